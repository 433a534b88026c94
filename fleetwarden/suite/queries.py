"""The registered queries: every operator run over the whole test tables.

Doubles are rounded to 6 places and arrays laid out as scalar columns, so that results compare by value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetwarden.functions import holidays
from fleetwarden.functions import keys as key_functions
from fleetwarden.functions.arrays import clean_request, request_json, spread_array
from fleetwarden.functions.temporal import calendar_features, retention_day, time_bucket
from fleetwarden.operators import joins, partials, quality, ranking, reshape, sampling, scoring, spread, stats, transport, transport_prices
from fleetwarden.plans import bindings as b
from fleetwarden.plans import gold as gold_plan
from fleetwarden.plans import flow, learning, silver, supply, tickets
from fleetwarden.plans.routes import route_arcs as arcs_plan
from fleetwarden.schemas import EVENTS, FAILURE_SHARES, PERCENTILES, PLATFORMS, SENSORS, sensor_impact
from fleetwarden.session import new_folder, pin, staged
from fleetwarden.sources import readers, writers
from fleetwarden.streaming import hourly, ingest

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in doubles})


def flat(df: DataFrame) -> DataFrame:
    """Percentile arrays as numbered columns, text arrays as comma lists, doubles rounded."""
    for field in df.schema.fields:
        if isinstance(field.dataType, T.ArrayType):
            if isinstance(field.dataType.elementType, T.DoubleType):
                df = spread_array(df, field.name, len(PERCENTILES))
            else:
                df = df.withColumn(field.name, F.array_join(field.name, ","))
    return rounded(df)


# ---- bronze and silver -------------------------------------------------------------------------------------


@query
def sensor_expectations(spark, sf):
    return rounded(silver.current_bronze(b.readings(spark, sf)))


@query
def expectation_metrics(spark, sf):
    tagged = b.readings(spark, sf).withColumn(
        "_rescued_data", F.when(F.col("sensor_C").isNull(), F.lit('{"sensor_C":"0"}'))
    )
    return quality.expectation_metrics(tagged, [*silver.CURRENT_RULES, *quality.not_null("turbine_id")])


@query
def sensor_stats(spark, sf):
    return flat(b.sensor_silver(spark, sf))


@query
def sensor_stats_labelled(spark, sf):
    return flat(silver.historical_sensor_silver(b.readings(spark, sf)))


@query
def training_set(spark, sf):
    return flat(gold_plan.damaged_flag(silver.training_dataset(b.readings(spark, sf))))


@query
def numeric_summary(spark, sf):
    return rounded(stats.numeric_summary(b.sensor_silver(spark, sf), learning.NUMERIC))


@query
def complete_training_rows(spark, sf):
    return flat(silver.training_dataset(b.readings(spark, sf)).dropna("any"))


@query
def rescued_data(spark, sf):
    """Event values that are not numbers, and the columns the schema does not name, end up in the rescue column."""
    raw = b.table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.concat(F.lit("n/a "), "event_type"))
        .otherwise(F.col("value").cast("decimal(18,2)").cast("string"))
        .alias("value"),
        F.when(F.col("event_type") == "view", F.col("props")).alias("props"),
    )
    target = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType())])
    held = readers.rescue(raw, target)
    return held.select(
        "event_id",
        F.round("value", 6).alias("value"),
        F.col("_rescued_data").isNull().alias("clean"),
        F.get_json_object("_rescued_data", "$.value").alias("rescued_value"),
        F.get_json_object("_rescued_data", "$.props").alias("rescued_props"),
    )


# ---- platforms ---------------------------------------------------------------------------------------------


@query
def platform_dimension(spark, sf):
    return rounded(b.platforms(spark, sf))


@query
def platform_metadata(spark, sf):
    return rounded(b.platform_meta(spark, sf))


@query
def fleet_expand(spark, sf):
    return reshape.expand_fleet(b.raw_platforms(spark, sf).select("designator"), "designator", 4)


@query
def failure_class_bucket(spark, sf):
    orders = b.table(spark, sf, "orders")
    bucket = ranking.cumulative_class(F.pmod("o_orderkey", F.lit(100)), FAILURE_SHARES)
    return orders.groupBy(bucket.alias("failure_class")).agg(F.count(F.lit(1)).alias("n"))


@query
def modulo_assignment(spark, sf):
    """Suppliers numbered in name order, dealt to customers' market segments in name order."""
    owners = ranking.number_distinct(b.table(spark, sf, "customer"), ["c_mktsegment"], "rn")
    owners = owners.select("c_mktsegment", (F.col("rn") - 1).cast("bigint").alias("owner_no"))
    rows = ranking.number_rows(b.table(spark, sf, "supplier").select("s_suppkey"), ["s_suppkey"], "rn")
    dealt = joins.modulo_assign(rows, F.col("rn").cast("bigint") - 1, owners, "owner_no")
    return dealt.select("s_suppkey", "c_mktsegment")


@query
def sensor_impact_parts(spark, sf):
    types = b.part_types(spark, sf).select("type", F.explode("sensors").alias("sensor"))
    return joins.join_dimension(types, sensor_impact(spark), "sensor")


# ---- status ------------------------------------------------------------------------------------------------


@query
def dedup_hour(spark, sf):
    timed = b.bronze(spark, sf).withColumn("hourly_timestamp", time_bucket("timestamp"))
    return rounded(ranking.dedup_hour(timed))


@query
def latest_per_turbine(spark, sf):
    return flat(ranking.latest_per_unit(b.sensor_silver(spark, sf)))


@query
def baseline_prediction(spark, sf):
    rows = b.sensor_silver(spark, sf).select("turbine_id", "hourly_timestamp", "avg_energy")
    placed = rows.withColumn(
        "prediction", scoring.placeholder_prediction("turbine_id", F.unix_timestamp("hourly_timestamp"))
    )
    return rounded(placed)


@query
def scoring_gate(spark, sf):
    scored = b.table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("prediction")
    )
    return rounded(quality.acceptance_gate(scored))


@query
def request_coercion(spark, sf):
    """Missing numbers become 0.0, malformed array text becomes zeros."""
    raw = b.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.nullif("l_tax", F.lit(0.0)).alias("avg_energy"),
        F.when(F.col("l_returnflag") == "A", F.lit("[broken"))
        .when(F.col("l_returnflag") == "N", F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("["), F.col("l_linenumber").cast("string"), F.lit(", 1, 2, 3, 4.5]")))
        .alias("percentiles"),
    )
    return flat(clean_request(raw, ["avg_energy"], ["percentiles"]))


@query
def request_rows(spark, sf):
    """One JSON request of all 14 feature fields per latest row, read back from its text."""
    fields = ["hourly_timestamp", *learning.NUMERIC, *learning.ARRAYS]
    rows = ranking.latest_per_unit(b.sensor_silver(spark, sf))
    packed = rows.select("turbine_id", request_json("turbine_id", *fields).alias("request"))
    kinds = {**dict.fromkeys(learning.NUMERIC, "double"), **dict.fromkeys(learning.ARRAYS, "array<double>")}
    shape = "turbine_id string, hourly_timestamp string, " + ", ".join(f"{c} {k}" for c, k in kinds.items())
    read = packed.select("turbine_id", F.from_json("request", shape).alias("r"))
    return flat(
        read.select(
            "turbine_id",
            F.col("r.hourly_timestamp").alias("iso_time"),
            F.col("r.turbine_id").alias("request_turbine"),
            *[f"r.{c}" for c in kinds],
        )
    )


@query
def current_predictions(spark, sf):
    return flat(b.predictions(spark, sf))


@query
def gold_status(spark, sf):
    return flat(b.gold(spark, sf))


@query
def gold_latest_only(spark, sf):
    return flat(b.gold(spark, sf, latest_only=True))


@query
def latest_snapshot(spark, sf):
    return flat(gold_plan.newest_status(b.gold(spark, sf)))


@query
def interval_status_join(spark, sf):
    """Hourly statistics inside fault intervals of the same unit, boundaries excluded."""
    hours = b.sensor_silver(spark, sf).select(
        "turbine_id", "avg_energy", F.unix_timestamp("hourly_timestamp").alias("hour_seconds")
    )
    found = joins.interval_join(
        hours, b.status_intervals(spark, sf), ["turbine_id"], "hour_seconds", "start_time", "end_time", 3600
    )
    return rounded(found)


@query
def label_prediction_crosstab(spark, sf):
    return joins.label_crosstab(b.readings(spark, sf), b.predictions(spark, sf), "turbine_id")


@query
def example_turbine_readings(spark, sf):
    return rounded(sampling.example_readings(b.readings(spark, sf)))


@query
def maintenance_by_label(spark, sf):
    """Readings of every label beside their maintenance action, through the salted path ('ok' is the hot key)."""
    labels = b.readings(spark, sf).select(F.col("abnormal_sensor").alias("fault"), "timestamp")
    joined = joins.salted_join(labels, b.maintenance_actions(spark), ["fault"], "left")
    return joined.groupBy("fault", "maintenance_type").agg(F.count(F.lit(1)).alias("n"))


# ---- supply ------------------------------------------------------------------------------------------------


def _dims(spark, sf):
    parts, platforms = b.parts(spark, sf), b.platforms(spark, sf)
    return parts, platforms


def _lp(spark, sf):
    parts, platforms = _dims(spark, sf)
    return supply.lp_table(parts, platforms, b.gold(spark, sf, platforms)), parts, platforms


def _shipping(spark, sf):
    parts, platforms = _dims(spark, sf)
    return supply.Shipping(parts, platforms, b.gold(spark, sf, platforms))


@query
def parts_inventory(spark, sf):
    return flat(b.parts(spark, sf))


@query
def stock_port_distance(spark, sf):
    return rounded(supply.site_port_distance(*_dims(spark, sf)))


@query
def shipping_cost_rank(spark, sf):
    return rounded(supply.shipping_cost(*_dims(spark, sf)))


@query
def cost_matrix_wide(spark, sf):
    cost = staged(supply.shipping_cost(*_dims(spark, sf)))
    return rounded(reshape.pivot_prefixed(cost, ["stock_location"], "homeport", F.max("distance"), "Cost_", b.PORT_IDS))


@query
def cost_unpivot(spark, sf):
    cost = staged(supply.shipping_cost(*_dims(spark, sf)))
    wide = reshape.pivot_prefixed(cost, ["stock_location"], "homeport", F.max("distance"), "Cost_", b.PORT_IDS)
    return rounded(reshape.unpivot_prefixed(wide, ["stock_location"], "Cost_", "home_location_id", "cost"))


@query
def supply_long(spark, sf):
    return supply.supply(b.parts(spark, sf))


@query
def demand_long(spark, sf):
    parts, platforms = _dims(spark, sf)
    return supply.demand(b.gold(spark, sf, platforms), parts)


@query
def lp_table(spark, sf):
    return rounded(_lp(spark, sf)[0])


@query
def cost_pivot(spark, sf):
    return rounded(supply.cost_wide(staged(_lp(spark, sf)[0]), values=b.DESIGNATOR_IDS))


@query
def supply_pivot(spark, sf):
    return supply.supply_wide(staged(_lp(spark, sf)[0]), b.SITE_IDS)


@query
def demand_pivot(spark, sf):
    return supply.demand_wide(staged(_lp(spark, sf)[0]), values=b.DESIGNATOR_IDS)


@query
def lp_wide(spark, sf):
    return rounded(supply.lp_wide(_lp(spark, sf)[0], b.SITE_IDS, b.DESIGNATOR_IDS))


@query
def transport_feasibility(spark, sf):
    made = _shipping(spark, sf)
    return transport.totals(made.stock, made.asked)


@query
def infeasible_products(spark, sf):
    made = _shipping(spark, sf)
    return supply.infeasible_products(made.asked, made.stock, made.plan)


@query
def transport_plan(spark, sf):
    return _shipping(spark, sf).plan


@query
def transport_audit(spark, sf):
    """The solved plan checked: demand met exactly, no site overdrawn, no designator short."""
    made = _shipping(spark, sf)
    return transport.plan_audit(made.asked, made.stock, made.plan)


@query
def transport_optimality(spark, sf):
    """The plan's prices checked: no route is too cheap, nothing flows at a loss, no idle stock has a price."""
    return transport.optimality(_shipping(spark, sf).flows).drop("total_cost")


@query
def transport_optimality_km(spark, sf):
    """Least kilometres where every customer has costs of its own: plan and prices prove each other."""
    plan, priced = transport_prices.least_cost(*b.customer_shipping(spark, sf))
    return transport_prices.proof(staged(plan), priced).drop("total_cost")


@query
def shipment_totals(spark, sf):
    """Shipped units per product and home port."""
    made = _shipping(spark, sf)
    lanes = made.asked.select("designator_id", "lane").distinct()
    shipped = made.plan.join(lanes, "designator_id").groupBy("type", "lane")
    return shipped.agg(F.sum("qty_shipped").alias("shipped"))


@query
def shipment_recommendations(spark, sf):
    parts, platforms = _dims(spark, sf)
    made = supply.Shipping(parts, platforms, b.gold(spark, sf, platforms))
    return supply.with_names(made.plan, parts, platforms)


@query
def named_shipment_totals(spark, sf):
    """The named plan by product and designator: what each receives, which no choice among equal-cost plans changes."""
    named = shipment_recommendations(spark, sf).filter("qty_shipped > 0")
    return named.groupBy("type", "designator_id", "designator").agg(
        F.sum("qty_shipped").alias("shipped"), F.count_if(F.col("stock_location").isNull()).alias("unnamed_sites")
    )


# ---- tickets and routes ------------------------------------------------------------------------------------


def _ticket_columns(gold):
    return gold.select(
        "turbine_id", "hourly_timestamp", "prediction", "designator", "designator_id", "maintenance_type"
    )


def _fixture(spark, sf):
    parts, platforms = _dims(spark, sf)
    gold = staged(_ticket_columns(b.gold(spark, sf, platforms)))
    return staged(b.fixture_shipments(parts, platforms, gold)), gold, parts, platforms


@query
def part_orders(spark, sf):
    return tickets.part_orders(_fixture(spark, sf)[0])


@query
def parts_required(spark, sf):
    return flat(tickets.required_parts(b.gold(spark, sf), b.parts(spark, sf)))


@query
def parts_required_per_hour(spark, sf):
    return flat(tickets.required_parts(b.gold(spark, sf), b.parts(spark, sf), keep_duplicates=True))


@query
def parts_required_long(spark, sf):
    """One row per unit, fault and stock number, without lists."""
    return tickets.required_parts_long(b.gold(spark, sf), b.parts(spark, sf))


@query
def work_orders(spark, sf):
    shipments, gold, parts, _ = _fixture(spark, sf)
    return flat(tickets.work_orders(gold, parts, staged(tickets.part_orders(shipments))))


@query
def planned_work_orders(spark, sf):
    """Work orders on the solver's own shipments."""
    parts, platforms = _dims(spark, sf)
    gold = staged(_ticket_columns(b.gold(spark, sf, platforms)))
    plan = staged(supply.with_names(supply.Shipping(parts, platforms, gold).plan, parts, platforms))
    return flat(tickets.work_orders(gold, parts, staged(tickets.part_orders(plan))))


@query
def route_arcs(spark, sf):
    shipments, _, parts, platforms = _fixture(spark, sf)
    return rounded(arcs_plan(shipments, parts, platforms))


@query
def route_arcs_underway(spark, sf):
    """Arcs to platforms at sea: the simulated position, held as text, replaces the home port's."""
    shipments, _, parts, platforms = _fixture(spark, sf)
    moved = platforms.withColumns(
        {"sim_lat": (F.col("lat") / 2).cast("string"), "sim_lon": (F.col("long") / 2 + 1).cast("string")}
    )
    return rounded(arcs_plan(shipments, parts, moved))


@query
def spread_duplicates(spark, sf):
    return rounded(spread.spread_on_circle(b.raw_platforms(spark, sf), ["designator"]))


@query
def jitter_duplicates(spark, sf):
    return rounded(spread.jitter_repeats(b.raw_platforms(spark, sf), ["designator"]))


# ---- series, sampling, names -------------------------------------------------------------------------------


@query
def sliced_numbering(spark, sf):
    """Orders numbered by date through the sliced path, whatever their count."""
    orders = b.table(spark, sf, "orders").select("o_orderdate", "o_orderkey")
    numbered = ranking.number_rows(orders, ["o_orderdate", "o_orderkey"], "n")
    return numbered.select("o_orderkey", "n")


@query
def sliced_numbering_by_status(spark, sf):
    """Orders numbered by date within each of three hot statuses, through the sliced path."""
    orders = b.table(spark, sf, "orders").select("o_orderstatus", "o_orderdate", "o_orderkey")
    numbered = ranking.number_rows(
        orders, ["o_orderdate", "o_orderkey"], "n", group=["o_orderstatus"]
    )
    return numbered.select("o_orderkey", "n")


@query
def time_grid(spark, sf):
    """An hourly grid per unit from its first to its last reading."""
    span = b.readings(spark, sf, labelled=False).groupBy("turbine_id").agg(
        F.min("timestamp").alias("first"), F.max("timestamp").alias("last")
    )
    return reshape.time_grid(span, "first", "last", 3600).select("turbine_id", "timestamp")


@query
def running_energy(spark, sf):
    """Running sum of absolute energy per supplier, carried over from ship day to ship day."""
    order = ["l_orderkey", "l_linenumber", "l_partkey"]
    lines = b.table(spark, sf, "lineitem").select("l_suppkey", "l_shipdate", *order, "l_extendedprice")
    summed = ranking.running_total(
        lines, ["l_suppkey"], "l_shipdate", order, F.abs(F.col("l_extendedprice") - 20000), "running"
    )
    return summed.select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", F.round("running", 2).alias("running")
    )


@query
def running_total_null_keys(spark, sf):
    """Running revenue by status and priority where both are partly null: null keys are keys."""
    orders = b.table(spark, sf, "orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("O")).alias("status"),
        F.nullif(F.substring("o_orderpriority", 1, 1), F.lit("3")).alias("level"),
        F.round(F.col("o_totalprice") * 100, 0).cast("bigint").alias("cents"),
    )
    return ranking.running_total(orders, ["status"], "level", ["o_orderkey"], F.col("cents"), "running").select(
        "o_orderkey", "running"
    )


@query
def datetime_features(spark, sf):
    hours = b.sensor_silver(spark, sf).select("turbine_id", "hourly_timestamp")
    return rounded(calendar_features(hours, "hourly_timestamp"))


@query
def split_labels(spark, sf):
    rows = b.table(spark, sf, "lineitem")
    key = ["l_orderkey", "l_linenumber", "l_partkey"]
    return sampling.with_split(rows, key).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query
def bernoulli_sample(spark, sf):
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return sampling.bernoulli(b.table(spark, sf, "lineitem").select(*key), 0.05, key)


@query
def newest_experiment(spark, sf):
    """The newest run by the stamp in its name, judged 10 days after the last order."""
    orders = b.table(spark, sf, "orders")
    names = orders.select(
        F.concat_ws("-", F.lit("automl"), "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd_HH:mm:ss")).alias("name")
    )
    today = F.date_add(orders.agg(F.max(F.to_date("o_orderdate"))).scalar(), 10)
    return ranking.newest_named(names, "name", today).select("name", "age_days")


@query
def retention_days(spark, sf):
    orders = b.table(spark, sf, "orders")
    return orders.groupBy(retention_day(F.to_date("o_orderdate")).alias("drop_day")).agg(F.count(F.lit(1)).alias("n"))


@query
def sanitised_names(spark, sf):
    named = b.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("cust-key"),
        key_functions.underscore_blanks(F.concat_ws(" ", "c_mktsegment", "c_name")).alias("full name (clean)"),
    )
    return key_functions.snake_columns(named)


# ---- sources and sinks -------------------------------------------------------------------------------------


@query
def csv_platforms(spark, sf):
    """Platforms written as CSV with a header and quoted commas, read back with the schema."""
    folder = new_folder(spark, "platforms-csv")
    listed = b.raw_platforms(spark, sf).withColumn("designator", F.concat_ws(", ", "designator", "home_location"))
    listed.select(*PLATFORMS.names).write.option("header", True).option("escape", '"').csv(folder)
    return rounded(readers.read_csv(spark, folder, PLATFORMS))


@query
def json_events(spark, sf):
    folder = new_folder(spark, "events-json")
    rows = b.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    rows.write.json(folder)
    return rounded(readers.read_json(spark, folder, rows.schema))


@query
def time_ordered_files(spark, sf):
    """Files of consecutive time stretches: rows read back by the day partition that holds them."""
    folder = new_folder(spark, "readings-by-day")
    writers.overwrite_by_day(b.readings(spark, sf, labelled=False), folder)
    stored = spark.read.parquet(folder)
    return stored.groupBy(F.col("day").cast("string").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last")
    )


@query
def feature_table(spark, sf):
    """A feature table with a key, replaced by a second version of its rows."""
    folder, name = new_folder(spark, "features"), f"features_{uuid.uuid4().hex}"
    features = b.sensor_silver(spark, sf).select(*learning.KEY, *learning.NUMERIC)
    writers.write_feature_table(features.filter("avg_energy > 0"), name, learning.KEY, folder)
    return rounded(writers.write_feature_table(features, name, learning.KEY, folder))


@query
def feature_pk_check(spark, sf):
    return quality.key_report(silver.training_dataset(b.readings(spark, sf)), learning.KEY)


@query
def managed_table(spark, sf):
    """A managed table replaced with another schema, read once it is there and has rows."""
    name = f"managed_{uuid.uuid4().hex}"
    orders = b.table(spark, sf, "orders")
    writers.overwrite_table(orders.select("o_orderkey"), name)
    writers.overwrite_table(orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")), name)
    return spark.table(name) if quality.table_ready(spark, name) else orders.limit(0)


@query
def bucketed_predictions(spark, sf):
    """Statistics and platforms stored in buckets by unit, joined without an exchange: hours and predictions a platform."""
    name = f"bucketed_{uuid.uuid4().hex}"
    statistics = writers.overwrite_bucketed(b.sensor_silver(spark, sf).select(*learning.KEY, *learning.NUMERIC), f"{name}_s", ["turbine_id"], 8)
    meta = writers.overwrite_bucketed(b.platform_meta(spark, sf), f"{name}_m", ["turbine_id"], 8)
    scored = gold_plan.current_predictions(statistics, meta, b.scorer())
    return scored.groupBy("designator_id", "prediction").agg(F.count(F.lit(1)).alias("hours"), F.count_distinct("turbine_id").alias("units"))


# ---- streams -----------------------------------------------------------------------------------------------


def _event_stream(spark, sf):
    # The table folder is the landing folder; its events are the only drop the glob lets in.
    return ingest.file_stream(pin(spark), sf, EVENTS, glob="events.parquet")


@query
def stream_ingest(spark, sf):
    """Events through the drop rules of a stream into a Parquet sink."""
    folder = new_folder(spark, "stream-ingest")
    rules = [quality.Expectation("correct_energy", "value > 25", drop=True), *quality.not_null("user_id")]
    ingest.ingest_files(pin(spark), sf, f"{folder}/table", f"{folder}/state", EVENTS, rules, glob="events*.parquet")
    stored = spark.read.schema(EVENTS).parquet(f"{folder}/table")
    return rounded(stored.select("event_id", "user_id", "event_type", F.col("value").alias("energy")))


@query
def stream_expectation_counts(spark, sf):
    """Expectation counts summed over many one-file micro-batches, from the stored metrics."""
    folder = new_folder(spark, "stream-counts")
    b.table(spark, sf, "events").repartition(16, "event_id").write.parquet(f"{folder}/landing")
    rules = [
        quality.Expectation("correct_energy", "value > 25", drop=True),
        quality.Expectation("known_type", "event_type <> 'error'"),
    ]
    ingest.ingest_files(spark, f"{folder}/landing", f"{folder}/table", f"{folder}/state", EVENTS, rules, 1)
    return ingest.expectation_totals(spark, f"{folder}/table_metrics")


@query
def rescued_landing(spark, sf):
    """One landing folder whose files differ in types and columns: nothing is lost, odd values are rescued."""
    folder = new_folder(spark, "rescued-landing")
    events = b.table(spark, sf, "events")
    kind, note = F.col("event_type"), F.concat(F.lit("n/a "), "event_type")
    drops = [
        events.filter(~kind.isin("error", "view")).select("event_id", "value"),
        events.filter(kind == "view").select("event_id", "value", "props"),
        events.filter(kind == "error").select("event_id", note.alias("value")),
    ]
    for drop in drops:
        drop.write.mode("append").parquet(f"{folder}/landing")
    target = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType())])
    ingest.ingest_files(spark, f"{folder}/landing", f"{folder}/table", f"{folder}/state", target)
    held = spark.read.parquet(f"{folder}/table")
    return held.select(
        "event_id",
        F.round("value", 6).alias("value"),
        F.col("_rescued_data").isNull().alias("clean"),
        F.get_json_object("_rescued_data", "$.value").alias("rescued_value"),
        F.get_json_object("_rescued_data", "$.props").alias("rescued_props"),
    )


@query
def stream_upsert(spark, sf):
    """Readings that arrive in three drops, each late for the one before: the upserted hours equal the batch plan."""
    lake = flow.Lake(spark, new_folder(spark, "upsert"))
    landing = new_folder(spark, "upsert-landing")
    readings = b.readings(spark, sf, labelled=False)
    for drop in range(3):
        part = readings.filter(F.pmod(F.xxhash64("turbine_id", "timestamp", "energy"), F.lit(3)) == drop)
        part.write.mode("append").parquet(f"{landing}/incoming_data")
        flow.ingest_table(lake, landing, "incoming_data")
        flow.upsert_silver(lake)
    return flat(lake.read("sensor_silver"))


@query
def replaced_table(spark, sf):
    """A lake table replaced twice, with another schema: readers see the last version alone."""
    lake = flow.Lake(spark, new_folder(spark, "replaced"))
    orders = b.table(spark, sf, "orders")
    lake.replace("status", orders.select("o_orderkey", "o_orderstatus"))
    lake.replace("status", orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")))
    return lake.read("status")


@query
def ordered_files(spark, sf):
    """Files of consecutive, sorted stretches of time: rows whose file starts before another file's end."""
    folder = new_folder(spark, "ordered")
    rows = b.readings(spark, sf, labelled=False).select("timestamp", "turbine_id")
    writers.overwrite_time_ordered(rows, folder, 4)
    stored = spark.read.parquet(folder).select("timestamp", F.input_file_name().alias("file"))
    spans = stored.groupBy("file").agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("z"), F.count(F.lit(1)).alias("n"))
    one, two = spans.alias("one"), spans.alias("two")
    crossed = one.join(two, (F.col("one.file") != F.col("two.file")) & (F.col("one.a") < F.col("two.z")) & (F.col("two.a") < F.col("one.z")))
    return spans.agg(F.sum("n").alias("rows"), (F.count(F.lit(1)) <= 4).alias("few_files")).withColumn(
        "crossed", crossed.agg(F.count(F.lit(1))).scalar()
    )


@query
def fixed_file_count(spark, sf):
    folder = new_folder(spark, "fixed-files")
    writers.overwrite_folder(b.table(spark, sf, "supplier").repartition(7), folder, files=2)
    stored = spark.read.parquet(folder).select(F.input_file_name().alias("file"))
    return stored.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("file").alias("files"))


@query
def stream_sensor_stats(spark, sf):
    """Hourly statistics kept by a watermarked state, upserted hour by hour."""
    folder = new_folder(spark, "stream-hourly")
    timed = _event_stream(spark, sf).select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("turbine_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("value").alias("energy"),
    )
    aggs = stats.statistic_columns(sensors=["energy"])
    state = hourly.hourly_state(timed, ["turbine_id"], "event_time", aggs)
    hourly.upsert_to(state, f"{folder}/table", f"{folder}/state").awaitTermination()
    stored = spark.read.schema(f"turbine_id string, avg_energy double, std_energy double, "
                               f"percentiles_energy array<double>, hourly_timestamp timestamp, batch int"
                               ).parquet(f"{folder}/table")
    return flat(hourly.current_hours(stored, ["turbine_id"]))


@query
def merged_sensor_stats(spark, sf):
    """Hourly statistics from the stored partials of three disjoint drops of the readings."""
    rows, keys = b.bronze(spark, sf), ["turbine_id", "hourly_timestamp"]
    hour = time_bucket("timestamp").alias("hourly_timestamp")
    drop = F.pmod(F.xxhash64("turbine_id", "timestamp", "energy"), F.lit(3)).alias("drop")
    stored = staged(partials.partial_statistics(rows, ["turbine_id", hour, drop]))
    return flat(partials.final_statistics(partials.merge_partials(stored, keys, "drop"), keys))


def _late_events(spark, sf):
    """Events in three drops by time; every tenth event comes with the last drop, however old it is."""
    folder = new_folder(spark, "late-events")
    events = b.events(spark, sf).select("turbine_id", "event_time", "energy")
    seconds = F.unix_timestamp("event_time")
    third = F.floor((seconds - 1_704_067_200) / 864_000)  # ten days each from the start of 2024
    drop = F.when(F.pmod(seconds, F.lit(10)) == 7, 2).when(third <= 0, 0).when(third == 1, 1).otherwise(2)
    for number in range(3):
        events.filter(drop == number).coalesce(1).write.mode("append").parquet(f"{folder}/landing")
    stream = ingest.file_stream(spark, f"{folder}/landing", events.schema, 1)
    table = hourly.HourlyPartials(spark, f"{folder}/table", ["turbine_id"], "event_time", ["energy"])
    table.run(stream, f"{folder}/state").awaitTermination()
    return table


@query
def stream_with_late_rows(spark, sf):
    """Streamed hours with their late rows: the same as one computation over all events."""
    return flat(_late_events(spark, sf).statistics())


@query
def late_row_counts(spark, sf):
    """Rows and late rows of every micro-batch."""
    return _late_events(spark, sf).batches().select("batch", "rows", "late")


@query
def holiday_orders(spark, sf):
    """Orders on public holidays, which a calendar of rules gives for ten years, and on the days these are observed."""
    orders = b.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d"))
    dates = holidays.calendar(spark, 1995, 2004)
    counted = [
        holidays.with_holidays(orders, F.col("d"), dates, observed)
        .select(F.year("d").alias("year"), F.explode("holidays").alias("holiday"))
        .groupBy("year", "holiday")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("observed", F.lit(observed))
        for observed in (False, True)
    ]
    return counted[0].unionByName(counted[1])


# ---- learning ----------------------------------------------------------------------------------------------


def _history(spark, sf):
    return staged(silver.training_dataset(b.readings(spark, sf)))


def _frame(spark, sf, history=None):
    history = _history(spark, sf) if history is None else history
    labels = learning.known_labels(history)
    return staged(learning.training_frame(history, labels)), labels


@query
def class_weights(spark, sf):
    return rounded(learning.balancing_weights(silver.training_dataset(b.readings(spark, sf))))


@query
def scaled_features(spark, sf):
    """The numeric block as the models see it: mean-filled and standardised, here over all rows."""
    rows = staged(learning.prepared(b.sensor_silver(spark, sf)))
    model = Pipeline(stages=learning.feature_stages(calendar=False)[:3]).fit(rows)
    block = model.transform(rows).withColumn("v", vector_to_array("numeric"))
    named = [F.get("v", i).alias(c) for i, c in enumerate(learning.NUMERIC)]
    return rounded(block.select(*learning.KEY, *named))


@query
def percentile_vector(spark, sf):
    """The concatenated percentile vector, missing arrays as zeros."""
    rows = learning.prepared(b.sensor_silver(spark, sf)).withColumn("v", vector_to_array("percentiles"))
    size = len(PERCENTILES) * len(SENSORS)
    return rounded(rows.select(*learning.KEY, *[F.get("v", i).alias(f"v{i + 1}") for i in range(size)]))


@query
def hour_flags(spark, sf):
    """The one-hot block of the hour of day, as many columns as hours occur, counted by hour and column."""
    rows = staged(learning.prepared(b.sensor_silver(spark, sf)))
    stages = [s for s in learning.feature_stages() if set(s.extractParamMap()) and "hour" in str(s.extractParamMap())]
    flagged = Pipeline(stages=stages[:2]).fit(rows).transform(rows).withColumn("v", vector_to_array("hour_flags"))
    ones = flagged.select(F.col("hour_of_day").cast("int").alias("hour"), F.array_position("v", F.lit(1.0)).alias("at"), F.aggregate("v", F.lit(0.0), lambda a, x: a + x).alias("s"))
    return ones.groupBy("hour", "at").agg(F.count(F.lit(1)).alias("n"), F.max("s").alias("flags"))


def _fixed_confusion(spark, sf):
    """Confusion counts of predictions that SQL can state too: the line number decides."""
    rows = b.table(spark, sf, "lineitem").select(
        F.when(F.col("l_orderkey") % 5 < 3, "train").when(F.col("l_orderkey") % 5 == 3, "val").otherwise("test").alias("split"),
        F.col("l_returnflag").alias("label"),
        F.when(F.col("l_linenumber") <= 3, "N").when(F.col("l_linenumber") <= 5, "A").otherwise("R").alias("prediction"),
    )
    return rows.groupBy("split", "label", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query
def split_metrics(spark, sf):
    return rounded(learning.split_metrics(_fixed_confusion(spark, sf)))


@query
def confusion_matrix(spark, sf):
    return learning.confusion_wide(_fixed_confusion(spark, sf), ["A", "N", "R"])


@query
def best_run(spark, sf):
    """Every line number as a run whose F1 on a split is its share of returned lines: the best by validation F1."""
    lines = b.table(spark, sf, "lineitem").select(
        F.col("l_linenumber").cast("string").alias("run"),
        F.when(F.col("l_orderkey") % 5 < 3, "train").when(F.col("l_orderkey") % 5 == 3, "val").otherwise("test").alias("split"),
        (F.col("l_returnflag") == "R").cast("int").alias("hit"),
    )
    scored = lines.groupBy("run", "split").agg(F.avg("hit").alias("weighted_f1"))
    return rounded(learning.best_run(learning.runs_table(scored)))


@query
def ml_logreg_eval(spark, sf):
    frame, labels = _frame(spark, sf)
    model = learning.train(frame, learning.logistic(frame))
    return learning.split_metrics(learning.confusion(model, frame, labels))


@query
def logistic_optimality(spark, sf):
    """A fitted logistic regression checked from the training rows alone: weights of each class that are not at their best."""
    frame, labels = _frame(spark, sf)
    rows = learning.features(frame)[1].filter(F.col("split") == "train")
    proof = learning.logistic_proof(learning.logistic(frame, 0.1, 200).setTol(1e-9).fit(rows), rows)
    names = F.array(*[F.lit(x) for x in labels])
    return proof.select(F.get(names, F.col("label")).alias("label"), F.col("off").alias("weights_off"))


@query
def ml_rf_eval(spark, sf):
    frame, labels = _frame(spark, sf)
    model = learning.train(frame, learning.forest(), calendar=False)
    return learning.split_metrics(learning.confusion(model, frame, labels))


@query
def ml_deep_forest_eval(spark, sf):
    """The forest at full depth: upper levels by passes over the table, the rest of every subtree in one task."""
    frame, labels = _frame(spark, sf)
    return learning.split_metrics(learning.confusion(learning.train_deep(frame), frame, labels))


@query
def trained_confusion_matrix(spark, sf):
    """The confusion matrix of a trained forest on the validation rows."""
    frame, labels = _frame(spark, sf)
    model = learning.train(frame, learning.forest(), calendar=False)
    return learning.confusion_wide(learning.confusion(model, frame, labels), labels)


@query
def trained_best_run(spark, sf):
    """Three candidates on features that are fitted once per feature set, the best by validation F1."""
    frame, labels = _frame(spark, sf)
    runs = learning.compare(
        frame,
        labels,
        [("logistic", learning.logistic(frame), True), ("logistic_strong", learning.logistic(frame, 0.1), True), ("forest", learning.forest(), False)],
    )
    return learning.best_run(learning.runs_table(runs))


@query
def model_search(spark, sf):
    """Regularisation strengths fitted on the training rows and judged on the validation rows."""
    frame, labels = _frame(spark, sf)
    return learning.search(frame, labels, [learning.INVERSE_REGULARISATION, 1.0])


def _halving(spark, sf):
    """A search over strengths: few iterations for all, more for the better half, all iterations for the last."""
    frame, labels = _frame(spark, sf)
    return learning.successive_halving(frame, labels, [100.0, learning.INVERSE_REGULARISATION, 1.0, 0.01], rungs=(10, 30, learning.ITERATIONS))


@query
def search_runs(spark, sf):
    """The runs table of a search by successive halving: fits and their iterations by rung."""
    runs = _halving(spark, sf)
    return runs.groupBy("rung").agg(
        F.count(F.lit(1)).alias("fits"), F.max("iterations").alias("iterations"), F.count_if("kept").alias("kept")
    )


def _model_gold(spark, sf):
    """Gold status with a trained forest as the scorer, and the labels it knows."""
    frame, labels = _frame(spark, sf)
    model = learning.train(frame, learning.forest(), calendar=False)
    gold = gold_plan.status_gold(
        b.sensor_silver(spark, sf),
        b.platform_meta(spark, sf),
        b.maintenance_actions(spark),
        learning.score_status(model, labels),
    )
    return gold, labels


@query
def model_status(spark, sf):
    """Gold status with a trained model as the scorer, counted by prediction and maintenance level."""
    return _model_gold(spark, sf)[0].groupBy("prediction", "maintenance_type").agg(F.count(F.lit(1)).alias("n"))


@query
def model_status_audit(spark, sf):
    """Gold status with a trained model as the scorer: hours and units by home port, predictions that are no label, and
    maintenance levels that are not the prediction's."""
    gold, labels = _model_gold(spark, sf)
    faults = b.maintenance_actions(spark).select("fault", F.col("maintenance_type").alias("listed"))
    level = joins.join_dimension(gold.withColumnRenamed("prediction", "fault"), faults, "fault", "left")
    return level.groupBy("home_location").agg(
        F.count(F.lit(1)).alias("hours"),
        F.count_distinct("turbine_id").alias("units"),
        F.count_if(~F.coalesce(F.col("fault").isin(labels), F.lit(False))).alias("unknown_predictions"),
        F.count_if(~F.col("maintenance_type").eqNullSafe(F.col("listed"))).alias("wrong_levels"),
    )


def _function_differences(spark, history, model, labels, name):
    """Rows, and rows where the model as a SQL function of the 14 input columns differs from the model."""
    learning.register_scorer(spark, name, model, labels)
    inputs = history.select(*learning.KEY, *learning.INPUTS[1:])
    by_pipeline = learning.score_status(model, labels)(inputs).withColumnRenamed("prediction", "by_pipeline")
    both = by_pipeline.withColumn("by_function", F.expr(f"{name}({', '.join(learning.INPUTS)})"))
    return both.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("by_function").eqNullSafe(F.col("by_pipeline"))).alias("different")
    )


@query
def registered_forest(spark, sf):
    """A stored forest as a SQL function, its nodes as arrays: rows, and rows where it differs from the library's forest."""
    history = _history(spark, sf)
    frame, labels = _frame(spark, sf, history)
    folder = new_folder(spark, "models")
    learning.publish(spark, learning.train(frame, learning.forest(), calendar=False), labels, folder, "champion", "run_1")
    return _function_differences(spark, history, *learning.published(spark, folder, "champion"), "predict_by_forest")


@query
def registered_scorer(spark, sf):
    """A stored model as a SQL function of the 14 input columns: rows, and rows where it differs from the pipeline."""
    history = _history(spark, sf)
    frame, labels = _frame(spark, sf, history)
    folder = new_folder(spark, "models")
    learning.publish(spark, learning.train(frame, learning.logistic(frame)), labels, folder, "champion", "run_1")
    return _function_differences(spark, history, *learning.published(spark, folder, "champion"), "predict_maintenance")
