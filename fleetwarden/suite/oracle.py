"""The same results in DuckDB SQL, written from the table definitions alone."""

from __future__ import annotations

from fleetwarden.plans.bindings import DESIGNATOR_IDS, PORT_IDS, SITE_IDS
from fleetwarden.schemas import FAILURE_SHARES, IMPACT, MAINTENANCE_ROWS, PERCENTILES, SENSORS

_NUMERIC = ["avg_energy", *[f"std_{s}" for s in SENSORS]]


def _h(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


def _case(percent: str) -> str:
    edge, whens = 0, []
    for name, share in FAILURE_SHARES:
        edge += share
        whens.append(f"WHEN {percent} < {edge} THEN '{name}'")
    return "CASE " + " ".join(whens) + " END"


def _lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else f"{v}::DOUBLE" if isinstance(v, float) else str(v)


_ORD = "(l_suppkey * 7 + l_linenumber - 1)"

READINGS = f"""
readings AS (
  SELECT 1704049200 + 15 * date_diff('day', DATE '1995-01-01', l_shipdate::DATE) AS timestamp,
    l_quantity AS "sensor_A", l_discount * 100 AS "sensor_B", nullif(l_tax * 100, 0) AS "sensor_C",
    l_extendedprice / 1000 AS "sensor_D", l_extendedprice * l_discount AS "sensor_E",
    l_quantity * l_discount AS "sensor_F", l_extendedprice - 20000 AS energy,
    'T' || l_suppkey || '-' || l_linenumber AS turbine_id,
    CASE WHEN {_ORD} * 10 > (SELECT count(*) * 7 FROM supplier) * 7 THEN {_case(f"({_ORD} % 100)")}
      ELSE 'ok' END AS abnormal_sensor
  FROM lineitem),
bronze AS (SELECT * FROM readings WHERE energy > 0)"""


def _stats(source: str, keys: str) -> str:
    probs = "[" + ", ".join(map(str, PERCENTILES)) + "]"
    std = ", ".join(f'stddev_pop("{s}") AS "std_{s}"' for s in SENSORS)
    pct = ", ".join(f'quantile_disc("{s}", {probs}) AS "percentiles_{s}"' for s in SENSORS)
    return (
        f"SELECT {keys}, date_trunc('hour', make_timestamp(timestamp * 1000000)) AS hourly_timestamp, "
        f"avg(energy) AS avg_energy, {std}, {pct} FROM {source} GROUP BY ALL"
    )


SILVER = READINGS + f""",
silver AS ({_stats("bronze", "turbine_id")})"""
HISTORY = READINGS + f""",
history AS ({_stats("readings", "turbine_id, abnormal_sensor")})"""


def _flat_stats() -> str:
    cols = ["round(avg_energy, 6) AS avg_energy"]
    cols += [f'round("std_{s}", 6) AS "std_{s}"' for s in SENSORS]
    for s in SENSORS:
        cols += [f'round("percentiles_{s}"[{i}], 6) AS "percentiles_{s}_{i}"' for i in range(1, 6)]
    return ", ".join(cols)


PLATFORMS = f"""
raw_platforms AS (
  SELECT DISTINCT n_name || ' ' || c_mktsegment AS designator, n_name AS home_location,
    (n_nationkey * 5 - 60)::DOUBLE AS lat, (n_nationkey * 14 - 170)::DOUBLE AS long
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
platforms AS (
  SELECT *, 'home_' || dense_rank() OVER (ORDER BY home_location) AS home_location_id,
    {_h("designator")} AS designator_id
  FROM raw_platforms)"""

META = PLATFORMS + """,
meta AS (
  SELECT 'T' || s_suppkey || '-' || line AS turbine_id, p.*
  FROM supplier, range(1, 8) r(line), (
    SELECT *, row_number() OVER (ORDER BY designator) - 1 AS owner_no, count(*) OVER () AS owners FROM platforms) p
  WHERE (s_suppkey * 7 + line - 1) % owners = owner_no)"""

_KEYTEXT = "turbine_id || '|' || epoch(hourly_timestamp)::BIGINT"


def _prediction(healthy: int, faults) -> str:
    names = "[" + ", ".join(f"'{f}'" for f in faults) + "]"
    h = _h(_KEYTEXT)
    return f"CASE WHEN {h} % 1000 < {healthy} THEN 'ok' ELSE {names}[(({h} >> 20) % {len(faults)})::INT + 1] END"


MAINTENANCE = """
maintenance(fault, maintenance_type, operable, ttr) AS (VALUES {})""".format(
    ", ".join("(" + ", ".join(_lit(v) for v in row) + ")" for row in MAINTENANCE_ROWS)
)

PREDICTIONS = SILVER + "," + META + f""",
predictions AS (
  SELECT turbine_id, silver.* EXCLUDE (turbine_id), home_location, designator, lat, long, home_location_id,
    designator_id, {_prediction(980, SENSORS)} AS prediction
  FROM silver JOIN meta USING (turbine_id))"""
GOLD = PREDICTIONS + "," + MAINTENANCE + """,
gold AS (
  SELECT p.*, maintenance_type, operable, ttr FROM predictions p LEFT JOIN maintenance ON prediction = fault)"""

_PLATFORM_COLS = "home_location, designator, lat, long, home_location_id, designator_id"
_GOLD_COLS = f"turbine_id, hourly_timestamp, {_flat_stats()}, {_PLATFORM_COLS}, prediction"
_MAINT_COLS = "maintenance_type, operable, round(ttr, 6) AS ttr"

PARTS = """
stock AS (
  SELECT r_name AS stock_location, 'supply_' || (r_regionkey + 1) AS stock_location_id,
    (r_regionkey * 25 - 60)::DOUBLE AS lat, (r_regionkey * 70 - 170)::DOUBLE AS long
  FROM region),
brands AS (
  SELECT p_brand AS type, substr(p_brand, 7)::INT AS n, max(p_size) AS width, min(p_size) AS height,
    count(*)::INT AS weight, min(p_retailprice) AS cost
  FROM part GROUP BY p_brand),
part_types AS (
  SELECT 'NSN-' || n AS "NSN", type, width, height, weight, cost, n + 30 AS production_time,
    CASE WHEN n % 5 = 0 THEN ['sensor_F']
      WHEN n % 2 = 0 THEN ['sensor_' || substr('ABCDE', n % 5 + 1, 1)]
      ELSE ['sensor_' || substr('ABCDE', n % 5 + 1, 1), 'sensor_' || substr('ABCDE', (n + 1) % 5 + 1, 1)]
    END AS sensors
  FROM brands),
inventory AS (
  SELECT p_brand AS type, 'supply_' || (p_partkey % 5 + 1) AS stock_location_id,
    count(*) FILTER (p_size % 5 < 2)::INT AS inventory_level, max(p_size) % 6 AS provisioning_time
  FROM part GROUP BY ALL),
parts AS (
  SELECT t.*, s.*, coalesce(inventory_level, 0) AS inventory_level, coalesce(provisioning_time, 0) AS provisioning_time
  FROM part_types t CROSS JOIN stock s LEFT JOIN inventory USING (type, stock_location_id))"""

_KM = """2 * 6371 * asin(least(1.0, sqrt(
    pow(sin((radians(p.lat) - radians(s.lat)) / 2), 2)
    + cos(radians(s.lat)) * cos(radians(p.lat)) * pow(sin((radians(p.long) - radians(s.long)) / 2), 2))))"""
COST = f"""
distance AS (
  SELECT stock_location_id, home_location_id, CASE WHEN km = 0 THEN 0.1 ELSE km END AS km
  FROM (
    SELECT stock_location_id, home_location_id, {_KM} AS km
    FROM (SELECT DISTINCT stock_location_id, lat, long FROM parts) s
    CROSS JOIN (SELECT DISTINCT home_location_id, lat, long FROM platforms) p)),
cost AS (
  SELECT stock_location_id, home_location_id, CASE WHEN place = 0 THEN 0.1 ELSE place END::DOUBLE AS cost
  FROM (
    SELECT a.stock_location_id, a.home_location_id, count(*) - 1 AS place
    FROM distance a JOIN distance o ON a.stock_location_id = o.stock_location_id AND o.km <= a.km
    GROUP BY ALL))"""
DEMAND = """
demand AS (
  SELECT designator_id, parts, count(*) AS demand
  FROM (
    SELECT DISTINCT designator_id, turbine_id, type AS parts
    FROM gold JOIN parts ON list_contains(sensors, prediction))
  GROUP BY ALL)"""
LP = GOLD + "," + PARTS + "," + COST + "," + DEMAND + """,
lp AS (
  SELECT s.type, s.stock_location_id, p.designator_id, p.home_location_id, c.cost,
    s.inventory_level AS supply, coalesce(d.demand, 0) AS demand
  FROM parts s JOIN cost c USING (stock_location_id) JOIN platforms p USING (home_location_id)
  LEFT JOIN demand d ON d.parts = s.type AND d.designator_id = p.designator_id
  WHERE s.type IN (SELECT parts FROM demand))"""
FEASIBLE = LP + """,
feasible AS (
  SELECT type, total_supply, total_demand, total_supply >= total_demand AS feasible
  FROM (SELECT type, sum(supply)::BIGINT AS total_supply
        FROM (SELECT DISTINCT type, stock_location_id, supply FROM lp) GROUP BY type)
  JOIN (SELECT type, sum(demand)::BIGINT AS total_demand
        FROM (SELECT DISTINCT type, designator_id, demand FROM lp) GROUP BY type) USING (type))"""
SHIPMENTS = LP + """,
shipments AS (
  SELECT type, stock_location_id, designator_id,
    (CASE WHEN row_number() OVER (PARTITION BY type, designator_id ORDER BY cost, stock_location_id) = 1
      THEN least(demand, supply) ELSE 0 END)::INT AS qty_shipped,
    stock_location, designator
  FROM lp JOIN stock USING (stock_location_id) JOIN (SELECT designator, designator_id FROM platforms)
    USING (designator_id)),
orders_made AS (
  SELECT s.*, 'PR-' || printf('%06d', n) AS order_number
  FROM shipments s JOIN (
    SELECT stock_location_id, designator_id, row_number() OVER (ORDER BY stock_location_id, designator_id) AS n
    FROM (SELECT DISTINCT stock_location_id, designator_id FROM shipments WHERE qty_shipped > 0))
  USING (stock_location_id, designator_id)
  WHERE qty_shipped > 0)"""
REQUIRED = """
required AS (
  SELECT turbine_id, prediction, list_sort(list(DISTINCT type)) AS parts_required
  FROM gold JOIN part_types ON list_contains(sensors, prediction)
  WHERE prediction <> 'ok' GROUP BY ALL)"""
_PRIORITY = """CASE maintenance_type WHEN 'Organizational Level' THEN 'Routine' WHEN 'Intermediate Level' THEN 'Urgent'
  WHEN 'Depot Level' THEN 'CASREP' END"""


def _circle(radius: float, columns: str, source: str = "raw_platforms") -> str:
    return f"""
  SELECT {columns},
    round(CASE WHEN n > 1 THEN lat + {radius} * sin(a) / 111000.0 ELSE lat END, 6) AS lat,
    round(CASE WHEN n > 1 THEN long + {radius} * cos(a) / (111000.0 * cos(radians(lat))) ELSE long END, 6) AS long
  FROM (
    SELECT *, count(*) OVER (PARTITION BY lat, long) AS n,
      2 * pi() * (row_number() OVER (PARTITION BY lat, long ORDER BY designator) - 1)
        / count(*) OVER (PARTITION BY lat, long) AS a
    FROM {source})"""


def _jitter() -> str:
    r = f"({_h("'0r|' || designator")} % 1000000) / 1000000.0 * 30.0"
    a = f"({_h("'0a|' || designator")} % 1000000) / 1000000.0 * (2 * pi())"
    return f"""WITH {PLATFORMS}
  SELECT designator, home_location,
    round(CASE WHEN k > 1 THEN lat + r * sin(a) / 111000.0 ELSE lat END, 6) AS lat,
    round(CASE WHEN k > 1 THEN long + r * cos(a) / (111000.0 * cos(radians(lat))) ELSE long END, 6) AS long
  FROM (
    SELECT *, row_number() OVER (PARTITION BY lat, long ORDER BY designator) AS k, {r} AS r, {a} AS a
    FROM raw_platforms)"""


def _summary() -> str:
    rows = [
        f"""SELECT '{c}' AS "column", count("{c}") AS count, round(avg("{c}"), 6) AS mean,
  round(stddev_samp("{c}"), 6) AS stddev, round(min("{c}"), 6) AS min, round(quantile_disc("{c}", 0.25), 6) AS p25,
  round(quantile_disc("{c}", 0.5), 6) AS p50, round(quantile_disc("{c}", 0.75), 6) AS p75,
  round(max("{c}"), 6) AS max FROM silver"""
        for c in _NUMERIC
    ]
    return f"WITH {SILVER} " + " UNION ALL ".join(rows)


def _calendar() -> str:
    t = "hourly_timestamp"
    places = {
        "day": (f"hour({t})", "24"),
        "week": (f"((isodow({t}) - 1) * 24 + hour({t}))", "168"),
        "month": (f"((day({t}) - 1) * 24 + hour({t}))", f"(day(last_day({t})) * 24)"),
        "year": (f"((dayofyear({t}) - 1) * 24 + hour({t}))", f"(dayofyear(make_date(year({t}), 12, 31)) * 24)"),
    }
    cols = []
    for name, (position, period) in places.items():
        for f in ("sin", "cos"):
            cols.append(f"round({f}(2 * pi() * {position} / {period}), 6) AS {f}_{name}")
    return f"""WITH {SILVER} SELECT turbine_id, {t}, epoch({t})::BIGINT AS unix_ts,
  (isodow({t}) >= 6)::INT AS is_weekend, (strftime({t}, '%m-%d') IN ('01-01', '07-04', '12-25'))::INT AS is_holiday,
  hour({t})::INT AS hour_of_day, {", ".join(cols)} FROM silver"""


def _scaled() -> str:
    filled = ", ".join(f'coalesce("{c}", avg("{c}") OVER ()) AS "{c}"' for c in _NUMERIC)
    scaled = ", ".join(
        f'round(("{c}" - avg("{c}") OVER ()) / stddev_samp("{c}") OVER (), 6) AS "{c}"' for c in _NUMERIC
    )
    return f"""WITH {SILVER}, filled AS (SELECT turbine_id, hourly_timestamp, {filled} FROM silver)
  SELECT turbine_id, hourly_timestamp, {scaled} FROM filled"""


_READING_COLS = ", ".join(["timestamp", *[f'round("{s}", 6) AS "{s}"' for s in SENSORS], "round(energy, 6) AS energy",
                           "turbine_id"])
_SPLIT = _h("l_orderkey || '|' || l_linenumber || '|' || l_partkey")
_SAMPLE = _h("l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey")
_IMPACT = "impact(sensor, impact) AS (VALUES " + ", ".join(f"('{s}', '{i}')" for s, i in IMPACT) + ")"
_EVENT_STATS = """SELECT 'U' || user_id AS turbine_id, round(avg(value), 6) AS avg_energy,
  round(stddev_pop(value), 6) AS std_energy, {}, date_trunc('hour', ts) AS hourly_timestamp
  FROM events GROUP BY user_id, date_trunc('hour', ts)""".format(
    ", ".join(f"round(quantile_disc(value, {p}), 6) AS percentiles_energy_{i}" for i, p in enumerate(PERCENTILES, 1))
)


def _wide(prefix: str, value: str, column: str, values, missing: int | None = None) -> str:
    """One column per value, with the same value list as the query's."""
    cell = lambda v: f"max({value}) FILTER (WHERE {column} = {_lit(v)})"
    full = cell if missing is None else lambda v: f"coalesce({cell(v)}, {missing})"
    return ", ".join(f'{full(v)} AS "{prefix}{v}"' for v in values)


_UUID = "md5(designator || '|' || unit_no)"

_CONFUSION = """scored AS (
  SELECT CASE WHEN l_orderkey % 5 < 3 THEN 'train' WHEN l_orderkey % 5 = 3 THEN 'val' ELSE 'test' END AS split,
    l_returnflag AS label, CASE WHEN l_linenumber <= 3 THEN 'N' WHEN l_linenumber <= 5 THEN 'A' ELSE 'R' END AS prediction
  FROM lineitem)"""

ORACLE: dict[str, str] = {
    "sensor_expectations": f"WITH {READINGS} SELECT {_READING_COLS}, abnormal_sensor FROM bronze",
    "expectation_metrics": f"""WITH {READINGS}, t AS (SELECT count(*) AS rows,
      count(*) FILTER ("sensor_C" IS NULL) AS a, count(*) FILTER (NOT coalesce(energy > 0, false)) AS b,
      count(*) FILTER (turbine_id IS NULL) AS c FROM readings)
      SELECT 'correct_schema' AS rule, 'warn' AS action, rows, a AS violations FROM t
      UNION ALL SELECT 'correct_energy', 'drop', rows, b FROM t
      UNION ALL SELECT 'turbine_id_valid', 'drop', rows, c FROM t""",
    "sensor_stats": f"WITH {SILVER} SELECT turbine_id, hourly_timestamp, {_flat_stats()} FROM silver",
    "sensor_stats_labelled": f"""WITH {HISTORY}
      SELECT turbine_id, abnormal_sensor, hourly_timestamp, {_flat_stats()} FROM history""",
    "training_set": f"""WITH {HISTORY} SELECT turbine_id, abnormal_sensor, hourly_timestamp, {_flat_stats()},
      abnormal_sensor <> 'ok' AS damaged FROM history""",
    "complete_training_rows": f"""WITH {HISTORY}
      SELECT turbine_id, abnormal_sensor, hourly_timestamp, {_flat_stats()} FROM history
      WHERE "std_sensor_C" IS NOT NULL""",
    "numeric_summary": _summary(),
    "rescued_data": """SELECT event_id, CASE WHEN event_type <> 'error' THEN round(value, 6) END AS value,
      event_type NOT IN ('error', 'view') AS clean,
      CASE WHEN event_type = 'error' THEN 'n/a error' END AS rescued_value,
      CASE WHEN event_type = 'view' THEN props END AS rescued_props FROM events""",
    "platform_dimension": f"WITH {PLATFORMS} SELECT {_PLATFORM_COLS} FROM platforms",
    "platform_metadata": f"WITH {META} SELECT turbine_id, {_PLATFORM_COLS} FROM meta",
    "fleet_expand": f"""WITH {PLATFORMS} SELECT designator, unit_no::INT AS unit_no,
      substr({_UUID}, 1, 8) || '-' || substr({_UUID}, 9, 4) || '-' || substr({_UUID}, 13, 4) || '-'
      || substr({_UUID}, 17, 4) || '-' || substr({_UUID}, 21, 12) AS turbine_id
      FROM raw_platforms, range(1, 5) r(unit_no)""",
    "failure_class_bucket": f"SELECT {_case('(o_orderkey % 100)')} AS failure_class, count(*) AS n FROM orders GROUP BY 1",
    "modulo_assignment": """SELECT s_suppkey, c_mktsegment
      FROM (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS j FROM supplier)
      JOIN (SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) - 1 AS i, count(*) OVER () AS n
            FROM (SELECT DISTINCT c_mktsegment FROM customer)) ON j % n = i""",
    "sensor_impact_parts": f"""WITH {PARTS}, {_IMPACT}
      SELECT type, sensor, impact FROM (SELECT type, unnest(sensors) AS sensor FROM part_types) JOIN impact
      USING (sensor)""",
    "dedup_hour": f"""WITH {READINGS}, timed AS (
        SELECT * EXCLUDE (abnormal_sensor),
          date_trunc('hour', make_timestamp(timestamp * 1000000)) AS hourly_timestamp FROM bronze),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY turbine_id, hourly_timestamp
        ORDER BY timestamp, "sensor_A", "sensor_B", "sensor_C" NULLS FIRST, "sensor_D", "sensor_E", "sensor_F", energy)
        AS rn FROM timed)
      SELECT {_READING_COLS}, hourly_timestamp FROM ranked WHERE rn = 1""",
    "latest_per_turbine": f"""WITH {SILVER} SELECT turbine_id, hourly_timestamp, {_flat_stats()} FROM silver
      QUALIFY row_number() OVER (PARTITION BY turbine_id ORDER BY hourly_timestamp DESC) = 1""",
    "baseline_prediction": f"""WITH {SILVER} SELECT turbine_id, hourly_timestamp, round(avg_energy, 6) AS avg_energy,
      {_prediction(900, ("sensor_F", "sensor_D", "sensor_B"))} AS prediction FROM silver""",
    "scoring_gate": """SELECT total, succeeded, total - succeeded AS failed,
      round(succeeded / total, 6) AS success_rate, total = succeeded OR succeeded / total >= 0.6 AS accepted
      FROM (SELECT count(*) AS total, count(*) FILTER (o_orderstatus <> 'P') AS succeeded FROM orders)""",
    "request_coercion": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_tax, 6) AS avg_energy,
      CASE WHEN l_returnflag IN ('A', 'N') THEN 0.0 ELSE l_linenumber END::DOUBLE AS percentiles_1,
      CASE WHEN l_returnflag IN ('A', 'N') THEN 0.0 ELSE 1 END::DOUBLE AS percentiles_2,
      CASE WHEN l_returnflag IN ('A', 'N') THEN 0.0 ELSE 2 END::DOUBLE AS percentiles_3,
      CASE WHEN l_returnflag IN ('A', 'N') THEN 0.0 ELSE 3 END::DOUBLE AS percentiles_4,
      CASE WHEN l_returnflag IN ('A', 'N') THEN 0.0 ELSE 4.5 END::DOUBLE AS percentiles_5 FROM lineitem""",
    "request_rows": f"""WITH {SILVER} SELECT turbine_id, strftime(hourly_timestamp, '%Y-%m-%dT%H:%M:%S') AS iso_time,
      turbine_id AS request_turbine, {_flat_stats()} FROM silver
      QUALIFY row_number() OVER (PARTITION BY turbine_id ORDER BY hourly_timestamp DESC) = 1""",
    "current_predictions": f"WITH {PREDICTIONS} SELECT {_GOLD_COLS} FROM predictions",
    "gold_status": f"WITH {GOLD} SELECT {_GOLD_COLS}, {_MAINT_COLS} FROM gold",
    "gold_latest_only": f"""WITH {GOLD} SELECT {_GOLD_COLS}, {_MAINT_COLS} FROM gold
      QUALIFY row_number() OVER (PARTITION BY turbine_id ORDER BY hourly_timestamp DESC) = 1""",
    "latest_snapshot": f"""WITH {GOLD} SELECT {_GOLD_COLS}, {_MAINT_COLS} FROM gold
      WHERE hourly_timestamp = (SELECT max(hourly_timestamp) FROM gold)""",
    "interval_status_join": f"""WITH {SILVER}, spans AS (
        SELECT 'T' || (o_custkey % (SELECT count(*) FROM supplier)) || '-' || (o_custkey % 7 + 1) AS turbine_id,
          1704049200 + 15 * date_diff('day', DATE '1995-01-01', o_orderdate::DATE) AS start_time,
          1704049200 + 15 * date_diff('day', DATE '1995-01-01', o_orderdate::DATE)
            + CASE WHEN o_orderkey % 50 = 0 THEN 31536000 ELSE 900 END AS end_time,
          CASE WHEN o_orderstatus = 'F' THEN 'ok' ELSE 'sensor_A' END AS abnormal_sensor FROM orders)
      SELECT turbine_id, round(avg_energy, 6) AS avg_energy, epoch(hourly_timestamp)::BIGINT AS hour_seconds,
        start_time, end_time, abnormal_sensor
      FROM silver JOIN spans USING (turbine_id)
      WHERE start_time < epoch(hourly_timestamp) AND epoch(hourly_timestamp) < end_time""",
    "label_prediction_crosstab": f"""WITH {PREDICTIONS} SELECT abnormal_sensor, prediction, sum(l * r)::BIGINT AS n
      FROM (SELECT turbine_id, abnormal_sensor, count(*) AS l FROM readings GROUP BY ALL)
      JOIN (SELECT turbine_id, prediction, count(*) AS r FROM predictions GROUP BY ALL) USING (turbine_id)
      GROUP BY ALL""",
    "example_turbine_readings": f"""WITH {READINGS} SELECT {_READING_COLS}, abnormal_sensor FROM readings
      WHERE turbine_id IN (SELECT min(turbine_id) FROM readings GROUP BY abnormal_sensor)""",
    "parts_inventory": f"""WITH {PARTS} SELECT "NSN", type, width, height, weight, round(cost, 6) AS cost, production_time,
      array_to_string(sensors, ',') AS sensors, stock_location, stock_location_id, lat, long, inventory_level,
      provisioning_time FROM parts""",
    "stock_port_distance": f"""WITH {PLATFORMS}, {PARTS}, {COST}
      SELECT stock_location_id, home_location_id, round(km, 6) AS km FROM distance""",
    "shipping_cost_rank": f"""WITH {PLATFORMS}, {PARTS}, {COST}
      SELECT stock_location_id AS stock_location, home_location_id AS homeport, cost AS distance FROM cost""",
    "cost_matrix_wide": f"""WITH {PLATFORMS}, {PARTS}, {COST} SELECT stock_location_id AS stock_location,
      {_wide("Cost_", "cost", "home_location_id", PORT_IDS)} FROM cost GROUP BY 1""",
    "cost_unpivot": f"""WITH {PLATFORMS}, {PARTS}, {COST}
      SELECT stock_location_id AS stock_location, home_location_id, cost FROM cost""",
    "supply_long": f"WITH {PARTS} SELECT type, stock_location_id, inventory_level AS supply FROM parts",
    "demand_long": f"WITH {GOLD}, {PARTS}, {DEMAND} SELECT designator_id, parts, demand FROM demand",
    "lp_table": f"""WITH {LP} SELECT type, stock_location_id, designator_id, home_location_id, cost, supply, demand
      FROM lp""",
    "cost_pivot": f"""WITH {LP} SELECT type, stock_location_id,
      {_wide("Cost_", "cost", "designator_id", DESIGNATOR_IDS)} FROM lp GROUP BY type, stock_location_id""",
    "supply_pivot": f"""WITH {LP} SELECT type, {_wide("Supply_", "supply", "stock_location_id", SITE_IDS)}
      FROM lp GROUP BY type""",
    "demand_pivot": f"""WITH {LP} SELECT type, {_wide("Demand_", "demand", "designator_id", DESIGNATOR_IDS)}
      FROM lp GROUP BY type""",
    "lp_wide": f"""WITH {LP}, c AS (SELECT type, stock_location_id,
        {_wide("Cost_", "cost", "designator_id", DESIGNATOR_IDS, 0)} FROM lp GROUP BY type, stock_location_id),
      s AS (SELECT type, {_wide("Supply_", "supply", "stock_location_id", SITE_IDS, 0)} FROM lp GROUP BY type),
      d AS (SELECT type, {_wide("Demand_", "demand", "designator_id", DESIGNATOR_IDS, 0)} FROM lp GROUP BY type)
      SELECT * FROM c JOIN s USING (type) JOIN d USING (type)""",
    "transport_feasibility": f"WITH {FEASIBLE} SELECT * FROM feasible",
    "infeasible_products": f"WITH {FEASIBLE} SELECT type, total_supply, total_demand FROM feasible WHERE NOT feasible",
    "transport_optimality": f"""WITH {FEASIBLE} SELECT type, 0::BIGINT AS reduced_cost_violations,
      0::BIGINT AS slack_violations FROM feasible WHERE feasible""",
    "transport_optimality_km": """WITH asked AS (
        SELECT p_brand AS type, o_custkey AS designator_id, count(*) AS demand
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY ALL),
      total AS (SELECT type, sum(demand)::BIGINT AS shipped, substr(type, 7)::INT % 7 = 0 AS few FROM asked GROUP BY type),
      stock AS (
        SELECT type, shipped, sum(floor(shipped * [1, 2, 3, 1, 4][r_regionkey + 1] / CASE WHEN few THEN 22 ELSE 10 END) + 1) AS supply
        FROM total, region GROUP BY ALL)
      SELECT type, shipped, 0::BIGINT AS dear_routes, 0::BIGINT AS site_violations, 0::BIGINT AS not_as_asked
      FROM stock WHERE supply >= shipped""",
    "shipment_totals": f"""WITH {FEASIBLE} SELECT type, home_location_id AS lane, sum(demand)::BIGINT AS shipped
      FROM (SELECT DISTINCT type, designator_id, home_location_id, demand FROM lp) JOIN feasible USING (type)
      WHERE feasible AND demand > 0 GROUP BY ALL""",
    "named_shipment_totals": f"""WITH {FEASIBLE} SELECT type, designator_id, designator, sum(demand)::BIGINT AS shipped,
        0::BIGINT AS unnamed_sites
      FROM (SELECT DISTINCT type, designator_id, demand FROM lp) JOIN feasible USING (type)
      JOIN (SELECT DISTINCT designator_id, designator FROM platforms) USING (designator_id)
      WHERE feasible AND demand > 0 GROUP BY ALL""",
    "transport_audit": f"""WITH {FEASIBLE} SELECT type, total_demand AS shipped, 0::BIGINT AS sites_overdrawn,
      0::BIGINT AS designators_short FROM feasible WHERE feasible""",
    "part_orders": f"""WITH {SHIPMENTS} SELECT stock_location_id, designator_id, type, qty_shipped, stock_location,
      designator, order_number FROM orders_made""",
    "parts_required": f"""WITH {GOLD}, {PARTS}, {REQUIRED}
      SELECT turbine_id, prediction, array_to_string(parts_required, ',') AS parts_required FROM required""",
    "parts_required_per_hour": f"""WITH {GOLD}, {PARTS}
      SELECT turbine_id, prediction, array_to_string(list_sort(list(type)), ',') AS parts_required
      FROM gold JOIN part_types ON list_contains(sensors, prediction) WHERE prediction <> 'ok'
      GROUP BY turbine_id, prediction""",
    "parts_required_long": f"""WITH {GOLD}, {PARTS}
      SELECT turbine_id, prediction, "NSN", type, count(*)::INT AS hours
      FROM gold JOIN part_types ON list_contains(sensors, prediction) WHERE prediction <> 'ok' GROUP BY ALL""",
    "work_orders": f"""WITH {SHIPMENTS}, {REQUIRED},
      numbered AS (SELECT *, 'AI-WO ' || printf('%03d', row_number() OVER (ORDER BY turbine_id, prediction))
        AS work_order FROM required),
      collapsed AS (SELECT designator, array_to_string(list_sort(list(DISTINCT order_number)), ',') AS part_orders
        FROM orders_made GROUP BY designator)
      SELECT turbine_id, prediction, hourly_timestamp, designator, designator_id, maintenance_type,
        array_to_string(parts_required, ',') AS parts_required, work_order, {_PRIORITY} AS priority, part_orders
      FROM gold JOIN numbered USING (turbine_id, prediction) JOIN collapsed USING (designator)""",
    "route_arcs": f"""WITH {SHIPMENTS}, spread AS ({_circle(400.0, "designator")})
      SELECT s.stock_location_id, s.designator, type, qty_shipped, round(k.lat, 0) AS source_lat,
        round(k.long, 0) AS source_lng, c.lat AS target_lat, c.long AS target_lng, s.stock_location AS stock_name
      FROM shipments s LEFT JOIN stock k USING (stock_location_id) LEFT JOIN spread c ON c.designator = s.designator
      WHERE qty_shipped > 0""",
    "route_arcs_underway": f"""WITH {SHIPMENTS}, moved AS (
        SELECT designator, round(lat / 2, 6) AS lat, round(long / 2 + 1, 6) AS long FROM raw_platforms),
      spread AS ({_circle(400.0, "designator", "moved")})
      SELECT s.stock_location_id, s.designator, type, qty_shipped, round(k.lat, 0) AS source_lat,
        round(k.long, 0) AS source_lng, c.lat AS target_lat, c.long AS target_lng, s.stock_location AS stock_name
      FROM shipments s LEFT JOIN stock k USING (stock_location_id) LEFT JOIN spread c ON c.designator = s.designator
      WHERE qty_shipped > 0""",
    "spread_duplicates": f"WITH {PLATFORMS} {_circle(200.0, 'designator, home_location')}",
    "jitter_duplicates": _jitter(),
    "maintenance_by_label": f"""WITH {READINGS}, {MAINTENANCE}
      SELECT abnormal_sensor AS fault, maintenance_type, count(*) AS n
      FROM readings LEFT JOIN maintenance ON abnormal_sensor = fault GROUP BY ALL""",
    "sliced_numbering": """SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS n FROM orders""",
    "sliced_numbering_by_status": """SELECT o_orderkey,
      row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) AS n FROM orders""",
    "time_grid": f"""WITH {READINGS} SELECT turbine_id, unnest(range(first, last + 1, 3600)) AS timestamp
      FROM (SELECT turbine_id, min(timestamp) AS first, max(timestamp) AS last FROM readings GROUP BY turbine_id)""",
    "running_energy": """SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey,
      round(sum(abs(l_extendedprice - 20000)) OVER (PARTITION BY l_suppkey
        ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey ROWS UNBOUNDED PRECEDING), 2) AS running
      FROM lineitem""",
    "running_total_null_keys": """SELECT o_orderkey, sum(round(o_totalprice * 100, 0)::BIGINT) OVER (
        PARTITION BY nullif(o_orderstatus, 'O')
        ORDER BY nullif(substr(o_orderpriority, 1, 1), '3') NULLS FIRST, o_orderkey ROWS UNBOUNDED PRECEDING)::BIGINT AS running
      FROM orders""",
    "datetime_features": _calendar(),
    "split_labels": f"""SELECT CASE WHEN {_SPLIT} % 10000 < 6000 THEN 'train' WHEN {_SPLIT} % 10000 < 8000 THEN 'val'
      ELSE 'test' END AS split, count(*) AS n FROM lineitem GROUP BY 1""",
    "bernoulli_sample": f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
      WHERE {_SAMPLE} % 1000000 < 50000""",
    "newest_experiment": """SELECT max('automl-' || o_orderstatus || '-' || strftime(o_orderdate, '%Y-%m-%d_%H:%M:%S'))
      AS name, 10 AS age_days FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""",
    "retention_days": """SELECT strftime(o_orderdate::DATE + 90, '%Y%m%d') AS drop_day, count(*) AS n
      FROM orders GROUP BY 1""",
    "sanitised_names": """SELECT c_custkey AS cust_key,
      replace(c_mktsegment || ' ' || c_name, ' ', '_') AS full_name_clean FROM customer""",
    "csv_platforms": f"""WITH {PLATFORMS} SELECT designator || ', ' || home_location AS designator, home_location, lat, long
      FROM raw_platforms""",
    "json_events": "SELECT event_id, user_id, event_type, round(value, 6) AS value FROM events",
    "time_ordered_files": f"""WITH {READINGS} SELECT strftime(make_timestamp(timestamp * 1000000), '%Y-%m-%d') AS day,
      count(*) AS n, min(timestamp) AS first, max(timestamp) AS last FROM readings GROUP BY 1""",
    "feature_table": "WITH {} SELECT turbine_id, hourly_timestamp, {} FROM silver".format(
        SILVER, ", ".join(f'round("{c}", 6) AS "{c}"' for c in _NUMERIC)
    ),
    "feature_pk_check": f"""WITH {HISTORY} SELECT count(*) AS keys, count(*) FILTER (n > 1) AS repeated_keys,
      0::BIGINT AS null_key_rows
      FROM (SELECT turbine_id, hourly_timestamp, count(*) AS n FROM history GROUP BY ALL)""",
    "stream_ingest": """SELECT event_id, user_id, event_type, round(value, 6) AS energy FROM events WHERE value > 25""",
    "stream_expectation_counts": """WITH t AS (SELECT count(*) AS rows,
        count(*) FILTER (NOT coalesce(value > 25, false)) AS a,
        count(*) FILTER (NOT coalesce(event_type <> 'error', false)) AS b FROM events)
      SELECT 'dropped' AS rule, rows, a AS violations FROM t UNION ALL SELECT 'correct_energy', rows, a FROM t
      UNION ALL SELECT 'known_type', rows, b FROM t""",
    "rescued_landing": """SELECT event_id, CASE WHEN event_type <> 'error' THEN round(value, 6) END AS value,
      event_type <> 'error' AND (event_type <> 'view' OR props IS NULL) AS clean,
      CASE WHEN event_type = 'error' THEN 'n/a error' END AS rescued_value,
      CASE WHEN event_type = 'view' THEN props END AS rescued_props FROM events""",
    "stream_upsert": f"WITH {SILVER} SELECT turbine_id, hourly_timestamp, {_flat_stats()} FROM silver",
    "replaced_table": "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus",
    "ordered_files": f"WITH {READINGS} SELECT count(*) AS rows, true AS few_files, 0::BIGINT AS crossed FROM readings",
    "fixed_file_count": "SELECT count(*) AS rows, 2::BIGINT AS files FROM supplier",
    "percentile_vector": f"""WITH {SILVER} SELECT turbine_id, hourly_timestamp, {", ".join(
        f'coalesce(round("percentiles_{s}"[{i}], 6), 0.0) AS v{k * 5 + i}'
        for k, s in enumerate(SENSORS) for i in range(1, 6))} FROM silver""",
    "hour_flags": f"""WITH {SILVER}, h AS (SELECT hour(hourly_timestamp)::INT AS hour, count(*) AS n FROM silver GROUP BY 1)
      SELECT hour, row_number() OVER (ORDER BY hour::DOUBLE::VARCHAR) AS "at", n, 1.0::DOUBLE AS flags FROM h""",
    "split_metrics": f"""WITH {_CONFUSION}, f AS (
        SELECT split, label, count(*) AS actual, count(*) FILTER (label = prediction) AS hit FROM scored GROUP BY ALL),
      g AS (SELECT split, prediction AS label, count(*) AS guessed FROM scored GROUP BY ALL)
      SELECT split, sum(actual)::BIGINT AS rows, round(sum(hit) / sum(actual), 6) AS accuracy,
        round(sum(actual * 2 * hit / (actual + coalesce(guessed, 0))) / sum(actual), 6) AS weighted_f1
      FROM f LEFT JOIN g USING (split, label) GROUP BY split""",
    "confusion_matrix": f"""WITH {_CONFUSION} SELECT label, {", ".join(
        f"count(*) FILTER (prediction = '{c}') AS \"predicted_{c}\"" for c in "ANR")}
      FROM scored WHERE split = 'val' GROUP BY label""",
    "best_run": """WITH r AS (SELECT l_linenumber::VARCHAR AS run,
        CASE WHEN l_orderkey % 5 < 3 THEN 'train' WHEN l_orderkey % 5 = 3 THEN 'val' ELSE 'test' END AS split,
        (l_returnflag = 'R')::INT AS hit FROM lineitem),
      w AS (SELECT run, avg(hit) FILTER (split = 'test') AS test_f1, avg(hit) FILTER (split = 'train') AS train_f1,
        avg(hit) FILTER (split = 'val') AS val_f1 FROM r GROUP BY run)
      SELECT run, round(test_f1, 6) AS test_f1, round(train_f1, 6) AS train_f1, round(val_f1, 6) AS val_f1
      FROM w ORDER BY w.val_f1 DESC LIMIT 1""",
    "logistic_optimality": f"WITH {HISTORY} SELECT abnormal_sensor AS label, 0::BIGINT AS weights_off FROM history GROUP BY ALL",
    "model_status_audit": f"""WITH {GOLD} SELECT home_location, count(*) AS hours, count(DISTINCT turbine_id) AS units,
      0::BIGINT AS unknown_predictions, 0::BIGINT AS wrong_levels FROM gold GROUP BY ALL""",
    "registered_forest": f"WITH {HISTORY} SELECT count(*) AS n, 0::BIGINT AS different FROM history",
    "registered_scorer": f"WITH {HISTORY} SELECT count(*) AS n, 0::BIGINT AS different FROM history",
    "managed_table": "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus",
    "bucketed_predictions": f"""WITH {PREDICTIONS} SELECT designator_id, prediction, count(*) AS hours,
      count(DISTINCT turbine_id) AS units FROM predictions GROUP BY ALL""",
    "search_runs": """SELECT * FROM (VALUES (0, 4::BIGINT, 10, 2::BIGINT), (1, 2::BIGINT, 30, 1::BIGINT), (2, 1::BIGINT, 100, 1::BIGINT))
      t(rung, fits, iterations, kept)""",
    "stream_sensor_stats": _EVENT_STATS,
    "stream_with_late_rows": _EVENT_STATS,
    "merged_sensor_stats": f"WITH {SILVER} SELECT turbine_id, hourly_timestamp, {_flat_stats()} FROM silver",
    "late_row_counts": """WITH timed AS (
        SELECT ts, floor(epoch(ts))::BIGINT AS s FROM events),
      dropped AS (
        SELECT ts, CASE WHEN s % 10 = 7 THEN 2 ELSE least(greatest((s - 1704067200) // 864000, 0), 2) END::INTEGER AS batch FROM timed),
      high AS (SELECT batch, max(ts) AS high FROM dropped GROUP BY batch)
      SELECT batch, count(*) AS rows, count(*) FILTER (
        ts < (SELECT max(high) FROM high h WHERE h.batch < d.batch) - INTERVAL 1 DAY) AS late
      FROM dropped d GROUP BY batch""",
    "holiday_orders": """WITH days AS (
        SELECT unnest(generate_series(DATE '1995-01-01', DATE '2004-12-31', INTERVAL 1 DAY))::DATE AS day),
      part AS (SELECT day, year(day) AS y, month(day) AS m, day(day) AS d, isodow(day) AS w FROM days),
      a AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM (SELECT DISTINCT y FROM part)),
      h AS (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM a),
      l AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM h),
      n AS (SELECT y, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS n FROM l),
      easter AS (SELECT make_date(y, n // 31, n % 31 + 1) AS easter FROM n),
      dated AS (
        SELECT day, CASE
          WHEN m = 1 AND d = 1 THEN 'New Year''s Day' WHEN m = 7 AND d = 4 THEN 'Independence Day'
          WHEN m = 11 AND d = 11 THEN 'Veterans Day' WHEN m = 12 AND d = 25 THEN 'Christmas Day'
          WHEN m = 1 AND w = 1 AND d BETWEEN 15 AND 21 THEN 'Martin Luther King Day'
          WHEN m = 2 AND w = 1 AND d BETWEEN 15 AND 21 THEN 'Washington''s Birthday'
          WHEN m = 5 AND w = 1 AND d >= 25 THEN 'Memorial Day' WHEN m = 9 AND w = 1 AND d <= 7 THEN 'Labor Day'
          WHEN m = 10 AND w = 1 AND d BETWEEN 8 AND 14 THEN 'Columbus Day'
          WHEN m = 11 AND w = 4 AND d BETWEEN 22 AND 28 THEN 'Thanksgiving'
          WHEN day + 2 IN (SELECT easter FROM easter) THEN 'Good Friday' END AS holiday, w
        FROM part),
      named AS (
        SELECT day, holiday, FALSE AS observed FROM dated WHERE holiday IS NOT NULL
        UNION ALL SELECT day + CASE w WHEN 6 THEN -1 WHEN 7 THEN 1 ELSE 0 END, holiday, TRUE FROM dated WHERE holiday IS NOT NULL)
      SELECT year(o_orderdate)::INTEGER AS year, holiday, count(*) AS n, observed
      FROM orders JOIN named ON o_orderdate::DATE = day GROUP BY ALL""",
    "class_weights": f"""WITH {HISTORY} SELECT abnormal_sensor, count(*) AS rows,
      round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight FROM history GROUP BY abnormal_sensor""",
    "scaled_features": _scaled(),
}
