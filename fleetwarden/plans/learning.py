"""Fault classifiers with Spark ML."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import (
    Imputer,
    OneHotEncoder,
    StandardScaler,
    StandardScalerModel,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetwarden.functions.temporal import HOLIDAYS, calendar_features
from fleetwarden.operators.joins import join_dimension
from fleetwarden.operators.ranking import best_row
from fleetwarden.operators.reshape import pivot_prefixed
from fleetwarden.operators.sampling import with_split
from fleetwarden.operators.scoring import score_with_model
from fleetwarden.plans import forests
from fleetwarden.schemas import PERCENTILES, SENSORS
from fleetwarden.session import ship, staged

LABEL = "abnormal_sensor"
KEY = ["turbine_id", "hourly_timestamp"]
NUMERIC = ["avg_energy", *[f"std_{s}" for s in SENSORS]]
ARRAYS = [f"percentiles_{s}" for s in SENSORS]
CALENDAR = ["unix_ts", "is_weekend", "is_holiday"] + [
    f"{f}_{p}" for p in ("day", "week", "month", "year") for f in ("sin", "cos")
]
INPUTS = ["hourly_timestamp", *NUMERIC, *ARRAYS]
# Inverse regularisation and steps of the L1 logistic regression, seed and trees of the forest.
INVERSE_REGULARISATION = 18.487521995589663
ITERATIONS = 100
FOREST_SEED = 42
TREES = 100
#: Depth to which passes over all rows grow a forest, and the depth that the original's trees may reach.
DEPTH, FULL_DEPTH = 8, 30
#: Memory of one task's split statistics while a forest grows.
FOREST_MEMORY_MB = 1024
#: Rows beyond which the rows of a fit are dealt evenly to the cores; fewer stay as their files hold them.
DEALT_ROWS = 200_000


def prepared(stats: DataFrame) -> DataFrame:
    """Numbers as doubles, calendar columns and the concatenated percentile vector."""
    zeros = F.array_repeat(F.lit(0.0), len(PERCENTILES))
    numbers = {c: F.col(c).try_cast("double") for c in NUMERIC}
    vector = array_to_vector(F.concat(*[F.coalesce(F.col(a), zeros) for a in ARRAYS]))
    dated = calendar_features(stats, "hourly_timestamp").withColumns(numbers).withColumn("percentiles", vector)
    return dated.withColumns({c: F.col(c).cast("double") for c in CALENDAR + ["hour_of_day"]})


def with_labels(df: DataFrame, labels: list[str]) -> DataFrame:
    position = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(LABEL)) - 1
    return df.withColumn("label", position.cast("double"))


def known_labels(df: DataFrame, limit: int = 1000) -> list[str]:
    """The label set; more than `limit` classes is an error."""
    rows = df.select(LABEL).filter(F.col(LABEL).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} classes")
    return sorted(r[0] for r in rows)


def balancing_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Per class: rows and weight n / (classes x rows), so that all classes weigh the same."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    # The window spans one row per class.
    classes = W.partitionBy(F.lit(1))
    n, k = F.sum("rows").over(classes), F.count(F.lit(1)).over(classes)
    return counts.withColumn("weight", n / (k * F.col("rows")))


def many_rows(df: DataFrame) -> bool:
    return df.count() > DEALT_ROWS


def training_frame(stats: DataFrame, labels: list[str]) -> DataFrame:
    """Prepared rows with label number, split and balancing weight; the weights come from the training rows alone.

    The weights are one row a class. Many rows meet them where they lie: a shuffle by the few labels would leave most
    cores without rows.
    """
    marked = with_split(with_labels(prepared(stats), labels), KEY)
    weights = balancing_weights(marked.filter(F.col("split") == "train")).drop("rows")
    weights = F.broadcast(weights) if many_rows(stats) else weights
    return join_dimension(marked, weights, LABEL, "left").fillna(1.0, ["weight"])


def feature_stages(calendar: bool = True) -> list:
    numeric = [f"{c}_filled" for c in NUMERIC]
    stages = [
        Imputer(strategy="mean", inputCols=NUMERIC, outputCols=numeric),
        VectorAssembler(inputCols=numeric, outputCol="numeric_raw"),
        StandardScaler(withMean=True, inputCol="numeric_raw", outputCol="numeric"),
        StandardScaler(withMean=True, inputCol="percentiles", outputCol="percentiles_scaled"),
    ]
    blocks = ["numeric", "percentiles_scaled"]
    if calendar:
        stages += [
            VectorAssembler(inputCols=CALENDAR, outputCol="calendar_raw"),
            StandardScaler(withMean=True, inputCol="calendar_raw", outputCol="calendar"),
            StringIndexer(
                inputCol="hour_of_day", outputCol="hour_index", handleInvalid="keep", stringOrderType="alphabetAsc"
            ),
            OneHotEncoder(inputCols=["hour_index"], outputCols=["hour_flags"], dropLast=False),
        ]
        blocks += ["calendar", "hour_flags"]
    return [*stages, VectorAssembler(inputCols=blocks, outputCol="features")]


def logistic(frame: DataFrame, inverse_reg: float = INVERSE_REGULARISATION, iterations: int = ITERATIONS) -> LogisticRegression:
    """Multinomial logistic regression with an L1 penalty; the penalty is per training row."""
    rows = frame.filter(F.col("split") == "train").count()
    return LogisticRegression(
        family="multinomial",
        elasticNetParam=1.0,
        regParam=1.0 / (inverse_reg * max(rows, 1)),
        weightCol="weight",
        maxIter=iterations,
        standardization=False,
    )


def logistic_proof(fitted: LogisticRegressionModel, rows: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """Per class: whether the fitted weights are a least point of what the training minimises, found from the rows alone.

    The minimised sum is convex, so a point is least exactly if no weight can move downhill: the mean slope of the loss
    is 0 for an intercept, the penalty against the sign of a weight, and within the penalty for a weight of 0. `rows` are
    the training rows with features, label and weight. Slopes are summed in the tasks, one short list a class and Arrow
    batch; the columns are label, weights that are not 0, weights off by more than the tolerance, and the largest miss.
    """
    spark = rows.sparkSession
    ship(spark)
    weights, bias = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    classes, penalty = len(bias), fitted.getRegParam()
    if fitted.getElasticNetParam() != 1.0 or fitted.getStandardization():
        raise ValueError("the proof is for a plain L1 penalty")

    def slopes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            x = np.column_stack([np.stack(batch["x"].to_numpy()), np.ones(len(batch))])
            score = x @ np.column_stack([weights, bias]).T
            share = np.exp(score - score.max(axis=1, keepdims=True))
            share /= share.sum(axis=1, keepdims=True)
            share[np.arange(len(batch)), batch["label"].to_numpy(dtype=int)] -= 1.0
            w = batch["weight"].to_numpy(dtype=float)
            yield pd.DataFrame({"label": np.arange(classes), "slope": list((share * w[:, None]).T @ x), "w": w.sum()})

    plain = rows.select(vector_to_array("features").alias("x"), "label", "weight")
    parts = plain.mapInPandas(slopes, "label int, slope array<double>, w double")
    total = F.sum("w").alias("w")
    summed = parts.select("label", "w", F.posexplode("slope").alias("at", "slope")).groupBy("label", "at")
    points = [(k, j, float(v)) for k in range(classes) for j, v in enumerate([*weights[k], bias[k]])]
    found = summed.agg(F.sum("slope").alias("slope"), total).join(
        spark.createDataFrame(points, "label int, at int, value double"), ["label", "at"]
    )
    slope, value, last = F.col("slope") / F.col("w"), F.col("value"), F.col("at") == weights.shape[1]
    miss = (
        F.when(last, F.abs(slope))
        .when(value == 0, F.greatest(F.abs(slope) - penalty, F.lit(0.0)))
        .otherwise(F.abs(slope + penalty * F.signum(value)))
    )
    return found.groupBy("label").agg(
        F.count_if((value != 0) & ~last).alias("weights"),
        F.count_if(miss > tolerance).alias("off"),
        F.max(miss).alias("largest_miss"),
    )


def forest(trees: int = TREES, depth: int = DEPTH) -> RandomForestClassifier:
    # Deep levels have many nodes: the memory bound decides how many passes over the rows they take.
    return RandomForestClassifier(
        seed=FOREST_SEED, numTrees=trees, maxDepth=depth, maxMemoryInMB=FOREST_MEMORY_MB, cacheNodeIds=True
    )


def features(frame: DataFrame, calendar: bool = True) -> tuple[PipelineModel, DataFrame]:
    """The feature stages fitted on the training rows, and all rows with nothing but what a classifier needs, stored once.

    A fit passes over its rows many times, and a pass lasts as long as its largest task. Many rows are therefore dealt by
    their keys to one file a core; a forest then draws its bags from that deal.
    """
    stages = Pipeline(stages=feature_stages(calendar)).fit(frame.filter(F.col("split") == "train"))
    rows = stages.transform(frame)
    if many_rows(frame):
        rows = rows.repartition(frame.sparkSession.sparkContext.defaultParallelism, *KEY)
    return stages, staged(rows.select("features", "label", LABEL, "weight", "split"))


def train(frame: DataFrame, classifier, calendar: bool = True) -> PipelineModel:
    """A classifier fitted on the training rows, with its feature stages; forests go without the time columns."""
    stages, rows = features(frame, calendar)
    fitted = classifier.fit(rows.filter(F.col("split") == "train"))
    return PipelineModel(stages=[*stages.stages, fitted])


def compare(frame: DataFrame, labels: list[str], candidates: list[tuple]) -> DataFrame:
    """Metrics (run, split, ...) of candidates (run, classifier, with the time columns or not).

    Feature stages are fitted once for each kind of candidate, not once for each candidate.
    """
    ready = {calendar: features(frame, calendar)[1] for calendar in {c for _, _, c in candidates}}
    scored = []
    for run, classifier, calendar in candidates:
        rows = ready[calendar]
        model = PipelineModel(stages=[classifier.fit(rows.filter(F.col("split") == "train"))])
        scored.append(split_metrics(confusion(model, rows, labels)).withColumn("run", F.lit(run)))
    return staged(reduce(DataFrame.unionByName, scored))


def confusion(model: PipelineModel, frame: DataFrame, labels: list[str]) -> DataFrame:
    """Counts per split, label and prediction."""
    names = F.array(*[F.lit(x) for x in labels])
    # A model that stores the rows it scores is spared the columns that neither it nor the counts read.
    read = {"split", LABEL, "features", "percentiles", "hour_of_day", *NUMERIC, *CALENDAR}
    scored = model.transform(frame.select(*[c for c in frame.columns if c in read]))
    return scored.groupBy("split", F.col(LABEL).alias("label"), F.get(names, F.col("prediction").cast("int")).alias(
        "prediction"
    )).agg(F.count(F.lit(1)).alias("n"))


def confusion_wide(counts: DataFrame, labels: list[str], split: str = "val") -> DataFrame:
    chosen = counts.filter(F.col("split") == split)
    return pivot_prefixed(chosen, ["label"], "prediction", F.sum("n"), "predicted_", labels).fillna(0)


def split_metrics(counts: DataFrame) -> DataFrame:
    """Per split: rows, accuracy and class-weighted F1, from the confusion counts."""
    right = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    actual, guessed = W.partitionBy("split", "label"), W.partitionBy("split", "prediction")
    marked = counts.withColumns(
        {"hit": right, "actual": F.sum("n").over(actual), "guessed": F.sum("n").over(guessed)}
    )
    f1 = 2 * F.col("hit") / (F.col("actual") + F.col("guessed"))
    return marked.groupBy("split").agg(
        F.sum("n").alias("rows"),
        (F.sum("hit") / F.sum("n")).alias("accuracy"),
        (F.sum(F.when(F.col("hit") > 0, f1 * F.col("actual")).otherwise(0.0)) / F.sum("n")).alias("weighted_f1"),
    )


def search(frame: DataFrame, labels: list[str], inverse_regs: list[float]) -> DataFrame:
    """inverse_reg and its weighted F1: each strength is fitted on the training rows and judged on the validation rows."""
    runs = compare(frame, labels, [(str(c), logistic(frame, c), True) for c in inverse_regs])
    return runs.filter(F.col("split") == "val").select(
        F.col("run").cast("double").alias("inverse_reg"), F.col("weighted_f1").alias("f1")
    )


def successive_halving(
    frame: DataFrame, labels: list[str], inverse_regs: list[float], rungs: tuple[int, ...] = (10, 30, ITERATIONS), parallel: int = 4
) -> DataFrame:
    """One row (rung, iterations, inverse_reg, f1, kept) for each fit of a search.

    All strengths are fitted with the iterations of the first rung, and the better half by weighted F1 on the validation
    rows goes on to the next; ties keep the smaller strength. Feature stages are fitted and stored once. The fits of a
    rung are independent Spark jobs that run side by side, so a cluster is not idle while one fit waits for its last task.
    """
    spark = frame.sparkSession
    ready = features(frame)[1]
    train_rows = ready.filter(F.col("split") == "train")
    held = ready.filter(F.col("split") == "val")

    def fit(strength: float, iterations: int) -> float:
        model = PipelineModel(stages=[logistic(frame, strength, iterations).fit(train_rows)])
        return split_metrics(confusion(model, held, labels)).first()["weighted_f1"]

    alive, found = sorted(set(inverse_regs)), []
    for rung, iterations in enumerate(rungs):
        with ThreadPoolExecutor(parallel) as pool:
            # Threads of the pool work for this session and its job properties.
            scores = list(pool.map(inheritable_thread_target(spark)(lambda c: fit(c, iterations)), alive))
        ranked = sorted(zip(alive, scores), key=lambda r: (-r[1], r[0]))
        stay = ranked[: 1 if rung == len(rungs) - 1 else (len(ranked) + 1) // 2]
        found += [(rung, iterations, c, float(f1), (c, f1) in stay) for c, f1 in ranked]
        alive = sorted(c for c, _ in stay)
    return spark.createDataFrame(found, "rung int, iterations int, inverse_reg double, f1 double, kept boolean")


def runs_table(metrics: DataFrame) -> DataFrame:
    """One row per run with its F1 on each split, by the split's name; a run without a split has null there."""
    f1 = lambda split: F.max(F.when(F.col("split") == split, F.col("weighted_f1"))).alias(f"{split}_f1")
    return metrics.groupBy("run").agg(f1("test"), f1("train"), f1("val"))


def best_run(runs: DataFrame) -> DataFrame:
    return best_row(runs, "val_f1")


def score_status(model: PipelineModel, labels: list[str]):
    """A frame -> frame scorer for the gold table."""

    def score(df: DataFrame) -> DataFrame:
        wide = score_with_model(prepared(df), model, labels)
        return wide.select(*df.columns, "prediction")

    return score


@dataclass
class FlatForest:
    """Fitted feature stages and a forest as a table of nodes; transform adds the class number, as a pipeline does.

    Rows meet the nodes in tasks, so a forest of any size scores a table. A SQL function holds the whole forest as arrays
    (`forest`), which are collected when one is registered and bounded by forests.MOST_NODES.
    """

    stages: PipelineModel
    nodes: DataFrame

    @cached_property
    def forest(self) -> forests.NodeArrays:
        return forests.node_arrays(self.nodes)

    def transform(self, df: DataFrame) -> DataFrame:
        ready = self.stages.transform(df).select(*df.columns, "features")
        return forests.with_deep_prediction(ready, self.nodes)


def train_deep(frame: DataFrame, depth: int = FULL_DEPTH, trees: int = TREES) -> FlatForest:
    """A forest of the depth that the original has: passes over all rows to DEPTH, the rest of each subtree in a task."""
    stages, rows = features(frame, calendar=False)
    nodes = forests.fit_deep(rows.filter(F.col("split") == "train"), forest(trees, min(depth, DEPTH)), depth)
    return FlatForest(stages, nodes)


def _feature_numbers(stages: list) -> dict:
    """The numbers inside fitted feature stages, for scoring inside a SQL function."""
    fill = stages[0].surrogateDF.first()
    hours = [s.labels for s in stages if isinstance(s, StringIndexerModel)]
    return {
        "fill": np.array([fill[c] for c in NUMERIC]),
        "scalers": [(s.mean.toArray(), s.std.toArray()) for s in stages if isinstance(s, StandardScalerModel)],
        "hours": np.array([float(h) for h in hours[0]]) if hours else None,
    }


@dataclass
class Linear:
    weights: np.ndarray
    bias: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights.T + self.bias


def _scorer_of(model: PipelineModel | FlatForest) -> tuple[dict, Linear | forests.NodeArrays]:
    """(numbers of the feature stages, what gives one score a class from features)."""
    if isinstance(model, FlatForest):
        return _feature_numbers(model.stages.stages), model.forest
    *stages, classifier = model.stages
    if isinstance(classifier, LogisticRegressionModel):
        return _feature_numbers(stages), Linear(classifier.coefficientMatrix.toArray(), classifier.interceptVector.toArray())
    if isinstance(classifier, (RandomForestClassificationModel, DecisionTreeClassificationModel)):
        return _feature_numbers(stages), forests.node_arrays(forests.model_nodes(classifier))
    raise TypeError(f"no SQL function for a {type(classifier).__name__}")


def _calendar_matrix(ts: pd.Series) -> np.ndarray:
    """The CALENDAR columns of calendar_features for a batch of timestamps."""
    hour, day = ts.dt.hour, ts.dt.dayofweek
    year_hours = np.where(ts.dt.is_leap_year, 366, 365) * 24
    places = [
        (hour, 24), (day * 24 + hour, 168), ((ts.dt.day - 1) * 24 + hour, ts.dt.days_in_month * 24),
        ((ts.dt.dayofyear - 1) * 24 + hour, year_hours),
    ]
    seconds = (ts - pd.Timestamp(0)) // pd.Timedelta(seconds=1)
    columns = [seconds, day >= 5, ts.dt.strftime("%m-%d").isin(HOLIDAYS)]
    for place, period in places:
        angle = 2 * np.pi * place / period
        columns += [np.sin(angle), np.cos(angle)]
    return np.column_stack([np.asarray(c, dtype=float) for c in columns])


def feature_matrix(numbers: dict, ts: pd.Series, values: list[pd.Series], arrays: list[pd.Series]) -> np.ndarray:
    """The feature vectors of a batch, from the 14 input columns."""
    plain = np.column_stack([v.to_numpy(dtype=float, na_value=np.nan) for v in values])
    plain = np.where(np.isnan(plain), numbers["fill"], plain)
    zeros = np.zeros(len(PERCENTILES))
    lists = np.column_stack([np.stack([zeros if x is None else np.asarray(x, float) for x in a]) for a in arrays])
    raw = [plain, lists] if numbers["hours"] is None else [plain, lists, _calendar_matrix(ts)]
    blocks = []
    for block, (mean, std) in zip(raw, numbers["scalers"]):
        blocks.append((block - mean) * np.where(std > 0, 1 / np.where(std > 0, std, 1), 0.0))
    if numbers["hours"] is not None:
        place = {h: i for i, h in enumerate(numbers["hours"])}
        # An hour that training never saw has the last flag.
        flags = np.zeros((len(ts), len(place) + 1))
        flags[np.arange(len(ts)), [place.get(float(h), len(place)) for h in ts.dt.hour]] = 1.0
        blocks.append(flags)
    return np.hstack(blocks)


def register_scorer(spark: SparkSession, name: str, model: PipelineModel | FlatForest, labels: list[str]) -> None:
    """Register a fitted logistic, tree or forest model as a SQL function of the 14 INPUTS.

    Each Arrow batch is one matrix product, or one walk down all trees level by level.
    """
    ship(spark)
    names, split = np.array(labels, dtype=object), 1 + len(NUMERIC)
    held = spark.sparkContext.broadcast(_scorer_of(model))  # a matrix, or nodes within forests.MOST_NODES

    @F.pandas_udf("string")
    def scorer(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        numbers, classifier = held.value
        for columns in batches:
            if len(columns[0]):
                x = feature_matrix(numbers, columns[0], list(columns[1:split]), list(columns[split:]))
                yield pd.Series(names[classifier.scores(x).argmax(axis=1)])
            else:
                yield pd.Series([], dtype=object)

    spark.udf.register(name, scorer)


def publish(spark: SparkSession, model: PipelineModel, labels: list[str], folder: str, alias: str, run: str) -> None:
    """Store the fitted pipeline and point the alias at it; the alias table keeps one row per alias."""
    path = f"{folder}/models/{run}"
    model.write().overwrite().save(path)
    row = spark.createDataFrame([(alias, run, path, labels)], "alias string, run string, path string, labels array<string>")
    row.coalesce(1).write.mode("overwrite").parquet(f"{folder}/aliases/{alias}")


def published(spark: SparkSession, folder: str, alias: str) -> tuple[PipelineModel, list[str]]:
    entry = spark.read.parquet(f"{folder}/aliases/{alias}").first()
    return PipelineModel.load(entry["path"]), list(entry["labels"])
