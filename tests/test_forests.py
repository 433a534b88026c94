import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from fleetwarden.functions.draws import unit
from fleetwarden.plans import forests
from fleetwarden.session import staged


def frame(spark, x, y, weight=None):
    rows = [(v.tolist(), float(c), float(w)) for v, c, w in zip(x, y, weight if weight is not None else np.ones(len(y)))]
    df = spark.createDataFrame(rows, "array array<double>, label double, weight double")
    return staged(df.select(array_to_vector("array").alias("features"), "label", "weight"))


@pytest.fixture(scope="module")
def data(spark):
    """Small whole-number features, so that all candidate splits are between the same values for everyone."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 12, (900, 5)).astype(float)
    y = ((x[:, 0] * 3 + x[:, 1] * 2 + (x[:, 2] > 5) * 7 + rng.integers(0, 9, 900)) // 14) % 3
    return x, y, frame(spark, x, y)


def predictions(df, forest):
    rows = forests.with_prediction(df, forest).select("features", "prediction").collect()
    return {tuple(r["features"].toArray()): r["prediction"] for r in rows}


def test_subtrees_from_tasks_make_the_tree_that_one_node_grows(spark, data):
    x, y, df = data
    whole = DecisionTreeClassifier(maxDepth=30, seed=1, weightCol="weight", maxBins=64).fit(df)
    nodes = forests.fit_deep(df, DecisionTreeClassifier(maxDepth=3, seed=1, weightCol="weight", maxBins=64), 30, bagged=False)
    forest = forests.node_arrays(nodes)
    got = predictions(df, forest)
    want = {tuple(r["features"].toArray()): r["prediction"] for r in whole.transform(df).collect()}
    differ = [k for k in want if got[k] != want[k]]
    assert len(got) == len(want) and len(differ) <= 0.01 * len(want)  # equal gains may be broken otherwise
    depth = nodes.where("node >= 4294967296").count()
    assert depth > 20 and nodes.groupBy("tree", "node").count().where("count > 1").isEmpty()
    # To the end: rows with equal features are the only ones that can be wrong.
    truth = {}
    for v, c in zip(x.tolist(), y):
        truth.setdefault(tuple(v), set()).add(c)
    assert all(got[k] in c for k, c in truth.items())


def test_subtrees_side_by_side_are_those_grown_alone():
    rng = np.random.default_rng(5)
    codes = rng.integers(0, 9, (600, 4)).astype(np.uint8)
    label = ((codes[:, 0] > 4) * 1 + (codes[:, 1] * codes[:, 2] > 20) + rng.integers(0, 2, 600)).astype(np.int64)
    weight = rng.integers(1, 4, 600).astype(float)
    root = rng.integers(0, 3, 600)
    depth, key = np.array([30, 2, 5]), np.array([11, 12, 13])

    def walk(tree, row, at):
        way = []
        while tree["feature"][at] >= 0:
            right = row[tree["feature"][at]] > tree["code"][at]
            at = tree["right" if right else "left"][at]
            way.append(bool(right))
        return way, tree["votes"][at].tolist()

    together = forests.grow(codes, root, label, weight, 4, depth, 2, key)
    for i in range(3):
        own = root == i
        alone = forests.grow(codes[own], np.zeros(own.sum(), int), label[own], weight[own], 4, depth[i : i + 1], 2, key[i : i + 1])
        for row in codes[own]:
            assert walk(together, row, i) == walk(alone, row, 0)
            assert len(walk(alone, row, 0)[0]) <= depth[i]
    assert together["rows"][:3].tolist() == np.bincount(root).tolist()


def test_best_split_against_every_split():
    rng = np.random.default_rng(6)
    for _ in range(40):
        n = int(rng.integers(2, 60))
        codes, label = rng.integers(0, 6, (n, 3)).astype(np.uint8), rng.integers(0, 3, n)
        weight = rng.integers(1, 4, n).astype(float)
        votes = np.bincount(label, weight, 3)[None, :]
        gini = lambda v: v.sum() - (v * v).sum() / v.sum()
        want = (0.0, 0, 0)
        for f in range(3):
            for c in range(6):
                low = np.bincount(label[codes[:, f] <= c], weight[codes[:, f] <= c], 3)
                if low.sum() and (votes[0] - low).sum():
                    gain = round((gini(votes[0]) - gini(low) - gini(votes[0] - low)) / votes.sum(), 9)
                    want = max(want, (gain, f, c), key=lambda g: g[0])
        gain, feature, code = forests._splits(codes, np.zeros(n, int), label, weight, votes, np.arange(3)[None, :])
        assert gain[0] == pytest.approx(want[0], abs=2e-9)
        if want[0] > 1e-8:
            assert (feature[0], code[0]) == want[1:]


@pytest.mark.parametrize("trees", [1, 12])
def test_node_arrays_score_like_the_library(spark, data, trees):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(500, 6))
    df = frame(spark, x, rng.integers(0, 4, 500), rng.random(500) + 0.2)
    kind = DecisionTreeClassifier(maxDepth=7, seed=4, weightCol="weight") if trees == 1 else RandomForestClassifier(
        numTrees=trees, maxDepth=7, seed=4, weightCol="weight"
    )
    model = kind.fit(df)
    forest = forests.node_arrays(forests.model_nodes(model))
    other = frame(spark, rng.normal(size=(700, 6)), np.zeros(700))
    want = {tuple(r["features"].toArray()): r["prediction"] for r in model.transform(other).collect()}
    assert predictions(other, forest) == want
    raw = model.transform(other).first()
    scores = forest.scores(raw["features"].toArray()[None, :])[0]
    assert np.allclose(scores / scores.sum(), raw["probability"].toArray())


def test_bagged_forest_repeats_itself_and_fits(spark, data):
    x, y, df = data
    kind = RandomForestClassifier(numTrees=8, maxDepth=3, seed=2, weightCol="weight")
    one, two = (forests.fit_deep(df.repartition(n), kind, 30) for n in (2, 5))
    local = lambda d: sorted(map(tuple, d.where("node >= 4294967296").drop("votes").collect()))
    assert len(local(one)) > 100
    shallow = forests.node_arrays(forests.model_nodes(kind.fit(df)))
    deep = forests.node_arrays(one)
    right = lambda f: np.mean(f.scores(x).argmax(axis=1) == y)
    assert right(deep) > right(shallow) + 0.05 and right(deep) > 0.9
    assert abs(right(forests.node_arrays(two)) - right(deep)) < 0.05


def test_large_leaves_are_grown_by_passes_first(spark, data, monkeypatch):
    _, _, df = data
    monkeypatch.setattr(forests, "TASK_ROWS", 60)
    kind = DecisionTreeClassifier(maxDepth=1, seed=1, weightCol="weight", maxBins=64)
    nodes = forests.fit_deep(df, kind, 30, bagged=False)
    top = nodes.where("node < 4294967296")
    assert top.count() > 40
    held = nodes.where("node >= 4294967296").agg(F.max("rows")).first()[0]
    assert held is not None and held <= 60
    whole = forests.fit_deep(df, DecisionTreeClassifier(maxDepth=4, seed=1, weightCol="weight"), 4)
    assert whole.where("node >= 4294967296").isEmpty()


def test_a_forest_beyond_a_task_is_refused(spark, data, monkeypatch):
    monkeypatch.setattr(forests, "MOST_NODES", 5)
    with pytest.raises(ValueError, match="scoring task"):
        forests.node_arrays(forests.model_nodes(DecisionTreeClassifier(maxDepth=5, weightCol="weight").fit(data[2])))


def test_draws_are_poisson_of_mean_one():
    key = np.arange(200_000) * 7919
    times = forests._draws(key, 3)
    assert abs(times.mean() - 1) < 0.01 and abs((times == 0).mean() - 0.3679) < 0.005 and abs(times.var() - 1) < 0.02
    assert abs(np.corrcoef(times, forests._draws(key, 4))[0, 1]) < 0.01
    assert 0 <= unit(key, 0).min() and unit(key, 0).max() < 1


def test_a_deep_forest_scores_without_being_held(spark, data, monkeypatch):
    x, _, df = data
    nodes = forests.fit_deep(df, RandomForestClassifier(numTrees=8, maxDepth=3, seed=2, weightCol="weight"), 30)
    held = forests.node_arrays(nodes)
    want = held.scores(x)
    monkeypatch.setattr(forests, "TASK_ROWS", 700)  # several shelves a tree
    # Only the upper levels may come to the driver.
    monkeypatch.setattr(forests, "MOST_NODES", nodes.where("node < 4294967296").count())
    assert nodes.count() > forests.MOST_NODES
    got = forests.with_deep_prediction(df, nodes).select("features", "prediction").collect()
    assert len(got) == len(x)
    by = {tuple(r["features"].toArray()): r["prediction"] for r in got}
    for row, scores in zip(x.tolist(), want):
        assert scores[int(by[tuple(row)])] >= scores.max() - 1e-8
    shallow = forests.fit_deep(df, RandomForestClassifier(numTrees=3, maxDepth=3, seed=2, weightCol="weight"), 3)
    assert predictions(df, forests.node_arrays(shallow)) == {
        tuple(r["features"].toArray()): r["prediction"] for r in forests.with_deep_prediction(df, shallow).collect()
    }


def test_counted_rows_split_like_sorted_ones():
    rng = np.random.default_rng(8)
    for classes in (2, 5):
        node = np.sort(rng.integers(0, 6, 3000))
        codes, label = rng.integers(0, 256, (3000, 4)).astype(np.uint8), rng.integers(0, classes, 3000)
        codes[:, 3] = 7  # a feature of one value splits nothing
        weight = rng.integers(1, 5, 3000).astype(float)
        votes = np.bincount(node * classes + label, weight, 6 * classes).reshape(6, classes)
        chosen = np.sort(np.argsort(rng.random((6, 4)), axis=1)[:, :3], axis=1)
        counted, ordered = (f(codes, node, label, weight, votes, chosen) for f in (forests._dense_splits, forests._sparse_splits))
        assert (counted[0] > 0).all()
        for a, b in zip(counted, ordered):
            assert a.tolist() == b.tolist()
        # Nodes of both kinds in any order.
        small = np.isin(node, [1, 4]) & (rng.random(3000) < 0.9)
        few = [x[~small] for x in (codes, node, label, weight)]
        held = np.bincount(few[1] * classes + few[2], few[3], 6 * classes).reshape(6, classes)
        assert len(set(forests._is_large(np.bincount(few[1]), classes))) == 2
        for a, b in zip(forests._splits(*few, held, chosen), forests._sparse_splits(*few, held, chosen)):
            assert a.tolist() == b.tolist()


def test_rows_of_a_shelf_travel_as_one_record():
    """Growth sends a record for each batch, tree and shelf, not one for each row and tree; no row is lost or repeated."""
    rng = np.random.default_rng(4)
    n, trees = 400, 6
    x, leaf, label = rng.normal(size=(n, 3)), rng.integers(0, 5, (n, trees)), rng.integers(0, 3, n)
    batch = pa.RecordBatch.from_pydict(
        {"features": x.tolist(), "leaf": leaf.tolist(), "label": label.astype(float), "weight": rng.random(n), "key": rng.integers(0, 1 << 60, n)}
    )
    edges = [np.sort(rng.normal(size=20)) for _ in range(3)]
    numbers, shelf = np.array([3, 8, 9, 12, 15]), np.array([0, -1, 1, 1, 0])
    open_ = forests.Open(numbers, [], numbers[shelf >= 0], shelf[shelf >= 0])
    sent = pa.Table.from_batches(forests._coded(edges, dict.fromkeys(range(trees), open_), False)(iter([batch])))
    assert sent.num_rows == 2 * trees
    for r in sent.to_pylist():
        rows = np.flatnonzero(shelf[leaf[:, r["tree"]]] == r["shelf"])
        key = np.frombuffer(r["key"], np.int64)
        order = np.argsort(key)
        rows = rows[np.argsort(batch.column("key").to_numpy()[rows])]
        assert key[order].tolist() == batch.column("key").to_numpy()[rows].tolist()
        assert np.frombuffer(r["leaf"], np.int64)[order].tolist() == numbers[leaf[rows, r["tree"]]].tolist()
        assert np.frombuffer(r["label"], np.int32)[order].tolist() == label[rows].tolist()
        codes = np.stack([np.searchsorted(e, x[rows, i]) for i, e in enumerate(edges)], axis=1)
        assert np.frombuffer(r["codes"], np.uint8).reshape(-1, 3)[order].tolist() == codes.tolist()
    packed = pa.Table.from_batches(forests._coded_rows(edges)(iter([batch.append_column("row", pa.array(np.arange(n)))])))
    assert packed.num_rows == 1 and len(packed.column("ids")[0].as_py()) == 8 * n


def test_blocks_of_rows_and_groups_of_trees_elect_what_the_whole_forest_does(spark, data, monkeypatch):
    x, _, df = data
    nodes = forests.fit_deep(df, RandomForestClassifier(numTrees=7, maxDepth=3, seed=5, weightCol="weight"), 30)
    scores = forests.node_arrays(nodes).scores(x)
    monkeypatch.setattr(forests, "TASK_ROWS", 250)  # blocks
    monkeypatch.setattr(forests, "SHELF_NODES", 40)  # shelves of a tree's nodes
    twice = df.unionByName(df)  # equal rows are rows of their own
    got = forests.with_deep_prediction(twice, nodes).select("features", "prediction").collect()
    assert len(got) == 2 * len(x)
    want = {tuple(v): np.flatnonzero(np.round(s, 9) == np.round(s, 9).max())[0] for v, s in zip(x.tolist(), scores)}
    differ = [r for r in got if r["prediction"] != want[tuple(r["features"].toArray())]]
    assert not differ
    none = forests.with_deep_prediction(df.limit(0), nodes)
    assert none.count() == 0
    alone = forests.fit_deep(df, DecisionTreeClassifier(maxDepth=3, seed=1, weightCol="weight"), 30, bagged=False)
    assert predictions(df, forests.node_arrays(alone)) == {
        tuple(r["features"].toArray()): r["prediction"] for r in forests.with_deep_prediction(df, alone).collect()
    }


def test_leaves_fill_shelves_evenly():
    rows = [900, 10, 500, 400, 0, 300, 299, 1]
    shelf = forests._shelved(rows, 800)
    held = np.bincount(shelf, rows)
    assert len(held) == 4 and held.max() == 900 and held.min() > 400
    assert forests._shelved([], 10).tolist() == []


def test_large_leaves_alone_get_passes_and_grow_as_in_one_task(spark, data, monkeypatch):
    """Counts of tasks split a large leaf as a task does that has all its rows; the forest is fitted once."""
    x, _, df = data
    fits = []
    fit = RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, *a, **k: fits.append(self.getMaxDepth()) or fit(self, *a, **k))
    kind = RandomForestClassifier(numTrees=4, maxDepth=2, seed=6, weightCol="weight")
    whole = forests.node_arrays(forests.fit_deep(df, kind, 30))
    monkeypatch.setattr(forests, "TASK_ROWS", 150)
    nodes = forests.fit_deep(df, kind, 30)
    assert fits == [2, 2]
    assert nodes.groupBy("tree", "node").count().where("count > 1").isEmpty()
    held = nodes.where("node >= 4294967296").agg(F.max("rows")).first()[0]
    assert held <= 150
    assert nodes.where("node < 4294967296").count() > 4 * 7
    passed = forests.node_arrays(nodes)
    assert np.allclose(whole.scores(x), passed.scores(x), atol=1e-9)
    by = {tuple(r["features"].toArray()): r["prediction"] for r in forests.with_deep_prediction(df, nodes).collect()}
    scores = np.round(passed.scores(x), 9)
    assert all(scores[i][int(by[tuple(v)])] == scores[i].max() for i, v in enumerate(x.tolist()))
