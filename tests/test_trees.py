"""Trees written out as expressions and node rows, against MLlib's own model."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chainsight.functions import constants as K
from chainsight.operators import ml as M
from chainsight.operators import trees as TR
from chainsight.plans import catalog_ml as CM

from .conftest import SF001


@pytest.fixture(scope="module")
def fitted(spark):
    train, test = CM.split(spark, SF001)
    return M.fit(spark, train, params={"maxIter": 5, "maxDepth": 3}), train, test


def indexed(df, model):
    return TR.with_indexes(df, model, M.INDEXED)


def test_expression_scores_like_the_model(spark, fitted):
    model, _, test = fitted
    parts = TR.extract(model)
    odd = test.where("order_id % 40 = 0").withColumn("shipping_mode", F.lit("never seen")).withColumn("market", F.lit(None).cast("string")) \
        .withColumn("lpi_score", F.lit(None).cast("double"))
    rows = test.unionByName(odd)
    want = model.transform(rows).select(*M.LINE_KEY, "prediction", M.vector_to_array("probability")[1].alias("p")).collect()
    got = TR.score(indexed(rows, parts), parts).select(*M.LINE_KEY, "prediction", F.col("late_probability").alias("p")).collect()
    key = lambda r: (r.order_id, r.line_number, r.prediction, round(r.p, 9))
    assert sorted(map(key, want)) == sorted(map(key, got)) and len(got) > 1000


def test_stored_model_round_trip(tmp_dir, fitted):
    parts = TR.extract(fitted[0])
    parts.save(f"{tmp_dir}/m.json")
    assert TR.Ensemble.load(f"{tmp_dir}/m.json") == parts
    stored = CM.stored_model()
    assert stored.features == K.FEATURE_COLS and len(stored.weights) == 5 and max(len(stored.tree(i)) for i in range(5)) <= 15


def test_importances_equal_the_models(spark, fitted):
    model, train, _ = fitted
    parts = TR.extract(model)
    gains = TR.node_gains(TR.node_statistics(indexed(train, parts), parts), parts)
    got = {r.feature: r.importance for r in TR.importances(gains).collect()}
    want = dict(zip(K.FEATURE_COLS, model.stages[-1].featureImportances.toArray()))
    assert got == pytest.approx(want, abs=1e-9) and sum(got.values()) == pytest.approx(1)
    # every node has the rows that it was fitted on
    counts = {(r.tree, r.node): r["rows"] for r in TR.node_statistics(indexed(train, parts), parts).collect()}
    assert all(counts[i, 0] == train.count() for i in range(5))


def test_root_split_is_the_best_of_the_histogram(spark, fitted):
    model, train, _ = fitted
    parts = TR.extract(model)
    rows = TR.split_gains(TR.split_histogram(indexed(train, parts))).collect()
    best = max(rows, key=lambda r: r.gain)
    root = parts.tree(0)[0]
    assert best.feature == parts.features[root.feature]
    threshold = root.threshold / parts.scale[root.feature] + parts.mean[root.feature]
    assert best.threshold == pytest.approx(threshold, abs=1e-9)
    java = model.stages[-1].trees[0]._java_obj.rootNode()
    assert best.gain == pytest.approx(java.gain(), abs=1e-9)


def test_split_gains_against_all_cuts(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 12, 400).astype(float)
    y = (x + rng.normal(0, 3, 400) > 6).astype(int)
    df = spark.createDataFrame([(float(a), None, 1.0, int(b)) for a, b in zip(x, y)], "a double, b double, c double, label int")
    (row,) = TR.split_gains(TR.split_histogram(df, ["a", "b", "c"])).collect()   # b has no value, c but one

    def spread(v):
        return len(v) * np.var(2.0 * v - 1)
    values = np.unique(x)
    cuts = [(-(spread(y) - spread(y[x <= t]) - spread(y[x > t])) / len(y), t) for t in (values[:-1] + values[1:]) / 2]
    gain, threshold = min(cuts)
    assert row.feature == "a" and row.threshold == threshold and row.gain == pytest.approx(-gain)
    assert row.left_rows == (x <= threshold).sum() and row.left_rows + row.right_rows == 400


def test_no_rows(spark, fitted):
    parts = TR.extract(fitted[0])
    none = indexed(fitted[2].where("false"), parts)
    assert TR.score(none, parts).count() == 0 and TR.split_gains(TR.split_histogram(none)).count() == 0
    gains = TR.node_gains(TR.node_statistics(none, parts), parts)
    assert {r.importance for r in TR.importances(gains).collect()} == {0.0}
