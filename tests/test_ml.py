"""Model pipeline and metrics (M1-M11): fixed-seed fit on sf0.001 and
metric operators against MLlib's evaluators."""

import os

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from chainsight.functions import constants as K
from chainsight.operators import ml as M
from chainsight.plans import catalog_ml as CM

from .conftest import SF001


@pytest.fixture(scope="module")
def fitted(spark):
    train, test = CM.split(spark, SF001)
    model = M.fit(spark, train, params={"maxIter": 10})
    return model, train, test


def test_split_is_stable_and_complete(spark):
    train, test = CM.split(spark, SF001)
    frame = M.model_frame(CM.silver(spark, SF001))
    a, b, n = train.count(), test.count(), frame.count()
    assert a + b == n and 0.7 < a / n < 0.9
    train2, _ = CM.split(spark, SF001)
    assert train.exceptAll(train2).count() == 0


def test_predictions_table(spark, fitted):
    model, _, test = fitted
    pred = M.predictions_table(model, test)
    assert pred.count() == test.count()
    assert {"order_id", "market", "actual_risk", "predicted_risk", "probability", "late_probability"} <= set(pred.columns)
    bad = pred.where((F.col("late_probability") < 0) | (F.col("late_probability") > 1)).count()
    assert bad == 0
    assert {r.predicted_risk for r in pred.select("predicted_risk").distinct().collect()} <= {0.0, 1.0}


def test_feature_importances(spark, fitted):
    model, _, _ = fitted
    imp = M.feature_importances(spark, model).collect()
    assert [r.feature for r in imp] == K.FEATURE_COLS
    assert abs(sum(r.importance for r in imp) - 1.0) < 1e-9


def test_metrics_match_mllib(spark, fitted):
    model, _, test = fitted
    scored = model.transform(test).withColumn("p1", M.vector_to_array("probability")[1])
    ours = M.area_under_roc(scored, "label", "p1").first().auc
    mllib = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction",
                                          metricName="areaUnderROC").evaluate(scored)
    assert ours == pytest.approx(mllib, abs=1e-9)
    acc = M.accuracy_f1(scored).first()
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    assert acc.accuracy == pytest.approx(ev.setMetricName("accuracy").evaluate(scored), abs=1e-12)
    assert acc.f1 == pytest.approx(ev.setMetricName("f1").evaluate(scored), abs=1e-12)
    conf = M.confusion(scored).collect()
    assert sum(r["count"] for r in conf) == test.count()


def test_auc_with_ties_and_many_buckets(spark):
    rows = [(1.0, 0.9), (0.0, 0.9), (1.0, 0.5), (0.0, 0.1), (0.0, 0.5), (1.0, 0.7)]
    df = spark.createDataFrame(rows, "label double, score double")
    # positives 0.9, 0.5, 0.7 vs negatives 0.9, 0.1, 0.5:
    # 0.9: beats 0.1, 0.5, tie 0.9 -> 2.5; 0.5: beats 0.1, tie 0.5 -> 1.5; 0.7: beats 0.1, 0.5 -> 2
    got = M.auc_fraction(df, "label", "score", buckets=4).first()
    assert (got.auc_num2, got.auc_den2) == (12, 18)
    assert M.area_under_roc(df, "label", "score").first().auc == pytest.approx(6 / 9)


def test_exact_metric_strings(spark):
    counts = spark.createDataFrame([(20000, 9000, 10501, 300, 199)], "n long, tp long, tn long, fp long, fn long")
    frac = spark.createDataFrame([(39001, 40000)], "auc_num2 long, auc_den2 long")
    r = M.exact_metric_strings(counts, frac).first()
    assert r.model_accuracy == "0.9751"  # 19501/20000 = 0.97505 exactly -> half up
    assert r.model_auc == "0.9750"       # 0.975025
    assert r.model_f1.startswith("0.97")


def test_random_split_option(spark):
    frame = M.model_frame(CM.silver(spark, SF001))
    train, test = M.train_test_split(frame, method="random")
    n = frame.count()
    assert train.count() + test.count() == n and 0.7 < train.count() / n < 0.9


def test_metrics_without_rows_or_with_one_class(spark):
    schema = "label double, prediction double, score double"
    empty = spark.createDataFrame([], schema)
    r = M.accuracy_f1(empty).first()
    assert (r.accuracy, r.f1, r.n) == (None, None, 0)
    assert M.area_under_roc(empty).first().auc is None
    one = spark.createDataFrame([(1.0, 1.0, 0.7), (1.0, 0.0, 0.2)], schema)
    assert M.area_under_roc(one).first().auc is None and M.accuracy_f1(one).first().accuracy == 0.5
    per = M.score_counts(one, prediction="prediction")
    text = M.exact_metric_strings(M.confusion_from_score_counts(per), M.auc_fraction(one, per_score=per)).first()
    assert (text.model_auc, text.model_accuracy) == (None, "0.5000")


def test_rows_without_a_score_count(spark):
    df = spark.createDataFrame([(1.0, 1.0, 0.7), (0.0, 0.0, 0.2), (1.0, 0.0, None)],
                               "label double, prediction double, score double")
    counts = M.confusion_counts(df).first()
    assert tuple(counts) == tuple(M.confusion_from_score_counts(M.score_counts(df, prediction="prediction")).first())
    auc = M.area_under_roc(df).first()
    assert (counts.n, auc.auc, auc.positives, auc.unscored) == (3, 1.0, 1, 1)


@pytest.mark.parametrize("n", [4, 10**12, 10**14])
def test_f1_text_at_any_size(spark, n):
    counts = spark.createDataFrame([(n, n // 4, n // 4, n // 4, n // 4)], "n long, tp long, tn long, fp long, fn long")
    frac = spark.createDataFrame([(1, 2)], "auc_num2 long, auc_den2 long")
    assert tuple(M.exact_metric_strings(counts, frac).first()) == ("0.5000", "0.5000", "0.5000")


def made_rows(spark, distinct, copies):
    """Training rows of the model's input columns: ``distinct`` different ones, the i-th ``copies(i)`` times."""
    i = F.col("i")
    cols = {c: (i * (7 + 2 * k) % (5 + 6 * k)).cast("double") for k, c in enumerate(K.FEATURE_COLS) if c not in M.INDEXED.values()}
    cols["supplier_esg_score"] = i.cast("double")   # each row its own
    cols |= {"shipping_mode": F.concat(F.lit("m"), i % 4), "market": F.when(i % 13 > 0, F.concat(F.lit("k"), i % 3)),
             "label": ((F.xxhash64(i) % 5 + F.col("i") % 5) > 2).cast("double")}
    n = spark.createDataFrame([(k, copies(k)) for k in range(distinct)], "i long, n int")
    return n.select(F.explode(F.array_repeat("i", F.col("n"))).alias("i")).select("i", *[c.alias(k) for k, c in cols.items()])


def test_equal_rows_are_boosted_once_and_weigh_as_many(spark, monkeypatch):
    """Trees, scaling and indexes are those of the rows, but the 250 passes read the different rows only."""
    rows = made_rows(spark, 200, lambda k: 2000 if k == 5 else 1 + k % 50)   # few enough for thresholds from all rows; no equal gains
    want = M.risk_pipeline(params={"maxIter": 4, "maxDepth": 2}).fit(rows)
    read, fit = [], M.GBTClassifier.fit
    monkeypatch.setattr(M.GBTClassifier, "fit", lambda self, data, *a: (read.append(data.count()), fit(self, data, *a))[1])
    got = M.fit(spark, rows, params={"maxIter": 4, "maxDepth": 2}, partitions=3)
    assert rows.count() == 7094 and 200 < read[0] <= 250   # the heavy row comes as several
    (i, _, s, g), (j, _, t, h) = got.stages, want.stages
    assert i.labelsArray == j.labelsArray
    assert list(s.mean) == pytest.approx(list(t.mean)) and list(s.std) == pytest.approx(list(t.std))
    assert g.featureImportances.toArray() == pytest.approx(h.featureImportances.toArray(), abs=1e-9)
    scores = [{r.i: r.p for r in m.transform(rows).select("i", M.vector_to_array("probability")[1].alias("p")).collect()} for m in (got, want)]
    assert scores[0] == pytest.approx(scores[1], abs=1e-9)


def test_rows_that_are_hardly_equal_are_fitted_as_they_are(spark, monkeypatch):
    rows = made_rows(spark, 100, lambda k: 1 + k % 2)
    read, fit = [], M.GBTClassifier.fit
    monkeypatch.setattr(M.GBTClassifier, "fit", lambda self, data, *a: (read.append((data.count(), "_weight" in data.columns)), fit(self, data, *a))[1])
    M.fit(spark, rows, params={"maxIter": 1})
    assert read == [(150, False)]


def test_fitted_importance_boosts_no_more_rows_for_more_lines_alike(spark, tmp_dir, monkeypatch):
    """Orders of the same suppliers, customers and days: twice the lines, the same different rows."""
    span = spark.read.parquet(f"{SF001}/supplier.parquet").agg(2 * (F.max("s_suppkey") - F.min("s_suppkey")) + 1).first()[0]
    shift = span * (1 + spark.read.parquet(f"{SF001}/orders.parquet").agg(F.max("o_orderkey")).first()[0])
    read, seen = {}, M.merged_rows
    monkeypatch.setattr(M, "merged_rows", lambda rows: (read.setdefault(n, [rows.count()]), seen(rows))[1])

    def stop(self, data, *a):
        read[n].append(data.count())
        raise StopIteration
    monkeypatch.setattr(M.GBTClassifier, "fit", stop)
    for n in (4, 8):
        folder = f"{tmp_dir}/{n}"
        os.mkdir(folder)
        for t in os.listdir(SF001):
            key = {"orders.parquet": "o_orderkey", "lineitem.parquet": "l_orderkey"}.get(t)
            if key is None:
                os.symlink(f"{SF001}/{t}", f"{folder}/{t}")
            else:
                copies = spark.range(n).withColumnRenamed("id", "_k")
                spark.read.parquet(f"{SF001}/{t}").crossJoin(copies).withColumn(key, F.col(key) + F.col("_k") * shift) \
                    .drop("_k").write.parquet(f"{folder}/{t}")
        with pytest.raises(StopIteration):
            CM.q_fitted_importance(spark, folder)
    assert read[8][0] > 1.9 * read[4][0] and read[4][1] < read[4][0] / 2 and read[8][1] < 1.05 * read[4][1]


def test_weighted_rows_stand_for_every_row(spark):
    merged = spark.createDataFrame([("a", 1), ("b", 10), ("c", 11), (None, 995)], "k string, _rows long")
    w = M.weighted_rows(merged, 10)
    got = {r.k: (r.n, r.w, r.m) for r in w.groupBy("k").agg(F.count("*").alias("n"), F.sum("_weight").alias("w"), F.max("_weight").alias("m")).collect()}
    assert got == {"a": (1, 1, 1), "b": (1, 10, 10), "c": (2, 11, 10), None: (100, 995, 10)}


def test_metrics_from_score_counts_equal_those_of_the_rows(spark):
    schema = "label double, prediction double, score double"
    rows = [(1.0, 1.0, 0.9), (0.0, 1.0, 0.9), (1.0, 0.0, 0.2), (0.0, 0.0, 0.1), (0.0, None, None), (None, 1.0, 0.7), (1.0, 0.0, None)]
    for df in (spark.createDataFrame(rows * 3, schema), spark.createDataFrame([], schema)):
        per = M.score_counts(df, prediction="prediction")
        assert M.accuracy_f1(df, per_score=per).first() == M.accuracy_f1(df).first()
        assert M.area_under_roc(df, per_score=per).first() == M.area_under_roc(df).first()
