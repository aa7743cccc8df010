"""Model preparation, training, scoring and metrics.

Training is MLlib: ``StringIndexer`` -> ``VectorAssembler`` ->
``StandardScaler`` -> ``GBTClassifier`` in one ``Pipeline``.  The tree
learner aggregates split statistics level by level across executors; the
training frame is persisted (memory, spilling to disk) so the 50 boosting
rounds do not rescan the silver table, and when the session names a
checkpoint folder the boosting state is checkpointed every few rounds, so a
lost executor costs a few rounds, not the whole fit.

Metrics are plain aggregates over the prediction table (no collect): the
confusion counts give accuracy and support-weighted F1; the area under ROC is
a rank-sum computed with a distributed prefix sum over score buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainsight.functions import constants as K
from chainsight.functions import features as FX
from chainsight.functions.exact import ratio, text
from chainsight.operators import joins as J
from chainsight.session import ensure_checkpoint_dir

INDEXED = {"shipping_mode": "shipping_mode_idx", "market": "market_idx"}
# An order line's key: the split of every caller hashes it, and nothing else.
LINE_KEY = ("order_id", "line_number")


# F12, F13, N3, F19 ----------------------------------------------------------
def model_frame(silver: DataFrame) -> DataFrame:
    """Encodings, model fills and the double label.

    Integer columns take a fill truncated to int (``lead_time_days`` 14.0 ->
    14), as ``fillna`` does.
    """
    df = silver
    if "news_risk_level" in df.columns:
        df = df.withColumn("news_risk_numeric", FX.news_risk_numeric("news_risk_level"))
    if "logistics_risk_tier" in df.columns:
        df = df.withColumn("lpi_risk_numeric", FX.lpi_risk_numeric("logistics_risk_tier"))
    fills = {k: v for k, v in K.MODEL_DEFAULTS.items() if k in df.columns}
    df = df.fillna(fills) if fills else df
    return df.withColumn("label", FX.label("late_delivery_risk"))


# M4 -------------------------------------------------------------------------
def split_flag(cols: Sequence[str] = LINE_KEY, train_percent: int = K.TRAIN_PERCENT) -> Column:
    """True for training rows: the first 32 bits of the MD5 of the key's text, modulo
    100, so the split does not depend on partitioning, row order or engine
    (``randomSplit`` does); rows of one key land on the same side.  NULL parts of the
    key are left out."""
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % 100 < train_percent


def train_test_split(df: DataFrame, cols: Sequence[str] = LINE_KEY, train_percent: int = K.TRAIN_PERCENT,
                     seed: int = 42, method: str = "hash") -> tuple[DataFrame, DataFrame]:
    """80/20 split.  ``method="hash"`` (default) is the key-hash split;
    ``method="random"`` is ``randomSplit`` with a seed, whose rows
    depend on partitioning and row order (so it differs across layouts)."""
    if method == "random":
        train, test = df.randomSplit([train_percent / 100, 1 - train_percent / 100], seed=seed)
        return train, test
    flag = split_flag(cols, train_percent)
    return df.where(flag), df.where(~flag)


def train_only_route_rates(silver: DataFrame, folds: int = 5) -> DataFrame:
    """Silver with route statistics that hold no test outcome, and for a training row none
    of its own fold: out-of-fold rates of training rows (test rows are a fold of their own)."""
    train = split_flag()
    df = silver.withColumn("_fold", F.when(train, J.fold_of(folds, LINE_KEY)).otherwise(-1))
    return J.join_route_stats_out_of_fold(df, "_fold", known=F.col("_fold") >= 0).drop("_fold").select(*silver.columns)


# M1, M2, M3, M5 -------------------------------------------------------------
def indexer(cols: Sequence[str] = tuple(INDEXED)) -> StringIndexer:
    """M1: category -> index by descending frequency (ties alphabetical);
    unseen and NULL values -> one extra last index.  All columns are indexed
    by one estimator, i.e. one pass over the data."""
    return StringIndexer(inputCols=list(cols), outputCols=[INDEXED[c] for c in cols],
                         handleInvalid="keep", stringOrderType="frequencyDesc")


def indexers() -> list[StringIndexer]:
    return [indexer()]


def assembler(features: Sequence[str] = K.FEATURE_COLS) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features_raw", handleInvalid="keep")


def scaler() -> StandardScaler:
    return StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True)


def gbt(params: dict | None = None, checkpoint: bool = True) -> GBTClassifier:
    p = dict(K.GBT_PARAMS, **(params or {}))
    clf = GBTClassifier(labelCol="label", featuresCol="features", **p)
    if checkpoint:
        clf = clf.setCheckpointInterval(10)
    return clf


def risk_pipeline(features: Sequence[str] = K.FEATURE_COLS, params: dict | None = None,
                  checkpoint: bool = True) -> Pipeline:
    return Pipeline(stages=[*indexers(), assembler(features), scaler(), gbt(params, checkpoint)])


# M6 -------------------------------------------------------------------------
#: Equal training rows are merged where that leaves this many times fewer, at least.
MERGE_AT = 2
# A merged row stands for at most so many times the mean number of rows.
HEAVIEST = 4


def fit(spark: SparkSession, train: DataFrame, features: Sequence[str] = K.FEATURE_COLS,
        params: dict | None = None, partitions: int | None = None) -> PipelineModel:
    """Fit the pipeline on a persisted copy of the training rows' used columns.

    Each boosting level is one pass with one task per partition, 250 and more passes
    in all: ``partitions`` (default: as the input comes) deals the rows out once, one
    to three for each task slot of the cluster being a good number.

    The used columns are small numbers of the line and attributes of its route, state,
    supplier, mode and market, so the more lines there are, the more of them are equal.
    Where merging halves the rows (``MERGE_AT``), the trees are grown on the merged rows,
    each weighing as many as it stands for, which gives every node the sums that the rows
    give it; otherwise on the rows as they are.
    """
    has_ckpt = ensure_checkpoint_dir(spark) is not None
    cols = sorted(set(features) - set(INDEXED.values()) | set(INDEXED) | {"label"})
    rows = train.select(*cols)
    merged = merged_rows(rows).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n, distinct = merged.agg(F.coalesce(F.sum("_rows"), F.lit(0)), F.count(F.lit(1))).first()
        if n >= MERGE_AT * distinct > 0:
            return fit_merged(weighted_rows(merged, HEAVIEST * -(-n // distinct)), features, params, partitions, has_ckpt)
    finally:
        merged.unpersist()
    data = (rows.repartition(partitions) if partitions else rows).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return risk_pipeline(features, params, checkpoint=has_ckpt).fit(data)
    finally:
        data.unpersist()


def merged_rows(rows: DataFrame) -> DataFrame:
    """Each different row once, ``_rows`` being how often it occurs."""
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_rows"))


def weighted_rows(merged: DataFrame, heaviest: int) -> DataFrame:
    """``merged_rows`` with a ``_weight`` in place of ``_rows``; what occurs more than
    ``heaviest`` times comes as several rows, so that the learner's row sample for its
    thresholds meets it about as often as it would in the rows themselves."""
    piece = F.explode(F.sequence(F.lit(0), F.ceil(F.col("_rows") / heaviest).cast("int") - 1))
    return merged.withColumn("_piece", piece) \
        .withColumn("_weight", F.least(F.lit(heaviest), F.col("_rows") - F.col("_piece") * heaviest)).drop("_rows", "_piece")


def fit_merged(weighted: DataFrame, features: Sequence[str] = K.FEATURE_COLS, params: dict | None = None,
               partitions: int | None = None, checkpoint: bool = True) -> PipelineModel:
    """The pipeline of ``risk_pipeline`` from rows with a ``_weight``.  The indexer and the
    scaler know no weights: they read each row as often as it weighs."""
    data = (weighted.repartition(partitions) if partitions else weighted).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        every = data.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("_weight").cast("int")))).drop("_copy")
        *prepare, boosted = risk_pipeline(features, params, checkpoint).getStages()
        prepared = Pipeline(stages=prepare).fit(every)
        trees = boosted.setWeightCol("_weight").fit(prepared.transform(data))
        return PipelineModel(stages=[*prepared.stages, trees])
    finally:
        data.unpersist()


# M11 ------------------------------------------------------------------------
def predictions_table(model: PipelineModel, test: DataFrame) -> DataFrame:
    """Scored test rows; the probability vector is stored as ``array<double>``
    (readable by any Parquet/SQL reader) plus the late-class probability."""
    return scored_columns(model.transform(test).withColumn("probability", vector_to_array("probability")))


def scored_columns(scored: DataFrame) -> DataFrame:
    """The columns of a prediction table, from rows with ``prediction`` and ``probability`` (array)."""
    prob = F.col("probability")
    return scored.select(
        "order_id", "order_country", "order_region", "market", "shipping_mode", "delay_days",
        "is_delayed", F.col("late_delivery_risk").alias("actual_risk"),
        F.col("prediction").alias("predicted_risk"), prob,
        prob[1].alias("late_probability"), "supplier_risk_flag", "weather_risk_score", "lpi_score",
        "news_risk_level", "route_delay_rate",
    )


# M10 ------------------------------------------------------------------------
def feature_importances(spark: SparkSession, model: PipelineModel,
                        features: Sequence[str] = K.FEATURE_COLS) -> DataFrame:
    """(feature, importance) pairs: one row per model input (15), from the model."""
    gbt_model = model.stages[-1]
    values = gbt_model.featureImportances.toArray().tolist()
    rows = [(name, float(v)) for name, v in zip(features, values)]
    schema = T.StructType([T.StructField("feature", T.StringType()), T.StructField("importance", T.DoubleType())])
    return spark.createDataFrame(rows, schema)


# M9 -------------------------------------------------------------------------
def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return pred.groupBy(label, prediction).count().orderBy(label, prediction)


# M8 -------------------------------------------------------------------------
def confusion_counts(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    l, p = F.col(label), F.col(prediction)
    return pred.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((l == 1) & (p == 1)).alias("tp"),
        F.count_if((l == 0) & (p == 0)).alias("tn"),
        F.count_if((l == 0) & (p == 1)).alias("fp"),
        F.count_if((l == 1) & (p == 0)).alias("fn"),
    )


def accuracy_f1(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                per_score: DataFrame | None = None) -> DataFrame:
    """Accuracy and F1 weighted by class support (MLlib's ``f1``), from counts.

    Per-class F1 is written ``2tp / (2tp + fp + fn)``, which equals
    ``2PR / (P + R)`` and is 0 for a class that never occurs.  Both are NULL
    without rows.  ``per_score`` (from ``score_counts``, split by prediction) replaces
    the pass over the rows when given.
    """
    c = confusion_counts(pred, label, prediction) if per_score is None else confusion_from_score_counts(per_score, prediction)
    tp, tn, fp, fn, n = (F.col(x) for x in ("tp", "tn", "fp", "fn", "n"))
    f1_pos = F.coalesce(F.try_divide((2 * tp).cast("double"), (2 * tp + fp + fn).cast("double")), F.lit(0.0))
    f1_neg = F.coalesce(F.try_divide((2 * tn).cast("double"), (2 * tn + fn + fp).cast("double")), F.lit(0.0))
    w_pos = F.try_divide((tp + fn).cast("double"), n.cast("double"))
    w_neg = F.try_divide((tn + fp).cast("double"), n.cast("double"))
    return c.select(
        F.try_divide((tp + tn).cast("double"), n.cast("double")).alias("accuracy"),
        (w_neg * f1_neg + w_pos * f1_pos).alias("f1"),
        "n", "tp", "tn", "fp", "fn",
    )


def exact_metric_strings(counts: DataFrame, auc_frac: DataFrame, places: int = 4) -> DataFrame:
    """One row of text: ``model_auc``, ``model_accuracy``, ``model_f1``, each
    rounded half-up in decimal; NULL where undefined (no rows, one class only).

    F1 is formed from ratios of counts, so no number grows beyond the counts."""
    tp, tn, fp, fn, n = (F.col(x) for x in ("tp", "tn", "fp", "fn", "n"))
    zero = F.lit(0).cast("decimal(19,18)")
    f1 = (ratio(tp + fn, n) * F.coalesce(ratio(2 * tp, 2 * tp + fp + fn), zero)
          + ratio(tn + fp, n) * F.coalesce(ratio(2 * tn, 2 * tn + fn + fp), zero))
    acc = counts.select(text(ratio(tp + tn, n), places).alias("model_accuracy"), text(f1, places).alias("model_f1"))
    auc = auc_frac.select(text(F.try_divide(F.col("auc_num2").cast("double"), F.col("auc_den2").cast("double"))
                               .cast("decimal(19,15)"), places).alias("model_auc"))
    return acc.select(auc.select("model_auc").scalar().alias("model_auc"), "model_accuracy", "model_f1")


# M7 -------------------------------------------------------------------------
def score_counts(pred: DataFrame, label: str = "label", score: str = "score",
                 prediction: str | None = None) -> DataFrame:
    """Rows, positives and negatives per distinct score (NULL is one; and per
    prediction, if named): the one pass over a prediction table that both the
    confusion counts and the area under ROC can be read from."""
    keys = [score] + ([prediction] if prediction else [])
    return (pred.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(label) == 1).alias("pos"),
                 F.count_if(F.col(label) == 0).alias("neg")))


def confusion_from_score_counts(per: DataFrame, prediction: str = "prediction") -> DataFrame:
    """``confusion_counts`` (n, tp, tn, fp, fn) from ``score_counts(..., prediction)``."""
    p = F.col(prediction)

    def total(when: Column, what: str) -> Column:
        return F.coalesce(F.sum(F.when(when, F.col(what))), F.lit(0)).cast("long")
    return per.agg(
        total(F.lit(True), "rows").alias("n"),
        total(p == 1, "pos").alias("tp"),
        total(p == 0, "neg").alias("tn"),
        total(p == 1, "neg").alias("fp"),
        total(p == 0, "pos").alias("fn"),
    )


def auc_fraction(pred: DataFrame, label: str = "label", score: str = "score", buckets: int = 32,
                 per_score: DataFrame | None = None) -> DataFrame:
    """Area under ROC as an exact fraction ``auc_num2 / auc_den2``.

    AUC = P(score of a positive > score of a negative) + 1/2 P(tie), i.e. the
    rank-sum statistic with mid-ranks (the trapezoidal ROC area).  Rows are
    first reduced to one row per distinct score (partial aggregation, so a
    score shared by a third of all rows is one row).  Distinct scores are cut into
    ``buckets`` ranges at approximate quantiles; each range is ranked in its own task and
    reduced to one row, its positives, negatives and rank-sum, to which the negatives
    of all ranges below it are added (``buckets`` rows; their number bounds the
    parallelism, not the rows).  Rows without a score take no part; ``unscored`` says how
    many there are.
    ``per_score`` (from ``score_counts``) replaces the first pass when given.
    """
    s = F.col(score)
    if per_score is None:
        every = score_counts(pred, label, score)
    else:  # from score_counts, possibly split by prediction
        every = per_score.groupBy(score).agg(*[F.sum(c).alias(c) for c in ("rows", "pos", "neg")])
    probs = [i / buckets for i in range(1, buckets)]
    # the quantiles read all the columns that the ranks read, so that the counts run once for both
    counted = (F.col("rows") >= 0) & (F.col("pos") >= 0) & (F.col("neg") >= 0)
    bounds = every.agg(F.percentile_approx(F.when(counted, s), probs, 10_000)).scalar()
    # the row of the missing score stays, with nothing to rank
    scored = s.isNotNull()
    per = every.select(score, *[F.when(scored, F.col(c)).otherwise(0).alias(c) for c in ("pos", "neg")],
                       F.when(~scored, F.col("rows")).otherwise(0).alias("_unscored"), bounds.alias("_bounds")) \
        .withColumn("_bucket", F.size(F.filter("_bounds", lambda b: b < s))).drop("_bounds")
    inside = Window.partitionBy("_bucket").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("neg").over(inside), F.lit(0)).cast("decimal(38,0)")
    ranked = per.withColumn("_term", F.col("pos").cast("decimal(38,0)") * (2 * below + F.col("neg")))
    ranges = ranked.groupBy("_bucket").agg(F.sum("_term").alias("_term"), *[F.sum(c).alias(c) for c in ("pos", "neg", "_unscored")])
    before = Window.partitionBy().orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offset = F.coalesce(F.sum("neg").over(before), F.lit(0)).cast("decimal(38,0)")
    ranges = ranges.withColumn("_term", F.col("_term") + 2 * offset * F.col("pos").cast("decimal(38,0)"))
    out = ranges.agg(F.sum("_term").alias("auc_num2"), F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"),
                     F.coalesce(F.sum("_unscored"), F.lit(0)).alias("unscored"))
    return out.withColumn("auc_den2", F.lit(2).cast("decimal(38,0)") * F.col("positives") * F.col("negatives"))


def area_under_roc(pred: DataFrame, label: str = "label", score: str = "score",
                   per_score: DataFrame | None = None) -> DataFrame:
    """One row: ``auc`` (double; NULL where one class is missing), positives,
    negatives, unscored.  ``per_score`` as in ``auc_fraction``."""
    frac = auc_fraction(pred, label, score, per_score=per_score)
    return frac.select(F.try_divide(F.col("auc_num2").cast("double"), F.col("auc_den2").cast("double")).alias("auc"),
                       "positives", "negatives", "unscored")
