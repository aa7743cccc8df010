"""Fitted trees as node rows and as expressions; audits of a training.

``extract`` takes a fitted pipeline apart: category indexes, scaling, and one row per
tree node.  From these

* ``score`` compiles the trees into nested conditions, so that a scored table is one
  projection inside generated code, with no model object in the tasks;
* ``node_statistics`` sends every row down every tree and adds up, for each node, the
  rows and the sums of the pseudo-residual that the tree was fitted to; node gains and
  feature importances follow from these sums, on whichever rows they are wanted;
* ``split_gains`` finds each feature's best first split from a (feature, cell)
  histogram of label sums.

Everything that grows with the rows is a partial and final aggregation over at most
(trees x nodes) or (features x cells) groups.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainsight.functions import constants as K


@dataclass(frozen=True)
class Node:
    """``feature`` is None in a leaf; rows with a value up to ``threshold`` (scaled) go left."""

    tree: int
    node: int
    left: int | None
    right: int | None
    feature: int | None
    threshold: float | None
    value: float


@dataclass(frozen=True)
class Ensemble:
    """A boosted classifier of two classes: margin = sum of weight x tree."""

    features: list[str]
    mean: list[float]
    scale: list[float]
    indexes: dict[str, list[str]]   # category column -> its values by index; others come last
    weights: list[float]
    nodes: list[Node]

    def save(self, path: str) -> None:
        with open(path, "w", encoding="utf-8") as f:
            head = {k: v for k, v in asdict(self).items() if k != "nodes"}
            rows = ",\n  ".join(json.dumps(asdict(n)) for n in self.nodes)
            f.write(json.dumps(head, indent=1)[:-2] + ',\n "nodes": [\n  ' + rows + "\n ]\n}\n")

    @staticmethod
    def load(path: str) -> "Ensemble":
        with open(path, encoding="utf-8") as f:
            read = json.load(f)
        return Ensemble(**{**read, "nodes": [Node(**n) for n in read["nodes"]]})

    def tree(self, number: int) -> dict[int, Node]:
        return {n.node: n for n in self.nodes if n.tree == number}


def extract(model: PipelineModel, features: Sequence[str] = K.FEATURE_COLS) -> Ensemble:
    """The parts of a pipeline of indexer, assembler, scaler and boosted trees."""
    indexer, _, scaler, gbt = model.stages
    indexes = dict(zip(indexer.getInputCols(), (list(x) for x in indexer.labelsArray)))
    nodes: list[Node] = []

    def walk(tree: int, java, number: int) -> int:
        """Adds a node and what is below it, numbered from ``number`` on; the next free number."""
        if java.subtreeDepth() == 0:
            nodes.append(Node(tree, number, None, None, None, None, float(java.prediction())))
            return number + 1
        split = java.split()
        if not hasattr(split, "threshold") or "Continuous" not in split.getClass().getSimpleName():
            raise ValueError("only splits at a threshold can be written out")
        at = len(nodes)
        nodes.append(None)
        right = walk(tree, java.leftChild(), number + 1)
        after = walk(tree, java.rightChild(), right)
        nodes[at] = Node(tree, number, number + 1, right, int(split.featureIndex()), float(split.threshold()),
                         float(java.prediction()))
        return after

    for i, tree in enumerate(gbt.trees):
        walk(i, tree._java_obj.rootNode(), 0)
    deviations = scaler.std.toArray().tolist()
    return Ensemble(list(features), scaler.mean.toArray().tolist(), [1 / s if s else 0.0 for s in deviations],
                    indexes, [float(w) for w in gbt.treeWeights], nodes)


# --------------------------------------------------------------------------
# Scoring

def with_indexes(df: DataFrame, model: Ensemble, indexed: dict[str, str]) -> DataFrame:
    """Category index columns (``indexed``: category -> index column), as the model numbers them."""
    def index(column: str) -> Column:
        known = model.indexes[column]
        found = F.array_position(F.array(*[F.lit(v) for v in known]), F.col(column)) - 1
        return F.when(found >= 0, found).otherwise(len(known)).cast("double")
    return df.withColumns({out: index(c) for c, out in indexed.items()})


def goes_left(model: Ensemble, node: Node) -> Column:
    j = node.feature
    value = F.coalesce(F.col(model.features[j]).cast("double"), F.lit(float("nan")))
    return (value - model.mean[j]) * model.scale[j] <= F.lit(node.threshold)


def tree_value(model: Ensemble, number: int) -> Column:
    """One tree as nested conditions."""
    nodes = model.tree(number)

    def below(n: int) -> Column:
        node = nodes[n]
        if node.feature is None:
            return F.lit(node.value)
        return F.when(goes_left(model, node), below(node.left)).otherwise(below(node.right))
    return below(0)


def margins(model: Ensemble) -> list[Column]:
    """Margin before each tree, and after the last."""
    out = [F.lit(0.0)]
    for i, w in enumerate(model.weights):
        out.append(out[-1] + F.lit(w) * tree_value(model, i))
    return out


def score(df: DataFrame, model: Ensemble) -> DataFrame:
    """``df`` (with the model's feature columns) and ``prediction``, ``late_probability``."""
    df = df.withColumn("_margin", margins(model)[-1])
    return df.withColumn("late_probability", 1 / (1 + F.exp(-2 * F.col("_margin")))) \
        .withColumn("prediction", F.when(F.col("_margin") > 0, 1.0).otherwise(0.0)).drop("_margin")


# --------------------------------------------------------------------------
# Audits

def node_statistics(df: DataFrame, model: Ensemble, label: str = "label") -> DataFrame:
    """(tree, node, rows, total, squares) over the rows that reach each node: sums of what
    the tree is fitted to, the label as -1 or 1 for the first tree, then the pseudo-residual
    4y / (1 + exp(2 y margin)) of the margin before it."""
    y = F.when(F.col(label) == 1, 1.0).otherwise(-1.0)
    before = margins(model)

    def path(number: int) -> Column:
        nodes = model.tree(number)

        def below(n: int, above: tuple[int, ...]) -> Column:
            node, here = nodes[n], (*above, n)
            if node.feature is None:
                return F.array(*[F.lit(i) for i in here])
            return F.when(goes_left(model, node), below(node.left, here)).otherwise(below(node.right, here))
        return below(0, ())

    fitted = [y if i == 0 else 4 * y / (1 + F.exp(2 * y * before[i])) for i in range(len(model.weights))]
    trees = F.array(*[F.struct(F.lit(i).alias("tree"), fitted[i].alias("target"), path(i).alias("path"))
                      for i in range(len(model.weights))])
    return (df.select(F.explode(trees).alias("t")).select("t.tree", "t.target", F.explode("t.path").alias("node"))
            .groupBy("tree", "node").agg(F.count(F.lit(1)).alias("rows"), F.sum("target").alias("total"),
                                         F.sum(F.col("target") * F.col("target")).alias("squares")))


def node_gains(statistics: DataFrame, model: Ensemble) -> DataFrame:
    """(tree, node, feature, rows, gain) of every split: the variance that it takes away."""
    spark = statistics.sparkSession
    splits = spark.createDataFrame(
        [(n.tree, n.node, n.left, n.right, model.features[n.feature]) for n in model.nodes if n.feature is not None],
        "tree int, node int, left int, right int, feature string")
    spread = F.coalesce(F.col("squares") - F.col("total") * F.col("total") / F.col("rows"), F.lit(0.0))  # rows x variance
    s = statistics.select("tree", "node", "rows", spread.alias("spread"))

    def child(side: str) -> DataFrame:
        return s.select("tree", F.col("node").alias(side), F.col("spread").alias(f"{side}_spread"))
    return (splits.join(s, ["tree", "node"]).join(child("left"), ["tree", "left"], "left").join(child("right"), ["tree", "right"], "left")
            .select("tree", "node", "feature", "rows",
                    ((F.col("spread") - F.coalesce("left_spread", F.lit(0.0)) - F.coalesce("right_spread", F.lit(0.0)))
                     / F.col("rows")).alias("gain")))


def importances(gains: DataFrame, features: Sequence[str] = K.FEATURE_COLS) -> DataFrame:
    """(feature, importance): share of rows x gain over all splits; 0 for features without one."""
    every = gains.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    sums = gains.groupBy("feature").agg(F.sum(F.col("rows") * F.col("gain")).alias("weight"))
    total = gains.agg(F.sum(F.col("rows") * F.col("gain"))).scalar()
    return every.join(sums, "feature", "left").select(
        "feature", F.coalesce(F.try_divide("weight", total), F.lit(0.0)).alias("importance"))


def split_histogram(df: DataFrame, features: Sequence[str] = K.FEATURE_COLS, label: str = "label",
                    cells: int = 1024) -> DataFrame:
    """(feature, cell, rows, late, low, high): each feature's range in ``cells`` equal cells, with
    the rows, late rows, smallest and largest value of every cell that has rows.

    Features with few values (codes, days, grades) get a cell for each value."""
    number = [F.col(f).cast("double") for f in features]
    ends = df.agg(F.array(*[F.struct(F.min(c).alias("low"), F.max(c).alias("high")) for c in number])).scalar()
    each = F.arrays_zip(F.array(*[F.lit(f) for f in features]).alias("feature"), F.array(*number).alias("value"),
                        ends.alias("ends"))
    long = df.select((F.col(label) == 1).cast("long").alias("late"), F.explode(each).alias("x")) \
        .select("late", "x.feature", "x.value", "x.ends.low", "x.ends.high").where("value IS NOT NULL AND high > low")
    cell = F.least(F.floor((F.col("value") - F.col("low")) / (F.col("high") - F.col("low")) * cells), F.lit(cells - 1))
    return long.groupBy("feature", cell.cast("int").alias("cell")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("late").alias("late"), F.min("value").alias("low"), F.max("value").alias("high"))


def split_gains(histogram: DataFrame) -> DataFrame:
    """(feature, threshold, gain, left_rows, right_rows): each feature's best split between two
    cells, by the variance of the label (-1, 1) that it takes away; of equal ones the lowest."""
    every = Window.partitionBy("feature")  # at most as many rows as a feature has cells
    order = every.orderBy("cell")
    sums = histogram.select(
        "feature", "high", F.lead("low").over(order).alias("next"),
        F.sum("rows").over(order).alias("n"), F.sum("late").over(order).alias("p"),
        F.sum("rows").over(every).alias("all_n"), F.sum("late").over(every).alias("all_p"))

    def spread(n: Column, p: Column) -> Column:
        return 4 * p.cast("double") * (n - p).cast("double") / n.cast("double")  # rows x variance
    n, p, m, q = F.col("n"), F.col("p"), F.col("all_n"), F.col("all_p")
    gain = (spread(m, q) - spread(n, p) - spread(m - n, q - p)) / m.cast("double")
    cuts = sums.where("next IS NOT NULL").select(
        "feature", ((F.col("high") + F.col("next")) / 2).alias("threshold"), gain.alias("gain"),
        n.alias("left_rows"), (m - n).alias("right_rows"))
    best = cuts.groupBy("feature").agg(F.max_by(F.struct("threshold", "gain", "left_rows", "right_rows"),
                                                F.struct("gain", -F.col("threshold"))).alias("b"))
    return best.select("feature", "b.*")
