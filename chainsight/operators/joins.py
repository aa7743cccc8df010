"""Enrichment joins.

All joins are left outer equi-joins from the order-line fact, so the fact's
row count is kept whenever the right key is unique.

The joins carry no hints: Spark measures each dimension, and each aggregated
side, in bytes while the query runs (AQE), broadcasts it where it is under the
session's threshold, and otherwise shuffles both sides and splits skewed fact
partitions.  Global scalars (J5) are attached as scalar subqueries, so nothing
goes through the driver and no cross join is planned.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from chainsight.functions import constants as K
from chainsight.functions import features as FX
from chainsight.functions.exact import exact_mean, exact_ratio


# J1 -------------------------------------------------------------------------
SUPPLIER_COLUMNS = {
    "supplier_name": "supplier_name",
    "tier": "supplier_tier",
    "region": "supplier_region",
    "country_code": "supplier_country_code",
    "lead_time_days": "lead_time_days",
    "quality_score": "supplier_quality_score",
    "esg_score": "supplier_esg_score",
    "risk_notes": "supplier_risk_notes",
}


def supplier_keyed(suppliers: DataFrame) -> DataFrame:
    """Supplier dimension with its numeric key (F17) and renamed attributes."""
    cols = [FX.supplier_number("supplier_id").alias("sup_key")]
    cols += [F.col(src).alias(dst) for src, dst in SUPPLIER_COLUMNS.items() if src in suppliers.columns]
    return suppliers.select(*cols)


def supplier_range(keyed: DataFrame) -> tuple[Column, Column]:
    """(min, max - min + 1) of supplier numbers (G12), from one scalar subquery."""
    rng = keyed.agg(F.struct(F.min("sup_key").alias("low"),
                             (F.max("sup_key") - F.min("sup_key") + 1).alias("span"))).scalar()
    return rng.getField("low"), rng.getField("span")


def join_suppliers(fact: DataFrame, suppliers: DataFrame, order_col: str = "order_id",
                   seen: Observation | None = None) -> DataFrame:
    """Give every order line a supplier by ``pmod(order_id, span) + min``.

    Supplier columns already on the fact are replaced (drop-if-present).
    """
    keyed = supplier_keyed(suppliers)
    low, span = supplier_range(keyed)
    fact = fact.drop(*[c for c in SUPPLIER_COLUMNS.values() if c in fact.columns])
    fact = fact.withColumn("_supplier_join_key", FX.supplier_assignment(order_col, low, span))
    out = fact.join(keyed, fact["_supplier_join_key"] == keyed["sup_key"], "left")
    return seen_after(out, "sup_key", seen).drop("_supplier_join_key", "sup_key")


# J2 -------------------------------------------------------------------------
def country_side(scores: DataFrame) -> DataFrame:
    return scores.select(
        FX.clean_key("country").alias("_lpi_country"),
        "lpi_score", "logistics_risk_tier", "infrastructure_score", "timeliness_score",
    )


def join_country_scores(fact: DataFrame, scores: DataFrame, country_col: str = "order_country",
                        seen: Observation | None = None) -> DataFrame:
    """Order country -> logistics scores on trimmed, case-sensitive names,
    then F5 from the order country's tier (before any default is filled)."""
    dim = country_side(scores)
    out = fact.join(dim, FX.clean_key(country_col) == dim["_lpi_country"], "left")
    out = seen_after(out, "_lpi_country", seen).drop("_lpi_country")
    return out.withColumn("supplier_risk_flag", FX.supplier_risk_flag("logistics_risk_tier"))


# J3 -------------------------------------------------------------------------
def storm_stats_by_state(weather: DataFrame) -> DataFrame:
    """G2 keyed by the normalised state, so two spellings of one state merge."""
    return (weather.groupBy(FX.clean_upper_key("state").alias("state_key"))
            .agg(exact_mean("severity_score", 2).alias("weather_risk_score"),
                 F.count("event_id").alias("storm_event_count"),
                 F.count_if(F.col("severity_score") >= K.SEVERE_STORM_AT).alias("high_critical_storm_count")))


def join_weather(fact: DataFrame, weather: DataFrame, state_col: str = "customer_state",
                 seen: Observation | None = None) -> DataFrame:
    """J3 + N1: customer state -> storm statistics; misses take the defaults."""
    stats = storm_stats_by_state(weather)
    out = fact.join(stats, FX.clean_upper_key(state_col) == stats["state_key"], "left")
    out = seen_after(out, "state_key", seen).drop("state_key")
    return out.fillna(K.WEATHER_DEFAULTS)


# J4 / G3 --------------------------------------------------------------------
ROUTE_KEYS = ("order_country", "order_region", "shipping_mode")


def route_stats(fact: DataFrame, keys: Sequence[str] = ROUTE_KEYS) -> DataFrame:
    """Per-route delay rate, mean delay and line count (unrounded).

    Partial aggregation runs before the shuffle, so a hot route costs one
    partial row per task, not its raw rows.
    """
    return (fact.groupBy(*keys)
            .agg(F.avg("is_delayed").alias("route_delay_rate"),
                 F.avg("delay_days").alias("route_avg_delay_days"),
                 F.count("order_id").alias("route_order_count")))


def route_side(source: DataFrame, keys: Sequence[str] = ROUTE_KEYS) -> DataFrame:
    """Route statistics with key columns renamed for the join back to lines."""
    return route_stats(source, keys).select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                                            "route_delay_rate", "route_avg_delay_days", "route_order_count")


def join_route_stats(fact: DataFrame, keys: Sequence[str] = ROUTE_KEYS,
                     source: DataFrame | None = None, seen: Observation | None = None) -> DataFrame:
    """Attach each line's route statistics.

    NULL in any key does not match (SQL equality), so such lines keep NULL
    here and take the silver defaults later.  ``source`` (default: ``fact``) is the
    frame the statistics are computed from; passing the lines before enrichment
    keeps dimension joins out of the aggregate branch.
    """
    stats = route_side(fact if source is None else source, keys)
    cond = None
    for k in keys:
        c = fact[k] == stats[f"_r_{k}"]
        cond = c if cond is None else cond & c
    out = seen_after(fact.join(stats, cond, "left"), f"_r_{keys[0]}", seen)
    return out.drop(*[f"_r_{k}" for k in keys])


def route_stats_window(fact: DataFrame, keys: Sequence[str] = ROUTE_KEYS, salts: int = 64) -> DataFrame:
    """Route statistics through window functions, one row per route.

    A per-line ``avg().over(partitionBy(route))`` would put every line of a
    route in one task, so a route holding a third of all lines would hold a
    third of the table in one task.  Here lines are first reduced to at most
    ``salts`` partial rows per route (partial sums keyed by a hash of the order
    id), and the windows run over those; the result equals ``route_stats``
    (NULL keys form their own routes, as in ``groupBy``).  ``salts`` bounds the
    rows of a route that meet in one task, and loses none.
    """
    salt = F.pmod(F.xxhash64("order_id"), F.lit(salts))
    part = (fact.groupBy(*keys, salt.alias("_salt"))
            .agg(F.sum("is_delayed").alias("_d"), F.count("is_delayed").alias("_dn"),
                 F.sum("delay_days").alias("_s"), F.count("delay_days").alias("_sn"),
                 F.count("order_id").alias("_n")))
    w = Window.partitionBy(*keys)
    out = part.select(
        *keys,
        (F.sum("_d").over(w).cast("double") / F.sum("_dn").over(w).cast("double")).alias("route_delay_rate"),
        (F.sum("_s").over(w).cast("double") / F.sum("_sn").over(w).cast("double")).alias("route_avg_delay_days"),
        F.sum("_n").over(w).alias("route_order_count"),
        F.row_number().over(w.orderBy("_salt")).alias("_first"))
    return out.where(F.col("_first") == 1).drop("_first")


def attach_route_stats_window(fact: DataFrame, keys: Sequence[str] = ROUTE_KEYS, salts: int = 64) -> DataFrame:
    """W3 for each line: the columns of ``join_route_stats`` through windows alone, so that
    the lines are read once, where ``fact`` is dear to compute twice.

    A route's lines are dealt over ``salts`` groups; one window adds each group up.  The
    first line of every group then carries the group's sums to all ``salts`` groups of its
    route (at most ``salts * salts`` small rows a route), and a second window over the same
    groups adds these up next to the lines.  No task holds more of a route than a group.
    Lines with a NULL key get no statistics, as they match nothing in ``join_route_stats``."""
    fact = fact.drop("route_delay_rate", "route_avg_delay_days", "route_order_count")
    group = Window.partitionBy(*[f"_k{i}" for i in range(len(keys))], "_salt")
    rows = fact.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                       F.pmod(F.xxhash64("order_id"), F.lit(salts)).alias("_salt"),
                       F.struct(*[F.col(f"`{c}`") for c in fact.columns]).alias("_line"))

    def total(c: str) -> Column:
        return F.sum(f"_line.{c}").over(group).cast("long")

    def many(c: str) -> Column:
        return F.count(f"_line.{c}").over(group)
    sums = F.struct(total("is_delayed").alias("d"), many("is_delayed").alias("dn"), total("delay_days").alias("s"),
                    many("delay_days").alias("sn"), many("order_id").alias("n"))
    rows = rows.select("*", sums.alias("_sums"), F.row_number().over(group.orderBy("_line.order_id")).alias("_first"))
    none_line, none_sums = (F.lit(None).cast(rows.schema[c].dataType) for c in ("_line", "_sums"))
    own = F.array(F.struct(F.col("_salt").alias("salt"), F.col("_line").alias("line"), none_sums.alias("sums")))
    copies = F.transform(F.sequence(F.lit(0), F.lit(salts - 1)), lambda t: F.struct(
        t.cast("long").alias("salt"), none_line.alias("line"), F.col("_sums").alias("sums")))
    names = [f"_k{i}" for i in range(len(keys))]
    rows = rows.select(*names, F.explode(F.when(F.col("_first") == 1, F.concat(own, copies)).otherwise(own)).alias("_x")) \
        .select(*names, F.col("_x.salt").alias("_salt"), F.col("_x.line").alias("_line"), F.col("_x.sums").alias("_sums"))
    known = F.lit(True)
    for n in names:
        known = known & F.col(n).isNotNull()

    def all_of(c: str) -> Column:
        return F.when(known, F.sum(f"_sums.{c}").over(group))

    def rate(a: str, b: str) -> Column:
        return F.try_divide(all_of(a).cast("double"), all_of(b).cast("double"))
    return rows.select("_line", rate("d", "dn").alias("route_delay_rate"), rate("s", "sn").alias("route_avg_delay_days"),
                       all_of("n").alias("route_order_count")) \
        .where(F.col("_line").isNotNull()).select("_line.*", "route_delay_rate", "route_avg_delay_days", "route_order_count")


# J4 without leakage -----------------------------------------------------------
def fold_of(folds: int, cols: Sequence[str] = ("order_id", "line_number")) -> Column:
    """Fold (0 to ``folds - 1``) of a line: the first 32 bits of the MD5 of its key's text."""
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % folds


def join_route_stats_out_of_fold(fact: DataFrame, fold: str, keys: Sequence[str] = ROUTE_KEYS,
                                 known: Column | None = None) -> DataFrame:
    """J4 for model inputs: each line's route statistics from the lines of other folds, so
    that no line's own outcome, nor that of its fold, is among its features.

    ``known`` (default: all) says which lines' outcomes may be used at all; with
    ``known`` the training rows, test rows take the rates of all training rows outside
    their fold number.  A route that no other fold knows has NULL rates and count 0.

    One aggregate to (route, fold) sums, a window over at most as many rows as there are
    folds for each route, and one join on (route, fold): a hot route costs as many
    partial rows as any other.  NULL in any key doesn't match, as in ``join_route_stats``."""
    use = F.lit(True) if known is None else known
    part = (fact.where(F.col(fold).isNotNull()).groupBy(*keys, fold)
            .agg(F.sum(F.when(use, F.col("is_delayed"))).alias("_d"), F.count(F.when(use, F.col("is_delayed"))).alias("_dn"),
                 F.sum(F.when(use, F.col("delay_days"))).alias("_s"), F.count(F.when(use, F.col("delay_days"))).alias("_sn"),
                 F.count(F.when(use, F.col("order_id"))).alias("_n")))
    route = Window.partitionBy(*keys)

    def others(c: str) -> Column:
        return F.sum(F.coalesce(c, F.lit(0))).over(route) - F.coalesce(c, F.lit(0))

    def rate(total: str, n: str) -> Column:
        return F.try_divide(others(total).cast("double"), others(n).cast("double"))
    side = part.select(*[F.col(k).alias(f"_r_{k}") for k in (*keys, fold)],
                       rate("_d", "_dn").alias("route_delay_rate"), rate("_s", "_sn").alias("route_avg_delay_days"),
                       others("_n").alias("route_order_count"))
    fact = fact.drop("route_delay_rate", "route_avg_delay_days", "route_order_count")
    cond = [fact[k] == side[f"_r_{k}"] for k in (*keys, fold)]
    return fact.join(side, cond, "left").drop(*[f"_r_{k}" for k in (*keys, fold)])


# J5 -------------------------------------------------------------------------
def attach_scalars(fact: DataFrame, **scalars: Column) -> DataFrame:
    """Attach one-row aggregates (given as ``DataFrame.scalar()`` columns)."""
    for name, value in scalars.items():
        fact = fact.withColumn(name, value)
    return fact


# J6 -------------------------------------------------------------------------
def join_coverage(df: DataFrame, matched: dict[str, str]) -> DataFrame:
    """For each named join, total rows, rows where its column is set, and the
    matched percent, from one pass.  ``matched`` maps a join's name to its column."""
    counts = df.agg(F.count(F.lit(1)).alias("_total"), *[F.count(c).alias(f"_m{i}") for i, c in enumerate(matched.values())])
    pairs = ", ".join(f"'{name}', _total, _m{i}" for i, name in enumerate(matched))
    out = counts.selectExpr(f"stack({len(matched)}, {pairs}) as (join_name, total_rows, matched_rows)")
    return out.withColumn("matched_pct", exact_ratio(F.col("matched_rows") * 100, F.col("total_rows"), 1))


def seen_after(df: DataFrame, key: str, seen: Observation | None) -> DataFrame:
    """Q6: count the lines that leave a join and those that found a match (``key``: a right
    side's join key), while the plan runs."""
    return df if seen is None else df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count(key).alias("matched"))


def join_report(spark, lines: int, seen: Mapping[str, Observation]) -> DataFrame:
    """One row per join, in order: lines before and after it, and matched ones, from the
    observations of a run that has ended (``lines``: what entered the first join)."""
    rows, before = [], lines
    for step, (name, counts) in enumerate(seen.items(), 1):
        after, matched = int(counts.get["rows"]), int(counts.get["matched"])
        rows.append((name, step, before, after, matched))
        before = after
    out = spark.createDataFrame(rows, "join_name string, step int, lines_before long, lines_after long, matched long")
    return out.withColumn("matched_pct", exact_ratio(F.col("matched") * 100, F.col("lines_after"), 1))


def join_forecast(fact: DataFrame, sides: Mapping[str, tuple[DataFrame, Sequence[str], Sequence[Column | str]]]) -> DataFrame:
    """What each of a chain of left joins will do to the lines, without making them:
    (join_name, step, lines_before, lines_after, matched).

    ``sides``: name -> (right side, its key columns, the fact's key columns), in order.  Each
    right side is counted by key; a line grows by the product of its keys' counts.  So a
    key that occurs more than once names the join that it would multiply lines in, before
    any table is written.  The fact is read once."""
    df, grown = fact, F.lit(1).cast("long")
    counts = [F.count(F.lit(1)).alias("_lines")]
    for i, (side, right, left) in enumerate(sides.values()):
        many = side.groupBy(*[F.col(c).alias(f"_k{i}_{j}") for j, c in enumerate(right)]).agg(F.count(F.lit(1)).alias(f"_m{i}"))
        keys = [F.col(c) if isinstance(c, str) else c for c in left]
        df = df.join(many, [k == F.col(f"_k{i}_{j}") for j, k in enumerate(keys)], "left")
        counts.append(F.sum(F.when(F.col(f"_m{i}").isNotNull(), grown * F.col(f"_m{i}")).otherwise(0)).alias(f"_found{i}"))
        grown = grown * F.coalesce(f"_m{i}", F.lit(1))
        counts.append(F.sum(grown).alias(f"_after{i}"))
    total = df.agg(*counts)
    rows = [F.struct(F.lit(name).alias("join_name"), F.lit(i + 1).alias("step"),
                     F.coalesce(F.col("_lines" if i == 0 else f"_after{i - 1}"), F.lit(0)).alias("lines_before"),
                     F.coalesce(f"_after{i}", F.lit(0)).alias("lines_after"), F.coalesce(f"_found{i}", F.lit(0)).alias("matched"))
            for i, name in enumerate(sides)]
    return total.select(F.inline(F.array(*rows)))


def duplicate_keys(dim: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once on a side that must be unique (NULL never matches)."""
    return dim.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1")
