"""Human versus judge agreement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def spearman(pairs: DataFrame, by: str) -> DataFrame:
    """Rank correlation of x and y per group, ties at their average rank. Distinct values
    are counted first, so a window holds one row per value."""

    def ranks(v: str) -> DataFrame:
        w = Window.partitionBy(by).orderBy(v)
        c = pairs.groupBy(by, v).agg(F.count(F.lit(1)).alias("_k"))
        return c.select(F.col(by).alias("_g"), F.col(v).alias("_v"), (F.sum("_k").over(w) - F.col("_k") + (F.col("_k") + 1) / 2).alias(f"r_{v}"))

    out = pairs
    for v in ("x", "y"):
        r = ranks(v)
        out = out.join(r, (out[by] == r["_g"]) & (out[v] == r["_v"])).drop("_g", "_v")
    return out.groupBy(by).agg(F.corr("r_x", "r_y").alias("rho"))


def quadratic_kappa(pairs: DataFrame) -> DataFrame:
    """Quadratic-weighted kappa of ordinal a and b over the marginals' categories."""
    o = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("o"))
    ra = o.groupBy("a").agg(F.sum("o").alias("ra"))
    rb = o.groupBy("b").agg(F.sum("o").alias("rb"))
    n = o.agg(F.sum("o").alias("n"))
    grid = ra.crossJoin(rb).crossJoin(n)  # a few categories
    both = grid.join(o, ["a", "b"], "left").withColumn("w", F.pow(F.col("a") - F.col("b"), 2))
    return both.agg((1 - F.sum(F.col("w") * F.coalesce("o", F.lit(0))) / F.sum(F.col("w") * F.col("ra") * F.col("rb") / F.col("n"))).alias("kappa"))


def krippendorff_interval(values: DataFrame) -> DataFrame:
    """Interval alpha over (unit, value) with at least two values a unit, from sums and
    squares, without pairing values."""
    u = values.groupBy("unit").agg(F.count("value").alias("m"), F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("q")).where("m > 1")
    t = u.agg(F.sum("m").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.sum((2 * F.col("m") * F.col("q") - 2 * F.col("s") * F.col("s")) / (F.col("m") - 1)).alias("d"))
    expected = (2 * F.col("n") * F.col("q") - 2 * F.col("s") * F.col("s")) / (F.col("n") - 1)
    return t.select((1 - F.col("d") / expected).alias("alpha"))


def krippendorff_nominal(values: DataFrame) -> DataFrame:
    """Nominal alpha over (unit, value), from counts per unit and value."""
    c = values.where(F.col("value").isNotNull()).groupBy("unit", "value").agg(F.count(F.lit(1)).alias("k"))
    u = c.groupBy("unit").agg(F.sum("k").alias("m"), F.sum(F.col("k") * F.col("k")).alias("q")).where("m > 1")
    seen = u.agg(F.sum("m").alias("n"), F.sum((F.col("m") * F.col("m") - F.col("q")) / (F.col("m") - 1)).alias("apart"))
    totals = c.join(u.select("unit"), "unit", "left_semi").groupBy("value").agg(F.sum("k").alias("t")).agg(F.sum(F.col("t") * F.col("t")).alias("s"))
    n = F.col("n")
    return seen.crossJoin(totals).select((1 - F.col("apart") * (n - 1) / (n * n - F.col("s"))).alias("alpha"))  # one row each


def fleiss_kappa(values: DataFrame) -> DataFrame:
    """Fleiss' kappa over (unit, value) of units that all have equally many values, at
    least two; others are left out by the most common number."""
    c = values.where(F.col("value").isNotNull()).groupBy("unit", "value").agg(F.count(F.lit(1)).alias("k"))
    u = c.groupBy("unit").agg(F.sum("k").alias("m"), F.sum(F.col("k") * (F.col("k") - 1)).alias("same"))
    usual = u.where("m > 1").groupBy("m").agg(F.count(F.lit(1)).alias("units")).agg(F.max_by("m", F.struct("units", "m")).alias("usual"))
    u = u.join(F.broadcast(usual), F.col("m") == F.col("usual")).drop("usual")  # one row
    seen = u.agg(F.avg(F.col("same") / (F.col("m") * (F.col("m") - 1))).alias("p"))
    share = c.join(u.select("unit"), "unit", "left_semi").groupBy("value").agg(F.sum("k").alias("t"))
    chance = share.agg((F.sum(F.col("t") * F.col("t")) / (F.sum("t") * F.sum("t"))).alias("e"))
    return seen.crossJoin(chance).select(F.try_divide(F.col("p") - F.col("e"), 1 - F.col("e")).alias("kappa"))


def binned(score: Column, edges: tuple[float, ...] = (0.25, 0.5, 0.75)) -> Column:
    """1 to len(edges) + 1: a continuous score as an ordinal rating."""
    return sum(F.coalesce(score >= e, F.lit(False)).cast("int") for e in edges) + F.when(score.isNotNull(), 1)


def ensemble_agreement(human: DataFrame, scores: DataFrame, axis: str = "fluency") -> DataFrame:
    """Rank correlation with ``human`` (item_id, rating) of each judge and of the ensemble
    mean: judge (``ensemble`` for the mean), n, rho."""
    each = scores.groupBy("item_id", "judge").agg(F.avg(axis).alias("y"))
    all_ = each.groupBy("item_id").agg(F.avg("y").alias("y")).withColumn("judge", F.lit("ensemble"))
    both = human.select("item_id", F.col("rating").alias("x")).join(each.unionByName(all_), "item_id")
    return both.groupBy("judge").agg(F.count(F.lit(1)).alias("n")).join(spearman(both, "judge"), "judge", "left")


def _running(counts: DataFrame, ranges: int) -> DataFrame:
    """``counts`` (score, p, n) with sums over this and all higher scores. Ranges of scores
    are summed first, so that no window holds more than a range or the ranges' totals."""
    ordered = counts.repartitionByRange(ranges, F.desc("score")).withColumn("_part", F.spark_partition_id())
    lows = ordered.groupBy("_part").agg(F.sum("p").alias("_p"), F.sum("n").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = lows.select("_part", F.coalesce(F.sum("_p").over(before), F.lit(0)).alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"))
    w = Window.partitionBy("_part").orderBy(F.desc("score"))
    return ordered.join(F.broadcast(starts), "_part").select("score", (F.col("_p") + F.sum("p").over(w)).alias("tp"), (F.col("_n") + F.sum("n").over(w)).alias("fp"))  # a row per range


def roc(scored: DataFrame, ranges: int = 64) -> DataFrame:
    """``scored`` (score, positive): tpr, fpr, youden per distinct threshold."""
    c = scored.groupBy("score").agg(F.count_if("positive").alias("p"), F.count_if(~F.col("positive")).alias("n"))
    every = c.agg(F.sum("p").alias("tp_all"), F.sum("n").alias("fp_all"))
    x = _running(c, ranges).crossJoin(F.broadcast(every))
    x = x.select("score", (F.col("tp") / F.col("tp_all")).alias("tpr"), (F.col("fp") / F.col("fp_all")).alias("fpr"))
    return x.withColumn("youden", F.col("tpr") - F.col("fpr"))


def best_threshold(curve: DataFrame) -> DataFrame:
    return curve.agg(F.max_by("score", F.struct("youden", "score")).alias("threshold"), F.max("youden").alias("youden"))
