"""Reports: retention, ensembles, audits, distributions, discrimination."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import clamp01, fixed, short_name
from ..sources.sinks import markdown_table

AXES = ("fluency", "faithfulness", "bias")


def rate(passed: Column, total: Column) -> Column:
    return F.coalesce(F.try_divide(passed, total), F.lit(0.0))


def retention(verdicts: DataFrame) -> DataFrame:
    """Long table (level, language, task, position, filter, passed, total, rate) over
    everything, by language and by language and task; the chain comes last. A filter that
    a verdict lacks is not counted."""
    # one pass: partial counts per group of the verdicts' pass patterns, then the filters
    short = verdicts.select("language", "task", "would_pass", F.transform("results", lambda r: F.struct(r["filter"].alias("filter"), r["passed"].alias("ok"))).alias("rs"))
    patterns = short.groupBy("language", "task", "would_pass", "rs").agg(F.count(F.lit(1)).alias("n"))
    every = F.concat("rs", F.array(F.struct(F.lit("chain").alias("filter"), F.col("would_pass").alias("ok"))))
    rows = patterns.select("language", "task", "n", F.size("rs").alias("k"), F.posexplode(every).alias("position", "r"))
    position = F.when(F.col("position") == F.col("k"), 99).otherwise(F.col("position"))  # the chain last
    leaf = rows.groupBy("language", "task", position.alias("position"), F.col("r.filter").alias("filter")).agg(F.sum(F.when(F.col("r.ok"), F.col("n")).otherwise(0)).alias("p"), F.sum("n").alias("t"))
    levels = leaf.withColumn("lv", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    keyed = levels.select("lv", F.when(F.col("lv") > 0, F.col("language")).alias("language"), F.when(F.col("lv") > 1, F.col("task")).alias("task"), "position", "filter", "p", "t")
    out = keyed.groupBy(F.col("lv").alias("level"), "language", "task", "position", "filter").agg(F.sum("p").alias("passed"), F.sum("t").alias("total"))
    return out.withColumn("rate", rate(F.col("passed"), F.col("total")))


def retention_markdown(report: DataFrame) -> str:
    rows = report.orderBy("level", "language", "task", "position").collect()  # groups times filters: small
    names = list(dict.fromkeys(r["filter"] for r in sorted(rows, key=lambda r: r["position"])))
    out = []
    for level, title in ((0, "Overall"), (1, "By language"), (2, "By language and task")):
        groups: dict[tuple, dict] = {}
        for r in rows:
            if r["level"] == level:
                groups.setdefault((r["language"] or "all", r["task"] or ""), {})[r["filter"]] = f"{r['passed']}/{r['total']} ({r['rate']:.0%})"
        out += [f"## {title}", markdown_table(["group", *names], [[" ".join(k).strip(), *[v.get(n, "-") for n in names]] for k, v in groups.items()])]
    return "\n\n".join(out)


def ensemble(scores: DataFrame, method: str = "mean") -> DataFrame:
    """Per item: axes aggregated over judges, their mean, and a label of the judges."""
    how = {"mean": F.avg, "median": F.median}[method]
    judges = F.array_sort(F.collect_set("judge"))
    got = scores.groupBy("item_id").agg(*[how(a).alias(a) for a in AXES], judges.alias("judges"), F.count(F.lit(1)).alias("n"))
    overall = sum(F.col(a) for a in AXES) / len(AXES)
    return got.select("item_id", *AXES, overall.alias("overall"), F.concat(F.lit(f"ensemble[{method}]:"), F.array_join("judges", ",")).alias("judge_model"), F.concat(F.col("n").cast("string"), F.lit(" judge(s)")).alias("judge_rationale"))


def required(scores: DataFrame) -> DataFrame:
    """ValueError where there is nothing to aggregate."""
    if scores.isEmpty():
        raise ValueError("no scores to aggregate")
    return scores


def overall() -> Column:
    """Mean of the clamped axes."""
    return sum(clamp01(F.col(a)) for a in AXES) / len(AXES)


def availability(targets: DataFrame, scores: DataFrame) -> DataFrame:
    """One row: items judged at least once (scored) and those with no usable judge
    (failed), which an ensemble leaves out."""
    usable = scores.where(" OR ".join(f"{a} IS NOT NULL" for a in AXES)).select("item_id").distinct().withColumn("_ok", F.lit(True))
    both = targets.select("item_id").join(usable, "item_id", "left")
    return both.agg(F.count_if(F.col("_ok")).alias("scored"), F.count_if(F.col("_ok").isNull()).alias("failed"))


def progress(items: DataFrame, log: DataFrame) -> DataFrame:
    """One row: items scored, remaining and in error by a log (id, error)."""
    per = log.groupBy("id").agg(F.max(F.col("error").isNull()).alias("_done"))
    both = items.select("id").join(per, "id", "left")
    return both.agg(F.count_if(F.col("_done")).alias("scored"), F.count_if(~F.col("_done")).alias("errors"), F.count_if(F.col("_done").isNull()).alias("remaining"))


def structural_fails(verdicts: DataFrame) -> DataFrame:
    ok = F.get(F.transform(F.filter("results", lambda r: r["filter"] == "structural"), lambda r: r["passed"]), F.lit(0))
    return verdicts.groupBy("task").agg(F.count(F.lit(1)).alias("total"), F.count_if(~ok).alias("fails"))


def by_judge(scores: DataFrame) -> DataFrame:
    """Judgements per judge's short name."""
    return scores.groupBy(short_name(F.col("judge")).alias("judge")).agg(F.count(F.lit(1)).alias("n"))


def ensemble_overview(scores: DataFrame, low: float) -> DataFrame:
    """One row: mean of item means, items, those of several judges and those below ``low``."""
    per = scores.groupBy("item_id").agg(F.avg(overall()).alias("o"), F.countDistinct("judge").alias("j"))
    return per.agg(F.avg("o").alias("mean"), F.count(F.lit(1)).alias("items"), F.count_if(F.col("j") >= 2).alias("multi"), F.count_if(F.col("o") < low).alias("low"))


def axis_means(scores: DataFrame, key: str = "language") -> DataFrame:
    return scores.groupBy(key).agg(*[F.avg(a).alias(a) for a in AXES], F.count(F.lit(1)).alias("n"))


def spread(scores: DataFrame, axis: str) -> DataFrame:
    return scores.groupBy("item_id").agg(F.when(F.count(axis) > 1, F.max(axis) - F.min(axis)).alias("spread"))


def low_p10(scores: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Nearest-rank-low tenth percentile, ``sorted[n // 10]``: the value whose rank is
    n // 10 + 1. Counts per distinct value meet in the window, not the rows."""
    per = scores.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_k"))
    w = Window.partitionBy(*keys)
    per = per.withColumn("_n", F.sum("_k").over(w)).withColumn("_upto", F.sum("_k").over(w.orderBy(value)))
    return per.where(F.col("_upto") > F.floor(F.col("_n") / 10)).groupBy(*keys).agg(F.min(value).alias("p10"))


def audit(scores: DataFrame, keys: list[str], value: str) -> DataFrame:
    base = scores.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.median(value).alias("median"), F.min(value).alias("min"), F.max(value).alias("max"))
    return base.join(low_p10(scores, keys, value), keys)


def coverage(items: DataFrame, log: DataFrame, back_translated: DataFrame | None = None) -> DataFrame:
    """Per language: items, judged at least once, by at least two judges; with the ids of
    a back-translation log also those eligible (no translation items) and scored."""
    n = log.groupBy("item_id").agg(F.countDistinct("judge").alias("judges"))
    both = items.join(n, items["id"] == n["item_id"], "left")
    out = [F.count(F.lit(1)).alias("items"), F.count_if(F.col("judges") >= 1).alias("judged"), F.count_if(F.col("judges") >= 2).alias("ensemble")]
    if back_translated is not None:
        both = both.join(back_translated.select("id").distinct().withColumn("_bt", F.lit(True)), "id", "left")
        free = F.col("task_family") != "translation"
        out += [F.count_if(free).alias("bt_eligible"), F.count_if(free & F.col("_bt")).alias("bt_scored")]
    return both.groupBy("language").agg(*out)


def distribution(scores: DataFrame, key: str, value: str) -> DataFrame:
    """N, mean, median, p10, p90 per key and over all (null key)."""
    p = F.percentile(value, F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))
    got = scores.rollup(key).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), p.alias("p"))
    return got.select(key, "n", "mean", F.col("p")[1].alias("median"), F.col("p")[0].alias("p10"), F.col("p")[2].alias("p90"))


def discrimination(pairs: DataFrame) -> DataFrame:
    """``pairs`` (matched, mismatched): means, extremes, separation, overlap."""
    top = pairs.agg(F.max("mismatched").alias("top"))
    return pairs.crossJoin(F.broadcast(top)).agg(
        F.avg("matched").alias("matched_mean"), F.min("matched").alias("matched_min"), F.avg("mismatched").alias("mismatched_mean"), F.max("mismatched").alias("mismatched_max"),
        (F.avg("matched") - F.avg("mismatched")).alias("separation"), F.count_if(F.col("matched") <= F.col("top")).alias("overlap"),
    )


def tier_pivot(scores: DataFrame, judges: list[str]) -> DataFrame:
    """Fluency per tier and judge; ``scores`` with a column ``error`` gives text cells, ERR
    where a judge failed."""
    if "error" not in scores.columns:
        return scores.groupBy("tier").pivot("judge", judges).agg(F.first("fluency", ignorenulls=True))
    cell = F.coalesce(fixed(F.max("fluency"), 2), F.max(F.when(F.col("error").isNotNull(), "ERR")))
    return scores.groupBy("tier").pivot("judge", judges).agg(cell)


def drop_counts(candidates: DataFrame) -> DataFrame:
    return candidates.where("drop_reason IS NOT NULL").groupBy("task_family", "drop_reason").agg(F.count(F.lit(1)).alias("n"))


def taxonomy(reviews: DataFrame) -> DataFrame:
    """``reviews`` (language, verdict, categories): counts per language and category."""
    return reviews.select("language", F.explode("categories").alias("category")).groupBy("language", "category").agg(F.count(F.lit(1)).alias("n"))


def defect_rate(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("language").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("verdict") == "defect").alias("defects")).withColumn("rate", rate(F.col("defects"), F.col("n")))


def verdict_shares(reviews: DataFrame) -> DataFrame:
    """Reviews per verdict and their share; the total is a sum of a few counts."""
    n = reviews.groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("share", rate(F.col("n"), F.sum("n").over(Window.partitionBy(F.lit(0)))))  # a row per verdict


def gold_summary(selected: DataFrame) -> DataFrame:
    """``selected`` (language, stratum, overlap): items, strata and double ratings."""
    return selected.groupBy("language").agg(F.count(F.lit(1)).alias("items"), F.count_if(F.col("stratum") == "normal").alias("normal"), F.count_if(F.col("stratum") == "borderline").alias("borderline"), F.count_if("overlap").alias("double_rated"))


def run_counts(done: DataFrame) -> DataFrame:
    """``done`` (error): generated and skipped rows of a run."""
    return done.agg(F.count_if(F.col("error").isNull()).alias("generated"), F.count_if(F.col("error").isNotNull()).alias("skipped"))
