"""Whole runs: generation, judging, scoring, filtering and exports, composed of the
operators. Each returns DataFrames and, where it has a report, its text; writing is left to
the sinks, which a caller names. Model calls go through ``models.complete``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import models
from .functions import prompts, salvage
from .functions import text as T
from .operators import aggregates as A
from .operators import gates, joins, pools
from .operators import windows as W
from .sources import readers, sinks

#: Fixed value: waits of the slow generator, in seconds.
DRIP_BACKOFF = (60.0, 300.0, 900.0)
DRIP_ATTEMPTS = 6
NO_KEYS = "seed_id string, target_language string, task_family string"


# ------------------------------------------------------------------ generation
def _asked(jobs: DataFrame, model: str) -> DataFrame:
    """``jobs`` (seed columns, target_language) with the prompts of each row's template."""
    p = prompts.for_task()
    return jobs.withColumn("_p", p).withColumn("system", F.col("_p.system")).withColumn("user", F.col("_p.user")).withColumn("template", prompts.default_template(F.col("task_family"))).withColumn("model", F.lit(model)).drop("_p")


def _items(answered: DataFrame, suffix: bool = False) -> DataFrame:
    """Answers as items; failed ones keep their error and have no text."""
    got = salvage.parse_response(F.col("raw_response"))
    id_ = T.synthetic_id(F.col("target_language"), F.col("seed_id"))
    id_ = F.concat(id_, F.lit("-"), T.padded(F.col("idx"), 3)) if suffix else id_
    config = F.struct("seed_id", "target_language", F.col("model").alias("teacher_model"), F.col("template").alias("prompt_template_name"))
    meta = pools.merged_metadata(F.col("metadata"), F.create_map(F.lit("template"), F.col("template")))
    ok = F.col("error").isNull()
    x = answered.withColumn("_got", F.when(ok, got))
    keep = ["idx"] if "idx" in answered.columns else []
    return x.select(
        id_.alias("id"), "seed_id", "task_family", "target_language", F.col("_got.prompt").alias("prompt"), F.col("_got.expected").alias("expected"),
        meta.alias("metadata"), config.alias("generation"), "raw_response", "error", *keep,
    )


def generate(seeds: DataFrame, task: str, language: str, n: int, factory: Callable, model: str, **call) -> DataFrame:
    """``n`` items of one task and language from the pool, cycled if it is shorter."""
    pool = joins.cycled(pools.of_task(seeds, task), n).withColumnRenamed("id", "seed_id")
    return _items(models.complete(_asked(pool.withColumn("target_language", F.lit(language)), model), factory, **call), suffix=True)


def planned(seeds: DataFrame, languages: DataFrame, tasks: str, existing: DataFrame | None, per_combo: int | None) -> DataFrame:
    """Jobs with their seeds' columns, without those generated already."""
    pool = pools.of_tasks(seeds, tasks)
    jobs = joins.plan_jobs(pool, languages, existing, per_combo)
    return jobs.join(pool.drop("pos", "task_family").withColumnRenamed("id", "seed_id"), "seed_id")


def generate_batch(seeds: DataFrame, languages: DataFrame, tasks: str, factory: Callable, model: str, existing: DataFrame | None = None, per_combo: int | None = None, **call) -> DataFrame:
    """Items for every task and language that lack them; ids count up within a combo."""
    existing = seeds.sparkSession.createDataFrame([], NO_KEYS) if existing is None else existing
    items = _items(models.complete(_asked(planned(seeds, languages, tasks, existing, per_combo), model), factory, **call))
    numbered = W.combo_suffix(items.withColumn("seed_pos", F.col("idx")))
    return numbered.withColumn("id", F.concat("id", F.lit("-"), T.padded(F.col("n"), 3))).drop("seed_pos", "n")


def generate_drip(seeds: DataFrame, languages: DataFrame, tasks: str, factory: Callable, model: str, existing: DataFrame, have: DataFrame, per_combo: int, **call) -> DataFrame:
    """Fills each combo up to ``per_combo`` items, one after another: ``have``
    (target_language, task_family, n) counts what exists, ``existing`` are its keys. One
    task makes all calls, with growing waits, as the server's patience is the limit."""
    jobs = planned(seeds, languages, tasks, existing, per_combo)
    jobs = jobs.join(have, ["target_language", "task_family"], "left").where(F.col("idx") < F.lit(per_combo) - F.coalesce("n", F.lit(0))).drop("n")
    one = _asked(jobs, model).orderBy("idx", "task_family", "lang_pos").coalesce(1)
    return _items(models.complete(one, factory, attempts=DRIP_ATTEMPTS, backoff=DRIP_BACKOFF, **call), suffix=True)


# ------------------------------------------------------------------ bootstrap
def bootstrap_seeds(spark: SparkSession, seeds: DataFrame, task: str, n: int, factory: Callable, model: str, per_call: int = 8, taken: DataFrame | None = None, max_calls: int | None = None, **call) -> tuple[DataFrame, DataFrame]:
    """New seeds of a task, and counts of dropped candidates by reason.

    All calls that may be needed are made at once, in parallel; candidates are judged in
    the order of calls, and the first ``n`` accepted ones are numbered past ``taken`` ids.
    """
    pool = pools.of_task(seeds, task)
    calls = max_calls or max(4, (n // per_call) * 3 + 4)
    shown = pool.orderBy("id").limit(3).agg(F.collect_list(F.struct("prompt", "expected", "labels", "metadata")).alias("examples"))
    asked = shown.select(F.explode(F.sequence(F.lit(0), F.lit(calls - 1))).alias("call"), prompts.bootstrap_prompt(task, F.col("examples"), per_call).alias("p"))
    asked = asked.select("call", "p.system", "p.user", F.lit(model).alias("model")).repartition("call")
    raw = models.complete(asked, factory, **({"temperature": 1.0} | call)).where("error IS NULL").select("call", salvage.parse_seed_records(F.col("raw_response")).alias("records"))
    found = raw.select("call", F.posexplode_outer("records").alias("at", "record"))
    schema = "prompt string, expected string, labels array<string>, metadata map<string,string>"
    found = found.select(F.struct("call", "at").alias("pos"), F.from_json("record", schema).alias("r"), F.col("record").isNull().alias("blank")).select("pos", "blank", "r.*")
    reason = F.when(F.col("blank"), "unparseable_response").otherwise(gates.seed_drop_reason(F.col("prompt"), F.col("expected"), F.col("labels"), F.lit(task)))
    judged = pools.with_duplicates(found.withColumn("task_family", F.lit(task)).withColumn("drop_reason", reason), pool)
    good = judged.where("drop_reason IS NULL").orderBy("pos").limit(n).withColumn("key", F.col("pos"))
    used = seeds.select("id") if taken is None else pools.all_ids(seeds, taken)
    ids = W.allocate_ids(good.select("key"), used, f"seed-{task}-bs-")
    source = F.create_map(F.lit("source"), F.lit(f"bootstrap:{model}"))
    new = good.join(ids, "key").select(F.col("new_id").alias("id"), "task_family", "prompt", "expected", pools.merged_metadata(F.col("metadata"), source).alias("metadata"), "labels")
    return new, A.drop_counts(judged)


# ------------------------------------------------------------------ judging
def _judged(targets: DataFrame, judges: list[str], factory: Callable, **call) -> DataFrame:
    """``targets`` (item_id, seed columns, item_prompt, item_expected) by every judge: one
    row each with clamped axes, their mean, a rationale, or an error."""
    asked = joins.each_of(targets, "judge", judges).withColumn("_p", prompts.judge_prompt(F.col("item_prompt"), F.col("item_expected")))
    asked = asked.withColumn("system", F.col("_p.system")).withColumn("user", F.col("_p.user")).withColumn("model", F.col("judge")).drop("_p")
    got = models.complete(asked, factory, **({"temperature": 0.0} | call))
    fields = ", ".join(f"{a} string" for a in A.AXES)
    cell = F.from_json(salvage.strict_object(salvage.object_candidate(F.col("raw_response")), once=True), f"reasoning string, {fields}")
    x = got.withColumn("_c", cell).withColumn("error", F.coalesce("error", F.when(F.col("_c").isNull(), "no JSON object in the answer")))
    ok = F.col("error").isNull()
    x = x.select("item_id", "judge", *[F.when(ok, T.clamp01(F.col(f"_c.{a}"))).alias(a) for a in A.AXES], F.col("_c.reasoning").alias("rationale"), "error", *[c for c in ("label", "prompt", "item_prompt") if c in targets.columns])
    return x.withColumn("overall", sum(F.col(a) for a in A.AXES) / len(A.AXES))


def _targets(items: DataFrame, seeds: DataFrame) -> DataFrame:
    """Items of known seeds with their seeds' columns."""
    s = seeds.select(F.col("id").alias("seed_id"), "prompt", "expected")
    i = items.select(F.col("id").alias("item_id"), "seed_id", "task_family", "target_language", F.col("prompt").alias("item_prompt"), F.col("expected").alias("item_expected"))
    return i.join(s, "seed_id")


def judge_score(items: DataFrame, seeds: DataFrame, judges: list[str], factory: Callable, method: str = "mean", **call) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(ensemble scores, scores of each judge, one row of counts: scored, failed, missing).
    Items that no judge scored are failed and have no ensemble row."""
    targets = _targets(items, seeds)
    scores = _judged(targets, judges, factory, **call)
    usable = scores.where("error IS NULL")
    missing = items.join(seeds.select(F.col("id").alias("seed_id")), "seed_id", "left_anti").agg(F.count(F.lit(1)).alias("missing"))
    return A.ensemble(usable, method), usable, A.availability(targets, usable).crossJoin(missing)  # one row each


def judge_compare(items: DataFrame, seeds: DataFrame, judges: list[str], factory: Callable, controls: int = 3, **call) -> tuple[DataFrame, str]:
    """A panel over items and control rows, in which judges see the raw English seed as if
    it were the item; and its report."""
    real = _targets(items, seeds).withColumn("label", F.lit("real"))
    control = pools.head(real, controls, "item_id").withColumn("item_id", F.concat(F.lit("control-"), "item_id")).withColumn("item_prompt", F.col("prompt")).withColumn("item_expected", F.col("expected")).withColumn("label", F.lit("CONTROL: raw English"))
    scores = _judged(real.unionByName(control), judges, factory, **call)
    return scores, panel_markdown(scores, judges)


def panel_markdown(scores: DataFrame, judges: list[str]) -> str:
    """Scores side by side and their spread; a panel is a few items by design."""
    rows = scores.orderBy("item_id").collect()
    out = [f"Judges: {', '.join(judges)}. Spread is the largest less the smallest score; a judge that finds raw English fluent tells nothing apart."]
    for item in dict.fromkeys(r["item_id"] for r in rows):
        own = sorted((r for r in rows if r["item_id"] == item), key=lambda r: judges.index(r["judge"]))
        good = [r for r in own if r["error"] is None]
        cells = [[r["judge"], *([f"{r[a]:.2f}" for a in (*A.AXES, "overall")] if r["error"] is None else [f"ERR {r['error']}", "", "", ""])] for r in own]
        spread = [f"{max(r[a] for r in good) - min(r[a] for r in good):.2f}" if len(good) > 1 else "-" for a in A.AXES]
        out += [f"## {item} ({own[0]['label']})", f"Seed: {own[0]['prompt']}", f"Judged: {own[0]['item_prompt']}", sinks.markdown_table(["judge", *A.AXES, "overall"], [*cells, ["spread", *spread, ""]])]
        out += ["\n".join(f"- {r['judge']}: {r['rationale']}" for r in good if r["rationale"])]
    return "\n\n".join(x for x in out if x)


def compare(seeds: DataFrame, teachers: list[str], language: str, n: int, factory: Callable, **call) -> tuple[DataFrame, str]:
    """The first ``n`` seeds by every teacher, and the report that shows them together."""
    jobs = joins.each_of(pools.head(seeds, n).withColumnRenamed("id", "seed_id").withColumn("target_language", F.lit(language)), "teacher", teachers)
    made = _items(models.complete(_asked(jobs, "").withColumn("model", F.col("teacher")), factory, **call))
    rows = made.select("seed_id", F.col("generation.teacher_model").alias("teacher"), "prompt", "expected", "error").collect()  # n times teachers
    cell = {(r["seed_id"], r["teacher"]): r for r in rows}
    out = [f"Teachers for {language}: {', '.join(teachers)}"]
    for s in pools.head(seeds, n).select("id", "task_family", "prompt", "expected").collect():
        out += [f"## {s['id']} ({s['task_family']})", f"English: {s['prompt']}" + (f"\nReference: {s['expected']}" if s["expected"] else "")]
        for t in teachers:
            r = cell[s["id"], t]
            out.append(f"### {t}\n" + (f"ERROR: {r['error']}" if r["error"] else f"- prompt: {r['prompt']}\n- expected: {r['expected']}"))
    return made, "\n\n".join(out)


def score_backtranslation(items: DataFrame, seeds: DataFrame, log: DataFrame, factory: Callable, embedder: Callable, translator: str, limit: int | None = None, **call) -> DataFrame:
    """New rows of the back-translation log: items of known seeds that it lacks, translated
    back and compared with their seeds by cosine; failures keep their error."""
    todo = joins.unscored(readers.without_translation(items), log)
    todo = todo if limit is None else pools.head(todo, limit, "id")
    t = todo.join(seeds.select(F.col("id").alias("seed_id"), T.with_answer(F.col("prompt"), F.col("expected")).alias("seed_text")), "seed_id")
    t = t.select("id", "seed_id", F.col("target_language").alias("lang"), F.col("task_family").alias("task"), "seed_text", prompts.back_translation_prompt(T.with_answer(F.col("prompt"), F.col("expected"))).alias("_p"))
    got = models.complete(t.select("*", "_p.system", "_p.user", F.lit(translator).alias("model")).drop("_p"), factory, **call)
    back = got.select("id", "seed_id", "lang", "task", "seed_text", F.col("model").alias("translator"), T.strip_ws(F.col("raw_response")).alias("back_translation"), "error")
    vectors = models.embed(back.select(F.explode(F.array("seed_text", "back_translation")).alias("text")).where("text IS NOT NULL"), embedder)
    a, b = (vectors.select(F.col("text").alias(c), F.col("vector").alias(v)) for c, v in (("seed_text", "_a"), ("back_translation", "_b")))
    both = back.join(a, "seed_text", "left").join(b, "back_translation", "left")
    return both.select("id", "seed_id", "lang", "task", "translator", F.when(F.col("_b").isNotNull(), T.cosine(F.col("_a"), F.col("_b"))).alias("cos"), "back_translation", "error")


def score_judge(items: DataFrame, seeds: DataFrame, log: DataFrame, judges: list[str], factory: Callable, day: str, cap: int, per_run: int, **call) -> DataFrame:
    """New rows of the judge log: pairs of items and judges it lacks, languages in turn, as
    many as the day's budget leaves; judges that the log shows congested on that day are
    left out."""
    spark = items.sparkSession
    today = log.where(T.utc_day(F.col("ts")) == day)
    busy = W.congested(today.select("judge", "ts", F.col("item_id").alias("event_id"), F.col("error").isNotNull().alias("failed"))).select("judge")
    open_ = spark.createDataFrame([(j,) for j in judges], "judge string").join(busy, "judge", "left_anti")
    done = readers.done_pairs(log.where("error IS NULL"))
    todo = joins.judge_work(readers.without_translation(items), open_, done, seeds)
    lang = items.select(F.col("id").alias("item_id"), F.col("target_language").alias("_lang"))
    turns = W.interleave(todo.join(lang, "item_id"), "_lang", [F.col("item_id"), F.col("judge")])
    some = turns.orderBy("turn", "_lang", "judge").limit(W.budget_left(log, day, cap, per_run)).select("item_id", "judge")
    targets = _targets(items, seeds).join(some, "item_id")
    names = [r[0] for r in open_.collect()]
    if not names:
        return _judged(targets.drop("judge").limit(0), judges, factory, **call)
    scores = _judged(targets.drop("judge").distinct(), names, factory, **call)
    return scores.join(some, ["item_id", "judge"], "left_semi")


# ------------------------------------------------------------------ filter, gold, audit
def filter_items(items: DataFrame, scripts=T.SCRIPTS, judge_scores: DataFrame | None = None, back_log: DataFrame | None = None, seeds: DataFrame | None = None, short_circuit: bool = False) -> tuple[DataFrame, DataFrame]:
    """(verdicts, retention): both deterministic gates, then those that only score, where
    their logs are given. ``judge_scores`` (item_id, overall); ``back_log`` (id, cos,
    error); without ``seeds`` every seed counts as known."""
    x, more = items, []
    if seeds is not None and (judge_scores is not None or back_log is not None):
        x = joins.with_seed(x, seeds).drop("seed_prompt", "seed_expected")
    known = F.coalesce("seed_known", F.lit(False)) if "seed_known" in x.columns else F.lit(True)
    if judge_scores is not None:
        x = x.join(judge_scores.select(F.col("item_id").alias("_j"), F.col("overall").alias("_overall")), F.col("id") == F.col("_j"), "left")
        x = x.withColumn("llm_judge", gates.llm_judge(F.col("_overall"), known))
        more.append("llm_judge")
    if back_log is not None:
        x = x.join(back_log.select(F.col("id").alias("_b"), F.col("cos").alias("_cos"), F.col("error").alias("_error"), F.lit(True).alias("_logged")), F.col("id") == F.col("_b"), "left")
        error = F.when(F.col("_logged").isNull(), "not translated back").otherwise(F.col("_error"))
        x = x.withColumn("back_translation", gates.back_translation(F.col("_cos"), error, known))
        more.append("back_translation")
    v = gates.verdicts(x, scripts, short_circuit, tuple(more))
    return v, A.retention(v)


def export_gold(items: DataFrame, scores: DataFrame, seeds: DataFrame, bundle_id: str, per_language: int, normal_share: float = 0.3, raters: int = 2, overlap: float = 0.2, seed: str = "0", version: str = "v1", created_at: str | None = None) -> tuple[dict, dict, DataFrame]:
    """(bundle for raters, private manifest, summary). ``scores`` (item_id, axes, overall,
    judge_model). A bundle is what people rate, so it is small and made by the driver."""
    have = joins.eligible(items, scores)
    ranked = have.join(scores.select(F.col("item_id").alias("id"), "overall"), "id").select("id", F.col("target_language").alias("language"), "overall")
    picked = W.select_gold(ranked, per_language, normal_share, seed)
    slots = [str(k + 1) for k in range(max(1, raters))]
    assigned = W.assign_raters(picked, slots, overlap, seed).select("id", "raters", "overlap")
    rows = picked.drop("overall").join(assigned, "id").join(joins.with_seed(items, seeds), "id").join(scores.withColumnRenamed("item_id", "id"), "id").orderBy("language", "id").collect()
    axes = [{"key": k, "label": label, "scale": [1, 4], "needs_source": k != "fluency"} for k, label in zip(A.AXES, ("Naturalness", "Meaning match", "Cultural fit"), strict=True)]
    bundle = {
        "bundle_id": bundle_id, "created_at": created_at or sinks.stamp(), "instructions_version": version, "rating_schema": {"axes": axes, "optional": ["unsure", "comment"]},
        "items": [{"task_id": r["id"], "language": r["language"], "task_family": r["task_family"], "source_prompt": r["seed_prompt"], "source_expected": r["seed_expected"], "generated_prompt": r["prompt"], "generated_expected": r["expected"], "show_source": True} for r in rows],
    }
    manifest = {
        "bundle_id": bundle_id,
        "assignments": [{"task_id": r["id"], "raters": [f"{r['language']}_r{k}" for k in r["raters"]], "overlap": r["overlap"], "stratum": r["stratum"]} for r in rows],
        "provenance": {r["id"]: {"teacher_model": r["generation"]["teacher_model"] if "generation" in r else None, "judge_scores": {a: round(r[a], 4) for a in A.AXES}, "judge_overall": round(r["overall"], 4), "judge_model_ensemble": _ensemble_names(r["judge_model"])} for r in rows},
    }
    return bundle, manifest, A.gold_summary(picked.join(assigned, "id"))


def _ensemble_names(label: str) -> list[str]:
    return [j for j in label.split(":", 1)[1].split(",") if j] if ":" in label else [label]


def audit_report(items: DataFrame, judge_log: DataFrame, back_log: DataFrame, scripts=T.SCRIPTS, n: int = 8) -> str:
    """The audit as one document: structural fails, back-translation, judges."""
    v, _ = filter_items(items, scripts)
    fails = v.where(F.array_contains("failed", "structural"))
    table = lambda df, *order: sinks.markdown_table(df.columns, [list(r) for r in (df.orderBy(*order) if order else df).collect()])
    cosine = A.audit(back_log.withColumn("all", F.lit("all")), ["all"], "cos").drop("all")
    parts = [
        "## Structural", table(A.structural_fails(v), "task"), table(pools.examples(fails, ["task"], "item_id", n), "task"),
        "## Back-translation", table(A.progress(readers.without_translation(items), back_log)), table(cosine), table(A.audit(back_log, ["lang"], "cos"), "lang"),
        table(pools.head(pools.low_scores(back_log, "cos", gates.LOW_COSINE).select("cos", "id"), n, "cos"), "cos"),
        "## Judges", table(A.by_judge(judge_log), "judge"), table(judge_log.agg(*[f(a).alias(f"{a}_{name}") for a in A.AXES for name, f in (("mean", F.avg), ("min", F.min))])), table(A.ensemble_overview(judge_log, gates.LOW_ENSEMBLE)),
        table(pools.head(pools.low_scores(A.ensemble(judge_log), "overall", gates.LOW_ENSEMBLE).select("overall", "item_id"), n, "overall"), "overall"),
    ]
    return "\n\n".join(parts)


def probe_back_translation(vectors: DataFrame, n: int, seed: str) -> DataFrame:
    """``vectors`` (id, language, vector, back): how far the cosine with an item's own
    back-translation lies from that with another's, on ``n`` items a language."""
    some = joins.mismatched(pools.sampled(vectors, "language", "id", n, seed))
    return A.discrimination(some.select(T.cosine(F.col("back"), F.col("vector")).alias("matched"), T.cosine(F.col("back"), F.col("other")).alias("mismatched")))
