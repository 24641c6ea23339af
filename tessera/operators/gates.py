"""The quality gates: struct columns (filter, passed, score, reason) and their chain.
Gates only annotate; nothing is discarded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# Fixed values of the structural gate.
MIN_PROMPT, MAX_PROMPT = 5, 8000
TRUNCATION_FROM = 40
TERMINAL = ".?!।॥۔؟…\"')]}"
REPEAT_TOKENS, REPEAT_ABOVE = 8, 0.75
NEEDS_ANSWER = ("qa", "classification", "translation")
# Fixed values of the script gate.
SCRIPT_THRESHOLD = 0.75
EXEMPT = ("translation",)
# Fixed values of seed acceptance.
SEED_MIN, SEED_MAX = 10, 2000
SEED_NEEDS_ANSWER = ("qa", "reasoning")
TARGET_SCRIPT = [(0x0900, 0x097F), (0x0600, 0x06FF), (0x0750, 0x077F), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF), (0x0B80, 0x0BFF), (0x0D00, 0x0D7F)]
# Fixed values of the review thresholds.
LOW_COSINE, LOW_ENSEMBLE = 0.5, 0.6


def result(name: str, passed: Column, score: Column, reason: Column) -> Column:
    return F.struct(F.lit(name).alias("filter"), passed.cast("boolean").alias("passed"), score.cast("double").alias("score"), reason.cast("string").alias("reason"))


def prepare(items: DataFrame, scripts=T.SCRIPTS) -> DataFrame:
    """Adds what the gates share, each in a projection of its own, so that no text is
    stripped, split or searched twice: _p, _e (stripped), _n, _frac (tokens and share of
    repeats), _conf (script share)."""
    x = items.withColumn("_p", T.strip_ws(F.coalesce("prompt", F.lit("")))).withColumn("_e", T.strip_ws(F.coalesce("expected", F.lit(""))))
    x = x.withColumn("_toks", T.stripped_tokens(F.col("_p"))).withColumn("_n", F.size("_toks")).withColumn("_frac", T.repeat_fraction(F.col("_toks"))).drop("_toks")
    x = x.withColumn("_letters", T.letters_of(T.with_answer(F.col("prompt"), F.col("expected"))))
    return x.withColumn("_conf", T.script_share(F.col("_letters"), F.col("target_language"), scripts)).drop("_letters")


def violations() -> Column:
    """Messages of the structural rules that a prepared row violates, in rule order."""
    p, e, n, frac, task = (F.col(c) for c in ("_p", "_e", "_n", "_frac", "task_family"))
    rules = [
        F.when(p == "", "empty prompt").when(F.length(p) < MIN_PROMPT, f"prompt under {MIN_PROMPT} chars").when(F.length(p) > MAX_PROMPT, f"prompt over {MAX_PROMPT} chars"),
        F.when(task.isin(*NEEDS_ANSWER) & (e == ""), F.concat(task, F.lit(" item missing 'expected' answer"))),
        F.when((e != "") & (e == p), "expected duplicates prompt (no-op generation)"),
        F.when(p.startswith("{") | p.contains('"prompt"'), "prompt contains raw JSON scaffolding"),
        F.when(p.contains("```"), "prompt contains markdown code fence"),
        F.when((F.length(p) > TRUNCATION_FROM) & ~F.lit(TERMINAL).contains(F.right(p, F.lit(1))), "possible truncation (no terminal punctuation)"),
        F.when((n >= REPEAT_TOKENS) & (frac > REPEAT_ABOVE), F.concat(T.percent(frac), F.lit(f" of tokens repeat (>{REPEAT_ABOVE:.0%})"))),
    ]
    return F.array_compact(F.array(*rules))


def structural(v: Column) -> Column:
    """``v``: the violations, as a computed column."""
    return result("structural", F.size(v) == 0, F.greatest(F.lit(0.0), 1 - 0.5 * F.size(v)), F.when(F.size(v) > 0, F.array_join(v, "; ")))


def language_id(threshold: float = SCRIPT_THRESHOLD, exempt=EXEMPT) -> Column:
    """Passes above the threshold; exempt families pass with their real score shown."""
    conf, task, lang = F.col("_conf"), F.col("task_family"), F.col("target_language")
    free = task.isin(*exempt) if exempt else F.lit(False)
    share = T.percent(conf)
    why = F.when(free, F.concat(F.lit("exempt ("), task, F.lit("): source-language text expected; "), share, F.lit(" in "), lang, F.lit(" script")))
    reason = why.when(conf < threshold, F.concat(F.lit("only "), share, F.lit(" of letters in "), lang, F.lit(f" script (<{threshold:.0%})")))
    return result("language_id", free | (conf >= threshold), conf, reason)


def gated(items: DataFrame, scripts=T.SCRIPTS, threshold: float = SCRIPT_THRESHOLD, exempt=EXEMPT) -> DataFrame:
    """``items`` with the results of both gates: structural, language_id."""
    x = prepare(items, scripts).withColumn("_v", violations())
    out = x.withColumn("structural", structural(F.col("_v"))).withColumn("language_id", language_id(threshold, exempt))
    return out.drop("_p", "_e", "_n", "_frac", "_conf", "_v")


def llm_judge(overall: Column, seed_known: Column) -> Column:
    """Score only: never rejects."""
    why = F.when(~seed_known, "judge unavailable: no seed").when(overall.isNull(), "judge unavailable: no score")
    return result("llm_judge", F.lit(True), F.coalesce(overall, F.lit(0.0)), why)


def back_translation(cos: Column, error: Column, seed_known: Column) -> Column:
    """Score only: never rejects."""
    why = F.when(~seed_known, "no seed").when(error.isNotNull(), F.concat(F.lit("back-translation unavailable: "), error))
    return result("back_translation", F.lit(True), F.when(error.isNull() & seed_known, cos), why).withField("score", F.when(error.isNull() & seed_known, F.coalesce(cos, F.lit(0.0))).otherwise(0.0))


def chain(*results: Column, short_circuit: bool = False) -> Column:
    """All results in order, or those up to the first failure."""
    every = F.array(*results)
    if not short_circuit:
        return every
    fails = F.array_position(F.transform(every, lambda r: r["passed"]), F.lit(False)).cast("int")
    return F.when(fails > 0, F.slice(every, 1, fails)).otherwise(every)


def would_pass(results: Column) -> Column:
    return F.forall(results, lambda r: r["passed"])


def failed_filters(results: Column) -> Column:
    return F.transform(F.filter(results, lambda r: ~r["passed"]), lambda r: r["filter"])


class QualityFilter:
    """A gate of one's own: give it a ``name`` and ``evaluate``, which returns (passed,
    score, reason) as columns over an item's columns."""

    name = "filter"

    def evaluate(self) -> tuple[Column, Column, Column]:
        raise NotImplementedError

    def column(self) -> Column:
        return result(self.name, *self.evaluate())


def annotated(items: DataFrame, *filters: QualityFilter, short_circuit: bool = False) -> DataFrame:
    """``items`` with ``results`` of user filters, in order, and ``would_pass``."""
    out = items.withColumn("results", chain(*[f.column() for f in filters], short_circuit=short_circuit))
    return out.withColumn("would_pass", would_pass(F.col("results")))


def verdicts(items: DataFrame, scripts=T.SCRIPTS, short_circuit: bool = False, more: tuple[str, ...] = ()) -> DataFrame:
    """item_id, language, task, would_pass, failed, results of the deterministic chain, and
    after it the results in the columns ``more`` of ``items``."""
    x = gated(items, scripts).select(F.col("id").alias("item_id"), F.col("target_language").alias("language"), F.col("task_family").alias("task"), "structural", "language_id", *more)
    got = x.withColumn("results", chain(F.col("structural"), F.col("language_id"), *[F.col(c) for c in more], short_circuit=short_circuit))
    return got.select("item_id", "language", "task", would_pass(F.col("results")).alias("would_pass"), failed_filters(F.col("results")).alias("failed"), "results")


def seed_drop_reason(prompt: Column, expected: Column, labels: Column, task: Column) -> Column:
    """The first rule that a candidate seed breaks, or null if it is accepted."""
    p, e = T.strip_ws(F.coalesce(prompt, F.lit(""))), T.strip_ws(F.coalesce(expected, F.lit("")))
    labels = labels.cast("array<string>")
    shown = F.size(F.filter(labels, lambda x: F.contains(F.lower(p), F.lower(x))))
    is_class = task == "classification"
    return (
        F.when(~F.length(p).between(SEED_MIN, SEED_MAX), "length")
        .when(p.rlike(f"[{T.char_class(TARGET_SCRIPT)}]"), "not_english")
        .when(task.isin(*SEED_NEEDS_ANSWER) & (e == ""), "missing_expected")
        .when(is_class & (F.coalesce(F.size(labels), F.lit(0)) < 2), "bad_labels")
        .when(is_class & (e == ""), "missing_expected")
        .when(is_class & ~F.coalesce(F.array_contains(labels, e), F.lit(False)), "expected_not_in_labels")
        .when(is_class & (shown < 2), "options_not_in_prompt")
        .when(~task.isin("instruction", "qa", "classification", "summarization", "translation", "reasoning"), "invalid_schema")
    )


def rating_reject_reason(r: dict[str, Column] | None = None) -> Column:
    """Why a submitted rating is refused, or null: ids and language are required, scores
    are whole numbers from 1 to 4, and faithfulness may be absent."""
    c = r or {k: F.col(k) for k in ("task_id", "rater_id", "language", "fluency", "faithfulness", "bias")}
    missing = F.lit(False)
    for k in ("task_id", "rater_id", "language"):
        missing = missing | (F.coalesce(c[k].cast("string"), F.lit("")) == "")
    whole = lambda x: x.between(1, 4) & (x == F.floor(x))
    bad = F.when(~F.coalesce(whole(c["fluency"]), F.lit(False)), "fluency").when(~F.coalesce(whole(c["bias"]), F.lit(False)), "bias").when(~F.coalesce(whole(c["faithfulness"]), F.lit(True)), "faithfulness")
    return F.when(missing, "missing task_id/rater_id/language").when(bad.isNotNull(), F.concat(bad, F.lit(" must be an integer 1-4")))


def human_accepts(fluency: Column, faithfulness: Column, bias: Column) -> Column:
    """No axis at 2 or below; an axis not asked for is skipped."""
    return F.least(fluency, faithfulness, bias) > 2


def axis_shown(needs_source: Column, has_source: Column, axis: Column) -> Column:
    """Whether the second phase of a rating shows an axis."""
    return needs_source & (has_source | (axis != "faithfulness"))


def plausible_pace(started: Column, submitted: Column, least_seconds: float) -> Column:
    return (F.unix_micros(submitted.cast("timestamp")) - F.unix_micros(started.cast("timestamp"))) / 1e6 >= least_seconds
