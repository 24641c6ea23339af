"""Named queries over the driver's tables and the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import aggregates as A
from ..operators import agreement as G
from ..operators import gates, joins
from ..operators import windows as W
from ..sources import readers, sinks
from .roles import ITEMS_SQL, SCORES_SQL, attempts, items, pairs, scores, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
FLAGSHIP = "retention_rollup"

_WS = T.WS.replace("'", "''")


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"



def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


# ------------------------------------------------------------------ gates (F1-F8, A1)
_GATES_SQL = f"""{ITEMS_SQL},
stripped AS (SELECT *, {_strip("prompt")} AS p, {_strip("coalesce(expected, '')")} AS e FROM items),
toks AS (SELECT *, CASE WHEN p = '' THEN []::VARCHAR[] ELSE regexp_split_to_array(p, '{_WS}+') END AS t FROM stripped),
fracs AS (SELECT *, CASE WHEN len(t) = 0 THEN 0::DOUBLE ELSE 1 - len(list_distinct(t))::DOUBLE / len(t) END AS frac FROM toks),
viol AS (SELECT *, list_filter([
   CASE WHEN p = '' THEN 'empty prompt' WHEN length(p) < 5 THEN 'prompt under 5 chars' WHEN length(p) > 8000 THEN 'prompt over 8000 chars' END,
   CASE WHEN task_family IN ('qa','classification','translation') AND e = '' THEN task_family || ' item missing ''expected'' answer' END,
   CASE WHEN e <> '' AND e = p THEN 'expected duplicates prompt (no-op generation)' END,
   CASE WHEN starts_with(p, '{{') OR contains(p, '"prompt"') THEN 'prompt contains raw JSON scaffolding' END,
   CASE WHEN contains(p, '```') THEN 'prompt contains markdown code fence' END,
   CASE WHEN length(p) > 40 AND NOT contains('.?!।॥۔؟…"'')]}}', right(p, 1)) THEN 'possible truncation (no terminal punctuation)' END,
   CASE WHEN len(t) >= 8 AND frac > 0.75::DOUBLE THEN CAST(CAST(round_even(100 * frac, 0) AS INT) AS VARCHAR) || '% of tokens repeat (>75%)' END], lambda x: x IS NOT NULL) AS v FROM fracs),
conf AS (SELECT *, CASE WHEN coalesce(expected, '') <> '' THEN prompt || chr(10) || expected ELSE prompt END AS whole FROM viol),
gated AS (SELECT *, CASE WHEN length(regexp_replace(whole, '[^\\p{{L}}]', '', 'g')) > 0
   THEN length(regexp_replace(whole, '[^A-Za-z]', '', 'g'))::DOUBLE / length(regexp_replace(whole, '[^\\p{{L}}]', '', 'g')) ELSE 0 END AS c FROM conf),
judged AS (SELECT id, target_language AS language, task_family AS task, source, v, len(v) = 0 AS s_ok, greatest(0, 1 - 0.5::DOUBLE * len(v)) AS s_score,
   c, (task_family = 'translation' OR c >= 0.75::DOUBLE) AS l_ok FROM gated)"""


def _verdicts(spark, d, **k):
    return gates.verdicts(items(spark, d), T.ASCII_SCRIPTS, **k)


@query(f"WITH {_GATES_SQL} SELECT id AS item_id, s_ok AS passed, s_score AS score, CASE WHEN len(v) > 0 THEN array_to_string(v, '; ') END AS reason FROM judged")
def structural_gate(spark, d):
    return gates.gated(items(spark, d), T.ASCII_SCRIPTS).select(F.col("id").alias("item_id"), "structural.passed", "structural.score", "structural.reason")


@query(f"""WITH {_GATES_SQL}, s AS (SELECT *, CAST(CAST(round_even(100 * c, 0) AS INT) AS VARCHAR) || '%' AS pc FROM judged)
SELECT id AS item_id, l_ok AS passed, round(c, 6) AS score, CASE WHEN task = 'translation' THEN 'exempt (translation): source-language text expected; ' || pc || ' in ' || language || ' script'
  WHEN NOT l_ok THEN 'only ' || pc || ' of letters in ' || language || ' script (<75%)' END AS reason FROM s""")
def language_gate(spark, d):
    x = gates.gated(items(spark, d), T.ASCII_SCRIPTS).withColumnRenamed("language_id", "r")
    return x.select(F.col("id").alias("item_id"), "r.passed", F.round("r.score", 6).alias("score"), "r.reason")


@query(f"WITH {_GATES_SQL} SELECT id AS item_id, s_ok AND l_ok AS would_pass, array_to_string(list_filter([CASE WHEN NOT s_ok THEN 'structural' END, CASE WHEN NOT l_ok THEN 'language_id' END], lambda x: x IS NOT NULL), ',') AS failed FROM judged")
def chain_verdicts(spark, d):
    return _verdicts(spark, d).select("item_id", "would_pass", F.array_join("failed", ",").alias("failed"))


@query(f"WITH {_GATES_SQL} SELECT id AS item_id, CASE WHEN s_ok THEN 'structural,language_id' ELSE 'structural' END AS ran FROM judged")
def chain_short_circuit(spark, d):
    return _verdicts(spark, d, short_circuit=True).select("item_id", F.array_join(F.transform("results", lambda r: r["filter"]), ",").alias("ran"))


@query(f"""WITH {_GATES_SQL}, long AS (SELECT language, task, unnest(['structural','language_id','chain']) AS filter, unnest([s_ok, l_ok, s_ok AND l_ok]) AS ok FROM judged)
SELECT CAST(2 - grouping(language) - grouping(task) AS INT) AS level, language, task, filter, count(*) FILTER (ok) AS passed, count(*) AS total,
       round(count(*) FILTER (ok) / count(*)::DOUBLE, 6) AS rate FROM long GROUP BY filter, ROLLUP(language, task)""")
def retention_rollup(spark, d):
    return A.retention(_verdicts(spark, d)).select("level", "language", "task", "filter", "passed", "total", F.round("rate", 6).alias("rate"))


@query(f"WITH {_GATES_SQL} SELECT task, count(*) AS total, count(*) FILTER (NOT s_ok) AS fails FROM judged GROUP BY task")
def audit_structural(spark, d):
    return A.structural_fails(_verdicts(spark, d))


@query(f"""WITH {_GATES_SQL}, s AS (SELECT item_id, avg(fluency + faithfulness + bias) / 3 AS overall FROM (SELECT * FROM (WITH {SCORES_SQL} SELECT * FROM scores)) GROUP BY 1)
SELECT id AS item_id, TRUE AS passed, round(coalesce(overall, 0), 6) AS score, CASE WHEN overall IS NULL THEN 'judge unavailable: no score' END AS reason FROM judged LEFT JOIN s ON id = item_id""")
def judge_filter(spark, d):
    e = A.ensemble(scores(spark, d)).select(F.col("item_id").alias("k"), "overall")
    r = gates.llm_judge(F.col("overall"), F.lit(True))
    return items(spark, d).join(e, F.col("id") == F.col("k"), "left").select(F.col("id").alias("item_id"), r.alias("r")).select("item_id", "r.passed", F.round("r.score", 6).alias("score"), "r.reason")


# ------------------------------------------------------------------ text functions
@query(f"SELECT norm, count(*) AS n, min(doc_id) AS first_id FROM (SELECT doc_id, trim(regexp_replace(lower(text), '{_WS}+', ' ', 'g')) AS norm FROM documents) GROUP BY norm")
def norm_dedup(spark, d):
    return table(spark, d, "documents").groupBy(T.norm_key(F.col("text")).alias("norm")).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"))


@query(f"SELECT doc_id, len(t) AS n_tokens, len(list_distinct(t)) AS n_distinct FROM (SELECT doc_id, CASE WHEN p = '' THEN []::VARCHAR[] ELSE regexp_split_to_array(p, '{_WS}+') END AS t FROM (SELECT doc_id, {_strip('text')} AS p FROM documents))")
def token_stats(spark, d):
    t = T.tokens(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.size(t).cast("long").alias("n_tokens"), F.size(F.array_distinct(t)).cast("long").alias("n_distinct"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_salvage(spark, d):
    from ..functions.salvage import object_candidate

    raw = F.concat(F.lit("<think>{x}</think>```json\n"), F.col("props"), F.lit("\n```"))
    return table(spark, d, "events").select("event_id", F.get_json_object(object_candidate(raw), "$.k").cast("long").alias("k"))


@query("""SELECT event_id, 'syn-hi-qa-' || CAST(event_id % 7 AS VARCHAR) || '-' || CASE WHEN event_id < 1000 THEN lpad(CAST(event_id AS VARCHAR), 3, '0') ELSE CAST(event_id AS VARCHAR) END AS item,
  'org_' || event_type || '_v' || CAST(event_id % 3 AS VARCHAR) AS slug, event_type || ':v' || CAST(event_id % 3 AS VARCHAR) AS short FROM events""")
def identifiers(spark, d):
    e = table(spark, d, "events")
    item = F.concat(T.synthetic_id(F.lit("hi"), F.concat(F.lit("seed-qa-"), (F.col("event_id") % 7).cast("string"))), F.lit("-"), T.padded(F.col("event_id"), 3))
    model = F.concat(F.lit("org/"), "event_type", F.lit(":v"), (F.col("event_id") % 3).cast("string"))
    return e.select("event_id", item.alias("item"), T.model_slug(model).alias("slug"), T.short_name(model).alias("short"))


@query("SELECT event_id, CASE WHEN isnan(value) THEN 1 ELSE greatest(0, least(1, value)) END AS score FROM events")
def clamp_scores(spark, d):
    return table(spark, d, "events").select("event_id", T.clamp01(F.col("value")).alias("score"))


@query("""SELECT a.vec_id, round(list_sum(list_transform(range(1, len(a.embedding) + 1), lambda i: a.embedding[i]::DOUBLE * b.embedding[i]::DOUBLE))
  / (sqrt(list_sum(list_transform(a.embedding, lambda x: x::DOUBLE * x::DOUBLE))) * sqrt(list_sum(list_transform(b.embedding, lambda x: x::DOUBLE * x::DOUBLE)))), 6) AS cos
  FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def cosine_neighbours(spark, d):
    e = table(spark, d, "embeddings")
    b = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return e.join(b, "vec_id").select("vec_id", F.round(T.cosine(F.col("embedding"), F.col("other")), 6).alias("cos"))


# ------------------------------------------------------------------ scans and joins
@query("SELECT conv_id, turn, prompt, expected FROM (SELECT conv_id, turn, role, text AS prompt, lead(role) OVER w AS nr, lead(text) OVER w AS expected FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'user' AND nr = 'assistant'")
def conversation_pairs(spark, d):
    return pairs(spark, d)


@query("SELECT conv_id, turn, prompt || chr(10) || expected AS text FROM (SELECT conv_id, turn, role, text AS prompt, lead(role) OVER w AS nr, lead(text) OVER w AS expected FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'user' AND nr = 'assistant' AND expected <> ''")
def pair_texts(spark, d):
    return pairs(spark, d).where("expected <> ''").select("conv_id", "turn", T.with_answer(F.col("prompt"), F.col("expected")).alias("text"))


@query(f"WITH {ITEMS_SQL} SELECT target_language, task_family, count(DISTINCT id) AS n FROM items GROUP BY ALL")
def existing_counts(spark, d):
    return readers.existing_counts(items(spark, d))


@query(f"WITH {ITEMS_SQL} SELECT DISTINCT seed_id, target_language, task_family FROM items")
def generated_keys(spark, d):
    return items(spark, d).select("seed_id", "target_language", "task_family").dropna().distinct()


@query(f"WITH {ITEMS_SQL} SELECT id, target_language FROM items WHERE task_family <> 'translation'")
def scan_without_translation(spark, d):
    return readers.without_translation(items(spark, d)).select("id", "target_language")


@query("SELECT doc_id AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def unscored_anti(spark, d):
    return joins.unscored(table(spark, d, "documents").select(F.col("doc_id").alias("id")), table(spark, d, "labels").select(F.col("doc_id").alias("id")))


@query(f"WITH {ITEMS_SQL} SELECT count(*) AS orphans FROM items WHERE seed_id NOT IN (SELECT 'seed-' || CAST(item_id AS VARCHAR) FROM benchmark)")
def orphan_items(spark, d):
    seeds = table(spark, d, "benchmark").select(F.concat(F.lit("seed-"), F.col("item_id").cast("string")).alias("id"))
    return joins.orphan_count(items(spark, d), seeds)


@query("SELECT user_id, min_by(event_type, event_id) AS kind FROM events WHERE event_type <> 'error' GROUP BY user_id")
def first_wins(spark, d):
    prompt = F.when(F.col("event_type") == "error", "[mock] x").otherwise("x")  # mock seeds are what merging drops
    p = table(spark, d, "events").select(F.col("user_id").alias("id"), F.lit("a").alias("file"), F.col("event_id").alias("pos"), prompt.alias("prompt"), F.col("event_type").alias("kind"))
    return readers.merge_pools(p).select(F.col("id").alias("user_id"), "kind")


@query("SELECT user_id, max_by(value, event_id) AS value FROM events GROUP BY user_id")
def last_wins(spark, d):
    rows = table(spark, d, "events").select(F.array(F.lit("a")).alias("file"), F.col("event_id").alias("line"), F.struct("user_id", "value").alias("r"))
    return readers.last_wins(rows, "user_id")


_SEEDS_SQL = "seeds AS (SELECT 'seed-' || CAST(item_id AS VARCHAR) AS id, ['qa','reasoning'][CAST(item_id % 2 + 1 AS INT)] AS task_family, CAST(item_id // 2 AS BIGINT) AS pos FROM benchmark)"


def _seeds(spark, d):
    return table(spark, d, "benchmark").select(F.concat(F.lit("seed-"), F.col("item_id").cast("string")).alias("id"), F.element_at(F.array(F.lit("qa"), F.lit("reasoning")), (F.col("item_id") % 2 + 1).cast("int")).alias("task_family"), F.floor(F.col("item_id") / 2).cast("long").alias("pos"))


@query(f"WITH {_SEEDS_SQL} SELECT task_family, id, CAST(i AS BIGINT) AS idx FROM (SELECT *, count(*) OVER (PARTITION BY task_family) AS n FROM seeds), range(0, 30) t(i) WHERE i % n = pos")
def cycle_seeds(spark, d):
    return joins.cycled(_seeds(spark, d), 30).select("task_family", "id", "idx")


@query(f"""WITH {_SEEDS_SQL}, {ITEMS_SQL}, langs AS (SELECT * FROM (VALUES ('en', 0), ('fr', 1), ('de', 2)) v(target_language, lang_pos))
SELECT task_family, target_language, id AS seed_id, pos AS idx FROM seeds, langs l WHERE NOT EXISTS
  (SELECT 1 FROM items i WHERE i.seed_id = seeds.id AND i.target_language = l.target_language AND i.task_family = seeds.task_family)""")
def plan_jobs(spark, d):
    langs = spark.createDataFrame([("en", 0), ("fr", 1), ("de", 2)], "target_language string, lang_pos int")
    return joins.plan_jobs(_seeds(spark, d), langs, generated_keys(spark, d)).select("task_family", "target_language", "seed_id", "idx")


@query(f"""WITH {ITEMS_SQL}, {SCORES_SQL}, judges AS (SELECT * FROM (VALUES ('org/j0'), ('org/j1'), ('org/j3')) v(judge))
SELECT id AS item_id, seed_id, judge FROM items, judges j WHERE NOT EXISTS (SELECT 1 FROM scores s WHERE s.item_id = items.id AND s.judge = j.judge)
  AND seed_id IN (SELECT 'seed-' || CAST(item_id AS VARCHAR) FROM benchmark)""")
def judge_work(spark, d):
    judges = spark.createDataFrame([("org/j0",), ("org/j1",), ("org/j3",)], "judge string")
    seeds = table(spark, d, "benchmark").select(F.concat(F.lit("seed-"), F.col("item_id").cast("string")).alias("id"))
    return joins.judge_work(items(spark, d), judges, readers.done_pairs(scores(spark, d)), seeds).select("item_id", "seed_id", "judge")


_NORM = f"trim(regexp_replace(lower(text), '{_WS}+', ' ', 'g'))"


@query(f"SELECT doc_id AS id FROM documents WHERE {_NORM} IN (SELECT {_NORM} FROM documents WHERE lang = 'en')")
def known_seed_prompts(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("prompt"), "lang")
    return joins.known_seeds(docs, docs.where("lang = 'en'"), T.norm_key).select("id")


# ------------------------------------------------------------------ scores and reports
@query(f"WITH {SCORES_SQL} SELECT item_id, round(avg(fluency), 6) AS fluency, round(avg(faithfulness), 6) AS faithfulness, round(avg(bias), 6) AS bias, 'ensemble[mean]:' || array_to_string(list_sort(list_distinct(list(judge))), ',') AS judge_model, CAST(count(*) AS VARCHAR) || ' judge(s)' AS judge_rationale FROM scores GROUP BY item_id")
def ensemble_mean(spark, d):
    return A.ensemble(scores(spark, d)).select("item_id", *[F.round(a, 6).alias(a) for a in A.AXES], "judge_model", "judge_rationale")


@query(f"WITH {SCORES_SQL} SELECT item_id, round(median(fluency), 6) AS fluency, round(median(faithfulness), 6) AS faithfulness, round(median(bias), 6) AS bias FROM scores GROUP BY item_id")
def ensemble_median(spark, d):
    return A.ensemble(scores(spark, d), "median").select("item_id", *[F.round(a, 6).alias(a) for a in A.AXES])


@query(f"WITH {SCORES_SQL} SELECT item_id, CASE WHEN count(fluency) > 1 THEN round(max(fluency) - min(fluency), 6) END AS spread FROM scores GROUP BY item_id")
def judge_spread(spark, d):
    return A.spread(scores(spark, d), "fluency").select("item_id", F.round("spread", 6).alias("spread"))


@query("""WITH n AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY event_type) AS c FROM events)
SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean, round(median(value), 6) AS median, round(min(value), 6) AS min, round(max(value), 6) AS max, round(max(value) FILTER (i = c // 10), 6) AS p10 FROM n GROUP BY event_type""")
def audit_distribution(spark, d):
    a = A.audit(table(spark, d, "events"), ["event_type"], "value")
    return a.select("event_type", "n", *[F.round(c, 6).alias(c) for c in ("mean", "median", "min", "max", "p10")])


@query("SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.1), 6) AS p10, round(quantile_cont(value, 0.9), 6) AS p90 FROM events GROUP BY ROLLUP(event_type)")
def score_distribution(spark, d):
    return A.distribution(table(spark, d, "events"), "event_type", "value").select("event_type", "n", *[F.round(c, 6).alias(c) for c in ("mean", "median", "p10", "p90")])


@query(f"WITH {SCORES_SQL}, n AS (SELECT item_id, count(DISTINCT judge) AS j FROM scores GROUP BY 1) SELECT lang AS language, count(*) AS items, count(*) FILTER (j >= 1) AS judged, count(*) FILTER (j >= 2) AS ensemble FROM documents LEFT JOIN n ON doc_id = item_id GROUP BY lang")
def coverage(spark, d):
    return A.coverage(table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("language")), scores(spark, d))


@query(f"WITH {SCORES_SQL}, m AS (SELECT item_id, avg((fluency + faithfulness + bias) / 3) AS o, count(DISTINCT judge) AS j FROM scores GROUP BY 1) SELECT round(avg(o), 6) AS mean, count(*) AS items, count(*) FILTER (j >= 2) AS multi, count(*) FILTER (o < 0.4507::DOUBLE) AS low FROM m")
def two_level_ensemble(spark, d):
    return A.ensemble_overview(scores(spark, d), 0.4507).withColumn("mean", F.round("mean", 6))


@query(f"WITH {SCORES_SQL} SELECT split_part(judge, '/', -1) AS judge, count(*) AS n, round(avg(fluency), 6) AS fluency, round(min(bias), 6) AS bias_min FROM scores GROUP BY 1")
def judge_coverage(spark, d):
    return scores(spark, d).groupBy(T.short_name(F.col("judge")).alias("judge")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("fluency"), 6).alias("fluency"), F.round(F.min("bias"), 6).alias("bias_min"))


@query("SELECT label AS tier, round(max(CASE WHEN vec_id % 3 = 0 THEN vec_id / 1000.0::DOUBLE END), 6) AS j0, round(max(CASE WHEN vec_id % 3 = 1 THEN vec_id / 1000.0::DOUBLE END), 6) AS j1 FROM embeddings GROUP BY label")
def tier_pivot(spark, d):
    e = table(spark, d, "embeddings").select(F.col("label").alias("tier"), F.concat(F.lit("j"), (F.col("vec_id") % 3).cast("string")).alias("judge"), (F.col("vec_id") / 1000).alias("fluency"))
    top = e.groupBy("tier", "judge").agg(F.round(F.max("fluency"), 6).alias("fluency"))
    return A.tier_pivot(top, ["j0", "j1"])


_REV = "reviews AS (SELECT lang AS language, CASE WHEN doc_id % 17 = 0 THEN 'defect' WHEN doc_id % 5 = 0 THEN 'minor' ELSE 'ok' END AS verdict, CASE WHEN doc_id % 17 = 0 THEN ['format', 'meaning'] WHEN doc_id % 5 = 0 THEN ['format'] ELSE []::VARCHAR[] END AS categories FROM documents)"


def _reviews(spark, d):
    k = F.col("doc_id")
    verdict = F.when(k % 17 == 0, "defect").when(k % 5 == 0, "minor").otherwise("ok")
    cats = F.when(k % 17 == 0, F.array(F.lit("format"), F.lit("meaning"))).when(k % 5 == 0, F.array(F.lit("format"))).otherwise(F.array().cast("array<string>"))
    return table(spark, d, "documents").select(F.col("lang").alias("language"), verdict.alias("verdict"), cats.alias("categories"))


@query(f"WITH {_REV} SELECT language, category, count(*) AS n FROM (SELECT language, unnest(categories) AS category FROM reviews) GROUP BY ALL")
def error_taxonomy(spark, d):
    return A.taxonomy(_reviews(spark, d))


@query(f"WITH {_REV} SELECT language, count(*) AS n, count(*) FILTER (verdict = 'defect') AS defects, round(count(*) FILTER (verdict = 'defect') / count(*)::DOUBLE, 6) AS rate FROM reviews GROUP BY language")
def defect_rate(spark, d):
    return A.defect_rate(_reviews(spark, d)).withColumn("rate", F.round("rate", 6))


_CAND = """cand AS (SELECT doc_id, ['classification','qa','reasoning','instruction'][CAST(doc_id % 4 + 1 AS INT)] AS task_family, text AS prompt,
  CASE WHEN doc_id % 3 = 0 THEN 'the' WHEN doc_id % 3 = 1 THEN 'zzz' END AS expected, CASE WHEN doc_id % 5 = 0 THEN ['the'] WHEN doc_id % 7 = 0 THEN ['qqq','the'] ELSE ['the','a'] END AS labels FROM documents)"""


@query(f"""WITH {_CAND}, s AS (SELECT *, {_strip("prompt")} AS p, coalesce(expected, '') AS e FROM cand)
SELECT doc_id, CASE WHEN NOT length(p) BETWEEN 10 AND 2000 THEN 'length' WHEN task_family IN ('qa','reasoning') AND e = '' THEN 'missing_expected'
  WHEN task_family = 'classification' AND len(labels) < 2 THEN 'bad_labels' WHEN task_family = 'classification' AND e = '' THEN 'missing_expected'
  WHEN task_family = 'classification' AND NOT list_contains(labels, e) THEN 'expected_not_in_labels'
  WHEN task_family = 'classification' AND len(list_filter(labels, lambda l: contains(lower(p), lower(l)))) < 2 THEN 'options_not_in_prompt' END AS drop_reason FROM s""")
def seed_acceptance(spark, d):
    return candidates(spark, d).select("doc_id", gates.seed_drop_reason(F.col("prompt"), F.col("expected"), F.col("labels"), F.col("task_family")).alias("drop_reason"))


def candidates(spark, d):
    """Documents as seeds to accept."""
    k = F.col("doc_id")
    return table(spark, d, "documents").select(
        "doc_id", F.element_at(F.array(*map(F.lit, ("classification", "qa", "reasoning", "instruction"))), (k % 4 + 1).cast("int")).alias("task_family"), F.col("text").alias("prompt"),
        F.when(k % 3 == 0, "the").when(k % 3 == 1, "zzz").alias("expected"), F.when(k % 5 == 0, F.array(F.lit("the"))).when(k % 7 == 0, F.array(F.lit("qqq"), F.lit("the"))).otherwise(F.array(F.lit("the"), F.lit("a"))).alias("labels"),
    )


# ------------------------------------------------------------------ windows
def _gold_scores(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("language"), F.col("n_chars").cast("double").alias("overall"))


@query("""WITH s AS (SELECT doc_id AS id, lang AS language, n_chars::DOUBLE AS overall FROM documents),
m AS (SELECT *, median(overall) OVER (PARTITION BY language) AS med, count(*) OVER (PARTITION BY language) AS pool FROM s),
t AS (SELECT *, least(60, pool) AS take, CAST(round_even(least(60, pool) * 0.3::DOUBLE, 0) AS INT) AS nn FROM m),
r AS (SELECT *, row_number() OVER (PARTITION BY language ORDER BY abs(overall - med), id) <= take - nn AS border FROM t),
p AS (SELECT *, row_number() OVER (PARTITION BY language, border ORDER BY md5('7:' || CAST(id AS VARCHAR)), id) AS pick FROM r)
SELECT id, language, overall, CASE WHEN border THEN 'borderline' ELSE 'normal' END AS stratum FROM p WHERE border OR pick <= nn""")
def gold_select(spark, d):
    return W.select_gold(_gold_scores(spark, d), 60, 0.3, "7")


@query("""WITH x AS (SELECT doc_id AS id, lang AS language, row_number() OVER (PARTITION BY lang ORDER BY md5('7:' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS idx,
  row_number() OVER (PARTITION BY lang ORDER BY md5('7/overlap:' || CAST(doc_id AS VARCHAR)), doc_id) AS pick, count(*) OVER (PARTITION BY lang) AS n FROM documents)
SELECT id, language, pick <= ceil(0.2::DOUBLE * n) AS overlap, CASE WHEN pick <= ceil(0.2::DOUBLE * n) THEN ['a','b','c'][idx % 3 + 1] || ',' || ['a','b','c'][(idx + 1) % 3 + 1] ELSE ['a','b','c'][idx % 3 + 1] END AS raters FROM x""")
def rater_assignment(spark, d):
    return W.assign_raters(_gold_scores(spark, d), ["a", "b", "c"], 0.2, "7").select("id", "language", "overlap", F.array_join("raters", ",").alias("raters"))


@query("SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS turn FROM documents")
def round_robin_interleave(spark, d):
    return W.interleave(table(spark, d, "documents").select("doc_id", "lang", "n_chars"), "lang", [F.desc("n_chars"), F.asc("doc_id")], F.coalesce(-F.col("n_chars"), F.lit(1))).select("doc_id", "lang", F.col("turn").cast("long").alias("turn"))


@query("""WITH l AS (SELECT user_id % 40 AS judge, ts, event_id, event_type = 'error' AS f FROM events),
g AS (SELECT *, sum(CASE WHEN f THEN 0 ELSE 1 END) OVER (PARTITION BY judge ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS isl FROM l),
s AS (SELECT *, sum(CASE WHEN f THEN 1 ELSE 0 END) OVER (PARTITION BY judge, isl ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS st FROM g),
w AS (SELECT judge, event_id, row_number() OVER (PARTITION BY judge ORDER BY ts, event_id) AS rn FROM s WHERE st >= 4) SELECT judge, event_id FROM w WHERE rn = 1""")
def congested_judges(spark, d):
    return W.congested(attempts(spark, d))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, row_number() OVER (PARTITION BY strftime(ts, '%Y-%m-%d') ORDER BY ts, event_id) AS attempt FROM events QUALIFY attempt <= 50")
def daily_quota(spark, d):
    return W.within_budget(attempts(spark, d), 50).select("event_id", "day", F.col("attempt").cast("long").alias("attempt"))


@query("""WITH r AS (SELECT user_id AS rater_id, event_id % 20 AS task_id, event_type AS language, round(value, 6) AS score, ts, event_id FROM events)
SELECT rater_id, task_id, arg_min(language, ts + to_microseconds(0)) AS language, arg_max(score, ts) AS score FROM (SELECT *, row_number() OVER (PARTITION BY rater_id, task_id ORDER BY ts, event_id) AS a FROM r) GROUP BY ALL""")
def ratings_latest(spark, d):
    r = table(spark, d, "events").select(F.col("user_id").alias("rater_id"), (F.col("event_id") % 20).alias("task_id"), F.col("event_type").alias("language"), F.round("value", 6).alias("score"), F.col("ts").alias("submitted_at"), F.col("event_id").alias("seq"))
    return sinks.upserted(r).select("rater_id", "task_id", "language", "score")


@query("""WITH free AS (SELECT 'seed-qa-bs-' || lpad(CAST(i AS VARCHAR), 4, '0') AS new_id, row_number() OVER (ORDER BY i) AS rk FROM range(1, 61 + (SELECT count(*) FROM benchmark)) t(i) WHERE i % 3 <> 0 OR i > 60)
SELECT item_id AS key, new_id FROM (SELECT item_id, row_number() OVER (ORDER BY item_id) AS rk FROM benchmark) JOIN free USING (rk)""")
def id_allocation(spark, d):
    taken = spark.range(1, 61).where("id % 3 = 0").select(F.format_string("seed-qa-bs-%04d", "id").alias("id"))
    return W.allocate_ids(table(spark, d, "benchmark").select(F.col("item_id").alias("key")), taken, "seed-qa-bs-")


@query("SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents) WHERE rn <= 2")
def first_samples(spark, d):
    return W.first_n(table(spark, d, "documents").select("source", "doc_id"), "source", ["doc_id"], 2)


# ------------------------------------------------------------------ agreement
def _human(spark, d):
    lab = table(spark, d, "labels").where("quality IS NOT NULL")
    return table(spark, d, "documents").join(lab, "doc_id").select("doc_id", "lang", "quality", "n_chars")


_HUMAN = "h AS (SELECT d.doc_id, lang, quality, n_chars FROM documents d JOIN labels l USING (doc_id) WHERE quality IS NOT NULL)"


@query(f"""WITH {_HUMAN}, r AS (SELECT lang, rank() OVER (PARTITION BY lang ORDER BY quality) + (count(*) OVER (PARTITION BY lang, quality) - 1) / 2.0::DOUBLE AS a,
  rank() OVER (PARTITION BY lang ORDER BY n_chars) + (count(*) OVER (PARTITION BY lang, n_chars) - 1) / 2.0::DOUBLE AS b FROM h)
SELECT lang, round(CASE WHEN isnan(corr(a, b)) THEN NULL ELSE corr(a, b) END, 6) AS rho FROM r GROUP BY lang""")
def spearman(spark, d):
    return G.spearman(_human(spark, d).select("lang", F.col("quality").alias("x"), F.col("n_chars").alias("y")), "lang").select("lang", F.round("rho", 6).alias("rho"))


@query("""WITH x AS (SELECT CAST(n_chars % 4 AS INT) AS a, CAST((n_chars + doc_id % 2) % 4 AS INT) AS b FROM documents), o AS (SELECT a, b, count(*) AS o FROM x GROUP BY ALL),
ra AS (SELECT a, sum(o) AS ra FROM o GROUP BY a), rb AS (SELECT b, sum(o) AS rb FROM o GROUP BY b)
SELECT round(1 - sum((ra.a - rb.b) * (ra.a - rb.b) * coalesce(o, 0))::DOUBLE / sum((ra.a - rb.b) * (ra.a - rb.b) * ra * rb / (SELECT sum(o)::DOUBLE FROM o)), 6) AS kappa
FROM ra CROSS JOIN rb LEFT JOIN o ON o.a = ra.a AND o.b = rb.b""")
def quadratic_kappa(spark, d):
    x = table(spark, d, "documents").select((F.col("n_chars") % 4).cast("int").alias("a"), ((F.col("n_chars") + F.col("doc_id") % 2) % 4).cast("int").alias("b"))
    return G.quadratic_kappa(x).select(F.round("kappa", 6).alias("kappa"))


@query("""WITH v AS (SELECT event_id // 2 AS unit, value FROM events), p AS (SELECT a.value AS x, b.value AS y FROM (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY value) AS i FROM v) a
  JOIN (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY value) AS i FROM v) b ON a.unit = b.unit AND a.i <> b.i), n AS (SELECT count(*) AS n, sum(value) AS s, sum(value * value) AS q FROM v WHERE unit IN (SELECT unit FROM v GROUP BY unit HAVING count(*) > 1))
SELECT round(1 - (SELECT sum((x - y) * (x - y)) FROM p) / ((2 * n * q - 2 * s * s) / (n - 1)), 5) AS alpha FROM n""")
def krippendorff(spark, d):
    return G.krippendorff_interval(table(spark, d, "events").select(F.floor(F.col("event_id") / 2).alias("unit"), "value")).select(F.round("alpha", 5).alias("alpha"))


_ROC = f"{_HUMAN}, c AS (SELECT n_chars AS score, count(*) FILTER (quality = 1) AS p, count(*) FILTER (quality <> 1) AS n FROM h GROUP BY 1), k AS (SELECT score, sum(p) OVER (ORDER BY score DESC) / (SELECT sum(p) FROM c)::DOUBLE AS tpr, sum(n) OVER (ORDER BY score DESC) / (SELECT sum(n) FROM c)::DOUBLE AS fpr FROM c)"


@query(f"WITH {_ROC} SELECT score, round(tpr, 6) AS tpr, round(fpr, 6) AS fpr, round(tpr - fpr, 6) AS youden FROM k")
def roc_curve(spark, d):
    return G.roc(_human(spark, d).select(F.col("n_chars").alias("score"), (F.col("quality") == 1).alias("positive"))).select("score", *[F.round(c, 6).alias(c) for c in ("tpr", "fpr", "youden")])


@query(f"WITH {_ROC} SELECT arg_max(score, (tpr - fpr, score)) AS threshold, round(max(tpr - fpr), 6) AS youden FROM k")
def youden_threshold(spark, d):
    c = G.roc(_human(spark, d).select(F.col("n_chars").alias("score"), (F.col("quality") == 1).alias("positive")))
    return G.best_threshold(c).select("threshold", F.round("youden", 6).alias("youden"))


def _discrimination_pairs(spark, d):
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("language"), F.col("embedding").alias("vector"))
    return joins.mismatched(e).select(T.cosine(F.col("vector"), F.transform("vector", lambda x: x * F.lit(2.0) + F.lit(0.1))).alias("matched"), T.cosine(F.col("vector"), F.col("other")).alias("mismatched"))


@query("""WITH e AS (SELECT vec_id, embedding AS v, coalesce(lead(embedding) OVER w, first_value(embedding) OVER (PARTITION BY label ORDER BY vec_id)) AS o FROM embeddings WINDOW w AS (PARTITION BY label ORDER BY vec_id)),
f AS (SELECT list_transform(v, lambda x: x::DOUBLE) AS v, list_transform(v, lambda x: x::DOUBLE * 2 + 0.1::DOUBLE) AS m, list_transform(o, lambda x: x::DOUBLE) AS o FROM e),
c AS (SELECT list_dot_product(v, m) / sqrt(list_dot_product(v, v)) / sqrt(list_dot_product(m, m)) AS a, list_dot_product(v, o) / sqrt(list_dot_product(v, v)) / sqrt(list_dot_product(o, o)) AS b FROM f)
SELECT round(avg(a), 5) AS matched_mean, round(avg(b), 5) AS mismatched_mean, round(avg(a) - avg(b), 5) AS separation, count(*) FILTER (a <= (SELECT max(b) FROM c)) AS overlap FROM c""")
def discrimination(spark, d):
    out = A.discrimination(_discrimination_pairs(spark, d))
    return out.select(*[F.round(c, 5).alias(c) for c in ("matched_mean", "mismatched_mean", "separation")], "overlap")


@query("""SELECT event_id, CASE WHEN r1 IS NULL OR la IS NULL THEN 'missing task_id/rater_id/language' WHEN NOT (fl BETWEEN 1 AND 4 AND fl = floor(fl)) THEN 'fluency must be an integer 1-4'
  WHEN NOT bi BETWEEN 1 AND 4 THEN 'bias must be an integer 1-4' WHEN NOT coalesce(fa BETWEEN 1 AND 4, TRUE) THEN 'faithfulness must be an integer 1-4' END AS reason,
  least(coalesce(fl, fa, bi), coalesce(fa, fl, bi), coalesce(bi, fl, fa)) > 2 AS accepts
FROM (SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN 'r' END AS r1, CASE WHEN event_id % 13 <> 0 THEN 'hi' END AS la, (event_id % 12) / 2.0::DOUBLE AS fl, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id % 5 AS INT) END AS fa, CAST(event_id % 4 + 1 AS INT) AS bi FROM events)""")
def rating_validation(spark, d):
    k = F.col("event_id")
    cols = {"task_id": F.lit("t"), "rater_id": F.when(k % 11 != 0, "r"), "language": F.when(k % 13 != 0, "hi"), "fluency": (k % 12) / 2.0, "faithfulness": F.when(k % 3 != 0, (k % 5).cast("int")), "bias": (k % 4 + 1).cast("int")}
    return table(spark, d, "events").select("event_id", gates.rating_reject_reason(cols).alias("reason"), gates.human_accepts(cols["fluency"], cols["faithfulness"], cols["bias"]).alias("accepts"))


from . import more  # noqa: E402, F401  (adds its queries)
