"""More named queries: pools, predicates, text functions, reports and whole runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import drivers, models
from ..functions import salvage
from ..functions import text as T
from ..operators import aggregates as A
from ..operators import agreement as G
from ..operators import gates, joins, pools
from ..operators import windows as W
from ..sources import readers
from . import registry as R
from .roles import ITEMS_SQL, SCORES_SQL, items, scores, table

query = R.query
_SEED_ROWS = "seed_rows AS (SELECT 'seed-' || CAST(item_id AS VARCHAR) AS id, text AS prompt, 'Answer ' || CAST(item_id AS VARCHAR) AS expected, ['qa','reasoning'][CAST(item_id % 2 + 1 AS INT)] AS task_family, item_id FROM benchmark)"


def seed_rows(spark, d):
    k = F.col("item_id")
    task = F.element_at(F.array(F.lit("qa"), F.lit("reasoning")), (k % 2 + 1).cast("int"))
    return table(spark, d, "benchmark").select(
        F.concat(F.lit("seed-"), k.cast("string")).alias("id"), F.col("text").alias("prompt"), F.concat(F.lit("Answer "), k.cast("string")).alias("expected"), task.alias("task_family"),
        F.lit(None).cast("array<string>").alias("labels"), F.create_map(F.lit("domain"), F.lit("test")).alias("metadata"), F.floor(k / 2).cast("long").alias("pos"), "item_id",
    )


# ------------------------------------------------------------------ joins
@query(f"WITH {ITEMS_SQL}, {_SEED_ROWS} SELECT i.id, i.seed_id, s.expected AS seed_expected, s.id IS NOT NULL AS seed_known FROM items i LEFT JOIN seed_rows s ON i.seed_id = s.id")
def items_with_seeds(spark, d):
    x = joins.with_seed(items(spark, d), seed_rows(spark, d))
    return x.select("id", "seed_id", "seed_expected", F.coalesce("seed_known", F.lit(False)).alias("seed_known"))


@query(f"WITH {ITEMS_SQL} SELECT id, task_family FROM items WHERE id IN (SELECT doc_id FROM labels)")
def eligible_items(spark, d):
    return joins.eligible(items(spark, d), table(spark, d, "labels").select(F.col("doc_id").alias("item_id"))).select("id", "task_family")


@query(f"WITH {_SEED_ROWS}, judges AS (SELECT DISTINCT user_id % 5 AS judge FROM events) SELECT id, judge FROM seed_rows, judges")
def judge_panel(spark, d):
    judges = table(spark, d, "events").select((F.col("user_id") % 5).alias("judge")).distinct()
    return joins.panel(seed_rows(spark, d).select("id"), judges)


@query("""WITH r AS (SELECT event_id // 3 AS task_id, event_id % 3 AS rater_id, value FROM events)
SELECT a.task_id, a.rater_id AS rater_a, b.rater_id AS rater_b, round(a.value, 6) AS a, round(b.value, 6) AS b FROM r a JOIN r b ON a.task_id = b.task_id AND a.rater_id < b.rater_id""")
def rater_pairs(spark, d):
    r = table(spark, d, "events").select(F.floor(F.col("event_id") / 3).alias("task_id"), (F.col("event_id") % 3).alias("rater_id"), F.round("value", 6).alias("value"))
    return joins.rater_pairs(r, "value")


@query("SELECT CAST(event_id % 700 AS VARCHAR) AS task_id, event_id, 't' || CAST(event_id % 700 % 3 AS VARCHAR) AS teacher_model FROM events JOIN documents ON doc_id = event_id % 700")
def rating_provenance(spark, d):
    ratings = table(spark, d, "events").select((F.col("event_id") % 700).cast("string").alias("task_id"), "event_id")
    entry = F.struct(F.concat(F.lit("t"), (F.col("doc_id") % 700 % 3).cast("string")).alias("teacher_model"))
    manifest = table(spark, d, "documents").select(F.create_map(F.col("doc_id").cast("string"), entry).alias("provenance"))
    return joins.provenance(ratings, manifest).select("task_id", "event_id", "teacher_model")


# ------------------------------------------------------------------ pools
@query(f"WITH {ITEMS_SQL} SELECT id, task_family FROM items WHERE task_family = 'qa'")
def task_filter(spark, d):
    return pools.of_task(items(spark, d), "qa").select("id", "task_family")


@query(f"WITH {ITEMS_SQL} SELECT id, task_family FROM items WHERE task_family IN ('qa', 'reasoning')")
def task_list(spark, d):
    return pools.of_tasks(items(spark, d), "qa, reasoning").select("id", "task_family")


@query("SELECT event_id FROM events WHERE event_id % 4 > 0")
def current_rubric(spark, d):
    e = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 4 > 0, "v2").otherwise("v1").alias("instructions_version"))
    return pools.of_rubric(e, "v2").select("event_id")


@query("SELECT event_id, ts FROM events WHERE (event_id % 90) + 0.5 >= 30")
def plausible_pace(spark, d):
    e = table(spark, d, "events").select("event_id", "ts", F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + (F.col("event_id") % 90) * 1_000_000 + 500_000).alias("done"))
    return e.where(gates.plausible_pace(F.col("ts"), F.col("done"), 30.0)).select("event_id", "ts")


@query("""WITH a AS (SELECT event_id, ['fluency','faithfulness','bias'][CAST(event_id % 3 + 1 AS INT)] AS axis, event_id % 2 = 0 AS src FROM events)
SELECT event_id, axis, axis <> 'fluency' AND (src OR axis <> 'faithfulness') AS shown FROM a""")
def axis_visibility(spark, d):
    axis = F.element_at(F.array(*map(F.lit, A.AXES)), (F.col("event_id") % 3 + 1).cast("int"))
    e = table(spark, d, "events").select("event_id", axis.alias("axis"))
    return e.withColumn("shown", gates.axis_shown(F.col("axis") != "fluency", F.col("event_id") % 2 == 0, F.col("axis")))


@query(f"WITH {SCORES_SQL}, e AS (SELECT item_id, (avg(fluency) + avg(faithfulness) + avg(bias)) / 3 AS overall FROM scores GROUP BY 1) SELECT item_id, round(overall, 6) AS overall FROM e WHERE overall < 0.40003::DOUBLE")
def review_candidates(spark, d):
    return pools.low_scores(A.ensemble(scores(spark, d)), "overall", 0.40003).select("item_id", F.round("overall", 6).alias("overall"))


@query("SELECT item_id, text FROM benchmark ORDER BY item_id LIMIT 8")
def pool_head(spark, d):
    return pools.head(table(spark, d, "benchmark"), 8, "item_id").select("item_id", "text")


@query("""WITH r AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn, count(*) OVER (PARTITION BY source) AS n FROM documents)
SELECT source, n, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS examples FROM r WHERE rn <= 8 GROUP BY source, n""")
def fail_examples(spark, d):
    x = pools.examples(table(spark, d, "documents"), ["source"], "doc_id", 8)
    return x.select("source", "n", F.array_join(F.transform("examples", lambda v: v.cast("string")), ",").alias("examples"))


@query("SELECT lang, doc_id FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY md5('3:' || CAST(doc_id AS VARCHAR)), doc_id) AS rn FROM documents) WHERE rn <= 4")
def language_sample(spark, d):
    return pools.sampled(table(spark, d, "documents").select("lang", "doc_id"), "lang", "doc_id", 4, "3")


@query("SELECT doc_id AS id FROM documents UNION SELECT doc_id FROM labels UNION SELECT conv_id FROM conversations")
def known_ids(spark, d):
    ids = lambda name, c: table(spark, d, name).select(F.col(c).alias("id"))
    return pools.all_ids(ids("documents", "doc_id"), ids("labels", "doc_id"), ids("conversations", "conv_id"))


@query("SELECT item_id AS id, text, NULL AS lang FROM benchmark UNION ALL SELECT doc_id, text, lang FROM documents")
def united_pools(spark, d):
    return pools.united(table(spark, d, "benchmark").select(F.col("item_id").alias("id"), "text"), table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", "lang")).select("id", "text", "lang")


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'new' ELSE 'old' END AS template, 'd' AS domain FROM events")
def metadata_merge(spark, d):
    left = F.create_map(F.lit("template"), F.lit("old"), F.lit("domain"), F.lit("d"))
    right = F.when(F.col("event_id") % 2 == 0, F.create_map(F.lit("template"), F.lit("new")))
    return table(spark, d, "events").select("event_id", pools.merged_metadata(left, right).alias("m")).select("event_id", F.col("m.template"), F.col("m.domain"))


@query(f"""WITH x AS (SELECT doc_id, {R._NORM} AS k, length(text) < 400 AS short FROM documents)
SELECT doc_id, CASE WHEN NOT short THEN 'length' WHEN k IN (SELECT trim(regexp_replace(lower(text), '{R._WS}+', ' ', 'g')) FROM benchmark) OR row_number() OVER (PARTITION BY k, short ORDER BY doc_id) > 1 THEN 'duplicate' END AS drop_reason FROM x""")
def duplicate_seeds(spark, d):
    c = table(spark, d, "documents").select("doc_id", F.col("doc_id").alias("pos"), F.col("text").alias("prompt"), F.when(F.length("text") >= 400, "length").alias("drop_reason"))
    return pools.with_duplicates(c, table(spark, d, "benchmark").select(F.col("text").alias("prompt"))).select("doc_id", "drop_reason")


@query(f"""WITH {R._CAND.replace("doc_id, ['class", "doc_id, 'seed-' || CAST(doc_id AS VARCHAR) AS id, ['class")}, {_SEED_ROWS}, n AS (SELECT *, trim(regexp_replace(lower(prompt), '{R._WS}+', ' ', 'g')) AS k FROM cand)
SELECT count(*) AS seeds, count(*) FILTER (k IN (SELECT trim(regexp_replace(lower(prompt), '{R._WS}+', ' ', 'g')) FROM seed_rows)) AS duplicates, count(*) FILTER (id IN (SELECT id FROM seed_rows)) AS id_clashes,
  count(*) FILTER (task_family = 'classification' AND NOT list_contains(labels, coalesce(expected, ''))) AS bad_labels,
  count(*) FILTER (task_family = 'classification' AND len(list_filter(labels, lambda l: contains(lower(prompt), lower(l)))) < 2) AS no_options,
  count(*) FILTER (task_family IN ('qa','reasoning') AND coalesce(expected, '') = '') AS missing_expected, (SELECT string_agg(id, ',' ORDER BY id) FROM (SELECT id FROM n ORDER BY id LIMIT 5)) AS first_ids FROM n""")
def seed_review(spark, d):
    new = R.candidates(spark, d).withColumn("id", F.concat(F.lit("seed-"), F.col("doc_id").cast("string")))
    return pools.seed_review(new, seed_rows(spark, d)).withColumn("first_ids", F.array_join("first_ids", ","))


@query("SELECT doc_id % 3 AS task_family, CASE WHEN doc_id % 7 = 0 THEN 'length' WHEN doc_id % 5 = 0 THEN 'duplicate' END AS drop_reason, count(*) AS n FROM documents WHERE doc_id % 7 = 0 OR doc_id % 5 = 0 GROUP BY ALL")
def drop_reasons(spark, d):
    k = F.col("doc_id")
    return A.drop_counts(table(spark, d, "documents").select((k % 3).alias("task_family"), F.when(k % 7 == 0, "length").when(k % 5 == 0, "duplicate").alias("drop_reason")))


# ------------------------------------------------------------------ reports
@query("""WITH r AS (SELECT e.event_id AS item_id, CASE WHEN event_type <> 'error' THEN value END AS v FROM events e)
SELECT count(DISTINCT item_id) FILTER (v IS NOT NULL) AS scored, count(DISTINCT item_id) FILTER (v IS NULL) AS failed FROM r""")
def judge_availability(spark, d):
    e = table(spark, d, "events").select(F.col("event_id").alias("item_id"), F.when(F.col("event_type") != "error", F.col("value")).alias("v"))
    return A.availability(e, e.select("item_id", *[F.col("v").alias(a) for a in A.AXES]))


@query("""WITH l AS (SELECT event_id % 1500 AS id, bool_or(event_type <> 'error') AS ok FROM events GROUP BY 1)
SELECT count(*) FILTER (ok) AS scored, count(*) FILTER (NOT ok) AS errors, count(*) FILTER (ok IS NULL) AS remaining FROM documents LEFT JOIN l ON id = doc_id""")
def log_progress(spark, d):
    log = table(spark, d, "events").select((F.col("event_id") % 1500).alias("id"), F.when(F.col("event_type") == "error", "x").alias("error"))
    return A.progress(table(spark, d, "documents").select(F.col("doc_id").alias("id")), log)


@query(f"WITH {SCORES_SQL} SELECT split_part(judge, '/', -1) AS judge, count(*) AS n FROM scores GROUP BY 1")
def judgements_by_judge(spark, d):
    return A.by_judge(scores(spark, d))


@query(f"WITH {SCORES_SQL} SELECT lang AS language, round(avg(fluency), 6) AS fluency, round(avg(faithfulness), 6) AS faithfulness, round(avg(bias), 6) AS bias, count(*) AS n FROM scores JOIN documents ON doc_id = item_id GROUP BY lang")
def axis_means(spark, d):
    lang = table(spark, d, "documents").select(F.col("doc_id").alias("item_id"), F.col("lang").alias("language"))
    return A.axis_means(scores(spark, d).join(lang, "item_id")).select("language", *[F.round(a, 6).alias(a) for a in A.AXES], "n")


@query(f"WITH {ITEMS_SQL}, {SCORES_SQL}, n AS (SELECT item_id, count(DISTINCT judge) AS j FROM scores GROUP BY 1), b AS (SELECT DISTINCT doc_id FROM labels) SELECT target_language AS language, count(*) AS items, count(*) FILTER (j >= 1) AS judged, count(*) FILTER (j >= 2) AS ensemble, count(*) FILTER (task_family <> 'translation') AS bt_eligible, count(*) FILTER (task_family <> 'translation' AND doc_id IS NOT NULL) AS bt_scored FROM items LEFT JOIN n ON id = item_id LEFT JOIN b ON doc_id = id GROUP BY 1")
def coverage_table(spark, d):
    i = items(spark, d).select("id", F.col("target_language").alias("language"), "task_family")
    return A.coverage(i, scores(spark, d), table(spark, d, "labels").select(F.col("doc_id").alias("id")))


@query(f"WITH {R._REV} SELECT verdict, count(*) AS n, round(count(*) / (SELECT count(*)::DOUBLE FROM reviews), 6) AS share FROM reviews GROUP BY verdict")
def verdict_shares(spark, d):
    return A.verdict_shares(R._reviews(spark, d)).withColumn("share", F.round("share", 6))


@query("""SELECT lang AS language, count(*) AS items, count(*) FILTER (doc_id % 3 > 0) AS normal, count(*) FILTER (doc_id % 3 = 0) AS borderline, count(*) FILTER (doc_id % 5 = 0) AS double_rated FROM documents GROUP BY lang""")
def gold_summary(spark, d):
    k = F.col("doc_id")
    return A.gold_summary(table(spark, d, "documents").select(F.col("lang").alias("language"), F.when(k % 3 == 0, "borderline").otherwise("normal").alias("stratum"), (k % 5 == 0).alias("overlap")))


@query("""WITH e AS (SELECT label AS tier, vec_id % 3 AS j, max(vec_id) FILTER (vec_id % 10 > 2) AS f FROM embeddings GROUP BY ALL)
SELECT tier, coalesce(max(printf('%.2f', f::DOUBLE)) FILTER (j = 0), 'ERR') AS j0, coalesce(max(printf('%.2f', f::DOUBLE)) FILTER (j = 1), 'ERR') AS j1 FROM e GROUP BY tier""")
def tier_cells(spark, d):
    e = table(spark, d, "embeddings").select(F.col("label").alias("tier"), F.concat(F.lit("j"), (F.col("vec_id") % 3).cast("string")).alias("judge"), F.when(F.col("vec_id") % 10 > 2, F.col("vec_id").cast("double")).alias("fluency"))
    per = e.groupBy("tier", "judge").agg(F.max("fluency").alias("fluency")).withColumn("error", F.when(F.col("fluency").isNull(), "failed"))
    return A.tier_pivot(per, ["j0", "j1"]).select("tier", F.coalesce("j0", F.lit("ERR")).alias("j0"), F.coalesce("j1", F.lit("ERR")).alias("j1"))


@query("SELECT count(*) FILTER (event_type <> 'error') AS generated, count(*) FILTER (event_type = 'error') AS skipped FROM events")
def run_counts(spark, d):
    return A.run_counts(table(spark, d, "events").select(F.when(F.col("event_type") == "error", "x").alias("error")))


# ------------------------------------------------------------------ agreement
_UNITS = "v AS (SELECT event_id // 3 AS unit, event_type AS value FROM events), c AS (SELECT unit, value, count(*) AS k FROM v GROUP BY ALL), u AS (SELECT unit, sum(k) AS m, sum(k * k) AS q FROM c GROUP BY unit)"


def _units(spark, d):
    return table(spark, d, "events").select(F.floor(F.col("event_id") / 3).alias("unit"), F.col("event_type").alias("value"))


@query(f"""WITH {_UNITS}, t AS (SELECT value, sum(k)::DOUBLE AS t FROM c WHERE unit IN (SELECT unit FROM u WHERE m = 3) GROUP BY value), e AS (SELECT sum(t * t) / (sum(t) * sum(t)) AS e FROM t)
SELECT round((avg((q - m) / (m * (m - 1))::DOUBLE) - any_value(e)) / (1 - any_value(e)), 6) AS kappa FROM u, e WHERE m = 3""")
def fleiss(spark, d):
    return G.fleiss_kappa(_units(spark, d)).select(F.round("kappa", 6).alias("kappa"))


@query(f"""WITH {_UNITS}, n AS (SELECT sum(m)::DOUBLE AS n, sum((m * m - q) / (m - 1)::DOUBLE) AS apart FROM u WHERE m > 1), t AS (SELECT sum(t * t) AS s FROM (SELECT sum(k)::DOUBLE AS t FROM c WHERE unit IN (SELECT unit FROM u WHERE m > 1) GROUP BY value))
SELECT round(1 - apart * (n - 1) / (n * n - s), 6) AS alpha FROM n, t""")
def krippendorff_nominal(spark, d):
    return G.krippendorff_nominal(_units(spark, d)).select(F.round("alpha", 6).alias("alpha"))


@query(f"WITH {SCORES_SQL} SELECT item_id, judge, CAST(1 + (fluency >= 0.25)::INT + (fluency >= 0.5)::INT + (fluency >= 0.75)::INT AS INT) AS bin, count(*) AS n FROM scores GROUP BY ALL")
def binned_scores(spark, d):
    return scores(spark, d).select("item_id", "judge", G.binned(F.col("fluency")).alias("bin")).groupBy("item_id", "judge", "bin").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {SCORES_SQL}, h AS (SELECT doc_id AS item_id, quality AS x FROM labels WHERE quality IS NOT NULL), e AS (SELECT item_id, judge, avg(fluency) AS y FROM scores GROUP BY ALL),
b AS (SELECT judge, x, y FROM e JOIN h USING (item_id) UNION ALL SELECT 'ensemble', x, y FROM (SELECT item_id, avg(y) AS y FROM e GROUP BY 1) JOIN h USING (item_id)),
r AS (SELECT judge, rank() OVER (PARTITION BY judge ORDER BY x) + (count(*) OVER (PARTITION BY judge, x) - 1) / 2.0::DOUBLE AS a, rank() OVER (PARTITION BY judge ORDER BY y) + (count(*) OVER (PARTITION BY judge, y) - 1) / 2.0::DOUBLE AS b FROM b)
SELECT judge, count(*) AS n, round(corr(a, b), 4) AS rho FROM r GROUP BY judge""")
def ensemble_agreement(spark, d):
    human = table(spark, d, "labels").where("quality IS NOT NULL").select(F.col("doc_id").alias("item_id"), F.col("quality").alias("rating"))
    return G.ensemble_agreement(human, scores(spark, d)).withColumn("rho", F.round("rho", 4))


# ------------------------------------------------------------------ text functions
@query("SELECT event_type, coalesce(median(value) FILTER (value > 1e12), 0) AS none, round(coalesce(median(value), 0), 6) AS median FROM events GROUP BY 1")
def median_or_zero(spark, d):
    big = F.when(F.col("value") > 1e12, F.col("value"))
    return table(spark, d, "events").groupBy("event_type").agg(T.median_or_zero(big).alias("none"), F.round(T.median_or_zero(F.col("value")), 6).alias("median"))


@query("SELECT event_id, CAST(CAST(round_even(100 * ((event_id % 1000) / 1000.0::DOUBLE), 0) AS INT) AS VARCHAR) || '%' AS pc, printf('%.2f', event_id / 4.0::DOUBLE) AS two FROM events")
def number_formats(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", T.percent((F.col("event_id") % 1000) / 1000.0).alias("pc"), T.fixed(F.col("event_id") / 4.0, 2).alias("two"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events")
def utc_days(spark, d):
    return table(spark, d, "events").select("event_id", T.utc_day(F.col("ts")).alias("day"))


@query("SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'say ' || lang || ' now' WHEN 1 THEN 'lang ' || lang ELSE lang END AS source FROM documents")
def quoted_sources(spark, d):
    k = F.col("doc_id")
    said = F.when(k % 3 == 0, F.concat(F.lit("Put this: 'say "), "lang", F.lit(" now'"))).when(k % 3 == 1, F.concat(F.lit("Translate to it: lang "), "lang")).otherwise(F.concat(F.lit("translate: '"), "lang", F.lit("'")))
    return table(spark, d, "documents").select("doc_id", T.quoted_source(said).alias("source"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'nim' ELSE 'dflt' END AS provider, CASE WHEN event_id % 2 = 0 THEN 'm:' || event_type ELSE 'zz:m:' || event_type END AS model FROM events")
def model_names(spark, d):
    name = F.concat(F.when(F.col("event_id") % 2 == 0, "nim:m:").otherwise("zz:m:"), "event_type")
    return table(spark, d, "events").select("event_id", T.split_model(name, ("nim",), "dflt").alias("s")).select("event_id", "s.provider", "s.model")


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 2 ELSE 0 END AS n, CASE WHEN event_id % 2 = 0 THEN 'a/b,' || event_type ELSE '' END AS judges FROM events")
def ensemble_labels(spark, d):
    label = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("ensemble[mean]:a/b,,"), "event_type")).otherwise(F.lit("solo"))
    j = T.ensemble_judges(label)
    return table(spark, d, "events").select("event_id", F.size(j).alias("n"), F.array_join(j, ",").alias("judges"))


@query("SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'Hindi' WHEN 1 THEN 'Urdu' WHEN 2 THEN 'Tamil' WHEN 3 THEN 'Malayalam' ELSE lang END AS name FROM documents")
def language_names(spark, d):
    code = F.col("lang")
    for i, c in enumerate(("hi", "ur", "ta", "ml")):
        code = F.when(F.col("doc_id") % 5 == i, c).otherwise(code)
    return table(spark, d, "documents").select("doc_id", T.language_name(code).alias("name"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 1 THEN 'plain ' || event_type ELSE event_type END AS prompt, CASE WHEN event_id % 3 = 0 THEN CAST(event_id AS VARCHAR) END AS expected FROM events")
def parsed_answers(spark, d):
    k, t = F.col("event_id"), F.col("event_type")
    fenced = F.concat(F.lit('<think>{no}</think> ```json\n{"prompt": "'), t, F.lit('", "expected": '), k.cast("string"), F.lit("}\n```"))
    raw = F.when(k % 3 == 0, fenced).when(k % 3 == 1, F.concat(F.lit(" plain "), t)).otherwise(F.concat(F.lit('sure: {"prompt": "'), t, F.lit('", "expected": " "} bye')))
    return table(spark, d, "events").select("event_id", salvage.parse_response(raw).alias("r")).select("event_id", "r.prompt", "r.expected")


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS n FROM events")
def seed_records(spark, d):
    k, t = F.col("event_id"), F.col("event_type")
    one = F.concat(F.lit('{"prompt": "'), t, F.lit('"}'))
    raw = F.when(k % 3 == 0, F.concat(F.lit("here: ["), one, F.lit(", 3, "), one, F.lit("] end"))).when(k % 3 == 1, one).otherwise(t)
    return table(spark, d, "events").select("event_id", F.size(salvage.parse_seed_records(raw)).alias("n"))


# ------------------------------------------------------------------ whole runs
@query(f"""WITH {R._GATES_SQL}, j AS (SELECT * FROM (WITH {SCORES_SQL} SELECT item_id, (avg(fluency) + avg(faithfulness) + avg(bias)) / 3 AS overall FROM scores GROUP BY 1)),
x AS (SELECT id AS item_id, s_ok AND l_ok AS would_pass, 'structural,language_id,llm_judge,back_translation' AS ran, round(coalesce(overall, 0), 6) AS judge, CASE WHEN toxic IS NULL THEN 0 ELSE toxic / 4.0::DOUBLE END AS back,
  CASE WHEN doc_id IS NULL THEN 'back-translation unavailable: not translated back' END AS back_reason FROM judged LEFT JOIN j ON id = item_id LEFT JOIN labels ON doc_id = id) SELECT * FROM x""")
def filter_run(spark, d):
    log = table(spark, d, "labels").select(F.col("doc_id").alias("id"), (F.col("toxic") / 4.0).alias("cos"), F.lit(None).cast("string").alias("error"))
    v, _ = drivers.filter_items(items(spark, d), T.ASCII_SCRIPTS, A.ensemble(scores(spark, d)), log)
    r = lambda k, c: F.get("results", F.lit(k))[c]
    return v.select("item_id", "would_pass", F.array_join(F.transform("results", lambda x: x["filter"]), ",").alias("ran"), F.round(r(2, "score"), 6).alias("judge"), r(3, "score").alias("back"), r(3, "reason").alias("back_reason"))


_MOCK = "'[mock] prompt' AS prompt, '[mock] answer' AS expected"


@query(f"WITH {_SEED_ROWS}, s AS (SELECT *, item_id // 2 AS pos, count(*) OVER (PARTITION BY task_family) AS n FROM seed_rows WHERE task_family = 'qa') SELECT 'syn-hi-' || replace(id, 'seed-', '') || '-' || lpad(CAST(i AS VARCHAR), 3, '0') AS id, id AS seed_id, {_MOCK} FROM s, range(0, 50) t(i) WHERE i % n = pos")
def generate_run(spark, d):
    return drivers.generate(seed_rows(spark, d).drop("item_id"), "qa", "hi", 50, models.MockClient, "mock").select("id", "seed_id", "prompt", "expected")


@query(f"""WITH {_SEED_ROWS}, {ITEMS_SQL}, langs AS (SELECT unnest(['en', 'fr']) AS l), j AS (SELECT id AS seed_id, task_family, l, item_id FROM seed_rows s, langs WHERE NOT EXISTS (SELECT 1 FROM items i WHERE i.seed_id = s.id AND i.target_language = l AND i.task_family = s.task_family)),
k AS (SELECT *, row_number() OVER (PARTITION BY l, task_family ORDER BY item_id // 2, seed_id) - 1 AS n FROM j)
SELECT 'syn-' || l || '-' || replace(seed_id, 'seed-', '') || '-' || lpad(CAST(n AS VARCHAR), 3, '0') AS id, seed_id, task_family, {_MOCK} FROM k""")
def generate_batch_run(spark, d):
    langs = spark.createDataFrame([("en", 0), ("fr", 1)], "target_language string, lang_pos int")
    return drivers.generate_batch(seed_rows(spark, d).drop("item_id"), langs, "all", models.MockClient, "mock", R.generated_keys(spark, d)).select("id", "seed_id", "task_family", "prompt", "expected")


class _Judge:
    """A judge whose scores are the lengths of what it reads, as SQL can state them."""

    def complete(self, model, system, user, temperature, max_tokens):
        if model == "down":
            raise RuntimeError("down")
        return '{"reasoning": "r", "fluency": %s, "faithfulness": 0.5, "bias": 2}' % (0.25 if model == "a" else 0.75)


@query(f"WITH {ITEMS_SQL}, {_SEED_ROWS} SELECT i.id AS item_id, 0.5::DOUBLE AS fluency, 0.5::DOUBLE AS faithfulness, 1.0::DOUBLE AS bias, round(2.0::DOUBLE / 3, 6) AS overall, 'ensemble[mean]:a,b' AS judge_model FROM items i JOIN seed_rows s ON i.seed_id = s.id")
def judge_score_run(spark, d):
    e, _, _ = drivers.judge_score(items(spark, d), seed_rows(spark, d), ["a", "b", "down"], _Judge, attempts=1)
    return e.select("item_id", *A.AXES, F.round("overall", 6).alias("overall"), "judge_model")
