import json
import math

import pytest
from pyspark.sql import functions as F

from tessera import drivers, models
from tessera.functions import prompts, salvage
from tessera.functions import text as T
from tessera.operators import aggregates as A
from tessera.operators import agreement as G
from tessera.operators import gates, joins, pools
from tessera.operators import windows as W
from tessera.sources import readers, sinks

ITEM = {"id": "item-1", "seed_id": "seed-1", "task_family": "qa", "target_language": "hi", "prompt": "सवाल: पानी किस ताप पर जमता है?", "expected": "शून्य पर।"}
SCHEMA = "id string, seed_id string, task_family string, target_language string, prompt string, expected string"


def frame(spark, *changes):
    return spark.createDataFrame([tuple({**ITEM, "id": f"i{k}", **c}.values()) for k, c in enumerate(changes)], SCHEMA)


def gate(spark, name, *changes, **kw):
    return [r[name] for r in gates.gated(frame(spark, *changes), **kw).orderBy("id").collect()]


STRUCTURAL = [
    ({}, None), ({"expected": None}, "missing 'expected'"), ({"task_family": "classification", "expected": "   "}, "missing 'expected'"), ({"task_family": "instruction", "expected": None}, None),
    ({"expected": ITEM["prompt"]}, "no-op"), ({"prompt": "   "}, "empty prompt"), ({"prompt": '{"prompt": "x y z"}'}, "raw JSON"), ({"prompt": "a ```code``` b."}, "code fence"),
    ({"prompt": "क" * 41}, "truncation"), ({"prompt": "क" * 40}, None), ({"prompt": "पानी बहा"}, None), ({"prompt": "फल " * 20 + "।"}, "repeat"), ({"prompt": "abcd"}, "under 5"), ({"prompt": "abcde"}, None),
    ({"prompt": "x" * 8001 + "."}, "over 8000"), ({"prompt": " \x1cabcd\xa0"}, "under 5"), ({"prompt": "a a a a a a b."}, None), ({"prompt": "a a a a a a a b."}, None), ({"prompt": "a a a a a a a a b."}, "78% of tokens"),
]


def test_structural(spark):
    for (change, want), r in zip(STRUCTURAL, [gate(spark, "structural", c)[0] for c, _ in STRUCTURAL]):
        assert r.passed == (want is None), (change, r)
        assert (r.reason is None) if want is None else want in r.reason
    assert gate(spark, "structural", {"prompt": "{bad", "expected": None})[0].score < gate(spark, "structural", {"expected": None})[0].score


def test_script_gate(spark):
    rows = [("नीला आकाश", "hi"), ("மழை", "ta"), ("പുഴ", "ml"), ("سفید بادل", "ur"), ("Blue sky", "hi"), ("77 + 1 = ?", "hi"), ("बादल 3!", "hi"), ("whatever", "fr"), ("Badal बादल", "hi")]
    got = [r[0] for r in spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, t string, l string").orderBy("i").select(T.script_confidence(F.col("t"), F.col("l"))).collect()]
    assert got == [1.0, 1.0, 1.0, 1.0, 0.0, 0.0, 1.0, 0.0, 0.375]
    mixed = {"task_family": "translation", "prompt": "Translate: See you later", "expected": "फिर मिलेंगे"}
    r = gate(spark, "language_id", mixed)[0]
    assert r.passed and "exempt" in r.reason and r.score < 0.75
    assert not gate(spark, "language_id", mixed, exempt=())[0].passed and gate(spark, "language_id", mixed, exempt=(), threshold=0.1)[0].passed


def test_chain_and_retention(spark):
    items = frame(spark, {}, {"prompt": "Hello there, world?", "expected": "Yes."}, {"target_language": "ta", "prompt": "மழை எப்போது வரும்?", "expected": "நாளை."}).cache()
    v = gates.verdicts(items).orderBy("item_id").collect()
    assert [x.would_pass for x in v] == [True, False, True] and v[1].failed == ["language_id"]
    blank = gates.verdicts(frame(spark, {"prompt": "  "}), short_circuit=True).first()
    assert [r["filter"] for r in blank.results] == ["structural"]
    rep = {(r.level, r.language, r.task, r["filter"]): (r.passed, r.total) for r in A.retention(gates.verdicts(items)).collect()}
    assert rep[0, None, None, "chain"] == (2, 3) and rep[1, "hi", None, "chain"] == (1, 2) and rep[1, "ta", None, "chain"] == (1, 1)
    assert rep[0, None, None, "structural"] == (3, 3) and rep[2, "hi", "qa", "language_id"] == (1, 2)
    md = A.retention_markdown(A.retention(gates.verdicts(items)))
    assert "## Overall" in md and md.index("structural") < md.index("language_id") < md.index("chain")


def test_score_only_gates_never_reject(spark):
    df = spark.createDataFrame([(0.4, None, True), (None, "boom", True), (None, None, False)], "c double, e string, k boolean")
    got = [r[0] for r in df.select(gates.back_translation(F.col("c"), F.col("e"), F.col("k"))).collect()]
    assert all(r.passed for r in got) and [r.score for r in got] == [0.4, 0.0, 0.0] and got[2].reason == "no seed"
    assert [r[0].score for r in df.select(gates.llm_judge(F.col("c"), F.col("k"))).collect()] == [0.4, 0.0, 0.0]


def test_seed_acceptance(spark):
    long_ = "What colour is the sky on a clear day?"
    rows = [("qa", long_, "Blue", None, None), ("qa", long_, None, None, "missing_expected"), ("qa", "short", "x", None, "length"), ("qa", "पानी का रंग क्या है बताओ?", "x", None, "not_english"),
            ("classification", long_ + " Options: blue, red", "blue", ["blue", "red"], None), ("classification", long_, "blue", ["blue", "red"], "options_not_in_prompt"),
            ("classification", long_ + " blue red", "green", ["blue", "red"], "expected_not_in_labels"), ("classification", long_, "blue", ["blue"], "bad_labels"), ("other", long_, "x", None, "invalid_schema")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, t string, p string, e string, l array<string>, want string")
    for r in df.select("want", gates.seed_drop_reason(F.col("p"), F.col("e"), F.col("l"), F.col("t")).alias("got")).collect():
        assert r.want == r.got


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


def test_salvage(spark):
    p = lambda raw: tuple(one(spark, raw, salvage.parse_response))
    assert p('{"prompt": "a", "expected": "b"}') == ("a", "b")
    assert p('```json\n{"prompt": "a", "expected": ""}\n```') == ("a", None)
    assert p('<think>{x}</think>so: {"prompt": "a", "expected": 0} end') == ("a", "0")
    assert p("{'prompt': 'a'}") == ("{'prompt': 'a'}", None) and p("  plain ") == ("plain", None)
    assert p('{"prompt": null, "expected": true}') == ("None", "True")
    recs = one(spark, 'x [{"prompt": "a"}, 3, {"prompt": "b"}] y', salvage.parse_seed_records)
    assert [json.loads(r)["prompt"] for r in recs] == ["a", "b"] and one(spark, '{"prompt": "c"}', salvage.parse_seed_records) == ['{"prompt": "c"}']


def test_text_functions(spark):
    assert one(spark, " \x1c a \x85", T.strip_ws) == "a" and one(spark, " A  b ", T.norm_key) == "a b"
    assert [one(spark, v, T.clamp01) for v in ("0.4", "7", "-1", "x", "NaN", None)] == [0.4, 1.0, 0.0, 0.0, 1.0, 0.0]
    assert one(spark, "seed-qa-seed-1", lambda c: T.synthetic_id(F.lit("hi"), c)) == "syn-hi-qa-seed-1"
    assert one(spark, 1000, lambda c: T.padded(c, 3), "int") == "1000" and one(spark, 7, lambda c: T.padded(c, 3), "int") == "007"
    assert one(spark, "Translate to it: 'Good day, sir'", T.quoted_source) == "Good day, sir" and one(spark, "translate this: hello", T.quoted_source) == "hello"
    assert one(spark, "ensemble[mean]:a,,b", T.ensemble_judges) == ["a", "b"] and one(spark, "solo", T.ensemble_judges) == []
    assert tuple(one(spark, "nvidia:m:free", lambda c: T.split_model(c, ("nvidia",), "d"))) == ("nvidia", "m:free") and tuple(one(spark, "x:free", lambda c: T.split_model(c, ("nvidia",), "d"))) == ("d", "x:free")
    cos = spark.createDataFrame([([1.0, 2.0], [1.0, 2.0]), ([1.0, 0.0], [0.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>").select(T.cosine(F.col("a"), F.col("b"))).collect()
    assert [round(r[0], 9) for r in cos] == [1.0, 0.0, 0.0]
    with pytest.raises(Exception, match="different length"):
        spark.createDataFrame([([1.0], [1.0, 2.0])], "a array<double>, b array<double>").select(T.cosine(F.col("a"), F.col("b"))).collect()


def test_prompts(spark):
    s = spark.createDataFrame([("classification", "hi", "Pick one: a, b", "a", ["a", "b"]), ("translation", "ta", "Translate: 'Hi there'", None, None)], "task_family string, target_language string, prompt string, expected string, labels array<string>")
    got = [r.p for r in s.select(prompts.for_task().alias("p")).collect()]
    assert "Hindi" in got[0].user and "Labels: a, b" in got[0].user and "must end with the list" in got[0].user and '"expected": "<answer in Hindi>"' in got[0].user
    assert got[1].user.endswith("'Hi there'") and "Tamil" in got[1].system
    with pytest.raises(KeyError):
        prompts.build("nope")
    asked = s.select(prompts.judge_prompt(F.lit("item"), F.lit(None).cast("string")).alias("p")).first().p
    assert all(a in asked.user for a in prompts.JUDGED_AXES)


def test_sources_and_sinks(spark, tmp_path):
    seeds = tmp_path / "seeds.json"
    seeds.write_text(json.dumps({"note": 1, "seeds": [{"id": "s1", "task_family": "qa", "prompt": "प?", "labels": None, "metadata": {"a": "b"}}, {"id": "s2", "task_family": "qa", "prompt": "q"}]}))
    got = readers.load_seeds(spark, str(seeds))
    assert [r.id for r in got.orderBy("pos").collect()] == ["s1", "s2"]
    again = tmp_path / "again.json"
    again.write_text(sinks.seeds_document(got.drop("pos")))
    assert {r.prompt for r in readers.load_seeds(spark, str(again)).collect()} == {"प?", "q"}
    seeds.write_text("{}")
    with pytest.raises(ValueError):
        readers.load_seeds(spark, str(seeds))
    for name, lines in {"hi/qa/a-b/x.jsonl": [dict(ITEM, prompt="late")], "hi/qa/a/x.jsonl": [ITEM, "not json", dict(ITEM, prompt="second"), {"id": "x", "no": 1}], "ta/qa/y.jsonl": [dict(ITEM, id="item-2", target_language="ta")]}.items():
        f = tmp_path / "gen" / name
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text("\n".join(x if isinstance(x, str) else json.dumps(x, ensure_ascii=False) for x in lines) + "\n\n")
    items = {r.id: r.prompt for r in readers.load_items(spark, str(tmp_path / "gen")).collect()}
    assert items["item-1"] == "late" and "item-2" in items  # components order: a < a-b
    assert {tuple(r) for r in readers.generated_seed_keys(spark, str(tmp_path / "gen")).collect()} == {("seed-1", "hi", "qa"), ("seed-1", "ta", "qa")}
    sinks.write_verdicts(gates.verdicts(readers.load_items(spark, str(tmp_path / "gen"))), str(tmp_path / "v"))
    assert spark.read.json(str(tmp_path / "v")).count() == 3
    r = spark.createDataFrame([("a", "t", "hi", 1, 10), ("a", "t", "ta", 3, 20)], "rater_id string, task_id string, language string, fluency int, submitted_at int").withColumn("seq", F.col("submitted_at"))
    latest = sinks.upserted(r).first()
    assert (latest.language, latest.fluency) == ("hi", 3)


def test_planning_is_idempotent(spark):
    seeds = spark.createDataFrame([("s1", "qa", 0), ("s2", "qa", 1)], "id string, task_family string, pos int")
    langs = spark.createDataFrame([("hi", 0), ("ta", 1)], "target_language string, lang_pos int")
    none = spark.createDataFrame([], "seed_id string, target_language string, task_family string")
    jobs = joins.plan_jobs(seeds, langs, none, per_combo=5)
    assert [(r.idx, r.target_language) for r in jobs.collect()] == [(0, "hi"), (0, "ta"), (1, "hi"), (1, "ta")]
    assert joins.plan_jobs(seeds, langs, jobs.select("seed_id", "target_language", "task_family"), per_combo=5).count() == 0
    assert joins.cycled(seeds, 5).count() == 5


def test_gold_and_raters(spark):
    s = spark.createDataFrame([(i, "hi" if i % 3 else "ta", float(i)) for i in range(90)], "id long, language string, overall double")
    g = W.select_gold(s, 20, 0.25, "1").toPandas()
    assert g.groupby(["language", "stratum"]).size().to_dict() == {("hi", "borderline"): 15, ("hi", "normal"): 5, ("ta", "borderline"): 15, ("ta", "normal"): 5} and g.id.is_unique
    a = W.assign_raters(spark.createDataFrame(g), ["x", "y"], 0.2, "1").toPandas()
    assert a.groupby("language").overlap.sum().tolist() == [4, 4] and a.raters.str.len().eq(a.overlap + 1).all()


def test_congestion_and_budget(spark):
    log = spark.createDataFrame([(1, i, i, f) for i, f in enumerate([1, 1, 1, 0, 1, 1, 1, 1, 1])] + [(2, i, 100 + i, 1) for i in range(3)], "judge long, ts long, event_id long, failed int").withColumn("failed", F.col("failed") == 1)
    assert [tuple(r) for r in W.congested(log).collect()] == [(1, 7)]


def test_congestion_over_days_equals_plain_scan(spark):
    import random

    r = random.Random(4)
    rows = [(k % 5, r.randrange(12) * 43_200 + k % 3, k, r.random() < 0.6) for k in range(400)] + [(9, d * 86_400, 1000 + d, d > 2) for d in range(8)] + [(8, d * 86_400, 2000 + d, True) for d in range(3)] + [(9, 5, 3000, None)]
    want, run = {}, {}
    for j, _, e, bad in sorted(x for x in rows if x[3] is not None):
        run[j] = run.get(j, 0) + 1 if bad else 0
        if run[j] >= 4:
            want.setdefault(j, e)
    log = spark.createDataFrame(rows, "judge long, ts long, event_id long, failed boolean")
    assert want[9] == 1006 and 8 not in want and len(want) > 3
    for x in (log, log.withColumn("ts", F.timestamp_seconds("ts"))):
        assert {tuple(r) for r in W.congested(x).collect()} == set(want.items())


def test_turns_by_coarse_values(spark):
    rows = spark.createDataFrame([(k % 3 or None, k * 7 % 5 if k % 11 else None, k) for k in range(90)], "g long, size long, id long")
    order = [F.desc("size"), F.asc("id")]
    plain = {(r.id, r.turn) for r in W.interleave(rows, "g", [F.desc_nulls_first("size"), F.asc("id")]).collect()}
    assert len(plain) == 90 and plain == {(r.id, r.turn) for r in W.interleave(rows, "g", order, -F.col("size")).collect()}


def test_agreement(spark):
    p = spark.createDataFrame([("g", float(x), float(y)) for x, y in [(1, 2), (2, 1), (3, 4), (4, 3), (4, 9)]], "grp string, x double, y double")
    want = 7 / math.sqrt(95)  # ranks 1 2 3 4.5 4.5 and 2 1 4 3 5
    assert abs(G.spearman(p, "grp").first().rho - want) < 1e-9
    same = spark.createDataFrame([(i % 4, i % 4) for i in range(20)], "a int, b int")
    assert G.quadratic_kappa(same).first().kappa == 1.0
    units = spark.createDataFrame([(i, float(i)) for i in range(9) for _ in range(2)], "unit int, value double")
    assert G.krippendorff_interval(units).first().alpha == 1.0
    curve = G.roc(spark.createDataFrame([(i / 10, i >= 6) for i in range(10)], "score double, positive boolean"))
    best = G.best_threshold(curve).first()
    assert best.threshold == 0.6 and best.youden == 1.0


def test_reports(spark):
    s = spark.createDataFrame([("k", float(i)) for i in range(25)], "k string, v double")
    r = A.audit(s, ["k"], "v").first()
    assert (r.n, r.p10, r.median) == (25, 2.0, 12.0)
    sc = spark.createDataFrame([("i", "b", 0.2, 0.4, 0.6), ("i", "a", 0.4, 0.4, 0.4)], "item_id string, judge string, fluency double, faithfulness double, bias double")
    e = A.ensemble(sc).first()
    assert e.judge_model == "ensemble[mean]:a,b" and abs(e.overall - 0.4) < 1e-12 and e.judge_rationale == "2 judge(s)"
    assert math.isclose(A.spread(sc, "fluency").first().spread, 0.2)


def test_models(spark):
    s = spark.createDataFrame([("m", "s", "u")], "model string, system string, user string")
    assert "[mock]" in models.complete(s, models.MockClient).first().raw_response

    class Broken:
        def complete(self, *a):
            raise RuntimeError("down")

    r = models.complete(s, Broken, attempts=2).first()
    assert r.raw_response is None and r.error == "down"
    with pytest.raises(ValueError):
        models.build_client("nope")
    slept = []
    limit = models.RateLimiter(60, clock=lambda: 0.0, sleep=slept.append)
    limit.wait(), limit.wait()
    assert slept == [1.0]


def test_streams(spark, tmp_path):
    from tessera.streaming import streams

    src = tmp_path / "log"
    rows = [(f"i{k % 7}", k % 2, f"2026-01-0{1 + k % 3} 10:00:00", k % 2 == 1) for k in range(30)]
    spark.createDataFrame(rows, "id string, judge long, ts string, failed boolean").withColumn("ts", F.to_timestamp("ts")).write.parquet(str(src))
    stream = lambda: spark.readStream.schema("id string, judge long, ts timestamp, failed boolean").parquet(str(src))
    for name, df, mode in (("seen", streams.unseen(stream()), "append"), ("ledger", streams.daily_ledger(stream()), "complete"), ("streaks", streams.failure_streaks(stream()), "append")):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination(60)
    assert spark.table("seen").count() == 7 and spark.table("ledger").count() == 6
    assert {tuple(r) for r in spark.table("streaks").collect()} == {(1, 15)}


def test_entry_and_registry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_ids_go_on_past_the_taken_ones(spark):
    taken = spark.createDataFrame([(f"s-{i:04d}",) for i in (1, 3, 500)], "id string")
    got = {r.key: r.new_id for r in W.allocate_ids(spark.range(90).select(F.col("id").alias("key")), taken, "s-").collect()}
    assert got == dict(enumerate(f"s-{i:04d}" for i in (2, *range(4, 93))))


# ------------------------------------------------------------------ pools, reports, runs
SEEDS = [("seed-1", "qa", "Which river runs through Cairo at night?", "Nile", None, {"domain": "geo"}, 0), ("seed-2", "qa", "How many legs has a common spider?", "Eight", None, None, 1), ("seed-3", "reasoning", "A box holds three rows of four jars; how many jars?", "12", None, None, 0)]
SEED_SCHEMA = "id string, task_family string, prompt string, expected string, labels array<string>, metadata map<string,string>, pos int"


def seed_frame(spark):
    return spark.createDataFrame(SEEDS, SEED_SCHEMA)


def langs(spark, *codes):
    return spark.createDataFrame([(c, i) for i, c in enumerate(codes)], "target_language string, lang_pos int")


def test_task_lists_and_absent_paths(spark, tmp_path):
    assert pools.resolve_tasks("qa, reasoning") == ["qa", "reasoning"] and len(pools.resolve_tasks("all")) == 6
    for bad in ("qa,poem", " "):
        with pytest.raises(ValueError):
            pools.resolve_tasks(bad)
    assert readers.load_items(spark, str(tmp_path / "none")).count() == 0 and readers.generated_seed_keys(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(ValueError):
        A.required(spark.createDataFrame([], "item_id string"))
    with pytest.raises(ValueError):
        readers.seed_pools(spark, [str(tmp_path / "none.json")])


def test_lines_keep_their_order_over_splits(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("\n".join(json.dumps({"item_id": f"i{k % 10}", "judge": str(k)}) for k in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = {r.item_id: r.judge for r in readers.load_scores(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {f"i{k}": str(4990 + k) for k in range(10)}


def test_user_filters(spark):
    class Short(gates.QualityFilter):
        name = "short"

        def evaluate(self):
            n = F.length("prompt")
            return n < 10, n / 10.0, F.when(n >= 10, "too long")

    got = {r.id: (r.would_pass, r.results[0].reason) for r in gates.annotated(frame(spark, {"prompt": "a"}, {"prompt": "a" * 12}), Short()).collect()}
    assert got == {"i0": (True, None), "i1": (False, "too long")}
    with pytest.raises(NotImplementedError):
        gates.QualityFilter().column()


def test_script_gate_reasons(spark):
    mixed = {"task_family": "translation", "prompt": "Translate: Good evening", "expected": "शुभ संध्या"}
    r = gate(spark, "language_id", mixed)[0]
    assert r.reason == f"exempt (translation): source-language text expected; {r.score:.0%} in hi script"
    r = gate(spark, "language_id", {"prompt": "only English here", "expected": "हाँ।"})[0]
    assert not r.passed and r.reason == f"only {r.score:.0%} of letters in hi script (<75%)"


def test_duplicates_among_seeds(spark):
    c = spark.createDataFrame([(0, "New one", None), (1, " new  ONE", None), (2, "which river runs through cairo at night?", None), (3, "New one", "length")], "pos int, prompt string, drop_reason string")
    assert {r.pos: r.drop_reason for r in pools.with_duplicates(c, seed_frame(spark)).collect()} == {0: None, 1: "duplicate", 2: "duplicate", 3: "length"}
    assert pools.seed_review(seed_frame(spark), seed_frame(spark)).first()[:7] == (3, 3, 3, 0, 0, 0, ["seed-1", "seed-2", "seed-3"])


def test_generate_and_drip(spark):
    made = drivers.generate(seed_frame(spark), "qa", "hi", 3, models.MockClient, "mock").orderBy("id").collect()
    assert [r.id for r in made] == ["syn-hi-1-000", "syn-hi-1-002", "syn-hi-2-001"] and made[0].metadata == {"domain": "geo", "template": "direct_translate"}
    assert made[0].prompt == "[mock] prompt" and made[0].generation.teacher_model == "mock"
    items = drivers.generate_batch(seed_frame(spark), langs(spark, "hi", "ta"), "all", models.MockClient, "m")
    assert sorted(r.id for r in items.collect()) == sorted(f"syn-{c}-{s}" for c in ("hi", "ta") for s in ("1-000", "2-001", "3-000"))
    done = items.select("seed_id", "target_language", "task_family")
    assert drivers.generate_batch(seed_frame(spark), langs(spark, "hi", "ta"), "all", models.MockClient, "m", done).count() == 0

    class Moody:
        def complete(self, model, system, user, temperature, max_tokens):
            raise models.RateLimited("slow down")

    have = spark.createDataFrame([("hi", "qa", 1)], "target_language string, task_family string, n long")
    none = spark.createDataFrame([], drivers.NO_KEYS)
    drip = drivers.generate_drip(seed_frame(spark), langs(spark, "hi"), "qa", Moody, "m", none, have, 2, sleep=lambda s: None)
    assert [(r.seed_id, r.error, r.prompt) for r in drip.collect()] == [("seed-1", "slow down", None)]
    assert tuple(A.run_counts(drip).first()) == (0, 1)


def test_pauses_and_clients(spark):
    assert models.pause(models.RateLimited("x"), 0) == 12.0 and models.pause(RuntimeError("status 429"), 2) == 12.0 and models.pause(RuntimeError("x"), 2) == 2.25
    assert [models.pause(RuntimeError("x"), k, drivers.DRIP_BACKOFF) for k in (0, 1, 5)] == [60.0, 300.0, 900.0]
    sent = []
    client = models.HttpClient("http://host/v1/", "key", post=lambda *a: sent.append(a) or {"choices": [{"message": {"content": "hi"}}]})
    assert client.complete("m", "s", "u", 0.5, 9) == "hi" and sent[0][0] == "http://host/v1/chat/completions" and json.loads(sent[0][2])["max_tokens"] == 9 and sent[0][3] == 90.0
    with pytest.raises(ValueError):
        models.HttpClient("http://host", "")
    assert models.CommandClient(["cat"]).complete("m", "s", "u", 0, 0) == "s\n\nu"
    with pytest.raises(RuntimeError):
        models.CommandClient(["false"]).complete("m", "s", "u", 0, 0)
    models.register_client("own", models.MockClient)
    assert isinstance(models.build_client("own"), models.MockClient)
    v = {r.text: r.vector for r in models.embed(spark.createDataFrame([("aab",), ("aab",), ("Z",)], "text string"), models.LetterEmbedder).collect()}
    assert v["aab"][:3] == [2.0, 1.0, 0.0] and v["Z"][25] == 1.0 and len(v) == 2


class Teacher:
    """New seeds: one good, one too short, one that repeats."""

    def complete(self, model, system, user, temperature, max_tokens):
        return 'Sure: [{"prompt": "Which planet is the largest one?", "expected": "Jupiter", "metadata": {"domain": "sky"}}, {"prompt": "short", "expected": "x"}, {"prompt": "which  planet is the largest one?", "expected": "Jupiter"}]'


def test_bootstrap(spark):
    new, dropped = drivers.bootstrap_seeds(spark, seed_frame(spark), "qa", 3, Teacher, "t", taken=spark.createDataFrame([("seed-qa-bs-0001",)], "id string"), max_calls=2)
    rows = new.collect()
    assert [(r.id, r.expected, r.metadata) for r in rows] == [("seed-qa-bs-0002", "Jupiter", {"domain": "sky", "source": "bootstrap:t"})]
    assert {r.drop_reason: r.n for r in dropped.collect()} == {"length": 2, "duplicate": 3}
    none, why = drivers.bootstrap_seeds(spark, seed_frame(spark), "qa", 1, models.MockClient, "t", max_calls=1)
    assert none.count() == 0 and sum(r.n for r in why.collect()) == 1


class Judge:
    def complete(self, model, system, user, temperature, max_tokens):
        if model == "down":
            raise RuntimeError("down")
        if model == "vague":
            return "no idea"
        return '{"reasoning": "fine", "fluency": 0.9, "faithfulness": "0.6", "bias": 3}'


def made_items(spark):
    return spark.createDataFrame([("i1", "seed-1", "qa", "hi", "काहिरा में कौन सी नदी है?", "नील।"), ("i2", "seed-2", "qa", "hi", "मकड़ी के कितने पैर?", "आठ।"), ("i3", "seed-x", "qa", "hi", "क?", "ख।")], SCHEMA)


def test_judging(spark, tmp_path):
    e, each, counts = drivers.judge_score(made_items(spark), seed_frame(spark), ["a", "vague", "down"], Judge, attempts=1)
    assert {(r.item_id, round(r.overall, 6), r.judge_model) for r in e.collect()} == {(i, round(2.5 / 3, 6), "ensemble[mean]:a") for i in ("i1", "i2")}
    assert tuple(counts.first()) == (2, 0, 1) and each.count() == 2
    both = sinks.write_scores(e, each, str(tmp_path / "scores"))
    assert spark.read.json(both[0]).count() == 2 and spark.read.json(both[1]).first().judge == "a"
    _, _, none = drivers.judge_score(made_items(spark), seed_frame(spark), ["down"], Judge, attempts=1)
    assert tuple(none.first()) == (0, 2, 1)
    scores, report = drivers.judge_compare(made_items(spark), seed_frame(spark), ["a", "down"], Judge, controls=1, attempts=1)
    assert scores.where("item_id like 'control-%'").count() == 2 and "CONTROL: raw English" in report and "ERR down" in report and "| spread | - | - | - |  |" in report
    _, text = drivers.compare(seed_frame(spark), ["m1", "m2"], "hi", 1, models.MockClient)
    assert text.count("- prompt: [mock] prompt") == 2 and "## seed-1 (qa)" in text


def test_filter_run(spark, tmp_path):
    scores = spark.createDataFrame([("i1", 0.8)], "item_id string, overall double")
    log = spark.createDataFrame([("i1", 0.7, None), ("i2", None, "boom")], "id string, cos double, error string")
    v, report = drivers.filter_items(made_items(spark), judge_scores=scores, back_log=log, seeds=seed_frame(spark))
    got = {r.item_id: [(x["filter"], x.passed, x.score, x.reason) for x in r.results[2:]] for r in v.collect()}
    assert got["i1"] == [("llm_judge", True, 0.8, None), ("back_translation", True, 0.7, None)]
    assert got["i2"] == [("llm_judge", True, 0.0, "judge unavailable: no score"), ("back_translation", True, 0.0, "back-translation unavailable: boom")]
    assert got["i3"][0][3] == "judge unavailable: no seed" and got["i3"][1][3] == "no seed"
    rep = {(r.level, r["filter"]): (r.passed, r.total) for r in report.where("level = 0").collect()}
    assert rep[0, "back_translation"] == (3, 3) and rep[0, "structural"] == (2, 3) and rep[0, "chain"] == (2, 3)
    sinks.write_verdicts(v, str(tmp_path / "verdicts"))
    sinks.write_report(spark, "Retention", A.retention_markdown(report), str(tmp_path / "r.md"))
    assert len(spark.read.json(str(tmp_path / "verdicts")).first().results) == 4
    assert (tmp_path / "r.md").read_text().startswith("# Retention\n\n## Overall")


def test_export_gold(spark, tmp_path):
    items = made_items(spark)
    scores = spark.createDataFrame([(f"i{k}", 0.5, 0.6, 0.7, 0.6 + k / 100, "ensemble[mean]:a,b") for k in (1, 2, 3)], "item_id string, fluency double, faithfulness double, bias double, overall double, judge_model string")
    bundle, manifest, summary = drivers.export_gold(items, scores, seed_frame(spark), "b1", 3, 0.34, 2, 0.2, created_at="t")
    assert len(bundle["items"]) == 3 and bundle["items"][0]["source_expected"] == "Nile" and "overall" not in json.dumps(bundle["items"]) and bundle["items"][2]["source_prompt"] is None
    assert sum(a["overlap"] for a in manifest["assignments"]) == 1 and {r for a in manifest["assignments"] for r in a["raters"]} <= {"hi_r1", "hi_r2"}
    assert manifest["provenance"]["i1"]["judge_model_ensemble"] == ["a", "b"] and tuple(summary.first()) == ("hi", 3, 1, 2, 1)
    sinks.write_json(spark, manifest, str(tmp_path / "m.json"))
    m = spark.read.schema("provenance map<string, struct<judge_overall: double>>").json(str(tmp_path / "m.json"), multiLine=True)
    ratings = spark.createDataFrame([("i1", 3)], "task_id string, fluency int")
    assert tuple(joins.provenance(ratings, m).first()) == ("i1", 3, 0.61)


class Echo:
    def complete(self, model, system, user, temperature, max_tokens):
        if "मकड़ी" in user:
            raise RuntimeError("boom")
        return "Which river runs through Cairo at night? Nile"


def test_back_translation_and_audit(spark):
    log = spark.createDataFrame([], "id string, seed_id string, lang string, task string, translator string, cos double, back_translation string, error string")
    new = drivers.score_backtranslation(made_items(spark), seed_frame(spark), log, Echo, models.LetterEmbedder, "t", attempts=1)
    got = {r.id: r for r in new.collect()}
    assert set(got) == {"i1", "i2"} and got["i1"].cos > 0.99 and got["i2"].cos is None and got["i2"].error == "boom"
    assert drivers.score_backtranslation(made_items(spark), seed_frame(spark), new, Echo, models.LetterEmbedder, "t").count() == 0
    judge_log = spark.createDataFrame([("i1", "org/a", 0.5, 0.5, 0.5), ("i1", "org/b", 0.3, 0.3, 0.3)], "item_id string, judge string, fluency double, faithfulness double, bias double")
    text = drivers.audit_report(made_items(spark), judge_log, new)
    assert "| scored | errors | remaining |\n| --- | --- | --- |\n| 1 | 1 | 1 |" in text and "| a | 1 |" in text and "## Judges" in text


def test_judge_run_keeps_to_the_budget(spark):
    log = spark.createDataFrame([("i1", "a", "2026-01-02 23:59:59", None)] + [("i2", "bad", f"2026-01-02 10:00:0{k}", "x") for k in range(4)], "item_id string, judge string, ts string, error string").withColumn("ts", F.to_timestamp("ts"))
    run = lambda **k: sorted((r.item_id, r.judge) for r in drivers.score_judge(made_items(spark), seed_frame(spark), log, ["a", "c", "bad"], Judge, "2026-01-02", attempts=1, **k).select("item_id", "judge").collect())
    assert run(cap=900, per_run=100) == [("i1", "c"), ("i2", "a"), ("i2", "c")]
    assert len(run(cap=6, per_run=100)) == 1 and run(cap=5, per_run=9) == [] and len(run(cap=900, per_run=2)) == 2
    assert W.budget_left(log, "2026-01-03", 10, 4) == 4


def test_agreement_measures(spark):
    rows = [(u, v) for u, vs in enumerate(["aab", "bbb", "abb", "aaa"]) for v in vs]
    df = spark.createDataFrame(rows, "unit int, value string")
    p = (1 / 3 + 1 + 1 / 3 + 1) / 4
    assert abs(G.fleiss_kappa(df).first().kappa - (p - 0.5) / 0.5) < 1e-12
    apart = (2 * 2 * 1 / 2) * 2
    assert abs(G.krippendorff_nominal(df).first().alpha - (1 - apart * 11 / (144 - 72))) < 1e-12
    assert [r[0] for r in spark.createDataFrame([(0.1,), (0.25,), (0.9,), (None,)], "s double").select(G.binned(F.col("s"))).collect()] == [1, 2, 4, None]
    curve = {r.score: (r.tpr, r.fpr) for r in G.roc(spark.createDataFrame([(i / 50, i % 3 == 0) for i in range(50)], "score double, positive boolean"), 7).collect()}
    for t, (tpr, fpr) in curve.items():
        assert abs(tpr - sum(i % 3 == 0 and i / 50 >= t for i in range(50)) / 17) < 1e-12 and abs(fpr - sum(i % 3 > 0 and i / 50 >= t for i in range(50)) / 33) < 1e-12


def test_rewrite_in_place_and_runs(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.createDataFrame([(1, "ok"), (2, None)], "a int, b string").write.json(path)
    read = lambda s, p: s.read.schema("a int, b string").json(p)
    assert sinks.rewrite_valid(spark, path, "b IS NOT NULL", read, dry_run=True) == (1, 1) and read(spark, path).count() == 2
    assert sinks.rewrite_valid(spark, path, "b IS NOT NULL", read) == (1, 1) and [r.a for r in read(spark, path).collect()] == [1]
    assert sinks.rewrite_valid(spark, path, "b IS NOT NULL", read) == (1, 0) and sorted(p.name for p in tmp_path.iterdir()) == ["rows"]
    a, b = (sinks.write_run(made_items(spark), str(tmp_path / "runs"), "org/m:free") for _ in range(2))
    assert a != b and "model=org_m_free" in a and readers.load_items(spark, str(tmp_path / "runs")).count() == 0  # json, not jsonl
    assert spark.read.json(a).count() == 3


def test_stream_upserts_and_bounded_state(spark, tmp_path):
    from tessera.streaming import streams

    src, out = tmp_path / "in", str(tmp_path / "now")
    cols = "rater_id string, task_id string, language string, fluency int, submitted_at timestamp, seq int"
    put, now = streams.upsert_into(spark, out)
    for k, rows in enumerate([[("a", "t", "hi", 1, "2026-01-01 00:00:00", 1)], [("a", "t", "ta", 4, "2026-01-02 00:00:00", 2), ("b", "t", "hi", 2, "2026-01-02 00:00:00", 3)]]):
        df = spark.createDataFrame(rows, cols.replace("timestamp", "string")).withColumn("submitted_at", F.to_timestamp("submitted_at"))
        df.write.mode("append").parquet(str(src))
        q = spark.readStream.schema(cols).parquet(str(src)).writeStream.foreachBatch(put).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(60)
    assert {(r.rater_id, r.language, r.fluency) for r in now().collect()} == {("a", "hi", 4), ("b", "hi", 2)}
    stream = spark.readStream.schema(cols).parquet(str(src))
    q = streams.unseen(stream, "rater_id", "submitted_at").writeStream.format("memory").queryName("bounded").option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("bounded").count() == 2


def test_utc_day_in_any_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        assert spark.sql("SELECT timestamp '2026-01-01 03:00:00' AS t").select(T.utc_day(F.col("t"))).first()[0] == "2025-12-31"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert one(spark, 0.125, lambda c: T.fixed(c, 2), "double") == "0.12" and one(spark, 2.675, lambda c: T.fixed(c, 2), "double") == "2.68"


class Weigher:
    """Answers with the MB of memory that its worker holds."""

    def complete(self, model, system, user, temperature, max_tokens):
        with open("/proc/self/smaps_rollup") as f:
            return str(sum(int(x.split()[1]) for x in f if x.startswith("Pss_Anon:")) // 1024)


def test_workers_hold_few_prompts_at_once(spark):
    asked = lambda n, size: spark.range(0, n, 1, 1).select("id", F.lit("m").alias("model"), F.lit("s").alias("system"), *[F.concat(F.col("id").cast("string"), F.repeat(F.lit("x"), size)).alias(c) for c in ("user", "item_prompt")])
    most = lambda df: models.complete(df, Weigher).agg(F.max(F.col("raw_response").cast("int")), F.count("item_prompt")).first()
    small, large = most(asked(8, 8)), most(asked(6000, 20_000))
    assert (small[1], large[1]) == (8, 6000) and large[0] - small[0] < 48


class Counted:
    """Answers with the number of calls of its process so far."""

    calls = 0

    def complete(self, model, system, user, temperature, max_tokens):
        Counted.calls += 1
        return '{"n": %d}' % Counted.calls


def test_calls_keep_other_columns_and_run_once(spark):
    big = 2**53 + 1
    df = spark.createDataFrame([(big, ["a"], "u"), (None, None, "v")], "n long, l array<string>, user string").coalesce(1).withColumn("model", F.lit("m")).withColumn("system", F.lit("s"))
    got = models.complete(df, Counted).where("error IS NULL AND raw_response IS NOT NULL AND user < 'z'").withColumn("again", F.concat("raw_response", "raw_response"))
    rows = sorted(got.collect(), key=lambda r: r.user)
    assert [(r.n, r.l) for r in rows] == [(big, ["a"]), (None, None)] and all(r.again == r.raw_response * 2 for r in rows)
    first, second = (json.loads(r.raw_response)["n"] for r in rows)
    assert second == first + 1


def test_judges_run_no_other_python_workers(spark, tmp_path):
    """Neither a list of judges nor a second parse of the answers starts workers, which stay."""
    for name, df in (("items", made_items(spark)), ("seeds", seed_frame(spark))):
        df.write.parquet(str(tmp_path / name))
    e, each, _ = drivers.judge_score(*(spark.read.parquet(str(tmp_path / n)) for n in ("items", "seeds")), ["a", "vague"], Judge, attempts=1)
    for df in (e, each):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "RDD" not in plan and plan.count("ArrowEvalPython") == 2


class Few(models.LetterEmbedder):
    def encode(self, texts):
        assert 0 < len(texts) <= 7
        return super().encode(texts)


def test_embed_takes_a_few_texts_at_a_time(spark):
    texts = spark.range(300).select(F.repeat(F.lit("ab"), F.col("id").cast("int")).alias("text")).coalesce(1)
    got = {r.text: r.vector for r in models.embed(texts.union(texts), Few, batch=7).collect()}
    assert len(got) == 300 and all(len(v) == 26 and v[0] == v[1] == len(t) / 2 for t, v in got.items())
