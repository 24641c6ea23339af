import shutil

import pandas as pd

import corpus_pipeline
from tessera.llm import langid

from .test_operators import brute_components


def test_stages_against_brute_force(spark, tmp_path):
    d = "/root/testdata/sf0.001"
    shutil.copy(f"{d}/benchmark.parquet", tmp_path)
    docs = pd.read_parquet(f"{d}/documents.parquet")
    extra = docs.iloc[[0, 1]].assign(doc_id=[90001, 90002], text=[None, docs.text[1] + " end"])
    pd.concat([docs, extra]).to_parquet(tmp_path / "documents.parquet", index=False)
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, str(tmp_path))
        if i < 4:
            assert out.columns == now.columns
        path = str(tmp_path / f"s{i}")
        out.write.parquet(path)
        now = spark.read.parquet(path)
        kept.append(now.toPandas())
    assert 90001 not in set(kept[0].doc_id) and len(kept[0]) >= len(docs) - 2
    groups = brute_components(zip(kept[0].doc_id, kept[0].text))
    assert set(kept[1].doc_id) == {i for i, (_, c) in groups.items() if c == i}
    assert 0 < len(kept[1]) - len(kept[2]) < 60
    share = kept[3].groupby("source").size()
    assert len(share) == kept[2].source.nunique()
    assert len(kept[4]) == len(kept[3]) and set(kept[4].shard) <= set(range(8))
    assert langid.SAMPLE_DOCS > 0


def test_null_doc_id_is_mixed(spark):
    docs = spark.createDataFrame([(None, "one two", "a"), (1, "three four", "a"), (2, "five", "a")], "doc_id long, text string, source string")
    assert {r.doc_id for r in corpus_pipeline.mixed(spark, docs, "").collect()} == {None, 1, 2}


def test_clashing_names_and_hard_rows(spark, messy, tmp_path):
    """Every stage on nulls, repeats and columns named as stages might name theirs."""
    from pyspark.sql import functions as F

    shutil.copy("/root/testdata/sf0.001/benchmark.parquet", tmp_path)
    names = ["lang_pred", "lang_score", "gone_id", "mixed_id", "mixed_copies", "mixed_turn", "copies", "kept", "removed"]
    docs = messy.union(messy.limit(1).withColumn("doc_id", F.lit(None).cast("long"))).select("*", *[F.lit("own").alias(n) for n in names])
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        assert i == 4 or out.columns == docs.columns
        out.write.parquet(str(tmp_path / f"m{i}"))
        docs = spark.read.parquet(str(tmp_path / f"m{i}"))
        ids = {r.doc_id for r in docs.collect()}
        assert ids == [{1, 2, 3, 7, 8, 9, 11, None}, {1, 7, 9, 11, None}, {1, 7, 9, 11, None}, ids, ids][i]
    assert docs.count() > 0


def test_without_languages(spark):
    rows = [(1, "clean words", None), (2, "12 34 !!", None), (3, None, None), (4, "élan", None), (5, "हिन्दी", None), (6, "", None)]
    out = corpus_pipeline.identified(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"), "")
    assert {r.doc_id for r in out.collect()} == {1, 4, 5} and out.columns == ["doc_id", "text", "lang"]


def test_empty(spark, tmp_path):
    d = "/root/testdata/sf0.001"
    shutil.copy(f"{d}/benchmark.parquet", tmp_path)
    pd.read_parquet(f"{d}/documents.parquet").iloc[:0].to_parquet(tmp_path / "documents.parquet", index=False)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
