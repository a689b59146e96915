"""The pipeline's stages against brute force on a small folder."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from leadforge.llm import quality
from llm_plain import classes, plain_print, repeated


@pytest.fixture(scope="module")
def kept(spark, folder):
    return [s for s in corpus_pipeline.STAGES], spark.read.parquet(f"{folder}/documents.parquet")


def test_stages(spark, folder, kept):
    stages, docs = kept
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    good = spark.createDataFrame(stages[0][1](spark, docs, folder).collect(), docs.schema)
    scores = {r.doc_id: r.score for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    assert {r.doc_id for r in good.collect()} == {d for d, s in scores.items() if s >= 0.5}
    rows = sorted(good.collect(), key=lambda r: r.doc_id)
    names = classes([plain_print(r.text) for r in rows], [r.doc_id for r in rows])
    single = spark.createDataFrame(stages[1][1](spark, good, folder).collect(), docs.schema)
    assert sorted(r.doc_id for r in single.collect()) == [r.doc_id for r, c in zip(rows, names) if r.doc_id == c]
    rows = sorted(single.collect(), key=lambda r: r.doc_id)
    short = spark.createDataFrame(stages[2][1](spark, single, folder).collect(), docs.schema)
    want = repeated([(r.doc_id, r.text.encode()) for r in rows])
    for r, (n, gone, _, digest) in zip(sorted(short.collect(), key=lambda r: r.doc_id), want):
        assert r.n_chars == len(r.text)
        if "�" not in r.text:
            assert len(r.text.encode()) == n - gone and hashlib.sha256(r.text.encode()).hexdigest() == digest
    mixed = stages[3][1](spark, short, folder)
    assert mixed.columns == docs.columns
    times = {r.doc_id: r.n for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert set(times.values()) <= {1, 2}
    ids = stages[4][1](spark, mixed, folder)
    assert {r.doc_id: r.n for r in ids.groupBy("doc_id").agg(F.count("*").alias("n")).collect()} == times


def test_run_names_and_columns(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 0


def test_extra_and_clashing_columns(spark, folder):
    names = ["n_bytes", "spans", "kept", "finish", "place", "__score", "__id", "__data", "__size", "__kept_0", "k_doc_id", "words", "score", "bits", "component_id", "root", "digest", "a.b`c", "__split", "__key", "__many", "label"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    wide = docs.select(*[F.concat_ws("/", F.lit(n), F.col("doc_id")).alias(n) for n in names], "*", F.array("lang").alias("list"), F.create_map("lang", F.col("doc_id")).alias("map"), F.struct("lang").alias("pair"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        want = sorted(tuple(r) for r in stage(spark, docs, folder).collect())
        out = stage(spark, wide, folder)
        assert out.columns == wide.columns
        rows = out.collect()
        assert sorted(tuple(r[c] for c in docs.columns) for r in rows) == want and want
        assert all(r[n] == f"{n}/{r.doc_id}" for r in rows for n in names)
        assert all(r["list"] == [r.lang] and r["map"] == {r.lang: r.doc_id} and r["pair"].lang == r.lang for r in rows)
    assert corpus_pipeline.STAGES[-1][1](spark, wide, folder).count() == docs.count()


def test_rows_without_an_id_are_compared_too(spark, folder):
    base = [" ".join(f"w{k}x{i}" for i in range(300)) for k in range(4)]
    rows = [(1, base[0]), (None, base[0]), (None, base[0].upper()), (None, base[1]), (None, base[1]), (None, base[1].upper()), (None, base[2]), (4, base[3]), (4, base[3])]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.without_near_duplicates(spark, docs, folder).collect()
    first = min(base[1], base[1].upper(), key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted([(1, base[0]), (None, first), (None, base[2]), (4, base[3])], key=str)


def test_one_row_of_each_near_duplicate_group_stays_whatever_the_ids(spark, folder):
    a, b, c = ("a b c d e f g", "q r s t u v w x y", "nobody has this one")
    rows = [(3, b), (5, a), (5, b), (5, b), (None, a), (None, c), (None, c), (9, c + " at all")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.without_near_duplicates(spark, docs, folder)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(3, b), (5, a), (None, c), (9, c + " at all")], key=str)
