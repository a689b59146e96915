"""The corpus pipeline: quality, near-duplicates, repeated passages, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written and read again as the next stage's documents.
All stages but the last return the columns of ``documents``; further ones are carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadforge.llm import bpe, mixing, quality, simhash, suffixes
from leadforge.llm.catalog import tokenizer_path
from leadforge.llm.common import binary_text, plain, stored, table, unused

WORDS, DISTANCE = 3, 3


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good ones stay. It learns from the labelled rows of its own input."""
    network = quality.fit(docs, table(spark, sf_dir, "labels"))
    out = unused(docs, "__score")
    return quality.score(docs, network, out=out).filter(F.col(out) >= 0.5).select(*plain(docs))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one document stays: that with the smallest id (none comes last), of several texts under that id
    the one with the smallest digest. Rows that agree in both stay once.
    """
    digest = F.sha2(binary_text("text"), 256)
    members = simhash.members(docs.select("doc_id", "text", digest.alias("digest")), words=WORDS, distance=DISTANCE, keep=("digest",))
    first = members.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "digest")).alias("first"))
    id_kept, mark = unused(docs, "__id"), unused(docs, "__digest")
    chosen = first.select(F.col("first.doc_id").alias(id_kept), F.col("first.digest").alias(f"{mark}_kept"))
    same = F.col("doc_id").eqNullSafe(F.col(id_kept)) & (F.col(mark) == F.col(f"{mark}_kept"))
    kept = docs.withColumn(mark, digest).join(chosen, same, "left_semi").dropDuplicates(["doc_id", mark])
    return kept.select(*plain(docs))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out; a character cut through becomes the replacement character."""
    # The operator sees its two columns and the others under names that its own do not have.
    carried = {c: f"__kept_{i}" for i, c in enumerate(docs.columns) if c not in ("text", "n_chars")}
    seen = docs.select("text", *[x.alias(carried[c]) for c, x in zip(docs.columns, plain(docs)) if c in carried])
    cut = suffixes.dedup(seen, doc_id=carried["doc_id"], keep=tuple(carried.values()))
    text = F.make_valid_utf8(F.col("kept").cast("string"))
    own = {"text": text, "n_chars": F.char_length(text).cast("long")}
    return cut.select(*[own.get(c, F.col(carried.get(c, "kept"))).alias(c) for c in docs.columns])


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources, a row for each time a document is taken."""
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document taken: number of tokens, digests of its ids and of the text they decode to."""
    return bpe.digests(docs, tokenizer_path())


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", without_near_duplicates),
    ("suffix-array dedup", without_repeats),
    ("mixing sources", mixed),
    ("BPE encoding", token_ids),
]

# A trained network and hash searches are no SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
