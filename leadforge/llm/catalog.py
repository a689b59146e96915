"""The queries of this subpackage: each operator over its whole table, and the pipeline."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadforge.llm import bpe, filter_audit, jaccard, mixing, onebit, quality, repair, segments, sharding, simhash, suffixes, url_filter, warc
from leadforge.llm.common import scratch_path, stored, table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """The place of a public tokenizer's file; ``LEADFORGE_TOKENIZERS`` names another folder."""
    folder = os.environ.get("LEADFORGE_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    records = stored(warc.read(spark, path).drop("payload"), "records")
    return warc.captures(warc.assemble(records))


def op2_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_onebit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return onebit.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.by_bytes(table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.verdicts(table(spark, sf_dir, "pages"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removed(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repaired(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_segments": op2_segments,
    "op3_mixing": op3_mixing,
    "op4_bpe": op4_bpe,
    "op5_quality": op5_quality,
    "op6_onebit": op6_onebit,
    "op7_sharding": op7_sharding,
    "op8_url_filter": op8_url_filter,
    "op9_simhash": op9_simhash,
    "op10_suffixes": op10_suffixes,
    "op11_filter_audit": op11_filter_audit,
    "op12_jaccard": op12_jaccard,
    "op13_repair": op13_repair,
}

# Base32 of SHA-1: each 5 of the 40 hex digits make 4 letters of 5 bits.
ORACLES: dict[str, str] = {
    "op1_warc": """
with p as (select page_id, coalesce(html, '') as body from pages),
d as (select page_id, strlen(body) as payload_bytes, sha1(body) as hex, max(page_id) over (partition by body) as newest from p)
select page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + cast(
           list_reduce(list_transform(range(5), lambda j: cast(strpos('0123456789abcdef', substr(hex, cast(5 * (i // 4) + j + 1 as int), 1)) - 1 as bigint)), lambda a, b: a * 16 + b)
           // cast(power(32, 3 - i % 4) as bigint) % 32 as int), 1)), '') as payload_digest,
       case when page_id = newest then 'response' else 'revisit' end as record_type,
       case when page_id <> newest then newest end as refers_to
from d""",
    "op2_segments": """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e from embeddings
           where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.e, c.e) as bigint) as score
      from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id),
r as (select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank, vec_id, score from s)
select query_id, rank, vec_id, score from r where rank <= 5""",
    "op11_filter_audit": r"""
with l as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic from labels group by doc_id),
d as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as body from documents),
w as (select d.*, regexp_extract_all(body, '[^\x20\x09-\x0D]+') as words, min(doc_id) over (partition by body) as least from d),
f as (select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
        len(words) < 200 as a, 100 * len(list_distinct(words)) < 50 * len(words) as b,
        100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 2 * length(body) as c, regexp_matches(body, '[#$%&*|]') as d,
        coalesce(doc_id > least, false) as e
      from w left join l using (doc_id)),
m as (select part, good, toxic, a::int + 2 * b::int + 4 * c::int + 8 * d::int + 16 * e::int as mask, count(*) as n from f group by all),
x as (select unnest(['A', 'B', 'C', 'D', 'E']) as letter, unnest([1, 2, 4, 8, 16]) as bit),
o as (select p.letter || q.letter || r.letter || s.letter || t.letter as filter_order, [p.bit, q.bit, r.bit, s.bit, t.bit] as bits
      from x p, x q, x r, x s, x t where p.bit + q.bit + r.bit + s.bit + t.bit = 31 and (p.bit | q.bit | r.bit | s.bit | t.bit) = 31),
k as (select filter_order, cast(unnest(range(1, 6)) as int) as step, bits from o),
g as (select filter_order, step, bits[step] as bit, coalesce(list_sum(bits[1:step - 1]), 0)::bigint as earlier from k),
r as (select part, filter_order, step, bit,
        cast(sum(case when mask & (bit | earlier) = 0 then n else 0 end) as bigint) as kept,
        cast(sum(case when mask & bit > 0 and mask & earlier = 0 then n else 0 end) as bigint) as removed,
        cast(sum(case when mask & bit > 0 and mask & earlier > 0 then n else 0 end) as bigint) as redundant,
        cast(sum(case when mask = bit then n else 0 end) as bigint) as unique_fails,
        cast(sum(case when mask & bit > 0 and mask & earlier = 0 and good = 1 then n else 0 end) as bigint) as good_lost,
        cast(sum(case when mask & bit > 0 and mask & earlier = 0 and toxic = 1 then n else 0 end) as bigint) as toxic_lost
      from m, g group by all)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       cast(sum(removed) over (partition by part, bit) as bigint) as shapley from r""",
}
