"""Hot keys: joins and duplicate marking give the plain result, and adaptive execution splits what is skewed."""

import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from leadforge.catalog import registry
from leadforge.operators.leads import mark_duplicates
from leadforge.operators.skew import equi_join, flag_in

# Small data count as skewed, and nothing is broadcast.
SKEWED = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skewed(spark):
    before = {k: spark.conf.get(k, None) for k in SKEWED}
    for k, v in SKEWED.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(5)
    left = [(i, rng.choice(["hot", "hot", "a", "b", None, "z"]), rng.choice(["p", "q"])) for i in range(400)]
    right = [("hot", 1), ("hot", 2), ("a", 3), ("b", 4), ("c", 5), (None, 6)]
    return (spark.createDataFrame(left, "n int, k string, t string"), spark.createDataFrame(right, "k string, v int"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_equals_plain_join(sides, skewed, how):
    left, right = sides
    joined = equi_join(left, right, ["k"], how)
    plain = left.hint("broadcast").join(right.hint("broadcast"), "k", how).select(*joined.columns)
    assert sorted(map(str, joined.collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("key", ["'hot'", "cast(null as string)"])
def test_a_heavy_key_is_read_by_several_tasks(spark, skewed, key):
    left = spark.range(0, 20_000, 1, 8).selectExpr("id", f"if(id % 3 > 0, {key}, cast(id as string)) k", "repeat(cast(hash(id) as string), 5) t")
    right = spark.range(100).selectExpr("if(id = 0, 'hot', cast(id as string)) k", "id v")
    joined = equi_join(left, right, ["k"], "left")
    assert len(joined.collect()) == 20_000
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def test_a_batch_summary_reads_each_input_once(spark, folder):
    for key, most in (("batch_summary", 15), ("scrub_batch_monitor", 15)):
        plan = registry.queries()[key](spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"Exchange (?:hash|range)partitioning", plan)) <= most, plan


def test_flag_in_never_flags_null(sides):
    left, right = sides
    flagged = flag_in(left, right, ["k"], "known")
    assert flagged.count() == left.count()
    assert flagged.filter("k is null and known").count() == 0
    assert flagged.filter("k = 'z' and known").count() == 0
    assert flagged.filter("k = 'hot' and not known").count() == 0


def test_first_row_of_a_phone_is_new_whatever_its_weight(spark, skewed):
    rng = random.Random(9)
    rows = [("p", "b", rng.randrange(4), i, rng.choice(["hot", "hot", "x", "y", "", None])) for i in range(200)]
    df = spark.createDataFrame(rows, "partner_name string, batch_no string, file_seq int, row_seq int, hashed_phone string")
    marked = mark_duplicates(df)
    w = Window.partitionBy("hashed_phone").orderBy("file_seq", "row_seq")
    plain = df.withColumn("rn", F.row_number().over(w)).withColumn("ff", F.first("file_seq").over(w))
    expected = {
        r["row_seq"]: (
            ("not processed", None) if not r["hashed_phone"] or r["rn"] == 1
            else ("duplicate", "in_file" if r["ff"] == r["file_seq"] else "in_batch")
        )
        for r in plain.collect()
    }
    assert {r["row_seq"]: (r["status"], r["duplicate_kind"]) for r in marked.collect()} == expected
