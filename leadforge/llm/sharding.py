"""Sharding by balanced label propagation: linked documents move to one shard, the shards' bytes stay near equal.

Documents are linked through the group they belong to (equal texts), as a star: document to group, never document to
document. A document starts in the shard its id hashes to; of rows that agree in id and text each starts in one of its own. In
each round a group takes the label in which most of its bytes lie, and its members elsewhere ask to follow. Per shard a quota of bytes admits the askers, in the order of a hash
of their group, so that groups move whole. Groups too large for a shard stay spread by design of the quota. Last, ballast
(documents without links first) moves from full shards to open ones, in rounds, until the sizes are near equal.

Cases: a null text has no bytes; null texts are equal to each other; rows that repeat an id are separate documents; an
empty table gives no rows. Extra columns are not read. A document larger than an even share keeps its shard over-full.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadforge.llm.common import running_total, stored

SHARDS, ROUNDS, SETTLING, SLACK = 24, 3, 3, 0.02
LARGE = 200  # members


def documents(docs: DataFrame) -> DataFrame:
    """Narrow rows: id, size, checksum, group key, and a spread hash."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(
        "doc_id", (F.octet_length(raw) + 8).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        F.when(F.col("text").isNull(), "null").otherwise(F.sha2(raw, 256)).alias("group"),
    ).withColumn("mark", F.xxhash64("doc_id", "group"))  # repeated rows share a mark


def numbered(narrow: DataFrame) -> DataFrame:
    """The rows with a stored number ``row``; those that share a mark get marks of their own from it.

    So equal rows, however many, lie in many buckets, and all other marks depend on id and text alone.
    """
    rows = stored(narrow.withColumn("row", F.monotonically_increasing_id()), "numbered")
    shared = stored(rows.groupBy("mark").agg(F.count("*").alias("copies")).filter("copies > 1").select("mark", F.lit(True).alias("shared")), "shared")
    return rows.join(shared, "mark", "left").withColumn("mark", F.when(F.col("shared"), F.xxhash64("mark", "row")).otherwise(F.col("mark"))).drop("shared")


def _admit(askers: DataFrame, quota: DataFrame, order: str, rows: int, cost: str = "size") -> DataFrame:
    """The askers (with ``target``) whose running bytes per target stay within its quota."""
    line = running_total(askers, ["target"], order, ["doc_id", "size"], cost, "asked", rows)
    return line.join(F.broadcast(quota), "target").filter("asked <= quota").drop("quota")  # one row per shard


def _loads(labelled: DataFrame, shards: int, spark) -> DataFrame:
    """Bytes per shard, empty shards included."""
    grid = spark.range(shards).select(F.col("id").cast("int").alias("label"))
    sums = labelled.groupBy("label").agg(F.sum("size").alias("load"))
    return grid.join(F.broadcast(sums), "label", "left").select("label", F.coalesce("load", F.lit(0)).alias("load"))  # one row per shard


def propagate(labelled: DataFrame, shards: int, rounds: int, slack: float, rows: int) -> DataFrame:
    """Rounds of label propagation; ``labelled`` has ``label`` and the row number ``row``."""
    spark = labelled.sparkSession
    total = labelled.agg(F.sum("size")).first()[0] or 0
    capacity = total / shards * (1 + slack)
    for _ in range(rounds):
        per_label = labelled.groupBy("group", "label").agg(F.sum("size").alias("here"), F.count("*").alias("n"))
        wanted = per_label.groupBy("group").agg(
            F.max_by("label", F.struct("here", F.xxhash64("group", "label"))).alias("target"), F.sum("n").alias("members"), F.count("*").alias("labels"),
        ).filter("labels > 1").select("group", "target", "members")
        wanted = stored(wanted, "wanted")  # written, so that the join below meets two plain shuffles and can split a hot group
        askers = labelled.join(wanted, "group").filter("label <> target")
        # What leaves a shard in this round makes room in it for the next one, so a quota is the room now.
        quota = _loads(labelled, shards, spark).select(F.col("label").alias("target"), F.greatest(F.lit(0), F.lit(capacity) - F.col("load")).alias("room"))
        leaving = askers.groupBy("label").agg(F.sum("size").alias("leaves"))
        coming = askers.groupBy(F.col("target").alias("label")).agg(F.sum("size").alias("comes"))
        # Members on their way out free as much room as the average shard admits of its askers.
        flow = quota.join(F.broadcast(leaving.withColumnRenamed("label", "target")), "target", "left").join(F.broadcast(coming.withColumnRenamed("label", "target")), "target", "left")
        quota = flow.select("target", (F.col("room") + F.least(F.coalesce("leaves", F.lit(0)), F.coalesce("comes", F.lit(0)))).alias("quota"))
        # Small groups move whole; the members of one that would fill a bucket of the running total stand in line singly.
        rank = F.when(F.col("members") > LARGE, F.col("mark")).otherwise(F.xxhash64("group"))
        admitted = _admit(askers.withColumn("rank", F.xxhash64(rank, "target")), quota, "rank", rows).select("row", "target")
        moved = admitted.count()
        labelled = stored(labelled.join(admitted, "row", "left").withColumn("label", F.coalesce("target", "label")).drop("target"), "labels")
        if not moved:
            break
    return labelled


def settle(labelled: DataFrame, shards: int, rounds: int, rows: int) -> DataFrame:
    """Moves ballast from shards above the even share into those below it; single documents go before linked ones."""
    spark = labelled.sparkSession
    total = labelled.agg(F.sum("size")).first()[0] or 0
    share = total / shards
    members = stored(labelled.groupBy("group").agg(F.count("*").alias("members")).filter("members > 1"), "members")
    labelled = stored(labelled.join(members, "group", "left").withColumn("linked", F.col("members").isNotNull()).drop("members"), "ballast")
    for turn in range(rounds):
        loads = _loads(labelled, shards, spark)
        over = loads.select(F.col("label").alias("target"), F.greatest(F.lit(0.0), F.col("load") - F.lit(share)).alias("quota"))
        room = loads.select("label", F.greatest(F.lit(0.0), F.lit(share) - F.col("load")).alias("room"))
        # Documents larger than the largest opening would only move the excess about.
        largest = room.agg(F.max("room")).first()[0]
        pool = labelled.filter((F.col("size") <= F.lit(largest)) & (~F.col("linked") | F.lit(turn == rounds - 1)))
        # Of a shard's own excess a larger document cannot be part either; it would only use up the quota of others.
        pool = pool.join(F.broadcast(over.withColumnRenamed("target", "label")), "label").filter("size <= quota").drop("quota")
        spare = _admit(pool.withColumn("target", F.col("label")).withColumn("rank", F.xxhash64("mark", F.lit(turn))), over, "rank", rows)
        # What the shards give up is one line, shard after shard, and so are the openings: a document goes where its middle falls.
        earlier, upto = Window.orderBy("label").rowsBetween(Window.unboundedPreceding, -1), Window.orderBy("label").rowsBetween(Window.unboundedPreceding, 0)
        spare = stored(spare.drop("target"), "spare")
        given = spare.groupBy("label").agg(F.max("asked").alias("given")).select("label", F.coalesce(F.sum("given").over(earlier), F.lit(0)).alias("before"))
        openings = room.filter("room > 0").select(F.col("label").alias("target"), F.sum("room").over(upto).alias("until"), "room")
        line = spare.join(F.broadcast(given), "label")  # given and openings: at most a row per shard
        place = F.col("before") + F.col("asked") - F.col("size") / 2
        placed = line.join(F.broadcast(openings), (place <= F.col("until")) & (place > F.col("until") - F.col("room"))).select("row", "target")
        labelled = stored(labelled.join(placed, "row", "left").withColumn("label", F.coalesce("target", "label")).drop("target"), "settled")
    return labelled


def shard(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, settling: int = SETTLING, slack: float = SLACK) -> DataFrame:
    """Per document: size, checksum, shard, slot in the shard (gapless from 0), and its group."""
    narrow = stored(numbered(documents(docs)).withColumn("label", F.pmod("mark", F.lit(shards)).cast("int")), "documents")
    rows = narrow.count()
    labelled = settle(propagate(narrow, shards, rounds, slack, rows), shards, settling, rows)
    slots = running_total(labelled.withColumn("one", F.lit(1)), ["label"], "mark", ["doc_id", "row"], "one", "slot", rows)
    return slots.select("doc_id", "size", "text_crc32", F.col("label").alias("shard"), (F.col("slot") - 1).alias("slot"), "group")


def by_bytes(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The shards under the law of near equal bytes."""
    return shard(docs, shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
