"""Mixing sources to target weights by weighted fair queueing.

Sources, in code point order with null last, weigh ``weights`` in turn. They share ``share`` times all words; no source
gets more than ``repeats`` times its words, and what it cannot use goes to the others by weight. Each source is a queue of
its documents, shuffled anew for every repeat; a document's virtual finish time is the words queued up to and with it,
divided by the source's target. All queues together, in order of finish time, are cut at the total budget.

Cases: a null text has size 0; a document without words is never taken; null sources are one source; an empty table gives
no rows. Rows that repeat an id, or have none, stand in the queue singly: rows that agree in id, source, size and text digest are
numbered, and the number is part of a row's place. Extra columns are kept by ``mix`` and never read. The end of the queue, which a
range sort would give, is found by histograms of the finish times; only their sums pass the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadforge.llm.common import guarded_broadcast, plain, running_total, stored

WEIGHTS, SHARE, REPEATS, SEED = (3, 1, 2), 1.5, 2, 20
BINS = 1024
KEY = ["__id", "__name", "__nameless", "__size", "__digest"]
RUN = 10_000  # rows that one array numbers


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def keyed(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """``docs`` with the queue's key: id, source (null marked apart), size and a digest of the text."""
    return docs.withColumns({
        "__id": F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "__name": F.coalesce(F.col(source), F.lit("")),
        "__nameless": F.col(source).isNull(), "__size": word_count(F.col(text)), "__digest": F.xxhash64(F.col(text)),
    })


def _ranked(sources: DataFrame) -> DataFrame:
    """Sources with their position: range partitions in order, rows numbered inside, plus the rows of earlier partitions."""
    ordered = stored(sources.repartitionByRange("__nameless", "__name").withColumn("part", F.spark_partition_id()), "sources")
    counts = ordered.groupBy("part").agg(F.count("*").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy("__nameless", "__name"))
    return ordered.join(F.broadcast(before), "part").withColumn("position", F.col("before") + inside - 1)  # one row per partition


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """Per source (``__name``, ``__nameless``) its ``source_size`` and ``target``, from rows with ``words``."""
    sources = sizes.groupBy("__name", "__nameless").agg(F.sum("words").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("position") % len(weights) + 1).cast("int"))
    ranked = stored(_ranked(sources).select("__name", "__nameless", "source_size", weight.alias("weight")), "weights")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    budget, level = share * total, 0.0
    while total:  # the excess of full sources is shared again until no further one fills up; each pass fills at least one
        full = F.col("source_size") * repeats <= F.col("weight") * F.lit(level)
        row = ranked.agg(F.sum(F.when(full, F.col("source_size") * repeats)).alias("held"), F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        raised = (budget - (row["held"] or 0)) / row["open"] if row["open"] else level
        if raised <= level:
            break
        level = raised
    return ranked.select("__name", "__nameless", "source_size", F.least(F.col("source_size") * repeats, F.col("weight") * F.lit(level)).cast("double").alias("target"))


def _cut(queue: DataFrame, order: str, budget: float) -> tuple[float, float]:
    """The value of ``order`` at which the running words pass the budget, and the words before it.

    Histograms of ``BINS`` bins narrow the place down to one value; only their sums pass through the driver.
    """
    bounds = queue.agg(F.min(order).alias("low"), F.max(order).alias("high"), F.sum("words").alias("words")).first()
    low, high, before = bounds["low"], bounds["high"], 0
    if low is None or bounds["words"] <= budget:
        return float("inf"), 0
    while low < high:
        here = queue.filter((F.col(order) >= F.lit(low)) & (F.col(order) <= F.lit(high)))
        place = F.least(F.floor((F.col(order) - F.lit(low)) / F.lit((high - low) / BINS)), F.lit(BINS - 1))
        bins = here.groupBy(place.alias("bin")).agg(F.sum("words").alias("words"), F.min(order).alias("low"), F.max(order).alias("high"))
        for row in sorted(bins.collect(), key=lambda r: r["bin"]):  # at most BINS rows
            low, high = row["low"], row["high"]
            if before + row["words"] > budget:
                break
            before += row["words"]
    return low, before


def queue(narrow: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """The goals per source, and a row for each time a row of a key (``__copy``, from 1) is taken.

    ``narrow`` has a row per key with its ``rows`` and ``words``, the words of all of them, and is read several times.
    """
    goals = targets(narrow, weights, share, repeats)
    known = narrow.filter("words > 0").join(guarded_broadcast(goals, goals.count()), ["__name", "__nameless"])
    runs = known.withColumn("__from", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"), F.lit(RUN).cast("long"))))
    single = runs.withColumn("__copy", F.explode(F.sequence("__from", F.least(F.col("__from") + (RUN - 1), "rows")))).drop("__from")
    turns = single.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    turns = turns.withColumn("place", F.xxhash64("__id", "__size", "__digest", "__copy", "turn", F.lit(seed)))
    rows = narrow.agg(F.sum("rows")).first()[0] or 0
    # Every turn is one shuffled pass over a source; the passes before it have queued all its words.
    turns = running_total(turns, ["__name", "__nameless", "turn"], "place", ["__id", "__size", "__digest", "__copy"], "__size", "queued", rows)
    finish = (F.col("turn") * F.col("source_size") + F.col("queued")) / F.col("target")
    line = stored(turns.select(*KEY, "__copy", F.col("__size").alias("words"), "turn", F.col("place").cast("double").alias("place"), finish.alias("finish")), "queue")
    budget = goals.agg(F.sum("target")).first()[0] or 0.0
    end, before = _cut(line, "finish", budget)
    # Queues may finish at the same time; the shuffled place decides among those.
    edge, _ = _cut(line.filter(F.col("finish") == F.lit(end)), "place", budget - before)
    inside = (F.col("finish") < F.lit(end)) | ((F.col("finish") == F.lit(end)) & (F.col("place") < F.lit(edge)))
    return goals, line.filter(inside)


def _narrow(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEY).agg(F.sum("__size").alias("words"), F.count("*").alias("rows"))


def _numbered(rows: DataFrame, narrow: DataFrame) -> DataFrame:
    """The rows with ``__copy``: 1, or a number among those of the same key, which are alike, so that any order will do."""
    several = stored(narrow.filter("rows > 1").select(*KEY), "several")
    if several.isEmpty():
        return rows.withColumn("__copy", F.lit(1).cast("long"))
    alike = stored(rows.join(several, KEY, "left_semi").withColumn("__row", F.monotonically_increasing_id()), "alike")
    line = alike.withColumns({"__order": F.xxhash64("__row"), "__one": F.lit(1).cast("long")})
    numbered = running_total(line, KEY, "__order", ["__row"], "__one", "__copy", alike.count()).select(*plain(rows), "__copy")
    return rows.join(several, KEY, "left_anti").withColumn("__copy", F.lit(1).cast("long")).select(*plain(rows), "__copy").unionByName(numbered)


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mixed documents in queue order: a row for each time a document is taken, with the columns of ``docs``."""
    # The columns travel under names of their own, so that none is taken for the queue's.
    kept = [f"__kept_{i}" for i in range(len(docs.columns))]
    named = docs.select(*[c.alias(k) for c, k in zip(plain(docs), kept)])
    own = {c: kept[docs.columns.index(c)] for c in (doc_id, text, source)}
    rows = keyed(named, own[doc_id], own[text], own[source])
    narrow = stored(_narrow(rows), "sizes")
    _, line = queue(narrow, **options)
    key = [*KEY, "__copy"]
    order = line.select(*[F.col(k).alias(f"{k}_q") for k in key], F.col("finish").alias("__finish"), F.col("place").alias("__place"))
    same = [F.col(k) == F.col(f"{k}_q") for k in key]
    mixed = _numbered(rows, narrow).join(order, same).repartitionByRange("__finish", "__place").sortWithinPartitions("__finish", "__place")
    return mixed.select(*[F.col(k).alias(c) for k, c in zip(kept, docs.columns)])


def taken(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """Per document its size, its source's size and target, and the words the mix takes of it."""
    rows = stored(keyed(docs, doc_id, text, source).select(F.col(doc_id).alias("doc_id"), *KEY), "rows")
    narrow = stored(_narrow(rows), "sizes")
    goals, line = queue(narrow, **options)
    copies = line.groupBy(*KEY, "__copy").agg(F.count("*").alias("copies"))
    numbered = _numbered(rows, narrow)
    return numbered.join(guarded_broadcast(goals, goals.count()), ["__name", "__nameless"]).join(copies, [*KEY, "__copy"], "left").select(
        "doc_id", F.col("__size").alias("size"), "source_size", "target", (F.col("__size") * F.coalesce("copies", F.lit(0))).alias("taken"))
