"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import inspect
import math
import os
import tempfile
import zipfile
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadforge.session import scratch_path

BROADCAST_ROWS = 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Sends the modules that tasks import along with the job, so executors need no copy of the package."""
    context = spark.sparkContext
    if getattr(context, "_leadforge_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="leadforge-"), "leadforge_tasks.zip")  # the driver's own copy, served by Spark
    with zipfile.ZipFile(archive, "w") as bundle:
        llm = sorted(f"llm/{name}" for name in os.listdir(os.path.join(top, "llm")) if name.endswith(".py"))
        for name in ["__init__.py", "session.py", *llm]:
            bundle.write(os.path.join(top, name), f"leadforge/{name}")
    context.addPyFile(archive)
    context._leadforge_shipped = True


def give_back() -> None:
    """Returns freed memory to the system: Spark keeps Python workers for later stages, which need it for themselves."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run: Callable) -> Callable:
    """The function over batches, giving back memory when its partition is done."""

    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def tidy_group(run: Callable) -> Callable:
    """The function over groups, giving back memory after each."""

    def tidied(*tables):
        try:
            return run(*tables)
        finally:
            give_back()

    # Spark reads from the number of parameters whether a group's key is wanted.
    return (lambda left, right: tidied(left, right)) if len(inspect.signature(run).parameters) == 2 else (lambda table: tidied(table))


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame as written to the shared folder: computed once, and safe from lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plain(df: DataFrame) -> list[Column]:
    """The frame's columns, whatever their names."""
    return [F.col(quoted(c)) for c in df.columns]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until the frame has no column that Spark takes for the same."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def binary_text(column: str | Column) -> Column:
    """The UTF-8 bytes of a text; a null text has none."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column, F.lit("")).cast("binary")


def guarded_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """The frame, hinted for broadcast only where its counted rows are few; else Spark joins it by sort and splits skew."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def running_total(df: DataFrame, group: list[str], order: str, tie: list[str], value: str, out: str, rows: int) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of the group up to and with this one, by ``order``.

    ``order`` is a spread 64-bit hash; its leading bits cut a group into nested buckets of about 1,000 rows in the
    largest group possible, so no window ever holds a whole group. Sums of buckets are added level by level: each
    level's window runs over at most 1,024 buckets. Rows that agree in ``order`` and ``tie`` are interchangeable.
    """
    levels = max(1, math.ceil(math.log2(max(rows, 1) / 1000) / 10)) if rows > 1000 else 1
    fine = df
    names = []
    for level in range(levels):
        name = f"__bucket_{level}"
        # The sign bit is flipped so that the numeric order of the hash is the order of its buckets.
        fine = fine.withColumn(name, F.shiftrightunsigned(F.col(order).bitwiseXOR(F.lit(-(2**63))), 54 - 10 * level).bitwiseAND(1023))
        names.append(name)
    keys = [f"__key_{i}" for i in range(len(group))]
    named = fine
    sums = named.groupBy(*group, *names).agg(F.sum(value).alias("__sum"))
    offsets = None
    for level in reversed(range(levels)):
        upto = sums.groupBy(*group, *names[: level + 1]).agg(F.sum("__sum").alias("__part"))
        window = Window.partitionBy(*group, *names[:level]).orderBy(names[level]).rowsBetween(Window.unboundedPreceding, -1)
        upto = upto.select(*group, *names[: level + 1], F.coalesce(F.sum("__part").over(window), F.lit(0)).alias(f"__before_{level}"))
        if offsets is None:
            offsets = upto
        else:
            renamed = upto.select(*[F.col(g).alias(k) for g, k in zip(group, keys)], *[F.col(n).alias(f"{n}_r") for n in names[: level + 1]], f"__before_{level}")
            condition = [F.col(g).eqNullSafe(F.col(k)) for g, k in zip(group, keys)]
            condition += [F.col(n) == F.col(f"{n}_r") for n in names[: level + 1]]
            offsets = offsets.join(renamed, condition).drop(*keys, *[f"{n}_r" for n in names[: level + 1]])
    before = sum((F.col(f"__before_{level}") for level in range(levels)), F.lit(0))
    offsets = offsets.select(*[F.col(g).alias(k) for g, k in zip(group, keys)], *[F.col(n).alias(f"{n}_r") for n in names], before.alias("__before"))
    condition = [F.col(g).eqNullSafe(F.col(k)) for g, k in zip(group, keys)]
    condition += [F.col(n) == F.col(f"{n}_r") for n in names]
    window = Window.partitionBy(*group, *names).orderBy(order, *tie).rowsBetween(Window.unboundedPreceding, 0)
    return (
        fine.join(offsets, condition)
        .withColumn(out, F.col("__before") + F.sum(value).over(window))
        .drop(*names, *keys, *[f"{n}_r" for n in names], "__before")
    )
