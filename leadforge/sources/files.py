"""File listings, headers and delimited scans."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadforge.session import scratch_path

# The few functions that run inside tasks travel with them, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Texts that stand for NULL in bureau files, and the accepted file endings.
NULL_TOKENS = ("NULL", "NUL", "")
BUREAU_ENDINGS = (".csv", ".txt", ".xlsx")
PARTNER_ENDINGS = (".csv", ".xls", ".xlsx")  # only the first is read here

SMALL_FILE = 1 << 20  # bytes; files up to this size are read whole for their first line
HEAD_BYTES, HEADS_AT_ONCE = 16_384, 16


def decoded(file_path: Column) -> Column:
    """A path as listings spell it, from the percent-encoded form that scans report; most rows' paths have nothing to decode."""
    encoded = F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(file_path, F.lit("%")), encoded).otherwise(file_path)


def _folder(spark: SparkSession, path: Column, root: str) -> Column:
    """The folder of a file as seen from ``root``; a dot for files in the root itself."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(root)
    top = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop_path).toString().rstrip("/")
    parent = F.regexp_replace(path, r"/[^/]+$", "")
    below = F.substr(parent, F.lit(len(top) + 2))
    return F.when(parent == top, ".").when(F.startswith(parent, F.lit(top + "/")), below).otherwise(parent)


def listing(listed: DataFrame, root: str) -> DataFrame:
    """(path, folder, batch, file_name, bytes) of a frame of files (path, length).

    ``folder`` and ``file_name`` together name a file; the batch is the last part of its folder.
    """
    return listed.select(
        "path",
        _folder(listed.sparkSession, F.col("path"), root).alias("folder"),
        F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("batch"),
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
        F.col("length").alias("bytes"),
    ).distinct()


def file_inventory(spark: SparkSession, root: str, batches: list[str] | None = None) -> DataFrame:
    """The listing of all files below ``root``; only the listing is read, never the content."""
    files = listing(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root), root)
    return files if batches is None else files.filter(F.col("batch").isin(*batches))


def file_ending() -> Column:
    return F.lower(F.regexp_extract("file_name", r"(\.[^.]*)$", 1))


def format_report(inventory: DataFrame, endings: tuple[str, ...] = BUREAU_ENDINGS) -> DataFrame:
    return inventory.select("batch", "file_name", file_ending().isin(*endings).alias("is_valid"))


def common_unique(inventory: DataFrame) -> DataFrame:
    """File names with the batches that hold them: common when in several, unique when in one."""
    per_name = inventory.groupBy("file_name").agg(
        F.array_sort(F.collect_set("batch")).alias("batches"), F.count_distinct("batch").alias("batch_count")
    )
    return per_name.select(
        "file_name", "batches", "batch_count", F.when(F.col("batch_count") > 1, "common").otherwise("unique").alias("kind")
    )


def _first_line(content: bytes) -> tuple[str, str | None]:
    if content[:2] in (b"\xff\xfe", b"\xfe\xff"):
        even = content[: len(content) - len(content) % 2]
        return even.decode("utf-16", "replace").split("\n")[0].rstrip("\r"), "UTF-16"
    line = content.split(b"\n")[0].rstrip(b"\r")
    if content[:3] == b"\xef\xbb\xbf":
        return line[3:].decode("utf-8", "replace"), "UTF-8"
    try:
        return line.decode("utf-8"), None
    except UnicodeDecodeError:
        return line.decode("latin1"), None


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, header, marker) of every file in a partition of (path, line)."""
    last = None
    for batch in batches:
        found = []
        for path, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if path != last:  # a file's lines follow one another
                found.append((path, *_first_line(line)))
                last = path
        columns = list(zip(*found)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["path", "header", "marker"])


def _head(spark: SparkSession, path: str) -> tuple[str, str, str | None]:
    """The same of one file, by the file access of Spark's readers: read piece by piece up to the end of its first line."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    try:
        taken = b""
        while b"\n" not in taken and (piece := bytes(stream.readNBytes(HEAD_BYTES))):
            taken += piece
    finally:
        stream.close()
    return path, *_first_line(taken)


def header_lines(inventory: DataFrame) -> DataFrame:
    """First line and byte-order mark of every file, from any store that Spark's readers open.

    Files of up to ``SMALL_FILE`` are packed to partitions and read by Spark's text reader. Of a larger one only the first block is
    wanted, for which Spark has no scan; the driver reads it, some files at a time, and keeps the line. The lines of the small ones
    are written to the shared folder at once. (The text reader drops a UTF-8 mark; such a file counts as one without.)
    """
    spark = inventory.sparkSession
    files = [(r["path"], r["bytes"]) for r in inventory.select("path", "bytes").distinct().toLocalIterator()]  # as in every scan
    small = [literal(p) for p, n in files if n <= SMALL_FILE]
    layout = "path string, header string, marker string"
    with ThreadPoolExecutor(HEADS_AT_ONCE) as pool:
        large = list(pool.map(lambda file: _head(spark, file[0]), [f for f in files if f[1] > SMALL_FILE]))
    heads = spark.createDataFrame(large, layout)
    if small:
        lines = spark.read.schema("value string").option("lineSep", "\n").text(small)
        rows = lines.select(decoded(F.col("_metadata.file_path")).alias("path"), F.col("value").cast("binary").alias("line"))
        written = scratch_path(spark, "heads")
        rows.mapInArrow(_heads, layout).write.parquet(written)
        heads = heads.unionByName(spark.read.schema(layout).parquet(written))
    named = inventory.select("path").distinct()
    return named.join(heads, "path", "left").withColumn("header", F.coalesce("header", F.lit("")))  # an empty file has no line


def header_columns(headers: DataFrame, sep: str = "|") -> DataFrame:
    """Header lines split into trimmed column names without quotes."""
    names = F.split(F.regexp_replace("header", '"', ""), "\\Q" + sep + "\\E")
    return headers.select("path", F.transform(names, F.trim).alias("columns"))


def _named_array(names: list[str]) -> Column:
    return F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")


def header_report(headers: DataFrame, schema: T.StructType, *, strict: bool = False) -> DataFrame:
    """Per file: expected columns that are missing, unexpected ones, missing required ones, and the verdict.

    A header that names a column twice is not valid.
    """
    expected = _named_array([f.name for f in schema.fields])
    required = _named_array([f.name for f in schema.fields if not f.nullable])
    compared = headers.select(
        "path", F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
        F.array_except(expected, "columns").alias("missing_columns"),
        F.array_except("columns", expected).alias("extra_columns"),
        F.array_except(required, "columns").alias("missing_required"),
        (F.size(F.array_distinct("columns")) < F.size("columns")).alias("repeated"),
    )
    valid = (F.size("missing_required") == 0) & ~F.col("repeated")
    return compared.withColumn("is_valid", valid & (F.size("extra_columns") == 0) if strict else valid).drop("repeated")


def partner_header_report(headers: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """Per partner file: a reference id is needed, and a phone or a hashed phone."""
    def standard(name):
        chain = F
        for spelling, target in aliases.items():
            chain = chain.when(name == spelling, target)
        return F.upper(chain.otherwise(name))

    found = headers.select(
        "path", F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), F.transform("columns", standard).alias("found_columns")
    )
    no_id = ~F.array_contains("found_columns", "PARTNER_REFERENCE_ID")
    no_phone = ~F.arrays_overlap("found_columns", _named_array(["PHONE", "HASHED_PHONE"]))
    missing = F.concat(
        F.when(no_id, _named_array(["PARTNER_REFERENCE_ID"])).otherwise(_named_array([])),
        F.when(no_phone, _named_array(["PHONE or HASHED_PHONE"])).otherwise(_named_array([])),
    )
    return found.withColumn("missing_columns", missing).withColumn("is_valid", F.size("missing_columns") == 0)


BAD = "_bad_row"


def distinct_names(names: Iterable[str]) -> list[str]:
    """Column names; those that repeat an earlier one get a number."""
    seen: set[str] = set()
    out = []
    for name in names:
        fresh, turn = name, 1
        while fresh.upper() in seen:
            turn += 1
            fresh = f"{name}__{turn}"
        seen.add(fresh.upper())
        out.append(fresh)
    return out


def literal(path: str) -> str:
    """A path with the characters escaped that readers take for wildcards."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _read_layout(spark, paths: list[str], names: list[str], sep: str) -> DataFrame:
    """All rows of files with one header layout; rows with a wrong number of cells keep their text in BAD.

    Without column pruning every row is split in full, so the verdict on a row does not depend on the
    columns that a query happens to use.
    """
    layout = T.StructType([T.StructField(n, T.StringType()) for n in names] + [T.StructField(BAD, T.StringType())])
    reader = spark.read.schema(layout).options(
        header=True, sep=sep, quote='"', mode="PERMISSIVE", columnNameOfCorruptRecord=BAD,
        enforceSchema=True, columnPruning=False, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    return reader.csv([literal(p) for p in paths]).withColumn("file_path", decoded(F.col("_metadata.file_path")))


def _first_cell_read(names: list[str]) -> Column:
    """Always true, but names the first cell: Spark refuses scans that ask for the bad-row column alone,
    as a plain row count would."""
    return F.length(F.coalesce(F.col(f"`{names[0]}`"), F.lit(""))) >= 0


def scan_rows(
    spark: SparkSession,
    inventory: DataFrame,
    schema: T.StructType | None = None,
    *,
    sep: str = "|",
    null_tokens: tuple[str, ...] = NULL_TOKENS,
    heads: DataFrame | None = None,
) -> DataFrame:
    """All rows of all files of an inventory, in one scan per header layout: cells, ``file_path`` and BAD.

    Columns are matched by header name; columns that a file lacks are NULL, columns outside ``schema`` are
    dropped (all are kept without a schema). BAD is the text of rows with a wrong number of cells. Files
    stay splittable, so one very large file is read by many tasks. ``heads`` are the header lines of the
    files where the caller has read them already.
    """
    if heads is None:
        heads = header_lines(inventory)
    layouts: dict[tuple[str, ...], list[str]] = {}
    for row in header_columns(heads, sep).toLocalIterator():  # a path per file, as Spark's own file index holds them
        layouts.setdefault(tuple(row["columns"]), []).append(row["path"])
    wanted = [f.name for f in schema.fields] if schema is not None else None
    return scan_layouts(spark, layouts, wanted, sep=sep, null_tokens=null_tokens)


def scan_layouts(
    spark: SparkSession, layouts: dict[tuple[str, ...], list[str]], wanted: list[str] | None = None, *,
    sep: str = "|", null_tokens: tuple[str, ...] = NULL_TOKENS,
) -> DataFrame:
    """``scan_rows`` of files that are grouped by header layout already."""
    scans = []
    for header, paths in layouts.items():
        columns = distinct_names(header)
        rows = _read_layout(spark, sorted(paths), columns, sep)
        upper = {c.upper(): c for c in columns}
        cells = [
            F.when(~F.col(f"`{upper[n.upper()]}`").isin(*null_tokens), F.col(f"`{upper[n.upper()]}`")).alias(n)
            if n.upper() in upper else F.lit(None).cast("string").alias(n)
            for n in wanted or columns
        ]
        scans.append(rows.filter(_first_cell_read(columns)).select(*cells, "file_path", BAD))
    if not scans:
        names = [*(wanted or []), "file_path", BAD]
        return spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in names]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def scan_delimited(
    spark: SparkSession,
    inventory: DataFrame,
    schema: T.StructType | None = None,
    *,
    sep: str = "|",
    null_tokens: tuple[str, ...] = NULL_TOKENS,
    tolerant: bool = False,
    heads: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(rows, bad rows) of ``scan_rows``: rows with a wrong number of cells are bad rows, unless ``tolerant``."""
    rows = scan_rows(spark, inventory, schema, sep=sep, null_tokens=null_tokens, heads=heads)
    good = rows if tolerant else rows.filter(F.col(BAD).isNull())
    return good.drop(BAD), rows.filter(F.col(BAD).isNotNull()).select("file_path", F.col(BAD).alias("line"))


def empty_file_report(inventory: DataFrame, rows: DataFrame, reports: DataFrame) -> DataFrame:
    """Per file: number of rows and a message for files without rows or with a wrong header."""
    counted = rows.groupBy(F.col("file_path").alias("path")).agg(F.count(F.lit(1)).alias("row_count"))
    joined = (
        inventory.select("path", "batch", "file_name").join(counted, "path", "left").fillna(0, ["row_count"])
        .join(reports.select("path", "is_valid"), "path", "left").drop("path")
    )
    message = F.when(~F.col("is_valid"), "schema mismatched").when(F.col("row_count") == 0, "no records found")
    return joined.withColumn("message", message)
