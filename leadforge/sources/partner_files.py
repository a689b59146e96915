"""Partner upload files: header clean-up and text encodings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadforge.sources.files import decoded, distinct_names, header_lines, literal

# Header spellings that partners use.
HEADER_ALIASES = {
    "PId": "PARTNER_REFERENCE_ID",
    "pid": "PARTNER_REFERENCE_ID",
    "PID": "PARTNER_REFERENCE_ID",
    "phone": "PHONE",
    "masked_phone": "MASKED_PHONE",
    "hashed_phone": "HASHED_PHONE",
}


def standard_name(header: str) -> str:
    trimmed = header.strip()
    return HEADER_ALIASES.get(trimmed, trimmed).upper()


def standardise(df: DataFrame) -> DataFrame:
    """Trimmed, aliased, upper-case headers; trimmed text cells."""
    return df.select(
        *[
            (F.trim(F.col(f"`{name}`")) if kind == "string" else F.col(f"`{name}`")).alias(standard_name(name))
            for name, kind in df.dtypes
        ]
    )


def detect_encodings(spark: SparkSession, inventory: DataFrame) -> DataFrame:
    """(path, encoding, header) of every file.

    A byte-order mark decides; else a file whose every line is valid UTF-8 is UTF-8, and any other is
    latin1, which reads all bytes. Lines are checked where they lie, so large files are split over tasks.
    """
    heads = header_lines(inventory)
    paths = [literal(r["path"]) for r in inventory.select("path").distinct().toLocalIterator()]
    checked = (
        spark.read.schema("value string").text(paths)
        .groupBy(decoded(F.col("_metadata.file_path")).alias("path"))
        .agg(F.bool_and(F.expr("is_valid_utf8(value)")).alias("clean"))
    )
    judged = heads.join(checked, "path", "left")
    plain = F.when(F.coalesce("clean", F.lit(True)), "UTF-8").otherwise("ISO-8859-1")
    return judged.select("path", F.coalesce("marker", plain).alias("encoding"), "header")


def scan_partner_csv(spark: SparkSession, inventory: DataFrame) -> DataFrame:
    """Partner files as one frame of trimmed text columns under standard names.

    One scan per encoding and header layout; layouts are unified by name. A file without a hashed phone uses
    its phone instead. FILENAME, FILE_OFFSET and ROW_SEQ give the place of a row: the file, the split
    inside it and the row inside the split.
    """
    layouts: dict[tuple[str, str], list[str]] = {}
    for row in detect_encodings(spark, inventory).toLocalIterator():
        layouts.setdefault((row["encoding"], row["header"]), []).append(row["path"])
    frames = []
    for (encoding, header), paths in layouts.items():
        names = distinct_names(standard_name(n.strip().strip('"')) for n in header.split(","))
        wide = encoding.startswith("UTF-16")
        reader = spark.read.schema(", ".join(f"`{n}` string" for n in names)).options(
            header=True, sep=",", encoding=encoding, multiLine=wide, enforceSchema=True
        )
        rows = reader.csv([literal(p) for p in sorted(paths)])
        stand_in = [F.trim(F.col("PHONE")).alias("HASHED_PHONE")] if "PHONE" in names and "HASHED_PHONE" not in names else []
        frames.append(
            rows.select(
                *[F.trim(F.col(f"`{n}`")).alias(n) for n in names],
                *stand_in,
                F.regexp_extract(decoded(F.col("_metadata.file_path")), r"([^/]+)$", 1).alias("FILENAME"),
                F.col("_metadata.file_block_start").alias("FILE_OFFSET"),
                F.monotonically_increasing_id().alias("ROW_SEQ"),
            )
        )
    nothing = spark.createDataFrame([], ", ".join(f"{n} string" for n in dict.fromkeys(HEADER_ALIASES.values())) + ", FILENAME string, FILE_OFFSET long, ROW_SEQ long")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) if frames else nothing
