"""Stages 4 and 5 end to end: files for a lender, and the offers that come back."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadforge.operators import cleaning as C
from leadforge.operators import rules as R
from leadforge.operators.mapping import map_offers
from leadforge.session import durable
from leadforge.sources import files as SF
from leadforge.sources.schemas import LENDER_OFFERS
from leadforge.sources.sinks import export_by_name


class Merged(Mapping):
    """Files of many names: one frame per merged layout, whose column ``name`` tells the file a row belongs to.

    As a mapping it gives the frame of one file name; work on all files goes over ``frames``, whose number does not
    depend on how many names there are.
    """

    def __init__(self, frames: list[DataFrame], places: dict[str, int], name: str):
        self.frames, self.places, self.name = frames, places, name

    def __getitem__(self, file_name: str) -> DataFrame:
        return self.frames[self.places[file_name]].filter(F.col(self.name) == file_name).drop(self.name)

    def __iter__(self):
        return iter(sorted(self.places))

    def __len__(self) -> int:
        return len(self.places)

    def map(self, change: Callable[[DataFrame], DataFrame]) -> Merged:
        return Merged([change(df) for df in self.frames], self.places, self.name)

    def of_kind(self, kind: str) -> DataFrame | None:
        """The rows of all files whose name holds ``kind``, together; None where there is no such file."""
        wanted = sorted({place for file_name, place in self.places.items() if kind in file_name.upper()})
        own = [self.frames[i].filter(F.contains(F.upper(self.name), F.lit(kind))).drop(self.name) for i in wanted]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), own) if own else None


def merge_batches(spark: SparkSession, inventory: DataFrame, batches: list[str], sep: str = "|") -> Merged:
    """Every file name once, holding the rows of that name in all chosen batches.

    Files are scanned once per header layout, whatever their names. A name whose batches have several layouts has the
    columns of all of them.
    """
    chosen = inventory.filter(F.col("batch").isin(*batches))
    heads = durable(chosen.select("path", "file_name").join(SF.header_columns(SF.header_lines(chosen), sep), "path"))
    files: dict[str, dict[tuple[str, ...], list[str]]] = {}
    for row in heads.orderBy("file_name", "path").toLocalIterator():  # an entry per file, as in all scans
        files.setdefault(row["file_name"], {}).setdefault(tuple(row["columns"]), []).append(row["path"])
    together: dict[tuple[str, ...], dict[tuple[str, ...], list[str]]] = {}
    names: dict[str, tuple[str, ...]] = {}
    for file_name, layouts in files.items():
        columns = {c.upper(): c for header in reversed(layouts) for c in reversed(SF.distinct_names(header))}
        names[file_name] = tuple(reversed(columns.values()))
        for header, paths in layouts.items():
            together.setdefault(names[file_name], {}).setdefault(header, []).extend(paths)
    name = "file_name"
    while any(name.upper() in map(str.upper, columns) for columns in together):
        name += "_"
    own = F.substring_index("file_path", "/", -1).alias(name)  # of every row, so no regular expression

    def scan(columns: tuple[str, ...], layouts: dict) -> DataFrame:
        rows = SF.scan_layouts(spark, layouts, list(columns), sep=sep, null_tokens=())
        return rows.filter(F.col(SF.BAD).isNull()).select(*[F.col(f"`{c}`") for c in columns], own)

    order = list(together)
    return Merged([scan(c, together[c]) for c in order], {n: order.index(c) for n, c in names.items()}, name)


def lender_export(
    spark: SparkSession,
    inventory: DataFrame,
    batches: list[str],
    criteria: dict,
    lender: str,
    bureau: str,
    lender_batch: str,
    as_of: dt.date,
    target: str | None = None,
    *,
    id_col: str = "CUSTOMER_ID",
    score_file: str = "SCORE",
    score_col: str = "SCORE_V3",
    features: DataFrame | None = None,
    feature_id: Column | None = None,
    aliases: dict[str, str] | None = None,
) -> tuple[Merged, DataFrame] | None:
    """(files with shortlisted rows only, shortlist record); None without a usable rule or score file.

    The shortlist is drawn from all score files together, by the score rule alone. With ``features``, a table of one row per
    customer whose id in the files is ``feature_id``, all rules act: each on the score files or the features, whichever
    has its field (``aliases``: feature columns by rule field). The id list is written once, meets every layout once, and the files
    of all names are written together, a folder ``file_name=...`` each; a file without shortlisted rows is not written.
    """
    merged = merge_batches(spark, inventory, batches)
    scores = merged.of_kind(score_file)
    if scores is None:
        return None
    score_col = next((c for c in (score_col, *R.SCORE_FIELDS) if c in scores.columns), score_col)  # a layout may rename it
    if features is None:
        ids = R.shortlist_ids(scores, criteria, id_col, score_col=score_col, score_only=True)
    else:
        own = F.col(id_col) if feature_id is None else feature_id
        ids = R.planned_ids([
            R.source(scores, F.col(id_col), dict.fromkeys(R.SCORE_FIELDS, score_col)), R.source(features, own, aliases),
        ], criteria)
    if ids is None:
        return None
    ids = durable(ids.distinct())
    kept = merged.map(lambda df: R.filter_by_ids(df, ids, id_col) if id_col in df.columns else df.limit(0))
    record = R.shortlist_record(kept.of_kind(score_file), id_col, lender_batch, lender, bureau, as_of)
    if target is not None:
        export_by_name(kept.frames, f"{target}/{lender}/{lender_batch}", kept.name, "|")
    return kept, record


# File kind, score column and key column of each lender and bureau.
SCORE_SOURCES = {
    ("prefr", "experian"): ("SCORE", "SCORE_V3", "CUSTOMER_ID"),
    ("zype", "experian"): ("SCORE", "SCORE_V3", "CUSTOMER_ID"),
    ("zype", "equifax"): ("AR", "SCORE", "CUSTOMER_ID"),
}


def export_for_lender(
    spark: SparkSession,
    lenders: DataFrame,
    inventory: DataFrame,
    batches: list[str],
    lender: str,
    bureau: str,
    lender_batch: str,
    as_of: dt.date,
    target: str | None = None,
    **features,
) -> tuple[Merged, DataFrame] | None:
    """``lender_export`` by the lender's active stored criteria; None where it has none or the bureau is not served.

    ``features`` are its arguments features, feature_id and aliases.
    """
    source = SCORE_SOURCES.get((lender.lower(), bureau.lower()))
    criteria = R.stored_criteria(lenders, lender, bureau)
    if source is None or criteria is None:
        return None
    score_file, score_col, id_col = source
    return lender_export(
        spark, inventory, batches, criteria, lender, bureau, lender_batch, as_of, target,
        id_col=id_col, score_file=score_file, score_col=score_col, **features)


def lender_offers(spark: SparkSession, inventory: DataFrame, as_of: dt.date, *, sep: str = ",", lender_name: str = "0") -> DataFrame:
    """All offer files of a folder, parsed and brought to the offers layout."""
    rows, _ = SF.scan_delimited(spark, inventory, LENDER_OFFERS, sep=sep, tolerant=True)
    return map_offers(C.parse_offer_columns(rows.drop("file_path")), as_of, lender_name=lender_name)
