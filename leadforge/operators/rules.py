"""Lender criteria: parsing, evaluation, shortlists."""

from __future__ import annotations

import datetime as dt
import operator
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadforge.operators.skew import equi_join

CRITERIA_SCHEMA = "logic string, rules array<struct<field: string, operator: string, value: double>>, version string"
OPERATORS = {
    ">=": operator.ge, "<=": operator.le, ">": operator.gt, "<": operator.lt,
    "=": operator.eq, "==": operator.eq, "===": operator.eq,
}
SCORE_FIELDS = ("SCORE", "SCORE_V3")


def criteria_rows(lenders: DataFrame) -> DataFrame:
    """One row per lender, bureau and rule; lenders with empty or unreadable criteria are skipped."""
    parsed = lenders.withColumn("criteria", F.from_json("eligible_criteria", CRITERIA_SCHEMA))
    return parsed.filter(F.col("criteria.rules").isNotNull()).select(
        "lender_name", "bureau_type",
        F.col("criteria.logic").alias("logic"),
        F.col("criteria.version").alias("version"),
        F.inline("criteria.rules"),
    )


def stored_criteria(lenders: DataFrame, lender: str, bureau: str) -> dict | None:
    """The newest active readable criteria of one lender and bureau; one cell comes to the driver."""
    own = (F.lower("lender_name") == lender.lower()) & (F.lower("bureau_type") == bureau.lower()) & F.col("is_active")
    rules = F.from_json("eligible_criteria", CRITERIA_SCHEMA)
    readable = lenders.filter(own).withColumn("_rules", rules).filter("_rules.rules is not null")
    newest = readable.agg(F.max_by("_rules", F.struct("created_at", "eligible_criteria")).alias("rules")).first()
    return None if newest["rules"] is None else newest["rules"].asDict(recursive=True)


def _test(rule: dict, names: dict[str, str]) -> Column | None:
    compare = OPERATORS.get(rule.get("operator", ">="))
    if compare is None:
        return None
    return compare(F.col(names[rule["field"].upper()]).cast("double"), float(rule.get("value", 0)))


def score_rule(criteria: dict) -> dict | None:
    return next((r for r in criteria.get("rules", []) if r["field"].upper() in SCORE_FIELDS), None)


def shortlist_ids(
    df: DataFrame, criteria: dict, id_col: str, *, score_col: str = "score", score_only: bool = False,
    aliases: dict[str, str] | None = None,
) -> DataFrame | None:
    """Distinct ids that pass the criteria; None when there is no usable rule.

    All rules are applied (joined by the criteria's logic word); ``score_only`` applies the score rule
    alone. ``aliases`` maps rule fields to column names.
    """
    names = {c.upper(): c for c in df.columns}
    names |= {k.upper(): v for k, v in (aliases or {}).items()}
    names |= {field: score_col for field in SCORE_FIELDS}
    if score_only:
        chosen = [r for r in [score_rule(criteria)] if r is not None]
    else:
        chosen = criteria.get("rules", [])
    tests = [_test(rule, names) for rule in chosen]
    if not tests or any(t is None for t in tests):
        return None
    join = operator.or_ if str(criteria.get("logic", "AND")).upper() == "OR" else operator.and_
    return df.filter(reduce(join, tests)).select(F.col(id_col).alias("id")).distinct()


class Source(NamedTuple):
    """A table that rules may ask: its rows, the id under which they are shortlisted, and column names by upper-case rule field."""

    rows: DataFrame
    id: Column
    names: dict[str, str]


def source(rows: DataFrame, id: Column, aliases: dict[str, str] | None = None) -> Source:
    return Source(rows, id, {c.upper(): c for c in rows.columns} | {k.upper(): v for k, v in (aliases or {}).items()})


def planned_ids(sources: list[Source], criteria: dict) -> DataFrame | None:
    """Distinct ids that pass all rules, or any, by the criteria's logic word; None when a rule has an unknown operator or there is none.

    Each rule goes to the first source that has its field. A source is read and filtered once, by all its rules together; the ids
    of several sources are then intersected or united. An unknown field is an error that names it.
    """
    tests: dict[int, list[Column]] = {}
    for rule in criteria.get("rules", []):
        field = rule["field"].upper()
        at = next((i for i, s in enumerate(sources) if field in s.names), None)
        if at is None:
            raise ValueError(f"no table holds the field {rule['field']!r}")
        test = _test(rule, sources[at].names)
        if test is None:
            return None
        tests.setdefault(at, []).append(test)
    if not tests:
        return None
    either = str(criteria.get("logic", "AND")).upper() == "OR"
    sets = [
        sources[at].rows.filter(reduce(operator.or_ if either else operator.and_, own)).select(sources[at].id.alias("id"))
        for at, own in tests.items()
    ]
    if either:
        return reduce(lambda a, b: a.unionByName(b), sets).distinct()
    return reduce(lambda a, b: a.join(b, "id", "left_semi"), sets[1:], sets[0].distinct())


def filter_by_ids(df: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """Rows of a file whose id is on the shortlist.

    The shortlist grows with the data, so it is not forced to be broadcast; the planner does so while it
    is small, and ids that fill much of a file are spread.
    """
    return equi_join(df, ids.select(F.col("id").alias(id_col)).distinct(), [id_col], "left_semi")


def shortlist_record(
    df: DataFrame, id_col: str, batch: str, lender: str, bureau: str, as_of: dt.date
) -> DataFrame:
    """Shortlisted rows in the shape of the record table; the bureau id is the lender id without its prefix."""
    return df.select(
        F.lit(as_of).alias("created_at"),
        F.expr(f"substring(`{id_col}`, 5)").alias("bureau_id"),
        F.col(id_col).alias("lender_uid"),
        F.lit(batch).alias("lender_batch"),
        F.lit(lender).alias("lender_name"),
        F.lit(bureau).alias("bureau_type"),
    )
