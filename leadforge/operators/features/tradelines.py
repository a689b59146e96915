"""Tradeline features: one pass over the accounts, two shuffles, both on pre-aggregated rows.

1. Accounts are reduced to *cells* - one row per customer, account type, sector and ticket band (as far as
   the wanted blocks tell them apart), with every basic metric. The number of cells of a customer is bounded by the code lists, and the first
   shuffle is keyed by customer and cell after a map-side combine, so one customer that holds a large
   share of all accounts is spread over many tasks and shrinks to a few hundred rows.
2. Cells are placed and sorted by customer, and tasks reduce the runs of a customer to the blocks their cells
   belong to (``reduction``), with only the metrics that are read of a block, without a further shuffle.

The full table of a batch (``with_slots``) shuffles the typed rows of its customers instead, once, and no cells: partial cells
would be wider, as most hold one account. A customer's rows then meet in one task, as a stream that the aggregate shrinks. They travel
packed (``packed_rows``): what is small is one number, and amounts take eight bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types

from leadforge.functions.dates import month_diff
from leadforge.operators.features import spec as S
from leadforge.operators.features.reduction import feature_reducer

AMOUNT = "decimal(38,2)"
DAYS = "decimal(10,2)"
OVERDUE = "decimal(18,5)"

NO_CODE, OTHER_CODE = 0, 1000
KNOWN_CODES = sorted(
    {c for b in S.BLOCKS.values() if b.codes for c in b.codes}
)
NO_SECTOR = 0
SECTOR_IDS = {name: i + 1 for i, name in enumerate(S.SECTORS)}
NO_BAND = 0
BAND_IDS = {name: i + 1 for i, (name, _, _) in enumerate(S.TICKET_BANDS)}
BLOCK_IDS = {name: i for i, name in enumerate(S.BLOCKS)}


def _cell_id(code, sector, band):
    return code * 1000 + sector * 100 + band


CODES = (NO_CODE, *KNOWN_CODES, OTHER_CODE)
SECTORS = range(len(S.SECTORS) + 1)
BANDS = range(len(S.TICKET_BANDS) + 1)


def _members(block: str) -> set[int]:
    """The cells of a block, of all possible ones: fixed by the code lists."""
    return {_cell_id(c, s, b) for c in CODES for s in SECTORS for b in BANDS if _belongs(S.BLOCKS[block], c, s, b)}


def _classes(blocks: list[str]) -> list[dict[int, int]]:
    """Codes, sectors and bands, each with the first one that the blocks do not tell from it."""
    chosen = [S.BLOCKS[b] for b in blocks]
    seen = (
        {c: tuple(_belongs(x, c, s, b) for x in chosen for s in SECTORS for b in BANDS) for c in CODES},
        {s: tuple(_belongs(x, c, s, b) for x in chosen for c in CODES for b in BANDS) for s in SECTORS},
        {b: tuple(_belongs(x, c, s, b) for x in chosen for c in CODES for s in SECTORS) for b in BANDS},
    )
    found = []
    for kind in seen:
        first: dict = {}
        found.append({value: first.setdefault(places, value) for value, places in kind.items()})
    return found


def _class_of(value: Column, classes: dict[int, int]) -> Column:
    if len(set(classes.values())) == 1:
        return F.lit(next(iter(classes.values())))
    merged = value
    for first in dict.fromkeys(classes.values()):
        others = [v for v, f in classes.items() if f == first and v != first]
        merged = F.when(value.isin(others), first).otherwise(merged) if others else merged
    return merged


def _belongs(block: S.Block, code: int, sector: int, band: int) -> bool:
    if block.every_row:
        return True
    if code == NO_CODE or code in block.excluded:
        return False
    if block.codes is not None and code not in block.codes:
        return False
    if block.sector and sector != SECTOR_IDS[block.sector]:
        return False
    if block.band and band != BAND_IDS[block.band]:
        return False
    return not (block.ticketed and band == NO_BAND)


def _sector_id(c: Column) -> Column:
    chain = F.when(c.isNull(), NO_SECTOR)
    for name, members in S.SECTORS.items():
        if members:
            chain = chain.when(c.isin(*members), SECTOR_IDS[name])
    return chain.otherwise(SECTOR_IDS["other"])


def _band_id(amount: Column) -> Column:
    chain = F.when(amount.isNull(), NO_BAND)
    for name, _, upper in S.TICKET_BANDS[:-1]:
        chain = chain.when(amount <= upper, BAND_IDS[name])
    return chain.otherwise(BAND_IDS[S.TICKET_BANDS[-1][0]])


def account_rows(ar: DataFrame, *, days_past_due: bool = False, blocks: list[str] | None = None) -> DataFrame:
    """Cast once: the typed, narrow account rows that the features need.

    A code that is no number is still a type: it counts among all accounts, and in no product. Cells that the
    given blocks (otherwise: all) do not tell apart are one cell.
    """
    code = F.col("acct_type_cd").try_cast("int")
    known = F.when(F.col("acct_type_cd").isNull(), NO_CODE).when(code.isin(KNOWN_CODES), code).otherwise(OTHER_CODE)
    typed = ar.select(
        "customer_id",
        known.alias("code"),
        _sector_id(F.col("m_sub_id")).alias("sector"),
        F.col("orig_loan_am").try_cast(AMOUNT).alias("loan"),
        F.col("balance_am").try_cast(AMOUNT).alias("balance"),
        F.col("credit_limit_am").try_cast(AMOUNT).alias("limit"),
        F.col("past_due_am").try_cast(OVERDUE).alias("past_due"),
        F.col("closed_dt").isNull().alias("active"),
        month_diff(F.col("open_dt"), F.col("created_at")).alias("months"),
        *([_dpd_months()] if days_past_due else []),
    )
    if days_past_due:
        typed = worst_days(typed)
    band = F.when(F.col("code").isin(*S.TICKET_CODES), _band_id(F.col("loan"))).otherwise(NO_BAND)
    codes, sectors, bands = _classes(list(S.BLOCKS) if blocks is None else blocks)
    cell = _cell_id(_class_of(F.col("code"), codes), _class_of(F.col("sector"), sectors), _class_of(band, bands))
    return typed.withColumn("cell", cell)


def _dpd_months() -> Column:
    """The 36 months of an account as one array, with a fixed value for months that are missing or unreadable."""
    months = F.array(*[F.col(f"days_past_due_{m:02d}") for m in range(1, 37)])
    return F.transform(months, lambda m: F.coalesce(m.try_cast(DAYS), F.lit(S.DPD_MISSING).cast(DAYS))).alias("months_past_due")


def worst_days(rows: DataFrame) -> DataFrame:
    """The months' array replaced by the worst of each window: a scan of its first items, which compiles to little code."""
    worst = [F.array_max(F.slice("months_past_due", 1, w)).alias(f"dpd_{w}") for w in S.DPD_WINDOWS]
    return rows.select(*[c for c in rows.columns if c != "months_past_due"], *worst)


# Places in the number that holds what is small of a row: cell, code, whether it is active, whether months are given, months.
CELL_BITS, CODE_BITS = 20, 10
ACTIVE_AT, DATED_AT, MONTHS_AT = CELL_BITS + CODE_BITS, CELL_BITS + CODE_BITS + 1, 32
AMOUNTS, SHORT_AMOUNT = ("loan", "balance", "limit"), "decimal(18,2)"
# A window's worst days in nine bits: whole days from 0, the last value stands for missing months. Seven windows fill a number.
DAY_BITS = 9
MISSING_DAYS = 2**DAY_BITS - 1


def _short_days(window: str) -> Column:
    days = F.col(window)
    whole = (days >= 0) & (days < MISSING_DAYS) & (days == days.cast("int"))
    return F.when(days == S.DPD_MISSING, F.lit(MISSING_DAYS).cast("bigint")).when(whole, days.cast("bigint"))


def packed_rows(rows: DataFrame) -> DataFrame:
    """Typed account rows with fewer and shorter columns, for a shuffle; ``unpacked_rows`` gives them back exactly.

    A row with an amount beyond 18 digits, or with days that nine bits do not hold, carries all of these in ``beyond`` as well:
    an array, since a struct would be taken apart before the shuffle.
    """
    windows = [c for c in rows.columns if c.startswith("dpd_")]
    flags = F.col("cell").cast("bigint")
    for value, place in (("code", CELL_BITS), ("active", ACTIVE_AT), (F.col("months").isNotNull(), DATED_AT), (F.coalesce("months", F.lit(0)), MONTHS_AT)):
        flags = flags.bitwiseOR(F.shiftleft((F.col(value) if isinstance(value, str) else value).cast("bigint"), place))
    days = [_short_days(w) for w in windows]
    together = days[:1]
    for later in days[1:]:
        together = [F.shiftleft(together[0], DAY_BITS).bitwiseOR(later)]
    short = rows.select(
        "customer_id", flags.alias("flags"), "past_due", *[F.col(a).try_cast(SHORT_AMOUNT).alias(f"short_{a}") for a in AMOUNTS],
        *[d.alias("days") for d in together], *AMOUNTS, *windows)
    fits = [F.col(a).isNull() | F.col(f"short_{a}").isNotNull() for a in AMOUNTS] + [F.col("days").isNotNull() for _ in together]
    every = fits[0]
    for further in fits[1:]:
        every = every & further
    kept = [c for c in short.columns if c not in (*AMOUNTS, *windows)]
    return short.select(*kept, F.when(~every, F.array(*[F.col(c).cast(AMOUNT) for c in (*AMOUNTS, *windows)])).alias("beyond"))


def unpacked_rows(packed: DataFrame) -> DataFrame:
    flags = F.col("flags")
    has = lambda place: flags.bitwiseAND(F.lit(2**place)) != 0
    beyond = lambda i: F.get("beyond", F.lit(i))
    windows = []
    for i, w in enumerate(S.DPD_WINDOWS if "days" in packed.columns else []):
        days = F.shiftright("days", DAY_BITS * (len(S.DPD_WINDOWS) - 1 - i)).bitwiseAND(F.lit(MISSING_DAYS))
        short = F.when(days == MISSING_DAYS, S.DPD_MISSING).otherwise(days.cast("int")).cast(DAYS)
        windows.append(F.coalesce(beyond(len(AMOUNTS) + i).cast(DAYS), short).alias(f"dpd_{w}"))
    return packed.select(
        "customer_id",
        F.shiftright(flags, CELL_BITS).bitwiseAND(F.lit(2**CODE_BITS - 1)).cast("int").alias("code"),
        *[F.coalesce(beyond(i), F.col(f"short_{a}").cast(AMOUNT)).alias(a) for i, a in enumerate(AMOUNTS)],
        "past_due",
        has(ACTIVE_AT).alias("active"),
        F.when(has(DATED_AT), F.shiftright(flags, MONTHS_AT).cast("int")).alias("months"),
        *windows,
        flags.bitwiseAND(F.lit(2**CELL_BITS - 1)).cast("int").alias("cell"),
    )


def _count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def _cell_metrics(days_past_due: bool) -> dict[str, Column]:
    loan, balance, limit = F.col("loan"), F.col("balance"), F.col("limit")
    active, months, is_card = F.col("active"), F.col("months"), F.col("code") == S.CARD_CODE
    loan_d, balance_d, limit_d = loan.cast("double"), balance.cast("double"), limit.cast("double")
    fallback = F.when(limit > 0, limit).when(loan > 0, loan).when(balance > 0, balance)
    card_limit = F.when(is_card, fallback)
    card_util = F.when(
        is_card,
        F.when(limit > 0, balance_d / limit_d * 100).when(loan > 0, balance_d / loan_d * 100).when(balance > 0, 100.0),
    )
    metrics = {
        "count": F.count(F.lit(1)),
        "count_active": _count_if(active),
        "count_lent": _count_if(loan > 0),
        "count_limited": _count_if(is_card & ((limit > 0) | (loan > 0) | (balance > 0))),
        "max_loan": F.max(loan),
        "max_balance": F.max(balance),
        "max_balance_active": F.max(F.when(active, balance)),
        "sum_loan": F.sum(loan),
        "sum_balance": F.sum(balance),
        "sum_loan_active": F.sum(F.when(active, loan)),
        "sum_balance_active": F.sum(F.when(active, balance)),
        "tenure": F.max(months),
        "utilisation": F.max(F.when(loan > 0, balance_d / loan_d * 100)),
        "card_utilisation": F.max(card_util),
        "max_limit": F.max(card_limit),
        "sum_limit": F.sum(card_limit),
        "max_limit_active": F.max(F.when(active, card_limit)),
        "sum_limit_active": F.sum(F.when(active, card_limit)),
        "overdue": F.max(F.col("past_due")),
        "overdue_active": F.max(F.when(active, F.col("past_due"))),
    }
    metrics |= {f"opened_{w}": _count_if(months <= w) for w in sorted({*S.WINDOWS, *S.LATE_WINDOWS})}
    if days_past_due:
        metrics |= {f"dpd_{w}": F.max(f"dpd_{w}") for w in S.DPD_WINDOWS}
    return metrics


def _additive(metric: str) -> bool:
    """Whether two partial values of a metric are added; of others the larger one stays."""
    return metric.startswith(("count", "sum", "opened"))


def _reads(feature: S.Feature) -> tuple[str, str]:
    """The metric of its block that a feature is, and the count that settles NULL and zero."""
    metric = feature.metric
    if metric == "utilisation":
        return metric, "count_lent"
    if metric == "card_utilisation":
        return metric, "count_limited"
    return {"ever": "count"}.get(metric, metric), "count_active" if metric.endswith("_active") else "count"


def _needed(features: list[S.Feature]) -> set[str]:
    """Metrics that the features read, with the counts that settle NULL and zero."""
    return {"count", *(metric for f in features for metric in _reads(f))}


def _blocks(features: list[S.Feature]) -> list[str]:
    return list(dict.fromkeys(["everything", *(f.block for f in features)]))


def customer_cells(
    ar: DataFrame,
    metrics: set[str],
    customers: DataFrame | None = None,
    blocks: list[str] | None = None,
    *,
    rows_of: DataFrame | None = None,
) -> DataFrame:
    """Account rows reduced to customer cells, as coarse as the blocks allow; optionally only for the given distinct customers.

    ``customers`` drops the cells of others, ``rows_of`` already their typed rows: unless these customers are few enough to be
    broadcast, that join places the packed rows by customer, and the aggregate shuffles no wide partial cells.
    """
    with_dpd = any(m.startswith("dpd_") for m in metrics)
    chosen = {k: v for k, v in _cell_metrics(with_dpd).items() if k in metrics}
    rows = account_rows(ar, days_past_due=with_dpd, blocks=blocks)
    if rows_of is not None:
        rows = unpacked_rows(packed_rows(rows).join(rows_of, "customer_id", "left_semi"))
    cells = rows.groupBy("customer_id", "cell").agg(*[v.alias(k) for k, v in chosen.items()])
    if customers is not None:
        cells = cells.join(customers, "customer_id", "left_semi")
    return cells


def _reduced(placed: DataFrame, features: list[S.Feature], key: str = "customer_id") -> DataFrame:
    """(key, slots) of cells whose rows of a customer follow each other."""
    plan = [(f.name, f.block, f.metric, _reads(f)[1]) for f in features]
    members = {b: _members(b) for b in {"everything", *(f.block for f in features)}}
    additive = {m for m in _needed(features) if _additive(m)}
    ansi = placed.sparkSession.conf.get("spark.sql.ansi.enabled") == "true"
    kinds = {f.name: placed.schema[_reads(f)[0]].dataType for f in features}
    slots = [types.StructField(n, types.LongType() if isinstance(k, types.IntegerType) else k) for n, k in kinds.items()]
    schema = types.StructType([types.StructField(key, placed.schema[key].dataType), types.StructField("slots", types.StructType(slots))])
    return placed.mapInArrow(feature_reducer(plan, members, additive, ansi, key), schema)


def customer_slots(cells: DataFrame, features: list[S.Feature]) -> DataFrame:
    """Cells reduced to the features, as fields of one struct per customer."""
    return _reduced(cells.repartition("customer_id").sortWithinPartitions("customer_id"), features)


def with_slots(base: DataFrame, ar: DataFrame, features: list[S.Feature], customers: DataFrame) -> DataFrame:
    """``base``, a row per customer, left-joined with the ``slots`` of its customers' accounts; ``customers`` has its distinct ids.

    Joined while the accounts are still cells, which are reduced where the join left them: a frame that comes out of ``feature_slots``
    would be shuffled and sorted by customer again, as wide as it is.
    """
    cells = customer_cells(ar, _needed(features), blocks=_blocks(features), rows_of=customers)
    metrics = [c for c in cells.columns if c != "customer_id"]
    joined = base.select("customer_id", F.struct(*base.columns).alias("carried")).join(cells, "customer_id", "left")
    placed = joined.select("customer_id", *metrics, "carried").sortWithinPartitions("customer_id")
    return _reduced(placed, features, "carried").select("carried.*", "slots")


def dpd_catalogue() -> list[S.Feature]:
    return [S.Feature(f"max_dpd_l{w}m_all", "everything", f"dpd_{w}") for w in S.DPD_WINDOWS] + [
        S.Feature(f"max_dpd_l{w}m_secured_acct", "secured_acct", f"dpd_{w}") for w in S.DPD_WINDOWS
    ]


def feature_slots(ar: DataFrame, features: list[S.Feature], customers: DataFrame | None = None) -> DataFrame:
    """(customer_id, slots): one field per feature, so that joins carry one column."""
    return customer_slots(customer_cells(ar, _needed(features), customers, _blocks(features)), features)


def slot_columns(features: list[S.Feature]) -> list[str]:
    """Select-list texts that turn ``slots`` into the feature columns; all are NULL where a left join found no accounts."""
    return [f"slots.{f.name} as {f.name}" for f in features]


def block_features(ar: DataFrame, features: list[S.Feature], customers: DataFrame | None = None) -> DataFrame:
    """Any selection of tradeline and delinquency columns, one row per customer."""
    return feature_slots(ar, features, customers).selectExpr("customer_id", *slot_columns(features))


def tradeline_features(ar: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """All tradeline columns."""
    return block_features(ar, S.tradeline_catalogue(), customers)


def ratio(balance: str, amount: str) -> str:
    """Balance as a percentage of the amount, 0 without an amount (SQL text)."""
    return f"if({amount} > 0, cast({balance} as double) / cast({amount} as double) * 100, 0.0D)"


def ratio_columns(names: set[str] | None = None) -> list[str]:
    return [f"{ratio(b, a)} as {name}" for name, b, a in S.utilisation_ratios() if names is None or name in names]


def current_utilisation(ar: DataFrame) -> DataFrame:
    """Only the utilisation ratios, reading only the blocks they need."""
    inputs = {c for _, b, a in S.utilisation_ratios() for c in (b, a)}
    features = block_features(ar, [f for f in S.tradeline_catalogue() if f.name in inputs])
    return features.selectExpr("customer_id", *ratio_columns())
