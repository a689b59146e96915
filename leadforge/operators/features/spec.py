"""The tradeline feature catalogue: which blocks of accounts exist, and which columns each block yields.

A *block* is a set of accounts (a product, optionally within a lender sector). A *feature* is one
output column: a block and a metric over its accounts. Columns are listed in table order.
"""

from __future__ import annotations

from dataclasses import dataclass

# Products and their account type codes (None: any known type).
SECURED_CODES = (47, 58, 168, 172, 173, 175, 184, 185, 191, 195, 246, 248, 220, 221, 241, 243)
UNSECURED_CODES = (5, 121, 123, 169, 225, 187, 189, 196, 213, 214, 245, 249)
PRODUCT_CODES = {
    "pl": (123,),
    "cd": (189,),
    "lap": (195,),
    "hl": (58,),
    "atl": (47,),
    "gld": (191,),
    "pmay": (240,),
    "edul": (130,),
    "mudl": (227,),
    "od": (121,),
    "others": (999,),
    "bl": (175, 176, 241, 228),
    "secured_acct": SECURED_CODES,
    "unsecured_acct": UNSECURED_CODES,
    "usedcar": (221,),
    "plp2p": (245,),
    "cc": (5,),
    "acct": None,
    "twl": (173,),
}
CARD_CODE = 5

# Lender sectors by member sub-type; "other" is any other non-null sub-type.
SECTORS = {
    "nbfc": ("NBF",),
    "bank": ("PVT", "FOR", "PUB"),
    "mfi": ("MFI", "SFI"),
    "sfb": ("RRB", "SFB", "COB", "COP"),
    "other": None,
}

# Look-back windows in months.
WINDOWS = (1, 2, 3, 6, 9, 12, 18, 24, 36)
BAND_WINDOWS = (3, 6, 12, 24, 36)
LATE_WINDOWS = (24, 36, 48)

# Personal-loan ticket-size bands (name, above, up to).
TICKET_CODES = (123, 245)
TICKET_BANDS = [
    ("lt5k", None, 5000),
    ("5k_10k", 5000, 10000),
    ("10k_20k", 10000, 20000),
    ("20k_50k", 20000, 50000),
    ("50k_1l", 50000, 100000),
    ("1l_2l", 100000, 200000),
    ("2l_3l", 200000, 300000),
    ("3l_4l", 300000, 400000),
    ("4l_5l", 400000, 500000),
    ("5l_7l", 500000, 700000),
    ("7l_10l", 700000, 1000000),
    ("gt10l", 1000000, None),
]

# Account type codes that mark derogatory accounts.
RESTRUCTURED_CODES = (200,)
WRITTEN_OFF_CODES = (204, 6, 2, 8, 206)
SUIT_FILED_CODES = (203, 201, 1)
SUIT_AND_WRITTEN_OFF_CODES = (205, 207)

PLAIN_PRODUCTS = [p for p in PRODUCT_CODES if p not in ("cc", "acct", "twl")]
UTILISED_PRODUCTS = ("pl", "gld", "bl")
SECTORED = {"pl": tuple(SECTORS), "cc": tuple(SECTORS), "cd": tuple(SECTORS), "acct": tuple(SECTORS),
            "gld": ("nbfc", "bank"), "bl": ("nbfc", "bank")}


@dataclass(frozen=True)
class Block:
    """A set of accounts: by type code, lender sector and ticket-size band."""

    name: str
    codes: tuple[int, ...] | None = None
    excluded: tuple[int, ...] = ()
    sector: str | None = None
    band: str | None = None
    ticketed: bool = False
    every_row: bool = False


@dataclass(frozen=True)
class Feature:
    name: str
    block: str
    metric: str


def _suffix(sector: str | None) -> str:
    return f"_{sector}" if sector else ""


def _blocks() -> dict[str, Block]:
    blocks = [Block("everything", every_row=True)]
    blocks += [Block(p, codes) for p, codes in PRODUCT_CODES.items()]
    blocks += [Block(p + _suffix(s), PRODUCT_CODES[p], sector=s) for p, sectors in SECTORED.items() for s in sectors]
    blocks += [Block(f"band_{b}", TICKET_CODES, band=b) for b, _, _ in TICKET_BANDS]
    blocks += [
        Block("ticketed", TICKET_CODES, ticketed=True),
        Block("non_card", None, excluded=(CARD_CODE,)),
        Block("restructured", RESTRUCTURED_CODES),
        Block("written_off", WRITTEN_OFF_CODES),
        Block("suit_filed", SUIT_FILED_CODES),
        Block("wrt_sf", SUIT_AND_WRITTEN_OFF_CODES),
    ]
    return {b.name: b for b in blocks}


BLOCKS = _blocks()


def _opened(product: str, block: str, windows, suffix: str = "") -> list[Feature]:
    return [Feature(f"nbr_{product}_opened_l{w}m{suffix}", block, f"opened_{w}") for w in windows]


def loan_features(product: str, sector: str | None = None) -> list[Feature]:
    end = _suffix(sector)
    block = product + end
    features = [
        Feature(f"nbr_{product}{end}", block, "count"),
        Feature(f"nbr_active_{product}{end}", block, "count_active"),
        Feature(f"max_{product}_loan_amt{end}", block, "max_loan"),
        Feature(f"max_{product}_bal{end}", block, "max_balance"),
        Feature(f"tot_{product}_loan_amt{end}", block, "sum_loan"),
        Feature(f"tot_{product}_bal{end}", block, "sum_balance"),
        Feature(f"tot_active_{product}_loan_amt{end}", block, "sum_loan_active"),
        Feature(f"tot_active_{product}_bal{end}", block, "sum_balance_active"),
        Feature(f"cb_{product}_tenure{end}", block, "tenure"),
        *_opened(product, block, WINDOWS, end),
    ]
    if product in UTILISED_PRODUCTS:
        features.append(Feature(f"max_{product}_util{end}", block, "utilisation"))
    return features


def card_features(sector: str | None = None) -> list[Feature]:
    end = _suffix(sector)
    block = "cc" + end
    total = "tot" if sector else "total"
    return [
        Feature(f"nbr_cc{end}", block, "count"),
        Feature(f"nbr_active_cc{end}", block, "count_active"),
        Feature(f"max_cc_bal{end}", block, "max_balance"),
        Feature(f"tot_cc_bal{end}", block, "sum_balance"),
        Feature(f"max_cc_util{end}", block, "card_utilisation"),
        Feature(f"max_active_cc_limit{end}", block, "max_limit_active"),
        Feature(f"{total}_active_cc_limit{end}", block, "sum_limit_active"),
        Feature(f"tot_active_cc_loan_amt{end}", block, "sum_limit_active"),
        Feature(f"max_active_cc_loan_amt{end}", block, "max_limit_active"),
        Feature(f"tot_active_cc_bal{end}", block, "sum_balance_active"),
        Feature(f"max_active_cc_bal{end}", block, "max_balance_active"),
        Feature(f"max_cc_limit{end}", block, "max_limit"),
        Feature(f"{total}_cc_limit{end}", block, "sum_limit"),
        Feature(f"max_cc_loan_amt{end}", block, "max_limit"),
        Feature(f"tot_cc_loan_amt{end}", block, "sum_limit"),
        Feature(f"cb_cc_tenure{end}", block, "tenure"),
        *_opened("cc", block, WINDOWS, end),
    ]


def derogatory_features() -> list[Feature]:
    return [
        Feature("current_max_overdue_non_cc", "non_card", "overdue_active"),
        Feature("current_max_overdue_cc", "cc", "overdue_active"),
        Feature("current_max_overdue_secured", "secured_acct", "overdue_active"),
        Feature("current_max_overdue_unsecured", "unsecured_acct", "overdue"),
        Feature("nbr_restructured_loan", "restructured", "count"),
        *_opened("restructured", "restructured", LATE_WINDOWS),
        Feature("nbr_written_off", "written_off", "count"),
        Feature("nbr_active_written_off", "written_off", "count_active"),
        Feature("ever_written_off_status", "written_off", "ever"),
        Feature("nbr_suit_filed", "suit_filed", "count"),
        Feature("nbr_active_suit_filed", "suit_filed", "count_active"),
        Feature("ever_suit_filed_status", "suit_filed", "count"),
        Feature("nbr_wrt_sf", "wrt_sf", "count"),
        *_opened("wrt_sf", "wrt_sf", LATE_WINDOWS),
        Feature("nbr_pl_ticket_size_ever", "ticketed", "count"),
    ]


def band_features() -> list[Feature]:
    return [
        feature
        for name, _, _ in TICKET_BANDS
        for feature in (
            Feature(f"nbr_pl_ts_{name}", f"band_{name}", "count"),
            *_opened(f"pl_ts_{name}", f"band_{name}", BAND_WINDOWS),
        )
    ]


def product_features() -> list[Feature]:
    """All loan products without a sector split, in table order, cards left out."""
    return [f for p in (*PLAIN_PRODUCTS, "acct", "twl") for f in loan_features(p)]


def sector_features() -> list[Feature]:
    return [f for p, sectors in SECTORED.items() if p != "cc" for s in sectors for f in loan_features(p, s)]


def all_card_features() -> list[Feature]:
    return card_features() + [f for s in SECTORED["cc"] for f in card_features(s)]


def tenure_feature() -> list[Feature]:
    return [Feature("credit_bureau_tenure", "acct", "tenure")]


def tradeline_catalogue() -> list[Feature]:
    """Every tradeline column in table order."""
    features = [f for p in PLAIN_PRODUCTS for f in loan_features(p)]
    features += card_features() + loan_features("acct")
    features += derogatory_features() + band_features()
    for product, sectors in SECTORED.items():
        for sector in sectors:
            features += card_features(sector) if product == "cc" else loan_features(product, sector)
    return features + loan_features("twl") + tenure_feature()


def utilisation_ratios() -> list[tuple[str, str, str]]:
    """(name, balance column, amount column) of each current utilisation ratio, in table order."""
    pairs = [(p, None) for p in ("pl", "gld", "bl", "cc")]
    pairs += [(p, s) for p in ("pl", "cc", "gld", "bl") for s in SECTORED[p]]
    return [
        (f"current_{p}_util{_suffix(s)}", f"tot_active_{p}_bal{_suffix(s)}", f"tot_active_{p}_loan_amt{_suffix(s)}")
        for p, s in pairs
    ]


# Enquiry purpose families.
ENQUIRY_FAMILIES = {
    "pl": (13,),
    "cd": (18,),
    "bl": (3,),
    "lap": (14,),
    "atl": (2,),
    "tw": (16,),
    "unsecured": (7, 13, 18),
}

# Delinquency windows in months, and the stand-in for a missing month.
DPD_WINDOWS = (1, 3, 6, 12, 18, 24, 36)
DPD_MISSING = -999
