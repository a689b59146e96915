"""Feature catalogue, zero rules of conditional aggregates, risk ladder."""

import datetime as dt
import random
import re
from decimal import Decimal, localcontext

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from leadforge.catalog.features import QUERIES, features_sql
from leadforge.catalog.shape import comparable
from leadforge.catalog.views import DPD_TEMPLATE, Views
from leadforge.operators.features import reduction
from leadforge.operators.features import risk as R
from leadforge.operators.features import spec as S
from leadforge.operators.features import tradelines as T


def test_catalogue_size_and_order():
    names = [f.name for f in S.tradeline_catalogue()]
    assert len(names) == len(set(names)) == 920
    assert names[0] == "nbr_pl" and names[18] == "max_pl_util" and names[-1] == "credit_bureau_tenure"
    position = {n: i for i, n in enumerate(names)}
    landmarks = ["nbr_plp2p", "nbr_cc", "nbr_acct", "current_max_overdue_non_cc", "nbr_pl_ts_lt5k", "nbr_pl_nbfc",
                 "nbr_cc_nbfc", "nbr_cd_nbfc", "nbr_acct_nbfc", "nbr_gld_nbfc", "nbr_bl_nbfc", "nbr_twl"]
    assert [position[n] for n in landmarks] == sorted(position[n] for n in landmarks)
    assert len(S.utilisation_ratios()) == 18
    assert len(T.dpd_catalogue()) == 14


ACCOUNT_SCHEMA = """customer_id string, acct_type_cd string, m_sub_id string, orig_loan_am string, balance_am string,
 credit_limit_am string, past_due_am decimal(10,2), open_dt date, closed_dt date, created_at date"""


def _accounts(seed: int, customers: int = 60):
    """Small customers with missing, unreadable and negative values, so that every zero rule is met."""
    rng = random.Random(seed)
    amounts = [None, "n/a", "-50.25", "0", "4999.99", "5000", "5000.01", "120000", "1000000", "1000000.01", "7"]
    rows = []
    for c in range(customers):
        for _ in range(rng.choice([1, 1, 2, 5])):
            opened = rng.choice([None, dt.date(2001, 12, 31), dt.date(2002, 2, 1), dt.date(2000, 1, 31), dt.date(1998, 6, 15)])
            rows.append((
                f"C{c}", rng.choice([None, "x", "5", "5", "123", "123", "245", "191", "175", "58", "06", "1", "200", "205", "777"]),
                rng.choice([None, "NBF", "PUB", "SFI", "COP", "HFC"]), rng.choice(amounts), rng.choice(amounts), rng.choice(amounts),
                rng.choice([None, 0, 10, -3]), opened, rng.choice([None, None, dt.date(2001, 5, 5)]), dt.date(2002, 1, 1),
            ))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_blocks_equal_plain_conditional_aggregates(spark, tmp_path, seed):
    path = str(tmp_path / "accounts")
    frame = spark.createDataFrame(
        [tuple(Decimal(v) if i == 6 and v is not None else v for i, v in enumerate(r)) for r in _accounts(seed)],
        ACCOUNT_SCHEMA,
    )
    frame.write.parquet(path)
    features = S.tradeline_catalogue()
    con = duckdb.connect()
    con.execute(f"create view tradelines as select * from '{path}/*.parquet'")
    relation = con.execute(features_sql(features))
    names = [d[0] for d in relation.description]
    expected = {r[0]: r for r in relation.fetchall()}
    actual = comparable(T.tradeline_features(spark.read.parquet(path))).select(*names).collect()
    assert len(actual) == len(expected)
    for row in actual:
        twin = expected[row["customer_id"]]
        wrong = [(n, a, b) for n, a, b in zip(names, row, twin) if a != b]
        assert not wrong, wrong[:5]


def test_hot_customer_shrinks_before_the_customer_shuffle(spark):
    """A customer with most of the accounts is reduced to a bounded number of cells."""
    rows = [("hot" if i % 3 else f"c{i}", "123", "NBF", "1000", "10", None, None, dt.date(2001, 1, 1), None, dt.date(2002, 1, 1)) for i in range(3000)]
    frame = spark.createDataFrame(rows, ACCOUNT_SCHEMA)
    cells = T.customer_cells(frame, {"count", "count_active", "sum_loan"})
    assert cells.filter("customer_id = 'hot'").count() == 1
    features = T.block_features(frame, S.loan_features("pl"))
    assert features.filter("customer_id = 'hot'").first()["nbr_pl"] == 2000


def test_customers_without_accounts_have_null_features(spark):
    base = spark.createDataFrame([("nobody", 800.0)], "customer_id string, score double")
    row = (("someone", "123", "NBF", "1000", "10", None, None, dt.date(2001, 1, 1), None, dt.date(2002, 1, 1)))
    accounts = spark.createDataFrame([row], ACCOUNT_SCHEMA)
    months = {f"days_past_due_{n:02d}": F.lit(None).cast("int") for n in range(1, 37)}
    result = R.categorised(base, accounts.withColumns(months)).first()
    assert result["customer_category"] == "CAT-D2"


GOOD = dict(
    score=800, credit_bureau_tenure=60, nbr_active_cc=0, max_cc_loan_amt=0, nbr_cc=0, current_cc_util=0.0, max_hl_loan_amt=0,
    cb_hl_tenure=0, max_pl_loan_amt=0, nbr_pl=0, current_pl_util=0.0, max_dpd_l36m_all=0, max_dpd_l24m_all=0, max_dpd_l12m_all=0,
    nbr_pl_opened_l3m=0, nbr_pl_opened_l6m=0, nbr_pl_opened_l12m=0,
)
CARD = dict(nbr_active_cc=1, nbr_cc=1, max_cc_loan_amt=100000)
LADDER = {
    "CAT-A1": CARD,
    "CAT-A2": dict(max_hl_loan_amt=4000000, cb_hl_tenure=12),
    "CAT-A3": dict(CARD, score=745),
    "CAT-A4": dict(score=745, max_hl_loan_amt=3000000, cb_hl_tenure=12),
    "CAT-B1": dict(max_pl_loan_amt=250000, nbr_pl=1),
    "CAT-B2": dict(score=745, max_pl_loan_amt=200000, nbr_pl=1),
    "CAT-B3": dict(CARD, score=725),
    "CAT-C1": dict(score=725, max_pl_loan_amt=150000, nbr_pl=1),
    "CAT-C2": dict(score=725, max_hl_loan_amt=2000000, cb_hl_tenure=6),
    "CAT-C3": dict(CARD, score=705),
    "CAT-C4": dict(score=705, max_pl_loan_amt=75000, nbr_pl=1),
    "CAT-C5": dict(CARD, score=705, nbr_pl_opened_l3m=1, nbr_pl_opened_l6m=1, nbr_pl_opened_l12m=1),
    "CAT-D1": dict(score=705, max_pl_loan_amt=75000, nbr_pl_opened_l3m=1, nbr_pl_opened_l6m=1, nbr_pl_opened_l12m=1),
    "CAT-D2": dict(score=11),
    "NO-HIT": dict(score=None),
}


def test_every_category_is_reached(spark):
    kinds = ", ".join(f"{k} {'double' if k.endswith('util') else 'int'}" for k in GOOD)
    rows = [(name, *{**GOOD, **change}.values()) for name, change in LADDER.items()]
    frame = spark.createDataFrame(rows, f"expected string, {kinds}")
    for row in frame.select("expected", R.customer_category().alias("got")).collect():
        assert row["got"] == row["expected"]


def test_missing_delinquency_passes_the_ladder(spark):
    """The stand-in for missing months is below every limit, as in the stored table."""
    change = dict(CARD, max_dpd_l36m_all=S.DPD_MISSING, max_dpd_l24m_all=S.DPD_MISSING, max_dpd_l12m_all=S.DPD_MISSING)
    kinds = ", ".join(f"{k} {'double' if k.endswith('util') else 'int'}" for k in GOOD)
    frame = spark.createDataFrame([tuple({**GOOD, **change}.values())], kinds)
    assert frame.select(R.customer_category().alias("got")).first()["got"] == "CAT-A1"


def _largest_method(frame):
    """Bytes of the largest generated method; the JIT compiles up to 8,000."""
    stages = frame._jdf.queryExecution().debug().codegenToSeq()
    return max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size()))


def test_delinquency_compiles_to_small_methods(spark, folder):
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.codegen.hugeMethodLimit")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
        accounts = Views(spark, folder).tradelines_dpd
        for frame in (accounts, R.dpd_features(accounts), T.account_rows(accounts, days_past_due=True)):
            assert _largest_method(frame) <= 8000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_months_of_delinquency_equal_their_plain_cases(spark, monkeypatch):
    """Also where keys are negative or missing."""
    rows = spark.sql("""select a.id - 20 k1, b.id - 15 k2, c.id - 2 dpd_class from range(40) a, range(30) b, range(5) c
        union all select * from values (null, 1L, 1L), (5L, null, 0L), (5L, null, 1L), (7L, 3L, null), (null, null, null)""")
    monkeypatch.setattr(Views, "tradelines", rows, raising=False)
    plain = rows.selectExpr("*", *[f"{DPD_TEMPLATE.format(n=n)} as days_past_due_{n:02d}" for n in range(1, 37)])
    got = Views(spark, "").tradelines_dpd
    assert got.schema.simpleString() == plain.schema.simpleString()
    assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()


def test_cells_are_reduced_without_a_row_per_block(spark):
    """The step after the cells joins and aggregates nothing: no cell becomes a row for each block it is in."""
    accounts = spark.createDataFrame([tuple(Decimal(v) if i == 6 and v is not None else v for i, v in enumerate(r)) for r in _accounts(4)], ACCOUNT_SCHEMA)
    plan = T.tradeline_features(accounts)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "Join" not in plan


def test_amounts_beyond_64_bits_stay_exact(spark):
    amounts = ["99999999999999999999999999999999.99", "99999999999999999999999999999999.98", "-92233720368547758.08", "n/a", "0.01"]
    rows = [(c, code, "NBF", a, a, None, None, dt.date(2001, 1, 1), None, dt.date(2002, 1, 1))
            for c, n in (("big", 5), ("small", 0), (None, 3)) for code in ("123", "58") for a in (amounts[-n:] if n else ["7", "8.5"])]
    frame = spark.createDataFrame(rows, ACCOUNT_SCHEMA)
    got = {r.customer_id: r for r in T.block_features(frame, S.loan_features("pl") + S.loan_features("acct")).collect()}
    assert set(got) == {"big", "small", None}
    with localcontext(prec=60):
        for c, row in got.items():
            values = [Decimal(r[3]) for r in rows if r[0] == c and r[1] == "123" and r[3] != "n/a"]
            assert row.tot_pl_loan_amt == sum(values) and row.tot_acct_bal == 2 * sum(values)
            assert row.max_pl_loan_amt == max(values) and row.nbr_active_pl * 2 == row.nbr_acct


@pytest.mark.parametrize("size", [1, 2, 3, 100])
def test_chunks_cut_no_customer_in_two(monkeypatch, size):
    monkeypatch.setattr(reduction, "CHUNK_ROWS", size)
    ids, cells = [None, None, "a", "b", "b", "b", "b", "b", "c"], [1, 2, 2, 1, 2, 1, 2, 1, 2]
    batch = pa.record_batch({"customer_id": pa.array(ids), "cell": pa.array(cells, pa.int32()), "count": pa.array([1] * 9)})
    run = reduction.feature_reducer([("n", "two", "count", "count")], {"everything": {1, 2}, "two": {2}}, {"count"}, True)
    found = pa.Table.from_batches(run(batch.slice(i, 2) for i in range(0, 9, 2))).to_pylist()
    assert [(r["customer_id"], r["slots"]["n"]) for r in found] == [(None, 1), ("a", 1), ("b", 2), ("c", 1)]


def test_cells_are_only_as_fine_as_the_wanted_blocks(spark):
    """Few columns keep few partial rows per customer, with the same values as from all cells."""
    accounts = spark.createDataFrame([tuple(Decimal(v) if i == 6 and v is not None else v for i, v in enumerate(r)) for r in _accounts(5)], ACCOUNT_SCHEMA)
    fine = T.customer_cells(accounts, {"count"})
    for features, most in ((S.loan_features("acct"), 2), (S.loan_features("pl") + S.loan_features("pl", "other"), 4), (S.band_features(), 13)):
        blocks = ["everything", *{f.block for f in features}]
        assert T.customer_cells(accounts, {"count"}, blocks=blocks).select("cell").distinct().count() <= most < fine.select("cell").distinct().count()
        coarse = T.block_features(accounts, features)
        plain = T.tradeline_features(accounts).select(coarse.columns)
        assert coarse.exceptAll(plain).isEmpty() and plain.exceptAll(coarse).isEmpty()


def test_the_wide_table_is_neither_shuffled_nor_joined(spark, folder):
    """Accounts are joined to the customers as narrow rows and as cells; what 900 columns come from only passes through."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        v = Views(spark, folder)
        pii = v.scores.selectExpr("customer_id", "score_v3 as score", "cast(null as date) as dob", "batch_no", "created_at")
        table = R.add_tli(pii, v.bureau_sent, v.tradelines_dpd, v.enquiries, "batch_1", dt.date(2002, 1, 1))
        wide, narrow = table._jdf.queryExecution().executedPlan().toString().split("MapInArrow")
        assert not any(step in wide for step in ("Exchange", "Sort", "Join")), wide
        cells = re.split(r"HashAggregate\(keys=\[customer_id#\d+, cell#\d+\]", narrow)[-1]
        assert cells.index("LeftSemi") < cells.index("Exchange") < cells.index("array_max(")  # placed once, with windows for months
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("limit", ["-1", "10485760"])
def test_customers_keep_their_columns_beside_the_slots(spark, limit):
    """Whatever their names, also customers without accounts; accounts of others and without a customer are left out."""
    accounts = spark.createDataFrame([tuple(Decimal(v) if i == 6 and v is not None else v for i, v in enumerate(r)) for r in _accounts(6)], ACCOUNT_SCHEMA)
    accounts = accounts.withColumn("customer_id", F.when(F.col("customer_id") != "C7", F.col("customer_id")))
    base = spark.createDataFrame(
        [(i, f"C{i}", dt.date(2000, 1, 1 + i), Decimal(i)) for i in range(0, 20)] + [(99, "nobody", None, None)],
        "count long, customer_id string, cell date, tenure decimal(10,2)")
    features = S.loan_features("pl") + S.loan_features("acct")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        got = T.with_slots(base, accounts, features, base.select("customer_id"))
        plain = base.join(T.feature_slots(accounts, features), "customer_id", "left").select(*base.columns, "slots")
        assert got.columns == plain.columns and got.count() == 21
        assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()
        assert {r["customer_id"] for r in got.filter("slots is null").collect()} == {"C7", "nobody"}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_feature_joins_has_the_account_table(spark, tmp_path):
    """Accounts, their ratios, enquiries and delinquency beside each customer of the batch, NULL where there are none."""
    tables = {
        "customer": ([(1, "one"), (2, "two"), (3, "three")], "c_custkey long, c_name string"),
        "orders": ([(8, 1, dt.datetime(2001, 11, 5), 50.0), (16, 2, dt.datetime(2000, 1, 5), 70.0)],
                   "o_orderkey long, o_custkey long, o_orderdate timestamp, o_totalprice double"),
        "lineitem": ([(8, n, 24, 1, 100.0, 30.0, flag, dt.datetime(2001, 12, 1)) for n, flag in ((1, "A"), (2, "N"), (3, "R"))],
                     "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_quantity double, "
                     "l_returnflag string, l_shipdate timestamp"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    got = {r["customer_id"]: r.asDict() for r in QUERIES["feature_joins"](spark, str(tmp_path)).collect()}
    assert set(got) == {"C1", "C2", "C3"}
    accounts = {f.name for f in S.tradeline_catalogue()} | {name for name, _, _ in S.utilisation_ratios()}
    assert len(accounts) == 938 and accounts < set(got["C1"])
    one = got["C1"]
    assert (one["nbr_pl"], one["nbr_active_pl"], one["max_pl_loan_amt"], one["tot_active_pl_bal"]) == (3, 2, 1000.0, 300.0)
    assert one["current_pl_util"] == 15.0 and one["current_cc_util"] == 0.0
    assert one["nbr_pl_enquiry_l2m"] == 1 and one["max_dpd_l36m_all"] is not None
    for c, enquiries in (("C2", 1), ("C3", None)):
        assert {got[c][a] for a in accounts} == {None} and got[c]["max_dpd_l36m_all"] is None
        assert got[c]["nbr_pl_enquiry_ever"] == enquiries and got[c]["score"] is not None


def test_packed_account_rows_are_given_back_exactly(spark):
    """Whatever their values: amounts of over 18 digits, days that are broken, negative or many, months that are missing or negative."""
    amounts = [None, "0", "-50.25", "9999999999999999.99", "10000000000000000.00", "-10000000000000000.01", "999999999999999999999999999999999999.99"]
    days = ["-999", "0", "5", "510", "511", "512", "-1", "0.50", "-999.01", "99999999.99"]
    rng, kinds = random.Random(7), "decimal(38,2)"
    rows = [
        (rng.choice([None, "C1", "C2"]), rng.choice([0, 123, 999, 1000]), *[a and Decimal(a) for a in rng.choices(amounts, k=3)],
         rng.choice([None, Decimal("0.00001"), Decimal("-9999999999999.99999")]), rng.random() < 0.5, rng.choice([None, 0, 7, -3, 120000, -(2**31), 2**31 - 1]),
         *[Decimal(d) for d in (rng.choices(days, k=7) if rng.random() < 0.5 else rng.choices(days[:4], k=7))], rng.choice([0, 123101, 1000512]))
        for _ in range(800)
    ]
    windows = ", ".join(f"dpd_{w} {T.DAYS}" for w in S.DPD_WINDOWS)
    frame = spark.createDataFrame(
        rows, f"customer_id string, code int, loan {kinds}, balance {kinds}, limit {kinds}, past_due {T.OVERDUE}, active boolean, months int, {windows}, cell int")
    for given in (frame, frame.select(*[c for c in frame.columns if not c.startswith("dpd_")])):
        packed = T.packed_rows(given)
        assert 0 < packed.filter("beyond is null").count() < len(rows)
        got = T.unpacked_rows(packed)
        assert got.schema.simpleString() == given.schema.simpleString()
        assert got.exceptAll(given).isEmpty() and given.exceptAll(got).isEmpty()


def test_accounts_are_shuffled_packed(spark, folder):
    """Eight columns go to the customers, whatever is read of them; amounts of 38 digits only in the array that few rows have."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        v = Views(spark, folder)
        customers = v.scores.select("customer_id").distinct()
        cells = T.customer_cells(v.tradelines_dpd, {"count", "sum_loan", "max_limit", "dpd_36", "tenure", "overdue"}, rows_of=customers)
        plan = cells._jdf.queryExecution().executedPlan().toString().split("LeftSemi")[1]
        (carried,) = re.findall(r"Exchange hashpartitioning\(customer_id#\d+, \d+\).*\n[ :|]*\+- Project \[(.*) AS beyond#\d+\]", plan)
        assert [c.split("#")[0] for c in carried.split(", CASE")[0].split(", ")] == [
            "customer_id", "flags", "past_due", "short_loan", "short_balance", "short_limit", "days"], plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_the_stored_master_is_neither_checkpointed_nor_gathered(spark, tmp_path, monkeypatch):
    from leadforge.plans import stored as ST

    master = spark.range(0, 60, 1, 4).selectExpr("cast(id as string) customer_id", "cast(id as decimal(10,2)) score")
    monkeypatch.setattr(ST, "pii_master", lambda *given: master)
    monkeypatch.setattr(ST, "durable", lambda rows: pytest.fail("checkpointed"))
    tables = dict.fromkeys(("scores", "ids", "name_dob", "phones", "addresses"))
    for _ in range(2):
        stored = ST.store_pii_master(spark, tables, None, "b", dt.date(2002, 1, 1), str(tmp_path / "t"))
    assert stored.count() == 60 and len(list((tmp_path / "t" / "batch_no=b").glob("*.parquet"))) == 4
