"""Raw files to stores, the audit over them, exports and samples."""

from __future__ import annotations

import datetime as dt
import glob
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallywright.operators import erp, filters, governance, ingest, quality
from tallywright.plans import build_stores, export_check, full_audit, preprocess, sample_match, score_rules
from tallywright.session import settings
from tallywright.sources import catalog, quarantine, readers, sinks

HEAD = (
    "Order ID,order date (DateOrders),Customer ID, CUSTOMER NAME ,Customer Country,Product Card Id,Product Name,Category Name,"
    "Order Item Quantity,Sales,Order Item Discount,Order Profit Per Order,Order Status,Late_delivery_risk,Market"
)
LINES = [
    "1,1/31/2018 22:56,c1,Ann,France,p1,Ring,Gold,1,10.00,0,3,Complete,0,Europe",
    "1,1/31/2018 22:56,c1,Ann,France,p2,Bolt,Iron,1,20.00,0,30,Complete,0,Europe",
    "1,1/31/2018 22:56,c1,Ann,France,p1,Ring again,Gold,2,30.00,0,-5,Complete,1,Europe",
    "2,99/99/9999,c2,nan,,p1,Ring,Gold,,40.00,,,COMPLETE,,",
    "3,2/1/2018 10:00,c3,Cid,Peru,p2,Bolt,Iron,abc,50.00,0,1,Cancelled,0,LATAM",
    "4,2/1/2018 10:00,c3,Cid,Peru,p2,Bolt,Iron,3.7,60.00,0,-2000,Cancelled,0,LATAM",
    ",2/1/2018 10:00,c3,Cid,Peru,p2,Bolt,Iron,1,70.00,0,1,Cancelled,0,LATAM",
]


@pytest.fixture
def raw_file(tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("\n".join([HEAD, *LINES]) + "\n", encoding="utf-8")
    return str(path)


def test_find_column_prefers_alias_order():
    names = ("Order ID", "order_id")
    assert ingest.find_column(["order_id", " ORDER ID "], names) == " ORDER ID "
    assert ingest.find_column(["x"], names) is None


def test_tables_of_a_raw_file(spark, raw_file):
    t = build_stores.canonical_tables(readers.read_raw(spark, raw_file))
    orders = {r.order_id: r for r in t.sales_orders.collect()}
    assert set(orders) == {"1", "4"}
    assert (orders["1"].sales, orders["1"].product_name, orders["1"].late_delivery_risk) == (Decimal("30.00"), "Ring again", 1)
    assert (orders["1"].order_date, orders["1"].order_month) == (dt.date(2018, 1, 31), 1)
    assert orders["4"].order_quantity == 3
    assert t.shipping_logs.count() == 4
    assert t.shipping_logs.where("shipping_date IS NOT NULL").count() == 0
    rejects = {r.reject_reason for r in t.rejects.collect()}
    assert rejects == {"order_quantity unreadable", "order_id missing", "order_date unreadable"}
    prices = {r.product_id: (r.product_name, r.product_price) for r in t.products.collect()}
    assert prices == {"p1": ("Ring", Decimal("20.00")), "p2": ("Bolt", Decimal("40.00"))}


def test_lenient_columns_become_null(spark, raw_file):
    """On request an unreadable date only empties its cell; missing cells get their defaults."""
    lines = ingest.harmonise(readers.read_raw(spark, raw_file))
    kept = {r.order_id: r for r in ingest.build_sales_orders(ingest.accepted_lines(ingest.judged_lines(lines, lenient=("order_date",)))).collect()}
    assert set(kept) == {"1", "2", "4"}
    two = kept["2"]
    assert (two.order_date, two.customer_name, two.customer_country) == (None, None, None)
    assert (two.order_quantity, two.profit, two.late_delivery_risk) == (0, Decimal("0.00"), 0)
    good, bad = ingest.split_rejects(lines, lenient=("order_date",))
    assert (good.count(), bad.count()) == (5, 2)


def test_prices_that_do_not_read_are_rejected_and_missing_ones_not_counted(spark):
    raw = spark.createDataFrame(
        [("1", "p", "10.00", 0), ("2", "p", "abc", 1), ("3", "p", None, 2), ("4", "q", "", 3)], "OrderId string, ProductId string, price string, seq int"
    )
    judged = ingest.judged_lines(ingest.harmonise(raw))
    prices = {r.product_id: r.product_price for r in ingest.build_products(ingest.accepted_lines(judged)).collect()}
    assert prices == {"p": Decimal("10.00"), "q": None}
    assert [(r.order_id, r.product_price, r.reject_reason) for r in ingest.rejected_lines(judged).collect()] == [("2", "abc", "product_price unreadable")]


def test_split_proves_that_no_row_is_lost(spark, raw_file, tmp_path):
    parted = quarantine.split(readers.read_raw(spark, raw_file), quarantine.raw_lines())
    assert parted.counts == quarantine.Counts(7, 4, 3, 0) and parted.counts.whole
    assert (parted.accepted.count(), parted.rejected.count()) == (4, 3)
    assert {r.reject_reason: r.n_rows for r in quarantine.reasons(parted).collect()} == {"order_date unreadable": 1, "order_id missing": 1, "order_quantity unreadable": 1}
    assert ingest.rejected_lines(parted.rejected).where("order_id = '2'").collect()[0].order_date == "99/99/9999"
    with pytest.raises(quarantine.LostRows):
        quarantine.split(readers.read_raw(spark, raw_file), lambda raw: quarantine.raw_lines()(raw.where("`Sales` <> '40.00'")))
    erp_raw = spark.createDataFrame(
        [("1", "20240105", "1"), ("2", "20240305", "1"), ("3", "2024-13-45", "x"), ("", "20240105", "1"), ("5", "20240105", "1,5")], "VBELN string, AUDAT string, NETWR string"
    )
    judge = quarantine.erp_rows("sap", "sales_orders", "2024-01-01", "2024-01-31")
    parted = quarantine.split(erp_raw, judge)
    assert parted.counts == quarantine.Counts(5, 1, 3, 1)
    assert [r.order_id for r in readers.read_erp_extract(erp_raw, "sap", "sales_orders", "2024-01-01", "2024-01-31").collect()] == ["1"]
    export = spark.createDataFrame([("t", "1", "2024-01-05", "x"), ("u", "1,2", "43131", "x"), ("v", None, None, None)], "transaction_id string, amount string, date string, account_code string")
    parted = quarantine.split(export, quarantine.export_rows)
    assert parted.counts == quarantine.Counts(3, 2, 1, 0)
    row = parted.rejected.collect()[0]
    assert (row.transaction_id, row.reject_reason, row.told.amount) == ("u", "amount unreadable; date unreadable", "1,2")


def test_stored_ids_do_not_depend_on_files_or_splits(spark, tmp_path):
    """Another split size, another dealing into files and one more file keep all ids; repeated lines stay apart."""
    body = [f"{k % 40},1/31/2018 22:56,c{k % 7},Ann,France,p{k % 3},Ring,Gold,1,{k % 5}.00,0,1,Complete,0,Europe" for k in range(400)]

    def ids(folder, files, split):
        (tmp_path / folder).mkdir()
        for k, part in enumerate(files):
            (tmp_path / folder / f"{k}.csv").write_text("\n".join([HEAD, *part]) + "\n", encoding="utf-8")
        with settings(spark, {"spark.sql.files.maxPartitionBytes": split}):
            t = build_stores.canonical_tables(readers.read_raw(spark, str(tmp_path / folder)))
            return [r.log_id for r in t.shipping_logs.collect()], {r.entry_id for r in t.general_ledger.collect()}

    logs, entries = ids("one", [body], "1m")
    assert len(set(logs)) == len(logs) == 400
    again, more = ids("two", [body[200:], body[:200], ["900,1/31/2018 22:56,c1,Ann,France,p1,Ring,Gold,1,9.00,0,1,Complete,0,Europe"]], "2k")
    assert set(logs) < set(again) and len(again) == 401 and entries < more


def test_a_period_is_cut_on_both_sides(spark):
    orders = spark.createDataFrame([("a", dt.date(2024, 1, 5)), ("b", dt.date(2024, 2, 1))], "order_id string, order_date date")
    invoices = spark.createDataFrame(
        [("a", dt.date(2024, 2, 9)), ("b", dt.date(2024, 1, 9)), ("g", dt.date(2024, 1, 31)), ("h", dt.date(2023, 12, 31)), (None, dt.date(2024, 1, 1))],
        "order_id string, invoice_date date",
    )
    own, billed = full_audit.period_sides(orders, invoices, dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    assert [r.order_id for r in own.collect()] == ["a"]
    assert sorted((r.order_id for r in billed.collect()), key=str) == [None, "a", "g"]


def test_ledger_balances(spark, raw_file):
    t = build_stores.canonical_tables(readers.read_raw(spark, raw_file))
    entries = t.general_ledger.collect()
    assert len({r.entry_id for r in entries}) == len(entries)
    assert sum(r.credit_amount for r in entries) == Decimal("120.00")
    second = [r for r in entries if r.credit_amount == Decimal("20.00") or r.debit_amount == Decimal("-10.00")]
    assert len(second) == 1  # profit above sales: no cost entry
    debits = {r.debit_amount for r in entries if r.account_code == "5000"}
    assert debits == {Decimal("7.00"), Decimal("35.00"), Decimal("2060.00")}


def test_payment_status(spark):
    df = spark.createDataFrame([("Complete",), ("COMPLETE",), ("Cancelled",), ("CANCELED",), (None,)], "s string")
    strict = [r[0] for r in df.select(ingest.payment_status(F.col("s"))).collect()]
    loose = [r[0] for r in df.select(ingest.payment_status(F.col("s"), True)).collect()]
    assert strict == ["Paid", "Outstanding", "Cancelled", "Outstanding", "Outstanding"]
    assert loose == ["Paid", "Paid", "Cancelled", "Cancelled", "Outstanding"]


def test_sum_lines_option(spark, raw_file):
    t = build_stores.canonical_tables(readers.read_raw(spark, raw_file), sum_lines=True)
    row = t.sales_orders.where("order_id = '1'").collect()[0]
    assert (row.sales, row.profit, row.order_quantity, row.product_name) == (Decimal("60.00"), Decimal("28.00"), 4, "Ring again")


def test_product_names_of_other_sources(spark):
    """A source without sales prices its products by its own price column."""
    raw = spark.createDataFrame([("1", "p", "Ring", "Gold", "4.00", 0), ("2", "p", "Ring", "Gold", "6.00", 1)], "OrderId string, ProductId string, ProductName string, category string, price string, seq int")
    (row,) = ingest.build_products(ingest.typed_lines(ingest.harmonise(raw))).collect()
    assert (row.product_id, row.product_name, row.product_category, row.product_price) == ("p", "Ring", "Gold", Decimal("5.00"))


def test_missing_customer_column_falls_back(spark):
    raw = spark.createDataFrame([("7", "1.00", 0)], "OrderId string, sales string, seq int")
    good, _ = ingest.split_rejects(ingest.harmonise(raw))
    lines = ingest.typed_lines(good)
    assert ingest.build_sales_orders(lines).collect()[0].customer_id == "7"
    assert ingest.build_accounts_receivable(lines).collect()[0].customer_id is None
    with pytest.raises(ValueError):
        ingest.harmonise(raw.drop("OrderId"))


def test_stores_audit_and_rerun(stores, raw_file):
    spark = stores
    stamp = "2018-02-10 00:00:00"
    counts = {r.table_name: r.row_count for r in build_stores.build(spark, raw_file, stamp).collect()}
    again = {r.table_name: r.row_count for r in build_stores.build(spark, raw_file, stamp).collect()}
    assert counts == again
    assert counts["operations.sales_orders"] == 2 and counts["operations.rejected_lines"] == 3
    assert counts["finance.accounts_receivable"] == 2 and counts["audit.audit_logs"] == 0

    result = full_audit.run(spark, stamp)
    # Order 1 is paid, order 2 is rejected for its date, order 4 has a cancelled invoice.
    assert result.summary.collect()[0].missing_in_fin == 1
    logged = spark.table("audit.audit_logs").count()
    assert logged == result.findings.count() > 0
    full_audit.run(spark, "2018-02-11 00:00:00")
    assert spark.table("audit.audit_logs").count() == logged
    assert spark.table("audit.reconciliation_audit").count() == 2
    flags = spark.table("audit.risk_flags")
    assert flags.count() == flags.select("risk_type", "entity_id").distinct().count()

    stored = spark.table("operations.sales_orders")
    plan = filters.period(stored, 2018, 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_year" in plan
    january = full_audit.run(spark, stamp, 2018, 1)
    assert {r.order_id for r in january.compared.collect()} == {"1"}

    scores = score_rules.run(spark, dt.date(2018, 2, 10))
    assert {r.rule_type for r in scores.collect()} == {"timing_fraud", "negative_margin"}
    score_rules.run(spark, dt.date(2018, 2, 10))
    assert spark.table("audit.fraud_rule_metrics").count() == 2

    assert "sales_orders" in catalog.list_tables(spark, "operations")
    assert catalog.table_count(spark, "operations", "products").collect()[0].row_count == 2
    assert "order_id" in {r.col_name for r in catalog.table_info(spark, "operations", "sales_orders").collect()}
    joined = catalog.query(
        spark,
        "operations",
        "SELECT o.order_id FROM sales_orders o JOIN finance.accounts_receivable a USING (order_id) WHERE o.sales > :floor",
        {"floor": 35},
    )
    assert sorted(r.order_id for r in joined.collect()) == ["4"]
    many = catalog.query_many(spark, {"operations": "SELECT 1 AS x", "audit": "SELECT count(*) AS n FROM audit_logs"})
    assert many["audit"].collect()[0].n == logged
    with pytest.raises(ValueError):
        catalog.query(spark, "nowhere", "SELECT 1")
    with pytest.raises(ValueError):
        catalog.table(spark, "audit", "nothing")


EXPORT = """transaction_id,amount,date,account_code,description
TXN001,1000.00,2024-01-15,1000,Sales Revenue
TXN002,-500.00,2024-01-16,2000,Refund
TXN003,2500.00,2024-01-17,1000,Sales Revenue
TXN004,800.00,2024-01-18,,Missing Account
"""


def test_export_report(spark, tmp_path):
    path = tmp_path / "export.csv"
    path.write_text(EXPORT)
    assert readers.validate_export(spark, str(path)) == {
        "valid": True,
        "rows": 4,
        "columns": ["transaction_id", "amount", "date", "account_code", "description"],
    }
    target = export_check.run(spark, str(path), str(tmp_path / "out"), "r1", "2024-02-01T00:00:00")
    (part,) = glob.glob(f"{target}/part-*.json")
    with open(part) as handle:
        report = json.load(handle)
    assert (report["rows_processed"], report["anomalies_found"]) == (4, 2)
    assert report["anomaly_list"] == [
        {"row": 1, "type": "negative_amount", "value": -500.0},
        {"row": 3, "type": "missing_account_code", "value": None},
    ]


def test_unreadable_cells_are_reported(spark, tmp_path):
    path = tmp_path / "odd.csv"
    path.write_text('transaction_id,amount,date,account_code\nt1,"-1,250.00",2024-01-15,4000\nt2,abc,43131,\nt3,,,4000\nt4,-1,2024-13-45,4000\n')
    row = export_check.report(spark, str(path), "r", "t").collect()[0]
    assert (row.rows_processed, row.anomalies_found) == (4, 6)
    assert [(a.row, a.type) for a in row.anomaly_list] == [
        (0, "unreadable_amount"), (1, "missing_account_code"), (1, "unreadable_amount"), (1, "unreadable_date"),
        (3, "negative_amount"), (3, "unreadable_date"),
    ]
    path.write_text("transaction_id,amount,date,account_code\nt1,1,2024-01-15,4000,too much\nt2,1\n")
    assert readers.validate_export(spark, str(path)) == {"valid": False, "error": "malformed lines: 2"}


def test_export_shows_ten_but_counts_all(spark, tmp_path):
    path = tmp_path / "many.csv"
    path.write_text("transaction_id,amount,date,account_code\n" + "".join(f"t{i},-1,2024-01-01,\n" for i in range(30)))
    row = export_check.report(spark, str(path), "r", "t").collect()[0]
    assert (row.rows_processed, row.anomalies_found, len(row.anomaly_list)) == (30, 60, 10)
    assert [a.row for a in row.anomaly_list] == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4]


def test_row_numbers_over_several_splits(spark, tmp_path):
    path = tmp_path / "long.csv"
    path.write_text("transaction_id,amount,date,account_code\n" + "".join(f"{i},1,2024-01-01,x\n" for i in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        numbered = readers.with_row_number(readers.read_export(spark, str(path)))
        assert numbered.rdd.getNumPartitions() >= 1
        assert numbered.where("row <> cast(transaction_id as bigint)").count() == 0
        assert numbered.count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_export_errors(spark, tmp_path):
    assert readers.validate_export(spark, str(tmp_path / "none.csv"))["error"].startswith("unreadable, PATH_NOT_FOUND")
    path = tmp_path / "bad.csv"
    path.write_text("transaction_id,amount\n1,2\n")
    assert readers.validate_export(spark, str(path)) == {
        "valid": False,
        "error": "columns not there: account_code, date",
    }
    with pytest.raises(ValueError):
        export_check.run(spark, str(path), str(tmp_path), "r", "t")


def test_sample_match(spark, tmp_path):
    sales = ["15000.00", "8500.50", "23000.00", "12000.00", "18500.75", "9500.00", "31000.00", "14500.25"]
    ops, fin = tmp_path / "ops.csv", tmp_path / "fin.csv"
    ops.write_text(
        "order_id,date,order_status,sales,customer_name\n"
        + "".join(f"ORD00{i},2024-01-0{(i + 1) // 2},COMPLETED,{s},Customer {i}\n" for i, s in enumerate(sales, 1))
    )
    fin.write_text(
        "transaction_id,date,order_id,amount,currency,gl_account,status\n"
        + "".join(f"TXN00{i},2024-01-0{(i + 1) // 2},ORD00{i},{s},USD,4000-Sales,Posted\n" for i, s in enumerate(sales, 1))
    )
    target = sample_match.run(spark, str(ops), str(fin), str(tmp_path / "out"), "now")
    (part,) = glob.glob(f"{target}/part-*.json")
    with open(part) as handle:
        summary = json.load(handle)["summary"]
    assert summary == {"total_orders": 8, "matched": 8, "mismatched": 0, "match_rate": "100.0%"}


def test_preprocess_round_trip(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("a,b\n1,x\n1,x\n2,\n")
    raw = readers.read_raw(spark, str(path)).drop("seq")
    profile = preprocess.profile(raw)
    assert [tuple(r) for r in profile.missing.collect()] == [("b", 1, 33.33)]
    csv_path, parquet_path = preprocess.run(spark, str(path), str(tmp_path / "out"), "raw")
    assert spark.read.parquet(parquet_path).count() == 2
    assert spark.read.option("header", True).csv(csv_path).columns == ["a", "b"]


def test_append_new_and_upsert(stores, rows):
    spark = stores
    first = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    sinks.append_new(first, "audit.once", "k")
    sinks.append_new(spark.createDataFrame([("b", 9), ("c", 3), ("c", 3)], "k string, v int"), "audit.once", "k")
    assert rows(spark.table("audit.once")) == [("a", 1), ("b", 2), ("c", 3)]

    sinks.upsert(spark.createDataFrame([("a", 1, 0), ("b", 2, 0)], "k string, v int, seq int"), "operations.up", "k", "seq")
    sinks.upsert(spark.createDataFrame([("b", 7, 1), ("b", 8, 2), ("c", 3, 1)], "k string, v int, seq int"), "operations.up", "k", "seq")
    assert rows(sinks.live(spark, "operations.up")) == [("a", 1), ("b", 8), ("c", 3)]
    sinks.upsert(spark.createDataFrame([("b", 0, 1), ("a", 5, 0), (None, 1, 9)], "k string, v int, seq int"), "operations.up", "k", "seq")
    assert rows(sinks.live(spark, "operations.up")) == [("a", 1), ("b", 8), ("c", 3)]  # nothing newer
    sinks.upsert(spark.createDataFrame([("b", 0, 5)], "k string, v int, seq int"), "operations.up", "k", "seq", deleted=F.col("v") == 0)
    sinks.upsert(spark.createDataFrame([("b", 6, 4), ("c", 4, 2)], "k string, v int, seq int"), "operations.up", "k", "seq")
    assert rows(sinks.live(spark, "operations.up")) == [("a", 1), ("c", 4)]  # an older change does not bring b back


def test_upsert_moves_rows_between_partitions(stores, rows):
    spark = stores
    schema = "k string, v int, seq int, m string"
    start = spark.createDataFrame([("a", 1, 0, "jan"), ("b", 2, 0, "feb"), ("c", 3, 0, "mar")], schema)
    sinks.upsert(start, "operations.parted", "k", "seq", "m")
    sinks.upsert(spark.createDataFrame([("b", 20, 1, "jan")], schema), "operations.parted", "k", "seq", "m")
    assert rows(spark.table("operations.parted"), "k", "v", "m") == [("a", 1, "jan"), ("b", 20, "jan"), ("c", 3, "mar")]
    sinks.upsert(spark.createDataFrame([("d", 4, 0, None)], schema), "operations.parted", "k", "seq", "m")
    sinks.upsert(spark.createDataFrame([("d", 5, 1, "may"), ("a", 0, -1, "dec")], schema), "operations.parted", "k", "seq", "m")
    assert rows(spark.table("operations.parted"), "k", "v", "m") == [("a", 1, "jan"), ("b", 20, "jan"), ("c", 3, "mar"), ("d", 5, "may")]


def test_erp_mappings(spark):
    sap = spark.createDataFrame(
        [("0000000012", "20240115", "000", "123456", "C", "note"), ("7", "20240299", "0042", "x", "Z", None)],
        "VBELN string, AUDAT string, KUNNR string, NETWR string, GBSTK string, EXTRA string",
    )
    got = erp.from_erp(sap, "sap", "sales_orders", {"EXTRA": ("remark", F.upper)}, amounts_in_cents=True).collect()
    assert (got[0].order_id, got[0].order_date, got[0].customer_id) == ("12", dt.date(2024, 1, 15), "0")
    assert (got[0].sales, got[0].order_status, got[0].remark, got[0].status_unmapped) == (Decimal("1234.56"), "COMPLETE", "NOTE", False)
    assert (got[1].order_date, got[1].sales, got[1].order_status, got[1].status_unmapped) == (None, None, "Z", True)

    for columns in ("ORDER_NUMBER string, FLOW_STATUS_CODE string", "OrderNumber string, FlowStatusCode string"):
        oracle = spark.createDataFrame([("5", "CANCELLED")], columns)
        row = erp.from_erp(oracle, "oracle", "sales_orders").collect()[0]
        assert (row.order_id, row.order_status) == ("5", "CANCELED")
    with pytest.raises(ValueError):
        erp.apply_mapping(sap, "other", "sales_orders")


def test_landed_extracts(spark, tmp_path):
    path = tmp_path / "orders.json"
    path.write_text('{"OrderNumber":"1","OrderedDate":"2024-01-05"}\n{"OrderNumber":"2","OrderedDate":"2024-03-05"}\n')
    landed = readers.read_landed(spark, str(path), "json", ["OrderNumber", "OrderedDate"])
    january = readers.read_erp_extract(landed, "oracle", "sales_orders", "2024-01-01", "2024-01-31")
    assert [r.order_id for r in january.collect()] == ["1"]
    with pytest.raises(ValueError):
        readers.read_landed(spark, str(path), "json")
    with pytest.raises(ValueError):
        readers.read_landed(spark, str(path), "xls")


def test_integrity_of_the_log(spark, rows):
    log = spark.createDataFrame([("1", "a", None), ("2", "b", "x"), ("3", "c", "y")], "log_id string, action string, notes string")
    stored = governance.with_row_hash(log)
    tampered = log.withColumn("notes", F.when(F.col("log_id") == "2", "z").otherwise(F.col("notes")))
    assert rows(governance.verify_hashes(log, stored)) == []
    assert rows(governance.verify_hashes(tampered, stored), "log_id") == [("2",)]
    later = governance.with_row_hash(tampered.where("log_id <> '3'"))
    assert rows(governance.append_only_check(stored, later)) == [("2", "CHANGED"), ("3", "DELETED")]
    assert rows(governance.append_only_check(stored, stored)) == []


def test_masking_and_retention(spark, rows):
    orders = spark.createDataFrame(
        [("1", "Alice", dt.date(2020, 1, 1)), ("2", None, dt.date(2023, 1, 1)), ("3", "Bo", None)],
        "order_id string, customer_name string, order_date date",
    )
    assert rows(governance.masked_orders(orders), "order_id", "customer_name_masked") == [("1", "A***"), ("2", None), ("3", "B***")]
    kept, expired = governance.retention(orders, "sales_orders", "order_date", "2024-02-29")
    assert rows(kept, "order_id") == [("2",), ("3",)] and rows(expired, "order_id") == [("1",)]
    everything, nothing = governance.retention(orders, "audit_logs", "order_date", "2024-02-29")
    assert everything.count() == 3 and nothing.count() == 0
    assert governance.retention_cutoff("sales_orders", "2024-02-29") == dt.date(2022, 2, 28)
    governance.register_read_views(orders, orders, orders)
    assert "customer_name" not in spark.table("ro_sales_orders").columns


def test_access_queries(spark, rows):
    log = spark.createDataFrame(
        [("1", "u", "ROLE_GRANT", "t", "2024-01-02 10:00:00"), ("2", "u", "READ", "s", "2024-01-02 11:00:00"),
         ("3", "u", "READ", "s", "2023-12-01 00:00:00"), ("4", "v", "PERMISSION_CHANGE", "t", "2024-01-02 12:00:00")],
        "log_id string, auditor_id string, action string, entity_type string, at string",
    ).selectExpr("*", "cast(at as timestamp) audit_date", "'e' entity_id", "'n' notes")
    assert [r.log_id for r in governance.permission_changes(log).collect()] == ["4", "1"]
    assert rows(governance.access_anomaly(log, "2024-01-02 23:00:00", limit=1)) == [("u", 2, 2)]


def test_table_counts_needs_tables(spark):
    assert quality.table_counts({"x": spark.range(3)}).collect()[0].row_count == 3


def test_orders_with_unreadable_dates_keep_their_last_line(spark, tmp_path, rows):
    from registry import ingest as queries

    day = dt.datetime(2020, 1, 2)
    tables = {
        "orders": ([(223, 1, "F", 1.0, day, "1-URGENT"), (224, 1, "F", 1.0, day, "1-URGENT"), (227, 1, "F", 1.0, day, "1-URGENT")],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": ([(k, 5, 1, n, 2.0, 10.0 * n, 0.1, 0.0, "N", "O", day) for k in (223, 224, 227) for n in (1, 2)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        "part": ([(5, "Bolt", "b", "Iron", 1, 3.0)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "customer": ([(1, "Ann", 1, 0.0, "X")], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
    }
    for name, (lines, schema) in tables.items():
        spark.createDataFrame(lines, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    got = queries.ingest_orders_keep_last(spark, str(tmp_path))
    assert rows(got, "order_id", "order_date", "order_year", "sales") == [("223", None, None, Decimal("20.00")), ("224", dt.date(2020, 1, 2), 2020, Decimal("20.00"))]


def test_ledger_entries_are_made_by_compiled_code(spark, rows):
    lines = spark.createDataFrame([("1", dt.date(2020, 1, 2), Decimal("5.00"), Decimal("2.00"), "a"), ("2", None, Decimal("5.00"), Decimal("5.00"), "b"), (None, None, Decimal("1.00"), None, "c")],
                                  "order_id string, order_date date, sales decimal(18,2), profit decimal(18,2), line_id string")
    ledger = ingest.build_general_ledger(lines)
    assert "lambda" not in ledger._jdf.queryExecution().optimizedPlan().toString()
    five, none = Decimal("5.00"), Decimal("0.00")
    assert rows(ledger, "order_id", "account_code", "account_name", "debit_amount", "credit_amount", "description") == [
        ("1", "4000", "Sales Revenue", none, five, "Sales for Order 1"),
        ("1", "5000", "Cost of Goods Sold", Decimal("3.00"), none, "COGS for Order 1"),
        ("2", "4000", "Sales Revenue", none, five, "Sales for Order 2"),
        (None, "4000", "Sales Revenue", none, Decimal("1.00"), None),
    ]
