from datetime import datetime

import pytest
from pyspark.sql import functions as F

from bazaarline.operators import gold, onboard, quality as q
from bazaarline.operators.profile import duplicate_row_count, infer_types, profile
from bazaarline.operators.scorecard import scorecard
from bazaarline.operators.templates import TEMPLATES
from bazaarline.sources.html import extract_links, extract_listings
from conftest import rows


def test_inventory_figures(spark):
    inv = spark.createDataFrame([(1, 101, 50, 20), (2, 102, 10, 15), (3, 103, 7, 1), (4, 104, 0, 5)],
                                "store_id int, product_id int, stock_level int, reorder_point int")
    pos = spark.createDataFrame(
        [(1, 1, 101, 10, datetime(2024, 1, 1, 10)), (2, 2, 102, 5, datetime(2024, 1, 1, 11)),
         (3, 2, 102, 5, datetime(2024, 1, 3, 12)), (4, 4, 104, 2, datetime(2024, 1, 2))],
        "transaction_id int, store_id int, product_id int, quantity int, timestamp timestamp_ntz")
    got = rows(gold.inventory_metrics(inv, pos), "store_id", "stock_turnover", "inventory_velocity",
               "days_inventory_outstanding", "low_stock_alert")
    assert got == [(1, 0.2, 5.0, 10.0, False), (2, 1.0, 5.0, 2.0, True), (3, 0.0, 0.0, 999.0, False),
                   (4, 0.0, 1.0, 0.0, True)]


def test_customer_figures(spark):
    erp = spark.createDataFrame([(1, 101, 2, 10.0), (2, 101, 1, 10.0), (3, 102, 5, 20.0), (4, None, 1, 1.0)],
                                "order_id int, customer_id int, quantity int, unit_price double")
    crm = spark.createDataFrame([(101, "Alice"), (102, "Bob"), (103, None)], "customer_id int, customer_name string")
    assert rows(gold.customer_metrics(erp, crm)) == [
        (101, "Alice", 30.0, 2, 15.0), (102, "Bob", 100.0, 1, 100.0), (103, "0", 0.0, 0, 0.0)]


def test_daily_sales(spark):
    pos = spark.createDataFrame([(1, datetime(2024, 1, 1), 100.0), (2, datetime(2024, 1, 1), 50.0), (3, datetime(2024, 1, 2), 200.0)],
                                "transaction_id int, timestamp timestamp_ntz, sale_amount double")
    got = [tuple(r)[1:] for r in gold.sales_metrics(pos).orderBy("date").collect()]
    assert got[0] == (150.0, 2, 0.0) and got[1][:2] == (200.0, 1)
    assert got[1][2] == pytest.approx(100 / 3)


def check(df, *rules):
    return [(r.passed, r.details) for r in q.run_suite(df, "d", list(rules)).collect()]


def test_expectations(spark):
    df = spark.createDataFrame([(1, -50.0), (1, 200.0), (None, 5000.0)], "id int, value double")
    assert check(df, q.NotNull("id"), q.Unique(("id",)), q.Between("value", 0, 1000), q.NullPct("id", 0.05),
                 q.DupPct(("id",), 0.4), q.HasColumns(("id", "x")), q.HasColumn("id")) == [
        (False, "Found 1 nulls"), (False, "Found 1 duplicates"), (False, "Found 2 out of range values"),
        (False, "Actual null percent: 33.33% (1 nulls)"), (True, "Actual duplicate percent: 33.33% (1 duplicates)"),
        (False, "Missing columns: ['x']"), (True, "")]


def test_rule_on_absent_column_fails_softly(spark):
    df = spark.createDataFrame([(1,)], "id int")
    assert check(df, q.NotNull("gone"), q.NotNull("id")) == [(False, "Column missing: ['gone']"), (True, "Found 0 nulls")]


def test_empty_dataset(spark):
    df = spark.createDataFrame([], "id int")
    assert check(df, q.NullPct("id", 0.05), q.Unique(("id",))) == [
        (True, "Actual null percent: 0.00% (0 nulls)"), (True, "Found 0 duplicates")]


def test_missing_keys_count_as_duplicates(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "id int")
    assert check(df, q.Unique(("id",))) == [(False, "Found 1 duplicates")]


def test_gate(spark):
    df = spark.createDataFrame([(None,)], "id int")
    q.gate(q.run_suite(df, "d", [q.HasColumn("id")]))
    with pytest.raises(q.QualityError, match="id not null"):
        q.gate(q.run_suite(df, "d", [q.NotNull("id")]))


def scored(df, kind, mapping):
    r = scorecard(df, kind, mapping).first()
    return (r.completeness, r.validity, r.uniqueness, r.consistency, r.quality_score, r.overall_score,
            [(d.category, d.points) for d in r.deductions])


def test_scorecard(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, "-5", "2024-01-01", "n", "9.5"), (1, 2, 1, "x", "soon", None, "1"), (None, 3, 1, "2", None, "s", "2"), (4, 3, 1, "2", None, "s", "2")],
        "order_id int, customer_id int, product_id int, quantity string, order_date string, region string, unit_price string")
    fields = {f: f for f in TEMPLATES["ERP"]}
    # nulls 1 + 2 + 1 of 28 cells; bad 1 date + 1 number of 5 * 4; one doubled id; one negative
    got = scored(df, "ERP", fields)
    assert got[:4] == (85, 90, 75, 75) and got[4] == 100.0 - 15 - 6 - 12 - 13 - 10
    assert got[6] == [("Completeness", 15), ("Completeness", 3), ("Completeness", 3), ("Uniqueness", 12),
                      ("Validity", 5), ("Validity", 8), ("Consistency", 10)]
    assert got[5] == pytest.approx(85 * .3 + 90 * .3 + 75 * .2 + 75 * .2, abs=0.051)
    assert scored(df, "Nothing", fields)[:5] == (100, 100, 100, 100, 100.0)
    assert scored(df, "ERP", {})[:5] == (100, 100, 100, 100, 100.0)


def test_profile(spark):
    df = spark.createDataFrame(
        [(0, 1, "2024-01-01", "a", True), (1, 2, "2024-01-02", None, False), (1, 2, "2024-01-02", None, False)],
        "n int, v int, d string, c string, f boolean")
    r = profile(df).first()
    assert (r.rows, r.columns, r.null_rate, r.dup_rate) == (3, 5, 13.33, 33.33)
    assert (r.numeric_fields, r.date_fields, r.categorical_fields) == (["n", "v", "f"], ["d"], ["c"])
    assert r.schema_definition == '{"n":"int","v":"int","d":"string","c":"string","f":"boolean"}'


def test_duplicate_rows_are_exact(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", None), ("b", "c")], "x string, y string")
    assert duplicate_row_count(df).first()[0] == 1


def test_infer_types(spark):
    df = spark.createDataFrame([("1", "1.5", "True", "x", None, "1"), ("2", "2", "False", "1", None, None)],
                               "a string, b string, c string, d string, e string, f string")
    assert [t for _, t in infer_types(df).dtypes] == ["bigint", "double", "boolean", "string", "double", "double"]


def headers(spark, *items):
    return spark.createDataFrame([(d, f, c) for d, f, cols in items for c in cols], "dataset string, filename string, column string")


def test_classify(spark):
    got = {r.dataset: r for r in onboard.classify(headers(
        spark, ("a", "customers.csv", list(TEMPLATES["CRM"])), ("b", "export.csv", list(TEMPLATES["ERP"])),
        ("c", "x.csv", ["foo"]), ("d", "Orders.csv", [" QTY", "sku", "price", "region", "order_date", "cust_id"]))).collect()}
    assert (got["a"].detected_type, got["a"].confidence_score, got["a"].status) == ("CRM", 100, "Auto-Classified")
    assert (got["b"].detected_type, got["b"].confidence_score, got["b"].status) == ("Unknown", 65, "Needs Review")
    assert (got["c"].detected_type, got["c"].confidence_score, got["c"].alternatives) == ("Unknown", 0, [])
    assert got["c"].matched_signals == ["⚠ Columns do not match any known templates"]
    assert (got["d"].detected_type, got["d"].confidence_score) == ("ERP", int((6 / 7 * 0.65 + 0.35) * 100))
    assert "⚠ Missing: order_id" in got["d"].matched_signals and got["d"].matched_signals[-1] == "✓ Filename matched patterns"
    legacy = dict(rows(onboard.classify_legacy(headers(spark, ("b", "export.csv", list(TEMPLATES["ERP"])), ("c", "x.csv", ["foo"]))),
                       "dataset", "detected_type"))
    assert legacy == {"b": "ERP", "c": "Unknown"}


def brute_mapping(cols, kind):
    import difflib
    out, low = {}, [c.lower().strip() for c in cols]
    for field, (_, syns) in TEMPLATES[kind].items():
        pick = next((c for c in cols if c.lower().strip() == field), None)
        if pick is None:
            pick = next((cols[low.index(s)] for s in syns if s in low), None)
        if pick is None:
            close = difflib.get_close_matches(field, cols, n=1, cutoff=0.6)
            for s in syns:
                close = close or difflib.get_close_matches(s, cols, n=1, cutoff=0.7)
            pick = close[0] if close else None
        out[field] = pick
    return out


@pytest.mark.parametrize("kind", list(TEMPLATES))
def test_mapping_against_the_standard_library(spark, kind):
    sets = [["Customer_ID", "fullname", "segmnt", "chanel", "date"], ["orderid ", "cust", "prodct_id", "qnty", "orderdate", "rgn", "unitprice"],
            ["tx", "storeid", "item", "units_sold", "tim", "amount_total"], ["stocks", "re_order", "restock", "store_ids", "pid"], ["zzz"]]
    df = spark.createDataFrame([(str(n), kind, i, c) for n, cols in enumerate(sets) for i, c in enumerate(cols)],
                               "dataset string, type string, position int, column string")
    got = {}
    for r in onboard.map_columns(df).collect():
        got.setdefault(r.dataset, {})[r.field] = r.column
    assert got == {str(n): brute_mapping(cols, kind) for n, cols in enumerate(sets)}


def test_mapping_is_one_aggregation_of_the_datasets(spark):
    """Rows without dataset, column or position, repeated rows and an unknown type; the pairs of columns and fields are no rows."""
    data = [("a", "POS", 1, "transactionid"), ("a", "POS", 2, "Store "), ("a", "POS", 2, "Store "), ("a", "POS", None, None), ("a", "POS", 3, "storeid"),
            ("b", "CRM", None, "id"), ("b", "CRM", 2, "uid"), (None, "POS", 1, "store"), ("c", "Other", 1, "store"), ("d", "POS", 1, None)]
    df = spark.createDataFrame(data, "dataset string, type string, position int, column string")
    out = onboard.map_columns(df)
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    got = {(r.dataset, r.type, r.field): (r.column, r.how) for r in out.collect()}
    assert len(got) == out.count() == 3 * 6 + 5
    assert {k: v for k, v in got.items() if v != (None, None)} == {
        ("a", "POS", "store_id"): ("Store ", "synonym"), ("a", "POS", "transaction_id"): ("transactionid", "fuzzy"),
        ("a", "POS", "timestamp"): ("transactionid", "fuzzy"),
        ("b", "CRM", "customer_id"): ("id", "synonym")}


def test_dependencies_and_impact(spark):
    staged, registry = spark.createDataFrame([("ERP",)], "type string"), spark.createDataFrame([("CRM",)], "type string")
    assert rows(onboard.missing_dependencies(staged, registry), "type", "required") == [("ERP", "Products")]
    sizes = spark.createDataFrame([("f", "POS", 7)], "dataset string, type string, rows bigint")
    assert rows(onboard.impact(sizes), "projected_rows", "gold_table") == [(7, "gold_sales_metrics")]


def test_schema_versions(spark):
    history = spark.createDataFrame([], "dataset_name string, schema_version int, columns array<string>")
    seen = []
    for cols in (["a", "b"], ["a", "b", "c"], ["a", "c"], ["c", "a"], ["a", "d"]):
        incoming = spark.createDataFrame([("f", cols)], "dataset_name string, columns array<string>")
        r = onboard.track_schema(history, incoming).first()
        seen.append((r.schema_version, r.change_type, r.added, r.removed))
        if r.change_type != "NONE":
            history = history.unionByName(spark.createDataFrame([("f", r.schema_version, cols)], history.schema))
    assert seen == [(1, "INITIAL", [], []), (2, "ADDED", ["c"], []), (3, "REMOVED", [], ["b"]), (3, "NONE", [], []),
                    (4, "CHANGED", ["d"], ["c"])]
    assert [r.schema_version for r in onboard.schema_history(history, "f").collect()] == [4, 3, 2, 1]


def test_listing_extraction(spark):
    html = ('<body><div class="job-listing top"><h2> Engineer &amp; co </h2><p><span class="x company">ACME</span></p></div>'
            '<div class="job-listing"><h2>No company</h2></div><div class="other"><h2>x</h2><span class="company">y</span></div>'
            '<br><div class="job-listing"><div class="job-listing"><h2>in<b>ner</b></h2></div><span class="company">Z</span></div></body>')
    pages = spark.createDataFrame([(1, html), (2, None), (3, "<p>nothing")], "page_id bigint, html string")
    assert rows(extract_listings(pages), "page_id", "title", "company") == [
        (1, "Engineer & co", "ACME"), (1, "inner", "Z")]
    links = spark.createDataFrame([(1, '<a class="k" href="/x">t</a><a href="/y">u</a>')], "page_id bigint, html string")
    assert rows(extract_links(links)) == [(1, 0, "/x"), (1, 1, "/y")]


def test_dashboard_figures(spark):
    sales = spark.range(40).select(F.expr("date_add(date'2024-01-01', cast(id as int))").alias("date"),
                                   F.col("id").cast("double").alias("daily_revenue"), F.lit(2).alias("daily_transactions"),
                                   F.lit(1.0).alias("revenue_growth_pct"))
    r = gold.kpi_sales(sales).first()
    assert (r.total_revenue, r.total_transactions, r.avg_growth_pct) == (sum(range(10, 40)), 60, 1.0)
    assert r.avg_daily_revenue == pytest.approx(sum(range(10, 40)) / 30)
