"""Star-schema load of one run: dimensions, facts, gold tables, audit."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from .. import schemas
from ..operators import audit, clean, facts, gold, scd
from ..operators.rows import dedup, upsert
from ..operators.skew import size_bytes
from ..session import KEPT, counted, row_count
from ..sources.buckets import BucketTable, Manifest
from ..sources.lake import Lake
from ..sources.members import LoadedKeys
from ..sources.tables import publish_gold

CUSTOMER_COMPARE = ["customer_name", "segment", "acquisition_channel"]
PRODUCT_COMPARE = ["product_name", "category", "unit_price"]
PRICE_TOLERANCE = 0.001
FILTER_FROM = 64 * 2**20  # bytes of keys from which a fact keeps filters of them


def merge_customers(dim: DataFrame, stg: DataFrame, load_ts: str | datetime, **options) -> DataFrame:
    """Next snapshot of the customer dimension; the default member is seeded first."""
    options.setdefault("default_row", schemas.DEFAULT_CUSTOMER)
    return scd.scd2_merge(dim, stg, "customer_id", CUSTOMER_COMPARE, load_ts, "customer_sk", **options)


def merge_products(dim: DataFrame, stg: DataFrame, load_ts: str | datetime, **options) -> DataFrame:
    """Next snapshot of the product dimension; prices within the tolerance count as equal."""
    return scd.scd2_merge(dim, stg, "product_id", PRODUCT_COMPARE, load_ts, "product_sk",
                          tolerance={"unit_price": PRICE_TOLERANCE}, **options)


def load_dimensions(lake: Lake, run_id: str, load_ts: str | datetime, stores: DataFrame | None = None) -> None:
    """Upsert stores and merge the run's customers and products."""
    if stores is not None:
        layout = schemas.layout("dim_store")
        fresh = dedup(schemas.fit(stores, "dim_store").dropna(subset=["store_id"]), ["store_id"], layout.names)
        lake.publish(upsert(lake.snapshot("dim_store", layout), fresh, ["store_id"]), "dim_store")
    for source, table in (("crm_customers", "dim_customer"), ("products", "dim_product")):
        silver = lake.read("silver", f"{source}/run_id={run_id}")
        if silver is not None:
            merge_dimension(lake, table, silver, load_ts)


def merge_dimension(lake: Lake, table: str, stg: DataFrame, load_ts: str | datetime, bucket_rows: int | None = None) -> Manifest:
    """Merge a delivery into a stored dimension: only buckets with changed or new keys are written."""
    key, number, merge, compare, tolerance = {
        "dim_customer": ("customer_id", "customer_sk", merge_customers, CUSTOMER_COMPARE, {}),
        "dim_product": ("product_id", "product_sk", merge_products, PRODUCT_COMPARE, {"unit_price": PRICE_TOLERANCE})}[table]
    stored = BucketTable(lake, table, key, number, schemas.layout(table), bucket_rows)
    attrs = [c for c in stored.schema.names if c not in (key, number, scd.EFFECTIVE, scd.END, scd.CURRENT)]
    staged = dedup(stg.select(key, *attrs), [key], attrs)

    def change(dim: DataFrame, batch: DataFrame, top: int | None) -> DataFrame:
        # the default member comes with the first merge; later ones see a part of the dimension only
        return merge(dim, batch, load_ts, **({} if top is None else {"default_row": None, "start": top}))

    return stored.merge(staged, lambda dim, batch: scd.scd2_dirty(dim, batch, key, compare, tolerance), change,
                        first=lake.snapshot(table, stored.schema))


def _not_loaded(lake: Lake, batch: DataFrame, name: str, key: str, ts: str, filter_from: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows whose key the fact lacks, by the fact's stored filters; for a small fact without filters, the batch and the fact to compare with.

    A first load has nothing to be compared with, and notes no keys: the filters are made once the fact is large.
    """
    members = LoadedKeys(lake, name, key)
    if not members.exists() and lake.read("warehouse", name) is None:
        return batch, None
    existing = lake.facts(name, schemas.layout(name))
    if not members.exists() and size_bytes(existing.select(key)) <= filter_from:
        return batch, existing
    members.compact()
    fresh = members.unseen(batch)
    # the calendar's keys are the computed ones, so this is the partition the fact will be in
    members.add(fresh.select(key, F.floor(fn.date_id(fn.to_second(F.col(ts))) / 100).cast("int").alias("date_month")))
    return fresh, None


def load_facts(lake: Lake, run_id: str, filter_from: int = FILTER_FROM) -> dict[str, int]:
    """Append the run's new facts; returns the number of rows per fact table.

    A fact of more than ``filter_from`` bytes of keys gets stored filters (``LoadedKeys``), which later loads keep.
    """
    pos = lake.read("silver", f"pos_transactions/run_id={run_id}")
    erp = lake.read("silver", f"erp_orders/run_id={run_id}")
    dated = [(df, col) for df, col in ((pos, "timestamp"), (erp, "order_date")) if df is not None]
    if not dated:
        return {}
    dim_date = lake.publish(
        facts.extend_calendar(lake.snapshot("dim_date", schemas.layout("dim_date")), *dated), "dim_date")
    product = lake.snapshot("dim_product", schemas.layout("dim_product"))
    customer = lake.snapshot("dim_customer", schemas.layout("dim_customer"))
    loaded = {}
    if pos is not None:
        pos, existing = _not_loaded(lake, pos, "fact_sales", "transaction_id", "timestamp", filter_from)
        new = facts.fact_sales(pos, product, dim_date, existing, unique=True)
        loaded["fact_sales"] = _append(lake, new, "fact_sales")
    if erp is not None:
        erp, existing = _not_loaded(lake, erp, "fact_orders", "order_id", "order_date", filter_from)
        new = facts.fact_orders(erp, product, customer, dim_date, existing, unique=True)
        loaded["fact_orders"] = _append(lake, new, "fact_orders")
    return loaded


def _append(lake: Lake, new: DataFrame, name: str) -> int:
    """Append facts by month. Rows are gathered per month first, so a load writes few files."""
    rows = schemas.fit(new, name).withColumn("date_month", F.expr("date_id div 100"))
    watched, seen = counted(rows)
    watched.hint("rebalance", "date_month").write.mode("append").options(**KEPT).partitionBy("date_month").parquet(
        lake.path("warehouse", name))
    return row_count(seen, rows)


def build_gold(lake: Lake) -> dict[str, str]:
    """Gold datasets from the silver rows of all runs, read whole. ``gold_deltas.refresh_gold`` gives the same from one run's rows."""
    erp, crm = clean.silver_current(lake, "erp_orders"), clean.silver_current(lake, "crm_customers")
    pos, inv = clean.silver_current(lake, "pos_transactions"), clean.silver_current(lake, "inventory")
    written = {}
    if erp is not None and crm is not None:
        written["customer_metrics"] = lake.write(gold.customer_metrics(erp, crm), "gold", "customer_metrics")
    if pos is not None:
        written["sales_metrics"] = lake.write(gold.sales_metrics(pos), "gold", "sales_metrics")
    if pos is not None and inv is not None:
        written["inventory_metrics"] = lake.write(gold.inventory_metrics(inv, pos), "gold", "inventory_metrics")
    return written


def run_audit(lake: Lake) -> dict[str, int]:
    """The seven integrity counters of the stored warehouse; raises on any violation."""
    return audit.enforce(audit.audit(
        lake.facts("fact_sales", schemas.layout("fact_sales")),
        lake.facts("fact_orders", schemas.layout("fact_orders")),
        lake.snapshot("dim_customer", schemas.layout("dim_customer")),
        lake.snapshot("dim_product", schemas.layout("dim_product"))))


def load_warehouse(lake: Lake, run_id: str, load_ts: str | datetime, stores: DataFrame | None = None,
                   database: str | None = None) -> dict[str, int]:
    """Dimensions, then facts, then reporting tables, then the audit."""
    load_dimensions(lake, run_id, load_ts, stores)
    loaded = load_facts(lake, run_id)
    if database:
        publish_gold(lake, database)
    run_audit(lake)
    return loaded
