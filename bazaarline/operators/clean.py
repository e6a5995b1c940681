"""Bronze to silver: one transform per feed, plus a generic one for unknown feeds."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import functions as fn
from .. import schemas
from ..sources.lake import Lake
from .rows import dedup, dedup_few

Order = Sequence[str | Column]
LOADED_AT = "_loaded_at"
MONEY = "decimal(18,4)"


def _replace(df: DataFrame, **cols: Column) -> DataFrame:
    return df.withColumns(cols)


def _with_ids(df: DataFrame, *ids: str) -> DataFrame:
    """Keys of a text feed as whole numbers, so that copies are found by value."""
    text = [c for c in ids if c in df.columns and df.schema[c].dataType.typeName() == "string"]
    return df.withColumns({c: fn.as_id(F.col(c)) for c in text}) if text else df


def clean_erp_orders(df: DataFrame, order_by: Order, once: Callable = dedup) -> DataFrame:
    """First row per order; dates, whole quantities, prices and upper-case regions."""
    kept = once(_with_ids(df, "order_id", "customer_id", "product_id"), ["order_id"], order_by)
    types = {f.name: f.dataType for f in df.schema}
    return _replace(
        kept,
        order_date=fn.parse_ts(F.col("order_date"), strict=True, dtype=types["order_date"]),
        quantity=fn.coerce_num(F.col("quantity"), to_int=True, dtype=types["quantity"]),
        unit_price=fn.coerce_num(F.col("unit_price"), dtype=types["unit_price"]),
        region=fn.fill_upper(F.col("region")),
    )


def clean_crm_customers(df: DataFrame, order_by: Order, once: Callable = dedup) -> DataFrame:
    """First row per customer; dates, title-case names, missing segments named."""
    kept = once(_with_ids(df, "customer_id"), ["customer_id"], order_by)
    types = {f.name: f.dataType for f in df.schema}
    return _replace(
        kept,
        signup_date=fn.parse_ts(F.col("signup_date"), strict=True, dtype=types["signup_date"]),
        customer_name=fn.title_trim(F.col("customer_name")),
        segment=fn.fill_const(F.col("segment"), "Uncategorized"),
    )


def clean_pos_transactions(df: DataFrame, order_by: Order, once: Callable = dedup) -> DataFrame:
    """First row per transaction; dates and amounts. Quantities are read, not filled."""
    kept = once(_with_ids(df, "transaction_id", "store_id", "product_id"), ["transaction_id"], order_by)
    types = {f.name: f.dataType for f in df.schema}
    return _replace(
        kept,
        timestamp=fn.parse_ts(F.col("timestamp"), strict=True, dtype=types["timestamp"]),
        quantity=fn.to_number(F.col("quantity"), types["quantity"]),
        sale_amount=fn.coerce_num(F.col("sale_amount"), dtype=types["sale_amount"]),
    )


def clean_products(df: DataFrame, order_by: Order, once: Callable = dedup) -> DataFrame:
    """First row per product; title-case names and categories, prices."""
    kept = once(_with_ids(df, "product_id"), ["product_id"], order_by)
    types = {f.name: f.dataType for f in df.schema}
    return _replace(
        kept,
        product_name=fn.title_trim(F.col("product_name")),
        category=fn.fill_title(F.col("category")),
        unit_price=fn.coerce_num(F.col("unit_price"), dtype=types["unit_price"]),
    )


def clean_inventory(df: DataFrame, order_by: Order, once: Callable = dedup) -> DataFrame:
    """Last row per raw store and product; lenient dates, whole numbers.

    The copies are removed before the ids are coerced, so two different bad ids may both end
    up as 0; the quality suite reports that.
    """
    kept = once(df, ["store_id", "product_id"], order_by, keep="last")
    types = {f.name: f.dataType for f in df.schema}
    whole = {c: fn.coerce_num(F.col(c), to_int=True, dtype=types[c])
             for c in ("stock_level", "reorder_point", "store_id", "product_id")}
    return _replace(
        kept,
        last_restock_date=fn.parse_ts(F.col("last_restock_date"), dtype=types["last_restock_date"]),
        **whole,
    )


def generic_clean(df: DataFrame, cast_all: bool = True) -> DataFrame:
    """Distinct rows with ``'Unknown'`` for every missing cell."""
    return fn.fill_all(df.distinct(), "Unknown", cast_all)


CLEANERS: dict[str, Callable[..., DataFrame]] = {
    "erp_orders": clean_erp_orders,
    "crm_customers": clean_crm_customers,
    "pos_transactions": clean_pos_transactions,
    "products": clean_products,
    "inventory": clean_inventory,
}


def clean(df: DataFrame, source: str, order_by: Order = (), once: Callable = dedup) -> DataFrame:
    """Cleaner of the named feed; unknown feeds get the generic one. ``once`` picks the one row of a key (``dedup_few``: the same one)."""
    cleaner = CLEANERS.get(source)
    return generic_clean(df) if cleaner is None else cleaner(df, order_by, once)


def to_silver(lake: Lake, source: str, run_id: str, order_by: Order = ("_file", "_block", "_pos"), few_copies: bool = False) -> str | None:
    """Clean one run's bronze partition into the silver partition of the same run.

    ``few_copies`` says that few keys are expected twice: then only rows of such keys are shuffled and ordered.
    """
    bronze = lake.read("bronze", f"{source}/run_id={run_id}")
    if bronze is None:
        return None
    return write_silver(lake, clean_delivery(bronze, source, order_by, dedup_few if few_copies else dedup), source, run_id)


def _silver_types(df: DataFrame, source: str) -> list[Column]:
    """Columns of a known feed in its fixed types, so that deliveries of text, uploads and frames mix:
    whole numbers as bigint, instants without a zone, and money as exact decimals."""
    known = {f.name: f.dataType.simpleString() for f in schemas.layout(source)} if source in schemas.SOURCES else {}
    exact = {"double": MONEY}
    return [F.col(f"`{c}`").try_cast(exact.get(known[c], known[c])).alias(c) if c in known else F.col(f"`{c}`")
            for c in df.columns]


def write_silver(lake: Lake, df: DataFrame, source: str, run_id: str) -> str:
    """Store one run's silver rows with the time of the load, by which later loads win."""
    stamped = df.select(*_silver_types(df, source)).withColumn(LOADED_AT, F.lit(datetime.now()).cast("timestamp_ntz"))
    return lake.replace_partition(stamped, "silver", source, "run_id", run_id)


def clean_delivery(bronze: DataFrame, source: str, order_by: Order = ("_file", "_block", "_pos"), once: Callable = dedup) -> DataFrame:
    """Cleaned rows of one delivery. Its line positions decide which copy is first; a delivery
    without positions is ordered by its values, so the result does not depend on task timing."""
    helpers = [c for c in bronze.columns if c.startswith("_")]
    if source not in CLEANERS:
        return clean(bronze.drop(*helpers), source)
    order = [c for c in order_by if c in bronze.columns] or bronze.columns
    return clean(bronze, source, order, once).drop(*helpers)


def silver_current(lake: Lake, source: str) -> DataFrame | None:
    """Silver rows of all runs, the latest load winning per business key.

    Loads are ordered by their stored time, so runs and streams mix whatever their ids are.
    """
    silver = lake.read("silver", source)
    if silver is None:
        return None
    keys = schemas.SOURCE_KEYS.get(source)
    if keys is None:
        return silver.drop("run_id", LOADED_AT).distinct()
    return dedup(silver, keys, [LOADED_AT, "run_id"], keep="last").drop("run_id", LOADED_AT)


def conform(df: DataFrame, mapping: Mapping[str, str | None], template: StructType | Sequence[str]) -> DataFrame:
    """Project onto the template's fields: the mapped column, or NULL where none is mapped."""
    out = []
    for field in template:
        name = field if isinstance(field, str) else field.name
        source = mapping.get(name)
        col = F.col(f"`{source}`") if source in df.columns else F.lit(None).cast("string")
        if not isinstance(field, str):
            col = col.cast(field.dataType)
        out.append(col.alias(name))
    return df.select(*out)


def where_in(df: DataFrame, **allowed: Sequence) -> DataFrame:
    """Rows whose columns are all in the given lists."""
    for column, values in allowed.items():
        df = df.filter(F.col(column).isin(list(values)))
    return df
