"""Query registry and the retail feeds as views over the given tables."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from ..operators import clean, facts, gold
from .views import BASE_TABLES, VIEWS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The order feed with its joins in another order: the market of an order is found before its lines are joined, so the lines,
# the longest table, are shuffled twice instead of three times. The rows are those of the view.
SPARK_FORMS = {"erp": VIEWS["erp"].split("\nfrom ")[0] + """
from (select o_orderkey, o_custkey, o_orderdate, r_name from orders join customer on o_custkey=c_custkey
      join nation on c_nationkey=n_nationkey join region on n_regionkey=r_regionkey) placed
     join lineitem on l_orderkey=o_orderkey join part on l_partkey=p_partkey"""}

_WORD = re.compile(r"[a-z_][a-z_0-9]*")


def _uses(text: str) -> list[str]:
    """Views the text needs, dependencies first."""
    order: list[str] = []

    def visit(body: str) -> None:
        for word in dict.fromkeys(_WORD.findall(body)):
            if word in VIEWS and word not in order:
                visit(VIEWS[word])
                order.append(word)

    visit(text)
    return order


def oracle_text(text: str) -> str:
    """The query with the views it uses as common table expressions."""
    def literal(body: str) -> str:
        return re.sub(r"TS\('([^']*)'\)", r"TIMESTAMP '\1'", body)

    views = _uses(text)
    if not views:
        return literal(text)
    ctes = ",\n".join(f"{v} AS ({literal(VIEWS[v])})" for v in views)
    body = literal(text).lstrip()
    if body[:5].lower() == "with ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


class Feeds:
    """The five feeds, stores and versioned dimensions derived from one folder of tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.table = cache(self._table)
        self.view = cache(self._view)

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _view(self, name: str) -> DataFrame:
        return self.sql(SPARK_FORMS.get(name, VIEWS[name]))

    def sql(self, text: str) -> DataFrame:
        """SQL over tables and views; every name is resolved to its frame."""
        text = re.sub(r"TS\('([^']*)'\)", r"TIMESTAMP_NTZ '\1'", text)
        frames: dict[str, DataFrame] = {}

        def name(match: re.Match) -> str:
            word = match.group(2)
            if word not in BASE_TABLES and word not in VIEWS:
                return match.group(0)
            frames[word] = self.table(word) if word in BASE_TABLES else self.view(word)
            return f"{match.group(1)}{{{word}}}"

        text = re.sub(r"(\b(?:from|join)\s+)([a-z_][a-z_0-9]*)\b", name, text, flags=re.I)
        return self.spark.sql(text, **frames)

    # silver feeds, as the cleaners make them from the views ---------------------------

    ERP_ORDER = ("ord1", "ord2", "product_id", "quantity", "ord3")
    POS_ORDER = ("timestamp", "store_id", "product_id", "quantity", "sale_amount")
    INV_ORDER = ("last_restock_date", "ord1", "stock_level")

    def erp(self) -> DataFrame:
        return clean.clean_erp_orders(self.view("erp"), self.ERP_ORDER).drop("ord1", "ord2", "ord3")

    def pos(self) -> DataFrame:
        return clean.clean_pos_transactions(self.view("pos"), self.POS_ORDER)

    def inventory(self) -> DataFrame:
        return clean.clean_inventory(self.view("inventory"), self.INV_ORDER).drop("ord1")

    # star schema and gold on top of them ----------------------------------------------

    def calendar(self) -> DataFrame:
        return facts.calendar((self.view("pos"), "timestamp"), (self.view("erp"), "order_date"))

    def fact_sales(self) -> DataFrame:
        return facts.fact_sales(self.pos(), self.view("dim_product"), unique=True)

    def fact_orders(self) -> DataFrame:
        return facts.fact_orders(self.erp(), self.view("dim_product"), self.view("dim_customer"), unique=True)

    def customer_metrics(self) -> DataFrame:
        return gold.customer_metrics(self.erp(), self.view("crm"))

    def sales_metrics(self) -> DataFrame:
        return gold.sales_metrics(self.pos())

    def inventory_metrics(self) -> DataFrame:
        return gold.inventory_metrics(self.inventory(), self.pos())


def query(name: str, oracle: str | None = None):
    """Register ``fn(feeds)`` under ``name`` with an optional SQL twin."""

    def add(fn: Callable[[Feeds], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Feeds(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = oracle_text(oracle)
        return fn

    return add
