"""Fixed table layouts: source feeds, star schema, gold tables and logs."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Column names and types of the five conformed source feeds.
SOURCES: dict[str, str] = {
    "crm_customers": "customer_id bigint, customer_name string, segment string, "
                     "acquisition_channel string, signup_date timestamp_ntz",
    "products": "product_id bigint, product_name string, category string, unit_price double",
    "erp_orders": "order_id bigint, customer_id bigint, product_id bigint, quantity bigint, "
                  "order_date timestamp_ntz, region string, unit_price double",
    "pos_transactions": "transaction_id bigint, store_id bigint, product_id bigint, quantity bigint, "
                        "timestamp timestamp_ntz, sale_amount double",
    "inventory": "store_id bigint, product_id bigint, stock_level bigint, reorder_point bigint, "
                 "last_restock_date timestamp_ntz",
}

# Business key and incremental date column per feed.
SOURCE_KEYS = {
    "crm_customers": ["customer_id"],
    "products": ["product_id"],
    "erp_orders": ["order_id"],
    "pos_transactions": ["transaction_id"],
    "inventory": ["store_id", "product_id"],
}
SOURCE_DATES = {
    "erp_orders": "order_date",
    "crm_customers": "signup_date",
    "pos_transactions": "timestamp",
    "products": None,
    "inventory": "last_restock_date",
}

# Warehouse, gold and log layouts.
WAREHOUSE: dict[str, str] = {
    "dim_customer": "customer_sk bigint, customer_id bigint, customer_name string, segment string, "
                    "acquisition_channel string, signup_date date, effective_date timestamp_ntz, "
                    "end_date timestamp_ntz, is_current boolean",
    "dim_product": "product_sk bigint, product_id bigint, product_name string, category string, "
                   "unit_price decimal(10,2), effective_date timestamp_ntz, end_date timestamp_ntz, "
                   "is_current boolean",
    "dim_store": "store_id bigint, store_name string, city string, state string, region string",
    "dim_date": "date_id int, full_date date, year int, month int, day int, quarter int, "
                "day_of_week int, is_weekend boolean",
    "fact_sales": "transaction_id bigint, date_id int, store_id bigint, product_sk bigint, "
                  "customer_sk bigint, quantity bigint, sale_amount decimal(15,2)",
    "fact_orders": "order_id bigint, date_id int, customer_sk bigint, product_sk bigint, "
                   "quantity bigint, unit_price decimal(10,2), total_amount decimal(15,2), region string",
    "gold_inventory_metrics": "store_id bigint, product_id bigint, stock_level bigint, "
                              "reorder_point bigint, stock_turnover double, inventory_velocity double, "
                              "days_inventory_outstanding double, low_stock_alert boolean",
    "gold_customer_metrics": "customer_id bigint, customer_name string, segment string, "
                             "acquisition_channel string, signup_date timestamp_ntz, "
                             "total_revenue double, total_orders bigint, average_order_value double",
    "gold_sales_metrics": "date date, daily_revenue double, daily_transactions bigint, "
                          "revenue_growth_pct double",
}
LOGS: dict[str, str] = {
    "pipeline_runs": "run_id string, event_time timestamp_ntz, rows_processed bigint, rows_loaded bigint, "
                     "rows_failed bigint, pipeline_status string, error_message string",
    "data_quality_results": "run_id string, dataset_name string, expectation string, passed boolean, "
                            "details string, evaluation_time timestamp_ntz",
    "data_lineage": "run_id string, source_dataset string, source_file_name string, bronze_path string, "
                    "silver_path string, gold_path string, load_timestamp timestamp_ntz",
    "dataset_registry": "dataset_name string, original_filename string, source_file_name string, "
                        "source_dataset_type string, detected_type string, status string, rows_count bigint, "
                        "columns_count int, schema_version int, schema_definition string, "
                        "quality_score double, completeness_score double, validity_score double, "
                        "uniqueness_score double, consistency_score double, quality_details string, "
                        "confidence_score double, detection_signals string, upload_timestamp timestamp_ntz, "
                        "upload_user string, last_run_id string",
    "schema_history": "dataset_name string, schema_version int, columns string, change_type string, "
                      "upload_timestamp timestamp_ntz",
    "pipeline_watermarks": "source_name string, last_processed_timestamp timestamp_ntz, "
                           "updated_at timestamp_ntz",
}

# The default customer every unmatched order points to.
DEFAULT_CUSTOMER = {
    "customer_sk": 1, "customer_id": 99999, "customer_name": "Walk-in Customer", "segment": "Retail",
    "acquisition_channel": "Organic", "signup_date": "2020-01-01",
    "effective_date": "2020-01-01 00:00:00", "end_date": None, "is_current": True,
}
FIRST_EFFECTIVE = "2000-01-01 00:00:00"
OPEN_END = "9999-12-31 23:59:59"


def layout(name: str) -> StructType:
    """The layout of a named table as a StructType."""
    for group in (SOURCES, WAREHOUSE, LOGS):
        if name in group:
            return StructType.fromDDL(group[name])
    raise KeyError(name)


def fit(df, name: str):
    """Project ``df`` onto the fixed layout of ``name`` (order, types, missing columns as NULL)."""
    from pyspark.sql import functions as F

    return df.select(*[
        (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in layout(name)
    ])
