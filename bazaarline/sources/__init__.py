"""Sources and sinks: lake layers, CSV feeds, incremental scans, tables and HTML pages."""

from .files import export_csv, read_source, write_quality_report
from .html import extract_links, extract_listings
from .incremental import Watermarks, load_incremental, reset_watermark, write_bronze
from .lake import Lake
from .tables import bootstrap, fact_writer, load_custom, load_table, publish_gold, run_sql, truncate_load

__all__ = [
    "export_csv", "read_source", "write_quality_report", "extract_links", "extract_listings", "Watermarks",
    "load_incremental", "reset_watermark", "write_bronze", "Lake", "bootstrap", "fact_writer",
    "load_custom", "load_table", "publish_gold", "run_sql", "truncate_load",
]
