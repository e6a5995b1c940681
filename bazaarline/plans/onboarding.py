"""Batch onboarding of a folder of uploads."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..ledger import Ledger
from ..operators import onboard as ops
from ..operators import templates
from ..operators.clean import conform
from ..operators.profile import infer_types, profile
from ..operators.scorecard import scorecard
from ..sources.files import CORRUPT, POSITION, read_source
from ..sources.lake import Lake
from ..sources.tables import custom_name, load_custom
from .medallion import run_medallion


PARALLEL = 8  # uploads examined at a time


def list_uploads(spark: SparkSession, upload_dir: str) -> list[str]:
    """Paths of the CSV files of a folder, by name."""
    base = spark._jvm.org.apache.hadoop.fs.Path(upload_dir)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(str(s.getPath()) for s in fs.listStatus(base) if str(s.getPath()).lower().endswith(".csv"))


def _headers(spark: SparkSession, frames: Mapping[str, DataFrame]) -> DataFrame:
    rows = [(name, name, n, c) for name, df in frames.items()
            for n, c in enumerate(c for c in df.columns if not c.startswith("_"))]
    return spark.createDataFrame(rows, "dataset string, filename string, position int, column string")


def _no_clash(ledger: Ledger, unknown: list[str]) -> None:
    """Stop before anything is written if two files, of this folder or of an earlier one, would become the same table."""
    owners = {custom_name(r["dataset_name"]): r["dataset_name"] for r in ledger.registry().where(
        "last_run_id = 'custom_import'").select("dataset_name").collect()}  # one short row per unclassified upload
    for name in unknown:
        owner = owners.setdefault(custom_name(name), name)
        if owner != name:
            raise ValueError(f"{owner} and {name} would both become {custom_name(name)}; rename one of them")


def onboard(spark: SparkSession, lake: Lake, upload_dir: str, run_id: str, load_ts: str | datetime,
            type_override: Mapping[str, str] | None = None,
            mapping_override: Mapping[str, Mapping[str, str]] | None = None,
            stores: DataFrame | None = None, database: str = "default") -> DataFrame:
    """Profile, classify, map, score, conform, load and register every upload of a folder.

    Unknown files become ``custom_<name>`` tables. Files of a known type are conformed and run
    through the medallion job together, all their rows: uploads may be older than the marks of the
    regular feeds and do not move them. ``type_override`` and ``mapping_override`` (by file
    name) replace what was detected. Returns the registry entries of this run.
    """
    ledger = Ledger(lake)
    frames = {os.path.basename(p): infer_types(read_source(spark, p, position=True).drop(CORRUPT))
              for p in list_uploads(spark, upload_dir)}
    headers = _headers(spark, frames)
    detected = {r["dataset"]: r for r in ops.classify(headers.select("dataset", "filename", "column")).collect()}
    types = {name: (type_override or {}).get(name, detected[name]["detected_type"]) for name in frames}
    typed = headers.join(F.broadcast(spark.createDataFrame(list(types.items()), "dataset string, type string")),
                         "dataset")
    _no_clash(ledger, [name for name, kind in types.items() if kind == "Unknown"])
    mapping: dict[str, dict[str, str | None]] = {name: {} for name in frames}
    chosen = {(r["dataset"], r["field"]): r["column"] for r in ops.map_columns(typed).collect()}
    for name, kind in types.items():
        for field in templates.TEMPLATES.get(kind, {}):
            mapping[name][field] = (mapping_override or {}).get(name, {}).get(field, chosen.get((name, field)))

    entries: list[DataFrame] = []
    inputs: dict[str, DataFrame] = {}
    files: dict[str, list[str]] = {}
    layout = schemas.layout("dataset_registry")

    def examine(name: str) -> tuple:
        """Store an upload as it came, profile and score what was stored (its text is not parsed again); files of one call run
        side by side."""
        df, kind = frames[name], types[name]
        data = df.drop(*POSITION)
        path = lake.write(data, "bronze", f"uploads/{os.path.splitext(name)[0]}")
        data = spark.read.schema(data.schema).parquet(path)
        facts = profile(data).drop("numeric_fields", "date_fields", "categorical_fields").first()
        score = None if kind == "Unknown" else \
            scorecard(data, kind, mapping[name]).withColumn("details", F.to_json("deductions")).first()
        return name, facts, score

    with ThreadPoolExecutor(PARALLEL) as pool:
        examined = list(pool.map(examine, frames))
    for name, facts, score in examined:
        df, kind = frames[name], types[name]
        data = df.drop(*POSITION)
        common = dict(dataset_name=name, original_filename=name, source_file_name=name, source_dataset_type=kind,
                      detected_type=kind, rows_count=facts["rows"], columns_count=facts["columns"],
                      schema_definition=facts["schema_definition"])
        if kind == "Unknown":
            table = load_custom(data, name, database)
            ledger.log_lineage("custom_import", name, source_file_name=name,
                               bronze_path=lake.path("bronze", f"uploads/{os.path.splitext(name)[0]}"),
                               silver_path=f"{database}.{table}")
            entries.append(ops.registry_row(
                spark, layout, **common, status="Completed", quality_score=100.0, completeness_score=100.0,
                validity_score=100.0, uniqueness_score=100.0, consistency_score=100.0, quality_details="[]",
                confidence_score=0.0, detection_signals="[]", last_run_id="custom_import"))
            continue
        feed = templates.FEEDS[kind]
        fields = {**mapping[name], **{c: c for c in POSITION}}
        conformed = conform(df, fields, [*templates.TEMPLATES[kind], *POSITION])
        inputs[feed] = inputs[feed].unionByName(conformed) if feed in inputs else conformed
        files.setdefault(feed, []).append(name)
        entries.append(ops.registry_row(
            spark, layout, **common, status="Completed", quality_score=float(score["quality_score"]),
            completeness_score=float(score["completeness"]), validity_score=float(score["validity"]),
            uniqueness_score=float(score["uniqueness"]), consistency_score=float(score["consistency"]),
            quality_details=score["details"], confidence_score=float(detected[name]["confidence_score"]),
            detection_signals=json.dumps(detected[name]["matched_signals"], ensure_ascii=False), last_run_id=run_id))
    if inputs:
        run_medallion(spark, lake, inputs, run_id, load_ts, stores, files=files, everything=True)
    names = [(n, [c for c in df.columns if c not in POSITION]) for n, df in frames.items()]
    ledger.track_schema(spark.createDataFrame(names, "dataset_name string, columns array<string>"))
    if entries:
        ledger.register(reduce(lambda a, b: a.unionByName(b), entries))
    return ledger.registry().filter(F.col("dataset_name").isin(list(frames)))
