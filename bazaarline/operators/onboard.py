"""Onboarding operators over many datasets at once: classify, map, dependencies, schema versions, registry."""

from __future__ import annotations

import difflib
from collections.abc import Sequence
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from . import templates
from .rows import schema_diff
from .skew import spread_join

# Weights and limits of the classification and of the fuzzy matches.
COLUMN_WEIGHT, FILENAME_WEIGHT = 0.65, 0.35
AUTO, REVIEW, LEGACY_MIN = 90, 70, 30
FIELD_CUTOFF, SYNONYM_CUTOFF = 0.6, 0.7


def _normal(col):
    return F.btrim(F.lower(col))


# Every template field has one bit, so the matches of a dataset fit in one integer.
_BITS = {(t, f): n for n, (t, f) in enumerate((t, f) for t, fields in templates.TEMPLATES.items() for f in fields)}


def _name_masks(spark: SparkSession) -> DataFrame:
    """One row per synonym with the bits of all fields it stands for."""
    masks: dict[str, int] = {}
    for t, fields in templates.TEMPLATES.items():
        for field, (_, synonyms) in fields.items():
            for name in synonyms:
                masks[name] = masks.get(name, 0) | 1 << _BITS[t, field]
    return spark.createDataFrame(list(masks.items()), "synonym string, bits bigint")


def _options(columns: DataFrame) -> DataFrame:
    """Per dataset the five templates as an array, best score first (ties: template order).

    ``columns`` holds (dataset, filename, column), one file name per dataset. Names are looked
    up in the fixed synonym list (broadcast); the matches of a dataset are OR-ed into one
    integer, which hashes and combines before the only shuffle, on the dataset.
    """
    masks = F.broadcast(_name_masks(columns.sparkSession))
    named = columns.join(masks, _normal(F.col("column")) == F.col("synonym"), "left")
    found = named.groupBy("dataset", "filename").agg(F.coalesce(F.bit_or("bits"), F.lit(0)).alias("bits"))
    options = []
    for rank, (name, fields) in enumerate(templates.TEMPLATES.items()):
        bits = {f: 1 << _BITS[name, f] for f in fields}
        matched = F.bit_count(F.col("bits").bitwiseAND(F.lit(sum(bits.values()))))
        mine = F.array_compact(F.array(*[
            F.when(F.col("bits").bitwiseAND(F.lit(b)) != 0, F.lit(f)) for f, b in bits.items()]))
        hit = F.lit(False)
        for word in templates.KEYWORDS[name]:
            hit = hit | F.lower(F.col("filename")).contains(word)
        share = matched.cast("double") / F.lit(len(fields))
        raw = share * F.lit(COLUMN_WEIGHT) + F.when(hit, F.lit(FILENAME_WEIGHT)).otherwise(F.lit(0.0))
        score = (raw * F.lit(100)).cast("int")
        options.append(F.struct((-score).alias("order"), F.lit(rank).alias("type_rank"), F.lit(name).alias("type"),
                                score.alias("score"), matched.alias("matched"), mine.alias("fields"),
                                hit.alias("fn_matched")))
    return found.select("dataset", "filename", F.sort_array(F.array(*options)).alias("options"))


def scores(columns: DataFrame) -> DataFrame:
    """Score of every dataset for every template: ``(dataset, filename, type, ..., score)``."""
    return _options(columns).select("dataset", "filename", F.inline("options")).drop("order")


def classify(columns: DataFrame, auto: int = AUTO, review: int = REVIEW) -> DataFrame:
    """Best type per dataset with status, signals and alternatives.

    Ties go to the earlier template. Below ``review`` the dataset stays Unknown.
    """
    best = F.element_at("options", 1)
    known = best["score"] >= review
    others = F.filter(F.slice("options", 2, len(templates.TEMPLATES)), lambda o: o["score"] > 0)
    return _options(columns).select(
        "dataset", "filename",
        F.when(known, best["type"]).otherwise(F.lit("Unknown")).alias("detected_type"),
        best["score"].alias("confidence_score"),
        F.when(best["score"] >= auto, F.lit("Auto-Classified")).otherwise(F.lit("Needs Review")).alias("status"),
        _signals(known, best).alias("matched_signals"),
        F.transform(others, lambda o: F.struct(o["type"].alias("type"), o["score"].alias("score")))
        .alias("alternatives"))


def _signals(known, best):
    """Found and missing fields of the chosen template in template order, then the file-name signal."""
    per_type = F.lit(None).cast("array<string>")
    for t, fields in templates.TEMPLATES.items():
        names = F.array(*[F.lit(f) for f in fields])
        found = F.transform(F.filter(names, lambda f: F.array_contains(best["fields"], f)),
                            lambda f: F.concat(F.lit("✓ "), f))
        lacking = F.transform(F.filter(names, lambda f: ~F.array_contains(best["fields"], f)),
                              lambda f: F.concat(F.lit("⚠ Missing: "), f))
        name_hit = F.when(best["fn_matched"], F.array(F.lit("✓ Filename matched patterns"))) \
            .otherwise(F.array().cast("array<string>"))
        per_type = F.when(best["type"] == t, F.concat(found, lacking, name_hit)).otherwise(per_type)
    return F.when(known, per_type).otherwise(F.array(F.lit("⚠ Columns do not match any known templates")))


def classify_legacy(columns: DataFrame, minimum: int = LEGACY_MIN) -> DataFrame:
    """Older rule: best type whatever its status, Unknown with score 0 below ``minimum``."""
    best = _options(columns).select("dataset", F.element_at("options", 1).alias("b"))
    known = F.col("b.score") >= minimum
    return best.select(
        "dataset", F.when(known, F.col("b.type")).otherwise(F.lit("Unknown")).alias("detected_type"),
        F.when(known, F.col("b.score")).otherwise(F.lit(0)).alias("confidence_score"))


def _named_fields(names: DataFrame, fuzzy: bool) -> DataFrame:
    """Per type and column name, what the name may stand for: for each field of the type, by its rank, the ``plain`` step
    that names it and the best ``close`` one (step, rating). Names that stand for nothing are left out.

    This depends on the name alone, not on the dataset, so every distinct name is looked up and rated once.
    """
    syn = templates.synonyms_frame(names.sparkSession)
    fields = syn.select("type", "field", "field_rank").distinct()
    steps = fields.select("type", "field_rank", F.col("field").alias("synonym"), F.lit(0).alias("step"),
                          F.lit(FIELD_CUTOFF).alias("cutoff")) \
        .unionByName(syn.select("type", "field_rank", "synonym", (F.col("syn_rank") + 1).alias("step"),
                                F.lit(SYNONYM_CUTOFF).alias("cutoff")))
    pairs = names.select("type", "column").dropna().distinct().join(F.broadcast(steps), "type")
    ratio = similarity(F.col("synonym"), F.col("column")) if fuzzy else F.lit(None).cast("double")
    rated = pairs.withColumns({"plain": _normal(F.col("column")) == F.col("synonym"), "ratio": ratio})
    close = F.struct((-F.col("step")).alias("step"), "ratio")
    options = []
    for rank in range(max(len(f) for f in templates.TEMPLATES.values())):
        mine = F.col("field_rank") == rank
        options += [F.min(F.when(mine & F.col("plain"), F.col("step"))).alias(f"plain_{rank}"),
                    F.max(F.when(mine & (F.col("ratio") >= F.col("cutoff")), close)).alias(f"close_{rank}")]
    return rated.where("plain or ratio >= cutoff").groupBy("type", "column").agg(*options)


def map_columns(columns: DataFrame, fuzzy: bool = True) -> DataFrame:
    """Column chosen for every template field of a dataset: ``(dataset, type, field, column, how)``.

    ``columns`` holds (dataset, type, position, column). Order of preference: same name,
    synonyms in order, then (``fuzzy``) a close match of the field name, then of its synonyms.
    Names are rated apart from the datasets, and each field is a minimum or maximum in one aggregation per dataset, so
    the pairs of columns and fields are never rows.
    """
    names = columns.filter(F.col("type").isin(list(templates.TEMPLATES))).select("dataset", "type", "position", "column")
    known = spread_join(names, _named_fields(names, fuzzy), ["type", "column"], "left")
    picks = []
    for rank in range(max(len(f) for f in templates.TEMPLATES.values())):
        plain, close = F.col(f"plain_{rank}"), F.col(f"close_{rank}")
        picks += [F.min(F.when(plain.isNotNull(), F.struct(plain.alias("step"), "position", "column"))).alias(f"plain_{rank}"),
                  F.max(F.when(close.isNotNull(), F.struct(close.alias("close"), "column"))).alias(f"close_{rank}")]
    chosen = None
    for name, fields in templates.TEMPLATES.items():
        rows = []
        for rank, field in enumerate(fields):
            plain, close = F.col(f"plain_{rank}"), F.col(f"close_{rank}")
            how = F.when(plain["step"] == 0, "exact").when(plain.isNotNull(), "synonym").when(close.isNotNull(), "fuzzy")
            there = F.col("dataset").isNotNull()  # columns of no dataset are given to none
            rows.append(F.struct(F.lit(field).alias("field"), F.when(there, F.coalesce(plain["column"], close["column"])).alias("column"),
                                 F.when(there, how).alias("how")))
        chosen = F.when(F.col("type") == name, F.array(*rows)) if chosen is None else chosen.when(F.col("type") == name, F.array(*rows))
    return known.groupBy("dataset", "type").agg(*picks).select("dataset", "type", F.inline(chosen))


@F.pandas_udf(DoubleType())
def similarity(word: pd.Series, candidate: pd.Series) -> pd.Series:
    """Similarity of two names as the standard library rates it (case counts)."""
    seen: dict[tuple[str, str], float] = {}
    out = []
    for pair in zip(word, candidate):
        if pair not in seen:
            seen[pair] = difflib.SequenceMatcher(None, pair[1], pair[0]).ratio()
        out.append(seen[pair])
    return pd.Series(out, dtype="float64")


def missing_dependencies(staged: DataFrame, registry: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Required types that are neither registered nor staged, with what they are needed for.

    Both inputs hold a ``type`` column and the optional scope columns ``by``.
    """
    by = list(by)
    available = staged.select(*by, "type").unionByName(registry.select(*by, "type")).distinct()
    edges = F.broadcast(templates.requires_frame(staged.sparkSession))
    needed = staged.select(*by, "type").distinct().join(edges, "type")
    return needed.join(available.withColumnRenamed("type", "required"), [*by, "required"], "left_anti") \
        .select(*by, "type", "required", "impact")


def impact(sizes: DataFrame) -> DataFrame:
    """Tables and metrics touched by ingests: ``sizes`` holds (dataset, type, rows)."""
    return sizes.join(F.broadcast(templates.impact_frame(sizes.sparkSession)), "type").select(
        "dataset", "type", F.col("rows").alias("projected_rows"), "warehouse_table", "gold_table", "metrics")


def track_schema(history: DataFrame, incoming: DataFrame, dataset: str = "dataset_name") -> DataFrame:
    """Version and change type of every incoming schema against the latest known one.

    ``history`` holds (dataset, schema_version, columns), ``incoming`` one (dataset, columns)
    per dataset; ``columns`` are arrays of names. Only names count, types do not. Rows with
    ``change_type`` NONE need no history entry.
    """
    known = history.groupBy(dataset).agg(
        F.max_by("columns", "schema_version").alias("__old"), F.max("schema_version").alias("__version"))
    both = schema_diff(incoming.join(known, dataset, "left"), "__old", "columns")
    grew, shrank = F.size("added") > 0, F.size("removed") > 0
    change = F.when(F.col("__version").isNull(), "INITIAL").when(grew & shrank, "CHANGED") \
        .when(grew, "ADDED").when(shrank, "REMOVED").otherwise("NONE")
    bump = F.when(change.isin("INITIAL", "NONE"), 0).otherwise(1)
    empty = F.array().cast("array<string>")
    return both.select(
        dataset, (F.coalesce("__version", F.lit(1)) + bump).cast("int").alias("schema_version"), "columns",
        change.alias("change_type"), F.coalesce("added", empty).alias("added"),
        F.coalesce("removed", empty).alias("removed"))


def schema_history(history: DataFrame, dataset_name: str) -> DataFrame:
    """Recorded versions of one dataset, newest first."""
    return history.filter(F.col("dataset_name") == dataset_name).orderBy(F.col("schema_version").desc())


def registry_current(log: DataFrame, order_by: Sequence[str] = ("upload_timestamp",)) -> DataFrame:
    """Latest entry per dataset of the append-only registry."""
    rest = [c for c in log.columns if c != "dataset_name"]
    newest = log.groupBy("dataset_name").agg(F.max_by(F.struct(*rest), F.struct(*order_by)).alias("r"))
    return newest.select("dataset_name", *[F.col(f"r.`{c}`").alias(c) for c in rest])


def register(log: DataFrame, entries: DataFrame) -> DataFrame:
    """New registry rows: the version grows when the set of columns differs from the latest entry.

    File names and source type keep their last known value where an entry leaves them empty.
    """
    known = registry_current(log).select(
        "dataset_name", F.col("schema_version").alias("__v"),
        F.map_keys(F.from_json("schema_definition", "map<string,string>")).alias("__cols"),
        *[F.col(c).alias(f"__{c}") for c in ("original_filename", "source_file_name", "source_dataset_type")])
    cols = F.map_keys(F.from_json("schema_definition", "map<string,string>"))
    both = entries.drop("schema_version").join(known, "dataset_name", "left")
    same = F.array_sort(cols) == F.array_sort(F.col("__cols"))
    version = F.when(F.col("__v").isNull(), F.lit(1)).when(F.coalesce(same, F.lit(True)), F.col("__v")) \
        .otherwise(F.col("__v") + 1)
    kept = {c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"__{c}"))
            for c in ("original_filename", "source_file_name", "source_dataset_type")}
    return both.withColumns({"schema_version": version.cast("int"), **kept}).select(*log.columns)


def registry_row(spark: SparkSession, schema, **values) -> DataFrame:
    """One registry entry from keyword values; absent ones are NULL."""
    values.setdefault("upload_timestamp", datetime.now())
    values.setdefault("upload_user", "anonymous")
    return spark.createDataFrame([tuple(values.get(f) for f in schema.names)], schema)
