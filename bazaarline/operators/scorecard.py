"""Quality scorecard of a dataset that claims to be of a known type."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_ts
from ..functions.numbers import percent_score, to_number
from . import templates
from .quality import _missing, one_pass

_DEDUCTION = "struct<category:string,points:int,reason:string>"


def scorecard(df: DataFrame, dataset_type: str, mapping: Mapping[str, str | None]) -> DataFrame:
    """One row: four 0..100 scores, deductions, quality score and the weighted overall score.

    All counters and the key duplicates come from one scan (``one_pass``). An unknown type or an empty mapping scores 100 throughout.
    """
    spark = df.sparkSession
    if dataset_type not in templates.TEMPLATES or not mapping:
        return spark.range(1).select(
            *[F.lit(100).alias(c) for c in ("completeness", "validity", "uniqueness", "consistency")],
            F.lit(100.0).alias("quality_score"), F.lit(100.0).alias("overall_score"),
            F.from_json(F.lit("[]"), f"array<{_DEDUCTION}>").alias("deductions"))

    kinds = {f: kind for f, (kind, _) in templates.TEMPLATES[dataset_type].items()}
    mapped = {f: c for f, c in mapping.items() if c}
    key = templates.KEYS[dataset_type]
    single = key[0] if len(key) == 1 else None

    counters: dict[str, Column] = {}
    for field, col in mapped.items():
        value, dtype = F.col(f"`{col}`"), df.schema[col].dataType
        missing = _missing(df, col)
        counters[f"null_{field}"] = missing
        if kinds.get(field) == "date":
            counters[f"bad_{field}"] = ~missing & parse_ts(value, dtype=dtype).isNull()
        elif kinds.get(field) == "numeric" and field != single:
            counters[f"bad_{field}"] = ~missing & to_number(value, dtype).isNull()
        if field in templates.NON_NEGATIVE:
            counters[f"neg_{field}"] = to_number(value, dtype) < 0
    keyed = all(mapped.get(k) for k in key)
    found = [mapped[k] for k in key] if keyed else []
    stats = one_pass(df, counters, [found] if keyed else [])
    if keyed:
        stats = stats.withColumnRenamed("dup:" + ",".join(found), "dups")

    rows = F.col("rows")

    def total(prefix: str) -> Column:
        return sum((F.col(c) for c in counters if c.startswith(prefix)), F.lit(0).cast("bigint"))

    def deduct(found: Column, category: str, points: int, text: str) -> Column:
        return F.when(found > 0, F.struct(F.lit(category).alias("category"), F.lit(points).alias("points"),
                                          F.format_string(text, found).alias("reason")))

    notes: list[Column] = []
    if single and mapped.get(single):
        notes.append(deduct(F.col(f"null_{single}"), "Completeness", 15,
                            f"Missing primary key values: %d null record(s) in mapped column '{mapped[single]}'."))
    notes += [deduct(F.col(f"null_{f}"), "Completeness", 3, f"Missing values: %d nulls found in '{c}'.")
              for f, c in mapped.items() if f != single]
    if keyed and single:
        notes.append(deduct(F.col("dups"), "Uniqueness", 12,
                            f"Duplicate primary keys: %d duplicate IDs found in '{mapped[single]}'."))
    elif keyed:
        notes.append(deduct(F.col("dups"), "Uniqueness", 10,
                            "Duplicate inventory composite keys: %d matching store-product duplicates found."))
    for field, col in mapped.items():
        if f"bad_{field}" in counters and kinds[field] == "date":
            notes.append(deduct(F.col(f"bad_{field}"), "Validity", 8,
                                f"Unparseable date formats: %d rows could not be parsed as date in '{col}'."))
        elif f"bad_{field}" in counters:
            notes.append(deduct(F.col(f"bad_{field}"), "Validity", 5,
                                f"Invalid numeric formatting: %d values could not be parsed as numeric in '{col}'."))
    notes += [deduct(F.col(f"neg_{f}"), "Consistency", 10,
                     f"Negative business bounds violated: %d negative value(s) in field '{c}'.")
              for f, c in mapped.items() if f"neg_{f}" in counters]
    deductions = F.filter(F.array(*notes), lambda d: d.isNotNull()) if notes \
        else F.from_json(F.lit("[]"), f"array<{_DEDUCTION}>")

    checked = sum(1 for c in counters if c.startswith("bad_"))
    scores = stats.select(
        percent_score(total("null_"), rows * len(mapped)).alias("completeness"),
        F.greatest(F.lit(0), percent_score(total("bad_"), rows * checked)).alias("validity"),
        (F.when(F.col("dups") > 0, F.greatest(F.lit(0), percent_score(F.col("dups"), rows)))
         .otherwise(F.lit(100)) if keyed else F.lit(100)).alias("uniqueness"),
        F.greatest(F.lit(0), percent_score(total("neg_"), rows)).alias("consistency"),
        deductions.alias("deductions"))
    points = F.aggregate("deductions", F.lit(0), lambda acc, d: acc + d["points"])
    overall = (F.col("completeness") * 0.3 + F.col("validity") * 0.3
               + F.col("uniqueness") * 0.2 + F.col("consistency") * 0.2)
    return scores.select(
        "completeness", "validity", "uniqueness", "consistency",
        F.greatest(F.lit(0.0), (F.lit(100) - points).cast("double")).alias("quality_score"),
        F.bround(overall, 1).alias("overall_score"), "deductions")
