"""Data-quality suites: all rules of a dataset, key rules too, in one scan and one grouped count."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

from .. import schemas
from ..functions.numbers import pct_of, to_number, with_two_places


class QualityError(ValueError):
    """Raised by the gate when a critical expectation fails."""


@dataclass(frozen=True)
class NotNull:
    col: str


@dataclass(frozen=True)
class Unique:
    """No key twice; rows beyond the first of a key are duplicates, missing keys count as one key."""
    cols: tuple[str, ...]
    label: str | None = None


@dataclass(frozen=True)
class Between:
    """Both ends included; missing values pass, text that is no number does not."""
    col: str
    lo: float
    hi: float


@dataclass(frozen=True)
class NullPct:
    col: str
    max_pct: float


@dataclass(frozen=True)
class DupPct:
    cols: tuple[str, ...]
    max_pct: float
    label: str | None = None


@dataclass(frozen=True)
class HasColumns:
    cols: tuple[str, ...]


@dataclass(frozen=True)
class HasColumn:
    col: str


Rule = NotNull | Unique | Between | NullPct | DupPct | HasColumns | HasColumn


def _missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN where the type has one."""
    col = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (FloatType, DoubleType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


_WORD_BITS = 62


def one_pass(df: DataFrame, flags: Mapping[str, Column], keyed: Sequence[Sequence[str]] = ()) -> DataFrame:
    """One row ``rows``, the rows each flag holds for, and ``dup:<columns>``, the rows beyond the first of each key.

    The dataset is read once, whatever the number of rules: a row is counted once under the set of flags it raises (a
    bit each) and once under each key. Tasks combine equal entries before the one shuffle, so a hot key or a common
    set of flags is one entry a task. Keys are compared in full; missing keys count as one key.
    """
    names = list(flags)
    sets = list(dict.fromkeys(tuple(k) for k in keyed))
    if not sets:
        return df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in flags.items()])
    words = []
    for at in range(0, max(len(names), 1), _WORD_BITS):
        bits = [F.when(flags[n], F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, n in enumerate(names[at:at + _WORD_BITS])]
        words.append(reduce(lambda a, b: a.bitwiseOR(b), bits, F.lit(0).cast("bigint")))
    columns = list(dict.fromkeys(c for k in sets for c in k))
    word_names, key_names = [f"__w{i}" for i in range(len(words))], {c: f"__k{i}" for i, c in enumerate(columns)}
    narrow = df.select(*[w.alias(n) for w, n in zip(words, word_names)], *[F.col(f"`{c}`").alias(n) for c, n in key_names.items()])
    grouped = [*word_names, *key_names.values()]

    def within(members: Sequence[str]) -> Column:
        """Whether an entry belongs to this set: Spark numbers a set by the columns it leaves out, the first one highest."""
        left_out = sum(1 << (len(grouped) - 1 - i) for i, c in enumerate(grouped) if c not in members)
        return F.col("__set") == left_out

    sets_of_columns = [word_names, *[[key_names[c] for c in k] for k in sets]]
    entries = narrow.groupingSets([[F.col(c) for c in s] for s in sets_of_columns], *[F.col(c) for c in grouped]).agg(
        F.grouping_id().alias("__set"), F.count(F.lit(1)).alias("__n"))

    def total(chosen: Column, n: Column) -> Column:
        return F.coalesce(F.sum(F.when(chosen, n)), F.lit(0)).cast("bigint")

    raised = [within(word_names) & (F.col(word_names[i // _WORD_BITS]).bitwiseAND(F.lit(1 << i % _WORD_BITS)) != 0) for i in range(len(names))]
    return entries.agg(
        total(within(word_names), F.col("__n")).alias("rows"), *[total(c, F.col("__n")).alias(n) for n, c in zip(names, raised)],
        *[total(within(m), F.col("__n") - 1).alias("dup:" + ",".join(k)) for k, m in zip(sets, sets_of_columns[1:])])


def _rule_cols(rule: Rule) -> tuple[str, ...]:
    if isinstance(rule, (Unique, DupPct)):
        return rule.cols
    return () if isinstance(rule, (HasColumns, HasColumn)) else (rule.col,)


def _title(rule: Rule) -> str:
    if isinstance(rule, NotNull):
        return f"{rule.col} not null"
    if isinstance(rule, Unique):
        return f"{rule.label or '_'.join(rule.cols)} unique"
    if isinstance(rule, Between):
        return f"{rule.col} between {rule.lo} and {rule.hi}"
    if isinstance(rule, NullPct):
        return f"{rule.col} null percent <= {rule.max_pct * 100}%"
    if isinstance(rule, DupPct):
        return f"{rule.label or '_'.join(rule.cols)} duplicate percent <= {rule.max_pct * 100}%"
    return "schema matches expected columns" if isinstance(rule, HasColumns) else f"{rule.col} exists"


def run_suite(df: DataFrame, dataset: str, rules: Sequence[Rule]) -> DataFrame:
    """Results ``(dataset, expectation, passed, details)`` of all rules over one dataset.

    Rules on columns the dataset lacks fail with a note instead of stopping the suite.
    """
    flags: dict[str, Column] = {}
    keyed: list[tuple[str, ...]] = []
    for rule in rules:
        cols = _rule_cols(rule)
        if any(c not in df.columns for c in cols):
            continue
        if isinstance(rule, (NotNull, NullPct)):
            flags[f"null:{rule.col}"] = _missing(df, rule.col)
        elif isinstance(rule, Between):
            dtype = df.schema[rule.col].dataType
            number = to_number(F.col(f"`{rule.col}`"), dtype)
            outside = (number < rule.lo) | (number > rule.hi)
            if not isinstance(dtype, NumericType):
                outside = outside | (number.isNull() & ~_missing(df, rule.col))
            flags[f"range:{rule.col}:{rule.lo}:{rule.hi}"] = outside
        elif isinstance(rule, (Unique, DupPct)):
            keyed.append(cols)
    stats = one_pass(df, flags, keyed).withColumnRenamed("rows", "__rows")

    def n(name: str) -> Column:
        return F.col(f"`{name}`")

    none, zero = F.lit(None).cast("string"), F.lit(0).cast("bigint")
    out = []
    for rule in rules:
        missing = [c for c in _rule_cols(rule) if c not in df.columns]
        found, template, note = zero, none, none
        if missing:
            passed, note = F.lit(False), F.lit(f"Column missing: {missing}")
        elif isinstance(rule, NotNull):
            found, template = n(f"null:{rule.col}"), F.lit("Found {n} nulls")
            passed = found == 0
        elif isinstance(rule, Unique):
            found, template = n("dup:" + ",".join(rule.cols)), F.lit("Found {n} duplicates")
            passed = found == 0
        elif isinstance(rule, Between):
            found = n(f"range:{rule.col}:{rule.lo}:{rule.hi}")
            template = F.lit("Found {n} out of range values")
            passed = found == 0
        elif isinstance(rule, NullPct):
            found, template = n(f"null:{rule.col}"), F.lit("Actual null percent: {pct}% ({n} nulls)")
            passed = pct_of(found, n("__rows")) <= F.lit(float(rule.max_pct))
        elif isinstance(rule, DupPct):
            found = n("dup:" + ",".join(rule.cols))
            template = F.lit("Actual duplicate percent: {pct}% ({n} duplicates)")
            passed = pct_of(found, n("__rows")) <= F.lit(float(rule.max_pct))
        elif isinstance(rule, HasColumns):
            absent = [c for c in rule.cols if c not in df.columns]
            passed, note = F.lit(not absent), F.lit(f"Missing columns: {absent}" if absent else "")
        else:
            present = rule.col in df.columns
            passed, note = F.lit(present), F.lit("" if present else "Column missing")
        out.append(F.struct(F.lit(_title(rule)).alias("expectation"), passed.alias("passed"), found.alias("found"),
                            template.alias("template"), note.alias("note")))
    # one short projection over the few result rows turns the counts into text
    results = stats.select("__rows", F.inline(F.array(*out))).withColumn("__pct", pct_of(F.col("found"), F.col("__rows")) * 100)
    results = with_two_places(results, "__pct", "__text")
    text = F.replace(F.col("template"), F.lit("{n}"), F.col("found").cast("string"))
    details = F.coalesce("note", F.replace(text, F.lit("{pct}"), F.col("__text")))
    return results.select(F.lit(dataset).alias("dataset"), "expectation", "passed", details.alias("details"))


# Limits of the standard suites.
MAX_NULL_PCT = 0.05
RANGES = {
    "products": Between("unit_price", 0, 10000),
    "erp_orders": Between("quantity", 0, 1000),
    "pos_transactions": Between("sale_amount", 0, 100000),
    "inventory": Between("stock_level", 0, 100000),
}
ID_COLUMNS = {"customer_id", "product_id", "order_id", "transaction_id", "store_id"}
DATASETS = ["crm_customers", "products", "erp_orders", "pos_transactions", "inventory"]


def medallion_rules(dataset: str, columns: Sequence[str] | None = None) -> list[Rule]:
    """Schema, key, null-share and range rules of a conformed feed."""
    expected = schemas.layout(dataset).names
    keys = schemas.SOURCE_KEYS[dataset]
    rules: list[Rule] = [HasColumns(tuple(expected))]
    rules += [NotNull(k) for k in keys]
    rules.append(Unique(tuple(keys), "composite_key" if len(keys) > 1 else None))
    rules += [NullPct(c, MAX_NULL_PCT) for c in (columns or expected) if c not in ID_COLUMNS]
    if dataset in RANGES:
        rules.append(RANGES[dataset])
    return rules


def short_rules(dataset: str) -> list[Rule]:
    """Key rules only, as used by the replay run."""
    keys = schemas.SOURCE_KEYS[dataset]
    return [NotNull(k) for k in keys] + ([Unique(tuple(keys))] if len(keys) == 1 else [])


def run_suites(frames: dict[str, DataFrame], short: bool = False) -> DataFrame:
    """Results of the standard suite of every given feed."""
    parts = []
    for name, df in frames.items():
        cols = [c for c in df.columns if not c.startswith("_") and c != "run_id"]
        rules = short_rules(name) if short else medallion_rules(name, cols)
        parts.append(run_suite(df, name, rules))
    return reduce(lambda a, b: a.unionByName(b), parts)


def bad_ids(frames: dict[str, DataFrame]) -> DataFrame:
    """A failed result for every id column of text with values that are no numbers; else no rows."""
    parts = []
    for name, df in frames.items():
        ids = [c for c in df.columns if c in ID_COLUMNS and df.schema[c].dataType.typeName() == "string"]
        if not ids:
            continue
        bad = [F.struct(F.lit(f"{c} is a number").alias("expectation"),
                        F.count_if(F.col(c).isNotNull() & to_number(F.col(c)).isNull()).alias("found")) for c in ids]
        parts.append(df.agg(F.array(*bad).alias("r")).select(F.lit(name).alias("dataset"), F.inline("r")).where("found > 0")
                     .select("dataset", "expectation", F.lit(False).alias("passed"),
                             F.format_string("Found %d values that are no numbers", "found").alias("details")))
    schema = "dataset string, expectation string, passed boolean, details string"
    return reduce(lambda a, b: a.unionByName(b), parts) if parts else next(iter(frames.values())).sparkSession.createDataFrame([], schema)


def gate(results: DataFrame) -> None:
    """Stop the run if an expectation failed; call it after the results are logged."""
    failed = results.filter(~F.col("passed")).collect()
    if failed:
        notes = [f"[{r['dataset']}] {r['expectation']}: {r['details']}" for r in failed]
        raise QualityError(f"Data quality task failed. Critical issues: {notes}")
