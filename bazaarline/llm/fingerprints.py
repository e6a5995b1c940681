"""Document fingerprints: the k smallest shingle hashes of a text (a bottom-k sketch).

Two sketches give the resemblance and the containment of their texts and each the number of its
distinct shingles. The sketch of a union is the bottom k of the two sketches, so sketches of parts
merge to that of the whole. Shingles are five words, A-Z lower-cased; hashes keep 40 bits; a
fingerprint is the base64 form of the ascending hashes, 5 bytes each, and equal texts have equal
fingerprints. A text with fewer than k shingles has all of them, and its figures are exact.

Null and empty texts, and those without words, have the empty fingerprint "": alike to one another
(likeness 1), unlike any other (0). Very long texts cost one sort of their shingles.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import Words, shingles, slices, spans

K = 128
WORDS = 5
BITS = 40


def sketches(texts: pa.Array, k: int = K, words: int = WORDS) -> list[np.ndarray]:
    """The sketch of every text: at most k ascending 40-bit values."""
    values, of = shingles(Words(texts, lower=True), words)
    values = values >> np.uint64(64 - BITS)
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    new[of[:-1][of[:-1] < len(values)]] = True
    before = np.r_[0, np.cumsum(new)]
    values, of = values[new], before[of]
    size = np.minimum(np.diff(of), k)
    values = values[spans(size, of[:-1])]
    return np.split(values, np.cumsum(size)[:-1]) if len(size) else []


def to_text(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:].tobytes()).decode()


def from_text(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, BITS // 8)
    return np.pad(raw, ((0, 0), (3, 0))).view(">u8").ravel().astype(np.uint64)


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of both texts' shingles together."""
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimate of shared over all distinct shingles: the part of the union's sketch held by both."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate([a, b]))
    twice = both[1:] == both[:-1]
    first = np.r_[True, ~twice]          # the distinct values, in order
    shared = np.r_[twice, False][first]  # and which of them came twice
    return float(shared[:k].sum() / min(k, len(shared)))


def distinct_shingles(a: np.ndarray, k: int = K) -> float:
    """Estimate of the number of distinct shingles; exact below k."""
    return float(len(a)) if len(a) < k else (k - 1) * float(2**BITS) / float(a[k - 1] + np.uint64(1))


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimate of the part of a's shingles that b has too; 1 for an empty a."""
    if not len(a):
        return 1.0
    r = resemblance(a, b, k)
    shared = r / (1 + r) * (distinct_shingles(a, k) + distinct_shingles(b, k))
    return float(min(1.0, shared / distinct_shingles(a, k)))


def fingerprints(docs: DataFrame, text: str = "text", k: int = K) -> DataFrame:
    """All columns of ``docs`` other than ``text``, and ``fingerprint``. No shuffle."""
    others = [c for c in docs.columns if c not in (text, "fingerprint")]
    rows = docs.select(*[F.col(f"`{c}`") for c in others], F.col(text).alias("__text"))
    schema = docs.select(*[F.col(f"`{c}`") for c in others], F.lit("").alias("fingerprint")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text"):
            prints = pa.array([to_text(s) for s in sketches(batch.column("__text"), k)], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), prints], names=[*others, "fingerprint"])

    return rows.mapInArrow(run, schema)


def merge_fingerprints(prints: DataFrame, key: str, k: int = K) -> DataFrame:
    """One fingerprint per ``key``, of all its parts. Each task first merges what it holds of a key,
    so that the shuffle moves one sketch per key and task. Null fingerprints are empty ones."""
    kind = prints.select(key).schema[0].dataType.simpleString()

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([(g, _merged(p["fingerprint"], k)) for g, p in frame.groupby(key, dropna=False)],
                               columns=[key, "fingerprint"])

    def final(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({key: frame[key].iloc[:1], "fingerprint": [_merged(frame["fingerprint"], k)]})

    schema = f"`{key}` {kind}, fingerprint string"
    return prints.select(key, "fingerprint").mapInPandas(partial, schema).groupBy(key).applyInPandas(final, schema)


def _merged(parts: pd.Series, k: int) -> str:
    held = [from_text(x or "") for x in parts]
    return to_text(np.unique(np.concatenate(held))[:k])


# each document with an edited form of itself and with its neighbour ------------------------

EDITED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def edited_text(text: str, following: str) -> str:
    """The text with its last floor(n/4) code points replaced by the first as many of the next."""
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


def compare_edited(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """Fingerprints of every text and of its edited form, with the document after it in ascending
    order of ids (after the last: the first), and their likeness.

    Null ids come first; rows with one id are ordered by a hash of the text. Documents are dealt
    over ranges of ids; the first document of each range is copied to the end of the range before
    it, so every range is worked off as a stream of batches with one row of look-ahead.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf")))
    cuts = rows.where(F.col("doc_id").isNotNull()).approxQuantile(
        "doc_id", [i / ranges for i in range(1, ranges)], 0.2 / ranges)
    inf = float("inf")
    splits = sorted({-inf, inf, *cuts})
    dealt = rows.withColumn("__at", place).withColumn("tie", F.xxhash64("text"))
    if len(splits) > 2:
        dealt = Bucketizer(splits=splits, inputCol="__at", outputCol="__range").transform(dealt) \
            .withColumn("part", F.col("__range").cast("int")).drop("__range", "__at")
    else:
        dealt = dealt.withColumn("part", F.lit(0)).drop("__at")
    # one row per range, of at most as many ranges as shuffle partitions
    first = {r.part: r.head for r in dealt.groupBy("part").agg(
        F.min(F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id", "tie")).alias("head")).collect()}
    used = sorted(first)
    if not used:
        return docs.sparkSession.createDataFrame([], EDITED)
    heads = docs.sparkSession.createDataFrame(
        [(q, first[q].doc_id, first[q].tie, used[i - 1]) for i, q in enumerate(used)],
        "part int, first_id long, first_tie long, copy_to int")
    is_first = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("tie") == F.col("first_tie"))
    here = F.struct(F.col("part").alias("p"), F.lit(False).alias("copy"))
    there = F.struct(F.col("copy_to").alias("p"), F.lit(True).alias("copy"))
    spread = dealt.join(F.broadcast(heads), "part") \
        .withColumn("to", F.explode(F.when(is_first, F.array(here, there)).otherwise(F.array(here)))) \
        .select("doc_id", "text", "tie", "to.p", "to.copy")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        for batch in slices(batches):
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            n = batch.num_rows
            if n > 1:
                yield _compared(batch, k)
            held = batch.slice(n - 1)

    return spread.repartitionById(max(used) + 1, F.col("p")) \
        .sortWithinPartitions("p", "copy", F.col("doc_id").asc_nulls_first(), "tie").mapInArrow(run, EDITED)


def _compared(batch: pa.RecordBatch, k: int) -> pa.RecordBatch:
    """Results for all rows but the last one and but copies; row i is followed by row i + 1."""
    texts = [t or "" for t in batch.column("text").to_pylist()]
    edited = [edited_text(a, b) for a, b in zip(texts, texts[1:], strict=False)]
    own, other = sketches(batch.column("text"), k), sketches(pa.array(edited, pa.large_string()), k)
    keep = [i for i, copy in enumerate(batch.column("copy").to_pylist()[:-1]) if not copy]
    return pa.RecordBatch.from_arrays([
        batch.column("doc_id").take(pa.array(keep, pa.int64())),
        pa.array([len(texts[i]) for i in keep], pa.int64()),
        pa.array([hashlib.sha256(edited[i].encode()).hexdigest() for i in keep], pa.string()),
        pa.array([to_text(own[i]) for i in keep], pa.string()),
        pa.array([to_text(other[i]) for i in keep], pa.string()),
        pa.array([resemblance(own[i], other[i], k) for i in keep], pa.float64()),
        pa.array([resemblance(own[i], own[i + 1], k) for i in keep], pa.float64()),
    ], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
