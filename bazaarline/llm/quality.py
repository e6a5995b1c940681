"""Quality classifier: a regularised quadratic discriminant over statistics of the text.

Each class is a normal distribution over log-transformed document statistics. Its covariance is
shrunk towards the pooled one and towards a multiple of the unit matrix. The score is the
posterior of class 1, from the difference of log densities; Mahalanobis distances use Cholesky
factors computed once when the model is made.

The model is fitted on sums over all labelled training rows (counts, sums and cross products per
class, added up by Spark): nothing is sampled. Only the text is used: statistics are computed
without ids, sources, languages or labels.

Null and empty texts have all statistics at their floor and get a score like any other. Rows with a
null or repeated id are scored each; training joins labels by id, and null labels and ids take no
part. A class without training rows, or an empty table, gives a model that scores by the prior alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, DoubleType

from ..session import materialise
from .words import Words, mix, per_text, slices, windows

STATISTICS = ("words", "mean_word", "word_spread", "longest_word", "capitals", "all_caps", "digits", "marks", "plain_marks",
              "loud_marks", "bars", "beyond_ascii", "lines", "distinct", "repeats", "repeated_fives", "short_words",
              "capital_starts")
TO_POOLED, TO_UNIT = 0.3, 0.05
THRESHOLD = 0.3
SIEVE_BITS = 25            # of the table that tells which documents may have a label: 4 MB
SLICE = 1 << 20            # bytes of text worked on at once: statistics take some 30 times as much

_FLAGS = {
    "upper": list(range(0x41, 0x5B)), "lower": list(range(0x61, 0x7B)), "digit": list(range(0x30, 0x3A)),
    "plain": [ord(c) for c in ".,;:'\"()-?"], "loud": [ord("!")], "bar": [ord(c) for c in "|<>{}[]=_\\/"],
    "odd": [ord(c) for c in "#$%&*+@^`~"], "high": list(range(0x80, 0x100)), "line": [10],
}
_LUT = {}
for _name, _codes in _FLAGS.items():
    _LUT[_name] = np.zeros(256, np.int32)
    _LUT[_name][_codes] = 1


def _sums(flags: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return (total[high] - total[low]).astype(float)


def _distinct(keys: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Distinct keys per document."""
    order = np.argsort(mix(keys + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), kind="stable")
    keys, doc = keys[order], doc[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
    return np.bincount(doc[new], minlength=n).astype(float)


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of log-transformed statistics per text, in the order of ``STATISTICS``."""
    w = Words(texts)
    n, low, high = len(w.count), w.offs[:-1], w.offs[1:]
    of = {name: _sums(lut[w.raw], low, high) for name, lut in _LUT.items()}
    words, size = w.count.astype(float), np.maximum(high - low, 1).astype(float)
    doc = np.repeat(np.arange(n), w.count)
    length = (w.end - w.start).astype(float)
    each = np.maximum(words, 1)
    mean = np.bincount(doc, length, n) / each
    spread = np.sqrt(np.maximum(np.bincount(doc, length**2, n) / each - mean**2, 0))
    longest = np.zeros(n)
    np.maximum.at(longest, doc, length)
    upper = _LUT["upper"][w.raw]
    capitals = _sums(upper, w.start, w.end)
    letters = capitals + _sums(_LUT["lower"][w.raw], w.start, w.end)
    shout = np.bincount(doc[(capitals == letters) & (letters > 1)], minlength=n)
    starts = np.bincount(doc[upper[w.start] == 1], minlength=n) if len(doc) else np.zeros(n)
    hashes = w.hashes()
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    fives, at = windows(hashes, w.of, 5)
    fdoc = doc[at] if len(at) else np.zeros(0, np.int64)
    n_fives = np.bincount(fdoc, minlength=n).astype(float)
    again = (n_fives - _distinct(fives, fdoc, n)) / np.maximum(n_fives, 1)
    rate = lambda x, by: np.log(x / by + 1e-3)
    return np.column_stack([
        np.log1p(words), np.log1p(mean), np.log1p(spread), np.log1p(longest),
        rate(of["upper"], np.maximum(of["upper"] + of["lower"], 1)), rate(shout, each), rate(of["digit"], size),
        rate(of["odd"], size), rate(of["plain"], size), rate(of["loud"], size), rate(of["bar"], size), rate(of["high"], size),
        rate(of["line"], each), rate(_distinct(hashes, doc, n), each), rate(np.bincount(doc[same], minlength=n), each),
        rate(again, 1.0), rate(np.bincount(doc[length <= 2], minlength=n), each), rate(starts, each)])


def with_statistics(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), sieve: Broadcast | None = None,
                    doc_id: str = "doc_id") -> DataFrame:
    """``keep`` columns and ``stats`` (array of doubles) of every row, or of those that a ``sieve`` of ids lets through. No shuffle."""
    schema = docs.select(*keep).schema.add("stats", ArrayType(DoubleType()))

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if sieve is not None:
                at = batch.column("__place").to_numpy()
                batch = batch.filter(pa.array((sieve.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)))
            yield batch

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(wanted(batches), "__text", SLICE):
            got = statistics(batch.column("__text"))
            width = got.shape[1]
            stats = pa.ListArray.from_arrays(pa.array(np.arange(0, got.size + 1, width), pa.int32()), pa.array(got.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), stats], names=[*keep, "stats"])

    place = [] if sieve is None else [_place(F.col(doc_id)).alias("__place")]
    return docs.select(*keep, F.col(text).alias("__text"), *place).mapInArrow(run, schema)


@dataclass
class Discriminant:
    """Per class: prior, mean and inverse Cholesky factor of the shrunk covariance, inverted once when fitted."""

    prior: np.ndarray
    mean: np.ndarray
    inverse: np.ndarray
    logdet: np.ndarray
    known: bool = True

    def score(self, x: np.ndarray) -> np.ndarray:
        """Posterior of class 1."""
        if not self.known:
            return np.full(len(x), self.prior[1])
        logs = []
        for c in (0, 1):
            z = self.inverse[c] @ (x - self.mean[c]).T
            logs.append(np.log(self.prior[c]) - 0.5 * (z * z).sum(axis=0) - self.logdet[c])
        return 1.0 / (1.0 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def fit(labelled: DataFrame, label: str = "label", to_pooled: float = TO_POOLED, to_unit: float = TO_UNIT) -> Discriminant:
    """Fit on all rows with ``stats`` and a label 0 or 1. What reaches the driver is one number per
    class, statistic and pair of statistics."""
    d = len(STATISTICS)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.asarray(batch.column("stats").flatten(), float).reshape(-1, d)
            y = batch.column("label").to_numpy()
            for c in (0, 1):
                xc = x[y == c]
                sums[c] += np.r_[len(xc), xc.sum(axis=0), (xc.T @ xc).ravel()]
        width = sums.shape[1]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat([0, 1], width), pa.int32()),
                                          pa.array(np.tile(np.arange(width), 2), pa.int32()), pa.array(sums.ravel())],
                                         names=["class", "at", "value"])

    rows = labelled.select("stats", F.col(label).cast("int").alias("label")).where(F.col("label").isin(0, 1)) \
        .mapInArrow(partial, "class int, at int, value double").groupBy("class", "at").agg(F.sum("value").alias("value")).collect()
    sums = np.zeros((2, 1 + d + d * d))
    for r in rows:
        sums[r["class"], r["at"]] = r["value"]
    count = sums[:, 0]
    prior = (count + 1) / (count.sum() + 2)
    if (count < 2).any():
        return Discriminant(prior, np.zeros((2, d)), np.zeros((2, d, d)), np.zeros(2), known=False)
    mean = sums[:, 1:1 + d] / count[:, None]
    cov = np.stack([sums[c, 1 + d:].reshape(d, d) / count[c] - np.outer(mean[c], mean[c]) for c in (0, 1)])
    pooled = np.tensordot(count / count.sum(), cov, 1)
    shrunk = [(1 - to_pooled) * cov[c] + to_pooled * pooled for c in (0, 1)]
    shrunk = [(1 - to_unit) * s + to_unit * max(np.trace(s) / d, 1e-9) * np.eye(d) for s in shrunk]
    factor = np.stack([np.linalg.cholesky(s) for s in shrunk])
    return Discriminant(prior, mean, np.linalg.inv(factor), np.log(np.diagonal(factor, axis1=1, axis2=2)).sum(axis=1))


def score_rows(stats: DataFrame, model: Discriminant) -> DataFrame:
    """``stats`` rows with ``score`` (0 to 1, higher: class 1 likelier) in the place of the statistics."""
    d = len(STATISTICS)
    others = [c for c in stats.columns if c != "stats"]
    schema = stats.select(*others, F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column("stats").flatten(), float).reshape(-1, d)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(model.score(x))],
                                             names=[*others, "score"])

    return stats.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Whether the row belongs to the fold that is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """Fit on the labelled rows outside the held-out fold and score all: doc_id, held_out, score, predicted.

    Texts are read once; their statistics, some 150 bytes a document, are stored and joined with the labels.
    """
    stats = materialise(with_statistics(docs), "quality-stats")
    named = labels.select("doc_id", F.col(label).alias("label")).where(F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
    model = fit(stats.join(named, "doc_id").select("stats", "label"))
    return score_rows(stats, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def _place(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(1 << SIEVE_BITS))


def _sieve(named: DataFrame) -> Broadcast:
    """A table of 2**SIEVE_BITS bits, whatever the number of ids, with those of the places of all ids of ``named`` set.
    It lets all of them through, and others whose hash meets theirs, which a join rules out."""
    at = _place(F.col("doc_id")) + 1
    bits = named.groupBy(F.bitmap_bucket_number(at).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    known = np.zeros(1 << SIEVE_BITS - 3, np.uint8)
    for row in bits.collect():
        known[(row["part"] - 1) * len(row["bits"]):row["part"] * len(row["bits"])] = np.frombuffer(row["bits"], np.uint8)
    return named.sparkSession.sparkContext.broadcast(known)


def accepted(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = THRESHOLD,
             doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score of ``threshold`` or more, with all their columns.

    Fitted like ``score_documents`` on the labelled rows of ``docs``; only their texts (and those of a few others, see
    ``_sieve``) are worked on for it. All rows are then scored where they are read: no text is shuffled, and
    none comes back from Python.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    named = labels.select("doc_id", F.col(label).alias("label")).where(F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
    model = fit(with_statistics(rows, sieve=_sieve(named)).join(named, "doc_id").select("stats", "label"))

    @arrow_udf(DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        got = per_text(lambda part: model.score(statistics(part)), texts, SLICE)
        return pa.array(np.concatenate(got) if got else np.zeros(0))

    return docs.where(score(F.col(text)) >= threshold)
