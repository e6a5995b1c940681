"""Ranked lexical search: accumulator-limited, term at a time, over shards of documents.

1. Index. One pass over the texts writes, for every document with terms, the numbers of the query terms
   in it and how often each occurs, packed, with the number of all its terms. Documents stay where they
   are read; nothing but this index is written, nothing is shuffled.
2. Statistics. The number of documents, of their terms, and of documents per query term are summed over
   the whole index.
3. Scoring. Each task turns its part of the index, a shard at a time, into postings by term and works
   off the terms of an item from the rarest on. Scores are kept in one accumulator per document. A term
   may open accumulators only while the most that it and the terms after it can add (their largest
   contributions in the shard) reaches the kth best score so far: that of the partial scores, or of the
   documents finished before. From then on, terms only add to the documents that have an accumulator,
   to the end, so their scores are exact. What is left out is below the kth score for certain.
4. The best k of each task are merged per item in two steps, so that no group holds more than a share
   of the tasks' rows.

Items are read in blocks of ``BLOCK_BYTES`` of text, the bound of what is broadcast; every block takes one
index of its own.

A term is a run of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased, known by a
64-bit hash. Weights use doubles, all else 64-bit integers. Null and empty texts have no terms: such a
document is not counted, such an item has no rows. A repeated document counts each time; a repeated item
(or item id) is ranked each. A null doc_id is ranked after others of the same score. Fewer matching documents than k
give fewer rows; empty tables none. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .words import Words, packed, slices

BLOCK_BYTES = 4 << 20
SHARD_BYTES = 8 << 20     # packed term numbers of one shard
SALTS = 256
_N, _L = -1, -2           # places of the document and term totals among the counts

GAPS = np.ones(256, bool)
for _first, _last in (("0", "9"), ("A", "Z"), ("a", "z")):
    GAPS[ord(_first):ord(_last) + 1] = False
GAPS[0x80:] = False


@dataclass
class Block:
    """Items with the numbers of their distinct terms; ``known`` are the hashes of all terms, ascending."""

    ids: list
    terms: list[np.ndarray]
    known: np.ndarray
    df: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    n_docs: int = 0
    n_terms: int = 0


def prepare(items: list[tuple]) -> Block:
    w = Words(pa.array([t for _, t in items], pa.string()), lower=True, gaps=GAPS)
    known, number = np.unique(w.hashes(), return_inverse=True)
    return Block([i for i, _ in items], [np.unique(number[w.of[i]:w.of[i + 1]]) for i in range(len(items))], known)


def item_blocks(items: DataFrame, item_id: str, text: str, limit: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """The items in blocks of about ``limit`` bytes, one item at least; one block on the driver at a time."""
    block, held = [], 0
    for row in items.select(F.col(item_id).cast("long"), F.col(text).cast("string")).toLocalIterator():
        size = len((row[1] or "").encode()) + 64
        if block and held + size > limit:
            yield block
            block, held = [], 0
        block.append((row[0], row[1]))
        held += size
    if block:
        yield block


def index(docs: DataFrame, block, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n (terms of the document), terms and tfs (packed 32-bit numbers and counts of query terms)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = block.value.known
        v = len(known)
        for part in slices(batches, "text"):
            w = Words(part.column("text"), lower=True, gaps=GAPS)
            hashes, doc = w.hashes(), np.repeat(np.arange(len(w.count)), w.count)
            at = np.minimum(np.searchsorted(known, hashes), max(v - 1, 0))
            same = np.flatnonzero(known[at] == hashes) if v else np.zeros(0, np.int64)
            pair, tf = np.unique(doc[same] * max(v, 1) + at[same], return_counts=True)
            of = np.searchsorted(pair, np.arange(len(w.count) + 1) * max(v, 1))
            out = pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(w.count, pa.int64()), packed((pair % max(v, 1)).astype(np.int32), of),
                 packed(tf.astype(np.int32), of)], names=["doc_id", "n", "terms", "tfs"])
            yield out.filter(pa.array(w.count > 0))

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")) \
        .mapInArrow(run, "doc_id long, n long, terms binary, tfs binary")


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The packed 32-bit numbers of a batch one after the other, and how many each row has."""
    wide = column.cast(pa.large_binary())
    _, where, data = wide.buffers()
    offs = np.frombuffer(where, np.int64)[wide.offset:wide.offset + len(wide) + 1]
    raw = np.frombuffer(data, np.uint8)[offs[0]:offs[-1]] if data is not None and len(wide) else np.zeros(0, np.uint8)
    return raw.view(np.int32), np.diff(offs) // 4


def weigh(postings: DataFrame, block: Block) -> None:
    """Fill in document counts and weights from the whole index: one row per term on the driver."""
    v = len(block.known)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(v + 2, np.int64)
        for batch in batches:
            total[:v] += np.bincount(_numbers(batch.column("terms"))[0], minlength=v)
            total[_N] += batch.num_rows
            total[_L] += int(batch.column("n").to_numpy().sum()) if batch.num_rows else 0
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["at", "value"])

    total = np.zeros(v + 2, np.int64)
    for row in postings.select("n", "terms").mapInArrow(count, "at long, value long") \
            .groupBy("at").agg(F.sum("value").alias("value")).collect():
        total[row["at"]] = row["value"]
    block.df, block.n_docs, block.n_terms = total[:v], int(total[_N]), int(total[_L])
    block.weight = np.array([floor(1000 * log((2 * block.n_docs + 2) / (2 * d + 1))) for d in block.df.tolist()], np.int64)


class Shard:
    """Postings of some documents by term: their places in the shard and what they add to a score."""

    def __init__(self, batch: pa.RecordBatch, block: Block):
        ids = batch.column("doc_id")
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        self.unnamed = ids.is_null().to_numpy(zero_copy_only=False)
        terms, counts = _numbers(batch.column("terms"))
        tf = _numbers(batch.column("tfs"))[0].astype(np.int64)
        n = batch.column("n").to_numpy().astype(np.int64)
        m = 10 + (90 * n * block.n_docs) // max(block.n_terms, 1)
        doc = np.repeat(np.arange(len(n)), counts)
        value = block.weight[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
        order = np.argsort(terms, kind="stable")
        self.doc, self.value = doc[order], value[order]
        self.of = np.searchsorted(terms[order], np.arange(len(block.known) + 1))
        full = np.flatnonzero(np.diff(self.of))
        self.most = np.zeros(len(block.known), np.int64)
        if len(full):
            self.most[full] = np.maximum.reduceat(self.value, self.of[full])

    def best(self, terms: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the documents that may be among the best k, given that k finished
        documents have ``least`` or more. ``terms`` are rarest first."""
        terms = terms[self.most[terms] > 0]
        rest = np.cumsum(self.most[terms][::-1])[::-1]
        score, opening = np.zeros(len(self.ids), np.int64), True
        for term, bound in zip(terms.tolist(), rest.tolist(), strict=True):
            low, high = self.of[term], self.of[term + 1]
            doc, value = self.doc[low:high], self.value[low:high]
            if opening:
                if len(score) > k and score.max() > bound:
                    least = max(least, int(np.partition(score, -k)[-k]))
                opening = bound >= least
            if not opening:
                open_ = score[doc] > 0
                doc, value = doc[open_], value[open_]
            score[doc] += value
        if len(score) > k:
            least = max(least, int(np.partition(score, -k)[-k]))
        at = np.flatnonzero(score >= max(least, 1))
        return at, score[at]


def rank(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", item_id: str = "item_id",
         text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``k`` highest-scoring documents of every item: item_id, rank (from 1), doc_id, score."""
    spark = docs.sparkSession
    schema = "item int, item_id long, doc_id long, score long"
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for rows in item_blocks(items, item_id, text, block_bytes):
        block = prepare(rows)
        if not len(block.known):
            continue
        postings = materialise(index(docs, spark.sparkContext.broadcast(block), doc_id, text), "search-index")
        weigh(postings, block)
        ready = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], ready=ready) -> Iterator[pa.RecordBatch]:
            block = ready.value
            rarest = [t[np.lexsort((t, block.df[t]))] for t in block.terms]
            kept = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))] * len(rarest)
            for part in slices(batches, "terms", SHARD_BYTES):
                shard = Shard(part, block)
                for i, terms in enumerate(rarest):
                    score, ids, unnamed = kept[i]
                    at, new = shard.best(terms, k, int(score[-1]) if len(score) == k else 0)
                    if not len(at):
                        continue
                    score, ids = np.r_[score, new], np.r_[ids, shard.ids[at]]
                    unnamed = np.r_[unnamed, shard.unnamed[at]]
                    order = np.lexsort((ids, unnamed, -score))[:k]
                    kept[i] = score[order], ids[order], unnamed[order]
            sizes = [len(s) for s, _, _ in kept]
            item = np.repeat(np.arange(len(kept)), sizes)
            score, ids, unnamed = (np.concatenate([x[c] for x in kept]) for c in range(3))
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int32()), pa.array([block.ids[i] for i in item.tolist()], pa.int64()),
                 pa.array(ids, pa.int64(), mask=unnamed), pa.array(score)], names=["item", "item_id", "doc_id", "score"])

        best = postings.mapInArrow(run, schema).withColumn("__salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
        order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        for keys in (["item", "__salt"], ["item"]):
            best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
        out = out.unionByName(best.select("item_id", "rank", "doc_id", "score"))
    return out
