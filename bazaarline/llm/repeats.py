"""Substring dedup: passages of 50 words or more that also occur in a document with a smaller id.

1. Anchors. Every document indexes its non-overlapping blocks of 25 words and probes with
   every rolling window of 25 words. Any 50 words contain a whole block, so each repeated window has
   at least one anchor that a block and a probe of two documents share. Probes travel as packed
   arrays per bucket of hashes (4 bytes each, and the bucket); a chance hit is only one more candidate.
2. Extension. Around the anchors hit, and only there, the 50-word windows are hashed (64 bits) and
   the smallest document with each is found. A window whose smallest document is another one is removed;
   consecutive windows make up the maximal repeats.
3. What a window covers is cut from the text: ``kept`` words, and ``spans`` of removed words.

Within a batch, a hash held by several documents is settled on the spot and only one of them
travels on. So a passage held by a third of all documents reaches its bucket once per batch.

Windows are judged on the input: they are not changed by what has been removed. Rows: null or empty
texts have no words. A row with a null id is kept whole and takes no part. Rows that repeat an id
are one document: they never remove each other's words. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .words import Words, mix, packed, slices, windows

LENGTH = 50
BLOCK = 25            # LENGTH >= 2 * BLOCK - 1, so every window holds a whole block
BATCH = 16 << 20
_U = np.uint64


def _anchor_keys(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and 32 further bits of a hash."""
    return (hashes % _U(buckets)).astype(np.int64), (mix(hashes) >> _U(32)).astype(np.uint32)


def _dealt(bucket: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, list[pa.Array]]:
    """Rows sorted by bucket, packed to one binary value per bucket and column."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    used, first = np.unique(bucket, return_index=True)
    bounds = np.r_[first, len(bucket)]
    return used, [packed(c[order], bounds) for c in columns]


def _groups(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ascending values: the number of the run each belongs to, and where runs begin."""
    new = np.r_[True, values[1:] != values[:-1]] if len(values) else np.zeros(0, bool)
    return np.cumsum(new) - 1, np.flatnonzero(new)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Slices in lists of about ``BATCH`` bytes of text."""
    held, size = [], 0
    for part in slices(batches):
        held.append(part)
        size += part.nbytes
        if size >= BATCH:
            yield held
            held, size = [], 0
    if held:
        yield held


def _own(kind: np.ndarray, doc: np.ndarray, flag: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (hash, document) in that order; the flag is set if it is for one of them."""
    order = np.lexsort((doc, kind))
    kind, doc, flag = kind[order], doc[order], flag[order]
    new = np.r_[True, (kind[1:] != kind[:-1]) | (doc[1:] != doc[:-1])] if len(kind) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return kind[first], doc[first], (np.logical_or.reduceat(flag, first) if len(first) else flag)


_ENTRIES = "bucket int, keys binary, docs binary, flags binary"


def _row(bucket, keys, docs, flags) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), keys, docs, flags],
                                      names=["bucket", "keys", "docs", "flags"])


def anchors(docs: DataFrame, buckets: int, length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """Packed probes per bucket and batch; the flag marks a block. What is shared inside a batch comes
    as well under bucket -1 - b, as hits of bucket b that need no further probing."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in _chunks(batches):
            kinds, owners, blocks = [], [], []
            for part in parts:
                w = Words(part.column("text"))
                of, ids = w.of, part.column("doc_id").to_numpy()
                got, at = windows(w.hashes(), of, block)
                d = np.searchsorted(of, at, "right") - 1
                long = w.count[d] >= length
                kinds.append(got[long])
                owners.append(ids[d[long]])
                blocks.append((at - of[d])[long] % block == 0)
            kind, doc, is_block = _own(*map(np.concatenate, (kinds, owners, blocks)))
            run_of, first = _groups(kind)
            size = np.diff(np.r_[first, len(kind)])
            shared = size[run_of] > 1
            bucket, rest = _anchor_keys(kind, buckets)
            if shared.any():
                by = np.argsort(doc[shared], kind="stable")
                hit, (k, o, f) = _dealt(bucket[shared][by], rest[shared][by], doc[shared][by], is_block[shared][by])
                yield _row(-1 - hit, k, o, f)
            if len(first):
                any_block = np.logical_or.reduceat(is_block, first)
                by = first[np.argsort(doc[first], kind="stable")]
                used, (k, o, f) = _dealt(bucket[by], rest[by], doc[by], any_block[run_of[by]])
                yield _row(used, k, o, f)

    return docs.mapInArrow(run, _ENTRIES)


def _unpacked(batches: Iterator[pa.RecordBatch], kind) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """All entries of each bucket of a task."""
    held: dict[int, list] = {}
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "keys", "docs", "flags")), strict=True):
            held.setdefault(row[0], []).append(row[1:])
    for bucket, rows in held.items():
        yield (bucket, *(np.concatenate([np.frombuffer(r[i], k) for r in rows]) for i, k in enumerate((kind, np.int64, np.bool_))))


def _addressed(doc: np.ndarray, keys: np.ndarray, lanes: int) -> pa.RecordBatch:
    """What is found for documents, packed by the lane that gathers each document."""
    lane = (mix(doc.view(_U)) % _U(lanes)).astype(np.int64)
    by = np.argsort(doc, kind="stable")
    used, (k, o) = _dealt(lane[by], keys[by].astype(_U), doc[by])
    return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), k, o], names=["lane", "keys", "docs"])


_HITS = "lane int, keys binary, docs binary"


def gathered(hits: DataFrame, lanes: int, name: str) -> DataFrame:
    """One row (doc_id, ``name``: keys) per document that has any."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(k, o) for batch in batches for k, o in
                zip(batch.column("keys").to_pylist(), batch.column("docs").to_pylist(), strict=True)]
        if held:
            keys, doc = (np.concatenate([np.frombuffer(r[i], kind) for r in held]) for i, kind in enumerate((_U, np.int64)))
            order = np.argsort(doc, kind="stable")
            keys, doc = keys[order], doc[order]
            _, first = _groups(doc)
            bounds = np.r_[first, len(doc)]
            for at in range(0, len(first), 2_000):
                upto = min(at + 2_000, len(first))
                part = bounds[at:upto + 1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc[first[at:upto]]), packed(keys[part[0]:part[-1]], part - part[0])], names=["doc_id", name])

    return hits.repartitionById(lanes, F.col("lane")).mapInArrow(run, f"doc_id long, {name} binary")


def anchor_hits(entries: DataFrame, buckets: int) -> DataFrame:
    """(doc_id, hits): the anchors of each document that a block and a probe of two documents share."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, key, doc, flag in _unpacked(batches, np.uint32):
            if bucket < 0:
                yield _addressed(doc, key.astype(_U) | (_U(-1 - bucket) << _U(32)), buckets)
                continue
            order = np.lexsort((doc, key))
            key, doc, flag = key[order], doc[order], flag[order]
            run_of, first = _groups(key)
            last = np.r_[first[1:], len(key)] - 1
            shared = (doc[first] != doc[last]) & np.logical_or.reduceat(flag, first)
            keep = shared[run_of]
            if keep.any():
                yield _addressed(doc[keep], key[keep].astype(_U) | (_U(bucket) << _U(32)), buckets)

    to = F.when(F.col("bucket") < 0, -1 - F.col("bucket")).otherwise(F.col("bucket"))
    return gathered(entries.repartitionById(buckets, to).mapInArrow(run, _HITS), buckets, "hits")


def candidates(docs: DataFrame, hits: DataFrame, buckets: int, length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """Stored: doc_id, n_words and sha256 of the words of every row, and for rows with a hit the text and
    ``starts``, the first words of the windows that hold an anchor hit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            w = Words(part.column("text"))
            marks = part.column("hits").to_pylist()
            n = part.num_rows
            hit = np.array([m is not None for m in marks], bool)
            starts: list[bytes | None] = [None] * n
            if hit.any():
                got, at = windows(w.hashes(), w.of, block)
                bucket, rest = _anchor_keys(got, buckets)
                full = (bucket.astype(_U) << _U(32)) | rest
                low = np.searchsorted(at, w.of)
                for d in np.flatnonzero(hit):
                    keys = np.frombuffer(marks[d], _U)
                    own = slice(low[d], low[d + 1])
                    where = at[own][np.isin(full[own], keys)] - w.of[d]
                    count = int(w.count[d])
                    cover = np.zeros(count + 2, np.int32)  # windows that hold the anchor begin this far before it
                    np.add.at(cover, np.maximum(where - (length - block), 0), 1)
                    np.add.at(cover, where + 1, -1)
                    first = np.flatnonzero(np.cumsum(cover)[:max(0, count - length + 1)] > 0)
                    if len(first):
                        starts[d] = first.astype(np.uint32).tobytes()
            texts = part.column("text").to_pylist()
            sums = [hashlib.sha256(b" ".join((t or "").encode().split())).hexdigest() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(w.count.astype(np.int64)), pa.array(sums, pa.string()),
                 pa.array([t if s is not None else None for t, s in zip(texts, starts, strict=True)], pa.string()),
                 pa.array(starts, pa.binary())], names=["doc_id", "n_words", "sha256", "text", "starts"])

    return materialise(docs.join(hits, "doc_id", "left").select("doc_id", "text", "hits").mapInArrow(
        run, "doc_id long, n_words long, sha256 string, text string, starts binary"), "repeat-candidates")


def repeated_windows(rows: DataFrame, buckets: int, length: int = LENGTH) -> DataFrame:
    """(doc_id, gone): hashes of the windows of each document that a smaller document has too."""
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in _chunks(batches):
            kinds, owners = [], []
            for part in parts:
                w = Words(part.column("text"))
                got, at = windows(w.hashes(), w.of, length)
                low = np.searchsorted(at, w.of)
                firsts = [np.frombuffer(s, np.uint32).astype(np.int64) for s in part.column("starts").to_pylist()]
                chosen = np.concatenate([low[d] + f for d, f in enumerate(firsts)])
                kinds.append(got[chosen])
                owners.append(np.repeat(part.column("doc_id").to_numpy(), [len(f) for f in firsts]))
            kind, doc = np.concatenate(kinds), np.concatenate(owners)
            kind, doc, _ = _own(kind, doc, np.zeros(len(kind), bool))
            run_of, first = _groups(kind)
            later = np.ones(len(kind), bool)
            later[first] = False
            bucket = (kind % _U(buckets)).astype(np.int64)
            if later.any():
                by = np.flatnonzero(later)[np.argsort(doc[later], kind="stable")]
                hit, (k, o, f) = _dealt(bucket[by], kind[by], doc[by], later[by])
                yield _row(-1 - hit, k, o, f)
            if len(first):
                by = first[np.argsort(doc[first], kind="stable")]
                used, (k, o, f) = _dealt(bucket[by], kind[by], doc[by], later[by])
                yield _row(used, k, o, f)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, key, doc, _ in _unpacked(batches, np.uint64):
            if bucket < 0:
                yield _addressed(doc, key, buckets)
                continue
            order = np.lexsort((doc, key))
            key, doc = key[order], doc[order]
            run_of, first = _groups(key)
            keep = doc > doc[first][run_of]
            if keep.any():
                yield _addressed(doc[keep], key[keep], buckets)

    to = F.when(F.col("bucket") < 0, -1 - F.col("bucket")).otherwise(F.col("bucket"))
    found = rows.select("doc_id", "text", "starts").mapInArrow(entries, _ENTRIES) \
        .repartitionById(buckets, to).mapInArrow(run, _HITS)
    return gathered(found, buckets, "gone")


def cut_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
                block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 (of the kept words, joined by
    one space), and for rows that lose words ``kept`` (the text left) and ``spans``, the removed ranges
    of word numbers as (start, end)."""
    if length < 2 * block - 1:
        raise ValueError("a window must be long enough to hold a whole block wherever it starts")
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = docs.where(F.col("doc_id").isNotNull())
    hits = anchor_hits(anchors(named, buckets, length, block), buckets)
    rows = candidates(docs, hits, buckets, length, block)
    gone = repeated_windows(rows.where("starts is not null"), buckets, length)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            w = Words(part.column("text"))
            got, at = windows(w.hashes(), w.of, length)
            low = np.searchsorted(at, w.of)
            out = []
            for d, keys in enumerate(part.column("gone").to_pylist()):
                n, sha = part.column("n_words")[d].as_py(), part.column("sha256")[d].as_py()
                keys = np.frombuffer(keys or b"", _U)
                own = slice(low[d], low[d + 1])
                start = at[own][np.isin(got[own], keys)] - w.of[d] if len(keys) else keys
                if not len(start):
                    out.append((n, 0, sha, None, None))
                    continue
                cover = np.zeros(n + 1, np.int64)
                cover[start] += 1
                cover[start + length] -= 1
                gap = np.diff(np.r_[0, (np.cumsum(cover)[:n] > 0).astype(np.int8), 0])
                ranges = list(zip(np.flatnonzero(gap == 1).tolist(), np.flatnonzero(gap == -1).tolist(), strict=True))
                words = w.raw[w.offs[d]:w.offs[d + 1]].tobytes().split()
                left, edge = [], 0
                for a, b in ranges:
                    left += words[edge:a]
                    edge = b
                kept = b" ".join(left + words[edge:])
                out.append((n, sum(b - a for a, b in ranges), hashlib.sha256(kept).hexdigest(), kept.decode(),
                            [{"start": a, "end": b} for a, b in ranges]))
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(list(c), k) for c, k in zip(columns, _CUT_TYPES, strict=True))],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept", "spans"])

    touched = rows.where("starts is not null").join(gone, "doc_id", "left") \
        .select("doc_id", "n_words", "sha256", "text", "gone").mapInArrow(cut, _CUT)
    whole = rows.where("starts is null").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha256").alias("kept_sha256"),
        F.lit(None).cast("string").alias("kept"), F.lit(None).cast("array<struct<start:bigint,end:bigint>>").alias("spans"))
    return whole.unionByName(touched)


_CUT = ("doc_id long, n_words long, n_removed long, kept_sha256 string, kept string, "
        "spans array<struct<start:bigint,end:bigint>>")
_CUT_TYPES = (pa.int64(), pa.int64(), pa.string(), pa.string(),
              pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
