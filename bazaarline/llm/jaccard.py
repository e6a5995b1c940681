"""Exact n-gram Jaccard join: components of documents whose shingle sets overlap by 3/4 or more.

All pairs alike count for the components, which are exact. The links given out are a subset of these pairs that
connects the same documents: pairs within a component that is already linked are left out, so in a group of near
copies mostly the links to its hub come out, and the number of links of a document says nothing.

1. Every text becomes the set of its 5-word shingles (64-bit hashes); equal sets are one class.
2. Candidates: with its shingles in one common order, by a sketch of their counts, rare ones first, a set that can reach
   the similarity with another shares ``COMMON`` of its first quarter (and a few more) with it. These
   are the keys of the tiles; in a tile, sets are sorted by size, and only sizes within the ratio 3/4
   meet. A set that meets others in fewer tiles is alike to none, and goes no further.
3. Near copies are first linked in stars: classes that agree on a pair of minimum hashes are
   compared with one of them. In the tiles, sets that are already in one component need no
   comparison any more, so a large group of near copies costs no square of its size.
4. Bounds: each class carries a bitmap of hashed shingles, sized with the set. Every bit in which
   two bitmaps differ stands for a shingle that only one set holds, so the count of differing bits
   bounds the overlap from above. Where many classes meet in tiles, they are cut into bands of
   sizes and blocks, and whole blocks of bitmaps are compared with one another.
5. Pairs that pass are compared exactly as sorted arrays.

The components do not depend on the order, on the stars or on the bitmaps; which of their links come out does.

Rows: null and empty texts and those without words have an empty set and link with nothing. A row
with a null id gets its number of shingles and no component. Rows that repeat an id are documents of
their own. Further columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .components import components
from .marks import possible, surely_not
from .words import Words, mix, packed, shingles, slices, spans

WORDS = 5
COMMON = 4               # first shingles that sets alike must share
KEYS = 8                 # pairs of minimum hashes per class
SKETCH_BITS = 20         # counters of the frequency sketch; a fixed size
PAIRS_HELD = 500_000     # pairs that a task holds before it packs them
TILE = 32                # classes up to which a tile emits its pairs one by one
BLOCK = 1_000            # classes of a block of bitmaps
LEAVES = 500             # members of a star that one group compares
_U = np.uint64

# similarity 3/4, in whole numbers: 4 * shared >= 3 * union


def alike(shared, left, right):
    return 100 * shared >= 75 * (left + right - shared)


def near_sizes(small, large):
    return 100 * small >= 75 * large


def prefix_length(n: np.ndarray) -> np.ndarray:
    """Two sets alike share ``COMMON`` (or all that they must share, if fewer) of so many first shingles
    of either: of the least overlap, all but ``COMMON`` can come later in the order."""
    return np.where(n > 0, np.minimum(n, n - (3 * n + 3) // 4 + COMMON), 0)


def _width(n: np.ndarray) -> np.ndarray:
    """Bits of the bitmap of a set: a power of two, 64 or more, and 8 to 16 for each shingle."""
    return (2 ** np.maximum(6, np.ceil(np.log2(8.0 * np.maximum(n, 1))))).astype(np.int64)


def _class_of(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """One 64-bit value per set, equal for equal sets."""
    sums = np.zeros(len(values) + 1, _U)
    np.cumsum(mix(values ^ _U(0x5851F42D4C957F2D)), out=sums[1:])
    n = np.diff(of).astype(_U)
    return mix((sums[of[1:]] - sums[of[:-1]]) ^ mix(n + _U(0x2545F4914F6CDD1D))).view(np.int64)


def _bitmaps(values: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps of all sets, one after the other, and their byte bounds."""
    n = np.diff(of)
    width = np.where(n > 0, _width(n), 0)
    first = np.r_[0, np.cumsum(width)]
    flags = np.zeros(first[-1], bool)
    flags[np.repeat(first[:-1], n) + (values & np.repeat(np.maximum(width, 1) - 1, n).astype(_U)).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little"), first // 8


def _minima(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """``KEYS`` keys per set, each of two minimum hashes; two sets share a key with odds of about J**2."""
    n = np.diff(of)
    out = np.zeros((len(n), KEYS), _U)
    full = np.flatnonzero(n)
    if not len(full):
        return out
    for k in range(KEYS):
        key = np.full(len(full), k + 1, _U)
        for half in range(2):
            seed = mix(np.array([2 * k + half + 1], _U))[0]
            key = mix(key * _U(31) + np.minimum.reduceat(mix(values ^ seed), of[:-1][full]))
        out[full, k] = key
    return out


# pass 1: classes and the frequency sketch -----------------------------------------------------

def profile(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Stored: a row per document (kind 0: doc_id, n and class), and the parts of a count sketch of
    all shingles per task (kind 1: n is the part)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        known: set[int] = set()
        for batch in slices(batches):
            values, of = shingles(Words(batch.column("text"), lower=True), WORDS)
            n, f = np.diff(of), _class_of(values, of)
            new = np.array([x not in known for x in f.tolist()], bool)
            known.update(f.tolist())
            chosen = values[spans(n[new], of[:-1][new])]
            counts += np.bincount((chosen >> _U(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts))
            rows = len(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(rows, np.int32)), batch.column("doc_id"), pa.array(n), pa.array(f),
                 pa.nulls(rows, pa.binary())], names=_PROFILE)
        parts = [_deflated(part) for part in counts.reshape(16, -1)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ones(16, np.int32)), pa.nulls(16, pa.int64()), pa.array(np.arange(16)), pa.array(np.zeros(16, np.int64)),
             pa.array(parts, pa.binary())], names=_PROFILE)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return materialise(rows.mapInArrow(run, "kind int, doc_id long, n long, f long, counts binary"), "shingle-profile")


_PROFILE = ["kind", "doc_id", "n", "f", "counts"]


def _deflated(counts: np.ndarray) -> bytes:
    """Counts of one task, low bytes first; beyond 65,535 they only say that a shingle is frequent."""
    return zlib.compress(np.minimum(counts, 0xFFFF).astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes(), 1)


def _inflated(part: bytes) -> np.ndarray:
    low, high = np.frombuffer(zlib.decompress(part), np.uint8).reshape(2, -1)
    return low.astype(np.int64) + 256 * high.astype(np.int64)


def _levels(profiled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Per sketch counter its rank among all by count, in 256 steps, and how far it is above ordinary ones (0: not).
    Two tables of ``2 ** SKETCH_BITS`` bytes, whatever the input.

    Ranks tell a shingle of a few dozen texts from one of few, which the distance from ordinary counters, some hundreds in a
    large corpus, cannot: else such shingles fill the tiles and tie texts by chance.
    """
    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros((1 << SKETCH_BITS) // 16, np.int64)
        for part in frame["counts"]:
            total += _inflated(part)
        return pd.DataFrame({"n": frame["n"].iloc[:1], "counts": [total.tobytes()]})

    rows = profiled.where("kind = 1").select("n", "counts").groupBy("n").applyInPandas(add, "n long, counts binary").collect()
    counts = np.concatenate([np.frombuffer(r.counts, np.int64) for r in sorted(rows, key=lambda r: r.n)]) if rows \
        else np.zeros(1 << SKETCH_BITS, np.int64)
    usual = np.median(counts) + 8 * np.sqrt(counts.mean() + 1)
    steps = np.quantile(counts[counts > 0], np.arange(1, 256) / 256) if counts.any() else np.zeros(0)
    return np.searchsorted(steps, counts).astype(np.uint8), np.minimum(255, np.maximum(0, counts / usual - 0.5) * 8).astype(np.uint8)


# pass 2: prefixes, dealt over buckets in packed arrays ----------------------------------------

def prefixes(docs: DataFrame, ranks: np.ndarray, buckets: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(bucket, rest, f, n): the first shingles of every class, packed per bucket and batch. ``rest``
    has 32 bits of the hash beyond the bucket; a chance agreement is only one more candidate."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        for batch in slices(batches, limit=16 << 20):
            for part in slices(iter([batch])):
                values, of = shingles(Words(part.column("text"), lower=True), WORDS)
                n, f = np.diff(of), _class_of(values, of)
                new = np.zeros(len(n), bool)
                for i, x in enumerate(f.tolist()):
                    if n[i] and x not in known:
                        known.add(x)
                        new[i] = True
                at = spans(n[new], of[:-1][new])
                values, sizes, f = values[at], n[new], f[new]
                doc = np.repeat(np.arange(len(sizes)), sizes)
                rank = ranks[(values >> _U(64 - SKETCH_BITS)).astype(np.int64)]
                # rows are sorted by (doc, hash): now by (doc, rank, hash)
                values = values[np.argsort(doc * 256 + rank, kind="stable")]
                take = prefix_length(sizes)
                starts = np.r_[0, np.cumsum(sizes)[:-1]] if len(sizes) else np.zeros(0, np.int64)
                values, doc = values[spans(take, starts)], np.repeat(np.arange(len(sizes)), take)
                scrambled = mix(values)
                bucket = (scrambled % _U(buckets)).astype(np.int64)
                rest = (scrambled >> _U(32)).astype(np.uint32)
                order = np.argsort(bucket, kind="stable")
                bucket, rest, doc = bucket[order], rest[order], doc[order]
                used, first = np.unique(bucket, return_index=True)
                bounds = np.r_[first, len(bucket)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int32()), packed(rest, bounds), packed(f[doc], bounds),
                     packed(sizes[doc].astype(np.uint32), bounds)], names=["bucket", "rest", "f", "n"])

    rows = docs.where(F.col(doc_id).isNotNull()).select(F.col(text).alias("text"))
    return rows.mapInArrow(run, "bucket int, rest binary, f binary, n binary")


def tiles(packed_rows: DataFrame, buckets: int, most: int = TILE) -> DataFrame:
    """Stored (tile, f, n, wide): classes that share a first shingle with one of a near size, and whether they are more than ``most``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "rest", "f", "n")), strict=True):
                held.setdefault(row[0], []).append(row[1:])
        for bucket, rows in held.items():
            rest, f, n = (np.concatenate([np.frombuffer(r[i], kind) for r in rows])
                          for i, kind in enumerate((np.uint32, np.int64, np.uint32)))
            order = np.lexsort((f, n, rest))
            rest, f, n = rest[order], f[order], n[order].astype(np.int64)
            new = np.ones(len(rest), bool)
            new[1:] = (rest[1:] != rest[:-1]) | (f[1:] != f[:-1])
            rest, f, n = rest[new], f[new], n[new]
            meets = (rest[1:] == rest[:-1]) & near_sizes(n[:-1], n[1:])
            keep = np.zeros(len(rest), bool)
            keep[1:] |= meets
            keep[:-1] |= meets
            rest, f, n = rest[keep], f[keep], n[keep]
            _, number, size = np.unique(rest, return_inverse=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array((np.int64(bucket) << 32) | rest.astype(np.int64)), pa.array(f), pa.array(n), pa.array((size > most)[number])],
                names=["tile", "f", "n", "wide"])

    dealt = packed_rows.repartitionById(buckets, F.col("bucket"))
    return materialise(dealt.mapInArrow(run, "tile long, f long, n long, wide boolean"), "tiles")


# comparing ---------------------------------------------------------------------------------

def _xor_bits(a: bytes, b: bytes) -> int:
    """Differing bits of two bitmaps, the longer one folded to the length of the other."""
    if len(a) > len(b):
        a, b = b, a
    left, right = np.frombuffer(a, _U), np.frombuffer(b, _U)
    if len(left) < len(right):
        right = np.bitwise_or.reduce(right.reshape(-1, len(left)), axis=0)
    return int(np.bitwise_count(left ^ right).sum())


def bounded(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b; stored) that the bit counts leave: the overlap is at most (|A| + |B| - differing) / 2."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            differ = np.array([_xor_bits(x.as_py(), y.as_py()) for x, y in
                               zip(batch.column("bits_a"), batch.column("bits_b"), strict=True)], np.int64)
            keep = alike((na + nb - differ) // 2, na, nb)
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(keep)) for c in (batch.column("a"), batch.column("b"))], names=["a", "b"])

    left = possible(classes, "f", pairs.select("a")).select(F.col("f").alias("a"), F.col("n").alias("na"), F.col("bits").alias("bits_a"))
    right = possible(classes, "f", pairs.select("b")).select(F.col("f").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bits_b"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a: hub, b: leaf) that are alike. ``texts`` has one text per class (f, text).

    Each group of at most about ``LEAVES`` leaves gets a copy of its hub, and the texts of a group
    come to one task, the hub first; sets are made again from the texts.
    """
    pairs = materialise(pairs, "pairs")
    degree = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(LEAVES))).cast("int").alias("groups"))
    leaves = pairs.join(degree, "a").select(
        "a", F.pmod(F.xxhash64("b"), F.col("groups")).cast("int").alias("part"), F.col("b").alias("f"), F.lit(1).alias("turn"))
    hubs = degree.select("a", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"),
                         F.col("a").alias("f"), F.lit(0).alias("turn"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, hub_set = None, np.zeros(0, _U)
        for batch in slices(batches):
            values, of = shingles(Words(batch.column("text"), lower=True), WORDS)
            found_a, found_b = [], []
            columns = (batch.column(c).to_pylist() for c in ("a", "f", "turn"))
            for d, (a, f, turn) in enumerate(zip(*columns, strict=True)):
                own = values[of[d]:of[d + 1]]
                if turn == 0:
                    hub, hub_set = a, own
                elif a == hub:
                    shared = len(np.intersect1d(hub_set, own, assume_unique=True))
                    if alike(shared, len(hub_set), len(own)):
                        found_a.append(a)
                        found_b.append(f)
            yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], names=["a", "b"])

    wanted = pairs.select(F.col("a").alias("f")).unionByName(pairs.select(F.col("b").alias("f")))
    spread = leaves.unionByName(hubs).join(possible(texts, "f", wanted), "f")
    return materialise(spread.repartition("a", "part").sortWithinPartitions("a", "part", "turn")
                       .select("a", "f", "turn", "text").mapInArrow(run, "a long, b long"), "alike")


def star_pairs(classes: DataFrame) -> DataFrame:
    """Each class with the most central one that shares a pair of minimum hashes with it, for every
    shared pair. A text that others were made from has their frequent shingles and none of its own,
    so it is the hub of its group."""
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = np.frombuffer(b"".join(batch.column("keys").to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(got), *(pa.array(np.repeat(batch.column(c).to_numpy(), KEYS)) for c in ("f", "n", "central"))],
                names=["key", "f", "n", "central"])

    keyed = classes.select("f", "n", "central", "keys").mapInArrow(keys, "key long, f long, n long, central double")
    hubs = keyed.groupBy("key").agg(F.max(F.struct("central", "f", "n")).alias("hub"), F.count(F.lit(1)).alias("c")).where("c > 1")
    small, large = F.least("n", "hub.n"), F.greatest("n", "hub.n")
    return keyed.join(hubs, "key").where((F.col("f") != F.col("hub.f")) & (100 * small >= 75 * large)) \
        .select(F.col("hub.f").alias("a"), F.col("f").alias("b")).distinct()


def open_tiles(named: DataFrame, lanes: int, most: int = TILE) -> tuple[DataFrame, DataFrame]:
    """What the tiles (tile, f, n, label, wides) leave open: pairs (a, b) of near sizes that share a small tile and are in no component
    together yet, each once; and for large tiles (a, b) edges that tie their classes to families.

    A pair meets in many tiles, so pairs travel packed, by a hash, to where their tiles are counted. Sets alike
    meet in ``COMMON`` tiles at least. ``wides`` says in how many large tiles a class is, or more: two that meet in small
    tiles can have no more large ones in common than either is in, so a pair for which both together are too few goes no further.
    Those that meet in large tiles alone are each in ``COMMON`` of them, and only such classes are tied to families: a large
    tile in which texts meet by chance ties none. Sets of under ``COMMON`` + 1 shingles may share fewer, and always go on.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        every = pa.Table.from_batches(held)
        tile, f, n, label, wides = (every.column(c).to_numpy() for c in ("tile", "f", "n", "label", "wides"))
        order = np.lexsort((f, n, tile))
        tile, f, n, label, wides = tile[order], f[order], n[order], label[order], wides[order]
        # tiles of one component are done with
        start = np.r_[True, tile[1:] != tile[:-1]]
        number = np.cumsum(start) - 1
        mixed = np.zeros(number[-1] + 1, bool)
        mixed[number[1:][~start[1:] & (label[1:] != label[:-1])]] = True
        large = np.bincount(number) > most
        wide = (mixed & large)[number] & (wides >= np.minimum(COMMON, (3 * n + 3) // 4))
        if wide.any():
            _, first, of = np.unique(number[wide], return_index=True, return_inverse=True)
            yield _packet(1, f[wide][first][of], f[wide], np.full(wide.sum(), COMMON), lanes)
        keep = (mixed & ~large)[number]
        tile, f, n, label, spare = tile[keep], f[keep], n[keep], label[keep], np.minimum(wides[keep], COMMON)
        at, pairs, few = np.arange(len(tile)), [], np.where(n <= COMMON, COMMON, 1)
        for apart in range(1, most):
            at = at[at + apart < len(tile)]
            near = (tile[at] == tile[at + apart]) & near_sizes(n[at], n[at + apart])
            at = at[near]  # sizes ascend: what is too far apart here stays so
            hit = at[label[at] != label[at + apart]]
            pairs.append((f[hit], f[hit + apart], few[hit] + _SPARE * np.minimum(spare[hit], spare[hit + apart])))
            if sum(len(x) for x, *_ in pairs) > PAIRS_HELD:
                yield _packet(0, *map(np.concatenate, zip(*pairs, strict=True)), lanes)
                pairs = []
        if pairs:
            yield _packet(0, *map(np.concatenate, zip(*pairs, strict=True)), lanes)

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in
                zip(*(batch.column(c).to_pylist() for c in ("kind", "pairs", "met")), strict=True)]
        for kind in (0, 1):
            own = [np.frombuffer(x, np.int64).reshape(-1, 2) for k, x, _ in rows if k == kind]
            if own:
                met = np.concatenate([np.frombuffer(x, np.uint8) for k, _, x in rows if k == kind])
                pair, met = _counted(np.concatenate(own), met)
                pair = pair[met % _SPARE + met // _SPARE >= COMMON]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), kind, np.int32)), pa.array(pair[:, 0]),
                                                  pa.array(pair[:, 1])], names=["kind", "a", "b"])

    found = named.select("tile", "f", "n", "label", "wides").repartitionById(lanes, F.pmod(F.xxhash64("tile"), F.lit(lanes)).cast("int")) \
        .mapInArrow(run, "kind int, lane int, pairs binary, met binary").repartitionById(lanes, F.col("lane")) \
        .mapInArrow(distinct, "kind int, a long, b long")
    found = materialise(found, "open-tiles")
    return found.where("kind = 0").select("a", "b"), found.where("kind = 1").select("a", "b")


_SPARE = 16  # met in small tiles, and this times how many large ones the pair can share: one byte


def _counted(pair: np.ndarray, met: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs and the sums of their ``met``, which say no more than "``COMMON`` or more" beyond it."""
    order = np.lexsort((pair[:, 1], pair[:, 0]))
    pair, met = pair[order], met[order].astype(np.int64)
    first = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]).any(axis=1)][:len(pair)])
    sums = np.add.reduceat(met % _SPARE, first) if len(first) else np.zeros(0, np.int64)
    return pair[first], (np.minimum(sums, COMMON) + met[first] // _SPARE * _SPARE).astype(np.uint8)


def _packet(kind: int, x: np.ndarray, y: np.ndarray, met: np.ndarray, lanes: int) -> pa.RecordBatch:
    """Distinct pairs, the smaller class first, and in how many tiles they met, packed by lane."""
    pair, met = _counted(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1), met)
    lane = (mix(mix(pair[:, 0].astype(_U)) ^ pair[:, 1].astype(_U)) % _U(lanes)).astype(np.int64)
    order = np.argsort(lane, kind="stable")
    used, first = np.unique(lane[order], return_index=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(used), kind, np.int32)), pa.array(used, pa.int32()),
         packed(pair[order].ravel(), np.r_[first, len(lane)] * 2), packed(met[order], np.r_[first, len(lane)])],
        names=["kind", "lane", "pairs", "met"])


def family_pairs(edges: DataFrame, classes: DataFrame, labels: DataFrame, block: int = BLOCK) -> DataFrame:
    """Pairs that the bit counts leave among classes that meet in large tiles, by blocks of near sizes.

    A family (classes tied by large tiles) is cut into size bands, and each band into blocks of about
    ``block`` classes; a component that fills blocks has blocks of its own, which are not compared with
    one another. Every two blocks of one band or of bands next to each other come to one group, and
    whole blocks of bitmaps are compared there: pairs are never rows before their bits are counted.
    """
    family = components(edges).withColumnsRenamed({"node": "f", "label": "family"})
    rows = family.join(possible(classes.select("f", "n", "bits"), "f", edges.select("a").union(edges.select("b"))), "f").join(labels.withColumnRenamed("node", "f"), "f", "left") \
        .withColumn("label", F.coalesce("label", "f")) \
        .withColumn("band", F.floor(F.log("n") / F.lit(float(np.log(1.34)))).cast("int"))  # wider than 4/3
    rows = materialise(rows, "families")
    big = rows.groupBy("family", "band", "label").count().where(F.col("count") >= block) \
        .select("family", "band", "label", F.lit(True).alias("big"))
    rows = rows.join(big, ["family", "band", "label"], "left").withColumn("big", F.coalesce("big", F.lit(False))) \
        .withColumn("own", F.when(F.col("big"), F.col("label")).otherwise(F.lit(0)))
    of_block = ["family", "band", "big", "own"]
    sizes = rows.groupBy(*of_block).agg(F.ceil(F.count(F.lit(1)) / F.lit(float(block))).cast("int").alias("parts"))
    rows = rows.join(sizes, of_block).withColumn("part", F.pmod(F.xxhash64("f"), F.col("parts")).cast("int")).drop("parts")
    of_block.append("part")
    blocks = materialise(sizes.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(*of_block), "blocks")
    left = blocks.select("family", *[F.col(c).alias(f"{c}_a") for c in of_block[1:]])
    right = blocks.select("family", *[F.col(c).alias(f"{c}_b") for c in of_block[1:]])
    at_a, at_b = (F.struct(*[F.col(f"{c}_{x}") for c in ("big", "own", "part")]) for x in "ab")
    together = left.join(right, "family").where(
        ((F.col("band_b") == F.col("band_a") + 1) | ((F.col("band_b") == F.col("band_a")) & (at_a <= at_b)))
        & ~(F.col("big_a") & F.col("big_b") & (F.col("own_a") == F.col("own_b"))))
    together = materialise(together.withColumn("tile", F.xxhash64("family", "band_a", at_a, "band_b", at_b)), "block-pairs")

    def side(x: str, turn: int) -> DataFrame:
        other = together if x == "a" else together.where(~((F.col("band_a") == F.col("band_b")) & at_a.eqNullSafe(at_b)))
        keys = other.select("tile", "family", *[F.col(f"{c}_{x}").alias(c) for c in of_block[1:]])
        return rows.join(keys, of_block).select("tile", F.lit(turn).alias("turn"), "f", "n", "label", "bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][0] != row[0]:
                    yield _compared(held)
                    held = []
                held.append(row)
        if held:
            yield _compared(held)

    return side("a", 0).unionByName(side("b", 1)).repartition("tile").sortWithinPartitions("tile", "turn") \
        .mapInArrow(run, "a long, b long").distinct()


def _compared(rows: list[tuple]) -> pa.RecordBatch:
    """Pairs of one tile, of its two blocks or within its only one, that can be alike by their bits."""
    _, turn, f, n, label, bits = zip(*rows, strict=True)
    f, n, label, turn = np.array(f), np.array(n), np.array(label), np.array(turn)
    words = min(len(x) for x in bits) // 8
    maps = np.stack([np.bitwise_or.reduce(np.frombuffer(x, _U).reshape(-1, words), axis=0) for x in bits])
    alone = not turn.any()
    left, right = np.flatnonzero(turn == 0), np.arange(len(f)) if alone else np.flatnonzero(turn == 1)
    found_a, found_b = [], []
    step = max(1, (1 << 21) // max(1, len(right) * words))
    for k in range(0, len(left), step):
        part = left[k:k + step]
        differ = np.bitwise_count(maps[part][:, None] ^ maps[right][None]).sum(axis=2, dtype=np.int64)
        na, nb = n[part][:, None], n[right][None]
        keep = alike((na + nb - differ) // 2, na, nb) & near_sizes(np.minimum(na, nb), np.maximum(na, nb))
        keep &= label[part][:, None] != label[right][None]
        i, j = np.nonzero(keep)
        found_a.append(f[part[i]])
        found_b.append(f[right[j]])
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def jaccard_links(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tile: int = TILE, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, n, f: class) and links (a, b) between classes: pairs alike, not all of them, that
    connect all that are (see above)."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    profiled = profile(docs)
    ranks, levels = _levels(profiled)
    tiled = tiles(prefixes(docs, ranks, buckets), buckets, tile)
    members = profiled.where("kind = 0")
    # one document of every class that meets another one in a tile, with its text
    least = F.least(F.lit(COMMON), F.ceil(F.col("n") * 0.75).cast("int"))
    meeting = tiled.groupBy("f", "n").agg(F.count(F.lit(1)).alias("tiles"), F.count_if("wide").alias("wides")) \
        .where(F.col("tiles") >= least).select("f", "wides")
    heads = materialise(members.where("doc_id is not null and n > 0").groupBy("f").agg(F.min("doc_id").alias("doc_id"))
                        .join(meeting, "f"), "heads")
    full = described(possible(docs, "doc_id", heads.select("doc_id")).join(heads, "doc_id").select("f", "text"), levels)
    classes, texts = full.drop("text"), full.select("f", "text")
    stars = verified(bounded(materialise(star_pairs(classes), "star-pairs"), classes), texts)
    labels = components(stars)
    named = heads.select("f", "wides").join(labels.withColumnRenamed("node", "f"), "f", "left") \
        .select("f", "wides", F.coalesce("label", "f").alias("label"))
    pairs, edges = open_tiles(tiled.join(named, "f"), buckets, tile)
    left = bounded(pairs, classes).unionByName(family_pairs(edges, classes, labels, block)).distinct()
    rest = verified(left, texts)
    return members.select("doc_id", "n", "f"), stars.unionByName(rest)


def described(texts: DataFrame, levels: np.ndarray) -> DataFrame:
    """Stored, one row per class: f, n, minimum hashes, bitmap, how central it is, and a text.

    Where ids repeat, the join by id has also brought texts of other classes, and copies; these go.
    The join has brought the rows of one id to one task, so copies are known there without a shuffle of texts
    (one that comes twice all the same, from a split partition, only repeats links).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        for batch in slices(batches):
            values, of = shingles(Words(batch.column("text"), lower=True), WORDS)
            n = np.diff(of)
            bits, bounds = _bitmaps(values, of)
            level = np.minimum(levels[(values >> _U(64 - SKETCH_BITS)).astype(np.int64)], 16).astype(float)
            sums = np.r_[0.0, np.cumsum(level)]
            central = (sums[of[1:]] - sums[of[:-1]]) / np.maximum(n, 1)
            wanted = batch.column("f").to_numpy()
            keep = _class_of(values, of) == wanted
            for i in np.flatnonzero(keep).tolist():
                keep[i] = int(wanted[i]) not in known
                known.add(int(wanted[i]))
            own = pa.array(keep)
            yield pa.RecordBatch.from_arrays([c.filter(own) for c in (
                batch.column("f"), pa.array(n), packed(_minima(values, of).ravel(), np.arange(len(n) + 1) * KEYS),
                packed(bits, bounds), pa.array(central), batch.column("text"))], names=["f", "n", "keys", "bits", "central", "text"])

    schema = "f long, n long, keys binary, bits binary, central double, text string"
    return materialise(texts.mapInArrow(run, schema), "classes")


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **sizes: int) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest id reachable by links) of every row.
    ``sizes`` (tile, block) only change how the work is cut."""
    members, links = jaccard_links(docs, doc_id, text, **sizes)
    labels = components(links)
    heads = members.where("doc_id is not null and n > 0").groupBy("f").agg(F.min("doc_id").alias("head"))
    named = heads.join(labels.withColumnRenamed("node", "f"), "f", "left").withColumn("label", F.coalesce("label", "f"))
    least = named.groupBy("label").agg(F.min("head").alias("least"))
    of_class = named.join(least, "label").select("f", F.col("least").alias("component_id"))
    full = members.where("doc_id is not null and n > 0").join(of_class, "f").select("doc_id", "n", "component_id")
    alone = members.where("doc_id is null or n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return full.unionByName(alone).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_per_component(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, and those without an id or words.
    Of rows that repeat such an id, with the same text or another, all stay that are heads."""
    of = materialise(jaccard_components(docs, doc_id, text).where("doc_id is not null")
                     .groupBy("doc_id").agg(F.bool_or(F.col("doc_id") == F.col("component_id")).alias("head")), "heads")
    heads = of.where("head").select(F.col("doc_id").alias("__head"))
    others = of.where("not head").select("doc_id")
    named = docs.where(F.col(doc_id).cast("long").isNotNull())
    # only texts that seem to be dropped move, to be sure of it
    doubtful = possible(named, doc_id, others).join(heads, F.col(doc_id) == F.col("__head"), "left_semi")
    return surely_not(named, doc_id, others).unionByName(doubtful).unionByName(docs.where(F.col(doc_id).isNull()))
