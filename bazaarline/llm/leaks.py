"""Benchmark decontamination: passages of benchmark items in documents, up to a few edited words.

Texts are sequences of words, A-Z lower-cased; the distance is the edit distance over words.

1. Windows. An item is cut into segments of at most ``SEGMENT`` words, all of about the same length: of the edits of a
   passage, one segment at least has no more than its share. Segments are grouped by length, and every word position
   of a document begins a window of that length, unless the words that no item has already make up more edits.
2. Embedding. A random walk reads a window: each step writes the word at the pointer, then a random bit that depends
   on step and word moves the pointer on or not (CGK). Two sequences at a small edit distance meet again after each
   edit, so their walks differ in few steps: a small Hamming distance.
3. Sampling. A key is the words at a few sampled steps. A window is followed only while its samples agree
   with those of a segment. Each repetition has other bits and steps.
4. Repetitions are counted for every length group by itself: edited copies of its items, at the full edit rate and between
   other words, are searched with the keys to be used, until the share of them that is found, less two standard errors,
   reaches ``recall``.
   If ``MOST_REPEATS`` don't suffice, an error says so.
5. Every hit is verified by the exact edit distance of the whole item to the best-fitting passage, so what
   is reported is within ``rate`` edits per item word for certain.

Passages are found with odds of ``recall`` or more at the full rate, and better with fewer edits (unedited ones always).
``exact=True`` takes the complete search of ``parts`` instead. Items of fewer than ``MIN_WORDS`` words, too short for
a window, are always searched so.

Items are read in blocks of ``BLOCK_BYTES`` of text, which bounds what is broadcast; one pass over the documents serves
a block. Documents are never shuffled.

Rows: null and empty texts have no words and no leaks; an item without words is in no document. Repeated items or documents
are matched each. An empty table of documents or items gives no leaks. Other columns, whatever their names, pass through
``without_leaks`` and are not read by ``find_leaks``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BooleanType

from .parts import Items, Parts, Sieve, Verifier, prepare
from .words import mix, per_text, slices, spans

RATE = 0.15
RECALL = 0.95
MIN_WORDS = 8
SEGMENT = 32
RATIO = 1.3            # lengths of one group differ by this factor at most
SAMPLES = 3
DEPTH = 1.4            # steps sampled from, per word of the shortest segment of a group
PROBES = 400           # edited copies searched for per group, each item of up to this many at least once
MOST_REPEATS = 2_000
BLOCK_BYTES = 8 << 20
_U = np.uint64
_PAD = _U(0xA0761D6478BD642F)


def _random(*seeds: int) -> np.random.RandomState:
    return np.random.RandomState(int(mix(np.array([sum(s * 1_000_003**i for i, s in enumerate(seeds)) % 2**63], _U))[0] % _U(2**32)))


def walk(padded: np.ndarray, first: np.ndarray, stop: np.ndarray, coins: np.ndarray, steps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Follow windows ``first .. stop`` of the words before the padding through the steps of the walk.

    At every sampled step it gives the numbers of the windows still followed and the words they write; what is
    sent back (a mask) says which of them to go on with.
    """
    n, at, place, j = len(padded) - 1, np.arange(len(first)), first, 0
    for step in steps.tolist():
        while j < step:
            word = padded[np.where(place < stop, place, n)]
            place = place + (word * coins[j] >> _U(63)).astype(np.int64)
            j += 1
        keep = yield at, padded[np.where(place < stop, place, n)]
        at, place, stop = at[keep], place[keep], stop[keep]


class Group:
    """Segments of about the same length and their keys, repetition after repetition."""

    def __init__(self, number: int, seed: int, words: np.ndarray, first: np.ndarray, size: np.ndarray,
                 item: np.ndarray, offset: np.ndarray, edits: int):
        self.number, self.seed = number, seed
        self.padded, self.first, self.size = np.r_[words, _PAD], first, size
        self.item, self.offset = item, offset
        self.sure = max(1, int(size.min()) - edits)  # words of a window that belong to every passage beginning there
        self.edits = edits
        self.depth = max(SAMPLES, int(DEPTH * size.min()))
        self.keys: list[tuple] = []

    def repeat(self) -> tuple:
        """The next repetition: coins, steps, known keys after each sample, final keys in order, their segments."""
        rng = _random(self.seed, self.number, len(self.keys))
        coins = mix(rng.randint(0, 2**62, self.depth).astype(_U)) | _U(1)
        steps = np.sort(rng.choice(self.depth, SAMPLES, replace=False))
        key, known = np.zeros(len(self.first), _U), []
        follow = walk(self.padded, self.first, self.first + self.size, coins, steps)
        at, word = next(follow)
        for s in range(SAMPLES):
            key = mix(key * _U(0x9E3779B97F4A7C15) + word)
            known.append(Sieve(np.unique(key)))
            if s + 1 < SAMPLES:
                at, word = follow.send(np.ones(len(at), bool))
        order = np.argsort(key, kind="stable")
        self.keys.append((coins, steps, known, key[order], order))
        return self.keys[-1]

    def hits(self, repetition: tuple, padded: np.ndarray, first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, segment) pairs that share a key. A window ends where its segments or its text do."""
        coins, steps, known, keys, segments = repetition
        if not len(first):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        follow = walk(padded, first, stop, coins, steps)
        at, word = next(follow)
        key = np.zeros(len(first), _U)
        for s in range(SAMPLES):
            key = mix(key * _U(0x9E3779B97F4A7C15) + word)
            keep = known[s](key)
            key, left = key[keep], at[keep]
            if s + 1 < SAMPLES:
                at, word = follow.send(keep)
        low, high = np.searchsorted(keys, key), np.searchsorted(keys, key, "right")
        counts = high - low
        return np.repeat(left, counts), segments[spans(counts, low)]

    def open(self, foreign: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First word and end of the windows that may hold a segment: ``foreign`` counts the words before each
        place that no item has."""
        n = len(foreign) - 1
        ends, at = np.repeat(of[1:], np.diff(of)), np.arange(n)
        upto = np.minimum(at + self.sure, ends)
        first = np.flatnonzero((foreign[upto] - foreign[at] <= self.edits) & (ends - at >= self.sure))
        return first, ends[first]


class Walks(Verifier):
    """Candidates by sampled random walks."""

    def __init__(self, items: Items, recall: float = RECALL, seed: int = 0):
        super().__init__(items)
        self.groups: list[Group] = []
        if not items.words:
            return
        flat, of = np.concatenate(items.words), np.r_[0, np.cumsum(self.sizes)]
        self.vocabulary = np.unique(flat)
        cuts = -(-self.sizes // SEGMENT)
        length = np.log(np.maximum(self.sizes // cuts, MIN_WORDS) / MIN_WORDS) // np.log(RATIO)
        for number in np.unique(length).tolist():
            which = np.flatnonzero(length == number)
            item = np.repeat(which, cuts[which])
            j = spans(cuts[which], np.zeros(len(which), np.int64))
            offset = j * self.sizes[item] // cuts[item]
            size = (j + 1) * self.sizes[item] // cuts[item] - offset
            group = Group(int(number), seed, flat, of[item] + offset, size, item, offset, int((self.edits[which] // cuts[which]).max()))
            self.groups.append(group)
            self._until(group, which, recall)

    def _until(self, group: Group, which: np.ndarray, recall: float) -> None:
        """Add repetitions to the group until the share of edited copies that is found reaches ``recall``."""
        rng = _random(group.seed + 1, group.number)
        probes = which if len(which) >= PROBES else np.resize(which, PROBES)
        probes = rng.choice(probes, PROBES, replace=False) if len(probes) > PROBES else probes
        noise = lambda n: mix(rng.randint(0, 2**62, n).astype(_U))
        texts = [np.r_[noise(8), _edited(self.items.words[i], int(self.edits[i]), rng, noise), noise(8)] for i in probes.tolist()]
        hashes, of = np.concatenate(texts), np.r_[0, np.cumsum([len(t) for t in texts])]
        first, stop = group.open(self._foreign(hashes), of)
        padded, text = np.r_[hashes, _PAD], np.searchsorted(of, first, "right") - 1
        found = np.zeros(len(probes), bool)
        # two standard errors of what is counted stay on the safe side
        while found.mean() - 2 * np.sqrt(found.mean() * (1 - found.mean()) / len(found)) < recall:
            if len(group.keys) == MOST_REPEATS:
                raise RuntimeError(f"{MOST_REPEATS} repetitions find {found.mean():.3f} of edited items of {group.size.min()} "
                                   f"to {group.size.max()} words, not {recall}; use exact=True or a lower rate")
            window, segment = group.hits(group.repeat(), padded, first, stop)
            found[text[window][group.item[segment] == probes[text[window]]]] = True

    def _foreign(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.r_[0, np.cumsum(self.vocabulary[at] != hashes)]

    def starts(self, hashes: np.ndarray, of: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        padded, foreign = np.r_[hashes, _PAD], self._foreign(hashes)
        for group in self.groups:
            first, stop = group.open(foreign, of)
            for repetition in group.keys:
                window, segment = group.hits(repetition, padded, first, stop)
                place = first[window]
                pair = np.unique(np.stack([np.searchsorted(of, place, "right") - 1, group.item[segment], place - group.offset[segment]]), axis=1)
                yield pair[0], pair[1], pair[2]


def _edited(words: np.ndarray, edits: int, rng: np.random.RandomState, noise) -> np.ndarray:
    """So many words added, dropped or replaced, at as many places."""
    out = words.tolist()
    places = np.sort(rng.choice(len(out), edits, replace=False))[::-1]
    for at, kind, new in zip(places.tolist(), rng.randint(3, size=edits).tolist(), noise(edits).tolist(), strict=True):
        out[at:at + (kind > 0)] = [new] * (kind < 2)
    return np.array(out, _U)


class Finder:
    """Walks for items of ``MIN_WORDS`` words and more, parts for the others, or parts for all (``exact``)."""

    def __init__(self, items: Items, recall: float = RECALL, exact: bool = False):
        long = np.array([not exact and len(w) >= MIN_WORDS for w in items.words], bool)
        self.items = items
        self.which = [np.flatnonzero(long), np.flatnonzero(~long)]
        self.searches = [Walks(items.part(self.which[0]), recall), Parts(items.part(self.which[1]))]

    def find(self, texts: pa.Array) -> list[dict[int, tuple[int, int, int]]]:
        """Per text: item number -> (distance, first word, words) of its best passage."""
        out: list[dict[int, tuple[int, int, int]]] = [{} for _ in range(len(texts))]
        for which, search in zip(self.which, self.searches, strict=True):
            if len(which):
                for all_, hits in zip(out, search.find(texts), strict=True):
                    all_.update({int(which[k]): v for k, v in hits.items()})
        return out


def _finders(items: DataFrame, item_id: str, text: str, rate: float, recall: float, exact: bool, limit: int) -> Iterator[Broadcast]:
    """A broadcast finder for each block of items; one block of at most ``limit`` bytes, or one item, on the driver at a time."""
    spark, block, held = items.sparkSession, [], 0

    def ready():
        words = prepare(block, rate)
        return [spark.sparkContext.broadcast(Finder(words, recall, exact))] if words.words else []

    for row in items.select(F.col(item_id).cast("long"), F.col(text).cast("string")).toLocalIterator():
        size = len((row[1] or "").encode()) + 64
        if block and held + size > limit:
            yield from ready()
            block, held = [], 0
        block.append((row[0], row[1]))
        held += size
    yield from ready()


def find_leaks(docs: DataFrame, items: DataFrame, rate: float = RATE, recall: float = RECALL, exact: bool = False,
               block_bytes: int = BLOCK_BYTES, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, distance (edited words), start (first
    word of the passage) and n_words (its words)."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, item_id long, distance int, start long, n_words long"
    out = docs.sparkSession.createDataFrame([], schema)
    for finder in _finders(items, item_id, text, rate, recall, exact, block_bytes):

        def run(batches: Iterator[pa.RecordBatch], finder: Broadcast = finder) -> Iterator[pa.RecordBatch]:
            for part in slices(batches):
                ids = part.column("doc_id").to_pylist()
                found = [(ids[d], finder.value.items.ids[item], *best) for d, hits in enumerate(finder.value.find(part.column("text")))
                         for item, best in sorted(hits.items())]
                columns = list(zip(*found, strict=True)) if found else [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
                                                 names=["doc_id", "item_id", "distance", "start", "n_words"])

        out = out.unionByName(rows.mapInArrow(run, schema))
    return out


def without_leaks(docs: DataFrame, items: DataFrame, rate: float = RATE, recall: float = RECALL, exact: bool = False,
                  block_bytes: int = BLOCK_BYTES, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns. Nothing is joined, and no text comes back
    from Python."""
    for finder in _finders(items, item_id, text, rate, recall, exact, block_bytes):
        docs = docs.where(_without(finder)(F.col(text)))
    return docs


def _without(finder: Broadcast):
    @arrow_udf(BooleanType())
    def clean(texts: pa.Array) -> pa.Array:
        found = per_text(lambda part: [not hits for hits in finder.value.find(part)], texts)
        return pa.array([x for part in found for x in part], pa.bool_())

    return clean
