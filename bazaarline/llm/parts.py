"""Complete search for passages within a number of edits: parts that must stand unchanged.

An item within which ``e`` edits are allowed is cut into ``e + 1`` parts of nearly the same length. Each edit touches
one part at most, so every passage within ``e`` edits holds at least one part unchanged, whatever the length of the item.
Every run of as many words as a part has is looked up among the parts of all items (of a part longer than ``KEY_WORDS`` its
first words). The words around a part that belong to every passage through it are then compared with the words of the
item; more strange words than edits, or more words missing at an end of the document, rule it out. None of the steps
loses a passage (a run is known by a 64-bit hash, which can only add hits).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from .words import Words, mix, spans, windows

KEY_WORDS = 8          # words of a part that are looked up, at most
HITS = 1 << 20         # looked up together
_U = np.uint64


@dataclass
class Items:
    """Items with words: their ids, word hashes and the edits allowed."""

    ids: list
    words: list[np.ndarray]
    edits: np.ndarray

    def part(self, which: np.ndarray) -> Items:
        return Items([self.ids[i] for i in which], [self.words[i] for i in which], self.edits[which])


def prepare(items: list[tuple], rate: float) -> Items:
    if not 0 <= rate < 1:
        raise ValueError(f"rate must be at least 0 and below 1, not {rate}")
    w = Words(pa.array([t for _, t in items], pa.string()), lower=True)
    hashes = w.hashes()
    kept = [i for i in range(len(items)) if w.count[i]]
    words = [hashes[w.of[i]:w.of[i + 1]] for i in kept]
    return Items([items[i][0] for i in kept], words, np.array([int(rate * len(x)) for x in words], np.int64))


def edit_distance(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Least edits from the item to a part of the passage, and where that part begins and ends."""
    n = len(passage)
    place = np.arange(n + 1)
    cost, start = np.zeros(n + 1, np.int64), place.copy()
    for k, word in enumerate(item, 1):
        swap = np.r_[k, cost[:-1] + (passage != word)]
        begin = np.r_[0, start[:-1]]
        drop = cost + 1
        begin = np.where(drop < swap, start, begin)
        best = np.minimum(swap, drop)
        lead = best - place                 # words added: one edit for each step to the right
        low = np.minimum.accumulate(lead)
        source = np.maximum.accumulate(np.where(lead == low, place, 0))
        cost, start = low + place, begin[source]
    end = int(np.argmin(cost))
    return int(cost[end]), int(start[end]), end


class Sieve:
    """A set of hashes that may also say yes to a few others."""

    def __init__(self, hashes: np.ndarray):
        bits = max(12, len(hashes).bit_length() + 4)
        self.shift, self.has = _U(64 - bits), np.zeros(1 << bits, bool)
        self.has[hashes >> self.shift] = True

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        return self.has[hashes >> self.shift]


class Verifier:
    """Finds the best passage of every item in stretches of a text that may hold one."""

    def __init__(self, items: Items):
        self.items, self.edits = items, items.edits
        self.sizes = np.array([len(x) for x in items.words], np.int64)

    def starts(self, hashes: np.ndarray, of: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text, item, where the item begins if nothing before the hit is edited), some at a time."""
        raise NotImplementedError

    def _windows(self, hashes: np.ndarray, of: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, first word, end) of the stretches that hold every passage of an item, by text, item
        and first word; those that begin close together are one."""
        found = [np.zeros((4, 0), np.int64)]
        for doc, item, start in self.starts(hashes, of):
            low = np.maximum(of[doc], start - self.edits[item])
            high = np.minimum(of[doc + 1], start + self.sizes[item] + self.edits[item])
            found.append(np.stack([doc, item, low, high]))
        doc, item, low, high = np.concatenate(found, axis=1)
        order = np.lexsort((high, low, item, doc))
        last = None
        for d, k, a, b in zip(*(x[order].tolist() for x in (doc, item, low, high)), strict=True):
            if last and last[:2] == (d, k) and a <= last[2] + len(self.items.words[k]) // 2:
                last = d, k, last[2], max(b, last[3])
                continue
            if last:
                yield last
            last = d, k, a, b
        if last:
            yield last

    def find(self, texts: pa.Array) -> list[dict[int, tuple[int, int, int]]]:
        """Per text: item number -> (distance, first word, words) of its best passage."""
        w = Words(texts, lower=True)
        hashes = w.hashes()
        out: list[dict[int, tuple[int, int, int]]] = [{} for _ in range(len(texts))]
        if not len(hashes) or not self.items.words:
            return out
        for d, item, low, high in self._windows(hashes, w.of):
            best = out[d].get(item)
            if best and not best[0]:
                continue  # the first unedited passage
            words, passage, most = self.items.words[item], hashes[low:high], int(self.edits[item])
            if not most and len(words) == high - low <= KEY_WORDS:
                out[d][item] = 0, int(low - w.of[d]), len(words)
                continue  # looked up as a whole
            if np.isin(words, passage).sum() < len(words) - most:
                continue
            cost, a, b = edit_distance(words, passage)
            if cost <= most:
                got = (cost, int(low - w.of[d] + a), b - a)
                out[d][item] = min(best or got, got)
        return out


class Parts(Verifier):
    """Looks the runs of words of a batch of documents up among the parts of the items."""

    def __init__(self, items: Items):
        super().__init__(items)
        self.tables = []   # per length: sieve, keys, bounds of each key's parts, their items and offsets
        if not items.words:
            return
        flat, of = np.concatenate(items.words), np.r_[0, np.cumsum(self.sizes)]
        parts = self.edits + 1
        owner = np.repeat(np.arange(len(parts)), parts)
        j = spans(parts, np.zeros(len(parts), np.int64))
        offset = j * self.sizes[owner] // parts[owner]
        length = np.minimum((j + 1) * self.sizes[owner] // parts[owner] - offset, KEY_WORDS)
        for q in np.unique(length).tolist():
            these = np.flatnonzero(length == q)
            values, at = windows(flat, of, q)
            keys = values[np.searchsorted(at, of[owner[these]] + offset[these])]
            order = np.argsort(keys, kind="stable")
            these = these[order]
            known, first = np.unique(keys[order], return_index=True)
            self.tables.append((q, Sieve(known), known, np.r_[first, len(these)], owner[these], offset[these]))
        self.names = mix(np.arange(len(parts), dtype=_U) + _U(1))
        self.own = Sieve(mix(flat ^ np.repeat(self.names, self.sizes)))

    def _hits(self, hashes: np.ndarray, of: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(first word, item, offset in the item) of every run of words that is a part, some at a time."""
        for q, sieve, known, bounds, owner, offset in self.tables:
            keys, at = windows(hashes, of, q)
            maybe = np.flatnonzero(sieve(keys))
            rank = np.minimum(np.searchsorted(known, keys[maybe]), len(known) - 1)
            same = known[rank] == keys[maybe]
            place, rank = at[maybe[same]], rank[same]
            counts = bounds[rank + 1] - bounds[rank]
            upto, i = np.cumsum(counts), 0
            while i < len(place):
                j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + HITS, "right")))
                take = spans(counts[i:j], bounds[rank[i:j]])
                yield np.repeat(place[i:j], counts[i:j]), owner[take], offset[take]
                i = j

    def _possible(self, hashes: np.ndarray, low: np.ndarray, high: np.ndarray, start: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Which hits can be within the edits allowed. ``start`` is where the item begins if nothing before
        the part is edited, ``low`` and ``high`` bound the document."""
        n, most = self.sizes[item], self.edits[item]
        lost = np.maximum(0, low - start) + np.maximum(0, start + n - high)
        alive = np.flatnonzero(lost <= most)
        at = np.maximum(start + most, low)[alive]
        end = np.minimum(start + n - most, high)[alive]
        left, name, sure = most[alive].copy(), self.names[item[alive]], []
        while len(alive):
            over = at >= end
            sure.append(alive[over])
            go = np.flatnonzero(~over)
            alive, at, end, left, name = alive[go], at[go], end[go], left[go], name[go]
            left -= ~self.own(mix(hashes[at] ^ name))
            go = np.flatnonzero(left >= 0)
            alive, at, end, left, name = alive[go], at[go] + 1, end[go], left[go], name[go]
        return np.sort(np.concatenate(sure)) if sure else alive

    def starts(self, hashes: np.ndarray, of: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for place, item, offset in self._hits(hashes, of):
            doc = np.searchsorted(of, place, "right") - 1
            start = place - offset
            keep = self._possible(hashes, of[doc], of[doc + 1], start, item)
            yield doc[keep], item[keep], start[keep]
