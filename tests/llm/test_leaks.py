"""Decontamination: the complete search against plain edit distances, the sampled walks against the complete search."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bazaarline.llm import leaks, parts


def passage(rng, n):
    return ["".join(rng.choice(list("abcdefghij"), rng.randint(3, 9))) for _ in range(n)]


def edited(words, rng, edits):
    """So many words added, dropped or replaced, spread over the whole passage."""
    out = []
    at = dict(zip(rng.choice(len(words), edits, replace=False).tolist(), rng.randint(3, size=edits).tolist(), strict=True))
    for i, word in enumerate(words):
        kind = at.get(i)
        out += {None: [word], 0: [f"x{i}", word], 1: [], 2: [f"x{i}"]}[kind]
    return out


def least_edits(item, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_recall_of_all_lengths_at_the_full_edit_rate(spark):
    """Few long items among many short ones, with as many edits as allowed; recall counted by length."""
    rng = np.random.RandomState(3)
    lengths = [8, 12, 16] * 60 + [24, 32] * 30 + [100, 200, 300, 400] * 3
    items = [(i, passage(rng, n)) for i, n in enumerate(lengths)]
    copies = [(1000 * k + i, i) for i, n in enumerate(lengths) for k in range(10 if n >= 100 else 2)]
    docs = [(d, " ".join(passage(rng, 60) + edited(items[i][1], rng, int(leaks.RATE * lengths[i])) + passage(rng, 60))) for d, i in copies]
    docs = spark.createDataFrame(docs, "doc_id long, text string").withColumn("a.b", F.lit(1)).withColumn("distance", F.lit("x")).repartition(4)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.distance for r in leaks.find_leaks(docs, bench).collect()}
    assert set(got) <= set(copies)
    assert all(d <= int(leaks.RATE * lengths[i]) for (_, i), d in got.items())
    for low, high in ((8, 8), (12, 16), (24, 32), (100, 400)):
        there = [c for c in copies if low <= lengths[c[1]] <= high]
        assert sum(c in got for c in there) / len(there) >= 0.93, (low, high)  # 0.95 but for the luck of the draw
    clean = leaks.without_leaks(docs, bench)
    assert clean.columns == docs.columns and clean.count() == len(docs.collect()) - len({d for d, _ in got})
    exact = {(r.doc_id, r.item_id): r.distance for r in leaks.find_leaks(docs, bench, exact=True).collect()}
    assert set(exact) == set(copies) and all(exact[c] == d for c, d in got.items())
    # several blocks of items give the same
    few = bench.where("item_id >= 230")
    assert sorted(leaks.find_leaks(docs, few, block_bytes=2000).collect()) == sorted(leaks.find_leaks(docs, few, block_bytes=2000).collect())
    assert leaks.find_leaks(docs.limit(0), bench).count() == 0 and leaks.without_leaks(docs, bench.limit(0)).count() == docs.count()


def test_too_few_repetitions_are_an_error(monkeypatch):
    monkeypatch.setattr(leaks, "MOST_REPEATS", 1)
    rng = np.random.RandomState(1)
    with pytest.raises(RuntimeError, match="repetitions"):
        leaks.Finder(parts.prepare([(1, " ".join(passage(rng, 20)))], leaks.RATE))


def test_unedited_passages_are_always_found():
    rng = np.random.RandomState(2)
    items = [(i, passage(rng, n)) for i, n in enumerate([8, 9, 15, 33, 64, 100, 500])]
    finder = leaks.Finder(parts.prepare([(i, " ".join(w)) for i, w in items], leaks.RATE))
    texts = [" ".join(passage(rng, rng.randint(5)) + w) for _, w in items] * 5
    assert [{k: v[0] for k, v in x.items()} for x in finder.find(pa.array(texts))] == [{k: 0} for k in range(len(items))] * 5


@pytest.mark.parametrize("seed", range(6))
def test_all_passages_of_few_words(seed):
    """Texts over a handful of words, where parts are met everywhere, against plain edit distances."""
    rng = np.random.RandomState(seed)
    names = [f"w{i}" for i in range(2 + 3 * seed)]
    items = [rng.choice(names, rng.randint(1, 45)).tolist() for _ in range(25)]
    texts = [rng.choice(names, rng.randint(0, 70)).tolist() for _ in range(25)]
    texts += [rng.choice(names, rng.randint(0, 9)).tolist() + edited(w, rng, int(leaks.RATE * len(w)) + rng.randint(2))[rng.randint(2):]
              for w in items]
    want = [{k: d for k, w in enumerate(items) if (d := least_edits(w, t)) <= int(leaks.RATE * len(w))} for t in texts]
    ready = parts.prepare([(k, " ".join(w)) for k, w in enumerate(items)], leaks.RATE)
    finder = leaks.Finder(ready, exact=True)
    got = finder.find(pa.array([" ".join(t) for t in texts]))
    assert [{k: cost for k, (cost, _, _) in hits.items()} for hits in got] == want
    for text, hits in zip(texts, got, strict=True):
        for k, (cost, start, n) in hits.items():
            assert least_edits(items[k], text[start:start + n]) == cost


def test_short_items(spark):
    """Items of one to nine words: exact runs below seven words, one edit from seven on."""
    text = "the river rose in spring and nobody had built a bridge across it"
    items = {1: "bridge", 2: "Nobody had", 3: "rose  in\nspring and nobody", 4: "river rose in spring and nobody", 5: "had nobody",
             6: "river rose in WINTER and nobody", 7: "river rose in winter and nobody had", 8: "in spring and nobody built a bridge across",
             9: "river fell in winter and nobody had", 10: None, 11: " ", 12: "rid", 13: "bridge"}
    docs = [(1, text), (2, "Bridge"), (3, None), (4, ""), (5, "abridged"), (6, "nobody"), (7, "had"), (8, "a bridge, no bridge bridge")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.distance, r.start, r.n_words) for r in leaks.find_leaks(frame, bench).collect()}
    assert got == {(1, 1): (0, 10, 1), (1, 13): (0, 10, 1), (1, 2): (0, 6, 2), (1, 3): (0, 2, 5), (1, 4): (0, 1, 6), (1, 7): (1, 1, 7),
                   (1, 8): (1, 3, 9), (2, 1): (0, 0, 1), (2, 13): (0, 0, 1), (8, 1): (0, 3, 1), (8, 13): (0, 3, 1)}
    assert {r.doc_id for r in leaks.without_leaks(frame, bench).collect()} == {3, 4, 5, 6, 7}
