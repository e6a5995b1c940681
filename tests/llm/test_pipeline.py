"""The corpus pipeline as a whole, every stage against a plain version, over odd rows and sources of unequal size."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from test_text_operators import BPE, SCHEMA, brute_components, brute_distance, near, passage, words_of

import corpus_pipeline
from bazaarline.llm import leaks, quality


def fixture():
    """Prose and junk in three sources and none, copies and near copies, passages of items, odd rows."""
    items = [(1, " ".join(passage(901, 40))), (2, " ".join(passage(902, 120))), (3, "one two three"), (4, None)]
    rows = []
    for i in range(160):
        junk = i % 4 == 3
        text = f"|||| CLICK HERE!!!! {i} $$$ " * (5 + i % 7) if junk else " ".join(passage(i, 50 + i % 60)).capitalize() + "."
        rows.append((i, text, "en", "small" if i % 10 == 0 else None if i % 10 == 5 else "mid" if i % 10 in (1, 2) else "big", i))
    prose = [r for r in rows if r[0] % 4 != 3]
    rows += [(200 + i, r[1], "de", "small", None) for i, r in enumerate(prose[:8])]
    rows += [(300 + i, " ".join(near(words_of(r[1]), i, 1)), None, "mid", 5) for i, r in enumerate(prose[8:20])]
    for i, (_, text) in enumerate(items[:2]):
        words = words_of(text)
        rows.append((400 + i, " ".join(passage(400 + i, 40) + near(words, i, int(leaks.RATE * len(words))) + passage(500 + i, 30)), "en", "big", 1))
    rows += [(410, " ".join(passage(410, 40) + words_of("One Two three") + passage(411, 30)), "en", "mid", 1),
             (None, " ".join(passage(600, 60)), "en", "big", 1), (None, None, None, None, None), (601, None, "en", "big", 0),
             (602, "", "en", None, 0), (603, " \n ", "fr", "small", 3), (5, " ".join(passage(604, 55)), "en", "mid", 2), rows[0]]
    labels = [(r[0], None if r[0] % 9 == 0 else int(r[0] % 4 != 3), 0) for r in rows[:160] if r[0] % 5]
    return rows, items, labels


def plainly_accepted(rows, labels):
    label = {i: y for i, y, _ in labels if y is not None and zlib.crc32(str(i).encode()) % 5}
    x = quality.statistics(pa.array([r[1] for r in rows], pa.string()))
    known = [k for k, r in enumerate(rows) if r[0] in label]
    y = np.array([label[rows[k][0]] for k in known])
    of = [x[known][y == c] for c in (0, 1)]
    cov = [np.cov(a.T, bias=True) for a in of]
    pooled = sum(len(a) * c for a, c in zip(of, cov)) / len(known)
    logs = []
    for a, c in zip(of, cov, strict=True):
        c = (1 - quality.TO_POOLED) * c + quality.TO_POOLED * pooled
        c = (1 - quality.TO_UNIT) * c + quality.TO_UNIT * np.trace(c) / len(c) * np.eye(len(c))
        z = x - a.mean(axis=0)
        logs.append(np.log((len(a) + 1) / (len(known) + 2)) - ((z @ np.linalg.inv(c)) * z).sum(axis=1) / 2 - np.linalg.slogdet(c)[1] / 2)
    odds = np.clip(logs[0] - logs[1], -500, 500)
    return [r for r, p in zip(rows, 1 / (1 + np.exp(odds)), strict=True) if p >= quality.THRESHOLD]


def plainly_first(rows):
    named = [r for r in rows if r[0] is not None]
    heads = {i for i, _, c in brute_components([(r[0], r[1]) for r in named]) if i == c}
    return [r for r in rows if r[0] is None or r[0] in heads]


def plainly_clean(rows, items):
    low = [words_of(t, lower=True) for _, t in items if t]
    return [r for r in rows if all(brute_distance(w, words_of(r[1], lower=True)) > int(leaks.RATE * len(w)) for w in low)]


def test_every_stage_and_the_whole(spark, tmp_path):
    from tokenizers import Tokenizer

    rows, items, labels = fixture()
    for name, data, schema in (("documents", rows, SCHEMA), ("benchmark", items, "item_id long, text string"),
                               ("labels", labels, "doc_id long, quality int, toxic int")):
        spark.createDataFrame(data, schema).repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    stages, folder = dict(corpus_pipeline.STAGES), str(tmp_path)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "ngram_jaccard_join", "benchmark_decontamination",
                                                      "source_mixing", "token_output"]

    def stage(name, data):
        out = stages[name](spark, spark.createDataFrame(data, SCHEMA).repartition(3), folder)
        assert name == "token_output" or out.columns == corpus_pipeline.COLUMNS
        return [tuple(r) for r in out.collect()]

    kept = plainly_accepted(rows, labels)
    assert Counter(stage("quality_classifier", rows)) == Counter(kept) and 0 < len(kept) < len(rows)
    first = plainly_first(kept)
    assert Counter(stage("ngram_jaccard_join", kept)) == Counter(first) and len(first) < len(kept)
    clean = plainly_clean(first, items)
    assert Counter(stage("benchmark_decontamination", first)) == Counter(clean) and len(clean) < len(first)
    # also with the rows that the stages before have left out
    assert Counter(stage("ngram_jaccard_join", rows)) == Counter(plainly_first(rows))
    assert Counter(stage("benchmark_decontamination", rows)) == Counter(plainly_clean(rows, items))

    mixed = stage("source_mixing", clean)
    have, times, size = Counter(clean), Counter(mixed), Counter()
    assert set(times) == set(have) and all(have[r] <= times[r] <= 2 * have[r] for r in have)
    for r in clean:
        size[r[3]] += len(words_of(r[1]))
    largest, smallest = max(size.values()), min(size.values())
    power = min(1.0, np.log(corpus_pipeline.MAX_REPEATS) / np.log(largest / smallest))
    longest = max(len(words_of(r[1])) for r in clean)
    for source, words in size.items():
        spent = sum(len(words_of(r[1])) for r in mixed if r[3] == source)
        due = words * (largest / words) ** power
        assert due - longest - 0.01 * words <= spent <= due + 0.01 * words

    plain = Tokenizer.from_file(str(BPE))

    def coded(r):
        ids = np.array(plain.encode(r[1] or "", add_special_tokens=False).ids + [2], "<u4")
        return r[0], len(ids), zlib.crc32(ids.tobytes())

    want = Counter(coded(r) for r in mixed)
    out = stages["token_output"](spark, spark.createDataFrame(mixed, SCHEMA), folder).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in out) == want
    out = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in out) == want


def test_run_on_empty_tables(spark, tmp_path):
    empty = {"documents": "doc_id long, text string, lang string, source string, n_chars long",
             "labels": "doc_id long, quality long, toxic long", "benchmark": "item_id long, text string"}
    for name, schema in empty.items():
        spark.createDataFrame([], schema).write.parquet(f"file:{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, f"file:{tmp_path}").count() == 0
