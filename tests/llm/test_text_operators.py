"""Each text operator against a plain version on small tables, with nulls, ties, empty and odd rows."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bazaarline.llm import fingerprints, jaccard, language, leaks, lines, marks, mixing, parts, quality, repeats, shards, tokens
from bazaarline.llm.components import components
from bazaarline.llm.words import Words, shingles, windows

BPE = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words_of(text, lower=False):
    if lower:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x20\x09-\x0D]+", text or "")


def passage(seed, n):
    rng = np.random.RandomState(seed)
    return ["".join(rng.choice(list("abcdefghij"), rng.randint(2, 9))) for _ in range(n)]


def near(words, seed, edits):
    rng, out = np.random.RandomState(seed), list(words)
    for _ in range(edits):
        out[rng.randint(len(out))] = f"x{rng.randint(10**6)}"
    return out


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows and ids, exact and near copies."""
    base, shared = passage(1, 120), passage(2, 60)
    texts = [" ".join(base), " ".join(near(base, 5, 2)), " ".join(near(base, 6, 3)), " ".join(base).upper(), None, "", " \n\t ",
             "one two", "One  two", "one two three four", " ".join(passage(3, 30) + shared + passage(4, 20)),
             " ".join(passage(7, 10) + shared), " ".join(shared + passage(8, 200)), "the the " * 400, "é漢 😀 " * 3,
             "A shared line here\nother\n\nA shared line here\r\n", "a SHARED line here  \nmine only line", "short\nshort",
             " ".join(passage(9, 30_000)), " ".join(passage(9, 29_999)), "x" * 50_000]
    rows = [(i * 3 + 1, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, None) for i, t in enumerate(texts)]
    rows += [(None, " ".join(base), "en", "s1", 1), (None, None, None, None, None), rows[0], (4, "another text under an id", "de", "s2", 5)]
    return rows


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts).withColumn("label", F.lit(7)).withColumn("score", F.lit("x"))


# helpers -----------------------------------------------------------------------------------

@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\tQ漢 ", max_size=30)), max_size=8))
def test_words_and_windows(texts):
    w = Words(pa.array(texts, pa.string()))
    want = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for t in texts]
    got = [[w.raw[a:b].tobytes() for a, b in zip(w.start[i:j], w.end[i:j], strict=True)] for i, j in zip(w.of, w.of[1:], strict=False)]
    assert got == want
    hashes, at = windows(w.hashes(), w.of, 3)
    known = {}
    flat = [x for t in want for x in t]
    for h, p in zip(hashes.tolist(), at.tolist(), strict=True):
        assert known.setdefault(h, tuple(flat[p:p + 3])) == tuple(flat[p:p + 3])
    assert len(hashes) == sum(max(0, len(t) - 2) for t in want)
    _, of = shingles(w, 3)
    assert np.diff(of).tolist() == [len({tuple(t[i:i + 3]) for i in range(max(1, len(t) - 2))}) if t else 0 for t in want]


def test_components(spark):
    rng = np.random.RandomState(0)
    links = [(int(a), int(b)) for a, b in rng.randint(0, 300, (150, 2))] + [(1000 + i, 1001 + i) for i in range(40)]
    links += [(5000, 5001 + i) for i in range(60)] + [(7, 7)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.label for r in got} == {x: find(x) for x in list(parent)}
    assert len(got) == len(parent)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# 1 token output ------------------------------------------------------------------------------

@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**31 - 1), max_size=200), st.integers(1, 32))
def test_packing_round_trip(values, bits):
    ids = np.array(values, np.uint32) & np.uint32((1 << bits) - 1)
    assert (tokens.unpack(tokens.pack(ids, bits), bits, len(ids)) == ids).all()
    assert len(tokens.pack(ids, bits)) == (len(ids) * bits + 7) // 8


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*"aB'1%é漢　\u0085\x1c \n\t", "'s", "<|endoftext|>", "😀", "  ", "don't"]), max_size=25)
                .map("".join), max_size=6))
def test_encoder_equals_the_library(texts):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(str(BPE))
    ids, sizes = tokens.encoder(str(BPE), False).encode(pa.array(texts, pa.string()), 2)
    want = [plain.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert sizes.tolist() == [len(x) for x in want]
    assert ids.tolist() == [i for x in want for i in x]


def test_token_files(spark, odd_docs, tmp_path):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(str(BPE))
    manifest = tokens.write_tokens(frame(spark, odd_docs), str(BPE), f"file:{tmp_path}/out", 2, block_ids=1024)
    got = tokens.read_tokens(manifest).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r[0] for r in odd_docs), key=lambda x: (x is not None, x or 0))
    code = lambda t: np.array(plain.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter(
        (r[0], len(code(r[1])), zlib.crc32(code(r[1]).tobytes())) for r in odd_docs)
    assert [r.start for r in got] == np.r_[0, np.cumsum([r.n_tokens for r in got])[:-1]].tolist()
    by_id = {r[0]: r[1] for r in odd_docs if r[0] not in (None, 4)}
    for r in got:  # random access by document and by token
        if r.doc_id in by_id:
            file, ids = tokens.TokenFile(r.file), code(by_id[r.doc_id])
            assert file.meta["bits"] == 16 and (file.document(r.number) == ids).all()
            first = int(file.first[r.number])
            assert (file.tokens(first + len(ids) // 2, first + len(ids)) == ids[len(ids) // 2:]).all()
            file.close()
    assert tokens.read_tokens(tokens.write_tokens(frame(spark, []), str(BPE), f"file:{tmp_path}/none")).count() == 0


# 2 Jaccard join --------------------------------------------------------------------------------

def shingle_set(text):
    w = words_of(text, lower=True)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if a and sets[j] and 100 * shared >= 75 * (len(a) + len(sets[j]) - shared):
                x, y = find(i), find(j)
                if x != y:
                    parent[max(x, y, key=lambda k: rows[k][0])] = min(x, y, key=lambda k: rows[k][0])
    least = {}
    for i, r in enumerate(rows):
        least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return Counter((r[0], len(sets[i]), least[find(i)]) for i, r in enumerate(rows))


def test_jaccard_on_odd_rows(spark, odd_docs):
    got = Counter(map(tuple, jaccard.jaccard_components(frame(spark, odd_docs)).collect()))
    named = [(r[0], r[1]) for r in odd_docs if r[0] is not None]
    assert got == brute_components(named) + Counter([(None, 116, None), (None, 0, None)])
    assert jaccard.jaccard_components(frame(spark, [])).count() == 0


@pytest.mark.parametrize("sizes", [{}, {"tile": 2, "block": 5}])
def test_jaccard_near_the_threshold(spark, sizes):
    rows, k = [], 0
    for group in range(12):
        base = passage(100 + group, 12 + 17 * group)
        for copy in range(9):
            rows.append((k * 7 % 1009, " ".join(near(base, k, copy // 2))))
            k += 1
    hot = passage(77, 45)  # a passage of many documents that are otherwise unlike
    rows += [(2000 + i, " ".join(hot + passage(900 + i, 20 + i))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert Counter(map(tuple, jaccard.jaccard_components(docs, **sizes).collect())) == brute_components(rows)
    heads = {c for _, _, c in brute_components(rows)}
    assert {r.doc_id for r in jaccard.one_per_component(docs).collect()} == heads


def test_pairs_count_their_tiles():
    rng = np.random.default_rng(7)
    x, y = rng.integers(0, 12, 400), rng.integers(12, 24, 400)
    met = np.where(rng.random(400) < 0.1, jaccard.COMMON, 1)
    want = Counter()
    for a, b, m in zip(x.tolist(), y.tolist(), met.tolist(), strict=True):
        want[a, b] += m
    # two packets and their sum, either way round
    packets = [jaccard._packet(0, x[:150], y[:150], met[:150], 3), jaccard._packet(0, y[150:], x[150:], met[150:], 3)]
    parts = [(np.frombuffer(p, np.int64).reshape(-1, 2), np.frombuffer(m, np.uint8)) for packet in packets
             for p, m in zip(packet.column("pairs").to_pylist(), packet.column("met").to_pylist(), strict=True)]
    pair, got = jaccard._counted(np.concatenate([p for p, _ in parts]), np.concatenate([m for _, m in parts]))
    assert dict(zip(map(tuple, pair.tolist()), got.tolist(), strict=True)) == {k: min(v, jaccard.COMMON) for k, v in want.items()}
    assert len(jaccard._counted(np.zeros((0, 2), np.int64), np.zeros(0, np.uint8))[0]) == 0


def test_chance_tiles_tie_no_families(spark):
    """Five texts of a large tile that are in it alone, three that share four; a pair of three small tiles and one large, one of two and one."""
    rows = [(1, f, 100, f, 1) for f in range(10, 15)]
    rows += [(tile, f, 100, f, 4) for tile in range(2, 6) for f in (20, 21, 22)]
    rows += [(tile, f, 100, f, 1) for tile in (6, 7, 8) for f in (10, 11)] + [(tile, f, 100, f, 1) for tile in (9, 10) for f in (12, 13)]
    named = spark.createDataFrame(rows, "tile long, f long, n long, label long, wides long")
    pairs, edges = jaccard.open_tiles(named, 3, most=2)
    assert {tuple(r) for r in pairs.collect()} == {(10, 11)}
    assert {tuple(r) for r in edges.collect()} - {(20, 20)} == {(20, 21), (20, 22)}


def test_frequent_shingles_rank_last(spark):
    """In a large corpus a shingle of 100 texts hardly lifts its counter: it still comes behind nearly all others."""
    size = 1 << jaccard.SKETCH_BITS
    counts = np.random.default_rng(3).poisson(1300, size)
    counts[12345] = 1300 + 150
    parts = [(1, k, jaccard._deflated(part)) for half in (counts // 2, counts - counts // 2) for k, part in enumerate(half.reshape(16, -1))]
    ranks, levels = jaccard._levels(spark.createDataFrame(parts, "kind int, n long, counts binary"))
    assert ranks.dtype == levels.dtype == np.uint8 and len(ranks) == len(levels) == size
    assert ranks[12345] >= 254 and (np.diff(ranks[np.argsort(counts)].astype(int)) >= 0).all()


def test_marks_leave_out_other_rows(spark):
    keys = spark.createDataFrame([(3 * k,) for k in range(700)] + [(None,), (-5,)], "k long")
    rows = spark.createDataFrame([(k, f"t{k}") for k in range(-20, 20_000)] + [(None, "none")], "doc_id long, text string")
    wanted = {r.k for r in keys.collect()} - {None}
    near, rest = (f(rows, "doc_id", keys) for f in (marks.possible, marks.surely_not))
    found, others = [r.doc_id for r in near.collect()], [r.doc_id for r in rest.collect()]
    assert wanted <= set(found) and not wanted & set(others) and None in others
    assert sorted(found + others, key=str) == sorted([r.doc_id for r in rows.collect()], key=str)
    assert len(found) < len(wanted) + 0.12 * 20_000
    assert marks.possible(rows, "doc_id", keys.where("k < -10")).count() == 0


def test_bitmaps_bound_the_overlap():
    a, b = " ".join(passage(1, 300)), " ".join(near(passage(1, 300), 3, 12) + passage(5, 400))
    values, of = shingles(Words(pa.array([a, b])))
    bits, at = jaccard._bitmaps(values, of)
    differ = jaccard._xor_bits(bits[at[0]:at[1]].tobytes(), bits[at[1]:at[2]].tobytes())
    shared = len(np.intersect1d(values[:of[1]], values[of[1]:]))
    assert shared <= (of[2] - differ) / 2


# 3 fingerprints --------------------------------------------------------------------------------

def test_edited_fingerprints(spark, odd_docs):
    rows = sorted({r[0]: r for r in odd_docs if r[0] not in (None, 4)}.values())
    got = {r.doc_id: r for r in fingerprints.compare_edited(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, row in enumerate(rows):
        text, following = row[1] or "", rows[(i + 1) % len(rows)][1] or ""
        cut = len(text) // 4
        edited = text[:len(text) - cut] + following[:cut]
        r = got[row[0]]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        for other, near_ in ((edited, r.near_edited), (following, r.near_next)):
            a, b = shingle_set(text), shingle_set(other)
            true = len(a & b) / len(a | b) if a | b else 1.0
            assert abs(near_ - true) < 0.2
    twice = fingerprints.compare_edited(frame(spark, odd_docs)).collect()
    assert Counter(r.doc_id for r in twice) == Counter(r[0] for r in odd_docs)
    assert fingerprints.compare_edited(frame(spark, [])).count() == 0
    assert fingerprints.compare_edited(frame(spark, rows[:1])).first().near_next == 1.0


def test_sketches_merge_and_estimate(spark):
    left, right = passage(1, 3000), passage(1, 1500) + passage(2, 1500)
    a, b, both = fingerprints.sketches(pa.array([" ".join(left), " ".join(right), " ".join(left[:1500])]))
    assert abs(fingerprints.distinct_shingles(a) / 2996 - 1) < 0.3
    assert abs(fingerprints.containment(both, a) - 1) < 0.25 and abs(fingerprints.resemblance(a, b) - 1 / 3) < 0.15
    assert (fingerprints.from_text(fingerprints.to_text(a)) == a).all()
    parts = [("k", " ".join(left[i * 500:i * 500 + 504])) for i in range(6)] + [(None, None), ("e", "")]
    made = fingerprints.fingerprints(spark.createDataFrame(parts, "key string, text string").repartition(3))
    merged = {r.key: r.fingerprint for r in fingerprints.merge_fingerprints(made, "key").collect()}
    assert merged == {"k": fingerprints.to_text(a), None: "", "e": ""}


# 4 quality ---------------------------------------------------------------------------------------

def test_quality_on_the_held_out_fold(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet").join(labels.select("doc_id"), "doc_id")
    got = quality.score_documents(docs, labels).join(labels, "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(d).encode()) % 5 == 0 for d in got.doc_id]).all()
    held = got[got.held_out]
    assert (held.predicted == held.quality).mean() > 0.98
    assert (held[held.quality == 1].predicted == 1).mean() > 0.99
    assert ((got.score >= 0) & (got.score <= 1)).all() and (got.predicted == (got.score >= 0.3)).all()


def test_quality_on_odd_rows(spark, odd_docs):
    docs = frame(spark, odd_docs)
    few = spark.createDataFrame([(1, 1, 0), (4, None, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    got = quality.score_documents(docs, few).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in odd_docs)
    assert len({r.score for r in got}) == 1  # one class only: the prior
    both = spark.createDataFrame([(i * 3 + 1, i % 2, 0) for i in range(21)] + [(1, 0, 0)], "doc_id long, quality int, toxic int")
    again = quality.score_documents(docs, both).collect()
    assert all(0 <= r.score <= 1 for r in again) and len(again) == len(odd_docs)
    kept = quality.accepted(docs, both)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in again)
    assert quality.score_documents(frame(spark, []), both).count() == 0


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(map(tuple, quality.score_documents(docs, x).collect())) for x in (labels, flipped))
    assert [x[:2] + x[3:] for x in a] == [x[:2] + x[3:] for x in b]
    assert np.allclose([x[2] for x in a], [x[2] for x in b])


# 5 substring dedup -------------------------------------------------------------------------------

def brute_repeats(rows, length=50):
    first = {}
    for d, t in rows:
        w = words_of(t)
        for i in range(len(w) - length + 1):
            key = tuple(w[i:i + length])
            if d is not None:
                first[key] = min(first.get(key, d), d)
    out = Counter()
    for d, t in rows:
        w = words_of(t)
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if d is not None and first[tuple(w[i:i + length])] < d:
                gone[i:i + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def test_repeats(spark, odd_docs):
    shared, rows = passage(50, 300), [(r[0], r[1]) for r in odd_docs]
    for i in range(40):  # passages of 45 to 84 words at every offset, in either order
        rows.append((500 - i, " ".join(passage(200 + i, i) + shared[i * 3:i * 3 + 45 + i] + passage(300 + i, 13))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = repeats.cut_repeats(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_repeats(rows)
    for r in got:
        assert sum(s.end - s.start for s in r.spans or []) == r.n_removed
    assert repeats.cut_repeats(frame(spark, [])).count() == 0


# 6 line dedup ------------------------------------------------------------------------------------

def brute_lines(rows, least=10):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip("\x20\x09\x0a\x0b\x0c\x0d"))

    first = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            if d is not None and len(key(line)) >= least:
                first[key(line)] = min(first.get(key(line), d), d)
    out = Counter()
    for d, t in rows:
        every = (t or "").split("\n")
        kept = [x for x in every if d is None or first.get(key(x), d) >= d]
        out[d, len(every), len(every) - len(kept), "\n".join(kept)] += 1
    return out


@pytest.mark.parametrize("hot", [1_000, 0])
def test_lines(spark, odd_docs, hot):
    rows = [(r[0], r[1]) for r in odd_docs] + [(i % 50 + 200, f"common line É {i % 3}\n\n own {i} line of text\nÀ COMMON line É") for i in range(120)]
    rows += [(400, "\n".join(f"line number {i % 90}" for i in range(200))), (401, "\n".join(f"LINE number {i}\r" for i in range(0, 300, 2)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).withColumn("keep", F.lit(1))
    got = lines.dedup_lines(docs, hot_rows=hot)
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in got.collect()) == brute_lines(rows)
    assert lines.dedup_lines(frame(spark, [])).count() == 0


# 7 decontamination -------------------------------------------------------------------------------

def brute_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.lists(st.integers(0, 3), max_size=14))
def test_edit_distance(item, text):
    cost, start, end = parts.edit_distance(np.array(item, np.uint64), np.array(text, np.uint64))
    assert cost == brute_distance(item, text)
    assert 0 <= start <= end <= len(text) and brute_distance(item, text[start:end]) <= cost


def test_leaks(spark, odd_docs):
    items = [(i, " ".join(passage(1000 + i, 12 + i))) for i in range(40)] + [(90, None), (91, ""), (92, "too short"), (93, " ".join(passage(1000, 12)))]
    rows, want = [(r[0], r[1]) for r in odd_docs], set()
    for i in range(40):
        words = passage(1000 + i, 12 + i)
        edited = near(words, i, int(0.1 * len(words)))
        rows.append((1000 + i, " ".join(passage(i, 80) + edited + passage(i + 1, 30))))
        want |= {(1000 + i, k) for k, t in items if t and k < 90 and brute_distance(words_of(t), edited) <= int(leaks.RATE * len(words_of(t)))}
    want.add((1000, 93))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in leaks.find_leaks(docs, bench).collect()}
    assert set(got) <= want and len(got) >= 0.95 * len(want)
    for (d, k), r in got.items():
        text = words_of(dict(rows)[d])[r.start:r.start + r.n_words]
        assert brute_distance(words_of(dict(items)[k]), text) <= r.distance <= int(leaks.RATE * len(words_of(dict(items)[k])))
    in_blocks = {(r.doc_id, r.item_id) for r in leaks.find_leaks(docs, bench, block_bytes=600).collect()}
    assert len(in_blocks) >= 0.95 * len(want) and in_blocks <= want
    clean = leaks.without_leaks(docs, bench)
    assert Counter(r.doc_id for r in clean.collect()) == Counter(d for d, _ in rows if d not in {d for d, _ in got})
    assert leaks.find_leaks(frame(spark, []), bench).count() == 0
    assert leaks.find_leaks(docs, spark.createDataFrame([], "item_id long, text string")).count() == 0


# 8 sharding --------------------------------------------------------------------------------------

@pytest.mark.parametrize("rows", [1, 2, 3, 5, 8, 100, 1000])
def test_permutation(spark, rows):
    got = spark.range(rows).select("id", shards.permute(F.col("id"), rows, 3).alias("p")) \
        .withColumn("back", shards.permute(F.col("p"), rows, 3, backwards=True)).collect()
    assert sorted(r.p for r in got) == list(range(rows)) and all(r.id == r.back for r in got)
    if rows == 1000:
        assert sum(r.id == r.p for r in got) < 20


def test_shards(spark, odd_docs):
    got = shards.shard_rows(frame(spark, odd_docs), 8).collect()
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) <= set(range(8))
    for s in sizes:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in odd_docs)
    again = shards.shard_rows(frame(spark, odd_docs, 5), 8).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    assert shards.shard_rows(frame(spark, []), 8).count() == 0


# 9 mixing ----------------------------------------------------------------------------------------

def corpus(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 7)), "en", "big" if i % 3 else f"s{i % 5}", 0) for i in range(3000)]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(4)


def test_mixing_meets_entropy_and_budget(spark):
    rows, docs = corpus(spark)
    mixed, sources = mixing.mix_sources(docs, min_entropy=0.9, block_tokens=300)
    table = {r["__src"]: r for r in sources.collect()}
    tokens_of = Counter()
    for r in rows:
        tokens_of["=" + r[3]] += len(r[1].split())
    assert {k: v.tokens for k, v in table.items()} == tokens_of
    weight = np.array([r.weight for r in table.values()])
    entropy = -(weight * np.log(weight)).sum() / np.log(len(weight))
    assert abs(weight.sum() - 1) < 1e-9 and abs(entropy - 0.9) < 1e-6
    share = np.array([r.share for r in table.values()])
    assert np.allclose(weight, share ** list(table.values())[0].exponent / (share ** list(table.values())[0].exponent).sum())
    spent = Counter()
    got = mixed.collect()
    assert len(got) == len(rows)
    for r in got:
        spent["=" + r.source] += r.passes * r.n_tokens
        assert r.passes in (table["=" + r.source].whole, table["=" + r.source].whole + 1)
    for k, r in table.items():
        assert -7 <= spent[k] - r.budget <= 1e-6
    turns = mixing.schedule(mixed).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max("pass").alias("last")).collect()
    assert {r.doc_id: r.n for r in turns} == {r.doc_id: r.passes for r in got if r.passes} and all(r.n == r.last for r in turns)


def test_mixing_covers_within_repeats(spark):
    rows, docs = corpus(spark)
    mixed, sources = mixing.mix_sources(docs, max_repeats=1.5, cover=True, block_tokens=200)
    assert mixed.agg(F.min("passes")).first()[0] == 1 and mixed.agg(F.max("passes")).first()[0] == 2
    due = [r.budget / r.tokens for r in sources.collect()]
    assert abs(min(due) - 1) < 1e-6 and abs(max(due) - 1.5) < 1e-5


def test_mixing_odd_rows(spark, odd_docs):
    docs = frame(spark, odd_docs)
    mixed, _ = mixing.mix_sources(docs, min_entropy=0.5)
    assert Counter(r.doc_id for r in mixed.collect()) == Counter(r[0] for r in odd_docs)
    assert {(r.text, r.n_tokens) for r in mixed.collect()} == {(r[1], len(words_of(r[1]))) for r in odd_docs}
    assert mixing.mix_sources(frame(spark, []), min_entropy=0.5)[0].count() == 0
    with pytest.raises(ValueError, match="one of"):
        mixing.solve_exponent(docs, 0.5, 2.0)


# 10 language -------------------------------------------------------------------------------------

def test_language_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    even = F.col("doc_id") % 2 == 0
    got = language.identify(docs.where(even), language.plain_evidence(docs.where(~even)).withColumn("kind", F.lit("d"))) \
        .join(docs.select(F.col("doc_id").alias("id"), F.col("lang").alias("truth")), "id").collect()
    assert sum(r.lang == r.truth for r in got) / len(got) > 0.98


def test_other_evidence_decides_where_the_text_says_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.lang: r.text for r in docs.where("n_chars > 500").collect()}
    page = lambda lang, host, body: (f"https://{host}/x", f'<html lang="{lang}"><script>der die das</script><nav>the of and</nav><p>{body}</p></html>')
    rows = [page("de", "a.haus.de", texts["de"]) for _ in range(30)] + [page("fr", "b.site.fr", texts["fr"]) for _ in range(30)]
    rows += [page("de", "a.haus.de", ""), page("fr", "c.site.fr", "12 34"), ("not an address", None), (None, "<p></p>"), page("de", "b.site.fr", texts["fr"])]
    pages = spark.createDataFrame([(i if i != 3 else None, *r) for i, r in enumerate(rows)], "page_id long, url string, html string") \
        .withColumn("lang", F.lit("zz"))
    evidence = language.page_evidence(pages).withColumn("kind", F.lit("p"))
    got = {r.id: r for r in language.identify(docs, evidence).collect()}
    assert len(got) == len(rows)
    assert got[60].lang == "de" and got[61].lang == "fr" and got[64].lang == "fr"
    assert all(0 < r.probability <= 1 for r in got.values()) and got[61].host == "c.site.fr" and got[61].suffix == "fr"
    none = language.identify(docs.where("false"), evidence).collect()
    assert len(none) == len(rows) and all(r.lang is None for r in none)
    assert language.identify(docs, evidence.where("false")).count() == 0


def test_host_priors_by_hand(spark):
    ll = lambda p: [float(np.log(p)), float(np.log(1 - p))]
    rows = [(1, "k", None, "h.x.org", None, "x.org", ll(0.9)), (2, "k", None, "h.x.org", None, "x.org", ll(0.8)),
            (3, "k", None, None, None, None, ll(0.5))]
    evidence = spark.createDataFrame(rows, "id long, kind string, declared string, host string, suffix string, parent string, ll array<double>")
    got = {r.id: r for r in language.fuse(evidence, ["a", "b"], strength=2.0).collect()}
    every = (0.8 + 0.5 + 1) / (2 + 2)
    parent = (0.8 + 2 * every) / 3
    host = (0.8 + 2 * parent) / 3
    a, b = 0.9 * host, 0.1 * (1 - host)
    assert got[1].lang == "a" and abs(got[1].probability - a / (a + b)) < 1e-9
