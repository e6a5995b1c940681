"""URL rules, conversation tries and ranked search against plain versions, with odd rows."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarline.llm import search, tries, url_rules
from bazaarline.llm.url_rules import Rule

RULES = [Rule("com", "/", "allow"), Rule("example.com", "/en/", "block"), Rule("www.example.com", "/en/", "allow"),
         Rule("net", "/es/", "block"), Rule("net", "/fr/", "block")]


# --- URL rules ---

def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), path


def plain_rule(host, path):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name)) if fits else None


URLS = [None, "", "no scheme", "http://", "http://a.com", "http://a.com/x", "HTTP://A.COM/X?q=1", "https://EXAMPLE.com/en/1",
        "https://www.example.com/en/1", "https://m.www.example.com/en/", "https://www.example.com/en", "http://net/es/?x",
        "http://a.net/es", "http://a.net/fr/1#t", "http://notexample.com/en/", "http://x.org?u=http://a.com/", "a://b://c/d",
        "http://net.org/es/1", "http://é.net/fr/ü%20", "http://a.net/fr/1#t", "http://" + "a." * 400 + "com/" + "b/" * 3000]


def test_given_rules(spark):
    rows = [(i if i else None, u, "clash") for i, u in enumerate(URLS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, `rule.x` string").withColumnRenamed("rule.x", "verdict")
    got = url_rules.judge(pages, RULES).collect()
    assert len(got) == len(URLS)
    by_id = {r.page_id: r for r in got}
    for i, u, _ in rows:
        host, path = plain_parts(u)
        rule, r = plain_rule(host, path), by_id[i]
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.name)
        assert r.verdict == (rule.verdict if rule else r.verdict) and r.verdict in ("allow", "block")
    assert url_rules.judge(pages.limit(0), RULES).count() == 0
    nothing = url_rules.judge(pages, []).collect()  # nothing to learn from either
    assert {(r.rule, r.verdict) for r in nothing} == {(None, "allow")}


def plain_rules(rows, min_support, min_confidence, min_lift):
    """All rules among sets of tokens, by trying all combinations; one that a shorter one covers is left out."""
    n = len(rows)
    least = max(2, math.ceil(min_support * n))
    share = Counter(v for _, v in rows)
    count = Counter(t for s, _ in rows for t in set(s))
    where = {t: frozenset(i for i, (s, _) in enumerate(rows) if t in s) for t in count}
    usable = [t for t in count if least <= count[t] < n]
    first = {t: min(u for u in usable if where[u] == where[t]) for t in usable}
    found = {}
    for s, _ in rows:
        items = sorted(t for t in set(s) if first.get(t) == t)
        for k in range(1, len(items) + 1):
            for combo in itertools.combinations(items, k):
                if combo in found:
                    continue
                covered = [v for s2, v in rows if set(combo) <= set(s2)]
                found[combo] = [(v, c / n, c / len(covered)) for v, c in Counter(covered).items()
                                if c >= least and c / len(covered) >= max(min_confidence, min_lift * share[v] / n)]
    flat = [(combo, *x) for combo, xs in found.items() for x in xs]
    return {r for r in flat if not any(set(o[0]) < set(r[0]) and o[1] == r[1] and o[3] >= r[3] for o in flat)}


@pytest.mark.parametrize("seed", range(2))
def test_mined_rules(spark, seed):
    rng = np.random.RandomState(seed)
    rows = []
    for _ in range(160):
        s = sorted(rng.choice(list("abcdefg"), rng.randint(0, 6), replace=False).tolist())
        s += ["always"] + (["a2"] if "a" in s else [])
        bad = {"a", "b"} <= set(s) or "c" in s and "d" not in s
        rows.append((s, "block" if bad != (rng.rand() < 0.05) else "allow"))
    rows += [(["a", "e", "always", "a2"], "allow")] * 40 + [([], "block")] * 3
    frame = spark.createDataFrame(rows, "tokens array<string>, verdict string").repartition(3)
    got = {(tuple(r.rule_tokens), r.verdict, round(r.support, 9), round(r.confidence, 9)) for r in url_rules.mine(frame, 0.03, 0.75, 1.1).collect()}
    assert got == {(c, v, round(s, 9), round(k, 9)) for c, v, s, k in plain_rules(rows, 0.03, 0.75, 1.1)}
    assert got


def test_verdict_of_the_best_rule(spark):
    urls = [(f"http://h{i % 7}.org/{'bad' if i % 3 == 0 else 'good'}/{i}", "block" if i % 3 == 0 else "allow") for i in range(90)]
    pages = spark.createDataFrame([(1, "http://new.org/bad/5"), (2, "http://new.org/good/5"), (3, "http://new.org/else/5"), (3, "http://new.org/else/5")],
                                  "page_id long, url string")
    got = url_rules.judge(pages, [Rule("com", "/", "allow")], spark.createDataFrame(urls, "url string, verdict string"), min_support=0.05).collect()
    assert sorted((r.page_id, r.verdict, r.mined) for r in got if r.page_id < 3) == [(1, "block", ["p:bad"]), (2, "allow", ["p:good"])]
    assert [(r.verdict, r.mined) for r in got if r.page_id == 3] == [("allow", None)] * 2


def test_long_urls_are_mined_in_spans(spark, monkeypatch):
    monkeypatch.setattr(url_rules, "SPAN", 8)
    long = [f"t{i:03d}" for i in range(60)]
    rows = [(long[: 30 + i % 30] + [f"v{i % 2}"], "block" if i % 2 else "allow") for i in range(60)]
    frame = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    got = {(tuple(r.rule_tokens), r.verdict, r.confidence) for r in url_rules.mine(frame, 0.2, 0.9).collect()}
    assert {(("v1",), "block", 1.0), (("v0",), "allow", 1.0)} <= got


# --- tries ---

def plain_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs[c].append(((turn is not None, turn or 0), role, digest, text))
    convs = {c: [(r, t) for _, r, _, t in sorted(v)] for c, v in convs.items()}
    whole = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = convs.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:]
    members = defaultdict(list)
    for c, path in sorted(whole.items()):
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        size = len(node[-1][1].encode()) if node else 0
        leaves, saved = int(node not in kids), (len(members[node]) - 1) * size
        for k in kids.get(node, []):
            leaves, saved = leaves + totals[k][0], saved + totals[k][1]
        totals[node] = leaves, saved
    ends = lambda node: ",".join(str(c) for c in members[node] if len(whole[c]) == len(node))
    return sorted((members[x][0], len(x), members[x[:-1]][0] if x else -1, len(members[x]), len(kids.get(x, [])), *totals[x],
                   hashlib.sha256(ends(x).encode()).hexdigest()) for x in members)


def run_trie(spark, rows, **conf):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("pos", F.lit("clash")).repartition(3)
    out = tries.conversation_trie(frame, **conf)
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens,
                   r.ends_sha256) for r in out.collect())


@pytest.mark.parametrize("leaf", [1, 16])
def test_trie_of_odd_conversations(spark, leaf):
    rng = np.random.RandomState(leaf)
    rows = [(c, t, ["user", "bot", None][t % 3], f"say {rng.randint(2)}" if rng.rand() < .8 else None)
            for c in range(40) for t in range(rng.randint(1, 9))]
    rows += [(c, t, "user", "same é" if t < 37 else f"{t}") for c in (50, 51, 52, 55, 60) for t in range(37 + c % 3)]  # long and alike
    rows += [(70, None, "user", "first"), (70, 2, "b", "x"), (70, 2, "a", "y"), (70, 2, "a", "y"), (None, 1, "user", "nobody"), (-3, 0, "user", "below"),
             (90, 0, "user", "w " * 20000), (101, 0, "user", "no base")]
    assert run_trie(spark, rows, leaf=leaf) == plain_trie(rows)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    assert run_trie(spark, []) == []
    lone = next(c for c in range(1, 1000) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(lone, 0, "user", "gone")]  # its first turns are those of a conversation that is absent
    assert run_trie(spark, rows) == plain_trie(rows) == [(lone, 0, -1, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]


def test_ends_in_several_stretches(spark, monkeypatch):
    monkeypatch.setattr(tries, "ID_BITS", 2)
    rows = [(5 * c, t, "user", f"t{t}") for c in range(-4, 60) for t in range(3)]
    assert run_trie(spark, rows) == plain_trie(rows)


# --- search ---

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_rank(docs, items, k=10):
    low = lambda t: re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
    bags = [(i, Counter(TERM.findall(low(t)))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, total = len(bags), sum(sum(b.values()) for _, b in bags)
    out = []
    for item, text in items:
        scores = []
        for i, b in bags:
            n, score = sum(b.values()), 0
            for term in set(TERM.findall(low(text))):
                df = sum(1 for _, c in bags if term in c)
                if term in b:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                    m = 100 - 90 + (90 * n * n_docs) // total
                    score += w * ((1000000000 * b[term]) // (1000 * b[term] + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard", [200, search.SHARD_BYTES])
def test_rank_is_that_of_all_scores(spark, monkeypatch, shard):
    rng = np.random.RandomState(5)
    words = [f"w{i}" for i in range(40)] + ["Ünter", "x-y", "end."]
    odds = 1 / np.arange(1, len(words) + 1)
    text = lambda n: " ".join(rng.choice(words, n, p=odds / odds.sum()))
    docs = [(i, text(rng.randint(1, 60))) for i in range(150)]
    docs += [(200, None), (201, ""), (202, " .-! "), (203, text(30000)), (None, "w5 w6 w7"), (204, "w5 w6 w7"), (3, docs[3][1]), (300, docs[4][1]), (2, docs[4][1])]
    items = [(i, text(rng.randint(1, 12))) for i in range(12)] + [(50, None), (51, "..."), (52, "absent"), (53, "w39 ÜNTER"), (None, "w30 w5")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"score": F.lit(1), "a.b": F.lit(2)}).repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit(0))
    monkeypatch.setattr(search, "SHARD_BYTES", shard)
    got = search.rank(frame, bench)
    assert sorted((tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()), key=repr) == plain_rank(docs, items)
    small = search.rank(frame, bench, block_bytes=150)  # several blocks of items
    assert sorted((tuple(r) for r in small.collect()), key=repr) == plain_rank(docs, items)
    assert search.rank(frame.limit(0), bench).count() == 0 and search.rank(frame, bench.limit(0)).count() == 0


def test_accumulators_are_limited(monkeypatch):
    """Common terms after a rare one open no accumulators, and the best documents stay the same."""
    docs = [(i, "rare common" if i < 3 else "common") for i in range(500)]
    import pyarrow as pa
    block = search.prepare([(0, "rare common")])
    tf = np.ones(1, np.int32).tobytes()
    number = {t: int(np.searchsorted(block.known, search.prepare([(0, t)]).known[0])) for t in ("rare", "common")}
    batch = pa.RecordBatch.from_pydict({
        "doc_id": [i for i, _ in docs], "n": [len(t.split()) for _, t in docs],
        "terms": [np.sort(np.array([number[w] for w in t.split()], np.int32)).tobytes() for _, t in docs], "tfs": [tf * len(t.split()) for _, t in docs]})
    block.df, block.n_docs, block.n_terms = np.array([3 if k == number["rare"] else 500 for k in range(2)]), 500, 503
    block.weight = np.array([math.floor(1000 * math.log(1002 / (2 * d + 1))) for d in block.df])
    shard = search.Shard(batch, block)
    at, score = shard.best(np.array([number["rare"], number["common"]]), 2, 0)
    assert at.tolist() == [0, 1, 2] and (score == score[0]).all()
    at, _ = shard.best(np.array([number["rare"], number["common"]]), 2, int(score[0]) + 1)
    assert not len(at)
