"""Language identification by fusing evidence: text, declared language, address suffix and host.

The posterior of a language is the product of

* the likelihood of the text: a multinomial over hashed three-byte sequences, trained on all labelled
  texts, tempered since the sequences overlap;
* the probability of the language declared in the markup, and of the suffix of the address, given
  the language: both estimated from the text posteriors of all pages, smoothed;
* the prior of the host, smoothed towards its parent domain and that towards all rows. Priors are sums
  of text posteriors by grouped aggregation, and leave out the row they are used for.

Rows: null or empty texts have no text evidence; missing or empty declarations, suffixes and hosts
say nothing. Null and repeated ids get a row each. Without labelled texts the language is null.
Further columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .words import buffers, mix, slices

BUCKET_BITS = 16
TEMPER = 1 / 3        # three-byte sequences overlap in two bytes
STRENGTH = 10.0       # rows that a smoothed prior counts as
ALPHA = 0.5
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_LOWER[[9, 10, 11, 12, 13]] = 0x20
_LOWER[[x for x in range(0x21, 0x41)] + [0x5B, 0x5C, 0x5D, 0x5E, 0x5F, 0x60, 0x7B, 0x7C, 0x7D, 0x7E]] = 0x20


def _sequences(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all three-byte sequences of the texts (letters lower-cased, other ASCII as a space;
    runs of spaces say nothing), and the text of each."""
    raw, offs = buffers(texts)
    raw = _LOWER[raw]
    n = len(raw)
    if n < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = (raw[:-2].astype(np.uint64) << np.uint64(16)) | (raw[1:-1].astype(np.uint64) << np.uint64(8)) | raw[2:]
    inside = np.ones(n - 2, bool)
    for back in (1, 2):
        edge = offs[1:-1] - back
        inside[edge[(edge >= 0) & (edge < n - 2)]] = False
    inside &= ~((raw[1:-1] == 0x20) & ((raw[:-2] == 0x20) | (raw[2:] == 0x20)))
    at = np.flatnonzero(inside)
    return (mix(code[at]) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), np.searchsorted(offs, at, "right") - 1


# training ----------------------------------------------------------------------------------

def train(texts: DataFrame, lang: str = "lang", text: str = "text") -> tuple[list[str], np.ndarray]:
    """Languages, and log probabilities of the buckets under each: ``2 ** BUCKET_BITS`` numbers a language.

    Every task adds up its own counts; the sums are grouped by language and part of the table.
    """
    width = 1 << (BUCKET_BITS - 4)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in slices(batches, "text"):
            bucket, doc = _sequences(batch.column("text"))
            names = batch.column("lang").dictionary_encode()
            kind = names.indices.to_numpy()[doc]
            for i, name in enumerate(names.dictionary.to_pylist()):
                got = np.bincount(bucket[kind == i], minlength=1 << BUCKET_BITS)
                sums[name] = sums[name] + got if name in sums else got
        for name, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * 16), pa.array(np.arange(16, dtype=np.int32)),
                 pa.array([total[k * width:(k + 1) * width].astype(np.int64).tobytes() for k in range(16)], pa.binary())],
                names=["lang", "part", "counts"])

    def add(frame):
        total = np.sum([np.frombuffer(x, np.int64) for x in frame["counts"]], axis=0)
        return frame.iloc[:1].assign(counts=[total.tobytes()])

    schema = "lang string, part int, counts binary"
    rows = texts.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text")) \
        .mapInArrow(count, schema).groupBy("lang", "part").applyInPandas(add, schema).collect()
    langs = sorted({r.lang for r in rows})
    counts = np.zeros((len(langs), 1 << BUCKET_BITS))
    for r in rows:
        counts[langs.index(r.lang), r.part * width:(r.part + 1) * width] = np.frombuffer(r.counts, np.int64)
    counts += ALPHA
    return langs, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def with_likelihood(rows: DataFrame, model: np.ndarray, text: str = "text") -> DataFrame:
    """``rows`` with ``ll``, the tempered log likelihood of the text under each language, for the text."""
    others = [c for c in rows.columns if c != text]
    schema = rows.select(*others, F.array(F.lit(0.0)).alias("ll")).schema
    table = rows.sparkSession.sparkContext.broadcast(np.ascontiguousarray(model.T))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = table.value
        width = logs.shape[1]
        for batch in slices(batches, "__text", 1 << 20):
            bucket, doc = _sequences(batch.column("__text"))
            got = np.column_stack([np.bincount(doc, logs[bucket, k], batch.num_rows) for k in range(width)]) * TEMPER
            got -= got.max(axis=1, keepdims=True)
            ll = pa.ListArray.from_arrays(pa.array(np.arange(0, got.size + 1, width), pa.int32()), pa.array(got.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), ll], names=[*others, "ll"])

    return rows.select(*others, F.col(text).alias("__text")).mapInArrow(run, schema)


# pages ---------------------------------------------------------------------------------------

_DROP = re.compile(r"<(script|style|nav|footer|aside|noscript)\b.*?</\1\s*>|<!--.*?-->", re.S | re.I)
_AD = re.compile(r'<div class="ad">.*?</div>', re.S | re.I)
_HIDDEN = re.compile(r"<(script|style)\b.*?</\1\s*>|<!--.*?-->", re.S | re.I)
_MAIN = re.compile(r"<(/?)(article|main)(?=[\s/>])[^>]*>", re.I)
_TAG = re.compile(r"<[^>]*>")


def _mains(source: str) -> Iterator[str]:
    """What the outermost articles of a page hold, with those inside them; an open one runs to the end."""
    inside, begin = [], 0
    for tag in _MAIN.finditer(source):
        name = tag[2].lower()
        if not tag[1]:
            begin = begin if inside else tag.end()
            inside.append(name)
        elif name in inside:
            while inside.pop() != name:
                pass
            if not inside:
                yield source[begin:tag.start()]
    if inside:
        yield source[begin:]


def page_text(source: str | None) -> str:
    """The readable text of a page: its articles where it marks some, without navigation and markup."""
    source = _HIDDEN.sub(" ", source or "")
    body = " ".join(_mains(source)) or source
    return entities.unescape(_TAG.sub(" ", _AD.sub(" ", _DROP.sub(" ", body)))).strip()


def page_evidence(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(id, text, declared, suffix, host, parent) of every page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = pa.array([page_text(x) for x in batch.column("html").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("id"), texts, batch.column("declared"), batch.column("host")],
                                             names=["id", "text", "declared", "host"])

    some = lambda c: F.when(c != "", c)
    declared = some(F.lower(F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-z]{2,3})\b", 1)))
    host = some(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)))
    rows = pages.select(F.col(page_id).cast("long").alias("id"), F.col(html).alias("html"), declared.alias("declared"),
                        host.alias("host")).mapInArrow(run, "id long, text string, declared string, host string")
    labels = F.split("host", r"\.")
    return rows.withColumn("suffix", F.when(F.size(labels) > 1, F.element_at(labels, -1))) \
        .withColumn("parent", F.when(F.size(labels) > 2, F.array_join(F.slice(labels, F.lit(2), F.size(labels) - 1), "."))
                    .otherwise(F.col("host")))


def plain_evidence(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Documents as rows of evidence: nothing is declared, and the source stands for the host."""
    none = F.lit(None).cast("string")
    return docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"), none.alias("declared"),
                       F.col(source).cast("string").alias("host"), none.alias("suffix"), F.col(source).cast("string").alias("parent"))


# fusing --------------------------------------------------------------------------------------

def _normal(logs: list[Column]) -> list[Column]:
    top = F.greatest(*logs) if len(logs) > 1 else logs[0]
    mass = [F.exp(x - top) for x in logs]
    total = sum(mass[1:], mass[0])
    return [m / total for m in mass]


def fuse(evidence: DataFrame, langs: list[str], strength: float = STRENGTH) -> DataFrame:
    """``evidence`` (with ``ll``; ``kind`` keeps tables apart) with ``lang``, ``probability`` and ``text_lang``.

    All tables of counts are grouped sums of text posteriors; rows are joined to them by key, and a key
    with very many rows is combined before the shuffle and split by adaptive execution in the join.
    """
    many = range(len(langs))
    p = [F.col(f"__p{i}") for i in many]
    text_part = _normal([F.element_at("ll", i + 1) for i in many])
    rows = evidence.select("*", *[c.alias(f"__p{i}") for i, c in enumerate(text_part)])
    rows = materialise(rows, "language-evidence")

    def sums(keys: list[str], name: str) -> DataFrame:
        return materialise(rows.dropna(subset=keys[1:]).groupBy(*keys).agg(
            *[F.sum(c).alias(f"__{name}{i}") for i, c in enumerate(p)]), f"language-{name}")

    total = sums(["kind"], "all")
    out = rows.join(total, "kind", "left")
    for name, key in (("declared", "declared"), ("suffix", "suffix"), ("parent", "parent"), ("host", "host")):
        out = out.join(sums(["kind", key], name), ["kind", key], "left")
    kinds = {name: rows.dropna(subset=[name]).groupBy("kind").agg(F.count_distinct(name).alias(f"__n_{name}"), *[
        F.sum(c).alias(f"__of_{name}{i}") for i, c in enumerate(p)]) for name in ("declared", "suffix")}
    for name, small in kinds.items():
        out = out.join(F.broadcast(small), "kind", "left")  # one row per kind

    def held(name: str, i: int) -> Column:
        """Rows of the key that count for language i, without this row."""
        return F.greatest(F.lit(0.0), F.coalesce(F.col(f"__{name}{i}"), p[i]) - p[i])

    def size(name: str) -> Column:
        return sum([held(name, i) for i in many][1:], held(name, 0))

    def prior(i: int) -> Column:
        every = (held("all", i) + 1.0) / (size("all") + float(len(langs)))
        parent = F.when(F.col("parent").isNull(), every).otherwise(
            (held("parent", i) + strength * every) / (size("parent") + strength))
        return F.when(F.col("host").isNull(), parent).otherwise((held("host", i) + strength * parent) / (size("host") + strength))

    def given(name: str, i: int) -> Column:
        """Probability of the declared value or suffix, given language i."""
        n = F.col(f"__n_{name}")
        of = F.greatest(F.lit(0.0), F.coalesce(F.col(f"__of_{name}{i}"), p[i]) - p[i])
        return F.when(F.col(name).isNull(), 1.0).otherwise((held(name, i) + ALPHA) / (of + ALPHA * n))

    logs = [F.element_at("ll", i + 1) + F.log(prior(i)) + F.log(given("declared", i)) + F.log(given("suffix", i)) for i in many]
    scored = out.select(*evidence.columns, F.array(*p).alias("__text"), F.array(*logs).alias("__logs")) \
        .withColumn("__top", F.array_max("__logs"))
    names = F.array(*[F.lit(x) for x in langs])
    total_mass = F.aggregate("__logs", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("__top")))
    return scored.select(
        *[c for c in evidence.columns if c != "ll"],
        F.element_at(names, F.array_position("__logs", F.col("__top")).cast("int")).alias("lang"),
        (F.lit(1.0) / total_mass).alias("probability"),
        F.element_at(names, F.array_position("__text", F.array_max("__text")).cast("int")).alias("text_lang"))


def identify(labelled: DataFrame, evidence: DataFrame, lang: str = "lang", text: str = "text",
             strength: float = STRENGTH) -> DataFrame:
    """Train on ``labelled`` and give every row of ``evidence`` its language (see ``fuse``)."""
    langs, model = train(labelled, lang, text)
    if not langs:
        none = F.lit(None)
        return evidence.drop("text").withColumns({"lang": none.cast("string"), "probability": none.cast("double"),
                                                  "text_lang": none.cast("string")})
    return fuse(with_likelihood(evidence, model), langs, strength)
