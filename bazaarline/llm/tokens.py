"""Token-ID output: ids packed in the fewest bits of the vocabulary, in files with block offsets.

A file holds the documents of one range of ids, in ascending order::

    magic | blocks | index | footer (JSON) | footer length (4 bytes) | magic

Every block packs ``block_ids`` ids (the last one fewer), each in ``bits`` bits, most
significant bit first. The index holds the byte offset of every block, the id and the first
token of every document. A range of tokens is read with the blocks that cover it, and a block is
unpacked by numpy as a whole.

Rows: a null text is empty (only the end id); a null ``doc_id`` sorts first; rows that repeat an
id are kept, ordered by a hash of the text. Further columns are ignored. An empty table writes
no document and gives an empty manifest or only empty files.

Tasks write under names of their own attempt, and only the manifest, which Spark commits, says
which files count: a lost executor leaves a file nobody reads.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .words import buffers, runs, slices, spans

MAGIC = b"BZTOKEN1"
BLOCK_IDS = 65_536  # a multiple of 8, so that blocks end on whole bytes
CACHED_SEGMENTS = 1_500_000
SLICE = 8 << 20


# packing ---------------------------------------------------------------------------------

def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids in ``bits`` bits each, padded with zero bits to a whole byte."""
    if bits == 16:
        return ids.astype(">u2").tobytes()
    wide = ids.astype(">u4").view(np.uint8).reshape(-1, 4)
    return np.packbits(np.unpackbits(wide, axis=1)[:, 32 - bits:].ravel()).tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    """The first ``n`` ids of a block, as uint32."""
    if bits == 16:
        return np.frombuffer(data, ">u2", n).astype(np.uint32)
    flags = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits).reshape(n, bits)
    out = np.zeros((n, 32), np.uint8)
    out[:, 32 - bits:] = flags
    return np.packbits(out, axis=1).view(">u4").ravel().astype(np.uint32)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and the path in it; a bare path or ``file:`` is local."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


class TokenWriter:
    """One file: blocks are written as they fill up, the index at the end."""

    def __init__(self, sink, bits: int, block_ids: int = BLOCK_IDS):
        self.sink, self.bits, self.block_ids = sink, bits, block_ids
        self.sink.write(MAGIC)
        self.at, self.held, self.n_held, self.n_ids = len(MAGIC), [], 0, 0
        self.offsets: list[int] = []
        self.ids: list[np.ndarray] = []
        self.nulls: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []

    def add(self, doc_ids: np.ndarray, nulls: np.ndarray, lengths: np.ndarray, tokens: np.ndarray) -> None:
        self.ids.append(doc_ids)
        self.nulls.append(nulls)
        self.lengths.append(lengths)
        self.held.append(tokens)
        self.n_held += len(tokens)
        self.n_ids += len(tokens)
        if self.n_held >= self.block_ids:
            rest = np.concatenate(self.held)
            whole = len(rest) // self.block_ids * self.block_ids
            for k in range(0, whole, self.block_ids):
                self._block(rest[k:k + self.block_ids])
            self.held, self.n_held = [rest[whole:]], len(rest) - whole

    def _block(self, ids: np.ndarray) -> None:
        data = pack(ids, self.bits)
        self.offsets.append(self.at)
        self.sink.write(data)
        self.at += len(data)

    def close(self) -> None:
        if self.n_held:
            self._block(np.concatenate(self.held))
        join = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
        lengths = join(self.lengths, np.int64)
        index = [np.asarray(self.offsets, "<i8"), join(self.ids, "<i8"), join(self.nulls, "u1"),
                 np.r_[0, np.cumsum(lengths)].astype("<i8")]
        footer = json.dumps({"bits": self.bits, "block_ids": self.block_ids, "ids": int(self.n_ids),
                             "documents": len(lengths), "blocks": len(self.offsets), "index": self.at}).encode()
        for part in [*(x.tobytes() for x in index), footer, len(footer).to_bytes(4, "little"), MAGIC]:
            self.sink.write(part)


class TokenFile:
    """Random access to one file by token position or by document."""

    def __init__(self, uri: str):
        fs, path = filesystem(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        tail = self.file.read_at(12, size - 12)
        if tail[4:] != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        n = int.from_bytes(tail[:4], "little")
        self.meta = json.loads(self.file.read_at(n, size - 12 - n))
        docs, blocks = self.meta["documents"], self.meta["blocks"]
        raw = self.file.read_at(size - 12 - n - self.meta["index"], self.meta["index"])
        cut = np.cumsum([0, 8 * blocks, 8 * docs, docs, 8 * (docs + 1)])
        self.offsets, self.doc_ids, self.nulls, self.first = (
            np.frombuffer(raw[a:b], kind) for a, b, kind in zip(cut, cut[1:], ("<i8", "<i8", "u1", "<i8"), strict=False))

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop - 1`` of the file."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        size, bits = self.meta["block_ids"], self.meta["bits"]
        low, high = start // size, (stop - 1) // size
        end = self.offsets[high + 1] if high + 1 < len(self.offsets) else self.meta["index"]
        data = self.file.read_at(int(end - self.offsets[low]), int(self.offsets[low]))
        n = min((high + 1) * size, self.meta["ids"]) - low * size
        return unpack(data, bits, n)[start - low * size:stop - low * size]

    def document(self, number: int) -> np.ndarray:
        """Ids of the document with this place in the file."""
        return self.tokens(int(self.first[number]), int(self.first[number + 1]))

    def close(self) -> None:
        self.file.close()


# encoding --------------------------------------------------------------------------------

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK = np.zeros(256, bool)
_MARK[[x for x in range(0x21, 0x7F) if not _LETTER[x] and not 0x30 <= x <= 0x39]] = True


def segments(raw: np.ndarray, offs: np.ndarray, fine: bool = True) -> np.ndarray:
    """Cut points where byte-level BPE splits a text in any case: between a word and white space,
    and, if ``fine``, between an ASCII letter and an ASCII punctuation mark after it.

    A white-space run belongs to what follows. Cuts at white space are made only after an ASCII
    byte that is no control character, or after a Latin letter with an accent, so that a run that
    holds other Unicode spaces is never cut.
    """
    space = (raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D))
    sure = (raw > 0x20) & (raw < 0x7F)
    sure[1:] |= (raw[1:] >= 0x80) & (raw[:-1] == 0xC3)
    cut = np.zeros(len(raw) + 1, bool)
    cut[1:-1] = space[1:] & sure[:-1]
    if fine:
        cut[1:-1] |= _LETTER[raw[:-1]] & _MARK[raw[1:]]
    cut[offs] = True
    return np.flatnonzero(cut)


class Encoder:
    """Encodes texts with a tokenizers file; a segment seen before is looked up, by its 64-bit hash."""

    def __init__(self, path: str, whole: bool = False):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.whole = whole
        self.marked = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.keys = np.zeros(0, np.uint64)   # ascending hashes of the known segments
        self.first = np.zeros(0, np.int64)   # where their ids begin in the table
        self.size = np.zeros(0, np.int64)
        self.table = np.zeros(0, np.uint32)

    def _encode(self, parts: list[str]) -> list[list[int]]:
        """Ids of each segment. One with ASCII letters only, after a space or not, is one word to the
        model, so it needs no further splitting."""
        out: list[list[int]] = []
        plain = not self.whole
        odd = [k for k, x in enumerate(parts) if not (plain and x.isascii() and x.removeprefix(" ").isalpha())]
        rest = dict(zip(odd, self.tokenizer.encode_batch_fast([parts[k] for k in odd], add_special_tokens=False), strict=True))
        tokenize = self.model.tokenize
        for k, x in enumerate(parts):
            out.append(rest[k].ids if k in rest else [t.id for t in tokenize("\u0120" + x[1:] if x[0] == " " else x)])
        return out

    def _learn(self, raw: np.ndarray, low: np.ndarray, high: np.ndarray, keys: np.ndarray) -> None:
        if len(self.keys) + len(keys) > CACHED_SEGMENTS:
            self.keys, self.first, self.size, self.table = (x[:0] for x in (self.keys, self.first, self.size, self.table))
        data = raw.tobytes()
        sizes, ids = [], []
        for k in range(0, len(keys), 20_000):
            got = self._encode([data[a:b].decode() for a, b in zip(low[k:k + 20_000].tolist(), high[k:k + 20_000].tolist(), strict=True)])
            sizes.append(np.fromiter(map(len, got), np.int64, len(got)))
            ids.append(np.fromiter((i for x in got for i in x), np.uint32, int(sizes[-1].sum())))
        size = np.concatenate(sizes)
        first = len(self.table) + np.r_[0, np.cumsum(size)[:-1]]
        self.table = np.concatenate([self.table, *ids])
        order = np.argsort(np.r_[self.keys, keys], kind="stable")
        self.keys, self.first, self.size = (np.concatenate(x)[order] for x in (
            (self.keys, keys), (self.first, first), (self.size, size)))

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, the end id after each text, and the number of ids of each text."""
        raw, offs = buffers(texts)
        n = len(offs) - 1
        if not len(raw):
            return np.full(n, end_id, np.uint32), np.ones(n, np.int64)
        if self.whole:
            cuts = np.unique(offs)
        else:
            data = raw.tobytes()
            cuts = segments(raw, offs, fine=not any(m in data for m in self.marked))
        codes, keys = pd.factorize(runs(raw, cuts))
        shown = np.zeros(len(keys), np.int64)
        shown[codes[::-1]] = np.arange(len(codes))[::-1]  # the first segment with each hash
        if CACHED_SEGMENTS < len(self.keys) + len(keys):
            self.keys, self.first, self.size, self.table = (x[:0] for x in (self.keys, self.first, self.size, self.table))
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        if not known.all():
            fresh = shown[~known]
            self._learn(raw, cuts[fresh], cuts[fresh + 1], keys[~known])
            at = np.searchsorted(self.keys, keys)
        lengths = self.size[at][codes]
        last = np.cumsum(lengths)
        before = np.r_[0, last]
        per_doc = np.diff(before[np.searchsorted(cuts, offs)])
        ids = self.table[spans(lengths, self.first[at][codes])]
        return np.insert(ids, np.cumsum(per_doc), end_id).astype(np.uint32), per_doc + 1


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, whole: bool) -> Encoder:
    if (path, whole) not in _ENCODERS:
        _ENCODERS[path, whole] = Encoder(path, whole)
    return _ENCODERS[path, whole]


def splits_at_words(path: str) -> bool:
    """Whether the tokenizer is plain byte-level BPE, for which ``segments`` holds."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    return (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and not spec.get("normalizer")
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec.get("added_tokens", [])))


# jobs ------------------------------------------------------------------------------------

MANIFEST = "file_no int, file string, documents long, ids long"


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 2, doc_id: str = "doc_id",
                 text: str = "text", block_ids: int = BLOCK_IDS) -> DataFrame:
    """Encode ``text`` in ascending ``doc_id`` order into files below ``folder``; returns the manifest.

    ``tokenizer`` is the path of a tokenizers file that every executor can read. One shuffle
    deals the documents over ranges of ids; the range is encoded and written in the same task.
    """
    from tokenizers import Tokenizer

    bits = bits_for(max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1))
    whole = not splits_at_words(tokenizer)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        number = TaskContext.get().partitionId()
        name = f"tokens-{number:06d}-{uuid.uuid4().hex}.bin"
        coder, sink, out, documents = encoder(tokenizer, whole), None, None, 0
        for batch in slices(batches, "text", SLICE):
            if out is None:
                fs.create_dir(base, recursive=True)
                sink = fs.open_output_stream(f"{base}/{name}")
                out = TokenWriter(sink, bits, block_ids)
            ids, lengths = coder.encode(batch.column("text"), end_id)
            keys = batch.column("doc_id")
            out.add(keys.fill_null(0).to_numpy(), keys.is_null().to_numpy(zero_copy_only=False), lengths, ids)
            documents += batch.num_rows
        if out is not None:
            out.close()
            sink.close()
            yield pa.RecordBatch.from_pylist(
                [{"file_no": number, "file": f"{folder}/{name}", "documents": documents, "ids": int(out.n_ids)}],
                pa.schema([("file_no", pa.int32()), ("file", pa.string()), ("documents", pa.int64()), ("ids", pa.int64())]))

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    return materialise(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(write, MANIFEST),
                       "token-manifest")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """One row per document from the files: doc_id, file, number (its place in the file), start
    (ids of all documents before it), n_tokens, ids_crc32 (of the ids as little-endian uint32)."""
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = manifest.select("file_no", "file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                source = TokenFile(row["file"])
                first = source.first
                sums = np.zeros(len(source.doc_ids), np.int64)
                step = 1 << 22
                at = 0
                while at < len(sums):  # documents of about ``step`` ids at a time
                    upto = max(at + 1, int(np.searchsorted(first, first[at] + step, "right")) - 1)
                    ids = source.tokens(int(first[at]), int(first[upto])).astype("<u4")
                    for d in range(at, upto):
                        sums[d] = zlib.crc32(ids[first[d] - first[at]:first[d + 1] - first[at]].tobytes())
                    at = upto
                source.close()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(source.doc_ids, mask=source.nulls.astype(bool)), pa.array([row["file"]] * len(sums), pa.string()),
                     pa.array(np.arange(len(sums))), pa.array(first[:-1] + row["base"]),
                     pa.array(np.diff(first)), pa.array(sums)],
                    names=["doc_id", "file", "number", "start", "n_tokens", "ids_crc32"])

    # a task per file: the rows are as many as files, so this moves next to nothing
    n = max(1, manifest.count())
    return files.repartitionById(n, F.pmod(F.col("file_no"), F.lit(n)).cast("int")).mapInArrow(
        read, "doc_id long, file string, number long, start long, n_tokens long, ids_crc32 long")
