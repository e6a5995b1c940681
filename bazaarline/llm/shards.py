"""Sharding by a keyed permutation of row numbers: reproducible, balanced and computable.

A Feistel network permutes the smallest range of 2**b values that holds all row numbers; values
past the last row are permuted again (cycle walking) until they fall inside, which makes it a
permutation of exactly ``0 .. n-1``. Row ``r`` lands at place ``p = permute(r)``: shard
``p % shards``, slot ``p // shards``. Shard sizes differ by one row at most, and a reader that
knows ``n`` and the key can compute shard and slot of any row, or with ``invert`` the row of any slot.

Only built-in column functions are used. Rows are numbered by id; rows that share an id, also
null ids, which come first, are ordered by size and checksum, and equal rows are alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .order import numbered

ROUNDS = 6
WALKS = 128  # at least half of the range is inside, so a value is still outside after all with odds of 2**-128


def permute(number: Column, rows: int, seed: int = 0, backwards: bool = False) -> Column:
    """Place of row ``number`` in the shuffled order of ``rows`` rows, or with ``backwards`` its row."""
    if rows < 2:
        return number
    bits = max(2, (rows - 1).bit_length())

    def walk(at: Column, _: Column) -> Column:
        return F.when(at < rows, at).otherwise(_feistel(at, bits, seed, backwards))

    first = _feistel(number, bits, seed, backwards)
    inside = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), first, walk)
    return F.when(inside < rows, inside).otherwise(F.raise_error(F.lit("cycle walking did not end")))


def _feistel(value: Column, bits: int, seed: int, backwards: bool) -> Column:
    """One pass over ``bits`` bits, as a fold over the round numbers. The halves swap each round; an even
    number of rounds puts halves of unequal length back in place."""
    low, high = bits // 2, bits - bits // 2
    masks = F.array(*[F.lit((1 << n) - 1) for n in ((high, low) * ROUNDS)[:ROUNDS]])
    start = F.struct(F.shiftright(value, low).cast("long").alias("l"),
                     value.bitwiseAND(F.lit((1 << low) - 1)).cast("long").alias("r"))

    def forward(s: Column, r: Column) -> Column:
        key = F.xxhash64(F.lit(seed), r, s["r"]).bitwiseAND(F.element_at(masks, r + 1))
        return F.struct(s["r"].alias("l"), s["l"].bitwiseXOR(key).alias("r"))

    def back(s: Column, r: Column) -> Column:
        key = F.xxhash64(F.lit(seed), r, s["l"]).bitwiseAND(F.element_at(masks, r + 1))
        return F.struct(s["r"].bitwiseXOR(key).alias("l"), s["l"].alias("r"))

    steps = F.array(*[F.lit(r) for r in (range(ROUNDS - 1, -1, -1) if backwards else range(ROUNDS))])
    end = F.aggregate(steps, start, back if backwards else forward,
                      lambda s: F.shiftleft(s["l"], low).bitwiseOR(s["r"]))
    return end


def shard_rows(docs: DataFrame, shards: int, seed: int = 0, doc_id: str = "doc_id", text: str = "text",
               total: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, size (UTF-8 bytes of the text, null none, plus 1),
    text_crc32, row_number, shard and slot. An empty table gives no rows."""
    body = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"),
                         F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"))
    rows = numbered(narrow, [F.col("doc_id").asc_nulls_first(), F.col("size").asc(), F.col("text_crc32").asc()])
    n = rows.count() if total is None else total
    return rows.withColumn("__p", permute(F.col("row_number"), n, seed)) \
        .withColumn("shard", F.pmod("__p", F.lit(shards)).cast("int")) \
        .withColumn("slot", F.expr(f"__p div {shards}")).drop("__p")
