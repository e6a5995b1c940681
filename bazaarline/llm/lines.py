"""Line dedup: a line stays only in the document with the smallest id that holds it.

Lines are reduced to hashes of their keys (two independent 64-bit hashes; the key is the line
with ASCII white space stripped at both ends and A-Z lower-cased). The hashes are dealt over
ranges and sorted by (hash, document, position) in them, and a running window streams over each
range: the first row of a hash names the document that keeps the line. What comes back are
keep bitmaps, one 64-bit word for each 64 lines with a drop among them, not texts.

A hash held by a very large number of rows is kept out of the ranges: it is reduced to its
smallest document by an aggregation, which combines before the shuffle, and its rows are
matched by a join that adaptive execution splits.

Rows: null or empty texts are one empty line. Rows with a null id are kept whole and take no
part. Rows that repeat an id are one document: they never drop each other's lines. Further
columns of ``docs`` are ignored by ``drop_bitmaps`` and kept by ``dedup_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

MIN_CHARS = 10
BUCKETS = 1 << 16
HOT_TIMES = 8     # a bucket of hashes is hot beyond so many times the mean, and HOT_ROWS rows more
HOT_ROWS = 1_000
_SPACE = " \t\n\x0b\x0c\r"


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def n_lines(text: Column) -> Column:
    body = F.coalesce(text, F.lit(""))
    return (F.octet_length(body) - F.octet_length(F.replace(body, F.lit("\n"), F.lit(""))) + 1).cast("long")


def line_key(line: Column) -> Column:
    """The line without outer ASCII white space, A-Z in lower case."""
    bare = F.trim(line, F.lit(_SPACE))
    letters = F.translate(bare, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    # in a line of ASCII only, lower() is the same and takes the bytes as they are
    return F.when(F.octet_length(line) == F.char_length(line), F.lower(bare)).otherwise(letters)


def _lines(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """(h1, h2, doc, tie, pos) of every line whose key counts; ``tie`` tells rows of one id apart."""
    key = line_key(F.col("line"))
    return docs.where(F.col(doc_id).isNotNull()) \
        .select(F.col(doc_id).alias("doc"), F.xxhash64(text).alias("tie"),
                F.posexplode(split_lines(F.col(text))).alias("pos", "line")) \
        .select("doc", "tie", "pos", key.alias("key")).where(F.char_length("key") >= min_chars) \
        .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc", "tie", "pos")


def drop_bitmaps(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                 hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per document with a drop: doc, tie, n_dropped and ``keep``, a map from line number div 64 to
    a word whose bit ``line % 64`` is 0 for a dropped line. Words without a drop are left out.

    Texts are read once: the hashes of their lines, some 30 bytes a line, are stored.
    """
    lines = materialise(_lines(docs, doc_id, text, min_chars), "line-hashes") \
        .withColumn("bucket", F.pmod("h1", F.lit(BUCKETS)).cast("int"))
    # a hash with very many rows makes its bucket hot; fewer than BUCKETS / HOT_TIMES buckets can be
    sizes = lines.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    mean = (sizes.agg(F.sum("n")).first()[0] or 0) / BUCKETS
    hot = [r.bucket for r in sizes.where(F.col("n") > HOT_TIMES * mean + hot_rows).select("bucket").collect()]
    is_hot = F.col("bucket").isin(hot) if hot else F.lit(False)

    running = Window.partitionBy("h1", "h2").orderBy("doc", "tie", "pos").rowsBetween(Window.unboundedPreceding, 0)
    streamed = lines.where(~is_hot).drop("bucket").repartitionByRange("h1", "h2") \
        .withColumn("first", F.first("doc").over(running))
    drops = streamed.where(F.col("doc") > F.col("first")).select("doc", "tie", "pos")
    if hot:
        wide = lines.where(is_hot).drop("bucket")
        first = wide.groupBy("h1", "h2").agg(F.min("doc").alias("first"), F.max("doc").alias("last")) \
            .where(F.col("first") < F.col("last")).drop("last")
        drops = drops.unionByName(wide.join(first, ["h1", "h2"]).where(F.col("doc") > F.col("first"))
                                  .select("doc", "tie", "pos"))
    bit = F.expr("shiftleft(1L, cast(pos % 64 as int))")
    words = drops.groupBy("doc", "tie", F.expr("cast(pos div 64 as int)").alias("word")) \
        .agg(F.bit_or(bit).alias("bits"))
    return words.groupBy("doc", "tie").agg(
        F.map_from_entries(F.collect_list(F.struct("word", F.bitwise_not("bits")))).alias("keep"),
        F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"))


def kept_lines(text: Column, keep: Column) -> Column:
    """The lines whose bit is 1, joined again."""
    def stays(_: Column, pos: Column) -> Column:
        word = F.coalesce(F.element_at(keep, F.floor(pos / 64).cast("int")), F.lit(-1).cast("long"))
        return F.getbit(word, F.pmod(pos, F.lit(64)).cast("int")) == 1

    return F.when(keep.isNull(), F.coalesce(text, F.lit(""))).otherwise(
        F.array_join(F.filter(split_lines(text), stays), "\n"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                hot_rows: int = HOT_ROWS) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` (before dropping) and ``n_dropped`` added."""
    maps = drop_bitmaps(docs, doc_id, text, min_chars, hot_rows) \
        .withColumnsRenamed({"doc": "__doc", "tie": "__tie", "keep": "__keep", "n_dropped": "__n"})
    here = [F.col(doc_id) == F.col("__doc"), F.xxhash64(text) == F.col("__tie")]
    joined = docs.join(maps, here, "left")
    return joined.withColumn("kept_text", kept_lines(F.col(text), F.col("__keep"))) \
        .withColumn("n_lines", n_lines(F.col(text))) \
        .withColumn("n_dropped", F.coalesce(F.col("__n"), F.lit(0)).cast("long")) \
        .drop("__doc", "__tie", "__keep", "__n")
