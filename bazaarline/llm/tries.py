"""Prefix trie of conversations by van Emde Boas recursion: cut at half depth, name, build, graft.

A sequence of turns is cut at half its depth, the halves at half theirs, and so on down to leaf tries of
``LEAF`` turns. A cut splits a trie into an upper one and the forest of lower ones, one below each cut prefix.

1. Names. From the leaves up, a segment gets the digest of its two halves (one job a level, half the rows
   each). A cut prefix is named by the digest of the name of its trie's root and the segment between them;
   all cuts of all levels are named in one job, so upper tries and lower forests come apart together.
2. Leaf tries. Under each cut prefix, nodes are the distinct beginnings of at most ``LEAF`` turns, named
   by the cut prefix and their turns: one aggregation gives members, smallest member and ends of each node.
3. Grafting. From the lowest level up, the total of each lower trie is added to the root of the trie that
   its cut belongs to. Each total is then credited to the nodes between that root and the cut, once, along the
   path of one conversation that passes through it.

Rows are turns, leaf tries and nodes; the recursion works on one row per leaf trie and doubles at every
level what a row stands for, so its volume is that of one level times the number of levels and the number
of jobs follows the logarithm of the longest conversation. A conversation is never gathered: one with a
third of all turns is numbered by ranges and dealt over its leaf tries. Digests have 128 bits.

Turns come in the order of ``turn`` (null first), then role, then the digest of role and text: turns that
tie are taken in that order, repeated rows one after the other. Null roles and texts are empty ones. Rows without
conv_id belong to no conversation and are left out. An empty table has no nodes, not even a root. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .order import numbered

LEAF = 16
HEADS, FAMILY = 9, 5      # of the contract's way to rebuild conversations: crc32 % 9 turns of conversation c - c % 5
ID_BITS = 16              # ids of members that end at a node are joined in stretches of 2**16


def _none() -> Column:
    return F.expr("X''")


def _root() -> Column:
    """The name of the root."""
    return F.expr("X'00'")


def _digest(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), key (digest of role and text) and size (bytes of the text) of every turn."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = _digest(F.encode(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), "UTF-8"))
    narrow = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), key.alias("key"),
                                  F.octet_length(text).cast("long").alias("size")).where("conv_id is not null")
    rows = numbered(narrow, [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("key").asc()])
    first = rows.groupBy("conv_id").agg(F.min("row_number").alias("first"))
    return rows.join(first, "conv_id").select("conv_id", (F.col("row_number") - F.col("first")).alias("pos"), "key", "size")


def rebuild(turns: DataFrame, heads: int = HEADS, family: int = FAMILY) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns, and conv_id with length of every conversation, those without turns too.

    Conversation c begins with the first h turns of conversation c - c % family (h: crc32 of its decimal id
    modulo ``heads``), and goes on with its own after its first h.
    """
    own = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    base = own.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    own = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % family) \
        .withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads)
    convs = own.join(base, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0)))) \
        .withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs = materialise(convs.select("conv_id", "base", "h", "taken", "length"), "trie-conversations")
    first = turns.where((F.col("pos") < heads - 1) & (F.col("conv_id") % family == 0)).withColumnRenamed("conv_id", "base")
    taken = convs.select("conv_id", "base", "taken").join(first, "base").where("pos < taken")
    kept = turns.join(convs.select("conv_id", "h", "taken"), "conv_id").where("pos >= h").withColumn("pos", F.expr("pos - h + taken"))
    columns = ["conv_id", "pos", "key", "size"]
    return taken.select(*columns).unionByName(kept.select(*columns)), convs.select("conv_id", "length")


def _leaf_rows(turns: DataFrame, convs: DataFrame, leaf: int) -> DataFrame:
    """One row per conversation and leaf trie it passes: its turns there, at most ``leaf``, in order.
    ``goes_on`` says whether the conversation has turns below."""
    rows = turns.groupBy("conv_id", F.expr(f"pos div {leaf}").alias("blk")) \
        .agg(F.sort_array(F.collect_list(F.struct("pos", "key", "size"))).alias("turns"))
    return rows.join(convs, "conv_id").withColumn("goes_on", F.col("length") > (F.col("blk") + 1) * leaf)


def _fold(turns: Column) -> Column:
    return F.aggregate(turns, _none(), lambda acc, t: _digest(acc, t["key"]))


def _segments(rows: DataFrame, levels: int) -> list[DataFrame]:
    """Per level: conv_id, at and name of the segments of 2**level leaf tries with turns below them."""
    out = [materialise(rows.where("goes_on").select("conv_id", F.col("blk").alias("at"), _fold(F.col("turns")).alias("name")), "trie-segments")]
    for _ in range(1, levels):
        half = F.col("at") % 2
        pairs = out[-1].groupBy("conv_id", F.expr("at div 2").alias("up")).agg(
            F.max(F.when(half == 0, F.col("name"))).alias("a"), F.max(F.when(half == 1, F.col("name"))).alias("b"))
        out.append(materialise(pairs.where("a is not null and b is not null")
                               .select("conv_id", F.col("up").alias("at"), _digest(F.col("a"), F.col("b")).alias("name")), "trie-segments"))
    return out


def _cuts(segments: list[DataFrame], convs: DataFrame, leaf: int) -> DataFrame:
    """conv_id, blk, start (name of the cut prefix above that leaf trie), anchor (that of the root of the trie that
    was cut there), level of the cut and node (name of the cut prefix as a node of the leaf trie above it)."""
    lefts = [s.where("at % 2 = 0").withColumn("level", F.lit(level)) for level, s in enumerate(segments)]
    pieces = lefts[0]
    for more in lefts[1:]:
        pieces = pieces.unionByName(more)
    # a left segment is part of the way to every leaf trie of the right half beside it
    last = F.expr(f"least(shiftleft(at + 2, level), (length + {leaf - 1}) div {leaf}) - 1")
    ways = pieces.join(convs, "conv_id").withColumn("low", F.expr("shiftleft(at + 1, level)")).where(F.col("low") <= last) \
        .select("conv_id", "level", "name", F.explode(F.sequence("low", last)).alias("blk"))
    way = F.sort_array(F.collect_list(F.struct((-F.col("level")).alias("order"), "name")))  # one piece a level
    starts = ways.groupBy("conv_id", "blk").agg(way.alias("way"), F.min("level").alias("level"))
    name = lambda way: F.aggregate(way, _root(), lambda acc, p: _digest(acc, p["name"]))
    starts = materialise(starts.select("conv_id", "blk", "level", name(F.col("way")).alias("start"),
                                       name(F.slice("way", F.lit(1), F.size("way") - 1)).alias("anchor")), "trie-cuts")
    above = starts.select("conv_id", "blk", "start").unionByName(
        segments[0].where("at = 0").select("conv_id", F.lit(0).cast("long").alias("blk"), _root().alias("start")))
    node = above.join(segments[0].select("conv_id", F.col("at").alias("blk"), "name"), ["conv_id", "blk"]) \
        .select("conv_id", (F.col("blk") + 1).alias("blk"), _digest(F.col("start"), F.col("name")).alias("node"))
    return starts.join(node, ["conv_id", "blk"])


def _graft(cuts: DataFrame, inside: DataFrame, levels: int) -> DataFrame:
    """start, level, rep (a conversation through it), blk, leaves and saved: the totals of every lower trie
    within its level, lowest level first."""
    known = cuts.groupBy("start").agg(F.min("conv_id").alias("rep"), F.first("blk").alias("blk"),
                                      F.first("level").alias("level"), F.first("anchor").alias("anchor"))
    known = known.join(inside, "start", "left").fillna(0, ["leaves", "saved"])
    state = materialise(known, "trie-totals")
    for level in range(levels - 1):  # the root needs no total of its own
        lower = state.where(F.col("level") == level).groupBy(F.col("anchor").alias("start")) \
            .agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        state = materialise(state.join(lower, "start", "left").select(
            "start", "rep", "blk", "level", "anchor", F.expr("leaves + coalesce(more_leaves, 0)").alias("leaves"),
            F.expr("saved + coalesce(more_saved, 0)").alias("saved")), "trie-totals")
    return state


def _ends(ends: DataFrame) -> DataFrame:
    """name, ends_sha256 of the nodes where conversations end, from (name, conv_id).

    Ids are joined in stretches of 2**ID_BITS. A node with several stretches has them hashed one after
    the other, as SHA-256 asks for, a batch in memory at a time.
    """
    parts = ends.groupBy("name", F.shiftright("conv_id", ID_BITS).alias("part")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    parts = materialise(parts, "trie-ends")
    counts = parts.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.max("ids").alias("ids"))
    one = counts.where("n = 1").select("name", F.sha2(F.encode("ids", "UTF-8"), 256).alias("ends_sha256"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state = None, None

        def done():
            return pa.RecordBatch.from_pydict({"name": pa.array([name], pa.binary()), "ends_sha256": [state.hexdigest()]})

        for batch in batches:
            for new, ids in zip(batch.column("name"), batch.column("ids"), strict=True):
                if state is None or new.as_py() != name:
                    if state is not None:
                        yield done()
                    name, state = new.as_py(), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.as_buffer())
        if state is not None:
            yield done()

    several = parts.join(counts.where("n > 1").select("name"), "name", "left_semi").repartition("name") \
        .sortWithinPartitions("name", "part").select("name", "ids").mapInArrow(run, "name binary, ends_sha256 string")
    return one.unionByName(several)


def build(turns: DataFrame, convs: DataFrame, leaf: int = LEAF) -> DataFrame:
    """One row per node of the trie over sequences of turns.

    ``turns`` has conv_id, pos (0, 1, ... without a gap), key and size; ``convs`` conv_id and length of
    every sequence. Returns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256.
    """
    rows = materialise(_leaf_rows(turns, convs, leaf), "trie-leaves")
    deepest = rows.agg(F.max("blk")).first()[0] or 0
    levels = int(deepest).bit_length()
    first = rows.where("blk = 0").withColumns({"start": _root(), "node": _root()})
    if levels:
        cuts = materialise(_cuts(_segments(rows, levels), convs, leaf), "trie-cuts")
        first = first.unionByName(rows.join(cuts.select("conv_id", "blk", "start", "node"), ["conv_id", "blk"]))
    # names[0] is the node above the leaf trie, names[i] that of its i-th turn
    folds = F.aggregate("turns", F.array(_none()), lambda acc, t: F.concat(acc, F.array(_digest(F.element_at(acc, -1), t["key"]))))
    names = F.concat(F.array("node"), F.transform(F.slice(folds, F.lit(2), F.size("turns")), lambda f: _digest(F.col("start"), f)))
    named = materialise(first.select("conv_id", "blk", "length", "goes_on", "start", names.alias("names"),
                                     F.transform("turns", lambda t: t["size"]).alias("sizes")), "trie-names")
    each = named.select("conv_id", "blk", "length", "start", "names", F.posexplode("sizes").alias("i", "size")).select(
        "conv_id", "blk", "start", "i", "size", F.get("names", F.col("i") + 1).alias("name"), F.get("names", F.col("i")).alias("parent"),
        (F.col("blk") * leaf + F.col("i") + 1).alias("depth"), F.col("length").alias("length"))
    n_ends = F.count_if(F.col("depth") == F.col("length"))
    nodes = materialise(each.groupBy("name").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent").alias("parent"),
        F.first("start").alias("start"), F.first("blk").alias("blk"), F.first("i").alias("i"), F.count(F.lit(1)).alias("n_convs"),
        ((F.count(F.lit(1)) - 1) * F.first("size")).alias("saved"), (n_ends == F.count(F.lit(1))).cast("long").alias("leaves")), "trie-nodes")

    # what a node adds to those above it in its leaf trie, and what cuts add along the way of one conversation
    adds = nodes.where("leaves > 0 or saved > 0").select("conv_id", "blk", "i", "leaves", "saved")
    if levels:
        inside = nodes.where("blk > 0").groupBy("start").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        totals = _graft(cuts, inside, levels).where("leaves > 0 or saved > 0")
        credits = totals.select(F.col("rep").alias("conv_id"), "leaves", "saved",
                                F.explode(F.expr("sequence(blk - shiftleft(1L, level), blk - 1)")).alias("blk")) \
            .groupBy("conv_id", "blk").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        adds = adds.unionByName(credits.withColumn("i", F.lit(leaf - 1)))
    adds = adds.groupBy("conv_id", "blk").agg(F.collect_list(F.struct("i", "leaves", "saved")).alias("adds"))  # leaf + 1 at most
    # the node above counts too where it is the root, which has no leaf trie above
    reach = lambda field: lambda name, j: F.aggregate(
        F.filter("adds", lambda a: a["i"] + 1 >= j), F.lit(0).cast("long"), lambda acc, a: acc + a[field])
    up = named.join(adds, ["conv_id", "blk"]).select(
        "blk", F.explode(F.arrays_zip(
            F.col("names").alias("name"), F.transform("names", reach("leaves")).alias("leaves"),
            F.transform("names", reach("saved")).alias("saved"), F.sequence(F.lit(0), F.size("names") - 1).alias("j"))).alias("x")) \
        .where("(x.j > 0 or blk = 0) and (x.leaves > 0 or x.saved > 0)").select("x.name", "x.leaves", "x.saved")

    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
                     F.count_if(F.col("length") == 0).alias("n_turnless")).where("n_convs > 0")
    last = named.where(~F.col("goes_on")).select(F.element_at("names", -1).alias("name"), "conv_id") \
        .unionByName(convs.where("length = 0").select(_root().alias("name"), "conv_id"))
    # one sum over all that is known of a node
    sources = [nodes.select("name", "conv_id", "depth", "parent", "n_convs"),
               nodes.select(F.col("parent").alias("name"), F.lit(1).cast("long").alias("n_children")), up, _ends(last),
               root.select(_root().alias("name"), "conv_id", F.lit(0).cast("long").alias("depth"), "n_convs",
                           (F.col("n_convs") == F.col("n_turnless")).cast("long").alias("leaves"))]
    together = sources[0]
    for more in sources[1:]:
        together = together.unionByName(more, allowMissingColumns=True)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    whole = materialise(together.groupBy("name").agg(
        F.max("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent").alias("parent"), F.max("n_convs").alias("n_convs"),
        total("n_children"), total("leaves"), total("saved"), F.max("ends_sha256").alias("ends_sha256")), "trie-whole")
    parents = whole.where("n_children > 0").select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return whole.join(parents, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(_none(), 256)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, leaf: int = LEAF) -> DataFrame:
    """The prefix trie of the rebuilt conversations (see ``rebuild`` and ``build``)."""
    turns, convs = rebuild(materialise(turns_of(conversations), "trie-turns"))
    return build(turns, convs, leaf)
