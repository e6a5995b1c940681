"""Mixing sources: temperature weights that meet a target, realised as whole and partial passes.

Weights are ``share ** exponent``, normalised: exponent 1 keeps the natural shares, 0 makes all
sources equal. The exponent is bisected to the largest value that meets the targets given:
an entropy of the weights of at least ``min_entropy`` (as a part of the entropy of equal
weights), or to the smallest that keeps every source within ``max_repeats`` passes.

A source with weight w and T tokens gets the budget w * B: floor(w * B / T) whole passes and a
part of one more. The part is taken from a permutation of the source's blocks of documents:
whole blocks until the budget's last one, and that one document by document. Blocks have a
bounded size, so a source with a third of all rows is spread over as many tasks as it has blocks.

Tokens are words (runs of other than ASCII white space). Only built-in column functions are
used. Rows: a null source is a source of its own; null or empty texts have no tokens and go
with every whole pass; equal rows are taken alike, by an order that only depends on their
content, then at random but reproducibly. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

BLOCK_TOKENS = 200_000
STEPS = 16    # exponents tried at once
ROUNDS = 8    # narrowings; the exponent is exact to 15 ** -8


def n_words(text: Column) -> Column:
    """Words of a text; none in a null text."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def _measured(sources: DataFrame, exponents: list[float], budget: float | None) -> dict[float, tuple[float, float]]:
    """For each exponent: entropy relative to equal weights, and the most passes of a source.

    ``budget`` None stands for the smallest one with which every source is passed once at least.
    """
    tried = sources.where(F.col("tokens") > 0).withColumn("e", F.explode(F.array(*[F.lit(float(e)) for e in exponents])))
    mass = F.pow(F.col("share"), F.col("e"))
    got = tried.groupBy("e").agg(
        F.sum(mass).alias("z"), F.sum(mass * F.col("e") * F.log("share")).alias("s"), F.count(F.lit(1)).alias("n"),
        F.max(mass / F.col("tokens")).alias("most"), F.min(mass / F.col("tokens")).alias("least")).collect()
    out = {}
    for r in got:
        entropy = math.log(r.z) - r.s / r.z
        passes = r.most / r.least if budget is None else budget * r.most / r.z
        out[r.e] = (entropy / math.log(r.n) if r.n > 1 else 1.0, passes)
    return out


def solve_exponent(sources: DataFrame, min_entropy: float | None = None, max_repeats: float | None = None,
                   budget: float | None = None) -> float:
    """The largest exponent in 0..1 whose entropy reaches ``min_entropy``, or else the smallest
    whose passes stay within ``max_repeats``. 1 where no exponent does.

    Both measures are monotone; each round tries ``STEPS`` exponents over the table of sources
    at once, and ``STEPS`` rows come back, however many sources there are.
    """
    if (min_entropy is None) == (max_repeats is None):
        raise ValueError("give one of min_entropy and max_repeats")
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        grid = [low + (high - low) * k / (STEPS - 1) for k in range(STEPS)]
        seen = _measured(sources, grid, budget)
        if not seen:
            return 1.0
        if min_entropy is not None:
            good = [e for e in grid if seen[e][0] >= min_entropy]
            if not good:
                return low
            if good[-1] == grid[-1]:
                return good[-1]
            low, high = good[-1], grid[grid.index(good[-1]) + 1]
        else:
            good = [e for e in grid if seen[e][1] <= max_repeats]
            if not good:
                return high
            if good[0] == grid[0]:
                return good[0]
            low, high = grid[grid.index(good[0]) - 1], good[0]
    return low if min_entropy is not None else high


def source_weights(sized: DataFrame, min_entropy: float | None, max_repeats: float | None, budget: float | None,
                   cover: bool, block_tokens: int) -> DataFrame:
    """One row per ``__src`` of ``sized``: tokens, documents, share, exponent, weight, budget (tokens to
    hand out), whole (passes), part (tokens of the last pass) and blocks."""
    summed = materialise(sized.groupBy("__src").agg(F.sum("__tokens").alias("tokens"), F.count(F.lit(1)).alias("documents")),
                         "mix-sources")
    total = summed.agg(F.sum("tokens")).first()[0] or 0
    sources = summed.withColumn("share", F.col("tokens") / F.lit(float(max(total, 1))))
    spend = float(total if budget is None else budget)
    exponent = solve_exponent(sources, min_entropy, max_repeats, None if cover else spend)
    mass = F.pow("share", F.lit(exponent))
    z, least = sources.where(F.col("tokens") > 0).agg(F.sum(mass), F.min(mass / F.col("tokens"))).first()
    if cover and z:
        spend = z / least
    filled = F.col("tokens") > 0
    sources = sources.withColumn("exponent", F.lit(exponent)) \
        .withColumn("weight", F.when(filled, mass / F.lit(z or 1.0)).otherwise(F.lit(0.0))) \
        .withColumn("budget", F.lit(spend) * F.col("weight"))
    # a tolerance of one part in 10**9, so that a source due exactly one pass gets all of it
    due = F.when(filled, F.col("budget") / F.col("tokens") * (1 + 1e-9)).otherwise(F.lit(1.0))
    sources = sources.withColumn("whole", F.floor(due).cast("long")) \
        .withColumn("part", F.greatest(F.lit(0.0), F.round(F.col("budget") - F.col("whole") * F.col("tokens"), 3))) \
        .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("tokens") / F.lit(float(block_tokens)))).cast("long"))
    return materialise(sources, "mix-weights")


def mix_sources(docs: DataFrame, min_entropy: float | None = None, max_repeats: float | None = None,
                budget: int | None = None, cover: bool = False, seed: int = 0, source: str = "source",
                text: str = "text", block_tokens: int = BLOCK_TOKENS) -> tuple[DataFrame, DataFrame]:
    """``docs`` with ``n_tokens``, ``block``, ``place`` and ``passes`` (how often the document is
    taken, 0 for one that is left out), and the table of sources (see ``source_weights``).

    ``budget`` is the number of tokens to hand out, that of the corpus by default; ``cover`` takes
    the smallest one with which every document is taken at least once. Columns of ``docs`` with one of
    the four added names are replaced. A source ends within one document of its budget.
    """
    sized = docs.withColumn("__tokens", n_words(F.col(text))) \
        .withColumn("__src", F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("null"))) \
        .withColumn("__place", F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in docs.columns]))
    sources = source_weights(sized.select("__src", "__tokens"), min_entropy, max_repeats, budget, cover, block_tokens)
    terms = sources.select("__src", F.col("whole").alias("__whole"), F.col("part").alias("__part"), F.col("blocks").alias("__blocks"))

    def in_blocks(rows: DataFrame, small: DataFrame) -> DataFrame:
        # the table of sources is a stored one: Spark broadcasts it within the session's limit only
        return rows.join(small, "__src").withColumn("__block", F.pmod("__place", "__blocks")) \
            .withColumn("__turn", F.xxhash64(F.lit(seed), "__src", "__block"))

    def with_part(rows: DataFrame) -> DataFrame:
        return rows.where(F.col("__part") > 0)

    narrow = with_part(in_blocks(sized.select("__src", "__place", "__tokens"), terms))
    order = Window.partitionBy("__src").orderBy("__turn", "__block").rowsBetween(Window.unboundedPreceding, 0)
    edge = narrow.groupBy("__src", "__block", "__turn", "__part").agg(F.sum("__tokens").alias("__t")) \
        .withColumn("__upto", F.sum("__t").over(order)) \
        .where((F.col("__upto") > F.col("__part")) & (F.col("__upto") - F.col("__t") <= F.col("__part"))) \
        .select("__src", F.col("__block").alias("__edge"), F.col("__turn").alias("__edge_turn"),
                (F.col("__part") - F.col("__upto") + F.col("__t")).alias("__left"))
    edge = materialise(edge, "mix-edges")
    docs_in = Window.partitionBy("__src").orderBy("__place").rangeBetween(Window.unboundedPreceding, 0)
    last = narrow.join(edge, "__src").where(F.col("__block") == F.col("__edge")) \
        .withColumn("__run", F.sum("__tokens").over(docs_in)).where(F.col("__run") <= F.col("__left")) \
        .groupBy("__src").agg(F.max("__place").alias("__last"))
    cuts = materialise(terms.join(edge.drop("__left"), "__src", "left").join(last, "__src", "left"), "mix-cuts")
    before = F.col("__edge_turn").isNull() | (F.col("__turn") < F.col("__edge_turn")) | (
        (F.col("__turn") == F.col("__edge_turn")) & (F.col("__block") < F.col("__edge")))
    at_edge = (F.col("__block") == F.col("__edge")) & (F.col("__place") <= F.col("__last"))
    extra = F.when((F.col("__part") > 0) & (before | F.coalesce(at_edge, F.lit(False))), 1).otherwise(0)
    added = {"n_tokens": F.col("__tokens"), "block": F.col("__block"), "place": F.col("__place"),
             "passes": (F.col("__whole") + extra).cast("long")}
    mixed = in_blocks(sized, cuts)
    return mixed.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added],
                        *[c.alias(n) for n, c in added.items()]), sources


def schedule(mixed: DataFrame, seed: int = 0) -> DataFrame:
    """One row per pass of a document: ``pass`` and ``turn``, by which to sort for the mixed order.
    Every pass permutes the blocks anew; documents of a block stay together."""
    return mixed.where(F.col("passes") > 0) \
        .withColumn("pass", F.explode(F.sequence(F.lit(1).cast("long"), F.col("passes")))) \
        .withColumn("turn", F.xxhash64(F.lit(seed), "pass", "block"))
