"""Mix sources to target weights: Sainte-Lague apportionment of equal-token blocks.

Per source a target of words is set: its share by weight, at most ``most`` times its size, the
excess going to the others by weight. The mix consists of blocks of equal word counts. Each
block goes to the source with the highest quotient target / (2 * blocks so far + 1), which
gives every source an integer quota of blocks, and every output shard its quotas per source.

A source's documents stand in a seeded order, end to end, and are cut into blocks; its quota
takes blocks from the start of that line, and starts over after the last one. So a document is
taken whole, once or twice, or not at all; only the one at the end of the quota is cut.

Sources are configuration: their totals, one row each, are handled on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: Words of a block. Where the smallest target is below 32 blocks, blocks shrink to a 32nd of it.
BLOCK_WORDS = 64
#: Documents, about, that are laid out by one task at a time.
LAYOUT_ROWS = 20_000


#: Output shards of the mix, each with its own quotas.
SHARDS = 8


@dataclass(frozen=True)
class Source:
    name: str | None
    size: int
    target: float
    quota: int  # blocks
    shard_ends: list[int]  # blocks up to the end of each output shard


def words_in(text: Column) -> Column:
    """The number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: list[float], share: float, most: float) -> list[float]:
    """Words per source: ``share`` of all sizes dealt by weight, none above ``most`` times its size."""
    found = [0.0] * len(sizes)
    left, open_ = share * sum(sizes), [i for i, s in enumerate(sizes) if s]
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] * unit >= most * sizes[i]]
        for i in full or open_:
            found[i] = float(most * sizes[i]) if full else weights[i] * unit
            left -= found[i]
        open_ = [i for i in open_ if i not in full] if full else []
    return found


def sainte_lague(votes: list[float], seats: int) -> list[int]:
    """Seats by highest quotients votes / (2 * seats + 1); ties go to the earlier entry.

    Starts from the rounded proportional numbers, which are at most a few seats off, and gives or
    takes back single seats by quotient: the same result as dealing all seats one by one.
    """
    total = sum(votes)
    if not total:
        return [0] * len(votes)
    held = [int(v * seats / total + 0.5) for v in votes]
    while (short := seats - sum(held)) != 0:
        if short > 0:
            at = max(range(len(votes)), key=lambda i: (votes[i] / (2 * held[i] + 1), -i))
            held[at] += 1
        else:
            at = min((i for i in range(len(votes)) if held[i]), key=lambda i: (votes[i] / (2 * held[i] - 1), -i))
            held[at] -= 1
    return held


def shard_quotas(votes: list[float], seats: int, shards: int) -> list[list[int]]:
    """Blocks per shard and source: shard k holds the seats dealt from the k-th to the next of ``shards`` equal parts.

    More seats never cost an entry one, so the differences are counts.
    """
    so_far = [sainte_lague(votes, seats * k // shards) for k in range(shards + 1)]
    return [[b - a for a, b in zip(x, y, strict=True)] for x, y in zip(so_far, so_far[1:], strict=False)]


def plan(totals: list[tuple[str | None, int]], weights=WEIGHTS, share: float = 1.5, most: float = 2.0, block: int = BLOCK_WORDS, shards: int = SHARDS) -> tuple[list[Source], int]:
    """Sources by code point, null last, with weights repeating; and the words of a block."""
    totals = sorted(totals, key=lambda t: (t[0] is None, t[0] or ""))
    sizes = [size for _, size in totals]
    dealt = [float(weights[i % len(weights)]) for i in range(len(totals))]
    goal = targets(sizes, dealt, share, most)
    block = max(1, min([block, *(int(g / 32) for g in goal if g)]))
    by_shard = shard_quotas(goal, round(sum(goal) / block), shards)
    ends = [list(accumulate(q[i] for q in by_shard)) for i in range(len(totals))]
    return [Source(name, size, g, e[-1], e) for (name, size), g, e in zip(totals, goal, ends, strict=True)], block


def drawn(docs: DataFrame, seed: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``docs`` with the columns the layout needs: words, source and a seeded draw per document."""
    text = F.col(text_col)
    return docs.withColumns(
        {
            "__size": words_in(text),
            "__source": F.col(source_col).cast("string"),
            "__draw": F.xxhash64(F.lit(seed), F.col(id_col), text),
            "__id": F.col(id_col),
        }
    )


def placed(found: DataFrame, weights, share: float, most: float) -> DataFrame:
    """Rows of ``drawn`` with __source_size, __target, __passes (times taken whole), __part (words beyond) and __shard."""
    spark = found.sparkSession
    sums = found.groupBy("__source").agg(F.sum("__size").alias("words"), F.count("*").alias("n")).collect()
    sources, block = plan([(r["__source"], r["words"]) for r in sums], weights, share, most)
    # The seeded order is cut into ranges of draws, so that a large source is laid out by many tasks.
    bits = max(4, (max((r["n"] for r in sums), default=1) // LAYOUT_ROWS).bit_length())
    found = found.withColumns(
        {
            "__range": F.shiftrightunsigned("__draw", 64 - bits).cast("int"),
            "__at": F.coalesce(F.concat(F.lit("s"), "__source"), F.lit("n")),
        }
    )
    by_range = found.groupBy("__at", "__range").agg(F.sum("__size").alias("__words"))
    earlier = Window.partitionBy("__at").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_range.select("__at", "__range", F.coalesce(F.sum("__words").over(earlier), F.lit(0)).alias("__before"))
    goals = spark.createDataFrame(
        [("n" if s.name is None else "s" + s.name, s.size, s.target, min(s.quota * block, int(most * s.size)), s.shard_ends) for s in sources],
        "__at string, __source_size long, __target double, __quota long, __ends array<long>",
    )
    in_order = F.col("__draw").bitwiseXOR(F.lit(-(2**63)))  # as unsigned numbers
    within = Window.partitionBy("__at", "__range").orderBy(in_order, "__id", "__size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("__before") + F.coalesce(F.sum("__size").over(within), F.lit(0))
    lined = found.join(offsets.join(F.broadcast(goals), "__at"), ["__at", "__range"]).withColumn("__start", start)
    passes = F.expr("if(__source_size > 0, __quota div greatest(__source_size, 1), 0)")
    part = F.greatest(F.lit(0), F.least("__size", F.expr("__quota - __passes * __source_size - __start")))
    ahead = F.expr(f"size(filter(__ends, e -> e <= __start div {block}))")
    return lined.withColumn("__passes", passes).withColumn("__part", part).withColumn("__shard", ahead)


def mix(docs: DataFrame, seed: int = 7, weights=WEIGHTS, share: float = 1.5, most: float = 2.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per document: doc_id, size, source, source_size, target, taken, passes (times taken whole), shard.

    ``shard`` is the output shard that holds the document's first word, null if none is taken.
    Null and empty texts have no words and none are taken; null sources are a source of their own;
    null ids and repeated rows are documents like others. Ties in the seeded order are broken by
    id and size. An empty table gives an empty result. Other columns are not looked at, whatever
    their names. Reruns agree, whatever the partitioning.
    """
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(source_col).alias("source"))
    found = drawn(narrow, seed, "doc_id", "text", "source").drop("text")
    taken = F.col("__passes") * F.col("__size") + F.col("__part")
    return placed(found, weights, share, most).select(
        "doc_id", F.col("__size").alias("size"), "source", F.col("__source_size").alias("source_size"), F.col("__target").alias("target"),
        taken.cast("long").alias("taken"), F.col("__passes").cast("long").alias("passes"), F.when(taken > 0, F.col("__shard")).alias("shard"),
    )


def copies(docs: DataFrame, seed: int = 7, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The mix itself: documents (doc_id, text, source, ...) as often as they are taken, with all their columns.

    Documents are taken whole: the one at the end of a source's quota comes once more if at least half
    of it is within, so a source is off its target by half a document at most. Documents without words
    stay as often as their source is taken whole. Null ids and sources and repeated rows are
    documents like others. Columns may have any names. Empty tables stay empty.
    """
    own = docs.select("doc_id", "text", "source", F.struct("*").alias("row"))
    lined = placed(drawn(own, seed, "doc_id", "text", "source").drop("doc_id", "text", "source"), weights, share, most)
    once_more = F.when((F.col("__part") > 0) & (2 * F.col("__part") >= F.col("__size")), 1).otherwise(0)
    times = (F.col("__passes") + once_more).cast("int")
    return lined.where(times > 0).select("row", F.explode(F.sequence(F.lit(1), times))).select("row.*")
