"""Sharding over fixed virtual slots, by DataFrame operations alone.

Records are hashed into thousands of slots; bytes are summed per slot; a versioned map says
which shard holds which slot. Growing or rebalancing edits the map: records never change their
slot, and only the moved slots' records move. The map has one row per slot, a fixed number that
does not follow the data, so it is edited on the driver and broadcast.

The law is ``bytes``: shard sizes are near equal, as far as one slot's size allows.
"""

from __future__ import annotations

import heapq

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Fixed: changing it would move records between slots.
SLOTS = 4096
#: Shards whose sizes differ by no more than this share of their mean stay as they are.
EVEN = 0.0005


def slot_of(doc_id: Column, text: Column, slots: int = SLOTS) -> Column:
    """The virtual slot of a record: a hash of its id. Records without an id go by their text."""
    return F.pmod(F.when(doc_id.isNull(), F.xxhash64(text, F.lit(1))).otherwise(F.xxhash64(doc_id)), F.lit(slots)).cast("int")


def records(docs: DataFrame, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot); size is the text's UTF-8 bytes plus 1, 1 for null."""
    doc_id, text = F.col(id_col), F.col(text_col)
    body = F.encode(F.coalesce(text, F.lit("")), "UTF-8")
    return docs.select(
        doc_id.alias("doc_id"),
        (F.octet_length(F.coalesce(text, F.lit(""))).cast("long") + 1).alias("size"),
        F.crc32(body).alias("text_crc32"),
        slot_of(doc_id, text, slots).alias("virtual_slot"),
    )


def slot_sizes(found: DataFrame) -> DataFrame:
    """(virtual_slot, slot_bytes, slot_rows), combined before the shuffle: a row per slot and task at most."""
    return found.groupBy("virtual_slot").agg(F.sum("size").alias("slot_bytes"), F.count("*").alias("slot_rows"))


def first_map(shards: int, slots: int = SLOTS) -> list[int]:
    """Version 1: slots dealt round."""
    return [slot % shards for slot in range(slots)]


def rebalance(slot_map: list[int], sizes: dict[int, int], shards: int) -> list[int]:
    """The next version of a map: slots moved until shard sizes are near equal.

    Shards above the mean give up slots, largest that still fit first; those slots and the ones
    of dropped shards are dealt, largest first, to the emptiest shard. All other slots stay.
    Slots without bytes stay as well, unless their shard is gone.
    """
    new = list(slot_map)
    held: dict[int, list[int]] = {shard: [] for shard in range(shards)}
    loose = []
    for slot, shard in enumerate(slot_map):
        (held[shard] if shard < shards else loose).append(slot)
    size = {shard: sum(sizes.get(s, 0) for s in own) for shard, own in held.items()}
    mean = sum(sizes.values()) / shards
    for shard, own in held.items():
        over = size[shard] - mean
        for slot in sorted(own, key=lambda s: (-sizes.get(s, 0), s)):
            if 0 < sizes.get(slot, 0) <= over:
                over -= sizes[slot]
                size[shard] -= sizes[slot]
                loose.append(slot)
    # Small slots level out what the large ones leave: they are given up too, a few of each shard.
    for shard, own in held.items():
        gone = set(loose)
        stay = [s for s in sorted(own, key=lambda s: (sizes.get(s, 0), s)) if s not in gone and sizes.get(s, 0)]
        for slot in stay[: max(1, len(stay) // 8)]:
            size[shard] -= sizes[slot]
            loose.append(slot)
    emptiest = [(size[shard], shard) for shard in range(shards)]
    heapq.heapify(emptiest)
    for slot in sorted(loose, key=lambda s: (-sizes.get(s, 0), s)):
        total, shard = heapq.heappop(emptiest)
        new[slot] = shard
        heapq.heappush(emptiest, (total + sizes.get(slot, 0), shard))
    return new


def grow(slot_map: list[int], sizes: dict[int, int], shards: int) -> list[int]:
    """The map's next version with one more shard, number ``shards``: slots move only into it.

    Each old shard gives slots, largest first, as far as its surplus over the new mean goes.
    """
    new, mean = list(slot_map), sum(sizes.values()) / (shards + 1)
    for shard in range(shards):
        own = sorted((s for s, at in enumerate(slot_map) if at == shard), key=lambda s: (-sizes.get(s, 0), s))
        over = sum(sizes.get(s, 0) for s in own) - mean
        for slot in own:
            if 0 < sizes.get(slot, 0) <= over:
                over -= sizes[slot]
                new[slot] = shards
    return new


def per_slot(spark: SparkSession, values: list[int], name: str) -> DataFrame:
    """(virtual_slot, ``name``) from one value per slot."""
    text = F.lit(",".join(map(str, values)))
    return spark.range(1).select(F.posexplode(F.split(text, ",")).alias("virtual_slot", name)).withColumn(name, F.col(name).cast("long"))


def map_table(spark: SparkSession, versions: list[list[int]], first: int = 1) -> DataFrame:
    """The versioned map as a table: (version, virtual_slot, shard)."""
    tables = [per_slot(spark, v, "shard").select(F.lit(n).alias("version"), "virtual_slot", F.col("shard").cast("int")) for n, v in enumerate(versions, first)]
    table = tables[0]
    for more in tables[1:]:
        table = table.unionAll(more)
    return table


def positions(found: DataFrame, counted: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Records with their shard and their place in it, gapless from 0.

    A shard's slots follow each other by number, a slot's records by id. The offset of a slot is a
    running sum over the map, so records are only sorted within their slot.
    """
    by_slot = slot_map.join(counted, "virtual_slot")
    before = F.sum("slot_rows").over(Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1))
    offsets = by_slot.select("virtual_slot", "shard", F.coalesce(before, F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    return (
        found.withColumn("within", within)
        .join(F.broadcast(offsets), "virtual_slot")  # one row per slot, a fixed number
        .withColumn("slot", F.col("offset") + F.col("within") - 1)
    )


def newest_map(spark: SparkSession, store: str, slots: int = SLOTS) -> tuple[int, list[int]] | None:
    """(version, shard of each slot) of the last complete version under ``store``; None if there is none.

    A version is a row per slot. One that a lost job left incomplete does not count, and its number is not used again.
    """
    try:
        table = spark.read.schema("version int, virtual_slot int, shard int").parquet(store)
        counts = {r.version: r["count"] for r in table.groupBy("version").count().collect()}
    except AnalysisException:  # nothing is stored yet
        return None
    done = [v for v, n in counts.items() if n == slots]
    if not done:
        return (max(counts, default=0), first_map(1, slots)) if counts else None
    rows = table.where(F.col("version") == max(done)).collect()  # a row per slot: a fixed number
    found = [0] * slots
    for r in rows:
        found[r.virtual_slot] = r.shard
    return max(counts), found


def next_map(known: list[int] | None, sizes: dict[int, int], shards: int, slots: int = SLOTS) -> list[int]:
    """The map for these slot sizes: the known one edited, or the first one.

    With one more shard than before, slots move only into it. Otherwise the map is left as it is while its
    shards are within ``EVEN`` of each other, and rebalanced if not.
    """
    if known is None:
        return rebalance(first_map(shards, slots), sizes, shards)
    held = max(known) + 1
    if shards == held + 1:
        return grow(known, sizes, held)
    if shards == held:
        totals = [0] * shards
        for slot, at in enumerate(known):
            totals[at] += sizes.get(slot, 0)
        if max(totals) - min(totals) <= EVEN * sum(totals) / shards:
            return list(known)
    return rebalance(known, sizes, shards)


def shard(docs: DataFrame, shards: int, store: str | None = None, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All records with size, text_crc32, law, shard, slot (place in the shard) and virtual_slot.

    Null texts have size 1 and the checksum of the empty text; null ids are dealt by their text;
    repeated rows share a slot and get places one after the other. Other columns are not looked
    at. An empty table gives an empty result. ``store`` is a folder with the versions of the map: the
    newest one is edited for the records at hand, and what changed becomes the next version.
    """
    spark = docs.sparkSession
    found = records(docs, slots, id_col, text_col)
    # One row per slot: a fixed number, whatever the data.
    sums = found.transform(slot_sizes).collect()
    sizes = {r.virtual_slot: r.slot_bytes for r in sums}
    last = newest_map(spark, store, slots) if store else None
    version, known = last or (0, None)
    current = next_map(known, sizes, shards, slots)
    if store and current != known:
        map_table(spark, [current], version + 1).write.mode("append").parquet(store)
    rows = {r.virtual_slot: r.slot_rows for r in sums}
    counted = per_slot(spark, [rows.get(s, 0) for s in range(slots)], "slot_rows")
    return positions(found, counted, map_table(spark, [current]).drop("version")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )
