"""MinHash near-duplicates: universal hash minima, bands, verification, connected components.

Documents are sets of five-word shingles. Documents with equal sets form a class, and only
classes go on. Classes that agree in a band of their signature share a bucket. In each bucket
the class that shares most with others leads and is compared with each member, signatures
first, then full sets; links give components by alternating large-star and small-star. Where a
bucket still holds several components, all pairs of classes across components are compared, in
blocks of a fixed number of members: by exact bounds on what they can share, then signatures, then full
sets. So a large group of copies costs one comparison per member, and no link between classes that
share a bucket is lost.

With ``BANDS`` bands of ``ROWS`` minima, a pair at similarity 0.75 shares no bucket with
probability (1 - 0.75 ** ROWS) ** BANDS, about 3e-7; from 0.8 on less than 1e-9. Other
similarities get bands of their own (``banding``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_out
from .common import WordHashes, minima, shingles, slices, texts, universal

BANDS, ROWS = 40, 4
SEED = 1
#: A pair at the least similarity shares no bucket with a probability of at most this.
MISSED = 4e-7
#: Pairs whose signatures agree in fewer places are not compared further: so many deviations below the least similarity.
DEVIATIONS = 5.26
#: Further minima, a byte of each, for classes that are compared pair by pair.
SKETCH = 480
#: Members of a bucket that are compared within one task at a time.
BLOCK = 512


def banding(percent: int, minima: int = BANDS * ROWS) -> tuple[int, int]:
    """(bands, rows) that ``minima`` make: rows as long as a pair at ``percent`` is ``MISSED`` seldom enough.

    75 gives ``BANDS`` and ``ROWS``. Below some similarity no banding of so few minima is safe.
    """
    share = percent / 100
    safe = [r for r in range(1, minima + 1) if (1 - share**r) ** (minima // r) <= MISSED]
    if not safe or percent > 100:
        raise ValueError(f"{minima} minima cannot find pairs at {percent} percent")
    return minima // safe[-1], safe[-1]


def least_agreeing(percent: int, places: int) -> float:
    """The share of places in which the signatures of a pair at ``percent`` agree nearly surely."""
    share = percent / 100
    return share - DEVIATIONS * (share * (1 - share) / places) ** 0.5


def sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, nameless, n_shingles, set_id, signature): the set's digest and its least hashes, null for empty sets.

    ``nameless`` is a hash of the text where the id is null.
    """
    a, b = universal(bands * rows, SEED)
    key = docs.schema[id_col].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            for part in slices(batch, "text"):
                found = [shingles(t, words) for t in texts(part, "text")]
                least = minima(found, a, b).view(np.int32)
                empty = np.array([not len(s) for s in found], bool)
                offsets = pa.array(np.arange(0, least.size + 1, least.shape[1], dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("nameless"),
                        pa.array([len(s) for s in found], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in found], pa.binary()),
                        pa.ListArray.from_arrays(offsets, pa.array(least.reshape(-1)), mask=pa.array(empty)),
                    ],
                    ["doc_id", "nameless", "n_shingles", "set_id", "signature"],
                )

    return named_texts(docs, id_col, text_col).mapInArrow(hashed, f"doc_id {key}, nameless long, n_shingles long, set_id binary, signature array<int>")


def named_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, nameless): texts that have no id go by a hash."""
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return named.withColumn("nameless", F.when(F.col("doc_id").isNull(), F.xxhash64("text")))


def buckets(classes: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(bucket, band, set_id, members): classes by band, where a band is shared by two or more."""
    hashes = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.xxhash64(i, F.slice("signature", i * rows + 1, F.lit(rows))))
    dealt = classes.select("set_id", F.posexplode(hashes).alias("band", "bucket"))
    return dealt.withColumn("members", F.count("*").over(Window.partitionBy("bucket"))).where("members > 1")


def leader_pairs(shared: DataFrame) -> DataFrame:
    """(a, b): each member of a bucket with the bucket's leader, the class that shares most buckets with most others."""
    weight = shared.groupBy("set_id").agg(F.sum("members").alias("weight"))
    best = F.max_by("set_id", F.struct("weight", "set_id"))
    led = shared.join(weight, "set_id")
    leaders = led.groupBy("bucket").agg(best.alias("leader"))
    return (
        led.join(leaders, "bucket")
        .where("set_id != leader")
        .select(F.least("set_id", "leader").alias("a"), F.greatest("set_id", "leader").alias("b"))
        .distinct()
    )


def agreeing(x, y):
    """The share of places in which two signatures agree."""
    same = F.aggregate(F.zip_with(x, y, lambda p, q: F.when(p == q, 1).otherwise(0)), F.lit(0), lambda s, v: s + v)
    return same / F.size(x)


def alike(pairs: DataFrame, classes: DataFrame, percent: int = 75, places: int = BANDS * ROWS) -> DataFrame:
    """Signature verification: the (a, b) pairs whose signatures agree often enough."""
    signed = classes.select("set_id", "signature")
    for side in ("a", "b"):
        pairs = pairs.join(signed.toDF(side, f"signature_{side}"), side)
    return pairs.where(agreeing(F.col("signature_a"), F.col("signature_b")) >= least_agreeing(percent, places)).select("a", "b")


def full_sets(docs: DataFrame, found: DataFrame, wanted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(set_id, shingles) of the wanted classes, from one document of each: the smallest id, or a text where all ids are null."""
    first = found.join(wanted, "set_id").groupBy("set_id").agg(F.min("doc_id").alias("first_id"), F.min("nameless").alias("first_text"))
    first = first.select("first_id", F.when(F.col("first_id").isNull(), F.col("first_text")).alias("first_text")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("first_id")) & F.col("nameless").eqNullSafe(F.col("first_text"))
    chosen = named_texts(docs, id_col, text_col).join(first, same, "left_semi")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            for part in slices(batch, "text"):
                own = [s for s in (shingles(t, words) for t in texts(part, "text")) if len(s)]
                ids = [xxhash.xxh3_128_digest(s.tobytes()) for s in own]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array([s.view(np.int64) for s in own], pa.list_(pa.int64()))], ["set_id", "shingles"])

    return chosen.select("text").mapInArrow(hashed, "set_id binary, shingles array<long>").dropDuplicates(["set_id"])


def linked(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """The (a, b) pairs with 100 * intersection >= percent * union of their full sets."""
    for side in ("a", "b"):
        pairs = pairs.join(full.toDF(side, f"set_{side}"), side)
    common = F.size(F.array_intersect("set_a", "set_b")).cast("long")
    union = F.size("set_a") + F.size("set_b") - common
    return pairs.where(100 * common >= percent * union).select("a", "b")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): nodes of at least one edge with the smallest node of their component.

    Large-star hangs each node's larger neighbours below its smallest one, small-star hangs a node
    and its smaller neighbours below the smallest of them, until nothing changes. Each round is
    written to the shared folder, which cuts the lineage. Only counts and checksums reach the driver.
    """
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    edges, before = write_out(edges, "edges"), None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        # All edges lead from larger to smaller nodes here.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = write_out(small.union(least.toDF("u", "v")).distinct(), "edges")
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").bitwiseAND(F.lit(0xFFFFFFFF)))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())
        before = state


def shareable(full: DataFrame, wanted: DataFrame) -> DataFrame:
    """(set_id, n, most): set sizes, and how many shingles at most a class shares with another wanted one.

    A shingle that only one class holds is in no intersection. Counts combine before the shuffle, so
    a shingle that all share costs a row per task; no shingle's classes are gathered.
    """
    own = full.join(wanted, "set_id", "left_semi").select("set_id", "shingles", F.xxhash64("set_id").alias("h"), F.xxhash64(F.lit(1), "set_id").alias("g"))
    each = own.select("h", "g", F.explode("shingles").alias("shingle"))
    once = each.groupBy("shingle").agg(F.count("*").alias("times"), F.min("h").alias("h"), F.min("g").alias("g")).where("times = 1")
    alone = once.groupBy("h", "g").agg(F.count("*").alias("alone"))
    size = F.size("shingles").cast("long")
    return own.join(alone, ["h", "g"], "left").select("set_id", size.alias("n"), (size - F.coalesce("alone", F.lit(0))).alias("most"))


def sketches(full: DataFrame, wanted: DataFrame) -> DataFrame:
    """(set_id, sketch): a byte of each of ``SKETCH`` further minima of the wanted classes."""
    a, b = universal(SKETCH, SEED + 1)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [s.view(np.uint64) for s in (x.values.to_numpy() for x in batch.column("shingles"))]
            least = (minima(held, a, b) & np.uint32(0xFF)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column("set_id"), pa.array([row.tobytes() for row in least], pa.binary())], ["set_id", "sketch"])

    return full.join(wanted, "set_id", "left_semi").select("set_id", "shingles").mapInArrow(hashed, "set_id binary, sketch binary")


def open_members(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """(bucket, band, set_id, root): the members of buckets that hold several components."""
    found = shared.join(roots, shared["set_id"] == roots["node"], "left").select("bucket", "band", "set_id", F.coalesce("root", "set_id").alias("root"))
    several = found.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high")
    return found.join(several.select("bucket"), "bucket", "left_semi")


def open_pairs(shared: DataFrame, roots: DataFrame, classes: DataFrame, full: DataFrame, percent: int = 75, bands: int = BANDS) -> DataFrame:
    """(a, b): classes of one bucket and different components that may be linked.

    Exact bounds come first: a class whose shingles are mostly its own is linked with nothing, and
    a pair shares no more than the smaller of the two shareable numbers. Then signatures are
    compared, longer ones than before. A pair is given by the first band it shares. Members of a bucket are cut into blocks, and
    each pair of blocks is compared by one task, so memory is bounded however large a bucket is.
    """
    found = open_members(shared, roots)
    sizes = shareable(full, found.select("set_id").distinct()).where(F.col("most") * 100 >= F.col("n") * percent)
    found = write_out(found.join(sizes, "set_id"), "open-members")
    several = found.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("members")).where("low != high")
    rest = found.join(several, "bucket").join(classes.select("set_id", "signature"), "set_id")
    rest = rest.join(sketches(full, rest.select("set_id").distinct()), "set_id")
    rest = rest.withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
    rest = rest.withColumn("own", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rest = rest.select(
        "bucket", "band", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "set_id",
        F.xxhash64("root").alias("root"), "n", "most", "signature", "sketch",
    )
    group = ["bucket", "p", "q"]

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if left is None else [*left.to_batches(), batch]).combine_chunks()
            start = group_starts(table, group)
            # The last group may go on in the next batch; none has more than two blocks.
            left = table.slice(int(start[-1])) if len(start) else table
            yield from pairs_within(table.slice(0, table.num_rows - left.num_rows), group, percent, bands)
        if left is not None:
            yield from pairs_within(left, group, percent, bands)

    return rest.repartition(*group).sortWithinPartitions(*group, "set_id").mapInArrow(compared, "a binary, b binary").distinct()


def group_starts(table: pa.Table, group: list[str]) -> np.ndarray:
    """Where runs of equal groups start in a sorted table."""
    if not table.num_rows:
        return np.empty(0, np.int64)
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for name in group:
        value = table.column(name).to_numpy()
        new[1:] |= value[1:] != value[:-1]
    return np.flatnonzero(new)


def pairs_within(table: pa.Table, group: list[str], percent: int, bands: int, chunk: int = 20_000) -> Iterator[pa.RecordBatch]:
    """The pairs of each group's rows that pass bounds and signatures; rows are sorted by group and set_id."""
    rows = table.num_rows
    if rows < 2:
        return
    table = table.combine_chunks()
    starts = group_starts(table, group)
    number = np.cumsum(np.bincount(starts, minlength=rows))
    column = {name: table.column(name).to_numpy() for name in ("p", "q", "own", "root", "n", "most", "band")}
    signature = table.column("signature").combine_chunks().flatten().to_numpy().reshape(rows, -1)
    sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(rows, -1)
    ids = table.column("set_id").combine_chunks()
    places = signature.shape[1]
    least_signed = least_agreeing(percent, places) * places
    least = least_agreeing(percent, places + sketch.shape[1]) * (places + sketch.shape[1])
    longest = int(np.diff(np.append(starts, rows)).max())
    for apart in range(1, longest):
        i = np.flatnonzero(number[:-apart] == number[apart:])
        j = i + apart
        open_ = (column["root"][i] != column["root"][j]) & ((column["p"][i] == column["q"][i]) | (column["own"][i] != column["own"][j]))
        i, j = i[open_], j[open_]
        common = np.minimum(column["most"][i], column["most"][j])
        could = 100 * common >= percent * (column["n"][i] + column["n"][j] - common)
        i, j = i[could], j[could]
        for k in range(0, len(i), chunk):
            x, y = i[k : k + chunk], j[k : k + chunk]
            same = signature[x] == signature[y]
            # Earlier bands that agree already have the pair.
            first = same.reshape(len(x), bands, -1).all(axis=2).argmax(axis=1)
            agree = same.sum(axis=1)
            near = (agree >= least_signed) & (first == column["band"][x])
            x, y, agree = x[near], y[near], agree[near]
            near = agree + (sketch[x] == sketch[y]).sum(axis=1) >= least
            x, y = x[near], y[near]
            if len(x):
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(x)), ids.take(pa.array(y))], ["a", "b"])


def groups(docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text", found: DataFrame | None = None, minima: int = BANDS * ROWS) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest doc_id reachable), kept, class_id.

    Null, empty and wordless texts have no shingles and are linked with nothing. Repeated rows and
    documents with equal sets share a class. A null doc_id is never a component's id, unless no
    other document is in it; such a document is kept. Other columns are not looked at, whatever
    their names. An empty table gives an empty result. ``percent`` decides the bands and how many places
    must agree; one that is too low for the signatures is refused. ``found`` are the rows of ``sets`` of these documents
    where they exist already, with signatures of ``minima`` places.
    """
    bands, rows = banding(percent, minima)
    if found is None:
        found = write_out(sets(docs, id_col, text_col, bands, rows), "sets")
    classes = found.where("set_id is not null").groupBy("set_id").agg(F.any_value("signature").alias("signature"))
    shared = write_out(buckets(classes, bands, rows), "buckets")
    wanted = shared.select("set_id").distinct()
    classes = write_out(found.join(wanted, "set_id", "left_semi").dropDuplicates(["set_id"]).select("set_id", "signature"), "classes")
    full = write_out(full_sets(docs, found, wanted, id_col, text_col), "full-sets")
    links = write_out(linked(alike(leader_pairs(shared), classes, percent, bands * rows), full, percent), "links")
    roots = components(links)
    more = write_out(linked(open_pairs(shared, roots, classes, full, percent, bands), full, percent), "links")
    if not more.isEmpty():
        # The components so far are stars already.
        roots = components(roots.select("node", "root").toDF("a", "b").union(more))
    roots = roots.withColumnRenamed("node", "set_id")
    named = found.select("doc_id", "n_shingles", "set_id").join(roots, "set_id", "left")
    named = named.withColumn("root", F.coalesce("root", "set_id"))
    least = named.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    out = named.join(least, "root", "left").withColumn("component_id", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least")))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), F.hex("set_id").alias("class_id"))
