"""A Merkle manifest of a dataset, with a proof for every row.

A row's leaf is the SHA-256 of its columns, each with its length. Per group (a language) the leaves
ascend by id; every ``fanout`` consecutive nodes become one until one remains, the group's subroot.
The subroots, in the order of their groups, likewise give the root.

Rows are numbered by a range partitioning, so a group may hold any share of them, and cut into
aligned units of ``fanout ** LEVELS`` leaves, each a subtree one task hashes. The units then exchange
subtree roots in a butterfly: in round r, aligned groups of ``fanout`` units that stand
``fanout ** r`` apart swap the ancestors they know, and every unit of a group hashes the common
parent for itself. So after the last round each unit holds its whole upper proof and the root;
nothing is passed down again. Where the counterpart is beyond the end of the tree, another unit
below the same ancestor, which knows it as well, sends it. The rows of a round are written before
the next one, so a lost executor costs one round.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_out

FANOUT = 2
#: Levels of the subtree of a unit: 4096 leaves at a fanout of 2.
LEVELS = 12
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: What a node sees at one level: the other nodes of its run, before and behind it.
STEP = "struct<left:string,right:string>"


def leaf_of(values: dict[str, Column]) -> Column:
    """The digest of a row: of each value `-` if null, else its length in UTF-8 bytes, a colon, and itself."""
    fields = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values.values()]
    return F.sha2(F.concat(*fields).cast("binary"), 256)


def numbered(rows: DataFrame, group: str, order: list[str], label: str) -> DataFrame:
    """``rows`` with __at, the place in their group from 0, and __of, the group's size; written once.

    ``group`` holds no nulls. Rows are ranged by group, order and a number of their own, so neither a
    large group nor equal rows meet in one task. Only counts of a range and group are summed up.
    """
    dealt = rows.withColumn("__own", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(group, *order, "__own").sortWithinPartitions(group, *order, "__own").drop("__own")
    # The number holds the partition in its upper bits, which ascend with the ranges.
    dealt = write_out(dealt.withColumn("__row", F.monotonically_increasing_id()), label)
    dealt = dealt.withColumn("__part", F.shiftright("__row", 33))
    parts = dealt.groupBy("__part", group).agg(F.min("__row").alias("__first"), F.count("*").alias("__n"))
    whole = Window.partitionBy(group)
    before = F.coalesce(F.sum("__n").over(whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("__part", group, (before - F.col("__first")).alias("__shift"), F.sum("__n").over(whole).alias("__of"))
    return dealt.join(parts, ["__part", group]).withColumn("__at", F.col("__row") + F.col("__shift")).drop("__part", "__row", "__shift")


def digest(*texts: str) -> str:
    return sha256("".join(texts).encode()).hexdigest()


def height(n: int, fanout: int) -> int:
    """Levels above ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fanout), levels + 1
    return levels


def subtree(leaves: list[str], levels: int, fanout: int) -> list[list[str]]:
    """All levels of nodes, from the leaves up."""
    out = [leaves]
    for _ in range(levels):
        below = out[-1]
        out.append([digest(*below[k : k + fanout]) for k in range(0, len(below), fanout)])
    return out


def butterfly(units: DataFrame, fanout: int = FANOUT, label: str = "butterfly") -> DataFrame:
    """(tree, unit, path, root) of units (tree, unit, units, node): every unit's upper proof, from below, and its tree's root.

    Units of a tree are numbered from 0 to ``units`` - 1, without gaps. A round is a join per fellow of a run.
    """
    state = units.select("tree", "unit", "units", "node", F.array().cast(f"array<{STEP}>").alias("path"))
    most = state.agg(F.max("units")).first()[0] or 0
    stride = 1
    while stride < most:
        step = F.lit(stride)
        at = F.expr(f"unit div {stride}")
        run = F.expr(f"unit div {stride * fanout}") * fanout
        nodes = F.ceil(F.col("units") / step).cast("long")
        told = state
        fellows = []
        for k in range(1, fanout):
            fellow = run + F.pmod(at - run + k, F.lit(fanout))
            # All units below the fellow know its node: receivers are dealt among those that exist.
            below = F.least(step, F.col("units") - fellow * stride)
            holder = F.when(fellow < nodes, fellow * stride + F.pmod(F.pmod(F.col("unit"), step), F.greatest(below, F.lit(1))))
            sent = state.select("tree", F.col("unit").alias(f"__holder{k}"), F.col("node").alias(f"__node{k}"))
            told = told.withColumn(f"__fellow{k}", fellow).withColumn(f"__holder{k}", holder).join(sent, ["tree", f"__holder{k}"], "left")
            fellows.append(F.struct(F.col(f"__fellow{k}").alias("at"), F.coalesce(f"__node{k}", F.lit("")).alias("node")))
        others = F.array_sort(F.array(*fellows))
        side = lambda mine: F.array_join(F.transform(F.filter(others, mine), lambda x: x["node"]), "")
        left, right = side(lambda x: x["at"] < at), side(lambda x: x["at"] > at)  # noqa: B023
        going = F.col("units") > step
        told = told.withColumn("__left", left).withColumn("__right", right)
        parent = F.sha2(F.concat("__left", "node", "__right").cast("binary"), 256)
        seen = F.concat("path", F.array(F.struct(F.col("__left").alias("left"), F.col("__right").alias("right"))))
        told = told.select("tree", "unit", "units", F.when(going, parent).otherwise(F.col("node")).alias("node"), F.when(going, seen).otherwise(F.col("path")).alias("path"))
        state = write_out(told, label)
        stride *= fanout
    return state.select("tree", "unit", "path", F.col("node").alias("root"))


def runs_of(keys: list[np.ndarray]) -> np.ndarray:
    """Where runs of equal keys start, and the end."""
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.append(np.flatnonzero(new), len(new))


def whole_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one unit at a time, of batches sorted by tree and unit."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        tree, unit = batch.column("tree"), batch.column("unit").to_numpy()
        cuts = runs_of([tree.dictionary_encode().indices.to_numpy(), unit])
        for start, end in zip(cuts, cuts[1:], strict=False):
            key = tree[int(start)].as_py(), int(unit[start])
            if key != last and held:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


def unit_nodes(leaves: DataFrame, fanout: int, levels: int) -> DataFrame:
    """(tree, unit, units, node): the root of every unit's subtree."""
    size = fanout**levels

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_units(batches):
            n = table.column("__of")[0].as_py()
            node = subtree(table.column("leaf").to_pylist(), min(levels, height(n, fanout)), fanout)[-1][0]
            yield pa.RecordBatch.from_pydict({"tree": [table.column("tree")[0].as_py()], "unit": [table.column("unit")[0].as_py()], "units": [-(-n // size)], "node": [node]})

    sorted_ = leaves.select("tree", "unit", "__at", "__of", "leaf").repartition("tree", "unit").sortWithinPartitions("tree", "unit", "__at")
    return sorted_.mapInArrow(hashed, "tree string, unit long, units long, node string")


def manifest(docs: DataFrame, claimed: Column, columns: tuple[str, ...] = COLUMNS, group: str = "lang", id_col: str = "doc_id", fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``claimed`` is the leaf a row is checked with, null for its own: ``folded_root`` is what it gives
    with the siblings of the manifest, ``verified`` whether that is the root. ``proof_sha256`` is the
    digest of all siblings from the leaf to the root, left to right. Null groups come first, the
    others in the order of their UTF-8 bytes; null ids come first, rows of one id follow by leaf, and
    repeated rows are leaves of their own. Other columns are not looked at. Empty tables stay empty.
    """
    if fanout < 2 or levels < 1:
        raise ValueError("a run has two nodes at least, a unit one level")
    key = docs.schema[id_col].dataType.simpleString()
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    leaf = leaf_of({c: F.col(c) for c in columns})
    # The texts are read once: what follows moves digests.
    rows = write_out(docs.select(F.col(id_col).alias("doc_id"), tree.alias("tree"), leaf.alias("leaf"), claimed.alias("claimed")), "leaves")
    placed = numbered(rows, "tree", ["doc_id", "leaf"], "ordered-leaves").withColumn("unit", F.expr(f"__at div {fanout**levels}"))
    own = butterfly(write_out(unit_nodes(placed, fanout, levels), "units"), fanout)
    groups = numbered(own.where("unit = 0").select(F.lit("").alias("all"), F.col("tree").alias("name"), "root"), "all", ["name"], "groups")
    tops = groups.select(F.col("all").alias("tree"), F.col("__at").alias("unit"), F.col("__of").alias("units"), F.col("root").alias("node"))
    above = butterfly(tops, fanout).select("unit", F.col("path").alias("above"), F.col("root").alias("whole"))
    above = groups.select(F.col("name").alias("tree"), F.col("__at").alias("unit")).join(above, "unit").drop("unit")
    heads = own.join(above, "tree").select("tree", "unit", F.concat("path", "above").alias("path"), F.col("root").alias("subroot"), F.col("whole").alias("root"))
    return proven(placed, heads, key, fanout, levels)


def proven(placed: DataFrame, heads: DataFrame, key: str, fanout: int, levels: int) -> DataFrame:
    """The result rows: each unit's head, with its upper proof, comes before its leaves."""
    only_leaf = {"doc_id": key, "leaf": "string", "claimed": "string", "__of": "long"}
    only_head = {"path": f"array<{STEP}>", "subroot": "string", "root": "string"}
    absent = lambda names: [F.lit(None).cast(t).alias(c) for c, t in names.items()]
    first = heads.select("tree", "unit", F.lit(-1).cast("long").alias("__at"), *absent(only_leaf), *only_head)
    rest = placed.select("tree", "unit", "__at", *only_leaf, *absent(only_head))
    stream = first.unionAll(rest).repartition("tree", "unit").sortWithinPartitions("tree", "unit", "__at")

    def proved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_units(batches):
            subroot, root = table.column("subroot")[0].as_py(), table.column("root")[0].as_py()
            upper = [(s["left"], s["right"]) for s in table.column("path")[0].as_py()]
            above = "".join(left + right for left, right in upper)
            table = table.slice(1)
            leaves, claims = table.column("leaf").to_pylist(), table.column("claimed").to_pylist()
            nodes = subtree(leaves, min(levels, height(table.column("__of")[0].as_py(), fanout)), fanout)
            proofs, folded = [], []
            for place, (leaf, claim) in enumerate(zip(leaves, claims, strict=True)):
                node, siblings = claim or leaf, []
                for level in nodes[:-1]:
                    start = place - place % fanout
                    left, right = "".join(level[start:place]), "".join(level[place + 1 : start + fanout])
                    siblings += left, right
                    node, place = digest(left, node, right), place // fanout
                for left, right in upper:
                    node = digest(left, node, right)
                proofs.append(digest(*siblings, above))
                folded.append(node)
            n = table.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    table.column("doc_id").combine_chunks(),
                    pa.array(leaves, pa.string()),
                    pa.array([subroot] * n, pa.string()),
                    pa.array([root] * n, pa.string()),
                    pa.array(proofs, pa.string()),
                    pa.array(folded, pa.string()),
                    pa.array([f == root for f in folded], pa.bool_()),
                ],
                ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
            )

    return stream.mapInArrow(proved, f"doc_id {key}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def tampered_leaf(every: int = 7) -> Column:
    """The leaf of documents with one more character than they have, where ``every`` divides their id's checksum; else null."""
    values = {c: F.col(c) for c in COLUMNS} | {"n_chars": F.col("n_chars") + 1}
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(every)) == 0
    return F.when(hit, leaf_of(values))
