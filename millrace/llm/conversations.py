"""Repair of conversation structure by the fewest and cheapest edits, with Four-Russians block tables.

A sound conversation is empty, or an optional system turn and then user and assistant turns in
alternation, ending with an assistant's: ``(s?(ua)+)?``. Turns are symbols of an alphabet of nine;
the state is what was said last. For every state the cost of repairing the rest is a vector of four
numbers that differ by little, so there are few normalised vectors. Tables give, for each vector and
each block of ``BLOCK`` symbols, the vector before the block and the cost it adds. A conversation is
looked up block by block from its end; then blocks are expanded backward one after the other,
from the vector behind them, and traced forward, which yields the least of all cheapest edits.

On Spark, rows are sorted by ranges of conversation and turn, so one conversation may hold any
share of them; a range hands on a string of symbols per conversation, a byte per row, and these
strings are joined and repaired. Only the digest of the repaired text, which is a chain by its
nature, passes through one task per conversation, as a stream.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import write_out

#: What counts as blank; a turn that says something ends with one of ``STOPS``.
SPACE = "".join(map(chr, (32, 9, 10, 11, 12, 13)))
STOPS = ".!?"

# Costs: a kept turn costs nothing, a truncated turn that is not deleted adds TRUNCATED.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

#: States: nothing yet, after system, after user, after assistant. What may be inserted or reroled leads to:
START, SYSTEM, USER, ASSISTANT = range(4)
GIVEN = (USER, USER, ASSISTANT, USER)
#: States by role initial from which a turn can be kept, and where it leads.
KEPT = {"s": ((START,), SYSTEM), "u": ((START, SYSTEM, ASSISTANT), USER), "a": ((USER,), ASSISTANT)}
NAMES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = "sua"
#: Symbols: 0 must be deleted, then two for each initial and any other one: whole, truncated.
SYMBOLS = 9
#: Symbols of a block.
BLOCK = 4


def symbol(initial: str, truncated: bool) -> int:
    at = INITIALS.find(initial) if initial else -1
    return 1 + 2 * (at if at >= 0 else 3) + truncated


def after(rest: tuple[int, ...], code: int) -> tuple[int, ...]:
    """The cost of each state with the symbol ahead, from the costs behind it."""
    out = []
    for state in range(4):
        out.append(min(cost + rest[to] for _, cost, to in choices(state, code)))
    return closed(out)


def choices(state: int, code: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) that take a turn, in the order of their letters."""
    found = [("D", DELETE, state)]
    if code:
        extra = TRUNCATED * ((code - 1) & 1)
        kind = (code - 1) >> 1
        if kind < 3 and state in KEPT[INITIALS[kind]][0]:
            found.append(("K", extra, KEPT[INITIALS[kind]][1]))
        found.append(("R", REROLE + extra, GIVEN[state]))
    return found


def closed(costs: list[int]) -> tuple[int, ...]:
    """Costs when turns may be inserted first; states repeat after two, so two rounds do."""
    for _ in range(2):
        costs = [min(c, INSERT + costs[GIVEN[s]]) for s, c in enumerate(costs)]
    return tuple(costs)


class Tables:
    """Normalised cost vectors, their transitions for symbols and blocks, and the edits that reach them."""

    def __init__(self, block: int = BLOCK) -> None:
        far = 1 << 20  # not an end
        last = closed([0, far, far, 0])
        self.block, self.vectors, self.number = block, [], {}
        self.last = self._of(last)[0]
        step, cost, k = [], [], 0
        while k < len(self.vectors):
            found = [self._of(after(self.vectors[k], code)) for code in range(SYMBOLS)]
            step.append([v for v, _ in found])
            cost.append([c for _, c in found])
            k += 1
        self.step, self.cost = np.array(step), np.array(cost)
        # Blocks: symbol codes as digits, the first symbol highest; the last symbol is taken first.
        self.blocks, self.block_cost = self.step, self.cost
        for _ in range(block - 1):
            before = self.step[self.blocks]  # (vector, block, symbol ahead)
            added = self.block_cost[:, :, None] + self.cost[self.blocks]
            self.blocks = before.transpose(0, 2, 1).reshape(len(step), -1)
            self.block_cost = added.transpose(0, 2, 1).reshape(len(step), -1)
        self.traces = {(v, code, s): self._trace(v, code, s) for v in range(k) for code in range(SYMBOLS) for s in range(4)}
        self.ends = [self._insert(last, s) for s in range(4)]

    def _of(self, costs: tuple[int, ...]) -> tuple[int, int]:
        least = min(costs)
        vector = tuple(c - least for c in costs)
        if vector not in self.number:
            self.number[vector] = len(self.vectors)
            self.vectors.append(vector)
        return self.number[vector], least

    def _trace(self, behind: int, code: int, state: int) -> tuple[str, int]:
        """The least cheapest edits before and of a symbol, from the vector behind it, and the state they lead to."""
        rest = self.vectors[behind]
        now, edits = after(rest, code), ""
        while True:
            for edit, cost, to in sorted([*choices(state, code), ("I", INSERT, GIVEN[state])]):
                if now[state] == cost + (now if edit == "I" else rest)[to]:
                    break
            edits, state = edits + edit, to
            if edit != "I":
                return edits, state

    def _insert(self, last: tuple[int, ...], state: int) -> str:
        edits = ""
        while last[state]:
            edits, state = edits + "I", GIVEN[state]
        return edits

    def repair(self, symbols: bytes) -> tuple[int, str]:
        """The cost and the edits."""
        size, step, blocks = self.block, self.step, self.blocks
        codes = np.frombuffer(symbols, np.uint8).astype(np.int64)
        whole = len(codes) // size
        numbers = codes[: whole * size].reshape(whole, size) @ SYMBOLS ** np.arange(size - 1, -1, -1)
        vector, total = self.last, 0
        for code in codes[: whole * size - 1 if whole else None : -1].tolist():
            total += int(self.cost[vector, code])
            vector = int(step[vector, code])
        behind = np.empty(whole, np.int32)
        for k in range(whole - 1, -1, -1):
            behind[k] = vector
            total += int(self.block_cost[vector, numbers[k]])
            vector = int(blocks[vector, numbers[k]])
        total += self.vectors[vector][START]
        edits, state = [], START
        tail = codes[whole * size :].tolist()
        for k in range(whole + bool(tail)):
            own = codes[k * size : (k + 1) * size].tolist() if k < whole else tail
            # Expand the block backward, then trace it forward.
            at = [int(behind[k]) if k < whole else self.last]
            for code in own[:0:-1]:
                at.append(int(step[at[-1], code]))
            for code, vector in zip(own, reversed(at), strict=True):
                letters, state = self.traces[vector, code, state]
                edits.append(letters)
        return total, "".join(edits) + self.ends[state]


@functools.cache
def tables() -> Tables:
    return Tables()


# -- damage ------------------------------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows damaged by a checksum of conversation and turn; nulls read as one space.

    Of twenty remainders 0 drops a row (no copies), 1 empties its text, 2 takes its stops away, 3
    repeats it, 4 makes it the user's.
    """
    blank = F.lit(" ")
    read = lambda c: F.coalesce(F.col(c).cast("string"), blank)
    code = F.pmod(F.crc32(F.concat(read("conv_id"), F.lit(":"), read("turn"))), F.lit(20))
    role, text = read("role"), read("text")
    return rows.select(
        "conv_id",
        "turn",
        F.when(code == 4, "user").otherwise(role).alias("role"),
        F.when(code == 1, "").when(code == 2, F.translate(text, STOPS, "")).otherwise(text).alias("text"),
        F.when(code == 0, 0).when(code == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


# -- symbols -----------------------------------------------------------------------------------


def faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies, blank, duplicate, truncated): one row per distinct row, with its first copy's fault.

    Equal rows are counted before the shuffle. A row repeats an earlier turn where its role and text
    have an earlier first turn in the conversation.
    """
    rows = write_out(rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")), "turns")
    said = F.rtrim(F.col("text"), F.lit(SPACE))
    rows = rows.withColumn("said", said).select(
        "conv_id", "turn", "role", "text", "copies", (F.length("said") == 0).alias("blank"), (~F.right("said", F.lit(1)).isin(*STOPS)).alias("open"),
        F.xxhash64("role", "text").alias("p"), F.xxhash64(F.lit(1), "text", "role").alias("q"),
    )
    # Rows that are said in several turns are few and narrow.
    firsts = rows.where("copies > 0 and not blank").groupBy("conv_id", "p", "q").agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("n"))
    firsts = firsts.where("n > 1").select(F.col("conv_id").alias("c"), F.col("p").alias("x"), F.col("q").alias("y"), F.col("first.turn").alias("t"), F.lit(True).alias("several"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("p") == F.col("x")) & (F.col("q") == F.col("y"))
    repeats = F.coalesce("several", F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("t")) & ~F.col("blank")
    joined = rows.join(firsts, same, "left")
    return joined.select("conv_id", "turn", "role", "text", "copies", "blank", repeats.alias("duplicate"), (F.col("open") & ~F.col("blank") & ~repeats).alias("truncated"))


#: What a stretch of a conversation's rows tells: edits need the symbols, the counts add up.
STRETCH = "symbols binary, blank long, duplicate long, truncated long, illegal long, first string, last string, low long, high long, turns long"


def stretches(ordered: DataFrame, key: str) -> DataFrame:
    """(conv_id, row, ...): a row per conversation and run of consecutive sorted rows."""

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("row", "conv_id", "turn", "initial", "copies", "blank", "duplicate", "truncated")), strict=True)
            before = own = None
            for row, conv_id, turn, initial, copies, blank, duplicate, truncated in rows:
                if own is None or before != (conv_id, row - 1):
                    own = Stretch(conv_id, row)
                    out.append(own)
                before = conv_id, row
                if copies:
                    own.add(turn, initial, copies, blank, duplicate, truncated)
            if out:
                values = list(zip(*(s.told() for s in out), strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, [batch.schema.field("conv_id").type, *types], strict=True)], names)

    schema = f"conv_id {key}, row long, {STRETCH}"
    names = [c.split()[0] for c in schema.split(", ")]
    long, text = pa.int64(), pa.string()
    types = [long, pa.binary(), long, long, long, long, text, text, long, long, long]
    return ordered.mapInArrow(told, schema)


class Stretch:
    def __init__(self, conv_id, row: int) -> None:
        self.conv_id, self.row, self.symbols = conv_id, row, bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None

    def add(self, turn, initial: str, copies: int, blank: bool, duplicate: bool, truncated: bool) -> None:
        self.symbols.append(0 if blank or duplicate else symbol(initial, truncated))
        self.symbols += bytes(copies - 1)
        self.blank += copies * blank
        self.duplicate += copies - 1 + duplicate if not blank else 0
        self.truncated += truncated
        if self.last is not None:
            self.illegal += illegal(self.last, initial)
        self.illegal += copies - 1  # a row and its copy never alternate
        self.first, self.last = initial if self.first is None else self.first, initial
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1

    def told(self) -> tuple:
        return (
            self.conv_id, self.row, bytes(self.symbols), self.blank, self.duplicate, self.truncated, self.illegal,
            self.first, self.last, self.low, self.high, self.turns,
        )


def illegal(left: str, right: str) -> bool:
    return left + right not in ("su", "ua", "au")


def verdict(parts: list[dict]) -> tuple:
    """(gaps, blank, duplicate, truncated, illegal, cost, audit) of a conversation's stretches."""
    parts = sorted(parts, key=lambda p: p["row"])
    totals = [sum(p[name] for p in parts) for name in ("blank", "duplicate", "truncated", "illegal")]
    said = [p for p in parts if p["symbols"]]
    totals[3] += sum(illegal(x["last"], y["first"]) for x, y in zip(said, said[1:], strict=False))
    dated = [p for p in said if p["turns"]]
    gaps = 0
    if dated:
        turns = sum(p["turns"] for p in dated) - sum(x["high"] == y["low"] for x, y in zip(dated, dated[1:], strict=False))
        gaps = dated[-1]["high"] - dated[0]["low"] + 1 - turns
    return gaps, *totals, *tables().repair(b"".join(p["symbols"] for p in parts))


# -- repair ------------------------------------------------------------------------------------

AUDIT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def audits(told: DataFrame, key: str) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) from stretches, at most one of a conversation per scan task and batch."""
    names = [c.split()[0] for c in f"conv_id {key}, {AUDIT}".split(", ")]
    fields = [c.split()[0] for c in STRETCH.split(", ")]

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = list(zip(*map(verdict, batch.column("parts").to_pylist()), strict=True))
                yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *(pa.array(x) for x in found)], names)

    return told.groupBy("conv_id").agg(F.collect_list(F.struct("row", *fields)).alias("parts")).mapInArrow(judged, f"conv_id {key}, {AUDIT}")


class Repaired:
    """The digest of a conversation as its rows go by."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state, self.sha, self.begun = audit, 0, START, sha256(), False

    def _say(self, role: str, text: str) -> None:
        self.sha.update(f"{chr(10) if self.begun else ''}{role}:{text}".encode())
        self.begun = True

    def _insert(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.state, self.at = GIVEN[self.state], self.at + 1
            self._say(NAMES[self.state], "")

    def add(self, role: str, text: str) -> None:
        self._insert()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "R":
            self.state = GIVEN[self.state]
            self._say(NAMES[self.state], text)
        elif edit == "K":
            self.state = KEPT[role[0]][1]
            self._say(role, text)

    def digest(self) -> str:
        self._insert()
        return self.sha.hexdigest()


def repair(rows: DataFrame) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``rows`` are (conv_id, turn, role, text, copies), as ``damaged`` gives them. Rows go by turn, nulls
    first, those of one turn by role and text. A row's first fault counts: blank, duplicate (its role
    and text come earlier), truncated. Roles other than system, user and assistant, by their initial,
    cannot be kept. A conversation without rows has zeros, no edits and the digest of nothing; a null
    conv_id is a conversation as well. Empty tables stay empty. conv_id is an integer or a text, turn
    an integer.
    """
    key = rows.schema["conv_id"].dataType.simpleString()
    order = ["conv_id", "turn", "role", "text"]
    ordered = faults(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = write_out(ordered.withColumn("row", F.monotonically_increasing_id()), "ordered-turns")
    narrow = ordered.select("row", "conv_id", F.col("turn").cast("long").alias("turn"), F.substring("role", 1, 1).alias("initial"), "copies", "blank", "duplicate", "truncated")
    found = audits(stretches(narrow, key), key)
    names = [c.split()[0] for c in AUDIT.split(", ")]
    types = dict(c.split() for c in AUDIT.split(", "))
    heads = found.select("conv_id", F.lit(-1).cast("long").alias("row"), *names, *(F.lit(None).cast(t).alias(c) for c, t in (("role", "string"), ("text", "string"), ("copies", "long"))))
    lines = ordered.where("copies > 0").select("conv_id", "row", *(F.lit(None).cast(types[c]).alias(c) for c in names), "role", "text", "copies")
    stream = heads.unionAll(lines).repartition("conv_id").sortWithinPartitions("conv_id", "row")

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, own = None, None
        for batch in batches:
            done = []
            at, copies = batch.column("row").to_pylist(), batch.column("copies").to_pylist()
            roles, texts = batch.column("role").to_pylist(), batch.column("text").to_pylist()
            for k, row in enumerate(at):
                if row < 0:
                    if head is not None:
                        done.append((*head, own.digest()))
                    head = tuple(batch.column(c)[k].as_py() for c in ("conv_id", *names))
                    own = Repaired(head[-1])
                else:
                    own.add(roles[k], texts[k])
                    for _ in range(copies[k] - 1):
                        own.add(roles[k], texts[k])
            if done:
                yield result(done, batch)
            last = batch
        if head is not None:
            yield result([(*head, own.digest())], last)

    def result(done: list[tuple], batch: pa.RecordBatch) -> pa.RecordBatch:
        types_ = [batch.schema.field("conv_id").type, *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done, strict=True), types_, strict=True)], ["conv_id", *names, "repaired_sha256"])

    return stream.mapInArrow(finished, f"conv_id {key}, {AUDIT}, repaired_sha256 string")
