"""Conversation repair against a search over all edits, with its own reading of the damage."""

import itertools
import random
import zlib
from functools import cache
from hashlib import sha256

import numpy as np
import pytest

from millrace.llm import conversations
from millrace.llm.common import ship

BLANK = " \t\n\x0b\f\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if code == 0:
            continue
        if code == 1:
            text = ""
        if code == 2:
            text = "".join(c for c in text if c not in ".!?")
        if code == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if code == 3 else 1)
    return out


def cheapest(kinds):
    """(cost, edits): the least of all cheapest ones. ``kinds`` are (initial, must go, truncated)."""

    @cache
    def rest(i, said):
        options = []
        given = "a" if said == "u" else "u"
        if i < len(kinds):
            initial, gone, truncated = kinds[i]
            options.append((4, "D", i + 1, said))
            if not gone:
                allowed = {"s": "-", "u": "-sa", "a": "u"}.get(initial, "")
                if said in allowed:
                    options.append((3 * truncated, "K", i + 1, initial))
                options.append((3 + 3 * truncated, "R", i + 1, given))
        return options, given

    # Insertions never pay beyond two in a row, so costs come from a search over (row, said) states.
    best = {}

    def solve(i, said, inserted=0):
        if (i, said, inserted) in best:
            return best[i, said, inserted]
        options, given = rest(i, said)
        found = [(0, "")] if i == len(kinds) and said in "-a" else []
        if inserted < 2:
            cost, edits = solve(i, given, inserted + 1)
            found.append((cost + 3, "I" + edits))
        for cost, letter, j, then in options:
            more, edits = solve(j, then)
            found.append((cost + more, letter + edits))
        best[i, said, inserted] = min(found, default=(10**9, ""))
        return best[i, said, inserted]

    for i in range(len(kinds), 0, -1):
        for said in "-sua":
            solve(i, said)
    return solve(0, "-")


def expected(rows):
    out = []
    ordered = sorted(damage(rows), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    for conv in {r[0] for r in rows}:
        own = [r for r in ordered if r[0] == conv]
        counts, seen, kinds = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), []
        for _, _, role, text in own:
            said = text.rstrip(BLANK)
            fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            kinds.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(x[0] + y[0] not in ("su", "ua", "au") for x, y in itertools.pairwise(kinds))
        turns = {r[1] for r in own if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit = cheapest(tuple(kinds))
        lines, said, left = [], "", iter(own)
        for edit in audit:
            given = "assistant" if said == "user" else "user"
            row = None if edit == "I" else next(left)
            if edit == "D":
                continue
            role = row[2] if edit == "K" else given
            said = {"s": "system", "u": "user", "a": "assistant"}[role[0]]
            lines.append(f"{role}:{row[3] if row else ''}")
        out.append((conv, gaps, *counts.values(), illegal, cost, audit, sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def frame(spark, rows):
    ship(spark)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def repaired(spark, rows):
    return sorted(map(tuple, conversations.repair(conversations.damaged(frame(spark, rows))).collect()), key=repr)


def random_rows(seed, n):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, 14)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", None, "", "ünder", "usher"])
            text = rng.choice(["Hello.", "Hello", "", " \n", "a b!", "Why?\t", None, "½", f"{turn}.", "..."])
            rows.append((rng.choice([conv, conv, conv, None]) if conv % 9 == 0 else conv, rng.choice([turn, turn, 2 * turn, None, 3]), role, text))
    return rows


@pytest.mark.parametrize("block", [1, 2, 3, 4])
def test_tables_find_the_least_cheapest_edits(block):
    tables = conversations.Tables(block)
    rng = np.random.default_rng(block)
    kinds = [("", True, False), *((i, False, t) for i in "sua-" for t in (False, True))]
    every = [list(p) for n in range(4) for p in itertools.product(range(9), repeat=n)]
    every += [rng.integers(0, 9, n).tolist() for n in range(4, 40) for _ in range(6)]
    for codes in every:
        assert tables.repair(bytes(codes)) == cheapest(tuple(kinds[c] for c in codes))


def test_few_vectors_and_all_blocks():
    tables = conversations.tables()
    assert len(tables.vectors) < 60
    assert tables.blocks.shape == (len(tables.vectors), 9**conversations.BLOCK)
    assert conversations.symbol("", False) == conversations.symbol("t", False) == 7


@pytest.mark.parametrize("seed", [1, 2])
def test_damaged_conversations_equal_the_search(spark, seed):
    rows = random_rows(seed, 90)
    assert repaired(spark, rows) == expected(rows)


def test_repeated_rows_ties_and_null_turns(spark):
    rows = random_rows(5, 12)
    rows = rows + rows[:40] + [(3, None, "user", "Same.")] * 5 + [(4, 1, "user", "Same."), (4, 2, "user", "Same."), (4, 2, "user", "Other.")]
    assert repaired(spark, rows) == expected(rows)


def test_one_conversation_in_many_ranges(spark):
    rows = [(7, t // 2, ["user", "assistant"][t % 2], f"{t % 50}.") for t in range(3000)] + [(8, 0, "user", "Hi.")]
    whole = frame(spark, rows).repartition(7)
    got = sorted(map(tuple, conversations.repair(conversations.damaged(whole)).collect()), key=repr)
    assert got == expected(rows)


def test_nothing_left_and_empty_table(spark):
    turn = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    got = repaired(spark, [(5, turn, "user", "Gone.")])
    assert got == [(5, 0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())]
    assert repaired(spark, []) == []


def test_extra_columns_do_not_matter(spark):
    rows = random_rows(3, 20)
    more = frame(spark, rows).selectExpr("*", "1 as copies", "2 as row", "'x' as blank", "3 as audit", "4 as p")
    assert sorted(map(tuple, conversations.repair(conversations.damaged(more)).collect()), key=repr) == expected(rows)
