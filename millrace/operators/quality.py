"""Data-quality checks: violating rows per check, and one report for a whole suite.

A check passes when it has no violations. NULL passes every check except
``not_null`` and the combination check, where NULLs form one group.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from millrace.operators.joins import orphans
from millrace.session import run_together

ROW_KINDS = ("not_null", "accepted_values", "accepted_range", "expression_is_true")


@dataclass(frozen=True)
class Check:
    """One declared check on one relation."""

    kind: str
    relation: str
    columns: tuple[str, ...] = ()
    values: tuple = ()  # accepted values, or (low, high) of a range
    parent: tuple[str, str] | None = None  # (relation, column)
    expression: str | None = None
    where: str | None = None

    @property
    def name(self) -> str:
        subject = self.expression or "__".join(self.columns)
        tail = f" where {self.where}" if self.where else ""
        target = f" in {self.parent[0]}.{self.parent[1]}" if self.parent else ""
        return f"{self.kind}: {subject}{target}{tail}"


def failing(check: Check, within: str = "") -> Column:
    """Row predicate that is true for violating rows; for the row-level kinds only.

    ``within`` names a struct that holds the columns, where an expression is not allowed.
    """
    c = F.col(f"{within}.{check.columns[0]}" if within else check.columns[0]) if check.columns else None
    if within and (check.expression or check.where):
        raise ValueError("expressions name columns of their own relation")
    match check.kind:
        case "not_null":
            bad = c.isNull()
        case "accepted_values":
            bad = ~c.isin(*check.values)
        case "accepted_range":
            bad = ~c.between(*check.values)
        case "expression_is_true":
            bad = ~F.expr(f"({check.expression})")
        case _:
            raise ValueError(f"{check.kind} is not a row-level check")
    if check.where:
        bad = bad & F.expr(check.where)
    return F.coalesce(bad, F.lit(False))


def duplicates(df: DataFrame, keys: Sequence[str], skip_nulls: bool = False) -> DataFrame:
    """Key values that occur more than once, with their count."""
    if skip_nulls:
        df = df.where(F.col(keys[0]).isNotNull())
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def violations(check: Check, relations: dict[str, DataFrame]) -> DataFrame:
    """The violating rows (row-level checks) or violating key values with their counts."""
    df = relations[check.relation]
    if check.kind in ROW_KINDS:
        return df.where(failing(check))
    if check.where:
        df = df.where(check.where)
    if check.kind == "unique":
        return duplicates(df, check.columns, skip_nulls=True)
    if check.kind == "unique_combination":
        return duplicates(df, check.columns)
    parent, column = check.parent
    return orphans(df, check.columns[0], relations[parent], column)


def tolerance_mismatch(a: Column, b: Column, tolerance: str = "0.05") -> Column:
    """True where two amounts differ by more than the tolerance."""
    return F.abs(F.round(a - b, 2)) > F.lit(tolerance).cast("decimal(12,2)")


def out_of_order(*milestones: str) -> Column:
    """True where a reached milestone lies after the next reached one (pairwise)."""
    late = F.lit(False)
    for earlier, later in zip(milestones, milestones[1:]):
        late = late | F.coalesce(F.col(earlier) > F.col(later), F.lit(False))
    return late


def sample(violating: DataFrame, keys: Sequence[str], rows: int = 50) -> DataFrame:
    """The first violations in key order, for a person to look at."""
    return violating.orderBy(*keys).limit(rows)


class Watch:
    """Failures of row-level checks, counted while their relations are written.

    A watched relation needs no scan of its own for these checks. Counts are those of the last write.
    """

    def __init__(self, checks: Sequence[Check]):
        self.checks = by_relation([c for c in checks if c.kind in ROW_KINDS])
        self.seen: dict[str, Observation] = {}

    def on(self, df: DataFrame, *relations: str) -> DataFrame:
        """``df``, counting for the checks of ``relations``, which have its rows.

        To be written next: only in the last stage of a job is a task that runs twice counted once.
        """
        for relation in relations:
            own = self.checks.get(relation)
            if own:
                self.seen[relation] = Observation()
                df = df.observe(self.seen[relation], *_counters(own))
        return df

    def failures(self) -> dict[Check, int]:
        """Failures of the checks of every relation written so far."""
        found = {}
        for relation, seen in self.seen.items():
            counts = seen.get
            found |= {c: counts[f"c{i}"] for i, c in enumerate(self.checks[relation])}
        return found


def by_relation(checks: Sequence[Check]) -> dict[str, list[Check]]:
    found: dict[str, list[Check]] = {}
    for c in checks:
        found.setdefault(c.relation, []).append(c)
    return found


def _counters(checks: Sequence[Check], within: dict[str, str] | None = None) -> list[Column]:
    inside = within or {}
    return [F.count_if(failing(c, inside.get(c.relation, ""))).alias(f"c{i}") for i, c in enumerate(checks)]


def _as_text(columns: Sequence[str]) -> Column:
    """One text per key; every part carries its length, so different keys stay different."""
    texts = [F.col(c).cast("string") for c in columns]
    if len(texts) == 1:
        return texts[0]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.concat_ws("|", *parts)


def _whole_numbers(check: Check, relations: dict[str, DataFrame]) -> bool:
    """Whether a key check compares single integer columns only."""
    if len(check.columns) > 1:
        return False
    used = [relations[check.relation].schema[check.columns[0]]]
    if check.parent:
        used.append(relations[check.parent[0]].schema[check.parent[1]])
    return all(isinstance(f.dataType, IntegralType) for f in used)


def _key(columns: Sequence[str], number: bool) -> Column:
    """A key as one value: integers stay 8-byte values."""
    return F.col(columns[0]).cast("bigint") if number else _as_text(columns)


def _entry(check: int, role: int, key: Column, keep: Column) -> Column:
    return F.struct(F.lit(check).alias("check"), F.lit(role).alias("role"), key.alias("key"), keep.alias("keep"))


def _key_counts(relations: dict[str, DataFrame], checks: Sequence[Check]) -> list[DataFrame]:
    """(check, failures) of key checks (unique, combination, relationships), numbered in their order: a frame per type of key.

    Each relation is scanned once per type of key, integer or text. Checks on the same column share its
    rows: its own uniqueness and all references to it are one group, named by the first check of it, in which
    a row has role 0 if it is the column's own and another number for each reference. Rows are counted per
    key and role before and after the only shuffle of each type: a duplicate is an own key counted more than once,
    an orphan is a referring key without an own row.
    """
    groups: dict[tuple, list[int]] = {}
    for n, c in enumerate(checks):
        owner = (*c.parent, None) if c.kind == "relationships" else (c.relation, *c.columns, c.where)
        groups.setdefault((_whole_numbers(c, relations), *owner), []).append(n)
    found = []
    for number in (True, False):
        by_relation: dict[str, list[Column]] = {}
        results = F.when(F.lit(False), F.lit(None).cast("array<struct<check:int,failures:bigint>>"))
        most = 0
        for (kind, owner, *columns, where), members in groups.items():
            if kind != number:
                continue
            group, references = members[0], [n for n in members if checks[n].kind == "relationships"]
            most = max(most, len(references))
            key = _key(columns, number)
            # NULL keys are a group of their own for a combination only.
            combined = any(checks[n].kind == "unique_combination" for n in members)
            entries = [(owner, 0, key, F.lit(True) if combined else key.isNotNull(), where)]
            for role, n in enumerate(references, 1):
                child = _key(checks[n].columns, number)
                entries.append((checks[n].relation, role, child, child.isNotNull(), checks[n].where))
            for name, role, value, keep, condition in entries:
                if condition:
                    keep = keep & F.coalesce(F.expr(condition), F.lit(False))
                by_relation.setdefault(name, []).append(_entry(group, role, value, keep))
            failures = []
            for n in members:
                kind_of = {"unique": "repeated", "unique_combination": "combined"}.get(checks[n].kind)
                failures.append(F.struct(F.lit(n).alias("check"), F.col(kind_of or f"orphans{references.index(n) + 1}").alias("failures")))
            results = results.when(F.col("check") == group, F.array(*failures))
        if not by_relation:
            continue
        parts = [relations[name].select(F.inline(F.array(*entries))).where("keep") for name, entries in by_relation.items()]
        roles = [F.count_if(F.col("role") == r).alias(f"n{r}") for r in range(most + 1)]
        per_key = united(parts).groupBy("check", "key").agg(*roles)
        repeated = F.col("n0") > 1
        totals = per_key.groupBy("check").agg(
            F.count_if(repeated & F.col("key").isNotNull()).alias("repeated"),
            F.count_if(repeated).alias("combined"),
            *[F.coalesce(F.sum(F.when(F.col("n0") == 0, F.col(f"n{r}"))), F.lit(0).cast("bigint")).alias(f"orphans{r}") for r in range(1, most + 1)],
        )
        found.append(totals.select(F.inline(results)))
    return found


def united(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of frames with the same columns; halves first, so that no plan is analysed once per part."""
    if len(parts) == 1:
        return parts[0]
    half = len(parts) // 2
    return united(parts[:half]).unionByName(united(parts[half:]))


def report(
    checks: Sequence[Check],
    relations: dict[str, DataFrame],
    counted: dict[Check, int] | None = None,
    together: Sequence[tuple[DataFrame, dict[str, str]]] = (),
) -> DataFrame:
    """One row per check: relation, name, failures and status.

    The scans run side by side, and one number per check comes to the driver. Row-level
    checks cost one scan per relation, and none where ``counted`` has their failures from
    a ``Watch``. ``together`` lists frames that hold several relations at once, as (frame, {relation:
    struct that holds its columns, "" for the frame's own}): they cost one scan in all.
    Key checks together cost one further scan per relation and type of key, and one shuffle per
    type. The two columns of a relationship must have the same type; integers may differ in width.
    """
    failures = {c: n for c, n in (counted or {}).items() if c in set(checks)}
    row_level = by_relation([c for c in checks if c.kind in ROW_KINDS and c not in failures])
    key_level = [c for c in checks if c.kind not in ROW_KINDS]
    scans = []
    for df, within in together:
        own = [c for name in within for c in row_level.pop(name, [])]
        if own:
            scans.append((df, own, within))
    scans += [(relations[name], own, None) for name, own in row_level.items()]

    def count(df: DataFrame, own: list[Check], within: dict[str, str] | None) -> dict[Check, int]:
        totals = df.agg(*_counters(own, within)).first()
        return dict(zip(own, totals, strict=True))

    def count_keys(df: DataFrame) -> dict[Check, int]:
        return {key_level[r["check"]]: r["failures"] for r in df.collect()}

    steps = [lambda scan=scan: count(*scan) for scan in scans]
    steps += [lambda df=df: count_keys(df) for df in (_key_counts(relations, key_level) if key_level else ())]
    # A check whose relation is empty has no keys; it still gets its row.
    failures |= dict.fromkeys(key_level, 0)
    for found in run_together(steps):
        failures |= found
    rows = [(c.relation, c.name, failures[c]) for c in checks]
    return with_status(_frame(relations, rows, "relation string, check_name string, failures long"))


def with_status(counts: DataFrame) -> DataFrame:
    status = F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail"))
    return counts.select("relation", "check_name", "failures", status.alias("status"))


def _frame(relations: dict[str, DataFrame], rows: list[tuple], schema: str) -> DataFrame:
    return next(iter(relations.values())).sparkSession.createDataFrame(rows, schema)


def rule_counts(rules: dict[str, DataFrame]) -> DataFrame:
    """(rule, failures) of named rules given as relations of violating rows, counted side by side."""
    counts = run_together([lambda df=df: df.count() for df in rules.values()])
    return _frame(rules, list(zip(rules, counts, strict=True)), "rule string, failures long")
