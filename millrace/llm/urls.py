"""URL filter: a trie over reversed host labels and path segments, broadcast to all tasks.

The rule list is configuration, as long as its maintainers make it, and does not grow with
the pages; ``compile_rules`` refuses lists beyond ``MAX_RULES`` rather than broadcast them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

MAX_RULES = 2_000_000

VERDICT = StructType([StructField("rule", StringType()), StructField("verdict", StringType())])


def host_of(url: Column) -> Column:
    """What stands after the first ``://``, up to ``/``, ``?``, ``#`` or the end; A-Z in lower case. Else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What stands after the host, up to ``?``, ``#`` or the end. Else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def compile_rules(rules: Iterable[tuple[str, str]]) -> dict:
    """The trie of (verdict, rule) pairs; a rule is a host and a path, like ``example.net/en/``.

    A node maps a host label (last first) to the next node. Its key ``/`` holds the root of the
    host's path trie, whose nodes map whole segments; their key ``None`` lists the beginnings of
    a next segment at which rules end. Of two entries for one rule, block stands.
    """
    root: dict = {}
    rules = list(rules)
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules are too many to broadcast")
    for verdict, rule in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"a verdict is allow or block, not {verdict}")
        host, slash, path = rule.partition("/")
        node = root
        for label in reversed(host.lower().split(".")) if host else ():
            node = node.setdefault("." + label, {})
        node = node.setdefault("/", {})
        *whole, beginning = (slash + path).split("/")
        for segment in whole:
            node = node.setdefault("/" + segment, {})
        ends = node.setdefault(None, {})
        if ends.get(beginning, (rule, "allow"))[1] == "allow":
            ends[beginning] = (rule, verdict)
    return root


def match(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    """The longest rule that fits: the most host labels, then the longest path; None if none fits."""
    node, found = trie, None
    for label in (None, *reversed(host.split("."))) if host else ():
        if label is not None:
            node = node.get("." + label)
            if node is None:
                break
        at = node.get("/")
        if at is not None:
            found = _longest_path(at, path) or found
    return found


def _longest_path(node: dict, path: str) -> tuple[str, str] | None:
    found = None
    for segment in path.split("/"):
        ends = node.get(None)
        if ends:
            fits = max((e for e in ends if segment.startswith(e)), key=len, default=None)
            found = found if fits is None else ends[fits]
        node = node.get("/" + segment)
        if node is None:
            break
    return found


def judge(pages: DataFrame, rules: Iterable[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """Per page: its id, host, path, the longest fitting rule (else null) and the verdict.

    A url that is null or holds no ``://`` has an empty host and path: no rule fits, and it gets
    ``default``, as do all urls that no rule fits. Repeated rows are judged each. Other columns
    are not looked at, whatever their names. An empty table gives an empty result. No shuffle.
    """
    trie = pages.sparkSession.sparkContext.broadcast(compile_rules(rules))

    def judged(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        known = trie.value
        for hosts, paths in parts:
            found = [match(known, h, p) or (None, default) for h, p in zip(hosts, paths, strict=True)]
            yield pd.DataFrame(found, columns=["rule", "verdict"], dtype=object)

    parted = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    said = F.pandas_udf(judged, VERDICT)(F.col("host"), F.col("path"))
    return parted.withColumn("said", said).select("page_id", "host", "path", "said.rule", "said.verdict")
