"""Small documents that every text operator must handle, and brute-force versions of the operators."""

import collections
import hashlib
import random

from millrace.llm.common import ship

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, tie long, score string, shard string, `__id_x` int"


def documents(spark, texts, ids=None, sources=None, langs=None):
    """A documents table with further columns whose names operators use themselves."""
    ship(spark)
    rows = []
    for k, text in enumerate(texts):
        n = None if text is None else len(text)
        source = sources[k] if sources else f"s{k % 3}"
        rows.append((ids[k] if ids else k, text, langs[k] if langs else "en", source, n, 1, 2, "x", None, 3))
    return spark.createDataFrame(rows, SCHEMA)


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def corpus(seed=0, n=60):
    """Texts with exact and near copies, shared passages, short and empty ones, nulls and a long one."""
    rng = random.Random(seed)
    passage = words(rng, 55)
    out = [None, "", "   \n\t ", "one", "Two words", "two WORDS", None, "É\u00a0x y"]
    for _ in range(n):
        own = words(rng, rng.choice([3, 8, 30, 90, 200]))
        kind = rng.randrange(5)
        if kind == 0 and len(out) > 12:
            other = out[rng.randrange(8, len(out))]
            out.append(other)
            changed = other.split()
            for _ in range(max(1, len(changed) // 60)):
                changed[rng.randrange(len(changed))] = "changed"
            out.append(" ".join(changed))
        elif kind == 1:
            at = rng.randrange(len(own))
            out.append(" ".join(own[:at] + passage + own[at:]))
        elif kind == 2:
            out.append("\n".join(own + own[:25]))
        else:
            out.append(" ".join(own).capitalize())
    out.append(" ".join(words(rng, 20_000, 5000)))
    return out


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def near_components(rows, percent=75):
    """{doc_id: (set size, smallest doc_id of the component)} from (doc_id, text) rows, comparing all pairs."""
    sets = {d: shingle_set(t) for d, t in rows}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in ids}


def repeats_removed(rows, width=20):
    """{doc_id: (words, removed, digest)}: words in a window that starts earlier are removed."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        w = (text or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            window = tuple(w[i : i + width])
            if window in seen:
                gone[i : i + width] = [True] * width
            seen.add(window)
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out[doc_id] = (len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


def grouped(pairs):
    out = collections.defaultdict(list)
    for key, value in pairs:
        out[key].append(value)
    return out
