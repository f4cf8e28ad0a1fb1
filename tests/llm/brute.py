"""Plain versions of the operators' results, and tables that hold awkward rows."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import re
import struct
import zlib

import numpy as np

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, slot int, score string"

KEYWORD = "|".join("".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token"))
API = "[aA][pP][iI]_?[kK][eE][yY]"
ASSIGN = re.compile(rf"""({KEYWORD}|{API})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def documents(spark, texts: dict[int | None, str | None] | list[tuple]):
    """A documents table with columns whose names clash with those that operators add."""
    rows = list(texts.items()) if isinstance(texts, dict) else texts
    out = [(i, t, "en", f"src{(i or 0) % 3}", None if t is None else len(t), "x", 7, "y") for i, t in rows]
    return spark.createDataFrame(out, DOCS)


def prose(seed: int, words: int) -> str:
    rng = np.random.default_rng(seed)
    parts = ["the", "and", "ing", "ti", "ver", "lo", "an", "re", "st", "ou", "mi", "ka"]
    return " ".join("".join(rng.choice(parts, rng.integers(2, 4))) for _ in range(words))


def awkward() -> list[tuple]:
    long = prose(1, 30_000)
    return [
        (None, "no id at all, and some words here"),
        (1, None),
        (2, ""),
        (3, "  \n\t "),
        (4, "é"),
        (5, long),
        (6, long),
        (7, prose(2, 60)),
        (7, prose(2, 60)),
        (8, prose(2, 60)),
        (9, "1234567890 " * 30),
        (10, "und " * 400),
    ]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def digest(spans: list[tuple[int, int, int]]) -> str:
    kinds = ("assign", "access", "hex")
    return hashlib.sha256(",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()


def entropy(word: str, window: int) -> float:
    best = -1.0
    for i in range(max(1, len(word) - window + 1)):
        part = word[i : i + window]
        counts = collections.Counter(part).values()
        best = max(best, -sum(c / len(part) * math.log2(c / len(part)) for c in counts))
    return best


def crc(ids: list[int]) -> int:
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def components(nodes, links) -> dict:
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def shingle_counts(text: str | None) -> collections.Counter:
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return collections.Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else collections.Counter()


def probability_jaccard(x: collections.Counter, y: collections.Counter) -> float:
    if set(x.values()) <= {1} and set(y.values()) <= {1}:
        return len(x.keys() & y.keys()) / max(1, len(x.keys() | y.keys()))
    keys = x.keys() | y.keys()
    return sum(1 / sum(max(x[k] / x[d], y[k] / y[d]) for k in keys) for d in x.keys() & y.keys())


def near_groups(texts: dict[int, str | None], similarity: float = 0.8) -> dict:
    counts = {d: shingle_counts(t) for d, t in texts.items()}
    by_shingle = collections.defaultdict(list)
    for d, c in counts.items():
        for s in c:
            by_shingle[s].append(d)
    pairs = {p for ds in by_shingle.values() for p in itertools.combinations(ds, 2)}
    return components(texts, [(a, b) for a, b in pairs if probability_jaccard(counts[a], counts[b]) >= similarity])


def substring_dedup(texts: dict[int, str | None], width: int) -> dict[int, tuple]:
    seen, out = set(), {}
    for d in sorted(texts):
        data = (texts[d] or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - width + 1):
            part = data[i : i + width]
            if part in seen:
                gone[i : i + width] = b"\1" * width
            seen.add(part)
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[d] = (len(data), sum(gone), spans, kept)
    return out
