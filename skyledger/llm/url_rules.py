"""URL filters: a bit-parallel automaton that runs every wildcard rule at once over each canonical URL.

A canonical URL is the host (A-Z in lower case) followed by the path; scheme, query and fragment are left out. Rules are
globs over it: ``?`` is one character, ``*`` any run of characters without ``/``, ``**`` any run at all. Every glob is a
row of states, one more than it has characters, and all rows stand end to end in one bit vector of as many 64-bit words
as they need. One step of all rules is a shift, a mask of the states that the next character enters, and a mask of the
states it lets stay (Shift-And with self-loops). A batch of URLs steps together, character by character.

Host rules come first: a rule for a host and the beginning of a path fits the host and all its subdomains, and the longest
one that fits decides (of equally long ones a block, then the smaller text). Where none fits, the globs decide: a URL that
any of them matches gets the glob's verdict (block before allow), every other URL the default.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK, ALLOW = "block", "allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: URLs that step together: bounds the state vectors a worker holds.
STEP_ROWS = 4096

HOST_PATTERN = "(?s)^.*?://([^/?#]*)"
PATH_PATTERN = "(?s)^.*?://[^/?#]*([^?#]*)"


class HostRule(NamedTuple):
    """A verdict on a host with its subdomains, for paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


class Glob(NamedTuple):
    """A verdict on the canonical URLs that a glob matches as a whole."""

    verdict: str
    pattern: str


class _State(NamedTuple):
    """What enters a state, and what lets the automaton stay in it."""

    enters: str | None
    loops: str | None


ANY, SEGMENT = "any", "segment"  # what a wildcard takes: every character, or all but the slash


def _states(pattern: str) -> list[_State]:
    """The states of one glob, its start first."""
    out = [_State(None, None)]
    at = 0
    while at < len(pattern):
        if pattern.startswith("**", at):
            out[-1] = out[-1]._replace(loops=ANY)
            at += 2
        elif pattern[at] == "*":
            if out[-1].loops is None:
                out[-1] = out[-1]._replace(loops=SEGMENT)
            at += 1
        else:
            out.append(_State(SEGMENT if pattern[at] == "?" else "=" + pattern[at], None))
            at += 1
    return out


def _literal(text: str) -> list[_State]:
    return [_State("=" + c, None) for c in text]


class Automaton:
    """All rules as masks of one bit vector. Characters that no rule names share one class."""

    def __init__(self, rules: Iterable[HostRule], globs: Iterable[Glob]):
        self.rules = sorted(set(rules), key=lambda r: (-len(r.text), r.verdict != BLOCK, r.text))
        self.globs = sorted(set(globs), key=lambda g: (g.verdict != BLOCK, g.pattern))
        for verdict in [r.verdict for r in self.rules] + [g.verdict for g in self.globs]:
            if verdict not in (BLOCK, ALLOW):
                raise ValueError(f"a rule says neither {BLOCK} nor {ALLOW}: {verdict}")
        rows: list[tuple[int, list[_State]]] = []  # (rank of the rule or glob, its states)
        for rank, rule in enumerate(self.rules):
            tail = _literal(rule.text)
            tail[-1:] = [tail[-1]._replace(loops=ANY)] if tail else []
            rows.append((rank, [_State(None, None if tail else ANY), *tail]))
            rows.append((rank, [_State(None, SEGMENT), _State("=.", None if tail else ANY), *tail]))
        rows += [(len(self.rules) + k, _states(g.pattern)) for k, g in enumerate(self.globs)]

        named = sorted({s.enters[1] for _, states in rows for s in states if s.enters and s.enters[0] == "="} | {"/"})
        self.alphabet = np.array([ord(c) for c in named], np.uint32)
        slash, classes = named.index("/"), len(named) + 1
        size = sum(len(states) for _, states in rows)
        enter, stay = np.zeros((classes, size), bool), np.zeros((classes, size), bool)
        start, final = np.zeros(size, bool), np.full(size, -1, np.int64)
        bit = 0
        for rank, states in rows:
            start[bit] = True
            for state in states:
                for mask, what in ((enter, state.enters), (stay, state.loops)):
                    if what in (ANY, SEGMENT):
                        mask[:, bit] = True
                        mask[slash, bit] = what == ANY
                    elif what:
                        mask[named.index(what[1]), bit] = True
                bit += 1
            final[bit - 1] = rank
        self.enter, self.stay, self.start = _words(enter), _words(stay), _words(start[None])[0]
        ends = np.flatnonzero(final >= 0)
        self.ends = ends[np.argsort(final[ends], kind="stable")]
        self.end_rank = final[self.ends]

    def _classes(self, chars: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.alphabet, chars), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == chars, at, len(self.alphabet)).astype(np.int32)

    def first_match(self, urls: list[str]) -> np.ndarray:
        """Rank of the first rule or glob that matches each URL; their number where none does."""
        none = len(self.rules) + len(self.globs)
        lengths = np.array([len(u) for u in urls], np.int64)
        order = np.argsort(-lengths, kind="stable")
        chars = self._classes(np.frombuffer("".join(urls).encode("utf-32-le", "surrogatepass"), np.uint32))
        begins = (np.cumsum(lengths) - lengths)[order]
        left = lengths[order]
        state = np.repeat(self.start[None], len(urls), axis=0)
        running = len(urls)
        for step in range(int(left[0]) if len(urls) else 0):
            running = int(np.searchsorted(-left[:running], -step, side="left"))  # longest first: those that go on lead
            now = chars[begins[:running] + step]
            held = state[:running]
            moved = held << np.uint64(1)
            moved[:, 1:] |= held[:, :-1] >> np.uint64(63)
            state[:running] = (moved & self.enter[now]) | (held & self.stay[now])
        found = np.full(len(urls), none, np.int64)
        for end, rank in zip(self.ends[::-1], self.end_rank[::-1], strict=True):
            found[(state[:, end >> 6] >> np.uint64(end & 63)) & np.uint64(1) == 1] = rank
        out = np.empty(len(urls), np.int64)
        out[order] = found
        return out


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words, the first bit lowest."""
    wide = np.zeros((bits.shape[0], max(1, -(-bits.shape[1] // 64)) * 64), bool)
    wide[:, : bits.shape[1]] = bits
    return np.packbits(wide, axis=1, bitorder="little").view("<u8").astype(np.uint64)


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without one."""
    return F.coalesce(F.translate(F.regexp_extract(url, HOST_PATTERN, 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty where there is no host part."""
    return F.coalesce(F.regexp_extract(url, PATH_PATTERN, 1), F.lit(""))


def judge(
    pages: DataFrame, rules: Iterable[HostRule], globs: Iterable[Glob] = (), default: str = ALLOW, keep: tuple[str, ...] = ("page_id",), url: str = "url"
) -> DataFrame:
    """One row per page: ``keep``, host, path, the host rule that decides (else null), and the verdict.

    Host and path of a URL that is null or has no ``://`` are empty. No host rule fits them unless it names neither host nor
    path; a glob may. Rows that repeat are judged one by one, no row is dropped, an empty table gives no rows. Other
    columns of the pages are left out, so clashing names do no harm. Nothing is shuffled: URLs are judged where they are read.
    """
    automaton = Automaton(rules, globs)
    verdicts = [r.verdict for r in automaton.rules] + [g.verdict for g in automaton.globs] + [default]
    texts = [r.text for r in automaton.rules] + [None] * (len(automaton.globs) + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, STEP_ROWS):
                batch = whole.slice(start, STEP_ROWS)
                urls = [h + p for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True)]
                rank = automaton.first_match(urls)
                columns = [*batch.columns, pa.array([texts[r] for r in rank], pa.string()), pa.array([verdicts[r] for r in rank], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "rule", "verdict"])

    parts = pages.select(*keep, host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema.fields)
    return parts.mapInArrow(run, f"{schema}, rule string, verdict string")
