"""Spelling variants: words one edit apart, found with a variable-length gram index.

A word is framed by a mark at either end. From every place of it one gram starts: it grows from ``SHORTEST`` characters until
it is rare, or reaches the longest length its word allows, or the end mark. A gram is rare when the dictionary does not hold
it; the dictionary holds the grams that occur more often than a threshold set by the size of the vocabulary, so it has
``DICTIONARY`` entries of each length at most, and it is closed: every beginning of a frequent gram is frequent.

One edit changes the grams that span its place and no others. For every word the operator looks for the two cheapest lists
that no single edit can change together (two grams that do not overlap): of those, one edit affects one at most, so each
word within one edit stands on at least one of the two lists. The lists are cut by word length and place, because an edit
moves a gram that it leaves alone by one place at most. Words that meet on a list are verified.

Both words of a pair must cut their grams alike: the longest length depends on the length of the word that looks, half of
it with its marks, so that two grams that do not overlap always exist; a word is filed under the grams of every
longest length by which words of its own length or one more may look for it.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import slices, stored

RUN = re.compile("[A-Za-zÀ-ÿ]+")
FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Distinct words a task counts before it hands its counts on, and bytes of text it holds at once.
HELD_WORDS = 100_000
HELD_BYTES = 512 << 10

FIRST, LAST = "\x02", "\x03"  # the marks; words hold letters only
SHORTEST, LONGEST = 2, 8
#: Frequent grams of one length at most, and the least threshold.
DICTIONARY = 8192
LEAST_FREQUENT = 200
HELD_GRAMS = 200_000


def lowered(text: str) -> str:
    """A-Z in lower case, all else as it is."""
    return text.encode("utf-8", "surrogatepass").translate(FOLD).decode("utf-8", "surrogatepass")


def count_words(docs: DataFrame, shortest: int = 6, drop_every: int | None = None, least: int = 1, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(word, n) of all words of at least ``shortest`` characters that occur ``least`` times or more.

    Words are the maximal runs of Latin letters, A-Z in lower case. With ``drop_every`` a run loses one character where that
    number divides the run's checksum (CRC-32 of ``<key>:<run>``; a null key is written as nothing): the character at the
    checksum modulo the run's length. Null texts have no words. Counts are added up within a task before the shuffle.
    """
    whole = re.compile(RUN.pattern.rstrip("+") + "{%d,}" % shortest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in slices(batches, text, HELD_BYTES):
            for doc, value in zip(batch.column(key).to_pylist(), batch.column(text).to_pylist(), strict=True):
                if value is None:
                    continue
                found = Counter(whole.findall(lowered(value)))
                if drop_every:
                    head = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                    for word in list(found):
                        check = zlib.crc32(word.encode(), head)
                        if check % drop_every == 0:
                            at, times = check % len(word), found.pop(word)
                            cut = word[:at] + word[at + 1 :]
                            if len(cut) >= shortest:
                                held[cut] += times
                held.update(found)
                if len(held) >= HELD_WORDS:
                    yield _counted(held)
                    held = Counter()
        if held:
            yield _counted(held)

    def _counted(counts: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    found = docs.select(F.col(key).cast("long").alias(key), F.col(text).alias(text)).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def reach(length: int) -> int:
    """Longest gram by which a word of this length looks for others."""
    return min(LONGEST, (length + 2) // 2)


def dictionary(words: DataFrame) -> dict[str, int]:
    """The frequent grams with their numbers: ``DICTIONARY`` of each length at most, however many words there are."""
    places = words.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    threshold = max(LEAST_FREQUENT, math.ceil(places / DICTIONARY))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for word in batch.column("word").to_pylist():
                framed = FIRST + word + LAST
                for size in range(SHORTEST, LONGEST):
                    held.update(framed[i : i + size] for i in range(len(framed) - size + 1))
                if len(held) >= HELD_GRAMS:
                    yield _table(held)
                    held = Counter()
        if held:
            yield _table(held)

    def _table(counts: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["gram", "n"])

    frequent = words.select("word").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") > threshold)
    return {r.gram: r.n for r in frequent.toLocalIterator()}


def grams(framed: str, longest: int, frequent: dict[str, int]) -> list[str]:
    """The gram that starts at every place of a framed word; a gram depends on nothing but its own characters."""
    out = []
    for start in range(len(framed) - SHORTEST + 1):
        size = SHORTEST
        while size < longest and start + size < len(framed) and framed[start : start + size] in frequent:
            size += 1
        out.append(framed[start : start + size])
    return out


def _cost(gram: str, frequent: dict[str, int]) -> float:
    """About how many words of one length stand on the list of a gram."""
    known = frequent.get(gram) or frequent.get(gram[:-1], 0) / 6
    return known if gram[0] == FIRST or gram[-1] == LAST else known / 4


def chosen(found: list[str], frequent: dict[str, int]) -> tuple[int, int]:
    """Places of the two cheapest lists that one edit cannot change together."""
    costs = [_cost(g, frequent) for g in found]
    ends = sorted(range(len(found)), key=lambda k: k + len(found[k]))
    best, first, done = (math.inf, 0, 0), None, 0
    for place, cost in enumerate(costs):
        while done < len(ends) and ends[done] + len(found[ends[done]]) <= place:
            if first is None or costs[ends[done]] < costs[first]:
                first = ends[done]
            done += 1
        if first is not None:
            best = min(best, (costs[first] + cost, first, place))
    return best[1], best[2]


def _filed(frequent: dict[str, int]):
    """Rows (gram, length, place, word, n) under which each word can be found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
                framed, length = FIRST + word + LAST, len(word)
                seen = {(g, i) for cap in {reach(length), reach(length + 1)} for i, g in enumerate(grams(framed, cap, frequent))}
                rows += [(g, length, i, word, n) for g, i in seen]
            if rows:
                yield _batch(rows)

    return run


def _asked(frequent: dict[str, int]):
    """Rows (gram, length, place, word, n) under which each word looks for others of its own length and of one less."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
                framed, length = FIRST + word + LAST, len(word)
                found = grams(framed, reach(length), frequent)
                for i in chosen(found, frequent):
                    gram = found[i]
                    rows.append((gram, length, i, word, n))
                    if gram[-1] != LAST:
                        rows.append((gram, length - 1, i, word, n))
                    if gram[0] != FIRST:
                        rows.append((gram, length - 1, i - 1, word, n))
            if rows:
                yield _batch(rows)

    return run


LISTED = "gram string, length int, place int, word string, n long"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["gram", "length", "place", "word", "n"])


def near_words(words: DataFrame) -> DataFrame:
    """Pairs (a, a_n, b, b_n) of words that differ by exactly one inserted, deleted or replaced character; each pair once.

    Words need two characters at least: a shorter one has no two grams that do not overlap, and takes no part.
    """
    words = words.where(F.length("word") > 1)
    frequent = dictionary(words)
    filed = words.mapInArrow(_filed(frequent), LISTED).withColumnsRenamed({"word": "b", "n": "b_n"})
    asked = words.mapInArrow(_asked(frequent), LISTED).withColumnsRenamed({"word": "a", "n": "a_n"})
    apart = (F.length("a") > F.length("b")) | (F.col("a") < F.col("b"))
    # merged: the planner takes the lists, many rows a word, to be as small as the compressed file of the words
    pairs = asked.join(filed.hint("merge"), ["gram", "length", "place"]).where(apart & (F.levenshtein("a", "b", 1) == 1))
    return pairs.select("a", "a_n", "b", "b_n").distinct()


def group_variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """One row per word: its form, the root that its forms lead to, its number, its near words, the form's number.

    ``words`` has distinct words and their numbers. A word's form is its near word with the largest number (of equal ones
    the first in code-point order) if that is at least ``ratio`` times its own; words without one are their own root.
    """
    if ratio < 2:
        raise ValueError("forms must be more frequent than their variants")
    words = stored(words, "spelling_words")
    pairs = stored(near_words(words), "spelling_pairs")
    ends = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n"))
    )
    best = F.min(F.struct((-F.col("other_n")).alias("order"), F.col("other")))
    near = ends.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    taken = -F.col("best.order") >= ratio * F.col("n")
    judged = words.join(near.hint("merge"), "word", "left").select(
        "word",
        "n",
        F.when(taken, F.col("best.other")).alias("form"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(taken, -F.col("best.order")).alias("form_n"),
    )
    judged = stored(judged, "spelling_forms")
    links = _roots(judged, ratio)
    return judged.join(links.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(judged: DataFrame, ratio: int) -> DataFrame:
    """(word, root) of words with a form: each round follows twice as many forms; numbers grow by the ratio, which bounds the steps."""
    links = judged.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    most = judged.agg(F.max("form_n")).first()[0] or 1
    steps = 1 + int(math.log(most, ratio))
    followed = 1
    while followed < steps:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = stored(links.join(onward.hint("merge"), "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling_roots")
        followed *= 2
    return links


def spelling_variants(docs: DataFrame, shortest: int = 6, least: int = 5, ratio: int = 5, drop_every: int | None = None) -> DataFrame:
    """The words of all documents, grouped by spelling; see :func:`count_words` and :func:`group_variants`."""
    return group_variants(count_words(docs, shortest, drop_every, least), ratio)

