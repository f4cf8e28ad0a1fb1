"""Language of documents by Bayesian fusion of evidence.

Four kinds of evidence meet in log space: the likelihood of the text's byte trigrams, the language a page declares, the
suffix of its address, and a prior from its host. What a declaration or a suffix says about the language, and the host
priors, are learned from the text posteriors of the whole table by grouped sums; a host's prior is smoothed towards
that of its domain, and a domain's towards the whole table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import lowered, sample_fraction, slices, stored, text_bytes
from skyledger.operators.keyed import join_totals

LANGUAGES = ("de", "en", "es", "fr")
FEATURES = 1 << 14
FIT_ROWS = 20_000
#: Trigrams beyond this number add confidence only by their mean, as neighbouring trigrams say much the same.
FULL_EVIDENCE = 150
SMOOTHING = 20.0
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[128:] = True


def _trigrams(values: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """Feature number and row of every trigram around a letter; a text begins and ends with a blank."""
    data, offsets = text_bytes(values)
    data = lowered(data)
    data = np.where(_LETTER[data], data, np.uint8(32))
    data = np.insert(data, np.sort(np.concatenate((offsets[:-1], offsets[1:]))), np.uint8(32)).astype(np.uint32)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets) + 2)
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), len(offsets) - 1
    code = data[:-2] | (data[1:-1] << np.uint32(8)) | (data[2:] << np.uint32(16))
    use = (row[:-2] == row[2:]) & (data[1:-1] != 32)
    feature = (code[use] * np.uint32(2654435761)) >> np.uint32(18)
    return feature.astype(np.int64), row[:-2][use], len(offsets) - 1


def fit_text_model(
    docs: DataFrame, languages: Sequence[str] = LANGUAGES, text: str = "text", label: str = "lang", most: int = FIT_ROWS
) -> np.ndarray:
    """Log probabilities of trigrams, one row per language, from about ``most`` labelled documents chosen by hash.

    The driver gets one sum per language and feature. Without labelled rows all languages are alike.
    """
    known = docs.where(F.col(label).isin(*languages) & F.col(text).isNotNull())
    share = sample_fraction(known.count(), most)
    sample = known.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(11)), F.lit(1 << 20)) < int(share * (1 << 20)))
    number = F.array_position(F.array(*map(F.lit, languages)), F.col(label)).cast("int") - 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(languages) * FEATURES, np.int64)
        for batch in slices(batches, "text"):
            feature, row, _ = _trigrams(batch.column("text"))
            lang = batch.column("number").to_numpy().astype(np.int64)
            total += np.bincount(lang[row] * FEATURES + feature, minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["cell", "n"])

    sums = (
        sample.select(F.col(text).alias("text"), number.alias("number"))
        .mapInArrow(count, "cell long, n long")
        .groupBy("cell")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    counts = np.zeros(len(languages) * FEATURES)
    counts[sums.column("cell").to_numpy()] = sums.column("n").to_numpy()
    counts = counts.reshape(len(languages), FEATURES)
    # as if all languages had equally much text, or what is new would speak for the rarest one
    counts = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1) * 1e6 + 0.5
    return np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def page_evidence(pages: DataFrame) -> DataFrame:
    """Pages (page_id, url, html) as rows (doc_id, text, declared, suffix, domain, host) for ``identify``."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-z]+://(?:[^/@]*@)?([^/:?#]+)", 1))
    body = F.regexp_replace(F.coalesce("html", F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    declared = F.lower(F.regexp_extract(F.coalesce("html", F.lit("")), r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([a-z]+)""", 1))
    empty = lambda c: F.when(c != "", c)
    return pages.select(
        F.col("page_id").alias("doc_id"),
        body.alias("text"),
        empty(declared).alias("declared"),
        empty(F.regexp_extract(host, r"\.([a-z]+)$", 1)).alias("suffix"),
        empty(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)).alias("domain"),
        empty(host).alias("host"),
    )


def document_evidence(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text, lang, source): the language they come with is the declared one, the source is the host."""
    none = F.lit(None).cast("string")
    return docs.select(
        "doc_id", "text", F.lower("lang").alias("declared"), none.alias("suffix"), none.alias("domain"), F.col("source").alias("host")
    )


def _text_scores(docs: DataFrame, model: np.ndarray) -> DataFrame:
    """Adds ``logs`` (log likelihood per language, tempered) and ``n_grams``; the text goes no further."""
    n = len(model)
    kept = ["doc_id", "declared", "suffix", "domain", "host"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            feature, row, rows = _trigrams(batch.column("text"))
            grams = np.bincount(row, minlength=rows)
            logs = np.stack([np.bincount(row, weights=model[k][feature], minlength=rows).astype(float) for k in range(n)], axis=1)
            logs *= np.minimum(1.0, FULL_EVIDENCE / np.maximum(grams, 1))[:, None]
            logs -= logs.max(axis=1, keepdims=True)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, rows * n + 1, n, dtype=np.int32)), pa.array(logs.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [flat, pa.array(grams.astype(np.int64))], names=[*kept, "logs", "n_grams"]
            )

    return docs.select(*kept, "text").mapInArrow(
        score, "doc_id long, declared string, suffix string, domain string, host string, logs array<double>, n_grams long"
    )


def _normal(logs: Column) -> Column:
    """Probabilities from log weights."""
    top = F.array_max(logs)
    raised = F.transform(logs, lambda x: F.exp(x - top))
    total = F.aggregate(raised, F.lit(0.0), lambda a, x: a + x)
    return F.transform(raised, lambda x: x / total)


def identify(docs: DataFrame, model: np.ndarray, languages: Sequence[str] = LANGUAGES, least: float = 0.5) -> DataFrame:
    """Rows (doc_id, lang, posterior, text_lang, declared, n_grams, accepted), one per row of ``docs``.

    ``docs`` has doc_id, text, declared, suffix, domain and host, any of them null; other columns are ignored. A text
    without letters (null, empty, digits only) has no language: ``lang`` is null and it is not accepted. Otherwise
    ``accepted`` tells whether the posterior of the best language reaches ``least``. Ties go to the language first in
    ``languages``. Repeated rows get equal results; an empty table gives an empty one.
    """
    n = len(languages)
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    scored = stored(_text_scores(docs, model), "language")
    lettered = scored.where(F.col("n_grams") > 0).withColumn("_p", _normal(F.col("logs")))
    sums = [F.sum(F.col("_p")[k]).alias(f"_s{k}") for k in range(n)]
    mass = lambda prefix="_s": F.array(*[F.coalesce(F.col(f"{prefix}{k}"), F.lit(0.0)) for k in range(n)])

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)

    def smoothed(values: Column, parent: Column) -> Column:
        return F.zip_with(values, parent, lambda x, p: (x + F.lit(SMOOTHING) * p) / (total(values) + F.lit(SMOOTHING)))

    overall = lettered.agg(*sums).select(mass().alias("m")).first()["m"]  # one row
    whole = np.array(overall) + 1.0
    prior = F.array(*[F.lit(float(x)) for x in whole / whole.sum()])
    by_domain = lettered.groupBy("domain").agg(*sums).select("domain", smoothed(mass(), prior).alias("_domain_prior"))
    by_host = lettered.where(F.col("host").isNotNull()).groupBy("host").agg(*sums, F.min("domain").alias("domain"))
    by_domain = by_domain.where(F.col("domain").isNotNull())
    hosts = (
        by_host.join(by_domain, "domain", "left")
        .select("host", smoothed(mass(), F.coalesce("_domain_prior", prior)).alias("_host_prior"))
    )

    def emission(column: str) -> DataFrame:
        """log P(value | language) for each value of a declared column, smoothed by one document per language."""
        sizes = F.array(*[F.lit(float(x)) for x in whole])
        seen = lettered.where(F.col(column).isNotNull()).groupBy(column).agg(*sums)
        return seen.select(column, F.zip_with(mass(), sizes, lambda x, s: F.ln((x + 0.5) / (s + 1.0))).alias(f"_{column}"))

    flat = F.array(*[F.lit(0.0)] * n)
    # one row per host, declared language or suffix: attached with a salt, so a hot host does not meet in one task
    joined = join_totals(scored, hosts, ["host"], grows=True)
    joined = join_totals(joined, by_domain, ["domain"], grows=True)
    joined = join_totals(joined, emission("declared"), ["declared"])
    joined = join_totals(joined, emission("suffix"), ["suffix"])
    host_prior = F.coalesce("_host_prior", "_domain_prior", prior)
    fused = F.col("logs")
    for part in (F.transform(host_prior, lambda x: F.ln(x)), F.coalesce("_declared", flat), F.coalesce("_suffix", flat)):
        fused = F.zip_with(fused, part, lambda a, b: a + b)
    names = F.array(*map(F.lit, languages))
    best = lambda values: F.element_at(names, F.array_position(values, F.array_max(values)).cast("int"))
    has = F.col("n_grams") > 0
    posterior = joined.withColumn("_posterior", _normal(fused))
    return posterior.select(
        "doc_id",
        F.when(has, best(F.col("_posterior"))).alias("lang"),
        F.when(has, F.array_max("_posterior")).otherwise(F.lit(0.0)).alias("posterior"),
        F.when(has, best(F.col("logs"))).alias("text_lang"),
        "declared",
        "n_grams",
        (has & (F.array_max("_posterior") >= least)).alias("accepted"),
    )
