"""Language evidence, quality, and the pipeline that joins all."""

import re

import numpy as np
import pytest
from brute import ASSIGN, awkward, base_spans, crc, documents, near_groups, prose
from pyspark.sql import functions as F

import corpus_pipeline
from skyledger.llm import language_id, packing, pu_quality, queries


@pytest.fixture(scope="module")
def model(spark, sf):
    return language_id.fit_text_model(queries.table(spark, sf, "documents"))


def test_language_of_labelled_texts(spark, sf, model):
    docs = queries.table(spark, sf, "documents")
    got = language_id.identify(language_id.document_evidence(docs), model).toPandas()
    want = docs.select("doc_id", "lang").toPandas().rename(columns={"lang": "true"})
    both = got.merge(want, on="doc_id")
    assert len(both) == len(want) and (both.lang == both.true).mean() > 0.98 and (both.text_lang == both.true).mean() > 0.95
    assert both.accepted.mean() > 0.99


def test_language_without_declaration(spark, sf, model):
    docs = queries.table(spark, sf, "documents").where(F.length("text") > 200)
    bare = language_id.document_evidence(docs.withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit(None).cast("string")))
    got = language_id.identify(bare, model).toPandas().merge(docs.select("doc_id", F.col("lang").alias("true")).toPandas(), on="doc_id")
    assert (got.lang == got.true).mean() > 0.97


def test_host_and_declaration_decide_short_texts(spark, model):
    rows = [(i, "Der und die ist nicht ein lich keit ung schein", "de", "de", "a.de", "x.a.de") for i in range(30)]
    rows += [(i, "the and that with was for ing tion", "en", "com", "b.com", "b.com") for i in range(30, 60)]
    rows += [(100, "qx", None, None, None, "x.a.de"), (101, "qx", None, None, None, "b.com"), (102, "qx", None, None, "a.de", "new.a.de")]
    rows += [(103, "qx", "de", None, None, None), (104, "qx", "en", None, None, None), (105, "qx", None, "de", None, None)]
    rows += [(106, None, "de", "de", "a.de", "x.a.de"), (107, "12 34", "de", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, declared string, suffix string, domain string, host string")
    got = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    assert [got[i].lang for i in (100, 101, 102, 103, 104, 105)] == ["de", "en", "de", "de", "en", "de"]
    assert got[106].lang is None and not got[106].accepted and not got[107].accepted


def test_page_evidence(spark):
    html = '<!DOCTYPE html><HTML class="x" lang=\'FR-ca\'><script>var a="<b>";</script><p>un <b>deux</b></p><!-- no -->'
    pages = spark.createDataFrame(
        [(1, "https://u@blog.x.example.fr:80/a?b=http://q.de", html), (2, None, None), (3, "nonsense", "")], "page_id long, url string, html string"
    )
    got = {r.doc_id: r for r in language_id.page_evidence(pages).collect()}
    assert (got[1].declared, got[1].suffix, got[1].domain, got[1].host) == ("fr", "fr", "example.fr", "blog.x.example.fr")
    assert got[1].text.split() == ["un", "deux"] and got[2].host is None and got[3].suffix is None


def test_language_awkward_rows(spark, model):
    got = language_id.identify(language_id.document_evidence(documents(spark, awkward())), model).collect()
    assert len(got) == len(awkward())
    assert {r.doc_id for r in got if not r.accepted} - {4} == {1, 2, 3, 9}
    empty = language_id.identify(language_id.document_evidence(documents(spark, []).limit(0)), model)
    assert empty.count() == 0 and language_id.fit_text_model(documents(spark, []).limit(0)).shape[0] == 4


def test_quality_on_held_out_rows(spark, sf):
    docs, labels = queries.table(spark, sf, "documents"), queries.table(spark, sf, "labels")
    got = pu_quality.classify(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    assert set(got.held_out) == {True, False}
    out = got[got.held_out]
    assert (out.predicted == out.quality).mean() > 0.9
    # labels of the held-out fold are never learned from
    flipped = labels.withColumn("quality", F.when(pu_quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = pu_quality.classify(docs, flipped).toPandas().merge(got, on="doc_id")
    assert np.allclose(again.score_x, again.score_y)


def test_risk_is_never_negative():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1.5, 1, (400, 3)), rng.normal(-1.5, 1, (400, 3))
    mix = np.concatenate([good[:200], bad])
    fitted = pu_quality.fit_nnpu(good[200:], mix, prior=1 / 3)
    z = [np.clip((x - fitted.mean) * fitted.scale, -8, 8) @ fitted.weights + fitted.bias for x in (good[:200], bad)]
    assert (z[0] > 0).mean() > 0.9 and (z[1] < 0).mean() > 0.9


def test_quality_awkward_rows(spark):
    docs = documents(spark, awkward())
    labels = spark.createDataFrame([(5, 1, 0), (6, 1, 0), (7, None, 0), (10, 0, 0), (8, 1, 0), (8, 0, 0), (None, 1, 0), (8000, 1, 1)], "doc_id long, quality int, toxic int")
    got = pu_quality.classify(docs, labels).collect()
    assert len(got) == len(awkward()) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    none = pu_quality.classify(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert pu_quality.classify(docs.limit(0), labels).count() == 0


def _redacted(text: str) -> str:
    from skyledger.llm import secret_scan

    marks = [(a, b) for a, _, b in base_spans(text)]
    for m in re.finditer(secret_scan.CANDIDATE, text):
        word = m[0]
        if re.search("[0-9]", word) and re.search("[A-Za-z]", word):
            marks.append((m.start(), m.end()))
    out, at = "", 0
    for a, b in sorted(marks):
        if a >= at:
            out += text[at:a] + "[SECRET]"
        at = max(at, b)
    return out + text[at:]


def test_pipeline_equals_brute_force(spark, sf):
    from tokenizers import Tokenizer

    docs = {r.doc_id: r.text for r in queries.table(spark, sf, "documents").collect()}
    got = corpus_pipeline.run(spark, sf).toPandas()
    group = near_groups({d: t for d, t in docs.items() if t and re.search(r"[^\W\d_]", t)})
    tokenizer = Tokenizer.from_file(packing.tokenizer_file())
    want = set()
    for d in (d for d, g in group.items() if d == g):
        assert len(ASSIGN.findall(docs[d])) < 9
        ids = tokenizer.encode(_redacted(docs[d]), add_special_tokens=False).ids + [0]
        want |= {(d, k // 2048, crc(ids[k : k + 2048])) for k in range(0, len(ids), 2048)}
    assert {(r.doc_id, r.piece, r.ids_crc32) for r in got.itertuples()} == want
    assert got.groupby("sequence_id").length.sum().max() <= 2048


def test_stages_keep_columns_and_take_awkward_rows(spark):
    docs = documents(spark, awkward())
    rows = docs
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, "")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert rows.columns == docs.columns
        if name == "near_copies":
            left = sorted(-1 if r.doc_id is None else r.doc_id for r in rows.collect())
            # one letter may be too little to tell the language
            assert [i for i in left if i != 4] == [-1, 5, 7, 7, 10]
    assert rows.where("piece = 0 AND doc_id <> 4").count() == 4


@pytest.mark.parametrize("lazy", [True, False])
def test_sequences_follow_the_mix(spark, tmp_path, monkeypatch, lazy):
    monkeypatch.setattr(packing, "SHARD_PIECES", 64)
    rows = [(i, prose(i, 150), "en", f"src{i % 2}") for i in range(1600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(7)
    mixed = corpus_pipeline.mixture(spark, docs, "")
    if not lazy:
        mixed.write.parquet(str(tmp_path / "mixed"))
        mixed = spark.read.parquet(str(tmp_path / "mixed"))
    got = corpus_pipeline.packed(spark, mixed, "").toPandas().sort_values("sequence_id")
    assert sorted(got.doc_id) == list(range(1600)) and got.groupby("sequence_id").length.sum().max() <= 2048
    assert not set(got.columns) - {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    # src0 : src1 = 60 : 20 until src0 runs out after two thirds of all, a block being a twelfth of a source or so
    done = got.length.cumsum() / got.length.sum()
    share = lambda a, b: got.length[(done > a) & (done <= b) & (got.doc_id % 2 == 0)].sum() / got.length.sum() / (b - a)
    assert 0.6 < share(0, 0.3) < 0.9 and 0.6 < share(0.3, 0.6) < 0.9 and share(0.75, 1) < 0.1


def test_stages_take_an_empty_table(spark):
    rows = documents(spark, []).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, "")
    assert rows.count() == 0
