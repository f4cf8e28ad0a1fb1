"""The registered queries of the operators, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import (
    cap_filters,
    fuzzy_passages,
    language_id,
    merkle,
    mixing,
    packing,
    prob_minhash,
    pu_quality,
    secret_scan,
    spelling,
    suffix_dedup,
    topk_search,
    url_rules,
)
from skyledger.plans.registry import Query

REGISTRY: dict[str, Query] = {}

#: Shares of the mix, out of their sum: the largest source counts for less than its rows, all others alike.
SHARES = {"src0": 60, **{f"src{i}": 20 for i in range(1, 20)}, mixing.OTHER: 20}


def query(name: str, sql: str | None = None) -> Callable:
    def add(run):
        REGISTRY[name] = Query(name, run, sql)
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op2_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"))
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


@query("op3_pfair_mixing")
def pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its turn in the mix."""
    return mixing.mix(table(spark, sf_dir, "documents"), SHARES)


@query("op8_entropy_secret_scan")
def entropy_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest and text of the spans of every document."""
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < 3)

    def count(k: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")

    counts = [count(k).alias(f"n_{kind}") for k, kind in enumerate(secret_scan.KINDS)]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("spans")).alias("spans"),
    )


@query("op7_language_evidence")
def language_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and posterior of every document."""
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(language_id.document_evidence(docs), language_id.fit_text_model(docs))


@query("op10_pu_quality")
def pu_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return pu_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


TOP_K_SQL = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT vec_id, unnest(range(len(v))) AS i, unnest(v) AS x FROM usable
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
  FROM parts q JOIN parts c ON q.i = c.i AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
  GROUP BY ALL
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scores
QUALIFY rank <= 5
"""


@query("op1_pivot_top_k", TOP_K_SQL)
def pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors of every fiftieth vector."""
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


CAP_FILTER_SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reached AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION
  SELECT r.vec_id, l.b FROM reached r JOIN links l ON r.other = l.a
), components AS (
  SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id
)
SELECT e.vec_id, count(l.b) AS n_links, any_value(c.component_id) AS component_id,
       any_value(c.component_id) = e.vec_id AS kept
FROM embeddings e JOIN components c USING (vec_id) LEFT JOIN links l ON l.a = e.vec_id
GROUP BY e.vec_id
"""


@query("op5_cap_filter_near_duplicates", CAP_FILTER_SQL)
def cap_filter_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return cap_filters.near_duplicates(table(spark, sf_dir, "embeddings"))


PROB_MINHASH_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS ws FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
), grams AS (
  SELECT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g
  FROM words
), counts AS (
  SELECT doc_id, g, count(*)::DOUBLE AS x FROM grams GROUP BY ALL
), totals AS (
  SELECT doc_id, sum(x) AS total FROM counts GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, sum(a.x) AS xa, sum(b.x) AS xb
  FROM counts a JOIN counts b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL
), near AS (
  SELECT a, b, ta.total - xa AS only_a, tb.total - xb AS only_b
  FROM shared JOIN totals ta ON ta.doc_id = a JOIN totals tb ON tb.doc_id = b
  WHERE xa > 0.79 * ta.total AND xb > 0.79 * tb.total
), common AS (
  SELECT n.a, n.b, ca.x, cb.x AS y FROM near n JOIN counts ca ON ca.doc_id = n.a JOIN counts cb ON cb.doc_id = n.b AND cb.g = ca.g
), ratios AS (
  SELECT a, b, x / y AS r, sum(x) AS xs FROM common GROUP BY ALL
), larger AS (
  SELECT r.a, r.b, r.r, any_value(r.xs) AS xs, sum(greatest(m.x, r.r * m.y)) AS top FROM ratios r JOIN common m USING (a, b) GROUP BY r.a, r.b, r.r
), links AS MATERIALIZED (
  SELECT a, b FROM larger JOIN near USING (a, b) GROUP BY a, b HAVING sum(xs / (only_a + r * only_b + top)) >= 0.8
), ends AS MATERIALIZED (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
  SELECT DISTINCT doc_id, doc_id AS other FROM documents WHERE doc_id IS NOT NULL
  UNION
  SELECT r.doc_id, e.b FROM reached r JOIN ends e ON r.other = e.a
), classes AS (
  SELECT doc_id, min(other) AS class_id FROM reached GROUP BY doc_id
)
SELECT doc_id, class_id, coalesce(doc_id = class_id, true) AS kept FROM documents LEFT JOIN classes USING (doc_id)
"""


@query("op9_prob_minhash", PROB_MINHASH_SQL)
def prob_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of near copies of every document."""
    return prob_minhash.near_duplicates(table(spark, sf_dir, "documents"))


SUFFIX_SQL = """
WITH texts AS (
  SELECT doc_id, hex(encode(min(coalesce(text, '')))) AS h FROM documents GROUP BY doc_id
), sized AS (
  SELECT doc_id, h, length(h) // 2 AS n FROM texts
), strings AS (
  SELECT doc_id, s, md5(substr(h, 2 * s + 1, 200)) AS k FROM (SELECT doc_id, h, unnest(range(n - 99)) AS s FROM sized WHERE n >= 100)
), firsts AS (
  SELECT k, min(doc_id * 16777216 + s) AS place FROM strings GROUP BY k HAVING count(*) > 1
), again AS (
  SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS before
  FROM strings JOIN firsts USING (k) WHERE doc_id * 16777216 + s > place
), runs AS (
  SELECT doc_id, s, sum(CASE WHEN s <= before + 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM again
), spans AS (
  SELECT doc_id, run, min(s) AS a, max(s) + 100 AS b FROM runs GROUP BY doc_id, run
), gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM spans
  UNION ALL SELECT doc_id, max(b), 2147483647 FROM spans GROUP BY doc_id
), kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS h FROM gaps JOIN sized USING (doc_id) GROUP BY doc_id
), removed AS (
  SELECT doc_id, sum(b - a) AS bytes, count(*) AS spans FROM spans GROUP BY doc_id
)
SELECT doc_id, n AS n_bytes, coalesce(r.bytes, 0)::BIGINT AS n_removed, coalesce(r.spans, 0) AS n_spans,
       sha256(unhex(coalesce(k.h, z.h))) AS kept_sha256
FROM sized z LEFT JOIN removed r USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""


@query("op6_suffix_dedup", SUFFIX_SQL)
def suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repeats within 100 bytes and is removed from every document, with a digest of the rest."""
    done = suffix_dedup.deduplicate(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_collinear_chaining")
def collinear_chaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The passages that every document shares with an earlier one."""
    return fuzzy_passages.shared_passages(table(spark, sf_dir, "documents"))


#: CRC-32 in SQL: its table from the polynomial, and the step over the bytes of a text given in hexadecimal.
CRC_TABLE = """
crc AS MATERIALIZED (
  SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS steps
)"""


def crc_sql(hex_text: str) -> str:
    byte = f"list_transform(range(length({hex_text}) // 2), lambda i: ('0x' || substr({hex_text}, 2 * i + 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {byte}), lambda c, b: xor(c // 256, steps[xor(c % 256, b) + 1])), 4294967295)"


SPELLING_SQL = f"""
WITH RECURSIVE {CRC_TABLE}, runs AS (
  SELECT doc_id, translate(w, '{url_rules.UPPER}', '{url_rules.LOWER}') AS w
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS w FROM documents)
), per_doc AS (
  SELECT doc_id, w, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || w)) AS h FROM runs WHERE length(w) >= 6 GROUP BY doc_id, w
), checks AS (
  SELECT w, n, {crc_sql("h")} AS h FROM per_doc, crc
), words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN left(w, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS word, n FROM checks)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), cuts AS MATERIALIZED (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS cut FROM (SELECT word, n, unnest(range(length(word)))::INT AS i FROM words)
), near AS MATERIALIZED (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cuts c JOIN words w ON c.cut = w.word
  UNION SELECT w.word, c.word, c.n FROM cuts c JOIN words w ON c.cut = w.word
), judged AS MATERIALIZED (
  SELECT words.word, n, n_near, CASE WHEN best.other_n >= 5 * n THEN best.other END AS form, CASE WHEN best.other_n >= 5 * n THEN best.other_n END AS form_n
  FROM words LEFT JOIN (
    SELECT word, count(*) AS n_near, first({{'other': other, 'other_n': other_n}} ORDER BY other_n DESC, other) AS best FROM near GROUP BY word
  ) USING (word)
), chain AS (
  SELECT word, word AS reached, 0 AS step FROM judged
  UNION ALL SELECT c.word, j.form, c.step + 1 FROM chain c JOIN judged j ON c.reached = j.word WHERE j.form IS NOT NULL
), roots AS (
  SELECT word, arg_max(reached, step) AS root FROM chain GROUP BY word
)
SELECT word, form, root, n, coalesce(n_near, 0) AS n_near, form_n FROM judged JOIN roots USING (word)
"""


@query("op11_spelling_variants", SPELLING_SQL)
def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frequent words of all documents, some with a letter dropped, each with the form it is a variant of."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), shortest=6, least=5, ratio=5, drop_every=199)


#: Host rules of the contract, and globs for all other pages: mobile mirrors, feeds, sessions in paths, files that hold no text.
HOST_RULES = [
    url_rules.HostRule("block", "net", "/"),
    url_rules.HostRule("allow", "example.net", "/en/"),
    url_rules.HostRule("block", "example.com", "/de/"),
    url_rules.HostRule("allow", "org", "/fr/"),
]
URL_GLOBS = [url_rules.Glob("block", g) for g in ("m.*/**", "**/feed/", "**;jsessionid=**", "**/login", "**.zip", "**.exe", "**.jp?g")]

URL_SQL = f"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), '{url_rules.UPPER}', '{url_rules.LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages
), judged AS (
  SELECT page_id, host, path, CASE
      WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN rule IS NOT NULL THEN 'allow'
    WHEN regexp_full_match(host || path, 'm[.][^/]*/.*|.*/feed/|.*;jsessionid=.*|.*/login|.*[.]zip|.*[.]exe|.*[.]jp[^/]g', 's') THEN 'block'
    ELSE 'allow' END AS verdict
FROM judged
"""


@query("op12_url_rules", URL_SQL)
def url_rule_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    return url_rules.judge(table(spark, sf_dir, "pages"), HOST_RULES, URL_GLOBS)


def _tree_sql(prefix: str, leaves: str, depth: int) -> str:
    """CTEs of one set of trees: node levels from ``leaves`` (tree, idx, d), and left and right neighbours in each run."""
    out = [f"{prefix}0 AS MATERIALIZED (SELECT tree, idx, d, count(*) OVER (PARTITION BY tree) AS n FROM {leaves})"]
    for k in range(depth):
        out.append(f"""{prefix}{k + 1} AS MATERIALIZED (
  SELECT tree, idx // 8 AS idx, sha256(string_agg(d, '' ORDER BY idx)) AS d, count(*) OVER (PARTITION BY tree) AS n FROM {prefix}{k} WHERE n > 1 GROUP BY tree, idx // 8
  UNION ALL SELECT tree, idx, d, n FROM {prefix}{k} WHERE n = 1
)""")
        run = "PARTITION BY tree, idx // 8 ORDER BY idx ROWS BETWEEN"
        out.append(f"""{prefix}{k}_run AS MATERIALIZED (
  SELECT tree, idx, n > 1 AS climbs, coalesce(string_agg(d, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {prefix}{k}
)""")
    return ",\n".join(out)


def _fold_sql(prefix: str, source: str, depth: int) -> str:
    """CTEs that carry (tree, idx, proof, folded) of ``source`` up all levels; the rest of the row rides along."""
    out = []
    for k in range(depth):
        out.append(f"""{prefix}{k}_fold AS (
  SELECT s.* EXCLUDE (idx, proof, folded), CASE WHEN climbs THEN s.idx // 8 ELSE s.idx END AS idx,
         CASE WHEN climbs THEN proof || l || r ELSE proof END AS proof, CASE WHEN climbs THEN sha256(l || folded || r) ELSE folded END AS folded
  FROM {source} s JOIN {prefix}{k}_run t ON s.tree = t.tree AND s.idx = t.idx
)""")
        source = f"{prefix}{k}_fold"
    return ",\n".join(out)


def _field_sql(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR))::VARCHAR || ':' || {value}::VARCHAR, '-')"


LEAF_SQL = " || ".join(_field_sql(c) for c in merkle.FIELDS)
FORGED_SQL = " || ".join(_field_sql("forged" if c == "text" else c) for c in merkle.FIELDS)
LEVELS, TOP_LEVELS = 6, 2  # enough for 262,144 rows of a language and 64 languages

MERKLE_SQL = f"""
WITH {CRC_TABLE}, checks AS (
  SELECT d.*, {crc_sql("hex(encode(doc_id::VARCHAR))")} AS c FROM documents d, crc
), swapped AS (
  SELECT *, CASE WHEN c % 3 = 0 THEN translate(text, '{url_rules.UPPER}', '{url_rules.LOWER}') ELSE text END AS forged FROM checks
), leaves AS MATERIALIZED (
  SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS tree, sha256({LEAF_SQL}) AS d, sha256({FORGED_SQL}) AS claim FROM swapped
), placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, d) - 1 AS idx FROM leaves
), {_tree_sql("t", "placed", LEVELS)}, groups AS MATERIALIZED (
  SELECT tree AS name, '' AS tree, d, row_number() OVER (ORDER BY tree) - 1 AS idx FROM t{LEVELS}
), {_tree_sql("g", "groups", TOP_LEVELS)}, begun AS (
  SELECT doc_id, d AS leaf, tree, idx, '' AS proof, claim AS folded FROM placed
), {_fold_sql("t", "begun", LEVELS)}, joined AS (
  SELECT f.doc_id, f.leaf, f.proof, f.folded, g.d AS subroot, g.tree, g.idx FROM t{LEVELS - 1}_fold f JOIN groups g ON f.tree = g.name
), {_fold_sql("g", "joined", TOP_LEVELS)}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM g{TOP_LEVELS - 1}_fold, (SELECT d AS root FROM g{TOP_LEVELS})
"""


@query("op13_merkle_manifest", MERKLE_SQL)
def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document; a third of the proofs are checked with a changed text."""
    forged = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    text = F.when(forged, merkle.lower_ascii(F.col("text"))).otherwise(F.col("text"))
    return merkle.manifest(table(spark, sf_dir, "documents"), text)
