"""Spelling variants, URL rules and the Merkle manifest against plain versions."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from brute import awkward, documents, prose
from pyspark.sql import functions as F

from skyledger.llm import merkle, spelling, url_rules
from skyledger.llm.common import stored
from skyledger.llm.queries import HOST_RULES, URL_GLOBS

UP, LOW = url_rules.UPPER, url_rules.LOWER


# ------------------------------------------------------------------------------------------------- spelling


def one_edit(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_counts(rows, shortest, drop_every, least):
    n = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = run.translate(str.maketrans(UP, LOW))
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if drop_every and h % drop_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= shortest:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= least}


def plain_groups(n, ratio=5):
    out = {}
    for w in n:
        near = sorted((-n[v], v) for v in n if one_edit(w, v))
        form = near[0][1] if near and -near[0][0] >= ratio * n[w] else None
        out[w] = (form, len(near))
    roots = {}
    for w in n:
        at = w
        while out[at][0]:
            at = out[at][0]
        roots[w] = at
    return sorted((w, f, roots[w], n[w], k, n[f] if f else None) for w, (f, k) in out.items())


def as_rows(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def test_variants_of_documents_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    base = ["Straße", "window", "windows", "éléphant", "MOUNTAIN", "mountain", "river", "riverbank", "quality"]
    texts = [(i, " ".join(rng.choice(base, 40)) + " " + prose(i, 60)) for i in range(120)]
    texts += [(i, t) for i, t in awkward() if t is None or len(t) < 100_000][:12] + [(5, texts[5][1]), (None, texts[3][1]), (900, "wîndow " * 3 + "windøw× " * 9)]
    got = as_rows(spelling.spelling_variants(documents(spark, texts), shortest=6, least=2, drop_every=7))
    want = plain_groups(plain_counts(texts, 6, 7, 2))
    assert got == want
    assert sum(1 for w in want if w[1]) > 10


def test_every_pair_is_found_at_all_lengths(spark, monkeypatch):
    monkeypatch.setattr(spelling, "LEAST_FREQUENT", 3)
    rng = np.random.default_rng(8)
    words = {"".join(rng.choice(list("abc"), k)) for k in (2, 3, 4, 5, 6, 7, 9, 14, 30) for _ in range(120)}
    words |= {w[:i] + c + w[i + j :] for w in list(words)[:80] for i in (0, len(w) // 2, len(w) - 1, len(w)) for j in (0, 1) for c in ("", "é", "a")}
    words = sorted(w for w in words if len(w) > 1)
    counts = {w: int(rng.integers(1, 400)) for w in words}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    pairs = {frozenset((r.a, r.b)) for r in spelling.near_words(frame).collect()}
    assert pairs == {frozenset((a, b)) for i, a in enumerate(words) for b in words[i + 1 :] if one_edit(a, b)}
    assert as_rows(spelling.group_variants(frame)) == plain_groups(counts)


def test_lists_are_not_broadcast_by_the_size_of_the_words_file(spark):
    rows = [("".join(chr(97 + (i * k) % 26) for k in range(1, 8)), 5) for i in range(200)]
    words = stored(spark.createDataFrame(sorted(set(rows)), "word string, n long"), "words")
    plan = spelling.near_words(words)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    plan = spelling.group_variants(words)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_two_lists_that_no_edit_changes_together():
    rng = np.random.default_rng(1)
    for _ in range(300):
        word = "".join(rng.choice(list("abcdef"), rng.integers(2, 25)))
        frequent = {word[i : i + k]: 9 for i in range(len(word)) for k in range(2, 8) if rng.random() < 0.6}
        found = spelling.grams(spelling.FIRST + word + spelling.LAST, spelling.reach(len(word)), frequent)
        first, second = spelling.chosen(found, frequent)
        assert first + len(found[first]) <= second


def test_forms_lead_to_a_root_over_many_steps(spark):
    chain = ["abcdef" + "x" * k for k in range(7)]
    frame = spark.createDataFrame([(w, 5 ** (7 - k)) for k, w in enumerate(chain)], "word string, n long")
    got = {r.word: (r.form, r.root) for r in spelling.group_variants(frame).collect()}
    assert got == {w: (chain[k - 1] if k else None, chain[0]) for k, w in enumerate(chain)}


def test_no_words(spark):
    assert spelling.spelling_variants(documents(spark, [(1, None), (2, "")])).count() == 0
    assert spelling.spelling_variants(documents(spark, [(1, "x")]).limit(0)).count() == 0
    long = spelling.count_words(documents(spark, [(1, "a" * 300_000 + " " + "word" * 3)]), 6)
    assert {(len(r.word), r.n) for r in long.collect()} == {(300_000, 1), (12, 1)}


# ------------------------------------------------------------------------------------------------- URL rules


def plain_parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return host.translate(str.maketrans(UP, LOW)), re.split("[?#]", rest[len(host) :], maxsplit=1)[0]


def plain_glob(pattern):
    parts = {"**": "(?s:.*)", "*": "[^/]*", "?": "[^/]"}
    return re.compile("".join(parts.get(p, re.escape(p)) for p in re.findall(r"\*\*|.", pattern, re.S)))


def plain_verdict(url, rules, globs, default="allow"):
    host, path = plain_parts(url)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fits:
        best = min(fits, key=lambda r: (-len(r.text), r.verdict != "block", r.text))
        return host, path, best.text, best.verdict
    hits = {g.verdict for g in globs if plain_glob(g.pattern).fullmatch(host + path)}
    return host, path, None, "block" if "block" in hits else "allow" if hits else default


URLS = [
    None, "", "no scheme", "://", "http://", "http://NET", "http://net/", "http://a.net/x", "http://.net/", "http://anet/x", "https://Example.NET/en/1?q#f",
    "http://example.net/en", "http://b.example.net/en/", "http://example.com/de/", "http://x.org/fr/?a", "http://org/fr/\nnext", "a://b://net/", "http://net?x/",
    "http://m.é.org/fr", "http://m.x.com/", "http://x.com/a/feed/", "http://x.com/login", "http://x.com/pic.jpeg", "http://x.com/pic.jpég", "http://x.com/p;jsessionid=1",
    "http://net:80/", "http://user@net/", "http://x.com/" + "a" * 30_000 + ".zip", "http://ÀÉ.Example.com/de/é", "http://x.com/\U0001f600.exe",
]


def pages(spark, urls):
    return spark.createDataFrame([(k, u, "h", "r", "v") for k, u in enumerate(urls)], "page_id long, url string, host string, rule string, verdict string")


def judged(spark, urls, rules, globs, **more):
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge(pages(spark, urls), rules, globs, **more).collect()}


def test_rules_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    hosts = ["net", "example.net", "a.example.net", "m.org", "blog.com", "xnet", "Net"]
    ends = ["", "/", "/en/", "/en/a.zip", "/fr/feed/", "/de/x/login", "?q=/en/", "#/x"]
    urls = URLS + [f"http://{rng.choice(hosts)}{rng.choice(ends)}" for _ in range(300)]
    got = judged(spark, urls, HOST_RULES, URL_GLOBS)
    assert got == {k: plain_verdict(u, HOST_RULES, URL_GLOBS) for k, u in enumerate(urls)}
    assert len(got) == len(urls)


def test_random_globs_over_several_words():
    rng = np.random.default_rng(3)
    globs = sorted({url_rules.Glob(str(rng.choice(["allow", "block"])), "".join(rng.choice(["a", "b", "/", "?", "*", "**", "é"], rng.integers(0, 9)))) for _ in range(150)})
    automaton = url_rules.Automaton([], globs + [url_rules.Glob("block", "a" * 200 + "*b")])
    assert automaton.enter.shape[1] > 8
    urls = ["".join(rng.choice(["a", "b", "/", "é", "z"], rng.integers(0, 10))) for _ in range(400)] + ["a" * 200 + "zzb", "a" * 199 + "b"]
    for url, rank in zip(urls, automaton.first_match(urls), strict=True):
        hits = [k for k, g in enumerate(automaton.globs) if plain_glob(g.pattern).fullmatch(url)]
        assert rank == (hits[0] if hits else len(automaton.globs)), url


def test_ties_empty_rules_and_tables(spark):
    rules = [url_rules.HostRule("allow", "a.com", "/x"), url_rules.HostRule("block", "a.com", "/x"), url_rules.HostRule("allow", "b.com", "")]
    got = judged(spark, ["http://a.com/xy", "http://b.com", "http://c.com/"], rules, [], default="block")
    assert [got[k][2:] for k in range(3)] == [("a.com/x", "block"), ("b.com", "allow"), (None, "block")]
    assert judged(spark, URLS, [], []) == {k: (*plain_parts(u), None, "allow") for k, u in enumerate(URLS)}
    assert url_rules.judge(pages(spark, ["x"]).limit(0), HOST_RULES).count() == 0
    everything = judged(spark, [None, "http://q/"], [url_rules.HostRule("block", "", "")], [])
    assert everything[0][3] == "block"
    with pytest.raises(ValueError):
        url_rules.Automaton([], [url_rules.Glob("maybe", "*")])


# ------------------------------------------------------------------------------------------------- Merkle manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes):
    """Levels of one tree, leaves first."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def path(tree, at, digest):
    siblings = []
    for level in tree[:-1]:
        start = at // 8 * 8
        run = level[start : start + 8]
        siblings += run[: at - start] + run[at - start + 1 :]
        digest = h(*run[: at - start], digest, *run[at - start + 1 :])
        at //= 8
    return siblings, digest


def plain_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text, forged text)."""
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0], h(*map(field, r[:5])), h(*map(field, (*r[:4], r[5])))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[g] = climb([leaf for _, leaf, _ in groups[g]])
    top = climb([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for at, (doc, leaf, claim) in enumerate(groups[g]):
            first, digest = path(trees[g], at, claim)
            second, digest = path(top, k, digest)
            out.append((doc, leaf, trees[g][-1][0], top[-1][0], h(*first, *second), digest, digest == top[-1][0]))
    return sorted(out, key=str)


def manifest_rows(spark, rows, **more):
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, forged string, leaf string, tree string")
    got = merkle.manifest(frame, F.col("forged"), **more).collect()
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[n] for n in names) for r in got), key=str)


@pytest.mark.parametrize("depth", [1, 2, 4])
def test_manifest_equals_brute_force(spark, depth):
    rng = np.random.default_rng(depth)
    langs = [None, "", "en", "de", "é", "z\U0001f600", *[f"l{k}" for k in range(9)]]
    rows = []
    for i in range(700):
        lang = "en" if i % 3 else langs[int(rng.integers(0, len(langs)))]
        text = None if i % 50 == 7 else "" if i % 50 == 8 else f"Text Ü {i}"
        rows.append((i if i % 97 else None, None if i % 11 == 0 else f"src{i % 4}", lang, i, text, text.lower() if text and i % 3 == 0 else text))
    rows += rows[5:9] + [(9_000, "s", "en", 1, "A" * 400_000, "a" * 400_000)]
    got = manifest_rows(spark, rows, depth=depth)
    assert got == plain_manifest(rows)
    assert {r[-1] for r in got} == {True, False}


def test_lone_rows_and_empty_tables(spark):
    one = [(1, "s", None, 3, "abc", "abc")]
    got = manifest_rows(spark, one)
    assert got == plain_manifest(one)
    assert got[0][1] == got[0][3] and got[0][4] == h() and got[0][-1]
    for n in (8, 9, 64, 65):
        rows = [(i, "s", "en", 3, f"t{i}", f"t{i}") for i in range(n)]
        assert manifest_rows(spark, rows, depth=1) == plain_manifest(rows)
    assert merkle.manifest(documents(spark, [(1, "x")]).limit(0), F.col("text")).count() == 0
