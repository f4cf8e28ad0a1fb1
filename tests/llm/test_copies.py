"""Suffix arrays, ProbMinHash, fuzzy passages."""

import collections
import random

import numpy as np
import pyarrow as pa
import pytest
from brute import awkward, components, documents, near_groups, probability_jaccard, prose, shingle_counts, substring_dedup

from skyledger.llm import fuzzy_passages, prob_minhash, suffix_dedup


def test_suffix_array_orders_all_suffixes():
    rng = np.random.default_rng(0)
    for _ in range(150):
        text = rng.integers(0, rng.integers(2, 6), rng.integers(1, 120)).astype(np.uint8)
        text[-1] = 0
        order = suffix_dedup.suffix_array(text, 25)

        def first_values(i, text=text):
            part = text[i : i + 25].tolist()
            return part[: part.index(0)] if 0 in part else part

        keys = [first_values(i) for i in order]
        assert sorted(order.tolist()) == list(range(len(text))) and keys == sorted(keys)


def test_equal_strings_share_an_anchor():
    data = np.frombuffer((prose(4, 80) + prose(5, 10) + prose(4, 80) + "und " * 90).encode(), np.uint8)
    key, start, count, off, _ = suffix_dedup.segments(data, np.array([0, len(data)]))
    assert count.sum() == len(data) - 99 and (np.diff(start) == count[:-1]).all()
    anchors = {s + j: (k, o - j) for k, s, c, o in zip(key, start, count, off, strict=True) for j in range(c)}
    seen = collections.defaultdict(set)
    for p, anchor in anchors.items():
        seen[data[p : p + 100].tobytes()].add(anchor)
    assert all(len(v) == 1 for v in seen.values())


def _copies() -> list[tuple]:
    """Passages that begin and end at many places, in many contexts, and within one text."""
    rng = random.Random(8)
    passages = [prose(20 + i, 40) for i in range(3)]
    texts = awkward()
    for i in range(40):
        parts = [prose(100 + i, rng.randint(0, 30))]
        for _ in range(rng.randint(1, 3)):
            p = rng.choice(passages)
            cut = rng.randint(0, 80)
            parts += [p[cut : len(p) - rng.randint(0, 60)], prose(rng.randint(1, 10**6), rng.randint(0, 12))]
        texts.append((100 + i, " ".join(parts)))
    return texts


@pytest.mark.parametrize("hot", [50_000, 16])
def test_suffix_dedup_equals_brute_force(spark, monkeypatch, hot):
    # with few documents a low bound makes anchors hot, which are then split into single strings
    monkeypatch.setattr(suffix_dedup, "HOT_SEGMENTS", hot)
    monkeypatch.setattr(suffix_dedup, "HOT_SAMPLE", 1 if hot == 16 else 16)
    rows = _copies()
    got = suffix_dedup.deduplicate(documents(spark, rows)).collect()
    want = substring_dedup({i: t for i, t in rows if i is not None}, 100)
    named = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got if r.doc_id is not None}
    assert named == want
    lone = [r for r in got if r.doc_id is None]
    assert len(got) == len(want) + 1 and bytes(lone[0].kept).decode() == rows[0][1]


def test_suffix_dedup_empty(spark):
    assert suffix_dedup.deduplicate(documents(spark, []).limit(0)).count() == 0
    conflict = suffix_dedup.deduplicate(documents(spark, [(1, "b"), (1, "a"), (2, None)])).collect()
    assert sorted((r.doc_id, bytes(r.kept)) for r in conflict) == [(1, b"a"), (2, b"")]


def test_registers_agree_as_often_as_texts_are_similar():
    a = "x " * 30 + prose(1, 150)
    b = "x " * 10 + prose(1, 150) + " " + prose(2, 40)
    hashed, weight, bounds, _ = prob_minhash.shingles(pa.array([a, b, a + " " + a, "", "one two"]))
    registers = prob_minhash.signatures(hashed, weight, bounds, 4096)
    exact = probability_jaccard(shingle_counts(a), shingle_counts(b))
    sets = [(hashed[s:e], weight[s:e]) for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
    assert prob_minhash.probability_jaccard(sets[0], sets[1]) == pytest.approx(exact, abs=1e-9)
    assert (registers[0] == registers[1]).mean() == pytest.approx(exact, abs=0.035)
    assert (registers[4] != 0).all() and not registers[3].any()


def _edited(text: str, share: float, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join(f"new{rng.randint(0, 10**6)}" if rng.random() < share else w for w in text.split())


@pytest.mark.parametrize("held", [None, 2000])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, held):
    if held:  # cells are compared in parts
        monkeypatch.setattr(prob_minhash, "HELD_BYTES", held)
    rows = awkward()
    for g in range(6):
        original = prose(50 + g, 150)
        rows += [(1000 * (g + 1) + i, _edited(original, 0.004 * (i % 7), 31 * g + i)) for i in range(14)]
    drift = prose(60, 200).split()
    # neighbours are similar, the ends are not
    rows += [(9000 + i, " ".join(drift[12 * i : 12 * i + 150])) for i in range(4)]
    rows += [(9100, prose(61, 80)), (9101, prose(61, 80).upper() + "!"), (9102, "a b c"), (9103, "A, b; C")]
    got = {(r.doc_id, r.class_id, r.kept) for r in prob_minhash.near_duplicates(documents(spark, rows)).collect()}
    group = near_groups({i: t for i, t in rows if i is not None})
    assert got == {(i, group.get(i), i is None or group[i] == i) for i, _ in rows}
    assert group[9101] == 9100 and group[9103] == 9102


def test_near_duplicates_of_nothing(spark):
    assert prob_minhash.near_duplicates(documents(spark, []).limit(0)).count() == 0
    blank = prob_minhash.near_duplicates(documents(spark, [(1, None), (2, ""), (3, "?!")])).collect()
    assert sorted(tuple(r) for r in blank) == [(1, 1, True), (2, 2, True), (3, 3, True)]


def test_chains_are_the_best_in_order():
    rng = np.random.default_rng(3)
    for _ in range(60):
        n = int(rng.integers(1, 9))
        x, y, length = rng.integers(0, 60, n), rng.integers(0, 60, n), rng.integers(5, 12, n)

        def best(i, x=x, y=y, length=length, n=n):
            before = [best(j) - 0.2 * (x[i] + y[i] - x[j] - y[j] - 2 * length[j]) for j in range(n) if x[j] + length[j] <= x[i] and y[j] + length[j] <= y[i]]
            return length[i] + max([0, *before])

        chains = fuzzy_passages.chain(x, y, length)
        assert sorted(k for c in chains for k in c) == list(range(n))
        first = chains[0]
        score = length[first].sum() - 0.2 * sum(
            x[b] + y[b] - x[a] - y[a] - 2 * length[a] for a, b in zip(first[:-1], first[1:], strict=True)
        )
        assert score == pytest.approx(max(best(i) for i in range(n)))
        for a, b in zip(first[:-1], first[1:], strict=True):
            assert x[a] + length[a] <= x[b] and y[a] + length[a] <= y[b]


def test_passages_planted_and_fuzzy(spark):
    passage = prose(70, 70)
    rows = [*awkward(), (100, f"{prose(71, 200)} {passage} {prose(72, 50)}"), (101, f"{passage.upper()} {prose(73, 300)}")]
    rows += [(102, f"{prose(74, 20)} {_edited(passage, 0.05, 1)}"), (103, prose(75, 400))]
    rows += [(200 + i, f"{prose(300 + i, 60)} {passage} {prose(400 + i, 60)}") for i in range(30)]
    rows += [(500, prose(76, 260)), (501, " ".join([*prose(76, 260).split()[:100], prose(77, 90), *prose(76, 260).split()[100:]]))]
    got = fuzzy_passages.shared_passages(documents(spark, rows)).collect()
    by_doc = collections.defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
    assert set(by_doc) == {6, 8, 101, 102, 501, *range(200, 230)}
    assert {r.source_id for d in (101, 102, *range(200, 230)) for r in by_doc[d]} == {100}
    assert (by_doc[101][0].start_word, by_doc[101][0].end_word, by_doc[101][0].source_start) == (0, 70, 200)
    assert all(by_doc[200 + i][0].start_word == 60 and by_doc[200 + i][0].end_word == 130 for i in range(30))
    assert sorted((r.start_word, r.end_word) for r in by_doc[501]) == [(0, 100), (190, 350)]
    assert by_doc[6][0].end_word == 30_000 and by_doc[6][0].identity == 1.0
    assert by_doc[102][0].identity >= 0.8


def test_passages_of_every_identity(spark):
    rng, rows, planted = np.random.default_rng(11), [], collections.defaultdict(set)
    for i in range(360):
        words, share = (50, 60, 80)[i % 3], (0.0, 0.05, 0.1, 0.15)[i // 3 % 4]
        passage = prose(5000 + i, words).split()
        changed = rng.random(words) < share
        if changed.mean() > 0.2:
            continue
        copy = [f"new{rng.integers(10**9)}" if c else w for w, c in zip(passage, changed, strict=True)]
        rows += [(1000 + i, f"{prose(6000 + i, 30)} {' '.join(passage)} {prose(7000 + i, 30)}")]
        rows += [(9000 + i, f"{prose(8000 + i, 20)} {' '.join(copy)} {prose(9000 + i, 40)}")]
        planted[words, share].add((9000 + i, 1000 + i))
    got = fuzzy_passages.shared_passages(documents(spark, rows)).collect()
    assert all(r.identity >= 0.8 and min(r.end_word - r.start_word, r.source_end - r.source_start) >= 45 for r in got)
    found = {(r.doc_id, r.source_id) for r in got}
    recall = {k: len(v & found) / len(v) for k, v in planted.items()}
    assert min(recall.values()) >= 0.7 and min(r for (words, share), r in recall.items() if words >= 60 or share <= 0.05) >= 0.9, recall


def test_passages_of_common_sentences(spark):
    # three sentences of 30 words that stand alone in earlier documents, then together in two
    rows, pairs = [], set()
    for g in range(40):
        sentences = [prose(20_000 + 10 * g + k, 30) for k in range(3)]
        rows += [(1000 * g + k, f"{prose(30_000 + 10 * g + k, 30)} {sentences[k]} {prose(40_000 + 10 * g + k, 30)}") for k in range(3)]
        rows += [(1000 * g + 10 + k, f"{prose(50_000 + 10 * g + k, 30)} {' '.join(sentences)} {prose(60_000 + 10 * g + k, 30)}") for k in range(2)]
        pairs.add((1000 * g + 11, 1000 * g + 10))
    got = fuzzy_passages.shared_passages(documents(spark, rows)).collect()
    assert {(r.doc_id, r.source_id) for r in got} == pairs


def test_passages_whose_seeds_all_stand_elsewhere(spark, monkeypatch):
    # three sentences of 17 words, each in four earlier documents, together in two: too short for a long seed to be sure
    rows, pairs = [], set()
    for g in range(60):
        sentences = [prose(70_000 + 10 * g + k, 17) for k in range(3)]
        for n in range(4):
            rows += [(1000 * g + 3 * n + k, f"{prose(80_000 + 100 * g + 3 * n + k, 60)} {sentences[k]} {prose(90_000 + 100 * g + 3 * n + k, 60)}") for k in range(3)]
        rows += [(1000 * g + 20 + k, f"{prose(100_000 + 10 * g + k, 60)} {' '.join(sentences)} {prose(110_000 + 10 * g + k, 60)}") for k in range(2)]
        pairs.add((1000 * g + 21, 1000 * g + 20))
    for block in (fuzzy_passages.BLOCK, 2):
        monkeypatch.setattr(fuzzy_passages, "BLOCK", block)
        got = fuzzy_passages.shared_passages(documents(spark, rows)).collect()
        assert {(r.doc_id, r.source_id) for r in got} == pairs
        assert all(r.start_word <= 60 and r.end_word >= 111 for r in got)


def test_likely_pairs_hold_all_that_align():
    rng, margin, around = np.random.default_rng(5), fuzzy_passages.MARGIN, fuzzy_passages.AROUND
    p = rng.integers(2, 2000, (60, around)).astype(np.uint16)
    q = np.concatenate((p, rng.integers(2, 2000, (400, around)).astype(np.uint16)))
    q[:60] = np.where(rng.random((60, around)) < rng.random((60, 1)) / 2, 1, p)
    q[:60, :10] = p[:, :10] = 0  # places before a text
    q[60:, margin : margin + 5] = q[:60, margin : margin + 5] = p[:, margin : margin + 5] = 7  # the seed
    q[:20, 70:-3] = p[:20, 73:]  # words are missing behind the 70th
    seed = np.array([[margin, margin, 5]])
    for few in (q[:20], q):
        got = set(zip(*(v.tolist() for v in fuzzy_passages.likely(p, few)), strict=True))
        for i in range(60):
            for j in range(len(few)):
                x, y = np.where(p[i] == 0, 1, p[i]), few[j]
                assert (i, j) in got or not fuzzy_passages.passages(x, y, seed, 45, 0.8)
        aligned = {i for i in range(len(few[:60])) if fuzzy_passages.passages(np.where(p[i] == 0, 1, p[i]), few[i], seed, 45, 0.8)}
        assert {(i, i) for i in aligned} <= got and len(aligned) >= 5 and all(i == j for i, j in got)
        assert not any((i, j) in got for i in range(60) for j in range(60, len(few)))


def test_runs_of_one_word_are_no_likely_pairs():
    # all have 30 to 34 words in a row of the seed's word, and no other word in common: never 36 of 45
    rows = np.random.default_rng(6).integers(100, 1 << 16, (200, fuzzy_passages.AROUND)).astype(np.uint16)
    for i, row in enumerate(rows):
        row[24 + i % 7 : 54 + i % 7 + i % 5] = 7
    left, right = fuzzy_passages.likely(rows, rows)
    assert sorted(zip(left.tolist(), right.tolist(), strict=True)) == [(i, i) for i in range(len(rows))]
    # with 38 words in a row in both, every pair has a passage
    rows[:, 30:68] = 7
    left, right = fuzzy_passages.likely(rows[:30], rows)
    assert len(left) == 30 * len(rows)


def test_runs_of_one_word_are_not_tested_pair_by_pair(monkeypatch):
    own = np.random.default_rng(7).integers(100, 1 << 16, (300, 9)).astype(np.uint16)
    rows = np.repeat(own, 12, axis=1)[:, : fuzzy_passages.AROUND]
    rows[:, 40:64] = 7  # 24 words in a row are enough for the diagonal, not for a passage
    rows[50:60] = rows[:10]
    half, least = fuzzy_passages._half(45, 0.8), fuzzy_passages._least(45, 0.8)
    left = sum(len(i) for i, _ in fuzzy_passages._half_alike(rows, rows, half, least))
    assert 320 <= left < 30_000  # of 90,000 that are alike on the diagonal
    quick = [set(zip(*(v.tolist() for v in fuzzy_passages.likely(rows, rows)), strict=True))]
    monkeypatch.setattr(fuzzy_passages, "FEW_OF", 0)
    assert sum(len(i) for i, _ in fuzzy_passages._half_alike(rows, rows, half, least)) == 90_000
    quick.append(set(zip(*(v.tolist() for v in fuzzy_passages.likely(rows, rows)), strict=True)))
    equal = {(i, i) for i in range(300)} | {(i, i + 50) for i in range(10)} | {(i + 50, i) for i in range(10)}
    assert quick[0] == quick[1] >= equal and len(quick[0]) < 340  # a few have a word beside the seed in common by chance


def test_surroundings_agree_on_two_diagonals_at_most():
    rng, margin, kmer = np.random.default_rng(8), fuzzy_passages.MARGIN, fuzzy_passages.KMER
    p, q = (rng.integers(2, 6, (40, fuzzy_passages.AROUND)).astype(np.uint16) for _ in range(2))
    q[:20] = np.where(rng.random((20, fuzzy_passages.AROUND)) < 0.6, p[:20], q[:20])
    q[10:20, 60:-2] = q[10:20, 62:]
    q[:, :9], p[:, 96:] = 0, 1

    def most(x, y):  # like words of the first k on the seed's diagonal up to some place, on another behind it
        own = [int(a == b) for a, b in zip(x, y, strict=True)]
        best = []
        for k in range(1, margin + 1):
            found = [sum(own[:k])]
            for t in range(-fuzzy_passages.LARGEST_SHIFT, fuzzy_passages.LARGEST_SHIFT + 1):
                other = [int(0 <= i - t < margin and x[i] == y[i - t]) for i in range(k)]
                found += [sum(own[:u]) + sum(other[u:]) for u in range(k)]
            best.append(max(found))
        return best

    want = []
    for x, y in zip(p, q, strict=True):
        left, right = ([0, *most(a, b)] for a, b in ((x[:margin][::-1], y[:margin][::-1]), (x[margin + kmer :], y[margin + kmer :])))
        want.append(any(left[i] + right[j] + kmer >= 0.8 * (i + j + kmer) - 1e-3 for i in range(margin + 1) for j in range(margin + 1) if i + j + kmer >= 45))
    got = fuzzy_passages._alike(p, q, 45, 0.8)
    assert got.tolist() == want and 0 < sum(want) < 40


def test_equal_words_of_a_source_give_its_first_place(spark):
    rows = [(9, 1, 10, 60, start, start + 50, same, same / 50) for start, same in ((300, 48), (200, 50), (70, 48), (400, 50))]
    for order in (rows, rows[::-1]):
        got = fuzzy_passages._first_sources(spark.createDataFrame(order, fuzzy_passages._PASSAGE).coalesce(1), 2).collect()
        assert [(r.source_start, r.same_words) for r in got] == [(200, 50)]


def test_second_copy_of_a_passage(spark):
    passage = prose(80, 70)
    part = " ".join(passage.split()[:30])
    rows = [(1, f"{prose(81, 50)} {passage} {prose(82, 50)}"), (2, f"{prose(83, 40)} {passage} {prose(84, 90)} {passage}")]
    rows += [(3, f"{part} {prose(85, 60)} {passage}")]
    got = fuzzy_passages.shared_passages(documents(spark, rows)).collect()
    assert {r.source_id for r in got} == {1}
    assert sorted((r.doc_id, r.start_word, r.end_word) for r in got) == [(2, 40, 110), (2, 200, 270), (3, 90, 160)]


def test_passages_of_nothing(spark):
    assert fuzzy_passages.shared_passages(documents(spark, []).limit(0)).count() == 0
    assert fuzzy_passages.shared_passages(documents(spark, [(1, None), (2, ""), (3, "a b"), (3, "a b")])).count() == 0


def test_groups_by_links_only():
    assert components([1, 2, 3], [(2, 3)]) == {1: 1, 2: 2, 3: 2}
