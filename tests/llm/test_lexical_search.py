"""Ranked search against scoring every document, and its bounds."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from corpora import documents, rows, sentence, stored

from castledger.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [t.translate({i: i + 32 for i in range(65, 91)}) for t in TERM.findall(text or "")]


def brute(data, items, best=20):
    docs = [(d, Counter(t), len(t)) for d, t in ((r[0], terms(r[1])) for r in data) if t]
    n_docs, total = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, counts, n in docs:
            m = 100 - 25 + 25 * n * n_docs // total
            score = 0
            for term, times in Counter(terms(text)).items():
                if counts[term]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += times * w * (1_000_000_000 * counts[term] // (1000 * counts[term] + 12 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        for rank, (score, absent, doc) in enumerate(sorted(found)[:best], 1):
            out.append((item, rank, None if absent else doc, -score))
    return sorted(out, key=repr)


def corpus(seed, n=160):
    """Few words, so lists are long, scores tie and terms go together."""
    rng = random.Random(seed)
    words = sentence(rng, 60).split()
    common = words[:6]
    data = []
    for i in range(n):
        own = rng.choices(words, k=rng.randint(1, 40)) + rng.choices(common, k=rng.randint(0, 20))
        data.append((i * 7 % 1009, " ".join(own), None, None, None))
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 25)) + rng.choices(common, k=3))) for i in range(15)]
    return data, items


def items_frame(spark, items):
    return spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, rank int, score int")


@pytest.mark.parametrize("chars", [ls.BLOCK_CHARS, 2000])
@pytest.mark.parametrize("seed", [1, 2])
def test_ranking(spark, tmp_path, seed, chars):
    data, items = corpus(seed)
    got = ls.search(stored(spark, data, tmp_path / "d"), items_frame(spark, items), block_chars=chars)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(data, items)


def test_odd_rows(spark, tmp_path):
    data = rows()
    items = [(1, data[15][1]), (1, data[15][1]), (None, "the same line"), (3, None), (4, "! ."), (5, "THE the The"), (6, "nowhere")]
    got = ls.search(stored(spark, data, tmp_path / "d"), items_frame(spark, items), items_at_a_time=3)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(data, items)


def test_a_very_long_text(spark, tmp_path):
    rng = random.Random(3)
    data = [(1, sentence(rng, 50_000), None, None, None), (2, "abc abc", None, None, None), (3, "abc d", None, None, None)]
    items = [(1, "abc"), (2, " ".join(data[0][1].split()[:500]))]
    got = ls.search(stored(spark, data, tmp_path / "d"), items_frame(spark, items))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(data, items)


def test_nothing_to_find(spark, tmp_path):
    data, items = corpus(1, 3)
    docs = stored(spark, data, tmp_path / "d")
    for found in (ls.search(docs, items_frame(spark, [])), ls.search(documents(spark, []), items_frame(spark, items)),
                  ls.search(docs, items_frame(spark, [(1, None)]))):
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0


def test_pair_bounds_hold_and_are_tighter():
    """For random lists: no document gets more than the bound of its terms, and the
    bound is never above the sum of the maxima, often below."""
    rng = np.random.default_rng(5)
    tighter = 0
    for _ in range(200):
        count = int(rng.integers(2, 7))
        impacts = rng.integers(1, 50, (count, 12)) * (rng.random((count, 12)) < 0.4)
        impacts = impacts[impacts.max(axis=1) > 0]
        times = rng.integers(1, 4, len(impacts))
        order = np.argsort(times * impacts.max(axis=1), kind="stable")
        impacts, times = impacts[order], times[order]
        maxima = impacts.max(axis=1)
        joint = {}
        for a in range(len(impacts)):
            for b in range(a + 1, min(a + 3, len(impacts))):
                both = (impacts[a] > 0) & (impacts[b] > 0)
                joint[(a, b)] = int((impacts[a] + impacts[b])[both].max()) if both.any() else 0
        most = (times * maxima).tolist()
        bounds = ls.prefix_bounds(most, times.tolist(), maxima.tolist(), joint)
        for k in range(len(impacts) + 1):
            true = int((times[:k, None] * impacts[:k]).sum(axis=0).max(initial=0))
            assert true <= bounds[k] <= sum(most[:k])
            tighter += bounds[k] < sum(most[:k])
    assert tighter > 200


def test_joint_maxima():
    terms_, starts = np.array([3, 5, 9], np.int32), np.array([0, 3, 5, 6], np.int32)
    docs, impacts = np.array([0, 2, 4, 2, 4, 1], np.int32), np.array([5, 1, 7, 10, 2, 4], np.int64)
    numbers, joint = ls.joint_maxima(np.array([[3, 5], [3, 9], [4, 5]], np.int32), terms_, starts, docs, impacts)
    assert numbers.tolist() == [0] and joint.tolist() == [11]


def test_lists_below_the_score_to_beat_are_skipped():
    """A block whose lists together can't beat the best is left at once."""
    row = {"doc_ids": np.arange(4), "null_ids": np.zeros(4, np.int8), "terms": np.array([0, 1], np.int32),
           "starts": np.array([0, 2, 4], np.int32), "docs": np.array([0, 1, 2, 3], np.int32),
           "impacts": np.array([6, 5, 6, 4]), "maxima": np.array([6, 6]), "pairs": np.array([], np.int32), "joint": np.array([], np.int64)}
    block = ls._Block({k: v.tobytes() for k, v in row.items()}, np.array([[0, 1]], np.int32))
    best = ls._Best(1)
    best.add(np.array([10]), np.array([99]), np.zeros(1, np.int8))
    block.list_of = lambda term: pytest.fail("no list need be read: no document has both terms")
    block.search({0: 1, 1: 1}, {(0, 1)}, best)  # independent maxima would add up to 12
    assert best.ids.tolist() == [99]
