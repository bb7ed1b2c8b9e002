"""Near copies, passages, languages, quality and the pipeline."""

import random
import re

import numpy as np
import pytest
from corpora import documents, rows, sentence, stored, texts

import corpus_pipeline
from castledger.llm import compact_windows, cotraining, language_id, minhash
from castledger.llm.common import Tables
from castledger.llm.components import components


@pytest.fixture(scope="module")
def none(spark, tmp_path_factory):
    return stored(spark, [], tmp_path_factory.mktemp("none") / "d")


def words_of(text):
    return [w.translate({i: i + 32 for i in range(65, 91)}) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]


def near_groups(data, size=3, percent=85):
    sets = []
    for doc, text, *_ in data:
        words = words_of(text)
        n = min(size, len(words))
        sets.append((doc, {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()))
    parent = {d: d for d, _ in sets if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and a is not None and b is not None and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return [(d, len(s), None if d is None else root(d), d is None or d == root(d)) for d, s in sets]


def chained(seed):
    """A family whose members differ step by step, around the threshold."""
    rng = random.Random(seed)
    words, out = sentence(rng, 120).split(), []
    for i in range(40):
        words = words[:]
        for _ in range(rng.choice([1, 2, 3, 6])):
            words[rng.randrange(len(words))] = sentence(rng, 1)
        out.append((i * 3 % 41, " ".join(words), None, None, None))
    return out


@pytest.mark.parametrize("data", [rows(), chained(1), chained(2)], ids=["mixed", "chain1", "chain2"])
def test_near_duplicates(spark, tmp_path, data):
    got = minhash.near_duplicates(stored(spark, data, tmp_path / "d")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(near_groups(data), key=repr)


def test_near_duplicates_of_nothing(none):
    assert minhash.near_duplicates(none).count() == 0


def test_components_of_a_path_and_a_loop(spark):
    edges = [(i, i + 1) for i in range(30)] + [(50, 50), (61, 60), (60, 61)]
    frame = spark.createDataFrame(edges, "u long, v long")
    found = {r.vertex: r.component for r in components(frame, Tables(spark, "test")).collect()}
    assert found == {**{i: 0 for i in range(1, 31)}, 61: 60}


def test_compact_windows_cover_every_stretch_once():
    rng = np.random.default_rng(3)
    sizes = np.array([30, 3, 25])
    hashes = rng.integers(0, 12, 58).astype(np.uint64) << np.uint64(20)
    starts = np.array([0, 30, 33])
    first, place, last = compact_windows.compact_windows(hashes, starts, sizes, 5)
    for s, n in zip(starts, sizes):
        for i in range(s, s + n):
            for j in range(i + 4, s + n):
                own = [(f, p, e) for f, p, e in zip(first, place, last) if f <= i <= p <= j <= e]
                assert len(own) == 1 and own[0][1] == i + int(np.argmin(hashes[i:j + 1]))


@pytest.mark.parametrize("block_chars", [compact_windows.BLOCK_CHARS, 1500])
def test_passages(spark, tmp_path, none, block_chars):
    data = rows()
    docs = stored(spark, data, tmp_path / "d")
    found = compact_windows.repeated_passages(docs, block_chars=block_chars)
    covered = {}
    for r in found.collect():
        for p in r.passages:
            covered.setdefault(r.doc_id, set()).update(range(p["first"], p["end"]))
    first = {}
    for doc, text, *_ in data:
        words = words_of(text)
        for i in range(len(words) - 49):
            if doc is not None:
                key = tuple(words[i:i + 50])
                first[key] = min(first.get(key, doc), doc)
    for doc, text, *_ in data:
        words = words_of(text)
        for i in range(len(words) - 49):
            if doc is not None and first[tuple(words[i:i + 50])] < doc:
                assert set(range(i, i + 50)) <= covered[doc]
    unlike = {r[0] for r in data[-27:-3]}  # random texts share nothing
    assert not unlike & set(covered) and None not in covered
    cut = compact_windows.remove_passages(docs, found)
    assert cut.columns == docs.columns and cut.count() == len(data)
    assert compact_windows.repeated_passages(none).count() == 0


def test_a_passage_with_one_changed_word_is_found(spark, tmp_path):
    rng = random.Random(9)
    passage = sentence(rng, 120).split()
    changed = passage[:60] + ["changed"] + passage[61:]
    data = [(1, sentence(rng, 30) + " " + " ".join(passage), None, None, None),
            (2, " ".join(changed) + "\n" + sentence(rng, 20), None, None, None)]
    got = {r.doc_id: r.passages for r in compact_windows.repeated_passages(stored(spark, data, tmp_path / "d")).collect()}
    assert got[1] == [] and [tuple(p) for p in got[2]] == [(0, 120)]


def test_words_cut_with_their_space():
    text = " a b\nc  d"
    assert compact_windows.without(text, [{"first": 1, "end": 3}]) == " a d"
    assert compact_windows.without(text, [{"first": 0, "end": 4}]) == " "


LETTERS = {"aa": "abcde", "bb": "fghij", "cc": "klmno"}


def spoken(n=90):
    rng = random.Random(4)
    return [(i, sentence(rng, 40, LETTERS[lang]), lang, None, None) for i in range(n) for lang in [list(LETTERS)[i % 3]]]


def test_languages(spark, none):
    data = [*spoken(), (500, None, "aa", None, None), (501, "12 !", "bb", None, None), (None, "abcde abc", None, None, None)]
    docs = documents(spark, data)
    model = language_id.fit(docs.where("lang is not null").where(~language_id.held_out()))
    got = language_id.predict(docs, model).collect()
    assert model.code.shape == (3, 3) and len(got) == len(data)
    assert all(r.lang_pred == list(LETTERS)[r.doc_id % 3] for r in got if r.doc_id is not None and r.doc_id < 500)
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in got if r.doc_id in (500, 501))
    assert all(0 <= r.score <= 1 for r in got)
    assert language_id.predict(none, model).count() == 0


def test_languages_without_labels(spark, none):
    model = language_id.fit(none)
    assert {r.lang_pred for r in language_id.predict(documents(spark, spoken(3)), model).collect()} == {"und"}
    one = language_id.fit(documents(spark, [s for s in spoken() if s[2] == "aa"]))
    assert {r.lang_pred for r in language_id.predict(documents(spark, spoken(3)), one).collect()} == {"aa"}


@pytest.mark.parametrize("languages", [2, 4, 7, 12])
def test_codewords_differ(languages):
    code = language_id.codewords(languages)
    assert len({tuple(c) for c in code.tolist()}) == languages
    assert all(-1 in column and 1 in column for column in code.T)


def graded(n=400):
    rng = random.Random(6)
    docs, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        docs.append((i, sentence(rng, 60) + (" vile" if bad else "") + " " + sentence(rng, 20), "en", f"s{i % 5}", 400))
        labels.append((i, 1, int(bad)))
    return docs, labels


def test_cotraining(spark, none, tmp_path):
    data, labels = graded()
    frame = spark.createDataFrame(labels[:300] + [(0, 1, 0), (None, 1, 1), (5000, 0, None), (7, None, None)],
                                  "doc_id long, quality int, toxic int")
    docs = stored(spark, [*data, (None, None, None, None, None)], tmp_path / "d")
    model = cotraining.fit(docs, frame)
    got = model.score(docs).collect()
    assert len(got) == len(data) + 1
    wrong = [r.doc_id for r in got if r.doc_id is not None and r.kept == (r.doc_id % 3 == 0)]
    assert len(wrong) <= len(data) // 50
    assert model.score(none).count() == 0


def test_cotraining_without_two_kinds_of_labels(spark, none):
    docs = documents(spark, graded(5)[0])
    for labels in ([], [(1, 1, 0)], [(1, 0, 0), (2, 0, 0)]):
        model = cotraining.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
        assert all(r.kept for r in model.score(docs).collect())


def test_pipeline_stages(spark, folder, tmp_path):
    """Each stage against what its own input asks for, on the smallest test tables."""
    tables = Tables(spark, "test")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = tables.keep(stage(spark, docs, folder))
        seen[name] = (before.collect(), docs.collect())
        if name != "byte_bpe":
            assert docs.columns == names
    before, after = seen["quality"]
    assert 0 < len(after) < len(before) and {tuple(r) for r in after} <= {tuple(r) for r in before}

    before, after = seen["near_dedup"]
    kept = {d for d, _, _, keep in near_groups([(r.doc_id, r.text) for r in before], 5, 80) if keep}
    assert {r.doc_id for r in after} == kept

    before, after = seen["substring_dedup"]
    cut = {r.doc_id: words_of(r.text) for r in after}
    assert set(cut) == {r.doc_id for r in before}
    first, phrases, removed = {}, set(), 0
    for r in sorted(before, key=lambda r: r.doc_id):
        words, repeated = words_of(r.text), set()
        for i in range(len(words) - 49):
            if first.setdefault(tuple(words[i:i + 50]), r.doc_id) < r.doc_id:
                repeated |= set(range(i, i + 50))
        assert len(cut[r.doc_id]) <= len(words) - len(repeated)
        own = {tuple(words[i:i + 5]) for i in range(len(words) - 4)}
        if not own & phrases:  # nothing in common with earlier documents
            assert cut[r.doc_id] == words
        phrases |= own
        removed += len(words) - len(cut[r.doc_id])
    assert removed > 0

    before, after = seen["decontamination"]
    def items(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))

    windows = {}
    for row in spark.read.parquet(f"{folder}/benchmark.parquet").collect():
        words = items(row.text)
        for i in range(max(len(words) - 9, 1 if words else 0)):
            windows.setdefault(min(10, len(words)), set()).add(tuple(words[i:i + 10]))
    clean = {r.doc_id for r in before if not any(
        tuple(w[i:i + n]) in held for w in [items(r.text)] for n, held in windows.items() for i in range(len(w) - n + 1))}
    assert {r.doc_id for r in after} == clean

    before, after = seen["byte_bpe"]
    assert {r.doc_id for r in before} == {r.doc_id for r in after}
    assert corpus_pipeline.run(spark, folder).count() == len(after)


def test_texts_cover_the_odd_cases():
    assert None in texts() and "" in texts() and max(len(t or "") for t in texts()) >= 3000
