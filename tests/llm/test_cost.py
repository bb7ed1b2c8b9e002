"""What the operators spend: work that must not come back."""

import numpy as np
import public_tokenizers
import regex

from castledger.llm import bwt, compact_windows, cotraining, suffix_dedup, wordvalues
from castledger.llm.common import Tables
from castledger.llm.textwords import block_words, sliding_min, space_words


def test_least_of_runs():
    values = np.random.default_rng(1).integers(0, 50, 300, dtype=np.uint64)
    for width in (1, 2, 3, 31, 46, 64, 300):
        found = sliding_min(values, width)
        assert found.tolist() == [values[i:i + width].min() for i in range(len(values) - width + 1)]
    assert len(sliding_min(values, 301)) == 0


def test_suffixes_are_sorted_three_times(monkeypatch):
    symbols = np.random.default_rng(2).integers(1, 4, 3000).astype(np.uint16)
    sorts, plain = [], np.argsort
    monkeypatch.setattr(bwt.np, "argsort", lambda *a, **b: sorts.append(a) or plain(*a, **b))
    order = bwt.suffix_order(symbols, 50)
    assert len(sorts) == 3  # four before
    heads = [symbols[i:i + 50].tolist() for i in order]
    assert heads == sorted(heads)


def test_busy_anchors_look_at_their_own_fragments(monkeypatch):
    rng = np.random.default_rng(3)
    piece = rng.integers(97, 123, 60).astype(np.uint8).tobytes()
    texts = [rng.integers(97, 123, 40).astype(np.uint8).tobytes() + piece + bytes([97 + i]) * 30 for i in range(20)]
    block = suffix_dedup.Block(b"".join(texts), np.array([len(t) for t in texts]), np.arange(20), 50)

    class Compared(np.ndarray):
        scans = 0

        def __eq__(self, other):
            Compared.scans += 1
            return np.asarray(self) == other

    fragments: dict[int, set[bytes]] = {}
    for a, f, c in zip(block.which.tolist(), block.first.tolist(), block.count.tolist()):
        fragments.setdefault(a, set()).add(block.data[f:f + c + 49])
    block.which = block.which.view(Compared)
    for limit in (1, 3, 19):
        assert block.busy(limit).tolist() == [len(fragments[a]) > limit for a in range(len(block.distinct))]
    assert Compared.scans == 0  # one scan of the block for each busy anchor before


def test_words_by_the_quick_engine(monkeypatch):
    find = regex.compile(public_tokenizers.PATTERN).findall
    quick = wordvalues.finder(public_tokenizers.PATTERN)
    for c in map(chr, range(0x20000)):
        text = f"a{c}{c} 1{c}'s {c}  {c}x '{c}"
        assert quick(text) == find(text)

    class Unused:
        def findall(self, text):
            raise AssertionError("the slow engine read it")

    monkeypatch.setattr(wordvalues.regex, "compile", lambda pattern: Unused())
    assert wordvalues.finder(public_tokenizers.PATTERN)("It's 5 o’clock,  né?\n") == [
        "It", "'s", " 5", " o", "’", "clock", ",", " ", " né", "?", "\n"]


def test_pairs_are_verified_in_rounds(spark, monkeypatch):
    passage = [f"word{i}" for i in range(70)]
    docs = spark.createDataFrame(
        [(i, " ".join([f"own{i}x{k}" for k in range(60 * (i % 3))] + passage)) for i in range(24)], "doc_id long, text string")
    released = []
    monkeypatch.setattr(Tables, "release", lambda self: released.append(1))

    def found():
        return {r["doc_id"]: [tuple(p) for p in r["passages"]]
                for r in compact_windows.repeated_passages(docs).select("doc_id", "passages").collect()}

    many = found()
    assert len(released) >= 2 * compact_windows.ROUNDS  # only between steps before
    monkeypatch.setattr(compact_windows, "ROUNDS", 1)
    assert found() == many
    assert many == {i: [(60 * (i % 3), 60 * (i % 3) + 70)] if i else [] for i in range(24)}


def test_fits_free_the_drivers_memory(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "good words here" if i % 2 else "bad ### text", "web", "en", 12) for i in range(80)],
                                 "doc_id long, text string, source string, lang string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    released = []
    monkeypatch.setattr(Tables, "release", lambda self: released.append(1))
    kept = {r["doc_id"] for r in cotraining.fit(docs, labels).score(docs).where("kept").collect()}
    assert kept == set(range(1, 80, 2))
    assert len(released) == cotraining.ROUNDS + 1  # never before


def test_words_are_hashed_without_objects():
    rng = np.random.default_rng(6)
    texts = ["", " ", "a b A B ab ba", "x" * 70_000 + " y " + "x" * 70_000, "", "é Ü\x1c a\x85b\tq\n", "end", "start"]
    texts += ["".join(rng.choice(list("abAB \n"), rng.integers(0, 9))) for _ in range(300)] + ["q w " * 30_000]
    data = [t.encode() for t in texts]
    hashes, n_words = block_words(b"".join(data), np.array([len(t) for t in data]))
    words = [space_words(t) for t in texts]
    assert n_words.tolist() == [len(w) for w in words]
    known = {}
    for word, value in zip((w for own in words for w in own), hashes.tolist(), strict=True):
        assert known.setdefault(word, value) == value
    assert len(set(known.values())) == len(known)


def test_overlapping_windows_of_a_key_are_one():
    rng = np.random.default_rng(7)
    which, text, first = (rng.integers(0, n, 400) for n in (5, 4, 200))
    last = first + rng.integers(45, 60, 400)

    def held(which, text, first, last):
        return {(w, t, x) for w, t, a, b in zip(*(v.tolist() for v in (which, text, first, last))) for x in range(a, b + 1)}

    w, t, place, a, b = compact_windows.united_windows(which, text, first + 20, first, last)
    assert held(w, t, a, b) == held(which, text, first, last)
    assert len(w) < 100 and (a <= place).all() and (place <= b).all() and (np.diff(t) >= 0).all()


def test_windows_of_lines_far_apart_hold_no_stretch():
    function, first = np.array([0, 1, 2, 2]), np.array([0, 100, 120, 300])
    flags = compact_windows.agreed(400, function, first, first + 59)
    low, high = compact_windows.long_runs(flags, 30)
    assert (low.tolist(), high.tolist()) == ([120], [159])
    assert not len(compact_windows.long_runs(flags, 41)[0])


def test_a_known_passage_alone_is_no_candidate():
    """Who shares the passage, and nothing beyond, can't prolong it: joined before."""
    values = np.arange(146, dtype=np.uint32)
    passages = [{"first": 0, "end": 100 + 4}]
    starts = compact_windows.open_starts(146, [{"low": 0, "high": 145}], passages, 46, 5)
    frequency = {v: 400 if v < 100 else 2 for v in range(128)}
    able = compact_windows.able(starts, values < 128, 46, 80)
    rows = compact_windows.wanted_members(values, frequency, able, passages, 46, 80, 5)
    assert {r[1] for r in rows if r[4]} == set(range(100, 128))  # new ones
    assert all(r[5] == r[6] == 0 for r in rows if not r[4]) and any(not r[4] for r in rows)
    frequency |= {v: 9000 for v in range(100, 128)}  # now they may be left out, and any member may be next to one
    assert all(r[4] for r in compact_windows.wanted_members(values, frequency, able, passages, 46, 80, 5) if r[1] >= 60)


def test_texts_without_a_dense_stretch_are_not_chained(monkeypatch):
    monkeypatch.setattr(compact_windows, "partners", None)
    line = np.arange(20, dtype=np.uint32)
    a, b = (np.concatenate([line, np.arange(100) + n, line]).astype(np.uint32) for n in (1000, 2000))
    assert compact_windows.similar_passages(a, b, 46, 80) == []


def test_members_are_counted_in_rounds(spark, tmp_path, monkeypatch):
    """What only a document that heads no group has, found from parts of the members."""
    passage, line = [f"p{i}" for i in range(60)], [f"q{i}" for i in range(60)]
    texts = [passage[:30] + [f"own{i}x{k}" for k in range(40)] + passage[30:] for i in range(6)] + [passage + line, line + passage]
    spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    filters, bits = [], compact_windows._member_bits
    monkeypatch.setattr(compact_windows, "_member_bits", lambda members: filters.append(1) or bits(members))

    def found():
        docs = spark.read.parquet(str(tmp_path / "d"))
        return {r["doc_id"]: [tuple(p) for p in r["passages"]]
                for r in compact_windows.repeated_passages(docs).select("doc_id", "passages").collect()}

    many = found()
    assert len(filters) == compact_windows.ROUNDS + 1  # 2 before: all members at once
    monkeypatch.setattr(compact_windows, "ROUNDS", 1)
    assert found() == many and many[7] == [(0, 120)] and not many[6]
