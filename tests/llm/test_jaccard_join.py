"""The grouped prefix join against all pairs of sets."""

import random

import numpy as np
import pytest
from corpora import documents, rows, sentence, stored
from test_similarity import chained, near_groups

from castledger.llm import jaccard_join as jj


def family(seed, members, edits):
    """Copies of one text, each with words of its own, over few partitions."""
    rng = random.Random(seed)
    base, out = sentence(rng, 90).split(), []
    for i in range(members):
        words = base[:]
        for _ in range(rng.choice(edits)):
            words[rng.randrange(len(words))] = sentence(rng, 1)
        out.append((i, " ".join(words), None, None, None))
    return out


def common_prefix(seed):
    """Sets with the same rarest shingles and the same size: twins that differ only
    in frequent ones, so that groups have several members."""
    rng = random.Random(seed)
    rare, out = sentence(rng, 30), []
    tails = [sentence(rng, 12) for _ in range(6)]
    for i in range(24):
        out.append((i, f"{rare} {tails[i % 6]} {tails[(i // 6) % 6]}", None, None, None))
    return out


@pytest.mark.parametrize("data", [rows(), chained(1), chained(2), family(3, 60, [1, 2, 3, 4]), common_prefix(4)],
                         ids=["mixed", "chain1", "chain2", "family", "prefix"])
def test_components(spark, tmp_path, data):
    got = jj.jaccard_join(stored(spark, data, tmp_path / "d")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((r[:3] for r in near_groups(data, 5, 80)), key=repr)


def test_small_blocks_give_the_same(spark, tmp_path):
    data = rows()
    docs = stored(spark, data, tmp_path / "d")
    assert sorted(map(tuple, jj.jaccard_join(docs, block_chars=700).collect()), key=repr) == sorted(
        (r[:3] for r in near_groups(data, 5, 80)), key=repr)


@pytest.mark.parametrize("percent", [60, 100])
def test_other_thresholds(spark, tmp_path, percent):
    data = family(5, 25, [1, 2, 4])
    got = jj.jaccard_join(stored(spark, data, tmp_path / "d"), size=3, percent=percent).collect()
    assert sorted(map(tuple, got)) == sorted(r[:3] for r in near_groups(data, 3, percent))


def test_nothing_and_only_empty_texts(spark, tmp_path):
    assert jj.jaccard_join(documents(spark, [])).count() == 0
    data = [(1, None, None, None, None), (2, "", None, None, None), (None, " \n", None, None, None)]
    got = jj.jaccard_join(stored(spark, data, tmp_path / "d")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, 0, 1), (2, 0, 2), (None, 0, None)], key=repr)


def test_a_very_long_text_and_its_near_copy(spark, tmp_path):
    rng = random.Random(6)
    words = sentence(rng, 60_000).split()
    changed = words[:]
    for i in range(0, len(words), 100):
        changed[i] = "changed"
    data = [(5, " ".join(words), None, None, None), (9, " ".join(changed), None, None, None),
            (11, " ".join(words[:40_000]), None, None, None)]
    got = {r.doc_id: r.component_id for r in jj.jaccard_join(stored(spark, data, tmp_path / "d")).collect()}
    assert got == {5: 5, 9: 5, 11: 11}


def test_a_family_is_not_compared_pair_by_pair(spark, tmp_path, monkeypatch):
    compared = []
    verified = jj.prefix_groups.verified

    def counting(pairs, sets, percent):
        compared.append(pairs.count())
        return verified(pairs, sets, percent)

    monkeypatch.setattr(jj.prefix_groups, "verified", counting)
    data = family(7, 300, [0, 1, 2])
    jj.jaccard_join(stored(spark, data, tmp_path / "d")).collect()
    assert 0 < sum(compared) < 10 * 300


def test_packed_keys_come_back():
    rng = np.random.default_rng(1)
    keys = np.sort(rng.integers(0, 1 << jj.KEY_BITS, 1000, dtype=np.uint64))
    numbers = rng.integers(0, 1 << 32, 1000, dtype=np.uint64)
    got = jj._unpack(jj._pack(keys, numbers))
    assert (got[0] == keys).all() and (got[1] == numbers).all()


def test_members_with_the_same_prefix_form_a_group(spark):
    """Shingles 0 to 9 are rarest and in the first three sets; their others are
    frequent and differ. The last sets have shingles of their own."""
    sets = [[*range(10), *range(100 + 10 * i, 120 + 10 * i)] for i in range(3)]
    sets += [[1000 + i, *range(100, 140)] for i in range(20)]
    frame = spark.createDataFrame([(str(i).encode(), s) for i, s in enumerate(sets)], "set_id binary, members array<long>")
    groups, members = jj.prefix_groups.grouped(jj.prefix_groups.prefixes(frame, 80))
    group = {r.set_id: r.group for r in members.collect()}
    assert group[b"0"] == group[b"1"] == group[b"2"] == b"0"
    assert len(set(group.values())) == groups.count() == len(group) - 2
