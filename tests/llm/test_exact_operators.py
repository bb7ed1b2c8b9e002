"""Operators with one right answer, against plain Python on small tables."""

import collections
import hashlib
import re

import public_tokenizers
import pytest
import tiktoken
from corpora import rows, stored
from hypothesis import given, settings, strategies as st

from castledger.llm import bpe, bwt, decontaminate, licenses, quality_rules, suffix_dedup, tokencounts

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
ENCODING = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    return stored(spark, rows(), tmp_path_factory.mktemp("docs") / "d")


@pytest.fixture(scope="module")
def none(spark, tmp_path_factory):
    return stored(spark, [], tmp_path_factory.mktemp("none") / "d")


def same(got, want):
    key = repr
    assert sorted(got, key=key) == sorted(want, key=key)


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def alnum_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=80))
@settings(max_examples=150, deadline=None)
def test_words_encode_as_the_library_does(text):
    word = text.encode()
    if word:
        want = ENCODING._encode_single_piece(word)
        assert bpe.encode_word(word, RANKS) == want
        if word not in RANKS:
            assert bpe._heap(word, RANKS) == bpe._scan(word, RANKS) == want


@pytest.mark.parametrize("block_chars", [bpe.BLOCK_CHARS, 500])
def test_encoding_and_round_trip(docs, block_chars):
    got = bpe.decode(bpe.encode(docs, PATH, block_chars=block_chars), PATH).collect()
    same([(r.doc_id, r.ids, bytes(r.bytes)) for r in got],
         [(r[0], ENCODING.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in rows()])


def test_token_counts(docs, none):
    costs = tokencounts.rank_costs(RANKS)

    def best(word):
        table = [(0, 0)]
        for end in range(1, len(word) + 1):
            table.append(min((table[i][0] + costs[word[i:end]], table[i][1] + 1)
                             for i in range(max(0, end - 130), end) if word[i:end] in costs))
        return table[-1][1]

    got = tokencounts.token_counts(docs, costs, block_chars=700).collect()
    want = []
    for doc, text, *_ in rows():
        words = [m.encode() for m in re.compile("x").findall("")] + [
            w.encode() for w in __import__("regex").findall(public_tokenizers.PATTERN, text or "")]
        want.append((doc, len(words), sum(map(best, words)), len((text or "").encode())))
    same([tuple(r) for r in got], want)
    assert tokencounts.token_counts(none, costs).count() == 0


def test_quality_rules(docs, none):
    def measures(text):
        words = space_words(text)
        windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        often = collections.Counter(windows)
        hit = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 3)}
        lines = [x for x in (text or "").split("\n") if space_words(x)]
        return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
                len(lines) - len(set(lines)), len(hit),
                len(words) < 50 or 100 * len(hit) > 50 * len(words))

    got = quality_rules.quality_rules(docs).collect()
    same([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
          for r in got], [(r[0], *measures(r[1])) for r in rows()])
    assert all(not r.kept for r in got if r.base_failed) and any(r.kept for r in got)
    assert quality_rules.quality_rules(none).count() == 0


def test_rule_order_changes_no_verdict(docs):
    rules = quality_rules.default_rules()
    a, b = (quality_rules.with_measures(docs).select("doc_id", quality_rules.cascade(r).isNull().alias("k")).collect()
            for r in (rules, rules[::-1]))
    same(a, b)
    assert {r.name for r in quality_rules.order_rules(docs, rules)} == {r.name for r in rules}


@given(st.lists(st.text("ab", min_size=4, max_size=30), min_size=1, max_size=8), st.data())
@settings(max_examples=80, deadline=None)
def test_least_owner(texts, data):
    import numpy as np
    texts = [t.encode() for t in texts]
    owners = np.array(data.draw(st.lists(st.integers(0, 9), min_size=len(texts), max_size=len(texts))))
    length = 4
    best = {}
    for t, o in zip(texts, owners):
        for i in range(len(t) - length + 1):
            best[t[i:i + length]] = min(best.get(t[i:i + length], 99), o)
    want = [best[t[i:i + length]] for t in texts for i in range(len(t) - length + 1)]
    assert bwt.least_owner(texts, owners, length).tolist() == want


def without_repeats(data, length=50):
    first = {}
    for doc, text, *_ in data:
        body = (text or "").encode()
        if doc is not None:
            for i in range(len(body) - length + 1):
                first[body[i:i + length]] = min(first.get(body[i:i + length], doc), doc)
    out = []
    for doc, text, *_ in data:
        body = (text or "").encode()
        gone = [False] * len(body)
        for i in range(len(body) - length + 1):
            if doc is not None and first[body[i:i + length]] < doc:
                gone[i:i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(body), sum(gone), spans, bytes(b for b, g in zip(body, gone) if not g)))
    return out


@pytest.mark.parametrize("limits", [{}, {"block_chars": 900, "chunk": 200, "busy_fragments": 1, "busy_blocks": 2}])
def test_suffix_dedup(docs, none, limits):
    same([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
          for r in suffix_dedup.suffix_dedup(docs, **limits).collect()], without_repeats(rows()))
    assert suffix_dedup.suffix_dedup(none).count() == 0


def test_decontamination(spark, docs, none, tmp_path):
    own = [r[1] for r in rows() if r[1] and len(r[1].split()) > 40]
    items = [(1, " ".join(own[0].split()[5:30])), (2, "one two"), (3, None), (None, own[1]), (4, ""),
             (5, " ".join(own[0].split()[5:30])), (6, "All rights"), (7, own[-1].upper()), (2, "one two")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")

    windows = collections.defaultdict(set)
    for item, text in items:
        words = alnum_words(text)
        n = min(10, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[i:i + n])].add(item)
    want = []
    for doc, text, *_ in rows():
        words, hit, found = alnum_words(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                if tuple(words[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(words[i:i + n])]
        want.append((doc, len(words), len(hit), sorted(str(i) for i in found if i is not None)))
    for bits in (decontaminate.FILTER_BITS, 8):  # a filter that lets nearly everything pass
        got = decontaminate.decontaminate(docs, benchmark, filter_bits=bits).collect()
        same([(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got], want)
    assert decontaminate.decontaminate(none, benchmark).count() == 0
    assert {r.n_hit for r in decontaminate.decontaminate(docs, benchmark.limit(0)).collect()} == {0}


def test_licenses(docs, none):
    data = rows()
    blocks = collections.Counter()
    want = []
    for doc, text, *_ in data:
        words = alnum_words(text)
        places = {label: [i for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
                  for p, label in licenses.PHRASES.items()}
        labels, score = {x for x, found in places.items() if found}, 0.0
        starts = sorted(i for found in places.values() for i in found)
        base = sorted(labels)
        for label, template in licenses.TEMPLATES.items():
            tokens, n = set(alnum_words(template)), len(alnum_words(template))
            for k in range(0, max(len(words), 1), n):
                share = len(tokens & set(words[k:k + 2 * n])) / len(tokens)
                if 100 * len(tokens & set(words[k:k + 2 * n])) >= licenses.PERCENT * len(tokens):
                    labels.add(label)
                    score = max(score, share)
                    blocks[label] += 1
        want.append((doc, len(words), len(starts), starts[0] if starts else None, starts[-1] if starts else None,
                     base, sorted(labels), score))
    got = licenses.scan(docs).collect()
    same([tuple(r)[:-1] for r in got], want)
    assert collections.Counter(b.label for r in got for b in r.blocks) == blocks and blocks
    assert licenses.scan(none).count() == 0


def test_digest_of_empty_text(spark, tmp_path):
    docs = stored(spark, [(1, None, None, None, None)], tmp_path / "d")
    row = bpe.digest(bpe.decode(bpe.encode(docs, PATH), PATH), "doc_id").first()
    nothing = hashlib.sha256(b"").hexdigest()
    assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (0, nothing, nothing)
