"""Token counts under a unigram vocabulary, by dynamic programming over a trie.

The corpus's distinct pre-tokens (``wordvalues``) arrive in byte order, which
walks their trie depth first: the forward scores of the prefix that a word
shares with the one before stay on a stack, and only the nodes below are
computed. The count at a word's last node is stored for the word, joined back
and added up per document.

Null text counts as empty: 0 tokens. Rows are independent: repeated rows, equal
or null doc_ids each give a row of their own. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from castledger.llm.bpe import read_ranks
from castledger.llm.wordvalues import BLOCK_CHARS, per_word

COUNTED = pa.schema([("doc_id", pa.int64()), ("n_pretokens", pa.int64()),
                     ("n_tokens", pa.int64()), ("n_bytes", pa.int64())])
#: Pre-tokens with this many bytes in common are valued by one task.
PREFIX_BYTES = 6


def rank_costs(ranks: dict[bytes, int]) -> dict[bytes, int]:
    """Unigram costs of a ranked vocabulary: -log of a probability that falls with
    1 / (rank + 1), in whole micro-nats so that sums and ties are exact."""
    total = math.log(sum(1 / (r + 1) for r in ranks.values()))
    return {t: round(1e6 * (math.log(r + 1) + total)) for t, r in ranks.items()}


def forward_counts(words: Iterable[bytes], costs: dict[bytes, int]) -> Iterator[tuple[int, int]]:
    """(tokens, cost) of each word of an ordered stream on its cheapest path, with
    fewest tokens among equally cheap ones. Every single byte must be a token."""
    lengths: dict[int, list[int]] = {}
    for token in costs:
        lengths.setdefault(token[-1], []).append(len(token))
    lengths = {last: sorted(set(x)) for last, x in lengths.items()}
    best, last = [(0, 0)], b""
    for word in words:
        shared = 0
        for a, b in zip(word, last):
            if a != b:
                break
            shared += 1
        del best[shared + 1:]
        for end in range(shared + 1, len(word) + 1):
            options = []
            for n in lengths[word[end - 1]]:
                if n > end:
                    break
                cost = costs.get(word[end - n:end])
                if cost is not None:
                    before = best[end - n]
                    options.append((before[0] + cost, before[1] + 1))
            best.append(min(options))
        last = word
        cost, count = best[-1]
        yield count, cost


def token_counts(docs: DataFrame, costs: dict[bytes, int],
                 pattern: str = public_tokenizers.PATTERN,
                 block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, n_pretokens, n_tokens, n_bytes) of every document. The vocabulary
    is broadcast: its size does not depend on the corpus."""
    shared = docs.sparkSession.sparkContext.broadcast(costs)

    def valuer(words):
        lengths: list[int] = []

        def noted():
            for word in words:
                lengths.append(len(word))
                yield word

        for count, _ in forward_counts(noted(), shared.value):
            yield np.array([count, lengths.pop()], np.uint32)

    def shape(doc_ids, values):
        rows = [(len(v) // 2, int(v[::2].sum(dtype=np.int64)), int(v[1::2].sum(dtype=np.int64)))
                for v in values]
        return pa.table([doc_ids, *(pa.array([r[i] for r in rows], pa.int64())
                                    for i in range(3))], schema=COUNTED)

    return per_word(docs, pattern, valuer, shape,
                    "doc_id long, n_pretokens long, n_tokens long, n_bytes long",
                    PREFIX_BYTES, block_chars)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), rank_costs(ranks))
