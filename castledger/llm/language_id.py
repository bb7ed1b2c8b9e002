"""Language identification by error-correcting output codes.

Each language gets a codeword of bits. For each bit, one binary classifier over
hashed character n-grams learns to tell the languages with a 1 from those with a
0: weights are smoothed log-odds of the n-gram counts, the output is their mean
over the text. Decoding weighs the loss of each bit by how well its classifier
does on each language and takes the nearest codeword; two codewords about as near
flag the text as ambiguous.

Predictions read the text only. Null text, or text without a letter, is ``und``
with score 0, as is everything when no labelled row is there to learn from. Rows
are independent; a null doc_id is neither held out nor learned from. Extra
columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BUCKET_BITS = 15
ORDERS = (2, 3)
#: Most labelled rows to learn from; of more, those with the least hashed ids.
TRAIN_ROWS = 20_000
#: Up to so many languages all distinct bits are used, beyond that random ones.
EXHAUSTIVE = 7
SHARPNESS = 8.0
#: Decoding losses closer than this are ambiguous.
AMBIGUOUS = 0.02
UNKNOWN = "und"

PREDICTED = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()),
                       ("score", pa.float64()), ("ambiguous", pa.bool_())])


def ngrams(text: str) -> np.ndarray:
    """Buckets of the character n-grams; all but letters counts as one space."""
    clean = " " + regex.sub(r"[\W\d_]+", " ", text.lower()).strip() + " "
    codes = np.frombuffer(clean.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    found = []
    for n in ORDERS:
        total = np.full(max(len(codes) - n + 1, 0), np.uint64(n))
        for i in range(n):
            total = (total + codes[i:i + len(total)]) * np.uint64(0x9E3779B97F4A7C15)
            total ^= total >> np.uint64(29)
        found.append((total * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BUCKET_BITS))
    return np.concatenate(found).astype(np.int64)


def has_letter(text: str | None) -> bool:
    return bool(text) and regex.search(r"\p{L}", text) is not None


def codewords(languages: int) -> np.ndarray:
    """A row of +1 and -1 for each language. All ways to part few languages in
    two; for many, the random code of 100 with the largest least distance."""
    if languages <= EXHAUSTIVE:
        bits = [b for b in itertools.product((1, -1), repeat=languages) if b[0] == 1 and -1 in b]
        return np.array(bits, np.int8).reshape(-1, languages).T
    drawn = np.random.default_rng(5)
    width = int(np.ceil(10 * np.log2(languages)))

    def least(code: np.ndarray) -> int:
        same = code.astype(int) @ code.T.astype(int)
        columns = np.abs(code.sum(axis=0)) < languages
        return -1 if not columns.all() else width - int((same - 2 * width * np.eye(languages)).max())
    return max((drawn.choice(np.array([1, -1], np.int8), (languages, width)) for _ in range(100)), key=least)


def held_out() -> Column:
    """Every fifth document by checksum is never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))


class Model:
    """Languages, their codewords, n-gram weights per bit, loss weights."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.code = codewords(len(languages)) if languages else np.zeros((0, 0), np.int8)
        smooth = 0.5
        weights = []
        for bit in self.code.T:
            one, zero = (counts[bit == side].sum(axis=0) + smooth for side in (1, -1))
            weights.append(np.log(one / one.sum()) - np.log(zero / zero.sum()))
        self.weights = np.array(weights, np.float32).reshape(len(weights), 1 << BUCKET_BITS).T.copy()
        self.trust = np.ones(self.code.shape)

    def margins(self, text: str) -> np.ndarray:
        return self.weights[ngrams(text)].mean(axis=0, dtype=np.float64)

    def decode(self, text: str | None) -> tuple[str, float, bool]:
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, False
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        loss = (self.trust * np.exp(-np.clip(self.code * self.margins(text), -30, 30))).sum(axis=1)
        near = np.argsort(loss, kind="stable")
        likely = np.exp(-SHARPNESS * (loss - loss[near[0]]))
        return (self.languages[near[0]], float(1 / likely.sum()),
                bool(loss[near[1]] - loss[near[0]] < AMBIGUOUS))


def fit(labelled: DataFrame) -> Model:
    """Learn from (text, lang). Counts are summed on executors; what reaches the
    driver has one number per language and bucket at most."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals: dict[str, np.ndarray] = {}
            for text, lang in zip(*(c.to_pylist() for c in batch.columns)):
                if has_letter(text):
                    found = np.bincount(ngrams(text), minlength=1 << BUCKET_BITS)
                    totals[lang] = totals.get(lang, 0) + found
            for lang, total in totals.items():
                used = np.flatnonzero(total)
                yield pa.record_batch([pa.array([lang] * len(used), pa.string()), pa.array(used),
                                       pa.array(total[used])], names=["lang", "bucket", "n"])

    rows = (labelled.select("text", "lang").mapInArrow(count, "lang string, bucket long, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    languages = sorted(set(rows["lang"]))
    counts = np.zeros((len(languages), 1 << BUCKET_BITS))
    counts[rows["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(int),
           rows["bucket"].to_numpy(int)] = rows["n"].to_numpy()
    model = Model(languages, counts)
    if len(languages) > 1:
        model.trust = _trust(labelled, model)
    return model


def _trust(labelled: DataFrame, model: Model) -> np.ndarray:
    """How often each bit is right for each language, each language's sum being 1."""
    shared = labelled.sparkSession.sparkContext.broadcast(vars(model))
    place = {x: i for i, x in enumerate(model.languages)}

    def right(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _restored(shared.value)
        for batch in batches:
            found = [(lang, bit, int(agrees)) for text, lang in zip(*(c.to_pylist() for c in batch.columns))
                     if has_letter(text)
                     for bit, agrees in enumerate(known.code[place[lang]] * known.margins(text) > 0)]
            yield pa.record_batch([pa.array([f[i] for f in found], t) for i, t in enumerate(
                (pa.string(), pa.int64(), pa.int64()))], names=["lang", "bit", "agrees"])

    rows = (labelled.select("text", "lang").mapInArrow(right, "lang string, bit long, agrees long")
            .groupBy("lang", "bit").agg(F.avg("agrees").alias("share")).collect())
    trust = np.zeros(model.code.shape)
    for r in rows:
        trust[place[r["lang"]], r["bit"]] = r["share"]
    trust = np.maximum(trust, 1e-3)
    return trust / trust.sum(axis=1, keepdims=True)


def _restored(state: dict) -> Model:
    model = Model.__new__(Model)
    vars(model).update(state)
    return model


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _restored(shared.value)
        for batch in batches:
            found = [known.decode(text.as_py()) for text in batch.column(1)]
            yield pa.record_batch([batch.column(0), *(pa.array([f[i] for f in found], t) for i, t in enumerate(
                (pa.string(), pa.float64(), pa.bool_())))], schema=PREDICTED)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
                       ).mapInArrow(run, "doc_id long, lang_pred string, score double, ambiguous boolean")


def bounded_sample(labelled: DataFrame, rows: int) -> DataFrame:
    """All rows if they are ``rows`` at most; of more, about so many by hashed id."""
    share = min(1.0, rows / max(labelled.count(), 1))
    return labelled.where((F.xxhash64("doc_id", F.lit("sample")) / F.lit(2.0**64) + 0.5) < share)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labelled = docs.where("lang is not null and doc_id is not null").where(~held_out())
    model = fit(bounded_sample(labelled.select("doc_id", "text", "lang"), TRAIN_ROWS))
    return predict(docs, model).withColumn("held_out", held_out()).select(
        "doc_id", "held_out", "lang_pred", "score", "ambiguous")
