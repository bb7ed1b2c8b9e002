"""Quality classifier by co-training of a text view and a metadata view.

A document is good if its label says quality 1 and not toxic. One logistic
regression reads the text (hashed words, symbols and shape), another the page
metadata (source, language, length). In each round both are fitted, and what one
of them is sure of in a pool of unlabelled documents becomes a label for the
other. At last each view is calibrated on labelled rows that neither has seen,
their log-odds are added (the prior counts once), and all documents are scored.

Fitting reads bounded samples, ``TRAIN_ROWS`` labelled and ``POOL_ROWS``
unlabelled documents by hashed id; scoring covers every row in one pass without
a shuffle.

Null text or metadata is a value of its own. Labels that repeat a doc_id are
bad if any of them is; a null quality labels nothing unless the row is toxic.
Without labels of both kinds nothing can be learned and every document gets the
share of good labels (1 if there is none). Rows are independent: repeated rows
and null doc_ids get a row each. Extra columns stay.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from castledger.llm.common import Tables, unused

TRAIN_ROWS, POOL_ROWS = 10_000, 5_000
ROUNDS = 2
#: A view labels for the other what it gives at least this probability.
SURE = 0.98
TEXT_FEATURES, META_FEATURES = 1 << 16, 1 << 10
#: Tasks that sum gradients: the samples are bounded, and each task sends as many numbers as there are features.
FIT_TASKS = 4
KEEP_AT = 0.6
#: Lengths of the word beginnings that are features.
STEMS = (3, 4, 5, 6, 7)
WORD, SYMBOLS = re.compile(r"[^\W_]+"), re.compile(r"[!#$%&*|<>@]{1,3}")


def _bucket(kind: str, value: str, size: int) -> int:
    return zlib.crc32(f"{kind}:{value}".encode("utf-8", "surrogatepass")) % size


def _word_buckets(word: str) -> list[int]:
    """A word and its beginnings."""
    return [_bucket("word", word, TEXT_FEATURES),
            *(_bucket("stem", word[:n], TEXT_FEATURES) for n in STEMS if len(word) > n)]


def _shape_buckets(text: str, words: list[str], distinct: int) -> list[int]:
    """Symbols that occur, and shares of capitals, symbols and distinct words."""
    symbols = SYMBOLS.findall(text)
    shares = {"capitals": sum(map(str.isupper, text)) / max(len(text), 1),
              "symbols": 2 * len("".join(symbols)) / max(len(text), 1),
              "distinct": distinct / max(len(words), 1)}
    return [*(_bucket("symbol", x, TEXT_FEATURES) for x in sorted(set(symbols))),
            *(_bucket(name, str(int(10 * share)), TEXT_FEATURES) for name, share in shares.items())]


def text_buckets(text: str | None) -> list[int]:
    """Features of the text view; one that stands for several words repeats."""
    text = text or ""
    words = WORD.findall(text.lower())
    distinct = set(words)
    return [b for w in distinct for b in _word_buckets(w)] + _shape_buckets(text, words, len(distinct))


def meta_buckets(source: str | None, lang: str | None, n_chars: int | None) -> list[int]:
    size = "?" if n_chars is None else str(max(n_chars, 0).bit_length())
    return [_bucket("source", str(source), META_FEATURES), _bucket("lang", str(lang), META_FEATURES),
            _bucket("size", size, META_FEATURES)]


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*(docs[c].cast(t).alias(c) for c, t in (
        ("doc_id", "long"), ("text", "string"), ("source", "string"), ("lang", "string"), ("n_chars", "long"))))


def with_views(docs: DataFrame) -> DataFrame:
    """Both views as sparse vectors, beside doc_id. For samples."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.record_batch([
                    pa.array([row["doc_id"]], pa.int64()),
                    pa.array([text_buckets(row["text"])], pa.list_(pa.int32())),
                    pa.array([meta_buckets(row["source"], row["lang"], row["n_chars"])], pa.list_(pa.int32()))],
                    names=["doc_id", "text_view", "meta_view"])

    def vector(size: int):
        return F.udf(lambda buckets: Vectors.sparse(size, {int(k): float(v) for k, v in Counter(buckets).items()}),
                     VectorUDT())

    return _columns(docs).mapInArrow(run, "doc_id long, text_view array<int>, meta_view array<int>").select(
        "doc_id", vector(TEXT_FEATURES)("text_view").alias("text_view"),
        vector(META_FEATURES)("meta_view").alias("meta_view"))


class _WordWeights(dict):
    """Weight of a word with its beginnings, added up once while remembered."""

    LIMIT = 300_000

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = total = float(self.weights[_word_buckets(word)].sum())
        return total


def with_odds(docs: DataFrame, text: np.ndarray, meta: np.ndarray) -> DataFrame:
    """Every document with text_odds and meta_odds, weighted sums of its features.
    The weights have a fixed number of features and are broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast((text, meta))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_weights, meta_weights = shared.value
        known = _WordWeights(text_weights)
        for batch in batches:
            odds = []
            for text, source, lang, n_chars in zip(*(batch.column(c) for c in ("text", "source", "lang", "n_chars"))):
                text = text.as_py() or ""
                words = WORD.findall(text.lower())
                distinct = set(words)
                odds.append((math.fsum(map(known.__getitem__, distinct))
                             + float(text_weights[_shape_buckets(text, words, len(distinct))].sum()),
                             float(meta_weights[meta_buckets(source.as_py(), lang.as_py(), n_chars.as_py())].sum())))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array([o[i] for o in odds], pa.float64()) for i in (0, 1))],
                [*batch.schema.names, "text_odds", "meta_odds"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("text_odds", T.DoubleType()),
                                              T.StructField("meta_odds", T.DoubleType())]))


def good_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, good): 1 or 0 once for each labelled document."""
    bad = (F.col("toxic") == 1) | (F.col("quality") == 0)
    value = F.when(F.coalesce(bad, F.lit(False)), 0.0).when(F.col("quality") == 1, 1.0)
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"), value.alias("good"))
            .where("good is not null and doc_id is not null").groupBy("doc_id").agg(F.min("good").alias("good")))


def _draw(share: float, salt: str) -> Column:
    return (F.xxhash64("doc_id", F.lit(salt)) / F.lit(2.0**64) + 0.5) < share


@dataclass
class View:
    """A fitted view and the line that turns its log-odds into calibrated ones."""
    name: str
    model: LogisticRegressionModel
    slope: float = 1.0
    offset: float = 0.0

    def score(self, rows: DataFrame) -> DataFrame:
        model = self.model
        model.setFeaturesCol(f"{self.name}_view").setRawPredictionCol("raw").setProbabilityCol(
            "probability").setPredictionCol("prediction")
        scored = model.transform(rows)
        return scored.withColumn(
            f"{self.name}_odds", self.slope * vector_to_array("raw")[1] + self.offset
        ).drop("raw", "probability", "prediction")


def _fit(rows: DataFrame, name: str, weight: float = 5e-4) -> View:
    """Sparse weights: of very many words few tell anything."""
    regression = LogisticRegression(featuresCol=f"{name}_view", labelCol="good", maxIter=25, regParam=weight,
                                    elasticNetParam=1.0, standardization=False)
    return View(name, regression.fit(rows.select(f"{name}_view", "good").coalesce(FIT_TASKS)))


def _calibrate(view: View, rows: DataFrame) -> View:
    """Fit good ~ odds on labelled rows that the view has not seen."""
    scored = VectorAssembler(inputCols=[f"{view.name}_odds"], outputCol="odds_view").transform(view.score(rows))
    line = _fit(scored, "odds").model
    return View(view.name, view.model, float(line.coefficients[0]), float(line.intercept))


@dataclass
class Classifier:
    views: list[View]
    prior: float  # log-odds of good

    def score(self, docs: DataFrame) -> DataFrame:
        """Every document with score, text_score, meta_score, kept; columns of
        those names are replaced."""
        added = ("score", "text_score", "meta_score", "kept", "text_odds", "meta_odds")
        docs = docs.drop(*added)
        if not self.views:
            constant = F.lit(round(1 / (1 + math.exp(-self.prior)), 6))
            return docs.withColumns({c: constant for c in added[:3]}).withColumn("kept", F.lit(True))

        def probability(odds: Column) -> Column:
            return F.round(1 / (1 + F.exp(-odds)), 6)

        rows = with_odds(docs, *(v.model.coefficients.toArray() for v in self.views))
        text, meta = (v.slope * (F.col(f"{v.name}_odds") + v.model.intercept) + v.offset for v in self.views)
        return rows.select(*docs.columns, probability(text + meta - self.prior).alias("score"),
                           probability(text).alias("text_score"), probability(meta).alias("meta_score")
                           ).withColumn("kept", F.col("score") >= KEEP_AT)


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, pool_rows: int = POOL_ROWS,
        rounds: int = ROUNDS) -> Classifier:
    tables = Tables(docs.sparkSession, "cotraining")
    known = good_labels(labels)
    drawn = known.where(_draw(min(1.0, train_rows / max(labels.count(), 1)), "train"))
    # by its share, the drawn sample has about ``train_rows`` rows at most
    labelled_id = unused(docs, "labelled_id")
    ids = F.broadcast(drawn.select(F.col("doc_id").alias(labelled_id)))
    labelled = docs.join(ids, docs["doc_id"] == ids[labelled_id])
    labelled = tables.keep(with_views(labelled).join(F.broadcast(drawn), "doc_id")
                           .withColumn("seen", _draw(0.8, "seen")))
    pool = with_views(docs.where("doc_id is not null").where(
        _draw(min(1.0, pool_rows / max(docs.count(), 1)), "pool")))
    pool = tables.keep(pool.join(known, "doc_id", "left_anti"))

    share = labelled.groupBy("seen").agg(F.count("*").alias("n"), F.sum("good").alias("good")).collect()
    total, good = sum(r["n"] for r in share), sum(r["good"] for r in share)
    if len(share) < 2 or any(r["good"] in (0, r["n"]) for r in share):
        return Classifier([], math.log((good + 1e-9) / (total - good + 1e-9)) if total else 20.0)

    train = labelled.where("seen").drop("seen")
    extra: dict[str, DataFrame | None] = {"text": None, "meta": None}
    for step in range(rounds + 1):
        views = {name: _fit(train if extra[name] is None else train.unionByName(extra[name]), name)
                 for name in extra}
        if step < rounds:
            for name, other in (("text", "meta"), ("meta", "text")):
                odds = F.col(f"{other}_odds")
                sure = F.abs(odds) >= math.log(SURE / (1 - SURE))
                extra[name] = (views[other].score(pool).where(sure)
                               .withColumn("good", (odds > 0).cast("double")).drop(f"{other}_odds"))
        tables.release()  # each iteration leaves vectors of all features and a broadcast
    unseen = labelled.where("not seen")
    return Classifier([_calibrate(v, unseen) for v in views.values()], math.log(good / (total - good)))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).score(docs).select(
        "doc_id", "score", "text_score", "meta_score", "kept")
