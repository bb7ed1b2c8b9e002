"""Quality rules as a short-circuit cascade of native column expressions.

Each rule is a condition that rejects a text. On a sample, the time a rule takes
and the share it rejects are measured; rules then run in order of rejection per
cost, and a text that one rejects is not shown to the later ones. The order
changes the work, never the verdict.

Null text has no words: it fails the base rule. Rows are independent: repeated
rows, equal or null doc_ids each give a row of their own. Extra columns are
ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from castledger.llm.common import documents_of

SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS, MAX_REPEATED_PCT, WINDOW = 50, 50, 3
#: Texts on which costs and selectivities are estimated.
SAMPLE_ROWS, SAMPLE_CHARS = 500, 100_000


@dataclass(frozen=True)
class Rule:
    """``rejects``: condition over the columns of ``with_measures``."""
    name: str
    rejects: Column


def _bind(value: Column, use) -> Column:
    """``use(value)`` with value computed once per row: inside a lambda a plain
    reference to an expression would be computed again for each element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text: Column) -> Column:
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(inner) > 0, F.split(inner, SPACE)).otherwise(
        F.array().cast("array<string>"))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"),
                     lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
    return _bind(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows that occur twice or more in the text. Windows are
    compared by 64-bit hashes, sorted with their places so that equal ones are
    neighbours."""
    def hashes(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(w) - window + 1), lambda i: F.xxhash64(
            *(F.get(w, i + (k - 1)) for k in range(window))))

    def repeated(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return _bind(placed, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"])
                     | (x["h"] == F.get(s, k + 1)["h"])), lambda x: x["i"])))

    def covered(h: Column) -> Column:
        return _bind(repeated(h), lambda p: F.aggregate(
            F.transform(p, lambda at, k: F.least(
                F.lit(window), F.coalesce(F.get(p, k + 1) - at, F.lit(window)))),
            F.lit(0).cast("long"), lambda a, x: a + x))

    distinct = _bind(words, lambda w: F.when(F.size(w) >= window, _bind(
        hashes(w), lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)))))
    return F.coalesce(distinct, F.lit(0).cast("long"))


def with_measures(docs: DataFrame) -> DataFrame:
    """Documents with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    docs = documents_of(docs).withColumn("words", words_of(F.col("text")))
    return docs.select(
        "doc_id", "text",
        F.size("words").cast("long").alias("n_words"),
        F.coalesce(F.length(F.array_join("words", "")), F.lit(0)).cast("long").alias("word_chars"),
        F.coalesce(F.regexp_count("text", F.lit(SYMBOLS)), F.lit(0)).cast("long").alias("n_symbols"),
        duplicate_lines(F.col("text")).alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"))


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEATED_PCT * F.col("n_words")))


def default_rules() -> list[Rule]:
    """Thresholds at which prose of any language passes and junk does not. All
    compare whole numbers, so that the verdict is exact."""
    n, text = F.col("n_words"), F.col("text")
    return [
        Rule("symbols", 10 * F.col("n_symbols") > F.col("word_chars")),
        Rule("word_length", (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 20 * n)),
        Rule("repeated_lines", 2 * F.col("n_dup_lines")
             > F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1),
        Rule("shouting", 2 * F.regexp_count(text, F.lit("[A-Z]")) > F.col("word_chars")),
        Rule("exclamation", 4 * F.regexp_count(text, F.lit("!")) > n),
    ]


def order_rules(docs: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Most rejections per second first, both measured on the first ``sample_rows``
    texts of up to ``SAMPLE_CHARS`` characters, for which Spark reads as few
    partitions as it can. Equal ones stay in the given order."""
    texts = documents_of(docs)
    short = F.coalesce(F.length("text"), F.lit(0)) <= SAMPLE_CHARS
    sample = with_measures(docs.sparkSession.createDataFrame(
        texts.where(short).take(sample_rows), texts.schema)).cache()
    rows = sample.count()

    def cost_and_share(rule: Rule) -> tuple[float, float]:
        seconds = []
        for _ in range(2):
            began = time.perf_counter()
            rejected = sample.agg(F.count_if(rule.rejects)).first()[0]
            seconds.append(time.perf_counter() - began)
        return min(seconds), rejected / max(rows, 1)

    rate = {r.name: share / max(cost, 1e-9) for r in rules for cost, share in [cost_and_share(r)]}
    sample.unpersist()
    return sorted(rules, key=lambda r: -rate[r.name])


def cascade(rules: list[Rule]) -> Column:
    """Name of the first rule that rejects, null if none does: a CASE evaluates
    its conditions in order and stops at the first that holds."""
    if not rules:
        return F.lit(None).cast("string")
    first, *rest = rules
    found = F.when(first.rejects, F.lit(first.name))
    for rule in rest:
        found = found.when(rule.rejects, F.lit(rule.name))
    return found


def quality_rules(docs: DataFrame, rules: list[Rule] | None = None,
                  sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Measures, ``base_failed``, ``rejected_by`` (first rule of the cascade) and
    ``kept`` of every document."""
    measured = with_measures(docs)
    ordered = order_rules(docs, rules if rules is not None else default_rules(), sample_rows)
    return (measured.withColumn("base_failed", base_failed())
            .withColumn("rejected_by", F.when(F.col("base_failed"), F.lit("base"))
                        .otherwise(cascade(ordered)))
            .withColumn("kept", F.col("rejected_by").isNull())
            .drop("text"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


OP2_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         [x for x in string_split(text, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM d
), p AS (
  SELECT r, unnest(range(1, len(words) - 1)) AS i, words FROM w WHERE len(words) >= 3
), g AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, words[i], words[i + 1], words[i + 2]) AS n FROM p
), c AS (
  SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS following FROM g WHERE n > 1
), k AS (
  SELECT r, sum(least(3, coalesce(following - i, 3)))::BIGINT AS n FROM c GROUP BY r
), m AS (
  SELECT doc_id, text, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(k.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN k USING (r)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > word_chars
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR 2 * n_dup_lines > len(regexp_extract_all(text, '\n')) + 1
            OR 2 * len(regexp_extract_all(text, '[A-Z]')) > word_chars
            OR 4 * len(regexp_extract_all(text, '!')) > n_words) AS kept
FROM b
"""
