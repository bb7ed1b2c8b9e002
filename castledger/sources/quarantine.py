"""Load text feeds without stopping at a bad value.

Every column is converted to its declared type or left NULL, never failing. What
could not be converted is listed with the column, the delivered text and the
reason. A row with any such entry is set aside as it was delivered; all others
are loaded. One write job stores both parts, in two partitions of one folder.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from castledger.functions.expr import trim_all
from castledger.sources.registry import TableSpec

PROBLEMS, DELIVERED, REJECTED = "_problems", "_delivered", "_rejected"
DATE_PATTERNS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss")

NOT_A_NUMBER, NOT_A_DATE, NOT_A_FLAG, MISSING_KEY = (
    "NOT_A_NUMBER", "NOT_A_DATE", "NOT_A_FLAG", "MISSING_KEY")


def _converted(text: Column, kind: T.DataType, patterns: Sequence[str]) -> tuple[Column, str | None]:
    """Value of a text, NULL if it has none, and the reason to give then."""
    if isinstance(kind, (T.TimestampType, T.DateType)):
        read = F.coalesce(*[F.try_to_timestamp(text, F.lit(p)) for p in patterns])
        return read.cast(kind), NOT_A_DATE
    if isinstance(kind, T.BooleanType):
        return text.try_cast("boolean"), NOT_A_FLAG
    if isinstance(kind, T.DoubleType):
        number = text.try_cast("double")  # also reads NaN and Infinity, which no amount is
        finite = ~F.isnan(number) & (F.abs(number) < float("inf"))
        return F.when(finite, number), NOT_A_NUMBER
    if isinstance(kind, T.LongType):
        return text.try_cast("bigint"), NOT_A_NUMBER
    return text, None


def typed(raw: DataFrame, spec: TableSpec, patterns: Sequence[str] = DATE_PATTERNS) -> DataFrame:
    """Declared columns in their types, the row as it was delivered (JSON), and
    the list of its problems. Empty text counts as missing; a missing column is
    NULL in all rows."""
    given = {c.lower(): c for c in raw.columns}
    values, problems = [], []
    for field in spec.schema:
        if field.name.lower() not in given:
            values.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        delivered = F.col(given[field.name.lower()]).cast("string")
        is_text = isinstance(field.dataType, T.StringType)
        text = delivered if is_text else F.nullif(trim_all(delivered), F.lit(""))
        value, reason = _converted(text, field.dataType, patterns)
        values.append(value.alias(field.name))
        if reason:
            problems.append(F.when(text.isNotNull() & value.isNull(), _problem(field.name, delivered, reason)))
        if field.name == spec.key:
            problems.append(F.when(F.nullif(trim_all(delivered), F.lit("")).isNull(),
                                   _problem(field.name, delivered, MISSING_KEY)))
    return raw.select(*values, F.to_json(F.struct(*raw.columns)).alias(DELIVERED),
                      F.array_compact(F.array(*problems)).alias(PROBLEMS))


def _problem(column: str, text: Column, reason: str) -> Column:
    return F.struct(F.lit(column).alias("coluna"), text.alias("valor"), F.lit(reason).alias("motivo"))


@dataclass(frozen=True)
class Load:
    """The two parts of a stored load."""

    accepted: DataFrame
    rejected: DataFrame  # delivered, coluna, valor, motivo: one row per problem
    rejected_rows: DataFrame  # delivered: one row per row


def split(frame: DataFrame) -> Load:
    """Parts of a frame of ``typed`` rows with their flag."""
    bad = frame.where(REJECTED).withColumn("delivered", F.col(DELIVERED))
    return Load(frame.where(~F.col(REJECTED)).drop(PROBLEMS, DELIVERED, REJECTED),
                bad.select("delivered", F.inline(PROBLEMS)), bad.select("delivered"))


def load(spark: SparkSession, raw: DataFrame, spec: TableSpec, folder: str,
         patterns: Sequence[str] = DATE_PATTERNS) -> Load:
    """Store both parts of a feed in one pass and return them as stored. Reading
    one part skips the other's files."""
    rows = typed(raw, spec, patterns).withColumn(REJECTED, F.size(PROBLEMS) > 0)
    rows.write.mode("overwrite").partitionBy(REJECTED).parquet(folder)
    return split(spark.read.schema(rows.schema).parquet(folder))
