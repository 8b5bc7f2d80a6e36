"""Set records aside that break a rule, without changing any value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.sources.writers import write_lake

#: The partition column of a lake of judged records, and its values.
VERDICT, CLEAN, ABNORMAL = "verdict", "clean", "abnormal"


def broken_rules(rules: dict[str, Column]) -> Column:
    """Names of the rules that a row breaks. A rule is a predicate of abnormality."""
    names = [F.when(broken, F.lit(name)) for name, broken in rules.items()]
    return F.array_compact(F.array(*names))


def split_abnormal(
    df: DataFrame, rules: dict[str, Column], column: str = "broken_rules"
) -> tuple[DataFrame, DataFrame]:
    """Clean rows as they are, and abnormal rows with the names of the broken rules.

    Each of the two frames evaluates ``df``; :func:`write_judged` evaluates it once for both.
    """
    if not rules:
        raise ValueError("at least one rule is needed")
    marked = df.withColumn(column, broken_rules(rules))
    clean = marked.where(F.size(column) == 0).drop(column)
    abnormal = marked.where(F.size(column) > 0)
    return clean, abnormal


def write_judged(
    df: DataFrame,
    rules: dict[str, Column],
    path: str,
    partition_by: Sequence[str] = (),
    column: str = "broken_rules",
    mode: str = "errorifexists",
) -> None:
    """Judge every row once and write clean and abnormal rows in one job, without a shuffle.

    The lake's first partition column is ``verdict``, ``clean`` or ``abnormal``, below which
    ``partition_by`` applies. Rows keep their values; ``column`` names the broken rules.
    """
    if not rules:
        raise ValueError("at least one rule is needed")
    taken = {VERDICT, column} & set(df.columns)
    if taken:
        raise ValueError(f"the records have columns named {sorted(taken)}")
    marked = df.withColumn(column, broken_rules(rules))
    verdict = F.when(F.size(column) == 0, CLEAN).otherwise(ABNORMAL)
    write_lake(marked.withColumn(VERDICT, verdict), path, [VERDICT, *partition_by], mode)


def read_clean(spark: SparkSession, path: str, column: str = "broken_rules") -> DataFrame:
    """The clean rows of :func:`write_judged`, as they were; the abnormal ones are not read."""
    return spark.read.parquet(path).where(F.col(VERDICT) == CLEAN).drop(VERDICT, column)


def read_abnormal(spark: SparkSession, path: str) -> DataFrame:
    """The abnormal rows of :func:`write_judged`, with the rules that they break."""
    return spark.read.parquet(path).where(F.col(VERDICT) == ABNORMAL).drop(VERDICT)
