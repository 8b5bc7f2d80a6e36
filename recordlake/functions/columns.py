"""Column-name helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """Column name in backticks, so unusual names (dots, spaces, ticks) resolve."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def cols(names) -> list[Column]:
    return [col(n) for n in names]


def columns_with_dtype(df: DataFrame, prefix: str) -> list[str]:
    """Names of the columns whose simple type string starts with ``prefix``.

    It is a prefix match: ``"int"`` also finds ``interval ...`` columns and
    ``"decimal"`` finds every precision.
    """
    return [name for name, dtype in df.dtypes if dtype.startswith(prefix)]


def literal_rows(spark: SparkSession, rows: list[dict[str, Column]]) -> DataFrame:
    """A frame of a few constant rows, given as constant columns by name."""
    structs = [F.struct(*[c.alias(n) for n, c in row.items()]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def partition_condition(partitions: list[dict]) -> Column:
    """Predicate that keeps exactly the listed partitions.

    An ``IN`` list of the last column for each combination of the others, joined by
    ``OR`` in a balanced tree: thousands of partitions stay a shallow expression.
    Directories are pruned at planning time.
    """
    if not partitions:
        raise ValueError("at least one partition is needed")
    names = list(partitions[0])
    if any(list(p) != names for p in partitions):
        raise ValueError("all partitions must name the same columns in the same order")
    lists: dict[tuple, list] = {}
    for values in partitions:
        *leading, last = values.values()
        lists.setdefault(tuple(leading), []).append(last)
    terms = []
    for leading, last in lists.items():
        term = col(names[-1]).isin(last)
        for name, value in zip(names, leading):
            term = (col(name) == F.lit(value)) & term
        terms.append(term)
    while len(terms) > 1:
        pairs = zip(terms[::2], terms[1::2])
        terms = [a | b for a, b in pairs] + terms[len(terms) & ~1 :]
    return terms[0]
