"""Labels for codes: a star of left joins to ``key, value`` lookup tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.functions.columns import col, cols
from recordlake.operators.counts import value_counts
from recordlake.operators.hot_keys import hot_keys
from recordlake.scratch import scratch_path

MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# What a row costs in a broadcast hash table besides its text.
_ROW_OVERHEAD = 64
# Over how many keys rows are spread that pass a shuffled join unmatched.
_SPREAD = 4096
# Names of helper columns, which stand beside the columns of any input.
_KEY, _CHAIN_KEY, _HOT_CODE, _HOT_LABEL, _SHUFFLE_KEY, _SPREAD_KEY = (
    f"_recordlake_{name}"
    for name in ("key", "chain_key", "hot_code", "hot_label", "shuffle_key", "spread_key")
)


@dataclass(frozen=True)
class LookupSpec:
    """How one code column gets its label.

    Keys are converted to the code's type, on the lookup side; a key that has no
    value of that type labels nothing and fails nothing. ``numeric`` is for number
    codes whose lookup keys are text (``'582'``): without a known code type, the keys
    are read as doubles. The same ``table`` may serve several columns.
    """

    code: str
    table: DataFrame
    label: str | None = None
    numeric: bool = False
    key: str = "key"
    value: str = "value"

    @property
    def label_column(self) -> str:
        return self.label or f"{self.code}_value"

    def prepared(self, code_type: str | None = None) -> DataFrame:
        """The lookup as ``lookup_key``, label, without keys that cannot match.

        The key has the code's type, so whole numbers are compared as such.
        """
        key = col(self.key)
        if code_type is None and self.numeric:
            code_type = "double"
        if code_type is not None and dict(self.table.dtypes)[self.key] != code_type:
            key = key.try_cast(code_type)
        return self.table.select(
            key.alias("lookup_key"), col(self.value).alias(self.label_column)
        ).where(F.col("lookup_key").isNotNull())


def lookup_sizes(specs: Sequence[LookupSpec]) -> dict[tuple, int]:
    """Upper estimate of each distinct lookup's size in memory, from one small job.

    It reads the lookups once more: store one that is costly to derive.
    """
    distinct = {_identity(s): s for s in specs}
    measured = [
        s.table.select(
            F.lit(i).alias("lookup"),
            sum(
                F.coalesce(F.octet_length(col(c).cast("string")), F.lit(0))
                for c in (s.key, s.value)
            ).alias("bytes"),
        )
        for i, s in enumerate(distinct.values())
    ]
    totals = (
        reduce(DataFrame.unionAll, measured)
        .groupBy("lookup")
        .agg((F.sum("bytes") + F.count("*") * _ROW_OVERHEAD).alias("bytes"))
        .collect()
    )
    found = {row["lookup"]: row["bytes"] for row in totals}
    return {key: found.get(i, 0) for i, key in enumerate(distinct)}


def _identity(spec: LookupSpec) -> tuple:
    return id(spec.table), spec.key, spec.value


def enrich_with_lookups(
    df: DataFrame,
    specs: Sequence[LookupSpec],
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    hot_rows: int | None = None,
) -> DataFrame:
    """Add one label column per spec; every row of ``df`` is kept.

    NULL codes and codes without a label get a NULL label. A code may be the label
    of an earlier spec. Keys are expected to
    be unique (see ``key_checks``): a repeated key would multiply rows.

    Lookups are measured first. As long as those taken so far stay under the limit
    together, they are broadcast, so that all
    of them are joined in one pass over ``df`` without a shuffle. Another one is
    joined by shuffle, with its heavy codes kept apart: a code with more than
    ``hot_rows`` rows is heavy, by default one that exceeds an even share of a
    shuffle task. Labels of its labels are looked up on the lookup's own rows, so
    a chain of large lookups is one join with ``df``. Heavy codes are found by a
    job that reads the code column only.
    """
    if not specs:
        return df
    _refuse_existing_labels(df, specs)
    sizes = lookup_sizes(specs)
    result, used, chains, rest = df, 0, [], list(specs)
    while rest:
        spec = rest.pop(0)
        chain = _chain(spec, rest)
        rest = [s for s in rest if not any(s is c for c in chain)]
        size = sum(sizes[_identity(s)] for s in [spec, *chain])
        if used + size <= max_broadcast_bytes:
            used += size
            for small in [spec, *chain]:
                result = _label(result, small, F.broadcast(_keyed(result, small)))
        else:
            chains.append((spec, chain))
    for spec, chain in chains:
        lookup = _keyed(df, spec).withColumnRenamed(_KEY, _CHAIN_KEY)
        lookup = enrich_with_lookups(lookup, chain, max_broadcast_bytes - used, hot_rows)
        lookup = lookup.withColumnRenamed(_CHAIN_KEY, _KEY)
        hot = _hot_codes(df, spec.code, hot_rows)
        # Two readings of the rows so far are cheaper than a shuffle of settled rows, but
        # with several large lookups the readings would double with each.
        result = _label_large(result, spec.code, lookup, hot, apart=len(chains) == 1)
    return result.select(*cols(df.columns), *[col(s.label_column) for s in specs])


def _refuse_existing_labels(df: DataFrame, specs: Sequence[LookupSpec]) -> None:
    taken = set(df.columns)
    for spec in specs:
        if spec.label_column in taken:
            raise ValueError(f"there is a column {spec.label_column} already")
        if spec.code not in taken:
            raise ValueError(f"there is no code column {spec.code} before its label")
        taken.add(spec.label_column)


def _chain(spec: LookupSpec, later: Sequence[LookupSpec]) -> list[LookupSpec]:
    """The later specs whose code is the label of ``spec``, or a label on that."""
    labels, chain = {spec.label_column}, []
    for other in later:
        if other.code in labels:
            chain.append(other)
            labels.add(other.label_column)
    return chain


def _keyed(df: DataFrame, spec: LookupSpec) -> DataFrame:
    """The lookup with keys of the code's type, under a name that no column of ``df`` has."""
    return spec.prepared(dict(df.dtypes)[spec.code]).withColumnRenamed("lookup_key", _KEY)


def _label(df: DataFrame, spec: LookupSpec, lookup: DataFrame) -> DataFrame:
    joined = df.join(lookup, col(spec.code) == F.col(_KEY), "left")
    return joined.drop(_KEY)


def _hot_codes(
    df: DataFrame, code: str, hot_rows: int | None, max_hot: int = 10_000
) -> DataFrame:
    """The heavy codes, ``max_hot`` at most, as a stored table."""
    spark = df.sparkSession
    counts = value_counts(df.where(col(code).isNotNull()), code, ordered=False)
    limit = hot_rows
    if limit is None:
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        limit = F.ceil(counts.agg(F.sum("records")).scalar() / F.lit(tasks))
    hot = hot_keys(counts, [code], limit, max_hot).select(col(code).alias(_HOT_CODE))
    path = scratch_path(spark, "hot-codes")
    hot.write.parquet(path)
    return spark.read.schema(hot.schema).parquet(path)


def _label_large(
    df: DataFrame, code_column: str, lookup: DataFrame, hot: DataFrame, apart: bool
) -> DataFrame:
    """Left join to a lookup that is too big to broadcast: ``_KEY`` and its labels.

    The labels of the heavy codes are broadcast. The others come by a shuffled join.
    Rows that are settled without it, because their code is heavy or NULL, are set
    ``apart`` and not shuffled. Otherwise they pass through it under keys that match
    nothing and spread them over the tasks. These keys come from the row and the task
    that read it: copies of one row spread too, and a task that runs again gives the
    same keys.
    """
    code, labels = col(code_column), [n for n in lookup.columns if n != _KEY]
    hot_rows = lookup.join(F.broadcast(hot), F.col(_KEY) == F.col(_HOT_CODE), "left_semi")
    hot_rows = hot_rows.select(_KEY, F.struct(*cols(labels)).alias(_HOT_LABEL))
    hot_labels = hot.join(
        F.broadcast(hot_rows), F.col(_HOT_CODE) == F.col(_KEY), "left"
    ).select(_HOT_CODE, _HOT_LABEL)
    with_hot = df.join(F.broadcast(hot_labels), code == F.col(_HOT_CODE), "left")
    settled = code.isNull() | F.col(_HOT_CODE).isNotNull()
    hot_values = [F.col(_HOT_LABEL).getField(n).alias(n) for n in labels]
    if apart:
        known = with_hot.where(settled).select(*cols(df.columns), *hot_values)
        others = df.where(code.isNotNull()).join(
            F.broadcast(hot), code == F.col(_HOT_CODE), "left_anti"
        )
        joined = others.join(lookup, code == F.col(_KEY), "left")
        return known.unionAll(joined.select(*cols(df.columns), *cols(labels)))

    hashed = [n for n, dtype in df.dtypes if "map<" not in dtype and dtype != "variant"]
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *cols(hashed)), F.lit(_SPREAD))
    shuffle_key = F.struct(
        F.when(~settled, code).alias("code"),
        F.when(settled, spread).otherwise(0).alias("spread"),
    )
    lookup_key = F.struct(
        F.col(_KEY).alias("code"), F.lit(0).cast("bigint").alias("spread")
    )
    return (
        with_hot.withColumn(_SHUFFLE_KEY, shuffle_key)
        .join(
            lookup.select(lookup_key.alias(_SPREAD_KEY), *cols(labels)),
            F.col(_SHUFFLE_KEY) == F.col(_SPREAD_KEY),
            "left",
        )
        .select(
            *cols(df.columns),
            *[F.coalesce(v, col(n)).alias(n) for v, n in zip(hot_values, labels)],
        )
    )


def unmatched_codes(
    df: DataFrame, spec: LookupSpec, ordered: bool = True
) -> DataFrame:
    """Codes that are not NULL and have no label, with their row counts.

    The codes are counted before the join, so only distinct codes are joined.
    """
    counts = value_counts(df, spec.code, ordered=False)
    codes = counts.where(col(spec.code).isNotNull())
    missing = codes.join(_keyed(df, spec), col(spec.code) == F.col(_KEY), "left_anti")
    return missing.orderBy(col(spec.code)) if ordered else missing
