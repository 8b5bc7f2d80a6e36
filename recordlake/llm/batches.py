"""Work on Arrow batches whose text per step is bounded, and tables kept between steps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from recordlake.functions import cols
from recordlake.scratch import scratch_path

#: Bytes of text that one step inside a task takes at most; a longer text is a step of its own.
STEP_BYTES = 4_000_000


def steps(batch: pa.RecordBatch, column: int = 0, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with ``limit`` bytes in a column of texts, binary values or ids at most."""
    texts = batch.column(column)
    if batch.num_rows == 0:
        return
    if pa.types.is_list(texts.type):
        lengths = pc.multiply(pc.list_value_length(texts), 8).fill_null(0)
    else:
        lengths = pc.binary_length(texts).fill_null(0)
    lengths = lengths.to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(lengths.astype(np.int64)), 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def append_columns(
    df: DataFrame,
    text: str | Column,
    fields: list[StructField],
    make: Callable[[list], list],
    keep: list[str] | None = None,
) -> DataFrame:
    """Columns computed from one column or expression of texts, binary values or ids, by batches.

    ``make`` gets the values of a step, None for null, and returns one list per field.
    ``keep`` names the columns that stay (all by default), whatever their names; a kept column
    with the name of a new one gives way to it. Rows stay where they are: nothing is shuffled.
    """
    new = [field.name for field in fields]
    kept = [c for c in (df.columns if keep is None else keep) if c not in new]
    # Inside the task columns go by place, so no name of theirs can clash or need quotes.
    places = [f"kept_{i}" for i in range(len(kept))]
    made_places = [f"made_{i}" for i in range(len(fields))]
    schema = StructType(
        [StructField(place, df.schema[c].dataType) for place, c in zip(places, kept)]
        + [StructField(place, field.dataType) for place, field in zip(made_places, fields)]
    )
    types = [pa_type(field) for field in fields]

    # A text that stays is sent once, at its own place.
    stays = isinstance(text, str) and text in kept
    at = kept.index(text) if stays else 0

    def run(batches):
        for batch in batches:
            for step in steps(batch, at):
                made = make(step.column(at).to_pylist())
                arrays = [pa.array(values, type=t) for values, t in zip(made, types)]
                columns = step.columns if stays else step.columns[1:]
                yield pa.RecordBatch.from_arrays(columns + arrays, names=places + made_places)

    source = [column.alias(place) for column, place in zip(cols(kept), places)]
    if not stays:
        source.insert(0, (df[quoted(text)] if isinstance(text, str) else text).alias("text"))
    renamed = [F.col(place).alias(name) for place, name in zip(places + made_places, kept + new)]
    return df.select(*source).mapInArrow(run, schema).select(*renamed)


def pa_type(field: StructField) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(field.dataType)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def row_keys(*names: str) -> list[Column]:
    """Two 64-bit keys of a row's values, which are the same whenever the row is read again.

    Nulls have keys too. Rows with equal values have equal keys, so a table that is joined
    back by them must hold a key once.
    """
    values = [F.col(quoted(n)) for n in names]
    nulls = [F.isnull(v) for v in values]
    return [
        F.xxhash64(F.lit(0), *values, *nulls).alias("key_a"),
        F.xxhash64(F.lit(1), *reversed(values), *nulls).alias("key_b"),
    ]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again: the lineage ends here."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
