"""Build the enriched lake: labels, real dates and a global id on every record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.functions.columns import cols, partition_condition
from recordlake.functions.dates import day_number_to_date
from recordlake.functions.keys import composite_key
from recordlake.operators.backfill import backfill_plan, to_rebuild
from recordlake.operators.lookups import LookupSpec, enrich_with_lookups
from recordlake.operators.numeric_types import apply_numeric_types, recommend_numeric_types
from recordlake.operators.quality import (
    join_preserves_rows,
    key_checks,
    require_all_passed,
    unique_in_partition,
)
from recordlake.plans import visits
from recordlake.sources.readers import read_lake
from recordlake.sources.writers import (
    replace_partitions,
    whole_partition_values,
    write_lake,
)


def lookup_specs(tables: dict[str, DataFrame]) -> list[LookupSpec]:
    """The six labels out of five code tables; countries are used twice."""
    return [
        LookupSpec(code, tables[table], numeric=numeric)
        for code, table, numeric in visits.LABELLED_CODES
    ]


def lookup_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Keys unique and not NULL, also after number keys are read as numbers."""
    numeric = {
        table: LookupSpec(code, tables[table], numeric=True).prepared()
        for code, table, is_number in visits.LABELLED_CODES
        if is_number
    }
    return key_checks(tables, "key").unionAll(key_checks(numeric, "lookup_key"))


def enriched_records(records: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Raw records with labels, dates and id, in the enriched column order.

    Codes and day numbers stay next to what is derived from them; the constant
    ``count`` column is left out.
    """
    labelled = enrich_with_lookups(records, lookup_specs(tables))
    derived = labelled.withColumns(
        {
            "guid": composite_key(F.col("i94yr"), F.col("i94mon"), F.col("cicid")),
            "arrival_date": day_number_to_date(F.col("arrdate")),
            "departure_date": day_number_to_date(F.col("depdate")),
        }
    )
    return derived.select(*cols(visits.ENRICHED_COLUMNS))


def build_enriched_lake(
    spark: SparkSession,
    raw_path: str,
    tables: dict[str, DataFrame],
    out: str,
    partitions: list[dict] | None = None,
    mode: str = "overwrite",
    narrow: bool = False,
) -> None:
    """Build the enriched lake in one job, or rebuild only the listed partitions.

    The lookups are checked first: a repeated key would multiply records. With
    ``partitions`` only those months are read, by pruned directories, and only
    those are replaced, so a failed or late month can be run again.

    ``narrow`` stores whole numbers as ints or bigints, by one more scan of the raw
    lake's numbers. Months cannot be replaced if the raw lake has since outgrown the
    types of the enriched one: build that anew.
    """
    require_all_passed(lookup_checks(tables))
    records = read_lake(spark, raw_path)
    proposals = []
    if narrow:
        doubles = set(visits.NUMBER_COLUMNS) - set(visits.PARTITION_BY)
        numbers = [c for c in visits.ENRICHED_COLUMNS if c in doubles]
        proposals = recommend_numeric_types(records, numbers).collect()
    if partitions is None:
        enriched = apply_numeric_types(enriched_records(records, tables), proposals)
        enriched = whole_partition_values(enriched, visits.PARTITION_BY)
        write_lake(enriched, out, visits.PARTITION_BY, mode)
    else:
        records = records.where(partition_condition(partitions))
        enriched = apply_numeric_types(enriched_records(records, tables), proposals)
        enriched = whole_partition_values(enriched, visits.PARTITION_BY)
        _refuse_other_types(enriched, out)
        replace_partitions(enriched, out, partitions)


def _lake_if_built(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return read_lake(spark, path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _refuse_other_types(new: DataFrame, out: str) -> None:
    """Months of one lake have the same types, else it could not be read any more."""
    lake = _lake_if_built(new.sparkSession, out)
    held = dict(lake.dtypes) if lake is not None else {}
    other = [f"{n} {held[n]}, not {t}" for n, t in new.dtypes if held.get(n, t) != t]
    if other:
        raise ValueError(f"the enriched lake has other types: {'; '.join(other)}")


def enriched_lake_checks(raw: DataFrame, enriched: DataFrame) -> DataFrame:
    """Every month kept its rows, and ids are still unique within each month."""
    return join_preserves_rows(raw, enriched, visits.PARTITION_BY).unionAll(
        unique_in_partition(enriched, visits.PARTITION_BY, visits.RECORD_ID)
    )


#: Columns that the enriched lake takes over from the raw one as they are.
CARRIED_COLUMNS = tuple(
    name
    for name, _ in visits.RAW_COLUMNS
    if name in visits.ENRICHED_COLUMNS and name not in visits.PARTITION_BY
)


def enriched_backfill_plan(
    spark: SparkSession, raw_path: str, out: str, columns: Sequence[str] = (visits.RECORD_ID,)
) -> DataFrame:
    """The state of every month of the enriched lake beside the raw one.

    By default records are told apart by their ids; :data:`CARRIED_COLUMNS` compares all values
    that both lakes hold, by a scan of all of them. See :func:`backfill_plan`.
    """
    raw = read_lake(spark, raw_path)
    return backfill_plan(raw, _lake_if_built(spark, out), visits.PARTITION_BY, columns)


def heal_enriched_lake(
    spark: SparkSession,
    raw_path: str,
    tables: dict[str, DataFrame],
    out: str,
    narrow: bool = False,
    columns: Sequence[str] = (visits.RECORD_ID,),
) -> list[dict]:
    """Build again the months of the enriched lake that do not follow from the raw one, and no others.

    Missing, short, doubled and changed months are replaced, and months that the raw lake no longer
    has are emptied. Returns the months done, with their former state and counts; a second call
    returns none. A call that failed half-way is repeated: what is done already is complete then.
    """
    plan = to_rebuild(enriched_backfill_plan(spark, raw_path, out, columns))
    # Months of a lake: a short list, as the directories that are replaced.
    damaged = [row.asDict() for row in plan.orderBy(*cols(visits.PARTITION_BY)).collect()]
    if damaged:
        months = [{n: month[n] for n in visits.PARTITION_BY} for month in damaged]
        if any(None in month.values() for month in months):
            raise ValueError("records without a year or month belong to no partition that can be built")
        build_enriched_lake(spark, raw_path, tables, out, partitions=months, narrow=narrow)
    return damaged
