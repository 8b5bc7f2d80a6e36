"""Exploration studies: are the keys unique, and how do ports and modes relate?"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from recordlake.operators.counts import (
    key_counts,
    presence_counts,
    records_per_key_range,
    repeat_key_records,
    repeat_keys,
)
from recordlake.operators.quality import sequence_completeness
from recordlake.plans import visits


@dataclass(frozen=True)
class KeyStudy:
    """Five lazy answers about a record id."""

    repeated_in_partition: DataFrame
    repeated: DataFrame
    repeated_records: DataFrame
    records_per_id: DataFrame
    sequences: DataFrame


def key_study(
    lake: DataFrame,
    record_id: str = visits.RECORD_ID,
    partition_by: Sequence[str] = visits.PARTITION_BY,
) -> KeyStudy:
    """Is the id unique per month, how often does it recur, is it a full sequence?"""
    return KeyStudy(
        repeated_in_partition=repeat_keys(lake, [record_id, *partition_by]),
        repeated=repeat_keys(lake, [record_id]),
        repeated_records=repeat_key_records(lake, [record_id]),
        records_per_id=records_per_key_range(lake, [record_id]),
        sequences=sequence_completeness(lake, partition_by, record_id),
    )


def port_presence_by_mode(
    lake: DataFrame, mode: str = "i94mode", port: str = "i94port"
) -> DataFrame:
    """Records by arrival mode and whether they name a port."""
    return presence_counts(lake, [mode], port)


def mode_port_counts(
    lake: DataFrame, mode: str = "i94mode", port: str = "i94port"
) -> DataFrame:
    """Records by arrival mode and port."""
    return key_counts(lake, [mode, port])
