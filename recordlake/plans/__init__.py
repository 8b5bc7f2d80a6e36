from recordlake.plans.analyst import (
    label_counts,
    label_type_counts,
    month_counts,
    month_shares,
    months_of_year,
    query,
    register,
    type_counts,
)
from recordlake.plans.code_lookups import (
    code_table_checks,
    export_code_tables,
    read_code_tables,
)
from recordlake.plans.column_profile import export_column_profile, export_value_counts
from recordlake.plans.enriched_lake import (
    CARRIED_COLUMNS,
    build_enriched_lake,
    enriched_backfill_plan,
    enriched_lake_checks,
    enriched_records,
    heal_enriched_lake,
    lookup_checks,
    lookup_specs,
)
from recordlake.plans.raw_lake import (
    build_raw_lake,
    ingest_files,
    monthly_paths,
    raw_lake_checks,
)
from recordlake.plans.studies import key_study, mode_port_counts, port_presence_by_mode

__all__ = [
    "CARRIED_COLUMNS",
    "build_enriched_lake",
    "build_raw_lake",
    "code_table_checks",
    "enriched_backfill_plan",
    "enriched_lake_checks",
    "enriched_records",
    "export_code_tables",
    "export_column_profile",
    "export_value_counts",
    "heal_enriched_lake",
    "ingest_files",
    "key_study",
    "label_counts",
    "label_type_counts",
    "lookup_checks",
    "lookup_specs",
    "mode_port_counts",
    "month_counts",
    "month_shares",
    "monthly_paths",
    "months_of_year",
    "port_presence_by_mode",
    "query",
    "raw_lake_checks",
    "read_code_tables",
    "register",
    "type_counts",
]
