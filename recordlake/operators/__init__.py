from recordlake.operators.anomalies import (
    anomaly_summary,
    group_quantiles,
    label_anomalies,
    rank_errors,
    robust_spread,
)
from recordlake.operators.backfill import backfill_plan, partition_digests, to_rebuild
from recordlake.operators.code_tables import (
    Section,
    code_table,
    code_table_report,
    extract_code_tables,
    section_bounds,
    section_lines,
)
from recordlake.operators.counts import (
    date_part_counts,
    distinct_count,
    group_min_max_count,
    key_counts,
    min_max,
    non_null_count,
    presence_counts,
    records_per_key_range,
    repeat_key_records,
    repeat_keys,
    row_count,
    share_of_total,
    value_counts,
)
from recordlake.operators.first_rows import first_by_key, last_by_key
from recordlake.operators.hot_keys import hot_keys, split_hot
from recordlake.operators.lookups import (
    LookupSpec,
    enrich_with_lookups,
    lookup_sizes,
    unmatched_codes,
)
from recordlake.operators.numeric_types import (
    apply_numeric_types,
    recommend_numeric_types,
)
from recordlake.operators.profiling import (
    first_value_counts,
    near_unique_columns,
    profile_value_counts,
    table_overview,
    table_preview,
)
from recordlake.operators.quality import (
    append_check_results,
    compare_check_runs,
    date_agreement,
    failed_checks,
    join_preserves_rows,
    key_checks,
    lake_checks,
    new_failures,
    read_check_history,
    require_all_passed,
    same_table_checks,
    sequence_completeness,
    unique_in_partition,
)
from recordlake.operators.quarantine import (
    broken_rules,
    read_abnormal,
    read_clean,
    split_abnormal,
    write_judged,
)
from recordlake.operators.sketches import (
    distinct_sketches,
    merged_distinct_counts,
    read_sketches,
    relative_error,
    store_sketches,
    surely_repeated,
)

__all__ = [
    "LookupSpec",
    "Section",
    "anomaly_summary",
    "append_check_results",
    "apply_numeric_types",
    "backfill_plan",
    "broken_rules",
    "code_table",
    "code_table_report",
    "compare_check_runs",
    "date_agreement",
    "date_part_counts",
    "distinct_count",
    "distinct_sketches",
    "enrich_with_lookups",
    "extract_code_tables",
    "failed_checks",
    "first_by_key",
    "first_value_counts",
    "group_min_max_count",
    "group_quantiles",
    "hot_keys",
    "join_preserves_rows",
    "key_checks",
    "key_counts",
    "label_anomalies",
    "lake_checks",
    "last_by_key",
    "lookup_sizes",
    "merged_distinct_counts",
    "min_max",
    "near_unique_columns",
    "new_failures",
    "non_null_count",
    "partition_digests",
    "presence_counts",
    "profile_value_counts",
    "rank_errors",
    "read_abnormal",
    "read_check_history",
    "read_clean",
    "read_sketches",
    "recommend_numeric_types",
    "records_per_key_range",
    "relative_error",
    "repeat_key_records",
    "repeat_keys",
    "require_all_passed",
    "robust_spread",
    "row_count",
    "same_table_checks",
    "section_bounds",
    "section_lines",
    "sequence_completeness",
    "share_of_total",
    "split_abnormal",
    "split_hot",
    "store_sketches",
    "surely_repeated",
    "table_overview",
    "table_preview",
    "to_rebuild",
    "unique_in_partition",
    "unmatched_codes",
    "value_counts",
    "write_judged",
]
