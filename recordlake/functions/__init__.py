from recordlake.functions.columns import (
    col,
    cols,
    columns_with_dtype,
    literal_rows,
    partition_condition,
    quoted,
)
from recordlake.functions.dates import (
    arrival_features,
    date_to_day_number,
    day_number_to_date,
)
from recordlake.functions.keys import composite_key, whole_number_text
from recordlake.functions.text import (
    code_of_line,
    has_assignment,
    label_of_line,
    strip,
)

__all__ = [
    "arrival_features",
    "code_of_line",
    "col",
    "cols",
    "columns_with_dtype",
    "composite_key",
    "date_to_day_number",
    "day_number_to_date",
    "has_assignment",
    "label_of_line",
    "literal_rows",
    "partition_condition",
    "quoted",
    "strip",
    "whole_number_text",
]
