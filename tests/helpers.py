from __future__ import annotations


def rows(df) -> list[tuple]:
    return [tuple(r) for r in df.collect()]


def row_set(df) -> list[tuple]:
    return sorted(rows(df), key=lambda r: [(v is not None, str(v)) for v in r])


def plan(df) -> str:
    """The physical plan as text, of the final plan if the query has run."""
    return df._jdf.queryExecution().executedPlan().toString()
