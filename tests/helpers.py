from __future__ import annotations

from collections import Counter


def rows(df, *columns):
    """Sorted tuples of a frame, NULLs first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()),
                  key=lambda t: tuple((v is not None, str(type(v)), v) for v in t))


def bag(df, *columns):
    return Counter(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def findings(checks):
    """{check: n_bad} of a checks frame."""
    return {r["check"]: r["n_bad"] for r in checks.collect()}


def physical_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
