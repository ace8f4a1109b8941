"""Small helpers shared by the tests."""

import datetime as dt


def day(text):
    return dt.date.fromisoformat(text)


def rows(df, *order):
    """Rows as tuples, ordered by the given columns."""
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def by(df, *keys):
    """Rows as dictionaries, keyed by one or more columns."""
    out = {}
    for row in df.collect():
        key = tuple(row[k] for k in keys)
        out[key[0] if len(key) == 1 else key] = row.asDict()
    return out


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
