"""Helpers for comparing frames."""


def rows(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())
