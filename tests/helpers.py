"""What several tests read results by."""

from __future__ import annotations


def rows_of(df):
    return [tuple(row) for row in df.collect()]


def sorted_rows(df):
    return sorted(rows_of(df), key=repr)
