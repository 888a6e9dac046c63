"""Helpers of the tests, in a module that no other folder of tests has."""

from datetime import datetime


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def rows_of(df, *names):
    """Rows in a fixed order; the last bits of a double depend on the order of its sum."""
    def plain(value):
        return round(value, 9) if isinstance(value, float) else value

    chosen = df.select(*names) if names else df
    return sorted((tuple(plain(value) for value in row) for row in chosen.collect()), key=str)
