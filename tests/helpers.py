from __future__ import annotations

import datetime as dt


def at(day: int = 1, hour: int = 0, minute: int = 0, second: int = 0, us: int = 0, month: int = 1):
    return dt.datetime(2024, month, day, hour, minute, second, us)


def rows(df, *columns: str):
    """Rows as sorted tuples, floats rounded."""
    picked = df.select(*columns) if columns else df
    plain = [tuple(round(v, 8) if isinstance(v, float) else v for v in r) for r in picked.collect()]
    return sorted(plain, key=repr)


def same(left, right) -> None:
    """Equal tables whatever the order of rows and columns."""
    assert sorted(left.columns) == sorted(right.columns)
    a, b = rows(left, *sorted(left.columns)), rows(right, *sorted(left.columns))
    assert len(a) == len(b)
    different = [(x, y) for x, y in zip(a, b) if x != y]
    assert not different, f"{len(different)} of {len(a)} rows, first {different[0]}"
