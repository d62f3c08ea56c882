"""Small helpers for comparing frames."""

import math


def rows(df, *columns):
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


def comparable(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return repr(float(value))
    return str(value)


def table(names, records):
    """Order-insensitive form of a result, columns sorted by name."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(comparable(r[i]) for i in order) for r in records)
