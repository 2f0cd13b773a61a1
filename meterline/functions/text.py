"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_uri(path: Column) -> Column:
    """One spelling for local file locations: ``file:/x`` and ``file:///x`` both become ``file:///x``.

    Prefix tests instead of a regular expression, because this runs for every row that is loaded.
    """
    one_slash = path.startswith("file:/") & ~path.startswith("file://")
    return F.when(one_slash, F.concat(F.lit("file:///"), F.substring(path, 7, 2**31 - 1))).otherwise(path)


def quoted_list(items: Column) -> Column:
    """An array of names written as ``['a', 'b']``."""
    quoted = F.transform(items, lambda item: F.concat(F.lit("'"), item, F.lit("'")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def fill(template: str, **values: Column) -> Column:
    """``template`` with each ``{name}`` replaced by the column of that name."""
    pieces: list[Column] = []
    rest = template
    while rest:
        before, brace, after = rest.partition("{")
        if before:
            pieces.append(F.lit(before))
        if not brace:
            break
        name, _, rest = after.partition("}")
        pieces.append(values[name])
    return F.concat(*pieces)
