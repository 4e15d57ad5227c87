"""Array expressions shared by chunks and tiles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once for use in ``body``.  A lambda variable is evaluated
    a single time; an expression mentioned inside another lambda would be
    evaluated again for each of its elements."""
    return F.transform(F.array(value), body)[0]


def dense_values(entries, n: int) -> Column:
    """Dense array of ``n`` values from structs ``(loc, value)`` in any order:
    NULL where no entry has a place; where several do, the greatest value.

    Linear after one sort: each entry adds the gap before it and itself."""
    e = F.col(entries) if isinstance(entries, str) else entries

    def fill(s: Column) -> Column:
        def piece(x: Column, i: Column) -> Column:
            before = F.coalesce(F.get(s, i - 1)["loc"], F.lit(-1))
            following = F.get(s, i + 1)["loc"]
            # of equal places the last in sort order, the greatest value, counts; the gap goes before the first
            gap = F.when(before == x["loc"], F.lit(0)).otherwise(x["loc"] - before - 1)
            own = F.when(following == x["loc"], F.slice(F.array(x["value"]), 1, 0)).otherwise(F.array(x["value"]))
            return F.concat(F.array_repeat(F.lit(None).cast("double"), gap), own)

        last = F.coalesce(F.get(s, F.size(s) - 1)["loc"], F.lit(-1))
        tail = F.array_repeat(F.lit(None).cast("double"), F.lit(n - 1) - last)
        return F.concat(F.flatten(F.transform(s, piece)), tail)

    return let(F.sort_array(e), fill)
