"""Column-level building blocks (all JVM-side expressions)."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def changed(cols, s: DataFrame | str, t: DataFrame | str) -> Column:
    """Null-safe "some column differs" test between two aliased sides.

    ``x <> y`` or exactly one side NULL, OR-ed over ``cols``; an empty
    list gives FALSE (the neutral start of the OR chain).
    """
    def side(d, c):
        return F.col(f"{d}.{c}") if isinstance(d, str) else d[c]
    return reduce(or_, (~side(s, c).eqNullSafe(side(t, c)) for c in cols), F.lit(False))


def differs(cols, s, t) -> list[Column]:
    """Plain (not null-safe) ``<>`` per column: NULL on either side is unknown."""
    def side(d, c):
        return F.col(f"{d}.{c}") if isinstance(d, str) else d[c]
    return [side(t, c) != side(s, c) for c in cols]


def full_name(last: Column | str, first: Column | str, middle: Column | str) -> Column:
    """``last || ' ' || first || ' ' || middle`` where a NULL part reads as empty text.

    Spark's ``||`` would give NULL and ``concat_ws`` would drop the blank,
    so each part is coalesced to ``''`` first.
    """
    parts = [F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit("")) for p in (last, first, middle)]
    return F.concat(parts[0], F.lit(" "), parts[1], F.lit(" "), parts[2])


def minus_days(ts: Column, days: int = 1) -> Column:
    """Timestamp minus whole days; stays zone-free (NULL stays NULL)."""
    return ts - F.expr(f"INTERVAL {int(days)} DAYS")


def within(later: Column, earlier: Column, gap: str) -> Column:
    """``later - earlier < gap`` for a literal interval such as ``'60 days'``.

    Written as ``later < earlier + gap`` so no day count is truncated.
    """
    return later < earlier + F.expr(f"INTERVAL {gap}")


def nulls_last(*cols: str | Column) -> list[Column]:
    return [(F.col(c) if isinstance(c, str) else c).asc_nulls_last() for c in cols]
