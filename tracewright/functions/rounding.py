"""Python ``round(v, 1)`` on doubles, exactly.

Python rounds the exact binary value half-to-even. Spark ``round``/``bround``
(and DuckDB ``round``) go through the shortest decimal string, so they differ
on the x.x5 values whose binary expansion lies just below or above the tie.
Within [0, 5] (the only range that reaches rounding: bounds run first) those
are the 50 values k/20 for odd k in 1..99; their Python results are built at
plan time into a literal map, every other value uses ``bround``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ties() -> list[tuple[float, float]]:
    return [(k / 20, round(k / 20, 1)) for k in range(1, 100, 2)]


TIES = _ties()


def py_round1(v: Column) -> Column:
    m = F.create_map(*[x for a, b in TIES for x in (F.lit(a).cast("double"), F.lit(b).cast("double"))])
    return F.coalesce(F.try_element_at(m, v.cast("double")), F.bround(v.cast("double"), 1))


def duck_round1(v: str) -> str:
    """The same rule for the DuckDB oracle (CASE over the tie table)."""
    whens = " ".join(f"WHEN {v} = {a!r} THEN {b!r}" for a, b in TIES)
    return f"(CASE {whens} ELSE round_even({v}, 1) END)"
