"""Money, ratios and averages with exact, engine-independent results.

Rounding a double at a .5 boundary is engine-dependent, so ratios that are
published as decimals (percentages, rounded averages) are computed with
integer arithmetic only. ``round_div_sql`` renders the same formula for
Spark SQL and for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(38,2)"
PCT = "decimal(9,2)"


def avg_exact(c: Column) -> Column:
    """AVG of an exact (integer / decimal) column as DOUBLE.

    The exact sum is turned into the nearest double and divided once, so the
    result is bit-identical in any engine and independent of row order.
    """
    return F.sum(c).cast("double") / F.nullif(F.count(c), F.lit(0)).cast("double")


def round_div_sql(num: str, den: str, digits: int, dialect: str = "spark") -> str:
    """SQL text for round_half_up(num / den, digits); null unless den > 0.

    ``num`` and ``den`` must be integral expressions. Returns decimal(38,digits).
    """
    if dialect == "spark":
        big, idiv = "DECIMAL(38,0)", "div"
    else:
        big, idiv = "HUGEINT", "//"
    n = f"CAST(({num}) AS {big})"
    d = f"CAST(({den}) AS {big})"
    q = (f"(CASE WHEN {n} < 0 THEN -1 ELSE 1 END) * "
         f"((2 * abs({n}) * {10 ** digits} + {d}) {idiv} (2 * {d}))")
    if digits:
        unit = f"CAST({10.0 ** -digits:.{digits}f} AS DECIMAL({digits + 1},{digits}))"
        val = f"CAST(CAST({q} AS DECIMAL(38,0)) * {unit} AS DECIMAL(38,{digits}))"
    else:
        val = f"CAST({q} AS DECIMAL(38,0))"
    return f"(CASE WHEN {d} > 0 THEN {val} END)"


def pct_sql(part: str, whole: str, dialect: str = "spark") -> str:
    """100 * part / whole, half-up to 2 decimals, as decimal(9,2)."""
    return f"CAST({round_div_sql(f'100 * ({part})', whole, 2, dialect)} AS {PCT})"


def pct(part: Column | str, whole: Column | str) -> Column:
    """Column form of :func:`pct_sql` for aggregated integral inputs.

    Inputs are SQL expression strings (e.g. ``"count_if(late)"``) so the
    whole ratio stays one Catalyst expression.
    """
    return F.expr(pct_sql(part, whole))


def round_div(num: str, den: str, digits: int) -> Column:
    return F.expr(round_div_sql(num, den, digits))
