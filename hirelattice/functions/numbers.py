"""Numeric helpers: exact money totals, percentages and guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money arrives as DOUBLE with two decimals. Amounts that are whole in this unit and below the
# bound are added up as whole numbers; all others (finer, larger, not finite) as they are.
MONEY_SCALE = 4
EXACT_BELOW = 1e10  # itself included
_BLOCK_BITS = 20


def total_parts(amount: str, scale: int = MONEY_SCALE) -> tuple[str, str, str]:
    """SQL text of the high and low parts of ``amount`` in units of 10^-scale, and of the rest.

    An amount is either in the first two or in the rest, never rounded. The parts are safe to
    add up as BIGINT: the low part is below 2^20, so its sum holds for 8e12 rows, and the high
    part's for 9e10 rows of the largest amount. The sums stay primitive longs inside generated
    code, unlike a DECIMAL buffer, and do not depend on the order of the rows, unlike a DOUBLE sum.
    """
    whole = f"rint(({amount}) * 1e{scale})"
    held = f"(abs({amount}) <= {EXACT_BELOW:.0e}D AND {whole} / 1e{scale} = ({amount}))"
    units = f"TRY_CAST({whole} AS BIGINT)"
    return (
        f"CASE WHEN {held} THEN shiftright({units}, {_BLOCK_BITS}) END",
        f"CASE WHEN {held} THEN {units} & {(1 << _BLOCK_BITS) - 1} END",
        f"CASE WHEN NOT {held} THEN CAST({amount} AS DOUBLE) END",
    )


def join_parts(high: str, low: str, scale: int = MONEY_SCALE) -> str:
    """SQL text of the DECIMAL behind two summed parts; nothing summed stays NULL."""
    step = f"CAST('{10 ** -scale:.{scale}f}' AS DECIMAL({scale + 1},{scale}))"
    units = f"CAST({high} AS DECIMAL(20,0)) * {1 << _BLOCK_BITS} + CAST({low} AS DECIMAL(20,0))"
    return f"CAST(({units}) * {step} AS DECIMAL(38,{scale}))"


def with_rest(exact: str, rest: str) -> str:
    """SQL text of an exact total and the total of the rest as one DOUBLE; NULL when both are."""
    return f"CASE WHEN {rest} IS NULL THEN CAST({exact} AS DOUBLE) ELSE coalesce(CAST({exact} AS DOUBLE), 0D) + {rest} END"


def total_struct_text(amount: str, scale: int = MONEY_SCALE) -> str:
    """SQL text of the exact total and the total of the rest as a struct (exact, rest)."""
    high, low, rest = total_parts(amount, scale)
    return f"named_struct('exact', {join_parts(f'sum({high})', f'sum({low})', scale)}, 'rest', sum({rest}))"


def exact_total_text(amount: str, scale: int = MONEY_SCALE) -> str:
    high, low, rest = total_parts(amount, scale)
    return with_rest(join_parts(f"sum({high})", f"sum({low})", scale), f"sum({rest})")


def exact_total(amount: str, scale: int = MONEY_SCALE) -> Column:
    """SUM of a column or SQL expression as DOUBLE, the same for every order of the rows.

    NULL when nothing is summed, like SUM itself; a NaN or infinite amount makes the total so.
    Totals of totals stay exact, as a total is a whole number of units again.
    """
    return F.expr(exact_total_text(amount, scale))


def exact_mean(amount: str, scale: int = MONEY_SCALE) -> Column:
    """AVG over the non-NULL values, built on the exact total."""
    return F.expr(f"try_divide({exact_total_text(amount, scale)}, CAST(count({amount}) AS DOUBLE))")


def safe_ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` as DOUBLE; NULL for a zero or missing divisor."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def percentage(part: Column, whole: Column, digits: int) -> Column:
    """``part`` in percent of ``whole``, rounded; an empty whole gives NULL, not an error."""
    return F.round(F.try_divide(part * F.lit(100), whole), digits)


def clip(value: Column, low: Column | int, high: Column | int) -> Column:
    """Keep ``value`` inside the bounds; NULL stays NULL (``greatest`` would skip it)."""
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    return F.when(value.isNotNull(), F.greatest(F.least(value, high), low))
