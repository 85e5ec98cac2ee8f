"""Text helpers: padded ids and numbers as they appear in messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import _col


def padded_id(prefix: str, number: Column | str, width: int) -> Column:
    """``prefix`` and the number (not negative), zero-padded to ``width``; NULL gives NULL.

    Padding by ``lpad`` costs a fraction of ``format_string``, which parses its pattern
    for every row. ``lpad`` would cut longer numbers, so it only runs on shorter ones.
    """
    digits = _col(number).cast("bigint").cast("string")
    padded = F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)
    return F.concat(F.lit(prefix), padded)


def trailing_number(identifier: Column | str, prefix: str) -> Column:
    """The number behind ``prefix`` in an id."""
    return F.substring(_col(identifier), len(prefix) + 1, 2**31 - 1).cast("bigint")


def _without_exponent(value: Column, scale: int) -> Column:
    text = value.cast(f"decimal(38,{scale})").cast("string")
    return F.regexp_replace(text, r"\.?0+$", "")


def plain_number(
    value: Column | str, missing: str = "null", whole_suffix: str = "",
    *, plain_from: float = 1e-6, plain_below: float = 1e21, exponent_digits: int = 1,
) -> Column:
    """A DOUBLE as people write it: ``280``, ``0.5``, ``3758439620.06``.

    Magnitudes outside ``plain_from`` .. ``plain_below`` keep an exponent (``1e+22``), padded to
    ``exponent_digits``. ``missing`` stands for NULL; ``whole_suffix`` is put behind whole numbers.
    """
    value = _col(value).cast("double")
    size = F.abs(value)
    exponent = F.regexp_replace(value.cast("string"), r"(\.0)?E(\d)", r"e+$2")
    exponent = F.regexp_replace(exponent, r"(\.0)?E-", "e-")
    if exponent_digits > 1:
        exponent = F.regexp_replace(exponent, r"e([+-])(\d)$", "e$1" + "0" * (exponent_digits - 1) + "$2")
    return (
        F.when(value.isNull(), F.lit(missing))
        .when(value == 0, F.lit("0" + whole_suffix))
        .when((size >= plain_below) | (size < plain_from), exponent)
        .when(value == F.rint(value), F.concat(value.cast("decimal(38,0)").cast("string"), F.lit(whole_suffix)))
        .when(size >= 1, _without_exponent(value, 16))
        .otherwise(_without_exponent(value, 24))
    )
