"""Numeric casts and exact percentages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from casetrace.schema import SCORE_MAX, SCORE_MIN


# Sign, digits before and after the point, exponent.
_NUMBER = r"^([+-]?)(\d*)\.?(\d*)(?:[eE]([+-]?\d{1,5}))?$"


def parse_score(text: Column | str) -> Column:
    """Text -> NUMBER(2) as int: rounded half away from zero, NULL when it is
    not a number or falls outside -99..99 (never raises).

    Texts of up to ten characters without an exponent fit a decimal as they
    are.  Of others the first digit after the point decides, so a text of any
    length is rounded once.
    """
    col = F.trim(F.col(text) if isinstance(text, str) else text)
    plain = (F.length(col) <= 10) & ~col.contains("e") & ~col.contains("E")
    rounded = F.round(F.nullif(col, F.lit("")).try_cast("decimal(38,10)"), 0)
    return F.when(plain, F.when(rounded.between(SCORE_MIN, SCORE_MAX), rounded.cast("int"))
                  ).otherwise(_score_of_digits(col))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _score_of_digits(col: Column) -> Column:
    def parts(t: Column) -> Column:
        sign, whole, fraction, exponent = [F.regexp_extract(t, _NUMBER, i) for i in (1, 2, 3, 4)]
        power = F.coalesce(F.nullif(exponent, F.lit("")).try_cast("int"), F.lit(0))
        return _let(F.concat(whole, fraction), lambda digits: _let(
            F.regexp_replace(digits, "^0+", ""), lambda leading: rounded(
                sign, leading, F.length(whole) - F.length(digits) + F.length(leading) + power)))

    def rounded(sign: Column, leading: Column, point: Column) -> Column:
        """``point`` digits stand before the point; beyond two it is too large."""
        def size(near: Column) -> Column:
            padded = F.concat(F.when(near < 0, F.lit("0")).otherwise(F.lit("")), leading, F.lit("000"))
            kept = F.greatest(near, F.lit(0))
            units = F.nullif(F.substring(padded, F.lit(1), kept), F.lit("")).cast("int")
            up = (F.substring(padded, kept + 1, F.lit(1)) >= "5").cast("int")
            return F.when(F.length(leading) == 0, F.lit(0)).when(near <= 2, F.coalesce(units, F.lit(0)) + up)

        value = _let(F.least(F.greatest(point, F.lit(-1)), F.lit(3)), size)
        return F.when(sign == "-", -value).otherwise(value)

    value = F.when(col.rlike(_NUMBER) & col.rlike(r"^[+-]?\.?\d"), _let(col, parts))
    return F.when(value.between(SCORE_MIN, SCORE_MAX), value)


def exact_percent(part: Column | str, whole: Column | str) -> Column:
    """``round(part / whole * 100, 2)`` rounded half away from zero, computed in
    integers so no binary-double error can flip the last digit.

    ``floor((20000 * part + whole) / (2 * whole)) / 100`` for non-negative
    counts; NULL when ``whole`` is 0 or NULL.
    """
    p = (F.col(part) if isinstance(part, str) else part).cast("long")
    w = (F.col(whole) if isinstance(whole, str) else whole).cast("long")
    hundredths = F.call_function("div", p * 20000 + w, F.nullif(w * 2, F.lit(0)))
    return hundredths.cast("double") / F.lit(100.0).cast("double")
