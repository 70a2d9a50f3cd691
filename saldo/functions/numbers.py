"""Quotients that are exact at their stored scale."""

from __future__ import annotations


def ratio(num: str, den: str, scale: int) -> str:
    """num / den, rounded half away from zero once, at ``scale`` digits.

    Spark's own decimal quotient is already rounded at six digits, so a second rounding could
    land on the wrong side. Whole-number arithmetic avoids that: both operands need the same
    scale, and the result is counted in units of 10**-scale. A quotient that does not fit its
    type is an error, since ``div`` itself would wrap around.
    """
    too_large = f"abs({num}) >= abs({den}) * {10 ** (18 - scale)}BD"
    whole = f"(abs({num}) * {2 * 10**scale} + abs({den})) div (abs({den}) * 2)"
    units = f"(CASE WHEN {too_large} THEN raise_error('quotient out of range') ELSE {whole} END)"
    sign = f"(CASE WHEN ({num} < 0) != ({den} < 0) THEN -1 ELSE 1 END)"
    step = f"{10**-scale:.{scale}f}BD"
    return f"cast(cast({units} * {sign} AS decimal(18,0)) * {step} AS decimal(18,{scale}))"


def safe_ratio(num: str, den: str, scale: int) -> str:
    """Null where the divisor is null or zero."""
    return ratio(f"({num})", f"nullif({den}, 0)", scale)
