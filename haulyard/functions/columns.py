"""Column helpers shared by all plans. All are built-in expressions, so they stay in generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulyard.constants import TRUTHY_TEXT

LETTER = r"[\p{Lu}\p{Ll}\p{Lt}]"
GLUED = rf"([^\p{{Lu}}\p{{Ll}}\p{{Lt}} ])(?={LETTER})"  # a letter right after a non-letter other than space
SEAM = "\ue000 "  # private-use character and space: makes such a letter start a word


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(c: Column | str) -> Column:
    """Double, with unreadable text and NaN both turned into NULL."""
    value = _col(c).try_cast("double")
    return F.when(~F.isnan(value), value)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it fails or is unknown."""
    return F.when(condition, 1).otherwise(0)


def violates(condition: Column) -> Column:
    """True where a required condition fails or is unknown."""
    return ~F.coalesce(condition, F.lit(False))


def clip(c: Column | str, low: float, high: float) -> Column:
    """Limit to [low, high]; NULL stays NULL (greatest/least alone would skip it)."""
    value = _col(c)
    return F.when(value.isNotNull(), F.greatest(F.least(value, F.lit(float(high))), F.lit(float(low))))


def cut(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the right-closed interval (edge, next edge] holding the value, else 'nan'."""
    value = _col(c)
    ladder = None
    for low, high, label in zip(edges[:-1], edges[1:], labels):
        inside = (value > F.lit(float(low))) & (value <= F.lit(float(high)))
        ladder = F.when(inside, label) if ladder is None else ladder.when(inside, label)
    return ladder.otherwise("nan")


def rounded(c: Column | str, digits: int) -> Column:
    """Scale, round half to even, scale back: the rounding of array libraries."""
    scale = F.lit(float(10**digits))
    return F.rint(_col(c) * scale) / scale


def half_up(c: Column | str, digits: int) -> Column:
    """SQL rounding (half away from zero on the decimal value)."""
    return F.round(_col(c), digits)


def ratio(top: Column, bottom: Column) -> Column:
    """Division giving NULL for a zero divisor instead of an error."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def share_pct(top: Column, bottom: Column, digits: int = 1) -> Column:
    """Percentage rounded to ``digits``; 0 for an empty base."""
    return F.coalesce(rounded(ratio(top, bottom) * F.lit(1e2), digits), F.lit(0.0))


def title_case(c: Column | str) -> Column:
    """Capitalise the first letter after every non-letter ('l&t goods' becomes 'L&T Goods').

    initcap starts words at spaces only. Texts with letters after other characters get a seam
    there first, which is removed again; most texts have none and skip that.
    """
    value = _col(c)
    seamed = F.initcap(F.regexp_replace(value, GLUED, f"$1{SEAM}"))
    return F.when(value.rlike(GLUED), F.replace(seamed, F.lit(SEAM), F.lit(""))).otherwise(F.initcap(value))


def clean_title(c: Column | str) -> Column:
    return F.trim(title_case(c))


def clean_upper(c: Column | str) -> Column:
    return F.trim(F.upper(_col(c)))


def truthy(c: Column | str) -> Column:
    """True for a true boolean and for the texts that mean true."""
    return F.coalesce(_col(c).cast("string").isin(TRUTHY_TEXT), F.lit(False))


def as_timestamp(df: DataFrame, name: str, strict: bool = False) -> Column:
    """UTC instant from ISO text or any timestamp type; unreadable text is NULL unless ``strict``."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return F.to_timestamp(F.col(name)) if strict else F.try_to_timestamp(F.col(name))
    return F.col(name).cast("timestamp")


def night_shift(hour: Column) -> Column:
    return flag((hour >= 20) | (hour <= 5))


def has(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The wanted names the frame really has, in the wanted order."""
    present = set(df.columns)
    return [n for n in names if n in present]
