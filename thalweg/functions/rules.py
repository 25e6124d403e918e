"""Attribute rules: coercion, outlets, clamps, exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OUTLET = -9999


def number(c: Column, default: float = 0.0) -> Column:
    """As a double; the default where that fails, is null or NaN."""
    return F.nanvl(F.coalesce(c.try_cast("double"), F.lit(default)), F.lit(default))


def is_outlet(c: Column, sentinel: int = OUTLET) -> Column:
    """A downstream id that is the sentinel, not positive, or no number."""
    n = c.cast("string").try_cast("bigint")
    return F.coalesce((n == sentinel) | (n <= 0), F.lit(True))


def clamp_slope(c: Column, least: float) -> Column:
    """At least ``least``; slopes of 1 or more are errors and become it."""
    value = number(c)
    return F.when(value >= 1.0, F.lit(least)).otherwise(F.greatest(value, F.lit(least)))


def clamp_length(c: Column, least: float) -> Column:
    return F.greatest(number(c), F.lit(least))


def unit_interval(c: Column) -> Column:
    """A share, held from 0 to 1."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), number(c)))


def lake_id(name: Column, fallback: Column | None = None) -> Column:
    """The number in ``Lake_<number>``; else the fallback, else -1."""
    found = F.regexp_extract(F.coalesce(name, F.lit("")), r"Lake_(\d+)", 1).try_cast("bigint")
    return F.coalesce(found, F.lit(-1).cast("bigint")) if fallback is None else F.coalesce(found, fallback.try_cast("bigint"), F.lit(-1).cast("bigint"))


def has_text(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit(""))) != ""


def role_mask(outlet: Column, gauge: Column, lake: Column) -> Column:
    """3 lake, 2 gauge, 1 outlet, 0 none; the highest counts."""
    return F.when(lake, 3).when(gauge, 2).when(outlet, 1).otherwise(0)


def rounded(c: Column, places: int) -> Column:
    """Half to even on the binary value."""
    scale = float(10**places)
    return F.rint(c * scale) / scale


def short_name(name: str) -> str:
    """The name that a ten-letter attribute table keeps."""
    return name[:10]


def export(df: DataFrame, places: int = 3, unrounded: tuple[str, ...] = ("Slope",)) -> DataFrame:
    """Numbers without nulls: floats 0 and rounded, but for ``unrounded``, integers -1; others unchanged."""
    out = []
    for f in df.schema:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = number(c)
            c = c if f.name in unrounded else rounded(c, places)
        elif isinstance(f.dataType, (T.LongType, T.IntegerType, T.ShortType)):
            c = F.coalesce(c, F.lit(-1).cast(f.dataType))
        out.append(c.alias(f.name))
    return df.select(*out)


def require(df: DataFrame, names: list[str], what: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns: {', '.join(missing)}")


def with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Adds the columns that are absent."""
    return df.withColumns({k: F.lit(v) for k, v in defaults.items() if k not in df.columns})
