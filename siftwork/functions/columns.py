"""Column helpers: names, type classes, missing values, derived-feature expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def quoted(name: str) -> str:
    """Back-ticked name; column names may hold hyphens, blanks and dots."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns in schema order; booleans belong to no class."""
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def text_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in skip]


def float_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]


def nan_to_null(df: DataFrame) -> DataFrame:
    """One notion of missing: every NaN becomes null. Apply once, at the boundary."""
    floats = float_columns(df)
    if not floats:
        return df
    return df.withColumns({c: F.when(~F.isnan(col(c)), col(c)) for c in floats})


def tokens_to_null(df: DataFrame, tokens: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Text cells that spell a missing value (``NA``, ``null``, ...) become null."""
    names = list(columns) if columns is not None else text_columns(df)
    if not names or not tokens:
        return df
    return df.withColumns({c: F.when(~col(c).isin(*tokens), col(c)) for c in names})


def require_columns(df: DataFrame, names: Iterable[str], what: str = "column") -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing {what}(s): {missing}")


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """a / b, where a zero or missing divisor gives 0.0."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def scaled_by(column: Column, factor: float) -> Column:
    return F.coalesce(column.cast("double") * F.lit(float(factor)), F.lit(0.0))


def above(column: Column, threshold: float) -> Column:
    """1 when strictly above, else 0; missing is 0."""
    return F.coalesce((column > F.lit(float(threshold))).cast("int"), F.lit(0))


def log1p_floor(column: Column) -> Column:
    """log(1 + max(x, 0)); missing stays missing (``greatest`` alone would turn it into 0)."""
    return F.when(column.isNotNull(), F.log1p(F.greatest(column.cast("double"), F.lit(0.0))))


def within(column: Column, low: float, high: float) -> Column:
    """Closed interval test that lets missing values pass."""
    return column.isNull() | column.between(low, high)


def melt_aggregates(df: DataFrame, rows: Sequence[Sequence[Column]]) -> DataFrame:
    """One aggregate over ``df`` returned as one row per entry of ``rows``.

    Each entry lists aliased aggregate expressions (or literals); all entries
    share one scan and one partial/final aggregation.
    """
    packed = F.array(*[F.struct(*r) for r in rows])
    return df.agg(packed.alias("rows")).select(F.inline("rows"))
