"""Defaults, null handling and small array helpers."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orgloom.schemas import ALL_MEMBERS, KEYWORD_MEMBERS, MISSING


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it several times inside ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def optional_column(df: DataFrame, name: str, default: str | None = "") -> Column:
    """The column, or the default when the input does not have it."""
    return F.col(f"`{name}`") if name in df.columns else F.lit(default).cast("string")


def or_missing(value: Column, default: str = MISSING) -> Column:
    return F.coalesce(value, F.lit(default))


def numbers_to_text(df: DataFrame) -> DataFrame:
    """Cast numeric columns to text so that they can hold the missing mark."""
    return df.select(
        *(
            F.col(f"`{f.name}`").cast("string").alias(f.name)
            if isinstance(f.dataType, T.NumericType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        )
    )


def fill_missing(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Write the missing mark into every NULL of the text columns."""
    wanted = set(df.columns if columns is None else columns)
    return df.select(
        *(
            or_missing(F.col(f"`{f.name}`")).alias(f.name)
            if f.name in wanted and isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        )
    )


def default_time(ts: Column, run_ts: str) -> Column:
    """A missing stamp becomes the run time, a parameter, so reruns agree."""
    return F.coalesce(ts, F.lit(run_ts))


def members_column(df: DataFrame, keyword: bool, name: str = "members") -> Column:
    """Choose the members column of the variant at hand."""
    return optional_column(df, KEYWORD_MEMBERS if keyword else ALL_MEMBERS, None).alias(name)
