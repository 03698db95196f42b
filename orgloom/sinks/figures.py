"""Counts that are taken while a table is written, without a job of their own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Places(dict[str, str]):
    """Where results are, by name; ``figures`` are the counts taken on the way."""

    def __init__(self, places: dict[str, str] | None = None, figures: dict[str, int] | None = None):
        super().__init__(places or {})
        self.figures: dict[str, int] = dict(figures or {})


def counted(df: DataFrame, write: Callable[[DataFrame], None], **counts: Column) -> dict[str, int]:
    """Write ``df`` and return its number of rows and of those for which each condition holds."""
    seen = Observation()
    found = [F.count_if(condition).alias(name) for name, condition in counts.items()]
    write(df.observe(seen, F.count(F.lit(1)).alias("rows"), *found))
    return {name: int(seen.get[name]) for name in ("rows", *counts)}
