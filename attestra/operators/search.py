"""Searches with optional filters, pages of results, existence tests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: rows of a page.
PAGE = 50


def matches(df: DataFrame, equal: dict[str, object] | None = None, text: str = "", text_cols: Sequence[str] = ()) -> DataFrame:
    """Rows that meet every filter that is given; an empty one is no filter and leaves no trace in the plan."""
    for c, v in (equal or {}).items():
        if v not in (None, ""):
            df = df.where(F.col(c) == v)
    if text:
        pattern = "%" + text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_") + "%"
        hit = F.lit(False)
        for c in text_cols:
            hit = hit | F.coalesce(F.ilike(F.col(c), F.lit(pattern)), F.lit(False))
        df = df.where(hit)
    return df


def page(df: DataFrame, order: Sequence[Column | str], number: int = 1, size: int = PAGE) -> DataFrame:
    """One page of a total order; the pages before it are counted off, not returned."""
    return df.orderBy(*order).offset((max(1, number) - 1) * size).limit(size)


def pages(total: int, size: int = PAGE) -> int:
    return -(-total // size)


def exists_in_any(df: DataFrame, key: Sequence[str], conditions: Sequence[Column], details: Sequence[tuple[DataFrame, Column]]) -> DataFrame:
    """Rows that meet one of the conditions or have a detail row (same key) that meets its own."""
    own = F.lit(False)
    for c in conditions:
        own = own | F.coalesce(c, F.lit(False))
    ids = df.where(own).select(*key)
    for detail, condition in details:
        ids = ids.unionByName(detail.where(condition).select(*key))
    return df.join(ids.distinct(), list(key), "left_semi")


def without(df: DataFrame, other: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.join(other.select(*key), list(key), "left_anti")


def highlight(text: Column, pattern: str, left: str = "<mark>", right: str = "</mark>") -> Column:
    return F.regexp_replace(text, f"(?iu)({pattern})", f"{left}$1{right}")
