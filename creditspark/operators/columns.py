"""Plan-time column work: names, renames, lookups by candidate, optional columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T


def normalize_columns(df: DataFrame) -> DataFrame:
    """Names stripped and lower-cased, spaces and hyphens as underscores; dots stay."""
    table = str.maketrans(" -", "__")
    return df.toDF(*[name.strip().lower().translate(table) for name in df.columns])


def rename_present(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename the columns that exist; the rest of the map is ignored."""
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def resolve_column(
    df: DataFrame,
    candidates: list[str],
    containing: tuple[str, ...] = (),
    position: int | None = None,
) -> str | None:
    """First candidate present, else first name holding every fragment, else by position."""
    for name in candidates:
        if name in df.columns:
            return name
    if containing:
        for name in df.columns:
            if all(part in name.lower() for part in containing):
                return name
    return None if position is None else df.columns[position]


def column_or(df: DataFrame, name: str | None, default) -> Column:
    return F.lit(default) if name is None else F.col(f"`{name}`")


def derive_if_absent(df: DataFrame, source: str, targets: list[str]) -> DataFrame:
    """Add double copies of ``source`` under ``targets``, unless the first is there already."""
    if targets[0] in df.columns or source not in df.columns:
        return df
    return df.withColumns({t: F.col(source).cast("double") for t in targets})


def lookup(value: Column, dtype: T.DataType, mapping: dict[str, str], default: str) -> Column:
    """Dictionary lookup on text or whole-number codes; anything else gets the default."""
    if isinstance(dtype, T.NumericType):
        whole = value.try_cast("long")
        key = F.when(value == whole, whole.cast("string"))
    else:
        key = value.cast("string")
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(table, key), F.lit(default))


def shared_columns(left: DataFrame, right: DataFrame, wanted: list[str]) -> list[str]:
    return [c for c in wanted if c in left.columns and c in right.columns]


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Stack tables by column name; columns missing on one side become null."""
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out
