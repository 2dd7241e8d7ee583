"""Column names: from whatever a file calls its fields to the canonical post fields.

All of this works on ``df.columns``; no rows are read.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postweave import settings


@dataclass(frozen=True)
class ColumnMatch:
    """What the mapping found: raw names, canonical field -> normalised raw name, real text fields."""

    original: tuple[str, ...]
    matched: dict[str, str]
    text_fields: tuple[str, ...]


def normalize_column_name(name: str) -> str:
    """Lower-case words joined by underscores."""
    words = re.sub(r"[^\w\s]", " ", str(name).strip().lower())
    return re.sub(r"\s+", "_", words).strip("_")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename all columns to their normalised names; a repeated name gets a numbered suffix."""
    names: list[str] = []
    for raw in df.columns:
        base = name = normalize_column_name(raw) or "column"
        copy = 1
        while name in names:
            copy += 1
            name = f"{base}_{copy}"
        names.append(name)
    return df.toDF(*names)


def match_fields(columns: Sequence[str], mapping: Mapping[str, str] | None = None) -> dict[str, str]:
    """Canonical field -> column, out of normalised column names.

    An explicit mapping replaces the default one. Fields it leaves open are looked for by alias.
    """
    present = set(columns)
    chosen = settings.DEFAULT_MAPPING if mapping is None else mapping
    found: dict[str, str] = {}
    for raw, field in chosen.items():
        name = normalize_column_name(raw)
        if name in present:
            found.setdefault(field, name)
    for field in settings.FIELD_ALIASES:
        names = map(normalize_column_name, settings.field_aliases(field))
        hit = next((name for name in names if name in present), None)
        if hit is not None:
            found.setdefault(field, hit)
    return found


def map_columns(df: DataFrame, mapping: Mapping[str, str] | None = None) -> tuple[DataFrame, ColumnMatch]:
    """Rename to canonical fields. Unmatched columns stay; one that is in the way gets ``_raw``.

    One raw column may serve several fields (an explicit map can ask for that).
    """
    original = tuple(df.columns)
    df = normalize_columns(df)
    found = match_fields(df.columns, mapping)
    used = set(found.values())
    taken = set(found)
    columns = [F.col(f"`{raw}`").alias(field) for field, raw in found.items()]
    for name in df.columns:
        if name not in used:
            columns.append(F.col(f"`{name}`").alias(f"{name}_raw" if name in taken else name))
    text_fields = tuple(f for f in settings.TEXT_FIELDS if f in found)
    return df.select(columns), ColumnMatch(original, found, text_fields)


def fill_optional(df: DataFrame) -> DataFrame:
    """Add the optional fields that are absent; nulls in present ones stay."""
    absent = {c: F.lit(v) for c, v in settings.OPTIONAL_DEFAULTS.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def check_fields(df: DataFrame, match: ColumnMatch) -> None:
    """Raise if a required field is absent or if no real text field was matched."""
    absent = [f for f in settings.REQUIRED_FIELDS if f not in df.columns]
    if absent:
        raise ValueError(f"required fields not found: {', '.join(absent)}; columns: {', '.join(match.original)}")
    if not match.text_fields:
        raise ValueError("no text field found: map a column to title or text")


def suggest_mapping(columns: Sequence[str]) -> dict[str, str | None]:
    """For each canonical field the raw column that would serve it, or None."""
    by_name = {normalize_column_name(c): c for c in columns}
    suggestion: dict[str, str | None] = {}
    for field in settings.FIELD_ALIASES:
        explicit = [raw for raw, target in settings.DEFAULT_MAPPING.items() if target == field]
        names = map(normalize_column_name, [*explicit, *settings.field_aliases(field)])
        suggestion[field] = next((by_name[n] for n in names if n in by_name), None)
    return suggestion


def align_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a stored table in its order: absent ones null, others dropped."""
    return df.select(
        [
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
