"""Map heterogeneous raw columns to the canonical schema. Works on names only: no job runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

from postmill.functions.text import as_text
from postmill.schema import (
    CANONICAL_COLUMNS,
    CANONICAL_TYPES,
    COLUMN_SYNONYMS,
    ORDER_COLUMN,
    SALARY_TEXT_SYNONYMS,
)


@dataclass(frozen=True)
class ColumnMapping:
    """Raw name to target name, plus the raw column that holds salary text, if any."""

    targets: dict[str, str]
    salary_text: str | None = None


def plain_name(name: str) -> str:
    """Lower-case a column name and turn blanks, hyphens and dots into underscores."""
    return name.strip().translate(str.maketrans(" -.", "___")).lower()


_TARGET_OF = {plain_name(s): target for target, names in COLUMN_SYNONYMS.items() for s in names}


def map_columns(columns: Sequence[str], custom: Mapping[str, str] | None = None) -> ColumnMapping:
    """Choose a target for each raw column; every target is used at most once.

    Custom pairs come first and count only if the raw column exists and the target is
    canonical; the first of several pairs for one target counts. Then a column already carrying its target's own name is preferred, then the
    raw columns in order.
    """
    targets: dict[str, str] = {}
    taken: set[str] = set()
    for raw, target in (custom or {}).items():
        if raw in columns and target in CANONICAL_TYPES and target not in taken:
            targets[raw] = target
            taken.add(target)
    exact_first = sorted(columns, key=lambda c: c != _TARGET_OF.get(plain_name(c)))
    for raw in exact_first:
        target = _TARGET_OF.get(plain_name(raw))
        if raw not in targets and target is not None and target not in taken:
            targets[raw] = target
            taken.add(target)
    salary_text = None
    if not {"salary_min", "salary_max"} <= taken:
        free = (c for c in columns if c not in targets and plain_name(c) in SALARY_TEXT_SYNONYMS)
        salary_text = next(free, None)
    return ColumnMapping({c: targets[c] for c in columns if c in targets}, salary_text)


def _spelled(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _leftover(raw: str, used: set[str]) -> str:
    """Name of a column without a target: its own, unless Spark would take it for another one."""
    low = raw.lower()
    return f"{raw}__raw" if low in used or (raw != low and low in CANONICAL_TYPES) else raw


def normalize_columns(df: DataFrame, custom: Mapping[str, str] | None = None,
                      strict: bool = False) -> tuple[DataFrame, ColumnMapping]:
    """Rename, copy the salary text and add absent canonical columns as NULL, in one select.

    Columns without a target stay, unless ``strict``. One that would collide with a target, or
    with another canonical name but for its case, is kept as ``<name>__raw``: names are compared as Spark does.
    """
    mapping = map_columns([c for c in df.columns if c != ORDER_COLUMN], custom)
    used = set(mapping.targets.values())
    selected, present = [], set()
    for raw in df.columns:
        name = mapping.targets.get(raw)
        if name is None:
            if strict and raw != ORDER_COLUMN:
                continue
            name = _leftover(raw, used)
        selected.append(F.col(_spelled(raw)).alias(name))
        present.add(name.lower())
    if mapping.salary_text is not None:
        source = mapping.salary_text
        text = as_text(F.col(_spelled(source)), df.schema[source].dataType)
        selected.append(text.alias("raw_salary_string"))
    selected += [F.lit(None).cast(CANONICAL_TYPES[c]).alias(c) for c in CANONICAL_COLUMNS if c not in present]
    return df.select(*selected), mapping


def rename_columns(df: DataFrame, custom: Mapping[str, str] | None = None) -> DataFrame:
    """Text view of a source under the common names, ready to be united with other sources.

    The salary text gets the name "salary" whatever its own; arrays are joined by "|".
    """
    mapping = map_columns([c for c in df.columns if c != ORDER_COLUMN], custom)
    names = dict(mapping.targets)
    if mapping.salary_text is not None:
        names[mapping.salary_text] = "salary"
    selected = []
    for field in df.schema.fields:
        c = F.col(_spelled(field.name))
        if field.name == ORDER_COLUMN:
            selected.append(c)
            continue
        name = names.get(field.name, field.name)
        if field.name not in names:
            name = _leftover(field.name, set(names.values()))
        if isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.StringType):
            text = F.array_join(c, "|")
        else:
            text = as_text(c, field.dataType)
        selected.append(text.alias(name))
    return df.select(*selected)
