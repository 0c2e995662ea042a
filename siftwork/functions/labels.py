"""Comma-separated label lists as native array expressions (no Python worker)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from siftwork.functions.aliases import COUNTRY_ALIASES

MAX_LOOKUP_ENTRIES = 5000


def strip(column: Column) -> Column:
    """Trim every kind of white space, as text tools do; ``trim`` removes blanks only."""
    return F.regexp_replace(column, r"(?U)^\s+|\s+$", "")


def lookup_map(entries: Mapping[str, str]) -> Column:
    """A constant map expression. Its size is bounded, so it travels inside the plan."""
    if len(entries) > MAX_LOOKUP_ENTRIES:
        raise ValueError(f"lookup of {len(entries)} entries exceeds {MAX_LOOKUP_ENTRIES}; join a table instead")
    if not entries:
        return F.expr("map('', cast(null as string))")
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def canonical_label(label: Column, aliases: Mapping[str, str] = COUNTRY_ALIASES) -> Column:
    """Alias lookup on the lower-cased, trimmed label; unknown labels keep their own spelling."""
    trimmed = strip(label)
    return F.coalesce(F.try_element_at(lookup_map(aliases), F.lower(trimmed)), trimmed)


def parse_labels(cell: Column, aliases: Mapping[str, str] = COUNTRY_ALIASES) -> Column:
    """Cell -> array of labels: empty and ``unknown`` parts go, duplicates and unmapped labels stay."""
    parts = F.transform(F.split(cell, ","), strip)
    kept = F.filter(parts, lambda p: (p != "") & (F.lower(p) != "unknown"))
    named = F.transform(kept, lambda p: canonical_label(p, aliases))
    return F.coalesce(named, F.expr("cast(array() as array<string>)"))


def iso_entries(iso: DataFrame, code_columns: list[str], name_column: str = "name") -> dict[str, str]:
    """Lookup entries (any code or the name itself, lower case -> name) from a country table.

    The table is the user's; its size is checked before it is brought in.
    """
    rows = iso.select(name_column, *code_columns).limit(MAX_LOOKUP_ENTRIES + 1).collect()
    if len(rows) > MAX_LOOKUP_ENTRIES:
        raise ValueError(f"country table has more than {MAX_LOOKUP_ENTRIES} rows")
    entries: dict[str, str] = {}
    for row in sorted(rows, key=lambda r: r[name_column]):
        for key in (*code_columns, name_column):
            if row[key] is not None:
                entries.setdefault(str(row[key]).lower(), row[name_column])
    return entries


def strict_entries(iso_names: Mapping[str, str], aliases: Mapping[str, str] = COUNTRY_ALIASES) -> dict[str, str]:
    """One lookup that resolves aliases first, then the country table.

    A country-table name that is itself an alias, or spells a canonical name in
    another case, takes the canonical spelling.
    """
    spelling = {v.lower(): v for v in aliases.values()}
    resolved = dict(aliases)
    for key, name in iso_names.items():
        lowered = name.lower()
        resolved.setdefault(key, aliases.get(lowered, spelling.get(lowered, name)))
    return resolved


def strict_text(label: Column) -> Column:
    """Lower, trim, drop every ``en:``, turn ``-`` into a blank."""
    return F.replace(F.replace(strip(F.lower(label)), F.lit("en:"), F.lit("")), F.lit("-"), F.lit(" "))


def strict_label(label: Column, entries: Mapping[str, str]) -> Column:
    """The strict text looked up; unknown gives null."""
    text = strict_text(label)
    return F.when(text != "", F.try_element_at(lookup_map(entries), text))


def clean_list(cell: Column, entries: Mapping[str, str]) -> Column:
    """Sorted distinct canonical labels joined by commas; nothing recognised gives ``unknown``."""
    found = F.filter(F.transform(F.split(cell, ","), lambda p: strict_label(p, entries)), lambda p: p.isNotNull())
    joined = F.array_join(F.array_sort(F.array_distinct(found)), ",")
    return F.when(cell.isNull() | (cell == "unknown") | (joined == ""), "unknown").otherwise(joined)
