"""Header operators SCH1-SCH5.

Headers are metadata: they are resolved on the driver, once per distinct raw
header (a "signature"), never per row. ``resolve_header`` chains the steps the
way the status-export intake does: decode -> de-duplicate -> alias, then keep
the first of equal names.
"""

from __future__ import annotations

import html
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Residues in exported headers and the text that each stands for.
RESIDUES = {
    "+ACI-": "",
    "+AC0-": "-",
    "\"": "",
}

# Canonical column names per header spelling (current intake).
CURRENT_ALIASES = {
    "Documento": "documento",
    "Devedor": "devedor",
    "Unique ID": "unique_id",
    "Data Inclusão": "data",
    "Data Inclusao": "data",
    "Data Exclusão": "data",
}
# The legacy intake also maps the UTF-7 residue spellings.
LEGACY_ALIASES = {
    "+//3//f/9-Unique ID": "unique_id",
    "Documento": "documento",
    "Devedor": "devedor",
    "Data Inclus+//3//Q-o": "data",
}
ALL_ALIASES = {**CURRENT_ALIASES, **LEGACY_ALIASES}

_RESIDUE = re.compile("|".join(map(re.escape, RESIDUES)))


def decode_header(name: str | None) -> str:
    """SCH1 for one name: entities decoded, then every residue of the table in one pass, edges stripped."""
    text = html.unescape(name or "")
    return _RESIDUE.sub(lambda m: RESIDUES[m.group()], text).strip()


def decode_headers(names: list[str]) -> list[str]:
    """SCH1."""
    return [decode_header(n) for n in names]


def dedup_headers(names: list[str | None]) -> list[str]:
    """SCH2: position by position, the n-th occurrence of a name is named ``<name>.<n-1>`` (the first stays).

    A missing name counts as the empty one.
    """
    plain = ["" if n is None else n for n in names]
    earlier = [plain[:i].count(n) for i, n in enumerate(plain)]
    return [f"{n}.{k}" if k else n for n, k in zip(plain, earlier, strict=True)]


def alias_headers(names: list[str], aliases: dict[str, str] = ALL_ALIASES) -> list[str]:
    """SCH3/SCH4: canonical names; unknown names are kept."""
    return [aliases.get(n, n) for n in names]


def first_of_duplicates(names: list[str]) -> list[int]:
    """SCH5: positions to keep so that each name appears once (its leftmost column)."""
    seen, keep = set(), []
    for i, n in enumerate(names):
        if n not in seen:
            seen.add(n)
            keep.append(i)
    return keep


def resolve_header(raw: list[str], aliases: dict[str, str] = ALL_ALIASES) -> tuple[list[str], list[int]]:
    """Read-time de-duplication, then SCH1 -> SCH2 -> SCH3/4 -> SCH5.

    Returns the final names and the column positions they come from.
    """
    names = alias_headers(dedup_headers(decode_headers(dedup_headers(raw))), aliases)
    keep = first_of_duplicates(names)
    return [names[i] for i in keep], keep


def apply_header(df: DataFrame, raw: list[str], aliases: dict[str, str] = ALL_ALIASES) -> DataFrame:
    """Rename a positional (``_c0`` …) frame by its raw header and drop repeated names."""
    names, keep = resolve_header(raw, aliases)
    cols = df.columns
    return df.select(*[F.col(cols[i]).alias(n) for i, n in zip(keep, names) if i < len(cols)])
