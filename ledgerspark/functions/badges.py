"""Presentation helpers that are plain column expressions (FN7-FN10, FN13)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Badge markup, colours, separator and ledger tags.
BADGE_TEMPLATE = "<span style='color:{color}'>{name}</span>"
PRESENT_COLOR = "green"
ABSENT_COLOR = "red"
BADGE_SEPARATOR = " | "
CNM_INCLUSION_TAG = "CNM"
CNM_OTHER_TAG = "CNM_EXCLUSAO"
INCLUSION = "INCLUSAO"


def or_placeholder(present: Column, value: Column, placeholder: str = "-") -> Column:
    """FN7: value of a ledger when it holds the document, else a placeholder.

    A present ledger whose value is null keeps the null.
    """
    return F.when(present, value).otherwise(F.lit(placeholder))


def priority_pick(*branches: tuple[Column, Column], placeholder: str = "-") -> Column:
    """FN8: first branch whose ledger is present wins; decided on presence, not nulls."""
    out = None
    for present, value in branches:
        out = F.when(present, value) if out is None else out.when(present, value)
    return out.otherwise(F.lit(placeholder))


def presence_badge(name: str, present: Column) -> Column:
    """FN9: coloured ledger name."""
    green = BADGE_TEMPLATE.format(color=PRESENT_COLOR, name=name)
    red = BADGE_TEMPLATE.format(color=ABSENT_COLOR, name=name)
    return F.when(present, F.lit(green)).otherwise(F.lit(red))


def join_badges(*named_flags: tuple[str, Column]) -> Column:
    """FN10: badges joined with `` | `` in the order given."""
    return F.concat_ws(BADGE_SEPARATOR, *[presence_badge(n, p) for n, p in named_flags])


def source_tag(tipo: Column) -> Column:
    """FN13: ``CNM`` when the raw movement type is exactly ``INCLUSAO``."""
    return F.when(tipo == F.lit(INCLUSION), F.lit(CNM_INCLUSION_TAG)).otherwise(F.lit(CNM_OTHER_TAG))
