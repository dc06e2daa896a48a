"""Scalar functions: every one is ``Column -> Column`` over built-in expressions (lambda bodies are interpreted)."""

from ledgerspark.functions.badges import (
    join_badges,
    or_placeholder,
    presence_badge,
    priority_pick,
    source_tag,
)
from ledgerspark.functions.dates import format_movement_date, parse_movement_timestamp
from ledgerspark.functions.entities import html_unescape
from ledgerspark.functions.keys import (
    canonical_type,
    int_id,
    key_function,
    normalize_document,
    normalize_document_loose,
    strip_non_word,
    strip_text,
    text_or_nan,
)

__all__ = [
    "canonical_type",
    "format_movement_date",
    "html_unescape",
    "int_id",
    "join_badges",
    "key_function",
    "normalize_document",
    "normalize_document_loose",
    "or_placeholder",
    "parse_movement_timestamp",
    "presence_badge",
    "priority_pick",
    "source_tag",
    "strip_non_word",
    "strip_text",
    "text_or_nan",
]
