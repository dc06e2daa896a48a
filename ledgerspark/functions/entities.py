"""FN3 ``html_unescape``: HTML5 character-reference decoding as a native expression.

Semantics follow the WHATWG "character reference" rules as Python's
``html.unescape`` applies them: every ``&`` may start a reference; numeric
references are decoded with the spec's remap of C1 controls, surrogates and
out-of-range values become U+FFFD, non-characters are dropped; named
references use the spec's entity table, and a name without ``;`` falls back to
the longest legacy prefix (``&ampx`` -> ``&x``).

The work is a ``split`` on ``&`` followed by staged ``transform``s over the
pieces, so rows never leave the JVM: (1) one regex finds the reference at the
start of each piece, (2) its code point or named lookup is computed once,
(3) the replacement text, (4) reassembly. Lambda bodies are evaluated without
common-subexpression elimination, hence the stages: every regex and lookup
runs at most once per piece. The named table is a map literal bucketed by
first character (Spark map lookups scan keys), and text with no ``&``
short-circuits to itself. The tables are built from the standard library's
copy of the spec table (``html.entities.html5``) and from the spec's rules,
not typed in.
"""

from __future__ import annotations

import json
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values from the HTML5 spec ("numeric character reference end state").
REPLACEMENT_CHAR = "�"
MAX_CODE_POINT = 0x10FFFF
SURROGATES = (0xD800, 0xDFFF)
# Characters a reference name may not contain, and its maximum length.
NAME_PATTERN = r"^[^\t\n\f <&#;]{1,32};?"
DEC_PATTERN = r"^#([0-9]+);?"
HEX_PATTERN = r"^#[xX]([0-9a-fA-F]+);?"
# The three alternatives together, tried in this order at the start of a piece.
REFERENCE_PATTERN = r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
# Longest entity name that is valid without a trailing semicolon.
MAX_LEGACY_NAME = 6


@lru_cache(maxsize=1)
def named_references() -> dict[str, str]:
    """Name (with or without ``;``) -> replacement text, per the HTML5 table."""
    from html.entities import html5

    return dict(html5)


@lru_cache(maxsize=1)
def legacy_references() -> dict[str, str]:
    """Names that are recognised without a semicolon (prefix fallback)."""
    return {k: v for k, v in named_references().items() if not k.endswith(";")}


@lru_cache(maxsize=1)
def numeric_remap() -> dict[int, str]:
    """Spec remap table: NUL -> U+FFFD, CR stays CR, 0x80-0x9F as windows-1252."""
    table = {0x00: REPLACEMENT_CHAR, 0x0D: "\r"}
    for n in range(0x80, 0xA0):
        try:
            table[n] = bytes([n]).decode("cp1252")
        except UnicodeDecodeError:
            table[n] = chr(n)  # undefined in windows-1252: kept as is
    return table


def is_dropped_code_point(n: Column) -> Column:
    """Control characters and non-characters that a numeric reference drops."""
    return (
        n.between(0x01, 0x08)
        | (n == 0x0B)
        | n.between(0x0E, 0x1F)
        | n.between(0x7F, 0x9F)
        | n.between(0xFDD0, 0xFDEF)
        | (F.bitwise_not(n).bitwiseAND(0xFFFE) == 0)  # U+xFFFE / U+xFFFF of any plane
    )


@lru_cache(maxsize=1)
def named_buckets() -> dict[str, dict[str, str]]:
    """The named table split by the first character of the name."""
    out: dict[str, dict[str, str]] = {}
    for k, v in named_references().items():
        out.setdefault(k[0], {})[k] = v
    return out


@lru_cache(maxsize=None)
def _map_json(name: str) -> tuple[str, str]:
    if name == "buckets":
        return json.dumps({k: dict(sorted(v.items())) for k, v in sorted(named_buckets().items())}), \
            "map<string,map<string,string>>"
    tables = {"named": named_references, "legacy": legacy_references, "remap": numeric_remap}
    table = tables[name]()
    return json.dumps({str(k): v for k, v in sorted(table.items())}), "map<string,string>"


def _map_literal(name: str) -> Column:
    """One JSON literal parsed into a map; Catalyst folds it to a constant once."""
    text, dtype = _map_json(name)
    return F.from_json(F.lit(text), dtype)


def code_point_to_text(n: Column) -> Column:
    """Text for a decoded code point (bigint, may be out of range)."""
    remapped = F.try_element_at(_map_literal("remap"), n.cast("string"))
    as_char = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    return (
        F.when(remapped.isNotNull(), remapped)
        .when(n.between(*SURROGATES) | (n > MAX_CODE_POINT), F.lit(REPLACEMENT_CHAR))
        .when(is_dropped_code_point(n), F.lit(""))
        .otherwise(as_char)
    )


def _digits_value(trimmed: Column, base: int) -> Column:
    """Value of a digit string without leading zeros, clamped above the code-point range."""
    too_long = F.length(trimmed) > (7 if base == 10 else 6)
    value = trimmed.try_cast("bigint") if base == 10 else F.conv(trimmed, 16, 10).try_cast("bigint")
    return F.when(too_long, F.lit(MAX_CODE_POINT + 1)).otherwise(F.coalesce(value, F.lit(0)))


def _field(s: Column, *names: str) -> list[Column]:
    return [s[n].alias(n) for n in names]


def _code_point(m: Column) -> Column:
    """Code point of a numeric reference text (``#65;``, ``#x41``); null for a named one."""
    is_num = m.startswith("#")
    is_hex = is_num & F.substr(m, F.lit(2), F.lit(1)).isin("x", "X")
    body = F.when(m.endswith(";"), F.left(m, F.length(m) - 1)).otherwise(m)
    digits = F.regexp_replace(F.when(is_hex, F.substr(body, F.lit(3))).otherwise(F.substr(body, F.lit(2))), "^0+", "")
    return F.when(is_hex, _digits_value(digits, 16)).when(is_num, _digits_value(digits, 10))


def _legacy_prefix(m: Column, legacy: Column) -> Column:
    """Longest semicolon-less name that is a proper prefix of ``m``, replaced, plus the rest of ``m``."""
    return F.coalesce(*[
        F.when(F.length(m) > k, F.concat(F.try_element_at(legacy, F.left(m, F.lit(k))), F.substr(m, F.lit(k + 1))))
        for k in range(MAX_LEGACY_NAME, 1, -1)
    ])


def html_unescape(c: Column | str) -> Column:
    """Decode all HTML5 character references in a string column."""
    c = F.col(c) if isinstance(c, str) else c
    buckets = _map_literal("buckets")
    legacy = _map_literal("legacy")
    pieces = F.split(c, "&", -1)
    # 1. the reference text at the start of every piece after an '&' (one regex run per piece)
    found = F.transform(pieces, lambda p, i: F.struct(
        p.alias("p"), F.when(i == 0, F.lit("")).otherwise(F.regexp_extract(p, REFERENCE_PATTERN, 1)).alias("m")))
    # 2. its code point, or its entry in the named table (one lookup, in the bucket of its first letter)
    looked_up = F.transform(found, lambda s: F.struct(
        *_field(s, "p", "m"),
        _code_point(s["m"]).alias("n"),
        F.try_element_at(F.try_element_at(buckets, F.left(s["m"], F.lit(1))), s["m"]).alias("full")))
    # 3. the replacement text of the reference (null: not a reference)
    replaced = F.transform(looked_up, lambda s: F.struct(
        *_field(s, "p", "m"),
        F.when(s["m"] == "", F.lit(None).cast("string"))
        .when(s["n"].isNotNull(), code_point_to_text(s["n"]))
        .when(s["full"].isNotNull(), s["full"])
        .otherwise(_legacy_prefix(s["m"], legacy)).alias("v")))
    # 4. reassemble
    parts = F.transform(replaced, lambda s, i: F.when(i == 0, s["p"])
                        .when(s["v"].isNull(), F.concat(F.lit("&"), s["p"]))
                        .otherwise(F.concat(s["v"], F.substr(s["p"], F.length(s["m"]) + 1))))
    return F.when(F.instr(c, "&") == 0, c).otherwise(F.array_join(parts, ""))
