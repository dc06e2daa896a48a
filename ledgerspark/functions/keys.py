"""Document-key and small text functions (Column -> Column).

Everything here is a Catalyst expression, so it stays inside whole-stage
codegen. Regex classes are spelled out (``\\p{Nd}``, ``\\p{L}``) rather than
``\\D``/``\\W`` so that Java matches the Unicode semantics of the ledgers'
original Python code instead of its ASCII defaults.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Regex classes with the meaning Python gives to \D, \W and
# str.strip() on text.
NON_DIGIT = r"[^\p{Nd}]"
NON_WORD = r"[^\p{L}\p{N}_]"
EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
# A trailing ".0" (what a float-typed id turns into), allowing one final
# newline the way Python's "$" does.
TRAILING_POINT_ZERO = r"\.0(?=\n?\z)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Stringify a key the way ``Series.astype(str)`` does for the common types.

    Integral floats render as ``<int>.0`` (not Spark's ``1.2345678901E10``);
    other types use the plain cast. Null stays null.
    """
    c = _col(c)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        integral = (c == F.floor(c)) & (F.abs(c) < F.lit(1e16))
        return F.when(
            integral, F.concat(c.cast("decimal(38,0)").cast("string"), F.lit(".0"))
        ).otherwise(c.cast("string"))
    return c.cast("string")


def normalize_document(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """FN1, strict: drop a trailing ``.0``, keep decimal digits; null -> ''."""
    s = as_text(c, dtype)
    digits = F.regexp_replace(F.regexp_replace(s, TRAILING_POINT_ZERO, ""), NON_DIGIT, "")
    return F.coalesce(digits, F.lit(""))


def normalize_document_loose(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """FN2, loose: keep decimal digits only (``12.0`` -> ``120``); null -> ''."""
    s = as_text(c, dtype)
    return F.coalesce(F.regexp_replace(s, NON_DIGIT, ""), F.lit(""))


def strip_non_word(c: Column | str) -> Column:
    """FN4: keep letters, digits and underscore."""
    return F.regexp_replace(_col(c), NON_WORD, "")


def strip_text(c: Column | str) -> Column:
    """``str.strip()``: all leading/trailing Unicode whitespace."""
    return F.regexp_replace(_col(c), EDGE_SPACE, "")


def canonical_type(c: Column | str) -> Column:
    """FN5: strip + upper; null stays null (rules treat it as 'other')."""
    return F.upper(strip_text(c))


def int_id(c: Column | str) -> Column:
    """FN11: ``int(Id)`` rendered as text; unparseable/null -> null."""
    c = _col(c)
    as_long = F.coalesce(
        c.cast("string").try_cast("bigint"),
        c.cast("string").try_cast("double").try_cast("bigint"),
    )
    return as_long.cast("string")


def text_or_nan(c: Column | str) -> Column:
    """FN12: ``astype(str)`` where missing values print as ``nan``."""
    return F.coalesce(_col(c).cast("string"), F.lit("nan"))


def key_function(mode: str):
    """Pick a normaliser by name: ``strict`` (default) or ``loose``."""
    if mode == "strict":
        return normalize_document
    if mode == "loose":
        return normalize_document_loose
    raise ValueError(f"unknown key mode {mode!r}")
