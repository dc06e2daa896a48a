"""Secret scan by assignment-aware lexing.

Two layers give code point spans. The base kinds ``assign``, ``access`` and ``hex``
are fixed patterns. The method adds ``literal`` spans: a text is lexed as source or
configuration syntax into name-literal pairs (``name = "literal"``, ``name: literal``,
``"name": "literal"``, ``<name>literal</name>``, ``NAME=literal`` in shell and ini
lines, joined literals ``"a" + "b"``, and typed forms: ``name: type = "literal"``,
``var name type = "literal"``, ``type name[] = "literal"``), names assigned from other names take their
literal (constant propagation, to a fixed point, within one document), and each
literal is scored by how sensitive the names are that it reaches and how random it
looks. A literal of score ``THRESHOLD`` or more is a secret.

A document is read whole; the work is per document, so nothing is shuffled.
Documents whose letters and digits, read line by line without what stands between them,
hold no sensitive word skip the lexer: no literal in them can reach a sensitive name.

Defined results: null counts as empty and has no spans; equal spans of one kind are
listed once; spans of different kinds may overlap; repeated rows repeat their
results; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm.blocks import slices
from ledgerspark.llm.common import table

KINDS = ("assign", "access", "hex", "literal")
THRESHOLD = 1.0

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_LEAST = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
HINTS = ("passw", "secret", "token", "key")

# Parts of names and how sensitive they make a name.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.9, "credential": 0.9,
    "credentials": 0.9, "apikey": 1.0, "privatekey": 1.0, "accesskey": 1.0, "secretkey": 1.0, "authkey": 1.0,
    "signingkey": 1.0, "encryptionkey": 1.0, "bearer": 0.8, "authorization": 0.7, "passcode": 0.9,
}
# Values that stand for a secret without being one.
PLACEHOLDERS = ("example", "changeme", "placeholder", "your", "xxxx", "****", "todo", "none", "null", "true", "false",
                "dummy", "redacted")
# A sensitive name holds one of these when only its letters and digits are read, as ``sensitivity`` joins its parts.
HINT_WORDS = tuple(w.encode() for w in SENSITIVE if not any(v != w and v in w for v in SENSITIVE))
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BETWEEN = bytes(c for c in range(128) if not chr(c).isalnum() and c != 10)

_STRINGS = {'"': r'"(?:[^"\\\n]|\\.)*"', "'": r"'(?:[^'\\\n]|\\.)*'"}
_TOKENS = r"""
    (?P<string>STRINGS)
  | (?P<tag><(?P<tagname>[A-Za-z_][\w.-]*)>(?P<tagtext>[^<>\n]+)</)
  | (?P<name>[A-Za-z_$][\w$]*(?:[.-][A-Za-z_$][\w$]*)*)
  | (?P<assign>:=|=>|=(?!=)|:(?!:))
  | (?P<join>\+|\.\.)
  | (?P<end>[;\n])
  | (?P<other>[^\s])
"""
# The lexer by the quote signs that may still open a string on the line at hand.
_LEX = {signs: re.compile(_TOKENS.replace("STRINGS", "|".join(_STRINGS[c] for c in signs) or "(?!)"), re.X | re.A)
        for signs in ("\"'", '"', "'", "")}
_BARE = re.compile(r"[^\s\"'`,;<>(){}\[\]]+")
_NAME = re.compile(r"[A-Za-z_$][\w$]*(?:\.[A-Za-z_$][\w$]*)*\Z", re.A)

# Types: names with generics, brackets and marks, unions of them, quoted ones; up to the ``=`` that follows. Nothing is tried twice.
_IN = r"[^<>\[\]\n=]"
_ARGS = rf"(?:<{_IN}*>|\[{_IN}*\])"
for _ in range(2):
    _ARGS = rf"(?:<(?:{_IN}|{_ARGS})*>|\[(?:{_IN}|{_ARGS})*\])"
_MARKS = r"(?:&(?:'[A-Za-z_]\w*[ \t]+)?(?:mut[ \t]+)?|\*(?:const[ \t]+|mut[ \t]+)?|\[\d*\]|\?|readonly[ \t]+)*+"
_WORD = r"[A-Za-z_$][\w$]*(?:(?:\.|::)[A-Za-z_$][\w$]*)*"
_ONE = rf"""(?>{_MARKS}(?:{_WORD}|{_ARGS})(?:{_ARGS})*+[?!*]*+|"[^"\n=]*"|'[^'\n=]*')"""
_SIGN = r"[ \t]*(?==(?![=>]))"
_TYPE = re.compile(rf"[ \t]*{_ONE}(?:[ \t]*+[|&][ \t]*+{_ONE})*+{_SIGN}", re.A)
_DECLARED = re.compile(rf"[ \t]+({_WORD})[ \t]+{_ONE}{_SIGN}", re.A)  # after var or const: a name, then a type
_PLAIN_TYPE = re.compile(rf"[ \t]+(?:\*|\[\d*\])*(?:string|byte|rune|any|error|interface[ \t]*\{{\}}){_SIGN}", re.A)
_BEFORE_NAME = frozenset(("var", "const", "let", "static", "final", "unsigned", "signed", "char", "public", "private", "protected"))
_INDEX = re.compile(r"[ \t]*([\w$][\w$ \t.+*-]*)?\]", re.A)  # after an opening bracket
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def sensitivity(name: str) -> float:
    """How sensitive a target name is: its words, or two neighbouring words joined."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    pairs = [a + b for a, b in zip(parts, parts[1:], strict=False)]
    return max((SENSITIVE.get(p, 0.0) for p in [*parts, *pairs, "".join(parts)]), default=0.0)


def randomness(literal: str) -> float:
    """0 to 1: length, mixture of character classes and entropy of a literal."""
    n = len(literal)
    if n < 8 or any(p in literal.lower() for p in PLACEHOLDERS) or any(c.isspace() for c in literal):
        return 0.0
    if len(set(literal)) < 5:
        return 0.0
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(literal).values())
    classes = sum((any(c.islower() for c in literal), any(c.isupper() for c in literal),
                   any(c.isdigit() for c in literal), any(not c.isalnum() for c in literal)))
    if classes < 2:
        return 0.0
    return min(1.0, entropy / 4 * (0.6 + 0.2 * classes) * min(1.0, 0.7 + n / 40))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns."""
    out = []
    low = text.lower()
    if any(h in low for h in HINTS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


def pairs(text: str) -> tuple[list[tuple[str, list[tuple[int, int]]]], list[tuple[str, str]]]:
    """Name-literal pairs (the literal as its pieces' spans) and name-name assignments, in text order."""
    literals: list[tuple[str, list[tuple[int, int]]]] = []
    aliases: list[tuple[str, str]] = []
    target: str | None = None  # last name or string that could be assigned to
    pieces: list[tuple[int, int]] = []
    waiting = False  # after an assignment sign or a join
    current: str | None = None
    at, n = 0, len(text)
    # where the lines end on which a quote of each sign was found open: an open quote has passed all later ones of its sign as
    # escaped, so none of those can open a string either, and no line is searched again for each of its quotes
    open_to = {'"': 0, "'": 0}

    def close() -> None:
        nonlocal pieces, current
        if current is not None and pieces:
            literals.append((current, pieces))
        pieces, current = [], None

    while at < n:
        m = _LEX["".join(c for c, to in open_to.items() if at >= to)].search(text, at)
        if m is None:
            break
        kind, at = m.lastgroup, m.end()
        if kind == "other" and m.group() in open_to and at > open_to[m.group()]:
            stop = text.find("\n", at)
            open_to[m.group()] = stop if stop >= 0 else n
        if m.group("tag"):
            close()
            literals.append((m.group("tagname"), [m.span("tagtext")]))
            target, waiting = None, False
        elif kind == "assign":
            typed = _TYPE.match(text, at) if target is not None and m.group() == ":" else None
            if typed:  # the name keeps waiting for the sign after its type
                at = typed.end()
            elif target is not None:
                close()
                current, waiting, target = target, True, None
                rest = _BARE.match(text, _blanks(text, at))
                if rest and not _NAME.match(rest.group()):  # a bare configuration value
                    pieces.append(rest.span())
                    at, waiting = rest.end(), False
                    close()
        elif kind == "string":
            if waiting and current is not None:
                pieces.append((m.start() + 1, m.end() - 1))
                waiting = False
                target = None
            else:
                close()
                target = m.group()[1:-1]
        elif kind == "name":
            if waiting and current is not None:
                aliases.append((current, m.group()))
                pieces, waiting, current = [], False, None
                target = None
            else:
                close()
                target = m.group()
                declared = _DECLARED.match(text, at) if target in ("var", "const") else None
                if declared:
                    name, kept = declared.group(1), text[declared.end(1):declared.end()]
                    # "const a b =" may be type and name as well
                    if name not in _BEFORE_NAME and (target == "var" or _PLAIN_TYPE.match(text, declared.end(1))
                                                     or sensitivity(name) > sensitivity(kept)):
                        target, at = name, declared.end()
                elif target not in _BEFORE_NAME:
                    plain = _PLAIN_TYPE.match(text, at)
                    at = plain.end() if plain else at
        elif kind == "join":
            waiting = bool(pieces)
        elif target is not None and m.group() == "[" and (index := _INDEX.match(text, at)):
            at, inner = index.end(), (index.group(1) or "").strip()
            if inner and not inner[0].isdigit() and sensitivity(inner) >= sensitivity(target):
                target = inner
        elif target is not None and m.group() in "?!" and text.startswith(":", at):
            pass  # an optional name
        else:
            if kind == "end" and waiting and not pieces:
                waiting, current = False, None
            close()
            target = None if kind == "end" else target if m.group() in "]*" else None
            waiting = waiting and current is not None
    close()
    return literals, aliases


def _blanks(text: str, at: int) -> int:
    while at < len(text) and text[at] in " \t":
        at += 1
    return at


def literal_spans(text: str) -> list[tuple[int, int, str]]:
    """Literals that reach a sensitive name and look like a secret."""
    solid = text.encode("ascii", "ignore").translate(_LOWER, _BETWEEN)
    if not any(w in solid for w in HINT_WORDS):
        return []
    literals, aliases = pairs(text)
    reach: dict[str, float] = {}  # name -> how sensitive the most sensitive name is that takes its value
    for name, _ in literals:
        reach[name] = sensitivity(name)
    for target, source in aliases:
        reach.setdefault(target, sensitivity(target))
        reach.setdefault(source, sensitivity(source))
    sources: dict[str, set[str]] = {}
    for target, source in aliases:
        sources.setdefault(target, set()).add(source)
    todo = sorted((n for n in sources if reach[n] > 0), key=lambda n: (-reach[n], n))
    while todo:  # a name is looked at again only when its value rises
        nxt = []
        for target in todo:
            for source in sources.get(target, ()):
                if reach[source] < reach[target]:
                    reach[source] = reach[target]
                    nxt.append(source)
        todo = nxt
    out = []
    for name, spans in literals:
        value = "".join(text[a:b] for a, b in spans)
        if reach[name] + randomness(value) >= 1 + THRESHOLD / 2 and randomness(value) >= 0.5:
            out += [(a, b, "literal") for a, b in spans if b > a]
    return out


def scan(text: str | None) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans and all spans of one text, by start, then kind as listed, then end."""
    text = text or ""
    order = lambda s: (s[0], KINDS.index(s[2]), s[1])
    base = sorted(set(base_spans(text)), key=order)
    return base, sorted({*base, *literal_spans(text)}, key=order)


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def redacted(text: str, spans: list[tuple[int, int, str]], mark: str = "[SECRET]") -> str:
    """``text`` with every union of spans replaced by ``mark``."""
    out, at = [], 0
    for a, b, _ in sorted(spans):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]]) if out else text


SCHEMA = ("spans array<struct<start:long,end:long,kind:string>>, n_assign long, n_access long, n_hex long, "
          "base_sha256 string, listed string, redacted string")
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        cols: list[list] = [[] for _ in range(7)]
        for t in batch.column(1):
            text = t.as_py()
            base, found = scan(text)
            count = Counter(k for _, _, k in base)
            row = ([{"start": a, "end": b, "kind": k} for a, b, k in found], count["assign"], count["access"], count["hex"],
                   sha256(listed(base).encode()).hexdigest(), listed(found), None if text is None else redacted(text, found))
            for c, v in zip(cols, row, strict=True):
                c.append(v)
        kinds = [_SPANS, *[pa.int64()] * 3, *[pa.string()] * 3]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
            names=["key", "spans", "n_assign", "n_access", "n_hex", "base_sha256", "listed", "redacted"])


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, all ``spans``, counts and digest of the base kinds, the spans as text, and the redacted text."""
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(
        _scan, f"key {kind}, {SCHEMA}").withColumnRenamed("key", key)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.col("listed").alias("spans"))
