"""Byte-level BPE with a tokenization automaton.

The merges of a vocabulary are compiled one after another into a deterministic
automaton over token labels that accepts exactly the token sequences BPE would
produce. Each merge ``u v -> w`` adds one gadget: from the state after ``u`` the arc
``v`` is cut, and a new label ``w`` leads from every state that had an arc ``u`` to
a copy of the state that followed ``v``. A state is determined by the last label,
and a copy inherits all arcs cut before it was made, so the automaton is kept as
its cut arcs with the time of the cut and the parent of each copy; rows of the
transition table are read off those on demand (a full table of a 50,000-label
vocabulary would have 2.5 billion entries).

A pre-split word is encoded by running the automaton along labels that match its
bytes, the longest first: every prefix of a word has one accepted label sequence at
most, so each byte position is visited once and time is linear in the word. Decoding emits the arc labels. Words are remembered within a
task in a cache of two generations of ``CACHE_WORDS`` each: when the younger one is full
the older one goes, and words met again move back into the younger.

Defined results: null text counts as empty, which has no tokens; texts of any
length are encoded whole; an empty table gives no rows; repeated rows repeat their
results; other columns are ignored. Special tokens of the file are recognised in
a text as the tokenizers library does by default. Letters and numbers are those of that
library's Unicode tables: characters that only the newer tables of ``regex`` know are neither.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm.blocks import slices
from ledgerspark.llm.common import table

CACHE_WORDS = 200_000
CACHE_ROWS = 300_000
KEPT_WORDS = 50_000  # from one task of a worker to the next

# Fixed value: the pre-split pattern of byte-level BPE vocabularies of this kind.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=1)
def newer_characters() -> np.ndarray:
    """Per code point whether ``regex`` takes it for a letter or number and the tokenizers library does not."""
    from tokenizers import Regex, pre_tokenizers

    kinds, every = r"[\p{L}\p{N}]+", "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    here = "".join(regex.findall(kinds, every))
    there = pre_tokenizers.Split(Regex(kinds), "removed", invert=True).pre_tokenize_str(here)
    newer = np.zeros(0x110000, bool)
    newer[_code_points(here)] = True
    newer[_code_points("".join(word for word, _ in there))] = False
    return newer


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


@lru_cache(maxsize=1)
def strict_split() -> regex.Pattern:
    """``SPLIT`` with the newer characters as neither letters nor numbers."""
    at = np.flatnonzero(newer_characters())
    if not len(at):
        return regex.compile(SPLIT)
    first, last = at[np.diff(at, prepend=-2) > 1], at[np.diff(at, append=0x110001) > 1]
    newer = "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(first, last, strict=True)) + "]"
    pattern = SPLIT.replace(r"\p{L}", rf"[\p{{L}}--{newer}]").replace(r"\p{N}", rf"[\p{{N}}--{newer}]")
    return regex.compile(pattern, regex.V1)


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in such vocabulary files."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Automaton:
    """The deterministic tokenization automaton; labels and states are token ids."""

    def __init__(self, size: int):
        self.labels: list[bytes] = [b""] * size
        self.left, self.right = [-1] * size, [-1] * size  # the two labels a merged label was made of
        self.made = [0] * size  # time at which the label (and its state) was made
        self.cut: dict[tuple[int, int], int] = {}  # arcs cut from a state, with the time
        self.time = 0
        self.rows: dict[int, bool] = {}  # entries of the transition table read so far: state and label in one number
        self.ids: dict[bytes, int] = {}

    def add_byte(self, token: int, byte: int) -> None:
        self._name(token, bytes([byte]))

    def add_merge(self, u: int, v: int, w: int) -> None:
        """One gadget: cut ``v`` after ``u``; ``w`` goes wherever ``u`` goes and leads to a copy of the state after ``v``."""
        self.time += 1
        self.cut.setdefault((u, v), self.time)
        if not self.labels[w]:
            self.left[w], self.right[w], self.made[w] = u, v, self.time
            self._name(w, self.labels[u] + self.labels[v])

    def _name(self, token: int, label: bytes) -> None:
        self.labels[token] = label
        self.ids[label] = token

    def _row_entry(self, state: int, label: int) -> bool:
        """Whether the state (the last label) has an arc ``label``."""
        # arcs cut from an ancestor before the copy was made are missing in the copy (the copy is
        # taken before its own gadget cuts); so are labels whose first part had been cut by the
        # time the label was made (its arcs are added after its own gadget's cut)
        spine, until = [], self.time
        while label >= 0:
            spine.append((label, until))
            until = self.made[label]
            label = self.left[label]
        before = self.time + 1
        while state >= 0:
            for first, until in spine:
                at = self.cut.get((state, first))
                if at is not None and at < before and at <= until:
                    return False
            before = self.made[state]
            state = self.right[state]
        return True

    def close(self) -> None:
        """Look-ups for ``run``: all beginnings of labels (with their token, or -1), and for each label the longest
        shorter one it begins with."""
        ids = self.ids
        self.begins = {label[:k]: -1 for label in ids for k in range(1, len(label))} | ids
        self.shorter = [-1] * len(self.labels)
        for label, token in ids.items():
            self.shorter[token] = next((ids[label[:k]] for k in range(len(label) - 1, 0, -1) if label[:k] in ids), -1)
        self.widths = [len(label) for label in self.labels]

    def _longest(self, word: bytes, at: int) -> int:
        """The longest label that matches ``word`` from ``at``."""
        find, best, n = self.begins.get, -1, len(word)
        for j in range(at + 1, n + 1):
            token = find(word[at:j])
            if token is None:
                break
            if token >= 0:
                best = token
        return best

    def run(self, word: bytes) -> list[int]:
        """The one accepted label sequence that spells ``word``.

        Arcs are followed longest label first; a position that leads nowhere is left for
        good, since one sequence at most reaches it. So each position is expanded once.
        """
        n, widths, shorter, rows, size = len(word), self.widths, self.shorter, self.rows, len(self.widths)
        path: list[int] = []
        dead: set[int] = set()
        pos, state, label = 0, -1, self._longest(word, 0)
        while pos < n:
            while label >= 0:
                if pos + widths[label] not in dead:
                    if state < 0:
                        break
                    known = rows.get(state * size + label)
                    if known is None:
                        if len(rows) >= CACHE_ROWS:
                            rows.clear()
                        known = rows[state * size + label] = self._row_entry(state, label)
                    if known:
                        break
                label = shorter[label]
            if label >= 0:
                path.append(label)
                pos += widths[label]
                state = label
                label = self._longest(word, pos)
            else:
                dead.add(pos)
                last = path.pop()
                pos -= widths[last]
                state = path[-1] if path else -1
                label = shorter[last]
        return path


class Tokenizer:
    """Encoder and decoder over one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, to_byte = spec["model"], byte_characters()
        vocab = model["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.automaton = Automaton(max([*vocab.values(), *special.values()]) + 1)
        for ch, byte in to_byte.items():
            if ch in vocab:
                self.automaton.add_byte(vocab[ch], byte)
        for merge in model["merges"]:
            u, v = merge.split(" ") if isinstance(merge, str) else merge
            self.automaton.add_merge(vocab[u], vocab[v], vocab[u + v])
        self.automaton.close()
        self.split = regex.compile(SPLIT)
        self.special = special
        self.cut = regex.compile("|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None
        self.words = _Words(self)
        self.emit = list(self.automaton.labels)
        for text, token in special.items():
            self.emit[token] = text.encode()

    def encode(self, text: str) -> bytes:
        """Token ids of ``text`` as little-endian unsigned 32-bit integers."""
        if self.cut is None or not self.cut.search(text):
            return self._plain(text)
        out, at = [], 0
        for m in self.cut.finditer(text):
            out.append(self._plain(text[at:m.start()]))
            out.append(self.special[m.group()].to_bytes(4, "little"))
            at = m.end()
        return b"".join([*out, self._plain(text[at:])])

    def _plain(self, text: str) -> bytes:
        if len(self.words) >= CACHE_WORDS:
            self.words.age()
        split = self.split
        if not text.isascii() and newer_characters()[_code_points(text)].any():
            split = strict_split()
        return b"".join(map(self.words.__getitem__, split.findall(text)))

    def forget(self) -> None:
        """Drop the cached words but the first (they came early because they are frequent)."""
        kept = dict(islice(self.words.items(), KEPT_WORDS))
        self.words = _Words(self)
        self.words.update(kept)

    def decode(self, ids: bytes) -> str:
        """The text of the arc labels, with stray bytes replaced."""
        tokens = np.frombuffer(ids, "<u4").tolist()
        return b"".join(map(self.emit.__getitem__, tokens)).decode("utf-8", "replace")


class _Words(dict):
    """Cache of encoded words; a missing word runs through the automaton."""

    def __init__(self, tokenizer: Tokenizer):
        self.automaton = tokenizer.automaton
        self.older: dict[str, bytes] = {}

    def age(self) -> None:
        self.older = dict(self)
        self.clear()

    def __missing__(self, word: str) -> bytes:
        known = self.older.get(word)
        if known is not None:
            self[word] = known
            return known
        data = word.encode("utf-8", "surrogatepass")
        whole = np.array(self.automaton.run(data), "<u4").tobytes()
        if len(data) < 256:
            self[word] = whole
        return whole


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    """One compiled automaton per worker process and file."""
    return Tokenizer(path)


def _encode(batches: Iterator[pa.RecordBatch], path: str, names: list[str]) -> Iterator[pa.RecordBatch]:
    coder = tokenizer(path)
    decodes = any(n.startswith("decoded") for n in names)
    for batch in slices(batches):
        ids = [coder.encode(t.as_py() or "") for t in batch.column(1)]
        decoded = [coder.decode(x) for x in ids] if decodes else []
        columns = {
            "n_tokens": lambda: pa.array([len(x) // 4 for x in ids], pa.int64()),
            "ids": lambda: pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in ids], pa.list_(pa.int32())),
            "ids_sha256": lambda: pa.array([sha256(x).hexdigest() for x in ids], pa.string()),
            "decoded": lambda: pa.array(decoded, pa.string()),
            "decoded_sha256": lambda: pa.array([sha256(x.encode()).hexdigest() for x in decoded], pa.string()),
        }
        yield pa.RecordBatch.from_arrays([batch.column(0), *(columns[n]() for n in names)], names=["key", *names])
    coder.forget()  # the worker process lives on; other operators' tasks get the memory


KINDS = {"n_tokens": "long", "ids": "array<int>", "ids_sha256": "string", "decoded": "string", "decoded_sha256": "string"}


def encode(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text",
           columns: tuple[str, ...] = tuple(KINDS)) -> DataFrame:
    """``key`` and the chosen columns of ``KINDS``: token ids, their count and digest, the decoded text and its digest.

    ``vocabulary`` is a tokenizer file that every executor can open at this path.
    """
    names = list(columns)
    schema = ", ".join([f"key {docs.schema[key].dataType.simpleString()}", *(f"{n} {KINDS[n]}" for n in names)])
    return docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(
        lambda it: _encode(it, vocabulary, names), schema).withColumnRenamed("key", key)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), default_vocabulary(),
                  columns=("n_tokens", "ids_sha256", "decoded_sha256"))
