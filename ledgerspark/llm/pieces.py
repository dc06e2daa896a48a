"""SentencePiece BPE by vectorised merge rounds.

A text is normalised as its model file says (a dummy space in front, spaces as U+2581) and
cut into words where no piece of the vocabulary can reach across. The words a task has
not met yet are laid out in one flat numpy array of symbols and cut further into segments, again where no
piece can reach across. Then rounds follow: each pair of neighbours has the rank of the
piece it spells (none: no merge), a segmented minimum gives the best rank of every segment, all its
leftmost non-overlapping occurrences merge at once, and the arrays are compacted; segments without a
pair are done. A merge that would at once allow a pair of the same or a better rank ends its
segment's round, since one merge at a time would go on there; so the result is that of merging one pair after another.

Pieces that are runs of one character and share the lowest score (the runs of spaces of such
vocabularies) merge from left to right, so a run of any length becomes longest pieces and a tail from a
table; that is applied once, after the rounds.

Characters without a piece are spelled by the byte pieces. Decoding emits the pieces, U+2581 as a
space, and drops the dummy space.

Defined results: null text counts as empty, which has the begin and end ids only; texts and words
of any length are encoded whole (a round costs the symbols of the segments that still merge);
an empty table gives no rows; repeated rows repeat their results; other columns are ignored. At most
``CACHE_WORDS`` words are remembered within a task, beside those of the texts at hand. A file with another normalisation, without byte
pieces or with pieces of user symbols is refused when it is opened.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm.blocks import slices
from ledgerspark.llm.common import table

CACHE_WORDS = 400_000
CACHED_LENGTH = 256  # longer words are encoded each time
KEPT_WORDS = 50_000  # from one task of a worker to the next
SLICE_ROWS = 256  # texts encoded at a time
FLAT_SYMBOLS = 1 << 20  # characters laid out at a time (a longer word is laid out alone)

SPACE = "▁"
NO_RANK = np.iinfo(np.int64).max
PROBES = ("a", " a", "a  b ", "\ta\n", "Åﬁ　", "é")


class Lookup:
    """Integer keys to integer values; ``none`` for other keys."""

    def __init__(self, entries: dict[int, int], none: int):
        self.keys = np.array(sorted(entries), np.int64)
        self.values = np.array([entries[k] for k in self.keys.tolist()] + [none], np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), self.values[-1])
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.values[np.where(self.keys[at] == keys, at, len(self.keys))]


class Pieces:
    """One model file: its vocabulary as look-up tables, encoder and decoder."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        every = range(self.size)
        piece = [model.id_to_piece(i) for i in every]
        plain = [i for i in every if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        self.begin, self.end = model.bos_id(), model.eos_id()
        self.byte_ids = np.full(256, -1, np.int64)
        for i in every:
            if model.is_byte(i):
                self.byte_ids[int(piece[i][3:-1], 16)] = i
        if (self.byte_ids < 0).any() or any(model.is_unused(i) for i in plain):
            raise ValueError(f"{path}: the encoder needs all byte pieces and no unused ones")
        if any(model.normalize(t) != SPACE + t.replace(" ", SPACE) for t in PROBES):
            raise ValueError(f"{path}: only files that keep the text as it is, with a dummy space in front, are supported")

        self._tables({piece[i]: i for i in plain}, {piece[i]: model.get_score(i) for i in plain})
        self.emit = [piece[i].replace(SPACE, " ").encode() for i in every]
        for byte, i in enumerate(self.byte_ids.tolist()):
            self.emit[i] = bytes([byte])
        for i in every:
            if model.is_control(i):
                self.emit[i] = b""
            elif model.is_unknown(i):
                self.emit[i] = " ⁇ ".encode()
        self.spaced = {i for i in plain if piece[i].startswith(SPACE)}
        self.silent = {i for i in every if model.is_control(i)}
        self.words: dict[str, bytes] = {}

    def _tables(self, ids: dict[str, int], score: dict[str, float]) -> None:
        # symbols: the pieces, then characters that occur in pieces but are none, then any other character
        symbol = dict(ids)
        for p in ids:
            for ch in p:
                symbol.setdefault(ch, self.size + len(symbol) - len(ids))
        self.other = self.size + len(symbol) - len(ids)
        self.base = self.other + 1
        self.of_char = np.full(0x110000, self.other, np.int64)
        for p, s in symbol.items():
            if len(p) == 1:
                self.of_char[ord(p)] = s

        self._runs(ids, score)
        merging = [p for p in ids if len(p) > 1 and p not in self.run_pieces]
        rank = {s: k for k, s in enumerate(sorted({score[p] for p in merging}, reverse=True))}
        ranks, results, triples, doubles = {}, {}, {}, {}
        for p in merging:
            for k in range(1, len(p)):
                a, b = symbol.get(p[:k]), symbol.get(p[k:])
                if a is not None and b is not None:
                    ranks[a * self.base + b] = rank[score[p]]
                    results[a * self.base + b] = ids[p]
            chars = [symbol[ch] for ch in p]
            if len(p) == 2:
                doubles[chars[0] * self.base + chars[1]] = 1
            for a, b, c in zip(chars, chars[1:], chars[2:]):
                triples[(a * self.base + b) * self.base + c] = 1
        self.rank, self.result = Lookup(ranks, NO_RANK), Lookup(results, -1)
        self.double, self.triple = Lookup(doubles, 0), Lookup(triples, 0)

        self.split = _splitter(ids, merging)

    def _runs(self, ids: dict[str, int], score: dict[str, float]) -> None:
        """The run pieces: all pieces that hold a character twice in a row, if they are runs of it, of one score below all
        others. ``run_table[n, i]`` is the piece at place ``i`` of a run of ``n``, or -1 within one."""
        self.run_pieces: dict[str, int] = {}
        self.run_of = -1
        low = min(score.values(), default=0.0)
        lowest = [p for p in ids if score[p] == low and len(p) > 1]
        ch = lowest[0][0] if lowest else ""
        if not lowest or ch not in ids or any(p != ch * len(p) for p in lowest) or \
                {p for p in ids if ch * 2 in p} != set(lowest) or any(score[p] == low and p[0] != ch for p in ids):
            return
        lengths = {len(p) for p in lowest}
        longest = max(lengths)
        if any(_merged_run(n, lengths) != [longest] * (n // longest) + _merged_run(n % longest, lengths)
               for n in range(4 * longest)):
            return
        self.run_pieces, self.run_of = {p: ids[p] for p in lowest}, ids[ch]
        self.run_table = np.full((longest + 1, longest), -1, np.int64)
        for n in range(1, longest + 1):
            at = 0
            for k in _merged_run(n, lengths):
                self.run_table[n, at] = ids[ch * k]
                at += k

    # -- encoding ----------------------------------------------------------

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, begin and end included, as little-endian unsigned 32-bit integers."""
        # words keep plain spaces, which stand for U+2581: most texts then take one byte a character
        cut = [self.split.findall(" " + t.replace(SPACE, " ")) if t else [] for t in texts]
        known = self.words
        wanted = list(set().union(*cut).difference(known))
        for group in _groups(wanted):
            known.update(zip(group, self.merge(group)))
        first, last = self.begin.to_bytes(4, "little"), self.end.to_bytes(4, "little")
        look = known.__getitem__
        out = [b"".join([first, *map(look, words), last]) for words in cut]
        for word in wanted:
            if len(word) >= CACHED_LENGTH:
                del known[word]
        if len(known) >= CACHE_WORDS:  # the younger half stays; frequent words come back with the next texts
            self.words = dict(islice(known.items(), len(known) - CACHE_WORDS // 2, None))
        return out

    def forget(self) -> None:
        """Drop the cached words but the first."""
        self.words = dict(islice(self.words.items(), KEPT_WORDS))

    def merge(self, words: list[str]) -> list[bytes]:
        """Ids of each word: all words at once, by rounds over flat arrays."""
        sizes = np.array([len(w) for w in words], np.int64)
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        chars[chars == ord(" ")] = ord(SPACE)
        done = self.of_char[chars]
        limits = np.concatenate([[0], np.cumsum(sizes)])
        self._rounds(done, self._segments(done, limits[:-1]))
        left = np.flatnonzero(done >= 0)
        word = np.searchsorted(limits, left, "right") - 1
        symbols = self._join_runs(done[left], word)
        kept = symbols >= 0
        return self._spell(symbols[kept], chars[left[kept]], word[kept], len(words))

    def _segments(self, s: np.ndarray, word_starts: np.ndarray) -> np.ndarray:
        """Starts of runs of characters across whose limits no piece can reach."""
        n, b = len(s), self.base
        pair = s[:-1] * b + s[1:]
        whole = self.double(pair) > 0
        three = np.zeros(n + 1, bool)  # three[i]: characters i - 1, i and i + 1 stand together in a piece
        if n > 2:
            three[1:n - 1] = self.triple(pair[:-1] * b + s[2:]) > 0
        start = np.ones(n, bool)
        start[1:] = ~(whole | three[:n - 1] | three[1:n])
        start[word_starts] = True
        return np.flatnonzero(start)

    def _rounds(self, done: np.ndarray, starts: np.ndarray) -> None:
        """Merge in place: ``done`` keeps each symbol at its first character, and -1 at the others."""
        b = self.base
        sizes = np.diff(np.append(starts, len(done)))
        at = np.flatnonzero(np.repeat(sizes > 1, sizes))
        sizes = sizes[sizes > 1]
        sym = done[at]
        seg = np.repeat(np.arange(len(sizes)), sizes)
        rank = self._ranks(sym, seg, np.arange(len(sym)))
        while len(sym):
            heads = np.flatnonzero(np.diff(seg, prepend=-1))
            best = np.minimum.reduceat(rank, heads)
            count = np.diff(np.append(heads, len(sym)))
            if (best == NO_RANK).any():  # segments without a pair are done
                live = np.repeat(best != NO_RANK, count)
                done[at[~live]] = sym[~live]
                sym, seg, at, rank = sym[live], seg[live], at[live], rank[live]
                if not len(sym):
                    return
                live = best != NO_RANK
                best, count = best[live], count[live]
                seg = np.repeat(np.arange(len(best)), count)
            index = np.arange(len(sym))
            hit = rank == np.repeat(best, count)
            first = hit.copy()
            first[1:] &= ~hit[:-1]
            take = np.flatnonzero(hit & ((index - np.maximum.accumulate(np.where(first, index, 0))) % 2 == 0))
            new = self.result(sym[take] * b + sym[take + 1])
            take, new = self._until_better(sym, seg, take, new, best)
            done[at[take + 1]] = -1
            sym[take] = new
            keep = np.ones(len(sym), bool)
            keep[take + 1] = False
            moved = np.cumsum(keep) - 1
            sym, seg, at, rank = sym[keep], seg[keep], at[keep], rank[keep]
            beside = np.zeros(len(sym) + 1, bool)  # the merged symbols and, shifted by one, those before them
            beside[moved[take] + 1] = beside[moved[take]] = True
            changed = np.flatnonzero(beside[1:])
            rank[changed] = self._ranks(sym, seg, changed)

    def _ranks(self, sym: np.ndarray, seg: np.ndarray, index: np.ndarray) -> np.ndarray:
        """Rank of the pair that begins at each index, within its segment."""
        out = np.full(len(index), NO_RANK)
        inner = index < len(sym) - 1
        inner[inner] = seg[index[inner]] == seg[index[inner] + 1]
        i = index[inner]
        out[inner] = self.rank(sym[i] * self.base + sym[i + 1])
        return out

    def _until_better(self, sym: np.ndarray, seg: np.ndarray, take: np.ndarray, new: np.ndarray,
                      best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per segment, the merges up to the first after which a pair of the same or a better rank stands beside it."""
        if len(take) < 2 or not (seg[take[1:]] == seg[take[:-1]]).any():
            return take, new
        limit = best[seg[take]]
        after = np.minimum(take + 2, len(sym) - 1)
        right = np.where((take + 2 < len(sym)) & (seg[after] == seg[take]), self.rank(new * self.base + sym[after]), NO_RANK)
        before = np.maximum(take - 1, 0)
        joined = np.zeros(len(take), bool)
        joined[1:] = take[:-1] + 2 == take[1:]
        left_symbol = np.where(joined, np.concatenate([[0], new[:-1]]), sym[before])
        left = np.where((take > 0) & (seg[before] == seg[take]), self.rank(left_symbol * self.base + new), NO_RANK)
        better = (right <= limit) | (left <= limit)
        if not better.any():
            return take, new
        earlier = np.cumsum(better) - better  # better merges before each, counted from the segment's first
        head = np.flatnonzero(np.diff(seg[take], prepend=-1))
        keep = earlier == np.repeat(earlier[head], np.diff(np.append(head, len(take))))
        return take[keep], new[keep]

    def _join_runs(self, sym: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Runs of the run character within a word become run pieces, the longest first; symbols that end in one get -1."""
        if self.run_of < 0 or not len(sym):
            return sym
        single = sym == self.run_of
        first = single.copy()
        first[1:] &= ~(single[:-1] & (word[1:] == word[:-1]))
        index, longest = np.arange(len(sym)), self.run_table.shape[1]
        offset = (index - np.maximum.accumulate(np.where(first, index, 0))) % longest
        head = np.flatnonzero(~single | (offset == 0))
        sizes = np.diff(np.append(head, len(sym)))
        length = np.repeat(sizes, sizes)
        return np.where(single, self.run_table[np.minimum(length, longest), np.where(single, offset, 0)], sym)

    def _spell(self, sym: np.ndarray, chars: np.ndarray, word: np.ndarray, words: int) -> list[bytes]:
        """Ids per word; symbols without an id are spelled by their bytes."""
        spelled = sym >= self.size
        width = np.ones(len(sym), np.int64)
        lost = chars[spelled]
        width[spelled] = 1 + (lost >= 0x80) + (lost >= 0x800) + (lost >= 0x10000)
        ids = np.repeat(np.where(spelled, -1, sym), width)
        if len(lost):
            data = np.frombuffer(lost.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass"), np.uint8)
            ids[ids < 0] = self.byte_ids[data]
        ends = np.cumsum(np.bincount(word, weights=width, minlength=words).astype(np.int64)) * 4
        flat = ids.astype("<u4").tobytes()
        return [flat[a:z] for a, z in zip([0, *ends[:-1].tolist()], ends.tolist())]

    # -- decoding ----------------------------------------------------------

    def decode(self, ids: bytes) -> str:
        """The text of the pieces; bytes that are no UTF-8 become U+FFFD."""
        tokens = np.frombuffer(ids, "<u4").tolist()
        text = b"".join(map(self.emit.__getitem__, tokens)).decode("utf-8", "replace")
        first = next((t for t in tokens if t not in self.silent), None)
        return text[1:] if first in self.spaced else text


def _splitter(ids: dict[str, int], merging: list[str]) -> re.Pattern:
    """Words end where no piece reaches across: before spaces, around ASCII characters that stand in no longer piece, and
    between marks and letters if no piece mixes them."""
    if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in ids):
        return re.compile(r"(?s).+")
    inside = {ch for p in merging for ch in p}
    alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in inside and c != ord(" "))
    marks = {chr(c) for c in range(128) if chr(c) in inside and not chr(c).isalnum()}
    beside = {pair for p in merging for pair in zip(p, p[1:]) if pair[0] != SPACE}
    while more := {ch for a, b in beside if (a in marks) != (b in marks) for ch in (a, b)} - marks:
        marks |= more  # other marks that share a piece with one
    if any(ch.isalpha() for ch in marks):
        marks = set()
    mark = "".join(map(re.escape, sorted(marks)))
    kinds = [f" *[^ {alone}{mark}]+", f" *[{mark}]+" if mark else "", " +", f"[{alone}]" if alone else ""]
    return re.compile("|".join(k for k in kinds if k))


def _merged_run(n: int, lengths: set[int]) -> list[int]:
    """Lengths of the pieces of a run of ``n``, merging the leftmost pair that has a piece until none has."""
    run = [1] * n
    while True:
        i = next((i for i in range(len(run) - 1) if run[i] + run[i + 1] in lengths), None)
        if i is None:
            return run
        run[i:i + 2] = [run[i] + run[i + 1]]


def _groups(words: list[str]) -> Iterator[list[str]]:
    """The words in runs of at most ``FLAT_SYMBOLS`` characters, one word at least."""
    ends = np.cumsum([len(w) for w in words])
    at = 0
    while at < len(words):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + FLAT_SYMBOLS, "right")))
        yield words[at:to]
        at = to


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """The tables of one file, once per worker process."""
    return Pieces(path)


def _encode(batches: Iterator[pa.RecordBatch], path: str, names: list[str]) -> Iterator[pa.RecordBatch]:
    coder = pieces(path)
    decodes = any(n.startswith("decoded") for n in names)
    for batch in slices(batches, SLICE_ROWS):
        ids = coder.encode([t or "" for t in batch.column(1).to_pylist()])
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


def encode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text",
           columns: tuple[str, ...] = tuple(KINDS)) -> DataFrame:
    """``key`` and the chosen columns of ``KINDS``: token ids, their count and digest, the decoded text and its digest.

    ``model`` is a model file that every executor can open at this path.
    """
    names = list(columns)
    schema = ", ".join([f"key {docs.schema[key].dataType.simpleString()}", *(f"{n} {KINDS[n]}" for n in names)])
    return docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(
        lambda it: _encode(it, model, names), schema).withColumnRenamed("key", key)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), default_model(), columns=("n_tokens", "ids_sha256", "decoded_sha256"))
