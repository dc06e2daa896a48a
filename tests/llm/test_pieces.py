"""op11: the vectorised merge rounds against the sentencepiece library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import Row

from ledgerspark.llm import pieces

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())


@pytest.fixture(scope="module")
def coder():
    return pieces.pieces(pieces.default_model())


def _check(coder, library, texts):
    for text, got in zip(texts, coder.encode(texts)):
        ids = library.encode(text, add_bos=True, add_eos=True)
        assert np.frombuffer(got, "<u4").tolist() == ids, text[:100]
        assert coder.decode(got) == library.decode(ids), text[:100]


@pytest.mark.parametrize("letters", ["abcdefgh .,\n\t ", " ▁▁ab  ", "аеионт ", "日本語中文字 ", "\x00​�\U0001f600é ", "0123456789.,- $",
                                     "{}()[]<>/=\"'; \\n", "the<s></s><0x0A>▁ "])
def test_random_texts(coder, library, letters):
    r = random.Random(letters)
    _check(coder, library, ["".join(r.choices(letters, k=r.randrange(60))) for _ in range(500)])


def test_all_planes(coder, library):
    r = random.Random(3)

    def ch():
        return chr(r.choice([r.randrange(1, 0xD800), r.randrange(0xE000, 0x110000), r.randrange(32, 127)]))

    _check(coder, library, ["".join(ch() for _ in range(r.randrange(40))) for _ in range(2000)])


def test_pieces_joined_at_random(coder, library):
    r = random.Random(4)
    piece = [library.id_to_piece(i).replace("▁", " ") for i in range(259, library.get_piece_size())]
    _check(coder, library, ["".join(r.choices(piece, k=r.randrange(12))) for _ in range(3000)] + piece)


@pytest.mark.parametrize("text", [" " * 200_000, "a" * 200_000, "ab" * 100_000, "x" + " " * 33 + "y" + " " * 31, ""])
def test_long_runs(coder, library, text):
    _check(coder, library, [text])


def test_long_word_of_random_letters(coder, library):
    r = random.Random(5)
    _check(coder, library, ["".join(r.choices("etaoinshrdlu", k=100_000)), "".join(r.choices("日本語中文字", k=100_000))])


def test_words_beyond_the_cache_and_the_flat_limit(library, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_WORDS", 50)
    monkeypatch.setattr(pieces, "FLAT_SYMBOLS", 64)
    small = pieces.Pieces(pieces.default_model())
    r = random.Random(6)
    texts = [" ".join("".join(r.choices("abcde", k=r.randrange(1, 9))) for _ in range(40)) for _ in range(60)]
    for k in range(0, 60, 6):
        _check(small, library, texts[k:k + 6] + texts[:3])
    small.forget()
    _check(small, library, texts)


class Tiny(pieces.Pieces):
    """A vocabulary made by hand, in which a merge opens a better one (its pieces do not all spell themselves)."""

    def __init__(self, score):
        self.size = len(score)
        self._tables({p: i for i, p in enumerate(score)}, score)


def _one_by_one(word, score):
    """The definition: merge the best pair, the leftmost of equals, until no pair is a piece."""
    parts = list(word)
    while True:
        found = [(-score[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in score]
        if not found:
            return parts
        i = min(found)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def test_a_merge_that_opens_a_better_one_ends_the_round():
    r = random.Random(7)
    for _ in range(150):
        piece = {"a", "b", "c", "▁"} | {"".join(r.choices("abc", k=r.randrange(2, 5))) for _ in range(12)}
        score = {p: float(-r.randrange(8)) for p in sorted(piece)}
        tiny = Tiny(score)
        names = list(score)
        words = ["".join(r.choices("abc", k=r.randrange(1, 25))) for _ in range(30)]
        for word, got in zip(words, tiny.merge(words)):
            assert [names[i] for i in np.frombuffer(got, "<u4")] == _one_by_one(word, score)


def test_query_shape_and_odd_rows(spark, library):
    rows = [Row(doc_id=1, text="a b", key="x"), Row(doc_id=1, text="a b", key="y"), Row(doc_id=None, text=None, key=None),
            Row(doc_id=2, text="", key=None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    out = pieces.encode(docs, pieces.default_model(), columns=("n_tokens", "ids_sha256", "decoded_sha256")).collect()

    def digest(text):
        ids = library.encode(text, add_bos=True, add_eos=True)
        return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()

    expected = [(r.doc_id, *digest(r.text or "")) for r in rows]
    assert sorted(map(tuple, out), key=str) == sorted(expected, key=str)
    assert pieces.encode(docs.limit(0), pieces.default_model()).count() == 0
