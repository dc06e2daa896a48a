"""Words are taken as equal by their bytes: hashes only find them."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerspark.llm import blocks, decontaminate, lattice, neardup
from tests.llm.test_operators import docs_of, leak_case, leaks_by_force, lowered

REAL = blocks.byte_hashes


def few_hashes(buf, starts, ends):
    """Three hashes for all words."""
    return REAL(buf, starts, ends) % np.uint64(3)


def twins():
    """Two words of 1,024 letters that differ everywhere; polynomial hashes modulo 2**64 cannot tell them apart."""
    bits = [bin(k).count("1") % 2 for k in range(1024)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def text_column(texts):
    return pa.array(texts, pa.string())


def spans_of(words):
    limits = np.concatenate([[0], np.cumsum([len(w) for w in words], dtype=np.int64)])
    return np.frombuffer(b"".join(words), np.uint8), limits[:-1], limits[1:]


def test_hashes_and_comparison_follow_the_bytes():
    rng = random.Random(9)
    words = [bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.choice([0, 1, 2, 3, 7, 8, 9, 15, 16, 17, 40, 1023, 1024, 1025, 3000])))
             for _ in range(2500)]
    words += [w + b"\x00" for w in words[:200]] + words[:300]
    buf, s, e = spans_of(words)
    h = blocks.byte_hashes(buf, s, e)
    assert len({(w, x) for w, x in zip(words, h.tolist(), strict=True)}) == len(set(words)) == len(set(h.tolist()))
    order = np.array(rng.sample(range(len(words)), len(words)))
    other, os, oe = spans_of([words[k] for k in order])
    assert (blocks.byte_hashes(other, os, oe) == h[order]).all()
    pick = np.array([rng.randrange(len(words)) for _ in words])
    expected = [words[a] == words[b] for a, b in enumerate(order[pick])]
    assert blocks.same_bytes(buf, s, e, other, os[pick], oe[pick]).tolist() == expected
    assert blocks.same_bytes(buf, s[order], e[order], other, os, oe).all()
    none = np.zeros(0, np.int64)
    assert len(blocks.byte_hashes(np.zeros(0, np.uint8), none, none)) == 0


@pytest.mark.parametrize("block_words", [10, 10_000])
def test_leaks_when_most_words_share_a_hash(monkeypatch, block_words):
    monkeypatch.setattr(decontaminate, "byte_hashes", few_hashes)
    docs, items = leak_case()
    items = [(i, t) for i, t in items[:block_words] if t]
    phrases = decontaminate.Phrases(items)
    assert phrases.most > 1
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in docs], pa.int64()), text_column([t for _, t in docs])], names=["key", "text"])
    mine = []
    for out in decontaminate._scan(iter([batch]), phrases):
        mine += [(r["key"], r["n_words"], sum(s["end"] - s["start"] for s in r["word_spans"]), r["items"]) for r in out.to_pylist()]
    assert sorted(mine, key=str) == sorted(leaks_by_force(docs, items), key=str)


def test_word_counts_when_most_words_share_a_hash(monkeypatch):
    monkeypatch.setattr(lattice, "byte_hashes", few_hashes)
    docs, _ = leak_case()
    texts = [t or "" for _, t in docs]
    batch = pa.RecordBatch.from_arrays([pa.array([k % 3 > 0 for k in range(len(texts))]), text_column(texts)], names=["learn", "text"])
    got = Counter()
    seen = set()
    for out in lattice._count_words(iter([batch])):
        for r in out.to_pylist():
            got[r["word"].decode()] += r["n"]
            seen.add(r["word"].decode())
    count = Counter(w for k, t in enumerate(texts) if k % 3 > 0 for w in lowered(t).split())
    assert {w: n for w, n in got.items() if n} == dict(count) and seen == {w for t in texts for w in lowered(t).split()}

    listed = [w for w, _ in count.most_common(6)]
    letters, begins, ends = spans_of([w.encode() for w in listed])
    keys = few_hashes(letters, begins, ends)
    order = np.argsort(keys)
    frequent = (keys[order], np.array([count[w] for w in listed])[order], np.zeros(6), letters, begins[order], ends[order])
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), text_column(texts)], names=["key", "text"])
    own, rest = {}, Counter()
    for out in lattice._doc_parts(iter([batch]), frequent, (sum(count.values()), len(count))):
        for r in out.to_pylist():
            if r["word"] is None:
                own[r["key"]] = r["n_known"], r["n_tokens"]
            else:
                rest[r["key"], r["word"].decode()] += r["tf"]
    for k, t in enumerate(texts):
        words = Counter(lowered(t).split())
        outside = {w: n for (d, w), n in rest.items() if d == k}
        inside = words - Counter(outside)
        assert set(inside) <= set(listed) and all(words[w] == n for w, n in outside.items())
        assert own[k] == (sum(inside.values()), sum(words.values()) + 1)


def test_words_of_one_polynomial_hash_stay_apart(spark):
    one, two = twins()
    buf, s, e = spans_of([one.encode(), two.encode()])
    assert len(set(blocks.span_hashes(buf, s, e).tolist())) == 1  # they are such a pair
    bench = spark.createDataFrame([("x", one)], "item_id string, text string")
    leaks = decontaminate.find_leaks(docs_of(spark, [(1, f"a {one} b"), (2, f"a {two} b")]), bench).collect()
    assert {r.doc_id: list(r["items"]) for r in leaks} == {1: ["x"], 2: []}
    scored = lattice.score_documents(docs_of(spark, [(3, one), (5, one)]), lattice.default_vocabulary()).collect()
    both = lattice.score_documents(docs_of(spark, [(3, one), (5, two)]), lattice.default_vocabulary()).collect()
    assert {r.n_known for r in scored} == {r.n_known for r in both} == {2}
    assert scored[0].base_score != both[0].base_score  # one word twice, two words once
    tail = " ".join(f"w{k}" for k in range(4))
    got = neardup.classes(docs_of(spark, [(1, f"{one} {tail}"), (2, f"{two} {tail}"), (3, f"{one} {tail}")])).collect()
    assert {r.id: r.class_id for r in got} == {1: 1, 2: 2, 3: 1}
