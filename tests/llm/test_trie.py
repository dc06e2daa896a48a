"""op12: the depth-band roll-up against brute force, also with bands lower than the trie and lists over several chunks."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from ledgerspark.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, key string, depth long"


def brute(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[conv].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [(r, t) for *_, r, t in sorted(ts)] for c, ts in turns.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        whole = tuple(own.get(c - c % 100, [])[:h] + own[c][h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ends[whole].append(c)
    children = defaultdict(list)
    for n in members:
        if n:
            children[n[:-1]].append(n)

    def subtree(n):
        yield n
        for c in children[n]:
            yield from subtree(c)

    return sorted((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children[n]),
                   sum(not children[x] for x in subtree(n)),
                   sum((len(members[x]) - 1) * len(x[-1][1]) for x in subtree(n) if x),
                   hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, m in members.items())


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA)
    out = trie.prefix_trie(df, **kw).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                            "saved_tokens", "ends_sha256")
    return sorted(map(tuple, out.collect()), key=lambda r: r)


def made(seed, convs, turns):
    r = random.Random(seed)
    rows = []
    for c in convs:
        for t in range(r.randrange(1, turns + 1)):
            rows.append((c, r.choice([t, t, t, t, 0]) if r.random() < 0.95 else None,
                         r.choice(["user", "assistant", None]), r.choice(["", "a", "é𝄞", None, "long text"])))
    r.shuffle(rows)
    return rows


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) if x is not None else (False, 0) for x in r))


@pytest.mark.parametrize("band", [1, 3, 32])
def test_against_brute_force(spark, band, monkeypatch):
    monkeypatch.setattr(trie.math, "isqrt", lambda d: 0)  # the height is the band given
    rows = made(band, [*range(0, 40), *range(205, 230), 7_000_000_000], 9)
    assert ordered(run(spark, rows, band=band)) == ordered(brute(rows))


def test_hot_copies_chunks_and_a_deep_conversation(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK_BITS", 3)
    rows = [(c, t, "user", f"hello {t}") for c in range(300, 380) for t in range(3)]  # one group of copies over many chunks
    rows += [(500, t, "user", f"t{t % 7}") for t in range(150)] + [(501, t, "user", f"t{t % 7}") for t in range(140)]
    rows += [(905, 0, "user", "lost"), (None, 1, "user", "nobody's")]  # its first turns come from an absent conversation
    assert ordered(run(spark, rows, band=8)) == ordered(brute(rows))


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, None, None), (2, None, "user", "a")]
    assert ordered(run(spark, rows)) == ordered(brute(rows))
    assert run(spark, []) == []
