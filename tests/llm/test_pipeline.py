"""The pipeline against a brute-force version on planted cases, and the registered queries against their SQL."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

import corpus_pipeline
from ledgerspark.llm import bpe, secrets
from ledgerspark.llm.queries import CATALOG
from tests.conftest import SF_ORACLE
from tests.llm.test_operators import docs_of, jaccard, leaks_by_force, lowered, prose, words
from tools.parity import compare

SYLLABLES = ("a", "be", "ci", "do", "fu", "gy", "ha", "lo", "mi", "né")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(21)
    good = {k: prose(rng, rng.randint(20, 120), SYLLABLES) for k in range(150)}
    items = [(k, prose(rng, 30, SYLLABLES)) for k in range(6)]
    docs = [(k, t) for k, t in good.items()]
    junk = list(range(1000, 1060))
    docs += [(k, "!! ".join(prose(rng, 40, SYLLABLES).upper().split())) for k in junk]
    docs += [(2000 + k, good[k]) for k in range(0, 30, 3)]  # exact copies
    for k in range(30, 60, 3):  # near copies: one word changed
        w = good[k].split()
        w[0] = "changed"
        docs.append((3000 + k, " ".join(w)))
    docs += [(4000 + k, prose(rng, 30, SYLLABLES) + "\n" + items[k][1].title() + ". " + prose(rng, 25, SYLLABLES)) for k in range(6)]
    docs += [(5000, prose(rng, 40, SYLLABLES) + '\napi_key = "Zx81kLmQ94vT2"\n' + prose(rng, 10, SYLLABLES)),
             (5001, prose(rng, 50, SYLLABLES) + " token: 0123456789abcdef0123 " + prose(rng, 10, SYLLABLES)),
             (5002, prose(rng, 30_000, SYLLABLES)), (7, good[7])]
    rows = [(i, t, "en", "src", None if t is None else len(t), "row", "k") for i, t in docs]
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row string, key string").repartition(
        4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 0 if i in junk else 1, 0) for i, _ in docs if i < 2000], "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, docs, items, junk


def expected_texts(docs, items, junk):
    """What each stage does, by force: drop junk, keep the smallest id of each class, cut leaks, redact."""
    kept = sorted({(i, t) for i, t in docs if i not in junk})
    cls = {i: i for i, _ in kept}
    for a, t in kept:
        for b, u in kept:
            if a < b and words(t) and words(u) and jaccard(t, u) >= 0.8:
                low, high = sorted((cls[a], cls[b]))
                for k, c in cls.items():
                    if c == high:
                        cls[k] = low
    kept = [(i, t) for i, t in kept if cls[i] == i]
    pattern = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    phrases = set()
    for _, text in items:
        w = words(text)
        phrases |= {tuple(w[a:a + 10]) for a in range(max(1, len(w) - 9))}
    out = {}
    for i, t in kept:
        spans = [m.span() for m in pattern.finditer(lowered(t))]
        w, hit = words(t), set()
        for n in {len(p) for p in phrases}:
            for a in range(len(w) - n + 1):
                if tuple(w[a:a + n]) in phrases:
                    hit |= set(range(a, a + n))
        chars = list(t)
        runs = [k for k in sorted(hit) if k - 1 not in hit]
        for a in reversed(runs):
            b = a
            while b + 1 in hit:
                b += 1
            del chars[spans[a][0]:spans[b][1]]
        text = "".join(chars)
        out[i] = secrets.redacted(text, secrets.scan(text)[1])
    return out


def test_pipeline_against_brute_force(spark, tables):
    tokenizers = pytest.importorskip("tokenizers")
    folder, docs, items, junk = tables
    assert sum(n > 0 for _, _, n, _ in leaks_by_force(docs, [(str(i), t) for i, t in items])) >= 6
    got = corpus_pipeline.run(spark, folder).collect()
    expected = expected_texts(docs, items, junk)
    library = tokenizers.Tokenizer.from_file(bpe.default_vocabulary())
    assert sorted(r.doc_id for r in got) == sorted(expected)
    for r in got:
        assert r.ids == library.encode(expected[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_stages_keep_the_columns_and_counts(spark, tables):
    folder, *_ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "encoding"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.dtypes == docs.dtypes
        assert out.where("n_chars <> length(text)").isEmpty()


def test_encoding_stage_decodes(spark):
    texts = {1: "Some words, não é?", 2: "", 3: "x\n\ny  z"}
    got = corpus_pipeline.encoding_stage(spark, docs_of(spark, list(texts.items())), "").collect()
    assert {r.doc_id: r.decoded_sha256 for r in got} == {k: hashlib.sha256(t.encode()).hexdigest() for k, t in texts.items()}


def test_stages_take_nulls_and_empty_tables(spark, tables):
    folder, *_ = tables
    kind = spark.read.parquet(f"{folder}/documents.parquet").schema
    odd = spark.createDataFrame([(None, None, None, None, None, None, None), (None, None, None, None, None, None, None), (1, None, "en", "s", None, "r", "k"),
                                 (2, "", "en", "s", 0, "r", "k"), (3, "", "en", "s", 0, "r", "k"), (None, "some words here", None, None, 15, None, None)], kind)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        assert stage(spark, odd.limit(0), folder).count() == 0
        n = stage(spark, odd, folder).count()
        assert n == 6 or k == 0  # texts without words are no duplicates; the classifier decides by its prior


@pytest.mark.parametrize("name", sorted(n for n, (_, text) in CATALOG.items() if text))
def test_query_matches_its_sql(spark, name):
    ok, mine, theirs = compare(spark, SF_ORACLE, [name], verbose=False)[name]
    assert ok, (mine, theirs)


def test_every_operator_has_its_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in CATALOG) == list(range(1, 14))
