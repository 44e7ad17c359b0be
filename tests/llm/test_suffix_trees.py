"""Repeated word sequences against plain Python."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortguard.llm import suffix_trees
from cohortguard.llm.suffix_trees import cut_repeated_words, suffix_ranks


def brute(rows, length=20):
    """(id, n_words, n_removed, kept) of rows (id, text) with distinct ids."""
    seen, out = set(), []
    for i, text in sorted(rows):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for a in range(len(words) - length + 1):
            window = tuple(words[a:a + length])
            if window in seen:
                gone[a:a + length] = [True] * length
            seen.add(window)
        out.append((i, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)))
    return out


def got(df, **options):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in cut_repeated_words(df, **options).collect()),
                  key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)] + ["é", "日本", " x", "\x1c"]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randrange(18, 70))] for _ in range(6)]
    texts = []
    for _ in range(120):
        words = []
        for _ in range(rng.randrange(0, 4)):
            words += rng.choice(passages) if rng.random() < 0.6 else rng.choices(vocabulary, k=rng.randrange(0, 60))
        texts.append(rng.choice([" ", "  ", "\n", " \t"]).join(words))
    texts += [" ".join(["a"] * 200), " ".join(["a", "b"] * 70), " ".join(["a"] * 19), "", None, "  \n ", texts[3], texts[3]]
    return texts


@pytest.mark.parametrize("seed,group", [(1, 1 << 14), (2, 1 << 14), (3, 2), (4, 1)])
def test_against_brute_force(documents, seed, group):
    texts = corpus(seed)
    rows = list(enumerate(texts))
    assert got(documents(texts, extra=True).repartition(6), group=group) == sorted(brute(rows), key=str)


def test_other_lengths(documents):
    texts = corpus(9)
    assert got(documents(texts), length=7, prefix=3) == sorted(brute(enumerate(texts), 7), key=str)
    assert got(documents(texts), length=33, prefix=8) == sorted(brute(enumerate(texts), 33), key=str)


@pytest.mark.parametrize("parts", [1, 2, 4])
def test_repeated_rows_are_one_document(documents, parts):
    text = " ".join(f"u{k}" for k in range(60))
    df = documents([text, text, "x " + text, text], ids=[5, 5, 7, 7]).repartition(parts, F.rand(3))
    found = sorted((r.doc_id, r.n_words, r.n_removed) for r in cut_repeated_words(df).collect())
    assert found[:2] == [(5, 60, 0), (5, 60, 0)]  # neither repeated row loses a word
    assert found[2:] == [(7, 60, 60), (7, 61, 60)]


def test_null_ids_stay_whole(documents):
    text = " ".join(f"u{k}" for k in range(30))
    found = sorted((str(r.doc_id), r.n_removed) for r in
                   cut_repeated_words(documents([text, text, text], ids=[None, 3, None])).collect())
    assert found == [("3", 0), ("None", 0), ("None", 0)]


def test_no_rows(documents):
    assert cut_repeated_words(documents([])).count() == 0
    assert got(documents([None, ""])) == [(0, 0, 0, ""), (1, 0, 0, "")]


def test_long_texts_in_segments(documents, monkeypatch):
    rng = random.Random(4)
    words = [f"w{rng.randrange(5000)}" for _ in range(4000)]
    raw = " ".join(words).encode()
    monkeypatch.setattr(suffix_trees, "_SEGMENT", 1000)
    seen = []
    for first, piece in suffix_trees._segments(raw, 20):
        found = piece.decode().split()
        assert words[first:first + len(found)] == found
        seen += [tuple(found[a:a + 20]) for a in range(len(found) - 19)]
    assert seen == [tuple(words[a:a + 20]) for a in range(len(words) - 19)]
    huge = ("x" * 5000 + " ").encode() * 50
    assert sum(len(p.split()) - 19 for _, p in suffix_trees._segments(huge, 20)) == 31


def test_very_long_text(documents):
    rng = random.Random(8)
    text = " ".join(f"w{rng.randrange(9)}" for _ in range(20)) + " " + " ".join(f"v{rng.randrange(10**6)}" for _ in range(700_000))
    texts = [text, "tail " + text[-3000:], "x" * 3_000_000]
    assert got(documents(texts)) == sorted(brute(enumerate(texts)), key=str)


def test_suffix_ranks_sort_suffixes():
    rng = np.random.default_rng(2)
    s = rng.integers(0, 3, 300)
    ranks = suffix_ranks(s, 11)
    keys = [tuple(s[i:i + 11]) for i in range(len(ranks))]
    assert len(ranks) == 290 and ranks.tolist() == [sorted(set(keys)).index(k) for k in keys]


def test_whole_table(spark):
    from tests.conftest import SF_ORACLE
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text")
    assert got(docs) == sorted(brute([tuple(r) for r in docs.collect()]), key=str)
