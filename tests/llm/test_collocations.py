"""Collocations against a count of all phrases, and the index against the text."""

import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barlab.llm import collocations

LOWER = {i: i + 32 for i in range(65, 91)}
PIECES, WORDS = re.compile("[.,;:!?\x0a-\x0d]"), re.compile("[^\x20\x09]+")


def plain(rows, longest=3, fewest=10, percent=50, top=2_000):
    counts = {}
    for lang, text in rows:
        own = counts.setdefault(lang or "und", Counter()) if lang != "" else counts.setdefault("", Counter())
        for piece in PIECES.split((text or "").translate(LOWER)):
            words = WORDS.findall(piece)
            for d in range(1, longest + 1):
                own.update(tuple(words[i : i + d]) for i in range(len(words) - d + 1))
    out = []
    for lang, own in counts.items():
        n = sum(c for g, c in own.items() if len(g) == 1)
        found = []
        for g, a in own.items():
            if len(g) < 2 or a < fewest:
                continue
            if any(c >= fewest and 100 * c >= percent * a and len(h) > len(g)
                   and any(h[i : i + len(g)] == g for i in range(len(h))) for h, c in own.items()):
                continue
            score, _, left, right = min((10**6 * a * a // (own[g[:k]] * own[g[k:]]), k, own[g[:k]], own[g[k:]]) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def rows_of(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


SMALL = [
    ("en", "New York is big. new YORK is big, New\tYork  is old; new york"), ("en", "is big is big is big is big"), ("en", None), ("en", ""),
    (None, "a b a b a b a b"), ("und", "a b\x0ba b"), ("", "x x x x x"), ("de", "...,,;;"), ("en", "new york is big\x00 is\x1f big"),
    ("fr", "ünï cödé ünï cödé ünï cödé 🙂 🙂 🙂"),
]


@pytest.mark.parametrize("longest", [2, 3, 5])
@pytest.mark.parametrize("shard_words", [4, 10**6])
def test_small_texts_equal_counts(spark, longest, shard_words):
    docs = spark.createDataFrame(SMALL, "lang string, text string").repartition(3)
    got = collocations.mine_collocations(docs, longest, 2, 60, None, shard_words=shard_words)
    assert rows_of(got) == plain(SMALL, longest, 2, 60, None)


def test_a_full_filter_changes_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("lang", "text").limit(60)
    rows = [tuple(r) for r in docs.collect()]
    held = spark.createDataFrame(rows, "lang string, text string")
    got = collocations.mine_collocations(held, fewest=4, top=50, filter_bits=64)
    assert rows_of(got) == plain(rows, fewest=4, top=50)


def test_nothing_and_clashing_columns(spark, odd, nothing):
    assert collocations.mine_collocations(nothing).count() == 0
    got = collocations.mine_collocations(odd.withColumnsRenamed({"n": "a", "h": "word"}), fewest=1)
    assert {r.lang for r in got.collect()} == {"und"}
    assert rows_of(got) == plain([(None, r.text) for r in odd.select("text").collect()], fewest=1)


def test_words_that_share_an_id_are_told_apart(spark, monkeypatch):
    honest = collocations._word_id
    monkeypatch.setattr(collocations, "_word_id", lambda seed, word: honest(seed, word) % 3 if seed < 2 else honest(seed, word))
    docs = spark.createDataFrame(SMALL, "lang string, text string")
    shards = collocations.build_shards(docs.na.fill("und", ["lang"]).na.fill(""), 3)
    assert collocations.count_words(shards)[1] == 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=80), st.integers(1, 4))
def test_intervals_are_the_phrases(symbols, length):
    """Counts of all phrases, and both intervals: the same size, and the right neighbours."""
    s = np.array([*symbols, 0], np.int32)
    kinds = 6
    strings = [collocations.transform(x, length + 1, kinds) for x in (s, s[::-1])]
    shard = collocations.Shard(*(collocations.packed(x, kinds) for x in strings), kinds)
    open_ = [collocations.Filter(np.full(1, 2**64 - 1, np.uint64), 64)] * length
    found = shard.phrases(length, open_, np.arange(kinds))
    want = Counter(tuple(s[i : i + length]) for i in range(len(s) - length + 1) if 0 not in s[i : i + length])
    got = {tuple(int(w[i]) for w in found.words): int(found.size[i]) for i in range(len(found.size))}
    assert got == want
    ring = [*s]
    for i in range(len(found.size)):
        phrase = tuple(int(w[i]) for w in found.words)
        places = [p for p in range(len(s)) if tuple(ring[(p + j) % len(s)] for j in range(length)) == phrase]
        low, other, size = int(found.low[i]), int(found.other[i]), int(found.size[i])
        assert Counter(strings[0][low : low + size].tolist()) == Counter(int(ring[p - 1]) for p in places)
        assert Counter(strings[1][other : other + size].tolist()) == Counter(int(ring[(p + length) % len(s)]) for p in places)


def test_large_numbers_stay_exact(spark):
    """Counts whose products pass 64 bits."""
    big = 3 * 10**12
    words = spark.createDataFrame([(1, big), (2, big + 1)], "w1 bigint, a bigint")
    pairs = spark.createDataFrame([(1, 2, big - 1)], "w1 bigint, w2 bigint, a bigint")
    row = collocations.scored([words, pairs], 2).first()
    assert row.score == 10**6 * (big - 1) ** 2 // (big * (big + 1))


def test_a_very_long_text_is_read_whole(spark):
    text = "alpha beta " * 150_000 + "gamma delta " * 12 + "." + "omega psi " * 300_000
    docs = spark.createDataFrame([("en", text)], "lang string, text string")
    got = {r.phrase: r.a for r in collocations.mine_collocations(docs, 2, top=None).collect()}
    assert got["gamma delta"] == 12 and got["alpha beta"] == 150_000 and got["omega psi"] == 300_000
