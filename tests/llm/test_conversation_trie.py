"""The trie against one built from all prefixes."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from barlab.llm import conversation_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(held)] for c, held in turns.items()}
    made = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        made[c] = turns.get(base, [])[:h] + own[h:]
    members = {}
    for c, held in made.items():
        for d in range(len(held) + 1):
            members.setdefault(tuple(held[:d]), []).append(c)
    out = []
    for prefix, held in members.items():
        d = len(prefix)
        below = [p for p in members if p[:d] == prefix]
        inner = {p[:-1] for p in members if p}
        ends = sorted(c for c in held if len(made[c]) == d)
        out.append((
            min(held), d, min(members[prefix[:-1]]) if d else None, len(held), sum(len(p) == d + 1 for p in below),
            sum(p not in inner for p in below), sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def found(spark, rows, size, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema).repartition(3)
    return sorted(map(tuple, conversation_trie.prefix_trie(df, size).select(*conversation_trie.NODE_COLUMNS).collect()), key=str)


def talks(n, seed, kinds=3, longest=9):
    rng = random.Random(seed)
    ids = rng.sample(range(-150, 420), n)
    return [(c, t, rng.choice(["user", "system"]), "abcde"[: rng.randint(0, kinds)]) for c in ids for t in range(rng.randint(1, longest))]


@pytest.mark.parametrize("size", [1, 6, 40, 10_000])
def test_equals_all_prefixes(spark, size):
    rows = talks(120, size, kinds=2)
    assert found(spark, rows, size) == plain(rows)


def test_copies_go_on_alike(spark):
    """Long copies are passed in one step, also where one of them is a beginning of the others."""
    long = [("user", f"turn {i}") for i in range(70)]
    rows = [(c, t, *long[t]) for c in range(100, 160) for t in range(70 if c % 7 else 30)]
    rows += [(c, t, "user", "else") for c in range(700, 720) for t in range(7)]
    assert found(spark, rows, 50) == plain(rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (0, None, None, None), (0, 1, "user", "hello 🙂"), (0, 1, "user", "hello 🙂"), (0, 2, None, ""), (0, 3, "a", "b"), (0, 4, "a", "b"),
        (0, 5, "a", "b"), (7, 1, "", ""), (7, 0, "user", None), (205, 1, "x", "y"), (None, 1, "user", "no id"), (300, None, "r", "t"),
        (300, None, "r", "t"), (301, 9, "r", "t"), (-5, 0, "n", "negative"), (99, 2, "user", "x" * 100_000), (12, 0, "a", "12"), (3, 0, "a", "3"),
    ]
    for size in (1, 100):
        assert found(spark, rows, size) == plain(rows)


def test_nothing_and_clashing_columns(spark):
    rows = talks(30, 4)
    df = spark.createDataFrame(rows, SCHEMA)
    assert conversation_trie.prefix_trie(df.limit(0)).count() == 0
    assert conversation_trie.prefix_trie(df.withColumn("conv_id", F.lit(None).cast("bigint"))).count() == 0
    more = df.withColumns({c: F.lit(c) for c in ("pos", "n_turns", "k1", "k2", "chars", "head", "at", "n", "kind", "len", "conv", "base", "h")})
    got = sorted(map(tuple, conversation_trie.prefix_trie(more, 5).select(*conversation_trie.NODE_COLUMNS).collect()), key=str)
    assert got == plain(rows)


def test_many_ends_at_one_node(spark, monkeypatch):
    """Lists of ends that are put together from several parts."""
    rows = [(c, 0, "user", "hi") for c in range(20_000, 29_000)]
    assert found(spark, rows, 100) == plain(rows)


def test_stretches_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "BLOCK", 8)
    rows = [(c, t, "user", f"turn {t}") for c in (100, 101, 102, 103) for t in range(45)]
    assert found(spark, rows, 20) == plain(rows)
