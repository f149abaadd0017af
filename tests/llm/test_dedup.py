"""Near-duplicates, line chunks and decontamination against brute force."""

import hashlib
import random
import re

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barlab.llm import decontamination, line_dedup, simhash
from barlab.llm.graph import components

LOWER = {i: i + 32 for i in range(65, 91)}


def plain_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, bits=3):
    parent = list(range(len(prints)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return [top(i) for i in range(len(prints))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_near_duplicates_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = sorted(docs.collect())
    prints = [plain_fingerprint(r.text) for r in rows]
    roots = plain_components(prints)
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    for i, r in enumerate(rows):
        assert got[r.doc_id].fingerprint == f"{prints[i]:016x}"
        assert got[r.doc_id].component_id == rows[roots[i]].doc_id


def dense_prints(n, seed):
    """Fingerprints of a large dense group, a long chain, and strangers."""
    rng = random.Random(seed)
    centre = rng.getrandbits(64)
    near = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(n)}
    chain, x = [], rng.getrandbits(64)
    for i in range(60):
        x ^= sum(1 << b for b in rng.sample(range(64), 3))
        chain.append(x)
    return sorted(near | set(chain) | {rng.getrandbits(64) for _ in range(n)} | {0, 1, 7, (1 << 64) - 1})


@pytest.mark.parametrize("bucket", [64, 1_024])
def test_links_connect_like_all_pairs(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash.buckets, "__defaults__", (bucket,))
    prints = dense_prints(250, bucket)
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp bigint").repartition(3)
    got = {r.node: r.root for r in components(simhash.links(df)).collect()}
    roots = plain_components(prints)
    groups, want = {}, {}
    for p, root in zip(prints, roots):
        groups.setdefault(root, []).append(signed(p))
    for members in groups.values():
        if len(members) > 1:
            want.update({m: min(members) for m in members})
    assert got == want


def test_buckets_keep_their_size(spark):
    prints = dense_prints(300, 3)
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp bigint")
    sizes = simhash.buckets(df, 3, 64).groupBy("mask", "key").count().agg(F.max("count")).first()[0]
    assert sizes <= 64


def test_buckets_start_no_other_python_workers(spark):
    prints = spark.range(10).withColumnRenamed("id", "fp")
    plan = simhash.buckets(prints, 3)._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan


def test_odd_near_duplicates(odd, nothing):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    empty = [r for r in rows if r.fingerprint == "0" * 16]
    assert {r.component_id for r in empty} == {1}
    assert simhash.near_duplicates(nothing).count() == 0
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert kept.where("doc_id = 4").count() == 2  # one of two alike, and the other text
    assert kept.where("text is null or text = ''").count() == 1
    assert simhash.keep_one(nothing).count() == 0


def test_keep_one_keeps_the_smallest_of_each_component(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = simhash.near_duplicates(docs)
    want = sorted(r[0] for r in found.select("component_id").distinct().collect())
    kept = simhash.keep_one(docs.union(docs))
    assert sorted(r.doc_id for r in kept.collect()) == want


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components(spark, pairs):
    pairs = pairs + [(100 + i, 101 + i) for i in range(40)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    label = {x: x for p in pairs for x in p}
    for _ in label:
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    assert got == label


def lines_of(*numbers):
    return "\n".join(f"line number {i} of the text" for i in numbers)


def test_boundaries_do_not_shift():
    lines = [f"line {i}".encode() for i in range(400)]
    ends = line_dedup.boundaries(lines)
    moved = line_dedup.boundaries([b"new", b"lines", b"above", *lines])
    assert ends[-1] == 400 and len(ends) > 60
    later = {e for e in ends if e > 20}
    assert later <= {e - 3 for e in moved}
    assert all(b - a >= 2 for a, b in zip([0, *ends], ends[:-1]))


def plain_dedup(rows):
    """Chunks that are kept, by bytes and in order of id."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        kept = []
        for chunk in line_dedup.chunks(text.encode(), line_dedup.WINDOW, line_dedup.DIVISOR, line_dedup.MIN_LINES):
            body = b"\n".join(chunk)
            if sum(1 for x in chunk if x.strip()) > 1:
                if body in seen:
                    continue
                seen.add(body)
            kept.extend(chunk)
        out[i] = b"\n".join(kept).decode()
    return out


def test_line_dedup_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = plain_dedup([(r.doc_id, r.text) for r in docs.collect()])
    got = line_dedup.dedup_lines(docs.repartition(5)).collect()
    assert {r.doc_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got if r.n_chunks_removed)
    assert sum(r.n_chunks_removed for r in got) > 50


def test_shared_passage_is_removed_behind_the_first(spark):
    passage = lines_of(*range(50, 80))
    texts = [f"{lines_of(*range(1000 * i, 1000 * i + 3 + i % 4))}\n{passage}\n{lines_of(*range(1000 * i + 500, 1000 * i + 505))}" for i in range(1, 30)]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    assert got[0].text == texts[0]
    for i in range(1, 29):
        assert got[i].n_lines_removed >= 20
        assert lines_of(1000 * (i + 1), 1000 * (i + 1) + 1) in got[i].text


def test_odd_line_dedup(spark, odd, nothing):
    rows = line_dedup.dedup_lines(odd).collect()
    assert len(rows) == odd.count()
    assert [r.text for r in rows if r.doc_id == 1] == [None]
    assert line_dedup.dedup_lines(odd).columns == [*odd.columns, "n_chunks_removed", "n_lines_removed"]
    assert line_dedup.dedup_lines(nothing).count() == 0
    same = spark.createDataFrame([(7, "a b\nc d\ne f"), (7, "a b\nc d\ne f"), (8, "a b\nc d\ne f")], "doc_id bigint, text string")
    got = sorted((r.doc_id, r.text) for r in line_dedup.dedup_lines(same).collect())
    assert got[:2] == [(7, "a b\nc d\ne f")] * 2 and got[2][0] == 8


def plain_cuts(lines):
    """Lines that bound passages: long ones, and three in four of the short ones by a hash over two lines."""
    out, before = [], None
    for k, x in enumerate(lines):
        line = x.encode()
        if not line.strip():
            continue
        h = xxhash.xxh64_intdigest(line)
        rolling = (h if before is None else before * int(line_dedup.STEP) + h) % 2**64
        if line.count(b" ") >= 7 or (rolling >> 17) % 4:
            out.append(k)
        before = h
    return out


def plain_passages(rows, least=20):
    """Lines between two boundary lines, or a long line, that stand earlier too, text by text."""
    seen, out = {}, {}
    for i, text in sorted(rows):
        lines = text.split("\n")
        filled = [k for k, x in enumerate(lines) if x.encode().strip()]
        cuts = plain_cuts(lines)
        units = [(a, b) for a, b in zip(cuts, cuts[1:])]
        units += [(a, a) for a in cuts if len(lines[a].encode().split()) > line_dedup.LONG_WORDS]
        marked = set()
        for a, b in units:
            place = seen.setdefault("\n".join(lines[a : b + 1]), (i, a, b))
            if place[0] != i or place[2] < a:
                marked |= set(range(a, b + 1))
        runs, run = [], []
        for k in filled + [None]:
            if k in marked:
                run.append(k)
            elif run:
                runs.append(run)
                run = []
        gone = set()
        for run in runs:
            if sum(len(lines[k].encode().split()) for k in run) >= least:
                gone |= set(range(run[0], run[-1] + 1)) & marked
        out[i] = "" if filled and gone >= set(filled) else "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def test_passages_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = plain_passages([(r.doc_id, r.text) for r in docs.collect()])
    got = line_dedup.dedup_passages(docs.repartition(5)).collect()
    assert {r.doc_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got if r.n_chunks_removed)
    chunked = {r.doc_id: r.n_lines_removed for r in line_dedup.dedup_lines(docs).collect()}
    assert sum(r.n_lines_removed for r in got) > sum(chunked.values())


def test_short_passages_go_whole_in_other_surroundings(spark):
    texts = []
    for n in range(1, 7):
        passage = "\n".join(" ".join(f"shared{n}x{i}y{w}" for w in range(60 // n + 1)) for i in range(n))
        texts += [f"{lines_of(10 * i, 10 * i + 1)}\n{passage}\n{lines_of(10 * i + 2)}" for i in range(10 * n, 10 * n + 8)]
    got = {r.doc_id: r for r in line_dedup.dedup_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    for i, text in enumerate(texts):
        n, k = i // 8 + 1, i % 8
        assert got[i].text == (lines_of(*range(10 * (10 * n + k), 10 * (10 * n + k) + 3)) if k else text)
        assert (got[i].n_chunks_removed, got[i].n_lines_removed) == ((1, n) if k else (0, 0))


def test_pairs_of_short_lines_stay(spark):
    texts = ["alpha one\n}\n}\nbeta", "gamma\n}\n}\ndelta", "Yes\nNo\nepsilon", "Yes\nNo\nzeta"]
    got = line_dedup.dedup_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.text, r.n_lines_removed) for r in got) == [(i, t, 0) for i, t in enumerate(texts)]


def test_runs_of_many_short_lines_go(spark):
    """A list of 60 short lines in other surroundings: nearly all of it goes."""
    shared = "\n".join(f"item {i}" for i in range(60))
    texts = [f"head {i} of the list\n{shared}\ntail {i}" for i in range(30)]
    got = {r.doc_id: r for r in line_dedup.dedup_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    assert got[0].text == texts[0]
    assert all(55 <= got[i].n_lines_removed <= 60 and f"head {i} " in got[i].text and f"tail {i}" in got[i].text for i in range(1, 30))


def test_a_full_filter_changes_no_text(spark, monkeypatch):
    from barlab.llm import collocations

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = plain_passages([(r.doc_id, r.text) for r in docs.collect()])
    monkeypatch.setattr(collocations.make_filter, "__defaults__", (64,))
    assert {r.doc_id: r.text for r in line_dedup.dedup_passages(docs).collect()} == want


def test_odd_passages(spark, odd, nothing):
    rows = line_dedup.dedup_passages(odd).collect()
    assert len(rows) == odd.count()
    assert [r.text for r in rows if r.doc_id == 1] == [None]
    assert line_dedup.dedup_passages(nothing).count() == 0
    one, two = " ".join(["one"] * 10), " ".join(["two"] * 10)
    same = spark.createDataFrame([
        (1, f"{one}\n{one}\n{one}\n{one}\n{one}"), (2, f"{two}\n{two}\n{two}"), (3, f"\nx\n\n{one}\n{one}\n"), (4, f"{one}\n\n{one}"),
        (5, f"\n{one}\n{one}\n"), (5, f"\n{one}\n{one}\n"),
    ], "doc_id bigint, text string")
    got = sorted((r.doc_id, r.text) for r in line_dedup.dedup_passages(same).collect())
    assert got == [(1, f"{one}\n{one}"), (2, f"{two}\n{two}\n{two}"), (3, "\nx\n\n"), (4, f"{one}\n\n{one}"), (5, ""), (5, "")]


WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_hits(docs, items, window=10):
    out = []
    for i, text in docs:
        words, hit, found = WORDS.findall((text or "").translate(LOWER)), set(), set()
        for item, body in items:
            need = WORDS.findall((body or "").translate(LOWER))
            for k in range(max(len(need) - window + 1, 1) if need else 0):
                part = need[k : k + window]
                for p in range(len(words) - len(part) + 1):
                    if words[p : p + len(part)] == part:
                        hit |= set(range(p, p + len(part)))
                        found.add(str(item))
        digest = hashlib.sha256(",".join(sorted(found - {"None"})).encode()).hexdigest()
        out.append((i, len(words), len(hit), len(found - {"None"}), digest, bool(hit)))
    return sorted(out, key=repr)


def test_decontamination_equals_brute_force(spark, odd):
    rng = random.Random(5)
    vocabulary = ["a", "the", "of", "Ünder", "x9", "rare", "über"]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 90))).replace("rare", "Rare,", 1)) for i in range(60)]
    docs += [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    cut = [(str(100 + i), " ".join(WORDS.findall(docs[i][1].translate(LOWER))[5 : 5 + n])) for i, n in enumerate([30, 14, 11, 10, 9, 3, 2, 1])]
    items = [(int(a), b) for a, b in cut] + [(7, "The the THE"), (7, "of! a; of-x9"), (8, ""), (9, None), (None, "ünder Rare"), (10, "never seen at all")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("words", F.lit(1))
    benchmark = spark.createDataFrame(items + items[:2], "item_id bigint, text string")
    got = decontamination.decontaminate(df, benchmark)
    assert sorted((tuple(r)[:6] for r in got.collect()), key=repr) == plain_hits(docs, items)
    clean = sorted((r.doc_id is None, r.doc_id or 0) for r in decontamination.keep_clean(df, benchmark).collect())
    assert clean == sorted((r[0] is None, r[0] or 0) for r in plain_hits(docs, items) if not r[5])


def test_decontamination_of_empty_tables(odd, nothing):
    items = nothing.select(F.col("doc_id").alias("item_id"), "text")
    rows = decontamination.decontaminate(odd, items).collect()
    assert len(rows) == odd.count() and not any(r.contaminated for r in rows)
    assert decontamination.decontaminate(nothing, odd.select(F.col("doc_id").alias("item_id"), "text")).count() == 0
    assert decontamination.keep_clean(odd, items).count() == odd.count()
