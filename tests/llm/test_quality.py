"""Quality rules, voters, the quality classifier, and the pipeline."""

import collections
import math
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from barlab.llm import quality_classifier, quality_rules, registry, sentencepiece_codec, simhash, votes
from checks.compare import oracle_connection, sorted_rows

SF = "/root/testdata/sf0.01"
WORD = re.compile("[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows, hit = collections.Counter(zip(words, words[1:], words[2:])), set()
    for k in range(len(words) - 2):
        if windows[tuple(words[k : k + 3])] > 1:
            hit |= {k, k + 1, k + 2}
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def test_counts_equal_brute_force(spark, odd):
    odd_texts = [r.text for r in odd.select("text").collect()]
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + odd_texts
    texts += ["a b c a b c", "a a a a", "x\x1cy\x85z w", "l\nl\n \nl\r\nl\r", " " * 4_000 + "a" + "\t" * 4_000, "a b c d " * 5_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: tuple(r[c] for c in quality_rules.COUNTS) for r in quality_rules.text_counts(df).collect()}
    assert got == {i: plain_counts(t) for i, t in enumerate(texts)}


def test_verdicts_agree_with_labels(spark):
    """The labels are not used by the rules."""
    rows = quality_rules.quality_verdicts(spark.read.parquet(f"{SF}/documents.parquet"))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = collections.Counter((r.quality, r.base_failed, r.kept) for r in rows.join(labels, "doc_id").collect())
    assert got[1, False, False] <= 0.01 * got[1, False, True]
    assert got[0, False, True] <= 0.05 * sum(n for (q, _, _), n in got.items() if q == 0)
    assert got[1, True, True] == got[0, True, True] == 0


def test_odd_quality(odd, nothing):
    rows = quality_rules.quality_verdicts(odd).collect()
    assert len(rows) == odd.count() and not any(r.kept for r in rows)
    assert quality_rules.quality_verdicts(nothing).count() == 0
    assert quality_rules.keep_good(odd).columns == odd.columns
    assert quality_rules.keep_good(nothing).count() == 0


def test_keep_good_acts_on_the_verdicts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = sorted(r.doc_id for r in quality_rules.quality_verdicts(docs).where("kept").collect())
    assert sorted(r.doc_id for r in quality_rules.keep_good(docs).collect()) == want


def test_voters_recover_planted_rates(spark):
    """Two kinds of trouble, each found by its own voter, one of which is careless."""
    start = votes.beginners(["a", "b"], calm=0.9, own=0.9, other=0.1, false=0.01, edge=5.0)
    cells = {  # (a, b): rows of calm, trouble a, trouble b
        (0, 0): (7_000, 60, 40), (1, 0): (70, 540, 4), (0, 1): (350, 6, 360), (1, 1): (3, 54, 36), (2, 0): (900, 20, 5), (0, 2): (500, 5, 5),
    }
    rows = [(*k, sum(n)) for k, n in cells.items()]
    model = votes.fit(spark.createDataFrame(rows, "a int, b int, n bigint"), start)
    assert abs(model.share[0] - 0.88) < 0.03
    assert abs(model.rates["a"][1] - 0.9) < 0.08 and model.rates["a"][0] < 0.02
    assert abs(model.rates["b"][2] - 0.9) < 0.15 and model.rates["b"][0] < 0.07
    assert votes.fit(spark.createDataFrame([], "a int, b int, n bigint"), start) == start


def test_an_edge_keeps_the_classes_apart(spark):
    start = votes.beginners(["a"], calm=0.9, own=0.9, other=0.1, false=0.01, edge=40.0)
    model = votes.fit(spark.createDataFrame([(1, 500), (0, 500)], "a int, n bigint"), start)
    assert model.rates["a"][1] >= 39.9 * model.rates["a"][0] or model.rates["a"][1] > 0.97


def test_classifier_on_held_out_labels(spark):
    """Trained on two thirds of the labels, tried on the rest."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held_out = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(1)), F.lit(3)) == 0
    rows = quality_classifier.classify(docs, labels.where(~held_out), F.col("source"), F.col("lang"))
    got = collections.Counter((r.quality, r.kept) for r in rows.join(labels.where(held_out), "doc_id").collect())
    assert got[1, True] >= 0.98 * (got[1, True] + got[1, False])
    assert got[0, False] >= 0.95 * (got[0, True] + got[0, False])


def test_posteriors_equal_brute_force(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    monkeypatch.setattr(quality_classifier, "strength", lambda groups, n, total, prior: 7.0)
    rows = quality_classifier.classify(docs, labels, F.col("source"), F.col("lang")).collect()
    where = {r.doc_id: (r.source, r.lang) for r in docs.collect()}
    mean = sum(r.p_document for r in rows) / len(rows)
    hosts, paths = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        hosts[where[r.doc_id][0]].append(r.p_document)
        paths[where[r.doc_id]].append(r.p_document)
    for r in rows:
        host, path = hosts[where[r.doc_id][0]], paths[where[r.doc_id]]
        p_host = (sum(host) - r.p_document + 7 * mean) / (len(host) - 1 + 7)
        p_path = (sum(path) - r.p_document + 7 * p_host) / (len(path) - 1 + 7)
        assert math.isclose(r.p_host, p_host, rel_tol=1e-9) and math.isclose(r.p_path, p_path, rel_tol=1e-9)


def test_strength_follows_the_spread(spark):
    alike = spark.createDataFrame([(100, 50.0 + i % 3) for i in range(50)], "n bigint, s double")
    apart = spark.createDataFrame([(100, 95.0 if i % 2 else 5.0) for i in range(50)], "n bigint, s double")
    assert quality_classifier.strength(alike, "n", "s", F.lit(0.5)) == quality_classifier.STRENGTHS[1]
    assert quality_classifier.strength(apart, "n", "s", F.lit(0.5)) == quality_classifier.STRENGTHS[0]


def test_sparse_paths_stay_near_their_host(spark):
    good, bad = "These are ordinary words in a fine sentence, all of them. " * 12, "$$$ ### !!! *** " * 60
    rows = [(i, good + str(i), "h", "big") for i in range(200)] + [(1000, bad, "h", "small"), (1001, good, "h", "small")]
    rows += [(i, f"{bad} {i}", "g", "p") for i in range(2000, 2040)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, host string, path string")
    labels = spark.createDataFrame([(i, 1) for i in range(60)] + [(i, 0) for i in range(2000, 2020)], "doc_id bigint, quality int")
    got = {r.doc_id: r for r in quality_classifier.classify(docs, labels, F.col("host"), F.col("path")).collect()}
    assert got[1001].p_path > 0.5 and got[1001].kept and not got[1000].kept


def test_odd_classifier(odd, nothing):
    labels = odd.select("doc_id", F.lit(1).alias("quality"))
    rows = quality_classifier.classify(odd, labels, F.col("source"), F.col("lang")).collect()
    assert len(rows) == odd.count() and all(0 <= r.p_good <= 1 for r in rows)
    assert quality_classifier.classify(nothing, labels, F.col("source"), F.col("lang")).count() == 0
    assert quality_classifier.classify(odd, labels.limit(0), F.col("source"), F.col("lang")).count() == odd.count()


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_queries_equal_their_sql(spark, name):
    df = registry.QUERIES[name](spark, "/root/testdata/sf0.001")
    relation = oracle_connection("/root/testdata/sf0.001").sql(registry.ORACLES[name])
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(relation.columns, relation.fetchall())


def test_pipeline_keeps_columns_and_takes_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, at, kept = docs.columns, docs, {}
    for name, step in corpus_pipeline.STAGES[:-1]:
        path = f"{registry.shared_folder(spark)}/pipeline-test/{name}-{id(docs)}"
        step(spark, at, SF).write.mode("overwrite").parquet(path)
        at = spark.read.parquet(path)
        assert at.columns == columns
        kept[name] = {r.doc_id: r.text for r in at.collect()}
    quality, lines, near, clean = (kept[n] for n, _ in corpus_pipeline.STAGES[:-1])
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(texts[i] == t for i, t in quality.items()) and len(quality) < len(texts)
    assert set(lines) == set(quality) and lines != quality
    assert set(near) < set(lines) and set(clean) < set(near)
    left = spark.createDataFrame(list(near.items()), "doc_id bigint, text string")
    assert simhash.near_duplicates(left).where("component_id <> doc_id").count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, at, SF).collect()
    assert {r.doc_id for r in last} == set(clean) and all(r.round_trip for r in last)
    library = sentencepiece_codec.marked_words(registry.PIECE_MODEL).pieces
    assert all(r.ids == library.encode(clean[r.doc_id]) for r in last)


def test_pipeline_on_odd_rows(spark, odd, nothing):
    for rows in (odd, nothing):
        for _, step in corpus_pipeline.STAGES:
            made = step(spark, rows, SF)
            assert made.count() <= rows.count()
