"""Quality of documents: a classifier's evidence, and what their path and host are like.

1. A naive Bayes classifier over bucketed measures of the text, trained by grouped counts over labelled rows, gives each
   document a log-likelihood ratio of good against bad.
2. Hierarchical empirical Bayes: the documents' probabilities are summed per path and per host. A host's rate is a beta posterior
   around the global rate, a path's one around its host's. How strongly a level is drawn to the one above
   it is estimated from how much the groups differ (method of moments), so a host or path
   with few documents stays close to what is known of the level above.
3. A document's posterior joins its evidence with the rate of its path as prior, without its own share in
   the path's and host's sums.

Sums per path and host are aggregated before they are shuffled; nothing collects the documents of a host.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlab.llm.common import broadcast_if_small, ship_package, slices, whole_text
from barlab.session import stage

#: Measures and the upper bounds of their buckets.
MEASURES = {
    "words": (5, 20, 50, 100, 1_000),
    "word_length": (2.5, 3.5, 4.5, 6.0, 7.5, 9.0),
    "symbols": (0.01, 0.05, 0.1, 0.3, 1.0),
    "distinct": (0.02, 0.1, 0.2, 0.35, 0.5, 0.65),
    "exclamations": (0.01, 0.05, 0.2, 1.0),
    "capitals": (0.05, 0.1, 0.2, 0.4),
    "digits": (0.01, 0.05, 0.15, 0.3),
    "repeated_lines": (0.05, 0.2, 0.4, 0.7),
}
SYMBOLS = re.compile(r"[#*$%&|<>\\^~_={}\[\]]")
CAPITALS = re.compile("[A-ZÀ-ÖØ-Þ]")
#: Words that the share of distinct ones is taken over at a time; the shares are averaged, so that it does not fall
#: with the length of a text.
STRETCH = 200
#: Labelled rows that the classifier is trained on, at most: those with the smallest hash of their id.
TRAINING_ROWS = 50_000
SMOOTHING = 1.0
#: Bounds of the strength, in documents, with which a group is drawn to the level above.
STRENGTHS = (2.0, 10_000.0)
KEEP_AT = 0.5
LEAST = 1e-4


def measure(text: str) -> tuple[float, ...]:
    """The measures of one text, in the order of ``MEASURES``."""
    words = text.split()
    n, chars = len(words), max(1, len(text))
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    shares = [len(set(part)) / len(part) for part in (words[i : i + STRETCH] for i in range(0, n, STRETCH))]
    # A short last stretch would weigh as much as a full one.
    weights = [min(STRETCH, n - i) for i in range(0, n, STRETCH)]
    return (
        float(n), sum(map(len, words)) / max(1, n), len(SYMBOLS.findall(text)) / max(1, n),
        sum(s * w for s, w in zip(shares, weights)) / max(1, n), text.count("!") / max(1, n),
        len(CAPITALS.findall(text)) / chars, sum(text.count(d) for d in "0123456789") / chars,
        (len(lines) - len(set(lines))) / max(1, len(lines)),
    )


def bucket(values: tuple[float, ...]) -> list[int]:
    return [sum(v > bound for bound in bounds) for v, bounds in zip(values, MEASURES.values())]


def measured(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and a bucket ``m_...`` per measure for every row."""
    ship_package(docs.sparkSession)
    source = docs.select(*[F.col(f"`{k}`") for k in keys], whole_text(text).alias("__text"))
    names = [f"m_{m}" for m in MEASURES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text"):
            rows = [bucket(measure(x)) for x in batch.column(batch.num_columns - 1).to_pylist()]
            columns = [pa.array(c, pa.int32()) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*keys, *names])

    kinds = dict(source.dtypes)
    return source.mapInArrow(run, ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), *(f"{n} int" for n in names)]))


def train(rows: DataFrame, labels: DataFrame, bound: int = TRAINING_ROWS) -> dict[str, list[float]]:
    """Per measure and bucket, the log-likelihood of good against bad.

    ``rows`` has ``doc_id`` and the buckets, ``labels`` has ``doc_id`` and ``quality`` (1 good, 0 bad; other
    values are ignored). Of labelled rows at most ``bound`` are used. Ids that repeat count once per row. Without labels all ratios are 0.
    """
    known = labels.where("doc_id is not null and quality in (0, 1)").select("doc_id", "quality").distinct()
    ranked = known.withColumn("__h", F.xxhash64("doc_id")).orderBy("__h", "doc_id", "quality").limit(bound)
    joined = rows.join(broadcast_if_small(stage(ranked.select("doc_id", "quality"), "labelled")), "doc_id")
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(f"m_{m}").alias("b")) for m in MEASURES])
    counted = joined.select("quality", F.explode(pairs).alias("p")).groupBy("p.measure", "p.b", "quality").count()
    found = {(r["measure"], r["b"], r["quality"]): r["count"] for r in counted.collect()}  # buckets x 2 at most
    ratios = {}
    for m, bounds in MEASURES.items():
        size, total = len(bounds) + 1, [sum(found.get((m, b, q), 0) for b in range(len(bounds) + 1)) for q in (0, 1)]
        share = [[(found.get((m, b, q), 0) + SMOOTHING) / (total[q] + SMOOTHING * size) for b in range(size)] for q in (0, 1)]
        ratios[m] = [math.log(g / b) if min(total) else 0.0 for b, g in zip(*share)]
    return ratios


def evidence(ratios: dict[str, list[float]]) -> Column:
    total = F.lit(0.0)
    for m, values in ratios.items():
        total = total + F.get(F.array(*[F.lit(v) for v in values]), F.col(f"m_{m}"))
    return total


def _logit(p: Column) -> Column:
    held = F.least(F.greatest(p, F.lit(LEAST)), F.lit(1 - LEAST))
    return F.log(held / (1 - held))


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def strength(groups: DataFrame, n: str, total: str, prior: Column) -> float:
    """How many documents the level above is worth: moments of groups' rates around ``prior``.

    ``groups`` has one row per group, with its number of documents and the sum of their probabilities. With less
    spread between groups than chance makes, or with fewer than two groups, the strength is the largest.
    """
    rate = F.col(total) / F.col(n)
    got = groups.where(F.col(n) > 0).select(
        F.col(n).alias("n"), (rate - prior).alias("off"), (prior * (1 - prior)).alias("v")
    ).agg(
        F.count(F.lit(1)).alias("k"), F.sum(F.col("n") * F.col("off") * F.col("off")).alias("spread"),
        F.sum("v").alias("chance"), F.sum(F.col("n") * F.col("v")).alias("weighed"),
    ).first()
    if got["k"] < 2 or not got["weighed"]:
        return STRENGTHS[1]
    excess = (got["spread"] - got["chance"]) / max(got["weighed"] - got["chance"], 1e-12)
    return min(max(1 / excess - 1, STRENGTHS[0]), STRENGTHS[1]) if excess > 0 else STRENGTHS[1]


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column, text: str = "text") -> DataFrame:
    """``doc_id, p_document, p_host, p_path, p_good, kept`` per row of ``docs``.

    ``p_document``: by the text alone, with the labelled rows' rate as prior. ``p_host`` and ``p_path``: posterior rates without
    the document itself. ``p_good`` joins the text's evidence with ``p_path``; ``kept`` if it is at least ``KEEP_AT``. A
    path belongs to a host: the same path name under two hosts is two paths. Null hosts and paths are groups
    of their own. A null or empty text is measured as one without words. Rows keep their lines,
    whether they repeat or lack an id; other columns are ignored; an empty table gives an empty one.
    """
    keyed = docs.select("doc_id", host.cast("string").alias("host"), path.cast("string").alias("path"), F.col(f"`{text}`").alias("text"))
    rows = stage(measured(keyed, ["doc_id", "host", "path"]), "measured")
    ratios = train(rows, labels)
    known = labels.where("quality in (0, 1)").agg(F.avg("quality")).first()[0]
    base = min(max(known if known is not None else 0.5, LEAST), 1 - LEAST)
    scored = stage(rows.select("doc_id", "host", "path", evidence(ratios).alias("ratio")).withColumn(
        "p_document", _sigmoid(F.col("ratio") + math.log(base / (1 - base)))
    ), "scored")
    paths = stage(scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n_path"), F.sum("p_document").alias("s_path")), "paths")
    hosts = stage(paths.groupBy("host").agg(F.sum("n_path").alias("n_host"), F.sum("s_path").alias("s_host")), "hosts")
    overall = hosts.agg(F.sum("s_host") / F.sum("n_host")).first()[0]
    mean = overall if overall is not None else base
    of_host = strength(hosts, "n_host", "s_host", F.lit(mean))
    rate = (F.col("s_host") + of_host * mean) / (F.col("n_host") + of_host)
    both = stage(paths.join(hosts.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h"))).drop("h"), "rates")
    of_path = strength(both, "n_path", "s_path", rate)
    groups = both.select(F.col("host").alias("h"), F.col("path").alias("p"), "n_path", "s_path", "n_host", "s_host")
    same = F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p"))
    joined = scored.join(broadcast_if_small(groups, 100_000), same)
    own = F.col("p_document")
    p_host = (F.col("s_host") - own + of_host * mean) / (F.col("n_host") - 1 + of_host)
    p_path = (F.col("s_path") - own + of_path * F.col("p_host")) / (F.col("n_path") - 1 + of_path)
    judged = joined.withColumn("p_host", p_host).withColumn("p_path", p_path)
    judged = judged.withColumn("p_good", _sigmoid(F.col("ratio") + _logit(F.col("p_path"))))
    return judged.select("doc_id", "p_document", "p_host", "p_path", "p_good", (F.col("p_good") >= KEEP_AT).alias("kept"))
