"""SimHash near-duplicates by pigeonhole blocks.

Two fingerprints that differ in at most ``max_bits`` bits agree in at least one of ``max_bits + 1`` blocks of
bits. Fingerprints are therefore dealt into buckets by block and value. A bucket with more
than ``BUCKET`` different fingerprints is dealt again by blocks of its remaining bits, by the same
argument, until it is small; buckets that agree in 54 bits hold 1,024 fingerprints at most, so this ends, no
bucket is cut and no pair is lost. Inside a bucket Hamming distances are verified, and a bucket
hands on a star per group of linked fingerprints, not its pairs. Equal
fingerprints are one node from the start, so copies cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.llm.common import broadcast_if_small, ship_package, slices, whole_text
from barlab.llm.graph import components
from barlab.llm.key_filter import split_by_keys
from barlab.session import stage

SEED = 42
#: Different fingerprints that one task compares with each other.
BUCKET = 1_024
#: Shingles whose bits are counted at a time.
SHINGLES = 500_000
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The 64 bits of one text, as a signed integer."""
    words = text.translate(LOWER).split()  # ASCII white space, as bytes know no other
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, n, SHINGLES):
        part = words[i : i + SHINGLES + shingle - 1]
        grams = zip(*(part[k:] for k in range(shingle))) if len(words) >= shingle else [words]
        hashes = b"".join([xxhash.xxh64_digest(b" ".join(g), SEED) for g in grams])
        bits = np.unpackbits(np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys`` and ``fp`` per row. Null and empty texts, and texts without words, have fingerprint 0."""
    ship_package(docs.sparkSession)
    source = docs.select(*[F.col(f"`{k}`") for k in keys], whole_text(text).cast("binary").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text"):
            found = [fingerprint(t.as_py(), shingle) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.int64())], names=[*keys, "fp"])

    kinds = dict(docs.dtypes)
    return source.mapInArrow(run, ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "fp bigint"]))


def blocks(mask: int, parts: int) -> list[int]:
    """``mask`` with each of ``parts`` blocks of its unset bits added."""
    free = [b for b in range(64) if not mask >> b & 1]
    cuts = [len(free) * k // parts for k in range(parts + 1)]
    return [mask | sum(1 << b for b in free[i:j]) for i, j in zip(cuts, cuts[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def buckets(prints: DataFrame, max_bits: int, size: int = BUCKET) -> DataFrame:
    """Rows ``mask, key, fp`` such that close fingerprints share a bucket ``(mask, key)`` of at most ``size``.

    ``prints`` has different, non-null ``fp``. The loop ends after seven levels at the latest.
    """
    spark = prints.sparkSession
    rows = prints.select(F.lit(0).cast("bigint").alias("mask"), "fp")
    masks, leaves = [0], []
    while True:
        finer = [(_signed(m), _signed(c)) for m in masks for c in blocks(m, max_bits + 1)]
        # At most 4^level rows. From a list they would come by an RDD, for which every executor starts more Python workers.
        table = pa.table([pa.array(c, pa.int64()) for c in zip(*finer)], names=["mask", "child"])
        table = F.broadcast(spark.createDataFrame(table))
        dealt = rows.join(table, "mask").select(
            F.col("child").alias("mask"), F.col("fp").bitwiseAND(F.col("child")).alias("key"), "fp"
        )
        large = stage(dealt.groupBy("mask", "key").count().where(F.col("count") > size).select("mask", "key"), "large")
        if large.isEmpty():
            leaves.append(dealt)
            break
        masks = [r["mask"] % (1 << 64) for r in large.select("mask").distinct().collect()]
        large = broadcast_if_small(large)
        leaves.append(dealt.join(large, ["mask", "key"], "left_anti"))
        rows = stage(dealt.join(large, ["mask", "key"], "left_semi").select("mask", "fp"), "dealt")
    found = leaves[0]
    for more in leaves[1:]:
        found = found.union(more)
    return found


def stars(sizes: np.ndarray, flat: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links ``(fingerprint, smallest index of its group)`` in consecutive buckets of ``flat``."""
    last = np.repeat(np.cumsum(sizes), sizes)
    label = np.arange(len(flat))
    at, apart, ends = np.arange(len(flat)), 1, []
    while len(at := at[at + apart < last[at]]):
        close = at[np.bitwise_count(flat[at] ^ flat[at + apart]) <= max_bits]
        if len(close):
            ends.append((close, close + apart))
        apart += 1
    if not ends:
        return flat[:0], flat[:0]
    a, b = (np.concatenate(x) for x in zip(*ends))
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    linked = np.flatnonzero(label != np.arange(len(flat)))
    return flat[linked], flat[label[linked]]


def links(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """Links ``a, b`` that connect the fingerprints of ``prints(fp)`` as all pairs within ``max_bits`` would."""
    ship_package(prints.sparkSession)
    grouped = buckets(prints, max_bits).groupBy("mask", "key").agg(F.collect_list("fp").alias("fps"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            ends = lists.offsets.to_numpy()
            flat = lists.values.to_numpy()[ends[0] : ends[-1]].view(np.uint64)
            a, b = stars(np.diff(ends), flat, max_bits)
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], names=["a", "b"])

    return grouped.where(F.size("fps") > 1).select("fps").mapInArrow(run, "a bigint, b bigint").distinct()


def groups(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """``fp, root`` for the rows' different fingerprints that are linked to another one."""
    different = stage(prints.select("fp").distinct(), "prints")
    return components(links(different, max_bits))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, text: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` per row of ``docs``.

    Fingerprints link at ``max_bits`` or fewer differing bits; ``component_id`` is the
    smallest ``doc_id`` of the rows reached, null if they all have none. Rows keep
    their own line when they repeat, with equal or null ``doc_id`` too. A text without words, or null, has
    fingerprint zero and links like any other. Other columns are ignored; an empty table has no rows.
    """
    prints = stage(fingerprints(docs, shingle, text), "fingerprints")
    per_print = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "prints")
    linked = components(links(per_print.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    rooted = stage(per_print.join(linked, "fp", "left"), "rooted")
    smallest = rooted.where("root is not null").groupBy("root").agg(F.min("first").alias("component"))
    several = rooted.where("root is not null").join(smallest, "root").select("fp", "component").union(
        rooted.where("root is null and n > 1").select("fp", F.col("first").alias("component"))
    )
    # A fingerprint outside this table belongs to one row, which is its own component.
    found = prints.join(broadcast_if_small(stage(several, "several")), "fp", "left")
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.coalesce("component", "doc_id").alias("component_id"),
    )


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 3, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with one row left of each group of near-duplicates: the one with the smallest ``doc_id``.

    Null ids come last; of rows with that ``doc_id``, the smallest hash over all columns decides, and of
    rows that are alike one stays. All columns are kept as they are.
    """
    columns = docs.columns
    row = "__row"
    while row in columns:
        row += "_"
    keyed = docs.withColumn(row, F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in columns]))
    prints = stage(fingerprints(keyed, shingle, text, ("doc_id", row)), "fingerprints").withColumnRenamed(row, "row")
    roots = broadcast_if_small(stage(groups(prints, max_bits), "roots"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    of_group = prints.join(roots, prints.fp == roots.node, "left").select("doc_id", "row", F.coalesce("root", "fp").alias("of"))
    several = of_group.groupBy("of").agg(F.min(order).alias("kept"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # Only rows that go, and rows alike of which one stays, are looked up; all others pass by.
    members = of_group.join(stage(several.select("of", "kept"), "several"), "of")
    stays = F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.col("row") == F.col("kept.row"))
    named = members.groupBy(F.col("doc_id").alias("__id"), F.col("row").alias("__key")).agg(
        F.max(stays).alias("__stays"), F.count(F.lit(1)).alias("__n"))
    named = stage(named.where("not __stays or __n > 1"), "going")
    some, rest = split_by_keys(keyed, row, row, named.select(F.col("__key").alias("a"), F.col("__key").alias("b")))
    met = some.join(named, some["doc_id"].eqNullSafe(named["__id"]) & (some[row] == named["__key"]), "left")
    kept = met.where("__stays is null").select(*[F.col(f"`{c}`") for c in columns])
    one = met.where("__stays").dropDuplicates(["__id", "__key"]).select(*[F.col(f"`{c}`") for c in columns])
    return rest.select(*[F.col(f"`{c}`") for c in columns]).unionByName(kept).unionByName(one)
