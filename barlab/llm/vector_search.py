"""Exact search for the largest inner products.

Vectors are ordered by length, longest first, and cut into blocks. Queries, in blocks too, meet the blocks in that order, in
rounds that take twice as many blocks each time. After a round every query knows a score that its results have at
least, and Cauchy-Schwarz (no product exceeds the product of the lengths) keeps it from whole blocks, and from the rest of a
block. Inside a block the vectors are rotated to the singular directions of all vectors: the first coordinates then
hold most of a product, and the lengths of what is left bound the rest. Only what these bounds let through is
multiplied out, in whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlab.llm.common import ship_package
from barlab.operators.panel import number_rows
from barlab.session import stage

#: Numbers in a block of vectors, and the most vectors and queries in one.
CELLS = 1 << 18
MOST_VECTORS = 4_096
MOST_QUERIES = 1_024
#: Vectors that a block of queries meets between two looks at its bounds.
STEP = 512
#: Bounds are computed in floating point; nothing within this share of one is dropped.
SLACK = 1e-9
EXACT = 2.0**53
LEAST, MOST = -(2**63), 2**63 - 1


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there and holds only finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True)))


def whole_numbers(rows: DataFrame, scale: float) -> DataFrame:
    """``rows(id, asked, vector)`` with the vectors ``floor(scale * x)`` as whole doubles, and their lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            ends = lists.offsets.to_numpy()
            flat = np.floor(scale * lists.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]])
            ends = ends - ends[0]
            lengths = np.array([np.linalg.norm(flat[a:b]) for a, b in zip(ends, ends[1:])])
            columns = [batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(lengths)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "asked", "vector", "length"])

    kind = dict(rows.dtypes)["id"]
    return rows.select("id", "asked", F.col("vector").cast("array<double>")).mapInArrow(
        run, f"id {kind}, asked boolean, vector array<double>, length double"
    )


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """``block, longest, rows`` from ``rows(at, id, row, length, vector)``: ``size`` consecutive ranks each, in order."""
    one = F.struct("at", "id", "row", "length", "vector")
    return rows.groupBy(F.expr(f"at div {size}L").alias("block")).agg(
        F.max("length").alias("longest"), F.sort_array(F.collect_list(one)).alias("rows")
    )


def unpack(rows: pa.ListScalar, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, row numbers, lengths and vectors (filled up with zeros) of a block."""
    held = rows.values
    lists = held.field("vector")
    ends = lists.offsets.to_numpy()
    flat = lists.values.to_numpy()
    matrix = np.zeros((len(held), width))
    sizes = np.diff(ends)
    if (sizes == width).all():
        matrix[:] = flat[ends[0] : ends[-1]].reshape(len(held), width)
    else:
        matrix[np.arange(width) < sizes[:, None]] = flat[ends[0] : ends[-1]]
    return held.field("id"), held.field("row").to_numpy(), held.field("length").to_numpy(), matrix


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """The right singular vectors of all vectors, strongest first; the driver gets ``width`` x ``width`` sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for i in range(batch.num_rows):
                matrix = unpack(batch.column(0)[i], width)[3]
                with np.errstate(over="ignore", invalid="ignore"):
                    total += matrix.T @ matrix
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width)), pa.array(total.ravel())], names=["cell", "part"])

    sums = vectors.select("rows").mapInArrow(run, "cell bigint, part double").groupBy("cell").agg(F.sum("part").alias("part")).toArrow()
    gram = np.zeros(width * width)
    gram[sums.column("cell").to_numpy()] = sums.column("part").to_numpy()
    if not np.isfinite(gram).all():
        return np.eye(width)
    return np.linalg.eigh(gram.reshape(width, width))[1][:, ::-1].copy()


def products(q: np.ndarray, x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows ``q[a]`` and ``x[b]`` of whole numbers, exact; beyond 64 bits the largest number of 64 bits."""
    if not np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[1] < EXACT:
        exact = (sum(int(s) * int(t) for s, t in zip(q[i], x[j])) for i, j in zip(a, b))
        return np.fromiter((min(max(s, LEAST), MOST) for s in exact), np.int64, len(a))
    if len(a) * 8 > len(q) * len(x):
        return (q @ x.T)[a, b].astype(np.int64)
    return np.einsum("ij,ij->i", q[a], x[b]).astype(np.int64)


def best(k: int, query: np.ndarray, score: np.ndarray, unnamed: np.ndarray, name: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Places of each query's ``k`` best: by score, then id (null last), then row."""
    # ~x reverses the order of whole numbers without leaving 64 bits, which -x may.
    order = np.lexsort((row, name, unnamed, ~score, query))
    first = np.flatnonzero(np.diff(query[order], prepend=-1))
    place = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    return order[place < k]


def search_block(
    queries: tuple, vectors: tuple, turn: np.ndarray, bounds: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query place, vector place and score of what may be among the ``k`` best of a block of queries.

    ``bounds`` holds for each query a score that is known to be reached ``k`` times (or minus infinity).
    """
    _, q_row, q_length, q = queries
    names, x_row, x_length, x = vectors
    width = q.shape[1]
    unnamed = names.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
    name = names.fill_null(0).to_numpy()
    bounds = bounds.copy()
    steps = sorted({max(1, width * s // 8) for s in (1, 2, 4)})
    with np.errstate(over="ignore", invalid="ignore"):
        q_turned, x_turned = q @ turn, x @ turn
        q_rest, x_rest = ({p: np.linalg.norm(m[:, p:], axis=1) for p in steps} for m in (q_turned, x_turned))
    found = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))
    for start in range(0, len(x), STEP):
        part = slice(start, start + STEP)
        with np.errstate(over="ignore", invalid="ignore"):
            # Lengths fall: a query that this step's longest vector cannot help needs none of the rest.
            active = np.flatnonzero(~(q_length * x_length[start] * (1 + SLACK) < bounds))
            if not len(active):
                break
            alive = np.ones((len(active), len(x[part])), bool)
            done, sums = 0, 0.0
            for p in steps:
                sums = sums + q_turned[active, done:p] @ x_turned[part, done:p].T
                most = np.outer(q_rest[p][active], x_rest[p][part])
                slack = SLACK * np.outer(q_length[active], x_length[part])
                alive &= ~(sums + most + slack < bounds[active, None])
                done = p
                if alive.sum() * 16 < alive.size:
                    break
        alive &= q_row[active, None] != x_row[None, part]
        a, b = np.nonzero(alive)
        if not len(a):
            continue
        score = products(q[active], x[part], a, b)
        merged = [np.concatenate(z) for z in zip(found, (active[a], start + b, score))]
        kept = best(k, merged[0], merged[2], unnamed[merged[1]], name[merged[1]], x_row[merged[1]])
        found = tuple(z[kept] for z in merged)
        counts = np.bincount(found[0], minlength=len(q))
        full = counts >= k
        least = np.full(len(q), np.inf)
        np.minimum.at(least, found[0], found[2].astype(np.float64))
        bounds = np.where(full, np.maximum(bounds, least), bounds)
    return found


def top_products(
    vectors: DataFrame,
    asked: Column,
    k: int = 5,
    scale: float = 256.0,
    name: str = "vec_id",
    vector: str = "embedding",
    cells: int = CELLS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that ``asked`` marks, its ``k`` best among all other rows.

    The score is the inner product of ``floor(scale * x)``, exact. Ties go to the smaller id, a null id comes last, and rows
    with one id stay separate (in an order of their own), as queries and as results. A row whose vector is null or holds a null or a
    non-finite number takes no part; shorter vectors are filled up with zeros, so an empty one scores 0 everywhere. A
    null in ``asked`` is no query. A query with fewer than ``k`` other rows gets them all; an empty table gives no rows. Scores
    beyond 64 bits count as the largest (least) number of 64 bits. Other columns are not looked at, whatever their names.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    given = vectors.select(F.col(f"`{name}`").alias("id"), F.coalesce(asked, F.lit(False)).alias("asked"), F.col(f"`{vector}`").alias("vector"))
    whole = whole_numbers(usable(given, "vector"), scale).withColumn("shortness", -F.col("length"))
    ranked = number_rows(whole, [], ["shortness", "id"], out="row", total="all", name="vectors").drop("shortness", "all")
    ranked = stage(ranked, "ranked")
    width = max(1, ranked.agg(F.max(F.size("vector"))).first()[0] or 0)
    rows = max(16, cells // width)
    x_blocks = stage(blocks(ranked.withColumn("at", F.col("row")), min(MOST_VECTORS, rows)), "blocks")
    wanted = number_rows(
        ranked.where("asked").withColumn("place", F.col("row")), [], ["place"], out="at", total="all", name="queries"
    )
    per_query_block = min(MOST_QUERIES, rows)
    q_blocks = stage(blocks(wanted, per_query_block).withColumnRenamed("block", "q_block"), "query_blocks")
    turn = rotation(x_blocks, width)
    count = x_blocks.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                queries, found_in = unpack(batch.column(1)[i], width), unpack(batch.column(2)[i], width)
                bounds = np.full(len(queries[1]), -np.inf)
                known = batch.column(3)[i]
                if known.is_valid and len(known.values):
                    bounds[known.values.field("q").to_numpy()] = known.values.field("bound").to_numpy()
                q, x, score = search_block(queries, found_in, turn, bounds, k)
                columns = [
                    pa.array(np.full(len(q), batch.column(0)[i].as_py())), pa.array(q), queries[0].take(pa.array(q)),
                    found_in[0].take(pa.array(x)), pa.array(found_in[1][x]), pa.array(score),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["q_block", "q", "query_id", "id", "row", "score"])

    kind = dict(ranked.dtypes)["id"]
    schema = f"q_block bigint, q bigint, query_id {kind}, id {kind}, row bigint, score bigint"
    order = Window.partitionBy("q_block", "q").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    found = stage(spark.createDataFrame([], schema), "found")
    start, step = 0, 1
    while start < count:
        bounds = found.groupBy("q_block", "q").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k)
        known = bounds.groupBy("q_block").agg(F.collect_list(F.struct("q", F.col("least").cast("double").alias("bound"))).alias("known"))
        q_now = stage(q_blocks.join(known, "q_block", "left"), "round")
        # The length that a vector needs to help any query of the block; 0 while one of them has no bound yet.
        need = F.expr("aggregate(known, double('Infinity'), (m, b) -> least(m, if(b.bound > 0, b.bound / rows[int(b.q)].length, 0D)))")
        need = F.when(F.size("known") == F.size("rows"), need).otherwise(F.lit(0.0))
        last = min(start + step, count)
        met = q_now.select("q_block", need.alias("need"), F.explode(F.expr(f"sequence({start}L, {last - 1}L)")).alias("block"))
        pairs = met.join(x_blocks.select("block", "longest"), "block").where(F.col("longest") * (1 + SLACK) >= F.col("need"))
        paired = (
            pairs.select("q_block", "block")
            .join(q_now.select("q_block", F.col("rows").alias("queries"), "known"), "q_block")
            .join(x_blocks.select("block", "rows"), "block")
        )
        new = paired.select("q_block", "queries", "rows", "known").mapInArrow(run, schema)
        ranks = found.unionByName(new).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        found = stage(ranks.drop("rank"), "found")
        start, step = last, step * 2
    return found.select("query_id", F.row_number().over(order).alias("rank"), F.col("id").alias("vec_id"), "score")


#: The same by SQL, where no id is null or there twice.
ORACLE = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, x.vec_id, CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.v, x.v)]) AS BIGINT) AS score
  FROM v q JOIN v x ON x.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5"""
