"""Exact top-k inner products with vector-approximation files.

The approximation of a vector is one byte a dimension: the number of its cell
between the smallest and the largest value of that dimension.  Queries meet the
cells, never the exact vectors, in blocks of bounded size.  A block's cells give
every candidate a lower and an upper bound of its score; a candidate goes on if
its upper bound reaches the k-th largest lower bound of the query in the block.

Exact vectors are then joined to what went on, in the order of the upper bounds:
first each query's best ``FIRST * k``, whose k-th exact score is the mark; then
only those whose upper bound reaches the mark (equal ones too, so ties are right).
No other candidate can be among the k best.

Edge cases: null vectors, vectors with a null or non-finite component and null
ids take no part; every row counts, repeated rows too, as a query and as a
candidate, and no row is a candidate of its own id; the rows of one query id are
ranked together; vectors of different length are filled up with zeros; ties go to
the smaller id; an empty table, or one vector alone, gives no rows.  Components
beyond 64 bits stand at the nearest 64-bit number; scores are added up and ranked
to 38 digits and, if they pass 64 bits, shown as the nearest 64-bit number.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohort_effects.llm.tables import lean, materialise, read

K = 10
BLOCK_BYTES, QUERIES, STEP, SLICE = 1 << 24, 2_048, 128, 8_192
FIRST = 2  # exact vectors read before the mark is known, in k
SMALLEST, LARGEST, MOST = -(2**63), 2**63 - 1, 10**38 - 1
_WIDE = pa.decimal128(38, 0)
_BOUNDS = "q_row long, query_id long, row long, vec_id long, high double"


def scaled(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """``vec_id`` and ``v``: whole components floor(scale * x)."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & sound).select(
        F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v")
    )


def _matrix(lists: pa.Array, dims: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), dims)


def _edges(rows: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest value of each dimension; a row a dimension and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full(dims, LARGEST), np.full(dims, SMALLEST)
        for batch in batches:
            if len(batch):
                m = _matrix(batch.column(0), dims)
                low, high = np.minimum(low, m.min(axis=0)), np.maximum(high, m.max(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims)), pa.array(low), pa.array(high)], names=["d", "a", "b"])

    got = rows.select("v").mapInArrow(lean(run), "d long, a long, b long").groupBy("d").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    got = got.toArrow().sort_by("d")
    return got["a"].to_numpy().astype(float), got["b"].to_numpy().astype(float)


def _cells(rows: DataFrame, low: np.ndarray, width: np.ndarray, dims: int) -> DataFrame:
    """``row``, ``vec_id`` and the cells' numbers as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = np.clip((_matrix(batch.column("v"), dims) - low) // width, 0, 255).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("vec_id"), pa.array([x.tobytes() for x in number], pa.binary())], names=["row", "vec_id", "cells"]
            )

    return rows.select("row", "vec_id", "v").mapInArrow(lean(run), "row long, vec_id long, cells binary")


def _scan(low: np.ndarray, width: np.ndarray, k: int, dims: int):
    """What can be among the best ``k`` of a block of cells, for a block of queries."""

    def run(queries: pa.Table, cells: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if len(queries) and len(cells):
            q_rows, q_ids = queries["q_row"].to_numpy(), queries["query_id"].to_numpy()
            q_all = np.concatenate([_matrix(c, dims) for c in queries["v"].chunks]).astype(float)
            rows, ids = cells["row"].to_numpy(), cells["vec_id"].to_numpy()
            number = np.frombuffer(b"".join(cells["cells"].to_pylist()), np.uint8).reshape(len(rows), dims)
            for at in range(0, len(q_ids), STEP):
                q, own = q_all[at : at + STEP], q_ids[at : at + STEP, None]
                above, below = np.maximum(q, 0) @ width, np.minimum(q, 0) @ width
                best = np.full((len(q), k), -np.inf)  # largest lower bounds so far
                held = []
                for a in range(0, len(rows), SLICE):
                    corner = low + width * number[a : a + SLICE]
                    base = q @ corner.T
                    loss = 1 + 1e-9 * (np.abs(q) @ np.abs(corner).max(axis=0) + above - below)[:, None]  # rounding
                    high, least = base + above[:, None] + loss, base + below[:, None] - loss
                    same = own == ids[None, a : a + SLICE]
                    high[same] = least[same] = -np.inf
                    best = -np.partition(-np.concatenate([best, least], axis=1), k - 1, axis=1)[:, :k]
                    i, j = np.nonzero((high >= best.min(axis=1)[:, None]) & (high > -np.inf))
                    held.append((i, a + j, high[i, j]))
                i, j, high = (np.concatenate(x) for x in zip(*held, strict=True))
                keep = high >= best.min(axis=1)[i]
                i, j, high = i[keep], j[keep], high[keep]
                found.append((q_rows[at + i], q_ids[at + i], rows[j], ids[j], high))
        columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [[], [], [], [], []]
        types = [pa.int64()] * 4 + [pa.float64()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["q_row", "query_id", "row", "vec_id", "high"])

    return lambda queries, cells: run(queries, cells)


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact inner products of the lists ``v`` and ``w``."""
    for batch in batches:
        dims = len(batch.column("v")[0]) if len(batch) else 1
        a, b = _matrix(batch.column("v"), dims), _matrix(batch.column("w"), dims)
        if len(batch) and float(np.abs(a.astype(float)).max()) * float(np.abs(b.astype(float)).max()) * dims < 2.0**62:
            score = pa.array(np.einsum("ij,ij->i", a, b)).cast(_WIDE)
        else:
            whole = [sum(x * y for x, y in zip(r, t, strict=True)) for r, t in zip(a.tolist(), b.tolist(), strict=True)]
            score = pa.array([Decimal(min(max(x, -MOST), MOST)) for x in whole], _WIDE)
        columns = [batch.column(c) for c in ("q_row", "query_id", "vec_id")]
        yield pa.RecordBatch.from_arrays([*columns, score], names=["q_row", "query_id", "vec_id", "score"])


def exact_scores(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """Joins the exact vectors to ``pairs`` and scores them."""
    queries = rows.select(F.col("row").alias("q_row"), F.col("v").alias("w"))
    with_both = pairs.join(rows.select("row", "v"), "row").join(queries, "q_row").select("q_row", "query_id", "vec_id", "v", "w")
    return with_both.mapInArrow(lean(_products), "q_row long, query_id long, vec_id long, score decimal(38,0)")


def approximated(rows: DataFrame, is_query: Column, k: int, count: int, dims: int, queries: int) -> DataFrame:
    """The (query, candidate) pairs that the cells leave open, with the upper bound
    ``high`` and the pair's ``place`` among its query's."""
    low, high = _edges(rows, dims)
    width = np.floor((high - low) / 256) + 1
    n_cand, n_query = -(-count // max(1, BLOCK_BYTES // dims)), -(-queries // QUERIES)
    block = lambda n, seed: F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.where(is_query).select(F.col("row").alias("q_row"), F.col("vec_id").alias("query_id"), "v", block(n_query, 1).alias("qb"), every(n_cand).alias("cb"))
    right = _cells(rows, low, width, dims).select("row", "vec_id", "cells", block(n_cand, 2).alias("cb"), every(n_query).alias("qb"))
    found = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInArrow(_scan(low, width, k, dims), _BOUNDS)
    place = F.row_number().over(Window.partitionBy("q_row").orderBy(F.desc("high"), "row"))
    return found.withColumn("place", place)


def top_k(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` for ``vec_id``, ``v``."""
    spark = vectors.sparkSession
    rows = materialise(vectors.withColumn("row", F.monotonically_increasing_id()))
    count, dims, queries = rows.agg(F.count("*"), F.max(F.size("v")), F.sum(is_query.cast("long"))).first()
    if not count or not queries or dims <= 0:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rows = rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("v"))))
    open_ = materialise(approximated(rows, is_query, k, count, dims, queries))
    first = materialise(exact_scores(open_.where(F.col("place") <= FIRST * k), rows))
    nth = F.row_number().over(Window.partitionBy("q_row").orderBy(F.desc("score")))
    mark = first.withColumn("nth", nth).where(F.col("nth") == k).select("q_row", F.col("score").cast("double").alias("mark"))
    # a double may round the mark up by a unit in 2 ** 53; the bounds are at least one wider
    rest = open_.where(F.col("place") > FIRST * k).join(mark, "q_row", "left").where("mark is null or high >= mark - abs(mark) * 1e-12")
    scores = first.unionByName(exact_scores(rest.drop("mark"), rows))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    fits = F.least(F.greatest("score", F.lit(Decimal(SMALLEST))), F.lit(Decimal(LARGEST))).cast("long")
    return scores.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", fits.alias("score"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(scaled(read(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0)


OP7_SQL = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 10
"""
