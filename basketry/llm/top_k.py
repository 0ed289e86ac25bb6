"""Exact top-k by inner product: Fagin's threshold algorithm over sorted per-dimension lists.

Vectors are dealt into blocks and queries into blocks; each pair of blocks is a task's piece of work. A block of
vectors has, per dimension, its rows sorted by value. A query reads the lists from the end that its sign makes best,
scores what it meets, and stops when the bound (the score of a row that would have the last value read in every list)
is below its k-th score; a tie reads on, as a smaller id may still come. It reads in steps of growing depth, until it
stops or has met every row of the block.

Defined results: vectors that are null, empty, or hold null or non-finite components take no part, nor does a null id;
equal rows count once; vectors of different lengths are never compared; a row of the query's own id is no candidate;
ties go to the smaller id. Extra columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import input_columns, ship, table

VECTOR_BLOCK = 8192
QUERY_BLOCK = 2048
FIRST_DEPTH = 16
GROWTH = 2


class SortedLists:
    """A block of vectors with the rows of each dimension in the order of their values."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.lists = np.argsort(self.vectors, axis=0, kind="stable")
        largest = float(np.abs(self.vectors).max(initial=0))
        self.limit = 2.0**53 / max(1, vectors.shape[1]) / max(1.0, largest)
        self.as_float = self.vectors.astype(np.float64)

    def _scores(self, rows: np.ndarray | slice, queries: np.ndarray) -> np.ndarray:
        """Exact integer products; in floating point where that is exact."""
        if float(np.abs(queries).max(initial=0)) <= self.limit:
            return (queries.astype(np.float64) @ self.as_float[rows].T).astype(np.int64)
        return queries @ self.vectors[rows].T

    def _best(self, rows: np.ndarray, scores: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best rows, by score and id."""
        keep = self.ids[rows] != own
        rows, scores = rows[keep], scores[keep]
        if len(rows) > k:
            # all that reach the k-th score, so that ties are settled by id
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
            reach = scores >= least
            rows, scores = rows[reach], scores[reach]
        order = np.lexsort((self.ids[rows], -scores))[:k]
        return rows[order], scores[order]

    def top(self, queries: np.ndarray, own_ids: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids and scores of the k best of this block for each query; ``stopped`` counts those the bound ended."""
        count, size = self.vectors.shape
        out = []
        self.stopped = 0
        dims = np.arange(size)
        for number, query in enumerate(queries):
            rising = query > 0
            used = dims[query != 0]
            high, low = used[rising[used]], used[~rising[used]]
            new, met = np.zeros(count, bool), np.zeros(count, bool)
            rows, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
            read, depth = 0, FIRST_DEPTH
            while True:
                depth = min(depth, count)
                new[self.lists[count - depth : count - read, high]] = True
                new[self.lists[read:depth, low]] = True
                new &= ~met
                if depth == count:
                    # a query of zeros meets no row in its lists
                    new = ~met
                fresh = np.flatnonzero(new)
                met |= new
                new[:] = False
                rows = np.concatenate((rows, fresh))
                scores = np.concatenate((scores, self._scores(fresh, query[None])[0]))
                rows, scores = self._best(rows, scores, own_ids[number], k)
                if met.all():
                    break
                last = np.where(rising, self.lists[count - depth], self.lists[depth - 1])
                bound = int((query * self.vectors[last, dims]).sum())
                if len(rows) == k and scores[-1] > bound:
                    self.stopped += 1
                    break
                read, depth = depth, depth * GROWTH
            out.append((self.ids[rows], scores))
        return out


def matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def top_k(
    vectors: DataFrame,
    is_query: F.Column,
    k: int = 5,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
    vector_block: int = VECTOR_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """Of each query row the k rows of highest integer product: query_id, rank, vec_id, score.

    ``is_query``: a condition on the column ``vec_id``.
    """
    ship(vectors.sparkSession)
    rows = input_columns(vectors, vec_id=vec_id, v=vector).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("v").cast("array<double>").alias("v")
    )
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & (F.size("v") > 0) & F.forall("v", finite))
    rows = rows.select("vec_id", F.transform("v", lambda x: F.floor(x * scale).cast("long")).alias("v")).distinct()
    rows = rows.withColumns({"size": F.size("v"), "deal": F.xxhash64("vec_id", "v")})
    total, asking = rows.agg(F.count("*"), F.count_if(is_query)).first()
    n_blocks, n_query_blocks = max(1, -(-total // vector_block)), max(1, -(-asking // query_block))

    def dealt(df: DataFrame, own: str, own_count: int, other: str, other_count: int) -> DataFrame:
        """Each row in its own block, once for each block of the other side."""
        spread = df.withColumn(own, F.pmod("deal", F.lit(own_count)).cast("int"))
        return spread.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(other_count - 1))))

    left = dealt(rows, "vb", n_blocks, "qb", n_query_blocks)
    right = dealt(rows.filter(is_query), "qb", n_query_blocks, "vb", n_blocks)
    keys = ("size", "vb", "qb")
    schema = "query_id long, query_row long, vec_id long, score long"

    def search(block: pa.Table, asked: pa.Table) -> pa.Table:
        found = []
        if block.num_rows and asked.num_rows:
            size = block["size"][0].as_py()
            lists = SortedLists(block["vec_id"].to_numpy(), matrix(block["v"], size))
            own, row = asked["vec_id"].to_numpy(), asked["deal"].to_numpy()
            for number, (ids, scores) in enumerate(lists.top(matrix(asked["v"], size), own, k)):
                found.append((np.full(len(ids), own[number]), np.full(len(ids), row[number]), ids, scores))
        columns = [np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found, strict=True) if found else [()] * 4)]
        return pa.table([pa.array(x, pa.int64()) for x in columns], ["query_id", "query_row", "vec_id", "score"])

    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, schema)
    order = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op8(spark, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP8_SQL = """
WITH e AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.vec_id AS query_id, e.vec_id, list_inner_product(q.v::DOUBLE[], e.v::DOUBLE[])::BIGINT AS score
    FROM e AS q JOIN e ON q.vec_id <> e.vec_id AND len(q.v) = len(e.v)
    WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""
