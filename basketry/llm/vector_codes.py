"""Codes of vectors: each part of a vector by its nearest entry of a small codebook, found by slices and masks.

A part position has at most 64 entries, so a set of them is one 64-bit mask. Per dimension the coordinates of the
entries are sorted, and for each place in that order a mask holds the entries before it; the entries whose coordinate
lies in a range are then the difference of two such masks, found by two binary searches. For a vector, the entry that
is nearest in one dimension gives the initial radius: its distance. The ranges of that radius around the vector, one
per dimension, are intersected with AND. What is left is exact: an entry outside is more than the radius away in one
dimension alone. The entries left are compared in the order of their index, so that ties go to the lowest.

The codebooks start from the vectors of the smallest ids and are moved to the means of their parts in rounds. Tasks sum
the parts of each entry; only the sums of 64 entries a position reach the driver. Codebooks and sums grow with the
length of a vector, not with their number.

Defined results: vectors that are null, empty or hold null or non-finite components take no part, and neither do those
whose length is no multiple of the number of parts or differs from that of the smallest id (of the smallest vector of
that id). A null id takes part but starts no entry. Rows that repeat an id are coded each; the smallest of their
vectors stands for the id among the first entries. With fewer ids there are fewer entries. Components so large that a
squared distance would leave 64 bits are an error. An empty table gives no rows. Extra columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import input_columns, per_batch, ship, table, written
from basketry.operators.lookup import lookup_join

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256


def _root(squares: np.ndarray) -> np.ndarray:
    """Whole square roots, rounded down."""
    root = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    root -= root * root > squares
    return root + ((root + 1) * (root + 1) <= squares)


class Slices:
    """The entries of one part position, with the masks of their sorted coordinates."""

    def __init__(self, entries: np.ndarray):
        if len(entries) > 64:
            raise ValueError("a mask holds 64 entries")
        self.entries = entries
        order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.ascontiguousarray(np.take_along_axis(entries, order, axis=0).T)
        bits = np.uint64(1) << order.astype(np.uint64)
        none = np.zeros((1, entries.shape[1]), np.uint64)
        self.before = np.concatenate((none, np.bitwise_or.accumulate(bits, axis=0))).T
        self.order = order.T

    def _distance(self, points: np.ndarray, entries: np.ndarray) -> np.ndarray:
        apart = points - self.entries[entries]
        return (apart * apart).sum(axis=1)

    def radius(self, points: np.ndarray) -> np.ndarray:
        """Within this distance of each point there is an entry: of those at its place in a dimension, the nearest."""
        least = None
        for dim, line in enumerate(self.sorted):
            place = np.minimum(np.searchsorted(line, points[:, dim]), len(line) - 1)
            found = self._distance(points, self.order[dim][place])
            least = found if least is None else np.minimum(least, found)
        return _root(least)

    def within(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks of the entries that are in range of each point in every dimension."""
        masks = np.full(len(points), ~np.uint64(0))
        for dim, (line, before) in enumerate(zip(self.sorted, self.before, strict=True)):
            low = np.searchsorted(line, points[:, dim] - radius, side="left")
            high = np.searchsorted(line, points[:, dim] + radius, side="right")
            masks &= before[high] ^ before[low]
        return masks

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of each point."""
        masks = self.within(points, self.radius(points))
        best = np.full(len(points), np.iinfo(np.int64).max)
        index = np.zeros(len(points), np.int64)
        rows = np.arange(len(points))
        while len(rows):
            left = masks[rows]
            lowest = left & (~left + np.uint64(1))
            entry = np.frexp(lowest.astype(np.float64))[1] - 1
            found = self._distance(points[rows], entry)
            better = found < best[rows]
            best[rows[better]], index[rows[better]] = found[better], entry[better]
            masks[rows] = left ^ lowest
            rows = rows[masks[rows] != 0]
        return index, best


class Codebooks:
    """Entries of all part positions: an array of position, entry, place in the part."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.slices = [Slices(of_part) for of_part in entries]

    @classmethod
    def start(cls, vectors: np.ndarray, parts: int) -> Codebooks:
        return cls(vectors.reshape(len(vectors), parts, -1).transpose(1, 0, 2).copy())

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indexes and squared distances, by vector and part."""
        parts = vectors.reshape(len(vectors), len(self.entries), -1)
        found = [of_part.nearest(parts[:, at]) for at, of_part in enumerate(self.slices)]
        return np.stack([index for index, _ in found], axis=1), np.stack([far for _, far in found], axis=1)

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The vectors that codes stand for."""
        return self.entries[np.arange(len(self.entries)), codes].reshape(len(codes), -1)

    def moved(self, sums: dict[tuple[int, int, int], tuple[int, int]]) -> Codebooks:
        """With the mean, rounded down, at each place that has a sum and a count."""
        entries = self.entries.copy()
        for place, (total, count) in sums.items():
            entries[place] = total // count
        return Codebooks(entries)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def whole(column: pa.Array, size: int, scale: int) -> np.ndarray:
    """Vectors as whole numbers."""
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    floors = np.floor(values * scale)
    limit = (2**62 / size) ** 0.5 / 2
    if len(floors) and np.abs(floors).max() > limit:
        raise ValueError(f"a component beyond {limit / scale:g} has no exact distance")
    return floors.astype(np.int64)


def kept_vectors(vectors: DataFrame, parts: int, vec_id: str, vector: str, label: str) -> tuple[DataFrame, int]:
    """vec_id, label and vector ``v`` of the rows that take part, and the length of their vectors."""
    rows = input_columns(vectors, vec_id=vec_id, label=label, v=vector).select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("v").cast("array<double>").alias("v")
    )
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = rows.filter((F.size("v") > 0) & (F.size("v") % parts == 0) & F.forall("v", finite))
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").select(F.size("v").alias("size")).first()
    size = first["size"] if first else parts
    return rows.filter(F.size("v") == size), size


def first_entries(rows: DataFrame, size: int, parts: int, entries: int, scale: int) -> Codebooks:
    """Codebooks of the vectors with the smallest ids."""
    ids = rows.select(F.col("vec_id").alias("first_id")).filter("first_id IS NOT NULL").distinct()
    ids = ids.orderBy("first_id").limit(entries)
    chosen = rows.join(F.broadcast(ids), F.col("vec_id") == F.col("first_id")).groupBy("vec_id").agg(F.min("v").alias("v"))
    vectors = [row.v for row in chosen.orderBy("vec_id").collect()]  # as many as there are entries
    if not vectors:  # only null ids: one entry at the origin
        vectors = [[0.0] * size]
    return Codebooks.start(whole(pa.array(vectors, pa.list_(pa.float64())), size, scale), parts)


def part_sums(rows: DataFrame, books: Codebooks, size: int, scale: int) -> dict[tuple[int, int, int], tuple[int, int]]:
    """Sum and count of the parts assigned to each entry, by part, entry and place; entries without parts are left out."""
    shape = books.entries.shape
    ship(rows.sparkSession)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(shape[:2], np.int64), np.zeros(shape, np.int64)
        for batch in batches:
            vectors = whole(batch.column("v"), size, scale)
            codes, _ = books.encode(vectors)
            for at in range(shape[0]):
                counts[at] += np.bincount(codes[:, at], minlength=shape[1])
                np.add.at(sums[at], codes[:, at], vectors.reshape(-1, shape[0], shape[2])[:, at])
        part, entry, place = (axis.ravel() for axis in np.indices(shape))
        used = counts[part, entry] > 0
        columns = part, entry, place, sums.ravel(), counts[part, entry]
        yield pa.RecordBatch.from_arrays([pa.array(x[used], pa.int64()) for x in columns], ["p", "e", "j", "total", "n"])

    partial = rows.select("v").mapInArrow(summed, "p long, e long, j long, total long, n long")
    totals = partial.groupBy("p", "e", "j").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    return {(row.p, row.e, row.j): (int(row.total), row.n) for row in totals.collect()}  # a row a codebook component


def trained(rows: DataFrame, size: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks:
    """Codebooks after the given rounds over all rows."""
    books = first_entries(rows, size, parts, entries, scale)
    for _ in range(rounds):
        books = books.moved(part_sums(rows, books, size, scale))
    return books


def coded(rows: DataFrame, books: Codebooks, size: int, scale: int = SCALE) -> DataFrame:
    """vec_id, label, code and error of each row: two hex digits a part, squared distances summed over the parts."""
    digits = np.array([f"{entry:02x}" for entry in range(books.entries.shape[1])], "S2")

    def code(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes, far = books.encode(whole(batch.column("v"), size, scale))
        written_out = np.ascontiguousarray(digits[codes]).view(f"S{2 * codes.shape[1]}").ravel().astype(str)
        columns = [batch.column("vec_id"), batch.column("label"), pa.array(written_out, pa.string()), pa.array(far.sum(axis=1))]
        return pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

    label_type = rows.schema["label"].dataType.simpleString()
    return per_batch(rows.select("vec_id", "label", "v"), code, f"vec_id long, label {label_type}, code string, error long")


def compress(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> tuple[DataFrame, Codebooks]:
    """The coded rows (vec_id, label, code, error), written, and the codebooks to decode them with."""
    rows, size = kept_vectors(vectors, parts, vec_id, vector, label)
    books = trained(rows, size, parts, entries, rounds, scale)
    return written(coded(rows, books, size, scale), "codes"), books


def op11(spark, sf_dir: str) -> DataFrame:
    codes, books = compress(table(spark, sf_dir, "embeddings"))
    # null labels are a label of their own
    codes = codes.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")))
    sums = codes.groupBy(F.col("key").alias("label_key")).agg(F.sum("error").alias("label_error"))
    summed = lookup_join(codes, sums, "key", "label_key", spread_by="vec_id")
    return summed.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def _sql(rounds: int) -> str:
    far = "list_inner_product(x, x) - 2 * list_inner_product(x, y) + list_inner_product(y, y)"
    parts = [
        f"""
kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda c: floor({SCALE} * c::DOUBLE)) AS v,
        len(embedding) // {PARTS} AS width
    FROM embeddings
    WHERE len(embedding) > 0 AND len(embedding) % {PARTS} = 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
parts AS MATERIALIZED (SELECT r, p, list_slice(v, p * width + 1, (p + 1) * width) AS x FROM kept, range({PARTS}) AS t(p)),
starts AS (
    SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS e
    FROM (SELECT arg_min(r, v) AS r, vec_id FROM kept WHERE vec_id IS NOT NULL GROUP BY vec_id ORDER BY vec_id LIMIT {ENTRIES})),
book0 AS MATERIALIZED (SELECT p, e, x AS y FROM parts JOIN starts USING (r))"""
    ]
    for number in range(rounds + 1):
        parts.append(
            f"""
near{number} AS MATERIALIZED (
    SELECT r, p, any_value(x) AS x, min(far) AS far, arg_min(e, far * {ENTRIES} + e) AS e
    FROM (SELECT r, p, x, e, {far} AS far FROM parts JOIN book{number} USING (p)) GROUP BY r, p)"""
        )
        if number < rounds:
            parts.append(
                f"""
book{number + 1} AS MATERIALIZED (
    SELECT p, e, coalesce(mean, y) AS y FROM book{number} LEFT JOIN (
        SELECT p, e, list(floor(total / n) ORDER BY j) AS mean
        FROM (SELECT p, e, j, sum(x[j]) AS total, count(*) AS n FROM near{number}, range(1, 1 + len(x)) AS t(j) GROUP BY p, e, j)
        GROUP BY p, e) USING (p, e))"""
            )
    return f"""
WITH {",".join(parts)},
codes AS (
    SELECT r, string_agg(printf('%02x', e::INTEGER), '' ORDER BY p) AS code, sum(far)::BIGINT AS error FROM near{rounds} GROUP BY r),
digest AS (
    SELECT sha256(string_agg(y[j]::BIGINT::VARCHAR, ',' ORDER BY p, e, j)) AS codebooks_sha256
    FROM book{rounds}, range(1, 1 + len(y)) AS t(j))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN codes USING (r), digest
"""


OP11_SQL = _sql(ROUNDS)
