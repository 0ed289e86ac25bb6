"""Vector codes against comparing everything with everything."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from basketry.llm import vector_codes
from basketry.llm.vector_codes import Codebooks, Slices

VECTORS = "vec_id long, embedding array<double>, label int, code string, v int, key string"


def nearest(entries, point):
    far = [sum((a - b) ** 2 for a, b in zip(entry, point, strict=True)) for entry in entries]
    return far.index(min(far)), min(far)


def brute(rows, parts, entries=64, rounds=2):
    """Codes, errors and codebooks of rows (vec_id, vector, label) that take part."""
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows]
    by_id = {}
    for i, v, _ in kept:
        if i is not None:
            by_id[i] = min(v, by_id.get(i, v))
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(by_id[i], p) for i in sorted(by_id)[:entries]] for p in range(parts)]
    for turn in range(rounds + 1):
        found = [[nearest(books[p], cut(v, p)) for p in range(parts)] for _, v, _ in kept]
        if turn == rounds:
            break
        for p in range(parts):
            for e in range(len(books[p])):
                own = [cut(kept[k][1], p) for k in range(len(kept)) if found[k][p][0] == e]
                if own:
                    books[p][e] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    errors = [sum(far for _, far in row) for row in found]
    of_label = {}
    for (_, _, label), error in zip(kept, errors, strict=True):
        of_label[label] = of_label.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    return sorted(
        ((i, "".join(f"{e:02x}" for e, _ in row), error, of_label[label], digest)
         for (i, _, label), row, error in zip(kept, found, errors, strict=True)),
        key=str,
    )


@pytest.mark.parametrize("spread", [2, 40, 100_000])
@pytest.mark.parametrize("count", [1, 5, 64])
def test_slices_find_the_nearest(spread, count):
    made = np.random.default_rng(count + spread)
    entries = made.integers(-spread, spread, (count, 4))
    points = np.concatenate((made.integers(-2 * spread, 2 * spread, (300, 4)), entries))
    slices = Slices(entries)
    index, far = slices.nearest(points)
    assert list(zip(index.tolist(), far.tolist(), strict=True)) == [nearest(entries.tolist(), p) for p in points.tolist()]
    radius = made.integers(0, spread, len(points))
    masks = slices.within(points, radius)
    inside = (np.abs(points[:, None] - entries[None]) <= radius[:, None, None]).all(axis=2)
    assert masks.tolist() == [sum(1 << int(e) for e in np.flatnonzero(row)) for row in inside]


def test_masks_leave_few_candidates():
    made = np.random.default_rng(3)
    slices = Slices(made.integers(-100, 100, (64, 4)))
    points = made.integers(-100, 100, (500, 4))
    masks = slices.within(points, slices.radius(points))
    assert 1 <= np.mean([int(mask).bit_count() for mask in masks]) < 32


def test_codebooks_decode_what_they_hold():
    vectors = np.arange(64 * 8).reshape(64, 8)
    books = Codebooks.start(vectors, 4)
    codes, far = books.encode(vectors)
    assert (books.decode(codes) == vectors).all() and not far.any()
    with pytest.raises(ValueError, match="64"):
        Slices(np.zeros((65, 2), np.int64))


def run(spark, rows):
    df = spark.createDataFrame([(*row, "x", 1, "y") for row in rows], VECTORS)
    codes, books = vector_codes.compress(df)
    errors = codes.groupBy("label").sum("error").collect()
    of_label = {row.label: row[1] for row in errors}
    return sorted(((r.vec_id, r.code, r.error, of_label[r.label], books.sha256()) for r in codes.collect()), key=str)


def made_rows(count, size, seed=1):
    made = np.random.default_rng(seed)
    # few different values give ties and like rows
    vectors = np.concatenate((made.integers(-3, 3, (count // 2, size)) / 256, made.normal(size=(count - count // 2, size))))
    return [(int(k), [float(x) for x in v], int(k) % 3 or None) for k, v in enumerate(vectors)]


@pytest.mark.parametrize(("count", "size"), [(150, 32), (20, 16), (1, 64)])
def test_codes_equal_brute_force(spark, count, size):
    rows = made_rows(count, size)
    rows += [(3, [0.5] * size, None), (3, [0.25] * size, 1), (3, [0.25] * size, 1), (None, [0.1] * size, 2)]
    assert run(spark, rows) == brute(rows, 16)


def test_rows_that_take_no_part(spark):
    rows = made_rows(80, 32)
    odd = [None, [], [float("nan")] * 32, [float("inf")] * 32, [None] + [0.0] * 31, [1.0] * 48, [1.0] * 31]
    assert run(spark, rows + [(100 + k, v, 1) for k, v in enumerate(odd)]) == brute(rows, 16)


def test_codes_of_nothing(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None, None)]) == []
    assert [(r[0], r[1]) for r in run(spark, [(None, [0.0] * 16, None)])] == [(None, "00" * 16)]


def test_components_beyond_exact_distances_are_an_error(spark):
    with pytest.raises(Exception, match="no exact distance"):
        run(spark, [(1, [1e300] * 16, 1)])
