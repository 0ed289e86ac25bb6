"""What filters of documents do to each other, in every order, per part of the corpus.

Spark finds the failures of each document as a mask, one bit a filter, and counts the rows of each mask per part: at
most 2^n counts a part. From these a decision diagram is built for each part: a level per filter, a branch for passing
and one for failing, each node weighted with the rows below it; equal subdiagrams are one node and empty ones none.
Two neighbouring levels are swapped in place, which touches no other level; such swaps, in the sequence of plain
changes, lead through all orders of the filters. In each order the path on which every filter is passed holds the
steps: a node's weight is what is left, its failing branch what the step removes.

A text is compared with all others by its SHA-256: the smallest doc_id of each digest is found with partial minima, and
the rows that carry it are joined by digest and doc_id, so that no group of copies comes together in one task.

Defined results: a null text is empty; a null or empty source is the part ``''``; rows of a null doc_id are neither
smaller nor larger than others and identical to none; rows that repeat a doc_id are counted each, and are no copies of
each other; a document has a label if any of its label rows says 1. An empty table has no parts and gives no rows.
Extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import input_columns, ship, table, written

WORD = r"[^\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WEIGHTS = ("n", "good", "toxic")
#: n filters have n! orders; more are refused
MOST_FILTERS = 8

Weight = tuple[int, ...]


class Diagram:
    """A decision diagram over failure masks, ordered by levels, each node with the weight of the rows below it."""

    EMPTY = 0

    def __init__(self, names: Sequence[str], counts: Mapping[int, Weight], width: int = len(WEIGHTS)):
        """``counts``: the weight of each mask; bit k of a mask stands for a failure of filter k."""
        self.order = list(range(len(names)))
        self.names = names
        self.weight: list[Weight] = [(0,) * width]
        self.branches: list[tuple[int, int]] = [(self.EMPTY, self.EMPTY)]
        leaves: dict[Weight, int] = {}
        below = {}
        for mask, weight in counts.items():
            if any(weight):
                if weight not in leaves:
                    leaves[weight] = self._add((self.EMPTY, self.EMPTY), weight)
                below[mask] = leaves[weight]
        self.levels: list[list[int]] = [[] for _ in names]
        for level in reversed(self.order):
            bit, known, above = 1 << level, {}, {}
            for mask in below:
                prefix = mask & ~bit
                above[prefix] = self._node(known, below.get(prefix, 0), below.get(prefix | bit, 0))
            self.levels[level] = list(known.values())
            below = above
        self.root = below.get(0, self.EMPTY)

    def _add(self, branches: tuple[int, int], weight: Weight) -> int:
        self.branches.append(branches)
        self.weight.append(weight)
        return len(self.weight) - 1

    def _node(self, known: dict[tuple[int, int], int], passing: int, failing: int) -> int:
        """The one node of a level with these branches."""
        if passing == failing == self.EMPTY:
            return self.EMPTY
        found = known.get((passing, failing))
        if found is None:
            total = tuple(map(sum, zip(self.weight[passing], self.weight[failing], strict=True)))
            found = known[passing, failing] = self._add((passing, failing), total)
        return found

    def swap(self, level: int) -> None:
        """Exchange the filters of a level and the next. Nodes of the upper level stay what they are to those above."""
        known: dict[tuple[int, int], int] = {}
        for node in self.levels[level]:
            passing, failing = (self.branches[child] for child in self.branches[node])
            self.branches[node] = tuple(self._node(known, *pair) for pair in zip(passing, failing, strict=True))
        self.levels[level + 1] = list(known.values())
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[int, Weight, Weight]]:
        """Filter, weight kept and weight removed along the path of passing."""
        node = self.root
        for name in self.order:
            node, failing = self.branches[node]
            yield name, self.weight[node], self.weight[failing]

    def __len__(self) -> int:
        return sum(map(len, self.levels))


def plain_changes(n: int) -> Iterator[int]:
    """Positions whose swap with the next leads through all orders of n things, each once."""
    if n < 2:
        return
    others, falling = plain_changes(n - 1), True
    while True:
        yield from range(n - 2, -1, -1) if falling else range(n - 1)
        change = next(others, None)
        if change is None:
            return
        yield change + falling
        falling = not falling


REPORT = {
    "filter_order": "string",
    "step": "int",
    "kept": "long",
    "removed": "long",
    "redundant": "long",
    "unique_fails": "long",
    "good_lost": "long",
    "toxic_lost": "long",
    "shapley": "long",
}


def report(names: Sequence[str], counts: Mapping[int, Weight]) -> Iterator[tuple]:
    """The rows of one part, in the columns of REPORT."""
    diagram = Diagram(names, counts)
    orders = [(tuple(diagram.order), list(diagram.steps()))]
    for position in plain_changes(len(names)):
        diagram.swap(position)
        orders.append((tuple(diagram.order), list(diagram.steps())))
    fails, alone, shares = {}, {}, dict.fromkeys(range(len(names)), 0)
    for _, steps in orders:
        # a filter meets all its failures as the first, and only its own as the last
        fails[steps[0][0]] = steps[0][2][0]
        alone[steps[-1][0]] = steps[-1][2][0]
        for name, _, removed in steps:
            shares[name] += removed[0]
    for order, steps in orders:
        label = "".join(names[k] for k in order)
        for step, (name, kept, removed) in enumerate(steps, 1):
            gone, good, toxic = removed
            yield label, step, kept[0], gone, fails[name] - gone, alone[name], good, toxic, shares[name]


def text_failures(text: Column) -> dict[str, Column]:
    """Conditions of failure that a text decides by itself."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    return {
        "A": F.size(words) < 200,
        "B": F.lit(100).cast("long") * F.size(F.array_distinct(words)) < F.lit(50).cast("long") * F.size(words),
        "C": F.lit(100).cast("long") * capitals > F.lit(2).cast("long") * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: rows of each failure mask, of the four conditions on texts and, as the last, copies."""
    rows = input_columns(docs, doc_id="doc_id", source="source", text="text").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("source", F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    conditions = text_failures(F.col("text")).values()
    mask = sum((F.when(fails, 1 << bit).otherwise(0) for bit, fails in enumerate(conditions)), F.lit(0))
    rows = rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("mask"))
    known = input_columns(labels, doc_id="doc_id", quality="quality", toxic="toxic")
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    rows = rows.join(known, "doc_id", "left").fillna(0, ["good", "toxic"])
    rows = written(rows.select("doc_id", "part", "digest", "mask", "good", "toxic"), "failures")

    def counted(some: DataFrame) -> DataFrame:
        sums = [F.sum(name).cast("long").alias(name) for name in ("good", "toxic")]
        return some.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), *sums)

    least = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    firsts = rows.join(least, ["digest", "doc_id"])
    originals = counted(firsts.unionByName(rows.filter("doc_id IS NULL"), allowMissingColumns=True).select(rows.columns))
    # all rows less the originals are the copies
    every = counted(rows).unionByName(
        originals.select("part", "mask", *(-F.col(name).alias(name) for name in WEIGHTS)).toDF("part", "mask", *WEIGHTS)
    )
    copies = every.withColumn("mask", F.col("mask").bitwiseOR(1 << len(text_failures(F.col("text")))))
    united = originals.unionByName(copies)
    return united.groupBy("part", "mask").agg(*(F.sum(name).alias(name) for name in WEIGHTS))


def audit(counts: DataFrame, names: Sequence[str]) -> DataFrame:
    """The report of each part from its counts of masks (part, mask, n, good, toxic); ``names`` are single letters."""
    if len(names) > MOST_FILTERS:
        raise ValueError(f"{len(names)} filters have too many orders")
    ship(counts.sparkSession)
    names = tuple(names)
    schema = "part string, " + ", ".join(f"{name} {dtype}" for name, dtype in REPORT.items())
    types = [{"string": pa.string(), "int": pa.int32(), "long": pa.int64()}[dtype] for dtype in REPORT.values()]

    def of_part(key: tuple[pa.Scalar, ...], masks: pa.Table) -> pa.Table:
        weights = zip(*(masks[name].to_pylist() for name in WEIGHTS), strict=True)
        rows = list(report(names, dict(zip(masks["mask"].to_pylist(), weights, strict=True))))
        columns = [pa.array(column, dtype) for column, dtype in zip(zip(*rows, strict=True), types, strict=True)]
        return pa.table([pa.array([key[0].as_py()] * len(rows), pa.string()), *columns], ["part", *REPORT])

    return counts.groupBy("part").applyInArrow(of_part, schema)


def op13(spark, sf_dir: str) -> DataFrame:
    counts = failure_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return audit(counts, "ABCDE")


OP13_SQL = r"""
WITH RECURSIVE rows_of AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents),
known AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
    FROM labels GROUP BY doc_id),
firsts AS (SELECT body, min(doc_id) AS first_id FROM rows_of GROUP BY body),
failing AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad,
        CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
        || CASE WHEN 100 * (length(body) - length(regexp_replace(body, '[A-Z]', '', 'g'))) > 2 * length(body) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN doc_id > first_id THEN 'E' ELSE '' END AS failed
    FROM rows_of JOIN firsts USING (body) LEFT JOIN known USING (doc_id)),
masks AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM failing GROUP BY part, failed),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter),
orders AS (
    SELECT letter AS filter_order FROM letters
    UNION ALL
    SELECT filter_order || letter FROM orders JOIN letters ON NOT contains(filter_order, letter)),
steps AS (
    SELECT filter_order, step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step) AS so_far,
        substr(filter_order, 1, step - 1) AS before
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step) WHERE length(filter_order) = 5),
counted AS (
    SELECT part, filter_order, step, letter,
        sum(CASE WHEN translate(failed, so_far, '') = failed THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN translate(failed, before, '') = failed AND contains(failed, letter) THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN translate(failed, before, '') <> failed AND contains(failed, letter) THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN failed = letter THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN translate(failed, before, '') = failed AND contains(failed, letter) THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN translate(failed, before, '') = failed AND contains(failed, letter) THEN bad ELSE 0 END) AS toxic_lost
    FROM masks, steps GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
    unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
    (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM counted
"""
