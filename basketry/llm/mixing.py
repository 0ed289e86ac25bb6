"""Mixing sources to target weights: random order within each source, prefix sums of words, a cut at the exact budget.

Each document gets a key by the hash of its id. The documents are range-sorted by source and key, so a large source lies
in many partitions, one after the other; each partition sums the words of its piece of each source as it goes, and what
came before a piece is added from the table of pieces. A source's budget is read in this order: whole epochs first, then
documents up to the words that are left; the document at the cut gives its first words, so that the words taken are the
budget to the word.

Targets share all words by the weights of the sources. Where a target would be above ``most_epochs`` times its source,
it stops there, and what is left over goes to the others by weight. The level at which that ends is found with the same
prefix sums over the sources in the order of their limit per weight: the documents, the sources and their ranks all go
through ranges, nothing goes whole through the driver.

Defined results: a null text has no words; a null source is a source of its own, the last; a source without words has
target 0; a null id is one id; rows that repeat an id are rows of their own, told apart by size, and where that is
equal by their place, which changes no result but the order of like rows. An empty table gives no rows. Extra columns
are left out unless ``carry`` names them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import ship, table, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
SEED = "mix"


def _group_starts(groups: pa.Array) -> np.ndarray:
    """Where a new group begins in a column sorted by group."""
    codes = groups.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))


def pieces_of(df: DataFrame, order: Sequence[Column], values: Sequence[str], by: str, label: str) -> tuple[DataFrame, DataFrame]:
    """The rows in ranges of ``order``, each with its piece and the running sums of ``values`` within that piece
    (``_run_``); and the pieces with their group, what is before them in it (``_offset_``) and all of it (``all_``).

    ``order`` starts with the group ``by``; the values are whole numbers, none negative. A group may lie in any number
    of partitions: only its pieces come together, a row for each.
    """
    ship(df.sparkSession)
    added = [T.StructField(name, T.LongType()) for name in ("_piece", *(f"_run_{value}" for value in values))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # pieces are numbered upwards through the partitions
        piece = (TaskContext.get().partitionId() << 40) - 1
        last, sums = None, np.zeros(len(values), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            groups = batch.column(by)
            starts = _group_starts(groups)
            sizes = np.diff(np.append(starts, batch.num_rows))
            if last is None or last[0] != groups[0].as_py():
                piece += 1
                sums[:] = 0
            runs = []
            for at, value in enumerate(values):
                total = np.cumsum(batch.column(value).to_numpy(zero_copy_only=False).astype(np.int64))
                before = np.concatenate(([-sums[at]], total[starts[1:] - 1]))
                runs.append(total - np.repeat(before, sizes))
                sums[at] = runs[-1][-1]
            numbers = piece + np.repeat(np.arange(len(starts)), sizes)
            piece, last = int(numbers[-1]), (groups[-1].as_py(),)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(x, pa.int64()) for x in (numbers, *runs))],
                [*batch.schema.names, *(field.name for field in added)],
            )

    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = written(ordered.mapInArrow(run, T.StructType([*df.schema.fields, *added])), label)
    sums = [F.max(f"_run_{value}").alias(f"_sum_{value}") for value in values]
    pieces = rows.groupBy("_piece").agg(F.any_value(by).alias("_group"), *sums)
    whole = Window.partitionBy("_group")
    earlier = whole.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = []
    for value in values:
        offsets.append(F.coalesce(F.sum(f"_sum_{value}").over(earlier), F.lit(0)).alias(f"_offset_{value}"))
        offsets.append(F.sum(f"_sum_{value}").over(whole).alias(f"all_{value}"))
    return rows, pieces.select("_piece", "_group", *offsets)


def before(value: str) -> Column:
    """The sum over the rows before a row in its group, of rows joined with their pieces."""
    return F.col(f"_offset_{value}") + F.col(f"_run_{value}") - F.col(value)


def source_targets(sizes: DataFrame, weights: Sequence[int], most_epochs: int) -> DataFrame:
    """source, source_size, target of the table of sources (source, source_size)."""
    sources = sizes.select(F.lit(0).alias("all"), "source", "source_size", F.lit(1).cast("long").alias("one"))
    by_name = [F.col("all"), F.col("source").asc_nulls_last()]
    rows, pieces = pieces_of(sources, by_name, ["one", "source_size"], "all", "ranks")
    turn = F.pmod(before("one"), F.lit(len(weights))).cast("int")
    limited = rows.join(pieces, "_piece").select(
        "all",
        "source",
        "source_size",
        F.col("all_source_size").alias("total"),
        F.array(*(F.lit(weight).cast("long") for weight in weights))[turn].alias("weight"),
        (F.col("source_size") * most_epochs).alias("limit"),
    )
    # with the sources before one at their limits, the others share what is left
    by_limit = [F.col("all"), F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last()]
    rows, pieces = pieces_of(limited, by_limit, ["limit", "weight"], "all", "limits")
    left = F.col("total") - before("limit")
    weight_left = F.col("all_weight") - before("weight")
    # the share of a unit of weight grows as long as a limit is below it, and then no more
    level = F.struct((left / weight_left).alias("level"), left.alias("left"), weight_left.alias("weight_left"))
    best = rows.join(pieces, "_piece").agg(F.max(level).alias("best")).first().best
    share = F.lit(best.left if best else 0).cast("double") * F.col("weight") / F.lit(best.weight_left if best else 1)
    return rows.select("source", "source_size", F.least(F.col("limit").cast("double"), share).alias("target"))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most_epochs: int = MOST_EPOCHS,
    seed: str = SEED,
    carry: Sequence[str] = (),
) -> DataFrame:
    """What the mix takes of each document: doc_id, source, size, source_size, target, epochs, last_words, taken.

    Sources in the order of their names get ``weights`` in turn. ``epochs`` are whole copies, ``last_words`` the words
    of one more that is cut.
    """
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        docs["source"].alias("source"),
        F.coalesce(F.regexp_count(docs["text"], F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.struct(*(docs[f"`{name}`"].alias(name) for name in carry), F.monotonically_increasing_id().alias("_place")).alias("_row"),
    )
    hashed = F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string")).cast("binary"))
    key = F.conv(F.substring(hashed, 1, 15), 16, 10).cast("long")
    order = [F.col("source").asc_nulls_last(), *map(F.col, ("_key", "doc_id", "size", "_row._place"))]
    # the ranges are drawn from a first look at the rows; written, the words of a text are counted once
    rows = written(rows.withColumn("_key", key), "sizes")
    rows, pieces = pieces_of(rows, order, ["size"], "source", "order")
    sizes = pieces.select(F.col("_group").alias("source"), F.col("all_size").alias("source_size")).distinct()
    targets = written(source_targets(sizes, weights, most_epochs), "targets").withColumnRenamed("source", "_source")
    # a source's target goes to its pieces, so that the rows of a large source meet it piece by piece
    pieces = pieces.join(targets, F.col("_group").eqNullSafe(F.col("_source")))
    aimed = rows.join(pieces.select("_piece", "_offset_size", "source_size", "target"), "_piece")
    budget = F.floor("target")
    aimed = aimed.withColumn("epochs", F.coalesce(F.expr("floor(target) div nullif(source_size, 0)"), F.lit(0)))
    rest = budget - F.col("epochs") * F.col("source_size") - before("size")
    aimed = aimed.withColumn("last_words", F.greatest(F.lit(0), F.least(rest, F.col("size"))))
    return aimed.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "epochs",
        "last_words",
        (F.col("epochs") * F.col("size") + F.col("last_words")).alias("taken"),
        *(F.col(f"_row.`{name}`").alias(name) for name in carry),
    )


def copies(mixed: DataFrame, text: str = "text") -> DataFrame:
    """The mix itself, a row per copy: doc_id, source, epoch (from 0), text; a cut copy keeps the white space between its words.

    ``mixed``: of ``mix`` with the text carried. Documents without words have no copy.
    """
    words = F.regexp_extract_all(F.col(text), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    words = F.slice(words, F.lit(1), F.col("last_words").cast("int"))
    last = F.when(F.col("last_words") == F.col("size"), F.col(text)).otherwise(F.concat_ws("", words))
    number = (F.col("epochs") + F.when(F.col("last_words") > 0, 1).otherwise(0)).cast("int")
    rows = mixed.filter("taken > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), number - 1)))
    return rows.select("doc_id", "source", "epoch", F.when(F.col("epoch") < F.col("epochs"), F.col(text)).otherwise(last).alias("text"))


def op12(spark, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "epochs")


OP12_SQL = r"""
WITH docs AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
        substr(md5(concat_ws(':', 'mix', doc_id::VARCHAR)), 1, 15) AS k
    FROM documents),
sources AS (
    SELECT source, source_size, source_size * 3 AS most, total,
        [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::BIGINT AS weight
    FROM (SELECT source, sum(size)::BIGINT AS source_size, sum(sum(size)) OVER ()::BIGINT AS total FROM docs GROUP BY source)),
filled AS (
    SELECT total - coalesce(sum(most) OVER earlier, 0)::BIGINT AS words_left,
        sum(weight) OVER ()::BIGINT - coalesce(sum(weight) OVER earlier, 0)::BIGINT AS weight_left
    FROM sources
    WINDOW earlier AS (ORDER BY most::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
best AS (SELECT words_left, weight_left FROM filled ORDER BY words_left::DOUBLE / weight_left DESC, words_left DESC, weight_left DESC LIMIT 1),
targets AS (SELECT source, source_size, least(most::DOUBLE, words_left::DOUBLE * weight / weight_left) AS target FROM sources, best),
ordered AS (
    SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
        coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
        CASE WHEN t.source_size > 0 THEN floor(t.target)::BIGINT // t.source_size ELSE 0 END AS epochs
    FROM docs AS d JOIN targets AS t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, epochs::BIGINT AS epochs,
    (epochs * size + greatest(0, least(budget - epochs * source_size - before, size)))::BIGINT AS taken
FROM ordered
"""
