"""Benchmark decontamination: Wu-Manber search of benchmark windows, with words as the alphabet.

The patterns are the windows of ``size`` consecutive words of each benchmark item (an item of fewer words is one
window). Patterns of one length make one matcher: a shift table over blocks of two adjacent words tells how far the
window can move on, a zero shift leads to a bucket keyed by the block at the window's end and the block at its start,
and what is in the bucket is compared word by word.

Benchmark patterns are split into shards of a bounded number of words; each shard is broadcast and searched in one
pass over the documents, so neither the number nor the size of the items is limited.

Defined results: a null or empty text, and one without words, has no words and no hits. A null item text has no
windows. An item without id marks words as hit but is not listed. Equal ids of several items count once. Rows are kept
one by one, repeated ones too; extra columns are left out of the report and kept by ``remove_contaminated``.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import input_columns, per_batch, table, texts_of, utf8

WINDOW = 10
#: most pattern words held by one task at a time
SHARD_WORDS = 5_000_000

# A-Z to a-z, all other ASCII but digits and letters to a blank; bytes from 0x80 on belong to words
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


class Matcher:
    """Wu-Manber over words for patterns of one length."""

    def __init__(self, length: int, patterns: dict[tuple[bytes, ...], int]):
        self.length = length
        self.block = min(2, length)
        self.furthest = length - self.block + 1
        self.shift: dict[bytes, int] = {}
        self.bucket: dict[bytes, dict[bytes, list[tuple[list[bytes], int]]]] = defaultdict(dict)
        for words, number in patterns.items():
            for end in range(self.block, length + 1):
                key = b" ".join(words[end - self.block : end])
                distance = length - end
                if distance < self.shift.get(key, self.furthest):
                    self.shift[key] = distance
            last, first = b" ".join(words[-self.block :]), b" ".join(words[: self.block])
            self.bucket[last].setdefault(first, []).append((list(words), number))
        self.bucket = dict(self.bucket)

    def find(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """Pairs of the first word's position and the pattern's number."""
        length, shift, furthest, bucket = self.length, self.shift.get, self.furthest, self.bucket
        at, count = length - 1, len(words)
        if self.block == 1:
            while at < count:
                step = shift(words[at], furthest)
                if not step:
                    for pattern, number in bucket[words[at]][words[at]]:
                        yield at, number
                    step = 1
                at += step
            return
        while at < count:
            key = words[at - 1] + b" " + words[at]
            step = shift(key, furthest)
            if not step:
                start = at - length + 1
                for pattern, number in bucket[key].get(words[start] + b" " + words[start + 1], ()):
                    if words[start : at + 1] == pattern:
                        yield start, number
                step = 1
            at += step


class Searcher:
    """All matchers of a shard. ``items[n]`` are the item ids of pattern ``n``."""

    def __init__(self, windows: dict[tuple[bytes, ...], set[str]]):
        self.items = [sorted(ids) for ids in windows.values()]
        by_length: dict[int, dict[tuple[bytes, ...], int]] = defaultdict(dict)
        for number, words in enumerate(windows):
            by_length[len(words)][words] = number
        self.matchers = [Matcher(length, patterns) for length, patterns in sorted(by_length.items())]

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Covered ranges of word positions (end excluded), joined where they meet, and the items found."""
        ranges, items = [], set()
        for matcher in self.matchers:
            for start, number in matcher.find(words):
                ranges.append((start, start + matcher.length))
                items.update(self.items[number])
        return merged(ranges), items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def shards(benchmark: DataFrame, id_col: str, text_col: str, window: int, shard_words: int) -> Iterator[dict]:
    """The windows of the benchmark in shards of bounded size, one at a time through the driver."""
    rows = input_columns(benchmark, item=id_col, body=text_col).select(
        F.col("item").cast("string").alias("item"), utf8("body").alias("body")
    )
    windows: dict[tuple[bytes, ...], set[str]] = {}
    held = 0
    for row in rows.toLocalIterator():
        words = words_of(bytes(row.body))
        size = min(window, len(words))
        for start in range(len(words) - size + 1 if size else 0):
            ids = windows.setdefault(tuple(words[start : start + size]), set())
            held += size
            if row.item is not None:
                ids.add(row.item)
            if held >= shard_words:
                yield windows
                windows, held = {}, 0
    if windows:
        yield windows


_HITS = "hits array<int>, items array<string>"


def _scan(df: DataFrame, searcher) -> DataFrame:
    """Add what one shard finds to the ranges and items found so far."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        search = searcher.value.search
        hits, items = [], []
        old_hits, old_items = batch.column("_hits").to_pylist(), batch.column("_items").to_pylist()
        for text, before, known in zip(texts_of(batch.column("_body")), old_hits, old_items, strict=True):
            ranges, found = search(words_of(text))
            if before:
                ranges = merged(ranges + list(zip(before[::2], before[1::2], strict=True)))
            hits.append([position for pair in ranges for position in pair])
            items.append(sorted(found.union(known or ())))
        columns = {name: batch.column(name) for name in batch.schema.names}
        columns["_hits"] = pa.array(hits, pa.list_(pa.int32()))
        columns["_items"] = pa.array(items, pa.list_(pa.string()))
        return pa.RecordBatch.from_pydict(columns)

    return per_batch(df, run, df.schema)


def _searched(docs: DataFrame, benchmark: DataFrame, text_col: str, item_col: str, item_text: str, **size) -> DataFrame:
    """``docs`` with the scratch columns _body, _hits and _items. ``docs`` must have no columns of these names."""
    df = docs.withColumns(
        {"_body": utf8(f"`{text_col}`"), "_hits": F.lit(None).cast("array<int>"), "_items": F.lit(None).cast("array<string>")}
    )
    for windows in shards(benchmark, item_col, item_text, size["window"], size["shard_words"]):
        df = _scan(df, docs.sparkSession.sparkContext.broadcast(Searcher(windows)))
    return df


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """A row per document: its words, hit words, items with occurring windows, and their list as a sha256 digest."""
    own = input_columns(docs, doc_id=doc_id, _text=text)
    df = _searched(own, benchmark, "_text", item_id, item_text, window=window, shard_words=shard_words)

    def report(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = texts_of(batch.column("_body"))
        hits = [sum(x[1::2]) - sum(x[::2]) if x else 0 for x in batch.column("_hits").to_pylist()]
        items = [x or [] for x in batch.column("_items").to_pylist()]
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                "n_words": pa.array(np.fromiter((len(words_of(x)) for x in texts), np.int64, len(texts))),
                "n_hit": pa.array(hits, pa.int64()),
                "n_items": pa.array([len(x) for x in items], pa.int64()),
                "items": pa.array(items, pa.list_(pa.string())),
                "items_sha256": [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items],
                "contaminated": pa.array([x > 0 for x in hits]),
            }
        )

    kind = own.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_hit long, n_items long, items array<string>, items_sha256 string, contaminated boolean"
    return per_batch(df.select("doc_id", "_body", "_hits", "_items"), report, schema)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark occurs, with the columns of ``docs``."""
    names = docs.columns
    boxed = docs.select(docs[f"`{text}`"].alias("_text"), F.struct(*(docs[f"`{name}`"] for name in names)).alias("_row"))
    df = _searched(boxed, benchmark, "_text", "item_id", "text", window=window, shard_words=SHARD_WORDS)
    clean = df.filter(F.coalesce(F.size("_hits"), F.lit(0)) <= 0)
    return clean.select(*(F.col("_row").getField(name).alias(name) for name in names))


def op10(spark, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("items")


OP10_SQL = r"""
WITH d AS (
    SELECT doc_id, row_number() OVER () AS rid,
           coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
    FROM documents),
b AS (
    SELECT item_id,
           coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
    FROM benchmark),
sized AS (SELECT item_id, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
patterns AS (
    SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
    FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
lengths AS (SELECT DISTINCT n FROM patterns),
places AS (
    SELECT rid, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
    FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)),
found AS (SELECT p.rid, p.i, p.n, q.item_id FROM places p JOIN patterns q ON p.n = q.n AND p.win = q.win),
hit AS (SELECT rid, count(DISTINCT pos) AS n_hit
        FROM (SELECT DISTINCT rid, unnest(range(i, i + n)) AS pos FROM found) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
          FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM found) GROUP BY rid)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN items USING (rid)
"""
