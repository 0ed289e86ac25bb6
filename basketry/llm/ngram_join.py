"""Jaccard self-join of texts on word n-grams by prefix trees, and the groups that its links make.

A text's set holds the 64-bit hashes of its n-grams, in the global order of their values. Two sets of similarity t or
more share at least ``l`` of their first ``n - ceil(t n) + l`` n-grams, whatever ``l`` (here a twentieth of the set).
These first n-grams, the head of a set, are all that is compared before candidates are known.

1. Equal sets are one node. Heads are exploded; n-grams in only one head are dropped by count.
2. Every set goes to a shard with the one other set it shares most head n-grams with among the smallest ids of these
   n-grams. Walks of the shard's prefix trees link nearly all copies to their group.
3. Only n-grams that stand in sets of more than one group go on, as sets of different groups share no others. Those in
   at most ``FREQUENT`` heads bring together the sets that may still be linked, if their heads can share what the bound
   asks for. Sets with so many frequent n-grams that a pair could share these alone are cut into parts by the values of
   their elements: similar sets differ in fewer elements than there are parts, so some parts are equal. Only sets that
   hold too many parts which many sets hold are compared in blocks; sets that a task has joined are not compared again.
4. Links are found by prefix trees of whole sets, ``PrefixTree``: elements stand in the order of falling frequency among
   the sets of a tree, sets that begin alike share their nodes, a walk carries the overlap of a branch for all its sets,
   and leaves a branch as soon as the elements that remain on it and in the probe can't reach the overlap asked for.
   Compressed texts are moved to the trees, and their sets made there.

``FREQUENT``, ``PART_SETS``, the sizes of blocks and filters, and ``l`` change the work and never the result. N-grams count as equal
if their 64-bit hashes are; within a pair of sets a chance match is less likely than 1 in 10^12.

Defined results: a text without words, null ones too, has an empty set and is linked with nothing; one of fewer words
than ``n`` has its whole sequence as its only n-gram. Rows of one id are one document: they are in one group. A row
without id has no group and is kept by ``keep_one``. Extra columns are left out by ``groups``, kept by ``keep_one``.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import input_columns, per_batch, ship, table, texts_of, utf8, written
from basketry.llm.components import components

FREQUENT = 64
#: most sets that a part of them brings together pair by pair; a block compares more of them in less time
PART_SETS = 16
#: most sets in a prefix tree
TREE_SETS = 256
#: sets with frequent n-grams compared with each other in one task, squared
BLOCK_SETS = 512
#: bits of the filters that are broadcast, whatever the input's size
FILTER_BITS = 1 << 26
#: texts whose sets a worker holds at a time
TEXTS = 256


@dataclass(frozen=True)
class Measure:
    """n-grams of ``words`` words; similar at ``num / den`` of the union or more."""

    words: int = 4
    num: int = 85
    den: int = 100

    def needed(self, a, b):
        """The least overlap of two similar sets of these sizes."""
        return -(-self.num * (a + b) // (self.num + self.den))

    def least_partner(self, n):
        return -(-self.num * n // self.den)

    @staticmethod
    def slack(n):
        """The ``l`` of a set."""
        return 1 + n // 20

    def least_slack(self) -> str:
        """SQL of the slack of a set's smallest partner."""
        return f"1 + int(ceil({self.num} * n / {self.den}) div 20)"

    def shared_heads(self) -> str:
        """SQL of the least number of elements that the heads of similar sets of ``n`` and ``n2`` elements share.

        All that both sets hold up to the end of the head that ends first is in both heads; what follows adds at most
        the rest of its set.
        """
        rest = ", ".join(f"int(ceil({self.num} * {x} / {self.den})) - 1 - {x} div 20" for x in ("n", "n2"))
        return f"int(ceil({self.num} * (n + n2) / {self.num + self.den})) - greatest({rest})"

    def apart(self, n):
        """The most elements that stand in only one of two similar sets, of which one has ``n``. Also as SQL."""
        if isinstance(n, str):
            return f"({n} * {self.den} div {self.num} - {n})"
        return n * self.den // self.num - n

    def band(self, n: int) -> int:
        """A similar set is in the same band of sizes or in a neighbouring one."""
        return int(np.floor(np.log(n) / np.log(self.den / self.num) + 1e-9))

    def parts(self, window: int) -> int:
        """Into how many parts the sets of two neighbouring bands are cut, the lower one being ``window``.

        Half more than the elements by which similar ones can differ, so that a third of the parts may be held by many.
        """
        return 3 * self.apart(int((self.den / self.num) ** (window + 2)) + 1) // 2 + 2

    def head(self, n: int) -> int:
        return n - self.least_partner(n) + self.slack(n) if n else 0


class Shingler:
    """Sorted distinct hashes of a text's n-grams."""

    def __init__(self, words: int):
        self.words = words

    def of(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        # a word is hashed in less time than it is looked up
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        size = min(self.words, len(words))
        count = len(words) - size + 1
        mixed = np.full(count, size, np.uint64)
        for k in range(size):
            mixed = (mixed ^ hashes[k : k + count]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        return np.unique(mixed ^ (mixed >> np.uint64(32)))


class PrefixTree:
    """Sets as a prefix tree: elements in the order of falling frequency, so that sets which share much begin alike.

    A node holds the elements up to the next place where its sets part or one of them ends; each element is stored once
    for all sets below it (``stored`` of ``given``). A probe goes down from the root and carries the overlap it has so
    far, for all sets of a branch at once. A subtree is left as soon as the elements that remain, in it or in the
    probe, can't reach the overlap asked for, or if it holds no set that is wanted.
    """

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        self.given = int(self.sizes.sum())
        joined = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        self.values, place, counts = np.unique(joined, return_inverse=True, return_counts=True)
        rank_of = np.empty(len(counts), np.int64)
        rank_of[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
        self.rank_of = rank_of
        ranked = [np.sort(part) for part in np.split(rank_of[place], np.cumsum(self.sizes)[:-1])] if sets else []
        # sets of one subtree stand side by side in the order of their elements
        order = sorted((i for i in range(len(sets)) if len(ranked[i])), key=lambda i: ranked[i].astype(">u4").tobytes())
        self.order = np.array(order, np.int64)
        ranked = [ranked[i] for i in order]
        self.nodes: list[tuple] = []
        self.children: list[list[int]] = []
        self.stored = 0
        self.top = self._branches(ranked, 0, len(ranked), 0, self._alike(ranked))

    @staticmethod
    def _alike(ranked: list[np.ndarray]) -> np.ndarray:
        """How many first elements each set has in common with the next."""
        out = np.zeros(max(0, len(ranked) - 1), np.int64)
        for i in range(len(out)):
            size = min(len(ranked[i]), len(ranked[i + 1]))
            differs = ranked[i][:size] != ranked[i + 1][:size]
            out[i] = differs.argmax() if differs.any() else size
        return out

    def _branches(self, ranked: list[np.ndarray], first: int, last: int, depth: int, alike: np.ndarray) -> list[int]:
        """Nodes below ``depth`` of the sets from ``first`` up to ``last``; returns the uppermost ones."""
        tops: list[int] = []
        todo = [(first, last, depth, tops)]
        while todo:
            lo, hi, at, siblings = todo.pop()
            # cuts between sets that part here
            cuts = [lo, *(lo + 1 + np.flatnonzero(alike[lo : hi - 1] <= at)).tolist(), hi]
            for x, y in zip(cuts, cuts[1:]):
                if x == y:
                    continue
                end = int(alike[x : y - 1].min()) if y - x > 1 else len(ranked[x])
                done = x
                while done < y and len(ranked[done]) == end:
                    done += 1
                sizes = self.sizes[self.order[x:y]]
                run = ranked[x][at:end]
                self.stored += len(run)
                siblings.append(len(self.nodes))
                below: list[int] = []
                self.nodes.append((run, end, x, done, y, int(sizes.min()), int(sizes.max())))
                self.children.append(below)
                if done < y:
                    todo.append((done, y, end, below))
        return tops

    def search(self, probe: np.ndarray, measure: Measure, wanted: np.ndarray | None = None) -> np.ndarray:
        """Numbers of the sets that are similar to the probe; of those ``wanted`` only, if given."""
        n, found = len(probe), []
        if not len(self.order) or not n:
            return np.zeros(0, np.int64)
        place = np.minimum(np.searchsorted(self.values, probe), len(self.values) - 1)
        held = np.sort(self.rank_of[place[self.values[place] == probe]])
        present = np.zeros(len(self.values), bool)
        present[held] = True
        asked = None if wanted is None else np.concatenate(([0], np.cumsum(wanted[self.order])))
        todo = [(node, 0) for node in self.top]
        while todo:
            node, overlap = todo.pop()
            run, end, x, done, y, least, most = self.nodes[node]
            if asked is not None and asked[x] == asked[y]:
                continue
            overlap += int(np.count_nonzero(present[run]))
            left = len(held) - int(np.searchsorted(held, run[-1], side="right"))
            if overlap + left < measure.needed(n, least) or overlap + most - end < measure.needed(n, most):
                continue
            if done > x and overlap >= measure.needed(n, end):
                found.append(self.order[x:done])
            todo.extend((child, overlap) for child in self.children[node])
        out = np.concatenate(found) if found else np.zeros(0, np.int64)
        return out if wanted is None else out[wanted[out]]


def sets_of(docs: DataFrame, measure: Measure) -> DataFrame:
    """id, n, print (of the whole set), head of each row. ``docs``: id, body."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        make = Shingler(measure.words).of
        sizes, prints, heads = [], [], []
        for text in texts_of(batch.column("body")):
            whole = make(text)
            sizes.append(len(whole))
            prints.append(xxhash.xxh3_128_digest(whole.tobytes()))
            heads.append(whole[: measure.head(len(whole))].tobytes())
        return pa.RecordBatch.from_pydict(
            {
                "id": batch.column("id"),
                "n": pa.array(sizes, pa.int32()),
                "print": pa.array(prints, pa.binary()),
                "head": pa.array(heads, pa.binary()),
            }
        )

    return per_batch(docs, run, "id long, n int, print binary, head binary", TEXTS)


def exploded(sets: DataFrame, filter_bits: np.ndarray | None = None) -> DataFrame:
    """A row per element of each head: gram, id, n; without those that are surely not in a filter of ``own_bits``."""
    shared = None if filter_bits is None else sets.sparkSession.sparkContext.broadcast(filter_bits)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        heads = [np.frombuffer(head, np.int64) for head in batch.column("head").to_pylist()]
        counts = np.fromiter(map(len, heads), np.int64, len(heads))
        grams, take = np.concatenate(heads), np.repeat(np.arange(len(heads)), counts)
        if shared is not None:
            place = grams & (64 * len(shared.value) - 1)
            may = ((shared.value[place >> 6] >> (place & 63)) & 1).astype(bool)
            grams, take = grams[may], take[may]
        return pa.RecordBatch.from_pydict(
            {
                "gram": pa.array(grams),
                "id": batch.column("id").take(pa.array(take)),
                "n": batch.column("n").take(pa.array(take)),
            }
        )

    return per_batch(sets.select("id", "n", "head"), run, "gram long, id long, n int")


def bit_filter(df: DataFrame, column: str, bits: int = FILTER_BITS) -> np.ndarray:
    """A bit for the hash of each value; of fixed size, so that it may be collected and broadcast."""
    return _bits(df, F.pmod(F.xxhash64(column), F.lit(bits)), bits)


def own_bits(df: DataFrame, column: str, bits: int = FILTER_BITS) -> np.ndarray:
    """The same of values that are hashes, placed by their lowest bits. ``bits`` is a power of two."""
    return _bits(df, F.col(column).bitwiseAND(F.lit(bits - 1)), bits)


def _bits(df: DataFrame, place: F.Column, bits: int) -> np.ndarray:
    words = df.select(place.alias("p")).groupBy(F.expr("p div 64").alias("w"))
    found = words.agg(F.expr("bit_or(shiftleft(1L, int(p % 64)))").alias("b")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[found["w"].to_numpy()] = found["b"].to_numpy()
    return out


def may_hold(df: DataFrame, column: str, filter_bits: np.ndarray, holds: bool = True) -> DataFrame:
    """Drop rows whose value is surely not in the filter; these alone are kept without ``holds``."""
    bits = 64 * len(filter_bits)
    shared = df.sparkSession.sparkContext.broadcast(filter_bits)
    schema = df.schema
    placed = df.withColumn("_place", F.pmod(F.xxhash64(column), F.lit(bits)))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        place = batch.column("_place").to_numpy()
        keep = (shared.value[place >> 6] >> (place & 63)) & 1
        return batch.filter(pa.array(keep.astype(bool) == holds)).select(schema.names)

    return per_batch(placed, run, schema)


def parted(df: DataFrame, column: str, values: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose value is surely not among ``values``, and the others, which alone must be moved to be told apart.

    Only the hash of the value goes to Python; the rows stay where they are.
    """
    filter_bits = bit_filter(values, column)
    bits = 64 * len(filter_bits)
    shared = df.sparkSession.sparkContext.broadcast(filter_bits)

    @F.arrow_udf("boolean")
    def held(places: pa.Array) -> pa.Array:
        place = places.to_numpy()
        return pa.array(((shared.value[place >> 6] >> (place & 63)) & 1).astype(bool))

    may = held(F.pmod(F.xxhash64(column), F.lit(bits)))
    return df.filter(~may), df.filter(may)


def packed_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """id, packed of the documents of some ids, and perhaps of a few others. ``docs``: id, body.

    What is moved to where sets are compared is the compressed text, not its set: hashes don't compress, and a set is
    nearly three times as large.
    """

    def pack(batch: pa.RecordBatch) -> pa.RecordBatch:
        packed = [zlib.compress(text, 1) for text in texts_of(batch.column("body"))]
        return pa.RecordBatch.from_pydict({"id": batch.column("id"), "packed": pa.array(packed, pa.binary())})

    return per_batch(parted(docs, "id", ids)[1], pack, "id long, packed binary", TEXTS)


def sets_in(packed: pa.ChunkedArray, measure: Measure) -> list[np.ndarray]:
    """The whole sets of texts from ``packed_texts``."""
    make = Shingler(measure.words).of
    return [make(zlib.decompress(text)) for text in packed.to_pylist()]


def hubs_of(pairs: DataFrame) -> DataFrame:
    """a, block, id, probe: each ``a`` with blocks of a bounded number of its ``b``; ``a`` itself is the probe of each."""
    hubs = pairs.groupBy("a").agg(F.ceil(F.count("*") / TREE_SETS).cast("int").alias("blocks"))
    members = pairs.join(hubs, "a").select(
        "a", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int").alias("block"), F.col("b").alias("id"), F.lit(False).alias("probe")
    )
    probes = hubs.select(
        "a", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("a").alias("id"), F.lit(True).alias("probe")
    )
    return written(members.unionByName(probes), "places")


def verified(docs: DataFrame, pairs: DataFrame, measure: Measure, among: bool = False) -> DataFrame:
    """Links a, b found by walking prefix trees of whole sets. ``docs``: id, body; ``pairs``: distinct a, b.

    The sets ``b`` of an ``a`` form trees of bounded size, through which the set ``a`` is run. With ``among`` the sets of a
    tree that it did not link are run through it as well, until all links between groups of the tree are known.
    """
    places = hubs_of(pairs)

    def link(group: pa.Table) -> pa.Table:
        ids, is_probe = group["id"].to_numpy(), group["probe"].to_numpy(zero_copy_only=False)
        sets = sets_in(group["packed"], measure)
        tree, met, first = PrefixTree(sets), Merger(np.arange(len(sets))), np.flatnonzero(is_probe)
        out_a, out_b = [], []
        for i in [*first.tolist(), *(np.flatnonzero(~is_probe).tolist() if among else ())]:
            if not is_probe[i] and (met.root[i] == met.root[first]).any():
                continue
            near = tree.search(sets[i], measure, met.root != met.root[i])
            if len(near):
                out_a.append(np.full(len(near), ids[i]))
                out_b.append(ids[near])
                met.join(i, near)
        empty = [np.zeros(0, np.int64)]
        return pa.table({"a": pa.array(np.concatenate(out_a or empty)), "b": pa.array(np.concatenate(out_b or empty))})

    return places.join(packed_texts(docs, places), "id").groupBy("a", "block").applyInArrow(link, "a long, b long")


def between(shared: DataFrame, group_of: DataFrame) -> DataFrame:
    """gram, id, n, cnt, component of the n-grams that stand in sets of more than one group.

    Sets of different groups share no others, so the rest of the search needs no others.
    """
    rows = shared.select("gram", "id", "n", "cnt").join(group_of, "id", "left")
    rows = rows.withColumn("component", F.coalesce("component", "id"))
    apart = rows.groupBy("gram").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi")
    return written(rows.join(apart.select("gram"), "gram"), "between")


class Merger:
    """Which components have met in a task."""

    def __init__(self, components: np.ndarray):
        _, first = np.unique(components, return_inverse=True)
        self.root = first.astype(np.int64)

    def join(self, i: int, others: np.ndarray) -> None:
        merged = np.isin(self.root, np.concatenate((self.root[[i]], self.root[others])))
        self.root[merged] = self.root[i]


def part_keys(docs: DataFrame, ids: DataFrame, measure: Measure) -> DataFrame:
    """Two rows per whole set of some ids: id, mark (of the set), n, window, parts, empty, keys (of parts not empty).

    A set is cut as the others of its two windows are, pairs of neighbouring bands. Equal parts have equal keys.
    """
    mix, mix2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)

    def mixed(values: np.ndarray) -> np.ndarray:
        values = values * mix
        values = (values ^ (values >> np.uint64(29))) * mix2
        return values ^ (values >> np.uint64(32))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        make = Shingler(measure.words).of
        keys, marks, numbers = [np.zeros(0, np.uint64)], [], []
        for i, text in enumerate(texts_of(batch.column("body"))):
            whole = make(text)
            if not len(whole):
                continue
            each, band = mixed(whole), measure.band(len(whole))
            for window in (band - 1, band):
                parts = measure.parts(window)
                # values are spread evenly, so the parts are ranges of values
                part = (whole >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
                first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
                place = part[first] | (np.uint64(window + 1) << np.uint64(40))
                keys.append(mixed(np.add.reduceat(each, first) ^ mixed(place)))
                marks.append(each.sum())
                numbers.append((i, len(first), len(whole), window, parts, parts - len(first)))
        rows, held, *rest = np.array(numbers, np.int64).reshape(-1, 6).T
        ends = np.concatenate(([0], np.cumsum(held))).astype(np.int32)
        return pa.RecordBatch.from_pydict(
            {
                "id": batch.column("id").take(pa.array(rows)),
                "mark": pa.array(np.array(marks, np.uint64).view(np.int64)),
                **{name: pa.array(values.astype(np.int32)) for name, values in zip(("n", "window", "parts", "empty"), rest)},
                "keys": pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys).view(np.int64))),
            }
        )

    schema = "id long, mark long, n int, window int, parts int, empty int, keys array<long>"
    return per_batch(parted(docs, "id", ids)[1], run, schema, TEXTS)


def by_parts(docs: DataFrame, left: DataFrame, measure: Measure) -> tuple[DataFrame, DataFrame]:
    """Pairs a, b of sets of different groups that may be similar; and id of the sets whose pairs these may lack.

    ``left``: id, component. Similar sets differ in ``apart`` elements at most, each of which spoils one part, so all
    other parts are equal. Of these, some may be empty or held by more than ``PART_SETS`` sets; if a set has so few of such
    that one more must be equal, its pairs are found by that one.
    """
    made = part_keys(docs, left, measure).join(left.select("id", "component").distinct(), "id")
    made = written(made.withColumn("key", F.explode("keys")).drop("keys"), "parts")
    # equal parts within one group bring nothing together
    held = made.groupBy("key").agg(F.count("*").alias("cnt"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    live = written(made.join(held.filter("lo <> hi").select("key", "cnt"), "key"), "live-parts")
    one_set = ["id", "mark", "n", "window"]
    lost = live.groupBy(*one_set, "parts", "empty").agg((F.count_if(F.col("cnt") > PART_SETS) + F.col("empty")).alias("lost"))
    asked = f"parts - {measure.apart('n')}"
    open_ = lost.filter(f"lost >= {asked}").select("id").unionByName(made.filter(f"empty >= {asked}").select("id")).distinct()
    rare = live.filter(F.col("cnt") <= PART_SETS).drop("cnt", "empty").join(lost.drop("parts", "empty"), one_set)
    # both sides are named anew, so that they are one exchange
    rare = written(rare, "rare-parts")
    one, other = (
        rare.select("key", "window", "parts", *(F.col(name).alias(f"{name}{end}") for name in ("id", "mark", "n", "lost", "component")))
        for end in ("", "2")
    )
    alike = f"least(n, n2) * {measure.den} >= greatest(n, n2) * {measure.num}"
    pairs = one.join(other, ["key", "window", "parts"]).filter(f"id < id2 and component <> component2 and {alike}")
    pairs = pairs.groupBy("id", "mark", "n", "lost", "id2", "mark2", "n2", "lost2", "window", "parts").agg(F.count("*").alias("c"))
    spoilt = f"(n + n2 - 2 * int(ceil({measure.num} * (n + n2) / {measure.num + measure.den})))"
    pairs = pairs.filter(f"c + least(lost, lost2) >= parts - {spoilt}")
    return written(pairs.select(F.col("id").alias("a"), F.col("id2").alias("b")).distinct(), "pairs"), written(open_, "open-sets")


def frequent_links(docs: DataFrame, rows: DataFrame, measure: Measure) -> DataFrame:
    """Links a, b that join all groups with similar sets that may share frequent n-grams alone.

    ``docs``: id, body; ``rows``: those of ``between``. Sets with equal parts are compared pair by pair, those left open in
    blocks, by prefix trees of whole sets; a pair already joined, by a group or within the task, is not looked at again.
    """
    enough = F.expr(measure.least_slack())
    left = rows.filter(F.col("cnt") > FREQUENT).groupBy("id", "n", "component").agg(F.count("*").alias("mixed"))
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(measure.den / measure.num)) + 1e-9).cast("int")
    left = written(left.filter(F.col("mixed") >= enough).select("id", "component", band.alias("band")), "frequent-sets")
    pairs, open_ = by_parts(docs, left, measure)
    left = written(left.join(open_, "id", "left_semi"), "frequent-sets")
    return verified(docs, pairs, measure).unionByName(block_links(docs, left, measure))


def block_links(docs: DataFrame, left: DataFrame, measure: Measure) -> DataFrame:
    """Links a, b between sets of different groups, each block of sets compared with each that may hold similar ones.

    ``docs``: id, body; ``left``: id, component, band. The work grows with the square of these sets in a band.
    """
    blocks = left.groupBy("band").agg(F.ceil(F.count("*") / BLOCK_SETS).cast("int").alias("blocks"))
    own = left.join(blocks, "band").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    # each block as a tree against each block of probes of its band and of the band below
    here = blocks.select(F.col("band").alias("tree_band"), F.col("blocks").alias("tree_blocks"))
    asking = blocks.select(
        F.col("band").alias("probe_band"), F.col("blocks").alias("probe_blocks"), F.explode(F.array("band", F.col("band") + 1)).alias("tree_band")
    )
    tiles = here.join(asking, "tree_band")
    tiles = tiles.select("tree_band", "probe_band", F.explode(F.sequence(F.lit(0), F.col("tree_blocks") - 1)).alias("tree"), "probe_blocks")
    tiles = tiles.select("tree_band", "probe_band", "tree", F.explode(F.sequence(F.lit(0), F.col("probe_blocks") - 1)).alias("ask"))
    tiles = tiles.filter("tree_band <> probe_band or ask <= tree")
    keys = ("tree_band", "probe_band", "tree", "ask")
    trees = own.join(tiles, (F.col("band") == F.col("tree_band")) & (F.col("block") == F.col("tree")))
    probes = own.join(tiles, (F.col("band") == F.col("probe_band")) & (F.col("block") == F.col("ask")))
    places = trees.select(*keys, "id", "component", F.lit(False).alias("probe")).unionByName(
        probes.select(*keys, "id", "component", F.lit(True).alias("probe"))
    )
    places = written(places, "tiles")

    def search(group: pa.Table) -> pa.Table:
        ids = group["id"].to_numpy()
        sets = sets_in(group["packed"], measure)
        is_probe = group["probe"].to_numpy(zero_copy_only=False)
        inner = np.flatnonzero(~is_probe)
        tree, met = PrefixTree([sets[i] for i in inner]), Merger(group["component"].to_numpy())
        out_a, out_b = [], []
        for i in np.flatnonzero(is_probe).tolist():
            wanted = met.root[inner] != met.root[i]
            if len(sets[i]) and wanted.any():
                near = inner[tree.search(sets[i], measure, wanted)]
                if len(near):
                    out_a.append(np.full(len(near), ids[i]))
                    out_b.append(ids[near])
                    met.join(i, near)
        empty = [np.zeros(0, np.int64)]
        return pa.table({"a": pa.array(np.concatenate(out_a or empty)), "b": pa.array(np.concatenate(out_b or empty))})

    return places.join(packed_texts(docs, left), "id").groupBy(*keys).applyInArrow(search, "a long, b long")


def groups(docs: DataFrame, measure: Measure = Measure(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per row of ``docs``: doc_id, n_shingles, component_id."""
    ship(docs.sparkSession)
    rows = input_columns(docs, id=doc_id, body=text).select(F.col("id").cast("long").alias("id"), utf8("body").alias("body"))
    made = written(sets_of(rows, measure), "sets")
    named = made.filter(F.col("id").isNotNull() & (F.col("n") > 0))
    prints = named.groupBy("print").agg(F.min("id").alias("node"))
    copies = named.select("id", "print").join(prints, "print").filter("id <> node")
    copies = written(copies.select(F.col("node").alias("a"), F.col("id").alias("b"), "print"), "copies")
    # a set stands for its copies: it is the one of the smallest id; other sets of a copy's id stay
    # only rows whose id may be that of a copy are moved for this
    bits = bit_filter(copies, "b")
    asked = may_hold(named, "id", bits).join(copies.select(F.col("b").alias("id"), "print"), ["id", "print"], "left_anti")
    columns = ("id", "n", "head")
    sets = written(may_hold(named, "id", bits, holds=False).select(*columns).unionByName(asked.select(*columns)), "heads")
    copies = copies.select("a", "b")
    grams = exploded(sets)
    counted = grams.groupBy("gram").agg(F.count("*").cast("int").alias("cnt"), F.min("id").alias("pivot")).filter("cnt > 1")
    counted = written(counted, "grams")
    grams = exploded(sets, own_bits(counted, "gram"))
    shared = written(grams.join(counted, "gram"), "shared")

    # each set with the pivot it shares most with
    star = shared.filter("id <> pivot").groupBy("id", "pivot", "n").agg(F.count("*").alias("c"))
    star = star.groupBy("id", "n").agg(F.max(F.struct("c", (-F.col("pivot")).alias("p"))).alias("best"))
    star = star.filter("best.c >= 1 + n div 20")
    star = written(star.select((-F.col("best.p")).alias("a"), F.col("id").alias("b")).distinct(), "star")
    first = written(verified(rows, star, measure, among=True), "links")
    group_of = written(components(first), "first-groups")

    # what is left between groups
    left = between(shared, group_of)
    hot = written(left.groupBy("id").agg(F.count_if(F.col("cnt") > FREQUENT).cast("int").alias("hot")), "hot")
    cold = left.filter(F.col("cnt") <= FREQUENT)
    # both sides are named anew, so that they are one exchange
    one, other = (
        cold.select("gram", F.col("id").alias(x), F.col("n").alias(y), F.col("component").alias(z))
        for x, y, z in (("a", "n", "ca"), ("b", "n2", "cb"))
    )
    alike = f"least(n, n2) * {measure.den} >= greatest(n, n2) * {measure.num}"
    pairs = one.join(other, "gram").filter(f"a < b and ca <> cb and {alike}")
    pairs = pairs.groupBy("a", "b", "n", "n2").agg(F.count("*").alias("c"))
    hot_a = hot.select(F.col("id").alias("a"), F.col("hot").alias("ha"))
    hot_b = hot.select(F.col("id").alias("b"), F.col("hot").alias("hb"))
    pairs = pairs.join(hot_a, "a").join(hot_b, "b").filter(f"c + least(ha, hb) >= {measure.shared_heads()}").select("a", "b")
    second = written(verified(rows, written(pairs, "pairs"), measure), "links")
    third = written(frequent_links(rows, left, measure), "links")

    # rows of one id with different sets are one document
    links = first.unionByName(second).unionByName(third).unionByName(copies)
    final = components(links)
    return made.join(final, "id", "left").select(
        F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")
    )


def keep_one(docs: DataFrame, measure: Measure = Measure(words=5, num=80), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with one document of each group: the one of the smallest id.

    Of rows that repeat an id the one of the smallest text stays. Rows are moved only if their id may be one to drop or
    one that repeats.
    """
    names = docs.columns
    found = written(groups(docs, measure, doc_id, text), "groups").filter(F.col("doc_id").isNotNull())
    roles = found.groupBy(F.col("doc_id").alias("key")).agg(F.min("component_id").alias("c"), F.count("*").alias("rows"))
    boxed = docs.select(docs[f"`{doc_id}`"].cast("long").alias("key"), F.struct(*(docs[f"`{n}`"] for n in names)).alias("row"))
    gone = written(roles.filter("c <> key").select("key"), "gone")
    stay, asked = parted(boxed, "key", gone)
    kept = stay.unionByName(asked.join(gone, "key", "left_anti"))
    twice = roles.filter("c = key and rows > 1").select("key")
    if not twice.isEmpty():
        once, asked = parted(kept, "key", twice)
        first = Window.partitionBy("key").orderBy(F.col("row").getField(text).asc_nulls_first())
        again = asked.join(twice, "key", "left_semi").withColumn("place", F.row_number().over(first)).filter("place = 1")
        kept = once.unionByName(asked.join(twice, "key", "left_anti")).unionByName(again.drop("place"))
    return kept.select(*(F.col("row").getField(n).alias(n) for n in names))


def op3(spark, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "documents"))
