"""The mix against plain Python, and the mix as texts."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import pytest

from basketry.llm import mixing

DOCS = "doc_id long, text string, source string, size long, target double, _piece long, _row string"


def frame(spark, docs):
    return spark.createDataFrame([(*row, 5, 1.0, 3, "x") for row in docs], DOCS)


def count(text) -> int:
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes: dict, weights, most: int) -> dict:
    """Share out, stop those that are above, share the rest again."""
    names = sorted(sizes, key=lambda name: (name is None, (name or "").encode()))
    weight = {name: weights[k % len(weights)] for k, name in enumerate(names)}
    total, targets, open_ = sum(sizes.values()), {}, list(names)
    while True:
        left = total - sum(targets.values())
        share = {name: left * weight[name] / sum(weight[n] for n in open_) for name in open_}
        above = [name for name in open_ if share[name] > most * sizes[name]]
        if not above:
            return targets | share
        targets |= {name: most * sizes[name] for name in above}
        open_ = [name for name in open_ if name not in above]


def brute(docs, weights=mixing.WEIGHTS, most=mixing.MOST_EPOCHS):
    sizes = Counter()
    for _, text, source in docs:
        sizes[source] += count(text)
    targets = brute_targets(sizes, weights, most)

    def key(doc_id):
        return hashlib.md5(("mix" if doc_id is None else f"mix:{doc_id}").encode()).hexdigest()[:15]

    rows = sorted((key(d), d if d is not None else -1, count(text), str(source), d, source) for d, text, source in docs)
    before, out = Counter(), []
    for _, _, size, _, doc_id, source in rows:
        whole = sizes[source]
        epochs, rest = divmod(math.floor(targets[source] + 1e-9), whole) if whole else (0, 0)
        taken = epochs * size + max(0, min(rest - before[source], size))
        before[source] += size
        out.append((doc_id, size, whole, round(targets[source], 6), taken))
    return sorted(out, key=str), targets


def run(spark, docs, **options):
    rows = mixing.mix(frame(spark, docs), **options).collect()
    return sorted(((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in rows), key=str)


def corpus(seed: int, sources, count_: int):
    made = random.Random(seed)
    bodies = [None, "", "one", " two\twords ", "é ß\nx", "w " * 30, "long " * 700]
    return [(k, made.choice(bodies), made.choice(sources)) for k in range(count_)]


@pytest.fixture()
def in_pieces(spark):
    """Small tables stay in several partitions, so that sources lie across them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("sources", [["a"], ["a", "a", "a", "b"], ["b", "B", "", None, "ä", "a", "a", "a", "a", "a"]])
def test_mix_equals_plain_python(spark, in_pieces, sources):
    docs = corpus(len(sources), sources, 200)
    docs += [(7, "again and again", sources[0]), (7, "again and again", sources[0]), (7, "again", sources[0]), (None, "x y", sources[-1])]
    wanted, targets = brute(docs)
    got = run(spark, docs)
    assert got == wanted
    # every budget is met to the word
    assert sum(row[4] for row in got) == sum(math.floor(target + 1e-9) for target in targets.values())


def test_small_sources_stop_at_three_epochs(spark):
    docs = [(1, "a b c d", "a"), (2, "w " * 1000, "b"), (3, "w " * 50, "c"), (4, None, "d"), (None, "", None)]
    got = run(spark, docs)
    assert got == brute(docs)[0]
    assert (1, 4, 4, 12.0, 12) in got and (3, 50, 50, 150.0, 150) in got
    assert (4, 0, 0, 0.0, 0) in got and (None, 0, 0, 0.0, 0) in got


def test_one_document_may_be_cut(spark):
    docs = [(k, "one  two\tthree four five", "a" if k < 5 else "b") for k in range(10)]
    mixed = mixing.mix(frame(spark, docs), carry=["text"])
    assert mixed.filter("last_words BETWEEN 1 AND 4").count() <= 2
    rows = mixing.copies(mixed).collect()
    words = Counter()
    for row in rows:
        assert "one  two\tthree four five".startswith(row.text)
        words[row.doc_id, row.epoch] += count(row.text)
    taken = Counter()
    for (doc_id, _), number in words.items():
        taken[doc_id] += number
    assert taken == {row.doc_id: row.taken for row in mixed.collect() if row.taken}


def test_mix_of_nothing_and_of_no_words(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, "  ", "a"), (1, None, None)]) == [(1, 0, 0, 0.0, 0), (1, 0, 0, 0.0, 0)]


def test_order_is_by_hash_and_repeats(spark):
    docs = [(k, "w " * (k % 7), "ab"[k % 2]) for k in range(100)]
    assert run(spark, docs) == run(spark, docs[::-1])
    assert run(spark, docs, seed="other") != run(spark, docs)
