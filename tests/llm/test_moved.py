"""What is moved between tasks and what workers hold: bounded and small, with the same results."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers

from basketry.llm import common, ngram_join, sentencepieces


def test_join_moves_texts_smaller_than_their_sets(spark):
    """The sets of texts are what is compared; what is shuffled for it is at most half of them."""
    random_ = random.Random(3)
    words = ["".join(random_.choices("abcdefghijklmnopqrstuvwxyz", k=random_.randrange(2, 9))) for _ in range(2000)]
    texts = [" ".join(random_.choices(words, k=400)) for _ in range(20)] + ["", "One", "one  ONE\tone", "ä ö ü \u0000 x"]
    docs = spark.createDataFrame([*enumerate(texts), (99, None)], "id long, body string")
    docs = docs.select("id", common.utf8("body").alias("body"))
    measure = ngram_join.Measure()
    moved = ngram_join.packed_texts(docs, docs).toArrow()
    sets = dict(zip(moved["id"].to_pylist(), ngram_join.sets_in(moved["packed"], measure), strict=True))
    assert len(sets) == len(texts) + 1 and not len(sets[99]) and not len(sets[20])
    for row in ngram_join.sets_of(docs, measure).collect():
        assert row.n == len(sets[row.id])
        assert sets[row.id][: measure.head(row.n)].tobytes() == row.head
    assert 2 * sum(map(len, moved["packed"].to_pylist())) < 8 * sum(map(len, sets.values()))


def test_encoder_forgets_at_the_end_of_a_task():
    """A worker that waits holds the trie, not the parts it has met; ids are the same after it."""
    common.let_go()
    model = sentencepieces.unigram(public_tokenizers.path("piece_bpe_32k.model"))
    texts = [f"Some words {k} and more".encode() for k in range(50)]
    first = model.encode(texts)
    assert model.known
    common.rest()
    assert not model.known
    assert sentencepieces.unigram(public_tokenizers.path("piece_bpe_32k.model")) is model
    assert all(np.array_equal(a, b) for a, b in zip(first, model.encode(texts), strict=True))
    common.let_go()


def test_keep_one_moves_only_rows_that_may_be_dropped(spark):
    """A row whose id is surely none to drop reaches the result without a join, so without a shuffle of its text."""
    texts = [" ".join(f"w{k}x{j}" for j in range(12)) for k in range(40)]
    rows = [*enumerate(texts), *((100 + k, texts[k]) for k in range(5)), (None, texts[0]), (7, "a text of its own"), (60, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = ngram_join.keep_one(docs)
    found = sorted(map(tuple, kept.collect()), key=str)
    assert found == sorted([*((k, t) for k, t in enumerate(texts) if k != 7), (None, texts[0]), (7, "a text of its own"), (60, None)], key=str)

    once = ngram_join.keep_one(docs.filter("doc_id <> 7"))
    node = once._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Union" and node.children().size():
        node = node.children().apply(0)
    assert node.nodeName() == "Union"
    assert [" Join " in node.children().apply(i).toString().replace("\n", " ") for i in range(2)] == [False, True]

    gone = spark.createDataFrame([(100,), (101,)], "doc_id long")
    stay, asked = ngram_join.parted(docs, "doc_id", gone)
    assert stay.count() + asked.count() == len(rows)
    assert {100, 101} <= {row.doc_id for row in asked.collect()} and asked.count() < 5
