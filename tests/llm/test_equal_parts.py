"""Sets that share only frequent n-grams: found by equal parts, so that few are compared in blocks."""

from __future__ import annotations

import random

import pytest

from basketry.llm import common, ngram_join


def brute_links(texts: dict[int, str], component: dict[int, int], words: int, num: int) -> set[tuple[int, int]]:
    def grams(text):
        split = text.split()
        n = min(words, len(split))
        return {tuple(split[i : i + n]) for i in range(len(split) - n + 1)} if n else set()

    sets = {k: grams(text) for k, text in texts.items()}
    return {
        (a, b)
        for a in sets
        for b in sets
        if a < b and component[a] != component[b] and sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])
    }


@pytest.mark.parametrize("part_sets", [1, 3, 16])
def test_equal_parts_lose_no_similar_pair(spark, monkeypatch, part_sets):
    """Each pair to find is named, or left open with both of its sets."""
    monkeypatch.setattr(ngram_join, "PART_SETS", part_sets)
    made = random.Random(part_sets)
    lines = [" ".join(f"l{k}w{j}" for j in range(made.randrange(2, 40))) for k in range(6)]
    texts = {}
    for k in range(90):
        words = " ".join(made.choices(lines, k=made.randrange(1, 4))).split()
        for _ in range(made.randrange(4)):
            words[made.randrange(len(words))] = f"own{made.randrange(400)}"
        texts[k] = " ".join(words)
    texts |= {90: "", 91: "one"}
    component = {k: k if k % 4 else made.choice([0, 4, 8]) for k in texts}
    measure = ngram_join.Measure(words=2, num=80)
    docs = spark.createDataFrame([*texts.items(), (17, "an other text of 17"), (None, "one")], "id long, body string")
    docs = docs.select("id", common.utf8("body").alias("body"))
    left = spark.createDataFrame([*component.items()], "id long, component long")
    pairs, left_open = ngram_join.by_parts(docs, left, measure)
    pairs, left_open = {tuple(row) for row in pairs.collect()}, {row.id for row in left_open.collect()}
    links = brute_links(texts, component, 2, 80)
    assert len(links) > 20
    assert not [link for link in links if link not in pairs and not left_open.issuperset(link)]
    if part_sets == 16:
        assert links & pairs


def test_a_common_line_brings_few_sets_into_blocks(spark, monkeypatch):
    """Texts of their own that share a line of many texts were all compared with each other in blocks."""
    made = random.Random(9)
    line = [f"common{j}" for j in range(24)]
    texts = [" ".join([*line, *(f"x{made.randrange(10**6)}" for _ in range(made.randrange(20, 30)))]) for _ in range(150)]
    texts += [f"{text} more" for text in texts[:5]]
    seen, plainly = {}, ngram_join.written

    def counted(df, label):
        out = plainly(df, label)
        seen[label] = seen.get(label, 0) + out.count()
        return out

    monkeypatch.setattr(ngram_join, "written", counted)
    found = ngram_join.groups(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")).collect()
    assert {row.doc_id: row.component_id for row in found} == {k: k if k < 150 else k - 150 for k in range(155)}
    assert seen["frequent-sets"] > 100
    assert seen["tiles"] < 20
