"""The audit of filters against counting in plain Python, and the diagram by itself."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import permutations

import pytest

from basketry.llm import filter_audit
from basketry.llm.filter_audit import Diagram, plain_changes, report

DOCS = "doc_id long, text string, lang string, source string, part string, mask int, n long, digest string"
LABELS = "doc_id long, quality int, toxic int, part string"


def failed_letters(doc_id, text, smallest) -> str:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return "".join(
        letter
        for letter, fails in {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": re.search(r"[#$%&*|]", text) is not None,
            "E": doc_id is not None and doc_id > smallest[text],
        }.items()
        if fails
    )


def brute(docs, labels):
    good = {doc_id for doc_id, quality, _ in labels if quality == 1 and doc_id is not None}
    toxic = {doc_id for doc_id, _, bad in labels if bad == 1 and doc_id is not None}
    smallest = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            smallest[text or ""] = min(doc_id, smallest.get(text or "", doc_id))
    parts = {}
    for doc_id, text, source in docs:
        parts.setdefault(source or "", []).append((doc_id, failed_letters(doc_id, text or "", smallest)))
    out = []
    for part, rows in parts.items():
        found, shapley = [], Counter()
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for step, letter in enumerate(order, 1):
                gone = [row for row in left if letter in row[1]]
                left = [row for row in left if letter not in row[1]]
                failing = [row for row in rows if letter in row[1]]
                shapley[letter] += len(gone)
                found.append(
                    (part, order, step, len(left), len(gone), len(failing) - len(gone), sum(f == letter for _, f in rows),
                     sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone), letter)
                )
        out += [(*row[:-1], shapley[row[-1]]) for row in found]
    return sorted(out)


def run(spark, docs, labels):
    rows = [(doc_id, text, "en", source, "clash", 7, 9, "x") for doc_id, text, source in docs]
    known = [(*row, "clash") for row in labels]
    counts = filter_audit.failure_counts(spark.createDataFrame(rows, DOCS), spark.createDataFrame(known, LABELS))
    return sorted(tuple(row) for row in filter_audit.audit(counts, "ABCDE").collect())


def test_audit_equals_counting(spark):
    made = random.Random(5)
    long = " ".join(f"w{k}" for k in range(250))
    bodies = [
        long, long + " #", "same " * 300, "LOUD " * 220 + long, "a b", "", None, "   ", long.upper() + " 50% off", "é " * 199,
        " ".join(f"w{k}" for k in range(200)), "word " * 40_000,
    ]
    docs = [(k, made.choice(bodies), made.choice(["s1", "s2", "s1", None, "", "Ä"])) for k in range(120)]
    docs += [(None, long, "s1"), (None, long, "s1"), (3, "twice", "s2"), (3, "twice", "s1"), (3, "twice", "s1"), (-4, long, "s2")]
    labels = [(k, made.choice([0, 1, None]), made.choice([0, 1, None])) for k in range(0, 120, 2)]
    labels += [(3, 1, 0), (3, 0, 1), (None, 1, 1), (4, 1, 1)]
    assert run(spark, docs, labels) == brute(docs, labels)


def test_audit_of_nothing(spark):
    assert run(spark, [], []) == []
    alone = run(spark, [(1, None, None)], [])
    assert len(alone) == 600 and {row[0] for row in alone} == {""}
    # an empty text fails A only
    assert {(row[4], row[6]) for row in alone if row[1][row[2] - 1] == "A"} == {(1, 1)}


@pytest.mark.parametrize("n", range(1, 6))
def test_plain_changes_lead_through_all_orders(n):
    order, seen = list(range(n)), {tuple(range(n))}
    for at in plain_changes(n):
        order[at], order[at + 1] = order[at + 1], order[at]
        assert tuple(order) not in seen
        seen.add(tuple(order))
    assert len(seen) == len(list(permutations(range(n))))


def test_diagram_keeps_its_weights_under_swaps():
    made = random.Random(2)
    counts = {mask: (made.randrange(4), made.randrange(2), 0) for mask in range(32) if mask % 3}
    diagram = Diagram("ABCDE", counts)
    for _ in range(200):
        diagram.swap(made.randrange(4))
        left = dict(counts)
        for filter_, kept, removed in diagram.steps():
            gone = [weight for mask, weight in left.items() if mask >> filter_ & 1]
            left = {mask: weight for mask, weight in left.items() if not mask >> filter_ & 1}
            assert removed == tuple(map(sum, zip((0, 0, 0), *gone, strict=True)))
            assert kept == tuple(map(sum, zip((0, 0, 0), *left.values(), strict=True)))


def test_equal_subdiagrams_are_one_node():
    same = Diagram("ABCDE", dict.fromkeys(range(32), (1, 0, 0)))
    assert len(same) == 5
    same.swap(2)
    assert len(same) == 5
    assert len(Diagram("ABCDE", {0: (7, 0, 0)})) == 5
    assert len(Diagram("ABCDE", {k: (k + 1, 0, 0) for k in range(32)})) == 31
    assert len(Diagram("ABCDE", {})) == 0


def test_steps_of_no_rows_are_zeros():
    assert all(set(row[2:]) == {0} for row in report("AB", {0: (0, 0, 0)}))
    assert len(list(report("ABC", {}))) == 18


def test_too_many_filters_are_refused(spark):
    counts = spark.createDataFrame([], "part string, mask int, n long, good long, toxic long")
    with pytest.raises(ValueError, match="orders"):
        filter_audit.audit(counts, "ABCDEFGHI")
