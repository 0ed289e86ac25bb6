"""Inputs that used to stop or to be cut in silence."""

from __future__ import annotations

import pytest

from basketry.llm import url_trust
from basketry.llm.components import components


def test_components_that_do_not_settle_are_an_error(spark):
    chain = spark.range(40).selectExpr("id AS a", "id + 1 AS b")
    with pytest.raises(RuntimeError, match="still change"):
        components(chain, most_rounds=1)
    assert {row.component for row in components(chain).collect()} == {0}


def test_links_without_any_seed_allow_every_page(spark):
    rows = [(1, "https://one.io/a", '<a href="https://two.io/">x</a>'), (2, "https://two.io/b", '<a href="https://one.io/">y</a>')]
    found = url_trust.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {(row.page_id, row.rule, row.verdict, row.host_trust) for row in found} == {(1, None, "allow", 0.0), (2, None, "allow", 0.0)}
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert url_trust.judge(empty).count() == 0
