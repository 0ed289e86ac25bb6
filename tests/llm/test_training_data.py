"""Small tests of each operator against brute force, round trips and defined results."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from basketry.llm import decontaminate, languages, licenses, main_text, ngram_join, sentencepieces, token_files, top_k, toxicity, url_trust
from basketry.llm.elias_fano import EliasFano

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, body string, _row int"


def texts(seed: int, count: int, length: int = 40) -> list[str]:
    made = random.Random(seed)
    out = []
    for k in range(count):
        if k % 3 and out:
            words = made.choice(out).split()
            for _ in range(made.randrange(3)):
                words[made.randrange(len(words))] = made.choice(WORDS)
        else:
            words = [made.choice(WORDS) + str(made.randrange(3)) for _ in range(made.randrange(5, length))]
        out.append(" ".join(words))
    return out


def frame(spark, bodies):
    """Documents with extra columns whose names clash with the operators' own."""
    rows = [(k, text, "en", "src0", len(text or ""), "x", "y", 1) for k, text in enumerate(bodies)]
    return spark.createDataFrame(rows, DOCS)


EDGES = [None, "", "   ", "one", "One\tONE", "é" * 3, "word " * 30_000, "same text here and there", "same text here and there"]


def test_elias_fano_selects():
    made = random.Random(1)
    for count in (0, 1, 2, 255, 256, 257, 3000):
        for top in (1, 50, 2**40):
            values = np.sort(np.array([made.randrange(top) - top // 3 for _ in range(count)], np.int64))
            read, _ = EliasFano.from_bytes(EliasFano.encode(values).to_bytes())
            assert (read.slice(0, count) == values).all()
            assert all(read.select(i) == values[i] for i in range(0, count, 97))


def test_token_files_match_the_tokenizer(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    odd = ["a<|endoftext|>b <|ENDOFTEXT|> x.", "it's DON'T, ½, İ. ΣΑΣ. ß, 3.", "x̸= a….", " \x85a\x1cb"]
    bodies = [*EDGES, *odd, *texts(3, 30)]
    coder = Tokenizer.from_file(path)
    start, wanted = 0, []
    for k, text in enumerate(bodies):
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, 2]
        wanted.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = token_files.token_files(frame(spark, bodies).repartition(3), path, shards=4)
    assert sorted(map(tuple, got.collect())) == wanted
    assert token_files.token_files(frame(spark, []), path).count() == 0


def test_pieces_come_back_and_are_the_best_path(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepieces.unigram(path)
    bodies = [*EDGES, "▁ x▁y \n\n z", "你好 мир 🙂", *texts(4, 10)]
    got = {row.doc_id: row for row in sentencepieces.encode(frame(spark, bodies), path).collect()}
    assert all(row.round_trip for row in got.values()) and not got[0].ids and not got[1].ids
    back = sentencepieces.decode(sentencepieces.encode(frame(spark, bodies), path), path)
    assert {row.doc_id: row.text for row in back.collect()} == {k: text or "" for k, text in enumerate(bodies)}
    keys = {piece: n for n, piece in enumerate(model.bytes_of) if piece and n not in set(model.byte_ids)}

    def best(part):
        score = [0.0] + [-np.inf] * len(part)
        for end in range(1, len(part) + 1):
            for at in range(max(0, end - model.longest), end):
                if part[at:end] in keys:
                    score[end] = max(score[end], score[at] + model.scores[keys[part[at:end]]])
        return score[-1]

    for word in (b" gamma", b" omicron0", b" thereabouts", b"x" * 70):
        assert sum(model.scores[i] for i in model._one(word)) == pytest.approx(best(word))
        assert model._many([word])[0] == model._one(word)


def windows(words, size=10):
    n = min(size, len(words))
    return [tuple(words[i : i + n]) for i in range(len(words) - n + 1)] if n else []


@pytest.mark.parametrize("shard_words", [30, 1_000_000])
def test_contamination_against_brute_force(spark, shard_words):
    items = [*texts(5, 8, 25), "short item", "", None, "short item"]
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(items)], "item_id long, text string")
    docs = [*EDGES, *(f"{a} {b}" for a, b in zip(texts(6, 12), items[:8] + ["a short item b", "x", "y", "z"], strict=True))]
    found = decontaminate.contamination(frame(spark, docs), bench, shard_words=shard_words).collect()
    of = [set(windows(decontaminate.words_of((t or "").encode()))) for t in items]
    for row in found:
        words = decontaminate.words_of((docs[row.doc_id] or "").encode())
        hit, ids = set(), set()
        for k, wins in enumerate(of):
            for win in wins:
                for at in range(len(words) - len(win) + 1):
                    if tuple(words[at : at + len(win)]) == win:
                        hit.update(range(at, at + len(win)))
                        ids.add(str(k))
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        assert (row.n_words, row.n_hit, row.n_items, row.items_sha256) == (len(words), len(hit), len(ids), digest)
    clean = decontaminate.remove_contaminated(frame(spark, docs), bench)
    assert clean.columns == frame(spark, []).columns
    assert clean.count() == sum(not row.contaminated for row in found)


@pytest.mark.parametrize("frequent", [2, 64])
def test_jaccard_groups_against_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    bodies = [*EDGES, *texts(7, 60)]
    measure = ngram_join.Measure(words=2, num=70)
    sets = []
    for text in bodies:
        words = (text or "").lower().split()
        n = min(2, len(words))
        sets.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set())
    group = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 70 * len(sets[a] | sets[b]):
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = [new if x == old else x for x in group]
    found = sorted(map(tuple, ngram_join.groups(frame(spark, bodies), measure).collect()))
    assert found == [(k, len(s), g) for k, (s, g) in enumerate(zip(sets, group, strict=True))]
    kept = ngram_join.keep_one(frame(spark, bodies), measure)
    assert sorted(row.doc_id for row in kept.collect()) == sorted(set(group))


@pytest.mark.parametrize("measure", [ngram_join.Measure(), ngram_join.Measure(words=2, num=50)])
def test_walks_of_the_prefix_tree_against_brute_force(measure):
    made = random.Random(5)
    for _ in range(60):
        base = [{made.randrange(60) for _ in range(made.randrange(40))} for _ in range(3)]
        sets = []
        for _ in range(made.randrange(40)):
            one = set(made.choice(base)) | {made.randrange(90) for _ in range(made.randrange(4))}
            if one and made.random() < 0.5:
                one.discard(made.choice(sorted(one)))
            sets.append(one)
        tree = ngram_join.PrefixTree([np.array(sorted(one), np.uint64) for one in sets])
        for probe in [*sets[:8], *base, set()]:
            wanted = np.array([made.random() < 0.7 for _ in sets], bool)
            alike = [bool(probe & x) and measure.den * len(probe & x) >= measure.num * len(probe | x) for x in sets]
            asked = np.array(sorted(probe), np.uint64)
            assert sorted(tree.search(asked, measure)) == [i for i, like in enumerate(alike) if like]
            assert sorted(tree.search(asked, measure, wanted)) == [i for i, like in enumerate(alike) if like and wanted[i]]


def test_near_copies_share_the_nodes_of_a_prefix_tree():
    made = np.random.default_rng(2)
    whole = np.unique(made.integers(0, 2**63, 500).astype(np.uint64))
    copies = [np.unique(np.append(np.delete(whole, made.integers(0, 400, 3)), np.uint64(k))) for k in range(50)]
    tree = ngram_join.PrefixTree(copies)
    assert tree.given > 24_000 and tree.stored < tree.given / 5


def test_best_path_of_languages():
    made = np.random.default_rng(1)
    sizes = made.integers(0, 6, 8)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    scores = 3 * made.normal(size=(starts[-1], 3)).astype(np.float32)
    label = languages.best_paths(scores, starts, 2.0)
    import itertools

    for a, b in zip(starts[:-1], starts[1:], strict=True):
        def value(path, a=a):
            return sum(scores[a + t, k] for t, k in enumerate(path)) - 2.0 * sum(x != y for x, y in itertools.pairwise(path))

        best = max(map(value, itertools.product(range(3), repeat=b - a)))
        assert value(label[a:b].tolist()) == pytest.approx(best)


def test_languages_of_mixed_text(spark):
    rows = [(k, "the house and the water of this place" if k % 2 else "das haus und das wasser der stadt", "en" if k % 2 else "de") for k in range(60)]
    model = languages.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    bodies = [None, "", "123 !?", "the water and this house", "das wasser und " * 9 + " the house and the water of this " * 3]
    found = {row.doc_id: row for row in languages.identify(frame(spark, bodies), model).collect()}
    assert [found[k].lang_pred for k in range(5)] == ["und", "und", "und", "en", "de"]
    assert [span.lang for span in found[4].spans] == ["de", "en"]
    assert languages.keep_identified(frame(spark, bodies), model).count() == 2
    assert {r.lang_pred for r in languages.identify(frame(spark, bodies), None).collect()} == {"und"}


def test_toxicity_learns_and_handles_edges(spark):
    made = random.Random(3)
    rows, marks = [], []
    for k in range(400):
        toxic = k % 4 == 0
        words = [made.choice(WORDS) for _ in range(20)] + (["idiot", "stupid"] if toxic else [])
        made.shuffle(words)
        rows.append((k, " ".join(words)))
        marks.append((k, int(toxic)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    found = {row.doc_id: row for row in toxicity.score_texts(docs, model).collect()}
    assert sum(found[k].predicted == toxic for k, toxic in marks) >= 396
    edges = toxicity.score_texts(frame(spark, EDGES), model).collect()
    assert len(edges) == len(EDGES) and all(0 <= row.score <= 1 for row in edges)
    assert toxicity.keep_clean(frame(spark, EDGES), model).columns == frame(spark, []).columns
    none = toxicity.train(docs, labels.filter("toxic > 1"))
    assert {row.score for row in toxicity.score_texts(docs, none).collect()} == {0.0}


def test_main_text():
    page = '<body><nav>Menu</nav><article><h1>T</h1><p>a &lt;b&gt; &amp c<p>d\n e<section class="comments"><p>no</p></section><aside>x</aside></article><footer>f'
    assert main_text.main_text(page) == "T\na <b> & c\nd e"
    soup = '<div id="menu"><a>Home</a></div><div class="post"><p>Long text, with words. And more.</p><p>Short.</p></div><div class="ad">Buy, now.</div>'
    assert main_text.main_text(soup) == "Long text, with words. And more.\nShort."
    assert [main_text.main_text(x) for x in (None, "", "<p a=\"", "<script>x")] == [""] * 4


def test_top_k_against_brute_force(spark):
    made = np.random.default_rng(5)
    rows = [(k, v.tolist()) for k, v in enumerate(np.round(made.normal(size=(300, 4)), 1).astype(float))]
    rows += [(300 + k, rows[7][1]) for k in range(20)] + [(400, None), (401, [1.0, None, 0.0, 0.0]), (402, [float("nan")] * 4), (403, []), (7, rows[7][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    from pyspark.sql import functions as F

    got = top_k.top_k(df, F.col("vec_id") % 50 == 0, vector_block=64, query_block=3)
    whole = {k: np.floor(256 * np.array(v)) for k, v in rows if v and None not in v and np.isfinite(v).all()}
    wanted = set()
    for q in (k for k in whole if k % 50 == 0):
        best = sorted((-int(whole[q] @ v), k) for k, v in whole.items() if k != q)[:5]
        wanted |= {(q, rank, k, -score) for rank, (score, k) in enumerate(best, 1)}
    assert set(map(tuple, got.collect())) == wanted


def test_url_rules_and_spread(spark):
    link = '<a href="http://bad.net/x">'
    rows = [
        (1, "HTTP://A.Example.ORG/es/1?x", ""), (2, "http://x.example.org/en/12", None), (3, "http://org", ""), (4, None, ""), (5, "no url", ""),
        (6, "https://b.com/fr/1#t", ""), (7, "http://bad.com/de/", ""), (8, "http://near.net/", '<a class=x HREF="//bad.com/de/">'), (9, "http://far.net/", '<a href="https://near.net/">'),
        (10, "http://b.com.evil/fr/", link), (11, "http://myorg/", ""),
    ]
    found = {row.page_id: row for row in url_trust.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [found[k].rule for k in range(1, 8)] == ["example.org/es/", "example.org/en/1", None, None, None, "com/fr/", "com/de/"]
    assert [found[k].verdict for k in range(1, 12)] == "block block allow allow allow allow block block block allow allow".split()
    assert (found[1].host, found[1].path, found[4].host, found[5].path) == ("a.example.org", "/es/1", "", "")


def test_licences_are_found_and_inherited(spark):
    from pyspark.sql import functions as F

    rows = [
        (1, "Released under the MIT License.", "a/LICENSE"), (2, "plain words", "a/b/c.txt"),
        (3, "# Licensed under the Apache License, Version 2.0.\n" + "code words " * 50, "a/b/d.txt"), (4, None, "e/f.txt"), (5, "", None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, path string")
    found = {row.doc_id: (row.license, row.found_in) for row in licenses.scan(docs, F.col("path")).collect()}
    assert found == {1: ("MIT", "file"), 2: ("MIT", "directory"), 3: ("Apache-2.0", "header"), 4: (None, None), 5: (None, None)}


def test_whole_licence_texts_and_standard_headers(spark):
    from pyspark.sql import functions as F

    mit = """Copyright (c) 2020 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
    gpl = """# This program is free software: you can redistribute it
# and/or modify it under the terms of the GNU General
# Public License as published by the Free Software
# Foundation, either version 3 of the License, or (at your
# option) any later version.
#
# This program is distributed in the hope that it will be
# useful, but WITHOUT ANY WARRANTY; without even the implied
# warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR
# PURPOSE.  See the GNU General Public License for more
# details."""
    apache = """/* Copyright 2021 Acme
 * Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
 * with the License. You may obtain a copy of the License at
 *
 *     http://www.apache.org/licenses/LICENSE-2.0
 *
 * Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
 * an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. */"""
    bsd = "All rights reserved.\n" + licenses.TEXTS["BSD-3-Clause"].partition("All rights reserved.")[2]
    code = "\n".join(f"value{k} = compute(other{k}, {k})" for k in range(80))
    rows = [
        (1, mit, "a/LICENSE"), (2, "plain words", "a/b/c.txt"), (3, f"import os\n{gpl}\n{code}", "a/b/d.py"),
        (4, f"{apache}\n{code}", "e/f.c"), (5, f"{code}\n{mit}", "e/g.py"), (6, f"{bsd}\n{code}", "e/h.py"), (7, code, "e/i.py"),
        *((10 + k, licenses.TEXTS[name], f"{name}/COPYING") for k, name in enumerate(("AGPL-3.0", "Apache-2.0", "GPL-2.0", "GPL-3.0", "MPL-2.0"))),
        (20, code, "GPL-2.0/src/main.c"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, path string")
    found = {row.doc_id: (row.license, row.found_in) for row in licenses.scan(docs, F.col("path")).collect()}
    assert found == {
        1: ("MIT", "file"), 2: ("MIT", "directory"), 3: ("GPL-3.0", "header"), 4: ("Apache-2.0", "header"), 5: ("MIT", "header"),
        6: ("BSD-3-Clause", "header"), 7: (None, None), 10: ("AGPL-3.0", "file"), 11: ("Apache-2.0", "file"), 12: ("GPL-2.0", "file"),
        13: ("GPL-3.0", "file"), 14: ("MPL-2.0", "file"), 20: ("GPL-2.0", "directory"),
    }


def test_main_text_is_chosen_by_ratios_of_the_whole_page():
    long = "The river, which rises in the hills, runs for many miles; then it turns west. Its banks are low, and floods are common there."
    body = "\n".join([long, "Kinds", "red", "blue", long, long])
    post = f'<div class="post"><p>{long}</p><h2>Kinds</h2><ul><li>red</li><li>blue</li></ul><p>{long}<p>{long}</div>'
    teasers = "".join(f'<article class="card"><h3><a href="/{k}">Story {k}</a></h3><p>Some words on it</p></article>' for k in range(6))
    assert main_text.main_text(f"<body>{post}{teasers}</body>") == body
    assert main_text.main_text(f"<body>{teasers}{post}</body>") == body
    links = "".join(f'<li><a href="/{k}">More of this {k}</a></li>' for k in range(5))
    unnamed = f'<div class="x7"><div>Tags</div><ul>{links}</ul></div>'
    for article in (f"<p>{long}{unnamed}<p>{long}", f"{unnamed}<p>{long}<p>{long}", f"<p>{long}<p>{long}<ul>{links}</ul>{unnamed}"):
        assert main_text.main_text(f"<body><article>{article}</article></body>") == f"{long}\n{long}"


def test_top_k_stops_by_its_bound():
    made = np.random.default_rng(6)
    vectors = made.integers(-20, 20, (600, 64))
    vectors[5:25] = 200 + made.integers(0, 9, (20, 64))
    ids = made.permutation(600)
    lists = top_k.SortedLists(ids, vectors)
    queries = np.vstack([made.integers(1, 9, (4, 64)), np.zeros((1, 64), int), made.integers(-9, 9, (3, 64))])
    for query, own, (got, scores) in zip(queries, ids, lists.top(queries, ids[: len(queries)], 5), strict=False):
        wanted = sorted((-int(query @ v), int(k)) for k, v in zip(ids, vectors, strict=True) if k != own)[:5]
        assert [(-int(s), int(k)) for k, s in zip(got, scores, strict=True)] == wanted
    assert 4 <= lists.stopped < len(queries)


@pytest.mark.parametrize("frequent", [2, 64])
def test_copies_of_repeated_ids_keep_their_other_texts(spark, monkeypatch, frequent):
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    near = " ".join(f"w{k}" for k in range(30))
    rows = [(1, "a b c d e f"), (5, "a b c d e f"), (5, near), (9, near + " w30"), (12, "x y z")]
    found = ngram_join.groups(spark.createDataFrame(rows, "doc_id long, text string"), ngram_join.Measure(words=2, num=70)).collect()
    assert sorted((row.doc_id, row.component_id) for row in found) == [(1, 1), (5, 1), (5, 1), (9, 1), (12, 12)]


def test_trust_settles_or_says_so(spark):
    assert 4 * url_trust.DAMPING ** url_trust.most_rounds(url_trust.DAMPING, url_trust.TOLERANCE) < url_trust.TOLERANCE
    rows = [(1, "http://bad.com/de/", ""), (2, "http://near.net/", '<a href="//bad.com/de/">'), (3, "http://far.net/", '<a href="//near.net/">')]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    with pytest.raises(RuntimeError, match="still changes"):
        url_trust.judge(pages, rounds=2)
