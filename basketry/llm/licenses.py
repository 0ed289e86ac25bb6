"""Licence scans: TF-IDF cosine of headers and licence files to templates, inherited along directories.

The words of all templates are the vocabulary; their document frequencies are counted over all texts and templates.
Templates are short statements, the standard headers and the whole texts of licences. A segment's vector holds its
words' counts times their inverse document frequencies, words outside the vocabulary included at the weight of a word
in no text; its cosine to each template is taken sparsely, over the words they share.

A licence file is a text that is as a whole close to a template; its licence is the closest one. In other texts a header
is a run of adjacent lines around one that mentions a licence (``MARKERS``): the run grows down and then up while its
cosine to a template can still rise, over at most ``PATIENCE`` words without a rise and up to ``LONGEST`` times the
template's words. Whole texts above ``HEADER_WORDS`` words are templates of licence files only. Of several headers the
one that shares most weight with its template counts, so the terms of BSD precede the ``All rights reserved`` in them.

A text without a header of its own inherits from the nearest ancestor directory that holds a licence file (its own
directory comes first). Directories are made distinct before they are joined with their ancestors, so the join grows
with the directories; of several licence files in one directory the closest counts, then the first by path.

Defined results: null and empty texts have no licence of their own; a null path belongs to no directory and inherits
nothing. Equal cosines go to the template that comes first by name. A licence without a template may go to one whose
text it shares (versions and variants of one family) or to none. Repeated rows are kept; extra columns are left out.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import per_batch, ship, table, texts_of, utf8, written
from basketry.llm.license_texts import HEADERS, TEXTS

HEADER_COSINE = 0.6
FILE_COSINE = 0.7
PATIENCE = 60
LONGEST = 4
HEADER_WORDS = 600
MARKERS = re.compile(rb"licen[cs]e|copyright|spdx|permission is|redistribution and use|public domain|rights reserved")

# Short statements of well-known licences.
STATEMENTS = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted. BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0. This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Released into the public domain under the CC0 1.0 Universal license.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This source code form is subject to the terms of the Mozilla Public License, version 2.0.",
    "Proprietary": "Copyright. All rights reserved.",
}

TEMPLATES = {
    name: tuple(kind[name] for kind in (STATEMENTS, HEADERS, TEXTS) if name in kind) for name in sorted({*STATEMENTS, *HEADERS, *TEXTS})
}

_WORD = re.compile(rb"[a-z0-9]+")


def words_of(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


def bodies_of(templates: Mapping[str, str | Iterable[str]]) -> list[tuple[str, list[bytes]]]:
    """Each template's name and words; a name may have several."""
    return [
        (name, words_of(body.encode()))
        for name in sorted(templates)
        for body in ([templates[name]] if isinstance(templates[name], str) else templates[name])
    ]


class Matcher:
    """Sparse cosine of a segment to each template.

    The templates count among the texts, so that words of every text weigh little however few texts there are.
    """

    def __init__(self, templates: Mapping[str, str | Iterable[str]], frequency: dict[bytes, int], texts: int):
        bodies = bodies_of(templates)
        frequency = Counter(frequency) + Counter(word for _, words in bodies for word in set(words))
        texts += len(bodies)
        self.names = [name for name, _ in bodies]
        self.unseen = float(np.log((1 + texts) / 1.0)) + 1
        self.idf = {word: float(np.log((1 + texts) / (1 + n))) + 1 for word, n in frequency.items()}
        self.rows = {word: row for row, word in enumerate(sorted({word for _, words in bodies for word in words}))}
        #: what one more of a word adds to the product with each template of length 1
        self.parts = np.zeros((len(self.rows), len(bodies)))
        for number, (_, words) in enumerate(bodies):
            weights = {word: n * self._idf(word) for word, n in Counter(words).items()}
            norm = float(np.sqrt(sum(w * w for w in weights.values())))
            for word, weight in weights.items():
                self.parts[self.rows[word], number] = weight * self._idf(word) / norm
        sizes = np.array([len(words) for _, words in bodies])
        self.short = np.flatnonzero(sizes <= HEADER_WORDS)
        self.limits = LONGEST * sizes[self.short]
        self.short_parts = np.ascontiguousarray(self.parts[:, self.short])

    def _idf(self, word: bytes) -> float:
        return self.idf.get(word, self.unseen)

    def best(self, words: list[bytes]) -> tuple[str | None, float]:
        """The template closest to the words as a whole."""
        counts = Counter(words)
        shared = sorted(counts.keys() & self.rows.keys())
        if not shared:
            return None, 0.0
        scores = np.array([counts[word] for word in shared], float) @ self.parts[[self.rows[word] for word in shared]]
        number = int(np.argmax(np.round(scores, 12)))
        return self.names[number], min(1.0, float(scores[number]) / float(np.sqrt(sum((n * self._idf(w)) ** 2 for w, n in counts.items()))))

    def header(self, lines: list[bytes], least: float) -> tuple[str | None, float]:
        """The header that shares most weight with its template, of all runs of lines with a cosine of ``least``."""
        words: dict[int, list[bytes]] = {}
        products: dict[int, np.ndarray] = {}

        def line(at: int) -> list[bytes]:
            if at not in words:
                words[at] = words_of(lines[at])
                known = [self.rows[word] for word in words[at] if word in self.rows]
                products[at] = self.short_parts[known].sum(axis=0)
            return words[at]

        class Run:
            """Counts, squared length and products of a growing run."""

            def __init__(run):
                run.counts, run.squared, run.size, run.product = Counter(), 0.0, 0, np.zeros(len(self.short))

            def add(run, at: int) -> int:
                for word in line(at):
                    n = run.counts[word]
                    run.squared += self._idf(word) ** 2 * (2 * n + 1)
                    run.counts[word] = n + 1
                run.size += len(words[at])
                run.product = run.product + products[at]
                return len(words[at])

            def cosines(run) -> np.ndarray:
                return run.product / np.sqrt(run.squared) if run.squared else run.product

        found: dict[int, tuple[float, float]] = {}
        covered: set[int] = set()
        for seed, text in enumerate(lines):
            if seed in covered or not MARKERS.search(text.lower()):
                continue
            run = Run()
            top, end, waited = np.full(len(self.short), -1.0), np.full(len(self.short), seed), np.zeros(len(self.short), int)
            for at in range(seed, len(lines)):
                added = run.add(at)
                now = run.cosines()
                rises = now > top
                top, end = np.where(rises, now, top), np.where(rises, at, end)
                waited = np.where(rises, 0, waited + added)
                if not ((waited <= PATIENCE) & (run.size <= self.limits)).any():
                    break
            for k in np.flatnonzero(top >= least / 2):
                run = Run()
                for at in range(seed, end[k] + 1):
                    run.add(at)
                start, close, product, still = seed, float(top[k]), float(run.product[k]), 0
                for at in range(seed - 1, -1, -1):
                    still += run.add(at)
                    now = float(run.cosines()[k])
                    if now > close:
                        start, close, product, still = at, now, float(run.product[k]), 0
                    if still > PATIENCE or run.size > self.limits[k]:
                        break
                if close >= least:
                    covered.update(range(start, end[k] + 1))
                    most, closest = found.get(k, (0.0, 0.0))
                    found[k] = (max(most, product), max(closest, close))
        if not found:
            return None, 0.0
        name = self.names[self.short[min(found, key=lambda k: (-round(found[k][0], 12), k))]]
        return name, min(1.0, max(close for k, (_, close) in found.items() if self.names[self.short[k]] == name))


def document_frequencies(texts: DataFrame, vocabulary: frozenset[bytes]) -> tuple[dict[bytes, int], int]:
    """In how many texts each word of the vocabulary stands, and the number of texts. ``texts``: body."""

    def count(batches):
        found: Counter = Counter()
        total = 0
        for batch in batches:
            for text in texts_of(batch.column("body")):
                found.update(vocabulary.intersection(words_of(text)))
                total += 1
        words = sorted(found)
        yield pa.RecordBatch.from_pydict(
            {
                "word": pa.array([*words, None], pa.binary()),
                "n": pa.array([*(found[w] for w in words), total], pa.int64()),
            }
        )

    ship(texts.sparkSession)
    rows = texts.select("body").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {bytes(r.word): r.n for r in rows if r.word is not None}, sum(r.n for r in rows if r.word is None)


def parent_of(path: F.Column) -> F.Column:
    """The directory of a path; the empty text is the root."""
    return F.regexp_extract(path, r"(?s)^(?:(.*)/)?[^/]*$", 1)


def scan(
    docs: DataFrame,
    path: F.Column,
    templates: Mapping[str, str | Iterable[str]] = TEMPLATES,
    doc_id: str = "doc_id",
    text: str = "text",
    header_cosine: float = HEADER_COSINE,
    file_cosine: float = FILE_COSINE,
) -> DataFrame:
    """A row per text: doc_id, path, own_license, cosine, is_license_file, license, found_in (header, file, directory).

    ``path``: an expression over the columns of ``docs``.
    """
    rows = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), path.cast("string").alias("path"), utf8(f"`{text}`").alias("body"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    vocabulary = frozenset(word for _, words in bodies_of(templates) for word in words)
    frequency, total = document_frequencies(rows, vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast(Matcher(templates, frequency, total))

    def match(batch: pa.RecordBatch) -> pa.RecordBatch:
        matcher = shared.value
        names, cosines, files = [], [], []
        for body in texts_of(batch.column("body")):
            name, cosine, is_file = None, 0.0, False
            if MARKERS.search(body.lower()):
                whole, close = matcher.best(words_of(body))
                if close >= file_cosine:
                    name, cosine, is_file = whole, close, True
                else:
                    name, cosine = matcher.header(body.splitlines(), header_cosine)
            names.append(name)
            cosines.append(cosine)
            files.append(is_file)
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                "path": batch.column("path"),
                "own_license": pa.array(names, pa.string()),
                "cosine": pa.array(cosines, pa.float64()),
                "is_license_file": pa.array(files, pa.bool_()),
            }
        )

    schema = f"doc_id {kind}, path string, own_license string, cosine double, is_license_file boolean"
    matched = written(per_batch(rows, match, schema), "licenses").withColumn("dir", parent_of(F.col("path")))
    # the licence of each directory that holds a licence file
    offered = matched.filter(F.col("is_license_file") & F.col("dir").isNotNull())
    offered = offered.groupBy("dir").agg(F.min_by("own_license", F.struct(-F.col("cosine"), "path")).alias("offered"))
    # each directory with itself and its ancestors, the nearest first
    dirs = matched.select("dir").filter(F.col("dir").isNotNull()).distinct()
    parts = F.split("dir", "/")
    depth = F.explode(F.sequence(F.lit(0), F.size(parts)))
    steps = dirs.select("dir", parts.alias("parts"), depth.alias("depth"))
    steps = steps.select("dir", "depth", F.array_join(F.slice("parts", F.lit(1), F.col("depth")), "/").alias("ancestor")).distinct()
    nearest = steps.join(offered.withColumnRenamed("dir", "ancestor"), "ancestor").groupBy("dir")
    nearest = nearest.agg(F.max_by("offered", "depth").alias("inherited"))
    joined = matched.join(nearest, "dir", "left")
    own = F.col("own_license").isNotNull()
    found_in = F.when(own & F.col("is_license_file"), "file").when(own, "header").when(F.col("inherited").isNotNull(), "directory")
    return joined.select(
        "doc_id", "path", "own_license", "cosine", "is_license_file",
        F.coalesce("own_license", "inherited").alias("license"), found_in.alias("found_in"),
    )


def op6(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scan(docs, F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")))
