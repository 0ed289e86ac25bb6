"""Language identification of mixed text: scripts narrow the candidates, Viterbi labels spans.

The model counts hashed character n-grams (1 to 4, with word boundaries) and scripts of words per language. A word
scores, for each language seen in the word's script, the mean log probability of its n-grams times the square root of
their number; languages not seen in the script get a floor. The path of languages over the words of a text, with a
penalty for each switch, labels its spans; the language of most letters is the language of the text.

``train`` learns from at most about ``rows_per_language`` rows of each language, chosen by a hash of the id
(``SAMPLE_ROWS``); this is the only sample. Identification reads whole texts.

Defined results: a null text, and one without letters, is ``und`` with score 0 and no spans; without any training rows
every text is ``und``. Ties go to the language that comes first in order. Rows with null language or text teach
nothing. Repeated rows are kept; extra columns are left out by ``identify`` and kept by ``keep_identified``.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import TokenTable, held_out, input_columns, let_go, of_worker, on_texts, per_batch, ship, table

UNKNOWN = "und"
SAMPLE_ROWS = 2000
SWITCH_PENALTY = 6.0
BUCKETS = 1 << 18
LONGEST_GRAM = 4
SMOOTHING = 0.1
#: a language counts as written in a script if this share of its training words is
SCRIPT_SHARE = 0.01
FLOOR = -50.0
#: most numbers held at a time by the path search
CELLS = 1_000_000
#: texts labelled at a time
TEXTS = 2048

# First code point of each range of the Unicode blocks, and the script of letters there.
SCRIPT_RANGES = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "Syriac"), (0x0750, "Arabic"), (0x0780, "Thaana"), (0x07C0, "Other"),
    (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Oriya"),
    (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"),
    (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"), (0x10A0, "Georgian"),
    (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Other"), (0x1780, "Khmer"), (0x1800, "Mongolian"),
    (0x18B0, "Other"), (0x1C80, "Cyrillic"), (0x1C90, "Georgian"), (0x1CC0, "Other"), (0x1D00, "Latin"),
    (0x1F00, "Greek"), (0x2000, "Latin"), (0x2E80, "Han"), (0x3040, "Kana"), (0x3100, "Other"), (0x3130, "Hangul"),
    (0x3190, "Han"), (0x31F0, "Kana"), (0x3200, "Other"), (0x3400, "Han"), (0xA000, "Other"), (0xA640, "Cyrillic"),
    (0xA6A0, "Other"), (0xA720, "Latin"), (0xA800, "Other"), (0xAC00, "Hangul"), (0xD800, "Other"), (0xF900, "Han"),
    (0xFB00, "Latin"), (0xFB13, "Armenian"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFE00, "Other"),
    (0xFE70, "Arabic"), (0xFF00, "Latin"), (0xFF65, "Kana"), (0xFFA0, "Hangul"), (0xFFE0, "Other"),
    (0x20000, "Han"), (0x30000, "Other"),
)
SCRIPTS = sorted({script for _, script in SCRIPT_RANGES})
_STARTS = np.array([start for start, _ in SCRIPT_RANGES])
_SCRIPT_AT = np.array([SCRIPTS.index(script) for _, script in SCRIPT_RANGES])

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text)


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All words in lower case with a blank on either side, as one array, and where each starts."""
    padded = [f" {word.lower()} " for word in words]
    sizes = np.fromiter(map(len, padded), np.int64, len(padded))
    flat = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    return flat, np.concatenate(([0], np.cumsum(sizes)))


def gram_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each n-gram, and the word it belongs to."""
    flat, starts = code_points(words)
    owner = np.repeat(np.arange(len(words)), np.diff(starts))
    buckets, owners = [], []
    mixed = np.zeros(len(flat), np.uint64)
    for size in range(1, LONGEST_GRAM + 1):
        count = len(flat) - size + 1
        if count <= 0:
            break
        mixed = (mixed[:count] * np.uint64(1_000_003)) ^ (flat[size - 1 :] + np.uint64(size))
        within = owner[:count] == owner[size - 1 :]
        if size == 1:
            within = within & (flat != 32)
        spread = mixed * np.uint64(0x9E3779B97F4A7C15)
        buckets.append((spread >> np.uint64(46))[within].astype(np.int64))
        owners.append(owner[:count][within])
    return np.concatenate(buckets), np.concatenate(owners)


def scripts_of(words: list[str]) -> np.ndarray:
    first = np.fromiter((ord(next((c for c in word if c.isalpha()), word[0])) for word in words), np.int64, len(words))
    return _SCRIPT_AT[np.searchsorted(_STARTS, first, side="right") - 1]


class LanguageModel:
    def __init__(self, languages: list[str], grams: np.ndarray, scripts: np.ndarray, penalty: float = SWITCH_PENALTY):
        """``grams``: counts by bucket and language; ``scripts``: words by script and language."""
        self.key = uuid.uuid4().hex
        self.languages, self.penalty = languages, penalty
        seen = max(1, int((grams.sum(axis=1) > 0).sum()))
        self.log_p = np.log((grams + SMOOTHING) / (grams.sum(axis=0) + SMOOTHING * seen)).astype(np.float32)
        share = scripts / np.maximum(scripts.sum(axis=0), 1)
        self.candidates = share >= SCRIPT_SHARE

    def score_words(self, words: list[str]) -> np.ndarray:
        """A row per word: letters, then a score per language."""
        buckets, owners = gram_buckets(words)
        count = np.maximum(np.bincount(owners, minlength=len(words)), 1)
        scores = np.stack(
            [np.bincount(owners, self.log_p[buckets, k], len(words)) for k in range(len(self.languages))], axis=1
        )
        scores /= np.sqrt(count)[:, None]
        allowed = self.candidates[scripts_of(words)]
        nowhere = ~allowed.any(axis=1)
        best = np.where(allowed, scores, -np.inf).max(axis=1, initial=-np.inf)
        scores = np.where(allowed, np.maximum(scores - best[:, None], FLOOR), FLOOR)
        scores[nowhere] = 0.0
        letters = np.fromiter((sum(map(str.isalpha, word)) for word in words), np.float64, len(words))
        scores[letters == 0] = 0.0
        return np.column_stack([letters, scores]).astype(np.float32)


def best_paths(scores: np.ndarray, starts: np.ndarray, penalty: float) -> np.ndarray:
    """Viterbi over many texts side by side: the best language of each word. Texts are ``starts[i]:starts[i + 1]``."""
    sizes = np.diff(starts)
    order = np.argsort(-sizes, kind="stable")
    first, sizes = starts[:-1][order], sizes[order]
    n, k = scores.shape
    switched, best_before = np.zeros((n, k), bool), np.zeros(n, np.int16)
    total = np.zeros((len(order), k), np.float64)
    active = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), side="right")
    for t, lanes in enumerate(active):
        at = first[:lanes] + t
        here = total[:lanes]
        if t:
            lead = here.argmax(axis=1)
            other = here[np.arange(lanes), lead] - penalty
            better = other[:, None] > here
            switched[at], best_before[at] = better, lead
            np.maximum(here, other[:, None], out=here)
        here += scores[at]
    label = np.zeros(n, np.int16)
    now = total.argmax(axis=1).astype(np.int16)
    for t in range(len(active) - 1, -1, -1):
        lanes = active[t]
        at = first[:lanes] + t
        label[at] = now[:lanes]
        if t:
            moved = switched[at, now[:lanes]]
            now[:lanes] = np.where(moved, best_before[at], now[:lanes])
    return label


class Identifier:
    """Labels texts. The table of word scores lives as long as the worker."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.words = TokenTable(model.score_words, limit=max(20_000, 500_000 // len(model.languages)))

    def label(self, texts: list[str | None]) -> list[tuple[str, float, list[tuple[str, int, int, int]]]]:
        """Of each text its language, the share of letters in it, and spans: language, first word, words, letters."""
        out = []
        split, held = [], 0
        for text in texts:
            split.append(words_of(text) if text else [])
            held += len(split[-1]) * len(self.model.languages)
            if held > CELLS:
                out.extend(self._label(split))
                split, held = [], 0
        return out + self._label(split)

    def _label(self, split: list[list[str]]):
        if not split:
            return []
        starts = np.concatenate(([0], np.cumsum([len(words) for words in split])))
        numbers = self.words.numbers([word for words in split for word in words])
        if not len(numbers):
            return [(UNKNOWN, 0.0, [])] * len(split)
        rows = self.words.rows[numbers]
        label = best_paths(rows[:, 1:], starts, self.model.penalty)
        letters = rows[:, 0]
        names, k = self.model.languages, len(self.model.languages)
        owner = np.repeat(np.arange(len(split)), np.diff(starts))
        sums = np.bincount(owner * k + label, letters, len(split) * k).reshape(len(split), k)
        edge = np.flatnonzero(np.concatenate(([True], (np.diff(label) != 0) | (np.diff(owner) != 0))))
        span_letters = np.add.reduceat(letters, edge)
        spans: list[list] = [[] for _ in split]
        ends = np.concatenate((edge[1:], [len(label)]))
        for begin, end, size in zip(edge.tolist(), ends.tolist(), span_letters.tolist(), strict=True):
            spans[owner[begin]].append((names[label[begin]], begin - int(starts[owner[begin]]), end - begin, int(size)))
        out = []
        for row, parts in zip(sums, spans, strict=True):
            whole = float(row.sum())
            best = int(row.argmax())
            out.append((names[best], float(row[best]) / whole, parts) if whole else (UNKNOWN, 0.0, []))
        return out


def train(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", rows_per_language: int = SAMPLE_ROWS
) -> LanguageModel | None:
    """The model of the languages in ``docs``, without the held-out ids. None if no row can teach."""
    ship(docs.sparkSession)
    rows = input_columns(docs, key=doc_id, body=text, lang=lang)
    usable = rows.filter(F.col("lang").isNotNull() & F.col("body").isNotNull() & ~held_out(F.col("key")))
    counts = {row.lang: row["count"] for row in usable.groupBy("lang").count().collect()}  # a row per language
    if not counts:
        return None
    languages = sorted(counts)
    # a hash of the id below this share chooses about the wanted number of rows
    share = F.create_map(
        *(x for name in languages for x in (F.lit(name), F.lit(min(1.0, rows_per_language / counts[name]))))
    )
    position = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / float(1 << 30)
    sample = usable.filter(position <= share[F.col("lang")])

    def count(batches):
        let_go()
        total = {name: (np.zeros(BUCKETS, np.int64), np.zeros(len(SCRIPTS), np.int64)) for name in languages}
        seen = set()
        for batch in batches:
            for name, body in zip(batch.column("lang").to_pylist(), batch.column("body").to_pylist(), strict=True):
                words = words_of(body)
                if not words:
                    continue
                distinct, times = np.unique(np.array(words, dtype=object), return_counts=True)
                buckets, owners = gram_buckets(distinct.tolist())
                grams, scripts = total[name]
                grams += np.bincount(buckets, times[owners], BUCKETS).astype(np.int64)
                scripts += np.bincount(scripts_of(distinct.tolist()), times, len(SCRIPTS)).astype(np.int64)
                seen.add(name)
        for name in sorted(seen):
            for kind, numbers in zip(("gram", "script"), total[name], strict=True):
                used = np.flatnonzero(numbers)
                yield pa.RecordBatch.from_pydict(
                    {"lang": [name] * len(used), "kind": [kind] * len(used), "at": used, "n": numbers[used]}
                )

    found = sample.select("lang", "body").mapInArrow(count, "lang string, kind string, at long, n long")
    # at most BUCKETS rows per language
    summed = found.groupBy("lang", "kind", "at").agg(F.sum("n").alias("n")).toArrow()
    grams, scripts = np.zeros((BUCKETS, len(languages))), np.zeros((len(SCRIPTS), len(languages)))
    column = np.array([languages.index(name) for name in summed["lang"].to_pylist()], np.int64)
    is_gram = np.array([kind == "gram" for kind in summed["kind"].to_pylist()], bool)
    at, n = summed["at"].to_numpy(), summed["n"].to_numpy()
    grams[at[is_gram], column[is_gram]] = n[is_gram]
    scripts[at[~is_gram], column[~is_gram]] = n[~is_gram]
    return LanguageModel(languages, grams, scripts)


def _labels(shared, column: pa.Array):
    """Labels of a batch; the worker keeps the identifier between its tasks."""
    if shared is None:
        return [(UNKNOWN, 0.0, [])] * len(column)
    model = shared.value
    return of_worker(("languages", model.key), lambda: Identifier(model)).label(column.to_pylist())


_SPANS = "array<struct<lang:string,first_word:int,words:int,letters:int>>"


def identify(docs: DataFrame, model: LanguageModel | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: lang_pred, score (share of letters in that language) and the labelled spans."""
    rows = input_columns(docs, doc_id=doc_id, body=text).withColumn("body", F.col("body").cast("string"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model) if model else None

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = _labels(shared, batch.column("body"))
        spans = [
            [{"lang": name, "first_word": first, "words": size, "letters": letters} for name, first, size, letters in x[2]]
            for x in found
        ]
        span = pa.struct([("lang", pa.string()), ("first_word", pa.int32()), ("words", pa.int32()), ("letters", pa.int32())])
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                "lang_pred": pa.array([x[0] for x in found], pa.string()),
                "score": pa.array([x[1] for x in found], pa.float64()),
                "spans": pa.array(spans, pa.list_(span)),
            }
        )

    return per_batch(rows, run, f"doc_id {kind}, lang_pred string, score double, spans {_SPANS}", TEXTS)


def keep_identified(docs: DataFrame, model: LanguageModel | None, text: str = "text", least_score: float = 0.0) -> DataFrame:
    """The rows of ``docs`` whose text has a language, at this share of its letters at least."""
    names = docs.columns
    boxed = docs.select(F.struct(*(docs[f"`{n}`"] for n in names)).alias("_row"))
    shared = docs.sparkSession.sparkContext.broadcast(model) if model else None

    def identified(texts: pa.Array) -> pa.Array:
        return pa.array([label != UNKNOWN and score >= least_score for label, score, _ in _labels(shared, texts)], pa.bool_())

    ship(docs.sparkSession)
    keep = on_texts(identified, "boolean", TEXTS)
    kept = boxed.filter(keep(F.col("_row").getField(text).cast("string")))
    return kept.select(*(F.col("_row").getField(n).alias(n) for n in names))


def op4(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, train(docs))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans")
    )
