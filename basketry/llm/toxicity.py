"""Toxicity: boosted trees over dense features of whole texts, calibrated by isotonic regression.

1. A lexicon of words and word beginnings is learnt from labelled texts: entries that stand in toxic texts far more
   often than in others, by the smoothed log odds of document frequencies.
2. Every text gets dense features: densities of lexicon entries (also behind look-alike characters), their nearness to
   a second person, shares of capitals, punctuation and obfuscated words.
3. Gradient-boosted trees are trained on one half of the labelled texts the lexicon has not seen; isotonic regression
   maps their raw score to the share of toxic texts on the other half.

Labels come from at most about ``rows_per_class`` rows a class, chosen by a hash of the id (``SAMPLE_ROWS``); this is
the only sample. Scoring reads whole texts.

Defined results: a null or empty text has all features 0 and is scored like any other; without both classes among the
training rows each text gets the share of toxic labels (0 without any). A text labelled twice counts as toxic if either
label says so. Repeated rows are kept; extra columns are left out by ``score_texts`` and kept by ``keep_clean``.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import TokenTable, held_out, input_columns, of_worker, on_texts, per_batch, ship, table, texts_of, utf8, written

SAMPLE_ROWS = 4000
LEXICON_SIZE = 5000
LEAST_TEXTS = 3
LEAST_LOG_ODDS = 1.5
STEM_LENGTHS = range(4, 9)
TREES, DEPTH = 12, 3
THRESHOLD = 0.5
#: texts turned into features at a time
TEXTS = 2048
NEAR = 3

# Second-person pronouns of English, German, French, Spanish, Italian and Portuguese.
SECOND_PERSON = frozenset(
    "you your yours yourself ur du dich dir dein deine euch euer ihr sie tu toi te ton ta tes vous votre vos "
    "usted ustedes tú ti tus vosotros voi tuo tua você vocês seu sua".split()
)
# Characters written for letters they look like.
LOOK_ALIKES = str.maketrans("013457@$!|", "oieastasii")
STRONG = 3.0
FEATURES = (
    "words", "lexicon_density", "strong_density", "strong_count", "highest_weight", "distinct_strong", "near_second_person",
    "capitals", "capital_words", "exclamations", "punctuation", "obfuscated", "repeated_letters",
)

_EDGE = "\"'.,;:!?()[]{}<>|*#%&$-_~`/\\…“”«»¡¿"
_INNER = re.compile(r"[^\W\d_][\d@$!|*.\-_+]+[^\W\d_]|[^\W\d_][@$!|*]|[\d@$!|][^\W\d_]")
_RUN = re.compile(r"(.)\1\1")


def bare_words(token: str) -> list[str]:
    """The word without edges in lower case, and the same with look-alikes and fillers undone."""
    word = token.strip(_EDGE).lower()
    if not word or word.isalpha():
        return [word] if word else []
    plain = re.sub(r"[\W_]", "", word.translate(LOOK_ALIKES))
    return [word, plain] if plain and plain != word and any(map(str.isalpha, word)) else [word]


def keys_of(word: str) -> list[str]:
    """The lexicon keys a word can match: itself, and its beginnings."""
    return [word, *(f"{word[:size]}*" for size in STEM_LENGTHS if len(word) > size)]


class TextFeatures:
    """Features of texts under a lexicon. Rows of tokens are computed once per token and worker."""

    COLUMNS = ("weight", "second", "letters", "upper", "marks", "exclaims", "obfuscated", "run", "capital_word")

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.tokens = TokenTable(self._rows, limit=150_000)

    def _rows(self, tokens: list[bytes]) -> np.ndarray:
        rows = np.zeros((len(tokens), len(self.COLUMNS)), np.float32)
        weight_of = self.lexicon.get
        for row, raw in zip(rows, tokens, strict=True):
            token = raw.decode("utf-8", "replace")
            words = bare_words(token)
            weight = max((weight_of(key, 0.0) for word in words for key in keys_of(word)), default=0.0)
            letters = sum(map(str.isalpha, token))
            upper = sum(map(str.isupper, token))
            marks = sum(not c.isalnum() for c in token)
            row[:] = (
                weight,
                bool(words) and words[0] in SECOND_PERSON,
                letters,
                upper,
                marks,
                token.count("!"),
                bool(letters) and len(words) > 0 and _INNER.search(token.strip(_EDGE)) is not None,
                _RUN.search(token.lower()) is not None and letters > 3,
                letters > 1 and upper == letters,
            )
        return rows

    def of(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros((len(texts), len(FEATURES)), np.float64)
        for row, text in zip(out, texts, strict=True):
            tokens = text.split()
            if not tokens:
                continue
            numbers = self.tokens.numbers(tokens)
            rows = self.tokens.rows[numbers]
            weight, count = rows[:, 0], len(tokens)
            sums = rows.sum(axis=0, dtype=np.float64)
            strong = np.flatnonzero(weight >= STRONG)
            near = 0
            if len(strong):
                second = np.concatenate(([0], np.cumsum(rows[:, 1])))
                near = (second[np.minimum(strong + NEAR + 1, count)] > second[np.maximum(strong - NEAR, 0)]).sum()
            letters = max(sums[2], 1.0)
            row[:] = (
                np.log1p(count),
                sums[0] / count,
                len(strong) / count,
                np.log1p(len(strong)),
                weight.max(),
                np.log1p(len(np.unique(numbers[strong]))),
                near / count,
                sums[3] / letters,
                sums[8] / count,
                sums[5] / count,
                sums[4] / max(len(text), 1),
                sums[6] / count,
                sums[7] / count,
            )
        return out


class Scorer:
    """What scoring needs besides the trees: the lexicon."""

    def __init__(self, lexicon: dict[str, float]):
        self.key, self.lexicon = uuid.uuid4().hex, lexicon


def _features(shared, column: pa.Array) -> pa.Array:
    scorer = shared.value
    features = of_worker(("toxicity", scorer.key), lambda: TextFeatures(scorer.lexicon))
    made = features.of(texts_of(column))
    offsets = np.arange(0, made.size + 1, len(FEATURES), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(made.ravel()))


def with_features(df: DataFrame, shared) -> DataFrame:
    """Replace the column ``body`` by ``features``."""
    names = [name for name in df.columns if name != "body"]
    schema = df.select(*names, F.lit(None).cast("array<double>").alias("features")).schema

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = {name: batch.column(name) for name in names}
        return pa.RecordBatch.from_pydict(columns | {"features": _features(shared, batch.column("body"))})

    return per_batch(df, run, schema, TEXTS)


def learn_lexicon(labelled: DataFrame, size: int = LEXICON_SIZE) -> dict[str, float]:
    """Words and beginnings with the log odds of standing in a toxic text. ``labelled``: body, toxic."""

    def count(batches):
        toxic, other = Counter(), Counter()
        for batch in batches:
            for text, label in zip(texts_of(batch.column("body")), batch.column("toxic").to_pylist(), strict=True):
                words = {word for token in set(text.split()) for word in bare_words(token.decode("utf-8", "replace"))}
                (toxic if label else other).update({key for word in words for key in keys_of(word)})
        keys = list(toxic.keys() | other.keys())
        for at in range(0, len(keys), 50_000):
            some = keys[at : at + 50_000]
            yield pa.RecordBatch.from_pydict(
                {"key": some, "n1": pa.array([toxic[k] for k in some], pa.int64()), "n0": pa.array([other[k] for k in some], pa.int64())}
            )

    totals = {bool(row.toxic): row["count"] for row in labelled.groupBy("toxic").count().collect()}
    counts = labelled.select("body", "toxic").mapInArrow(count, "key string, n1 long, n0 long")
    counts = counts.groupBy("key").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    odds = F.log(((F.col("n1") + 0.5) / (totals.get(True, 0) + 1.0)) / ((F.col("n0") + 0.5) / (totals.get(False, 0) + 1.0)))
    # an entry has to be seen in texts of more than one kind of word use: a few texts, and hardly in others
    best = (
        counts.filter((F.col("n1") >= LEAST_TEXTS) & (F.length("key") > 2))
        .withColumn("odds", odds)
        .filter(F.col("odds") >= LEAST_LOG_ODDS)
        .orderBy(F.desc(F.col("odds") * F.log1p("n1")), "key")
        .limit(size)
    )
    return {row.key: float(row.odds) for row in best.collect()}  # at most ``size`` rows


class ToxicityModel:
    """``prior`` alone scores if there was nothing to learn."""

    def __init__(self, prior: float, shared=None, trees=None, calibration=None):
        self.prior, self.shared, self.trees, self.calibration = prior, shared, trees, calibration

    def score(self, df: DataFrame) -> DataFrame:
        """Replace ``body`` by ``score``; the other columns stay."""
        names = [name for name in df.columns if name != "body"]
        if self.trees is None:
            return df.select(*names, F.lit(self.prior).alias("score"))
        return self.score_features(with_features(df, self.shared))

    def score_features(self, df: DataFrame) -> DataFrame:
        """Replace ``features`` by ``score``; the other columns stay."""
        names = [name for name in df.columns if name != "features"]
        scored = self.trees.transform(df.select(*names, array_to_vector("features").alias("_x")))
        raw = scored.select(*names, vector_to_array("rawPrediction")[1].alias("_margin"))
        return self.calibration.transform(raw).select(*names, F.greatest(F.lit(0.0), F.least(F.lit(1.0), "_p")).alias("score"))


def training_rows(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, rows_per_class: int) -> DataFrame:
    """key, part (0 to 99, by a hash of the id), toxic, body of a bounded number of labelled rows, not held out."""
    keys = input_columns(labels, key=doc_id, toxic=label).filter(F.col("key").isNotNull() & F.col("toxic").isNotNull())
    keys = keys.filter(~held_out(F.col("key"))).groupBy("key").agg((F.max("toxic") > 0).alias("toxic"))
    counts = {row.toxic: row["count"] for row in keys.groupBy("toxic").count().collect()}
    share = F.when(F.col("toxic"), F.lit(min(1.0, rows_per_class / max(1, counts.get(True, 0))))).otherwise(
        F.lit(min(1.0, rows_per_class / max(1, counts.get(False, 0))))
    )
    position = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / float(1 << 30)
    # at most about twice ``rows_per_class`` keys, so the side to broadcast has a fixed bound
    chosen = keys.filter(position <= share)
    rows = input_columns(docs, key=doc_id, body=text).join(F.broadcast(chosen), "key")
    part = F.pmod(F.xxhash64("key", F.lit("part")), F.lit(100))
    return written(rows.select("key", part.cast("int").alias("part"), "toxic", utf8("body").alias("body")), "toxicity-sample")


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    rows_per_class: int = SAMPLE_ROWS,
) -> ToxicityModel:
    spark = docs.sparkSession
    ship(spark)
    sample = training_rows(docs, labels, doc_id, text, label, rows_per_class)
    sizes = {(row.third, row.toxic): row["count"] for row in sample.groupBy(_third().alias("third"), "toxic").count().collect()}
    toxic, every = sum(n for (_, hit), n in sizes.items() if hit), sum(sizes.values())
    if not all(sizes.get((third, hit)) for third in range(3) for hit in (True, False)):
        return ToxicityModel(toxic / every if every else 0.0)
    lexicon = learn_lexicon(sample.filter(_third() == 0))
    shared = spark.sparkContext.broadcast(Scorer(lexicon))
    made = with_features(sample.withColumn("third", _third()), shared)
    made = made.select("third", F.col("toxic").cast("double").alias("label"), array_to_vector("features").alias("_x")).persist()
    try:
        trees = GBTClassifier(
            featuresCol="_x", labelCol="label", predictionCol="_class",
            maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, maxBins=64,
        )
        model = trees.fit(made.filter("third = 1"))
        raw = model.transform(made.filter("third = 2")).select("label", vector_to_array("rawPrediction")[1].alias("_margin"))
        calibration = IsotonicRegression(featuresCol="_margin", labelCol="label", predictionCol="_p").fit(raw)
    finally:
        made.unpersist()
    return ToxicityModel(toxic / every, shared, model, calibration)


def _third() -> F.Column:
    """What a labelled row is for: 0 the lexicon (half of the rows), 1 the trees, 2 the calibration."""
    return F.when(F.col("part") < 50, 0).when(F.col("part") < 80, 1).otherwise(2)


def score_texts(docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: score, predicted."""
    rows = input_columns(docs, doc_id=doc_id, body=text).select("doc_id", utf8("body").alias("body"))
    return model.score(rows).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_clean(docs: DataFrame, model: ToxicityModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold."""
    names = docs.columns
    boxed = docs.select(F.struct(*(docs[f"`{n}`"] for n in names)).alias("_row"))
    if model.trees is None:
        scored = boxed.withColumn("score", F.lit(model.prior))
    else:
        ship(docs.sparkSession)
        features = on_texts(partial(_features, model.shared), "array<double>", TEXTS)
        body = F.coalesce(F.col("_row").getField(text).cast("binary"), F.lit(b""))
        scored = model.score_features(boxed.withColumn("features", features(body)))
    kept = scored.filter(F.col("score") < threshold)
    return kept.select(*(F.col("_row").getField(n).alias(n) for n in names))


def op2(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_texts(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
