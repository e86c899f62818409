"""Toxicity scores by gradient-boosted trees over dense features, with isotonic calibration.

A lexicon is counted from labelled rows: words, and the first STEM characters
of longer words, whose odds of standing in a toxic text are high. A document's
features are the densities of both lexicons in three tiers, the nearness of
hits to second-person words, shares of capitals and of marks, and rates of
obfuscation (marks or digits within words, stretched letters). Boosted trees
are fitted on part of the labelled rows, and an isotonic regression on the
rest turns their margin into a probability.

Labels come from at most TRAIN_ROWS rows outside the held-out fold; every
document is scored. Labels, language, source and id are no inputs. Nulls and
empty texts have all features 0 and are scored. Without rows of both labels
every score is the share of toxic rows (0 if there is none). Repeated rows
score alike. Empty tables give empty results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthloom.llm.common import Vocabulary, picked, scratch_table, text_bytes
from growthloom.llm.labels import fold_of, training_rows

TRAIN_ROWS = 20_000
LEXICON = 4_000
STEM = 5
TREES, DEPTH = 20, 4
PREDICT = 0.5
NEAR = 5
EDGE = ".,;:!?\"'`()[]{}<>|#*$%&=_~^/\\-+@"
#: Second-person words of the corpus languages.
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine deinen ihr euch tu te toi ton ta tes vous votre vos usted ustedes ti tus vosotros vuestro".split())
#: Digits and marks that stand for letters.
STANDS_FOR = str.maketrans("013457@$", "oieastas")
FEATURES = (
    "words", "hits_weak", "hits_mid", "hits_strong", "stems_weak", "stems_mid", "stems_strong", "best", "best_stem", "top_sum",
    "kinds", "near_second", "second", "capitals", "shouted", "marks", "loud", "masked", "stretched",
)


MASKED = re.compile(r"[^\W\d_][\d@$*!|]+[^\W\d_]")
STRETCHED = re.compile(r"(.)\1\1")


def plain(word: bytes) -> str:
    return word.decode("utf-8", "replace").lower().strip(EDGE)


def _tiers(weights: np.ndarray, n: int) -> list[float]:
    return [min(1.0, 20 * int(((weights >= lo) & (weights < hi)).sum()) / n) for lo, hi in ((1.0, 2.0), (2.0, 3.0), (3.0, np.inf))]


class Featuriser:
    """Features of texts for one lexicon: {word or stem*: log odds}; distinct words are looked at once a task."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self._start()

    def _start(self) -> None:
        self.book = Vocabulary(code=lambda _: 0)
        self.table = np.zeros((1 << 12, 6))
        self.known = 0

    def _row(self, word: bytes) -> tuple:
        raw = word.decode("utf-8", "replace").strip(EDGE)
        text = raw.lower()
        if not text:
            return 0, 0, 0, 0, 0, 0
        masked = not raw.isalpha() and bool(MASKED.search(raw))
        weight = max(self.lexicon.get(text, 0.0), self.lexicon.get(text.translate(STANDS_FOR), 0.0) if masked else 0.0)
        stem = self.lexicon.get(text[:STEM] + "*", 0.0) if len(text) > STEM else 0.0
        return weight, stem, text in SECOND_PERSON, len(raw) > 2 and raw.isupper(), masked, bool(STRETCHED.search(text))

    def _learn(self) -> None:
        words = self.book.words
        while len(words) > len(self.table):  # doubled, so that a row is copied a few times at most
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[self.known : len(words)] = [self._row(w) for w in words[self.known :]]
        self.known = len(words)

    def features(self, text: bytes) -> list[float]:
        if self.book.trim():
            self._start()
        words = text.split()
        n = len(words)
        if n == 0:
            return [0.0] * len(FEATURES)
        numbers = self.book.numbers(words)
        if len(self.book.words) > self.known:
            self._learn()
        weight, stem, second, shouted, masked, stretched = self.table[numbers].T
        count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        letters = int(count[65:91].sum() + count[97:123].sum())
        hits = np.flatnonzero(weight >= 1.0)
        near = 0.0
        if len(hits) and second.any():
            at = np.flatnonzero(second)
            where = np.searchsorted(at, hits)
            gap = np.minimum(np.abs(hits - at[np.minimum(where, len(at) - 1)]), np.abs(hits - at[np.maximum(where - 1, 0)]))
            near = float((gap <= NEAR).mean())
        kinds = numbers[hits]
        top = np.sort(weight[hits])[-3:].sum() if len(hits) else 0.0
        marks = int(count[33:48].sum() + count[58:65].sum() + count[91:97].sum() + count[123:127].sum())
        return [
            min(1.0, np.log1p(n) / 10), *_tiers(weight, n), *_tiers(stem, n), float(weight.max()), float(stem.max()), float(top),
            min(1.0, len(np.unique(kinds)) / 5), near, min(1.0, 10 * second.mean()), int(count[65:91].sum()) / letters if letters else 0.0,
            float(shouted.mean()), min(1.0, marks / n), min(1.0, int(count[33] + count[63]) / n), min(1.0, 10 * masked.mean()), min(1.0, 10 * stretched.mean()),
        ]


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, text) -> (word, toxic texts, other texts) with it, combined within the task."""
    found: dict[str, list[int]] = {}
    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
            words = {plain(w) for w in text.split()} - {""}
            for w in words | {w[:STEM] + "*" for w in words if len(w) > STEM}:
                found.setdefault(w, [0, 0])[0 if label else 1] += 1
    keys = list(found)
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *[pa.array([found[k][i] for k in keys], pa.int64()) for i in (0, 1)]], names=["word", "bad", "good"])


def lexicon_of(rows: DataFrame, n_bad: int, n_good: int) -> dict[str, float]:
    """At most LEXICON words and stems by their log odds, held back where few texts speak for them."""
    counts = rows.select(F.col("label").cast("int").alias("label"), "text").mapInArrow(_word_rows, "word string, bad long, good long").groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    odds = F.log(((F.col("bad") + 0.05) / (n_bad + 0.1)) / ((F.col("good") + 0.5) / (n_good + 1.0))) * (F.col("bad") / (F.col("bad") + 1.0))
    found = counts.where("bad >= 2").withColumn("odds", odds).where("odds >= 0.7").orderBy(F.desc(F.col("odds") * F.sqrt("bad")), "word").limit(LEXICON)
    return {r.word: float(r.odds) for r in found.collect()}


def _vectors(rows: DataFrame, lexicon: dict[str, float], keep: tuple[str, ...]) -> DataFrame:
    """(*keep, x: array of FEATURES) of the column ``text``."""
    frame = rows.select(*keep, "text")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.schema.fields[:-1]) + ", x array<double>"
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)  # LEXICON words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        featuriser = Featuriser(shared.value)
        for batch in batches:
            x = pa.array([featuriser.features(t) for t in text_bytes(batch.column(len(keep)))], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(keep))] + [x], names=[*keep, "x"])

    return frame.mapInArrow(run, schema)


def _margin(model, frame: DataFrame) -> DataFrame:
    """``frame`` with the trees' margin ``m`` in place of ``x``."""
    columns = [c for c in frame.columns if c != "x"]
    out = model.transform(frame.withColumn("features", array_to_vector("x")))
    return out.select(*columns, vector_to_array("rawPrediction")[1].alias("m"))


def _calibrated(m: Column, bounds: list[float], values: list[float]) -> Column:
    """Linear between the isotonic steps, level outside: the steps are few and stand in the plan."""
    out = F.lit(values[0])
    for (a, b), (p, q) in zip(zip(bounds, bounds[1:]), zip(values, values[1:])):
        out = F.when(m < a, out).otherwise(F.when(m < b, p + (q - p) * (m - a) / (b - a)).otherwise(F.lit(q))) if b > a else F.when(m < b, out).otherwise(F.lit(q))
    return out


def toxicity_scores(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    docs = picked(docs, **{id_col: id_col, "text": text_col})
    ident = F.col(id_col)
    rows = training_rows(docs, labels, label_col, ("text",), TRAIN_ROWS, id_col)
    counts = {r.label > 0: r.n for r in rows.groupBy((F.col("label") > 0).cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n")).collect()}
    n_bad, n_good = counts.get(True, 0), counts.get(False, 0)
    held = (fold_of(ident) == 0).alias("held_out")
    if not n_bad or not n_good:
        flat = F.lit(1.0 if n_bad else 0.0)
        return docs.select(id_col, held, flat.alias("score"), (flat >= PREDICT).cast("int").alias("predicted"))
    # The calibration rows take no part in the lexicon and the trees.
    apart = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(4)) == 0
    rows = rows.withColumn("label", (F.col("label") > 0).cast("double"))
    fitting, rest = rows.where(~apart), rows.where(apart)
    if {r.label for r in fitting.select("label").distinct().collect()} != {0.0, 1.0}:
        fitting = rows
    lexicon = lexicon_of(fitting, n_bad, n_good)
    inputs = scratch_table(_vectors(rows.withColumn("apart", apart), lexicon, ("label", "apart")), "toxic-inputs")
    chosen = inputs if fitting is rows else inputs.where("not apart")
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=1, minInstancesPerNode=3)
    model = trees.fit(chosen.withColumn("features", array_to_vector("x")))
    margins = _margin(model, inputs.where("apart") if not rest.isEmpty() else inputs)
    isotonic = IsotonicRegression(featuresCol="m", labelCol="label").fit(margins)
    bounds, values = (list(map(float, x.toArray())) for x in (isotonic.boundaries, isotonic.predictions))
    scored = _margin(model, _vectors(docs.select(ident.alias("id"), "text"), lexicon, ("id",)))
    # A whisker of the margin keeps the order within a step.
    score = 0.998 * _calibrated(F.col("m"), bounds, values) + 0.002 / (1 + F.exp(-2 * F.col("m")))
    return scored.select(F.col("id").alias(id_col), (fold_of(F.col("id")) == 0).alias("held_out"), score.alias("score"), (score >= PREDICT).cast("int").alias("predicted"))
