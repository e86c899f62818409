"""Quality scores by a factorisation machine.

Inputs of a document: hashed words (1 + ln count, of unit length together),
structure statistics of the whole text, and metadata (the declared number of
characters against the actual one). The machine is

    s = w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

and the pairs are scored in linear time by the sum-of-squares identity,
1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2). It is fitted by AdaGrad
on at most TRAIN_ROWS labelled rows outside the held-out fold; every document
is scored.

Neither labels nor language, source or id are inputs. Nulls and empty texts
are scored from their statistics alone; a null declared length counts as
missing. Without labelled rows every score is 0.5. Repeated rows score alike.
Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthloom.llm.common import Vocabulary, picked, text_bytes
from growthloom.llm.labels import fold_of, training_rows

BUCKETS = 1 << 16
TRAIN_ROWS = 10_000
FACTORS = 8
#: Passes over the rows: EPOCHS, more where the rows give fewer than STEPS steps.
EPOCHS, STEPS, BATCH, RATE, DECAY = 6, 400, 64, 0.08, 1e-5
PREDICT = 0.3
STATS = 16
_BYTES = {name: np.frombuffer(chars, np.uint8) for name, chars in {
    "blank": b" \t\n\x0b\x0c\r", "symbol": b"#*$%&|<>@^~_=+{}[]\\/", "stop": b".,;:!?", "loud": b"!?", "digit": b"0123456789",
    "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)),
}.items()}


def _ratio(a: float, b: float) -> float:
    return a / b if b else 0.0


def structure(text: bytes, words: list[bytes], hashes: np.ndarray, declared: float | None) -> list[float]:
    """STATS numbers, most between 0 and 1."""
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n = {k: int(count[v].sum()) for k, v in _BYTES.items()}
    n_words, chars = len(words), len(text) - int(count[0x80:0xC0].sum())
    letters = n["upper"] + n["lower"]
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    same = int((hashes[1:] == hashes[:-1]).sum()) if n_words > 1 else 0
    kinds = len(np.unique(hashes))
    pairs = np.unique(hashes[1:] * np.uint64(31) + hashes[:-1]) if n_words > 1 else hashes
    gap = 1.0 if declared is None else min(1.0, abs(declared - chars) / (chars + 1))
    return [
        1.0 if n_words else 0.0,
        min(1.0, np.log1p(n_words) / 10),
        1.0 if n_words < 20 else 0.0,
        1.0 if n_words < 50 else 0.0,
        min(1.0, _ratio(chars - n["blank"], n_words) / 20),
        min(1.0, _ratio(n["symbol"], n_words)),
        min(1.0, _ratio(n["stop"], n_words)),
        min(1.0, _ratio(n["loud"], n_words)),
        min(1.0, _ratio(n["digit"], chars) * 4),
        _ratio(n["upper"], letters),
        _ratio(same, n_words),
        1 - _ratio(kinds, n_words),
        1 - _ratio(len(pairs), max(1, n_words - 1)) if n_words > 1 else 0.0,
        1 - _ratio(len(set(lines)), len(lines)) if lines else 0.0,
        gap,
        1.0 if declared is None else 0.0,
    ]


def features(text: bytes, declared: float | None, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(indices, values) of a document: hashed words, then the statistics that aren't 0."""
    vocabulary.trim()
    words = text.split()
    hashes = vocabulary.hashed(words)
    index, times = np.unique((hashes & np.uint64(BUCKETS - 1)).astype(np.int64), return_counts=True)
    value = 1 + np.log(times)
    if len(value):
        value /= np.sqrt(value @ value)
    stats = np.array(structure(text, words, hashes, declared))
    on = np.flatnonzero(stats)
    return np.concatenate([index, BUCKETS + on]), np.concatenate([value, stats[on]])


class FactorisationMachine:
    """Weights of BUCKETS + STATS inputs; scores and gradients over flat rows (index, value, start of each row)."""

    def __init__(self, seed: int = 3):
        self.w0 = 0.0
        self.w = np.zeros(BUCKETS + STATS, np.float32)
        self.v = np.random.default_rng(seed).normal(0, 0.05, (BUCKETS + STATS, FACTORS)).astype(np.float32)

    def sums(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(scores, sum_i v_if x_i); every row has an input."""
        vx = self.v[index] * value[:, None]
        total = np.add.reduceat(vx, starts, axis=0)
        pairs = 0.5 * (total * total - np.add.reduceat(vx * vx, starts, axis=0)).sum(axis=1)
        return self.w0 + np.add.reduceat(self.w[index] * value, starts) + pairs, total

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 3) -> FactorisationMachine:
        rng = np.random.default_rng(seed)
        gw, gv, g0 = np.full_like(self.w, 1e-6), np.full_like(self.v, 1e-6), 1e-6
        rate = float(np.clip(labels.mean(), 0.01, 0.99))
        self.w0 = float(np.log(rate / (1 - rate)))
        for _ in range(max(EPOCHS, -(-STEPS * BATCH // len(rows)))):
            order = rng.permutation(len(rows))
            for lo in range(0, len(rows), BATCH):
                chosen = order[lo : lo + BATCH]
                sizes = np.array([len(rows[i][0]) for i in chosen])
                index = np.concatenate([rows[i][0] for i in chosen])
                value = np.concatenate([rows[i][1] for i in chosen]).astype(np.float32)
                starts = np.cumsum(sizes) - sizes
                score, total = self.sums(index, value, starts)
                off = ((1 / (1 + np.exp(-np.clip(score, -30, 30))) - labels[chosen]) / len(chosen)).astype(np.float32)
                of = np.repeat(np.arange(len(chosen)), sizes)
                slope = off[of] * value
                place, back = np.unique(index, return_inverse=True)
                dw = np.bincount(back, weights=slope, minlength=len(place)) + DECAY * self.w[place]
                dv_each = slope[:, None] * (total[of] - self.v[index] * value[:, None])
                by = np.argsort(back, kind="stable")
                dv = np.add.reduceat(dv_each[by], np.searchsorted(back[by], np.arange(len(place))), axis=0) + DECAY * self.v[place]
                gw[place] += dw * dw
                gv[place] += dv * dv
                self.w[place] -= RATE * dw / np.sqrt(gw[place])
                self.v[place] -= 0.5 * RATE * dv / np.sqrt(gv[place])
                g0 += float(off.sum()) ** 2
                self.w0 -= RATE * float(off.sum()) / np.sqrt(g0)
        return self


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, declared, text) -> (label, indices, values)."""
    vocabulary = Vocabulary()
    for batch in batches:
        rows = [features(t, d.as_py(), vocabulary) for t, d in zip(text_bytes(batch.column(2)), batch.column(1))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([i.astype("<u4").tobytes() for i, _ in rows], pa.binary()), pa.array([v.astype("<f4").tobytes() for _, v in rows], pa.binary())],
            names=["label", "i", "v"],
        )


def fit_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars") -> FactorisationMachine | None:
    """Fit on the driver, on the inputs of TRAIN_ROWS rows at most; null without rows of both labels."""
    columns = (text_col, length_col) if length_col else (text_col,)
    rows = training_rows(docs, labels, label_col, columns, TRAIN_ROWS, id_col)
    declared = F.col(length_col).cast("double") if length_col else F.lit(None).cast("double")
    vectors = rows.select(F.col("label").cast("int").alias("label"), declared.alias("d"), F.col(text_col).alias("t")).mapInArrow(_vectors, "label int, i binary, v binary")
    found = sorted(((r.label, bytes(r.i), bytes(r.v)) for r in vectors.toLocalIterator()), key=lambda r: (r[1], r[2]))
    usable = [(l, np.frombuffer(i, "<u4").astype(np.int64), np.frombuffer(v, "<f4")) for l, i, v in found if i]
    if len({r[0] for r in usable}) < 2:
        return None
    return FactorisationMachine().fit([(i, v) for _, i, v in usable], np.array([float(r[0] > 0) for r in usable]))


def quality_scores(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    machine = fit_quality(docs, labels, label_col, id_col, text_col, length_col)
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # BUCKETS x FACTORS floats
    if length_col:
        rows = picked(docs, id=id_col, d=length_col, t=text_col).withColumn("d", F.col("d").cast("double"))
    else:
        rows = picked(docs, id=id_col, t=text_col).select("id", F.lit(None).cast("double").alias("d"), "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, fm = Vocabulary(), shared.value
        for batch in batches:
            scores = []
            for text, d in zip(text_bytes(batch.column(2)), batch.column(1)):
                if fm is None:
                    scores.append(0.5)
                    continue
                index, value = features(text, d.as_py(), vocabulary)
                s = fm.sums(index, value, np.zeros(1, np.int64))[0][0] if len(index) else fm.w0
                scores.append(1 / (1 + np.exp(-float(np.clip(s, -30, 30)))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["id", "score"])

    scored = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, score double")
    return scored.select(F.col("id").alias(id_col), (fold_of(F.col("id")) == 0).alias("held_out"), "score", (F.col("score") >= PREDICT).cast("int").alias("predicted"))
