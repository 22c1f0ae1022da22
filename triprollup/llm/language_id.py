"""Language of a text by a bidirectional gated recurrent network over its bytes.

One network reads windows of bytes forwards, one backwards; at each byte their states give
scores for the languages, so every position gets a label. Mean log-probabilities over all
positions of a text give its language. The cell has an update gate z:

    z, c = sigmoid(byte row + U h), tanh(byte row' + U' h);  h <- h + z (c - h)

Training is numpy on the driver, by backpropagation through time over windows of a bounded
sample of labelled texts. Prediction runs on Spark over all bytes of all texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from triprollup.llm.batches import released, slices
from triprollup.llm.tables import crc_of_id
from triprollup.llm.tokens import chunks

UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2
WINDOW = 128
#: The sample: so many texts of a language at most, and of all together, but of each language
#: so many at least; and so many characters of each, cut out at a place that the id decides.
TEXTS_PER_LANGUAGE, SAMPLE_TEXTS, LEAST_TEXTS = 250, 32_000, 8
SAMPLE_CHARS = 1_000
#: Units of a direction at least, and steps of learning; more with many languages.
HIDDEN, STEPS = 8, 400
BATCH = 256
LEARN_WINDOW = 48
#: How far from a draw among all languages to a certain one a text's score must be.
DOUBT = 2 / 15


@dataclass
class Direction:
    """Weights of one direction. rows: of each byte, gate half first; gates are halved logits."""

    rows: np.ndarray  # 256 x 2H
    turn: np.ndarray  # H x 2H
    out: np.ndarray  # H x C

    def forward(self, text: np.ndarray, keep: bool = False):
        """States' logits (T, B, C) for bytes (T, B); with keep, what backward needs."""
        steps, width = text.shape
        size = self.turn.shape[0]
        h = np.zeros((width, size), np.float32)
        logits = np.empty((steps, width, self.out.shape[1]), np.float32)
        trace = []
        for t in range(steps):
            a = self.rows[text[t]]
            a += h @ self.turn
            np.tanh(a, out=a)
            z = a[:, :size] * np.float32(0.5)
            z += np.float32(0.5)
            c = a[:, size:]
            if keep:
                trace.append((h, z, c))
            h = h + z * (c - h)
            np.matmul(h, self.out, out=logits[t])
        return (logits, trace, h) if keep else logits

    def backward(self, text: np.ndarray, trace: list, last: np.ndarray, d_logits: np.ndarray):
        """Gradients of rows, turn and out."""
        g_rows, g_turn = np.zeros_like(self.rows), np.zeros_like(self.turn)
        g_out, dh, after = np.zeros_like(self.out), np.zeros_like(last), last
        for t in range(len(trace) - 1, -1, -1):
            h, z, c = trace[t]
            g_out += after.T @ d_logits[t]
            dh = dh + d_logits[t] @ self.out.T
            # z = (1 + tanh(a)) / 2, so dz/da = 2 z (1 - z).
            da = np.concatenate([dh * (c - h) * 2 * z * (1 - z), dh * z * (1 - c * c)], axis=1)
            np.add.at(g_rows, text[t], da)
            g_turn += h.T @ da
            dh = dh * (1 - z) + da @ self.turn.T
            after = h
        return g_rows, g_turn, g_out


@dataclass
class Tagger:
    languages: list[str]
    ahead: Direction
    back: Direction
    bias: np.ndarray
    #: Texts that score less are in doubt; see `fit`.
    least: float = 0.0

    def position_log_probs(self, text: np.ndarray) -> np.ndarray:
        """(T, B, C) for windows of bytes in columns (T, B)."""
        scores = self.ahead.forward(text)
        scores += self.back.forward(text[::-1])[::-1]
        scores += self.bias
        scores -= scores.max(axis=2, keepdims=True)
        scores -= np.log(np.exp(scores).sum(axis=2, keepdims=True))
        return scores

    def predict(self, texts: list[bytes], part: int = 1 << 18) -> list[tuple[int, float]]:
        """Language number and mean probability at a position, for texts that are not empty."""
        out: list[tuple[int, float]] = []
        for first, last in chunks([len(t) for t in texts], part):
            out.extend(self._pooled(texts[first:last], part // WINDOW))
        return out

    def _pooled(self, texts: list[bytes], width: int) -> list[tuple[int, float]]:
        sizes = np.array([len(t) for t in texts])
        windows = -(-sizes // WINDOW)
        owner = np.repeat(np.arange(len(texts)), windows)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        filled = np.minimum(WINDOW, sizes[owner] - nth * WINDOW)
        flat = np.frombuffer(b"".join(texts), np.uint8)
        # A short window is filled up with its own bytes, which are read but not counted.
        first = (np.cumsum(filled) - filled)[:, None]
        data = flat[first + np.arange(WINDOW) % filled[:, None]]
        classes = len(self.languages)
        logs, shares = np.zeros((2, len(texts), classes))
        # A long text is many windows; so many are read side by side at a time.
        for at in range(0, len(owner), width):
            some = slice(at, at + width)
            found = self.position_log_probs(np.ascontiguousarray(data[some].T))
            inside = (np.arange(WINDOW)[:, None] < filled[some]).astype(np.float32)
            np.add.at(logs, owner[some], np.einsum("tbc,tb->bc", found, inside))
            np.exp(found, out=found)
            np.add.at(shares, owner[some], np.einsum("tbc,tb->bc", found, inside))
        best = logs.argmax(axis=1)
        score = shares[np.arange(len(texts)), best] / sizes
        return [(int(b), float(s)) for b, s in zip(best, score)]


def train(
    texts: list[bytes],
    labels: list[str],
    hidden: int | None = None,
    steps: int | None = None,
    seed: int = 7,
) -> Tagger | None:
    """Adam on windows drawn evenly over languages; None without a text to learn from.

    Units and steps follow the number of languages unless they are given.
    """
    pairs = [(t, x) for t, x in zip(texts, labels) if t]
    if not pairs:
        return None
    languages = sorted({x for _, x in pairs})
    rng, classes = np.random.default_rng(seed), len(languages)
    hidden = hidden or max(HIDDEN, 2 * math.isqrt(classes))
    steps = steps or STEPS * math.ceil(max(1.0, classes / 16) ** 0.5)
    by_language = [[t for t, x in pairs if x == name] for name in languages]

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    def direction() -> Direction:
        return Direction(
            normal(256, 2 * hidden, scale=0.3),
            normal(hidden, 2 * hidden, scale=0.3),
            normal(hidden, classes, scale=0.3),
        )

    model = Tagger(languages, direction(), direction(), np.zeros(classes, np.float32))
    weights = [model.bias]
    for d in (model.ahead, model.back):
        weights += [d.rows, d.turn, d.out]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    for step in range(1, steps + 1):
        label = rng.integers(classes, size=BATCH)
        window = np.zeros((LEARN_WINDOW, BATCH), np.uint8)
        inside = np.zeros((LEARN_WINDOW, BATCH), np.float32)
        for b, x in enumerate(label):
            text = by_language[x][rng.integers(len(by_language[x]))]
            first = rng.integers(max(1, len(text) - LEARN_WINDOW + 1))
            cut = text[first : first + LEARN_WINDOW]
            window[: len(cut), b] = np.frombuffer(cut, np.uint8)
            inside[: len(cut), b] = 1
        ahead, trace_a, last_a = model.ahead.forward(window, keep=True)
        turned = window[::-1]
        back, trace_b, last_b = model.back.forward(turned, keep=True)
        scores = ahead + back[::-1] + model.bias
        scores -= scores.max(axis=2, keepdims=True)
        probs = np.exp(scores)
        probs /= probs.sum(axis=2, keepdims=True)
        probs[:, np.arange(BATCH), label] -= 1
        d = probs * (inside / inside.sum())[:, :, None]
        gradients = [d.sum(axis=(0, 1))]
        gradients += model.ahead.backward(window, trace_a, last_a, d)
        gradients += model.back.backward(turned, trace_b, last_b, d[::-1])
        rate = 0.02 * (1 - step / (steps + 1))
        for w, g, (m, v) in zip(weights, gradients, moments):
            g = np.clip(g, -1, 1)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return model


def least_score(languages: int) -> float:
    """The score below which a text's language is in doubt, whatever the number of languages.

    A text about which nothing is known scores 1 / languages, one that is certain 1.
    """
    return 1 / languages + DOUBT * (1 - 1 / languages)


def labelled_sample(docs: DataFrame, per_language: int | None = None) -> DataFrame:
    """lang and a cut of text of each language's `per_language` first texts by a hash of the id.

    Every label is in it. Left to itself, `per_language` follows the number of labels, so that
    the sample has SAMPLE_TEXTS rows at most, or LEAST_TEXTS of each label.
    """
    labelled = docs.filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
    ).filter(crc_of_id() % FOLDS != HELD_OUT)
    if per_language is None:
        spread_over = SAMPLE_TEXTS // max(labelled.select("lang").distinct().count(), 1)
        per_language = max(LEAST_TEXTS, min(TEXTS_PER_LANGUAGE, spread_over))
    draw = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30))
    spread = F.pmod(F.xxhash64(F.lit("place"), "doc_id"), F.lit(1 << 30))
    room = F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1
    cut = F.substring(F.col("text"), (spread % room + 1).cast("int"), F.lit(SAMPLE_CHARS))

    def first(rows: DataFrame, *order: str) -> DataFrame:
        # Spark takes so many of each task before it shuffles.
        rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
        return rows.withColumn("_rank", rank).filter(F.col("_rank") <= per_language).drop("_rank")

    # How far to draw, from the draws alone: a row for each label, which the model holds anyway.
    drawn = first(labelled.select("lang", draw.alias("_draw")), "_draw")
    bounds = drawn.groupBy("lang").agg(F.max("_draw").alias("_last"))
    near = labelled.withColumn("_draw", draw).join(F.broadcast(bounds), "lang").filter("_draw <= _last")
    near = near.select("lang", cut.alias("text"), "_draw", F.xxhash64("doc_id", "text").alias("_order"))
    # Once more, as many rows may share an id.
    chosen = first(near, "_draw", "_order", "text")
    return chosen.orderBy("_order", "lang", "text").select("lang", "text")


def fit(docs: DataFrame, **options) -> Tagger | None:
    """A tagger learned from the texts and languages of the training folds, of every label there.

    None without a label. Of languages that fit a text equally well the first by name is taken.
    Its bound of doubt is `least_score`, or less where the sample's own texts score low: half of the
    way from a draw to what all but one in a hundred of them score. A model that is in doubt of
    these texts itself, as with labels that say nothing, has no bound, and no text is in doubt.
    """
    rows = labelled_sample(docs).collect()
    texts = [r["text"].encode() for r in rows]
    model = train(texts, [r["lang"] for r in rows], **options)
    if model is not None:
        draw = 1 / len(model.languages)
        low = np.quantile([score for _, score in model.predict([t for t in texts if t])], 0.01)
        least = least_score(len(model.languages))
        model.least = float(min(least, (draw + low) / 2)) if low >= least else 0.0
    return model


def held_out() -> Column:
    return F.coalesce(crc_of_id() % FOLDS == HELD_OUT, F.lit(False))


def identify(docs: DataFrame, model: Tagger | None, keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (default: all) of docs, with lang_pred and score.

    A text that is null or has no letter, or any text without a model, is `und` at score 0.
    Prediction reads the text alone. Columns of docs named lang_pred or score are replaced.
    Repeated rows are predicted each; an empty table gives no rows.
    """
    names = [c for c in (keep or docs.columns) if c not in ("lang_pred", "score")]
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(
        F.struct(*names).alias("row"),
        F.when(letters, F.col("text").cast("binary")).alias("text"),
    )

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text")):
            texts = batch.column("text").to_pylist()
            at = [i for i, t in enumerate(texts) if t and model]
            languages, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if at:
                for i, (k, score) in zip(at, model.predict([texts[i] for i in at])):
                    languages[i], scores[i] = model.languages[k], round(min(score, 1.0), 6)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(languages), pa.array(scores, pa.float64())],
                names=["row", "lang_pred", "score"],
            )

    schema = StructType([rows.schema["row"]]).add("lang_pred", StringType()).add("score", DoubleType())
    return rows.mapInArrow(lambda batches: released(label(batches)), schema).select("row.*", "lang_pred", "score")
