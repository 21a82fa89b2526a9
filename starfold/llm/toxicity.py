"""Toxicity by averaged subword embeddings and a linear softmax, trained jointly.

A word is the mean of the vectors of its character n-grams and of itself, so that a misspelling shares most of its
vector with the word. Vectors are averaged over windows of `WINDOW` words, as one insult would vanish in the mean of a
long text; a text scores as its worst window. A word that a window repeats counts once, with zero vectors in the place
of its repeats and at the end of a short window.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from starfold.llm.common import bounded, letter_words, mix, span_sums, steps, text_steps, word_grams

_log = logging.getLogger(__name__)

# Bounds of what a model is fitted on: labelled rows, and code points of their texts.
SAMPLE_ROWS = 3_000
SAMPLE_CHARS = 12_000_000
WINDOW = 16
BUCKETS = 1 << 15
WIDTH = 4
SIZES = (3, 4)
# Buckets of fewer training texts than this keep a zero vector: they could only learn those texts by heart.
LEAST_TEXTS = 8
BATCH = 512
# Words whose n-grams are hashed at a time.
STEP_WORDS = 20_000
# A phase of the training makes so many steps at least, in as many passes as that takes.
LEAST_STEPS = 300
THRESHOLD = 0.7


class Model(NamedTuple):
    buckets: np.ndarray  # what each bucket adds to the logit: its vector times the softmax weights
    bias: float


def word_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word's n-grams and of the word itself, and where each word's begin."""
    found, counts = [np.empty(0, np.int32)], [np.zeros(1, np.int64)]
    for first in range(0, len(words), STEP_WORDS):
        buckets, begins = _step_buckets(words[first : first + STEP_WORDS])
        found.append(buckets)
        counts.append(np.diff(begins))
    return np.concatenate(found), np.cumsum(np.concatenate(counts))


def _step_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    parts = []
    for n in SIZES:
        hashes, begins = word_grams(words, n)
        parts.append((hashes, np.repeat(np.arange(len(words)), np.diff(begins))))
    points, ends = "".join(words).encode("utf-32-le"), np.cumsum([len(w) for w in words])
    values = np.frombuffer(points, np.uint32).astype(np.uint64) + np.uint64(1)
    whole = span_sums(values, ends - np.diff(np.concatenate(([0], ends))), ends)
    parts.append((mix(whole ^ np.uint64(0xA0761D6478BD642F)), np.arange(len(words))))
    hashes, owner = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(owner, kind="stable")
    begins = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(words)))))
    return (hashes[order] % np.uint64(BUCKETS)).astype(np.int32), begins


def _expand(begins: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all entries of `items`, and the place in `items` that each belongs to."""
    counts = begins[items + 1] - begins[items]
    owner = np.repeat(np.arange(len(items)), counts)
    return np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + begins[items][owner], owner


class _Trainer:
    """Joint gradient steps with step sizes that shrink by each parameter's past gradients."""

    def __init__(self, buckets: np.ndarray, begins: np.ndarray, seen: np.ndarray, seed: int):
        """`seen`: whether each bucket has a vector that is learnt."""
        self.random = np.random.default_rng(seed)
        self.buckets, self.begins, self.seen = buckets, begins, seen[:, None]
        self.vectors = self.random.normal(0, 0.1, (BUCKETS, WIDTH)) * self.seen
        self.weights = self.random.normal(0, 0.1, (WIDTH, 2))
        self.bias = np.zeros(2)
        self.past = [np.full(x.shape, 1e-6) for x in (self.vectors, self.weights, self.bias)]

    def epoch(self, words: np.ndarray, ends: np.ndarray, chosen: np.ndarray, labels: np.ndarray, rate: float) -> None:
        """One pass over the windows `chosen`; window i has the words from ends[i] to ends[i + 1]."""
        for part in np.array_split(self.random.permutation(chosen), max(1, len(chosen) // BATCH)):
            at, owner = _expand(ends, part)
            entries, word = _expand(self.begins, words[at])
            share = 1.0 / (np.bincount(word, minlength=len(at))[word] * WINDOW)
            bucket, window = self.buckets[entries], owner[word]
            means = np.empty((len(part), WIDTH))
            for j in range(WIDTH):
                means[:, j] = np.bincount(window, self.vectors[bucket, j] * share, len(part))
            logits = means @ self.weights + self.bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(part)), labels[part]] -= 1
            back = p @ self.weights.T
            grown = np.empty((BUCKETS, WIDTH))
            for j in range(WIDTH):
                grown[:, j] = np.bincount(bucket, back[window, j] * share, BUCKETS)
            grown *= self.seen
            self.past[0] += grown**2
            self.vectors -= rate * grown / np.sqrt(self.past[0])
            for k, (value, gradient) in enumerate(((self.weights, means.T @ p), (self.bias, p.sum(axis=0))), 1):
                gradient = gradient / len(part)
                self.past[k] += gradient**2
                value -= rate * gradient / np.sqrt(self.past[k])

    def model(self) -> Model:
        return Model(self.vectors @ (self.weights[:, 1] - self.weights[:, 0]), float(self.bias[1] - self.bias[0]))


def _windows(codes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of every window, where each window's begin, and its text; each text's last may be short."""
    n = np.diff(begins)
    counts = -(-n // WINDOW)
    text = np.repeat(np.arange(len(n)), counts)
    first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    of_word = np.repeat(np.arange(len(n)), n)
    window = first[of_word] + (np.arange(len(codes)) - begins[:-1][of_word]) // WINDOW
    size = int(codes.max()) + 1
    pairs = np.unique(window * size + codes)
    return pairs % size, np.concatenate(([0], np.cumsum(np.bincount(pairs // size, minlength=len(text))))), text


def _window_logits(model: Model, distinct: list[str], words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    buckets, begins = word_buckets(distinct)
    total = np.concatenate(([0.0], np.cumsum(model.buckets[buckets])))
    each = (total[begins[1:]] - total[begins[:-1]]) / np.maximum(np.diff(begins), 1)
    summed = np.concatenate(([0.0], np.cumsum(each[words])))
    return (summed[ends[1:]] - summed[ends[:-1]]) / WINDOW + model.bias


def _word_codes(texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """As `letter_words`, but in steps, so that of all words only the distinct ones are in memory at once."""
    known: dict[str, int] = {}
    codes, sizes = [np.empty(0, np.int64)], [np.zeros(1, np.int64)]
    for first, end in text_steps(texts):
        part, distinct, begins = letter_words(texts[first:end])
        places = np.array([known.setdefault(w, len(known)) for w in distinct], np.int64)
        codes.append(places[part] if len(part) else np.empty(0, np.int64))
        sizes.append(np.diff(begins))
    return np.concatenate(codes), list(known), np.cumsum(np.concatenate(sizes))


def train(texts: list[str], labels: list[int], epochs: int = 2, rate: float = 0.3, seed: int = 7) -> Model | None:
    """A model, or None if the texts have no words or only one label.

    In the first epochs every window has its text's label. After that the model itself picks what makes a text
    toxic: its worst window and those that it holds to be toxic; the other windows of toxic texts are left out.
    """
    codes, distinct, begins = _word_codes(texts)
    toxic = np.asarray(labels, np.int64)
    if not len(codes) or len(set(labels)) < 2:
        return None
    words, windows, text = _windows(codes, begins)
    buckets, ends = word_buckets(distinct)
    in_texts = np.zeros(BUCKETS, np.int64)
    for first, end in zip(begins, begins[1:]):
        in_texts[np.unique(buckets[_expand(ends, np.unique(codes[first:end]))[0]])] += 1
    trainer = _Trainer(buckets, ends, in_texts >= LEAST_TEXTS, seed)
    passes = max(epochs, -(-LEAST_STEPS // max(1, len(text) // BATCH)))
    for _ in range(passes):
        trainer.epoch(words, windows, np.arange(len(text)), toxic[text], rate)
    for _ in range(passes):
        logits = _window_logits(trainer.model(), distinct, words, windows)
        worst = np.full(len(texts), -np.inf)
        np.maximum.at(worst, text, logits)
        chosen = np.flatnonzero((toxic[text] == 0) | (logits >= worst[text]) | (logits > 0))
        trainer.epoch(words, windows, chosen, toxic[text], rate)
    return trainer.model()


def score(model: Model | None, texts: list[str]) -> np.ndarray:
    """Score of each text from 0 to 1: that of its worst window; a text without a word scores 0."""
    codes, distinct, begins = letter_words(texts)
    out = np.zeros(len(texts))
    if model is None or not len(codes):
        return out
    words, windows, text = _windows(codes, begins)
    logits = _window_logits(model, distinct, words, windows)
    np.maximum.at(out, text, 1.0 / (1.0 + np.exp(-np.clip(logits, -50, 50))))
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="toxic",
        sample_rows=SAMPLE_ROWS, sample_chars=SAMPLE_CHARS) -> Model | float | None:
    """A model of the labelled rows of `docs`; None if `docs` has no labelled row.

    It is fitted on `sample_rows` ids at most, those with the least hashes. If their texts together have more than
    `sample_chars` code points, the longest ones are left out, as few as bring the rest below it, so a very long text
    never takes the place of the others. Only the ids of labels are sorted; texts are fetched for the chosen ones.
    A label of null is no label; an id with several labels counts as toxic if one of them is 1. Labelled rows that no
    model can be learnt from, as all have one label or no words, give their share of label 1, which is logged.
    """
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(chosen), "id")
    sizes = rows.groupBy("id").agg(F.sum(F.length("text")).alias("size")).toPandas()
    if sizes.empty:
        return None
    sizes["order"] = pd.util.hash_array(sizes["id"].to_numpy())
    sizes = sizes.sort_values(["size", "order", "id"])
    kept = sizes[sizes["size"].cumsum() <= sample_chars]["id"]
    model = None
    if len(kept):
        part = docs.sparkSession.createDataFrame(pd.DataFrame({"id": kept}))
        sample = rows.join(F.broadcast(part), "id").toPandas().sort_values(["id", "text"])
        model = train(sample["text"].tolist(), sample["label"].tolist())
    if model is None:
        toxic = float(rows.agg(F.avg("label")).first()[0])
        _log.warning("no toxicity model from %d of %d labelled texts; all score %.2f", len(kept), len(sizes), toxic)
        return toxic
    return model


def rate(docs: DataFrame, model: Model | float | None, id_col="doc_id", text_col="text", threshold=THRESHOLD) -> DataFrame:
    """(id_col, score, predicted) of every row; predicted is 1 where score is at least `threshold`.

    Null and empty texts, texts without letters, and all texts if there is no model score 0; all score alike if the model
    is but a share. Equal texts score alike.
    Extra columns are ignored; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for step in steps(batches, "text"):
            known = shared.value
            texts = step["text"].tolist()
            found = np.full(len(texts), known) if isinstance(known, float) else score(known, texts)
            yield pd.DataFrame({"id": step["id"], "score": found, "predicted": (found >= threshold).astype("int32")})

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInPandas(bounded(run), f"id {kind}, score double, predicted int").withColumnRenamed("id", id_col)
