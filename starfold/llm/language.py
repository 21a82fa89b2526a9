"""Language of a text by known words, with shorter and shorter character n-grams for words that are not known."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from starfold.llm.common import LETTERS, bounded, letter_words, stored, text_steps, word_grams

# Bounds of what a model is fitted on and how large it may get.
SAMPLE_ROWS = 6_000
KNOWN_WORDS = 60_000
SIZES = (5, 4, 3, 2, 1)
UNDETERMINED = "und"


class Model(NamedTuple):
    languages: list[str]
    words: dict[str, int]
    word_scores: np.ndarray  # log frequency of each known word by language
    grams: dict[int, tuple[np.ndarray, np.ndarray]]  # by size: sorted hashes, log frequencies by language


def _log_frequencies(counts: np.ndarray) -> np.ndarray:
    return np.log((counts + 0.5) / (counts.sum(axis=0, keepdims=True) + 0.5 * len(counts)))


def fit(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample_rows=SAMPLE_ROWS, known_words=KNOWN_WORDS):
    """A model of the languages in `docs`, or None if no row has both a language and a word.

    It is fitted on `sample_rows` rows at most, those whose ids have the least hashes. Spark counts their words;
    the most frequent words of each language come to the driver, `known_words` in all and as many of each language, and
    n-grams are counted from them.
    """
    known = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    ids = known.select(F.col(id_col).alias("id")).orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    sample = known.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    sample = sample.join(F.broadcast(ids.distinct()), sample["id"].eqNullSafe(ids["id"]), "left_semi")
    words = sample.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(LETTERS), F.lit(0))).alias("word"))
    counts = stored(words.groupBy("lang", "word").count(), "word-counts")
    n_languages = counts.select("lang").distinct().count()
    if not n_languages:
        return None
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("count"), "word"))
    rows = counts.withColumn("rank", rank).filter(F.col("rank") <= max(1, known_words // n_languages)).drop("rank").toPandas()
    languages = sorted(rows["lang"].unique())
    table = rows.pivot_table(index="word", columns="lang", values="count", aggfunc="sum", fill_value=0)[languages]
    distinct, amounts = list(table.index), table.to_numpy(dtype=float)
    grams = {}
    for n in SIZES:
        hashes, begins = word_grams(distinct, n)
        each, place = np.unique(hashes, return_inverse=True)
        sums = np.zeros((len(each), len(languages)))
        np.add.at(sums, place, np.repeat(amounts, np.diff(begins), axis=0))
        grams[n] = each, _log_frequencies(sums) if len(each) else sums
    return Model(languages, {w: i for i, w in enumerate(distinct)}, _log_frequencies(amounts), grams)


def word_scores(model: Model, words: list[str]) -> np.ndarray:
    """A row of log frequencies for each word. A word that is not known takes the mean of its n-grams of the largest
    size of which the model knows any; one without any known n-gram says nothing (zeros)."""
    places = np.array([model.words.get(w, -1) for w in words], np.int64)
    out = np.zeros((len(words), len(model.languages)))
    out[places >= 0] = model.word_scores[places[places >= 0]]
    open_ = np.flatnonzero(places < 0)
    for n in SIZES:
        known, scores = model.grams[n]
        if not len(open_) or not len(known):
            continue
        hashes, begins = word_grams([words[i] for i in open_], n)
        owner = np.repeat(np.arange(len(open_)), np.diff(begins))
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        hit = known[at] == hashes
        counts = np.bincount(owner[hit], minlength=len(open_))
        for j in range(len(model.languages)):
            sums = np.bincount(owner[hit], scores[at[hit], j], len(open_))
            out[open_, j] = np.divide(sums, counts, out=np.zeros(len(open_)), where=counts > 0)
        open_ = open_[counts == 0]
    return out


def predict(model: Model | None, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text; the score is the language's share under the words' mean evidence."""
    codes, distinct, begins = letter_words(texts)
    n_words = np.diff(begins)
    if model is None or not len(codes):
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    each = word_scores(model, distinct)[codes]
    total = np.concatenate((np.zeros((1, each.shape[1])), np.cumsum(each, axis=0)))
    mean = (total[begins[1:]] - total[begins[:-1]]) / np.maximum(n_words, 1)[:, None]
    evidence = mean * np.minimum(n_words, 20)[:, None]
    share = np.exp(evidence - evidence.max(axis=1, keepdims=True))
    share /= share.sum(axis=1, keepdims=True)
    best = share.argmax(axis=1)
    names = [model.languages[b] if n else UNDETERMINED for b, n in zip(best, n_words)]
    return names, np.where(n_words > 0, share.max(axis=1), 0.0)


def identify(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """`docs` with lang_pred and score after its other columns; columns of these names are replaced.

    A text that is null or has no letter is `und` with score 0, as is every text if there is no model. Equal texts
    get equal results; ties between languages go to the first by name. An empty table stays empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")])
    place = rows.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(place).to_pylist()]
            for first, end in text_steps(texts):
                names, scores = predict(shared.value, texts[first:end])
                part = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=[*part.schema.names, "lang_pred", "score"],
                )

    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return rows.mapInArrow(bounded(run), T.StructType([*rows.schema.fields, *added]))
