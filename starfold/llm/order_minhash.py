"""Near duplicates by order MinHash: sketches that keep the text order of sampled word sequences.

Every text is cut into sequences of five words, each labelled with the number of its earlier occurrences. For
each of `SKETCHES` seeds, the labelled sequences with the least hashes are taken (`KEPT` of all, and `KEPT_NEW` more
that stand for the first time) and hashed together in the order in which they stand in the text, so that texts agree
in a sketch the likelier the smaller their edit distance. Texts that agree in a sketch are candidates, and short texts that
share a sequence; a banded alignment of their words decides.

Groups of candidates are never compared pair by pair as a whole. In three rounds one text leads each group and is aligned with
the others, which joins copies however many there are. Of the groups that still hold several components, those with few
nodes outside the largest are compared whole. The texts of the others have something in common that does not make them alike,
such as a line or a passage. They are compared when they share a rare run of words, and a text waits for a shorter run only
while its frequent runs alone could make it alike to another; so no pair is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from starfold.llm.common import BROADCAST_IDS, bounded, hashed_words, mix, small_side, span_sums, steps, stored
from starfold.llm.components import components

WORDS = 5
KEPT = 1
KEPT_NEW = 1
SKETCHES = 64
SIMILARITY = 0.8
# Least share of distinct sequences in common: about what is left of them if the edits lie evenly in the text.
DISTINCT = 0.2

# Texts of at most so many sequences are also compared by single sequences: a sketch is likely to miss one in common.
FEW = 9
# A group with at most so many nodes outside its largest component is compared whole; a run of words with more is frequent.
FEW_COMPONENTS = 32
# Words of the runs by which the texts of other groups are compared, one after the other.
RUNS = (WORDS, 3, 2, 1)
# Runs of several components that are sent to all tasks (4 MB); more are joined.
LISTED = 500_000

_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
_ODD = np.uint64(0xD6E8FEB86659FD93)
_SINGLE = np.uint64(0xA24BAED4963EE407)


def sequences(words: np.ndarray, begins: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word sequences of all texts in text order, and where each text's begin.

    A text of fewer than k words, but not none, has one sequence of all its words.
    """
    n = np.diff(begins)
    counts = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    bounds = np.concatenate(([0], np.cumsum(counts)))
    text = np.repeat(np.arange(len(n)), counts)
    starts = begins[:-1][text] + np.arange(bounds[-1]) - bounds[:-1][text]
    return mix(span_sums(words, starts, np.minimum(starts + k, begins[1:][text]))), bounds


def earlier_occurrences(found: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How often each sequence stands earlier in its own text."""
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    key = mix(found + text.astype(np.uint64) * _ODD)
    order = np.argsort(key, kind="stable")
    run = np.arange(len(order))
    first = np.ones(len(order), bool)
    first[1:] = key[order][1:] != key[order][:-1]
    earlier = np.empty(len(order), np.int64)
    earlier[order] = run - np.maximum.accumulate(np.where(first, run, 0))
    return earlier


def _ranks(text: np.ndarray) -> np.ndarray:
    """Place of each element among those of its text; elements of a text stand together."""
    run = np.arange(len(text))
    new = np.ones(len(text), bool)
    new[1:] = text[1:] != text[:-1]
    return run - np.maximum.accumulate(np.where(new, run, 0))


def sketches(found: np.ndarray, bounds: np.ndarray, kept: int, kept_new: int, n_sketches: int) -> np.ndarray:
    """One row of sketches for each text; texts without any sequence have a row of zeros.

    A sketch takes the `kept` least labelled sequences, and the `kept_new` least of the others that stand for the
    first time: a line that is repeated often fills the first part, but not the second.
    """
    counts = np.diff(bounds)
    out = np.zeros((len(counts), n_sketches), np.uint64)
    if not len(found):
        return out
    earlier = earlier_occurrences(found, bounds)
    labels = mix(found + earlier.astype(np.uint64) * _ODD)
    new = earlier == 0
    text = np.repeat(np.arange(len(counts)), counts)
    n_new = np.bincount(text, new, len(counts))
    # Only values below a bound can be among the least; about four times as many as are taken, or all of a short text.
    share = np.minimum(1.0, 4.0 * np.maximum(kept, kept_new + kept) / np.maximum(np.minimum(counts, n_new), 1))
    bound = np.where(share < 1, (share * 2.0**63).astype(np.uint64) * np.uint64(2), _TOP)[text]
    seeds = mix(np.arange(1, 2 * n_sketches + 1, dtype=np.uint64) * _ODD)
    enough_all, enough_new = np.minimum(counts, kept), np.minimum(n_new, kept + kept_new)
    for s in range(n_sketches):
        values = (labels ^ seeds[2 * s]) * (seeds[2 * s + 1] | np.uint64(1))
        at = np.flatnonzero(values <= bound)
        few = (np.bincount(text[at], minlength=len(counts)) < enough_all) | (
            np.bincount(text[at], new[at], len(counts)) < enough_new
        )
        if few.any():
            at = np.flatnonzero((values <= bound) | few[text])
        at = at[np.lexsort((values[at], text[at]))]
        taken = _ranks(text[at]) < kept
        others = np.flatnonzero(~taken & new[at])
        taken[others[_ranks(text[at[others]]) < kept_new]] = True
        places = np.sort(at[taken])
        # The chosen ones in text order, folded into one number for each text.
        hashed = mix(labels[places] + (_ranks(text[places]).astype(np.uint64) + np.uint64(1)) * _ODD)
        first = np.flatnonzero(np.concatenate(([True], text[places][1:] != text[places][:-1])))
        out[text[places][first], s] = mix(np.add.reduceat(hashed, first) ^ seeds[2 * s])
    return out


def single_sequences(found: np.ndarray, bounds: np.ndarray, most: int) -> list[np.ndarray]:
    """For each text of at most `most` sequences one value for each distinct sequence; none for longer texts."""
    values = mix(found ^ _SINGLE)
    none = np.empty(0, np.uint64)
    return [np.unique(values[a:b]) if b - a <= most else none for a, b in zip(bounds[:-1], bounds[1:])]


def _sketch_batches(k: int, kept: int, kept_new: int, n_sketches: int, similarity: float):
    # The longest near duplicate of a text of `FEW` sequences has `most`.
    most = max(FEW, int((FEW + k - 1) / max(similarity, 1e-6) + 1e-6) - k + 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in steps(batches, "text"):
            words, begins = hashed_words(batch["text"].tolist())
            found = sequences(words, begins, k)
            values = zip(sketches(*found, kept, kept_new, n_sketches), single_sequences(*found, most))
            second = span_sums(mix(words + _ODD), begins[:-1], begins[1:]).view(np.int64)
            yield pd.DataFrame(
                {
                    "id": batch["id"],
                    "words_a": span_sums(words, begins[:-1], begins[1:]).view(np.int64),
                    "words_b": second,
                    "n_words": np.diff(begins),
                    "sketches": [np.concatenate(v).view(np.int64) for v in values],
                }
            )

    return run


def edit_distance(a: list, b: list, limit: int) -> int:
    """Edit distance of two sequences if it is at most `limit`, else `limit` + 1.

    Only cells within `limit` of the diagonal are computed: a row of the band is one number of 2 * limit + 1 bits,
    which moves one place along `a` for each element of `b`.
    """
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    if len(a) < len(b):
        a, b = b, a
    if not b or not limit:
        return min(len(a), limit + 1)
    limit = min(limit, len(a))
    width = 2 * limit + 1
    band = (1 << width) - 1
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    # In step j, bit p stands for element j - limit + p of `a`. The score follows the band's upper edge until that
    # leaves `a`, and then the last element of `a`, which lies one bit lower after each step.
    plus, minus = band & ~((1 << limit) - 1), 0
    score, edge, last = limit, 1 << (width - 1), 1 << (width - 2)
    steps_along = len(a) - limit
    for j, x in enumerate(b):
        match = places.get(x, 0)
        match = (match >> (j - limit) if j >= limit else match << (limit - j)) & band
        diagonal = ((((match & plus) + plus) ^ plus) | match | minus) & band
        right_plus = (minus | ~(diagonal | plus)) & band
        right_minus = diagonal & plus
        if j < steps_along:
            score += not diagonal & edge
            if score > 2 * limit + len(b) - len(a):
                return limit + 1
        else:
            score += bool(right_plus & last) - bool(right_minus & last)
            last >>= 1
        diagonal >>= 1
        plus = (right_minus | ~(diagonal | right_plus)) & band
        minus = diagonal & right_plus
    return min(score, limit + 1)


def word_distance(a: np.ndarray, b: np.ndarray, similarity: float) -> int:
    """Edit distance of two texts' hashed words, or -1 if it is above the share that `similarity` leaves.

    Also -1 if the texts share less than `DISTINCT` of their distinct sequences: a line that both repeat many times
    does not make them alike.
    """
    longest = max(len(a), len(b))
    limit = int(longest * (1 - similarity) + 1e-9)
    if abs(len(a) - len(b)) > limit:
        return -1
    if np.array_equal(a, b):
        return 0
    if longest >= WORDS:
        distinct = [np.unique(sequences(x, np.array([0, len(x)]), WORDS)[0]) for x in (a, b)]
        common = len(np.intersect1d(*distinct, assume_unique=True))
        if common < DISTINCT * (len(distinct[0]) + len(distinct[1]) - common):
            return -1
    # Words that are not shared, with repeats, are a lower bound of the distance.
    a_words, a_counts = np.unique(a, return_counts=True)
    b_words, b_counts = np.unique(b, return_counts=True)
    _, at_a, at_b = np.intersect1d(a_words, b_words, assume_unique=True, return_indices=True)
    if longest - int(np.minimum(a_counts[at_a], b_counts[at_b]).sum()) > limit:
        return -1
    found = edit_distance(a.tolist(), b.tolist(), limit)
    return found if found <= limit else -1


def _verify_batches(similarity: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in steps(batches, "text_b"):
            words, begins = hashed_words([*batch["text_a"], *batch["text_b"]])
            n = len(batch)
            far = [
                word_distance(words[begins[i] : begins[i + 1]], words[begins[n + i] : begins[n + i + 1]], similarity)
                for i in range(n)
            ]
            kept = np.array(far, np.int64) >= 0
            yield batch.loc[kept, ["a", "b"]]

    return run


def sketch_table(
    docs: DataFrame, id_col: str, text_col: str, k=WORDS, kept=KEPT, kept_new=KEPT_NEW, n_sketches=SKETCHES,
    similarity=SIMILARITY,
) -> DataFrame:
    """(id, words_a, words_b, n_words, sketches) of every row; the two words_ columns are a 128-bit hash of its words.

    The sketches of texts of few sequences are followed by the values of their single sequences.
    """
    schema = "id long, words_a long, words_b long, n_words long, sketches array<long>"
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return stored(rows.mapInPandas(bounded(_sketch_batches(k, kept, kept_new, n_sketches, similarity)), schema), "sketches")


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    # First the leaders' texts, then the others': few pairs share a `b`, so the alignments spread over all tasks.
    def side(name: str) -> DataFrame:
        # Texts of no pair are left out before the shuffle.
        used = texts.join(small_side(pairs.select(F.col(name).alias("node")).distinct()), "node", "left_semi")
        return used.select(F.col("node").alias(name), F.col("text").alias(f"text_{name}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b")
    return both.mapInPandas(bounded(_verify_batches(similarity)), "a long, b long")


def _open(members: DataFrame, names: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """(value, node, n_words, component) of the groups of `members`, or those `among` these values, that hold several components."""
    named = members.select("value", "node", "n_words").join(names, "node")
    bounds = named.groupBy("value").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    several = bounds.filter("low != high").select("value")
    if among is not None:
        several = several.join(among, "value")
    return stored(named.join(several, "value", "left_semi").select("value", "node", "n_words", "component"), "open")


def _parts(members: DataFrame) -> DataFrame:
    """(value, component, n_nodes, head, head_words) of the open groups of `members`."""
    order = F.struct(F.xxhash64("node"), "node", "n_words")
    parts = members.groupBy("value", "component").agg(F.count("*").alias("n_nodes"), F.min(order).alias("head"))
    return parts.select(
        "value", "component", "n_nodes", F.col("head.node").alias("head"), F.col("head.n_words").alias("head_words")
    )


def _near_in_length(a: str, b: str, similarity: float) -> Column:
    least, most = F.least(a, b), F.greatest(a, b)
    return most - least <= most * (1 - similarity) + 1e-9


def _led(members: DataFrame, similarity: float, turn: int) -> DataFrame:
    """Pairs (a, b) of one leader of each open group with its other nodes.

    In turns 0 and 1 a leader is the same in all groups that share it, and in turn 0 a node meets one leader alone, so
    that a group of copies is joined by one pair for each. In turn 2 leaders come from the smallest components.
    """
    if turn == 2:
        heads, rank = _parts(members), F.struct("n_nodes", F.xxhash64("head", F.lit(1)))
    else:
        heads, rank = members.withColumnsRenamed({"node": "head", "n_words": "head_words"}), F.xxhash64("head")
    leaders = heads.groupBy("value").agg(F.min_by(F.struct("head", "head_words", "component"), rank).alias("leader"))
    leaders = leaders.select("value", "leader.*").withColumnRenamed("component", "head_component")
    pairs = _across(members.join(leaders, "value"), similarity)
    return pairs if turn else pairs.groupBy("b").agg(F.min_by("a", F.xxhash64("a")).alias("a"))


def _across(both: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of heads and nodes of different components that are near enough in length."""
    apart = both.filter("component != head_component").filter(_near_in_length("n_words", "head_words", similarity))
    return apart.select(F.col("head").alias("a"), F.col("node").alias("b"))


def _whole(members: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """(pairs of all nodes of the open groups with few nodes outside the largest component, values of the other open groups)."""
    largest = F.max(F.struct("n_nodes", "component")).alias("largest")
    sizes = stored(_parts(members).groupBy("value").agg(F.sum("n_nodes").alias("size"), largest), "sizes")
    few = F.col("size") - F.col("largest.n_nodes") <= FEW_COMPONENTS
    inside = members.join(sizes.filter(few).select("value", F.col("largest.component").alias("largest")), "value")
    heads = inside.filter("component != largest").select(
        "value", F.col("node").alias("head"), F.col("n_words").alias("head_words"), F.col("component").alias("head_component")
    )
    return _across(inside.join(heads, "value"), similarity), sizes.filter(~few).select("value")


def least_common(n_words: int, run: int, similarity: float) -> int:
    """How many runs of `run` words, with repeats, a text shares at least with any that is alike; not above 0 if none need be.

    An edit changes at most `run` runs of the longer of two texts.
    """
    if run * (1 - similarity) >= 1:
        return 0
    longest = np.arange(n_words, int(n_words / similarity) + 2)
    edits = (longest * (1 - similarity) + 1e-9).astype(np.int64)
    return int((longest - run + 1 - run * edits).min())


def _run_batches(run: int, similarity: float):
    """Distinct runs of each text, in one order for all texts, and how many of them a text that is alike has at least."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in steps(batches, "text"):
            words, begins = hashed_words(batch["text"].tolist())
            found, bounds = sequences(words, begins, run)
            if run < WORDS:
                found = found + earlier_occurrences(found, bounds).astype(np.uint64) * _ODD
            found = mix(found + np.uint64(run) * _SINGLE)
            lists = [np.unique(found[x:y]).view(np.int64) for x, y in zip(bounds[:-1], bounds[1:])]
            n_words = np.diff(begins)
            if run < WORDS:
                least = {n: least_common(n, run, similarity) for n in set(n_words.tolist())}
                needed = [least[n] for n in n_words.tolist()]
            else:
                needed = [int(np.ceil(DISTINCT * len(x) - 1e-9)) if n >= WORDS else 0 for n, x in zip(n_words, lists)]
            yield batch[["node", "component"]].assign(n_words=n_words, runs=lists, needed=needed)

    return of


def _rare_batches(listed: Broadcast | None):
    """The rare runs by which each text is compared, and whether it can be alike to none by its frequent runs alone.

    Runs are ordered alone, then rare, then frequent ones. Two texts that share as many as they need share one among the first
    of both: of `n` runs of which `needed` are shared, n - needed + 1. Of those, only rare ones make pairs. Rare and frequent
    runs are `listed`, or stand in each row.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        none = np.empty(0, np.int64)
        for batch in batches:
            values, settled = [], []
            for own, rare, n_frequent, needed in zip(batch["runs"], batch["rare"], batch["n_frequent"], batch["needed"]):
                if listed:
                    rare, n_frequent = own[_among(own, listed.value[0])], int(_among(own, listed.value[1]).sum())
                else:
                    rare = none if rare is None else np.sort(rare)
                n_alone = len(own) - len(rare) - n_frequent
                settled.append(n_frequent < needed)
                values.append(rare[: max(0, len(own) - needed + 1 - n_alone)])
            yield batch[["node", "component", "n_words"]].assign(settled=settled, values=values)

    return run


def _among(own: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of `own` are among the sorted `values`: those with unequal places on both sides."""
    return np.searchsorted(values, own) < np.searchsorted(values, own, "right")


def _by_rare_runs(nodes: DataFrame, texts: DataFrame, run: int, similarity: float) -> DataFrame:
    """(node, component, n_words, settled, values): rare runs of `nodes` (node, component); of two that are alike and share none, neither is settled.

    A run that one component alone holds links no two, so that it is neither listed nor given out.
    """
    schema = "node long, component long, n_words long, runs array<long>, needed long"
    # Dealt evenly, as texts with something in common may lie together.
    rows = texts.join(small_side(nodes, BROADCAST_IDS // 2), "node").repartition("node")
    listed = stored(rows.mapInPandas(bounded(_run_batches(run, similarity)), schema), "runs")
    single = listed.select("node", "component", F.explode("runs").alias("value"))
    others = single.groupBy("value", "component").count().groupBy("value").agg((F.sum("count") - F.max("count")).alias("others"))
    linking = others.filter("others > 0").select("value", (F.col("others") > FEW_COMPONENTS).alias("frequent"))
    linking = stored(linking, "linking")
    if linking.count() <= LISTED:
        found = linking.toArrow().to_pandas()
        sides = [np.sort(found["value"].to_numpy()[found["frequent"].to_numpy(bool) == x]) for x in (False, True)]
        known = nodes.sparkSession.sparkContext.broadcast(sides)
        rows = listed.withColumns({"rare": F.lit(None).cast("array<long>"), "n_frequent": F.lit(0).cast("long")})
    else:
        own = single.join(linking, "value").groupBy("node").agg(
            F.collect_list(F.when(~F.col("frequent"), F.col("value"))).alias("rare"), F.count_if("frequent").alias("n_frequent")
        )
        known, rows = None, listed.join(own, "node", "left").withColumn("n_frequent", F.coalesce("n_frequent", F.lit(0)))
    rows = rows.select("node", "component", "n_words", "runs", "rare", "n_frequent", "needed")
    schema = "node long, component long, n_words long, settled boolean, values array<long>"
    return stored(rows.mapInPandas(bounded(_rare_batches(known)), schema), "rare")


def _all_pairs(members: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of all nodes of each group, a slice of a few nodes with all others at a time."""
    slices = members.groupBy("value").agg(F.ceil(F.count("*") / FEW_COMPONENTS).cast("int").alias("slices"))
    sliced = members.join(slices, "value")
    heads = sliced.select(
        "value", F.pmod(F.xxhash64("node"), "slices").cast("int").alias("slice"), F.col("node").alias("head"),
        F.col("n_words").alias("head_words"), F.col("component").alias("head_component"),
    )
    nodes = sliced.select("value", "node", "n_words", "component", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    return _across(nodes.join(heads, ["value", "slice"]).filter("head < node"), similarity)


def _rest(members: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) among which are all alike pairs of the open groups of `members`.

    Rare runs make at most `FEW_COMPONENTS` pairs for each run of a text. Texts that no run settles, as even most of their
    single words are frequent, are compared with all others of them in their groups.
    """
    nodes, found = members.select("node", "component").distinct(), []
    for run in RUNS:
        rare = _by_rare_runs(nodes, texts, run, similarity)
        found.append(rare.select(F.explode("values").alias("value"), "node", "n_words", "component"))
        nodes = rare.filter("not settled").select("node", "component")
        if nodes.isEmpty():
            break
    pairs, _ = _whole(stored(reduce(DataFrame.union, found), "by_run"), similarity)
    if len(found) == len(RUNS):
        pairs = pairs.union(_all_pairs(members.join(nodes.select("node"), "node", "left_semi"), similarity))
    return pairs


def _members(values: DataFrame) -> DataFrame:
    """Rows of `values` (value, node, n_words) whose value several nodes share."""
    shared = values.groupBy("value").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low != high")
    return stored(values.join(shared.select("value"), "value").select("value", "node", "n_words").distinct(), "members")


class _Joiner:
    """Aligns pairs of texts and keeps the names of the components that similar pairs make."""

    def __init__(self, nodes: DataFrame, texts: DataFrame, similarity: float):
        self.names = nodes.select("node", F.col("node").alias("component"))
        self.texts, self.similarity = texts, similarity

    def take(self, pairs: DataFrame) -> None:
        """Components that a similar pair connects become one; only their names are linked, so links do not pile up."""
        once = stored(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
        similar = stored(_verified(once, self.texts, self.similarity), "similar")
        of = lambda name: self.names.select(F.col("node").alias(name), F.col("component").alias(f"{name}_name"))
        links = similar.join(of("a"), "a").join(of("b"), "b").select(F.col("a_name").alias("a"), F.col("b_name").alias("b"))
        links = stored(links.filter("a != b").distinct(), "links")
        if links.isEmpty():
            return
        newer = components(links).select(F.col("node").alias("component"), F.col("component").alias("newer"))
        renamed = self.names.join(newer, "component", "left").select("node", F.coalesce("newer", "component").alias("component"))
        self.names = stored(renamed, "names")


def _joined(members: DataFrame, docs: DataFrame, id_col: str, text_col: str, similarity: float) -> DataFrame:
    """(node, component) of the nodes of `members` (value, node, n_words) that chains of similar pairs connect.

    A fixed number of rounds. All nodes of a group are compared, or all that can be alike by the runs of words they share.
    """
    nodes = stored(members.select("node").distinct(), "nodes")
    texts = stored(
        docs.select(F.col(id_col).alias("node"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        .join(small_side(nodes), "node", "left_semi"),
        "texts",
    )
    joiner = _Joiner(nodes, texts, similarity)
    # Groups that have become one component need no more work.
    groups = members.withColumn("component", F.col("node"))
    for turn in range(3):
        joiner.take(_led(groups, similarity, turn))
        groups = _open(groups, joiner.names)
    pairs, many = _whole(groups, similarity)
    joiner.take(pairs)
    if not many.isEmpty():
        joiner.take(_rest(_open(groups, joiner.names, many), texts, similarity))
    return joiner.names


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
    k: int = WORDS,
    kept: int = KEPT,
    kept_new: int = KEPT_NEW,
    n_sketches: int = SKETCHES,
) -> DataFrame:
    """One row (id_col, class_id, class_size) for each row of `docs`.

    Texts are in a class if a chain of pairs whose edit similarity (1 - distance / words of the longer, words
    compared in lower case) is at least `similarity`, and that share `DISTINCT` of their distinct
    sequences, connects them. `class_id` is the least id of the class.

    Texts with the same words are one node, so copies are never expanded. A null text counts as an empty one, and
    all texts without a word are one class. Texts of fewer than `k` words are near duplicates only of texts with the
    same words or the same few sequences. Texts of few sequences, which a sketch takes whole, are compared with all
    that share one sequence with them. Rows that share an id are one document: their classes are joined. A null
    id gets the class of its text; where all ids of a class are null its `class_id` is a number made from the words.
    Extra columns of `docs` are ignored, whatever their names. An empty table gives no rows.
    """
    table = sketch_table(docs, id_col, text_col, k, kept, kept_new, n_sketches, similarity)
    key = ["words_a", "words_b"]
    exact = stored(
        table.groupBy(key).agg(
            F.coalesce(F.min("id"), F.col("words_a")).alias("node"), F.count("*").alias("rows"),
            F.first("n_words").alias("n_words"), F.first("sketches").alias("sketches"),
        ),
        "exact",
    )
    members = _members(exact.filter("n_words > 0").select("node", "n_words", F.explode("sketches").alias("value")))
    names = _joined(members, docs, id_col, text_col, similarity)
    shared = table.filter("id is not null").select("id", *key).distinct().join(exact.select(*key, "node"), key)
    versions = shared.filter("id != node").select(F.col("id").alias("a"), F.col("node").alias("b"))
    versions = versions.join(exact.select(F.col("node").alias("a")).distinct(), "a")
    if not versions.isEmpty():
        chained = names.filter("node != component").toDF("a", "b").union(versions)
        more = components(chained)
        names = (
            exact.select("node").distinct().join(names, "node", "left").join(more.toDF("node", "more"), "node", "left")
            .select("node", F.coalesce("more", "component", "node").alias("component"))
        )
    classes = exact.join(names, "node", "left").select(*key, "rows", F.coalesce("component", "node").alias("class_id"))
    sizes = classes.groupBy("class_id").agg(F.sum("rows").alias("class_size"))
    classes = classes.join(sizes, "class_id").select(*key, "class_id", "class_size")
    return table.join(classes, key).select(F.col("id").alias(id_col), "class_id", "class_size")
