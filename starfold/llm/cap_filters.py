"""Near-equal vectors by spherical-cap filters: random product codes whose near code words a vector is listed under.

A filter is a direction made of one code word for each of `PARTS` parts of a randomly turned vector; there are as many
filters as all choices of code words, about `FILTERS_PER_VECTOR` for each vector. A vector is listed under every filter
whose product with it is at least `alpha`, and under its `LEAST` nearest where fewer are (the parts of some vectors are of
unequal length, and no filter is as near to them). Lists are decoded part by part, and partial sums that the best remaining
code words can't lift to `alpha` are left out, so the filters are never tried one by one. Vectors that share a filter
are compared by their exact cosine.

`alpha` is the number that `LISTED` filters exceed on average. Where pairs of just the wanted cosine
would share none too often, as in spaces of few dimensions, there are fewer code words.

Vectors of one filter are compared as blocks of at most `BLOCK` rows, whose products are one matrix; a larger filter is
cut into blocks that meet in tasks of their own. A task returns for each vector the number of its links and one link of
a spanning forest, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from starfold.llm.common import bounded, stored
from starfold.llm.components import components

SIMILARITY = 0.98
PARTS = 3
FILTERS_PER_VECTOR = 16
# Share of pairs of just the wanted cosine that must share a filter, of pairs drawn to choose the code.
RECALL = 0.99
DRAWN = 2_000
# Filters that exceed alpha for a vector on average, and the least number that any vector is listed under.
LISTED = 8
LEAST = 16
# Vectors of a filter that one task compares with as many others.
BLOCK = 1_024
_SEED = 20_240_611
# By which alpha falls, until a vector has its least number of filters.
_STEP = 0.02


class Code(NamedTuple):
    """`turn`: a rotation of the (padded) space; `words`: code words of each part; `alpha`: least product of a filter."""

    turn: np.ndarray
    words: np.ndarray
    alpha: float


def code_words(dim: int, n_words: int, parts: int, turn: int = 0) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng([_SEED, dim, n_words, turn])
    padded = -(-dim // parts) * parts
    turned = np.linalg.qr(r.standard_normal((padded, padded)))[0][:, :dim]
    words = r.standard_normal((parts, n_words, padded // parts))
    # A filter is a unit vector: each part has an equal share of its length.
    words /= np.linalg.norm(words, axis=2, keepdims=True) * np.sqrt(parts)
    return turned, words


def decode(unit: np.ndarray, code: Code) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, filter, product) of every filter that is at least `alpha` near; rows in order."""
    parts, n_words, width = code.words.shape
    turned = unit @ code.turn.T
    products = [turned[:, p * width : (p + 1) * width] @ code.words[p].T for p in range(parts)]
    rest = np.zeros((parts + 1, len(unit)))
    for p in reversed(range(parts)):
        rest[p] = rest[p + 1] + products[p].max(axis=1)
    row, name, total = np.arange(len(unit)), np.zeros(len(unit), np.int64), np.zeros(len(unit))
    for p in range(parts):
        # From the best word on: a vector's words that may still reach alpha come first.
        order = np.argsort(-products[p], axis=1)
        ranked = np.take_along_axis(products[p], order, axis=1)
        needed = code.alpha - total - rest[p + 1][row]
        n_kept = np.empty(len(row), np.int64)
        for first in range(0, len(row), 100_000):
            piece = slice(first, first + 100_000)
            n_kept[piece] = (ranked[row[piece]] >= needed[piece, None]).sum(axis=1)
        source = np.repeat(np.arange(len(row)), n_kept)
        rank = np.arange(len(source)) - np.repeat(np.cumsum(n_kept) - n_kept, n_kept)
        row, name, total = row[source], name[source], total[source]
        total = total + ranked[row, rank]
        name = name * n_words + order[row, rank]
    return row, name, total


def listed(unit: np.ndarray, code: Code, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) of every filter that is at least alpha near, or else of the `least` nearest; rows in order."""
    row, name, _ = decode(unit, code)
    least = min(least, code.words.shape[1] ** len(code.words))
    few = np.flatnonzero(np.bincount(row, minlength=len(unit)) < least)
    kept = ~np.isin(row, few)
    rows, names, at = [row[kept]], [name[kept]], code.alpha
    while len(few):
        at -= _STEP
        row, name, total = decode(unit[few], code._replace(alpha=at))
        enough = np.bincount(row, minlength=len(few)) >= least
        order = np.lexsort((-total, row))
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        best = order[enough[row] & (rank < least)]
        rows.append(few[row[best]])
        names.append(name[best])
        few = few[~enough]
    row, name = np.concatenate(rows), np.concatenate(names)
    order = np.argsort(row, kind="stable")
    return row[order], name[order]


def _alpha(unit: np.ndarray, turn: np.ndarray, words: np.ndarray, n_listed: int) -> float:
    """The alpha at which `unit` rows are listed under about `n_listed` filters each; lists only grow as it is sought."""
    width = words.shape[2]
    turned = unit @ turn.T
    high = low = float(sum((turned[:, p * width : (p + 1) * width] @ w.T).max(axis=1) for p, w in enumerate(words)).max())
    many = lambda at: len(decode(unit, Code(turn, words, at))[0]) >= n_listed * len(unit)
    while not many(low) and low > -1.0:
        high, low = low, low - _STEP
    for _ in range(8):
        middle = (low + high) / 2
        low, high = (middle, high) if many(middle) else (low, middle)
    return low


@lru_cache
def calibrated(dim: int, n_vectors: int, similarity: float, n_listed: int = LISTED) -> Code:
    """The code for so many vectors; alpha and the number of code words follow from pairs drawn with a fixed seed.

    Beyond the count of vectors nothing of the data enters: a random turn makes every direction like any other.
    """
    parts = min(PARTS, dim)
    n_words = max(2, round((FILTERS_PER_VECTOR * max(n_vectors, 2)) ** (1 / parts)))
    r = np.random.default_rng([_SEED, dim])
    a, b = r.standard_normal((2, DRAWN, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    length = np.linalg.norm(b, axis=1, keepdims=True)
    b = similarity * a + np.sqrt(1 - similarity**2) * np.divide(b, length, out=np.zeros_like(b), where=length > 1e-9)
    while True:
        turn, words = code_words(dim, n_words, parts)
        code = Code(turn, words, _alpha(a[: DRAWN // 10], turn, words, min(n_listed, n_words**parts)))
        lists = [pd.DataFrame(dict(zip(("row", "name"), listed(side, code)))) for side in (a, b)]
        met = lists[0].merge(lists[1])["row"].nunique() >= RECALL * DRAWN
        if n_words == 2 or (met and len(lists[0]) <= 4 * LEAST * DRAWN):
            return code
        n_words = max(2, int(n_words * 0.8))


def unit_vectors(vectors: list) -> np.ndarray:
    """Rows of length 1, in double precision; scaled first, so that no square is too large or too small."""
    found = np.array([np.asarray(v, np.float64) for v in vectors])
    found /= np.abs(found).max(axis=1, keepdims=True)
    return found / np.linalg.norm(found, axis=1, keepdims=True)


def _listed(codes: dict[int, Code]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, rows in batch.groupby("dim"):
                row, name = listed(unit_vectors(rows["vector"].tolist()), codes[dim])
                lists = np.split(name, np.searchsorted(row, np.arange(1, len(rows))))
                yield pd.DataFrame({"node": rows["node"].to_numpy(), "filters": lists})

    return run


def _usable(column: str) -> Column:
    """Whether a vector has a direction: no null, only finite components, not all zero, and at least one."""
    c = F.col(column)
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(c.isNotNull() & finite & F.exists(c, lambda x: x != 0), F.lit(False))


def _forest(linked: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix the least row it is connected with."""
    name = np.arange(len(nodes))
    while True:
        near = np.where(linked, name[None, :], len(nodes)).min(axis=1, initial=len(nodes))
        new = np.minimum(name, near)
        new = new[new]
        if np.array_equal(new, name):
            return nodes[name]
        name = new


def compare_block(rows: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """Links of one task: (node, n_links, other) for each node with a link; `other` is a node it is connected with.

    Rows have `node`, `side`, `copies`, `vector`, `filter` and `filters`. Rows of side 0 are compared with those of side
    1, or among themselves if there is only side 0. A pair is counted under the first filter that it shares.
    """
    rows = rows.reset_index(drop=True)
    unit = unit_vectors(rows["vector"].tolist())
    near = unit @ unit.T >= similarity
    np.fill_diagonal(near, False)
    if (rows["side"] != rows["side"].iloc[0]).any():
        near &= rows["side"].to_numpy()[:, None] != rows["side"].to_numpy()[None, :]
    if near.any():
        own = rows["filter"].iloc[0]
        sizes = rows["filters"].map(len).to_numpy()
        names = np.concatenate(rows["filters"].tolist())
        row = np.repeat(np.arange(len(rows)), sizes)
        earlier = names < own
        distinct, column = np.unique(names[earlier], return_inverse=True)
        held = np.zeros((len(rows), len(distinct)), np.float32)
        held[row[earlier], column] = 1
        held = held[:, held.sum(axis=0) > 1]
        near &= held @ held.T == 0
    linked = np.flatnonzero(near.any(axis=1))
    near = near[np.ix_(linked, linked)]
    nodes = rows["node"].to_numpy()[linked]
    copies = rows["copies"].to_numpy()[linked]
    return pd.DataFrame({"node": nodes, "n_links": near @ copies, "other": _forest(near, nodes)})


def _compare(similarity: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[pd.DataFrame] = []
        for batch in batches:
            # The tasks of a partition follow one another; the last of a batch may go on in the next.
            task = batch[["group", "low", "high"]].to_numpy()
            new = np.flatnonzero(np.any(task[1:] != task[:-1], axis=1)) + 1
            for first, last in zip([0, *new], [*new, len(batch)]):
                piece = batch.iloc[first:last]
                if waiting and tuple(waiting[-1][["group", "low", "high"]].iloc[-1]) != tuple(task[first]):
                    yield compare_block(pd.concat(waiting), similarity)
                    waiting = []
                waiting.append(piece)
        if waiting:
            yield compare_block(pd.concat(waiting), similarity)

    return run


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    similarity: float = SIMILARITY,
    block: int = BLOCK,
) -> DataFrame:
    """(id_col, n_links, component_id, kept) for each row of `vectors`.

    Rows are linked if their labels and lengths are equal, no label is null, and their cosine in double precision is at
    least `similarity`; pairs below it never are. Of the pairs at `similarity` about `RECALL` are found, of nearer
    ones more, equal vectors always. `n_links` counts linked rows, `component_id` is the least id that links reach.

    Rows whose vector is null, empty, zero or holds a null, NaN or infinity, and rows without a label, have no link and
    are their own component. Rows that repeat an id are rows of their own. A row without an id takes part in links; its
    component is the least id that it reaches, null if there is none, and it is not kept. Other columns are ignored,
    whatever their names. An empty table gives no rows.
    """
    rows = vectors.select(
        F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), F.col(label_col).cast("string").alias("label")
    )
    able = F.col("label").isNotNull() & _usable("vector")
    key = ["label", "vector"]
    # Equal vectors are one node; copies are counted before the shuffle.
    equal = rows.filter(able).groupBy(*key).agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    nodes = stored(equal.withColumns({"node": F.monotonically_increasing_id(), "dim": F.size("vector")}), "vectors")
    # One row for each length of vector that occurs.
    dims = {r.dim: r.n for r in nodes.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    codes = {dim: calibrated(dim, n, similarity) for dim, n in dims.items()}
    found = _links(nodes, codes, similarity, block)
    counted = found.groupBy("node").agg(F.sum("n_links").alias("others"))
    links = found.filter("node != other").select(F.col("node").alias("a"), F.col("other").alias("b"))
    named = components(links)
    least = named.join(nodes.select("node", "least"), "node").groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component").select("node", "component_id")
    judged = (
        nodes.join(counted, "node", "left").join(named, "node", "left")
        .select(
            *key, (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component_id", "least").alias("component_id"),
        )
    )
    alone = rows.filter(~able).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    linked = rows.filter(able).join(judged, key).select("id", "n_links", "component_id")
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept")
    return linked.union(alone).select(F.col("id").alias(id_col), "n_links", "component_id", kept)


def _links(nodes: DataFrame, codes: dict[int, Code], similarity: float, block: int) -> DataFrame:
    """(node, n_links, other), several rows for a node that meets others in several tasks."""
    own = nodes.select("node", "dim", "vector")
    listed = stored(own.mapInPandas(bounded(_listed(codes)), "node long, filters array<long>"), "filters")
    sides = nodes.select("node", "label", "dim").join(listed, "node")
    single = sides.select("node", "label", "dim", F.explode("filters").alias("filter"))
    group = F.xxhash64("label", "dim", "filter").alias("group")
    # Filters of one vector have nothing to compare; of the others only sizes and names go on.
    sizes = single.groupBy("label", "dim", "filter").agg(F.count("*").alias("size")).filter("size > 1")
    live = stored(
        single.join(sizes, ["label", "dim", "filter"]).select("node", "filter", "size", group), "shared-filters"
    )
    lists = live.groupBy("node").agg(F.collect_list("filter").alias("filters"))
    payload = nodes.select("node", "vector", "copies").join(lists, "node")
    # Block p of a filter meets itself and every other block; each meeting is a task, named by its two blocks.
    n_blocks = F.ceil(F.col("size") / block).cast("int")
    mine = F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int")
    placed = live.withColumn("n_blocks", n_blocks).withColumn("mine", mine)
    met = placed.withColumn("theirs", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    tasks = met.select(
        "node", "filter", "group", F.least("mine", "theirs").alias("low"), F.greatest("mine", "theirs").alias("high"),
        (F.col("mine") > F.col("theirs")).cast("int").alias("side"),
    )
    dealt = (
        tasks.join(payload, "node")
        .repartition("group", "low", "high")
        .sortWithinPartitions("group", "low", "high", "filter")
    )
    return stored(dealt.mapInPandas(bounded(_compare(similarity)), "node long, n_links long, other long"), "vector-links")
