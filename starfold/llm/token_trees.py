"""Token counts that follow edits: a tree of pre-tokens for each text, of which an edit changes only a part.

Leaves hold the lengths and token counts of up to `LEAF` pre-tokens, inner nodes the sums of what is below. After an
edit, pre-tokens are split anew from two before the edit on, until a new boundary meets an old one behind the edit:
from there on the split is as it was, since it depends only on what follows. Only these are encoded.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame, functions as F

from starfold.llm.common import bounded

# Fixed value: how the byte-level vocabularies split a text before merging.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
LEAF = 128
# Token counts that one task remembers.
REMEMBERED = 500_000


class Counter:
    """Splits texts into pre-tokens and counts the tokens of each."""

    def __init__(self, vocabulary: str = VOCABULARY, split: str = SPLIT):
        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("own", pat_str=split, mergeable_ranks=ranks, special_tokens={})
        self.split = regex.compile(split)
        self.known: dict[str, int] = {}

    def counts(self, pretokens: list[str]) -> list[int]:
        out = list(map(self.known.get, pretokens))
        if None in out:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            encode = self.encoding.encode_ordinary
            for i, n in enumerate(out):
                if n is None:
                    out[i] = self.known[pretokens[i]] = len(encode(pretokens[i]))
        return out


class Node(NamedTuple):
    chars: int
    tokens: int
    size: int  # pre-tokens
    height: int
    left: Node | None
    right: Node | None
    lengths: np.ndarray | None
    counts: np.ndarray | None


def _leaf(lengths: np.ndarray, counts: np.ndarray) -> Node:
    return Node(int(lengths.sum()), int(counts.sum()), len(lengths), 0, None, None, lengths, counts)


def _inner(left: Node, right: Node) -> Node:
    return Node(
        left.chars + right.chars, left.tokens + right.tokens, left.size + right.size,
        1 + max(left.height, right.height), left, right, None, None,
    )


def build(lengths: list[int], counts: list[int]) -> Node | None:
    """A balanced tree of pre-tokens; None of none."""
    sizes, tokens = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    if not len(sizes):
        return None
    firsts = np.arange(0, len(sizes), LEAF)
    sums = zip(np.add.reduceat(sizes, firsts).tolist(), np.add.reduceat(tokens, firsts).tolist(), firsts.tolist())
    level = [
        Node(c, t, min(LEAF, len(sizes) - i), 0, None, None, sizes[i : i + LEAF], tokens[i : i + LEAF])
        for c, t, i in sums
    ]
    while len(level) > 1:
        level = [_inner(*level[i : i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def join(left: Node | None, right: Node | None) -> Node | None:
    """Both trees one after the other; heights differ by one at most again after joins along the inner edge."""
    if left is None or right is None:
        return left if right is None else right
    if left.height == right.height == 0 and left.size + right.size <= LEAF:
        return _leaf(np.concatenate((left.lengths, right.lengths)), np.concatenate((left.counts, right.counts)))
    if left.height > right.height + 1:
        return _balanced(left.left, join(left.right, right))
    if right.height > left.height + 1:
        return _balanced(join(left, right.left), right.right)
    return _inner(left, right)


def _balanced(left: Node, right: Node) -> Node:
    if left.height > right.height + 1:
        if left.right.height > left.left.height:
            return _inner(_inner(left.left, left.right.left), _inner(left.right.right, right))
        return _inner(left.left, _inner(left.right, right))
    if right.height > left.height + 1:
        if right.left.height > right.right.height:
            return _inner(_inner(left, right.left.left), _inner(right.left.right, right.right))
        return _inner(_inner(left, right.left), right.right)
    return _inner(left, right)


def split(node: Node | None, at: int) -> tuple[Node | None, Node | None]:
    """The tree before and after a pre-token boundary, given in code points."""
    if node is None or at <= 0:
        return None, node
    if at >= node.chars:
        return node, None
    if node.lengths is not None:
        cut = int(np.searchsorted(np.cumsum(node.lengths), at, side="left")) + 1
        return _leaf(node.lengths[:cut], node.counts[:cut]), _leaf(node.lengths[cut:], node.counts[cut:])
    if at < node.left.chars:
        before, after = split(node.left, at)
        return before, join(after, node.right)
    before, after = split(node.right, at - node.left.chars)
    return join(node.left, before), after


def locate(node: Node, at: int) -> int:
    """Where the pre-token begins that holds the code point `at`."""
    start = 0
    while node.lengths is None:
        if at - start < node.left.chars:
            node = node.left
        else:
            start += node.left.chars
            node = node.right
    ends = np.cumsum(node.lengths)
    i = int(np.searchsorted(ends, at - start, side="right"))
    return start + int(ends[i] - node.lengths[i])


class Document:
    def __init__(self, text: str, counter: Counter):
        pretokens = counter.split.findall(text)
        self.text, self.counter = text, counter
        self.tree = build(list(map(len, pretokens)), counter.counts(pretokens))
        self.encoded = len(pretokens)

    @property
    def tokens(self) -> int:
        return self.tree.tokens if self.tree else 0

    def edit(self, start: int, end: int, new: str) -> int:
        """Replaces text[start:end] by `new`; returns how many pre-tokens were encoded for it."""
        old = self.text
        self.text = old[:start] + new + old[end:]
        moved = len(new) - (end - start)
        first = 0
        if self.tree is not None and start > 0:
            first = locate(self.tree, min(start, len(old) - 1))
            for _ in range(2):
                first = locate(self.tree, first - 1) if first else 0
        pretokens, at = [], first
        for match in self.counter.split.finditer(self.text, first):
            pretokens.append(match[0])
            at = match.end()
            if at - moved >= end and at >= start + len(new):
                if at - moved >= len(old) or locate(self.tree, at - moved) == at - moved:
                    break
        before, rest = split(self.tree, first)
        _, after = split(rest, (at - moved if pretokens else len(old)) - first)
        middle = build(list(map(len, pretokens)), self.counter.counts(pretokens))
        self.tree = join(join(before, middle), after)
        self.encoded += len(pretokens)
        return len(pretokens)


def spread_edits(text: str) -> list[tuple[int, int, str]]:
    """Three edits that the query applies one after another: a 64th of the text is removed at a quarter, its first 40
    code points are inserted at the half, and the 20 code points at three quarters are turned round."""
    n = len(text)
    quarter, half, late = n // 4, n // 2, 3 * n // 4
    return [
        (late, min(n, late + 20), text[late : late + 20][::-1]),
        (half, half, text[:40]),
        (quarter, quarter + n // 64, ""),
    ]


def count_edited(docs: DataFrame, edits=spread_edits, id_col="doc_id", text_col="text", vocabulary=VOCABULARY):
    """(id_col, n_chars, n_tokens, n_pretokens, n_edits, edited_chars, edited_tokens, reencoded, height) of every row.

    `edits` gives a text's edits (start, end, new text), each for the text as the one before left it. `reencoded` is
    the number of pre-tokens that the edits had to encode, `height` that of the tree after them. Null texts count as
    empty; an empty text has no tokens and no tree. Repeated rows are counted alike. Extra columns are ignored; an
    empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    names = "n_chars n_tokens n_pretokens n_edits edited_chars edited_tokens reencoded height".split()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = Counter(vocabulary)
        for batch in batches:
            out = []
            for id_, text in zip(batch["id"], batch["text"]):
                doc = Document("" if text is None else text, counter)
                before = len(doc.text), doc.tokens, doc.encoded
                changes = edits(doc.text)
                reencoded = sum(doc.edit(*e) for e in changes)
                height = doc.tree.height if doc.tree else 0
                out.append((id_, *before, len(changes), len(doc.text), doc.tokens, reencoded, height))
            yield pd.DataFrame(out, columns=["id", *names])

    schema = f"id {kind}, " + ", ".join(f"{n} long" for n in names)
    return rows.mapInPandas(bounded(run), schema).withColumnRenamed("id", id_col)
