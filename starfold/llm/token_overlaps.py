"""Alignment of two tokenizers: which tokens of the one overlap which of the other, and where both end together.

Both sides encode the same bytes, so a token is a byte range. An as-of join by document finds for each token's start the
other side's token that covers it; the union of both directions holds every overlap, as of two overlapping ranges one
starts within the other. Ends that both sides have cut a text into groups.

Documents are worked on in blocks of bounded size. A block keeps each id pair once, with the number of its documents
that hold it; corpus-wide numbers come from sums over blocks and return to the blocks, so that what is shuffled is a
block's distinct pairs, not the tokens of its documents.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from starfold.llm.common import bounded, stored
from starfold.operators.lookup import HOT_ROWS, spread_left_join

BYTE_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
# Code points of a block; a longer text is a block of its own.
BLOCK_CHARS = 2_000_000
# Words and token ids that a task remembers before it starts anew.
REMEMBERED = 300_000
REMEMBERED_IDS = 4_000_000

_SPACE = "▁"
# A blank between two other characters: both tokenizers begin a token with it, and what stands before has no effect.
_CUT = re.compile(r"\x20(?<=[^\s▁]\x20)(?=[^\s▁])")
# Fixed value: how the byte-level vocabulary splits a text before merging.
_SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, then from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def words(text: str) -> list[str]:
    """`text` cut at each blank between two other characters."""
    return _CUT.split(text)


class Tokenizers:
    """The two tokenizers, and the bytes of each of their ids."""

    def __init__(self, byte_vocabulary: str = BYTE_VOCABULARY, piece_vocabulary: str = PIECE_VOCABULARY):
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_vocabulary)
        with open(byte_vocabulary, encoding="utf-8") as file:
            listed = json.load(file)
        alphabet, special = byte_alphabet(), {t["content"] for t in listed["added_tokens"]}
        entries = {i: bytes(map(alphabet.get, e)) for e, i in listed["model"]["vocab"].items() if e not in special}
        self.a_bytes = [entries.get(i, b"") for i in range(max(entries) + 1)]
        # Ids are in the order of merges. Special tokens are left out: their strings in a text are ordinary text.
        ranks = {entry: i for i, entry in entries.items()}
        self.byte_level = tiktoken.Encoding("own", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.b_bytes = [self._piece_bytes(i) for i in range(self.pieces.get_piece_size())]
        self.a_sizes = np.fromiter(map(len, self.a_bytes), np.int64, len(self.a_bytes))
        self.b_sizes = np.fromiter(map(len, self.b_bytes), np.int64, len(self.b_bytes))
        # A text may be cut before a blank only if no piece goes on over one.
        listed = (self.pieces.id_to_piece(i) for i in range(len(self.b_bytes)))
        self.divisible = not any(_SPACE in piece.lstrip(_SPACE) for piece in listed)
        self._forget()
        self.a_names, self.b_names = _names(len(self.a_bytes), ",|"), _names(len(self.b_bytes), ",;")

    def _piece_bytes(self, i: int) -> bytes:
        if self.pieces.is_byte(i):
            return bytes([int(self.pieces.id_to_piece(i)[3:-1], 16)])
        return self.pieces.id_to_piece(i).replace(_SPACE, " ").encode()

    def _forget(self) -> None:
        self.codes: dict[str, int] = {}
        self.changed = np.empty(0, bool)
        # For both sides the ids of all remembered words, one after another, and where each word's begin.
        self.ids = [np.empty(0, np.int64), np.empty(0, np.int64)]
        self.begins = [np.zeros(1, np.int64), np.zeros(1, np.int64)]

    def _learn(self, parts: set[str]) -> None:
        """Remember the ids of both sides of each part after a blank, and whether B's pieces give it back; A's always do."""
        listed = list(parts)
        both = [self.byte_level.encode_ordinary(" " + part) for part in listed], self.pieces.encode(listed, num_threads=1)
        back = (b"".join(map(self.b_bytes.__getitem__, ids)) for ids in both[1])
        changed = np.fromiter((own != b" " + part.encode() for own, part in zip(back, listed)), bool, len(listed))
        self.changed = np.concatenate((self.changed, changed))
        for side, lists in enumerate(both):
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            ids = np.fromiter(chain.from_iterable(lists), np.int64, sizes.sum())
            self.begins[side] = np.concatenate((self.begins[side], self.begins[side][-1] + np.cumsum(sizes)))
            self.ids[side] = np.concatenate((self.ids[side], ids))
        self.codes.update(zip(listed, range(len(self.codes), len(self.codes) + len(listed))))

    def _ids_of(self, side: int, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words one after another, and how many each has."""
        first = self.begins[side][codes]
        sizes = self.begins[side][codes + 1] - first
        shift = first - (np.cumsum(sizes) - sizes)
        return self.ids[side][np.arange(sizes.sum()) + np.repeat(shift, sizes)], sizes

    def encode_all(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each side the ids of all texts, one text after another, and where each text's begin (one more than texts).

        A text has none if it is null or empty, or if either side does not give back its bytes after a blank.
        """
        texts = list(map(_encodable, texts))
        cut = [(words(t) if self.divisible else [t]) if t else [] for t in texts]
        if len(self.codes) >= REMEMBERED or len(self.ids[0]) >= REMEMBERED_IDS:
            self._forget()
        new = set(chain.from_iterable(cut)).difference(self.codes)
        if new:
            self._learn(new)
        ends = np.cumsum([0, *map(len, cut)])
        codes = np.fromiter(map(self.codes.__getitem__, chain.from_iterable(cut)), np.int64, ends[-1])
        owner = np.repeat(np.arange(len(texts)), np.diff(ends))
        differs = [
            # Pieces that differ from their words could only together give the text back.
            i for i in np.unique(owner[self.changed[codes]])
            if b"".join(self.b_bytes[x] for x in self._ids_of(1, codes[ends[i] : ends[i + 1]])[0]) != (" " + texts[i]).encode()
        ]
        if differs:
            kept = ~np.isin(owner, differs)
            codes, owner = codes[kept], owner[kept]
        out = []
        for side in range(2):
            ids, sizes = self._ids_of(side, codes)
            out.append((ids, np.cumsum([0, *np.bincount(owner, sizes, len(texts)).astype(np.int64)])))
        return out

    def encode(self, text: str | None) -> tuple[list[int], list[int]]:
        (a, _), (b, _) = self.encode_all([text])
        return a.tolist(), b.tolist()


def _encodable(text: str | None) -> str | None:
    """`text`, or None if it has no UTF-8, as half of a surrogate pair."""
    try:
        (text or "").encode()
    except UnicodeEncodeError:
        return None
    return text


def _names(n: int, separators: str) -> np.ndarray:
    """Decimal ids followed by each of the separators or by nothing, a row for each."""
    out = np.empty((len(separators) + 1, n), object)
    for row, separator in enumerate([*separators, ""]):
        out[row] = [f"{i}{separator}" for i in range(n)]
    return out


@dataclass
class Aligned:
    """The tokens of a block's texts, one text after another, and how they overlap.

    `a_ids`, `a_begins`, `a_groups`: ids, where each text's begin (one more than texts), group of each token; likewise
    `b_`. `ends`: the byte at which each group ends, counted over all texts; `group_begins`: where each text's groups
    begin. `links_a`, `links_b`: places of the tokens of each overlap.
    """

    a_ids: np.ndarray
    b_ids: np.ndarray
    a_begins: np.ndarray
    b_begins: np.ndarray
    a_groups: np.ndarray
    b_groups: np.ndarray
    ends: np.ndarray
    group_begins: np.ndarray
    links_a: np.ndarray
    links_b: np.ndarray

    def texts_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.a_begins, places, side="right") - 1


def align(encoded: list[tuple[np.ndarray, np.ndarray]], sizes: tuple[np.ndarray, np.ndarray]) -> Aligned:
    """How the tokens of both sides (see `Tokenizers.encode_all`) overlap; `sizes` are the bytes of each id of a side."""
    sides = []
    for (ids, begins), size in zip(encoded, sizes):
        ends = np.cumsum(size[ids])
        frame = pd.DataFrame({"doc": np.repeat(np.arange(len(begins) - 1), np.diff(begins)), "start": ends - size[ids]})
        sides.append((ids, begins, ends, frame))
    (a_ids, a_begins, a_ends, a), (b_ids, b_begins, b_ends, b) = sides
    places_a, places_b = np.arange(len(a)), np.arange(len(b))
    if len(a):
        covering_b = pd.merge_asof(a, b.assign(place=places_b), on="start", by="doc")["place"].to_numpy(np.int64)
        covering_a = pd.merge_asof(b, a.assign(place=places_a), on="start", by="doc")["place"].to_numpy(np.int64)
    else:
        covering_a = covering_b = np.empty(0, np.int64)
    # Tokens that start together are found in both directions.
    own = a["start"].to_numpy()[covering_a] != b["start"].to_numpy()
    ends_of_a, ends_of_b = (np.zeros(a_ends[-1] + 1 if len(a) else 1, bool) for _ in range(2))
    ends_of_a[a_ends], ends_of_b[b_ends] = True, True
    a_last, b_last = ends_of_b[a_ends], ends_of_a[b_ends]
    a_groups, b_groups = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
    group_begins = np.concatenate((a_groups, [a_last.sum()]))[a_begins]
    return Aligned(
        a_ids, b_ids, a_begins, b_begins, a_groups, b_groups, a_ends[a_last], group_begins,
        np.concatenate((places_a, covering_a[own])), np.concatenate((covering_b, places_b[own])),
    )


def group_texts(found: Aligned, tokenizers: Tokenizers) -> list[str]:
    """For each text its groups as `a1,a2|b1;a3|b2,b3`."""
    n_a, n_b = len(found.a_ids), len(found.b_ids)
    last_a = np.append(found.a_groups[1:] != found.a_groups[:-1], True)[:n_a]
    last_b = np.append(found.b_groups[1:] != found.b_groups[:-1], True)[:n_b]
    # Tokens of all groups up to one, on either side.
    a_until, b_until = np.flatnonzero(last_a) + 1, np.concatenate(([0], np.flatnonzero(last_b) + 1))
    after_b = last_b.astype(np.int64)
    after_b[found.b_begins[1:][np.diff(found.b_begins) > 0] - 1] = 2
    merged = np.empty(n_a + n_b, object)
    merged[np.arange(n_a) + b_until[found.a_groups]] = (
        tokenizers.a_names[last_a.astype(np.int64), found.a_ids]
    )
    merged[np.arange(n_b) + a_until[found.b_groups]] = (
        tokenizers.b_names[after_b, found.b_ids]
    )
    parts, begins = merged.tolist(), found.a_begins + found.b_begins
    return ["".join(parts[first:last]) for first, last in zip(begins[:-1], begins[1:])]


def _blocks(batches: Iterator[pa.RecordBatch], chars: int) -> Iterator[tuple[list, list]]:
    """(ids, texts) of about `chars` code points each."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for own, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids.append(own)
            texts.append(text)
            size += len(text or "") + 1
            if size >= chars:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _lists(values: np.ndarray, begins: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(values))


_BLOCK_SCHEMA = (
    "block long, id long, n_a long, n_b long, n_groups long, n_links long, groups string, codes array<int>, "
    "times array<int>, pairs array<long>, holding array<int>"
)
# An id pair is one number: A's id above so many bits, B's below.
_PAIR_BITS = 32
_PLACE_BITS = 33


def _block_rows(make: Callable[[], Tokenizers], chars: int, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = make()
        block = TaskContext.get().partitionId() << _PLACE_BITS
        for ids, texts in _blocks(batches, chars):
            yield _block_batch(block, ids, texts, tokenizers, digest)
            block += 1

    return run


def _block_batch(block: int, ids: list, texts: list, tokenizers: Tokenizers, digest: bool) -> pa.RecordBatch:
    """A row for each text, and one more with the block's distinct pairs."""
    found = align(tokenizers.encode_all(texts), (tokenizers.a_sizes, tokenizers.b_sizes))
    n = len(texts)
    groups = group_texts(found, tokenizers)
    if digest:
        groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
    owner = found.texts_of(found.links_a)
    pair = (found.a_ids[found.links_a] << _PAIR_BITS) | found.b_ids[found.links_b]
    codes, pairs = pd.factorize(pair)
    held, times = np.unique(owner * len(pairs) + codes, return_counts=True)
    holder, codes = np.divmod(held, max(len(pairs), 1))
    begins = np.searchsorted(holder, np.arange(n + 1))
    # The row of the block has no text, the rows of texts have no pairs.
    alone = lambda values: _lists(values, np.array([0] * (n + 1) + [len(values)]))
    nulls = pa.array([True] * n + [False])
    columns = [
        pa.array([block] * (n + 1), pa.int64()),
        pa.array([*ids, None], pa.int64()),
        *(pa.array([*np.diff(b).tolist(), None], pa.int64()) for b in (found.a_begins, found.b_begins, found.group_begins)),
        pa.array([*np.bincount(owner, minlength=n).tolist(), None], pa.int64()),
        pa.array([*groups, None], pa.string()),
        *(_lists(v.astype(np.int32), np.append(begins, begins[-1])) for v in (codes, times)),
        *(pa.compute.if_else(nulls, None, alone(v)) for v in (pairs, np.bincount(codes, minlength=len(pairs)).astype(np.int32))),
    ]
    names = [field.split()[0] for field in _BLOCK_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays(columns, names)


def _rated(texts: pd.DataFrame, numbers: pd.DataFrame) -> pd.DataFrame:
    """The texts of a block with `n_best` and `count_sum`; `numbers` has a row for each of its distinct pairs."""
    n_docs = np.zeros(len(numbers), np.int64)
    best = np.zeros(len(numbers), np.int64)
    code = numbers["code"].to_numpy()
    n_docs[code], best[code] = numbers["n_docs"].to_numpy(), numbers["best"].to_numpy()
    sizes = texts["codes"].map(len).to_numpy()
    codes = np.concatenate([*texts["codes"], np.empty(0, np.int32)]).astype(np.int64)
    times = np.concatenate([*texts["times"], np.empty(0, np.int32)]).astype(np.int64)
    begins = np.concatenate(([0], np.cumsum(sizes)))
    total = lambda values: np.diff(np.concatenate(([0], np.cumsum(values * times)))[begins])
    return texts.drop(columns=["block", "codes", "times"]).assign(n_best=total(best[codes]), count_sum=total(n_docs[codes]))


def compare_tokenizers(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    make: Callable[[], Tokenizers] = Tokenizers,
    digest: bool = False,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) for each row of `docs`.

    `groups` is the alignment as `a1,a2|b1;a3|b2,b3`, or its SHA-256 with `digest`. `n_links` counts pairs of token
    occurrences that overlap; `count_sum` adds for each of them the number of documents of the whole table that hold its
    id pair, and `n_best` counts those whose number is the highest of their A id.

    A text that is null or empty, or that either tokenizer does not give back byte for byte, has zeros and '' and adds to
    no number. Each row is a document, also where ids are null or repeat. Other columns are ignored, whatever their
    names. An empty table gives no rows. `make` is called in each task; its vocabulary files are on every executor.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    blocks = stored(rows.mapInArrow(bounded(_block_rows(make, block_chars, digest)), _BLOCK_SCHEMA), "token-blocks")
    texts = blocks.filter("pairs is null").drop("pairs", "holding")
    listed = blocks.filter("pairs is not null").select("block", F.posexplode(F.arrays_zip("pairs", "holding")).alias("code", "held"))
    listed = listed.select("block", "code", F.col("held.pairs").alias("pair"), F.col("held.holding").alias("n"))
    counts = stored(listed.groupBy("pair").agg(F.sum("n").alias("n_docs"), F.count("*").alias("n_blocks")), "pair-counts")
    a_id = F.shiftright("pair", _PAIR_BITS)
    # At most one row for each id of A's vocabulary.
    highest = counts.groupBy(a_id.alias("a_id")).agg(F.max("n_docs").alias("highest"))
    rated = counts.withColumn("a_id", a_id).join(F.broadcast(highest), "a_id").select(
        "pair", "n_docs", (F.col("n_docs") == F.col("highest")).cast("long").alias("best")
    )
    hot = counts.filter(F.col("n_blocks") > HOT_ROWS).select("pair", F.ceil(F.col("n_blocks") / HOT_ROWS).cast("int").alias("_parts"))
    back = spread_left_join(listed.drop("n"), rated, ["pair"], hot, F.xxhash64("block", "code"))
    back = back.select(F.col("block").alias("of_block"), "code", "n_docs", "best")
    schema = "id long, n_a long, n_b long, n_groups long, n_links long, groups string, n_best long, count_sum long"
    found = texts.groupBy("block").cogroup(back.groupBy("of_block")).applyInPandas(_rated, schema)
    return found.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


def overlaps(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    make: Callable[[], Tokenizers] = Tokenizers,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row (id_col, group, start, end, a_ids, b_ids) for each group of each text, with bytes of the text after a blank.

    Rows without tokens, as in `compare_tokenizers`, have no group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = make()
        for ids, texts in _blocks(batches, block_chars):
            found = align(tokenizers.encode_all(texts), (tokenizers.a_sizes, tokenizers.b_sizes))
            if not len(found.ends):
                continue
            text = np.repeat(np.arange(len(texts)), np.diff(found.group_begins))
            ends = found.ends
            starts = np.concatenate(([0], ends[:-1]))
            base = starts[found.group_begins[:-1][text]]
            within = np.arange(len(ends)) - found.group_begins[:-1][text]
            edges = np.arange(len(ends) + 1)
            columns = [
                pa.array([ids[i] for i in text], pa.int64()), *map(pa.array, (within, starts - base, ends - base)),
                _lists(found.a_ids, np.searchsorted(found.a_groups, edges)),
                _lists(found.b_ids, np.searchsorted(found.b_groups, edges)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "group", "start", "end", "a_ids", "b_ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    schema = "id long, group long, start long, end long, a_ids array<long>, b_ids array<long>"
    return rows.mapInArrow(bounded(run), schema).withColumnRenamed("id", id_col)
