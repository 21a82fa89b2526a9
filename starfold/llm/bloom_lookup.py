"""Document fingerprints: invertible Bloom lookup tables of paragraph digests.

A text is cut into pieces, each piece is hashed, and the set of digests is summed into a table of cells. The tables of
two versions are subtracted; what both have falls away, and peeling recovers the digests that differ. If peeling gets
stuck, both tables are built again with more cells.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from starfold.llm.common import STEP_CHARS, bounded, mix
from starfold.llm.successors import NULL_KEY, block_of, id_blocks, next_in_blocks

# Cells of a fingerprint, in three parts of which each digest has one cell, and how much larger each retry is.
CELLS = 24
GROWTH = 4
PARTS = 3
# Pieces end at line breaks and sentence ends; longer ones also after one word in eight, chosen by its hash.
LONG_PIECE = 160
_PIECE = re.compile(r"\n+|(?<=[.!?])\s+")
_WORD = re.compile(r"\S+\s*")
_CHECK = np.uint64(0x2545F4914F6CDD1D)
_SEEDS = mix(np.arange(1, PARTS + 1, dtype=np.uint64))


def pieces(text: str) -> list[str]:
    out = []
    for piece in _PIECE.split(text):
        piece = piece.strip()
        if len(piece) <= LONG_PIECE:
            out.append(piece)
            continue
        start = 0
        for word in _WORD.finditer(piece):
            if zlib.crc32(word[0].rstrip().encode("utf-8", "surrogatepass")) % 8 == 0:
                out.append(piece[start : word.end()].rstrip())
                start = word.end()
        out.append(piece[start:])
    return [p for p in out if p]


def digests(text: str) -> np.ndarray:
    """Sorted distinct digests of the pieces of a text."""
    found = {xxhash.xxh3_64_intdigest(p.encode("utf-8", "surrogatepass")) for p in pieces(text)}
    return np.sort(np.fromiter(found, np.uint64, len(found)))


class Tables:
    """Tables of several sets at once; set i has `size[i]` cells for each part, from `base[i]` on."""

    def __init__(self, size: np.ndarray):
        self.size = size
        self.base = np.concatenate(([0], np.cumsum(size * PARTS)))
        self.count = np.zeros(self.base[-1], np.int64)
        self.keys = np.zeros(self.base[-1], np.uint64)
        self.checks = np.zeros(self.base[-1], np.uint64)

    def cells(self, owner: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Cells of each key, one row for each part."""
        size = self.size[owner]
        return np.stack([
            self.base[owner] + part * size + (mix(keys ^ _SEEDS[part]) % size.astype(np.uint64)).astype(np.int64)
            for part in range(PARTS)
        ])

    def add(self, owner: np.ndarray, keys: np.ndarray, sign: np.ndarray) -> None:
        signed = sign.astype(np.uint64)  # -1 is 2**64 - 1, so that products wrap to the negative
        for cells in self.cells(owner, keys):
            np.add.at(self.count, cells, sign)
            np.add.at(self.keys, cells, keys * signed)
            np.add.at(self.checks, cells, mix(keys ^ _CHECK) * signed)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each set: digests recovered with a plus, with a minus, and whether nothing is left in its table."""
        owner_of = np.repeat(np.arange(len(self.size)), self.size * PARTS)
        plus, minus = np.zeros(len(self.size), np.int64), np.zeros(len(self.size), np.int64)
        while True:
            single = np.flatnonzero(np.abs(self.count) == 1)
            sign = self.count[single]
            keys = self.keys[single] * sign.astype(np.uint64)
            good = mix(keys ^ _CHECK) * sign.astype(np.uint64) == self.checks[single]
            owner, keys, sign = owner_of[single[good]], keys[good], sign[good]
            if not len(keys):
                break
            order = np.lexsort((keys, owner))
            owner, keys, sign = owner[order], keys[order], sign[order]
            first = np.ones(len(keys), bool)
            first[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
            owner, keys, sign = owner[first], keys[first], sign[first]
            plus += np.bincount(owner[sign > 0], minlength=len(plus))
            minus += np.bincount(owner[sign < 0], minlength=len(minus))
            self.add(owner, keys, -sign)
        dirty = (self.count != 0) | (self.keys != 0) | (self.checks != 0)
        return plus, minus, np.bincount(owner_of, dirty, len(self.size)) == 0


def _flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    return owner, np.concatenate([np.empty(0, np.uint64), *sets])


def base_tables(sets: list[np.ndarray]) -> Tables:
    tables = Tables(np.full(len(sets), CELLS // PARTS))
    owner, keys = _flat(sets)
    tables.add(owner, keys, np.ones(len(keys), np.int64))
    return tables


def fingerprints(tables: Tables, sets: list[np.ndarray]) -> list[str]:
    """Number of distinct pieces, then the cells (count, sum of digests, sum of checks) in base64."""
    record = np.zeros(len(tables.count), [("count", "<i4"), ("keys", "<u8"), ("checks", "<u4")])
    record["count"], record["keys"], record["checks"] = tables.count, tables.keys, tables.checks.astype(np.uint32)
    rows = record.reshape(len(sets), CELLS)
    return [f"{len(s)}:{base64.b64encode(row.tobytes()).decode()}" for s, row in zip(sets, rows)]


def differing(tables: Tables, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many digests only the left and only the right set of each pair has, as two rows.

    `tables` are the base tables of `sets`; pairs that don't peel there are tried in tables of `GROWTH` times the
    cells again and again. With more cells than twice the digests a failure is a matter of chance, so this ends.
    """
    out = np.zeros((2, len(left)), np.int64)
    open_ = np.arange(len(left))
    size = CELLS // PARTS
    while len(open_):
        table = Tables(np.full(len(open_), size))
        if size == CELLS // PARTS:
            for name in ("count", "keys", "checks"):
                rows = getattr(tables, name).reshape(len(sets), CELLS)
                setattr(table, name, (rows[left[open_]] - rows[right[open_]]).reshape(-1))
        else:
            for side, sign in ((left, 1), (right, -1)):
                owner, keys = _flat([sets[i] for i in side[open_]])
                table.add(owner, keys, np.full(len(keys), sign))
        plus, minus, done = table.peel()
        out[:, open_[done]] = plus[done], minus[done]
        open_, size = open_[~done], size * GROWTH
    return out


def likeness(tables: Tables, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Twice the digests in common over all digests of both; 1 for two sets without any."""
    n = np.array([len(s) for s in sets], np.int64)
    only = differing(tables, sets, left, right)
    total = n[left] + n[right]
    return np.where(total > 0, 1.0 - only.sum(axis=0) / np.maximum(total, 1), 1.0)


def edited(text: str, following: str) -> str:
    """The last half of the code points (rounded down) replaced by as many of the following text, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(rows: list[tuple]) -> pd.DataFrame:
    """Rows (id, text, following text) with their fingerprints."""
    place: dict[str, int] = {}
    pairs = []
    for _, text, following in rows:
        new = edited(text, following)
        pairs.append([place.setdefault(t, len(place)) for t in (text, new, following)] + [new])
    sets = [digests(t) for t in place]
    tables = base_tables(sets)
    texts = fingerprints(tables, sets)
    own, new, following = (np.array([p[i] for p in pairs], np.int64) for i in range(3))
    both = likeness(tables, sets, np.concatenate((own, own)), np.concatenate((new, following)))
    return pd.DataFrame({
        "id": pd.array([None if r[0] == NULL_KEY else r[0] for r in rows], "Int64"),
        "n_chars": [len(r[1]) for r in rows],
        "edited_sha256": [hashlib.sha256(p[3].encode("utf-8", "surrogatepass")).hexdigest() for p in pairs],
        "fingerprint": [texts[i] for i in own], "edited_fingerprint": [texts[i] for i in new],
        "near_edited": both[: len(rows)], "near_next": both[len(rows) :],
    })


def _packed(bounds: list[int], least: list[int | None]):
    """Texts packed and sent to their block; the first id of a block also to the block before, as what follows it."""
    before: dict[int, int] = {}
    for block, key in enumerate(next_in_blocks(least)):
        if key is not None and least[block] is not None:
            before[key] = block
    ends = np.array(bounds, np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            keys = batch["key"].to_numpy(np.int64)
            texts = [("" if t is None else t).encode("utf-8", "surrogatepass") for t in batch["text"]]
            own = pd.DataFrame({
                "block": np.searchsorted(ends, keys, side="left").astype(np.int32), "place": np.int32(0), "key": keys,
                "hash": [xxhash.xxh3_64_intdigest(t) >> 1 for t in texts], "packed": [pack(t) for t in texts],
            })
            yield own
            first = own[[k in before for k in keys]]
            if len(first):
                yield first.assign(block=np.array([before[k] for k in first["key"]], np.int32), place=np.int32(1))

    return run


def _by_block(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by block, place and id; each waits for the first row of the next id in its block."""
    unpack = zstandard.ZstdDecompressor().decompress
    waiting: list[tuple] = []
    ready: list[tuple] = []
    chars, at = 0, None
    for batch in batches:
        for block, place, key, packed in zip(batch["block"], batch["place"], batch["key"], batch["packed"]):
            text = unpack(packed).decode("utf-8", "surrogatepass")
            if waiting and (at != (block, key) or place):
                ready += [(k, t, text) for k, t in waiting]
                chars += sum(len(t) for _, t in waiting) + len(text)
                waiting = []
            if not place:
                waiting.append((key, text))
                at = (block, key)
            if chars >= STEP_CHARS:
                yield _compared(ready)
                ready, chars = [], 0
    if ready:
        yield _compared(ready)


def fingerprint_versions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited version, and how alike they and the next document's are.

    Columns: id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The next document
    is the one with the next larger id, after the largest the one with the smallest; of several with that id the one
    whose text has the least hash. Null ids count as one id before all others; a null text as an empty one. Equal texts
    have equal fingerprints, those without a piece the empty one, which is like itself (1) and unlike others (0).
    Repeated rows stay. Extra columns are ignored; an empty table gives no rows.

    Texts are packed and shuffled once, to ranges of ids; of each range only its first id is sent to the one before.
    """
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_KEY)).alias("key")
    rows = docs.select(key, F.col(text_col).alias("text"))
    bounds, least = id_blocks(rows.select("key"), "key")
    sent = rows.mapInPandas(bounded(_packed(bounds, least)), "block int, place int, key long, hash long, packed binary")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = sent.repartition(n, "block").sortWithinPartitions("block", "place", "key", "hash")
    schema = (
        "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return ordered.mapInPandas(bounded(_by_block), schema).withColumnRenamed("id", id_col)
