"""Benchmark items in documents, up to an edit budget: exact hits of pieces, then bit-parallel edit distance.

An item that stands in a text with at most e edits, cut into e + 1 pieces, has one piece without an edit. Around a hit
first two neighbouring pieces are compared, of which some pair has one edit at most, and then the whole item.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from starfold.llm.common import bounded

# Edits allowed for each code point of an item.
ERRORS = 0.1
# Code points of the items that one pass over the documents looks for; more items take more passes.
BLOCK_CHARS = 4_000_000


def folded(text: str) -> str:
    """Lower case, one code point for each."""
    lower = text.lower()
    return lower if len(lower) == len(text) else "".join(c if len(c.lower()) != 1 else c.lower() for c in text)


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """`errors` + 1 pieces of about the same length with their offsets; an item shorter than that has fewer edits."""
    n = min(errors, len(item) - 1) + 1
    ends = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(ends, ends[1:])]


def groups(parts: list[tuple[int, str]]) -> list[tuple[int, int, int]]:
    """Start, end and allowed edits of groups of two neighbouring pieces, the last of three if their number is odd.

    If there are fewer edits than pieces, some group has fewer edits than pieces, and a piece without any.
    """
    firsts = [*range(0, max(1, len(parts) - 1), 2), len(parts)]
    return [
        (parts[a][0], parts[b - 1][0] + len(parts[b - 1][1]), b - a - 1) for a, b in zip(firsts, firsts[1:])
    ]


class Pattern:
    """A string that is looked for with Myers' bit-parallel columns: one bit for each of its code points."""

    def __init__(self, text: str):
        self.size = len(text)
        self.places: dict[str, int] = {}
        for i, c in enumerate(text):
            self.places[c] = self.places.get(c, 0) | 1 << i

    def nearest(self, text: str, limit: int, enough: int = 0) -> tuple[int, int] | None:
        """Least edit distance to any substring of `text`, and where the first such substring ends; None if it is
        above `limit`. The search ends early at a distance of at most `enough`."""
        places, full, top = self.places, (1 << self.size) - 1, 1 << (self.size - 1)
        plus, minus, score = full, 0, self.size
        best, at = limit + 1, 0
        for j, c in enumerate(text):
            match = places.get(c, 0)
            diagonal = ((((match & plus) + plus) ^ plus) | match | minus) & full
            up = (minus | ~(diagonal | plus)) & full
            down = diagonal & plus
            if up & top:
                score += 1
            elif down & top:
                score -= 1
                if score < best:
                    best, at = score, j + 1
                    if best <= enough:
                        break
            up, down = (up << 1) & full, (down << 1) & full
            plus = (down | ~(diagonal | up)) & full
            minus = diagonal & up
        return (best, at) if best <= limit else None


def _halves(item: str, group: tuple, offset: int, size: int) -> tuple[str, int, str, int] | None:
    """The other piece of a pair in halves, with their offsets: the one next to the piece at `offset`, and the far one.

    Beside an exact piece the pair has one edit at most: the next half is as it was and where it was, or the far one is
    as it was, moved by one at most.
    """
    _, start, end, allowed, _ = group
    if allowed != 1:
        return None
    if offset == start:
        middle = (offset + size + end) // 2
        return item[offset + size : middle], offset + size, item[middle:end], middle
    middle = (start + offset) // 2
    return item[middle:offset], middle, item[start:middle], start


class Finder:
    def __init__(self, items: list[tuple[int, str]], errors: float):
        self.items = [(i, folded(t), min(int(len(t) * errors), len(t) - 1)) for i, t in items if t]
        self.patterns = [Pattern(t) for _, t, _ in self.items]
        self.automaton = ahocorasick.Automaton()
        self.groups: list[tuple[int, int, int, int, Pattern]] = []
        owners: dict[str, list[tuple]] = {}
        for place, (_, item, limit) in enumerate(self.items):
            parts = pieces(item, limit)
            first = len(self.groups)
            self.groups += [(place, a, b, k, Pattern(item[a:b])) for a, b, k in groups(parts)]
            for i, (offset, piece) in enumerate(parts):
                group = min(first + i // 2, len(self.groups) - 1)
                owners.setdefault(piece, []).append((group, offset, _halves(item, self.groups[group], offset, len(piece))))
        for piece, found in owners.items():
            self.automaton.add_word(piece, (len(piece), found))
        if owners:
            self.automaton.make_automaton()

    def _places(self, text: str) -> dict[int, list[int]]:
        """For each item, where it would begin by the pieces that are hit and whose groups hold."""
        begins: dict[int, set[int]] = {}
        for last, (size, owners) in self.automaton.iter(text):
            for group, offset, halves in owners:
                at = last + 1 - size - offset
                if halves is not None:
                    inner, inner_at, outer, outer_at = halves
                    if not text.startswith(inner, max(0, at + inner_at)) and outer not in text[
                        max(0, at + outer_at - 1) : max(0, at + outer_at + len(outer) + 1)
                    ]:
                        continue
                place, start, end, allowed, pattern = self.groups[group]
                if at in begins.get(place, ()):
                    continue
                stretch = text[max(0, at + start - allowed) : max(0, at + end + allowed)]
                if not allowed or pattern.nearest(stretch, allowed, allowed) is not None:
                    begins.setdefault(place, set()).add(at)
        return {place: sorted(found) for place, found in begins.items()}

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item id, distance, start, end) of each item in the text: its nearest place, of equal ones the first."""
        if not len(self.automaton) or not text:
            return []
        text = folded(text)
        out = []
        for place, begins in sorted(self._places(text).items()):
            id_, item, limit = self.items[place]
            best = None
            for low, high in _ranges(begins, 2 * limit):
                # Where a piece is, the item begins at most `limit` before or after the piece's place in it.
                low, high = max(0, low - limit), min(len(text), high + len(item) + limit)
                found = self.patterns[place].nearest(text[low:high], limit if best is None else best[0] - 1)
                if found is not None:
                    distance, end = found
                    back = Pattern(item[::-1]).nearest(text[low : low + end][::-1], distance, distance)
                    best = distance, low + end - back[1], low + end
                    if not distance:
                        break
            if best is not None:
                out.append((id_, *best))
        return out


def _ranges(starts: list[int], gap: int) -> list[tuple[int, int]]:
    """Sorted places, those within `gap` of each other joined."""
    out = [[starts[0], starts[0]]]
    for s in starts[1:]:
        if s - out[-1][1] <= gap:
            out[-1][1] = s
        else:
            out.append([s, s])
    return [(a, b) for a, b in out]


def contaminated(
    docs: DataFrame, items: DataFrame, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text",
    errors: float = ERRORS, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(id_col, item_col, distance, start, end) for each document and item that stands in it.

    An item stands in a text if some stretch of the text has an edit distance of at most `errors` times the item's
    length (rounded down), ignoring case. Of several stretches the nearest is reported, of equal ones the first that is
    found from the left; start and end are code points of the text.

    Null and empty texts hold no item; null and empty items stand nowhere. Repeated rows are reported each; items with
    equal texts are reported under each id, rows of the same id and text once. Extra columns are ignored.

    Items are the query set: a block of about half of `block_chars` code points of items is sent to all tasks at a time,
    and each block is one pass over the documents.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("length(text) > 0")
    kind, item_kind = rows.schema["id"].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    out = None
    for wanted in _item_blocks(items, item_col, item_text_col, block_chars):

        def run(batches: Iterator[pd.DataFrame], wanted=wanted) -> Iterator[pd.DataFrame]:
            finder = Finder(wanted.value, errors)
            for batch in batches:
                found = [(i, *hit) for i, t in zip(batch["id"], batch["text"]) for hit in finder.find(t)]
                yield pd.DataFrame(found, columns=["id", "item", "distance", "start", "end"])

        hits = rows.mapInPandas(bounded(run), f"id {kind}, item {item_kind}, distance long, start long, end long")
        out = hits if out is None else out.union(hits)
    return out.withColumnRenamed("id", id_col).withColumnRenamed("item", item_col)


def without_items(
    docs: DataFrame, items: DataFrame, text_col="text", item_col="item_id", item_text_col="text",
    errors: float = ERRORS, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The rows of `docs`, with all their columns, in which no item stands in the sense of `contaminated`."""
    place = docs.columns.index(text_col)
    # Which item stands in a text does not matter here, so one without an id is looked for as well.
    named = items.withColumn(item_col, F.coalesce(F.col(item_col).cast("string"), F.lit("")))
    for wanted in _item_blocks(named, item_col, item_text_col, block_chars):

        def run(batches: Iterator[pa.RecordBatch], wanted=wanted) -> Iterator[pa.RecordBatch]:
            finder = Finder(wanted.value, errors)
            for batch in batches:
                clean = [not finder.find(t or "") for t in batch.column(place).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(bounded(run), docs.schema)
    return docs


def _item_blocks(items: DataFrame, item_col: str, text_col: str, block_chars: int) -> list[Broadcast]:
    known = items.select(F.col(item_col).alias("item"), F.col(text_col).alias("wanted")).distinct()
    known = known.filter("item is not null and length(wanted) > 0")
    total = known.agg(F.sum(F.length("wanted"))).first()[0] or 0
    n_blocks = max(1, -(-2 * total // block_chars))
    blocks = []
    for block in range(n_blocks):
        part = known.filter(F.pmod(F.xxhash64("item", "wanted"), F.lit(n_blocks)) == block).orderBy("item", "wanted")
        blocks.append(items.sparkSession.sparkContext.broadcast([tuple(r) for r in part.collect()]))
    return blocks
