"""License notices by conditional compression: the template that best explains a block shrinks it most."""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, functions as F

from starfold.llm.common import bounded

# The wording of public license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS '
        "OF ANY KIND, either express or implied."
    ),
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
# Each template has one of these words; a block is a longest run of lines that have one too.
CUE = r"(?i)licen[sc]|permission|copyright|warrant|sublicen|software"
# Stands in the place of words that a confirmed notice has taken; no template has it.
_TAKEN = "\0"
# Largest share of a template's words that may differ, if no word differs that tells it from another template.
REWORDED = 0.1

_CUE = re.compile(CUE)
_WORD = re.compile(r"[\w./+-]*\w")


def blocks(text: str) -> list[tuple[int, int]]:
    """Spans of the longest runs of lines with a cue."""
    out, at = [], 0
    for line in text.split("\n"):
        if _CUE.search(line):
            if out and out[-1][1] + 1 == at:
                out[-1] = (out[-1][0], at + len(line))
            else:
                out.append((at, at + len(line)))
        at += len(line) + 1
    return out


def windows(text: str, around: int) -> list[tuple[int, int]]:
    """Spans of the blocks with `around` characters before and after, up to a blank; those that meet are one."""
    out: list[tuple[int, int]] = []
    for a, b in blocks(text):
        a = text.rfind(" ", 0, a - around) + 1 if a > around else 0
        b = text.find(" ", b + around)
        b = len(text) if b < 0 else b
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Scanner:
    def __init__(self, templates: dict[str, str], level: int = 3):
        self.templates = dict(sorted(templates.items()))
        self.longest = max(map(len, templates.values()), default=0)
        self.words = {name: words(t) for name, t in self.templates.items()}
        self.plain = zstandard.ZstdCompressor(level=level, write_checksum=False)
        self.with_ = {
            name: zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(
                t.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT))
            for name, t in self.templates.items()
        }
        sets = {name: set(w) for name, w in self.words.items()}
        close = lambda a, b: len(sets[a] & sets[b]) >= 0.5 * min(len(sets[a]), len(sets[b]))
        self.telling = {
            a: set().union(*(sets[a] ^ sets[b] for b in sets if b != a and close(a, b))) for a in sets
        }

    def differences(self, name: str, block: list[str]) -> tuple[int, list[str]]:
        """Words of the template found in order, and the wording differences between them."""
        template = self.words[name]
        matcher = difflib.SequenceMatcher(None, template, block, autojunk=False)
        found, out = 0, []
        codes = matcher.get_opcodes()
        inside = [i for i, c in enumerate(codes) if c[0] == "equal"]
        for i, (kind, a, b, c, d) in enumerate(codes):
            if kind == "equal":
                found += b - a
                continue
            extra = block[c:d] if inside and inside[0] < i < inside[-1] else []
            # Before the first and after the last match stands other text, of which only a replacement counts.
            if inside and not extra and b > a:
                extra = block[max(c, d - (b - a)) : d] if i < inside[0] else block[c : c + b - a]
            out += [f"-{w}" for w in template[a:b]] + [f"+{w}" for w in extra]
        return found, out

    def notices(self, block: str, taken=()) -> list[tuple[int, int, str, str, str]]:
        """(start, end, license, verdict, differences) of each confirmed notice in a block, ordered by place.

        Words in the spans `taken` belong to other notices.

        Templates are ranked as in `scan`. The words of the winner are taken out, at all places where it is exact, and
        the rest is ranked again until no template is confirmed.
        """
        spans = [m.span() for m in _WORD.finditer(block)]
        tokens = [block[a:b].lower() for a, b in spans]
        for start, end in taken:
            tokens = [_TAKEN if start <= a < end else t for t, (a, _) in zip(tokens, spans)]
        out = []
        while True:
            left = set(tokens)
            # Each word of a template that stands nowhere is a difference, so other templates can't be confirmed.
            able = [n for n, w in self.words.items() if sum(x not in left for x in w) <= REWORDED * len(w)]
            won = None
            for _, name in self._ranked(self._remaining(block, spans, tokens), able):
                won = self._confirmed(name, tokens)
                if won:
                    break
            if not won:
                return sorted(out)
            verdict, differences, places = won
            for first, last in places:
                out.append((spans[first][0], spans[last - 1][1], name, verdict, differences))
                tokens[first:last] = [_TAKEN] * (last - first)

    def _remaining(self, block: str, spans: list[tuple[int, int]], tokens: list[str]) -> str:
        """The block without the stretches whose words are taken."""
        out, at = [], 0
        for i, (a, b) in enumerate(spans):
            if tokens[i] == _TAKEN:
                if not i or tokens[i - 1] != _TAKEN:
                    out.append(block[at:a])
                at = b
        return "".join([*out, block[at:]])

    def _ranked(self, block: str, names) -> list[tuple[int, str]]:
        data = block.encode("utf-8", "surrogatepass")
        plain = len(self.plain.compress(data))
        return sorted(((plain - len(self.with_[n].compress(data)), n) for n in names), key=lambda s: (-s[0], s[1]))

    def _confirmed(self, name: str, tokens: list[str]) -> tuple[str, str, list[tuple[int, int]]] | None:
        """Verdict, differences and the ranges of words of a template's notices; None if its wording is not there."""
        template = self.words[name]
        n, places, at = len(template), [], 0
        while at + n <= len(tokens):
            try:
                at = tokens.index(template[0], at)
            except ValueError:
                break
            if tokens[at : at + n] == template:
                places.append((at, at + n))
                at += n
            else:
                at += 1
        if places:
            return "exact", "", places
        _, differences = self.differences(name, tokens)
        if len(differences) > REWORDED * n or {d[1:] for d in differences} & self.telling[name]:
            return None
        same = difflib.SequenceMatcher(None, template, tokens, autojunk=False).get_matching_blocks()[:-1]
        return "reworded", " ".join(differences), [(same[0].b, same[-1].b + same[-1].size)]

    def figures(self, name: str, block: str) -> tuple[int, int]:
        """Bytes of a block compressed alone, and how many fewer with a template as dictionary."""
        data = block.encode("utf-8", "surrogatepass")
        plain = len(self.plain.compress(data))
        return plain, plain - len(self.with_[name].compress(data))

    def rows(self, text: str) -> list[tuple]:
        """(start, end, license, verdict, plain bytes, bytes saved, differences): a row for each confirmed notice, and
        for each block without one.

        Notices are looked for across lines without a cue, up to the length of the longest template around each block,
        and then in each block alone.
        """
        alone, wide = blocks(text), windows(text, self.longest)
        found = [(a + x, a + y, *rest) for a, b in wide for x, y, *rest in self.notices(text[a:b])]
        for a, b in alone:
            if (a, b) not in wide:
                taken = [(x - a, y - a) for x, y, *_ in found if x < b and y > a]
                found += [(a + x, a + y, *rest) for x, y, *rest in self.notices(text[a:b], taken)]
        out = []
        for x, y, name, verdict, differences in found:
            touched = [s for s in alone if x < s[1] and y > s[0]]
            line_end = text.find("\n", y)
            start = min([text.rfind("\n", 0, x) + 1, *(a for a, _ in touched)])
            end = max([len(text) if line_end < 0 else line_end, *(b for _, b in touched)])
            out.append((start, end, name, verdict, *self.figures(name, text[start:end]), differences))
        held = [(x, y) for x, y, *_ in found]
        out += [(a, b, *self.scan(text[a:b])) for a, b in alone if not any(x < b and y > a for x, y in held)]
        return sorted(out, key=lambda row: row[:2])

    def scan(self, block: str) -> tuple[str | None, str, int, int, str]:
        """(license, verdict, plain bytes, bytes saved, differences); the license is None if no template is confirmed.

        Templates are ranked by the bytes that each as dictionary saves, ties by name; the first that its wording
        confirms wins. Without a winner the saving and the differences are those of the first.
        """
        data = block.encode("utf-8", "surrogatepass")
        plain = len(self.plain.compress(data))
        saved = sorted(((plain - len(c.compress(data)), name) for name, c in self.with_.items()),
                       key=lambda s: (-s[0], s[1]))
        tokens = words(block)
        first = None
        for reduction, name in saved:
            found, differences = self.differences(name, tokens)
            changed = {d[1:] for d in differences}
            if found == len(self.words[name]) and not differences:
                return name, "exact", plain, reduction, ""
            few = len(differences) <= REWORDED * len(self.words[name])
            if few and not changed & self.telling[name]:
                return name, "reworded", plain, reduction, " ".join(differences)
            first = first or (None, f"unconfirmed:{name}", plain, reduction, " ".join(differences))
        return first or (None, "unconfirmed", plain, 0, "")


def scan_licenses(docs: DataFrame, id_col="doc_id", text_col="text", templates: dict[str, str] | None = None):
    """One row for each confirmed notice, and for each block of lines with a cue word in which none lies: id_col, start,
    end (code points), license, verdict, plain_bytes, saved_bytes and differences.

    A notice may run over lines without a cue, and blank ones. Its span is that of its lines and of the blocks that
    they lie in; a block that holds several has a row for each.

    Texts without a cue, null and empty ones have no block. Repeated rows give repeated blocks, a block that several
    texts share is judged alike in each. Extra columns are ignored; an empty table gives no rows.
    """
    chosen = TEMPLATES if templates is None else templates
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.col("text").rlike(CUE))
    kind = rows.schema["id"].dataType.simpleString()
    names = ["license", "verdict", "plain_bytes", "saved_bytes", "differences"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(chosen)
        for batch in batches:
            found = []
            for id_, text in zip(batch["id"], batch["text"]):
                found += [(id_, *row) for row in scanner.rows(text)]
            yield pd.DataFrame(found, columns=["id", "start", "end", *names])

    schema = (
        f"id {kind}, start long, end long, license string, verdict string, plain_bytes long, saved_bytes long, "
        "differences string"
    )
    return rows.mapInPandas(bounded(run), schema).withColumnRenamed("id", id_col)
