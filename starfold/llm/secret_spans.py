"""Secrets in texts: what their wording gives away, and encoded candidates confirmed by their structure."""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starfold.llm.common import bounded

# The patterns and least lengths of the base kinds, and the order of kinds.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "der", "openssh", "jwt")

_ENCODED = re.compile(r"[A-Za-z0-9+/](?:[A-Za-z0-9+/]|\r?\n(?=[A-Za-z0-9+/])){38,}={0,2}|[A-Za-z0-9_-]{40,}={0,2}")
# Where a key may start in base64: the tag of a sequence and a length, or the magic of the length-prefixed kind.
_START = re.compile(r"M(?=[A-P\r\n])|b3Bl")
_PIECE = re.compile(r"[A-Za-z0-9+/_-]+")
# Hex digits that colons, or line ends and indentation, may part.
_HEX_ANY = re.compile(r"[0-9A-Fa-f](?:(?::?\r?\n[ \t]{0,16}|:)?+[0-9A-Fa-f]){63,}+")
_HEX_COLONS = re.compile(r"(?:[0-9A-Fa-f]{2}:){8}")
_NO_DIGIT = re.compile(r"[^0-9A-Fa-f]+")
# Where a key may start in hex digits: a sequence, its length and a version of 0 or 1, or the magic.
_HEX_START = re.compile(
    r"(?=30(?:[0-7].|81.{2}|82.{4}|83.{6}|84.{8})02010[01]|6f70656e7373682d6b65792d763100)"
)
# What a text must hold for the slower patterns to be tried on it.
_LONG_RUN = re.compile(r"[A-Za-z0-9+/_-]{32,}")
_MAGIC = b"openssh-key-v1\0"
_NAMES = ("passw", "secret", "token", "key")
_HEADERS = ("eyJ", "eyA", "ewo", "ew0")
_HEADER = re.compile("|".join(_HEADERS))
# Dotted parts; each run is tried from its first character alone, so that long runs take time in proportion.
_DOTTED = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]++(?:\.[A-Za-z0-9_-]++){2,}+")
_JSON = json.JSONDecoder()
# How an object with a member begins; a failed parse is far dearer than a failed match.
_MEMBER = re.compile(r'\s*\{\s*"(?:[^"\\]|\\.)*+"\s*:')


def _element(data: bytes, at: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the tagged element at a place, if its length is well formed and fits."""
    if at + 2 > len(data):
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if size >= 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or at + n > len(data) or data[at] == 0:
            return None
        size, at = int.from_bytes(data[at : at + n], "big"), at + n
        if size < 0x80:
            return None
    return (tag, at, at + size) if at + size <= len(data) else None


def _children(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """Elements that fill a range exactly, or None."""
    out = []
    while start < end:
        found = _element(data, start)
        if found is None or found[2] > end:
            return None
        out.append(found)
        start = found[2]
    return out


def is_private_key(data: bytes) -> bool:
    """Whether bytes are a private key: one sequence that fills them, with nested lengths that fit.

    Known are a list of nine or more integers (version 0 or 1), a version with an algorithm's sequence and an octet
    string, and version 1 with an octet string of 16 bytes or more.
    """
    outer = _element(data, 0)
    if outer is None or outer[0] != 0x30 or outer[2] != len(data):
        return False
    parts = _children(data, outer[1], outer[2])
    if not parts or parts[0][0] != 0x02 or parts[0][2] - parts[0][1] != 1 or data[parts[0][1]] > 1:
        return False
    tags = [p[0] for p in parts]
    if len(parts) >= 9 and tags[:9] == [0x02] * 9:
        return True
    if len(parts) >= 3 and tags[1:3] == [0x30, 0x04]:
        inner = _children(data, parts[1][1], parts[1][2])
        return bool(inner) and inner[0][0] == 0x06
    return len(parts) >= 2 and tags[1] == 0x04 and parts[1][2] - parts[1][1] >= 16


def is_openssh_key(data: bytes) -> bool:
    """Whether bytes are a private key of the length-prefixed kind: its magic, then fields whose lengths nest."""
    return openssh_size(data) is not None


def openssh_size(data: bytes) -> int | None:
    """Size of the private key of the length-prefixed kind that bytes begin with, or None."""
    if not data.startswith(_MAGIC):
        return None
    at = len(_MAGIC)
    fields = []
    for n in range(3):  # cipher, key derivation and its options
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            return None
        fields.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    keys = int.from_bytes(data[at : at + 4], "big")
    at += 4
    if not fields[0].isascii() or not 1 <= keys <= 16:
        return None
    for _ in range(keys + 1):
        size = int.from_bytes(data[at : at + 4], "big")
        if not size or at + 4 + size > len(data):
            return None
        at += 4 + size
    return at


def is_signed_token(text: str) -> bool:
    """Whether the first part of a three-part token decodes to a header that names an algorithm other than none."""
    parts = text.split(".")
    try:
        header = json.loads(_decoded(parts[0]) or b"")
        payload = _decoded(parts[1])
    except (ValueError, RecursionError):
        return False
    if not isinstance(header, dict) or payload is None or _decoded(parts[2]) is None:
        return False
    algorithm = header.get("alg")
    return isinstance(algorithm, str) and bool(algorithm) and algorithm.lower() != "none"


def _decoded(text: str) -> bytes | None:
    plain = re.sub(r"\s+", "", text).rstrip("=").translate(str.maketrans("-_", "+/"))
    if len(plain) % 4 == 1:
        return None
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _encoded(text: str, at: int, n: int) -> tuple[str, int]:
    """The next `n` base64 characters, or as many as there are, without line breaks between them, and their end."""
    parts = []
    while n:
        m = _PIECE.match(text, at, at + n)
        if m is None:
            break
        parts.append(m[0])
        at, n = m.end(), n - len(m[0])
        if n:
            after = at + (2 if text.startswith("\r\n", at) else 1 if text.startswith("\n", at) else 0)
            if after == at or _PIECE.match(text, after, after + 1) is None:
                break
            at = after
    return "".join(parts), at


def _prefix(text: str, at: int, size: int) -> tuple[bytes, int]:
    """At most `size` bytes that the base64 from a place on decodes to, and where their characters end."""
    plain, end = _encoded(text, at, -(-size * 4 // 3))
    return (_decoded(plain) or b"")[:size], end


def keys_within(text: str, start: int, end: int) -> list[tuple[str, int, int]]:
    """(kind, start, end) of keys in base64 that start in a range, whatever words stand right before or after them.

    A key may start at any character and ends where its own outer length, or its last field, says.
    """
    out, at = [], start
    while (m := _START.search(text, at, end)) is not None:
        begin = m.start()
        at = begin + 1
        if m[0] == "M":
            head = _prefix(text, begin, 9)[0]
            n = head[1] & 0x7F if len(head) == 9 and head[1] >= 0x80 else 0
            if len(head) < 9 or head[0] != 0x30 or n > 4 or head[2 + n : 4 + n] != b"\2\1" or head[4 + n] > 1:
                continue
            size = 2 + n + (int.from_bytes(head[2 : 2 + n], "big") if n else head[1])
            data, last = _prefix(text, begin, size) if size <= len(text) else (b"", begin)
            kind = "der" if is_private_key(data) else None
        else:
            if _prefix(text, begin, len(_MAGIC))[0] != _MAGIC:
                continue
            size = openssh_size(_longest(text, begin))
            kind, last = ("openssh", _prefix(text, begin, size)[1]) if size else (None, begin)
        if kind:
            padded = 0
            while padded < -size % 3 and text.startswith("=", last):
                last, padded = last + 1, padded + 1
            out.append((kind, begin, last))
            at = last
    return out


def _longest(text: str, at: int) -> bytes:
    """What all base64 from a place on decodes to; characters that are no whole byte are left out."""
    plain = _encoded(text, at, len(text))[0]
    return _decoded(plain[: len(plain) // 4 * 4 + (len(plain) % 4 if len(plain) % 4 != 1 else 0)]) or b""


def keys_in_hex(text: str, start: int, end: int) -> list[tuple[str, int, int]]:
    """(kind, start, end) of keys in the hex digits of a range, whatever digits stand right before or after them.

    A key may start at any digit and ends where its own lengths say; what parts the digits is passed over.
    """
    run = text[start:end]
    digits = _NO_DIGIT.sub("", run).lower()
    out, at = [], 0
    while (m := _HEX_START.search(digits, at)) is not None:
        begin = m.start()
        at, kind, size = begin + 1, None, None
        if digits.startswith("30", begin):
            n = int(digits[begin + 2 : begin + 4], 16)
            more = n & 0x7F if n & 0x80 else 0
            size = 2 + more + (int(digits[begin + 4 : begin + 4 + 2 * more], 16) if more else n)
            if 2 * size <= len(digits) - begin and is_private_key(bytes.fromhex(digits[begin : begin + 2 * size])):
                kind = "der"
        else:
            left = len(digits) - begin
            size = openssh_size(bytes.fromhex(digits[begin : begin + left // 2 * 2]))
            kind = "openssh" if size else None
        if kind:
            at = begin + 2 * size
            out.append((kind, begin, at))
    if out and len(digits) < len(run):
        places = [i for i, c in enumerate(run) if c not in ": \t\r\n"]
        out = [(kind, places[a], places[b - 1] + 1) for kind, a, b in out]
    return [(kind, start + a, start + b) for kind, a, b in out]


def _header_starts(part: str) -> list[int]:
    """Places in a part from which the rest of it decodes to a JSON object.

    A part is decoded once for each place of its first character in a group of four, not once for each place.
    """
    out, plain = [], {}
    for begin in dict.fromkeys([0, *(m.start() for m in _HEADER.finditer(part))]):
        lead = begin % 4
        if lead not in plain:
            plain[lead] = (_decoded(part[lead:]) or b"").decode("latin-1").rstrip()
        if _MEMBER.match(plain[lead], begin // 4 * 3) is None:
            continue
        try:
            if _JSON.raw_decode(plain[lead], begin // 4 * 3)[1] == len(plain[lead]):
                out.append(begin)
        except (ValueError, RecursionError):
            continue
    return out


def tokens_within(text: str, start: int, end: int) -> list[tuple[str, int, int]]:
    """Signed tokens among the dotted parts of a range: each part, and each place in it, may begin the header.

    Of a last part that has one character too many for base64 that character is left out.
    """
    parts, out, i, at = text[start:end].split("."), [], 0, start
    places = []
    for part in parts:
        places.append(at)
        at += len(part) + 1
    while i + 2 < len(parts):
        header, payload, sign = parts[i : i + 3]
        if len(sign) % 4 == 1:
            sign = sign[:-1]
        found = None
        if len(header) >= 8 and len(payload) >= 2 and len(sign) >= 16 and any(h in header for h in _HEADERS):
            starts = (p for p in _header_starts(header) if len(header) - p >= 8)
            found = next((p for p in starts if is_signed_token(f"{header[p:]}.{payload}.{sign}")), None)
        if found is not None:
            out.append(("jwt", places[i] + found, places[i + 2] + len(sign)))
        i += 1 if found is None else 3
    return out


def find(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all secrets, ordered by start and then kind; code points, end exclusive.

    Kinds `assign`, `access` and `hex` go by their wording. Candidates in base64 or hex are reported as `der` or
    `openssh` if they decode to a private key, and dotted ones as `jwt` if they are signed tokens. Keys and tokens may
    begin anywhere in a run, so that words or digits joined to one don't hide it.
    """
    spans, lower = [], text.lower()
    if any(name in lower for name in _NAMES):
        spans += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    if any(header in text for header in _HEADERS):
        for m in _DOTTED.finditer(text):
            spans += tokens_within(text, *m.span())
    long_run = _LONG_RUN.search(text)
    if long_run:
        spans += [("hex", *m.span()) for m in _HEX.finditer(text)]
        for m in _ENCODED.finditer(text):
            data = _decoded(m[0])
            if data and is_private_key(data):
                spans.append(("der", *m.span()))
            elif data and openssh_size(data) == len(data):
                spans.append(("openssh", *m.span()))
            else:
                spans += keys_within(text, *m.span())
    if long_run or _HEX_COLONS.search(text):
        for m in _HEX_ANY.finditer(text):
            spans += keys_in_hex(text, *m.span())
    return sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def redact(text: str, spans: list[tuple[str, int, int]], mark: str = "[secret]") -> str:
    """The text with each stretch that spans cover replaced by a mark."""
    out, at = [], 0
    for _, start, end in spans:
        if end <= at:
            continue
        if start >= at and (start > at or not out):
            out += [text[at:start], mark]
        at = end
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, spans array of (kind, start, end), redacted text) for every row.

    Null texts count as empty; empty texts have no spans. Repeated rows are scanned alike and stay. Extra columns are
    ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = ["" if t is None else t for t in batch["text"]]
            found = [find(t) for t in texts]
            as_rows = [[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in found]
            yield pd.DataFrame({
                "id": batch["id"], "spans": as_rows, "redacted": [redact(t, s) for t, s in zip(texts, found)],
            })

    schema = f"id {kind}, spans array<struct<kind:string,start:long,end:long>>, redacted string"
    return rows.mapInPandas(bounded(run), schema).withColumnRenamed("id", id_col)


def scan_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of the base kinds, the SHA-256 of their joined spans, and all spans joined, for every row of `scan`."""
    spans = scan(docs, id_col, text_col)
    item = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return spans.select(
        id_col, count("assign"), count("access"), count("hex"),
        F.sha2(F.array_join(F.transform(base, item), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", item), ",").alias("spans"),
    )



def redacted(docs: DataFrame, text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """The rows of `docs` with secrets in their texts replaced by a mark, and the sizes of such texts counted anew.

    Rows without a secret, null texts among them, stay as they are; so do all other columns. A table without `size_col`
    has only its texts changed.
    """
    text_at = docs.columns.index(text_col)
    size_at = docs.columns.index(size_col) if size_col in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            spans = [find(t) if t else [] for t in texts]
            new = [redact(t, s) if s else t for t, s in zip(texts, spans)]
            columns = list(batch.columns)
            columns[text_at] = pa.array(new, batch.schema.field(text_at).type)
            if size_at is not None:
                sizes = [len(t) if s else n for t, s, n in zip(new, spans, batch.column(size_at).to_pylist())]
                columns[size_at] = pa.array(sizes, batch.schema.field(size_at).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(bounded(run), docs.schema)
