"""Near vectors, resampling and tokenizer alignment against plain versions, on odd, empty and driver tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import connect, differences
from tokenizers import Tokenizer

from starfold.llm import cap_filters, importance, queries, token_overlaps
from starfold.llm.oracles import ORACLES

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<double>, label int, node long, copies int, filter string"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None


def linked(rows, similarity=0.98):
    """(n_links, component) of each row, from all pairs."""
    def able(v):
        return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def unit(v):
        a = np.array(v) / np.abs(v).max()
        return a / np.linalg.norm(a)

    near = {i: set() for i in range(len(rows))}
    for i, (_, v, a) in enumerate(rows):
        for j, (_, w, b) in enumerate(rows[:i]):
            if a is not None and a == b and able(v) and able(w) and len(v) == len(w) and unit(v) @ unit(w) >= similarity:
                near[i].add(j)
                near[j].add(i)
    out = []
    for i in near:
        reached, todo = {i}, [i]
        while todo:
            new = near[todo.pop()] - reached
            reached |= new
            todo += new
        out.append((len(near[i]), min((rows[k][0] for k in reached if rows[k][0] is not None), default=None)))
    return out


def vector_rows(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, 1, "x") for i, v, label in rows], VECTORS)


def around(r, centre, cosine):
    """A vector of random length at this cosine from `centre`."""
    noise = r.standard_normal(len(centre))
    noise -= noise @ centre * centre
    noise /= np.linalg.norm(noise)
    return ((cosine * centre + math.sqrt(1 - cosine**2) * noise) * r.uniform(0.1, 9)).tolist()


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.1], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None),
        (6, None, 1), (7, [], 1), (8, [0.0, 0.0], 1), (9, [nan, 1.0], 1), (10, [inf, 1.0], 1), (11, [None, 1.0], 1),
        (12, [1e300, 0.0], 1), (13, [1e-300, 0.0], 1), (14, [1.0, 0.0, 0.0], 1), (15, [0.0, 1.0], 1), (15, [0.0, 2.0], 1),
        (None, [-1.0, 0.0], 1), (None, [0.0, -3.0], 2), (16, [-2.0, 0.0], 1), (17, [1.0], 3), (18, [-4.0], 3), (19, [2.0], 3),
    ]
    found = cap_filters.near_vectors(vector_rows(spark, rows)).collect()
    want = Counter((row[0], *n) for row, n in zip(rows, linked(rows)))
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in found) == want
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in found)
    empty = cap_filters.near_vectors(vector_rows(spark, []))
    assert empty.columns == ["vec_id", "n_links", "component_id", "kept"] and empty.count() == 0


@pytest.mark.parametrize("block", [8, 1024])
def test_vectors_against_all_pairs(spark, block):
    r = np.random.default_rng(4)
    rows = []
    for family in range(30):
        centre = r.standard_normal(48)
        centre /= np.linalg.norm(centre)
        rows += [(len(rows) + k, around(r, centre, r.uniform(0.985, 0.999)), family % 2) for k in range(family)]
    # A third of all rows are one vector, and a chain holds together what is not near.
    rows += [(1000 + k, rows[5][1], rows[5][2]) for k in range(200)]
    frame = vector_rows(spark, rows).repartition(4)
    found = {x.vec_id: x for x in cap_filters.near_vectors(frame, block=block).collect()}
    want = linked(rows)
    total = sum(n for n, _ in want)
    assert all(found[row[0]].n_links <= n for row, (n, _) in zip(rows, want))
    assert sum(x.n_links for x in found.values()) >= 0.995 * total
    assert sum(found[row[0]].component_id == c for row, (_, c) in zip(rows, want)) >= 0.995 * len(rows)


@pytest.mark.parametrize("dim, n", [(1, 100), (2, 1000), (16, 5000), (64, 50_000), (64, 5_000_000)])
def test_pairs_of_just_the_wanted_cosine_share_a_filter(dim, n):
    code = cap_filters.calibrated(dim, n, 0.98)
    r = np.random.default_rng(9)
    a = r.standard_normal((1000, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = np.array([around(r, x, 0.98) for x in a]) if dim > 1 else a.copy()
    lists = [set(zip(*(x.tolist() for x in cap_filters.listed(cap_filters.unit_vectors(list(s)), code)))) for s in (a, b)]
    assert len({row for row, _ in lists[0] & lists[1]}) >= 980
    assert len(lists[0]) <= 5 * cap_filters.LEAST * len(a)


def test_listed_filters_are_all_that_exceed_alpha():
    turn, words = cap_filters.code_words(24, 12, 3)
    unit = cap_filters.unit_vectors(list(np.random.default_rng(1).standard_normal((50, 24))))
    row, name, _ = cap_filters.decode(unit, cap_filters.Code(turn, words, 0.3))
    want = set()
    for i, x in enumerate(unit @ turn.T):
        sums = [[float(x[p * 8 : p * 8 + 8] @ w) for w in words[p]] for p in range(3)]
        for f in range(12**3):
            if sums[0][f // 144] + sums[1][f // 12 % 12] + sums[2][f % 12] >= 0.3:
                want.add((i, f))
    assert set(zip(row.tolist(), name.tolist())) == want and len(row) == len(want)


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, id string, weight long, score string, rank int, down long, tie long, place long"


def features(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [
        zlib.crc32(" ".join(words[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(words) - n + 1)
    ]


def drawn(docs, target, percent=5, least=20):
    """(n_features, weight, score, rank) of each row."""
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    rows = []
    for own, text in docs:
        n, found = features(text)
        weight = sum(
            math.floor(1000 * math.log((t[f] + 1) * (s.total() + 10000) / ((s[f] + 1) * (t.total() + 10000)))) for f in found
        )
        h = int(hashlib.sha256(f"42:{'' if own is None else own}".encode()).hexdigest()[:8], 16)
        rows.append((n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = [i for i, row in enumerate(rows) if row[0] >= least]
    able.sort(key=lambda i: (-rows[i][3], docs[i][0] is None, docs[i][0] or 0))
    rank = {i: k + 1 for k, i in enumerate(able[: percent * len(able) // 100])}
    return [(*row[1:], rank.get(i)) for i, row in enumerate(rows)]


def doc_rows(spark, docs):
    return spark.createDataFrame([(i, t, "x", 7, "y", 1, 2, 3, 4) for i, t in docs], DOCS)


@pytest.mark.parametrize("piece", [3, 1_000_000])
def test_resampling_against_a_plain_version(spark, piece):
    r = random.Random(5)
    word = lambda: f"{r.choice('bcdfg')}{r.choice('aeiou')}{r.choice(['', 'É', '-x', '7', ' ', '_'])}"
    docs = [(i, " ".join(word() for _ in range(r.randrange(60)))) for i in range(150)]
    docs += [(500, None), (501, ""), (502, "Ａ½   x"), (503, "é " * 9000), (None, "one two " * 30)]
    target = [" ".join(word() for _ in range(40)) for _ in range(10)] + [None, "", docs[3][1]]
    frame = spark.createDataFrame([(t,) for t in target], "text string")
    found = importance.resample(doc_rows(spark, docs).repartition(5), frame, percent=30, piece=piece).collect()
    want = Counter((d[0], *w) for d, w in zip(docs, drawn(docs, target, percent=30)))
    assert Counter(tuple(row) for row in found) == want


def test_resampling_of_repeated_and_no_rows(spark):
    docs = [(7, "a b c " * 10)] * 40 + [(None, "a b c " * 10)] * 60
    found = importance.resample(doc_rows(spark, docs), doc_rows(spark, []), percent=50).collect()
    assert sorted(row["rank"] for row in found if row["rank"]) == list(range(1, 51))
    assert Counter(tuple(row)[:4] for row in found) == Counter((d[0], *w[:3]) for d, w in zip(docs, drawn(docs, [])))
    for few in ([], docs[:1]):
        rows = importance.resample(doc_rows(spark, few), doc_rows(spark, docs)).collect()
        assert [row["rank"] for row in rows] == [None] * len(few)


def test_cutoff_is_the_key_of_the_rank(spark):
    r = random.Random(6)
    keys = [(r.randrange(-3, 3), r.randrange(-5, 5), i) for i in range(300)]
    frame = spark.createDataFrame(keys, "a long, b long, c long").repartition(7)
    for rank in (1, 2, 150, 299, 300):
        assert importance.cutoff(frame, ["a", "b", "c"], rank, piece=11) == sorted(keys)[rank - 1]
    assert importance.cutoff(frame, ["a", "b", "c"], 301) is None
    assert importance.cutoff(frame.filter("false"), ["a", "b", "c"], 1) is None


def plain_alignment(tokenizers, text):
    """(a ids, b ids, groups, links as places) of one text."""
    ids = tokenizers.encode(text)
    spans = []
    for table, side in zip((tokenizers.a_bytes, tokenizers.b_bytes), ids):
        at, found = 0, []
        for i in side:
            found.append((at, at + len(table[i]), i))
            at += len(table[i])
        spans.append(found)
    links = [(a[2], b[2]) for a in spans[0] for b in spans[1] if a[0] < b[1] and b[0] < a[1]]
    groups, last = [], 0
    for end in sorted({s[1] for s in spans[0]} & {s[1] for s in spans[1]}):
        groups.append("|".join(",".join(str(i) for s, e, i in side if last < e <= end) for side in spans))
        last = end
    return *ids, groups, links


@pytest.fixture(scope="module")
def tokenizers():
    return token_overlaps.Tokenizers()


def alignment_rows(tokenizers, docs):
    found = [plain_alignment(tokenizers, text) for _, text in docs]
    held = Counter(pair for *_, links in found for pair in set(links))
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    return [
        (own, len(a), len(b), len(groups), len(links), sum(held[k] == best[k[0]] for k in links), sum(held[k] for k in links), ";".join(groups))
        for (own, _), (a, b, groups, links) in zip(docs, found)
    ]


ODD_TEXTS = [
    None, "", " ", "  two  blanks  ", "tab\tand\r\nline\n", "naïve Straße 東京 🎉🏽", "<|endoftext|> <s> </s> <unk>", "▁under▁",
    "a" * 3000, "x" * 50 + " " * 300 + "y", "\x00\x01\x7f", "﻿bom ﬁ ½", "don't they'LL 12345678 ...!!!", "ééé" * 50,
    "<0x41> 0x41", "   　 wide",
]


@pytest.mark.parametrize("block", [1, 60, 2_000_000])
def test_alignment_against_a_plain_version(spark, tokenizers, block):
    r = random.Random(8)
    words = "the of and Zahl été 12 co-operate isn't unbelievable \n x".split(" ")
    docs = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "the of"), (3, "the of"), (3, "the of")]
    docs += [(100 + i, " ".join(r.choice(words) for _ in range(r.randrange(80)))) for i in range(20)]
    schema = "doc_id long, text string, id string, block int, codes string, groups int, pairs string"
    frame = spark.createDataFrame([(*d, "x", 1, "y", 2, "z") for d in docs], schema).repartition(3)
    found = token_overlaps.compare_tokenizers(frame, block_chars=block)
    assert Counter(map(tuple, found.collect())) == Counter(alignment_rows(tokenizers, docs))
    assert token_overlaps.compare_tokenizers(frame.limit(0)).count() == 0


def test_alignment_query_on_the_driver_table(spark, tokenizers):
    found = queries.QUERIES["op13_token_alignment"](spark, SF).collect()
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    docs = [d for d in docs if len(d[1] or "") < 6000]
    whole = {r.doc_id: r for r in found}
    assert len(found) == len(whole) >= len(docs)
    for own, text in docs:
        a, b, groups, links = plain_alignment(tokenizers, text)
        row, text = whole[own], ";".join(groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if text else ""
        assert (row.n_a, row.n_b, row.n_groups, row.n_links, row.groups_sha256) == (len(a), len(b), len(groups), len(links), digest)


def test_words_are_encoded_as_the_whole_text_is(spark, tokenizers):
    """By the library that the vocabulary file is made for, special strings as plain text."""
    reference = Tokenizer.from_file(token_overlaps.BYTE_VOCABULARY)
    reference.encode_special_tokens = True
    r = random.Random(9)
    word = ["a", "Straße", "don't", "", "12", "x.", "▁", "日本", "\n", "end\t", "unbelievable", "<|endoftext|>", "\u0301x", "\xa0"]
    texts = [t for t in ODD_TEXTS if t] + [" ".join(r.choice(word) for _ in range(3000))]
    texts += [t.text for t in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect() if t.text]
    assert tokenizers.divisible
    for text in texts:
        assert " ".join(token_overlaps.words(text)) == text
        a = reference.encode(" " + text, add_special_tokens=False).ids
        b = tokenizers.pieces.encode(text, num_threads=1)
        back = b"".join(map(tokenizers.b_bytes.__getitem__, b)) == (" " + text).encode()
        assert tokenizers.encode(text) == ((a, b) if back else ([], []))
        assert b"".join(map(tokenizers.a_bytes.__getitem__, a)) == (" " + text).encode()


def test_overlaps_hold_the_groups(spark, tokenizers):
    docs = [(i, t) for i, t in enumerate(ODD_TEXTS)]
    found = defaultdict(list)
    rows = token_overlaps.overlaps(spark.createDataFrame(docs, "doc_id long, text string")).orderBy("doc_id", "group").collect()
    for row in rows:
        assert row.start == (found[row.doc_id][-1][1] if found[row.doc_id] else 0)
        found[row.doc_id].append((f"{','.join(map(str, row.a_ids))}|{','.join(map(str, row.b_ids))}", row.end))
    for own, text in docs:
        *_, groups, _ = plain_alignment(tokenizers, text)
        assert [g for g, _ in found[own]] == groups
        if groups:
            assert found[own][-1][1] == len((" " + text).encode())
