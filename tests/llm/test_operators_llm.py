"""Operators on small tables with nulls, empty and long texts, repeats and extra columns, and queries on driver tables."""

import hashlib
import random
import textwrap
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starfold.llm import (
    bloom_lookup, decontaminate, language, licenses, mixing, order_minhash, preferences, queries, secret_spans,
    token_trees, toxicity,
)

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, value long"


def table(spark, rows):
    full = [(i, t, lang, s, len(t or ""), "x", 1) for i, t, lang, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def words(r, n):
    return " ".join(f"{r.choice('bcdfg')}{r.choice('aeiou')}{r.randrange(300)}" for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    r = random.Random(1)
    base = words(r, 120)
    rows = [(None, base, "en", "a"), (3, base, "en", "a"), (3, base, "en", "a"), (4, base.upper(), "en", None),
            (5, None, None, "b"), (6, "", "en", "b"), (7, words(r, 9000), "de", "c"), (8, "12 34", "en", "c"),
            (9, words(r, 80), "en", "b"), (10, "a\n\nb", "en", "b")]
    return table(spark, rows)


def test_every_operator_takes_odd_and_empty_tables(spark, odd):
    items = spark.createDataFrame([(1, None), (None, "x"), (2, ""), (3, "nowhere to be found")], "item_id int, text string")
    turns = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    labels = spark.createDataFrame([(3, 1), (9, 0), (None, 1), (7, None)], "doc_id long, toxic int")
    assert preferences.format_preferences(preferences.swapped_answers(preferences.conversations(turns))).count() == 0
    for docs, n in ((odd, 10), (odd.limit(0), 0)):
        model = language.fit(docs, "doc_id", "text", "lang")
        tox = toxicity.fit(docs, labels)
        assert order_minhash.near_duplicates(docs).count() == n
        assert bloom_lookup.fingerprint_versions(docs).count() == n
        assert token_trees.count_edited(docs).count() == n
        assert secret_spans.scan_digests(docs).count() == n
        assert secret_spans.redacted(docs).collect() == docs.collect()
        assert mixing.Mix(docs).taken().count() == n
        assert language.identify(docs, model).columns[: len(docs.columns)] == docs.columns
        assert language.identify(docs, model).count() == n
        assert toxicity.rate(docs, tox).count() == n
        assert decontaminate.contaminated(docs, items).count() == 0
        assert decontaminate.without_items(docs, items).count() == n
        assert licenses.scan_licenses(docs).count() == 0
        for _, stage in corpus_pipeline.STAGES[:2]:
            assert stage(spark, docs, SF).columns == docs.columns


def test_near_duplicates_of_odd_rows(spark, odd):
    found = {}
    for row in order_minhash.near_duplicates(odd).collect():
        found.setdefault(row.doc_id, set()).add((row.class_id, row.class_size))
    assert found[None] == found[3] == found[4] == {(3, 4)}
    assert found[5] == found[6] == {(5, 2)}
    assert all(found[i] == {(i, 1)} for i in (7, 8, 9, 10))
    kept = corpus_pipeline.drop_near_duplicates(spark, odd, SF)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 5, 7, 8, 9, 10]


def test_near_duplicates_against_all_pairs(spark):
    r = random.Random(2)
    texts = [words(r, r.randrange(60, 200)) for _ in range(40)]
    for i in range(25):
        parts = r.choice(texts[:12]).split()
        for _ in range(r.randrange(1, 6)):
            parts[r.randrange(len(parts))] = f"new{i}"
        texts.append(" ".join(parts))
    shared = words(r, 60)
    texts += [f"{words(r, 100)} {shared} {words(r, 100)}" for _ in range(12)] + texts[:5]
    split = [t.split() for t in texts]
    name = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            longest = max(len(split[i]), len(split[j]))
            if order_minhash.edit_distance(split[i], split[j], longest) <= 0.2 * longest:
                name = [name[j] if n == name[i] else n for n in name]
    want = {i: min(k for k in range(len(texts)) if name[k] == name[i]) for i in range(len(texts))}
    docs = table(spark, [(i, t, "en", "a") for i, t in enumerate(texts)]).repartition(5)
    assert {r.doc_id: r.class_id for r in order_minhash.near_duplicates(docs).collect()} == want


def test_rounds_join_groups_that_one_leader_does_not(spark):
    """A group of three families under one value: leaders of each must be tried, and the chain 5-6 found."""
    r = random.Random(3)
    families = [words(r, 100).split() for _ in range(3)]
    texts = [" ".join([*f[:k], "z", *f[k + 1 :]]) for f in families for k in range(4)]
    docs = table(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    members = spark.createDataFrame([(v, i, 100) for v in (1, 2) for i in range(12)], "value long, node long, n_words long")
    names = order_minhash._joined(members, docs, "doc_id", "text", 0.8)
    assert {n.node: n.component for n in names.collect()} == {i: i // 4 * 4 for i in range(12)}


def test_pairs_that_agree_in_one_sketch_are_found(spark):
    """Three families that share no more than one value, which the first leader of the group joins to one only."""
    r = random.Random(6)
    families = [words(r, 100).split() for _ in range(3)]
    texts = [" ".join([*f[:k], "z", *f[k + 1 :]]) for f in families for k in range(4)] + [words(r, 300)]
    docs = table(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    members = [(1, i, 100) for i in range(12)] + [(1, 12, 300)]
    members = spark.createDataFrame(members, "value long, node long, n_words long")
    names = order_minhash._joined(members, docs, "doc_id", "text", 0.8)
    assert {n.node: n.component for n in names.collect()} == {i: i // 4 * 4 for i in range(12)} | {12: 12}


def test_short_texts_meet_slightly_longer_ones(spark):
    r = random.Random(7)
    eight, last, nine, first = ([f"{name}{i}" for i in range(n)] for name, n in (("a", 8), ("b", 8), ("c", 9), ("d", 9)))
    mid = [f"e{i}" for i in range(13)]
    pairs = [(eight, [*eight, "x"]), (["y", *last[1:]], last), (nine, [*nine[:-1], "x"]), (first, ["x", *first[1:]]),
             (mid, [*mid[:6], "x", *mid[7:]]), ([f"f{i}" for i in range(13)], [f"f{i}" for i in range(13)] + ["x"] * 3)]
    rows = [(2 * i + j, " ".join(t), "en", "a") for i, p in enumerate(pairs) for j, t in enumerate(p)]
    rows += [(90, " ".join(eight[:5]) + " p q r s t u", "en", "a"), (91, words(r, 9), "en", "a")]
    found = {x.doc_id: x.class_id for x in order_minhash.near_duplicates(table(spark, rows)).collect()}
    assert found == {i: i // 2 * 2 for i in range(12)} | {90: 90, 91: 91}


def test_aligned_pairs_grow_in_proportion(spark, monkeypatch):
    """Unlike texts with a common line, and others with a common passage of half their words."""
    aligned = []

    class Counted(order_minhash._Joiner):
        def take(self, pairs):
            pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
            aligned.append(pairs.count())
            super().take(pairs)

    monkeypatch.setattr(order_minhash, "_Joiner", Counted)
    monkeypatch.setattr(order_minhash, "FEW_COMPONENTS", 8)
    r = random.Random(8)
    line, passage = words(r, 6), words(r, 40)
    for make in (lambda: f"{words(r, 5)} {line}", lambda: f"{words(r, 20)} {passage} {words(r, 20)}"):
        pairs = []
        for n in (100, 200, 400):
            aligned.clear()
            rows = [(i, make(), "en", "a") for i in range(n)]
            rows += [(n + i, rows[i][1] + " x", "en", "a") for i in range(0, n, 10)]
            found = {x.doc_id: x.class_id for x in order_minhash.near_duplicates(table(spark, rows)).collect()}
            assert found == {i: i if i < n else i - n for i in found}
            pairs.append(sum(aligned))
            assert len(aligned) <= 6
        assert pairs[2] <= 5 * pairs[0] and pairs[2] < 40 * 400


def passages(r, n_texts, n_alike):
    """Unlike texts with a common passage of half their words, and some again, so edited that they share no other sequence."""
    passage = words(r, 50)
    rows = [(i, f"{words(r, 25)} {passage} {words(r, 25)}", "en", "a") for i in range(n_texts)]
    edit = lambda t: " ".join(f"x{k}" if (k < 25 or k >= 75) and k % 4 == 0 else w for k, w in enumerate(t.split()))
    return rows + [(n_texts + i, edit(rows[i][1]), "en", "a") for i in range(n_alike)]


@pytest.mark.parametrize("listed", [500_000, 0])
def test_alike_texts_that_share_frequent_sequences_alone_are_found(spark, monkeypatch, listed):
    monkeypatch.setattr(order_minhash, "LISTED", listed)
    rows = passages(random.Random(11), 80, 30)
    found = {x.doc_id: x.class_id for x in order_minhash.near_duplicates(table(spark, rows)).collect()}
    assert found == {i: i if i < 80 else i - 80 for i in found}


def test_alike_texts_of_frequent_words_alone_are_found(spark):
    """Texts of few words in an order of their own, each of which stands in many texts, and a line in all of them."""
    r = random.Random(12)
    rows = [(i, " ".join(["p q r s t u", *(r.choice("abcdefgh") for _ in range(40))]), "en", "a") for i in range(60)]
    edited = lambda t: " ".join(w if k < 6 or k % 9 else "z" for k, w in enumerate(t.split()))
    rows += [(60 + i, edited(rows[i][1]), "en", "a") for i in range(30)]
    docs = table(spark, rows)
    members = spark.createDataFrame([(1, row[0], 46) for row in rows], "value long, node long, n_words long")
    names = order_minhash._joined(members, docs, "doc_id", "text", 0.8)
    assert {n.node: n.component for n in names.collect()} == {i: i if i < 60 else i - 60 for i in range(90)}


def test_large_components_of_a_group_are_joined_by_any_of_their_nodes(spark):
    """Two chains of texts that drift apart; only texts near one end of each are alike."""
    r = random.Random(13)
    base = words(r, 100).split()
    chains = [[f"a{k}" if k < i else w for k, w in enumerate(base)] for i in range(45)]
    last = [f"b{k}" if k >= 84 else w for k, w in enumerate(chains[-1])]
    chains += [[f"c{k}" if 45 <= k < 45 + i and k < 84 else w for k, w in enumerate(last)] for i in range(1, 39)]
    docs = table(spark, [(i, " ".join(t), "en", "a") for i, t in enumerate(chains)])
    n = len(chains)
    members = [(1, i, 100) for i in range(n)] + [(2 + i, j, 100) for i in range(n - 1) if i != 44 for j in (i, i + 1)]
    members = spark.createDataFrame(members, "value long, node long, n_words long")
    names = order_minhash._joined(members, docs, "doc_id", "text", 0.8)
    assert {x.component for x in names.collect()} == {0}


@pytest.mark.parametrize("listed", [500_000, 0])
def test_runs_that_link_nothing_are_not_given_out(spark, monkeypatch, listed):
    """Of unlike texts with a common line only the runs that several texts share may become rows."""
    given, own = [], order_minhash.stored

    def counted(df, label):
        table = own(df, label)
        if label == "rare":
            given.append(table.select(F.sum(F.size("values"))).first()[0])
        return table

    monkeypatch.setattr(order_minhash, "stored", counted)
    monkeypatch.setattr(order_minhash, "LISTED", listed)
    r = random.Random(14)
    line = words(r, 6)
    rows = [(i, f"{' '.join(f'w{i}x{k}' for k in range(60))} {line}", "en", "a") for i in range(80)]
    rows += [(80 + i, rows[i][1].replace(f"w{i}x30 ", "z "), "en", "a") for i in range(3)]
    members = spark.createDataFrame([(1, row[0], 66) for row in rows], "value long, node long, n_words long")
    names = order_minhash._joined(members, table(spark, rows), "doc_id", "text", 0.8)
    assert {x.node: x.component for x in names.collect()} == {i: i if i < 80 else i - 80 for i in range(83)}
    assert given and sum(given) <= 2 * 3 * 62


def test_closed_groups_leave_the_rounds(spark):
    """Members of groups that have become one component are not carried on."""
    members = spark.createDataFrame([(1, 1, 9), (1, 2, 9), (2, 1, 9), (2, 3, 9)], "value long, node long, n_words long")
    names = spark.createDataFrame([(1, 1), (2, 1), (3, 3)], "node long, component long")
    left = order_minhash._open(members, names).collect()
    assert {(x.value, x.node, x.component) for x in left} == {(2, 1, 1), (2, 3, 3)}


@pytest.mark.parametrize("percent", [3, 8, 12, 15, 19])
def test_edited_texts_are_found(spark, percent):
    """Words replaced evenly; of the pairs that the definition calls alike at least nine in ten are in one class."""
    r = random.Random(percent)
    rows, alike = [], set()
    for i in range(120):
        old = words(r, r.randrange(100, 300)).split()
        new = list(old)
        for k in r.sample(range(len(old)), len(old) * percent // 100):
            new[k] = f"n{k}"
        hashed, begins = order_minhash.hashed_words([" ".join(old), " ".join(new)])
        if order_minhash.word_distance(hashed[: begins[1]], hashed[begins[1] :], 0.8) >= 0:
            alike.add(i)
        rows += [(2 * i, " ".join(old), "en", "a"), (2 * i + 1, " ".join(new), "en", "a")]
    found = {x.doc_id: x.class_id for x in order_minhash.near_duplicates(table(spark, rows)).collect()}
    joined = {i for i in range(120) if found[2 * i] == found[2 * i + 1]}
    assert joined <= alike and len(joined) >= 0.9 * len(alike)
    assert len(alike) == 120 or percent == 19


def test_fingerprints_follow_the_contract(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = sorted(rows)
    found = {r.doc_id: r for r in queries.bloom_fingerprint(spark, SF).collect()}
    assert len(found) == len(rows)
    for (i, text), (_, following) in zip(rows, [*rows[1:], rows[0]]):
        new, got = text[: len(text) - len(text) // 2] + following[: len(text) // 2], found[i]
        assert got.n_chars == len(text) and got.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        sets = [set(bloom_lookup.digests(t).tolist()) for t in (text, new, following)]
        for other, near in ((sets[1], got.near_edited), (sets[2], got.near_next)):
            total = len(sets[0]) + len(other)
            assert near == pytest.approx(2 * len(sets[0] & other) / total if total else 1.0)
    by_text = {}
    for i, text in rows:
        assert by_text.setdefault(text, found[i].fingerprint) == found[i].fingerprint


def test_mix_meets_its_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first, again = (mixing.Mix(d).taken().orderBy("doc_id").collect() for d in (docs, docs.repartition(7)))
    assert first == again
    source = {r.doc_id: r.source for r in docs.collect()}
    sizes, taken, target = {}, {}, {}
    for r in first:
        name = source[r.doc_id]
        sizes[name] = sizes.get(name, 0) + r.size
        taken[name] = taken.get(name, 0) + r.taken
        target[name] = r.target
        assert 0 <= r.taken <= 2 * r.size
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes))}
    left, open_, want = 1.5 * sum(sizes.values()), set(sizes), {}
    while True:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not full:
            break
        want |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        open_ -= full
    want |= {s: level * weight[s] for s in open_}
    for s in sizes:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= 1


def test_small_sources_meet_their_targets(spark):
    """Sources of 40 to 3,000 words, whose last block is short, full or the only one."""
    sizes = {"a": 300, "b": 300, "c": 300, "d": 256, "e": 40, "f": 3000, "g": 257, "h": 1000}
    rows = [(100 * k + i, " ".join(["w"] * (n - 10 * i if i == 3 else n // 4)), "en", s)
            for k, (s, n) in enumerate(sizes.items()) for i in range(4)]
    for few in (rows[:12], rows):
        mix, found = mixing.Mix(table(spark, few)), {}
        source = {i: s for i, _, _, s in few}
        for r in mix.taken().collect():
            taken, _ = found.get(source[r.doc_id], (0, 0))
            found[source[r.doc_id]] = taken + r.taken, r.target
            assert r.taken <= 2 * r.size
        assert all(abs(taken - target) <= 1 for taken, target in found.values())
        shards = mix.shards().groupBy("source").agg(F.sum("n_words").alias("n"), F.sum(F.size(F.split("text", " "))).alias("m")).collect()
        assert {r.source: (r.n, r.m) for r in shards} == {s: (taken, taken) for s, (taken, _) in found.items()}


def test_shards_hold_the_words_that_are_taken(spark):
    r = random.Random(4)
    rows = [(i, "  ".join(f"d{i}w{k}" for k in range(r.randrange(0, 90))), "en", r.choice("ab")) for i in range(40)]
    rows += [(41, "twice the same", "en", None), (41, "twice the same", "en", None), (42, None, "en", "a")]
    mix = mixing.Mix(table(spark, rows), block_words=16, shard_slots=8)
    shards = mix.shards().collect()
    assert all(len(s.text.split(" ")) == s.n_words <= 16 for s in shards)
    counts = {}
    for s in shards:
        for w in s.text.split(" "):
            counts[w[: w.index("w")] if w[0] == "d" else "41"] = counts.get(w[: w.index("w")] if w[0] == "d" else "41", 0) + 1
    taken = {}
    for t in mix.taken().collect():
        taken[t.doc_id] = taken.get(t.doc_id, 0) + t.taken
    assert {f"d{i}" if i != 41 else "41": n for i, n in taken.items() if n} == counts
    assert len({(s.shard, s.slot) for s in shards}) == len(shards)


def test_a_table_of_one_label_is_scored(spark):
    docs = table(spark, [(i, f"some words {i}", "en", "a") for i in range(9)] + [(9, None, "en", "a")])
    for label in (0, 1):
        labels = spark.createDataFrame([(i, label) for i in range(5)], "doc_id long, toxic int")
        found = toxicity.rate(docs, toxicity.fit(docs, labels)).collect()
        assert len(found) == 10 and {(r.score, r.predicted) for r in found} == {(float(label), label)}


def test_letters_alone_make_a_language(spark):
    docs = table(spark, [(1, "der Hund und die Katze", "de", "a"), (2, "the dog and the cat", "en", "a")] * 20
                 + [(3, t, None, "a") for t in ("½ ² Ⅷ 12", "\u0301", "e\u0301te\u0301", "the½dog")])
    model = language.fit(docs, "doc_id", "text", "lang")
    found = {r.text: r.lang_pred for r in language.identify(docs, model).filter("doc_id = 3").collect()}
    assert found["½ ² Ⅷ 12"] == found["\u0301"] == "und" and found["e\u0301te\u0301"] != "und" and found["the½dog"] == "en"


def test_a_rare_language_keeps_its_words(spark):
    r = random.Random(12)
    hot = [(i, " ".join("".join(r.choice("bcdfghk") for _ in range(5)) for _ in range(200)), "aa", "a") for i in range(60)]
    rare = [(1000 + i, "zebra quagga okapi", "zz", "a") for i in range(2)]
    docs = table(spark, hot + rare)
    model = language.fit(docs, "doc_id", "text", "lang", known_words=400)
    assert model.languages == ["aa", "zz"] and {"zebra", "quagga", "okapi"} <= set(model.words) and len(model.words) == 203
    found = {r.doc_id: r.lang_pred for r in language.identify(docs, model).collect()}
    assert found[1000] == "zz" and found[0] == "aa"


def test_items_without_an_id_are_cleaned_out(spark):
    item = "a benchmark question of several words that stands in a text"
    items = spark.createDataFrame([(None, item)], "item_id long, text string")
    docs = table(spark, [(1, f"before {item} after", "en", "a"), (2, "nothing of it", "en", "a")])
    assert [r.doc_id for r in decontaminate.without_items(docs, items).collect()] == [2]


def test_permutations_are_permutations(spark):
    for n in (1, 2, 3, 10, 257):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit(5)).alias("x")).collect()
        assert sorted(r.x for r in got) == list(range(n))


def test_secrets_on_the_driver_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    for r in queries.structural_secrets(spark, SF).collect():
        spans = secret_spans.find(texts[r.doc_id])
        base = [s for s in spans if s[0] in ("assign", "access", "hex")]
        assert r.spans == secret_spans.joined(spans)
        assert r.base_sha256 == hashlib.sha256(secret_spans.joined(base).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[0] == k for s in base) for k in ("assign", "access", "hex"))


def test_models_on_held_out_rows(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.word_backoff_language(spark, SF).collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.97 * len(held)
    scores = queries.subword_toxicity(spark, SF).collect()
    assert len(scores) == len(docs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in scores)


def test_a_very_long_text_leaves_the_toxicity_sample_whole(spark):
    r = random.Random(8)
    rows = [(i, words(r, 40) + (" wretchedfool" if i % 3 == 0 else ""), "en", "a") for i in range(120)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(120)], "doc_id long, toxic int")
    plain = table(spark, rows)
    total = sum(len(t) for _, t, _, _ in rows)
    want = toxicity.fit(plain, labels, sample_chars=total)
    long = [(i + 1000, words(r, 40) * (total // 100), "en", "a") for i in range(20)]
    more = labels.union(spark.createDataFrame([(i, 0) for i, *_ in long], "doc_id long, toxic int"))
    got = toxicity.fit(table(spark, rows + long), more, sample_chars=total)
    assert got.bias == want.bias and (got.buckets == want.buckets).all()
    assert toxicity.fit(plain, labels, sample_chars=10) == pytest.approx(1 / 3)


def test_every_notice_of_a_block_has_a_row(spark):
    t = licenses.TEMPLATES
    apache, mit, header = t["Apache-2.0"], t["MIT"], t["Apache-2.0-header"]
    rows = [(1, f"{mit}\n{apache}", "en", "a"), (2, f"x {apache} y {t['MIT-text'].replace('hereby granted', 'granted')} "
             f"z {mit} {mit}", "en", "a"), (3, f"{header} and {apache}", "en", "a"), (4, "license " * 3 + "of words", "en", "a")]
    found = licenses.scan_licenses(table(spark, rows)).collect()
    names = lambda i: sorted((x.license or "", x.verdict) for x in found if x.doc_id == i)
    assert names(1) == [("Apache-2.0", "exact"), ("MIT", "exact")]
    assert names(2) == [("Apache-2.0", "exact"), ("MIT", "exact"), ("MIT", "exact"), ("MIT-text", "reworded")]
    assert names(3) == [("Apache-2.0", "exact"), ("Apache-2.0-header", "exact")]
    (open_,) = [x for x in found if x.doc_id == 4]
    assert open_.license is None
    name = open_.verdict.split(":")[1]
    assert open_.differences.split(" ") == licenses.Scanner(t).differences(name, licenses.words(rows[3][1]))[1]


def test_wrapped_notices_are_found(spark):
    rows, want = [], []
    for name, text in licenses.TEMPLATES.items():
        for width in (20, 40, 60, 72, 80, 100):
            lines = textwrap.wrap(text, width, break_long_words=False, break_on_hyphens=False)
            for gap in ("\n", "\n\n"):
                cut = max(1, len(lines) // 2)
                body = "\n".join(lines[:cut]) + gap + "\n".join(lines[cut:])
                want.append(name)
                rows.append((len(rows), f"Some words before.\nMore of them.\n\n{body}\n\nAnd after.\n", "en", "a"))
    found = {}
    for x in licenses.scan_licenses(table(spark, rows)).collect():
        found.setdefault(x.doc_id, []).append((x.license, x.verdict))
        assert rows[x.doc_id][1][x.start : x.end].split()
    assert found == {i: [(name, "exact")] for i, name in enumerate(want)}
    far = "Released under the MIT License." + "\nplain line of words" * 200 + "\nAll software needs permission."
    both = licenses.scan_licenses(table(spark, [(1, far, "en", "a")])).collect()
    assert sorted((x.license or "", x.verdict.split(":")[0]) for x in both) == [("", "unconfirmed"), ("MIT", "exact")]


def test_language_of_unseen_words(spark):
    docs = table(spark, [(1, "the cat sat on the mat", "en", ""), (2, "die katze sitzt auf der matte", "de", "")] * 3)
    model = language.fit(docs, "doc_id", "text", "lang")
    names, scores = language.predict(model, ["the cats", "sitzt katzen", "12!", "", "ЖЖЖ", "matten katz"])
    assert names[:4] == ["en", "de", "und", "und"] and names[5] == "de" and scores[2] == scores[3] == 0 < scores[4]


def test_preferences_against_plain_python(spark):
    r = random.Random(5)
    rows = []
    for c in range(30):
        for t in range(r.randrange(1, 6)):
            rows.append((c * 3, t, r.choice(["user", "assistant"]), r.choice(["a", "b <|end|>", "", None, "日本"])))
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(4)
    got = {p.pair_id: p for p in preferences.format_preferences(
        preferences.swapped_answers(preferences.conversations(turns))).collect()}
    convs = {}
    for c, _, role, text in sorted(rows, key=lambda x: x[:2]):
        convs.setdefault(c, []).append((role, (text or "").replace("<|", "<||")))
    ids = sorted(convs)
    render = lambda ts: "".join(f"<|{a}|>\n{b}\n<|end|>\n" for a, b in ts)
    for i, c in enumerate(ids):
        one, other = convs[c], list(convs[c])
        answers = [t for a, t in convs[ids[(i + 1) % len(ids)]] if a == "assistant"]
        mine = [k for k, (a, _) in enumerate(one) if a == "assistant"]
        if mine:
            other[mine[-1]] = ("assistant", answers[-1] if answers else "")
        n = next((k for k, (a, b) in enumerate(zip(one, other)) if a != b), len(one))
        p = got[c]
        assert (p.n_common, p.prompt, p.chosen, p.rejected) == (n, render(one[:n]), render(one[n:]), render(other[n:]))
        for text, turns_, mask in ((p.chosen, one[n:], p.chosen_mask), (p.rejected, other[n:], p.rejected_mask)):
            trained = [f"{b}\n<|end|>\n" for a, b in turns_ if a == "assistant"]
            assert [text[m.start : m.end] for m in mask] == trained


def test_leaks_and_pipeline(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    found = {(r.doc_id, r.item_id): r.distance for r in queries.pigeonhole_leaks(spark, SF).collect()}
    exact = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    assert exact and {k for k, v in found.items() if v == 0} >= exact
    small = "/root/testdata/sf0.001"
    mixed = corpus_pipeline.run(spark, small).collect()
    assert mixed and not any(secret_spans.find(r.text) for r in mixed)


def test_names():
    assert sorted(queries.QUERIES) == sorted(queries.QUERIES, key=str) and len(queries.QUERIES) == 10
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 11))
