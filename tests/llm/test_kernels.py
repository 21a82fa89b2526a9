"""Kernels against brute force."""

import random
from collections import Counter

import numpy as np

from starfold.llm import bloom_lookup, decontaminate, licenses, secret_spans, token_trees, toxicity
from starfold.llm.common import hashed_words
from starfold.llm.order_minhash import edit_distance, least_common, sequences, sketches, word_distance


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def plain_nearest(item, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def changed(r, text, letters, n):
    out = list(text)
    for _ in range(n):
        i, kind = r.randrange(len(out) + 1), r.randrange(3)
        if kind == 0:
            out.insert(i, r.choice(letters))
        elif out:
            out[min(i, len(out) - 1) :][:1] = []
            i = min(i, len(out) - 1)
            out[i : i + 1] = [] if kind == 1 else [r.choice(letters)]
    return out


def test_banded_alignment():
    r = random.Random(1)
    for _ in range(4000):
        a = [r.randrange(4) for _ in range(r.randrange(14))]
        b = changed(r, a, [0, 1, 9], r.randrange(5)) if r.random() < 0.6 else [r.randrange(4) for _ in range(9)]
        limit, far = r.randrange(10), plain_distance(a, b)
        assert edit_distance(a, b, limit) == min(far, limit + 1)


def test_word_hashes_do_not_depend_on_place_or_case():
    words, begins = hashed_words(["The cat", "", "a the\tCAT\nthe", "  "])
    assert np.diff(begins).tolist() == [2, 0, 4, 0]
    assert words[0] == words[3] == words[5] and words[1] == words[4] and len(set(words.tolist())) == 3


def test_sketches_ignore_place_in_a_batch_and_long_repeats():
    r = random.Random(2)
    texts = [" ".join(r.choice("abcdefgh") + str(r.randrange(60)) for _ in range(n)) for n in (300, 40, 7, 3)]
    row = lambda ts: sketches(*sequences(*hashed_words(ts), 5), 3, 2, 16)
    alone = np.concatenate([row([t]) for t in texts])
    assert (row(["x y", *texts])[1:] == alone).all()
    assert (row([""]) == 0).all()
    repeated = row([t + " so on" * 300 for t in texts[:1]] + [texts[1] + " so on" * 300])
    assert not (repeated[0] == repeated[1]).any()


def test_repeats_alone_do_not_make_texts_alike():
    r = random.Random(3)
    texts = [" ".join(f"w{r.randrange(9999)}" for _ in range(60)) + " is one" * 300 for _ in range(2)]
    words, begins = hashed_words(texts)
    assert word_distance(words[: begins[1]], words[begins[1] :], 0.8) == -1


def test_items_up_to_the_budget():
    r = random.Random(4)
    for _ in range(1500):
        item = "".join(r.choice("abc") for _ in range(r.randrange(1, 24)))
        text = "".join(r.choice("abc") for _ in range(12))
        text = text[:5] + "".join(changed(r, item, "xyz", r.randrange(5))) + text[5:]
        errors = r.choice([0, 0.1, 0.2, 0.3])
        limit = min(int(len(item) * errors), len(item) - 1)
        far, found = plain_nearest(item, text), decontaminate.Finder([(1, item)], errors).find(text)
        assert bool(found) == (far <= limit)
        if found:
            _, distance, start, end = found[0]
            assert distance == far == plain_distance(item, text[start:end])


def test_peeling_recovers_differences():
    r = random.Random(5)
    sets = [np.unique(np.array([r.getrandbits(64) for _ in range(n)], np.uint64)) for n in (0, 3, 60, 400)]
    sets += [np.unique(np.concatenate((sets[2][:50], sets[1]))), sets[3]]
    left, right = np.meshgrid(range(len(sets)), range(len(sets)))
    left, right = left.ravel(), right.ravel()
    found = bloom_lookup.differing(bloom_lookup.base_tables(sets), sets, left, right)
    for a, b, x, y in zip(left, right, *found):
        one, other = set(sets[a].tolist()), set(sets[b].tolist())
        assert (x, y) == (len(one - other), len(other - one))


def test_pieces_of_unbroken_text_survive_an_edit():
    text = " ".join(f"word{i * 7919 % 1000}" for i in range(400))
    assert len(bloom_lookup.pieces(text)) > 20 and "".join(bloom_lookup.pieces("a. b\n\nc")) == "a.bc"
    a, b = bloom_lookup.digests(text), bloom_lookup.digests("new start " + text[40:])
    assert len(np.intersect1d(a, b)) > 0.8 * len(a)


def test_trees_follow_edits():
    r, counter = random.Random(6), token_trees.Counter()
    letters = "ab  \n\t'sr1é!漢"
    for _ in range(200):
        doc = token_trees.Document("".join(r.choice(letters) for _ in range(r.randrange(900))), counter)
        for _ in range(6):
            start = r.randrange(len(doc.text) + 1)
            end = min(len(doc.text), start + r.randrange(30))
            doc.edit(start, end, "".join(r.choice(letters) for _ in range(r.randrange(12))))
            assert doc.tokens == len(counter.encoding.encode_ordinary(doc.text))
            assert (doc.tree.size if doc.tree else 0) == len(counter.split.findall(doc.text))
            assert doc.tree is None or doc.tree.chars == len(doc.text)


def test_an_edit_encodes_little():
    doc = token_trees.Document("one two three " * 3000, token_trees.Counter())
    assert doc.edit(20_000, 20_005, "four") < 12


def der(tag, body):
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x80 | (n.bit_length() + 7) // 8]) + n.to_bytes((n.bit_length() + 7) // 8, "big")
    return bytes([tag]) + size + body


def test_structures():
    import base64
    import json

    key = der(0x30, der(2, b"\0") + b"".join(der(2, bytes([7]) * 40) for _ in range(8)))
    pkcs8 = der(0x30, der(2, b"\0") + der(0x30, der(6, b"\x2a\x03")) + der(4, b"\1" * 64))
    assert secret_spans.is_private_key(key) and secret_spans.is_private_key(pkcs8)
    assert not any(secret_spans.is_private_key(key[:n] + b"\0") for n in range(len(key) - 1))
    field = lambda b: len(b).to_bytes(4, "big") + b
    ssh = b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + (1).to_bytes(4, "big") + field(b"p" * 51)
    assert not secret_spans.is_openssh_key(ssh) and secret_spans.is_openssh_key(ssh + field(b"k" * 80))
    part = lambda b: base64.urlsafe_b64encode(b).decode().rstrip("=")
    token = ".".join((part(json.dumps({"alg": "HS256"}).encode()), part(b"{}x"), part(b"s" * 32)))
    unsigned = ".".join((part(json.dumps({"alg": "none"}).encode()), part(b"{}x"), part(b"s" * 32)))
    wrapped = base64.encodebytes(key).decode().strip()
    text = f"a {token} b {base64.b64encode(pkcs8).decode()} c {key.hex()} d {wrapped}\n{unsigned} " + part(b"x" * 90)
    kinds = [k for k, _, _ in secret_spans.find(text)]
    assert sorted(k for k in kinds if k not in ("assign", "access", "hex")) == ["der", "der", "der", "jwt"]
    assert [text[a:b] for k, a, b in secret_spans.find(text) if k == "jwt"] == [token]


def test_words_joined_to_a_key_do_not_hide_it():
    import base64

    keys = [der(0x30, der(2, b"\0") + b"".join(der(2, bytes([n, 255, 254]) * 40) for _ in range(8))) for n in (7, 8, 9)]
    keys.append(der(0x30, der(2, b"\0") + der(0x30, der(6, b"\x2a\x03")) + der(4, b"\xfb\xff" * 33)))
    field = lambda b: len(b).to_bytes(4, "big") + b
    ssh = b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + (1).to_bytes(4, "big")
    keys += [ssh + field(b"p" * 51) + field(b"k" * n) for n in (80, 81, 82)]
    for key in keys:
        plain = base64.b64encode(key).decode()
        for code in (plain, plain.rstrip("="), base64.encodebytes(key).decode().strip().replace("\n", "\r\n")):
            for before, after in (("my key\n", "\nthanks"), ("secret_", ""), ("id-", "\n\nbye"), ("", "\nthanks a lot"),
                                  ("see/", " x"), ("a\nb\n", "\nc d"), ("x " * 9, " y"), (plain + "\n", "")):
                text = before + code + after
                found = [(a, b) for k, a, b in secret_spans.find(text) if k in ("der", "openssh")]
                assert (len(before), len(before) + len(code)) in found, (before, after)
                assert code not in secret_spans.redact(text, secret_spans.find(text))
    assert secret_spans.find("my key\n" + base64.b64encode(keys[0][:-1] + b"").decode()) == []
    assert secret_spans.keys_within("M" * 5000 + "\n" + "MIIB" * 900, 0, 8601) == []


def test_digits_joined_to_a_hex_key_do_not_hide_it():
    field = lambda b: len(b).to_bytes(4, "big") + b
    ssh = b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + (1).to_bytes(4, "big")
    keys = [
        der(0x30, der(2, b"\0") + b"".join(der(2, bytes([n, 255, 254]) * 40) for n in range(1, 9))),
        der(0x30, der(2, b"\0") + der(0x30, der(6, b"\x2a\x03")) + der(4, b"\xfb\xff" * 33)),
        der(0x30, der(2, b"\1") + der(4, b"\x30\x82" * 16)),
        ssh + field(b"p" * 51) + field(b"k" * 80),
    ]
    for key in keys:
        plain = key.hex()
        for code in (
            plain, plain.upper(), key.hex(":"), key.hex("\n", 30), "\r\n    ".join(key.hex(":", 1)[i : i + 45] for i in range(0, 3 * len(key), 45)),
        ):
            for before, after in (("", ""), ("a", ""), ("be", ""), ("", "ab"), ("3082", "0"), ("my key\n", "\nbye"), ("x ", " y")):
                text = before + code + after
                found = secret_spans.find(text)
                spans = [(a, b) for k, a, b in found if k in ("der", "openssh")]
                assert (len(before), len(before) + len(code.rstrip(":\r\n "))) in spans, (before, after, code[:40])
                assert plain not in secret_spans.redact(text, found).lower()
        assert not [k for k, _, _ in secret_spans.find(plain[:-2]) if k == "der"]


def test_words_joined_to_a_token_do_not_hide_it():
    import base64
    import json
    import time

    plain = lambda value: base64.urlsafe_b64encode(json.dumps(value).encode()).decode().rstrip("=")
    header = {"typ": "JWT", "alg": "HS256", "jwk": {"kty": "é"}}
    token = f"{plain(header)}.{plain({'sub': 1})}.{'s' * 43}"
    for before in ("", "auth_header.", "authtoken.", "Bearer_", "www.example-site.", "x", "xy", "xyz", "a.b.c.d."):
        for after in ("", " ", ".", "s", ".html"):
            text = f"see {before}{token}{after}"
            least = 4 + len(before)
            spans = [(a, b) for k, a, b in secret_spans.find(text) if k == "jwt"]
            if after == "s":
                assert spans == [(least, least + len(token) + 1)], (before, after)
            else:
                assert spans == [(least, least + len(token))], (before, after)
    two = [(a, b) for k, a, b in secret_spans.find(f"{token}.{token}") if k == "jwt"]
    assert two == [(0, len(token)), (len(token) + 1, 2 * len(token) + 1)]
    none = f"{plain({'alg': 'none'})}.{plain({'sub': 1})}.{'s' * 43}"
    assert not secret_spans.find(none)
    # Long runs take time in proportion, and deep nesting is no error.
    began = time.time()
    deep = base64.b64encode(b'{"a":' * 50_000).decode()
    for run in ("eyJ" + "a" * 1_000_000, "eyJ" * 300_000 + ".aa." + "b" * 20, "3082" * 250_000, "a." * 500_000 + "eyJ", "0\n" * 500_000):
        secret_spans.find(run)
    secret_spans.find(f"{deep}.aaaa.{'b' * 20}")
    assert time.time() - began < 20


def test_base_kinds_agree_with_a_plain_scan():
    import random

    draw = random.Random(7)
    bits = ["AKIA", "A", "0", "f", "ab12" * 9, "password", "TOKEN", "api_key", "apikey", '"', "'", " ", ":", "=", "x/+", "é", "\n", "Z9" * 8, "G"]
    for _ in range(3000):
        text = "".join(draw.choice(bits) for _ in range(draw.randrange(40)))
        expected, at = [], 0
        for kind, head, letters, least in (
            ("access", "AKIA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16), ("hex", "", "0123456789abcdef", 32),
        ):
            at = 0
            while at < len(text):
                end = at + len(head)
                while end < len(text) and text[end] in letters:
                    end += 1
                if text.startswith(head, at) and end > at + len(head):
                    expected += [(kind, at, end)] if end - at >= least else []
                    at = end
                else:
                    at += 1
        at = 0
        while at < len(text):
            name = next((n for n in ("password", "passwd", "secret", "token", "api_key", "apikey") if text[at:].lower().startswith(n)), None)
            end = at + len(name or "")
            if name:
                end += text[end : end + 1] in ('"', "'") and end < len(text)
                while text[end : end + 1] == " ":
                    end += 1
                if text[end : end + 1] in (":", "=") and end < len(text):
                    end += 1
                    # A value may itself begin with `=`, so the mark is the first one only.
                    while text[end : end + 1] == " ":
                        end += 1
                    end += text[end : end + 1] in ('"', "'") and end < len(text)
                    begin = end
                    while end < len(text) and (text[end].isascii() and text[end].isalnum() or text[end] in "+/_.=-"):
                        end += 1
                    if end > begin:
                        expected += [("assign", at, end)] if end - begin >= 8 else []
                        at = end
                        continue
            at += 1
        got = [s for s in secret_spans.find(text) if s[0] in ("assign", "access", "hex")]
        assert sorted(got) == sorted(expected), text


def test_base_kinds_and_redaction():
    text = 'é TOKEN = "abcdefgh" key api-key=1 apikey:12345678 AKIAABCDEFGHIJKL AKIAB ' + "f" * 31 + "g" + "a1" * 16
    found = secret_spans.find(text)
    assert [(k, text[a:b]) for k, a, b in found] == [
        ("assign", 'TOKEN = "abcdefgh'), ("assign", "apikey:12345678"), ("access", "AKIAABCDEFGHIJKL"), ("hex", "a1" * 16),
    ]
    clean = secret_spans.redact(text, found)
    assert not secret_spans.find(clean) and clean.count("[secret]") == 4 and clean.startswith('é [secret]" key')
    assert secret_spans.redact("abcdef", [("x", 0, 3), ("y", 1, 2), ("y", 2, 5)]) == "[secret]f"


def test_licenses_by_wording():
    scan = licenses.Scanner(licenses.TEMPLATES).scan
    for name, text in licenses.TEMPLATES.items():
        assert scan("Some words before. " + text + " And after.")[:2] == (name, "exact")
    assert scan("Licensed under CC BY-ND 4.0.")[0] is None
    assert scan(licenses.TEMPLATES["MIT-text"].replace("hereby granted", "granted"))[:2] == ("MIT-text", "reworded")
    assert scan("All software needs permission.")[0] is None
    assert licenses.blocks("a\nlicense x\ncopyright\n\nwarranty") == [(2, 21), (23, 31)]


def test_misspellings_share_vectors():
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(6))
    common = [word() for _ in range(300)]
    texts, labels = [], []
    for i in range(600):
        text = [r.choice(common) for _ in range(60)]
        if i % 5 == 0:
            text[r.randrange(60)] = r.choice(["wretchedfool", "stinkyvillain"])
        texts.append(" ".join(text))
        labels.append(int(i % 5 == 0))
    model = toxicity.train(texts, labels)
    probe = " ".join(common[:50])
    scores = toxicity.score(model, [probe, probe + " wretchedfool", probe + " wretchedfoool", "", probe + " stinkyvilain"])
    assert scores[0] < 0.5 < 0.7 < min(scores[1], scores[2], scores[4]) and scores[3] == 0
    assert toxicity.train(["a", "b"], [1, 1]) is None and toxicity.score(None, ["a"]).tolist() == [0]


def test_alike_texts_share_least_common_runs():
    r = random.Random(9)
    for _ in range(400):
        a = [r.randrange(30) for _ in range(r.randrange(1, 60))]
        b = list(a)
        for _ in range(r.randrange(1, 1 + max(1, len(a) // 5))):
            k = r.randrange(len(b) + 1)
            b[k : k + r.randrange(2)] = [r.randrange(30, 60)] * r.randrange(2)
        longest = max(len(a), len(b))
        if edit_distance(a, b, longest) <= int(longest * 0.2 + 1e-9):
            for run in (1, 2, 3):
                counts = [Counter(tuple(x[i : i + run]) for i in range(len(x) - run + 1)) for x in (a, b)]
                shared = (counts[0] & counts[1]).total()
                assert shared >= max(least_common(len(a), run, 0.8), least_common(len(b), run, 0.8))
