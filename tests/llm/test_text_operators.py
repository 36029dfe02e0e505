"""Operators on texts against brute force on small tables."""

from __future__ import annotations

import base64
import hashlib
import json
import math
import random
import re
import time
import zlib
from collections import Counter
from pathlib import Path

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from hostvigil.llm import (
    common,
    order_minhash,
    packing,
    pii,
    quality_lines,
    queries,
    secrets,
    substring_dedup,
    toxicity,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, words string, key int"


def made_texts(seed: int = 1, n: int = 60) -> list[str | None]:
    """Texts with shared passages, copies, near copies, odd blanks, empty and long ones."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [r.choice(vocabulary) for _ in range(70)]
    out: list[str | None] = [None, "", " \n\t ", "one", "\x0b a\x0cb  c\r\nd "]
    for i in range(n):
        words = [r.choice(vocabulary) for _ in range(r.randint(1, 200))]
        if i % 3 == 0:
            at = r.randint(0, len(words))
            words[at:at] = passage[r.randint(0, 10) : r.randint(40, 70)]
        out.append("".join(w + r.choice([" ", " ", "\n", "  "]) for w in words))
    base = [r.choice(vocabulary) for _ in range(300)]
    for _ in range(12):
        near = list(base)
        for _ in range(4):
            near[r.randrange(len(near))] = "changed"
        out.append(" ".join(near))
    out += [out[9], out[9], out[20], " ".join(vocabulary * 50), "x" * 30000]
    return out


def documents(spark, texts):
    """Texts as documents, with a null id, repeated rows and columns of clashing names."""
    rows = [(i, t, "en" if i % 2 else None, f"src{i % 3}", len(t or ""), "clash", 1)
            for i, t in enumerate(texts)]
    rows.append((None, "no id here", None, None, None, None, None))
    rows += rows[8:10]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


@pytest.fixture(scope="module")
def texts():
    return made_texts()


@pytest.fixture(scope="module")
def docs(spark, texts):
    return documents(spark, texts).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)


def test_operators_of_no_rows(spark, nothing):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(nothing, labels)
    for result in (
        quality_lines.judge_documents(nothing), secrets.scan_secrets(nothing),
        secrets.redact_secrets(nothing), substring_dedup.remove_repeats(nothing),
        order_minhash.near_duplicates(nothing),
        packing.pack_documents(nothing, queries.TOKENIZER),
        toxicity.score_documents(nothing, model), pii.find_personal_data(nothing),
    ):
        assert result.count() == 0


def removed_by_brute_force(texts, span):
    seen, out = set(), {}
    for i, text in enumerate(texts):
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for a in range(len(words) - span + 1):
            window = tuple(words[a : a + span])
            if window in seen:
                gone[a : a + span] = [True] * span
            seen.add(window)
        out[i] = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
    return out


@pytest.mark.parametrize("hot", [32768, 3])
def test_substring_dedup(docs, texts, hot):
    found = substring_dedup.remove_repeats(docs, hot=hot).collect()
    assert len(found) == len(texts) + 3
    expected = removed_by_brute_force(texts, 20)
    for r in found:
        assert r["text"] == (expected[r["doc_id"]] if r["doc_id"] is not None else "no id here")
        gone = sum(s["length"] for s in r["removed"])
        assert r["n_words"] - gone == len(WORD.findall(r["text"]))


def test_suffix_automaton():
    r = random.Random(4)
    for _ in range(200):
        automaton, put = substring_dedup.SuffixAutomaton(), []
        for _ in range(r.randint(1, 4)):
            one = [r.randint(0, 2) for _ in range(r.randint(3, 12))]
            put.append(one)
            automaton.add(one)
        asked = [r.randint(0, 2) for _ in range(12)]
        expected, ends = [], 0
        flat = []
        for one in put:
            flat += [(tuple(one[a : a + 3]), ends + a + 2) for a in range(len(one) - 2)]
            ends += len(one)
        for a in range(len(asked) - 2):
            places = [e for w, e in flat if w == tuple(asked[a : a + 3])]
            expected.append(min(places, default=-1))
        assert automaton.first_ends(asked, 3) == expected


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance(monkeypatch):
    r = random.Random(2)
    for few in (1, 24):
        monkeypatch.setattr(order_minhash, "FEW", few)
        for _ in range(300):
            a = [r.randint(0, 5) for _ in range(r.randint(0, 30))]
            b = [x for x in a if r.random() > 0.1] + [r.randint(0, 5) for _ in range(3)]
            most = r.randint(0, 15)
            got = order_minhash.edit_distance(np.array(a, int), np.array(b, int), most)
            assert got == min(edits(a, b), most + 1)


def shingles(text):
    words = text.lower().split()
    return set(zip(*(words[i:] for i in range(5)), strict=False)) or {tuple(words)}


def test_near_duplicates(docs, texts):
    found = order_minhash.near_duplicates(docs).collect()
    assert len(found) == len(texts) + 3
    of = {r["doc_id"]: r["class_id"] for r in found if r["doc_id"] is not None}
    worded = [i for i, t in enumerate(texts) if t and t.split()]
    for i in worded:
        for j in worded:
            a, b = shingles(texts[i]), shingles(texts[j])
            if i < j and len(a & b) >= 0.8 * len(a | b):
                assert of[i] == of[j]
    for i, c in of.items():
        assert c <= i
        if c != i:  # linked with some other member of its class
            x = texts[i].lower().split()
            others = [texts[j].lower().split() for j in of if of[j] == c and j != i]
            assert any(edits(x, y) <= 0.2 * max(len(x), len(y)) for y in others)
    assert all(of[i] == i for i in range(5))
    kept = {r["doc_id"] for r in found if r["kept"]}
    assert kept == set(of.values()) | {None}


def test_texts_that_share_an_id_are_classed_apart(spark):
    r = random.Random(9)
    one, two, three = ([f"{x}{r.random()}" for _ in range(60)] for x in "abc")
    near = lambda words, i: " ".join([*words[:30], f"n{i}", *words[31:]])
    rows = [(3, " ".join(one)), (5, near(one, 1)), (5, " ".join(two)), (9, near(two, 2)),
            (9, " ".join(three)), (9, near(three, 3)), (9, "  ".join(three)),
            (5, " ".join(two)), (9, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = order_minhash.near_duplicates(docs).collect()
    assert Counter((x["doc_id"], x["class_id"], x["kept"]) for x in found) == {
        (3, 3, True): 1, (5, 3, False): 1, (5, 5, True): 2, (9, 5, False): 1, (9, 9, True): 2,
        (9, 9, False): 2}
    left = [tuple(x) for x in corpus_pipeline.near_dedup_stage(spark, docs, "").collect()]
    assert len(left) == len(set(left)) == 4
    assert {rows[0], rows[2], rows[8]} < set(left)
    assert sum(x in left for x in rows[4:7]) == 1


def test_blocks_find_what_the_first_text_does_not(spark, monkeypatch):
    """A chain in which only neighbours are similar, in blocks of two."""
    monkeypatch.setattr(order_minhash, "BLOCK", 2)
    r = random.Random(8)
    words = [f"v{i}" for i in range(120)]
    texts = []
    for step in range(8):
        texts.append(" ".join(words))
        for _ in range(5):
            words[20 + r.randrange(100)] = f"n{step}{r.random()}"
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = order_minhash.near_duplicates(docs).collect()
    assert {r["class_id"] for r in found} == {0}


def test_links_of_blocks_do_not_depend_on_the_order_of_rows():
    r = random.Random(4)
    base = [f"w{i}" for i in range(30)]
    texts = []
    for _ in range(60):
        for _ in range(2):
            base[r.randrange(30)] = f"w{r.randrange(200)}"
        texts.append(" ".join(base))
    rows = order_minhash.pd.DataFrame({
        "text_id": range(60), "component": range(60), "part": "rest", "block": 0, "text": texts})
    found = order_minhash.compare_blocks(rows, 0.8)
    assert len(found) > 20
    for seed in range(5):
        other = order_minhash.compare_blocks(rows.sample(frac=1, random_state=seed), 0.8)
        assert found.equals(other)


@pytest.mark.parametrize(("share", "least"), [(0.1, 0.93), (0.15, 0.7), (0.2, 0.41)])
def test_texts_with_scattered_edits_share_sketches(share, least):
    r, n, pairs = np.random.default_rng(7), 300, 1500
    first = r.integers(-(2**62), 2**62, (pairs, n))
    second = first.copy()
    for row in second:
        row[r.choice(n, int(share * n), replace=False)] = r.integers(-(2**62), 2**62, int(share * n))
    one, two = (np.concatenate([order_minhash.sketches(x.ravel(), np.full(len(x), n))
                                for x in np.array_split(texts, 15)]) for texts in (first, second))
    assert (one == two).any(1).mean() >= least


def test_packing(docs, texts):
    pieces = packing.pack_documents(docs, queries.TOKENIZER, buffer_tokens=6000).collect()
    tokenizer = packing.WordIds(open(queries.TOKENIZER, encoding="utf-8").read(), by_word=False)
    expected = {i: [*tokenizer.encode([t or ""])[0], 1] for i, t in enumerate(texts)}
    expected[None] = [*tokenizer.encode(["no id here"])[0], 1]
    times = Counter({i: 1 for i in expected}) + Counter({8: 1, 9: 1})
    found: dict = {}
    sequences: dict = {}
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u4").tolist()
        assert len(ids) == p["length"] and p["doc_tokens"] == len(expected[p["doc_id"]])
        assert ids == expected[p["doc_id"]][p["start"] : p["start"] + p["length"]]
        found.setdefault(p["doc_id"], []).append((p["start"], p["length"]))
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for i, ids in expected.items():
        assert sum(n for _, n in found[i]) == times[i] * len(ids)
    for placed in sequences.values():
        at = 0
        for offset, n in sorted(placed):
            assert offset == at
            at += n
        assert at <= 2048 and (at == 2048 or at & (at - 1) == 0)


def test_word_ids_equal_the_tokenizer():
    source = open(queries.TOKENIZER, encoding="utf-8").read()
    by_word, whole = packing.WordIds(source, True), packing.WordIds(source, False)
    r = random.Random(6)
    parts = list("abcdeAZ.,.,  \n\t\x0b\x0c\x1c\x85  'sSt123!?#<|é́ßİΣKſñ中あ🙂‍") + ["<|endoftext|>", "'s ", "a. "]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 50))) for _ in range(3000)]
    assert by_word(texts)[0].tolist() == whole(texts)[0].tolist()
    assert by_word(texts)[1].tolist() == whole(texts)[1].tolist()


def test_words_are_encoded_jointly(monkeypatch):
    """Words with and without bars, which join them, and one text for many new words."""
    source = open(queries.TOKENIZER, encoding="utf-8").read()
    by_word, whole = packing.WordIds(source, True), packing.WordIds(source, False)
    r = random.Random(7)
    words = ["|", "||", "a|b", "|'s", "'s", "é|", *(
        "".join(r.choice("abé'.|Σ\u0301\u0338=9中") for _ in range(r.randint(1, 9)))
        for _ in range(3000))]
    asked = []
    encode = packing.WordIds.encode
    monkeypatch.setattr(packing.WordIds, "encode", lambda self, texts: (
        asked.append(len(texts)), encode(self, texts))[1])
    for texts in (words, [" ".join(words)]):
        assert by_word(texts)[0].tolist() == whole(texts)[0].tolist()
        assert by_word(texts)[1].tolist() == whole(texts)[1].tolist()
        by_word.forget()
    plain = [f"word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'u' * (i // 100)}"
             for i in range(1000)]
    asked.clear()
    assert by_word(plain)[0].tolist() == encode(whole, plain)[0].tolist()
    assert sum(asked) <= 1000 / packing.JOINED + 1


def test_costs_are_balanced():
    lengths = [random.Random(1).randint(1, 2048) for _ in range(400)]
    placed, left = packing.place(lengths, 2048, 1 / 2048)
    assert sum(n for _, _, n in left) == sum(lengths) % 2048
    cost = Counter()
    for _, _, n, s, _ in placed:
        cost[s] += n + n * n / 2048
    assert max(cost.values()) <= 2 * 2048


def test_quality_lines(spark, docs, texts):
    found = quality_lines.judge_documents(docs).collect()
    assert len(found) == len(texts) + 3
    for r in found:
        text = "no id here" if r["doc_id"] is None else texts[r["doc_id"]] or ""
        words = WORD.findall(text)
        triples = Counter(zip(words, words[1:], words[2:], strict=False))
        covered = {i + k for i in range(len(words) - 2) for k in range(3)
                   if triples[tuple(words[i : i + 3])] > 1}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        assert r["n_words"] == len(words) and r["word_chars"] == sum(map(len, words))
        assert r["n_symbols"] == sum(text.count(c) for c in "#*$%&|<>")
        assert r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["n_repeat_words"] == len(covered)
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        assert r["base_failed"] == failed and (not failed or not r["kept"])


def test_common_lines_deplete(spark):
    """A line of one host's documents goes there only; copies count as documents, repeated rows
    do not."""
    line = "Share this page 12 " + " ".join(f"menu{i}" for i in range(60))
    own = [" ".join(f"own{i}x{j}" for j in range(70)) for i in range(40)]
    rows = [(i, f"{line.replace('12', str(i))}\n" + (own[i] if i % 2 else "short"), "a")
            for i in range(40)]
    rows += [(100 + i, rows[0][1], "b") for i in range(40)]
    rows += [(200, rows[1][1], "c")] * 40 + [(300 + i, rows[1][1], "d") for i in range(20)]
    rows += [(None, rows[1][1], "e")] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality_lines.judge_documents(docs).collect()}
    assert all(kept[i] == bool(i % 2) for i in range(40))
    assert not any(kept[100 + i] for i in range(40))
    assert kept[200] and kept[None] and all(kept[300 + i] for i in range(20))


def der(tag: int, body: bytes) -> bytes:
    size = bytes([len(body)]) if len(body) < 128 else b"\x82" + len(body).to_bytes(2, "big")
    return bytes([tag]) + size + body


def test_secrets(spark, docs, texts):
    part = lambda x: base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")
    key = der(0x30, der(2, b"\x01") + der(2, b"\x11" * 200))
    ssh = b"".join(len(x).to_bytes(4, "big") + x for x in (b"ssh-rsa", b"\1\0\1", b"\x22" * 64))
    text = "\n".join([
        "é🙂 Password: 'abc123' passwd=abc", "AKIA" + "A" * 16 + " AKIA123", "f" * 24 + " abcdef",
        "jwt " + part({"alg": "HS256"}) + "." + part({"sub": 1}) + ".c2ln",
        "not " + part({"typ": "HS256"}) + "." + part({"sub": 1}) + ".c2ln",
        base64.b64encode(key).decode(), "A" * 40, "ssh-rsa " + base64.b64encode(ssh).decode(),
        "-----BEGIN RSA PRIVATE KEY-----\n" + base64.encodebytes(key).decode()
        + "-----END RSA PRIVATE KEY-----",
        "-----BEGIN RSA PRIVATE KEY-----\nbm90aGluZw==\n-----END RSA PRIVATE KEY-----",
        "token_api-key x APIKEY=" + "0" * 40,
    ])
    spans = secrets.find_secrets(text)
    assert Counter(k for k, *_ in spans) == {
        "assign": 2, "access": 1, "hex": 2, "jwt": 1, "der": 1, "ssh": 1, "pem": 1}
    assert text[spans[0][1] : spans[0][2]] == "Password: 'abc123"
    assert "abc123" not in secrets.redact(text) and "<pem>" in secrets.redact(text)
    found = secrets.scan_secrets(docs).collect()
    assert len(found) == len(texts) + 3
    assert Counter(secrets.redact_secrets(docs).collect()) == Counter(docs.collect())


def base_secrets(text):
    out = []
    for m in re.finditer(
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        text,
    ):
        if len(m[2]) >= 6:
            out.append(("assign", *m.span()))
    for kind, pattern, least in (("access", r"AKIA[A-Z0-9]+", 20), ("hex", r"[0-9a-f]+", 24)):
        out += [(kind, *m.span()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    order = ("assign", "access", "hex")
    return sorted(out, key=lambda s: (s[1], order.index(s[0])))


def test_base_secrets_equal_brute_force(spark):
    r = random.Random(4)
    bits = ["password", "Passwd", "SECRET", "token", "api_key", "apikey", '"', "'", ":", "=", "  ",
            "AKIA", "A1B2C3D4E5F6A7B8", "deadbeef", "0123456789abcdef", "é", "🙂", "\n", "x", "-", "."]
    texts = [None, ""] + ["".join(r.choices(bits, k=r.randint(1, 40))) for _ in range(400)]
    docs = spark.createDataFrame(
        [(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    found = {x["doc_id"]: x["spans"] for x in secrets.scan_secrets(docs).collect()}
    for i, text in enumerate(texts):
        base = [(s["kind"], s["start"], s["end"]) for s in found[i] if s["kind"] in secrets.BASE]
        assert base == base_secrets(text or "")


KEY = lambda: der(0x30, der(2, b"\x01") + der(0x30, der(2, b"\x11" * 60) + der(2, b"\x07" * 140)))


def token_part(text):
    return base64.urlsafe_b64encode(text.encode()).decode().rstrip("=")


def test_secrets_in_other_spellings():
    key = KEY()
    one_line = base64.b64encode(key).decode()
    wrapped = base64.encodebytes(key).decode().strip()
    pem = f"-----BEGIN EC PRIVATE KEY-----\n{wrapped}\n-----END EC PRIVATE KEY-----"
    signed = token_part('{ "alg": "ES256" }') + "." + token_part('{"sub": 1}') + ".c2ln"
    for text, kind, want in (
        (f"a {key.hex().upper()} b", "der", key.hex().upper()),
        (f"key:\n{wrapped}\nend", "der", wrapped),
        (f"key:\n{wrapped.replace(chr(10), chr(13) + chr(10) + '  ')}\nend", "der",
         wrapped.replace("\n", "\r\n  ")),
        ('{"k": "' + pem.replace("\n", "\\n") + '"}', "pem", pem.replace("\n", "\\n")),
        (f"see {signed} there", "jwt", signed),
        (f"cat /etc/keys/{one_line}", "der", one_line),
        (f"-----BEGIN A-----\n{pem}", "pem", pem),
    ):
        spans = [text[a:b] for k, a, b, _ in secrets.find_secrets(text) if k == kind]
        assert spans == [want], (kind, text[:80])
        assert want not in secrets.redact(text)


def test_what_has_no_structure_is_not_confirmed():
    digest = hashlib.sha256(b"x").hexdigest()
    key = base64.b64encode(KEY()).decode()
    for text in (
        digest, digest.upper(), f"token={digest}", f"password: {digest[:32]}",
        token_part('{"alg": "none"}') + "." + token_part('{"sub": 1}') + ".",
        token_part('{"alg": "none"}') + "." + token_part('{"sub": 1}') + ".c2ln",
        token_part('{"alg": "HS256"}') + "." + token_part('{"sub": 1}'),
        key[:-8], key[4:], "/" + key[:-4] + "AAAA" + key[-4:], "A" * 64,
        "-----BEGIN X-----\n" + key[:40] + "\n-----END X-----",
    ):
        assert all(
            evidence is None and kind in secrets.BASE
            for kind, _, _, evidence in secrets.find_secrets(text)), text[:60]


def test_der_of_any_depth_and_broken_der():
    data = b"\x02\x01\x05"
    for _ in range(3000):
        data = b"\x30\x84" + len(data).to_bytes(4, "big") + data
    assert secrets.is_der_key(data)
    assert not secrets.is_der_key(data[:-1]) and not secrets.is_der_key(data + b"\0")
    assert not secrets.der_fits(b"\x30\x03\x02\x02\x01")


@pytest.mark.parametrize("text", [
    "-----BEGIN A-----\n" * 100_000,
    "-----BEGIN A-----\nMII\n-----END A-----\n" * 30_000,
    "/MIIBAQ" * 100_000 + "=",
    ("ABCDEFGHIJKLMNOPQRSTUV\n" * 60_000) + "!",
    "eyA." * 200_000, "eyJhbGciOiJIUzI1NiJ9." * 50_000, "M" * 500_000,
], ids=["begins", "blocks", "paths", "lines", "dots", "headers", "run"])
def test_long_texts_are_scanned_in_time(text):
    began = time.perf_counter()
    secrets.find_secrets(text)
    assert time.perf_counter() - began < 5


def base_pii(text):
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    )
    out = []
    for kind, pattern in kinds:
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            if kind == "card":
                double = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
                if not 16 <= len(digits) <= 19 or sum(d // 10 + d % 10 for d in double) % 10:
                    continue
            out.append((kind, *m.span()))
    return out


def test_personal_data(spark):
    r = random.Random(3)
    parts = ["a.b@c.de", "x@y.z_d@e.f", "@", "1.2.3.4", "999.1.1.1", "1.2.3.4.5.6.7.8", " ", "é🙂",
             "4111 1111 1111 1111", "4111111111111112", "+1 (555) 555-1234", "+12", "++49 30 1234567",
             "\n", "tel ", "Dr. Smith", "0.0.0.0000000001", "1" * 50, "a@b", "-"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(1, 9))) for _ in range(300)]
    texts += [None, "", "1" * 20000, "a" * 50000, "a@b" + ".c" * 9000, "1-" * 9000 + "1",
              "+1" + "(" * 20000]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)],
                                 "doc_id long, text string, spans string, span string")
    for row in pii.find_personal_data(docs).collect():
        text = texts[row["doc_id"]] or ""
        spans = [(s["kind"], s["start"], s["end"]) for s in row["spans"]]
        assert [s for s in spans if s[0] in pii.BASE] == base_pii(text), text[:200]
        assert all(s["value"] == text[s["start"] : s["end"]] for s in row["spans"])


def test_reliabilities_follow_the_majority():
    patterns = [("a", (1, 1, 1, -1, 1, -1), 50), ("a", (0, 0, 0, -1, 1, -1), 50),
                ("a", (1, 0, 1, -1, 1, -1), 5)]
    truth = pii.reliabilities(patterns)
    assert truth["a", (1, 1, 1, -1, 1, -1)] > 0.9 > 0.1 > truth["a", (0, 0, 0, -1, 1, -1)]
    assert truth["a", (1, 0, 1, -1, 1, -1)] > 0.5


def plain_em(spans, rounds=40):
    """EM span by span: (kind, votes) of each; probabilities by (kind, votes)."""
    clean = lambda p: min(max(p, 1e-6), 1 - 1e-6)
    truth = [clean((sum(v for v in said if v >= 0) + 0.5) / (sum(v >= 0 for v in said) + 1))
             for _, said in spans]
    for _ in range(rounds):
        prior = {}
        for kind in {k for k, _ in spans}:
            of = [p for p, (k, _) in zip(truth, spans, strict=True) if k == kind]
            prior[kind] = (1 + sum(of)) / (2 + len(of))
        told = {}
        for j in range(len(pii.LABELERS)):
            for y in (0, 1):
                share = [p if y else 1 - p for p in truth]
                n = {v: 1 + sum(w for w, (_, said) in zip(share, spans, strict=True) if said[j] == v)
                     for v in (-1, 0, 1)}
                # A vote nobody cast has its count of one as well.
                told.update({(j, v, y): n[v] / sum(n.values()) for v in n})
        truth = []
        for kind, said in spans:
            odds = math.log(prior[kind] / (1 - prior[kind])) + sum(
                math.log(told[j, v, 1] / told[j, v, 0]) for j, v in enumerate(said) if v >= 0)
            truth.append(clean(1 / (1 + math.exp(-max(min(odds, 30), -30)))))
    return dict(zip(spans, truth, strict=True))


def test_candidates_of_one_kind_are_told_apart(spark):
    """Accounts and persons that labelers agree on are reported, others of their kind are not."""
    r = random.Random(8)
    number = lambda first, n: first + "".join(r.choice("123456789") for _ in range(n - len(first)))
    fails = lambda d: sum(x // 10 + x % 10 for x in (
        int(c) * (1 + i % 2) for i, c in enumerate(reversed(d)))) % 10

    def card(first="4"):
        while fails(d := number(first, 16)) or not d:
            pass
        return " ".join(d[i : i + 4] for i in range(0, 16, 4))

    def account(first="4"):
        while not fails(d := number(first, 16)):
            pass
        return " ".join(d[i : i + 4] for i in range(0, 16, 4))

    texts, good, bad = [], [], []
    for i in range(150):
        texts.append(f"my card is card {card()} and mail {i}@host.com, tel +49 30 12{i:05d}")
        good.append(f"karte {account()} bitte")
        bad.append(f"order {number('2', 11)}000 items")
    people = [f"name Dr. Smith said {i}" for i in range(40)]
    docs = spark.createDataFrame(
        list(enumerate(texts + good + bad + people)), "doc_id long, text string")
    kinds = [{s["kind"] for s in x["spans"]} for x in
             sorted(pii.find_personal_data(docs).collect(), key=lambda x: x["doc_id"])]
    assert all({"card", "email", "phone"} <= k for k in kinds[:150])
    assert all("account" in k for k in kinds[150:300])
    assert not any("account" in k for k in kinds[300:450])
    assert all("person" in k for k in kinds[450:])

    # The models behind it, against EM span by span.
    each = pii.found_spans(docs).select(F.explode("spans").alias("span"))
    said = each.select("span.kind", *(v.alias(k) for k, v in pii.votes(F.col("span")).items()))
    spans = [(x[0], tuple(x)[1:]) for x in said.collect()]
    truth = pii.reliabilities([(k, v, n) for (k, v), n in sorted(Counter(spans).items())])
    want = plain_em(spans)
    assert all(math.isclose(truth[key], p, abs_tol=1e-6) for key, p in want.items())
    accounts = {v: p for (k, v), p in truth.items() if k == "account"}
    assert min(accounts.values()) < 0.1 and max(accounts.values()) > 0.9


def test_texts_full_of_addresses(spark):
    """Time grows with the number of matches, not with its square."""
    def seconds(n):
        text = " ".join(f"a{i}@b.de" for i in range(n))
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        began = time.perf_counter()
        spans = pii.found_spans(docs).first()["spans"]
        assert [s["value"] for s in spans] == text.split()
        assert all(text[s["start"] : s["end"]] == s["value"] for s in spans)
        return time.perf_counter() - began

    seconds(10)
    assert seconds(32_000) < 12


def test_toxicity_learns(spark):
    r = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(900):
        text = [r.choice(words) for _ in range(r.randint(5, 80))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(2):
                text[r.randrange(len(text))] = r.choice(["Moron!", "idiot", "SCUM"])
        rows.append((i, " ".join(text), "en"))
        labels.append((i, int(toxic)))
    rows += [(900, None, None), (901, "", "xx"), (None, "idiot", "en"), (902, "w1 " * 50000, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    scored = {x["doc_id"]: x for x in toxicity.score_documents(docs, model).collect()}
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum((scored[i]["score"] >= 0.5) == bool(labels[i][1]) for i in held)
    assert right >= 0.95 * len(held) and len(scored) == len(rows)
    assert all(0 <= x["score"] <= 1 for x in scored.values())
    assert scored[900]["score"] == scored[901]["score"] < 0.5
    kept = {x["doc_id"] for x in toxicity.drop_toxic(docs, model).collect()}
    assert kept == {i for i, x in scored.items() if not x["toxic"]}
    # Neither the order of rows nor the batch that a text comes in changes anything.
    again = docs.orderBy(F.xxhash64("doc_id")).repartition(7)
    other = toxicity.train(again, spark.createDataFrame(labels[::-1], "doc_id long, toxic int"))
    assert other.thresholds == model.thresholds and np.array_equal(other.tables, model.tables)
    rescored = toxicity.score_documents(again, other).collect()
    assert {x["doc_id"]: x for x in rescored} == scored


def test_toxicity_learns_from_every_label(spark):
    n = 7000
    ids = spark.range(n).select("id").orderBy(F.xxhash64("id", F.lit(17)), "id")
    late = {x["id"] for x in ids.collect()[5000:]}  # far from the first by a hash of the id
    r = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        text, toxic = [f"w{r.randrange(200)}" for _ in range(6)], i % 5 == 0
        if toxic:
            text[r.randrange(6)] = "scoundrel" if i in late else "idiot"
        rows.append((i, " ".join(text), "en"))
        labels.append((i, int(toxic)))
    rows += [(n, "w1 w2 scoundrel w3 w4", "en"), (n + 1, "w1 w2 w5 w3 w4", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    found = {x["doc_id"]: x for x in toxicity.score_documents(docs, model).collect()}
    assert found[n]["toxic"] and found[n]["score"] >= 0.5 > found[n + 1]["score"]
    held = [i for i in range(n) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((found[i]["score"] >= 0.5) == bool(labels[i][1]) for i in held) > 0.98 * len(held)


def test_passages_cut_out_take_little_of_the_shared_folder(spark):
    r = random.Random(6)
    shared = " ".join(f"shared{r.randrange(10**6)}" for _ in range(400))
    texts = [f"{shared} own{i} {r.random()}" for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    folder = Path(common.shared_folder(spark).removeprefix("file:"))
    size = lambda: sum(f.stat().st_size for f in folder.rglob("*") if f.is_file())
    before = size()
    found = {x["doc_id"]: x for x in substring_dedup.remove_repeats(docs).collect()}
    assert found[0]["removed"] == [] and found[7]["text"].startswith("own7 ")
    assert size() - before < sum(map(len, texts)) / 2


def test_scores_do_not_depend_on_batches():
    rng = np.random.default_rng(3)
    lengths = rng.integers(0, 60, 500)
    hashes = rng.integers(-(2**63), 2**63 - 1, int(lengths.sum()))
    model = toxicity.fit(hashes, lengths, (rng.random(500) < 0.2).astype(float), steps=20)
    whole, upto = toxicity.scores(model, hashes, lengths), np.append(0, np.cumsum(lengths))
    for size in (1, 7, 64):
        parts = [toxicity.scores(model, hashes[upto[i] : upto[min(i + size, 500)]],
                                 lengths[i : i + size]) for i in range(0, 500, size)]
        assert np.array_equal(np.concatenate(parts), whole)


def test_digests_of_queries(spark, tmp_path, texts):
    """The registered digests are those of the contract."""
    documents(spark, texts).drop("words", "key").write.parquet(str(tmp_path / "documents.parquet"))
    expected = removed_by_brute_force(texts, 20)
    for r in queries.QUERIES["op3_substring_dedup"](spark, str(tmp_path)).collect():
        if r["doc_id"] is not None:
            kept = expected[r["doc_id"]]
            assert r["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
    for r in queries.QUERIES["op9_personal_data"](spark, str(tmp_path)).collect():
        text = "" if r["doc_id"] is None else texts[r["doc_id"]] or ""
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base_pii(text))
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
    assert public_tokenizers.path("word_bpe_49k.json") == queries.TOKENIZER
    ids = queries.QUERIES["op5_packing"](spark, str(tmp_path)).filter(F.col("doc_id") == 3).collect()
    assert [r["length"] for r in ids] == [2]
