"""License templates, token alignment and fill-in-the-middle against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hostvigil.llm import fill_middle, license_templates, licenses, pair_bitmaps, token_alignment
from hostvigil.llm.wavelet import CLASSES, WaveletMatrix

A_FILE = public_tokenizers.path("byte_bpe_50k.json")
B_FILE = public_tokenizers.path("piece_bpe_32k.model")
#: ``form``, ``n`` and the like clash with what the operators call their own columns.
SCHEMA = "doc_id long, text string, n long, form string, pair long, slot int, matches string"


def rows_of(texts):
    return [(None if i == 3 else i // 2, t, i, "x", 1, 2, "m") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    words = ["the", "The", "naïve", "日本語", "x y", "a b", "🙂🙂", "don't", "1234567", "\t",
             "\n", "\r\n", "...", "<|endoftext|>", "<s>", "<0x0A>", "ﬁ", "᠎", "café", "ñ", " "]
    plain = [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(60)]
    notice = ("Permission is hereby granted, free of charge, to any person obtaining a copy of "
              "this software and associated documentation files (the \"Software\"), to deal in")
    return [
        None, "", " ", "   ", "no id here", "a", "\n", "▁ a", "x ▁", "<P>", "a<S>b", "<M", "<", "S>",
        *plain, *plain[:5], "long " * 20_000, "z" * 30_000, "é" * 5_000, notice, "the the " * 500,
        "Licensed under the Apache License, Version 2.0. CC BY-NC cc by nc",
        "this this this work is licensed under the GNU Affero General Public License, version 3",
    ]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(rows_of(texts), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# Alignment


def aligned_by_hand(texts):
    """Every figure from whole texts and all pairs of byte ranges."""
    first, second = (
        cls(open(name, "rb").read())
        for cls, name in ((token_alignment.ByteLevel, A_FILE), (token_alignment.Pieces, B_FILE))
    )
    found, links_of = [], []
    for text in texts:
        raw = (" " + text).encode() if text else b""
        a = first.tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.model.encode(text) if text else []
        spelled = [b"".join(t.bytes[i] for i in ids) for t, ids in ((first, a), (second, b))]
        if spelled != [raw, raw]:
            a, b = [], []
        ends = [np.cumsum([len(t.bytes[i]) for i in ids]).tolist()
                for t, ids in ((first, a), (second, b))]
        links, groups = [], []
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                start_a, start_b = (e[k - 1] if k else 0 for e, k in zip(ends, (i, j)))
                if start_a < ends[1][j] and start_b < ends[0][i]:
                    links.append((x, y))
        p = q = 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            u, v = ends[0].index(end) + 1, ends[1].index(end) + 1
            groups.append(",".join(map(str, a[p:u])) + "|" + ",".join(map(str, b[q:v])))
            p, q = u, v
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        links_of.append(links)
        found.append([len(a), len(b), len(groups), len(links), digest])
    counts = Counter(link for links in links_of for link in links)
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    for row, links in zip(found, links_of, strict=True):
        row.append(sum(counts[link] == most[link[1]] for link in links))
        row.append(sum(counts[link] for link in links))
    return found, counts, links_of


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")


@pytest.fixture(scope="module")
def short_texts(texts):
    return [t[:400] if t else t for t in texts]


def test_alignment_equals_all_pairs(spark, short_texts):
    want, counts, links_of = aligned_by_hand(short_texts)
    docs = spark.createDataFrame(rows_of(short_texts), SCHEMA).repartition(3)
    got = token_alignment.align_documents(docs, A_FILE, B_FILE).collect()
    key = lambda rows: Counter(map(repr, rows))
    ids = [row[0] for row in rows_of(short_texts)]
    assert key([i, *row] for i, row in zip(ids, want, strict=True)) == key(
        [r["doc_id"], *(r[c] for c in COLUMNS)] for r in got)
    pairs = token_alignment.pair_counts(token_alignment.map_documents(docs, A_FILE, B_FILE))
    bits = pair_bitmaps.ID_BITS
    holders = Counter(link for links in links_of for link in set(links))
    assert {(r["pair"] >> bits, r["b"]): (r["n_documents"], r["n_links"]) for r in pairs.collect()
            } == {link: (holders[link], n) for link, n in counts.items()}


def test_pieces_align_like_whole_texts(texts):
    """Long texts too, ids only: whole texts give the ids of their pieces."""
    first, second = (
        cls(open(name, "rb").read())
        for cls, name in ((token_alignment.ByteLevel, A_FILE), (token_alignment.Pieces, B_FILE))
    )
    for text in filter(None, texts):
        raw = (" " + text).encode()
        cuts = token_alignment.piece_starts(np.frombuffer(raw, np.uint8), np.array([0]))
        ends = [*cuts[1:].tolist(), len(raw)]
        pieces = [raw[a:b].decode() for a, b in zip(cuts.tolist(), ends, strict=True)]
        assert sum(first.encode(pieces), []) == first.encode([" " + text])[0]
        assert sum(second.encode(pieces), []) == second.encode([" " + text])[0]


def test_alignment_of_chunks_that_fill(spark, short_texts, monkeypatch):
    """Many chunks of few numbers give what one chunk gives."""
    docs = spark.createDataFrame(rows_of(short_texts), SCHEMA).coalesce(1)
    want = Counter(token_alignment.align_documents(docs, A_FILE, B_FILE).collect())
    monkeypatch.setattr(token_alignment, "CHUNK_NUMBERS", 500)
    monkeypatch.setattr(token_alignment, "SLICE_BYTES", 300)
    monkeypatch.setattr(token_alignment, "REMEMBERED", 50)
    assert Counter(token_alignment.align_documents(docs, A_FILE, B_FILE).collect()) == want


def test_alignment_of_nothing(spark):
    assert token_alignment.align_documents(empty(spark), A_FILE, B_FILE).count() == 0


def test_bitmaps_of_common_pairs(spark):
    """Sets stored as bitmaps and as numbers count and return alike, planes as well."""
    rng = np.random.default_rng(3)
    pairs = rng.choice([5, 7 << 20, (7 << 20) + 1, 9], 90_000, p=[0.5, 0.3, 0.19, 0.01])
    slots = rng.integers(0, 9000, 90_000)
    chunk = pair_bitmaps.Chunk()
    for part in (slots < 3000, slots >= 3000):
        chunk.add(pairs[part], slots[part])
    want = Counter(zip(pairs.tolist(), slots.tolist(), strict=True))
    got = Counter()
    for found, documents, planes in chunk.sets(1000):
        for k, pair in enumerate(found.tolist()):
            for stored, weight in [(documents.slice(k, 1), 1), *(
                (planes.values.slice(planes.offsets[k].as_py() + bit, 1), 1 << bit)
                for bit in range(planes.offsets[k + 1].as_py() - planes.offsets[k].as_py())
            )]:
                members, (n,) = pair_bitmaps.members(stored)
                assert n == len(members)
                for slot in members.tolist():
                    got[pair, slot] += weight
            row = spark.createDataFrame(
                [(documents[k].as_py(), planes[k].as_py())], "d binary, p array<binary>"
            ).select(pair_bitmaps.cardinality(F.col("d")),
                     pair_bitmaps.total(F.col("d"), F.col("p"))).first()
            held = [n for (p, _), n in want.items() if p == pair]
            assert tuple(row) == (len(held), sum(held))
    assert got == want


# Templates


def regex_of(template):
    pattern = ""
    for part in re.split(r"(\{\{|\}\}|\[\[[^\]]*\]\])", template):
        if part in ("{{", "}}"):
            pattern += "(?:" if part == "{{" else ")?"
        elif part.startswith("[["):
            low, high = re.findall(r"\d+", part)[:2]
            pattern += f"(?:\\S+ ){{{low},{high}}}"
        else:
            pattern += "".join(f"{w} " for w in licenses.words_of(part))
    return pattern


def places_by_hand(template, words):
    """The longest accepted text from each word on, those within earlier ones left out."""
    pattern, found, reached = re.compile(regex_of(template)), [], -1
    for i in range(len(words)):
        ends = [j for j in range(i, len(words))
                if pattern.fullmatch("".join(f"{w} " for w in words[i : j + 1]))]
        if ends and ends[-1] > reached:
            reached = ends[-1]
            found.append((i, reached))
    return found


@pytest.mark.parametrize("seed", range(12))
def test_automaton_equals_regex(seed):
    rng = random.Random(seed)

    def region(depth):
        parts = [rng.choice("abc")]
        for _ in range(rng.randint(0, 4)):
            kind = rng.random()
            low = rng.randint(0, 2)
            parts.append(
                rng.choice("abc") if kind < 0.5 or not depth
                else "{{" + region(depth - 1) + "}}" if kind < 0.75
                else f"[[{low},{low + rng.randint(0, 3)}|a note]]"
            )
        return " ".join(parts)

    templates = {f"l{k}": region(2) for k in range(4)}
    automaton = licenses.TemplateAutomaton(templates)
    for _ in range(60):
        words = rng.choices("abcd", k=rng.randint(0, 14))
        got = automaton.find(words)
        for label, template in templates.items():
            assert [(i, j) for x, i, j in got if x == label] == places_by_hand(template, words)


def test_template_mistakes():
    for template in ("", "[[1,2]] a", "{{a}}", "a {{b", "a }} b"):
        with pytest.raises(ValueError):
            licenses.TemplateAutomaton({"x": template})


def test_licenses_of_documents(spark, docs, texts):
    found = licenses.scan_licenses(
        docs, license_templates.TEMPLATES, license_templates.PHRASES).collect()
    assert len(found) == len(texts)
    matched = {m["label"] for r in found for m in r["matches"]}
    assert matched == {"apache-2.0", "apache-2", "cc-by-nc", "gpl"}  # the MIT text is cut short
    by_words = {r["n_words"]: r for r in found if r["matches"]}
    apache = by_words[14]
    text = texts[-2]
    assert [(text[m["start"] : m["end"]], m["label"]) for m in apache["matches"]] == [
        ("Licensed under the Apache License, Version 2.0", "apache-2.0"),
        ("Apache License, Version 2", "apache-2"),
        ("CC BY-NC", "cc-by-nc"), ("cc by nc", "cc-by-nc"),
    ]
    assert apache["score"] == 1.0
    assert all(r["score"] == 0 for r in found if not r["matches"])
    assert licenses.scan_licenses(empty(spark), {"x": "a"}, {}).count() == 0


def test_mandatory_wording_is_exact():
    automaton = licenses.TemplateAutomaton(license_templates.TEMPLATES)
    whole = re.sub(r"\{\{|\}\}|\[\[[^\]]*\]\]", "", license_templates.TEMPLATES["mit"])
    filled = license_templates.TEMPLATES["mit"].replace('[[0,4|"Software"]]', "Work of Art")
    for text, want in ((whole, True), (re.sub(r"\{\{.*?\}\}", "", filled, flags=re.S), True),
                       (whole.replace("copies", "copy", 1), False),
                       (filled.replace("Work of Art", "one two three four five"), False)):
        assert any(x == "mit" for x, *_ in automaton.find(licenses.words_of(text))) == want


# Fill-in-the-middle


def units_of(text, unit):
    if unit == "chars":
        return list(text)
    return re.findall(r"[^ \t\n]*[ \t\n]|[^ \t\n]+$" if unit == "words" else r"[^\n]*\n|[^\n]+$", text)


@pytest.mark.parametrize("unit", ["chars", "words", "lines"])
def test_fill_middle_equals_plain_version(spark, docs, texts, unit):
    found = fill_middle.fill_middle(docs, unit=unit).select(
        "*", fill_middle.restore(F.col("output"), F.col("form")).alias("restored")).collect()
    want = Counter()
    for doc_id, text, *_ in rows_of(texts):
        text = text or ""
        digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
        units = units_of(text, unit)
        p, q = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
        a, b, c = ("".join(x) for x in (units[:p], units[p:q], units[q:]))
        if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
            row = (doc_id, len(units), "plain", None, None, text, text)
        else:
            spm = h4 % 100 < 20
            out = f"<S>{c}<P>{a}<M>{b}" if spm else f"<P>{a}<S>{c}<M>{b}"
            row = (doc_id, len(units), "spm" if spm else "psm", p, q - p, out, text)
        want[row] += 1
    assert Counter(map(tuple, found)) == want


def test_restore_across_seams(spark):
    """Ends and beginnings of texts that look like pieces of markers."""
    bits = ["", "<", "<S", "S>", ">", "<P", "P>", "<M", "M>", "x"]
    rows = [(form, a, b, c) for form in ("psm", "spm") for a in bits for b in bits for c in bits
            if not re.search("<[PSM]>", a + b + c)]
    made = [(f, f"<S>{c}<P>{a}<M>{b}" if f == "spm" else f"<P>{a}<S>{c}<M>{b}", a + b + c)
            for f, a, b, c in rows]
    df = spark.createDataFrame(made, "form string, output string, want string")
    back = fill_middle.restore(F.col("output"), F.col("form"))
    assert df.filter(~back.eqNullSafe(F.col("want"))).count() == 0


def test_fill_middle_of_nothing(spark):
    assert fill_middle.fill_middle(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        fill_middle.fill_middle(empty(spark), unit="bytes")


def test_wavelet_ranks_equal_counts():
    rng = np.random.default_rng(5)
    for size in (0, 1, 63, 64, 65, 1000):
        data = rng.integers(0, 256, size).astype(np.uint8)
        matrix, classes, at = WaveletMatrix(data), CLASSES[data], np.arange(size + 1)
        for kind in range(8):
            want = np.concatenate([[0], np.cumsum(classes == kind)])
            assert (matrix.rank(kind, at) == want).all()
        kinds = frozenset({1, 4})
        counts = np.concatenate([[0], np.cumsum(np.isin(classes, list(kinds)))])
        assert (matrix.count(kinds, at) == counts).all()
        targets = np.arange(int(counts[-1]) + 1)
        found = matrix.locate(kinds, targets, np.zeros_like(targets), np.full_like(targets, size))
        assert (found == np.searchsorted(counts, targets)).all()


def test_schemas_do_not_depend_on_rows(spark, docs):
    for made in (fill_middle.fill_middle, lambda d: licenses.scan_licenses(d, {"x": "a"}, {}),
                 lambda d: token_alignment.align_documents(d, A_FILE, B_FILE)):
        assert isinstance(made(docs).schema, T.StructType)
        assert made(docs).schema == made(empty(spark)).schema
