"""Operators on vectors, urls and mixtures, components and the pipeline, against brute force."""

from __future__ import annotations

import math
import random
import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hostvigil.llm import mixing, subspace_join, url_filter
from hostvigil.llm.common import pinned
from hostvigil.llm.components import connected_components

FOLDER = "/root/testdata/sf0.001"


def components_of(n, pairs):
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_components(spark):
    r = random.Random(1)
    pairs = [(r.randrange(200), r.randrange(200)) for _ in range(120)]
    pairs += [(i, i + 1) for i in range(200, 260)]
    links = spark.createDataFrame(pairs, "a long, b long")
    found = {x["id"]: x["component"] for x in connected_components(links).collect()}
    label = components_of(261, pairs)
    assert found == {i: label[i] for i in {x for p in pairs if p[0] != p[1] for x in p}}


@pytest.mark.parametrize("chunk", [1500, 7])
def test_subspace_join(spark, monkeypatch, chunk):
    monkeypatch.setattr(subspace_join, "CHUNK", chunk)
    r = np.random.default_rng(2)
    base = r.normal(size=(12, 20))
    vectors = [b + r.normal(size=20) * s for b in base for s in (0, 0, 0.05, 0.2, 0.3, 0.35, 0.4)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]
    n = len(rows)
    rows += [(n, None), (n + 1, []), (n + 2, [0.0] * 20), (n + 3, [float("nan")] * 20),
             (n + 4, [None] + [1.0] * 19), (n + 5, [float("inf")] + [1.0] * 19), (n + 6, [1.0]),
             (None, rows[0][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn(
        "links", F.lit("clash"))
    found = subspace_join.similar_vectors(table, width=5, pivots=4).collect()
    assert len(found) == len(rows)
    of = {x["vec_id"]: x for x in found}
    exact = np.array([x[1] for x in rows[:n]])
    exact /= np.linalg.norm(exact, axis=1, keepdims=True)
    near = exact @ exact.T >= 0.9
    np.fill_diagonal(near, False)
    label = components_of(n, np.argwhere(near).tolist())
    for i in range(n):
        assert (of[i]["n_links"], of[i]["component_id"]) == (near[i].sum(), label[i])
        assert of[i]["kept"] == (label[i] == i)
    for i in range(n, n + 7):
        assert (of[i]["n_links"], of[i]["component_id"], of[i]["kept"]) == (0, i, True)
    assert of[None]["n_links"] == 0 and of[None]["component_id"] is None
    assert subspace_join.similar_vectors(table.limit(0)).count() == 0


def linked(vectors, cosine=0.9):
    """Pairs at or above the cosine, from exactly scaled vectors of one length each."""
    out = []
    for i, a in enumerate(vectors):
        for j, b in enumerate(vectors[:i]):
            if len(a) == len(b):
                x, y = (np.array(v) / np.abs(v).max() for v in (a, b))
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                    out.append((i, j))
    return out


def same_as_pairs(spark, vectors, **options):
    table = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(vectors)],
        "vec_id long, embedding array<double>")
    found = {x["vec_id"]: x for x in subspace_join.similar_vectors(table, **options).collect()}
    pairs = linked(vectors)
    label = components_of(len(vectors), pairs)
    for i in range(len(vectors)):
        n = sum(i in pair for pair in pairs)
        assert (found[i]["n_links"], found[i]["component_id"]) == (n, label[i]), i
    return pairs


@pytest.mark.parametrize("chunk", [1500, 5])
def test_vectors_of_any_length_and_magnitude(spark, monkeypatch, chunk):
    monkeypatch.setattr(subspace_join, "CHUNK", chunk)
    r = np.random.default_rng(6)
    vectors = []
    for n in (1, 2, 3, 7, 20, 33):
        for _ in range(4):
            base = r.normal(size=n)
            vectors += [base + r.normal(size=n) * s for s in (0, 0.1, 0.3)]
    # The same directions at magnitudes that single precision does not hold.
    vectors += [v * m for v, m in zip(vectors[:40], [1e300, 1e-300, 1e38, 5e-320] * 10, strict=True)]
    vectors += [-vectors[5], vectors[5] * -3.0]
    assert same_as_pairs(spark, vectors, width=5, pivots=4)


def test_pairs_at_the_edges_of_blocks(spark):
    """Pairs whose every block is a rounding error within or beyond its share of the budget."""
    r = np.random.default_rng(7)
    turn = subspace_join.rotation(20, 11)
    vectors = []
    for _ in range(60):
        x, d = np.zeros(20), np.zeros(20)
        off = r.choice([-1e-5, -1e-8, -2e-9, -1e-9, -1e-10, 0, 1e-10, 1e-9, 2e-9, 1e-8], 4)
        off -= max(0, off.sum()) / 4 + 1e-9
        for k in range(4):
            a, b = r.normal(size=5), r.normal(size=5)
            a /= np.linalg.norm(a) * 2
            b -= a * (a @ b) / (a @ a)
            share = 0.05 + off[k]
            x[5 * k : 5 * k + 5] = a
            alpha = -share / 2 / (a @ a)
            d[5 * k : 5 * k + 5] = alpha * a + b / np.linalg.norm(b) * np.sqrt(
                share - alpha * alpha * (a @ a))
        vectors += [turn @ x, turn @ (x + d)]
    pairs = same_as_pairs(spark, vectors, width=5, pivots=6)
    assert len(pairs) >= 55


def test_links_between_packs_and_partitions(spark, monkeypatch):
    """Groups of near and of equal vectors that lie in several packs of several partitions."""
    monkeypatch.setattr(subspace_join, "CHUNK", 20)
    monkeypatch.setattr(subspace_join, "PACK_BYTES", 2_000, raising=False)
    monkeypatch.setattr(subspace_join, "PARTITION_BYTES", 6_000, raising=False)
    r = np.random.default_rng(8)
    vectors = []
    for n in (24, 12):
        for size in (60, 20, 3, 2, 2, 1, 1, 1):
            base = r.normal(size=n)
            vectors += [base + r.normal(size=n) * s for s in r.choice([0, 0.1, 0.2, 0.3], size)]
        vectors += list(r.normal(size=(60, n)))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        # Not single precision, single precision, and both.
        assert same_as_pairs(spark, vectors)
        rounded = [v.astype(np.float32).astype(float) for v in vectors]
        assert same_as_pairs(spark, rounded, width=3)
        assert same_as_pairs(spark, rounded[::2] + vectors[1::2], pivots=5)
    finally:
        spark.conf.unset(key)


def test_disk_of_the_vector_join_is_a_few_times_its_input(spark, tmp_path):
    """Shuffles, spills and checkpoints together; 3,000 vectors as on disk."""
    r = np.random.default_rng(9)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(r.normal(size=(3000, 64)))]
    path = f"{tmp_path}/embeddings.parquet"
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(path)
    size = sum(p.stat().st_size for p in Path(path).glob("*.parquet"))
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()
    pinned(spark.range(1))  # the folder of checkpoints exists from now on
    folders = [str(f) for f in blocks.diskBlockManager().localDirs()]
    folders.append(spark.sparkContext.getCheckpointDir().removeprefix("file:"))

    def files():
        return {p: p.stat().st_size for f in folders for p in Path(f).rglob("*") if p.is_file()}

    before = files()
    assert subspace_join.similar_vectors(spark.read.parquet(path)).count() == 3000
    written = sum(n for p, n in files().items() if p not in before)
    assert size < written < 4 * size


def test_url_filter(spark):
    urls = [
        "http://www.Example.com/en/1", "https://example.com/en/2?x=/fr/", "http://a.net/fr/",
        "http://b.net/de/1", "http://shop.org", "http://x.com", "http://x.com?q", "nothing", None,
        "http://cheappills.org/buy", "http://cheap-pills.org/", "http://badnet/fr/1", "a://b://c/d",
        "http://" + "housegarden" * 500 + ".org/", "http://ÄB.com/#x",
    ] + [f"http://house{i}.org/garden" for i in range(20)]
    html = "<p>the house has cheap pills and a garden, spam from a farm</p>" * 3
    pages = spark.createDataFrame(
        [(i, u, html, "clash") for i, u in enumerate(urls)] + [(None, None, None, None)],
        "page_id long, url string, html string, tokens string")
    found = {r["page_id"]: r for r in url_filter.filter_urls(pages, rarest=1e-3).collect()}
    assert len(found) == len(urls) + 1
    for i, url in enumerate(urls):
        m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
        host = re.sub("[A-Z]", lambda x: x[0].lower(), m[1]) if m else ""
        path = m[2] if m else ""
        fits = [(len(h + p), v, h + p) for v, h, p in url_filter.RULES
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        r = found[i]
        assert (r["host"], r["path"]) == (host, path)
        assert r["rule"] == (max(fits)[2] if fits else None)
        if fits:
            assert r["verdict"] == max(fits)[1]
    assert found[9]["tokens"][:2] == ["h:cheap", "h:pills"]
    assert found[9]["verdict"] == found[10]["verdict"] == "block"
    assert found[4]["verdict"] == found[20]["verdict"] == found[None]["verdict"] == "allow"
    assert url_filter.filter_urls(pages.limit(0)).count() == 0


def test_url_filter_keeps_rare_words(spark):
    # Long pages that show no name: spam words and the words of names are rare or only in urls.
    html = "<p>" + "the house has a garden and a farm " * 60 + "</p>"
    urls = ["http://casino-win.org/x"] * 3 + ["http://bestcheappills.org/", "http://poker.org/"]
    urls += [f"http://house{i}.org/zimmer-{i}" for i in range(200)]
    urls += ["http://housegarden.org/"] * 40 + ["http://casinowin.org/"] * 40
    pages = spark.createDataFrame(
        [(i, u, html) for i, u in enumerate(urls)], "page_id long, url string, html string")
    found = {r["page_id"]: r for r in url_filter.filter_urls(pages, rarest=2e-4).collect()}
    assert {found[i]["verdict"] for i in range(5)} == {"block"}
    assert found[0]["tokens"][0] == "h:casino"
    assert found[3]["tokens"][1:3] == ["h:cheap", "h:pills"]
    assert found[5]["tokens"][-2:] == ["p:zimmer", "p:0"]
    assert found[205]["tokens"][:2] == ["h:house", "h:garden"]
    assert found[245]["tokens"][0] == "h:casino"
    assert found[5]["verdict"] == found[205]["verdict"] == "allow"
    counts = url_filter.word_counts(pages, url_filter.SPAM_WORDS, 0.5)
    # Of what a hundredth of all hosts share, their ending is the only label of letters.
    assert set(counts) == {*url_filter.SPAM_WORDS, "org"}


def plain_cost(counts, name, unknown, barred=None):
    """The cheapest split of a name by trying all of them."""
    total = sum(counts.values())
    price = lambda part: (
        -math.log(counts[part] / total) if part in counts and part != barred
        else unknown if len(part) == 1 else math.inf)
    best = math.inf
    for cuts in range(2 ** max(0, len(name) - 1)):
        parts, at = [], 0
        for k in range(1, len(name) + 1):
            if k == len(name) or cuts >> (k - 1) & 1:
                parts.append(name[at:k])
                at = k
        one_by_one = math.inf if len(name) > 1 else price(name)
        best = min(best, sum(map(price, parts)), one_by_one)
    return best


@pytest.mark.parametrize("seed", range(8))
def test_viterbi_equals_all_splits(seed):
    r = random.Random(seed)
    counts = {"".join(r.choices("abc", k=r.randint(1, 4))): r.randint(1, 50) for _ in range(12)}
    segmenter = url_filter.Segmenter(counts)
    for _ in range(40):
        name = "".join(r.choices("abcd", k=r.randint(1, 9)))
        want = plain_cost(counts, name, segmenter.unknown)
        assert math.isclose(segmenter.best(name)[-1][0], want)
        assert math.isclose(
            segmenter.cost_without(name), plain_cost(counts, name, segmenter.unknown, name))
    kept = url_filter.earned(counts, set())
    assert set(kept) == {
        w for w, n in counts.items()
        if n * (plain_cost(counts, w, segmenter.unknown, w) - segmenter.costs[w])
        > math.log(27) * len(w)}


def test_bayes_equals_counts_by_hand():
    rows = [{"token": "a", "block": 3, "allow": 1}, {"token": "b", "block": 0, "allow": 4}]
    model = url_filter.Bayes(rows, {True: 2, False: 6})
    a = math.log((3 + 1) / (3 + 3)) - math.log((1 + 1) / (5 + 3))
    b = math.log((0 + 1) / (3 + 3)) - math.log((4 + 1) / (5 + 3))
    assert math.isclose(model.score(["a", "b", "a", "new"]), math.log(3 / 7) + a + b)
    assert math.isclose(model.score([]), math.log(3 / 7))


@pytest.mark.parametrize("copies", [1, 40])
def test_names_are_segmented_whatever_pages_show(spark, copies):
    """A page's own name does not become a word, in small and larger corpora, and words that go
    with spam are learnt beyond the list."""
    r = random.Random(9)
    prose = "the house has a garden and some cheap pills a farm with bonus wins".split()
    clean = lambda: " ".join(r.choices(prose[:6] + prose[8:], k=60))
    rows = []
    for i in range(30 * copies):
        rows.append((f"http://farmhouse{i}.org/garden", f"<p>{clean()}</p>"))
    own = "cheappillscasino"
    rows += [(f"http://{own}.org/x", f"<p>{clean()} welcome to {own} and {own}.org http://{own}.org/")]
    spam = "casino poker casino viagra pills casino"
    rows += [(f"http://bonus{x}.org/{i}", f"<p>{spam}</p>") for i in range(3 * copies)
             for x in ("wins", "farm")]
    rows += [("http://bonuswins.org/new", "<p>the house</p>"), ("http://gardenfarm.org/", None)]
    pages = spark.createDataFrame(
        [(i, u, h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string")
    found = {x["page_id"]: x for x in url_filter.filter_urls(pages, rarest=1e-4).collect()}
    by_url = {u: found[i] for i, (u, _) in enumerate(rows)}
    assert by_url[f"http://{own}.org/x"]["tokens"][:3] == ["h:cheap", "h:pills", "h:casino"]
    assert by_url[f"http://{own}.org/x"]["verdict"] == "block"
    # No list word in the url, and nothing on the page: its name alone was learnt.
    assert by_url["http://bonuswins.org/new"]["verdict"] == "block"
    assert by_url["http://gardenfarm.org/"]["verdict"] == "allow"
    assert all(v["verdict"] == "allow" for u, v in by_url.items() if "farmhouse" in u)


def poured(budget, children):
    """Budgets of children {name: (weight, capacity)} by filling the short ones first."""
    out, left, rest = {}, budget, dict(children)
    while rest:
        weight = sum(w for w, _ in rest.values())
        short = {k: c for k, (w, c) in rest.items() if c * weight <= left * w}
        if not short:
            return out | {k: min(c, left * w // weight) for k, (w, c) in rest.items()}
        out |= short
        left -= sum(short.values())
        rest = {k: v for k, v in rest.items() if k not in short}
    return out


def test_leaf_budgets(spark):
    r = random.Random(5)
    leaves = [(d, lang, s, r.choice([0, 5, 50, 1000, 20000]), 3)
              for d in "ab" for lang in ("x", "y", "z") for s in "pqr"]
    weights = {"domain": {"a": 3}, "lang": {"x": 5, "y": 2}, "source": {"q": 4, "r": 2}}
    table = spark.createDataFrame(
        leaves, "domain string, lang string, source string, tokens long, docs long")
    for total in (0, 700, 30000, 10**9):
        found = {(x["domain"], x["lang"], x["source"]): x["budget"] for x in
                 mixing.leaf_budgets(table, weights, total, 1).collect()}
        cap = lambda *p: sum(t for d, la, s, t, _ in leaves if (d, la, s)[: len(p)] == p)
        of = lambda level, n: weights[level].get(n, 1)
        top = poured(min(total, cap()), {d: (of("domain", d), cap(d)) for d in "ab"})
        for d, b in top.items():
            langs = poured(b, {x: (of("lang", x), cap(d, x)) for x in "xyz"})
            for la, c in langs.items():
                for s, e in poured(c, {x: (of("source", x), cap(d, la, x)) for x in "pqr"}).items():
                    assert found[d, la, s] == e


@pytest.mark.parametrize("per_bucket", [4096, 3])
def test_mix_takes_prefixes(spark, monkeypatch, per_bucket):
    monkeypatch.setattr(mixing, "BUCKET_DOCS", per_bucket)
    r = random.Random(7)
    rows = [(i, "w " * r.randint(0, 30), r.choice(["en", "de", None]), r.choice(["s1", "s2"]), "c")
            for i in range(150)]
    rows += [(None, "w w", "en", "s1", "c"), (150, None, "de", "s2", "c"), rows[3]]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, budget string")
    found = mixing.mix(docs, F.lit("d"), {"source": {"s1": 9}}, share=0.9, epochs=3)
    found = found.withColumn("place", mixing.seeded(5, F.lit(0)))
    by_leaf: dict = {}
    for x in found.collect():
        by_leaf.setdefault((x["lang"], x["source"]), []).append(x)
    assert sum(map(len, by_leaf.values())) == len(rows)
    for members in by_leaf.values():
        tokens, budget = sum(x["n_tokens"] for x in members), members[0]["leaf_budget"]
        whole = budget // tokens
        assert sum(x["copies"] * x["n_tokens"] for x in members) <= budget
        assert {x["copies"] for x in members} <= {whole, whole + 1}
        least = min((x["n_tokens"] for x in members if x["copies"] == whole), default=0)
        longest = max(x["n_tokens"] for x in members)
        spent = sum(x["copies"] * x["n_tokens"] for x in members)
        assert budget - spent <= 2 * longest or not least
    assert mixing.mix(docs.limit(0), F.lit("d")).count() == 0
    whole = mixing.mixed_documents(docs, mixing.mix(docs, F.lit("d"), share=1.0, epochs=1))
    assert whole.columns == docs.columns and whole.count() == len(rows)


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no supplied tables")
def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    step = docs
    sizes = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        step = spark.createDataFrame(
            stage(spark, step, FOLDER).collect(), docs.schema)
        ids = [r["doc_id"] for r in step.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= set(before)
        sizes.append(len(ids))
    assert len(before) > sizes[0] > sizes[1] == sizes[2] > sizes[3] > 0.5 * len(before)
    pieces = corpus_pipeline.run(spark, FOLDER).collect()
    assert {p["doc_id"] for p in pieces} == set(ids)
    assert sum(p["length"] for p in pieces) == sum(
        {p["doc_id"]: p["doc_tokens"] for p in pieces}.values())
