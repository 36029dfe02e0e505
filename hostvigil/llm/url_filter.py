"""URL verdicts: rules first, else a naive Bayes model over the words that hosts and paths hide.

Concatenated names are split into words by Viterbi under unigram frequencies counted from the
visible words of all pages, from names in hosts and paths that are written apart (``a-b``) and from
labels that many hosts share (``www``). What pages show of urls and of their own host's name is not counted, or every name would be a word. A
counted word that other words spell out must earn its place: it stays only if an entry of its own
shortens the description of all its occurrences by more than its letters cost.

The words of hosts and paths are then scored by multinomial naive Bayes; a url counts each of its
words once, however long it is. It learns from three teachers. A page is blocked if its visible text
holds words of a short list of spam words far more often than all pages do, or its url holds one. A
rule's verdict counts for a host that it judges in all of its urls, without the place that the rule
names, since the model is for other places. All other pages are allowed. So words that only go with
spam come to count against a url as well. Words that a fifth of all hosts have in their urls
(``www``, ``html``) tell places apart, not names, and are not scored.

Words rarer than ``rarest`` among all words are not in the unigram table, so it has at most
1/rarest entries however many pages there are. Spam words are added, at that frequency if they are
rarer, so that names are read as them however large the corpus is. What Viterbi cannot read becomes
a token for its length, digits become one token, so the naive Bayes table is bounded as well. Both
are sent to every task; counting combines before the shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostvigil.llm.common import pinned

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What an entry of the unigram table costs per letter, in the unit of the words' costs.
LETTER_COST = math.log(27)
TAGS = re.compile(r"<[^<>]*>")
#: Host names and what follows them in a url; begun only where no name goes on.
NAMES = re.compile(r"(?<![a-z0-9-])[a-z0-9-]+(?:\.[a-z0-9-]+)+(?:/[^\s<>]*)?")
RUNS = re.compile("[a-z]+")
#: Parts that the pages of a host are dealt into.
SALTS = 64
#: Different words that a task adds up before it sends them.
AT_ONCE = 300_000
#: (verdict, host, path): a rule holds for its host and subdomains and for paths that begin so.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Words of hosts and paths that mark spam.
SPAM_WORDS = (
    "bets", "betting", "casino", "cheap", "loans", "pills", "poker", "porn", "spam", "viagra", "xxx"
)


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(found, UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as struct(verdict, rule); null if none does."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, on, begins in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == on) | host.endswith("." + on)) & path.startswith(begins)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"),
                                    F.lit(on + begins).alias("rule"))).otherwise(out)
    return out


def shown_words(host: str, html: str | None) -> list[str]:
    """The words that a page shows, but for urls, host names and the labels of its own host."""
    text = NAMES.sub(" ", TAGS.sub(" ", (html or "").lower()))
    own = set(RUNS.findall(host))
    return [word for word in RUNS.findall(text) if word not in own]


def counted_words(pages: DataFrame) -> DataFrame:
    """(word, n, shown): how often words of pages (host, path, html) occur, and how often shown.

    A task adds up what it reads before it sends anything, as far as its memory is meant to go.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shown, named = Counter(), Counter()

        def flush() -> pa.RecordBatch:
            found = [*shown, *(w for w in named if w not in shown)]
            out = pa.RecordBatch.from_arrays(
                [pa.array(found, pa.string()),
                 pa.array([shown[w] + named[w] for w in found], pa.int64()),
                 pa.array([shown[w] for w in found], pa.int64())],
                ["word", "n", "shown"])
            shown.clear()
            named.clear()
            return out

        for batch in batches:
            for host, path, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                shown.update(shown_words(host, html))
                for name in re.split("[./]", f"{host}/{path.lower()}"):
                    if re.search("[-_+]", name):
                        named.update(RUNS.findall(name))
                if len(shown) + len(named) > AT_ONCE:
                    yield flush()
        yield flush()

    counted = pages.select("host", "path", "html").mapInArrow(
        count, "word string, n long, shown long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"), F.sum("shown").alias("shown"))


def word_counts(pages: DataFrame, spam_words: Sequence[str], rarest: float) -> dict[str, int]:
    """How often words occur in what pages (url, html) show and in names written apart.

    For words not rarer than ``rarest``, and for spam words, which count as that at least. A word
    found in names only is left out if shown words or spam words read it. Labels that a hundredth
    of all hosts have, which can be a hundred times the labels of a host at most, are words.
    """
    url = F.col("url")
    named = pages.select(host_of(url).alias("host"), path_of(url).alias("path"), "html")
    hosts = named.select("host").distinct()
    labels = hosts.select(F.explode(F.array_distinct(F.split("host", "[.]"))).alias("label"))
    shared = labels.groupBy("label").agg(F.count(F.lit(1)).alias("n")).filter(
        F.col("label").rlike("^[a-z]+$") & (F.col("n") * 100 >= F.lit(hosts.count())))
    counted = pinned(counted_words(named))
    floor = rarest * (counted.agg(F.sum("n")).first()[0] or 0)
    rows = counted.filter((F.col("n") >= floor) | F.col("word").isin(*spam_words)).collect()
    spam = set(spam_words)
    counts = dict.fromkeys(spam_words, max(1, math.ceil(floor)))
    for r in rows:
        if r["shown"] >= floor or r["word"] in spam:
            counts[r["word"]] = max(r["n"], counts.get(r["word"], 0))
    segmenter = Segmenter(counts)
    for r in rows:
        if r["word"] not in counts:
            parts = segmenter.split(r["word"])
            if any(p[0] == "?" for p in parts) and spam.isdisjoint(parts):
                counts[r["word"]] = r["n"]
    for r in shared.collect():
        counts[r["label"]] = max(r["n"], counts.get(r["label"], 0))
    return earned(counts, spam)


def earned(counts: dict[str, int], always: set[str]) -> dict[str, int]:
    """The words whose own entries pay: ``n`` times what an entry saves over the best reading by
    other words must exceed what its letters cost. Those of ``always`` stay."""
    segmenter = Segmenter(counts)
    kept = {}
    for word, n in counts.items():
        own = segmenter.costs[word]
        if word in always or n * (segmenter.cost_without(word) - own) > LETTER_COST * len(word):
            kept[word] = n
    return kept


class Segmenter:
    """Splits names into words by Viterbi."""

    def __init__(self, counts: dict[str, int]):
        total = max(1, sum(counts.values()))
        self.costs = {w: -math.log(n / total) for w, n in counts.items()}
        #: Of a letter that belongs to no known word; dearer than any word.
        self.unknown = math.log(total) + math.log(10)
        self.lengths = sorted({len(w) for w in self.costs})
        self.seen: dict[str, list[str]] = {}

    def best(self, name: str, barred: str | None = None) -> list[tuple[float, int, bool]]:
        """Per end the cost of the cheapest split up to there, its last part's begin, and whether
        that part is a word. ``barred`` is taken for no word."""
        best: list[tuple[float, int, bool]] = [(0.0, 0, True)]
        for end in range(1, len(name) + 1):
            options = [(best[end - 1][0] + self.unknown, end - 1, False)]
            for length in self.lengths:
                if length > end:
                    break
                word = name[end - length : end]
                cost = self.costs.get(word)
                if cost is not None and word != barred:
                    options.append((best[end - length][0] + cost, end - length, True))
            best.append(min(options))
        return best

    def cost_without(self, word: str) -> float:
        """What a word costs if other words have to spell it."""
        return self.best(word, barred=word)[-1][0]

    def split(self, name: str) -> list[str]:
        """The cheapest split of a run of letters; unread letters in a row become ``?n``."""
        best = self.best(name)
        parts, end, unread = [], len(name), 0
        while end:
            _, begin, known = best[end]
            if known:
                if unread:
                    parts.append(f"?{min(unread, 9)}")
                    unread = 0
                parts.append(name[begin:end])
            else:
                unread += 1
            end = begin
        if unread:
            parts.append(f"?{min(unread, 9)}")
        return parts[::-1]

    def tokens(self, host: str, path: str) -> list[str]:
        """Words of a host, then of a path, marked apart; digits are ``0``."""
        out = []
        for mark, text in (("h:", host), ("p:", path.lower())):
            for run in re.findall(r"[a-z]+|[0-9]+|[^\x00-\x7f]+", text):
                if run[0].isdigit():
                    out.append(mark + "0")
                elif run[0] > "\x7f":
                    out.append(mark + "?9")
                else:
                    if run not in self.seen:
                        if len(self.seen) > 200_000:
                            self.seen.clear()
                        self.seen[run] = self.split(run)
                    out += [mark + w for w in self.seen[run]]
        return out


def tokenised(parsed: DataFrame, counts: dict[str, int]) -> DataFrame:
    """The columns of ``parsed`` and the tokens of its second and third, host and path."""
    sent = parsed.sparkSession.sparkContext.broadcast(counts)  # 1/rarest entries and spam words

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = Segmenter(sent.value)
        for batch in batches:
            found = [segmenter.tokens(h, p) for h, p in
                     zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.list_(pa.string()))],
                [*batch.schema.names, "tokens"],
            )

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in parsed.schema)
    return parsed.mapInArrow(tokenise, f"{columns}, tokens array<string>")


class Bayes:
    """Multinomial naive Bayes for block against allow.

    Tokens of ``place`` are counted among all, but say nothing.
    """

    def __init__(self, rows: list, docs: dict[bool, int], place: frozenset[str] = frozenset()):
        block = {r["token"]: r["block"] for r in rows}
        allow = {r["token"]: r["allow"] for r in rows}
        of_block, of_allow = sum(block.values()), sum(allow.values())
        size = len(block) + 1
        self.odds = {
            t: math.log((block[t] + 1) / (of_block + size))
            - math.log((allow[t] + 1) / (of_allow + size))
            for t in sorted(block.keys() - place)
        }
        self.prior = math.log((docs.get(True, 0) + 1) / (docs.get(False, 0) + 1))

    def score(self, tokens: list[str]) -> float:
        """The log odds of block; tokens seen with neither label say nothing."""
        return self.prior + sum(self.odds.get(t, 0.0) for t in sorted(set(tokens)))


def beside_rule(host: Column, path: Column, rule: Column) -> tuple[Column, Column]:
    """What a url holds besides the place of the rule that fits it; all of it without a rule."""
    on = F.substring_index(rule, "/", 1)
    begins = F.substring(rule, F.length(on) + 1, F.length(rule))
    rest = F.substring(host, F.lit(1), F.length(host) - F.length(on))
    left = F.substring(path, F.length(begins) + 1, F.length(path))
    return F.coalesce(rest, host), F.coalesce(left, path)


def teachable(pages: DataFrame, counts: dict[str, int], spam_words: Sequence[str]) -> DataFrame:
    """Per page its host, the words that its url holds besides a rule's place, how many words and
    spam words it shows, and the rules' verdict if they judge all urls of the host alike."""
    sent = pages.sparkSession.sparkContext.broadcast((counts, frozenset(spam_words)))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, spam = sent.value
        segmenter = Segmenter(table)
        for batch in batches:
            host, rest, left, _, html = (c.to_pylist() for c in batch.columns)
            words = [shown_words(h, x) for h, x in zip(host, html, strict=True)]
            tokens = [sorted(set(segmenter.tokens(a, b)))
                      for a, b in zip(rest, left, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(3), pa.array(tokens, pa.list_(pa.string())),
                 pa.array(map(len, words), pa.int64()),
                 pa.array([sum(w in spam for w in x) for x in words], pa.int64())],
                ["host", "verdict", "tokens", "n_words", "n_spam"])

    measured = pinned(pages.select("host", "rest", "left", "verdict", "html").mapInArrow(
        measure, "host string, verdict string, tokens array<string>, n_words long, n_spam long"))
    alike = measured.groupBy("host").agg(
        F.min("verdict").alias("least"), F.max("verdict").alias("most"),
        F.count_if(F.col("verdict").isNull()).alias("free"),
    ).filter((F.col("least") == F.col("most")) & (F.col("free") == 0))
    # A host's pages are dealt to several tasks; its verdict goes to each of them.
    judged = alike.select(
        F.col("host").alias("of"), F.col("least").alias("taught"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("of_salt"))
    salted = measured.withColumn(
        "salt", F.pmod(F.xxhash64("tokens", "n_words", "n_spam"), F.lit(SALTS)))
    same = (F.col("host") == F.col("of")) & (F.col("salt") == F.col("of_salt"))
    return salted.join(judged, same, "left").drop("of", "of_salt", "salt")


def learnt(
    texts: DataFrame, counts: dict[str, int], spam_words: Sequence[str], excess: float,
    common: float,
) -> Bayes:
    """The model. What is collected is bounded as the unigram table is.

    How likely either label is before any word is taken from urls without a rule.
    """
    pages = teachable(texts, counts, spam_words)
    totals = pages.agg(F.sum("n_spam").alias("s"), F.sum("n_words").alias("w"),
                       F.count_distinct("host").alias("hosts"))
    marked = F.array(*(F.lit(mark + word) for word in spam_words for mark in ("h:", "p:")))
    shown = F.col("n_spam") * F.col("w") > excess * F.col("s") * F.col("n_words")
    label = F.when(F.col("taught") == "block", True).when(F.col("taught") == "allow", False)
    labelled = pages.crossJoin(F.broadcast(totals)).select(  # one row of sums
        "host", "hosts", "tokens",
        F.coalesce(label, shown | F.arrays_overlap("tokens", marked), F.lit(False)).alias("spam"),
        F.col("verdict").isNull().alias("open"),
    )
    rows = (
        labelled.select("spam", "host", "hosts", F.explode("tokens").alias("token"))
        .groupBy("token", "host", "hosts")
        .agg(F.count_if("spam").alias("block"), F.count_if(~F.col("spam")).alias("allow"))
        .groupBy("token", "hosts")
        .agg(F.sum("block").alias("block"), F.sum("allow").alias("allow"),
             (F.count(F.lit(1)) > common * F.col("hosts")).alias("place"))
        .collect()
    )
    per_label = {
        r["spam"]: r["count"] for r in labelled.filter("open").groupBy("spam").count().collect()}
    return Bayes(rows, per_label, frozenset(r["token"] for r in rows if r["place"]))


def filter_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    spam_words: Sequence[str] = SPAM_WORDS,
    rarest: float = 1e-5,
    excess: float = 5.0,
    common: float = 0.2,
) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, tokens, block_odds.

    ``excess`` is how many times more often than all pages a page must show spam words to be
    blocked for it, ``common`` the share of hosts beyond which words are not scored. A url without
    ``://`` or a null one has an empty host and path and no tokens; like any url that no rule fits,
    it gets the model's verdict: block if the log odds are above 0. A null html shows nothing. Null ids stay null, rows that repeat are judged each, no rows
    give no rows, and other columns than page_id, url and html are not looked at.
    """
    url = F.col("url").cast("string")
    host, path = host_of(url), path_of(url)
    found = rule_of(F.col("host"), F.col("path"), rules)
    parsed = (
        pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"),
                     path.alias("path"), url.alias("url"),
                     F.col("html").cast("string").alias("html"))
        .withColumn("found", found)
        .select("page_id", "host", "path", "found.verdict", "found.rule", "url", "html")
    )
    counts = word_counts(parsed.select("url", "html"), spam_words, rarest)
    rest, left = beside_rule(F.col("host"), F.col("path"), F.col("rule"))
    model = learnt(
        parsed.select("host", rest.alias("rest"), left.alias("left"), "verdict", "html"),
        counts, spam_words, excess, common,
    )
    judged = tokenised(parsed.drop("url", "html"), counts)
    sent = pages.sparkSession.sparkContext.broadcast(vars(model))

    @F.pandas_udf("double")
    def block_odds(tokens):
        model = Bayes.__new__(Bayes)
        model.__dict__.update(sent.value)
        return tokens.map(model.score).astype("float64")

    verdict = F.col("verdict")
    return judged.withColumn("block_odds", block_odds("tokens")).select(
        "page_id", "host", "path", "rule",
        F.coalesce(verdict, F.when(F.col("block_odds") > 0, "block").otherwise("allow"))
        .alias("verdict"),
        "tokens", "block_odds",
    )
