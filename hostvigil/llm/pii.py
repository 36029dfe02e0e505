"""Personal data by weak supervision, in DataFrame functions only.

Four kinds are reported on their pattern (``email``, ``ip``, ``card``, ``phone``). Three more are
candidates: ``account`` (digits in the shape of a card that fail its check), ``email_masked``
(``name (at) host``) and ``person`` (a title and a capitalised word). Six labelers vote yes, no or
nothing on every span, none of them by its kind alone: how digits are grouped, gazetteers, words
before, words after, digit shape and edges. Expectation maximisation finds how reliable each is, from the number of spans with each combination of votes.
The resulting probabilities label the spans on which the final classifier, naive Bayes over the
span's features, is trained. A candidate is reported if the classifier finds it likelier than not.

Patterns run once over each text; what they find, a small table, is checkpointed. Vote
combinations and feature counts are bounded by construction, so both models are small whatever the
input; nothing else reaches the driver. Positions come from the lengths of the pieces between
matches. Patterns use possessive quantifiers and edges, which change no match but keep a text
without blanks from costing its length squared.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostvigil.llm.common import pinned

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "account", "email_masked", "person")
#: An address can begin where the one before it ended (\G), else only at the edge of a run.
EMAIL = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)++"
)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
DIGITS = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
MASKED = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[(\[]at[)\]] ?[A-Za-z0-9.-]++"
PERSON = (
    r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Señor|Señora|Sr|Sra|Monsieur|Madame|Mme)\b\.? "
    r"\p{Lu}\p{Ll}++"
)
#: Words that speak for personal data before a span, and words that speak against it.
CUES = "mail|contact|tel|phone|call|fon|ruf|card|kart|tarjeta|carte|ip|host|name|from|von|de"
COUNTER_CUES = "version|order|invoice|isbn|page|seite|total|sum|id|no|nr|build|rev"
TOP_LEVELS = "com|org|net|edu|gov|info|io|de|fr|es|uk|eu"
#: Words after a span that make a number an amount or a name someone spoken of.
AMOUNTS = "eur|euro|euros|usd|kg|km|mm|cm|mb|gb|ms|bytes|items|pages|percent|st[uü]ck"
SPOKEN = "said|wrote|called|lives|was|born|sagt|schrieb|wohnt|dit|dijo|vive"
#: Family names and given names that are common where the titles above are used.
NAMES = (
    "smith|jones|brown|taylor|johnson|williams|miller|davis|wilson|anna|john|mary|james|david|"
    "müller|schmidt|schneider|fischer|weber|meyer|wagner|becker|garcía|lópez|martínez|pérez|"
    "gonzález|rodríguez|martin|bernard|dubois|durand|petit|moreau|laurent|simon|michel"
)
LABELERS = ("grouping", "gazetteer", "context", "follow", "shape", "edges")
#: Matches whose places are summed up at a time.
RUN = 256
WORD_BUCKETS = 128


def pieces(text: Column, pattern: str, possible: Column) -> Column:
    """Every match with the text before it since the last one and the text after it up to the next.

    ``possible`` spares texts that cannot match the search.
    """
    between = F.split(text, pattern, -1)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # Piece, match, piece after; zipping keeps the searches out of the lambdas.
    around = F.zip_with(F.arrays_zip(between.alias("a"), values.alias("b")),
                        F.slice(between, 2, F.greatest(F.size(values), F.lit(1))),
                        lambda x, y: F.struct(x["a"].alias("a"), x["b"].alias("b"), y.alias("c")))
    matched = F.filter(around, lambda x: x["b"].isNotNull())
    return F.when(possible, matched).otherwise(
        F.array().cast("array<struct<a:string,b:string,c:string>>"))


def _length(match: Column) -> Column:
    return F.length(match["a"]) + F.length(match["b"])


def _sum(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda total, n: total + n)


def _upto(run: Column, n: Column) -> Column:
    """The characters that the first ``n`` matches of a run take up."""
    return F.aggregate(F.slice(run, F.lit(1), n), F.lit(0), lambda total, x: total + _length(x))


def placed(out: DataFrame, name: str, kind, ok) -> DataFrame:
    """Turns the column of pieces into matches with their places, 32 characters before and 16 after.

    ``kind`` and ``ok`` make columns of a match's text. Places are running sums of lengths, in two
    steps: within runs of matches, and over the runs. A fold that carries its result along would
    copy it at every step, which costs the square of the number of matches. Every step is a column
    of its own that the next one uses twice, so that it is not computed anew for each element.
    """
    size = F.size(name)
    runs = F.when(size > 0, F.transform(
        F.sequence(F.lit(0), F.floor((size - 1) / RUN).cast("int")),
        lambda k: F.slice(F.col(name), k * RUN + 1, F.least(F.lit(RUN), size - k * RUN)),
    )).otherwise(F.array(F.col(name)))
    out = out.withColumn("runs", runs)
    out = out.withColumn("sums", F.transform(
        "runs", lambda run: F.aggregate(run, F.lit(0), lambda total, x: total + _length(x))))
    bases = F.transform("sums", lambda _, k: _sum(F.slice(F.col("sums"), F.lit(1), k)))
    out = out.withColumn("bases", bases)

    def match(run: Column, base: Column, x: Column, i: Column) -> Column:
        begin = base + _upto(run, i) + F.length(x["a"])
        return F.struct(
            kind(x["b"]).alias("kind"), x["b"].alias("value"), begin.alias("start"),
            (begin + F.length(x["b"])).alias("end"), F.right(x["a"], F.lit(32)).alias("before"),
            F.left(x["c"], F.lit(16)).alias("after"), ok(x["b"]).alias("ok"),
        )

    found = F.flatten(F.transform(
        F.arrays_zip(F.col("runs"), F.col("bases")),
        lambda r: F.transform(r["runs"], lambda x, i: match(r["runs"], r["bases"], x, i)),
    ))
    return out.withColumn(name, F.filter(found, lambda s: s["ok"])).drop("runs", "sums", "bases")


def found_spans(docs: DataFrame) -> DataFrame:
    """doc_id and all matches of all patterns, each kind by its place."""
    digits = lambda v: F.translate(v, "+ ().-", "")
    card = lambda v: F.length(digits(v)).between(16, 19) & F.call_function("luhn_check", digits(v))
    octets = lambda v: F.forall(
        F.split(v, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False))
    )
    named = lambda kind: lambda v: F.lit(kind)
    yes = lambda v: F.lit(True)
    text = F.col("text")
    specs = [
        (EMAIL, F.contains(text, F.lit("@")), named("email"), yes),
        (IP, text.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), named("ip"), octets),
        (DIGITS, text.rlike(r"[0-9](?:[\x20-]?[0-9]){8}"),
         lambda v: F.when(card(v), "card").otherwise("account"),
         lambda v: card(v) | F.length(digits(v)).between(9, 19)),
        (PHONE, F.contains(text, F.lit("+")), named("phone"),
         lambda v: F.length(digits(v)).between(8, 15)),
        (MASKED, text.rlike(r"[(\[]at[)\]]"), named("email_masked"), yes),
        (PERSON, text.rlike(PERSON), named("person"), yes),
    ]
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    for i, (pattern, possible, _, _) in enumerate(specs):
        out = out.withColumn(f"found{i}", pieces(text, pattern, possible))
    for i, (_, _, kind, ok) in enumerate(specs):
        out = placed(out, f"found{i}", kind, ok)
    every = F.concat(*(F.col(f"found{i}") for i in range(len(specs))))
    return out.select("doc_id", every.alias("spans"))


def votes(span: Column) -> dict[str, Column]:
    """What each labeler says of a span: 1, 0, or -1 for nothing."""
    kind, value = span["kind"], span["value"]
    before, after = span["before"], span["after"]
    digits = F.translate(value, "+ ().-", "")
    numeric = kind.isin("card", "phone", "account")
    words = F.lower(before)
    follow = F.lower(after)
    fours = r"^[0-9]{4}(?:[ -]?[0-9]{4}){2,3}(?:[ -]?[0-9]{1,3})?$"
    named = rf" (?:{NAMES})$"
    return {
        "grouping": F.when(kind.isin("card", "account"), F.when(value.rlike(fours), 1).otherwise(0))
        .when(kind == "phone", F.when(value.rlike(r"[0-9][ ().-]+[0-9]"), 1).otherwise(-1))
        .otherwise(-1),
        "gazetteer": F.when(kind.isin("email", "email_masked"), F.when(
            F.lower(value).rlike(rf"\.(?:{TOP_LEVELS})$"), 1).otherwise(0))
        .when(kind == "ip", F.when(value.rlike(r"^(?:0|10|127|255|192\.168|169\.254)\."), 0)
              .otherwise(1))
        .when(kind.isin("card", "account"), F.when(digits.rlike(r"^(?:4|5[1-5]|3[47]|6)"), 1)
              .otherwise(0))
        .when(kind == "phone", F.when(value.rlike(r"^\+(?:1|3[0-9]|4[0-9]|5[0-9]|[67-9])"), 1)
              .otherwise(0))
        .when(F.lower(value).rlike(named), 1).otherwise(-1),
        "context": F.when(words.rlike(rf"\b(?:{CUES})\b[^\p{{L}}]*$"), 1)
        .when(words.rlike(rf"\b(?:{COUNTER_CUES})\b[^\p{{L}}]*$"), 0).otherwise(-1),
        "follow": F.when(numeric & follow.rlike(rf"^[^\p{{L}}]*(?:{AMOUNTS})\b"), 0)
        .when((kind == "person") & follow.rlike(rf"^[^\p{{L}}]*(?:{SPOKEN})\b"), 1).otherwise(-1),
        "shape": F.when(~numeric, -1).when(digits.rlike(r"([0-9])\1{5}|012345|123456"), 0)
        .when(digits.rlike(r"000$"), 0).otherwise(1),
        "edges": F.when(before.rlike(r"[\p{L}\p{N}]$") | after.rlike(r"^[\p{L}\p{N}]"), 0)
        .otherwise(1),
    }


def features(span: Column) -> Column:
    """What the final classifier sees; fixed values and WORD_BUCKETS hashes of the word before."""
    last = F.regexp_extract(F.lower(span["before"]), r"(\p{L}++)[^\p{L}]*+$", 1)
    said = votes(span)
    return F.array(
        *(F.concat(F.lit(f"{name}="), span["kind"], F.lit(":"), said[name].cast("string"))
          for name in ("context", "follow", "grouping", "shape")),
        F.concat(F.lit("kind="), span["kind"]),
        F.concat(F.lit("size="), span["kind"], F.lit(":"),
                 F.least(F.length(span["value"]), F.lit(40)).cast("string")),
        F.concat(F.lit("left="), F.when(span["before"] == "", "start")
                 .when(span["before"].rlike(r"[\p{L}\p{N}]$"), "word")
                 .when(span["before"].rlike(r"\s$"), "blank").otherwise("mark")),
        F.concat(F.lit("right="), F.when(span["after"] == "", "end")
                 .when(span["after"].rlike(r"^[\p{L}\p{N}]"), "word")
                 .when(span["after"].rlike(r"^\s"), "blank").otherwise("mark")),
        F.concat(F.lit("first="), F.when(span["value"].rlike(r"^\+?[0-9]"), F.substring(
            span["value"], 1, 2)).otherwise("letter")),
        F.concat(F.lit("word="), F.pmod(F.xxhash64(last), F.lit(WORD_BUCKETS)).cast("string")),
    )


def reliabilities(patterns: list, rounds: int = 40) -> dict[tuple, float]:
    """EM over vote combinations: the probability that spans with each one are personal data.

    ``patterns`` holds (kind, votes, number of spans). Each kind has its own prior, each labeler
    its own odds of every vote given the truth, with a count of one added to each.
    """
    def clean(p: float) -> float:
        return min(max(p, 1e-6), 1 - 1e-6)

    truth = {}
    for kind, said, _ in patterns:
        cast = [v for v in said if v >= 0]
        truth[kind, said] = clean((sum(cast) + 0.5) / (len(cast) + 1))
    for _ in range(rounds):
        prior, told = {}, {}
        for kind, said, n in patterns:
            p = truth[kind, said]
            hot, total = prior.get(kind, (1.0, 2.0))
            prior[kind] = hot + n * p, total + n
            for j, v in enumerate(said):
                for y, share in ((1, p), (0, 1 - p)):
                    told[j, v, y] = told.get((j, v, y), 1.0) + n * share
        sums = {(j, y): sum(told.get((j, v, y), 1.0) for v in (-1, 0, 1))
                for j in range(len(LABELERS)) for y in (0, 1)}
        for kind, said, _ in patterns:
            hot, total = prior[kind]
            odds = math.log(hot / max(total - hot, 1e-9))
            for j, v in enumerate(said):
                if v >= 0:  # saying nothing is no evidence
                    odds += math.log(told[j, v, 1] / sums[j, 1])
                    odds -= math.log(told[j, v, 0] / sums[j, 0])
            truth[kind, said] = clean(1 / (1 + math.exp(-max(min(odds, 30), -30))))
    return truth


def lookup(key: Column, values: dict[str, float], missing: float) -> Column:
    """The number that belongs to a key."""
    if not values:
        return F.lit(missing)
    pairs = [F.lit(x) for pair in sorted(values.items()) for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(missing))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id and its spans, by kind, then start.

    A span is struct(kind, start, end, value, probability); places count code points and the end
    is exclusive. The four base kinds are always there; the other kinds where the classifier finds
    personal data likelier. A null or empty text has no spans, null ids stay null, rows that
    repeat are searched each, no rows give no rows, and other columns are not looked at.
    """
    found = pinned(found_spans(docs))
    each = found.select(F.explode("spans").alias("span"))
    voted = each.select("span", F.concat_ws(",", *(v.cast("string") for v in
                                                  votes(F.col("span")).values())).alias("votes"))
    # At most 7 kinds times 3 to the power of 6 rows.
    patterns = [
        (r["kind"], tuple(int(v) for v in r["votes"].split(",")), r["n"])
        for r in voted.groupBy("span.kind", "votes").agg(F.count(F.lit(1)).alias("n"))
        .orderBy("kind", "votes").collect()
    ]
    truth = reliabilities(patterns)
    by_votes = {f"{kind}|{','.join(map(str, said))}": p for (kind, said), p in truth.items()}
    likely = lookup(F.concat(F.col("span.kind"), F.lit("|"), F.col("votes")), by_votes, 0.5)
    # Feature values are bounded: kinds, lengths up to 40, edges, two characters, word buckets.
    counted = (
        voted.select(likely.alias("p"), F.explode(features(F.col("span"))).alias("feature"))
        .groupBy("feature").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no"))
        .collect()
    )
    spans = sum(n for *_, n in patterns)
    yes = sum(truth[kind, said] * n for kind, said, n in patterns)
    odds = {
        r["feature"]: math.log((r["yes"] + 1) / (yes + 2)) - math.log((r["no"] + 1) /
                                                                      (spans - yes + 2))
        for r in counted
    }
    prior = math.log((yes + 1) / (spans - yes + 1))

    def probability(span: Column) -> Column:
        parts = F.transform(features(span), lambda f: lookup(f, odds, 0.0))
        total = F.aggregate(parts, F.lit(prior), lambda acc, x: acc + x)
        return 1 / (1 + F.exp(-total))

    judged = F.transform("spans", lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
        s["value"].alias("value"), probability(s).alias("probability"),
    ))
    kept = F.filter(judged, lambda s: s["kind"].isin(*BASE) | (s["probability"] > 0.5))

    def only(kind: str) -> Column:
        return F.filter(F.col("kept"), lambda s: s["kind"] == kind)

    by_kind = F.concat(*map(only, KINDS))
    return found.select("doc_id", kept.alias("kept")).select("doc_id", by_kind.alias("spans"))
