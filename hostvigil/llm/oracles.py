"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

import re

from hostvigil.llm.license_templates import PHRASES, TEMPLATES

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _template_regex(template: str) -> tuple[str, list[str], int]:
    """A template as a regular expression over words that each end in a blank; the words it can
    begin with, and how many words it matches at most."""
    pattern, most, depth, firsts, opened = "", 0, 0, [], True
    for part in re.split(r"(\{\{|\}\}|\[\[[^\]]*\]\])", template):
        if part == "{{":
            pattern, depth = pattern + "(?:", depth + 1
        elif part == "}}":
            pattern, depth = pattern + ")?", depth - 1
        elif part.startswith("[["):
            low, high = re.findall("[0-9]+", part)[:2]
            pattern, most = f"{pattern}(?:[^ ]+ ){{{low},{high}}}", most + int(high)
        else:
            words = re.findall("[a-z0-9]+", part.lower())
            pattern, most = pattern + "".join(f"{w} " for w in words), most + len(words)
            if words and opened:
                firsts.append(words[0])
                opened = depth > 0  # an optional region can be passed over
    return pattern, firsts, most


def _license_matches() -> str:
    """All places where a template or phrase fits, with the longest text that does."""
    rows = []
    for label, template in TEMPLATES.items():
        pattern, firsts, most = _template_regex(template)
        rows += [(label, False, pattern, first, most) for first in dict.fromkeys(firsts)]
    for phrase, label in PHRASES.items():
        pattern, firsts, most = _template_regex(phrase)
        rows += [(label, True, pattern, firsts[0], most)]
    values = ", ".join(
        f"('{label}', {str(phrase).lower()}, '{pattern}', '{first}', {most})"
        for label, phrase, pattern, first, most in rows
    )
    return f"""
        w AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
            FROM documents),
        t(label, phrase, pattern, first, most) AS (VALUES {values}),
        maybe AS (
            SELECT r, words, t.* FROM w JOIN t
            ON list_contains(words, first)
               AND regexp_matches(array_to_string(words, ' ') || ' ', '(^| )' || pattern)),
        starts AS (
            SELECT * FROM (SELECT *, unnest(range(1, len(words) + 1)) AS i FROM maybe)
            WHERE words[i] = first),
        ends AS (
            SELECT *, unnest(range(i, least(i + most, len(words) + 1))) AS j FROM starts),
        matches AS (
            SELECT r, label, phrase, i, max(j) AS j FROM ends
            WHERE regexp_full_match(array_to_string(words[i:j], ' ') || ' ', pattern)
            GROUP BY ALL)"""


_LICENSES = f"""
    WITH {_license_matches()},
    covered AS (
        SELECT r, count(DISTINCT k) AS n
        FROM (SELECT r, unnest(range(i, j + 1)) AS k FROM matches) GROUP BY r),
    found AS (
        SELECT r, count(*) FILTER (WHERE phrase) AS n_base,
            min(i - 1) FILTER (WHERE phrase) AS first_word,
            max(i - 1) FILTER (WHERE phrase) AS last_word,
            string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE phrase) AS base_labels,
            string_agg(DISTINCT label, ',' ORDER BY label) AS labels
        FROM matches GROUP BY r)
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
        first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
        coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
        coalesce(covered.n::DOUBLE / len(words), 0.0) AS score
    FROM w LEFT JOIN found USING (r) LEFT JOIN covered USING (r)"""

_FILL_MIDDLE = """
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
            sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
        FROM documents),
    numbers AS (
        SELECT *, ('0x' || h[1:8])::BIGINT % (n + 1) AS x, ('0x' || h[9:16])::BIGINT % (n + 1) AS y,
            ('0x' || h[17:24])::BIGINT % 100 AS u, ('0x' || h[25:32])::BIGINT % 100 AS v
        FROM d),
    cuts AS (
        SELECT *, least(x, y) AS p, greatest(x, y) - least(x, y) AS m,
            CASE WHEN t = '' OR u >= 90 OR contains(t, '<P>') OR contains(t, '<S>')
                      OR contains(t, '<M>') THEN 'plain'
                 WHEN v < 20 THEN 'spm' ELSE 'psm' END AS form
        FROM numbers),
    parts AS (
        SELECT *, substring(t, 1, p) AS a, substring(t, p + 1, m) AS b,
            substring(t, p + m + 1, n - p - m) AS c
        FROM cuts)
    SELECT doc_id, n::BIGINT AS n, form,
        CASE WHEN form <> 'plain' THEN p END::BIGINT AS prefix_chars,
        CASE WHEN form <> 'plain' THEN m END::BIGINT AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN t
            WHEN 'psm' THEN '<P>' || a || '<S>' || c || '<M>' || b
            ELSE '<S>' || c || '<P>' || a || '<M>' || b END) AS output_sha256,
        sha256(t) AS restored_sha256
    FROM parts"""

# Line ends, words and blanks as the base rules name them; line counts by distinct ids of a host.
_QUALITY = r"""
    WITH d AS (
        SELECT row_number() OVER () AS r, doc_id, source AS host, coalesce(text, '') AS t
        FROM documents),
    w AS (
        SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
            list_filter(string_split(t, chr(10)),
                lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
        FROM d),
    windows AS (
        SELECT r, i, words[i:i + 2] AS three
        FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
    twice AS (SELECT r, three FROM windows GROUP BY r, three HAVING count(*) > 1),
    covered AS (
        SELECT r, count(DISTINCT i + k) AS n
        FROM windows JOIN twice USING (r, three), (VALUES (0), (1), (2)) o(k) GROUP BY r),
    worded AS (
        SELECT r, doc_id, host, t,
            trim(regexp_replace(regexp_replace(lower(x), '[\x20\x09-\x0D]+', ' ', 'g'),
                '[0-9]+', '0', 'g')) AS line,
            len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n
        FROM (SELECT r, doc_id, host, t, unnest(lines) AS x FROM w)),
    per_host AS (
        SELECT host, count(*) AS docs FROM (SELECT DISTINCT host, doc_id, t FROM d) GROUP BY host),
    per_line AS (
        SELECT host, line, count(*) AS docs
        FROM (SELECT DISTINCT host, line, doc_id, t FROM worded) GROUP BY host, line),
    common AS (
        SELECT l.host, line FROM per_line l
        JOIN per_host h ON l.host IS NOT DISTINCT FROM h.host
        WHERE l.docs > 20 AND l.docs > 0.002 * h.docs),
    gone AS (
        SELECT r, sum(n) AS n FROM worded x
        JOIN common c ON x.line = c.line AND x.host IS NOT DISTINCT FROM c.host GROUP BY r),
    measured AS (
        SELECT doc_id, len(words)::BIGINT AS n_words,
            length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
            (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
            (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
            coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
            coalesce(gone.n, 0)::BIGINT AS n_line_words
        FROM w LEFT JOIN covered USING (r) LEFT JOIN gone USING (r))
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
            AND n_words - n_line_words >= 0.5 * n_words AS kept
    FROM measured"""

# A window is one text of its words, which a blank cannot be part of.
_REPEATS = r"""
    WITH w AS (
        SELECT row_number() OVER (ORDER BY doc_id, md5(coalesce(text, ''))) AS r, doc_id,
            regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
        FROM documents),
    windows AS (
        SELECT r, i, md5(array_to_string(words[i:i + 19], ' ')) AS h
        FROM (SELECT r, words, unnest(range(1, len(words) - 18)) AS i FROM w)),
    first AS (SELECT h, min(struct_pack(r := r, i := i)) AS f FROM windows GROUP BY h),
    again AS (
        SELECT r, i FROM windows JOIN first USING (h) WHERE struct_pack(r := r, i := i) <> f),
    gone AS (
        SELECT DISTINCT r, i + k AS i FROM again, (SELECT unnest(range(0, 20)) AS k)),
    removed AS (SELECT r, list(i) AS places, count(*) AS n FROM gone GROUP BY r)
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
        sha256(CASE WHEN n IS NULL THEN array_to_string(words, ' ')
            ELSE array_to_string(list_filter(words, lambda x, i: NOT list_contains(places, i)), ' ')
            END) AS kept_sha256
    FROM w LEFT JOIN removed USING (r)"""

# All pairs of vectors of one length; components by carrying the smallest id along links.
_SIMILAR = """
    WITH RECURSIVE v AS (
        SELECT vec_id, embedding::DOUBLE[] AS e, sqrt(list_sum(list_transform(
            embedding::DOUBLE[], lambda x: x * x))) AS norm
        FROM embeddings),
    good AS (SELECT * FROM v WHERE norm > 0 AND isfinite(norm)),
    links AS (
        SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b
        ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
        WHERE list_inner_product(a.e, b.e) >= 0.9 * a.norm * b.norm),
    reach AS (
        SELECT vec_id AS x, vec_id AS y FROM v
        UNION
        SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
    least AS (SELECT x, min(y) AS y FROM reach GROUP BY x),
    degree AS (SELECT x, count(*) AS n FROM links GROUP BY x)
    SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least.y::BIGINT AS component_id,
        vec_id = least.y AS kept
    FROM v JOIN least ON vec_id = least.x LEFT JOIN degree ON vec_id = degree.x"""

ORACLES: dict[str, str] = {
    "op1_quality_lines": _QUALITY,
    "op3_substring_dedup": _REPEATS,
    "op8_subspace_join": _SIMILAR,
    "op11_license_templates": _LICENSES,
    "op13_fill_middle": _FILL_MIDDLE,
}
