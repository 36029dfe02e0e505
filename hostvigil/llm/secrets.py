"""Secrets in texts: pattern candidates, confirmed by decoding and parsing them.

Three kinds are reported on their pattern alone (``assign``, ``access``, ``hex``). The other kinds
are reported only when their structure holds up:

- ``pem``: a BEGIN/END block whose base64 decodes to DER with consistent nested lengths, or to an
  OpenSSH key container; line ends may be written as ``\\n``;
- ``ssh``: a base64 run that decodes to length-prefixed fields, the first naming a key type;
- ``der``: base64, on one line or wrapped over several, or hex of either case that decodes to one
  DER sequence whose nested lengths add up; base64 may be glued to a path before it;
- ``jwt``: three base64url parts, the first a JSON object with ``alg`` other than ``none``, the
  second a JSON object, the third a signature.

Base spans carry what their value decodes to as ``evidence``, null if nothing is recognised: a
digest or a random number has no structure that could confirm it. A text is scanned in time that
grows with its length, whatever it holds.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds in the order that breaks ties between spans with the same start; the first three are base.
KINDS = ("assign", "access", "hex", "pem", "ssh", "der", "jwt")
BASE = KINDS[:3]
SPAN = "struct<kind:string,start:int,end:int,evidence:string>"
SCHEMA = f"doc_id long, spans array<{SPAN}>"
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# Runs are matched whole, so asking for 24 at once finds what matching any run and dropping
# shorter ones would.
HEX = re.compile(r"[0-9a-f]{24,}")
MARK = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]+)-----")
PEM_BODY = re.compile(r"[A-Za-z0-9+/=\s:,-]*", re.ASCII)
UPPER_HEX = re.compile(r"[0-9A-F]{32,}")
# A run goes on over a line end if what stands before it is long enough to be a wrapped line.
RUN = re.compile(r"(?:[A-Za-z0-9+/]{16,}\r?\n[ \t]*)*[A-Za-z0-9+/]{16,}={0,2}")
LINE_RUN = re.compile(r"[A-Za-z0-9+/]{24,}={0,2}")
JWT = re.compile(
    r"(?<![A-Za-z0-9_-])(e[w-z0-7][A-Za-z0-9_-]*)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)"
)


def unbase64(text: str, url: bool = False) -> bytes | None:
    """Decoded base64, padded if need be; None if it is none."""
    text = text.rstrip("=")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(
            text + "=" * (-len(text) % 4), altchars=b"-_" if url else None, validate=True
        )
    except (binascii.Error, ValueError):
        return None


def der_element(data: bytes, at: int) -> tuple[int, int] | None:
    """Where the content of the DER element at a place begins and ends; None if it is none."""
    if at + 2 > len(data) or data[at] == 0:
        return None
    size, at = data[at + 1], at + 2
    if size & 0x80:
        octets = size & 0x7F
        if not 1 <= octets <= 4 or at + octets > len(data):
            return None
        size, at = int.from_bytes(data[at : at + octets], "big"), at + octets
    return (at, at + size) if at + size <= len(data) else None


def der_fits(data: bytes, at: int = 0, end: int | None = None) -> bool:
    """Whether the bytes are DER elements one after another, constructed ones likewise inside.

    Every element is looked at once, however deep it lies.
    """
    ends = [len(data) if end is None else end]
    while ends:
        if at == ends[-1]:
            ends.pop()
            continue
        found = der_element(data, at)
        if found is None or found[1] > ends[-1]:
            return False
        if data[at] & 0x20:
            ends.append(found[1])
            at = found[0]
        else:
            at = found[1]
    return True


def is_der_key(data: bytes, at: int = 0) -> bool:
    """One DER sequence that fills the bytes from a place on."""
    if len(data) - at < 16 or data[at] != 0x30:
        return False
    found = der_element(data, at)
    return found is not None and found[1] == len(data) and der_fits(data, *found)


def der_start(run: str) -> int | None:
    """Where in a base64 run a DER sequence begins that ends with it.

    At the run's begin or behind a character that paths hold as well. A run is decoded once per
    alignment, and a sequence whose length does not reach the end is given up at its first bytes.
    """
    body = run.rstrip("=")
    decoded: dict[int, bytes] = {}
    starts = [m.end() for m in re.finditer(r"\A(?=M)|[/+](?=M)", body)]
    for start in starts:
        phase = start % 4
        if phase not in decoded:
            decoded[phase] = unbase64(body[phase:]) or b""
        if decoded[phase] and is_der_key(decoded[phase], (start - phase) // 4 * 3):
            return start
    return None


def ssh_key_type(data: bytes) -> str | None:
    """The key type of an SSH public key blob whose field lengths add up."""
    at, fields = 0, []
    while at < len(data):
        if at + 4 > len(data):
            return None
        size = int.from_bytes(data[at : at + 4], "big")
        at += 4
        if size == 0 or at + size > len(data):
            return None
        fields.append(data[at : at + size])
        at += size
    if len(fields) < 2 or not re.fullmatch(rb"(ssh|ecdsa|sk)-[a-z0-9@.-]+", fields[0]):
        return None
    return fields[0].decode()


def json_object(text: str) -> dict | None:
    """The JSON object in a base64url part."""
    data = unbase64(text, url=True)
    try:
        found = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def signed_token(match: re.Match) -> str | None:
    """The algorithm of a signed token; None if the parts are no token, or it is not signed."""
    alg = (json_object(match[1]) or {}).get("alg")
    if not isinstance(alg, str) or alg.lower() == "none" or json_object(match[2]) is None:
        return None
    return alg


def evidence(value: str) -> str | None:
    """What a value decodes to, if anything is recognised."""
    if re.fullmatch(r"(?:[0-9a-f]{2}){16,}|(?:[0-9A-F]{2}){16,}", value):
        return "der" if is_der_key(bytes.fromhex(value)) else None
    if (jwt := JWT.fullmatch(value)) and (alg := signed_token(jwt)):
        return f"jwt {alg}"
    if len(value) >= 24 and (data := unbase64(value)):
        return "der" if is_der_key(data) else ssh_key_type(data)
    return None


def pem_blocks(text: str) -> list[tuple[int, int, str]]:
    """(start, end, content) of the key blocks: an END mark and the last BEGIN mark before it.

    Marks are found in one pass and blocks do not overlap.
    """
    blocks, opened = [], None
    for mark in MARK.finditer(text):
        if mark[1] == "BEGIN":
            opened = mark
            continue
        if opened is not None and opened[2] == mark[2]:
            body = text[opened.end() : mark.start()]
            body = body.replace("\\r", "\n").replace("\\n", "\n")
            if PEM_BODY.fullmatch(body):
                lines = (x for x in re.split(r"[\r\n]+", body) if ":" not in x)
                data = unbase64("".join("".join(lines).split())) or b""
                if data.startswith(b"openssh-key-v1\0"):
                    blocks.append((opened.start(), mark.end(), "openssh"))
                elif data and data[0] == 0x30 and der_fits(data):
                    blocks.append((opened.start(), mark.end(), "der"))
        opened = None
    return blocks


def find_secrets(text: str | None) -> list[tuple[str, int, int, str | None]]:
    """Spans (kind, start, end, evidence) by start, then kind; ends are exclusive."""
    if not text:
        return []
    spans = [("assign", *m.span(), evidence(m[2])) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [("access", *m.span(), None) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    for m in HEX.finditer(text):
        found = evidence(m[0])
        spans.append(("hex", *m.span(), found))
        if found == "der":
            spans.append(("der", *m.span(), found))
    spans += [("der", *m.span(), "der") for m in UPPER_HEX.finditer(text) if evidence(m[0]) == "der"]
    blocks = pem_blocks(text) if "-----BEGIN " in text else []
    spans += [("pem", *block) for block in blocks]
    begins = [a for a, _, _ in blocks]

    def in_block(at: int) -> bool:
        k = bisect.bisect_right(begins, at) - 1
        return k >= 0 and at < blocks[k][1]

    for m in RUN.finditer(text):
        if not in_block(m.start()):
            spans += encoded_keys(m[0], m.start())
    for m in JWT.finditer(text):
        if alg := signed_token(m):
            spans.append(("jwt", *m.span(), f"jwt {alg}"))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def encoded_keys(run: str, at: int) -> list[tuple[str, int, int, str]]:
    """Keys in a base64 run that begins at a place: the whole of it, or else its lines."""
    if "\n" in run:
        joined = "".join(run.split())
        start = der_start(joined)
        if start is not None and start < len(run.split("\n", 1)[0]):
            return [("der", at + start, at + len(run), "der")]
    spans = []
    for m in LINE_RUN.finditer(run):
        if m[0].startswith("AAAA") and (data := unbase64(m[0])) and (kind := ssh_key_type(data)):
            spans.append(("ssh", at + m.start(), at + m.end(), kind))
        elif (start := der_start(m[0])) is not None:
            spans.append(("der", at + m.start() + start, at + m.end(), "der"))
    return spans


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id and its spans, counted in code points.

    A null or empty text has no spans, a null doc_id stays null, rows that repeat are scanned
    each, no rows give no rows, and other columns are not looked at. No shuffle; a long text
    is scanned whole within its row.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()),
                                   ("end", pa.int32()), ("evidence", pa.string())]))
        for batch in batches:
            spans = [
                [dict(zip(("kind", "start", "end", "evidence"), s, strict=True))
                 for s in find_secrets(text)]
                for text in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, kind)], ["doc_id", "spans"]
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        scan, SCHEMA
    )


def redact(text: str | None) -> str | None:
    """The text with every span replaced by its kind in angle brackets; overlaps become one."""
    spans = find_secrets(text)
    parts, at = [], 0
    merged: list[list] = []
    for kind, start, end, _ in spans:
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([kind, start, end])
    for kind, start, end in merged:
        parts += [text[at:start], f"<{kind}>"]
        at = end
    return "".join(parts) + text[at:] if spans else text


def redact_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets in ``text`` replaced and ``n_chars``, if there, counted anew where
    something was replaced.

    Every row stays, texts without secrets as they are (null and empty ones too), and all
    columns, whatever their names.
    """

    @F.pandas_udf("string")
    def redacted(texts):
        return texts.map(redact, na_action="ignore").astype(object)

    new = "redacted"
    while new in docs.columns:
        new += "_"
    out = docs.withColumn(new, redacted(F.col("text")))
    columns = {"text": F.col(new)}
    if "n_chars" in docs.columns:
        changed = ~F.col("text").eqNullSafe(F.col(new))
        columns["n_chars"] = F.when(
            changed, F.length(new).cast(docs.schema["n_chars"].dataType)
        ).otherwise(F.col("n_chars"))
    return out.select(*(columns[c].alias(c) if c in columns else F.col(f"`{c}`")
                        for c in docs.columns))
