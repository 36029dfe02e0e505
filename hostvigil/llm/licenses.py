"""License notices found by template markup, compiled into one automaton over words.

A template's mandatory words must stand exactly and in order; optional regions may be absent and
replaceable regions hold any words up to a number (see ``license_templates``). All templates form
one nondeterministic automaton, made deterministic as far as texts reach into it. It is started
only at words that begin a template and dies at the first word that none allows, so a text costs
one look per word. Documents stay in their rows; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostvigil.llm.common import release_memory

#: A word is a run of letters, digits and anything outside ASCII.
WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_MARKUP = re.compile(r"(\{\{|\}\}|\[\[\d+,\d+(?:\|[^\]]*)?\]\])")
#: Deterministic states that are remembered; beyond it they are found anew.
REMEMBERED = 50_000

SCHEMA = (
    "doc_id long, n_words long, matches array<struct<label: string, phrase: boolean, "
    "first_word: long, last_word: long, start: long, end: long>>, score double"
)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.translate(_LOWER))


class TemplateAutomaton:
    """An automaton that accepts the words of some templates, each under a label of its own."""

    def __init__(self, templates: dict[str, str]):
        self.by_word: list[dict[str, list[int]]] = []
        self.by_any: list[list[int]] = []
        self.skips: list[list[int]] = []
        self.accepts: dict[int, str] = {}
        root = self._state()
        for label, template in templates.items():
            first = self._state()
            self.skips[root].append(first)
            last = self._compile(template, first, label)
            self.accepts[last] = label
        opening = self._closure([root])
        if any(self.by_any[s] or s in self.accepts for s in opening):
            raise ValueError("a template begins with a replaceable region or has no words")
        self.alphabet = frozenset(w for moves in self.by_word for w in moves)
        self.opening = opening
        self.starts = frozenset(w for s in opening for w in self.by_word[s])
        self.forget()

    def forget(self) -> None:
        self.places: dict[frozenset[int], int] = {}
        self.sets: list[frozenset[int]] = []
        self.moves: list[dict[str, int]] = []
        self.labels: list[tuple[str, ...]] = []
        self.begin = self._place(self.opening)

    def _state(self) -> int:
        self.by_word.append({})
        self.by_any.append([])
        self.skips.append([])
        return len(self.skips) - 1

    def _compile(self, template: str, at: int, label: str) -> int:
        """Adds a template's states after ``at``; the last one accepts."""
        opened: list[int] = []
        for part in _MARKUP.split(template):
            if part == "{{":
                opened.append(at)
            elif part == "}}":
                if not opened:
                    raise ValueError(f"an optional region ends before it begins: {label}")
                # What follows is reached from the region's begin as well.
                after = self._state()
                self.skips[at].append(after)
                self.skips[opened.pop()].append(after)
                at = after
            elif part.startswith("[["):
                least, most = map(int, re.findall(r"\d+", part)[:2])
                after = self._state()
                for k in range(most):
                    if k >= least:
                        self.skips[at].append(after)
                    to = self._state()
                    self.by_any[at].append(to)
                    at = to
                self.skips[at].append(after)
                at = after
            else:
                for word in words_of(part):
                    to = self._state()
                    self.by_word[at].setdefault(word, []).append(to)
                    at = to
        if opened:
            raise ValueError(f"an optional region is not closed: {label}")
        return at

    def _closure(self, states: list[int]) -> frozenset[int]:
        found, queue = set(states), list(states)
        while queue:
            for to in self.skips[queue.pop()]:
                if to not in found:
                    found.add(to)
                    queue.append(to)
        return frozenset(found)

    def _place(self, states: frozenset[int]) -> int:
        if states not in self.places:
            self.places[states] = len(self.sets)
            self.sets.append(states)
            self.moves.append({})
            self.labels.append(tuple(sorted(self.accepts[s] for s in states if s in self.accepts)))
        return self.places[states]

    def _step(self, state: int, word: str) -> int:
        """The state after a word; -1 if no template goes on."""
        to = [t for s in self.sets[state]
              for t in (*self.by_word[s].get(word, ()), *self.by_any[s])]
        after = self._place(self._closure(to)) if to else -1
        self.moves[state][word] = after
        return after

    def longest_from(self, words: list[str], first: int) -> dict[str, int]:
        """The last word of the longest text that each template accepts from ``first`` on."""
        if len(self.sets) > REMEMBERED:
            self.forget()
        state, ends = self.begin, {}
        for at in range(first, len(words)):
            # Words that no template names are alike.
            word = words[at] if words[at] in self.alphabet else ""
            after = self.moves[state].get(word)
            state = self._step(state, word) if after is None else after
            if state < 0:
                break
            for label in self.labels[state]:
                ends[label] = at
        return ends

    def find(self, words: list[str]) -> list[tuple[str, int, int]]:
        """(label, first word, last word) of all matches by their first words.

        A match within an earlier one of the same template is part of it.
        """
        found, reached = [], {}
        for first, word in enumerate(words):
            if word in self.starts:
                for label, last in self.longest_from(words, first).items():
                    if last > reached.get(label, -1):
                        found.append((label, first, last))
                        reached[label] = last
        return found


def covered(spans: list[tuple[str, int, int]]) -> int:
    """How many words lie in any of the spans, which come by their first words."""
    total, upto = 0, -1
    for _, first, last in spans:
        total += max(0, last - max(first - 1, upto))
        upto = max(upto, last)
    return total


def scan_licenses(
    docs: DataFrame, templates: dict[str, str], phrases: dict[str, str]
) -> DataFrame:
    """One row per document: doc_id, n_words, matches, score.

    ``phrases`` are templates without regions, given as wording to label; all their places count.
    A match names its label, its first and last word (from 0) and its code points (``end``
    exclusive). ``score`` is the share of the words that lie in matches, 0 without words. A null
    text counts as empty; a null doc_id stays null; repeated rows give repeated results; an empty
    table gives none; other columns are not looked at. Templates lie on the driver and are sent
    with the task: their number does not grow with the documents.
    """
    named = {f"t{label}": wording for label, wording in templates.items()}
    named |= {f"p{label}": wording for wording, label in phrases.items()}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = TemplateAutomaton(named)
        schema = None
        for batch in batches:
            rows = [_scanned(automaton, text or "") for text in batch.column(1).to_pylist()]
            if schema is None:
                span = pa.struct([
                    ("label", pa.string()), ("phrase", pa.bool_()), ("first_word", pa.int64()),
                    ("last_word", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
                ])
                schema = pa.list_(span)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([n for n, _, _ in rows], pa.int64()),
                    pa.array([m for _, m, _ in rows], schema),
                    pa.array([s for _, _, s in rows], pa.float64()),
                ],
                ["doc_id", "n_words", "matches", "score"],
            )
        release_memory()

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(scan, SCHEMA)


def _scanned(automaton: TemplateAutomaton, text: str) -> tuple[int, list[dict], float]:
    words = words_of(text)
    spans = automaton.find(words)
    if not spans:
        return len(words), [], 0.0
    places = [m.span() for m in WORD.finditer(text.translate(_LOWER))]
    matches = [
        {
            "label": label[1:], "phrase": label[0] == "p", "first_word": first,
            "last_word": last, "start": places[first][0], "end": places[last][1],
        }
        for label, first, last in spans
    ]
    return len(words), matches, covered(spans) / len(words)
