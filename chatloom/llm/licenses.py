"""License scans by template-markup matching.

A template is a license's wording with the public markup for what may vary: <<beginOptional>> ... <<endOptional>>
for wording that may be left out, nested at will, and <<var;name="...";original="...";match="...">> for what may be
replaced. It is compiled into an automaton over words. A place in a text is accepted if a path of the automaton
reads its words: all mandatory words exactly and in order, optional regions as a whole or not at all, and in
the place of a replaceable region what its match allows.

Every template has an anchor, the run of up to ANCHOR mandatory words that is least likely to be met by chance. All
anchors are looked up at once by word hashes over the whole text, and the automaton runs from each find in both
directions, so texts without an anchor cost no more than their words. Anchors lie outside all regions, so every
accepted place holds its anchor, and nothing is missed.

Defined results: words are case-insensitive for ASCII letters, and punctuation and line breaks between them don't
count; null and blank texts have no words, no labels and score 0; equal rows get equal results; an empty table gives
no rows; further columns are ignored. score is m / (m + 8) for the greatest number m of mandatory words among the
accepted templates and found phrases, 0 without any.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from chatloom.llm.common import table
from chatloom.llm.license_texts import PHRASES, TEMPLATES
from chatloom.llm.textops import chunks, plain_words, span_hashes

#: Words of an anchor at most; words that a replaceable region without stated bounds may have; bytes of all templates, which every task gets.
ANCHOR, WILD, MAX_BYTES = 4, 40, 4 << 20
EVIDENCE = 8
_MARK = re.compile(r"<<(beginOptional|endOptional|var)\b(.*?)>>", re.DOTALL)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_COUNTS = re.compile(r"\.(?:\{(\d+),(\d+)\}|([*+]))")


def words_of(text: str) -> list[str]:
    """Words as in texts: A-Z lower-cased, the rest as it is."""
    return _WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text))


@dataclass(frozen=True)
class Optional:
    """Wording that stands as a whole or not at all."""

    parts: tuple


@dataclass(frozen=True)
class Replaceable:
    """Any of the choices, or without choices from least to most words of any kind."""

    choices: tuple[tuple[str, ...], ...] = ()
    least: int = 0
    most: int = WILD


def _replaceable(attributes: str) -> Replaceable:
    """match="a b|c" lists the choices; match=".{2,9}", ".+" or ".*" stands for so many words of any kind."""
    match = (re.search(r'match="(.*?)"', attributes, re.DOTALL) or [None, ".*"])[1]
    if counts := _COUNTS.fullmatch(match):
        return Replaceable((), int(counts[1] or counts[3] == "+"), int(counts[2] or WILD))
    choices = tuple(tuple(words_of(x)) for x in match.split("|"))
    if re.search(r"[\[\](){}*+?\\^$]", match) or not all(choices):
        raise ValueError(f"a match is a list of words or .{{least,most}}: {match}")
    return Replaceable(choices)


def parse(template: str) -> tuple:
    """A template's words, Optional and Replaceable regions in order."""
    open_regions: list[list] = [[]]
    at = 0
    for m in [*_MARK.finditer(template), None]:
        open_regions[-1] += words_of(template[at : m.start() if m else None])
        if m is None:
            break
        at = m.end()
        if m[1] == "beginOptional":
            open_regions.append([])
        elif m[1] == "var":
            open_regions[-1].append(_replaceable(m[2]))
        elif len(open_regions) < 2:
            raise ValueError("<<endOptional>> without its beginning")
        else:
            own = Optional(tuple(open_regions.pop()))
            open_regions[-1].append(own)
    if len(open_regions) > 1:
        raise ValueError("<<beginOptional>> without its end")
    return tuple(open_regions[0])


@dataclass
class Automaton:
    """Numbered states with the words that lead on from each (None: any word), steps without a word, the last state, and the anchor."""

    steps: list[list[tuple[str | None, int]]] = field(default_factory=lambda: [[]])
    free: list[list[int]] = field(default_factory=lambda: [[]])
    mandatory: int = 0
    anchor: tuple[str, ...] = ()
    anchor_state: int = 0

    def _state(self) -> int:
        self.steps.append([])
        self.free.append([])
        return len(self.steps) - 1

    def _word(self, state: int, word: str | None) -> int:
        new = self._state()
        self.steps[state].append((word, new))
        return new

    def add(self, parts: tuple, state: int, runs: list[tuple[int, list[str]]] | None = None) -> int:
        """Compiles parts from state on, and says where they end; runs gets the mandatory words outside of regions with the states before them."""
        run: list[str] | None = None
        for part in parts:
            if isinstance(part, str):
                if runs is not None:
                    if run is None:
                        runs.append((state, run := []))
                    run.append(part)
                state = self._word(state, part)
                continue
            run, before = None, state
            if isinstance(part, Optional):
                state = self.add(part.parts, self._free(before))
                ends = [before, state]
            elif part.choices:
                ends = [self.add(choice, self._free(before)) for choice in part.choices]
            else:
                for _ in range(part.least):
                    state = self._word(state, None)
                ends = [state]
                for _ in range(part.most - part.least):
                    ends.append(state := self._word(state, None))
            state = self._state()
            for end in ends:
                self.free[end].append(state)
        return state

    def _free(self, state: int) -> int:
        new = self._state()
        self.free[state].append(new)
        return new

    def reached(self, states: set[int], free: list[list[int]]) -> set[int]:
        """states and those that steps without a word lead to."""
        out, left = set(states), list(states)
        while left:
            new = [x for x in free[left.pop()] if x not in out]
            out.update(new)
            left += new
        return out


def compiled(template: str) -> Automaton:
    own, runs = Automaton(), []
    own.add(parse(template), 0, runs)
    own.mandatory = sum(len(run) for _, run in runs)
    places = [(sum(map(len, run[k : k + ANCHOR])), state, k, run) for state, run in runs for k in range(max(1, len(run) - ANCHOR + 1))]
    if not places:
        raise ValueError("a template needs a mandatory word")
    _, state, k, run = max(places, key=lambda x: (x[0], -x[1], -x[2]))
    # Words of a run follow each other by one step each.
    for _ in range(k):
        state = own.steps[state][0][1]
    own.anchor, own.anchor_state = tuple(run[k : k + ANCHOR]), state
    return own


class Words:
    """The words of a row, spelled out one at a time as the automaton asks for them."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        self.data, self.starts, self.ends = data, starts, ends

    def __len__(self) -> int:
        return len(self.starts)

    def __getitem__(self, i: int) -> str:
        return self.data[self.starts[i] : self.ends[i]].tobytes().decode()


class Matcher:
    """An automaton that can be run to both sides of its anchor."""

    def __init__(self, own: Automaton) -> None:
        self.own = own
        n = len(own.steps)
        back: list[list[tuple[str | None, int]]] = [[] for _ in range(n)]
        back_free: list[list[int]] = [[] for _ in range(n)]
        for a in range(n):
            for word, b in own.steps[a]:
                back[b].append((word, a))
            for b in own.free[a]:
                back_free[b].append(a)
        self.sides = ((own.steps, own.free, n - 1, 1), (back, back_free, 0, -1))

    def end(self, words: Words, at: int, side: int) -> int | None:
        """How far the automaton gets from the anchor at word `at`: the farthest border of an accepted place, to the right (0) or the left (1)."""
        steps, free, goal, way = self.sides[side]
        states, found = self.own.reached({self.own.anchor_state}, free), None
        i = at if side == 0 else at - 1
        while states:
            if goal in states:
                found = i if side == 0 else i + 1
            if not 0 <= i < len(words):
                break
            word = words[i]
            states = self.own.reached({b for a in states for w, b in steps[a] if w is None or w == word}, free)
            i += way
        return found

    def place(self, words: Words, at: int) -> tuple[int, int] | None:
        """The longest accepted place (first word, word after the last) whose anchor is at word `at`."""
        right = self.end(words, at, 0)
        left = None if right is None else self.end(words, at, 1)
        return None if left is None else (left, right)


def _hashes(words: tuple[str, ...]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
    _, starts, ends, _ = plain_words(data, np.array([0, len(data)]))
    return span_hashes(data, starts, ends)


def _places(hashes: np.ndarray, row_end: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where the wanted words stand consecutively in one row; row_end: for each word where its row ends."""
    at = np.flatnonzero(hashes == wanted[0])
    at = at[at + len(wanted) <= row_end[at]]
    for k in range(1, len(wanted)):
        at = at[hashes[at + k] == wanted[k]]
    return at


def _scan(batches: Iterator[pa.RecordBatch], templates: dict[str, list[Automaton]], phrases: dict[str, str]) -> Iterator[pa.RecordBatch]:
    automata = [(label, Matcher(a), _hashes(a.anchor)) for label, own in templates.items() for a in own]
    wanted = [(label, _hashes(tuple(words_of(p)))) for p, label in phrases.items()]
    for batch in batches:
        for part, data, offsets in chunks(batch, "text", lower=False):
            low, starts, ends, first = plain_words(data, offsets)
            hashes, n = span_hashes(low, starts, ends), np.diff(first)
            row_of = np.repeat(np.arange(len(n)), n)
            row_end = first[1:][row_of]
            base: list[set[str]] = [set() for _ in n]
            labels: list[set[str]] = [set() for _ in n]
            spans: list[list[tuple[str, int, int]]] = [[] for _ in n]
            most, n_base = np.zeros(len(n), dtype=np.int64), np.zeros(len(n), dtype=np.int64)
            first_word, last_word = np.full(len(n), np.iinfo(np.int64).max), np.full(len(n), -1)
            for label, own in wanted:
                at = _places(hashes, row_end, own)
                rows = row_of[at]
                np.add.at(n_base, rows, 1)
                np.minimum.at(first_word, rows, at - first[rows])
                np.maximum.at(last_word, rows, at - first[rows])
                for row in np.unique(rows):
                    base[row].add(label)
                    most[row] = max(most[row], len(own))
            found = [(row_of[x], x - first[row_of[x]], label, m) for label, m, own in automata for x in _places(hashes, row_end, own)]
            for row, at, label, matcher in found:
                own_words = slice(first[row], first[row + 1])
                if place := matcher.place(Words(low, starts[own_words], ends[own_words]), int(at)):
                    labels[row].add(label)
                    spans[row].append((label, *place))
                    most[row] = max(most[row], matcher.own.mandatory)
            none = n_base == 0
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pa.array(n), pa.array(n_base), pa.array(first_word, mask=none), pa.array(last_word, mask=none),
                pa.array([",".join(sorted(x)) for x in base], pa.string()), pa.array([",".join(sorted(x | y)) for x, y in zip(base, labels, strict=True)], pa.string()),
                pa.array(most / (most + EVIDENCE)), pa.array([[{"label": x, "first": a, "after": b} for x, a, b in sorted(set(own))] for own in spans], _SPANS),
            ], _NAMES)


_SPANS = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("after", pa.int64())]))
_NAMES = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label string, first long, after long>>"


def scan_licenses(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """docs(doc_id, text) with words, places and labels of phrases, all labels, the score, and the accepted places by word numbers.

    templates: marked-up wordings by label; phrases: label by phrase.
    """
    if sum(len(t.encode()) for own in templates.values() for t in own) > MAX_BYTES:
        raise ValueError(f"templates of over {MAX_BYTES} bytes")
    automata = {label: [compiled(t) for t in own] for label, own in templates.items()}
    return docs.select("doc_id", "text").mapInArrow(lambda b: _scan(b, automata, phrases), SCHEMA)


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


def _pattern(parts: tuple) -> str:
    """Parts as a regular expression over words that each end in a space, for the SQL."""
    out = ""
    for p in parts:
        if isinstance(p, str):
            out += f"{p} "
        elif isinstance(p, Optional):
            out += f"(?:{_pattern(p.parts)})?"
        elif p.choices:
            out += "(?:" + "|".join(_pattern(c) for c in p.choices) + ")"
        else:
            out += f"(?:[^ ]+ ){{{p.least},{p.most}}}"
    return out


def _oracle() -> str:
    """The query in SQL: words with spaces between them, templates as regular expressions."""
    tests = [(label, compiled(t).mandatory, f" {_pattern(parse(t))}") for label, own in TEMPLATES.items() for t in own]
    places = lambda p: (
        f"[i FOR i IN range(1, len(w) - {len(words_of(p)) - 2}) IF w[i:i + {len(words_of(p)) - 1}] = {words_of(p)}]"
    )
    hits = ", ".join(f"CASE WHEN regexp_matches(s, '{x}') THEN {{'label': '{label}', 'm': {m}}} END" for label, m, x in tests)
    base = ", ".join(f"{{'label': '{label}', 'm': {len(words_of(p))}, 'places': {places(p)}}}" for p, label in PHRASES.items())
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
s AS (SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS s FROM d),
h AS (SELECT doc_id, len(w) AS n_words, [x FOR x IN [{hits}] IF x IS NOT NULL] AS t, [x FOR x IN [{base}] IF len(x.places) > 0] AS b FROM s),
f AS (SELECT doc_id, n_words, t, b, flatten([x.places FOR x IN b]) AS found, coalesce(list_max([x.m FOR x IN t] || [x.m FOR x IN b]), 0) AS m FROM h)
SELECT doc_id, n_words, len(found)::BIGINT AS n_base, list_min(found) - 1 AS first_word, list_max(found) - 1 AS last_word,
  array_to_string(list_sort(list_distinct([x.label FOR x IN b])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct([x.label FOR x IN b] || [x.label FOR x IN t])), ',') AS labels, m / (m + {EVIDENCE})::DOUBLE AS score FROM f
"""


ORACLE = _oracle()
