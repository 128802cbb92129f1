"""License scans: template markup compiled into token automata.

A template is license wording with two marks: ``<<optional>> ... <</optional>>`` holds words that may
be left out, ``<<var name max>>`` stands for up to ``max`` words of any wording (a version, a name).
All other wording is mandatory: a place of a text is accepted only if its words match it exactly.
The templates (license_texts) are whole license texts, whole notices, and names. They are compiled together into one automaton over words whose states are sets of template
positions. A text is read once; only places where some template's first word stands are followed,
and words outside all templates lead to no state at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import read, worker_task
from gridloom.llm.license_texts import TEMPLATES

#: A-Z in lower case; bytes under 0x80 that are neither digits nor letters part words.
_FOLD = bytes(x if x >= 0x80 or 0x30 <= x <= 0x39 or 0x61 <= x <= 0x7A else x + 32 if 0x41 <= x <= 0x5A else 0x20 for x in range(256))

#: The base phrases and their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

_MARK = re.compile(r"<<(/?optional|var \w+ \d+)>>")


@dataclass
class Automaton:
    """Words lead from state to state; free has, by state, where any word leads; ends has, by state, the labels accepted there."""

    moves: list[dict[bytes, set[int]]] = field(default_factory=list)
    free: list[set[int]] = field(default_factory=list)
    skips: list[set[int]] = field(default_factory=list)
    ends: dict[int, str] = field(default_factory=dict)
    starts: set[int] = field(default_factory=set)

    def state(self) -> int:
        self.moves.append({})
        self.free.append(set())
        self.skips.append(set())
        return len(self.moves) - 1

    def add(self, label: str, markup: str) -> None:
        at = self.state()
        self.starts.add(at)
        open_at: list[int] = []
        for i, part in enumerate(_MARK.split(markup)):
            if i % 2 == 0:
                for word in fold(part).split():
                    to = self.state()
                    self.moves[at].setdefault(word, set()).add(to)
                    at = to
            elif part == "optional":
                open_at.append(at)
            elif part == "/optional":
                to = self.state()
                self.skips[at].add(to)
                self.skips[open_at.pop()].add(to)
                at = to
            else:
                end = self.state()
                for _ in range(int(part.split()[2])):
                    self.skips[at].add(end)
                    to = self.state()
                    self.free[at].add(to)
                    at = to
                self.skips[at].add(end)
                at = end
        if open_at:
            raise ValueError(f"{label}: an optional region isn't closed")
        self.ends[at] = label

    def closed(self, states: set[int]) -> frozenset[int]:
        found, work = set(states), list(states)
        while work:
            for to in self.skips[work.pop()] - found:
                found.add(to)
                work.append(to)
        return frozenset(found)


def each_template(templates: dict[str, str | tuple[str, ...]]) -> list[tuple[str, str]]:
    return [(label, markup) for label, found in templates.items() for markup in ((found,) if isinstance(found, str) else found)]


def fold(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD)


class Matcher:
    """Sets of automaton states, made as texts need them, behind a search for the first words."""

    def __init__(self, templates: dict[str, str | tuple[str, ...]], phrases: dict[str, str]) -> None:
        self.auto = Automaton()
        for label, markup in each_template(templates):
            self.auto.add(label, markup)
        self.start = self.auto.closed(self.auto.starts)
        if self.start & self.auto.ends.keys() or any(self.auto.free[x] for x in self.start):
            raise ValueError("a template must begin with mandatory or optional words")
        self.first = frozenset(w for x in self.start for w in self.auto.moves[x])
        self.steps: dict[tuple[frozenset[int], bytes], tuple[frozenset[int], tuple[str, ...]]] = {}
        self.known = frozenset(w for m in self.auto.moves for w in m)
        self.phrases = [(fold(p).split(), label) for p, label in phrases.items()]
        # A text without one of these words holds no template and no phrase; each is a rare word of one.
        self.signs = sorted({max(self.required(t), key=len) for _, t in each_template(templates)} | {max(p, key=len) for p, _ in self.phrases})

    @staticmethod
    def required(markup: str) -> list[bytes]:
        depth, words = 0, []
        for i, part in enumerate(_MARK.split(markup)):
            if i % 2:
                depth += {"optional": 1, "/optional": -1}.get(part, 0)
            elif not depth:
                words += fold(part).split()
        return words

    def step(self, states: frozenset[int], word: bytes) -> tuple[frozenset[int], tuple[str, ...]]:
        key = (states, word if word in self.known else b"")
        if key not in self.steps:
            to = set()
            for x in states:
                to |= self.auto.moves[x].get(word, set()) | self.auto.free[x]
            done = self.auto.closed(to)
            self.steps[key] = done, tuple(sorted({self.auto.ends[x] for x in done if x in self.auto.ends}))
        return self.steps[key]

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int, str]], list[tuple[int, int, str]]]:
        """Number of words; places (first word, last word, label) of the phrases; of the templates (each label's longest at a start)."""
        folded = fold(text or "")
        words = folded.split()
        if not any(x in folded for x in self.signs):
            return len(words), [], []
        base = []
        for phrase, label in self.phrases:
            at, size = -1, len(phrase)
            while True:
                try:
                    at = words.index(phrase[0], at + 1)
                except ValueError:
                    break
                if words[at : at + size] == phrase:
                    base.append((at, at + size - 1, label))
        found: dict[tuple[int, str], int] = {}
        for at, word in enumerate(words):
            if word not in self.first:
                continue
            states, i = self.start, at
            while states and i < len(words):
                states, labels = self.step(states, words[i])
                found |= {(at, x): i for x in labels}
                i += 1
        return len(words), base, [(at, to, label) for (at, label), to in found.items()]


@worker_task("licenses")
def _scan_batches(batches: Iterator[pa.RecordBatch], templates: dict[str, str | tuple[str, ...]], phrases: dict[str, str]) -> Iterator[pa.RecordBatch]:
    matcher = Matcher(templates, phrases)
    place = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("label", pa.string())]))
    pack = lambda x: [dict(zip(("first", "last", "label"), y, strict=True)) for y in x]
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            found = [matcher.scan(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([x[0] for x in found], pa.int64()), pa.array([pack(x[1]) for x in found], place), pa.array([pack(x[2]) for x in found], place)],
                ["doc_id", "n_words", "phrases", "templates"],
            )


def scan_licenses(docs: DataFrame, templates: dict[str, str | tuple[str, ...]] = TEMPLATES, phrases: dict[str, str] = BASE_PHRASES) -> DataFrame:
    """doc_id, n_words, phrases, templates for each row of docs (doc_id, text).

    phrases and templates are arrays of (first, last, label), places counted in words from 0. Null
    and empty texts have no words and no places; repeated rows give repeated results; other columns
    are ignored; an empty table gives an empty result. A text is scanned whole. Of a template's
    places with one start the longest is given; places of several templates may overlap, and all
    are given. There is no shuffle.
    """
    place = "array<struct<first: bigint, last: bigint, label: string>>"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(partial(_scan_batches, templates=templates, phrases=phrases), f"doc_id long, n_words long, phrases {place}, templates {place}")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score over the whole documents table.

    score is 1 if a template accepts a place, 0.5 if only a base phrase stands in the text, else 0.
    """
    found = scan_licenses(read(spark, sf_dir, "documents"))
    starts, base = F.transform("phrases", lambda x: x["first"]), F.transform("phrases", lambda x: x["label"])
    own = F.transform("templates", lambda x: x["label"])
    return found.select(
        "doc_id", "n_words", F.size("phrases").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"), F.array_join(F.array_sort(F.array_union(base, own)), ",").alias("labels"),
        F.when(F.size("templates") > 0, 1.0).when(F.size("phrases") > 0, 0.5).otherwise(0.0).alias("score"),
    )


def template_pattern(markup: str) -> str:
    """The same places as a regular expression over words with a space around each."""
    out = " "
    for i, part in enumerate(_MARK.split(markup)):
        if i % 2 == 0:
            out += "".join(f"{w.decode()} " for w in fold(part).split())
        else:
            out += {"optional": "(?:", "/optional": ")?"}.get(part) or f"(?:[^ ]+ ){{0,{part.split()[2]}}}"
    return out


def scan_sql() -> str:
    def places(phrase: str) -> str:
        words = phrase.split()
        same = " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(words))
        return f"list_filter(range(0, len(w) - {len(words) - 1}), lambda i: {same})"

    base = ", ".join(f"{places(p)} AS p{k}" for k, p in enumerate(BASE_PHRASES))
    n = range(len(BASE_PHRASES))
    named = " || ".join(f"CASE WHEN len(p{k}) > 0 THEN ['{label}'] ELSE [] END" for k, label in enumerate(BASE_PHRASES.values()))
    own = " || ".join("CASE WHEN " + " OR ".join(f"regexp_matches(t, '{template_pattern(m)}')" for m in found) + f" THEN ['{label}'] ELSE [] END" for label, found in TEMPLATES.items())
    every = " || ".join(f"p{k}" for k in n)
    return rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), found AS (SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS t, {base} FROM words),
named AS (SELECT doc_id, w, {every} AS places, {named} AS base, {own} AS own FROM found)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base, list_min(places) AS first_word, list_max(places) AS last_word,
       array_to_string(list_sort(base), ',') AS base_labels, array_to_string(list_sort(list_distinct(base || own)), ',') AS labels,
       CASE WHEN len(own) > 0 THEN CAST(1 AS DOUBLE) WHEN len(places) > 0 THEN 0.5 ELSE 0 END AS score
FROM named
"""


ORACLE_SQL = scan_sql()
