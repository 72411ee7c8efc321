"""License scans: template markup compiled to token automata, and the places of known phrases."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from eventmart.llm.common import texts

# fixed values: phrases and the label of each
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Markup: <<beginOptional>> ... <<endOptional>> may be left out; <<var;min=a;max=b>> stands for a to b words
# of any wording. Everything else is mandatory and must stand word for word.
TEMPLATES = {
    "gpl-3.0-notice": "<<beginOptional>>this <<var;min=1;max=3>> is<<endOptional>> licensed under the "
                      "<<beginOptional>>terms of the<<endOptional>> gnu general public license "
                      "<<beginOptional>>as published by the free software foundation<<endOptional>> version 3",
    "apache-2.0-notice": "licensed under the apache license version 2 0 <<beginOptional>>the license you may not use this "
                         "<<var;min=1;max=3>> except in compliance with the license<<endOptional>>",
    "cc-by-4.0-notice": "<<beginOptional>>this <<var;min=1;max=3>> is<<endOptional>> licensed under "
                        "<<beginOptional>>a<<endOptional>> cc by <<beginOptional>>international<<endOptional>> 4 0",
    "cc-by-nc-4.0-notice": "<<beginOptional>>this <<var;min=1;max=3>> is<<endOptional>> licensed under "
                           "<<beginOptional>>a<<endOptional>> cc by nc 4 0",
    "mit-notice": "<<var;min=1;max=1>> under the <<beginOptional>>terms of the<<endOptional>> mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                 "documentation files <<beginOptional>>the software<<endOptional>> to deal in the software without restriction",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that "
                 "the following conditions are met",
}

# how words are found: A-Z in lower case, everything that is not a letter, digit or beyond ASCII is a gap
NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


@dataclass
class Automaton:
    """A token automaton: `step[state]` lists (word or None for any word, next state); `skip` are empty moves."""

    step: list[list[tuple[bytes | None, int]]] = field(default_factory=lambda: [[]])
    skip: list[list[int]] = field(default_factory=lambda: [[]])
    final: int = 0
    run: bytes = b""  # the longest stretch of mandatory words, with a blank at both ends
    before: int = 0  # most words in a match, so also before that stretch

    def state(self) -> int:
        self.step.append([])
        self.skip.append([])
        return len(self.step) - 1

    def closure(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for t in self.skip[todo.pop()]:
                if t not in states:
                    states.add(t)
                    todo.append(t)
        return states

    def longest(self, words: list[bytes], start: int) -> int:
        """The end of the longest match that begins at word `start`, or -1."""
        now, end = self.closure({0}), -1
        for i in range(start, len(words) + 1):
            if self.final in now:
                end = i
            if i == len(words) or not now:
                break
            now = self.closure({t for s in now for w, t in self.step[s] if w is None or w == words[i]})
        return end


def compile_template(markup: str) -> Automaton:
    """The automaton of a template. Optional regions may be nested."""
    a = Automaton()
    at, opened, stretch, best = 0, [], [], []
    for piece in re.findall(r"<<.*?>>|[^<]+", markup):
        words = [] if piece.startswith("<<") else piece.encode().translate(NORMAL).split()
        stretch = words if words and not opened else []
        best = max(best, stretch, key=len)
        if piece == "<<beginOptional>>":
            opened.append(at)
        elif piece == "<<endOptional>>":
            a.skip[opened.pop()].append(at)
        elif piece.startswith("<<var"):
            low, high = (int(re.search(rf"{k}=(\d+)", piece)[1]) for k in ("min", "max"))
            early = []
            for n in range(high):
                if n >= low:
                    early.append(at)
                new = a.state()
                a.step[at].append((None, new))
                at = new
            for e in early:
                a.skip[e].append(at)
            a.before += high
        for w in words:
            new = a.state()
            a.step[at].append((w, new))
            at = new
        a.before += len(words)
    a.final, a.run = at, b" " + b" ".join(best) + b" "
    return a


def places(text: bytes, phrase: bytes) -> Iterator[int]:
    """Every start of a phrase in blank-separated words, overlapping ones too."""
    at = text.find(phrase)
    while at >= 0:
        yield at
        at = text.find(phrase, at + 1)


def template_places(normal: bytes, words: list[bytes], a: Automaton) -> list[tuple[int, int]]:
    """(first word, end) of the matches: from left to right, the earliest start with its longest end, none overlapping."""
    out, done, counted, at_byte = [], 0, 0, 0
    for at in places(normal, a.run):
        counted += normal.count(b" ", at_byte, at)
        at_byte = at
        for start in range(max(done, counted - a.before), counted + 1):
            if (end := a.longest(words, start)) > start and end > counted:
                out.append((start, end))
                done = end
                break
    return out


def scan(text: bytes, automata: dict[str, Automaton]) -> tuple[int, int, int | None, int | None, str, str, str, float]:
    words = text.translate(NORMAL).split()
    normal = b" " + b" ".join(words) + b" "
    n, first, last, base, covered, matches = 0, None, None, set(), [], []
    for phrase, label in PHRASES.items():
        word, counted_to = 0, 0
        for at in places(normal, b" %b " % phrase.encode()):
            word += normal.count(b" ", counted_to, at)
            counted_to = at
            n, first, last = n + 1, word if first is None else min(first, word), word if last is None else max(last, word)
            base.add(label)
            covered.append((word, word + phrase.count(" ") + 1))
    for label, a in automata.items():
        if a.run in normal:
            for start, end in template_places(normal, words, a):
                matches.append((start, end, label))
    covered += [m[:2] for m in matches]
    labels = base | {m[2] for m in matches}
    inside, end = 0, 0
    for a, b in sorted(covered):
        inside += max(0, b - max(a, end))
        end = max(end, b)
    spans = ";".join(f"{a}-{b}:{c}" for a, b, c in sorted(matches))
    return (len(words), n, first, last, ",".join(sorted(base)), ",".join(sorted(labels)), spans, inside / len(words) if words else 0.0)


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """Add n_words, n_base, first_word, last_word, base_labels, labels, template_spans and score to (text, ...).

    A template's label is given where its mandatory wording stands word for word, optional regions left
    out or whole, replaceable ones filled with as many words as they allow; `template_spans` lists
    these places as start-end:label. `score` is the share of the text's words in any place found.

    Null counts as empty: no words, no labels (empty text), score 0. Whole texts of any length are read;
    an automaton runs only where the longest stretch of its mandatory words occurs, which every match
    contains. Equal rows get equal results; columns of the same names are replaced.
    """
    automata = {label: compile_template(t) for label, t in (TEMPLATES if templates is None else templates).items()}
    added = {"n_words": "long", "n_base": "long", "first_word": "long", "last_word": "long", "base_labels": "string",
             "labels": "string", "template_spans": "string", "score": "double"}
    arrow = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    kept = [c for c in docs.columns if c not in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in texts(batches):
            if not found:
                continue
            new = [pa.array(x, arrow[k]) for x, k in zip(zip(*[scan(t, automata) for t in found]), added.values())]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in kept), *new], [*kept, *added])

    docs = docs.select(*[f"`{c}`" for c in kept])
    new = T.StructType.fromDDL(", ".join(f"{k} {v}" for k, v in added.items()))
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *new.fields]))
