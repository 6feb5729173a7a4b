"""License scans: phrases, and template-markup matching by token automata.

A template is the wording of a notice in lower-case words with two kinds of markup: [[words]] may be left out, and
<<n>> stands for up to n words of any kind, such as a name or a year. Everything else is mandatory and must occur
exactly. Each template is compiled to an automaton over words; a text has the template's label where the automaton
accepts some stretch of it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm import words
from rowsmith.llm.decontaminate import LETTERED

#: The base phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Wordings of common notices, by label.
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 [[0]] [[the license]]",
    "mit-notice": "[[this <<3>> is]] [[licensed]] [[released]] [[distributed]] under the [[terms of the]] mit license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "gpl-3.0": "licensed under the gnu general public license version 3 [[or [[at your option]] any later version]]",
    "gpl": "under the terms of the gnu general public license as published by the free software foundation",
    "lgpl": "under the terms of the gnu lesser general public license",
    "agpl-3.0": "licensed under the gnu affero general public license [[version 3]]",
    "bsd-text": "redistribution and use in source and binary forms with or without modification are permitted",
    "mpl-2.0": "subject to the terms of the mozilla public license [[v]] [[version]] 2 0",
    "cc-by-nc-4.0": "licensed under [[a]] cc by nc 4 0",
    "cc-by-4.0": "licensed under [[a]] cc by 4 0",
    "cc-by-sa-4.0": "licensed under [[a]] cc by sa 4 0",
    "cc0": "[[licensed]] under [[the]] cc0 [[1 0]] [[universal]]",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "all-rights-reserved": "copyright [[c]] <<4>> all rights reserved",
}


def hash_of(word: str) -> int:
    return int(words.word_hashes(*words.texts_of(pa.array([word])), LETTERED)[0][0])


@dataclass
class Automaton:
    """States are numbered; `steps` has the word transitions, `anything` those on any word, `free` those on none."""

    label: str
    steps: list[dict[int, int]] = field(default_factory=list)
    anything: list[list[int]] = field(default_factory=list)
    free: list[list[int]] = field(default_factory=list)
    mandatory: set[int] = field(default_factory=set)
    final: int = 0

    def state(self) -> int:
        self.steps.append({})
        self.anything.append([])
        self.free.append([])
        return len(self.steps) - 1

    def closure(self, states: set[int]) -> set[int]:
        todo, seen = list(states), set(states)
        while todo:
            for after in self.free[todo.pop()]:
                if after not in seen:
                    seen.add(after)
                    todo.append(after)
        return seen

    def accept(self, stream: list[int], at: int) -> int | None:
        """The end of the longest accepted stretch that begins at a word."""
        states, end = self.closure({0}), None
        while states:
            if self.final in states:
                end = at
            if at == len(stream):
                break
            word = stream[at]
            states = self.closure({self.steps[s][word] for s in states if word in self.steps[s]} | {t for s in states for t in self.anything[s]})
            at += 1
        return end


def compiled(label: str, template: str) -> Automaton:
    """The automaton of a template. Nothing may be left open, and some wording must be mandatory."""
    auto = Automaton(label)
    at = auto.state()
    opened = []
    for token in re.findall(r"\[\[|\]\]|<<\d+>>|[^\s\[\]<>]+", template):
        if token == "[[":
            opened.append(at)
        elif token == "]]":
            auto.free[opened.pop()].append(at)
        elif token.startswith("<<"):
            start = at
            for _ in range(int(token[2:-2])):
                after = auto.state()
                auto.anything[at].append(after)
                auto.free[start].append(after)
                at = after
        else:
            after = auto.state()
            auto.steps[at][hash_of(token)] = after
            if not opened:
                auto.mandatory.add(hash_of(token))
            at = after
    if opened or not auto.mandatory:
        raise ValueError(f"template {label} leaves a region open or has no mandatory wording")
    auto.final = at
    return auto


class Scanner:
    """Phrases and automata over the word hashes of a batch of texts."""

    def __init__(self, phrases: dict[str, str], templates: dict[str, str]):
        self.phrases = [(label, np.array([hash_of(w) for w in phrase.split()], np.uint64)) for phrase, label in phrases.items()]
        self.automata = [compiled(label, text) for label, text in templates.items()]
        self.vocabulary = np.array(sorted(set().union(*(a.mandatory for a in self.automata))), np.uint64)
        self.first = [{w for s in a.closure({0}) for w in a.steps[s]} for a in self.automata]

    def phrase_places(self, hashes: np.ndarray, row: np.ndarray) -> list[tuple[str, np.ndarray]]:
        """For each phrase, the words at which it begins."""
        out = []
        for label, phrase in self.phrases:
            rarest = len(phrase) - 1
            at = np.flatnonzero(hashes == phrase[rarest]) - rarest
            at = at[at >= 0]
            for i, word in enumerate(phrase):
                at = at[hashes[at + i] == word]
            out.append((label, at[row[at] == row[at + rarest]]))
        return out

    def spans(self, hashes: np.ndarray, before: np.ndarray, row: np.ndarray) -> dict[int, list[tuple[str, int, int]]]:
        """Accepted stretches (label, first word, word after) of the rows that have any. Only rows with all of a
        template's mandatory words are run through its automaton."""
        slot = np.searchsorted(self.vocabulary, hashes)
        slot = np.minimum(slot, len(self.vocabulary) - 1)
        known = np.flatnonzero(self.vocabulary[slot] == hashes)
        pairs = np.unique(row[known] * len(self.vocabulary) + slot[known])
        have: dict[int, set[int]] = {}
        for r, s in zip((pairs // len(self.vocabulary)).tolist(), (pairs % len(self.vocabulary)).tolist(), strict=True):
            have.setdefault(r, set()).add(int(self.vocabulary[s]))
        found: dict[int, list[tuple[str, int, int]]] = {}
        for r, has in have.items():
            stream = None
            for automaton, first in zip(self.automata, self.first, strict=True):
                if not automaton.mandatory <= has:
                    continue
                stream = hashes[before[r] : before[r + 1]].tolist() if stream is None else stream
                for at, word in enumerate(stream):
                    if word in first and (end := automaton.accept(stream, at)) is not None:
                        found.setdefault(r, []).append((automaton.label, at, end))
        return found


def scans(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans), one row per input row.

    n_base counts all places of all phrases, first_word and last_word are the smallest and largest of their starts
    (null without any). spans lists what templates accepted: label, first word, word after. Labels are lists, sorted
    and distinct. The score is 1 where a template accepts, one half where only phrases occur, else 0. Words are
    numbered from 0; A-Z are lower-cased.

    Null and empty texts have no words and no labels. Null and repeated doc_ids are rows like others. Other columns do
    not matter. Empty tables give no rows.
    """
    scanner = Scanner(phrases, templates)
    span = pa.struct([("label", pa.string()), ("first", pa.int64()), ("after", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in words.slices(whole):
                hashes, before = words.word_hashes(*words.texts_of(batch.column("text")), LETTERED)
                row = np.repeat(np.arange(batch.num_rows), np.diff(before))
                base: dict[int, list[tuple[str, int]]] = {}
                for label, places in scanner.phrase_places(hashes, row):
                    for at in places.tolist():
                        base.setdefault(int(row[at]), []).append((label, at - int(before[row[at]])))
                spans = scanner.spans(hashes, before, row)
                out = {"doc_id": batch.column("doc_id").to_pylist(), "n_words": np.diff(before).tolist()}
                hits = [base.get(r, []) for r in range(batch.num_rows)]
                more = [spans.get(r, []) for r in range(batch.num_rows)]
                out |= {"n_base": list(map(len, hits))}
                out |= {name: [f((at for _, at in h), default=None) for h in hits] for name, f in (("first_word", min), ("last_word", max))}
                out["base_labels"] = [sorted({label for label, _ in h}) for h in hits]
                out["labels"] = [sorted({label for label, *_ in [*h, *m]}) for h, m in zip(hits, more, strict=True)]
                out["score"] = [1.0 if m else 0.5 if h else 0.0 for h, m in zip(hits, more, strict=True)]
                out["spans"] = [[dict(zip(("label", "first", "after"), x, strict=True)) for x in m] for m in more]
                yield pa.RecordBatch.from_pydict(out, schema)

    numbers = [(name, pa.int64()) for name in ("doc_id", "n_words", "n_base", "first_word", "last_word")]
    lists = [("base_labels", pa.list_(pa.string())), ("labels", pa.list_(pa.string()))]
    schema = pa.schema([*numbers, *lists, ("score", pa.float64()), ("spans", pa.list_(span))])
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        task,
        "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels array<string>, "
        "labels array<string>, score double, spans array<struct<label:string, first:bigint, after:bigint>>",
    )
