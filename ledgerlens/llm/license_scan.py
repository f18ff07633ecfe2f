"""Operator 11: license scans by matching template markup.

A template is a license's wording with two kinds of markup: ``{{ ... }}`` may be left
out, ``<<n>>`` may be replaced by up to n words of any kind. All templates are compiled
into one token automaton (a state per word of wording, skips over optional regions, any
word inside a replaceable one), which reads a text word by word and accepts wherever a
template's mandatory wording stands exactly. Its deterministic form is built as far as
texts need it and forgotten when it outgrows ``MAX_STATES``.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_batches

#: A word, after A-Z are lower-cased: a run of digits, a-z and characters beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The base phrases and their labels, then license wording as published.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
TEMPLATES = {
    "mit-notice": "{{this <<4>> is}} released under the mit license",
    "mit-text": """
        permission is hereby granted free of charge to any person obtaining a copy of this software and associated
        documentation files {{the software}} to deal in the software without restriction including without limitation
        the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to
        permit persons to whom the software is furnished to do so subject to the following conditions the above
        copyright notice and this permission notice {{including the next paragraph}} shall be included in all copies
        or substantial portions of the software the software is provided as is without warranty of any kind express or
        implied including but not limited to the warranties of merchantability fitness for a particular purpose and
        noninfringement in no event shall <<8>> be liable for any claim damages or other liability whether in an
        action of contract tort or otherwise arising from out of or in connection with the software or the use or
        other dealings in the software""",
    "isc-text": """
        permission to use copy modify and or distribute this software for any purpose with or without fee is hereby
        granted provided that the above copyright notice and this permission notice appear in all copies the software
        is provided as is and <<8>> disclaims all warranties with regard to this software including all implied
        warranties of merchantability and fitness""",
    "bsd-text": """
        redistribution and use in source and binary forms with or without modification are permitted provided that the
        following conditions are met {{1}} redistributions of source code must retain the above copyright notice this
        list of conditions and the following disclaimer {{2}} redistributions in binary form must reproduce the above
        copyright notice this list of conditions and the following disclaimer in the documentation and or other
        materials provided with the distribution""",
    "bsd-no-endorsement": """
        neither the name of <<12>> nor the names of its contributors may be used to endorse or promote products derived
        from this software without specific prior written permission""",
    "zlib-text": """
        this software is provided as is without any express or implied warranty in no event will the authors be held
        liable for any damages arising from the use of this software permission is granted to anyone to use this
        software for any purpose including commercial applications and to alter it and redistribute it freely""",
    "apache-notice": "licensed under the apache license version <<1>> 0",
    "apache-text": """
        you may not use this file except in compliance with the license you may obtain a copy of the license at http www
        apache org licenses license 2 0""",
    "gpl-notice": "{{this <<4>> is}} licensed under the {{terms of the}} gnu {{lesser}} {{affero}} general public license",
    "gpl-text": """
        you can redistribute it and or modify it under the terms of the gnu {{lesser}} {{affero}} general public license
        as published by the free software foundation either version <<1>> of the license or at your option any later
        version""",
    "mpl-text": """
        this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not
        distributed with this file you can obtain one at {{https}} {{http}} mozilla org mpl 2 0""",
    "unlicense-text": """
        this is free and unencumbered software released into the public domain anyone is free to copy modify publish use
        compile sell or distribute this software""",
    "cc-by-notice": "licensed under {{a}} {{the}} {{creative commons}} {{attribution}} cc by <<3>> 0",
    "cc-by-nc": "cc by nc {{sa}} {{nd}} <<1>> 0",
    "spdx-line": "spdx license identifier",
}
MAX_STATES = 20_000
ANY = -2
_MARK = re.compile(r"\{\{|\}\}|<<(\d+)>>|" + TERM)
_WORD = re.compile(TERM)
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.encode("utf-8", "replace").translate(_LOWER).decode()) if text else []


class TokenAutomaton:
    """All templates at once; ``places`` lists what a text's words hold of them."""

    def __init__(self, templates: list[tuple[str, bool, str]]):
        self.templates = templates
        self.ids: dict[str, int] = {}
        self.arcs: list[int | None] = []        # by state: a word's id, ANY, or None at a template's end
        self.skips: dict[int, list[int]] = {}   # states that a state reaches without a word
        self.first, self.least, self.most, self.wording, self.end = [], [], [], [], {}
        for k, (_, _, text) in enumerate(templates):
            self._compile(k, text)
        self._start = frozenset(q for s in self.first for q in self._closed(s))
        self._sets: list[frozenset] = []
        self._index: dict[frozenset, int] = {}
        self.moves: list[dict[int, int]] = []
        self.accepts: list[list[int]] = []
        self._add(self._start)

    def _compile(self, k: int, text: str) -> None:
        self.first.append(len(self.arcs))
        opened, mandatory, gaps = [], 0, 0
        for m in _MARK.finditer(text):
            at = len(self.arcs)
            if m[0] == "{{":
                opened.append(at)
            elif m[0] == "}}":
                self.skips.setdefault(opened.pop(), []).append(at)
            elif m[1]:
                n = int(m[1])
                self.arcs += [ANY] * n
                for j in range(at, at + n):
                    self.skips.setdefault(j, []).append(at + n)
                gaps += n
            else:
                self.arcs.append(self.ids.setdefault(m[0], len(self.ids)))
                mandatory += not opened
        if opened or not mandatory:
            raise ValueError(f"template {self.templates[k][0]}: an optional region stays open, or no word is mandatory")
        self.end[len(self.arcs)] = k
        self.least.append(mandatory)
        self.most.append(len(self.arcs) - self.first[k])
        self.wording.append(mandatory)
        self.arcs.append(None)

    def _closed(self, state: int) -> set[int]:
        out, todo = {state}, [state]
        while todo:
            for q in self.skips.get(todo.pop(), ()):
                if q not in out:
                    out.add(q)
                    todo.append(q)
        return out

    def _after(self, states, word: int) -> set[int]:
        return {r for q in states if self.arcs[q] is not None and self.arcs[q] in (ANY, word) for r in self._closed(q + 1)}

    def _add(self, states: frozenset) -> int:
        if states not in self._index:
            self._index[states] = len(self._sets)
            self._sets.append(states)
            self.moves.append({})
            self.accepts.append(sorted(self.end[q] for q in states if q in self.end))
        return self._index[states]

    def _move(self, state: int, word: int) -> int:
        nxt = frozenset(self._after(self._sets[state], word) | self._start)
        if len(self._sets) >= MAX_STATES:       # forget all but the start; what is needed comes again
            self._index.clear()
            for x in (self._sets, self.moves, self.accepts):
                x.clear()
            self._add(self._start)
            return self._add(nxt)
        self.moves[state][word] = to = self._add(nxt)
        return to

    def _start_of(self, k: int, ids: list[int], end: int) -> int:
        """Where the longest place of template ``k`` that ends before word ``end`` starts."""
        for at in range(max(end - self.most[k], 0), end - self.least[k] + 1):
            states = self._closed(self.first[k])
            for w in ids[at:end]:
                states = self._after(states, w)
                if not states:
                    break
            if any(self.end.get(q) == k for q in states):
                return at
        raise AssertionError("an accepted place has a start")

    def places(self, words: list[str]) -> list[tuple[int, int, int]]:
        """(template, start, end) of every place: one per template and end, the longest;
        words are counted from 0, ``end`` is exclusive."""
        get, moves, accepts, state, out = self.ids.get, self.moves, self.accepts, 0, []
        ids = [get(w, -1) for w in words]
        for i, w in enumerate(ids):
            to = moves[state].get(w)
            state = self._move(state, w) if to is None else to
            for k in accepts[state]:
                out.append((k, self._start_of(k, ids, i + 1), i + 1))
        return out


def all_templates() -> list[tuple[str, bool, str]]:
    """(label, base, marked-up wording): base phrases are templates without markup."""
    return [*((label, True, phrase) for phrase, label in BASE.items()), *((label, False, text) for label, text in TEMPLATES.items())]


def license_places(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   templates: list[tuple[str, bool, str]] | None = None) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words`` and ``places``, an array of (label,
    base, start, end, wording): the words [start, end) that hold a template, and how many
    mandatory words it has; by end, then in the order of the templates.

    Whole texts; null and empty texts have no words and no places. Repeated rows and null
    ids keep a row each; an empty table gives an empty result; other columns are ignored.
    A text is read once, in time that grows with its length."""
    listed = all_templates() if templates is None else templates
    held: list[TokenAutomaton] = []     # a worker's own, filled by its first batch

    @F.pandas_udf("struct<n_words:long,places:array<struct<label:string,base:boolean,start:long,end:long,wording:long>>>")
    def scan(text: pd.Series) -> pd.DataFrame:
        if not held:
            held.append(TokenAutomaton(listed))
        n, out = np.zeros(len(text), np.int64), []
        for i, t in enumerate(text):
            words = words_of(t)
            n[i] = len(words)
            out.append([{"label": listed[k][0], "base": listed[k][1], "start": a, "end": b, "wording": held[0].wording[k]}
                        for k, a, b in held[0].places(words)])
        return pd.DataFrame({"n_words": n, "places": out})

    found = text_batches(docs).select(F.col(id_col), scan(F.col(text_col)).alias("found"))
    return found.select(F.col(id_col), "found.n_words", "found.places")


def digest_columns(places: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """n_words, n_base, first_word, last_word, base_labels, labels and score from
    ``license_places``. score: of the accepted template with the most mandatory words,
    their share of the text's words (0 without one)."""
    base = F.filter("places", lambda p: p["base"])

    def labels(x):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(x, lambda p: p["label"]))), ",")

    most = F.coalesce(F.array_max(F.transform("places", lambda p: p["wording"])), F.lit(0))
    return places.select(
        F.col(id_col), "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda p: p["start"])).alias("first_word"),
        F.array_max(F.transform(base, lambda p: p["start"])).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("places")).alias("labels"),
        F.when(F.col("n_words") > 0, most / F.col("n_words")).otherwise(0.0).alias("score"))


def _sql_pattern(text: str) -> str:
    """A template as a regular expression over words that a space follows each."""
    parts = {"{{": "(?:", "}}": ")?"}
    return "".join(parts.get(m[0]) or (f"(?:[^ ]+ ){{0,{m[1]}}}" if m[1] else f"{m[0]} ") for m in _MARK.finditer(text))


def oracle_sql() -> str:
    """DuckDB SQL: templates as regular expressions over the joined words, base places by
    comparing words."""
    places = []
    for phrase in BASE:
        ws = phrase.split()
        fits = " AND ".join(f"w[i + {j}] = '{x}'" for j, x in enumerate(ws))
        places.append(f"list_filter(range(1, len(w) + 1), lambda i: {fits})")
    kinds = [*((label, True, phrase) for phrase, label in BASE.items()), *((label, False, text) for label, text in TEMPLATES.items())]
    hits = ", ".join(f"CASE WHEN regexp_matches(s, ' {_sql_pattern(t)}') THEN '{label}' END" for label, _, t in kinds)
    depth = {label: sum(1 for m in _MARK.finditer(_mandatory(t)) if m[0] not in ("{{", "}}") and not m[1]) for label, _, t in kinds}
    basis = ", ".join(f"CASE WHEN len(list_filter(range(1, len(w) + 1), lambda i: {' AND '.join(f'w[i + {j}] = {chr(39)}{x}{chr(39)}' for j, x in enumerate(p.split()))})) > 0 THEN '{label}' END"
                      for p, label in BASE.items())
    most = " ".join(f"WHEN '{label}' THEN {n}" for label, n in depth.items())
    return f"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '{TERM}') AS w
  FROM documents),
u AS (
  SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS s,
         flatten([{', '.join(places)}]) AS p FROM t),
v AS (
  SELECT doc_id, w, p, list_filter([{basis}], lambda x: x IS NOT NULL) AS b, list_filter([{hits}], lambda x: x IS NOT NULL) AS h FROM u)
SELECT doc_id, len(w)::BIGINT AS n_words, len(p)::BIGINT AS n_base,
       (list_min(p) - 1)::BIGINT AS first_word, (list_max(p) - 1)::BIGINT AS last_word,
       array_to_string(list_sort(list_distinct(b)), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(h)), ',') AS labels,
       CASE WHEN len(w) > 0 THEN coalesce(list_max(list_transform(h, lambda x: CASE x {most} END)), 0) / len(w) ELSE 0.0 END::DOUBLE AS score
FROM v"""


def _mandatory(text: str) -> str:
    """A template's wording without its optional regions."""
    while "{{" in text:
        text = re.sub(r"\{\{(?:(?!\{\{).)*?\}\}", " ", text, flags=re.S)
    return text
