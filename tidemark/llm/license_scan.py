r"""License scans by template markup: optional and replaceable regions compiled into token automata.

A template is license wording with two kinds of markup:

* ``<<beginOptional>> ... <<endOptional>>``  may be left out (may nest)
* ``<<var;name="...";match=".{0,N}">>``       any 0 to N words

Both sides are words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z,
so punctuation, quotes and line breaks never matter.  A template compiles to a
token automaton; it accepts a place of a text from which all mandatory words
follow exactly, with only the marked regions left out or replaced.  Optional
or replaceable regions at either end say nothing about a text that may go on
before and after, so they are trimmed.

Base labels come from fixed phrases (consecutive words); templates add theirs.
Score: 1.0 if a template accepts, else 0.9 with a base phrase, else 0.

Scale: map-only, one pass over whole texts; words are compared as 64-bit
hashes on whole blocks and the automata run only where a template's first two
mandatory words stand (a hot license line costs its own length).

Defined cases: a null or empty text has no words and no labels; rows are
independent, so repeated rows, null doc_ids and empty tables are no special
case; only doc_id and text are read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from . import _text as X

#: Phrase and label.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
BASE_SCORE = 0.9

_O, _C = "<<beginOptional>>", "<<endOptional>>"


def _var(name: str, most: int) -> str:
    return f'<<var;name="{name}";match=".{{0,{most}}}">>'


_AS_IS = """"AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES
OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."""
_BSD_HEAD = f"""Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: {_var("bullet1", 1)} Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. {_var("bullet2", 1)} Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""

#: (label, template); wording of the public license texts and their usual notices.
TEMPLATES = (
    ("mit", f"""{_O}Copyright {_var("holder", 20)}{_C} Permission is hereby granted, free of charge, to any person obtaining a copy of this software
and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom
the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice
{_O}(including the next paragraph){_C} shall be included in all copies or substantial portions of the Software."""),
    ("mit", f"{_O}Released{_C} {_O}licensed{_C} under the MIT license"),
    ("apache-2", f"""Licensed under the Apache License, Version 2.0 {_O}(the "License"); you may not use this file except in compliance with
the License.{_C}"""),
    ("gpl-3", f"""{_O}This {_var("work", 3)} is{_C} licensed under the {_O}terms of the{_C} GNU General Public License
{_O}as published by the Free Software Foundation{_C} {_O}either{_C} version 3 {_O}of the License{_C} {_O}or (at your option) any later version{_C}"""),
    ("gpl-3", f"""redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software
Foundation, either version 3 of the License, or {_O}(at your option){_C} any later version"""),
    ("cc-by-nc", f"""Licensed under {_O}a{_C} {_O}the{_C} {_O}Creative Commons{_C} {_O}license{_C} CC BY-NC {_O}4.0{_C}"""),
    ("cc-by-nc", f"""Creative Commons Attribution-NonCommercial {_var("version", 2)} {_O}International{_C} License"""),
    ("bsd-2", f"""{_BSD_HEAD} THIS SOFTWARE IS PROVIDED BY {_var("holder", 12)} {_AS_IS}"""),
    ("bsd-3", f"""{_BSD_HEAD} {_var("bullet3", 1)} Neither the name of {_var("holder", 12)} nor the names of its contributors may be used to endorse
or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY {_var("holder2", 12)} {_AS_IS}"""),
    ("isc", f"""Permission to use, copy, modify, and{_O}/or{_C} distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies."""),
)
_TAG = re.compile(r'<<(beginOptional|endOptional|var;name="[^"]*";match="\.\{0,(\d+)\}")>>')
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))


def word_hashes(words: list[str]) -> list[int]:
    data = " ".join(words).encode()
    raw = np.frombuffer(data, np.uint8)
    starts, ends, _ = X.span_words(raw, np.array([0, len(raw)]), X.PLAIN)
    return X.span_hash(X.prefix_hash(raw), starts, ends).tolist()


@dataclass(frozen=True)
class Automaton:
    """step[s]: word hash -> next state; skip[s]: states reached without a word; some[s]: next state on any word (else -1)."""

    label: str
    first: tuple[int, ...]
    step: tuple[dict[int, int], ...]
    skip: tuple[tuple[int, ...], ...]
    some: tuple[int, ...]

    def closure(self, states: set[int]) -> set[int]:
        todo, out = list(states), set(states)
        while todo:
            for s in self.skip[todo.pop()]:
                if s not in out:
                    out.add(s)
                    todo.append(s)
        return out

    def accepts(self, hashes: np.ndarray, at: int, end: int) -> bool:
        """Whether the template's wording begins at word ``at`` of a document that ends before ``end``."""
        final, now = len(self.step) - 1, self.closure({0})
        while now and final not in now and at < end:
            h, nxt = int(hashes[at]), set()
            for s in now:
                if h in self.step[s]:
                    nxt.add(self.step[s][h])
                if self.some[s] >= 0:
                    nxt.add(self.some[s])
            now, at = self.closure(nxt), at + 1
        return final in now


def compile_template(label: str, template: str) -> Automaton:
    """Automaton of a template; ValueError for unbalanced markup or a template without mandatory words."""
    parts: list[tuple[str, object]] = []
    last = 0
    for tag in _TAG.finditer(template):
        parts += [("word", w) for w in words_of(template[last : tag.start()])]
        last = tag.end()
        parts.append(("any", int(tag[2])) if tag[2] else ("open" if tag[1].startswith("begin") else "close", None))
    parts += [("word", w) for w in words_of(template[last:])]
    depth, mandatory = 0, []
    for i, (kind, _) in enumerate(parts):
        depth += (kind == "open") - (kind == "close")
        if depth < 0:
            raise ValueError(f"{label}: endOptional without beginOptional")
        if kind == "word" and depth == 0:
            mandatory.append(i)
    if depth or not mandatory:
        raise ValueError(f"{label}: unbalanced markup, or no mandatory word")
    parts = parts[mandatory[0] : mandatory[-1] + 1]
    step: list[dict[int, int]] = [{}]
    skip: list[list[int]] = [[]]
    some = [-1]

    def state() -> int:
        step.append({}), skip.append([]), some.append(-1)
        return len(step) - 1

    here, opened = 0, []
    for kind, value in parts:
        if kind == "word":
            nxt = state()
            step[here][word_hashes([value])[0]] = nxt
            here = nxt
        elif kind == "any":
            reached = [here]
            for _ in range(value):
                nxt = state()
                some[here] = nxt
                here = nxt
                reached.append(here)
            end = state()
            for s in reached:
                skip[s].append(end)
            here = end
        elif kind == "open":
            begin = state()
            skip[here].append(begin)
            opened.append(begin)
            here = begin
        else:
            end, begin = state(), opened.pop()
            skip[here].append(end)
            skip[begin].append(end)
            here = end
    words = [v for k, v in parts[:2] if k == "word"]
    return Automaton(label, tuple(word_hashes(words)), tuple(step), tuple(map(tuple, skip)), tuple(some))


def scanner(templates=TEMPLATES, phrases=PHRASES):
    """Function of a text block giving n_words, n_base, first_word, last_word, base_labels, labels and score."""
    automata = [compile_template(*t) for t in templates]
    fixed = [(word_hashes(p.split()), label) for p, label in phrases]

    def places(h: np.ndarray, doc: np.ndarray, wanted) -> np.ndarray:
        n = len(h) - len(wanted) + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        at = np.flatnonzero(h[:n] == np.uint64(wanted[0]))
        for j, w in enumerate(wanted):
            at = at[h[at + j] == np.uint64(w)]
        return at[doc[at] == doc[at + len(wanted) - 1]]

    def scan(raw: np.ndarray, offsets: np.ndarray) -> list:
        docs = len(offsets) - 1
        raw = X.LOWER[raw]
        starts, ends, doc = X.span_words(raw, offsets, X.PLAIN)
        h = X.span_hash(X.prefix_hash(raw), starts, ends)
        n_words = np.bincount(doc, minlength=docs)
        begin = np.searchsorted(doc, np.arange(docs))
        n_base = np.zeros(docs, np.int64)
        first: list = [None] * docs
        last: list = [None] * docs
        base: list[set] = [set() for _ in range(docs)]
        found: list[set] = [set() for _ in range(docs)]
        for wanted, label in fixed:
            for at in places(h, doc, wanted).tolist():
                d = int(doc[at])
                word = at - int(begin[d])
                n_base[d] += 1
                first[d] = word if first[d] is None else min(first[d], word)
                last[d] = word if last[d] is None else max(last[d], word)
                base[d].add(label)
        for a in automata:
            for at in places(h, doc, a.first).tolist():
                d = int(doc[at])
                if a.label not in found[d] and a.accepts(h, at, int(begin[d] + n_words[d])):
                    found[d].add(a.label)
        score = [1.0 if f else BASE_SCORE if b else 0.0 for f, b in zip(found, base, strict=True)]
        join = lambda s: ",".join(sorted(s))
        return [n_words, n_base, first, last, list(map(join, base)), [join(b | f) for b, f in zip(base, found, strict=True)], score]

    return scan


FIELDS = T.StructType([T.StructField(n, T.LongType()) for n in ("n_words", "n_base", "first_word", "last_word")]
                      + [T.StructField(n, T.StringType()) for n in ("base_labels", "labels")] + [T.StructField("score", T.DoubleType())])


def licenses(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """Places and labels of license wording in every row of ``docs``."""
    return X.map_text(docs, "text", ["doc_id"], FIELDS, "found", lambda: scanner(templates, phrases)).select("doc_id", "found.*")
