"""Licence scans: Aho-Corasick over identifier tags and notice phrases, and a shunting-yard
evaluation of licence expressions with AND, OR and WITH."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quarry.llm.common import WORD_BYTE, byte_texts, column_type, lower_ascii, map_arrow, slices, to_words, word_bounds

#: Phrase -> label, unless a caller names others. Words are those of :func:`to_words`.
BASE_PHRASES = {
    "the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Further notice phrases of the method -> label.
NOTICE_PHRASES = {
    "mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "apache license 2 0": "apache-2",
    "apache 2 0 license": "apache-2",
    "gnu general public license version 3": "gpl-3",
    "gnu general public license version 2": "gpl-2",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl-3",
    "mozilla public license version 2": "mpl-2",
    "redistribution and use in source and binary forms": "bsd",
    "bsd 3 clause": "bsd-3-clause",
    "bsd 2 clause": "bsd-2-clause",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "cc by sa": "cc-by-sa",
    "cc0 1 0": "cc0",
    "public domain": "public-domain",
    "all rights reserved": "proprietary",
}
#: Words that introduce a licence expression.
TAG = "spdx license identifier"
#: SPDX identifiers (lower case) -> label.
IDENTIFIERS = {
    "mit": "mit", "apache-2.0": "apache-2", "gpl-2.0": "gpl-2", "gpl-2.0-only": "gpl-2",
    "gpl-2.0-or-later": "gpl-2", "gpl-3.0": "gpl-3", "gpl-3.0-only": "gpl-3", "gpl-3.0-or-later": "gpl-3",
    "lgpl-2.1": "lgpl", "lgpl-2.1-or-later": "lgpl", "lgpl-3.0": "lgpl", "agpl-3.0": "agpl-3",
    "agpl-3.0-only": "agpl-3", "mpl-2.0": "mpl-2", "bsd-2-clause": "bsd-2-clause",
    "bsd-3-clause": "bsd-3-clause", "isc": "isc", "cc0-1.0": "cc0", "cc-by-4.0": "cc-by",
    "cc-by-sa-4.0": "cc-by-sa", "cc-by-nc-4.0": "cc-by-nc", "unlicense": "public-domain",
}
#: Labels under which a text may be used without further conditions on the result.
PERMISSIVE = frozenset({"mit", "apache-2", "bsd", "bsd-2-clause", "bsd-3-clause", "isc", "cc0", "cc-by",
                        "public-domain"})
#: Exceptions that lift a copyleft licence's reach over linked or generated works.
LIFTING = frozenset({"classpath-exception-2.0", "gcc-exception-3.1", "llvm-exception",
                     "autoconf-exception-3.0", "bison-exception-2.2"})

_TOKEN = re.compile(rb"[A-Za-z0-9.+-]+|[()\n]")
_RANK = {"or": 1, "and": 2, "with": 3}


def normalised(text: bytes) -> bytes:
    """The words of a text joined by one space."""
    return b" ".join(to_words(text))


@dataclass(frozen=True)
class Expression:
    """The value of a licence expression: labels named, and whether a choice of its
    alternatives is permissive."""

    labels: frozenset[str]
    permissive: bool


def to_postfix(text: bytes, start: int = 0) -> list[str]:
    """Shunting yard: WITH binds before AND before OR; reading stops where the grammar ends. A line's
    end ends the expression, but not one that is open: before its first name, behind an
    operator, or within parentheses; another tag always does."""
    out: list[str] = []
    stack: list[str] = []
    operand = True
    for token in (m[0] for m in _TOKEN.finditer(text, start)):
        low = token.lower().decode()
        if low == "\n":
            if operand or "(" in stack:
                continue
            break
        if low == TAG.replace(" ", "-"):  # the next one's
            break
        if low in _RANK and not operand:
            while stack and stack[-1] != "(" and _RANK[stack[-1]] >= _RANK[low]:
                out.append(stack.pop())
            stack.append(low)
            operand = True
        elif low == "(" and operand:
            stack.append(low)
        elif low == ")" and not operand and "(" in stack:
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
        elif operand and low not in _RANK and low not in "()":
            out.append(low)
            operand = False
        else:
            break
    while operand and stack and stack[-1] in _RANK:  # an operator without its right side
        stack.pop()
        operand = False
    out += [s for s in reversed(stack) if s != "("]
    return out


def evaluate(text: str | bytes, start: int = 0) -> Expression | None:
    """The expression at ``start`` of ``text``; None if there is none. An unknown identifier is a
    label of its own and not permissive; ``X WITH e`` has the label of X."""
    stack: list[Expression] = []
    names: list[str] = []
    for token in to_postfix(text.encode() if isinstance(text, str) else text, start):
        if token not in _RANK:
            label = IDENTIFIERS.get(token.rstrip("+."), token.rstrip("."))
            stack.append(Expression(frozenset({label}), label in PERMISSIVE))
            names.append(token)
            continue
        if len(stack) < 2:
            return None
        right, left = stack.pop(), stack.pop()
        if token == "with":
            exception = names[-1].rstrip(".")
            stack.append(Expression(left.labels, left.permissive or exception in LIFTING))
        elif token == "and":
            stack.append(Expression(left.labels | right.labels, left.permissive and right.permissive))
        else:
            stack.append(Expression(left.labels | right.labels, left.permissive or right.permissive))
    return stack[-1] if stack else None


class Scanner:
    """Aho-Corasick automaton over all phrases and the tag, with word borders."""

    def __init__(self, base: Mapping[str, str] = BASE_PHRASES) -> None:
        import ahocorasick

        self.base = base
        self.automaton = ahocorasick.Automaton()
        for phrase, label in {**NOTICE_PHRASES, **base, TAG: ""}.items():
            self.automaton.add_word(f" {phrase} ", (phrase, label))
        self.automaton.make_automaton()

    def scan(self, text: bytes) -> tuple:
        words = normalised(text)
        if not words:
            return 0, 0, None, None, "", "", 0.0, None, 0
        n_words = words.count(b" ") + 1
        base: set[str] = set()
        found: set[str] = set()
        starts: list[int] = []
        weight = 0.0
        tags: list[int] = []
        for end, (phrase, label) in self.automaton.iter(f" {words.decode('latin-1')} "):
            if phrase == TAG:
                tags.append(words.count(b" ", 0, end - 1))  # words up to the tag's last one
                continue
            found.add(label)
            weight = max(weight, 0.6)
            if phrase in self.base:
                base.add(label)
                weight = 0.9
                starts.append(end - len(phrase) - 1)
        values = [v for v in (evaluate(text, at) for at in self.behind(text, tags)) if v]
        for value in values:
            found |= value.labels
            weight = 1.0
        first = last = None
        if starts:  # positions in the padded text; the words before are counted
            first, last = (words.count(b" ", 0, p) for p in (min(starts), max(starts)))
        allowed = all(v.permissive for v in values) if values else all(x in PERMISSIVE for x in found) if found else None
        return (n_words, len(starts), first, last, ",".join(sorted(base)), ",".join(sorted(found)), weight,
                allowed, len(values))

    @staticmethod
    def behind(text: bytes, tags: list[int]) -> list[int]:
        """Where the text goes on behind its words of the given numbers."""
        if not tags:
            return []
        ends = word_bounds(np.frombuffer(lower_ascii(text), np.uint8), WORD_BYTE)[1]
        return [int(ends[n]) for n in tags]


_SCHEMA = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
           "score double, permissive boolean, n_expressions long")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                  base: Mapping[str, str] = BASE_PHRASES) -> DataFrame:
    """One row per row of ``docs``: its id (null kept), word and phrase counts, labels and a score.

    ``base`` has the base phrases, lower-case words joined by one space, and their labels.
    ``n_base`` counts all places of these phrases, overlapping ones included; ``first_word``
    and ``last_word`` are the smallest and largest of their starts (words from 0), else null.
    ``labels`` adds notice phrases and the identifiers of tagged expressions. ``score`` is the
    strongest evidence: 1.0 an evaluated expression, 0.9 a base phrase, 0.6 another notice, 0.0
    none. ``permissive`` is the expressions' value (all of them), without any the phrases', and
    null if nothing was found. Null and empty texts have no words and score 0. Whole texts are
    read; memory is bounded by one text. Repeated rows are judged each; other columns are unused.
    """
    def run(batches):
        scanner = Scanner(base)
        for batch in slices(batches):
            rows = [scanner.scan(t) for t in byte_texts(batch, text)]
            cols = list(zip(*rows)) if rows else [()] * 9
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.bool_(), pa.int64()]
            made = [pa.array(c, t) for c, t in zip(cols, types)]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), *made], names=names)

    names = [id_col, *[p.split()[0] for p in _SCHEMA.split(", ")]]
    kind = column_type(docs, id_col)
    return map_arrow(docs.select(id_col, text), run, f"{id_col} {kind}, {_SCHEMA}")

