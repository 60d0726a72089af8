"""Licence scans: an Aho-Corasick automaton finds notice phrases and identifier tags in one pass over the words of
a text; a shunting-yard parser evaluates the tags' and/or/with expressions.

Words are runs of digits, letters a-z (A-Z are lower-cased) and characters beyond ASCII. Phrases match where their
words stand consecutively, whatever separates them. Bytes above 0x7F only occur inside characters beyond ASCII,
so words are found in the UTF-8 bytes without decoding."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import batch_of, modest_batches, rows_of

#: Phrases that the contract fixes, and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Further notice phrases.
NOTICE_PHRASES = {
    "licensed under cc by nc": "cc-by-nc",
    "licensed under cc by sa": "cc-by-sa",
    "licensed under cc by": "cc-by",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "apache license version 2 0": "apache-2.0",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd 2 clause license": "bsd-2-clause",
    "bsd 3 clause license": "bsd-3-clause",
    "isc license": "isc",
    "boost software license": "bsl-1.0",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "all rights reserved": "all-rights-reserved",
}
#: Words after which an identifier expression stands, up to the line's end.
TAG = "spdx license identifier"
_TAG_LINE = re.compile(rb"spdx-license-identifier\s*:[ \t]*([^\r\n]*)", re.I)
#: Licences whose terms allow reuse; an expression is permitted if it can be met with these alone.
PERMISSIVE = frozenset({"mit", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "isc", "bsl-1.0", "cc0-1.0", "cc-by-4.0", "zlib", "unlicense"})
_FOLD = bytes((c + 32 if 65 <= c <= 90 else c) if (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128) else 32 for c in range(256))
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"\(|\)|[A-Za-z0-9.+:-]+")

SCHEMA = pa.schema(
    [("_key", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64())]
    + [("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("n_tags", pa.int64()), ("n_bad_tags", pa.int64()), ("permitted", pa.bool_())]
)


def folded(text: bytes) -> list[bytes]:
    """The words of a text in UTF-8."""
    return text.translate(_FOLD).split()


@dataclass(frozen=True)
class Expression:
    """names: the licences named, lower-cased, 'x with y' for exceptions. postfix: names, and 'and' and 'or' after their operands."""

    names: frozenset[str] = frozenset()
    postfix: tuple[str, ...] = ()

    def permitted(self, allowed: Iterable[str]) -> bool:
        have = frozenset(allowed)
        met: list[bool] = []
        for x in self.postfix:
            if x in ("and", "or"):
                b, a = met.pop(), met.pop()
                met.append(a and b if x == "and" else a or b)
            else:
                met.append(x.partition(" with ")[0].removesuffix("+") in have)
        return bool(met) and met[0]

    @property
    def alternatives(self) -> frozenset[frozenset[str]]:
        """The sets that each satisfy it; they can double with each 'and', and no scan expands them."""
        sets: list[frozenset[frozenset[str]]] = []
        for x in self.postfix:
            if x in ("and", "or"):
                b, a = sets.pop(), sets.pop()
                sets.append(frozenset(y | z for y in a for z in b) if x == "and" else a | b)
            else:
                sets.append(frozenset({frozenset({x})}))
        return sets[0] if sets else frozenset()


def parse(text: str) -> Expression:
    """Evaluates a licence expression: with binds before and, and before or, parentheses before all; operators in any
    case. Raises ValueError where it isn't well formed."""
    postfix: list[str] = []
    operands: list[tuple[str | None, int]] = []  # the one name of each, null for several, and its place in postfix
    operators: list[str] = []

    def apply(op: str) -> None:
        if len(operands) < 2:
            raise ValueError("an operator lacks an operand")
        (b, _), (a, start) = operands.pop(), operands.pop()
        if op == "with":
            if a is None or b is None or " with " in a or " with " in b:
                raise ValueError("with joins a licence and an exception")
            name = f"{a} with {b}"
            postfix[start:] = [name]
            operands.append((name, start))
        else:
            postfix.append(op)
            operands.append((a if a == b else None, start))

    text, end, wants = text.strip(), 0, True  # wants: an operand comes next
    for m in _TOKEN.finditer(text):
        if text[end : m.start()].strip():
            raise ValueError("an unknown character")
        end, token = m.end(), m[0].lower()
        if token == "(":
            if not wants:
                raise ValueError("an operator is missing")
            operators.append(token)
        elif token == ")":
            if wants:
                raise ValueError("an operand is missing")
            while operators and operators[-1] != "(":
                apply(operators.pop())
            if not operators:
                raise ValueError("a parenthesis isn't open")
            operators.pop()
        elif token in _PRECEDENCE:
            if wants:
                raise ValueError("an operand is missing")
            while operators and operators[-1] != "(" and _PRECEDENCE[operators[-1]] >= _PRECEDENCE[token]:
                apply(operators.pop())
            operators.append(token)
            wants = True
        else:
            if not wants:
                raise ValueError("an operator is missing")
            operands.append((token, len(postfix)))
            postfix.append(token)
            wants = False
    if wants or text[end:].strip():
        raise ValueError("an operand is missing" if wants else "an unknown character")
    while operators:
        if operators[-1] == "(":
            raise ValueError("a parenthesis isn't closed")
        apply(operators.pop())
    return Expression(frozenset(postfix) - {"and", "or"}, tuple(postfix))


def tag_value(line: str) -> str:
    """A tag's line without the comment sign, or the run of equal quotes or hashes, that may close it. Linear in the line."""
    line = line.strip()
    for sign in ("*/", "-->", "*)"):
        if line.endswith(sign):
            return line[: -len(sign)].rstrip()
    return line.rstrip(line[-1]).rstrip() if line[-1:] in ("#", '"', "'") else line


class Scanner:
    """phrases: words joined by single spaces -> (label, whether it counts as base)."""

    def __init__(self, phrases: Mapping[str, tuple[str, bool]], allowed: Iterable[str] = PERMISSIVE):
        self.automaton, self.allowed = ahocorasick.Automaton(), frozenset(allowed)
        for phrase, (label, base) in {**phrases, TAG: ("", False)}.items():
            words = b" ".join(folded(phrase.encode())).decode()
            self.automaton.add_word(f" {words} ", (len(words.split(" ")), label, base, phrase == TAG))
        self.automaton.make_automaton()

    def scan(self, text: bytes) -> tuple:
        """A row of SCHEMA without its key."""
        words = folded(text)
        line = " " + b" ".join(words).decode() + " "
        n_base = n_other = seen = at = tags = bad = 0
        first = last = None
        base: set[str] = set()
        labels: set[str] = set()
        permitted = None
        for end, (n, label, counts, tag) in self.automaton.iter(line):
            seen, at = seen + line.count(" ", at, end + 1), end + 1  # spaces up to here: one before each word and this one
            if tag:
                tags += 1
                continue
            if counts:
                start = seen - 1 - n
                n_base += 1
                base.add(label)
                first = start if first is None else min(first, start)
                last = start if last is None else max(last, start)
            else:
                n_other += 1
            labels.add(label)
        if tags:
            tags, bad, names, permitted = self.tags(text)
            labels |= names
        weight = n_base + n_other + 2 * (tags - bad)
        return len(words), n_base, first, last, ",".join(sorted(base)), ",".join(sorted(labels | base)), 1.0 - 0.5 ** min(weight, 60), tags, bad, permitted

    def tags(self, text: bytes) -> tuple[int, int, set[str], bool | None]:
        tags = bad = 0
        names: set[str] = set()
        permitted = None
        for m in _TAG_LINE.finditer(text):
            tags += 1
            try:
                found = parse(tag_value(m[1].decode("utf-8", "replace")))
            except ValueError:
                bad += 1
                continue
            names |= found.names
            permitted = found.permitted(self.allowed) and permitted is not False
        return tags, bad, names, permitted


@lru_cache(maxsize=4)
def _scanner(phrases: tuple, allowed: frozenset) -> Scanner:
    return Scanner({p: (label, base) for p, label, base in phrases}, allowed)


def scan(docs: DataFrame, base: Mapping[str, str] = BASE_PHRASES, notices: Mapping[str, str] = NOTICE_PHRASES, allowed: Iterable[str] = PERMISSIVE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of docs: doc_id, n_words, n_base (all places of base phrases), first_word, last_word (smallest and
    largest start of one, else null), base_labels, labels (base, notice and tag labels; distinct, sorted by code point,
    comma-joined), score (1 - 2^-evidence, a valid tag counting twice), n_tags, n_bad_tags (not well formed) and
    permitted (null without a valid tag; else whether every valid tag can be met with allowed licences).

    Null text: empty, so no words and score 0. Null ids stay null, repeated rows stay. Other columns aren't read. One
    pass in the order of the input, no shuffle; a task holds a few hundred texts at a time."""
    phrases = tuple((p, label, True) for p, label in base.items()) + tuple((p, label, False) for p, label in notices.items() if p not in base)
    allowed = frozenset(allowed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(phrases, allowed)
        for b in rows_of(batches, 256):
            found = [scanner.scan(t or b"") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, type=f.type) for c, f in zip(zip(*found), list(SCHEMA)[1:], strict=True))], names=SCHEMA.names)

    slim = modest_batches(docs).select(F.col(id_col).cast("long").alias("_key"), F.col(text_col).cast("binary").alias("_text"))
    kinds = {pa.int64(): "long", pa.string(): "string", pa.float64(): "double", pa.bool_(): "boolean"}
    return slim.mapInArrow(run, ", ".join(f"{f.name} {kinds[f.type]}" for f in SCHEMA)).withColumnRenamed("_key", id_col)
