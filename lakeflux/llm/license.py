"""Licence scan: an Aho-Corasick automaton over words finds notice phrases and
identifier tags; a shunting-yard parser evaluates tagged licence expressions.

Words are maximal runs of digits, letters a-z (A-Z in lower case) and non-ASCII bytes.

Labels: those of the notice phrases, and ``spdx:<id>`` for each licence that a tag
``SPDX-License-Identifier:`` names in a well-formed expression (with its exception as
``spdx:<id> with <exception>``). The score is 0 without any label, 0.6 for notices
alone, 0.8 for several different ones, 1 for a well-formed tagged expression.

Defined results: a null text is empty (no words, no labels, score 0, null places); a
malformed expression adds nothing; a well-formed one of too many alternatives to spell out
adds its labels and, in place of them, itself as one entry; repeated rows get equal rows; an empty table gives
no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: phrases and their labels
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
MORE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "bsd license": "bsd",
    "mozilla public license": "mpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "public domain": "public-domain",
    "cc0": "cc0",
}
TAG = "spdx license identifier"

#: Products of alternatives beyond so many are not spelled out: the expression itself is reported, as one entry.
MOST_ALTERNATIVES = 256
_OPERATORS = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"\s*(?:([()])|([A-Za-z0-9][A-Za-z0-9.+:-]*))")
_TAG_TEXT = re.compile(r"spdx-license-identifier\s*:([^\n\r]*)", re.IGNORECASE)


class Parsed(NamedTuple):
    """A licence expression: its licences, its alternatives (None where they exceed MOST_ALTERNATIVES),
    and itself, written with as few brackets as it needs."""

    licences: frozenset[str]
    alternatives: frozenset[frozenset[str]] | None
    text: str
    top: str = ""  # the operator that binds last


def _joined(op: str, a: Parsed, b: Parsed) -> Parsed | None:
    """The expression of two operands; None where ``with`` does not join two single licences."""
    if op == "with":
        alone = all(x.alternatives is not None and len(x.alternatives) == 1 and len(x.licences) == 1 for x in (a, b))
        if not alone or " with " in next(iter(a.licences)):
            return None
        one = f"{next(iter(a.licences))} with {next(iter(b.licences))}"
        return Parsed(frozenset([one]), frozenset([frozenset([one])]), one)
    both = None
    if a.alternatives is not None and b.alternatives is not None:
        if op == "or":
            both = a.alternatives | b.alternatives
        elif len(a.alternatives) * len(b.alternatives) <= MOST_ALTERNATIVES:
            both = frozenset(x | y for x in a.alternatives for y in b.alternatives)
    parts = [f"({x.text})" if op == "and" and x.top == "or" else x.text for x in (a, b)]
    return Parsed(a.licences | b.licences, both, f" {op} ".join(parts), op)


def parse_tagged(text: str) -> Parsed | None:
    """A licence expression; None if malformed.

    Shunting-yard: ``with`` binds closest, then ``and``, then ``or``. Reading stops at the
    first character that no expression has (the end of a comment, say).
    """
    out: list[Parsed] = []
    ops: list[str] = []
    operand_next, at = True, 0

    def reduce() -> bool:
        op = ops.pop()
        if len(out) < 2:
            return False
        b, a = out.pop(), out.pop()
        if (one := _joined(op, a, b)) is None:
            return False
        out.append(one)
        return True

    while m := _TOKEN.match(text, at):
        word = (m[1] or m[2]).lower()
        if word == "(":
            if not operand_next:
                break
            ops.append(word)
        elif word == ")":
            if operand_next or "(" not in ops:
                break
            while ops[-1] != "(":
                if not reduce():
                    return None
            ops.pop()
        elif word in _OPERATORS:
            if operand_next:
                return None
            while ops and ops[-1] != "(" and _OPERATORS[ops[-1]] >= _OPERATORS[word]:
                if not reduce():
                    return None
            ops.append(word)
            operand_next = True
        else:
            if not operand_next:
                break  # prose goes on after the expression
            word = word.rstrip(".")
            out.append(Parsed(frozenset([word]), frozenset([frozenset([word])]), word))
            operand_next = False
        at = m.end()
    if operand_next:
        return None
    while ops:
        if ops[-1] == "(" or not reduce():
            return None
    return out[0] if len(out) == 1 else None


def parse_expression(text: str) -> frozenset[frozenset[str]] | None:
    """The alternatives of a licence expression, each the set of licences that hold together; None if
    it is malformed, or if they exceed MOST_ALTERNATIVES (parse_tagged has its licences then, too)."""
    found = parse_tagged(text)
    return None if found is None else found.alternatives


_KEEP = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_NORMAL = bytes((c + 32 if 65 <= c <= 90 else c) if (c + 32 if 65 <= c <= 90 else c) in _KEEP else 32 for c in range(256))


class Scanner:
    """The automaton over `` phrase `` with a space on either side, so that only whole words match."""

    def __init__(self, base: dict[str, str], more: dict[str, str]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for kind, phrases in (("base", base), ("more", more), ("tag", {TAG: ""})):
            for phrase, label in phrases.items():
                self.automaton.add_word(f" {phrase} ", (len(phrase) + 2, kind, label))
        self.automaton.make_automaton()

    def scan(self, text: str):
        """n_words, word places of base phrases, base labels, all labels, alternatives of tagged expressions."""
        found = text.encode("utf-8", "surrogatepass").translate(_NORMAL).decode("latin-1").split(" ")
        found = [w for w in found if w] if "" in found else found
        line = f" {' '.join(found)} "
        places, base, labels, alternatives, tagged = [], set(), set(), [], False
        seen = words = 0  # blanks before the place that was counted up to
        for end, (size, kind, label) in self.automaton.iter(line):
            if kind == "base":
                start = end - size + 1
                words += line.count(" ", seen, start) if start >= seen else -line.count(" ", start, seen)
                seen = start
                places.append(words)
                base.add(label)
            if kind == "tag":
                tagged = True
            else:
                labels.add(label)
        for m in _TAG_TEXT.finditer(text) if tagged else ():
            if (parsed := parse_tagged(m[1])) is not None:
                options = parsed.alternatives
                alternatives.append([parsed.text] if options is None else sorted(" and ".join(sorted(x)) for x in options))
                labels |= {f"spdx:{x}" for x in parsed.licences}
        return len(found), places, base, labels, alternatives


SCHEMA = (
    "doc_id long, n_words long, base_places array<long>, base_labels array<string>, labels array<string>, expressions array<array<string>>, score double"
)


def scan_licenses(docs: DataFrame, base: dict[str, str] | None = None, more: dict[str, str] | None = None) -> DataFrame:
    """One row a document: word count, places of the base phrases (in order), sorted labels,
    the alternatives of each tagged expression, and a score."""
    base, more = base or BASE_PHRASES, more if more is not None else MORE_PHRASES

    def run(batches):
        scanner = Scanner(base, more)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for lo in range(0, batch.num_rows, 1024):
                rows = []
                for doc_id, text in zip(ids[lo : lo + 1024].to_pylist(), texts[lo : lo + 1024].to_pylist()):
                    n, places, found, labels, options = scanner.scan(text or "")
                    score = 1.0 if options else 0.0 if not labels else 0.8 if len(labels) > 1 else 0.6
                    rows.append((doc_id, n, sorted(places), sorted(found), sorted(labels), options, score))
                kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.list_(pa.string())), pa.float64()]
                names = ["doc_id", "n_words", "base_places", "base_labels", "labels", "expressions", "score"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)
