"""Licence scans: notices and expressions in whole texts.

One Aho-Corasick automaton over word sequences finds, in one pass, the notice
phrases (``NOTICES``) and the tags after which an expression stands (``TAGS``).
A text is lower-cased (A-Z) and its words are joined by single blanks first, so
a phrase matches whatever stands between its words; phrases may overlap.

After a tag the raw text is read as a licence expression, to the first token
that does not fit: identifiers (``IDENTIFIERS``, or one that starts with
"licenseref-"), AND, OR, WITH and an exception name, and parentheses. A
shunting-yard parser turns it into postfix order (WITH binds closest, then
AND, then OR) and evaluates it: AND asks for everything both sides ask for, OR
leaves the choice of the side that asks for less, an exception takes a strong
copyleft down to a weak one. What is left open at the end is closed; an
operator without a right side is ignored.

Labels are those of the notices and of every identifier in an expression. The
score is how much the text asks of whoever uses it: the largest value
(``ASKS``) of a notice or an evaluated expression, 0 where there is none.

A null or empty text has no words and no labels. Each row is judged alone, so
repeated rows, null and repeated doc_ids get their own text's result; equal
places count once per phrase. Very long texts are scanned whole. Extra columns
are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .sequences import words
from .tables import bounded_batches, texts

# fixed values: the phrases whose places are counted, with their labels
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# fixed values: further notices and their labels
NOTICES = {
    "affero general public license": "agpl",
    "apache license": "apache",
    "artistic license": "artistic",
    "boost software license": "bsl",
    "bsd license": "bsd",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "cc0": "cc0",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "eclipse public license": "epl",
    "european union public licence": "eupl",
    "isc license": "isc",
    "lesser general public license": "lgpl",
    "library general public license": "lgpl",
    "mit license": "mit",
    "mozilla public license": "mpl",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "released into the public domain": "public-domain",
    "this is free and unencumbered software": "unlicense",
    "unlicense": "unlicense",
    "zlib license": "zlib",
}
# fixed values: what stands before an expression, and what must follow the tag's words
TAGS = {"spdx license identifier": b":", "license": b":", "licence": b":", "licensed under": b"", "licensed under the": b"",
        "released under": b"", "released under the": b"", "distributed under": b"", "distributed under the": b""}
# fixed values: how much each label asks for, from nothing to permission for any use
ASKS = {
    "public-domain": 0.05, "cc0": 0.05, "unlicense": 0.05,
    "mit": 0.2, "bsd": 0.2, "isc": 0.2, "zlib": 0.2, "bsl": 0.2,
    "apache": 0.3, "artistic": 0.3, "cc-by": 0.3,
    "mpl": 0.5, "epl": 0.5, "lgpl": 0.5, "eupl": 0.5,
    "cc-by-sa": 0.6, "gpl": 0.8, "agpl": 0.9,
    "cc-by-nd": 0.9, "cc-by-nc": 0.9, "other": 0.9, "reserved": 1.0,
}
# fixed values: how identifiers start, the longest that fits counts; versions may follow
IDENTIFIERS = {
    "0bsd": "bsd", "afl": "artistic", "agpl": "agpl", "apache": "apache", "artistic": "artistic", "bsd": "bsd",
    "bsl": "bsl", "cc-by": "cc-by", "cc-by-nc": "cc-by-nc", "cc-by-nd": "cc-by-nd", "cc-by-sa": "cc-by-sa",
    "cc0": "cc0", "epl": "epl", "eupl": "eupl", "gpl": "gpl", "isc": "isc", "lgpl": "lgpl", "licenseref": "other",
    "mit": "mit", "mpl": "mpl", "unlicense": "unlicense", "zlib": "zlib",
}
WEAK = 0.5  # what a strong copyleft with an exception asks for
LONGEST = 64  # letters of an identifier
# what may follow the start of an identifier: versions and suffixes
ENDING = re.compile(r"(?:[-.]?v?[0-9][0-9a-z.]*+|-clause|-only|-or-later|-modern|\+)*+")
TOKEN = re.compile(rb"[\x20\t]*+([()]|[a-z0-9][a-z0-9.+-]*+)")
BINDS = {"or": 1, "and": 2, "with": 3}
BETWEEN = np.ones(256, bool)
BETWEEN[48:58] = BETWEEN[97:123] = BETWEEN[128:] = False
PLAIN = bytes(32 if blank else i for i, blank in enumerate(BETWEEN.tolist()))
SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, n_expressions long")


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    """Finds all phrases between blanks; a phrase may be of several kinds."""
    kinds: dict[str, dict] = {}
    for phrase, label in {**NOTICES, **BASE}.items():
        kinds.setdefault(phrase, {}).update(label=label, base=phrase in BASE)
    for phrase in TAGS:
        kinds.setdefault(phrase, {})["tag"] = TAGS[phrase]
    found = ahocorasick.Automaton()
    for phrase, kind in kinds.items():
        found.add_word(f" {phrase} ", (phrase.count(" ") + 1, kind))
    found.make_automaton()
    return found


def identified(token: str) -> str | None:
    """The label of a licence identifier."""
    if len(token) > LONGEST:
        return None
    if token.startswith("licenseref-"):
        return "other"
    for k in range(len(token), 2, -1):
        label = IDENTIFIERS.get(token[:k])
        if label and ENDING.fullmatch(token, k):
            return label
    return None


def tokens(text: bytes, at: int):
    """(kind, value) of the tokens from ``at`` on, as long as they continue an
    expression: an operand where one is due, an operator after one. A token
    that ends with a full stop is the last."""
    due, depth, exception = True, 0, False
    while match := TOKEN.match(text, at):
        at = match.end()
        token = match[1][:LONGEST + 1].decode()
        last, token = token.endswith("."), token.rstrip(".")
        if exception:
            if "exception" not in token:
                return
            yield "exception", token
            exception = False
        elif due and token == "(":
            depth += 1
            yield "(", token
        elif due:
            label = identified(token)
            if label is None:
                return
            yield "label", label
            due = False
        elif token == ")" and depth:
            depth -= 1
            yield ")", token
        elif token in BINDS:
            exception = token == "with"
            due = not exception
            yield "operator", token
        else:
            return
        if last:
            return


def postfix(read) -> list[tuple[str, str]]:
    """Shunting-yard: the tokens in postfix order."""
    out, waiting = [], []
    for kind, value in read:
        if kind in ("label", "exception"):
            out.append((kind, value))
        elif kind == "(":
            waiting.append((kind, value))
        elif kind == ")":
            while waiting and waiting[-1][0] != "(":
                out.append(waiting.pop())
            if waiting:
                waiting.pop()
        else:
            while waiting and waiting[-1][0] == "operator" and BINDS[waiting[-1][1]] >= BINDS[value]:
                out.append(waiting.pop())
            waiting.append((kind, value))
    out += [x for x in reversed(waiting) if x[0] == "operator"]
    return out


def evaluated(text: bytes, at: int = 0) -> tuple[set[str], float] | None:
    """The labels of the expression at ``at`` of a lower-cased text and what it asks for."""
    labels: set[str] = set()
    stack: list[float | None] = []  # None: an exception's name
    for kind, value in postfix(tokens(text, at)):
        if kind == "label":
            labels.add(value)
            stack.append(ASKS[value])
        elif kind == "exception":
            stack.append(None)
        elif len(stack) > 1:  # else its right side is missing
            y, x = stack.pop(), stack.pop()
            if value == "with":
                stack.append(WEAK if x in (ASKS["gpl"], ASKS["agpl"]) else x)
            else:
                stack.append(max(x, y) if value == "and" else min(x, y))
    return (labels, stack[0]) if labels else None


def scan(text: str):
    """(words, base places, first and last of them, base labels, labels, score, expressions)."""
    data = text.encode().lower()  # of bytes: A-Z only
    found = data.translate(PLAIN).split()
    line = f" {b' '.join(found).decode()} "
    n_base, first, last, base, labels, score = 0, None, None, set(), set(), 0.0
    tags: dict[int, bytes] = {}  # words up to the tag's end, what must follow
    word, seen = 0, 0  # blanks before ``seen`` are counted in ``word``
    for at, (size, kind) in automaton().iter(line):
        word += line.count(" ", seen, at)
        seen = at
        if "tag" in kind:
            tags[word] = min(kind["tag"], tags.get(word, kind["tag"]))
        if "label" in kind:
            labels.add(kind["label"])
            score = max(score, ASKS[kind["label"]])
        if kind.get("base"):
            n_base += 1
            base.add(kind["label"])
            first = word - size if first is None else min(first, word - size)
            last = word - size if last is None else max(last, word - size)
    n_expressions = 0
    if tags:
        raw = np.frombuffer(data, np.uint8)
        _, stop, _ = words(raw, np.array([0, len(raw)]), BETWEEN)
        for k, follows in tags.items():
            at = int(stop[k - 1])
            if not data.startswith(follows, at):
                continue
            read = evaluated(data, at + len(follows))
            if read:
                n_expressions += 1
                labels |= read[0]
                score = max(score, read[1])
    return len(found), n_base, first, last, base, labels, score, n_expressions


def _scanned(batches):
    listed = lambda labels: ",".join(sorted(labels))
    for batch in batches:
        rows = [scan(t) for t in batch.column("text").to_pylist()]
        n, n_base, first, last, base, labels, score, read = zip(*rows) if rows else [()] * 8
        whole = [pa.array(c, pa.int64()) for c in (n, n_base, first, last)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *whole, pa.array(map(listed, base), pa.string()),
             pa.array(map(listed, labels), pa.string()), pa.array(score, pa.float64()), pa.array(read, pa.int64())],
            names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
                   "n_expressions"])


def licences(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, the base places and labels, all labels, the score and the
    number of expressions read of each row."""
    bounded_batches(docs.sparkSession)
    return texts(docs).mapInArrow(_scanned, SCHEMA)
