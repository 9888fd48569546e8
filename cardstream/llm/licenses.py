"""Licence scan: notice phrases and identifier tags, and what their expressions allow.

An Aho-Corasick automaton finds, in one pass over a text's words, every notice
phrase and every identifier tag (``SPDX-License-Identifier:``). From the place
where the automaton found a tag, the longest expression is read, token by token, to the
first token that cannot go on with it, at the latest to the line's end or the next tag, so
a text is read once however many tags it has. A shunting-yard parser
(``with`` binds tighter than ``and``, ``and`` tighter than ``or``; brackets group)
orders it, and it is evaluated: ``and`` takes the least open side, ``or`` the most open,
``with`` opens a licence a little.

An identifier is a listed family's name, alone or followed by ``-`` or ``+`` and more
(``gpl-2.0-or-later``), a family's name followed by ``license`` and a version (``Apache
License 2.0`` is ``apache-2.0``), or a ``LicenseRef-``; after ``with``, a name that holds
``exception`` or ends in ``-note``. No other word is a licence.

Defined cases: null text counts as empty (no words, empty labels, score 0); an
expression that words follow is read up to them, at half score; a tag without
an expression still yields the identifiers named up to the line's end or the next tag, at half score; a text of any length is read whole, in time that grows
with its length; bytes that are not UTF-8 are replaced; phrases match across line ends and
punctuation, since only words count; of equal findings each counts (ties need no order);
repeated rows each get the same result; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ddl, map_batches, text_bytes, with_columns

# Base phrases of the scan and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Further notice phrases (as words) and their licence names.
NOTICE_PHRASES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license": "apache-2",
    "redistribution and use in source and binary forms": "bsd",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution": "cc-by",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "all-rights-reserved",
}
TAG = "spdx license identifier"
# How open a licence family is, by the start of its identifier.
OPENNESS = {
    # permissive
    "0bsd": 1.0, "afl": 0.9, "apache": 1.0, "artistic": 0.8, "blessing": 1.0, "blueoak": 1.0, "bsd": 1.0, "bsl": 1.0,
    "cc0": 1.0, "curl": 1.0, "ecl": 1.0, "fsfap": 1.0, "fsful": 1.0, "ftl": 0.9, "hpnd": 1.0, "ibm-pibs": 1.0,
    "icu": 1.0, "ijg": 1.0, "isc": 1.0, "libpng": 1.0, "libtiff": 1.0, "mit": 1.0, "mit-0": 1.0, "mulanpsl": 1.0,
    "ncsa": 1.0, "ntp": 1.0, "openssl": 0.8, "pddl": 1.0, "php": 0.8, "postgresql": 1.0, "psf": 0.9, "python": 0.9,
    "ruby": 0.9, "tcl": 1.0, "unicode": 0.9, "unlicense": 1.0, "upl": 1.0, "vim": 0.8, "w3c": 0.9, "wtfpl": 1.0,
    "x11": 1.0, "zlib": 1.0, "zpl": 0.9,
    # share alike, per file or library
    "apsl": 0.5, "cddl": 0.5, "cecill-b": 0.9, "cecill-c": 0.6, "cpal": 0.4, "cpl": 0.5, "epl": 0.6, "eupl": 0.4, "lgpl": 0.6,
    "lppl": 0.6, "mpl": 0.6, "ms-pl": 0.6, "ms-rl": 0.5, "odbl": 0.5, "ofl": 0.7, "osl": 0.3, "qpl": 0.4,
    # share alike, whole works
    "agpl": 0.2, "cecill": 0.3, "gfdl": 0.3, "gpl": 0.3, "sleepycat": 0.3, "sspl": 0.1,
    # texts and media
    "cc-by": 0.9, "cc-by-nc": 0.1, "cc-by-nd": 0.1, "cc-by-sa": 0.5, "cc-pddc": 1.0,
    # not open
    "busl": 0.1, "elastic": 0.1, "json": 0.5, "polyform": 0.1, "all-rights-reserved": 0.0,
}
OWN = ("licenseref-", "documentref-")      # identifiers that a document defines itself
UNKNOWN = 0.2                              # openness of those
PRIORITY = {"or": 1, "and": 2, "with": 3}

_NOT_WORD = bytes(range(0x30)) + bytes(range(0x3A, 0x61)) + bytes(range(0x7B, 0x80))
_WORDS = bytes.maketrans(_NOT_WORD, b" " * len(_NOT_WORD))


def words_of(lowered: bytes) -> list[bytes]:
    """Runs of digits, lower-case ASCII letters and non-ASCII characters."""
    return lowered.translate(_WORDS).split()


def family(name: str) -> str | None:
    """The longest listed family that an identifier is of: its name, alone or before ``-`` or ``+``."""
    starts = [k for k in OPENNESS if name.startswith(k) and name[len(k): len(k) + 1] in ("", "-", "+")]
    return max(starts, key=len, default=None)


def openness(name: str) -> float:
    """How freely a licence lets its text be used, 0 to 1, by its family."""
    known = family(name)
    return UNKNOWN if known is None else OPENNESS[known]


def is_licence(word: str) -> bool:
    return family(word) is not None or word.startswith(OWN)


def is_exception(word: str) -> bool:
    return "exception" in word or word.endswith("-note") or word.startswith("additionref-")


def tokens_of(line: bytes, at: int, stop: int) -> Iterator[str]:
    """Words and brackets of ``line[at:stop]``, one by one; punctuation around a word is no part of it."""
    for found in _TOKEN.finditer(line, at, stop):
        word = found[0].strip(_AROUND)
        if word:
            yield word.decode("utf-8", "replace")


def longest_start(tokens: Iterator[str]) -> tuple[list[str], bool]:
    """The longest start of the tokens that is an expression, and whether it is all of them.

    Tokens are taken until one cannot go on with an expression: where an operator is due and
    another word comes, or a licence is due and a word that is none comes. A version after
    a family's name and ``license`` joins that name.
    """
    taken: list[str] = []
    depth, due, ends, beyond = 0, "licence", 0, False
    between = 0                                   # words between a family's name and its version
    for t in tokens:
        named = due == "operator" and taken[-1] in OPENNESS
        if named and t in _FILLERS and between < 2:
            between += 1
            continue
        if named and _VERSION.fullmatch(t) and (between or t.startswith("v")):
            taken[-1], between = f"{taken[-1]}-{t.lstrip('v')}", 0
            continue
        between = 0
        if t == "(" and due == "licence":
            depth += 1
        elif t == ")" and due == "operator" and depth:
            depth -= 1
        elif t in PRIORITY and due == "operator":
            due = "exception" if t == "with" else "licence"
        elif due == "licence" and is_licence(t) or due == "exception" and is_exception(t):
            due = "operator"
        else:
            beyond = True
            break
        taken.append(t)
        if due == "operator" and not depth:
            ends = len(taken)
    return taken[:ends], ends == len(taken) and ends > 0 and not beyond


def to_postfix(tokens: list[str]) -> list[str]:
    """Shunting-yard: operators wait on a stack until a weaker one or a bracket comes."""
    out: list[str] = []
    waiting: list[str] = []
    operand_due = True
    for t in tokens:
        if t == "(":
            if not operand_due:
                raise ValueError("operator expected")
            waiting.append(t)
        elif t == ")":
            if operand_due:
                raise ValueError("licence expected")
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                raise ValueError("bracket never opened")
            waiting.pop()
        elif t in PRIORITY:
            if operand_due:
                raise ValueError("licence expected")
            while waiting and waiting[-1] != "(" and PRIORITY[waiting[-1]] >= PRIORITY[t]:
                out.append(waiting.pop())
            waiting.append(t)
            operand_due = True
        else:
            if not operand_due:
                raise ValueError("operator expected")
            out.append(t)
            operand_due = False
    if operand_due or "(" in waiting:
        raise ValueError("expression ends early")
    return out + waiting[::-1]


def evaluate(postfix: list[str]) -> float:
    """Openness of an expression."""
    stack: list[float] = []
    for t in postfix:
        if t not in PRIORITY:
            stack.append(openness(t))
            continue
        right, left = stack.pop(), stack.pop()
        if t == "with":                       # an exception widens its licence and is no licence
            stack.append(min(1.0, left + 0.2))
        else:
            stack.append(min(left, right) if t == "and" else max(left, right))
    return stack[0]


def read_expression(line: bytes, at: int = 0, stop: int | None = None) -> tuple[float, set[str], bool]:
    """(openness, licences, read to the end?) of the expression that starts at ``at``."""
    stop = len(line) if stop is None else stop
    tokens, whole = longest_start(tokens_of(line, at, stop))
    if not tokens:
        named = {t for t in tokens_of(line, at, stop) if is_licence(t)}
        return min(map(openness, named), default=UNKNOWN), named, False
    names = {t for before, t in zip(["", *tokens], tokens)
             if before != "with" and t not in PRIORITY and t not in "()"}
    return evaluate(to_postfix(tokens)), names, whole


def canonical(name: str) -> str:
    """Label of an SPDX identifier; the base labels stand for their families."""
    if name.startswith("apache-2"):
        return "apache-2"
    return "cc-by-nc" if name.startswith("cc-by-nc-") else name


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    kinds: dict[str, list[tuple[str, str]]] = {}
    for phrase, label in BASE_PHRASES.items():
        kinds.setdefault(phrase, []).append(("base", label))
    for phrase, label in NOTICE_PHRASES.items():
        kinds.setdefault(phrase, []).append(("notice", label))
    kinds.setdefault(TAG, []).append(("tag", ""))
    for phrase, kind in kinds.items():
        found.add_word(f" {phrase} ", (len(phrase) + 1, kind))
    found.make_automaton()
    return found


_FOUND = automaton()
_TAG_TEXT = b"spdx-license-identifier:"
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_TOKEN = re.compile(rb"[()]|[^\s()]+")
_AROUND = b",;:.\"'*/#<>!-"
_FILLERS = ("license", "licence", "version")
_VERSION = re.compile(r"v?\d+(\.\d+)*")


def tag_ends(lowered: bytes, tags: list[int]) -> list[int]:
    """Where the text of each tag that begins at the given word (ascending) ends; words in
    between that are no tag as written (``spdx license identifier``) are left out."""
    ends, due = [], iter(tags)
    next_tag = next(due)
    for k, found in enumerate(_WORD.finditer(lowered)):
        if k == next_tag:
            if lowered.startswith(_TAG_TEXT, found.start()):
                ends.append(found.start() + len(_TAG_TEXT))
            next_tag = next(due, None)
            if next_tag is None:
                break
    return ends


def scan(text: bytes) -> dict:
    """All findings of one text."""
    lowered = text.lower()                         # bytes.lower(): A-Z alone
    words = words_of(lowered)
    line = f" {b' '.join(words).decode('utf-8', 'replace')} "
    starts, base, labels, scores, open_to, tags = [], set(), set(), [], [], []
    seen = word = 0                                # ``word`` words begin before ``seen``
    for end, (back, kinds) in _FOUND.iter(line):
        start = end - back
        word += line.count(" ", seen, start) if start >= seen else -line.count(" ", start, seen)
        seen = start
        for kind, label in kinds:
            if kind == "base":
                starts.append(word)
                base.add(label)
                scores.append(0.9)
                open_to.append(openness(label))
            elif kind == "notice":
                labels.add(label)
                scores.append(0.7)
                open_to.append(openness(label))
            else:
                tags.append(word)
    ends = tag_ends(lowered, sorted(tags)) if tags else []
    for at, after in zip(ends, [*(e - len(_TAG_TEXT) for e in ends[1:]), len(lowered)]):
        stop = lowered.find(b"\n", at, after)
        value, names, whole = read_expression(lowered, at, stop if stop >= 0 else after)
        labels |= {canonical(n) for n in names}
        if names:
            scores.append(1.0 if whole else 0.5)
            open_to.append(value)
    return {
        "n_words": len(words), "n_base": len(starts),
        "first_word": min(starts, default=None), "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(base | labels)),
        "score": max(scores, default=0.0), "openness": min(open_to, default=None),
    }


SCHEMA = {"n_words": ("bigint", pa.int64()), "n_base": ("bigint", pa.int64()),
          "first_word": ("bigint", pa.int64()), "last_word": ("bigint", pa.int64()),
          "base_labels": ("string", pa.string()), "labels": ("string", pa.string()),
          "score": ("double", pa.float64()), "openness": ("double", pa.float64())}


def license_scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: id and the findings; ``openness`` is the least open finding (null: none)."""
    rows = docs.select(F.col(id_col), text_bytes(text).alias("__text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [scan(x.as_py()) for x in batch.column(1)]
        return with_columns(batch, ["__text"], {
            n: pa.array([f[n] for f in found], kind) for n, (_, kind) in SCHEMA.items()})

    return map_batches(rows, run, ddl(rows, [id_col], ", ".join(f"{n} {t}" for n, (t, _) in SCHEMA.items())))
