"""Cost-balanced packing of documents into training sequences.

A document is its token ids and one closing id. Every full run of
``SEQUENCE`` ids is a sequence by itself; what remains is packed window by
window: pieces are taken by descending cost (linear in their length plus
quadratic for attention, which stays inside a piece) and each goes to the
sequence of lowest cost that still has room for it. Pieces that no sequence has
room for are cut to fill the gaps, so every sequence of a window ends full; what
is over opens the next window. A partition's last ids fill sequences whose
lengths are powers of two, which need no padding.

The work needs no shuffle: a window lives in one task and holds at most
``WINDOW`` sequences of ids, whatever the table's size. A sequence's id is its
partition's number and a counter, so a task that runs again on the same input
split gives the same rows. (An input whose rows move between partitions when
recomputed should be written first.)

Defined cases: null or empty text is one piece of length one (the closing id);
repeated rows are packed each; a long text is cut as often as needed; an empty
table gives no rows; pieces of equal cost keep the order of their rows, and of sequences of equal
cost the first is filled; any tokenizer file may be given (see ``WordIds``); other columns are never read.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ddl, give_back_memory, text_bytes

SEQUENCE = 4096
WINDOW = 256               # sequences packed together
LINEAR, QUADRATIC = 1.0, 1.0 / 2048
CLOSING_ID = 2
CACHE_WORDS = 600_000      # words, and as many runs, whose ids a worker remembers

PIECE_DDL = ("start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
             "sequence_id bigint, offset bigint, padded bigint")


def cost(length):
    """Estimated cost of a piece: linear plus quadratic in its length."""
    return LINEAR * length + QUADRATIC * length * length


def _byte_chars() -> dict[int, int]:
    """Byte-level alphabet: a printable Latin-1 byte stands for itself, the others, in
    order, for the code points from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - set(own)))}


class WordIds:
    """Ids of texts by the tokenizer, with the ids of white-space-bounded words remembered.

    The tokenizer drops white space and lower-cases, so a text's ids are those of
    its words in turn. Words are lower-cased (A-Z) before the lookup, save in texts
    with combining marks or ``<|``, where that could change the ids. A new word of
    plain Latin characters is cut into letter, digit and other runs here and goes
    straight to the tokenizer's model; any other takes the tokenizer's whole way.

    All this holds for tokenizers that normalise and split as ``NORMALIZER`` and ``SPLITTER``
    say, which is checked when one is loaded; any other encodes whole texts itself.
    """

    #: No white space, controls, combining marks or letters whose lower case has two characters.
    LATIN = regex.compile("[\\x21-\\x7e\\xa1-\u012f\u0131-\u024f]+")
    #: Fixed value: the tokenizer file's own split pattern.
    RUNS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

    # The steps of the tokenizer file before its model.
    NORMALIZER = {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
    SPLITTER = {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": RUNS.pattern}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}

    def __init__(self, tokenizer_path: str, remember: int = CACHE_WORDS):
        self.remember = remember
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.model = self.tokenizer.model
        told = [None if part is None else json.loads(part.__getstate__())
                for part in (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer)]
        self.by_words = told == [self.NORMALIZER, self.SPLITTER]
        self.byte_chars = _byte_chars()
        self.runs: dict[str, tuple[int, ...]] = {}
        self.clear()

    def clear(self) -> None:
        self.words: dict[bytes, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.starts = np.zeros(1 << 14, np.int64)
        self.lengths = np.zeros(1 << 14, np.int64)

    def _run(self, run: str) -> tuple[int, ...]:
        ids = self.runs.get(run)
        if ids is None:
            ids = self.runs[run] = tuple([t.id for t in self.model.tokenize(
                run if run.isascii() else run.encode().decode("latin-1").translate(self.byte_chars))])
        return ids

    def _encode(self, word: str) -> list[int]:
        if "<|" in word or not self.LATIN.fullmatch(word):
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        word = word.lower()
        if word.isalpha():
            return self._run(word)
        return [i for run in self.RUNS.findall(word) for i in self._run(run)]

    def _learn(self, new: list[bytes]) -> None:
        found = [self._encode(w.decode("utf-8", "replace")) for w in new]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        k, total = len(self.words), int(lengths.sum())
        while k + len(new) > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used: self.used + total] = np.fromiter(chain.from_iterable(found), np.uint32, total)
        self.starts[k: k + len(new)] = self.used + np.cumsum(lengths) - lengths
        self.lengths[k: k + len(new)] = lengths
        self.used += total
        self.words.update(zip(new, range(k, k + len(new))))

    def ids(self, text: bytes) -> np.ndarray:
        if not self.by_words:
            return np.array(self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, np.uint32)
        if len(self.words) > self.remember or self.used > 16 * self.remember:
            self.clear()
        if len(self.runs) > self.remember:
            self.runs = {}
        plain = b"\xcc" not in text and b"\xcd" not in text and b"<|" not in text
        words = (text.lower() if plain else text).split()
        if not words:
            return np.zeros(0, np.uint32)
        known = list(map(self.words.get, words))
        if None in known:
            self._learn(list({w for w, k in zip(words, known) if k is None}))
            known = list(map(self.words.get, words))
        at = np.array(known, np.int64)
        lengths = self.lengths[at]
        ends = np.cumsum(lengths)
        take = np.repeat(self.starts[at] - (ends - lengths), lengths) + np.arange(ends[-1])
        return self.flat[take]


def pack(pieces: list[tuple], room: list[int]) -> tuple[list[list[tuple]], list[tuple]]:
    """Fill sequences of lengths ``room`` from ``pieces``; what is over comes back.

    A piece is (doc, start, ids). There are at least as many ids as room.
    """
    free = np.array(room, np.int64)
    spent = np.zeros(len(room))
    filled: list[list[tuple]] = [[] for _ in room]
    over = []
    for piece in sorted(pieces, key=lambda p: -len(p[2])):
        n = len(piece[2])
        fits = free >= n
        if not fits.any():
            over.append(piece)
            continue
        k = int(np.argmin(np.where(fits, spent, np.inf)))
        filled[k].append(piece)
        free[k] -= n
        spent[k] += cost(n)
    for k in np.argsort(spent, kind="stable"):       # cut what found no room, to close the gaps
        while free[k]:
            doc, start, ids = over.pop()
            n = min(int(free[k]), len(ids))
            filled[k].append((doc, start, ids[:n]))
            free[k] -= n
            if n < len(ids):
                over.append((doc, start + n, ids[n:]))
    return filled, over


def powers_of_two(n: int) -> list[int]:
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                   text: str = "text", remember: int = CACHE_WORDS) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset and
    ``padded``, the length that its sequence takes up. A worker remembers the ids of
    ``remember`` words between its tasks (memory against time; the rows are the same)."""
    rows = docs.select(F.col(id_col), text_bytes(text).alias("__text"))
    id_type = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _word_ids(tokenizer_path, remember)
        first = TaskContext.get().partitionId() << 33
        made = 0
        id_kind: pa.DataType | None = None

        def emit(sequences: list[list[tuple]]) -> pa.RecordBatch:
            nonlocal made
            out: list[tuple] = []
            for seq in sequences:
                at, total = 0, sum(len(p[2]) for p in seq)
                padded = total if total & (total - 1) == 0 else SEQUENCE
                for (doc, tokens), start, ids in seq:
                    crc = zlib.crc32(ids.astype("<u4", copy=False).tobytes())
                    out.append((doc, start, len(ids), crc, tokens, first + made, at, padded))
                    at += len(ids)
                made += 1
            cols = list(zip(*out))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], id_kind), *(pa.array(c, pa.int64()) for c in cols[1:])],
                names=[id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded"])

        waiting: list[tuple] = []
        held = 0
        for batch in batches:
            id_kind = batch.schema.field(0).type
            whole = []
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(words.ids(raw.as_py()), np.uint32(CLOSING_ID))
                key, cut = (doc, len(ids)), len(ids) - len(ids) % SEQUENCE
                whole += [[(key, s, ids[s: s + SEQUENCE])] for s in range(0, cut, SEQUENCE)]
                if cut < len(ids):
                    waiting.append((key, cut, ids[cut:].copy()))
                    held += len(ids) - cut
                if len(whole) >= WINDOW:
                    yield emit(whole)
                    whole = []
                if held >= WINDOW * SEQUENCE:
                    filled, waiting = pack(waiting, [SEQUENCE] * WINDOW)
                    held -= WINDOW * SEQUENCE
                    yield emit(filled)
            if whole:
                yield emit(whole)
        if held:
            room = [SEQUENCE] * (held // SEQUENCE) + powers_of_two(held % SEQUENCE)
            yield emit(pack(waiting, room)[0])
        del batches, waiting
        give_back_memory()

    return rows.mapInArrow(run, f"`{id_col}` {id_type}, {PIECE_DDL}")


_LOADED: dict[tuple[str, int], WordIds] = {}


def _word_ids(path: str, remember: int) -> WordIds:
    """A worker keeps its tokenizer and remembered words between tasks."""
    if (path, remember) not in _LOADED:
        _LOADED[path, remember] = WordIds(path, remember)
    return _LOADED[path, remember]
