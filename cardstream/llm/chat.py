r"""Chat formatting at token level.

A conversation's turns, in their order, become one sequence of token ids and a loss
mask. Every segment (a turn's text) is encoded by itself; the controls that mark turns
are reserved ids beyond the vocabulary, spliced between the segments; places and mask
come from prefix sums of the segments' lengths. The formatted text reads

    [INST]user text[/INST]   assistant text</s>   <<SYS>>system text<</SYS>>
    [ROLE]any other role[/ROLE]text[/TURN]

without anything between. A control string that occurs in a text is escaped: a backslash
goes behind its first character, and one more if it has some there already
(``[INST]`` -> ``[\INST]`` -> ``[\\INST]``), so no text holds a control and taking one
backslash away restores it. The mask covers the text ids of the learned roles.

Conversations are dealt by range of (conversation, turn), so a conversation that holds a
third of all rows is cut into as many ranges as it needs and encoded by as many tasks;
places in it are carried over from range to range.

``digests`` reads the ids back. A SHA-256 over a whole conversation has to see its turns
one after the other: conversations that lie in one range are read in the same pass, as a
stream; the few that a range's end cuts (one per range at most) are read again, each as a
stream of one task, with no more than a batch in memory.

Defined cases: null text is empty, a null role is an empty role; null conversation ids are
one conversation; null turns come first; turns of equal number go by role, then by the
text's XXH64 (seed 42, signed), and repeated rows are turns of their own; a very long text
is encoded in pieces cut where the tokenizer cuts anyway; an empty table gives an empty
result; other columns are never read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import give_back_memory, written

#: Control strings of the template; ``<s>`` marks nothing here but is no text's either.
CONTROLS = ["[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "</s>", "[ROLE]", "[/ROLE]", "[/TURN]", "<s>"]
FRAMES = {"user": ("[INST]", "[/INST]"), "system": ("<<SYS>>", "<</SYS>>"), "assistant": (None, "</s>")}
ROLE_OPEN, ROLE_CLOSE, TURN_CLOSE = "[ROLE]", "[/ROLE]", "[/TURN]"
LEARNED = ("assistant",)
PIECE = 1 << 18              # characters encoded at a time

_BARE = re.compile("|".join(f"{re.escape(c[0])}\\\\*(?={re.escape(c[1:])})" for c in CONTROLS))
_ESCAPED = re.compile("|".join(f"{re.escape(c[0])}\\\\+(?={re.escape(c[1:])})" for c in CONTROLS))
#: The tokenizer starts a new piece before a blank that follows a character and precedes a letter.
_CUT = regex.compile(r"(?<=\S)(?= \p{L})")


def escape(text: str) -> str:
    return _BARE.sub(lambda m: m.group() + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m.group()[:-1], text)


class Encoder:
    """A byte-level tokenizer, which gives every text back exactly, and the reserved ids."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        plan = json.loads(self.tokenizer.to_str())
        if plan["normalizer"] or (plan["pre_tokenizer"] or {}).get("type") != "ByteLevel" \
                or plan["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError(f"{path}: chat formatting needs a byte-level tokenizer that changes no text")
        self.tokenizer.encode_special_tokens = True        # their strings in a text are text
        self.base = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.ids = {c: self.base + k for k, c in enumerate(CONTROLS)}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, long ones in pieces, not more than ``PIECE`` characters or so at once."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        waiting: list[tuple[int, str]] = []
        held = 0
        for k, text in enumerate(texts):
            at = 0
            while len(text) - at > PIECE:
                cut = _CUT.search(text, at + PIECE)
                if cut is None:
                    break
                waiting.append((k, text[at: cut.start()]))
                held, at = held + cut.start() - at, cut.start()
                if held >= PIECE:
                    self._flush(waiting, out)
                    held = 0
            waiting.append((k, text[at:] if at else text))
            held += len(text) - at
            if held >= PIECE:
                self._flush(waiting, out)
                held = 0
        self._flush(waiting, out)
        return [x[0] if len(x) == 1 else np.concatenate(x) for x in out]

    def _flush(self, waiting: list[tuple[int, str]], out: list[list[np.ndarray]]) -> None:
        found = self.tokenizer.encode_batch_fast([t for _, t in waiting], add_special_tokens=False)
        for (k, _), e in zip(waiting, found):
            out[k].append(np.array(e.ids, np.int32))
        waiting.clear()

    def decode(self, segments: list[np.ndarray]) -> list[str]:
        return self.tokenizer.decode_batch([s.tolist() for s in segments], skip_special_tokens=False)


_LOADED: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """A worker keeps its tokenizer between tasks."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def splice(encoder: Encoder, roles: list[str], texts: list[str],
           learned: tuple[str, ...] = LEARNED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Turns put together: all ids, the mask, and where each turn ends."""
    segments = encoder.encode([escape(t) for t in texts])
    leads: list[list[int]] = []
    closes = []
    for role in roles:
        opening, closing = FRAMES.get(role, (ROLE_OPEN, TURN_CLOSE))
        lead = [encoder.ids[opening]] if opening else []
        if role not in FRAMES:
            lead += [*encoder.encode([escape(role)])[0].tolist(), encoder.ids[ROLE_CLOSE]]
        leads.append(lead)
        closes.append(encoder.ids[closing])
    n_lead = np.fromiter(map(len, leads), np.int64, len(leads))
    n_text = np.fromiter(map(len, segments), np.int64, len(segments))
    ends = np.cumsum(n_lead + n_text + 1)
    begins = ends - (n_lead + n_text + 1)
    text_at = begins + n_lead
    ids = np.empty(ends[-1], np.int32)

    def put(at: np.ndarray, lengths: np.ndarray, values) -> None:
        before = np.cumsum(lengths) - lengths
        ids[np.repeat(at - before, lengths) + np.arange(lengths.sum())] = values

    put(begins, n_lead, [i for lead in leads for i in lead])
    put(text_at, n_text, np.concatenate(segments))
    ids[ends - 1] = closes
    change = np.zeros(ends[-1] + 1, np.int8)
    taught = np.fromiter((r in learned for r in roles), bool, len(roles))
    taught &= n_text > 0
    change[text_at[taught]] = 1                    # a closing id lies between two texts
    change[(text_at + n_text)[taught]] = -1
    return ids, np.cumsum(change[:-1], dtype=np.int8), ends


ORDER = ["turn", "role", "tie", "row"]
TURN_DDL = "role string, tie bigint, row bigint, part int, start bigint, ids array<int>, loss array<tinyint>"


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, tie, row, text): the columns that are read, nulls defined."""
    text: Column = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return conversations.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.xxhash64(text).alias("tie"), F.monotonically_increasing_id().alias("row"), text.alias("text"))


def in_ranges(rows: DataFrame) -> DataFrame:
    """Rows dealt by ranges of conversation and turn, in their order."""
    return rows.repartitionByRange("conv_id", *ORDER).sortWithinPartitions("conv_id", *ORDER)


def assemble(rows: DataFrame, tokenizer_path: str, learned: tuple[str, ...] = LEARNED) -> DataFrame:
    """One row per turn: its ids and mask, ``start`` ids after the first of its conversation's in
    this ``part`` (a task's partition; rows come in the order given)."""
    kinds = [rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(tokenizer_path), TaskContext.get().partitionId()
        current, offset = (None,), 0               # no conversation yet
        for batch in batches:
            if not batch.num_rows:
                continue
            col = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
            ids, loss, ends = splice(encoder, col["role"].to_pylist(), col["text"].to_pylist(), learned)
            starts, before = [], 0
            for conv, end in zip(col["conv_id"].to_pylist(), ends.tolist()):
                if (conv,) != current:
                    current, offset = (conv,), 0
                starts.append(offset)
                offset, before = offset + end - before, end
            cuts = pa.array(np.concatenate([[0], ends]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [col["conv_id"], col["turn"], col["role"], col["tie"], col["row"],
                 pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(starts, pa.int64()),
                 pa.ListArray.from_arrays(cuts, pa.array(ids)), pa.ListArray.from_arrays(cuts, pa.array(loss))],
                names=["conv_id", "turn", "role", "tie", "row", "part", "start", "ids", "loss"])
        del batches
        give_back_memory()

    return rows.select("conv_id", *ORDER, "text").mapInArrow(
        run, f"conv_id {kinds[0]}, turn {kinds[1]}, {TURN_DDL}")


def format_conversations(conversations: DataFrame, tokenizer_path: str,
                         learned: tuple[str, ...] = LEARNED) -> DataFrame:
    """One row per turn: conv_id, turn, role, ``start`` (ids of the conversation before it), ids,
    loss. The ids of a conversation in the order of ``start`` are its training sequence."""
    turns = written(assemble(in_ranges(turn_rows(conversations)), tokenizer_path, learned), "chat-turns")
    per = turns.groupBy("conv_id", "part").agg(F.sum(F.size("ids")).alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # conversations that go on from the range before: one per range at most
    carried = (per.withColumn("before", before).where("before > 0")
               .select(F.col("conv_id").alias("c_conv"), F.col("part").alias("c_part"), "before"))
    return (turns.join(F.broadcast(carried), F.col("conv_id").eqNullSafe(F.col("c_conv"))
                       & (F.col("part") == F.col("c_part")), "left")
            .select("conv_id", "turn", "role", (F.col("start") + F.coalesce("before", F.lit(0))).alias("start"),
                    "ids", "loss"))


def parse(encoder: Encoder, ids: np.ndarray, loss: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, str, str, str, int]]:
    """Turns read back from ids: (row that it ends in, role, text, text under the mask, formatted
    characters). ``ends`` are the rows' ends."""
    name = {i: c for c, i in encoder.ids.items()}
    roles = {opening: role for role, (opening, _) in FRAMES.items()}
    at = np.flatnonzero(ids >= encoder.base)
    spans, begin, opening, role_end = [], 0, None, None
    for k in at.tolist():
        control = name[int(ids[k])]
        if control == ROLE_CLOSE:
            role_end = k
        elif control in roles or control == ROLE_OPEN:
            opening = control
        else:                                       # closes a turn
            spans.append((begin, opening, role_end, k, control))
            begin, opening, role_end = k + 1, None, None
    segments, masked = [], []
    for begin, opening, role_end, end, _ in spans:
        text = slice(role_end + 1 if role_end is not None else begin + (opening is not None), end)
        segments.append(ids[text])
        if role_end is not None:
            segments.append(ids[begin + 1: role_end])
        mask = loss[begin: end + 1] == 1
        masked.append(None if not mask.any() else ids[begin: end + 1][mask])
    # what is learned is the whole text, or else is decoded by itself
    alone = [m for m in masked if m is not None]
    decoded = iter(encoder.decode(segments))
    learnt = iter(encoder.decode(alone))
    rows = np.searchsorted(ends, [s[3] for s in spans], side="right")
    for row, (begin, opening, role_end, end, close), mask in zip(rows.tolist(), spans, masked):
        text = next(decoded)
        role = roles.get(opening)
        chars = len(text) + len(close) + len(opening or "")
        if role_end is not None:
            role = next(decoded)
            chars += len(role) + len(ROLE_CLOSE)
            role = unescape(role)
        yield row, role, unescape(text), "" if mask is None else unescape(next(learnt)), chars


DIGEST = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def read_back(turns: DataFrame, tokenizer_path: str) -> DataFrame:
    """One row per run of turns of a conversation: its turns, text and learned text, as digests."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    ddl = (f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
           "formatted_chars bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        state: list = []
        out: list[tuple] = []

        def close() -> None:
            if state:
                conv, n, text, chars, learnt, formatted = state
                out.append((conv, n, text.hexdigest(), chars, learnt.hexdigest(), formatted))

        kinds = None
        for batch in batches:
            if not batch.num_rows:
                continue
            convs, ids, loss = (batch.column(k) for k in range(3))
            kinds = convs.type
            names = convs.to_pylist()
            # of a sliced batch, the offsets do not begin at 0
            ends = ids.offsets.to_numpy()[1:] - ids.offsets[0].as_py()
            for row, role, text, taught, chars in parse(encoder, ids.flatten().to_numpy(), loss.flatten().to_numpy(), ends):
                if not state or state[0] != names[row]:
                    close()
                    state = [names[row], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                state[3] += len(taught)
                state[4].update(taught.encode())
                state[5] += chars
            if out:
                yield _digest_batch(out, kinds)
                out = []
        close()
        if out:
            yield _digest_batch(out, kinds)
        del batches
        give_back_memory()

    return turns.select("conv_id", "ids", "loss").mapInArrow(run, ddl)


def _digest_batch(rows: list[tuple], conv_kind: pa.DataType) -> pa.RecordBatch:
    cols = list(zip(*rows))
    kinds = [conv_kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=DIGEST)


def digests(conversations: DataFrame, tokenizer_path: str, learned: tuple[str, ...] = LEARNED) -> DataFrame:
    """Per conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and
    formatted_chars, as read back from its ids."""
    rows = turn_rows(conversations)
    runs = written(read_back(assemble(in_ranges(rows), tokenizer_path, learned), tokenizer_path), "chat-runs")
    cut = written(runs.groupBy(F.col("conv_id").alias("c_conv")).agg(F.count(F.lit(1)).alias("n"))
                  .where("n > 1").select("c_conv"), "chat-cut")
    same = F.col("conv_id").eqNullSafe(F.col("c_conv"))
    whole = runs.join(F.broadcast(cut), same, "left_anti")
    # ids of the cut conversations, assembled where their rows lie, then brought into order
    again = assemble(rows.join(F.broadcast(cut), same, "left_semi"), tokenizer_path, learned)
    ordered = again.repartition("conv_id").sortWithinPartitions("conv_id", *ORDER)
    return whole.unionByName(read_back(ordered, tokenizer_path))
