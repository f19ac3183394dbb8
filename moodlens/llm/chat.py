"""Chat formatting by columnar byte assembly, with a loss mask, and reading the formatted text back.

A turn is formatted as ``<|im_start|>role``, a line feed, the text, ``<|im_end|>`` and a line feed. Control strings
inside a text get a backslash behind their first character, and one more where backslashes stand there already;
reading takes one away. As no control string holds the first character of any other behind its own, they cannot
overlap, and every text comes back as it was. Roles are escaped likewise, with line feeds written ``\\n`` and a null
role ``\\-``.

A task gets its conversations sorted and formats a block of them at once: numpy computes the lengths of headers and
contents, their cumulative offsets and the place of every byte, and scatters them into one buffer, which becomes the
Arrow column as it is. The loss mask is a list of spans of code points: the escaped texts of ``LOSS_ROLE``.

A conversation of up to ``whole_bytes`` is one row. A longer one is dealt out by ranges of its turns over many tasks and
comes in pieces, so neither a task nor a row ever holds an unbounded conversation. Only the digest of a split
conversation streams its pieces through one task, one at a time, since a hash must see them in order.

Turns are sorted by turn, then role, then text, nulls first: repeated rows all count. Null texts are empty, null roles
are kept and empty in digests. Rows without a conversation id form one conversation. Further columns are ignored. No
rows give no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from moodlens.llm.common import stored
from moodlens.llm.cuts import slices

START, END = "<|im_start|>", "<|im_end|>"
#: Strings that must not stand in a formatted text except as marks; the last four are marks of other templates.
CONTROL = (START, END, "<s>", "</s>", "[INST]", "[/INST]")
LOSS_ROLE = "assistant"
#: Bytes of a conversation up to which it is one row, and of a block that is formatted at once.
WHOLE_BYTES = 8 << 20
BLOCK_BYTES = 4 << 20
NULL_ROLE = "\\-"

_ESCAPED = "|".join(re.escape(c[0]) + r"\\*" + re.escape(c[1:]) for c in CONTROL)
FIND = re.compile(_ESCAPED.encode())
HIDDEN = re.compile("(" + "|".join(f"{re.escape(c[0])}(?=\\\\+{re.escape(c[1:])})" for c in CONTROL) + r")\\")


class Formatted(NamedTuple):
    """Formatted rows ``(conv_id, piece, text, loss_starts, loss_lengths)``; ``piece`` is 0 in ``whole``, rising in ``split``."""

    whole: DataFrame
    split: DataFrame

    def rows(self) -> DataFrame:
        return self.whole.unionByName(self.split)


def escape(text: str) -> str:
    return re.sub(_ESCAPED, lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return HIDDEN.sub(r"\1", text) if "\\" in text else text


def role_mark(role: str | None) -> str:
    return NULL_ROLE if role is None else escape(role).replace("\\", "\\\\").replace("\n", "\\n")


def role_of(mark: str) -> str | None:
    if mark == NULL_ROLE:
        return None
    return unescape(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], mark)) if "\\" in mark else mark


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of the pieces that begin at ``starts``."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def _bytes_of(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The offsets of string values, from 0, and the bytes of all."""
    values = values.cast(pa.large_string())
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return offsets - offsets[0], data


def assemble(ids: pa.Array, roles: pa.Array, texts: pa.Array) -> dict[str, pa.Array]:
    """Formatted text and loss spans of every run of rows with one id."""
    offsets, source = _bytes_of(pc.fill_null(texts, ""))
    starts, sizes = offsets[:-1], np.diff(offsets)
    # escapes go behind the first byte of a control string that lies in one text
    spans = np.array([m.span() for m in FIND.finditer(source)], np.int64).reshape(-1, 2)
    owner = np.searchsorted(offsets, spans[:, 0], side="right") - 1
    inside = spans[:, 1] <= offsets[owner + 1]
    hits, owner = spans[inside, 0], owner[inside]
    extra = np.bincount(owner, minlength=len(sizes))

    encoded = pc.dictionary_encode(roles, null_encoding="encode")
    names, role = encoded.dictionary.to_pylist(), encoded.indices.to_numpy()
    headers = [f"{START}{role_mark(r)}\n".encode() for r in names]
    pool, widths = np.frombuffer(b"".join(headers), np.uint8), np.array([len(h) for h in headers], np.int64)
    head = widths[role]
    footer = np.frombuffer(f"{END}\n".encode(), np.uint8)

    turn_end = np.cumsum(head + sizes + extra + len(footer))
    turn = np.concatenate([[0], turn_end[:-1]])
    content, content_end = turn + head, turn_end - len(footer)
    out = np.empty(int(turn_end[-1]), np.uint8)
    out[_spread(turn, head)] = pool[_spread((np.cumsum(widths) - widths)[role], head)]
    # stretches of text between escapes, and where each goes
    cut = np.sort(np.concatenate([starts[sizes > 0], hits + 1]))
    row = np.searchsorted(offsets, cut, side="right") - 1
    earlier = np.searchsorted(hits, cut) - np.searchsorted(hits, starts[row])
    out[_spread(content[row] + cut - starts[row] + earlier, np.diff(cut, append=len(source)))] = source
    rank = np.arange(len(hits)) - np.searchsorted(hits, starts[owner])
    out[content[owner] + hits - starts[owner] + 1 + rank] = ord("\\")
    out[(content_end[:, None] + np.arange(len(footer))).ravel()] = np.tile(footer, len(sizes))

    place = pc.dictionary_encode(ids, null_encoding="encode").indices.to_numpy()
    first = np.flatnonzero(np.diff(place, prepend=-1))
    conversation = np.repeat(np.arange(len(first)), np.diff(first, append=len(place)))
    points = np.concatenate([[0], np.cumsum((out & 0xC0) != 0x80, dtype=np.int64)])
    learned = np.array([n == LOSS_ROLE for n in names])[role]
    loss = pa.array(np.concatenate([[0], np.cumsum(np.bincount(conversation[learned], minlength=len(first)))]).astype(np.int32))
    begin = (points[content] - points[turn[first]][conversation])[learned]
    length = (points[content_end] - points[content])[learned]
    bounds = np.append(turn[first], len(out)).astype(np.int32)
    return {
        "conv_id": ids.take(pa.array(first)),
        "text": pa.StringArray.from_buffers(len(first), pa.py_buffer(bounds), pa.py_buffer(out)),
        "loss_starts": pa.ListArray.from_arrays(loss, pa.array(begin.astype(np.int32))),
        "loss_lengths": pa.ListArray.from_arrays(loss, pa.array(length.astype(np.int32))),
    }


def _blocks(parts: Iterator[pa.RecordBatch], whole: bool, block_bytes: int) -> Iterator[pa.Table]:
    """Sorted rows in blocks. With ``whole`` a block ends only where a conversation does."""
    held: list[pa.Table] = []
    for batch in parts:
        for part in slices(batch, "text"):
            table = pa.Table.from_batches([part])
            place = pc.dictionary_encode(table["conv_id"].combine_chunks(), null_encoding="encode").indices.to_numpy()
            same = held and held[-1]["conv_id"][-1].as_py() == table["conv_id"][0].as_py()
            if held and not same and sum(t["text"].nbytes for t in held) >= block_bytes:
                yield pa.concat_tables(held)
                held = []
            last = int(np.flatnonzero(np.diff(place, prepend=-1))[-1])
            if not whole:
                yield table
            elif last and sum(t["text"].nbytes for t in held) + table["text"].nbytes >= block_bytes:
                yield pa.concat_tables([*held, table.slice(0, last)])
                held = [table.slice(last)]
            else:
                held.append(table)
    if held:
        yield pa.concat_tables(held)


def _formatter(names: list[str], whole: bool, block_bytes: int):
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for table in _blocks(parts, whole, block_bytes):
            found = assemble(*(table[c].combine_chunks() for c in ("conv_id", "role", "text")))
            n = len(found["conv_id"])
            # pieces are numbered by task, so the numbers rise with the ranges of turns
            base = 0 if whole else (TaskContext.get().partitionId() << 32) + number + 1
            found["piece"] = pa.array(np.zeros(n, np.int64) if whole else base + np.arange(n))
            number += n
            yield pa.RecordBatch.from_arrays([found[c] for c in names], names=names)

    return batches


def format(turns: DataFrame, whole_bytes: int = WHOLE_BYTES, block_bytes: int = BLOCK_BYTES) -> Formatted:  # noqa: A001
    """The formatted conversations of a table ``(conv_id, turn, role, text)``."""
    turns = turns.select("conv_id", "turn", "role", "text")
    kind = turns.schema["conv_id"]
    schema = StructType([
        kind, StructField("piece", LongType()), StructField("text", StringType()),
        StructField("loss_starts", ArrayType(IntegerType())), StructField("loss_lengths", ArrayType(IntegerType())),
    ])
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + F.coalesce(F.octet_length("role"), F.lit(0)) + len(START + END) + 2
    long = turns.groupBy("conv_id").agg(F.sum(size.cast("long")).alias("size")).where(F.col("size") > whole_bytes)
    long = stored(long.select(F.col("conv_id").alias("_id")), "long-conversations")
    here = turns["conv_id"].eqNullSafe(long["_id"])
    order = ["conv_id", "turn", "role", "text"]
    short = turns.join(long, here, "left_anti").repartition("conv_id").sortWithinPartitions(*order)
    ranges = turns.join(long, here, "left_semi").repartitionByRange(*order[:3]).sortWithinPartitions(*order)
    return Formatted(*(rows.mapInArrow(_formatter(schema.names, whole, block_bytes), schema) for rows, whole in ((short, True), (ranges, False))))


def turns_of(text: str) -> list[tuple[str | None, str]]:
    """The roles and texts of a formatted text."""
    out = []
    for part in text.split(END + "\n")[:-1]:
        mark, _, content = part.removeprefix(START).partition("\n")
        out.append((role_of(mark), unescape(content)))
    return out


def under_mask(text: str, starts: list[int], lengths: list[int]) -> list[str]:
    """The texts under the loss mask."""
    return [unescape(text[a : a + n]) for a, n in zip(starts, lengths, strict=True)]


class _Digest:
    """What is known of a conversation from the pieces read so far."""

    def __init__(self, conv: object) -> None:
        self.conv, self.turns, self.loss = conv, hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0

    def add(self, text: str, starts: list[int], lengths: list[int]) -> None:
        for role, content in turns_of(text):
            self.turns.update(f"{role or ''}\n{content}\n".encode())
            self.n_turns += 1
        for content in under_mask(text, starts, lengths):
            self.loss.update(content.encode())
            self.loss_chars += len(content)
        self.formatted_chars += len(text)

    def row(self) -> tuple:
        return self.conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars


def digests(formatted: Formatted) -> DataFrame:
    """One row per conversation, read back from the formatted text: turns, loss text and length."""
    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [LongType(), StringType(), LongType(), StringType(), LongType()]
    schema = StructType([formatted.whole.schema["conv_id"], *(StructField(n, k) for n, k in zip(names, kinds))])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = None
        now: _Digest | None = None
        for whole in parts:
            arrow = arrow or whole.schema.field("conv_id").type
            for part in slices(whole, "text"):
                done = []
                for conv, piece, text, starts, lengths in zip(*(part.column(c).to_pylist() for c in ("conv_id", "piece", "text", "loss_starts", "loss_lengths"))):
                    if now is None or not piece or conv != now.conv:
                        done += [now.row()] if now else []
                        now = _Digest(conv)
                    now.add(text, starts, lengths)
                yield _rows(done, arrow)
        if now:
            yield _rows([now.row()], arrow)

    def _rows(done: list[tuple], arrow: pa.DataType) -> pa.RecordBatch:
        types = [arrow, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        columns = list(zip(*done)) if done else [()] * len(types)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=schema.names)

    in_order = formatted.split.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return formatted.whole.unionByName(in_order).mapInArrow(batches, schema)
