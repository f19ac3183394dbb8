"""Tokens on their way to chunks: rows of one chunk travel as one compressed block with a dictionary of its words.

A chunk is never turned back into strings: :func:`coded` looks up the dictionaries of its blocks and keeps four bytes a token.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

PACK_BYTES = 64 << 20  # rows that a task gathers before it packs them
LOOKUP_WORDS = 200_000  # words of dictionaries that are looked up at once
MOVED_TOKENS = 100_000  # tokens that are put in order at once


def packed(df: DataFrame) -> DataFrame:
    """``chunk, block`` of ``chunk, review_id, tokens``; no other column is kept. Null tokens stay, a null list becomes an empty one."""

    def flush(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts)
        parts.clear()
        chunk, ids, lists = (rows[c] for c in ("chunk", "review_id", "tokens"))
        del rows
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
        words = pc.list_flatten(lists).dictionary_encode().unify_dictionaries()
        del lists
        vocab = words.chunk(0).dictionary if words.num_chunks else pa.array([], pa.string())
        words = np.concatenate([np.zeros(0, np.int32), *(pc.fill_null(x.indices, -1).to_numpy() for x in words.chunks)])
        starts, chunks = np.cumsum(sizes) - sizes, chunk.to_numpy()
        order = np.argsort(chunks, kind="stable")
        chunks = chunks[order]
        bounds = [*np.flatnonzero(np.diff(chunks, prepend=chunks[0] - 1)), len(chunks)]
        place = np.zeros(len(vocab) + 1, np.int32)
        for low, high in zip(bounds, bounds[1:]):
            at = order[low:high]
            block = pa.array([_block(ids.take(pa.array(at)), sizes[at], _moved(words, starts[at], sizes[at]), vocab, place)], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(chunks[low : low + 1], chunk.type), block], names=["chunk", "block"])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0
        for part in parts:
            if len(part):
                kept.append(part)
                size += part.nbytes
            del part
            if size >= PACK_BYTES:
                yield from flush(kept)
                kept, size = [], 0
        if kept:
            yield from flush(kept)

    rows = df.select("chunk", "review_id", "tokens")
    return rows.mapInArrow(batches, f"chunk {rows.schema['chunk'].dataType.simpleString()}, block binary")


def _moved(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The words of rows that begin at ``starts``, one row after the other."""
    ends = np.cumsum(sizes)
    out = np.empty(ends[-1] if len(ends) else 0, words.dtype)
    low = a = 0
    while low < len(sizes):  # whole rows of so many words, or one of more
        high = max(low + 1, int(np.searchsorted(ends, a + MOVED_TOKENS, side="right")))
        b = int(ends[high - 1])
        if high == low + 1:
            out[a:b] = words[starts[low] : starts[low] + sizes[low]]
        else:
            out[a:b] = words[np.arange(a, b) + np.repeat(starts[low:high] + sizes[low:high] - ends[low:high], sizes[low:high])]
        low, a = high, b
    return out


def _block(ids: pa.ChunkedArray, sizes: np.ndarray, words: np.ndarray, vocab: pa.Array, place: np.ndarray) -> bytes:
    """``place`` is scratch space, one number for each word of ``vocab`` and one more."""
    own = np.unique(words)
    own = own[own >= 0]
    place[own] = np.arange(len(own), dtype=np.int32)
    tokens = pa.DictionaryArray.from_arrays(pa.array(place[words], mask=words < 0), vocab.take(pa.array(own)))
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    table = pa.table({"review_id": ids, "tokens": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), tokens)}).combine_chunks()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _opened(blocks: pa.ChunkedArray) -> Iterator[tuple[pa.Array, pa.Array]]:
    """The ids and lists of tokens of each block, one after the other."""
    for block in blocks:
        part = pa.ipc.open_stream(block.as_buffer()).read_all().combine_chunks()
        yield part["review_id"].combine_chunks(), part["tokens"].combine_chunks()


def words(blocks: pa.ChunkedArray) -> pa.Array:
    """The distinct words of the blocks of one chunk."""
    found = pa.array([], pa.string())
    kept: list[pa.Array] = []
    for _, lists in _opened(blocks):
        kept.append(lists.values.dictionary)
        if sum(map(len, kept)) >= LOOKUP_WORDS:
            found, kept = pc.unique(pa.concat_arrays([found, *kept])), []
    return pc.unique(pa.concat_arrays([found, *kept]))


def counts(blocks: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The distinct words of the blocks of one chunk, and how often each occurs."""
    vocab = words(blocks)
    _, _, at = coded(blocks, vocab)
    return vocab, np.bincount(at, minlength=len(vocab))


def coded(blocks: pa.ChunkedArray, vocab: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Ids of the reviews of a chunk in order, how many tokens each has, and the tokens as places in ``vocab``.

    Words that ``vocab`` lacks have the place after its last. Null tokens are left out. ``vocab`` has no word twice.
    """
    ids, sizes, codes, lists = [], [], [], []

    def look_up() -> None:
        whole = pa.concat_arrays([x.values.dictionary for x in lists])
        found = pc.fill_null(pc.index_in(whole, value_set=vocab), len(vocab)).to_numpy().astype(np.int32, copy=False)
        at = 0
        for x in lists:
            own = found[at : at + len(x.values.dictionary)]
            at += len(own)
            index = x.flatten().indices
            n = pc.list_value_length(x).to_numpy()
            if index.null_count:
                there = index.is_valid().to_numpy(zero_copy_only=False)
                upto = np.concatenate([[0], np.cumsum(there)])
                ends = np.cumsum(n)
                n = upto[ends] - upto[ends - n]
                index = index.drop_null()
            sizes.append(np.asarray(n, np.int64))
            codes.append(own[index.to_numpy()])
        lists.clear()

    waiting = 0
    for own_ids, own_lists in _opened(blocks):
        ids.append(own_ids)
        lists.append(own_lists)
        waiting += len(own_lists.values.dictionary)
        if waiting >= LOOKUP_WORDS:
            look_up()
            waiting = 0
    if lists:
        look_up()
    all_ids, all_sizes = pa.concat_arrays(ids), np.concatenate(sizes)
    flat = np.concatenate(codes)
    codes.clear()
    order = pc.sort_indices(all_ids)
    at = order.to_numpy().astype(np.int64)
    return all_ids.take(order), all_sizes[at], _moved(flat, (np.cumsum(all_sizes) - all_sizes)[at], all_sizes[at])


def unpacked(blocks: pa.Table) -> pa.Table:
    """``review_id, tokens`` of the blocks of one chunk, with plain strings."""
    parts = []
    for ids, lists in _opened(blocks["block"]):
        sizes = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
        plain = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), lists.flatten().dictionary_decode())
        parts.append(pa.table({"review_id": ids, "tokens": plain}))
    return pa.concat_tables(parts)
