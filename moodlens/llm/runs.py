"""Periodic runs: stretches of words that repeat with a period, found by suffix trees and Lyndon roots.

A run is a stretch of consecutive words with smallest period q, at least ``max(SHORTEST, REPEATS * q)`` words long,
that no neighbouring word extends. Every run has a Lyndon root: the longest Lyndon word at some place of the run,
in the order of the words or in the reverse order, is one of its periods. So the longest Lyndon words at all places,
in both orders, are all candidates there are. Each is extended to the right by the longest common extension of its
two ends in the suffix tree of the document, and to the left by that in the tree of the reversed document. Trees are
built by Ukkonen's method; common extensions are lowest common ancestors, found in constant time in an Euler tour.

Trees are only built of stretches that can hold a run. Within a stretch of n words that is one, every word stands
``REPEATS`` times, at a distance of n / REPEATS or less from the next of its kind. Words that do not, cut their
stretch; what is left is judged again until nothing changes. No run is lost, and a neighbour that would extend a run
is never cut from it. Stretches of a document are joined in one tree by marks that stand once each.

A document is worked on by the task that reads it; there is no shuffle. Memory grows with the longest document alone.
Null texts have no words. Rows with equal ids or texts each get their row, in any order; null ids are kept. Only
``doc_id`` and the text are read, so further columns, whatever their names, change nothing. No rows give none.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from moodlens.llm.cuts import slices
from moodlens.llm.suffix_tree import SuffixTree

#: Words that a run has at least.
SHORTEST = 6
#: Periods that a run has at least.
REPEATS = 4
RUN = ("start", "length", "period")


def _next_smaller(rank: list[int]) -> np.ndarray:
    """The place of the next smaller rank; the last place for those without one."""
    out = [0] * len(rank)
    stack: list[int] = []
    for i in range(len(rank) - 1, -1, -1):
        mine = rank[i]
        while stack and rank[stack[-1]] > mine:
            stack.pop()
        out[i] = stack[-1] if stack else i
        stack.append(i)
    return np.array(out, np.int64)


def _joined(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The parts' symbols, renumbered above the marks before, between and behind them, and the places of the marks."""
    marks = np.cumsum([0, *(len(p) + 1 for p in parts)])
    out = np.empty(int(marks[-1]) + 1, np.int64)
    out[marks] = np.arange(len(marks))
    word = np.ones(len(out), bool)
    word[marks] = False
    out[word] = len(marks) + np.unique(np.concatenate(parts), return_inverse=True)[1]
    return out, marks


def runs_of(parts: list[np.ndarray], shortest: int = SHORTEST, repeats: int = REPEATS) -> list[tuple[int, int, int, int]]:
    """``(part, start in it, length, period)`` of every run of the parts, which are judged one by one."""
    text, marks = _joined(parts)
    tree, back = SuffixTree(text.tolist()), SuffixTree(text[::-1].tolist())
    size, word = len(text), np.ones(len(text), bool)
    word[marks] = False
    # marks stay below all words in both orders, so no Lyndon word reaches over one
    reverse = np.concatenate([np.arange(len(marks)), np.arange(tree.width - 1, len(marks) - 1, -1)])
    found = []
    for rank in (tree.rank, tree.ranks(reverse)):
        end = _next_smaller(rank.tolist())
        i = np.flatnonzero(word & ((end - np.arange(size)) * repeats <= size))
        j = end[i]
        period = j - i
        right, left = tree.common(i, j), back.common(size - i, size - j)
        length = left + period + right
        good = length >= np.maximum(shortest, repeats * period)
        found.append(np.stack([(i - left)[good], length[good], period[good]], axis=1))
    every = np.unique(np.concatenate(found), axis=0)
    part = np.searchsorted(marks, every[:, 0]) - 1
    every[:, 0] -= marks[part] + 1
    return [(int(p), *map(int, r)) for p, r in zip(part, every, strict=True)]


def stretches(words: np.ndarray, group: np.ndarray, shortest: int = SHORTEST, repeats: int = REPEATS) -> tuple[np.ndarray, np.ndarray]:
    """Places of words that can be in a run, and the number of each place's stretch; ``group`` keeps documents apart."""
    at = np.arange(len(words))
    while len(at):
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) != 1) | (group[at[1:]] != group[at[:-1]])
        stretch = np.cumsum(new) - 1
        length = np.bincount(stretch)[stretch]
        long = length >= shortest
        if not long.all():
            at = at[long]
            continue
        key = stretch * (int(words.max()) + 1) + words[at]
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        times = np.diff(first, append=len(key))
        gap = np.diff(at[order])
        gap = np.where(key[1:] == key[:-1], gap, len(words))
        nearest = np.minimum(np.append(gap, len(words)), np.insert(gap, 0, len(words)))
        good = np.empty(len(at), bool)
        good[order] = (np.repeat(times, times) >= repeats) & (nearest * repeats <= length[order])
        if good.all():
            return at, stretch
        at = at[good]
    return at, at


def runs_of_texts(words: list[list[bytes]], shortest: int = SHORTEST, repeats: int = REPEATS) -> dict[int, list[tuple[int, int, int]]]:
    """``(start, length, period)`` of the runs of those documents that have any, by start, then period."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    number = defaultdict(count().__next__)
    every = np.fromiter(map(number.__getitem__, chain.from_iterable(words)), np.int64, int(sizes.sum()))
    document = np.repeat(np.arange(len(words)), sizes)
    at, stretch = stretches(every, document, shortest, repeats)
    out: dict[int, list[tuple[int, int, int]]] = {}
    if not len(at):
        return out
    begin = np.flatnonzero(np.diff(stretch, prepend=-1))
    parts, owner, offset = np.split(every[at], begin[1:]), document[at[begin]], at[begin] - (np.cumsum(sizes) - sizes)[document[at[begin]]]
    bounds = [*np.flatnonzero(np.diff(owner, prepend=-1)), len(owner)]
    for a, b in zip(bounds, bounds[1:]):
        found = runs_of(parts[a:b], shortest, repeats)
        if found:
            out[int(owner[a])] = sorted(((int(offset[a + p]) + s, n, q) for p, s, n, q in found), key=lambda r: (r[0], r[2]))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that stay if every run keeps its first period."""
    covered = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        covered[start + period] += 1
        covered[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(covered[:-1]) == 0)]


def find(docs: DataFrame, text: str = "text", shortest: int = SHORTEST, repeats: int = REPEATS) -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)``: the runs by start, then period, and the text with one period of each.

    ``collapsed`` holds the words left, joined by one space.
    """
    runs = StructField("runs", ArrayType(StructType([StructField(n, LongType()) for n in RUN])))
    schema = StructType([docs.schema["doc_id"], StructField("n_words", LongType()), StructField("collapsed", StringType()), runs])
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in RUN]))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for part in slices(whole, text):
                words = [(t or "").encode().split() for t in part.column(text).to_pylist()]
                found = runs_of_texts(words, shortest, repeats)
                left = [b" ".join(collapse(w, found[k]) if k in found else w) for k, w in enumerate(words)]
                rows = [[dict(zip(RUN, r, strict=True)) for r in found.get(k, ())] for k in range(len(words))]
                columns = {
                    "doc_id": part.column("doc_id"), "n_words": pa.array(list(map(len, words)), pa.int64()),
                    "collapsed": pa.array(left, pa.binary()).cast(pa.string()), "runs": pa.array(rows, kind),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return docs.select("doc_id", text).mapInArrow(batches, schema).select("doc_id", "n_words", "runs", "collapsed")


def longest(runs: Column) -> Column:
    """The run with the greatest length, ties by the smallest start, then period; null without runs."""
    return F.reduce(
        runs, F.get(runs, F.lit(0)),
        lambda best, r: F.when(r["length"] > best["length"], r).otherwise(best),
    )
