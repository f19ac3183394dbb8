"""A bounded memory of the token ids of text cuts, for tokenizers that drop white space."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct cuts that a memory keeps.
CACHE = 400_000
#: Text bytes handled at once.
SLICE_BYTES = 4 << 20


class IdMemory:
    """Remembers the ids of texts. ``learn`` takes new texts and gives the number of ids of each, and the ids of all."""

    def __init__(self, learn: Callable[[list], tuple[np.ndarray, np.ndarray]]) -> None:
        self.learn = learn
        self.slots: dict = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.used = 0
        self.start = np.zeros(1 << 12, np.int64)
        self.length = np.zeros(1 << 12, np.int64)
        # calls that met a text
        self.met = np.zeros(1 << 12, np.int32)

    def _add(self, texts: list) -> None:
        sizes, flat = self.learn(texts)
        first, total = len(self.slots), len(self.slots) + len(texts)
        while total > len(self.start):
            self.start, self.length, self.met = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length, self.met))
        if self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), len(flat)), np.int32)])
        self.slots.update(zip(texts, range(first, total), strict=True))
        self.start[first:total] = self.used + np.cumsum(sizes) - sizes
        self.length[first:total] = sizes
        self.met[first:total] = 0
        self.ids[self.used : self.used + len(flat)] = flat
        self.used += len(flat)

    def thin(self, count: int) -> None:
        """Keep the ``count`` texts that most calls met; half of what was counted goes, so that old texts leave."""
        n = len(self.slots)
        kept = np.sort(np.argsort(-self.met[:n], kind="stable")[:count])
        texts = list(self.slots)
        self.slots = {texts[k]: j for j, k in enumerate(kept.tolist())}
        length, ids = self.gather(kept)
        self.used, m = len(ids), len(kept)
        self.ids[: self.used] = ids
        self.met[:m] = self.met[kept] >> 1
        self.start[:m] = np.cumsum(length) - length
        self.length[:m] = length

    def _find(self, texts: list) -> tuple[np.ndarray, list]:
        """The slots of texts, -1 for new ones, and the distinct new ones."""
        get = self.slots.get
        slot = np.array([get(t, -1) for t in texts], np.int64)
        return slot, list(dict.fromkeys([texts[k] for k in np.flatnonzero(slot < 0).tolist()]))

    def slots_of(self, texts: list, limit: int) -> np.ndarray:
        """The slots of texts. Where more than ``limit`` would be known, the texts met most often stay, half of it at most."""
        slot, new = self._find(texts)
        if len(self.slots) + len(new) > limit and self.slots:
            self.thin(max(0, min(limit // 2, limit - len(new))))
            slot, new = self._find(texts)
        if new:
            self._add(new)
            gone = np.flatnonzero(slot < 0)
            slot[gone] = [self.slots[texts[k]] for k in gone.tolist()]
        self.met[slot] += 1
        return slot

    def gather(self, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each slot, and the ids of all."""
        length = self.length[slot]
        at = np.repeat(self.start[slot] - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
        return length, self.ids[at]


class CutMemory:
    """Cuts texts at spaces and line feeds and encodes every distinct new cut once, with ``learn``.

    When ``limit`` cuts are known, the more frequent half of them stays.
    """

    def __init__(self, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int | None = None) -> None:
        self.limit = limit or CACHE
        self.known = IdMemory(learn)

    def encode(self, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets of the texts, one more than there are texts, and the ids of all. Nulls count as empty."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        lists = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
        # only distinct cuts become Python strings
        coded = lists.flatten().dictionary_encode()
        slot = self.known.slots_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), self.limit)
        length, ids = self.known.gather(slot[coded.indices.to_numpy()])
        return np.concatenate([[0], np.cumsum(length)])[bounds].astype(np.int64), ids


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most ``SLICE_BYTES`` of text, or so many list items, in ``column``; one row at least."""
    values = batch.column(column)
    length = pc.list_value_length if pa.types.is_list(values.type) else pc.binary_length
    sizes = pc.fill_null(length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(sizes) // SLICE_BYTES
    first = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
    for a, b in zip(first, first[1:]):
        if b > a:
            yield batch.slice(a, b - a)
