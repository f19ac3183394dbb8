"""Token ids in binary files, compressed document by document with one shared dictionary.

A file holds, in little-endian order::

    8 bytes   magic b"TOKIDS01"
    4 bytes   width of an id in bytes (2 or 4)
    32 bytes  SHA-256 of the shared dictionary
    frames    one zstandard frame per document
    index     document ids int64, offsets uint64 (one more than documents), counts uint64, present uint8
    24 bytes  index offset uint64, number of documents uint64, magic

so any document can be read by itself: one look at the index, one frame. The dictionary is trained on the ids of
``SAMPLE`` documents at most, chosen by the hash of their id; every document is written.

Documents are range-sorted by id, each range gives files of about ``FILE_BYTES`` of compressed frames, and files
are committed by :mod:`files`. Null texts are encoded like empty ones, and null ids come first. Rows with equal
ids each have their entry. An empty table gives no files.
"""

from __future__ import annotations

import hashlib
import os
import struct
import unicodedata
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from moodlens.llm import files
from moodlens.llm.cuts import CACHE, CutMemory, IdMemory, slices

MAGIC = b"TOKIDS01"
#: Compressed bytes after which a file is closed.
FILE_BYTES = 64 << 20
#: Text bytes of a range.
RANGE_BYTES = 24 << 20
#: Documents the dictionary is trained on, and ids taken of each, at most.
SAMPLE, SAMPLE_IDS = 1_000, 2_048
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
MARKS = "!\"#$%&()*+,-./:;<=>?@[]^_`{|}~"
#: Distinct cuts that a task remembers, about 200 bytes each.
CUTS = 800_000
#: Parts of cuts that are encoded in one call.
JOINED = 2_000
#: Partitions of files when they are read back, at most.
READERS = 20_000
MANIFEST = f"{files.MANIFEST}, documents bigint, ids bigint"


@lru_cache(maxsize=2)
def memory(path: str) -> CutMemory:
    """The tokenizer's ids, by the library's own encoder, for tokenizers like this one.

    It lower-cases, its pre-tokenizer drops white space and never joins letters and punctuation. So cuts are
    independent, and so are a word and the marks behind it: the library encodes each distinct part once.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items() if t.special and not t.normalized}
    if not special:
        raise ValueError("the tokenizer must have a special token, to stand between cuts")
    mark, number = min(special.items())

    widths = np.zeros(tokenizer.get_vocab_size(), np.int64)
    suffix = getattr(tokenizer.model, "end_of_word_suffix", None) or ""
    for token, i in tokenizer.get_vocab().items():
        widths[i] = len(token.removesuffix(suffix))

    def encode(text: str) -> np.ndarray:
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)

    def between_spaces(parts: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Parts in one text; the bytes of tokens and parts tell where each ends. None where they do not agree."""
        ids = encode(" ".join(parts))
        sizes = [len(p) if p.isascii() else len(unicodedata.normalize("NFC", p).lower().encode()) for p in parts]
        last, have = np.cumsum(sizes), np.concatenate([[0], np.cumsum(widths[ids])])
        ends = np.searchsorted(have, last)
        if have[-1] != last[-1] or (have[ends] != last).any():
            return None
        return np.diff(ends, prepend=0), ids

    def between_marks(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = encode(mark.join(parts))
        ends = np.flatnonzero(ids == number) if len(parts) > 1 else np.zeros(0, np.int64)
        if len(ends) != len(parts) - 1:
            raise ValueError("the tokenizer does not keep its special token")
        return np.diff(np.concatenate([[-1], ends, [len(ids)]])) - 1, np.delete(ids, ends)

    def library(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Many parts in one call, between spaces or else between special tokens; parts that hold one of these go alone."""
        found = []
        for k in range(0, len(parts), JOINED):
            some = parts[k : k + JOINED]
            joined = " ".join(some)
            if any(t in joined for t in special):
                found += [between_marks([p]) for p in some]
            else:
                found.append(between_spaces(some) or between_marks(some))
        return tuple(np.concatenate(x) for x in zip(*found))

    words = IdMemory(library)

    def learn(cuts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A cut is a word and the marks behind it; both are learned once and put together by their places."""
        parts = []
        for cut in cuts:
            word = cut.rstrip(MARKS)
            if word.isalpha() and word.isascii():
                parts += (word.lower(), cut[len(word) :])
            elif len(word) < len(cut) and word.isalpha() and unicodedata.normalize("NFC", word).lower().isalpha():
                parts += (word, cut[len(word) :])
            else:
                parts += (cut, "")
        length, flat = words.gather(words.slots_of(parts, CACHE))
        return length.reshape(-1, 2).sum(axis=1), flat

    return CutMemory(learn, CUTS)


def train_dictionary(docs: DataFrame, tokenizer: str, width: int) -> bytes:
    """The shared dictionary; plain sample content where there is too little to train on."""
    ids = docs.select("doc_id").where("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    rows = docs.join(F.broadcast(ids), "doc_id").select(F.substring("text", 1, 8 * SAMPLE_IDS).alias("text")).limit(2 * SAMPLE)
    kind, encode = np.dtype(f"<u{width}"), memory(tokenizer).encode
    texts = sorted(r[0] or "" for r in rows.collect())
    samples = [encode([t])[1][:SAMPLE_IDS].astype(kind).tobytes() for t in texts]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


class _File:
    """A file being written."""

    def __init__(self, folder: str, width: int, dictionary: bytes) -> None:
        self.temporary = files.temporary_name()
        self.out = files.create(folder, self.temporary)
        self.out.write(MAGIC + struct.pack("<I", width) + hashlib.sha256(dictionary).digest())
        self.offsets, self.counts, self.ids, self.present = [len(MAGIC) + 36], [], [], []

    def add(self, doc_id: int | None, frame: bytes, count: int) -> None:
        self.out.write(frame)
        self.offsets.append(self.offsets[-1] + len(frame))
        self.counts.append(count)
        self.ids.append(doc_id or 0)
        self.present.append(doc_id is not None)

    def close(self, part: int, number: int) -> tuple:
        for values, kind in ((self.ids, "<i8"), (self.offsets, "<u8"), (self.counts, "<u8"), (self.present, "u1")):
            self.out.write(np.array(values, kind).tobytes())
        self.out.write(struct.pack("<QQ", self.offsets[-1], len(self.ids)) + MAGIC)
        size = self.out.tell()
        self.out.close()
        return part, number, self.temporary, f"part-{part:06d}-{number:04d}.tok", size, len(self.ids), sum(self.counts)


def _writer(folder: str, tokenizer: str, end: int | None, width: int, dictionary: bytes) -> Callable:
    names = [x.split()[0] for x in MANIFEST.split(", ")]

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, done, file = memory(tokenizer).encode, TaskContext.get().partitionId(), [], None
        packer, kind = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary)), np.dtype(f"<u{width}")
        tail = np.array([] if end is None else [end], kind)
        for whole in parts:
            for batch in slices(whole, "text"):
                offsets, ids = encode(batch.column("text"))
                for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), offsets, offsets[1:]):
                    values = np.concatenate([ids[a:b].astype(kind), tail])
                    file = file or _File(folder, width, dictionary)
                    file.add(doc_id, packer.compress(values.tobytes()), len(values))
                    if file.offsets[-1] >= FILE_BYTES:
                        done.append(file.close(part, len(done)))
                        file = None
        if file:
            done.append(file.close(part, len(done)))
        rows = pd.DataFrame(done, columns=names).astype({"part": "int32", "number": "int32"})
        yield pa.RecordBatch.from_pandas(rows, preserve_index=False)

    return write


def write(docs: DataFrame, folder: str, tokenizer: str, end: int | None = None, width: int = 2) -> DataFrame:
    """Write the ids of all documents, each followed by ``end``, below ``folder``; returns the manifest.

    ``width`` 2 is for vocabularies of up to 65,536 ids. The dictionary is the file ``dictionary``.
    """
    docs = docs.select("doc_id", "text")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    dictionary = train_dictionary(docs, tokenizer, width)
    with files.create(folder, "dictionary") as out:
        out.write(dictionary)
    ranges = docs.repartitionByRange(int(total // RANGE_BYTES + 1), "doc_id").sortWithinPartitions("doc_id")
    return files.commit(ranges.mapInArrow(_writer(folder, tokenizer, end, width, dictionary), MANIFEST), folder)


class Reader:
    """Reads one file; checks that its dictionary is the given one."""

    def __init__(self, folder: str, name: str, dictionary: bytes) -> None:
        self.file = files.open_input(folder, name)
        head = self.file.read(len(MAGIC) + 36)
        self.file.seek(self.file.size() - 24)
        at, n, magic = struct.unpack("<QQ8s", self.file.read(24))
        if head[:8] != MAGIC or magic != MAGIC:
            raise ValueError(f"{name} is no token file")
        if head[12:44] != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{name} was written with another dictionary")
        self.kind = np.dtype(f"<u{struct.unpack('<I', head[8:12])[0]}")
        self.file.seek(at)
        read = lambda kind, k: np.frombuffer(self.file.read(np.dtype(kind).itemsize * k), kind)
        self.ids, self.offsets, self.counts, self.present = read("<i8", n), read("<u8", n + 1), read("<u8", n), read("u1", n)
        self.unpacker = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def document(self, k: int) -> np.ndarray:
        """The ids of the file's document ``k``."""
        self.file.seek(int(self.offsets[k]))
        frame = self.file.read(int(self.offsets[k + 1] - self.offsets[k]))
        return np.frombuffer(self.unpacker.decompress(frame, max_output_size=max(1, int(self.counts[k]) * self.kind.itemsize)), self.kind)


def read(manifest: DataFrame, folder: str, with_ids: bool = True) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32, ids)`` of every document in the files, in the files' order.

    ``start`` counts the ids before the document. The running total is over files, a bounded row each. Without
    ``with_ids`` the ids are read and checked, but stay in the task.
    """
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("name", "bytes", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    spread = placed.repartition(min(READERS, manifest.count() + 1), "name")
    names = ["doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]

    kinds = [*[pa.int64()] * 4, pa.list_(pa.int32())]

    def documents(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for name, base in zip(*(part.column(c).to_pylist() for c in ("name", "base")), strict=True):
                with files.open_input(folder, "dictionary") as f:
                    reader = Reader(folder, name, f.read())
                starts = base + np.concatenate([[0], np.cumsum(reader.counts)]).astype(np.int64)
                rows, size = [], 0
                for k in range(len(reader.ids)):
                    ids = reader.document(k)
                    crc = zlib.crc32(ids.astype("<u4").tobytes())
                    rows.append((int(reader.ids[k]) if reader.present[k] else None, int(starts[k]), len(ids), crc, *([ids.astype(np.int32)] if with_ids else [])))
                    size += len(ids)
                    if size > 500_000 or k == len(reader.ids) - 1:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
                        rows, size = [], 0

    return spread.mapInArrow(documents, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids)
