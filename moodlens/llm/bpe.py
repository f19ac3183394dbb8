"""BPE encoding and decoding with a prefix-sharing trie.

A text is cut at spaces, special tokens are taken out, the rest is normalised and split into words. The distinct
words that are new form a trie of byte symbols, the last symbol of a word being one with the end mark; in sorted
order they are its depth-first walk. The walk gives every prefix its last token: the one token that ends the prefix
and fits the last token of what stands before it. Two tokens fit if merging their symbols gives the same two tokens
back. Only tokens that end a prefix are tried: the longest end of it that begins a token names them. The encoding of
a prefix shared by many words is so worked out once, and a word's ids are read backwards from its end.

There is no shuffle and no vocabulary of the corpus: each task keeps the ids of at most ``CACHE`` distinct cuts
and as many distinct words, and of a full memory the more frequent half. Work arrives in slices of at most
``SLICE_BYTES`` of text, single long texts excepted.

Null texts are encoded like empty ones, to no ids. Rows are independent, so repeated rows give equal results; all
input columns pass through, and columns named like an output are replaced.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from moodlens.llm.cuts import CACHE, CutMemory, IdMemory, slices

#: Marks that the pattern never joins with letters.
MARKS = "!\"#$%&()*+,-./:;<=>?@[]^_`{|}~"
#: Characters of a word in which what it shares with another is looked for.
SHARED = 32
#: Remembered token pairs.
PAIRS = 500_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself, or the next free one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Bpe:
    """A tokenizer file of the kind: NFC, lower case, pattern split, byte symbols, merges with an end mark."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model.get("dropout") or model["unk_token"] or model["continuing_subword_prefix"] or not model["end_of_word_suffix"]:
            raise ValueError("the tokenizer file must hold merges with an end mark and no unknown token")
        self.end: str = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.merges = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.merges[self.vocab[a], self.vocab[b]] = (rank, self.vocab[a + b])
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*self.vocab.values(), *special.values()]) + 1
        self.tokens = [""] * size
        for text, i in [*self.vocab.items(), *special.items()]:
            self.tokens[i] = text
        self.special = special
        self.special_cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        (split,) = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.pattern = regex.compile(split)
        self.symbols = byte_symbols()
        self.table = dict(enumerate(self.symbols))
        # tokens by their text, without end mark and with it
        self.plain = {t: i for t, i in self.vocab.items() if not t.endswith(self.end) or t == self.end}
        self.ended = {t.removesuffix(self.end): i for t, i in self.vocab.items() if t.endswith(self.end) and t != self.end}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}
        self.width = [len(t.removesuffix(self.end)) or 1 for t in self.tokens]
        self.chains = self._chains()
        self.words = IdMemory(self.encode_pieces)
        self.memory = CutMemory(self.encode_cuts)

    # tokens and pairs

    def _parts(self, token: int) -> list[int]:
        text = self.tokens[token]
        ended = text.endswith(self.end) and text != self.end
        chars = list(text.removesuffix(self.end) if ended else text)
        if ended:
            chars[-1] += self.end
        return [self.vocab[c] for c in chars]

    def merged(self, parts: list[int]) -> list[int]:
        """Apply the merges to symbols, lowest rank first, leftmost first."""
        while len(parts) > 1:
            best = min(((self.merges[p][0], k) for k, p in enumerate(zip(parts, parts[1:])) if p in self.merges), default=None)
            if best is None:
                break
            k = best[1]
            parts = [*parts[:k], self.merges[parts[k], parts[k + 1]][1], *parts[k + 2 :]]
        return parts

    def _stands(self, token: int) -> bool:
        """Whether the token's own text is encoded as the token."""
        if token not in self.whole:
            self.whole[token] = self.merged(self._parts(token)) == [token]
        return self.whole[token]

    def _fits(self, left: int, right: int) -> bool:
        found = self.pairs.get((left, right))
        if found is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            found = self._stands(right) and self.merged(self._parts(left) + self._parts(right)) == [left, right]
            self.pairs[left, right] = found
        return found

    # the trie

    def _chains(self) -> dict[str, tuple[tuple[int, ...], tuple[int, ...]]]:
        """For every beginning of a token's text the tokens that end it, longest first, without end mark and with it."""
        texts = self.plain.keys() | self.ended.keys()
        found = {}
        for text in {t[:n] for t in texts for n in range(1, len(t) + 1)}:
            tails = [text[k:] for k in range(len(text))]
            found[text] = tuple(tuple(kind[t] for t in tails if t in kind) for kind in (self.plain, self.ended))
        return found

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids and ids of distinct words, given in byte symbols.

        In sorted order the words are the depth-first walk of their trie: what a word shares with the word before it
        is known, and the rest is a new branch.
        """
        order = sorted(range(len(words)), key=words.__getitem__)
        sizes, out = np.zeros(len(words), np.int64), []
        shared = _shared([words[k] for k in order])
        chains, pairs, width, none = self.chains, self.pairs, self.width, ((), ())
        longest = max(map(len, words), default=0) + 1
        # for each prefix of the word, by length: its last token, and how much of its end begins a token
        last, begun = [0] * longest, [0] * longest
        for k, known in zip(order, shared):
            word, n = words[k], len(words[k])
            for depth in range(known + 1, n + 1):
                at = depth - 1 - begun[depth - 1]
                chain = chains.get(word[at:depth])
                while chain is None and at < depth:
                    at += 1
                    chain = chains.get(word[at:depth])
                begun[depth] = depth - at
                for token in (chain or none)[depth == n]:
                    left = depth - width[token]
                    if left:
                        pair = (last[left], token)
                        fits = pairs.get(pair)
                        if fits is None:
                            fits = self._fits(*pair)
                    else:
                        fits = self._stands(token)
                    if fits:
                        break
                else:
                    raise ValueError(f"no encoding for {word[:depth]!r}")
                last[depth] = token
            ids, at = [], n
            while at:
                ids.append(last[at])
                at -= width[last[at]]
            sizes[k] = len(ids)
            out += ids[::-1]
        # from sorted order to the order given
        order, flat = np.array(order, np.int64), np.array(out, np.int32)
        starts = np.zeros(len(words), np.int64)
        starts[order] = np.cumsum(sizes[order]) - sizes[order]
        return sizes, flat[np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(flat))]

    # texts

    def _pieces(self, cut: str) -> list[int | str]:
        """The words of a cut in byte symbols, and the ids of special tokens."""
        out: list[int | str] = []
        for part in self.special_cut.split(cut) if self.special_cut and "<" in cut else [cut]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                text = unicodedata.normalize("NFC", part)
                text = (text.replace("Σ", "σ") if "Σ" in text else text).lower()
                for w in self.pattern.findall(text):
                    out.append(w if w.isascii() and w.isprintable() else "".join([self.symbols[b] for b in w.encode()]))
        return out

    def encode_pieces(self, pieces: list[int | str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids and ids of distinct words in byte symbols and of special tokens, which stand for themselves."""
        words = np.array([isinstance(p, str) for p in pieces], bool)
        sizes = np.ones(len(pieces), np.int64)
        sizes[words], flat = self.encode_words([p for p in pieces if isinstance(p, str)])
        of_word = np.repeat(words, sizes)
        ids = np.zeros(len(of_word), np.int32)
        ids[of_word], ids[~of_word] = flat, [p for p in pieces if not isinstance(p, str)]
        return sizes, ids

    def encode_cuts(self, cuts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids and ids of cuts, whose words are remembered by themselves."""
        pieces: list[int | str] = []
        counts = np.full(len(cuts), 2, np.int64)
        table, marks = self.table, MARKS
        for k, cut in enumerate(cuts):
            # most cuts are a word of letters and marks behind it, for which the pattern's answer is plain
            word = cut.rstrip(marks)
            if word.isalpha():
                if word.isascii():
                    pieces += (word.lower(), cut[len(word) :])
                    continue
                text = unicodedata.normalize("NFC", word)
                text = (text.replace("Σ", "σ") if "Σ" in text else text).lower()
                if text.isalpha():
                    pieces += (text.encode().decode("latin-1").translate(table), cut[len(word) :])
                    continue
            found = self._pieces(cut)
            pieces += found
            counts[k] = len(found)
        length, flat = self.words.gather(self.words.slots_of(pieces, CACHE))
        return np.diff(np.concatenate([[0], np.cumsum(length)])[np.concatenate([[0], np.cumsum(counts)])]), flat

    def decode(self, ids: list[int] | None) -> str:
        """The tokens of the ids joined by a space; ids without a token are left out."""
        tokens, ids = self.tokens, ids or []
        if ids and not 0 <= min(ids) <= max(ids) < len(tokens):
            ids = [i for i in ids if 0 <= i < len(tokens)]
        return " ".join(map(tokens.__getitem__, ids))


def _shared(words: list[str]) -> list[int]:
    """How much each of sorted words shares with the word before it, short of that word's end, up to ``SHARED``."""
    if not words:
        return []
    chars = np.array(words, f"U{SHARED}").view(np.uint32).reshape(len(words), SHARED)
    differs = np.concatenate([chars[1:] != chars[:-1], np.ones((len(words) - 1, 1), bool)], axis=1)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    return [0, *np.minimum(differs.argmax(axis=1), np.minimum(sizes[:-1], sizes[1:]) - 1).clip(0).tolist()]


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    return Bpe(path)


def _with_column(df: DataFrame, name: str, kind: object) -> tuple[DataFrame, StructType]:
    kept = df.drop(name)
    return kept, StructType([*kept.schema.fields, StructField(name, kind)])


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids", decoded: str | None = None, keep_text: bool = True) -> DataFrame:
    """``docs`` with the token ids of ``text``. ``path`` is the tokenizer file, present on every executor.

    ``decoded`` names a column for the text decoded from the ids, in the same pass as encoding: one worker per task
    holds the tokenizer, and ids do not travel twice. Without ``keep_text`` the input text is left out.
    """
    kept, schema = _with_column(docs, out, ArrayType(IntegerType()))
    if decoded:
        kept = kept.drop(decoded)
        schema = StructType([f for f in schema.fields if f.name != decoded] + [StructField(decoded, StringType())])
    if not keep_text:
        schema = StructType([f for f in schema.fields if f.name != text])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for whole in parts:
            for part in slices(whole, text):
                offsets, ids = bpe.memory.encode(part.column(text))
                columns = {n: c for n, c in zip(part.schema.names, part.columns) if keep_text or n != text}
                columns[out] = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))
                if decoded:
                    columns[decoded] = pa.array([bpe.decode(ids[a:b].tolist()) for a, b in zip(offsets, offsets[1:])], pa.string())
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return kept.mapInArrow(batches, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text of its token ids."""
    kept, schema = _with_column(df, out, StringType())

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for whole in parts:
            for part in slices(whole, ids):
                lists = part.column(ids)
                flat, ends = pc.fill_null(lists.flatten(), -1).to_numpy(), np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
                texts = [bpe.decode(flat[a:b].tolist()) for a, b in zip([0, *ends], ends)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, out])

    return kept.mapInArrow(batches, schema)
