"""Byte-level BPE encoding and decoding in batched numpy merge rounds.

New words of a batch lie in one flat array of symbols. A round packs every neighbouring
pair into one integer key, finds its rank by binary search over the sorted keys of the
merge table, takes the lowest rank of each word and merges all its pairs of that rank,
left ones first. A merge never makes a pair of a lower rank, so that equals merging one
pair after the other. Rounds end when no word has a pair of the table.

Nulls: a null text counts as empty and has no ids. Repeated rows are encoded alike; an
empty table gives no rows; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from callgrove.llm.common import table
from callgrove.llm.tokens import ByteUnits, byte_letters

TOKENIZER = "byte_bpe_50k.json"
#: Fixed value: the pre-tokenizer pattern of the public byte-level BPE.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


class Merges:
    """The merge table: sorted pair keys with rank and result, and the bytes of each id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        letters = byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        spelled = [b""] * size
        for token, number in vocab.items():
            spelled[number] = bytes(letters[c] for c in token)
        for token, number in self.special.items():
            spelled[number] = token.encode()
        self.spelling = Spelling(spelled)
        self.decimals = Spelling([b"%d," % number for number in range(size)])
        self.byte_ids = np.array([vocab[letter] for letter, _ in sorted(letters.items(), key=lambda x: x[1])], np.int64)
        self.size = size
        pairs = [merge.split(" ") if isinstance(merge, str) else merge for merge in merges]
        keys = np.array([vocab[a] * size + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order
        self.results = np.array([vocab[a + b] for a, b in pairs], np.int64)

    def encode(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word."""
        sizes = np.array([len(w) for w in words], np.int64)
        symbols = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        done_symbols, done_words = [], []
        none = len(self.results)
        while len(symbols):
            keys = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            rank = np.full(len(symbols), none)
            rank[:-1] = np.where((self.keys[at] == keys) & (word[1:] == word[:-1]), self.ranks[at], none)
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.minimum.reduceat(rank, starts)
            per = np.repeat(lowest, np.diff(np.r_[starts, len(word)]))
            finished = per == none
            if finished.any():
                # Words without a pair leave the array; the others go on.
                done_symbols.append(symbols[finished])
                done_words.append(word[finished])
                symbols, word, rank, per = symbols[~finished], word[~finished], rank[~finished], per[~finished]
                if not len(symbols):
                    break
            chosen = rank == per
            # In a run of overlapping pairs every second one merges, from the left.
            index = np.arange(len(chosen))
            begins = chosen & ~np.r_[False, chosen[:-1]]
            run_start = np.maximum.accumulate(np.where(begins, index, 0))
            chosen &= (index - run_start) % 2 == 0
            symbols = np.where(chosen, self.results[np.minimum(rank, none - 1)], symbols)
            kept = ~np.r_[False, chosen[:-1]]
            symbols, word = symbols[kept], word[kept]
        if not done_words:
            return [np.zeros(0, np.int64) for _ in words]
        all_words, all_symbols = np.concatenate(done_words), np.concatenate(done_symbols)
        order = np.argsort(all_words, kind="stable")
        ends = np.cumsum(np.bincount(all_words, minlength=len(words)))
        return np.split(all_symbols[order], ends[:-1])

    def decode(self, ids: np.ndarray) -> str:
        return self.spelling.join(ids).decode("utf-8", "replace")


class Spelling:
    """Byte strings by id, joined for many ids at once."""

    def __init__(self, strings: list[bytes]):
        self.sizes = np.array([len(s) for s in strings], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(strings), np.uint8)

    def join(self, ids: np.ndarray) -> bytes:
        sizes = self.sizes[ids]
        shift = self.starts[ids] - (np.cumsum(sizes) - sizes)
        return self.flat[np.arange(sizes.sum()) + np.repeat(shift, sizes)].tobytes()


class NumpyUnits(ByteUnits):
    """Units encoded by :class:`Merges` instead of the library."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.special = self.merges.special
        self.known = {}
        self.forget()

    def encode_new(self, units: list[str]) -> list[bytes]:
        split = [[w.encode("utf-8") for w in PATTERN.findall(unit)] for unit in units]
        words = list({w for parts in split for w in parts})
        ids = dict(zip(words, (x.astype("<u4").tobytes() for x in self.merges.encode(words)), strict=True))
        return [b"".join(ids[w] for w in parts) for parts in split]


@lru_cache(2)
def codec(path: str) -> NumpyUnits:
    return NumpyUnits(path)


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded): ids as little-endian unsigned 32-bit, and what they decode to."""
    return _mapped(docs, path, "ids binary, decoded string", lambda units, ids, raw: (raw, units.merges.decode(ids)))


def _mapped(docs: DataFrame, path: str | None, fields: str, result) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    file = path or public_tokenizers.path(TOKENIZER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = codec(file)
        names = [f.split()[0] for f in fields.split(", ")]
        types = {"binary": pa.binary(), "string": pa.string(), "long": pa.int64()}
        kinds = [types[f.split()[1]] for f in fields.split(", ")]
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [text.as_py() or "" for text in part.column("text")]
                rows = [result(units, np.frombuffer(raw, "<u4"), raw) for raw in units.many(texts)]
                columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                    ["doc_id", *names],
                )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {fields}")


def _digests(units: NumpyUnits, ids: np.ndarray, raw: bytes) -> tuple:
    decimal = units.merges.decimals.join(ids)[:-1]
    decoded = units.merges.decode(ids).encode("utf-8")
    return len(ids), hashlib.sha256(decimal).hexdigest(), hashlib.sha256(decoded).hexdigest()


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return _mapped(docs, None, "n_tokens long, ids_sha256 string, decoded_sha256 string", _digests)
