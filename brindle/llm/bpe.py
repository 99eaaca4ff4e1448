"""Byte-level BPE encoding and decoding with a published vocabulary.

Texts are split by the vocabulary's pattern into short words. A word is a contiguous
array of parts with the rank of every adjacent pair beside it: the smallest rank is found
by scanning, its boundary is deleted, and the ranks of its two neighbours are looked up again,
until no pair has a rank. All new words of a slice that have one length are scanned
together as one matrix. A word of more than ``LONG_WORD`` bytes would make repeated scans quadratic,
so it keeps its pairs in a heap, which merges in the same order.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.llm.kernels import slices

LONG_WORD = 96
CACHED_WORDS = 150_000
BLOCK_CELLS = 1 << 20
NO_RANK = np.int32(np.iinfo(np.int32).max)

# Fixed value: the pattern by which the vocabulary's words were split.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary file."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class Codec:
    """Vocabulary and merge ranks of one tokenizer file, with a bounded cache of encoded words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in merges]
        letters = byte_letters()
        byte_of = {letter: b for b, letter in enumerate(letters)}
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.byte_ids = np.array([vocab[letter] for letter in letters], dtype=np.int64)
        self.bytes_of = [b""] * (1 + max([*vocab.values(), *added.values()]))
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(byte_of[c] for c in token)
        for token, i in added.items():
            self.bytes_of[i] = token.encode()
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], dtype=np.int64)
        order = np.argsort(keys)
        self.pair_keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.pair_ranks = np.append(order.astype(np.int32), NO_RANK)
        self.merged = np.array([vocab[a + b] for a, b in merges] or [0], dtype=np.int64)
        self.added = {token: np.array([i], "<u4").tobytes() for token, i in added.items()}
        longest = sorted(map(regex.escape, added), key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(longest) + ")") if added else None
        self.pattern = regex.compile(PATTERN)
        self.cache: dict[str, bytes] = {}

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        found = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[found] == keys, self.pair_ranks[found], NO_RANK)

    def _encode_block(self, words: list[bytes]) -> list[bytes]:
        """Words of one length, merged side by side in a matrix of parts and one of ranks."""
        width = len(words[0])
        parts = self.byte_ids[np.frombuffer(b"".join(words), np.uint8).reshape(-1, width)]
        ranks = np.full((len(words), width), NO_RANK, dtype=np.int32)  # the last column stays empty
        ranks[:, :-1] = self.ranks(parts[:, :-1], parts[:, 1:])
        sizes = np.full(len(words), width)
        places = np.arange(width)
        live = np.arange(len(words))
        while True:
            spot = np.argmin(ranks[live], axis=1)
            best = ranks[live, spot]
            keep = best != NO_RANK
            live, spot, best = live[keep], spot[keep], best[keep]
            if len(live) == 0:
                break
            # Delete the boundary: parts and ranks behind it move one place to the left.
            source = np.minimum(places + (places > spot[:, None]), width - 1)
            part = np.take_along_axis(parts[live], source, 1)
            source = np.minimum(places + (places >= spot[:, None]), width - 1)
            rank = np.take_along_axis(ranks[live], source, 1)
            rank[:, -1] = NO_RANK
            row = np.arange(len(live))
            part[row, spot] = self.merged[best]
            sizes[live] -= 1
            # Refresh the ranks to the right and to the left of the new part.
            inner = spot + 1 < sizes[live]
            rank[row, spot] = NO_RANK
            rank[row[inner], spot[inner]] = self.ranks(part[row[inner], spot[inner]], part[row[inner], spot[inner] + 1])
            inner = spot > 0
            rank[row[inner], spot[inner] - 1] = self.ranks(part[row[inner], spot[inner] - 1], part[row[inner], spot[inner]])
            parts[live], ranks[live] = part, rank
        parts = parts.astype("<u4")
        return [parts[i, :n].tobytes() for i, n in enumerate(sizes.tolist())]

    def _encode_long(self, word: bytes) -> bytes:
        """One long word: a heap of ranked pairs over a linked list of parts."""
        parts = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        before, after = list(range(-1, len(parts) - 1)), [*range(1, len(parts)), -1]
        whole = np.array(parts, dtype=np.int64)
        first = self.ranks(whole[:-1], whole[1:]).tolist()
        heap = [(rank, i, parts[i], parts[i + 1]) for i, rank in enumerate(first) if rank != NO_RANK]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j < 0 or parts[j] != right:
                continue  # one of the two was merged meanwhile
            parts[i], parts[j], after[i] = int(self.merged[rank]), -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for a in (before[i], i):
                if a >= 0 and (b := after[a]) >= 0:
                    new = int(self.ranks(np.array([parts[a]]), np.array([parts[b]]))[0])
                    if new != NO_RANK:
                        heapq.heappush(heap, (new, a, parts[a], parts[b]))
        return np.array([p for p in parts if p >= 0], "<u4").tobytes()

    def learn(self, words: set[str]) -> None:
        """Encode words that the cache does not hold; the cache starts anew when it is full."""
        cache = self.cache
        missing = [w for w in words if w not in cache]
        if len(cache) + len(missing) > CACHED_WORDS:
            cache.clear()
            missing = list(words)
        by_length: dict[int, list[tuple[str, bytes]]] = {}
        for word in missing:
            raw = word.encode()
            by_length.setdefault(len(raw), []).append((word, raw))
        for length, group in by_length.items():
            if length > LONG_WORD:
                cache.update((word, self._encode_long(raw)) for word, raw in group)
                continue
            step = max(1, BLOCK_CELLS // length)
            for at in range(0, len(group), step):
                block = group[at : at + step]
                cache.update(zip((w for w, _ in block), self._encode_block([raw for _, raw in block])))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Token ids of each text as little-endian unsigned 32-bit integers."""
        pieces = []
        for text in texts:
            if self.special is not None and self.special.search(text):
                split = self.special.split(text)
                pieces.append([w for i, s in enumerate(split) for w in ([s] if i % 2 else self.pattern.findall(s))])
            else:
                pieces.append(self.pattern.findall(text))
        self.learn(set().union(*pieces) - self.added.keys())
        known = self.cache if not self.added else _Either(self.added, self.cache)
        found = known.__getitem__
        return [b"".join(map(found, words)) for words in pieces]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


class _Either(dict):
    """Added tokens first, then the cache."""

    def __init__(self, added: dict[str, bytes], cache: dict[str, bytes]):
        super().__init__(added)
        self.cache = cache

    def __missing__(self, key: str) -> bytes:
        return self.cache[key]


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of a file, loaded once per Python process."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _with(batch: pa.RecordBatch, values: pa.Array, name: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, name])


def encode(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "token_ids") -> DataFrame:
    """``df`` without its text and with an array of token ids in ``ids_col``.

    ``path`` names a byte-level BPE file of the tokenizers library, the same on every executor. Added
    tokens inside a text become their ids; truncation and padding are not applied. A NULL or empty text
    gives an empty array. Other columns are kept; ``ids_col`` replaces one of its own name.
    """
    others = [c for c in df.columns if c not in (text_col, ids_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            column = batch.column(len(others))
            rest = pa.RecordBatch.from_arrays(batch.columns[:-1] or [column], names=others or ["_text"])
            for first, last, _, _ in slices(column):
                texts = [t or "" for t in column.slice(first, last - first).to_pylist()]
                coded = coder.encode(texts)
                offsets = np.cumsum([0, *(len(c) // 4 for c in coded)]).astype(np.int32)
                values = np.frombuffer(b"".join(coded), "<u4").view(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
                if others:
                    yield _with(rest.slice(first, last - first), ids, ids_col)
                else:
                    yield pa.RecordBatch.from_arrays([ids], names=[ids_col])

    taken = df.select(*others, text_col)
    schema = T.StructType([*(df.schema[c] for c in others), T.StructField(ids_col, T.ArrayType(T.IntegerType()))])
    return taken.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids_col: str = "token_ids", text_col: str = "text") -> DataFrame:
    """``df`` with the text of its token ids in ``text_col``, special tokens included.

    A NULL array gives a NULL text, an empty one an empty text. Other columns are kept;
    ``text_col`` replaces one of its own name.
    """
    others = [c for c in df.columns if c != text_col]
    place = others.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            column = batch.column(place)
            texts = [None if ids is None else coder.decode(ids) for ids in arrays(column)]
            yield _with(batch, pa.array(texts, pa.string()), text_col)

    schema = T.StructType([*(df.schema[c] for c in others), T.StructField(text_col, T.StringType())])
    return df.select(*others).mapInArrow(run, schema)


def arrays(column: pa.Array) -> Iterator[np.ndarray | None]:
    """The rows of a list column as numpy arrays without a Python object per id."""
    values = column.values.to_numpy(zero_copy_only=False)
    offsets = column.offsets.to_numpy()
    valid = column.is_valid().to_pylist()
    for i, good in enumerate(valid):
        yield values[offsets[i] : offsets[i + 1]] if good else None


def digests(df: DataFrame, ids_col: str = "token_ids", text_col: str = "text") -> DataFrame:
    """``df`` with n_tokens, ids_sha256 and decoded_sha256 in place of its ids and text."""
    others = [c for c in df.columns if c not in (ids_col, text_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [None if ids is None else hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest() for ids in arrays(batch.column(len(others)))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], pa.array(hashes, pa.string())], names=[*others, "ids_sha256"])

    schema = T.StructType([*(df.schema[c] for c in others), T.StructField("n_tokens", T.LongType()), T.StructField("decoded_sha256", T.StringType()), T.StructField("ids_sha256", T.StringType())])
    own = df.select(*others, F.size(ids_col).cast("long").alias("n_tokens"), F.sha2(text_col, 256).alias("decoded_sha256"), ids_col)
    others = [*others, "n_tokens", "decoded_sha256"]
    return own.mapInArrow(run, schema)
