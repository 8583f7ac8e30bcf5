"""Byte-level BPE with the tiktoken library and a local rank file.

A text is cut at *safe boundaries* - between a character that is surely not
white space and a space, tab or line end - where no match of the splitting
pattern can reach across.  The chunks between them repeat a lot, so a worker
remembers the ids of recent chunks and encodes the new ones of a slice of texts
in one call (a chunk that opens with white space may stand behind any other).
Chunks are found by 64-bit hash and then compared byte by byte; a slice with a
clash is encoded text by text.

Cases: null and empty texts have no ids and decode to no bytes; special tokens
are ordinary text; a white-space run that no pattern library can match in one
go is taken apart by the pattern's own rule; every id has its bytes, so
decoding returns raw bytes whether or not they are UTF-8; an unknown or null id
raises ValueError; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame

from .catalog import query, table
from .text import BYTES, list_array, narrow, prefix_hash, ranges, slices, span_hash

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LONG_SPACE = 50_000  # white-space runs up to this length go to the library whole
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 9, 10, 13]] = True
# Last bytes of characters that may be white space beyond ASCII.
_DOUBTFUL = np.zeros(256, dtype=bool)
_DOUBTFUL[list(range(0x80, 0x8B)) + [0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True
_DOUBTFUL[:0x21] = True
_DOUBTFUL[0x7F] = True


def byte_alphabet() -> dict[str, int]:
    """The characters by which tokenizer files write bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a tiktoken file, or of a tokenizers file whose ids are in merge order."""
    if not path.endswith(".json"):
        with open(path, "rb") as lines:
            return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    special = {x["content"] for x in spec.get("added_tokens", [])}
    alphabet = byte_alphabet()
    return {bytes(alphabet[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}


def read_specials(path: str) -> dict[bytes, int]:
    """Special tokens that a tokenizers file finds in texts."""
    if not path.endswith(".json"):
        return {}
    with open(path, encoding="utf-8") as file:
        return {x["content"].encode(): x["id"] for x in json.load(file).get("added_tokens", [])}


class Pool:
    """An array that grows at its end."""

    def __init__(self, kind):
        self.data = np.zeros(1 << 16, dtype=kind)
        self.size = 0

    def add(self, values: np.ndarray) -> int:
        start = self.size
        self.size += len(values)
        if self.size > len(self.data):
            grown = np.zeros(max(self.size, 2 * len(self.data)), dtype=self.data.dtype)
            grown[:start] = self.data[:start]
            self.data = grown
        self.data[start : self.size] = values
        return start


class Memo:
    """Chunks met so far with their bytes and ids, in a direct-mapped table by hash.  Forgotten whole once it is full."""

    SLOTS, CHUNKS, BYTES = 1 << 19, 400_000, 8 << 20

    def __init__(self):
        self.slot_keys = np.zeros(self.SLOTS, dtype=np.uint64)
        self.slot_chunks = np.full(self.SLOTS, -1, dtype=np.int32)
        self.sources, self.sizes, self.places, self.counts = (Pool(np.int64) for _ in range(4))
        self.bytes, self.ids = Pool(np.uint8), Pool(np.uint32)

    def full(self) -> bool:
        return self.sizes.size > self.CHUNKS or self.bytes.size > self.BYTES

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Chunk number of each key, below 0 where it is not held."""
        slots = (keys & np.uint64(self.SLOTS - 1)).astype(np.int64)
        return np.where(self.slot_keys[slots] == keys, self.slot_chunks[slots], -1)

    def add(self, keys, data, sizes, ids, counts) -> np.ndarray:
        self.sources.add(self.bytes.add(data) + np.cumsum(sizes) - sizes)
        self.places.add(self.ids.add(ids) + np.cumsum(counts) - counts)
        self.counts.add(counts)
        chunks = self.sizes.add(sizes) + np.arange(len(sizes))
        slots = (keys & np.uint64(self.SLOTS - 1)).astype(np.int64)
        self.slot_keys[slots] = keys
        self.slot_chunks[slots] = chunks
        return chunks


class Codec:
    """Vectorised encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        ranks = read_ranks(path)
        self.specials = read_specials(path)
        self.encoding = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        pieces = [b""] * (max(ranks.values()) + 1)
        for piece, i in ranks.items():
            pieces[i] = piece
        self.memo = Memo()
        self.known = np.array([bool(p) for p in pieces])
        self.lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        decimal = [f"{i},".encode() for i in range(len(pieces))]
        self.digits = np.frombuffer(b"".join(decimal), dtype=np.uint8)
        self.digit_lengths = np.array([len(x) for x in decimal], dtype=np.int64)
        self.digit_starts = np.cumsum(self.digit_lengths) - self.digit_lengths

    def encode_text(self, text: str) -> list[int]:
        """One text, or one chunk between safe boundaries."""
        if len(text) <= LONG_SPACE:
            return self.encoding.encode_ordinary(text)
        return self._encode_long(text)

    def _encode_long(self, text: str) -> list[int]:
        # A run of white space gives all but its last character to one match when more text follows.
        out: list[int] = []
        start = at = 0
        n = len(text)
        while at < n:
            if not text[at].isspace():
                at += 1
                continue
            end = at
            while end < n and text[end].isspace():
                end += 1
            if end - at > LONG_SPACE:
                if at > start:
                    out += self.encoding.encode_ordinary(text[start:at])
                head = end if end == n else end - 1
                out += self._long_piece(text[at:head])
                start = head
            at = end
        return out + self.encoding.encode_ordinary(text[start:])

    def _long_piece(self, text: str) -> list[int]:
        return self.encoding._encode_single_piece(text.encode())

    def boundaries(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Starts of the chunks: text starts and safe boundaries, ascending."""
        cut = _BLANK[data]
        last = np.empty(len(data), dtype=np.uint8)
        last[0], last[1:] = 0x20, data[:-1]
        doubtful = _DOUBTFUL[last]
        lead = np.zeros(len(data), dtype=np.uint8)
        lead[2:] = data[:-2]
        doubtful &= ~((last >= 0x80) & (lead >= 0xC3) & (lead <= 0xDF))
        cut &= ~doubtful
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
        return np.flatnonzero(cut)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slice, and for each text the range of its ids."""
        if len(data) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        starts = self.boundaries(data, offsets)
        sizes = np.diff(np.append(starts, len(data)))
        keys = span_hash(prefix_hash(data, BYTES), starts, starts + sizes)
        if self.memo.full():
            self.memo = Memo()
        memo = self.memo
        at = memo.find(keys)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new, first, which = np.unique(keys[missing], return_index=True, return_inverse=True)
            first = missing[first]
            at[missing] = self._learn(memo, data, starts[first], sizes[first], new)[which]
        if not np.array_equal(memo.sizes.data[at], sizes) or not np.array_equal(
            memo.bytes.data[ranges(memo.sources.data[at], sizes)], data
        ):
            return self._plainly(data, offsets)
        each = memo.counts.data[at]
        upto = np.concatenate([[0], np.cumsum(each)])
        return memo.ids.data[ranges(memo.places.data[at], each)], upto[np.searchsorted(starts, offsets)]

    def _learn(self, memo: Memo, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Encode chunks not held yet; those that open with white space and close with something else in one call."""
        fits = _BLANK[data[starts]] & ~_DOUBTFUL[data[starts + sizes - 1]] & (sizes < LONG_SPACE)
        ids: list[np.ndarray] = []
        counts = np.zeros(len(starts), dtype=np.int64)
        if fits.any():
            text = data[ranges(starts[fits], sizes[fits])].tobytes().decode()
            got = np.array(self.encoding.encode_ordinary(text), dtype=np.uint32)
            places = np.searchsorted(np.cumsum(self.lengths[got]), np.cumsum(sizes[fits]), side="left") + 1
            counts[fits] = np.diff(places, prepend=0)
            ids.append(got)
        for i in np.flatnonzero(~fits):
            got = self.encode_text(data[starts[i] : starts[i] + sizes[i]].tobytes().decode())
            counts[i] = len(got)
            ids.append(np.array(got, dtype=np.uint32))
        order = np.concatenate([np.flatnonzero(fits), np.flatnonzero(~fits)])
        chunks = np.empty(len(starts), dtype=np.int64)
        chunks[order] = memo.add(
            keys[order], data[ranges(starts[order], sizes[order])], sizes[order], np.concatenate(ids), counts[order]
        )
        return chunks

    def encode_specials(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, but special tokens of the file written in a text get their ids, as the tokenizers library does."""
        ids, places = self.encode(data, offsets)
        raw = data.tobytes() if self.specials else b""
        if not any(token in raw for token in self.specials):
            return ids, places
        split = re.compile(b"(" + b"|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + b")")
        out = []
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            found = split.split(raw[a:b])
            if len(found) == 1:
                out.append(ids[places[i] : places[i + 1]])
                continue
            flat = [j for x in found for j in ([self.specials[x]] if x in self.specials else self.encode_text(x.decode()))]
            out.append(np.array(flat, dtype=np.uint32))
        return np.concatenate(out), np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int64)

    def _plainly(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        lists = [self.encode_text(raw[a:b].decode()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        flat = np.array([i for x in lists for i in x], dtype=np.uint32)
        return flat, np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)

    def decode(self, ids: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all id lists, and for each list the range of its bytes."""
        if len(ids) and (int(ids.max()) >= len(self.known) or not self.known[ids].all()):
            raise ValueError("an id is outside the vocabulary")
        size = self.lengths[ids]
        upto = np.concatenate([[0], np.cumsum(size)])
        return self.bytes[ranges(self.starts[ids], size)], upto[places]

    def decimals(self, ids: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``1,22,333,`` for all id lists, with a closing comma each."""
        size = self.digit_lengths[ids]
        upto = np.concatenate([[0], np.cumsum(size)])
        return self.digits[ranges(self.digit_starts[ids], size)], upto[places]


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    """One codec for each file and worker."""
    return Codec(path)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS) -> DataFrame:
    """Columns ``id_col`` and ``ids`` (array of int), one row per row."""

    def run(batches):
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(1)):
                ids, places = codec(ranks).encode(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), list_array(ids.astype(np.int32), places, pa.int32())], [id_col, "ids"]
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return narrow(docs, id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def _id_lists(column) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    places = np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
    values = column.flatten()
    if values.null_count:
        raise ValueError("an id is null")
    return values.to_numpy(zero_copy_only=False), places


def decode(rows: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", ranks: str = RANKS) -> DataFrame:
    """Columns ``id_col``, ``ids`` and ``decoded`` (raw bytes)."""

    def run(batches):
        for batch in batches:
            step = 256
            for a in range(0, batch.num_rows, step):
                ids, places = _id_lists(batch.column(1).slice(a, step))
                data, offsets = codec(ranks).decode(ids, places)
                raw = data.tobytes()
                out = [raw[s:e] for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, step), batch.column(1).slice(a, step), pa.array(out, pa.binary())], [id_col, "ids", "decoded"]
                )

    kind = rows.schema[id_col].dataType.simpleString()
    return narrow(rows, id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, decoded binary")


def digest_columns(rows: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", ranks: str = RANKS) -> DataFrame:
    """Id count, digest of the ids, and digest of what ``decode`` returns for them."""

    def run(batches):
        own = codec(ranks)
        for batch in batches:
            step = 128
            for a in range(0, batch.num_rows, step):
                part = batch.slice(a, step)
                ids, places = _id_lists(part.column(1))
                sums = []
                for cut, (data, offsets) in ((1, own.decimals(ids, places)), (0, own.decode(ids, places))):
                    view = memoryview(data)
                    pairs = zip(offsets[:-1].tolist(), offsets[1:].tolist())
                    sums.append(pa.array([hashlib.sha256(view[s : max(s, e - cut)]).hexdigest() for s, e in pairs], pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(places), pa.int64()), *sums], [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
                )

    kind = rows.schema[id_col].dataType.simpleString()
    return narrow(rows, id_col, ids_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )


@query("op1_bpe")
def op1_bpe(spark, sf_dir):
    return digest_columns(encode(table(spark, sf_dir, "documents")))
