"""Harmonic packing of token sequences into bins of a fixed capacity.

Class k holds pieces of more than capacity / (k + 1) and at most capacity / k
tokens, and each of its bins takes exactly k of them.  Every task fills its own
bins; no piece of one task waits for another's.  Documents may be cut, so each
is first cut to lengths that fill their class nearly exactly: whole bins, then
the largest capacity / k that fits, and so on, until what is left wastes less
than ``slack`` of a bin or is ``tail`` tokens at most.  The pieces of the bins
a task could not fill are strung together and cut anew at the capacity, and the
last, incomplete string at powers of two, so they need no padding.

A task holds its open bins (fewer than 2 * sqrt(capacity) of them), never a
group of rows.  A task that is run again yields the same bins as long as it gets
the same rows in the same order, as from a scan; ``pack`` is meant for scans.

Cases: null and empty texts are the closing id alone; a text of any length is
cut; rows that repeat are packed each; an empty table gives an empty table;
columns besides the id and the text never matter.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .bpe import codec
from .catalog import query, table
from .text import narrow, slices

CAPACITY = 2048
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END = 1  # the id that closes each document
SLACK, TAIL = 1 / 256, 64


@lru_cache(maxsize=4)
def cuts(capacity: int, slack: float = SLACK, tail: int = TAIL) -> list[tuple[int, ...]]:
    """Piece lengths for each rest below the capacity."""
    out: list[tuple[int, ...]] = [()]
    for rest in range(1, capacity):
        k = capacity // rest
        if rest <= tail or capacity - k * rest <= slack * capacity:
            out.append((rest,))
        else:
            head = capacity // (k + 1)
            out.append((head, *out[rest - head]))
    return out


class Bins:
    """Open bins of one task; ``take`` and ``finish`` yield rows (piece, sequence, offset)."""

    def __init__(self, capacity: int, first: int):
        self.capacity, self.next = capacity, first
        self.open: dict[int, list] = {}

    def place(self, pieces):
        offset = 0
        for piece in pieces:
            yield piece, self.next, offset
            offset += piece[2]
        self.next += 1

    def take(self, piece):
        k = self.capacity // piece[2]
        if k == 1:
            return self.place([piece])
        waiting = self.open.setdefault(k, [])
        waiting.append(piece)
        if len(waiting) < k:
            return ()
        del self.open[k]
        return self.place(waiting)

    def finish(self):
        row, room = [], self.capacity
        for piece in (p for k in sorted(self.open) for p in self.open[k]):
            for part in iter_cut(piece, room, self.capacity):
                row.append(part)
                room -= part[2]
                if room == 0:
                    yield from self.place(row)
                    row, room = [], self.capacity
        total = self.capacity - room
        for power in (1 << i for i in range(total.bit_length() - 1, -1, -1) if total >> i & 1):
            head, rest, left = [], [], power
            for piece in row:
                if left == 0:
                    rest.append(piece)
                    continue
                parts = list(iter_cut(piece, left, piece[2]))
                head.append(parts[0])
                left -= parts[0][2]
                rest += parts[1:]
            yield from self.place(head)
            row = rest


def iter_cut(piece, room: int, capacity: int):
    """A piece (row, start, length, document's tokens, ids) cut after ``room`` and then every ``capacity`` tokens."""
    row, start, length, tokens, ids = piece
    at = 0
    while at < length:
        size = min(room, length - at)
        yield row, start + at, size, tokens, ids[at : at + size]
        at += size
        room = capacity


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    tokenizer: str = TOKENIZER,
    end_id: int = END,
) -> DataFrame:
    """One row a piece: id, start, length, doc_tokens, sequence_id, offset, ids."""
    names = [id_col, "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]

    def batch_of(rows, kind):
        keys, columns = [], [[] for _ in range(5)]
        for (key, start, length, tokens, _), sequence, offset in rows:
            keys.append(key)
            for column, value in zip(columns, (start, length, tokens, sequence, offset)):
                column.append(value)
        ids = np.concatenate([r[0][4] for r in rows]).view(np.int32)
        places = np.concatenate([[0], np.cumsum(columns[1])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(places), pa.array(ids))
        return pa.RecordBatch.from_arrays([pa.array(keys, kind), *[pa.array(c, pa.int64()) for c in columns], lists], names)

    def run(batches):
        bins = Bins(capacity, TaskContext.get().partitionId() << 33)
        table_of_cuts, kind = cuts(capacity), None
        for batch in batches:
            kind = batch.schema.field(0).type
            for a, b, data, offsets in slices(batch.column(1)):
                ids, places = codec(tokenizer).encode_specials(data, offsets)
                keys, out = batch.column(0).slice(a, b - a).to_pylist(), []
                for key, s, e in zip(keys, places[:-1].tolist(), places[1:].tolist()):
                    tokens = e - s + 1
                    own = np.append(ids[s:e], np.uint32(end_id))
                    full = tokens // capacity
                    start = 0
                    for length in (*(capacity,) * full, *table_of_cuts[tokens - full * capacity]):
                        out += bins.take((key, start, length, tokens, own[start : start + length]))
                        start += length
                if out:
                    yield batch_of(out, kind)
        if bins.open:
            yield batch_of(list(bins.finish()), kind)

    kind = docs.schema[id_col].dataType.simpleString()
    return narrow(docs, id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids array<int>"
    )


def checksums(pieces: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The pieces with ``ids_crc32`` (of the ids as little-endian unsigned 32-bit numbers) in place of the ids."""
    columns = [id_col, "start", "length", "doc_tokens", "sequence_id", "offset"]

    def run(batches):
        for batch in batches:
            lists = batch.column(6)
            values = np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False), dtype="<u4").view(np.uint8)
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)) * 4
            view = memoryview(values)
            sums = [zlib.crc32(view[a:b]) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(sums, pa.int64())], [*columns, "ids_crc32"])

    kind = pieces.schema[id_col].dataType.simpleString()
    return narrow(pieces, *columns, "ids").mapInArrow(
        run, f"`{id_col}` {kind}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids_crc32 bigint"
    )


@query("op2_packing")
def op2_packing(spark, sf_dir):
    pieces = checksums(pack(table(spark, sf_dir, "documents")))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
