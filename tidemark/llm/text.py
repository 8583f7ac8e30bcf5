"""Arrow text columns as byte arrays, and vectorised word hashes over them.

Shared by the operators of this package.  A *word* is a maximal run of bytes
other than ``0x20`` and ``0x09``-``0x0D``; words are hashed with A-Z lowered.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

SLICE_BYTES = 1 << 19  # text handled at once; a longer single text is one slice
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_WORD = np.ones(256, dtype=bool)
_WORD[[0x20, 9, 10, 11, 12, 13]] = False
# Runs of ASCII letters, digits and all bytes beyond ASCII: words without punctuation.
LETTERS = np.zeros(256, dtype=bool)
LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# One fixed pseudo-random 64-bit value a byte; FOLDED gives A-Z the values of a-z.
BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
FOLDED = BYTES.copy()
FOLDED[65:91] = BYTES[97:123]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to n."""
    if len(_powers.get("up", ())) <= n:
        size = max(n + 1, SLICE_BYTES + (SLICE_BYTES >> 2))
        for name, factor in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, factor, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def prefix_hash(data: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Prefix sums whose differences hash every substring (see ``span_hash``)."""
    up, _ = powers(len(data))
    out = np.empty(len(data) + 1, dtype=np.uint64)
    out[0] = 0
    terms = values[data]
    terms *= up[: len(data)]
    np.cumsum(terms, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def text_array(column) -> pa.Array:
    """A text column of one batch: null becomes the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    return pc.fill_null(column, "") if column.null_count else column


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it


def release() -> None:
    """Hand freed memory back to the system: idle workers stay beside busy ones on an executor."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def slices(column, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of consecutive rows of about ``limit`` bytes."""
    array = text_array(column)
    n = len(array)
    if n == 0:
        return
    kind = np.int64 if pa.types.is_large_string(array.type) else np.int32
    offsets = np.frombuffer(array.buffers()[1], dtype=kind)[array.offset : array.offset + n + 1].astype(np.int64)
    raw = array.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        end = min(end, n)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end
    release()


def word_spans(data: np.ndarray, offsets: np.ndarray, word: np.ndarray = _WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each text the range of its words."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = word[data]
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    before[offsets[offsets < n]] = False
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    after[offsets[offsets > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, word: np.ndarray = _WORD) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word, and for each text the range of its words."""
    starts, ends, places = word_spans(data, offsets, word)
    return span_hash(prefix_hash(data, FOLDED), starts, ends), places


def owners(places: np.ndarray) -> np.ndarray:
    """The text number of each element of consecutive ranges."""
    return np.repeat(np.arange(len(places) - 1), np.diff(places))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each range, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def list_array(values: np.ndarray, places: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(places, type=pa.int32()), pa.array(values, type=kind))


def narrow(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so clashing extra ones never meet an operator's own."""
    return df.select(*[df[c] for c in columns])


def parts(spark) -> int:
    """Tasks the cluster is set to shuffle into."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned 64-bit numbers as compressed differences."""
    steps = np.diff(values.astype(np.uint64), prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    return pack_bytes(np.ascontiguousarray(steps))


def unpack_sorted(blob: bytes) -> np.ndarray:
    steps = np.frombuffer(unpack_bytes(blob), dtype=np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(steps).view(np.uint64).ravel(), dtype=np.uint64)


def pack_bytes(values: np.ndarray) -> bytes:
    raw = values.tobytes()
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def unpack_bytes(blob: bytes) -> bytes:
    size = int.from_bytes(blob[:8], "little")
    return pa.decompress(blob[8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def sums_by_text(values: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Sum of the rows of ``values`` in each range (0 for an empty one)."""
    out = np.zeros((len(places) - 1, *values.shape[1:]), dtype=np.float64)
    full = np.flatnonzero(np.diff(places) > 0)
    if len(full):
        out[full] = np.add.reduceat(values, places[full], axis=0, dtype=np.float64)
    return out


def pack_arrays(**arrays: np.ndarray) -> bytes:
    """Columns of one length as a compressed Arrow stream."""
    batch = pa.RecordBatch.from_arrays([pa.array(v) for v in arrays.values()], list(arrays))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack_arrays(blobs) -> dict[str, np.ndarray]:
    """The columns of several packed blobs, one after the other."""
    release()
    tables = [pa.ipc.open_stream(blob).read_all() for blob in blobs]
    whole = pa.concat_tables(tables)
    return {name: whole.column(name).to_numpy() for name in whole.column_names}


def pack_columns(arrays: dict[str, np.ndarray]) -> bytes:
    """Columns of one length, compressed together: a blob of few rows costs little more than the rows."""
    return pack_bytes(np.concatenate([np.ascontiguousarray(v).view(np.uint8) for v in arrays.values()]))


def unpack_columns(blobs: list[bytes], kinds: dict[str, type]) -> dict[str, np.ndarray]:
    """The columns of several blobs of ``pack_columns``, one after the other; ``kinds`` names them in order."""
    release()
    width = sum(np.dtype(kind).itemsize for kind in kinds.values())
    sizes = [int.from_bytes(blob[:8], "little") // width for blob in blobs]
    out = {name: np.empty(sum(sizes), kind) for name, kind in kinds.items()}
    at = 0
    for blob, size in zip(blobs, sizes):
        raw, start = unpack_bytes(blob), 0
        for values in out.values():
            values[at : at + size] = np.frombuffer(raw, values.dtype, size, start)
            start += size * values.itemsize
        at += size
    return out


def split_by(part: np.ndarray, count: int, arrays: dict[str, np.ndarray]):
    """(part, its arrays) for every part that has elements."""
    order = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[order], np.arange(count + 1))
    for k in range(count):
        if edges[k + 1] > edges[k]:
            own = order[edges[k] : edges[k + 1]]
            yield k, {name: values[own] for name, values in arrays.items()}
