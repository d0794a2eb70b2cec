"""Vectorised views of text columns: words, hashes and per-document sums over byte blocks.

Arrow hands a task its texts as one byte buffer with offsets.  The helpers
here work on blocks of that buffer (about two megabytes, at least one whole
document), so memory is bounded by the longest document and no per-word
Python object is made.

Hashes are 64-bit: bytes are mapped to fixed random odd-multiplied values,
summed with powers of an odd base (prefix sums give every word's hash at
once) and mixed.  Equal words always have equal hashes; different ones
collide with a chance of about 2^-64 a pair.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T

from ._stage import small_batches

BLOCK_BYTES = 1 << 21

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 1 << 64)
_powers = {"n": 0, "up": np.ones(0, np.uint64), "down": np.ones(0, np.uint64)}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: bytes of ``[^\x20\x09-\x0D]``
SPACED = np.ones(256, bool)
SPACED[[9, 10, 11, 12, 13, 32]] = False
#: bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` (after lower-casing A-Z)
PLAIN = np.zeros(256, bool)
PLAIN[48:58] = PLAIN[97:123] = PLAIN[128:] = True
#: first byte of a code point
LEAD = (np.arange(256) & 0xC0) != 0x80


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers["n"] < n:
        size = max(n, min(BLOCK_BYTES, 1 << (n - 1).bit_length()) + 1)
        for key, base in (("up", _BASE), ("down", _INV)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[key] = np.multiply.accumulate(table)
        _powers["n"] = size
    return _powers["up"][:n], _powers["down"][:n]


def prefix_hash(raw: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``span_hash`` takes the hash of any byte span."""
    up, _ = _power_tables(len(raw) + 1)
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[: len(raw)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span; equal bytes give equal hashes wherever they stand."""
    _, down = _power_tables(len(prefix))
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(_INV))


def sliding_hash(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive entries of ``h``."""
    n = len(h) - k + 1
    out = np.zeros(max(n, 0), np.uint64)
    for j in range(k if n > 0 else 0):
        out = out * np.uint64(_BASE) + h[j : j + n]
    return mix(out)


def span_words(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of each maximal run of bytes that ``table`` admits; runs never cross documents."""
    n = len(raw)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = table[raw]
    filled = offsets[:-1] < offsets[1:]
    first, last = offsets[:-1][filled], offsets[1:][filled] - 1
    before, after = inside[:-2].copy(), inside[2:].copy()
    before[first] = False
    after[last] = False
    here = inside[1:-1]
    starts = np.flatnonzero(here & ~before)
    ends = np.flatnonzero(here & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def planes(values: np.ndarray) -> bytes:
    """The values' first bytes, then their second ones and so on, which compresses better."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def unplaned(data, kind) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def packed(values: np.ndarray) -> bytes:
    return pa.compress(planes(values), "zstd", asbytes=True)


def unpacked(data, n: int, kind) -> np.ndarray:
    return unplaned(pa.decompress(pa.py_buffer(data), n * np.dtype(kind).itemsize, "zstd"), kind)


def per_doc(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of set bytes in each document."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def blocks(text: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, offsets) of consecutive documents, null as empty, about ``limit`` bytes each."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    text = pc.fill_null(text.cast(pa.large_string()), "")
    n = len(text)
    if n == 0:
        return
    bufs = text.buffers()
    offs = np.frombuffer(bufs[1], np.int64)[text.offset : text.offset + n + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield data[offs[lo] : offs[hi]], (offs[lo : hi + 1] - offs[lo]).astype(np.int64)
        lo = hi


def map_text(docs: DataFrame, text: str, keep: list[str], fields: T.StructType, name: str,
             make: Callable[[], Callable[[np.ndarray, np.ndarray], list]], limit: int = BLOCK_BYTES) -> DataFrame:
    """Rows of ``docs`` (columns ``keep``) with a struct ``name`` of values computed from ``text``.

    ``make()`` runs once a task and returns a function of (bytes, offsets)
    giving one list or array a field.  Row by row and map-only: nothing is
    shuffled, and equal or null doc_ids are no special case.
    """
    wanted = [*keep, *([] if text in keep else [text])]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(name, fields)])
    kinds = {"long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
             "string": pa.string(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()),
             "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string()), "array<double>": pa.list_(pa.float64()),
             "array<array<int>>": pa.list_(pa.list_(pa.int32()))}
    arrow = [kinds[f.dataType.simpleString()] for f in fields]
    labels = [f.name for f in fields]

    def run(batches):
        compute = make()
        for batch in batches:
            at = 0
            for raw, offsets in blocks(batch.column(wanted.index(text)), limit):
                n = len(offsets) - 1
                part = batch.slice(at, n)
                at += n
                values = [v if isinstance(v, pa.Array) else pa.array(v, kind) for v, kind in zip(compute(raw, offsets), arrow, strict=True)]
                made = pa.StructArray.from_arrays(values, labels)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(keep))), made], [*keep, name])

    small_batches(docs.sparkSession)
    return docs.select(*[docs[f"`{c}`"] for c in wanted]).mapInArrow(run, schema)


def doc_strings(raw: np.ndarray, offsets: np.ndarray) -> list[str]:
    data = raw.tobytes()
    return [data[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
