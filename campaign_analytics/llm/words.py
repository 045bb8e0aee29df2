"""Words and their hashes for whole Arrow batches of texts, by array operations on the UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20  # bytes of text worked on at a time; a longer text is a chunk of its own

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x



def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes data[start:end] of each word; equal words have equal hashes wherever they stand.

    A word is read in blocks of eight bytes. Every block is scrambled together with its place before the blocks are
    added up, so that no arrangement of few letters, as long as it may be, brings two words to the same sum by its
    pattern; what is left is the chance of 64 random bits.
    """
    lengths = ends - starts
    blocks = (lengths + 7) >> 3
    first = np.cumsum(blocks) - blocks
    word = np.repeat(np.arange(len(starts)), blocks)
    place = np.arange(len(word)) - first[word]
    at = starts[word] + 8 * place
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    body = padded[at[:, None] + np.arange(8)]
    body[np.arange(8) >= (ends[word] - at)[:, None]] = 0
    value = mix64(body.view("<u8")[:, 0] ^ mix64((place.astype(np.uint64) + np.uint64(1)) * _BASE))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value)])
    return mix64(sums[first + blocks] - sums[first] + lengths.astype(np.uint64) * _BACK)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_CACHE: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_CACHE.get("up", ())) <= n:
        size = max(n, CHUNK)
        up, down = _powers(_BASE, size), _powers(_BACK, size)
        if size > CHUNK:
            return up, down
        _CACHE.update(up=up, down=down)
    return _CACHE["up"], _CACHE["down"]


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[start:end] for each pair; equal runs have equal hashes wherever they stand."""
    up, down = _power_tables(len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive values; as many as there are starts."""
    at = np.arange(max(0, len(hashes) - n + 1))
    return run_hashes(hashes, at, at + n)


def classes(kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes belong to words, and the byte each stands for.

    ``space``: everything but white space. ``lower``: the same with A-Z lower-cased. ``letters``: ASCII letters
    and digits and all bytes of other characters, A-Z lower-cased.
    """
    byte = np.arange(256)
    inside = ~((byte == 0x20) | ((byte >= 0x09) & (byte <= 0x0D)))
    stands = byte.astype(np.uint8)
    if kind != "space":
        upper = (byte >= 65) & (byte <= 90)
        stands = np.where(upper, byte + 32, byte).astype(np.uint8)
    if kind == "letters":
        low = (byte >= 97) & (byte <= 122)
        inside = upper | low | ((byte >= 48) & (byte <= 57)) | (byte >= 128)
    return inside, stands


class Words:
    """The words of some texts: hashes, byte ranges in ``data``, and for each text where its words begin.

    Text i has the words ``at[i]:at[i + 1]``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kind: str):
        inside, stands = classes(kind)
        self.data = data
        mask = inside[data]
        before = np.zeros(len(data), bool)
        before[1:] = mask[:-1]
        first = offsets[:-1][offsets[:-1] < len(data)]
        before[first] = False  # a text starts anew
        self.starts = np.flatnonzero(mask & ~before)
        after = np.zeros(len(data), bool)
        after[:-1] = mask[1:]
        last = offsets[1:]
        after[last[last > 0] - 1] = False
        self.ends = np.flatnonzero(mask & ~after) + 1
        self.hashes = word_hashes(stands[data], self.starts, self.ends)
        self.at = np.searchsorted(self.starts, offsets)
        self.texts = len(offsets) - 1

    def text_of(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(self.texts), np.diff(self.at))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, kind: str) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, Words) for stretches of rows of about ``CHUNK`` bytes."""
    data, offsets = text_bytes(column)
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + CHUNK, side="right")) - 1
        end = min(max(end, row + 1), n)
        part = offsets[row : end + 1]
        yield row, end, Words(data[part[0] : part[-1]], part - part[0], kind)
        row = end


def binary_column(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """Rows values[at[i]:at[i + 1]] as a binary column."""
    width = values.dtype.itemsize
    body = np.ascontiguousarray(values)
    offsets = (at * width).astype(np.int64)
    large = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(body)])
    return large.cast(pa.binary())


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Stretches of rows with equal keys from batches sorted by them, across batch borders."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        head = tuple(c[0] for c in columns)
        cuts = [0, *np.flatnonzero(change), batch.num_rows]
        if last is not None and head != last:
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)
