"""Remove long word sequences that already occur earlier in the corpus.

Repeated windows are found by fingerprints and not by suffix automata; the README says why.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bloom_filter, might_hold, stored
from .words import Words, chunks, gram_hashes, mix64

WINDOW = 20
GRAM = 10  # words of an anchor; each window has one, chosen by its content alone
PART_CHARS = 4_000_000  # characters of text per part of the fingerprint space
HELD = 1 << 19  # fingerprints collected before they are packed, or merged
TASKS = 8192  # shuffle partitions at most; a task works off its parts one after another


def window_anchors(words: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor hash and place: in every window, the gram with the smallest hash, the first of equal ones.

    Equal windows have the same anchor wherever they stand, so only windows whose anchor is repeated can be.
    """
    grams = gram_hashes(words.hashes, gram)
    steps = window - gram + 1
    n = len(words.hashes) - window + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    owner = words.text_of()
    inside = owner[:n] == owner[window - 1 :]
    low = np.lib.stride_tricks.sliding_window_view(grams, steps)[:n]
    at = np.unique((low.argmin(1) + np.arange(n))[inside])
    return grams[at], at


def _second(words: Words, n: int) -> np.ndarray:
    """Fingerprints independent of gram_hashes(words.hashes, n); they choose the part and add to its 64 bits."""
    return gram_hashes(mix64(words.hashes ^ np.uint64(0x5851F42D4C957F2D)), n)


def _pack(arrays: list[np.ndarray], parts: int, part: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows (part, hashes, places), ordered by document and place inside a row, the places compressed."""
    hashes, docs, places = arrays
    order = np.lexsort((places, docs, part))
    hashes, docs, places, part = hashes[order], docs[order], places[order], part[order]
    cut = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
    press = zstandard.ZstdCompressor(level=1)
    rows: tuple[list, list, list] = ([], [], [])
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        body = np.diff(docs[a:b], prepend=0).tobytes() + np.diff(places[a:b], prepend=0).astype(np.int32).tobytes()
        rows[0].append(int(part[a]))
        rows[1].append(hashes[a:b].tobytes())
        rows[2].append(press.compress(body))
    types = [pa.int32(), pa.binary(), pa.binary()]
    yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, types, strict=True)], names=["part", "hashes", "places"])


def _repeated(packed: DataFrame, parts: int, with_first: bool) -> DataFrame:
    """(doc_id, pos) of places whose fingerprint occurs at several places: all, or all but the first.

    A task merges what comes in with the fingerprints of its part and returns repeated places at once, so it
    holds the distinct fingerprints of one part only, however often one of them occurs and however many parts it has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        none = np.empty(0, np.int64)
        nothing = [np.empty(0, np.uint64), none, none, np.empty(0, bool)]
        state, now = nothing, None
        coming: list[list[np.ndarray]] = []
        held = 0

        def merge() -> pa.RecordBatch:
            nonlocal state, held
            hashes, docs, places, told = (np.concatenate([s, *c]) for s, c in zip(state, zip(*coming, strict=True), strict=True))
            coming.clear()
            held = 0
            order = np.lexsort((~told, places, docs, hashes))
            hashes, docs, places, told = hashes[order], docs[order], places[order], told[order]
            head = np.r_[True, hashes[1:] != hashes[:-1]]
            twin = np.r_[False, ~head[1:] & (docs[1:] == docs[:-1]) & (places[1:] == places[:-1])]
            later = ~head & ~twin
            group = np.cumsum(head) - 1
            several = np.bincount(group[later], minlength=int(head.sum())) > 0 if len(head) else head
            out = later & ~told
            if with_first:
                out |= head & several[group] & ~told
            told = told | (head & several[group]) if with_first else told
            rows = [pa.array(docs[out]), pa.array(places[out].astype(np.int32))]
            state = [x[head] for x in (hashes, docs, places, told)]
            return pa.RecordBatch.from_arrays(rows, names=["doc_id", "pos"])

        for batch in batches:
            for part, hashes, body in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if part != now:
                    if coming:
                        yield merge()
                    state, now = nothing, part
                h = np.frombuffer(hashes, np.uint64)
                raw = open_.decompress(body)
                docs = np.cumsum(np.frombuffer(raw[: 8 * len(h)], np.int64))
                places = np.cumsum(np.frombuffer(raw[8 * len(h) :], np.int32).astype(np.int64))
                coming.append([h, docs, places, np.zeros(len(h), bool)])
                held += len(h)
                if held > max(HELD, len(state[0]) // 2):
                    yield merge()
        if coming:
            yield merge()

    dealt = packed.repartition(min(parts, TASKS), "part").sortWithinPartitions("part")
    return dealt.mapInArrow(run, "doc_id long, pos int")


def _packed_anchors(docs: DataFrame, parts: int, window: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        n = 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for row, _, words in chunks(batch.column(1), "space"):
                hashes, at = window_anchors(words, window, gram)
                text = np.searchsorted(words.at, at, "right") - 1
                held.append([hashes, ids[row + text], at - words.at[text], (_second(words, gram)[at] % np.uint64(parts)).astype(np.int32)])
                n += len(at)
                if n > HELD:
                    yield from _pack(*_joined(held, parts))
                    held, n = [], 0
        if n:
            yield from _pack(*_joined(held, parts))

    return docs.select("doc_id", "text").mapInArrow(run, "part int, hashes binary, places binary")


def _joined(held: list, parts: int) -> tuple[list[np.ndarray], int, np.ndarray]:
    hashes, docs, places, part = (np.concatenate(x) for x in zip(*held, strict=True))
    return [hashes, docs, places], parts, part


def _packed_windows(candidates: DataFrame, parts: int, window: int, gram: int) -> DataFrame:
    """Fingerprints of the windows around repeated anchors; rows are (doc_id, text, places of anchors)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        n = 0
        for batch in batches:
            ids, anchors = batch.column(0).to_numpy(), batch.column(2)
            for row, end, words in chunks(batch.column(1), "space"):
                part = anchors.slice(row, end - row)
                near = np.zeros(len(words.hashes) + 1, np.int64)
                places = part.flatten().to_numpy() + np.repeat(words.at[:-1], pc.list_value_length(part).to_numpy())
                owner = words.text_of()
                first = np.maximum(places - (window - gram), words.at[owner[places]])
                np.add.at(near, first, 1)
                np.add.at(near, places + 1, -1)
                starts = np.flatnonzero(np.cumsum(near)[:-1] > 0)
                starts = starts[starts + window <= words.at[owner[starts] + 1]]
                if not len(starts):
                    continue
                text = owner[starts]
                hashes, second = gram_hashes(words.hashes, window)[starts], _second(words, window)[starts]
                held.append([hashes, ids[row + text], starts - words.at[text], (second % np.uint64(parts)).astype(np.int32)])
                n += len(starts)
                if n > HELD:
                    yield from _pack(*_joined(held, parts))
                    held, n = [], 0
        if n:
            yield from _pack(*_joined(held, parts))

    return candidates.select("doc_id", "text", "places").mapInArrow(run, "part int, hashes binary, places binary")


def _finished(docs: DataFrame, window: int) -> DataFrame:
    """What is left of each text once the words under its marked windows are gone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, batch.num_rows, 256):
                part = batch.slice(row, 256)
                total, gone, kept = [], [], []
                for text, marks in zip(part.column(1), part.column(2), strict=True):
                    words = (text.as_py() or "").encode().split()
                    total.append(len(words))
                    if marks.is_valid and len(marks):
                        starts = marks.values.to_numpy()
                        edge = np.zeros(len(words) + 1, np.int64)
                        np.add.at(edge, starts, 1)
                        np.add.at(edge, starts + window, -1)
                        stay = np.cumsum(edge)[:-1] == 0
                        words = [words[i] for i in np.flatnonzero(stay)]
                    gone.append(total[-1] - len(words))
                    kept.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept_text"],
                )

    schema = "doc_id long, n_words long, n_removed long, kept_text string"
    return docs.select("doc_id", "text", "marks").mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text for each row of ``docs`` (doc_id, text).

    Words are cut at ASCII white space and otherwise unchanged. A word goes if a window of ``window`` words
    over it has a word sequence that also starts earlier: in a document with a smaller id, or earlier in the
    same one. Windows are judged on the input, not on what is left. kept_text joins the other words with
    blanks.

    First the anchors of all windows are fingerprinted; then the windows around repeated anchors, in full.
    Fingerprints have 64 bits and a part number from an independent hash. Texts only travel for documents
    with repeated anchors, and again for those that lose words; a Bloom filter of bounded size tells.

    Null and empty texts have no words. Rows with a null id keep all words and take none from others. Rows with
    the same id count as one document at each place: they are not repeats of one another. An empty table gives
    no rows; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = rows.filter("doc_id is not null and text is not null")
    chars = known.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(48, math.ceil(chars / PART_CHARS))

    repeated = _repeated(_packed_anchors(known, parts, window, gram), parts, True)
    places = stored(repeated.groupBy("doc_id").agg(F.array_sort(F.collect_set("pos")).alias("places")), "anchors")
    candidates = might_hold(known, "doc_id", bloom_filter(places.select("doc_id"), "doc_id"), "_maybe").filter("_maybe")
    candidates = candidates.select("doc_id", "text").join(places, "doc_id")
    later = _repeated(_packed_windows(candidates, parts, window, gram), parts, False)
    marks = stored(later.groupBy("doc_id").agg(F.array_sort(F.collect_set("pos")).alias("marks")), "marks")

    rows = might_hold(rows, "doc_id", bloom_filter(marks.select("doc_id"), "doc_id"), "_maybe")
    whole = rows.filter("not _maybe").withColumn("marks", F.lit(None).cast("array<int>"))
    cut_down = rows.filter("_maybe").join(marks, "doc_id", "left")
    return _finished(whole, window).union(_finished(cut_down, window))
