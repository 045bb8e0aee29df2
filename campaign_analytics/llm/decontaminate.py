"""Find benchmark passages in training documents by spaced seeds, also where some words were replaced."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, row_keys, shared_object, without
from .words import Words, chunks, mix64, text_bytes

# Positions of a window that are compared; the ones left out may differ. Each mask has weight 6. Of 13 words in a row
# any two may be replaced, and some mask still finds the others somewhere among them; tests try all 79 ways.
MASKS = ("111111", "1111011", "1101100101", "10110010011")
SPAN = 13  # words that an overlap needs, or all words of a shorter item
LEAST = 0.8  # share of these words that must be equal
PAIRS = 1 << 20  # hits of seeds turned into diagonals at a time
ITEMS_AT_ONCE = 4_000_000  # words of benchmark text broadcast at a time; a longer benchmark is read in several passes


def seeds(hashes: np.ndarray, owner: np.ndarray, mask: str, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the compared words of each window and the window's first word; windows stay within a text."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    total = np.full(n, salt, np.uint64)
    for i, used in enumerate(mask):
        if used == "1":
            total = mix64(total * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n])
    inside = np.flatnonzero(owner[:n] == owner[len(mask) - 1 :])
    return total[inside], inside


def short_masks(n: int, least: float) -> list[str]:
    """Masks over the whole of an item of ``n`` words that together miss none of the replacements it may have.

    With r replaced words at most, the positions are dealt out to r + 1 masks: one of them sees no replaced word.
    """
    masks = n - int(np.ceil(least * n - 1e-9)) + 1
    return ["".join("1" if i % masks == g else "0" for i in range(n)) for g in range(masks)]


def seed_runs(values: np.ndarray, place: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of one seed at consecutive places of a text: value, first place, how many."""
    if not len(values):
        return values, place, np.empty(0, np.int64)
    goes_on = (values[1:] == values[:-1]) & (place[1:] == place[:-1] + 1) & (owner[place[1:]] == owner[place[:-1]])
    first = np.flatnonzero(np.concatenate([[True], ~goes_on]))
    return values[first], place[first], np.diff(np.concatenate([first, [len(values)]]))


class Benchmark:
    """The items' words and, per mask, the runs of seeds in ascending order of the items that it is for."""

    def __init__(self, ids: np.ndarray, words: Words, span: int = SPAN, least: float = LEAST):
        self.ids, self.hashes, self.at, self.owner = ids, words.hashes, words.at, words.text_of()
        sizes = np.diff(self.at)
        masks = [(mask, None) for mask in MASKS]
        masks += [(mask, n) for n in np.unique(sizes[(sizes > 0) & (sizes < span)]).tolist() for mask in short_masks(n, least)]
        self.seeds = []
        for salt, (mask, n) in enumerate(masks):
            values, place = seeds(self.hashes, self.owner, mask, salt)
            own = sizes[self.owner[place]]
            mine = own >= span if n is None else own == n
            values, place = values[mine], place[mine]
            values, place, many = seed_runs(values, place, self.owner)
            order = np.argsort(values, kind="stable")
            self.seeds.append((mask, salt, values[order], place[order], many[order]))


def _diagonals(words: Words, bench: Benchmark) -> np.ndarray:
    """Distinct rows (text, item, where word 0 of the item falls) that a seed hit lies on.

    Where a seed goes on over consecutive places on either side, both runs together hit a stretch of neighbouring
    diagonals. Hits are turned into diagonals in pieces of ``PAIRS``, so that words which both sides repeat without
    end take no more room than the diagonals they leave.
    """
    owner = words.text_of()
    texts, items, low_shift = words.texts, len(bench.ids), -len(bench.hashes)
    width = len(words.hashes) - low_shift + 1
    if texts * items * width >= 2**62:
        raise ValueError("texts and benchmark are too large to be held against each other at once")
    found = np.empty(0, np.int64)
    for mask, salt, keys, theirs, their_many in bench.seeds:
        if not len(keys):
            continue
        values, place, many = seed_runs(*seeds(words.hashes, owner, mask, salt), owner)
        low, high = np.searchsorted(keys, values, "left"), np.searchsorted(keys, values, "right")
        hit = np.flatnonzero(high > low)
        pairs = (high - low)[hit]
        upto = np.cumsum(pairs)
        at = 0
        while at < len(hit):
            done = upto[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(upto, done + PAIRS, "right")))
            n = pairs[at:end]
            run = np.repeat(low[hit[at:end]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            mine = np.repeat(hit[at:end], n)
            item = bench.owner[theirs[run]]
            first = place[mine] - (theirs[run] + their_many[run] - 1 - bench.at[item])
            code = (owner[place[mine]] * items + item) * width - low_shift + first
            for piece in _stretched(code, many[mine] + their_many[run] - 1):
                found = np.union1d(found, piece)
            at = end
    rest, shift = np.divmod(found, width)
    return np.stack([rest // items, rest % items, shift + low_shift], 1)


def _stretched(starts: np.ndarray, lengths: np.ndarray) -> Iterator[np.ndarray]:
    """The numbers of all stretches in pieces of about ``PAIRS``."""
    starts, where = np.unique(starts, return_inverse=True)
    longest = np.zeros(len(starts), np.int64)
    np.maximum.at(longest, where, lengths)
    upto = np.cumsum(longest)
    at = 0
    while at < len(starts):
        done = upto[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(upto, done + PAIRS, "right")))
        n = longest[at:end]
        yield np.repeat(starts[at:end] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        at = end


def overlaps(words: Words, bench: Benchmark, span: int, least: float) -> np.ndarray:
    """Rows (text, item, first word, end word, equal words): the best verified overlap on each diagonal hit.

    A seed hit fixes a diagonal, on which words are compared one by one over the stretch where document and
    item lie side by side. It counts if ``span`` words in a row, or the whole of a shorter item, have the
    share ``least`` of equal words.
    """
    out = []
    for t, i, s in _diagonals(words, bench):
        a, b = bench.at[i], bench.at[i + 1]
        first, end = max(s, words.at[t]), min(s + b - a, words.at[t + 1])
        need = min(span, b - a)
        if end - first < need:
            continue
        same = words.hashes[first:end] == bench.hashes[a + first - s : a + end - s]
        sums = np.concatenate([[0], np.cumsum(same)])
        runs = sums[need:] - sums[:-need]
        if runs.max() >= least * need - 1e-9:
            good = np.flatnonzero(runs >= least * need - 1e-9)
            x, y = good[0], good[-1] + need
            out.append((t, i, first + x - words.at[t], first + y - words.at[t], sums[y] - sums[x]))
    return np.array(out, np.int64).reshape(-1, 5)


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, least: float = LEAST) -> DataFrame:
    """doc_id, item_id, start, end, n_equal of each overlap of a document with an item, in words.

    Words are runs of letters and digits with A-Z lower-cased. Spaced seeds of both sides are matched, every
    hit is verified on its diagonal. With the default span and share no overlap is missed: items of fewer words
    have masks of their own length, so an item of one word is found wherever that word stands. The benchmark is a stated query set: it is read in blocks of bounded
    size, each of which is broadcast and held against all rows.

    Null and empty texts have no words and no overlaps, as do items without words. Items with equal text are
    each reported. Repeated rows are treated one by one; empty tables give no rows; other columns are ignored.
    """
    items = benchmark.select("item_id", "text").filter("text is not null")
    total = items.agg(F.sum(F.length("text") / 4)).first()[0] or 0
    blocks = max(1, int(np.ceil(total / ITEMS_AT_ONCE)))
    kinds = {c.name: c.dataType.simpleString() for c in [docs.schema["doc_id"], benchmark.schema["item_id"]]}
    schema = f"doc_id {kinds['doc_id']}, item_id {kinds['item_id']}, start long, end long, n_equal long"
    out = None
    for k in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").toArrow()
        ids = np.array(part.column("item_id").to_pylist(), object)
        load = shared_object(docs.sparkSession, _benchmark(ids, part.column("text").to_pylist(), span, least))

        def run(batches: Iterator[pa.RecordBatch], load=load) -> Iterator[pa.RecordBatch]:
            bench = load()
            for batch in batches:
                for row, _, words in chunks(batch.column(1), "letters"):
                    rows = overlaps(words, bench, span, least)
                    if len(rows):
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(pa.array(rows[:, 0] + row)), pa.array(list(bench.ids[rows[:, 1]]))]
                            + [pa.array(rows[:, c]) for c in (2, 3, 4)],
                            names=["doc_id", "item_id", "start", "end", "n_equal"],
                        )

        hits = docs.select("doc_id", "text").mapInArrow(run, schema)
        out = hits if out is None else out.union(hits)
    return out


def _benchmark(ids: np.ndarray, texts: list[str], span: int, least: float) -> Benchmark:
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    return Benchmark(ids, Words(data, offsets, "letters"), span, least)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without an overlap. Every row is judged by its own text, also where ids are null or
    repeated; other columns are kept, whatever their names."""
    key = fresh(docs, "row_key")
    keyed, _ = row_keys(docs, key)
    bad = contaminated_spans(keyed.select(F.col(key).alias("doc_id"), "text"), benchmark, **options)
    return without(keyed, key, bad.select("doc_id"))
