"""Spelling variants: words of a corpus that differ by one letter, and the usual form of each.

Words are arranged in a trie whose levels are the words' counts of successive letter groups: a few wide groups first,
then many narrow ones. One inserted, deleted or replaced letter changes the counts of either grouping by a surplus of
at most one and a deficit of at most one, so a depth-first search that may spend one of each, anew for the narrow
groups, reaches every near word; words at the leaves are then verified letter by letter.

The top levels of the trie deal the words out: a word is a member of one shard and is asked of every shard within its
budget. How many levels that takes follows from the measured sizes of the subtrees. Where a shard still holds too many
members or is asked too often, it is split into cells of some of its members and some of its questions, so that no
task holds more than ``CELL`` words and no pair of words is lost.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, stored

LETTERS = "[A-Za-zÀ-ÿ]"
WIDE_GROUPS, NARROW_GROUPS = 8, 16  # a letter belongs to the groups of its code point modulo these
CELL = 8192  # members, and questions, that meet in one step of a task
SLICE = 1 << 20  # characters of a text searched at a time
HELD = 1 << 17  # distinct words a task holds before it passes its counts on
PAIRS = 1 << 16  # pairs of words verified together
WIDE = 48  # words up to this length are compared as arrays, longer ones one by one
_LOWER = {upper: upper + 32 for upper in range(ord("A"), ord("Z") + 1)}


def word_counts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 6, min_n: int = 5, slip_every: int | None = None
) -> DataFrame:
    """Words of all texts with how often they occur: columns word and n.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z lower-cased. With ``slip_every`` a run loses one
    letter in every document where that number divides the hash h of ``<key>:<run>``: the one at h modulo its length.
    Null texts have no words, a null key is hashed as an empty one, repeated rows count each time.

    Counts are summed in each task before they are shuffled. A task holds one batch of texts and ``HELD`` words.
    """
    found, other = re.compile(f"{LETTERS}+"), re.compile(f"[^{LETTERS[1:]}")

    def runs(value: str) -> Counter:
        counts: Counter = Counter()
        at = 0
        while at < len(value):
            border = other.search(value, at + SLICE)
            end = border.start() if border else len(value)
            counts.update(found.findall(value, at, end))
            at = end
        return counts

    def as_batch(counts: Counter) -> pa.RecordBatch:
        columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for ident, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                start = zlib.crc32(f"{ident}:".encode())
                for run, n in runs(value).items():
                    word = run if run.islower() and run.isascii() else run.translate(_LOWER)
                    if slip_every:
                        h = zlib.crc32(word.encode(), start)
                        if h % slip_every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                    if len(word) >= min_chars:
                        total[word] += n
                if len(total) >= HELD:
                    yield as_batch(total)
                    total.clear()
        yield as_batch(total)

    named = docs.filter(F.col(text).isNotNull()).select(F.coalesce(F.col(key).cast("string"), F.lit("")), F.col(text))
    partial = named.mapInArrow(count, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_n)


def group_counts(words: list[str], groups: int) -> np.ndarray:
    """How many letters of each group every word has, one row a word."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
    flat = np.bincount(owner * groups + points % groups, minlength=len(words) * groups)
    return flat.reshape(len(words), groups).astype(np.int32)


def levels_of(words: list[str]) -> np.ndarray:
    """The path of every word through the trie."""
    return np.hstack([group_counts(words, WIDE_GROUPS), group_counts(words, NARROW_GROUPS)])


def _packed(counts: np.ndarray) -> pa.Array:
    """Rows as binary values whose byte order is the order of the rows."""
    data = np.ascontiguousarray(counts.astype(">u4"))
    return pa.Array.from_buffers(pa.binary(4 * counts.shape[1]), len(counts), [None, pa.py_buffer(data)]).cast(pa.binary())


def _unpacked(column: pa.Array) -> np.ndarray:
    body = b"".join(column.to_pylist())
    return np.frombuffer(body, ">u4").reshape(len(column), -1).astype(np.int32)


def _with_vectors(words: DataFrame) -> DataFrame:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("vector", _packed(group_counts(batch.column(0).to_pylist(), WIDE_GROUPS)))

    return words.select("word", "n").mapInArrow(add, "word string, n long, vector binary")


def _prefix(levels: int) -> Column:
    return F.substring("vector", 1, 4 * levels)


def shard_levels(vocabulary: DataFrame) -> int:
    """The least number of top levels whose largest subtree fits a cell; all the wide groups where none does."""
    vectors = vocabulary.groupBy("vector").agg(F.count("*").alias("n"))
    levels = F.explode(F.sequence(F.lit(1), F.lit(WIDE_GROUPS))).alias("levels")
    subtrees = vectors.select("n", "vector", levels).groupBy("levels", F.expr("substring(vector, 1, 4 * levels)"))
    largest = subtrees.agg(F.sum("n").alias("n")).groupBy("levels").agg(F.max("n").alias("n")).collect()
    return min([r.levels for r in largest if r.n <= CELL], default=WIDE_GROUPS)


def reachable(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefixes within a surplus and a deficit of one that do not sort before the own one: (row, prefix) pairs.

    Nearness goes both ways, so of two different prefixes only the smaller one has to ask.
    """
    levels = own.shape[1]
    eye = np.eye(levels, dtype=np.int32)
    steps = [np.zeros(levels, np.int32), *eye]
    steps += [up - down for i, up in enumerate(eye) for j, down in enumerate(eye) if i < j]
    rows, found = [], []
    for step in steps:
        reached = own + step
        fits = np.flatnonzero((reached >= 0).all(axis=1))
        rows.append(fits)
        found.append(reached[fits])
    return np.concatenate(rows), np.concatenate(found)


def _dealt(vocabulary: DataFrame, levels: int) -> DataFrame:
    """Every word once as a member and as a question to each shard in reach, with its cell."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, shards = reachable(_unpacked(batch.column(2))[:, :levels])
            columns = [_packed(shards), *[c.take(pa.array(rows)) for c in batch.columns[:2]]]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "word", "n"])

    members = vocabulary.select(_prefix(levels).alias("shard"), "word", "n", F.lit(0).alias("role"))
    asked = vocabulary.mapInArrow(ask, "shard binary, word string, n long").withColumn("role", F.lit(1))
    sizes = members.groupBy("shard").agg(F.ceil(F.count("*") / CELL).cast("int").alias("parts"))
    known = asked.join(sizes, "shard")  # a prefix that no word has is no shard
    times = known.groupBy("shard").agg(F.ceil(F.count("*") / CELL).cast("int").alias("turns"))
    shares = sizes.join(times, "shard")
    both = members.unionByName(asked).join(shares, "shard")
    mine = F.pmod(F.xxhash64("word"), F.when(F.col("role") == 0, F.col("parts")).otherwise(F.col("turns"))).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.when(F.col("role") == 0, F.col("turns")).otherwise(F.col("parts")) - 1))
    placed = both.withColumn("mine", mine).withColumn("other", others)
    member = F.col("role") == 0
    return placed.select(
        "shard",
        F.when(member, F.col("mine")).otherwise(F.col("other")).alias("part"),
        F.when(member, F.col("other")).otherwise(F.col("mine")).alias("turn"),
        "role",
        "word",
        "n",
    )


class _Spelled:
    """Words as arrays of code points from the left and from the right."""

    def __init__(self, words: list[str]):
        self.words = words
        self.lengths = np.array([len(w) for w in words], np.int64)
        short = [w if len(w) <= WIDE else "" for w in words]
        self.width = max(map(len, short), default=0)
        self.left = self._matrix(short)
        self.right = self._matrix([w[::-1] for w in short])

    @staticmethod
    def _matrix(words: list[str]) -> np.ndarray:
        wide = np.array(words, f"<U{WIDE}") if words else np.empty(0, f"<U{WIDE}")
        points = wide.view(np.uint32).reshape(len(words), WIDE)
        return points if points.size and points.max() > 255 else points.astype(np.uint8)

    def near(self, mine: np.ndarray, other: _Spelled, theirs: np.ndarray) -> np.ndarray:
        """Whether the words of each pair differ by exactly one letter."""
        a, b = self.lengths[mine], other.lengths[theirs]
        out = np.abs(a - b) <= 1
        long = np.flatnonzero(out & (np.maximum(a, b) > WIDE))
        for i in long:
            out[i] = one_letter_apart(self.words[mine[i]], other.words[theirs[i]])
        short = np.flatnonzero(out & (np.maximum(a, b) <= WIDE))
        x, y = mine[short], theirs[short]
        shared = np.zeros(len(short), np.int64)
        least, most = np.minimum(a, b)[short], np.maximum(a, b)[short]
        width = max(self.width, other.width, 1)
        same = np.zeros(len(short), bool)
        for one, two in ((self.left, other.left), (self.right, other.right)):
            differs = one[:, :width][x] != two[:, :width][y]
            first = differs.argmax(axis=1)
            same = ~differs[np.arange(len(short)), first]  # nothing differs
            shared += np.where(same, least, np.minimum(first, least))
        out[short] = (shared >= most - 1) & ~same
        return out


def one_letter_apart(a: str, b: str) -> bool:
    """Exactly one inserted, deleted or replaced letter."""
    if len(a) > len(b):
        a, b = b, a
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    if len(a) == len(b):
        return at < len(a) and a[at + 1 :] == b[at + 1 :]
    return len(b) - len(a) == 1 and a[at:] == b[at + 1 :]


def search(paths: np.ndarray, asked: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (member, question) whose counts differ by a surplus and a deficit of at most one in either grouping.

    Members are sorted by their ``paths``: a node of the trie is a range of them that agree on the levels above. All
    questions descend together; at every child those go on whose budget allows the difference.
    """

    def descend(first: int, end: int, depth: int, alive: np.ndarray, surplus: np.ndarray, deficit: np.ndarray):
        if depth == paths.shape[1]:
            members = np.arange(first, end)
            some = max(1, PAIRS // len(members))
            for at in range(0, len(alive), some):
                now = alive[at : at + some]
                yield np.tile(members, len(now)), np.repeat(now, len(members))
            return
        if depth == WIDE_GROUPS:
            surplus, deficit = np.ones_like(surplus), np.ones_like(deficit)
        values = paths[first:end, depth]
        borders = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1), end - first]
        wanted = asked[alive, depth]
        for a, b in zip(borders[:-1], borders[1:], strict=True):
            more = values[a] - wanted
            left, missing = surplus - np.maximum(more, 0), deficit - np.maximum(-more, 0)
            on = np.flatnonzero((left >= 0) & (missing >= 0))
            if len(on):
                yield from descend(first + a, first + b, depth + 1, alive[on], left[on], missing[on])

    if len(paths) and len(asked):
        budget = np.ones(len(asked), np.int32)
        yield from descend(0, len(paths), 0, np.arange(len(asked)), budget, budget)


class _Members:
    """The members of one cell as a trie, and what they are asked."""

    def __init__(self, table: pa.Table, levels: int):
        words = table["word"].to_pylist()
        paths = levels_of(words)
        order = np.lexsort(paths.T[::-1])
        self.paths, self.levels = paths[order], levels
        self.spelled = _Spelled([words[i] for i in order])
        self.n = table["n"].to_numpy()[order]

    def ask(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words = batch.column(batch.schema.get_field_index("word")).to_pylist()
        n = batch.column(batch.schema.get_field_index("n")).to_numpy()
        asked, spelled = levels_of(words), _Spelled(words)
        own = (asked[:, : self.levels] == self.paths[0, : self.levels]).all(axis=1)
        held, size = [], 0
        for pairs in search(self.paths, asked):
            held.append(pairs)
            size += len(pairs[0])
            if size >= PAIRS:
                yield from self._verified(held, spelled, n, own)
                held, size = [], 0
        if held:
            yield from self._verified(held, spelled, n, own)

    def _verified(self, pairs: list, spelled: _Spelled, n: np.ndarray, own: np.ndarray) -> Iterator[pa.RecordBatch]:
        mine, theirs = (np.concatenate(side) for side in zip(*pairs, strict=True))
        near = self.spelled.near(mine, spelled, theirs)
        mine, theirs = mine[near], theirs[near]
        a = [self.spelled.words[i] for i in mine]
        b = [spelled.words[i] for i in theirs]
        # Two words of one shard ask each other; the pair counts once.
        once = pa.array([not (own[q] and x < y) for x, y, q in zip(a, b, theirs, strict=True)], pa.bool_())
        a, b = pa.array(a, pa.string()), pa.array(b, pa.string())
        for columns in ([a, b, pa.array(n[theirs])], [b, a, pa.array(self.n[mine])]):
            yield pa.RecordBatch.from_arrays(columns, ["word", "near", "near_n"]).filter(once)


def near_words(words: DataFrame) -> DataFrame:
    """All pairs of words that differ by one letter, in both directions: word, near, near_n.

    ``words`` has distinct words with their n; words may hold any letters.
    """
    vocabulary = stored(_with_vectors(words), "vocabulary")
    levels = shard_levels(vocabulary)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, trie = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = list(zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True))
            borders = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
            for a, b in zip(borders[:-1], borders[1:], strict=True):
                if keys[a][:3] != cell:
                    cell, held, trie = keys[a][:3], [], None
                part = batch.slice(a, b - a)
                if keys[a][3] == 0:
                    held.append(part)
                elif held:
                    trie = trie or _Members(pa.Table.from_batches(held), levels)
                    yield from trie.ask(part)

    cells = _dealt(vocabulary, levels).repartition("shard", "part", "turn")
    return cells.sortWithinPartitions("shard", "part", "turn", "role").mapInArrow(meet, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """The last form of every word: columns word and root, from the columns word and form.

    Each round lets every word skip to the form of its current one, which doubles the steps it has gone. Forms are
    more frequent by a factor at each step, so chains are short and without circles.
    """
    state = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        further = state.select(F.col("word").alias("at"), F.col("root").alias("next"))
        gone = state.join(further, F.col("root") == F.col("at"), "left")
        state = cut(gone.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if state.filter("moved").isEmpty():
            return state.select("word", "root")
        state = state.select("word", "root")


def spelling_variants(words: DataFrame, factor: int = 5) -> DataFrame:
    """Every word with its usual form: word, form, root, n, n_near, form_n.

    ``form`` is the near word of largest n, of equal ones the first in code-point order, if its n is at least
    ``factor`` times the word's own; else null. ``root`` is the last word reached by following forms, the word itself
    where it has none. ``n_near`` counts near words. ``words`` holds words and n, as ``word_counts`` gives
    them; rows of one word are added up, a null word is left out, further columns are not carried along, and an empty
    table gives an empty table.
    """
    words = words.filter("word is not null").groupBy("word").agg(F.sum("n").alias("n"))
    words = stored(words, "words")
    best = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best")
    )
    usual = -F.col("best.n") >= factor * F.col("n")
    known = words.join(best, "word", "left").select(
        "word",
        F.when(usual, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(usual, -F.col("best.n")).alias("form_n"),
    )
    known = stored(known, "forms")
    last = roots(known.filter("form is not null"))
    return known.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
