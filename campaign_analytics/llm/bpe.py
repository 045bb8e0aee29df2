"""Byte-level BPE: texts to token ids and back, by merge rounds over many words at once.

A text is cut into words by the pattern of byte-level vocabularies. The distinct words of a batch lie in one flat
array of symbols; every round finds the lowest-ranked pair of each word by binary search over the sorted pair keys
and merges all its places. A merge makes a symbol that only later merges use, so merging every place of the lowest
pair from left to right gives what one merge at a time gives. Words met before are looked up in a table that each
task keeps and empties when it is full.

Results are those of the ``tokenizers`` library for a file with byte-level splitting, no normalizer and no prefix
space; other files are refused.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import shared_object
from .words import CHUNK

# Fixed value: the pattern that cuts a text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Letters and digits that Unicode has after version 16. The vocabularies' library does not know them as
# such, the pattern engine does.
NEWER = """
    558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF
    10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F
    12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2
    18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF
    1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E
    2CEA2-2CEAD 323B0-33479 3D000-3FC3F
"""

NO_PAIR = np.int32(2**31 - 1)
KNOWN_WORDS = 1 << 18  # words a task remembers
WORK = 1 << 22  # bytes of new words merged together; one longer word is worked on alone
PIECE = 1 << 20  # characters of a text cut into words at a time


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a vocabulary file: itself where it prints, else the next from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class Vocabulary:
    """The arrays that encoding and decoding need, read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        split = spec["pre_tokenizer"] or {}
        plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
        if spec["model"]["type"] != "BPE" or spec["normalizer"] or not plain:
            raise ValueError("not a byte-level BPE file without normalizer and prefix space")
        ids = spec["model"]["vocab"]
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        self.byte_ids = np.array([ids[letter] for letter in byte_letters()], np.int32)
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*ids.values(), *added.values()]) + 1
        spelled = [b""] * size
        for token, i in ids.items():
            spelled[i] = bytes(byte_of[letter] for letter in token)
        for token, i in added.items():
            spelled[i] = token.encode()
        self.size = size
        self.lengths = np.array([len(t) for t in spelled], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.letters = np.frombuffer(b"".join(spelled), np.uint8)

        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([ids[a] * size + ids[b] for a, b in merges], np.int64)
        self.merged = np.array([ids[a + b] for a, b in merges], np.int32)
        self.ranks = np.argsort(keys, kind="stable").astype(np.int32)
        self.keys = keys[self.ranks]

        # Two bytes that stand side by side in no token are never joined: a word can be cut between them.
        self.joined = np.zeros((256, 256), bool)
        for i in ids.values():
            at = np.frombuffer(spelled[i], np.uint8)
            self.joined[at[:-1], at[1:]] = True

        self.added = added
        self.added_pattern = "|".join(regex.escape(t) for t in sorted(added, key=len, reverse=True))

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, ``NO_PAIR`` where they do not merge."""
        wanted = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NO_PAIR)


def _newer_letters() -> str:
    """The ranges of ``NEWER`` as the inside of a pattern class."""
    ends = [(r.partition("-")[0], r.rpartition("-")[2]) for r in NEWER.split()]
    return "".join(f"\\U{first:0>8}-\\U{last:0>8}" for first, last in ends)


def merge_rounds(data: np.ndarray, starts: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of many words: flat ids, and how many belong to each word.

    ``starts`` holds where in ``data`` each word begins; words are not empty.
    """
    first = np.zeros(len(data), bool)
    first[1:] = ~vocabulary.joined[data[:-1], data[1:]]
    first[starts] = True
    part = np.cumsum(first, dtype=np.int64) - 1
    word_of_part = np.searchsorted(starts, np.flatnonzero(first), side="right") - 1
    symbols = vocabulary.byte_ids[data]
    ranks = np.full(len(data), NO_PAIR, np.int32)
    inner = np.flatnonzero(part[1:] == part[:-1])
    ranks[inner] = vocabulary.rank(symbols[inner], symbols[inner + 1])
    done_symbols, done_parts = [], []
    while len(symbols):
        begins = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        lengths = np.diff(np.concatenate([begins, [len(part)]]))
        lowest = np.minimum.reduceat(ranks, begins)
        open_part = lowest != NO_PAIR
        if not open_part.all():
            keep = np.repeat(open_part, lengths)
            done_symbols.append(symbols[~keep])
            done_parts.append(part[~keep])
            symbols, part, ranks = symbols[keep], part[keep], ranks[keep]
            lengths, lowest = lengths[open_part], lowest[open_part]
            if not len(symbols):
                break
        hits = np.flatnonzero(ranks == np.repeat(lowest, lengths))
        # In a run such as "aaa" the places overlap: every other one is merged, from the left.
        fresh = np.concatenate([[True], np.diff(hits) != 1])
        run_start = np.maximum.accumulate(np.where(fresh, np.arange(len(hits)), 0))
        hits = hits[(np.arange(len(hits)) - run_start) % 2 == 0]
        symbols[hits] = vocabulary.merged[ranks[hits]]
        stays = np.ones(len(symbols), bool)
        stays[hits + 1] = False
        at = hits - np.arange(len(hits))  # places of the new symbols once the right halves are gone
        symbols, part, ranks = symbols[stays], part[stays], ranks[stays]
        touched = np.zeros(len(symbols), bool)
        touched[at] = True
        touched[at[at > 0] - 1] = True
        changed = np.flatnonzero(touched)
        with_next = changed[changed + 1 < len(symbols)]
        inside = part[with_next] == part[with_next + 1]
        ranks[changed] = NO_PAIR
        with_next = with_next[inside]
        ranks[with_next] = vocabulary.rank(symbols[with_next], symbols[with_next + 1])
    symbols, part = np.concatenate(done_symbols), np.concatenate(done_parts)
    order = np.argsort(part, kind="stable")
    counts = np.bincount(word_of_part[part], minlength=len(starts))
    return symbols[order], counts


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the stretches starts[i] : starts[i] + lengths[i], one after another."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


class _Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


class Encoder:
    """Encodes texts one after another, keeping the tokens of the words it met."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.pattern = regex.compile(PATTERN)
        newer = _newer_letters()
        self.newer = regex.compile(f"[{newer}]")
        exact = PATTERN.replace(r"[^\s\p{L}\p{N}]", f"(?:[^\\s\\p{{L}}\\p{{N}}]|[{newer}])")
        for kind in (r" ?\p{L}+", r" ?\p{N}+"):
            exact = exact.replace(kind, f" ?(?:(?![{newer}]){kind[2:-1]})+")
        self.exact = regex.compile(exact)
        self.special = regex.compile(f"({vocabulary.added_pattern})") if vocabulary.added else None
        self._forget()

    def _forget(self) -> None:
        self.numbers = _Numbers()
        self.ids = np.empty(0, np.int32)
        self.starts = np.empty(0, np.int64)
        self.lengths = np.empty(0, np.int64)

    def _has_newer(self, piece: str) -> bool:
        try:
            piece.encode("latin-1")  # by far the fastest test, and true of most texts
        except UnicodeEncodeError:
            return self.newer.search(piece) is not None
        return False

    def _words(self, text: str) -> Iterator[list[str]]:
        """Words in lists of bounded length; a blank behind other characters always begins a word."""
        at = 0
        while at < len(text):
            end = at + PIECE
            while end < len(text):
                end = text.find(" ", end)
                if end < 0:
                    end = len(text)
                elif text[end - 1].isspace():
                    end += 1
                else:
                    break
            piece = text[at:end]
            yield (self.exact if self._has_newer(piece) else self.pattern).findall(piece)
            at = end

    def _learn(self, words: list[str]) -> None:
        """Merge new words; their numbers follow those of the words known so far."""
        spelled = [w.encode() for w in words]
        sizes = np.array([len(w) for w in spelled], np.int64)
        ids, lengths = [self.ids], [self.lengths]
        at = 0
        ends = np.cumsum(sizes)
        while at < len(words):
            done = int(ends[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(ends, done + WORK, side="right")))
            data = np.frombuffer(b"".join(spelled[at:end]), np.uint8)
            tokens, counts = merge_rounds(data, ends[at:end] - sizes[at:end] - done, self.vocabulary)
            ids.append(tokens)
            lengths.append(counts)
            at = end
        self.ids = np.concatenate(ids)
        self.lengths = np.concatenate(lengths)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids, and how many belong to each text."""
        if len(self.numbers) > KNOWN_WORDS:
            self._forget()
        numbers, parts, places = self.numbers, [], []
        for row, text in enumerate(texts):
            for i, run in enumerate(self.special.split(text) if self.special else [text]):
                if i % 2:
                    # An added token is one id whatever its letters; its number is below zero.
                    parts.append(np.array([-1 - self.vocabulary.added[run]], np.int64))
                    places.append(row)
                elif run:
                    for words in self._words(run):
                        parts.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
                        places.append(row)
        known = len(self.lengths)
        if len(numbers) > known:
            self._learn(list(numbers)[known:])
        if not parts:
            return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
        flat = np.concatenate(parts)
        row_of = np.repeat(places, [len(p) for p in parts])
        added = flat < 0
        safe = np.where(added, 0, flat)
        lengths = np.where(added, 1, self.lengths[safe] if len(self.lengths) else 1)
        starts = np.where(added, 0, self.starts[safe] if len(self.starts) else 0)
        ids = self.ids[spread(starts, lengths)] if len(self.ids) else np.zeros(int(lengths.sum()), np.int32)
        if added.any():
            ids[(np.cumsum(lengths) - lengths)[added]] = -1 - flat[added]
        return ids.astype(np.int32, copy=False), np.bincount(row_of, lengths, len(texts)).astype(np.int64)


def _with_column(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    at = batch.schema.get_field_index(name)
    if at < 0:
        return batch.append_column(name, column)
    return batch.set_column(at, name, column)


def _stretches(sizes: np.ndarray, bound: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes add up to about ``bound``; a larger row is a range of its own."""
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        done = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, done + bound, side="right")))
        yield at, end
        at = end


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add the token ids of a text column, without padding, truncation or further tokens.

    Rows, their order in a partition and other columns stay as they are; a column named ``out`` is replaced. A null
    or empty text has no ids. Added tokens in a text, such as ``<|endoftext|>``, are one id. ``path`` names the
    tokenizer file on the driver; its arrays (a few MB) are broadcast. Every row is encoded by itself, so repeated
    rows and ids, and a lost task, give the same ids again. Memory: one batch of texts, or one long text.
    """
    load = shared_object(docs.sparkSession, Vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(load())
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text)).fill_null("")
            sizes = np.array([len(v) for v in column.cast(pa.large_binary()).to_pylist()], np.int64)
            for a, b in _stretches(sizes, 4 * CHUNK):
                ids, counts = encoder.encode(column.slice(a, b - a).to_pylist())
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
                yield _with_column(batch.slice(a, b - a), out, lists)

    return docs.mapInArrow(run, _schema(docs, out, T.ArrayType(T.IntegerType())))


def decode(docs: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the text of a column of token ids, added tokens included.

    Ids that the vocabulary does not have, null ids among them, add nothing; a null or empty list gives an empty
    text. Bytes that are no UTF-8 become U+FFFD, as in the ``tokenizers`` library. Rows and other columns stay as
    they are; a column named ``out`` is replaced.
    """
    load = shared_object(docs.sparkSession, Vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load()
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for a, b in _stretches(sizes, CHUNK):
                flat = lists.slice(a, b - a).flatten().fill_null(-1).to_numpy(zero_copy_only=False)
                known = (flat >= 0) & (flat < vocabulary.size)
                at = np.where(known, flat, 0)
                lengths = np.where(known, vocabulary.lengths[at], 0)
                letters = vocabulary.letters[spread(vocabulary.starts[at], lengths)]
                ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(sizes[a:b])]
                yield _with_column(batch.slice(a, b - a), out, _texts(letters, np.concatenate([[0], ends])))

    return docs.mapInArrow(run, _schema(docs, out, T.StringType()))


def _texts(letters: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Strings of the bytes letters[offsets[i] : offsets[i + 1]]."""
    body = letters.tobytes()
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(body)]
    texts = pa.Array.from_buffers(pa.string(), len(offsets) - 1, buffers)
    try:
        texts.validate(full=True)
    except pa.ArrowInvalid:
        texts = pa.array([body[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
    return texts


def _schema(docs: DataFrame, out: str, kind: T.DataType) -> T.StructType:
    field = T.StructField(out, kind)
    kept = [field if f.name == out else f for f in docs.schema.fields]
    return T.StructType(kept if out in docs.columns else [*kept, field])
