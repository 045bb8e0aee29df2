"""Language identification by interpolated Kneser-Ney character models in sorted hash arrays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_measured
from .common import cut, shared_object
from .words import _powers, mix64, text_bytes

ORDER = 4
SAMPLE_CHARS = 4_000_000  # expected characters of training text per language; languages with less give all they have
TOTAL_CHARS = 64_000_000  # of all languages together; more than sixteen get equal shares
CALIBRATION = 5  # one sampled document in this many is not counted but used to calibrate
TOGETHER = 8  # languages whose values stand side by side in one table
SHORT = 20  # letters below which a cross-entropy says too little to reject a text
CHUNK_CHARS = 1 << 18
UNKNOWN = "und"

_BASE = np.uint64(0xD6E8FEB86659FD93)
_TABLES: dict[str, np.ndarray] = {}


def _lower_letters() -> np.ndarray:
    """For each code point the lower-case letter it stands for; 0 for everything that is not a letter."""
    if "letters" not in _TABLES:
        table = np.zeros(0x110000, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                table[i] = ord(low) if len(low) == 1 else i
        _TABLES["letters"] = table
    return _TABLES["letters"]


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case letters of the texts with one blank (0) before, between and after runs of letters.

    Returns the symbols, the text of each and the number of letters of each text.
    """
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    letters = _lower_letters()[codes]
    n = np.bincount(owner[letters > 0], minlength=len(texts))
    # each text ends with a blank of its own; runs of blanks become one
    ends = np.cumsum([len(t) for t in texts])
    letters = np.insert(letters, ends, 0)
    owner = np.insert(owner, ends, np.arange(len(texts)))
    keep = letters > 0
    keep[1:] |= letters[:-1] > 0
    return letters[keep], owner[keep], n


def grams(sym: np.ndarray, owner: np.ndarray) -> list[np.ndarray]:
    """Hashes of the 1- to ORDER-grams that end at each symbol; before a text's start stand blanks."""
    powers = _powers(_BASE, ORDER)
    value = sym.astype(np.uint64) + np.uint64(1)
    total = np.zeros(len(sym), np.uint64)
    out = []
    for k in range(ORDER):
        back = np.ones(len(sym), np.uint64)
        if k < len(sym):
            same = owner[k:] == owner[: len(owner) - k]
            back[k:] = np.where(same, value[: len(value) - k], np.uint64(1))
        total = total + back * powers[k]
        out.append(mix64(total + np.uint64(k)))
    return out


def _context(sym: np.ndarray, owner: np.ndarray) -> list[np.ndarray]:
    """Hash of the k-1 symbols before each symbol, for k = 1..ORDER, as grams() hashes them."""
    out = [np.zeros(len(sym), np.uint64)]
    before = grams(sym, owner)
    for k in range(1, ORDER):
        h = np.empty(len(sym), np.uint64)
        start = np.ones(len(sym), bool)
        start[1:] = owner[1:] != owner[:-1]
        h[1:] = before[k - 1][:-1]
        blank = np.zeros(1, np.uint64)
        h[start] = grams(np.zeros(1, np.uint32), np.zeros(1, np.int64))[k - 1][0] if len(sym) else blank
        out.append(h)
    return out


def _batches(batch_ids: pa.Array, texts: pa.Array) -> Iterator[tuple[pa.Array, list[str]]]:
    """Rows in stretches of about CHUNK_CHARS characters, null as empty."""
    _, offsets = text_bytes(texts)
    row, n = 0, len(texts)
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + CHUNK_CHARS, side="right")) - 1
        end = min(max(end, row + 1), n)
        yield batch_ids.slice(row, end - row), texts.slice(row, end - row).fill_null("").to_pylist()
        row = end


class HashArray:
    """Hashes in ascending order, with the first place of each leading bit pattern.

    Hashes are uniform, so as many leading bits as the array has give a range of a few entries to look in.
    """

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        bits = max(1, len(keys).bit_length())
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(keys >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Place of each value, -1 where absent."""
        head = (wanted >> self.shift).astype(np.int64)
        at, stop = self.first[head], self.first[head + 1]
        out = np.full(len(wanted), -1, np.int32)
        todo = np.flatnonzero(at < stop)
        at, stop = at[todo], stop[todo]
        while len(todo):
            hit = self.keys[at] == wanted[todo]
            out[todo[hit]] = at[hit]
            at = at + 1
            go = ~hit & (at < stop)
            todo, at, stop = todo[go], at[go], stop[go]
        return out


@dataclass
class Table:
    """Log-probabilities of a few languages for every n-gram seen in any of them, in arrays sorted by hash.

    ``grams[k]`` and ``logp[k]`` hold the (k+1)-grams, ``contexts[k]`` and ``back[k]`` the log of the weight that
    a context leaves to the shorter one.
    """

    grams: list[HashArray]
    logp: list[np.ndarray]
    contexts: list[HashArray]
    back: list[np.ndarray]


@dataclass
class Model:
    """The languages in code-point order and their tables, ``TOGETHER`` languages each, so that the size of the model
    goes with the text it learned and not with the square of the languages. A text whose cross-entropy exceeds
    ``limit`` is rejected.
    """

    languages: list[str]
    tables: list[Table]
    floor: float
    scale: float = 1.0
    limit: np.ndarray | None = None


def log_probabilities(model: Model, sym: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Log-probability of each symbol under each language."""
    ends, before = grams(sym, owner), _context(sym, owner)
    return np.hstack([_table_scores(table, model.floor, ends, before) for table in model.tables])


def _table_scores(table: Table, floor: float, ends: list[np.ndarray], before: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(ends[0]), table.logp[0].shape[1]), np.float32)
    todo = np.arange(len(out))
    for k in range(ORDER - 1, -1, -1):
        place = table.grams[k].find(ends[k][todo])
        hit = place >= 0
        out[todo[hit]] += table.logp[k][place[hit]]
        todo = todo[~hit]
        if not len(todo):
            return out
        place = table.contexts[k].find(before[k][todo])
        known = place >= 0
        out[todo[known]] += table.back[k][place[known]]
    out[todo] += floor
    return out


def fit(counts: dict[str, list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]], languages: list[str]) -> Model:
    """Interpolated Kneser-Ney with one discount per order.

    ``counts[lang][k]``: hashes of the (k+1)-grams, of their contexts, of their last k symbols, and counts.
    Below the highest order a gram counts by the number of different symbols seen before it.
    """
    alphabet = len(np.unique(np.concatenate([counts[x][0][0] for x in languages])))
    floor = -np.log(2.0 * max(2, alphabet))
    tables = [_table(counts, languages[i : i + TOGETHER], floor) for i in range(0, len(languages), TOGETHER)]
    return Model(languages, tables, floor)


def _table(counts: dict, languages: list[str], floor: float) -> Table:
    keys = [np.unique(np.concatenate([counts[x][k][0] for x in languages])) for k in range(ORDER)]
    contexts = [np.unique(np.concatenate([counts[x][k][1] for x in languages])) for k in range(ORDER)]
    logp = [np.zeros((len(k), len(languages)), np.float32) for k in keys]
    back = [np.zeros((len(c), len(languages)), np.float32) for c in contexts]
    links = [_links(counts, languages, k, keys, contexts) for k in range(ORDER)]
    for li, lang in enumerate(languages):
        lower = np.full(1, np.exp(floor))  # what an order falls back to, by place in the keys below
        for k in range(ORDER):
            gram, context, suffix, n = counts[lang][k]
            n = n.astype(np.float64)
            if k + 1 < ORDER:  # continuation counts from the order above
                up = counts[lang][k + 1][2]
                order = np.sort(up)
                n = (np.searchsorted(order, gram, "right") - np.searchsorted(order, gram, "left")).astype(np.float64)
                n = np.maximum(n, 1.0)  # grams at a text's start have nothing before them
            ones, twos = float((n == 1).sum()), float((n == 2).sum())
            discount = ones / (ones + 2 * twos) if ones else 0.5
            discount = min(max(discount, 0.1), 0.9)
            at = np.searchsorted(contexts[k], context)
            total = np.bincount(at, n, len(contexts[k]))
            kinds = np.bincount(at, minlength=len(contexts[k]))
            with np.errstate(divide="ignore", invalid="ignore"):
                left = np.where(total > 0, discount * kinds / total, 1.0)
            back[k][:, li] = np.log(left)
            # every n-gram of the union gets this language's value, seen here or not
            mine = np.zeros(len(keys[k]))
            mine[np.searchsorted(keys[k], gram)] = np.maximum(n - discount, 0) / total[at]
            place, below = links[k]
            probability = mine + left[place] * (lower[below] if k else lower[0])
            logp[k][:, li] = np.log(probability)
            lower = probability
    return Table([HashArray(x) for x in keys], logp, [HashArray(x) for x in contexts], back)


def _links(counts: dict, languages: list[str], k: int, keys: list, contexts: list) -> tuple[np.ndarray, np.ndarray]:
    """For each (k+1)-gram of the union: place of its context, and of its last k symbols among the k-grams."""
    gram = np.concatenate([counts[x][k][0] for x in languages])
    context = np.concatenate([counts[x][k][1] for x in languages])
    suffix = np.concatenate([counts[x][k][2] for x in languages])
    _, first = np.unique(gram, return_index=True)
    place = np.searchsorted(contexts[k], context[first])
    below = np.searchsorted(keys[k - 1], suffix[first]) if k else np.zeros(len(first), np.int64)
    return place, below


def _suffixes(ends: list[np.ndarray], k: int) -> np.ndarray:
    return ends[k - 1] if k else np.zeros(len(ends[0]), np.uint64)


def _count_grams(sample: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            row = 0
            for _, texts in _batches(batch.column(0), batch.column(1)):
                mine = langs[row : row + len(texts)]
                row += len(texts)
                sym, owner, _ = symbols(texts)
                ends, before = grams(sym, owner), _context(sym, owner)
                for lang in sorted(set(mine)):
                    pick = (mine == lang)[owner]
                    for k in range(ORDER):
                        gram, first, n = np.unique(ends[k][pick], return_index=True, return_counts=True)
                        cols = [gram, before[k][pick][first], _suffixes(ends, k)[pick][first]]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(gram)), pa.array(np.full(len(gram), k, np.int32))]
                            + [pa.array(c.view(np.int64)) for c in cols]
                            + [pa.array(n.astype(np.int64))],
                            names=["lang", "k", "gram", "context", "suffix", "n"],
                        )

    schema = "lang string, k int, gram long, context long, suffix long, n long"
    counted = sample.select("lang", "text").mapInArrow(run, schema)
    return counted.groupBy("lang", "k", "gram").agg(F.first("context").alias("context"), F.first("suffix").alias("suffix"), F.sum("n").alias("n"))


def _mean_scores(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Cross-entropy per symbol for each text and language, and the number of letters of each text."""
    sym, owner, letters = symbols(texts)
    sums = np.zeros((len(texts), len(model.languages)))
    if len(sym):
        logs = log_probabilities(model, sym, owner)
        begin = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        sums[owner[begin]] = np.add.reduceat(logs, begin, axis=0)
    n = np.bincount(owner, minlength=len(texts)) if len(sym) else np.zeros(len(texts))
    return -sums / np.maximum(n, 1)[:, None], letters


def _softmax(entropy: np.ndarray, letters: np.ndarray, scale: float) -> np.ndarray:
    """Confidence in the best language; a text of many letters counts as one of at most 200."""
    gap = -(entropy - entropy.min(1, keepdims=True)) * scale * np.minimum(letters, 200)[:, None]
    return 1.0 / np.exp(gap).sum(1)


def train(labelled: DataFrame, sample_chars: int = SAMPLE_CHARS, total_chars: int = TOTAL_CHARS) -> Model | None:
    """Fit on a bounded sample of labelled rows (doc_id, lang, text); rows without lang or text are left out.

    Every language is learned. Each gives documents by a hash of id and text, in expectation ``sample_chars``
    characters, or an equal share of ``total_chars`` where there are many; these bounds keep the model, which is
    broadcast, bounded too. A fifth of the sample calibrates: the scale of the
    confidence, and per language the cross-entropy above which a text is rejected. None without any
    labelled row. Languages are taken in code-point order, which also settles ties.
    """
    rows = labelled.filter("lang is not null and text is not null")
    sizes = rows.groupBy("lang").agg(F.sum(F.length("text")).alias("chars")).filter("chars > 0")
    sizes = cut(sizes)
    each = min(sample_chars, total_chars / max(1, sizes.count()))
    at = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / (1 << 30)
    share = F.least(F.lit(1.0), F.lit(float(each)) / F.col("chars"))
    sample = join_measured(rows, sizes, "lang").filter(at < share)
    check = F.pmod(F.xxhash64("text", "doc_id"), F.lit(CALIBRATION)) == 0
    found = _count_grams(sample.filter(~check)).toArrow()
    if found.num_rows == 0:
        found = _count_grams(sample).toArrow()
        check = F.lit(True)
    if found.num_rows == 0:
        return None
    lang = np.array(found.column("lang").to_pylist(), object)
    languages = sorted(set(lang))
    level = found.column("k").to_numpy()
    part = [found.column(c).to_numpy() for c in ("gram", "context", "suffix", "n")]
    counts = {}
    for x in languages:
        counts[x] = []
        for k in range(ORDER):
            pick = (lang == x) & (level == k)
            counts[x].append(tuple(p[pick].astype(np.int64).view(np.uint64) for p in part[:3]) + (part[3][pick],))
    model = fit(counts, languages)
    return _calibrated(model, sample.filter(check))


def _calibrated(model: Model, sample: DataFrame) -> Model:
    load = shared_object(sample.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = load()
        for batch in batches:
            for langs, texts in _batches(batch.column(0), batch.column(1)):
                entropy, letters = _mean_scores(fitted, texts)
                ordered = np.sort(entropy, 1)
                gap = ordered[:, 1] - ordered[:, 0] if entropy.shape[1] > 1 else np.ones(len(texts))
                best = np.array(fitted.languages, object)[entropy.argmin(1)]
                yield pa.RecordBatch.from_arrays(
                    [langs, pa.array(list(best)), pa.array(ordered[:, 0]), pa.array(gap), pa.array(letters.astype(np.int64))],
                    names=["lang", "best", "entropy", "gap", "letters"],
                )

    schema = "lang string, best string, entropy double, gap double, letters long"
    scored = sample.select("lang", "text").mapInArrow(run, schema).filter("letters > 0").toArrow()
    lang, best = (np.array(scored.column(c).to_pylist(), object) for c in ("lang", "best"))
    entropy, gap, letters = (scored.column(c).to_numpy() for c in ("entropy", "gap", "letters"))
    blind = -model.floor  # as many nats per symbol as twice the alphabet takes without any model
    model.limit = np.full(len(model.languages), np.inf)
    for i, x in enumerate(model.languages):
        mine = entropy[(best == x) & (lang == x) & (letters >= SHORT)]
        if len(mine) >= 20:  # twice as far from the middle text as the worst one seen
            model.limit[i] = max(2 * mine.max() - np.median(mine), blind)
    right = lang == best
    # the scale at which confidence, on average, equals the share of right answers
    share = min(max(right.mean(), 0.5), 0.9999) if len(right) else 0.99
    low, high = 1e-3, 1e3
    for _ in range(40):
        scale = (low * high) ** 0.5
        sure = (1 / (1 + np.exp(-gap * scale * np.minimum(letters, 200)))).mean() if len(gap) else share
        low, high = (scale, high) if sure < share else (low, scale)
    model.scale = scale
    return model


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score and rejected for each row of ``docs`` (doc_id, text), from the whole text.

    lang_pred is the language with the lowest cross-entropy per symbol. A null text or one without letters, or
    no model at all, gives ``und`` with score 0, and is rejected. A text is also rejected if its cross-entropy
    lies far above what calibration saw for its language and the model does worse than blind guessing; lang_pred
    stays then. Ties go to the first language
    in code-point order. Repeated rows are treated one by one; other columns are ignored.
    """
    if model is None:
        return docs.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    load = shared_object(docs.sparkSession, model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load()
        for batch in batches:
            for ids, texts in _batches(batch.column(0), batch.column(1)):
                entropy, letters = _mean_scores(m, texts)
                best = entropy.argmin(1)
                none = letters == 0
                names = np.array([*m.languages, UNKNOWN], object)[np.where(none, len(m.languages), best)]
                odd = none | ((letters >= SHORT) & (entropy.min(1) > m.limit[best]))
                score = np.where(none, 0.0, _softmax(entropy, letters, m.scale))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(list(names), pa.string()), pa.array(score), pa.array(odd)],
                    names=["doc_id", "lang_pred", "score", "rejected"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def held_out(doc_id: str = "doc_id"):
    """Documents that no model learns from: crc32 of the id as text leaves 0 by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))
