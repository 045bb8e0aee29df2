"""Fill-in-the-middle training texts: a document cut in three, its pieces put in another order behind marks.

Cuts, form and order come from a hash of the key, as columns. The cutting is a pipeline of ``pyarrow.compute``
steps over a batch: texts are split into lists of units (code points), the lists are flattened with the index of
their text, every unit gets its ordinal and from that its role, units are filtered by role, put back into lists and
joined, and the joined pieces are joined with their marks. Long texts go through in stretches that are joined again,
so that a batch never holds more than ``STRETCH`` bytes of text as units.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"  # fixed values: the marks before each piece
STRETCH = 1 << 19


def unit_lists(texts: pa.Array) -> pa.ListArray:
    """The code points of each text as a list of strings."""
    offsets, data = _bytes_of(texts)
    starts = pc.indices_nonzero(pc.not_equal(pc.bit_wise_and(data, pa.scalar(0xC0, pa.uint8())), pa.scalar(0x80, pa.uint8())))
    ends = pa.concat_arrays([starts.cast(pa.int64()), pa.array([len(data)], pa.int64())])
    units = pa.LargeStringArray.from_buffers(len(starts), ends.buffers()[1], data.buffers()[1])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(starts.to_numpy(), offsets), pa.int32()), units)


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Byte offsets of the texts, from 0 on, and their UTF-8 bytes. Texts are not null."""
    texts = texts.cast(pa.large_string())
    if len(texts) == 0:
        return np.zeros(1, np.int64), pa.array([], pa.uint8())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2] or pa.py_buffer(b"")
    body = body.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
    return offsets - offsets[0], pa.Array.from_buffers(pa.uint8(), body.size, [None, body])


def _joined(values: pa.Array, offsets: np.ndarray) -> pa.Array:
    """Strings values[offsets[i] : offsets[i + 1]] joined to one each."""
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
    return pc.binary_join(lists, pa.scalar("", pa.large_string()))


def _pieces_of(texts: pa.Array, first: pa.Array, second: pa.Array) -> list[pa.Array]:
    """Prefix, middle and suffix of texts that together are small."""
    lists = unit_lists(texts)
    units, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    ordinals = pc.subtract(pa.array(np.arange(len(units))), pc.take(lists.offsets, parents))
    before = pc.less(ordinals, pc.take(first, parents))
    after = pc.greater_equal(ordinals, pc.take(second, parents))
    out = []
    for role in (before, pc.invert(pc.or_(before, after)), after):
        owners = pc.filter(parents, role).to_numpy()
        out.append(_joined(pc.filter(units, role), np.searchsorted(owners, np.arange(len(texts) + 1))))
    return out


def _stretches(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets that cut long texts at code points, and the text of each stretch."""
    cuts, owner = [], []
    for row in np.flatnonzero(np.diff(offsets) > STRETCH):
        at = np.arange(offsets[row] + STRETCH, offsets[row + 1], STRETCH)
        for _ in range(3):  # a code point has at most three bytes behind its first
            at = at - ((data[at] & 0xC0) == 0x80)
        cuts.append(at)
        owner.append(np.full(len(at), row))
    starts = np.concatenate([offsets[:-1], *cuts])
    rows = np.concatenate([np.arange(len(offsets) - 1), *owner])
    order = np.lexsort((starts, rows))
    return np.concatenate([starts[order], offsets[-1:]]), rows[order]


def cut_texts(texts: pa.Array, first: pa.Array, second: pa.Array) -> list[pa.Array]:
    """Prefix, middle and suffix of each text, which end before the code points ``first`` and ``second``."""
    offsets, body = _bytes_of(texts)
    bounds, rows = _stretches(offsets, body.to_numpy())
    stretches = pa.LargeStringArray.from_buffers(len(rows), pa.array(bounds).buffers()[1], body.buffers()[1])
    lengths = pc.utf8_length(stretches).to_numpy().astype(np.int64)
    at_row = np.searchsorted(rows, np.arange(len(texts) + 1))
    total = np.concatenate([[0], np.cumsum(lengths)])
    before = total[:-1] - total[at_row[:-1]][rows]  # code points of the text before the stretch
    low = pc.subtract(pc.take(first, pa.array(rows)), pa.array(before))
    high = pc.subtract(pc.take(second, pa.array(rows)), pa.array(before))
    parts: list[list[pa.Array]] = [[], [], []]
    at = 0
    while at < len(rows):
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + STRETCH, side="right")) - 1)
        for done, piece in zip(parts, _pieces_of(stretches.slice(at, end - at), low[at:end], high[at:end]), strict=True):
            done.append(piece)
        at = end
    empty = pa.array([], pa.large_string())
    return [_joined(pa.concat_arrays(p) if p else empty, at_row) for p in parts]


def _row_join(*parts: str | pa.Array) -> pa.Array:
    """Marks and texts of each row joined to one text; a null makes the row null."""
    typed = [pa.scalar(p, pa.large_string()) if isinstance(p, str) else p for p in (*parts, "")]
    return pc.binary_join_element_wise(*typed, null_handling="emit_null")


def _ordered(text: pa.Array, form: pa.Array, pieces: list[pa.Array]) -> pa.Array:
    prefix, middle, suffix = pieces
    psm = _row_join(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)
    spm = _row_join(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)
    return pc.if_else(pc.equal(form, "psm"), psm, pc.if_else(pc.equal(form, "spm"), spm, text))


def _halves(texts: pa.Array, mark: str) -> tuple[pa.Array, pa.Array]:
    """What stands before and behind the first ``mark``; the second half is null without one."""
    parts = pc.list_slice(pc.split_pattern(texts, mark, max_splits=1), 0, 2, return_fixed_size_list=True)
    return pc.list_element(parts, 0), pc.list_element(parts, 1)


def _restored(output: pa.Array, form: pa.Array) -> pa.Array:
    out = output
    for name, lead, inner in [("psm", PREFIX, SUFFIX), ("spm", SUFFIX, PREFIX)]:
        head, rest = _halves(pc.if_else(pc.equal(form, name), output, pa.scalar(None, output.type)), lead)
        one, rest = _halves(rest, inner)
        two, middle = _halves(rest, MIDDLE)
        prefix, suffix = (one, two) if name == "psm" else (two, one)
        text = _row_join(prefix, middle, suffix)
        text = pc.if_else(pc.equal(head, ""), text, pa.scalar(None, text.type))
        out = pc.if_else(pc.equal(form, name), text, out)
    return out


def _with_column(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    at = batch.schema.get_field_index(name)
    column = column.cast(pa.string())
    return batch.append_column(name, column) if at < 0 else batch.set_column(at, name, column)


def _with_text(frame: DataFrame, out: str) -> T.StructType:
    field = T.StructField(out, T.StringType())
    fields = frame.schema.fields
    return T.StructType([field if f.name == out else f for f in fields] + ([] if out in frame.columns else [field]))


def _draws(key: Column, seed: int, n: int) -> list[Column]:
    """``n`` unsigned 32-bit integers from a hash of the key; a null key is hashed as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(n)]


def fill_in_middle(
    docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 1, percent: int = 90, spm_percent: int = 20
) -> DataFrame:
    """Add ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` to every row.

    ``percent`` of the texts are cut in three, ``spm_percent`` of those with the suffix before the prefix (``spm``),
    the others with the prefix first (``psm``). A text stays ``plain`` where it is null, empty or holds one of the
    marks; a null text counts as empty. Both cuts are drawn from all places between code points, the ends included.

    Equal keys draw equal numbers, so repeated rows come out equal, and a lost task gives the same texts again.
    Columns of these five names are replaced, all others pass through.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    one, two, chance, order = _draws(F.col(key), seed, 4)
    length = F.length(body).cast("long")
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked |= body.contains(mark)
    form = (
        F.when((body == "") | marked | (chance % 100 >= percent), F.lit("plain"))
        .when(order % 100 < spm_percent, F.lit("spm"))
        .otherwise(F.lit("psm"))
    )
    cut = F.col("form") != "plain"
    first, second = F.least(one % (length + 1), two % (length + 1)), F.greatest(one % (length + 1), two % (length + 1))
    # Both cuts are read from the input before a column of a name given here is replaced.
    planned = docs.withColumn("n", F.struct(length.alias("n"), form.alias("form"), first.alias("a"), second.alias("b"), body.alias("t")))
    planned = planned.withColumns({"form": F.col("n.form"), "prefix_chars": F.col("n.a"), "middle_chars": F.col("n.b"), "output": F.col("n.t")})
    planned = planned.withColumn("n", F.col("n.n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = {c: batch.column(batch.schema.get_field_index(c)) for c in ("form", "prefix_chars", "middle_chars", "output")}
            whole = part["output"].cast(pa.large_string())
            pieces = cut_texts(whole, part["prefix_chars"], part["middle_chars"])
            yield _with_column(batch, "output", _ordered(whole, part["form"], pieces))

    made = planned.mapInArrow(run, planned.schema)
    return made.withColumns(
        {
            "middle_chars": F.when(cut, F.col("middle_chars") - F.col("prefix_chars")),
            "prefix_chars": F.when(cut, F.col("prefix_chars")),
        }
    )


def restore(frame: DataFrame, output: str = "output", form: str = "form", out: str = "restored") -> DataFrame:
    """Add the text that ``fill_in_middle`` was given, found from its output and form alone.

    A text that is not of its form gives null, as does a null output; a null form counts as plain.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = batch.column(batch.schema.get_field_index(output)).cast(pa.large_string())
            kind = batch.column(batch.schema.get_field_index(form)).fill_null("plain")
            yield _with_column(batch, out, _restored(made, kind))

    return frame.mapInArrow(run, _with_text(frame, out))
