"""Licence notices in documents: Dice coefficient over word bigrams against templates, with size bounds."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_object
from .words import Words, chunks, gram_hashes, text_bytes

THRESHOLD = 0.8

# The wording of common licence notices.
TEMPLATES = {
    "mit-line": "Released under the MIT License.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The "
        "above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software."
    ),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        "an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for "
        "the specific language governing permissions and limitations under the License."
    ),
    "gpl-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
}


@dataclass
class Template:
    name: str
    grams: np.ndarray  # distinct bigrams, ascending
    length: int  # bigrams counting repeats


def _least_hits(size: int, threshold: float) -> int:
    """A window with fewer of a template's bigrams cannot reach the threshold, whatever else it holds."""
    return int(np.ceil(threshold * size / (2 - threshold) - 1e-9))


def templates_of(texts: Mapping[str, str]) -> list[Template]:
    """Templates with at least one bigram, by name."""
    out = []
    for name in sorted(texts):
        data, offsets = text_bytes(pa.array([texts[name]]))
        grams = gram_hashes(Words(data, offsets, "letters").hashes, 2)
        if len(grams):
            out.append(Template(name, np.unique(grams), len(grams)))
    return out


def best_end(grams: np.ndarray, own: np.ndarray, size: int) -> tuple[float, int]:
    """The best Dice of the stretches that start with the first of ``grams``, and the bigrams it takes.

    ``own`` tells which are the template's, ``size`` how many it has; a stretch has the distinct bigrams up to its end.
    """
    _, first = np.unique(grams, return_index=True)
    new = np.zeros(len(grams), np.int64)
    new[first] = 1
    values = 2 * np.cumsum(new * own) / (np.cumsum(new) + size)
    at = int(values.argmax())
    return float(values[at]), at + 1


def scan_document(grams: np.ndarray, templates: list[Template], threshold: float) -> list[tuple[str, int, int, float]]:
    """(template, first word, end word, Dice) of the notices in one document, given its bigrams in order.

    A window starts and ends with one of the template's bigrams. The threshold leaves it at least t / (2 - t) of
    the template's bigrams and at most (2 - t) / t as many as the template has, repeats counted; windows of all sizes
    between are compared where the first bound allows it. For each start the best end is taken. Of windows that
    overlap the best is kept, the first of equal ones.
    """
    found = []
    for t in templates:
        size = len(t.grams)
        least, most = _least_hits(size, threshold), int(t.length * (2 - threshold) / threshold + 1e-9)
        if len(grams) < least:
            continue
        own = np.isin(grams, t.grams)
        hit = np.flatnonzero(own)
        if len(hit) < least:
            continue
        last = np.searchsorted(hit, hit + most) - 1
        open_ = np.flatnonzero(last - np.arange(len(hit)) + 1 >= least)
        scored = []
        for i in open_:
            a, b = int(hit[i]), int(hit[last[i]]) + 1
            value, taken = best_end(grams[a:b], own[a:b], size)
            if value >= threshold - 1e-12:
                scored.append((-value, a, a + taken))
        taken_at: list[tuple[int, int]] = []
        for value, a, b in sorted(scored):
            if all(b <= x or a >= y for x, y in taken_at):
                taken_at.append((a, b))
                found.append((t.name, a, b + 1, -value))
    return sorted(found, key=lambda m: (m[1], m[2], m[0]))


def license_matches(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, license, start, end, dice: one row per notice found in ``docs`` (doc_id, text), in words.

    Words are runs of letters and digits with A-Z lower-cased. Every window of the whole text that the size bounds
    do not rule out is compared. The templates are an argument of some hundred texts at most. A template of
    one word has no bigram and never matches. Null and empty texts match nothing; repeated rows are scanned
    one by one; an empty table gives no rows; other columns are ignored.
    """
    load = shared_object(docs.sparkSession, templates_of(templates))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = load()
        every = np.unique(np.concatenate([t.grams for t in known])) if known else np.empty(0, np.uint64)
        least = min((_least_hits(len(t.grams), threshold) for t in known), default=1)
        for batch in batches:
            for row, _, words in chunks(batch.column(1), "letters"):
                grams = gram_hashes(words.hashes, 2)
                if not len(grams) or not len(every):
                    continue
                owner = words.text_of()
                at = np.minimum(np.searchsorted(every, grams), len(every) - 1)
                hits = np.flatnonzero((every[at] == grams) & (owner[:-1] == owner[1:]))
                many = np.bincount(owner[hits], minlength=words.texts)
                out: list[list] = [[], [], [], [], []]
                for text in np.flatnonzero(many >= least):
                    own = grams[words.at[text] : words.at[text + 1] - 1]
                    for name, a, b, value in scan_document(own, known, threshold):
                        for column, x in zip(out, (row + int(text), name, a, b, value), strict=True):
                            column.append(x)
                if out[0]:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(out[0]))] + [pa.array(c) for c in out[1:]],
                        names=["doc_id", "license", "start", "end", "dice"],
                    )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, license string, start long, end long, dice double")
