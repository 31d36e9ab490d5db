"""Licence notices in texts: a trained paragraph classifier, confirmed by comparison with templates.

A paragraph is a line. Its features are the words and word pairs, in lower case without punctuation, that
occur in the templates; they are looked up as 64-bit hashes, so a paragraph is a sparse row. A logistic
regression with one class per licence family and one for everything else is trained from the templates, from
notices made of licence names by rule, from shortened and damaged copies of both, and, as other text, from
everyday sentences made of the same words. Its scores are calibrated on held-out examples (one temperature), and
what stays below the probability at which held-out other text is no longer taken for a licence is unknown.
A prediction counts only if enough of its word pairs stand in one template of its family.

The model is a few hundred kilobytes, trained in seconds on the driver and the same on every run; the corpus
takes no part in it. Rows: a null or empty text has no paragraphs; every paragraph is judged whole, however
long; repeated rows are judged each. Other columns are not carried.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from chronomart.llm.batches import SPACE, Words, ranges, small_batches

NEWLINE = 0x0A
UNKNOWN = "unknown"
#: Damaged copies of each template, sweeps of training, and the share of held-out other text let through.
COPIES = 12
SWEEPS = 300
LEAK = 0.002
#: Share of a paragraph's known word pairs, or of a template's, that one template must account for.
CONFIRM = 0.6
MIN_PAIRS = 3

NAMES = {
    "apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0 license"],
    "mit": ["MIT License", "MIT license (Expat)", "terms of the MIT License"],
    "bsd": ["BSD 3-Clause License", "BSD 2-Clause License", "New BSD License", "BSD license"],
    "gpl": ["GNU General Public License, version 3", "GNU General Public License version 2 or later", "GNU GPL v3"],
    "lgpl": ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License version 2.1"],
    "agpl": ["GNU Affero General Public License, version 3", "GNU AGPL v3"],
    "mpl-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0"],
    "isc": ["ISC License", "terms of the ISC License"],
    "cc-by": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License", "CC BY-SA 4.0",
              "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc-by-nc": ["CC BY-NC 4.0", "CC BY-NC-SA 4.0", "CC BY-NC-ND 4.0",
                 "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "public-domain": ["CC0 1.0 Universal", "Creative Commons Zero", "the Unlicense"],
}

NOTICES = [
    "Licensed under the {}.", "Licensed under {}.", "Released under the {}.", "Released under {}.",
    "This work is licensed under the {}.", "This work is licensed under a {}.", "This file is part of a work under the {}.",
    "Distributed under the terms of the {}.", "This software is available under the {}.", "License: {}",
    "You may use this file under the terms of the {}.", "This project is licensed under the {}; see the LICENSE file.",
]

TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "gpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ],
    "agpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "cc-by": [
        "This work is licensed under the Creative Commons Attribution 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/",
    ],
    "cc-by-nc": [
        "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-nc/4.0/",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ],
}

_EVERYDAY = (
    "the a of to and in this that our your new old work file program software library name copy version notice "
    "general public common free license licence permission terms condition source form person use may must "
    "see you we they people city government school report under by with for from is was are released published "
    "granted distributed driving fishing marriage music open national international house book letter 2 3 4 0"
).split()


def templates() -> dict[str, list[str]]:
    return {f: TEMPLATES[f] + [n.format(name) for name in NAMES[f] for n in NOTICES] for f in NAMES}


def _apart() -> np.ndarray:
    out = SPACE.copy()
    for c in range(0x21, 0x7F):
        out[c] |= not chr(c).isalnum()
    return out


class Paragraphs:
    """Lines of a batch of texts, as hashes of words and word pairs in lower case."""

    def __init__(self, texts: pa.Array):
        words = Words(texts, lower=True, apart=_apart())
        breaks = np.cumsum(words.data == NEWLINE)
        self.doc = words.doc_of()
        line = breaks[words.starts] if len(words.starts) else np.zeros(0, np.int64)
        first = np.concatenate([[0], breaks])[words.bounds[:-1]]
        self.line_in_doc = line - first[self.doc] if len(line) else line
        # A paragraph is a run of words of one document and line.
        new = np.ones(len(line), bool)
        new[1:] = (np.diff(line) != 0) | (np.diff(self.doc) != 0)
        self.begin = np.flatnonzero(new)
        self.of_word = np.cumsum(new) - 1
        pair = np.flatnonzero(~new) - 1
        self.words, self.pairs = words.hashes, ranges(words.hashes, pair, pair + 2, 1)
        self.of_pair = self.of_word[pair]


class Model:
    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.families = [*NAMES, UNKNOWN]
        texts, labels = self._examples(random.Random(seed))
        known = Paragraphs(pa.array([t for f in NAMES for t in templates()[f]]))
        self.features = np.unique(np.concatenate([known.words, known.pairs]))
        self.pair_set = np.unique(known.pairs)
        self.of_template = self._template_pairs()
        x, y = self._dense(texts), np.array(labels)
        held = rng.random(len(y)) < 0.25
        self.weights = self._train(x[~held], y[~held])
        self._calibrate(x[held] @ self.weights, y[held])

    def _examples(self, rng: random.Random) -> tuple[list[str], list[int]]:
        texts, labels = [], []
        for label, family in enumerate(NAMES):
            for template in templates()[family]:
                words = template.split()
                for copy in range(COPIES if len(words) > 15 else 3):
                    some = words if copy == 0 else [w for w in words if rng.random() > 0.12] or words
                    if copy % 3 == 2 and len(some) > 15:
                        at = rng.randrange(len(some) - 10)
                        some = some[at : at + rng.randint(10, len(some))]
                    texts.append(" ".join(some))
                    labels.append(label)
        for _ in range(1500):
            texts.append(" ".join(rng.choices(_EVERYDAY, k=rng.randint(3, 40))))
            labels.append(len(NAMES))
        return texts, labels

    def _template_pairs(self) -> list[tuple[int, np.ndarray]]:
        out = []
        for label, family in enumerate(NAMES):
            for template in templates()[family]:
                out.append((label, np.unique(Paragraphs(pa.array([template])).pairs)))
        return out

    def _rows(self, p: Paragraphs) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Each paragraph's known features, once: (paragraph, feature), its scale, and its share of unknown words."""
        of = np.concatenate([p.of_word, p.of_pair])
        grams = np.concatenate([p.words, p.pairs])
        at = np.minimum(np.searchsorted(self.features, grams), len(self.features) - 1)
        known = self.features[at] == grams
        n = len(p.begin)
        strange = np.bincount(p.of_word[~known[: len(p.words)]], minlength=n) / np.maximum(
            np.bincount(p.of_word, minlength=n), 1
        )
        pairs = np.unique(of[known] * np.int64(len(self.features)) + at[known])
        row, feature = pairs // len(self.features), pairs % len(self.features)
        scale = 1 / np.sqrt(np.maximum(np.bincount(row, minlength=n), 1))
        return row, feature, scale, strange

    def _dense(self, texts: list[str]) -> np.ndarray:
        row, feature, scale, strange = self._rows(Paragraphs(pa.array(texts)))
        x = np.zeros((len(texts), len(self.features) + 2))
        x[row, feature] = scale[row]
        x[:, -2], x[:, -1] = strange, 1
        return x

    def _train(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Multinomial logistic regression by accelerated gradient descent, with an L2 penalty."""
        weights = ahead = np.zeros((x.shape[1], len(self.families)))
        goal = np.eye(len(self.families))[y]
        rate = 2.0
        for sweep in range(SWEEPS):
            slope = x.T @ (self._softmax(x @ ahead) - goal) / len(y) + 1e-4 * ahead
            before, weights = weights, ahead - rate * slope
            ahead = weights + sweep / (sweep + 3) * (weights - before)
        return weights

    @staticmethod
    def _softmax(scores: np.ndarray) -> np.ndarray:
        raised = np.exp(scores - scores.max(axis=1, keepdims=True))
        return raised / raised.sum(axis=1, keepdims=True)

    def _calibrate(self, scores: np.ndarray, y: np.ndarray) -> None:
        def loss(heat: float) -> float:
            return -np.log(self._softmax(scores / heat)[np.arange(len(y)), y] + 1e-12).mean()

        self.heat = min(np.geomspace(0.1, 5, 60), key=loss)
        other = self._softmax(scores / self.heat)[y == len(NAMES)][:, :-1].max(axis=1)
        self.least = max(0.5, float(np.quantile(other, 1 - LEAK)))

    def judge(self, texts: pa.Array) -> list[tuple[int, int, str, float]]:
        """``(document in batch, line in document, family, probability)`` of confirmed paragraphs."""
        p = Paragraphs(texts)
        if not len(p.begin):
            return []
        at = np.minimum(np.searchsorted(self.pair_set, p.pairs), len(self.pair_set) - 1)
        hits = np.bincount(p.of_pair[self.pair_set[at] == p.pairs], minlength=len(p.begin))
        # Without word pairs of a template no prediction could be confirmed.
        near = np.flatnonzero(hits >= MIN_PAIRS)
        if not len(near):
            return []
        row, feature, scale, strange = self._rows(p)
        scores = np.zeros((len(p.begin), len(self.families)))
        np.add.at(scores, row, self.weights[feature] * scale[row, None])
        scores += strange[:, None] * self.weights[-2] + self.weights[-1]
        sure = self._softmax(scores[near] / self.heat)
        out = []
        for i, chances in zip(near.tolist(), sure):
            label = int(chances.argmax())
            if label == len(NAMES) or chances[label] < self.least:
                continue
            if self._confirmed(label, np.unique(p.pairs[slice(*np.searchsorted(p.of_pair, [i, i + 1]))])):
                first = p.begin[i]
                out.append((int(p.doc[first]), int(p.line_in_doc[first]), self.families[label], float(chances[label])))
        return out

    def _confirmed(self, label: int, pairs: np.ndarray) -> bool:
        for other, template in self.of_template:
            if other == label:
                common = len(np.intersect1d(pairs, template, assume_unique=True))
                if common >= MIN_PAIRS and common >= CONFIRM * min(len(pairs), len(template)):
                    return True
        return False


@lru_cache(maxsize=1)
def model() -> Model:
    return Model()


def licence_paragraphs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, found array<struct<line,family,probability>>)`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for doc, line, family, chance in model().judge(batch.column(1)):
                found[doc].append({"line": line, "family": family, "probability": chance})
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _FOUND)], ["key", "found"])

    schema = f"`{key}` long, found array<struct<line:long,family:string,probability:double>>"
    return docs.selectExpr(f"cast(`{key}` as bigint) as `{key}`", f"`{text}`").mapInArrow(run, schema)


_FOUND = pa.list_(pa.struct([("line", pa.int64()), ("family", pa.string()), ("probability", pa.float64())]))
