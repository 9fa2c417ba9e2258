"""License scans by a trained paragraph classifier.

A sparse logistic regression over word n-grams (one to three words) names the licence family of a paragraph (a line
with a word), or none. It is trained on the driver from the templates below, from mutilated copies of them, and from paragraphs that are no licence: ordinary sentences and shuffled words of the templates. The unknown class
is calibrated: the least probability a family needs is set on held-back examples, so that at most one in a thousand
of those that are no licence passes. A prediction counts only when a template of the predicted family confirms it:
most of the template's word pairs must occur in the paragraph in the template's order of neighbours.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Short notices and first paragraphs of public licences, by family.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "Distributed under the MIT License.",
        "SPDX-License-Identifier: MIT",
        "License: MIT",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "Distributed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License version 2.",
        "Released under the GPL.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
        "Distributed under the GNU General Public License.",
        "SPDX-License-Identifier: GPL-3.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-2.0-or-later",
        "SPDX-License-Identifier: GPL-2.0",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-2.1-only",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "SPDX-License-Identifier: LGPL-3.0-only",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
        "Licensed under the BSD 2-Clause License.",
        "Distributed under the BSD license.",
        "BSD 3-Clause License",
        "BSD 2-Clause License",
        "SPDX-License-Identifier: BSD-3-Clause",
        "SPDX-License-Identifier: BSD-2-Clause",
    ),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "CC0": (
        "Released into the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "Unlicense": ("This is free and unencumbered software released into the public domain.", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.", "SPDX-License-Identifier: Unlicense"),
    "ISC": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "SPDX-License-Identifier: ISC",
    ),
}
PLAIN = (
    "The committee met on Tuesday to discuss the version of the plan that was published in spring.",
    "She was granted a permission to visit the public library free of charge.",
    "Any person may use the park without restriction, including the rights of way along the river.",
    "This work is the second part of a general history of the valley and its people.",
    "The software of the old computer was written by hand and never sold.",
    "He holds a licence to fish and a driving license, version two of which was lost.",
    "Creative people are common in the city, and attribution of the paintings is hard.",
    "The foundation gave a free copy of the book to every school.",
    "A notice appeared in the paper with the conditions of the sale.",
    "The software is licensed per seat, and the licence ends when the contract does.",
    "By using this site you agree to the terms and conditions, which may change without notice.",
    "All rights reserved, and no part of this publication may be reproduced without the permission of the publisher.",
    "Copyright of the photographs lies with the artists who kindly gave their permission.",
    "The driver must carry a valid license and the papers of the vehicle at any time.",
    "The identifier of the licence is printed on the back of the card.",
    "A license is needed to sell wine in the town, and the fee is paid each year.",
    "The warranty covers parts and labour for two years and does not extend to damage by water.",
    "The contract was sold without warranty of any kind, which the buyer accepted.",
    "The public domain of the crown was sold to private persons in the last century.",
    "The library is free for any purpose that serves the public, and books are lent without a fee.",
    "He taught at MIT for a year before he moved to the west coast.",
    "The source of the river is in the mountains and its form is that of a wide lake.",
    "Version 2.0 of the programme was published in March and version 3 is planned.",
    "The work of the commons committee was released into the archive last spring.",
    "The university distributed the grants under the rules of the foundation.",
    "Rain is likely later in the week, with wind from the west and a warm evening.",
)
WORD = re.compile(rb"[a-z0-9]+(?:[.\-/][a-z0-9]+)*")
ORDER, MADE, EPOCHS, RATE, SEED = 3, 40, 12, 0.5, 11
CONFIRM = 0.8
UNKNOWN = 0


def words(paragraph: bytes) -> list[bytes]:
    return WORD.findall(paragraph.lower())


def _grams(w: list[bytes]) -> Iterator[bytes]:
    for n in range(1, ORDER + 1):
        for i in range(len(w) - n + 1):
            yield b" ".join(w[i : i + n])


class Scanner:
    """Sparse multinomial logistic regression, its calibrated threshold, and the templates to confirm with."""

    def __init__(self) -> None:
        rng = random.Random(SEED)
        self.families = ["", *TEMPLATES]
        texts = [(words(t.encode()), k) for k, f in enumerate(self.families) if k for t in TEMPLATES[f]]
        self.pairs = {k: [frozenset(zip(w, w[1:], strict=False)) for w, j in texts if j == k] for k in range(1, len(self.families))}
        vocabulary = sorted({g for w, _ in texts for g in _grams(w)})
        self.index = {g: i for i, g in enumerate(vocabulary)}
        #: (pairs, most words of a run of lines that may hold them) of each template
        self.runs = [(frozenset(zip(w, w[1:], strict=False)), len(w) * 5 // 4 + 8) for w, _ in texts]
        # a template is confirmed by CONFIRM of its pairs at least, so one of any larger rest of them must occur
        rest = lambda pairs: int(round((1 - CONFIRM) * len(pairs), 9)) + 1
        self.keys = frozenset(x for each in self.pairs.values() for pairs in each for x in sorted(pairs, key=lambda x: (-len(x[0]) - len(x[1]), x))[: rest(pairs)])
        plain = [words(t.encode()) for t in PLAIN]
        filler = [x for w in plain for x in w]
        samples: list[tuple[list[bytes], int]] = []
        for w, k in texts:
            samples.append((w, k))
            for _ in range(MADE):
                kept = [x for x in w if rng.random() > 0.1] if len(w) > 20 else w
                samples.append((rng.choices(filler, k=rng.randrange(8)) + kept + rng.choices(filler, k=rng.randrange(8)), k))
            own = set(zip(w, w[1:], strict=False))
            for _ in range(MADE // 2):
                mixed = rng.sample(w, len(w))
                if 2 * len(own & set(zip(mixed, mixed[1:], strict=False))) < len(own):
                    samples.append((mixed, UNKNOWN))
                cut = rng.randrange(len(w))
                samples.append((rng.choices(filler, k=12) + w[cut : cut + max(1, len(w) // 5)] + rng.choices(filler, k=12), UNKNOWN))
        samples += [(w, UNKNOWN) for w in plain for _ in range(10)]
        samples += [(rng.choices(filler, k=rng.randrange(3, 60)), UNKNOWN) for _ in range(400)]
        rng.shuffle(samples)
        held = samples[::5]
        self.weights = np.zeros((len(vocabulary), len(self.families)))
        self.bias = np.zeros(len(self.families))
        features = [(self.features(w), k) for i, (w, k) in enumerate(samples) if i % 5]
        for epoch in range(EPOCHS):
            for at, k in features:
                d = self.probabilities(at)
                d[k] -= 1
                rate = RATE / (1 + epoch / 3)
                self.bias -= 0.1 * rate * d
                if len(at):
                    self.weights[at] -= rate * d / np.sqrt(len(at))
        wrong = sorted(1 - self.probabilities(self.features(w))[UNKNOWN] for w, k in held if k == UNKNOWN)
        self.least = max(0.5, wrong[int(len(wrong) * 0.999)] if wrong else 0.5)

    def features(self, w: list[bytes]) -> np.ndarray:
        return np.array(sorted({i for g in _grams(w) if (i := self.index.get(g)) is not None}), np.int64)

    def probabilities(self, at: np.ndarray) -> np.ndarray:
        z = self.bias + (self.weights[at].sum(axis=0) / np.sqrt(len(at)) if len(at) else 0)
        e = np.exp(z - z.max())
        return e / e.sum()

    def judge(self, w: list[bytes]) -> tuple[int, float, float]:
        """Family (0: none) of a paragraph's words, its probability, and how far a template of it confirms."""
        at = self.features(w)
        p = self.probabilities(at)
        k = int(p[1:].argmax()) + 1
        if 1 - p[UNKNOWN] < self.least or p[k] < 0.5:
            return 0, float(p[UNKNOWN]), 0.0
        mine = set(zip(w, w[1:], strict=False))
        like = max(len(mine & pairs) / max(1, len(pairs)) for pairs in self.pairs[k])
        return (k, float(p[k]), like) if like >= CONFIRM else (0, float(p[UNKNOWN]), like)

    def scan(self, text: bytes) -> list[tuple[str, int, float, float]]:
        """(family, number of the first line, probability, confirmation) of each licence found, in order of lines.

        Each line is judged alone, and so are runs of neighbouring lines, up to one without a word, for wrapped texts.
        """
        found: list[tuple[str, int, float, float]] = []
        block: list[tuple[int, list[bytes], bool]] = []
        known, last = False, b""
        for number, line in enumerate(text.split(b"\n")):
            w = words(line)
            if not w:
                if known and len(block) > 1:
                    found += self._wrapped(block, found)
                block, known, last = [], False, b""
                continue
            known = known or (last, w[0]) in self.keys
            if not self.keys.isdisjoint(zip(w, w[1:], strict=False)):
                known = True
                k, p, like = self.judge(w)
                if k:
                    found.append((self.families[k], number, p, like))
            cut = line.rstrip().endswith(b"-")  # the next line may go on with the same word
            known = known or cut
            block.append((number, w, cut))
            last = w[-1]
        if known and len(block) > 1:
            found += self._wrapped(block, found)
        return sorted(found, key=lambda x: x[1])

    def _wrapped(self, block: list[tuple[int, list[bytes], bool]], found: list[tuple[str, int, float, float]]) -> list[tuple[str, int, float, float]]:
        """Licences over several lines of a block that aren't found already in one of their lines."""
        w: list[bytes] = []
        lines: list[int] = []
        glued = False
        for number, line, cut in block:
            if glued:
                w[-1] += b"-" + line[0]
            w += line[glued:]
            lines += [number] * (len(line) - glued)
            glued = cut
        taken = {(family, number) for family, number, *_ in found}
        here, out = set(zip(w, w[1:], strict=False)), []
        for pairs, most in self.runs:
            if len(pairs & here) < CONFIRM * len(pairs):
                continue
            at = [i for i, x in enumerate(zip(w, w[1:], strict=False)) if x in pairs]
            held: dict[tuple[bytes, bytes], int] = {}
            left = right = 0
            while right < len(at):
                x = w[at[right]], w[at[right] + 1]
                held[x] = held.get(x, 0) + 1
                right += 1
                while at[right - 1] - at[left] + 2 > most:
                    y = w[at[left]], w[at[left] + 1]
                    held[y] -= 1
                    if not held[y]:
                        del held[y]
                    left += 1
                if len(held) < CONFIRM * len(pairs):
                    continue
                while right < len(at) and at[right] - at[left] + 2 <= most:
                    right += 1
                start, end = at[left], at[right - 1] + 2
                held, left = {}, right
                k, p, like = self.judge(w[start:end])
                over = range(lines[start], lines[end - 1] + 1)
                if k and len(over) > 1 and not any((self.families[k], n) in taken for n in over):
                    out.append((self.families[k], lines[start], p, like))
                    taken |= {(self.families[k], n) for n in over}
        return out


@cache
def scanner() -> Scanner:
    return Scanner()


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, family, paragraphs, probability, confirmation), one for each document row and family found.

    paragraphs lists the numbers of the lines found (from 0), of a text wrapped over several lines the first; probability and confirmation are the largest of them.
    Every line of every text is judged, and runs of lines up to one without a word. Null and empty texts, and texts without a licence, give no row; a null id is
    passed on; repeated rows are reported each. Ties between families go to the first in the list. Other columns are
    not read.
    """
    model = scanner()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            out: list[tuple] = []
            for i in range(batch.num_rows):
                by_family: dict[str, list[tuple[int, float, float]]] = {}
                for family, number, p, like in model.scan(texts[i].as_py() or b""):
                    by_family.setdefault(family, []).append((number, p, like))
                out += [(ids[i].as_py(), f, [x[0] for x in v], max(x[1] for x in v), max(x[2] for x in v)) for f, v in by_family.items()]
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = (ids.type, pa.string(), pa.list_(pa.int32()), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "family", "paragraphs", "probability", "confirmation"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return slim.mapInArrow(run, "doc_id long, family string, paragraphs array<int>, probability double, confirmation double")
