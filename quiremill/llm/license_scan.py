"""License scans: a trained paragraph classifier over sparse word n-grams, confirmed by templates.

A softmax regression over the presence of word 1- to 3-grams tells licence families, other licence text and plain prose
apart. It is trained here, on the driver, from notices of each family in varied wordings, made-up licences, and a bounded
sample of the corpus's own paragraphs as prose. A temperature fitted on held-out variants calibrates its probabilities, and
the unknown class takes licence text of which no family reaches the probability that held-out variants of known families reach.
A predicted family is confirmed by its templates (notices by which works state it, SPDX tags, and the texts of licences or of their usual headers): one must give enough of its word pairs to the passage,
or hold enough of the passage's, as a window of a long text does. A notice of a few words must also end where a sentence or line does. Else the passage is unknown too.

Texts are read twice: line by line, for notices of one line, and by paragraphs (lines up to one without words) for those that
are wrapped. What has more than ``WINDOW`` words is read in windows of so many words that overlap by half, so that a notice
inside long prose isn't thinned out; the whole text is read in any case. The classifier scores the windows of many texts at a time;
those that it takes for more than prose are then read one by one.
"""

from __future__ import annotations

import random
import re
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiremill.llm.common import with_fields

PROSE, OTHER, UNKNOWN = "prose", "other", "unknown"
WINDOW = 40
#: Documents whose lines serve as prose in training, at most; taken by a hash of their ids.
SAMPLE = 400
#: Lines of each of them, at most, evenly spread over its first ``SAMPLE_CHARS`` characters. These bound the training sample only.
SAMPLE_LINES, SAMPLE_CHARS = 4, 20_000
#: A template of fewer words is compared with where sentences end; a passage of fewer words is not known by being part of a template.
FEW, PART = 5, 10
#: Share of a notice's word pairs that a passage must hold. Similarities that differ by ``SAME`` at most are alike.
CONFIRMED, SAME = 0.6, 0.005
#: Texts are scored by so many characters at a time, or one text if it is longer, and by so many windows; neither changes what is found.
CHARS, BLOCK = 1 << 20, 4096
#: Windows whose prose leads by less, which is far above rounding, are judged one by one.
LEAD = 1e-6
#: From here on templates tell the family, and the classifier whether it is a known one.
PLAIN = 0.9
SPAN = "array<struct<paragraph: int, start: int, `end`: int, family: string, probability: double, similarity: double, predicted: string>>"

#: Short notices by which works state their licence, by family.
NOTICES: dict[str, tuple[str, ...]] = {
    "mit": ("Released under the MIT License.", "Licensed under the MIT license.", "This project is licensed under the terms of the MIT license.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    "apache-2.0": ("Licensed under the Apache License, Version 2.0.", "Released under the Apache 2.0 license.", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    "bsd": ("Released under the BSD License.", "Licensed under the BSD 3-Clause License.", "Licensed under the 2-clause BSD license.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    "gpl": ("This work is licensed under the GNU General Public License, version 3.", "Released under the GPL v2.", "Licensed under GPL-3.0.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation."),
    "lgpl": ("Licensed under the GNU Lesser General Public License, version 2.1.", "Released under the LGPL.", "You can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation."),
    "agpl": ("Licensed under the GNU Affero General Public License, version 3.", "Released under the AGPL v3.", "You can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation."),
    "mpl": ("Licensed under the Mozilla Public License, version 2.0.", "Released under MPL 2.0.", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    "isc": ("Released under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    "cc-by": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc-by-nd": ("Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    "cc0": ("Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related rights to this work.", "This work is marked with CC0 1.0 Universal."),
    "unlicense": ("Released under the Unlicense.", "This is free and unencumbered software released into the public domain."),
    "boost": ("Distributed under the Boost Software License, Version 1.0.", "Released under the Boost license."),
    "epl": ("Licensed under the Eclipse Public License 2.0.", "This program and the accompanying materials are made available under the terms of the Eclipse Public License."),
    "proprietary": ("All rights reserved.", "Copyright by the publisher. All rights reserved. No part of this publication may be reproduced without prior written permission."),
}
#: SPDX identifiers by family, as tags give them.
SPDX: dict[str, tuple[str, ...]] = {
    "mit": ("MIT",), "apache-2.0": ("Apache-2.0",), "bsd": ("BSD-2-Clause", "BSD-3-Clause"), "gpl": ("GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later"), "lgpl": ("LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-or-later"),
    "agpl": ("AGPL-3.0-only", "AGPL-3.0-or-later"), "mpl": ("MPL-2.0",), "isc": ("ISC",), "cc-by": ("CC-BY-4.0",), "cc-by-sa": ("CC-BY-SA-4.0",), "cc-by-nc": ("CC-BY-NC-4.0",), "cc-by-nd": ("CC-BY-ND-4.0",), "cc0": ("CC0-1.0",), "unlicense": ("Unlicense",), "boost": ("BSL-1.0",), "epl": ("EPL-2.0",),
}
_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'
_GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details.
You should have received a copy of the GNU {name} along with this program. If not, see <https://www.gnu.org/licenses/>."""
#: Texts of licences, or the headers that files under long ones carry, by family.
TEXTS: dict[str, str] = {
    "mit": f"""Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
{_AS_IS} IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.""",
    "gpl": _GNU.format(name="General Public License", version=3),
    "lgpl": _GNU.format(name="Lesser General Public License", version=3),
    "agpl": _GNU.format(name="Affero General Public License", version=3),
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "isc": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.',
    "unlicense": """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
    "boost": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so.",
    "epl": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "cc0": "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring rights to this work.",
}


def templates(family: str) -> tuple[str, ...]:
    """Notices, SPDX tags and text of a family."""
    return (*NOTICES[family], *(f"SPDX-License-Identifier: {x}" for x in SPDX.get(family, ())), *((TEXTS[family],) if family in TEXTS else ()))


_WORD = re.compile(r"\w+(?:[.-]\w+)*")
_ENDED = re.compile(r"[^\S\n]*(?:[.,;:!?)\]}\"'*/|#>-]|\n|$)")
_LEADS = ("", "Note: ", "This file is ", "The source code is ", "Unless stated otherwise, it is ", "Documentation is ", "Copyright 2019 the authors. ", "All content here is ")
_TAILS = ("", " See the file for details.", " Contact us for questions.", " See LICENSE.", " Terms apply.")
_MADE_UP = ("Licensed under the {} License.", "Released under the {} Public License, version {}.", "This work is licensed under the {} Community License.", "Use is subject to the {} licence agreement.", "Distributed under the terms of the {} Source License {}.")


#: Prose that uses the words of licences.
_HARD_PROSE = (
    "Your driving license expired yesterday.", "She is a licensed physician.", "The restaurant lost its liquor license.", "He applied for a fishing licence in the spring.",
    "The public library opens at nine.", "The general was not pleased with the terms of peace.", "Version 2 of the plan was worse.", "A free copy of the book is on the table.", "They work under the supervision of the project lead.",
    "The source of the river lies in the common forest.", "Permission to land was refused.", "Distribution of food began at once.", "It was released under pressure from the public.", "All rights of way are closed.",
    "All rights of the guests are reserved to the manager.", "The table was reserved, and the rights to the seats were theirs.", "Under the terms of the treaty both states may use the river without restriction.", "The terms and conditions of the peace were subject to the law of the land.",
    "The bank provides a public service under law.", "He was granted a free hand by the general, subject to no conditions.", "The copy was made available to any person who asked.", "They may use the hall for any purpose but trade.",
)


def words(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def grams(tokens: Sequence[str]) -> set[str]:
    return {" ".join(tokens[i : i + n]) for n in (1, 2, 3) for i in range(len(tokens) - n + 1)}


def _variants(rng: random.Random, n: int) -> list[tuple[str, str]]:
    out = []
    syllables = ["ka", "lo", "mi", "ren", "tu", "vas", "pel", "dor", "si", "qua", "nex", "or"]
    for family in NOTICES:
        for notice in templates(family):
            long = notice.split()
            for _ in range(n):
                t = notice
                if len(long) > WINDOW:  # as windows of a long text are
                    at = rng.randrange(len(long) - WINDOW + 1)
                    out.append((" ".join(long[at : at + WINDOW]), family))
                    continue
                if rng.random() < 0.3:
                    t = t.replace("License", rng.choice(["Licence", "license", "LICENSE"]))
                t = rng.choice(_LEADS) + t + rng.choice(_TAILS)
                tokens = t.split()
                if len(tokens) > 8 and rng.random() < 0.4:
                    del tokens[rng.randrange(len(tokens))]
                out.append((" ".join(tokens), family))
    for _ in range(len(out) // 4):
        name = "".join(rng.choice(syllables) for _ in range(3)).title()
        out.append((rng.choice(_LEADS) + rng.choice(_MADE_UP).format(name, rng.randrange(1, 9)) + rng.choice(_TAILS), OTHER))
    return out


class Model:
    """Softmax regression over the presence of n-grams."""

    def __init__(self, prose: Sequence[str], seed: int = 3, steps: int = 300):
        rng = random.Random(seed)
        self.classes = [PROSE, OTHER, *NOTICES]
        train, held = _variants(rng, 12), _variants(rng, 4)
        cut = len(prose) * 3 // 4
        train += [(p, PROSE) for p in [*prose[:cut], *_HARD_PROSE * 4]]
        held += [(p, PROSE) for p in prose[cut:]]
        known = sorted(set().union(*(grams(words(t)) for t, c in train if c != PROSE)))
        self.index = {g: i for i, g in enumerate(known)}
        x, y = self._matrix([t for t, _ in train]), np.array([self.classes.index(c) for _, c in train])
        w = np.zeros((len(known) + 1, len(self.classes)), np.float32)
        target = np.eye(len(self.classes), dtype=np.float32)[y]
        share = 1 / np.bincount(y, minlength=len(self.classes)).clip(1)[y]  # classes weigh alike
        share = (share / share.sum()).astype(np.float32)[:, None]
        move = np.zeros_like(w)
        for _ in range(steps):
            p = self._softmax(x @ w)
            move = np.float32(0.9) * move + x.T @ ((p - target) * share) + np.float32(1e-6) * w
            w -= np.float32(8.0) * move
        self.w = w.astype(np.float64)
        hx, hy = self._matrix([t for t, _ in held]), np.array([self.classes.index(c) for _, c in held])
        z = (hx @ w).astype(np.float64)
        rows = np.arange(len(hy))
        losses = [(-np.log(self._softmax(z / t)[rows, hy].clip(1e-12)).mean(), t) for t in np.geomspace(0.25, 4, 33)]
        self.temperature = min(losses)[1]
        p = self._softmax(z / self.temperature)
        right = (p.argmax(1) == hy) & (hy > 1)
        self.accuracy = float((p.argmax(1) == hy).mean())
        self.least = float(np.quantile(p[rows, hy][right], 0.02)) if right.any() else 0.5
        self.pairs = {c: [(frozenset(zip(t, t[1:], strict=False)), tuple(t)) for t in map(words, templates(c))] for c in NOTICES}
        self.words = frozenset(g for g in known if " " not in g)
        # The n-grams known by number, from 1: a longer one by its key, made of the number of all its words but the last and that of the last.
        self.numbers = {g: i for i, g in enumerate(sorted(self.words), 1)}
        self.base, shorter = len(self.numbers) + 1, self.numbers
        self.rows = [np.array([0, *(self.index[g] for g in shorter)])]
        self.keys = []
        for n in (2, 3):
            keyed = sorted((shorter[g.rsplit(" ", 1)[0]] * self.base + self.numbers[g.rsplit(" ", 1)[1]], g) for g in known if g.count(" ") == n - 1)
            shorter = {g: i for i, (_, g) in enumerate(keyed, 1)}
            self.keys.append(np.array([k for k, _ in keyed], np.int64))
            self.rows.append(np.array([0, *(self.index[g] for g in shorter)]))

    def _matrix(self, texts: Sequence[str]) -> np.ndarray:
        x = np.zeros((len(texts), len(self.index) + 1), np.float32)
        for i, t in enumerate(texts):
            self._fill(x[i], words(t))
        return x

    def _fill(self, row: np.ndarray, tokens: Sequence[str]) -> None:
        found = [k for g in grams(tokens) if (k := self.index.get(g)) is not None]
        row[found] = 1
        row /= max(1.0, np.sqrt(len(found)))
        row[-1] = 1

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(-1, keepdims=True))
        return e / e.sum(-1, keepdims=True)

    def similarity(self, family: str, tokens: Sequence[str], ended: Callable[[int], bool] = lambda i: True) -> float:
        """The most that a template and the passage hold of each other's word pairs. ended: does a sentence or line end after the i-th word?"""
        own = set(zip(tokens, tokens[1:], strict=False))
        best = 0.0
        for pairs, template in self.pairs[family]:
            if len(template) < FEW:
                n = len(template)
                best = max(best, float(any(tuple(tokens[i : i + n]) == template and ended(i + n - 1) for i in range(len(tokens) - n + 1))))
                continue
            both = len(pairs & own)
            best = max(best, both / max(1, len(pairs)), both / max(1, len(own)) if len(tokens) >= PART else 0.0)
        return best

    def judge(self, tokens: Sequence[str], ended: Callable[[int], bool] = lambda i: True) -> tuple[str, float, float, str, tuple[str, ...]] | None:
        """(family or unknown, probability, similarity, predicted class, families) of a passage; None for prose.

        families: those whose templates confirm it about as well as the best one. Licences of one kind share whole sentences, so there may be several; then the family is open here.
        """
        # Without known words a passage has the features of every other such passage, which is prose.
        if self.words.isdisjoint(tokens):
            return None
        found = [k for g in grams(tokens) if (k := self.index.get(g)) is not None]
        p = self._softmax((self.w[found].sum(0) / max(1.0, np.sqrt(len(found))) + self.w[-1]) / self.temperature)
        k = int(p.argmax())
        if k == 0:
            return None
        c = self.classes[k]
        near = {self.classes[i]: self.similarity(self.classes[i], tokens, ended) for i in range(2, len(p))}
        best = max(near.values(), default=0.0)
        fits = tuple(f for f, x in near.items() if x >= max(CONFIRMED, best - SAME))
        if not fits:
            return UNKNOWN, float(p[k]), near.get(c, 0.0), c, ()
        # A passage that is part of a template need not say of which family it is: then it counts how surely it is of a known one.
        sure = float(p[2:].sum() if best >= PLAIN else sum(p[self.classes.index(f)] for f in fits))
        named = fits[0] if len(fits) == 1 or c not in fits else c
        if sure < self.least:
            return UNKNOWN, sure, near[named], c, ()
        return named if len(fits) == 1 else UNKNOWN, sure, best, named, fits

    def _known(self, ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Where known 1-, 2- and 3-grams start in the numbers of words (0: unknown), and their features."""
        at = np.flatnonzero(ids)
        number = ids[at].astype(np.int64)
        out = [(at, self.rows[0][number])]
        for n, keys in enumerate(self.keys, 1):
            inside = at + n < len(ids)
            at, number = at[inside], number[inside]
            key = number * self.base + ids[at + n]
            k = np.searchsorted(keys, key).clip(max=len(keys) - 1)
            same = keys[k] == key
            at, number = at[same], k[same] + 1
            out.append((at, self.rows[n][number]))
        return out

    def _open(self, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Whether ``judge`` has to look at each window: whether its likeliest class isn't surely prose."""
        known, wide = self._known(ids), len(self.w)
        out = np.zeros(len(starts), bool)
        for i in range(0, len(starts), BLOCK):
            start, end = starts[i : i + BLOCK], ends[i : i + BLOCK]
            found = []
            for n, (at, feature) in enumerate(known):
                lo, hi = np.searchsorted(at, start), np.searchsorted(at, end - n)
                count = (hi - lo).clip(0)
                which = np.arange(count.sum()) + np.repeat(lo - count.cumsum() + count, count)
                found.append(np.repeat(np.arange(len(start)), count) * wide + feature[which])
            found = np.sort(np.concatenate(found))
            if not len(found):  # without known words all is prose
                continue
            window, feature = np.divmod(found[np.diff(found, prepend=-1) > 0], wide)
            first = np.flatnonzero(np.diff(window, prepend=-1))
            z = np.add.reduceat(self.w[feature], first) / np.sqrt(np.diff(first, append=len(window)))[:, None] + self.w[-1]
            out[i + window[first]] = z[:, 1:].max(1) > z[:, 0] - LEAD
        return out

    @staticmethod
    def _windows(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the windows of stretches of words."""
        step = WINDOW // 2
        count = np.where(sizes <= WINDOW, 1, -((step - sizes) // step))
        lo = np.repeat(starts, count) + step * (np.arange(count.sum()) - np.repeat(count.cumsum() - count, count))
        return lo, np.minimum(lo + WINDOW, np.repeat(starts + sizes, count))

    def _passages(self, parts: Iterable[Sequence[tuple[str, int, int, int]]], text: str) -> list[dict]:
        """Passages of windows of (word, start, end, line). Of overlapping windows that name one family the likelier stays."""
        out, last = [], None
        for part in parts:
            found = self.judge([t[0] for t in part], lambda i, part=part: _ENDED.match(text, part[i][2]) is not None)
            if found is None:
                continue
            span = {"paragraph": part[0][3], "start": part[0][1], "end": part[-1][2], "family": found[0], "probability": found[1], "similarity": found[2], "predicted": found[3], "fits": found[4]}
            if last is not None and span["start"] < last["end"] and (last["predicted"] == span["predicted"] or set(last["fits"]) & set(span["fits"])):
                rank = lambda x: (x["family"] != UNKNOWN, bool(x["fits"]), x["similarity"], x["probability"])
                if rank(span) > rank(last):
                    out[-1] = span
            else:
                out.append(span)
            last = out[-1]
        return out

    def _part_of(self, family: str, tokens: Sequence[str]) -> bool:
        """Whether a line is a piece of a notice of ``family``."""
        own = set(zip(tokens, tokens[1:], strict=False))
        return not own or max(len(p & own) for p, _ in self.pairs[family]) >= CONFIRMED * len(own)

    def scan(self, text: str | None) -> list[dict]:
        """Licence passages of a whole text, with code point offsets and the number of the line where they start.

        Passages of lines come first. A wrapped passage of a family is added unless a line that it covers has that family; lines unknown
        by themselves that are pieces of its notice go. A wrapped unknown passage is added where nothing else is.
        """
        return next(self.scan_all([text]))

    def scan_all(self, texts: Iterable[str | None]) -> Iterator[list[dict]]:
        """``scan`` of each text."""
        group, size = [], 0
        for text in texts:
            group.append(text or "")
            size += len(group[-1])
            if size >= CHARS:
                yield from self._scan(group)
                group, size = [], 0
        yield from self._scan(group)

    def _scan(self, texts: Sequence[str]) -> list[list[dict]]:
        out: list[list[dict]] = [[] for _ in texts]
        # Of words their number (0: unknown), of lines that have words their size, their text and their place in it.
        ids, sizes, owners, places = array("i"), array("q"), array("q"), array("q")
        for k, text in enumerate(texts):
            for i, line in enumerate(text.split("\n")):
                before = len(ids)
                ids.extend(map(self.numbers.get, map(str.lower, _WORD.findall(line)), repeat(0)))
                if len(ids) > before:
                    sizes.append(len(ids) - before)
                    owners.append(k)
                    places.append(i)
        if not sizes:
            return out
        ids, sizes, owners, places = (np.frombuffer(x, x.typecode) for x in (ids, sizes, owners, places))
        first = sizes.cumsum() - sizes
        top = np.flatnonzero((np.diff(owners, prepend=-1) != 0) | (np.diff(places, prepend=-1) != 1))  # lines that begin a paragraph
        many = np.diff(top, append=len(sizes)) > 1
        lo, hi = self._windows(first, sizes)
        wide_lo, wide_hi = self._windows(first[top][many], np.add.reduceat(sizes, top)[many])
        wrapped = np.searchsorted(first, wide_lo, "right") != np.searchsorted(first, wide_hi - 1, "right")
        wide = np.repeat([False, True], [len(lo), wrapped.sum()])
        lo, hi = np.concatenate([lo, wide_lo[wrapped]]), np.concatenate([hi, wide_hi[wrapped]])
        left = self._open(ids, lo, hi)
        lo, hi, wide = lo[left], hi[left], wide[left]
        line = np.searchsorted(first, lo, "right") - 1
        # What is left, by paragraph: windows within lines, by line, and wrapped ones.
        by: dict[int, tuple[dict[int, list], list]] = {}
        for p, j, x, y, w in zip(*(v.tolist() for v in (np.searchsorted(top, line, "right") - 1, line, lo, hi, wide)), strict=True):
            within, across = by.setdefault(p, ({}, []))
            (across if w else within.setdefault(j, [])).append((j, x, y))
        at: tuple[int, list[str], list[int]] = (-1, [], [])  # a text, its lines and where they start
        for p in sorted(by):
            k = int(owners[top[p]])
            if at[0] != k:
                split = texts[k].split("\n")
                at = k, split, list(accumulate((len(x) + 1 for x in split), initial=0))
            within, across = by[p]
            read: dict[int, list[tuple[str, int, int, int]]] = {}

            def part(j: int, lo: int, hi: int, at=at, read=read) -> list[tuple[str, int, int, int]]:
                """Words lo to hi, from the j-th line on."""
                found: list[tuple[str, int, int, int]] = []
                while lo < hi:
                    if j not in read:
                        i = int(places[j])
                        read[j] = [(m.group().lower(), at[2][i] + m.start(), at[2][i] + m.end(), i) for m in _WORD.finditer(at[1][i])]
                    start = int(first[j])
                    found += read[j][lo - start : hi - start]
                    j, lo = j + 1, start + len(read[j])
                return found

            own = [x for windows in within.values() for x in self._passages((part(*x) for x in windows), texts[k])]
            out[k] += self._merged(own, self._passages((part(*x) for x in across), texts[k]), texts[k])
        return [self._settled(x) for x in out]

    def _merged(self, own: list[dict], wide: list[dict], text: str) -> list[dict]:
        """Passages of a paragraph's lines and its wrapped ones, as ``scan`` tells."""
        for x in sorted(wide, key=lambda x: (x["family"] == UNKNOWN, x["start"])):
            over = [y for y in own if y["start"] < x["end"] and x["start"] < y["end"]]
            if x["family"] != UNKNOWN:
                own = [y for y in own if y["family"] != UNKNOWN or y["fits"] or y not in over or not self._part_of(x["family"], words(text[y["start"] : y["end"]]))]
            if x["family"] == UNKNOWN and over or any(y["family"] == x["family"] for y in over):
                continue
            own.append(x)
        return sorted(own, key=lambda x: (x["start"], x["end"]))

    @staticmethod
    def _settled(spans: list[dict]) -> list[dict]:
        """A passage that fits several families is of that one of them which the nearest passage with a family names; overlapping ones of one family are one. What fits several and stays open is unknown."""
        named = [x for x in spans if x["family"] != UNKNOWN]
        for x in spans:
            near = [y for y in named if y["family"] in x["fits"]]
            if x["family"] == UNKNOWN and near:
                x["family"] = min(near, key=lambda y: abs(y["start"] - x["start"]))["family"]
        out: list[dict] = []
        for x in spans:
            if out and x["start"] < out[-1]["end"] and x["family"] == out[-1]["family"] and x["family"] != UNKNOWN:
                if x["similarity"] > out[-1]["similarity"]:
                    out[-1] = x
            else:
                out.append(x)
        return [{k: v for k, v in x.items() if k != "fits"} for x in out]


def train(docs: DataFrame, sample: int = SAMPLE, sample_lines: int = SAMPLE_LINES, sample_chars: int = SAMPLE_CHARS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model with ``sample_lines`` lines of each of ``sample`` documents at most as prose; lines that speak of licences or rights are no prose. Null ids and texts are left out, an id gives one text."""
    rows = docs.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    ids = rows.select("id").distinct().orderBy(F.md5("id"), "id").limit(sample)
    picked = rows.join(F.broadcast(ids), "id").groupBy("id").agg(F.min(F.left("text", F.lit(sample_chars))).alias("text")).orderBy("id").collect() if sample else []
    prose = []
    for r in picked:
        lines = [x for x in r.text.split("\n") if x.strip() and not re.search(r"licen[cs]|copyright|rights|public|permission|creative commons", x, re.I)]
        prose += [" ".join(lines[i * len(lines) // sample_lines].split()[:WINDOW]) for i in range(min(sample_lines, len(lines)))] if len(lines) > sample_lines else [" ".join(x.split()[:WINDOW]) for x in lines]
    return Model(prose)


def scan(df: DataFrame, model: Model, text_col: str = "text", out: str = "licenses") -> DataFrame:
    """``df`` with column ``out``: the licence passages of each whole text.

    Null and empty texts have none. Very long texts are read by windows, as a whole; of families that tie in probability the first in ``NOTICES`` counts. Repeated rows each get their own
    passages; an empty table gives no rows. Other columns are kept, one named ``out`` is replaced.
    """
    rest = [c for c in df.columns if c not in (out, text_col)]
    rows = df.select(F.col(text_col).alias("_text"), F.struct(*(F.col(f"`{c}`") for c in rest)).alias("_row"))
    schema = with_fields(rows.schema["_row"], f"`{out}` {SPAN}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        for batch in batches:
            kind = kind or pa.list_(pa.struct([("paragraph", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("family", pa.string()), ("probability", pa.float64()), ("similarity", pa.float64()), ("predicted", pa.string())]))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(list(model.scan_all(t.as_py() for t in batch.column(0))), kind)], names=["_row", out])

    return rows.mapInArrow(run, schema).select("_row.*", out)
