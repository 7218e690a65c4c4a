"""Licence passages found by a trained sentence classifier and confirmed against templates.

A text falls into units: sentences within lines, sentences over line ends, and paragraphs (blocks
between blank lines, their lines joined). A unit is a sparse vector of hashed word
1- and 2-grams; multinomial logistic regression, trained in numpy, names its licence family or
``none``, or ``unknown``: notices of made-up licences and general clauses are a class of their own.
Probabilities are calibrated by a temperature chosen on held-out rows. A unit that no family bears out
is ``unknown`` with the calibrated probability of that class, if it reaches ``least`` and a word of
licences, permission or copying is in the unit, or with that of not being ``none``, if a usual phrase puts it
under a licence. Long units are
classified as a whole and in overlapping stretches of ``window`` words, the likeliest of which counts.
A prediction stands if the unit names the family and grants something by it, or is a notice of it (enough
word pairs of the unit lie in its notices, or of a notice in the unit), or shares ``stretch`` words in a
row with the family's full text. A unit that names no family and shares its longest stretch with the texts
of several goes to the one that the rest of the text shows, and is ``ambiguous`` otherwise. A paragraph nearly all in a family's text takes the place of the finer
units found in it; otherwise a coarse unit adds what the finer ones do not show. Every unit of every text
is classified.

Training rows are the templates, labels (``SPDX-License-Identifier: X``, ``License: X``) and full texts (whole, in
sentences, shortened, with other words around) and, as ``none``, sentences that mention a licence without granting
anything and units of a bounded hash-chosen sample of at most ``sample_docs`` documents.

Null or empty text: nothing found. Null or repeated ``doc_id``: rows stay as they are. Other columns
are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from itertools import compress
from operator import itemgetter
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm.shared import column, mixed, per_batch, text_bytes, word_ids

NONE, UNKNOWN, AMBIGUOUS = "none", "unknown", "ambiguous"

# Usual notices of each family (fixed values).
TEMPLATES: dict[str, list[str]] = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache 2.0 license.",
        "Distributed under the terms of the Apache License 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Distributed under the terms of the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "gpl-3": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GNU GPL v3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "gpl-2": [
        "This work is licensed under the GNU General Public License, version 2.",
        "Released under the GNU GPL v2.",
        "You can redistribute it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License.",
        "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License.",
    ],
    "bsd": [
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0.",
    ],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "Distributed under the terms of the Creative Commons Attribution 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "public-domain": ["This work is dedicated to the public domain under CC0 1.0.", "This is free and unencumbered software released into the public domain."],
    "all-rights-reserved": ["All rights reserved.", "Copyright holder. All rights reserved."],
    "isc": ["Licensed under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."],
    "agpl-3": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "You can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ],
    "boost": ["Distributed under the Boost Software License, Version 1.0."],
}

# Names and SPDX identifiers of each family (fixed values).
TITLES: dict[str, list[str]] = {
    "apache-2.0": ["Apache License, Version 2.0", "Apache-2.0"],
    "mit": ["MIT License", "MIT"],
    "gpl-3": ["GNU General Public License, version 3", "GPL-3.0-only", "GPL-3.0-or-later"],
    "gpl-2": ["GNU General Public License, version 2", "GPL-2.0-only", "GPL-2.0-or-later"],
    "lgpl": ["GNU Lesser General Public License", "LGPL-2.1-or-later", "LGPL-3.0-only"],
    "bsd": ["BSD License", "BSD-2-Clause", "BSD-3-Clause"],
    "mpl-2.0": ["Mozilla Public License, Version 2.0", "MPL-2.0"],
    "cc-by": ["Creative Commons Attribution 4.0 International License", "CC-BY-4.0"],
    "cc-by-nc": ["Creative Commons Attribution-NonCommercial 4.0 International License", "CC-BY-NC-4.0"],
    "cc-by-sa": ["Creative Commons Attribution-ShareAlike 4.0 International License", "CC-BY-SA-4.0"],
    "public-domain": ["public domain", "CC0-1.0", "Unlicense"],
    "all-rights-reserved": [],
    "isc": ["ISC License", "ISC"],
    "agpl-3": ["GNU Affero General Public License, version 3", "AGPL-3.0-only", "AGPL-3.0-or-later"],
    "boost": ["Boost Software License, Version 1.0", "BSL-1.0"],
}
LABELS = ["SPDX-License-Identifier: {}", "License: {}", "Sous licence {}."]
# Notices of a licence by name, whatever it is called, and clauses that several licences hold.
NOTICES = [
    "Licensed under the {}.", "Released under the {}.", "This work is licensed under the {}.", "Distributed under the terms of the {}.",
    "This program and its parts are made available under the terms of the {}.", "You may use this library under the terms of the {} as approved by its authors.",
    "Use of this source code is governed by the {}.", "All files of this project are covered by the {}.",
]
# Names close to those of a family, with other terms.
UNLISTED = ["Apache License, Version 1.1", "CC BY-NC-SA 4.0", "CC BY-ND 4.0", "CC BY-NC-ND 4.0",
            "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", "Creative Commons Attribution-NoDerivatives 4.0 International License"]
CLAUSES = [
    "Permission is granted to anyone to use, alter and redistribute this software for any purpose.",
    "Permission to use, copy and modify this software for commercial applications is granted if this notice stays in place.",
    "You may redistribute this work freely as long as you name its authors.",
    "Modified versions must be marked as such and must not be misrepresented as the original software.",
    "Redistribution of this data is allowed under the terms of its licence only.",
]
# Licences that are mentioned, and licences of other kinds: nothing is granted.
MENTIONS = ["A history of the {} appeared last year.", "He read about the {} on the train.", "Many people discuss the wording of the {}.",
            "The {} is older than its authors thought.", "What does the {} say about this?"]
EVERYDAY = [
    "Her driving licence ran out in May.", "The council granted a licence to sell beer to the shop.", "Doctors are licensed by the state.",
    "We were licensed to fly across the lake.", "The medicine was distributed under the terms of this contract.", "Food was distributed under the terms of this law.",
    "The film was released under another title.", "The number of the license plate is unknown.", "She lost her fishing license.", "The book is available under the counter.",
    "Permission to enter was granted by the guard.", "Everyone is permitted to sing.", "The shop sold goods under license until the war.",
    "The vaccine was distributed under this license by the ministry.",
]

# How a text names a family, on words joined by single spaces.
_NAMES = {family: re.compile(pattern) for family, pattern in {
    "apache-2.0": rb"\bapache (?:software |public )?licen[cs]e (?:version |v )?(?:2|v2)\b|\bapache 2(?: 0)? (?:software )?licen[cs]e|\bapache 2 0\b|apache org licenses license 2 0",
    "mit": rb"\b(?:mit|expat) (?:style )?licen[cs]ed?\b|under mit\b|(?:\blicen[cs]e identifier|\bsous licen[cs]e|^licen[cs]e) mit\b",
    "gpl-3": rb"(?<!lesser )(?<!affero )general public licen[cs]e (?:\w+ ){0,10}?(?:version |v )?(?:3|v3)\b|\bgpl ?(?:version ?|v ?)?3\b",
    "gpl-2": rb"(?<!lesser )(?<!affero )general public licen[cs]e (?:\w+ ){0,10}?(?:version |v )?(?:2|v2)\b|\bgpl ?(?:version ?|v ?)?2\b",
    "lgpl": rb"\b(?:lesser|library) general public licen[cs]e|\blgpl",
    "bsd": rb"\bbsd(?: \w+ clause| style)? licen[cs]e|\bbsd \d clause|clause bsd\b",
    "mpl-2.0": rb"\bmozilla public licen[cs]e (?:version |v )?2\b|\bmpl (?:version |v )?2\b",
    "cc-by": rb"\bcc by(?! n[cd]\b| sa\b)|\bcreative commons attribution(?! non| no| share| nc| nd| sa)",
    "cc-by-nc": rb"\b(?:cc by nc|creative commons attribution non ?commercial)\b(?! sa\b| nd\b| share| no)",
    "cc-by-sa": rb"\b(?:cc by sa|creative commons attribution share ?alike)\b",
    "public-domain": rb"\bcc0\b|\bpublic domain\b|\bunlicense\b",
    "all-rights-reserved": rb"\ball rights reserved\b",
    "isc": rb"\bisc licen[cs]e\b|(?:\blicen[cs]e identifier|\bsous licen[cs]e|^licen[cs]e) isc\b",
    "agpl-3": rb"\baffero general public licen[cs]e|\bagpl",
    "boost": rb"\bboost software licen[cs]e\b|\bbsl 1 0\b",
}.items()}
# Words by which a sentence puts something under the licence it names.
_GRANT = re.compile(rb"\b(?:licen[cs]ed|licen[cs]ing|(?:re)?distributed|redistribute|released|available|published|provided|offered|covered|governed|subject|terms|under|sous licen[cs]e|dedicated|spdx)\b")
# A licence named by none of the words that name a family: its clauses may be those of a family.
_OTHER = re.compile(
    rb"\b(?:licen[cs]ed|released|distributed|available|redistribute \w+|terms(?: and conditions)?) (?:under|of) (?:the |a |an )?(?:terms of (?:the |a |an )?)?"
    rb"(?!(?:the|a|an|this|that|these|those|such|any|its|your|our|section|secondary|terms|same|following|new|above|applicable|either|sections|licen[cs]es?) )"
    rb"(?:(?!apache|mit |expat|x11|gnu|gpl|general|lesser|library|bsd|berkeley|mozilla|mpl|creative|cc|isc|boost|affero|agpl|licen[cs]e)[a-z0-9]+ ){1,6}(?:public )?licen[cs]e\b")
_TEXTS = Path(__file__).parent / "licence_texts"

# How texts talk of their licence, whichever it is: such units of the sample are no examples of ``none``.
_LIKE = re.compile(
    rb"\b(?:licen[cs]ed|licen[cs]ing|released|(?:re)?distributed|available|published|provided|offered|covered|governed)(?: \w+){0,3}? (?:under|by|to)(?: \w+){0,9}? (?:licen[cs]es?|gpl|lgpl|cc)\b"
    rb"|\blicen[cs]ed under\b|\bterms (?:and conditions )?of (?:\w+ ){1,8}?licen[cs]e|\bpublic licen[cs]e\b|\bspdx licen[cs]e\b|\bthis licen[cs]e\b|\bcopy of the licen[cs]e\b"
    rb"|\bpermission (?:\w+ ){0,20}?(?:is )?(?:hereby )?granted\b|\bredistributions?\b|\bredistribute\b|\bwithout (?:any )?(?:express or implied )?warrant(?:y|ies)\b"
    rb"|\bas is without\b|\brights? reserved\b")

# What speaks of no licence, permission or copying at all is no unknown licence, however likely.
_TALK = re.compile(rb"\b(?:sub)?licen[cs]|\bpermi(?:ssion|tted)|\bredistribut|\bspdx\b|\bcop(?:y|ies)\b|\bcopyright")

_TOKEN = re.compile(rb"[a-z0-9]+|\n(?:[ \t\r]*\n)+|\n|[.!?](?=\s|$)")
_UNIT = re.compile(rb"[^\n]+?(?:[.!?](?=\s)|(?=\n)|$)")
_WORD = re.compile(rb"[a-z0-9]+")
_BREAKS = np.frombuffer(b"\n.!?", np.uint8)
_GRAM = 6


@dataclass
class Settings:
    bits: int = 16
    sample_docs: int = 1_000
    copies: int = 40
    epochs: int = 60
    rate: float = 0.05
    decay: float = 1e-4
    least: float = 0.5
    overlap: float = 0.6
    stretch: int = 8
    window: int = 24
    whole: float = 0.8
    seed: int = 5


def features(ids: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of words, and of each word with the one before it."""
    shift = np.uint64(64 - bits)
    one = (mixed(ids) >> shift).astype(np.int64)
    two = (mixed(ids[:-1] * np.uint64(0x9E3779B97F4A7C15) + ids[1:]) >> shift).astype(np.int64)
    return one, two


class Model:
    """Weights (features x families), bias, temperature and the families' notices and full texts.

    A family's notices are sets of word pairs; runs of six words come from its full text, where there
    is one, and from those notices that do not name it."""

    def __init__(self, families: list[str], weights: np.ndarray, bias: np.ndarray, heat: float, s: Settings, full: dict[str, str]):
        self.families, self.weights, self.bias, self.heat, self.s = families, weights, bias, heat, s
        self.notices: list[list[set]] = []
        self.runs: dict[bytes, int] = {}
        for k, f in enumerate(families):
            labels = [label.format(t) for t in TITLES.get(f, []) for label in LABELS]
            given = [_WORD.findall(t.lower().encode()) for t in (*TEMPLATES.get(f, []), *labels)]
            self.notices.append([pairs_of(w) for w in given])
            clauses = [w for w in given if f in _NAMES and not _NAMES[f].search(b" ".join(w))]
            for words in [*clauses, _WORD.findall(full.get(f, "").lower().encode())]:
                for run in runs_of(words):
                    self.runs[run] = self.runs.get(run, 0) | 1 << k

    def probabilities(self, ids: np.ndarray, first: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Calibrated probabilities of the ranges ``first`` to ``after`` (excluded) of the words."""
        one, two = features(ids, self.s.bits)
        each = self.weights[one]
        each[1:] += self.weights[two]
        upto = np.zeros((len(ids) + 1, len(self.families)))
        np.cumsum(each, 0, np.float64, upto[1:])
        z = upto[after] - upto[first]
        cut = first > 0
        z[cut] -= self.weights[two[first[cut] - 1]]
        z /= np.sqrt(2 * (after - first) - 1)[:, None]
        z = (z + self.bias) / self.heat
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def stretches(self, words: list[bytes]) -> dict[int, int]:
        """Words of the longest stretch shared with each family's texts, from six words on."""
        best: dict[int, int] = {}
        now: dict[int, int] = {}
        for run in runs_of(words):
            held = self.runs.get(run, 0)
            now = {k: now.get(k, _GRAM - 1) + 1 for k in range(len(self.families)) if held >> k & 1} if held else {}
            for k, n in now.items():
                best[k] = max(best.get(k, 0), n)
        return best

    def named(self, phrase: bytes, own: set, family: int) -> bool:
        """The words name the family, and put something under it or are a notice of it: enough of their
        pairs lie in its notices, or enough of one notice's pairs in them."""
        if not _NAMES[self.families[family]].search(phrase):
            return False
        notices, most = self.notices[family], self.s.overlap
        return bool(_GRANT.search(phrase) or any(len(own & n) >= most * len(n) for n in notices)
                    or len(own & set().union(*notices)) >= most * len(own))

    def confirmed(self, words: list[bytes], candidates: list[int]) -> list[int]:
        """Those of ``candidates`` (likeliest first) that the words bear out: all they name or, if they
        name none, the one whose texts share the longest stretch with them; -1 if several share it."""
        phrase, own = b" ".join(words), pairs_of(words)
        named = [k for k in candidates if self.named(phrase, own, k)]
        if named or _OTHER.search(phrase):
            return named
        alike = self.alike(words)
        return [] if not alike or not set(alike) & set(candidates) else alike if len(alike) == 1 else [-1]

    def alike(self, words: list[bytes]) -> list[int]:
        """The families whose texts share the longest stretch, of ``stretch`` words or more, with the words."""
        shared = self.stretches(words)
        longest = max(shared.values(), default=0)
        return [k for k, n in shared.items() if n == longest] if longest >= self.s.stretch else []

    def whole(self, words: list[bytes], family: int) -> bool:
        """Nearly all words lie in runs shared with the family's texts."""
        held = np.fromiter((self.runs.get(r, 0) >> family & 1 for r in runs_of(words)), np.int64)
        return int(np.count_nonzero(np.convolve(held, np.ones(_GRAM, int)))) >= self.s.whole * len(words) if len(held) else False


def pairs_of(words: list[bytes]) -> set[tuple[bytes, bytes]]:
    return set(zip(words, words[1:]))


def runs_of(words: list[bytes]) -> list[bytes]:
    return [b" ".join(words[i : i + _GRAM]) for i in range(len(words) - _GRAM + 1)]


def full_texts() -> dict[str, str]:
    """The full licence texts in ``licence_texts``, by family (read by the driver only)."""
    return {f.stem: f.read_text(encoding="utf-8") for f in sorted(_TEXTS.glob("*.txt"))}


def units_of(text: bytes) -> list[tuple[int, int]]:
    return [m.span() for m in _UNIT.finditer(text)]


def train(negatives: list[bytes], s: Settings) -> Model:
    """Softmax regression by full-batch Adam on sparse rows; a fifth of the rows sets the temperature."""
    rng = np.random.default_rng(s.seed)
    families = [NONE, *TEMPLATES, UNKNOWN]
    spare = [w for n in negatives[:2000] for w in _WORD.findall(n.lower())] or [b"a"]
    rows: list[tuple[list[bytes], int]] = []
    full = full_texts()

    def invented(short: bool) -> str:
        """A licence of a made-up name, or a made-up identifier."""
        if short:
            return spare[rng.integers(0, len(spare))].decode() + (f"-{rng.integers(1, 5)}.{rng.integers(0, 3)}" if rng.integers(0, 2) else "")
        name = " ".join(spare[j].decode() for j in rng.integers(0, len(spare), rng.integers(1, 4)))
        kind = ("License", "Public License", "Licence", "Community License")[rng.integers(0, 4)]
        return f"{name} {kind}" + (f", Version {rng.integers(1, 5)}.{rng.integers(0, 3)}" if rng.integers(0, 2) else "")

    for k, family in enumerate(families[1:-1], 1):
        blocks = [" ".join(x.split()) for x in re.split(r"\n\s*\n", full.get(family, ""))]
        parts = [x for block in blocks for x in re.split(r"(?<=[.;!?])\s", block)]
        labels = [label.format(t) for t in TITLES[family] for label in LABELS]
        for text, copies in [*((t, s.copies) for t in TEMPLATES[family]), *((t, s.copies // 4) for t in labels), *((t, 2) for t in parts)]:
            words = _WORD.findall(text.lower().encode())
            if copies == 2 and len(words) < 8:
                continue
            rows += [(words, k)] * (copies // 4)
            for i in range(copies):
                a = rng.integers(0, max(1, len(words) // 4))
                b = len(words) - rng.integers(0, max(1, len(words) // 4))
                noise = [spare[j] for j in rng.integers(0, len(spare), rng.integers(0, s.window - 7 if i % 2 else 3))]
                at = rng.integers(0, len(noise) + 1) if i % 2 else len(noise) * rng.integers(0, 2)
                # A label is kept whole: its last words are the name.
                rows.append((noise[:at] + (words if text in labels else words[a:b]) + noise[at:], k))
    for text, copies, k in [*((t, 4 * s.copies, len(families) - 1) for t in (*NOTICES, *LABELS)), *((t, s.copies, len(families) - 1) for t in CLAUSES),
                            *((t.format(x), 6, len(families) - 1) for t in NOTICES for x in UNLISTED),
                            *((t, 2, 0) for t in EVERYDAY), *((m.format(t), 1, 0) for m in MENTIONS for f in TITLES.values() for t in f)]:
        for i in range(copies):
            words = _WORD.findall(text.format(invented(text in LABELS)).lower().encode())
            words = words[rng.integers(0, max(1, len(words) // 4)) if k and text not in LABELS else 0 :]
            noise = [spare[j] for j in rng.integers(0, len(spare), rng.integers(0, s.window - 7) if i % 2 else 0)]
            at = rng.integers(0, len(noise) + 1)
            rows.append((noise[:at] + words + noise[at:], k))
    known = Model(families, np.zeros((1 << s.bits, 1)), np.zeros(1), 1.0, s, full)
    everyone = list(range(1, len(families) - 1))
    for n in negatives:
        words = _WORD.findall(n.lower())
        if words and not _LIKE.search(b" ".join(words)) and not known.confirmed(words, everyone):
            rows.append((words, 0))
    order = rng.permutation(len(rows))
    rows = [rows[i] for i in order]
    truth = np.array([r[1] for r in rows])
    unit = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    ids = word_ids([w for r in rows for w in r[0]])
    one, two = features(ids, s.bits)
    inside = unit[1:] == unit[:-1]
    at, col = np.concatenate([unit, unit[1:][inside]]), np.concatenate([one, two[inside]])
    used, col = np.unique(col, return_inverse=True)
    value = 1 / np.sqrt(np.bincount(at, minlength=len(rows)))[at]
    weights, bias = np.zeros((len(used), len(families))), np.zeros(len(families))
    fold = np.arange(len(rows)) % 5 == 0
    importance = np.where(fold, 0, 1 / np.bincount(truth, minlength=len(families))[truth])
    importance /= importance.sum()
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(bias), np.zeros_like(bias)]

    def scores() -> np.ndarray:
        z = np.stack([np.bincount(at, value * weights[col, k], len(rows)) for k in range(len(families))], 1)
        return z + bias

    for step in range(1, s.epochs + 1):
        z = scores()
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(rows)), truth] -= 1
        p *= importance[:, None]
        slope = np.stack([np.bincount(col, value * p[at, k], len(used)) for k in range(len(families))], 1) + s.decay * weights
        for v, g, a, b in ((weights, slope, moments[0], moments[1]), (bias, p.sum(0), moments[2], moments[3])):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            v -= s.rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    z = scores()[fold]
    best, heat = np.inf, 1.0
    for t in np.geomspace(0.2, 5, 25):
        y = z / t
        loss = float(np.mean(np.log(np.exp(y - y.max(1, keepdims=True)).sum(1)) + y.max(1) - y[np.arange(len(y)), truth[fold]])) if len(y) else 0.0
        if loss < best:
            best, heat = loss, float(t)
    dense = np.zeros((1 << s.bits, len(families)), np.float32)
    dense[used] = weights
    return Model(families, dense, bias, heat, s, full)


def windows(first: np.ndarray, after: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit, begin, end) of every unit's whole range and, in longer ones, of its stretches of ``size``
    words, half of them shared with the next."""
    more = np.maximum(0, -(-(after - first - size) // (size // 2)))
    more = np.where(after - first > size, more + 1, 0)
    unit = np.repeat(np.arange(len(first)), more)
    nth = np.arange(len(unit)) - np.repeat(np.cumsum(more) - more, more)
    begin = np.minimum(first[unit] + nth * (size // 2), after[unit] - size)
    return (np.concatenate([np.arange(len(first)), unit]), np.concatenate([first, begin]), np.concatenate([after, begin + size]))


def fit(docs: DataFrame, s: Settings | None = None) -> Model:
    s = s or Settings()
    n = docs.count()
    step = max(1, n // s.sample_docs)
    size = 600
    start = (F.greatest(F.length("text") - size, F.lit(0)) * F.pmod(F.xxhash64("text"), F.lit(97)) / 97).cast("int") + 1
    rows = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(step)) == 0).select(F.substring("text", start, F.lit(size)).alias("cut"))
    cuts = rows.orderBy(F.xxhash64("cut"), "cut").limit(2 * s.sample_docs).collect()
    negatives = [r["cut"].encode()[a:b] for r in cuts if r["cut"] for a, b in units_of(r["cut"].encode())]
    return train(negatives[: 20 * s.sample_docs], s)


def ranges(cuts: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and after-last word of the stretches of words between ``cuts`` (both by token)."""
    level = np.cumsum(cuts)[word]
    first = np.concatenate([[0], np.flatnonzero(np.diff(level)) + 1])
    return first, np.append(first[1:], len(level))


def verdicts(words: list[bytes], p: np.ndarray, model: Model) -> dict[int, float]:
    """Probabilities of the families that the words bear out (-1: several alike, their sum); of ``UNKNOWN``
    as 0 if there is none."""
    last = len(p) - 1
    likely = [int(f) for f in np.argsort(-p, kind="stable") if 0 < f < last and p[f] >= model.s.least]
    if likely:
        held = model.confirmed(words, likely)
    else:
        held = [-1] if p[1:last].sum() >= model.s.least and len(model.alike(words)) > 1 else []
    if held:
        return {f: float(min(1.0, p[model.alike(words)].sum()) if f < 0 else p[f]) for f in held}
    phrase = b" ".join(words)
    if p[last] >= model.s.least:
        return {0: float(p[last])} if _TALK.search(phrase) else {}
    # Put under a licence by a usual phrase, like a family's but borne out by none.
    return {0: float(1 - p[0])} if p[0] <= 1 - model.s.least and _LIKE.search(phrase) else {}


def agreed(found: list[tuple[int, int, int, float]], words: list[bytes], model: Model) -> list[tuple[int, int, int, float]]:
    """A passage that several families' texts hold goes to one that the rest of the text shows, if its own
    family is shown by no passage of its own or is open."""
    if len({v[0] for v in found}) < 2:
        return found
    fits = [[f for f in range(1, len(model.families) - 1) if model.whole(words[v[1] : v[2]], f)] for v in found]
    own = Counter(v[0] for v, f in zip(found, fits) if v[0] > 0 and f in ([], [v[0]]))
    out = []
    for v, f in zip(found, fits):
        others = [g for g in f if own[g]] if v[0] and not own.get(v[0]) else []
        out.append((max(others, key=lambda g: own[g]), *v[1:]) if others else v)
    return out


def scan_text(text: bytes, model: Model) -> tuple[int, list[tuple[str, int, int, float]]]:
    """Number of classified units with a word, and (family, start, end, probability) of the confirmed,
    ambiguous and unknown ones; offsets are code points."""
    low = text.lower()
    tokens = _TOKEN.findall(low)
    if not tokens:
        return 0, []
    lead = np.fromiter(map(itemgetter(0), tokens), np.uint8, len(tokens))
    breaks = np.isin(lead, _BREAKS)
    words = list(compress(tokens, ~breaks))
    if not words:
        return 0, []
    # Pieces of lines, then sentences over line ends and blocks between blank lines that hold several.
    blank = breaks & (np.fromiter(map(len, tokens), np.int64, len(tokens)) > 1)
    first, after = ranges(breaks, ~breaks)
    pieces, inner = len(first), first
    for cuts in ((breaks & (lead != 10)) | blank, blank):
        a, b = ranges(cuts, ~breaks)
        several = np.searchsorted(inner, b) - np.searchsorted(inner, a) > 1
        first, after, inner = np.append(first, a[several]), np.append(after, b[several]), a
    unit, begin, end = windows(first, after, model.s.window)
    p = model.probabilities(word_ids(words), begin, end)
    if not (p[:, 0] <= 1 - model.s.least).any():
        return len(first), []
    found: list[tuple[int, int, int, float]] = []
    hit: dict[int, list[int]] = {}
    for r in np.flatnonzero(p[:, 0] <= 1 - model.s.least):
        hit.setdefault(int(unit[r]), []).append(int(r))
    for k in sorted(hit):
        a, b = int(first[k]), int(after[k])
        if k < pieces:
            # The likeliest stretch counts, and the whole piece bears it out.
            likely = p[hit[k]].max(0)
            likely[0] = p[hit[k], 0].min()
            found += [(f, a, b, x) for f, x in verdicts(words[a:b], likely, model).items()]
            continue
        # A coarse unit adds what no finer one shows, or takes the place of those that are parts of it.
        held: dict[int, tuple[float, int, int]] = {}
        for r in hit[k]:
            if b - a <= model.s.window or end[r] - begin[r] < b - a:
                for f, x in verdicts(words[begin[r] : end[r]], p[r], model).items():
                    held[f] = max(held.get(f, (0.0, 0, 0)), (x, int(begin[r]), int(end[r])))
        for f, (x, since, until) in held.items():
            parts = [v for v in found if a <= v[1] and v[2] <= b]
            if f > 0 and model.whole(words[a:b], f):
                gone = {v for v in parts if v[0] in (0, -1, f) or model.whole(words[v[1] : v[2]], f)}
                found = [v for v in found if v not in gone] + [(f, a, b, max([x, *(v[3] for v in gone if v[0] == f)]))]
            elif not parts or (f > 0 and all(v[0] != f for v in parts) and _NAMES[model.families[f]].search(b" ".join(words[a:b]))):
                found = [v for v in found if not (f and v in parts and v[0] <= 0 and v[1] < until and since < v[2])] + [(f, a, b, x)]
    found = agreed(found, words, model)
    if not found:
        return len(first), []
    spots = [ab for ab in units_of(low) if _WORD.search(low, *ab)]
    starts, stops = {int(w): ab[0] for w, ab in zip(first, spots)}, {int(w): ab[1] for w, ab in zip(after, spots)}
    out = []
    for f, a, b, x in sorted(found, key=lambda v: (v[1], v[2], v[0])):
        start = len(text[: starts[a]].decode("utf-8", "replace"))
        out.append((AMBIGUOUS if f < 0 else model.families[f] if f else UNKNOWN, start, start + len(text[starts[a] : stops[b]].decode("utf-8", "replace")), x))
    return len(first), out


def licence_scan(docs: DataFrame, model: Model | None = None, s: Settings | None = None) -> DataFrame:
    """doc_id, n_units, n_licence, families, spans, score of every row of ``docs`` (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs, s))

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            units, counts, families, spans, scores = [], [], [], [], []
            for text in text_bytes(batch):
                n, found = scan_text(text, shared.value)
                units.append(n)
                counts.append(len(found))
                families.append(",".join(sorted({f[0] for f in found})))
                spans.append(",".join(f"{f}:{a}:{b}" for f, a, b, _ in found))
                scores.append(max((f[3] for f in found), default=0.0))
            made = [pa.array(units, pa.int64()), pa.array(counts, pa.int64()), pa.array(families, pa.string()), pa.array(spans, pa.string()), pa.array(scores, pa.float64())]
            return pa.RecordBatch.from_arrays([column(batch, "doc_id"), *made], names=["doc_id", "n_units", "n_licence", "families", "spans", "score"])

        return step

    kind = docs.schema["doc_id"].dataType.simpleString()
    return per_batch(docs, make, f"doc_id {kind}, n_units bigint, n_licence bigint, families string, spans string, score double")
