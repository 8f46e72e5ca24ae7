"""License templates longer than a line: titles, headers and full texts, found in windows of a file's terms."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from itertools import pairwise
from pathlib import Path

import numpy as np

#: Cosine from which a window counts as a full text or title; stop words alone bring long texts of one language close.
FULL_THRESHOLD = 0.9


@dataclass(frozen=True)
class Form:
    """A template. ``keys``: terms that a window must have whatever its cosine. ``aligned``: only whole lines count."""

    name: str
    text: str
    keys: frozenset[str] = frozenset()
    aligned: bool = False
    full: bool = False
    #: Only for files whose lines are all below the threshold.
    notice: bool = False


#: Terms that tell a license from its neighbours; those that a title, header or notice has must be in a window.
KEYS = {
    "AGPL-3.0": "agpl affero 3 3.0 v3", "Apache-2.0": "apache 2.0", "BSD-2-Clause": "bsd 2", "BSD-3-Clause": "bsd 3", "CC-BY-4.0": "cc by attribution 4.0",
    "CC-BY-NC-4.0": "cc by nc attribution noncommercial 4.0", "CC-BY-NC-ND-4.0": "cc by nc nd attribution noncommercial noderivatives 4.0",
    "CC-BY-NC-SA-4.0": "cc by nc sa attribution noncommercial sharealike 4.0", "CC-BY-ND-4.0": "cc by nd attribution noderivatives 4.0",
    "CC-BY-SA-4.0": "cc by sa attribution sharealike 4.0", "CC0-1.0": "cc0 1.0", "GPL-1.0": "gpl general 1 1.0 v1", "GPL-2.0": "gpl general 2 2.0 v2",
    "GPL-3.0": "gpl general 3 3.0 v3", "LGPL-2.0": "lgpl library 2 2.0", "LGPL-2.1": "lgpl lesser 2.1", "LGPL-3.0": "lgpl lesser 3 3.0 v3", "MIT": "mit",
    "MPL-1.1": "mozilla mpl 1.1", "MPL-2.0": "mozilla mpl 2.0",
}
#: Terms that a window of a full text must have.
FULL_KEYS = {"Apache-2.0": "apache license", "BSD-2-Clause": "redistributions disclaimer", "BSD-3-Clause": "redistributions disclaimer endorse",
             "CC0-1.0": "cc0 waiver", "LGPL-2.0": "library gnu general", "LGPL-2.1": "lesser gnu general", "LGPL-3.0": "lesser gnu general",
             "MIT": "sublicense hereby noninfringement", "MPL-1.1": "covered contributor mozilla", "MPL-2.0": "covered contributor incompatible"}
TITLES = {
    "AGPL-3.0": ["GNU Affero General Public License Version 3, 19 November 2007", "GNU Affero General Public License v3.0"],
    "Apache-2.0": ["Apache License Version 2.0, January 2004", "Apache License Version 2.0", "Apache License 2.0", "Apache 2.0 License",
                   "Apache Software License 2.0", "License: Apache-2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", "License: BSD-2-Clause"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "License: BSD-3-Clause"],
    "CC0-1.0": ["CC0 1.0 Universal", "Creative Commons Legal Code CC0 1.0 Universal", "License: CC0-1.0"],
    "GPL-1.0": ["GNU General Public License Version 1, February 1989"],
    "GPL-2.0": ["GNU General Public License Version 2, June 1991", "GNU General Public License Version 2", "GNU General Public License v2.0", "GNU GPL v2"],
    "GPL-3.0": ["GNU General Public License Version 3, 29 June 2007", "GNU General Public License Version 3", "GNU General Public License v3.0", "GNU GPL v3"],
    "LGPL-2.0": ["GNU Library General Public License Version 2, June 1991"],
    "LGPL-2.1": ["GNU Lesser General Public License Version 2.1, February 1999", "GNU Lesser General Public License v2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License Version 3, 29 June 2007", "GNU Lesser General Public License Version 3", "GNU Lesser General Public License v3.0"],
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "License: MIT"],
    "MPL-1.1": ["Mozilla Public License Version 1.1"],
    "MPL-2.0": ["Mozilla Public License Version 2.0", "Mozilla Public License 2.0", "License: MPL-2.0"],
}
_GNU = ("is free software; you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation; "
        "either version {} of the License, or (at your option) any later version.")
_GNU_ONLY = "you can redistribute it and/or modify it under the terms of the GNU {} version {} as published by the Free Software Foundation."
_CC = ("By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this "
       "Creative Commons {} 4.0 International Public License (\"Public License\").")
HEADERS = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "MIT": ["Use of this source code is governed by an MIT-style license that can be found in the LICENSE file"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
                "with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0."],
}
for _name, _long, _version in (("AGPL-3.0", "Affero General Public License", "3"), ("GPL-1.0", "General Public License", "1"), ("GPL-2.0", "General Public License", "2"),
                               ("GPL-3.0", "General Public License", "3"), ("LGPL-2.0", "Library General Public License", "2"),
                               ("LGPL-2.1", "Lesser General Public License", "2.1"), ("LGPL-3.0", "Lesser General Public License", "3")):
    HEADERS[_name] = [_GNU.format(_long, _version), _GNU_ONLY.format(_long, _version)]
for _name, _long in (("CC-BY-4.0", "Attribution"), ("CC-BY-NC-4.0", "Attribution-NonCommercial"), ("CC-BY-SA-4.0", "Attribution-ShareAlike"),
                     ("CC-BY-ND-4.0", "Attribution-NoDerivatives"), ("CC-BY-NC-SA-4.0", "Attribution-NonCommercial-ShareAlike"),
                     ("CC-BY-NC-ND-4.0", "Attribution-NonCommercial-NoDerivatives")):
    HEADERS[_name] = [_CC.format(_long), f"This work is licensed under a Creative Commons {_long} 4.0 International License."]
    TITLES[_name] = [f"Creative Commons {_long} 4.0 International Public License", f"Creative Commons {_long} 4.0 International", f"{_long} 4.0 International",
                     f"License: {_name}"]


def known_forms(terms: Callable[[str], list[str]]) -> list[Form]:
    """Titles, headers, SPDX tags and full texts."""
    def keyed(name: str, text: str, **more: bool) -> Form:
        return Form(name, text, frozenset(KEYS[name].split()).intersection(terms(text)), **more)

    out = [keyed(name, text, aligned=True) for name, texts in TITLES.items() for text in texts]
    out += [keyed(name, text) for name, texts in HEADERS.items() for text in texts]
    for name in KEYS:
        tag = f"SPDX-License-Identifier: {name}"
        out.append(Form(name, tag, frozenset(terms(tag))))
    for file in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        keys = FULL_KEYS.get(file.stem, "gnu general public license")
        out.append(Form(file.stem, file.read_text(), frozenset(keys.split()), full=True))
    return out


class Windows:
    """The best cosine of any window of a text to a form; a window has as many terms as its form, or the whole text if that has fewer."""

    def __init__(self, forms: Iterable[Form], terms: Callable[[str], list[str]], idf: dict[str, float], unseen: float, threshold: float):
        self.forms, self.unseen = list(forms), unseen
        counts = [Counter(terms(f.text)) for f in self.forms]
        self.index = {t: i for i, t in enumerate(sorted(set().union(*counts)))}
        self.idf = np.array([idf[t] for t in self.index])
        self.weights = np.zeros((len(self.forms), len(self.index)))
        for i, found in enumerate(counts):
            for term, n in found.items():
                self.weights[i, self.index[term]] = n * idf[term]
        self.norms = np.sqrt((self.weights**2).sum(axis=1))
        self.lengths = [c.total() for c in counts]
        self.least = np.array([max(threshold, FULL_THRESHOLD) if f.full or f.aligned else threshold for f in self.forms])
        # A text whose terms have less than this share of a form's square has no window near it.
        self.shares = np.ascontiguousarray((self.weights / self.norms[:, None]).T ** 2)
        self.keys = [[self.index[k] for k in sorted(f.keys)] for f in self.forms]
        self.notices = np.array([f.notice for f in self.forms])

    def scan(self, text: str, spans: Callable, with_notices: bool) -> tuple[float, str | None, int]:
        """Cosine, license and line (of the first term) of the nearest window; 0 where none reaches its threshold."""
        text = text.lower()
        words = [m.span() for m in spans(text)]
        known = [self.index.get(text[a:b]) for a, b in words]
        present = sorted({i for i in known if i is not None})
        if not present:
            return 0.0, None, -1
        may = self.shares[present].sum(axis=0) >= self.least**2 - 1e-9
        if not with_notices:
            may &= ~self.notices
        held = set(present)
        chosen = [f for f in np.flatnonzero(may) if held.issuperset(self.keys[f])]
        if not chosen:
            return 0.0, None, -1
        others: dict[str, int] = {}
        ids = np.array([others.setdefault(text[a:b], len(self.index) + len(others)) if i is None else i for i, (a, b) in zip(known, words, strict=True)])
        weight = np.where(ids < len(self.index), self.idf[np.minimum(ids, len(self.index) - 1)], self.unseen)
        starts = np.array([a for a, _ in words])
        breaks = np.flatnonzero(np.array(list(text)) == "\n") if "\n" in text else np.zeros(0, int)
        lines = np.searchsorted(breaks, starts)
        first = np.concatenate(([True], lines[1:] != lines[:-1]))
        last = np.concatenate((first[1:], [True]))
        squares = np.concatenate(([0.0], np.cumsum(weight**2)))
        best: tuple[float, int, float, str | None, int] = (0.0, 0, 0.0, None, -1)
        for f in chosen:
            size = min(self.lengths[f], len(ids))
            own = np.append(self.weights[f], 0.0)[np.minimum(ids, len(self.index))]
            sums = np.concatenate(([0.0], np.cumsum(own * weight)))
            dots = sums[size:] - sums[:-size]
            # Repeated terms only add to a window's square.
            near = dots >= (self.least[f] - 1e-9) * self.norms[f] * np.sqrt(np.maximum(0, squares[size:] - squares[:-size]))
            for key in self.keys[f]:
                n = np.concatenate(([0], np.cumsum(ids == key)))
                near &= n[size:] > n[:-size]
            if self.forms[f].aligned:
                near &= first[: len(near)] & last[size - 1 :]
            places = np.flatnonzero(near)
            if len(places):
                cosines = dots[places] / (self.norms[f] * np.sqrt(exact_squares(ids, weight, places, size)))
                at = int(cosines.argmax())
                if cosines[at] >= self.least[f]:
                    found = (round(float(cosines[at]), 9), self.lengths[f])
                    if found > best[:2]:
                        best = (*found, float(cosines[at]), self.forms[f].name, int(lines[places[at]]))
        return best[2:]


def exact_squares(ids: np.ndarray, weight: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """Squared lengths of the windows that begin at ``places`` (rising): each from the one before where they overlap."""
    out, counts, square = np.empty(len(places)), Counter(), 0.0
    squares = (weight**2).tolist()
    listed = ids.tolist()

    def add(i: int) -> float:
        counts[listed[i]] += 1
        return squares[i] * (2 * counts[listed[i]] - 1)

    def drop(i: int) -> float:
        counts[listed[i]] -= 1
        return squares[i] * (2 * counts[listed[i]] + 1)

    square = sum(map(add, range(places[0], places[0] + size)))
    out[0] = square
    for k, (before, now) in enumerate(pairwise(places.tolist()), 1):
        if now - before < size:
            square += sum(map(add, range(before + size, now + size))) - sum(map(drop, range(before, now)))
        else:
            counts.clear()
            square = sum(map(add, range(now, now + size)))
        out[k] = square
    return out
