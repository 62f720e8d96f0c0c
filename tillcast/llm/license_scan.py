"""License notices by conditional compression, confirmed by wording.

Around words that speak of rights a text is cut into windows of each template's length, across lines and paragraphs.
A window is compressed alone and with the template as a raw zstandard dictionary: templates that save enough are
looked for in it, word by word or with few changes. Of notices that share words the one that saves most counts.
"""

from __future__ import annotations

import difflib
import re
from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillcast.llm.common import add_columns

# Wordings of common notices.
TEMPLATES = {
    "AGPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "AGPL-3.0-line": "This work is licensed under the GNU Affero General Public License, version 3.",
    "All-rights-reserved": "All rights reserved.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "BSD-line": "Released under the BSD License.",
    "CC-BY-4.0-line": "Licensed under CC BY 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-SA-4.0-line": "Licensed under CC BY-SA 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-2.0-line": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "LGPL-3.0-line": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MIT-line": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

#: A line that has none of these is no candidate.
CUE = re.compile(r"licen[sc]|copyright|rights\s+reserved|permission|redistribut|public\s+domain|waived|spdx|\bCC[ -]?(?:BY|0)", re.I)
WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")
PARAGRAPH = re.compile(r"\n\s*\n")

#: Least size reduction of a changed notice; share of a template's words that may differ in a changed notice.
LEAST_GAIN = 0.25
MOST_CHANGED = 0.25
#: Least size reduction of a window by a template that is then looked for in it; a window is up to ten times as long as a notice.
NOTICED = 0.02


def candidate_blocks(text: str) -> list[str]:
    """Lines with a cue, and paragraphs of several lines that hold one, in page order."""
    if not CUE.search(text):
        return []
    out = []
    for paragraph in PARAGRAPH.split(text):
        if CUE.search(paragraph):
            lines = [x for x in paragraph.split("\n") if x.strip()]
            out += [x.strip() for x in lines if CUE.search(x)]
            if len(lines) > 1:
                out.append(paragraph.strip())
    return list(dict.fromkeys(out))


class LicenseScanner:
    """Finds all notices of a text; equal windows are compared once a task."""

    REMEMBERED = 50_000

    def __init__(self, templates: dict[str, str] = TEMPLATES, level: int = 3):
        import zstandard as zstd

        self.alone = zstd.ZstdCompressor(level=level)
        self.names = list(templates)
        self.given = []
        for text in templates.values():
            # both sides as plain words, so that line ends, case and punctuation cost nothing
            prior = zstd.ZstdCompressionDict(self.plain(WORD.findall(text.lower())), dict_type=zstd.DICT_TYPE_RAWCONTENT)
            prior.precompute_compress(level=level)
            self.given.append(zstd.ZstdCompressor(level=level, dict_data=prior))
        self.words = [[w.lower() for w in WORD.findall(t)] for t in templates.values()]
        self.known: dict[tuple[int, str], tuple[int, int, int, int]] = {}

    @staticmethod
    def plain(words: list[str]) -> bytes:
        return " ".join(words).encode()

    def gain(self, words: list[str], template: int) -> float:
        """Size reduction of the words by the template."""
        data = self.plain(words)
        return 1 - len(self.given[template].compress(data)) / len(self.alone.compress(data))

    def windows(self, own: list[str], cues: list[int]) -> dict[int, list[tuple[int, int]]]:
        """By template, the windows around cues that it makes smaller.

        A notice holds a cue and is no longer than ``reach``; neighbouring windows overlap by more than that.
        """
        by_reach: dict[int, list[tuple[int, int, bytes, int]]] = {}
        out: dict[int, list[tuple[int, int]]] = {}
        for i, words in enumerate(self.words):
            reach = len(words) + int(MOST_CHANGED * len(words))
            if reach not in by_reach:
                cut = []
                for first, last in _stretches(cues, reach, len(own)):
                    for at in range(first, max(last - 2 * reach, first + 1), 2 * reach):
                        data = self.plain(own[at:min(at + 4 * reach, last)])
                        cut.append((at, min(at + 4 * reach, last), data, len(self.alone.compress(data))))
                by_reach[reach] = cut
            given = self.given[i]
            noticed = [(a, b) for a, b, data, alone in by_reach[reach] if len(given.compress(data)) <= (1 - NOTICED) * alone]
            if noticed:
                out[i] = noticed
        return out

    def differences(self, own: list[str], template: int) -> tuple[int, int, int, int]:
        """Words of the template that are missing, words between them in addition, and the stretch they take."""
        key = (template, " ".join(own))
        if key not in self.known:
            if len(self.known) >= self.REMEMBERED:
                self.known.clear()
            wanted = self.words[template]
            same = [m for m in difflib.SequenceMatcher(None, own, wanted, autojunk=False).get_matching_blocks() if m.size]
            first, last = (same[0].a, same[-1].a + same[-1].size) if same else (0, 0)
            kept = sum(m.size for m in same)
            self.known[key] = len(wanted) - kept, last - first - kept, first, last
        return self.known[key]

    def _exact(self, own: list[str], noticed: dict[int, list[tuple[int, int]]]) -> list[tuple[int, int, int]]:
        """(template, first word, the one past the last) wherever a template stands word by word in a window it makes smaller."""
        out = set()
        for i, windows in noticed.items():
            wanted = self.words[i]
            for a, b in windows:
                out.update((i, at, at + len(wanted)) for at in range(a, b - len(wanted) + 1) if own[at] == wanted[0] and own[at:at + len(wanted)] == wanted)
        return sorted(out)

    def scan(self, text: str) -> list[tuple[str, float, int, int, str, str]]:
        """License, gain, words missing, words added, exact or changed, and the stretch of text, in text order.

        Of notices that share words the one that saves most bytes counts, of those the one of nearest wording.
        """
        if not CUE.search(text):
            return []
        found = list(WORD.finditer(text))
        own = [m[0].lower() for m in found]
        begins = [m.start() for m in found]
        cues = sorted({max(bisect_right(begins, m.start()) - 1, 0) for m in CUE.finditer(text)})
        noticed = self.windows(own, cues)
        exact = self._exact(own, noticed)
        passed = {(i, first, last): (0.0, 0, 0) for i, first, last in exact}
        for i, windows in noticed.items():
            wanted = self.words[i]
            most = int(MOST_CHANGED * len(wanted))
            least, width = len(wanted) - most, len(wanted) + most
            if not most:
                continue
            known = set(wanted)
            covered = {p for j, first, last in exact if len(self.words[j]) >= len(wanted) for p in range(first, last)}
            at = sorted({p for a, b in windows for p in range(a, b) if own[p] in known and p not in covered})
            # a changed notice begins where this many words of the template stand within its greatest width
            for k in range(len(at) - least + 1):
                if at[k + least - 1] - at[k] < width:
                    missing, added, first, last = self.differences(own[at[k]:at[k] + width], i)
                    if 0 < missing + added <= most:
                        passed.setdefault((i, at[k] + first, at[k] + last), ((missing + added) / len(wanted), missing, added))
        ranked = []
        for (i, first, last), (wrong, missing, added) in passed.items():
            gain, block = self.gain(own[first:last], i), text[found[first].start():found[last - 1].end()]
            if not wrong or gain >= LEAST_GAIN and CUE.search(block):
                saved = gain * len(self.alone.compress(self.plain(own[first:last])))
                ranked.append((-round(saved), wrong, first - last, i, first, last, missing, added, gain, block))
        out, taken = [], set()
        for _, wrong, _, i, first, last, missing, added, gain, block in sorted(ranked):
            if taken.isdisjoint(range(first, last)):
                taken.update(range(first, last))
                out.append((first, (self.names[i].removesuffix("-line"), gain, missing, added, "changed" if wrong else "exact", block)))
        return [x for _, x in sorted(out)]


def _stretches(cues: list[int], reach: int, n: int) -> list[tuple[int, int]]:
    """Words within ``reach`` of a cue, as stretches that do not touch."""
    out: list[tuple[int, int]] = []
    for c in cues:
        first, last = max(c - reach, 0), min(c + reach + 1, n)
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], last)
        else:
            out.append((first, last))
    return out


def scan_licenses(docs: DataFrame, column: str = "text") -> DataFrame:
    """``docs`` with licenses (sorted, each once), n_blocks (candidates) and notices.

    ``notices`` has license, gain, words missing, words added, wording (exact or changed) and the stretch of text. A
    null or empty text has no block. New columns replace clashing ones.
    """
    fields = [
        T.StructField("licenses", T.ArrayType(T.StringType())), T.StructField("n_blocks", T.LongType()),
        T.StructField("notices", T.ArrayType(T.StructType([
            T.StructField("license", T.StringType()), T.StructField("gain", T.DoubleType()), T.StructField("missing", T.IntegerType()),
            T.StructField("added", T.IntegerType()), T.StructField("wording", T.StringType()), T.StructField("block", T.StringType()),
        ]))),
    ]
    names = [f.name for f in fields[2].dataType.elementType.fields]

    def make():
        scanner = LicenseScanner()

        def run(texts):
            licenses, counts, notices = [], [], []
            for text in texts:
                found = scanner.scan(text) if text else []
                licenses.append(sorted({x[0] for x in found}))
                counts.append(len(candidate_blocks(text)) if text else 0)
                notices.append([dict(zip(names, x)) for x in found])
            return licenses, counts, notices

        return run

    return add_columns(docs, column, make, fields)
