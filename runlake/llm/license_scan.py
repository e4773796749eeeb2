"""License scans by conditional compression.

The words within reach of one that speaks of licensing make a block, however its lines are broken. Each template
is fitted to the block's words, wherever it differs least; stretches that fit are compressed once alone and once with
the template as a raw dictionary. Fits are ranked by the bytes that this saves, less what the words that differ
would take; a fit is confirmed by its exact wording: few words differ, none of those that tell licenses apart, and
never many in a row, for a clause that is added or missing makes another license. Of fits that
overlap, the first in rank tells what is stated there.
"""

from __future__ import annotations

import difflib
import functools
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import smaller_batches, text_or_empty

# Parts of public license notices.
_GRANT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without '
    "restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
    'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR '
    "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
    "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_MIT_0 = _GRANT.replace(", subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.", ".")
_MAY_USE = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_RETAIN = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
    "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_ADVERTISING = "All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the organization."
_NO_NAMES = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_NO_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY '
    "AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
    "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY "
    "OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_APACHE = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'
_APACHE_REST = (
    'You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" '
    "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."
)


def _gnu(kind: str, version: str) -> tuple[str, ...]:
    """The notices of one license of the GNU family: by name, and the header for a program or a library."""
    lesser = "General" != kind.split()[0] and "Affero" not in kind
    what = "library" if lesser else "program"
    return (
        f"This work is licensed under the GNU {kind}, version {version}.",
        f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.",
        f"This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU {kind} as published by the Free Software Foundation; version {version} of the License.",
    )


def _commons(terms: str, names: str, version: str) -> tuple[str, ...]:
    return f"Licensed under CC {terms} {version}.", f"This work is licensed under a Creative Commons {names} {version} International License."


#: Wordings of notices, by SPDX identifier, a list for each license.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "0BSD": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES "
        "WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    ),
    "AGPL-3.0": _gnu("Affero General Public License", "3"),
    "Apache-1.1": ("Licensed under the Apache Software License, Version 1.1.",),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", _APACHE, f"{_APACHE} {_APACHE_REST}"),
    "Artistic-2.0": ("This is free software, licensed under the Artistic License 2.0.",),
    "BSD-2-Clause": ("Released under the BSD 2-Clause License.", _MAY_USE, f"{_MAY_USE} {_RETAIN} {_NO_WARRANTY}"),
    "BSD-3-Clause": ("Released under the BSD 3-Clause License.", _NO_NAMES, f"{_MAY_USE} {_RETAIN} {_NO_NAMES} {_NO_WARRANTY}"),
    "BSD-4-Clause": ("Released under the BSD 4-Clause License.", f"{_MAY_USE} {_RETAIN} {_ADVERTISING} {_NO_NAMES} {_NO_WARRANTY}"),
    "BSL-1.0": ("Distributed under the Boost Software License, Version 1.0.",),
    "CC-BY-4.0": _commons("BY", "Attribution", "4.0"),
    "CC-BY-NC-4.0": _commons("BY-NC", "Attribution-NonCommercial", "4.0"),
    "CC-BY-NC-ND-4.0": _commons("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives", "4.0"),
    "CC-BY-NC-SA-4.0": _commons("BY-NC-SA", "Attribution-NonCommercial-ShareAlike", "4.0"),
    "CC-BY-ND-4.0": _commons("BY-ND", "Attribution-NoDerivatives", "4.0"),
    "CC-BY-SA-4.0": _commons("BY-SA", "Attribution-ShareAlike", "4.0"),
    "CC0-1.0": ("Dedicated to the public domain under CC0 1.0.",),
    "EPL-2.0": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",),
    "GFDL-1.3": (
        "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3 or any later version published by the Free Software Foundation.",
    ),
    "GPL-2.0": _gnu("General Public License", "2"),
    "GPL-3.0": _gnu("General Public License", "3"),
    "ISC": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "LGPL-2.0": _gnu("Library General Public License", "2"),
    "LGPL-2.1": _gnu("Lesser General Public License", "2.1"),
    "LGPL-3.0": _gnu("Lesser General Public License", "3"),
    "MIT": ("Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.", _GRANT),
    "MIT-0": ("Released under the MIT-0 License.", _MIT_0),
    "MPL-1.1": ("The contents of this file are subject to the Mozilla Public License Version 1.1; you may not use this file except in compliance with the License.",),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "Zlib": ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",),
}

# How one states a license by its identifier, and titles that stand over a copyright line.
STATED = ("SPDX-License-Identifier: {}", "License: {}")
GNU_ENDINGS = ("", "-only", "-or-later")
TITLES = {"MIT": "MIT License Copyright (c)", "ISC": "ISC License Copyright (c)", "BSD-2-Clause": "BSD 2-Clause License Copyright (c)", "BSD-3-Clause": "BSD 3-Clause License Copyright (c)", "Apache-2.0": "Apache License Version 2.0, January 2004"}

#: Words that a block must hold one of to be a candidate, in lower case.
SIGNS = ("licen", "copyright", "public domain", "permission is hereby", "permission to use", "redistribution and use", "software is provided")
#: Words that tell licenses of like wording apart: a notice has those of its template and no others. So it is with words that hold digits.
TELLING = ("affero", "lesser", "noncommercial", "sharealike", "noderivatives", "noderivs")
#: Words that may differ, out of a hundred of the template's, and the bytes that each of them counts for in the rank.
MAY_DIFFER, WORD_BYTES = 34, 6
#: Words in a row, added or missing, that make a clause: a fit with so many is another license's.
CLAUSE = 9
#: Words between a title and its license's notice at most, such as those of a copyright line.
TITLE_WORDS = 25

#: A sign's own words may stand on two lines, with comment marks between them.
_SIGN = re.compile("|".join(x.replace(" ", r"\W+") for x in SIGNS), re.IGNORECASE | re.ASCII)
_WORD = re.compile(r"\w+(?:[-.]\w+)*")
_BREAK = re.compile(r"\s*\n[^\w\n]*")
_IS = re.compile("[:=]")
_STOP = re.compile(r"[^\w\s]*")

#: Each template as (license, text, words as numbers, numbers of the words it must hold, words that may differ).
_NUMBER: dict[str, int] = {w: i for i, w in enumerate(TELLING, 1)}
_TELL = set(_NUMBER.values())
_FITTED: list[tuple[str, str, list[int], set[int], int]] = []
_IDENTIFIERS = {n: [n + e for e in (GNU_ENDINGS if "GPL" in n else ("",))] for n in TEMPLATES}
_STATEMENTS = {n: [how.format(i) for how in STATED for i in own] for n, own in _IDENTIFIERS.items()}
#: Templates that are statements: a colon or an equals sign stands between their two words.
_STATING: set[int] = set()
_TITLING: set[int] = set()
for _name, _texts in TEMPLATES.items():
    for _text in (*_texts, *((TITLES[_name],) if _name in TITLES else ()), *_STATEMENTS[_name]):
        if _text in _STATEMENTS[_name]:
            _STATING.add(len(_FITTED))
        if _text == TITLES.get(_name):
            _TITLING.add(len(_FITTED))
        _words = [(w, _NUMBER.setdefault(w, len(_NUMBER) + 1)) for w in _WORD.findall(_text.lower())]
        _FITTED.append((_name, _text, [n for _, n in _words], {n for w, n in _words if n in _TELL or any(ch.isdigit() for ch in w)}, MAY_DIFFER * len(_words) // 100))
_HOLDS = np.zeros((len(_FITTED), len(_NUMBER) + 1), dtype=np.int32)
for _i, _fitted in enumerate(_FITTED):
    _HOLDS[_i, _fitted[2]] = 1
#: Templates by their length, so that those of a group take about the same time: (numbers of the templates, words by template and place).
_GROUPS: list[tuple[np.ndarray, np.ndarray]] = []
for _least, _most in ((0, 8), (8, 50), (50, 1 << 30)):
    _own = [i for i, x in enumerate(_FITTED) if _least <= len(x[2]) < _most]
    _want = np.full((len(_own), max(len(_FITTED[i][2]) for i in _own)), -1, dtype=np.int64)
    for _row, _i in enumerate(_own):
        _want[_row, : len(_FITTED[_i][2])] = _FITTED[_i][2]
    _GROUPS.append((np.array(_own), _want))
#: Words of the longest fit, which is how far a block reaches round a sign; words that are looked at at once.
REACH, AT_ONCE = max(len(x[2]) + x[4] for x in _FITTED), 1 << 14


@functools.lru_cache(maxsize=1)
def _compressors() -> tuple[zstandard.ZstdCompressor, list[zstandard.ZstdCompressor]]:
    options = zstandard.ZstdCompressionParameters.from_level(9, write_content_size=False, write_checksum=False, write_dict_id=False)
    own = [zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(x[1].encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=options) for x in _FITTED]
    return zstandard.ZstdCompressor(compression_params=options), own


@functools.lru_cache(maxsize=20_000)
def saved(notice: str, template: int) -> int:
    """The bytes that a template as dictionary saves of a notice."""
    plain, own = _compressors()
    data = notice.encode()
    return len(plain.compress(data)) - len(own[template].compress(data))


def words_of(text: str) -> tuple[array, array, array]:
    """Where each word starts and ends, and its number among the templates' words (0: in none)."""
    starts, ends, numbers = array("q"), array("q"), array("i")
    for m in _WORD.finditer(text):
        starts.append(m.start())
        ends.append(m.end())
        numbers.append(_NUMBER.get(m[0].lower(), 0))
    return starts, ends, numbers


def blocks(text: str, starts: array, ends: array) -> list[tuple[int, int]]:
    """From and to which word the candidates go: all words within reach of a sign, touching ones as one."""
    first, last, out = np.frombuffer(starts, dtype=np.int64), np.frombuffer(ends, dtype=np.int64), []
    for m in _SIGN.finditer(text):
        low = max(0, int(np.searchsorted(last, m.start(), "right")) - REACH)
        high = min(len(first), int(np.searchsorted(first, m.end())) + REACH)
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], high)
        else:
            out.append((low, high))
    return out


def least_different(have: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """For each end in ``have`` and each row of ``wanted`` (filled up with -1) the stretch that differs from it in fewest words.

    Words differ that one side has and the other lacks. Of stretches with one end the least different is taken,
    then the shortest. A cell holds differences times ``len(have) + 1`` less the start. All templates and all of their places
    are computed at once for one word after another.
    """
    big, (rows, wide) = len(have) + 1, wanted.shape
    sizes = (wanted >= 0).sum(1)
    steps = np.arange(wide + 1, dtype=np.int64) * big
    column = np.broadcast_to(steps, (rows, wide + 1)).copy()
    out, every = np.empty((len(have), rows), dtype=np.int64), np.arange(rows)
    beyond = np.int64(1) << 62
    for j, word in enumerate(have.tolist(), 1):
        here = column + big
        here[:, 0] = -j
        np.minimum(here[:, 1:], np.where(wanted == word, column[:, :-1], beyond), out=here[:, 1:])
        here -= steps  # a word of the template that is lacking costs one, wherever the stretch stood before
        np.minimum.accumulate(here, axis=1, out=here)
        here += steps
        column = here
        out[j - 1] = column[every, sizes]
    return out


def fits(have: list[int], want: list[int], most: int) -> list[tuple[int, int, int]]:
    """(words that differ, from, to) for each end of a stretch of ``have`` that differs from ``want`` in at most ``most`` words."""
    big = len(have) + 1
    cells = least_different(np.array(have, dtype=np.int64), np.array([want], dtype=np.int64))[:, 0].tolist()
    return [(-(-c // big), -(-c // big) * big - c, j) for j, c in enumerate(cells, 1) if -(-c // big) <= most]


def confirmed(named: set[int], have: list[int]) -> bool:
    """Whether a stretch has the words that tell its template from others, and none that tell others from it."""
    held = set(have)
    return named <= held and not (held & _TELL) - named


def same_clauses(have: list[int], want: list[int]) -> bool:
    """Whether no CLAUSE words in a row are added or missing in ``have``."""
    matched = difflib.SequenceMatcher(None, want, have, autojunk=False).get_opcodes()
    return all(max(b - a, d - c) < CLAUSE for kind, a, b, c, d in matched if kind != "equal")


@functools.lru_cache(maxsize=20_000)
def found_in(numbers: bytes) -> list[tuple[int, int, int, int]]:
    """(differences, template, from, to) for each fit of each template to some words in order."""
    ids = np.frombuffer(numbers, dtype=np.int32)
    sums = np.concatenate([np.zeros((len(_FITTED), 1), dtype=np.int32), np.cumsum(_HOLDS[:, ids], axis=1, dtype=np.int32)], axis=1)
    out = []
    for own, wanted in _GROUPS:
        near = np.zeros(len(ids) + 1, dtype=np.int64)  # where stretches of words that are looked at begin and end
        for k in own.tolist():
            _, _, want, _, most = _FITTED[k]
            ends = np.minimum(np.arange(len(ids)) + len(want) + most, len(ids))
            enough = np.flatnonzero(sums[k, ends] - sums[k, :-1] >= len(want) - most)  # a fit has so many of the template's words
            np.add.at(near, enough, 1)
            np.add.at(near, ends[enough], -1)
        looked = np.flatnonzero(np.diff(np.concatenate([[False], np.cumsum(near)[:-1] > 0, [False]]).astype(np.int8)))
        for low, high in looked.reshape(-1, 2).tolist():
            have = ids[low:high]
            cells, big = least_different(have, wanted), high - low + 1
            differ = -(-cells // big)
            for j, row in np.argwhere(differ <= np.array([_FITTED[k][4] for k in own])).tolist():
                k, d = int(own[row]), int(differ[j, row])
                s, e = d * big - int(cells[j, row]), j + 1
                if confirmed(_FITTED[k][3], have[s:e].tolist()):
                    out.append((d, k, low + s, low + e))
    return out


def notices(text: str) -> tuple[int, list[tuple[int, int, str, int, int]]]:
    """The number of blocks, and (start, end, license, bytes saved, words that differ) of each notice by start.

    A notice ends with the stops that follow its last word. A title over a notice of its license is no notice by itself.
    """
    if not _SIGN.search(text):
        return 0, []
    starts, ends, numbers = words_of(text)
    at, fitted = blocks(text, starts, ends), set()
    for low, high in at:
        for s in range(low, max(low + 1, high - REACH), AT_ONCE):  # any fit lies in one piece: they overlap by its length
            fitted |= {(d, k, s + a, s + e) for d, k, a, e in found_in(numbers[s : min(high, s + AT_ONCE + REACH)].tobytes())}
    ranked = []
    for differ, k, a, e in fitted:
        if k in _STATING and not _IS.search(text, ends[a], starts[e - 1]):
            continue
        start, end = starts[a], _STOP.match(text, ends[e - 1]).end()
        bytes_saved = saved(_BREAK.sub(" ", text[start:end]), k)
        if bytes_saved > 0:
            ranked.append((WORD_BYTES * differ - bytes_saved, differ, _FITTED[k][0], a, e, start, end, bytes_saved, k))
    taken, used = [], bytearray(len(starts))
    refused: dict[str, bytearray] = {}  # words of fits that lack a clause or have one more, where shorter wordings of that license tell nothing
    for _, differ, name, a, e, start, end, bytes_saved, k in sorted(ranked):
        if any(used[a:e]) or (name in refused and any(refused[name][a:e])):
            continue
        if differ >= CLAUSE and not same_clauses(list(numbers[a:e]), _FITTED[k][2]):
            refused.setdefault(name, bytearray(len(starts)))[a:e] = b"\1" * (e - a)
            continue
        used[a:e] = b"\1" * (e - a)
        taken.append((a, e, k, start, end, name, bytes_saved, differ))
    taken.sort()
    led = [k in _TITLING and name == after[5] and after[0] - e <= TITLE_WORDS for (_, e, k, _, _, name, *_), after in zip(taken, taken[1:])]
    return len(at), [found[3:] for found, part in zip(taken, [*led, False]) if not part]


def licence(block: str) -> tuple[str, int, int] | None:
    """The license that a text states in the words nearest its template, the bytes saved, and the words that differ."""
    return min(((name, saves, differ) for _, _, name, saves, differ in notices(block)[1]), key=lambda x: (x[2], -x[1], x[0]), default=None)


def find_licenses(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_blocks (candidates), n_found (notices), licenses, spans, saved_bytes.

    ``licenses`` are the different identifiers in order, comma-joined; ``spans`` are identifier:start:end of each
    notice in code points, ends exclusive. A notice may run over lines of any length. Whole texts are searched; a
    null text counts as an empty one. Repeated rows each give a row, a null doc_id stays null, other columns are
    ignored, an empty table gives an empty one.
    """
    schema = "doc_id long, n_blocks long, n_found long, licenses string, spans string, saved_bytes long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in smaller_batches(whole, "text", 8 << 20):
                rows = []
                for text in batch["text"].to_pylist():
                    n, found = notices(text)
                    rows.append((n, len(found), ",".join(sorted({f[2] for f in found})), ",".join(f"{f[2]}:{f[0]}:{f[1]}" for f in found), sum(f[3] for f in found)))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))], names=[c.split()[0] for c in schema.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, schema)
