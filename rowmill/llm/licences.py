"""Licence notices and texts in documents by the Dice coefficient over word bigrams."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

from rowmill.llm.common import utf8

#: Least Dice coefficient of a match.
LEAST_DICE = 0.8

# Notices and texts that licences prescribe or that are customary for them.
TEMPLATES: dict[str, str] = {
    "All-Rights-Reserved": "All rights reserved.",
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0-notice": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0-notice": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0-notice": "Licensed under CC BY-NC-ND 4.0.",
    "CC0-1.0-notice": "Dedicated to the public domain under CC0 1.0.",
    "MPL-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."
    ),
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details."
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS '
        "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
        "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
        "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: 1. Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in "
        "binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE "
        'IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE "
        "FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT "
        "NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
        "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
        "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
        "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
        "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
        'copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS '
        "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
        "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
        "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE "
        "OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE."
    ),
    "GPL-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the "
        "License, or (at your option) any later version. This program is distributed in the hope that it will "
        "be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS "
        "FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "LGPL-2.1-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of "
        "the License, or (at your option) any later version. This library is distributed in the hope that it "
        "will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
        "FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."
    ),
    "LGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version. This program is distributed in the hope that it will "
        "be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS "
        "FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."
    ),
    "AGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Affero General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version. This program is distributed in the hope that it will "
        "be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS "
        "FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: 1. Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in "
        "binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither "
        "the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission. THIS SOFTWARE IS "
        'PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE "
        "FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT "
        "NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
        "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
        "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
        "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "0BSD": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
        'is hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH '
        "REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT "
        "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
        "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
        "THIS SOFTWARE."
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the "
        "authors be held liable for any damages arising from the use of this software. Permission is granted "
        "to anyone to use this software for any purpose, including commercial applications, and to alter it "
        "and redistribute it freely, subject to the following restrictions: 1. The origin of this software "
        "must not be misrepresented; you must not claim that you wrote the original software. If you use this "
        "software in a product, an acknowledgment in the product documentation would be appreciated but is "
        "not required. 2. Altered source versions must be plainly marked as such, and must not be "
        "misrepresented as being the original software. 3. This notice may not be removed or altered from any "
        "source distribution."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
        "modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
        "compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions "
        "that recognize copyright laws, the author or authors of this software dedicate any and all copyright "
        "interest in the software to the public domain. We make this dedication for the benefit of the public "
        "at large and to the detriment of our heirs and successors. We intend this dedication to be an overt "
        "act of relinquishment in perpetuity of all present and future rights to this software under "
        'copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, '
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
        "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
}

# letters and digits are kept and lower-cased, other ASCII characters separate words
_SEPARATE = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256)).lower()
_COPYRIGHT = re.compile(rb"(?im)^\s*(?:copyright|\(c\)|\xc2\xa9).*$")


def bigrams_of(text: bytes, drop_copyright: bool = False) -> np.ndarray:
    """Hashes of the word bigrams of a normalised text, in order."""
    if drop_copyright:
        text = _COPYRIGHT.sub(b" ", text)
    hashes = [zlib.crc32(word) for word in text.translate(_SEPARATE).split()]
    words = np.array(hashes, dtype=np.uint64)
    return words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:] * np.uint64(0xC2B2AE3D27D4EB4F)


class Templates:
    """Licence texts as sets of bigrams, smallest first."""

    def __init__(self, texts: dict[str, str], least: float):
        self.least = least
        sets = {name: frozenset(bigrams_of(text.encode(), True).tolist()) for name, text in texts.items()}
        self.sets = dict(sorted(((n, s) for n, s in sets.items() if s), key=lambda x: (len(x[1]), x[0])))
        self.known = np.array(sorted(set().union(*self.sets.values())), dtype=np.uint64)

    def matches(self, text: bytes | None) -> list[tuple[str, float, int, int]]:
        """``(licence, dice, first word, words)`` of the passages that match, the better of overlapping ones."""
        grams = bigrams_of(text or b"")
        where = np.flatnonzero(np.isin(grams, self.known)) if len(grams) else np.zeros(0, dtype=np.int64)
        if not len(where):
            return []
        found = grams[where].tolist()
        present = set(found)
        places = where.tolist()
        every = grams.tolist()
        candidates = []
        for name, template in self.sets.items():
            # Dice of at least d needs d / (2 - d) of the template, and a passage of at most (2 - d) / d its size
            least, most = self.least / (2 - self.least) * len(template), (2 - self.least) / self.least * len(template)
            if len(template & present) < least:
                continue
            own = [p for p, g in zip(places, found) if g in template]
            passages = sorted(self._passages(every, own, template, least, most), key=lambda p: (-p[0], p[1], p[2]))
            candidates += [(*p, len(template), name) for p in _apart(passages)]
        candidates.sort(key=lambda c: (-c[0], -c[3], c[1], c[4]))
        out = [(name, dice, start, end - start + 1) for dice, start, end, _, name in _apart(candidates)]
        return sorted(out, key=lambda m: (m[2], m[0]))

    def _passages(
        self, grams: list[int], own: list[int], template: frozenset, least: float, most: float
    ) -> Iterator[tuple[float, int, int]]:
        """``(dice, start, end)`` of the runs of bigrams ``[start, end)`` that match; they start and end with one of the template.

        Of runs with the same start and the same Dice coefficient only the shortest is given: it lies in the others.
        """
        for k, start in enumerate(own):
            seen: set[int] = set()
            common, at = 0, start
            given: set[float] = set()
            for end in own[k:]:
                if end + 1 - start > most:
                    break
                fresh = set(grams[at : end + 1]) - seen
                seen |= fresh
                common += len(fresh & template)
                at = end + 1
                if common >= least:
                    dice = 2 * common / (len(seen) + len(template))
                    if dice >= self.least and dice not in given:
                        given.add(dice)
                        yield dice, start, end + 1


def _apart(passages: list[tuple]) -> Iterator[tuple]:
    """The passages ``(dice, start, end, ..)`` that overlap none of the given ones before them."""
    taken: list[tuple[int, int]] = []  # sorted
    for passage in passages:
        start, end = passage[1:3]
        at = bisect_left(taken, (end, end))
        if not at or taken[at - 1][1] <= start:
            taken.insert(at, (start, end))
            yield passage


def licences_in(text: Column, templates: dict[str, str] | None = None, least: float = LEAST_DICE) -> Column:
    """Licences in a text: an array of ``(licence, dice, first_word, n_words)``, in text order.

    Text and templates are lower-cased and cut into words at all but letters and digits; copyright lines of templates
    are left out. A passage matches a licence when the Dice coefficient of their sets of word bigrams is at least
    ``least``. All matching passages of all licences are looked for; of passages that overlap, the better one stays (then
    the longer template, the earlier passage, the name), so every notice of a text is given, repeated ones too. A template that shares
    too few bigrams with the text for any passage to match is never compared, nor is a passage with more bigrams (repeats included)
    than a match can have. Null and empty texts have none; an array is never null. Templates of fewer than two words never match.
    """
    known = Templates(TEMPLATES if templates is None else templates, least)
    fields = ("licence", "dice", "first_word", "n_words")
    kind = pa.list_(pa.struct(list(zip(fields, (pa.string(), pa.float64(), pa.int32(), pa.int32())))))

    @F.arrow_udf("array<struct<licence:string,dice:double,first_word:int,n_words:int>>")
    def scan(texts: pa.Array) -> pa.Array:
        return pa.array([[dict(zip(fields, m)) for m in known.matches(t.as_py())] for t in texts], kind)

    return scan(utf8(text))
