"""Licence texts by templates with optional and replaceable regions.

A template is compiled to an automaton over words: mandatory words must stand exactly
as written, an optional region may be left out as a whole, a replaceable region takes
any words up to its limit. A text matches where the automaton accepts, so every
mandatory word is there and nothing else stands between. Short phrases are templates
too; they are the base labels.
"""

from __future__ import annotations

import functools
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
MARK = re.compile(r"\[\[|\]\]|\{\{\d+\}\}|[^\[\]{}]+")

# Phrases and published licence wording. [[...]] is optional, {{n}}
# stands for up to n replaced words; no template ends in replaced words.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

WARRANTY = """
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE {{8}} BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""
DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY {{12}} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL {{12}} BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN
ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
CONDITIONS = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: [[1.]] Redistributions of source code must retain the above
copyright notice, this list of conditions and the following disclaimer. [[2.]] Redistributions in binary
form must reproduce the above copyright notice, this list of conditions and the following disclaimer in
the documentation and/or other materials provided with the distribution.
"""
VERSION = "[[, version [[1]][[2]][[2.1]][[3]][[.0]]]] [[only]] [[or later]] [[or (at your option) any later version]]"


def _gnu_header(name: str) -> str:
    """The notice at the head of a file; what follows the grant may be left out."""
    return f"""
        free software[[:]] you can redistribute it and/or modify it under the terms of the GNU {name} as
        published by the Free Software Foundation[[,]] either version {{{{2}}}} of the License, or (at your
        option) any later version. [[{{{{4}}}} is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
        See the GNU {name} for more details. [[You should have received a copy of the GNU {name} along with
        {{{{4}}}} If not, see [[http:]][[https:]]//www.gnu.org/licenses]]]]
    """


TEMPLATES = {
    "mit-text": """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction,
        including without limitation the rights to use, copy, modify, merge, publish, distribute,
        sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
        furnished to do so, subject to the following conditions: The above copyright notice and this
        permission notice [[(including the next paragraph)]] shall be included in all copies or
        substantial portions of the Software.
    """ + WARRANTY,
    "bsd-2-clause": CONDITIONS + DISCLAIMER,
    "bsd-3-clause": CONDITIONS + """
        [[3.]] Neither the name of {{10}} nor the names of its contributors may be used to endorse or
        promote products derived from this software without specific prior written permission.
    """ + DISCLAIMER,
    "isc": """
        Permission to use, copy, modify, and[[/or]] distribute this software for any purpose with or
        without fee is hereby granted, provided that the above copyright notice and this permission
        notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND {{6}} DISCLAIMS ALL WARRANTIES
        WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO
        EVENT SHALL {{6}} BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
        DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
        NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
        THIS SOFTWARE.
    """,
    "apache-2-header": """
        Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
        in compliance with the License. You may obtain a copy of the License at {{12}} Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on
        an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
        See the License for the specific language governing permissions and limitations under the License.
    """,
    "zlib": """
        This software is provided 'as-is', without any express or implied warranty. In no event will the
        authors be held liable for any damages arising from the use of this software. Permission is granted
        to anyone to use this software for any purpose, including commercial applications, and to alter it
        and redistribute it freely, subject to the following restrictions: [[1.]] The origin of this
        software must not be misrepresented; you must not claim that you wrote the original software. If you
        use this software in a product, an acknowledgment in the product documentation would be appreciated
        but is not required. [[2.]] Altered source versions must be plainly marked as such, and must not be
        misrepresented as being the original software. [[3.]] This notice may not be removed or altered from
        any source distribution.
    """,
    "unlicense": """
        This is free and unencumbered software released into the public domain. Anyone is free to copy,
        modify, publish, use, compile, sell, or distribute this software, either in source code form or as a
        compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions
        that recognize copyright laws, the author or authors of this software dedicate any and all copyright
        interest in the software to the public domain. We make this dedication for the benefit of the public
        at large and to the detriment of our heirs and successors. We intend this dedication to be an overt
        act of relinquishment in perpetuity of all present and future rights to this software under copyright
        law.
    """ + WARRANTY + "[[For more information, please refer to [[http:]][[https:]]//unlicense.org]]",
    "bsl-1.0": """
        Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the
        software and accompanying documentation covered by this license (the "Software") to use, reproduce,
        display, distribute, execute, and transmit the Software, and to prepare derivative works of the
        Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the
        following: The copyright notices in the Software and this entire statement, including the above
        license grant, this restriction and the following disclaimer, must be included in all copies of the
        Software, in whole or in part, and all derivative works of the Software, unless such copies or
        derivative works are solely in the form of machine-executable object code generated by a source
        language processor. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
        IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
        PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING
        THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
    """,
    "mpl-2.0-header": """
        This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
        MPL was not distributed with this file, You can obtain one at [[http:]][[https:]]//mozilla.org/MPL/2.0
    """,
    "gpl-notice": "[[This work is]] licensed under the GNU General Public License" + VERSION,
    "lgpl-notice": "[[This work is]] licensed under the GNU Lesser General Public License" + VERSION,
    "agpl-notice": "[[This work is]] licensed under the GNU Affero General Public License" + VERSION,
    "gpl-header": _gnu_header("General Public License"),
    "lgpl-header": _gnu_header("Lesser General Public License"),
    "agpl-header": _gnu_header("Affero General Public License"),
    "cc-notice": """
        [[This work is]] licensed under a Creative Commons Attribution[[-NonCommercial]][[-ShareAlike]]
        [[-NoDerivatives]] [[{{2}}]] International License
    """,
    "cc-by-nc-notice": """
        licensed under CC BY-NC[[-SA]][[-ND]] [[1.0]][[2.0]][[2.5]][[3.0]][[4.0]] [[International]]
    """,
}


def words_of(text: str | None) -> list[str]:
    """Words of a text, A to Z lower-cased; null and empty texts have none."""
    if not text:
        return []
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    return WORD.findall(lowered)


class Automaton:
    """Words accepted by a template. States are numbers; the last one accepts.

    ``step[s]`` is the word that leads from s to s + 1 (None for any word), ``skip[s]``
    the states reachable from s without a word.
    """

    def __init__(self, markup: str):
        self.step: list[str | None] = []
        self.skip: dict[int, list[int]] = {}
        begun: list[int] = []
        needed: set[str] = set()
        for token in MARK.findall(markup):
            at = len(self.step)
            if token == "[[":
                begun.append(at)
            elif token == "]]":
                self.skip.setdefault(begun.pop(), []).append(at)
            elif token.startswith("{{"):
                limit = int(token[2:-2])
                self.step += [None] * limit
                for k in range(limit):
                    self.skip.setdefault(at + k, []).append(at + limit)
            else:
                words = words_of(token)
                self.step += words
                if not begun:
                    needed.update(words)
        self.accepting = len(self.step)
        self.needed = frozenset(needed)
        self.first = frozenset(self.step[s] for s in self.closed({0}) if s < self.accepting)
        self.size = sum(word is not None for word in self.step)

    def closed(self, states: set[int]) -> set[int]:
        todo, out = list(states), set()
        while todo:
            state = todo.pop()
            if state not in out:
                out.add(state)
                todo += self.skip.get(state, ())
        return out

    def match(self, words: list[str], start: int) -> int | None:
        """End of the longest accepted run of words from ``start`` on, or None."""
        states, at, end = self.closed({0}), start, None
        while True:
            if self.accepting in states:
                end = at
            if at == len(words):
                return end
            word = words[at]
            reached = {s + 1 for s in states if s < self.accepting and self.step[s] in (None, word)}
            if not reached:
                return end
            states = self.closed(reached)
            at += 1


@functools.cache
def _compiled() -> tuple[list[tuple[str, Automaton]], list[tuple[str, Automaton]]]:
    return (
        [(label, Automaton(phrase)) for phrase, label in PHRASES.items()],
        [(label, Automaton(markup)) for label, markup in TEMPLATES.items()],
    )


def _matches(automata, words, vocabulary):
    for label, automaton in automata:
        if not automaton.needed <= vocabulary:
            continue
        at = 0
        while at < len(words):
            if words[at] in automaton.first or None in automaton.first:
                end = automaton.match(words, at)
                if end is not None:
                    yield label, automaton, at, end
                    if automaton.size > 8:  # a whole licence text, places of phrases may overlap
                        at = end - 1
            at += 1


def scan(text: str | None) -> dict:
    """Places of the base phrases, labels of all templates and a score.

    The score is the share of the text's words within matches, 0 without any.
    """
    words = words_of(text)
    vocabulary = frozenset(words)
    phrases, templates = _compiled()
    base = list(_matches(phrases, words, vocabulary))
    texts = list(_matches(templates, words, vocabulary))
    starts = [start for _, _, start, _ in base]
    covered, reach = 0, 0
    for _, _, start, end in sorted(base + texts, key=lambda m: (m[2], m[3])):
        covered += max(0, end - max(start, reach))
        reach = max(reach, end)
    return {
        "n_words": len(words),
        "n_base": len(base),
        "first_word": min(starts, default=None),
        "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted({m[0] for m in base})),
        "labels": ",".join(sorted({m[0] for m in base + texts})),
        "score": covered / len(words) if words else 0.0,
    }


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double"
)
TYPES = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}


def _scanned(batches):
    fields = [x.split() for x in SCHEMA.split(", ")]
    for batch in batches:
        found = [scan(text.as_py()) for text in batch.column("text")]
        arrays = [pa.array([x[name] for x in found], TYPES[kind]) for name, kind in fields[1:]]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=[f[0] for f in fields])


def label(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row: base places and labels, labels of all templates, score.

    Null and empty texts have no words, no labels and score 0. Repeated rows and null
    ids are kept as they are, other columns are not read. Works row by row.
    """
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    ).mapInArrow(_scanned, SCHEMA)
