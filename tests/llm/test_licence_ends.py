"""Licence texts count only with their whole mandatory wording."""

from __future__ import annotations

import random
import re

import pytest

from keelstone.llm import licenses

ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without
fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE,
DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN
CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
APACHE = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License."""


@pytest.mark.parametrize(
    ("label", "text", "altered"),
    [
        ("isc", ISC, [ISC[: ISC.index(" IN NO EVENT")], ISC.replace("NEGLIGENCE", "FAULT"), ISC.replace("IMPLIED ", "")]),
        ("apache-2-header", APACHE, [APACHE[: APACHE.index("# See")], APACHE.replace("limitations", "limits")]),
    ],
)
def test_whole_wording(label, text, altered):
    found = licenses.scan(text)
    assert label in found["labels"].split(",") and found["score"] == 1
    for other in altered:
        assert label not in licenses.scan(other)["labels"].split(",")


GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0}
as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU {0} for more details.

You should have received a copy of the GNU {0} along with this program.  If not, see <https://www.gnu.org/licenses/>."""


@pytest.mark.parametrize(
    ("text", "labels", "covered"),
    [
        (GNU.format("General Public License"), "gpl-header", -3),
        (GNU.format("Lesser General Public License"), "lgpl-header", -3),
        (GNU.format("Affero General Public License"), "agpl-header", -3),
        (GNU.format("General Private License"), "", None),
        ("licensed under CC BY-NC banana apple pear plum", "cc-by-nc,cc-by-nc-notice", -4),
        ("Licensed under CC BY-NC-SA 4.0.", "cc-by-nc,cc-by-nc-notice", 0),
        ("licensed under the GNU General Public License, version banana", "gpl-notice", -1),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl-notice", 0),
        ("licensed under the GNU Lesser General Public License, version 2.1 or later", "lgpl-notice", 0),
        ("licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "cc-notice", 0),
        ("licensed under a Creative Commons Attribution of any other kind International License", "", None),
    ],
)
def test_notices(text, labels, covered):
    """The notice and nothing behind it counts; ``covered`` is what stands outside, in words."""
    found = licenses.scan(text)
    assert found["labels"] == labels
    if covered is None:
        assert found["score"] == 0
    else:
        assert found["score"] == pytest.approx(1 + covered / found["n_words"])


def as_pattern(markup):
    """The template as a regular expression over words that end in a space."""
    out = []
    for token in re.findall(r"\[\[|\]\]|\{\{\d+\}\}|[^\[\]{}]+", markup):
        if token in ("[[", "]]"):
            out.append("(?:" if token == "[[" else ")?")
        elif token.startswith("{{"):
            out.append(r"(?:\S+ ){0,%s}" % token[2:-2])
        else:
            out += [re.escape(word) + " " for word in licenses.words_of(token)]
    return re.compile("".join(out))


@pytest.mark.parametrize("label", sorted(licenses.TEMPLATES))
def test_templates_against_patterns(label):
    """Every place and end in texts made from the template, with words left out, added and changed."""
    markup, rng = licenses.TEMPLATES[label], random.Random(label)
    automaton, pattern = licenses.Automaton(markup), as_pattern(markup)
    accepted = 0
    for _ in range(25):
        text = markup
        while "[[" in text:  # innermost regions first
            text = re.sub(r"\[\[([^\[\]]*)\]\]", lambda m: rng.choice([m[1], " "]), text)
        text = re.sub(r"\{\{(\d+)\}\}", lambda m: " any" * rng.randint(0, int(m[1]) + 1), text)
        words = ["x"] * rng.randint(0, 2) + licenses.words_of(text) + rng.choice([[], ["banana", "3"], ["4", "0", "x"]])
        if rng.random() < 0.4:
            at = rng.randrange(len(words))
            words[at : at + 1] = rng.choice([[], ["other"], [words[at], "other"]])
        for start in range(min(4, len(words))):
            run = [word + " " for word in words[start:]]
            ends = [k for k in range(len(run), 0, -1) if pattern.fullmatch("".join(run[:k]))]
            assert automaton.match(words, start) == (start + ends[0] if ends else None)
            accepted += bool(ends)
    assert accepted > 5
    assert automaton.match([], 0) is None
