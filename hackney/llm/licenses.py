"""License scans: short phrases, and templates whose mandatory wording must match exactly.

A template is text with markup: ``<<beginOptional>>`` ... ``<<endOptional>>`` around wording that may be
missing, and ``<<var;name="...";match=".{a,b}">>`` for a place that holds any ``a`` to ``b`` words. It is
compiled to an automaton over words; a text that takes the automaton from its first to its last state
holds the license. Words compare in lower case; white space and punctuation do not count.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from hackney.llm.common import small, texts_of
from hackney.llm.license_texts import APACHE

#: Upper case to lower case, and everything but digits, letters and what is beyond ASCII to a space.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b in range(48, 58) or b in range(97, 123) or b > 127 else 32 for b in range(256)
)

# The phrases that count as such, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Customary wording of notices and whole licenses, by label. Those who disclaim in mit-text are not a
# var region: it is by their name, and by what comes after the end, that X11 differs.
TEMPLATES = {
    "gpl-3.0-notice": """
        This <<var;name="work";match=".{1,4}">> is <<beginOptional>>free software and is<<endOptional>> licensed under
        the <<beginOptional>>terms of the<<endOptional>> GNU General Public License<<beginOptional>> as published by the
        Free Software Foundation<<endOptional>>, version 3<<beginOptional>> or any later version<<endOptional>>.""",
    "apache-2.0-notice": """
        Licensed under the Apache License, Version 2.0<<beginOptional>> (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at
        <<var;name="address";match=".{1,12}">> Unless required by applicable law or agreed to in writing, software
        distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
        either express or implied. See the License for the specific language governing permissions and limitations
        under the License<<endOptional>>.""",
    "cc-by-nc-4.0-notice": """
        <<beginOptional>>This work is<<endOptional>> Licensed under <<beginOptional>>a<<endOptional>> CC BY-NC 4.0
        <<beginOptional>>International License<<endOptional>>.""",
    "cc-by-4.0-notice": """
        <<beginOptional>>This work is<<endOptional>> Licensed under <<beginOptional>>a<<endOptional>> CC BY 4.0
        <<beginOptional>>International License<<endOptional>>.""",
    "mit-notice": """
        Released under the <<beginOptional>>terms of the<<endOptional>> MIT License.""",
    "mit-text": """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall
        be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT
        WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
        FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE
        LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "isc-text": """
        Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any purpose
        with or without fee is hereby granted, provided that the above copyright notice and this permission notice
        appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND <<var;name="holder";match=".{1,20}">> DISCLAIMS
        ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.
        IN NO EVENT SHALL <<var;name="holder";match=".{1,20}">> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
        CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
        ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
        PERFORMANCE OF THIS SOFTWARE.""",
    "bsd-2-clause-text": """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of source code must
        retain the above copyright notice, this list of conditions and the following disclaimer.
        <<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided
        with the distribution. THIS SOFTWARE IS PROVIDED BY <<var;name="holder";match=".{1,20}">> "AS IS" AND ANY
        EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND
        FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<var;name="holder";match=".{1,20}">> BE
        LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT
        NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
        INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
        (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF
        THE POSSIBILITY OF SUCH DAMAGE.""",
    "bsd-3-clause-text": """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of source code must
        retain the above copyright notice, this list of conditions and the following disclaimer.
        <<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided
        with the distribution. <<beginOptional>>3.<<endOptional>> Neither the name of
        <<var;name="name";match=".{1,20}">> nor the names of <<var;name="its";match=".{1,6}">> contributors may be
        used to endorse or promote products derived from this software without specific prior written permission.
        THIS SOFTWARE IS PROVIDED BY <<var;name="holder";match=".{1,20}">> "AS IS" AND ANY EXPRESS OR IMPLIED
        WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
        PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<var;name="holder";match=".{1,20}">> BE LIABLE FOR ANY
        DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
        PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
        HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
        NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
        POSSIBILITY OF SUCH DAMAGE.""",
    "apache-2.0-text": APACHE,
    "gpl-3.0-or-later-notice": """
        This <<var;name="work";match=".{1,6}">> is free software: you can redistribute it and/or modify it under the
        terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of
        the License, or (at your option) any later version. This <<var;name="work";match=".{1,6}">> is distributed
        in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
        You should have received a copy of the GNU General Public License along with
        <<var;name="work";match=".{1,6}">> <<beginOptional>>If not, see <<beginOptional>>http<<endOptional>>
        <<beginOptional>>https<<endOptional>> www.gnu.org/licenses<<endOptional>>.""",
    "gpl-3.0-only-notice": """
        This <<var;name="work";match=".{1,6}">> is free software: you can redistribute it and/or modify it under the
        terms of the GNU General Public License as published by the Free Software Foundation, version 3
        <<beginOptional>>of the License<<endOptional>>. This <<var;name="work";match=".{1,6}">> is distributed in
        the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
        You should have received a copy of the GNU General Public License along with
        <<var;name="work";match=".{1,6}">> <<beginOptional>>If not, see <<beginOptional>>http<<endOptional>>
        <<beginOptional>>https<<endOptional>> www.gnu.org/licenses<<endOptional>>.""",
}


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


@dataclass
class Automaton:
    """States 0 to ``last``. ``steps`` maps a state's next word to the state after it; ``free`` leads on without
    a word; ``any`` leads on with any word."""

    last: int = 0
    steps: dict[int, tuple[bytes, int]] = field(default_factory=dict)
    free: dict[int, list[int]] = field(default_factory=dict)
    any: dict[int, int] = field(default_factory=dict)

    def _new(self) -> int:
        self.last += 1
        return self.last

    def reach(self, states: set[int]) -> set[int]:
        """All states that free steps lead to."""
        todo, seen = list(states), set(states)
        while todo:
            for after in self.free.get(todo.pop(), ()):
                if after not in seen:
                    seen.add(after)
                    todo.append(after)
        return seen

    def firsts(self) -> set[bytes] | None:
        """The words that a match may begin with; None if it may begin with any."""
        states = self.reach({0})
        if states & self.any.keys():
            return None
        return {self.steps[s][0] for s in states if s in self.steps}

    def end(self, words: list[bytes], start: int) -> int | None:
        """Where the longest match that begins at ``start`` ends (exclusive)."""
        states, found = self.reach({0}), None
        for i in range(start, len(words)):
            word = words[i]
            after = {self.steps[s][1] for s in states if s in self.steps and self.steps[s][0] == word}
            after |= {self.any[s] for s in states if s in self.any}
            if not after:
                return found
            states = self.reach(after)
            if self.last in states:
                found = i + 1
        return found


_MARK = re.compile(r'<<(beginOptional|endOptional|var;name="[^"]*";match="\.\{(\d+),(\d+)\}")>>')


def compile_template(template: str) -> Automaton:
    made, now, open_ = Automaton(), 0, []
    at = 0
    for mark in [*_MARK.finditer(template), None]:
        for word in words_of(template[at : mark.start() if mark else len(template)].encode()):
            made.steps[now] = (word, after := made._new())
            now = after
        if mark is None:
            break
        at = mark.end()
        # A state of its own, so that nothing but the region begins or ends here.
        made.free.setdefault(now, []).append(after := made._new())
        now = after
        if mark[1] == "beginOptional":
            open_.append(now)
        elif mark[1] == "endOptional":
            made.free.setdefault(open_.pop(), []).append(now)
        else:
            leave = []
            for n in range(int(mark[3]) + 1):
                if n >= int(mark[2]):
                    leave.append(now)
                if n < int(mark[3]):
                    made.any[now] = after = made._new()
                    now = after
            now = made._new()
            for state in leave:
                made.free.setdefault(state, []).append(now)
    if open_:
        raise ValueError("an optional region does not end")
    return made


class Scanner:
    """Finds phrases and templates in texts; the automata run only where all mandatory wording occurs."""

    def __init__(self, phrases: dict[str, str], templates: dict[str, str]) -> None:
        self._phrases = [(p.encode().split(), label) for p, label in phrases.items()]
        self._templates = [(label, compile_template(t)) for label, t in templates.items()]
        self._firsts = {label: made.firsts() for label, made in self._templates}
        self._needs = {label: _mandatory(made) for label, made in self._templates}

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int, str]], list[tuple[int, int, str]]]:
        """The number of words; phrases and templates found, as (first word, after the last, label)."""
        words = words_of(text)
        line = b" " + b" ".join(words) + b" "
        base, own = [], []
        for phrase, label in self._phrases:
            wanted, at, first, counted = b" " + b" ".join(phrase) + b" ", -1, 0, 0
            while (at := line.find(wanted, at + 1)) >= 0:
                # From the last match on, so that a text full of matches takes linear time.
                first, counted = first + line.count(b" ", counted, at), at
                base.append((first, first + len(phrase), label))
        for label, made in self._templates:
            if all(line.find(run) >= 0 for run in self._needs[label]):
                firsts, done = self._firsts[label], 0
                for i, word in enumerate(words):
                    if i >= done and (firsts is None or word in firsts) and (end := made.end(words, i)):
                        own.append((i, end, label))
                        done = end
        return len(words), base, own


def _mandatory(made: Automaton) -> list[bytes]:
    """Runs of words that every match has, as they stand in a line of words."""
    runs, now, run = [], 0, []
    # States are numbered along the template, so what no free step jumps over is mandatory.
    jumped = {s for a, afters in made.free.items() for b in afters if b > a + 1 for s in range(a, b)}
    while now <= made.last:
        if now in made.steps and now not in jumped:
            run.append(made.steps[now][0])
        elif run:
            runs.append(b" " + b" ".join(run) + b" ")
            run = []
        now += 1
    return [*runs, b" " + b" ".join(run) + b" "] if run else runs


SCHEMA = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint,"
    " base_labels string, labels string, score double,"
    " spans array<struct<label: string, first: bigint, after: bigint>>"
)
_SPANS = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("after", pa.int64())]))


def scan_licenses(
    docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES
) -> DataFrame:
    """A row per document: its words, the phrases' places and labels, the templates' labels, and all spans.

    ``score`` is 1 if a template matches, else 0.5 if a phrase does, else 0. Null and empty texts have no
    words; ``first_word`` and ``last_word``, the phrases' smallest and largest start, are null without a
    phrase. ``doc_id`` may be null, and repeated rows come back as often.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, templates)
        for whole in batches:
            for batch in small(whole):
                found = [scanner.scan(text) for text in texts_of(batch)]
                starts = [[first for first, _, _ in base] for _, base, _ in found]
                base_labels = [{label for _, _, label in base} for _, base, _ in found]
                labels = [names | {label for _, _, label in own} for names, (_, _, own) in zip(base_labels, found)]
                spans = [
                    [{"label": x, "first": a, "after": b} for a, b, x in sorted(base + own)] for _, base, own in found
                ]
                columns = [
                    batch.column(0),
                    pa.array([n for n, _, _ in found], pa.int64()),
                    pa.array(list(map(len, starts)), pa.int64()),
                    pa.array([min(s, default=None) for s in starts], pa.int64()),
                    pa.array([max(s, default=None) for s in starts], pa.int64()),
                    pa.array([",".join(sorted(x)) for x in base_labels], pa.string()),
                    pa.array([",".join(sorted(x)) for x in labels], pa.string()),
                    pa.array([1.0 if own else 0.5 if base else 0.0 for _, base, own in found]),
                    pa.array(spans, _SPANS),
                ]
                names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels"]
                yield pa.RecordBatch.from_arrays(columns, [*names, "score", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
