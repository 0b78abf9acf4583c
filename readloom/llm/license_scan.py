"""License templates in texts, by an exact set-similarity join of text blocks with templates.

Tokens are ordered by their frequency in the whole corpus, rarest first. A template with n
distinct tokens and threshold t needs o = ceil(t * n) of them in a block, so one of its
first n - o + 1 tokens is there: only blocks that hold such a prefix token are candidates.
Of these, blocks with fewer than o template tokens (length filter), and those whose tokens
from the met one on cannot reach o (positional filter), fall out before tokens are counted.

Blocks are stretches of words, each half over the next, so whatever is no longer than half a
block lies in one of them as a whole. Their length follows the template: `BLOCK` words, doubled
until half a block holds the template, so a sentence is sought in short blocks and a whole
license text in long ones.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, Words, batch, slices

#: Words of the shortest blocks.
BLOCK = 48
#: Templates are broadcast; their words at most in one scan (some 16 MB), which is four times all SPDX license texts.
MOST_TEMPLATE_WORDS = 1_000_000


class Template(NamedTuple):
    label: str
    text: str
    threshold: float = 0.8
    #: the words must stand together, in order
    phrase: bool = False
    #: words of the text that a block must have in any case, as they tell it from others
    telling: str = ""


def block_length(words: int) -> int:
    """Words of the blocks in which a template of so many words is sought."""
    length = BLOCK
    while length // 2 < words:
        length *= 2
    return length


BASE = (Template("cc-by", "cc by", 1.0, True), Template("gpl", "general public license", 1.0, True), Template("reserved", "all rights reserved", 1.0, True))
# Wordings of well-known licenses and notices, as published.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
_GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""

#: Templates of the method: opening sentences and whole texts.
TEMPLATES = (
    Template("apache-2.0", _APACHE, telling="apache 2 0"),
    Template("bsd", _BSD),
    Template("gpl-3.0", _GPL, telling="gnu 3"),
    Template("isc", _ISC),
    Template("mit", _MIT),
    Template("zlib", _ZLIB),
    Template("agpl-3.0", "gnu affero general public license version 3", telling="affero general public license 3"),
    Template("apache-2.0", "licensed under the apache license version 2 0", telling="apache license 2 0"),
    Template("boost-1.0", "distributed under the boost software license version 1 0", telling="boost software license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", telling="redistribution"),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", telling="cc by nc 4 0"),
    Template("cc-by-nd-4.0", "licensed under cc by nd 4 0", telling="cc by nd 4 0"),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", telling="cc by sa 4 0"),
    Template("cc0", "to the extent possible under law the author has waived all copyright and related rights", telling="waived"),
    Template("epl-2.0", "terms of the eclipse public license 2 0", telling="eclipse public license 2 0"),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3", telling="gnu general public license 3"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose"),
    Template("lgpl", "gnu lesser general public license", telling="lesser general public license"),
    Template("mit", "released under the mit license", telling="mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", telling="mozilla public license 2 0"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", telling="unencumbered public domain"),
)


class Index:
    """The templates, their vocabulary (hashes, sorted) and, once counts are known, their prefixes."""

    def __init__(self, templates: tuple[Template, ...]):
        self.templates = templates
        texts = [t.text.encode() for t in templates]
        w = Words(texts, WORD, lower=True)
        if len(w.start) > MOST_TEMPLATE_WORDS:
            raise ValueError("too many template words for one scan; scan with parts of the templates")
        if not w.counts.all():
            raise ValueError("a template without words")
        self.length = [block_length(int(n)) for n in w.counts]
        h = w.hashes()
        self.sequence = [h[a:b] for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
        self.words = [[bytes(w.data[s:e]) for s, e in zip(w.start[a:b], w.end[a:b], strict=True)] for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
        self.vocabulary = np.unique(h)
        telling = Words([t.telling.encode() for t in templates], WORD, lower=True)
        self.telling_words = np.split(telling.hashes(), telling.first[1:-1])
        if not all(np.isin(t, s).all() for t, s in zip(self.telling_words, self.sequence, strict=True)):
            raise ValueError("a telling word that its template does not have")

    def known(self, h: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == h, at, -1)

    def order_by(self, counts: np.ndarray) -> None:
        rank = np.empty(len(counts), np.int64)
        rank[np.argsort(counts, kind="stable")] = np.arange(len(counts))
        self.rank = rank  # of a vocabulary place in the global order
        self.tokens = [np.sort(rank[np.unique(np.searchsorted(self.vocabulary, s))]) for s in self.sequence]
        self.telling = [np.sort(rank[np.unique(np.searchsorted(self.vocabulary, t))]) for t in self.telling_words]
        self.needed = [max(1, math.ceil(t.threshold * len(r) - 1e-9)) for t, r in zip(self.templates, self.tokens, strict=True)]
        #: by length of block and rank: (template, place in its order)
        self.starts: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for k, (r, o) in enumerate(zip(self.tokens, self.needed, strict=True)):
            own = self.starts.setdefault(self.length[k], {})
            for i, x in enumerate(r[: len(r) - o + 1].tolist()):
                own.setdefault(x, []).append((k, i))
        self.first = {length: np.isin(np.arange(len(counts)), list(own)) for length, own in self.starts.items()}


def token_counts(docs: DataFrame, text: str, index: Index) -> np.ndarray:
    """How often each template token occurs in the whole corpus."""
    shared = docs.sparkSession.sparkContext.broadcast(index)
    schema = pa.schema([("token", pa.int64()), ("n", pa.int64())])

    def work(batches):
        total = np.zeros(len(shared.value.vocabulary), np.int64)
        for _, texts in slices(batches):
            at = shared.value.known(Words(texts, WORD, lower=True).hashes())
            total += np.bincount(at[at >= 0], minlength=len(total))
        yield batch(schema, np.arange(len(total)), total)

    out = np.zeros(len(index.vocabulary), np.int64)
    for token, n in docs.select(F.col(text).alias("text")).mapInArrow(work, "token long, n long").groupBy("token").agg(F.sum("n")).collect():
        out[token] = n
    return out


def joined(texts: list[bytes], index: Index) -> tuple[Words, list[tuple[int, int, int, float]]]:
    """All (text, first word of the block, template, containment) at or above the template's threshold, by text and block."""
    w = Words(texts, WORD, lower=True)
    at = index.known(w.hashes())
    place = np.flatnonzero(at >= 0)
    rank = index.rank[at[place]]
    owner = np.searchsorted(w.first, place, side="right") - 1
    inside = place - w.first[owner]
    out = {}
    for length, starts in index.starts.items():
        half, met, blocks = length // 2, set(), {}
        for p in np.flatnonzero(index.first[length][rank]).tolist():
            begin = int(inside[p]) // half * half
            met.update((int(owner[p]), b, int(rank[p])) for b in (begin, begin - half) if b == 0 or b > 0 and w.counts[owner[p]] > b + half)
        for doc, begin, r in met:
            if (doc, begin) not in blocks:
                a, b = np.searchsorted(place, [w.first[doc] + begin, min(w.first[doc] + begin + length, w.first[doc + 1])])
                blocks[doc, begin] = np.unique(rank[a:b])
            block = blocks[doc, begin]
            for k, i in starts[r]:
                if (doc, begin, k) in out or len(block) < index.needed[k]:
                    continue
                tokens = index.tokens[k]
                j = int(np.searchsorted(block, r))
                if i + 1 + min(len(tokens) - i - 1, len(block) - j - 1) < index.needed[k]:
                    continue
                shared = len(np.intersect1d(tokens, block, assume_unique=True))
                if shared >= index.needed[k] and np.isin(index.telling[k], block, assume_unique=True).all():
                    out[doc, begin, k] = shared / len(tokens)
    return w, [(*x, c) for x, c in sorted(out.items())]


_FOUND = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("places", pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))), ("labels", pa.list_(pa.string())), ("blocks", pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()), ("containment", pa.float64())]))), ("score", pa.float64())])


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: tuple[Template, ...] = BASE + TEMPLATES) -> DataFrame:
    """doc_id, n_words, places, labels, blocks, score of every row.

    blocks: label, first word and containment of every block that reaches a template's
    threshold and has all its telling words (of a phrase, only blocks that hold it); places: label and first word of every
    phrase; labels: those of both, sorted and distinct; score: the highest containment, 0
    without any. A-Z are lower-cased; words are letters, digits and all beyond ASCII. Null and
    empty texts have no words; rows are kept apart even if doc_ids repeat or are null; an empty
    table gives none. Tokens of one frequency are ordered by hash, which changes no result.
    """
    index = Index(tuple(templates))
    index.order_by(token_counts(docs, text, index))
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def work(batches):
        ix = shared.value
        for rows, texts in slices(batches):
            w, found = joined(texts, ix)
            n = len(texts)
            places, labels, blocks, score = [set() for _ in range(n)], [set() for _ in range(n)], [[] for _ in range(n)], [0.0] * n
            for doc, begin, k, containment in found:
                t, words = ix.templates[k], ix.words[k]
                if t.phrase:
                    a = w.first[doc] + begin
                    b = min(a + ix.length[k], w.first[doc + 1])
                    own = [bytes(w.data[s:e]) for s, e in zip(w.start[a:b], w.end[a:b], strict=True)]
                    here = [begin + i for i in range(len(own) - len(words) + 1) if own[i : i + len(words)] == words]
                    if not here:
                        continue
                    places[doc].update((t.label, p) for p in here)
                labels[doc].add(t.label)
                blocks[doc].append((t.label, begin, containment))
                score[doc] = max(score[doc], containment)
            yield batch(_FOUND, rows.column("doc_id"), w.counts, [[{"label": x, "word": p} for x, p in sorted(s, key=lambda y: (y[1], y[0]))] for s in places], [sorted(s) for s in labels], [[{"label": x, "word": b, "containment": c} for x, b, c in s] for s in blocks], score)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(work, "doc_id long, n_words long, places array<struct<label: string, word: long>>, labels array<string>, blocks array<struct<label: string, word: long, containment: double>>, score double")
