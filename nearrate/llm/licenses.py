"""License scans (operator 9), DataFrame functions only.

Two findings per document. Phrases: every place where a known phrase's words
stand consecutively. Templates: every block of the text whose word set holds at
least ``CONTAINMENT`` of a template's word set, found as an exact set-similarity
join. Template words are ordered by corpus frequency, rarest first, and a block's
words that any template has in the same order. With need = ceil(CONTAINMENT *
size), a block that qualifies has need such words at least (length filter), and
the first word it shares with the template, at place p there and q in the block,
is one of the template's first size - need + 1 (prefix filter) and leaves
enough words on both sides: min(size - p, block size - q) >= need (positional
filter). What remains is compared in full. As a set has no order, a block must
then also hold ``PAIRS`` of the template's pairs of neighbouring words, side by
side; words of a notice that merely happen to be near do not make one.

A template of n words is sought in blocks of twice the next power of two from n
(16 at least) that overlap by half, so its text lies whole inside a block
wherever it begins. Templates of any length are found.

Words: A-Z lower-cased, runs of letters, digits and non-ASCII characters.

Defined cases: null text is empty: no words, no labels, score 0; equal rows get
equal results; an empty table gives no rows; other columns are ignored; a
template without words matches nothing; without templates only phrases count.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, functions as F

from nearrate.llm.common import LOWER, TERM, UPPER, lower_ascii, saved, words

#: Phrase and label.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Public licenses in full where they are short, and the notices
#: that the longer ones ask to be attached; copyright lines are left out.
_NO_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
TEMPLATES = {
    "mit": ["Released under the MIT License.",
            """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""],
    "bsd": [f"{_BSD}\n{_NO_WARRANTY}", f"{_BSD}\n{_BSD_NAMES}\n{_NO_WARRANTY}"],
    "isc": ["""Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""],
    "zlib": ["""This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""],
    "apache-2": ["Licensed under the Apache License, Version 2.0.",
                 """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""],
    "gpl-3": ["This work is licensed under the GNU General Public License, version 3.",
              """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""],
    "mpl-2": ["""This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
}
CONTAINMENT = 0.8
PAIRS = 0.5
LEAST_BLOCK = 16


def template_words(templates: dict | None = None) -> list[tuple[str, list[str]]]:
    """(label, words in order) of each template that has words."""
    lower = str.maketrans(UPPER, LOWER)
    found = [(label, re.findall(TERM, t.translate(lower)))
             for label, texts in sorted((TEMPLATES if templates is None else templates).items()) for t in texts]
    return [(label, ws) for label, ws in found if ws]


def block_of(n: int) -> int:
    """The block length for a template of n words."""
    return max(LEAST_BLOCK, 2 << (n - 1).bit_length())


def pairs_of(ws: list[str]) -> list[str]:
    return sorted({f"{a} {b}" for a, b in zip(ws, ws[1:])})


def needed(size: int, share: float) -> int:
    return math.ceil(share * size - 1e-9)


def phrase_places(w: Column, phrase: str) -> Column:
    """Starts (from 0) of a phrase in an array of words. The scan runs only on
    documents that hold the phrase's longest word."""
    parts = phrase.split()
    n = len(parts)
    starts = F.filter(F.sequence(F.lit(0), F.size(w) - n), lambda i: _all(w, parts, i))
    return F.when((F.size(w) >= n) & F.array_contains(w, max(parts, key=len)) & F.array_contains(w, min(parts, key=len)),
                  starts).otherwise(F.array().cast("array<int>"))


def _all(w, parts, i):
    test = F.lit(True)
    for j, p in enumerate(parts):
        test = test & (F.get(w, i + j) == F.lit(p))
    return test


def frequencies(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Corpus counts of the template words: one row for each, a fixed number."""
    c = (docs.select(F.explode(words(lower_ascii(F.col("text")), TERM)).alias("w")).where(F.col("w").isin(vocabulary))
         .groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect())
    return {r["w"]: r["n"] for r in c}


class Index:
    """Templates with their words in global order: rarest in the corpus first."""

    def __init__(self, count: dict[str, int], templates: dict | None = None, containment: float = CONTAINMENT, pairs: float = PAIRS):
        self.entries, self.tokens = [], {}
        for tid, (label, ws) in enumerate(template_words(templates)):
            block = block_of(len(ws))
            t = sorted(set(ws), key=lambda x: (count.get(x, 0), x))
            need, p = needed(len(t), containment), pairs_of(ws)
            self.entries.append((tid, label, block, need, t, needed(len(p), pairs), p))
            self.tokens.setdefault(block, set()).update(t)
        self.tokens = {b: sorted(ts, key=lambda x: (count.get(x, 0), x)) for b, ts in self.tokens.items()}

    def prefixes(self, block: int | None = None) -> list[str]:
        """The words by which templates (of one block length) are looked up."""
        return sorted({x for _, _, b, need, t, _, _ in self.entries if block in (None, b) for x in t[: len(t) - need + 1]})

    def lookup(self, spark, block: int) -> DataFrame:
        rows = [(tid, len(t), need, token, place) for tid, _, b, need, t, _, _ in self.entries if b == block
                for place, token in enumerate(t[: len(t) - need + 1])]
        return spark.createDataFrame(rows, "tid int, size int, need int, token string, place int")

    def table(self, spark) -> DataFrame:
        rows = [(tid, label, t, need_pairs, p) for tid, label, _, _, t, need_pairs, p in self.entries]
        return spark.createDataFrame(rows, "tid int, label string, ttokens array<string>, need_pairs int, tpairs array<string>")


def candidate_blocks(tokens: DataFrame, index: Index, block: int) -> DataFrame:
    """(doc_id, key, words) -> (doc_id, key, block, bwords, bset, tid, token, need):
    the blocks of one length that pass the prefix, length and positional filters."""
    half = block // 2
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - half, F.lit(1)), F.lit(half))
    ordered = F.lit(index.tokens[block])
    blocks = (tokens.where(F.arrays_overlap("words", F.lit(index.prefixes(block))))
              .select("doc_id", "key", F.posexplode(F.transform(starts, lambda i: F.slice("words", i, block))).alias("block", "bwords"))
              # in the order of the first array, which is the global one
              .withColumn("bset", F.array_intersect(ordered, F.col("bwords"))).where(F.size("bset") > 0))
    found = blocks.select("doc_id", "key", "block", "bwords", "bset", F.posexplode("bset").alias("at", "token"))
    # the lookup has a row for each prefix word of the given templates
    return (found.join(F.broadcast(index.lookup(tokens.sparkSession, block)), "token")
            .where((F.size("bset") >= F.col("need")) & (F.least(F.col("size") - F.col("place"), F.size("bset") - F.col("at")) >= F.col("need")))
            .select("doc_id", "key", "block", "bwords", "bset", "tid", "token", "need"))


def matching_blocks(tokens: DataFrame, index: Index) -> DataFrame:
    """(doc_id, key, words) -> (doc_id, key, length, block, tid, label, share):
    every block that meets a template, once."""
    spark = tokens.sparkSession
    out = None
    for block in sorted(index.tokens):
        tried = candidate_blocks(tokens, index, block).join(F.broadcast(index.table(spark)), "tid")
        common = F.array_intersect("ttokens", "bset")
        beside = F.zip_with("bwords", F.slice("bwords", 2, block), lambda a, b: F.concat(a, F.lit(" "), b))
        met = (tried.withColumn("common", common)
               # a block meets a template by several prefix words: the first they share stands for all
               .where((F.size("common") >= F.col("need")) & (F.get("common", F.lit(0)) == F.col("token")))
               .where(F.size(F.array_intersect("tpairs", beside)) >= F.col("need_pairs"))
               .select("doc_id", "key", F.lit(block).alias("length"), "block", "tid", "label",
                       (F.size("common") / F.size("ttokens")).alias("share")))
        out = met if out is None else out.unionByName(met)
    if out is None:  # no templates
        return tokens.where(F.lit(False)).select("doc_id", "key", F.lit(0).alias("length"), F.lit(0).alias("block"), F.lit(0).alias("tid"),
                                                 F.lit("").alias("label"), F.lit(0.0).alias("share"))
    return out


def scan(docs: DataFrame, templates: dict | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score. ``templates``: label -> texts."""
    vocabulary = sorted({x for _, ws in template_words(templates) for x in ws})
    index = Index(frequencies(docs, vocabulary) if vocabulary else {}, templates, containment)
    tokens = docs.select("doc_id", F.xxhash64("text").alias("key"), words(lower_ascii(F.col("text")), TERM).alias("words"))
    places = {label: phrase_places(F.col("words"), p) for p, label in PHRASES.items()}
    # one pass: the phrases, and the words of those texts that hold a prefix word
    may = F.arrays_overlap("words", F.lit(index.prefixes())) if vocabulary else F.lit(False)
    seen = tokens.select("doc_id", "key", F.size("words").cast("long").alias("n_words"),
                         *[places[x].alias(x) for x in places], F.when(may, F.col("words")).alias("words"))
    seen = saved(seen, "license-words")
    found = matching_blocks(seen.where(F.col("words").isNotNull()).select("doc_id", "key", "words"), index)
    labels = found.groupBy("doc_id", "key").agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    starts = F.concat(*[F.col(f"`{x}`") for x in places])
    has = F.array_compact(F.array(*[F.when(F.size(F.col(f"`{x}`")) > 0, F.lit(x)) for x in places]))
    base = seen.select("doc_id", "key", "n_words", starts.alias("starts"), F.array_sort(has).alias("base"))
    out = base.alias("b").join(labels.alias("l"), F.col("b.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.col("b.key") == F.col("l.key")), "left")
    every = F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>"))))
    return out.select(
        F.col("b.doc_id").alias("doc_id"), "n_words", F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"), F.array_max("starts").cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))
