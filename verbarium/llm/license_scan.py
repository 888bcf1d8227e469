"""License scans: Dice coefficient over word bigrams against licence templates."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, small, store

# Public licence notices, the shortest forms first.
TEMPLATES = {
    "agpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details. You should have received a copy of the GNU Affero General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "bsd-2-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "bsd-3-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "bsd-3-clause-line": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0-line": "Licensed under CC BY-SA 4.0.",
    "cc0-line": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "lgpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You should have received a copy of the GNU Lesser General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    "mit-line": "Released under the MIT License.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}

#: Lengths of the runs of words compared with a template, as multiples of its own.
STRETCHES = (1.0, 1.25)
#: A segment ends at a line's end, and after . ! or ? before white space.
SENTENCE_END = r"([.!?])[\x20\x09-\x0D]+"


def segments(text: str) -> F.Column:
    """Sentences and lines of ``text``; the whole text follows if there are several."""
    parts = F.split(F.regexp_replace(text, SENTENCE_END, "$1\n"), "\n")
    return F.when(F.size(parts) > 1, F.array_append(parts, F.col(text))).otherwise(parts)


def normal(text: F.Column) -> F.Column:
    """Words (runs of a-z and digits of the lowered text) between single spaces."""
    return F.concat(F.lit(" "), F.regexp_replace(text, "[^a-z0-9]+", " "), F.lit(" "))


def bigrams(text: F.Column) -> F.Column:
    """Distinct hashes of neighbouring words of a normalised text."""
    words = F.filter(F.split(text, " "), lambda w: w != "")
    paired = lambda w: F.transform(F.slice(w, 2, F.greatest(F.size(w), F.lit(1))), lambda x, k: F.xxhash64(F.get(w, k), x))
    return F.array_distinct(F.get(F.transform(F.array(words), paired), 0))  # a lambda's variable, so that the words are made once


def in_words(text: str, made) -> F.Column:
    """``made`` of the words of a lowered text, as a lambda's variable, so that the words are made once."""
    words = F.filter(F.split(normal(F.col(text)), " "), lambda w: w != "")
    return F.get(F.transform(F.array(words), made), 0)


def window_matches(lowered: DataFrame, grams: DataFrame, least: float, longest: int) -> DataFrame:
    """Runs of words, across sentences and lines, that match a template: doc_id, _t, license, _s (place), dice, peak.

    A run starts with a bigram of the template that another word precedes than in the template, and
    ends with the last of its bigrams within one of STRETCHES times its length. Of the runs that
    start within the template's length of each other the best is the peak, the first of equal ones.

    Places are cut into overlapping blocks of the template's longest run, so what meets in a row is
    bounded by the template, however often a text repeats it; blocks with too few of its bigrams go first.
    """
    after = lambda w: F.slice(w, 2, F.greatest(F.size(w), F.lit(1)))
    paired = lambda w: F.transform(after(w), lambda x, k: F.struct(F.xxhash64(F.get(w, k), x).alias("gram"), F.xxhash64(F.get(w, k - 1)).alias("prior")))
    placed = lowered.select("doc_id", "_t", F.posexplode(in_words("_low", paired)).alias("_p", "_g")).select("doc_id", "_t", "_p", F.col("_g.gram").alias("_gram"), F.col("_g.prior").alias("_prior"))
    hits = placed.join(small(grams), "_gram").withColumn("_reach", F.ceil(F.col("_span") * max(STRETCHES)))
    own = F.floor(F.col("_p") / F.col("_reach"))
    hit = F.struct("_p", "_gram", (~F.array_contains("_before", F.col("_prior"))).alias("first"))
    dealt = hits.select("doc_id", "_t", "license", "_m", "_span", "_reach", hit.alias("_hit"), F.explode(F.array(own, own - 1)).alias("_b")).where("_b >= 0")
    blocks = dealt.groupBy("doc_id", "_t", "license", "_m", "_span", "_reach", "_b").agg(F.collect_set("_hit").alias("_h"))
    distinct = lambda of: F.size(F.array_distinct(F.transform(of, lambda h: h["_gram"])))
    enough = F.col("_m") * (least / (2 - least)) - 1e-9
    starts = blocks.where(distinct("_h") >= enough).withColumn("_s", F.explode(F.filter("_h", lambda h: h["first"] & (h["_p"] < (F.col("_b") + 1) * F.col("_reach")))))
    starts = starts.withColumn("_s", F.col("_s._p")).withColumn("_by", F.explode(F.array(*map(F.lit, STRETCHES))))
    inside = F.filter("_h", lambda h: (h["_p"] >= F.col("_s")) & (h["_p"] < F.col("_s") + F.col("_span") * F.col("_by")))
    runs = starts.withColumn("_in", inside).withColumn("_common", distinct("_in")).where(F.col("_common") >= enough)
    runs = runs.select("doc_id", "_t", "license", "_m", "_span", "_s", "_common", F.array_max(F.transform("_in", lambda h: h["_p"])).alias("_e"), F.floor(F.col("_s") / longest).alias("_b"))
    runs = store(runs, "license-runs")
    # Sizes are distinct bigrams, of the template or not: from the texts once more, but only those with runs.
    cut = lambda g: F.transform(F.sequence(F.lit(0), F.floor(F.size(g) / longest).cast("int")), lambda b: F.slice(g, b * longest + 1, 2 * longest))
    hashed = lambda w: F.get(F.transform(F.array(F.transform(after(w), lambda x, k: F.xxhash64(F.get(w, k), x))), cut), 0)
    texts = runs.select(F.col("doc_id").alias("_rd"), F.col("_t").alias("_rt")).distinct()
    mine = F.col("doc_id").eqNullSafe(F.col("_rd")) & (F.col("_t") == F.col("_rt"))
    slices = lowered.join(small(texts), mine, "left_semi").select(F.col("doc_id").alias("_rd"), F.col("_t").alias("_rt"), F.posexplode(in_words("_low", hashed)).alias("_rb", "_grams"))
    sized = runs.join(slices, mine & (F.col("_b") == F.col("_rb"))).withColumn("_n", F.size(F.array_distinct(F.slice("_grams", F.col("_s") - F.col("_b").cast("int") * longest + 1, F.col("_e") - F.col("_s") + 1))))
    scored = sized.withColumn("dice", (2.0 * F.col("_common")) / (F.col("_n") + F.col("_m"))).where(F.col("dice") >= least)
    scored = scored.groupBy("doc_id", "_t", "license", "_span", "_s").agg(F.max("dice").alias("dice")).withColumn("_x", F.col("_s") / F.col("_span"))
    near = 1 + 1 / (4 * longest)
    best = F.expr(f"max(struct(dice, -_s)) OVER (PARTITION BY doc_id, _t, license ORDER BY _x RANGE BETWEEN {near!r}D PRECEDING AND {near!r}D FOLLOWING)")
    return scored.withColumn("_best", best).select("doc_id", "_t", "license", "_s", "dice", (F.col("_best") == F.struct("dice", (-F.col("_s")).alias("col2"))).alias("peak"))


def template_words(body: str) -> list[str]:
    return re.findall("[a-z0-9]+", body.translate({k: k + 32 for k in range(65, 91)}))


def template_bigrams(body: str) -> set[tuple[str, str]]:
    words = template_words(body)
    return set(zip(words, words[1:], strict=False))


def words_before(body: str, gram: tuple[str, str]) -> list[str]:
    """The words that precede a bigram in the template."""
    words = template_words(body)
    return sorted({words[k - 1] for k in range(1, len(words) - 1) if (words[k], words[k + 1]) == gram})


def telling_words(grams: set[tuple[str, str]], least: float) -> set[str]:
    """Words of which any segment that matches the template has one.

    A match needs least / 2 * (size + template's size) common bigrams, and its size is at
    least the lower bound. Words, long ones first, are taken until fewer of the template's
    bigrams are without them than a match needs.
    """
    m = len(grams)
    need = least / 2 * (m + m * least / (2 - least)) - 1e-9
    left, taken = set(grams), set()
    while left and len(left) >= need:
        counts = Counter(w for g in left for w in set(g))
        best = max(counts, key=lambda w: (counts[w] * len(w) ** 2, w))
        taken.add(best)
        left = {g for g in left if best not in g}
    return taken


def any_word(words: list[str]) -> str:
    """A pattern that finds any of ``words`` (a-z and digits) as a whole word, in either case; grouped by first sign, so that most places fail at once."""
    by_first: dict[str, list[str]] = {}
    for w in sorted(words):
        by_first.setdefault(w[0], []).append(w[1:])
    grouped = "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in by_first.items())
    return f"(?i)(?<![a-z0-9])(?:{grouped})(?![a-z0-9])"


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, least: float = 0.8) -> DataFrame:
    """The licences whose template a text, or a segment of it, matches.

    ``docs`` needs doc_id and text; other columns are ignored. Each sentence or line of a
    text, and the text as a whole, is compared with the templates as a set of word bigrams,
    by the Dice coefficient 2 * common / (size + template's size). A coefficient of
    ``least`` needs a size between least / (2 - least) and (2 - least) / least of the
    template's: segments outside the bounds of every template are dropped before their
    bigrams are looked up, and a segment meets only templates whose bounds hold it. Before
    that, texts and segments go that have none of the words of which every match of a
    template has one (``telling_words``); this loses no match.

    Licences are also looked for in runs of words across sentences and lines (``window_matches``),
    any number in a text. The best run near each place is a notice; notices of a licence that
    no segment of the text matches count as segments too.

    Defined cases: null, empty and one-word texts match nothing; equal segments of a text
    count each; of equal coefficients the smaller licence name is the best; rows of equal
    doc_id and text are one; other rows of equal doc_id are reported together.

    Returns one row per doc_id: doc_id, n_segments (segments with a match), license (the
    best match's, null without), dice (its coefficient, 0 without), licenses (all matched
    names, sorted, comma-joined), n_notices (runs of words that match, of each licence).
    """
    spark = docs.sparkSession
    by_name = {name: grams for name, body in sorted(templates.items()) if (grams := template_bigrams(body))}
    rows = [(name, len(grams), len(template_words(templates[name])) - 1, *gram, words_before(templates[name], gram)) for name, grams in by_name.items() for gram in sorted(grams)]
    listed = spark.createDataFrame(rows, "license string, _m int, _span int, a string, b string, before array<string>")
    prior = F.transform("before", lambda w: F.xxhash64(w))
    grams = store(listed.select("license", "_m", "_span", F.xxhash64("a", "b").alias("_gram"), prior.alias("_before")), "license-templates")
    longest = max((math.ceil(row[2] * max(STRETCHES)) for row in rows), default=1)
    low, high = least / (2 - least), (2 - least) / least
    within = lambda n, m: (n >= m * low - 1e-9) & (n <= m * high + 1e-9)
    any_of = lambda tests: reduce(lambda a, b: a | b, tests, F.lit(False))
    fits = any_of(within(F.col("_n"), F.lit(m)) for m in sorted({len(g) for g in by_name.values()}))
    words = sorted(set().union(*(telling_words(g, least) for g in by_name.values())))
    tells = lambda text: any_of(F.contains(text, F.lit(f" {w} ")) for w in words)
    # Few texts have a telling word: they are looked for in the texts as they are, once, and only those are kept.
    found = docs.where(F.col("text").rlike(any_word(words))) if words else docs.where(F.lit(False))
    lowered = store(found.select("doc_id", F.xxhash64("text").alias("_t"), ascii_lower("text").alias("_low")), "license-texts")
    grams_of = lambda s: F.get(F.transform(F.array(normal(s)), lambda n: F.when(tells(n), bigrams(n))), 0)
    # The bigrams are made below the explode, so that nothing above it makes them again.
    scanned = lowered.select("doc_id", "_t", F.posexplode(F.transform(segments("_low"), grams_of)).alias("_at", "_b"))
    looked_up = scanned.withColumn("_n", F.size("_b")).where(fits).select("doc_id", "_t", "_at", "_n", F.explode("_b").alias("_gram"))
    hits = looked_up.join(small(grams.select("license", "_m", "_gram")), "_gram").where(within(F.col("_n"), F.col("_m")))
    common = F.size(F.collect_set("_gram"))  # at most a template's bigrams
    matched = hits.groupBy("doc_id", "_t", "_at", "license", "_n", "_m").agg(common.alias("_common"))
    matched = matched.withColumn("dice", (2.0 * F.col("_common")) / (F.col("_n") + F.col("_m"))).where(F.col("dice") >= least)
    matched = store(matched.select("doc_id", "_t", "_at", "license", "dice"), "license-segments")
    seen = matched.select(F.col("doc_id").alias("_sd"), F.col("_t").alias("_st"), F.col("license").alias("_sl"), F.lit(True).alias("_seen")).distinct()
    runs = window_matches(lowered, grams, least, longest)
    runs = runs.join(seen, F.col("doc_id").eqNullSafe(F.col("_sd")) & (F.col("_t") == F.col("_st")) & (F.col("license") == F.col("_sl")), "left")
    # A run is a segment of its own where no segment of the text has its licence.
    place = F.when(F.col("peak") & F.col("_seen").isNull(), -1 - F.col("_s"))
    runs = runs.select("doc_id", "_t", place.alias("_at"), "license", "dice", F.col("peak").cast("int").alias("_peak"))
    matched = matched.withColumn("_peak", F.lit(0)).unionByName(runs)
    best = F.min_by("license", F.struct(-F.col("dice"), "license"))
    per_doc = matched.groupBy(F.col("doc_id").alias("_doc")).agg(
        F.count_distinct("_t", "_at").alias("n_segments"), best.alias("license"), F.max("dice").alias("dice"), F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"), F.sum("_peak").alias("n_notices")
    )
    every = docs.select("doc_id").distinct()
    return every.join(per_doc, F.col("doc_id").eqNullSafe(F.col("_doc")), "left").select(
        "doc_id", F.coalesce("n_segments", F.lit(0)).cast("long").alias("n_segments"), "license", F.coalesce("dice", F.lit(0.0)).alias("dice"), F.coalesce("licenses", F.lit("")).alias("licenses"), F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices")
    )
