"""License scans (op 4): MinHash bands over overlapping windows of text retrieve templates, containment verifies.

Texts and templates are words in lower case without marks; shingles are five words (a shorter template is one).

Windows. A text's shingles are cut into blocks of four; a block has the least value of its shingles under each of
``BANDS`` seeded orders. Windows of two blocks begin at every block, windows of twelve at every fourth: a run of eight
words lies in one of the former, one of 32 in one of the latter, wherever it stands. Of these blocks and windows
every band value is looked up in the table of the templates' values.

Bands. A template of eight to 31 words is cut into overlapping segments of eight words, a longer one of 32; each has
a value in every band. A window that holds a whole segment has a Jaccard similarity of 0.5 or more with it (4 of 8
shingles, 28 of 48), so some band of one row agrees with probability 1 - 0.5 ** 12 = 0.9998 or more, for each segment
that is left whole. A copy of which 0.8 of the shingles are left has one in all but odd cases: a changed word costs
five shingles, so it has a change in every twenty-five words at most. A template of under eight words is its own
window of one shingle, for which equal hashes are the band.

Verification is exact: over runs of a template's length that begin every quarter of it, the share of its distinct
shingles in the words around the run must be CONTAINED or more.

Defined results: null and empty texts have no licenses; each document and template is one row, with the best
containment and, of equal ones, the first place; very long texts are scanned whole; repeated rows give repeated
rows; an empty table gives an empty result; the document is one struct column, so no name can clash.

Scale: native expressions only, one pass over the texts without a shuffle. Templates are constants of the plan,
``CHUNK`` at a time; more of them are more passes, never fewer results. What is looked up in every document is a
value for each band and block, and a hash for each word; only documents with a value of the table are looked at
by window and template.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import blank, hashes_of, table, where_fenced, window_hashes

SHINGLE = 5
BANDS = 12
BLOCK = 4
#: Blocks of a window, by the words of a segment.
WINDOWS = {8: 2, 32: 12}
CONTAINED = 0.8
#: Templates that go into one plan.
CHUNK = 100
#: The seeded orders: shingle hashes are compared after an exclusive or with these.
MASKS = [int(x) for x in np.random.default_rng(4).integers(-(2**63), 2**63, BANDS, dtype=np.int64)]

#: Notices and license texts as their authors ask to have them given.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "All-rights-reserved": "All rights reserved.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    "Apache-2.0": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "BSD-2-Clause-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "BSD-3-Clause-clause": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "Zlib-text": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "Unlicense-text": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program.",
    "LGPL-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    "AGPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "CC-BY-ND-4.0": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
}

ROW, WORDS, HASHES, LEAST = (blank(x) for x in ("row", "words", "hashes", "least"))


@dataclass(frozen=True)
class Template:
    name: str
    words: tuple[str, ...]

    @property
    def shingle(self) -> int:
        return min(SHINGLE, len(self.words))

    @property
    def segment(self) -> int:
        """The words of its segments; 0: its shingles are looked up themselves."""
        return max((c for c in WINDOWS if c <= len(self.words)), default=0)


def normal(text: str) -> tuple[str, ...]:
    return tuple(re.findall(r"[a-z0-9]+", text.lower()))


def words_in(text: Column) -> Column:
    """Words of letters and digits in lower case; other characters beyond ASCII are part of words."""
    spaced = F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    return F.when(spaced == "", F.expr("array()").cast("array<string>")).otherwise(F.split(spaced, " "))


def template_hashes(spark, templates: list[Template]) -> dict[str, list[int]]:
    """The shingle hashes of each template, by the same expressions as those of the texts."""
    rows = spark.createDataFrame([(t.name, list(t.words), t.shingle) for t in templates], "name string, words array<string>, k int")
    hashed = rows.select("name", "k", hashes_of(F.col("words")).alias("h"))
    found = None
    for k in sorted({t.shingle for t in templates}):
        part = hashed.where(F.col("k") == k).select("name", window_hashes(F.col("h"), k).alias("s"))
        found = part if found is None else found.unionByName(part)
    return {r["name"]: r["s"] for r in found.collect()}


def band_values(template: Template, own: list[int]) -> list[int]:
    """The values of a template's segments in every band."""
    if not template.segment:
        return sorted(set(own))
    size = template.segment - SHINGLE + 1
    starts = sorted({*range(0, len(own) - size, template.segment // 2), len(own) - size})
    return sorted({min(h ^ m for h in own[a : a + size]) for a in starts for m in MASKS})


def longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def block_values(shingles: Column) -> Column:
    """The least values of each block of shingles in every band."""
    four = F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.size(shingles) - 1, F.lit(0)) / BLOCK).cast("int")), lambda j: F.struct(*[F.get(shingles, (j * BLOCK + i).cast("int")).alias(f"h{i}") for i in range(BLOCK)]))
    least = lambda x, m: F.least(*[x[f"h{i}"].bitwiseXOR(F.lit(m)) for i in range(BLOCK)])
    return F.when(F.size(shingles) > 0, F.transform(four, lambda x: F.array(*[least(x, m) for m in MASKS]))).otherwise(F.expr("array()").cast("array<array<bigint>>"))


def joined(values: Column, apart: int) -> Column:
    """The values of windows from those of blocks or shorter windows: each with the one that begins ``apart`` blocks on, if any."""
    return F.transform(values, lambda x, j: F.zip_with(x, F.coalesce(F.get(values, j + apart), x), lambda a, b: F.least(a, b)))


def scan(docs: DataFrame, text: str = "text", templates: dict[str, str] = TEMPLATES, contained: float = CONTAINED) -> DataFrame:
    """docs as one struct column, with template, containment, start and stop (in words): a row per template found."""
    known = [Template(name, normal(body)) for name, body in templates.items()]
    known = [t for t in known if t.words]
    found = [scan_chunk(docs, text, known[at : at + CHUNK], contained) for at in range(0, len(known), CHUNK)] or [scan_chunk(docs, text, [Template("", ("",))], contained)]
    for more in found[1:]:
        found[0] = found[0].unionByName(more)
    return found[0]


def scan_chunk(docs: DataFrame, text: str, known: list[Template], contained: float) -> DataFrame:
    own = template_hashes(docs.sparkSession, known)
    sizes = sorted({SHINGLE, *(t.shingle for t in known)})
    hashed = docs.select(F.struct("*").alias(ROW), words_in(F.col(text)).alias(WORDS)).select(ROW, hashes_of(F.col(WORDS)).alias(HASHES))
    shingles = hashed.select(ROW, *[window_hashes(F.col(HASHES), k).alias(f"s{k}") for k in sizes])
    blocks = shingles.withColumn(LEAST, block_values(F.col(f"s{SHINGLE}")))

    # The band table, by what it is looked up with: values of blocks, and short shingles as they are.
    bands = {t.name: band_values(t, own[t.name]) for t in known}
    wide = sorted({v for t in known if t.segment for v in bands[t.name]})
    there = F.exists(LEAST, lambda x: F.exists(x, lambda v: v.isin(wide))) if wide else F.lit(False)
    for k in sizes:
        short = sorted({v for t in known if not t.segment and t.shingle == k for v in bands[t.name]})
        if short:
            there = there | F.exists(f"s{k}", lambda v: v.isin(short))  # noqa: B023
    left = where_fenced(blocks, there)
    two = left.withColumn("w2", joined(F.col(LEAST), 1))
    four = two.withColumn("w4", joined(F.col("w2"), 2))
    eight = four.withColumn("w8", joined(F.col("w4"), 4))
    twelve = F.transform("w8", lambda x, j: F.zip_with(x, F.coalesce(F.get(F.col("w4"), j + 8), x), lambda a, b: F.least(a, b)))
    windows = eight.select(ROW, *[f"s{k}" for k in sizes], F.flatten("w2").alias("w8_"), F.flatten(F.filter(twelve, lambda x, j: j % 4 == 0)).alias("w32_"))

    lit = lambda t: [F.lit(t.name).alias("template"), F.lit(len(t.words)).alias("n"), F.lit(t.shingle).alias("k"), F.lit(t.segment).alias("segment")]
    listed = F.array(*[F.struct(*lit(t), longs(sorted(set(own[t.name]))).alias("own"), longs(bands[t.name]).alias("bands")) for t in known])
    of = lambda t: F.coalesce(*[F.when(t["k"] == k, F.col(f"s{k}")) for k in sizes])
    agrees = lambda t: F.arrays_overlap(F.when(t["segment"] == 8, F.col("w8_")).when(t["segment"] == 32, F.col("w32_")).otherwise(of(t)), t["bands"])
    candidates = windows.select(ROW, *[f"s{k}" for k in sizes], F.explode(F.filter(listed, agrees)).alias("t"))
    t = F.col("t")
    placed = candidates.select(ROW, "t", F.size(of(t)).alias("size"), F.filter(F.transform(of(t), lambda h, i: F.struct(i.alias("i"), h.alias("h"))), lambda x: F.array_contains(t["own"], x["h"])).alias("at"))

    # Runs of the template's length begin every quarter of it; the last ends with the text. Only those with a shingle in them count.
    step, span = F.greatest(F.floor(t["n"] / 4), F.lit(1)).cast("int"), t["n"] - t["k"] + 1
    last = F.greatest(F.col("size") - span, F.lit(0))
    first = lambda x: F.ceil(F.greatest(x["i"] - span + 1, F.lit(0)) / step).cast("int") * step
    near = lambda x: F.filter(F.sequence(first(x), F.greatest(first(x), x["i"]), step), lambda a: (a <= x["i"]) & (a <= last))
    begin = lambda a, of: F.struct(a.alias("a"), of.cast("int").alias("of"))
    end = F.filter(F.array(last), lambda a: F.exists("at", lambda x: (x["i"] >= a) & (x["i"] < a + span)))
    many = F.concat(F.flatten(F.transform("at", lambda x, of: F.transform(near(x), lambda a: begin(a, of)))), F.transform(end, lambda a: begin(a, F.size("at") - 1)))
    starts = F.when(F.size(t["own"]) == 1, F.array(begin(F.get("at", F.lit(0))["i"], F.lit(0)))).otherwise(many)
    # Places are distinct, so a run with what is around it has no more of them than words; they stand beside the one it begins at.
    reach = (span + 2 * step).cast("int")

    def share(x: Column) -> Column:
        low = F.greatest(x["a"] - step, F.lit(0))
        beside = F.transform(F.sequence(F.greatest(x["of"] - reach, F.lit(0)), F.least(x["of"] + reach, F.size("at") - 1)), lambda j: F.get("at", j))
        inside = F.filter(beside, lambda y: (y["i"] >= low) & (y["i"] < low + span + 2 * step))
        n = F.size(F.array_distinct(F.transform(inside, lambda y: y["h"])))
        return F.struct((n / F.size(t["own"]).cast("double")).alias("share"), (-x["a"]).alias("back"))

    best = placed.select(ROW, "t", F.array_max(F.transform(starts, share)).alias("best"))
    good = where_fenced(best, F.col("best.share") >= contained)
    return good.select(ROW, F.col("t.template").alias("template"), F.col("best.share").alias("containment"), (-F.col("best.back")).alias("start"), (F.col("t.n") - F.col("best.back")).alias("stop"))


def op4_license_scan(spark, sf_dir) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col(ROW)["doc_id"].alias("doc_id"), "template", F.round("containment", 6).alias("containment"))


def _values(templates: dict[str, str]) -> str:
    return ", ".join(f"('{name}', {list(words)}, {min(SHINGLE, len(words))}, {len(words)})" for name, body in templates.items() for words in [normal(body)])


OP4_SQL = rf"""
WITH t(template, words, k, n) AS (VALUES {_values(TEMPLATES)}),
ts AS (SELECT DISTINCT template, k, n, array_to_string(words[i:i + k - 1], ' ') AS s FROM (SELECT *, unnest(range(1, len(words) - k + 2)) AS i FROM t)),
total AS (SELECT template, count(*) AS total FROM ts GROUP BY template),
d AS (SELECT doc_id, row_number() OVER () AS row_no, list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM documents),
ds AS (SELECT row_no, k, i - 1 AS p, array_to_string(w[i:i + k - 1], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM t) WHERE len(w) >= k)),
hit AS (SELECT row_no, template, ts.k, n, p, s FROM ds JOIN ts USING (k, s)),
spans AS (SELECT DISTINCT row_no, template, n, n - hit.k + 1 AS span, greatest(1, n // 4) AS step, greatest(len(w) - hit.k + 1 - (n - hit.k + 1), 0) AS last_start FROM hit JOIN d USING (row_no)),
starts AS (SELECT DISTINCT row_no, template, span, step, unnest(list_append(range(0, last_start + 1, step), last_start)) AS a FROM spans),
near AS (SELECT s.row_no, s.template, s.a, count(DISTINCT h.s) AS shared FROM starts s JOIN hit h ON h.row_no = s.row_no AND h.template = s.template
  AND h.p >= greatest(s.a - s.step, 0) AND h.p < greatest(s.a - s.step, 0) + s.span + 2 * s.step GROUP BY s.row_no, s.template, s.a, s.span HAVING bool_or(h.p >= s.a AND h.p < s.a + s.span))
SELECT d.doc_id, template, round(max(shared) / total, 6) AS containment FROM near JOIN total USING (template) JOIN d USING (row_no) GROUP BY d.doc_id, d.row_no, template, total HAVING max(shared) / total >= {CONTAINED}
"""
