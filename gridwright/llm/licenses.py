"""License scan: TF-IDF cosine to license templates, then directory inheritance.

1. Templates are short notices, full notices and full license texts. A file's
   lines, its windows of a notice's length (over line ends) and the file as a
   whole are sparse TF-IDF vectors. Inverse document frequencies are counted
   over all files, so template words that are common in the corpus weigh little.
2. A piece matches the template with the highest cosine at or above
   ``THRESHOLD``; a file's own license is that of its best piece. Pieces that
   cannot reach the bound are left out before, by a bound that loses none.
   Licenses of one family differ in a few terms (version, ``lesser``, ``nd``):
   a piece with others than its template's, or without one that is needed,
   tells of a license without a template, which is ``unknown``.
3. A file is the license file of its directory if it has a license and is
   named as one (LICENSE, COPYING, NOTICE), or matches a template as a whole,
   however long. A file without a license of its own inherits from the nearest ancestor directory that has one, by joining its
   ancestor paths with the license files' directories.

The templates are few and fixed; everything else is counted, joined and
aggregated by Spark.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridwright.llm.common import in_slices, small_or_shuffled, written
from gridwright.llm.license_texts import FULL_TEXTS

THRESHOLD = 0.75
# What a file has that resembles a template but tells of another license.
UNKNOWN = "unknown"

# SPDX ids and the customary short notices of the licenses.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License",
    ],
    "LGPL-2.1": ["Licensed under the GNU Lesser General Public License, version 2.1."],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License."],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0",
    ],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "Licensed under the Creative Commons Attribution 4.0 License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0."],
    "CC-BY-NC-SA-4.0": ["Licensed under CC BY-NC-SA 4.0."],
    "CC-BY-NC-ND-4.0": ["Licensed under CC BY-NC-ND 4.0."],
    "CC0-1.0": ["Released under CC0 1.0 Universal public domain dedication."],
}
# Full notices: the header that a license asks for, or (MIT, BSD) its whole text.
NOTICES = {
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of "
        "its contributors may be used to endorse or promote products derived from this software without specific "
        "prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND "
        "ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY "
        "AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS "
        "BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT "
        "NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
        "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
        "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF "
        "THE POSSIBILITY OF SUCH DAMAGE.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS "
        "OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License.",
    ],
    **{name: [
        f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}"
        f"General Public License as published by the Free Software Foundation, either version {version} of the License, or (at "
        "your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT "
        "ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See "
        f"the GNU {kind}General Public License for more details. You should have received a copy of the GNU {kind}"
        "General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."]
       for name, kind, version in (
           ("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.1", "Lesser ", "2.1"), ("LGPL-3.0", "Lesser ", "3"),
           ("AGPL-3.0", "Affero ", "3"))},
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
}
# Terms that tell the licenses of a family apart, by the start of their ids, and
# whether a piece must have all those of its template (GNU and Creative Commons
# licenses have several siblings here) or may leave them out.
DIGITS = ("1", "2", "3", "4", "5", "6", "7", "8", "9")
SIBLINGS = {
    ("GPL", "LGPL", "AGPL"): (("lesser", "library", "affero", *DIGITS), True),
    ("CC-",): (("nc", "nd", "sa", "noncommercial", "noderivatives", "noderivs", "sharealike", *DIGITS), True),
    ("Apache", "MPL", "EPL"): (DIGITS, False),
}
# BSD licenses are told apart by their number of clauses where it is given.
CLAUSES = DIGITS
BEYOND = 3
# The full texts say their version in the title.
TITLES = {
    "Apache-2.0": "apache license version 2 0",
    "GPL-3.0": "gnu general public license version 3",
    "LGPL-3.0": "gnu lesser general public license version 3",
    "MPL-2.0": "mozilla public license version 2 0",
}
TERM = r"([a-z0-9]+)"
# Names of license files, in lower case.
LICENSE_NAME = r"^(un)?(licen[sc]e|copying|notice)([-_][a-z0-9.+_-]*)?(\.(txt|md|rst|html|lesser|mit|apache|bsd))?$"
# Texts scanned at a time.
BATCH_ROWS = 64


class Template(NamedTuple):
    number: int
    license: str
    counts: dict[str, int]
    length: int  # in terms
    slides: bool  # compared with windows and lines, and not with whole files only
    family: frozenset[str]  # terms of which a piece must have no others than the template
    exact: bool  # and all of the template's
    title: str  # words that a whole file must have


def templates() -> list[Template]:
    """The short notices, the full notices, and the full license texts."""
    listed = [(name, t, True) for texts in (TEMPLATES, NOTICES) for name, some in texts.items() for t in some]
    listed += [(name, t, False) for name, t in FULL_TEXTS.items()]
    out = []
    for k, (name, text, slides) in enumerate(listed):
        terms = re.findall(TERM, text.lower())
        family, exact = next((f for starts, f in SIBLINGS.items() if name.startswith(starts)), ((), False)) if slides else ((), False)
        if slides and "clause" in terms:
            family, exact = CLAUSES, True
        title = "" if slides else TITLES.get(name, "")
        out.append(Template(k, name, Counter(terms), len(terms), slides, frozenset(family), exact, title))
    return out


def vocabulary() -> list[str]:
    return sorted({t for one in templates() for t in (*one.counts, *one.family)})


def inverse_frequencies(files: DataFrame) -> dict[str, float]:
    """IDF of the template words over all files (one number per word, at most
    as many as the templates have)."""
    known = vocabulary()
    words = files.select(F.array_intersect(
        F.split(F.lower("text"), r"[^a-z0-9]+"), F.array(*map(F.lit, known))).alias("w"))
    total = files.count()
    rows = words.select(F.explode("w").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()
    seen = {r["w"]: r["n"] for r in rows}
    return {t: math.log((1 + total) / (1 + seen.get(t, 0))) + 1 for t in known}


def template_vectors(idf: dict[str, float]) -> list[tuple[int, int, float]]:
    """(number, term, weight): unit TF-IDF vectors of the templates; a term is
    its place in the vocabulary."""
    place, out = {t: k for k, t in enumerate(idf)}, []
    for one in templates():
        norm = math.sqrt(sum((c * idf[t]) ** 2 for t, c in one.counts.items()))
        out += [(one.number, place[t], c * idf[t] / norm) for t, c in sorted(one.counts.items())]
    return out


class Finder:
    """The pieces of a text that may reach the threshold with a template.

    Pieces are the whole text, each line, and each window that starts at a
    template's word and has as many words as the template. Two bounds leave
    pieces out, and neither loses one: a cosine is at most the root of the
    template's mass (squared weights) on the words that the text has, and at
    most the dot product over the root of the sum of squared IDFs, which is
    the length of the piece's vector if no word repeats and less otherwise."""

    def __init__(self, idf: dict[str, float], threshold: float):
        self.place = {t: k for k, t in enumerate(idf)}
        self.idf = np.array([*idf.values(), max(idf.values())])  # the last: all words outside the templates
        self.listed = templates()
        self.weights = np.zeros((len(self.idf), len(self.listed)))
        for number, term, weight in template_vectors(idf):
            self.weights[term, number] = weight
        self.least = threshold - 1e-9
        self.family = [np.array(sorted(self.place[t] for t in one.family), np.int64) for one in self.listed]
        self.telling = [{self.place[t] for t in one.family if t in one.counts} for one in self.listed]

    def pieces(self, text: str) -> list[dict]:
        """number, line, whole (the piece is the file), told (it has the terms
        that tell the template's license from its siblings), terms, tfs (of
        template words) and other (the sum of squared counts of all other words). Equal pieces are given once, with their first line."""
        low = text.lower()
        get, rest = self.place.get, len(self.place)
        known = {k for k in map(get, set(re.findall(TERM, low))) if k is not None}
        if not known:
            return []
        mass = (self.weights[list(known)] ** 2).sum(0)
        may = np.flatnonzero(mass >= self.least**2)
        if not len(may):
            return []
        new: dict[str, int] = {}
        ids, breaks = [], [0]
        for line in low.split("\n"):
            for w in re.findall(TERM, line):
                k = get(w)
                ids.append(new.setdefault(w, rest + len(new)) if k is None else k)
            breaks.append(len(ids))
        ids, breaks = np.array(ids), np.array(breaks)
        at = np.minimum(ids, rest)
        squares = np.concatenate([[0.0], np.cumsum(self.idf[at] ** 2)])
        out: dict[tuple, dict] = {}
        words = None
        for number in may.tolist():
            one, weight = self.listed[number], self.weights[at, number]
            dots = np.concatenate([[0.0], np.cumsum(self.idf[at] * weight)])
            lo, hi = [np.array([0])], [np.array([len(ids)])]
            if one.slides:
                starts = np.flatnonzero(weight > 0)
                lo += [breaks[:-1], starts]
                hi += [breaks[1:], np.minimum(starts + one.length, len(ids))]
            lo, hi = np.concatenate(lo), np.concatenate(hi)
            ok = (hi > lo) & (dots[hi] - dots[lo] >= self.least * np.sqrt(squares[hi] - squares[lo]) - 1e-9)
            for a, b in sorted(set(zip(lo[ok].tolist(), hi[ok].tolist(), strict=True))):
                terms, tfs = np.unique(ids[a:b], return_counts=True)
                inside = terms < rest
                other = float((tfs[~inside] ** 2).sum())
                whole = bool(b - a == len(ids))
                if one.title and words is None:
                    words = " ".join(re.findall(TERM, low))
                if one.title:
                    told = one.title in words
                else:
                    # A window may end before the version: the next words tell, too.
                    beyond = terms if one.exact else ids[a : b + BEYOND]
                    has = set(np.intersect1d(beyond, self.family[number]).tolist())
                    told = has == self.telling[number] or (not one.exact and has <= self.telling[number])
                key = (number, whole, told, terms[inside].tobytes(), tfs[inside].tobytes(), other)
                if key not in out:
                    line = int(np.searchsorted(breaks, a, "right")) - 1
                    out[key] = {"number": number, "line": line, "whole": whole, "told": told, "terms": terms[inside].tolist(),
                                "tfs": tfs[inside].tolist(), "other": other}
        return list(out.values())


PIECES = "array<struct<number:int,line:int,whole:boolean,told:boolean,terms:array<int>,tfs:array<int>,other:double>>"
ARROW_PIECES = pa.list_(pa.struct([
    ("number", pa.int32()), ("line", pa.int32()), ("whole", pa.bool_()), ("told", pa.bool_()), ("terms", pa.list_(pa.int32())),
    ("tfs", pa.list_(pa.int32())), ("other", pa.float64())]))


def file_pieces(files: DataFrame, idf: dict[str, float], threshold: float) -> DataFrame:
    """Written once, a row per row of ``files``: file (a row number), path
    and its pieces."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(idf, threshold)
        for batch in in_slices(batches, BATCH_ROWS):
            found = [finder.pieces(t) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(found, ARROW_PIECES)], names=["path", "pieces"])

    rows = files.select("path", "text").mapInArrow(find, f"path string, pieces {PIECES}")
    return written(rows.withColumn("file", F.monotonically_increasing_id()), "license-pieces")


def file_matches(found: DataFrame, idf: dict[str, float], threshold: float) -> DataFrame:
    """(file, path, license, line, cosine, whole): the best template of each
    row of ``file_pieces`` that has one; whole says that a template matches the file as a whole.

    The cosine of a piece counts all its words: words outside the templates
    weigh as words that no file has."""
    spark = found.sparkSession
    rare = max(idf.values())
    weights = spark.createDataFrame([(k, v) for k, v in enumerate(idf.values())], "term int, idf double")
    vectors = spark.createDataFrame(template_vectors(idf), "number int, term int, weight double")
    names = spark.createDataFrame([(t.number, t.license) for t in templates()], "number int, license string")
    pieces = found.select("file", F.posexplode("pieces").alias("nth", "p")).select("file", "nth", "p.*")
    key = ["file", "nth", "number", "line", "whole", "told", "other"]
    tf = pieces.select(*key, F.explode(F.arrays_zip("terms", "tfs")).alias("t")).select(*key, "t.terms", "t.tfs")
    tf = tf.withColumnsRenamed({"terms": "term", "tfs": "tf"})
    entries = tf.join(F.broadcast(weights), "term").join(F.broadcast(vectors), ["number", "term"], "left").select(
        *key, (F.col("tf") * F.col("idf")).alias("v"), F.coalesce("weight", F.lit(0.0)).alias("weight"))
    sums = entries.groupBy(*key).agg(F.sum(F.col("v") * F.col("weight")).alias("dot"), F.sum(F.col("v") * F.col("v")).alias("sq"))
    cosine = F.round(F.col("dot") / F.sqrt(F.col("sq") + F.col("other") * F.lit(rare * rare)), 9)
    best = sums.withColumn("cosine", cosine).where(F.col("cosine") >= threshold).join(F.broadcast(names), "number")
    best = best.withColumn("license", F.when(F.col("told"), F.col("license")).otherwise(F.lit(UNKNOWN)))
    return best_of(best, "file").join(found.select("file", "path"), "file")


def best_of(matches: DataFrame, key: str) -> DataFrame:
    """One row per key: the highest cosine, then a known license before an
    unknown one, the earlier line, the name."""
    order = F.struct(-F.col("cosine"), F.col("license") == UNKNOWN, "line", "license")
    return matches.groupBy(key).agg(
        F.min_by("license", order).alias("license"), F.min_by("line", order).alias("line"),
        F.min_by("cosine", order).alias("cosine"), F.max("whole").alias("whole"))


def ancestors(path: Column) -> Column:
    """Directories above a path, the nearest first, the root ('') last."""
    parts = F.split(path, "/")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda k: F.array_join(F.slice(parts, F.lit(1), F.size(parts) - k), "/"))


def scan_licenses(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """License of every file.

    ``files`` has path and text; other columns are ignored whatever their
    names, and texts of any length are scanned whole. Returns, for each of its
    rows, path, license (null if none applies, ``unknown`` for a relative of a
    template that is none of them), origin (``own``, ``inherited`` or ``none``),
    inherited_from (the directory whose license file gave it), cosine and line
    (of an own license). A null or empty text has no own license and inherits.
    A row with a null path is a file of its own at an unknown place: it has the
    license of its text, and can neither give nor inherit. Rows that repeat a
    path are one file with all their lines, and each gets that file's result.
    Where several license files of a directory disagree, the highest cosine
    wins, then the path. An empty table gives no rows.
    """
    files = files.select(F.col("path").cast("string").alias("path"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    idf = inverse_frequencies(files)
    found = file_pieces(files, idf, threshold)
    matches = written(file_matches(found, idf, threshold), "license-matches")
    own = written(best_of(matches.where("path is not null"), "path"), "license-own")
    named = F.lower(F.element_at(F.split("path", "/"), -1)).rlike(LICENSE_NAME)
    licensed = own.where(F.col("whole") | named).select(
        F.get(ancestors(F.col("path")), F.lit(0)).alias("dir"), "license", "cosine", "path")
    order = F.struct(-F.col("cosine"), "path")
    directories = small_or_shuffled(
        licensed.groupBy("dir").agg(F.min_by("license", order).alias("dir_license")), "license-directories")
    known = small_or_shuffled(own.drop("whole"), "license-known")
    marked = written(found.where("path is not null").select("path").join(known, "path", "left"), "license-marked")
    # Ancestor directories are few and shared: inheritance is decided per directory, not per file.
    open_dirs = marked.where("license is null").select(
        F.get(ancestors(F.col("path")), F.lit(0)).alias("from_dir")).distinct()
    steps = open_dirs.select("from_dir", F.posexplode(F.concat(F.array("from_dir"), F.when(
        F.col("from_dir") == "", F.array().cast("array<string>")).otherwise(ancestors(F.col("from_dir"))))).alias("up", "dir"))
    nearest = steps.join(directories, "dir").groupBy("from_dir").agg(
        F.min_by(F.struct("dir", "dir_license"), "up").alias("given")).select(
        "from_dir", F.col("given.dir").alias("given_dir"), F.col("given.dir_license").alias("given_license"))
    nearest = small_or_shuffled(nearest, "license-nearest")
    at = F.when(F.col("license").isNull(), F.get(ancestors(F.col("path")), F.lit(0)))
    out = marked.withColumn("from_dir", at).join(nearest, "from_dir", "left")
    out = out.select(
        "path", F.coalesce("license", "given_license").alias("license"),
        F.when(F.col("license").isNotNull(), "own").when(F.col("given_license").isNotNull(), "inherited")
        .otherwise("none").alias("origin"),
        F.col("given_dir").alias("inherited_from"), "cosine", "line")
    return placeless(found, matches, out).unionByName(out)


def placeless(found: DataFrame, matches: DataFrame, like: DataFrame) -> DataFrame:
    """The rows with a null path, in the columns of ``like``: those with a
    license of their own, then the others."""
    licensed = matches.where("path is null")
    plain = found.where("path is null").join(licensed.select("file"), "file", "left_anti")
    nothing = {c: F.lit(None).cast(like.schema[c].dataType) for c in like.columns}
    return licensed.select(*[{**nothing, "license": F.col("license"), "origin": F.lit("own"), "cosine": F.col("cosine"),
                              "line": F.col("line")}[c].alias(c) for c in like.columns]).unionByName(
        plain.select(*[{**nothing, "origin": F.lit("none")}[c].alias(c) for c in like.columns]))


def document_files(documents: DataFrame) -> DataFrame:
    """Documents as files: source / thousands of ids / hundreds of ids / id."""
    part = lambda n: F.floor(F.col("doc_id") / n).cast("string")
    path = F.concat_ws("/", F.coalesce(F.col("source").cast("string"), F.lit("unknown")), part(1000), part(100),
                       F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return documents.select(F.when(F.col("doc_id").isNotNull(), path).alias("path"), "text")
