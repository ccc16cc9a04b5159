from __future__ import annotations

import math
import re
import textwrap
from collections import Counter

import numpy as np
import pytest

from gridwright.llm import licenses


def scan(spark, files, **kw):
    df = spark.createDataFrame(files, "path string, text string")
    return {r.path: (r.license, r.origin, r.inherited_from) for r in licenses.scan_licenses(df, **kw).collect()}


APACHE, MIT = "Licensed under the Apache License, Version 2.0.", "Released under the MIT License."
PROSE = "\n".join(f"some words of line {k}" for k in range(60))


def test_own_headers_and_nearest_ancestor(spark):
    files = [
        ("LICENSE", MIT), ("a/LICENSE", "Notice.\n" + APACHE), ("a/x.txt", PROSE), ("a/b/c/y.txt", PROSE),
        ("z/w.txt", PROSE), ("a/own.txt", PROSE + "\nThis work is licensed under the GNU General Public License, version 3."),
        ("a/b/nc.txt", PROSE + "\nlicensed under CC BY-NC 4.0"), ("a/empty.txt", ""), ("a/null.txt", None),
    ]
    got = scan(spark, files)
    assert got["LICENSE"] == ("MIT", "own", None) and got["a/LICENSE"] == ("Apache-2.0", "own", None)
    assert got["a/x.txt"] == ("Apache-2.0", "inherited", "a") == got["a/b/c/y.txt"] == got["a/empty.txt"] == got["a/null.txt"]
    assert got["z/w.txt"] == ("MIT", "inherited", "")
    assert got["a/own.txt"][:2] == ("GPL-3.0", "own") and got["a/b/nc.txt"][:2] == ("CC-BY-NC-4.0", "own")


@pytest.mark.parametrize("name", sorted(licenses.TEMPLATES))
def test_every_template_finds_itself(spark, name):
    files = [(f"t/{k}.txt", t) for k, t in enumerate(licenses.TEMPLATES[name])] + [("prose.txt", PROSE)]
    got = scan(spark, files)
    assert all(got[f"t/{k}.txt"][:2] == (name, "own") for k in range(len(files) - 1))
    assert got["prose.txt"] == (None, "none", None)


def test_mentions_are_not_licenses(spark):
    files = [("a.txt", "The driver needs a license to drive the car, said the officer on the road."),
             ("b.txt", "public domain")]
    assert all(v[1] == "none" for v in scan(spark, files).values())


def test_ties_nulls_repeats_and_empty_table(spark):
    files = [("d/one", MIT), ("d/two", APACHE), ("d/x", PROSE), (None, MIT), (None, PROSE), ("d/x", PROSE), ("d/x", MIT)]
    got = scan(spark, files)
    assert got["d/x"][:2] == ("MIT", "own") and got[None] == (None, "none", None)
    files = [("d/one", MIT), ("d/two", APACHE), ("d/x", PROSE)]
    assert scan(spark, files)["d/x"][2] == "d" and scan(spark, files[::-1]) == scan(spark, files)
    df = spark.createDataFrame([("p", MIT, 1, 2)], "path string, text string, line int, row int")
    assert licenses.scan_licenses(df).count() == 1 and licenses.scan_licenses(df.limit(0)).count() == 0


def test_documents_as_files(spark):
    df = spark.createDataFrame([(12345, "t", None), (None, MIT, "s")], "doc_id bigint, text string, source string")
    assert sorted(str(r.path) for r in licenses.document_files(df).collect()) == ["None", "unknown/12/123/12345.txt"]


def test_lines_without_a_cue_word_match(spark):
    """Words like 'license' need not be on the line."""
    line = "This Source Code Form is subject to the terms of the Mozilla Public"
    got = scan(spark, [("a.txt", PROSE + "\n" + line + "\n" + PROSE), ("b.txt", PROSE)])
    assert got["a.txt"][:2] == ("MPL-2.0", "own") and got["b.txt"][:2] == (None, "none")


def wrapped(text, width=60, prefix=" * "):
    return "\n".join(prefix + line for line in textwrap.wrap(text, width))


def test_wrapped_headers_and_sentences_inside_a_line(spark):
    mit, bsd = licenses.TEMPLATES["MIT"][1], licenses.TEMPLATES["BSD-3-Clause"][1]
    notices = {f"{name}.c": (name, PROSE + "\n/*\n" + wrapped(texts[0]) + "\n */\n" + PROSE) for name, texts in licenses.NOTICES.items()}
    files = {
        "mit.c": ("MIT", PROSE + "\n" + wrapped(mit, 40, "# ") + "\n" + PROSE),
        "bsd.c": ("BSD-3-Clause", wrapped(bsd, 40, "// ") + "\n" + PROSE),
        "foo.c": ("MIT", PROSE + "\nCopyright (c) 2020 Foo. Released under the MIT License."),
        "see.c": ("MIT", "Released under the MIT License. See the LICENSE file for details.\n" + PROSE),
        **notices,
    }
    got = scan(spark, [(path, text) for path, (_, text) in files.items()] + [("plain/prose.txt", PROSE)])
    assert {p: got[p][:2] for p in files} == {p: (name, "own") for p, (name, _) in files.items()}


def test_pieces_lose_nothing():
    """Against the cosine of every line, window and whole text, without bounds."""
    rng = np.random.default_rng(5)
    listed = licenses.templates()
    idf = {t: float(1 + 6 * rng.random()) for t in licenses.vocabulary()}
    rare = max(idf.values())
    finder = licenses.Finder(idf, 0.75)
    words = list(idf)

    def cosine(piece, one):
        tf = Counter(piece)
        norm = math.sqrt(sum((c * idf.get(t, rare)) ** 2 for t, c in tf.items()))
        own = math.sqrt(sum((c * idf[t]) ** 2 for t, c in one.counts.items()))
        return sum(c * idf[t] * one.counts[t] * idf[t] for t, c in tf.items() if t in one.counts) / norm / own

    for trial in range(12):
        notice = list(licenses.TEMPLATES.values())[trial % len(licenses.TEMPLATES)][-1].split()
        text = " ".join(rng.choice(words, 8)) + " zzz\n" + " ".join(
            w + ("\n" if rng.random() < 0.2 else "") + (" qqq" if rng.random() < 0.15 else "") for w in notice) + "\nend " + " ".join(rng.choice(words, 5))
        lines = [re.findall(licenses.TERM, line) for line in text.lower().split("\n")]
        terms = [t for line in lines for t in line]
        got = Counter(p["number"] for p in finder.pieces(text))
        for one in listed:
            pieces = [terms]
            if one.slides:
                pieces += [p for p in lines if p] + [terms[k : k + one.length] for k, t in enumerate(terms) if t in one.counts]
            reach = {tuple(sorted(p)) for p in pieces if cosine(p, one) >= 0.75}
            assert got[one.number] >= bool(reach)
            # Pieces are told apart by their template words and the counts of the others.
            kinds = {(tuple(sorted(t for t in p if t in idf)), sum(c * c for t, c in Counter(p).items() if t not in idf)) for p in reach}
            found = {(tuple(sorted(words[t] for t, c in zip(p["terms"], p["tfs"]) for _ in range(c))), p["other"])
                     for p in finder.pieces(text) if p["number"] == one.number}
            assert kinds <= found


def test_whole_license_texts(spark):
    """Full texts under other names: the license is that of the whole file."""
    files = [(f"{name}/x.txt", "Some title\n\n" + text) for name, text in licenses.FULL_TEXTS.items()]
    got = scan(spark, files + [(f"p/{k}.txt", PROSE) for k in range(8)])
    assert {p: v[:2] for p, v in got.items() if not p.startswith("p/")} == {f"{n}/x.txt": (n, "own") for n in licenses.FULL_TEXTS}
    assert got["p/1.txt"][1] == "none"


def test_long_license_files_pass_their_license_down(spark):
    """By name or by their whole text, whatever their number of words."""
    mit = "Copyright (c) 2020 Foo\n\n" + licenses.NOTICES["MIT"][0]
    files = [
        ("a/LICENSE", licenses.FULL_TEXTS["Apache-2.0"]), ("a/b/x.txt", PROSE), ("c/17.txt", mit), ("c/x.txt", PROSE),
        ("d/COPYING.md", PROSE + "\n" + APACHE), ("d/x.txt", PROSE), ("e/license.py", PROSE + "\n" + MIT), ("e/x.txt", PROSE),
        ("f/9.txt", licenses.FULL_TEXTS["GPL-3.0"]), ("f/g/h/x.txt", PROSE), ("x.txt", PROSE),
    ]
    got = scan(spark, files)
    assert got["a/b/x.txt"] == ("Apache-2.0", "inherited", "a") and got["c/x.txt"] == ("MIT", "inherited", "c")
    assert got["d/x.txt"] == ("Apache-2.0", "inherited", "d") and got["f/g/h/x.txt"] == ("GPL-3.0", "inherited", "f")
    assert got["e/license.py"][:2] == ("MIT", "own") and got["e/x.txt"][1] == got["x.txt"][1] == "none"


def test_every_row_has_a_result(spark):
    """Rows without a path are scanned and kept one by one; so are repeats."""
    df = spark.createDataFrame(
        [(None, MIT, "s"), (None, PROSE, "s"), (None, PROSE + "\n" + APACHE, None), (None, None, "s"), (7, MIT, "s"), (7, PROSE, "s")],
        "doc_id bigint, text string, source string")
    got = Counter((r.path, r.license, r.origin) for r in licenses.scan_licenses(licenses.document_files(df)).collect())
    assert got == Counter({(None, "MIT", "own"): 1, (None, None, "none"): 2, (None, "Apache-2.0", "own"): 1, ("s/0/0/7.txt", "MIT", "own"): 2})


SIBLING_CASES = {
    "gpl2.c": ("GPL-2.0", wrapped(licenses.NOTICES["GPL-2.0"][0])),
    "gpl3.c": ("GPL-3.0", wrapped(licenses.NOTICES["GPL-3.0"][0])),
    "lgpl21.c": ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
    "short.c": ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    "nd.md": ("CC-BY-ND-4.0", "licensed under CC BY-ND 4.0"),
    "ncsa.md": ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    "by.md": ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    "isc.c": ("ISC", wrapped(licenses.TEMPLATES["ISC"][0])),
    "bsd2.c": ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    # Relatives without a template are no other license.
    "gpl1.c": ("unknown", "This work is licensed under the GNU General Public License, version 1."),
    "gpl4.c": ("unknown", "This work is licensed under the GNU General Public License, version 4."),
    "cc3.md": ("unknown", "Licensed under CC BY-NC-SA 3.0."),
    "apache11.c": ("unknown", "Licensed under the Apache License, Version 1.1."),
    "mpl11.c": ("unknown", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1."),
    # The better match counts, known or not.
    "both.c": ("MIT", "Licensed under the Apache License, Version 1.1.\n" + PROSE + "\n" + MIT),
}


def test_siblings_are_told_apart(spark):
    files = [(f"{k}/{p}", PROSE + "\n" + t + "\n" + PROSE) for k, (p, (_, t)) in enumerate(SIBLING_CASES.items())]
    got = scan(spark, files + [(f"p/{k}.txt", PROSE) for k in range(12)])
    assert {p.split("/")[1]: v[0] for p, v in got.items() if not p.startswith("p/")} == {p: n for p, (n, _) in SIBLING_CASES.items()}


def test_a_full_text_of_another_version_is_unknown(spark):
    other = licenses.FULL_TEXTS["GPL-3.0"].replace("Version 3", "Version 9").replace("version 3", "version 9")
    got = scan(spark, [("a/COPYING", other), ("a/x.c", PROSE), ("b/x.c", PROSE)])
    assert got["a/COPYING"][:2] == ("unknown", "own") and got["a/x.c"] == ("unknown", "inherited", "a")
    assert got["b/x.c"][1] == "none"


def test_no_file_is_a_license_file_by_its_length(spark):
    """A notice is passed down if it is the file, however long, and not if it
    is a line among others, however few."""
    few, many = "one two three four\n" + MIT + "\nfive six seven eight nine ten", licenses.NOTICES["Apache-2.0"][0] * 1
    got = scan(spark, [("a/1.txt", few), ("a/x", PROSE), ("b/1.txt", many), ("b/x", PROSE), ("c/1.txt", MIT), ("c/x", PROSE)])
    assert got["a/1.txt"][:2] == ("MIT", "own") and got["a/x"][1] == "none"
    assert got["b/x"] == ("Apache-2.0", "inherited", "b") and got["c/x"] == ("MIT", "inherited", "c")


def test_the_query_against_every_piece_by_hand(spark):
    """The whole scan of the table against plain cosines of every line, window
    and text, and plain inheritance."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    files = [(r.path, r.text or "") for r in licenses.document_files(docs).collect()]
    known = licenses.vocabulary()
    words = {i: re.findall(licenses.TERM, t.lower()) for i, (_, t) in enumerate(files)}
    df = Counter(w for ws in words.values() for w in set(ws) & set(known))
    idf = {t: math.log((1 + len(files)) / (1 + df[t])) + 1 for t in known}
    rare = max(idf.values())
    listed = licenses.templates()
    norms = [math.sqrt(sum((c * idf[t]) ** 2 for t, c in one.counts.items())) for one in listed]
    own = {}
    for i, (_, text) in enumerate(files):
        lines = [re.findall(licenses.TERM, line) for line in text.lower().split("\n")]
        starts = np.cumsum([0, *map(len, lines)])
        found = []
        for one, norm in zip(listed, norms, strict=True):
            if sum((one.counts[t] * idf[t]) ** 2 for t in set(words[i]) & set(one.counts)) < (0.75 * norm) ** 2 * 0.999:
                continue  # a cosine is at most the root of this share
            spans = [(0, len(words[i]))]
            if one.slides:
                spans += list(zip(starts[:-1], starts[1:], strict=True))
                spans += [(k, min(k + one.length, len(words[i]))) for k, t in enumerate(words[i]) if t in one.counts]
            for a, b in spans:
                tf = Counter(words[i][a:b])
                size = math.sqrt(sum((c * idf.get(t, rare)) ** 2 for t, c in tf.items()))
                cosine = round(sum(c * idf[t] ** 2 * one.counts[t] for t, c in tf.items() if t in one.counts) / max(size, 1e-9) / norm, 9)
                if cosine >= 0.75:
                    near = set(tf) if one.exact else set(words[i][a : b + licenses.BEYOND])
                    told = one.title in " ".join(words[i]) if one.title else (
                        near & one.family == set(one.counts) & one.family
                        or (not one.exact and near & one.family <= set(one.counts)))
                    name = one.license if told else "unknown"
                    line = int(np.searchsorted(starts, a, "right")) - 1
                    found.append((-cosine, name == "unknown", line, name, b - a == len(words[i])))
        if found:
            own[i] = (min(found)[3], any(f[4] for f in found), -min(found)[0])
    given = {}
    for i, (path, _) in enumerate(files):
        if path and i in own and own[i][1]:
            d = path.rsplit("/", 1)[0]
            given[d] = min(given.get(d, (1, "")), (-own[i][2], path, own[i][0]))
    got = {r.path: (r.license, r.origin) for r in licenses.scan_licenses(licenses.document_files(docs)).collect()}
    for i, (path, _) in enumerate(files):
        if path is None:
            continue
        if i in own:
            want = (own[i][0], "own")
        else:
            above = [path.rsplit("/", k)[0] for k in range(1, path.count("/") + 1)] + [""]
            near = next((given[d] for d in above if d in given), None)
            want = (near[2], "inherited") if near else (None, "none")
        assert got[path] == want, path
