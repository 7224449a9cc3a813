import math
import re
import textwrap
from collections import Counter

from pyspark.sql import functions as F

from lapframe.llm import licenses
from lapframe.llm.common import read_table
from lapframe.llm.workload import as_files, op2_license_scan

SF = "/root/testdata/sf0.01"


def plain(rows):
    """Path to (own license, cosine, license, directory), by loops."""
    cue = re.compile(licenses.CUE)
    cut, files = [], [(p, t or "") for p, t in dict.fromkeys(rows) if cue.search(t or "")]
    for path, text in dict.fromkeys(files):
        found = [s for s in re.split(licenses.SENTENCE, text) if cue.search(s)]
        cut += [(path, at, s, len(s) / len(text)) for at, s in enumerate(found)]
        lines = text.split("\n")
        for at, line in enumerate(lines):
            if cue.search(line):
                for r in licenses.AROUND:
                    block = lines[max(0, at - r) : at + r + 1]
                    cut.append((path, at, "\n".join(block), sum(map(len, block)) / len(text)))
        cut.append((path, 0, text, sum(map(len, lines)) / len(text)))
    templates = [(k, Counter(licenses._terms(t))) for k, ts in licenses.TEMPLATES.items() for t in ts]
    vocabulary = set().union(*(w for _, w in templates))
    df = Counter(t for _, text in dict.fromkeys(files) for t in set(licenses._terms(text)))
    weight = {t: math.log((1 + len(set(files))) / (1 + (df[t] if t in vocabulary else 0))) + 1 for t in {*df, *vocabulary}}
    units = []
    for name, words in templates:
        u = {t: k * weight[t] for t, k in words.items()}
        units.append((name, u, math.sqrt(sum(x * x for x in u.values()))))
    own = {}
    for path, at, s, share in cut:
        v = {t: k * weight[t] for t, k in Counter(licenses._terms(s)).items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        for name, u, norm in units:
            c = sum(v[t] * u[t] for t in v.keys() & u.keys()) / (size * norm or 1)
            if c >= licenses.LEAST_COSINE:
                own[path] = max(own.get(path, (0,)), (round(c, 9), share, -at, name))
    dirs = {}
    for path in sorted(own):
        if own[path][1] >= licenses.FILE_SHARE or re.search(licenses.FILE_NAME, path):
            dirs.setdefault(path.rpartition("/")[0], own[path][3])
    out = {}
    for path in {p for p, _ in rows}:
        if path in own:
            out[path] = (own[path][3], own[path][0], own[path][3], None)
            continue
        up = path
        while up:
            up = up.rpartition("/")[0]
            if up in dirs:
                break
        out[path] = (None, None, dirs.get(up), up if up in dirs else None)
    return out


def check(files, rows):
    want, got = plain(rows), licenses.scan(files).collect()
    assert len(got) == len(want)
    for r in got:
        own, cosine, license, directory = want[r.path]
        assert (r.own_license, r.license, r.from_dir) == (own, license, directory), r.path
        assert cosine is None and r.cosine is None or math.isclose(cosine, r.cosine, abs_tol=1e-6)


def test_given_documents(spark):
    files = as_files(read_table(spark, SF, "documents"))
    rows = [tuple(r) for r in files.select("path", "text").collect()]
    check(files, rows)
    kinds = {r.own_license for r in licenses.scan(files).collect()}
    assert {"Apache-2.0", "MIT", "GPL"} <= kinds


def test_inheritance_and_odd_rows(spark, frame):
    rows = [
        ("LICENSE", "Released under the MIT License."),
        ("a/COPYING", "Licensed under the Apache License, Version 2.0."),
        ("a/b/x.py", "plain text"),
        ("a/b/y.py", "# This work is licensed under the GNU General Public License, v3\n" + "x = 1\n" * 40),
        ("c/z.py", None),
        ("c/d/", ""),
        ("top.txt", "no license here " * 500),
        ("top.txt", "no license here " * 500),
        (None, "Released under the MIT License."),
    ]
    files = frame([(*r, 0) for r in rows], "path string, text string, license int")
    check(files, [r for r in rows if r[0] is not None])
    got = {r.path: r for r in licenses.scan(files).collect()}
    assert got["a/b/x.py"].license == "Apache-2.0" and got["a/b/y.py"].own_license == "GPL"
    assert got["c/z.py"].license == "MIT" and got["c/z.py"].from_dir == ""
    assert licenses.scan(files.filter(F.lit(False))).collect() == []


def test_query_takes_documents_without_an_id_or_with_odd_sources(spark, tmp_path):
    rows = [(None, "Released under the MIT License.", "a/b"), (7, "plain text", "a/b"), (8, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = op2_license_scan(spark, str(tmp_path))
    assert sorted(((r.doc_id, r.path) for r in got.collect()), key=repr) == [
        (7, "a_b/0/0/7"), (8, "none/0/0/8"), (None, "a_b/none/none/none")]


HEADERS = {
    "MIT": licenses.TEMPLATES["MIT"][1],
    "MPL-2.0": licenses.TEMPLATES["MPL-2.0"][1],
    "GPL": licenses.TEMPLATES["GPL"][1].replace("version 3", "version 2"),
    "BSD-3-Clause": licenses.TEMPLATES["BSD-3-Clause"][1],
    "Apache-2.0": licenses.TEMPLATES["Apache-2.0"][1],
}


def test_headers_are_found_however_they_are_wrapped(spark, frame):
    code = "\n".join(f"value_{i} = compute(argument_{i}, other_{i})" for i in range(80))
    rows, want = [], {}
    for name, text in HEADERS.items():
        flat = " ".join(text.split())
        for width in (40, 72, 5000):
            body = "\n".join("# " + x for x in textwrap.wrap(flat, width))
            rows += [(f"{name}/{width}/header.py", f"# Copyright 2024 Some Author\n{body}\n\n{code}"), (f"{name}/{width}/f/LICENSE", flat), (f"{name}/{width}/f/sub/x.py", code)]
            want |= {f"{name}/{width}/header.py": name, f"{name}/{width}/f/LICENSE": name, f"{name}/{width}/f/sub/x.py": name}
    rows += [("spdx/a.c", "// SPDX-License-Identifier: MIT\n" + code), ("spdx/b.c", "/* SPDX-License-Identifier: GPL-3.0-or-later */\n" + code), ("plain/p.py", code)]
    want |= {"spdx/a.c": "MIT", "spdx/b.c": "GPL", "plain/p.py": None}
    got = {r.path: r.license for r in licenses.scan(frame(rows, "path string, text string")).collect()}
    assert got == want
