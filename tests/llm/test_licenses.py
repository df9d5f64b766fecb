import math
import re
from collections import Counter

from llm_rows import LONG

from anchorline.llm import licenses
from anchorline.llm.queries import QUERIES
from conftest import SMALL

MIT, APACHE = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."


def files(spark, rows):
    frame = spark.createDataFrame(list(rows), "doc_id long, path string, text string")
    return frame.selectExpr("*", "'x' AS line", "'y' AS score", "'z' AS folder", "'w' AS license")


def scan(spark, staging, rows):
    return licenses.scan(files(spark, rows), staging)


def brute(rows):
    """Own cosines by hand: per file the best line and the whole file, by plain dictionaries."""
    rows = [(i, p or "", t or "") for i, p, t in rows]
    words = lambda t: re.findall(r"[^\W_]+(?:\.[0-9]+)*", t.lower())
    n = len(rows)
    df = Counter(w for _, _, t in rows for w in set(words(t)))
    vocabulary = set(licenses.VOCABULARY)

    def vector(text):
        return {
            w: k * (math.log((1 + n) / (1 + df[w])) + 1 if w in vocabulary else math.log(1 + n) + 1)
            for w, k in Counter(words(text)).items()
        }

    def cosine(a, b):
        length = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
        return sum(x * b.get(w, 0) for w, x in a.items()) / length if length else 0

    templates = [(name, vector(text)) for name, text in licenses.TEMPLATES]

    def best(text):
        v = vector(text)
        score, _, name = max((round(cosine(v, t), 6), -i, name) for i, (name, t) in enumerate(templates))
        return score, name

    out, given = {}, {}
    for i, p, t in rows:
        header = max(((s, -k, name) for k, line in enumerate(t.split("\n")) for s, name in [best(line)]))
        whole = best(t)
        out[i] = [header[2] if header[0] >= licenses.HEADER else None, None]
        named = re.search(licenses.FILE_NAMES, p)
        if whole[0] < licenses.FILE and not (named and whole[0] >= licenses.NAMED):
            says = named and words(t)
            whole = (header[0], header[2]) if named and out[i][0] else (0.0, "unknown") if says else None
        if whole:
            folder = p.rpartition("/")[0]
            given[folder] = min(given.get(folder, (1, "", "")), (-whole[0], p, whole[1]))
            out[i][1] = whole[1]
    found = {}
    for i, p, _ in rows:
        folder, header, whole = p.rpartition("/")[0], *out[i]
        parts = folder.split("/")
        up = ["/".join(parts[:k]) for k in range(len(parts), -1, -1)]
        near = next((given[f][2] for f in up if f in given), None)
        how = "header" if header else "file" if whole else "inherited" if near else "none"
        found[i] = (header or whole or near, how)
    return found


TREE = [
    (1, "a/LICENSE", f"{MIT}\nCopyright some people."),
    (2, "a/x.py", "code of some kind"),
    (3, "a/b/y.py", "more code"),
    (4, "a/b/c/z.py", f"# {APACHE}\ncode"),
    (5, "d/e.py", "nothing at all"),
    (6, "a/b/f/COPYING.txt", "This program is free software: you can redistribute it and modify it under the terms of the GNU General Public License"),
    (7, "a/b/f/g/h.py", "inherits from f"),
    (8, "ab/i.py", "not below a"),
    (9, "a/b/c/k.py", "This text talks of a license and of permission to leave, and no more of it."),
    (10, "j.py", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
]


def test_tree(spark, staging):
    got = {r.doc_id: (r.license, r.how) for r in scan(spark, staging, TREE).collect()}
    assert got == brute(TREE)
    assert got[2] == got[3] == ("MIT", "inherited")
    assert got[4] == ("Apache-2.0", "header")
    assert got[7] == ("GPL-3.0", "inherited")
    assert got[5] == got[8] or got[8][1] == "inherited"  # the root's licence, if it has one


def test_query_matches_brute_force(spark):
    rows = [
        (r.doc_id, f"{r.source}/{'/'.join(str(r.doc_id // 10))}/{r.doc_id}.txt", r.text)
        for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    ]
    got = QUERIES["op7_licenses"](spark, SMALL).collect()
    assert {r.doc_id: r.path for r in got} == {i: p for i, p, _ in rows}
    assert {r.doc_id: (r.license, r.how) for r in got} == brute(rows)


def test_odd_rows(spark, staging):
    rows = [
        (1, None, None), (1, None, None), (None, "a/b", ""), (2, "a/c/LICENSE", None), (3, "/", " \n"),
        (4, "a/c/d", LONG), (5, "a/c/e", APACHE), (5, "a/c/e", APACHE), (6, "a/c/e/f/", "x"),
        (7, "q/w", f"{LONG}\n{MIT}\n{LONG}"), (8, "t/1", f"{MIT}\n{MIT}"), (9, "t/2", MIT), (10, "t/3", "w"),
    ]
    got = scan(spark, staging, rows).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _, _ in rows)
    by = {r.doc_id: (r.license, r.how) for r in got}
    assert by[5] == ("Apache-2.0", "header") and by[6][1] == "inherited" and by[4][1] == "inherited"
    assert by[7] == by[8] == ("MIT", "header") and by[10] == ("MIT", "inherited")
    assert by[1] == by[2] == by[3] == (None, "none") or by[2][1] == "inherited"
    assert scan(spark, staging, []).count() == 0


def test_plan_is_native(spark):
    plan = QUERIES["op7_licenses"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapIn" not in plan and "CartesianProduct" not in plan


def test_a_licence_file_of_another_kind_is_unknown_and_stops_inheritance(spark, staging):
    rows = [
        (1, "LICENSE", MIT), (2, "x.py", "code"), (3, "own/LICENSE", "Copyright Acme Corp. All rights reserved. "
         "No part of this software may be copied, and the source is not to be distributed without our consent."),
        (4, "own/y.py", "code"), (5, "own/deep/z.py", "code"), (6, "blank/COPYING", " \n"), (7, "blank/w.py", "code"),
        (8, "long/LICENSE", "\n".join([MIT] + [f"words of clause {i} about other things" for i in range(60)])),
        (9, "long/v.py", "code"),
    ]
    got = {r.doc_id: (r.license, r.how) for r in scan(spark, staging, rows).collect()}
    assert got == brute(rows)
    assert got[3] == ("unknown", "file") and got[4] == got[5] == ("unknown", "inherited")
    assert got[2] == got[7] == ("MIT", "inherited")  # a blank file says nothing
    assert got[9] == ("MIT", "inherited")
