import random
import re

from llm_rows import *  # noqa: F403

from gateflow.llm import license_scan, queries

FIXED = [("mit", "under the mit license".split()), ("apache-2", "apache license version 2".split()), ("cc-by-nc", "cc by nc".split())]


def brute(t):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
    at = [(i, name) for name, p in FIXED for i in range(len(w)) if w[i:i + len(p)] == p]
    starts = [i for i, _ in at]
    return (len(w), len(at), min(starts, default=None), max(starts, default=None), sorted({name for _, name in at}))


def base(e):
    return (e["n_words"], e["n_base"], e["first_word"], e["last_word"], e["base_labels"])


def test_base_equals_brute_force():
    found = license_scan.Automaton()
    r = random.Random(1)
    some = "under the mit license apache version 2 cc by nc 0 licensed Released x gnu general public Case É".split()
    for _ in range(4000):
        t = r.choice([" ", "-", ". ", "\n"]).join(r.choice(some) for _ in range(r.randrange(40)))
        if r.random() < 0.5:
            t += " " + r.choice(license_scan.TEMPLATES)[1] + " " + t
        e = license_scan.examine(t, found)
        assert base(e) == brute(t), t
        assert 0 <= e["score"] <= 1 and set(e["base_labels"]) <= set(e["labels"])


def test_matching_statistics_equal_brute_force():
    found = license_scan.Automaton([("a", "p q r s p q t"), ("b", "q r s u")], [])
    all_runs = {tuple(ws[i:j]) for _, ws in found.templates for i in range(len(ws)) for j in range(i + 1, len(ws) + 1)}
    r = random.Random(2)
    for _ in range(500):
        w = [r.choice("pqrstux") for _ in range(r.randrange(30))]
        best = [max((n for n in range(i + 2) if tuple(w[i + 1 - n:i + 1]) in all_runs), default=0) for i in range(len(w))]
        want = [(i + 1 - n, n) for i, n in enumerate(best)
                if n >= license_scan.LEAST_RUN and (i + 1 == len(w) or best[i + 1] != n + 1)]
        assert [x[:2] for x in found.stream(w)[1]] == want


def test_templates_are_found_with_changes():
    found = license_scan.Automaton()
    for label, t in license_scan.TEMPLATES:
        e = license_scan.examine(f"foo bar {t} baz", found)
        # A phrase of the base may stand in a template of another label ("cc by nc sa").
        assert {label} <= set(e["labels"]) <= {label, *e["base_labels"]}, t
        assert e["score"] == 1.0 and e["spans"][0]["start"] == 2
    body = license_scan.TEMPLATES[1][1].split()
    body[10:11] = ["changed", "words"]
    del body[40]
    e = license_scan.examine(" ".join(body), found)
    assert e["labels"] == ["mit"] and 0.85 < e["score"] < 1


def test_query_equals_brute_force(spark):
    rows = queries.op10_license_scan(spark, "/root/testdata/sf0.001").join(
        spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), "doc_id").collect()
    assert len(rows) == 200
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (
            *brute(r.text)[:4], ",".join(brute(r.text)[4]))


def test_odd_rows(docs):
    texts = [*ODD, "Released under the MIT License. " * 5000]
    rows = license_scan.scan(docs([*texts, *texts], [*range(len(texts)), *[None] * len(texts)])).collect()
    assert len(rows) == 2 * len(texts)
    for r in rows:
        if r.doc_id is not None:
            assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(texts[r.doc_id])
    assert license_scan.digests(license_scan.scan(docs([]))).count() == 0


def test_neighbours_are_told_apart():
    found = license_scan.Automaton()

    def labels(t):
        return license_scan.examine(t, found)["labels"]

    assert labels("The film was released under the title X") == labels("Released under the GPL") == []
    work = "This work is licensed under "
    assert labels(work + "the GNU General Public License, version 2.") == ["gpl-2"]
    assert labels(work + "the GNU General Public License, version 3.") == ["gpl-3"]
    assert labels(work + "a Creative Commons Attribution-ShareAlike 4.0 International License.") == ["cc-by-sa"]
    header = """This program is free software; you can redistribute it and/or modify it under the terms of the GNU {}
    General Public License as published by the Free Software Foundation; either version {} of the License, or (at your
    option) any later version."""
    for name, version, label in (("", 2, "gpl-2"), ("", 3, "gpl-3"), ("Lesser", 2.1, "lgpl-2.1"), ("Affero", 3, "agpl-3")):
        assert labels(header.format(name, version)) == [label]


def test_tags_titles_and_whole_texts():
    found = license_scan.Automaton()

    def labels(t):
        return license_scan.examine(t, found)["labels"]

    assert labels("// SPDX-License-Identifier: Apache-2.0 some code") == ["apache-2"]
    assert labels("# SPDX-License-Identifier: LGPL-2.1-or-later\n") == ["lgpl-2.1"]
    assert labels("Licensed under the GPL-3.0-or-later") == ["gpl-3"]
    assert labels("SPDX-License-Identifier: GPL-4.0-only") == labels("Licensed under the terms of the agreement") == []
    assert labels("Licensed under CC BY-NC-SA 4.0.") == ["cc-by-nc", "cc-by-nc-sa"]
    assert labels("GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n Copyright") == ["gpl-3"]
    assert labels("MIT License\n\nCopyright (c) 2020 Someone") == ["mit"]
    text = {label: t for label, t in license_scan.TEMPLATES if label in ("bsd-2", "bsd-3", "isc") and len(t) > 300}
    for label, t in text.items():
        assert labels(f"Copyright 2020, Someone. All rights reserved. {t}") == [label]
        changed = t.replace("COPYRIGHT HOLDER", "AUTHOR").replace("following conditions", "conditions below")
        assert labels(changed) == [label]
    # The head alone does not say which of the two it is.
    assert labels(text["bsd-2"].split("1.")[0]) == ["bsd"]
