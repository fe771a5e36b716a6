"""License scan against plain Python counts, and detections against nested search."""

import random
import re
from re import _parser

from slotflow.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"gpl": "gnu general public license", "apache": "apache license", "cc-by": "cc by", "mit": "mit license"}


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(text):
    words, places = words_of(text), []
    for label, phrase in PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    at = [i for i, _ in places]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def detected(text):
    """Rules as interval tests on the joined words, with pairwise containment."""
    form = "".join(f" {w}" for w in words_of(text)) + " "
    found = []
    for k, (label, keyword, priority, weight, pattern) in enumerate(licenses.RULES):
        if f" {keyword} " in form:
            for m in re.finditer(pattern, form):
                start = form[: m.start()].count(" ")
                found.append((start, start + m.group().count(" "), priority, k, label, weight))
    kept = []
    for a in found:
        inside = [b for b in found if b is not a and b[2] >= a[2] and b[0] <= a[0] and a[1] <= b[1]]
        same = [b for b in inside if b[:2] == a[:2] and (b[2], -b[3]) < (a[2], -a[3])]
        if len(inside) == len(same):
            kept.append(a)
    return sorted({(s, e, label) for s, e, _, _, label, _ in kept}), {x[4] for x in kept}, max((x[5] for x in kept), default=0.0)


def rows():
    rng = random.Random(3)
    bits = ["Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3.", "MIT License", "mit license mit license", "CC BY-NC 4.0", "cc by", "CC BY", "gnu general public license",
            "GNU Lesser General Public License v2.1 or later", "see the Mozilla Public License", "spdx-license-identifier: MIT", "no license here", "é🙂", "All rights reserved.", "apache licence", "Released under the terms of the BSD 3-Clause License", "word", "\n", "MITLICENSE", "mit\x00license", "Creative Commons Attribution-ShareAlike 4.0"]
    out = [None, "", " .. ", "cc", "by cc", "mit license", "x mit license", "mit license x"]
    return out + [rng.choice([" ", ". ", ""]).join(rng.choices(bits, k=rng.randint(1, 12))) for _ in range(150)]


def test_base_and_detections(spark):
    texts = rows()
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, "mit license", "y"), (3, "cc", "z")], "doc_id long, text string, form string").repartition(3)
    got = licenses.scan(df).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        text = "mit license" if r.doc_id is None else texts[r.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(text), text
        spans, labels, score = detected(text)
        base = {x for x in r.base_labels.split(",") if x}
        assert r.labels == ",".join(sorted(base | labels)), text
        assert r.spans.split(",") == [f"{label}:{s}:{e}" for s, e, label in spans] or (not spans and r.spans == ""), text
        assert r.score == (score or (0.5 if base else 0.0)), text
    assert licenses.scan(df.limit(0)).collect() == []


def test_number_of_rules():
    assert len(licenses.RULES) > 300 and all(re.compile(r[4]) for r in licenses.RULES)


def test_many_detections_in_one_text(spark):
    text = "x mit license " * 3000
    row = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.n_base, row.first_word, row.last_word, len(row.spans.split(","))) == (3000, 1, 8998, 3000)


MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal"
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
 documentation and/or other materials provided with the distribution.
 """
AS_IS = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS"
NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software"
SPDX = {
    "MIT": "mit", "Apache-2.0": "apache-2.0", "Apache-1.1": "apache-1.1", "GPL-2.0-only": "gpl-2.0", "GPL-3.0-or-later": "gpl-3.0", "LGPL-2.1-only": "lgpl-2.1",
    "LGPL-3.0": "lgpl-3.0", "AGPL-3.0-only": "agpl-3.0", "MPL-2.0": "mpl-2.0", "MPL-1.1": "mpl-1.1", "EPL-2.0": "epl-2.0", "ISC": "isc", "Zlib": "zlib", "X11": "x11",
    "OFL-1.1": "ofl-1.1", "BSD-2-Clause": "bsd-2-clause", "BSD-3-Clause": "bsd-3-clause", "CC-BY-SA-4.0": "cc-by,cc-by-sa", "CC0-1.0": "cc0", "Unlicense": "unlicense", "WTFPL": "wtfpl",
    "BSL-1.0": "boost-1.0", "Artistic-2.0": "artistic-2.0", "PSF-2.0": "psf-2.0", "Python-2.0": "psf-2.0", "EUPL-1.2": "eupl", "ODbL-1.0": "odbl", "CDDL-1.0": "cddl-1.0",
    "GFDL-1.3": "gfdl", "PostgreSQL": "postgresql", "MIT OR Apache-2.0": "apache-2.0,mit", "(GPL-2.0-or-later AND ISC)": "gpl-2.0,isc", "Apache-2.0 OR BSD-3-Clause": "apache-2.0,bsd-3-clause",
}
LITERAL = {
    "Licensed under GPLv3.": ("gpl-3.0", 0.9), "the GNU GPLv3": ("gpl-3.0", 0.5), "licensed under the LGPLv2.1": ("lgpl-2.1", 0.9), "released under AGPLv3": ("agpl-3.0", 0.9),
    "Licensed under MIT": ("mit", 0.9), "distributed under Apache 2.0": ("apache-2.0", 0.9), "GPL v2 or later": ("gpl-2.0", 0.6),
    MIT: ("mit", 1.0), BSD + AS_IS: ("bsd-2-clause", 1.0), BSD + NAMES + ". " + AS_IS: ("bsd-3-clause", 1.0), BSD[:160]: ("bsd", 1.0),
    "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License": ("gpl,gpl-3.0", 1.0),
    "Er kam mit dem Rad; she went to MIT and the Apache 2.4 server ran zlib on X11": ("", 0.0), "GPL": ("", 0.0),
}


def test_literal_labels(spark):
    # "cc by" is a base phrase, too
    want = {f"// SPDX-License-Identifier: {k}\nint x;": (v, 1.0) for k, v in SPDX.items()} | LITERAL
    got = licenses.scan(spark.createDataFrame(list(enumerate(want)), "doc_id long, text string")).collect()
    texts = list(want)
    assert {texts[r.doc_id]: (r.labels, r.score) for r in got} == want


def sample(tree, rng):
    """A string that a parsed expression matches."""
    out = ""
    for op, arg in tree:
        op = str(op)
        if op == "LITERAL":
            out += chr(arg)
        elif op == "NOT_LITERAL":
            out += "q"
        elif op == "IN":
            kind, value = rng.choice(arg)
            out += chr(value if str(kind) == "LITERAL" else rng.randint(*value))
        elif op == "BRANCH":
            out += sample(rng.choice(arg[1]), rng)
        elif op == "SUBPATTERN":
            out += sample(arg[-1], rng)
        elif op in ("MAX_REPEAT", "MIN_REPEAT"):
            out += "".join(sample(arg[2], rng) for _ in range(rng.randint(arg[0], min(arg[1], arg[0] + 3))))
        else:
            assert op in ("ASSERT", "ASSERT_NOT"), op
    return out


def test_keywords_are_in_all_that_their_rules_match(spark):
    rng, texts = random.Random(9), ["Released under the FreeBSD License", "FreeBSD licence", "see the FreeBSD License"]
    for label, keyword, _, _, pattern in licenses.RULES:
        tree = _parser.parse(pattern)
        found = [sample(tree, rng) for _ in range(40)]
        assert all(f" {keyword} " in f"{x} " for x in found), (label, keyword, pattern)
        texts += found[:1]
    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    labels = {r.doc_id: set(r.labels.split(",")) for r in got}
    assert [labels[k] for k in range(3)] == [{"bsd-2-clause"}] * 3
    for k, text in enumerate(texts):  # without any gate
        form = "".join(f" {w}" for w in words_of(text)) + " "
        assert (labels[k] != {""}) == any(re.search(r[4], form) for r in licenses.RULES) and labels[k] != {""}, text
