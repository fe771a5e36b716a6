"""License scan with ordered signature rules, in DataFrame functions only.

Text is reduced to words (A-Z lower-cased; ASCII other than digits and letters separates), each
after one space. A rule is a regular expression over that form with a label, a keyword and a
priority. Rules are the families of ``FAMILIES`` in the wordings of ``WORDINGS``, the identifiers
and short forms of ``SHORT`` in those wordings that speak of licensing (alone they are common
words) or beside one another ("MIT OR Apache-2.0"), and ``BODIES``, the licences' own words:
several hundred. A document is looked at if it holds any keyword, and a rule runs if its own is there.
A detection is an interval of words; one that lies inside another of the same or a higher
priority is suppressed (a title inside a notice, a short name inside a long one). What is left
gives the labels and, as the score, the weight of the strongest wording (0 if nothing is left).

Null text has no words. Repeated rows each get their result. Detections are placed by running
sums over their document's few rows, not by nested scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from slotflow.llm.common import stage

# Fixed values of the result's contract: phrase and label.
BASE = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]

#: label, keyword, expression for the name; the keyword is a whole word of all that it matches
FAMILIES = [
    ("apache-2.0", "apache", "apache (?:software )?licen[cs]e (?:version |v ?)?2(?: 0)?"),
    ("apache-1.1", "apache", "apache (?:software )?licen[cs]e (?:version |v ?)?1 1"),
    ("apache", "apache", "apache(?: software)? licen[cs]e"),
    ("agpl-3.0", "affero", "(?:gnu )?affero general public licen[cs]e(?: (?:version |v ?)?3(?: 0)?)?"),
    ("lgpl-2.1", "lesser", "(?:gnu )?lesser general public licen[cs]e (?:version |v ?)?2 1"),
    ("lgpl-3.0", "lesser", "(?:gnu )?lesser general public licen[cs]e (?:version |v ?)?3(?: 0)?"),
    ("lgpl", "lesser", "(?:gnu )?lesser general public licen[cs]e"),
    ("gpl-2.0", "gnu", "gnu (?:general public licen[cs]e|gpl) (?:version |v ?)?2(?: 0)?"),
    ("gpl-3.0", "gnu", "gnu (?:general public licen[cs]e|gpl) (?:version |v ?)?3(?: 0)?"),
    ("gpl", "gnu", "gnu (?:general public licen[cs]e|gpl)"),
    ("agpl-3.0", "agplv3", "(?:gnu )?agplv3(?: 0)?"),
    ("agpl-3.0", "agpl", "(?:gnu )?agpl (?:version |v ?)3(?: 0)?"),
    ("lgpl-2.1", "lgplv2", "(?:gnu )?lgplv2 1"),
    ("lgpl-2.1", "lgpl", "(?:gnu )?lgpl (?:version |v ?)2 1"),
    ("lgpl-3.0", "lgplv3", "(?:gnu )?lgplv3(?: 0)?"),
    ("lgpl-3.0", "lgpl", "(?:gnu )?lgpl (?:version |v ?)3(?: 0)?"),
    ("lgpl", "lgpl", "gnu lgpl"),
    ("gpl-2.0", "gplv2", "(?:gnu )?gplv2(?: 0)?"),
    ("gpl-2.0", "gpl", "gpl (?:version |v ?)2(?: 0)?"),
    ("gpl-3.0", "gplv3", "(?:gnu )?gplv3(?: 0)?"),
    ("gpl-3.0", "gpl", "gpl (?:version |v ?)3(?: 0)?"),
    ("gfdl", "gnu", "gnu free documentation licen[cs]e"),
    ("mit", "mit", "mit licen[cs]e"),
    ("x11", "x11", "x11 licen[cs]e"),
    ("isc", "isc", "isc licen[cs]e"),
    ("bsd-2-clause", "bsd", "(?:simplified bsd|bsd 2 clause|2 clause bsd)(?: licen[cs]e)?"),
    ("bsd-2-clause", "freebsd", "freebsd(?: licen[cs]e)?"),
    ("bsd-3-clause", "bsd", "(?:new bsd|modified bsd|bsd 3 clause|3 clause bsd)(?: licen[cs]e)?"),
    ("bsd", "bsd", "bsd(?: style)? licen[cs]e"),
    ("mpl-2.0", "mozilla", "mozilla public licen[cs]e (?:version |v ?)?2(?: 0)?"),
    ("mpl-1.1", "mozilla", "mozilla public licen[cs]e (?:version |v ?)?1 1"),
    ("mpl", "mozilla", "mozilla public licen[cs]e"),
    ("epl-2.0", "eclipse", "eclipse public licen[cs]e(?: (?:version |v ?)?2(?: 0)?)?"),
    ("cddl-1.0", "development", "common development and distribution licen[cs]e"),
    ("cc-by-nc-sa", "cc", "cc by nc sa(?: [1-4] 0)?"),
    ("cc-by-nc-nd", "cc", "cc by nc nd(?: [1-4] 0)?"),
    ("cc-by-nc", "cc", "cc by nc(?: [1-4] 0)?"),
    ("cc-by-sa", "cc", "cc by sa(?: [1-4] 0)?"),
    ("cc-by-nd", "cc", "cc by nd(?: [1-4] 0)?"),
    ("cc-by", "cc", "cc by(?: [1-4] 0)?"),
    ("cc0", "cc0", "cc0(?: 1 0)?(?: universal)?"),
    ("cc-by-sa", "commons", "creative commons attribution share ?alike(?: [1-4] 0)?"),
    ("cc-by-nc", "commons", "creative commons attribution non ?commercial(?: [1-4] 0)?"),
    ("cc-by", "commons", "creative commons attribution(?: [1-4] 0)?"),
    ("unlicense", "unlicense", "(?:the )?unlicense"),
    ("zlib", "zlib", "zlib licen[cs]e"),
    ("boost-1.0", "boost", "boost software licen[cs]e"),
    ("artistic-2.0", "artistic", "artistic licen[cs]e(?: 2(?: 0)?)?"),
    ("psf-2.0", "python", "python software foundation licen[cs]e"),
    ("ofl-1.1", "font", "(?:sil )?open font licen[cs]e"),
    ("odbl", "database", "open database licen[cs]e"),
    ("eupl", "european", "european union public licen[cs]e"),
    ("postgresql", "postgresql", "postgresql licen[cs]e"),
    ("wtfpl", "wtfpl", "wtfpl"),
]
#: priority (the larger suppresses what it contains), weight, wording
WORDINGS = [
    (3, 1.0, "spdx licen[cs]e identifier {name}"),
    (3, 1.0, "(?:this|the) (?:work|file|software|program|project|document) is licen[cs]ed under (?:the )?(?:terms of (?:the )?)?{name}"),
    (2, 0.9, "(?:dual |re)?licen[cs]ed (?:to you )?under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?{name}"),
    (2, 0.9, "(?:released|distributed|published|available|redistribute it) under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?{name}"),
    (2, 0.8, "(?:subject to|governed by|covered by|use of) (?:the )?(?:terms of (?:the )?)?{name}"),
    (2, 0.7, "(?:copy of|see|read) (?:the )?{name}"),
    (1, 0.6, "{name} (?:or later|or newer|only|compatible)"),
    (0, 0.5, "{name}"),
]
#: as FAMILIES; identifiers and short forms
SHORT = [
    ("apache-2.0", "apache", "apache (?:version |v ?)?2(?: 0|(?! [0-9]))"),
    ("apache-1.1", "apache", "apache (?:version |v ?)?1 1"),
    ("agpl-3.0", "agpl", "agpl(?: 3(?: 0)?)?"),
    ("lgpl-2.1", "lgpl", "lgpl 2 1"),
    ("lgpl-3.0", "lgpl", "lgpl 3(?: 0)?"),
    ("lgpl", "lgpl", "lgpl"),
    ("gpl-2.0", "gpl", "gpl 2(?: 0)?"),
    ("gpl-3.0", "gpl", "gpl 3(?: 0)?"),
    ("gpl", "gpl", "gpl"),
    ("gfdl", "gfdl", "(?:gnu )?gfdl(?: 1 [1-3])?"),
    ("mit", "mit", "mit"),
    ("x11", "x11", "x11"),
    ("isc", "isc", "isc"),
    ("mpl-2.0", "mpl", "mpl (?:version |v ?)?2(?: 0)?"),
    ("mpl-2.0", "mplv2", "mplv2(?: 0)?"),
    ("mpl-1.1", "mpl", "mpl (?:version |v ?)?1 1"),
    ("mpl", "mpl", "mpl"),
    ("epl-2.0", "epl", "epl (?:version |v ?)?2(?: 0)?"),
    ("cddl-1.0", "cddl", "cddl(?: 1 0)?"),
    ("zlib", "zlib", "zlib"),
    ("boost-1.0", "bsl", "bsl 1 0"),
    ("artistic-2.0", "artistic", "artistic 2(?: 0)?"),
    ("psf-2.0", "psf", "psf(?: 2 0)?"),
    ("psf-2.0", "python", "python 2 0"),
    ("ofl-1.1", "ofl", "(?:sil )?ofl(?: 1 1)?"),
    ("odbl", "odbl", "odbl(?: 1 0)?"),
    ("eupl", "eupl", "eupl(?: 1 [0-2])?"),
    ("postgresql", "postgresql", "postgresql"),
]
# SPDX expressions: an identifier joined to another; overlaps what names the first, so both stay
_ID = "|".join([name for _, _, name in SHORT] + ["bsd [23] clause", "cc0 1 0", "unlicense", "only", "or later"])
JOINED = (2, 0.9, f"(?:{_ID}) (?:or|and) {{name}}")
SHORT_WORDINGS = [*WORDINGS[:4], JOINED]
_BSD = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"
)
_BSD_CONDITIONS = (
    _BSD + " (?:[0-9a-z] )?redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"
    " (?:and )?(?:[0-9a-z] )?redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"
    " in the documentation and or other materials provided with the distribution"
)
_AS_PUBLISHED = "general public licen[cs]e as published by the free software foundation (?:either )?version"
#: label, keyword, words of the licence or of its notice; those without any contain their name
BODIES = [
    ("mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("x11", "consortium", "except as contained in this notice the name of the x consortium shall not be used in advertising"),
    ("isc", "hereby", "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd-2-clause", "redistribution", _BSD_CONDITIONS + " this software is provided by"),
    ("bsd-3-clause", "redistribution", _BSD_CONDITIONS + " (?:[0-9a-z] )?neither the name of (?:[^ ]+ ){1,16}?may be used to endorse or promote products derived from this software"),
    ("bsd", "redistribution", _BSD),
    ("zlib", "altered", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("boost-1.0", "hereby", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("postgresql", "hereby", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("cc0", "deed", "the person who associated a work with this deed has dedicated the work to the public domain"),
    ("wtfpl", "fuck", "do what the fuck you want to public licen[cs]e"),
    ("agpl-3.0", "affero", f"gnu affero {_AS_PUBLISHED} 3"),
    ("lgpl-2.1", "lesser", f"gnu lesser {_AS_PUBLISHED} 2 1"),
    ("lgpl-3.0", "lesser", f"gnu lesser {_AS_PUBLISHED} 3"),
    ("gpl-2.0", "gnu", f"gnu {_AS_PUBLISHED} 2"),
    ("gpl-3.0", "gnu", f"gnu {_AS_PUBLISHED} 3"),
]
RULES = [
    (label, keyword, priority, weight, " " + wording.format(name=f"(?:{name})") + "(?= )")
    for families, wordings in ((FAMILIES, [*WORDINGS, JOINED]), (SHORT, SHORT_WORDINGS), (BODIES, [(3, 1.0, "{name}")]))
    for label, keyword, name in families
    for priority, weight, wording in wordings
]
PRIORITIES = sorted({p for p, _, _ in WORDINGS})


def _words_in(x) -> Column:
    """Words of a part of the normal form: its spaces."""
    return (F.length(x) - F.length(F.translate(x, " ", ""))).cast("long")


def normal_form(docs: DataFrame) -> DataFrame:
    """(row_id, doc_id, form): each word after one space, and a space at the end."""
    lower = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.btrim(F.regexp_replace(lower, "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", " "))
    rows = docs.select("doc_id", words.alias("words"))
    form = F.when(F.col("words") == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), F.col("words"), F.lit(" ")))
    return rows.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", form.alias("form"))


def _scan(docs: DataFrame) -> DataFrame:
    keywords = sorted({k for _, k, _, _, _ in RULES} | {p.split()[0] for p, _ in BASE})
    rows = normal_form(docs).withColumn("gate", F.col("form").rlike(" (?:" + "|".join(keywords) + ")(?= )"))
    by_keyword = {k: [(n, r[4]) for n, r in enumerate(RULES) if r[1] == k] for k in sorted({r[1] for r in RULES})}
    groups = F.array(*[
        F.struct(F.lit(f" {k} ").alias("keyword"), F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(p).alias("pattern")) for n, p in rules]).alias("rules"))
        for k, rules in by_keyword.items()
    ])
    places = lambda r: F.zip_with(
        F.split("form", r.pattern, -1), F.regexp_extract_all("form", r.pattern, F.lit(0)),
        lambda gap, hit: F.struct(_words_in(gap).alias("gap"), _words_in(hit).alias("n")),
    )
    rules = F.flatten(F.transform(F.filter(groups, lambda g: F.contains("form", g.keyword)), lambda g: g.rules))
    gated = F.transform(rules, lambda r: F.struct(r.rule.alias("rule"), places(r).alias("places")))
    hits = F.filter(gated, lambda x: F.size(x.places) > 1)
    out = rows.withColumn("hits", F.when(F.col("gate"), hits))
    for phrase, label in BASE:
        out = out.withColumn(f"p_{label}", F.when(F.col("gate"), F.split("form", f" {phrase}(?= )", -1)))
    n_words = _words_in("form") - 1
    count = [F.coalesce(F.size(f"p_{label}") - 1, F.lit(0)) for _, label in BASE]
    first = [F.when(n > 0, _words_in(F.get(f"p_{label}", 0))) for n, (_, label) in zip(count, BASE)]
    last = [F.when(n > 0, n_words - (_words_in(F.get(f"p_{label}", n)) - 1) - len(phrase.split())) for n, (phrase, label) in zip(count, BASE)]
    found = F.array_compact(F.array(*[F.when(n > 0, F.lit(label)) for n, (_, label) in zip(count, BASE)]))
    total = count[0] + count[1] + count[2] + count[3]
    return out.select(
        "row_id", "doc_id", n_words.alias("n_words"), total.cast("long").alias("n_base"),
        F.least(*first).alias("first_word"), F.greatest(*last).alias("last_word"), F.sort_array(found).alias("base"), "hits",
    )


def detections(scanned: DataFrame) -> DataFrame:
    """(row_id, rule, label, start, end, weight) that no other detection suppresses, in words."""
    rule = F.col("rule")
    about = F.array(*[F.struct(F.lit(r[0]).alias("label"), F.lit(r[2]).alias("priority"), F.lit(r[3]).alias("weight")) for r in RULES])
    rows = scanned.where(F.size("hits") > 0).select("row_id", F.explode("hits").alias("h"))
    rows = rows.select("row_id", F.col("h.rule").alias("rule"), F.posexplode("h.places").alias("k", "place"))
    before = Window.partitionBy("row_id", "rule").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    skipped = F.coalesce(F.sum(F.col("place.gap") + F.col("place.n")).over(before), F.lit(0))
    rows = rows.withColumn("start", skipped + F.col("place.gap")).where("place.n IS NOT NULL")
    rows = rows.select("row_id", "rule", F.get(about, rule).alias("a"), "start", (F.col("start") + F.col("place.n")).alias("end"))
    rows = rows.select("row_id", "rule", "a.*", "start", "end")
    order = Window.partitionBy("row_id").orderBy("start", F.desc("end"), F.desc("priority"), "rule").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.lit(False)
    for p in PRIORITIES:
        reach = F.max(F.when(F.col("priority") >= p, F.col("end"))).over(order)
        inside = inside | ((F.col("priority") == p) & F.coalesce(reach >= F.col("end"), F.lit(False)))
    return rows.withColumn("inside", inside).where(~F.col("inside")).drop("inside", "priority")


def scan(docs: DataFrame) -> DataFrame:
    """The contract's columns for every row, and ``spans`` (label:start:end, comma-joined)."""
    scanned = stage(_scan(docs), "licenses")
    kept = detections(scanned).groupBy("row_id").agg(
        F.collect_set("label").alias("own"), F.max("weight").alias("score"),
        F.sort_array(F.collect_list(F.struct("start", "end", "label"))).alias("spans"),
    )
    joined = scanned.join(kept, "row_id", "left")
    labels = F.sort_array(F.array_union("base", F.coalesce("own", F.array().cast("array<string>"))))
    spans = F.transform("spans", lambda s: F.concat_ws(":", s.label, s.start.cast("string"), s.end.cast("string")))
    score = F.coalesce("score", F.when(F.col("n_base") > 0, F.lit(0.5)).otherwise(F.lit(0.0)))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"), score.alias("score"), F.coalesce(F.array_join(spans, ","), F.lit("")).alias("spans"),
    )
