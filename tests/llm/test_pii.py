"""Personal data against the contract's patterns, tried as they are written."""

import hashlib
import math
import random
import re

import pytest

from slotflow.llm import pii

PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def plain(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")), "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), k, m.end(), kind))
    return [(kind, s, e) for s, _, e, kind in sorted(out)]


def written(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def test_patterns_on_random_texts():
    rng = random.Random(2)
    for _ in range(4000):
        text = "".join(rng.choice("ab@@..-_+ 0123456789()é🙂\n") for _ in range(rng.randint(0, 60)))
        assert [(pii.KINDS[k], s, e) for s, k, e in pii.find(text)] == plain(text), text
    cards = ["4111 1111 1111 1111", "4111-1111-1111-1111x", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.002.3.255", "+1 (555) 010-2030", "a@b.c_d@e.f", "a@b@c.d", "x" * 5000 + "@", "1" * 4000 + ".1.1.1"]
    for text in cards:
        assert [(pii.KINDS[k], s, e) for s, k, e in pii.find(text)] == plain(text), text


def documents(spark):
    rows = []
    for i in range(60):  # "dial" occurs with phones only; "the" everywhere
        rows.append((i, f"the dial +1 555 010 {2000 + i} the end", "x"))
    for i in range(60, 400):
        rows.append((i, f"the word{i} the end", "x"))
    rows += [(1000, None, None), (1001, "", ""), (1002, "mail the a@b.co 1.2.3.4", "y"), (1002, "mail the a@b.co 1.2.3.4", "y"), (None, "the dial +1 555 010 9999 the end", "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, key string")


def test_report_and_disclosing_terms(spark):
    df = documents(spark)
    rows = pii.report(df).collect()
    assert len(rows) == df.count()
    texts = {r.doc_id: r.text for r in df.collect()}
    for r in rows:
        base = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(written(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for x, _, _ in base) for k in pii.KINDS]
        added = [s for s in r.spans.split(",") if s and s not in written(base).split(",")]
        # "dial" is always told by a phone number; "the" is not, nor is "end"
        assert added == (["cut-phone:4:8"] if texts[r.doc_id] and "dial" in texts[r.doc_id] else [])


def test_disclosure_values(spark):
    df = documents(spark)
    told = {(r.kind, r.term): r for r in pii.disclosing_terms(df, pii.scan(df)).collect()}
    n, n_c = df.count(), 61
    assert list(told) == [("phone", "dial")] and abs(told[("phone", "dial")].disclosure - disclosure(61, 61, n_c, n)) < 1e-12
    assert told[("phone", "dial")].action == "removed"


def disclosure(n_tc, n_t, n_c, n, z=1.96):
    m, k = n_t - 1, n_tc - 1
    p = k / m
    low = (p + z * z / (2 * m) - z * math.sqrt(p * (1 - p) / m + z * z / (4 * m * m))) / (1 + z * z / m)
    return math.log2(low * n / n_c) / math.log2(n / n_c)


@pytest.mark.parametrize("scale", [1, 20])
def test_a_small_table_is_judged_like_a_large_one(spark, scale):
    """60 documents, a phone in ten of them, always with one name: the name goes. A name that is in
    one document only stays, and so does a word that half of its documents have without a phone."""
    rows = [(i, f"ask martha at +1 555 010 {2000 + i % 900} about plan{i}{' soon' if i % 2 else ''}") for i in range(10 * scale)]
    rows += [(i, f"the plan{i} is out{' soon' if i % 10 == 0 else ''}") for i in range(10 * scale, 60 * scale)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert not [t for t in got.values() if "martha" in t]
    assert all(f"plan{i}" in got[i] for i in range(60 * scale)) and sum("soon" in t for t in got.values()) == 10 * scale
    told = {r.term: r.disclosure for r in pii.disclosing_terms(df).collect()}
    assert abs(told["martha"] - disclosure(10 * scale, 10 * scale, 10 * scale, 60 * scale)) < 1e-12


def test_rare_kinds_need_two_documents(spark):
    rows = [(0, "call jane or rex +1 555 010 2000"), (1, "jane says +1 555 010 2001")] + [(i, "nothing to call or says here") for i in range(2, 9000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.term for r in pii.disclosing_terms(df).collect()} == {"jane"}


def test_sanitise(spark):
    df = documents(spark)
    got = {(r.doc_id, r.key): r.text for r in pii.sanitise(df).collect()}
    assert got[(5, "x")] == "the  [PHONE] the end" and got[(None, "z")] == "the  [PHONE] the end"
    assert got[(1002, "y")] == "mail the [EMAIL] [IP]" and got[(1000, None)] is None and got[(1001, "")] == ""
    assert pii.sanitise(df).columns == df.columns and pii.sanitise(df).count() == df.count()
    assert pii.sanitise(df.limit(0)).collect() == [] and pii.report(df.limit(0)).collect() == []


def test_overlapping_spans():
    spans = [{"kind": "ip", "start": 2, "end": 6}, {"kind": "card", "start": 2, "end": 9}, {"kind": "phone", "start": 8, "end": 12}]
    assert pii.clean_text("ab1234567890cd", spans) == "ab[CARD]cd"


def far(spark):
    """"badge" stands seven words from the phone, in documents where the pattern misses the number,
    and beside an e-mail; "ward" is never within three words of an entity."""
    rows = [(i, f"badge one two three four five six +1 555 010 {2000 + i} one two three four ward") for i in range(60)]
    rows += [(i, "Badge, call five five five; ward") for i in range(60, 70)] + [(70, "write badge a@b.co now")]
    rows += [(i, "one two three four five six call now write") for i in range(71, 2000)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_terms_go_at_all_their_places(spark):
    df = far(spark)
    told = {(r.kind, r.term): r for r in pii.disclosing_terms(df, pii.scan(df)).collect()}
    assert set(told) == {("phone", "badge"), ("phone", "ward")}
    want = disclosure(60, 71, 60, 2000)
    assert abs(told["phone", "badge"].disclosure - want) < 1e-12
    got = {r.doc_id: r.text for r in pii.sanitise(df.repartition(3)).collect()}
    assert len(got) == 2000 and not [t for t in got.values() if "badge" in t.lower() or "ward" in t]
    assert got[0] == "[PHONE] one two three four five six [PHONE] one two three four [PHONE]" and got[65] == "[PHONE], call five five five; [PHONE]"
    assert got[70] == "write [PHONE] [EMAIL] now" and got[100] == "one two three four five six call now write"


def test_terms_inside_entities_neither_count_nor_go(spark):
    rows = [(i, f"word{i} {i}@desk.example.com") for i in range(60)] + [(60, "the desk example")] + [(i, "the rest") for i in range(61, 400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert pii.disclosing_terms(df).collect() == []
    assert {r.doc_id: r.text for r in pii.sanitise(df).collect()}[60] == "the desk example"


def test_terms_joined_without_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(i, f"one{i % 30} x y z u v w a{i}@b.co") for i in range(900)] + [(i, f"x y z u v w end{i} one{i % 30}") for i in range(900, 940)] + [(i, "x y z u v w") for i in range(940, 30000)]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        told = {r.term for r in pii.disclosing_terms(df).collect()}
        assert told == {f"one{k}" for k in range(30)}
        assert not [r for r in pii.sanitise(df).collect() if "one" in r.text]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
