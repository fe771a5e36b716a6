"""Personal data: patterns, and terms that reveal it by their co-occurrence in the corpus.

The patterns find four kinds of entities. Every term that overlaps no entity stands clear; in
documents, over the whole corpus, n(t) hold the term t clear, n(c) an entity of kind c, n(t, c)
both, wherever they stand, and N is all. They give the share of the kind's information that the
term discloses:

    log2(p(c | t) N / n(c)) / log2(N / n(c))      (PMI(t; c) / IC(c), 1 at most)

p(c | t) is the lower end of Wilson's interval (``Z`` standard deviations) of (n(t, c) - 1) among
(n(t) - 1): a document is no evidence against itself, and few documents leave doubt. So there is
no least count, and a term is judged alike in a small and in a large table. It is generalised (to
a mark naming the kind) where its share reaches ``GENERALISE``, and removed where it reaches
``REMOVE``: at all its clear places in all documents, those without an entity too. Where the kind
is in one document of 6, that takes 10 documents that all have it, of 100 four, of 3000 two.
Counting is a word count:
distinct terms of each document, summed in each task before the shuffle. Places are joined to the
terms; a bitmap of fixed size leaves out most places of other terms before that join.

A term is a run of ASCII digits and letters and of characters beyond ASCII, A-Z as a-z. Null
text is empty. Repeated rows each get their result; rows with a null doc_id too.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from slotflow.llm.common import slices, stage

Z = 1.96
GENERALISE, REMOVE = 0.8, 0.95
# Fixed values of the result's contract: the kinds in their order.
KINDS = ("email", "ip", "card", "phone")

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile("[0-9]")
# a run of digits that fails fails from each of its digits, so only its first is tried
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_PLACE = pa.list_(pa.struct([("term", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_SPAN_SQL = "array<struct<kind:string,start:bigint,end:bigint>>"
_PLACE_SQL = "array<struct<term:string,start:bigint,end:bigint>>"
_COUNTS = ["n", *(f"n_{k}" for k in KINDS)]
# slices of texts that a task counts before it gives out its sums, and bits of the bitmap
HELD = 8
BITS = 1 << 23


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @: back over the local part (not into an earlier match), forward over the domain."""
    low, at = 0, text.find("@")
    while at >= 0:
        begin = low + len(text[low:at].rstrip(_LOCAL))
        end = _DOMAIN.match(text, at + 1) if begin < at else None
        if end:
            yield begin, end.end()
        low = end.end() if end else at + 1
        at = text.find("@", low)


def _luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _checked(kind: str, match: str) -> bool:
    if kind == "ip":
        parts = [p.lstrip("0") for p in match.split(".")]
        return all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)
    digits = "".join(_DIGIT.findall(match))
    return 12 <= len(digits) <= 19 and _luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def find(text: str) -> list[tuple[int, int, int]]:
    """(start, index of the kind, end) of the entities, sorted."""
    found = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for k, pattern in ((1, _IP), (2, _CARD), (3, _PHONE)):
            found += [(m.start(), k, m.end()) for m in pattern.finditer(text) if _checked(KINDS[k], m.group())]
    return sorted(found)


def clear(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, str]]:
    """(start, end, term) of the terms that overlap none of the sorted spans."""
    begins, reach, open_ = [s for s, _, _ in spans], [], 0
    for _, _, e in spans:
        reach.append(open_ := max(open_, e))
    for m in _TERM.finditer(_lower(text)):
        k = bisect.bisect_left(begins, m.end())
        if not k or reach[k - 1] <= m.start():
            yield m.start(), m.end(), m.group()


def _lower(text: str) -> str:
    """A-Z as a-z, nothing else."""
    return text.encode().lower().decode()


def _distinct(text: str, spans: list[tuple[int, int, int]]) -> set[str]:
    return {t for _, _, t in clear(text, spans)} if spans else set(_TERM.findall(_lower(text)))


def _summed(counts: list[Counter]) -> pa.RecordBatch:
    terms = list(counts[0])
    return pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *(pa.array([c[t] for t in terms], pa.int64()) for c in counts)], ["term", *_COUNTS])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = [Counter() for _ in _COUNTS]
    for k, part in enumerate(slices(batches), 1):
        for text in part.column("text").to_pylist():
            own = find(text or "")
            terms = _distinct(text or "", own)
            terms.add("")
            for c in [0, *{kind + 1 for _, kind, _ in own}]:
                counts[c].update(terms)
        if k % HELD == 0:
            yield _summed(counts)
            counts = [Counter() for _ in _COUNTS]
    yield _summed(counts)


def scan(docs: DataFrame) -> DataFrame:
    """(term, n, n_<kind>): the documents that hold each term clear, all and those with an entity
    of the kind; the empty term stands for every document. Terms without any kind are left out."""
    counts = docs.select("text").mapInArrow(_count, "term string, " + ", ".join(f"{c} long" for c in _COUNTS))
    summed = counts.groupBy("term").agg(*[F.sum(c).alias(c) for c in _COUNTS])
    return stage(summed.where((F.col("term") == "") | (F.greatest(*_COUNTS[1:]) > 0)), "pii-counts")


def lower_bound(hits: F.Column, tries: F.Column, z: float) -> F.Column:
    """The lower end of Wilson's interval of a share."""
    p, spread = hits / tries, z * z / tries
    return (p + spread / 2 - F.sqrt(spread * (p * (1 - p) + spread / 4))) / (1 + spread)


def disclosing_terms(docs: DataFrame, scanned: DataFrame | None = None, z: float = Z) -> DataFrame:
    """(kind, term, disclosure, action) of the terms that reach a threshold; ``scanned`` is the
    scan of ``docs``, if there is one."""
    scanned = scan(docs) if scanned is None else scanned
    totals = scanned.where("term = ''").first()  # one row of counts; none if there are no documents
    n = F.lit(totals["n"] if totals else 0)
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"n_{k}").alias("n_tc"), F.lit(totals[f"n_{k}"] if totals else 0).alias("n_c")) for k in KINDS])
    pairs = scanned.where("term <> ''").select("term", F.col("n").alias("n_t"), F.explode(kinds).alias("x")).select("term", "n_t", "x.*")
    counted = pairs.where((F.col("n_tc") > 1) & (F.col("n_c") < n))
    share = F.log2(lower_bound(F.col("n_tc") - 1, F.col("n_t") - 1, z) * n / F.col("n_c")) / F.log2(n / F.col("n_c"))
    told = counted.withColumn("disclosure", share).where(F.col("disclosure") >= GENERALISE)
    return told.select("kind", "term", "disclosure", F.when(F.col("disclosure") >= REMOVE, "removed").otherwise("generalised").alias("action"))


def _bitmap(terms: DataFrame) -> bytes:
    """Bits set at the terms' hashes: BITS bits for any number of terms."""
    bit = F.crc32(F.col("term").cast("binary")) % BITS + 1
    parts = terms.groupBy(F.bitmap_bucket_number(bit).alias("at")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).collect()
    width, out = 4096, bytearray(BITS // 8 if parts else 0)
    for r in parts:
        out[(r["at"] - 1) * width : r["at"] * width] = r["bits"]
    return bytes(out)


def _locate(batches: Iterator[pa.RecordBatch], bits: bytes) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        spans, places = [], []
        for text in part.column("text").to_pylist():
            own = find(text or "")
            spans.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in own])
            may = {t for t in _distinct(text or "", own) if bits[(h := zlib.crc32(t.encode()) % BITS) >> 3] >> (h & 7) & 1} if bits else ()
            places.append([{"term": t, "start": s, "end": e} for s, e, t in clear(text, own) if t in may] if may else [])
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("key"), pa.array(spans, _SPAN), pa.array(places, _PLACE)], ["doc_id", "key", "base", "places"])


def locate(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(row_id, doc_id, key, base, places) of every row; key is a hash of the text, and places
    holds each clear place of each of the terms (and may hold some of others)."""
    bits = _bitmap(terms)
    keyed = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    found = keyed.mapInArrow(lambda it: _locate(it, bits), f"doc_id long, key long, base {_SPAN_SQL}, places {_PLACE_SQL}")
    return stage(found.withColumn("row_id", F.monotonically_increasing_id()), "pii")


def _written(spans) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def _ordered(spans) -> F.Column:
    """By start, then kind as listed (added kinds after those, by name), then end."""
    rank = lambda s: F.when(F.array_position(F.array(*map(F.lit, KINDS)), s.kind) > 0, F.array_position(F.array(*map(F.lit, KINDS)), s.kind)).otherwise(F.lit(9))
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(s.start.alias("start"), rank(s).alias("rank"), s.kind.alias("kind"), s.end.alias("end"))))
    return F.transform(keyed, lambda s: F.struct(s.kind.alias("kind"), s.start.alias("start"), s.end.alias("end")))


def spans(docs: DataFrame, z: float = Z) -> DataFrame:
    """(doc_id, key, base, spans) of every row: the pattern spans, and those with the added: one
    for each clear place of a disclosing term, of kind term-<kind> (generalised) or cut-<kind>
    (removed), of several kinds the first in order."""
    name = F.concat(F.when(F.col("action") == "removed", "cut-").otherwise("term-"), "kind")
    terms = stage(disclosing_terms(docs, z=z).groupBy("term").agg(F.min(name).alias("kind")), "pii-terms")
    rows = locate(docs, terms)
    held = rows.select("row_id", F.explode(F.array_distinct("places.term")).alias("term"))
    own = held.join(terms, "term").groupBy("row_id").agg(F.map_from_entries(F.collect_list(F.struct("term", "kind"))).alias("own"))
    joined = rows.join(own, "row_id", "left")
    placed = F.transform("places", lambda p: F.struct(F.try_element_at("own", p.term).alias("kind"), p.start.alias("start"), p.end.alias("end")))
    more = F.coalesce(F.filter(F.when(F.col("own").isNotNull(), placed), lambda p: p.kind.isNotNull()), F.array().cast(_SPAN_SQL))
    return joined.select("doc_id", "key", "base", _ordered(F.concat("base", more)).alias("spans"))


def report(docs: DataFrame, z: float = Z) -> DataFrame:
    """The contract's columns of every row."""
    found = spans(docs, z)
    kinds = found.select("doc_id", "base", "spans", F.col("base.kind").alias("kinds"))
    counts = [(F.size("kinds") - F.size(F.array_remove("kinds", k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return kinds.select("doc_id", *counts, F.sha2(_written("base"), 256).alias("base_sha256"), _written("spans").alias("spans"))


def clean_text(text: str, spans: list[dict]) -> str:
    """The text with each span replaced by a mark of its kind (removed terms: by nothing). Of
    overlapping spans the first, of those that start together the longest, counts."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= at:
            kind = s["kind"].removeprefix("term-")
            out += [text[at : s["start"]], "" if kind.startswith("cut-") else f"[{kind.upper()}]"]
            at = s["end"]
        elif s["end"] > at:
            at = s["end"]
    return "".join(out) + text[at:]


def _sanitise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        texts = [clean_text(t, s) if s else t for t, s in zip(part.column("text").to_pylist(), part.column("pii_spans").to_pylist())]
        names = [c for c in part.schema.names if c not in ("pii_spans", "pii_key", "pii_doc")]
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == "text" else part.column(c) for c in names], names)


def sanitise(docs: DataFrame, z: float = Z) -> DataFrame:
    """``docs`` with its texts cleaned and n_chars, where there, counted anew."""
    found = spans(docs, z).where(F.size("spans") > 0).groupBy(F.col("doc_id").alias("pii_doc"), F.col("key").alias("pii_key")).agg(F.first("spans").alias("pii_spans"))
    on = F.col("doc_id").eqNullSafe(F.col("pii_doc")) & (F.xxhash64("text") == F.col("pii_key"))
    cleaned = docs.join(found.hint("merge"), on, "left").mapInArrow(_sanitise, docs.schema)
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cleaned
