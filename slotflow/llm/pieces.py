"""SentencePiece encoding by suffix-array matching, and decoding.

A batch's text is cut into parts that no piece can cross (a run of spaces with what follows up
to the next space or line end). The distinct parts are concatenated and indexed by a suffix array
(prefix doubling over packed characters, up to the longest piece). Every piece of the vocabulary
is found by binary search as a range of suffixes; each occurrence is an edge from its start to
its end. Edges are sorted by position and relaxed in that order, in lockstep over all parts.

The model's pieces are merged by rank (byte-pair encoding), so what is relaxed is not a sum of
scores: a part's encoding up to a position ends with exactly one piece, the one that is
compatible with the last piece of the encoding up to that piece's start (merging the two texts
must not cross their border). That gives the library's encoding exactly. Compatibility of two
pieces follows from the merges they are made of, and is kept in a table.

Characters outside the vocabulary become their bytes. Null text is empty and has no pieces.
Decoding a text's pieces gives the text back, but that U+2581, which stands for a space, comes
back as a space. Repeated rows and rows with a null doc_id each get their result. A task holds
one slice of texts and an index over at most ``INDEX_CHARS`` characters of distinct parts (or
one longer part).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from slotflow.llm.common import slices
from slotflow.llm.hashing import spread

SPACE = "▁"
INDEX_CHARS = 1 << 20
_TABLE_BITS = 21


@dataclass
class Vocabulary:
    """The pieces in an order of their own: single characters first, then merged pieces by rank."""

    texts: list[str]
    ids: np.ndarray  # library id
    left: np.ndarray  # the two pieces that a merged one is made of; itself for a character
    right: np.ndarray
    pair_keys: np.ndarray  # left * n + right of the merged pieces, sorted
    pair_made: np.ndarray
    byte_ids: np.ndarray  # library id of each byte's piece
    decode_bytes: np.ndarray  # bytes of all library ids, joined, and where each begins
    decode_at: np.ndarray
    line_ends: bool  # whether a line end is a border that no piece crosses


def _merge(parts: list[str], rank: dict[str, int], below: int) -> list[str]:
    """Byte-pair encoding with the pieces of rank under ``below``."""
    while len(parts) > 1:
        best, at = min((rank.get(a + b, below), k) for k, (a, b) in enumerate(zip(parts, parts[1:])))
        if best >= below:
            break
        parts = [*parts[:at], parts[at] + parts[at + 1], *parts[at + 2 :]]
    return parts


def load(path: str) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.vocab_size()
    plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    if [model.decode(model.encode(t)) for t in ("  a  b ", "ａ")] != ["  a  b ", "ａ"] or not model.is_byte(model.piece_to_id("<0x00>")):
        raise ValueError("only models that keep their text as it is are supported")
    text = {i: model.id_to_piece(i) for i in plain}
    if any(SPACE in t.lstrip(SPACE) for t in text.values()):
        raise ValueError("a piece goes on after a space")
    chars = [i for i in plain if len(text[i]) == 1]
    merged = sorted((i for i in plain if len(text[i]) > 1), key=lambda i: -model.get_score(i))
    rank = {text[i]: k for k, i in enumerate(merged)}
    own = {text[i]: k for k, i in enumerate(chars)}
    texts, ids, left, right = [text[i] for i in chars], list(chars), list(range(len(chars))), list(range(len(chars)))
    for k, i in enumerate(merged):
        parts = _merge(list(text[i]), rank, k)
        if len(parts) == 2 and parts[0] in own and parts[1] in own:  # else no merge ever makes it
            own[text[i]] = len(texts)
            texts.append(text[i])
            ids.append(i)
            left.append(own[parts[0]])
            right.append(own[parts[1]])
    left, right = np.array(left), np.array(right)
    made = np.arange(len(chars), len(texts))
    keys = left[made] * len(texts) + right[made]
    order = np.argsort(keys)
    byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
    as_bytes = [b""] * n
    for i in plain:
        as_bytes[i] = text[i].replace(SPACE, " ").encode()
    for b, i in enumerate(byte_ids.tolist()):
        as_bytes[i] = bytes([b])
    at = np.concatenate(([0], np.cumsum([len(x) for x in as_bytes])))
    return Vocabulary(texts, np.array(ids, np.int32), left, right, keys[order], made[order], byte_ids.astype(np.int32), np.frombuffer(b"".join(as_bytes), np.uint8), at, not any("\n" in t for t in texts))


# ------------------------------------------------------------------ compatibility
def _compatible(v: Vocabulary, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Whether the encoding of the two pieces' joined text is the two pieces: undoing the merges
    inside both, latest first, no pair at their border may merge earlier than what was undone."""
    n, first, second = len(v.texts), first.copy(), second.copy()
    out = np.ones(len(first), bool)
    limit = np.full(len(first), n, np.int64)
    todo = np.arange(len(first))
    while len(todo):
        a, b, lim = first[todo], second[todo], limit[todo]
        key = a * n + b
        k = np.minimum(np.searchsorted(v.pair_keys, key), len(v.pair_keys) - 1)
        out[todo[(v.pair_keys[k] == key) & (v.pair_made[k] < lim)]] = False
        undo_first = a > b
        a_char, b_char = v.right[a] == a, v.left[b] == b
        # the later of the two merges is undone; a character has none, then it is the other's turn
        on_first = (undo_first & ~a_char) | (~undo_first & b_char & ~a_char)
        on_second = ~on_first & ~b_char
        limit[todo] = np.where(on_first, a, np.where(on_second, b + 1, lim))
        first[todo] = np.where(on_first, v.right[a], a)
        second[todo] = np.where(on_second, v.left[b], b)
        todo = todo[(on_first | on_second) & out[todo]]
    return out


class Pairs:
    """Compatibility of pairs asked so far, in a table of fixed size (a newer pair may replace)."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.keys = np.full(1 << _TABLE_BITS, -1, np.int64)
        self.good = np.zeros(1 << _TABLE_BITS, bool)

    def __call__(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        key = first * len(self.v.texts) + second
        slot = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)
        good = self.good[slot]
        new = np.flatnonzero(self.keys[slot] != key)
        if len(new):
            asked, back = np.unique(key[new], return_inverse=True)
            told = _compatible(self.v, asked // len(self.v.texts), asked % len(self.v.texts))
            good[new] = told[back]
            self.keys[slot[new]], self.good[slot[new]] = key[new], good[new]
            same = self.keys[slot[new]] == key[new]  # of several in one slot the last stays
            self.good[slot[new][same]] = good[new][same]
        return good


# ------------------------------------------------------------------ suffix array
def _key_ranges(sorted_keys: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.searchsorted(sorted_keys, low), np.searchsorted(sorted_keys, high)


def find_pieces(codes: np.ndarray, pieces: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(piece, start) of every occurrence of every piece in ``codes``; 0 in codes matches none."""
    alphabet = np.unique(codes)
    bits = max(1, int(len(alphabet)).bit_length())
    per_key = 63 // bits
    letters = np.searchsorted(alphabet, codes).astype(np.int64) + 1  # 0: past the end
    longest = max(map(len, pieces))
    n = len(letters)
    padded = np.concatenate((letters, np.zeros(per_key, np.int64)))
    key = np.zeros(n, np.int64)
    for k in range(per_key):
        key = (key << bits) | padded[k : k + n]
    # pieces as letters; those with a character that is not here do not occur
    flat = np.concatenate(pieces)
    place = np.minimum(np.searchsorted(alphabet, flat), len(alphabet) - 1)
    sizes = np.array([len(p) for p in pieces])
    first = np.cumsum(sizes) - sizes
    here = np.logical_and.reduceat(alphabet[place] == flat, first)
    which = np.flatnonzero(here)
    n_blocks = -(-longest // per_key)
    blocks = np.zeros((len(which), n_blocks * per_key), np.int64)
    row, within = spread(sizes[which])
    blocks[row, within] = place[first[which][row] + within] + 1
    packed = np.zeros((len(which), n_blocks), np.int64)
    for k in range(per_key):
        packed = (packed << bits) | blocks[:, k::per_key]
    # the interval of ranks, at level 0, that each block of a piece allows
    ranks, rank = np.unique(key, return_inverse=True)
    left = sizes[which][:, None] - np.arange(n_blocks) * per_key
    open_bits = np.clip(per_key - left, 0, per_key) * bits
    top = packed + (np.int64(1) << np.minimum(open_bits, 62))
    low, high = np.searchsorted(ranks, packed), np.searchsorted(ranks, top)
    anything = left <= 0
    low[anything], high[anything] = 0, len(ranks)
    reach = per_key
    while reach < longest:  # prefix doubling: a rank of twice the reach is a pair of ranks
        total = len(ranks) + 1
        after = np.concatenate((rank[reach:], np.full(min(reach, n), -1, rank.dtype)))[:n]
        pair = rank * total + after + 1
        ranks, rank = np.unique(pair, return_inverse=True)
        if low.shape[1] % 2:
            low = np.concatenate((low, np.zeros((len(low), 1), low.dtype)), 1)
            high = np.concatenate((high, np.full((len(high), 1), total - 1, high.dtype)), 1)
        a, b, c, d = low[:, ::2], high[:, ::2], low[:, 1::2], high[:, 1::2]
        ends_here = (c == 0) & (d >= total - 1)
        low = np.searchsorted(ranks, np.where(ends_here, a * total, a * total + c + 1))
        high = np.searchsorted(ranks, np.where(ends_here, b * total, a * total + d + 1))
        high = np.where(~ends_here & (b <= a), low, np.where(b <= a, low, high))
        reach *= 2
    order = np.argsort(rank, kind="stable")
    count = np.concatenate(([0], np.cumsum(np.bincount(rank, minlength=len(ranks)))))
    begin, end = count[low[:, 0]], count[np.maximum(high[:, 0], low[:, 0])]
    row, within = spread(end - begin)
    return which[row], order[begin[row] + within]


# ------------------------------------------------------------------ encoding
class Encoder:
    def __init__(self, v: Vocabulary):
        self.v, self.pairs = v, Pairs(v)
        self.pieces = [np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in v.texts]
        self.lengths = np.array([len(t) for t in v.texts])
        self.known = np.unique([ord(t) for t in v.texts if len(t) == 1])
        self.cut = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n" if v.line_ends else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")

    def parts(self, text: str) -> list[str]:
        return self.cut.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all parts, where each part's begin) for distinct, non-empty parts."""
        sizes = np.array([len(p) for p in parts])
        begin = np.cumsum(sizes + 1) - sizes - 1
        codes = np.frombuffer("\x00".join([*parts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
        codes[begin + sizes] = 0x110000  # between parts; no text holds it
        n, no_piece = len(codes), len(self.v.texts)
        piece, start = find_pieces(codes, self.pieces)
        known = np.zeros(n, bool)
        known[start[self.lengths[piece] == 1]] = True
        alone = np.flatnonzero(~known & (codes != 0x110000))
        piece, start = np.concatenate((piece, np.full(len(alone), no_piece))), np.concatenate((start, alone))
        length = np.concatenate((self.lengths, [1]))
        end = start + length[piece]
        part_of = np.repeat(np.arange(len(parts)), sizes + 1)
        step = end - begin[part_of[start]]
        order = np.argsort(step.astype(np.uint16) if int(sizes.max()) < 65536 else step, kind="stable")
        piece, start, end, step = piece[order], start[order], end[order], step[order]
        last = np.full(n + 1, -1, np.int64)
        first = np.zeros(n, bool)
        first[begin] = True
        cuts = np.searchsorted(step, np.arange(1, int(sizes.max()) + 2))
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            p, s, e = piece[a:b], start[a:b], end[a:b]
            before = last[s]
            good = first[s] | (before == no_piece) | ((p == no_piece) & (before >= 0))
            ask = np.flatnonzero(~good & (before >= 0))
            if len(ask):
                good[ask] = self.pairs(before[ask], p[ask])
            last[e[good]] = p[good]
        # back from each part's end
        at, open_ = begin + sizes, np.arange(len(parts))
        steps, count = [], np.zeros(len(parts), np.int64)
        while len(open_):
            p = last[at[open_]]
            steps.append((open_, p, at[open_] - 1))
            count[open_] += 1
            at[open_] -= length[p]
            open_ = open_[at[open_] > begin[open_]]
        ends = np.cumsum(count)
        token, where = np.zeros(int(ends[-1]), np.int64), np.zeros(int(ends[-1]), np.int64)
        for k, (part, p, place) in enumerate(steps):
            token[ends[part] - 1 - k] = p
            where[ends[part] - 1 - k] = place
        bounds = np.concatenate(([0], ends))
        ids = np.concatenate((self.v.ids, [0]))[token].astype(np.int32)
        other = np.flatnonzero(token == no_piece)
        if not len(other):
            return ids, bounds
        as_bytes = [chr(c).encode("utf-8", "surrogatepass") for c in codes[where[other]].tolist()]
        grow = np.ones(len(ids), np.int64)
        grow[other] = [len(b) for b in as_bytes]
        wide = np.repeat(ids, grow)
        wide[np.repeat(token == no_piece, grow)] = self.v.byte_ids[np.frombuffer(b"".join(as_bytes), np.uint8)]
        return wide, np.concatenate(([0], np.cumsum(grow)))[bounds]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's begin)."""
        index: dict[str, int] = {}
        rows, n_rows = [], []
        for text in texts:
            own = [index.setdefault(p, len(index)) for p in self.parts(text or "")]
            rows += own
            n_rows.append(len(own))
        bounds = np.concatenate(([0], np.cumsum(n_rows)))
        if not index:
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        parts, ids, sizes, at, size = list(index), [], [], 0, 0
        for k, p in enumerate(parts):
            size += len(p) + 1
            if size >= INDEX_CHARS or k == len(parts) - 1:
                own, places = self.encode_parts(parts[at : k + 1])
                ids.append(own)
                sizes.append(np.diff(places))
                at, size = k + 1, 0
        ids, sizes, rows = np.concatenate(ids), np.concatenate(sizes), np.array(rows)
        begin = np.cumsum(sizes) - sizes
        row, within = spread(sizes[rows])
        total = np.concatenate(([0], np.cumsum(sizes[rows])))
        return ids[begin[rows[row]] + within], total[bounds]


def decode_ids(v: Vocabulary, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
    """The texts of rows of ids."""
    sizes = np.diff(v.decode_at)[ids]
    row, within = spread(sizes)
    data = v.decode_bytes[v.decode_at[ids[row]] + within].tobytes()
    at = np.concatenate(([0], np.cumsum(sizes)))[bounds]
    return [data[a + 1 : b].decode("utf-8", "replace") if b > a else "" for a, b in zip(at.tolist(), at[1:].tolist())]


def _list(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))


def _encode(batches: Iterator[pa.RecordBatch], v: Vocabulary) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(v)
    for part in slices(batches):
        texts = part.column("text").to_pylist()
        ids, bounds = encoder.encode(texts)
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(bounds)), _list(ids, bounds)], ["doc_id", "n_pieces", "pieces"])


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_pieces, pieces) of every row: the ids that the model at ``path`` gives."""
    v = load(path)
    return docs.select("doc_id", "text").mapInArrow(lambda it: _encode(it, v), "doc_id long, n_pieces long, pieces array<int>")


def _decode(batches: Iterator[pa.RecordBatch], v: Vocabulary) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("pieces").fill_null([])
        offsets = column.offsets.to_numpy()
        ids = column.values.to_numpy()[offsets[0] : offsets[-1]]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(decode_ids(v, ids, offsets - offsets[0]), pa.string())], ["doc_id", "text"])


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of every row with ``pieces`` (null: none)."""
    v = load(path)
    return encoded.select("doc_id", "pieces").mapInArrow(lambda it: _decode(it, v), "doc_id long, text string")


def _round_trip(batches: Iterator[pa.RecordBatch], v: Vocabulary) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(v)
    for part in slices(batches):
        texts = part.column("text").to_pylist()
        ids, bounds = encoder.encode(texts)
        same = [a == (b or "").replace(SPACE, " ") for a, b in zip(decode_ids(v, ids, bounds), texts)]
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(bounds)), _list(ids, bounds), pa.array(same)], ["doc_id", "n_pieces", "pieces", "round_trip"])


def report(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_pieces, pieces, round_trip): encodes and decodes every row."""
    v = load(path)
    return docs.select("doc_id", "text").mapInArrow(lambda it: _round_trip(it, v), "doc_id long, n_pieces long, pieces array<int>, round_trip boolean")
