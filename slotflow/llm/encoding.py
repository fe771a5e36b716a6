"""Token ids by the tokenizer libraries, asking for each frequent piece of text once.

Two kinds of ``.json`` files let a text be cut without changing its tokens: byte-level files, and the
lower-casing word file. Texts of ASCII and accented Latin letters, digits and marks are cut into
what the file's pattern finds in them, and the library's model encodes these parts. Other texts are
cut at white space only (for byte-level files before the last character of a run of white space, as
their pattern does); pieces with characters of which libraries may know different Unicode versions
go to the library with all its steps.

The ids of short parts and pieces are kept (``2 * MEMO`` of them at most). Texts that hold a special
token's string go to the library whole, and so do all texts of other files and of ``.model`` files.
A long text is cut into stretches, so that its list of parts stays small.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache

MEMO = 300_000
SHORT = 64
STRETCH = 1 << 20
# Fixed value: the characters that Unicode calls white space.
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Fixed value: the pattern of the lower-casing word file.
_WORD_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
# letters whose case and normal form no Unicode version changes, and ASCII marks
_LETTER = r"A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u017e"
_MARK = r"!-/:-@\[-`{-~"
_PLAIN = re.compile(rf"[{_LETTER}{_MARK}0-9 \t-\r]*")
_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"


class _Memo(dict):
    """Values computed when they are first asked for. Those of long keys are not kept; when it is
    full, the keys not asked for since it was last full go."""

    def __init__(self, compute: Callable[[str], bytes]):
        self.compute, self.older = compute, {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= SHORT:
            if len(self) >= MEMO:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


def _letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else
    the next one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(256 + k) for k, b in enumerate(rest)}


_LETTERS = _letters()


def _spelled(part: str) -> str:
    """The bytes of a part as a byte-level vocabulary spells them."""
    if part.isascii() and part.isprintable():
        return part.replace(" ", _LETTERS[32])
    return part.encode().decode("latin-1").translate(_LETTERS)


class _Cuts:
    """How to cut the texts of a file: into pieces, plain pieces into parts, long texts into
    stretches that begin where ``border`` does."""

    def __init__(self, pieces: str, parts: str, border: str, lower: bool):
        self.pieces, self.parts, self.border = re.compile(pieces).findall, re.compile(parts).findall, re.compile(border)
        self.lower = lower

    @classmethod
    def of(cls, spec: dict) -> _Cuts | None:
        """None if the texts must stay whole."""
        before = spec.get("pre_tokenizer") or {}
        if spec["model"].get("type") != "BPE" or spec["model"].get("dropout"):
            return None
        if before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not spec.get("normalizer"):
            parts = rf"{_ENDINGS}| ?[{_LETTER}]+| ?[0-9]+| ?[{_MARK}]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+"
            return cls(f"[{_WHITE}]?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])", parts, f"(?<=[^{_WHITE}]) (?=[^{_WHITE}])", False)
        split = next((p for p in before.get("pretokenizers", []) if p["type"] == "Split"), {})
        if split.get("pattern") == {"Regex": _WORD_PATTERN} and split.get("behavior") == "Removed" and split.get("invert"):
            return cls(r"[^\t-\r ]+", rf"{_ENDINGS}|[{_LETTER}]+|[0-9]|[{_MARK}]+", r"[\t-\r ]", True)
        return None


def _pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """Ids of texts for a tokenizer file, without begin, end or added special tokens."""

    def __init__(self, path: str):
        self.cuts, self.special = None, ()
        if path.endswith(".model"):
            import sentencepiece

            pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            self.size, encode = pieces.vocab_size(), pieces.encode
        else:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
            import tokenizers

            with open(path, encoding="utf-8") as f:
                spec = json.load(f)
            library = tokenizers.Tokenizer.from_file(path)
            library.no_truncation()
            library.no_padding()
            self.size = library.get_vocab_size(with_added_tokens=True)
            self.special = [t["content"] for t in spec.get("added_tokens", [])]
            self.cuts = _Cuts.of(spec)
            encode, model = lambda text: library.encode(text, add_special_tokens=False).ids, library.model
            self._parts = _Memo(lambda part: _pack([t.id for t in model.tokenize(_spelled(part))]))
        self._library = lambda text: _pack(encode(text))
        self._pieces = _Memo(self._library)

    def ids(self, text: str) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit integers."""
        if self.cuts is None or any(s in text for s in self.special):
            return self._library(text)
        return b"".join(map(self._stretch, self._stretches(text)))

    def _stretch(self, text: str) -> bytes:
        if not _PLAIN.fullmatch(text):
            return b"".join(map(self._pieces.__getitem__, self.cuts.pieces(text)))
        return b"".join(map(self._parts.__getitem__, self.cuts.parts(text.lower() if self.cuts.lower else text)))

    def count(self, text: str) -> int:
        return len(self.ids(text)) // 4

    def _stretches(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > STRETCH and (border := self.cuts.border.search(text, at + STRETCH)):
            yield text[at : border.start()]
            at = border.start()
        yield text[at:]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of a file, one for each worker process."""
    return Encoder(path)
