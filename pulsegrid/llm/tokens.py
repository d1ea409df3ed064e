"""Exact fast encoding with a given public vocabulary; no Spark here.

``Encoder`` gives the ids of the ``tokenizers`` library. A text is cut where the
vocabulary's own pre-tokenisation always cuts (white space), and each unit is
looked up in a bounded cache. A unit not seen yet is encoded by the library; a
single pre-token of letters or signs goes through ``tiktoken``'s merge loop over
the ranks of the same vocabulary, which is several times faster per word. The
two agree if every vocabulary entry encodes to itself (a merge inside a span sees
nothing outside of it), which is checked for all entries that are valid text when
the first word is met; otherwise the library alone is used. Texts with special tokens, unusual controls or an
unknown kind of vocabulary go to the library whole.

Where sentence ends are asked for as well, a text of ``COMMON`` characters and single
blanks goes through the merge loop in one call, cut as the byte-level vocabulary
cuts it; the bytes of its ids show at which count a sentence ends.
"""

from __future__ import annotations

import json
import os
import re
from functools import partial
from struct import pack

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Entries that a cache holds at most, and the longest unit that is kept.
CACHE_UNITS, CACHE_WORDS, CACHE_FIRSTS, LONGEST_KEPT = 300_000, 400_000, 50_000, 48
#: ASCII signs that form one run for the pre-tokenisers; the apostrophe opens contractions.
SIGNS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")
#: A unit that ends so closes a sentence; a line break does as well.
SENTENCE_ENDS = (".", "!", "?")
_CLOSES = np.isin(np.arange(256), [ord(x) for x in SENTENCE_ENDS])
MARK = "\x01"
#: The cut of byte-level vocabularies in texts of ``COMMON`` characters without two blanks in a row: nothing looks ahead.
PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"
COMMON = "\n -~\xa1-\u024f\u2010-\u2027\u20ac"
#: Characters that Python takes for white space and the library does not.
_ODD = re.compile("[\x1c-\x1f]")
_DOUBLE = re.compile(r"\s\s")
_UNCOMMON = re.compile(f"[^{COMMON}]")
#: Two blanks in a row among the common characters.
_PAIRS = ("  ", "\n\n", " \n", "\n ")
_SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def byte_alphabet() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in plain}
    for shift, b in enumerate(b for b in range(256) if b not in table):
        table[b] = chr(256 + shift)
    return [table[b] for b in range(256)]


class _Kept(dict):
    """Unit -> little-endian ids; computes what it lacks and keeps a bounded number."""

    def __init__(self, compute, most: int):
        super().__init__()
        self._compute, self._most = compute, most

    def __missing__(self, unit):
        value = self._compute(unit)
        if len(self) < self._most and len(unit) <= LONGEST_KEPT:
            self[unit] = value
        return value


class Encoder:
    """The vocabulary in ``path``; ``kind`` is "byte", "word" or None (library only)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        spec = json.loads(self.tok.to_str())
        self.kind = _kind(spec)
        self.specials = [t["content"] for t in spec.get("added_tokens", [])]
        self.tokens = [self.tok.id_to_token(i) or "" for i in range(self.tok.get_vocab_size())]
        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        self._alphabet = byte_alphabet()
        self.model = self.tok.model
        self.plain = self.tok
        if self.kind == "word":
            self.plain = Tokenizer.from_file(path)
            self.plain.normalizer = normalizers.Sequence([])
        self._merge = None
        self._whole = self._pieces
        #: bytes of each id, known when ``_whole`` is
        self._sizes = np.empty(0, np.int64)
        #: whether the last text had no two blanks in a row
        self.single = False
        self._words = _Kept(self._first_word, CACHE_WORDS)
        self._firsts = _Kept(self._bare, CACHE_FIRSTS)
        self._units = _Kept(self._spaced if self.kind == "byte" else self._bare, CACHE_UNITS)

    # -- single units -------------------------------------------------------
    def _word(self, word: str) -> bytes:
        """One pre-token through the library's merge model."""
        mapped = "".join(map(self._alphabet.__getitem__, word.encode()))
        return np.array([t.id for t in self.model.tokenize(mapped)], "<i4").tobytes()

    def _merger(self):
        """The same merges over byte strings; a zero byte stands for the end of a word."""
        import tiktoken

        back = {c: bytes([b]) for b, c in enumerate(self._alphabet)}
        ranks = {}
        for i, token in enumerate(self.tokens):
            if token in self.specials:
                continue
            end = bool(self.suffix) and token.endswith(self.suffix)
            body = token[: len(token) - len(self.suffix)] if end else token
            if not all(c in back for c in body):
                return None
            ranks[b"".join(map(back.__getitem__, body)) + b"\0" * end] = i
        if len(ranks) != len(self.tokens) - len(self.specials):
            return None
        merger = tiktoken.Encoding("unit", pat_str="(?s).+", mergeable_ranks=ranks, special_tokens={})
        for raw, i in ranks.items():
            try:
                text = raw.decode()
            except UnicodeDecodeError:
                continue
            if merger.encode_ordinary(text) != [i]:
                return None
        return merger

    def _pieces(self, text: str) -> np.ndarray | None:
        """Build the merge loop over whole texts when the first one asks for it."""
        import tiktoken

        self._whole = None
        merger = self._merger() if self.kind == "byte" and not self.suffix else None
        if merger:
            ranks = merger._mergeable_ranks
            # without a special token the search for one would stop at every place; no common text has this one
            whole = tiktoken.Encoding(
                "text", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={"\0": len(self.tokens)}
            )
            self._whole = partial(whole.encode_to_numpy, disallowed_special=())
            self._sizes = np.zeros(len(self.tokens), np.int64)
            self._sizes[list(ranks.values())] = [len(raw) for raw in ranks]
        return self._whole and self._whole(text)

    def _first_word(self, word: str) -> bytes:
        """Build the merge loop when the first word asks for it: decoding alone needs none."""
        merger = self._merger()
        if merger:
            self._merge = merger.encode_ordinary
        self._words._compute = self._ranked if merger else self._word
        return self._words._compute(word)

    def _ranked(self, word: str) -> bytes:
        ids = self._merge(word + "\0" if self.suffix else word)
        return pack(f"<{len(ids)}i", *ids)

    def _library(self, text: str, tok=None) -> bytes:
        ids = (tok or self.plain).encode(text, add_special_tokens=False).ids
        return np.array(ids, "<i4").tobytes()

    def _split_unit(self, unit: str, lead: str) -> bytes:
        core = unit.rstrip(SIGNS)
        if core.isalpha():
            tail = unit[len(core):]
            return self._words[lead + core] + (self._words[tail] if tail else b"")
        return self._library(lead + unit)

    def _bare(self, unit: str) -> bytes:
        return self._split_unit(unit, "")

    def _spaced(self, unit: str) -> bytes:
        """``unit`` with the space before it."""
        return self._split_unit(unit, " ")

    # -- whole texts --------------------------------------------------------
    def is_plain(self, text: str) -> bool:
        """Whether the unit path holds for this text."""
        return self.kind is not None and not any(s in text for s in self.specials) and not _ODD.search(text)

    def is_common(self, text: str) -> bool:
        """Whether one call of the merge loop over the whole text gives its ids."""
        return (
            not _UNCOMMON.search(text)
            and not any(p in text for p in _PAIRS)
            and not any(s in text for s in self.specials)
        )

    def normalize(self, text: str) -> str:
        """What the vocabulary's normaliser makes of the text."""
        if self.kind == "byte" or self.tok.normalizer is None:
            return text
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.tok.normalizer.normalize_str(text)
        return text.lower()

    def parts(self, text: str) -> tuple[list[bytes], list[str]] | None:
        """Ids of each unit of a plain text, and the units; None if it is not plain."""
        if not self.is_plain(text):
            return None
        return self.normal_parts(self.normalize(text))

    def normal_parts(self, text: str) -> tuple[list[bytes], list[str]]:
        if self.kind == "word":
            units = text.split()
            return list(map(self._units.__getitem__, units)), units
        self.single = bool(text) and not _DOUBLE.search(text)
        if not self.single:
            units = _SINGLE_SPACE.split(text)
            found = list(map(self._units.__getitem__, units))
            found[0] = self._library(units[0]) if units[0] else b""
            return found, units
        # single white space only: a unit follows each space, or opens a line behind the break's own token
        found, units, spaced = [], [], self._units.__getitem__
        for k, line in enumerate(text.split("\n")):
            first, *rest = line.split(" ")
            opening = self._firsts[first] if first else b""
            found.append(self._words["\n"] + opening if k else opening)
            found += map(spaced, rest)
            units.append(first)
            units += rest
        return found, units

    def encode(self, text: str | None) -> np.ndarray:
        """int32 ids of the whole text; a null or empty text has none."""
        if not text:
            return np.empty(0, "<i4")
        found = self.parts(text)
        data = b"".join(found[0]) if found else self._library(text, self.tok)
        return np.frombuffer(data, "<i4")

    def encode_with_ends(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The ids, and the token counts at which a sentence of the text ends (increasing)."""
        if text and self._whole and self.is_common(text) and (whole := self._whole(text)) is not None:
            ids = whole.astype("<i4")
            raw = np.frombuffer(text.encode(), np.uint8)
            blanks = np.flatnonzero((raw == 32) | (raw == 10))
            closing = blanks[(raw[blanks] == 10) | _CLOSES[raw[blanks - 1]]]
            places = np.append(closing[closing > 0], len(raw))
            return ids, np.searchsorted(np.cumsum(self._sizes[ids]), places) + 1
        found = self.parts(text) if text else None
        if not found:
            return self.encode(text), np.empty(0, np.int64)
        parts, units = found
        if self.kind == "byte" and self.single and MARK not in text:
            # a unit for each blank of the text: count those of a sentence
            marked = text
            for sign in SENTENCE_ENDS:
                marked = marked.replace(sign + " ", sign + MARK)
            joined, ends, at = [], [], 0
            for sentence in marked.replace("\n", MARK).split(MARK):
                stop = at + sentence.count(" ") + 1
                joined.append(b"".join(parts[at:stop]))
                at = stop
            sizes = np.fromiter(map(len, joined), np.int64, len(joined))
            ends = np.cumsum(sizes)[sizes > 0] // 4
            return np.frombuffer(b"".join(joined), "<i4"), ends
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts))) // 4
        closing = np.array([k for k, u in enumerate(units) if u.endswith(SENTENCE_ENDS)], np.int64)
        return np.frombuffer(b"".join(parts), "<i4"), np.unique(ends[closing])

    def encode_normal(self, text: str) -> np.ndarray:
        """The same for a plain text that is normalised already."""
        return np.frombuffer(b"".join(self.normal_parts(text)[0]), "<i4")

    def decode(self, ids: np.ndarray) -> str:
        """The library's ``decode(ids, skip_special_tokens=False)``."""
        if self.tok.decoder is None:
            return " ".join(map(self.tokens.__getitem__, ids.tolist()))
        return self.tok.decode(ids.tolist(), skip_special_tokens=False)


def _kind(spec: dict) -> str | None:
    norm, pre, model = spec["normalizer"], spec["pre_tokenizer"] or {}, spec["model"]
    if model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges"):
        return None
    if norm is None and pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]:
        return "byte"
    steps = [x["type"] for x in (norm or {}).get("normalizers", [])]
    splits = pre.get("pretokenizers", [])
    if (
        steps == ["NFC", "Replace", "Lowercase"]
        and [x["type"] for x in splits] == ["Split", "ByteLevel"]
        and (splits[0]["behavior"], splits[0]["invert"]) == ("Removed", True)
        and not splits[1]["use_regex"]
    ):
        return "word"
    return None


_open: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per vocabulary and Python worker, so the caches outlive a task."""
    if path not in _open:
        _open[path] = Encoder(path)
    return _open[path]
