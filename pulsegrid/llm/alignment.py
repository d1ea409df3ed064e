"""Token alignment of two tokenizers over the same texts, with corpus-wide link counts.

A byte-level vocabulary (A) and a sentencepiece model with byte fallback (B) cut the
same bytes, a space and the text. The libraries give the coarse cuts: ``tokenizers``
its character offsets, ``sentencepiece`` the spans of its immutable proto (the installed
release calls it ``return_type="proto"``; its spans count bytes). Where several
tokens share one character, or a span is empty (byte fallback), the cuts are refined
with the decoded bytes of the tokens. Bytes where tokens of both end bound groups; two
tokens are linked if their byte ranges overlap.

Both vocabularies always cut before a single space or line break between two other
characters (checked for B's pieces; else texts are not cut), so a text is a sequence of
units whose alignments follow each other, and a worker computes each unit once. Blocks of
about ``BLOCK_CHARS`` of texts then ask for the counts of their different pairs only:
(block, pair) rows are exchanged, never (document, link) rows.

Null and empty texts, and texts that one of the tokenizers does not give back byte by
byte, have no tokens: zeros, and the empty string for ``groups``. Rows are treated one
by one, so repeated rows and null keys give a row each and count in the corpus each.
"""

from __future__ import annotations

import hashlib
import re
import struct
from itertools import accumulate
from operator import ge

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.frames import lists, ship, written
from pulsegrid.llm.tokens import SIGNS, byte_alphabet

#: Characters of texts whose pairs are asked for together, and the longest piece cut at once.
BLOCK_CHARS = 1 << 22
#: Units of one of a worker's two generations, and the bytes they hold (keys and packed units).
CACHE_UNITS, CACHE_BYTES = 200_000, 1 << 26
#: Units and their characters that the libraries align at once: what they return takes many times the text.
ALIGN_UNITS, ALIGN_CHARS = 1 << 12, 1 << 16
CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
_DOUBLE = re.compile(r"\s\s")
BLANK = "▁"


def units_of(text: str) -> list[str]:
    """Keys of the units of a space and ``text``: the unit, without a space in front that no blank follows."""
    if not text[0].isspace() and not text[-1].isspace() and not _DOUBLE.search(text):
        return text.replace("\n", " \n").split(" ")
    return [u[1:] if u[0] == " " and not u[1:2].isspace() else u for u in CUT.split(" " + text)]


def pieces_of(text: str, most: int):
    """The units of ``text`` in lists, each of about ``most`` characters; a unit is never cut."""
    if len(text) <= most:
        yield units_of(text)
        return
    text, at = " " + text, 0
    while at < len(text):
        found = CUT.search(text, at + most)
        stop = found.start() if found else len(text)
        yield [u[1:] if u[0] == " " and not u[1:2].isspace() else u for u in CUT.split(text[at:stop])]
        at = stop


def _length(key: str | tuple[str]) -> int:
    """Characters of a unit; signs behind a word are held in a tuple."""
    return len(key) if isinstance(key, str) else len(key[0])


def portions(units: list, most: int, chars: int):
    """``units`` in lists of at most ``most``, each ending with the unit that brings it to ``chars`` characters."""
    part, size = [], 0
    for unit in units:
        part.append(unit)
        size += _length(unit)
        if len(part) >= most or size >= chars:
            yield part
            part, size = [], 0
    if part:
        yield part


def byte_ends(coarse: list[int], sizes: list[int]) -> list[int]:
    """Where each token ends: the library's span, refined by decoded sizes inside a shared character."""
    out, at = [], 0
    for k, (end, size) in enumerate(zip(coarse, sizes)):
        shared = end <= at or (k + 1 < len(coarse) and coarse[k + 1] == end)
        at = at + size if shared else end
        out.append(at)
    return out


def pack(n_a: int, n_b: int, n_groups: int, groups: str, links: list[int]) -> bytes:
    """One unit in few bytes: four counts, the links as a << 32 | b, and the groups as text."""
    return struct.pack(f"<4i{len(links)}q", n_a, n_b, n_groups, len(links), *links) + groups.encode()


def follow(first: bytes, then: bytes) -> bytes:
    """The alignment of two units one after the other."""
    x, y = struct.unpack_from("<4i", first), struct.unpack_from("<4i", then)
    if x[0] < 0 or y[0] < 0:
        return BAD
    p, q = 16 + 8 * x[3], 16 + 8 * y[3]
    head = struct.pack("<4i", *(i + j for i, j in zip(x, y)))
    return head + first[16:p] + then[16:q] + first[p:] + b";" + then[q:]


#: A unit whose bytes one of the tokenizers does not give back.
BAD = pack(-1, 0, 0, "", [])


class Pair:
    """Both tokenizers; ``align`` does many strings at once."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        back = {c: bytes([k]) for k, c in enumerate(byte_alphabet())}
        added = {i: t.content.encode() for i, t in self.a.get_added_tokens_decoder().items()}
        self.a_bytes = [
            added[i] if i in added else b"".join(map(back.__getitem__, self.a.id_to_token(i) or ""))
            for i in range(self.a.get_vocab_size())
        ]
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(names)
        ]
        self.lead = self.b.piece_to_id(BLANK)
        real = [p for i, p in enumerate(names) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        self.cuts = not any(re.search(f"[^{BLANK}]{BLANK}", p) or "\n" in p for p in real)
        #: signs that no piece of B holds right behind a letter; A always cuts there
        inside = {y for p in real for x, y in zip(p, p[1:]) if x.isalpha()}
        self.signs = "".join(c for c in SIGNS if c not in inside) if self.cuts else ""
        self.said = [str(i) for i in range(max(len(names), len(self.a_bytes)))]

    def align(self, spaced: list[str], bare: list[str]) -> list[bytes]:
        """Packed units: ``spaced`` follow a space that is theirs, ``bare`` stand behind other text."""
        ahead = "\n" if self.cuts else ""  # keeps the model from putting a space in front of a bare one
        left = self.a.encode_batch([" " + u for u in spaced] + bare, add_special_tokens=False)
        right = self.b.encode([*spaced, *(ahead + u for u in bare)], return_type="proto", num_threads=1)
        n = len(spaced)
        out = [self._unit(" " + u, x, y.pieces, 1, 0) for u, x, y in zip(spaced, left, right)]
        return out + [self._unit(u, x, y.pieces, -1, 2) for u, x, y in zip(bare, left[n:], right[n:])]

    def _unit(self, unit: str, left, right, shift: int, skip: int) -> bytes:
        raw, a = unit.encode(), left.ids
        if skip:  # the space that the model puts in front, and the line break
            right = right[skip:]
        b, b_ends = [p.id for p in right], [p.end + shift for p in right]
        a_parts, b_parts = [self.a_bytes[i] for i in a], [self.b_bytes[i] for i in b]
        if b"".join(a_parts) != raw or b"".join(b_parts) != raw:
            return BAD
        a_ends = [e for _, e in left.offsets]
        if len(raw) != len(unit):
            width = [0, *accumulate(len(c.encode()) for c in unit)]
            a_ends = byte_ends([width[e] for e in a_ends], list(map(len, a_parts)))
            b_ends = byte_ends(b_ends, list(map(len, b_parts)))
        elif b and (b_ends[0] <= 0 or any(map(ge, b_ends, b_ends[1:]))):  # byte fallback of a control
            b_ends = byte_ends(b_ends, list(map(len, b_parts)))
        said = self.said
        if len(a) == len(b) and a_ends == b_ends:  # token for token
            return pack(len(a), len(b), len(a), ";".join([f"{said[x]}|{said[y]}" for x, y in zip(a, b)]),
                        [x << 32 | y for x, y in zip(a, b)])
        links, groups = [], []
        i = j = from_a = from_b = 0
        while i < len(a):
            links.append(a[i] << 32 | b[j])
            x, y = a_ends[i], b_ends[j]
            i += x <= y
            j += y <= x
            if x == y:
                groups.append(",".join([said[k] for k in a[from_a:i]]) + "|" + ",".join([said[k] for k in b[from_b:j]]))
                from_a, from_b = i, j
        return pack(len(a), len(b), len(groups), ";".join(groups), links)


class Cache:
    """Packed units of a worker. Two generations: what is used stays, what is not goes with its generation."""

    def __init__(self, pair: Pair):
        self.pair, self.new, self.old, self.size = pair, {}, {}, 0

    def _put(self, key, packed: bytes) -> None:
        self.new[key] = packed
        self.size += len(packed) + _length(key)

    def _get(self, key) -> bytes | None:
        found = self.new.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self._put(key, found)
        return found

    def find(self, keys: list[str]) -> list[bytes]:
        """The packed unit of each key; a word and the signs behind it are two units, if it is new."""
        if len(self.new) > CACHE_UNITS or self.size > CACHE_BYTES:
            self.new, self.old, self.size = {}, self.new, 0
        split, wanted = {}, {}
        for key in keys:
            if self._get(key) is None:
                word = key.rstrip(self.pair.signs) if self.pair.signs else key
                if word and len(word) < len(key) and word[-1].isalpha():
                    split[key] = parts = word, (key[len(word):],)
                    wanted.update((p, None) for p in parts if self._get(p) is None)
                else:
                    wanted[key] = None
        for part in portions(list(wanted), ALIGN_UNITS, ALIGN_CHARS):
            spaced = [k for k in part if isinstance(k, str) and not k[:1].isspace()]
            inner = [k for k in part if isinstance(k, str) and k[:1] == " "]  # units that start with two blanks
            bare = [k for k in part if not isinstance(k, str) or k[:1].isspace() and k[:1] != " "]
            found = self.pair.align(spaced + [k[1:] for k in inner], [k if isinstance(k, str) else k[0] for k in bare])
            for key, packed in zip(spaced + inner + bare, found):
                self._put(key, packed)
        for key, (word, signs) in split.items():
            self._put(key, follow(self._get(word), self._get(signs)))
        return [self._get(k) for k in keys]


class Block(dict):
    """Key of a unit -> its number in a block of texts."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number

    def settle(self, cache: Cache) -> None:
        """Counts (n_a, n_b, n_groups, n_links), groups and links of the units by number."""
        packed = cache.find(list(self))
        self.counts = np.frombuffer(b"".join([x[:16] for x in packed]), "<i4").reshape(-1, 4).astype(np.int64)
        ends = (16 + 8 * self.counts[:, 3]).tolist()
        self.groups = [x[e:].decode() for x, e in zip(packed, ends)]
        self.links = np.frombuffer(b"".join([x[16:e] for x, e in zip(packed, ends)]), "<i8")


_open: dict[tuple, Cache] = {}


def _worker(a_path: str, b_path: str) -> Cache:
    """One cache per Python worker, so that it outlives a task."""
    if (a_path, b_path) not in _open:
        _open[a_path, b_path] = Cache(Pair(a_path, b_path))
    return _open[a_path, b_path]


def _numbers(block: Block, text: str | None, most: int, cuts: bool) -> np.ndarray:
    if not text:
        return np.empty(0, np.int32)
    if not cuts:
        return np.array([block[" " + text if text[0].isspace() else text]], np.int32)
    return np.concatenate([np.array([block[k] for k in keys], np.int32) for keys in pieces_of(text, most)])


def _groups(table: Block, numbers: np.ndarray, digest: bool) -> str:
    if not digest:
        return ";".join([table.groups[k] for k in numbers.tolist()])
    sha = hashlib.sha256()
    for at in range(0, len(numbers), 1 << 18):
        part = ";".join([table.groups[k] for k in numbers[at:at + (1 << 18)].tolist()])
        sha.update((";" * (at > 0) + part).encode())
    return sha.hexdigest()


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _blocks(df: DataFrame, key: str, text: str, a_path: str, b_path: str, digest: bool, block_chars: int) -> DataFrame:
    """Rows of documents (units as numbers in their block) and one row per block (its pairs, those of each unit)."""
    kind = df.schema[key].dataType.simpleString()
    schema = (
        f"block long, k {kind}, {', '.join(f'{c} long' for c in _COUNTS)}, groups string, units array<int>, times array<int>,"
        " unit_ends array<int>, unit_pairs array<int>, pairs array<long>, weights array<long>"
    )
    ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())

    def run(batches):
        cache, number = _worker(a_path, b_path), TaskContext.get().partitionId() << 32
        table, keys, held, size = Block(), [], [], 0

        def flush():
            table.settle(cache)
            every = [np.unique(x, return_counts=True) for x in held]
            bad = [bool((table.counts[u, 0] < 0).any()) for u, _ in every]
            every = [(u[:0], t[:0]) if b else (u, t) for (u, t), b in zip(every, bad)]
            local, total = np.unique(np.concatenate([u for u, _ in every]), return_inverse=True)
            times = np.bincount(total, np.concatenate([t for _, t in every]), len(local)).astype(np.int64)
            stop = np.cumsum(table.counts[:, 3])
            sizes = table.counts[local, 3]
            rows = np.repeat(stop[local] - np.cumsum(sizes), sizes) + np.arange(sizes.sum())
            pairs, at = np.unique(table.links[rows], return_inverse=True)
            weights = np.zeros(len(pairs), np.int64)
            np.add.at(weights, at, np.repeat(times, sizes))
            sums = np.array([(t @ table.counts[u]) for u, t in every], np.int64).reshape(-1, 4)
            names = ["block", "k", *_COUNTS, "groups", "units", "times", "unit_ends", "unit_pairs", "pairs", "weights"]
            n, step = len(held), 2000
            for a in range(0, n, step):
                part = range(a, min(n, a + step))
                said = ["" if bad[i] or not len(held[i]) else _groups(table, held[i], digest) for i in part]
                m = len(said)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * m, pa.int64()), pa.concat_arrays(keys[a:a + m]),
                     *[pa.array(sums[a:a + m, c]) for c in range(4)], pa.array(said, pa.string()),
                     lists([np.searchsorted(local, every[i][0]).astype(np.int32) for i in part], pa.int32()),
                     lists([every[i][1].astype(np.int32) for i in part], pa.int32()),
                     *[pa.nulls(m, x) for x in (ints, ints, longs, longs)]], names,
                )
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.nulls(1, keys[0].type), *[pa.nulls(1, pa.int64())] * 4,
                 pa.nulls(1, pa.string()), *[pa.nulls(1, ints)] * 2, lists([np.cumsum(sizes).astype(np.int32)], pa.int32()),
                 lists([at.astype(np.int32)], pa.int32()), lists([pairs], pa.int64()), lists([weights], pa.int64())], names,
            )

        for batch in batches:
            for i, value in enumerate(batch.column(1)):
                value = value.as_py()
                keys.append(batch.column(0).slice(i, 1))
                held.append(_numbers(table, value, block_chars, cache.pair.cuts))
                size += len(value or "")
                if size >= block_chars:
                    yield from flush()
                    number, table, keys, held, size = number + 1, Block(), [], [], 0
        if held:
            yield from flush()

    ship(df.sparkSession)
    given = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    return given.mapInArrow(run, schema)


def _corpus(blocks: DataFrame) -> DataFrame:
    """(pair, n): how many links of all texts hold it."""
    x = F.col("x")
    asked = blocks.filter("pairs is not null").select(F.explode(F.arrays_zip("pairs", "weights")).alias("x"))
    return asked.groupBy(x["pairs"].alias("pair")).agg(F.sum(x["weights"]).alias("n"))


def _top(counts: DataFrame) -> DataFrame:
    """(pair, n, top): whether no pair of the same B id has more; an id has as many pairs as A has entries at most."""
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    return counts.select("pair", "n", (F.col("n") == F.max("n").over(of_b)).alias("top"))


def pair_counts(df: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """(a_id, b_id, n, top): all linked id pairs of the texts; ``top`` marks the most frequent ones of a B id."""
    blocks = _blocks(df.select(F.lit(None).cast("long").alias("k"), F.col(f"`{text}`").alias("t")), "k", "t", a_path, b_path, True, BLOCK_CHARS)
    found = _top(_corpus(written(blocks, "alignment-blocks")))
    return found.select(
        F.shiftright("pair", 32).cast("int").alias("a_id"), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("b_id"), "n", "top"
    )


def align(
    df: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", digest: bool = False,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Per row: the key, n_a, n_b, n_groups, n_links, n_best, count_sum and groups.

    ``groups`` is ``a1,a2|b1;a3|b2,b3`` (ids of A and B of each group in order), or with
    ``digest`` its SHA-256 in hexadecimal, which is much smaller to exchange. ``n_best``
    counts the links whose pair is as frequent as any of its B id in all texts,
    ``count_sum`` adds up the counts of the links.
    """
    blocks = written(_blocks(df, key, text, a_path, b_path, digest, block_chars), "alignment-blocks", compression="zstd")
    asked = blocks.filter("pairs is not null").select("block", F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(_top(_corpus(blocks)), "pair").select(F.col("block").alias("of"), "place", "n", "top")
    kind = df.schema[key].dataType.simpleString()

    def judge(docs: pa.Table, found: pa.Table) -> pa.Table:
        whole = docs.filter(docs.column("unit_ends").is_valid())
        rows = docs.filter(docs.column("unit_ends").is_null())
        place = found.column("place").to_numpy()
        n, top = np.zeros((2, len(place) + 1), np.int64)
        n[place], top[place] = found.column("n").to_numpy(), found.column("top").to_numpy(zero_copy_only=False)
        ends = whole.column("unit_ends").combine_chunks().values.to_numpy()
        at = whole.column("unit_pairs").combine_chunks().values.to_numpy()
        per_unit = [
            np.diff(np.concatenate([[0], np.cumsum(x[at])])[np.concatenate([[0], ends])]) for x in (top, n)
        ]
        units, times = (rows.column(c).combine_chunks() for c in ("units", "times"))
        many = times.values.to_numpy()
        lengths = np.diff(units.offsets.to_numpy())
        owner = np.repeat(np.arange(rows.num_rows), lengths)
        out = []
        for x in per_unit:
            total = np.zeros(rows.num_rows, np.int64)
            np.add.at(total, owner, x[units.values.to_numpy()] * many)
            out.append(pa.array(total))
        return pa.table([rows.column("k"), *[rows.column(c) for c in _COUNTS], *out, rows.column("groups")],
                        ["k", *_COUNTS, "n_best", "count_sum", "groups"])

    ship(df.sparkSession)
    # a block holds BLOCK_CHARS of texts, or one long text
    left = blocks.drop("pairs", "weights").groupBy("block")
    found = left.cogroup(answers.groupBy("of")).applyInArrow(
        judge, f"k {kind}, {', '.join(f'{c} long' for c in _COUNTS)}, n_best long, count_sum long, groups string"
    )
    return found.select(F.col("k").alias(key), *_COUNTS, "n_best", "count_sum", "groups")
