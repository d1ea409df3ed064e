"""BPE encoding and decoding by tree concatenation.

Texts of ordinary length are encoded where they lie. A text longer than
``long_chars`` is cut into leaves that other tasks encode in parallel; the leaves
are then joined pairwise up a tree. At each join a window around the cut is
encoded again and grows until one of its tokens is also a token of the left side
and one is also a token of the right side. All neighbouring tokens of the result
are then neighbours in some correct encoding, and an encoding whose neighbours
are all correct is the encoding of the whole, so the result is exact.

Null and empty texts have no ids; rows, their order in a partition and other
columns stay as they are. Texts the normalised form of which cannot be cut (no
admissible place near a middle) are encoded whole.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.frames import append, fresh, lists, map_arrow, with_schema
from pulsegrid.llm.tokens import Encoder, encoder

#: Characters of a leaf, of a text that is cut, and of the first window on each side.
LEAF_CHARS, LONG_CHARS, WINDOW = 16_384, 65_536, 64
#: Tokens ending this close to a window's false end are not trusted (contractions).
MARGIN = 4


# -- joining two encodings --------------------------------------------------
def _class(c: str) -> str:
    kind = unicodedata.category(c)[0]
    return "S" if c.isspace() else kind if kind in "LN" else "P"


def can_cut(text: str, at: int) -> bool:
    """Whether both sides keep the pre-tokens of the whole, but for the run that is cut."""
    left, right = text[at - 1], text[at]
    return _class(left) == _class(right) in ("L", "N", "P") and "'" not in (left, right)


def cut_near(text: str, at: int, reach: int) -> int | None:
    for step in range(reach):
        for place in (at + step, at - step):
            if 0 < place < len(text) and can_cut(text, place):
                return place
    return None


def leaves(text: str, leaf: int = LEAF_CHARS) -> list[str]:
    """Halve a normalised text until no piece is longer than ``leaf``."""
    done, todo = [], [text]
    while todo:
        piece = todo.pop()
        at = cut_near(piece, len(piece) // 2, leaf // 4) if len(piece) > leaf else None
        if at is None:
            done.append(piece)
        else:
            todo += [piece[at:], piece[:at]]
    return done


class Joiner:
    """Joins encodings of adjacent normalised texts."""

    def __init__(self, enc: Encoder):
        self.enc = enc
        n = len(enc.suffix)
        #: bytes of text behind each token
        self.width = np.array(
            [len(t) - n if n and t.endswith(enc.suffix) else len(t) for t in enc.tokens], np.int64
        )
        #: white space has no token in the "word" kind, so places are counted without it
        self.skip = enc.kind == "word"

    def _bytes(self, text: str) -> int:
        return len(("".join(text.split()) if self.skip else text).encode())

    def _ends(self, ids: np.ndarray) -> np.ndarray:
        return np.cumsum(self.width[ids])

    def join(self, left: str, a: np.ndarray, right: str, b: np.ndarray) -> np.ndarray:
        """Ids of ``left + right`` from the ids of both; the seam may lie inside a pre-token."""
        reach = WINDOW
        while True:
            start = self._start(left, reach)
            stop = min(len(right), reach)
            whole = start == 0 and stop == len(right)
            middle = self.enc.encode_normal(left[start:] + right[:stop])
            if whole:
                return middle
            found = self._agree(left, a, right, b, middle, start, stop)
            if found is not None:
                i, (p, q), j = found
                return np.concatenate([a[:i], middle[p:q], b[j:]])
            reach *= 2

    def _start(self, left: str, reach: int) -> int:
        at = len(left) - reach
        while at > 0 and not can_cut(left, at):
            at -= 1
        return max(at, 0)

    def _agree(self, left, a, right, b, middle, start, stop):
        tail = self._bytes(left[start:])
        ends = self._ends(middle)  # bytes behind each token of the window, from its start
        begins = ends - self.width[middle]
        if start == 0:
            i, p = 0, 0
        else:  # a token of the window that the left side has at the same place
            at = self._ends(a)
            at -= (at[-1] if len(at) else 0) - tail
            limit = tail - MARGIN
            p = self._common(at - self.width[a], at, a, begins, ends, middle, 1, limit, first=True)
            if p is None:
                return None
            i, p = p
        if stop == len(right):
            j, q = len(b), len(middle)
        else:
            at = self._ends(b) + tail
            limit = (ends[-1] if len(ends) else 0) - MARGIN
            found = self._common(at - self.width[b], at, b, begins, ends, middle, tail + 1, limit, first=False)
            if found is None:
                return None
            j, q = found
        return (i, (p, q), j) if p <= q else None

    def _common(self, lo, hi, ids, begins, ends, middle, least, most, first):
        """(place in ids, place in the window) of the outermost shared token in the bounds."""
        _, x, y = np.intersect1d(lo, begins, return_indices=True)
        good = (hi[x] == ends[y]) & (ids[x] == middle[y]) & (begins[y] >= least) & (ends[y] <= most)
        if not good.any():
            return None
        k = np.flatnonzero(good)
        k = k[0] if first else k[-1]
        return int(x[k]), int(y[k])


def join_tree(joiner: Joiner, pieces: list[tuple[str, np.ndarray]]) -> np.ndarray:
    """Join neighbours level by level until one encoding is left."""
    while len(pieces) > 1:
        pairs = zip(pieces[::2], pieces[1::2])
        up = [(x + y, joiner.join(x, a, y, b)) for (x, a), (y, b) in pairs]
        pieces = up + pieces[len(pieces) // 2 * 2:]
    return pieces[0][1] if pieces else np.empty(0, "<i4")


# -- operators --------------------------------------------------------------
def encode(
    df: DataFrame, path: str, text: str = "text", ids: str = "ids",
    long_chars: int = LONG_CHARS, leaf_chars: int = LEAF_CHARS, decoded: str | None = None,
) -> DataFrame:
    """``df`` with the array<int> column ``ids``: the whole text's ids without special ones.

    With ``decoded`` the ids are decoded again in the same pass, into that column.
    """
    source = fresh(df, "text_in")
    ids_name = fresh(df, ids)
    base = df.withColumn(source, F.col(f"`{text}`"))
    is_long = F.coalesce(F.length(source) > long_chars, F.lit(False))
    at = len(df.columns)

    def short():
        enc = encoder(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [enc.encode(x.as_py()) for x in batch.column(at)]
            kept = pa.RecordBatch.from_arrays(batch.columns[:at], batch.schema.names[:at])
            back = {back_name: pa.array(map(enc.decode, found), pa.string())} if back_name else {}
            return append(kept, **{ids_name: lists(found, pa.int32())}, **back)

        return step

    back_name = decoded and fresh(df.withColumn(ids_name, F.lit(0)), decoded)
    extra = f"`{ids_name}` array<int>" + (f", `{back_name}` string" if back_name else "")
    near = map_arrow(base.filter(~is_long), short, with_schema(df, extra))
    far = _encode_long(df, base.filter(is_long), source, path, ids_name, leaf_chars)
    return near.unionByName(decode(far, path, ids_name, back_name) if back_name else far)


def _encode_long(df, rows, source, path, ids_name, leaf_chars):
    """Leaves of long texts go to other tasks; the other columns wait in one struct."""
    packed = rows.select(
        F.monotonically_increasing_id().alias("row"),
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("rest"),
        F.col(source).alias("text"),
    )
    at_leaf = "row long, leaf int, plain boolean, piece string"

    def cut():
        enc = encoder(path)

        def step(batch):
            out = []
            for row, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                whole = value.as_py()
                plain = enc.is_plain(whole)
                parts = leaves(enc.normalize(whole), leaf_chars) if plain else [whole]
                out += [(row, k, plain, piece) for k, piece in enumerate(parts)]
            columns = list(zip(*out)) or [[], [], [], []]
            kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["row", "leaf", "plain", "piece"]
            )

        return step

    def encode_leaf():
        enc = encoder(path)

        def step(batch):
            found = [
                enc.encode_normal(piece) if plain and piece else enc.encode(piece)
                for plain, piece in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            ]
            return append(batch, ids=lists(found, pa.int32()))

        return step

    def join_leaves():
        joiner = Joiner(encoder(path))

        def step(batch):
            found = []
            for parts in batch.column(1):
                parts = sorted(parts.as_py(), key=lambda x: x["leaf"])
                found.append(join_tree(joiner, [(x["piece"], np.array(x["ids"], "<i4")) for x in parts]))
            return pa.RecordBatch.from_arrays(
                [batch.column(0), lists(found, pa.int32())], ["row", "ids"]
            )

        return step

    cuts = map_arrow(packed.select("row", "text"), cut, at_leaf).repartition(F.col("row"), F.col("leaf"))
    coded = map_arrow(cuts, encode_leaf, at_leaf + ", ids array<int>")
    # a long text is one row of the input, so its pieces fit one row here as well
    whole = coded.groupBy("row").agg(F.collect_list(F.struct("leaf", "piece", "ids")).alias("parts"))
    joined = map_arrow(whole, join_leaves, "row long, ids array<int>")
    return packed.drop("text").join(joined, "row").select("rest.*", F.col("ids").alias(ids_name))


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of the ids, special ones included; null ids give a null text."""
    name = fresh(df, text)
    at = df.columns.index(ids)

    def make():
        enc = encoder(path)

        def step(batch):
            out = [None if x.values is None else enc.decode(x.values.to_numpy()) for x in batch.column(at)]
            return append(batch, **{name: pa.array(out, pa.string())})

        return step

    return map_arrow(df, make, with_schema(df, f"`{name}` string"))
