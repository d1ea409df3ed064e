"""Quality rules with an isolation forest over their statistics.

Each document gets counts over its whole text (see ``statistics``). Base rules
reject the plainly bad. An isolation forest judges the rest: trees of random
splits are grown on a bounded sample of rows, and a row that the trees separate
after few splits is an anomaly. The score at which a row is rejected is learned
from labelled rows: scores of all of them are counted into ``BINS`` bins, and the
cut with the best balanced accuracy is taken among those that keep at least
``MIN_KEPT`` of the good ones; without labelled rows of both kinds no row is
rejected by the forest.

Null texts count as empty; they have no word and fail the base rules. Rows with
equal keys are judged each on its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.frames import map_arrow, written

#: n_upper, n_signs, n_digits: ASCII capitals, ASCII signs (symbols included) and ASCII digits.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_signs", "n_digits")
_BYTES = [chr(b) for b in range(128)]
_SETS = {
    "symbols": np.array([c in "#*$%&|<>" for c in _BYTES]),
    "blanks": np.array([c in "\x20\x09\x0a\x0b\x0c\x0d" for c in _BYTES]),
    "upper": np.array([c.isupper() for c in _BYTES]),
    "signs": np.array([33 <= b < 127 and not chr(b).isalnum() for b in range(128)]),
    "digits": np.array([c.isdigit() for c in _BYTES]),
}
WINDOW = 5
#: The forest: rows sampled at most, trees, rows that each tree sees (few, so that anomalies of one
#: kind do not hide each other).
SAMPLE_ROWS, TREES, TREE_ROWS, SEED = 8192, 200, 64, 7
BINS, MIN_KEPT = 1000, 0.995


# -- rule statistics ---------------------------------------------------------
def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window found twice or more, the first one included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    size = len(numbers)
    if size == len(words):
        return 0
    key, span = ids[:n], size
    for k in range(1, window):
        if span * size >= 1 << 62:  # renumber before the key could overflow
            key = np.unique(key, return_inverse=True)[1]
            span = int(key.max()) + 1
        key = key * size + ids[k:n + k]
        span *= size
    order = np.argsort(key, kind="stable")
    equal = np.diff(key[order]) == 0
    if not equal.any():
        return 0
    again = np.zeros(n, bool)
    again[order[1:][equal]] = True
    again[order[:-1][equal]] = True
    marks = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(again)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + window, -1)
    return int((np.cumsum(marks)[:-1] > 0).sum())


def counts(text: str | None) -> tuple[int, ...]:
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode()
    words = raw.split()
    found = np.bincount(np.frombuffer(raw, np.uint8), minlength=128)[:128]
    of = {name: int(found[chosen].sum()) for name, chosen in _SETS.items()}
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (
        len(words), len(text) - of["blanks"], of["symbols"], len(lines) - len(set(lines)), repeat_words(words),
        of["upper"], of["signs"], of["digits"],
    )


def statistics(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key and the counts; one pass, nothing moves."""
    kind = df.schema[key].dataType.simpleString()
    names = [key, *COUNTS]

    def make():
        def step(batch):
            rows = np.array([counts(x.as_py()) for x in batch.column(1)], np.int64).reshape(-1, len(COUNTS))
            return pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(rows[:, k]) for k in range(len(COUNTS)))], names
            )

        return step

    return map_arrow(df.select(key, text), make, f"`{key}` {kind}, " + ", ".join(f"{c} long" for c in COUNTS))


# -- isolation forest --------------------------------------------------------
def features(rows: np.ndarray) -> np.ndarray:
    """What the forest splits on: shares of symbols, signs, capitals and repeated words."""
    words, chars, symbols, _, repeats, upper, signs, _ = rows.astype(np.float64).T
    some, size = np.maximum(words, 1), np.maximum(chars, 1)
    return np.stack(
        [np.sqrt(symbols / size), np.minimum(symbols / some, 1), np.log1p(symbols), np.minimum(signs / some, 3),
         upper / size, np.sqrt(repeats / some)], axis=1,
    )


def average_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, np.float64)
    safe = np.maximum(n, 2)
    value = 2 * (np.log(safe - 1) + np.euler_gamma) - 2 * (safe - 1) / safe
    return np.where(n < 2, 0.0, np.where(n == 2, 1.0, value))


def grow(x: np.ndarray, rng: np.random.Generator, depth: int) -> list[tuple]:
    """A tree as rows (feature, split, left, right, path added at a leaf)."""
    nodes: list[tuple] = []

    def build(rows: np.ndarray, level: int) -> int:
        at = len(nodes)
        nodes.append(())
        low, high = rows.min(0), rows.max(0)
        open_ = np.flatnonzero(high > low)
        if level == depth or len(rows) < 2 or not len(open_):
            nodes[at] = (-1, 0.0, at, at, level + float(average_path(len(rows))))
            return at
        f = int(rng.choice(open_))
        split = float(rng.uniform(low[f], high[f]))
        below = rows[:, f] < split
        nodes[at] = (f, split, build(rows[below], level + 1), build(rows[~below], level + 1), 0.0) \
            if below.any() and not below.all() else (-1, 0.0, at, at, level + float(average_path(len(rows))))
        return at

    build(x, 0)
    return nodes


class Forest:
    def __init__(self, x: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = SEED):
        rng = np.random.default_rng(seed)
        size = min(tree_rows, len(x))
        depth = max(1, int(np.ceil(np.log2(max(size, 2)))))
        self.depth, self.norm = depth, max(float(average_path(size)), 1e-9)
        self.trees = []
        for _ in range(trees):
            nodes = grow(x[rng.choice(len(x), size, replace=False)], rng, depth)
            f, split, left, right, path = map(np.array, zip(*nodes))
            self.trees.append((f, split, left, right, path))

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; near 1 for rows that few splits separate."""
        total = np.zeros(len(x))
        every = np.arange(len(x))
        for f, split, left, right, path in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                inner = f[at] >= 0
                below = x[every, np.maximum(f[at], 0)] < split[at]
                at = np.where(inner, np.where(below, left[at], right[at]), at)
            total += path[at]
        return np.exp2(-total / len(self.trees) / self.norm)


def fit_forest(stats: DataFrame, key: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> Forest | None:
    """Grow the forest on the ``sample_rows`` rows of smallest key hash (a bounded sample).

    Twice as many as wanted pass a bound on the hash first, so tasks send few rows to the driver.
    """
    share = min(1.0, 2 * sample_rows / max(1, stats.count()))
    order = F.shiftrightunsigned(F.xxhash64(key, *COUNTS), 1)
    few = stats.filter(order <= F.lit(min(int(share * (1 << 63)), (1 << 63) - 1)))
    rows = few.orderBy(order, *COUNTS).limit(sample_rows).select(*COUNTS).collect()
    return Forest(features(np.array(rows, np.int64))) if rows else None


def scored(stats: DataFrame, forest: Forest | None) -> DataFrame:
    """``stats`` with the column ``score``."""
    names = stats.columns
    at = [names.index(c) for c in COUNTS]

    def make():
        def step(batch):
            rows = np.stack([batch.column(k).to_numpy() for k in at], axis=1)
            value = forest.score(features(rows)) if forest else np.zeros(len(rows))
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(value)], [*names, "score"])

        return step

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stats.schema.fields)
    return map_arrow(stats, make, ddl + ", score double")


def threshold(scores: DataFrame, labels: DataFrame, key: str = "doc_id", good: str = "quality") -> float:
    """The cut with the best balanced accuracy over all labelled rows; 1.0 if they are of one kind.

    Only one count per (bin, label) comes to the driver.
    """
    known = labels.filter(F.col(good).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).alias("k"), (F.col(good) > 0).alias("good")
    )
    table = (
        scores.join(known, F.col(key) == F.col("k"))
        .groupBy(F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1)).alias("bin"), "good").count().collect()
    )
    n = np.zeros((2, BINS))
    for r in table:
        n[int(r["good"]), r["bin"]] += r["count"]
    if not n.sum(1).all():
        return 1.0
    kept = np.concatenate([[0], np.cumsum(n[1])]) / n[1].sum()  # good rows below each cut
    caught = 1 - np.concatenate([[0], np.cumsum(n[0])]) / n[0].sum()
    value = np.where(kept >= MIN_KEPT, kept + caught, -1.0)
    best = np.flatnonzero(value >= value.max() - 1e-12)
    return float(best[len(best) // 2]) / BINS  # the middle of a plateau


def judge(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", good: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Per document: the counts, ``base_failed``, ``score`` and ``kept``."""
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    stats = written(statistics(docs, key, text).withColumn("base_failed", failed), "quality-statistics")
    judged = stats.filter(~F.col("base_failed"))
    scores = scored(stats, fit_forest(judged, key, sample_rows))
    cut = threshold(scores.filter(~F.col("base_failed")), labels, key, good)
    return scores.withColumn("kept", ~F.col("base_failed") & (F.col("score") < cut))
