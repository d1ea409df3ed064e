"""Language identification by sparse multinomial logistic regression.

Features are the character n-grams (1 to 3) of the lower-cased text, hashed into
``BUCKETS`` places, weighted by TF-IDF and scaled to unit length. Document
frequencies are counted over all training rows; the weights are learned from at
most ``ROWS_PER_CLASS`` rows of each language by the follow-the-regularised-leader
rule with an elastic net, which leaves most of them zero; a temperature fitted on
held-back rows of that sample makes the scores honest probabilities.

A null text, and one without a letter, is ``und`` with score 0. Training ignores
rows with a null language and rows whose id is null. Without any training row all
texts are ``und``. Repeated rows count as often as they occur.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.frames import append, fresh, map_arrow, with_schema

BUCKETS = 1 << 14
#: Bound of the labelled sample that the weights are learned from, for each language.
ROWS_PER_CLASS = 500
SLICES = 32
UNKNOWN = "und"
ALPHA, BETA, L1, L2, EPOCHS = 1.0, 1.0, 2e-4, 1e-4, 4
#: Characters that are hashed at a time.
PIECE = 1 << 20
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def has_letter(text: str) -> bool:
    return text.isalpha() or any(map(str.isalpha, text))


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of the n-grams of the whole text; digits and signs count as a blank."""
    total = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(text or ""), PIECE):
        # two characters more, so that n-grams over the border are counted, and counted once
        piece = text[at:at + PIECE + 2].lower()
        code = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        code = np.where(code < 128, np.where((code >= 97) & (code <= 122), code, 32), code)
        fresh_ = min(len(code), PIECE) if len(text) > at + PIECE else len(code)
        key = np.zeros(len(code), np.uint64)
        for n, odd in enumerate(_ODD):
            if n:
                key = key[:-1]
            key = (key + code[n:n + len(key)] + np.uint64(n + 1)) * odd
            key ^= key >> np.uint64(29)
            bucket = (key[:fresh_] >> np.uint64(50)).astype(np.int64)
            total += np.bincount(bucket, minlength=BUCKETS)
    found = np.flatnonzero(total)
    return found, total[found]


def weights_of(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    value = (1 + np.log(counts)) * idf[found]
    size = np.sqrt(value @ value)
    return value / size if size else value


# -- learning ----------------------------------------------------------------
def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def ftrl(rows: list, target: np.ndarray, classes: int) -> np.ndarray:
    """Weights (bucket, class), most of them exactly zero."""
    z, n = np.zeros((BUCKETS, classes)), np.zeros((BUCKETS, classes))

    def weights(zi, ni):
        return -np.sign(zi) * np.maximum(np.abs(zi) - L1, 0) / ((BETA + np.sqrt(ni)) / ALPHA + L2)

    rng = np.random.default_rng(11)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)).tolist():
            at, x = rows[k]
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            p = softmax(x @ w)
            p[target[k]] -= 1
            g = x[:, None] * p[None, :]
            step = (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA
            z[at] = zi + g - step * w
            n[at] = ni + g * g
    return weights(z, n)


def temperature(logits: np.ndarray, target: np.ndarray) -> float:
    """The divisor of the logits with the least loss on held-back rows (1 if there are none)."""
    if not len(logits):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.5), np.log(20), 121))  # separable rows would drive it to zero
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(target)), target], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


class Model:
    def __init__(self, classes: list[str], idf: np.ndarray, weights: np.ndarray, temperature: float):
        self.classes, self.idf, self.weights, self.temperature = classes, idf, weights, temperature

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.classes or not has_letter(text):
            return UNKNOWN, 0.0
        at, counts = gram_counts(text)
        p = softmax(weights_of(at, counts, self.idf) @ self.weights[at] / self.temperature)
        best = int(np.argmax(p))
        return self.classes[best], float(p[best])


def _document_counts(train: DataFrame) -> tuple[np.ndarray, int]:
    """In how many training texts each bucket occurs; one row of BUCKETS counts per task is merged."""

    def run(batches):
        total, rows = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for x in batch.column(0):
                total[gram_counts(x.as_py())[0]] += 1
                rows += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(total[at], rows))], ["bucket", "n"]
        )

    from pulsegrid.llm.frames import ship

    ship(train.sparkSession)
    counted = train.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    df, rows = np.zeros(BUCKETS, np.int64), 0
    for r in counted.collect():
        if r["bucket"] < 0:
            rows = r["n"]
        else:
            df[r["bucket"]] = r["n"]
    return df, rows


def _sample(train: DataFrame, rows_per_class: int) -> list:
    """(lang, buckets, counts) of the rows of smallest id hash, the same number at most for each language.

    Rows of one id are ranked by the hash of the text, and equal rows come as one with their
    number, so an id on many rows brings no more than its share. The chosen rows are
    broadcast: they are ``rows_per_class`` for each class of the model at most.
    """
    best = [F.xxhash64("id"), F.col("id"), F.col("h")]
    hashed = train.withColumn("h", F.xxhash64("text"))

    def first(df: DataFrame, *by) -> DataFrame:
        ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*best)))
        return ranked.filter(F.col("rank") <= rows_per_class).drop("rank")

    # slices of a language first, so that what meets in one task does not grow with the input
    sliced = first(hashed.select("id", "lang", "h"), "lang", F.pmod(F.xxhash64("id"), F.lit(SLICES)))
    chosen = first(sliced, "lang").groupBy("id", "lang", "h").agg(F.count("*").alias("times"))

    def make():
        def step(batch):
            found = [gram_counts(x.as_py()) for x in batch.column(1)]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([f[k].tolist() for f in found], pa.list_(pa.int64())) for k in (0, 1)),
                 *batch.columns[2:]],
                ["lang", "at", "n", "id", "h", "times"],
            )

        return step

    sample = hashed.join(F.broadcast(chosen), ["id", "lang", "h"]).dropDuplicates(["id", "lang", "h"])
    rows = map_arrow(
        sample.select("lang", "text", "id", "h", "times"), make,
        "lang string, at array<long>, n array<long>, id string, h long, times long",
    ).collect()
    rows = sorted(rows, key=lambda r: (r["id"], r["lang"], r["h"]))
    return [(r["lang"], np.array(r["at"], np.int64), np.array(r["n"], np.int64)) for r in rows for _ in range(r["times"])]


def fit(train: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> Model:
    """``train`` has the columns id, text and lang."""
    train = train.filter("lang IS NOT NULL AND text IS NOT NULL AND id IS NOT NULL").select(
        F.col("id").cast("string").alias("id"), "text", "lang"
    )
    counts, rows = _document_counts(train)
    idf = np.log((1 + rows) / (1 + counts)) + 1
    sample = _sample(train, rows_per_class)
    classes = sorted({r[0] for r in sample})
    target = np.array([classes.index(r[0]) for r in sample], np.int64)
    vectors = [(at, weights_of(at, n, idf)) for _, at, n in sample]
    held = np.arange(len(sample)) % 5 == 4
    learn = np.flatnonzero(~held).tolist()
    w = ftrl([vectors[k] for k in learn], target[~held], len(classes))
    logits = np.array([vectors[k][1] @ w[vectors[k][0]] for k in np.flatnonzero(held)])
    return Model(classes, idf, w, temperature(logits, target[held]))


def predict(df: DataFrame, model: Model, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``df`` with the predicted language and its probability; nothing but the text is used."""
    source, out, sure = fresh(df, "text_in"), fresh(df, lang), fresh(df, score)
    last = len(df.columns)

    def make():
        def step(batch):
            found = [model.predict(x.as_py()) for x in batch.column(last)]
            kept = pa.RecordBatch.from_arrays(batch.columns[:last], batch.schema.names[:last])
            return append(kept, **{
                out: pa.array([x[0] for x in found], pa.string()), sure: pa.array([x[1] for x in found], pa.float64())
            })

        return step

    return map_arrow(
        df.withColumn(source, F.col(f"`{text}`")), make, with_schema(df, f"`{out}` string, `{sure}` double")
    )


def held_out(key: str):
    """Whether a document is outside of training: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_documents(docs: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> Model:
    return fit(docs.filter(~held_out("doc_id")).select(F.col("doc_id").alias("id"), "text", "lang"), rows_per_class)


def keep_known(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows with a learned language of at least that probability, columns as they were."""
    marked = predict(docs, model)
    lang, score = marked.columns[-2:]
    return marked.filter((F.col(lang) != UNKNOWN) & (F.col(score) >= least)).select(*docs.columns)
