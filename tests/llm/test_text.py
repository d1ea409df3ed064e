"""Operators 4 and 10."""

import random
import re
from collections import Counter

import numpy as np
from corpus import docs, odd_texts, words
from pyspark.sql import functions as F

from pulsegrid.llm import language, quality

SYLLABLES = {"xx": ["ka", "lo", "mi"], "yy": ["sch", "ung", "en"]}


def speak(rnd, lang, n=40):
    return " ".join("".join(rnd.choice(SYLLABLES[lang]) for _ in range(3)) for _ in range(n))


def labelled(spark, n=240):
    rnd = random.Random(8)
    rows = [(k, speak(rnd, lang), lang) for k in range(n) for lang in [rnd.choice(["xx", "yy"])]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_languages_held_out(spark):
    train = labelled(spark).unionByName(
        spark.createDataFrame([(None, "ka lo", "xx"), (900, None, "xx"), (901, "ka", None)], "doc_id long, text string, lang string")
    )
    model = language.fit_documents(train)
    assert model.classes == ["xx", "yy"]
    assert (model.weights == 0).mean() > 0.5  # sparse
    got = language.predict(train, model).filter(language.held_out("doc_id") & F.col("lang").isNotNull()).collect()
    assert len(got) > 30 and all(r["lang"] == r["lang_pred"] and 0.5 < r["score"] <= 1 for r in got if r["text"])


def test_language_of_odd_texts(spark):
    model = language.fit_documents(labelled(spark))
    df = docs(spark, list(enumerate(odd_texts())), extra=True)
    got = language.predict(df, model)
    assert got.columns == [*df.columns, "lang_pred_", "score_"]
    for r in got.collect():
        letter = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred_"] == "und") == (not letter) and 0 <= r["score_"] <= 1
    kept = language.keep_known(df, model, 0.0)
    assert kept.columns == df.columns and kept.count() == sum(any(c.isalpha() for c in t or "") for t in odd_texts())


def test_language_sample_is_bounded_in_rows(spark):
    rnd = random.Random(41)
    rows = [("hot", speak(rnd, lang), lang) for lang in ("xx", "yy") for _ in range(60)] + [("hot", "ka lo mi", "xx")] * 60
    rows += [(str(k), speak(rnd, "xx"), "xx") for k in range(3)] + [("twice", "sch ung", "zz")] * 2
    train = spark.createDataFrame(rows, "id string, text string, lang string")
    assert Counter(r[0] for r in language._sample(train, 20)) == {"xx": 20, "yy": 20, "zz": 2}
    every = language._sample(train, 1000)
    assert Counter(r[0] for r in every) == {"xx": 123, "yy": 60, "zz": 2}


def test_language_without_training_rows(spark):
    model = language.fit_documents(labelled(spark).filter("false"))
    assert {r["lang_pred"] for r in language.predict(docs(spark, [(1, "text")]), model).collect()} == {"und"}


def test_grams_do_not_depend_on_pieces(monkeypatch):
    text = words(random.Random(1), 500) + " éà日本"
    whole = language.gram_counts(text)
    monkeypatch.setattr(language, "PIECE", 37)
    pieces = language.gram_counts(text)
    assert all((a == b).all() for a, b in zip(whole, pieces))


def slow_counts(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    five = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = {i + k for i in range(len(w) - 4) if five[tuple(w[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


def test_rule_counts():
    rnd = random.Random(9)
    texts = [*odd_texts(), "a b c d e f a b c d e", "x\nx\n\nx y", " ".join(["z"] * 30)]
    texts += [" ".join(rnd.choice("abc") for _ in range(rnd.randint(1, 60))) for _ in range(200)]
    texts.append(" ".join(str(rnd.randint(0, 20000)) for _ in range(40000)) + " 1 2 3 4 5 1 2 3 4 5")
    for t in texts:
        assert quality.counts(t)[:5] == slow_counts(t)


def test_forest_keeps_good_rows(spark):
    rnd = random.Random(10)
    rows, marks = [], []
    for k in range(400):
        bad = k % 12 == 0
        text = words(rnd, 60)
        rows.append((k, re.sub(r"(\w+)", r"\1***", text) if bad else text))
        if k % 2 == 0:
            marks.append((k, 0 if bad else 1))
    rows += [(None, words(rnd, 60)), (500, None), (501, ""), (5, rows[5][1])]
    labels = spark.createDataFrame([*marks, (None, 1), (3, None)], "doc_id long, quality int")
    got = quality.judge(docs(spark, rows, extra=True), labels).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert all(by[k]["kept"] == (k % 12 != 0) for k in range(400))
    assert by[500]["base_failed"] and by[501]["base_failed"] and by[None]["kept"]
    none = quality.judge(docs(spark, rows[:20]), labels.filter("false")).collect()
    assert all(r["kept"] for r in none)
    assert quality.judge(docs(spark, []), labels).count() == 0


def test_forest_paths():
    x = np.concatenate([np.random.default_rng(1).normal(size=(500, 2)), [[9.0, 9.0]]])
    s = quality.Forest(x).score(x)
    assert s.argmax() == 500 and 0 < s.min() < s.max() < 1
    assert len(set(quality.Forest(np.ones((10, 2))).score(np.ones((3, 2))))) == 1
