"""The pipeline over a small corpus with planted cases, and the registration."""

import random

import corpus_pipeline
import __spark_entry__ as entry
from corpus import words
from pyspark.sql import functions as F
from test_text import speak

from pulsegrid.llm import registered

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def planted(spark, tmp_path):
    rnd = random.Random(11)
    rows = [(k, ".\n".join(words(rnd, 9) for _ in range(8)) + ".", "xx") for k in range(60)]
    rows += [(100 + k, ".\n".join(speak(rnd, "yy", 9) for _ in range(8)) + ".", "yy") for k in range(60)]
    passage = words(rnd, 90)
    rows += [(200 + k, f"{words(rnd, 30)} {passage} {words(rnd, 30)}", "xx") for k in range(3)]
    rows += [(300, rows[0][1], "xx"), (301, rows[1][1] + " more", "xx"), (302, "12 345 ###", "xx"), (303, None, "yy")]
    df = spark.createDataFrame([(k, t, la, "s", len(t or "")) for k, t, la in rows], SCHEMA)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    return {k: t for k, t, _ in rows}, passage


def test_stages(spark, tmp_path):
    texts, passage = planted(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    after = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert sorted(docs.columns) == sorted(x.split()[0] for x in SCHEMA.split(", "))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        after[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert docs.filter(F.col("n_chars") != F.length("text")).count() == 0
    assert {302, 303}.isdisjoint(after["language"]) and len(after["language"]) == len(texts) - 2
    assert 300 not in after["lines"]  # an exact copy loses every line
    assert 301 not in after["near_copies"] or len(after["near_copies"][301]) < 400
    last = after["substrings"]
    clean = [k for k in texts if 2 <= k < 200]
    assert all(last[k] == texts[k] for k in clean)
    assert not any(passage in t for t in last.values())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert {r["doc_id"] for r in pieces} == set(last)
    run = corpus_pipeline.run(spark, str(tmp_path)).collect()
    key = lambda r: (r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"])
    assert sorted(map(key, run)) == sorted(map(key, pieces))


def test_repeated_rows_and_null_ids_stay_once(spark, tmp_path):
    rnd = random.Random(12)
    rows = [(k, ".\n".join(words(rnd, 9) for _ in range(8)) + ".", "xx") for k in range(60)]
    rows += [(100 + k, ".\n".join(speak(rnd, "yy", 9) for _ in range(8)) + ".", "yy") for k in range(60)]
    lone, long = words(rnd, 90), ".\n".join(words(rnd, 9) for _ in range(12)) + "."
    rows += [(200, lone, "xx")] * 3 + [(None, long, "xx")] * 2 + [(None, words(rnd, 70), "xx"), rows[3], rows[3]]
    df = spark.createDataFrame([(k, t, la, "s", len(t)) for k, t, la in rows], SCHEMA)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = stage(spark, df, str(tmp_path))
        df.write.parquet(f"{tmp_path}/{name}")
        df = spark.read.parquet(f"{tmp_path}/{name}")
    assert sorted((str(r["doc_id"]), r["text"]) for r in df.collect()) == sorted({(str(k), t) for k, t, _ in rows})


def test_every_operator_is_registered():
    queries, checks = registered()
    assert {int(q[2:].split("_")[0]) for q in queries if q != "pipeline"} == set(range(1, 14))
    assert "pipeline" in queries and set(checks) <= set(queries) <= set(entry.queries())


def test_line_query_matches_sql(spark):
    from oracle import compare, connect

    queries, checks = registered()
    sf = "/root/testdata/sf0.001"
    for name, check in checks.items():
        _, _, ok, note = compare(spark, connect(sf), queries[name], check, sf)
        assert ok, note
