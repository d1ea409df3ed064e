"""Operators of a training-data pipeline. Nothing outside this folder imports it but the entry."""

from __future__ import annotations


def registered() -> tuple[dict, dict]:
    """(queries, check SQL) of all operators and of the pipeline."""
    import corpus_pipeline

    from pulsegrid.llm import queries_corpus, queries_layout, queries_pairs, queries_text, queries_tokens

    queries, checks = {}, {}
    for module in (queries_tokens, queries_text, queries_layout, queries_pairs, queries_corpus):
        queries |= module.QUERIES
        checks |= module.CHECKS
    queries["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL is not None:
        checks["pipeline"] = corpus_pipeline.ORACLE_SQL
    return queries, checks
