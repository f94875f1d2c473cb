"""The language stage where no language can be learned."""

from __future__ import annotations

import corpus_pipeline


def test_without_languages_all_documents_stay(spark, documents):
    docs = documents([(1, "some words of text"), (2, "more of them"), (3, None)])
    kept = corpus_pipeline.identify_language(spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3]
    assert kept.columns == docs.columns
