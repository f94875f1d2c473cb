from __future__ import annotations

import random
import re
from collections import Counter
from math import floor, log

import pytest

from perimeter.llm import lexical

ITEMS = "item_id long, text string"


def plain_terms(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain_search(docs, items, k=10):
    """Ranking by the definition, one pair at a time."""
    bags = [(i, Counter(plain_terms(t))) for i, t in docs if plain_terms(t)]
    n_docs, n_terms = len(bags), sum(b.total() for _, b in bags)
    frequency = Counter(t for _, b in bags for t in b)
    found = []
    for item_id, text in items:
        scored = []
        for doc_id, bag in bags:
            m = 25 + (75 * bag.total() * n_docs) // n_terms
            score = 0
            for term in plain_terms(text):
                if term in bag:
                    w = floor(1000 * log((2 * n_docs + 2) / (2 * frequency[term] + 1)))
                    score += w * ((10**9 * bag[term]) // (1000 * bag[term] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        scored.sort(key=lambda s: s[:3])
        found += [(item_id, n + 1, s[3], -s[0]) for n, s in enumerate(scored[:k])]
    return Counter(found)


def found_by(rows):
    return Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in rows.collect())


@pytest.fixture
def corpus():
    words = [f"w{n}" for n in range(30)] + ["É", "ünï", "日本", "a-b", "x_y", "W1", "w"]
    random.seed(5)
    docs = [(n, " ".join(random.choices(words, k=random.randint(0, 40)))) for n in range(120)]
    docs += [(1000 + n, docs[3][1]) for n in range(15)]  # ties
    docs += [(None, docs[3][1]), (5, docs[3][1]), (7, None), (8, ""), (9, "--- !"), (10, "w1," * 20_000 + "É")]
    items = [(n, " ".join(random.choices(words, k=random.randint(1, 25)))) for n in range(12)]
    items += [(50, docs[3][1]), (51, None), (52, "absent terms"), (53, "?!"), (None, "w2 W2 w2"), (54, "w1"), (54, "w1")]
    return docs, items


def test_against_the_definition(spark, documents, corpus):
    docs, items = corpus
    found = lexical.search(documents(docs), spark.createDataFrame(items, ITEMS))
    assert found_by(found) == plain_search(docs, items)


def test_items_in_several_groups(spark, documents, corpus):
    docs, items = corpus
    found = lexical.search(documents(docs, 5), spark.createDataFrame(items, ITEMS), k=3, automaton_bytes=60)
    assert found_by(found) == plain_search(docs, items, 3)


def test_scores_in_small_blocks(spark, documents, corpus, monkeypatch):
    docs, items = corpus
    expected = plain_search(docs, items)
    tally = list(lexical._tallies(iter(_batches(docs)), _terms_of(items)))
    assert sum(t[1] for t in tally) == sum(len(plain_terms(t)) for _, t in docs)
    monkeypatch.setattr(lexical, "CELLS", 20)
    monkeypatch.setattr(lexical, "MATCHES", 5)
    terms = _terms_of(items)
    bags = [set(plain_terms(t)) for _, t in docs if plain_terms(t)]
    n_docs, n_terms = len(bags), sum(len(plain_terms(t)) for _, t in docs)
    weights = [
        floor(1000 * log((2 * n_docs + 2) / (2 * sum(w in b for b in bags) + 1))) for w in terms.words
    ]
    statistics = lexical.Statistics(n_docs, n_terms, lexical.np.array(weights))

    class Shared:
        value = terms

    (batch,) = lexical._ranking(Shared, statistics, 10)(iter(_batches(docs, 7)))
    rows = Counter((items[r["item_row"]][0], r["doc_id"], r["score"]) for r in batch.to_pylist())
    assert rows == Counter((i, d, s) for (i, _, d, s), n in expected.items() for _ in range(n))


def _batches(docs, size=1000):
    pa = lexical.pa
    for at in range(0, len(docs), size):
        ids, texts = zip(*docs[at : at + size], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])


def _terms_of(items):
    np = lexical.np
    rows = sorted(
        (term, row, times)
        for row, (_, text) in enumerate(items)
        for term, times in Counter(plain_terms(text)).items()
    )
    words, first = np.unique(np.array([r[0] for r in rows], object), return_index=True)
    item_rows, numbers = np.unique(np.array([r[1] for r in rows]), return_inverse=True)
    return lexical.Terms(list(words), np.append(first, len(rows)), numbers, np.array([r[2] for r in rows]), item_rows)


def test_empty_tables_and_clashing_names(spark, documents, clashing):
    items = spark.createDataFrame([(1, "alpha beta")], ITEMS)
    assert lexical.search(documents([]), items).count() == 0
    assert lexical.search(documents([(1, "alpha")]), spark.createDataFrame([], ITEMS)).count() == 0
    rows = documents([(1, "alpha x y z"), (2, "other words")])
    expected = plain_search([(1, "alpha x y z"), (2, "other words")], [(1, "alpha beta")])
    wide = clashing(items.withColumnRenamed("item_id", "i")).withColumnRenamed("i", "n")
    assert found_by(lexical.search(clashing(rows), wide, item_id="n")) == expected
    assert lexical.search(rows, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_terms_that_all_documents_hold_still_rank(spark, documents):
    """A weight of zero adds nothing; documents with a score of 0 aren't listed."""
    docs = [(n, "common " * (n + 1) + ("rare" if n == 4 else "")) for n in range(400)]
    items = [(1, "common"), (2, "common rare")]
    found = found_by(lexical.search(documents(docs), spark.createDataFrame(items, ITEMS)))
    assert found == plain_search(docs, items)
