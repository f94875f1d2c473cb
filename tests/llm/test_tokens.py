"""Rollups against a recount of what is left; repeated and broken-off commits."""

from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from perimeter.llm import registry, tokens

CHANGES = "doc_id long, version string, source string, lang string, tokens long"


@pytest.fixture
def rollup(spark, tmp_path):
    return tokens.Rollup(spark, str(tmp_path / "rollup"))


def _totals(rollup):
    return {(r["source"], r["lang"], r["version"]): (r["documents"], r["tokens"]) for r in rollup.totals().collect()}


def _brute(batches):
    state, loose = {}, []
    for rows in batches:
        by_key = defaultdict(list)
        for row in rows:
            if row[0] is None:
                loose += [row] if row[4] is not None else []
            else:
                by_key[row[:2]].append(row)
        for key, changes in by_key.items():
            state.pop(key, None)
            counted = [c for c in changes if c[4] is not None]
            if counted:
                state[key] = max(counted, key=lambda c: (c[4], c[2] or "", c[3] or ""))
    found = defaultdict(lambda: [0, 0])
    for _, version, source, lang, count in [*state.values(), *loose]:
        found[source, lang, version][0] += 1
        found[source, lang, version][1] += count
    return {k: tuple(v) for k, v in found.items()}


def _batches():
    first = [(n, "v1", "ab"[n % 2], "en", n) for n in range(40)] + [(n, "v2", "a", None, 3 * n) for n in range(40)]
    second = [(n, "v1", "b", "de", 7) for n in range(0, 40, 4)] + [(n, "v1", None, "en", None) for n in range(1, 40, 4)]
    third = [(None, "v1", "a", "en", 5)] * 3 + [(99, "v1", "a", "en", None), (2, "v1", "a", "en", 0), (2, "v1", "a", "en", 9)]
    return [first, second, third, [], [(n, "v1", None, None, None) for n in range(40)]]


def test_totals_follow_changes(spark, rollup):
    assert _totals(rollup) == {}
    done = []
    for n, rows in enumerate(_batches()):
        done.append(rows)
        assert rollup.commit(f"batch-{n}", spark.createDataFrame(rows, CHANGES))
        assert _totals(rollup) == _brute(done)


def test_commits_are_idempotent(spark, rollup):
    first, second, *_ = _batches()
    for rows in (first, second):
        name = "one" if rows is first else "two"
        assert rollup.commit(name, spark.createDataFrame(rows, CHANGES))
        assert not rollup.commit(name, spark.createDataFrame(rows, CHANGES))
    assert not rollup.commit("one", spark.createDataFrame(first, CHANGES))
    assert _totals(rollup) == _brute([first, second]) and rollup.batches() == ["one", "two"]


@pytest.mark.parametrize("lost", ["ledger", "deltas"])
def test_broken_off_commit_is_finished(spark, rollup, tmp_path, lost):
    first, second, *_ = _batches()
    rollup.commit("one", spark.createDataFrame(first, CHANGES))
    rollup.commit("two", spark.createDataFrame(second, CHANGES))
    (tmp_path / "rollup" / "deltas" / "batch=two" / "_SUCCESS").unlink()
    if lost == "ledger":
        (tmp_path / "rollup" / "ledger" / "batch=two" / "_SUCCESS").unlink()
    assert rollup.batches() == ["one"] and _totals(rollup) == _brute([first])
    assert rollup.commit("two", spark.createDataFrame(second, CHANGES))
    assert _totals(rollup) == _brute([first, second])


def test_bad_batch_id(spark, rollup):
    with pytest.raises(ValueError):
        rollup.commit("../x", spark.createDataFrame([], CHANGES))


def test_token_counts(documents, clashing):
    import tiktoken

    texts = [None, "", "Hello  world's 123 été\n", "<|endoftext|>", "a" * 30_000, " " * 2_000]
    version = "byte-bpe-50k"
    ranks = tokens.load_ranks(tokens.VERSIONS[version])
    coder = tiktoken.Encoding("plain", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = tokens.counts(clashing(documents(list(enumerate(texts)))), version).collect()
    for row in found:
        text = texts[row["doc_id"]]
        assert row["tokens"] == (len(coder.encode_ordinary(text)) if text else 0)
    # A round trip: the tokens are those of the whole text.
    assert all(coder.decode(coder.encode_ordinary(t)) == t for t in texts if t)


def test_repeated_lines(documents):
    rows = [(1, "a\nb\na\nc"), (2, "a\nb"), (3, None), (4, "")]
    found = tokens.without_repeated_lines(documents(rows)).select("doc_id", F.col("text")).collect()
    assert [tuple(r) for r in found] == [(1, "a\nb\nc")]


def test_registered_query_counts_every_row(spark, documents, monkeypatch):
    """Repeated and missing ids: each row counts, is revised, and goes if its id is toxic."""
    import tiktoken

    rows = [(1, "a b\na b\nc", "en", "s"), (1, "a b\na b\nc", "en", "s"), (1, "other text", None, "s"), (None, "x\nx", "en", None)]
    rows += [(None, "x\nx", "en", None), (2, "toxic words", "en", "s"), (2, "more of it", "de", "s"), (3, None, "en", "s")]
    labels = spark.createDataFrame([(2, 0, 1), (1, 1, 0)], "doc_id long, quality int, toxic int")
    tables = {"documents": documents(rows), "labels": labels}
    monkeypatch.setattr(registry, "read_table", lambda spark, sf_dir, name: tables[name])
    expected = {}
    for version, file in tokens.VERSIONS.items():
        coder = tiktoken.Encoding("plain", pat_str=tokens.PATTERN, mergeable_ranks=tokens.load_ranks(file), special_tokens={})
        for doc_id, text, lang, source in rows:
            if doc_id != 2:
                text = "\n".join(dict.fromkeys((text or "").split("\n")))
                n, total = expected.get((source, lang, version), (0, 0))
                expected[source, lang, version] = (n + 1, total + len(coder.encode_ordinary(text)))
    found = registry.op8_tokens(spark, "").collect()
    assert {(r["source"], r["lang"], r["version"]): (r["documents"], r["tokens"]) for r in found} == expected
