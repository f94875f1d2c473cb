"""Hits of the positional index against a walk over all windows."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from perimeter.llm import decontamination as D

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return TERM.findall(lowered)


def _brute(rows, items):
    windows = {}
    for item_id, text in items:
        words = _words(text)
        size = min(10, len(words))
        for s in range(len(words) - size + 1):
            if size:
                windows.setdefault(tuple(words[s : s + size]), set()).add(item_id)
    found = []
    for doc_id, text, *_ in rows:
        words, hit, names = _words(text), set(), set()
        for size in {len(w) for w in windows}:
            for s in range(len(words) - size + 1):
                if (window := tuple(words[s : s + size])) in windows:
                    hit |= set(range(s, s + size))
                    names |= {str(i) for i in windows[window] if i is not None}
        found.append((doc_id, len(words), len(hit), sorted(names), bool(hit)))
    return sorted(found, key=str)


def _found(spark, frame, items):
    table = spark.createDataFrame(items, "item_id long, text string")
    rows = D.decontaminate(frame, table).collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in rows), key=str)


def _corpus():
    rng = random.Random(9)
    vocabulary = [f"{a}{b}" for a in "abcdeé" for b in "xyz1"]
    items = [(n, " ".join(rng.choices(vocabulary, k=rng.choice([3, 9, 10, 11, 25, 40])))) for n in range(12)]
    items += [(12, items[0][1]), (13, "the " * 14)]
    rows = []
    for n in range(60):
        words = rng.choices(vocabulary, k=rng.randrange(0, 60))
        if n % 2:
            item = rng.choice(items)[1].split()
            a = rng.randrange(len(item))
            words[5:5] = item[a : a + rng.randrange(1, 30)]
        rows.append((n, rng.choice([" ", ", ", "\n- "]).join(words).upper() if n % 3 else " ".join(words)))
    rows += [(100, "the " * 30), (101, "the " * 9), (102, items[5][1])]
    return rows, items


def test_equals_brute_force(spark, documents):
    rows, items = _corpus()
    assert _found(spark, documents(rows), items) == _brute(rows, items)


def test_odd_rows(spark, documents, clashing):
    items = [(1, None), (2, ""), (3, "..."), (4, "É école"), (None, "no id here"), (6, "a b c"), (6, "d e f")]
    rows = [(1, None), (2, ""), (3, "é École"), (4, "É école"), (5, "no ID here a b c"), (5, "d e f"), (None, "a b c")]
    rows += [(7, "a b " * 50_000 + "c"), (7, "a b " * 50_000 + "c"), (8, "x\x00a b\tc")]
    assert _found(spark, clashing(documents(rows)), items) == _brute(rows, items)
    assert _found(spark, documents([]), items) == []
    assert _found(spark, documents(rows[:3]), []) == _brute(rows[:3], [])


def test_near_matches(spark, documents):
    item = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, "two one four three six five eight seven ten nine twelve eleven"), (2, "one two three"), (3, item)]
    table = spark.createDataFrame([(5, item)], "item_id long, text string")
    found = {r["doc_id"]: (r["contaminated"], r["near_items"]) for r in D.decontaminate(documents(rows), table).collect()}
    assert found == {1: (False, ["5"]), 2: (False, []), 3: (True, [])}


def test_no_python_on_executors(spark, documents):
    table = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    plan = D.decontaminate(documents([(1, "a b c")]), table)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan.replace("LocalTableScan", "")


def test_words_are_cut_not_matched(spark):
    texts = ["", None, " a", "a ", "..A1b--É x\x00Z9 ", "Zoë's naïve 10-K", "\U0001f600 x\U0001f600y", "\x7f\x80 Q", "{[`~A^"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", D.terms(F.col("text")).alias("w"))
    assert [r["w"] for r in rows.collect()] == [_words(t) for t in texts]
    assert "regexp_extract_all" not in rows._jdf.queryExecution().toString()
