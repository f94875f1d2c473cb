"""The Kneser-Ney model against the textbook recursion; thresholds."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest

from perimeter.llm import quality
from perimeter.llm.shared import Scratch


class Plain:
    """Interpolated modified Kneser-Ney over characters, straight from its definition."""

    def __init__(self, texts):
        self.counts = {4: Counter()}
        for text in texts:
            padded = "\x02" * 3 + text
            for n in range(len(text)):
                self.counts[4][padded[n : n + 4]] += 1
        for order in (3, 2, 1):
            self.counts[order] = Counter({g: 0 for g in {x[1:] for x in self.counts[order + 1]}})
            for x in self.counts[order + 1]:
                self.counts[order][x[1:]] += 1
        self.discounts, self.totals, self.followers = {}, defaultdict(Counter), defaultdict(lambda: defaultdict(list))
        for order, counts in self.counts.items():
            n1, n2, n3, n4 = (max(sum(c == k for c in counts.values()), 1) for k in (1, 2, 3, 4))
            y = n1 / (n1 + 2 * n2)
            self.discounts[order] = (
                min(max(1 - 2 * y * n2 / n1, 0.05), 0.95),
                min(max(2 - 3 * y * n3 / n2, 0.05), 1.9),
                min(max(3 - 4 * y * n4 / n3, 0.05), 2.9),
            )
            for g, c in counts.items():
                self.totals[order][g[:-1]] += c
                self.followers[order][g[:-1]].append(c)
        self.units = len(self.counts[1]) + 1

    def p(self, gram):
        order = len(gram)
        if not order:
            return 1 / self.units
        context, lower = gram[:-1], self.p(gram[1:])
        total = self.totals[order][context]
        if not total:
            return lower
        d = self.discounts[order]
        c = self.counts[order][gram]
        held = sum(d[min(f, 3) - 1] for f in self.followers[order][context])
        return (max(c - d[min(c, 3) - 1], 0) if c else 0) / total + held / total * lower

    def perplexity(self, text):
        padded = "\x02" * 3 + text
        logs = [math.log(self.p(padded[n : n + 4])) for n in range(len(text))]
        return math.exp(-sum(logs) / len(logs))


def _corpus():
    rng = random.Random(7)
    words = ["the", "of", "and", "water", "été", "\U0001f600"]
    good = [(n, " ".join(rng.choices(words, k=rng.randrange(5, 40))), "ab"[n % 2]) for n in range(80)]
    noise = [(100 + n, "".join(rng.choices("qxz#%&19", k=80)), "ab"[n % 2]) for n in range(20)]
    return good, noise


def _labels(spark, ids):
    return spark.createDataFrame([(i, 1, 0) for i in ids], "doc_id long, quality int, toxic int")


def test_perplexities_and_thresholds(spark, documents, clashing, monkeypatch):
    monkeypatch.setattr(quality, "BLOCK_BYTES", 2_000)
    good, noise = _corpus()
    trusted = [r[0] for r in good if r[0] < 40]
    plain = Plain([r[1] for r in good if r[0] < 40])
    # Outside the basic plane a character is two units; the plain model sees them as such, too.
    found = quality.classify(clashing(documents(good + noise)), _labels(spark, trusted), quantile=1.0).collect()
    for row in found:
        text = next(r[1] for r in good + noise if r[0] == row["doc_id"])
        units = text.encode("utf-16-le")
        text = "".join(chr(int.from_bytes(units[n : n + 2], "little")) for n in range(0, len(units), 2))
        assert row["units"] == len(text)
        if "\U0001f600" not in "".join(r[1] for r in good):
            assert row["perplexity"] == pytest.approx(plain.perplexity(text), rel=1e-4)
        assert row["keep"] == (row["perplexity"] <= row["threshold"])
    assert not any(r["keep"] for r in found if r["doc_id"] >= 100)
    assert all(r["keep"] for r in found if r["doc_id"] in trusted)


def test_equals_the_definition(spark, documents):
    rng = random.Random(2)
    rows = [(n, "".join(rng.choices("abcd é", k=rng.randrange(1, 60)))) for n in range(30)]
    plain = Plain([t for n, t in rows if n < 20])
    found = quality.classify(documents(rows), _labels(spark, range(20))).collect()
    for row in found:
        assert row["perplexity"] == pytest.approx(plain.perplexity(dict(rows)[row["doc_id"]]), rel=1e-4)


def test_probabilities_add_up(spark, documents):
    levels = quality.train(documents([(1, "abab acab ba"), (2, "bacca")]), Scratch(spark, "test"))
    units = "abc \x05"  # the last one stands for all that is unknown
    for context in ("aba", "xyz", "\x02\x02\x02"):
        grams = [int.from_bytes((context + u).encode("utf-16-be"), "big") for u in units]
        frame = spark.createDataFrame([(g,) for g in grams], "gram long")
        total = sum(math.exp(r["log_p"]) for r in quality.probabilities(frame, levels).collect())
        assert total == pytest.approx(1, rel=1e-5)


def test_odd_rows(spark, documents):
    rows = [(1, None, "a"), (2, "", "a"), (3, "ab", None), (4, "ab" * 60_000, "a"), (5, "ab", "a"), (5, "ab", "a"), (None, "zz", "a")]
    found = quality.classify(documents(rows), _labels(spark, [5, None])).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[1]["perplexity"] is None and not by_id[1]["keep"] and not by_id[2]["keep"]
    assert by_id[3]["threshold"] is None and by_id[3]["keep"] and by_id[5]["keep"] and not by_id[None]["keep"]
    assert quality.classify(documents([]), _labels(spark, [1])).count() == 0
    assert quality.classify(documents(rows[2:4]), _labels(spark, [])).where("keep").count() == 2


def test_toxic_rows_are_not_trusted(spark, documents):
    rows = [(1, "abab acab", "a"), (2, "baca", "a"), (3, "zzzz qqqq", "a")]
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, None), (3, 1, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")
    found = {r["doc_id"]: r for r in quality.classify(documents(rows), labels).collect()}
    assert found[1]["trusted"] and found[2]["trusted"] and not found[3]["trusted"]
    assert not found[3]["keep"]
