"""Held-out accuracy and odd input of language identification."""

from __future__ import annotations

import random

import zstandard
from pyspark.sql import functions as F

from perimeter.llm import language

SAMPLES = {
    "en": "the of and to in that it was for on with as his they at be this from have or by one had not",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an",
}


def _texts(count: int) -> list[tuple]:
    rng = random.Random(4)
    rows = []
    for n in range(count):
        lang = ("en", "de")[n % 2]
        rows.append((n, " ".join(rng.choices(SAMPLES[lang].split(), k=60)), lang))
    return rows


def _by_id(found):
    return {r["doc_id"]: (r["lang_pred"], r["score"], r["rejected"]) for r in found.collect()}


def test_held_out(documents):
    rows = documents(_texts(120))
    held_out = language.remainder(F.col("doc_id")) == 1
    found = language.identify(rows, language.learn(rows.where(~held_out)))
    scores = found.where(held_out).select("lang", "lang_pred", "rejected").collect()
    assert len(scores) > 20
    assert all(r["lang"] == r["lang_pred"] and not r["rejected"] for r in scores)


def test_odd_texts(documents, clashing):
    learned = language.learn(documents(_texts(40)))
    long = "der die und das " * 40_000
    odd = [(1, None), (2, ""), (3, "123 %%% \n"), (4, long), (5, "the of\x00and that was"), (None, "the of and that was")]
    found = _by_id(language.identify(clashing(documents(odd)), learned))
    assert found[1] == found[2] == found[3] == (language.UNKNOWN, 0.0, True)
    assert found[4][0] == "de" and found[5][0] == found[None][0] == "en"
    assert all(0 <= score <= 1 for _, score, _ in found.values())


def test_ties_are_rejected(documents):
    same = documents([(n, "lorem ipsum dolor sit amet", lang) for n, lang in enumerate(["a", "b"] * 3)])
    found = _by_id(language.identify(same, language.learn(same)))
    assert all(score == 0 and rejected for _, score, rejected in found.values())


def test_nothing_learned(documents):
    empty = language.learn(documents([(1, "text", None), (2, None, "en")]))
    assert _by_id(language.identify(documents([(1, "text")]), empty)) == {1: ("und", 0.0, True)}
    assert language.identify(documents([]), empty).count() == 0


def _encoded(text, languages):
    """The choice for one text with new encoders for every block: a plain loop over the definition."""
    word, words = "", []
    for c in text + " ":
        if c.isalpha():
            word += c
        elif word:
            words.append(word.lower())
            word = ""
    if not words:
        return language.UNKNOWN, 0.0
    data = f" {' '.join(words)} ".encode()
    sizes = {}
    for name, content in languages:
        size = 0
        for at in range(0, len(data), language.BLOCK):
            raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            form = zstandard.ZstdCompressionParameters(**language.ENCODING)
            encoder = zstandard.ZstdCompressor(dict_data=raw, compression_params=form)
            size += len(encoder.compress(language.HEAD + data[at : at + language.BLOCK]))
        sizes[name] = size
    names = [name for name, _ in languages]
    best = min(names, key=lambda n: (sizes[n], names.index(n)))
    other = min(sizes[n] for n in names if n != best)
    return best, max(0.0, 1 - sizes[best] / other)


def test_equals_plain_encoding(documents):
    rows = _texts(160) + [(200 + n, t, None) for n, t in enumerate(["", "12 - 3", "the", "Für das Haus 7!", "of the " * 2_000])]
    learned = language.learn(documents(rows))
    found = _by_id(language.identify(documents([r[:2] for r in rows]), learned))
    for doc_id, text, _ in rows:
        name, score = _encoded(text, learned.content)
        assert found[doc_id][0] == name and abs(found[doc_id][1] - score) < 1e-12


def test_only_text_and_language_teach(documents):
    """Other ids, another order and copies give the same dictionaries."""
    rows = _texts(300)
    other = [(9_000 - 7 * i, text, lang) for i, text, lang in reversed(rows)]
    learned = language.learn(documents(rows))
    assert language.learn(documents(other)) == learned
    hot = language.learn(documents(rows + [rows[0]] * 400))
    assert dict(hot.content) == dict(learned.content)


def test_marks_stay_with_their_letters():
    assert language.letters("किताब, 12") == " किताब ".encode()
