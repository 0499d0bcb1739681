import random
import re
from collections import Counter

import pytest

from orderloom.llm import collocations
from orderloom.llm.scratch import settle

DOCS = "doc_id bigint, text string, lang string, phrase string, n string, key string"


@pytest.fixture(autouse=True)
def _settled(spark):
    settle(spark)


def _counts(rows, longest):
    counts, totals = Counter(), Counter()
    for _, text, lang in rows:
        tag = "und" if lang is None else lang
        text = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            totals[tag] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[tag, tuple(words[i : i + size])] += 1
    return counts, totals


def _plain(rows, longest=3, least=10, share=50, top=2000):
    counts, totals = _counts(rows, longest)
    found = {}
    for (lang, words), a in counts.items():
        if len(words) > 1 and a >= least:
            cuts = []
            for k in range(1, len(words)):
                l, r = counts[lang, words[:k]], counts[lang, words[k:]]
                cuts.append((1_000_000 * a * a // (l * r), k, l, r))
            score, _, l, r = min(cuts)
            found[lang, words] = (a, l, r, score)
    inner = set()
    for (lang, words), (longer, *_) in found.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                part = lang, words[i : i + size]
                if part in found and 100 * longer >= share * found[part][0]:
                    inner.add(part)
    out = []
    for lang in {g for g, _ in found}:
        rows = [(-score, -a, " ".join(w).encode(), l, r) for (g, w), (a, l, r, score) in found.items() if g == lang and (g, w) not in inner]
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def _found(spark, rows, partitions=5, **options):
    df = spark.createDataFrame([(i, t, g, "taken", None, "k") for i, t, g in rows], DOCS).repartition(partitions)
    return sorted(map(tuple, collocations.collocations(df, **options).collect()))


def _texts(seed, n):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "a", *(f"w{i}" for i in range(40)), "Été", "X", "new york", "\x0b", "c'est"]
    weights = [30, 20, 20, *([2] * 40), 3, 3, 3, 1, 3]
    phrases = ["strong tea", "of the w1", "to be or not to be", "a a a", "The END", "w1 w2\tw3"]
    out = []
    for i in range(n):
        words = [rng.choice(phrases) if rng.random() < 0.2 else rng.choices(vocabulary, weights)[0] for _ in range(rng.randint(0, 60))]
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n"]) for w in words)
        out.append((rng.choice([None, 1, i]), rng.choice([text, text, text, None]) if i % 9 == 0 else text, rng.choice(["en", "fr", None, "", "und"])))
    return out


def test_equals_brute_force(spark):
    rows = _texts(2, 300)
    rows += rows[:40]
    expected = _plain(rows)
    assert len(expected) > 50 and any(" " in r[2] and r[2].count(" ") == 2 for r in expected)
    assert _found(spark, rows) == expected


@pytest.mark.parametrize("least", [1, 4])
def test_other_bounds_and_longer_phrases(spark, least):
    rows = _texts(4, 60)
    options = {"longest": 4, "least": least, "share": 80, "top": 25}
    assert _found(spark, rows, **options) == _plain(rows, **options)


def test_the_sample_never_decides_the_result(spark, monkeypatch):
    """No document sampled, or a filter so small that it takes nearly all phrases for proposed: the same phrases."""
    rows = _texts(6, 120)
    expected = _plain(rows)
    passes = []
    counted = collocations._counts
    monkeypatch.setattr(collocations, "_counts", lambda *a, **k: passes.append(a) or counted(*a, **k))
    monkeypatch.setattr(collocations, "SAMPLE_ONE_IN", 10**9)
    assert _found(spark, rows) == expected
    assert len(passes) > 3, "the sample, and passes until no phrase of the border fails"
    del passes[:]
    monkeypatch.setattr(collocations, "SAMPLE_LEAST", 1)
    monkeypatch.setattr(collocations, "SAMPLE_ONE_IN", 1)
    monkeypatch.setattr(collocations, "frequent_phrases", lambda d, longest, least, f=collocations.frequent_phrases: f(d, longest, least, 64))
    assert _found(spark, rows) == expected
    assert len(passes) == 2, "all that occurs is proposed"


def test_long_texts_are_cut_at_ends_of_pieces(spark, monkeypatch):
    monkeypatch.setattr(collocations, "FOLD_BYTES", 100)
    rows = [(1, "a b, c d. " * 400, "en"), (2, "no end of a piece in here " * 300, "en"), (3, "", "en"), (4, None, None)]
    assert _found(spark, rows) == _plain(rows)


def test_empty_tables(spark):
    assert _found(spark, []) == []
    assert _found(spark, [(1, None, "en"), (2, "", None), (3, " .,\n", "fr")]) == []


def test_products_beyond_64_bits(spark, monkeypatch):
    big = 3_000_000_019
    rows = [("en", 0, "", 10 * big), ("en", 1, "x", big), ("en", 1, "y", big + 2), ("en", 2, "x y", big - 1)]
    given = spark.createDataFrame(rows, "lang string, size int, phrase string, n bigint")
    monkeypatch.setattr(collocations, "frequent_phrases", lambda *a: given)
    docs = spark.createDataFrame([], DOCS)
    expected = 1_000_000 * (big - 1) ** 2 // (big * (big + 2))
    assert [tuple(r) for r in collocations.collocations(docs).collect()] == [("en", 1, "x y", big - 1, big, big + 2, 10 * big, expected)]


def test_wide_slabs_are_folded_without_packing():
    import numpy as np

    ids = [np.array([5, 1, 5, 1 << 40]), np.array([2, 2, 2, 0])]
    packed, wide = collocations._distinct(ids, 1 << 20)[1], collocations._distinct(ids, 1 << 41)
    assert sorted(packed.tolist()) == [1, 1, 2] and wide[1].tolist() == [1, 2, 1] and wide[0][0].tolist() == [1, 5, 1 << 40]
