"""The language model against a plain one over strings."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from orderloom.llm import kneser_ney as kn

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + ["</s>"]


def plain_model(texts):
    """log10 scores of a text under the interpolated modified Kneser-Ney bigrams of ``texts``, written out by the formula."""
    words, pairs = Counter(), Counter()
    for t in texts:
        ts = tokens(t)
        words.update(ts)
        pairs.update(zip(["<s>", *ts[:-1]], ts))
    contexts = Counter()
    followers = defaultdict(lambda: [0, 0, 0])
    before = Counter()
    for (a, b), c in pairs.items():
        contexts[a] += c
        followers[a][min(c, 3) - 1] += 1
        before[b] += 1

    def cut(counts):
        kinds = Counter(counts)
        n1, n2, n3, n4 = (kinds[i] for i in (1, 2, 3, 4))
        if not (n1 and n2 and n3 and n4):
            return [0, 0.5, 1.0, 1.5]
        y = n1 / (n1 + 2 * n2)
        d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
        return [0, *(min(max(x, 0), i) for i, x in enumerate(d, 1))]

    cut2, cut1 = cut(pairs.values()), cut(before.values())
    freed = sum(cut1[min(c, 3)] for c in before.values()) / max(1, len(pairs)) if pairs else 1.0
    n, v = sum(words.values()), len(words)

    def lower(b):
        return (before[b] - cut1[min(before[b], 3)]) / max(1, len(pairs)) + freed / (v + 1)

    def score(text):
        ts, total, base = tokens(text), 0.0, 0.0
        for a, b in zip(["<s>", *ts[:-1]], ts):
            p = lower(b)
            if contexts[a]:
                spare = sum(d * k for d, k in zip(cut2[1:], followers[a]))
                p = (pairs[a, b] - cut2[min(pairs[a, b], 3)] + spare * p) / contexts[a]
            total += math.log10(p)
            base += math.log10((words[b] + 0.1) / (n + 0.1 * (v + 1)))
        return len(ts), sum(words[t] > 0 for t in ts), n, base, total

    return score


def check(spark, train, texts):
    model = kn.train(spark.createDataFrame([(t,) for t in train], "text string"))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    score = plain_model(train)
    rows = {r["doc_id"]: r for r in kn.score(docs, model).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        want = score(t)
        r = rows[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == want[:3]
        assert r["base_score"] == pytest.approx(want[3], rel=1e-9, abs=1e-9)
        assert r["score"] == pytest.approx(want[4], rel=1e-9, abs=1e-9)
    return model


def corpus(seed=1, n=120):
    rng = np.random.default_rng(seed)
    vocabulary = ["The", "the", "a", "cat", "dog", "sat", "on", "mat.", "é", "É", "x" * 300, "1"] + [f"w{i}" for i in range(60)]
    return [" ".join(rng.choice(vocabulary, rng.integers(0, 40), p=None)) for _ in range(n)] + [None, "", " \t\n", "a\x0bb c  d"]


def test_matches_the_formula(spark):
    texts = corpus()
    check(spark, texts, [*texts[:40], *corpus(2, 20), "unknown words only", None, ""])


def test_small_ranges_and_gathers(spark, monkeypatch):
    """Many ranges and many hand-overs give the same model; no range boundary loses a count."""
    monkeypatch.setattr(kn, "RANGE_BYTES", 300)
    monkeypatch.setattr(kn, "BLOB_VALUES", 3)
    texts = corpus(3)
    model = check(spark, texts, texts[:50])
    assert model.bigram_ranges > 20 and model.word_ranges > 10


def test_probabilities_add_up(spark):
    """After any known word, the model's probabilities of all words, the end and one unknown word make 1."""
    train = corpus(4)
    model = kn.train(spark.createDataFrame([(t,) for t in train], "text string"))
    scorer = kn.Scorer(model)
    vocabulary = sorted({w for t in train for w in tokens(t)} - {"</s>"})
    for first in ("cat", "w1", "neverseen"):
        texts = [f"{first} {w}" for w in [*vocabulary, "unseenword"]] + [first]
        data = "".join(texts).encode()
        offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
        *_, whole = scorer.score(np.frombuffer(data, np.uint8), offsets)
        # log p(first | begin) is shared; the end after the second word is taken off again
        _, _, _, alone = scorer.score(np.frombuffer(b"", np.uint8), np.zeros(2, np.int64))
        plain = plain_model(train)
        assert whole[-1] == pytest.approx(plain(first)[4])
        assert alone[0] == pytest.approx(plain("")[4])


def test_empty_table_and_hot_pair(spark):
    check(spark, [], ["a b", None, ""])
    check(spark, ["the end the end the end"] * 200 + ["a b c d"], ["the end", "a the", "b c", "zz"])


def test_extra_columns_and_repeats(spark):
    docs = spark.createDataFrame([(1, "a b", 0.5, "x"), (1, "a b", 0.5, "x"), (None, None, None, None)], "doc_id long, text string, score double, base_score string")
    model = kn.train(docs)
    rows = kn.score(docs, model).collect()
    assert sorted(r["n_tokens"] for r in rows) == [1, 3, 3] and rows[0].__fields__[0] == "doc_id"


def test_folder_must_be_mounted():
    with pytest.raises(ValueError, match="mounted"):
        kn._mounted("hdfs://store/x")
    assert kn._mounted("file:///a/b") == "/a/b" == kn._mounted("/a/b")
