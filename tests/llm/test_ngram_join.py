"""The n-gram join against all pairs compared by hand."""

import random
import re

import pytest

from orderloom.llm import ngram_join as nj
from orderloom.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width):
    ws = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not ws:
        return frozenset()
    return frozenset(tuple(ws[i : i + width]) for i in range(max(1, len(ws) - width + 1)))


def by_hand(rows, width, percent):
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted((str(i), len(sets[k]), str(least.get(find(k)))) for k, (i, _) in enumerate(rows))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "r") for i, t in rows], "doc_id long, text string, n int, row string")


def check(spark, rows, width=4, percent=85):
    got = nj.similar_groups(frame(spark, rows).repartition(6), width, percent).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == by_hand(rows, width, percent)


def near_copies(seed, n=90):
    """Templates with edits of all strengths, so that overlaps lie on both sides of the bound; copies; short and odd texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["The", "the", "É", "é"]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    templates = [[rng.choice(vocabulary) for _ in range(rng.choice([6, 30, 120, 200]))] for _ in range(8)]
    texts = []
    for _ in range(n):
        words = list(rng.choice(templates))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5, 9])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        if rng.random() < 0.2:
            words = words[: len(words) - rng.randrange(1, 6)]
        if rng.random() < 0.3:
            words = words + passage
        texts.append(rng.choice([" ", "\n", "  "]).join(words))
    texts += [None, "", " \t\n", "one", "One", "one two", "one two three", "ONE two  three", "one two three four", "x\x0bone two"]
    texts += texts[:5]
    ids = rng.sample(range(-1000, 100_000), len(texts))
    return list(zip(ids, texts, strict=True))


@pytest.mark.parametrize("seed", [1, 2])
def test_all_links_are_found(spark, seed):
    check(spark, near_copies(seed))


def test_many_ranges_tiles_and_hot_ngrams(spark, monkeypatch):
    monkeypatch.setattr(nj, "RANGE_BYTES", 3000)
    monkeypatch.setattr(nj, "GATHER_BYTES", 5000)
    monkeypatch.setattr(nj, "BLOB_ENTRIES", 50)
    monkeypatch.setattr(nj, "TILE_ENTRIES", 400)
    monkeypatch.setattr(nj, "HOT_SHARE", 20)
    monkeypatch.setattr(nj, "HOT_AT_LEAST", 2)
    rows = near_copies(3, 120)
    check(spark, rows)
    check(spark, rows, 5, 80)


def test_chain_of_links_reaches_the_smallest_id(spark):
    words = [f"w{i}" for i in range(100)]
    rows = [(500 - k, " ".join([f"v{j}" for j in range(k)] + words[k:])) for k in range(0, 60, 4)]
    check(spark, rows, 2, 85)
    assert by_hand(rows, 2, 85)[0][2] == "444"


def test_empty_nulls_and_repeats(spark):
    assert nj.similar_groups(frame(spark, []), 4, 85).count() == 0
    check(spark, [(1, None), (2, ""), (None, "a b c d e"), (None, "a b c d e"), (3, "z")])
    check(spark, [(7, "a b c d e f g"), (7, "a b c d e f g"), (9, "a b c d e f g"), (None, "a b c d e f g")])


def test_drop_similar_keeps_rows_whole(spark):
    rows = [(5, "a b c d e f g"), (2, "A b c d e f g"), (2, "a B c d e f g"), (8, "q r s"), (9, None), (10, ""), (None, "a b c d e f g"), (11, "q r s t")]
    kept = nj.drop_similar(frame(spark, rows)).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["10", "11", "2", "8", "9", "None"]
    assert kept[0].__fields__ == ["doc_id", "text", "n", "row"]
    assert nj.drop_similar(frame(spark, [])).count() == 0


def test_drop_similar_tells_texts_of_a_repeated_id_apart(spark):
    near, far, other = "a b c d e f g", "q r s t u v w", "h i j k l m n"
    rows = [(3, near), (5, far), (5, near.upper()), (5, other), (5, other), (5, other.upper()), (7, other), (8, far), (9, None), (9, near), (9, "")]
    kept = nj.drop_similar(frame(spark, rows).repartition(4)).collect()
    assert sorted((r["doc_id"], (r["text"] or "").lower()) for r in kept) == [(3, near), (5, other), (5, far), (9, ""), (9, "")]


def test_components_of_long_and_wide_graphs(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)] + [(5000, 5000), (7000, 6000)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long").repartition(7)).collect()}
    want = {i: 0 for i in range(1, 301)} | {1000 + i: 1000 for i in range(1, 400)} | {7000: 6000}
    assert got == want
