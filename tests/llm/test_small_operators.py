"""Exact dedup, shard tree, mixing and language ID against plain Python, with nulls, ties, repeats and clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import exact_dedup, langid, mixing, shard_tree

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ── exact dedup ──


def copies(n=300):
    rng = random.Random(1)
    texts = [f"text {i} " + "x" * rng.randrange(50) for i in range(60)] + ["", None, "é", "é", "hot"]
    return [(i, rng.choice(texts) if rng.random() < 0.7 else "hot") for i in rng.sample(range(-500, 5000), n)]


def copy_frame(spark, rows):
    return spark.createDataFrame([(i, t, True, "s", 1) for i, t in rows], "doc_id long, text string, kept boolean, digest string, n int").repartition(5)


@pytest.mark.parametrize("table_bytes", [exact_dedup.TABLE_BYTES, 500, 1])
def test_text_classes(spark, table_bytes):
    rows = copies()
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    want = sorted((i, max(groups[t or ""]), len(groups[t or ""]), i == max(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)
    got = exact_dedup.text_classes(copy_frame(spark, rows), table_bytes=table_bytes).collect()
    assert sorted(map(tuple, got)) == want
    kept = exact_dedup.drop_copies(copy_frame(spark, rows), table_bytes=table_bytes)
    assert kept.columns == ["doc_id", "text", "kept", "digest", "n"]
    texts = dict(rows)
    found = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert found == {max(g): texts[max(g)] for g in groups.values()} and kept.count() == len(groups)


def test_grace_spills_and_keeps_every_row():
    rng = random.Random(2)
    groups = [(f"t{rng.randrange(500)}".encode() * 5, 1, i) for i in range(4000)]
    found = list(exact_dedup.grace(((t, hashlib.sha256(t).digest(), n, i) for t, n, i in groups), table_bytes=700))
    want = defaultdict(lambda: [0, -1])
    for t, n, i in groups:
        want[t][0] += n
        want[t][1] = max(want[t][1], i)
    assert len(found) == len(want) and {t: [n, i] for t, _, n, i in found} == want


def test_dedup_of_null_ids_and_repeats(spark):
    rows = [(None, "a"), (1, "a"), (None, "b"), (2, "c"), (2, "c")]
    got = sorted(((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"]) for r in exact_dedup.text_classes(copy_frame(spark, rows)).collect()))
    assert got == [("1", "1", 2, True), ("2", "2", 2, True), ("2", "2", 2, True), ("None", "1", 2, False), ("None", "None", 1, True)]
    assert sorted(str(r["doc_id"]) for r in exact_dedup.drop_copies(copy_frame(spark, rows)).collect()) == ["1", "2", "None"]
    assert exact_dedup.text_classes(copy_frame(spark, [])).count() == exact_dedup.drop_copies(copy_frame(spark, [])).count() == 0


# ── shards ──


def shard_by_hand(tree, key):
    """Descend by the smallest of -ln(u) / weight among the children, with u from the md5 of the path and the key."""
    path, shards = "", [s for s in tree if s.weight > 0]
    for level in ("region", "rack", "shard"):
        groups = {}
        for s in shards:
            groups.setdefault(str(getattr(s, level)), []).append(s)

        def draw(name):
            bits = int(hashlib.md5(f"{shard_tree.SEED}{path}/{name}/{key}".encode()).hexdigest()[:13], 16)
            return -math.log((bits + 1) / 2**52) / sum(s.weight for s in groups[name])

        name = min(groups, key=draw) if len(groups) > 1 else next(iter(groups))
        path, shards = f"{path}/{name}", groups[name]
    return shards[0].shard


def shard_frame(spark, rows):
    return spark.createDataFrame([(i, t, 7, "run") for i, t in rows], "doc_id long, text string, shard int, key string").repartition(4)


def test_shards_slots_and_growth(spark, monkeypatch):
    monkeypatch.setattr(shard_tree, "ROWS_PER_RUN", 4)
    rows = [(i, f"é{i}" if i % 7 else None) for i in range(-50, 900)] + [(5, "é5"), (None, ""), (None, "x")]
    tree = shard_tree.even_tree(2, 3, 4)
    more = shard_tree.grown(tree)
    got = shard_tree.assign(shard_frame(spark, rows), tree, more).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)
    for r in got:
        key = "null" if r["doc_id"] is None else r["doc_id"]
        assert r["shard"] == shard_by_hand(tree, key) and r["grown_shard"] == shard_by_hand(more, key)
        assert r["grown_shard"] in (r["shard"], 24) and r["law"] == "key"
    texts = {i: (t or "").encode() for i, t in rows if i is not None}
    assert all((r["size"], r["text_crc32"]) == (len(texts[r["doc_id"]]) + 8, zlib.crc32(texts[r["doc_id"]])) for r in got if r["doc_id"] is not None)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 24
    assert any(r["grown_shard"] == 24 for r in got)


def test_changed_weights_move_rows_only_on_the_changed_paths(spark):
    tree = shard_tree.even_tree(2, 2, 2)
    heavier = [shard_tree.Shard(s.region, s.rack, s.shard, 3.0 if s.shard == 0 else 1.0) for s in tree]
    keys = spark.range(2000).select(F.col("id").cast("string").alias("key"))
    moved = shard_tree.with_shard(shard_tree.with_shard(keys, "key", tree, "before"), "key", heavier, "after").collect()
    region = {s.shard: s.region for s in tree}
    rack = {s.shard: s.rack for s in tree}
    for r in moved:
        if region[r["before"]] == region[r["after"]] and rack[r["before"]] == rack[r["after"]] != "rack0":
            assert r["before"] == r["after"]
        assert not (region[r["before"]] == "region0" and region[r["after"]] == "region1")
    share = Counter(r["after"] for r in moved)
    assert 0.24 < share[0] / 2000 < 0.36  # 3 of 10


def test_shards_of_an_empty_table_and_of_no_weight(spark):
    tree = shard_tree.even_tree(1, 1, 2)
    assert shard_tree.assign(shard_frame(spark, []), tree).count() == 0
    with pytest.raises(ValueError):
        shard_tree.assign(shard_frame(spark, [(1, "")]), [shard_tree.Shard("a", "b", 0, 0.0)])


# ── mixing ──


def mix_frame(spark, rows):
    return spark.createDataFrame([(i, t, s, 0, "q") for i, t, s in rows], "doc_id long, text string, source string, size int, run string").repartition(4)


def targets_by_hand(sizes):
    """Share by weight; whoever is above three times its size is set to that, the rest shared again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    left, fixed = float(sum(sizes.values())), {}
    while True:
        free = [s for s in order if s not in fixed]
        total = sum(weight[s] for s in free)
        above = [s for s in free if left * weight[s] / total > 3 * sizes[s] + 1e-9]
        if not above:
            return fixed | {s: left * weight[s] / total for s in free}
        for s in above:
            fixed[s] = 3.0 * sizes[s]
            left -= fixed[s]


def test_mix_comes_near_its_targets(spark):
    rng = random.Random(3)
    sources = ["a", "b", "c", "Z", "é", None, "empty"]
    rows = [(i, None if rng.random() < 0.02 else " ".join(["w"] * rng.randrange(0, 60)), rng.choices(sources[:6], [60, 10, 1, 5, 5, 8])[0]) for i in range(1500)]
    rows += [(5000 + i, " \t", "empty") for i in range(5)]
    size = {i: len(WORD.findall(t or "")) for i, t, _ in rows}
    source = {i: s for i, _, s in rows}
    sizes = Counter()
    for i in size:
        sizes[source[i]] += size[i]
    want = targets_by_hand(dict(sizes))
    assert any(abs(want[s] - 3 * sizes[s]) < 1e-6 for s in want if sizes[s])
    got = mixing.mix(mix_frame(spark, rows)).collect()
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        i = r["doc_id"]
        assert r["size"] == size[i] and r["source_size"] == sizes[source[i]]
        assert r["target"] == pytest.approx(want[source[i]])
        assert r["taken"] == r["copies"] * size[i] and 0 <= r["copies"] <= 3
        taken[source[i]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 60 for s in want)
    again = mixing.mix(mix_frame(spark, rows).repartition(3)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))
    copies = Counter({r["doc_id"]: r["copies"] for r in got})
    mixed = mixing.mixed_rows(mix_frame(spark, rows))
    assert mixed.columns == ["doc_id", "text", "source", "size", "run"]
    assert Counter(r["doc_id"] for r in mixed.collect()) == +copies


def test_mix_of_one_size_and_of_nothing(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_RUN", 10)
    rows = [(i, "a b c", "hot" if i % 3 else "cold") for i in range(300)] + [(None, "a b c", "hot")]
    got = mixing.mix(mix_frame(spark, rows)).collect()
    assert len(got) == 301
    for s in (200, 100):
        some = [r for r in got if r["source_size"] // 300 == s // 100]
        assert abs(sum(r["taken"] for r in some) - some[0]["target"]) <= 3
    assert mixing.mix(mix_frame(spark, [])).count() == 0
    assert [r["taken"] for r in mixing.mix(mix_frame(spark, [(1, None, None), (2, "", "a")])).collect()] == [0, 0]


def test_mixed_rows_of_null_and_repeated_ids_meet_the_targets(spark):
    rows = [(None, f"a b {i}", "abcd"[i % 4]) for i in range(400)] + [(7, f"c d {i}", "b") for i in range(100)]
    rows += [(i, "e f g h", "c") for i in range(200)] + [(None, None, "a"), (None, "same one", "d"), (None, "same one", "d")]
    plan = mixing.mix(mix_frame(spark, rows)).collect()
    got = mixing.mixed_rows(mix_frame(spark, rows)).collect()
    taken = Counter()
    for r in got:
        taken[r["source"]] += len(WORD.findall(r["text"] or ""))
    targets = {}
    for r in plan:
        targets[r["source_size"]] = r["target"]
    assert len(got) == sum(r["copies"] for r in plan) and sum(taken.values()) == sum(r["taken"] for r in plan)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    assert len(set(sizes.values())) == 4 and all(abs(taken[s] - targets[sizes[s]]) <= 8 for s in sizes)
    assert Counter(map(tuple, mixing.mixed_rows(mix_frame(spark, rows).repartition(7)).collect())) == Counter(map(tuple, got))


# ── language ──


def vector_by_hand(text):
    """Bundle of bound n-grams, letter by letter."""
    table, vectors = langid.letter_table(), langid.letter_vectors().astype(int)
    letters = [0]
    for c in text:
        x = int(table[ord(c)])
        if x or letters[-1]:
            letters.append(x)
    if letters[-1]:
        letters.append(0)
    out = np.zeros(langid.DIMENSIONS, int)
    for i in range(len(letters) - 2):
        a, b, c = letters[i : i + 3]
        out += np.roll(vectors[a], 2) * np.roll(vectors[b], 1) * vectors[c]
    return out


TEXTS = ["The cat sat", "LE chat!!  noir", "a", "x y", "", "123 --", "Ünïcode ß", "日本 語", "😀", "a\n\nb", "é" * 50, " lead", "trail "]


def test_bundles_are_those_of_the_letters():
    doc, code, count = langid.grams(TEXTS)
    found = langid.bundles(doc, code, count, len(TEXTS))
    assert np.array_equal(found, np.array([vector_by_hand(t) for t in TEXTS], np.float32))
    for i, t in enumerate(TEXTS):  # neighbours in a slab make no difference
        alone = langid.bundles(*langid.grams([t]), 1)
        assert np.array_equal(alone[0], found[i])


def test_prediction_is_the_nearest_prototype(spark):
    rows = [(0, "the cat and the dog", "en"), (1, "le chat et le chien", "fr"), (2, "the house and the tree", "en"), (3, None, "fr"), (4, "12", "de"), (5, "la maison et le", None)]
    schema = "doc_id long, text string, lang string, score double"
    docs = spark.createDataFrame([(*r, 0.0) for r in rows], schema)
    profiles = langid.learn(docs)
    assert profiles.languages == ("en", "fr")
    whole = {"en": vector_by_hand(rows[0][1]) + vector_by_hand(rows[2][1]), "fr": vector_by_hand(rows[1][1])}
    tests = [(i, t) for i, t in enumerate([*TEXTS, None, "the dog", "le chien"])]
    got = langid.predict(spark.createDataFrame([(i, t, "zz", 9.0) for i, t in tests], schema), profiles)
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    for r in got.collect():
        v = vector_by_hand(r["text"] or "")
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0)
            continue
        cosine = {k: v @ p / np.linalg.norm(v) / np.linalg.norm(p) for k, p in whole.items()}
        assert r["score"] == pytest.approx(min(1, max(0, *cosine.values())), abs=1e-5)
        assert cosine[r["lang_pred"]] == pytest.approx(max(cosine.values()), abs=1e-5)


def test_held_out_accuracy_and_empty_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    found = langid.identify(docs, fold != 2, keep=(F.col("doc_id"), F.col("lang"), (fold == 2).alias("held_out")))
    held = [r for r in found.collect() if r["held_out"]]
    assert len(held) > 20 and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    none = docs.limit(0)
    assert langid.learn(none).languages == () and langid.predict(none, langid.learn(docs)).count() == 0
    assert {r["lang_pred"] for r in langid.predict(docs.limit(5), langid.learn(none)).collect()} == {"und"}
