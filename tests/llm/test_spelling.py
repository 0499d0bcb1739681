import random
import zlib
from collections import Counter

import pyarrow as pa
import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import spelling
from orderloom.llm.scratch import settle

DOCS = "doc_id bigint, text string, word string, n string"


@pytest.fixture(autouse=True)
def _settled(spark):
    settle(spark)


def _near(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _plain(rows, shortest=5, least=3, typos=0):
    counts = Counter()
    for doc_id, text in rows:
        run = ""
        for c in (text or "") + " ":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
                continue
            if run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                if typos and h % typos == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                counts[run] += len(run) >= shortest
            run = ""
    words = {w: n for w, n in counts.items() if n >= least}
    found = {}
    for w, n in words.items():
        near = [(-m, v) for v, m in words.items() if _near(w, v)]
        best = min(near) if near else None
        form = best[1] if best and -best[0] >= 2 * n else None
        found[w] = [form, None, n, len(near), words[form] if form else None]
    for w, row in found.items():
        root = w
        while found[root][0]:
            root = found[root][0]
        row[1] = root
    return {w: tuple(r) for w, r in found.items()}


def _texts(seed, n=120):
    rng = random.Random(seed)
    base = ["".join(rng.choice("aeinrstéÉ×") for _ in range(rng.randint(4, 9))) for _ in range(60)]
    out = []
    for i in range(n):
        words = []
        for _ in range(40):
            w = rng.choice(base)
            if rng.random() < 0.3:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1 :], w[:at] + "n" + w[at:], w[:at] + "o" + w[at + 1 :]])
            words.append(w.upper() if rng.random() < 0.1 else w)
        out.append((rng.choice([None, 7, i]), rng.choice([" ", "-", "1", "Ā"]).join(words)))
    return out


def _found(spark, rows, **options):
    df = spark.createDataFrame([(i, t, "taken", None) for i, t in rows], DOCS)
    got = [tuple(r) for r in spelling.variants(df.repartition(3), **options).collect()]
    assert len({r[0] for r in got}) == len(got)
    return {r[0]: r[1:] for r in got}


@pytest.mark.parametrize("shard_words", [20_000, 5])
def test_equals_brute_force(spark, monkeypatch, shard_words):
    monkeypatch.setattr(spelling.near_words, "__defaults__", (shard_words,))
    rows = [*_texts(1), (3, None), (4, ""), (5, "Straße Straße strasse STRASSE"), (6, "a" * 300 + " " + "a" * 299 + "b " + "a" * 301)] * 3
    expected = _plain(rows, typos=13)
    assert any(r[0] and r[1] != r[0] for r in expected.values()), "some chain has two steps"
    assert _found(spark, rows, typos=13) == expected


def test_empty_tables_and_texts(spark):
    assert _found(spark, []) == {}
    assert _found(spark, [(1, None), (2, ""), (None, "12 , .")]) == {}


def test_runs_and_checksums(spark):
    texts = pa.array(["Abéx-Ācd", "", "À", "z" * 100, "a b"])
    from orderloom.llm.text import raw

    data, offsets = raw(texts)
    starts, ends, owner = spelling.runs(data, offsets)
    assert [data[a:b].tobytes().decode() for a, b in zip(starts, ends)] == ["Abéx", "cd", "À", "z" * 100, "a", "b"]
    assert owner.tolist() == [0, 0, 2, 3, 4, 4]
    before = np.array([zlib.crc32(f"{i}:".encode()) for i in owner], np.uint32)
    crcs = spelling.span_crcs(data, starts, ends - starts, before)
    assert crcs.tolist() == [zlib.crc32(f"{i}:".encode() + data[a:b].tobytes()) for i, a, b in zip(owner, starts, ends)]


def test_many_words_of_one_vector(spark):
    """Words of the same letters: the trie cannot part them, so they are blocks that are searched by halves."""
    rng = random.Random(5)
    words = sorted({"".join(rng.sample("aabbccdd", 8)) for _ in range(900)} | {"aabbccd", "aabbccdda"})
    df = spark.createDataFrame([(w, i + 1) for i, w in enumerate(words)], "word string, n bigint")
    found = {r["word"]: (r["n_near"], r["best_n"], r["best"]) for r in spelling.near_words(df, 50).collect()}
    n = {w: i + 1 for i, w in enumerate(words)}
    expected = {}
    for w in words:
        near = [v for v in words if _near(w, v)]
        if near:
            best = min(near, key=lambda v: (-n[v], v))
            expected[w] = (len(near), n[best], best)
    assert found == expected and expected


def test_hot_word_is_folded_in_the_task(spark):
    df = spark.range(6000, numPartitions=4).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hello " * 20)).otherwise(F.concat(F.lit("other "), "id")).alias("text"))
    assert {r["word"]: r["n"] for r in spelling.vocabulary(df).collect()} == {"hello": 40000, "other": 4000}
    plan = spelling.vocabulary(df)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and plan.count("Exchange hashpartitioning") == 1
