"""The pipeline against the same decisions taken in plain Python, and the registered queries' shapes."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline
from orderloom.llm import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    ws = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def by_hand(rows):
    rows = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    last = {}
    for r in rows:
        last[r[1]] = max(r[0], last.get(r[1], r[0]))
    rows = [r for r in rows if last[r[1]] == r[0]]
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = defaultdict(lambda: 10**9)
    for i, r in enumerate(rows):
        least[find(i)] = min(least[find(i)], r[0])
    rows = [r for i, r in enumerate(rows) if least[find(i)] == r[0]]

    size = {r[0]: len(WORD.findall(r[1])) for r in rows}
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += size[r[0]]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    level, capped = None, []
    for s in sorted(order, key=lambda s: sizes[s] / weight[s]):
        rest = sum(weight[x] for x in order if x not in capped)
        level = (sum(sizes.values()) - 3 * sum(sizes[x] for x in capped)) / rest
        if level * weight[s] <= 3 * sizes[s]:
            break
        capped.append(s)
    copies = {}
    for s in order:
        f = min(level * weight[s], 3.0 * sizes[s]) / sizes[s]
        u = int(hashlib.md5(("mix/offset/" + ("1" if s is None else "0" + s)).encode()).hexdigest()[:13], 16) / 2**52
        own = sorted((size[r[0]], hashlib.md5(f"mix/row/{r[0]}".encode()).hexdigest(), r[0]) for r in rows if r[3] == s)
        for k, (_, _, i) in enumerate(own):
            copies[i] = 3 if f >= 3 else math.floor((k + 1) * f + u) - math.floor(k * f + u)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for r in rows:
        ids = library.encode(r[1], add_special_tokens=False).ids
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        out += [(r[0], len(ids), digest, hashlib.sha256(r[1].encode()).hexdigest(), tuple(ids))] * copies[r[0]]
    return sorted(out)


def documents(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}é" for i in range(200)]
    texts = [[rng.choice(vocabulary) for _ in range(rng.choice([3, 20, 60, 90]))] for _ in range(25)]
    rows = []
    for i in rng.sample(range(1000), 90):
        words = list(rng.choice(texts))
        if rng.random() < 0.5:
            words[rng.randrange(len(words))] = "changed"
        rows.append((i, " ".join(words), rng.choice(["en", "fr", None]), rng.choice(["a", "b", "c", None]), 0))
    rows += [(2000 + i, t, "en", "a", 0) for i, t in enumerate([None, "", "12 --", "\n", "ok", "ok"])]
    return rows


def test_pipeline_by_hand(spark, tmp_path):
    rows = documents()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    folder = f"file://{tmp_path}/sf"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    got = corpus_pipeline.run(spark, folder).collect()
    assert sorted((*tuple(r)[:4], tuple(r["ids"])) for r in got) == by_hand(rows)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns
    nothing = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, folder).count() == 0


def test_without_labels_letters_decide(spark):
    docs = spark.createDataFrame([(1, "é", None, "s", 1), (2, "1", None, "s", 1), (3, None, None, "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    assert [r["doc_id"] for r in corpus_pipeline.known_language(spark, docs, "").collect()] == [1]


def test_columns_pass_through_all_stages_and_reruns_agree(spark):
    rng = random.Random(3)
    rows = [(i, t, lang, source, n, round(rng.random(), 3), f"own {k}", k, b"x", [k]) for k, (i, t, lang, source, n) in enumerate(documents(5))]
    rows += [(7000, "one text of two rows", lang, "a", 1, s, "own", 0, None, None) for lang, s in (("en", 0.25), ("fr", 0.5), (None, 0.75))]
    rows += [(7001, t, "en", "b", 1, s, "own", 0, None, []) for t, s in ((None, 0.1), ("", 0.2))]
    rows += [(None, t, "en", None, 1, 0.5, "own", 0, b"", None) for t in ("a text without an id", "a text without an id", "another one")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, lang_pred string, `n.x` int, keep_line binary, keep_text array<int>"
    values = {tuple(map(repr, r)) for r in rows}
    kept = []
    for parts in (1, 5):
        docs = spark.createDataFrame(rows, schema).repartition(parts, "score")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = spark.createDataFrame(stage(spark, docs, "").collect(), schema)  # without a link to the rows before
            assert docs.columns == [c.split()[0].strip("`") for c in schema.split(", ")], name
            assert {tuple(repr(bytes(v) if isinstance(v, bytearray) else v) for v in r) for r in docs.collect()} <= values, name
            assert name != "exact_dedup" or sorted(r["doc_id"] for r in docs.where("doc_id >= 7000").collect()) == [7000]
        ids = corpus_pipeline.token_ids(spark, docs, "").select("doc_id", "ids_sha256").collect()
        kept.append((sorted(map(repr, docs.collect())), sorted(map(repr, ids))))
    assert kept[0] == kept[1]


def test_every_operator_is_registered():
    names = set(entry_points.queries())
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= names and set(queries.ORACLES) <= set(entry_points.oracle_sql())
