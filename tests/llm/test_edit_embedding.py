"""Edit embedding: the vectorised walk against a plain one, edits against strings, links against planted copies."""

import hashlib
import random

import numpy as np
import pytest

from orderloom.llm import edit_embedding as ee

ODD = ["", "a", "é", "ab", "x" * 20, "日本語 テキスト", "😀" * 50, "a b\nc" * 700, "\0nul\0"]


def plain_walk(text):
    moves, steps = ee._table("moves"), ee._table("steps").tolist()
    read = [*ee.classes(np.frombuffer(text.encode("utf-32-le"), np.uint32)).tolist(), 0]
    out, at, step, sample = [], 0, 0, 0
    while read[at]:
        if steps[sample] == step:
            out.append(read[at])
            sample += 1
        at += int(moves[step % ee.PERIOD][read[at]])
        step += 1
    return out


def texts(seed, n=40):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefgh ijé\n") for _ in range(rng.choice([0, 3, 40, 500, 4000]))) for _ in range(n)]


@pytest.mark.parametrize("few", [0, 8, 1000])
def test_walk_is_the_plain_one(monkeypatch, few):
    monkeypatch.setattr(ee, "FEW", few)
    some = [*ODD, *texts(1)]
    found = ee.walk(some)
    for row, text in zip(found, some, strict=True):
        want = plain_walk(text)
        assert row[: len(want)].tolist() == want and not row[len(want) :].any()


def test_fingerprints_depend_on_the_text_alone():
    alone = [ee.fingerprints([t])[0][0] for t in ODD]
    assert ee.fingerprints(ODD)[0] == alone
    bits = ee.read_back(alone)
    assert ee.written(bits) == alone
    assert ee.likeness(bits, bits).tolist() == [1.0] * len(ODD)


def test_likeness_falls_with_edits():
    rng = random.Random(5)
    base = [t for t in texts(2, 80) if len(t) >= 500]
    means = []
    for rate in (0.0, 0.002, 0.02, 0.2, 1.0):
        near = []
        for t in base:
            u = list(t)
            for _ in range(int(rate * len(t))):
                u[rng.randrange(len(u))] = rng.choice("abcdefgh ")
            bits = ee.read_back(ee.fingerprints([t, "".join(u)])[0])
            near.append(ee.likeness(bits[:1], bits[1:])[0])
        means.append(np.mean(near))
    assert means[0] == 1 and means == sorted(means, reverse=True) and means[1] > 0.7 and means[-1] < 0.35


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, fingerprint int, run string")


def test_edits_follow_id_order(spark, monkeypatch):
    monkeypatch.setattr(ee, "RUN_BYTES", 2000)
    some = [*ODD, *texts(3, 60)]
    ids = random.Random(1).sample(range(-500, 100_000), len(some))
    rows = [(i, t, 1, "x") for i, t in zip(ids, some, strict=True)] + [(200_000, None, None, None)]
    found = {r["doc_id"]: r for r in ee.fingerprint_edits(frame(spark, rows).repartition(5)).collect()}
    ordered = sorted(rows)
    assert len(found) == len(rows)
    for k, (i, t, *_) in enumerate(ordered):
        t, after = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        changed = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        prints, bits = ee.fingerprints([t, changed, after])
        r = found[i]
        assert r["n_chars"] == len(t)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert [r["fingerprint"], r["edited_fingerprint"]] == prints[:2]
        assert r["near_edited"] == pytest.approx(ee.likeness(bits[:1], bits[1:2])[0])
        assert r["near_next"] == pytest.approx(ee.likeness(bits[:1], bits[2:])[0])


def test_small_and_repeated_tables(spark):
    assert ee.fingerprint_edits(frame(spark, [])).count() == 0
    (one,) = ee.fingerprint_edits(frame(spark, [(7, "abcd", 0, "")])).collect()
    assert one["near_next"] == 1 and one["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()
    rows = [(None, "a", 0, ""), (3, "same", 0, ""), (3, "same", 0, ""), (3, "other", 0, "")]
    assert sorted(str(r["doc_id"]) for r in ee.fingerprint_edits(frame(spark, rows)).collect()) == ["3", "3", "3", "None"]


def test_near_copies_are_linked(spark):
    rng = random.Random(9)
    base = ["".join(rng.choice("abcdefgh ijklm") for _ in range(3000)) for _ in range(12)]
    rows = [(i, t, 0, "") for i, t in enumerate(base)]
    rows += [(100 + i, t[:-20] + "z" * 20, 0, "") for i, t in enumerate(base)] + [(200 + i, t, 0, "") for i, t in enumerate(base)]
    rows += [(300, None, 0, ""), (301, "", 0, ""), (None, base[0], 0, "")]
    links = {(r["rep_id"], r["other_id"]) for r in ee.near_links(frame(spark, rows)).collect()}
    assert {(i, 100 + i) for i in range(12)} == links


def alike_by_hand(some, near):
    """All pairs of texts, by the likeness of their fingerprints; ids are places."""
    bits = ee.read_back(ee.fingerprints(some)[0])
    signs = np.where(bits == 2, 0.0, 1.0 - 2.0 * bits)
    weights = ee._table("weights")[: bits.shape[1]]
    size = np.abs(signs) @ weights
    out = {}
    for low in range(0, len(some), 1000):
        part = slice(low, low + 1000)
        alike = (signs[part] * weights) @ signs.T / np.maximum(np.maximum(size[part][:, None], size), 1e-9)
        for i, j in zip(*np.nonzero(alike >= near), strict=True):
            if low + i < j and size[j]:
                out[int(low + i), int(j)] = alike[i, j]
    return out


@pytest.mark.parametrize("block", [2000, 16])
def test_links_among_many_unrelated_texts(spark, monkeypatch, block):
    monkeypatch.setattr(ee, "BLOCK", block, raising=False)
    rng = random.Random(12)

    def made(n):
        return "".join(rng.choice("abcdefgh ijklmnop") for _ in range(n))

    def changed(text, times):
        text = list(text)
        for _ in range(times):
            text[rng.randrange(len(text))] = rng.choice("qrst")
        return "".join(text)

    some = [made(rng.choice([20, 25, 30, 200, 260, 400])) for _ in range(10_000 if block > 100 else 500)]
    some += [changed(t, rng.choice([1, 1, 2, 3])) for t in some[:400]]  # pairs, the short ones too
    template = made(300)
    some += [changed(template, 1) for _ in range(60)]  # one bucket in which nearly all are alike
    some += [template + made(n) for n in (10, 40, 60, 80)]  # lengths that lie in different cells
    some = list(dict.fromkeys(some))
    want = alike_by_hand(some, 0.8)
    short = {p for p in want if len(some[p[0]]) <= 30}
    assert len(want) > 1500 and len(short) > 50
    links = ee.near_links(frame(spark, [(i, t, 0, "") for i, t in enumerate(some)]).repartition(8)).collect()
    found = {(r["rep_id"], r["other_id"]): r["likeness"] for r in links}
    assert len(found) == len(links) and set(found) <= set(want)
    assert all(found[p] == pytest.approx(want[p], abs=1e-12) for p in found)
    assert len(found) >= 0.99 * len(want) and len(short & set(found)) >= 0.98 * len(short)
