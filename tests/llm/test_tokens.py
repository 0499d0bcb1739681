"""Chunked BPE and token attribution against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from orderloom.llm import attribution, bpe
from orderloom.llm.text import mix, raw, slabs, span_hashes, unmix, words

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
PIECES = [
    "a", "B", "é", "ß", " ", "  ", "\n", "\t", ".", ",", "'s", "'ll", "<|endoftext|>", "1", "22", " ", " ", "日", "😀",
    "-", "_", "!", "the", "ing", "́", "×", "\x1c", "​", "Ж", "\u0085", "\x0b", "\r",
]
ODD = [
    "", "a", "  ", " a", "é è", "   x   y", "<|endoftext|>", "a<|endoftext|>b <|endoftext|>.", "don't.can't,I'll!we've", "a\n\n\nb  \n",
    "日本語 テキスト 。x", "A.B.C", "x" * 3000, "xy " * 3000, "é" * 2000, " " * 2000 + "x", "a" + " " * 2000, "\u0085 a\u0085b", "a\x1c b\x00 d",
]


def same(texts, bits):
    table = bpe.piece_table(PATH)
    table.chunks.clear()
    ids, first = bpe.encode_texts(table, *raw(pa.array(texts, pa.string())), bits)
    data, at = bpe.decode_ids(table, ids, first)
    for i, want in enumerate(LIBRARY.encode_batch(texts, add_special_tokens=False)):
        assert ids[first[i] : first[i + 1]].tolist() == want.ids, texts[i][:80]
        assert data[at[i] : at[i + 1]].tobytes().decode() == LIBRARY.decode(want.ids, skip_special_tokens=False)


@pytest.mark.parametrize("bits", [9, 4, 1, 0])
def test_chunks_give_the_library_s_ids(bits):
    rng = random.Random(bits)
    same([*ODD, *("".join(rng.choice(PIECES) for _ in range(rng.randrange(60))) for _ in range(1500))], bits)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=80), min_size=1, max_size=5), st.sampled_from([0, 2, 9]))
def test_any_text(texts, bits):
    same(texts, bits)


def test_shared_chunks_are_encoded_once(monkeypatch):
    table = bpe.PieceTable(PATH)
    rng = random.Random(1)
    passage = " ".join(f"word{rng.randrange(10**6)}" for _ in range(3000))
    texts = [f"start {k} {passage} end {k}" for k in range(5)]
    seen = []
    encode = table.encode
    monkeypatch.setattr(table, "encode", lambda data, offsets: (seen.append(len(data)), encode(data, offsets))[1])
    bpe.encode_texts(table, *raw(pa.array(texts[:1])))
    alone = sum(seen)
    seen.clear()
    bpe.encode_texts(table, *raw(pa.array(texts[1:])))
    assert sum(seen) < 0.25 * 4 * alone  # only ends of documents and joins


def test_table_starts_afresh(monkeypatch):
    monkeypatch.setattr(bpe, "MOST_PIECES", 50)
    monkeypatch.setattr(bpe, "CHUNK_STORE_BYTES", 1000)
    table = bpe.PieceTable(PATH)
    rng = random.Random(2)
    for _ in range(6):
        texts = [" ".join(str(rng.randrange(10**6)) for _ in range(100)) for _ in range(3)]
        ids, first = bpe.encode_texts(table, *raw(pa.array(texts)))
        assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "i", 3) for i, t in rows], "doc_id long, text string, ids string, section int")


def test_over_tables(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100, None), (None, "x y"), (3, " a"), (3, " a")]
    got = bpe.round_trip(frame(spark, rows).repartition(3), PATH).collect()
    want = []
    for i, t in rows:
        ids = LIBRARY.encode(t or "", add_special_tokens=False).ids
        text = LIBRARY.decode(ids, skip_special_tokens=False)
        want.append((str(i), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)
    both = bpe.decode(bpe.encode(frame(spark, rows), PATH), PATH)
    assert both.columns == ["doc_id", "text", "section", "ids", "decoded"]
    assert all(r["decoded"] == (r["text"] or "") for r in both.collect())
    assert bpe.encode(frame(spark, []), PATH).count() == bpe.round_trip(frame(spark, []), PATH).count() == 0


# ── attribution ──


def by_hand(text, starts, rule):
    ends = [*starts[1:], len(text)]
    counts = [0] * len(starts)
    for a, b in LIBRARY.encode(text, add_special_tokens=False).offsets:
        held = [max(0, min(b, e) - max(a, s)) for s, e in zip(starts, ends)]
        at = {"start": next(k for k, n in enumerate(held) if n), "end": max(k for k, n in enumerate(held) if n), "most": held.index(max(held))}[rule]
        counts[at] += 1
    return [(k, s, e, n) for k, (s, e, n) in enumerate(zip(starts, ends, counts))]


@pytest.mark.parametrize("rule", attribution.RULES)
def test_sections_of_lines_and_of_any_places(spark, rule):
    rng = random.Random(5)
    texts = ["", "\n", "\n\n", "a\nb\n", "é\n日本\n😀😀", "x" * 500] + ["".join(rng.choice(PIECES) for _ in range(rng.randrange(80))) for _ in range(60)]
    texts = [t.replace("\x00", "") for t in texts]
    rows = [(i, t) for i, t in enumerate(texts)] + [(900, None)]
    got = {}
    for r in attribution.section_tokens(frame(spark, rows), PATH, rule).collect():
        got.setdefault(r["doc_id"], []).append(tuple(r)[1:])
    for i, t in rows:
        t = t or ""
        starts = [0] + [k + 1 for k, c in enumerate(t) if c == "\n" and k < len(t) - 1]
        assert sorted(got[i]) == by_hand(t, starts, rule)
    places = [(i, t, sorted(rng.sample(range(-2, len(t) + 3), 3)) + [None] if i % 5 else None) for i, t in enumerate(texts)]
    given = spark.createDataFrame(places, "doc_id long, text string, at array<int>")
    got = {}
    for r in attribution.section_tokens(given, PATH, rule, starts_col="at").collect():
        got.setdefault(r["doc_id"], []).append(tuple(r)[1:])
    for i, t, at in places:
        starts = [0, *sorted({s for s in at or [] if s is not None and 0 < s < len(t)})]
        assert sorted(got[i]) == by_hand(t, starts, rule)


def test_fields_and_bad_rule(spark):
    rows = [(1, "a title", "the body text", "end"), (2, None, "b", ""), (3, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, title string, body string, foot string")
    got = sorted(map(tuple, attribution.field_tokens(docs, PATH, ["title", "body", "foot"]).collect()))
    for i, *fields in rows:
        text = "\n".join(f or "" for f in fields)
        at = [0, len(fields[0] or "") + 1, len(fields[0] or "") + len(fields[1] or "") + 2]
        want = [0, 0, 0]
        for a, _ in LIBRARY.encode(text, add_special_tokens=False).offsets:
            want[max(k for k in range(3) if at[k] <= a)] += 1
        assert {f: n for d, f, n in got if d == i} == dict(zip(["title", "body", "foot"], want))
    with pytest.raises(ValueError):
        attribution.section_tokens(docs, PATH, "middle")
    assert attribution.section_tokens(frame(spark, []), PATH).count() == 0


@pytest.mark.parametrize("separator", ["\n", ""])
def test_fields_of_null_and_repeated_ids(spark, separator):
    rows = [(None, "no id", "at all here"), (4, "a", "first of two"), (4, "longer title", ""), (5, "", "after an empty one"), (5, None, None), (4, "a", "first of two")]
    docs = spark.createDataFrame(rows, "doc_id long, title string, body string").repartition(3)
    want = []
    for i, title, body in rows:
        at = len(title or "") + len(separator)
        offsets = LIBRARY.encode(separator.join([title or "", body or ""]), add_special_tokens=False).offsets
        late = sum(a >= at for a, _ in offsets)
        want += [(str(i), "body", late), (str(i), "title", len(offsets) - late)]
    got = attribution.field_tokens(docs, PATH, ["title", "body"], separator=separator).collect()
    assert sorted((str(r["doc_id"]), r["field"], r["n_tokens"]) for r in got) == sorted(want)


# ── shared helpers ──


def test_words_hashes_and_slabs():
    texts = ["", " a  b", "c", "d e\n", "\x0b", "f", "a"]
    data, offsets = raw(pa.array(texts))
    starts, ends, first = words(data, offsets)
    plain = [bytes(data[a:b]).decode() for a, b in zip(starts, ends)]
    assert plain == ["a", "b", "c", "d", "e", "f", "a"] and first.tolist() == [0, 0, 2, 3, 5, 5, 6, 7]
    h = span_hashes(data, starts, ends)
    assert h[0] == h[-1] and len(set(h.tolist())) == 6
    values = np.random.default_rng(1).integers(0, 1 << 63, 1000).astype(np.uint64)
    assert np.array_equal(unmix(mix(values)), values)
    batch = pa.RecordBatch.from_pydict({"text": ["x" * n for n in (5, 0, 20, 3, 3, 3, 30)]})
    pieces = list(slabs(iter([batch, batch.slice(2, 0)]), limit=9))
    assert [t for p in pieces for t in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert all(p.num_rows == 1 or sum(map(len, p.column(0).to_pylist())) <= 9 for p in pieces)
