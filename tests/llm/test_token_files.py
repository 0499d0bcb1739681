"""rANS blocks and token files: exact round trips, damage, and digests against the library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from orderloom.llm import bpe, rans, token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [0, 1, 15, 16, 17, 4096, 4097, 16_384, 16_385, 70_001])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % 50_257).astype(np.int32)
    counts = np.bincount(ids, minlength=50_257)
    table = rans.frequencies(counts)
    assert not n or table.share.sum() == 1 << table.bits
    blocks = rans.encode_blocks(ids, table)
    assert [i for b in rans.decode_blocks(blocks, table) for i in b.tolist()] == ids.tolist()
    if n > 50_000:  # close to the entropy of the table
        p = counts[counts > 0] / n
        assert 32 * sum(len(b.words) for b in blocks) / n < 1.02 * -(p * np.log2(p)).sum() + 0.1


def test_blocks_of_one_symbol_and_of_equal_shares():
    for ids in (np.zeros(40_000, np.int32), np.arange(50_257, dtype=np.int32)):
        table = rans.frequencies(np.bincount(ids))
        assert np.concatenate(rans.decode_blocks(rans.encode_blocks(ids, table), table)).tolist() == ids.tolist()


def test_decoding_starts_at_any_checkpoint():
    ids = (np.random.default_rng(1).zipf(1.2, rans.BLOCK_IDS) % 5000).astype(np.int32)
    table = rans.frequencies(np.bincount(ids))
    (block,) = rans.encode_blocks(ids, table)
    step = rans.ROWS_PER_CHECKPOINT * rans.LANES
    for k in range(len(block.marks)):
        rest = rans.Block(step, block.words, block.marks[k : k + 1], block.states[k : k + 1])
        assert rans.decode_blocks([rest], table)[0].tolist() == ids[k * step : (k + 1) * step].tolist()


def test_joined_crc():
    rng = random.Random(2)
    parts = [rng.randbytes(n) for n in (0, 1, 7, 1000, 65_536, 3)]
    assert token_files.joined_crc([(len(p), zlib.crc32(p)) for p in parts]) == zlib.crc32(b"".join(parts))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", b"y") for i, t in rows], "doc_id long, text string, ids string, words binary")


def texts(n=60):
    rng = random.Random(4)
    words = ["the", "Théâtre", "don't", "x1", "日本", "😀", "of", "and", "ing"]
    some = [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 30, 300]))) for _ in range(n)]
    return [*some, None, "", " ".join(["long text"] * 15_000), " " * 5000, "<|endoftext|>"]


@pytest.mark.parametrize("end_id", [2, 70_000])
def test_files_hold_what_the_library_gives(spark, tmp_path, end_id):
    library = Tokenizer.from_file(PATH)
    some = texts()
    rows = list(zip(random.Random(1).sample(range(-100, 10_000), len(some)), some, strict=True))
    folder = token_files.write(frame(spark, rows).repartition(3), f"file://{tmp_path}/files", PATH, end_id)
    digests = {r["doc_id"]: r for r in token_files.read_digests(spark, folder).collect()}
    lists = {r["doc_id"]: r["ids"] for r in token_files.read_ids(spark, folder).collect()}
    assert len(digests) == len(lists) == len(rows)
    start = 0
    for i, t in sorted(rows):
        want = [*library.encode(t or "", add_special_tokens=False).ids, end_id]
        assert lists[i] == want
        crc = zlib.crc32(np.array(want, "<u4").tobytes())
        assert (digests[i]["start"], digests[i]["n_tokens"], digests[i]["ids_crc32"]) == (start, len(want), crc)
        start += len(want)


def test_damage_is_found(spark, tmp_path):
    folder = token_files.write(frame(spark, list(enumerate(texts()))), f"file://{tmp_path}/files", PATH, 2)
    blocks = spark.read.parquet(f"{folder}/blocks")
    block = blocks.collect()[0].asDict()
    table = token_files.frequency_table(spark, folder)
    words = bytearray(block["words"])
    words[len(words) // 2] ^= 1
    batch = blocks.limit(1).toArrow().to_batches()[0]
    at = batch.schema.get_field_index("words")
    broken = batch.set_column(at, "words", __import__("pyarrow").array([bytes(words)], batch.schema.field("words").type))
    with pytest.raises(ValueError, match="damaged"):
        list(token_files._blocks(broken, table))


def test_empty_and_repeated(spark, tmp_path):
    folder = token_files.write(frame(spark, []), f"file://{tmp_path}/none", PATH, 2)
    assert token_files.read_digests(spark, folder).count() == 0
    folder = token_files.write(frame(spark, [(3, "a"), (3, "a"), (None, "b"), (None, None)]), f"file://{tmp_path}/some", PATH, 2)
    rows = sorted((r["start"], str(r["doc_id"]), r["n_tokens"]) for r in token_files.read_digests(spark, folder).collect())
    assert [r[1] for r in rows] == ["None", "None", "3", "3"] and sum(r[2] for r in rows) == 7 and rows[0][0] == 0


@pytest.mark.parametrize("filled", [0, 1, 40])
def test_documents_without_ids_are_found_without_an_end_id(spark, tmp_path, monkeypatch, filled):
    monkeypatch.setattr(token_files, "SIDE_BY_SIDE", 1)
    monkeypatch.setattr(rans, "BLOCK_IDS", 16)
    monkeypatch.setattr(rans, "ROWS", 1)
    library = Tokenizer.from_file(PATH)
    (one,) = library.encode("a", add_special_tokens=False).ids
    rows = [(i, "" if i % 2 else None) for i in range(40)] + [(None, "")]
    rows += [(-1 - i, "a") for i in range(filled)]
    folder = token_files.write(frame(spark, rows).repartition(3), f"file://{tmp_path}/files", PATH, None)
    want = sorted((str(i), [one] if t else []) for i, t in rows)
    assert sorted((str(r["doc_id"]), list(r["ids"])) for r in token_files.read_ids(spark, folder).collect()) == want
    got = token_files.read_digests(spark, folder).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in got) == [(i, len(ids)) for i, ids in want]
    assert all(r["ids_crc32"] == zlib.crc32(np.array([one] * r["n_tokens"], "<u4").tobytes()) and 0 <= r["start"] <= filled for r in got)


def test_token_table_is_the_vocabulary():
    data, starts = bpe.token_table(PATH)
    library = Tokenizer.from_file(PATH)
    for i in (0, 10, 220, 1000, 50_000, 50_256):
        assert data[starts[i] : starts[i + 1]].tobytes().decode("utf-8", "replace") == library.decode([i], skip_special_tokens=False)
