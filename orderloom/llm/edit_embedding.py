"""Document fingerprints by a randomised edit embedding.

A shared random walk reads a text: at step j it stands on a character, gives it out, and moves on or stays by a
random bit that depends on j and the character only. Texts at a small edit distance give out strings at a small Hamming
distance, since walks that an edit has parted meet again soon. Of the string given out, bits at fixed random steps are kept:
up to ``SAMPLES`` steps of every stretch [2^l, 2^(l+1)), so short and long texts are both covered whole, and one hashed
bit of each character. Bands of sampled bits find candidates, the likeness of whole fingerprints verifies them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.scratch import stored
from orderloom.llm.text import whole_text

SEED = 11
SAMPLES = 64
LEVELS = 40
#: Random moves repeat after so many steps.
PERIOD = 8192
#: Bytes of text that walk side by side; fewer walks than this go on one by one.
SIDE_BY_SIDE_BYTES = 12 << 20
FEW = 8
#: Bytes of text in one run of neighbouring documents, and the most runs there are (then they are longer).
RUN_BYTES = 1 << 20
MOST_RUNS = 20_000

_tables: dict[str, object] = {}


def _table(name: str):
    if not _tables:
        rng = np.random.default_rng(SEED)
        moves = rng.integers(0, 2, (PERIOD, 256), dtype=np.uint8)
        moves[:, 0] = 0  # the end of a text is never left
        steps, levels = [0], [0]
        for level in range(LEVELS):
            low, size = 1 << level, 1 << level
            some = np.arange(low, low + size) if size <= SAMPLES else low + _distinct(rng, size)
            steps += some.tolist()
            levels += [level] * len(some)
        _tables["moves"] = moves
        _tables["steps"] = np.array(steps, np.int64)
        level = np.array(levels)
        _tables["weights"] = np.maximum(1.0, (2.0**level) / SAMPLES)
        _tables["bits"] = rng.integers(0, 2, (len(steps), 256), dtype=np.uint8)
    return _tables[name]


def _distinct(rng: np.random.Generator, size: int) -> np.ndarray:
    """``SAMPLES`` ascending steps of a stretch, one from each equal part of it."""
    edges = np.array([size * i // SAMPLES for i in range(SAMPLES + 1)], np.int64)
    return edges[:-1] + (rng.random(SAMPLES) * np.diff(edges)).astype(np.int64)


def classes(points: np.ndarray) -> np.ndarray:
    """Code points folded to 1…255; all of Latin-1 but U+0000 and U+00FF keep classes of their own."""
    folded = points ^ (points >> np.uint32(8)) * np.uint32(37) ^ (points >> np.uint32(16)) * np.uint32(101)
    return (folded % np.uint32(255) + np.uint32(1)).astype(np.uint8)


def _stops() -> Iterator[int]:
    """Steps at which finished walks are taken out: every one up to 32, then 16 in every stretch."""
    step = 1
    while True:
        yield step
        step += max(1, 1 << max(0, step.bit_length() - 5))


def walk(texts: list[str]) -> np.ndarray:
    """For every text the characters (as classes, 0 after its end) at the sampled steps."""
    n = len(texts)
    steps, moves = _table("steps"), _table("moves")
    lengths = np.fromiter(map(len, texts), np.int64, n)
    points = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(lengths + 1) - 1
    read = classes(points)
    read[ends] = 0
    order = np.argsort(-lengths, kind="stable")
    at = (ends - lengths)[order]
    who = order
    found = np.zeros((n, int(np.searchsorted(steps, 4 * (lengths.max(initial=0) + 64)))), np.uint8)
    step, sample = 0, 0
    for stop in _stops():
        if len(who) <= FEW:
            break
        while step < stop:
            here = read[at]
            if sample < len(steps) and steps[sample] == step:
                if sample >= found.shape[1]:
                    found = np.concatenate([found, np.zeros((n, 64), np.uint8)], axis=1)
                found[who, sample] = here
                sample += 1
            at += moves[step % PERIOD][here]
            step += 1
        live = read[at] != 0
        if not live.all():
            at, who = at[live], who[live]
    for place, text in zip(at.tolist(), who.tolist(), strict=True):
        found = _walk_on(read, place, text, step, sample, found)
    return found


def _walk_on(read: np.ndarray, at: int, text: int, step: int, sample: int, found: np.ndarray) -> np.ndarray:
    """One walk to its end, by the same rules, in plain steps."""
    steps = _table("steps").tolist()
    if "plain" not in _tables:
        _tables["plain"] = [row.tobytes() for row in _table("moves")]
    moves = _tables["plain"]
    length = int(np.argmax(read[at:] == 0))
    own = read[at : at + length + 1].tobytes()
    at = 0
    next_sample = steps[sample]
    for stop in _stops():
        if stop <= step:
            continue
        while step < stop:
            here = own[at]
            if step == next_sample:
                if sample >= found.shape[1]:
                    found = np.concatenate([found, np.zeros((len(found), 64), np.uint8)], axis=1)
                found[text, sample] = here
                sample += 1
                next_sample = steps[sample] if sample < len(steps) else -1
            at += moves[step % PERIOD][here]
            step += 1
        if own[at] == 0:
            return found


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How alike the strings given out are, 0 to 1, row by row: the share of steps at which they agree beyond chance.

    Rows are sampled bits with 2 where the text has ended. A step at which only one text has ended counts as differing.
    Two empty texts are alike (1).
    """
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1])), constant_values=2) for x in (a, b))
    weights = _table("weights")[:width]
    valid = (a != 2) | (b != 2)
    both = (a != 2) & (b != 2)
    total = valid @ weights
    agreed = (both * np.where(a == b, 1.0, -1.0)) @ weights
    return np.where(total > 0, np.clip(agreed / np.maximum(total, 1e-9), 0, 1), 1.0)


def sampled_bits(found: np.ndarray) -> np.ndarray:
    """One bit per sample, 2 after the end."""
    bits = _table("bits")[np.arange(found.shape[1])[None, :], found]
    bits[found == 0] = 2
    return bits


def written(bits: np.ndarray) -> list[str]:
    """Fingerprints as text: the number of samples before the end, a colon, and their bits in hexadecimal."""
    counts = (bits != 2).sum(axis=1)  # a text that has ended gives out nothing more
    packed = np.packbits(bits & 1, axis=1)
    return [f"{n}:{row[: -(-n // 8)].tobytes().hex()}" for n, row in zip(counts.tolist(), packed, strict=True)]


def read_back(fingerprints: list[str]) -> np.ndarray:
    """Sampled bits of written fingerprints, 2 after the end."""
    parts = [f.split(":") for f in fingerprints]
    counts = [int(n) for n, _ in parts]
    out = np.full((len(parts), max(counts, default=0)), 2, np.uint8)
    for row, n, (_, data) in zip(out, counts, parts, strict=True):
        row[:n] = np.unpackbits(np.frombuffer(bytes.fromhex(data), np.uint8))[:n]
    return out


def fingerprints(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Written fingerprints, and their bits."""
    bits = sampled_bits(walk(texts))
    return written(bits), bits


def edited(text: str, after: str) -> str:
    """The text with its last floor(n / 2) characters replaced by the first as many, or all, of the next document."""
    cut = len(text) // 2
    return text[: len(text) - cut] + after[:cut]


# ── over tables ──


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row: ``doc_id, n_chars, text_sha256, fingerprint``. A null text is empty, with the fingerprint ``0:``.

    Equal texts have equal fingerprints. An empty table gives no rows; other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _gathered(batches, ["doc_id", "text"]):
            texts = rows["text"]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(rows["doc_id"], pa.int64()),
                    "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                    "text_sha256": [hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in texts],
                    "fingerprint": fingerprints(texts)[0],
                }
            )

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_chars long, text_sha256 string, fingerprint string")


def _gathered(batches: Iterator[pa.RecordBatch], names: list[str], carry: bool = False) -> Iterator[dict[str, list]]:
    """Rows in groups of a bounded number of bytes. With ``carry`` each group begins with the last row of the one before."""
    rows: dict[str, list] = {n: [] for n in names}
    held = 0
    for batch in batches:
        sizes = pc.binary_length(batch.column("text")).to_pylist()
        at = 0
        while at < batch.num_rows:
            to = at
            while to < batch.num_rows and (to == at or held < SIDE_BY_SIDE_BYTES):
                held += sizes[to] + 200
                to += 1
            for n in names:
                rows[n] += batch.column(n).slice(at, to - at).to_pylist()
            at = to
            if held >= SIDE_BY_SIDE_BYTES:
                yield rows
                rows, held = {n: v[-1:] if carry else [] for n, v in rows.items()}, 0
    if rows["text"]:
        yield rows


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``run, guest, doc_id, text`` so that within a run, in order, every host is followed by the next document.

    Ids are cut into runs at their quantiles; the first row of each run also visits the run before as a guest (the first of
    all visits the last), and so only texts, once each, and one row per run are shuffled. Cuts and first ids, at most
    ``MOST_RUNS``, are all the driver sees. Null ids come first. Rows with equal ids stand in the order of a hash of their texts.
    """
    given = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    size = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    runs = max(1, min(MOST_RUNS, -(-size // RUN_BYTES)))
    marks = [i / runs for i in range(1, runs)]
    cuts = given.agg(F.percentile_approx("doc_id", marks, max(10_000, 10 * runs))).first()[0] if marks else []
    cuts = np.unique(np.array(cuts or [], np.int64))

    @F.pandas_udf("int")
    def run_of(ids):
        return pd.Series(np.searchsorted(cuts, ids.to_numpy(), "right").astype(np.int32))

    known = F.coalesce("doc_id", F.lit(-(1 << 63)))
    heads = {r["run"]: r["head"] for r in given.select(run_of(known).alias("run"), known.alias("head")).groupBy("run").agg(F.min("head").alias("head")).collect()}
    order = sorted(heads)
    visited = {heads[run]: order[i - 1] for i, run in enumerate(order)}  # the run that a head visits

    @F.pandas_udf("array<int>")
    def stays(ids):
        values = ids.to_numpy()
        own = np.searchsorted(cuts, values, "right")
        return pd.Series([[run] if v not in visited else [run, -1 - visited[v]] for run, v in zip(own.tolist(), values.tolist(), strict=True)])

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = given.withColumn("stay", F.explode(stays(known)))
    placed = placed.select(F.when(F.col("stay") < 0, -1 - F.col("stay")).otherwise(F.col("stay")).alias("run"), (F.col("stay") < 0).alias("guest"), "doc_id", "text")
    return placed.repartition(parts, "run").sortWithinPartitions("run", "guest", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The edited text ends with the beginning of the next document's, see :func:`edited`; the next document is the one
    with the next larger id, after the last the first. A null text is empty. Of rows with equal ids, the next one is the
    one with the next hash of its text. A single document is its own next. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _gathered(batches, ["run", "guest", "doc_id", "text"], carry=True):
            texts, runs = rows["text"], rows["run"]
            hosts = np.array([i for i in range(len(texts) - 1) if not rows["guest"][i] and runs[i] == runs[i + 1]], np.int64)
            if not len(hosts):
                continue
            changed = [edited(texts[i], texts[i + 1]) for i in hosts.tolist()]
            own, bits = fingerprints(texts)
            other, other_bits = fingerprints(changed)
            out = {
                "doc_id": pa.array([rows["doc_id"][i] for i in hosts.tolist()], pa.int64()),
                "n_chars": pa.array([len(texts[i]) for i in hosts.tolist()], pa.int64()),
                "edited_sha256": [hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in changed],
                "fingerprint": [own[i] for i in hosts.tolist()],
                "edited_fingerprint": other,
                "near_edited": likeness(bits[hosts], other_bits),
                "near_next": likeness(bits[hosts], bits[hosts + 1]),
            }
            yield pa.RecordBatch.from_pydict(out)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(docs, id_col, text_col).mapInArrow(run, schema)


# ── near copies ──

NEAR = 0.8
#: Lengths of walks are told apart in cells, each so many times as long as the one before.
CELL = 2**0.25
#: The most that is missed of pairs that are alike by exactly ``near``; of those more alike it is less.
MISSED = 0.01
#: Unrelated texts that may be expected in a bucket, bits of a band, and the most bands.
CROWD = 8
LEAST_BITS = 12
MOST_BANDS = 256
#: Members of a bucket that are compared with each other, or with as many others, at a time.
BLOCK = 2000


@dataclass(frozen=True)
class Bands:
    """A plan of bands: ``spread`` cells below its own in which a text is found, ``bands`` in each, of ``bits`` bits."""

    spread: int
    bands: int
    bits: int

    def keys(self, bits: np.ndarray) -> np.ndarray:
        """Band keys, a row for each fingerprint; -1 where it has none.

        Keys that two fingerprints can have in common stand in the same column.
        """
        cuts = _cells()
        counts = (bits != 2).sum(axis=1)
        own = np.searchsorted(cuts, counts, "right") - 1
        out = np.full((len(bits), self.spread + 1, self.bands), -1, np.int64)
        for cell in np.unique(own[own >= 0]).tolist():
            rows = np.flatnonzero(own == cell)
            for below in range(max(0, cell - self.spread), cell + 1):
                drawn = np.zeros((len(rows), self.bands, 32), np.uint8)
                drawn[:, :, : self.bits] = bits[rows][:, self._picks(below)]
                values = np.packbits(drawn, axis=2, bitorder="little").view("<u4")[:, :, 0].astype(np.int64)
                out[rows, below % (self.spread + 1)] = values << 16 | np.arange(self.bands) << 8 | below
        return out.reshape(len(bits), -1)

    def _picks(self, cell: int) -> np.ndarray:
        """The samples that each band of a cell reads, drawn by the steps that they stand for."""
        name = f"picks {self} {cell}"
        if name not in _tables:
            share = _table("weights")[: _cells()[cell]]
            _tables[name] = np.random.default_rng([SEED, cell]).choice(len(share), (self.bands, self.bits), p=share / share.sum())
        return _tables[name]


def _cells() -> np.ndarray:
    """The number of samples with which each cell begins: weighed, at least ``CELL`` times as many as the one before."""
    weights = _table("weights")
    if "cells" not in _tables:
        reach = np.cumsum(weights)
        cuts = [1]
        while (after := int(np.searchsorted(reach, CELL * reach[cuts[-1] - 1]))) < len(reach):
            cuts.append(after + 1)
        _tables["cells"] = np.array(cuts)
    return _tables["cells"]


def plan_bands(n: int, near: float) -> Bands:
    """Bands for ``n`` texts: bits grow with the logarithm of ``n``, and bands so that no more than ``MISSED`` is missed.

    Texts that are alike by ``near`` have lengths of walks in a ratio of at least ``near``, and differ in at most
    ``(1 - near) / 2`` of the shorter walk, so in at most ``CELL`` times that share of the part below a common cell's border.
    """
    if not 0 < near <= 1:
        raise ValueError("near is above 0 and at most 1")
    agree = 1 - (1 - near) / 2 * CELL
    bits = max(LEAST_BITS, int(np.ceil(np.log2(max(n, 1) / CROWD))))
    tries = np.log(1 / MISSED)
    if agree < 1:
        bits = min(bits, max(1, int(np.log((MOST_BANDS - 1) / tries) / -np.log(agree))))
    bits = min(bits, 31)
    return Bands(int(np.log(1 / near) / np.log(CELL)) + 1, int(np.ceil(tries / agree**bits)), bits)


def _block_links(plan: Bands, near: float):
    """All links of each block, a pair in the first of the bands that it shares only."""

    def links(band: int, side: list, ids: list, prints: list) -> pa.RecordBatch:
        bits = read_back(prints)
        left, right = (np.flatnonzero(np.array(side) == s) for s in (0, 1))
        across = len(right) > 0
        right = right if across else left
        weights = _table("weights")[: bits.shape[1]]
        signs = np.where(bits == 2, 0.0, 1.0 - 2.0 * bits)
        size = np.abs(signs) @ weights
        alike = np.clip((signs[left] * weights) @ signs[right].T / np.maximum(size[left][:, None], size[right]), 0, 1)
        ids = np.array(ids, np.int64)
        linked = (alike >= near) & (ids[left][:, None] != ids[right])
        if not across:
            linked = np.triu(linked, 1)
        if linked.any():
            keys = plan.keys(bits)
            column = int(np.flatnonzero(keys[left[0]] == band)[0])
            for k in range(column):
                linked &= (keys[left, k][:, None] != keys[right, k]) | (keys[right, k] < 0)
        i, j = np.nonzero(linked)
        a, b = ids[left[i]], ids[right[j]]
        columns = [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(alike[i, j])]
        return pa.RecordBatch.from_arrays(columns, names=["rep_id", "other_id", "likeness"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, ([], [], [])
        for batch in batches:
            for *block, side, doc, fingerprint_ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if block != at:
                    if len(held[0]) > 1:
                        yield links(at[0], *held)
                    at, held = block, ([], [], [])
                for column, value in zip(held, (side, doc, fingerprint_), strict=True):
                    column.append(value)
        if len(held[0]) > 1:
            yield links(at[0], *held)

    return run


def near_links(docs: DataFrame, near: float = NEAR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Links ``rep_id, other_id, likeness`` between different texts whose fingerprints are alike by at least ``near``.

    Equal texts count as one document, the smallest id of them. All members of every band's bucket are compared with each
    other, in blocks of at most ``BLOCK`` by ``BLOCK`` that are tasks of their own; bits are added to the bands as texts
    become more, so that unrelated ones rarely meet. Banding finds a pair by chance: of pairs alike by exactly ``near``,
    of any length, at most ``MISSED`` are expected to share no band, and far fewer of those more alike. Every pair of
    texts is given once. Empty texts have no links, null ids are not linked, nor are two texts of one id.
    """
    prints = fingerprint(docs.where(F.col(f"`{id_col}`").isNotNull()), id_col, text_col).where("n_chars > 0")
    one = stored(prints.groupBy("text_sha256", "fingerprint").agg(F.min("doc_id").alias("doc_id")), "edit-prints")
    plan = plan_bands(one.count(), near)

    @F.pandas_udf("array<long>")
    def bands(column):
        return pd.Series([row[row >= 0] for row in plan.keys(read_back(column.tolist()))])

    found = F.explode(bands("fingerprint")).alias("band")
    crowds = one.select(found).groupBy("band").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("k"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = one.select("doc_id", "fingerprint", F.xxhash64("text_sha256").alias("draw"), found).join(crowds, "band")
    members = members.withColumn("tile", F.pmod("draw", "k").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    t1, t2 = F.least("tile", "other"), F.greatest("tile", "other")
    placed = members.select("band", t1.alias("t1"), t2.alias("t2"), (F.col("tile") > F.col("other")).cast("int").alias("side"), "doc_id", "fingerprint")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = placed.repartition(parts, "band", "t1", "t2").sortWithinPartitions("band", "t1", "t2")
    return blocks.mapInArrow(_block_links(plan, near), "rep_id long, other_id long, likeness double")
