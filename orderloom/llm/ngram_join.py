"""Jaccard join of documents over word n-grams, as a blocked sparse matrix product.

The incidence matrix has a row for each distinct set of n-grams (documents with equal sets are one row) and a column
for each n-gram. It is cut into blocks twice, and a size bound discards rows and columns before each product:

1. Column blocks, by ranges of the n-gram's hash: every n-gram learns how many rows hold it; entries of n-grams that only one
   row holds are dropped, as they add to no overlap.
2. Row blocks, by a hash of the row: a row of n n-grams that is linked to any other shares ceil(t * n) of them with it, so
   rows with fewer entries left are discarded. In the others, n-grams are put in order, rare ones first; two linked rows have
   a common n-gram among their first n - ceil(t * n) + 1. Rows that share such an n-gram, next to each other by size and
   near enough in size, form a cluster; rows of different clusters can't be linked.
3. Clusters, in tiles of bounded size: the product of a tile with its transpose, or with another tile's, gives overlap counts
   row by row, from lists of the rows of each n-gram; pairs below the bound of their sizes are discarded, which is exact.
   A tile's links are handed on as trees, never as all pairs.

N-grams that more than one in 500 rows hold meet in one place only where a row has few others: they are known beforehand, from counts of the tasks, count
as shared, and come last in the order. There are at most 500 times as many of them as n-grams in a mean row, whatever the corpus.

An n-gram is known by 48 bits of a hash of its words, a row by 64 bits of a hash of its set. A pair of rows of 500 n-grams meets a
false match with probability 1e-9.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.components import components, union
from orderloom.llm.scratch import remove, store, stored
from orderloom.llm.text import free_name, mix, ragged, raw, slabs, span_hashes, whole_text, words

KEY_BITS = 48
#: Bytes of text whose entries a task gathers before it hands them on, and for each range of n-grams.
GATHER_BYTES = 8 << 20
RANGE_BYTES = 16 << 20
#: Entries in one tile of a cluster.
TILE_ENTRIES = 1_000_000
#: An n-gram in more than one of so many rows is known beforehand; it counts in a task from this number of rows on.
HOT_SHARE = 500
HOT_AT_LEAST = 8
HOT_CLASS = 255


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The set of each text as ascending 48-bit keys, one text after the other, and the number of keys of each.

    A set holds all runs of ``width`` words, A-Z lowered; a text with fewer words is one run, one without words has none.
    """
    n = len(offsets) - 1
    starts, ends, first = words(data, offsets)
    h = span_hashes(data, starts, ends, lower=True)
    counts = np.diff(first)
    owner, values = [], []
    run = h
    for k in range(1, width + 1):
        if k > 1:
            run = mix(run[: len(run) - 1]) + h[k - 1 :] if len(run) > 1 else run[:0]
        if k < width:
            short = np.flatnonzero(counts == k)
            owner.append(short)
            values.append(mix(run[first[short]] + np.uint64(k)))
    whole = np.flatnonzero(counts >= width)
    places = ragged(first[whole], counts[whole] - width + 1)
    owner.append(np.repeat(whole, counts[whole] - width + 1))
    values.append(mix(run[places] + np.uint64(width)))
    keys = (np.concatenate(owner).astype(np.uint64) << np.uint64(KEY_BITS)) | (np.concatenate(values) >> np.uint64(64 - KEY_BITS))
    keys.sort()
    if len(keys):
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    sizes = np.bincount((keys >> np.uint64(KEY_BITS)).astype(np.int64), minlength=n)
    return keys & np.uint64((1 << KEY_BITS) - 1), sizes


def set_rows(keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of each set; 0 for the empty one."""
    out = np.zeros(len(sizes), np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        begins = (np.cumsum(sizes) - sizes)[some]
        out[some] = np.maximum(mix(np.add.reduceat(mix(keys), begins) + sizes[some].astype(np.uint64)), np.uint64(1))
    return out.view(np.int64)


def needed(sizes: np.ndarray, percent: int) -> np.ndarray:
    """How many n-grams a set must share with any set it is linked to."""
    return -(-percent * sizes // 100)


# ── rounds over the texts ──


def _signatures(width: int, carry: bool):
    """A row for each document, and with kind 1 each n-gram that many rows of this task hold. With ``carry`` a mark goes through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, size = [], [], 0

        def hot():
            row = np.concatenate(rows)
            _, first = np.unique(row, return_index=True)
            some, counts = np.unique(np.concatenate([held[i] for i in first.tolist()]) if len(first) else np.zeros(0, np.uint64), return_counts=True)
            many = counts >= max(HOT_AT_LEAST, len(first) // (2 * HOT_SHARE))
            n = int(many.sum())
            return pa.RecordBatch.from_arrays(
                [pa.array(np.ones(n, np.int32)), pa.nulls(n, pa.int64()), pa.array(counts[many]), pa.array(some[many].astype(np.int64)), *[pa.nulls(n, pa.int64())] * carry],
                names=["kind", "doc_id", "n", "row", "mark"][: 4 + carry],
            )

        for slab in slabs(batches):
            data, offsets = raw(slab.column(1))
            keys, sizes = shingle_sets(data, offsets, width)
            row = set_rows(keys, sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(row), np.int32)), slab.column(0), pa.array(sizes), pa.array(row), *slab.columns[2:]],
                names=["kind", "doc_id", "n", "row", "mark"][: 4 + carry],
            )
            edges = np.cumsum(sizes)[:-1]
            held += np.split(keys, edges)
            rows.append(row)
            size += len(data)
            if size > GATHER_BYTES:
                yield hot()
                held, rows, size = [], [], 0
        if rows:
            yield hot()

    return run


BLOB = "block int, rows binary, sizes binary, of binary, keys binary, class binary"
BLOB_NAMES = [c.split()[0] for c in BLOB.split(", ")]
BLOB_ENTRIES = 2048


def _blobs(block: np.ndarray, rows: np.ndarray, sizes: np.ndarray, of: np.ndarray, keys: np.ndarray, class_: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Entries (row number, key, class), ascending by block, as one blob for each block and at most ``BLOB_ENTRIES`` entries."""
    out = []
    cuts = np.concatenate([[0], np.flatnonzero(block[1:] != block[:-1]) + 1, [len(block)]]) if len(block) else np.zeros(1, np.int64)
    for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        for a in range(low, high, BLOB_ENTRIES):
            b = min(a + BLOB_ENTRIES, high)
            own, at = np.unique(of[a:b], return_inverse=True)
            six = keys[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
            kinds = class_[a:b].tobytes() if class_ is not None else b""
            out.append((int(block[a]), rows[own].astype("<i8").tobytes(), sizes[own].astype("<i4").tobytes(), at.astype("<u2").tobytes(), six, kinds))
        if len(out) >= 64:
            yield _blob_batch(out)
            out = []
    if out:
        yield _blob_batch(out)


def _blob_batch(out: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=BLOB_NAMES)


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[np.ndarray, ...]]]]:
    """The blocks of a task, which come in order, each as lists of (row, size, key, class) arrays."""
    at, parts = None, []
    for batch in batches:
        for r in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
            if at is not None and r[0] != at:
                yield at, parts
                parts = []
            at = r[0]
            of = np.frombuffer(r[3], "<u2")
            key = np.zeros((len(of), 8), np.uint8)
            key[:, :6] = np.frombuffer(r[4], np.uint8).reshape(-1, 6)
            kinds = np.frombuffer(r[5], np.uint8) if r[5] else np.zeros(len(of), np.uint8)
            parts.append((np.frombuffer(r[1], "<i8"), np.frombuffer(r[2], "<i4"), of, key.view("<u8").ravel(), kinds))
    if at is not None:
        yield at, parts


def _joined(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows and their sizes; row number, key and class of every entry. Empties ``parts`` on the way."""
    rows, first, at = np.unique(np.concatenate([p[0] for p in parts]), return_index=True, return_inverse=True)
    sizes = np.concatenate([p[1] for p in parts])[first]
    starts = np.cumsum([0, *(len(p[0]) for p in parts)])
    n = sum(len(p[2]) for p in parts)
    of, keys, kinds = np.empty(n, np.int32), np.empty(n, np.uint64), np.empty(n, np.uint8)
    for start in starts[-2::-1].tolist():
        part = parts.pop()
        low = n - len(part[2])
        of[low:n] = at[start + part[2].astype(np.int64)]
        keys[low:n], kinds[low:n] = part[3], part[4]
        n = low
    return rows, sizes, of, keys, kinds


def _by_range(width: int, ranges: int, hot: np.ndarray):
    """Entries of a task, dealt by ranges of keys; entries of hot keys go on by rows, in blocks of their own."""

    def out(rows, sizes, keys):
        rows, first = np.unique(np.concatenate(rows), return_index=True)
        sizes = np.concatenate(sizes)
        begins = np.cumsum(sizes) - sizes
        sizes = sizes[first]
        keys = np.concatenate(keys)[ragged(begins[first], sizes)]
        of = np.repeat(np.arange(len(rows)), sizes)
        is_hot = hot[np.minimum(np.searchsorted(hot, keys), len(hot) - 1)] == keys if len(hot) else np.zeros(len(keys), bool)
        block = ((keys >> np.uint64(KEY_BITS - 32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int32)
        block[is_hot] = ranges + _bucket(rows, ranges)[of[is_hot]]
        order = np.argsort(block, kind="stable")
        kinds = np.where(is_hot, HOT_CLASS, 0).astype(np.uint8)
        yield from _blobs(block[order], rows, sizes, of[order], keys[order], kinds[order])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, sizes, keys, held = [], [], [], 0
        for slab in slabs(batches):
            data, offsets = raw(slab.column(0))
            own, n = shingle_sets(data, offsets, width)
            row = set_rows(own, n)
            some = n > 0
            rows.append(row[some])
            sizes.append(n[some])
            keys.append(own)
            held += len(data)
            if held > GATHER_BYTES:
                yield from out(rows, sizes, keys)
                rows, sizes, keys, held = [], [], [], 0
        if rows:
            yield from out(rows, sizes, keys)

    return run


def _bucket(rows: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(rows.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)


def _shared(ranges: int):
    """Of each range of keys, the entries whose key several rows hold, with the key's class, dealt by rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, parts in _entries(batches):
            rows, sizes, of, keys, kinds = _joined(parts)
            if block < ranges:
                order = np.lexsort((of, keys))
                of, keys = of[order], keys[order]
                once = np.concatenate([[True], (keys[1:] != keys[:-1]) | (of[1:] != of[:-1])])
                of, keys = of[once], keys[once]
                first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
                counts = np.diff(np.append(first, len(keys)))
                kinds = np.repeat(np.minimum(HOT_CLASS - 1, 8 * np.log2(counts)).astype(np.uint8), counts)
                kept = np.repeat(counts > 1, counts)
                of, keys, kinds = of[kept], keys[kept], kinds[kept]
            bucket = _bucket(rows, ranges)[of]
            order = np.lexsort((of, bucket))  # by row, so that a blob names few rows
            yield from _blobs(bucket[order], rows, sizes, of[order], keys[order], kinds[order])

    return run


SETS = "row long, n int, keys binary, prefix array<long>"


def _survivors(percent: int):
    """Rows that share enough to be linked at all: their shared keys, and those that a linked row must share one of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, parts in _entries(batches):
            rows, sizes, of, keys, kinds = _joined(parts)
            order = np.lexsort((keys, kinds, of))
            of, keys, kinds = of[order], keys[order], kinds[order]
            once = np.concatenate([[True], (keys[1:] != keys[:-1]) | (of[1:] != of[:-1])])
            of, keys = of[once], keys[once]
            shared = np.bincount(of, minlength=len(rows))
            begins = np.cumsum(shared) - shared
            need = needed(sizes.astype(np.int64), percent)
            out = []
            for i in np.flatnonzero(shared >= need).tolist():
                own = keys[begins[i] : begins[i] + shared[i]]
                reach = int(sizes[i] - need[i] + 1 - (sizes[i] - shared[i]))
                out.append((int(rows[i]), int(sizes[i]), np.sort(own).astype("<u8").tobytes(), own[:reach].astype(np.int64).tolist()))
                if len(out) == 500:
                    yield _sets_batch(out)
                    out = []
            if out:
                yield _sets_batch(out)

    return run


def _sets_batch(out: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["row", "n", "keys", "prefix"])


# ── tiles ──


def tile_links(sets: list[np.ndarray], sizes: np.ndarray, sides: np.ndarray | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """All linked pairs (i < j) of a tile, or of two tiles across, by overlap counts from the rows of each key."""
    lengths = np.array([len(s) for s in sets])
    _, columns = np.unique(np.concatenate(sets), return_inverse=True)
    of = np.repeat(np.arange(len(sets)), lengths)
    order = np.argsort(columns, kind="stable")
    held_by = of[order]
    counts = np.bincount(columns)
    begins = np.cumsum(counts) - counts
    ends = np.cumsum(lengths)
    left, right = [], []
    for i in range(len(sets) - 1):
        own = columns[ends[i] - lengths[i] : ends[i]]
        overlap = np.bincount(held_by[ragged(begins[own], counts[own])], minlength=len(sets))[i + 1 :]
        linked = (overlap > 0) & (100 * overlap >= percent * (sizes[i] + sizes[i + 1 :] - overlap))
        if sides is not None:
            linked &= sides[i + 1 :] != sides[i]
        found = np.flatnonzero(linked)
        left.append(np.full(len(found), i))
        right.append(found + i + 1)
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64),) * 2


def _products(percent: int):
    """Links of each tile as trees: every row with the smallest one it is joined to within the tile."""

    def links(rows, sizes, keys, sides) -> pa.RecordBatch:
        rows, sizes = np.array(rows, np.int64), np.array(sizes, np.int64)
        side = np.array(sides)
        i, j = tile_links([np.frombuffer(k, "<u8") for k in keys], sizes, side if side.any() else None, percent)
        nodes, least = union(rows[i], rows[j])
        some = nodes != least
        return pa.RecordBatch.from_arrays([pa.array(nodes[some]), pa.array(least[some])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, ([], [], [], [])
        for batch in batches:
            tiles = list(zip(*(batch.column(c).to_pylist() for c in ("cluster", "b1", "t1", "b2", "t2")), strict=True))
            for tile, *values in zip(tiles, *(batch.column(c).to_pylist() for c in ("row", "n", "keys", "side")), strict=True):
                if tile != at:
                    if len(held[0]) > 1:
                        yield links(*held)
                    at, held = tile, ([], [], [], [])
                for column, value in zip(held, values, strict=True):
                    column.append(value)
        if len(held[0]) > 1:
            yield links(*held)

    return run


def _tiles(members: DataFrame, percent: int) -> DataFrame:
    """Every row of a cluster in each pair of tiles that it takes part in.

    A cluster of at most ``TILE_ENTRIES`` entries is one tile. Others are cut by bands of size, so that linked rows lie in one
    band or in neighbouring ones, and by a hash of the row within the band.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(-np.log(percent / 100 - 1e-9))).cast("int")
    whole = members.groupBy("cluster").agg(F.sum(F.col("n").cast("long")).alias("entries"))
    sized = members.join(whole, "cluster").withColumn("band", F.when(F.col("entries") > TILE_ENTRIES, band).otherwise(F.lit(0)))
    counts = (
        sized.groupBy("cluster", "band")
        .agg(F.sum(F.col("n").cast("long")).alias("n"))
        .select("cluster", "band", F.ceil(F.col("n") / F.lit(TILE_ENTRIES)).cast("int").alias("k"))
    )
    for name, shift in (("k0", 0), ("up", 1), ("down", -1)):
        other = counts.select("cluster", (F.col("band") - shift).alias("band"), F.col("k").alias(name))
        sized = sized.join(other, ["cluster", "band"], "left")
    sized = sized.withColumn("tile", F.pmod(F.xxhash64("row"), F.col("k0")).cast("int"))

    def span(k: str) -> Column:
        return F.when(F.coalesce(k, F.lit(0)) > 0, F.sequence(F.lit(0), F.col(k) - 1)).otherwise(F.array().cast("array<int>"))

    def place(b1, t1, b2, t2, side) -> Column:
        return F.struct(b1.alias("b1"), t1.alias("t1"), b2.alias("b2"), t2.alias("t2"), side.cast("int").alias("side"))

    b, t = F.col("band"), F.col("tile")
    places = F.concat(
        F.transform(span("k0"), lambda j: place(b, F.least(t, j), b, F.greatest(t, j), t > j)),
        F.transform(span("up"), lambda j: place(b, t, b + 1, j, F.lit(0))),
        F.transform(span("down"), lambda j: place(b - 1, j, b, t, F.lit(1))),
    )
    out = sized.select("cluster", "row", "n", "keys", F.explode(places).alias("p")).select("cluster", "p.*", "row", "n", "keys")
    return out.select("cluster", "b1", "t1", "b2", "t2", "side", "row", "n", "keys")


# ── the join ──


def similar_groups(docs: DataFrame, width: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row: ``doc_id, n_shingles, component_id``.

    Texts are linked when their sets of ``width``-word n-grams (A-Z lowered; a text of fewer words is one n-gram) overlap in at
    least ``percent`` in a hundred of their union. ``component_id`` is the smallest id that can be reached by links. A null or
    empty text, or one without words, has an empty set and is linked with nothing. Equal texts are linked, so repeated rows
    share a component; null ids never name one unless all ids of a component are null. An empty table gives no rows; other
    columns are not looked at. Long texts are taken whole.
    """
    return _groups(docs, width, percent, id_col, text_col).select("doc_id", "n_shingles", "component_id")


def _groups(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str, mark: Column | None = None) -> DataFrame:
    """As :func:`similar_groups`, with ``component``, which tells components of one smallest id apart (null: empty), and ``mark``."""
    carried = ["mark"] if mark is not None else []
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), whole_text(text_col).alias("text"), *([mark.alias("mark")] if carried else []))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, -(-size // RANGE_BYTES))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(ranges, 100_000))

    marked = stored(rows.mapInArrow(_signatures(width, bool(carried)), ", ".join(["kind int, doc_id long, n long, row long", *(f"{c} long" for c in carried)])), "ngram-rows")
    signed = marked.where("kind = 0")
    sets = signed.where("n > 0").groupBy("row").agg(F.min("doc_id").alias("least_id"))
    n_rows = sets.count()
    often = marked.where("kind = 1").groupBy("row").agg(F.sum("n").alias("n")).where(F.col("n") >= max(2 * HOT_AT_LEAST, n_rows // HOT_SHARE))
    hot = np.sort(np.array([r["row"] for r in often.select("row").collect()], np.int64).astype(np.uint64))

    entries = rows.select("text").mapInArrow(_by_range(width, ranges, hot), BLOB)
    shared = entries.repartition(parts, "block").sortWithinPartitions("block").mapInArrow(_shared(ranges), BLOB)
    kept = shared.repartition(parts, "block").sortWithinPartitions("block").mapInArrow(_survivors(percent), SETS)
    kept_path = store(kept, "ngram-sets")
    kept = spark.read.schema(SETS).parquet(kept_path)

    from pyspark.sql import Window

    by_size = Window.partitionBy("key").orderBy("n", "row")
    beside = kept.select("row", "n", F.explode("prefix").alias("key")).select("row", "n", F.lag("row").over(by_size).alias("other"), F.lag("n").over(by_size).alias("smaller"))
    near = beside.where(F.col("other").isNotNull() & (F.lit(100) * F.col("smaller") >= F.lit(percent) * F.col("n")))
    clusters = components(near.select(F.col("row").alias("a"), F.col("other").alias("b")))
    members = kept.select("row", "n", "keys").join(clusters.select(F.col("node").alias("row"), F.col("component").alias("cluster")).union(clusters.select(F.col("component"), F.col("component")).distinct()), "row")
    place = ["cluster", "b1", "t1", "b2", "t2"]
    tiles = _tiles(members, percent).repartition(parts, *place).sortWithinPartitions(*place)
    groups = components(tiles.mapInArrow(_products(percent), "a long, b long"))
    remove(spark, kept_path)

    named = groups.select(F.col("node").alias("row"), "component").union(groups.select(F.col("component"), F.col("component")).distinct())
    linked = sets.join(named, "row")
    least = linked.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_linked = linked.join(least, "component").select("row", "component", "component_id")
    of_set = sets.join(of_linked, "row", "left").select("row", F.coalesce("component", "row").alias("component"), F.coalesce("component_id", "least_id").alias("component_id"))
    found = signed.where("n > 0").join(of_set, "row", "left").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "component", *carried)
    return found.union(signed.where("n = 0").select("doc_id", F.col("n"), "doc_id", F.lit(None).cast("long"), *carried))


def drop_similar(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, without those that are linked to one of a smaller id, directly or not.

    Of each component the row with its smallest id stays, of rows that repeat that id one: the one with the smallest hash
    of its text. An id that is repeated with different texts is decided for each of them. Empty texts and rows with a null
    id are linked with nothing here and stay.
    """
    mark, text = free_name(docs, "similar_id"), free_name(docs, "similar_text")
    print_ = F.xxhash64(whole_text(text_col))
    known = docs.where(F.col(f"`{id_col}`").isNotNull())
    found = _groups(known, width, percent, id_col, text_col, print_)
    key = [F.col("doc_id").alias(mark), F.col("mark").alias(text)]

    def same(rows: DataFrame):
        return (rows[id_col].cast("long") == F.col(mark)) & (print_ == F.col(text))

    dropped = found.where(F.col("doc_id") != F.col("component_id")).select(*key).distinct()
    left = docs.join(dropped, same(docs), "left_anti")
    heads = found.where("doc_id = component_id AND n_shingles > 0")
    sized = heads.groupBy("doc_id", "component").agg(F.count(F.lit(1)).alias("number"), F.min("mark").alias("least")).where("number > 1")
    if sized.isEmpty():
        return left
    # Only ids that are repeated in a component need one of their rows chosen.
    repeated = heads.join(sized, ["doc_id", "component"]).select("doc_id", "mark", "least").distinct()
    chosen = left.join(repeated.where("mark = least").select(*key), same(left), "left_semi").withColumn(text, print_).dropDuplicates([id_col, text]).drop(text)
    return left.join(repeated.select(*key), same(left), "left_anti").union(chosen)
