"""Shards by a hierarchical weighted hash tree, in DataFrame expressions only.

A key descends region, rack and shard. At each level every child draws ``-ln(u) / weight``, where u
comes from a hash of the key and the child's name, and the smallest draw wins. A child's draw depends on
nothing but its own weight, so a change of weights moves rows only into or out of the subtrees on the
changed paths. A new shard that is to take rows only into itself is put in a region of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.text import free_name, whole_text

#: Rows that are numbered together inside a shard.
ROWS_PER_RUN = 2048
SEED = "shard-tree"


@dataclass(frozen=True)
class Shard:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def even_tree(regions: int, racks: int, shards: int) -> list[Shard]:
    """``regions * racks * shards`` shards of equal weight, numbered from 0."""
    return [
        Shard(f"region{a}", f"rack{b}", (a * racks + b) * shards + c)
        for a in range(regions)
        for b in range(racks)
        for c in range(shards)
    ]


def grown(tree: list[Shard], weight: float = 1.0) -> list[Shard]:
    """The tree with one more shard, in a region of its own: it takes rows only into itself."""
    names = {s.region for s in tree}
    region = next(f"region{i}" for i in range(len(names) + 1) if f"region{i}" not in names)
    return [*tree, Shard(region, "rack0", max((s.shard for s in tree), default=-1) + 1, weight)]


def _children(tree: list[Shard]) -> list[list[tuple[str, float, int]]]:
    """For every inner node, the root first, its children as (path, weight, node); a shard stands as its own number."""
    live = [s for s in tree if s.weight > 0]
    if not live:
        raise ValueError("the tree has no shard with a weight")
    levels = ("region", "rack", "shard")
    nodes, todo = [[]], [(0, "", live, 0)]
    while todo:
        node, path, shards, level = todo.pop(0)
        groups: dict[str, list[Shard]] = {}
        for s in shards:
            groups.setdefault(str(getattr(s, levels[level])), []).append(s)
        for name, group in groups.items():
            below = f"{path}/{name}"
            if level == len(levels) - 1:
                nodes[node].append((below, group[0].weight, group[0].shard))
            else:
                nodes.append([])
                nodes[node].append((below, float(sum(s.weight for s in group)), len(nodes) - 1))
                todo.append((len(nodes) - 1, below, group, level + 1))
    return nodes


def with_shard(df: DataFrame, key: str, tree: list[Shard], out: str) -> DataFrame:
    """``df`` with the shard of the text column ``key`` in the column ``out``. A null key is the word null.

    Shards of weight 0 get nothing; the tree must hold some weight. Equal draws go to the first child. Each level is a
    projection of its own, so only the draws of the chosen node's children are computed.
    """
    nodes = _children(tree)

    def winner(children: list[tuple[str, float, int]]) -> str:
        if len(children) == 1:
            return str(children[0][2])
        draws = []
        for place, (path, weight, node) in enumerate(children):
            text = f"{SEED}{path}/".replace("\\", "\\\\").replace("'", "\\'")
            bits = f"cast(conv(substring(md5(concat('{text}', coalesce(`{key}`, 'null'))), 1, 13), 16, 10) AS double)"
            draws.append(f"struct(-ln(({bits} + 1D) / {1 << 52}D) / {float(weight)!r}D AS value, {place} AS place, {node} AS node)")
        return f"array_min(array({', '.join(draws)})).node"

    at = free_name(df, f"{out}_node")
    level = [0]
    df = df.withColumn(at, F.expr(winner(nodes[0])))
    for _ in range(2):
        level = [child[2] for node in level for child in nodes[node]]
        df = df.withColumn(at, F.expr(f"CASE `{at}` {' '.join(f'WHEN {n} THEN {winner(nodes[n])}' for n in level)} END"))
    return df.withColumn(out, F.coalesce(F.col(at), F.lit(0))).drop(at)


def assign(docs: DataFrame, tree: list[Shard], more: list[Shard] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    The law is ``key``: id and tree decide, the text does not. ``size`` is the UTF-8 length of the text plus 8 (a null
    text has none), ``slot`` numbers the rows of a shard from 0 without gaps, ``grown_shard`` is the shard under ``more``.
    A null id is a key of its own, the word null. Rows with the same id share a shard and have slots of their own. An
    empty table gives no rows; other columns are not looked at.

    Slots: rows of a shard fall into runs by a hash of their key, are numbered inside the run, and get the number of
    rows in the runs before it. So no task holds a whole shard where ids are distinct; rows of one repeated or null
    id are numbered in one task.
    """
    runs = max(1, -(-docs.count() // (len(tree) * ROWS_PER_RUN)))
    number = F.conv(F.substring(F.md5(F.concat(F.lit(f"{SEED}/slot/"), F.coalesce(F.col("key"), F.lit("null")))), 1, 8), 16, 10)

    def placed(*more_columns: Column) -> DataFrame:
        rows = docs.select(F.col(f"`{id_col}`").cast("string").alias("key"), *more_columns)
        return with_shard(rows.withColumn("run", F.coalesce(number.cast("long") % F.lit(runs), F.lit(0))), "key", tree, "shard")

    rows = placed(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        (F.octet_length(whole_text(text_col)) + F.lit(8)).cast("long").alias("size"),
        F.crc32(whole_text(text_col).cast("binary")).alias("text_crc32"),
    )
    rows = with_shard(rows, "key", more, "grown_shard") if more else rows.withColumn("grown_shard", F.lit(None).cast("int"))
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        placed()
        .groupBy("shard", "run")
        .agg(F.count(F.lit(1)).alias("rows_in_run"))
        .select("shard", "run", F.coalesce(F.sum("rows_in_run").over(before), F.lit(0)).alias("rows_before"))
    )
    inside = Window.partitionBy("shard", "run").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("rank", F.row_number().over(inside).cast("long"))
    return numbered.join(sizes, ["shard", "run"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("rank") - 1 + F.col("rows_before")).alias("slot"),
        "grown_shard",
    )
