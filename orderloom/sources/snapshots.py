"""Versions of a warehouse: whatever a batch changes becomes visible at once, or not at all.

A table is a list of *parts*, folders that are written once and never changed. A version is one small manifest,
``_versions/<n>.json``, that names the parts of every table. Readers take the newest manifest and see all tables as of that
version, however long they read. A writer stages new parts beside the old ones and then publishes the next manifest; the
file is created with its whole content only if it does not exist yet, so of two writers that start from one version the
second fails, and nothing of it is seen. A writer that dies leaves folders that no manifest names; :func:`clean_up` takes
them away.

Manifests hold one entry for each batch and table, no rows; the driver reads one of them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass
from functools import partial, reduce
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from orderloom.schemas import FACT_COLUMNS, WAREHOUSE_TABLES, YEAR
from orderloom.session import drop_path, file_system, run_together
from orderloom.sources.files import create_whole
from orderloom.sources.writers import FIRST_BATCH, check_contract, conformed, write_table

VERSIONS = "_versions"
PART = "part="
BATCH = "batch_id"
#: Name and number of the folders that a batch deals the values of its first cluster column to.
CLUSTER, CLUSTERS = "_cluster", 16


class StaleWriter(RuntimeError):
    """Another writer has published the version that this one was about to."""


@dataclass(frozen=True)
class Part:
    """A folder of rows, the batch that wrote it, and the columns that name the folders in it. Two tables may read one part:
    each takes its own columns."""

    path: str
    batch: str
    rows: int
    folders: tuple[str, ...] = ()


@dataclass(frozen=True)
class Table:
    schema: StructType
    parts: tuple[Part, ...]


@dataclass(frozen=True)
class Version:
    number: int
    tables: Mapping[str, Table]

    def as_text(self) -> str:
        tables = {
            name: {"schema": t.schema.jsonValue(), "parts": [{**asdict(p), "folders": list(p.folders)} for p in t.parts]}
            for name, t in self.tables.items()
        }
        return json.dumps({"version": self.number, "tables": tables})

    @staticmethod
    def of_text(text: str) -> Version:
        given = json.loads(text)
        tables = {n: Table(StructType.fromJson(t["schema"]), tuple(Part(**{**p, "folders": tuple(p.get("folders", ()))}) for p in t["parts"])) for n, t in given["tables"].items()}
        return Version(given["version"], tables)


def newest(spark: SparkSession, folder: str) -> Version:
    """The version that readers see now; number 0, without tables, where nothing was published yet."""
    numbers = _numbers(spark, folder)
    return version(spark, folder, numbers[-1]) if numbers else Version(0, {})


def version(spark: SparkSession, folder: str, number: int) -> Version:
    return Version.of_text(spark.read.text(_manifest(folder, number), wholetext=True).first()[0])


def open_tables(spark: SparkSession, folder: str, seen: Version, names: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """Tables of a version by name; all missing ones are reported together."""
    names = list(seen.tables if names is None else names)
    missing = [n for n in names if n not in seen.tables]
    if missing:
        raise FileNotFoundError(f"missing in {folder}: {', '.join(missing)}")
    return {n: _read(spark, folder, seen.tables[n]) for n in names}


def _read(spark: SparkSession, folder: str, table: Table) -> DataFrame:
    alike: dict[tuple, list[str]] = {}  # one reader takes parts that lie in one place and have the same folders
    for p in table.parts:
        if p.rows:
            alike.setdefault((p.path.split("/")[0], p.folders), []).append(f"{folder}/{p.path}")
    if not alike:
        return spark.createDataFrame([], table.schema)
    columns = [F.col(f"`{c}`") for c in table.schema.names]  # without the name of the part
    found = [spark.read.schema(table.schema).option("basePath", f"{folder}/{place}").parquet(*paths).select(*columns) for (place, _), paths in alike.items()]
    return reduce(DataFrame.unionByName, found)


class Changes:
    """What a writer stages on top of the newest version. Leaving the block without ``publish`` drops it all.

    With ``afresh`` the tables start empty. Several threads may stage parts at once.
    """

    def __init__(self, spark: SparkSession, folder: str, afresh: bool = False):
        self.spark, self.folder = spark, folder
        self.base = newest(spark, folder)
        self.tables: dict[str, Table] = {} if afresh else dict(self.base.tables)
        self._name = f"{PART}v{self.base.number + 1}-{uuid.uuid4().hex[:12]}"
        self._staged: list[str] = []
        self._lock = Lock()
        self.published = False

    def __enter__(self) -> Changes:
        return self

    def __exit__(self, *error) -> None:
        if not self.published:
            for path in self._staged:
                drop_path(self.spark, f"{self.folder}/{path}")

    def read(self, *names: str) -> dict[str, DataFrame]:
        """Tables with what has been staged so far."""
        return open_tables(self.spark, self.folder, Version(self.base.number, self.tables), names)

    def batch(self, name: str, batch: str) -> DataFrame:
        """What one batch holds of a table."""
        table = self.tables[name]
        return _read(self.spark, self.folder, Table(table.schema, tuple(p for p in table.parts if p.batch == batch)))

    def rows(self, name: str, batch: str) -> int:
        """Number of rows that one batch holds of a table."""
        return sum(p.rows for p in self.tables[name].parts if p.batch == batch)

    def put_batch(
        self, name: str, df: DataFrame, batch: int | str, partition_by: Iterable[str] = (), cluster_by: Iterable[str] = ()
    ) -> int:
        """Add the rows of a batch, in place of what the same batch wrote before; ``batch_id`` becomes a column.

        Types are those of the first batch; what they cannot hold is an error before anything is written. Rows are not
        shuffled: each task writes a file for each folder of ``partition_by``, in the order of ``cluster_by``. Values of the
        first of these columns are dealt to ``CLUSTERS`` folders, so a scan for a few values passes over the files, and for
        the others over the row groups, that hold other ones.
        """
        by = [BATCH, *partition_by]
        if name in self.tables:
            df = conformed(df, StructType([f for f in self.tables[name].schema.fields if f.name != BATCH]), name)
        rows = df.withColumn(BATCH, F.lit(str(batch)))
        schema = StructType([*[f for f in df.schema.fields if f.name not in by], StructField(BATCH, StringType()), *[df.schema[c] for c in partition_by]])
        cluster = list(cluster_by)
        if cluster:
            by = [*by, CLUSTER]
            rows = rows.withColumn(CLUSTER, F.pmod(F.xxhash64(cluster[0]), F.lit(CLUSTERS)).cast("int")).sortWithinPartitions(*by, *cluster)
        return self._stage(name, rows, str(batch), schema, by, lambda p: p.batch != str(batch))

    def share_batch(self, name: str, of: str, batch: int | str, columns: Iterable[str]) -> int:
        """Let ``name`` hold ``columns`` of what a batch holds of the table ``of``, without writing the rows again."""
        table, batch = self.tables[of], str(batch)
        part = next(p for p in table.parts if p.batch == batch)
        names = [*[c for c in columns if c not in part.folders], *[c for c in part.folders if c in table.schema.names]]
        return self._stage(name, None, batch, StructType([table.schema[c] for c in names]), [], lambda p: p.batch != batch, written=part)

    def put(self, name: str, df: DataFrame, batch: int | str = "") -> int:
        """Replace a whole table."""
        return self._stage(name, df, str(batch), df.schema, [], lambda p: False)

    def add(self, name: str, df: DataFrame, batch: int | str) -> int:
        """Add rows to a table, in its columns and types; nothing is added where there are none."""
        schema = self.tables[name].schema
        return self._stage(name, conformed(df, schema, name), str(batch), schema, [], lambda p: True, empty=False)

    def _stage(
        self, name: str, df: DataFrame | None, batch: str, schema: StructType, by: list[str], stays, empty: bool = True, written: Part | None = None
    ) -> int:
        """Write ``df`` as a part, or take the part that is ``written`` already."""
        if written is None:
            with self._lock:
                path = f"{name}/{self._name}-{len(self._staged)}"
                self._staged.append(path)
            written = Part(path, batch, write_table(df, f"{self.folder}/{path}", partition_by=by), tuple(by))
        nullable = StructType([StructField(f.name, f.dataType) for f in schema.fields])
        with self._lock:
            old = self.tables[name].parts if name in self.tables else ()
            new = (written,) if written.rows or empty else ()
            self.tables[name] = Table(nullable, tuple(p for p in old if stays(p)) + new)
        return written.rows

    def publish(self) -> Version:
        """Make everything visible as the next version, or raise :class:`StaleWriter` and change nothing."""
        done = Version(self.base.number + 1, self.tables)
        if not create_whole(self.spark, _manifest(self.folder, done.number), done.as_text()):
            raise StaleWriter(f"{self.folder}: version {done.number} was published by another writer")
        self.published = True
        return done


def _manifest(folder: str, number: int) -> str:
    return f"{folder}/{VERSIONS}/{number:012d}.json"


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    files, place = file_system(spark, f"{folder}/{VERSIONS}")
    if not files.exists(place):
        return []
    names = [s.getPath().getName() for s in files.listStatus(place)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def clean_up(spark: SparkSession, folder: str, keep: int = 2) -> list[str]:
    """Drop all but the newest ``keep`` versions, and the folders that none of those names; return what was dropped.

    Folders of a writer that is still at work on the next version stay.
    """
    numbers = _numbers(spark, folder)
    kept = [version(spark, folder, n) for n in numbers[-max(keep, 1) :]]
    used = {p.path for v in kept for t in v.tables.values() for p in t.parts}
    files, place = file_system(spark, folder)
    dropped = [f"{VERSIONS}/{n:012d}.json" for n in numbers[: -max(keep, 1)]]
    for table in files.listStatus(place):
        name = table.getPath().getName()
        if table.isDirectory() and not name.startswith("_"):
            for part in files.listStatus(table.getPath()):
                path = f"{name}/{part.getPath().getName()}"
                staged_for = part.getPath().getName().removeprefix(f"{PART}v").split("-")[0]
                if path not in used and staged_for.isdigit() and int(staged_for) <= numbers[-1]:
                    dropped.append(path)
    for path in dropped:
        drop_path(spark, f"{folder}/{path}")
    return dropped


def load_warehouse(spark: SparkSession, tables: Mapping[str, DataFrame], folder: str) -> DataFrame:
    """Replace the ten warehouse tables as one and return ``(table_name, n_rows)``."""
    with Changes(spark, folder, afresh=True) as new:
        counts = run_together([partial(_load, new, name, tables[name]) for name in WAREHOUSE_TABLES])
        new.publish()
    return spark.createDataFrame(list(zip(WAREHOUSE_TABLES, counts)), "table_name string, n_rows bigint")


def _load(new: Changes, name: str, df: DataFrame) -> int:
    if name == "fact_orders":
        return put_orders(new, name, check_contract(df.select(*FACT_COLUMNS), name), FIRST_BATCH)
    return new.put(name, check_contract(df, name))


def put_orders(new: Changes, name: str, df: DataFrame, batch: int | str, cluster_by: Iterable[str] = ()) -> int:
    """Stage a batch of order rows, by order year: a report on some years reads only those."""
    return new.put_batch(name, df.withColumn(YEAR, F.year("order_date")), batch, [YEAR], cluster_by)
