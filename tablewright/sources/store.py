"""Published tables on storage without row-level updates.

A published table is a view over *parts*: ordinary managed parquet tables that
are written once and never changed. A run writes its new rows as one part and
then replaces the view in a single catalog statement, so readers see the old
rows or the new ones and a failed run leaves the table as it was.

The view puts predicates in front of older parts (``Change.goes``). Replacing
a time window, deleting a list of keys or partitions and closing versions thus
cost as much as the rows they touch, not as much as the table; the predicates
reach the parts' scans. A part without remaining rows is let go, one with more
rows gone than left is rewritten, and when a table has gathered many parts the
smaller ones are folded into one. So a table never takes much more than twice
the space of its rows, and never reads from more than ``max_parts`` parts.

One writer per table is assumed; a second one is noticed before it publishes.
"""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from ..functions.literals import text_literal
from ..functions.types import quote, quote_table
from ..plans.change import EVERYTHING, NOTHING, Change, keep_unless
from ..plans.curve import curve
from ..plans.sizing import in_few_tasks
from ..plans.touched import FILE
from ..operators.checks import Watch
from ..spec import IS_CURRENT, TableSpec

_STATE = "tablewright.state"
_PART = re.compile(r"__p\d{6}_[0-9a-f]{8}$")


class PublishError(RuntimeError):
    """The table cannot be published as asked."""


@dataclass(frozen=True)
class Part:
    """A stored table, the predicates before it, its rows and those that are left.

    ``only`` limits a part to some partitions of its table: open and closed
    versions are parts of their own, though one job writes both.
    """

    table: str
    keep: tuple[str, ...] = ()
    rows: int = 0
    left: int = 0
    only: str = ""

    @property
    def conditions(self) -> tuple[str, ...]:
        return (self.only, *self.keep) if self.only else self.keep


@dataclass(frozen=True)
class State:
    """What a published table consists of; kept as a property of its view."""

    version: int
    parts: tuple[Part, ...]
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    retired: tuple[str, ...] = ()
    batches: tuple[tuple[str, int], ...] = ()  # of each stream, the last batch that is in the table

    def to_json(self) -> str:
        return json.dumps(
            {
                "version": self.version,
                "parts": [[p.table, list(p.keep), p.rows, p.left, p.only] for p in self.parts],
                "partition_by": self.partition_by,
                "cluster_by": self.cluster_by,
                "retired": self.retired,
                "batches": self.batches,
            }
        )

    @staticmethod
    def from_json(text: str) -> State:
        raw = json.loads(text)
        return State(
            raw["version"],
            tuple(Part(table, tuple(keep), *rest) for table, keep, *rest in raw["parts"]),
            tuple(raw["partition_by"]),
            tuple(raw["cluster_by"]),
            tuple(raw["retired"]),
            tuple((stream, batch) for stream, batch in raw.get("batches", ())),
        )


class TableStore:
    """Creates, changes and reads published tables of one Spark catalog.

    New schemas are placed under ``location``, by default where the catalog
    puts them. A commit that leaves more than ``max_parts`` parts, or more than
    ``max_masks`` predicates before one part, is followed by a rewrite of parts.
    """

    def __init__(
        self,
        spark: SparkSession,
        location: str | None = None,
        max_parts: int = 32,
        max_masks: int = 16,
    ) -> None:
        self.spark = spark
        self.location = location
        self.max_parts = max_parts
        self.max_masks = max_masks

    # -- looking things up -------------------------------------------------

    def full_name(self, name: str) -> str:
        return name if "." in name else f"{self.spark.catalog.currentDatabase()}.{name}"

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(quote_table(self.full_name(name)))

    def state(self, name: str) -> State | None:
        """The state of a table published here; ``None`` for anything else."""
        full = self.full_name(name)
        if not self.exists(full):
            return None
        listed = self.spark.sql(f"SHOW TBLPROPERTIES {quote_table(full)}")
        found = listed.filter(F.col("key") == _STATE).collect()
        return State.from_json(found[0]["value"]) if found else None

    def read(self, name: str) -> DataFrame:
        return self.spark.table(quote_table(self.full_name(name)))

    def target(self, name: str) -> DataFrame | None:
        """The table to be changed, or ``None`` if there is none yet.

        A plain table is taken over first.
        """
        if not self.exists(name):
            return None
        if self.state(name) is None and not self._is_view(self.full_name(name)):
            self.adopt(name)
        return self.read(name)

    def filed(self, name: str) -> DataFrame | None:
        """The table's rows with the name of the file each is stored in, as ``touched.FILE``.

        ``None`` where files are not known: other views, and tables taken over
        that are no files to Spark or hide the files' names by a column of theirs.
        """
        state = self.state(name)
        columns = self.read(name).columns
        if state is None or not state.parts or {"_metadata", FILE} & {c.lower() for c in columns}:
            return None
        try:
            return self.spark.sql(_select(columns, state.parts, f"_metadata.file_name AS {FILE}"))
        except AnalysisException:
            return None

    # -- changing tables ---------------------------------------------------

    def create_schema(self, name: str) -> None:
        """Create the schema of a qualified table name unless it exists."""
        if "." not in name:
            return
        schema = name.split(".")[0]
        if self.spark.catalog.databaseExists(schema):
            return
        place = f" LOCATION {text_literal(f'{self.location}/{schema}.db')}" if self.location else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(schema)}{place}")

    def declare(self, spec: TableSpec) -> bool:
        """Create an empty table with the declared columns; leave an existing one alone."""
        if self.exists(spec.name):
            return False
        empty = self.spark.createDataFrame([], spec.schema())
        self.commit(spec, Change(EVERYTHING, empty))
        return True

    def replace(self, spec: TableSpec, rows: DataFrame, watch: Watch | None = None) -> None:
        """Make the table consist of ``rows``, with their schema."""
        self.commit(spec, Change(EVERYTHING, rows), new_layout=True, watch=watch)

    def has_batch(self, name: str, batch: tuple[str, int]) -> bool:
        """Whether a stream's batch, or a later one, is in the published table."""
        state = self.state(name)
        return state is not None and dict(state.batches).get(batch[0], -1) >= batch[1]

    def commit(
        self,
        spec: TableSpec,
        change: Change,
        new_layout: bool = False,
        batch: tuple[str, int] | None = None,
        watch: Watch | None = None,
    ) -> None:
        """Write the rows of ``change`` and publish the next state of the table.

        The ``batch`` of a stream is published in the same statement as its rows.
        ``watch`` counts checks of the rows while they are written.
        """
        self.create_schema(spec.name)
        full = self.full_name(spec.name)
        before = self.state(full)
        if before is None and self.exists(full):
            if self._is_view(full):
                raise PublishError(f"{full} is a view that was not published here")
            self.adopt(full)
            before = self.state(full)
        if before is None or new_layout:
            partition_by, cluster_by = tuple(spec.partition_by), tuple(spec.cluster_by)
        else:
            partition_by, cluster_by = before.partition_by, before.cluster_by
        old_parts = before.parts if before else ()
        version = before.version + 1 if before else 1
        schema = change.rows.schema
        if before and not new_layout:
            schema = self.read(full).schema
        schema = _described(schema, spec)

        written = self._write(full, version, change.rows, partition_by, cluster_by, spec.is_scd2, True, watch)
        if change.goes is NOTHING:
            kept = old_parts
        elif change.goes == EVERYTHING:
            kept = ()
        else:
            kept = self._without(old_parts, change.goes)
        kept = tuple(p for p in kept if p.left)
        unused = [written[0].table] if kept and not any(p.rows for p in written) else []
        parts = kept if unused else (*kept, *written)
        batches = {**dict(before.batches if before else ()), **dict([batch] if batch else [])}
        state = State(version, parts, partition_by, cluster_by, batches=tuple(sorted(batches.items())))
        self._publish(full, schema, before, state)
        self._drop(unused)
        self._tidy(full, state, spec.is_scd2)

    def _without(self, parts: Sequence[Part], goes: str) -> tuple[Part, ...]:
        """The parts less the rows that go, which are counted by one pruned scan each."""
        if not parts:
            return ()
        counts = []
        for i, p in enumerate(parts):
            going = self.spark.table(quote_table(p.table))
            for condition in (*p.conditions, goes):
                going = going.filter(F.expr(condition))
            counts.append(going.agg(F.lit(i).alias("i"), F.count(F.lit(1)).alias("n")))
        gone = {row["i"]: row["n"] for row in reduce(DataFrame.union, counts).collect()}
        kept = []
        for i, p in enumerate(parts):
            if gone[i] == 0:
                kept.append(p)
            elif gone[i] < p.left:
                kept.append(replace(p, keep=(*p.keep, keep_unless(goes)), left=p.left - gone[i]))
        return tuple(kept)

    def _tidy(self, full: str, state: State, scd2: bool) -> None:
        """Rewrite parts that are mostly gone; fold the smaller parts when there are many."""
        old = [p for p in state.parts if p.left * 2 < p.rows or len(p.keep) > self.max_masks]
        count = len(state.parts) - len(old) + bool(old)
        if count > self.max_parts:
            # The smallest parts, and on while the next is no larger than those together: a row's
            # part at least doubles with most folds it goes through, so it is seldom rewritten.
            rest = sorted((p for p in state.parts if p not in old), key=lambda p: p.left)
            enough, total = len(state.parts) - self.max_parts + 1, sum(p.left for p in old)
            for part in rest:
                if len(old) >= enough and part.left > total:
                    break
                old.append(part)
                total += part.left
        if old:
            self._fold(full, old, scd2)

    def compact(self, name: str, scd2: bool = False) -> None:
        """Rewrite the table as one part."""
        full = self.full_name(name)
        state = self.state(full)
        if state is None:
            raise PublishError(f"{full} was not published here")
        self._fold(full, state.parts, scd2, apart=False)

    def _fold(self, full: str, old: Sequence[Part], scd2: bool, apart: bool = True) -> None:
        """Put one new part in place of some; of versions, one for open and one for closed ones."""
        before = self.state(full)
        schema = self.read(full).schema
        rows = self.spark.sql(_select(schema.names, old))
        version = before.version + 1
        written = self._write(full, version, rows, before.partition_by, before.cluster_by, scd2, apart)
        kept = tuple(p for p in before.parts if p not in old)
        state = replace(before, version=version, parts=(*kept, *written))
        self._publish(full, schema, before, state, same_rows=True)

    def create_view(self, name: str, query: str) -> None:
        """Make ``name`` stand for ``query``, evaluated on read.

        A table of that name gives way, whether published here or not.
        """
        self.create_schema(name)
        full = self.full_name(name)
        before = self.state(full)
        self.spark.sql(query).schema  # a query that cannot be analysed leaves everything as it is
        aside = None
        if before is None and self.exists(full) and not self._is_view(full):
            aside = _part_name(full, 0)
            self.spark.sql(f"ALTER TABLE {quote_table(full)} RENAME TO {quote_table(aside)}")
        try:
            self.spark.sql(f"CREATE OR REPLACE VIEW {quote_table(full)} AS {query}")
        except Exception:
            if aside:
                self.spark.sql(f"ALTER TABLE {quote_table(aside)} RENAME TO {quote_table(full)}")
            raise
        if aside:
            self._drop([aside])
        if before is not None:
            self._drop([*(p.table for p in before.parts), *before.retired])

    def drop(self, name: str) -> None:
        """Drop a published table with all its parts."""
        full = self.full_name(name)
        before = self.state(full)
        if before is None:
            raise PublishError(f"{full} was not published here")
        self.spark.sql(f"DROP VIEW {quote_table(full)}")
        self._drop([*(p.table for p in before.parts), *before.retired])

    def adopt(self, name: str) -> None:
        """Take over an existing table as the first part of a published one."""
        full = self.full_name(name)
        if self.state(full) is not None or not self.exists(full) or self._is_view(full):
            raise PublishError(f"{full} is not a table that can be adopted")
        schema = self.read(full).schema
        layout = [c.name for c in self.spark.catalog.listColumns(quote_table(full)) if c.isPartition]
        part = _part_name(full, 1)
        self.spark.sql(f"ALTER TABLE {quote_table(full)} RENAME TO {quote_table(part)}")
        if layout:
            # Catalogs may still list the partitions under the old name's folder.
            self.spark.sql(f"MSCK REPAIR TABLE {quote_table(part)} SYNC PARTITIONS")
        self._publish(full, schema, None, State(1, (self._part(part),), tuple(layout)))

    def vacuum(self, name: str) -> list[str]:
        """Drop parts that failed runs left behind; not while one is running."""
        full = self.full_name(name)
        schema, table = full.split(".")
        state = self.state(full)
        used = {p.table for p in state.parts} | set(state.retired) if state else set()
        left = [
            f"{schema}.{t.name}"
            for t in self.spark.catalog.listTables(schema)
            if t.name.startswith(table.lower() + "__p")
            and _PART.fullmatch(t.name[len(table) :])
            and f"{schema}.{t.name}" not in used
        ]
        self._drop(left)
        return left

    def stage(self, rows: DataFrame) -> DataFrame:
        """Evaluate ``rows`` once and read them back from shared storage.

        For queries that a plan reads more than once: they may be costly, or
        give other rows each time. ``unstage`` deletes the copy.
        """
        path = f"{shared_folder(self.spark)}/tablewright-stage/{uuid.uuid4().hex}"
        plain = rows.toDF(*[f"c{i}" for i in range(len(rows.columns))])
        plain.write.parquet(path)
        return self.spark.read.schema(plain.schema).parquet(path).toDF(*rows.columns)

    def unstage(self, rows: DataFrame) -> None:
        """Delete the copy that ``rows``, as ``stage`` returned it, are read from."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for folder in {file.rsplit("/", 1)[0] for file in rows.inputFiles()}:
            if "/tablewright-stage/" in folder:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(conf).delete(path, True)

    # -- internals ---------------------------------------------------------

    def _is_view(self, full: str) -> bool:
        return self.spark.catalog.getTable(quote_table(full)).tableType == "VIEW"

    def _write(
        self,
        full: str,
        version: int,
        rows: DataFrame,
        partition_by: Sequence[str],
        cluster_by: Sequence[str],
        scd2: bool,
        apart: bool = True,
        watch: Watch | None = None,
    ) -> tuple[Part, ...]:
        part = _part_name(full, version)
        if cluster_by:
            rows = _clustered(rows, cluster_by)
        layout = list(partition_by)
        if scd2 and IS_CURRENT in rows.columns:
            # Open and closed versions apart: a run reads only the open ones.
            layout.insert(0, IS_CURRENT)
        if partition_by:
            # One shuffle towards few files; partitions that are large are split.
            rows = rows.hint("rebalance", *[F.col(quote(c)) for c in layout])
        if watch is not None:
            rows = watch(rows)
        writer = rows.write.format("parquet")
        if layout:
            writer = writer.partitionBy(*layout)
        writer.saveAsTable(quote_table(part))
        if apart and layout and layout[0] == IS_CURRENT:
            return self._versions(part)
        return (self._part(part),)

    def _versions(self, table: str) -> tuple[Part, ...]:
        """Closed versions and the others of a table as two parts, so that neither moves with the other."""
        current = F.coalesce(F.col(quote(IS_CURRENT)), F.lit(True))
        seen = self.spark.table(quote_table(table)).groupBy(current.alias("open")).count().collect()
        counts = {row["open"]: row["count"] for row in seen}
        only = {False: f"NOT coalesce({quote(IS_CURRENT)}, TRUE)", True: f"coalesce({quote(IS_CURRENT)}, TRUE)"}
        found = tuple(Part(table, (), n, n, only[of]) for of, n in sorted(counts.items()))
        return found or (Part(table, (), 0, 0, only[True]),)

    def _part(self, table: str) -> Part:
        # Answered from file footers.
        count = in_few_tasks(self.spark.table(quote_table(table)).select()).count()
        return Part(table, (), count, count)

    def _publish(
        self,
        full: str,
        schema: T.StructType,
        before: State | None,
        state: State,
        same_rows: bool = False,
    ) -> None:
        """Replace the view; what the version before last needed is dropped.

        A fold gives the same rows, so it does not end the time of readers of
        the version before it.
        """
        kept = {p.table for p in state.parts}
        ended: tuple[str, ...] = ()
        if before is not None:
            gone = tuple(dict.fromkeys(p.table for p in before.parts if p.table not in kept))
            waiting = before.retired if same_rows else ()
            ended = () if same_rows else before.retired
            state = replace(state, retired=(*waiting, *gone))
        now = self.state(full)
        if (now.version if now else None) != (before.version if before else None):
            known = {p.table for p in before.parts} if before else set()
            self._drop(sorted({p.table for p in state.parts} - known))
            raise PublishError(f"{full} was changed by another writer meanwhile")
        columns = ", ".join(
            quote(f.name)
            + (f" COMMENT {text_literal(f.metadata['comment'])}" if f.metadata.get("comment") else "")
            for f in schema
        )
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {quote_table(full)} ({columns}) "
            f"TBLPROPERTIES ({text_literal(_STATE)} = {text_literal(state.to_json())}) "
            f"AS {_select(schema.names, state.parts)}"
        )
        self._drop(ended)

    def _drop(self, tables: Sequence[str]) -> None:
        for table in tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {quote_table(table)}")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share.

    Where the setting is missing, a local session gets a folder of its own; a
    cluster session is refused, as its machines share no temporary folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise PublishError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="checkpoints-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def _part_name(full: str, version: int) -> str:
    return f"{full}__p{version:06d}_{uuid.uuid4().hex[:8]}".lower()


def _select(names: Sequence[str], parts: Sequence[Part], *more: str) -> str:
    columns = ", ".join([*(quote(name) for name in names), *more])
    selects = []
    for part in parts:
        where = " AND ".join(f"({condition})" for condition in part.conditions)
        selects.append(
            f"SELECT {columns} FROM {quote_table(part.table)}" + (f" WHERE {where}" if where else "")
        )
    return " UNION ALL ".join(selects)


def _described(schema: T.StructType, spec: TableSpec) -> T.StructType:
    """``schema`` with the spec's column descriptions as comments."""
    texts = {c.name.lower(): c.description for c in spec.columns if c.description}
    return T.StructType(
        [
            T.StructField(
                f.name,
                f.dataType,
                f.nullable,
                {**f.metadata, **({"comment": texts[f.name.lower()]} if f.name.lower() in texts else {})},
            )
            for f in schema
        ]
    )


def _clustered(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Range-sorted rows, so that files cover narrow value ranges.

    Several columns are laid along a curve, so that a filter on any of them reads
    few files. Rows of one frequent value are spread too: ranges are cut within it by the
    row's hash and, for copies of a row, by the partition it was read in.
    """
    names = rows.columns
    spread = rows.select(
        "*",
        F.xxhash64(*[F.col(quote(c)) for c in names if _hashable(rows, c)]).alias("__row"),
        F.spark_partition_id().alias("__read"),
    )
    by = [F.col(quote(c)) for c in columns]
    place = curve(rows, [rows.select(c).columns[0] for c in by]) if len(by) > 1 else None
    if place is not None:
        spread = spread.withColumn("__place", place)
        by.insert(0, F.col("__place"))
    ranged = spread.repartitionByRange(*by, F.col("__row"), F.col("__read"))
    return ranged.sortWithinPartitions(*by).select(*[F.col(quote(c)) for c in names])


def _hashable(rows: DataFrame, column: str) -> bool:
    return "map<" not in rows.schema[column].dataType.simpleString()
