"""Seeds: typed CSV files as tables.

The header row names the columns; a column declared in the spec gets its type,
any other is a string. Cells are read as text and cast, so a cell means the
same whatever its neighbours are. Files in which every line is a record are read
in splits; where records span lines, they are put together across the splits of
their file, whatever these are. A quote that neither opens nor closes a cell is
refused before that, so the rows never depend on how a file is split.

Lines end at a line feed, and a carriage return right before it belongs to the end.
Any other carriage return is part of its cell, whatever else the file holds.
"""

from __future__ import annotations

import csv
import io
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types import is_text_type, parse_type, sized_text, strict_cast
from ..plans.sizing import in_few_tasks
from ..spec import SpecError, TableSpec
from .store import shared_folder

# How seed files are written (fixed values).
_FORMAT = {"sep": ",", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
_LINE = "\n"


class SeedError(ValueError):
    """A seed file that cannot be loaded."""


def read_seed(
    spark: SparkSession, path: str | list[str], spec: TableSpec, on_bad_cell: str = "raise"
) -> DataFrame:
    """The rows of a seed file (or of several with the same header).

    Missing and empty cells are ``''`` in string columns and NULL in others;
    surplus cells are dropped. ``on_bad_cell="null"`` turns cells that do not
    fit their type into NULL instead of failing.
    """
    if on_bad_cell not in ("raise", "null"):
        raise SpecError("on_bad_cell must be 'raise' or 'null'")
    names = _header(spark, path)
    texts = [f"c{i}" for i in range(len(names))]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in texts])
    if _one_line_records(spark, path):
        _same_headers(path, names, _first_lines(spark, path))
        cells = spark.read.options(**_FORMAT).schema(schema).csv(path, header=True, lineSep=_LINE)
    else:
        ddl = ", ".join(f"{c} STRING" for c in texts)
        records = _records(spark, path)
        _same_headers(path, names, records.filter("is_header").select("record"))
        rows = records.filter(~F.col("is_header"))
        cells = rows.select(F.from_csv("record", ddl, _FORMAT).alias("r")).select("r.*")
    declared = {c.name.lower(): c.type for c in spec.columns}
    return cells.select(
        *[
            _typed(F.col(text), declared.get(name.lower()), on_bad_cell).alias(name)
            for text, name in zip(texts, names)
        ]
    )


def _typed(cell: Column, declared: str | None, on_bad_cell: str) -> Column:
    if is_text_type(declared):
        return sized_text(F.coalesce(cell, F.lit("")), declared)
    filled = F.when(cell != "", cell)
    dtype = parse_type(declared)
    return strict_cast(filled, dtype) if on_bad_cell == "raise" else filled.try_cast(dtype)


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(line, file, block, at)``: lines without their ends, ordered within a file by ``block`` and ``at``."""
    lines = spark.read.text(path, lineSep=_LINE).select(
        _without_return(F.col("value")).alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )
    return in_few_tasks(lines)


def _without_return(line: Column) -> Column:
    return F.regexp_replace(line, r"\r\z", "")


def _header(spark: SparkSession, path: str | list[str]) -> list[str]:
    # Reads no further than the first record.
    start = _lines(spark, path).filter((F.col("block") == 0) & (F.trim("line") != "")).select("line").first()
    if start is None or start[0].count('"') % 2:  # the header spans lines, or comes late
        start = _records(spark, path).filter("is_header").select("record").first()
    # The module would split at carriage returns.
    first = start and next(csv.reader(io.StringIO(start[0].replace("\r", "\0"), newline="")), None)
    if first is None:
        raise SeedError(f"seed file {path} is empty, it needs a header row")
    names = [name.replace("\0", "\r").strip() for name in first]
    if not all(names):
        raise SeedError(f"seed file {path} has a column without a name")
    if len({name.lower() for name in names}) != len(names):
        raise SeedError(f"seed file {path} names a column twice")
    return names


def _quotes_odd(line: Column) -> Column:
    return (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2


# A quoted cell with its quotes, and one that is still open at the end of the line.
_CLOSED = r'(?:^|(?<=,))"[^"]*+(?:""[^"]*+)*+"(?=,|$)'
_OPEN = r'(?:^|(?<=,))"[^"]*+(?:""[^"]*+)*+$'


def _bare_quote(line: Column, inside: Column) -> Column:
    """A quote is left when the quoted cells are taken out of a line that begins ``inside`` one or not."""
    whole = F.when(inside, F.concat(F.lit('"'), line)).otherwise(line)
    rest = F.regexp_replace(F.regexp_replace(whole, _CLOSED, ""), _OPEN, "")
    return F.instr(rest, '"') > 0


def _one_line_records(spark: SparkSession, path: str | list[str]) -> bool:
    """Is every line a whole record, ended by a line feed alone?"""
    lines = in_few_tasks(spark.read.text(path, lineSep=_LINE))
    rest = F.regexp_replace("value", _CLOSED, "")
    # Reads no further than the tasks of the first line that is none.
    return lines.filter((F.instr(rest, '"') > 0) | F.col("value").endswith("\r")).first() is None


def _first_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The first line of each file that is not empty, in files of one-line records."""
    filled = _lines(spark, path).filter(F.trim("line") != "")
    return filled.groupBy("file").agg(F.min_by("line", F.struct("block", "at")).alias("record")).select("record")


def _same_headers(path: str | list[str], names: list[str], headers: DataFrame) -> None:
    """Refuse files whose headers differ; few distinct ones are looked at."""
    ddl = ", ".join(f"c{i} STRING" for i in range(len(names) + 1))
    for row in headers.distinct().select(F.from_csv("record", ddl, _FORMAT).alias("r")).select("r.*").limit(100).collect():
        found = [(cell or "").strip() for cell in row]
        if found != [*names, ""]:
            raise SeedError(f"files of {path} have different headers: {names} and {found}")


def _records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Whole CSV records ``(record, is_header)`` of files in which records may span lines.

    Whether a line starts a record follows from the number of quotes before
    it. That is counted inside each read block, in the task that reads it and
    in read order, and over the block totals of each file, so no line is
    shuffled for it. Only the lines of records with several lines are then
    shuffled together.
    """
    lines = _lines(spark, path).withColumn("odd", _quotes_odd(F.col("line")))
    lines = lines.withColumn("filled", F.col("line") != "")
    small = lines.drop("line")
    counted = small.mapInArrow(_quote_states, _with_states(small.schema))

    # Per block, for both cases: it begins outside (0) or inside (1) of a quoted cell.
    blocks = counted.groupBy("file", "block").agg(
        F.sum("odd").alias("quotes"),
        *[F.max(F.when(F.col("flips") == i, F.col("at"))).alias(f"last_{i}") for i in (0, 1)],
        *[
            F.min(F.when((F.col("flips") == i) & F.col("filled"), F.col("at"))).alias(f"first_{i}")
            for i in (0, 1)
        ],
    )
    per_file = Window.partitionBy("file")
    before = per_file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    throughout = per_file.orderBy("block").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    message = F.format_string("a quoted cell is never closed in %s", F.col("file"))
    blocks = blocks.withColumn("unclosed", F.sum("quotes").over(per_file) % 2 == 1).withColumn(
        "begins", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2
    )
    blocks = blocks.filter(
        F.when(F.col("unclosed"), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    )
    for name in ("last", "first"):
        outside, inside = F.col(f"{name}_0"), F.col(f"{name}_1")
        blocks = blocks.withColumn(name, F.when(F.col("begins") == 0, outside).otherwise(inside))
    blocks = blocks.select(
        "file",
        "block",
        "begins",
        F.last("last", ignorenulls=True).over(before).alias("open_since"),
        F.first("first", ignorenulls=True).over(throughout).alias("header_at"),
    )

    # One row per read block, so the lines keep their tasks and their order.
    lines = lines.mapInArrow(_quote_states, _with_states(lines.schema))
    lines = lines.join(F.broadcast(blocks), ["file", "block"])
    lines = lines.withColumn("starts", F.col("flips") == F.col("begins"))
    began = F.when(F.col("begins") == 0, F.col("began_0")).otherwise(F.col("began_1"))
    lines = lines.withColumn("record_at", F.coalesce(began, F.col("open_since")))
    lines = lines.withColumn("is_header", F.col("record_at") == F.col("header_at"))
    # The quote check, the headers and the rows read the lines as they are now: they are read,
    # counted and joined once, and kept in the shared folder (``TableStore.unstage`` deletes them).
    kept = lines.select("file", "block", "at", "line", "odd", "starts", "record_at", "is_header")
    path = f"{shared_folder(spark)}/tablewright-stage/{uuid.uuid4().hex}"
    kept.write.parquet(path)
    lines = in_few_tasks(spark.read.schema(kept.schema).parquet(path))
    # Up to the first bare quote of a file all states are right, so that quote is seen.
    bare = lines.filter(_bare_quote(F.col("line"), ~F.col("starts"))).select("file", "line").first()
    if bare is not None:
        raise SeedError(f"a quote inside a cell is not doubled in {bare['file']}: {bare['line'][:80]}")
    whole = F.col("starts") & (F.col("odd") == 0)
    single = lines.filter(whole & (F.col("line") != "")).select(F.col("line").alias("record"), "is_header")
    pieces = F.sort_array(F.collect_list(F.struct("block", "at", "line")))
    joined = (
        lines.filter(~whole)
        .groupBy("file", "record_at", "is_header")
        .agg(F.array_join(F.transform(pieces, lambda piece: piece["line"]), "\n").alias("record"))
    )
    return single.union(joined.select("record", "is_header"))


def _with_states(schema: T.StructType) -> T.StructType:
    return T.StructType(
        [*schema.fields, *[T.StructField(c, T.LongType()) for c in ("flips", "began_0", "began_1")]]
    )


def _quote_states(batches):
    """The lines of one task, in read order, with ``flips`` (quotes before the line in its block, mod 2)
    and ``began_0``/``began_1`` (the last line up to it whose ``flips`` is 0/1, in its block; else null).

    A task reads whole blocks, one after the other, each in order; ``at`` grows along a block.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    carried = None  # file, block, quotes, last_0, last_1 and at of the last line so far
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        file, block = batch.column("file"), batch.column("block").to_numpy()
        at, odd = batch.column("at").to_numpy(), batch.column("odd").to_numpy().astype(np.int64)
        new = np.ones(n, dtype=bool)
        if n > 1:
            new[1:] = pc.not_equal(file.slice(1), file.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            new[1:] |= block[1:] != block[:-1]
        goes_on = carried is not None and carried[0] == file[0].as_py() and carried[1] == block[0]
        if (np.diff(at)[~new[1:]] <= 0).any() or (goes_on and at[0] <= carried[5]):
            raise RuntimeError("the lines of a block are not in read order")
        group = np.cumsum(new) - 1
        heads = np.flatnonzero(new)
        seen = np.cumsum(odd) - odd
        count = seen - seen[heads][group]
        first = group == 0
        if goes_on:
            count[first] += carried[2]
        flips = count % 2
        began = []
        for i in (0, 1):
            last = np.maximum.accumulate(np.where(flips == i, at, -1))
            last = np.where(last >= at[heads][group], last, -1)
            if goes_on:
                last[first & (last < 0)] = carried[3 + i]
            began.append(last)
        carried = (file[n - 1].as_py(), block[-1], int(count[-1] + odd[-1]), int(began[0][-1]), int(began[1][-1]), at[-1])
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns,
                pa.array(flips, type=pa.int64()),
                *[pa.array(b, type=pa.int64(), mask=b < 0) for b in began],
            ],
            names=[*batch.schema.names, "flips", "began_0", "began_1"],
        )
