"""Tables, day partitions and text files.

Each write is preceded by a rebalance: adaptive execution then merges small partitions (a
small result becomes one file) and splits large ones, instead of one task writing everything.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayfold.sinks.shared import folders_in, remove_path, shared_path, write_to


def append_table(frame: DataFrame, table: str, path: str | None = None) -> None:
    """Append to a managed table, or to one that lies at ``path``; created when missing.

    Appending a day again doubles it: ``write_day_table`` does not.
    """
    writer = frame.hint("rebalance").write.mode("append")
    (writer if path is None else writer.option("path", path)).saveAsTable(table)


def write_day(frame: DataFrame, path: str, day_column: str = "day", fmt: str = "parquet") -> None:
    """Write day partitions under ``path``, replacing exactly the days that ``frame`` holds.

    Declare the type of the day column when reading back, or it is inferred as a number.
    """
    (
        frame.hint("rebalance", day_column)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day_column)
        .format(fmt)
        .save(path)
    )


def write_day_table(
    frame: DataFrame,
    table: str,
    day_column: str = "day",
    path: str | None = None,
    day: str | None = None,
    missing: str = "error",
) -> None:
    """As ``write_day``, for a table; created when missing, partitioned by the day column.

    Columns that the table lacks are added to it. One that the frame lacks is an error, or null
    with ``missing="null"``. With ``day`` the frame is all there is of that day: if it has no
    rows, the day is emptied.
    """
    spark = frame.sparkSession
    if not spark.catalog.tableExists(table):
        writer = frame.hint("rebalance", day_column).write.partitionBy(day_column)
        (writer if path is None else writer.option("path", path)).saveAsTable(table)
        return
    known = spark.table(table).columns
    lacking = [c for c in known if c not in frame.columns]
    if lacking and missing != "null":
        raise ValueError(f"{table} has columns that the rows lack: {', '.join(lacking)}")
    add_columns(spark, table, frame, known)
    stored = spark.table(table).schema
    rows = frame.select(
        *[
            (F.col(f.name) if f.name in frame.columns else F.lit(None)).cast(f.dataType).alias(
                f.name
            )
            for f in stored
        ]
    )
    if day is None:
        overwrite_partitions(rows, table)
        return
    aside = shared_path(spark, "day")
    rows = write_to(rows, aside)
    if rows.isEmpty():
        _empty_day(spark, table, day_column, day)
    else:
        overwrite_partitions(rows, table)
    remove_path(spark, aside)


def swap_day(frame: DataFrame, table: str, day: str, day_column: str = "day") -> str:
    """Replace a day of a table in one step, and keep what was there for queries that read it.

    The rows are written to a new folder of their own; then the day's partition is added at, or
    moved to, that location. That entry of the catalog is the commit: a write that dies before
    it leaves the table as it was, whatever it has written, and readers see the old day or the new
    one, never both or half. Nothing else is listed or touched. Returns the folder.

    The frame is all there is of the day, and has the table's columns (a day column in it must hold
    that day only). ``drop_old_days`` deletes folders that are no partition's any more.
    """
    spark = frame.sparkSession
    if partition_columns(spark, table) != [day_column]:
        raise ValueError(f"{table} is not partitioned by {day_column} alone")
    if day_column in frame.columns:
        own = F.coalesce(F.col(day_column).cast("string"), F.lit("null"))
        error = F.raise_error(F.concat(F.lit(f"rows of another {day_column}: "), own))
        frame = frame.where(F.when(own == F.lit(day), True).otherwise(error.cast("boolean")))
    stored = spark.table(table).schema
    lacking = [f.name for f in stored if f.name not in (*frame.columns, day_column)]
    if lacking:
        raise ValueError(f"{table} has columns that the rows lack: {', '.join(lacking)}")
    add_columns(spark, table, frame, stored.names)
    columns = [f for f in spark.table(table).schema if f.name != day_column]
    rows = frame.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in columns])
    folder = f"{_versions(spark, table)}/{day_column}={day}-{uuid.uuid4().hex}"
    try:
        rows.hint("rebalance").write.format(table_detail(spark, table, "Provider")).save(folder)
    except Exception:
        remove_path(spark, folder)
        raise
    _place_partition(spark, table, day_column, day, folder)
    return folder


def _versions(spark: SparkSession, table: str) -> str:
    """Where the folders of swapped days lie: hidden, so that listing the table skips it."""
    return f"{table_detail(spark, table, 'Location').rstrip('/')}/_versions"


def _place_partition(spark: SparkSession, table: str, column: str, value: str, folder: str) -> None:
    spec = f"PARTITION (`{column}` = '{_quoted(value)}')"
    place = f"LOCATION '{_quoted(folder)}'"
    if spark.sql(f"SHOW PARTITIONS {table} {spec}").isEmpty():
        spark.sql(f"ALTER TABLE {table} ADD {spec} {place}")
    else:
        spark.sql(f"ALTER TABLE {table} {spec} SET {place}")
    spark.catalog.refreshTable(table)


def _quoted(value: object) -> str:
    return str(value).replace("\\", "\\\\").replace("'", "\\'")


def drop_old_days(spark: SparkSession, table: str, seconds: float) -> list[str]:
    """Delete folders of ``swap_day`` that no partition is at, and that are older than ``seconds``.

    Choose more than any query takes, and any write. Returns the deleted folders.
    """
    column = partition_columns(spark, table)[0]
    live = set()
    # One for each day that the table has.
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        value = _quoted(row[0].removeprefix(f"{column}="))
        told = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION (`{column}` = '{value}')")
        place = told.where((F.col("col_name") == "Location") & (F.col("data_type") != ""))
        live |= {_plain_path(r["data_type"]) for r in place.collect()}
    before = time.time() - seconds
    folders = folders_in(spark, _versions(spark, table))
    old = [f for f, at in folders.items() if _plain_path(f) not in live and at <= before]
    for folder in old:
        remove_path(spark, folder)
    return old


def _plain_path(place: str) -> str:
    """A path without its scheme, however many slashes that is written with."""
    return "/" + unquote(place).partition(":")[2].lstrip("/") if ":" in place else place


def add_columns(spark: SparkSession, table: str, rows: DataFrame, known: Sequence[str]) -> None:
    """Add the columns of ``rows`` that are not among the ``known`` ones of the table."""
    new = [f for f in rows.schema.fields if f.name not in known]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")


def table_detail(spark: SparkSession, table: str, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name") == name)
    return rows.first()["data_type"]


def _empty_day(spark: SparkSession, table: str, day_column: str, day: str) -> None:
    """Remove the rows of a day."""
    value = day.replace("'", "\\'")
    if not spark.sql(f"SHOW PARTITIONS {table} PARTITION (`{day_column}` = '{value}')").isEmpty():
        drop_partitions(spark, table, day_column, [day])


def drop_partitions(spark: SparkSession, table: str, column: str, values: Sequence) -> None:
    """Remove partitions and their files, which an external table would keep."""
    location = table_detail(spark, table, "Location").rstrip("/")
    specs = [str(value).replace("'", "\\'") for value in values]
    spec = ", ".join(f"PARTITION (`{column}` = '{value}')" for value in specs)
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {spec}")
    for value in values:
        remove_path(spark, f"{location}/{column}={value}")
    spark.catalog.refreshTable(table)


def overwrite_partitions(frame: DataFrame, table: str) -> None:
    """Replace the partitions of ``table`` that ``frame`` holds, and no others.

    Written to the table's place with the mode as an option of this write: an insert would take
    it from the session, where other writes would see it.
    """
    spark = frame.sparkSession
    columns = partition_columns(spark, table)
    (
        frame.hint("rebalance", *columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .format(table_detail(spark, table, "Provider"))
        .save(table_detail(spark, table, "Location"))
    )
    spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


# What stands for a backslash, a line feed, a carriage return and the separator in escaped text, and
# for a null.
ESCAPE = "\\"
LINE_ENDS = {"\n": "n", "\r": "r"}
SEPARATOR_MARK = "s"
NULL_MARK = "N"


def write_text(
    frame: DataFrame,
    path: str,
    separator: str = "\t",
    null_text: str = "",
    escaped: bool = False,
) -> None:
    """Export all columns as lines of text; a null becomes ``null_text`` and keeps its place.

    Values are written as they are: a line break or separator in one is not escaped. With
    ``escaped`` they are, and backslashes, and nulls are told from empty texts, so that
    ``read_text`` gives the rows back.
    """
    if escaped:
        cells = [_escaped(F.col(f"`{c}`").cast("string"), separator) for c in frame.columns]
    else:
        cells = [F.coalesce(F.col(c).cast("string"), F.lit(null_text)) for c in frame.columns]
    frame.select(F.concat_ws(separator, *cells).alias("value")).hint("rebalance").write.mode(
        "append"
    ).text(path)


def _require_separator(separator: str) -> None:
    taken = {ESCAPE, NULL_MARK, SEPARATOR_MARK, *LINE_ENDS, *LINE_ENDS.values()}
    if not separator or set(separator) & taken:
        raise ValueError(f"{separator!r} cannot separate escaped text")


def _escaped(cell: Column, separator: str) -> Column:
    _require_separator(separator)
    text = F.replace(cell, F.lit(ESCAPE), F.lit(2 * ESCAPE))
    for raw, mark in {separator: SEPARATOR_MARK, **LINE_ENDS}.items():
        text = F.replace(text, F.lit(raw), F.lit(ESCAPE + mark))
    return F.coalesce(text, F.lit(ESCAPE + NULL_MARK))


def _plain_text(cell: Column, separator: str) -> Column:
    """What ``_escaped`` was given. Pairs of backslashes part the text into pieces without any."""

    def piece(text: Column) -> Column:
        for raw, mark in {separator: SEPARATOR_MARK, **LINE_ENDS}.items():
            text = F.replace(text, F.lit(ESCAPE + mark), F.lit(raw))
        return text

    pieces = F.split(cell, 4 * ESCAPE, -1)
    text = F.array_join(F.transform(pieces, piece), ESCAPE)
    return F.when(cell != F.lit(ESCAPE + NULL_MARK), text)


def read_text(
    spark: SparkSession, path: str, schema: T.StructType, separator: str = "\t"
) -> DataFrame:
    """Rows of a schema from what ``write_text`` exported with ``escaped``.

    A line is a record whatever its values hold, so long files are read in parts that end at
    records. A line with another number of values is an error.
    """
    _require_separator(separator)
    quoted = "".join(f"[{c}]" if c not in "^[]" else f"\\{c}" for c in separator)
    cells = F.split("value", quoted, -1)
    error = F.raise_error(F.concat(F.lit("a line with "), F.size(cells), F.lit(" values")))
    right = F.when(F.size(cells) == len(schema), True).otherwise(error.cast("boolean"))
    lines = spark.read.text(path).where(right).select(cells.alias("cells"))
    return lines.select(
        *[
            _plain_text(F.col("cells")[i], separator).cast(f.dataType).alias(f.name)
            for i, f in enumerate(schema)
        ]
    )
