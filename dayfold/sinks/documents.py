"""Documents: rows that are added, or that replace the row with the same id.

``upsert_docs`` keeps them in a table with a partition per batch. The document of an id is the
one of its latest batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayfold.sinks.bulk import write_bulk
from dayfold.sinks.shared import move_to_new, remove_path
from dayfold.sinks.tables import add_columns, drop_partitions, partition_columns, table_detail

# The target of the metrics preset and the settings of the search-index connector.
METRICS_RESOURCE = "mlp/metrics"
CONNECTOR = "org.elasticsearch.spark.sql"
RESOURCE_SETTING = "es.resource"
ID_SETTING = "es.mapping.id"

# Files for the bulk interface instead of a connection to the index.
BULK = "bulk"

METRICS_TABLE = "metrics"
BATCH = "upsert_batch"


def append_docs(
    docs: DataFrame | Mapping[str, Any],
    resource: str | None = None,
    id_field: str | None = None,
    config: Mapping[str, str] | None = None,
    fmt: str = CONNECTOR,
) -> None:
    """Append documents through any data source, by default the search-index connector.

    A single document can be given as a mapping. The target is ``resource``, or comes from
    ``config``, and so may the id field. The connector replaces the document of the same id; a
    format that cannot is an error: use ``upsert_docs``. The format ``bulk`` writes the documents as
    lines for the bulk interface to the folder ``resource`` (see ``write_bulk``); of several with
    one id the last by their other columns is written.
    """
    options = dict(config or {})
    target = resource or options.get(RESOURCE_SETTING)
    if target is None:
        raise ValueError(f"give a resource, or {RESOURCE_SETTING} in the config")
    if id_field is not None and fmt not in (CONNECTOR, BULK):
        raise ValueError(f"{fmt} cannot replace documents by id; use upsert_docs")
    if isinstance(docs, Mapping):
        docs = SparkSession.active().createDataFrame([dict(docs)])
    if fmt == BULK:
        id_field = id_field or options.get(ID_SETTING)
        if id_field is not None:
            docs = latest_per_id(_required(docs, id_field), id_field)
        write_bulk(docs, target, id_field)
        return
    if id_field is not None:
        options[ID_SETTING] = id_field
    docs.write.mode("append").format(fmt).options(**options).save(target)


def latest_per_id(docs: DataFrame, id_field: str, order: str | None = None) -> DataFrame:
    """One document per id: the latest by ``order``; ties, or no order, go by the other columns.

    Copies of an id are reduced before the shuffle. Columns that hold maps, which have no
    order, are compared as JSON.
    """
    first = [order] if order is not None and order != id_field else []
    others = [c for c in docs.columns if c != id_field and c not in first]
    if not first + others:
        return docs.distinct()
    doc = F.struct(*[F.col(f"`{c}`") for c in first + others])
    rank = F.struct(*[_comparable(docs, c) for c in first + others])
    best = docs.groupBy(id_field).agg(F.max_by(doc, rank).alias("_doc"))
    return best.select(id_field, "_doc.*").select(*[f"`{c}`" for c in docs.columns])


def _comparable(docs: DataFrame, name: str) -> Column:
    column = F.col(f"`{name}`")
    return F.to_json(F.struct(column)) if _holds_map(docs.schema[name].dataType) else column


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_map(field.dataType) for field in kind)
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    return isinstance(kind, T.MapType)


def _required(docs: DataFrame, id_field: str) -> DataFrame:
    kind = docs.schema[id_field].dataType
    missing = F.raise_error(F.lit(f"a document has no {id_field}")).cast(kind)
    return docs.withColumn(id_field, F.coalesce(F.col(id_field), missing))


def _batches(spark: SparkSession, table: str) -> list[int]:
    """The batches of a table, also those whose write died before the catalog knew of them."""
    if partition_columns(spark, table) != [BATCH]:
        raise ValueError(f"{table} was not written by upsert_docs")
    spark.catalog.recoverPartitions(table)
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()  # one per batch since the last compaction
    return sorted(int(row[0].removeprefix(f"{BATCH}=")) for row in rows)


def _write_batch(docs: DataFrame, table: str) -> str:
    """Write documents, null in the columns they lack, to a folder that the table does not see yet."""
    spark = docs.sparkSession
    stored = spark.table(table).schema
    columns = [
        (F.col(f"`{f.name}`") if f.name in docs.columns else F.lit(None)).cast(f.dataType).alias(
            f.name
        )
        for f in stored
        if f.name != BATCH
    ]
    folder = f"{_place(spark, table)}/_writing-{uuid.uuid4().hex}"
    writer = docs.select(*columns).hint("rebalance").write
    writer.format(table_detail(spark, table, "Provider")).save(folder)
    return folder


def _place(spark: SparkSession, table: str) -> str:
    return table_detail(spark, table, "Location").rstrip("/")


def _take_number(spark: SparkSession, table: str, folder: str, number: int) -> bool:
    """Make a written folder the batch of a number, in one step; False if another writer has it."""
    if not move_to_new(spark, folder, f"{_place(spark, table)}/{BATCH}={number}"):
        return False
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({BATCH} = {number})")
    spark.catalog.refreshTable(table)
    return True


def upsert_docs(
    docs: DataFrame,
    table: str,
    id_field: str,
    order: str | None = None,
    path: str | None = None,
) -> None:
    """Insert documents; one with a known id replaces the whole stored document.

    Columns the stored documents lack are added to the table; columns the new documents lack
    are null in them. Of several documents with one id in a batch the latest by ``order`` counts.

    A batch is one more partition, with a number above all others: nothing stored is read or
    rewritten, so the cost is that of the batch. ``current_docs`` gives the state, and
    ``compact_docs`` merges the batches now and then. A run that dies can be repeated. Of two
    writers that want the same number, one gets it and the other the next: a batch is written to
    a folder of its own first and gets its number by a rename. ``current_docs`` over the rows with
    numbers up to some batch is the state as of that batch.
    """
    spark = docs.sparkSession
    if BATCH in docs.columns:
        raise ValueError(f"documents must not have a column {BATCH}")
    exists = spark.catalog.tableExists(table)
    if exists:
        number = max(_batches(spark, table), default=-1) + 1
        stored = spark.table(table).schema
        docs = docs.withColumn(id_field, F.col(id_field).cast(stored[id_field].dataType))
    batch = latest_per_id(_required(docs, id_field), id_field, order)
    if exists:
        add_columns(spark, table, docs, stored.names)
        folder = _write_batch(batch, table)
        while not _take_number(spark, table, folder, number):
            number += 1
        return
    numbered = batch.withColumn(BATCH, F.lit(0).cast("long"))
    writer = numbered.hint("rebalance").write.partitionBy(BATCH)
    (writer if path is None else writer.option("path", path)).saveAsTable(table)


def current_docs(rows: DataFrame, id_field: str) -> DataFrame:
    """The documents in the rows of a table of ``upsert_docs``: those of the latest batch per id.

    One shuffle; the rows of an id are reduced before it.
    """
    others = [c for c in rows.columns if c not in (id_field, BATCH)]
    if not others:
        return rows.select(id_field).distinct()
    doc = F.max_by(F.struct(*[F.col(f"`{c}`") for c in others]), F.col(BATCH)).alias("_doc")
    latest = rows.groupBy(id_field).agg(doc).select(id_field, "_doc.*")
    return latest.select(*[f"`{c}`" for c in rows.columns if c != BATCH])


def compact_docs(
    spark: SparkSession, table: str, id_field: str, keep_old: bool = False
) -> list[int]:
    """Merge all batches of a table into one; returns the batches that it replaces.

    The state is written as the newest batch before the older ones are removed, so a run that dies
    in between changes no document. If a writer has added a batch meanwhile, the state is read
    again. Queries that are still reading older batches fail when those go: with ``keep_old`` they
    stay, and change nothing, until they are given to ``drop_batches``.
    """
    while True:
        batches = _batches(spark, table)
        if len(batches) < 2:
            return []
        merged = spark.table(table).where(F.col(BATCH) <= batches[-1])
        folder = _write_batch(current_docs(merged, id_field), table)
        # The very next number, or else what came in between would be hidden.
        if _take_number(spark, table, folder, batches[-1] + 1):
            break
        remove_path(spark, folder)
    if not keep_old:
        drop_batches(spark, table, batches)
    return batches


def drop_batches(spark: SparkSession, table: str, batches: Sequence[int]) -> None:
    """Remove batches that ``compact_docs`` has replaced."""
    if batches:
        drop_partitions(spark, table, BATCH, batches)


def metrics_upsert(
    metrics: DataFrame | Mapping[str, Any],
    id_field: str,
    table: str = METRICS_TABLE,
    order: str | None = None,
    path: str | None = None,
) -> None:
    """Upsert of metrics documents, or of a single one given as a mapping, into a fixed target."""
    if isinstance(metrics, Mapping):
        metrics = SparkSession.active().createDataFrame([dict(metrics)])
    upsert_docs(metrics, table, id_field, order, path)
