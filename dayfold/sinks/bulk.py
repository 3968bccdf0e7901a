"""Documents as lines for the bulk interface of a search index: an action, then the document.

A target is a folder with a sub-folder per batch, numbered in the order of arrival. Spark writes
and reads the lines on any file system it knows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayfold.sinks.shared import folders_in, move_to_new, remove_path

BATCH = "bulk_batch"
# An action begins with a space, which a document never does: so records can be told apart.
ACTION = '{ "index": '
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _record(docs: DataFrame, id_field: str | None) -> Column:
    doc = F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), JSON)
    if id_field is None:
        about = F.lit("{}")
    else:
        about = F.to_json(F.struct(F.col(f"`{id_field}`").cast("string").alias("_id")))
    return F.concat(F.lit(ACTION), about, F.lit(" }\n"), doc).alias("value")


def write_bulk(docs: DataFrame, path: str, id_field: str | None = None) -> int:
    """Add documents to the folder ``path`` as one batch; returns its number.

    With ``id_field`` a document replaces that of the same id in earlier batches; an id must not be
    null, and may come once in a batch (see ``latest_per_id``). The lines are written to a folder
    that readers do not see, which gets its number by a rename: a batch is there whole or not at
    all, tasks can be lost and run again, and of two writers each gets its own number.
    """
    spark = docs.sparkSession
    path = path.rstrip("/")
    folder = f"{path}/_writing-{uuid.uuid4().hex}"
    try:
        docs.select(_record(docs, id_field)).write.text(folder)
    except Exception:
        remove_path(spark, folder)
        raise
    number = max(_numbers(spark, path), default=-1) + 1
    while not move_to_new(spark, folder, f"{path}/{BATCH}={number}"):
        number += 1
    return number


def _numbers(spark: SparkSession, path: str) -> list[int]:
    names = [folder.rstrip("/").rsplit("/", 1)[1] for folder in folders_in(spark, path)]
    return [int(n.removeprefix(f"{BATCH}=")) for n in names if n.startswith(f"{BATCH}=")]


def read_bulk(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The documents of a folder of ``write_bulk``: the latest per id, and all that have none.

    A document that is not of the ``schema`` is an error. One shuffle, of the documents with ids;
    those of an id are reduced before it.
    """
    lines = spark.read.option("lineSep", f"\n{ACTION}").schema(f"value string, {BATCH} bigint")
    records = lines.text(path).where(F.col("value") != "")
    # The first record of a file has its own beginning, the last one a line break at its end.
    plain = F.regexp_replace("value", r"^\Q" + ACTION + r"\E", "")
    about = F.from_json(F.substring_index(plain, " }\n", 1), "_id string")
    doc = F.from_json(F.substring(plain, F.instr(plain, " }\n") + 3, F.length(plain)), schema,
                      {**JSON, "mode": "FAILFAST"})
    parsed = records.select(about["_id"].alias("_id"), doc.alias("_doc"), BATCH)
    latest = (
        parsed.where("_id IS NOT NULL").groupBy("_id").agg(F.max_by("_doc", BATCH).alias("_doc"))
    )
    return latest.select("_doc").unionAll(parsed.where("_id IS NULL").select("_doc")).select("_doc.*")
