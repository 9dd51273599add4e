"""Tables, stored intermediate results and files in the shared folder."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from claimward.session import scratch_path

#: A word is a longest run without ASCII white space; this is also what ``bytes.split()`` finds.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and go on from the files.

    A lost executor then repeats at most the stage after the write, and later steps read
    only the columns they name.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def folder(spark: SparkSession, name: str) -> str:
    """A new folder for files that tasks write themselves."""
    return scratch_path(spark, name)


def word_count(text: Column) -> Column:
    """Words of a text as bigint; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def bucket(key: Column, modulus: int) -> Column:
    """crc32 of a key's decimal text, modulo ``modulus``: which rows are held out."""
    return F.crc32(key.cast("string").cast("binary")) % F.lit(modulus)


def sample_ids(ids: DataFrame, each: int) -> DataFrame:
    """At most ``each`` rows of (doc_id, label) per label, in the order of a hash of the id.

    Labels are counted first; a hash bound then leaves about twice as many rows as wanted,
    and only those are ordered. Labels must be few: their counts reach the driver.
    """
    counts = {r.label: r.n for r in ids.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return ids
    rates = [x for label, n in counts.items() for x in (F.lit(label), F.lit(min(1.0, 2.0 * each / n)))]
    place = F.xxhash64("doc_id", F.lit("sample"))
    part = F.shiftrightunsigned(place, 1).cast("double") / float(1 << 63)
    few = ids.filter(part <= F.element_at(F.create_map(*rates), F.col("label")))
    nth = Window.partitionBy("label").orderBy(place, "doc_id")
    return few.withColumn("nth", F.row_number().over(nth)).filter(F.col("nth") <= each).drop("nth")


def local_path(uri: str) -> str | None:
    """The plain path of a local or mounted file, None for other stores."""
    if uri.startswith("file:"):
        return "/" + uri[len("file:") :].lstrip("/")
    return uri if "://" not in uri else None


def open_for_write(uri: str):
    path = local_path(uri)
    if path is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, "wb")
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(uri)
    return store.open_output_stream(inner)


def open_for_read(uri: str):
    """A seekable binary file."""
    path = local_path(uri)
    if path is not None:
        return open(path, "rb")
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(uri)
    return store.open_input_file(inner)


def attempt_name(base: str, kind: str) -> str:
    """A file name no other task attempt uses.

    The rows a task returns name its files, so that only files of the attempt that
    succeeded are ever read; a repeated or speculative attempt leaves an unused file.
    """
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    return f"{base}/{kind}-{part:06d}-{uuid.uuid4().hex}"


def by_batch(df: DataFrame, change: Callable[[dict[str, list]], dict], schema: str) -> DataFrame:
    """Run ``change`` on the columns of every Arrow batch; it returns columns or None."""
    from pyspark.sql.types import _parse_datatype_string

    target = pa.schema([(f.name, _arrow(f.dataType)) for f in _parse_datatype_string(schema).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = change({n: batch.column(n) for n in batch.schema.names})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], f.type) for f in target], schema=target
                )

    return df.mapInArrow(run, schema)


def _arrow(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
