"""File readers and writers. Paths may name any file system Spark knows."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from milepost import schemas
from milepost.functions.scalars import decimal_comma
from milepost.operators.skew import row_hash

CORRUPT = "_corrupt_record"


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Nested event lake; unused struct fields are pruned from the scan."""
    return spark.read.schema(schemas.EVENTS).parquet(path)


def read_cities(spark: SparkSession, path: str) -> DataFrame:
    """City dimension: ``;`` between fields, header, decimal comma. Further columns are ignored."""
    text = spark.read.options(sep=";", header=True).csv(path)
    return text.select(
        "city", decimal_comma(F.col("lat")).alias("lat"), decimal_comma(F.col("lng")).alias("lng")
    )


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str,
    sep: str = ",",
    keep_corrupt: bool = False,
    renamed: Mapping[str, str] | None = None,
) -> DataFrame:
    """CSV with header, columns taken by name whatever their order in the file; further columns are ignored.

    ``renamed`` maps names of the file to names of the schema. A column of the schema that no header names raises.
    Columns are nullable; a value that does not fit is null, and, if asked, what the file held in a line with such a
    value is kept as text in ``_corrupt_record``. All files of a path carry one header: Spark compares each file's with the
    first one's and fails on a file with another.
    """
    reader = spark.read.options(header=True, sep=sep, mode="PERMISSIVE")
    names = reader.csv(path).columns
    wanted = StructType.fromDDL(schema)
    held = {(renamed or {}).get(n, n): n for n in names}
    if absent := [f.name for f in wanted if f.name not in held]:
        raise ValueError(f"no column {', '.join(absent)} in the header {', '.join(names)} of {path}")
    fields = StructType([StructField(n, StringType()) for n in names]).add(CORRUPT, StringType())
    rows = reader.schema(fields).option("columnNameOfCorruptRecord", CORRUPT).option("enforceSchema", False).csv(path)
    text = {n: F.col(f"`{n}`") for n in names}
    typed = {f.name: text[held[f.name]].try_cast(f.dataType) for f in wanted}
    columns = [v.alias(k) for k, v in typed.items()]
    if keep_corrupt:
        unfit = F.lit(False)
        for name, value in typed.items():
            unfit = unfit | (value.isNull() & text[held[name]].isNotNull())
        line = F.concat_ws(sep, *[F.coalesce(c, F.lit("")) for c in text.values()])
        columns.append(F.coalesce(F.col(CORRUPT), F.when(unfit, line)).alias(CORRUPT))
    return rows.select(*columns)


def read_group_log(spark: SparkSession, path: str) -> DataFrame:
    """Group log with nullable integers; the file may call its time column ``datetime``."""
    return read_csv(spark, path, schemas.GROUP_LOG, renamed={"datetime": "event_dt"})


def read_named_objects(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Landed pages of ``[{"_id": .., "name": ..}]`` as (object_id, object_value); all pages.

    A file is one page; with ``multi_line=False`` every line of a file is one page or one object, and
    large files are split between tasks.
    """
    pages = spark.read.schema(schemas.NAMED_OBJECT_JSON).option("multiLine", multi_line).json(path)
    return pages.select(F.col("_id").alias("object_id"), F.col("name").alias("object_value"))


def read_delivery_pages(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Landed pages of deliveries as staging rows of nine fields; other fields are not parsed."""
    return spark.read.schema(schemas.DELIVERY_STAGED).option("multiLine", multi_line).json(path)


def write_parquet(
    df: DataFrame, path: str, mode: str = "errorifexists", partition_by: Sequence[str] = ()
) -> None:
    """Write a mart; with partition columns each value's rows are gathered first, so that a load
    day does not end up in one small file per task."""
    if partition_by:
        spread = F.pmod(row_hash(df.columns), F.lit(32))
        df = df.repartition(*partition_by, spread)
        df.write.mode(mode).partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def append_rows(
    df: DataFrame, path: str, columns: Sequence[str], max_rows_per_file: int = 5_000_000
) -> None:
    """One append by column name; Spark's partitions take the place of hand-made chunks."""
    df.select(*columns).write.mode("append").option(
        "maxRecordsPerFile", max_rows_per_file
    ).parquet(path)


def load_once(df: DataFrame, path: str, load_id: str, columns: Sequence[str] | None = None, max_rows_per_file: int = 5_000_000) -> bool:
    """Append a load to the table at ``path`` as the partition ``load_id=<id>``, once; whether this call has published it.

    The rows are written to a folder that readers do not see (its name begins with an underscore) and published by one
    rename. A load that is there is not written again, and one that broke off before its rename has left nothing to be
    read: its repetition writes anew. On object stores, whose rename is not one step, publish through a table format.
    """
    if not re.fullmatch(r"[A-Za-z0-9.-]+", load_id):
        raise ValueError(f"a load id has letters, digits, dots and dashes, not {load_id!r}")
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    final = hadoop.Path(f"{path.rstrip('/')}/load_id={load_id}")
    store = final.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.exists(final):
        return False
    staged = f"{path.rstrip('/')}/_staged/{load_id}-{uuid.uuid4().hex}"
    rows = df if columns is None else df.select(*columns)
    rows.write.option("maxRecordsPerFile", max_rows_per_file).parquet(staged)
    return publish(store, hadoop.Path(staged), final)


def publish(store, staged, final) -> bool:
    """Rename a staged folder to its final place; False where another writer of the same load came first."""
    if store.exists(final) or not store.rename(staged, final):
        store.delete(staged, True)
        return False
    # A rename onto a folder that has just appeared puts the staged one inside it.
    inside = final.suffix("/" + staged.getName())
    if store.exists(inside):
        store.delete(inside, True)
        return False
    return True


def read_labelled_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """File tree whose directory names are labels: (path, label, length, content).

    ``content`` is read only where it is used.
    """
    files = spark.read.format("binaryFile").options(
        recursiveFileLookup=True, pathGlobFilter=glob
    ).load(root)
    label = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    return files.select("path", label.alias("label"), "length", "content")


def label_counts(files: DataFrame) -> DataFrame:
    return files.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def class_indices(files: DataFrame) -> DataFrame:
    """Rows (label, index): labels numbered in name order. Labels are directory names, so few."""
    names = files.select("label").distinct().agg(F.array_sort(F.collect_set("label")).alias("l"))
    return names.select(F.posexplode("l").alias("index", "label")).select("label", "index")
