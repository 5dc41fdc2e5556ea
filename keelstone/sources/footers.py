"""Schemas of single files: footers are read in parallel and compared, so drift is seen by file."""

from __future__ import annotations

from urllib.parse import quote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

FILES = "file string, columns map<string, string>, error string"


def _footer(file: str) -> tuple[list | None, str | None]:
    """Name and Spark type of the columns of a file, or why it has none."""
    scheme, _, rest = file.partition(":")
    where = ("s3" if scheme in ("s3a", "s3n") else scheme) + ":" + quote(rest, safe="/:@")
    try:
        system, path = fs.FileSystem.from_uri(where)
        schema = pq.read_schema(path, filesystem=system)
    except (pa.ArrowException, OSError) as problem:
        return None, str(problem) or type(problem).__name__
    columns = []
    for field in schema:
        try:
            columns.append((field.name, from_arrow_type(field.type).simpleString()))
        except Exception:  # a type Spark has no name for is still a type
            columns.append((field.name, str(field.type)))
    return columns, None


def _footers(batches):
    schema = pa.schema([("file", pa.string()), ("columns", pa.map_(pa.string(), pa.string())), ("error", pa.string())])
    for batch in batches:
        files = batch.column("file").to_pylist()
        found = [_footer(file) for file in files]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip((files, *zip(*found, strict=True)) if files else ([], [], []), schema.types, strict=True)],
            schema=schema,
        )


def file_schemas(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``columns`` (name to type), ``error`` for every Parquet file below ``path``.

    Only footers are read, by the tasks that Spark's listing of the folder makes; a file
    without a readable one has the reason in ``error``. Partition columns are not in files
    and not in ``columns``. Files of no bytes are left out, as in every read by Spark.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    files = listed.load(path).select(F.col("path").alias("file"))
    return files.mapInArrow(_footers, FILES)


def usual_schema(files: DataFrame) -> DataFrame:
    """One row: ``wanted``, the type that most files give each column that at least half of them have.

    Of equally frequent types the first by name.
    """
    n = files.where("error IS NULL").agg(F.count(F.lit(1)).alias("n"))
    kinds = files.select(F.explode("columns").alias("item", "kind")).groupBy("item", "kind").agg(F.count(F.lit(1)).alias("files"))
    by_item = kinds.groupBy("item").agg(
        F.sum("files").alias("files"), F.min(F.struct((-F.col("files")).alias("rank"), "kind")).alias("first")
    )
    usual = by_item.where(2 * F.col("files") >= n.scalar())
    return usual.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("item", "first.kind")))).alias("wanted"))


def schema_drift(files: DataFrame, expected: T.StructType | None = None) -> DataFrame:
    """Every file and column that departs from ``expected``, by default from what files usually hold.

    ``problem`` is missing, type, extra, or unreadable for a file without a footer (then
    without a column). Files that agree give no row, and so does a folder without files.
    """
    if expected is None:
        wanted = usual_schema(files).scalar()
    else:
        pairs = [F.lit(x) for f in expected.fields for x in (f.name, f.dataType.simpleString())]
        wanted = F.create_map(*pairs).cast("map<string, string>")
    names = F.array_sort(F.array_union(F.map_keys("wanted"), F.map_keys("columns")))
    compared = F.transform(
        names, lambda x: F.struct(x.alias("item"), F.col("wanted")[x].alias("expected"), F.col("columns")[x].alias("actual"))
    )
    departing = F.filter(compared, lambda x: ~x["expected"].eqNullSafe(x["actual"]))
    unreadable = F.array(F.struct(*[F.lit(None).cast("string").alias(c) for c in ("item", "expected", "actual")]))
    rows = files.withColumn("wanted", wanted)
    rows = rows.select("file", "error", F.explode(F.when(F.col("error").isNull(), departing).otherwise(unreadable)).alias("x"))
    problem = (
        F.when(F.col("error").isNotNull(), "unreadable")
        .when(F.col("x.actual").isNull(), "missing")
        .when(F.col("x.expected").isNull(), "extra")
        .otherwise("type")
    )
    return rows.select("file", "x.item", problem.alias("problem"), "x.expected", "x.actual")
