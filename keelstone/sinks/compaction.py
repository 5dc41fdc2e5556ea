"""Compaction of small files only: first fit decreasing, large files keep their place.

Parquet folders have no transactions, so the change is done in steps that a journal can
finish: the merged files are staged in a hidden folder, the journal names what comes and
what goes, then old files go and new ones come. Up to the journal a failure leaves the
table as it was; after it ``recover`` (called by the next compaction too) completes the
change. A reader that lists the slice between the last two steps may miss rows, so this
belongs between runs, as any compaction without a transaction log.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

JOURNAL = "_compaction.json"
STAGED = "_staged-"


class Folder:
    """A folder of any file system Spark can reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.hadoop = spark._jvm.org.apache.hadoop
        self.root = self.hadoop.fs.Path(path)
        self.fs = self.root.getFileSystem(spark._jsc.hadoopConfiguration())
        self.root = self.fs.makeQualified(self.root)

    def place(self, name: str):
        return self.hadoop.fs.Path(self.root, name)

    def files(self) -> dict[str, int]:
        """Size of every data file, by its path below the folder."""
        found = {}
        if self.fs.exists(self.root):
            listed = self.fs.listFiles(self.root, True)
            while listed.hasNext():
                status = listed.next()
                name = self.root.toUri().relativize(status.getPath().toUri()).getPath()
                if not any(part.startswith(("_", ".")) for part in name.split("/")):
                    found[name] = status.getLen()
        return found

    def staged(self) -> list[str]:
        listed = self.fs.listStatus(self.root) if self.fs.exists(self.root) else []
        return [x.getPath().getName() for x in listed if x.getPath().getName().startswith(STAGED)]

    def move(self, source: str, target: str) -> None:
        self.fs.mkdirs(self.place(target).getParent())
        if not self.fs.rename(self.place(source), self.place(target)):
            raise OSError(f"cannot move {source} to {target}")

    def remove(self, name: str) -> None:
        self.fs.delete(self.place(name), True)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.place(name))

    def read(self, name: str) -> str:
        stream = self.fs.open(self.place(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """The whole file or none: it is written beside its place and moved there."""
        stream = self.fs.create(self.place(name + ".new"), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        self.move(name + ".new", name)


def bins(sizes: dict[str, int], target: int) -> list[list[str]]:
    """Files to be merged, by first fit decreasing: each list is of one folder and at most ``target``.

    Files from half the target on stay as they are, and so does a file that stays alone.
    """
    by_folder: dict[str, list[tuple[int, list[str]]]] = {}
    small = sorted((name for name, size in sizes.items() if 2 * size < target), key=lambda x: (-sizes[x], x))
    for name in small:
        held = by_folder.setdefault(name.rpartition("/")[0], [])
        for k, (size, names) in enumerate(held):
            if size + sizes[name] <= target:
                held[k] = (size + sizes[name], [*names, name])
                break
        else:
            held.append((sizes[name], [name]))
    return [names for folder in sorted(by_folder) for _, names in by_folder[folder] if len(names) > 1]


def recover(spark: SparkSession, folder: str) -> bool:
    """Complete a compaction of a slice that was cut short after its journal was written.

    What one that was cut short before that had staged is removed.
    """
    slice_ = Folder(spark, folder)
    if not slice_.exists(JOURNAL):
        for name in slice_.staged():
            slice_.remove(name)
        return False
    journal = json.loads(slice_.read(JOURNAL))
    for name in journal["remove"]:
        slice_.remove(name)
    for name in journal["add"]:
        if slice_.exists(f"{journal['staged']}/{name}"):
            slice_.move(f"{journal['staged']}/{name}", name)
    slice_.remove(journal["staged"])
    slice_.remove(JOURNAL)
    return True


def _with_bin(rows: DataFrame, groups: list[list[str]]) -> DataFrame:
    """Rows with the number of the list that their file is in."""
    spark = rows.sparkSession
    named = [(name.rpartition("/")[2], name.rpartition("/")[0], k) for k, names in enumerate(groups) for name in names]
    merged = spark.createDataFrame(named, "file string, folder string, bin int")
    # the same file name may occur in every class of one writer, so the folder is compared too
    place = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    table = rows.select("*", F.col("_metadata.file_name").alias("_file"), place.alias("_path"))
    at = (F.col("_file") == F.col("file")) & F.endswith("_path", F.concat_ws("/", F.nullif("folder", F.lit("")), "file"))
    return table.join(merged, at).drop("_file", "_path", "file", "folder")


def compact_small(
    spark: SparkSession,
    path: str,
    day: dt.date,
    column: str = "calculation_date",
    by: Sequence[str] = (),
    target: int = 256 << 20,
) -> int:
    """Merge the small files of one slice into files of at most ``target`` bytes; how many went.

    Only small files are read and rewritten, each list of them by one task: it holds one
    class and at most ``target``, so a class of any size makes tasks of one size. All
    other files keep their names and bytes. A slice that does not exist has none.
    """
    folder = f"{path}/{column}={day.isoformat()}"
    recover(spark, folder)
    slice_ = Folder(spark, folder)
    groups = bins(slice_.files(), target)
    if not groups:
        return 0
    staged = f"{STAGED}{uuid.uuid4().hex}"
    rows = _with_bin(spark.read.parquet(folder), groups)
    # whatever the classes are called, a list is one class: nothing is spread further
    placed = rows.repartitionById(len(groups), F.col("bin")).drop("bin")
    writer = placed.write.option("maxRecordsPerFile", 0)
    (writer.partitionBy(*by) if by else writer).parquet(f"{folder}/{staged}")
    staging = Folder(spark, f"{folder}/{staged}")
    gone = [name for names in groups for name in names]
    slice_.write(JOURNAL, json.dumps({"staged": staged, "add": sorted(staging.files()), "remove": gone}))
    recover(spark, folder)
    return len(gone)
