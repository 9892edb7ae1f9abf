"""Bronze CSV files: sensors and interventions.

Every file is looked at once for its first line, and the files that cannot be used
are listed with a reason. The others are read by Spark's CSV source, one scan per
header layout, so column order, extra columns and empty header cells may vary by file.
"""

from __future__ import annotations

import csv
import re
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..session import ship_package, stage_table

# Names of the bronze files; a folder of part files may bear the
# name as well. Numbers fit an int.
SENSOR_NAME = r"(?i)machine_(\d{1,9})_targetcycle(\d{1,9})\.csv(?:/[^/]+)?$"
INTERVENTION_NAME = r"(?i)intervention_data_machine(\d{1,9})\.csv(?:/[^/]+)?$"
INTERVENTION_COLUMNS = ["timestamp", "failure_type", "temperature", "rpm", "vibration", "pressure"]

# The reader's options under which .gz files come as their bytes; builds that
# bundle the file system's classes call the second by another name.
PACKED_BYTES = {
    "lineSep": "\n",
    "io.compression.codecs": "org.apache.hadoop.io.compress.PassthroughCodec",
    "io.compress.passthrough.extension": ".gz",
    "org.apache.hadoop.shaded.io.compress.passthrough.extension": ".gz",
}

LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
FOUND = ("file string, kind string, header string, length long, missing array<string>, extra array<string>, "
         "reason string")
#: Bytes of a block's unit in row numbers; Spark cuts files in much larger splits.
BLOCK_UNIT = 65536
#: Bits of a row number, and those that must be left for the rows of one task.
ROW_BITS, TASK_ROW_BITS = 62, 24


def name_part(path: Column, pattern: str, group: int) -> Column:
    """Number from a file name; null when the name does not match."""
    return F.nullif(F.regexp_extract(path, pattern, group), F.lit("")).cast("int")


@contextmanager
def _listing(spark: SparkSession) -> Iterator[None]:
    """Paths are listed by a few tasks for each core: by default each of many paths gets a task of its own."""
    before = spark.conf.get(LISTING_TASKS)
    spark.conf.set(LISTING_TASKS, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(LISTING_TASKS, before)


def _globs(folder: str) -> list[str]:
    """One level: archived copies in other folders are no input."""
    return [f"{folder}/*.[cC][sS][vV]"]


def column_names(header: str) -> list[str]:
    """Names by position; empty and repeated cells get a name that nothing asks for."""
    cells = [c.strip() for c in next(csv.reader([header.lstrip("﻿")]), [])]
    return [c if c and c not in cells[:i] else f"_unnamed_{i}" for i, c in enumerate(cells)]


class _Unpacking:
    """Whether the bytes of a compressed file, given piece by piece, end where their format says."""

    def __init__(self) -> None:
        self.seen, self.broken = 0, False
        self.member = zlib.decompressobj(zlib.MAX_WBITS | 16)

    def add(self, data: bytes) -> None:
        self.seen += len(data)
        try:
            while data and not self.broken:
                if self.member.eof:  # another archive follows
                    self.member = zlib.decompressobj(zlib.MAX_WBITS | 16)
                self.member.decompress(data, 1 << 20)
                data = self.member.unused_data if self.member.eof else self.member.unconsumed_tail
        except zlib.error:
            self.broken = True

    def whole(self, size: int) -> bool:
        # The scan takes a last line break away.
        self.add(b"\n" * (size - self.seen))
        return self.member.eof and not self.broken


def _torn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The compressed files that break off. Rows are the pieces of one file after another, cut at line breaks."""
    name, size, state = None, 0, _Unpacking()

    def ended() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([True])], ["file", "torn"])

    for batch in batches:
        files, sizes, pieces = (batch.column(c) for c in ("file", "size", "piece"))
        runs = pc.run_end_encode(files)
        begin = 0
        for file, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist(), strict=True):
            if file != name:
                if name is not None and not state.whole(size):
                    yield ended()
                name, size, state = file, sizes[begin].as_py(), _Unpacking()
            elif state.seen:
                state.add(b"\n")
            state.add(b"\n".join(pieces.slice(begin, end - begin).to_pylist()))
            begin = end
    if name is not None and not state.whole(size):
        yield ended()


def inspect_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per CSV file of the folder: kind, header, missing and extra columns, and the reason against it.

    Reasons: `unknown name`, `empty`, `unreadable` (a compressed file that breaks off,
    or one that gives no line), `missing columns`. Null: the file is used, whole.
    """
    ship_package(spark)
    try:
        with _listing(spark):
            listed = spark.read.format("binaryFile").load(_globs(folder))
            text = spark.read.option("ignoreCorruptFiles", True).text(_globs(folder))
            pieces = spark.read.options(**PACKED_BYTES).text(_globs(folder)).filter(F.col("_metadata.file_name").rlike(r"(?i)\.gz$"))
        # The index writes an empty authority as three slashes, the scan as one.
        names = [re.sub(r"^([A-Za-z][A-Za-z0-9+.-]*):///", r"\1:/", n) for n in text.inputFiles()]
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FOUND)
    path = F.col("_metadata.file_path").alias("file")
    # Scans skip files without a byte; the index knows them.
    files = spark.createDataFrame([(n,) for n in names], "file string").join(listed.select(path, "length"), "file", "left")
    # `pieces` is one scan of the files as they are: a task reads each file in order, holding one batch of pieces.
    torn = pieces.select(path, F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("piece")
                         ).mapInArrow(_torn, "file string, torn boolean")
    # The first line lies in the first block; a block is read by one task in order.
    lines = text.filter((F.col("_metadata.file_block_start") == 0) & (F.trim("value") != ""))
    first = lines.select(path, F.monotonically_increasing_id().alias("nth"),
                         "value").groupBy("file").agg(F.min_by("value", "nth").alias("header"))
    found = files.join(first, "file", "left").join(torn, "file", "left")
    kind = (F.when(F.col("file").rlike(INTERVENTION_NAME), "interventions")
            .when(F.col("file").rlike(SENSOR_NAME), "sensors"))
    rows = found.withColumn("kind", kind)
    needs = {"sensors": C.BUSINESS, "interventions": INTERVENTION_COLUMNS}

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples():
                names = column_names(r.header) if isinstance(r.header, str) else []
                needed = needs.get(r.kind, [])
                missing = sorted(set(needed) - set(names))
                extra = [c for c in names if c not in needed and not c.startswith("_unnamed_")]
                reason = ("unknown name" if r.kind is None else "empty" if not r.length > 0 else
                          "unreadable" if r.torn is True or not names else "missing columns" if missing else None)
                out.append((r.file, r.kind, r.header, r.length, missing, extra, reason))
            yield pd.DataFrame(out, columns=["file", "kind", "header", "length", "missing", "extra", "reason"])

    return stage_table(rows.select("file", "kind", "header", "torn", "length").mapInPandas(compare, FOUND))


def _read(spark: SparkSession, files: DataFrame, kind: str, columns: list[str], multiline: bool) -> DataFrame:
    """All rows of the usable files as text, with file and a stable row order.

    One scan per layout. The paths of a scan are held by the driver, as every file
    index is. The order is (file of its series by name, block start, position in the
    task): a block is read by one task in order, so numbers are stable under retries, and
    unique within a series. The first two take the bits that the file table asks for.
    """
    good = files.filter(F.col("reason").isNull() & (F.col("kind") == kind))
    layouts = good.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header").collect()
    series = F.struct(*[name_part(F.col("file"), SENSOR_NAME if kind == "sensors" else INTERVENTION_NAME, g)
                        for g in range(1, 3 if kind == "sensors" else 2)])
    numbered = good.select("file", "length", (F.row_number().over(Window.partitionBy(series).orderBy("file")) - 1)
                           .cast("long").alias("nth"))
    most = numbered.agg(F.max("nth").alias("nth"), F.max("length").alias("length")).first()
    block_bits = ((most["length"] or 0) // BLOCK_UNIT).bit_length()
    row_bits = ROW_BITS - block_bits - (most["nth"] or 0).bit_length()
    if row_bits < TASK_ROW_BITS:
        raise ValueError(f"rows of {(most['nth'] or 0) + 1} files of up to {most['length']} bytes cannot be numbered")
    block = F.floor(F.col("_metadata.file_block_start") / BLOCK_UNIT)
    position = F.shiftleft(block, row_bits) + F.monotonically_increasing_id().bitwiseAND(F.lit((1 << min(row_bits, 33)) - 1))
    scans = []
    for layout in layouts:
        names = column_names(layout["header"])
        schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
        with _listing(spark):
            rows = (spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", multiline)
                    .csv(layout["files"]))
        scans.append(rows.select(F.col("_metadata.file_path").alias("file"), position.alias("position"),
                                 *[F.col(f"`{c}`") for c in columns]))
    if not scans:
        return spark.createDataFrame([], "file string, row_id long, " + ", ".join(f"{c} string" for c in columns))
    rows = reduce(DataFrame.unionByName, scans).join(numbered.select("file", "nth"), "file", "left")
    # A number of zero for the first file leaves the order of a lone file to its blocks.
    row_id = F.shiftleft(F.coalesce("nth", F.lit(0).cast("long")), row_bits + block_bits) + F.col("position")
    return rows.select("file", row_id.alias("row_id"), *columns)


def read_sensors(spark: SparkSession, folder: str, files: DataFrame | None = None, multiline: bool = False) -> DataFrame:
    """All bronze sensor rows as text, with the keys from the file name.

    `files` is the result of `inspect_files`, if it is known already; `multiline`
    allows line breaks within quotes, at the cost of one task per file.
    """
    files = inspect_files(spark, folder) if files is None else files
    return _read(spark, files, "sensors", C.BUSINESS, multiline).withColumns({
        "machine_id": name_part(F.col("file"), SENSOR_NAME, 1),
        "target_cycle": name_part(F.col("file"), SENSOR_NAME, 2),
    }).drop("file")


def read_interventions(spark: SparkSession, folder: str, files: DataFrame | None = None,
                       multiline: bool = False) -> DataFrame:
    files = inspect_files(spark, folder) if files is None else files
    rows = _read(spark, files, "interventions", INTERVENTION_COLUMNS, multiline)
    return rows.withColumn("machine_id", name_part(F.col("file"), INTERVENTION_NAME, 1)).drop("file")


def rejected_files(spark: SparkSession, folder: str, files: DataFrame | None = None) -> DataFrame:
    """Files left out, with the reason; the others proceed."""
    files = inspect_files(spark, folder) if files is None else files
    return files.filter(F.col("reason").isNotNull()).select("file", "reason", "missing")


def _write_files(rows: DataFrame, folder: str) -> None:
    """Rows with `file` to one CSV folder per name, in the order they came.

    Rows are ranged by (file, order) before they are written: a file lies in neighbouring
    tasks only, so there are at most as many part files as names and tasks together, not one
    per name and task, and the rows of a large file are spread over tasks.
    The number of tasks is given, as many small files have few bytes and would be written by one task.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.withColumn("_nth", F.monotonically_increasing_id()).repartitionByRange(tasks, "file", "_nth")
    ranged.sortWithinPartitions("file", "_nth").drop("_nth").write.mode("append").partitionBy("file").option("header", True).csv(folder)


def write_sensors(df: DataFrame, folder: str) -> None:
    """Bronze rows to CSV folders named like the files."""
    name = F.concat(F.lit("machine_"), F.col("machine_id").cast("string"), F.lit("_targetcycle"),
                    F.col("target_cycle").cast("string"), F.lit(".csv"))
    _write_files(df.select(name.alias("file"), *C.BUSINESS), folder)


def write_interventions(df: DataFrame, folder: str) -> None:
    name = F.concat(F.lit("intervention_data_machine"), F.col("machine_id").cast("string"), F.lit(".csv"))
    _write_files(df.select(name.alias("file"), *INTERVENTION_COLUMNS), folder)
