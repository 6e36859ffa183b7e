"""CSV with line breaks inside quoted cells, read by many tasks: a large file is cut at line ends, not read by one task.

A line begins inside a quoted cell if an odd number of quotes stands before it in its file. A first pass over the lines
counts quotes per split of a file. Running sums over the splits, one row each, tell how every split begins. A second pass
puts lines together to records; a record that crosses splits is put together from one piece per split. Texts of cells
don't move between tasks but for those pieces.

Cells follow RFC 4180: quotes only around a cell, doubled inside it. A file that ends inside a quoted cell raises, as do
files with different headers. Lines end with LF or CRLF; line breaks inside cells stay as they are. Empty lines are left
out. Missing cells are null, as are empty ones without quotes; cells beyond the header's are left out. Files without a
record, and files with a header only, give no rows; columns are all strings.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilematch.operators.skew import MAX_BROADCAST_ROWS
from profilematch.session import materialize

MIN_PARTITIONS = "spark.sql.files.minPartitionNum"
SPLIT = ["file", "start", "length"]


@contextmanager
def _same_splits(spark: SparkSession):
    """Both passes have to cut files alike, also when executors come or go between them."""
    before = spark.conf.get(MIN_PARTITIONS, None)
    spark.conf.set(MIN_PARTITIONS, before or str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(MIN_PARTITIONS)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, length, line): lines with the split that they begin in, in the file's order within a split."""
    raw = spark.read.option("lineSep", "\n").text(path)
    where = (F.col(f"_metadata.file_{c}").alias(n) for c, n in (("path", "file"), ("block_start", "start"), ("block_length", "length")))
    return raw.select(*where, F.col("value").alias("line"))


def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of one split."""
    files, starts = batch.column("file"), batch.column("start")
    first = 0
    while first < batch.num_rows:
        same = pc.and_(pc.equal(files, files[first]), pc.equal(starts, starts[first])).slice(first)
        stop = pc.index(same, pa.scalar(False)).as_py()
        count = batch.num_rows - first if stop < 0 else stop
        yield batch.slice(first, count)
        first += count


def _odd_after(lines: pa.Array, odd: bool) -> pa.Array:
    """Whether an odd number of quotes stands before the end of each line, ``odd`` counting what is before all."""
    quotes = pc.cumulative_sum(pc.cast(pc.count_substring(lines, '"'), pa.int64()), start=int(odd))
    return pc.equal(pc.bit_wise_and(quotes, 1), 1)


_COUNTS = "file string, start long, length long, odd boolean, even_ends boolean, odd_ends boolean"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each split: whether its quotes are odd, and whether a line ends after an even, after an odd number of them."""
    names = [*SPLIT, "odd", "even_ends", "odd_ends"]
    held: list | None = None
    for batch in batches:
        for run in _runs(batch):
            key = [run.column(c)[0].as_py() for c in SPLIT]
            if held is not None and held[:3] != key:
                yield pa.RecordBatch.from_pylist([dict(zip(names, held))])
                held = None
            held = held or [*key, False, False, False]
            after = _odd_after(run.column("line"), held[3])
            held[3] = after[-1].as_py()
            held[4] |= not pc.all(after).as_py()
            held[5] |= pc.any(after).as_py()
    if held is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(names, held))])


def _splits(lines: DataFrame) -> DataFrame:
    """A row per split: ``inside`` if it begins inside a cell, and the split in which the record open there began."""
    counted = materialize(lines.mapInArrow(_count, _COUNTS), "csv-splits")
    before = W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    inside = F.pmod(F.coalesce(F.sum(F.col("odd").cast("int")).over(before), F.lit(0)), F.lit(2)) == 1
    rows = counted.withColumn("inside", inside)
    # line ends outside of cells: after an even number of quotes in all
    ends = F.when(F.col("inside"), F.col("odd_ends")).otherwise(F.col("even_ends"))
    open_at_end = F.col("inside") != F.col("odd")
    opens = F.when(open_at_end & (ends | ~F.col("inside")), F.col("start"))
    rows = rows.withColumn("_open", open_at_end).withColumn("_opens", opens)
    rows = rows.withColumn("opener", F.when(F.col("inside"), F.last("_opens", ignorenulls=True).over(before)))
    return materialize(rows.select(*SPLIT, "inside", "opener", F.col("_open").alias("open_at_end")), "csv-openers")


_PIECES = "file string, start long, owner long, first boolean, record string"


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records (owner null), and pieces of those that cross splits with the split that their record begins in."""
    schema = pa.schema([("file", pa.string()), ("start", pa.int64()), ("owner", pa.int64()), ("first", pa.bool_()), ("record", pa.string())])
    key: tuple | None = None
    rest: list[pa.Array] = []
    odd = head = ended = fresh = False
    opener = None

    def piece(owner: int | None, text: str) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"file": key[0], "start": key[1], "owner": owner, "first": fresh, "record": text}], schema)

    def left_over() -> Iterator[pa.RecordBatch]:
        """What no line end closes in this split."""
        if key is not None and rest:
            text = "\n".join(pa.concat_arrays(rest).to_pylist())
            yield piece(opener if head and not ended else key[1], text)

    for batch in batches:
        for run in _runs(batch):
            here = (run.column("file")[0].as_py(), run.column("start")[0].as_py())
            if here != key:
                yield from left_over()
                key, rest, ended = here, [], False
                odd, opener = run.column("inside")[0].as_py(), run.column("opener")[0].as_py()
                head, fresh = odd, key[1] == 0
            lines = run.column("line").cast(pa.string())
            after = _odd_after(lines, odd)
            odd = after[-1].as_py()
            ends = pc.add(pc.indices_nonzero(pc.invert(after)).cast(pa.int64()), 1)
            if not len(ends):
                rest.append(lines)
                continue
            kept = sum(map(len, rest))
            offsets = pa.concat_arrays([pa.array([0], pa.int64()), pc.add(ends, kept)]).cast(pa.int32())
            all_lines = pa.concat_arrays([*rest, lines])
            records = pc.binary_join(pa.ListArray.from_arrays(offsets, all_lines.slice(0, offsets[-1].as_py())), "\n")
            rest = [all_lines.slice(offsets[-1].as_py())] if offsets[-1].as_py() < len(all_lines) else []
            if head and not ended:
                yield piece(opener, records[0].as_py())
                records = records.slice(1)
            ended = True
            records = pc.replace_substring_regex(records, "\r$", "")
            if fresh and len(records):
                records = pa.concat_arrays([pa.array([records[0].as_py().removeprefix("﻿")], pa.string()), records.slice(1)])
            records = records.filter(pc.not_equal(records, ""))
            if len(records):
                n = len(records)
                first = pa.array([fresh] + [False] * (n - 1), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array([key[0]] * n), pa.array([key[1]] * n), pa.nulls(n, pa.int64()), first, records], schema=schema)
                fresh = False
    yield from left_over()


def _in_order(lines: DataFrame, splits: DataFrame, few: bool) -> DataFrame:
    """Lines with what is known of their split, in the file's order within it."""
    known = splits.select(*SPLIT, "inside", "opener")
    if few:
        joined = lines.join(F.broadcast(known), SPLIT, "left")
    else:
        numbered = lines.withColumn("_at", F.monotonically_increasing_id())
        joined = numbered.join(known, SPLIT, "left").repartition(*SPLIT).sortWithinPartitions(*SPLIT, "_at")
    lost = F.raise_error(F.lit("files were cut differently in the second pass"))
    return joined.withColumn("inside", F.when(F.col("inside").isNull(), lost.cast("boolean")).otherwise(F.col("inside"))).select(
        *SPLIT, "inside", "opener", "line"
    )


def read_records(spark: SparkSession, path: str, max_broadcast_splits: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """(first, record): the records of all CSV files at ``path`` as strings, stored; ``first`` marks a file's first one."""
    with _same_splits(spark):
        splits = _splits(_lines(spark, path))
        last = splits.groupBy("file").agg(F.max_by("open_at_end", "start").alias("cut"))
        cut = last.where("cut").limit(1).collect()
        if cut:
            raise ValueError(f"{cut[0]['file']} ends inside a quoted cell")
        ordered = _in_order(_lines(spark, path), splits, splits.count() <= max_broadcast_splits)
        pieces = materialize(ordered.mapInArrow(_assemble, _PIECES), "csv-pieces")
    whole = pieces.where("owner is null").select("first", "record")
    ordered = F.array_sort(F.collect_list(F.struct("start", "record")))
    crossing = pieces.where("owner is not null").groupBy("file", "owner").agg(F.max("first").alias("first"), ordered.alias("p"))
    joined = F.regexp_replace(F.array_join(F.col("p.record"), "\n"), "\r$", "")
    joined = F.when(F.col("first"), F.regexp_replace(joined, "^﻿", "")).otherwise(joined)
    return whole.unionByName(crossing.select("first", joined.alias("record")))


def read_csv(spark: SparkSession, path: str, max_broadcast_splits: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """CSV files with a header as string columns."""
    records = read_records(spark, path, max_broadcast_splits)
    headers = records.where("first").select("record").distinct().limit(2).collect()
    if len(headers) > 1:
        raise ValueError(f"files at {path} have different headers")
    names = next(csv.reader([headers[0]["record"]])) if headers else []
    if len({n.lower() for n in names}) < len(names):
        raise ValueError(f"columns at {path} have equal names")
    if not names:
        return spark.createDataFrame([], T.StructType([]))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    cells = F.from_csv("record", schema.toDDL(), {"escape": '"'})
    return records.where(~F.col("first")).select(cells.alias("c")).select("c.*")
