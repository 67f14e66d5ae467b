"""Records of quoted CSV files, read by many tasks per file.

A quoted field may hold line breaks, so a line need not start a record: it does if the quotes
before it in its file are even (a doubled quote counts twice and changes nothing). The text
source reads each file in byte ranges and gives whole lines in order.

1. Per range, count the lines with an odd number of quotes; a running sum over the ranges of a
   file tells whether a range starts inside a quoted field and in which range that record began.
2. Each task then puts the lines of its ranges together to records. A record cut by the end of a
   range leaves one fragment in each range it touches; only fragments are shuffled, to be joined
   in order.

Both steps scan within one plan, so the ranges are the same. What is broadcast has one short row
per range, that is per `spark.sql.files.maxPartitionBytes` of input; a range without its row
fails the job. A task holds one batch of lines and one open record.

Lines end with a line feed, with or without a carriage return before it; line ends within quotes
are kept as they are. Empty records are skipped; the first record of a file is its header.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUOTE = '"'
FOUND = "record string, file string, owner long, place long, header boolean"
_KINDS = pa.schema([("record", pa.string()), ("file", pa.string()), ("owner", pa.int64()), ("place", pa.int64()), ("header", pa.bool_())])


def _odd(line: Column) -> Column:
    """1 where a line has an odd number of quotes."""
    return (F.octet_length(line) - F.octet_length(F.replace(line, F.lit(QUOTE), F.lit("")))) % 2


def _lines(spark: SparkSession, paths: list[str], options: dict[str, str]) -> DataFrame:
    text = spark.read.options(**options).option("lineSep", "\n").schema("value string").format("text").load(paths)
    return text.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )


def _ranges(lines: DataFrame) -> DataFrame:
    """(file, block, inside, owner): whether a range starts within quotes, and where that record began."""
    counted = lines.groupBy("file", "block").agg(F.sum(_odd(F.col("value"))).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opening = F.last(F.when(F.col("odd") > 0, F.col("block")), ignorenulls=True).over(before)
    inside = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1
    return counted.select("file", "block", inside.alias("inside"), F.when(inside, opening).alias("owner"))


class _Assembler:
    """Puts the lines of one byte range after another together."""

    def __init__(self) -> None:
        self.range: tuple[str, int] | None = None
        self.out: list[pa.RecordBatch] = []

    def begin(self, file: str, block: int, inside: bool, owner: int | None) -> None:
        self.finish()
        self.range, self.carried, self.owner = (file, block), inside, owner
        self.open: list[str] | None = [] if inside else None
        self.header = block == 0

    def finish(self) -> None:
        """The end of a range: what is open is a fragment."""
        if self.range and self.open:
            self._fragment()
        self.open = None

    def _emit(self, records: pa.Array, owner: int | None, header: bool = False) -> None:
        if len(records):
            file, block = self.range
            n = len(records)
            self.out.append(pa.RecordBatch.from_arrays(
                [records.cast(pa.string()), pa.array([file] * n), pa.array([owner] * n, pa.int64()),
                 pa.array([block] * n, pa.int64()), pa.array([header] * n)], schema=_KINDS))

    def _fragment(self) -> None:
        owner = self.owner if self.carried else self.range[1]
        self._emit(pa.array(["\n".join(self.open)], pa.string()), owner, self.header and not self.carried)
        self.header = self.header and self.carried

    def _whole(self, records: pa.Array) -> None:
        if self.header and len(records):
            records, self.header = records[1:], False
        self._emit(records, None)

    def add(self, lines: pa.Array) -> None:
        odd = np.asarray(pc.count_substring(lines, QUOTE)) & 1
        after = (np.cumsum(odd) + (self.open is not None)) & 1
        starts = np.flatnonzero((after ^ odd) == 0)
        first = int(starts[0]) if len(starts) else len(lines)
        if self.open is not None:
            self.open += lines[:first].to_pylist()
            if not len(starts) and after[-1]:
                return
            if self.carried:
                self._fragment()
            else:
                self._whole(pa.array(["\n".join(self.open)], pa.string()))
            self.open, self.carried = None, False
        if not len(starts):
            return
        whole = starts if not after[-1] else starts[:-1]
        end = len(lines) if not after[-1] else int(starts[-1])
        if len(whole) == end - first:
            self._whole(lines[first:end])
        elif len(whole):
            bounds = pa.array(np.append(whole, end) - first, pa.int32())
            self._whole(pc.binary_join(pa.ListArray.from_arrays(bounds, lines[first:end]), "\n"))
        if after[-1]:
            self.open, self.carried = lines[end:].to_pylist(), False

    def taken(self) -> Iterator[pa.RecordBatch]:
        out, self.out = self.out, []
        yield from out


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines (value, file, block, inside, owner) in order to records and fragments."""
    work = _Assembler()
    for batch in batches:
        if not batch.num_rows:
            continue
        lines, files = batch.column(0), batch.column(1).dictionary_encode()
        blocks = batch.column(2).to_numpy(zero_copy_only=False)
        codes = files.indices.to_numpy(zero_copy_only=False)
        turns = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(codes) != 0)) + 1
        for low, high in zip([0, *turns.tolist()], [*turns.tolist(), len(blocks)], strict=True):
            file, block = files[low].as_py(), int(blocks[low])
            if work.range != (file, block):
                work.begin(file, block, batch.column(3)[low].as_py(), batch.column(4)[low].as_py())
            work.add(lines[low:high])
        yield from work.taken()
    work.finish()
    yield from work.taken()


def csv_records(spark: SparkSession, paths: list[str], options: dict[str, str]) -> DataFrame:
    """(record, file): every record of the files as text, in any order, without headers."""
    lines = _lines(spark, paths, options)
    known = F.when(F.col("inside").isNull(), F.raise_error(F.lit("a byte range was not counted")).cast("boolean")).otherwise(F.col("inside"))
    placed = lines.join(F.broadcast(_ranges(lines)), ["file", "block"], "left").select(
        "value", "file", "block", known.alias("inside"), "owner"
    )
    found = placed.mapInArrow(_assembled, FOUND)
    pieces = found.filter("owner is not null").groupBy("file", "owner").agg(
        F.sort_array(F.collect_list(F.struct("place", "record"))).alias("pieces"), F.max("header").alias("header")
    )
    joined = pieces.filter("not header").select(
        F.array_join(F.transform("pieces", lambda p: p.record), "\n").alias("record"), "file"
    )
    records = found.filter("owner is null").select("record", "file").unionAll(joined)
    return records.withColumn("record", F.regexp_replace("record", "\r$", "")).filter("record <> ''")
