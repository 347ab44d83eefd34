"""CSV records with quoted line breaks, read by many tasks per file.

Spark's ``multiLine`` reader gives a whole file to one task, because where a record
begins depends on all quotes before it. That dependence is one bit: whether the number of
quotes so far is odd. So the file is read as text lines in byte ranges, and

1. each range counts its quotes and notes, for either value of the bit at its start,
   where its last record begins;
2. prefix sums over a file's ranges (one row per range) give every range its bit, and
   the record that is open at its start;
3. a line that begins and ends a record is one; the others meet by the place where
   their record begins, at most one record's lines in a group.

Only lines of records with line breaks are shuffled. Records are parsed by ``from_csv``
with the contract's options, so cells and corrupt records are those of the file reader.
A quote inside a quoted cell must be doubled (the default of the contracts): other escapes do
not keep the count and are left to the file reader.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FILE, BLOCK = "_file", "_block"
_LINES = f"{FILE} string, {BLOCK} long, n long, value string, odd boolean, quotes int, begin0 long, begin1 long"


def _numbered(batches):
    """Per line of a range: its number, whether an odd number of quotes of this range stands
    before it, its own quotes, and the line that begins its record if the range starts
    outside (0) or inside (1) a quoted cell; -1 if that is in an earlier range."""
    key, n, odd, begin = None, 0, 0, [-1, -1]
    for batch in batches:
        files, blocks = batch.column(FILE).to_pylist(), batch.column(BLOCK).to_pylist()
        quotes = pc.count_substring(batch.column("value"), '"').to_numpy(zero_copy_only=False).astype(np.int64)
        at, rows = 0, batch.num_rows
        while at < rows:
            here = (files[at], blocks[at])
            end = at + 1
            if (files[-1], blocks[-1]) == here:
                end = rows
            else:
                while end < rows and (files[end], blocks[end]) == here:
                    end += 1
            if here != key:
                key, n, odd, begin = here, 0, 0, [-1, -1]
            own = quotes[at:end]
            before = (odd + np.cumsum(own) - own) % 2
            number = n + np.arange(end - at)
            begins = [np.maximum.accumulate(np.where(before == bit, number, begin[bit])) for bit in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).slice(at, end - at) for c in (FILE, BLOCK)), pa.array(number), batch.column("value").slice(at, end - at),
                 pa.array(before == 1), pa.array(own.astype(np.int32)), *map(pa.array, begins)],
                names=[FILE, BLOCK, "n", "value", "odd", "quotes", "begin0", "begin1"],
            )
            n, odd, begin = n + end - at, int(before[-1] + own[-1]) % 2, [int(b[-1]) for b in begins]
            at = end


def records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(_file, first, record): the records of the files; ``first`` marks a file's first one."""
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK), "value"
    ).mapInArrow(_numbered, _LINES)
    ranges = lines.groupBy(FILE, BLOCK).agg(F.sum("quotes").alias("quotes"), F.max("begin0").alias("last0"), F.max("begin1").alias("last1"))
    order = Window.partitionBy(FILE).orderBy(BLOCK)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    last = F.when(F.col("inside"), F.col("last1")).otherwise(F.col("last0"))
    ranges = ranges.withColumn("place", F.when(last >= 0, F.struct(F.col(BLOCK).alias("b"), last.alias("n"))))
    ranges = ranges.withColumn("open", F.last("place", ignorenulls=True).over(before)).select(FILE, BLOCK, "inside", "open")
    placed = lines.join(ranges, [FILE, BLOCK])
    begin = F.when(F.col("inside"), F.col("begin1")).otherwise(F.col("begin0"))
    place = F.when(begin >= 0, F.struct(F.col(BLOCK).alias("b"), begin.alias("n"))).otherwise(F.col("open"))
    placed = placed.select(FILE, BLOCK, "n", "value", "quotes", place.alias("at"))
    alone = (F.col("at.b") == F.col(BLOCK)) & (F.col("at.n") == F.col("n")) & (F.col("quotes") % 2 == 0)
    first = (F.col("at.b") == 0) & (F.col("at.n") == 0)
    single = placed.filter(alone).select(FILE, first.alias("first"), F.col("value").alias("record"))
    parts = F.sort_array(F.collect_list(F.struct(BLOCK, "n", "value")))
    several = placed.filter(~alone).groupBy(FILE, "at").agg(F.array_join(F.transform(parts, lambda x: x["value"]), "\n").alias("record"))
    every = single.unionByName(several.select(FILE, first.alias("first"), "record"))
    # A carriage return before the line break that ends a record is part of the break.
    every = every.withColumn("record", F.when(F.endswith("record", F.lit("\r")), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record")))
    return every.filter("record <> ''")


def can_split(options: dict) -> bool:
    """Whether the contract's reader options leave quoting and line ends at their defaults."""
    return not {k.lower() for k in options} & {"encoding", "charset", "linesep", "quote", "escape", "comment", "chartoescapequoteescaping"}
