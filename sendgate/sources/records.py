"""Records of quoted CSV files, split like plain lines: one file is read by many tasks.

Where a line end may stand inside quotes, a task that starts in the middle of a file does not know
whether it starts inside quotes. That only depends on how many lines before it have an odd number
of quotes (an escaped quote is two). So the odd lines are counted per byte range first, the counts
are added up in the order of the ranges, and the ranges are read again with what stands before
them. A line that starts outside and is not odd is a record by itself and stays where it is; only
the lines of longer records are brought together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sendgate.session import broadcast_if_small, keep

_SPLIT = ["_file", "_start"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines with the file and the byte range they were read from."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.input_file_name().alias("_file"),
        F.input_file_block_start().alias("_start"),
    )


def _numbered(lines: DataFrame) -> DataFrame:
    """Every line with its place in its range, and the odd lines of the range before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, place, odd = None, 0, 0
        for batch in batches:
            files, starts = batch["_file"], batch["_start"].to_numpy()
            # A batch of a large file has one range; ranges come one behind the other.
            names = files.dictionary_encode()
            codes = names.indices.to_numpy()
            new = (np.diff(codes) != 0) | (np.diff(starts) != 0)
            cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
            quotes = pc.count_substring(batch["value"], pattern='"').to_numpy(zero_copy_only=False) & 1
            places, before = np.empty(batch.num_rows, np.int64), np.empty(batch.num_rows, np.int64)
            for first, last in zip(cuts, cuts[1:]):
                if last <= first:
                    continue
                here = (files[first].as_py(), int(starts[first]))
                if here != split:
                    split, place, odd = here, 0, 0
                part = quotes[first:last]
                places[first:last] = place + np.arange(last - first)
                running = odd + np.cumsum(part)
                before[first:last] = running - part
                place, odd = place + last - first, int(running[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(places), pa.array(before), pa.array(quotes.astype(bool))],
                [*batch.schema.names, "_place", "_before", "_odd"],
            )

    return lines.mapInArrow(
        run, "value string, _file string, _start long, _place long, _before long, _odd boolean"
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of the CSV files at ``path``: record, and whether it is the first of its file.

    Records end at a line feed outside quotes, also after a carriage return; empty ones are left
    out. A file may be read by any number of tasks. Quotes that never close make the rest of
    their file one record. The order of records is not kept.
    """
    lines = _lines(spark, path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    odd = lines.groupBy(*_SPLIT).agg(F.sum(quotes % 2).alias("_odd_lines"))
    earlier = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    # A row per byte range, some 100 million bytes each.
    ahead = keep(
        odd.select(*_SPLIT, F.coalesce(F.sum("_odd_lines").over(earlier), F.lit(0)).alias("_ahead")),
        "odd-lines",
    )
    placed = _numbered(lines).join(broadcast_if_small(ahead), _SPLIT)
    before = F.col("_ahead") + F.col("_before")
    placed = placed.select(*_SPLIT, "_place", "value", "_odd", before.alias("_before"))
    outside = F.col("_before") % 2 == 0
    first = (F.col("_start") == 0) & (F.col("_place") == 0)

    alone = placed.where(outside & ~F.col("_odd")).select(F.col("value").alias("record"), first.alias("first"))
    # The k-th pair of odd lines opens and closes a record, with all lines between.
    parts = placed.where(~outside | F.col("_odd")).groupBy(
        "_file", F.floor(F.col("_before") / 2).alias("_number")
    )
    joined = parts.agg(
        F.array_sort(F.collect_list(F.struct("_start", "_place", "value"))).alias("_lines"),
        F.max(first).alias("first"),
    ).select(F.array_join(F.col("_lines.value"), "\n").alias("record"), "first")
    records = alone.unionByName(joined)
    return records.select(F.regexp_replace("record", "\\r$", "").alias("record"), "first").where(
        F.trim("record") != ""
    )
