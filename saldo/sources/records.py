"""CSV records that hold quoted line breaks, read from splits of a file by many tasks.

A line break lies within quotes if an odd number of quotes comes before it. One pass counts the quotes of every
split; sums over the splits of a file tell which of them begin within quotes. In a second pass each task cuts its
split into records at true record ends. Only the parts of records that cross a split, at most two per split, are
put together across tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Splits up to which their states are sent to every task.
BROADCAST_SPLITS = 1 << 16

_PARTS = "file string, block long, id long, record string, part int"
# A whole record, and the parts of one that begins in a split, passes through it, or ends in it.
_WHOLE, _BEGINS, _PASSES, _ENDS = range(4)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).selectExpr(
        "_metadata.file_path AS file", "_metadata.file_block_start AS block", "value"
    )


def _opened(lines: DataFrame) -> DataFrame:
    """Whether each split begins within quotes: (file, block, inside). One row per split."""
    quotes = "sum(length(value) - length(replace(value, '\"', '')))"
    splits = lines.groupBy("file", "block").agg(F.expr(f"{quotes} AS quotes"))
    before = "sum(quotes) OVER (PARTITION BY file ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return splits.selectExpr("file", "block", f"coalesce({before}, 0) % 2 = 1 AS inside")


def _cut(parts: tuple[int, int, int, int]):
    """A function that cuts the lines of splits, which come in order, into records and parts of records."""
    whole, begins, passes, ends = parts

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "block", "id", "record", "part"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        split, held, first, inside, continued = None, [], 0, False, False

        for batch in batches:
            odd = pc.equal(pc.bit_wise_and(pc.count_substring(batch.column("value"), '"'), 1), 1)
            if not held and not pc.any(pc.or_(odd, batch.column("inside"))).as_py():
                # no quote is open at the end of any line
                columns = [batch.column(c) for c in ("file", "block", "id", "value")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([whole] * batch.num_rows, pa.int32())], names)
                split, inside, continued = tuple(c[-1].as_py() for c in columns[:2]), False, False
                continue
            rows: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in ("file", "block", "id", "value", "inside")]
            for file, block, id_, value, opened, changes in zip(*columns, odd.to_pylist(), strict=True):
                if split != (file, block):
                    if held:
                        rows.append((*split, first, "\n".join(held), passes if continued else begins))
                    split, held, inside = (file, block), [], opened
                    continued = inside
                if not held:
                    first = id_
                held.append(value)
                inside ^= changes
                if not inside:
                    rows.append((file, block, first, "\n".join(held), ends if continued else whole))
                    held, continued = [], False
            if rows:
                yield batch_of(rows)
        if held:
            yield batch_of([(*split, first, "\n".join(held), passes if continued else begins)])

    return cut


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of CSV files in file order: (file, block, id, record); ``block`` and ``id`` say where they begin.

    Quotes in the files must follow the usual rule: fields that hold quotes, commas or line breaks are quoted, and
    quotes in them doubled. A file with an open quote has one long last record, without the line break that ends the
    file. Empty lines are left out. The files are read three times, by as many tasks as they have splits.
    """
    lines = _lines(spark, path)
    opened = _opened(lines)
    if opened.count() <= BROADCAST_SPLITS:
        opened = F.broadcast(opened)
    numbered = lines.withColumn("id", F.monotonically_increasing_id()).join(opened, ["file", "block"])
    found = numbered.select("file", "block", "id", "value", "inside").mapInArrow(_cut((_WHOLE, _BEGINS, _PASSES, _ENDS)), _PARTS)
    begun = f"sum(CASE WHEN part = {_BEGINS} THEN 1 ELSE 0 END) OVER (PARTITION BY file ORDER BY block, id) AS nth"
    pieces = F.array_sort(F.collect_list(F.struct("block", "id", "record"))).alias("pieces")
    joined = (
        found.filter(f"part <> {_WHOLE}")
        .selectExpr("*", begun)
        .groupBy("file", "nth")
        .agg(pieces)
        .selectExpr("file", "pieces[0].block AS block", "pieces[0].id AS id", "array_join(pieces.record, '\\n') AS record")
    )
    whole = found.filter(f"part = {_WHOLE}").select("file", "block", "id", "record")
    ended = "regexp_replace(record, '\\r$', '') AS record"
    return whole.unionByName(joined).selectExpr("file", "block", "id", ended).filter("record <> ''")
