"""CSV with quoted line breaks, read by many tasks a file.

Spark's ``multiLine`` reader takes each file as one split, because a task that starts in the middle
of a file cannot tell whether a line end stands inside quotes. Here a file is read as lines, which
Spark splits at any byte, in two passes:

1. Every quote character toggles "inside quotes" (a doubled one twice), so the parity of the quotes
   of each split is counted, and prefix-summed over the splits of a file: one small row a split.
2. With the parity at its start known, each task puts the lines of its splits together to records as
   they stream by. A record that runs over the end of a split leaves its beginning there and its
   rest at the head of later splits; only these pieces, at most two a split, are shuffled and joined.

Records then pass Spark's own ``from_csv``. Results equal the ``multiLine`` reader's for files whose
quotes are at the edges of fields or doubled inside them (RFC 4180): a lone quote inside an unquoted
field shifts what follows. An unclosed quote makes one record of the rest of its file, there as here.
Blank lines are no records; line ends may be ``\\n`` or ``\\r\\n`` (inside quotes ``\\n`` comes back).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_PIECES = "file string, split bigint, kind int, first boolean, value string"
_PIECE_TYPE = pa.schema(
    [("file", pa.string()), ("split", pa.int64()), ("kind", pa.int32()), ("first", pa.bool_()), ("value", pa.string())]
)
RECORD, REST, BEGINNING = 0, 1, 2  # a whole record; pieces of one that crosses the end of a split


def _lines(spark: SparkSession, path: str, quote: str) -> DataFrame:
    """(file, split, value, odd): lines in the order of the file inside each split, which is named
    by its first byte; ``odd``: an odd number of quotes."""
    lines = spark.read.text(path, lineSep="\n")
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value",
        (quotes % 2 == 1).alias("odd"),
    )


def _inside_at_start(lines: DataFrame) -> DataFrame:
    """(file, split, inside): whether a split starts inside quotes. One row a split, some hundred
    bytes for each ``spark.sql.files.maxPartitionBytes`` of input."""
    parity = lines.groupBy("file", "split").agg(F.sum(F.col("odd").cast("int")).alias("quotes"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    return parity.select("file", "split", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside"))


class _Assembler:
    """Puts the lines of one split together."""

    def __init__(self, file: str, split: int, inside: bool):
        self.file, self.split, self.inside = file, split, inside
        self.first = split == 0  # the next record is the file's first
        self.open: list[str] = []
        self.kind = REST if inside else RECORD
        self.done: list[tuple] = []

    def add(self, line: str, odd: bool) -> None:
        self.inside ^= odd
        self.open.append(line[:-1] if line.endswith("\r") else line)
        if not self.inside:
            self.close(self.kind)

    def close(self, kind: int) -> None:
        value = "\n".join(self.open)
        if value or kind != RECORD:
            self.done.append((self.file, self.split, kind, self.first, value))
            self.first = False
        self.open, self.kind = [], RECORD

    def end(self) -> None:
        if self.open:
            self.close(REST if self.kind == REST else BEGINNING)

    def taken(self) -> pa.RecordBatch:
        rows, self.done = self.done, []
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(_PIECE_TYPE)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PIECE_TYPE, strict=True)], schema=_PIECE_TYPE)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at: _Assembler | None = None
    for batch in batches:
        start = 0
        while start < batch.num_rows:
            file, split = batch.column("file")[start].as_py(), batch.column("split")[start].as_py()
            same = pc.and_(pc.equal(batch.column("file"), file), pc.equal(batch.column("split"), split))
            rest = pc.index(same.slice(start), False).as_py()  # files do not return within a task
            end = batch.num_rows if rest < 0 else start + rest
            if at is None or (at.file, at.split) != (file, split):
                if at is not None:
                    at.end()
                    yield at.taken()
                at = _Assembler(file, split, batch.column("inside")[start].as_py())
            part = batch.slice(start, end - start)
            for line, odd in zip(part.column("value").to_pylist(), part.column("odd").to_pylist(), strict=True):
                at.add(line, odd)
            yield at.taken()
            start = end
    if at is not None:
        at.end()
        yield at.taken()


def csv_records(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """(value, first): the records of the CSV files under ``path``, line breaks included, and
    whether one is its file's first."""
    lines = _lines(spark, path, quote)
    # One row a split, and a split is megabytes of input: small enough to send to every task.
    known = lines.join(F.broadcast(_inside_at_start(lines)), ["file", "split"])
    pieces = known.mapInArrow(_pieces, _PIECES)
    # A rest belongs to the last beginning before it.
    order = Window.partitionBy("file").orderBy("split", "kind").rowsBetween(Window.unboundedPreceding, 0)
    parts = pieces.where(F.col("kind") != RECORD).withColumn("record", F.sum((F.col("kind") == BEGINNING).cast("long")).over(order))
    texts = F.sort_array(F.collect_list(F.struct("split", "kind", "value")))
    crossing = parts.groupBy("file", "record").agg(F.array_join(F.transform(texts, lambda p: p.value), "\n").alias("value"), F.max("first").alias("first"))
    return pieces.where(F.col("kind") == RECORD).select("value", "first").unionByName(crossing.select("value", "first"))


def read_csv_in_splits(spark: SparkSession, path: str, options: Mapping[str, str]) -> DataFrame:
    """The CSV files under ``path`` as string columns, named by the first file's header (``_c0``
    and so on without ``header``). ``options`` are those of Spark's CSV reader."""
    opts = {k: v for k, v in options.items() if k.lower() != "multiline"}
    header = str({k.lower(): v for k, v in opts.items()}.get("header", "false")).lower() == "true"
    names = spark.read.options(**opts, multiLine="true").csv(path).columns
    records = csv_records(spark, path, opts.get("quote", '"'))
    if header:
        records = records.where(~F.col("first"))
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    parse = {k: v for k, v in opts.items() if k.lower() not in ("header", "encoding")}
    return records.select(F.from_csv("value", schema, parse).alias("r")).select("r.*").toDF(*names)
