"""Raw and clean sales files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almacen.functions.text import blank_to_null
from almacen.model import NA_TOKENS
from almacen.sources.passes import write_in_passes


_LINE = "_line"


def _cells_of(spark: SparkSession, path: str, multiline: bool) -> tuple[DataFrame, list[str]]:
    """The cells by position, the raw line where their number is not the header's, and the header."""
    reader = (
        spark.read.option("header", True)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .option("multiLine", multiline)
    )
    header = reader.option("inferSchema", False).csv(path).columns
    fields = [T.StructField(f"_{i}", T.StringType()) for i in range(len(header))]
    schema = T.StructType([*fields, T.StructField(_LINE, T.StringType())])
    if not multiline:
        return reader.option("columnNameOfCorruptRecord", _LINE).schema(schema).csv(path), header
    options = {"escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": _LINE}
    cells = F.from_csv("value", schema.toDDL(), options)
    return _records(spark, path).select(cells.alias("cells")).select("cells.*"), header


def _scanned(line: Column, inside: bool = False) -> Column:
    """What a line leaves behind: commas outside of cells in quotes, and whether one is open.

    The text between two quotes is taken one piece after the other, with what is known
    so far, so cells of any length and with any number of quotes need no recursion. A
    quote opens a cell only where the cell begins; two quotes inside are one. ``inside`` says that the line begins within a cell.
    """
    start = F.struct(
        F.lit(0).alias("commas"),
        F.lit(inside).alias("inside"),
        F.lit(False).alias("closed"),
        F.lit(not inside).alias("blank"),
        F.lit(inside).alias("open"),
    )

    def next_piece(seen: Column, piece: Column) -> Column:
        commas = F.length(piece) - F.length(F.replace(piece, F.lit(",")))
        tail = F.length(F.substring_index(piece, ",", -1)) == 0
        blank = F.when(commas > 0, tail).otherwise(seen["blank"] & tail)
        doubled = seen["closed"] & (F.length(piece) == 0)
        return F.struct(
            (seen["commas"] + F.when(seen["inside"], 0).otherwise(commas)).alias("commas"),
            (~seen["inside"] & (blank | doubled)).alias("inside"),
            seen["inside"].alias("closed"),
            F.lit(False).alias("blank"),
            seen["inside"].alias("open"),
        )

    return F.aggregate(F.split(line, '"'), start, next_piece)


def _records(spark: SparkSession, path: str) -> DataFrame:
    """The records of a CSV file or folder without headers (column ``value``), line breaks in quotes kept.

    Files are read in splits like any text. Each line says how it ends if it begins
    outside, and if it begins within a cell in quotes. Within a split the lines are
    followed in order; how a split begins follows from the splits of its file before it,
    one row for each. So every line knows whether it begins a record, and only the
    lines of records with breaks are put together.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )
    ends = {"out": _scanned(F.col("value"))["open"], "in_": _scanned(F.col("value"), True)["open"]}
    lines = lines.withColumns(ends)
    in_split = Window.partitionBy("file", "block").orderBy("line")
    # A line that ends alike however it begins settles the state; one that swaps it is counted.
    lines = _followed(lines, in_split, F.lit(False), "from_out")
    lines = _followed(lines, in_split, F.lit(True), "from_in")
    splits = lines.groupBy("file", "block").agg(
        F.max_by("from_out_end", "line").alias("out"),
        F.max_by("from_in_end", "line").alias("in_"),
        F.max(F.when(~F.col("from_out"), F.col("line"))).alias("last_out"),
        F.max(F.when(~F.col("from_in"), F.col("line"))).alias("last_in"),
    )
    in_file = Window.partitionBy("file").orderBy("block")
    splits = _followed(splits, in_file, F.lit(False), "begins")
    # The record that a split's first lines belong to, if it began in a split before it.
    last = F.when(F.col("begins"), F.col("last_in")).otherwise(F.col("last_out"))
    last = F.when(last.isNotNull(), F.struct("block", last.alias("line")))
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "block", "begins", F.last(last, True).over(before).alias("carried"))
    lines = lines.join(splits, ["file", "block"])
    inside = F.when(F.col("begins"), F.col("from_in")).otherwise(F.col("from_out"))
    ends_in = F.when(F.col("begins"), F.col("from_in_end")).otherwise(F.col("from_out_end"))
    lines = lines.select("file", "block", "line", "value", "carried", inside.alias("inside"), ends_in.alias("open"))
    begun = F.when(~F.col("inside"), F.struct("block", "line"))
    lines = lines.withColumn("record", F.coalesce(F.last(begun, True).over(in_split), "carried"))
    whole = lines.filter("not inside and not open").select("file", "record", "value")
    parts = lines.filter("inside or open").groupBy("file", "record")
    parts = parts.agg(F.array_sort(F.collect_list(F.struct("block", "line", "value"))).alias("parts"))
    joined = parts.select("file", "record", F.array_join("parts.value", "\n").alias("value"))
    records = whole.unionByName(joined)
    first = records.groupBy("file").agg(F.min("record").alias("first"))
    records = records.join(first, "file").filter("record != first")
    # A join leaves the records of a file in any order; within a task they keep that of the file.
    records = records.sortWithinPartitions("file", "record")
    value = F.regexp_replace("value", r"\r$", "").alias("value")
    return records.select(value).filter("value != ''")


def _followed(rows: DataFrame, order: Window, begins: Column, name: str) -> DataFrame:
    """Add whether each row begins (``name``) and ends (``name``_end) within a cell, in order.

    ``out`` and ``in_`` say how a row ends if it begins outside and within; ``begins``
    is how the first row begins.
    """
    settled = F.col("out") == F.col("in_")
    swaps = F.sum((F.col("out") & ~F.col("in_")).cast("int")).over(order)
    last = F.last(F.when(settled, F.struct(F.col("out").alias("open"), swaps.alias("swaps"))), True).over(order)
    state = F.coalesce(last["open"], begins) != ((swaps - F.coalesce(last["swaps"], F.lit(0))) % 2 == 1)
    return rows.withColumn(f"{name}_end", state).withColumn(
        name, F.coalesce(F.lag(f"{name}_end").over(order), begins)
    )


def _malformed(columns: int, multiline: bool) -> Column:
    """Whether a line has more cells than the header, or a quote that it does not close."""
    line = F.coalesce(F.col(_LINE), F.lit(""))
    extra = _scanned(line)["commas"] >= columns
    # A cell left open at the end of a complete line shows in the next one, which closes it.
    bad = extra if multiline else extra | (F.regexp_count(line, F.lit('"')) % 2 == 1)
    # Always true; it keeps all cells in the scan, which counts those it is asked for only.
    return bad & (F.length(F.concat_ws("", *[f"_{i}" for i in range(columns)])) >= 0)


def malformed_lines(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """The lines that ``load_raw`` refuses, each as raw text."""
    rows, header = _cells_of(spark, path, multiline)
    return rows.filter(_malformed(len(header), multiline)).select(F.col(_LINE).alias("linea"))


def _read_csv(spark: SparkSession, path: str, multiline: bool, na_tokens) -> DataFrame:
    rows, header = _cells_of(spark, path, multiline)
    message = F.concat(F.lit("malformed line: "), F.col(_LINE))
    refused = F.when(_malformed(len(header), multiline), F.raise_error(message).cast("boolean"))
    rows = rows.filter(F.coalesce(refused, F.lit(True)))
    cells = [blank_to_null(F.col(f"_{i}"), na_tokens).alias(c) for i, c in enumerate(header)]
    return rows.select(*cells)


def load_raw(
    spark: SparkSession, path: str, multiline: bool = False, na_tokens=NA_TOKENS
) -> DataFrame:
    """A CSV file or folder with a header row, every column as text.

    Set ``multiline`` when quoted cells hold line breaks. A large file is cut into
    ``spark.sql.files.maxPartitionBytes`` pieces either way; with ``multiline`` the lines
    are shuffled once, by piece, to see which of them belong together.

    Lines with fewer cells than the header are padded with nulls. More cells, or
    (without ``multiline``) a quote that the line leaves open, stop the job that
    reads them; ``malformed_lines`` lists all of them.
    """
    return _read_csv(spark, path, multiline, na_tokens)


def load_clean_csv(
    spark: SparkSession, path: str, multiline: bool = False, na_tokens=NA_TOKENS
) -> DataFrame:
    """A clean CSV export as text, names lower-cased.

    Text that cleaning has turned into a "no value" token (an empty string,
    ``None``) becomes null here; ``operators.boundary`` types and rejects.
    """
    rows = _read_csv(spark, path, multiline, na_tokens)
    return rows.toDF(*[c.lower() for c in rows.columns])


def export_clean(clean: DataFrame, path: str) -> None:
    """Replace the clean dataset at ``path`` (Parquet)."""
    write_in_passes(iter([clean]), path)


def export_clean_csv(clean: DataFrame, path: str, compression: str = "none") -> None:
    """Replace the clean dataset at ``path`` (CSV folder, one header per part)."""
    (
        clean.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path, compression=compression)
    )
