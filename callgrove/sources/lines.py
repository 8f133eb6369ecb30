"""Distributed reading of text reports, line by line.

A report is one file or, with ``parts=True``, a folder of part files in name order.
Files are split like any text source, so a report of any size is read by many tasks.
The order of its lines is kept as (file, start of the split, sequence in the split);
all bookkeeping below works on splits, whose size the reader bounds, never on whole
reports.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from callgrove.plans.lineage import cut, cut_and_observe
from callgrove.plans.lookup import BROADCAST_BYTES, lookup, measured_bytes

SPLIT = ["report", "file", "block"]


def read_lines(spark: SparkSession, path: str, *, parts: bool = False) -> DataFrame:
    """Every line as ``report, file, block, seq, line``."""
    text = spark.read.option("recursiveFileLookup", True).text(path)
    return text.select(
        _report(F.col("_metadata.file_path"), parts).alias("report"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").alias("line"),
    )


def kept(lines: DataFrame) -> DataFrame:
    """Lines stored once with their place.

    Borders of splits follow session settings that may change between a load and the use
    of its rows.  Headers, counts and row numbers all come from this one copy.
    """
    return cut(lines)


def list_reports(spark: SparkSession, path: str, *, parts: bool = False) -> DataFrame:
    """Every report, also those without a line, which a scan of lines would skip.

    The files are listed as a table; their contents are not read.
    """
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    files = scan.select(F.col("path").alias("file"))
    # No scan shows empty files.  The session lists all; its list is taken over only if longer.
    listed = scan._jdf.inputFiles()
    if len(listed) > files.count():
        files = spark.createDataFrame([(name,) for name in listed], "file string")
    return files.select(_report(F.col("file"), parts).alias("report")).distinct()


def _report(file: Column, parts: bool) -> Column:
    # Local paths come with one slash from a scan and with three from a listing.
    file = F.regexp_replace(file, "^file:/+", "file:/")
    return F.regexp_replace(file, r"/[^/]*$", "") if parts else file


def experiment_of(report: Column) -> Column:
    """Experiment id: the last number in the report name before any suffix."""
    digits = F.regexp_extract(report, r"(\d+)(?:\.[A-Za-z]\w*)*$", 1)
    return digits.try_cast("bigint")


def summarize_splits(lines: DataFrame, **aggregates: Column) -> tuple[DataFrame, float]:
    """A row per split with ``first``, its first sequence number, and the given aggregates.

    ``lines`` are :func:`kept`.  The result is stored too, so judging the reports and
    numbering their rows does not read the lines again.  The second result is its size.
    """
    splits = lines.groupBy(*SPLIT).agg(
        F.min("seq").alias("first"),
        *(aggregate.alias(name) for name, aggregate in aggregates.items()),
    )
    stored, seen = cut_and_observe(splits, bytes=F.sum(F.length("report") + F.length("file") + 96))
    return stored, float(seen.get("bytes") or 0)


def first_lines(lines: DataFrame, splits: DataFrame, unit: Sequence[str], size: float) -> DataFrame:
    """The first line of each unit (report or file): ``unit, _top``.

    ``_top`` is ``file, block, seq, line``.  Units have few lines of theirs read: the places of
    the first ones are looked up in the stored lines.
    """
    place = F.min(F.struct("file", "block", F.col("first").alias("seq"))).alias("_at")
    places = splits.groupBy(*unit).agg(place).select("report", "_at.*")
    found = lookup(
        lines, places, [*SPLIT, "seq"], table_bytes=size, spread=["seq"], how="left_semi"
    )
    return found.select(*unit, F.struct("file", "block", "seq", "line").alias("_top"))


# Records over several lines


def quotes_of(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))


def whole_records(lines: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Lines with every record of a quoted file on one row, and the files that end in a quote.

    A line belongs to the record before it if an odd number of quotes of its file stand before
    it.  Quotes are counted by split, and the counts summed over the splits of a file, so a
    record may begin in one split and end in another.  Only splits that touch a record of
    several lines are numbered line by line; all other lines pass as they are.  The lines of
    a record are joined by line feeds and take the place of its first line.

    Files whose last quote is open are left as they are.  ``None`` stands for no such file.
    """
    odd = quotes_of(F.col("line")) % 2
    counts, seen = cut_and_observe(
        lines.groupBy(*SPLIT).agg(F.sum(odd.cast("long")).alias("_odd")), odd=F.sum("_odd")
    )
    if not seen.get("odd"):
        return lines, None
    of_file = Window.partitionBy("report", "file")
    earlier = of_file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    states = cut(
        counts.withColumn("_before", F.coalesce(F.sum("_odd").over(earlier), F.lit(0)))
        .withColumn("_open", F.sum("_odd").over(of_file) % 2 == 1)
        .where("_open or _odd > 0 or _before % 2 = 1")
    )
    unclosed = states.where("_open").select("report", "file").distinct()
    touched = states.where("not _open").select(*SPLIT, "_before")
    size = measured_bytes(states, F.length("report") + F.length("file") + 64)
    numbered = lookup(lines, touched, SPLIT, table_bytes=size, spread=["seq"])
    rest = lines.join(F.broadcast(touched) if size <= BROADCAST_BYTES else touched, SPLIT, "left_anti")
    in_split = Window.partitionBy(*SPLIT).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    numbered = numbered.withColumn("_odd", odd).withColumn(
        "_quotes", F.col("_before") + F.coalesce(F.sum("_odd").over(in_split), F.lit(0))
    )
    alone = (F.col("_quotes") % 2 == 0) & (F.col("_odd") == 0)
    # Quotes before a line open and close in turn, so each pair of odd lines is a record.
    joined = (
        numbered.where(~alone)
        .groupBy("report", "file", F.floor(F.col("_quotes") / 2).alias("_record"))
        .agg(F.sort_array(F.collect_list(F.struct("block", "seq", "line"))).alias("_lines"))
        .select(
            "report",
            "file",
            F.col("_lines")[0]["block"].alias("block"),
            F.col("_lines")[0]["seq"].alias("seq"),
            F.array_join(F.transform("_lines", lambda part: part["line"]), "\n").alias("line"),
        )
    )
    columns = [*SPLIT, "seq", "line"]
    whole = rest.select(columns).unionByName(numbered.where(alone).select(columns)).unionByName(joined)
    return cut(whole), unclosed


def with_row_offsets(splits: DataFrame, rows: str) -> DataFrame:
    """Add ``offset``, the rows of the same report in earlier splits."""
    earlier = Window.partitionBy("report").orderBy("file", "block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return splits.withColumn("offset", F.coalesce(F.sum(rows).over(earlier), F.lit(0)))


def number_in_report(rows: DataFrame, name: str) -> DataFrame:
    """Add ``name``, the 0-based position in the report, from ``offset`` and ``seq``."""
    in_split = Window.partitionBy(*SPLIT).orderBy("seq")
    return rows.withColumn(name, F.row_number().over(in_split) - F.lit(1) + F.col("offset"))


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def csv_cells(line: Column) -> Column:
    """Cells of a comma-separated line; quotes protect commas and double themselves."""
    quoted = F.regexp_extract_all(
        F.concat(F.lit(","), line), F.lit(r',\s*("[^"]*+(?:""[^"]*+)*+"|[^,]*)'), F.lit(1)
    )
    unquoted = F.transform(
        quoted,
        lambda cell: F.when(
            F.startswith(cell, F.lit('"')),
            F.replace(F.regexp_replace(cell, r'^"|"\s*$', ""), F.lit('""'), F.lit('"')),
        ).otherwise(F.btrim(cell, F.lit(" \t"))),
    )
    plain = F.transform(F.split(line, ","), lambda cell: F.btrim(cell, F.lit(" \t")))
    return F.when(F.contains(line, F.lit('"')), unquoted).otherwise(plain)


def cell_of(cells: Column, header: Column, name: str) -> Column:
    """Cell below the header ``name``; null where the row is short or the cell empty."""
    at = F.array_position(header, name)
    return F.nullif(F.get(cells, (at - 1).cast("int")), F.lit(""))
