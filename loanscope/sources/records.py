"""Records of delimited text whose quoted fields hold line feeds, read from split files.

A line feed ends a record unless a quote is open. Whether one is open at the start of a block
depends on all that comes before, which a task that reads the block does not see. But a line
changes that state in one of four ways: it keeps it, flips it, opens or closes whatever it
was. Such changes add up in any grouping, so each block adds up its own, one small row for each
block settles in what state blocks begin, and lines then learn their state inside their block.

Only files with a line that leaves a quote open go this way; all others are read as lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanscope.sources.storage import scratch_dir, written

#: Characters of a record of several lines. A quote that is never closed would swallow the rest
#: of a file; beyond this (the usual limit of CSV readers for one field) it is an error.
LONGEST_RECORD = 131_072

#: Lines that one window orders at most.
LINES_OF_BLOCK = 1 << 16

# A field is quoted, with doubled quotes inside, or begins with another character; quotes further
# on in it mean themselves. Possessive, so that a line is read once.
_REST_OF_QUOTED = r'(?:[^"]++|"")*+"[^|]*+'
_FIELD = rf'(?:"{_REST_OF_QUOTED}|[^"|][^|]*+|)'
_ENDS_CLOSED = rf"^{_FIELD}(?:\|{_FIELD})*+$"
_CLOSES = rf"^{_REST_OF_QUOTED}(?:\|{_FIELD})*+$"


def _stays_open(line: Column) -> Column:
    """Whether a line that begins outside quotes ends inside."""
    return line.contains('"') & ~line.rlike(_ENDS_CLOSED)


def files_with_open_lines(spark: SparkSession, path: str) -> list[str]:
    """Files with a record of several lines: those with a line that leaves a quote open.

    As long as no line of a file does, all of them begin outside quotes, so one pass without
    order decides. The names fit on the driver, as those of all files do to plan a scan.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("source_file"))
    found = lines.filter(_stays_open(F.col("value"))).select("source_file").distinct()
    return sorted(row.source_file for row in found.collect())


def _state(before: Window, start: Column | None, change: str) -> Column:
    """Whether a quote is open before a row, from the ``change`` of rows before it in order.

    ``change`` is 'open', 'close', 'flip' or 'keep'. What the last 'open' or 'close' left, and
    the flips since, decide; without either it is ``start``, flipped as often (NULL for None).
    """
    flips = F.count_if(F.col(change) == "flip")
    upto = before.rowsBetween(Window.unboundedPreceding, -1)
    sets = F.col(change).isin("open", "close")
    fixed = F.struct((F.col(change) == "open").alias("open"), F.col("flips").alias("at"))
    last = F.last(F.when(sets, fixed), ignorenulls=True).over(upto)
    so_far = F.coalesce(flips.over(upto), F.lit(0))
    odd = lambda n: n % 2 == 1
    settled = last["open"] != odd(so_far - last["at"])
    begun = F.lit(None).cast("boolean") if start is None else start != odd(so_far)
    return F.when(last.isNotNull(), settled).otherwise(begun)


def _with_flips(rows: DataFrame, order: Window, change: str) -> DataFrame:
    """Adds ``flips``, how many up to and with the row."""
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("flips", F.count_if(F.col(change) == "flip").over(upto))


def _change(after_closed: Column, after_open: Column) -> Column:
    """What a stretch of text does, from the states after it for either state before."""
    return (
        F.when(after_closed & after_open, "open")
        .when(~after_closed & ~after_open, "close")
        .when(after_closed, "flip")
        .otherwise("keep")
    )


def multi_line_records(lines: DataFrame, longest: int = LONGEST_RECORD) -> DataFrame:
    """``value, source_file``: a row for each record, its lines put together by line feeds.

    Takes ``source_file``, ``block`` (an order of the stretches of a file), ``place`` (an
    order of the lines in a block, unique over all) and ``value``. Each block is ordered by one
    task; files are not. A record that ends with its file is a record, closed or not.
    """
    spark = lines.sparkSession
    value = F.col("value")
    has = value.contains('"')
    after_open = ~has | ~value.rlike(_CLOSES)
    kept = written(
        lines.select("source_file", "block", "place", "value", _change(_stays_open(value), after_open).alias("change")),
        f"{scratch_dir(spark, 'records')}/lines",
    )
    # State of a line if its block begins closed, and if it begins open.
    in_block = Window.partitionBy("source_file", "block").orderBy("place")
    ordered = _with_flips(kept, in_block, "change")
    both = ordered.withColumn("inside", _state(in_block, F.lit(False), "change")).withColumn(
        "inside_of_open", _state(in_block, F.lit(True), "change")
    )
    after = lambda state: (
        F.when(F.col("change") == "open", True).when(F.col("change") == "close", False)
        .when(F.col("change") == "flip", ~F.col(state)).otherwise(F.col(state))
    )
    both = both.withColumn("then", after("inside")).withColumn("then_of_open", after("inside_of_open"))
    ends = F.max_by(F.struct("then", "then_of_open"), "place")
    starts = lambda state: F.max(F.when(~F.col(state), F.col("place")))
    blocks = both.groupBy("source_file", "block").agg(
        ends.alias("end"), starts("inside").alias("last"), starts("inside_of_open").alias("last_of_open")
    )
    blocks = blocks.withColumn("change", _change(F.col("end.then"), F.col("end.then_of_open")))
    # One row for each block: the state in which it begins, and the last record begun before it.
    in_file = Window.partitionBy("source_file").orderBy("block")
    blocks = _with_flips(blocks, in_file, "change").withColumn("begins_open", _state(in_file, F.lit(False), "change"))
    last = F.when(F.col("begins_open"), F.col("last_of_open")).otherwise(F.col("last"))
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("last_begun", last).select(
        "source_file", "block", "begins_open", F.last("last_begun", ignorenulls=True).over(before).alias("carried")
    )
    told = both.join(blocks, ["source_file", "block"])
    inside = F.when(F.col("begins_open"), F.col("inside_of_open")).otherwise(F.col("inside"))
    told = told.withColumn("begins", F.when(~inside, F.col("place")))
    upto = in_block.rowsBetween(Window.unboundedPreceding, 0)
    record = F.coalesce(F.last("begins", ignorenulls=True).over(upto), "carried").alias("record")
    # A line that begins and ends outside quotes is a record; only the others are gathered.
    alone = (~inside & F.col("change").isin("keep", "close")).alias("alone")
    told = written(
        told.select("source_file", "block", "place", "value", record, alone),
        f"{scratch_dir(spark, 'records')}/told",
    )
    single = told.filter("alone").select("value", "source_file")
    told = told.filter("NOT alone")

    size = F.sum(F.char_length("value") + 1).alias("size")
    long = told.groupBy("source_file", "record").agg(size, F.count("*").alias("n"))
    problem = long.filter((F.col("n") > 1) & (F.col("size") > longest)).select("source_file").first()
    if problem is not None:
        raise ValueError(f"a quote that stays open for more than {longest} characters in {problem.source_file}")
    parts = F.array_sort(F.collect_list(F.struct("block", "place", "value")))
    joined = F.array_join(F.transform(parts, lambda part: part["value"]), "\n")
    several = told.groupBy("source_file", "record").agg(joined.alias("value")).select("value", "source_file")
    return single.unionByName(several)


def split_lines(spark: SparkSession, paths: list[str], lines_of_block: int = LINES_OF_BLOCK) -> DataFrame:
    """Lines of files with the block in which each begins and its place among all lines.

    Blocks are the splits of the scan, cut after every ``LINES_OF_BLOCK`` places, so that one task
    orders no more however large splits are. Their sizes may change from one scan to the next, so
    whoever needs places stores what one scan told.
    """
    placed = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )
    # Places of a split follow one another, so its stretches have the order of its lines.
    stretch = F.expr(f"place DIV {int(lines_of_block)}")
    return placed.select("source_file", F.struct("start", stretch.alias("stretch")).alias("block"), "place", "value")
