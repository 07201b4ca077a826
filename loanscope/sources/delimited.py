"""Pipe-delimited source files, read as text under a fixed layout.

A field may be quoted, and a quoted pipe or line feed does not separate. Files without a
quoted line feed are read line by line; in the others lines are first put together to
records (see ``records``), and all files stay splittable.

The CSV source normally parses only the columns a query uses and then cannot tell
a line with too many or too few fields. Here pruning is off and every scan tests
the field count, so that ``count()`` and narrow projections fail on a damaged file
as a full read does.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanscope.domain import ORIGINATION_FIELDS, PERFORMANCE_FIELDS, VINTAGES
from loanscope.sources.records import files_with_open_lines, multi_line_records, split_lines

_MALFORMED = "_malformed_line"
_FORMAT = {
    "sep": "|",
    "quote": '"',
    "escape": '"',
    "columnNameOfCorruptRecord": _MALFORMED,
    "columnPruning": "false",
}
# Options of a record that is parsed by itself.
_OPTIONS = {name: value for name, value in _FORMAT.items() if name != "columnPruning"}
_SOURCE_YEAR = r"smallint(regexp_extract(source_file, r'sample_(\d{4})', 1))"

# dataset -> (part of the file name, fields in file order)
DATASETS = {
    "origination": ("orig", ORIGINATION_FIELDS),
    "performance": ("perf", PERFORMANCE_FIELDS),
}


def dataset_glob(raw_dir: str, dataset: str) -> str:
    return f"{raw_dir}/sample_*/sample_{DATASETS[dataset][0]}_*.txt"


def _layout(fields: list[str]) -> str:
    return ", ".join(f"{name} string" for name in [*fields, _MALFORMED])


def scan(
    spark: SparkSession, raw_dir: str, dataset: str, multi_line: list[str] | None = None
) -> DataFrame:
    """All rows of a dataset as text; any action fails on a malformed record.

    Empty lines hold no row and are skipped; the raw profile reports them. ``multi_line`` names
    the files with quoted line feeds; None finds them, which reads the files once.
    """
    fields, path = DATASETS[dataset][1], dataset_glob(raw_dir, dataset)
    if multi_line is None:
        multi_line = files_with_open_lines(spark, path)
    source_file = F.col("_metadata.file_path").alias("source_file")
    rows = spark.read.schema(_layout(fields)).options(**_FORMAT).csv(path).select("*", source_file)
    if multi_line:
        records = multi_line_records(split_lines(spark, multi_line)).filter("value <> ''")
        parsed = F.from_csv("value", _layout(fields), _OPTIONS).alias("record")
        others = records.select(parsed, "source_file").select("record.*", "source_file")
        rows = rows.filter(~F.col("source_file").isin(multi_line)).unionByName(others)
    # Naming the loan also makes the test refer to a data column, without which
    # Spark refuses to read the malformed marker (as in a bare count).
    loan = F.coalesce("loan_id", F.lit("unknown"))
    problem = F.concat(
        F.lit(f"wrong field count in {dataset} file "), "source_file", F.lit(", loan "), loan
    )
    well_formed = F.when(F.col(_MALFORMED).isNotNull(), F.raise_error(problem)).otherwise(True)
    return rows.filter(well_formed).selectExpr(
        f"{_SOURCE_YEAR} AS source_year", "source_file", *fields
    )


def scan_lines(spark: SparkSession, path: str, multi_line: list[str] | None = None) -> DataFrame:
    """Records of the matching files as text, with the file path and the year in it.

    ``multi_line`` as in :func:`scan`.
    """
    if multi_line is None:
        multi_line = files_with_open_lines(spark, path)
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("source_file"))
    if multi_line:
        records = multi_line_records(split_lines(spark, multi_line))
        lines = lines.filter(~F.col("source_file").isin(multi_line)).unionByName(records)
    return lines.selectExpr("*", f"{_SOURCE_YEAR} AS source_year")


def split_fields(lines: DataFrame, fields: list[str]) -> DataFrame:
    """Add one text column per field and ``is_malformed`` (wrong field count)."""
    record = lines.withColumn("record", F.from_csv("value", _layout(fields), _OPTIONS))
    return record.selectExpr(
        *lines.columns,
        f"record.{_MALFORMED} IS NOT NULL OR value = '' AS is_malformed",
        *(f"record.{name} AS {name}" for name in fields),
    )


def scan_origination(spark: SparkSession, raw_dir: str) -> DataFrame:
    return scan(spark, raw_dir, "origination")


def scan_performance(spark: SparkSession, raw_dir: str) -> DataFrame:
    return scan(spark, raw_dir, "performance")


def expected_file(raw_dir: str, dataset: str, year: int) -> str:
    return f"{raw_dir}/sample_{year}/sample_{DATASETS[dataset][0]}_{year}.txt"


def expected_files(raw_dir: str, years: Iterable[int] = VINTAGES) -> list[str]:
    return [expected_file(raw_dir, dataset, year) for year in years for dataset in DATASETS]


def require_files(spark: SparkSession, raw_dir: str, years: Iterable[int] = VINTAGES) -> None:
    """Raise one error that lists every expected file that is absent."""

    def present(path: str) -> bool:
        try:
            spark.read.text(path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return False
            raise
        return True

    missing = [path for path in expected_files(raw_dir, years) if not present(path)]
    if missing:
        raise FileNotFoundError("Missing source files:\n- " + "\n- ".join(missing))


def as_lines(rows: DataFrame, fields: list[str]) -> DataFrame:
    """Add ``value``: the text fields in file order as one unquoted line."""
    line = F.concat_ws("|", *(F.coalesce(F.col(name), F.lit("")) for name in fields))
    return rows.withColumn("value", line)
