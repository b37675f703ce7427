"""CSV files to bronze tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import check_on_error
from ..functions.together import run_together
from .csv_records import read_records
from .tables import create_layers, layer, overwrite_table

# Spellings read as NULL.
NA_SPELLINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


@dataclass(frozen=True)
class CsvFile:
    """A file and the columns that are not text. Only files with free text may hold line breaks inside quotes; those are
    gone over once more to find where records end."""

    name: str
    types: Mapping[str, str] = field(default_factory=dict)
    line_breaks: bool = False


# The file of each bronze table.
CSV_FILES = {
    "raw_orders": CsvFile("olist_orders_dataset.csv"),
    "raw_customers": CsvFile("olist_customers_dataset.csv", {"customer_zip_code_prefix": "int"}),
    "raw_order_items": CsvFile(
        "olist_order_items_dataset.csv", {"order_item_id": "int", "price": "double", "freight_value": "double"}
    ),
    "raw_products": CsvFile(
        "olist_products_dataset.csv",
        {
            "product_weight_g": "double",
            "product_length_cm": "double",
            "product_height_cm": "double",
            "product_width_cm": "double",
        },
    ),
    "raw_reviews": CsvFile("olist_order_reviews_dataset.csv", {"review_score": "int"}, line_breaks=True),
    "raw_payments": CsvFile("olist_order_payments_dataset.csv", {"payment_sequential": "int", "payment_value": "double"}),
}


_LINE = "_whole_line"
_FIRST = "_first_record"


def _checked_lines(spark: SparkSession, path: str, line_breaks: bool, on_error: str = "fail") -> tuple[DataFrame, list[str]]:
    """All lines as text by the header, with the whole line in ``_LINE`` where it has a wrong number of fields.

    Every file must carry the columns of the first header, in its order; another header is an error.
    """
    options = {"header": True, "quote": '"', "escape": '"'}
    names = spark.read.csv(path, inferSchema=False, multiLine=line_breaks, **options).columns
    schema = ", ".join(f"`{name.replace('`', '``')}` STRING" for name in [*names, _LINE])
    if line_breaks and names:
        records = read_records(spark, path, "fail" if on_error == "fail" else "cut")
        fields = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _LINE}
        # a generator parses each record once; filters over a projection would be pushed below it and parse again
        read = records.select(F.col("first").alias(_FIRST), F.inline(F.array(F.from_csv("record", F.lit(schema), fields))))
        found = F.array(*[F.col(f"`{name}`") for name in names])
        other = F.concat(F.lit("CSV header is not that of the first file: "), F.array_join(found, ","))
        is_header = F.when(F.col(_FIRST) & (found != F.array(*map(F.lit, names))), F.raise_error(other).cast("boolean"))
        # the outcome of the check is part of the filter, so that no plan leaves it out
        return read.where(~F.coalesce(is_header, F.col(_FIRST))).drop(_FIRST), names
    # with pruned columns the reader would not count the fields of a line
    lines = spark.read.option("columnPruning", False).csv(
        path, schema=schema, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=_LINE, multiLine=line_breaks, **options
    )
    return lines, names


def _surplus(names: list[str]) -> Column:
    """A line with more fields than the header. Only malformed lines are looked at: their commas outside quotes tell."""
    bare = F.regexp_replace(_LINE, '"(?:[^"]|"")*"', "")
    return F.col(_LINE).isNotNull() & (F.length(bare) - F.length(F.replace(bare, F.lit(","))) >= len(names))


def csv_rejects(spark: SparkSession, path: str, line_breaks: bool = True) -> DataFrame:
    """The lines ``read_csv`` refuses, as ``line``."""
    lines, names = _checked_lines(spark, path, line_breaks, "null")
    # a scan must name another column besides the malformed line, so the first one is asked for what does not matter
    line = F.when(F.col(f"`{names[0]}`").isNull(), F.concat(_LINE, F.lit(""))).otherwise(F.col(_LINE))
    return lines.where(_surplus(names)).select(line.alias("line"))


def read_csv(
    spark: SparkSession,
    path: str,
    types: Mapping[str, str] | None = None,
    line_breaks: bool = True,
    on_error: str = "fail",
) -> DataFrame:
    """Read a CSV file or folder with a header, columns by name, without an inference pass over the data.

    Quotes are doubled inside quoted text. NA spellings become NULL in every column, as do fields a short line lacks. A
    line with more fields than the header raises; with ``on_error="null"`` it is left out and ``csv_rejects`` lists it.
    With ``line_breaks`` quoted fields may hold them, large files are still read in many tasks (``csv_records``), and a field
    open at the end of a file raises too; under ``"null"`` its record is cut.
    """
    check_on_error(on_error)
    raw, names = _checked_lines(spark, path, line_breaks, on_error)
    refused = _surplus(names)
    if on_error == "fail":
        message = F.concat(F.lit("CSV line with more fields than the header: "), F.left(_LINE, F.lit(200)))
        refused = F.when(refused, F.raise_error(message).cast("boolean")).otherwise(F.lit(False))
    raw = raw.where(~refused)
    types = types or {}

    def column(name: str):
        text = F.col(f"`{name}`")
        value = F.when(~text.isin(*NA_SPELLINGS), text)
        return (value.cast(types[name]) if name in types else value).alias(name)

    return raw.select(*[column(c) for c in names])


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def load_csv(spark: SparkSession, path: str, table: str, types: Mapping[str, str] | None = None, line_breaks: bool = True) -> int:
    """Replace a bronze table by the file and return its rows, counted in the written table."""
    create_layers(spark)
    name = layer("bronze", table)
    overwrite_table(read_csv(spark, path, types, line_breaks), name)
    return spark.table(name).count()


def load_all_csv(spark: SparkSession, folder: str, files: Mapping[str, CsvFile] = CSV_FILES) -> dict[str, int | None]:
    """Load every file that exists, several at once: rows per table, None for a missing file. An error comes when the others are done."""
    create_layers(spark)

    def load(table: str, file: CsvFile) -> int | None:
        path = f"{folder.rstrip('/')}/{file.name}"
        return load_csv(spark, path, table, file.types, file.line_breaks) if path_exists(spark, path) else None

    return dict(zip(files, run_together(spark, [partial(load, table, file) for table, file in files.items()])))


def total_rows(rows: Mapping[str, int | None]) -> int:
    return sum(n or 0 for n in rows.values())
