"""Price sheet file source (S01-S03) and table sinks.

The reference bulk-loads a tab-separated file (header row skipped, any bad
row aborts the load) into a landing table it truncates first. Here the lines
are parsed with an explicit positional schema in FAILFAST mode, or, where some
bad rows are to be put up with, into the good rows and a report that names each bad one by
file, line and reason. Landing and published tables are written to a fresh folder and read back, so no job ever
overwrites the files it is reading.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillprice.session import materialize, scratch_path, shuffles_freed

# Column order of the price sheet file (the load is positional). Prices keep the
# decimals of the sheet: only CalcPrice rounds them, by its own casts.
PRICE_SHEET_SCHEMA = T.StructType([
    T.StructField("xmfg", T.StringType()),
    T.StructField("Cust_Part_Number", T.StringType()),
    T.StructField("Gross_Price", T.DecimalType(18, 6)),
    T.StructField("POP_Code", T.StringType()),
    T.StructField("Change_Code", T.StringType()),
    T.StructField("Core_Price", T.DecimalType(18, 6)),
    T.StructField("Price_Sheet_Number", T.StringType()),
    T.StructField("Effective_Date", T.DateType()),
])

_TSV = {"sep": "\t", "header": "true", "quote": "", "escape": "",
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
_CSV = {"sep": "\t", "quote": "", "escape": "",
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
#: Bad lines that the message of a rejected load names; its report names all.
SHOWN = 100


def read_price_sheet(spark: SparkSession, path: str,
                     schema: T.StructType = PRICE_SHEET_SCHEMA) -> DataFrame:
    """Tab-separated, first row skipped, quotes literal, abort on a bad row.

    ``path`` is a file, or a folder that holds one sheet in several files. The
    header is the first line of its first file (by name) and is skipped wherever
    it stands, so files with and without a header of their own both load whole.
    Every field of a row is parsed whatever columns are read, so a bad one
    always fails, and so does a price that its column would round. CRLF and LF line ends both parse; an empty field is NULL.
    Splits of a large file are read in parallel by the executors.
    """
    rows = _without_header(spark.read.text(path))
    fields = _parsed_fields(schema)
    parsed = rows.filter(F.length("value") > 0).select(
        F.from_csv("value", _ddl(schema), _CSV | {"mode": "FAILFAST"}).alias("row"))
    # A condition on the whole row: column pruning cannot leave a field unparsed.
    row = F.struct(*[_exact(F.col(f"row.{f.name}"), f) if f.name in fields else F.col(f"row.{f.name}")
                     for f in schema.fields])
    return parsed.select(row.alias("row")).filter(F.hash("row") >= F.lit(-(1 << 31))).select("row.*")


class PriceSheetRejected(ValueError):
    """More bad lines than a load puts up with; ``report`` has them all, as ``load_price_sheet`` returns them."""

    def __init__(self, message: str, report: DataFrame):
        super().__init__(message)
        self.report = report


def load_price_sheet(spark: SparkSession, path: str, max_errors: int = 0,
                     schema: T.StructType = PRICE_SHEET_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """S01 with MAXERRORS: the good rows, and a report (file, line, reason, value) of the bad ones.

    Rows are good exactly if ``read_price_sheet`` would load them. With more than
    ``max_errors`` bad lines it raises ``PriceSheetRejected`` after the whole sheet was read, so
    one attempt names every bad line: the message the first ``SHOWN``, the stored report
    all. ``line`` counts from 1 in its file, header and empty lines included.

    Lines are numbered without a global order: each task numbers those of its file block, and
    a sum over the blocks (one row each) gives the lines before it.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"))
    blocks = lines.groupBy("file", "block").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("lines"))
    before = F.sum("lines").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.withColumn("before", F.coalesce(before, F.lit(0))).drop("lines")

    checked = _checked(lines, schema)
    good = checked.filter(F.col("reason").isNull()).select("row.*")
    bad = checked.filter(F.col("reason").isNotNull())
    report = materialize(
        bad.join(blocks, ["file", "block"])
           .select("file", (F.col("id") - F.col("first") + F.col("before") + 1).alias("line"), "reason", "value"),
        "price-sheet-rejects")
    found = report.count()
    if found > max_errors:
        first = report.orderBy("file", "line").limit(SHOWN).collect()
        names = "\n".join(f"{r['file']}, line {r['line']}: {r['reason']}" for r in first)
        more = f"\nand {found - SHOWN} more" if found > SHOWN else ""
        raise PriceSheetRejected(f"{found} bad lines in the price sheet, {max_errors} allowed\n{names}{more}", report)
    return good, report


def _without_header(lines: DataFrame) -> DataFrame:
    """The lines that are not the header (the first line of the first file by name)."""
    files = sorted(lines.inputFiles())
    header = lines.sparkSession.read.text(files[0]).first() if files else None
    return lines.filter(F.col("value") != header["value"]) if header else lines


def _checked(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Lines but header and empty ones, with the parsed ``row`` and the ``reason`` why it is bad (NULL: it is good)."""
    rows = _without_header(lines)
    fields = _parsed_fields(schema)
    corrupt = "__corrupt"
    row = F.from_csv("value", f"{_ddl(schema)}, {corrupt} string",
                     _CSV | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    parsed = rows.filter(F.length("value") > 0).withColumn("row", row)
    # Each field of another type is tried again by itself, to name it where the row as a whole did not parse.
    tokens = F.split("value", "\t")
    width = len(schema.fields)
    reasons = [F.when(F.size(tokens) != width,
                      F.concat(F.size(tokens).cast("string"), F.lit(f" fields instead of {width}")))]
    for i, f in enumerate(schema.fields):
        token = F.when(F.length(F.get(tokens, F.lit(i))) > 0, F.get(tokens, F.lit(i)))
        if f.name in fields:
            reasons.append(F.when(token.isNotNull() & ~_lossless(token, f.dataType), F.lit(_message(f))))
        elif not isinstance(f.dataType, T.StringType):
            one = F.from_csv(token, f"{f.name} {f.dataType.simpleString()}", _CSV)[f.name]
            reasons.append(F.when(token.isNotNull() & one.isNull(), F.lit(_message(f))))
    told = F.concat_ws("; ", *reasons)
    unparsed = F.col(f"row.{corrupt}").isNotNull()
    reason = F.when(told != "", told).when(unparsed, F.lit("no row of the price sheet"))
    value = F.struct(*[(F.col(f"row.{f.name}").try_cast(f.dataType) if f.name in fields else F.col(f"row.{f.name}"))
                       .alias(f.name) for f in schema.fields])
    return parsed.select(*lines.columns, value.alias("row"), reason.alias("reason"))


def _parsed_fields(schema: T.StructType) -> set[str]:
    """Decimals are read as text first: one that its column cannot hold exactly is a bad field, not a rounded one."""
    return {f.name for f in schema.fields if isinstance(f.dataType, T.DecimalType)}


def _ddl(schema: T.StructType) -> str:
    fields = _parsed_fields(schema)
    return ", ".join(f"{f.name} {'string' if f.name in fields else f.dataType.simpleString()}" for f in schema.fields)


def _lossless(value: Column, kind: T.DecimalType) -> Column:
    """Whether a text is a number that the type holds exactly."""
    return (value.try_cast(kind).isNotNull() & ~value.rlike("[eE]")
            & ~value.rlike(rf"\.[0-9]{{{kind.scale}}}[0-9]*[1-9]"))


def _message(field: T.StructField) -> str:
    return f"{field.name} of the price sheet is no {field.dataType.simpleString()}"


def _exact(value: Column, field: T.StructField) -> Column:
    """A decimal field of the sheet; fails on text that is no number or that the type would round."""
    kind = field.dataType
    bad = F.raise_error(F.concat(F.lit(f"{_message(field)}: "), value)).cast(kind)
    return F.when(value.isNull() | _lossless(value, kind), value.try_cast(kind)).otherwise(bad).alias(field.name)


def write_price_sheet(df: DataFrame, path: str) -> str:
    """Write rows in the price-sheet file layout (used to stage test files)."""
    df.select(*[f.name for f in PRICE_SHEET_SCHEMA.fields]).write.options(**_TSV) \
      .mode("errorifexists").csv(path)
    return path


def publish(df: DataFrame, path: str | None = None, name: str = "table") -> DataFrame:
    """Replace a table by writing a new version and reading it back.

    Writing to a new folder makes the swap atomic for readers of the old
    version and never overwrites the input of the job being run.
    """
    target = path or scratch_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.mode("errorifexists").parquet(target)
    return df.sparkSession.read.parquet(target)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table folder exists, in whatever file system the path names."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def append(df: DataFrame, path: str) -> DataFrame:
    """INSERT INTO ... SELECT as an append to a parquet table folder."""
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.parquet(path)
