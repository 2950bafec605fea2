"""Uploaded lists (country codes, team roles, upsells, curves) read from CSV with declared schemas.

The reports' small reference lists are maintained by hand and uploaded as CSV
files.  ``read_upload`` is strict: a wrong value fails the read instead of
silently turning into NULL.  ``check_upload`` sets bad rows aside with their
line and the reason, and gives the others.

A landing folder holds the uploads as they came, one folder per list and day:
``<landing>/<list>/<yyyy-mm-dd>/*.csv``.  ``latest_upload`` finds the one that
counts for a report date.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType, StructField, StructType

SCHEMAS = {
    "country_codes": "nation_key int, country_code string, sfdc_country_name string, sales_region string",
    "team_role": "sales_owner string, role string, team string",
    "upsells": "sales_merchant_id bigint, effective_activation_date date, pct_share_of_npv decimal(5,4), include int",
    "backlog_curve": "days_since_activation int, first_year_sold_pct double, first_year_sold_cumulative_pct double",
    "pipeline_curve": "day_count int, first_year_sold_pct double",
}
# columns that must have a value; the first one names the row and must not repeat, but for upsells
REQUIRED = {
    "country_codes": ("country_code", "sfdc_country_name", "sales_region"),
    "team_role": ("sales_owner", "role"),
    "upsells": ("sales_merchant_id", "effective_activation_date", "pct_share_of_npv", "include"),
    "backlog_curve": ("days_since_activation", "first_year_sold_pct", "first_year_sold_cumulative_pct"),
    "pipeline_curve": ("day_count", "first_year_sold_pct"),
}
REPEATING = ("upsells",)
# (list, column, least, most) of columns that are shares
SHARES = {"upsells": ("pct_share_of_npv",), "backlog_curve": ("first_year_sold_pct", "first_year_sold_cumulative_pct"),
          "pipeline_curve": ("first_year_sold_pct",)}
# header row; NULL written as \N and empty strings as "" so both survive a round trip
CSV_WRITE = {"header": True, "nullValue": "\\N"}
CSV_READ = {"header": True, "nullValue": "\\N", "emptyValue": "", "mode": "FAILFAST"}
LINE_READ = {"nullValue": "\\N", "emptyValue": "", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}


class UploadError(ValueError):
    pass


def read_upload(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Read an uploaded list with its declared schema.

    Malformed rows fail the read, and so do decimals with more digits than
    their column holds: nothing is rounded silently.
    """
    declared = declared_schema(spark, name)
    exact = {f.name: f.dataType for f in declared if isinstance(f.dataType, DecimalType)}
    wide = StructType([StructField(f.name, DecimalType(38, 18) if f.name in exact else f.dataType) for f in declared])
    rows = spark.read.schema(wide).options(**CSV_READ).csv(path)
    for c, kind in exact.items():
        kept = F.col(c).try_cast(kind)
        wrong = F.raise_error(F.concat(F.lit(f"{name}.{c}: {kind.simpleString()} does not hold "), F.col(c).cast("string")))
        rows = rows.withColumn(c, F.when(F.col(c).isNull() | kept.eqNullSafe(F.col(c)), kept).otherwise(wrong.cast(kind)))
    return rows


def write_upload(df: DataFrame, path: str, name: str) -> None:
    """Write a list in the upload format (used to produce upload files from existing tables)."""
    cols = [c.split()[0] for c in SCHEMAS[name].split(", ")]
    df.select(*cols).coalesce(1).write.mode("overwrite").options(**CSV_WRITE).csv(path)


def declared_schema(spark: SparkSession, name: str) -> StructType:
    """Columns and types of a list."""
    return spark.createDataFrame([], SCHEMAS[name]).schema


def upload_dates(spark: SparkSession, landing: str, name: str) -> list[dt.date]:
    """Days on which the list was uploaded, oldest first; folders of other names are passed over."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{landing.rstrip('/')}/{name}")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    out = []
    for status in fs.listStatus(folder) if fs.exists(folder) else []:
        try:
            out.append(dt.date.fromisoformat(status.getPath().getName()))
        except ValueError:
            continue
    return sorted(out)


def latest_upload(spark: SparkSession, landing: str, name: str, as_of: dt.date) -> tuple[dt.date, str]:
    """(day, folder) of the latest upload of a list on or before ``as_of``; without one it raises."""
    days = [d for d in upload_dates(spark, landing, name) if d <= as_of]
    if not days:
        raise UploadError(f"{landing}: no upload of {name} on or before {as_of}")
    return days[-1], f"{landing.rstrip('/')}/{name}/{days[-1].isoformat()}"


def _problem(name: str, field: StructField, raw: Column) -> Column:
    """What is wrong with the text of one field, or NULL."""
    kind, label = field.dataType, F.lit(f"{field.name}: ")
    tests = []
    if field.name in REQUIRED[name]:
        tests.append((raw.isNull() | (F.trim(raw) == ""), F.lit(f"{field.name} is empty")))
    if not isinstance(kind, StringType):
        read = raw.try_cast(kind)
        tests.append((raw.isNotNull() & read.isNull(), F.concat(label, F.lit("'"), raw, F.lit(f"' is no {kind.simpleString()}"))))
        if isinstance(kind, DecimalType):
            tests.append((~read.eqNullSafe(raw.try_cast(DecimalType(38, 18))), F.concat(label, raw, F.lit(f" has more digits than {kind.simpleString()}"))))
        if field.name in SHARES.get(name, ()):
            tests.append(((read < 0) | (read > 1), F.concat(label, raw, F.lit(" is not within 0 and 1"))))
    out = F.lit(None).cast("string")
    for failed, reason in reversed(tests):
        out = F.when(failed, reason).otherwise(out)
    return out


def check_upload(spark: SparkSession, path: str, name: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected) of an upload: typed rows of the declared columns, and what was set aside.

    ``rejected`` has the list, the file, the line (from 1, the header), the
    record as it stands there and the first reason: a wrong number of fields, an
    empty field that is needed, a text that is not of the column's type or has
    more digits than it holds, a share outside 0..1, a name that an earlier line
    has.  The header names the columns, in any order; a missing one fails the
    upload, further ones are passed over, and so are blank lines.  A record is one
    line.  Lists are small: a file is read as one row to number its lines.
    """
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    lines = text.select("file", F.posexplode(F.split("value", r"\r?\n")).alias("line", "record")).select("file", F.col("line") + 1, "record").toDF("file", "line", "record")
    heads = [r["record"] for r in lines.filter("line = 1").select("record").distinct().limit(2).collect()]
    if len(heads) != 1:
        raise UploadError(f"{path}: {len(heads)} different headers, not one")
    header = [h.strip().strip('"').lower() for h in heads[0].split(",")]
    declared = declared_schema(spark, name)
    missing = [f.name for f in declared if f.name not in header]
    if missing or len(set(header)) < len(header):
        raise UploadError(f"{path}: the header {header} lacks {missing}" if missing else f"{path}: the header {header} repeats a column")
    fields = ", ".join(f"`{h}` string" for h in header) + ", _corrupt string"
    body = lines.filter((F.col("line") > 1) & (F.trim("record") != "")).select("*", F.from_csv("record", F.lit(fields), LINE_READ).alias("f"))
    problems = [_problem(name, f, F.col(f"f.{f.name}")) for f in declared]
    reason = F.when(F.col("f._corrupt").isNotNull(), F.lit(f"not {len(header)} fields")).otherwise(F.coalesce(*problems))
    judged = body.select("file", "line", "record", reason.alias("reason"), *[F.col(f"f.{f.name}").alias(f.name) for f in declared])
    if name not in REPEATING:
        key = REQUIRED[name][0]
        first = F.min(F.when(F.col("reason").isNull(), F.struct("file", "line"))).over(Window.partitionBy(key))
        again = F.col("reason").isNull() & (F.struct("file", "line") > F.col("_first"))
        judged = judged.select("*", first.alias("_first")).withColumn(
            "reason", F.when(again, F.concat(F.lit(f"{key}: "), F.col(key), F.lit(" stands in line "), F.col("_first.line").cast("string"), F.lit(" already"))).otherwise(F.col("reason")))
    good = judged.filter(F.col("reason").isNull()).select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in declared])
    bad = judged.filter(F.col("reason").isNotNull()).select(F.lit(name).alias("list"), "file", "line", "record", "reason")
    return good, bad


def write_lines(df: DataFrame, path: str, name: str, further: tuple[str, ...] = ()) -> None:
    """Write a list as one CSV file as a person would upload it, with ``further`` lines as they are at its end."""
    cols = [c.split()[0] for c in SCHEMAS[name].split(", ")]
    spark = df.sparkSession
    rows = df.select(F.lit(1).alias("part"), F.to_csv(F.struct(*cols), {"nullValue": "\\N"}).alias("value"))
    ends = spark.createDataFrame([(0, ",".join(cols)), *[(2 + i, line) for i, line in enumerate(further)]], "part int, value string")
    rows.unionByName(ends).repartition(1).sortWithinPartitions("part").select("value").write.mode("overwrite").text(path)
