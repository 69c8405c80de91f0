"""CSV corpus I/O.

Reading follows pandas' defaults where they matter for the data: a header
row, RFC-4180 quoting with doubled quotes, quoted newlines, a leading BOM
tolerated, and pandas' missing-value tokens read as null.  Writing never
overwrites a path being read: every write goes to a fresh path (the output
committer makes it atomic).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusforge import schema
from corpusforge.session import scratch_path

_CSV_OPTS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8",
}


def na_to_null(df: DataFrame, cols: Sequence[str] | None = None, tokens: Sequence[str] = schema.NA_TOKENS) -> DataFrame:
    """pandas' missing-value tokens become null in string columns."""
    str_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    cols = [c for c in (cols or str_cols) if c in str_cols]
    toks = list(tokens)
    for c in cols:
        df = df.withColumn(c, F.when(F.col(c).isin(toks), F.lit(None).cast("string")).otherwise(F.col(c)))
    return df


def read_corpus_csv(spark: SparkSession, path: str, schema_: T.StructType | str | None = None,
                    quoted_newlines: bool = True) -> DataFrame:
    """CSV corpus scan.  With ``schema_=None`` every column is read as
    string (no inference pass over the data).  With a schema, the header's
    columns are taken by name and cast; a column the header lacks is null and
    further ones are left out.  ``quoted_newlines=False`` promises that no
    field holds a line break: one large file is then read by many tasks."""
    df = na_to_null(spark.read.options(**_CSV_OPTS, multiLine=str(quoted_newlines).lower()).csv(path))
    if schema_ is None:
        return df
    fields = (T.StructType.fromDDL(schema_) if isinstance(schema_, str) else schema_).fields
    return df.select(*[
        (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields
    ])


def read_tolerant(spark: SparkSession, path: str, schema_: T.StructType | str) -> DataFrame:
    """On a missing/unreadable path return an empty frame and carry on."""
    from pyspark.errors import AnalysisException

    try:
        df = read_corpus_csv(spark, path, schema_)
        df.schema  # resolves the path now
        return df
    except AnalysisException:
        return spark.createDataFrame([], schema_)


def read_rows_tolerant(spark: SparkSession, path: str, schema_: T.StructType | str, quoted_newlines: bool = False) -> tuple[DataFrame, DataFrame]:
    """S2/S3 row by row: (good rows, rejects (line, reason)).

    A row with too few or too many fields, or with a value that its column's
    type can't hold, is a reject; a file that breaks off (say, a truncated
    archive) gives its rows up to there, a file that is gone by the time it is
    read none, and a path that never was gives two empty frames.  The header of
    the first file names the columns, as in ``read_corpus_csv``."""
    from pyspark.errors import AnalysisException

    struct = T.StructType.fromDDL(schema_) if isinstance(schema_, str) else schema_
    reader = spark.read.options(**_CSV_OPTS, multiLine=str(quoted_newlines).lower(), ignoreCorruptFiles="true", ignoreMissingFiles="true")
    try:
        names = reader.csv(path).columns
    except AnalysisException:
        return spark.createDataFrame([], struct), spark.createDataFrame([], "line string, reason string")
    raw = T.StructType([*(T.StructField(n, T.StringType()) for n in names), T.StructField("_line", T.StringType())])
    # without pruning, so that the number of fields is looked at whatever is asked for
    rows = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord="_line", columnPruning="false").schema(raw).csv(path)
    rows = na_to_null(rows, names)
    reason = F.when(F.col("_line").isNotNull(), "fields")
    for f in struct.fields:
        if f.name in names:
            value = F.col(f"`{f.name}`")
            reason = reason.when(value.isNotNull() & value.try_cast(f.dataType).isNull(), f.name)
    rows = rows.withColumn("_reason", reason)
    good = rows.filter("_reason is null").select(*[
        (F.col(f"`{f.name}`") if f.name in names else F.lit(None)).try_cast(f.dataType).alias(f.name) for f in struct.fields
    ])
    line = F.coalesce(F.col("_line"), F.concat_ws(",", *(F.coalesce(F.col(f"`{n}`"), F.lit("")) for n in names)))
    return good, rows.filter("_reason is not null").select(line.alias("line"), F.col("_reason").alias("reason"))


def read_with_report(spark: SparkSession, path: str, schema_: T.StructType | str) -> tuple[DataFrame, dict]:
    """S3: read, and report row count and the label values (A3) with their
    number, or a message.  A corpus has a handful of labels."""
    df = read_tolerant(spark, path, schema_)
    rep: dict = {"rows": df.count()}
    if "label" in df.columns:
        rep["labels"] = sorted(r[0] for r in df.select("label").distinct().collect() if r[0] is not None)
        rep["n_labels"] = len(rep["labels"])
    else:
        rep["message"] = "no label column"
    return df, rep


def write_corpus_csv(df: DataFrame, path: str | None = None, spark: SparkSession | None = None) -> str:
    """Write with a header to a fresh path (never the input's).

    Spark writes no BOM (documented difference).  Returns the path."""
    spark = spark or df.sparkSession
    path = path or scratch_path(spark, "csv")
    df.write.mode("errorifexists").options(**_CSV_OPTS).csv(path)
    return path
