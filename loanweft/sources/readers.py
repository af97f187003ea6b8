"""Tables in: raw CSV once, Parquet from then on."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanweft.functions.checks import DataCheckError, enforce, duplicate_values, require_columns, union_violations, violations
from loanweft.functions.text import strip
from loanweft.session import materialize

# The texts pandas.read_csv takes as missing. Case matters.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _typed(name: str, kind: T.DataType, tokens: Sequence[str]):
    text = F.when(~F.col(f"`{name}`").isin(*tokens), F.col(f"`{name}`"))
    return text.try_cast(kind).alias(name)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Floating columns with NaN turned into NULL, so that missing has one meaning."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = F.when(~F.isnan(column), column).alias(field.name)
        columns.append(column)
    return df.select(*columns)


def _raw_text(spark: SparkSession, path: str, line_breaks: bool) -> DataFrame:
    return (spark.read.option("header", True).option("escape", '"').option("multiLine", line_breaks)
            .option("maxCharsPerColumn", -1).csv(path))


LINE = "file string, block bigint, kind int, line bigint, value string"
INSIDE, HEAD, TAIL = 0, 1, 2  # a whole record; what a block begins with and ends with of a record that lies in several


def _records(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, line, value): the records of plain CSV files, whose quoted cells may hold line breaks, by many tasks a file.

    A record ends at a line break before which the quotes are even. Each task
    counts the quotes of its byte range; a running sum over a file's ranges, a
    number each, tells whether a range begins inside quotes. Then each task puts
    its lines together, and only the records that cross ranges are moved.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    per_block = materialize(lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd")), "quotes")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = per_block.select("file", "block", (F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2 == 1).alias("inside"))
    # one row for a byte range of, usually, 128 MB; a shuffle would lose the lines' order
    known = lines.join(F.broadcast(begins), ["file", "block"])

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, inside, open_, first, line = None, False, [], False, 0

        def ended(last: bool) -> tuple | None:
            """The lines held, if they end a record or the block does."""
            if not open_ or (inside and not last):
                return None
            kind = HEAD if first else TAIL if inside else INSIDE
            return (*at, kind, line, "\n".join(open_))

        for batch in batches:
            rows = []
            for file, block, value, begun in zip(*(batch.column(name).to_pylist() for name in ("file", "block", "value", "inside"))):
                if (file, block) != at:
                    rows += [row] if (row := ended(True)) else []
                    at, inside, open_, first, line = (file, block), begun, [], begun, 0
                open_.append(value)
                inside ^= value.count('"') % 2 == 1
                if row := ended(False):
                    rows.append(row)
                    open_, first, line = [], False, line + 1
            if rows:
                yield record_batch(rows)
        if row := ended(True) if at else None:
            yield record_batch([row])

    def record_batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[c.split()[0] for c in LINE.split(", ")])

    pieces = materialize(known.select("file", "block", "value", "inside").mapInArrow(put_together, LINE), "records")
    whole = pieces.where(F.col("kind") == INSIDE).select("file", "block", "line", "value")
    # a tail begins a record; the heads up to the next tail go on with it
    order = Window.partitionBy("file").orderBy("block", "line")
    crossing = pieces.where(F.col("kind") != INSIDE).withColumn("record", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    listed = F.array_sort(F.collect_list(F.struct("block", "line", "value")))
    joined = crossing.groupBy("file", "record").agg(listed.alias("parts")).select(
        "file", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["line"].alias("line"),
        F.array_join(F.transform("parts", lambda part: part["value"]), "\n").alias("value"))
    return whole.unionByName(joined)


def _split_text(spark: SparkSession, path: str) -> DataFrame:
    """The cells of plain CSV files as text, each file read by many tasks."""
    names = _raw_text(spark, path, True).columns
    records = _records(spark, path).where(~((F.col("block") == 0) & (F.col("line") == 0)))  # without the headers
    cells = F.from_csv(F.regexp_replace("value", "\r$", ""), F.lit(_ddl(names)),
                       {"escape": '"', "maxCharsPerColumn": "-1", "multiLine": "true", "mode": "PERMISSIVE"})
    return records.where(F.length("value") > 0).select(cells.alias("c")).select(*[F.col("c").getField(name).alias(name) for name in names])


def _ddl(names: Sequence[str]) -> str:
    return ", ".join(f"`{name.replace('`', '``')}` string" for name in names)


def read_raw_loans(spark: SparkSession, path: str, schema: T.StructType | None = None, limit: int | None = None,
                   missing_tokens: Sequence[str] = MISSING_TOKENS, line_breaks: bool = True, split_files: bool = False) -> DataFrame:
    """S1, S2. Loan-level CSV, plain or gzip, one file or a folder.

    Values are read as text, missing tokens become NULL and the rest is cast to
    ``schema`` (all text without one); ``unreadable_values`` lists what the cast
    turned into NULL. Quoted cells may hold line breaks, quotes are doubled; a
    file is then one task, as a gzip file always is. With ``split_files`` a large
    plain file is many tasks all the same; its text is then scanned twice.
    Without ``line_breaks`` plain files are split at every line break.
    """
    raw = _split_text(spark, path) if split_files else _raw_text(spark, path, line_breaks)
    if schema is None:
        schema = T.StructType([T.StructField(name, T.StringType()) for name in raw.columns])
    require_columns(raw, schema.fieldNames(), "raw file")
    typed = raw.select(*[_typed(field.name, field.dataType, missing_tokens) for field in schema.fields])
    typed = nan_to_null(typed)
    return typed if limit is None else typed.limit(limit)


def unreadable_values(spark: SparkSession, path: str, schema: T.StructType, missing_tokens: Sequence[str] = MISSING_TOKENS,
                      line_breaks: bool = True) -> DataFrame:
    """S1. (column_name, value, row_count) of cells of a raw CSV that are neither missing nor readable as ``schema`` says."""
    raw = _raw_text(spark, path, line_breaks)
    require_columns(raw, schema.fieldNames(), "raw file")
    cells = [F.struct(F.lit(field.name).alias("column_name"), F.when(
        ~F.col(f"`{field.name}`").isin(*missing_tokens) & F.col(f"`{field.name}`").try_cast(field.dataType).isNull(),
        F.col(f"`{field.name}`")).alias("value")) for field in schema.fields if not isinstance(field.dataType, T.StringType)]
    if not cells:
        return spark.createDataFrame([], "column_name string, value string, row_count bigint")
    listed = raw.select(F.inline(F.array(*cells))).where(F.col("value").isNotNull())
    return listed.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("row_count"))


def part_violations(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A1. (file, rule, offender): where the headers of a raw CSV's files differ from ``columns``, by default from the header of most files.

    Rules: absent_column, extra_column, repeated_column, and moved_column where
    a file has the same columns in another order. Run it before the parts are
    read as one table, which takes every file to have the first one's columns.
    """
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("line"))
    first = lines.groupBy(F.col("file_path").alias("file")).agg(F.min_by("value", F.struct("file_block_start", "line")).alias("header"))
    names = F.transform(F.split("header", ","), lambda name: F.regexp_replace(strip(F.regexp_replace(name, "^\ufeff", "")), '^"|"$', ""))
    headers = materialize(first.select("file", names.alias("names")), "headers")
    if columns is None:
        most = headers.groupBy("names").agg(F.count(F.lit(1)).alias("files")).orderBy(F.desc("files"), "names").limit(1)
        expected = most.select("names").scalar()
    else:
        expected = F.array(*[F.lit(name) for name in columns])
    judged = headers.select("file", "names", expected.alias("wanted"))
    repeated = F.filter(F.array_distinct("names"), lambda name: F.size(F.filter("names", lambda other: other == name)) > 1)
    same = (F.size("names") == F.size("wanted")) & (F.size(F.array_except("wanted", "names")) == 0)
    moved = F.when(same, F.transform(F.filter(F.arrays_zip("names", "wanted"), lambda pair: pair["names"] != pair["wanted"]), lambda pair: pair["names"]))
    rules = {"absent_column": F.array_except("wanted", "names"), "extra_column": F.array_except("names", "wanted"), "repeated_column": repeated, "moved_column": moved}
    return union_violations([judged.select("file", F.lit(rule).alias("rule"), F.explode(found).alias("offender")) for rule, found in rules.items()])


def _stored(spark: SparkSession, path: str, file_format: str) -> DataFrame:
    if file_format == "csv":
        return _raw_text(spark, path, True)
    return spark.read.format(file_format).load(path)


def read_columns(spark: SparkSession, path: str, file_format: str = "parquet") -> list[str]:
    """S3. Column names of a table, from its schema or, for CSV, from the header."""
    return _stored(spark, path, file_format).columns


def read_projection(spark: SparkSession, path: str, columns: Sequence[str], file_format: str = "parquet") -> DataFrame:
    """S4. The given columns in the given order; the others are not read (in a CSV not parsed)."""
    df = _stored(spark, path, file_format)
    require_columns(df, columns, path)
    return df.select(*[F.col(f"`{name}`") for name in columns])


def read_split(spark: SparkSession, path: str, split: str, column: str = "modeling_split") -> DataFrame:
    """S5. One split; only its partition folder is listed and read."""
    return spark.read.parquet(path).where(F.col(column) == split)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """S6. Small CSV about columns: text trimmed, blanks instead of missing, ``position`` as in the file."""
    raw = spark.read.option("header", True).csv(path).coalesce(1)
    cleaned = [F.coalesce(strip(F.col(f"`{name}`")), F.lit("")).alias(name) for name in raw.columns]
    return raw.select(F.monotonically_increasing_id().cast("int").alias("position"), *cleaned)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """S6, G8. Column catalog, checked."""
    from loanweft.operators.governance import enforce_catalog

    catalog = read_metadata(spark, path)
    enforce_catalog(catalog)
    return catalog


def read_feature_names(spark: SparkSession, path: str, column: str = "feature_name") -> list[str]:
    """S7. Vector slot names in slot order, checked."""
    table = spark.read.parquet(path)
    require_columns(table, ["slot", column], "feature names")
    enforce(union_violations([
        violations(table, "missing_name", F.col("slot"), F.col(column).isNull()),
        duplicate_values(table.where(F.col(column).isNotNull()), column, "duplicate_name")]), "feature names")
    names = [row[column] for row in table.orderBy("slot").collect()]
    if not names:
        raise DataCheckError("no feature names")
    return names


def read_features(spark: SparkSession, path: str, label: str = "bad_loan", vector: str = "features",
                  names: Sequence[str] | None = None) -> DataFrame:
    """S8, J5. Keyed table with vector and label: present, non-empty, labels 0 or 1, vectors of the right size
    and finite."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.stat import Summarizer

    df = spark.read.parquet(path)
    require_columns(df, [label, vector], path)
    if not isinstance(df.schema[vector].dataType, VectorUDT):
        raise DataCheckError(f"{vector} is not a vector column")
    y = F.col(label)
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(y.isNull() | ~y.isin(0, 1)).alias("labels")).first()
    if not row.rows:
        raise DataCheckError(f"{path} holds no rows or no features")
    if row.labels:
        raise DataCheckError(f"{row.labels} labels are not 0 or 1")
    try:  # sums per slot, without making the vectors dense; vectors of different sizes are refused there
        norms = df.agg(Summarizer.metrics("normL1").summary(F.col(vector)).alias("m")).select(
            vector_to_array("m.normL1").alias("norms")).first().norms
    except Exception as error:
        if "imension" not in str(error):
            raise
        raise DataCheckError(f"{path}: vectors are not of one size") from error
    if not norms:
        raise DataCheckError(f"{path} holds no rows or no features")
    if not all(math.isfinite(norm) for norm in norms) or (names is not None and len(norms) != len(names)):
        raise DataCheckError(f"{path}: vectors not finite or not of one size that matches the names")
    return df
