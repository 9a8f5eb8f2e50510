"""Readers: raw text files, raw history, staged changes and the source database."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledger.schemas import KEYS, columns, text_schema, typed_schema
from ledger.session import path_exists
from ledger.sources.control import completed_runs


def csv_reader(spark: SparkSession, schema: T.StructType, escape: str = '"', multi_line: bool = True):
    """Strict reader: every file must have exactly the expected header, bad rows fail the job.

    Column pruning is off so that the whole header is compared; with ``spark.sql.caseSensitive`` (set
    by ``session.configure``) letter case counts too.  ``multi_line`` keeps line breaks inside quoted
    texts and reads each part file in one task, so writers here cap the rows per file; switch it off
    for files known to have none and Spark splits them.  A byte order mark is skipped.
    ``escape`` is ``"`` for doubled quotes and ``\\`` for backslash escapes.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("columnPruning", False)
        .option("mode", "FAILFAST")
        .option("quote", '"')
        .option("escape", escape)
        .option("multiLine", multi_line)
    )


def _input_order(batch: Column, done: Column | None = None):
    """Batch, completion of its run, part number, file of the part, position in the file, row within the task.

    Increases with the input order: written part files are numbered in the order of the rows, and a part
    longer than the row cap is cut into files counted by ``-c000``, ``-c001``.  Only numbers, since it
    travels with every row through shuffles.
    """
    # "part-00012-...-c001.csv": a name without a number sorts first.
    name = F.col("_metadata.file_name")
    return F.struct(
        batch.alias("batch"),
        (F.lit(0).cast("bigint") if done is None else done).alias("done"),
        F.regexp_extract(name, r"^part-([0-9]+)", 1).try_cast("bigint").alias("part"),
        F.regexp_extract(name, r"-c([0-9]+)(?:[.]|$)", 1).try_cast("bigint").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def _batch_number(watermark: Column) -> Column:
    """Batch folders as numbers that grow with their watermark."""
    return F.unix_micros(F.to_timestamp(F.substring(watermark, 1, 15), "yyyyMMdd'T'HHmmss")) + F.substring(
        watermark, 16, 6
    ).cast("bigint")


def locate_raw(spark: SparkSession, root: str, table: str) -> str:
    candidates = [f"{root}/{table}.csv", f"{root}/{table}/{table}.csv"]
    for path in candidates:
        if path_exists(spark, path):
            return path
    raise FileNotFoundError(f"no raw {table} file; checked: {', '.join(candidates)}")


def read_raw(
    spark: SparkSession, root: str, table: str, escape: str = '"', multi_line: bool = True
) -> DataFrame:
    """One table's full raw file(s): all fields as text, blanks as ``''``, plus ``_seq``.

    ``_seq`` orders rows as they were read.  Freeze it with ``session.stage`` before using the result
    in several jobs.
    """
    path = locate_raw(spark, root, table)
    rows = csv_reader(spark, text_schema(table), escape, multi_line).csv(path)
    return rows.select(
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns(table)],
        _input_order(F.lit(0).cast("bigint")).alias("_seq"),
    )


def read_layer(
    spark: SparkSession, path: str, table: str, *extra: str, escape: str = '"', multi_line: bool = True
) -> DataFrame:
    """A written layer of one table as text; ``extra`` names fields after the table's own."""
    rows = csv_reader(spark, text_schema(table, *extra), escape, multi_line).csv(path)
    return rows.na.fill("")


def read_raw_versions(
    spark: SparkSession, root: str, table: str, escape: str = '"', multi_line: bool = True, runs: DataFrame | None = None
) -> DataFrame:
    """The full extract and all completed incremental batches as versions of one table.

    A batch counts only if the control history names its run: a run stopped by its count guard leaves its folders
    behind.  ``watermark`` and ``run_id`` come from the batch folders (``''`` for the full extract) and stay
    text; filters on them prune folders.  ``_seq`` puts later batches after earlier ones, those of one watermark
    in the order in which their runs completed.  ``runs`` (``_run``) names the batches to read instead of all, ``''`` for
    the full extract.
    """
    fields = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns(table)]
    parts = []
    if runs is None or not runs.filter(F.col("_run") == "").isEmpty():
        parts.append(
            csv_reader(spark, text_schema(table), escape, multi_line).csv(locate_raw(spark, root, table)).select(
                *fields, F.lit("").alias("watermark"), F.lit("").alias("run_id"),
                _input_order(F.lit(-(1 << 62))).alias("_seq"),
            )
        )
    batches = f"{root}/{table}/incremental"
    if path_exists(spark, batches):
        wanted = completed_runs(spark, root)
        if runs is not None:
            wanted = wanted.join(runs, "_run", "left_semi")
        # Folder names hold text; the reader's schema fixes the types of the partition columns.
        schema = text_schema(table, "watermark", "run_id")
        parts.append(
            csv_reader(spark, schema, escape, multi_line)
            .option("basePath", batches)
            .csv(batches)
            .select(*fields, "watermark", "run_id", _input_order(_batch_number(F.col("watermark"))).alias("_seq"))
            .join(wanted, F.col("run_id") == F.col("_run"))
            .withColumn("_seq", F.col("_seq").withField("done", F.col("_done")))
            .drop("_run", "_done")
        )
    if not parts:
        empty = spark.createDataFrame([], text_schema(table, "watermark", "run_id"))
        return empty.withColumn("_seq", F.lit(None).cast("struct<batch:bigint,done:bigint,part:bigint,file:bigint,block:bigint,row:bigint>"))
    return reduce(DataFrame.unionByName, parts)


def read_batch(
    spark: SparkSession, root: str, table: str, watermark: str, run_id: str, escape: str = '"', multi_line: bool = True
) -> DataFrame:
    """One watermark/run folder as text."""
    path = f"{root}/{table}/incremental/watermark={watermark}/run_id={run_id}"
    return csv_reader(spark, text_schema(table), escape, multi_line).csv(path).na.fill("")


def read_staged(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Change rows: ``operation`` first, then the typed fields; blanks become null."""
    schema = T.StructType([T.StructField("operation", T.StringType()), *typed_schema(table).fields])
    return (
        csv_reader(spark, schema).option("nullValue", "").option("timestampFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS][XXX]")
        .csv(path)
    )


def read_source(spark: SparkSession, source: dict, table: str) -> DataFrame:
    """One table of the source system.

    ``{"format": "parquet", "path": root}`` reads ``<root>/<table>`` (or ``<table>.parquet``); ``"partition": "day=1"`` reads
    that partition folder of each table alone.
    ``{"format": "jdbc", "url": ..., "partitions": n, "bounds": {table: (low, high)}, ...}`` reads the
    database in ``n`` parallel key ranges.  Bounds only place the ranges, rows outside them are read
    too; where none are given, the lowest and highest key are asked from the database first, one row per table.
    Other entries go to the driver as options.  Filters and columns reach either source.
    """
    kind = source.get("format", "jdbc")
    if kind != "jdbc":
        root = source["path"]
        path = next(
            (p for p in (f"{root}/{table}", f"{root}/{table}.{kind}") if path_exists(spark, p)), None
        )
        if path is None:
            raise FileNotFoundError(f"no {table} below {root}")
        part = f"{path}/{source['partition']}" if source.get("partition") else path
        return spark.read.format(kind).load(part).select(*columns(table))
    bounds = source.get("bounds", {}).get(table) or key_bounds(spark, source, table)
    source = {**source, "bounds": {table: bounds}}
    reader = spark.read.format("jdbc").options(**jdbc_options(source, table))
    return reader.load().select(*columns(table))


def key_bounds(spark: SparkSession, source: dict, table: str) -> tuple[int, int] | None:
    """Lowest and highest key of a database table; None if it is empty."""
    options = jdbc_options({**source, "bounds": {}}, table)
    key, name = KEYS[table], options.pop("dbtable")
    options["query"] = f"SELECT MIN({key}) AS low, MAX({key}) AS high FROM {name}"
    row = spark.read.format("jdbc").options(**options).load().first()
    return None if row["low"] is None else (row["low"], row["high"] + 1)


def jdbc_options(source: dict, table: str) -> dict[str, str]:
    given = {k: str(v) for k, v in source.items() if k not in ("format", "bounds", "partitions", "schema")}
    options = {"dbtable": f"{source.get('schema', 'public')}.{table}", "fetchsize": "10000", **given}
    bounds = source.get("bounds", {}).get(table)
    if bounds:
        low, high = bounds
        options.update(
            partitionColumn=KEYS[table], lowerBound=str(low), upperBound=str(high),
            numPartitions=str(source.get("partitions", 64)),
        )
    return options


def source_window(spark: SparkSession, source: dict, table: str, old: str | None = None) -> DataFrame:
    """One row ``(new_watermark, expected_rows)`` of a source table, above ``old`` if given.

    A database works both numbers out itself; Spark's reader would fetch the column to aggregate it.
    """
    if source.get("format", "jdbc") != "jdbc":
        df = read_source(spark, source, table)
        if old is not None:
            df = df.filter(F.col("updated_at") > F.lit(old).cast(df.schema["updated_at"].dataType))
        return df.agg(F.max("updated_at").alias("new_watermark"), F.count(F.lit(1)).alias("expected_rows"))
    options = jdbc_options({**source, "bounds": {}}, table)
    where = "" if old is None else f" WHERE updated_at > TIMESTAMP WITH TIME ZONE '{old}+00'"
    options["query"] = (
        f"SELECT MAX(updated_at) AS new_watermark, COUNT(*) AS expected_rows FROM {options.pop('dbtable')}{where}"
    )
    return spark.read.format("jdbc").options(**options).load()
