"""What lies in the lake: files, digests, batches, and proof that a rerun changed nothing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledger.schemas import KEYS, TABLES, columns
from ledger.sources.control import read_watermark_history
from ledger.sources.raw import read_batch
from ledger.sources.sinks import watermark_folder

#: Raw files, plain or compressed.
RAW_FILES = "*.{csv,csv.gz,csv.lz4,csv.snappy}"

# A file's hash tree: lines in leaves, leaves and nodes in nodes.  Fixed, since digests are kept and compared.
LEAF_LINES = 1 << 14
NODE_FAN = 1 << 12
NODE_LEVELS = 3


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _files(spark: SparkSession, root: str, glob: str) -> DataFrame:
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
        .load(root)
    )


def _headers(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """``(path, header, width)``: the first line of each file without its quotes, and its number of fields."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(root)
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    placed = lines.select(F.col("_metadata.file_path").alias("path"), "value", place.alias("place"))
    found = placed.groupBy("path").agg(F.min_by("value", "place").alias("line"))
    fields = F.split("line", r',(?=(?:[^"]*"[^"]*")*[^"]*$)', -1)
    return found.select("path", F.array_join(F.transform(fields, lambda f: F.btrim(f, F.lit('"'))), ",").alias("header"), F.size(fields).alias("width"))


def _parsed(spark: SparkSession, root: str, glob: str, multi_line: bool = True) -> tuple[DataFrame, list[str]]:
    """Rows of delimited files with any header, headers included, as wide as the widest header."""
    width = _headers(spark, root, glob).agg(F.max("width")).first()[0] or 1
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])
    rows = (
        spark.read.schema(schema).option("header", False).option("quote", '"').option("escape", '"')
        .option("multiLine", multi_line).option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob).csv(root)
    )
    return rows, schema.names


def _file_rows(spark: SparkSession, root: str, glob: str, multi_line: bool = True) -> DataFrame:
    """``(path, header, data_rows)`` of delimited files with any header."""
    rows, _ = _parsed(spark, root, glob, multi_line)
    counts = rows.groupBy(F.col("_metadata.file_path").alias("path")).agg((F.count(F.lit(1)) - 1).alias("data_rows"))
    return _headers(spark, root, glob).select("path", "header").join(counts, "path")


def _with_rows(files: DataFrame, rows: DataFrame) -> DataFrame:
    """Files without any row stay, with no header and zero rows."""
    return files.join(rows, "path", "left").withColumns({
        "header": F.coalesce("header", F.lit("")), "data_rows": F.coalesce("data_rows", F.lit(0)),
    })


def lake_inventory(spark: SparkSession, roots: list[str], glob: str = RAW_FILES) -> DataFrame:
    """``(path, bytes, modified_at, header, data_rows)`` per file; files outside ``glob`` are listed without contents."""
    return _union([
        _with_rows(
            _files(spark, root, "*").select(
                "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified_at")
            ),
            _file_rows(spark, root, glob),
        )
        for root in roots
    ])


def _placed_lines(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """``(path, value, at)``: lines of the files with their number in the file, whatever tasks read which part of it.

    A task numbers its lines in reading order; the lines of the blocks before it in the file are counted per block and added.
    """
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).option("lineSep", "\n").text(root)
    placed = lines.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value",
        F.monotonically_increasing_id().alias("id"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        placed.groupBy("path", "block").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .withColumn("shift", F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).drop("n", "first")
    )
    return placed.join(blocks, ["path", "block"]).select("path", "value", (F.col("id") + F.col("shift")).alias("at"))


def _leaves(lines: DataFrame) -> DataFrame:
    """``(path, leaf, digest, quotes, even, odd)``: per leaf the digest of its lines in order, whether it has an odd number of
    quotes, and the rows that end in it if it begins outside (``even``) or inside (``odd``) a quoted text."""
    quotes = F.pmod(F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))), F.lit(2))
    blank = F.btrim("value", F.lit("\r")) == ""
    line = F.struct("at", F.unhex(F.sha2(F.col("value").cast("binary"), 256)).alias("digest"), quotes.alias("q"), blank.alias("blank"))
    start = F.struct(F.lit(0).alias("q"), F.lit(0).cast("bigint").alias("even"), F.lit(0).cast("bigint").alias("odd"))

    def step(state, one):
        after = (state["q"] + one["q"]) % 2
        # A blank line outside quotes is no row; inside, it is part of one.
        outside = F.when((after == 0) & ~(one["blank"] & (state["q"] == 0)), 1).otherwise(0)
        inside = F.when((after == 1) & ~(one["blank"] & (state["q"] == 1)), 1).otherwise(0)
        return F.struct(after.cast("int").alias("q"), (state["even"] + outside).alias("even"), (state["odd"] + inside).alias("odd"))

    grouped = lines.select("path", F.floor(F.col("at") / LEAF_LINES).alias("leaf"), line.alias("line")).groupBy("path", "leaf").agg(
        F.sort_array(F.collect_list("line")).alias("lines"))
    counts = F.aggregate("lines", start, step)
    return grouped.withColumn("counts", counts).select(
        "path", "leaf", _joined("lines").alias("digest"), F.col("counts.q").alias("quotes"), F.col("counts.even").alias("even"), F.col("counts.odd").alias("odd"))


def _joined(ordered: str) -> Column:
    """Digest of the digests in order."""
    return F.unhex(F.sha2(F.unhex(F.array_join(F.transform(ordered, lambda x: F.hex(x["digest"])), "")), 256))


def file_digests(spark: SparkSession, root: str, glob: str = RAW_FILES) -> DataFrame:
    """``(path, bytes, tree_sha256, data_rows)`` per file.

    ``tree_sha256`` is the root of a hash tree over the file's lines in order: SHA-256 of each line, of each ``LEAF_LINES`` lines' digests, and of
    up to ``NODE_FAN`` digests on each of ``NODE_LEVELS`` levels above.  It takes in every byte but a last line break, which shows in ``bytes``, and does not depend on how
    Spark splits the file, so files of any size are read by many tasks on one path.  ``data_rows`` counts the rows of texts with doubled
    quotes, whose line breaks inside quotes end no row, less the header.  Of a compressed file the lines are those of its text, ``bytes`` its size.  Files
    without a byte are not listed by Spark's readers.
    """
    files = _files(spark, root, glob).select("path", F.col("length").alias("bytes"))
    leaves = _leaves(_placed_lines(spark, root, glob))
    before = Window.partitionBy("path").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    rows = leaves.select("path", "even", "odd", F.pmod(F.coalesce(F.sum("quotes").over(before), F.lit(0)), F.lit(2)).alias("begins")).groupBy("path").agg(
        F.sum(F.when(F.col("begins") == 0, F.col("even")).otherwise(F.col("odd"))).alias("rows"))
    nodes = leaves.select("path", F.col("leaf").alias("at"), "digest")
    for _ in range(NODE_LEVELS):
        nodes = nodes.groupBy("path", F.floor(F.col("at") / NODE_FAN).alias("up")).agg(
            F.sort_array(F.collect_list(F.struct("at", "digest"))).alias("below")).select("path", F.col("up").alias("at"), _joined("below").alias("digest"))
    found = nodes.select("path", F.lower(F.hex("digest")).alias("tree_sha256")).join(rows, "path")
    return files.join(found, "path", "left").select(
        "path", "bytes", F.coalesce("tree_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("tree_sha256"),
        F.greatest(F.coalesce("rows", F.lit(0)) - 1, F.lit(0)).alias("data_rows"))


def compare_digests(before: DataFrame, after: DataFrame) -> DataFrame:
    """``(path, unchanged)`` over the files of either side."""
    same = F.col("b.bytes").eqNullSafe(F.col("a.bytes")) & F.col("b.tree_sha256").eqNullSafe(F.col("a.tree_sha256")) \
        & F.col("b.path").isNotNull() & F.col("a.path").isNotNull()
    return before.alias("b").join(after.alias("a"), F.col("b.path") == F.col("a.path"), "full").select(
        F.coalesce("b.path", "a.path").alias("path"), same.alias("unchanged")
    )


def _folder(watermark: str | dict[str, str], table: str) -> str:
    return watermark_folder(watermark[table] if isinstance(watermark, dict) else watermark)


def verify_batch(
    spark: SparkSession, root: str, watermark: str | dict[str, str], run_id: str, expected: DataFrame,
) -> DataFrame:
    """One row per table: rows found and expected, those on one side only, and whether the control history has the run.

    ``expected`` has ``(table_name, row_key, updated_at)`` as text, a row per expected row.  Both sides are counted per key and
    time, so a missing, doubled or changed row shows.  ``control_ok``: exactly one control row names the run, and its
    mark of the table is the batch's.  ``watermark`` is one boundary or one per table.  Reading fails on a wrong header.
    """
    fields = ["table_name", "row_key", "updated_at"]
    sides = batch_rows(spark, root, watermark, run_id).select(*fields, F.lit(1).alias("f"), F.lit(0).alias("e")).union(
        expected.select(*fields, F.lit(0), F.lit(1)))
    per_row = sides.groupBy(*fields).agg(F.sum("f").alias("f"), F.sum("e").alias("e"))
    sums = per_row.groupBy("table_name").agg(
        F.sum("f").alias("data_rows"), F.sum("e").alias("expected_rows"),
        F.sum(F.greatest(F.col("e") - F.col("f"), F.lit(0))).alias("missing_rows"),
        F.sum(F.greatest(F.col("f") - F.col("e"), F.lit(0))).alias("unexpected_rows"),
        F.min(F.when(F.col("f") > 0, F.col("updated_at"))).alias("first_updated_at"),
        F.max(F.when(F.col("f") > 0, F.col("updated_at"))).alias("last_updated_at"),
    )
    history = read_watermark_history(spark, root).filter(F.col("last_successful_run_id") == run_id)
    control = _union([
        history.agg(F.count(F.lit(1)).alias("control_rows"), F.max(f"{t}_watermark").alias("_mark")).select(
            F.lit(t).alias("_table"), F.lit(_folder(watermark, t)).alias("_folder"), "control_rows", "_mark")
        for t in TABLES
    ])
    counts = ["data_rows", "expected_rows", "missing_rows", "unexpected_rows"]
    mark = F.date_format(F.col("_mark").cast("timestamp"), "yyyyMMdd'T'HHmmssSSSSSS'0Z'")
    return (
        control.join(sums, F.col("_table") == F.col("table_name"), "left")
        .withColumn("table_name", F.col("_table"))
        .fillna(0, counts)
        .withColumn("rows_ok", (F.col("missing_rows") == 0) & (F.col("unexpected_rows") == 0))
        .withColumn("control_ok", (F.col("control_rows") == 1) & F.coalesce(mark == F.col("_folder"), F.lit(False)))
        .select("table_name", *counts, "first_updated_at", "last_updated_at", "rows_ok", "control_rows", "control_ok")
    )


def batch_rows(spark: SparkSession, root: str, watermark: str | dict[str, str], run_id: str) -> DataFrame:
    """``(table_name, row_key, updated_at)`` of a batch, for callers that want to see them."""
    return _union([
        read_batch(spark, root, table, _folder(watermark, table), run_id).select(
            F.lit(table).alias("table_name"), F.col(KEYS[table]).alias("row_key"), "updated_at"
        )
        for table in TABLES
    ])


def batch_digests(spark: SparkSession, root: str, watermark: str | dict[str, str], run_id: str) -> DataFrame:
    """:func:`file_digests` of a batch's four folders, with the table name."""
    return _union([
        file_digests(spark, f"{root}/{table}/incremental/watermark={_folder(watermark, table)}/run_id={run_id}")
        .withColumn("table_name", F.lit(table))
        for table in TABLES
    ])


def batch_snapshot(spark: SparkSession, root: str, watermark: str | dict[str, str], run_id: str) -> DataFrame:
    """``(table_name, row_key, row_digest, copies)`` of a batch's rows as they lie in the lake now.

    Kept before a rerun and taken again after it, it proves what the rerun left alone, down to single keys.
    """
    return _union([
        read_batch(spark, root, t, _folder(watermark, t), run_id).select(
            F.lit(t).alias("table_name"), F.col(KEYS[t]).alias("row_key"), F.sha2(F.to_json(F.struct(*columns(t))), 256).alias("row_digest"))
        for t in TABLES
    ]).groupBy("table_name", "row_key", "row_digest").agg(F.count(F.lit(1)).alias("copies"))


SNAPSHOT_BUCKETS = 4096


def changed_keys(before: DataFrame, after: DataFrame, buckets: int = SNAPSHOT_BUCKETS) -> DataFrame:
    """``(table_name, row_key, change)`` with change ``added``, ``removed`` or ``changed``, over two snapshots.

    Both are first added up per bucket of keys; only buckets that differ are compared key by key, so equal snapshots shuffle
    one row per bucket and task.
    """
    bucket = F.pmod(F.xxhash64("row_key"), F.lit(buckets))
    both = [df.withColumn("_bucket", bucket) for df in (before, after)]
    # Two independent sums of hashes; each snapshot row is unique.
    parts = [F.xxhash64("row_key", "row_digest", "copies").cast("decimal(38,0)"), F.xxhash64("copies", "row_digest", "row_key").cast("decimal(38,0)")]
    sums = [df.groupBy("table_name", "_bucket").agg(*[F.sum(p).alias(f"_s{i}") for i, p in enumerate(parts)], F.sum("copies").alias("_n")) for df in both]
    names = ["_s0", "_s1", "_n"]
    signed = [sums[0].select("table_name", "_bucket", *names), sums[1].select("table_name", "_bucket", *[(-F.col(c)).alias(c) for c in names])]
    differ = _union(signed).groupBy("table_name", "_bucket").agg(*[F.sum(c).alias(c) for c in names]).filter(
        (F.col("_s0") != 0) | (F.col("_s1") != 0) | (F.col("_n") != 0)).select("table_name", "_bucket")
    rows = _union([
        df.join(differ, ["table_name", "_bucket"], "left_semi").select("table_name", "row_key", "row_digest", "copies", F.lit(side).alias("side"))
        for df, side in zip(both, (-1, 1), strict=True)])
    per_row = rows.groupBy("table_name", "row_key", "row_digest").agg(
        F.sum(F.col("side") * F.col("copies")).alias("n"), F.count_if(F.col("side") < 0).alias("was"), F.count_if(F.col("side") > 0).alias("is"))
    return per_row.groupBy("table_name", "row_key").agg(F.sum("was").alias("was"), F.sum("is").alias("is"), F.count_if(F.col("n") != 0).alias("off")).filter(
        F.col("off") > 0).select("table_name", "row_key", F.when(F.col("was") == 0, "added").when(F.col("is") == 0, "removed").otherwise("changed").alias("change"))


def rerun_proof(
    spark: SparkSession, root: str, watermark: str | dict[str, str], first_id: str, second_id: str, before_files: DataFrame, before_rows: DataFrame,
    source_before: DataFrame, source_after: DataFrame, expected_marks: DataFrame,
) -> DataFrame:
    """Is a run unharmed by the rerun after it?  One row per table, all worked out from the lake and from what was kept before the rerun.

    ``before_files`` are :func:`batch_digests` and ``before_rows`` the :func:`batch_snapshot` of the first run, taken before the rerun;
    ``source_before`` and ``source_after`` have ``(table_name, source_rows)``, ``expected_marks`` ``(table_name, watermark)`` as text.
    Counts of keys before and after, changed keys (:func:`changed_keys` names them), changed files, rows of the rerun's own files, misplaced files,
    control rows of both runs, source totals, the current mark and who set it, and ``passed``.
    """
    after_files = batch_digests(spark, root, watermark, first_id)
    second = batch_digests(spark, root, watermark, second_id)
    after_rows = batch_snapshot(spark, root, watermark, first_id)
    history = read_watermark_history(spark, root)

    def per_table(df: DataFrame, *cells: Column) -> DataFrame:
        return df.groupBy("table_name").agg(*cells)

    table_of = _union([before_files.select("path", "table_name"), after_files.select("path", "table_name")]).distinct()
    files = compare_digests(before_files, after_files).join(table_of, "path")
    first_folder, second_folder = F.lit(f"/run_id={first_id}/"), F.lit(f"/run_id={second_id}/")
    current = history.agg(F.max_by(F.struct("*"), F.struct(F.col("completed_at").cast("timestamp"), "last_successful_run_id")).alias("c")).select("c.*")
    marks = _union([current.select(F.lit(t).alias("table_name"), F.col(f"{t}_watermark").alias("current_watermark"), "last_successful_run_id") for t in TABLES])
    runs = history.agg(*[F.count_if(F.col("last_successful_run_id") == r).alias(n) for r, n in ((first_id, "first_control_rows"), (second_id, "rerun_control_rows"))])
    parts = [
        per_table(before_rows, F.sum("copies").alias("rows_before"), F.count_distinct("row_key").alias("keys_before")),
        per_table(after_rows, F.sum("copies").alias("rows_after"), F.count_distinct("row_key").alias("keys_after")),
        per_table(changed_keys(before_rows, after_rows), F.count(F.lit(1)).alias("changed_keys")),
        per_table(files, F.count_if(~F.col("unchanged")).alias("changed_files")),
        per_table(before_files, F.count_if(~F.contains("path", first_folder)).alias("misplaced_files")),
        per_table(second, F.sum("data_rows").alias("rerun_rows"), F.count_if(~F.contains("path", second_folder)).alias("misplaced_rerun_files")),
        source_before.select("table_name", F.col("source_rows").alias("source_rows_before")),
        source_after.select("table_name", F.col("source_rows").alias("source_rows_after")),
        marks, _union([runs.select(F.lit(t).alias("table_name"), "*") for t in TABLES]), expected_marks.select("table_name", F.col("watermark").alias("expected_watermark")),
    ]
    out = spark.createDataFrame([(t,) for t in TABLES], "table_name string")
    for part in parts:
        out = out.join(part, "table_name", "left")
    counts = [c for c, kind in out.dtypes if kind == "bigint"]
    out = out.fillna(0, counts)
    same_mark = F.col("current_watermark").cast("timestamp") == F.col("expected_watermark").cast("timestamp")
    checks = [
        F.col("rows_before") == F.col("rows_after"), F.col("keys_before") == F.col("keys_after"), F.col("source_rows_before") == F.col("source_rows_after"),
        *[F.col(c) == 0 for c in ("changed_keys", "changed_files", "misplaced_files", "misplaced_rerun_files", "rerun_rows")],
        F.col("first_control_rows") == 1, F.col("rerun_control_rows") == 1, F.col("last_successful_run_id") == second_id, same_mark,
    ]
    passed = reduce(lambda a, b: a & b, [F.coalesce(c, F.lit(False)) for c in checks])
    return out.withColumn("watermark_ok", F.coalesce(same_mark, F.lit(False))).withColumn("passed", passed).select(
        "table_name", *counts, "last_successful_run_id", "watermark_ok", "passed")


def rerun_idempotency(proof: DataFrame) -> DataFrame:
    """Verdicts ``(check_name, passed)`` over all tables of a :func:`rerun_proof`, and their conjunction as ``status``."""
    checks = {
        "first_run_files_unchanged": (F.col("changed_files") == 0) & (F.col("changed_keys") == 0) & (F.col("rows_before") == F.col("rows_after")),
        "second_run_files_separate_and_empty": (F.col("rerun_rows") == 0) & (F.col("misplaced_rerun_files") == 0),
        "first_run_files_located": F.col("misplaced_files") == 0,
        "run_ids_unique": (F.col("first_control_rows") == 1) & (F.col("rerun_control_rows") == 1),
        "watermarks_as_expected": F.col("watermark_ok"),
        "source_unchanged": F.col("source_rows_before") == F.col("source_rows_after"),
        "status": F.col("passed"),
    }
    sums = proof.agg(*[F.coalesce(F.bool_and(c), F.lit(False)).alias(n) for n, c in checks.items()])
    return sums.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(n).alias("passed")) for n in checks])))


# Names of the activities in run records.
COPY_NAME = r"^Copy_([A-Za-z]+)_(?:Incremental_)?To_Raw$"
LOOKUP_NAME = r"^Lookup_([A-Za-z]+)_(?:Window|Full_Count)$"

RUN_SCHEMA = T.StructType([
    T.StructField("runId", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("activities", T.ArrayType(T.StructType([
        T.StructField("activityName", T.StringType()),
        T.StructField("rowsCopied", T.LongType()),
        T.StructField("firstRow", T.StructType([
            T.StructField("expected_rows", T.LongType()),
            T.StructField("source_rows", T.LongType()),
        ])),
    ]))),
])


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Run records, one JSON document per file."""
    return spark.read.schema(RUN_SCHEMA).option("multiLine", True).json(path)


def run_counts(runs: DataFrame) -> DataFrame:
    """``(run_id, status, table_name, copied_rows, expected_rows)`` out of run records."""
    activity = runs.select("runId", "status", F.explode("activities").alias("a")).select(
        F.col("runId").alias("run_id"), "status", F.col("a.activityName").alias("name"),
        F.col("a.rowsCopied").alias("copied"),
        F.coalesce("a.firstRow.expected_rows", "a.firstRow.source_rows").alias("expected"),
    )
    copy = F.regexp_extract("name", COPY_NAME, 1)
    lookup = F.regexp_extract("name", LOOKUP_NAME, 1)
    return (
        activity.withColumn("table_name", F.lower(F.concat(copy, lookup)))
        .filter(F.col("table_name").isin(TABLES))
        .groupBy("run_id", "status", "table_name")
        .agg(F.max("copied").alias("copied_rows"), F.max("expected").alias("expected_rows"))
    )
