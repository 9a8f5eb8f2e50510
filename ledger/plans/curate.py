"""Raw text to curated and rejected layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledger.operators import quality, relate
from ledger.operators.validate import VALIDATORS
from ledger.schemas import KEYS, TABLES, columns, timestamps
from ledger.session import path_exists, remove_scratch, scratch, stage, together
from ledger.sources.raw import read_raw, read_raw_versions
from ledger.sources.sinks import layer_path, write_curated, write_rejected


# What versions, references and amounts depend on; everything else stays out of their shuffles.
SLIM = {
    "customers": ["t_customer_id", "t_updated_at"],
    "products": ["t_product_id", "t_updated_at"],
    "orders": ["t_order_id", "t_customer_id", "t_product_id", "t_quantity", "t_unit_price", "w_unit_price", "t_updated_at"],
    "payments": ["t_payment_id", "t_order_id", "t_payment_amount", "w_payment_amount", "t_payment_status", "t_payment_time", "t_updated_at"],
}


#: Stands for all reasons a row has by itself while further ones are worked out.
OWN = ""


def _with_final(wide: DataFrame, gained: DataFrame) -> DataFrame:
    """Put the reasons that rows gained behind those they had by themselves.

    ``_row`` is unique, so the one shuffle of full rows is even whatever the keys look like.
    """
    return (
        wide.join(gained, "_row", "left")
        .withColumn("reasons", F.when(F.col("_gained").isNull(), F.col("reasons")).otherwise(F.concat("reasons", "_gained")))
        .drop("_gained", "_row")
    )


def _layers(wide: DataFrame, gained: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(curated, rejected) full rows, straight from the typed rows and the slim outcome.

    Curated rows meet only the numbers of those that gained a reason; rows with reasons of their own only look up further ones.
    """
    clean, own = wide.filter(F.size("reasons") == 0), wide.filter(F.size("reasons") > 0)
    late = clean.drop("reasons").join(gained, "_row").withColumn("reasons", F.col("_gained")).drop("_gained", "_row")
    return clean.join(gained, "_row", "left_anti").drop("_row"), _with_final(own, gained).unionByName(late)


def judge(text_tables: dict[str, DataFrame], work: str, fields: dict[str, list[str]] | None = None) -> dict[str, DataFrame]:
    """All rows of the four tables with their final ``reasons``; ``text_tables`` hold the text fields and ``_seq``.

    ``fields`` names the text fields that a caller still reads of each table, instead of all; the others are judged but not written.
    They travel with the slim rows, so nothing is joined by row number in the end; a key's text does so only where it differs from the key.
    """
    if fields is None:
        typed, gained = _outcome(text_tables, work)
        return {table: _with_final(typed[table], gained[table]) for table in TABLES}

    def type_rows(table: str) -> DataFrame:
        rows = VALIDATORS[table](text_tables[table])
        kept = [odd_text(table).alias(f) if f == KEYS[table] else F.col(f) for f in fields[table]]
        return stage(rows.select(*kept, "_seq", *SLIM[table], "reasons"), f"{work}/typed/{table}")

    typed = together(next(iter(text_tables.values())).sparkSession, type_rows, TABLES)
    slim = {t: relate.reject_superseded(df, f"t_{KEYS[t]}").drop("t_updated_at") for t, df in typed.items()}
    slim, wrong = _linked(slim, work)
    slim["payments"] = relate.flag_payments(slim["payments"], slim["orders"], wrong)
    slim["orders"] = relate.flag_orders(slim["orders"], wrong)
    return {
        t: df.withColumns({KEYS[t]: whole_text(t)} if KEYS[t] in fields[t] else {}).select(*fields[t], "_seq", *[c for c in SLIM[t] if c in df.columns], "reasons")
        for t, df in slim.items()
    }


def odd_text(table: str) -> Column:
    """The text of a table's key where it isn't the plain text of the typed key, else null."""
    key = KEYS[table]
    return F.when(F.col(key) == F.col(f"t_{key}").cast("string"), F.lit(None).cast("string")).otherwise(F.col(key))


def whole_text(table: str) -> Column:
    """The text of a table's key again."""
    key = KEYS[table]
    return F.coalesce(F.col(key), F.col(f"t_{key}").cast("string"))


def _linked(slim: dict[str, DataFrame], work: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Slim rows with versions collapsed: orders get their unknown references; also the mismatches of clean rows.

    What feeds several steps is written below ``work``; a column goes with the last step that reads it.
    """
    spark = slim["orders"].sparkSession
    slim = slim | together(spark, lambda table: stage(slim[table], f"{work}/slim/{table}"), ["customers", "products"])
    orders = relate.unknown_customer(slim["orders"], slim["customers"]).drop("t_customer_id")
    slim["orders"] = relate.unknown_product(orders, slim["products"]).drop("t_product_id")
    slim |= together(spark, lambda table: stage(slim[table], f"{work}/slim/{table}"), ["orders", "payments"])
    return slim, stage(relate.amount_mismatches(slim["orders"], slim["payments"]), f"{work}/mismatches")


def _outcome(
    text_tables: dict[str, DataFrame], work: str, seen: dict[str, int] | None = None, unique: bool = False
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Per table the typed rows, and ``_row`` and ``_gained`` reasons of those that gained any; ``seen`` gets the rows read.

    The typed rows are written below ``work`` once: the text is
    parsed once, ``_seq`` is frozen and each row gets a number.  Versions, references and amounts
    are then worked out on the few columns they need, with one stand-in for the reasons that a row has by itself;
    what comes out of that is slim too.  ``unique`` says that no two rows of a table share a ``_seq``.
    """
    spark = next(iter(text_tables.values())).sparkSession

    def type_rows(table: str) -> DataFrame:
        read = Observation()
        rows = VALIDATORS[table](text_tables[table].observe(read, F.count(F.lit(1)).alias("rows")))
        # Of the typed columns only what later steps read is written.
        needed = dict.fromkeys([*columns(table), *[f"t_{c}" for c in timestamps(table)], "_seq", *SLIM[table], "reasons"])
        out = stage(rows.select(*needed, F.monotonically_increasing_id().alias("_row")), f"{work}/typed/{table}")
        if seen is not None:
            seen[table] = read.get["rows"]
        return out

    def collapse(table: str) -> DataFrame:
        own = F.when(F.size("reasons") > 0, F.array(F.lit(OWN))).otherwise(F.array().cast("array<string>"))
        rows = typed[table].select("_row", "_seq", *SLIM[table], own.alias("reasons"))
        rows = relate.reject_superseded(rows, f"t_{KEYS[table]}", row="_row" if unique else None)
        # From here on rows are told apart, and rows without a key spread, by their number.
        return rows.drop("t_updated_at", "_seq").withColumnRenamed("_row", "_seq")

    typed = together(spark, type_rows, TABLES)
    slim, wrong = _linked({table: collapse(table) for table in TABLES}, work)
    slim["payments"] = relate.flag_payments(slim["payments"], slim["orders"], wrong)
    slim["orders"] = relate.flag_orders(slim["orders"], wrong, unique)

    def gain(table: str) -> DataFrame:
        found = F.filter("reasons", lambda r: r != OWN)
        return stage(slim[table].select(F.col("_seq").alias("_row"), found.alias("_gained")).filter(F.size("_gained") > 0), f"{work}/gained/{table}")

    return typed, together(spark, gain, TABLES)


def raw_to_curated(
    spark: SparkSession,
    raw: str,
    curated: str,
    rejected: str,
    overwrite: bool = False,
    summary: str | None = None,
    history: bool = False,
    run_id: str | None = None,
    keep_work: bool = False,
    escape: str = '"',
    multi_line: bool = True,
    compression: str | None = None,
) -> DataFrame:
    """Judge the raw files and write both layers; returns the rows of ``layer_summary``.

    ``history`` takes the full extract and all completed incremental batches as versions instead of the full
    extract alone.  With ``run_id`` the layers go to their published folders.  ``summary`` names
    a folder for the JSON summary; the job raises if the layers do not reconcile: rows are counted as they are
    read and again as each layer is written, so a row lost or doubled in between shows.  ``compression`` names a codec for
    the layers' files, which are plain text by default.
    """
    if len({raw.rstrip("/"), curated.rstrip("/"), rejected.rstrip("/")}) != 3:
        raise ValueError("raw, curated and rejected folders must be distinct")
    targets = {
        (table, root): layer_path(root, table, run_id) for table in TABLES for root in (curated, rejected)
    }
    if not overwrite:
        for path in targets.values():
            if path_exists(spark, path):
                raise FileExistsError(f"refusing to overwrite {path}")
    work = scratch(spark, "curate")
    try:
        return _curate(spark, raw, targets, curated, rejected, overwrite, summary, history, work, escape, multi_line, compression)
    finally:
        if not keep_work:
            remove_scratch(spark, work)


def _curate(
    spark: SparkSession, raw: str, targets: dict, curated: str, rejected: str, overwrite: bool, summary: str | None,
    history: bool, work: str, escape: str, multi_line: bool, compression: str | None,
) -> DataFrame:
    read = read_raw_versions if history else read_raw
    seen: dict[str, int] = {}
    typed, gained = _outcome({table: read(spark, raw, table, escape, multi_line) for table in TABLES}, work, seen, unique=True)
    # Full rows are written twice: typed, and in their layer.
    layers = {table: _layers(typed[table], gained[table]) for table in TABLES}

    def write(table: str) -> tuple[int, int]:
        kept, refused = layers[table]
        return (write_curated(kept, targets[table, curated], table, overwrite, compression),
                write_rejected(refused, targets[table, rejected], table, overwrite, compression))

    written = together(spark, write, TABLES)
    result = [(t, seen[t], *written[t], seen[t] == sum(written[t])) for t in TABLES]
    report = spark.createDataFrame(
        result, "table_name string, raw_rows bigint, curated_rows bigint, rejected_rows bigint, reconciled boolean")
    if summary:
        # A rejected row's reasons are those it had by itself and those it gained; counting needs no row that has both.
        reasons = {t: typed[t].select("reasons").union(gained[t].select("_gained")) for t in TABLES}
        quality.write_summary(report, quality.rejection_histogram(reasons), summary)
    elif not all(row[-1] for row in result):
        raise ValueError("layers do not reconcile")
    return report
