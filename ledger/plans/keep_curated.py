"""Keep the layers up to date batch by batch, judging again only what a batch can change.

The state below one folder holds the text of every row of the raw history once, as it came, and apart from it the slim rows that judging
looks at, as last judged, in files by key bucket: customers and products by their key, orders and payments by order id, so that all rows
an amount check looks at lie together.  Texts are written by the step that takes them in and not read again before a layer is asked for.  Side tables say in which
bucket the orders of a customer or a product lie, and under which orders the versions of a payment.  A manifest names the folder
that holds each bucket now.

A batch changes
- the versions of the keys in it;
- whether a customer or product key counts as valid: the orders that refer to keys for which this turns are judged again;
- everything of the order ids met so far: those of the batch's orders and payments, of earlier versions of its payments, and of the orders that refer to a key that turned.

Rows outside keep their reasons: none depends on anything else.  Only buckets with such rows are read and written anew, beside the
old ones; the manifest comes last, so a run that stops halfway changes nothing and is repeated by the next one.
The buckets a batch meets are a list of at most ``buckets`` numbers per table, which the driver turns into paths.
"""

from __future__ import annotations

from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledger.operators import relate
from ledger.operators.lookup import with_match_flag
from ledger.operators.validate import VALIDATORS
from ledger.plans.curate import SLIM
from ledger.schemas import KEYS, TABLES, columns, timestamps
from ledger.session import remove_scratch, scratch, stage, together
from ledger.sources.control import completed_runs
from ledger.sources.manifest import next_number, read_manifest, write_manifest
from ledger.sources.raw import read_raw_versions
from ledger.sources.sinks import curated_rows, rejected_rows, write_curated, write_rejected

BUCKETS = 256
HOME = {"customers": "t_customer_id", "products": "t_product_id", "orders": "t_order_id", "payments": "t_order_id"}
#: Side tables: where rows lie, found by another key than the one they are kept by.
SIDES = {
    "orders_by_customer": ("orders", "t_customer_id"), "orders_by_product": ("orders", "t_product_id"),
    "payments_by_id": ("payments", "t_payment_id"),
}
SEQ = "struct<batch:bigint,done:bigint,part:bigint,file:bigint,block:bigint,row:bigint>"
#: What tells a row from all others: the step that took it in, and its place in the input.
ROW = ["_step", "_seq"]
MANIFEST = "kind string, name string, bucket int, folder string, curated bigint, rejected bigint"
KNOWN = {"orders": ["_knows_customer", "_knows_product"]}


class State:
    """What the current manifest says."""

    def __init__(self, spark: SparkSession, root: str, buckets: int):
        self.spark, self.root = spark, root
        found = read_manifest(spark, root)
        rows = [] if found is None else found.collect()
        self.buckets = next((r["bucket"] for r in rows if r["kind"] == "buckets"), buckets)
        self.runs = {r["name"] for r in rows if r["kind"] == "run"}
        self.tables = {t: {r["bucket"]: r for r in rows if r["kind"] == "table" and r["name"] == t} for t in TABLES}
        self.texts = {t: [r["folder"] for r in rows if r["kind"] == "text" and r["name"] == t] for t in TABLES}
        self.sides: dict[str, dict[int, list[str]]] = {s: {} for s in SIDES}
        for r in rows:
            if r["kind"] == "side":
                self.sides[r["name"]].setdefault(r["bucket"], []).append(r["folder"])
        self.number = next_number(spark, root)
        #: Folders of a run of its own: a run that stopped halfway leaves its folders behind.
        self.step = f"step={self.number}-{uuid4().hex[:8]}"

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def home(self, table: str) -> Column:
        """Rows without a key are spread by their place in the input."""
        return F.when(F.col(HOME[table]).isNotNull(), self.bucket(F.col(HOME[table]))).otherwise(self.bucket(F.col("_seq")))

    def read(self, table: str, buckets: set[int] | None, schema) -> DataFrame:
        """Slim rows of the given buckets, of all for None."""
        own = self.tables[table]
        paths = [f"{self.root}/{r['folder']}/bucket={b}" for b, r in own.items() if buckets is None or b in buckets]
        return self._load(paths, schema)

    def text(self, table: str, schema) -> DataFrame:
        return self._load([f"{self.root}/{f}" for f in self.texts[table]], schema)

    def side(self, name: str, buckets: set[int]) -> DataFrame:
        paths = [f"{self.root}/{f}/bucket={b}" for b, folders in self.sides[name].items() if b in buckets for f in folders]
        return self._load(paths, "key bigint, order_id bigint, home int")

    def _load(self, paths: list[str], schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)


def _distinct(df: DataFrame, number: Column) -> set[int]:
    """Bucket numbers: at most as many as there are buckets."""
    return {r[0] for r in df.select(number.alias("b")).distinct().collect()}


def _append(df: DataFrame, found: Column, reason: str) -> DataFrame:
    return df.withColumn("reasons", F.when(found & ~F.array_contains("reasons", reason), F.array_append("reasons", F.lit(reason))).otherwise(F.col("reasons")))


def _union(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _unjudged(df: DataFrame) -> DataFrame:
    """Back to the reasons that a row has by itself."""
    return df.withColumn("reasons", F.col("checked"))


def update_layers(spark: SparkSession, raw: str, root: str, buckets: int = BUCKETS, escape: str = '"', multi_line: bool = True) -> DataFrame:
    """Take the full extract and the completed batches that the state below ``root`` has not seen yet into it.

    ``buckets`` counts for the first run and is kept: about one per million rows of the largest table.  Returns one row per table:
    ``new_rows``, ``judged_again`` (rows met before), ``buckets_written``, ``raw_rows``, ``curated_rows``, ``rejected_rows``, ``reconciled``.
    Raises, and leaves the state as it was, if rows were lost or doubled.
    """
    state, work = State(spark, root, buckets), scratch(spark, "keep")
    try:
        return _update(spark, raw, state, work, escape, multi_line)
    finally:
        remove_scratch(spark, work)


def _update(spark: SparkSession, raw: str, state: State, work: str, escape: str, multi_line: bool) -> DataFrame:
    seen = spark.createDataFrame([(r,) for r in state.runs], "_run string")
    every = completed_runs(spark, raw).select("_run").union(spark.createDataFrame([("",)], "_run string"))
    runs = stage(every.join(seen, "_run", "left_anti").distinct(), f"{work}/runs")

    def type_rows(table: str) -> tuple[DataFrame, int]:
        read = Observation()
        rows = VALIDATORS[table](read_raw_versions(spark, raw, table, escape, multi_line, runs).observe(read, F.count(F.lit(1)).alias("rows")))
        kept = dict.fromkeys([*columns(table), "_seq", *SLIM[table], *[f"t_{c}" for c in timestamps(table)]])
        # Texts stay where they are written first; what follows reads the slim columns of the same files.
        out = stage(
            rows.select(*kept, F.lit(state.number).cast("bigint").alias("_step"), F.col("reasons").alias("checked")),
            f"{state.root}/{table}_text/{state.step}")
        known = [F.lit(None).cast("boolean").alias(c) for c in KNOWN.get(table, [])]
        slim = out.select(*ROW, *SLIM[table], *known, "checked", F.col("checked").alias("linked"), F.col("checked").alias("reasons"))
        return slim, read.get["rows"]

    typed = together(spark, type_rows, TABLES)
    new = {t: typed[t][0] for t in TABLES}
    schemas = {t: new[t].schema for t in TABLES}
    written: dict[str, DataFrame] = {}
    again: dict[str, int] = {}
    turned: dict[str, DataFrame] = {}

    def write(table: str, rest: DataFrame, judged: DataFrame) -> None:
        """The touched buckets with the rows that stay and those judged."""
        folder = f"{table}/{state.step}"
        rows = _union(rest, judged.select(*rest.columns)).withColumn("bucket", state.home(table))
        # A bucket too large for one task goes into several files of its folder.
        rows.hint("rebalance", "bucket").write.mode("errorifexists").partitionBy("bucket").parquet(f"{state.root}/{folder}")
        written[table] = spark.read.schema(rows.schema).parquet(f"{state.root}/{folder}")

    for table in ("customers", "products"):
        key = HOME[table]
        keys = stage(new[table].filter(F.col(key).isNotNull()).select(F.col(key).alias("_key")).distinct(), f"{work}/keys/{table}")
        old = state.read(table, _distinct(new[table], state.home(table)), schemas[table])
        marked = stage(with_match_flag(old, keys, "_key", key, "_hit", "_seq"), f"{work}/old/{table}")
        hit, rest = marked.filter("_hit").drop("_hit"), marked.filter("not _hit").drop("_hit")
        judged = relate.reject_superseded(_unjudged(_union(hit, new[table])), key)
        judged = stage(judged.withColumn("linked", F.col("reasons")), f"{work}/judged/{table}")
        before, after = relate.valid_keys(hit, key), relate.valid_keys(judged, key)
        turned[table] = stage(
            before.select(F.col(key).alias("_key"), F.lit(-1).alias("_way")).union(after.select(F.col(key), F.lit(1)))
            .groupBy("_key").agg(F.sum("_way").alias("_way")).filter(F.col("_way") != 0), f"{work}/turned/{table}")
        again[table] = marked.filter("_hit").count()
        write(table, rest, judged)

    # Order ids whose orders or payments may be judged otherwise now, and the buckets of rows without an order id.
    referring = {
        t: state.side(side, _distinct(turned[t], state.bucket(F.col("_key")))).join(turned[t], F.col("key") == F.col("_key"), "left_semi")
        for t, side in (("customers", "orders_by_customer"), ("products", "orders_by_product"))
    }
    refs = stage(_union(*referring.values()), f"{work}/referring")
    ids = stage(new["payments"].filter(F.col("t_payment_id").isNotNull()).select(F.col("t_payment_id").alias("_key")).distinct(), f"{work}/payment-ids")
    versions = stage(
        state.side("payments_by_id", _distinct(ids, state.bucket(F.col("_key")))).join(ids, F.col("key") == F.col("_key"), "left_semi"), f"{work}/versions")
    affected = stage(
        _union(*[df.select(F.col(c).alias("_key")) for df, c in (
            (new["orders"], "t_order_id"), (new["payments"], "t_order_id"), (refs, "order_id"), (versions, "order_id"))])
        .filter(F.col("_key").isNotNull()).distinct(), f"{work}/affected")
    near = _distinct(affected, state.bucket(F.col("_key")))

    def orders() -> DataFrame:
        touched = near | _distinct(refs, F.col("home")) | _distinct(new["orders"], state.home("orders"))
        rows = with_match_flag(state.read("orders", touched, schemas["orders"]), affected, "_key", "t_order_id", "_hit", "_seq")
        known = {"customers": "_knows_customer", "products": "_knows_product"}
        for t, column in known.items():
            for way, flag in ((1, "_on"), (-1, "_off")):
                rows = with_match_flag(rows, turned[t].filter(F.col("_way") == way).select("_key"), "_key", HOME[t], flag, "_seq")
            rows = (
                rows.withColumn("_hit", F.col("_hit") | F.col("_on") | F.col("_off"))
                .withColumn(column, F.when(F.col("_on"), True).when(F.col("_off"), False).otherwise(F.col(column))).drop("_on", "_off"))
        marked = stage(rows, f"{work}/old/orders")
        fresh = new["orders"]
        for t, column in known.items():
            wanted = fresh.filter(F.col(HOME[t]).isNotNull()).select(F.col(HOME[t]).alias("_key")).distinct()
            around = _distinct(wanted, state.bucket(F.col("_key")))
            kept = around - _distinct(written[t], F.col("bucket"))
            slim = [HOME[t], "reasons"]
            rows_now = _union(state.read(t, kept, schemas[t]).select(*slim), written[t].filter(F.col("bucket").isin(*around) if around else F.lit(False)).select(*slim))
            fresh = with_match_flag(fresh.drop(column), relate.valid_keys(rows_now, HOME[t]), HOME[t], HOME[t], column, "_seq")
        rows = relate.reject_superseded(_unjudged(_union(marked.filter("_hit").drop("_hit"), fresh)), "t_order_id")
        for t, column, reason in (("customers", "_knows_customer", relate.UNKNOWN_CUSTOMER), ("products", "_knows_product", relate.UNKNOWN_PRODUCT)):
            rows = _append(rows, F.col(HOME[t]).isNotNull() & ~F.coalesce(F.col(column), F.lit(False)), reason)
        again["orders"] = marked.filter("_hit").count()
        return stage(rows.withColumn("linked", F.col("reasons")), f"{work}/linked/orders"), marked.filter("not _hit").drop("_hit")

    def payments() -> DataFrame:
        touched = near | _distinct(versions, F.col("home")) | _distinct(new["payments"], state.home("payments"))
        rows = with_match_flag(state.read("payments", touched, schemas["payments"]), affected, "_key", "t_order_id", "_hit", "_seq")
        marked = stage(with_match_flag(rows, ids, "_key", "t_payment_id", "_version", "_seq"), f"{work}/old/payments")
        hit = F.col("_hit") | F.col("_version")
        # All versions of the batch's payments are at hand; the others keep what was found among theirs.
        whole = relate.reject_superseded(_unjudged(_union(marked.filter("_version").drop("_hit", "_version"), new["payments"])), "t_payment_id")
        other = marked.filter(F.col("_hit") & ~F.col("_version")).drop("_hit", "_version").withColumn("reasons", F.col("linked"))
        again["payments"] = marked.filter(hit).count()
        rows = _union(whole, other.select(*whole.columns))
        return stage(rows.withColumn("linked", F.col("reasons")), f"{work}/linked/payments"), marked.filter(~hit).drop("_hit", "_version")

    (linked_orders, rest_orders), (linked_payments, rest_payments) = orders(), payments()
    wrong = stage(relate.amount_mismatches(linked_orders, linked_payments), f"{work}/mismatches")
    write("orders", rest_orders, relate.flag_orders(linked_orders, wrong, True))
    # The orders of the judged payments' ids are all among those judged here.
    write("payments", rest_payments, relate.flag_payments(linked_payments, linked_orders, wrong))

    def write_side(name: str) -> list[tuple]:
        table, key = SIDES[name]
        folder = f"{name}/{state.step}"
        rows = new[table].filter(F.col(key).isNotNull()).select(
            F.col(key).alias("key"), F.col("t_order_id").alias("order_id"), state.home(table).alias("home"), state.bucket(F.col(key)).alias("bucket"))
        rows.distinct().repartition("bucket").write.mode("errorifexists").partitionBy("bucket").parquet(f"{state.root}/{folder}")
        return [("side", name, b, folder, None, None) for b in sorted(_distinct(spark.read.schema(rows.schema).parquet(f"{state.root}/{folder}"), F.col("bucket")))]

    sides = together(spark, write_side, SIDES)
    manifest = [("buckets", "", state.buckets, "", None, None), *(("run", r, None, "", None, None) for r in {*state.runs, *(x["_run"] for x in runs.collect())})]
    for table, folders in state.texts.items():
        own = [f"{table}_text/{state.step}"] if typed[table][1] else []
        manifest += [("text", table, None, f, None, None) for f in (*folders, *own)]
    for name, own in state.sides.items():
        manifest += [("side", name, b, f, None, None) for b, folders in own.items() for f in folders] + sides[name]
    result = []
    for table in TABLES:
        counts = written[table].groupBy("bucket").agg(
            F.count_if(F.size("reasons") == 0).alias("curated"), F.count_if(F.size("reasons") > 0).alias("rejected")).collect()
        now = {b: (r["folder"], r["curated"], r["rejected"]) for b, r in state.tables[table].items()}
        earlier = sum(c + j for _, c, j in now.values())
        now |= {r["bucket"]: (f"{table}/{state.step}", r["curated"], r["rejected"]) for r in counts}
        manifest += [("table", table, b, *v) for b, v in now.items()]
        curated, rejected = sum(v[1] for v in now.values()), sum(v[2] for v in now.values())
        raw_rows = earlier + typed[table][1]
        if curated + rejected != raw_rows:
            raise ValueError(f"layers do not reconcile: {table} has {raw_rows} raw, {curated} curated and {rejected} rejected rows")
        result.append((table, typed[table][1], again[table], len(counts), raw_rows, curated, rejected, True))
    write_manifest(spark.createDataFrame(manifest, MANIFEST), state.root, state.number)
    return spark.createDataFrame(
        result, "table_name string, new_rows bigint, judged_again bigint, buckets_written bigint, raw_rows bigint, curated_rows bigint, "
        "rejected_rows bigint, reconciled boolean")


def current_rows(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Every row of the state with its final ``reasons``, the fields as text and typed timestamps."""
    state, found = State(spark, root, BUCKETS), {}
    for table in TABLES:
        text = ", ".join(f"{c} string" for c in columns(table))
        times = ", ".join(f"t_{c} timestamp" for c in timestamps(table))
        rows = state.text(table, f"{text}, {times}, _step bigint, _seq {SEQ}")
        found[table] = rows.join(state.read(table, None, f"_step bigint, _seq {SEQ}, reasons array<string>"), ROW).drop(*ROW)
    return found


def current_layers(spark: SparkSession, root: str) -> dict[str, tuple[DataFrame, DataFrame]]:
    """(curated, rejected) rows of each table, as the layers hold them."""
    return {t: (curated_rows(df, t), rejected_rows(df, t)) for t, df in current_rows(spark, root).items()}


def publish_layers(spark: SparkSession, root: str, targets: dict[str, tuple[str, str]]) -> None:
    """Write the layers as files to ``targets`` (curated and rejected folder of each table), create-only."""
    rows = current_rows(spark, root)
    for table, (curated, rejected) in targets.items():
        write_curated(rows[table], curated, table)
        write_rejected(rows[table], rejected, table)
