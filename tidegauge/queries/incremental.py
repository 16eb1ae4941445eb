"""Incremental and change-data queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.watermarks import (
    epoch_ms_to_timestamp,
    order_key,
    timestamp_to_epoch_ms,
)
from tidegauge.operators.changes import (
    CHANGE_TYPE,
    COMMIT_VERSION,
    apply_changes,
    catch_up,
    latest_per_key,
    live_rows,
    missing_rows,
    upsert,
)
from tidegauge.operators.joins import aggregate_then_join, dimension_join
from tidegauge.plans.ingest import WATERMARK_SCHEMA, ingest
from tidegauge.plans.tables import (
    FeedReader,
    apply_changes_table,
    read_changes,
    recompute,
    upsert_table,
)
from tidegauge.queries.base import Registry, table
from tidegauge.session import scratch
from tidegauge.sources.increments import (
    SOURCE_SCHEMA,
    SOURCE_VALUE,
    extract_increment,
)
from tidegauge.sources.versions import VersionedTable

register = Registry()


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


# -- typed extracts ----------------------------------------------------------------------------


@register(
    "extract_timestamp",
    """
    SELECT o_orderkey, o_custkey, CAST(o_orderdate AS VARCHAR) AS _source_watermark_value
    FROM orders
    WHERE o_orderdate > TIMESTAMP '1998-03-01 00:15:00' - INTERVAL 30 MINUTE
    """,
)
def extract_timestamp(spark, sf_dir):
    rows = extract_increment(
        _orders(spark, sf_dir), "o_orderdate", "timestamp", "1998-03-01 00:15:00", 30
    )
    return rows.select("o_orderkey", "o_custkey", SOURCE_VALUE)


@register(
    "extract_date",
    """
    SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS _source_watermark_value
    FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '1998-02-26'
    """,
)
def extract_date(spark, sf_dir):
    dated = _orders(spark, sf_dir).withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    rows = extract_increment(dated, "o_orderdate", "date", "1998-03-01", 2 * 24 * 60 + 30)
    return rows.select("o_orderkey", SOURCE_VALUE)


@register(
    "extract_epoch_ms",
    """
    SELECT event_id, CAST(epoch_us(ts) // 1000 AS VARCHAR) AS _source_watermark_value
    FROM events WHERE epoch_us(ts) // 1000 > 1705320000000 - 30 * 60000
    """,
)
def extract_epoch_ms(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("ts_ms", timestamp_to_epoch_ms(F.col("ts")))
    rows = extract_increment(events, "ts_ms", "epoch_ms", "1705320000000", 30)
    return rows.select("event_id", SOURCE_VALUE)


@register(
    "extract_bigint",
    """
    SELECT o_orderkey, o_totalprice, CAST(o_orderkey AS VARCHAR) AS _source_watermark_value
    FROM orders WHERE o_orderkey > 999
    """,
)
def extract_bigint(spark, sf_dir):
    rows = extract_increment(_orders(spark, sf_dir), "o_orderkey", "bigint", "999", 30)
    return rows.select("o_orderkey", "o_totalprice", SOURCE_VALUE)


@register(
    "extract_full_load",
    """
    SELECT count(*) AS n, CAST(max(o_orderdate) AS VARCHAR) AS watermark
    FROM orders WHERE o_orderdate IS NOT NULL
    """,
)
def extract_full_load(spark, sf_dir):
    rows = extract_increment(_orders(spark, sf_dir), "o_orderdate", "timestamp", None)
    return rows.agg(
        F.count(F.lit(1)).alias("n"), F.max("o_orderdate").cast("string").alias("watermark")
    )


@register(
    "epoch_normalise",
    """
    SELECT event_id, epoch_us(ts) // 1000 AS ts_ms, date_trunc('millisecond', ts) AS ts_back FROM events
    """,
)
def epoch_normalise(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("ts_ms", timestamp_to_epoch_ms(F.col("ts")))
    back = epoch_ms_to_timestamp(F.col("ts_ms")).cast("timestamp_ntz")
    return events.select("event_id", "ts_ms", back.alias("ts_back"))


@register(
    "composite_order_key",
    """
    SELECT user_id, CAST(max(CAST(epoch_us(ts) AS HUGEINT) * 1000000000000 + event_id) AS VARCHAR)
           AS last_key
    FROM events GROUP BY user_id
    """,
)
def composite_order_key(spark, sf_dir):
    key = order_key(F.col("ts"), F.col("event_id"))
    return (
        table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(F.max(key).cast("string").alias("last_key"))
    )


# -- upsert and ingestion ----------------------------------------------------------------------

_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]


@register(
    "upsert_orders",
    """
    SELECT o_orderkey, o_custkey,
           CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 'U' ELSE o_orderstatus END
               AS o_orderstatus,
           CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_totalprice + 1
                ELSE o_totalprice END AS o_totalprice,
           o_orderdate
    FROM orders
    """,
)
def upsert_orders(spark, sf_dir):
    """Old orders, updated and extended by newer ones that overlap by two years; applied twice."""
    orders = _orders(spark, sf_dir).select(*_ORDER_COLUMNS)
    target = orders.filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    updates = (
        orders.filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
        .withColumn("o_orderstatus", F.lit("U"))
        .withColumn("o_totalprice", F.col("o_totalprice") + 1)
    )
    return upsert(upsert(target, updates, ["o_orderkey"]), updates, ["o_orderkey"])


def order_slices():
    """Slices of a million order keys: new orders touch the last slices only."""
    return F.floor(F.col("o_orderkey") / 1_000_000)


@register(
    "upsert_sliced",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN o_orderdate >= TIMESTAMP '2001-01-01' THEN o_totalprice * 2
                ELSE o_totalprice END AS o_totalprice,
           o_orderdate
    FROM orders
    """,
)
def upsert_sliced(spark, sf_dir):
    """Upsert into a sliced, versioned table; slices without updates are not rewritten."""
    orders = _orders(spark, sf_dir).select(*_ORDER_COLUMNS)
    stored = VersionedTable(spark, scratch(spark, "orders"), order_slices())
    stored.publish(orders)
    recent = orders.filter(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    doubled = recent.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    upsert_table(stored, doubled, ["o_orderkey"], ["o_orderdate"])
    return stored.read()


_CUTOFF = "1999-01-01"


def _run_ingest(spark: SparkSession, sf_dir: str) -> tuple[VersionedTable, VersionedTable, list]:
    """Old orders first, then all of them, then all again; one source is switched off."""
    orders = _orders(spark, sf_dir).select(*_ORDER_COLUMNS)
    registry = spark.createDataFrame(
        [
            ("shop", "orders", "o_orderkey", "o_orderdate", "timestamp", None, None, None),
            ("shop", "broken", "id", "changed", "timestamp", None, 30, True),
            ("shop", "retired", "id", "changed", "timestamp", None, 30, False),
        ],
        SOURCE_SCHEMA,
    )
    target = VersionedTable(spark, scratch(spark, "target"), order_slices())
    control = VersionedTable(spark, scratch(spark, "control"))
    old = orders.filter(F.col("o_orderdate") < F.lit(_CUTOFF).cast("timestamp_ntz"))
    runs = []
    for available in (old, orders, orders):
        def read(source, available=available):
            if source.source_table != "orders":
                raise LookupError(f"no table {source.source_table}")
            return available

        runs.append(ingest(registry, read, lambda source: target, control))
    return target, control, runs


@register(
    "ingest_rerun",
    f"SELECT {', '.join(_ORDER_COLUMNS)} FROM orders WHERE o_orderdate IS NOT NULL",
)
def ingest_rerun(spark, sf_dir):
    target, _, _ = _run_ingest(spark, sf_dir)
    return target.read().select(*_ORDER_COLUMNS)


@register(
    "ingest_status",
    f"""
    WITH highest AS (
        SELECT max(o_orderdate) FILTER (o_orderdate < TIMESTAMP '{_CUTOFF}') AS first_run,
               max(o_orderdate) AS later_runs
        FROM orders
    )
    SELECT 1 AS run, 'orders' AS source_table, 'success' AS status, count(*) AS rows_processed,
           (SELECT CAST(first_run AS VARCHAR) FROM highest) AS watermark_value
    FROM orders WHERE o_orderdate < TIMESTAMP '{_CUTOFF}'
    UNION ALL
    SELECT 2, 'orders', 'success', count(*), (SELECT CAST(later_runs AS VARCHAR) FROM highest)
    FROM orders
    WHERE o_orderdate > (SELECT first_run FROM highest) - INTERVAL 30 MINUTE
    UNION ALL
    SELECT 3, 'orders', 'success', count(*), (SELECT CAST(later_runs AS VARCHAR) FROM highest)
    FROM orders
    WHERE o_orderdate > (SELECT later_runs FROM highest) - INTERVAL 30 MINUTE
    UNION ALL
    SELECT r, 'broken', 'failed', 0, NULL FROM (VALUES (1), (2), (3)) v(r)
    """,
)
def ingest_status(spark, sf_dir):
    _, _, runs = _run_ingest(spark, sf_dir)
    first, second, third = [r.withColumn("run", F.lit(i + 1)) for i, r in enumerate(runs)]
    return first.unionAll(second).unionAll(third).select(
        "run", "source_table", "status", "rows_processed", "watermark_value"
    )


@register(
    "watermark_control",
    """
    SELECT 'shop' AS source_system, 'orders' AS source_table, 'o_orderdate' AS watermark_column,
           CAST(max(o_orderdate) AS VARCHAR) AS watermark_value, 'timestamp' AS watermark_type,
           'success' AS last_run_status, 'tidegauge' AS updated_by
    FROM orders
    UNION ALL
    SELECT 'shop', 'broken', 'changed', '', 'timestamp', 'failed', 'tidegauge'
    """,
)
def watermark_control(spark, sf_dir):
    _, control, _ = _run_ingest(spark, sf_dir)
    timed = ("last_run_timestamp", "rows_processed")
    return control.read().select(*[n for n in WATERMARK_SCHEMA.names if n not in timed])


@register(
    "control_after_failure",
    """
    SELECT 'shop' AS source_system, 'orders' AS source_table,
           CAST(max(o_orderdate) AS VARCHAR) AS watermark_value, 'failed' AS last_run_status,
           CAST(0 AS BIGINT) AS rows_processed
    FROM orders
    """,
)
def control_after_failure(spark, sf_dir):
    """A good run, then one whose source cannot be read: the watermark stays, the status tells."""
    registry = spark.createDataFrame(
        [("shop", "orders", "o_orderkey", "o_orderdate", "timestamp", None, None, None)],
        SOURCE_SCHEMA,
    )
    target = VersionedTable(spark, scratch(spark, "target"))
    control = VersionedTable(spark, scratch(spark, "control"))

    def broken(source):
        raise LookupError("the source is gone")

    for read in (lambda source: _orders(spark, sf_dir).select(*_ORDER_COLUMNS), broken):
        ingest(registry, read, lambda source: target, control)
    return control.read().select(
        "source_system", "source_table", "watermark_value", "last_run_status", "rows_processed"
    )


@register(
    "ingest_date_late",
    """
    SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders
    WHERE o_orderdate IS NOT NULL AND (
        o_orderstatus = 'F' OR CAST(o_orderdate AS DATE) >= (
            SELECT CAST(max(o_orderdate) AS DATE) FROM orders WHERE o_orderstatus = 'F'))
    """,
)
def ingest_date_late(spark, sf_dir):
    """Rows of the watermark's own day that come after the run are still loaded."""
    dated = _orders(spark, sf_dir).select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderstatus"
    )
    registry = spark.createDataFrame(
        [("shop", "orders", "o_orderkey", "o_orderdate", "date", None, None, None)], SOURCE_SCHEMA
    )
    target = VersionedTable(spark, scratch(spark, "target"))
    control = VersionedTable(spark, scratch(spark, "control"))
    for available in (dated.filter("o_orderstatus = 'F'"), dated):
        ingest(registry, lambda source, rows=available: rows, lambda source: target, control)
    return target.read().select("o_orderkey", F.col("o_orderdate").cast("string").alias("day"))


# -- ordered changes ---------------------------------------------------------------------------

_LATEST_EVENT = """
    SELECT user_id, event_id, ts, event_type, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
        FROM events
    ) WHERE rn = 1
"""
_EVENT_COLUMNS = ["user_id", "event_id", "ts", "event_type", "value"]


@register("latest_per_key", _LATEST_EVENT)
def latest_event(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(*_EVENT_COLUMNS)
    return latest_per_key(events, ["user_id"], ["ts", "event_id"])


@register("apply_changes", f"{_LATEST_EVENT} AND event_type <> 'signup'")
def apply_event_changes(spark, sf_dir):
    """Events as changes by user, the newer half applied first; a signup deletes the user's row."""
    events = table(spark, sf_dir, "events").select(*_EVENT_COLUMNS)
    middle = F.lit("2024-01-15").cast("timestamp_ntz")
    sequence, gone = ["ts", "event_id"], F.col("event_type") == "signup"
    newer = apply_changes(None, events.filter(F.col("ts") >= middle), ["user_id"], sequence, gone)
    both = apply_changes(newer, events.filter(F.col("ts") < middle), ["user_id"], sequence, gone)
    return live_rows(both)


@register("apply_changes_stored", f"{_LATEST_EVENT} AND event_type <> 'error'")
def apply_changes_stored(spark, sf_dir):
    """The same into a versioned table, with one batch applied twice."""
    events = table(spark, sf_dir, "events").select(*_EVENT_COLUMNS)
    middle = F.lit("2024-01-15").cast("timestamp_ntz")
    stored = VersionedTable(spark, scratch(spark, "users"), F.floor(F.col("user_id") / 1_000))
    halves = [events.filter(F.col("ts") >= middle), events.filter(F.col("ts") < middle)]
    for batch in (*halves, halves[0]):
        apply_changes_table(
            stored, batch, ["user_id"], ["ts", "event_id"], F.col("event_type") == "error"
        )
    return live_rows(stored.read())


_NULL_KEYS = """
    WITH keyed AS (
        SELECT CASE WHEN event_type IN ('view', 'error') THEN user_id END AS k1, event_id AS k2,
               event_type, ts FROM events)
"""


def _keyed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a first key that is null for all but two types."""
    kinds = F.col("event_type").isin("view", "error")
    return table(spark, sf_dir, "events").select(
        F.when(kinds, F.col("user_id")).alias("k1"), F.col("event_id").alias("k2"), "event_type", "ts"
    )


@register(
    "upsert_null_keys",
    f"""{_NULL_KEYS}
    SELECT k1, k2, CASE WHEN event_type = 'click' THEN 'seen' ELSE event_type END AS event_type, ts
    FROM keyed
    """,
)
def upsert_null_keys(spark, sf_dir):
    """A table sliced by a key that may be null: an upsert of some null slices keeps the others."""
    rows = _keyed_events(spark, sf_dir)
    stored = VersionedTable(spark, scratch(spark, "nulls"), F.floor(F.col("k1") / 100_000))
    first = F.col("event_type").isin("view", "purchase", "click")
    stored.publish(rows.filter(first))
    upsert_table(stored, rows.filter(~first), ["k1", "k2"], ["ts"])
    seen = rows.filter("event_type = 'click'").withColumn("event_type", F.lit("seen"))
    upsert_table(stored, seen, ["k1", "k2"], ["ts"])
    return stored.read()


@register(
    "apply_changes_null_keys",
    f"{_NULL_KEYS} SELECT k1, k2, event_type, ts FROM keyed WHERE event_type <> 'signup'",
)
def apply_changes_null_keys(spark, sf_dir):
    rows = _keyed_events(spark, sf_dir)
    stored = VersionedTable(spark, scratch(spark, "nulls"), F.floor(F.col("k1") / 100_000))
    gone = F.col("event_type") == "signup"
    for kinds in (["view", "signup"], ["click"], ["purchase", "error"], ["view", "signup"]):
        batch = rows.filter(F.col("event_type").isin(kinds))
        apply_changes_table(stored, batch, ["k1", "k2"], ["ts"], gone)
    return live_rows(stored.read())


_CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def _customer_versions(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """v1 all but two segments; v2 adds BUILDING; v3 changes MACHINERY, drops HOUSEHOLD, adds
    FURNITURE."""
    customers = table(spark, sf_dir, "customer").select(*_CUSTOMER)
    segment = F.col("c_mktsegment")
    stored = VersionedTable(
        spark, scratch(spark, "customers"), F.floor(F.col("c_custkey") / 100_000)
    )
    stored.publish(customers.filter(~segment.isin("BUILDING", "FURNITURE")))
    stored.publish(customers.filter(segment != "FURNITURE"))
    changed = F.when(segment == "MACHINERY", F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    stored.publish(customers.filter(segment != "HOUSEHOLD").withColumn("c_acctbal", changed))
    return stored



@register(
    "change_feed",
    f"""
    WITH v1 AS (SELECT * FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'FURNITURE')),
    v2 AS (SELECT * FROM customer WHERE c_mktsegment <> 'FURNITURE'),
    v3 AS (
        SELECT c_custkey, c_name, c_nationkey,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN c_acctbal + 1 ELSE c_acctbal END
                   AS c_acctbal,
               c_mktsegment
        FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'
    ),
    pairs AS (
        SELECT 2 AS version, a, b FROM v1 a FULL JOIN v2 b ON a.c_custkey = b.c_custkey
        UNION ALL
        SELECT 3, a, b FROM v2 a FULL JOIN v3 b ON a.c_custkey = b.c_custkey
    ),
    feed AS (
        SELECT b AS r, 'insert' AS _change_type, version FROM pairs
            WHERE a.c_custkey IS NULL
        UNION ALL SELECT a, 'delete', version FROM pairs WHERE b.c_custkey IS NULL
        UNION ALL SELECT a, 'update_preimage', version FROM pairs
            WHERE a.c_custkey = b.c_custkey AND a IS DISTINCT FROM b
        UNION ALL SELECT b, 'update_postimage', version FROM pairs
            WHERE a.c_custkey = b.c_custkey AND a IS DISTINCT FROM b
    )
    SELECT r.c_custkey, r.c_name, r.c_nationkey, r.c_acctbal, r.c_mktsegment, _change_type,
           version AS _commit_version
    FROM feed
    """,
)
def change_feed_query(spark, sf_dir):
    stored = _customer_versions(spark, sf_dir)
    return read_changes(stored, ["c_custkey"], after=1, on_change="feed")


@register(
    "change_feed_widened",
    """
    SELECT c_custkey, CAST(NULL AS VARCHAR) AS c_mktsegment, 'update_preimage' AS _change_type,
           2 AS _commit_version
    FROM customer WHERE c_mktsegment = 'BUILDING'
    UNION ALL
    SELECT c_custkey, c_mktsegment, 'update_postimage', 2 FROM customer
    WHERE c_mktsegment = 'BUILDING'
    """,
)
def change_feed_widened(spark, sf_dir):
    """The second version adds a column, which is null in what the first one held."""
    customers = table(spark, sf_dir, "customer")
    stored = VersionedTable(spark, scratch(spark, "wider"))
    stored.publish(customers.select("c_custkey"))
    segments = customers.filter("c_mktsegment = 'BUILDING'").select("c_custkey", "c_mktsegment")
    upsert_table(stored, segments, ["c_custkey"])
    return read_changes(stored, ["c_custkey"], after=1, on_change="feed")


@register(
    "feed_consumer",
    """
    SELECT c_custkey, c_acctbal, 'insert' AS _change_type, 1 AS _commit_version, 1 AS run
    FROM customer WHERE c_mktsegment <> 'BUILDING'
    UNION ALL SELECT c_custkey, c_acctbal, 'insert', 2, 2 FROM customer
    WHERE c_mktsegment = 'BUILDING'
    UNION ALL SELECT c_custkey, c_acctbal, 'update_preimage', 3, 2 FROM customer
    WHERE c_mktsegment = 'MACHINERY'
    UNION ALL SELECT c_custkey, c_acctbal + 1, 'update_postimage', 3, 2 FROM customer
    WHERE c_mktsegment = 'MACHINERY'
    """,
)
def feed_consumer(spark, sf_dir):
    """A reader that remembers its place: three runs, the last one with nothing new."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    folder = scratch(spark, "feed")
    stored = VersionedTable(spark, f"{folder}/table", F.floor(F.col("c_custkey") / 100_000))
    reader = FeedReader(stored, f"{folder}/positions", "silver")

    def run(number: int) -> None:
        def handle(feed: DataFrame) -> None:
            feed.withColumn("run", F.lit(number)).write.mode("append").parquet(f"{folder}/seen")

        reader.run(["c_custkey"], handle)

    stored.publish(customers.filter("c_mktsegment <> 'BUILDING'"))
    run(1)
    upsert_table(stored, customers.filter("c_mktsegment = 'BUILDING'"), ["c_custkey"])
    machinery = customers.filter("c_mktsegment = 'MACHINERY'")
    upsert_table(stored, machinery.withColumn("c_acctbal", F.col("c_acctbal") + 1), ["c_custkey"])
    run(2)
    run(3)
    return spark.read.parquet(f"{folder}/seen").drop("c_mktsegment")


@register(
    "skip_change_commits",
    f"""
    SELECT {', '.join(_CUSTOMER)}, 'insert' AS _change_type, 2 AS _commit_version
    FROM customer WHERE c_mktsegment = 'BUILDING'
    """,
)
def skip_change_commits(spark, sf_dir):
    """Commits that update or delete are left out as a whole, their inserts included."""
    stored = _customer_versions(spark, sf_dir)
    feed = read_changes(stored, ["c_custkey"], after=1, on_change="skip")
    return feed.select(*_CUSTOMER, CHANGE_TYPE, COMMIT_VERSION)


@register(
    "read_modes",
    """
    SELECT 'previous' AS mode, count(*) AS n, round(sum(c_acctbal), 2) AS acctbal
    FROM customer WHERE c_mktsegment <> 'FURNITURE'
    UNION ALL
    SELECT 'current', count(*),
           round(sum(CASE WHEN c_mktsegment = 'MACHINERY' THEN c_acctbal + 1 ELSE c_acctbal END), 2)
    FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'
    """,
)
def read_modes(spark, sf_dir):
    stored = _customer_versions(spark, sf_dir)

    def summed(df: DataFrame, mode: str) -> DataFrame:
        return df.agg(
            F.lit(mode).alias("mode"),
            F.count(F.lit(1)).alias("n"),
            F.round(F.sum("c_acctbal"), 2).alias("acctbal"),
        )

    return summed(stored.previous(), "previous").unionAll(summed(stored.read(), "current"))


@register(
    "catch_up",
    "SELECT event_id, user_id, ts, event_type FROM events",
)
def catch_up_events(spark, sf_dir):
    """Silver lost one event type of the first ten days as late; the catch-up puts it back."""
    bronze = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    early = F.col("ts") < F.lit("2024-01-11").cast("timestamp_ntz")
    silver = bronze.filter(~(early & (F.col("event_type") == "error")))
    return catch_up(bronze, silver, ["event_id"], ["ts"])


@register(
    "missing_rows",
    """
    SELECT event_id, user_id, ts FROM events
    WHERE ts < TIMESTAMP '2024-01-11' AND event_type = 'error'
    """,
)
def missing_events(spark, sf_dir):
    bronze = table(spark, sf_dir, "events")
    early = F.col("ts") < F.lit("2024-01-11").cast("timestamp_ntz")
    silver = bronze.filter(~(early & (F.col("event_type") == "error")))
    return missing_rows(bronze, silver, ["event_id"]).select("event_id", "user_id", "ts")


# -- recomputed views --------------------------------------------------------------------------


@register(
    "recompute_view",
    """
    SELECT n_name, c_mktsegment, count(*) AS orders, round(sum(o_totalprice), 2) AS revenue
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name, c_mktsegment
    """,
)
def recompute_view(spark, sf_dir):
    """Orders by nation and segment, recomputed and published; the last version is read."""

    def query() -> DataFrame:
        price = F.col("o_totalprice").cast("decimal(18,2)")
        per_customer = aggregate_then_join(
            _orders(spark, sf_dir),
            ["o_custkey"],
            [F.count(F.lit(1)).alias("orders"), F.sum(price).alias("revenue")],
            table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"),
            ["c_custkey"],
        ).withColumnRenamed("c_nationkey", "n_nationkey")
        nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
        return (
            dimension_join(per_customer, nations, ["n_nationkey"], "inner")
            .groupBy("n_name", "c_mktsegment")
            .agg(
                F.sum("orders").alias("orders"),
                F.sum("revenue").cast("double").alias("revenue"),
            )
        )

    view = VersionedTable(spark, scratch(spark, "view"))
    recompute(view, query)
    recompute(view, query)
    return view.read()


@register(
    "csv_dimension",
    "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey",
)
def csv_dimension(spark, sf_dir):
    """A dimension through a CSV file with header, read back under a fixed schema."""
    nations, regions = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    joined = nations.join(regions, nations.n_regionkey == regions.r_regionkey)
    rows = joined.select("n_nationkey", "n_name", "r_name")
    folder = scratch(spark, "dimension")
    rows.write.option("header", True).csv(folder)
    return spark.read.schema(rows.schema).option("header", True).csv(folder)
