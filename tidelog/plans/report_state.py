"""The access report kept up by deliveries: a stored, mergeable state per day.

A delivery's silver lines are read once more, aggregated by day and added to the state
as one folder; nothing of earlier deliveries is read or rewritten but the client
numbers.  Report, top clients and distinct clients of any range of days are merged from
the state alone.

``<base>/deliveries/delivery=<id>/kind=<kind>`` holds, per event day (null for lines
without a time), sorted by day, so that a range of days skips the row groups of others:

* ``client``: hits per client, ``page``: hits per page (assets left out), ``day``: the
  row of ``daily_rollup``;
* ``bitmap``: the day's clients as bitmaps over their numbers (32,768 clients a row),
  which merge by OR: exact distinct counts without shuffling a client;
* ``sketch`` (with ``sketches=True``): one HyperLogLog sketch of the day's clients.

``<base>/clients`` numbers the clients.  New ones are dealt to ``NUMBER_BUCKETS`` by hash
and numbered inside their bucket behind the ones it has, so numbers stay dense and no
task orders all clients.  Numbers are never taken back.

A delivery is written to a staging folder and moved into place as a whole; the same id
again replaces it.  Null clients count as lines, not as clients.  One writer at a time.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.functions.http import event_day, is_page
from tidelog.operators.metrics import daily_rollup
from tidelog.operators.report import report_of
from tidelog.plans.tables import move_path, path_exists, remove_path

STATE_SCHEMA = ("key string, hits long, client_errors long, size_sum double, size_max double, size_min double, "
                "size_n long, bucket long, bits binary, date date, delivery string, kind string")
CLIENT_SCHEMA = "client_ip string, number long, delivery string"
NUMBER_BUCKETS = 1024
LG_SKETCH = 12  # of a HyperLogLog sketch: 4,096 registers
_COLUMNS = [c.split()[0] for c in STATE_SCHEMA.split(", ")]


def _rows(df: DataFrame, kind: str) -> DataFrame:
    types = dict(c.split() for c in STATE_SCHEMA.split(", "))
    return df.withColumn("kind", F.lit(kind)).select(
        *[(F.col(c) if c in df.columns or c == "kind" else F.lit(None)).cast(types[c]).alias(c)
          for c in _COLUMNS if c != "delivery"])


def hits_by_day(silver: DataFrame) -> DataFrame:
    """``(date, key, hits)``: lines per day and client."""
    lines = silver.select(event_day(F.col("timestamp")).alias("date"), F.col("client_ip").alias("key"))
    return lines.groupBy("date", "key").agg(F.count(F.lit(1)).alias("hits"))


def page_hits_by_day(silver: DataFrame) -> DataFrame:
    pages = silver.filter(is_page(F.col("endpoint_clean"))).select(
        event_day(F.col("timestamp")).alias("date"), F.col("endpoint_clean").alias("key"))
    return pages.groupBy("date", "key").agg(F.count(F.lit(1)).alias("hits"))


def bitmaps_by_day(hits: DataFrame, numbers: DataFrame) -> DataFrame:
    """``(date, bucket, bits)``: the clients of each day as bits at their numbers."""
    numbered = hits.select("date", "key").join(numbers, F.col("key") == F.col("client_ip"))
    return numbered.groupBy("date", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


class ReportState:
    """The stored state under ``base`` (shared storage)."""

    def __init__(self, spark: SparkSession, base: str, sketches: bool = False):
        self.spark, self.base, self.sketches = spark, base.rstrip("/"), sketches

    # --- writing -------------------------------------------------------------------

    def add(self, silver: DataFrame, delivery: str) -> None:
        """Add a delivery's lines, or replace what was added under the same id."""
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", delivery):
            raise ValueError(f"not a delivery id: {delivery!r}")
        staging = f"{self.base}/_staging/{delivery}-{uuid.uuid4().hex[:8]}"
        parts = _rows(hits_by_day(silver), "client").unionByName(_rows(page_hits_by_day(silver), "page"))
        self._write(parts.unionByName(_rows(daily_rollup(silver), "day")), staging)
        hits = self._read(staging).filter("kind = 'client' AND key IS NOT NULL")
        self._number(hits.select(F.col("key").alias("client_ip")).distinct(), delivery)
        more = _rows(bitmaps_by_day(hits, self.clients()), "bitmap")
        if self.sketches:
            sketch = hits.groupBy("date").agg(F.hll_sketch_agg("key", LG_SKETCH).alias("bits"))
            more = more.unionByName(_rows(sketch, "sketch"))
        self._write(more, staging)
        target = f"{self.base}/deliveries/delivery={delivery}"
        remove_path(self.spark, target)
        move_path(self.spark, staging, target)

    def _write(self, rows: DataFrame, path: str) -> None:
        # a day's rows in few files, large days split by size
        rows = rows.hint("rebalance", "kind", "date").sortWithinPartitions("kind", "date")
        rows.write.mode("append").partitionBy("kind").parquet(path)

    def _number(self, found: DataFrame, delivery: str) -> None:
        known = self.clients()
        bucket = F.pmod(F.xxhash64("client_ip"), F.lit(NUMBER_BUCKETS))
        new = found.join(known, "client_ip", "left_anti").withColumn("bucket", bucket)
        used = known.groupBy(F.pmod("number", F.lit(NUMBER_BUCKETS)).alias("bucket")).agg(
            (F.max(F.floor(F.col("number") / NUMBER_BUCKETS)) + 1).alias("used"))
        place = F.row_number().over(Window.partitionBy("bucket").orderBy("client_ip")) - 1
        number = (F.coalesce("used", F.lit(0)) + place) * NUMBER_BUCKETS + F.col("bucket")
        rows = new.join(used, "bucket", "left").select("client_ip", number.cast("long").alias("number"))
        rows.write.parquet(f"{self.base}/clients/delivery={delivery}-{uuid.uuid4().hex[:8]}")

    # --- reading -------------------------------------------------------------------

    def _read(self, path: str) -> DataFrame:
        return self.spark.read.schema(STATE_SCHEMA).parquet(path)

    def clients(self) -> DataFrame:
        """``(client_ip, number)`` of all clients so far."""
        path = f"{self.base}/clients"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], CLIENT_SCHEMA).select("client_ip", "number")
        return self.spark.read.schema(CLIENT_SCHEMA).parquet(path).select("client_ip", "number")

    def rows(self, kind: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
        """The state's rows of a kind; with ``first`` or ``last``, of the days from and to it
        (lines without a time are in no range)."""
        path = f"{self.base}/deliveries"
        found = self._read(path) if path_exists(self.spark, path) else self.spark.createDataFrame([], STATE_SCHEMA)
        found = found.filter(F.col("kind") == kind)
        if first is not None:
            found = found.filter(F.col("date") >= F.lit(first))
        return found if last is None else found.filter(F.col("date") <= F.lit(last))

    def daily(self, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
        """``daily_rollup`` of all deliveries."""
        return self.rows("day", first, last).groupBy("date").agg(
            F.sum("client_errors").alias("client_errors"), F.sum("size_sum").alias("size_sum"),
            F.max("size_max").alias("size_max"), F.min("size_min").alias("size_min"), F.sum("size_n").alias("size_n"))

    def hits(self, kind: str, name: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
        """Hits per client (``client``) or page (``page``), the key named ``name``."""
        return self.rows(kind, first, last).groupBy(F.col("key").alias(name)).agg(F.sum("hits").alias("access_count"))

    def report(self, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
        """The gold report of all deliveries, or of a range of their days."""
        return report_of(self.hits("client", "client_ip", first, last), self.hits("page", "endpoint", first, last),
                         self.daily(first, last))

    def distinct_counts(self, first: dt.date | None = None, last: dt.date | None = None,
                        approximate: bool = False) -> DataFrame:
        """One row: ``distinct_ip_count`` and ``distinct_day_count``, of all lines or of a range
        of days.  Exact from the bitmaps; ``approximate`` merges the sketches instead."""
        days = self.rows("day", first, last).agg(F.count_distinct("date").alias("distinct_day_count"))
        if approximate:
            merged = self.rows("sketch", first, last).agg(F.hll_union_agg("bits").alias("bits"))
            found = merged.select(F.coalesce(F.hll_sketch_estimate("bits"), F.lit(0)).alias("distinct_ip_count"))
        else:
            found = _members(self.rows("bitmap", first, last).groupBy("bucket")).agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("distinct_ip_count"))
        return found.select("distinct_ip_count", days.scalar().alias("distinct_day_count"))

    def rolling_clients(self, days: int = 7) -> DataFrame:
        """``(date, distinct_ip_count)``: for each day with lines, the distinct clients of the
        ``days`` days that end with it, from the bitmaps."""
        ends = self.rows("bitmap").select(
            F.explode(F.sequence("date", F.date_add("date", days - 1))).alias("end"), "bucket", "bits")
        counts = _members(ends.groupBy("end", "bucket")).groupBy("end").agg(F.sum("n").alias("distinct_ip_count"))
        known = self.rows("day").filter("date IS NOT NULL").select("date").distinct()
        return known.join(counts, F.col("date") == F.col("end"), "left").select(
            "date", F.coalesce("distinct_ip_count", F.lit(0)).alias("distinct_ip_count"))


def _members(grouped) -> DataFrame:
    return grouped.agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))


def incremental_report(state_path: str, sketches: bool = False):
    """A ``gold_builder`` that adds the run's silver to the state and reports on all
    deliveries.  The delivery's id is the run instant on its lines, so a gold stage that
    runs again over the same silver replaces its delivery."""

    def build(silver: DataFrame) -> DataFrame:
        state = ReportState(silver.sparkSession, state_path, sketches)
        stamp = silver.agg(F.date_format(F.max("processed_timestamp"), "yyyyMMdd'T'HHmmss.SSSSSS")).first()[0]
        if stamp is not None:
            state.add(silver, stamp)
        return state.report()

    return build
