"""Writing and incrementally loading warehouse tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, functions as F

from listenhouse.functions.time import hour_start
from listenhouse.operators.joins import new_rows
from listenhouse.sources.tables import read_table, table_exists

FILE_FORMATS = ("parquet", "orc", "json", "csv")


def write_table(
    df: DataFrame, name: str, mode: str = "append", format: str | None = None,
    partition_by: Sequence[str] = (), **options: str,
) -> int:
    """Write and return the number of rows written.

    The count is observed during the write; nothing is computed twice.
    """
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if format is None:
        writer.options(**options).saveAsTable(name)
    elif format in FILE_FORMATS:
        writer.format(format).options(**options).save(name)
    else:
        writer.format(format).options(table=name, **options).save()
    return seen.get["rows"]


def append_new(
    incoming: DataFrame, name: str, keys: Sequence[str], format: str | None = "parquet",
    **options: str,
) -> int:
    """Create the table, or append only rows with a key it does not hold.

    A second run with the same input appends nothing. Keys that are known keep
    their stored row; ``scd2_merge`` brings changes in.
    """
    spark = incoming.sparkSession
    if table_exists(spark, name, format, **options):
        incoming = new_rows(incoming, read_table(spark, name, format, **options), keys)
    return write_table(incoming, name, "append", format, **options)


def overwrite(df: DataFrame, name: str, format: str | None = "parquet", **options: str) -> int:
    return write_table(df, name, "overwrite", format, **options)


def with_event_hour(facts: DataFrame, ts: str = "Timestamp") -> DataFrame:
    return facts.withColumns({"event_date": F.to_date(ts), "event_hour": hour_start(ts)})


def write_by_hour(
    facts: DataFrame, path: str, mode: str = "overwrite", granularity: str = "day"
) -> int:
    """Fact table partitioned by event time.

    By day unless asked for hours: at scale hours give many small files. The
    rebalance hint lets AQE gather the rows of a partition into few files and
    still split a partition that is too large for one task.
    """
    column = {"day": "event_date", "hour": "event_hour"}[granularity]
    rows = with_event_hour(facts).hint("rebalance", column)
    return write_table(rows, path, mode, "parquet", [column])


def changed_days(facts: DataFrame, stored: DataFrame) -> list[date | None]:
    """The days whose rows differ from those stored, told by count and checksum.

    ``facts`` covers all events so far; a day that has fewer rows than are stored is an error. At most one value per
    day reaches the driver.
    """
    columns = [c for c in facts.columns if c != "event_date"]
    digest = F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))
    old, new = (
        df.groupBy("event_date").agg(F.count(F.lit(1)).alias(f"{n}_rows"), digest.alias(f"{n}_sum"))
        for df, n in ((stored.select(*columns, "event_date"), "old"), (facts, "new"))
    )
    days = new.alias("n").join(old.alias("o"), F.col("n.event_date").eqNullSafe(F.col("o.event_date")), "full")
    differ = days.where("not (old_rows <=> new_rows and old_sum <=> new_sum)")
    found = differ.select(F.coalesce("n.event_date", "o.event_date"), F.expr("old_rows > coalesce(new_rows, 0)")).collect()
    if any(fewer for _, fewer in found):
        raise ValueError("facts have to cover all events that are stored; load from the whole landed table")
    return [day for day, _ in found]
