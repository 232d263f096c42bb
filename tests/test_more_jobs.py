"""Models, streams into the warehouse, compaction, supervision, and the jobs on a connector."""

import pytest
from pyspark.sql import functions as F

from listenhouse.plans import jobs
from listenhouse.plans.models import Model, build_models, build_order, sql_model
from listenhouse.sinks.compact import compact, file_sizes
from listenhouse.sinks.store import Store
from listenhouse.sources import testdata
from listenhouse.streaming.supervise import Supervisor
from tests.connector import Shelf, manifest
from tests.test_store import rows

SF_DIR = "/root/testdata/sf0.001"


def test_jobs_on_a_connector(spark, folder):
    """Two loads through a data source of Python give the tables of two loads in files."""
    spark.dataSource.register(Shelf)
    events = jobs.with_row_hash(testdata.listen_events(spark, SF_DIR).withColumn("itemInSession", F.col("event_id")).withColumn("ts", F.col("ts").cast("timestamp"))).cache()
    early = F.col("event_id") % 3 > 0
    shelf = Store(spark, "wh", "shelf", {"root": folder}, missing="no such shelf")
    files = Store(spark, f"{folder}/files")
    for store in (shelf, files):
        for batch, landed, days in ((events.where(early), events.where(early), None), (events.where(~early), events, jobs.days_of(events.where(~early)))):
            jobs.load_dimensions(spark, batch, store, landed=landed)
            jobs.load_fact(spark, landed, store, days=days)
    for table in ("fact_streams", "dim_user", "dim_session", "dim_user_history", "dim_location"):
        assert rows(shelf.read(table)) == rows(files.read(table)), table
    before = manifest(folder, "wh.dim_user")
    with pytest.raises(Exception, match="killed"):
        shelf.append(shelf.read("dim_user").withColumn("userId", F.raise_error(F.lit("killed")).cast("bigint")), "dim_user")
    assert manifest(folder, "wh.dim_user") == before


def test_models_in_order(spark, folder):
    built = []

    def of(name):
        return lambda refs: built.append(name) or next(iter(refs.values())).withColumn(name, F.lit(name))

    models = [Model("c", of("c"), ["b"]), Model("a", of("a"), ["source"]), Model("b", of("b"), ["a"], "view"),
              Model("other", of("other"), ["source"]), sql_model("total", "SELECT count(*) AS n FROM {c}", ["c"])]
    store = Store(spark, folder)
    assert build_models(models, {"source": spark.range(3)}, store, ["total"]) == {"a": 3, "b": None, "c": 3, "total": 1}
    assert built == ["a", "b", "c"] and store.read("total").first().n == 3 and spark.table("b").count() == 3
    assert store.read("c").columns == ["id", "a", "b", "c"] and not store.exists("other")
    for wrong in ([Model("x", of("x"), ["y"])], [Model("x", of("x"), ["y"]), Model("y", of("y"), ["x"])], [models[1], models[1]]):
        with pytest.raises(ValueError):
            build_order(wrong, ["source"])


def test_compaction(spark, folder):
    """Small files become as few as their bytes need; rows, other partitions and null partitions stay."""
    df = spark.range(4000).select("id", F.when(F.col("id") % 4 > 0, F.col("id") % 4).alias("hour"), F.concat(F.lit("a b/"), F.col("id") % 2).alias("kind"))
    by = ["hour", "kind"]
    df.repartition(6, F.rand(1)).write.partitionBy(*by).parquet(f"{folder}/t")
    spark.range(9).select("id", F.lit(9).cast("long").alias("hour"), F.lit("one").alias("kind")).coalesce(1).write.mode("append").partitionBy(*by).parquet(f"{folder}/t")
    sizes = lambda: {(r.hour, r.kind): r.n for r in file_sizes(spark, f"{folder}/t", by).groupBy(*by).agg(F.count("*").alias("n")).collect()}
    before = rows(spark.read.parquet(f"{folder}/t"))
    assert set(sizes().values()) == {1, 6}
    largest = file_sizes(spark, f"{folder}/t", by).agg(F.max("bytes")).first()[0]
    assert compact(spark, f"{folder}/t", by, only=F.col("hour") == "1") == 1
    assert sorted(sizes().values()) == [1, 1, 6, 6, 6]
    assert compact(spark, f"{folder}/t", by, target=2 * largest) == 3
    found = sizes()
    assert rows(spark.read.parquet(f"{folder}/t")) == before and all(n <= 3 for n in found.values())
    others = file_sizes(spark, f"{folder}/t", by).where("hour <> '1'")
    assert others.agg(F.max("bytes")).first()[0] <= 2 * 1.5 * largest
    assert compact(spark, f"{folder}/t", by) == sum(n > 1 for n in found.values()) and set(sizes().values()) == {1}
    assert rows(spark.read.parquet(f"{folder}/t")) == before
    spark.range(1).write.parquet(f"{folder}/s/_spark_metadata")
    with pytest.raises(ValueError):
        compact(spark, f"{folder}/s", by)


def failing_start(spark, folder, failures):
    """A query over a growing folder that fails in its first batches."""
    left = [failures]

    def batch(df, batch_id):
        if left[0]:
            left[0] -= 1
            raise RuntimeError("the sink is away")
        df.write.mode("append").parquet(f"{folder}/out")

    def start():
        stream = spark.readStream.schema("id long").parquet(f"{folder}/in")
        return stream.writeStream.foreachBatch(batch).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()

    return start


def test_supervision(spark, folder):
    spark.range(5).write.parquet(f"{folder}/in")
    watch = Supervisor(spark, {"q": failing_start(spark, folder, 2)}, attempts=2, pause=0.01)
    watch.run()
    assert watch.restarts == {"q": 2} and spark.read.parquet(f"{folder}/out").count() == 5
    spark.range(5, 6).write.mode("append").parquet(f"{folder}/in")
    with pytest.raises(Exception, match="away"):
        Supervisor(spark, {"q": failing_start(spark, folder, 9)}, attempts=1, pause=0.01).run()
    Supervisor(spark, {"q": failing_start(spark, folder, 0)}).run()
    assert spark.read.parquet(f"{folder}/out").count() == 6
