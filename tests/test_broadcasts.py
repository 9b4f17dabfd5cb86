"""Which side of a join passes through the driver: lists with a bound, never rows of the feeds."""

from pyspark.sql import functions as F

from quakehouse.operators import facts as FA
from quakehouse.operators import ingest as I
from quakehouse.operators import keys as K
from quakehouse.operators import lookups as L
from quakehouse.operators import staging as ST
from quakehouse.session import materialize


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def wide(spark, n=2000):
    """A stored table of many columns, of which a few look small to the planner."""
    return materialize(spark.range(n).select(
        F.concat(F.lit("e"), F.col("id")).alias("id"), F.col("id").cast("double").alias("latitude"), F.col("id").alias("StgId"),
        *[F.sha2(F.concat(F.lit(str(i)), F.col("id").cast("string")), 256).alias(f"c{i}") for i in range(5)]), "wide")


def test_landed_rows_meet_the_file_names_by_the_names(spark):
    text = plan(ST._landed(wide(spark), "landed").select("latitude", ST.ORDER))
    assert "BuildRight" in text and "BuildLeft" not in text


def test_joins_of_rows_with_rows_are_shuffled(spark):
    rows, other = wide(spark), wide(spark).filter(F.col("StgId") % 2 == 0)
    joins = [ST.first_per_key(rows, "id", "StgId"), I.not_yet_staged(rows, other, "id"),
             L.keep_where_missing(rows, other, "StgId"), L.keep_where_exists(rows, other, "StgId"),
             FA.keep_first(rows, ["id"]), K.stable_keys(rows.drop("StgId"), other.select("id", "StgId"), ["id"], ["id"])[0]]
    for df in joins:
        assert "BroadcastExchange" not in plan(df)
    assert [df.count() for df in joins] == [2000, 1000, 1000, 1000, 2000, 2000]
