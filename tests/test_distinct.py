"""Distinct counts that add up, against counting over the facts."""

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import distinct, heavy
from tidewatch.operators.metrics import security_metrics, sketched_actors


@pytest.fixture(scope="module")
def visits(spark):
    """An hour in which one minute and one actor hold most rows, and a third of the actors have no name."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 60).alias("minute"),
        F.when(F.col("id") % 4 == 0, F.lit("hot")).when(F.col("id") % 9 != 0, F.concat(F.lit("a"), (F.col("id") * 7 % 5003).cast("string"))).alias("actor"),
    )
    return rows.cache()


def test_sets_add_up(spark, visits, tmp_path):
    distinct.extended_dictionary(visits.select("actor")).write.parquet(str(tmp_path / "ids"))
    ids = spark.read.parquet(str(tmp_path / "ids"))
    minutes = distinct.distinct_sets(visits.repartition(5), ["minute"], "actor", ids)
    quarters = distinct.merged_sets(minutes, F.floor(F.col("minute") / 15).alias("quarter"))
    for sets, key, column in ((minutes, "minute", F.col("minute")), (quarters, "quarter", F.floor(F.col("minute") / 15))):
        expected = visits.groupBy(column.alias(key)).agg(F.count_distinct("actor").alias("n")).filter("n > 0")
        assert sorted(map(tuple, distinct.set_sizes(sets, key, name="n").collect())) == sorted(map(tuple, expected.collect()))
    assert "Expand" not in minutes._jdf.queryExecution().executedPlan().toString()
    assert distinct.set_sizes(distinct.distinct_sets(visits.limit(0), ["minute"], "actor", ids), "minute", name="n").count() == 0


def test_sets_of_few_values_are_small(spark, visits, tmp_path):
    """Many sets of one value each take a few bytes a set, hashed and not sorted; a full word, with its sign bit, counts 64."""
    distinct.extended_dictionary(visits.select("actor")).write.parquet(str(tmp_path / "ids"))
    ids = spark.read.parquet(str(tmp_path / "ids"))
    single = distinct.distinct_sets(visits.withColumn("n", F.monotonically_increasing_id()), ["n"], "actor", ids)
    assert single.agg(F.max(F.length(F.col("members").cast("string").cast("binary")))).first()[0] <= 20
    assert distinct.set_sizes(single, "n", name="size").agg(F.sum("size"), F.max("size")).first()[:] == (visits.filter("actor IS NOT NULL").count(), 1)
    assert "SortAggregate" not in distinct.merged_sets(single, F.lit(1).alias("all"))._jdf.queryExecution().executedPlan().toString()
    dense = spark.range(128).select(F.lit("k").alias("k"), F.col("id").cast("string").alias("value"), F.col("id"))
    words = distinct.distinct_sets(dense.select("k", "value"), ["k"], "value", dense.select("value", "id"))
    assert words.count() == 2 and distinct.set_sizes(words, "k", name="size").collect() == [("k", 128)]


def test_a_dictionary_grows_and_keeps_its_ids(spark, visits, tmp_path):
    first = visits.filter("minute < 20").select("actor")
    distinct.extended_dictionary(first.repartition(7)).write.parquet(str(tmp_path / "a"))
    known = spark.read.parquet(str(tmp_path / "a"))
    distinct.extended_dictionary(visits.select("actor"), known).write.parquet(str(tmp_path / "b"))
    grown = spark.read.parquet(str(tmp_path / "b"))
    assert grown.join(known, ["value", "id"]).count() == known.count() == first.filter("actor is not null").distinct().count()
    row = grown.agg(F.count("*"), F.count_distinct("id"), F.count_distinct("value")).first()
    assert row[0] == row[1] == row[2] == visits.agg(F.count_distinct("actor")).first()[0]
    assert distinct.extended_dictionary(visits.select("actor").limit(0), known).count() == known.count()


def test_united_sketches_stay_within_their_error(spark, processed):
    """5,000 actors over many minutes: the union is within three standard errors, and far from the sum of the minutes."""
    one = processed({}).filter("quality_status = 'valid'")
    actors = spark.range(20_000).select(F.concat(F.lit("actor"), (F.col("id") % 5000).cast("string")).alias("actor_id"), F.col("id"))
    rows = one.drop("actor_id").crossJoin(actors).withColumn("event_timestamp", F.col("event_timestamp") + F.expr("make_dt_interval(0, 0, CAST((id + id div 5000) % 50 AS INT))"))
    minutes = security_metrics(rows, keep_sketches=True).cache()
    (united,) = sketched_actors(minutes, "event_type").collect()
    assert abs(united.unique_actors - 5000) <= 3 * distinct.STANDARD_ERROR * 5000 and united.unique_source_ips == 1
    assert minutes.agg(F.sum("unique_actors")).first()[0] > 19_000
    small = security_metrics(rows.filter("id < 300"), keep_sketches=True)
    assert sketched_actors(small, "event_type").first().unique_actors == 300


def test_no_heavy_hitter_is_missed(spark):
    """States far smaller than the number of values, over many minutes: every value above the bound is there, within the stated error."""
    tracked = 96
    hot = F.when(F.col("id") % 2 == 0, F.concat(F.lit("hot"), (F.col("id") / 2 % 6).cast("int").cast("string")))
    rows = spark.range(40_000).select((F.col("id") % 45).alias("minute"), F.coalesce(hot, F.concat(F.lit("rare"), F.col("id").cast("string"))).alias("value"))
    rows = rows.unionByName(spark.createDataFrame([(1, None)], "minute long, value string"))
    minutes = heavy.hitter_states(rows.repartition(6), ["minute"], "value", tracked)
    (combined,) = heavy.combined_states(minutes, F.lit(1).alias("all"), tracked=tracked).collect()
    whole = heavy.combined_states(minutes, F.floor(F.col("minute") / 10).alias("part"), tracked=tracked)
    found = {r.value: r["count"] for r in heavy.top_values(heavy.combined_states(whole, tracked=tracked), 20).collect()}
    exact = {r.value: r["count"] for r in rows.groupBy("value").count().collect()}
    error = heavy.count_error(40_000, tracked)
    assert error < 3333 and combined["all"] == 1
    assert {v for v, n in exact.items() if v and n > error} == {f"hot{i}" for i in range(6)} <= set(found)
    assert all(abs(found[f"hot{i}"] - exact[f"hot{i}"]) <= error for i in range(6))
    assert heavy.top_values(heavy.combined_states(heavy.hitter_states(rows.limit(0), ["minute"], "value")), 6).count() == 0
