"""The stream's join with customers beyond the broadcast limit."""

from pyspark.sql import functions as F

from tidedesk_checks import projection

SF_DIR = "/root/testdata/sf0.01"


def with_hot(spark):
    events = projection._table(spark, SF_DIR, "events")
    return events.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, 1).when(F.col("event_id") % 100 > 1, F.col("event_id") % 1500).cast("bigint"))


def test_customers_with_a_large_part_of_the_events_are_hot(spark):
    assert projection.hot_customers(with_hot(spark)) == [1]
    assert projection.hot_customers(with_hot(spark).where("false")) == []


def test_only_places_of_hot_customers_are_multiplied(spark):
    places = projection.customer_places(spark, SF_DIR)
    dealt = projection.salted(places, [1])
    assert dealt.count() == places.count() + projection.SALTS - 1
    assert dealt.where("c_custkey = 1").select("c_salt").distinct().count() == projection.SALTS


def test_the_salt_loses_and_repeats_no_event(spark):
    events, places = with_hot(spark), projection.customer_places(spark, SF_DIR)
    plain = projection.project_events(events, places)
    salted = projection.project_events(events, projection.salted(places, [1]), [1])
    assert salted.count() == plain.count() > 0
    assert salted.exceptAll(plain).isEmpty()


def test_a_stream_beyond_the_broadcast_limit_has_the_same_contacts(spark, tmp_path):
    with_hot(spark).write.parquet(str(tmp_path / "events.parquet"))
    for name in ("customer", "nation", "region"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stream = projection.contact_stream(spark, str(tmp_path))
        query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp"))
        query.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    expected = projection.contacts(spark, str(tmp_path))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == expected.count() > 0
    assert got.exceptAll(expected).isEmpty()
