"""Regressions: quoted multi-line CSV and text dates under a zone with daylight saving."""

import datetime

from demandflow.operators.clean import coerce_datetime
from demandflow.sources.catalog import load_dataset


def test_quoted_line_breaks_and_quotes(spark, tmp_path):
    (tmp_path / "notes.csv").write_text('id,comment\n1,"two\nlines, ""quoted"""\n2,plain\n')
    got = load_dataset(spark, str(tmp_path), multi_line=["notes"])["notes.csv"].orderBy("id").collect()
    assert [tuple(r) for r in got] == [("1", 'two\nlines, "quoted"'), ("2", "plain")]


def test_text_dates_do_not_move_in_a_zones_gap(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        df = spark.createDataFrame([("2017-10-15 00:30:00",), ("no date",), (None,)], "d string")
        got = [r["d"] for r in coerce_datetime(df, ["d"]).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == [datetime.datetime(2017, 10, 15, 0, 30), None, None]


def test_plain_tables_are_read_by_many_tasks_and_from_any_store(spark, tmp_path):
    lines = "".join(f"o{k},{k % 7}\n" for k in range(60_000))
    (tmp_path / "orders.csv").write_text("order_id,n\n" + lines)
    (tmp_path / "reviews.csv").write_text("review_id,n\n" + lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        got = load_dataset(spark, f"file://{tmp_path}")
        assert list(got) == ["orders.csv", "reviews.csv"]
        assert got["orders.csv"].rdd.getNumPartitions() > 1 and got["reviews.csv"].rdd.getNumPartitions() == 1
        assert got["orders.csv"].count() == got["reviews.csv"].count() == 60_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert load_dataset(spark, f"file://{tmp_path}/none") == {}
