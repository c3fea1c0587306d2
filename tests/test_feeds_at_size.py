"""What keeps the feeds in proportion: the calls are shuffled once, in tasks of a bounded number of rows."""

import contextlib
import io

from punctual.checks import feeds, landing
from punctual.sources import archives as archive_source
from punctual.sources import positions


def plan_of(frame) -> str:
    with contextlib.redirect_stdout(io.StringIO()) as said:
        frame.explain("simple")
    return said.getvalue()


def test_calls_are_shuffled_once(spark, small):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as beyond the size at which routes and trips are sent
    try:
        plan = plan_of(feeds.positions(spark, small))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # the order lines, the orders by route, the routes, and the orders by trip
    assert plan.count("Exchange hashpartitioning") == 4
    assert plan.count("lineitem.parquet") == 1


def test_tasks_follow_the_rows(spark, small, monkeypatch):
    monkeypatch.setattr(feeds, "TASK_ROWS", 500)
    rows = feeds.read_table(spark, small, "lineitem").count()
    assert feeds._calls(spark, small).rdd.getNumPartitions() == -(-rows // 500) > spark.sparkContext.defaultParallelism


def test_archives_follow_the_rows(spark, small, monkeypatch, tmp_path):
    monkeypatch.setattr(landing, "ARCHIVE_ROWS", 200)
    folder = tmp_path / "copy"
    folder.symlink_to(small)  # another source, so that nothing stored before is taken
    rows = landing.positions(spark, str(folder)).where(f"source_date = '{landing.DAY}'").count()
    found = landing.archives(spark, str(folder))[landing.DAY]
    assert landing.ARCHIVES_A_DAY < len(found) <= rows // 200


PLACES = """concat('OP', id % 3) operator_ref, concat('L', id % 7) line_ref, concat('V', id) vehicle_ref, '2026-07-01T08:00:00+00:00' origin_aimed_departure,
    concat('at ', id) recorded_at, 53.4D + (id % 100) * 0.001D latitude, -2.3D longitude, if(id < 1900, '20260630', '20260701') source_date"""


def stored_places(spark, path, tasks=3):
    spark.range(0, 3000, 1, tasks).createOrReplaceTempView("places")
    spark.sql(f"select {PLACES} from places").write.partitionBy("source_date").parquet(path)
    return landing._read_by_day(spark, path, "source_date")


def test_archives_are_packed_where_positions_are_scanned(spark, tmp_path):
    """Text is many times as long as the positions; shuffled and sorted it took more disk than the archives."""
    rows = stored_places(spark, str(tmp_path / "places"))
    assert rows.rdd.getNumPartitions() > 1
    assert "Exchange" not in plan_of(feeds.as_archives(rows, str(tmp_path / "plan"), 2, 200))
    # few tasks: dealt out before the positions become text
    dealt = feeds.as_archives(rows, str(tmp_path / "plan"), 8, 200)._jdf.queryExecution().executedPlan().toString()
    assert "VehicleActivity>" in dealt and "VehicleActivity>" not in dealt[dealt.index("Exchange") :]


def test_archives_hold_all_positions(spark, tmp_path):
    rows = stored_places(spark, str(tmp_path / "places"))
    there = sorted(tuple(r) for r in rows.select("source_date", "operator_ref", "vehicle_ref", "recorded_at", "latitude").collect())
    for at_least in (2, 8):
        for full in (90, 100_000):
            packed = feeds.as_archives(rows, str(tmp_path / f"packed-{at_least}-{full}"), at_least, full).collect()
            assert len({r.archive for r in packed}) == len(packed)
            days = {day: [r.archive for r in packed if r.source_date == day] for day in ("20260630", "20260701")}
            back = positions.load_positions(spark, days)
            assert sorted(tuple(r) for r in back.select("source_date", "operator_ref", "vehicle_ref", "recorded_at", "latitude").collect()) == there
            # each document and its damaged copy
            held = [r["count"] for r in archive_source.read_archives(spark, days, content=False).groupBy("archive").count().collect()]
            assert sum(held) >= 2 * 3000 / feeds.ACTIVITIES_PER_DOCUMENT
            if full == 90:
                assert len(packed) > 2 * at_least and all(full * 2 <= n * feeds.ACTIVITIES_PER_DOCUMENT for n in held)


def test_documents_go_on_from_batch_to_batch(spark, tmp_path):
    rows = stored_places(spark, str(tmp_path / "places"), 1)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    counts = []
    for most in ("10000", "7"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", most)
        try:
            packed = feeds.as_archives(rows, str(tmp_path / f"batches-{most}"), 1, 1000).collect()
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
        days = {day: [r.archive for r in packed if r.source_date == day] for day in ("20260630", "20260701")}
        counts.append(archive_source.read_archives(spark, days, content=False).count())
    assert counts[0] == counts[1]
