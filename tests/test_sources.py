import io
import zipfile

import pytest
from pyspark.sql import functions as F

from helpers import rows_of
from punctual import schemas
from punctual.checks import feeds
from punctual.models.regression import metrics_long
from punctual.sources import archives as archive_source
from punctual.sources import positions, sinks, timetable

NS = positions.NAMESPACE


# ------------------------------------------------------------------------------------------------- CSV


def test_columns_are_bound_by_name(spark, tmp_path):
    path = tmp_path / "stops.txt"
    path.write_text("﻿stop_lon, stop_id,stop_lat,unknown\n-2.2,S1,53.4,x\nbad,S2,53.5,y\n", encoding="utf-8")
    got = timetable.read_csv(spark, str(path), schemas.STOPS, ["stop_id"])
    assert got.columns == schemas.STOPS.fieldNames()
    assert rows_of(got, "stop_id", "stop_lat", "stop_lon", "stop_name") == [
        ("S1", 53.4, -2.2, None),
        ("S2", 53.5, None, None),
    ]
    assert dict(got.dtypes)["stop_lat"] == "double"


def test_missing_required_column_is_an_error(spark, tmp_path):
    path = tmp_path / "stops.txt"
    path.write_text("stop_lat,stop_lon\n1,2\n")
    with pytest.raises(ValueError, match="stop_id"):
        timetable.read_csv(spark, str(path), schemas.STOPS, ["stop_id"])


def test_undeclared_csv_is_all_text(spark, tmp_path):
    path = tmp_path / "calendar.txt"
    path.write_text("service_id,monday\n007,1\n")
    got = timetable.read_csv_strings(spark, str(path))
    assert got.dtypes == [("service_id", "string"), ("monday", "string")] and got.first().service_id == "007"


# ------------------------------------------------------------------------------------------- positions


PLACE = "<VehicleLocation><Longitude>{lon}</Longitude><Latitude>{lat}</Latitude></VehicleLocation>"


def document(activities, head="", tail="", opening=f'<Siri xmlns="{NS}">', closing="</Siri>"):
    return f"{head}{opening}{activities}{closing}{tail}"


def activity(lat="53.5", lon="-2.3", line="12", tag="VehicleActivity", place=PLACE):
    """As little as a position needs, at no particular depth."""
    where = place.format(lat=lat, lon=lon)
    journey = f"<MonitoredVehicleJourney><LineRef>{line}</LineRef>{where}</MonitoredVehicleJourney>"
    return f"<{tag}><RecordedAtTime>2026-07-01T05:00:00Z</RecordedAtTime>{journey}</VehicleActivity>"


def siri(**values):
    return document(activity(**values))


def snapshot(xml, member="siri.xml"):
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as inner:
        inner.writestr(member, xml)
    return packed.getvalue()


def archive(directory, date, entries):
    path = positions.archive_path(str(directory), date)
    with zipfile.ZipFile(path, "w") as outer:
        for name, payload in entries.items():
            outer.writestr(name, payload)
    return path


def load(spark, tmp_path, payload, **options):
    path = archive(tmp_path, "20260701", {"snap.zip": payload})
    return positions.load_positions(spark, {"20260701": path}, **options).collect()


def test_all_columns_of_a_position(spark, tmp_path):
    """A document made from the list of fields: each path gets a text of its own."""
    inside = {"longitude": "-2.3", "latitude": "53.5"}
    tree = {}
    for name, where in positions.ACTIVITY_FIELDS.items():
        node = tree
        *steps, last = where.split(".")
        for step in steps:
            node = node.setdefault(step, {})
        node[last] = inside.get(name, f" {name} & more ")

    def text(node):
        return "".join(f"<{k}>{text(v) if isinstance(v, dict) else v.replace('&', '&amp;')}</{k}>" for k, v in node.items())

    (row,) = load(spark, tmp_path, snapshot(document(f"<VehicleActivity>{text(tree)}</VehicleActivity>")))
    expected = {name: float(inside[name]) if name in inside else f"{name} & more" for name in positions.ACTIVITY_FIELDS}
    assert row.asDict() == expected | {"snapshot_file": "snap.zip", "source_date": "20260701"}


LONG = "filler " * 1500
WELL_FORMED = {
    "comment after": dict(tail=f"<!--{LONG}-->"),
    "blanks after": dict(tail="\n" * 12_000),
    "instruction after": dict(tail=f"<?done {LONG}?>"),
    "all of them": dict(tail=f"<?a?>\n<!--{LONG}-->\n<?b {LONG}?> "),
    "declared": dict(head='<?xml version="1.0" encoding="UTF-8"?>'),
    "prefix": dict(opening=f'<q:Siri xmlns:q="{NS}" xmlns="{NS}">', closing="</q:Siri>"),
    "nested": dict(opening=f'<Siri xmlns="{NS}">' + "<More>" * 30, closing="</More>" * 30 + "</Siri>"),
    "foreign root": dict(opening=f'<All xmlns="urn:all"><Siri xmlns="{NS}">', closing="</Siri></All>"),
}
TAGS = ["VehicleActivity", "VehicleActivity ", "VehicleActivity\n", "VehicleActivity note='a > b'", f'VehicleActivity x="{LONG}"']


def lines_of(spark, *documents, kind="string"):
    frame = spark.createDataFrame([(i, d) for i, d in enumerate(documents)], f"k int, xml {kind}")
    return sorted((r.k, r.line_ref) for r in positions.explode_activities(frame).collect())


@pytest.mark.parametrize("variant", WELL_FORMED)
def test_well_formed_documents_lose_nothing(spark, variant):
    made = [document("".join(activity(line=str(i), tag=tag) for i, tag in enumerate(TAGS)), **WELL_FORMED[variant])]
    assert lines_of(spark, *made) == [(0, str(i)) for i in range(len(TAGS))]


def test_content_that_only_looks_like_markup(spark):
    cases = [
        activity(line="<![CDATA[<b>]]>"), activity(line="A&amp;B"), activity(line=""), activity(line="4<!-- not -->2"),
        "<!-- " + activity() + " -->" + activity(line="real"),
    ]
    assert lines_of(spark, *map(document, cases)) == [(0, "<b>"), (1, "A&B"), (2, None), (3, "42"), (4, "real")]


def made_of(*activities, head="", opening=f'<Siri xmlns="{NS}">', closing="</Siri>"):
    return head + opening + "".join(activities) + closing


LEFT_TO_THE_PARSER = {  # by element, because a pattern may get it wrong
    "entity": made_of(activity(line="A&amp;B")),
    "comment": made_of("<!-- " + activity() + " -->", activity(line="b")),
    "return": made_of(activity(line="a\r\nb")),
    "declaration inside": made_of(activity(), f'<More xmlns="{NS}"/>'),
    "bytes in another encoding": made_of(activity(), head='<?xml version="1.0" encoding="iso-8859-1"?>').encode(),
    "inside a text": made_of(activity(line="1" + activity(line="2") + "3")),
    "crossed": made_of("<VehicleActivity><A><B></A></B></VehicleActivity>"),
    "control character": made_of(activity(line="a\x0cb")),
    "nul": made_of(activity(), "<\0>", activity()),
    "end of a section": made_of(activity(line="a]]>b")),
    "foreign prefix": made_of(activity(line="<x:y/>")),
}
BY_PATTERN = {
    "alike": made_of(activity(line="1"), activity(line=""), activity(line=" Zürich "), "\n"),
    "bytes": made_of(activity(line="é"), head='<?xml version="1.0" encoding="utf-8"?>').encode(),
    "tags of all kinds": made_of(*(activity(line=str(i), tag=tag) for i, tag in enumerate(TAGS))),
    "attribute twice": made_of(activity(tag="VehicleActivity a='1' a='2'")),
    "unbound attribute": made_of(activity(tag="VehicleActivity q:a='1'")),
    "no place": made_of(activity(), "<VehicleActivity><RecordedAtTime>1</RecordedAtTime></VehicleActivity>"),
    "twice": made_of(activity().replace("<LineRef>", "<LineRef/><LineRef>"), activity(line="1").replace("</LineRef>", "</LineRef><LineRef>2</LineRef>")),
    "other namespace": made_of(activity(), opening='<Siri xmlns="urn:other">'),
    "cut short": made_of(activity(), closing=""),
    "after the root": made_of(activity()) + activity(),
    "nothing": made_of(),
    "no name": made_of(activity(), "<>", activity()),
    "tail": made_of(activity()) + "<!-- </VehicleActivity -->",
}


@pytest.mark.parametrize("name", LEFT_TO_THE_PARSER | BY_PATTERN)
def test_patterns_find_what_the_parser_finds(name):
    made = (LEFT_TO_THE_PARSER | BY_PATTERN)[name]
    rows = lambda columns: sorted(map(str, zip(*columns, strict=True)))
    assert rows(positions._activities(made)) == rows(positions._parsed(made))
    if name != "tail":
        assert (positions._by_shape(made) is None) == (name in LEFT_TO_THE_PARSER)


def test_documents_of_a_feed_are_not_taken_apart_by_element(spark, monkeypatch):
    """Nor is their text shuffled."""
    row = "'OP1' operator_ref, 'L' line_ref, 'V' vehicle_ref, '1' origin_aimed_departure, '2' recorded_at, 53.4D latitude, -2.3D longitude, '20260701' source_date"
    made = feeds.as_documents(spark.sql(f"select {row} from range(2000)"))
    text = made._jdf.queryExecution().executedPlan().toString()
    assert text.index("Exchange") > text.index("VehicleActivity>") and "VehicleActivity>" not in text[text.index("Exchange") :]
    monkeypatch.setattr(positions, "_parsed", None)
    documents = [r.xml for r in made.collect() if r.xml.startswith("<")]
    assert sum(len(positions._activities(d)[0]) for d in documents) == 2000


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "utf-16", "iso-8859-1"])
def test_encodings(spark, tmp_path, encoding):
    declared = "utf-8" if encoding == "utf-8-sig" else encoding
    text = document(activity(line="Zürich é"), head=f'<?xml version="1.0" encoding="{declared}"?>')
    (row,) = load(spark, tmp_path, snapshot(text.encode(encoding)))
    assert row.line_ref == "Zürich é"


@pytest.mark.parametrize(
    "payload",
    [
        snapshot(siri(lat="53.0")), snapshot(siri(lon="-1.0")), b"", b"PK no zip at all", snapshot(siri(), member="else.xml"),
        snapshot(siri(place="")), snapshot(siri(lat="up there")), snapshot(siri(lon="")), snapshot(siri()[:-3]),
        snapshot(siri() + "<again/>"), snapshot(siri() + "words"), snapshot(document(activity(), opening=f'<Siri xmlns="urn:no" was="{NS}">')),
        snapshot(siri().replace(f' xmlns="{NS}"', "")), snapshot(""), snapshot(b"\xff\xfe\x00"),
    ],
)
def test_unusable_snapshots_give_nothing(spark, tmp_path, payload):
    assert load(spark, tmp_path, payload) == []


def damaged_entries():
    """A good snapshot with a broken stream inside, and one whose stored bytes no longer fit their checksum."""
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as inner:
        inner.writestr("siri.xml", siri() * 3)
    broken = bytearray(packed.getvalue())
    start = 30 + len("siri.xml")
    broken[start : start + 12] = b"\xff" * 12
    return bytes(broken)


def test_damaged_entries_do_not_stop_the_day_and_are_counted(spark, tmp_path):
    good = snapshot(siri(line="good"))
    marked = snapshot(siri(line="changed later"))
    path = archive(tmp_path, "20260701", {"1.zip": good, "2.zip": damaged_entries(), "3.zip": marked, "4.zip": b"", "notes.txt": "x", "5.zip": good})
    data = open(path, "rb").read()
    at = data.index(marked)
    with open(path, "wb") as out:  # the outer checksum of 3.zip fails
        out.write(data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :])
    archives = {"20260701": path}
    assert sorted(r.snapshot_file for r in positions.load_positions(spark, archives, task_bytes=1).collect()) == ["1.zip", "5.zip"]
    snapshots = archive_source.read_archives(spark, archives)
    assert [tuple(r) for r in positions.damaged_per_day(snapshots).collect()] == [("20260701", 5, 2)]


def days_of_snapshots(tmp_path, days=("20260629", "20260630", "20260701"), n=40):
    return {day: archive(tmp_path, day, {f"{i:03}.zip": snapshot(siri(line=str(i))) for i in range(n)}) for day in days}


def test_tasks_take_stretches_of_one_archive(spark, tmp_path):
    archives = days_of_snapshots(tmp_path)
    one = archive_source.read_archives(spark, archives, content=False).first()["size"]
    rows = archive_source.read_archives(spark, archives, task_bytes=15 * one).select("source_date", "ordinal", F.spark_partition_id().alias("task"))
    tasks = {}
    for r in rows.collect():
        tasks.setdefault(r.task, []).append((r.source_date, r.ordinal))
    assert sorted(x for t in tasks.values() for x in t) == [(d, i) for d in sorted(archives) for i in range(40)]
    for taken in tasks.values():
        first = taken[0][1]
        assert taken == [(taken[0][0], first + i) for i in range(len(taken))] and len(taken) <= 15
    assert 9 <= len(tasks) <= 12
    path = str(tmp_path / "stored")
    sinks.replace_days(positions.load_positions(spark, archives, task_bytes=15 * one), path)
    assert len(list((tmp_path / "stored").glob("source_date=*/*.parquet"))) == len(tasks)
    assert positions.read_positions(spark, path).count() == 120


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_options_name_the_entries_to_read(spark, tmp_path):
    archives = days_of_snapshots(tmp_path)
    some = archive_source.read_archives(spark, {"20260701": archives["20260701"]}, first=3, last=5)
    assert rows_of(some, "source_date", "ordinal") == [("20260701", i) for i in (3, 4, 5)]
    sample = archive_source.read_archives(spark, archives, every_nth=7, first=8, last=1000, task_bytes=1)
    assert rows_of(sample, "source_date", "ordinal") == sorted((d, i) for d in archives for i in (14, 21, 28, 35))
    assert archive_source.read_archives(spark, archives, first=40).count() == 0
    with pytest.raises(Exception, match="not there"):
        archive_source.read_archives(spark, archives | {"20260702": str(tmp_path / "not there.zip")}).count()


def test_filters_of_one_table_do_not_meet(spark, tmp_path):
    every = archive_source.read_archives(spark, days_of_snapshots(tmp_path))
    one, other = every.where("source_date = '20260629' and ordinal < 3"), every.where("source_date = '20260701'")
    assert (one.count(), other.count(), every.count()) == (3, 40, 120)
    assert rows_of(one.union(other).groupBy("source_date").count()) == [(3, "20260629"), (40, "20260701")]


def test_loading_a_day_moves_no_rows(spark, tmp_path):
    archives = days_of_snapshots(tmp_path)
    day = positions.load_positions(spark, {"20260630": archives["20260630"]}, sample_every_nth=5)
    assert "Exchange" not in plan_of(day)
    assert {r.snapshot_file for r in day.collect()} == {f"{i:03}.zip" for i in range(0, 40, 5)}


def test_listing_reads_no_documents(spark, tmp_path):
    listed = archive_source.read_archives(spark, days_of_snapshots(tmp_path), every_nth=20, content=False)
    assert listed.columns == ["source_date", "archive", "ordinal", "snapshot_file", "size"]
    assert rows_of(listed, "source_date", "ordinal") == [(d, i) for d in ("20260629", "20260630", "20260701") for i in (0, 20)]


def test_several_archives_of_a_day_and_empty_ones(spark, tmp_path):
    parts = {}
    for part, n in (("a", 3), ("b", 0), ("c", 2)):
        (tmp_path / part).mkdir()
        parts[part] = archive(tmp_path / part, "20260701", {f"{i}.zip": snapshot(siri(line=part)) for i in range(n)})
    got = archive_source.read_archives(spark, {"20260701": list(parts.values())})
    assert rows_of(got, "archive", "ordinal") == [(parts["a"], i) for i in range(3)] + [(parts["c"], i) for i in range(2)]
    assert archive_source.read_archives(spark, {"20260701": parts["b"]}).count() == 0
    assert archive_source.read_archives(spark, {}).count() == 0


def test_an_archive_that_is_no_zip_is_an_error(spark, tmp_path):
    (tmp_path / "x.zip").write_bytes(b"words")
    with pytest.raises(Exception, match="not a zip"):
        archive_source.read_archives(spark, {"20260701": str(tmp_path / "x.zip")}).count()


def test_systematic_sample_counts_from_the_first_entry(spark, tmp_path):
    names = [f"{i:02}.zip" for i in (5, 3, 9, 1, 7)]
    path = archive(tmp_path, "20260701", {n: snapshot(siri(line=n)) for n in names})
    listed = archive_source.read_archives(spark, {"20260701": path}, content=False)
    assert rows_of(listed, "ordinal", "snapshot_file") == list(enumerate(names))
    got = positions.load_positions(spark, {"20260701": path}, sample_every_nth=2)
    assert {r.snapshot_file for r in got.collect()} == {"05.zip", "09.zip", "07.zip"}


# ----------------------------------------------------------------------------------------------- sinks


def test_reloading_a_day_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "positions")
    schema = "vehicle_ref string, source_date string"
    sinks.replace_days(spark.createDataFrame([("A", "20260630"), ("B", "20260701")], schema), path)
    sinks.replace_days(spark.createDataFrame([("C", "20260701")], schema), path)
    got = positions.read_positions(spark, path, ["vehicle_ref", "source_date"])
    assert rows_of(got, "source_date", "vehicle_ref") == [("20260630", "A"), ("20260701", "C")]
    assert dict(got.dtypes)["source_date"] == "string"


def test_full_refresh(spark, tmp_path):
    for n in (3, 2):
        sinks.write_tables({"t": spark.range(n).toDF("id")}, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_events_are_partitioned_by_day(spark, tmp_path):
    path = str(tmp_path / "events")
    rows = spark.createDataFrame([("20260701", 1.0), ("20260630", 2.0)], "service_date string, delay_min double")
    sinks.write_delay_events(rows, path)
    assert len(list((tmp_path / "events").glob("service_date=*/*.parquet"))) == 2
    back = sinks.read_delay_events(spark, path, rows.schema)
    assert rows_of(back, "service_date", "delay_min") == [("20260630", 2.0), ("20260701", 1.0)]
    plan = back.where("service_date = '20260701'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(service_date" in plan


def test_events_of_other_days_stay(spark, tmp_path):
    path, schema = str(tmp_path / "events"), "service_date string, delay_min double"
    frame = lambda *rows: spark.createDataFrame(list(rows), schema)
    read = lambda: rows_of(sinks.read_delay_events(spark, path, frame(("", 0.0)).schema), "service_date", "delay_min")
    sinks.replace_delay_events(frame(("20260630", 1.0), ("20260701", 2.0)), path, ["20260630", "20260701"])
    # rows of a day that was not asked for are left out, and a day asked for without rows goes
    sinks.replace_delay_events(frame(("20260701", 3.0), ("20260630", 9.0)), path, ["20260701"])
    assert read() == [("20260630", 1.0), ("20260701", 3.0)]
    sinks.replace_delay_events(frame(("20260702", 4.0)), path, ["20260630", "20260702"])
    assert read() == [("20260701", 3.0), ("20260702", 4.0)]
    sinks.replace_delay_events(frame(("20260702", 4.0)).limit(0), path, ["20260701"])
    assert read() == [("20260702", 4.0)]


def test_model_comparison_file(spark, tmp_path):
    path = str(tmp_path / "comparison")
    assert sinks.read_model_comparison(spark, path) is None
    rows = spark.createDataFrame([("m", 2.0, 1.0, 0.5, 3.0, 0.1)], schemas.MODEL_COMPARISON)
    sinks.write_model_comparison(rows, path)
    back = sinks.read_model_comparison(spark, path)
    assert rows_of(back) == rows_of(rows)
    assert rows_of(metrics_long(back)) == [("RMSE", 2.0, "m"), ("MAE", 1.0, "m")][::-1]


def test_jdbc_load_is_batched_and_in_order():
    calls = []

    class Table:
        def __init__(self):
            self.write = self

        def jdbc(self, url, name, mode, properties):
            calls.append((url, name, mode, properties))

    sinks.write_jdbc({"dim": Table(), "fact": Table()}, "jdbc:x:y", driver="d")
    assert [c[1] for c in calls] == ["dim", "fact"]
    assert all(c[2:] == ("overwrite", {"batchsize": "5000", "driver": "d"}) for c in calls)


def test_range_source(spark):
    spread = spark.range(100).repartition(8)
    assert spread.rdd.getNumPartitions() == 8 and spread.agg(F.sum("id")).first()[0] == 4950
