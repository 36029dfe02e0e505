"""Wide CSV, landed tables, topic records, Kafka options."""

from __future__ import annotations

import math

import pytest
from pyspark.errors import PySparkException

from hostvigil.operators.quarantine import (
    count_problems,
    mark_bad_times,
    quarantined,
    usable,
)
from hostvigil.operators.split import from_records, readings_of, split_topic, to_records
from hostvigil.schemas import CPU, DISK, MEM, NET, TOPICS, WIDE
from hostvigil.sources.kafka import kafka_options
from hostvigil.sources.landed import read_landed, read_landed_topic
from hostvigil.sources.wide_csv import read_wide_csv

HEADER = "ts,server_id,cpu_pct,mem_pct,net_in,net_out,disk_io"


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def line(ts, *numbers):
    return ",".join([ts, "server_1", *map(str, numbers or (1, 2, 3, 4, 5))])


def times(df):
    return sorted(row.ts for row in df.collect())


def test_headers_and_blank_lines_are_skipped_anywhere(spark, tmp_path):
    path = write(tmp_path / "w.csv", HEADER, line("20:53:00"), "", "   ", HEADER,
                 "  " + line("20:53:05") + "  ")
    df = usable(read_wide_csv(spark, path))
    assert df.columns == WIDE.names
    assert [tuple(r) for r in df.orderBy("ts").collect()] == [
        ("20:53:00", "server_1", 1.0, 2.0, 3.0, 4.0, 5.0),
        ("20:53:05", "server_1", 1.0, 2.0, 3.0, 4.0, 5.0),
    ]


def test_files_without_header_lose_nothing(spark, tmp_path):
    path = write(tmp_path / "w.csv", line("20:53:00"), line("20:53:05"))
    assert times(usable(read_wide_csv(spark, path))) == ["20:53:00", "20:53:05"]


def test_skip_first_record(spark, tmp_path):
    records = [line(f"20:53:{s:02d}") for s in range(40)]
    path = write(tmp_path / "w.csv", "", HEADER, records[0], records[0], *records[1:])
    kept = times(usable(read_wide_csv(spark, path, skip_first_record=True)))
    assert kept == [f"20:53:{s:02d}" for s in range(40)]  # one of the two copies is gone

    split = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    before = {key: spark.conf.get(key) for key in split}
    try:
        for key, value in split.items():
            spark.conf.set(key, value)
        scan = read_wide_csv(spark, path, skip_first_record=True)
        assert scan.rdd.getNumPartitions() > 1
        assert times(usable(scan)) == kept
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)

    empty = write(tmp_path / "empty.csv", HEADER)
    assert read_wide_csv(spark, empty, skip_first_record=True).count() == 0


@pytest.mark.parametrize("most_bytes", ["134217728", "150"])
def test_skip_first_record_of_every_file(spark, tmp_path, most_bytes):
    files = {
        "a.csv": [HEADER, line("20:00:00"), line("20:00:01"), line("20:00:02")],
        "b.csv": [line("20:00:03"), HEADER, line("20:00:04")],
        "headers.csv": [HEADER] * 9,
        # The first record lies beyond the first blocks.
        "late.csv": [*["", HEADER] * 9, line("20:00:05"), line("20:00:05"), line("20:00:06")],
        "one.csv": ["   ", line("20:00:07")],
        "bad.csv": ["20:00:08,server_1", line("20:00:09")],
    }
    for name, lines in files.items():
        write(tmp_path / name, *lines)
    split = {"spark.sql.files.maxPartitionBytes": most_bytes, "spark.sql.files.openCostInBytes": "1"}
    before = {key: spark.conf.get(key) for key in split}
    try:
        for key, value in split.items():
            spark.conf.set(key, value)
        checked = read_wide_csv(spark, str(tmp_path), skip_first_record=True)
        assert times(usable(checked)) == [
            f"20:00:0{s}" for s in (1, 2, 4, 5, 6, 9)]
        assert quarantined(checked).count() == 0  # a first record goes whatever it holds
        assert checked.columns == [*WIDE.names, "problem", "raw"]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_bad_lines_are_quarantined(spark, tmp_path):
    bad = [line("20:53:10") + ",6", "20:53:11,server_1,1", line("20:53:12", 1, 2, "x", 4, 5),
           line("20:53:13", "1.0", "2.0", "", "4.0", "5.0"), '"20:53:14,server_1",1,2,3,4,5']
    path = write(tmp_path / "w.csv", HEADER, line("20:53:00"), *bad,
                 line("20:53:20", "nan", 2, "inf", 4, 5))
    checked = read_wide_csv(spark, path)
    assert {tuple(r) for r in quarantined(checked).collect()} == {
        ("field_count", bad[0]), ("field_count", bad[1]), ("not_a_number", bad[2]),
        ("not_a_number", bad[3]),
    }
    rows = {r.ts: r for r in usable(checked).collect()}
    assert sorted(rows) == ['"20:53:14', "20:53:00", "20:53:20"]  # quotes mean nothing
    assert rows["20:53:20"][2:] == (None, 2.0, None, 4.0, 5.0)
    counts = {r.problem: r.n for r in count_problems(checked).collect()}
    assert counts == {"ok": 3, "field_count": 2, "not_a_number": 2}
    assert usable(checked).select("server_id").count() == 3  # pruned columns change nothing


@pytest.mark.parametrize("bad", [line("20:53:10") + ",6", "20:53:11,server_1,1",
                                 line("20:53:12", 1, 2, "x", 4, 5)])
def test_strict_reading_stops_at_bad_lines(spark, tmp_path, bad):
    path = write(tmp_path / "w.csv", HEADER, line("20:53:00"), bad)
    with pytest.raises(PySparkException, match="field_count|not_a_number"):
        usable(read_wide_csv(spark, path, strict=True)).collect()
    good = write(tmp_path / "good.csv", HEADER, line("20:53:00"))
    assert usable(read_wide_csv(spark, good, strict=True)).count() == 1


def test_records_that_hold_more_than_an_object(spark):
    """What follows an object is found however it is spaced, and nested objects are no reason to
    refuse one."""
    good = ['{"ts":"a"}', ' {"ts":"a"} ', '{"x":{"y":1},"ts":"a"}', '{"x":[{"y":1} , 2],"ts":"a"}',
            '{"ts":"a","x":"},\\"b\\":1"}']
    bad = ['{"ts":"a"},"b":1', '{"ts":"a"} , "b":1', '{"ts":"a"}\n,\n"b":1', '{"ts":"a"},{"ts":"a"}',
           '{"ts":"a"}}', '{"ts":"a"},', '[{"ts":"a"}]', '"ts"', "", "{", "null", None]
    records = [("topic-cpu", bytearray(x.encode()) if x is not None else None)
               for x in [*good, *bad]]
    df = from_records(spark.createDataFrame(records, "topic string, value binary"))
    rows = df.collect()
    assert [r.problem for r in rows] == [None] * len(good) + ["undecodable"] * len(bad)
    assert [r.ts for r in rows] == ["a"] * len(good) + [None] * len(bad)


def test_bad_times_are_marked(spark):
    df = spark.createDataFrame([("20:53:00",), ("8:05:00",), (None,)], "ts string")
    counts = {r.problem: r.n for r in count_problems(mark_bad_times(df)).collect()}
    assert counts == {"ok": 1, "bad_time": 2}


def test_landed_csv_binds_by_position(spark, tmp_path):
    path = write(
        tmp_path / "c.csv", "ts,server_id,cpu_pct", "a,s,75.69", "b,s,nan", "c,s,inf", "d,s,abc",
        "e,s,NaN", "f,s,Inf", "g,,1", "h,s", "i,s,1,2", "", "ts,server_id,cpu_pct",
    )
    rows = {r.ts: (r.server_id, r.cpu_pct) for r in read_landed(spark, path, CPU, "csv").collect()}
    assert rows["a"] == ("s", 75.69000244140625)
    assert rows["b"] == rows["c"] == rows["d"] == rows["h"] == ("s", None)
    assert math.isnan(rows["e"][1]) and rows["f"][1] == math.inf
    assert rows["g"] == (None, 1.0)
    assert rows["i"] == ("s", 1.0)
    assert rows["ts"] == ("server_id", None)
    assert len(rows) == 10

    swapped = write(tmp_path / "swapped.csv", "server_id,ts,cpu_pct", "s,20:53:00,1")
    assert read_landed(spark, swapped, CPU, "csv").first().ts == "s"
    with pytest.raises(Exception, match="does not conform to the schema"):
        read_landed(spark, swapped, CPU, "csv", strict=True).collect()

    (tmp_path / "zero.csv").write_bytes(b"")
    assert read_landed(spark, str(tmp_path / "zero.csv"), MEM, "csv").count() == 0


def test_split_and_records_carry_every_metric(spark):
    wide = spark.createDataFrame([("20:53:00", "s", 75.69, 2.0, 3.0, None, 5.0)], WIDE)
    assert split_topic(wide, "topic-cpu").schema == CPU
    assert split_topic(wide, "topic-net").schema == NET
    records = to_records(wide)
    assert records.count() == 4
    texts = {r.topic: bytes(r.value).decode() for r in records.collect()}
    assert texts["topic-net"] == (
        '{"ts":"20:53:00","server_id":"s","net_in":3.0,"net_out":null}'
    )
    decoded = from_records(records)
    for topic, schema in TOPICS.items():
        got = readings_of(decoded, topic)
        assert got.schema == schema
        assert got.collect() == split_topic(wide, topic).collect()


def test_undecodable_records_are_kept_apart(spark):
    values = {
        '{"ts":"a","server_id":"s","disk_io":1.5}': 1.5,
        '{"ts":"b","server_id":"s","disk_io":"1.5","extra":[1]}': 1.5,
        '{"ts":"c","server_id":"s","disk_io":NaN}': None,
        '{"ts":"d","server_id":"s","disk_io":Infinity}': None,
        '{"ts":"e","server_id":"s","disk_io":"abc"}': None,
        '{"ts":"f","server_id":"s"}': None,
    }
    bad = ['{"ts":"x"', "[1]", '[{"ts":"y"}]', "5", "", "text"]
    rows = [("topic-disk", bytearray(v.encode())) for v in [*values, *bad]]
    df = spark.createDataFrame([*rows, ("topic-disk", None)], "topic string, value binary")
    decoded = from_records(df)
    good = readings_of(decoded, "topic-disk").orderBy("ts").collect()
    assert [(r.ts, r.disk_io) for r in good] == list(zip("abcdef", values.values()))
    refused = decoded.filter("problem = 'undecodable'").collect()
    assert sorted(r.raw or "" for r in refused) == sorted([*bad, ""])
    assert all(r.ts is None for r in refused)


def test_schemas_match_their_tables():
    assert [f.dataType.simpleString() for f in CPU] == ["string", "string", "float"]
    assert [f.dataType.simpleString() for f in MEM] == ["string", "string", "float"]
    assert [f.dataType.simpleString() for f in NET][2:] == ["double", "double"]
    assert [f.dataType.simpleString() for f in DISK][2:] == ["double"]
    assert all(f.nullable for schema in (*TOPICS.values(), WIDE) for f in schema)


def test_kafka_options():
    assert kafka_options("b:9092", ["topic-cpu", "topic-mem"], 64) == {
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "topic-cpu,topic-mem",
        "startingOffsets": "earliest",
        "minPartitions": "64",
    }
    assert kafka_options("b")["subscribe"] == "topic-cpu,topic-mem,topic-net,topic-disk"


def test_records_are_one_json_object_each(spark):
    good = '{"ts":"a","server_id":"s","cpu_pct":1}'
    texts = [good, f"\n{good}\n", f"\t{good} ", good + good, good + " garbage", good + "," + good,
             good + ',"ts":"b"', good.replace('"', "'"), f"[{good}]", "", None, good[:-1]]
    records = spark.createDataFrame([("topic-cpu", t) for t in texts], "topic string, value string")
    found = from_records(records).collect()
    assert [r["problem"] is None for r in found] == [True] * 3 + [False] * 9
    assert [r["ts"] for r in found] == ["a"] * 3 + [None] * 9


def test_refused_lines_are_given_back_as_they_were(spark, tmp_path):
    path = tmp_path / "wide.csv"
    bad = [" a,s,1e2,2,,0.10,5", "\ta,s,01,+2,x,4 ,5", 'a,s,1,2,3,4,"5"', "a,s,1,2,3,4,5,", "a"]
    fine = ["a,s,1e2,2,3,0.10,5", " b,s,nan,+inf,-Infinity,+NaN, 7 "]
    path.write_text("\n".join([*bad, *fine]) + "\n")
    checked = read_wide_csv(spark, str(path))
    refused = checked.filter("problem is not null")
    assert sorted(r.raw for r in refused.select("raw").collect()) == sorted(bad)
    assert sorted(r.problem for r in refused.collect()) == ["field_count"] * 2 + ["not_a_number"] * 3
    good = checked.filter("problem is null").drop("problem", "raw").orderBy("ts").collect()
    assert [tuple(r) for r in good] == [
        ("a", "s", 100.0, 2.0, 3.0, 0.1, 5.0), ("b", "s", None, None, None, None, 7.0),
    ]


def test_strict_reading_fails_whatever_is_asked_for(spark, tmp_path):
    path = tmp_path / "wide.csv"
    path.write_text("a,s,1,2,3,4,5\na,s,1,2\n")
    for ask in (lambda df: df.count(), lambda df: df.select("ts").collect()):
        with pytest.raises(Exception, match="field_count"):
            ask(read_wide_csv(spark, str(path), strict=True))


def test_an_empty_landing_has_no_rows(spark, tmp_path):
    (tmp_path / "landed").mkdir()
    assert read_landed_topic(spark, str(tmp_path / "landed"), "topic-cpu").count() == 0
