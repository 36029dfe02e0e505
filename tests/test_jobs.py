"""The alert jobs from their command lines, and their files."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest

from hostvigil.config import CPU_MEM, NET_DISK, load_thresholds
from hostvigil.jobs import alerting
from hostvigil.operators.split import to_records
from hostvigil.schemas import CPU_MEM_ALERT, WIDE
from hostvigil.session import scratch_dir
from hostvigil.sinks.tables import publish_single_csv, write_table
from hostvigil.sources.landed import read_alerts

ROOT = Path(__file__).resolve().parent.parent


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture
def csvs(tmp_path):
    return {
        "cpu": write(tmp_path / "cpu.csv", "ts,server_id,cpu_pct", "20:53:00,server_2,80",
                     "20:53:05,server_2,90", "20:53:00,server_10,75.69", "08:00:00,server_2,1",
                     "bad,server_2,1"),
        "mem": write(tmp_path / "mem.csv", "ts,server_id,mem_pct", "20:53:00,server_2,10.005",
                     "20:53:05,server_2,10", "20:53:00,server_10,80", "08:00:00,server_2,1",
                     "20:53:09,server_2,1"),
        "net": write(tmp_path / "net.csv", "ts,server_id,net_in,net_out",
                     "20:53:00,server_1,7000,1", "20:53:10,server_1,6477.4,1"),
        "disk": write(tmp_path / "disk.csv", "ts,server_id,disk_io",
                      "20:53:00,server_1,1000", "20:53:10,server_1,1200"),
    }


def test_cpu_mem_job_writes_one_sorted_csv(spark, csvs, tmp_path):
    out = tmp_path / "alerts.csv"
    report = alerting.main(CPU_MEM, "cpu", "mem", [
        "--cpu_csv", csvs["cpu"], "--mem_csv", csvs["mem"], "--out", str(out), "--full_counts",
        "--preview", "--single_file",
    ])
    assert out.read_text().splitlines() == [
        "server_id,window_start,window_end,avg_cpu,avg_mem,alert",
        "server_10,20:53:00,20:53:30,75.69,80.0,Memory saturation suspected",
        "server_2,20:53:00,20:53:30,85.0,10.0,CPU spike suspected",
    ]
    assert report == alerting.JobReport(
        left_records=5, right_records=5, joined_records=4, earliest="08:00:00", windows=2,
        output=str(out), left_read=5, right_read=5, left_bad_times=1, right_bad_times=0,
    )

    # Running again replaces the file; without full counts, early readings are not looked at.
    report = alerting.main(CPU_MEM, "cpu", "mem", [
        "--cpu_csv", csvs["cpu"], "--mem_csv", csvs["mem"], "--out", str(out),
        "--cpu_threshold", "85", "--mem_threshold", "9.5", "--single_file",
    ])
    assert report.joined_records == 3 and report.earliest == "20:53:00"
    assert (report.left_records, report.left_read, report.right_read) == (None, 4, 4)
    assert [line.split(",")[-1] for line in out.read_text().splitlines()[1:]] == [
        "Memory saturation suspected", "Memory saturation suspected",
    ]


def test_unreadable_times_join_nothing_in_the_report(spark, tmp_path):
    cpu = write(tmp_path / "cpu.csv", "ts,server_id,cpu_pct", "20:53:00,s,1", "bad,s,2",
                "ts,server_id,cpu_pct", ",s,3")
    mem = write(tmp_path / "mem.csv", "ts,server_id,mem_pct", "20:53:00,s,1", "bad,s,2",
                "ts,server_id,mem_pct", ",s,3")
    for more in ([], ["--full_counts"]):
        report = alerting.main(CPU_MEM, "cpu", "mem", [
            "--cpu_csv", cpu, "--mem_csv", mem, "--out", str(tmp_path / "out"), *more,
            "--quarantine", str(tmp_path / "bad"),
        ])
        assert (report.joined_records, report.earliest) == (1, "20:53:00")
        bad = spark.read.option("header", True).csv(str(tmp_path / "bad")).collect()
        assert sorted((r.topic, r.ts or "", r.problem) for r in bad) == [
            (topic, ts, "bad_time")
            for topic in ("topic-cpu", "topic-mem") for ts in ("", "bad", "ts")
        ]
    assert (report.left_bad_times, report.right_bad_times) == (3, 3)
    scratch = Path(scratch_dir(spark, "x").removeprefix("file:")).parent
    assert not list(scratch.glob("cpu_mem-*"))


def test_every_line_of_a_thresholds_file_counts(spark, tmp_path):
    long = write(tmp_path / "long.txt", *["cpu_threshold: 1"] * 100, "mem_threshold: 7")
    assert load_thresholds(spark, long)["cpu_mem"].right.threshold == 7
    with pytest.raises(ValueError, match="not a threshold line"):
        load_thresholds(spark, write(tmp_path / "bad.txt", "cpu_threshold: 1", "cpu_treshold: 2"))


def test_net_disk_job_with_threshold_file(spark, csvs, tmp_path):
    limits = write(tmp_path / "limits.txt", "net_in_threshold: 6000", "disk_io_threshold: 5000")
    out = tmp_path / "alerts.csv"
    alerting.main(NET_DISK, "net", "disk", [
        "--net_csv", csvs["net"], "--disk_csv", csvs["disk"], "--out", str(out),
        "--thresholds", limits, "--disk_threshold", "1100", "--single_file",
    ])
    assert out.read_text().splitlines() == [
        "server_id,window_start,window_end,max_net_in,max_disk_io,alert",
        "server_1,20:53:00,20:53:30,7000.0,1200.0,Network flood + Disk thrash suspected",
        "server_1,20:53:10,20:53:40,6477.4,1200.0,Network flood + Disk thrash suspected",
    ]


def test_results_are_sorted_parts_unless_one_file_is_asked_for(spark, csvs, tmp_path):
    out = tmp_path / "alerts"
    report = alerting.main(CPU_MEM, "cpu", "mem", [
        "--cpu_csv", csvs["cpu"], "--mem_csv", csvs["mem"], "--out", str(out),
    ])
    assert out.is_dir() and report.windows == 2
    parts = sorted(out.glob("part-*.csv"))
    lines = [line for part in parts for line in part.read_text().splitlines()[1:]]
    assert [line.split(",")[0] for line in lines] == ["server_10", "server_2"]


def test_windows_and_cutoff_can_be_set(spark, csvs, tmp_path):
    def windows(*flags):
        return alerting.main(CPU_MEM, "cpu", "mem", [
            "--cpu_csv", csvs["cpu"], "--mem_csv", csvs["mem"], "--out", str(tmp_path / "out"),
            *flags,
        ]).windows

    assert windows("--cutoff", "none") == 9
    assert windows("--cutoff", "08:00:00", "--size_seconds", "5", "--slide_seconds", "5") == 4
    with pytest.raises(SystemExit):
        windows("--since", "2024-01-01")


def test_no_windows_still_give_a_header(spark, csvs, tmp_path):
    empty = write(tmp_path / "none.csv", "ts,server_id,cpu_pct")
    out = tmp_path / "alerts.csv"
    report = alerting.main(CPU_MEM, "cpu", "mem", [
        "--cpu_csv", empty, "--mem_csv", csvs["mem"], "--out", str(out), "--single_file",
    ])
    assert report.windows == 0 and report.joined_records == 0 and report.earliest is None
    assert out.read_text().splitlines() == [
        "server_id,window_start,window_end,avg_cpu,avg_mem,alert"
    ]


def test_values_survive_the_csv(spark, tmp_path):
    rows = [("s", "a", "b", None, float("inf"), ""), ("x, y", "a", "b", 1.25, -0.5, 'q "z"')]
    df = spark.createDataFrame(rows, CPU_MEM_ALERT)
    path = str(tmp_path / "table")
    write_table(df, path, "csv")
    back = read_alerts(spark, path, CPU_MEM_ALERT)
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    text = "".join(p.read_text() for p in Path(path).glob("part-*.csv"))
    assert 's,a,b,,Infinity,""' in text and '"x, y"' in text


def test_single_file_publishing(spark, tmp_path):
    path = tmp_path / "one.csv"
    path.write_text("old")
    assert publish_single_csv(spark.range(3).repartition(3).orderBy("id"), str(path))
    assert path.read_text().split() == ["id", "0", "1", "2"]
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["one.csv"]

    folder = tmp_path / "kept"
    folder.mkdir()
    (folder / "notes.txt").write_text("mine")
    with pytest.raises(Exception, match="is a folder"):
        publish_single_csv(spark.range(3), str(folder))
    assert (folder / "notes.txt").read_text() == "mine"


def test_records_of_all_topics_can_be_written_as_messages(spark):
    wide = spark.createDataFrame([("20:53:00", "s", 1.0, 2.0, 3.0, 4.0, 5.0)], WIDE)
    assert dict(to_records(wide).dtypes) == {"topic": "string", "value": "binary"}


def session_with(shared, master):
    """Just enough of a session to ask for its shared folder and master."""
    values = {"spark.checkpoint.dir": shared, "spark.sql.warehouse.dir": "hdfs:///warehouse"}
    conf = SimpleNamespace(get=lambda key, default=None: values.get(key) or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_scratch_lies_in_the_shared_folder():
    cluster = session_with("hdfs:///shared/", "yarn")
    first, second = scratch_dir(cluster, "x"), scratch_dir(cluster, "x")
    assert first.startswith("hdfs:///shared/hostvigil/x-") and first != second
    assert scratch_dir(session_with(None, "yarn"), "x").startswith("hdfs:///warehouse/_scratch/")


def test_every_job_has_a_command_line():
    for job in ("cpu_mem", "net_disk", "publish", "land", "compact"):
        done = subprocess.run(
            [sys.executable, "-m", f"hostvigil.jobs.{job}", "--help"],
            cwd=ROOT, capture_output=True, text=True, timeout=60,
        )
        assert done.returncode == 0 and "usage" in done.stdout


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[3,2,1024]"])
def test_clusters_need_a_shared_folder(master):
    conf = {"spark.sql.warehouse.dir": "/warehouse"}
    session = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(session, "x")
    conf["spark.checkpoint.dir"] = "hdfs:///shared/"
    assert scratch_dir(session, "x").startswith("hdfs:///shared/hostvigil/x-")
    session.sparkContext.master, conf["spark.checkpoint.dir"] = "local[4]", None
    assert scratch_dir(session, "x").startswith("/warehouse/_scratch/")
