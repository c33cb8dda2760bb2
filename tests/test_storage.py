"""Warehouse, published tables, keyed histories and streams: round trips, failures, files left alone."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from vigia.plans import bindings, storage
from vigia.sources import warehouse
from vigia.sources.published import Published
from vigia.streaming import weekly


@pytest.fixture
def url():
    return f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true"


ROWS = [(1, "O'Hara", 1.5, True, "2024-02-29"), (2, None, None, False, None), (None, "x" * 300, -0.25, None, "1999-12-31"), (40, "é日本", 1e300, True, "2001-01-01")]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "id long, nome string, valor double, sim boolean, d string").withColumn("d", F.col("d").cast("date"))


def test_a_table_comes_back_as_it_was(spark, url):
    warehouse.replace(frame(spark), url, "Tabela \"A\"")
    for split in (None, "id"):
        back = warehouse.read(spark, url, 'Tabela "A"', split, 3)
        assert sorted(map(str, back.collect())) == sorted(map(str, frame(spark).collect()))
    assert back.rdd.getNumPartitions() == 3 and [t for _, t in back.dtypes] == ["bigint", "string", "double", "boolean", "date"]
    assert warehouse.row_count(spark, url, 'Tabela "A"') == 4
    warehouse.replace(frame(spark), url, 'Tabela "A"', limit=2)
    assert warehouse.row_count(spark, url, 'Tabela "A"') == 2
    warehouse.replace(frame(spark).limit(0), url, 'Tabela "A"')
    assert warehouse.read(spark, url, 'Tabela "A"', "id").collect() == []


def test_a_failure_leaves_the_old_rows(spark, url):
    warehouse.replace(frame(spark).select("id"), url, "T")
    with pytest.raises(Exception):  # the new rows don't fit the table: the transaction ends as it began
        warehouse.replace(frame(spark).select(F.col("nome").alias("id")), url, "T")
    assert warehouse.row_count(spark, url, "T") == 4
    with pytest.raises(Exception):  # they fail before they reach it
        warehouse.replace(frame(spark).select(F.raise_error(F.lit("no")).cast("long").alias("id")), url, "T")
    assert warehouse.row_count(spark, url, "T") == 4
    warehouse.replace(frame(spark).select("id").limit(1), url, "T")  # what was left of the failures is no hindrance
    assert warehouse.row_count(spark, url, "T") == 1 and not warehouse.exists(spark, url, "T_NEW")


def test_names_are_found_by_literal_patterns(spark, url):
    for name in ("A_B", "AXB", "O'B"):
        warehouse.replace(frame(spark).select("id"), url, name)
    found = lambda *like: sorted(r["TABLE_NAME"] for r in warehouse.tables(spark, url, list(like)).collect())
    assert found("A_B") == ["AXB", "A_B"] and found("O'%") == ["O'B"] and found("x' OR '1'='1") == [] and found() == []
    assert warehouse.exists(spark, url, "A_B") and not warehouse.exists(spark, url, "A_C")
    assert warehouse.column_types(frame(spark), "sqlserver") == '"id" BIGINT, "nome" NVARCHAR(300), "valor" FLOAT, "sim" BIT, "d" DATE'
    with pytest.raises(ValueError):
        warehouse.dialect("jdbc:other:x")


def files(home):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(f"{home}/data") for f in names if f.startswith("part-")}


def week_rows(spark, rows):
    return spark.createDataFrame(rows, "ano long, semana long, municipio string, n long")


def test_only_weeks_that_changed_are_written(spark, tmp_path):
    rows = [(2024, w, m, w) for w in range(1, 6) for m in "abc"] + [(None, None, "a", 9)]
    table = Published(spark, f"file://{tmp_path}", ["ano", "semana"], week_rows(spark, rows).schema)
    assert table.read().collect() == [] and table.publish(week_rows(spark, rows)) == 6
    before = files(tmp_path)
    again = [(a, s, m, n + (s == 3)) for a, s, m, n in rows if s != 5]
    assert table.publish(week_rows(spark, again)) == 1
    after = files(tmp_path)
    assert {f: t for f, t in after.items() if f in before} == before and all("semana=3" in f for f in set(after) - set(before))
    assert sorted(map(str, table.read().collect())) == sorted(map(str, week_rows(spark, again).collect()))
    assert sorted(map(str, table.read(1).collect())) == sorted(map(str, week_rows(spark, rows).collect()))
    assert table.publish(week_rows(spark, again)) == 0


def test_a_write_that_fails_leaves_the_old_table(spark, tmp_path):
    rows = week_rows(spark, [(2024, 1, "a", 1), (2024, 2, "a", 2)])
    table = Published(spark, f"file://{tmp_path}", ["ano", "semana"], rows.schema)
    table.publish(rows)
    broken = rows.withColumn("n", F.when(F.col("semana") == 2, F.raise_error(F.lit("no")).cast("long")).otherwise(F.col("n") + 5))
    with pytest.raises(Exception):
        table.publish(broken)
    assert table.current() == 1 and sorted(r["n"] for r in table.read().collect()) == [1, 2]
    table.publish(rows.withColumn("n", F.col("n") + 5))
    assert sorted(r["n"] for r in table.read().collect()) == [6, 7]


def test_merge_touches_only_the_parts_of_its_rows_and_old_files_go(spark, tmp_path):
    rows = week_rows(spark, [(2024, w, "a", w) for w in range(1, 30)])
    table = Published(spark, f"file://{tmp_path}", ["ano", "semana"], rows.schema)
    table.publish(rows)
    sizes = []
    for k in range(1, 5):
        new = week_rows(spark, [(2024, 7, "b", k), (2024, 40 + k, "b", k)])
        assert table.merge(new, lambda old, new: old.unionByName(new)) == 2
        assert table.merge(new, lambda old, new: old.unionByName(new), base=k) == 2  # taken again, it gives the same
        sizes.append(len(files(tmp_path)))
        assert table.read().where("semana = 7").count() == 1 + k
    # parts: 29 + one a merge; of week 7 the files of the last two versions
    assert sizes == [29 + 1 + 1, 29 + 1 + 2, 29 + 1 + 3, 29 + 1 + 4]
    assert sorted(os.listdir(tmp_path / "manifests")) == ["4", "5"]


def test_the_manifest_is_written_behind_a_shuffle(spark, tmp_path, monkeypatch):
    """one task writes it, but does not hold the joins and groupings of all partitions before it."""
    rows = week_rows(spark, [(2024, w, "a", w) for w in range(1, 9)])
    table = Published(spark, f"file://{tmp_path}", ["ano", "semana"], rows.schema)
    merged = []
    frame = type(rows)
    monkeypatch.setattr(frame, "coalesce", lambda self, n, f=frame.coalesce: merged.append(n) or f(self, n))
    table.publish(rows)
    assert merged == [] and len([f for f in os.listdir(tmp_path / "manifests/1") if f.startswith("part-")]) == 1


def arrive(spark, folder, rows):
    frame = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    frame.coalesce(1).write.mode("append").parquet(str(folder))


def test_a_batch_rewrites_only_its_buckets(spark, tmp_path):
    arrive(spark, tmp_path / "in", [(k, "2024-01-01 00:00:00", k, "x", float(k), None) for k in range(200)])
    run = lambda: {r["user_id"]: r["value"] for r in weekly.run_upserts(spark, str(tmp_path / "in"), ["user_id"], "ts", home=str(tmp_path / "home"), buckets=16).collect()}
    assert run() == {k: float(k) for k in range(200)}
    before = files(tmp_path / "home/table")
    arrive(spark, tmp_path / "in", [(900, "2024-01-02 00:00:00", 7, "x", 0.5, None)])
    assert run() == {k: float(k) for k in range(200)} | {7: 0.5}
    after = files(tmp_path / "home/table")
    assert len(before) == 16 and len(set(after) - set(before)) == 1


def test_records_count_once_and_late_rows_stand_apart(spark, tmp_path):
    day = lambda d, i, v=1.0: (i, f"2024-{d} 00:00:00", 1, "x", v, None)
    arrive(spark, tmp_path / "in", [day("01-01", 1), day("01-02", 2), day("01-02", 2)])
    run = lambda: weekly.run_distinct(spark, str(tmp_path / "in"), late="7 days", home=str(tmp_path / "home"))
    weeks, late = run()
    assert weeks.collect() == [] and late.collect() == []
    arrive(spark, tmp_path / "in", [day("01-02", 2), day("01-03", 3), day("01-30", 4)])
    weeks, late = run()
    assert [(str(r["semana"]), r["n"]) for r in weeks.collect()] == [("2024-01-01", 3)] and late.collect() == []
    arrive(spark, tmp_path / "in", [day("01-04", 5), day("01-30", 4), day("01-31", 6), day("02-28", 7)])
    weeks, late = run()
    assert sorted((str(r["semana"]), r["n"]) for r in weeks.collect()) == [("2024-01-01", 3), ("2024-01-29", 2)]
    assert [r["event_id"] for r in late.collect()] == [5]


def test_the_state_of_records_lies_on_disk(spark, tmp_path):
    """a store in memory holds a row for every record of the watermark; the session's own settings stay as they are."""
    settings = {k: spark.conf.get(k, None) for k in weekly.ON_DISK}
    arrive(spark, tmp_path / "in", [(k, "2024-01-01 00:00:00", k, "x", 1.0, None) for k in range(20)])
    weekly.run_distinct(spark, str(tmp_path / "in"), home=str(tmp_path / "home"))
    assert "RocksDBStateStoreProvider" in (tmp_path / "home/state/offsets/0").read_text()
    assert {k: spark.conf.get(k, None) for k in weekly.ON_DISK} == settings


def test_events_arrive_whole_and_from_many_tasks(spark, tmp_path, monkeypatch):
    """no task takes all of the ids or all of the events, and those without an id arrive too; the late ones are the same."""
    rows = [(k, f"2024-01-{1 + k % 20:02d} 00:00:00", k, "click" if k % 3 else "view", float(k), None) for k in range(300)] + [(None, "2024-01-30 00:00:00", 1, "view", 0.5, None)]
    arrive(spark, tmp_path / "t/events.parquet", rows[:150])
    arrive(spark, tmp_path / "t/events.parquet", rows[150:])
    monkeypatch.setattr(bindings, "TASK_BYTES", 1000)
    monkeypatch.setattr(storage.stream, "work_folder", lambda spark, name: f"file://{tmp_path}/{name}")
    plans, frame = [], type(spark.range(1))
    monkeypatch.setattr(frame, "join", lambda self, other, *a, f=frame.join: plans.append(other._jdf.queryExecution().toString()) or f(self, other, *a))
    late = sorted(tuple(r) for r in storage.stream_late(spark, str(tmp_path / "t")).collect())
    assert late == sorted((r[0], r[3], r[4]) for r in rows if r[3] == "click" and r[1] < "2024-01-27")
    assert spark.read.schema(weekly.SCHEMA).parquet(f"file://{tmp_path}/arrivals").count() == len(rows) + len(late)
    assert not any("percentile(" in p for p in plans)
    assert all(len([f for f in os.listdir(tmp_path / d) if f.startswith("part-")]) > n for d, n in (("arrivals", 3), ("late-arrivals", 2)))
