"""JSON records in, each once, none lost."""

import json
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from assayline.schemas import BRONZE, BRONZE_FIELDS
from assayline.sources import (
    read_bronze,
    read_products,
    read_records,
    read_rejects,
    split_records,
    write_records,
)
from assayline.sinks.versions import Versions
from assayline.streaming import compact, land_batch, land_stream, landing
from assayline.streaming.changes import ChangedDays
from tests.helpers import EDGE_RECORDS, bronze_of, plan_of, record, rows_of

UNIQUE = ["e1", "e2", "e3", "e4", "e5", "e6", "e7", "e8"]


def send(folder, records, name, extra=()):
    os.makedirs(folder, exist_ok=True)
    lines = [json.dumps(r, ensure_ascii=False) for r in records] + list(extra)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as out:
        out.write("".join(line + "\n" for line in lines))


def ids(spark, path):
    return sorted(r.event_id for r in read_bronze(spark, path).collect())


@pytest.fixture
def paths(tmp_path):
    return {k: str(tmp_path / k) for k in ("raw", "bronze", "state", "rejects")}


def stream(spark, paths, **options):
    return land_stream(spark, paths["raw"], paths["bronze"], paths["state"], **options)


def test_record_round_trip(spark, tmp_path):
    records = bronze_of(spark, EDGE_RECORDS)
    write_records(records, str(tmp_path / "out"))
    assert rows_of(read_records(spark.read, str(tmp_path / "out"))) == rows_of(records)
    text = spark.read.text(str(tmp_path / "out")).where("value like '%운동화%'").first()[0]
    assert json.loads(text)["user_id"] == "USER-002" and '"item_id":null' in text


def test_resent_records_land_once(spark, paths):
    send(paths["raw"], EDGE_RECORDS[:5], "1.json")
    stream(spark, paths)
    send(paths["raw"], EDGE_RECORDS, "2.json")
    stream(spark, paths)
    assert ids(spark, paths["bronze"]) == UNIQUE
    stream(spark, paths)
    assert ids(spark, paths["bronze"]) == UNIQUE


def test_records_without_an_id_are_not_merged(spark, paths):
    records = [record(None, "2026-01-10 00:00:00", f"S{i}", "view") for i in range(5)]
    send(paths["raw"], records + records[:2], "1.json")
    stream(spark, paths)
    sessions = read_bronze(spark, paths["bronze"]).select("session_id")
    assert sorted(r.session_id for r in sessions.collect()) == ["S0", "S1", "S2", "S3", "S4"]


def test_any_lateness_lands_against_the_table(spark, paths):
    send(paths["raw"], [record("new", "2026-03-01 00:00:00", "S", "view")], "1.json")
    stream(spark, paths)
    send(paths["raw"], EDGE_RECORDS, "2.json")
    stream(spark, paths)
    assert ids(spark, paths["bronze"]) == UNIQUE + ["new"]


def test_small_micro_batches(spark, paths):
    for i in range(4):
        send(paths["raw"], EDGE_RECORDS, f"{i}.json")
    stream(spark, paths, max_bytes=1)
    assert ids(spark, paths["bronze"]) == UNIQUE


def test_batch_twice_lands_once(spark, paths):
    send(paths["raw"], EDGE_RECORDS, "1.json")
    for _ in range(2):
        land_batch(read_records(spark.read, paths["raw"]), paths["bronze"])
    assert ids(spark, paths["bronze"]) == UNIQUE
    days = {r[0].isoformat() for r in read_bronze(spark, paths["bronze"]).select("event_date").collect()}
    assert days == {"2026-01-10", "2026-01-11"}


def test_batch_over_thousands_of_days(spark, paths):
    rows = spark.range(3000).selectExpr(
        "concat('d', id) as event_id",
        "date_format(date_add(date'2020-01-01', int(id)), 'yyyy-MM-dd 01:00:00') as event_timestamp",
    )
    for name in BRONZE.names:
        if name not in rows.columns:
            rows = rows.selectExpr("*", f"cast(null as {dict(BRONZE_FIELDS)[name]}) as {name}")
    for days in (2500, 3000):
        land_batch(rows.where(f"int(substring(event_id, 2)) < {days}"), paths["bronze"])
    landed = read_bronze(spark, paths["bronze"])
    assert landed.count() == landed.select("event_id").distinct().count() == 3000


NO_TIME = record("n1", None, "S", "view")
NO_ID = record(None, "2026-01-10 00:00:00", "S", "view")
NEITHER = record(None, None, "S", "view")
FUTURE = record("f1", "2099-01-01 00:00:00", "S", "view")


@pytest.mark.parametrize("odd", [NO_TIME, NO_ID, NEITHER, FUTURE])
def test_odd_records_land_once(spark, paths, odd):
    send(paths["raw"], [odd], "1.json")
    stream(spark, paths)
    send(paths["raw"], [*EDGE_RECORDS, odd, odd], "2.json")
    send(paths["raw"], [odd, *EDGE_RECORDS], "3.json")
    stream(spark, paths, max_bytes=1)
    for _ in range(2):
        land_batch(read_records(spark.read, paths["raw"]), paths["bronze"])
    found = [r.event_id for r in read_bronze(spark, paths["bronze"]).collect()]
    assert sorted(found, key=str) == sorted([*UNIQUE, odd["event_id"]], key=str)


def test_one_id_on_two_days_is_two_records(spark, paths):
    days = [record("x", f"2026-01-1{d} 00:00:00", "S", "view") for d in (0, 1)]
    for k in range(2):
        send(paths["raw"], days, f"{k}.json")
        stream(spark, paths)
    assert ids(spark, paths["bronze"]) == ["x", "x"]


BROKEN = ['{"event_id": "x", "quantity": ', '{"event_id": "y", "quantity": "many"}']


def test_malformed_line_fails_unless_set_aside(spark, paths):
    send(paths["raw"], EDGE_RECORDS, "1.json", BROKEN)
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_records(spark.read, paths["raw"]).collect()
    kept = read_records(spark.read, paths["raw"], keep_going=True)
    assert rows_of(kept) == rows_of(bronze_of(spark, EDGE_RECORDS))
    assert sorted(r.line for r in read_rejects(spark.read, paths["raw"]).collect()) == sorted(BROKEN)


BAD_TIME = '{"event_id": "z", "event_timestamp": "2026-13-45 99:00:00"}'


def rejects(spark, paths):
    rows = spark.read.schema("line string, file string, reason string").json(paths["rejects"]).collect()
    return sorted((r.line, os.path.basename(r.file), r.reason) for r in rows)


def test_stream_sets_bad_lines_aside_with_their_reason(spark, paths):
    send(paths["raw"], EDGE_RECORDS, "1.json", BROKEN + ["", "  "])
    send(paths["raw"], EDGE_RECORDS[:2], "2.json", [BAD_TIME, "[1]", BROKEN[0]])
    stream(spark, paths, rejects_path=paths["rejects"])
    assert ids(spark, paths["bronze"]) == UNIQUE
    expected = [(line, "1.json", "malformed") for line in BROKEN]
    expected += [(BAD_TIME, "2.json", "time"), ("[1]", "2.json", "malformed"), (BROKEN[0], "2.json", "malformed")]
    assert rejects(spark, paths) == sorted(expected)


def test_a_batch_that_runs_again_rejects_once(spark, paths):
    send(paths["raw"], EDGE_RECORDS, "1.json", BROKEN)
    lines = split_records(spark.read, paths["raw"])
    for _ in range(2):
        landing._land_good(lines, paths["bronze"], f"{paths['rejects']}/batch=0", 4)
    assert ids(spark, paths["bronze"]) == UNIQUE
    assert [r[0] for r in rejects(spark, paths)] == sorted(BROKEN)


def test_good_and_bad_lines_come_from_one_scan(spark, paths):
    send(paths["raw"], EDGE_RECORDS, "1.json", BROKEN)
    lines = split_records(spark.read, paths["raw"]).persist()
    bad, good = lines.where("reason is not null"), lines.where("reason is null")
    for part in (bad, good):
        assert "InMemoryTableScan" in plan_of(part)
    assert plan_of(lines).count("FileScan") == 1
    lines.unpersist()


def test_a_line_is_kept_for_landing_or_for_the_rejects(spark, paths):
    send(paths["raw"], EDGE_RECORDS, "1.json", extra=["{not json"])
    kept = landing._for_both(split_records(spark.read, paths["raw"])).collect()
    assert sum(r.reason is None for r in kept) == len(EDGE_RECORDS)
    for row in kept:
        good = row.reason is None
        assert (row.record is not None) == good and (row.line is None) == good and (row.file is None) == good


def test_without_rejects_a_bad_time_fails(spark, paths):
    send(paths["raw"], EDGE_RECORDS, "1.json", [BAD_TIME])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stream(spark, paths)


def test_products_csv(spark, tmp_path):
    path = tmp_path / "products.csv"
    path.write_text("item_id,name,category,price\nITEM-309,생수 2L 6개입,식품,3900\n", encoding="utf-8")
    assert [tuple(r) for r in read_products(spark, str(path)).collect()] == [
        ("ITEM-309", "생수 2L 6개입", "식품", 3900)
    ]
    path.write_text("item_id,name,price,category\nITEM-309,x,3900,y\n", encoding="utf-8")
    with pytest.raises(Exception, match="header"):
        read_products(spark, str(path)).collect()
    path.write_text("item_id,name,category,price\nITEM-309,x,y,cheap\n", encoding="utf-8")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_products(spark, str(path)).collect()


def test_what_has_landed_is_read_by_bucket_and_never_shuffled(spark, paths):
    send(paths["raw"], EDGE_RECORDS, "1.json")
    records = read_records(spark.read, paths["raw"])
    land_batch(records, paths["bronze"], buckets=4)
    late = bronze_of(spark, [record("late", "2026-01-10 05:00:00", "S", "view")])
    land_batch(late, paths["bronze"])
    table = landing.LandedTable.at(spark, paths["bronze"], 99)
    rows = landing.unlanded(late, table)
    plan = plan_of(rows)
    # The branch below the join that scans the landed table, down to its scan.
    landed = plan[plan.index("SortMergeJoin") :]
    scan = landed.index("Bucketed: true")
    branch = landed[: scan].rsplit("\n", 8)
    assert "SelectedBucketsCount: 4 out of 4" in landed
    assert not any("Exchange" in line for line in branch[-4:])
    assert plan.count("Exchange") == 1 and "rangepartitioning" not in plan
    assert "ReadSchema: struct<record_key:string>" in plan
    assert "2026-01-10" in plan[plan.index("PartitionFilters") :].split("]")[0]
    assert "2026-01-11" not in plan and rows_of(rows) == []


def data_files(paths, day):
    """Data files of the day's current version."""
    folder = f"{paths['bronze']}/event_date={day}"
    return [f for f in os.listdir(f"{folder}/{max(os.listdir(folder))}") if f.startswith("part-")]


def test_files_of_a_day_are_no_more_than_the_buckets(spark, paths):
    many = bronze_of(spark, [record(f"e{i}", "2026-01-10 00:00:00", "S", "view") for i in range(200)])
    land_batch(many.repartition(16), paths["bronze"], buckets=4)
    assert len(data_files(paths, "2026-01-10")) == 4
    assert len(ids(spark, paths["bronze"])) == 200


def test_a_large_batch_is_dealt_into_parts_of_the_buckets(spark, paths, monkeypatch):
    monkeypatch.setattr(landing, "TASK_BYTES", 4_000)
    records = [record(f"e{k}", f"2026-01-{10 + k % 3} 09:00:00", "S", "view") for k in range(400)]
    first, every = (bronze_of(spark, r) for r in (records[::2], records + records[:50]))
    land_batch(first, paths["bronze"], buckets=2)
    table = landing.LandedTable.at(spark, paths["bronze"])
    rows = landing.unlanded(every, table).select(landing.KEY, F.spark_partition_id().alias("part"))
    placed = rows.select("part", F.expr(f"pmod(hash({landing.KEY}), 2)").alias("bucket")).collect()
    assert len(placed) == 200
    parts = {part: sum(p == part for p, _ in placed) for part, _ in placed}
    assert len(parts) > 10 and max(parts.values()) < 40
    assert len(set(placed)) == len(parts)  # every part lies in one bucket
    for _ in range(2):
        land_batch(every, paths["bronze"])
        assert ids(spark, paths["bronze"]) == sorted(r["event_id"] for r in records)
    compact(spark, paths["bronze"], most=1)
    assert ids(spark, paths["bronze"]) == sorted(r["event_id"] for r in records)
    land_batch(bronze_of(spark, records[:5]), paths["bronze"])
    assert len(ids(spark, paths["bronze"])) == 400


def test_records_without_an_id_spread_over_the_buckets(spark, paths):
    rows = [record(None, "2026-01-10 00:00:00", f"S{i}", "view") for i in range(200)]
    for _ in range(2):
        land_batch(bronze_of(spark, rows), paths["bronze"], buckets=4)
    assert len(data_files(paths, "2026-01-10")) == 4 and read_bronze(spark, paths["bronze"]).count() == 200


def test_another_session_finds_the_buckets_and_days(spark, paths):
    land_batch(bronze_of(spark, EDGE_RECORDS), paths["bronze"], buckets=4)
    landing.LandedTable._open.clear()
    land_batch(bronze_of(spark, [*EDGE_RECORDS, NO_TIME]), paths["bronze"], buckets=9)
    assert sorted(ids(spark, paths["bronze"])) == sorted([*UNIQUE, "n1"])
    assert landing.LandedTable.at(spark, paths["bronze"]).buckets == 4


def test_a_folder_without_buckets_is_refused(spark, paths):
    os.makedirs(f"{paths['bronze']}/event_date=2026-01-10")
    with pytest.raises(ValueError, match="not landed in buckets"):
        land_batch(bronze_of(spark, EDGE_RECORDS), paths["bronze"])


def test_a_batch_notes_the_days_it_adds_to(spark, paths, tmp_path):
    notes = ChangedDays(spark, paths["bronze"])

    def changed(warehouse):
        return sorted({d.isoformat() for own in notes.pending(warehouse).values() for d in own})

    land_batch(bronze_of(spark, [*EDGE_RECORDS, NO_TIME]), paths["bronze"])
    assert changed("w1") == ["2026-01-10", "2026-01-11"]
    warehouse = str(tmp_path / "w")
    notes.done(warehouse, notes.pending(warehouse))
    assert changed(warehouse) == []
    land_batch(bronze_of(spark, EDGE_RECORDS), paths["bronze"])  # nothing new
    assert changed(warehouse) == []
    land_batch(bronze_of(spark, [record("l", "2026-01-03 00:00:00", "S", "view")]), paths["bronze"])
    assert changed(warehouse) == ["2026-01-03"]
    assert changed(str(tmp_path / "other")) == ["2026-01-03", "2026-01-10", "2026-01-11"]


def test_a_batch_that_fails_in_between_lands_when_it_runs_again(spark, paths, monkeypatch):
    def broken(*_, **__):
        raise OSError("lost")

    writer = type(spark.range(1).write)
    with monkeypatch.context() as m:
        m.setattr(writer, "insertInto", broken)
        with pytest.raises(OSError):
            land_batch(bronze_of(spark, EDGE_RECORDS), paths["bronze"])
    land_batch(bronze_of(spark, EDGE_RECORDS), paths["bronze"])
    assert ids(spark, paths["bronze"]) == UNIQUE
    assert len(ChangedDays(spark, paths["bronze"]).pending("w")) == 2


# --- compaction


def in_batches(spark, paths, records, size=2, buckets=2):
    for k in range(0, len(records), size):
        land_batch(bronze_of(spark, records[k : k + size]), paths["bronze"], buckets=buckets)


def day_of(k):
    return [record(f"e{k}-{i}", f"2026-01-{k:02} 00:00:00", "S", "view") for i in range(10)]


def test_compaction_bounds_the_files_and_keeps_the_records(spark, paths):
    records = [*day_of(10), *day_of(11)[:2], *[record(f"n{i}", None, "S", "view") for i in range(6)]]
    in_batches(spark, paths, records)
    before = rows_of(read_bronze(spark, paths["bronze"]))
    assert len(data_files(paths, "2026-01-10")) > 4
    days = compact(spark, paths["bronze"], most=2)
    assert str(days[0]) == "2026-01-10" and "2026-01-11" not in map(str, days)
    assert len(data_files(paths, "2026-01-10")) <= 2
    assert rows_of(read_bronze(spark, paths["bronze"])) == before
    one_day = read_bronze(spark, paths["bronze"], day="2026-01-10")
    assert sorted(r.event_id for r in one_day.collect()) == [r["event_id"] for r in day_of(10)]
    # Landing goes on against the compacted day, in this session and in another.
    in_batches(spark, paths, records)
    landing.LandedTable._open.clear()
    in_batches(spark, paths, [*records, record("late", "2026-01-10 03:00:00", "S", "view")])
    assert sorted(ids(spark, paths["bronze"])) == sorted([r["event_id"] for r in records] + ["late"])
    assert compact(spark, paths["bronze"], most=50) == []


def test_a_version_that_is_being_read_stays(spark, paths):
    in_batches(spark, paths, day_of(10))
    reading = read_bronze(spark, paths["bronze"])
    compact(spark, paths["bronze"], most=1)
    assert reading.count() == 10
    in_batches(spark, paths, [record(f"x{i}", "2026-01-10 00:00:00", "S", "view") for i in range(8)])
    compact(spark, paths["bronze"], most=1)
    assert len(os.listdir(f"{paths['bronze']}/event_date=2026-01-10")) == 2


def test_a_batch_that_lands_during_compaction_is_kept(spark, paths, monkeypatch):
    """Once between the copy and the switch, once after it, into the version that was left."""
    late = [record(f"late{k}", "2026-01-10 01:00:00", "S", "view") for k in (0, 1)]
    in_batches(spark, paths, day_of(10))
    real = Versions.finish

    def finish_after_a_batch(self, run, days):
        land_batch(bronze_of(spark, late[:1]), paths["bronze"])
        return real(self, run, days)

    with monkeypatch.context() as m:
        m.setattr(Versions, "finish", finish_after_a_batch)
        compact(spark, paths["bronze"], most=1)
    assert sorted(ids(spark, paths["bronze"])) == sorted([r["event_id"] for r in day_of(10)] + ["late0"])

    in_batches(spark, paths, [record(f"y{i}", "2026-01-10 00:00:00", "S", "view") for i in range(6)])
    append = landing._append
    ran = []

    def append_to_the_old_version(records, table):
        if ran:
            return append(records, table)
        ran.append(1)
        old = append(records, table)
        # As if the day had been copied just before the batch was written, and switched to after.
        table.versions.finish(run, [date(2026, 1, 10)])
        return old

    run = landing.LandedTable.at(spark, paths["bronze"]).versions.start()
    rows = read_bronze(spark, paths["bronze"], day="2026-01-10")
    keyed = rows.withColumn("record_key", landing._identity()).drop("event_date")
    folder = landing.LandedTable.at(spark, paths["bronze"]).versions.folder(date(2026, 1, 10), run)
    staging = f"staging_{run.replace('-', '_')}"
    spark.sql(
        f"CREATE TABLE {staging} ({landing._COLUMNS}) USING PARQUET CLUSTERED BY (record_key) "
        f"INTO 2 BUCKETS LOCATION '{folder}'"
    )
    keyed.repartition(2, "record_key").write.insertInto(staging)
    with monkeypatch.context() as m:
        m.setattr(landing, "_append", append_to_the_old_version)
        land_batch(bronze_of(spark, late), paths["bronze"])
    spark.sql(f"DROP TABLE {staging}")
    found = ids(spark, paths["bronze"])
    assert found.count("late1") == 1 and len(found) == len(set(found)) == 18


def test_a_compaction_that_fails_changes_nothing(spark, paths, monkeypatch):
    in_batches(spark, paths, day_of(10))
    files = data_files(paths, "2026-01-10")
    writer = type(spark.range(1).write)

    def broken(*_, **__):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(writer, "insertInto", broken)
        with pytest.raises(OSError):
            compact(spark, paths["bronze"], most=1)
    assert data_files(paths, "2026-01-10") == files and len(ids(spark, paths["bronze"])) == 10
    compact(spark, paths["bronze"], most=1)
    assert len(data_files(paths, "2026-01-10")) == 2
