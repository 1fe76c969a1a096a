"""Distinct counts over spans of days from stored bitmaps, against counting the rows."""

import random
from datetime import date, timedelta

import pytest

from assayline import operators as op
from assayline.functions import days_between
from assayline.schemas import sets_of
from tests.helpers import plan_of

SPEC = sets_of("test", "kind", "day")
SCHEMA = "kind string, id string, day date"


def rows_for(seed, count=3000):
    r = random.Random(seed)
    hot = ["hot"] * 5
    return [
        (
            r.choice([*hot, "a", "b", "ü", "", None]),
            r.choice([None, f"id{r.randrange(700)}", f"id{r.randrange(40_000)}"]),
            date(2026, 1, 1) + timedelta(days=r.randrange(10)),
        )
        for _ in range(count)
    ]


def stored(spark, path, rows, pieces=1):
    codes = op.IdCodes(spark, path)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5).cache()
    for k in range(pieces):
        part = frame.where(f"pmod(hash(id), {pieces}) <= {k}")
        codes.extend(part.select("id"))
    return codes, op.day_sets(frame, SPEC, "id", codes.read())


@pytest.mark.parametrize("pieces", [1, 3])
def test_any_span_counts_like_the_rows(spark, tmp_path, pieces):
    rows = rows_for(pieces)
    codes, sets = stored(spark, str(tmp_path / "codes"), rows, pieces)
    sets = sets.cache()
    for first, last in (("2026-01-01", "2026-01-10"), ("2026-01-03", "2026-01-03"), ("2026-01-04", "2026-01-08")):
        days = days_between(first, last)
        got = {r.kind: r.distinct_ids for r in op.distinct_over(sets, SPEC, days).collect()}
        want = {}
        for kind, id_, day in rows:
            if kind is not None and id_ is not None and day in days:
                want.setdefault(kind, set()).add(id_)
        assert got == {kind: len(ids) for kind, ids in want.items()}
    assert op.distinct_over(sets, SPEC, days_between("2027-01-01", "2027-01-02")).count() == 0


def test_codes_are_dense_kept_and_unique(spark, tmp_path):
    rows = rows_for(7)
    codes, _ = stored(spark, str(tmp_path / "codes"), rows)
    first = {r.id: r.code for r in codes.read().collect()}
    ids = {r[1] for r in rows} - {None}
    assert first.keys() == ids and sorted(first.values()) == list(range(len(ids)))
    codes.extend(spark.createDataFrame([("new",), ("id1",), (None,), ("new",)], "id string"))
    again = {r.id: r.code for r in codes.read().collect()}
    assert again == first | {"id1": first.get("id1", again["id1"]), "new": again["new"]}
    assert sorted(again.values()) == list(range(len(again)))


def test_an_id_without_a_code_fails(spark, tmp_path):
    codes = op.IdCodes(spark, str(tmp_path / "codes"))
    rows = spark.createDataFrame([("a", "x", date(2026, 1, 1))], SCHEMA)
    with pytest.raises(Exception, match="no code for x"):
        op.day_sets(rows, SPEC, "id", codes.read()).collect()


def test_empty_rows(spark, tmp_path):
    codes, sets = stored(spark, str(tmp_path / "codes"), [])
    assert sets.count() == 0 and codes.read().count() == 0


def test_a_span_reads_bitmaps_and_prunes_days(spark, tmp_path):
    _, sets = stored(spark, str(tmp_path / "codes"), rows_for(2))
    sets.write.partitionBy("day").parquet(str(tmp_path / "sets"))
    read = spark.read.schema(SPEC.schema).parquet(str(tmp_path / "sets"))
    plan = plan_of(op.distinct_over(read, SPEC, days_between("2026-01-02", "2026-01-04")))
    assert "PartitionFilters: [day" in plan and "bitmap_or_agg" in plan and "SinglePartition" not in plan
