import pytest

from tidemark.operators.areas import invert_areas
from tidemark.sources.areas import AreaSnapshots, PinnedAreas
from tidemark.workspace import has_folder

HASH = [("NORTH", "NL"), ("EAST", "BQ,CW"), ("SOUTH", "LU,MC,VA"), ("WEST", "ZZ")]


def table(spark, rows):
    return spark.createDataFrame(rows, "area string, codes string")


def codes(df):
    return {row["country_code"]: row["area"] for row in df.collect()}


def test_invert(spark):
    expected = {"NL": "NORTH", "BQ": "EAST", "CW": "EAST", "LU": "SOUTH", "MC": "SOUTH", "VA": "SOUTH", "ZZ": "WEST"}
    assert codes(invert_areas(table(spark, HASH))) == expected


def test_code_in_two_areas_gives_one_row(spark):
    inverted = invert_areas(table(spark, [("A", "X,Y"), ("B", "X"), ("A", "X")]))
    assert sorted(map(tuple, inverted.collect())) == [("X", "B"), ("Y", "A")]


class Clock:
    now = 0.0

    def __call__(self):
        return self.now


def test_snapshots_renew_replace_and_keep(spark, caplog):
    clock = Clock()
    source = {"rows": HASH}

    def load():
        if source["rows"] is None:
            raise OSError("no connection")
        return table(spark, source["rows"])

    areas = AreaSnapshots(load, max_age=60, clock=clock)
    first = areas.current()
    assert len(codes(first)) == 7

    source["rows"] = [("FIRST", "NL")]
    clock.now = 59
    assert areas.current() is first
    clock.now = 60
    assert codes(areas.current()) == {"NL": "FIRST"}
    assert len(codes(first)) == 7  # a job that still uses the old table is not disturbed

    clock.now = 120
    source["rows"] = []
    assert codes(areas.current()) == {"NL": "FIRST"}
    assert "empty" in caplog.text

    clock.now = 180
    source["rows"] = None
    assert codes(areas.current()) == {"NL": "FIRST"}
    source["rows"] = [("SECOND", "NL")]
    assert codes(areas.current()) == {"NL": "SECOND"}  # a failed read is tried again at once


def test_first_read_must_work(spark):
    def load():
        raise OSError("no connection")

    with pytest.raises(OSError):
        AreaSnapshots(load).current()


def test_empty_at_start_maps_nothing(spark):
    assert codes(AreaSnapshots(lambda: table(spark, [])).current()) == {}


def test_a_batch_keeps_the_version_it_read_first(spark, tmp_path, caplog):
    source = {"rows": [("OLD", "NL")]}

    def load():
        if source["rows"] is None:
            raise OSError("no connection")
        return table(spark, source["rows"])

    def job(**settings):
        return PinnedAreas(AreaSnapshots(load, max_age=0), f"{tmp_path}/areas", **settings)

    first = job()
    assert codes(first.for_batch(spark, 0)) == {"NL": "OLD"}
    source["rows"] = [("NEW", "NL,BQ")]
    assert codes(first.for_batch(spark, 0)) == {"NL": "OLD"}
    assert codes(first.for_batch(spark, 1)) == {"NL": "NEW", "BQ": "NEW"}
    source["rows"] = []
    assert codes(first.for_batch(spark, 2)) == {"NL": "NEW", "BQ": "NEW"}

    source["rows"] = None  # a new job, which can't reach the source
    second = job(keep=2)
    assert codes(second.for_batch(spark, 0)) == {"NL": "OLD"}
    assert codes(second.for_batch(spark, 3)) == {"NL": "NEW", "BQ": "NEW"} and "going on" in caplog.text
    source["rows"] = [("LAST", "ZZ")]
    for batch_id in (4, 5, 6):
        assert codes(second.for_batch(spark, batch_id)) == {"ZZ": "LAST"}
    kept = [n for n in range(7) if has_folder(spark, f"{tmp_path}/areas/batches/{n}")]
    assert kept == [0, 5, 6]  # batch 0 was there before this job, which keeps two
    with pytest.raises(OSError):
        PinnedAreas(AreaSnapshots(lambda: (_ for _ in ()).throw(OSError("none"))), f"{tmp_path}/other").for_batch(spark, 0)
