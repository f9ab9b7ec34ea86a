"""Versioned tables and the late-data repair: what a job that dies leaves,
what a reader sees, who writes how much, and which risk is computed."""

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from driftcast.fixtures import fixture
from driftcast.operators.risk import risk_year
from driftcast.operators.weather import merge_history
from driftcast.plans import sources_q as Q
from driftcast.session import shared_path
from driftcast.sources import tables as TB
from driftcast.sources import versions
from driftcast.streaming import incremental as J

SF = "/root/testdata/sf0.001"
DAY = dt.date(2024, 1, 1)


def risk_rows(spark, values, day=DAY):
    return spark.createDataFrame([(c, day, x) for c, x in values], "insee_com string, date date, risque_brut double")


def risk_of(spark, table):
    return {r["insee_com"]: r["risque_brut"] for r in TB.read_risk(spark, table).collect()}


def table(spark):
    p = shared_path(spark, "versioned")
    TB.upsert_year(spark, p, risk_rows(spark, [("01001", 1.0), ("01002", 2.0), ("02001", 3.0)]), 2024)
    return p


# ---- a job that dies -----------------------------------------------------------

@pytest.mark.parametrize("step", ["first write", "second write", "swap"])
def test_a_job_that_dies_leaves_the_old_version(spark, monkeypatch, step):
    p = table(spark)
    new, old = risk_rows(spark, [("01002", 5.0), ("03001", 7.0)]), risk_of(spark, p)
    real, calls = versions.write, []

    def dies(spark_, df, *rest):
        calls.append(1)
        if len(calls) == (1 if step == "first write" else 2):  # the Spark job itself fails
            df = df.withColumn("risque_brut", F.when(F.length("insee_com") > 0, F.raise_error(F.lit("killed"))).cast("double"))
        return real(spark_, df, *rest)

    with monkeypatch.context() as m:
        if step == "swap":
            m.setattr(versions._Files, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        else:
            m.setattr(versions, "write", dies)
        with pytest.raises(Exception, match="killed"):
            TB.upsert_year(spark, p, new, 2024)
    assert risk_of(spark, p) == old and versions.version_numbers(spark, p) == [1]
    TB.upsert_year(spark, p, new, 2024)  # the job simply runs again
    assert risk_of(spark, p) == {"01001": 1.0, "01002": 5.0, "02001": 3.0, "03001": 7.0}


def test_a_reader_keeps_the_version_it_began_with(spark):
    p = table(spark)
    reader = TB.read_risk(spark, p)
    TB.upsert_year(spark, p, risk_rows(spark, [("01002", 5.0), ("02001", 6.0)]), 2024)
    assert {r["insee_com"]: r["risque_brut"] for r in reader.collect()} == {"01001": 1.0, "01002": 2.0, "02001": 3.0}
    assert risk_of(spark, p) == {"01001": 1.0, "01002": 5.0, "02001": 6.0}
    first = versions.read(spark, p, versions.current(spark, p, 1))
    assert first.where("insee_com = '02001'").first()["risque_brut"] == 3.0


def test_the_slower_of_two_writers_is_told(spark):
    p = table(spark)
    slow = TB.prepare_year(spark, p, risk_rows(spark, [("01001", 9.0)]), 2024)
    TB.upsert_year(spark, p, risk_rows(spark, [("02001", 8.0)]), 2024)
    with pytest.raises(Exception, match="(?i)exist"):
        versions.commit(spark, p, slow)
    assert risk_of(spark, p) == {"01001": 1.0, "01002": 2.0, "02001": 8.0}


def test_vacuum_keeps_what_the_last_versions_name(spark):
    p = table(spark)
    for x in (4.0, 5.0, 6.0):
        TB.upsert_year(spark, p, risk_rows(spark, [("01001", x)]), 2024)
    kept, old = risk_of(spark, p), versions.read(spark, p, versions.current(spark, p, 3)).collect()
    assert len(versions.vacuum(spark, p)) > 0 and versions.version_numbers(spark, p) == [3, 4]
    assert risk_of(spark, p) == kept == {"01001": 6.0, "01002": 2.0, "02001": 3.0}
    assert sorted(versions.read(spark, p, versions.current(spark, p, 3)).collect()) == sorted(old)
    assert versions.vacuum(spark, p) == []


def test_untouched_partitions_are_not_written_again(spark):
    p = table(spark)
    before = versions.current(spark, p)
    TB.upsert_year(spark, p, risk_rows(spark, [("01001", 9.0)]), 2024)
    after = versions.current(spark, p)
    assert after.parts["annee=2024/dep=02"] == before.parts["annee=2024/dep=02"]
    assert set(after.parts["annee=2024/dep=01"]).isdisjoint(before.parts["annee=2024/dep=01"])


# ---- size of what a task writes -----------------------------------------------

def test_a_large_departement_is_written_by_many_tasks(spark):
    """A third of the rows in one departement; the number of files follows bytes."""
    dep = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40 + 2).cast("int")
    rows = spark.range(0, 600_000, 1, 8).select(
        F.format_string("%02d%05d", dep, F.floor(F.rand(2) * 900).cast("int")).alias("insee_com"),
        F.date_add(F.lit(DAY), (F.col("id") % 366).cast("int")).alias("date"), F.rand(1).alias("risque_brut"))
    p = shared_path(spark, "wide")
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512k")
    spark.conf.set("spark.sql.shuffle.partitions", "499")
    try:
        TB.upsert_year(spark, p, rows, 2024)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    files = {r["dep"]: (r["files"], r["n"]) for r in TB.read_risk(spark, p).withColumn("f", F.input_file_name()).groupBy("dep").agg(
        F.count_distinct("f").alias("files"), F.count("*").alias("n")).collect()}
    assert files["01"][1] == 200_000 and files["01"][0] >= 6
    assert all(n < 3 for d, (n, _) in files.items() if d != "01")
    per_file = TB.read_risk(spark, p).where("dep = '01'").withColumn("f", F.input_file_name()).groupBy("f").count()
    assert per_file.agg(F.max("count")).first()[0] < files["01"][1] / 3
    # one pass writes: nothing is staged beside the version's own files
    assert len({w for writes in versions.current(spark, p).parts.values() for w in writes}) == 1


# ---- the repair -------------------------------------------------------------------

@pytest.fixture(scope="module")
def night(spark):
    """Stored inputs before the night, and the merged history of the night."""
    inp = Q.stored_inputs(spark, SF)
    era5, archive = fixture(spark, SF, "fx_meteo_era5"), fixture(spark, SF, "fx_meteo_archive")
    return inp, era5, archive, merge_history(era5, archive, Q.TODAY, Q.ANNEE)


def seeded(spark, inp, stamp=1704931200):
    weather, risk = shared_path(spark, "weather"), shared_path(spark, "risk")
    TB.upsert_year(spark, risk, risk_year(inp), Q.ANNEE)
    J.upsert_weather(spark, weather, inp.weather.withColumn("fetched_at", F.lit(stamp).cast("long")))
    return weather, risk


def as_set(df, *columns):
    return set(map(repr, df.select(*columns).collect()))


VALUES = ("code_insee", "time", "wind_speed_10m_mean", "precipitation_sum")


def test_repair_follows_a_revised_day_before_the_gap(spark, night):
    """Day 10 was revised, day 12 was missing: both before the gap. Afterwards
    weather and risk agree: the risk is that of the year computed anew."""
    inp, era5, archive, merged = night
    weather, risk = seeded(spark, inp)
    changed = J.write_late_repair(spark, inp, era5, archive, Q.TODAY, weather, risk)
    pairs = J.weather_changes(inp.weather, merged)
    assert changed == pairs.count() > 0
    assert {r["time"].day for r in pairs.select("time").distinct().collect()} >= {10, 12}
    after = versions.read(spark, weather)
    assert as_set(merged, *VALUES) <= as_set(after, *VALUES)
    anew = risk_year(dataclasses.replace(inp, weather=after.select(*VALUES), memo={}))
    assert as_set(TB.read_risk(spark, risk), *anew.columns) == as_set(anew, *anew.columns)
    # a second night without news writes nothing
    numbers = versions.version_numbers(spark, weather), versions.version_numbers(spark, risk)
    assert J.write_late_repair(spark, inp, era5, archive, Q.TODAY, weather, risk) == 0
    assert (versions.version_numbers(spark, weather), versions.version_numbers(spark, risk)) == numbers


def test_repair_computes_the_changed_pairs_and_nothing_else(spark, night):
    inp, era5, archive, merged = night
    pairs = {(r[0], r[1]) for r in J.weather_changes(inp.weather, merged).collect()}
    communes = {r[0] for r in inp.ift.select("insee_com").collect()}
    bare = {d for _, d in pairs} - {r[0] for r in inp.weather.select("time").distinct().collect()}
    assert dt.date(2024, 1, 12) in bare
    want = {(c, d) for c, d in pairs if c in communes} | {(c, d) for c in communes for d in bare}
    got = [(r[0], r[1]) for r in J.late_weather_repair(inp, era5, archive, Q.TODAY).select("insee_com", "date").collect()]
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("stamp", [1704931200, 9_000_000_000, 3])
def test_repaired_rows_win_whatever_the_stored_stamp(spark, night, stamp):
    inp, era5, archive, merged = night
    weather, risk = seeded(spark, inp, stamp)
    J.write_late_repair(spark, inp, era5, archive, Q.TODAY, weather, risk)
    after = versions.read(spark, weather)
    assert as_set(merged, *VALUES) <= as_set(after, *VALUES)
    stamps = {r[0] for r in after.select("fetched_at").distinct().collect()}
    assert stamps == {stamp, int(dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc).timestamp())}


def test_repair_dying_between_the_swaps_runs_again(spark, night, monkeypatch):
    inp, era5, archive, merged = night
    weather, risk = seeded(spark, inp)
    real = versions.commit

    def dies(spark_, name, version):
        if name == weather:
            raise RuntimeError("killed")
        real(spark_, name, version)

    with monkeypatch.context() as m:
        m.setattr(versions, "commit", dies)
        with pytest.raises(RuntimeError, match="killed"):
            J.write_late_repair(spark, inp, era5, archive, Q.TODAY, weather, risk)
    assert as_set(versions.read(spark, weather), *VALUES) == as_set(inp.weather, *VALUES)
    assert J.write_late_repair(spark, inp, era5, archive, Q.TODAY, weather, risk) > 0
    assert as_set(merged, *VALUES) <= as_set(versions.read(spark, weather), *VALUES)


def test_only_touched_months_are_written(spark):
    p = shared_path(spark, "months")
    spring = [("a", dt.date(2024, m, 3), 1, float(m)) for m in (1, 2, 3)]
    schema = "code_insee string, time date, fetched_at long, precipitation_sum double"
    J.upsert_weather(spark, p, spark.createDataFrame(spring, schema))
    before = versions.current(spark, p).parts
    J.upsert_weather(spark, p, spark.createDataFrame([("a", dt.date(2024, 2, 3), 2, 9.0), ("b", dt.date(2024, 2, 4), 2, 8.0)], schema))
    after = versions.current(spark, p).parts
    assert [k for k in after if after[k] != before[k]] == ["annee=2024/mois=2"]
    got = {(r["code_insee"], r["time"].month): r["precipitation_sum"] for r in versions.read(spark, p).collect()}
    assert got == {("a", 1): 1.0, ("a", 2): 9.0, ("a", 3): 3.0, ("b", 2): 8.0}


def test_days_without_a_new_row_are_kept_without_a_join(spark, monkeypatch):
    """Rows may repeat, and have no day: kept as they are unless replaced."""
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    schema = "insee_com string, date date, risque_brut double"
    p = shared_path(spark, "days")
    TB.upsert_year(spark, p, spark.createDataFrame(
        [("01001", d, 1.0) for d in days] + [("01002", days[1], 2.0), ("01002", days[2], 3.0), ("01002", days[2], 3.0),
                                             ("01003", None, 4.0)], schema), 2024)
    real, written = versions.write, []

    def spied(spark_, df, *rest):
        written.append(df)
        return real(spark_, df, *rest)

    with monkeypatch.context() as m:
        m.setattr(versions, "write", spied)
        TB.upsert_year(spark, p, spark.createDataFrame([("01001", days[1], 9.0), ("01003", None, 8.0)], schema), 2024,
                       key=["insee_com", "date"])
    got = sorted(map(repr, TB.read_risk(spark, p).select("insee_com", "date", "risque_brut").collect()))
    want = [("01001", days[0], 1.0), ("01001", days[1], 9.0), ("01001", days[2], 1.0), ("01002", days[1], 2.0),
            ("01002", days[2], 3.0), ("01002", days[2], 3.0), ("01003", None, 4.0), ("01003", None, 8.0)]
    assert got == sorted(map(repr, spark.createDataFrame(want, schema).collect()))
    plan = written[1]._jdf.queryExecution().optimizedPlan().toString()
    joined = plan[plan.index("Join LeftAnti"):]
    assert plan.lstrip().startswith("Union") and "2024-01-02" in joined.split("\n")[1] + joined.split("\n")[2] + joined.split("\n")[3]


@pytest.mark.parametrize("before, during", [(None, str(versions.WRITE_BYTES)), ("256m", str(versions.WRITE_BYTES)), ("512k", "512k")])
def test_a_task_sorts_few_shuffled_bytes(spark, before, during):
    if before:
        spark.conf.set(versions.ADVISORY, before)
    try:
        was = spark.conf.get(versions.ADVISORY, None)
        with versions._small_writes(spark):
            assert spark.conf.get(versions.ADVISORY) == during
        assert spark.conf.get(versions.ADVISORY, None) == was
    finally:
        spark.conf.unset(versions.ADVISORY)
