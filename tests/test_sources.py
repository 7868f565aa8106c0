import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from goldkeel.session import discard, get_session, scratch_folder, stage, staged
from goldkeel.sources.npi_files import load_deactivations, load_npi_registry
from goldkeel.sources.schemas import registry_columns, registry_schema


def registry_line(**values):
    return ",".join('"' + values.get(c, "").replace('"', '""') + '"' for c in registry_columns())


def write(tmp_path, *lines, end="\n"):
    path = tmp_path / "file.csv"
    path.write_bytes((end.join(lines) + end).encode())
    return str(path)


HEADER = registry_line(**{c: c.replace("_", " ") for c in registry_columns()})


def test_registry_has_329_columns():
    assert len(registry_schema()) == 329
    assert len(set(registry_columns())) == 329


def test_registry_quotes_blanks_and_dates(spark, tmp_path):
    path = write(
        tmp_path,
        HEADER,
        registry_line(
            NPI="1003000126",
            Entity_Type_Code="1",
            Provider_Organization_Name='A "B", C',
            Provider_Business_Mailing_Address_Postal_Code="08080",
            Last_Update_Date="07/08/2018",
            NPI_Deactivation_Reason_Code="DT",
        ),
        registry_line(NPI="1003000134"),
    )
    load = load_npi_registry(spark, path)
    first, second = sorted(load.rows.collect())
    assert first["Provider_Organization_Name"] == 'A "B", C'
    assert first["Provider_Business_Mailing_Address_Postal_Code"] == "08080"
    assert first["Last_Update_Date"] == datetime.date(2018, 7, 8)
    assert first["Provider_First_Name"] is None and second["Entity_Type_Code"] is None
    assert load.rejects.count() == 0 and len(load.rows.columns) == 329


def test_bad_rows_become_rejects(spark, tmp_path):
    good = registry_line(NPI="1")
    late = registry_line(NPI="2", Last_Update_Date="2018-99-99")
    path = write(tmp_path, HEADER, good, '"3","1"', late)
    load = load_npi_registry(spark, path)
    assert rows(load.rows.select("NPI")) == [("1",)]
    rejected = {r["NPI"]: r["_corrupt_record"] for r in load.rejects.collect()}
    assert set(rejected) == {"2", "3"}
    assert rejected["3"] == '"3","1"' and "2018-99-99" in rejected["2"]
    with pytest.raises(ValueError, match="more than 1 bad rows"):
        load_npi_registry(spark, path, max_errors=1)
    assert load_npi_registry(spark, path, max_errors=None).rejects.count() == 2


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_deactivations(spark, tmp_path, end):
    path = write(tmp_path, "NPI,NPI Deactivation Date", "1003002031,05/01/2012", "1003002049,", end=end)
    load = load_deactivations(spark, path)
    assert rows(load.rows) == [("1003002031", datetime.date(2012, 5, 1)), ("1003002049", None)]


def test_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no file to load"):
        load_npi_registry(spark, str(tmp_path / "absent.csv"))


def test_stage_keeps_content(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    assert rows(stage(df, "some")) == rows(df)


def test_scratch_uses_the_configured_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_folder(spark, "x").startswith(shared + "/x-")
    assert get_session() is not None


def test_the_eleventh_bad_row_fails_the_load(spark, tmp_path):
    def lines(bad):
        return ["NPI,NPI Deactivation Date", *[f"{i},05/01/2012" for i in range(40)], *[f"{i},x" for i in range(bad)]]

    load = load_deactivations(spark, write(tmp_path, *lines(10)))
    assert load.rows.count() == 40 and load.rejects.count() == 10
    with pytest.raises(ValueError, match="more than 10 bad rows"):
        load_deactivations(spark, write(tmp_path, *lines(11)))


def test_a_checked_load_reads_its_file_once(spark, tmp_path):
    from test_groups import plan

    path = write(tmp_path, "NPI,NPI Deactivation Date", "1003002031,05/01/2012", "1003002049,x")
    load = load_deactivations(spark, path)
    (tmp_path / "file.csv").write_text("changed")
    assert rows(load.rows) == [("1003002031", datetime.date(2012, 5, 1))]
    assert rows(load.rejects) == [("1003002049", "1003002049,x")]
    assert "Scan csv" not in plan(load.rows) and "Scan csv" not in plan(load.rejects)


def test_a_discarded_stage_is_gone(spark):
    df, path = staged(spark.range(3), "some")
    assert df.count() == 3
    discard(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    discard(spark, path)


def test_a_small_file_is_no_single_task(spark, tmp_path, monkeypatch):
    """Wide rows and lines of one small file are made by several tasks."""
    from goldkeel.sources import bindings

    folder = "/root/testdata/sf0.001"
    usual = bindings.Bindings(spark, folder)
    monkeypatch.setattr(bindings, "WIDE_ROWS_PER_TASK", 15)
    monkeypatch.setattr(bindings, "LINES_PER_TASK", 500)
    other = bindings.Bindings(spark, folder)
    customers, lines = usual._star("customer").count(), usual._star("lineitem").count()
    assert other._derive("registry_file").rdd.getNumPartitions() == -(-customers // 15) > 4
    assert other._derive("chart").rdd.getNumPartitions() == -(-lines // 500) > 4
    for name in ("registry_file", "chart", "junction"):
        assert sorted(map(repr, other._derive(name).collect())) == sorted(map(repr, usual._table(name).collect()))


def test_shuffles_of_many_rows_make_more_tasks(spark, monkeypatch):
    from goldkeel import session

    monkeypatch.setattr(session, "ROWS_PER_TASK", 10)
    parts, size = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    usual = spark.conf.get(parts), spark.conf.get(size)
    with session.shuffling(spark, 95):
        assert spark.conf.get(parts) == "10" and spark.conf.get(size) == str(session.BYTES_PER_TASK)
    with pytest.raises(ZeroDivisionError), session.shuffling(spark, 95):
        1 / 0
    assert (spark.conf.get(parts), spark.conf.get(size)) == usual
    with session.shuffling(spark, 1):
        assert spark.conf.get(parts) == usual[0]
    assert not spark.conf._jconf.contains(size)


def test_counted_pairs_tell_how_many_rows_they_shuffle(spark, monkeypatch):
    from goldkeel import session
    from goldkeel.plans import mastering
    from goldkeel.sources import bindings, snapshots
    from workload import queries

    told = []

    def note(of, rows):
        told.append(rows)
        return shuffling(of, rows)

    shuffling = session.shuffling
    for module in (session, bindings, snapshots):
        monkeypatch.setattr(module, "shuffling", note)
    monkeypatch.setattr(bindings.Bindings, "_written", {})
    b = bindings.Bindings(spark, "/root/testdata/sf0.001")
    lines = b._star("lineitem").count()
    queries._pairs(b)
    assert told.count(lines) == 3  # junction, charts and pairs
    inputs = mastering.Inputs(b.provider, b.junction, b.charts, b.location)
    told.clear()
    store = snapshots.StateStore(spark, session.scratch_folder(spark, "state"))
    mastering.master_project(spark, "LOCATION", "ADD", queries.PROJECT_A, inputs, store)
    linked = b.junction.where(F.col("Project_Name__c") == queries.PROJECT_A).count()
    links = len(b.junction.where(F.col("Project_Name__c") == queries.PROJECT_A).select(*queries.ch.PAIR).distinct().collect())
    assert told[:2] == [linked, links] and links > 0


def test_orders_move_to_the_customer_instead_of_lines(spark):
    from goldkeel.sources.bindings import Bindings

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        derived = Bindings(spark, "/root/testdata/sf0.001")._derive("junction")
        steps = derived._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    depth = [len(s) - len(s.lstrip(" :+-")) for s in steps]
    first = next(i for i, s in enumerate(steps) if "Exchange hashpartitioning(o_custkey" in s)
    below = next((i for i in range(first + 1, len(steps)) if depth[i] <= depth[first]), len(steps))
    assert "l_orderkey" not in "".join(steps[first:below])
