import datetime
import re
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import rows
from goldkeel.operators import state as st
from goldkeel.operators.chase import COUNT_COLUMNS, chase_list
from goldkeel.plans import mastering as job
from goldkeel.session import scratch_folder, stage
from goldkeel.sources.bindings import Bindings
from goldkeel.sources.snapshots import StateStore

DAY = datetime.date(2018, 1, 1)
TYPES = "Client_name string, Project_Name string, New_lid_all string, CreatedDate date, " + ", ".join(
    f"{c} long" for c in COUNT_COLUMNS
)
A, B = "BUILDING|2018|MRR|0", "MACHINERY|2018|MRR|1"


def chase(spark, project, figures):
    data = [("c", project, lid, DAY, *[n] * len(COUNT_COLUMNS)) for lid, n in figures.items()]
    return spark.createDataFrame(data, TYPES)


def short(df):
    return rows(df.select("Project_Name", "New_lid_all", "charts_at_loc", COUNT_COLUMNS[-1]))


def test_upsert_adds_and_inserts(spark):
    target = chase(spark, "A", {"x": 5, "y": 7, "z": None})
    source = chase(spark, "B", {"y": 2, "z": 1, "w": 4})
    result = st.accumulate_chase_list(target, source)
    assert short(result.target) == [("A", "x", 5, 5), ("A", "y", 9, 9), ("A", "z", None, None), ("B", "w", 4, 4)]
    feed = {r["inserted_New_lid_all"]: r for r in result.changes.collect()}
    assert set(feed) == {"y", "z", "w"}
    assert (feed["y"]["action"], feed["y"]["deleted_charts_at_loc"], feed["y"]["inserted_charts_at_loc"]) == ("UPDATE", 7, 9)
    assert feed["y"]["inserted_Project_Name"] == "A"
    assert feed["w"]["action"] == "INSERT" and feed["w"]["deleted_New_lid_all"] is None


def test_upsert_of_disjoint_sources_is_their_union(spark):
    one, two = chase(spark, "A", {"x": 1}), chase(spark, "B", {"y": 2})
    assert short(st.accumulate_chase_list(one, two).target) == short(one.unionByName(two))


def test_small_source_never_shuffles_the_target(spark):
    from test_groups import plan

    target = stage(chase(spark, "A", {"x": 5, "y": 7}), "target")
    source = stage(chase(spark, "B", {"y": 2}), "source")
    text = plan(st.accumulate_chase_list(target, source).target)
    assert "hashpartitioning" not in text and "SortMergeJoin" not in text


def control(spark, *entries):
    return spark.createDataFrame(list(entries), st.CONTROL_SCHEMA)


def test_register_project(spark):
    junction = spark.createDataFrame([("P",)], "Project_Name__c string")
    empty = control(spark)
    assert rows(st.register_project(empty, "LOC", "c", "P", junction)) == [(1, "LOC", "c", "P")]
    assert rows(st.register_project(empty, "LOC", "c", "Q", junction)) == []
    listed = control(spark, (7, "LOC", "c", "P"))
    assert rows(st.register_project(listed, "LOC", "C ", "p", junction)) == []
    assert rows(st.register_project(listed, "OTHER", "c", "P")) == [(8, "OTHER", "c", "P")]


def test_unmaster_ignores_the_master_name(spark):
    listed = control(spark, (1, "LOC", "c", "P"), (2, "OTHER", "C", "p "), (3, "LOC", "d", "P"), (4, "LOC", None, "P"))
    mapped = chase(spark, "P", {"x": 1}).unionByName(chase(spark, "Q", {"y": 2}))
    left = st.unmaster_project(listed, mapped, "P", "c")
    assert [r[0] for r in rows(left.control)] == [3, 4]
    assert [r[0] for r in rows(left.removed_control)] == [1, 2]
    assert short(left.chase_map) == [("Q", "y", 2, 2)]
    assert short(left.removed_map) == [("P", "x", 1, 1)]


def test_append_masters(spark):
    known = spark.createDataFrame([("x", "old")], "New_lid_all string, v string")
    new = spark.createDataFrame([("n", "x"), ("n", "y")], "v string, New_lid_all string")
    assert rows(st.append_masters(known, new)) == [("y", "n")]


def test_chase_list_argument(spark):
    with pytest.raises(ValueError, match="by must be"):
        chase_list(None, None, by="npi")


@pytest.fixture(scope="module")
def inputs(spark):
    b = Bindings(spark, "/root/testdata/sf0.001")
    return job.Inputs(b.provider, b.junction, b.charts, b.location)


def new_store(spark):
    return StateStore(spark, scratch_folder(spark, "state"))


def run(spark, inputs, store, action, project, **options):
    return job.master_project(spark, "LOCATION", action, project, inputs, store, **options)


def state(store, inputs):
    return {
        "map": store.read(job.MAP, job.map_schema(inputs.location)),
        "backup": store.read(job.BACKUP, job.map_schema(inputs.location)),
        "control": store.read(job.CONTROL, st.CONTROL_SCHEMA),
    }


@pytest.mark.parametrize(
    "arguments, message",
    [
        ((" ", "ADD", A), "type"),
        (("LOCATION", "", A), "ADD or DELETE"),
        (("LOCATION", "MERGE", A), "ADD or DELETE"),
        (("LOCATION", "ADD", None), "project name"),
        (("LOCATION", "ADD", "nowhere"), "unknown project"),
    ],
)
def test_wrong_input_is_refused(spark, inputs, arguments, message):
    with pytest.raises(ValueError, match=message):
        job.master_project(spark, *arguments, inputs, new_store(spark))


def test_two_projects_share_ids(spark, inputs):
    store = new_store(spark)
    first = run(spark, inputs, store, "ADD", A)
    assert (first.status, first.version) == (job.MASTERED, 1)
    alone = {r["New_lid_all"]: r["charts_at_loc"] for r in state(store, inputs)["map"].collect()}
    assert {r["action"] for r in first.reports["changes"].collect()} == {"INSERT"}
    assert rows(first.reports["control"]) == [(1, "LOCATION", "BUILDING", A)]
    masters = store.read(job.MASTERS, first.reports["location_master"].schema)
    assert rows(masters.select("New_lid_all")) == rows(first.reports["location_master"].select("New_lid_all"))

    again = run(spark, inputs, store, "add", A)
    assert (again.status, again.version) == (job.ALREADY_MASTERED, 1)

    second = run(spark, inputs, store, "ADD", B)
    added = {r["New_lid_all"]: r["charts_at_loc"] for r in second.reports["chase_list"].collect()}
    both = {r["New_lid_all"]: r for r in state(store, inputs)["map"].collect()}
    assert set(both) == set(alone) | set(added)
    for lid, row in both.items():
        assert row["charts_at_loc"] == alone.get(lid, 0) + added.get(lid, 0)
        assert row["Project_Name"] == (A if lid in alone else B)
    masters = store.read(job.MASTERS, first.reports["location_master"].schema)
    assert masters.count() == masters.select("New_lid_all").distinct().count() == len(both)

    # Ids first seen in A keep B's share when B goes, and take it along with A.
    undone = run(spark, inputs, store, "DELETE", B)
    assert undone.status == job.DELETED
    assert rows(undone.reports["removed_control"]) == [(2, "LOCATION", "MACHINERY", B)]
    left = {r["New_lid_all"]: r["charts_at_loc"] for r in state(store, inputs)["map"].collect()}
    assert left == {lid: both[lid]["charts_at_loc"] for lid in alone}
    run(spark, inputs, store, "DELETE", A)
    final = state(store, inputs)
    assert final["map"].count() == 0 and final["control"].count() == 0
    assert final["backup"].count() == len(both)
    assert store.read(job.MASTERS, masters.schema).count() == len(both)


def test_delete_of_an_unknown_combination(spark, inputs):
    store = new_store(spark)
    run(spark, inputs, store, "ADD", A)
    quiet = job.master_project(spark, "OTHER", "DELETE", A, inputs, store)
    assert (quiet.status, quiet.version) == (job.NOT_MASTERED, 1)
    literal = job.master_project(spark, "OTHER", "DELETE", A, inputs, store, strict_reference=True)
    assert literal.status == job.NOT_MASTERED
    after = state(store, inputs)
    assert [after[k].count() for k in ("map", "control", "backup")] == [0, 0, 0]


def test_a_project_of_two_clients_is_refused(spark, inputs):
    other = inputs.provider.where(F.col("Project_Name__c") == A).limit(1).withColumn("Client_Name__c", F.lit("X"))
    mixed = job.Inputs(inputs.provider.unionByName(other), inputs.junction, inputs.charts, inputs.location)
    with pytest.raises(ValueError, match="more than one client"):
        run(spark, mixed, new_store(spark), "ADD", A)


def test_a_lost_job_leaves_no_trace_and_commits_collide(spark):
    store = new_store(spark)
    schema = "k string"
    one = store.write_segment(spark.createDataFrame([("a",)], schema), "t")
    assert store.version() == 0 and store.read("t", st.CONTROL_SCHEMA).count() == 0
    assert store.commit(0, append={"t": one}) == 1
    two = store.write_segment(spark.createDataFrame([("b",)], schema), "t")
    with pytest.raises(RuntimeError, match="run the job again"):
        store.commit(0, append={"t": two})
    assert store.commit(1, append={"t": two}) == 2
    types = spark.createDataFrame([], schema).schema
    assert rows(store.read("t", types)) == [("a",), ("b",)]
    three = store.write_segment(spark.createDataFrame([("c",)], schema), "t")
    store.commit(2, replace={"t": three})
    assert rows(store.read("t", types)) == [("c",)]
    assert uuid.UUID(three.split("/")[1])


def test_content_of_earlier_versions(spark):
    store = new_store(spark)
    types = spark.createDataFrame([], "k string").schema
    one, two = (store.write_segment(spark.createDataFrame([(k,)], types), "t") for k in "ab")
    store.commit(0, append={"t": one})
    store.commit(1, append={"t": two})
    assert rows(store.read("t", types, version=1)) == [("a",)]
    assert rows(store.read("t", version=2)) == [("a",), ("b",)]
    assert rows(store.read("t", types, version=0)) == []


def test_a_torn_draft_is_never_read(spark):
    store = new_store(spark)
    stream = store._filesystem().create(store._path("drafts/torn.json"), False)
    stream.write(bytearray(b'{"tables": {'))
    stream.close()
    stream = store._filesystem().create(store._path("commits/.0000000009.json.tmp"), False)
    stream.close()
    assert store.version() == 0
    segment = store.write_segment(spark.createDataFrame([("a",)], "k string"), "t")
    assert store.commit(0, append={"t": segment}) == 1


def test_of_two_commits_at_once_one_wins(spark):
    """Both read the same version before either publishes."""
    store = new_store(spark)
    rival = StateStore(spark, store.root)
    one = store.write_segment(spark.createDataFrame([("a",)], "k string"), "t")
    two = rival.write_segment(spark.createDataFrame([("b",)], "k string"), "t")
    seen = rival._latest()
    store.commit(0, append={"t": one})
    rival._latest = lambda: seen
    with pytest.raises(RuntimeError, match="run the job again"):
        rival.commit(0, append={"t": two})
    assert rows(store.read("t", version=1)) == [("a",)]


def test_remove_unused_spares_what_is_young_or_in_use(spark):
    store = new_store(spark)
    staged = store.stage(spark.createDataFrame([("s",)], "k string"), "some")
    old = store.write_segment(spark.createDataFrame([("a",)], "k string"), "t")
    store.commit(0, replace={"t": old})
    new = store.write_segment(spark.createDataFrame([("b",)], "k string"), "t")
    store.commit(1, replace={"t": new})
    store.remove_unused()
    assert rows(staged) == [("s",)] and rows(store.read("t", version=1)) == [("a",)]
    store.remove_unused(older_than=-60)
    assert rows(store.read("t")) == [("b",)]
    files = store._filesystem()
    assert not files.exists(store._path(old)) and files.exists(store._path(new))
    assert len(files.listStatus(store._path("staging"))) == 0
    new_store(spark).remove_unused(older_than=-60)


def test_keys_of_deleted_projects_are_not_issued_again(spark, inputs):
    store = new_store(spark)
    run(spark, inputs, store, "ADD", A)
    run(spark, inputs, store, "DELETE", A)
    assert store.last_key(job.CONTROL) == 1
    second = run(spark, inputs, store, "ADD", B)
    assert [r[0] for r in rows(second.reports["control"])] == [2]


def test_regional_projects_leave_and_stay(spark):
    """A deleted project takes its rows along, those of the other stay."""
    from workload.queries import QUERIES

    names = [n for n in QUERIES if re.match("c18_.*after_|c15_.*_next_|c17_.*regional_rem", n)]
    count = {n: QUERIES[n](spark, "/root/testdata/sf0.001").count() for n in names}
    assert count["c18_map_after_delete"] + count["c18_backup_after_delete"] == count["c18_map_after_adds"]
    assert min(count["c18_map_after_delete"], count["c18_backup_after_delete"]) > 1
    assert count["c18_control_after_adds"] == 2 and count["c18_control_after_delete"] == 1
    assert count["c18_masters_after_delete"] > count["c18_masters_after_first_add"] > 1
    appended = count["c18_masters_after_delete"] - count["c18_masters_after_first_add"]
    assert count["c15_append_masters_of_next_project"] == appended > 1
    assert count["c17_unmaster_regional_remaining"] == count["c18_map_after_delete"]


def test_pairs_carry_marks_of_the_patterns_that_link_them(spark, monkeypatch):
    """As a semi join finds them, with pairs that repeat, lack a key or are
    linked by projects of both patterns."""
    from types import SimpleNamespace

    from workload import queries

    provider = spark.createDataFrame([("c", p) for p in ("A|0", "A|1", "B|0 ", "C|2")], "Client_Name__c string, Project_Name__c string")
    data = [(i % 5, i % 7, p, i % 3) for i in range(40) for p in ("A|0", "a|1", "B|0", "C|2") if i % 4 != len(p) + ord(p[0]) % 4]
    data = [*data, *data[:9], (None, 1, "A|0", 1), (1, None, "A|1", 1), (77, 77, "C|2", 1), (78, 78, "Z|0", 1)]
    day = F.expr("case when d > 0 then date '2018-01-01' + d end")
    junction = spark.createDataFrame(data, "Location__c long, Provider__c long, Project_Name__c string, d int")
    junction = junction.withColumns({"CreatedDate": F.to_date(F.lit("2018-01-02")), "LastModifiedDate": day}).drop("d")
    b = SimpleNamespace(provider=provider, junction=junction)
    marked = queries._marked_links(b, {"_even": "%|0", "_odd": "%|1"})
    links = queries._links(b)
    assert rows(marked.drop("_even", "_odd")) == rows(links)
    for mark, pattern in (("_even", "%|0"), ("_odd", "%|1")):
        own = queries._links(b, pattern).select(*queries.ch.PAIR)
        wanted = rows(links.join(own, queries.ch.PAIR, "left_semi"))
        found = marked.where(mark).drop("_even", "_odd").dropna(subset=queries.ch.PAIR)
        assert rows(found) == wanted and wanted


def test_the_change_feed_writes_its_pairs_once(spark, monkeypatch):
    from workload import queries

    names, stage = [], queries.stage
    monkeypatch.setattr(queries, "stage", lambda df, name, rows=0: names.append(name) or stage(df, name, rows))
    queries._upsert(Bindings(spark, "/root/testdata/sf0.001"))
    assert names == ["pairs", "chase", "chase"]
