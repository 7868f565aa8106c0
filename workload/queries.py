"""One registered query per operator, each over its whole tables.

Queries named after a single project, NPI or code take it as the operator's
own argument; all others run over every project at once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldkeel.operators import charts as ch
from goldkeel.operators import counts as co
from goldkeel.operators import locations as lo
from goldkeel.operators import profile as pr
from goldkeel.operators import reports as rp
from goldkeel.operators import registry as rg
from goldkeel.operators import state as st
from goldkeel.operators.chase import chase_list, distinct_chase_map
from goldkeel.plans.mastering import BACKUP, CONTROL, MAP, MASTERS, Inputs, map_schema, master_project
from goldkeel.session import scratch_folder, stage
from goldkeel.sources.bindings import Bindings
from goldkeel.sources.npi_files import CORRUPT, DATE_FORMAT, load_deactivations, load_npi_registry
from goldkeel.sources.snapshots import StateStore
from workload.names import (
    CHASE_COUNTS,
    CLIENT_A,
    EVEN,
    KEYWORD_NAMES,
    NPI,
    ODD,
    PROJECT_A,
    PROJECT_B,
    TAXONOMY_CODES,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Callable[[Bindings], DataFrame]) -> Callable[[Bindings], DataFrame]:
    QUERIES[function.__name__] = lambda spark, folder: function(Bindings(spark, folder))
    return function


def _links(b: Bindings, project_like: str | None = None) -> DataFrame:
    return ch.provider_locations(ch.select_projects(b.provider, project_like=project_like), b.junction)


def _rows(b: Bindings) -> DataFrame:
    return ch.qualifying_charts(_links(b), b.charts, b.provider)


def _pairs(b: Bindings) -> DataFrame:
    return _counted(b, _links(b))


def _counted(b: Bindings, links: DataFrame) -> DataFrame:
    pairs = ch.pair_counts(links, b.charts, b.provider)
    return stage(pairs, "pairs", max(b.junction.count(), b.charts.count()))


def _candidates(b: Bindings, **options) -> DataFrame:
    return stage(lo.location_candidates(b.location, ch.retrieval_summary(_pairs(b)), **options), "candidates")


def _session_candidates(b: Bindings) -> DataFrame:
    return _candidates(b, address_mode="full", require_contact=True)


def _marked_links(b: Bindings, patterns: dict[str, str]) -> DataFrame:
    """Links of all projects, each with a mark per pattern whose projects link
    the pair as well. Pairs counted from them carry the marks, so that no wide
    row has to meet the links of a pattern again."""
    links = _links(b)
    for mark, project_like in patterns.items():
        own = _links(b, project_like).select(*ch.PAIR, F.lit(True).alias(mark))
        links = links.join(own, ch.PAIR, "left")
    return links


def _run(b: Bindings, pairs: DataFrame, label: str, require_contact: bool) -> DataFrame:
    """Chase list of some projects under one label, from their counted pairs."""
    found = lo.location_candidates(b.location, ch.retrieval_summary(pairs), require_contact=require_contact)
    return stage(chase_list(found, pairs, label, label), "chase")


def _upsert(b: Bindings) -> st.Upsert:
    pairs = _counted(b, _marked_links(b, {"_even": "%|0", "_odd": "%|1"}))
    even, odd = pairs.where("_even").drop("_even", "_odd"), pairs.where("_odd").drop("_even", "_odd")
    return st.accumulate_chase_list(_run(b, even, EVEN, True), _run(b, odd, ODD, False))


def _control(b: Bindings) -> DataFrame:
    """A control list that already holds the even projects."""
    listed = ch.select_projects(b.provider, project_like="%|0")
    return listed.select(
        F.substring("Client_Name__c", 1, 1).alias("_first"), "Client_Name__c", "Project_Name__c"
    ).select(
        F.ascii("_first").cast("bigint").alias("MasteredProjetsListKey"),
        F.lit("LOCATION").alias("masterName"),
        F.col("Client_Name__c").alias("sourceSystem"),
        F.col("Project_Name__c").alias("sourceProject"),
    )


def _view(b: Bindings) -> DataFrame:
    return rg.provider_registry_view(b.provider, b.registry, b.deactivation)


def _as_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, DATE_FORMAT) for c in columns})


@query
def c01_select_projects(b: Bindings) -> DataFrame:
    return ch.select_projects(b.provider)


@query
def c01_select_projects_like(b: Bindings) -> DataFrame:
    return ch.select_projects(b.provider, client_like="%U%", project_like="%2018%MRR%0")


@query
def c02_provider_locations(b: Bindings) -> DataFrame:
    return _links(b)


@query
def c03_qualifying_charts(b: Bindings) -> DataFrame:
    return _rows(b)


@query
def c04_contact_keys(b: Bindings) -> DataFrame:
    return ch.contact_keys(b.provider)


@query
def c05_chart_count_matrix(b: Bindings) -> DataFrame:
    return co.chart_count_matrix(_pairs(b)).select(*ch.PAIR, *co.GRAINS)


@query
def c05_chart_count_matrix_full_address(b: Bindings) -> DataFrame:
    matrix = co.chart_count_matrix(_pairs(b), co.SESSION_GRAINS, "full")
    return matrix.select(*ch.PAIR, *co.SESSION_GRAINS)


@query
def c06_classify_retrieval(b: Bindings) -> DataFrame:
    return ch.classify_retrieval(b.charts).select("Id", *ch.PAIR, "MRT_Name__c", "Retreival_type")


@query
def c06_classify_every_keyword(b: Bindings) -> DataFrame:
    """Names made of every keyword, in upper and lower case, within other words
    and with blanks behind."""
    named = b.charts.withColumn("MRT_Name__c", F.expr(KEYWORD_NAMES))
    return ch.classify_retrieval(named).select("Id", "MRT_Name__c", "Retreival_type")


@query
def c07_retrieval_summary(b: Bindings) -> DataFrame:
    return ch.retrieval_summary(_pairs(b))


@query
def c08_appointment_counts(b: Bindings) -> DataFrame:
    return ch.appointment_counts(ch.linked_charts(_links(b), b.charts).drop("MRT_Name__c"))


@query
def c09_location_ids(b: Bindings) -> DataFrame:
    return lo.location_ids(b.location)


@query
def c09_location_ids_full_address(b: Bindings) -> DataFrame:
    return lo.location_ids(b.location, address_mode="full")


@query
def c10_location_candidates(b: Bindings) -> DataFrame:
    return _candidates(b)


@query
def c10_location_candidates_with_contact(b: Bindings) -> DataFrame:
    return _session_candidates(b)


@query
def c10_location_candidates_raw(b: Bindings) -> DataFrame:
    return _candidates(b, address_mode="full", require_contact=True, raw_zip_and_fax=True)


@query
def c11_merge_report(b: Bindings) -> DataFrame:
    return lo.merge_report(_candidates(b))


@query
def c11_merge_report_sorted(b: Bindings) -> DataFrame:
    report = lo.merge_report(_candidates(b))
    return rp.numbered_report(report, [F.col("count_sfLid_at_NewLIdAll").desc()])


@query
def c12_location_master(b: Bindings) -> DataFrame:
    return lo.location_master(_candidates(b), with_separators=True)


@query
def c12_location_master_with_source(b: Bindings) -> DataFrame:
    return lo.location_master(_session_candidates(b), with_source=True)


@query
def c12_location_master_sorted(b: Bindings) -> DataFrame:
    golden = lo.location_master(_session_candidates(b), with_source=True)
    phone = F.coalesce("Phone_1__c", "Phone_2__c").asc()
    return rp.numbered_report(golden, ["New_lid_all", "Provider_Full_Address__c", phone])


@query
def c12_location_master_uncut(b: Bindings) -> DataFrame:
    golden = lo.location_master(_candidates(b), truncate_percent=False)
    percent = F.round(F.col("Percent_of_Charts_Recovered__c").cast("double"), 6)
    return golden.select("New_lid_all", percent.alias("Percent_of_Charts_Recovered__c"))


@query
def c13_chase_list(b: Bindings) -> DataFrame:
    pairs = _pairs(b)
    return chase_list(lo.location_candidates(b.location, ch.retrieval_summary(pairs)), pairs)


@query
def c13_chase_list_by_provider(b: Bindings) -> DataFrame:
    pairs = _pairs(b)
    found = lo.location_candidates(b.location, ch.retrieval_summary(pairs), "full", require_contact=True)
    narrow = pairs.select(*ch.PAIR, "chart_count", "NPI__c", "TIN_ID__c", "FULL_ADDRESS", "Phone_Number__c", *co.KEYS)
    matrix = stage(co.chart_count_matrix(narrow, co.SESSION_GRAINS, "full").drop(*co.KEYS), "matrix")
    return chase_list(found, matrix, by="lid_provider")


@query
def c13_chase_list_sorted(b: Bindings) -> DataFrame:
    pairs = _pairs(b)
    listed = chase_list(lo.location_candidates(b.location, ch.retrieval_summary(pairs)), pairs)
    return rp.numbered_report(listed, ["-New_lid_all"])


@query
def c13_distinct_chase_map(b: Bindings) -> DataFrame:
    pairs = _pairs(b)
    found = lo.location_candidates(b.location, ch.retrieval_summary(pairs), "full", require_contact=True)
    return distinct_chase_map(found, pairs)


@query
def c14_accumulate_chase_list(b: Bindings) -> DataFrame:
    return _upsert(b).target


@query
def c14_change_feed(b: Bindings) -> DataFrame:
    return _upsert(b).changes


@query
def c15_append_masters(b: Bindings) -> DataFrame:
    known = lo.location_master(_candidates(b, require_contact=True))
    return st.append_masters(known, lo.location_master(_candidates(b)))


@query
def c15_append_masters_of_next_project(b: Bindings) -> DataFrame:
    return st.append_masters(*[_regional_masters(b, p) for p in (PROJECT_A, PROJECT_B)])


@query
def c16_register_project(b: Bindings) -> DataFrame:
    control = _control(b)
    return control.unionByName(st.register_project(control, "LOCATION", CLIENT_A, PROJECT_B, b.junction))


@query
def c17_unmaster_remaining_map(b: Bindings) -> DataFrame:
    return st.unmaster_project(_control(b), _upsert(b).target, EVEN, EVEN).chase_map


@query
def c17_unmaster_archived_map(b: Bindings) -> DataFrame:
    return st.unmaster_project(_control(b), _upsert(b).target, ODD, ODD).removed_map


@query
def c17_unmaster_control(b: Bindings) -> DataFrame:
    projects = ch.select_projects(b.provider).withColumnRenamed("Project_Name__c", "Project_Name")
    return st.unmaster_project(_control(b), projects, PROJECT_A, CLIENT_A).control


def _regional_masters(b: Bindings, project: str) -> DataFrame:
    links = ch.provider_locations(ch.select_projects(b.provider, project), b.regional_junction)
    links = stage(links, "links", b.regional_junction.count())
    pairs = ch.pair_counts(links, b.charts, b.provider, max_broadcast_links=ch.MAX_BROADCAST_LINKS)
    return lo.location_master(stage(lo.location_candidates(b.location, ch.retrieval_summary(pairs)), "candidates"))


ADDED, REMOVED = 2, 3  # versions of the regional state: both projects, the second alone
_stores: dict[tuple[str, str], StateStore] = {}


def _regional_state(b: Bindings) -> StateStore:
    """The state after two projects that share some locations were added and
    the first was deleted; the jobs run once a session."""
    key = (b.spark.sparkContext.applicationId, b.folder)
    if key not in _stores:
        inputs = Inputs(b.provider, b.regional_junction, b.charts, b.location)
        store = StateStore(b.spark, scratch_folder(b.spark, "state"))
        for action, project in (("ADD", PROJECT_A), ("ADD", PROJECT_B), ("DELETE", PROJECT_A)):
            master_project(b.spark, "LOCATION", action, project, inputs, store)
        _stores[key] = store
    return _stores[key]


def _job(b: Bindings, *steps: tuple[str, str]) -> DataFrame:
    inputs = Inputs(b.provider, b.junction, b.charts, b.location)
    store = StateStore(b.spark, scratch_folder(b.spark, "state"))
    for action, project in steps:
        master_project(b.spark, "LOCATION", action, project, inputs, store)
    return store.read(MAP, map_schema(b.location))


@query
def c18_master_projects(b: Bindings) -> DataFrame:
    return _job(b, ("ADD", PROJECT_A), ("ADD", PROJECT_B))


@query
def c18_undo_project(b: Bindings) -> DataFrame:
    return _job(b, ("ADD", PROJECT_A), ("ADD", PROJECT_B), ("DELETE", PROJECT_B))


@query
def c17_unmaster_regional_remaining(b: Bindings) -> DataFrame:
    chase_map = _regional_state(b).read(MAP, map_schema(b.location), ADDED)
    return st.unmaster_project(_control(b), chase_map, PROJECT_A, CLIENT_A).chase_map


@query
def c17_unmaster_regional_archived(b: Bindings) -> DataFrame:
    chase_map = _regional_state(b).read(MAP, map_schema(b.location), ADDED)
    return st.unmaster_project(_control(b), chase_map, PROJECT_A, CLIENT_A).removed_map


@query
def c18_map_after_adds(b: Bindings) -> DataFrame:
    return _regional_state(b).read(MAP, map_schema(b.location), ADDED)


@query
def c18_map_after_delete(b: Bindings) -> DataFrame:
    return _regional_state(b).read(MAP, map_schema(b.location), REMOVED)


@query
def c18_backup_after_delete(b: Bindings) -> DataFrame:
    return _regional_state(b).read(BACKUP, map_schema(b.location), REMOVED)


@query
def c18_control_after_adds(b: Bindings) -> DataFrame:
    return _regional_state(b).read(CONTROL, st.CONTROL_SCHEMA, ADDED)


@query
def c18_control_after_delete(b: Bindings) -> DataFrame:
    return _regional_state(b).read(CONTROL, st.CONTROL_SCHEMA, REMOVED)


@query
def c18_masters_after_first_add(b: Bindings) -> DataFrame:
    return _regional_state(b).read(MASTERS, version=1)


@query
def c18_masters_after_delete(b: Bindings) -> DataFrame:
    """Golden records stay when a project goes."""
    return _regional_state(b).read(MASTERS, version=REMOVED)


@query
def c19_load_npi_registry(b: Bindings) -> DataFrame:
    path = scratch_folder(b.spark, "registry")
    dates = [f.name for f in b.registry_file.schema if f.dataType.typeName() == "date"]
    _as_text(b.registry_file, *dates).write.csv(path, header=True, quoteAll=True, escape='"', emptyValue="")
    return load_npi_registry(b.spark, path).rows


@query
def c19_rejects(b: Bindings) -> DataFrame:
    """Lines of a deactivation list whose date cannot be read."""
    path = scratch_folder(b.spark, "rejects")
    date = F.when(F.col("NPI").cast("bigint") % 7 == 0, F.lit("unknown")).otherwise(
        F.date_format("NPI_Deactivation_Date", DATE_FORMAT)
    )
    b.deactivation.select("NPI", date.alias("NPI_Deactivation_Date")).write.csv(path, header=True)
    rejects = load_deactivations(b.spark, path, max_errors=None).rejects
    return rejects.withColumnRenamed(CORRUPT, "line")


@query
def c20_load_deactivations(b: Bindings) -> DataFrame:
    path = scratch_folder(b.spark, "deactivation")
    _as_text(b.deactivation, "NPI_Deactivation_Date").write.csv(path, header=True)
    return load_deactivations(b.spark, path).rows


@query
def c21_npi_status(b: Bindings) -> DataFrame:
    return rg.npi_status(b.registry).select("NPI", "Entity_Type_Code", "Status_of_npi")


@query
def c21_npi_status_no_record(b: Bindings) -> DataFrame:
    return rg.npi_status(b.registry, rg.NO_RECORD).select("NPI", "Entity_Type_Code", "Status_of_npi")


@query
def c21_npi_status_of_registry_file(b: Bindings) -> DataFrame:
    """All 329 columns and the status."""
    return rg.npi_status(b.registry_file)


@query
def c22_provider_registry_view(b: Bindings) -> DataFrame:
    return _view(b)


@query
def c23_one_per_client_npi(b: Bindings) -> DataFrame:
    shown = ["Client_Name__c", "npi_npi", "provider_npi", "Status_of_npi", "Taxonomy_GRP1", "Taxonomy_Grp2"]
    return rg.one_per_client_npi(_view(b).select(*shown, "Taxonomy_code1", "Taxonomy_code2", "Full_Name__c"))


@query
def c23_one_per_client_project(b: Bindings) -> DataFrame:
    return rg.one_per_client_project(b.provider.select("Client_Name__c", "Project_Name__c", "NPI__c", "Id"))


@query
def c24_status_summary(b: Bindings) -> DataFrame:
    return rg.status_summary(_view(b))


@query
def c24_status_summary_without_client(b: Bindings) -> DataFrame:
    return rg.status_summary(_view(b), exclude_client=CLIENT_A)


@query
def c25_deactivated_in_project(b: Bindings) -> DataFrame:
    return rg.deactivated_in_project(b.provider, b.registry, b.deactivation)


@query
def c25_deactivated_in_one_project(b: Bindings) -> DataFrame:
    return rg.deactivated_in_project(b.provider, b.registry, b.deactivation, PROJECT_A, CLIENT_A)


@query
def c25_providers_without_entity(b: Bindings) -> DataFrame:
    return rg.providers_without_entity(b.provider, b.registry)


@query
def c26_repeated_npis_by_rows(b: Bindings) -> DataFrame:
    return pr.repeated_npis(b.provider, min_rows=1)


@query
def c26_repeated_npis_by_projects(b: Bindings) -> DataFrame:
    return pr.repeated_npis(b.provider, min_projects=1)


@query
def c27_active_project_profile(b: Bindings) -> DataFrame:
    return pr.active_project_profile(b.provider)


@query
def c27_active_project_profile_sorted(b: Bindings) -> DataFrame:
    profile = pr.active_project_profile(b.provider)
    return rp.numbered_report(profile, ["Client_Name__c", "Project_Name__c"])


@query
def c28_active_providers(b: Bindings) -> DataFrame:
    return pr.active_providers(b.provider)


@query
def c28_active_providers_of_project(b: Bindings) -> DataFrame:
    return pr.active_providers(b.provider, PROJECT_A)


@query
def c29_provider_vs_registry_address(b: Bindings) -> DataFrame:
    return rg.provider_vs_registry_address(b.provider, b.registry)


@query
def c30_contact_report(b: Bindings) -> DataFrame:
    return rg.contact_report(_view(b))


@query
def c31_npi_footprint_by_client(b: Bindings) -> DataFrame:
    return pr.npi_footprint(b.provider, NPI, ["NPI__c", "Client_Name__c"])


@query
def c31_npi_footprint_by_project(b: Bindings) -> DataFrame:
    return pr.npi_footprint(b.provider, NPI)


@query
def c32_taxonomy_fallback(b: Bindings) -> DataFrame:
    return rg.taxonomy_fallback(b.registry)


@query
def c32_taxonomy_fallback_top(b: Bindings) -> DataFrame:
    return rg.taxonomy_fallback(b.registry, limit=10)


@query
def c33_taxonomy_lookup(b: Bindings) -> DataFrame:
    codes = b.registry.select(F.col("Healthcare_Provider_Taxonomy_Code_1").alias("taxonomy_code")).distinct()
    return rg.taxonomy_lookup(codes, TAXONOMY_CODES)


@query
def c34_taxonomy_groups(b: Bindings) -> DataFrame:
    return rg.taxonomy_groups(b.registry)


@query
def c35_find_npi_in_provider(b: Bindings) -> DataFrame:
    found = rg.find_npi(b.provider, NPI, "provider_id__c", ["Project_Name__c", "Client_Name__c"])
    return found.select("NPI__c", "provider_id__c", "Project_Name__c", "Client_Name__c", "Full_Name__c")


@query
def c35_find_npi_in_registry(b: Bindings) -> DataFrame:
    return rg.find_npi(b.registry, NPI)


@query
def c35_find_npi_in_deactivations(b: Bindings) -> DataFrame:
    return rg.find_npi(b.deactivation, NPI)


@query
def c36_registry_active_count(b: Bindings) -> DataFrame:
    return rg.registry_active_count(b.registry)


@query
def c37_uniqueness_of_junction(b: Bindings) -> DataFrame:
    return pr.uniqueness_check(b.junction, ch.PAIR)


@query
def c37_uniqueness_of_links(b: Bindings) -> DataFrame:
    # Staged, as no task then holds the sets of links and those of the check at once.
    return pr.uniqueness_check(stage(_links(b).select(*ch.PAIR), "links", b.junction.count()), ch.PAIR)


@query
def c38_merge_reduction(b: Bindings) -> DataFrame:
    return lo.merge_reduction(_candidates(b))


@query
def c38_merged_ids(b: Bindings) -> DataFrame:
    return lo.merged_ids(_candidates(b))


@query
def c38_merged_ids_sorted(b: Bindings) -> DataFrame:
    return rp.numbered_report(lo.merged_ids(_candidates(b)), [-4, 1, 2])


@query
def c39_junction_rows(b: Bindings) -> DataFrame:
    return st.junction_rows(b.junction, PROJECT_A)


@query
def c39_mastered_list(b: Bindings) -> DataFrame:
    return st.mastered_list(_control(b), PROJECT_A, CLIENT_A, "LOCATION")


@query
def c40_chart_counts_at_npi(b: Bindings) -> DataFrame:
    return co.chart_counts_at(_pairs(b), npi=NPI)


@query
def w02_first_row_per_location(b: Bindings) -> DataFrame:
    return ch.first_row_per_location(_rows(b).select(*ch.PAIR, "plj_record_date", "chart_id", "chart_date"))


@query
def w03_latest_chart_per_pair(b: Bindings) -> DataFrame:
    return ch.latest_chart_per_pair(_rows(b).select(*ch.PAIR, "chart_date", "chart_id", "MRT_Name__c"))


assert list(co.GRAINS) == CHASE_COUNTS
