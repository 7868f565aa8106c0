"""DuckDB twins of the registered queries.

They count at chart level with windows and rank with row_number, so they share
neither plan nor code with the operators they check.
"""

from __future__ import annotations

import re

from goldkeel.functions.labels import RETRIEVAL_RULES
from goldkeel.sources.bindings import LOCATION, duckdb_ctes
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


def with_ctes(ctes: dict[str, str], body: str) -> str:
    """Bindings, then the given CTEs, keeping only what the body reaches."""
    pool = {**duckdb_ctes(), **ctes}
    needed: list[str] = []
    text = body
    for name in reversed(list(pool)):
        if _mentions(text, name):
            needed.insert(0, name)
            text += " " + pool[name]
    head = ", ".join(f"{name} as ({pool[name]})" for name in needed)
    return f"with {head} {body}"


def _mentions(text: str, name: str) -> bool:
    return re.search(rf"\b(from|join)\s+{name}\b", text) is not None


def clean(x: str) -> str:
    return f"nullif(regexp_replace({x}, '[^0-9]', '', 'g'), '')"


def later(modified: str, created: str) -> str:
    return f"case when coalesce({modified}, {created}) > {created} then {modified} else {created} end"


def lines(p: str = "") -> str:
    return (
        f"(case when {p}Address_Line_1__c is null then '' else {p}Address_Line_1__c || ' ' end"
        f" || coalesce({p}Address_Line_2__c, ''))"
    )


def big(x: str) -> str:
    return f"cast({x} as bigint)"


PIPED = (
    lines("p.") + " || ' | ' || coalesce(p.City__c, '') || ' | ' || coalesce(p.State__c, '')"
    " || ' | ' || coalesce(p.ZIP_Code__c, '')"
)
FULL = "(p.Provider_Full_Address_With_Suite__c || ' | ' || p.City__c || ' | ' || p.State__c || ' | ' || p.ZIP_Code__c)"

CONTACT = f"""
    p.NPI__c, p.TIN_ID__c, p.Provider_Full_Address__c, p.Provider_Full_Address_With_Suite__c,
    p.Address_Line_1__c as Address_Line, p.Address_Line_2__c as Address_Line_Suite,
    {lines('p.')} as Address_With_Suite, p.City__c, p.State__c, p.ZIP_Code__c,
    (case when p.Address_Line_1__c is null then '' else p.Address_Line_1__c || ' ' end
     || case when p.Address_Line_2__c is null then '' else p.Address_Line_2__c || ' ' end
     || case when p.City__c is null then '' else p.City__c || ' ' end
     || case when p.State__c is null then '' else p.State__c || ' ' end
     || case when p.ZIP_Code__c is null then '' else p.ZIP_Code__c || ' ' end) as full_address,
    {clean('coalesce(p.Phone_Number__c, p.Secondary_Phone_Number__c)')} as Phone_Number_Select,
    {clean('p.Phone_Number__c')} as Phone_Number_1,
    {clean('p.Secondary_Phone_Number__c')} as Phone_Number_2,
    {clean('p.Fax_Number__c')} as Fax_Number__c
"""


def retrieval(name: str) -> str:
    """The label of a retrieval name: the first rule with a keyword in it."""
    cases = f"when {name} is null then 'NullsOthers' "
    for rule in RETRIEVAL_RULES:
        tests = [f"contains(lower({name}), '{word.lower()}')" for word in rule.keywords]
        tests += [f"lower(rtrim({name}, ' ')) = '{word.lower()}'" for word in rule.whole]
        cases += f"when {' or '.join(tests)} then '{rule.label}' "
    return f"case {cases} else 'Field' end"


PASSING = (
    "c.FileBound_Disposition_Code__c = 'QAP' and c.FileBound_Status__c = 'REL' and c.MRT_Name__c <> 'Replication'"
)

# Count columns and the extra partition keys of each: n = NPI, t = TIN, a = address, f = full address, ph = phone.
PARTITIONS = {
    "charts_at_loc": "",
    "CountOfCharts_atLoc_byNpiTinAddPhone": "n, t, a, ph",
    "CountOfCharts_atLoc_byNpiAddPhone": "n, a, ph",
    "CountOfCharts_atLoc_byNpiPhone": "n, ph",
    "CountOfCharts_atLoc_byNpiAdd": "n, a",
    "CountOfCharts_atLoc_byNpiTinAdd": "n, t, a",
    "CountOfCharts_atLoc_byNpiTin": "n, t",
    "CountOfCharts_atLoc_byNpiTinPhone": "n, t, ph",
    "CountOfCharts_atLoc_byTinAddPhone": "t, a, ph",
    "CountOfCharts_atLoc_byTinPhone": "t, ph",
    "CountOfCharts_atLoc_byTinAdd": "t, f",
    "CountOfCharts_atLoc_byPhone": "ph",
    "CountOfCharts_atLoc_byAddress": "a",
    "CountOfCharts_atLoc_byNpi": "n",
    "CountOfCharts_atLoc_byTin": "t",
}
SESSION_COUNTS = [
    c for c in CHASE_COUNTS if c.split("_")[-1] not in ("byNpiTinAdd", "byNpiTin", "byNpiTinPhone", "byNpi", "byTin")
]


def rel_ctes(
    prefix: str = "", project: str = "true", mode: str = "lines", junction: str = "junction"
) -> dict[str, str]:
    """Links, chart rows with all window counts, and one row per pair."""
    counts = ", ".join(
        f"count(chart_id) over (partition by Location__c{', ' + (keys.replace('a', 'f') if mode == 'full' else keys) if keys else ''}) as {name}"
        for name, keys in PARTITIONS.items()
    )
    return {
        f"{prefix}links": f"""
            select Location__c, Provider__c, plj_record_date from (
              select Location__c, Provider__c, {later('LastModifiedDate', 'CreatedDate')} as plj_record_date,
                     row_number() over (partition by Location__c, Provider__c
                                        order by LastModifiedDate nulls first, CreatedDate nulls first) as rn
              from {junction} where Project_Name__c in (select Project_Name__c from provider where {project})) ranked
            where rn = 1""",
        f"{prefix}rel": f"""
            select *, {counts} from (
              select l.Location__c, l.Provider__c, l.plj_record_date, c.Id as chart_id, c.MRT_Name__c,
                     c.Appointment_Type__c, {later('c.LastModifiedDate', 'c.CreatedDate')} as chart_date,
                     {retrieval('c.MRT_Name__c')} as kind,
                     p.NPI__c, p.TIN_ID__c, p.Phone_Number__c, p.NPI__c as n, p.TIN_ID__c as t, {PIPED} as a,
                     {FULL} as f, coalesce(p.Phone_Number__c, p.Secondary_Phone_Number__c) as ph
              from {prefix}links l join chart c on l.Location__c = c.Location__c and l.Provider__c = c.Provider__c
              join provider p on l.Provider__c = p.Id where {PASSING}) base""",
        f"{prefix}pair": f"""
            select * from (select *, row_number() over (partition by Location__c, Provider__c
                                                        order by chart_date desc, chart_id, MRT_Name__c) as rn
                           from {prefix}rel) ranked where rn = 1""",
        f"{prefix}kinds": f"""
            select Location__c, charts_at_loc,
              count(*) filter (where kind = 'SFTP') as charts_retreived_via_SFTP,
              count(*) filter (where kind = 'Mail Room') as charts_retreived_via_MailRoom,
              count(*) filter (where kind = 'Fax') as charts_retreived_via_Fax,
              count(*) filter (where kind = 'E-Mail') as charts_retreived_via_eMail,
              count(*) filter (where kind = 'CopyService') as charts_retreived_via_CopyService,
              count(*) filter (where kind = 'Field') as charts_retreived_via_Field,
              count(*) filter (where kind = 'NullsOthers') as charts_retreived_via_NullOthers
            from {prefix}rel group by Location__c, charts_at_loc""",
        f"{prefix}retrieval": f"""
            select k.Location__c, k.charts_at_loc, b.Best_Retreival_Type, k.* exclude (Location__c, charts_at_loc)
            from {prefix}kinds k join (
              select Location__c, label as Best_Retreival_Type, row_number() over (
                       partition by Location__c order by amount desc, place) as rn
              from (select Location__c, 1 as place, 'SFTP' as label, charts_retreived_via_SFTP as amount from {prefix}kinds
                    union all select Location__c, 2, 'MailRoom', charts_retreived_via_MailRoom from {prefix}kinds
                    union all select Location__c, 3, 'Fax', charts_retreived_via_Fax from {prefix}kinds
                    union all select Location__c, 4, 'eMail', charts_retreived_via_eMail from {prefix}kinds
                    union all select Location__c, 5, 'CopyService', charts_retreived_via_CopyService from {prefix}kinds
                    union all select Location__c, 6, 'Field', charts_retreived_via_Field from {prefix}kinds
                    union all select Location__c, 7, 'NullOthers', charts_retreived_via_NullOthers from {prefix}kinds) u
              ) b on k.Location__c = b.Location__c and b.rn = 1""",
    }


LOCATION_PHONE = clean("coalesce(Phone_1__c, Phone_2__c)")


def hashed(*parts: str) -> str:
    return "upper(md5(" + " || ".join(f"'#$%^&' || coalesce({p}, '') || '&^%$#'" for p in parts) + "))"


def id_columns(mode: str = "lines") -> str:
    street = lines() if mode == "lines" else "Provider_Full_Address__c"
    place = (street, "City__c", "State__c", "ZIP_Code__c")
    base = f"substring(coalesce({LOCATION_PHONE}, ''), 1, 9)"
    return (
        f"{hashed(*place, LOCATION_PHONE)} as NEW_LID_ALL, {hashed(*place)} as NEW_LID_ADD, "
        f"{hashed(LOCATION_PHONE)} as NEW_LID_PHONE, {base} as base_phone, "
        f"{hashed(*place, base)} as NEW_LID_ADD_BASE_PHONE"
    )


HAS_CONTACT = "(Provider_Full_Address__c is not null or coalesce(Phone_1__c, Phone_2__c) is not null)"
CLEANED = ["Phone_1__c", "Phone_2__c", "Fax_Number__c", "Fax_Number_Console__c", "Fax_Number_For_Display__c"]
RENAMED = ["Id", "Name", "Address_Line_1__c", "Address_Line_2__c", "ZIP_Code__c", *CLEANED]
PLAIN = [c for c in LOCATION if c not in RENAMED]


def candidate_cte(
    prefix: str = "", mode: str = "lines", where: str = "true", name: str = "cand", raw: bool = False
) -> dict[str, str]:
    cleaned = [c if raw and c.startswith("Fax") else f"{clean(c)} as {c}" for c in CLEANED]
    zip_code = "ZIP_Code__c" if raw else (
        "case when length(rtrim(ZIP_Code__c)) < 5 then '0' || ZIP_Code__c else ZIP_Code__c end as ZIP_Code__c"
    )
    return {
        f"{prefix}{name}": f"""
            select l.Id as Location__c, l.Name as SFDC_LID, l.* exclude (Id, Name, source_line_1, source_line_2),
                   l.source_line_1 as Address_Line, l.source_line_2 as Address_Suite_No,
                   r.charts_at_loc as charts_recovered_at_loc, r.* exclude (Location__c, charts_at_loc)
            from (select Id, Name, {id_columns(mode)}, {', '.join(PLAIN)},
                         Address_Line_1__c as source_line_1, Address_Line_2__c as source_line_2,
                         {lines()} as Address_With_Suite,
                         {zip_code}, {', '.join(cleaned)}
                  from location where {where}) l
            join {prefix}retrieval r on l.Id = r.Location__c""",
    }


REPORT = """
    select NEW_LID_ALL, NEW_LID_ADD, NEW_LID_PHONE, NEW_LID_ADD_BASE_PHONE, Location__c, SFDC_LID,
           CreatedDate as sfdcLidCreatedDate,
           count(SFDC_LID) over (partition by NEW_LID_ALL) as count_sfLid_at_NewLIdAll,
           count(SFDC_LID) over (partition by NEW_LID_ADD) as count_sfLid_at_NewLIdAdd,
           count(SFDC_LID) over (partition by NEW_LID_PHONE) as count_sfLid_at_NewLIdPhone,
           count(SFDC_LID) over (partition by NEW_LID_ADD_BASE_PHONE) as count_sfLid_at_NewLIdBasePhone
    from cand"""

# Columns of a golden record.
GOLDEN_COLUMNS = """
    Contact_Person__c, Contact_Person_2__c, Practice_Name__c, Address_Line, Address_Suite_No, Address_With_Suite,
    City__c, State__c, ZIP_Code__c, Phone_1__c, Phone_1_Ext__c, Phone_2__c, Phone_2_Ext__c, Fax_Number__c,
    Fax_Number_Console__c, Fax_Number_For_Display__c, CreatedDate, Num_of_Charts__c as charts_numbers_at_loc,
    charts_recovered_at_loc,
    cast(cast((10000 * charts_recovered_at_loc) // nullif(Num_of_Charts__c, 0) as decimal(16, 0)) * cast(0.01 as decimal(3, 2))
         as decimal(18, 2)) as Percent_of_Charts_Recovered__c,
    Best_Retreival_Type, charts_retreived_via_SFTP, charts_retreived_via_MailRoom, charts_retreived_via_Fax,
    charts_retreived_via_eMail, charts_retreived_via_CopyService, charts_retreived_via_Field,
    charts_retreived_via_NullOthers, Record_Storage_Type__c, EMR_System__c, EMR_Version__c, Other_EMR_System__c,
    Appointment_Type__c, Workflow_Status__c, Invoices__c, PNP_Reason__c, Location__Latitude__s, Location__Longitude__s
"""


def golden(extra: str = "", source: str = "cand") -> str:
    return f"""
        select NEW_LID_ALL as New_lid_all, {extra} {GOLDEN_COLUMNS} from (
          select *, row_number() over (partition by NEW_LID_ALL order by charts_recovered_at_loc desc, Location__c) as rn,
                 count(SFDC_LID) over (partition by NEW_LID_ALL) as count_sfLid_at_NewLId from {source}) ranked
        where rn = 1"""


def chase(prefix: str = "", client: str | None = None, project: str | None = None) -> str:
    constants = "" if client is None else f"'{client}' as Client_name, '{project}' as Project_Name, "
    sums = ", ".join(f"{big(f'sum(p.{c})')} as {c}" for c in CHASE_COUNTS)
    return f"""select {constants} m.NEW_LID_ALL as New_lid_all, max(m.CreatedDate) as CreatedDate, {sums}
               from {prefix}cand m join {prefix}pair p on m.Location__c = p.Location__c group by m.NEW_LID_ALL"""


def run_ctes(
    prefix: str, project: str, where: str, client: str, name: str, junction: str = "junction"
) -> dict[str, str]:
    return {
        **rel_ctes(prefix, project, junction=junction),
        **candidate_cte(prefix, where=where),
        f"{prefix}chase": chase(prefix, client, name),
    }


LABEL_ROWS = ["Client_name", "Project_Name", "New_lid_all", "CreatedDate"]


def merged_map(target: str, source: str) -> str:
    """Additive upsert by a full outer join."""
    hit = f"{source}.New_lid_all is not null and {target}.New_lid_all is not null"
    labels = ", ".join(
        f"case when {target}.New_lid_all is not null then {target}.{c} else {source}.{c} end as {c}" for c in LABEL_ROWS
    )
    sums = ", ".join(
        f"case when {hit} then {target}.{c} + {source}.{c} when {target}.New_lid_all is not null then {target}.{c} "
        f"else {source}.{c} end as {c}"
        for c in CHASE_COUNTS
    )
    return f"select {labels}, {sums} from {target} full join {source} on {target}.New_lid_all = {source}.New_lid_all"


def change_feed(target: str, source: str) -> str:
    columns = [*LABEL_ROWS, *CHASE_COUNTS]
    before = ", ".join(f"{target}.{c} as deleted_{c}" for c in columns)
    after = ", ".join(
        f"case when {target}.New_lid_all is null then {source}.{c} "
        + (f"else {target}.{c} + {source}.{c}" if c in CHASE_COUNTS else f"else {target}.{c}")
        + f" end as inserted_{c}"
        for c in columns
    )
    return f"""select case when {target}.New_lid_all is null then 'INSERT' else 'UPDATE' end as action, {before}, {after}
               from {source} left join {target} on {target}.New_lid_all = {source}.New_lid_all"""


ALL = rel_ctes()
FULL_MODE = rel_ctes(mode="full")
CAND = {**ALL, **candidate_cte()}
SESSION_CAND = {**FULL_MODE, **candidate_cte(mode="full", where=HAS_CONTACT)}
UPSERT = {
    **run_ctes("e_", "Project_Name__c like '%|0'", HAS_CONTACT, EVEN, EVEN),
    **run_ctes("o_", "Project_Name__c like '%|1'", "true", ODD, ODD),
}
JOBS = {
    **run_ctes("a_", f"Project_Name__c = '{PROJECT_A}'", "true", CLIENT_A, PROJECT_A),
    **run_ctes("b_", f"Project_Name__c = '{PROJECT_B}'", "true", CLIENT_A, PROJECT_B),
}
REGIONAL = {
    **run_ctes("ra_", f"Project_Name__c = '{PROJECT_A}'", "true", CLIENT_A, PROJECT_A, "regional_junction"),
    **run_ctes("rb_", f"Project_Name__c = '{PROJECT_B}'", "true", CLIENT_A, PROJECT_B, "regional_junction"),
}
REGIONAL_MAP = merged_map("ra_chase", "rb_chase")
CONTROL = {
    "control": """
        select distinct cast(ascii(substring(Client_Name__c, 1, 1)) as bigint) as MasteredProjetsListKey,
               'LOCATION' as masterName, Client_Name__c as sourceSystem, Project_Name__c as sourceProject
        from provider where Project_Name__c like '%|0'"""
}
STATUS = "case when n.Entity_Type_Code = '1' then 'Individual' when n.Entity_Type_Code = '2' then 'Organization' else '{}' end"
VIEW = {
    "view_rows": f"""
        select p.NPI__c as provider_npi, p.Project_Name__c, p.Client_Name__c, p.Full_Name__c,
               p.Provider_Full_Address_With_Suite__c, p.Phone_Number__c, p.Fax_Number__c, p.Secondary_Phone_Number__c,
               p.City__c, p.State__c, p.ZIP_Code__c, p.Provider_Specialty__c, n.NPI as npi_npi,
               n.Healthcare_Provider_Taxonomy_Group_1 as Taxonomy_GRP1,
               n.Healthcare_Provider_Taxonomy_Group_2 as Taxonomy_Grp2,
               n.Healthcare_Provider_Taxonomy_Code_1 as Taxonomy_code1,
               n.Healthcare_Provider_Taxonomy_Code_2 as Taxonomy_code2,
               {STATUS.format('De-activated')} as Status_of_npi, d.NPI as deactivated_npi
        from registry n join provider p on p.NPI__c = n.NPI left join deactivation d on n.NPI = d.NPI"""
}
ACTIVE = "Project_status__c <> 'Inactive' and NPI__c is not null"
ACTIVE_LIST = f"""select NPI__c, Full_Name__c, Phone_Number__c, Provider_Full_Address_With_Suite__c, City__c, State__c
                  from provider where {ACTIVE}"""


def shown_phone(column: str, missing: str) -> str:
    return (
        f"case when length({column}) >= 7 then '(' || substring({column}, 1, 3) || ')' || substring({column}, 4, 3) "
        f"|| '-' || substring({column}, 7) else '{missing}' end"
    )


def _repeated(having: str) -> str:
    return with_ctes(
        {},
        f"""select NPI__c, count(*) as count_recs, count(distinct Project_Name__c) as count_projects from provider
            where CreatedDate > date '2015-01-01' group by NPI__c having {having}""",
    )


def _count_of_deactivated(where: str) -> str:
    return with_ctes(
        {},
        f"""select count(p.NPI__c) as count_npi from provider p join registry n on p.NPI__c = n.NPI
            join deactivation d on p.NPI__c = d.NPI where n.Entity_Type_Code is null and {where}""",
    )


def _uniqueness(table: str, ctes: dict[str, str]) -> str:
    return with_ctes(
        ctes,
        f"""select {big('sum(size)')} as row_count, count(*) as distinct_keys,
                   count(*) filter (where size > 1) as repeated_keys
            from (select Location__c, Provider__c, count(*) as size from {table} group by Location__c, Provider__c) g""",
    )


def _reduction() -> str:
    return with_ctes(
        CAND,
        f"""select id_kind, count(*) as row_count, count(distinct Location__c) as distinct_locations,
                   count(distinct new_id) as distinct_new_ids, count(*) - count(distinct new_id) as ids_saved,
                   count(*) filter (where size > 1) as rows_in_merged_groups,
                   count(distinct case when size > 1 then new_id end) as merged_groups
            from (select *, count(*) over (partition by id_kind, new_id) as size from ({_kinds()}) k) s group by id_kind""",
    )


def _kinds() -> str:
    return " union all ".join(
        f"select '{kind}' as id_kind, Location__c, SFDC_LID, {kind} as new_id from cand"
        for kind in ("NEW_LID_ALL", "NEW_LID_ADD", "NEW_LID_PHONE", "NEW_LID_ADD_BASE_PHONE")
    )


def _merged_ids() -> str:
    return f"""select id_kind, new_id, count(*) as row_count, count(distinct Location__c) as distinct_locations,
                      count(distinct SFDC_LID) as distinct_source_ids
               from ({_kinds()}) k group by id_kind, new_id having count(SFDC_LID) > 1"""


def _numbered(body: str, order: str) -> str:
    return f"select *, row_number() over (order by {order}) as place from ({body}) report"


def _control_rows(*rows: tuple[int, str]) -> str:
    values = ", ".join(f"(cast({key} as bigint), 'LOCATION', '{CLIENT_A}', '{project}')" for key, project in rows)
    return f"""select * from (values {values}) v(MasteredProjetsListKey, masterName, sourceSystem, sourceProject)
               where sourceProject in (select Project_Name__c from provider)"""


def oracle_sql() -> dict[str, str]:
    report_order = ", ".join(
        f"{c} nulls first"
        for c in (
            "NEW_LID_ALL", "NEW_LID_ADD", "NEW_LID_PHONE", "NEW_LID_ADD_BASE_PHONE", "Location__c", "SFDC_LID",
            "sfdcLidCreatedDate", "count_sfLid_at_NewLIdAll", "count_sfLid_at_NewLIdAdd",
            "count_sfLid_at_NewLIdPhone", "count_sfLid_at_NewLIdBasePhone",
        )
    )
    session_golden = golden("Location__c, SFDC_LID, Client_Name__c, Provider_Full_Address__c, count_sfLid_at_NewLId,")
    removed = f"select * from ({REGIONAL_MAP}) m where Project_Name = '{PROJECT_A}'"
    remaining = f"select * from ({REGIONAL_MAP}) m where Project_Name <> '{PROJECT_A}'"
    first, second = golden(source="ra_cand"), golden(source="rb_cand")
    appended = f"select * from ({second}) s where New_lid_all not in (select NEW_LID_ALL from ra_cand)"
    counts = ", ".join(CHASE_COUNTS)
    session = ", ".join(SESSION_COUNTS)
    session_sums = ", ".join(f"{big(f'sum(p.{c})')} as {c}" for c in SESSION_COUNTS)
    status = "select n.NPI, n.Entity_Type_Code, {} as Status_of_npi from registry n"
    view_columns = (
        "Client_Name__c, npi_npi, provider_npi, Status_of_npi, Taxonomy_GRP1, Taxonomy_Grp2, Taxonomy_code1, "
        "Taxonomy_code2, Full_Name__c"
    )
    summary = "select Project_Name__c, Client_Name__c, Status_of_npi, count(*) as count_recs from view_rows {} group by all"
    return {
        "c01_select_projects": with_ctes(
            {}, "select Client_Name__c, Project_Name__c, count(*) as count_recs from provider group by all"
        ),
        "c01_select_projects_like": with_ctes(
            {},
            "select Client_Name__c, Project_Name__c, count(*) as count_recs from provider "
            "where Client_Name__c like '%U%' and Project_Name__c like '%2018%MRR%0' group by all",
        ),
        "c02_provider_locations": with_ctes(ALL, "select * from links"),
        "c03_qualifying_charts": with_ctes(
            ALL,
            f"""select l.Location__c, l.Provider__c, l.plj_record_date, c.Id as chart_id,
                       {later('c.LastModifiedDate', 'c.CreatedDate')} as chart_date, c.MRT_Name__c,
                       c.Appointment_Type__c, {CONTACT}
                from links l join chart c on l.Location__c = c.Location__c and l.Provider__c = c.Provider__c
                join provider p on l.Provider__c = p.Id where {PASSING}""",
        ),
        "c04_contact_keys": with_ctes({}, f"select p.Id as Provider__c, {CONTACT} from provider p"),
        "c05_chart_count_matrix": with_ctes(ALL, f"select Location__c, Provider__c, {counts} from pair"),
        "c05_chart_count_matrix_full_address": with_ctes(
            FULL_MODE, f"select Location__c, Provider__c, {session} from pair"
        ),
        "c06_classify_retrieval": with_ctes(
            {}, f"select Id, Location__c, Provider__c, MRT_Name__c, {retrieval('MRT_Name__c')} as Retreival_type from chart"
        ),
        "c06_classify_every_keyword": with_ctes(
            {},
            f"""select Id, MRT_Name__c, {retrieval('MRT_Name__c')} as Retreival_type
                from (select Id, {KEYWORD_NAMES} as MRT_Name__c from chart) named""",
        ),
        "c07_retrieval_summary": with_ctes(ALL, "select * from retrieval"),
        "c08_appointment_counts": with_ctes(
            ALL,
            """select Location__c, Provider__c, plj_record_date, chart_id, chart_date, Appointment_Type__c,
                      count(Provider__c) over (partition by Location__c) as provider_charts_at_loc,
                      count(chart_id) over (partition by Location__c, Appointment_Type__c)
                        as countOfChartsAtLocationbyAppointmentType
               from rel""",
        ),
        "c09_location_ids": with_ctes(
            {}, f"select Id as Location__c, Name as SFDC_LID, {id_columns()} from location"
        ),
        "c09_location_ids_full_address": with_ctes(
            {}, f"select Id as Location__c, Name as SFDC_LID, {id_columns('full')} from location"
        ),
        "c10_location_candidates": with_ctes(CAND, "select * from cand"),
        "c10_location_candidates_with_contact": with_ctes(SESSION_CAND, "select * from cand"),
        "c10_location_candidates_raw": with_ctes(
            {**FULL_MODE, **candidate_cte(mode="full", where=HAS_CONTACT, raw=True)}, "select * from cand"
        ),
        "c11_merge_report": with_ctes(CAND, REPORT),
        "c11_merge_report_sorted": with_ctes(
            CAND, _numbered(REPORT, f"count_sfLid_at_NewLIdAll desc nulls last, {report_order}")
        ),
        "c12_location_master_sorted": with_ctes(
            SESSION_CAND,
            _numbered(
                session_golden,
                "New_lid_all nulls first, Provider_Full_Address__c nulls first, "
                "coalesce(Phone_1__c, Phone_2__c) nulls first",
            ),
        ),
        "c12_location_master_uncut": with_ctes(
            CAND,
            f"""select New_lid_all, round(100.0::double * charts_recovered_at_loc / nullif(charts_numbers_at_loc, 0), 6)
                         as Percent_of_Charts_Recovered__c from ({golden()}) g""",
        ),
        "c12_location_master": with_ctes(
            CAND,
            golden(
                "'Contact Info=>' as DATASET_CONTACT_INFO, 'Charts Info=>' as DATASET_CHARTS_INFO, "
                "'Med. Rec. Storage Info=>' as DATASET_STORAGE_INFO, 'Other Info=>' as DATASET_OTHER_INFO,"
            ),
        ),
        "c12_location_master_with_source": with_ctes(
            SESSION_CAND,
            golden("Location__c, SFDC_LID, Client_Name__c, Provider_Full_Address__c, count_sfLid_at_NewLId,"),
        ),
        "c13_chase_list": with_ctes(CAND, chase()),
        "c13_chase_list_sorted": with_ctes(CAND, _numbered(chase(), "New_lid_all desc nulls last")),
        "c13_distinct_chase_map": with_ctes(
            SESSION_CAND,
            """select distinct m.NEW_LID_ALL as New_lid_all, p.NPI__c, p.TIN_ID__c, p.f as FULL_ADDRESS,
                      p.ph as Phone_Number__c
               from cand m join pair p on m.Location__c = p.Location__c""",
        ),
        "c13_chase_list_by_provider": with_ctes(
            SESSION_CAND,
            f"""select m.NEW_LID_ALL as New_lid_all, p.NPI__c, p.TIN_ID__c, p.f as FULL_ADDRESS, p.Phone_Number__c,
                       {session_sums}
                from cand m join pair p on m.Location__c = p.Location__c
                group by m.NEW_LID_ALL, p.NPI__c, p.TIN_ID__c, p.f, p.Phone_Number__c""",
        ),
        "c14_accumulate_chase_list": with_ctes(UPSERT, merged_map("e_chase", "o_chase")),
        "c14_change_feed": with_ctes(UPSERT, change_feed("e_chase", "o_chase")),
        "c15_append_masters": with_ctes(
            CAND,
            f"""select * from ({golden()}) g where New_lid_all not in (
                  select NEW_LID_ALL from cand
                  where Provider_Full_Address__c is not null or coalesce(Phone_1__c, Phone_2__c) is not null)""",
        ),
        "c15_append_masters_of_next_project": with_ctes(REGIONAL, appended),
        "c16_register_project": with_ctes(
            CONTROL,
            f"""select * from control union all
                select max(MasteredProjetsListKey) + 1, 'LOCATION', '{CLIENT_A}', '{PROJECT_B}' from control""",
        ),
        "c17_unmaster_remaining_map": with_ctes(
            UPSERT, f"select * from ({merged_map('e_chase', 'o_chase')}) m where Project_Name <> '{EVEN}'"
        ),
        "c17_unmaster_archived_map": with_ctes(
            UPSERT, f"select * from ({merged_map('e_chase', 'o_chase')}) m where Project_Name = '{ODD}'"
        ),
        "c17_unmaster_control": with_ctes(
            CONTROL, f"select * from control where not (sourceProject = '{PROJECT_A}' and sourceSystem = '{CLIENT_A}')"
        ),
        "c18_master_projects": with_ctes(JOBS, merged_map("a_chase", "b_chase")),
        "c18_undo_project": with_ctes(
            JOBS, f"select * from ({merged_map('a_chase', 'b_chase')}) m where Project_Name <> '{PROJECT_B}'"
        ),
        "c17_unmaster_regional_remaining": with_ctes(REGIONAL, remaining),
        "c17_unmaster_regional_archived": with_ctes(REGIONAL, removed),
        "c18_map_after_adds": with_ctes(REGIONAL, REGIONAL_MAP),
        "c18_map_after_delete": with_ctes(REGIONAL, remaining),
        "c18_backup_after_delete": with_ctes(REGIONAL, removed),
        "c18_control_after_adds": with_ctes({}, _control_rows((1, PROJECT_A), (2, PROJECT_B))),
        "c18_control_after_delete": with_ctes({}, _control_rows((2, PROJECT_B))),
        "c18_masters_after_first_add": with_ctes(REGIONAL, first),
        "c18_masters_after_delete": with_ctes(REGIONAL, f"select * from ({first}) f union all {appended}"),
        "c19_load_npi_registry": with_ctes({}, "select * from registry_file"),
        "c19_rejects": with_ctes(
            {}, "select NPI, NPI || ',unknown' as line from deactivation where cast(NPI as bigint) % 7 = 0"
        ),
        "c20_load_deactivations": with_ctes({}, "select * from deactivation"),
        "c21_npi_status": with_ctes({}, status.format(STATUS.format("De-activated"))),
        "c21_npi_status_no_record": with_ctes({}, status.format(STATUS.format("No Record"))),
        "c21_npi_status_of_registry_file": with_ctes(
            {}, f"select n.*, {STATUS.format('De-activated')} as Status_of_npi from registry_file n"
        ),
        "c22_provider_registry_view": with_ctes(VIEW, "select * from view_rows"),
        "c23_one_per_client_npi": with_ctes(
            VIEW,
            f"""select {view_columns} from (select {view_columns}, row_number() over (
                  partition by Client_Name__c, npi_npi order by provider_npi nulls first, Status_of_npi nulls first,
                    Taxonomy_GRP1 nulls first, Taxonomy_Grp2 nulls first, Taxonomy_code1 nulls first,
                    Taxonomy_code2 nulls first, Full_Name__c nulls first) as rn from view_rows) r where rn = 1""",
        ),
        "c23_one_per_client_project": with_ctes(
            {},
            """select Client_Name__c, Project_Name__c, NPI__c, Id from (
                 select Client_Name__c, Project_Name__c, NPI__c, Id, row_number() over (
                   partition by Client_Name__c, Project_Name__c order by NPI__c nulls first, Id) as rn from provider) r
               where rn = 1""",
        ),
        "c24_status_summary": with_ctes(VIEW, summary.format("")),
        "c24_status_summary_without_client": with_ctes(
            VIEW, summary.format(f"where Client_Name__c <> '{CLIENT_A}'")
        ),
        "c25_deactivated_in_project": _count_of_deactivated("true"),
        "c25_deactivated_in_one_project": _count_of_deactivated(
            f"p.Project_Name__c = '{PROJECT_A}' and p.Client_Name__c = '{CLIENT_A}'"
        ),
        "c25_providers_without_entity": with_ctes(
            {}, "select p.NPI__c from provider p join registry n on p.NPI__c = n.NPI where n.Entity_Type_Code is null"
        ),
        "c26_repeated_npis_by_rows": _repeated("count(*) > 1"),
        "c26_repeated_npis_by_projects": _repeated("count(distinct Project_Name__c) > 1"),
        "c27_active_project_profile": with_ctes(
            {}, f"select Client_Name__c, Project_Name__c, count(*) as count_recs from provider where {ACTIVE} group by all"
        ),
        "c27_active_project_profile_sorted": with_ctes(
            {},
            _numbered(
                "select Client_Name__c, Project_Name__c, count(*) as count_recs from provider "
                f"where {ACTIVE} group by all",
                "Client_Name__c nulls first, Project_Name__c nulls first",
            ),
        ),
        "c28_active_providers": with_ctes({}, ACTIVE_LIST),
        "c28_active_providers_of_project": with_ctes({}, f"{ACTIVE_LIST} and Project_Name__c = '{PROJECT_A}'"),
        "c29_provider_vs_registry_address": with_ctes(
            {},
            f"""select p.NPI__c, p.Full_Name__c, p.Phone_Number__c, p.Provider_Full_Address_With_Suite__c, p.City__c,
                       p.State__c, p.CreatedDate, n.NPI, {STATUS.format('No Record')} as Status_of_npi,
                       n.Provider_First_Line_Business_Mailing_Address, n.Provider_Second_Line_Business_Mailing_Address
                from registry n join provider p on n.NPI = p.NPI__c where {ACTIVE}""",
        ),
        "c30_contact_report": with_ctes(
            VIEW,
            f"""select * exclude (Phone_Number__c, Fax_Number__c, Secondary_Phone_Number__c),
                       {shown_phone('Phone_Number__c', '0')} as Phone_number,
                       {shown_phone('Fax_Number__c', '0')} as Fax_number,
                       {shown_phone('Secondary_Phone_Number__c', 'Not available')} as Secondary_phone_number
                from view_rows""",
        ),
        "c31_npi_footprint_by_client": with_ctes(
            {},
            f"select NPI__c, Client_Name__c, count(*) as count_recs from provider where NPI__c = '{NPI}' group by all",
        ),
        "c31_npi_footprint_by_project": with_ctes(
            {},
            "select Project_Name__c, Client_Name__c, count(*) as count_recs from provider "
            f"where NPI__c = '{NPI}' group by all",
        ),
        "c32_taxonomy_fallback": with_ctes({}, FALLBACK),
        "c32_taxonomy_fallback_top": with_ctes(
            {}, f"select * from ({FALLBACK}) t order by NPI nulls first, Healthcare_Provider_Taxonomy_Code_1 nulls first limit 10"
        ),
        "c33_taxonomy_lookup": with_ctes(
            {},
            "select distinct Healthcare_Provider_Taxonomy_Code_1 as taxonomy_code from registry "
            f"where lower(Healthcare_Provider_Taxonomy_Code_1) in ({', '.join(repr(c.lower()) for c in TAXONOMY_CODES)})",
        ),
        "c34_taxonomy_groups": with_ctes(
            {},
            "select NPI, Entity_Type_Code, "
            + ", ".join(f"Healthcare_Provider_Taxonomy_Group_{i}" for i in range(1, 16))
            + " from registry",
        ),
        "c35_find_npi_in_provider": with_ctes(
            {},
            "select NPI__c, provider_id__c, Project_Name__c, Client_Name__c, Full_Name__c from provider "
            f"where NPI__c = '{NPI}' and provider_id__c is not null order by Project_Name__c, Client_Name__c",
        ),
        "c35_find_npi_in_registry": with_ctes({}, f"select * from registry where NPI = '{NPI}'"),
        "c35_find_npi_in_deactivations": with_ctes({}, f"select * from deactivation where NPI = '{NPI}'"),
        "c36_registry_active_count": with_ctes(
            {}, "select count(distinct NPI) as active_npis from registry where Entity_Type_Code is not null"
        ),
        "c37_uniqueness_of_junction": _uniqueness("junction", {}),
        "c37_uniqueness_of_links": _uniqueness("links", ALL),
        "c38_merge_reduction": _reduction(),
        "c38_merged_ids": with_ctes(CAND, _merged_ids()),
        "c38_merged_ids_sorted": with_ctes(
            CAND, _numbered(_merged_ids(), "distinct_locations desc nulls last, id_kind nulls first, new_id nulls first")
        ),
        "c39_junction_rows": with_ctes({}, f"select * from junction where Project_Name__c = '{PROJECT_A}'"),
        "c39_mastered_list": with_ctes(CONTROL, f"select * from control where sourceProject = '{PROJECT_A}'"),
        "c40_chart_counts_at_npi": with_ctes(
            FULL_MODE,
            f"""select Location__c, Provider__c, NPI__c, TIN_ID__c, f as FULL_ADDRESS, ph as Phone_Number,
                       count(chart_id) over (partition by NPI__c, TIN_ID__c, f, ph, Location__c) as pairs_at_key,
                       CountOfCharts_atLoc_byNpiTinAddPhone
                from pair where NPI__c = '{NPI}'""",
        ),
        "w02_first_row_per_location": with_ctes(
            ALL,
            """select Location__c, Provider__c, plj_record_date, chart_id, chart_date from (
                 select *, row_number() over (partition by Location__c order by plj_record_date, Provider__c, chart_id,
                                              chart_date) as first_rn from rel) r where first_rn = 1""",
        ),
        "w03_latest_chart_per_pair": with_ctes(
            ALL, "select Location__c, Provider__c, chart_date, chart_id, MRT_Name__c from pair"
        ),
    }


FALLBACK = """select NPI, Healthcare_Provider_Taxonomy_Code_1, Healthcare_Provider_Taxonomy_Code_2,
                     coalesce(Healthcare_Provider_Taxonomy_Code_1, Healthcare_Provider_Taxonomy_Code_2) as taxonomy_code
              from registry where Entity_Type_Code is not null"""
