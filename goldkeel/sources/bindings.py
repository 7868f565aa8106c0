"""The logical tables derived from the generated star schema.

Each column is one SQL expression that Spark and DuckDB both accept, so tests
can build the same tables in either engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from goldkeel.session import scratch_folder, shuffling
from goldkeel.sources.schemas import REGISTRY_DATES, registry_columns


def _text(expression: str) -> str:
    return f"cast({expression} as string)"


def _digits(expression: str, width: int) -> str:
    return f"lpad({_text(expression)}, {width}, '0')"


def _npi(expression: str, pad: str = "1000000000") -> str:
    return f"lpad({_text(expression)}, 10, '{pad}')"


PROVIDER = {
    "Id": "c_custkey",
    "provider_id__c": f"case when c_custkey % 6 = 0 then null else concat('P-', {_text('c_custkey')}) end",
    "Client_Name__c": "c_mktsegment",
    "Full_Name__c": "c_name",
    "Provider_Specialty__c": f"concat('Specialty ', {_text('c_nationkey % 7')})",
    "Project_Name__c": f"concat(c_mktsegment, '|2018|MRR|', {_text('c_custkey % 2')})",
    "Project_status__c": "case when c_custkey % 11 = 0 then 'Inactive' else 'Active' end",
    "NPI__c": "case when c_custkey % 13 = 0 then null "
    f"when c_custkey % 17 = 0 then {_npi('c_custkey', '9000000000')} else {_npi('c_custkey - c_custkey % 3')} end",
    "TIN_ID__c": f"case when c_custkey % 8 = 0 then null else concat('9900000', {_digits('c_nationkey', 2)}) end",
    "Address_Line_1__c": f"case when c_custkey % 9 = 0 then null else concat({_text('c_custkey % 30')}, ' Main St') end",
    "Address_Line_2__c": f"case when c_custkey % 3 = 0 then concat('Suite ', {_text('c_custkey % 5')}) end",
    "City__c": f"concat('City ', {_text('c_nationkey')})",
    "State__c": f"concat('S', {_text('c_nationkey')})",
    "ZIP_Code__c": f"case when c_custkey % 10 = 0 then null else {_text('1000 + c_nationkey * 397')} end",
    "Provider_Full_Address__c": f"concat({_text('c_custkey % 30')}, ' Main St, City ', {_text('c_nationkey')})",
    "Provider_Full_Address_With_Suite__c": "case when c_custkey % 9 = 0 then null "
    f"else concat({_text('c_custkey % 30')}, ' Main St, City ', {_text('c_nationkey')}) end",
    "Phone_Number__c": "case when c_custkey % 7 = 0 then null when c_custkey % 29 = 0 then '12345' "
    f"else concat('212555', {_digits('c_custkey % 10000', 4)}) end",
    "Secondary_Phone_Number__c": "case when c_custkey % 4 = 0 then null "
    f"else concat('(646) 555-', {_digits('c_custkey % 10000', 4)}) end",
    "Fax_Number__c": "case when c_custkey % 5 = 0 then null "
    f"else concat('917555', {_digits('c_custkey % 10000', 4)}) end",
    "CreatedDate": "date '2013-06-01' + cast(c_custkey % 1500 as int)",
}

_G = "cast(floor(s_suppkey / 3.0) as bigint)"
_D = "case when s_suppkey % 3 = 2 then '1' else '0' end"
LOCATION = {
    "Id": "s_suppkey",
    "Name": f"concat('LID-', {_digits('s_suppkey', 6)})",
    "Address_Line_1__c": f"case when {_G} % 9 = 8 then null else concat({_text(_G)}, ' Main St') end",
    "Address_Line_2__c": f"case when {_G} % 2 = 0 then concat('Suite ', {_text(f'{_G} % 7')}) end",
    "City__c": f"concat('City ', {_text(f'{_G} % 5')})",
    "State__c": f"concat('S', {_text(f'{_G} % 5')})",
    "ZIP_Code__c": _text(f"800 + {_G} * 37"),
    "Phone_1__c": "case when s_suppkey % 10 = 9 then null "
    f"when s_suppkey % 2 = 0 then concat('(212) 555-', {_digits(_G, 3)}, {_D}) "
    f"else concat('212.555.', {_digits(_G, 3)}, {_D}) end",
    "Phone_2__c": f"case when s_suppkey % 5 = 0 then concat('646555', {_digits(_G, 3)}, {_D}) end",
    "Provider_Full_Address__c": f"case when {_G} % 9 = 8 then null else concat({_text(_G)}, ' Main St, City') end",
    "Provider_Full_Address_With_Suite__c": f"case when {_G} % 9 = 8 then null "
    f"else concat({_text(_G)}, ' Main St, Suite ', {_text(f'{_G} % 7')}) end",
    "Phone_1_Ext__c": f"case when s_suppkey % 4 = 0 then {_text('s_suppkey % 100')} end",
    "Phone_2_Ext__c": f"case when s_suppkey % 8 = 0 then {_text('s_suppkey % 50')} end",
    "Fax_Number__c": f"concat('(718) 555-', {_digits(_G, 3)}, {_D})",
    "Fax_Number_Console__c": f"case when s_suppkey % 6 = 0 then concat('718.555.', {_digits(_G, 3)}, '9') end",
    "Fax_Number_For_Display__c": "case when s_suppkey % 7 = 0 then 'none' end",
    "Client_Name__c": f"concat('Client ', {_text('s_nationkey')})",
    "Contact_Person__c": "s_name",
    "Contact_Person_2__c": "case when s_suppkey % 3 = 0 then concat(s_name, ' jr') end",
    "Practice_Name__c": f"concat('Practice ', {_text(_G)})",
    "Record_Storage_Type__c": "case when s_suppkey % 2 = 0 then 'Paper' else 'EMR' end",
    "EMR_System__c": "case when s_suppkey % 2 = 1 then concat('EMR ', cast(s_nationkey as string)) end",
    "EMR_Version__c": "case when s_suppkey % 2 = 1 then '2.0' end",
    "Other_EMR_System__c": "case when s_suppkey % 12 = 1 then 'Other' end",
    "Num_of_Charts__c": "case when s_suppkey % 17 = 16 then 0 else 500 + s_suppkey end",
    "CreatedDate": "date '2016-01-01' + cast(s_suppkey % 2000 as int)",
    "Appointment_Type__c": f"concat('T', {_text('s_suppkey % 3')})",
    "Workflow_Status__c": "case when s_suppkey % 5 = 0 then 'Open' else 'Closed' end",
    "Invoices__c": f"case when s_suppkey % 9 = 0 then concat('INV-', {_text('s_suppkey')}) end",
    "PNP_Reason__c": "case when s_suppkey % 13 = 0 then 'No record' end",
    "Location__Latitude__s": "cast(s_nationkey as double) + 0.5",
    "Location__Longitude__s": "cast(0 - s_nationkey as double) - 0.25",
}

JUNCTION = {
    "Provider__c": "o_custkey",
    "Location__c": "l_suppkey",
    "Project_Name__c": "Project_Name__c",
    "CreatedDate": "o_orderdate",
    "LastModifiedDate": "case when l_partkey % 5 = 0 then null else l_shipdate end",
}

# The same links, but a project reaches some locations alone and shares others.
REGIONAL_JUNCTION = {
    **JUNCTION,
    "Project_Name__c": "concat(substring(Project_Name__c, 1, length(Project_Name__c) - 1), case cast(floor(l_suppkey / 3.0) as bigint) % 3 "
    f"when 0 then '0' when 1 then '1' else {_text('o_custkey % 2')} end)",
}

CHART = {
    "Id": f"concat({_text('l_orderkey')}, '-', {_text('l_linenumber')})",
    "Provider__c": "o_custkey",
    "Location__c": "l_suppkey",
    "CreatedDate": "o_orderdate",
    "LastModifiedDate": "case when l_partkey % 4 = 0 then null else l_shipdate end",
    "FileBound_Disposition_Code__c": "case when l_returnflag = 'R' then 'REJ' else 'QAP' end",
    "FileBound_Status__c": "case when l_linestatus = 'F' then 'REL' else 'PND' end",
    "Appointment_Type__c": f"concat('T', {_text('l_linenumber % 3')})",
    "MRT_Name__c": "case l_partkey % 16 when 0 then 'Client sFTP' when 1 then 'Mail Room' when 2 then 'MailRoom East' "
    "when 3 then 'RingCentral' when 4 then 'Vitelity' when 5 then 'E-Mail' when 6 then 'email box' when 7 then 'Ciox' "
    "when 8 then 'BOX' when 9 then 'Midwest ROI' when 10 then 'Verisma' when 11 then 'Replication' when 12 then null "
    "else 'J. Doe' end",
}

REGISTRY = {
    "NPI": _npi("c_custkey"),
    "Entity_Type_Code": "case when c_nationkey % 5 = 0 then null when c_nationkey % 2 = 0 then '1' else '2' end",
    "Provider_Organization_Name": f"concat('Clinic \"', {_text('c_custkey')}, '\", Ltd')",
    "Provider_First_Line_Business_Mailing_Address": f"concat({_text('c_custkey')}, ' Registry Rd')",
    "Provider_Second_Line_Business_Mailing_Address": f"case when c_nationkey % 3 = 0 then concat('Floor ', {_text('c_nationkey')}) end",
    "Provider_Business_Mailing_Address_Postal_Code": _digits("c_nationkey * 397", 5),
    "Provider_Enumeration_Date": "date '2006-01-01' + cast(c_custkey % 3000 as int)",
    "Healthcare_Provider_Taxonomy_Code_1": f"case when c_custkey % 4 = 0 then null else concat('207Q', {_digits('c_custkey % 50', 5)}, 'X') end",
    "Healthcare_Provider_Taxonomy_Code_2": f"case when c_custkey % 5 = 0 then null else concat('101Y', {_digits('c_custkey % 20', 5)}, 'X') end",
    **{
        f"Healthcare_Provider_Taxonomy_Group_{i}": f"case when (c_custkey + {i}) % 4 = 0 then 'GROUP {i}' end"
        for i in range(1, 16)
    },
}



def _registry_file() -> dict[str, str]:
    """All 329 columns in file order; those without a meaning here vary by row
    and by position, some of them missing."""
    columns = {}
    for i, name in enumerate(registry_columns()):
        if name in REGISTRY_DATES:
            value = f"date '2001-01-01' + cast((c_custkey + {i}) * 7 % 6000 as int)"
        else:
            value = f"concat('v{i} ', {_text('c_custkey % 97')})"
        columns[name] = REGISTRY.get(name) or f"case when (c_custkey + {i}) % 5 = 0 then null else {value} end"
    return columns


REGISTRY_FILE = _registry_file()

DEACTIVATION = {
    "NPI": _npi("c_custkey"),
    "NPI_Deactivation_Date": "date '2018-07-10' - cast(c_custkey % 4000 as int)",
}
DEACTIVATED = "(c_acctbal < 0 or c_custkey % 30 = 0)"


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"{expression} as {name}" for name, expression in columns.items())


def duckdb_ctes() -> dict[str, str]:
    """Each logical table as the body of a common table expression."""
    return {
        "provider": f"select {_select(PROVIDER)} from customer",
        "location": f"select {_select(LOCATION)} from supplier",
        "junction": f"select {_select(JUNCTION)} from lineitem join orders on l_orderkey = o_orderkey "
        f"join (select {_select(PROVIDER)} from customer) pr on pr.Id = o_custkey",
        "regional_junction": f"select {_select(REGIONAL_JUNCTION)} from lineitem join orders on l_orderkey = o_orderkey "
        f"join (select {_select(PROVIDER)} from customer) pr on pr.Id = o_custkey",
        "chart": f"select {_select(CHART)} from lineitem join orders on l_orderkey = o_orderkey",
        "registry": f"select {_select(REGISTRY)} from customer",
        "registry_file": f"select {_select(REGISTRY_FILE)} from customer",
        "deactivation": f"select {_select(DEACTIVATION)} from customer where {DEACTIVATED}",
    }


LINES_PER_TASK = 1_000_000
MADE_OF_LINES = ("chart", "junction", "regional_junction")
WIDE_ROWS_PER_TASK = 20_000  # of 329 columns, which a narrow file of few blocks becomes

# Column types of the generated tables, so reading them infers nothing.
STAR_SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_returnflag string, "
    "l_linestatus string, l_shipdate timestamp_ntz",
}


class Bindings:
    """The logical tables over one folder of Parquet files.

    Each table is derived once per session, written to the shared folder and
    scanned from there, as stored provider, chart and location tables would be.
    """

    _written: dict[tuple[str, str, str], tuple[str, StructType]] = {}

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def _star(self, name: str) -> DataFrame:
        return self.spark.read.schema(STAR_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def _parts(self, rows: DataFrame, each: int) -> int:
        """Tasks for so many rows each, and one per core at least."""
        return max(self.spark.sparkContext.defaultParallelism, -(-rows.count() // each))

    def _lines(self, orders: DataFrame) -> DataFrame:
        """Dealt out by the key they are joined by: a small file is no single
        task then, and no further exchange follows."""
        lineitem = self._star("lineitem")
        lineitem = lineitem.repartition(self._parts(lineitem, LINES_PER_TASK), "l_orderkey")
        return lineitem.join(orders, lineitem["l_orderkey"] == orders["o_orderkey"])

    def _derive(self, name: str) -> DataFrame:
        def bound(df: DataFrame, columns: dict[str, str]) -> DataFrame:
            return df.selectExpr(*[f"{expression} as {column}" for column, expression in columns.items()])

        if name == "provider":
            return bound(self._star("customer"), PROVIDER)
        if name == "location":
            return bound(self._star("supplier"), LOCATION)
        if name == "chart":
            return bound(self._lines(self._star("orders")), CHART)
        if name == "registry":
            return bound(self._star("customer"), REGISTRY)
        if name == "registry_file":
            people = self._star("customer")
            return bound(people.repartition(self._parts(people, WIDE_ROWS_PER_TASK)), REGISTRY_FILE)
        if name == "deactivation":
            return bound(self._star("customer").where(DEACTIVATED), DEACTIVATION)
        people = bound(self._star("customer"), PROVIDER).select("Id", "Project_Name__c")
        # Orders, not their many more lines, move to the customer.
        orders = self._star("orders")
        lines = self._lines(orders.join(people, orders["o_custkey"] == people["Id"]))
        return bound(lines, REGIONAL_JUNCTION if name == "regional_junction" else JUNCTION)

    def _table(self, name: str) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in self._written:
            path = scratch_folder(self.spark, f"table-{name}")
            derived = self._derive(name)
            with shuffling(self.spark, self._star("lineitem").count() if name in MADE_OF_LINES else 0):
                derived.write.parquet(path)
            self._written[key] = path, derived.schema
        path, schema = self._written[key]
        return self.spark.read.schema(schema).parquet(path)

    @property
    def provider(self) -> DataFrame:
        return self._table("provider")

    @property
    def location(self) -> DataFrame:
        return self._table("location")

    @property
    def junction(self) -> DataFrame:
        return self._table("junction")

    @property
    def regional_junction(self) -> DataFrame:
        return self._table("regional_junction")

    @property
    def charts(self) -> DataFrame:
        return self._table("chart")

    @property
    def registry(self) -> DataFrame:
        return self._table("registry")

    @property
    def registry_file(self) -> DataFrame:
        """All 329 columns in file order."""
        return self._table("registry_file")

    @property
    def deactivation(self) -> DataFrame:
        return self._table("deactivation")
