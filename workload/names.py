"""Names used by queries and their SQL twins alike."""

from goldkeel.functions.labels import RETRIEVAL_RULES

PROJECT_A = "BUILDING|2018|MRR|0"
CLIENT_A = "BUILDING"
PROJECT_B = "BUILDING|2018|MRR|1"
EVEN = "EVEN PROJECTS"
ODD = "ODD PROJECTS"
NPI = "1000000030"
TAXONOMY_CODES = ["207Q00001X", "207q00030x", "207Q00042X"]


def _keyword_names() -> str:
    """An expression that gives charts names made of all keywords, whole or
    within other words, in several spellings, and some that are no keyword."""
    words = [w for rule in RETRIEVAL_RULES for w in (*rule.keywords, *rule.whole)]
    words += ["Boxer", "Box Springs", "J. Doe", "Ring  central", "Mail  Room", "EM ail"]
    number = "(Provider__c * 7 + Location__c)"
    cases = " ".join(f"when {i} then '{w}'" for i, w in enumerate(words))
    name = f"(case {number} % {len(words) + 1} {cases} end)"
    return (
        f"case Location__c % 5 when 0 then {name} when 1 then upper({name}) when 2 then lower({name}) || '  ' "
        f"when 3 then 'the ' || {name} || 'x' else ' ' || {name} end"
    )


KEYWORD_NAMES = _keyword_names()

# Count columns of the chase list.
CHASE_COUNTS = [
    "charts_at_loc",
    "CountOfCharts_atLoc_byNpiTinAddPhone",
    "CountOfCharts_atLoc_byNpiAddPhone",
    "CountOfCharts_atLoc_byNpiPhone",
    "CountOfCharts_atLoc_byNpiAdd",
    "CountOfCharts_atLoc_byNpiTinAdd",
    "CountOfCharts_atLoc_byNpiTin",
    "CountOfCharts_atLoc_byNpiTinPhone",
    "CountOfCharts_atLoc_byTinAddPhone",
    "CountOfCharts_atLoc_byTinPhone",
    "CountOfCharts_atLoc_byTinAdd",
    "CountOfCharts_atLoc_byPhone",
    "CountOfCharts_atLoc_byAddress",
    "CountOfCharts_atLoc_byNpi",
    "CountOfCharts_atLoc_byTin",
]
