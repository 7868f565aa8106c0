"""Labels: how a chart was retrieved, and what the registry says about an NPI."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from goldkeel.functions.text import DEFAULT_RULES, TextRules


@dataclass(frozen=True)
class RetrievalRule:
    label: str
    keywords: tuple[str, ...]
    whole: tuple[str, ...] = ()


# Keyword rules, first match wins.
RETRIEVAL_RULES = (
    RetrievalRule("SFTP", ("FTP",)),
    RetrievalRule("Mail Room", ("Mail Room", "MailRoom")),
    RetrievalRule("Fax", ("Ringcentral", "Ring central", "Vitelity")),
    RetrievalRule("E-Mail", ("EMail", "email", "E Mail", "E-Mail")),
    RetrievalRule(
        "CopyService",
        (
            "Ciox",
            "Diversified",
            "Diversified Medical Records Services",
            "DMRS",
            "Chartswap",
            "Chart swap",
            "Sharecare",
            "Share care",
            "MRO",
            "DataFile",
            "Data File",
            "Scanstat",
            "Scan stat",
            "Health",
            "Integrity Document Solutions",
            "IDS",
            "BACTES",
            "IOD",
            "STAT Imaging",
            "Imaging",
            "Chart",
            "Photostat",
            "Photo stat",
            "Midwest ROI",
            "Verisma",
            "Dynamic Document Imaging",
            "DDI",
            "Medical Records",
        ),
        whole=("BOX",),
    ),
)
NO_NAME_LABEL = "NullsOthers"
OTHER_LABEL = "Field"

# Retrieval label, its name in the per-location summary, in
# tie-break order.
RETRIEVAL_SUMMARY = (
    ("SFTP", "SFTP"),
    ("Mail Room", "MailRoom"),
    ("Fax", "Fax"),
    ("E-Mail", "eMail"),
    ("CopyService", "CopyService"),
    ("Field", "Field"),
    ("NullsOthers", "NullOthers"),
)


def retrieval_type(name: Column, rules: TextRules = DEFAULT_RULES) -> Column:
    """The label of a retrieval name that ``rules`` already folded."""
    label = F.when(name.isNull(), NO_NAME_LABEL)
    for rule in RETRIEVAL_RULES:
        hit = rules.contains_any(name, rule.keywords)
        for value in rule.whole:
            hit = hit | rules.equals(name, value)
        label = label.when(hit, rule.label)
    return label.otherwise(OTHER_LABEL)


DEACTIVATED = "De-activated"
NO_RECORD = "No Record"


def npi_status(entity_type_code: Column, missing: str = DEACTIVATED) -> Column:
    """1 is a person, 2 an organization, compared as numbers; anything else
    gets ``missing``."""
    code = F.trim(entity_type_code).try_cast("int")
    return F.when(code == 1, "Individual").when(code == 2, "Organization").otherwise(missing)
