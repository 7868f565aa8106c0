"""Schemas of the registry file, the deactivation list and the logical tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the public registry file, outside its numbered blocks.
REGISTRY_BASE = """
NPI Entity_Type_Code Replacement_NPI Employer_Identification_Number
Provider_Organization_Name Provider_Last_Name Provider_First_Name Provider_Middle_Name
Provider_Name_Prefix_Text Provider_Name_Suffix_Text Provider_Credential_Text
Provider_Other_Organization_Name Provider_Other_Organization_Name_Type_Code
Provider_Other_Last_Name Provider_Other_First_Name Provider_Other_Middle_Name
Provider_Other_Name_Prefix_Text Provider_Other_Name_Suffix_Text Provider_Other_Credential_Text
Provider_Other_Last_Name_Type_Code
Provider_First_Line_Business_Mailing_Address Provider_Second_Line_Business_Mailing_Address
Provider_Business_Mailing_Address_City_Name Provider_Business_Mailing_Address_State_Name
Provider_Business_Mailing_Address_Postal_Code Provider_Business_Mailing_Address_Country_Code
Provider_Business_Mailing_Address_Telephone_Number Provider_Business_Mailing_Address_Fax_Number
Provider_First_Line_Business_Practice_Location_Address Provider_Second_Line_Business_Practice_Location_Address
Provider_Business_Practice_Location_Address_City_Name Provider_Business_Practice_Location_Address_State_Name
Provider_Business_Practice_Location_Address_Postal_Code Provider_Business_Practice_Location_Address_Country_Code
Provider_Business_Practice_Location_Address_Telephone_Number Provider_Business_Practice_Location_Address_Fax_Number
Provider_Enumeration_Date Last_Update_Date NPI_Deactivation_Reason_Code NPI_Deactivation_Date
NPI_Reactivation_Date Provider_Gender_Code
Authorized_Official_Last_Name Authorized_Official_First_Name Authorized_Official_Middle_Name
Authorized_Official_Title_or_Position Authorized_Official_Telephone_Number
""".split()
REGISTRY_TAXONOMY = (
    "Healthcare_Provider_Taxonomy_Code",
    "Provider_License_Number",
    "Provider_License_Number_State_Code",
    "Healthcare_Provider_Primary_Taxonomy_Switch",
)
REGISTRY_IDENTIFIER = (
    "Other_Provider_Identifier",
    "Other_Provider_Identifier_Type_Code",
    "Other_Provider_Identifier_State",
    "Other_Provider_Identifier_Issuer",
)
REGISTRY_TAIL = """
Is_Sole_Proprietor Is_Organization_Subpart Parent_Organization_LBN Parent_Organization_TIN
Authorized_Official_Name_Prefix_Text Authorized_Official_Name_Suffix_Text Authorized_Official_Credential_Text
""".split()
REGISTRY_DATES = (
    "Provider_Enumeration_Date",
    "Last_Update_Date",
    "NPI_Deactivation_Date",
    "NPI_Reactivation_Date",
)
TAXONOMY_SLOTS = 15
IDENTIFIER_SLOTS = 50


def registry_columns() -> list[str]:
    """The 329 column names in file order."""
    return [
        *REGISTRY_BASE,
        *[f"{name}_{i}" for i in range(1, TAXONOMY_SLOTS + 1) for name in REGISTRY_TAXONOMY],
        *[f"{name}_{i}" for i in range(1, IDENTIFIER_SLOTS + 1) for name in REGISTRY_IDENTIFIER],
        *REGISTRY_TAIL,
        *[f"Healthcare_Provider_Taxonomy_Group_{i}" for i in range(1, TAXONOMY_SLOTS + 1)],
    ]


def registry_schema() -> T.StructType:
    """All text but the dates; codes and zips keep their leading zeros."""
    dates = set(REGISTRY_DATES)
    return T.StructType(
        [T.StructField(c, T.DateType() if c in dates else T.StringType()) for c in registry_columns()]
    )


def deactivation_schema() -> T.StructType:
    return T.StructType(
        [T.StructField("NPI", T.StringType()), T.StructField("NPI_Deactivation_Date", T.DateType())]
    )
