"""Content-hashed location ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from goldkeel.functions.text import address_lines, cleanse_phone, or_blank

# Delimiters around every hashed part.
OPEN = "#$%^&"
CLOSE = "&^%$#"

BASE_PHONE_DIGITS = 9
ADDRESS_MODES = ("lines", "full")


def content_id(*parts: Column, encoding: str = "UTF-8") -> Column:
    """Upper-case MD5 hex over the delimited parts; NULL counts as ''.

    ``encoding='UTF-16LE'`` gives the ids of a wide-character database.
    """
    wrapped = F.concat(*[F.concat(F.lit(OPEN), or_blank(p), F.lit(CLOSE)) for p in parts])
    if encoding.upper() != "UTF-8":
        wrapped = F.encode(wrapped, encoding)
    return F.upper(F.md5(wrapped))


def location_id_columns(
    address_mode: str = "lines", encoding: str = "UTF-8", strip_country: bool = False
) -> dict[str, Column]:
    """The four ids and the base phone of a location row, by output name."""
    if address_mode not in ADDRESS_MODES:
        raise ValueError(f"address_mode must be one of {ADDRESS_MODES}, not {address_mode!r}")
    if address_mode == "lines":
        street = address_lines(F.col("Address_Line_1__c"), F.col("Address_Line_2__c"))
    else:
        street = F.col("Provider_Full_Address__c")
    place = (street, F.col("City__c"), F.col("State__c"), F.col("ZIP_Code__c"))
    phone = cleanse_phone(F.coalesce(F.col("Phone_1__c"), F.col("Phone_2__c")), strip_country)
    base_phone = F.substring(or_blank(phone), 1, BASE_PHONE_DIGITS)
    return {
        "NEW_LID_ALL": content_id(*place, phone, encoding=encoding),
        "NEW_LID_ADD": content_id(*place, encoding=encoding),
        "NEW_LID_PHONE": content_id(phone, encoding=encoding),
        "base_phone": base_phone,
        "NEW_LID_ADD_BASE_PHONE": content_id(*place, base_phone, encoding=encoding),
    }
