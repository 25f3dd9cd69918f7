"""Identifier formats, check digits and extraction from free text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Identifier formats.
ISI_FORMAT = r"^A19\d{2}[A-Z\d]{5}\d{5}$|^000\d{12}$|^001\d{12}$"
DOI_FORMAT = r"^10[.]"
ORCID_FORMAT = r"^([0-9]{4})+(-)+([0-9]{4})+(-)+([0-9]{4})+(-)+([0-9]{3}[0-9Xx]{1})$"
STAFF_ID_FORMAT = r"^u1[a-z0-9]{6}$"
TEMPORARY_ID_FORMAT = r"^PI\d+|P\d+|pi\d+|p\d+|Pi\d+|PI \d+|-"
AUTHORITY_ID_FORMAT = r"^[a-z0-9]{4}$"
SCOPUS_FORMAT = r"^2-s2\.0-\d{10,11}$"
ISSN_FORMAT = r"^\d{4}-?\d{3}(X|x|\d)$"
ORCID_IN_TEXT = r"\d{4}-\d{4}-\d{4}-\d{3}[1-9Xx]"
PREPRINT_DOI = r"^10.1101|^10.48550|^10.2139|^10.31219|^10.20944|^10.21203"

# VAT country codes.
VAT_COUNTRIES = (
    "AT BE BG CY CZ DE DK EE EL ES EU FI FR HR HU IE IT LT LU LV MT NL PL PT RO SE SI SK XI"
).split()


def _check_sum(bare: Column, length: int, weight) -> Column:
    """Weighted sum of the digits; an X in the last place counts as ten.

    Only evaluated on texts whose format has been tested, so a digit is its
    character code less 48."""
    total = F.lit(0)
    for i in range(1, length):
        total = total + (F.ascii(F.substr(bare, F.lit(i), F.lit(1))) - 48) * weight(i)
    last = F.ascii(F.substr(bare, F.lit(length), F.lit(1)))
    return total + F.when(last > 57, F.lit(10)).otherwise(last - 48) * weight(length)


def _checked(col: Column, form: str, length: int, weight, modulus: int) -> Column:
    bare = F.replace(col, F.lit("-"), F.lit(""))
    sound = F.when(bare.rlike(form), _check_sum(bare, length, weight) % modulus == 0)
    return F.coalesce(sound, F.lit(False))


def issn_ok(col: Column) -> Column:
    """ISSN check digit: weights 8 to 1, sum divisible by 11. Malformed is false."""
    return _checked(col, r"^\d{7}[\dXx]$", 8, lambda i: 9 - i, 11)


def isbn10_ok(col: Column) -> Column:
    """ISBN-10 check digit: weights 10 to 1, sum divisible by 11."""
    return _checked(col, r"^\d{9}[\dXx]$", 10, lambda i: 11 - i, 11)


def isbn13_ok(col: Column) -> Column:
    """ISBN-13 check digit: weights 1, 3 alternating, sum divisible by 10."""
    return _checked(col, r"^\d{13}$", 13, lambda i: 1 if i % 2 else 3, 10)


def orcid_checksum_ok(col: Column) -> Column:
    """ISO 7064 11-2 check over the 16 characters, for the strict ORCID check."""
    bare = F.upper(F.regexp_replace(col, "-", ""))
    total = F.lit(0)
    for i in range(1, 16):
        total = (total + F.substr(bare, F.lit(i), F.lit(1)).try_cast("int")) * 2
    check = (12 - total % 11) % 11
    last = F.substr(bare, F.lit(16), F.lit(1))
    given = F.when(last == "X", F.lit(10)).otherwise(last.try_cast("int"))
    return F.coalesce(bare.rlike(r"^\d{15}[\dX]$") & (check == given), F.lit(False))


def first_hit(col: Column, pattern: str, group: int = 0) -> Column:
    """First match of the pattern, missing when there is none."""
    return F.nullif(F.regexp_extract(col, pattern, group), F.lit(""))


def orcid_in_text(col: Column) -> Column:
    return first_hit(col, ORCID_IN_TEXT)


def staff_id_in_text(col: Column, kind: str = "any") -> Column:
    """Staff or unit id inside text: ``any``, ``person`` (u1) or ``unit`` (u2)."""
    lead = {"any": "u[12]", "person": "u1", "unit": "u2"}[kind]
    return first_hit(col, lead + "[a-z0-9]{6}")


def vat_parts(col: Column) -> Column:
    """Struct of the parts of a VAT number."""
    country = F.regexp_replace(col, r"(^[A-Z]{2}).*$", "$1")
    number = F.regexp_replace(col, r"^[A-Z]{2}(\d{12})$", "$1")
    return F.struct(
        (F.length(col) == 14).alias("valid"),
        country.alias("country"),
        country.isin(VAT_COUNTRIES).alias("is_eu"),
        (country == "SE").alias("is_swe"),
        number.alias("vat_number"),
        F.substr(number, F.lit(1), F.lit(10)).alias("swe_org"),
    )


def typed_identifier(col: Column) -> Column:
    """``PID:12`` style text to a struct of upper-case kind and value."""
    pattern = r"^(PID|DOI|PMID|ISI):(.+)$"
    return F.struct(
        first_hit(col, pattern, 1).alias("kind"), first_hit(col, pattern, 2).alias("value")
    )


def grant_number(col: Column) -> Column:
    """Keep only the ``yyyy-nnnnn`` number when the text contains one."""
    return F.regexp_replace(col, r"^.*(\d{4}-\d{4,5}).*$", "$1")


def before_last_underscore(col: Column) -> Column:
    return F.regexp_replace(col, r"^(.*)_\w+$", "$1")
