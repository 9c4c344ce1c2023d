"""Cleaning of single columns: expressions that never fail on bad values (null instead)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mask_email(c: Column) -> Column:
    """First letter and domain of an address; text without @ stays."""
    domain = F.element_at(F.split(c, "@", -1), 2)
    return F.when(c.contains("@"), F.concat(F.substring(c, 1, 1), F.lit("***@"), domain)).otherwise(c)


def clean_decimal(c: Column, precision: int = 38, scale: int = 2) -> Column:
    """A number out of text with signs of currency or grouping."""
    digits = F.regexp_replace(c.cast("string"), r"[^0-9.\-]", "")
    return F.nullif(digits, F.lit("")).try_cast(f"decimal({precision},{scale})")


def parse_mixed_date(c: Column, excel_epoch: str = "1899-12-30") -> Column:
    """A date from a spreadsheet's day number or any of several spellings, the first that fits."""
    text = F.trim(c.cast("string"))
    days = F.floor(text.try_cast("double")).cast("int")
    stamp = lambda x, pattern: F.try_to_timestamp(x, F.lit(pattern)).cast("date")
    return (
        F.when(text.rlike(r"^\d{1,7}(\.\d+)?$"), F.date_add(F.lit(excel_epoch).cast("date"), days))
        .when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), stamp(text, "y-M-d"))
        .when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d"), stamp(F.regexp_replace(F.regexp_replace(text, r"\.\d+$", ""), "T", " "), "y-M-d H:mm:ss"))
        .when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{4} \d"), stamp(text, "d/M/y H:mm:ss"))
        .when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), stamp(text, "d/M/y"))
        .when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{2}$"), stamp(F.regexp_replace(text, r"/(\d{2})$", "/20$1"), "d/M/y"))
        .when(text.rlike(r"^\d{4}/\d{1,2}/\d{1,2}$"), stamp(text, "y/M/d"))
    )


def clean_uk_postcode(c: Column) -> Column:
    """Upper case, one space before the last three signs."""
    return F.regexp_replace(F.upper(F.trim(c)), r"^([A-Z0-9]+?)\s*([0-9][A-Z]{2})$", "$1 $2")


#: Titles before a name; forms of companies, in the order in which they are taken off.
TITLES = ["Mr", "Mrs", "Miss", "Ms", "Dr", "Prof", "Sir", "Lady", "Lord"]
COMPANY_FORMS = ["LIMITED", "LTD", "LLP", "PLC", "INC"]


def clean_contact_name(c: Column) -> Column:
    """'Last, First' becomes 'First Last'; of 'Company - Name' the name; titles go; single spaces."""
    halves = F.split(c, ",")
    turned = F.concat_ws(" ", *[F.trim(F.try_element_at(halves, F.lit(i))) for i in (2, 1)])
    name = F.when(c.contains(","), turned).otherwise(F.trim(F.element_at(F.split(c, " - "), -1)))
    return F.regexp_replace(F.regexp_replace(name, rf"^({'|'.join(TITLES)})\.?\s+", ""), r"\s+", " ")


def clean_company_name(c: Column, remove_legal_suffix: bool = True) -> Column:
    """Upper case, single spaces, AND for &, without the company's legal form."""
    name = F.regexp_replace(F.trim(F.upper(c)), r"\s+", " ")
    for form in COMPANY_FORMS if remove_legal_suffix else []:
        name = F.regexp_replace(name, rf" {form}\.?$", "")
    return F.regexp_replace(name, " & ", " AND ")


def sanitize_name(c: Column) -> Column:
    """Lower case with single underscores between letters and digits; null if nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9]+", "_"), F.lit("_")), F.lit(""))


#: Names of months as file names have them.
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]


def extract_period(c: Column) -> Column:
    """Period yymmdd in a file name: eight digits, six, a month's name with a year, or yymm; the first that is a date."""
    text = F.lower(c)
    names = "|".join([*MONTHS, "sept", *(m[:3] for m in MONTHS)])

    def found(pattern: str, group: int = 1) -> Column:
        return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))

    def date(digits: Column) -> Column:
        return F.date_format(F.try_to_timestamp(digits, F.lit("yyyyMMdd")), "yyMMdd")

    def of_month(pattern: str, year: int, month: int) -> Column:
        number = F.coalesce(*[F.when(found(pattern, month).startswith(m[:3]), F.lit(f"{i:02d}")) for i, m in enumerate(MONTHS, 1)])
        return F.concat(F.substring(found(pattern, year), 3, 2), number, F.lit("01"))

    return F.coalesce(
        date(found(r"(?<!\d)(\d{8})(?!\d)")),
        date(F.concat(F.lit("20"), found(r"\b(\d{6})\b"))),
        of_month(rf"\b({names})[\s_-]*(20\d\d)\b", 2, 1),
        of_month(rf"\b(20\d\d)[\s_-]*({names})\b", 1, 2),
        F.concat(found(r"\b(\d\d(?:0[1-9]|1[0-2]))\b"), F.lit("01")),
    )


def excluded(name: Column, patterns: Column) -> Column:
    """Whether a name holds any of the comma-separated patterns; empty ones don't count."""
    return F.coalesce(F.exists(F.split(F.lower(patterns), ","), lambda p: (F.trim(p) != "") & F.lower(name).contains(F.trim(p))), F.lit(False))


def strip_date_tokens(c: Column) -> Column:
    """A name without runs of four to eight digits and names of months."""
    names = "|".join(f"{m}|{m[:3]}" for m in MONTHS)
    plain = F.regexp_replace(F.regexp_replace(F.lower(c), r"\d{4,8}", " "), rf"(?<![a-z])({names})(?![a-z])", " ")
    return F.trim(F.regexp_replace(plain, r"[\s_\-]+", " "))
