"""Column expressions for text: accents, slugs, tokens, dates, measures. All stay on the JVM."""

from __future__ import annotations

from unicodedata import combining, normalize

from pyspark.sql import Column
from pyspark.sql import functions as F


def _plain_letters() -> tuple[str, str]:
    """Latin letters with marks and the letters without, by the rule of canonical decomposition."""
    pairs = []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        bare = "".join(c for c in normalize("NFD", chr(code)) if not combining(c))
        if len(bare) == 1 and bare != chr(code):
            pairs.append((chr(code), bare))
    pairs += [("Đ", "D"), ("đ", "d"), ("Ð", "D"), ("ð", "d")]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_MARKED, _BARE = _plain_letters()


def deaccent(c: Column) -> Column:
    """Letters without their marks, one for one: offsets in a composed text stay valid."""
    return F.translate(c, _MARKED, _BARE)


def folded(c: Column) -> Column:
    """Lower case, no marks, combining ones neither."""
    return F.regexp_replace(deaccent(F.lower(c)), r"\p{M}+", "")


def slug(c: Column) -> Column:
    """Folded, every run of other characters one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(folded(c), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def tokens(c: Column) -> Column:
    """The folded words and numbers, in order."""
    return F.regexp_extract_all(folded(c), F.lit("[a-z0-9]+"), F.lit(0))


def iso_date(c: Column) -> Column:
    """The first d/m/yyyy or yyyy-mm-dd in ``c`` as yyyy-mm-dd; null if there is none or no such day."""
    iso = F.try_to_date(F.nullif(F.regexp_extract(c, r"(\d{4}-\d{1,2}-\d{1,2})", 1), F.lit("")), "yyyy-M-d")
    vn = F.try_to_date(F.nullif(F.regexp_extract(c, r"(\d{1,2}/\d{1,2}/\d{4})", 1), F.lit("")), "d/M/yyyy")
    return F.date_format(F.coalesce(iso, vn), "yyyy-MM-dd")


def first_year(c: Column) -> Column:
    """The first 19xx or 20xx."""
    return F.nullif(F.regexp_extract(c, r"((?:19|20)\d{2})", 1), F.lit("")).cast("int")


def accent_share(c: Column, least: int = 200) -> Column:
    """Letters with Vietnamese marks per letter; -1 under ``least`` letters."""
    letters = F.regexp_count(c, F.lit(r"\p{L}"))
    marked = F.regexp_count(F.lower(c), F.lit("[ăâđêôơưàảãáạằẳẵắặầẩẫấậèẻẽéẹềểễếệìỉĩíịòỏõóọồổỗốộờởỡớợùủũúụừửữứựỳỷỹýỵ]"))
    return F.when(letters < least, F.lit(-1.0)).otherwise(marked / letters)


# fixed values: the type codes of document numbers
TYPE_CODES = ["QH", "UBTVQH", "NĐ", "TT", "TTLT", "QĐ", "NQ", "CT", "HD", "KH", "VBHN", "L"]


def number_parts(c: Column) -> Column:
    """A plain document number as (num, year, type_code, org_code); missing parts null.

    After the number and a year of four digits, what stands before the first dash is the type if it
    is one of TYPE_CODES, accents or not, and the rest the organisation; else all of it is the
    organisation's (a letter without a type). The assembly's number, QH and a term, is both.
    """
    part = lambda s, pattern, k: F.nullif(F.regexp_extract(s, pattern, k), F.lit(""))
    shape = r"^([0-9]+)(?:/([0-9]{4})(?=/|$))?(?:/(.+))?$"
    tail = part(c, shape, 3)
    head, rest = F.regexp_extract(tail, "^([^-]*)", 1), part(tail, "^[^-]*-(.+)$", 1)
    known = F.upper(deaccent(head)).isin(*(x.replace("Đ", "D") for x in TYPE_CODES))
    assembly = tail.rlike("^QH[0-9]*$")
    return F.struct(
        part(c, shape, 1).alias("num"),
        part(c, shape, 2).alias("year"),
        F.when(assembly, F.lit("QH")).when(known, head).alias("type_code"),
        F.when(assembly, tail).when(known, rest).otherwise(tail).alias("org_code"),
    )


def clean_page(c: Column) -> Column:
    """Unix line ends, no blanks before them, at most one empty line in a row."""
    s = F.regexp_replace(c, "\r\n?", "\n")
    s = F.regexp_replace(s, "[ \t]+\n", "\n")
    return F.regexp_replace(s, "\n{3,}", "\n\n")


def markdown_off(c: Column) -> Column:
    """Text without Markdown's emphasis, headings, code marks and link targets."""
    s = F.regexp_replace(c, r"\[([^\]\n]*)\]\([^)\n]*\)", "$1")
    s = F.regexp_replace(s, r"(?m)^#{1,6} +", "")
    return F.regexp_replace(s, r"\*\*|__|`", "")


def articles_heading_number(c: Column) -> Column:
    """The article number in "Điều 5 ..." or "điều 5"; null otherwise."""
    return F.nullif(F.regexp_extract(folded(c), r"\bdieu +(\d+)", 1), F.lit("")).cast("int")
