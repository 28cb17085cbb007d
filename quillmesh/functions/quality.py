"""Column expressions for typed titles, statuses, authority and the quality of page texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmesh.functions.text import folded, iso_date

# fixed values: authority levels by kind of organisation, and by kind of document for the rest; 6 is the highest
ORG_LEVELS = {"quoc_hoi": 5, "chinh_phu": 4, "thu_tuong": 3, "bo_nganh": 3, "dai_hoc_vung": 2, "truong_thanh_vien": 1}
TYPE_LEVELS = {"hien phap": 6, "luat": 5, "phap lenh": 5, "nghi dinh": 4, "thong tu": 3, "thong tu lien tich": 3}
_LOOKALIKE = ("lI|oOSBZ", "11100582")


def _lookup(key: Column, table: dict[str, int]) -> Column:
    """The value of a key, null for others."""
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), key)


def authority_level(doc_type: Column, org_type: Column) -> Column:
    """(level, note): the constitution's, else that of the issuer's kind, else that of the document's, else null; the note says which.

    The issuer goes before the kind of document, since every level issues decisions.
    """
    kind, issuer = _lookup(folded(doc_type), TYPE_LEVELS), _lookup(org_type, ORG_LEVELS)
    top = F.when(kind == 6, kind)
    note = F.when(top.isNotNull() | issuer.isNotNull(), "onto").when(kind.isNotNull(), "onto: theo-loai").otherwise("khong-suy-duoc")
    return F.struct(F.coalesce(top, issuer, kind).alias("level"), note.alias("note"))


def validity(text: Column, effective: Column, as_of: Column) -> Column:
    """(status, expiry) from a typed status such as "Hết hiệu lực 01/01/2024" and the effective date, as of a given ISO date."""
    t, date = folded(text), iso_date(text)
    status = (
        F.when(t.contains("het hieu luc") & (date.isNull() | (date <= as_of)), "HET_HIEU_LUC")
        .when(t.contains("chua co hieu luc") | (effective > as_of), "CHUA_HIEU_LUC")
        .when(t.contains("hieu luc") | effective.isNotNull(), "CON_HIEU_LUC")
    )
    return F.struct(status.alias("status"), F.when(t.contains("het hieu luc"), date).alias("expiry"))


def digits(c: Column) -> Column:
    """Letters that look like digits as digits; null if something else is left."""
    out = F.translate(c, *_LOOKALIKE)
    return F.when(out.rlike("^[0-9]+$"), out)


def position_rank(c: Column) -> Column:
    """head, acting, deputy or other for a typed position; "KT." before it means a deputy signs."""
    t = folded(c)
    return (
        F.when(t.rlike(r"^kt\b|\bky thay\b|\bpho "), "deputy").when(t.rlike(r"^quyen |\bphu trach\b"), "acting").when(t.rlike("truong|giam doc|chu tich|chanh"), "head").otherwise("other")
    )


def academic_titles(c: Column) -> Column:
    """The titles in "PGS. TS", "ths", ... in their usual order, joined by dots; null if there is none."""
    known = ["GS", "PGS", "TS", "ThS", "KS", "CN"]
    found = F.transform(F.regexp_extract_all(F.upper(c), F.lit("PGS|GS|THS|TS|KS|CN"), F.lit(0)), lambda x: F.when(x == "THS", "ThS").otherwise(x))
    return F.nullif(F.array_join(F.filter(F.array(*map(F.lit, known)), lambda k: F.array_contains(found, k)), "."), F.lit(""))


def sanitize(c: Column, most: int = 120) -> Column:
    """A file name: no characters that file systems refuse, single blanks, at most ``most`` characters."""
    s = F.regexp_replace(c, r'[\\/:*?"<>|\x00-\x1f]+', " ")
    return F.rtrim(F.substring(F.trim(F.regexp_replace(s, r"\s+", " ")), 1, most))


def page_gate(text: Column, pages: Column, least: int = 200, per_page: int = 150) -> Column:
    """ok, short, code or thin: whether a page text is worth keeping."""
    code = F.regexp_count(text, F.lit(r"(?m)^\s*(?:def |import |print\(|return\b|```)"))
    return F.when(F.coalesce(F.length(text), F.lit(0)) < least, "short").when(code >= 3, "code").when((pages > 0) & (F.length(text) < per_page * pages), "thin").otherwise("ok")
