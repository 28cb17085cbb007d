"""Queries of the training-text operators, and their SQL where SQL can express them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.llm.bpe import encode_corpus
from quillmesh.llm.canonical import map_values
from quillmesh.llm.consensus import agreement, consensus, reliability
from quillmesh.llm.leaks import find_leaks
from quillmesh.llm.names import link_organizations, link_people, pairs
from quillmesh.llm.scans import find_faults
from quillmesh.llm.stuffing import find_stuffed
from quillmesh.llm.split import heading_items, split_oversized, zone_items
from quillmesh.runtime import table

#: Folder of the public tokenizers' files.
TOKENIZERS = os.environ.get("QUILLMESH_TOKENIZERS", "/opt/tokenizers")
# fixed value: the pre-tokenizer of the byte-level vocabularies
BYTE_BPE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document's text."""
    return encode_corpus(table(spark, folder, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json", BYTE_BPE_PATTERN)


HEADING_LIMIT, HEADING_OVERLAP = 200, 20
ZONE_LIMIT, ZONE_OVERLAP = 3000, 200


def _oversized(spark: SparkSession, folder: str) -> DataFrame:
    headings = heading_items(table(spark, folder, "articles"), HEADING_LIMIT)
    zones = zone_items(table(spark, folder, "parts"), table(spark, folder, "docs"), ZONE_LIMIT)
    return split_oversized(headings, HEADING_LIMIT, HEADING_OVERLAP).unionByName(split_oversized(zones, ZONE_LIMIT, ZONE_OVERLAP))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Headings and zones above their limit."""
    return _oversized(spark, folder).select("rec_id", "part_index", "item_kind", "item_name").distinct()


def p3_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces of every heading and zone above its limit."""
    return _oversized(spark, folder).select(
        "rec_id", "part_index", "item_kind", "item_name", F.posexplode("pieces").alias("piece_no", "piece")
    )


def _entries(spark: SparkSession, folder: str) -> DataFrame:
    names = (F.col(c).alias(a) for c, a in zip(("org_id", "org_name", "short_code"), ("code", "name", "short")))
    return table(spark, folder, "organizations").select(*names)


def _people(spark: SparkSession, folder: str) -> DataFrame:
    return link_people(table(spark, folder, "chuan").select(F.col("signer_id").alias("id"), F.col("unit_code").alias("unit"), F.col("full_name").alias("name")))


def _organizations(spark: SparkSession, folder: str) -> DataFrame:
    return link_organizations(table(spark, folder, "aliases_seed").select(F.col("alias_id").alias("id"), F.col("alias").alias("name")), _entries(spark, folder))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of rows that mean the same signer or the same organisation."""
    people, orgs = pairs(_people(spark, folder), "unit", "entity"), pairs(_organizations(spark, folder), "entity")
    return people.select(F.lit("chuan").alias("tbl"), "id_a", "id_b").unionByName(orgs.select(F.lit("aliases_seed").alias("tbl"), "id_a", "id_b"))


def p2_links(spark: SparkSession, folder: str) -> DataFrame:
    """The entity of every row that names one, with the score it was linked by; under 1 for a short name that fits several."""
    people = _people(spark, folder).select(F.lit("chuan").alias("tbl"), "id", F.concat_ws("/", "unit", "entity").alias("entity"), F.round("score", 6).alias("score"))
    orgs = _organizations(spark, folder).select(F.lit("aliases_seed").alias("tbl"), "id", "entity", F.lit(1.0).alias("score"))
    return people.unionByName(orgs)


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """The organisation and the document type meant by each typed value, or NONE."""
    docs = table(spark, folder, "docs")
    out = None
    for field, name, cols in (
        ("org_name", "organizations", ("org_id", "org_name", "short_code")),
        ("doc_type", "document_types", ("type_code", "type_name", "type_code")),
    ):
        reference = table(spark, folder, name).select(*(F.col(c).alias(a) for c, a in zip(cols, ("code", "name", "short"))))
        values = docs.select("rec_id", F.lit(field).alias("field_name"), F.col(field).alias("value"))
        found = map_values(values, reference)
        out = found if out is None else out.unionByName(found)
    return out


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """The right label and number of every item of the annotation sheets."""
    return consensus(table(spark, folder, "phieu_gan"))


def p6_agreement(spark: SparkSession, folder: str) -> DataFrame:
    """Chance-corrected agreement of the annotators."""
    return agreement(table(spark, folder, "phieu_gan"))


def p6_reliability(spark: SparkSession, folder: str) -> DataFrame:
    """Expected accuracy of every annotator."""
    return reliability(table(spark, folder, "phieu_gan"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold a passage of a test item's question or answer."""
    held = table(spark, folder, "eval_items")
    items = held.select("item_id", F.col("cau_hoi").alias("text")).union(held.select("item_id", "dap_an"))
    return find_leaks(table(spark, folder, "documents"), items)


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that are pages of keywords, links, tags or offers."""
    return find_stuffed(table(spark, folder, "documents"))


def _scans(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "docs").select(F.lit("docs").alias("tbl"), F.col("rec_id").alias("row_id"), F.col("raw_txt").alias("text"))
    evidence = table(spark, folder, "article_evidence").select(F.lit("article_evidence").alias("tbl"), F.col("evidence_id").alias("row_id"), "text")
    return docs.unionByName(evidence)


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Faulty lines of scanned texts."""
    return find_faults(_scans(spark, folder))


def p7_text(spark: SparkSession, folder: str) -> DataFrame:
    """The repaired running text of every scanned text."""
    return find_faults(_scans(spark, folder), text_too=True)


QUERIES = {f.__name__: f for f in (p2_found, p2_links, p3_found, p3_pieces, p5_found, p6_found, p6_agreement, p6_reliability, p7_found, p7_text, p8_ids, p9_found, p10_found)}
_TRIM = "regexp_replace(nfc_normalize({0}), '^[\\s\\x0b\\p{{Z}}\\x{{85}}]+|[\\s\\x0b\\p{{Z}}\\x{{85}}]+$', '', 'g')"
ORACLE: dict[str, str] = {
    "p3_found": f"""WITH j AS (SELECT rec_id, part_index, CASE WHEN json_valid(zones) THEN
          CASE WHEN json_type(zones) = 'VARCHAR' THEN zones->>'$' ELSE zones END END AS z FROM parts),
      k AS (SELECT rec_id, part_index, z, unnest(json_keys(z)) AS name FROM j WHERE z IS NOT NULL AND json_type(z) = 'OBJECT'),
      v AS (SELECT rec_id, part_index, name, json_extract(z, '$."' || name || '"') AS v FROM k),
      s AS (SELECT rec_id, part_index, name,
          try_cast(CASE json_type(v) WHEN 'ARRAY' THEN v->>0 WHEN 'OBJECT' THEN v->>'start' ELSE split_part(v->>'$', '-', 1) END AS INT) AS a,
          try_cast(CASE json_type(v) WHEN 'ARRAY' THEN v->>1 WHEN 'OBJECT' THEN v->>'end' ELSE split_part(v->>'$', '-', 2) END AS INT) AS b FROM v)
      SELECT DISTINCT s.rec_id, part_index, 'zone' AS item_kind, name AS item_name FROM s JOIN docs ON docs.rec_id = s.rec_id
       WHERE a >= 0 AND b > a AND length({_TRIM.format('substring(raw_txt, a + 1, b - a)')}) > {ZONE_LIMIT}
      UNION SELECT rec_id, part_index, 'heading', CAST(seq AS VARCHAR) FROM articles
       WHERE length({_TRIM.format('heading')}) > {HEADING_LIMIT}""",
}
