"""The property graph of the regulation store: one frame per node label and edge type.

``PropertyGraph.of(spark, folder)`` builds the frames lazily and keeps each, once asked for, in the
shared checkpoint folder, so later queries of the session start from loaded tables, as they would
from a graph store. ``VIEWS_SQL`` states the same frames for DuckDB.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmesh.functions.numbers import PLAIN_NUMBER_SQL, plain_number
from quillmesh.functions.text import iso_date, slug
from quillmesh.runtime import BROADCAST_ROWS, checkpoint_dir, cut, maybe_broadcast, table

_LOADED: dict[tuple[str, str], PropertyGraph] = {}
CITING = ("BASED_ON", "REFERENCES", "REPLACES", "AMENDS", "REPEALS")
VIEWS = ("document", "org", "issued_by", "person", "signed_by", "topic", "applies_to", "content", "article", "edge", "mention")


class PropertyGraph:
    """Frames by label: see VIEWS."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @staticmethod
    def of(spark: SparkSession, folder: str) -> PropertyGraph:
        checkpoint_dir(spark)
        key = (spark.sparkContext.applicationId, folder)
        if key not in _LOADED:
            _LOADED[key] = PropertyGraph(spark, folder)
        return _LOADED[key]

    def _table(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, name)

    @cached_property
    def _latest(self) -> DataFrame:
        """Of the crawls of a number the one that stands: a real one before a stub, then the latest."""
        by = Window.partitionBy("doc_key").orderBy("is_stub", F.col("crawled_at").desc_nulls_last(), F.col("rec_id").desc())
        return self._table("docs").where("doc_key is not null").withColumn("nth", F.row_number().over(by)).where("nth = 1")

    @cached_property
    def document(self) -> DataFrame:
        """Real documents, framework laws and stubs; a cited number that nothing else has is a stub too."""
        real = self._latest.select(
            "doc_key", "title", "doc_type", "normative_type", "status",
            iso_date(F.col("issue_date")).alias("issue_date"),
            iso_date(F.col("effective_date")).alias("effective_date"),
            F.col("authority_level").alias("level"), F.col("is_stub").cast("int").alias("is_stub"), "rec_id",
        )
        none = lambda kind, name: F.lit(None).cast(kind).alias(name)
        seeds = self._table("docs_seed").join(real.where("is_stub = 0").select("doc_key"), "doc_key", "left_anti").select(
            "doc_key", "title", "doc_type", none("string", "normative_type"), F.lit("CON_HIEU_LUC").alias("status"),
            iso_date(F.col("issue_date")).alias("issue_date"), none("string", "effective_date"), F.lit(1).alias("level"), F.lit(0).alias("is_stub"), none("bigint", "rec_id"),
        )
        known = real.join(seeds.select("doc_key"), "doc_key", "left_anti").unionByName(seeds)
        cited = self.edge.select(F.col("dst").alias("doc_key")).union(self.edge.select("src")).distinct()
        missing = cited.join(known.select("doc_key"), "doc_key", "left_anti").select(
            "doc_key", *(none(t, c) for c, t in known.dtypes if c not in ("doc_key", "is_stub", "rec_id")), F.lit(1).alias("is_stub"), none("bigint", "rec_id")
        )
        return cut(known.unionByName(missing))

    @cached_property
    def org(self) -> DataFrame:
        return cut(self._table("organizations").coalesce(1))

    @cached_property
    def issued_by(self) -> DataFrame:
        """The issuer by the number's organisation code: its last part, else the first after the slash."""
        key = F.col("doc_key")
        codes = maybe_broadcast(self.org.select("org_id", "short_code"))
        d = self.document.select("doc_key", F.regexp_extract(key, "([^/-]+)$", 1).alias("tail"), F.regexp_extract(key, "/([^/-]+)-[^/-]+$", 1).alias("head"))
        a, b = codes.select(F.col("org_id").alias("o1"), F.col("short_code").alias("tail")), codes.select(F.col("org_id").alias("o2"), F.col("short_code").alias("head"))
        return cut(d.join(a, "tail", "left").join(b, "head", "left").select("doc_key", F.coalesce("o1", "o2").alias("org_id")).where("org_id is not null"))

    @cached_property
    def _signatures(self) -> DataFrame:
        return self._table("chuan").where("full_name is not null and trim(full_name) <> ''").dropDuplicates(["signer_id"])

    @cached_property
    def signed_by(self) -> DataFrame:
        return cut(self._signatures.select(F.col("doc_key"), slug(F.col("full_name")).alias("person_id")).where("person_id <> ''").distinct())

    @cached_property
    def person(self) -> DataFrame:
        """Names that fold alike are one person: first name and title by order of the rows, all positions."""
        rows = self._signatures.withColumn("person_id", slug(F.col("full_name"))).where("person_id <> ''")
        return cut(
            rows.groupBy("person_id").agg(
                F.min_by("full_name", "signer_id").alias("full_name"),
                F.min_by("academic_title", F.when(F.col("academic_title").isNotNull(), F.col("signer_id"))).alias("academic_title"),
                F.array_sort(F.array_distinct(F.flatten(F.collect_list("positions")))).alias("positions"),
            )
        )

    @cached_property
    def topic(self) -> DataFrame:
        topics = F.explode(F.from_json("topics", "array<string>"))
        return cut(self._latest.where("is_stub = 0").select("doc_key", topics.alias("topic")).distinct())

    @cached_property
    def applies_to(self) -> DataFrame:
        """The units in which a document is signed are those it applies to."""
        return cut(self._table("chuan").where("unit_code is not null").select("doc_key", F.col("unit_code").alias("target_group")).distinct())

    @cached_property
    def content(self) -> DataFrame:
        """Attached parts are normative contents of their document; they have its status."""
        docs = self._latest.where("is_stub = 0").select("rec_id", "status", "normative_type")
        parts = self._table("parts").where("kind = 'attached'").dropDuplicates(["rec_id", "part_index"])
        return cut(
            parts.join(docs, "rec_id").select(
                F.concat("doc_key", F.lit("#nd"), "part_index").alias("content_id"), "doc_key", "title", F.col("normative_type").alias("content_type"), "status", "part_index"
            )
        )

    @cached_property
    def article(self) -> DataFrame:
        """Articles with their text; those of attached parts belong to the content."""
        docs = self._latest.where("is_stub = 0").select("rec_id", "raw_txt")
        arts = self._table("articles").dropDuplicates(["rec_id", "part_index", "seq"]).join(docs, "rec_id")
        text = F.substring("raw_txt", F.col("start_pos") + 1, F.greatest(F.col("end_pos") - F.col("start_pos"), F.lit(0)))
        return cut(
            arts.select(
                F.concat_ws("#", "doc_key", F.col("part_index").cast("string"), F.col("seq").cast("string")).alias("article_id"),
                "doc_key",
                F.when(F.col("part_index") > 0, F.concat("doc_key", F.lit("#nd"), "part_index")).alias("content_id"),
                F.col("article_number").alias("number"), "seq", "heading", F.col("is_thi_hanh").alias("implements"), text.alias("text"),
            )
        )

    @cached_property
    def edge(self) -> DataFrame:
        """Citations as edges, one per (src, rel, dst), with hits, least zone and article, and a context; no loops."""
        c = self._table("citations").dropDuplicates(["id"])
        rows = c.select(
            plain_number(F.col("doc_key")).alias("src"), F.col("relation").alias("rel"), plain_number(F.col("target_key")).alias("dst"),
            "zone_name", "article_number", "context", "in_thi_hanh",
        ).where(F.col("rel").isin(*CITING) & F.col("src").isNotNull() & F.col("dst").isNotNull() & (F.col("src") != F.col("dst")))
        return cut(
            rows.groupBy("src", "rel", "dst").agg(
                F.count(F.lit(1)).alias("hits"), F.min("zone_name").alias("zone"), F.min("article_number").alias("target_article"), F.min("context").alias("context"), F.max("in_thi_hanh").alias("in_thi_hanh")
            )
        )

    @cached_property
    def mention(self) -> DataFrame:
        """The organisations whose names stand in a document's text, found in one scan by an alternation of the list."""
        names = self.org.select("org_name").where("org_name <> ''").orderBy(F.length("org_name").desc(), "org_name").limit(BROADCAST_ROWS + 1).collect()
        if len(names) > BROADCAST_ROWS:
            raise ValueError(f"more than {BROADCAST_ROWS} names are too many for one pattern")
        pattern = "(" + "|".join(re.escape(r["org_name"]) for r in names) + ")"
        found = self._latest.where("is_stub = 0").select("doc_key", F.explode(F.regexp_extract_all("raw_txt", F.lit(pattern), F.lit(0))).alias("org_name"))
        return cut(found.groupBy("doc_key", "org_name").agg(F.count(F.lit(1)).alias("n")).join(maybe_broadcast(self.org.select("org_id", "org_name")), "org_name").select("doc_key", "org_id", "n"))

    def views(self, sql: str) -> dict[str, DataFrame]:
        """The frames whose names stand in ``sql``."""
        words = set(re.findall(r"\w+", sql))
        return {v: getattr(self, v) for v in VIEWS if v in words}


_K = PLAIN_NUMBER_SQL.format
_ISO = """coalesce(strftime(try_cast(nullif(regexp_extract({0}, '(\\d{{4}}-\\d{{1,2}}-\\d{{1,2}})', 1), '') AS DATE), '%Y-%m-%d'),
  strftime(try_strptime(nullif(regexp_extract({0}, '(\\d{{1,2}}/\\d{{1,2}}/\\d{{4}})', 1), ''), '%d/%m/%Y'), '%Y-%m-%d'))""".format
FOLD_SQL = "regexp_replace(replace(replace(strip_accents(lower({0})), 'đ', 'd'), 'ð', 'd'), '\\p{{M}}+', '', 'g')".format
SLUG_SQL = lambda c: f"regexp_replace(regexp_replace({FOLD_SQL(c)}, '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')"
VIEWS_SQL = f"""
latest AS (SELECT * FROM docs WHERE doc_key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_key ORDER BY is_stub, crawled_at DESC NULLS LAST, rec_id DESC) = 1),
cit AS (SELECT DISTINCT ON (id) * FROM citations),
edge0 AS (SELECT {_K('doc_key')} AS src, relation AS rel, {_K('target_key')} AS dst, zone_name, article_number, context, in_thi_hanh FROM cit
  WHERE relation IN {CITING}),
edge AS (SELECT src, rel, dst, count(*) AS hits, min(zone_name) AS zone, min(article_number) AS target_article, min(context) AS context, max(in_thi_hanh) AS in_thi_hanh
  FROM edge0 WHERE src IS NOT NULL AND dst IS NOT NULL AND src <> dst GROUP BY src, rel, dst),
real0 AS (SELECT doc_key, title, doc_type, normative_type, status, {_ISO('issue_date')} AS issue_date, {_ISO('effective_date')} AS effective_date,
  authority_level AS level, is_stub, rec_id FROM latest),
seed0 AS (SELECT doc_key, title, doc_type, NULL AS normative_type, 'CON_HIEU_LUC' AS status, {_ISO('issue_date')} AS issue_date, NULL AS effective_date,
  1 AS level, 0 AS is_stub, NULL AS rec_id FROM docs_seed WHERE doc_key NOT IN (SELECT doc_key FROM real0 WHERE is_stub = 0)),
known0 AS (SELECT * FROM real0 WHERE doc_key NOT IN (SELECT doc_key FROM seed0) UNION ALL SELECT * FROM seed0),
document AS (SELECT * FROM known0 UNION ALL SELECT k, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 1, NULL FROM (SELECT dst AS k FROM edge UNION SELECT src FROM edge)
  WHERE k NOT IN (SELECT doc_key FROM known0)),
org AS (SELECT * FROM organizations),
issued_by AS (SELECT d.doc_key, coalesce(a.org_id, b.org_id) AS org_id FROM document d
  LEFT JOIN org a ON a.short_code = regexp_extract(d.doc_key, '([^/-]+)$', 1) LEFT JOIN org b ON b.short_code = regexp_extract(d.doc_key, '/([^/-]+)-[^/-]+$', 1)
  WHERE coalesce(a.org_id, b.org_id) IS NOT NULL),
sig AS (SELECT DISTINCT ON (signer_id) *, {SLUG_SQL('full_name')} AS person_id FROM chuan WHERE full_name IS NOT NULL AND trim(full_name) <> ''),
signed_by AS (SELECT DISTINCT doc_key, person_id FROM sig WHERE person_id <> ''),
person AS (SELECT person_id, arg_min(full_name, signer_id) AS full_name, arg_min(academic_title, signer_id) FILTER (academic_title IS NOT NULL) AS academic_title,
  list_sort(list_distinct(flatten(list(positions)))) AS positions FROM sig WHERE person_id <> '' GROUP BY person_id),
topic AS (SELECT DISTINCT doc_key, unnest(CAST(topics AS JSON)::VARCHAR[]) AS topic FROM latest WHERE is_stub = 0),
applies_to AS (SELECT DISTINCT doc_key, unit_code AS target_group FROM chuan WHERE unit_code IS NOT NULL),
content AS (SELECT p.doc_key || '#nd' || p.part_index AS content_id, p.doc_key, p.title, l.normative_type AS content_type, l.status, p.part_index
  FROM (SELECT DISTINCT ON (rec_id, part_index) * FROM parts WHERE kind = 'attached') p JOIN latest l ON l.rec_id = p.rec_id AND l.is_stub = 0),
article AS (SELECT a.doc_key || '#' || a.part_index || '#' || a.seq AS article_id, a.doc_key, CASE WHEN a.part_index > 0 THEN a.doc_key || '#nd' || a.part_index END AS content_id,
  a.article_number AS number, a.seq, a.heading, a.is_thi_hanh AS implements, substring(l.raw_txt, a.start_pos + 1, greatest(a.end_pos - a.start_pos, 0)) AS text
  FROM (SELECT DISTINCT ON (rec_id, part_index, seq) * FROM articles) a JOIN latest l ON l.rec_id = a.rec_id AND l.is_stub = 0),
mention0 AS (SELECT doc_key, unnest(regexp_extract_all(raw_txt, (SELECT '(' || string_agg(org_name, '|' ORDER BY length(org_name) DESC, org_name) || ')' FROM organizations))) AS org_name FROM latest WHERE is_stub = 0),
mention AS (SELECT doc_key, org_id, count(*) AS n FROM mention0 JOIN organizations USING (org_name) GROUP BY doc_key, org_id)
"""
