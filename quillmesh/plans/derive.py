"""What follows from numbers, names, titles and contexts of the raw tables: issuers, kinds, gold sets, rewritten citations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.functions.pages import page_chunks
from quillmesh.functions.text import folded, number_parts
from quillmesh.operators.segments import segments
from quillmesh.plans import tables
from quillmesh.plans.graph import FOLD_SQL, VIEWS_SQL, PropertyGraph
from quillmesh.runtime import maybe_broadcast, table

QUERIES, ORACLE = {}, {}


def _both(name: str, sql: str, spark: str | None = None) -> None:
    tables.both(name, sql, spark)
    QUERIES[name], ORACLE[name] = tables.QUERIES.pop(name), tables.ORACLE.pop(name)


def _exploded(name: str, sql: str) -> None:
    _both(name, sql, spark=sql.replace("unnest(", "explode("))


def _graph_query(sql: str | None = None):
    def wrap(f):
        QUERIES[f.__name__] = lambda spark, folder: f(PropertyGraph.of(spark, folder))
        if sql:
            ORACLE[f.__name__] = f"WITH RECURSIVE {VIEWS_SQL} {sql}"
        return f

    return wrap


# fixed values: the kind of document that a type code stands for; issuers whose old numbers without a code are decrees
TYPE_BY_CODE = {"QH": "Luật", "UBTVQH": "Pháp lệnh", "NĐ": "Nghị định", "TT": "Thông tư", "TTLT": "Thông tư liên tịch", "QĐ": "Quyết định", "NQ": "Nghị quyết", "CT": "Chỉ thị", "HD": "Hướng dẫn", "KH": "Kế hoạch", "VBHN": "Văn bản hợp nhất", "L": "Lệnh"}
OLD_DECREES = ["CP", "HDBT"]
# fixed values: beginnings of the names of local government and of parts of an institution
LOCAL = ["thanh pho", "uy ban nhan dan", "ubnd", "so ", "tinh "]
PARTS = ["phong ", "ban ", "khoa ", "trung tam ", "vien "]

_FLAT = lambda x: f"upper({FOLD_SQL(x)})"
_TAIL = "regexp_extract(doc_key, '^[0-9]+(?:/[0-9]{4}(?:/|$))?/?(.*)$', 1)"
_TYPES = " ".join(f"WHEN '{k.replace('Đ', 'D')}' THEN '{v}'" for k, v in TYPE_BY_CODE.items())
_KNOWN = ", ".join(f"'{k.replace('Đ', 'D')}'" for k in TYPE_BY_CODE)


def number_issuers(spark: SparkSession, folder: str) -> DataFrame:
    """The kind and the issuer that a document's number tells: by its code, old decrees, letters; by the whole tail, else its first part."""
    docs = table(spark, folder, "docs").where("doc_key is not null").select("doc_key").distinct()
    parts = docs.select("doc_key", number_parts(F.col("doc_key")).alias("p")).select("doc_key", "p.*")
    flat = lambda c: F.upper(folded(F.col(c)))
    of = F.create_map(*(F.lit(x) for k, v in TYPE_BY_CODE.items() for x in (k.replace("Đ", "D"), v)))
    kind = F.coalesce(F.try_element_at(of, flat("type_code")), F.when(flat("org_code").isin(*OLD_DECREES), F.lit("Nghị định")).when(F.col("org_code").isNotNull(), F.lit("Công văn")))
    orgs = maybe_broadcast(table(spark, folder, "organizations").select(flat("short_code").alias("code"), "org_id").groupBy("code").agg(F.min("org_id").alias("org_id")))
    whole, first = orgs.select(F.col("code").alias("c1"), F.col("org_id").alias("o1")), orgs.select(F.col("code").alias("c2"), F.col("org_id").alias("o2"))
    with_codes = parts.withColumn("c1", flat("org_code")).withColumn("c2", F.split_part(flat("org_code"), F.lit("-"), F.lit(1)))
    return with_codes.join(whole, "c1", "left").join(first, "c2", "left").select("doc_key", "num", "year", "type_code", "org_code", kind.alias("kind"), F.coalesce("o1", "o2").alias("org_id"))


QUERIES["number_issuers"] = number_issuers
ORACLE["number_issuers"] = f"""WITH d AS (SELECT DISTINCT doc_key, nullif(regexp_extract(doc_key, '^([0-9]+)', 1), '') AS num FROM docs WHERE doc_key IS NOT NULL),
  y AS (SELECT *, CASE WHEN regexp_matches(doc_key, '^[0-9]+/[0-9]{{4}}(/|$)') THEN regexp_extract(doc_key, '^[0-9]+/([0-9]{{4}})', 1) END AS year FROM d),
  t AS (SELECT *, nullif(CASE WHEN year IS NOT NULL THEN substring(doc_key, length(num) + 7) ELSE substring(doc_key, length(num) + 2) END, '') AS tail FROM y),
  h AS (SELECT *, {_FLAT("split_part(tail, '-', 1)")} AS head, regexp_matches(tail, '^QH[0-9]*$') AS qh FROM t),
  p AS (SELECT doc_key, num, year, CASE WHEN num IS NULL THEN NULL WHEN qh THEN 'QH' WHEN head IN ({_KNOWN}) THEN split_part(tail, '-', 1) END AS type_code,
    CASE WHEN num IS NULL THEN NULL WHEN qh THEN tail WHEN head IN ({_KNOWN}) THEN nullif(regexp_extract(tail, '^[^-]*-(.+)$', 1), '') ELSE tail END AS org_code FROM h),
  o AS (SELECT {_FLAT('short_code')} AS code, min(org_id) AS org_id FROM organizations GROUP BY 1)
  SELECT doc_key, num, year, type_code, org_code, CASE {_FLAT('type_code')} {_TYPES} ELSE CASE WHEN {_FLAT('org_code')} IN ('CP', 'HDBT') THEN 'Nghị định' WHEN org_code IS NOT NULL THEN 'Công văn' END END AS kind,
   coalesce(a.org_id, b.org_id) AS org_id FROM p LEFT JOIN o a ON a.code = {_FLAT('org_code')} LEFT JOIN o b ON b.code = split_part({_FLAT('org_code')}, '-', 1)"""

_starts = lambda words: " OR ".join(f"substring(f, 1, {len(w)}) = '{w}'" for w in words)
_both(
    "org_kinds",
    "WITH n AS (SELECT DISTINCT org_name, FOLD(trim(org_name)) AS f FROM docs WHERE trim(org_name) <> ''), k AS (SELECT n.org_name, CASE WHEN " + _starts(LOCAL) + " THEN 1 ELSE 0 END AS is_local, "
    "coalesce(o.org_type, CASE WHEN substring(f, 1, 3) = 'bo ' THEN 'bo_nganh' WHEN substring(f, 1, 7) = 'truong ' THEN 'truong_thanh_vien' WHEN " + _starts(PARTS) + " THEN 'phong_ban' ELSE 'don_vi_truc_thuoc' END) AS kind, o.parent_org "
    "FROM n LEFT JOIN organizations o ON o.org_name = n.org_name), g AS (SELECT min(org_name) AS name FROM organizations WHERE org_type = 'chinh_phu') "
    "SELECT org_name, is_local, kind, coalesce(parent_org, CASE WHEN kind = 'bo_nganh' THEN g.name END) AS parent FROM k CROSS JOIN g",
)
_both(
    "article_ids",
    "SELECT rec_id, part_index, seq, CASE WHEN nth = 1 THEN stem ELSE stem || '~' || nth END AS article_id FROM (SELECT rec_id, part_index, seq, stem, row_number() OVER (PARTITION BY stem ORDER BY seq) AS nth "
    "FROM (SELECT DISTINCT rec_id, part_index, seq, rec_id || '#' || part_index || '#' || coalesce(CAST(article_number AS VARCHAR), '') AS stem FROM articles) a) x",
    spark="SELECT rec_id, part_index, seq, CASE WHEN nth = 1 THEN stem ELSE stem || '~' || nth END AS article_id FROM (SELECT rec_id, part_index, seq, stem, row_number() OVER (PARTITION BY stem ORDER BY seq) AS nth "
    "FROM (SELECT DISTINCT rec_id, part_index, seq, rec_id || '#' || part_index || '#' || coalesce(CAST(article_number AS STRING), '') AS stem FROM articles) a) x",
)
_VOTES = (
    "v AS (SELECT number_key, n, surface FROM (SELECT PLAIN(target_key) AS number_key, surface, sum(count(*)) OVER (PARTITION BY PLAIN(target_key)) AS n, row_number() OVER (PARTITION BY PLAIN(target_key) ORDER BY count(*) DESC, surface) AS nth "
    "FROM citations WHERE surface IS NOT NULL AND PLAIN(target_key) IS NOT NULL GROUP BY PLAIN(target_key), surface) x WHERE nth = 1 AND n >= 3)"
)
_both("rewritten_citations", f"WITH {_VOTES}, c AS (SELECT DISTINCT id, surface, PLAIN(target_key) AS number_key FROM citations WHERE surface IS NOT NULL) SELECT c.id, c.surface, v.surface AS rewritten FROM c JOIN v ON v.number_key = c.number_key WHERE v.surface <> c.surface")
_both("learned_numbers", "SELECT FOLD(doc_type) AS kind, FOLD(title) AS name, ISO(issue_date) AS issued, min(doc_key) AS number, count(*) AS n FROM docs WHERE is_stub = 0 AND doc_key IS NOT NULL AND title IS NOT NULL AND issue_date IS NOT NULL GROUP BY FOLD(doc_type), FOLD(title), ISO(issue_date) HAVING count(DISTINCT doc_key) = 1")
_DIRECTION = (
    "SELECT id, CASE WHEN rel IS NULL THEN NULL WHEN passive THEN CASE rel WHEN 'REPLACES' THEN 'REPLACED_BY' WHEN 'AMENDS' THEN 'AMENDED_BY' ELSE 'REPEALED_BY' END ELSE rel END AS relation FROM "
    "(SELECT id, CASE WHEN HAS(c, 'sửa đổi|bổ sung') THEN 'AMENDS' WHEN HAS(c, 'thay thế|thay cho|bãi bỏ|hết hiệu lực') THEN CASE WHEN HAS(c, '(?:một số|các) (?:điều|khoản|điểm)') THEN 'AMENDS' WHEN HAS(c, 'thay thế|thay cho') THEN 'REPLACES' ELSE 'REPEALS' END END AS rel, "
    "HAS(c, '(?:được|bị) (?:sửa đổi|thay thế|bãi bỏ)[^;]* bởi ') AS passive FROM (SELECT DISTINCT id, lower(context) AS c FROM citations WHERE context IS NOT NULL) a) b WHERE rel IS NOT NULL"
)
_both("relation_directions", _DIRECTION)
_both(
    "dropped_citations",
    "SELECT c.doc_key, count(*) AS n, SET(c.k) AS numbers FROM (SELECT DISTINCT doc_key, PLAIN(target_key) AS k FROM citations WHERE PLAIN(target_key) IS NOT NULL) c LEFT JOIN (SELECT doc_key AS known FROM docs UNION SELECT doc_key FROM docs_seed) d ON d.known = c.k WHERE d.known IS NULL GROUP BY c.doc_key",
)
_SYL = "^(?:ngh|ng|nh|ch|gh|gi|kh|ph|qu|th|tr|[bcdghklmnprstvx])?(?:[aeiouy]{1,3})(?:ng|nh|ch|[cmnpt])?$"
_RATES = f"r AS (SELECT rec_id, SUM1(NOT HAS(w, '{_SYL}')) * 1.0 / count(*) AS rate FROM (SELECT rec_id, unnest(ALL(FOLD(raw_txt), '[a-z]+')) AS w FROM docs) x GROUP BY rec_id)"
_both(
    "syllable_report",
    f"WITH {_RATES} SELECT count(*) AS n, round(avg(rate), 6) AS mean, SUM1(rate >= 0.01) AS over_1, SUM1(rate >= 0.02) AS over_2, SUM1(rate >= 0.03) AS over_3 FROM r",
    spark=f"WITH {_RATES.replace('unnest(', 'explode(').replace('* 1.0 /', '* 1.0D /')} SELECT count(*) AS n, round(avg(rate), 6) AS mean, SUM1(rate >= 0.01) AS over_1, SUM1(rate >= 0.02) AS over_2, SUM1(rate >= 0.03) AS over_3 FROM r",
)
_WORST = f"WITH {_RATES} SELECT rec_id, round(rate, 6) AS rate FROM r ORDER BY rate DESC, rec_id LIMIT 30"
_both("worst_syllables", _WORST, spark=_WORST.replace("unnest(", "explode(").replace("* 1.0 /", "* 1.0D /"))
# --- gold sets of questions
#: Keywords whose documents are asked for, and how often a text has to have one.
KEYWORDS, TIMES = ["học bổng khuyến học", "danh mục tạp chí", "thẻ ra vào"], 5
_both(
    "gold_keywords",
    " UNION ALL ".join(
        f"SELECT '{k}' AS keyword, doc_key, min(CASE WHEN contains(lower(title), '{k}') THEN 'title' ELSE 'text' END) AS found_in FROM docs WHERE is_stub = 0 AND doc_key IS NOT NULL AND (contains(lower(title), '{k}') OR len(ALL(lower(raw_txt), '{k}')) >= {TIMES}) GROUP BY doc_key"
        for k in KEYWORDS
    ),
    spark=" UNION ALL ".join(
        f"SELECT '{k}' AS keyword, doc_key, min(CASE WHEN contains(lower(title), '{k}') THEN 'title' ELSE 'text' END) AS found_in FROM docs WHERE is_stub = 0 AND doc_key IS NOT NULL AND (contains(lower(title), '{k}') OR size(ALL(lower(raw_txt), '{k}')) >= {TIMES}) GROUP BY doc_key"
        for k in KEYWORDS
    ),
)


@_graph_query(
    "SELECT t.topic, d.status, d.level, count(DISTINCT d.doc_key) AS n, array_to_string(list_sort(list_distinct(list(d.doc_key))), ' ') AS answers FROM topic t JOIN document d ON d.doc_key = t.doc_key WHERE d.is_stub = 0 AND d.status IS NOT NULL AND d.level >= 4 GROUP BY ALL HAVING count(DISTINCT d.doc_key) >= 2"
)
def gold_facets(graph: PropertyGraph) -> DataFrame:
    """The answers to questions that cross topic, status and level, two at least."""
    d = graph.document.where("is_stub = 0 and status is not null and level >= 4").select("doc_key", "status", "level")
    each = graph.topic.join(d, "doc_key").groupBy("topic", "status", "level").agg(F.array_sort(F.collect_set("doc_key")).alias("x"))
    return each.select("topic", "status", "level", F.size("x").cast("bigint").alias("n"), F.array_join("x", " ").alias("answers")).where("n >= 2")


_IN = ", p AS (SELECT DISTINCT src, dst FROM edge), g AS (SELECT dst, count(*) AS n, string_agg(src, ' ' ORDER BY src) AS answers FROM p GROUP BY dst HAVING count(*) >= 3)"


@_graph_query(
    f"{_IN}, c1 AS (SELECT 'shared basis' AS kind, dst AS about, n, answers FROM g JOIN document d ON d.doc_key = dst WHERE d.is_stub = 1 ORDER BY n DESC, dst LIMIT 6), "
    "c2 AS (SELECT 'foundation' AS kind, dst AS about, n, answers FROM g JOIN document d ON d.doc_key = dst WHERE d.is_stub = 0 ORDER BY n DESC, dst LIMIT 4) SELECT * FROM c1 UNION ALL SELECT * FROM c2"
)
def gold_hops(graph: PropertyGraph) -> DataFrame:
    """Questions that only links answer: what rests on a document that is not held, and on one that is."""
    pairs = graph.edge.select("src", "dst").distinct()
    n = pairs.groupBy(F.col("dst").alias("about")).agg(F.count(F.lit(1)).alias("n")).where("n >= 3").join(graph.document.select(F.col("doc_key").alias("about"), "is_stub"), "about")
    top = lambda stub, most: n.where(F.col("is_stub") == stub).orderBy(F.desc("n"), "about").limit(most)
    asked = top(1, 6).withColumn("kind", F.lit("shared basis")).unionByName(top(0, 4).withColumn("kind", F.lit("foundation")))
    # only the ten that are asked about are listed
    listed = pairs.withColumnRenamed("dst", "about").join(F.broadcast(asked), "about").groupBy("kind", "about", "n")
    return listed.agg(F.array_join(F.array_sort(F.collect_list("src")), " ").alias("answers"))


@_graph_query(
    ", p AS (SELECT DISTINCT src, dst FROM edge), k AS (SELECT doc_key FROM document WHERE is_stub = 0 UNION SELECT dst FROM p JOIN document d ON d.doc_key = dst WHERE d.is_stub = 1 GROUP BY dst HAVING count(*) >= 3) "
    "SELECT src, rel, dst, d.is_stub AS outside FROM edge JOIN document d ON d.doc_key = dst WHERE src IN (SELECT doc_key FROM k) AND dst IN (SELECT doc_key FROM k)"
)
def study_graph(graph: PropertyGraph) -> DataFrame:
    """The links between documents that are held and those outside that three of them cite at least."""
    docs = graph.document.select("doc_key", "is_stub")
    cited = graph.edge.select("src", "dst").distinct().groupBy(F.col("dst").alias("doc_key")).agg(F.count(F.lit(1)).alias("n"))
    kept = docs.join(cited, "doc_key", "left").where("is_stub = 0 or n >= 3")
    a, b = kept.select(F.col("doc_key").alias("src")), kept.select(F.col("doc_key").alias("dst"), F.col("is_stub").alias("outside"))
    return graph.edge.join(b, "dst").join(a, "src", "left_semi").select("src", "rel", "dst", "outside")


def page_chunk_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Every text in chunks of at most 4,000 characters along its pages: number and length of each."""
    docs = table(spark, folder, "docs").where("raw_txt is not null").select("rec_id", page_chunks(F.col("raw_txt"), 4_000).alias("c"))
    return docs.select("rec_id", F.posexplode("c").alias("nth", "chunk")).select("rec_id", "nth", F.length("chunk").alias("n"))


QUERIES["page_chunk_sizes"] = page_chunk_sizes


def document_parts(spark: SparkSession, folder: str) -> DataFrame:
    """The parts of every text with their zones' lengths and numbers of articles."""
    parts = segments(table(spark, folder, "docs"))
    size = lambda z: (F.col("zones")[z]["end_pos"] - F.col("zones")[z]["start_pos"]).alias(f"{z}_len")
    return parts.select("rec_id", "part_index", "kind", "title", "marker", "start_pos", "end_pos", F.size("articles").alias("n_articles"), *map(size, ("header", "basis", "body", "sign")))


def document_articles(spark: SparkSession, folder: str) -> DataFrame:
    """The articles of every part, as they stand in the text."""
    parts = segments(table(spark, folder, "docs")).select("rec_id", "part_index", F.explode("articles").alias("a"))
    return parts.select("rec_id", "part_index", "a.seq", F.col("a.number").alias("article_number"), "a.suffix", "a.heading", "a.start_pos", "a.end_pos", F.col("a.implements").alias("is_thi_hanh"))


QUERIES |= {f.__name__: f for f in (document_parts, document_articles)}
# that every text is covered by its parts without gaps, and every article lies in a part, is tested; the articles' places are SQL's
ORACLE["document_articles_found"] = r"""WITH t AS (SELECT rec_id, unnest(regexp_extract_all(nfc_normalize(raw_txt), '(?m)^[ \t]*Điều\s+[0-9]+[a-zA-ZđĐ]?\s*[.:]')) AS head FROM docs)
  SELECT rec_id, count(*) AS n, sum(CAST(regexp_extract(head, '([0-9]+)', 1) AS BIGINT)) AS total FROM t GROUP BY rec_id"""


def document_articles_found(spark: SparkSession, folder: str) -> DataFrame:
    """How many articles each text has and what their numbers add up to."""
    return document_articles(spark, folder).groupBy("rec_id").agg(F.count(F.lit(1)).alias("n"), F.sum("article_number").alias("total"))


QUERIES["document_articles_found"] = document_articles_found
