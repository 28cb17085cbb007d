"""Queries of the resolvers, of template selection, and of the evidence of an answer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.functions.numbers import PLAIN_NUMBER_SQL, nfc, plain_number
from quillmesh.functions.registry import nearest_part
from quillmesh.functions.text import slug
from quillmesh.operators import evidence, resolve
from quillmesh.operators.search import any_of, search
from quillmesh.operators.text_keys import RUN, SHAPE, as_query, numbers_in, terms_of
from quillmesh.plans import find, templates
from quillmesh.plans.graph import SLUG_SQL, VIEWS_SQL, PropertyGraph
from quillmesh.runtime import table

QUERIES, ORACLE = {}, {}


def _query(sql: str | None = None):
    def wrap(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return wrap


def _told(df: DataFrame) -> DataFrame:
    return df.select("mention", "outcome", "value", F.array_join("candidates", " | ").alias("candidates"))


def _pick_sql(mentions: str, options: str, aliases: str | None = None, tail: str = "") -> str:
    """The resolver in DuckDB's words, all pairs compared."""
    bare = "list_distinct(list_filter(string_split(regexp_replace({0}, '^(?:" + "|".join(resolve.GENERIC) + ")', ''), '_'), lambda t: t <> ''))"
    alias = (
        f"al AS (SELECT s, min(k) AS k FROM (SELECT {SLUG_SQL('alias')} AS s, {SLUG_SQL('canonical')} AS k FROM ({aliases})) WHERE s <> '' AND k IN (SELECT key FROM o) GROUP BY s)"
        if aliases
        else "al AS (SELECT NULL::VARCHAR AS s, NULL::VARCHAR AS k WHERE FALSE)"
    )
    return f"""WITH m0 AS (SELECT DISTINCT mention, bare FROM ({mentions}) WHERE mention IS NOT NULL), m AS (SELECT *, {SLUG_SQL('bare')} AS s FROM m0),
      o AS (SELECT {SLUG_SQL('name')} AS key, min(name) AS name FROM ({options}) WHERE name IS NOT NULL GROUP BY 1 HAVING key <> ''), {alias},
      sc AS (SELECT m.mention, o.key, o.name, round(len(list_intersect(a, b)) * 1.0 / len(list_distinct(list_concat(a, b))), 9) AS score
        FROM (SELECT *, {bare.format('s')} AS a FROM m) m JOIN (SELECT *, {bare.format('key')} AS b FROM o) o ON len(list_intersect(a, b)) > 0),
      rk AS (SELECT *, row_number() OVER w AS nth, lead(score) OVER w AS next, count(*) OVER (PARTITION BY mention) AS n FROM sc WHERE score >= {resolve.LEAST} WINDOW w AS (PARTITION BY mention ORDER BY score DESC, key)),
      nm AS (SELECT mention, string_agg(name, ' | ' ORDER BY nth) FILTER (nth <= {resolve.TELL}) AS names FROM rk GROUP BY mention),
      pk AS (SELECT m.mention, m.s, coalesce(al.k, o.key, CASE WHEN rk.n = 1 OR round(rk.score - rk.next, 9) >= {resolve.MARGIN} THEN rk.key END) AS value, nm.names
        FROM m LEFT JOIN al ON al.s = m.s LEFT JOIN o ON o.key = m.s LEFT JOIN rk ON rk.mention = m.mention AND rk.nth = 1 LEFT JOIN nm ON nm.mention = m.mention)
      {tail or "SELECT mention, CASE WHEN value IS NOT NULL THEN 'resolved' WHEN names IS NOT NULL THEN 'ambiguous' ELSE 'not_found' END AS outcome, value, CASE WHEN value IS NULL THEN coalesce(names, '') ELSE '' END AS candidates FROM pk"}"""


@_query(
    _pick_sql(
        "SELECT org_name AS mention, org_name AS bare FROM docs WHERE trim(org_name) <> ''",
        "SELECT org_name AS name FROM organizations",
        "SELECT alias, canonical FROM aliases_seed",
    )
)
def resolve_organizations(spark: SparkSession, folder: str) -> DataFrame:
    """The organisation meant by every typed name, by alias, slug or telling words."""
    mentions = table(spark, folder, "docs").where("trim(org_name) <> ''").select(F.col("org_name").alias("mention"))
    return _told(resolve.pick(mentions, table(spark, folder, "organizations").select(F.col("org_name").alias("name")), table(spark, folder, "aliases_seed")))


_PART = f"""
 , words AS (SELECT mention, list_distinct(list_filter(string_split(s, '_'), lambda t: t <> '')) AS a FROM pk WHERE value IS NULL AND names IS NULL),
 part AS (SELECT w.mention, o.key, o.name, row_number() OVER (PARTITION BY w.mention ORDER BY o.key) AS nth, count(*) OVER (PARTITION BY w.mention) AS n
   FROM words w JOIN o ON len(a) > 0 AND list_has_all(string_split(o.key, '_'), a)),
 told AS (SELECT mention, min(key) AS key, max(n) AS n, string_agg(name, ' | ' ORDER BY nth) FILTER (nth <= {resolve.TELL_PART}) AS names FROM part GROUP BY mention)
 SELECT pk.mention, CASE WHEN value IS NOT NULL OR told.n = 1 THEN 'resolved' WHEN pk.names IS NOT NULL OR told.n > 1 THEN 'ambiguous' ELSE 'not_found' END AS outcome,
   coalesce(value, CASE WHEN told.n = 1 THEN told.key END) AS value, CASE WHEN value IS NOT NULL OR told.n = 1 THEN '' ELSE coalesce(pk.names, told.names, '') END AS candidates FROM pk LEFT JOIN told ON told.mention = pk.mention"""
_HON = "trim(regexp_replace(full_name, '(?i)^\\s*(?:(?:" + "|".join(resolve.HONORIFICS) + ")(?:\\.\\s*|\\s+))+', ''))"


@_query(
    _pick_sql(
        f"SELECT full_name AS mention, {_HON} AS bare FROM chuan WHERE trim(full_name) <> ''",
        "SELECT full_name AS name FROM chuan WHERE len(string_split(trim(full_name), ' ')) = 4",
        None,
        _PART,
    )
)
def resolve_people(spark: SparkSession, folder: str) -> DataFrame:
    """The person meant by every typed name, among the names of four words."""
    names = table(spark, folder, "chuan").where("trim(full_name) <> ''")
    return _told(resolve.pick_person(names.select(F.col("full_name").alias("mention")), names.where("size(split(trim(full_name), ' ')) = 4").select(F.col("full_name").alias("name"))))


@_query(
    f"SELECT m AS mention, CASE WHEN k IS NULL THEN 'not_found' ELSE 'resolved' END AS outcome, k AS value, '' AS candidates FROM (SELECT DISTINCT target_key AS m, {PLAIN_NUMBER_SQL.format('target_key')} AS p FROM citations WHERE target_key IS NOT NULL) "
    "LEFT JOIN (SELECT doc_key AS k FROM docs WHERE doc_key IS NOT NULL UNION SELECT doc_key FROM docs_seed) ON k = p"
)
def resolve_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Which typed numbers some document has, stubs included."""
    known = table(spark, folder, "docs").select(F.col("doc_key").alias("key")).union(table(spark, folder, "docs_seed").select("doc_key"))
    return _told(resolve.pick_key(table(spark, folder, "citations").select(F.col("target_key").alias("mention")), known, plain_number(F.col("mention"))))


@_query(
    f"SELECT m AS mention, CASE WHEN k IS NULL THEN 'not_found' ELSE 'resolved' END AS outcome, k AS value, '' AS candidates FROM (SELECT DISTINCT doc_type AS m, {SLUG_SQL('doc_type')} AS s FROM docs WHERE doc_type IS NOT NULL) "
    f"LEFT JOIN (SELECT DISTINCT {SLUG_SQL('type_name')} AS k FROM document_types) ON k = s"
)
def resolve_types(spark: SparkSession, folder: str) -> DataFrame:
    """Which typed document types are listed, case and accents aside."""
    known = table(spark, folder, "document_types").select(slug(F.col("type_name")).alias("key"))
    return _told(resolve.pick_key(table(spark, folder, "docs").select(F.col("doc_type").alias("mention")), known, slug(F.col("mention"))))


_ARTICLE = (
    "CASE WHEN regexp_matches(c, '[Đđ][Ii][Ềề][Uu]\\s+[0-9]+') THEN 'Điều ' || regexp_extract(c, '[Đđ][Ii][Ềề][Uu]\\s+([0-9]+[a-zA-Z]?)', 1) WHEN regexp_full_match(c, '[0-9]+[a-zA-Z]?') THEN 'Điều ' || c "
    "ELSE nullif(upper(regexp_extract(c, '^(?:(?:[Mm][Ụụ][Cc]|[Pp][Hh][Ầầ][Nn])\\s+)?([0-9]+(?:\\.[0-9]+)*|[IVXLivxl]+)\\.?$', 1)), '') END"
)


@_query(f"SELECT dieu AS mention, {_ARTICLE} AS value FROM (SELECT DISTINCT dieu, trim(dieu) AS c FROM phieu_gan WHERE dieu IS NOT NULL)")
def resolve_articles(spark: SparkSession, folder: str) -> DataFrame:
    """The article meant by what annotators typed."""
    typed = table(spark, folder, "phieu_gan").where("dieu is not null").select(F.col("dieu").alias("mention")).distinct()
    return typed.select("mention", resolve.article_number(F.col("mention")).alias("value"))


_KEY = "regexp_replace(upper(replace(replace(strip_accents({0}), 'đ', 'd'), 'Đ', 'D')), '^0+([0-9])', '\\1')"


@_query(
    f"WITH r AS (SELECT DISTINCT id, list_filter(list_transform(regexp_extract_all(nfc_normalize(ngu_canh), '{RUN}'), lambda x: regexp_replace(x, '^[/&-]+|[/&-]+$', '', 'g')), lambda x: regexp_matches(upper(x), '{SHAPE}')) AS f FROM phieu_gan WHERE ngu_canh IS NOT NULL), "
    f"u AS (SELECT id, f, unnest(f) AS x, generate_subscripts(f, 1) AS i FROM r), k AS (SELECT id, f, x, i, row_number() OVER (PARTITION BY id, f, {_KEY.format('x')} ORDER BY i) AS nth FROM u) "
    "SELECT DISTINCT id, numbers FROM (SELECT id, string_agg(x, ' ; ' ORDER BY i) AS numbers FROM k WHERE nth = 1 GROUP BY id, f)"
)
def numbers_in_contexts(spark: SparkSession, folder: str) -> DataFrame:
    """The document numbers in the contexts of the annotation sheets, those without any left out."""
    rows = table(spark, folder, "phieu_gan").where("ngu_canh is not null").select("id", nfc(F.col("ngu_canh")).alias("c"))
    return rows.select("id", numbers_in(F.col("c")).alias("n")).where("size(n) > 0").select("id", F.array_join("n", " ; ").alias("numbers")).distinct()


@_query()
def question_terms(spark: SparkSession, folder: str) -> DataFrame:
    """Every held-out question as a full-text query."""
    rows = table(spark, folder, "eval_items").select("item_id", nfc(F.col("cau_hoi")).alias("c"))
    return rows.select("item_id", as_query(terms_of(F.col("c"))).alias("query"))


#: Frames of questions for the selection: by action, with the slots that were filled.
FRAMES = [
    (1, "list_documents", {"topic": "x"}, "Văn bản nào về x?"), (2, "list_documents", {"topic": "x", "colour": "red"}, ""), (3, "no_such_action", {}, ""), (4, "document_detail", {}, "Bản 71/TB-UVW nói gì?"),
    (5, "document_detail", {}, "So 71/TB-UVW với 72/TB-UVW"), (6, "relation_counts", {}, ""), (7, "stats_by_year", {"org": "o", "topic": ""}, ""), (8, "most_cited", {"limit": "5"}, ""),
]


@_query()
def template_choices(spark: SparkSession, folder: str) -> DataFrame:
    """What the selection decides for some frames, numbers filled in from their questions first."""
    frames = spark.createDataFrame(FRAMES, "id int, action string, slots map<string,string>, question string").withColumn("c", nfc(F.col("question")))
    frames = evidence.fill_number(frames, numbers_in(F.col("c")))
    return evidence.select_template(frames, evidence.rules(spark, templates.REGISTRY.values()))


_SEEDS = f"{find._index_sql('article')}{find._leaf_sql('q', find._BAGW, False)}, l AS ({find._TOP('q', 60)}), sd AS (SELECT key, score, nth AS rank FROM (SELECT l.key, l.score, row_number() OVER (ORDER BY l.rank, l.key) AS nth FROM l JOIN article a ON a.article_id = l.key WHERE coalesce(a.implements, 0) = 0) WHERE nth <= 20)"


def _seeds(graph: PropertyGraph) -> tuple[DataFrame, DataFrame]:
    arts = graph.article.select(F.col("article_id").alias("key"), "implements", "text")
    return evidence.seeds(search(find.index(graph, "article"), any_of(find._BAG), 60), arts, 20), arts


@_query(f"WITH RECURSIVE {VIEWS_SQL} {_SEEDS} SELECT key, score, rank FROM sd")
def seed_fulltext(spark: SparkSession, folder: str) -> DataFrame:
    """The twenty best articles for a question, articles of implementation dropped from three times as many."""
    return _seeds(PropertyGraph.of(spark, folder))[0]


@_query(
    f"WITH RECURSIVE {VIEWS_SQL} {_SEEDS}, sh AS (SELECT a.* FROM sd JOIN article a ON a.article_id = sd.key WHERE length(coalesce(a.text, '')) < 400) "
    "SELECT sh.article_id AS key, b.article_id AS neighbour FROM sh JOIN article b ON b.doc_key = sh.doc_key AND b.content_id IS NOT DISTINCT FROM sh.content_id AND abs(b.number - sh.number) = 1"
)
def short_seed_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The articles beside seeds that are too short to stand alone."""
    from quillmesh.plans.walks import neighbour_articles

    graph = PropertyGraph.of(spark, folder)
    seeds, arts = _seeds(graph)
    return evidence.short_seeds(seeds, arts).join(neighbour_articles(graph).withColumnRenamed("article_id", "key"), "key").select("key", "neighbour")


_ROWS = "SELECT row_number() OVER (ORDER BY doc_key) AS pos, doc_key AS document, NULL::VARCHAR AS article, NULL::VARCHAR AS content, title, status FROM document WHERE is_stub = 0 QUALIFY pos <= 15"


@_query(
    f"WITH RECURSIVE {VIEWS_SQL} {_SEEDS}, ro AS ({_ROWS}), hi AS (SELECT sd.rank AS pos, a.doc_key AS document, sd.key AS article, a.heading AS title, d.status FROM sd JOIN article a ON a.article_id = sd.key JOIN document d ON d.doc_key = a.doc_key), "
    "rt AS (SELECT document, arg_max(status, pos) AS r FROM hi WHERE status IS NOT NULL GROUP BY document), ev AS (SELECT 0 AS part, pos, ro.document, NULL::VARCHAR AS article, title, coalesce(r, status) AS status FROM ro LEFT JOIN rt ON rt.document = ro.document "
    "UNION ALL SELECT 1, pos, document, article, title, status FROM hi), fi AS (SELECT * FROM ev QUALIFY row_number() OVER (PARTITION BY document, article ORDER BY part, pos) = 1) "
    "SELECT nth AS pos, document, article, title, status FROM (SELECT *, row_number() OVER (ORDER BY part, pos) AS nth FROM fi) WHERE nth <= 20"
)
def answer_sources(spark: SparkSession, folder: str) -> DataFrame:
    """What an answer of fifteen rows and twenty seeds rests on."""
    graph = PropertyGraph.of(spark, folder)
    seeds, _ = _seeds(graph)
    docs = graph.document.where("is_stub = 0").orderBy("doc_key").limit(15)
    none = F.lit(None).cast("string")
    from pyspark.sql import Window

    rows = docs.select(F.row_number().over(Window.orderBy("doc_key")).alias("pos"), F.col("doc_key").alias("document"), none.alias("article"), none.alias("content"), "title", "status")
    of = graph.article.select(F.col("article_id").alias("key"), "doc_key", F.col("heading").alias("title"))
    hits = seeds.join(of, "key").join(graph.document.select("doc_key", "status"), "doc_key").select(F.col("rank").alias("pos"), F.col("doc_key").alias("document"), F.col("key").alias("article"), "title", "status")
    return evidence.sources(rows, hits).drop("content")


@_query()
def heading_in_scan(spark: SparkSession, folder: str) -> DataFrame:
    """How near the nearest part of the page text comes to each article's heading: edits and place."""
    docs = table(spark, folder, "docs").where("raw_txt is not null").select("rec_id", "raw_txt")
    arts = table(spark, folder, "articles").where("length(trim(heading)) between 1 and 80").dropDuplicates(["rec_id", "part_index", "seq"])
    part = F.substring("raw_txt", F.greatest(F.col("start_pos") + 1, F.lit(1)), 200)
    near = arts.join(docs, "rec_id").select("rec_id", "part_index", "seq", nearest_part(nfc(F.trim("heading")), nfc(part)).alias("x"))
    return near.select("rec_id", "part_index", "seq", "x.edits", "x.begin", "x.end")
