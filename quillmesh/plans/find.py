"""Questions that search texts and vectors, and the assembly of evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmesh.operators.paths import trails
from quillmesh.operators.search import And, Or, Phrase, Term, TextIndex, any_of, cosine_top, expand_once, fuse, pack, phrase_or_all, ranked, search
from quillmesh.plans.graph import FOLD_SQL, VIEWS_SQL, PropertyGraph

QUERIES, ORACLE = {}, {}
_INDEXES: dict[tuple, TextIndex] = {}


def _query(sql: str | None = None):
    def wrap(f):
        QUERIES[f.__name__] = lambda spark, folder: f(PropertyGraph.of(spark, folder))
        if sql:
            ORACLE[f.__name__] = f"WITH RECURSIVE {VIEWS_SQL} {sql}"
        return f

    return wrap


def index(graph: PropertyGraph, what: str) -> TextIndex:
    """The text index of documents (title), articles (heading and text) or contents (title), made once a session."""
    key = (graph.spark.sparkContext.applicationId, graph.folder, what)
    if key not in _INDEXES:
        texts = {
            "document": lambda: graph.document.where("is_stub = 0").select(F.col("doc_key").alias("key"), F.col("title").alias("text")),
            "article": lambda: graph.article.select(F.col("article_id").alias("key"), F.concat_ws(" ", "heading", "text").alias("text")),
            "content": lambda: graph.content.select(F.col("content_id").alias("key"), F.col("title").alias("text")),
        }[what]()
        _INDEXES[key] = TextIndex(texts)
    return _INDEXES[key]


_SOURCE = {
    "document": "SELECT doc_key AS key, title AS text FROM document WHERE is_stub = 0",
    "article": "SELECT article_id AS key, concat_ws(' ', heading, text) AS text FROM article",
    "content": "SELECT content_id AS key, title AS text FROM content",
}


def _index_sql(what: str, n: str = "") -> str:
    """ws: the words of each text; tx: its length; po: postings with places."""
    return (
        f", ws{n} AS (SELECT key, regexp_extract_all({FOLD_SQL('coalesce(text, ' + chr(39) * 2 + ')')}, '[a-z0-9]+') AS w FROM ({_SOURCE[what]})),"
        f" st{n} AS (SELECT count(*) AS n, avg(len(w)) AS mean FROM ws{n}), po{n} AS (SELECT key, len(w) AS len, unnest(w) AS term, generate_subscripts(w, 1) AS pos FROM ws{n})"
    )


def _leaf_sql(name: str, words: list[str], phrase: bool, n: str = "") -> str:
    if phrase:
        joins = "".join(f" JOIN po{n} p{k} ON p{k}.key = p0.key AND p{k}.term = '{w}' AND p{k}.pos = p0.pos + {k}" for k, w in enumerate(words) if k)
        hits = f"SELECT 'x' AS leaf, p0.key, p0.len, count(*) AS tf FROM po{n} p0{joins} WHERE p0.term = '{words[0]}' GROUP BY p0.key, p0.len"
    else:
        hits = f"SELECT term AS leaf, key, len, count(*) AS tf FROM po{n} WHERE term IN ({', '.join(repr(w) for w in words)}) GROUP BY term, key, len"
    return (
        f", {name}h AS ({hits}), {name} AS (SELECT key, sum(s) AS score FROM (SELECT h.leaf, h.key, ln(1 + (st{n}.n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len / mean)) AS s "
        f"FROM (SELECT *, count(*) OVER (PARTITION BY leaf) AS df FROM {name}h) h CROSS JOIN st{n}) GROUP BY key)"
    )


_TOP = "SELECT key, round(score, 9) AS score, row_number() OVER (ORDER BY round(score, 9) DESC, key) AS rank FROM {0} QUALIFY rank <= {1}".format
_PHRASE = "danh mục tạp chí"
_P = ["danh", "muc", "tap", "chi"]


def _plain(df: DataFrame) -> DataFrame:
    return df.select("key", "score", F.col("rank").cast("int").alias("rank"))


@_query(f"{_index_sql('document')}{_leaf_sql('q', _P, True)} {_TOP('q', 50)}")
def b11_fulltext_doc_text(graph: PropertyGraph) -> DataFrame:
    """Documents with a phrase in the title, best first."""
    return _plain(search(index(graph, "document"), Phrase(" ".join(_P)), 50))


@_query(f"{_index_sql('article')}{_leaf_sql('q', _P, True)} {_TOP('q', 50)}")
def b12_fulltext_article_text(graph: PropertyGraph) -> DataFrame:
    """Articles with a phrase, best first."""
    return _plain(search(index(graph, "article"), Phrase(" ".join(_P)), 50))


@_query(f"{_index_sql('content')}{_leaf_sql('q', _P, True)} {_TOP('q', 50)}")
def b13_fulltext_content_text(graph: PropertyGraph) -> DataFrame:
    """Attached contents with a phrase in the title, best first."""
    return _plain(search(index(graph, "content"), Phrase(" ".join(_P)), 50))


_DUTY = ["trach", "nhiem"]


@_query(f"{_index_sql('article')}{_leaf_sql('q', _DUTY, True)} SELECT q.key, a.heading, round(score, 9) AS score FROM q JOIN article a ON a.article_id = q.key")
def s14_fulltext_article(graph: PropertyGraph) -> DataFrame:
    """Every article with a phrase, with its heading and score."""
    hits = search(index(graph, "article"), Phrase(" ".join(_DUTY)))
    return hits.join(graph.article.select(F.col("article_id").alias("key"), "heading"), "key").select("key", "heading", "score")


_BAG = "Học bổng và học phí: biểu mẫu nào?"
_BAGW = ["hoc", "bong", "va", "phi", "bieu", "mau", "nao"]


@_query(f"{_index_sql('document')}{_leaf_sql('q', _BAGW, False)} {_TOP('q', 20)}")
def tpl_document_fulltext_search(graph: PropertyGraph) -> DataFrame:
    """Documents by the bag of words of a question."""
    return _plain(search(index(graph, "document"), any_of(_BAG), 20))


@_query(
    f"{_index_sql('article')}{_leaf_sql('q', _P, True)}{''.join(_leaf_sql('t' + w, [w], False) for w in _P)}, al AS (SELECT key, sum(score) AS score FROM ("
    + " UNION ALL ".join(f"SELECT key, score FROM t{w}" for w in _P)
    + f") GROUP BY key HAVING count(*) = {len(_P)}), bo AS (SELECT key, sum(score) AS score FROM (SELECT key, 2 * score AS score FROM q UNION ALL SELECT * FROM al) GROUP BY key) {_TOP('bo', 20)}"
)
def tpl_article_fulltext_search(graph: PropertyGraph) -> DataFrame:
    """Articles by a boosted phrase or all of its words."""
    return _plain(search(index(graph, "article"), phrase_or_all(_PHRASE), 20))


@_query(f"{_index_sql('content')}{_leaf_sql('q', ['hoc', 'bong'], False)} {_TOP('q', 20)}")
def tpl_content_title_search(graph: PropertyGraph) -> DataFrame:
    return _plain(search(index(graph, "content"), any_of("học bổng"), 20))


def _article_search(graph: PropertyGraph, docs: DataFrame | None, k: int = 20) -> DataFrame:
    """The best articles of the whole index first, then those of ``docs`` (doc_key): weights stay corpus-wide."""
    hits = search(index(graph, "article"), Phrase(" ".join(_P))).join(graph.article.select(F.col("article_id").alias("key"), "doc_key"), "key")
    if docs is not None:
        hits = hits.join(docs.select("doc_key").distinct(), "doc_key", "left_semi")
    return hits.orderBy(F.desc("score"), "key").limit(k).select("key", "doc_key", "score")


def _in_docs(where: str) -> str:
    return f"{_index_sql('article')}{_leaf_sql('q', _P, True)} SELECT key, a.doc_key, round(score, 9) AS score FROM q JOIN article a ON a.article_id = key WHERE {where} ORDER BY round(score, 9) DESC, key LIMIT 20"


@_query(_in_docs("a.doc_key IN (SELECT doc_key FROM document WHERE status = 'CON_HIEU_LUC')"))
def tpl_article_search_active(graph: PropertyGraph) -> DataFrame:
    return _article_search(graph, graph.document.where("status = 'CON_HIEU_LUC'"))


@_query(_in_docs("a.doc_key IN (SELECT doc_key FROM issued_by WHERE org_id = 'bo_hoc_chinh')"))
def tpl_article_search_by_org(graph: PropertyGraph) -> DataFrame:
    return _article_search(graph, graph.issued_by.where("org_id = 'bo_hoc_chinh'"))


@_query(_in_docs("a.doc_key IN (SELECT doc_key FROM applies_to WHERE target_group <= 'DV-0000010')"))
def tpl_article_search_for_group(graph: PropertyGraph) -> DataFrame:
    return _article_search(graph, graph.applies_to.where("target_group <= 'DV-0000010'"))


@_query(_in_docs("a.doc_key IN (SELECT doc_key FROM topic WHERE topic = 'Khen thưởng')"))
def tpl_article_search_by_topic(graph: PropertyGraph) -> DataFrame:
    return _article_search(graph, graph.topic.where("topic = 'Khen thưởng'"))


@_query(_in_docs("a.doc_key = (SELECT min(doc_key) FROM article WHERE text LIKE '%danh mục tạp chí%')"))
def tpl_doc_article_search(graph: PropertyGraph) -> DataFrame:
    return _article_search(graph, graph.article.where(F.col("text").contains(_PHRASE)).agg(F.min("doc_key").alias("doc_key")))


@_query(
    f"{_index_sql('document')}{_leaf_sql('q', _BAGW, False)} SELECT key AS doc_key, round(score, 9) AS score, d.issue_date FROM q JOIN document d ON d.doc_key = key WHERE round(score, 9) >= 0.6 * (SELECT max(round(score, 9)) FROM q) "
    "AND d.status = 'CON_HIEU_LUC' AND NOT EXISTS (SELECT 1 FROM edge e WHERE e.dst = key AND e.rel IN ('REPLACES', 'REPEALS')) ORDER BY d.issue_date IS NULL, d.issue_date DESC, key LIMIT 10"
)
def tpl_latest_doc_about(graph: PropertyGraph) -> DataFrame:
    """Good hits that are in force and that nothing replaced or repealed, newest first."""
    hits = search(index(graph, "document"), any_of(_BAG))
    best = hits.agg(F.max("score").alias("top"))
    good = hits.join(F.broadcast(best)).where(F.col("score") >= 0.6 * F.col("top")).select(F.col("key").alias("doc_key"), "score")
    over = graph.edge.where("rel in ('REPLACES', 'REPEALS')").select(F.col("dst").alias("doc_key"))
    live = good.join(graph.document.where("status = 'CON_HIEU_LUC'").select("doc_key", "issue_date"), "doc_key").join(over, "doc_key", "left_anti")
    return live.orderBy(F.col("issue_date").desc_nulls_last(), "doc_key").limit(10).select("doc_key", "score", "issue_date")


def _hop(rels: str, back: bool) -> str:
    a, b = ("dst", "src") if back else ("src", "dst")
    return (
        f"{_index_sql('document')}{_leaf_sql('q', _BAGW, False)}, s0 AS (SELECT key FROM q ORDER BY round(score, 9) DESC, key LIMIT 10), n1 AS (SELECT DISTINCT e.{b} AS key FROM s0 JOIN edge e ON e.{a} = s0.key AND e.rel IN ({rels})), "
        f"n2 AS (SELECT DISTINCT e.{b} AS key FROM n1 JOIN edge e ON e.{a} = n1.key AND e.rel IN ({rels})) SELECT d.doc_key, d.level FROM (SELECT * FROM s0 UNION SELECT * FROM n1 UNION SELECT * FROM n2) u "
        "JOIN document d ON d.doc_key = u.key ORDER BY d.level DESC NULLS LAST, d.doc_key LIMIT 50"
    )


def _expanded(graph: PropertyGraph, rels: tuple[str, ...], back: bool) -> DataFrame:
    seeds = search(index(graph, "document"), any_of(_BAG), 10).select(F.col("key").alias("node"))
    e = graph.edge.where(F.col("rel").isin(*rels))
    e = e.select(F.col("dst").alias("src"), "rel", F.col("src").alias("dst")) if back else e
    near = trails(e, 0, 2, seeds).select(F.col("end").alias("doc_key")).distinct()
    return near.join(graph.document.select("doc_key", "level"), "doc_key").orderBy(F.col("level").desc_nulls_last(), "doc_key").limit(50)


@_query(_hop("'BASED_ON', 'REFERENCES'", False))
def tpl_hybrid_fulltext_expand(graph: PropertyGraph) -> DataFrame:
    """The best documents and their bases and references within two hops, by authority."""
    return _expanded(graph, ("BASED_ON", "REFERENCES"), False)


@_query(_hop("'BASED_ON', 'REFERENCES', 'REPLACES', 'AMENDS', 'REPEALS'", True))
def b15_hybrid_expand_incoming(graph: PropertyGraph) -> DataFrame:
    """The best documents and whatever cites them within two hops."""
    return _expanded(graph, ("BASED_ON", "REFERENCES", "REPLACES", "AMENDS", "REPEALS"), True)


_ROLL = "rolled AS (SELECT a.doc_key AS key, max(score) AS score FROM (SELECT key, score FROM qa ORDER BY round(score, 9) DESC, key LIMIT 500) x JOIN article a ON a.article_id = x.key GROUP BY a.doc_key)"
_FULL = (
    f"{_index_sql('document', '1')}{_leaf_sql('qd', ['hoc', 'bong'], False, '1')}{_index_sql('article', '2')}{_leaf_sql('qa', ['hoc', 'bong'], False, '2')}, {_ROLL}, "
    f"l0 AS ({_TOP('qd', 500)}), l1 AS ({_TOP('rolled', 500)}), full_ AS (SELECT key, sum(1.0 / (60 + rank)) AS score FROM (SELECT key, rank FROM l0 UNION ALL SELECT key, rank FROM l1) GROUP BY key)"
)


def bm25_full(graph: PropertyGraph, query: object) -> DataFrame:
    """Titles and articles (rolled up to documents by their best) fused by rank."""
    titles = search(index(graph, "document"), query, 500)
    arts = search(index(graph, "article"), query, 500).join(graph.article.select(F.col("article_id").alias("key"), "doc_key"), "key")
    rolled = ranked(arts.groupBy(F.col("doc_key").alias("key")).agg(F.max("score").alias("score")))
    return fuse([titles, rolled])


@_query(f"{_FULL} {_TOP('full_', 20)}")
def bm25_full_search(graph: PropertyGraph) -> DataFrame:
    fused = bm25_full(graph, any_of("học bổng")).select("key", F.round("score", 9).alias("score"))
    return _plain(ranked(fused.orderBy(F.desc("score"), "key").limit(20)))


_VEC = (
    ", dv AS (SELECT doc_key, rec_id AS vec_id FROM document WHERE is_stub = 0), qv AS (SELECT embedding::DOUBLE[] AS q FROM embeddings WHERE vec_id = 0), "
    "sim AS (SELECT doc_key AS key, round(list_cosine_similarity(embedding::DOUBLE[], q), 9) AS score FROM embeddings JOIN dv USING (vec_id) CROSS JOIN qv), l2 AS (SELECT key, score, row_number() OVER (ORDER BY score DESC, key) AS rank FROM sim QUALIFY rank <= 500)"
)


def _vectors(graph: PropertyGraph) -> DataFrame:
    """(key, doc_key, vector): the embeddings of the real documents, by the id of their record."""
    docs = graph.document.where("is_stub = 0 and rec_id is not null").select("doc_key", F.col("rec_id").alias("key"))
    vec = graph._table("embeddings").select(F.col("vec_id").alias("key"), F.col("embedding").alias("vector"))
    return vec.join(docs, "key")


def _vector_list(graph: PropertyGraph) -> DataFrame:
    v = _vectors(graph)
    query = graph._table("embeddings").where("vec_id = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vector"))
    near = cosine_top(v.select("key", "vector"), query, 500).join(v.select("key", "doc_key"), "key")
    return ranked(near.select(F.col("doc_key").alias("key"), "score"))


@_query(f"{_VEC} SELECT key, score, rank FROM l2 WHERE rank <= 20")
def vector_search(graph: PropertyGraph) -> DataFrame:
    """The documents nearest to a vector by cosine."""
    return _plain(_vector_list(graph).where("rank <= 20"))


_HYB = f"{_FULL}{_VEC}, lf AS (SELECT key, row_number() OVER (ORDER BY round(score, 9) DESC, key) AS rank FROM full_), hy AS (SELECT key, sum(1.0 / (60 + rank)) AS score FROM (SELECT key, rank FROM lf UNION ALL SELECT key, rank FROM l2) GROUP BY key)"


def _hybrid(graph: PropertyGraph) -> DataFrame:
    full = ranked(bm25_full(graph, any_of("học bổng")).select("key", F.round("score", 9).alias("score")))
    return ranked(fuse([full, _vector_list(graph)]).select("key", F.round("score", 9).alias("score")))


@_query(f"{_HYB} {_TOP('hy', 20)}")
def hybrid_search(graph: PropertyGraph) -> DataFrame:
    """Lexical and vector lists fused by rank."""
    return _plain(_hybrid(graph).where("rank <= 20"))


@_query(
    f"{_HYB}, r AS ({_TOP('hy', 20)}), sd AS (SELECT key FROM r WHERE rank <= 5), ue AS (SELECT src AS a, dst AS b FROM edge UNION SELECT dst, src FROM edge), "
    "nb AS (SELECT b AS key, count(DISTINCT a) AS n FROM ue WHERE a IN (SELECT key FROM sd) AND b NOT IN (SELECT key FROM sd) GROUP BY b ORDER BY n DESC, b LIMIT 10), "
    "al AS (SELECT key, 0 AS block, rank AS pos FROM r WHERE rank <= 5 UNION ALL SELECT key, 1, row_number() OVER (ORDER BY n DESC, key) FROM nb UNION ALL SELECT key, 2, rank FROM r WHERE rank > 5) "
    "SELECT key, row_number() OVER (ORDER BY block, pos) AS rank FROM (SELECT key, min(block) AS block, arg_min(pos, block) AS pos FROM al GROUP BY key) QUALIFY rank <= 20"
)
def hybrid_kg_search(graph: PropertyGraph) -> DataFrame:
    """The head of the hybrid list, then what is linked to most of it, then the rest."""
    r = _hybrid(graph).where("rank <= 20")
    head = r.where("rank <= 5")
    near = expand_once(graph.edge, head).orderBy(F.desc("n"), "key").limit(10)
    near = near.select("key", F.lit(1).alias("block"), F.row_number().over(Window.orderBy(F.desc("n"), "key")).alias("pos"))
    block = F.when(F.col("rank") <= 5, 0).otherwise(2)
    every = r.select("key", block.alias("block"), F.col("rank").alias("pos")).unionByName(near)
    first = every.groupBy("key").agg(F.min(F.struct("block", "pos")).alias("x"))
    return first.select("key", F.row_number().over(Window.orderBy("x.block", "x.pos")).alias("rank")).where("rank <= 20")


_RULES = {
    "s21_gpa_rule": ("diem", ["hoc ky", "hoc phan"]), "s22_academic_warning": ("vi pham", ["hoc ky", "buoi"]), "s23_valid_absence_procedure": ("vang qua", ["buoi", "don"]),
    "s24_graduation_conditions": ("tot nghiep", ["ho so", "tien do"]), "s25_graduation_ranking": ("xep loai", ["cuoi nam", "diem"]), "s26_foreign_language_exit": ("ngoai van", ["chung chi", "bang diem"]),
    "s27_credit_load_limits": ("tin chi", ["hoc phan", "hoc ky"]), "s28_double_degree": ("chuong trinh", ["dao luyen", "trao doi"]), "s29_merit_scholarship": ("hoc bong", ["khuyen hoc", "diem"]),
    "s30_exam_impersonation": ("thi lai", ["ban coi thi", "danh sach"]), "s31_tuition_exemption": ("muc thu", ["hoc phi", "noi tru"]),
}


def _boolean(name: str, must: str, some: list[str]):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        """Documents by their best article under (must AND (a OR b)), without those replaced or repealed."""
        graph = PropertyGraph.of(spark, folder)
        leaf = lambda p: Phrase(p) if " " in p else Term(p)
        hits = And((leaf(must), Or(tuple(leaf(p) for p in some)))).scores(index(graph, "article"), 1.5, 0.75)
        docs = hits.join(graph.article.select(F.col("article_id").alias("key"), "doc_key"), "key").groupBy("doc_key").agg(F.round(F.max("score"), 9).alias("score"))
        over = graph.edge.where("rel in ('REPLACES', 'REPEALS')").select(F.col("dst").alias("doc_key"))
        return docs.join(over, "doc_key", "left_anti").orderBy(F.desc("score"), "doc_key").limit(10)

    leaves = "".join(_leaf_sql(f"z{k}", p.split(), " " in p) for k, p in enumerate([must, *some]))
    either = " UNION ALL ".join(f"SELECT * FROM z{k + 1}" for k in range(len(some)))
    sql = (
        f"{_index_sql('article')}{leaves}, ei AS (SELECT key, sum(score) AS score FROM ({either}) GROUP BY key), bo AS (SELECT z0.key, z0.score + ei.score AS score FROM z0 JOIN ei ON ei.key = z0.key) "
        "SELECT a.doc_key, round(max(score), 9) AS score FROM bo JOIN article a ON a.article_id = bo.key WHERE a.doc_key NOT IN (SELECT dst FROM edge WHERE rel IN ('REPLACES', 'REPEALS')) GROUP BY a.doc_key ORDER BY score DESC, a.doc_key LIMIT 10"
    )
    QUERIES[name], ORACLE[name] = query, f"WITH RECURSIVE {VIEWS_SQL} {sql}"


for _name, (_must, _some) in _RULES.items():
    _boolean(_name, _must, _some)


@_query(
    ", sc AS (SELECT e.vec_id, e.label, list_cosine_similarity(e.embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 1)) AS s FROM embeddings e) "
    "SELECT label, vec_id AS key, round(s, 9) AS score FROM sc QUALIFY row_number() OVER (PARTITION BY label ORDER BY round(s, 9) DESC, vec_id) <= 3"
)
def scoped_nearest(graph: PropertyGraph) -> DataFrame:
    """The three nearest vectors of every label."""
    e = graph._table("embeddings")
    query = e.where("vec_id = 1").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vector"))
    near = cosine_top(e.select(F.col("vec_id").alias("key"), F.col("embedding").alias("vector"), "label"), query, 3, scope="label")
    return near.select(F.col("label").cast("int").alias("label"), "key", "score")


@_query(
    ", m AS (SELECT e.vec_id AS key, round(list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 9) AS score, q.vec_id AS qid FROM embeddings e CROSS JOIN embeddings q WHERE q.vec_id % 50 = 0) "
    "SELECT qid, key, score FROM m QUALIFY row_number() OVER (PARTITION BY qid ORDER BY score DESC, key) <= 10"
)
def nearest_vectors(graph: PropertyGraph) -> DataFrame:
    """The ten nearest vectors of every vector whose id is divisible by 50."""
    e = graph._table("embeddings").select(F.col("vec_id").alias("key"), F.col("embedding").alias("vector"))
    queries = e.where("key % 50 = 0").select(F.col("key").alias("qid"), "vector")
    return cosine_top(e, queries, 10).select("qid", "key", "score")


def context(graph: PropertyGraph, query: object, budget: int = 6000, clip: int = 1500) -> DataFrame:
    """(doc, taken): evidence for a question, articles by document in order of the best, packed greedily under ``budget`` characters."""
    hits = search(index(graph, "article"), query, 40).join(graph.article.where("implements = 0").select(F.col("article_id").alias("key"), "doc_key", "text"), "key")
    docs = hits.groupBy("doc_key").agg(F.min("rank").alias("best"), F.transform(F.array_sort(F.collect_list(F.struct("rank", "text"))), lambda x: x["text"]).alias("texts"))
    line = docs.agg(F.array_sort(F.collect_list(F.struct("best", F.col("doc_key").alias("doc"), "texts"))).alias("docs"))
    packed = line.select(F.posexplode(pack(F.transform("docs", lambda x: F.struct(x["doc"].alias("doc"), x["texts"].alias("texts"))), budget, clip)).alias("pos", "x"))
    return packed.select(F.col("pos").alias("pos"), F.col("x.doc").alias("doc_key"), F.size("x.taken").alias("n_articles"), F.length(F.array_join("x.taken", "")).alias("n_chars"))


@_query()
def packed_context(graph: PropertyGraph) -> DataFrame:
    """The evidence taken for a question, per document."""
    return context(graph, any_of("học bổng khuyến học"))
