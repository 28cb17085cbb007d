"""The registry of parameterised questions over the property graph.

A template is SQL over the graph's views with bound parameters (``:name``). ``{facets}`` stands for
the optional conditions; only those whose parameter is given become part of the plan. ``SET(x)`` is
the sorted distinct values of x in a group, joined. Questions that walk chains or search text are
built from the operators in ``quillmesh.operators`` instead (see ``plans.walks`` and ``plans.find``).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from quillmesh.plans.graph import VIEWS_SQL, PropertyGraph

ROW_CAP = 200
DOC = "d.doc_key, d.title, d.doc_type, d.status, d.issue_date"
NEWEST = "ORDER BY d.issue_date IS NULL, d.issue_date DESC, d.doc_key"
#: The optional conditions on a document d.
FACETS = {
    "org": "EXISTS (SELECT 1 FROM issued_by i WHERE i.doc_key = d.doc_key AND (i.org_id = :org OR substring(i.org_id, 1, length(:org) + 1) = :org || '_'))",
    "topic": "EXISTS (SELECT 1 FROM topic t WHERE t.doc_key = d.doc_key AND t.topic = :topic)",
    "target_group": "EXISTS (SELECT 1 FROM applies_to g WHERE g.doc_key = d.doc_key AND g.target_group = :target_group)",
    "status": "d.status = :status",
    "doc_type": "d.doc_type = :doc_type",
    "year": "substring(d.issue_date, 1, 4) = :year",
    "since_year": "substring(d.issue_date, 1, 4) >= :since_year",
}


@dataclass(frozen=True)
class Template:
    name: str
    level: int
    action: str
    sql: str
    required: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()
    example: dict = field(default_factory=dict)


REGISTRY: dict[str, Template] = {}
#: Parameters of the examples that are looked up in the graph.
LOOKUP = {
    "citing": "SELECT min(src) FROM edge WHERE rel = 'BASED_ON' AND hits > 1",
    "amended": "SELECT min(dst) FROM edge WHERE rel = 'AMENDS'",
    "amender": "SELECT min(src) FROM edge WHERE rel = 'AMENDS'",
    "replaced": "SELECT min(dst) FROM edge WHERE rel = 'REPLACES'",
    "repealed": "SELECT min(dst) FROM edge WHERE rel = 'REPEALS'",
    "repealer": "SELECT min(src) FROM edge WHERE rel = 'REPEALS'",
    "cited": "SELECT min(dst) FROM edge WHERE rel = 'REFERENCES'",
    "signed": "SELECT min(doc_key) FROM signed_by",
    "issued": "SELECT min(doc_key) FROM issued_by",
    "with_articles": "SELECT min(doc_key) FROM article WHERE content_id IS NOT NULL",
    "implementing": "SELECT min(doc_key) FROM article WHERE implements = 1",
    "person": "SELECT min(person_id) FROM signed_by",
    "unit": "SELECT min(target_group) FROM applies_to",
    "mentioning": "SELECT min(doc_key) FROM mention",
    "content_type": "SELECT min(content_type) FROM content",
}


def template(name: str, level: int, action: str, sql: str, optional: str = "", **example) -> None:
    required = tuple(p for p in dict.fromkeys(re.findall(r":(\w+)", sql)) if p != "limit")
    REGISTRY[name] = Template(name, level, action, sql, required, tuple(optional.split()), example)


def _clamped(params: dict) -> dict:
    if "limit" in params:
        return params | {"limit": max(1, min(int(params["limit"]), ROW_CAP))}
    return params


def _text(t: Template, params: dict) -> str:
    missing = [p for p in t.required if p not in params]
    if missing:
        raise ValueError(f"{t.name} needs {', '.join(missing)}")
    given = [FACETS[f] for f in t.optional if params.get(f) is not None]
    return t.sql.replace("{facets}", " AND ".join(given) or "TRUE")


def _set(sql: str, dialect: str) -> str:
    """SET(x) in the words of an engine; x may have brackets of its own, also in quotes."""
    out, rest = "", sql
    while "SET(" in rest:
        head, _, rest = rest.partition("SET(")
        depth, end = 1, 0
        while depth:
            depth += {"(": 1, ")": -1}.get(rest[end], 0)
            end += 1
        x, rest = rest[: end - 1], rest[end:]
        if dialect == "spark":
            out += f"{head}array_join(array_sort(collect_set({x})), ', ')"
        else:
            out += f"{head}coalesce(array_to_string(list_sort(list_distinct(list({x}))), ', '), '')"
    return out + rest


def ask(graph: PropertyGraph, name: str, **params) -> DataFrame:
    """The lazy result of a template with its parameters bound; unknown parameters are an error."""
    t = REGISTRY[name]
    params = _clamped({k: v for k, v in params.items() if v is not None})
    extra = set(params) - set(t.required) - set(t.optional) - {"limit"}
    if extra:
        raise ValueError(f"{name} has no parameter {', '.join(sorted(extra))}")
    sql = _set(_text(t, params), "spark")
    used = {p: params[p] for p in set(re.findall(r":(\w+)", sql))}
    views = graph.views(sql)
    for v, df in views.items():
        df.createOrReplaceTempView(v)
    return graph.spark.sql(sql, args=used)


def run_example(name: str):
    """The template's example as a query (spark, folder)."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        graph = PropertyGraph.of(spark, folder)
        params = {}
        for p, v in REGISTRY[name].example.items():
            if isinstance(v, str) and v.startswith("?"):
                sql = LOOKUP[v[1:]]
                for view, df in graph.views(sql).items():
                    df.createOrReplaceTempView(view)
                v = spark.sql(sql).first()[0]
            params[p] = v
        return ask(graph, name, **params)

    query.__name__ = name
    return query


def example_sql(name: str) -> str:
    """The example as one DuckDB statement."""
    t = REGISTRY[name]
    params = _clamped(t.example)
    sql = _set(_text(t, params), "duckdb")
    for p in sorted(params, key=len, reverse=True):
        v = params[p]
        text = f"({LOOKUP[v[1:]]})" if isinstance(v, str) and v.startswith("?") else str(v) if isinstance(v, int) else f"'{v}'"
        sql = re.sub(rf":{p}\b", lambda _, text=text: text, sql)
    return f"WITH RECURSIVE {VIEWS_SQL} {sql}"


def _docs(where: str) -> str:
    return f"SELECT {DOC} FROM document d WHERE {where} {NEWEST} LIMIT :limit"


def _relation(rel: str, out: bool, extra: str = "") -> str:
    a, b = ("src", "dst") if out else ("dst", "src")
    return f"SELECT {DOC}{extra} FROM edge e JOIN document d ON d.doc_key = e.{b} WHERE e.{a} = :doc_number AND e.rel IN ({rel}) {NEWEST}, e.rel LIMIT :limit"


# --- documents by facet
template("tpl_docs_by_org_status", 1, "list_documents", _docs(FACETS["org"] + " AND {facets}"), "status", org="bo_hoc_chinh", status="CON_HIEU_LUC", limit=50)
template("tpl_docs_by_topic", 1, "list_documents", _docs(FACETS["topic"] + " AND {facets}"), "status", topic="Khen thưởng", limit=50)
template("tpl_docs_by_target_group", 1, "list_documents", _docs(FACETS["target_group"] + " AND {facets}"), "status", target_group="?unit", limit=50)
template("tpl_docs_by_type", 1, "list_documents", _docs(FACETS["doc_type"] + " AND {facets}"), "status", doc_type="Quyết định", limit=50)
template("tpl_docs_by_year", 1, "list_documents", _docs(FACETS["year"] + " AND {facets}"), "status", year="2015", limit=50)
template("tpl_docs_recent", 1, "recent_documents", _docs("d.is_stub = 0 AND d.issue_date IS NOT NULL"), limit=10)
template("tpl_docs_by_signer", 1, "documents_signed_by", f"SELECT {DOC} FROM document d JOIN signed_by s ON s.doc_key = d.doc_key WHERE s.person_id = :person {NEWEST} LIMIT :limit", person="?person", limit=50)
template(
    "tpl_docs_signed_by_position", 2, "documents_signed_by",
    f"SELECT DISTINCT {DOC} FROM document d JOIN signed_by s ON s.doc_key = d.doc_key JOIN person p ON p.person_id = s.person_id "
    f"WHERE array_contains(p.positions, :position) AND {{facets}} {NEWEST} LIMIT :limit",
    "org", position="Trưởng phòng", org="bo_hoc_chinh", limit=20,
)
template("tpl_docs_filtered", 2, "list_documents", _docs("{facets}"), "org topic target_group status doc_type year", org="bo_hoc_chinh", status="CON_HIEU_LUC", topic="Khen thưởng", limit=50)
template("tpl_docs_since_year", 2, "list_documents", _docs(FACETS["since_year"] + " AND {facets}"), "org topic status", since_year="2018", status="HET_HIEU_LUC", limit=50)
template("tpl_count_docs", 2, "count_documents", "SELECT count(*) AS n FROM document d WHERE {facets}", "org topic target_group status doc_type year", org="bo_hoc_chinh", status="CON_HIEU_LUC")
template(
    "tpl_docs_mentioning_org", 2, "documents_mentioning_org",
    f"SELECT DISTINCT {DOC} FROM document d JOIN mention m ON m.doc_key = d.doc_key WHERE m.org_id = :org {NEWEST} LIMIT :limit", org="bo_hoc_chinh", limit=50,
)
template(
    "tpl_superseded_docs", 3, "superseded_documents",
    "SELECT d.doc_key, d.status, d.is_stub, SET(e.src || ' (' || e.rel || ')') AS superseded_by FROM document d LEFT JOIN edge e ON e.dst = d.doc_key AND e.rel IN ('REPLACES', 'REPEALS') "
    "WHERE {facets} GROUP BY d.doc_key, d.status, d.is_stub, d.issue_date HAVING count(e.src) > 0 OR d.status = 'HET_HIEU_LUC' ORDER BY d.issue_date IS NULL, d.issue_date DESC, d.doc_key LIMIT :limit",
    "org", org="bo_hoc_chinh", limit=50,
)
# --- one document
template(
    "tpl_document_detail", 1, "document_detail",
    f"SELECT {DOC}, (SELECT SET(o.org_name) FROM issued_by i JOIN org o ON o.org_id = i.org_id WHERE i.doc_key = :doc_number) AS issuers, "
    "(SELECT SET(p.full_name) FROM signed_by s JOIN person p ON p.person_id = s.person_id WHERE s.doc_key = :doc_number) AS signers, "
    "(SELECT SET(t.topic) FROM topic t WHERE t.doc_key = :doc_number) AS topics FROM document d WHERE d.doc_key = :doc_number",
    doc_number="?signed",
)
template(
    "tpl_doc_status", 1, "document_status",
    "SELECT d.doc_key, d.status, CASE WHEN count(CASE WHEN e.rel = 'REPLACES' THEN 1 END) > 0 THEN 'REPLACED' WHEN count(CASE WHEN e.rel = 'REPEALS' THEN 1 END) > 0 THEN 'REPEALED' "
    "WHEN d.status = 'HET_HIEU_LUC' THEN 'EXPIRED' WHEN count(CASE WHEN e.rel = 'AMENDS' THEN 1 END) > 0 THEN 'AMENDED' WHEN d.status = 'CON_HIEU_LUC' THEN 'IN_FORCE' ELSE 'UNKNOWN' END AS verdict, "
    "SET(e.rel || ' ' || e.src) AS incoming FROM document d LEFT JOIN edge e ON e.dst = d.doc_key AND e.rel IN ('REPLACES', 'REPEALS', 'AMENDS') WHERE d.doc_key = :doc_number GROUP BY d.doc_key, d.status",
    doc_number="?replaced",
)
template(
    "tpl_doc_signer", 1, "document_signer",
    "SELECT p.full_name, p.academic_title, array_join(p.positions, ', ') AS positions, o.org_name FROM signed_by s JOIN person p ON p.person_id = s.person_id "
    "LEFT JOIN issued_by i ON i.doc_key = s.doc_key LEFT JOIN org o ON o.org_id = i.org_id WHERE s.doc_key = :doc_number", doc_number="?signed",
)
template(
    "tpl_doc_topics_targets", 1, "document_applies_to",
    "SELECT d.doc_key, (SELECT SET(t.topic) FROM topic t WHERE t.doc_key = :doc_number) AS topics, (SELECT SET(g.target_group) FROM applies_to g WHERE g.doc_key = :doc_number) AS target_groups "
    "FROM document d WHERE d.doc_key = :doc_number", doc_number="?signed",
)
_ANCESTORS = (
    "SELECT o.org_name AS o0, p1.org_name AS o1, p2.org_name AS o2, p3.org_name AS o3, p4.org_name AS o4 FROM org o LEFT JOIN org p1 ON p1.org_name = o.parent_org "
    "LEFT JOIN org p2 ON p2.org_name = p1.parent_org LEFT JOIN org p3 ON p3.org_name = p2.parent_org LEFT JOIN org p4 ON p4.org_name = p3.parent_org"
)
template("tpl_doc_issuer_hierarchy", 2, "document_issuer", f"{_ANCESTORS} JOIN issued_by i ON i.org_id = o.org_id WHERE i.doc_key = :doc_number", doc_number="?issued")
_ART = "SELECT a.article_id, a.number, a.heading, a.content_id FROM article a WHERE a.doc_key = :doc_number"
_ART_ORDER = "ORDER BY a.content_id IS NOT NULL, coalesce(a.number, 9999), a.article_id"
template("tpl_doc_article_list", 2, "document_articles", f"{_ART} {_ART_ORDER} LIMIT :limit", doc_number="?with_articles", limit=100)
template("tpl_doc_article_text", 2, "article_text", "SELECT a.article_id, a.heading, a.text FROM article a WHERE a.doc_key = :doc_number AND a.number = :article_number", doc_number="?with_articles", article_number=1)
template("tpl_doc_scope_articles", 2, "document_scope", f"{_ART} AND (lower(a.heading) LIKE '%phạm vi%' OR lower(a.heading) LIKE '%đối tượng%') {_ART_ORDER}", doc_number="?with_articles")
template("tpl_doc_implementation_clauses", 2, "document_implementation", f"{_ART} AND a.implements = 1 {_ART_ORDER}", doc_number="?implementing")
template(
    "tpl_doc_promulgated_content", 2, "document_contents",
    "SELECT c.content_id, c.title, c.content_type, count(a.article_id) AS n_articles FROM content c LEFT JOIN article a ON a.content_id = c.content_id WHERE c.doc_key = :doc_number GROUP BY c.content_id, c.title, c.content_type",
    doc_number="?with_articles",
)
template("tpl_doc_mentioned_orgs", 2, "document_mentions", "SELECT o.org_id, o.org_name FROM mention m JOIN org o ON o.org_id = m.org_id WHERE m.doc_key = :doc_number ORDER BY o.org_name LIMIT :limit", doc_number="?mentioning", limit=50)
# --- relations
template("tpl_doc_legal_basis", 2, "document_legal_basis", _relation("'BASED_ON'", True), doc_number="?citing", limit=50)
template("tpl_doc_references", 2, "document_references", _relation("'REFERENCES'", True), doc_number="?citing", limit=50)
template("tpl_doc_cited_by", 2, "document_cited_by", _relation("'BASED_ON', 'REFERENCES'", False, ", e.rel"), doc_number="?cited", limit=50)
template("tpl_replaced_by", 2, "replaced_by", _relation("'REPLACES'", False), doc_number="?replaced", limit=50)
template("tpl_doc_amended_by", 2, "amended_by", _relation("'AMENDS'", False, ", e.target_article"), doc_number="?amended", limit=50)
template("tpl_doc_repealed_by", 2, "repealed_by", _relation("'REPEALS'", False), doc_number="?repealed", limit=50)
template("tpl_doc_what_it_amends", 2, "what_it_amends", _relation("'AMENDS'", True, ", e.target_article"), doc_number="?amender", limit=50)
template("tpl_doc_what_it_repeals", 2, "what_it_repeals", _relation("'REPEALS'", True), doc_number="?repealer", limit=50)
template(
    "tpl_doc_all_relations", 3, "document_relations",
    "SELECT rel, direction, count(*) AS n, SET(CASE WHEN nth <= 10 THEN other END) AS first_ten FROM (SELECT rel, direction, other, row_number() OVER (PARTITION BY rel, direction ORDER BY other) AS nth FROM "
    "(SELECT rel, 'out' AS direction, dst AS other FROM edge WHERE src = :doc_number UNION SELECT rel, 'in', src FROM edge WHERE dst = :doc_number) u) v GROUP BY rel, direction",
    doc_number="?citing",
)
template(
    "tpl_doc_related", 4, "related_documents",
    "SELECT k AS doc_key, sum(points) AS score FROM (SELECT b.doc_key AS k, 2 * count(*) AS points FROM topic a JOIN topic b ON a.topic = b.topic AND b.doc_key <> a.doc_key WHERE a.doc_key = :doc_number GROUP BY b.doc_key "
    "UNION ALL SELECT b.doc_key, count(*) FROM applies_to a JOIN applies_to b ON a.target_group = b.target_group AND b.doc_key <> a.doc_key WHERE a.doc_key = :doc_number GROUP BY b.doc_key "
    "UNION ALL SELECT b.src, count(*) FROM edge a JOIN edge b ON a.dst = b.dst AND b.src <> a.src AND b.rel = 'BASED_ON' WHERE a.rel = 'BASED_ON' AND a.src = :doc_number GROUP BY b.src) x "
    "GROUP BY k HAVING sum(points) >= 3 ORDER BY sum(points) DESC, k LIMIT :limit",
    doc_number="?citing", limit=20,
)
template(
    "tpl_docs_sharing_basis", 5, "documents_sharing_basis",
    "SELECT b.src AS doc_key, count(DISTINCT b.dst) AS n_shared, SET(b.dst) AS shared FROM edge a JOIN edge b ON a.dst = b.dst AND b.src <> a.src AND b.rel = 'BASED_ON' "
    "WHERE a.rel = 'BASED_ON' AND a.src = :doc_number GROUP BY b.src HAVING count(DISTINCT b.dst) >= 2 ORDER BY count(DISTINCT b.dst) DESC, b.src LIMIT :limit", doc_number="?citing", limit=20,
)
# --- contents
template(
    "tpl_normative_content_by_type", 1, "list_contents",
    "SELECT c.content_id, c.title, c.status, c.doc_key FROM content c WHERE c.content_type = :content_type ORDER BY c.content_id LIMIT :limit", content_type="?content_type", limit=50,
)
# --- people and organisations
template(
    "tpl_top_orgs_by_doc_count", 1, "rank_orgs",
    "SELECT o.org_name, count(*) AS n FROM issued_by i JOIN org o ON o.org_id = i.org_id JOIN document d ON d.doc_key = i.doc_key WHERE d.is_stub = 0 GROUP BY o.org_name ORDER BY count(*) DESC, o.org_name LIMIT :limit", limit=10,
)
template(
    "tpl_person_profile", 1, "person_profile",
    "SELECT p.person_id, p.full_name, count(d.doc_key) AS n, min(d.issue_date) AS first_signed, max(d.issue_date) AS last_signed FROM person p JOIN signed_by s ON s.person_id = p.person_id "
    "JOIN document d ON d.doc_key = s.doc_key WHERE p.person_id = :person GROUP BY p.person_id, p.full_name", person="?person",
)
_SIGNERS = "FROM person p JOIN signed_by s ON s.person_id = p.person_id JOIN document d ON d.doc_key = s.doc_key"
template("tpl_top_signers", 2, "rank_signers", f"SELECT p.person_id, p.full_name, count(*) AS n {_SIGNERS} WHERE {{facets}} GROUP BY p.person_id, p.full_name ORDER BY count(*) DESC, p.person_id LIMIT :limit", "org", limit=20)
template(
    "tpl_signers_of_org", 2, "org_signers",
    f"SELECT p.person_id, p.full_name, count(*) AS n, min(d.issue_date) AS first_signed, max(d.issue_date) AS last_signed {_SIGNERS} WHERE {FACETS['org']} GROUP BY p.person_id, p.full_name ORDER BY count(*) DESC, p.person_id LIMIT :limit",
    org="bo_hoc_chinh", limit=50,
)
template(
    "tpl_org_profile", 2, "org_profile",
    "SELECT o.org_id, o.org_name, count(DISTINCT d.doc_key) AS n, max(d.issue_date) AS latest, (SELECT SET(x.topic) FROM (SELECT t.topic, row_number() OVER (ORDER BY count(DISTINCT t.doc_key) DESC, t.topic) AS nth "
    "FROM topic t JOIN issued_by i2 ON i2.doc_key = t.doc_key WHERE i2.org_id = :org GROUP BY t.topic) x WHERE x.nth <= 3) AS top_topics FROM org o LEFT JOIN issued_by i ON i.org_id = o.org_id "
    "LEFT JOIN document d ON d.doc_key = i.doc_key WHERE o.org_id = :org GROUP BY o.org_id, o.org_name", org="bo_hoc_chinh",
)
template(
    "tpl_org_subunits", 2, "org_structure",
    f"SELECT u.o0, u.o1, u.o2, u.o3, u.o4, (SELECT SET(k.org_name) FROM org k WHERE k.parent_org = u.o0) AS children FROM ({_ANCESTORS} WHERE o.org_id = :org) u".replace("u.o0) AS children", "(SELECT z.org_name FROM org z WHERE z.org_id = :org)) AS children"),
    org="bo_hoc_chinh",
)
template(
    "tpl_org_topic_breakdown", 3, "org_topic_breakdown",
    "SELECT t.topic, count(DISTINCT d.doc_key) AS n FROM document d JOIN topic t ON t.doc_key = d.doc_key WHERE " + FACETS["org"].replace(" t ", " t9 ") + " GROUP BY t.topic", org="bo_hoc_chinh",
)
# --- statistics
template("tpl_doc_distribution_by_status", 1, "status_distribution", "SELECT d.status, count(*) AS n FROM document d WHERE d.is_stub = 0 GROUP BY d.status")
template("tpl_doc_count_by_type", 1, "stats_by_type", "SELECT d.doc_type, count(*) AS n FROM document d WHERE d.is_stub = 0 GROUP BY d.doc_type")
template("tpl_doc_count_by_topic", 1, "stats_by_topic", "SELECT t.topic, count(DISTINCT d.doc_key) AS n FROM document d JOIN topic t ON t.doc_key = d.doc_key WHERE {facets} GROUP BY t.topic", "org")
template("tpl_doc_count_by_year", 2, "stats_by_year", "SELECT substring(d.issue_date, 1, 4) AS year, count(*) AS n FROM document d WHERE d.is_stub = 0 AND {facets} GROUP BY substring(d.issue_date, 1, 4)", "org topic")
template(
    "tpl_doc_count_by_authority_level", 2, "stats_by_authority_level",
    "SELECT level, sum(n) AS n, SET(CASE WHEN nth <= 5 THEN doc_type END) AS types FROM (SELECT d.level, d.doc_type, count(*) AS n, row_number() OVER (PARTITION BY d.level ORDER BY d.doc_type) AS nth "
    "FROM document d WHERE d.is_stub = 0 AND d.doc_type IS NOT NULL GROUP BY d.level, d.doc_type) x GROUP BY level",
)
template("tpl_citation_relation_counts", 2, "relation_counts", "SELECT rel, count(*) AS n, sum(hits) AS hits FROM edge GROUP BY rel")
template(
    "tpl_amends_target_still_active", 3, "amended_still_active",
    "SELECT d.doc_key, d.issue_date, SET(e.src) AS amended_by FROM edge e JOIN document d ON d.doc_key = e.dst WHERE e.rel = 'AMENDS' AND d.status = :status GROUP BY d.doc_key, d.issue_date "
    "ORDER BY d.issue_date IS NULL, d.issue_date DESC, d.doc_key LIMIT :limit", status="CON_HIEU_LUC", limit=50,
)
template("tpl_most_cited_docs", 3, "most_cited", "SELECT dst AS doc_key, count(*) AS n FROM edge WHERE rel = 'BASED_ON' GROUP BY dst ORDER BY count(*) DESC, dst LIMIT :limit", limit=20)
template(
    "tpl_missing_cited_docs", 4, "missing_documents",
    "SELECT d.doc_key, count(*) AS n, SET(e.rel) AS rels FROM document d JOIN edge e ON e.dst = d.doc_key WHERE d.is_stub = 1 GROUP BY d.doc_key ORDER BY count(*) DESC, d.doc_key LIMIT :limit", limit=20,
)
template(
    "tpl_org_citation_flow", 5, "org_citation_flow",
    "SELECT a.org_id AS from_org, b.org_id AS to_org, count(*) AS n FROM edge e JOIN issued_by a ON a.doc_key = e.src JOIN issued_by b ON b.doc_key = e.dst "
    "GROUP BY a.org_id, b.org_id ORDER BY count(*) DESC, a.org_id, b.org_id LIMIT :limit", limit=50,
)
# --- regression and performance catalogues, and scenarios that are no variant of the above
template("q_label_counts", 1, "counts", "SELECT 'Document' AS label, count(*) AS n FROM document UNION ALL SELECT 'Organization', count(*) FROM org UNION ALL SELECT 'Person', count(*) FROM person UNION ALL SELECT 'Article', count(*) FROM article UNION ALL SELECT 'NormativeContent', count(*) FROM content")
template("q_relation_counts", 1, "counts", "SELECT rel, count(*) AS n FROM edge GROUP BY rel UNION ALL SELECT 'ISSUED_BY', count(*) FROM issued_by UNION ALL SELECT 'SIGNED_BY', count(*) FROM signed_by UNION ALL SELECT 'HAS_TOPIC', count(*) FROM topic UNION ALL SELECT 'MENTIONS', count(*) FROM mention UNION ALL SELECT 'APPLIES_TO', count(*) FROM applies_to")
template("q12_mentions_count", 1, "counts", "SELECT count(*) AS total FROM mention")
template("q14_applies_to_count", 1, "counts", "SELECT count(*) AS total FROM applies_to")
template("s04_normative_content_active", 2, "scenario", "SELECT content_id, title FROM content WHERE content_type = :content_type AND status = :status", content_type="?content_type", status="CON_HIEU_LUC")
template("q_repeals_count", 1, "counts", "SELECT count(*) AS n FROM edge WHERE rel = 'REPEALS'")
template("q_stub_in_degree", 1, "counts", "SELECT d.doc_key, count(e.src) AS n FROM document d LEFT JOIN edge e ON e.dst = d.doc_key WHERE d.is_stub = 1 GROUP BY d.doc_key")
template("b4_normative_content_by_type", 1, "counts", "SELECT content_type, count(*) AS n FROM content GROUP BY content_type")
template("b6_top_persons", 1, "counts", "SELECT p.full_name, p.person_id, count(*) AS n FROM signed_by s JOIN person p ON p.person_id = s.person_id GROUP BY p.full_name, p.person_id ORDER BY count(*) DESC, p.person_id LIMIT :limit", limit=10)
template("b7_top_topics", 1, "counts", "SELECT topic, count(*) AS n FROM topic GROUP BY topic ORDER BY count(*) DESC, topic LIMIT :limit", limit=10)
template("b9_amends_target_article_completeness", 1, "counts", "SELECT target_article IS NOT NULL AS has_article, count(*) AS n FROM edge WHERE rel = 'AMENDS' GROUP BY target_article IS NOT NULL")
template("b16_top_cited_stubs", 1, "counts", "SELECT d.doc_key, count(e.src) AS n FROM document d LEFT JOIN edge e ON e.dst = d.doc_key WHERE d.is_stub = 1 GROUP BY d.doc_key ORDER BY count(e.src) DESC, d.doc_key LIMIT :limit", limit=10)
template("b17_documents_without_citations", 1, "counts", "SELECT d.doc_key FROM document d WHERE d.is_stub = 0 AND NOT EXISTS (SELECT 1 FROM edge e WHERE e.src = d.doc_key) ORDER BY d.doc_key LIMIT :limit", limit=100)
template(
    "s16_basis_of_org_docs", 4, "scenario",
    "SELECT t.doc_key, count(DISTINCT e.src) AS n FROM issued_by i JOIN edge e ON e.src = i.doc_key AND e.rel = 'BASED_ON' JOIN document t ON t.doc_key = e.dst WHERE i.org_id = :org "
    "AND (t.level >= 3 OR (t.is_stub = 1 AND regexp_like(t.doc_key, '^[0-9]+/.*$'))) GROUP BY t.doc_key ORDER BY count(DISTINCT e.src) DESC, t.doc_key LIMIT :limit", org="bo_hoc_chinh", limit=10,
)
template("s19_multi_facet_and", 3, "scenario", _docs(f"{FACETS['org']} AND {FACETS['topic']} AND {FACETS['status']}"), org="bo_hoc_chinh", topic="Khen thưởng", status="CON_HIEU_LUC", limit=50)
template(
    "s20_active_org_docs_that_amend", 3, "scenario",
    _docs(f"{FACETS['org']} AND d.status = 'CON_HIEU_LUC' AND EXISTS (SELECT 1 FROM edge e WHERE e.src = d.doc_key AND e.rel = 'AMENDS')"), org="bo_hoc_chinh", limit=50,
)

QUERIES = {name: run_example(name) for name in REGISTRY}


def _oracle(name: str) -> str:
    sql = example_sql(name)
    return sql.replace("array_join(", "array_to_string(").replace("regexp_like(", "regexp_matches(")


ORACLE = {name: _oracle(name) for name in REGISTRY}
