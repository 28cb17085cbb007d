"""Queries over the raw tables, written once as SQL with a few macros that each engine spells its own way.

Macros: FOLD(x) lower case without accents, SLUG(x), PLAIN(x) a document number in plain form,
ALL(x, 'pattern') all matches, ISO(x) a date, HAS(x, 'pattern') regular expression found, SET(x) the sorted
distinct values joined, SUM1(x) the number of true values, JSONLIST(x) an array of strings.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from quillmesh.functions.numbers import DASHES, PLAIN_NUMBER_SQL, nfc
from quillmesh.functions.text import _BARE, _MARKED
from quillmesh.plans.graph import FOLD_SQL, _ISO
from quillmesh.runtime import table

QUERIES, ORACLE = {}, {}
TABLES = (
    "docs parts articles article_evidence citations docs_seed organizations document_types aliases_seed chuan phieu_gan eval_items documents "
    "region nation customer supplier part orders lineitem events embeddings"
).split()

_SPARK_PLAIN = (
    "nullif(regexp_replace(regexp_replace(regexp_replace(translate(upper(nfc({0})), "
    f"'Ð{DASHES}', 'Đ{'-' * len(DASHES)}'), '[\\\\s\\\\p{{{{Z}}}}\\u0085\\u200b\\u200c\\u200d\\u2060\\ufeff]+', ''), "
    "'^SỐ[:.]?', ''), '^([^0-9]*)0+(?=[0-9])', '$1'), '')"
).format
_SPARK_FOLD = f"regexp_replace(translate(lower({{0}}), '{_MARKED}', '{_BARE}'), '\\\\p{{{{M}}}}+', '')".format
_SPARK_ISO = (
    "date_format(coalesce(try_to_timestamp(nullif(regexp_extract({0}, '(\\\\d{{4}}-\\\\d{{1,2}}-\\\\d{{1,2}})', 1), ''), 'yyyy-M-d'), "
    "try_to_timestamp(nullif(regexp_extract({0}, '(\\\\d{{1,2}}/\\\\d{{1,2}}/\\\\d{{4}})', 1), ''), 'd/M/yyyy')), 'yyyy-MM-dd')"
).format
MACROS = {
    "FOLD": (_SPARK_FOLD, FOLD_SQL),
    "SLUG": (
        lambda x: f"regexp_replace(regexp_replace({_SPARK_FOLD(x)}, '[^a-z0-9]+', '_'), '^_+|_+$', '')",
        lambda x: f"regexp_replace(regexp_replace({FOLD_SQL(x)}, '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')",
    ),
    "PLAIN": (_SPARK_PLAIN, PLAIN_NUMBER_SQL.format),
    "ISO": (_SPARK_ISO, _ISO),
    "SET": (lambda x: f"array_join(array_sort(collect_set({x})), ', ')", lambda x: f"coalesce(array_to_string(list_sort(list_distinct(list({x}))), ', '), '')"),
    "SUM1": (lambda x: f"count_if({x})", lambda x: f"count(*) FILTER ({x})"),
    "HAS": (lambda x: f"regexp_like({x})", lambda x: f"regexp_matches({x})"),
    "CUTOUT": (lambda x: f"regexp_replace({x}, '')", lambda x: f"regexp_replace({x}, '')"),
    "ALL": (lambda x: f"regexp_extract_all({x}, 0)", lambda x: f"regexp_extract_all({x})"),
    "JSONLIST": (lambda x: f"from_json({x}, 'array<string>')", lambda x: f"CAST({x} AS JSON)::VARCHAR[]"),
}


def expand(sql: str, dialect: str) -> str:
    """``sql`` with its macros written out for "spark" or "duckdb"; macros may hold macros."""
    at = 0 if dialect == "spark" else 1
    while m := re.search(r"\b(" + "|".join(MACROS) + r")\(", sql):
        depth, end, quoted = 1, m.end(), False
        while depth:
            c = sql[end]
            if c == "'":
                quoted = not quoted
            elif not quoted:
                depth += {"(": 1, ")": -1}.get(c, 0)
            end += 1
        inner = sql[m.end() : end - 1]
        if dialect == "spark" and m[1] in ("ALL", "HAS", "CUTOUT"):
            inner = inner.replace("\\", "\\\\")
        sql = sql[: m.start()] + MACROS[m[1]][at](expand(inner, dialect)) + sql[end:]
    return sql


def both(name: str, sql: str, spark: str | None = None) -> None:
    """Registers a query and its oracle; ``spark`` where the engines' words differ too much."""
    text = spark or sql

    def query(session: SparkSession, folder: str) -> DataFrame:
        words = set(re.findall(r"\w+", text))
        for t in TABLES:
            if t in words:
                table(session, folder, t).createOrReplaceTempView(t)
        session.udf.register("nfc", nfc)
        return session.sql(expand(text, "spark"))

    query.__name__ = name
    QUERIES[name], ORACLE[name] = query, expand(sql, "duckdb")


# --- keys, text, dates
both("fn_number_plain", "SELECT id, PLAIN(target_key) AS number_key FROM citations")
both("fn_slug", "SELECT signer_id, SLUG(full_name) AS person_id FROM chuan")
both("fn_fold_title", "SELECT rec_id, FOLD(title) AS folded, length(FOLD(title)) AS n FROM docs")
both("fn_iso_dates", "SELECT rec_id, ISO(issue_date) AS issued, ISO(effective_date) AS effective, ISO(expiry_date) AS expired FROM docs")
both("fn_first_year", "SELECT rec_id, CAST(nullif(regexp_extract(so_hieu_raw, '((?:19|20)[0-9][0-9])', 1), '') AS INT) AS year FROM docs")
both(
    "fn_number_parts",
    "SELECT doc_key, nullif(regexp_extract(doc_key, '^([0-9]+)', 1), '') AS num, nullif(regexp_extract(doc_key, '^[0-9]+/([0-9]{4})/', 1), '') AS year, "
    "nullif(regexp_extract(doc_key, '([^/-]+)-[^/]+$', 1), '') AS head, nullif(regexp_extract(doc_key, '[^/-]+-([^/]+)$', 1), '') AS tail FROM docs",
)
both(
    "fn_status",
    "SELECT rec_id, CASE WHEN expiry_date IS NOT NULL AND ISO(expiry_date) <= '2024-06-30' THEN 'HET_HIEU_LUC' WHEN ISO(effective_date) > '2024-06-30' THEN 'CHUA_HIEU_LUC' "
    "WHEN status IS NOT NULL THEN status WHEN effective_date IS NOT NULL THEN 'CON_HIEU_LUC' END AS status_as_of FROM docs",
)
both("fn_tokens_with_digits", "SELECT doc_id, t AS token FROM (SELECT doc_id, explode(ALL(text, '[0-9A-Za-z/.-]*[0-9][0-9A-Za-z/.-]*')) AS t FROM documents) x".replace("explode(", "unnest("),
     spark="SELECT doc_id, t AS token FROM (SELECT doc_id, explode(ALL(text, '[0-9A-Za-z/.-]*[0-9][0-9A-Za-z/.-]*')) AS t FROM documents) x")
both("fn_clean_page", "SELECT rec_id, length(regexp_replace(regexp_replace(regexp_replace(raw_txt, '\\r\\n?', chr(10), 'g'), '[ \\t]+\\n', chr(10), 'g'), '\\n{3,}', chr(10) || chr(10), 'g')) AS n FROM docs",
     spark="SELECT rec_id, length(regexp_replace(regexp_replace(regexp_replace(raw_txt, '\\\\r\\\\n?', '\\n'), '[ \\\\t]+\\\\n', '\\n'), '\\\\n{3,}', '\\n\\n')) AS n FROM docs")
_MARKS = "[ăâđêôơưàảãáạằẳẵắặầẩẫấậèẻẽéẹềểễếệìỉĩíịòỏõóọồổỗốộờởỡớợùủũúụừửữứựỳỷỹýỵ]"
both("fn_accent_share", f"SELECT doc_id, CASE WHEN len(ALL(text, '\\p{{L}}')) < 200 THEN -1.0 ELSE round(len(ALL(lower(text), '{_MARKS}')) / len(ALL(text, '\\p{{L}}')), 6) END AS share FROM documents WHERE text IS NOT NULL",
     spark=f"SELECT doc_id, CASE WHEN size(ALL(text, '\\p{{L}}')) < 200 THEN CAST(-1.0 AS DOUBLE) ELSE round(size(ALL(lower(text), '{_MARKS}')) / size(ALL(text, '\\p{{L}}')), 6) END AS share FROM documents WHERE text IS NOT NULL")
# --- ingest, collisions, validation, upserts
both("find_collisions", "SELECT PLAIN(so_hieu) AS number_key, count(*) AS n, min(rec_id) AS first_rec FROM docs GROUP BY PLAIN(so_hieu) HAVING count(*) > 1")
both(
    "cross_field_errors",
    "SELECT 'self_citation' AS error, doc_key AS subject, count(DISTINCT id) AS n FROM citations WHERE PLAIN(doc_key) = PLAIN(target_key) GROUP BY doc_key "
    "UNION ALL SELECT 'repeated_article', rec_id || '#' || part_index || '#' || article_number, count(*) FROM (SELECT DISTINCT rec_id, part_index, seq, article_number FROM articles) a "
    "WHERE article_number IS NOT NULL GROUP BY rec_id, part_index, article_number HAVING count(*) > 1 "
    "UNION ALL SELECT 'unknown_type', doc_type, count(*) FROM docs WHERE doc_type IS NOT NULL AND doc_type NOT IN (SELECT type_name FROM document_types) GROUP BY doc_type",
)
both(
    "register_org",
    "SELECT org_id, min(CASE WHEN nth = 1 THEN org_name END) AS org_name, count(*) AS n FROM (SELECT org_id, org_name, row_number() OVER (PARTITION BY org_id ORDER BY rec_id) AS nth FROM docs WHERE org_id IS NOT NULL AND org_name IS NOT NULL) x GROUP BY org_id",
)
both(
    "last_row_wins",
    "SELECT doc_key, rec_id, title FROM (SELECT doc_key, rec_id, title, row_number() OVER (PARTITION BY doc_key ORDER BY crawled_at DESC NULLS LAST, rec_id DESC) AS nth FROM docs WHERE doc_key IS NOT NULL) x WHERE nth = 1",
)
both(
    "merge_records",
    "SELECT doc_key, min(CASE WHEN longest = 1 THEN title END) AS title, max(pages) AS pages, SET(status) AS statuses, count(*) AS n FROM (SELECT doc_key, title, pages, status, "
    "row_number() OVER (PARTITION BY doc_key ORDER BY length(title) DESC NULLS LAST, rec_id) AS longest FROM docs WHERE is_stub = 0) x GROUP BY doc_key",
)
both(
    "manifest",
    "SELECT rec_id, sha256(raw_txt) AS digest, length(raw_txt) AS n FROM docs WHERE raw_txt IS NOT NULL", spark="SELECT rec_id, sha2(raw_txt, 256) AS digest, length(raw_txt) AS n FROM docs WHERE raw_txt IS NOT NULL",
)
both("incremental_todo", "SELECT r.rec_id FROM docs r WHERE r.is_stub = 0 AND NOT EXISTS (SELECT 1 FROM parts p WHERE p.rec_id = r.rec_id)")
both("plan_by_status", "SELECT status, count(*) AS n, sum(pages) AS pages, round(sum(pages) * 0.1, 4) AS hours FROM docs WHERE is_stub = 0 GROUP BY status")
# --- structure and citations
_NUM = "[0-9]{1,4}/(?:[0-9]{4}/)?[A-ZĐ]+[0-9]{0,2}(?:-[A-ZĐ]+)+"
both("scan_citations", f"SELECT rec_id, k AS target, count(*) AS n FROM (SELECT rec_id, doc_key, unnest(ALL(raw_txt, '{_NUM}')) AS k FROM docs) x WHERE k <> doc_key GROUP BY rec_id, k",
     spark=f"SELECT rec_id, k AS target, count(*) AS n FROM (SELECT rec_id, doc_key, explode(ALL(raw_txt, '{_NUM}')) AS k FROM docs) x WHERE k <> doc_key GROUP BY rec_id, k")
both("scan_articles", "SELECT rec_id, array_to_string(ALL(raw_txt, '(?m)^Điều [0-9]+'), ', ') AS heads FROM docs WHERE raw_txt IS NOT NULL", spark="SELECT rec_id, array_join(ALL(raw_txt, '(?m)^Điều [0-9]+'), ', ') AS heads FROM docs WHERE raw_txt IS NOT NULL")
both(
    "numbering_restarts",
    "SELECT rec_id, part_index, seq, article_number FROM (SELECT rec_id, part_index, seq, article_number, lag(article_number) OVER (PARTITION BY rec_id ORDER BY part_index, seq) AS before, "
    "lead(article_number) OVER (PARTITION BY rec_id ORDER BY part_index, seq) AS after FROM (SELECT DISTINCT rec_id, part_index, seq, article_number FROM articles) a) x WHERE article_number = 1 AND before > 1 AND after = 2",
)
both(
    "article_gaps",
    "SELECT rec_id, part_index, count(DISTINCT article_number) AS have, max(article_number) AS last, max(article_number) - count(DISTINCT article_number) AS missing, count(*) - count(DISTINCT article_number) AS extra "
    "FROM (SELECT DISTINCT rec_id, part_index, seq, article_number FROM articles) a GROUP BY rec_id, part_index",
)
both(
    "zone_at_offset",
    "SELECT c.id, a.part_index AS at_part, a.seq AS at_seq, a.article_number AS at_number FROM (SELECT DISTINCT id, doc_key, char_offset FROM citations) c JOIN (SELECT DISTINCT doc_key, rec_id, part_index, seq, article_number, start_pos, end_pos FROM articles) a "
    "ON a.doc_key = c.doc_key AND c.char_offset >= a.start_pos AND c.char_offset < a.end_pos",
)
both(
    "repair_truncated",
    "WITH k AS (SELECT DISTINCT doc_key AS known FROM docs UNION SELECT doc_key FROM docs_seed), u AS (SELECT DISTINCT PLAIN(target_key) AS cut FROM citations), "
    "x AS (SELECT u.cut, k.known FROM u JOIN k ON starts_with(k.known, u.cut || '-') OR starts_with(k.known, u.cut || '/') WHERE u.cut NOT IN (SELECT known FROM k)) SELECT cut, min(known) AS whole FROM x GROUP BY cut HAVING count(*) = 1",
    spark="WITH k AS (SELECT DISTINCT doc_key AS known FROM docs UNION SELECT doc_key FROM docs_seed), u AS (SELECT DISTINCT PLAIN(target_key) AS cut FROM citations), "
    # every prefix of a known number that ends before a separator, so that the join is on equal keys
    "p AS (SELECT known, substring(known, 1, pos) AS cut FROM k LATERAL VIEW explode(sequence(1, length(known) - 1)) e AS pos WHERE substring(known, pos + 1, 1) IN ('-', '/')), "
    "x AS (SELECT u.cut, p.known FROM u JOIN p ON p.cut = u.cut LEFT ANTI JOIN k ON k.known = u.cut) SELECT cut, min(known) AS whole FROM x GROUP BY cut HAVING count(*) = 1",
)
both(
    "resolve_and_stub",
    "WITH c AS (SELECT DISTINCT id, PLAIN(target_key) AS k, zone_name FROM citations), n AS (SELECT k, count(*) AS hits, max(CASE WHEN zone_name = 'can_cu' THEN 1 ELSE 0 END) AS basis FROM c WHERE k IS NOT NULL GROUP BY k) "
    "SELECT n.k AS number_key, n.hits, CASE WHEN d.doc_key IS NOT NULL THEN 'known' WHEN n.hits >= 2 OR n.basis = 1 THEN 'stub' ELSE 'dropped' END AS verdict FROM n LEFT JOIN (SELECT DISTINCT doc_key FROM docs WHERE is_stub = 0) d ON d.doc_key = n.k",
)
both(
    "classify_relation",
    "SELECT id, CASE WHEN zone_name = 'can_cu' THEN 'BASED_ON' WHEN in_thi_hanh = 0 OR part_kind <> 'main' THEN 'REFERENCES' WHEN HAS(lower(context), 'thay thế|thay cho') THEN 'REPLACES' "
    "WHEN HAS(lower(context), 'bãi bỏ|hết hiệu lực') THEN 'REPEALS' WHEN HAS(lower(context), 'sửa đổi|bổ sung') THEN 'AMENDS' ELSE 'REFERENCES' END AS rel FROM (SELECT DISTINCT id, zone_name, in_thi_hanh, part_kind, context FROM citations) c",
)
both("relation_edges", "SELECT PLAIN(doc_key) AS src, PLAIN(target_key) AS dst, relation, count(DISTINCT id) AS hits, min(zone_name) AS zone, min(article_number) AS article, max(in_thi_hanh) AS in_thi_hanh FROM citations WHERE relation IS NOT NULL AND PLAIN(target_key) IS NOT NULL GROUP BY PLAIN(doc_key), PLAIN(target_key), relation")
both("citation_votes", "SELECT number_key, n, surface FROM (SELECT PLAIN(target_key) AS number_key, surface, count(*) AS k, sum(count(*)) OVER (PARTITION BY PLAIN(target_key)) AS n, row_number() OVER (PARTITION BY PLAIN(target_key) ORDER BY count(*) DESC, surface) AS nth FROM citations WHERE surface IS NOT NULL AND PLAIN(target_key) IS NOT NULL GROUP BY PLAIN(target_key), surface) x WHERE nth = 1 AND n >= 3")
both("citation_report", "SELECT zone_name, part_kind, relation, count(DISTINCT id) AS n, sum(n1) AS resolved FROM (SELECT id, zone_name, part_kind, relation, max(CASE WHEN resolved = 1 THEN 1 ELSE 0 END) AS n1 FROM citations GROUP BY id, zone_name, part_kind, relation) x GROUP BY zone_name, part_kind, relation")
# the head of a first page: after its mark, before the second page and the legal bases, and of a bounded length
_HEAD = "substring(CUTOUT(CUTOUT(CUTOUT(raw_txt, '(?s)^.*?-----\\s*\\[Trang\\s*1\\]\\s*-----'), '(?s)-----\\s*\\[Trang\\s*2\\].*$'), '(?is)\\bc[aăâáàảãạ]n\\s*c[uưứúùủũụ].*$'), 1, 1800)"
_PRINTED = "[0-9]{1,4}\\s*/\\s*(?:[0-9]{4}\\s*/\\s*)?[A-ZĐÐ]{1,8}[0-9]{0,2}(?:-[A-ZĐÐa-z0-9]{1,15})*"
_HEADER = (
    f"WITH f AS (SELECT rec_id, upper(FOLD(PLAIN(doc_key))) AS k, unnest(ALL({_HEAD}, '{_PRINTED}')) AS m FROM docs), g AS (SELECT DISTINCT rec_id, k, upper(FOLD(PLAIN(m))) AS p FROM f), "
    "t AS (SELECT *, substring(k, length(split_part(k, '/', 1)) + 2) AS kt, substring(p, length(split_part(p, '/', 1)) + 2) AS pt, length(k) - length(replace(k, '/', '')) AS kn, length(p) - length(replace(p, '/', '')) AS pn FROM g), "
    "v AS (SELECT rec_id, max(CASE WHEN k = p THEN 1 ELSE 0 END) AS same, max(CASE WHEN split_part(k, '/', 1) = split_part(p, '/', 1) AND (kn < 2 OR pn < 2 OR split_part(k, '/', 2) = split_part(p, '/', 2)) "
    "AND (starts_with(kt, pt) OR starts_with(pt, kt)) THEN 1 ELSE 0 END) AS near FROM t GROUP BY rec_id) "
    "SELECT d.rec_id, CASE WHEN v.rec_id IS NULL THEN 'khong-thay' WHEN same = 1 THEN 'khop' WHEN near = 1 THEN 'gan-khop' ELSE 'lech' END AS verdict FROM docs d LEFT JOIN v ON v.rec_id = d.rec_id"
)
both("header_check", _HEADER, spark=_HEADER.replace("unnest(", "explode(").replace("starts_with(", "startswith("))
_BASIS = (
    f"WITH f AS (SELECT DISTINCT doc_key, unnest(ALL(raw_txt, '(?m)^Căn cứ [^;]*')) AS line FROM docs), n AS (SELECT DISTINCT doc_key, unnest(ALL(line, '{_NUM}')) AS k FROM f) "
    "SELECT n.doc_key, n.k AS target FROM n WHERE n.k <> n.doc_key AND NOT EXISTS (SELECT 1 FROM citations c WHERE c.doc_key = n.doc_key AND PLAIN(c.target_key) = n.k AND c.relation = 'BASED_ON')"
)
both("missing_basis", _BASIS, spark=_BASIS.replace("unnest(", "explode("))
both(
    "page_of_article",
    "WITH m AS (SELECT rec_id, raw_txt, string_split(raw_txt, '----- [Trang ') AS s FROM docs WHERE raw_txt IS NOT NULL), p AS (SELECT rec_id, i, length(s[i]) AS len, try_cast(regexp_extract(s[i], '^([0-9]+)', 1) AS INT) AS page FROM (SELECT rec_id, s, unnest(range(1, len(s) + 1)) AS i FROM m)), "
    "q AS (SELECT rec_id, page, i, sum(len + 13) OVER (PARTITION BY rec_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 13 AS at FROM p) "
    "SELECT a.rec_id, a.part_index, a.seq, max_by(q.page, q.i) AS page FROM (SELECT DISTINCT rec_id, part_index, seq, start_pos FROM articles) a JOIN q ON q.rec_id = a.rec_id AND q.i > 1 AND q.at <= a.start_pos GROUP BY a.rec_id, a.part_index, a.seq",
    spark="WITH m AS (SELECT rec_id, split(raw_txt, '----- \\\\[Trang ') AS s FROM docs WHERE raw_txt IS NOT NULL), "
    # the last page mark at or before each article: marks as an array a document, no row a mark is joined
    "q AS (SELECT rec_id, filter(transform(s, (x, i) -> struct(try_cast(regexp_extract(x, '^([0-9]+)', 1) AS INT) AS page, i AS i, "
    "CAST(aggregate(slice(s, 1, i), 0, (acc, y) -> acc + length(y) + 13) - 13 AS INT) AS at)), x -> x.i > 0) AS marks FROM m) "
    "SELECT a.rec_id, a.part_index, a.seq, element_at(filter(q.marks, x -> x.at <= a.start_pos), -1).page AS page FROM (SELECT DISTINCT rec_id, part_index, seq, start_pos FROM articles) a JOIN q ON q.rec_id = a.rec_id "
    "WHERE size(filter(q.marks, x -> x.at <= a.start_pos)) > 0",
)
both("mark_quality", "SELECT rec_id, CASE WHEN n = 0 THEN 'none' WHEN n = pages THEN 'complete' WHEN n < pages THEN 'missing' ELSE 'too many' END AS verdict FROM (SELECT rec_id, pages, len(ALL(raw_txt, '----- \\[Trang [0-9]+\\] -----')) AS n FROM docs WHERE raw_txt IS NOT NULL) x",
     spark="SELECT rec_id, CASE WHEN n = 0 THEN 'none' WHEN n = pages THEN 'complete' WHEN n < pages THEN 'missing' ELSE 'too many' END AS verdict FROM (SELECT rec_id, pages, size(ALL(raw_txt, '----- \\[Trang [0-9]+\\] -----')) AS n FROM docs WHERE raw_txt IS NOT NULL) x")
both(
    "suspicious_dates",
    "SELECT rec_id, d AS found FROM (SELECT rec_id, unnest(ALL(raw_txt, 'ngày [0-9]{1,2} tháng [0-9]{1,2} năm [0-9]{4}')) AS d FROM docs) x WHERE CAST(regexp_extract(d, 'ngày ([0-9]+)', 1) AS INT) > 31 OR CAST(regexp_extract(d, 'tháng ([0-9]+)', 1) AS INT) > 12 OR CAST(regexp_extract(d, 'năm ([0-9]+)', 1) AS INT) NOT BETWEEN 1945 AND 2035",
    spark="SELECT rec_id, d AS found FROM (SELECT rec_id, explode(ALL(raw_txt, 'ngày [0-9]{1,2} tháng [0-9]{1,2} năm [0-9]{4}')) AS d FROM docs) x WHERE CAST(regexp_extract(d, 'ngày ([0-9]+)', 1) AS INT) > 31 OR CAST(regexp_extract(d, 'tháng ([0-9]+)', 1) AS INT) > 12 OR CAST(regexp_extract(d, 'năm ([0-9]+)', 1) AS INT) NOT BETWEEN 1945 AND 2035",
)
_JUNK = {"control": "[\\x00-\\x08\\x0b\\x0e-\\x1f]", "replacement": "�", "cjk": "[\\x{4e00}-\\x{9fff}]", "cyrillic": "[\\x{0400}-\\x{04ff}]", "url": "https?://", "html": "<[a-z]+[ >]", "rule": "[-_=]{6,}", "dots": "\\.{6,}", "hashtag": "#[a-z0-9_]+", "email": "[a-z0-9.]+@[a-z0-9.]+", "percent": "[0-9]+ ?%", "emoji": "[\\x{1f300}-\\x{1faff}]"}
both("junk_classes", "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS kind, SUM1(HAS(text, '{p}')) AS docs, coalesce(sum(len(ALL(text, '{p}'))), 0) AS hits FROM documents" for k, p in _JUNK.items()) + ") x",
     spark="SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS kind, SUM1(HAS(text, '{p}')) AS docs, coalesce(sum(size(ALL(text, '{p}'))), 0) AS hits FROM documents WHERE text IS NOT NULL" for k, p in _JUNK.items()) + ") x")
# --- evaluation
both("ablation", "SELECT count(DISTINCT doc_key || '|' || target_key || '|' || relation) AS every, count(DISTINCT CASE WHEN zone_name IS NOT NULL THEN doc_key || '|' || target_key || '|' || relation END) AS with_zone, count(DISTINCT CASE WHEN resolved = 1 THEN doc_key || '|' || target_key || '|' || relation END) AS resolved_only, count(DISTINCT CASE WHEN in_thi_hanh = 1 THEN doc_key || '|' || target_key || '|' || relation END) AS enforcing FROM citations WHERE relation IS NOT NULL")
both("same_number_other_year", "SELECT num, org, count(*) AS n, SET(doc_key) AS numbers FROM (SELECT DISTINCT doc_key, regexp_extract(doc_key, '^([0-9]+)/', 1) AS num, regexp_extract(doc_key, '([^/]+)$', 1) AS org FROM docs) x GROUP BY num, org HAVING count(*) > 1")
both("unresolved_rate", "SELECT zone_name, count(*) AS n, round(avg(CAST(CASE WHEN resolved = 1 THEN 0 ELSE 1 END AS DOUBLE)), 6) AS rate FROM (SELECT DISTINCT id, zone_name, resolved FROM citations) c GROUP BY zone_name")
_LABEL = "CASE FOLD(trim(replace(nhan, '_', ' '))) WHEN 'based on' THEN 'BASED_ON' WHEN 'based-on' THEN 'BASED_ON' WHEN 'can cu' THEN 'BASED_ON' WHEN 'references' THEN 'REFERENCES' WHEN 'reference' THEN 'REFERENCES' WHEN 'dan chieu' THEN 'REFERENCES' WHEN 'replaces' THEN 'REPLACES' WHEN 'thay the' THEN 'REPLACES' WHEN 'amends' THEN 'AMENDS' WHEN 'sua doi' THEN 'AMENDS' WHEN 'repeals' THEN 'REPEALS' WHEN 'repeals.' THEN 'REPEALS' WHEN 'bai bo' THEN 'REPEALS' WHEN 'khong' THEN 'KHONG' END"
_SHEET = f"WITH s AS (SELECT id, nguoi_gan, {_LABEL} AS label, row_number() OVER (PARTITION BY id, nguoi_gan ORDER BY gan_luc DESC, row_no DESC) AS nth FROM phieu_gan), v AS (SELECT id, nguoi_gan, label FROM s WHERE nth = 1 AND label IS NOT NULL)"
both("label_confusions", f"{_SHEET} SELECT a.label AS label_a, b.label AS label_b, count(*) AS n FROM v a JOIN v b ON a.id = b.id AND a.nguoi_gan < b.nguoi_gan GROUP BY a.label, b.label")
both("merge_gold", f"{_SHEET} SELECT id, count(*) AS n, CASE WHEN count(DISTINCT label) = 1 AND count(*) > 1 THEN 'keep' WHEN count(*) = 1 THEN 'single' ELSE 'drop' END AS verdict, CASE WHEN count(DISTINCT label) = 1 THEN min(label) END AS label FROM v GROUP BY id")
both("label_levels", f"{_SHEET} SELECT coalesce(nguoi_gan, 'all') AS annotator, count(*) AS n, count(DISTINCT id) AS items FROM v GROUP BY GROUPING SETS ((nguoi_gan), ())")
both(
    "jaccard_resolver",
    "WITH m AS (SELECT DISTINCT org_name AS mention FROM docs WHERE org_name IS NOT NULL), mt AS (SELECT DISTINCT mention, unnest(ALL(FOLD(mention), '[a-z0-9]+')) AS t FROM m), mn AS (SELECT mention, count(*) AS n FROM mt GROUP BY mention), "
    "ot AS (SELECT DISTINCT org_id, unnest(ALL(FOLD(org_name), '[a-z0-9]+')) AS t FROM organizations), o_n AS (SELECT org_id, count(*) AS n FROM ot GROUP BY org_id), "
    "c AS (SELECT mention, org_id, count(*) AS k FROM mt JOIN ot ON mt.t = ot.t GROUP BY mention, org_id), s AS (SELECT c.mention, c.org_id, round(k * 1.0 / (mn.n + o_n.n - k), 6) AS score FROM c JOIN mn ON mn.mention = c.mention JOIN o_n ON o_n.org_id = c.org_id), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY mention ORDER BY score DESC, org_id) AS nth, lead(score) OVER (PARTITION BY mention ORDER BY score DESC, org_id) AS next_score FROM s) "
    "SELECT mention, org_id, score FROM r WHERE nth = 1 AND score >= 0.5 AND score - coalesce(next_score, 0) >= 0.08",
    spark="WITH m AS (SELECT DISTINCT org_name AS mention FROM docs WHERE org_name IS NOT NULL), mt AS (SELECT DISTINCT mention, explode(ALL(FOLD(mention), '[a-z0-9]+')) AS t FROM m), mn AS (SELECT mention, count(*) AS n FROM mt GROUP BY mention), "
    "ot AS (SELECT DISTINCT org_id, explode(ALL(FOLD(org_name), '[a-z0-9]+')) AS t FROM organizations), o_n AS (SELECT org_id, count(*) AS n FROM ot GROUP BY org_id), "
    "c AS (SELECT mention, org_id, count(*) AS k FROM mt JOIN ot ON mt.t = ot.t GROUP BY mention, org_id), s AS (SELECT c.mention, c.org_id, CAST(round(k * 1.0D / (mn.n + o_n.n - k), 6) AS DOUBLE) AS score FROM c JOIN mn ON mn.mention = c.mention JOIN o_n ON o_n.org_id = c.org_id), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY mention ORDER BY score DESC, org_id) AS nth, lead(score) OVER (PARTITION BY mention ORDER BY score DESC, org_id) AS next_score FROM s) "
    "SELECT mention, org_id, score FROM r WHERE nth = 1 AND score >= 0.5 AND score - coalesce(next_score, 0) >= 0.08",
)
