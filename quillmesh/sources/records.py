"""Document records: reading, validating, turning into graph tables, writing.

A record is one JSON object per file (or per line): the document, its organisation, signers,
citations, mentions and attached contents with their articles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmesh.functions.numbers import plain_number
from quillmesh.functions.text import iso_date, slug

SCHEMA = """
  schemaVersion string, sourceFile string, mappedBy string, note string,
  document struct<documentNumber: string, title: string, documentType: string, status: string, issueDate: string, effectiveDate: string,
    expiryDate: string, fileUrl: string, summary: string, idOverride: string, topics: array<string>, targetGroups: array<string>>,
  organization struct<name: string, orgType: string, parentOrg: string, idOverride: string>,
  signers array<struct<fullName: string, academicTitle: string, position: array<string>, idOverride: string>>,
  citations array<struct<targetDocumentNumber: string, relationType: string, targetArticle: string, context: string>>,
  mentions array<string>,
  normativeContents array<struct<contentType: string, title: string, status: string, idOverride: string,
    articles: array<struct<number: string, heading: string, text: string, isImplementationClause: boolean>>>>,
  articles array<struct<number: string, heading: string, text: string, isImplementationClause: boolean>>, _corrupt_record string
"""
# fixed values: the statuses and relations a record may name
STATUSES = ["CON_HIEU_LUC", "HET_HIEU_LUC", "CHUA_HIEU_LUC"]
RELATIONS = ["BASED_ON", "REFERENCES", "REPLACES", "AMENDS", "REPEALS"]


def read_records(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Records below ``path`` with their file; directories that begin with "_" are left out; broken files keep their text in _corrupt_record."""
    raw = spark.read.schema(SCHEMA).option("recursiveFileLookup", True).option("multiLine", not lines).option("mode", "PERMISSIVE").json(path)
    raw = raw.withColumn("file", F.col("_metadata.file_path"))
    return raw.where(~F.col("file").rlike(r"/_[^/]*/")).withColumn("doc_key", F.coalesce(F.nullif("document.idOverride", F.lit("")), plain_number(F.col("document.documentNumber"))))


def validate(records: DataFrame) -> DataFrame:
    """(file, doc_key, errors): every rule a record breaks, as an array; empty where it is sound."""
    numbers = F.transform(F.coalesce("articles", F.array()), lambda a: a["number"])
    bad = lambda c, allowed: F.exists(F.coalesce(c, F.array()), lambda x: x.isNull() | ~x.isin(*allowed))
    rules = {
        "unreadable": F.col("_corrupt_record").isNotNull(),
        "no_number": F.col("doc_key").isNull(),
        "no_title": F.coalesce(F.trim("document.title"), F.lit("")) == "",
        "unknown_status": F.col("document.status").isNotNull() & ~F.col("document.status").isin(*STATUSES),
        "unknown_relation": bad(F.transform("citations", lambda c: c["relationType"]), RELATIONS),
        "cites_itself": F.exists(F.coalesce(F.transform("citations", lambda c: c["targetDocumentNumber"]), F.array()), lambda n: n == F.col("document.documentNumber")),
        "repeated_article": F.size(F.array_distinct(numbers)) < F.size(numbers),
        "bad_date": F.col("document.issueDate").isNotNull() & iso_date(F.col("document.issueDate")).isNull(),
    }
    found = F.filter(F.array(*(F.when(F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules.items())), lambda x: x.isNotNull())
    return records.select("file", "doc_key", found.alias("errors"))


def collisions(records: DataFrame) -> DataFrame:
    """(doc_key, files): records of different files with one number."""
    return records.where("doc_key is not null").groupBy("doc_key").agg(F.array_sort(F.collect_set("file")).alias("files")).where(F.size("files") > 1)


def graph_tables(records: DataFrame, strict: bool = True) -> dict[str, DataFrame]:
    """The node and edge tables of records; ``strict`` fails on the first unsound record.

    Of records with one number the last by file name stands. Organisations: the first name stands,
    later records fill in a missing type or parent. Persons: first title, all positions. Cited
    numbers without a record become stubs.
    """
    if strict:
        wrong = validate(records).where(F.size("errors") > 0).limit(1).collect()
        if wrong:
            raise ValueError(f"{wrong[0]['file']}: {', '.join(wrong[0]['errors'])}")
    nth = F.row_number().over(Window.partitionBy("doc_key").orderBy(F.desc("file")))
    r = records.where("doc_key is not null").withColumn("nth", nth).where("nth = 1").drop("nth")
    org_id = F.coalesce(F.nullif("organization.idOverride", F.lit("")), slug(F.col("organization.name")))
    documents = r.select(
        "doc_key", F.col("document.documentNumber").alias("number"), "document.title", F.col("document.documentType").alias("doc_type"), "document.status", "document.summary",
        *(iso_date(F.col(f"document.{a}")).alias(b) for a, b in (("issueDate", "issue_date"), ("effectiveDate", "effective_date"), ("expiryDate", "expiry_date"))), F.lit(0).alias("is_stub"),
    )
    o = r.where("organization.name is not null").select(org_id.alias("org_id"), "organization.name", F.col("organization.orgType").alias("org_type"), F.col("organization.parentOrg").alias("parent"), "file")
    firsts = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("file"))).alias(c)
    orgs = o.groupBy("org_id").agg(firsts("name"), firsts("org_type"), firsts("parent"))
    parents = orgs.where("parent is not null").select(slug(F.col("parent")).alias("org_id"), F.col("parent").alias("name")).distinct().join(orgs.select("org_id"), "org_id", "left_anti")
    orgs = orgs.unionByName(parents.groupBy("org_id").agg(F.min("name").alias("name")), allowMissingColumns=True)
    s = r.select("doc_key", "file", F.posexplode("signers").alias("pos", "s")).select("doc_key", "file", "pos", F.coalesce(F.nullif("s.idOverride", F.lit("")), slug(F.col("s.fullName"))).alias("person_id"), "s.*")
    people = s.groupBy("person_id").agg(
        F.min_by("fullName", F.struct("file", "pos")).alias("full_name"),
        F.min_by("academicTitle", F.when(F.col("academicTitle").isNotNull(), F.struct("file", "pos"))).alias("academic_title"),
        F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("file", "pos", "position"))), lambda x: F.coalesce(x["position"], F.array())))).alias("positions"),
    )
    c = r.select("doc_key", F.posexplode("citations").alias("seq", "c")).select(
        F.col("doc_key").alias("src"), F.col("c.relationType").alias("rel"), plain_number(F.col("c.targetDocumentNumber")).alias("dst"), F.col("c.targetArticle").alias("target_article"), "c.context", "seq"
    )
    last = F.row_number().over(Window.partitionBy("src", "rel", "dst").orderBy(F.desc("seq")))
    edges = c.where("dst is not null and src <> dst").withColumn("nth", last).where("nth = 1").drop("nth", "seq")
    stubs = edges.select(F.col("dst").alias("doc_key")).distinct().join(documents.select("doc_key"), "doc_key", "left_anti").withColumn("is_stub", F.lit(1))
    contents = r.select("doc_key", F.col("document.status").alias("doc_status"), F.posexplode("normativeContents").alias("i", "n"))
    content_id = F.coalesce(F.nullif("n.idOverride", F.lit("")), F.concat("doc_key", F.lit("#nd"), F.col("i") + 1))
    contents = contents.withColumn("content_id", content_id)
    article = lambda df, parent, arts: df.select(F.col(parent).alias("parent_id"), "doc_key", F.explode(arts).alias("a"))
    arts = article(r, "doc_key", "articles").unionByName(article(contents, "content_id", "n.articles"))
    return {
        "document": documents.unionByName(stubs, allowMissingColumns=True),
        "org": orgs,
        "part_of": orgs.where("parent is not null").select("org_id", slug(F.col("parent")).alias("parent_id")),
        "person": people,
        "signed_by": s.select("doc_key", "person_id").distinct(),
        "issued_by": r.where("organization.name is not null").select("doc_key", org_id.alias("org_id")),
        "topic": r.select("doc_key", F.explode("document.topics").alias("topic")).distinct(),
        "applies_to": r.select("doc_key", F.explode("document.targetGroups").alias("target_group")).distinct(),
        "mention": r.select("doc_key", F.explode("mentions").alias("name")).select("doc_key", slug(F.col("name")).alias("org_id")).distinct(),
        "content": contents.select("content_id", "doc_key", "n.title", F.col("n.contentType").alias("content_type"), F.coalesce("n.status", "doc_status").alias("status")),
        "article": arts.select(F.concat_ws("#", "parent_id", "a.number").alias("article_id"), "parent_id", "doc_key", "a.number", "a.heading", "a.text", F.coalesce("a.isImplementationClause", F.lit(False)).alias("implements")),
        "edge": edges,
    }


def write_graph(tables: dict[str, DataFrame], path: str) -> None:
    """One parquet table a label, edges partitioned by type; writing again replaces."""
    for name, df in tables.items():
        w = df.write.mode("overwrite")
        (w.partitionBy("rel") if name == "edge" else w).parquet(f"{path}/{name}")


def write_lines(df: DataFrame, path: str) -> None:
    """JSON lines; nulls are left out, as in the records."""
    df.write.mode("overwrite").json(path)


def upsert(old: DataFrame, new: DataFrame, *key: str) -> DataFrame:
    """``old`` with the rows of ``new`` in place of those with their key."""
    return old.join(new.select(*key).distinct(), list(key), "left_anti").unionByName(new, allowMissingColumns=True)


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    """The question set: CSV with a header, answers split at ";"."""
    cols = "id string, nhom string, cau_hoi string, tu_khoa string, cypher_tham_so string, loai_truy_van string, nguon_dap_an string, DAP_AN string"
    df = spark.read.schema(cols).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return df.withColumn("answers", F.filter(F.transform(F.split("DAP_AN", ";"), lambda x: F.trim(x)), lambda x: x != "")).drop("DAP_AN")


def read_crawl(spark: SparkSession, path: str) -> DataFrame:
    """The crawler's CSV: numeric ids only, padded to four digits; of repeated ids the last line of a file stands."""
    cols = "id string, linh_vuc string, ten_van_ban string, so_hieu string, ngay_ban_hanh string, ngay_hieu_luc string, co_quan_ban_hanh string, loai string, tinh_trang string, pdf_url string"
    df = spark.read.schema(cols).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    df = df.where(F.col("id").rlike("^[0-9]+$")).withColumn("id", F.lpad("id", 4, "0"))
    nth = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("line")))
    return df.withColumn("line", F.monotonically_increasing_id()).withColumn("nth", nth).where("nth = 1").drop("line", "nth")


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(file, topic, stem, text) of the text files below ``path``; the topic is the first directory below it."""
    df = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.txt").withColumn("file", F.col("_metadata.file_path"))
    below = F.regexp_extract("file", r"([^/]+)/[^/]+$", 1)
    return df.select("file", below.alias("topic"), F.regexp_extract("file", r"([^/]+)\.txt$", 1).alias("stem"), F.col("value").alias("text"))
