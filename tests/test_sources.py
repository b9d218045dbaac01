"""Dumps, tables, lists and sinks."""

import bz2
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from explain import plan_of
from wortfund import schemas
from wortfund.operators import clean as C
from wortfund.operators import index as I
from wortfund.plans import jobs
from wortfund.sources import lists, xml_dump
from wortfund.sources import tables as S

DUMP = """<mediawiki xmlns="http://www.mediawiki.org/xml/export-0.10/" version="0.10" xml:lang="de">
  <siteinfo>
    <sitename>Wikipedia</sitename>
    <namespaces><namespace key="0" case="first-letter" /></namespaces>
  </siteinfo>
  <page>
    <title>Alan &amp; Co</title>
    <ns>0</ns>
    <id>1</id>
    <revision>
      <id>900</id>
      <contributor><username>x</username><id>77</id></contributor>
      <text bytes="20" xml:space="preserve">''Alan'' {{x}} &lt;b&gt;fett&lt;/b&gt; &amp;amp; mehr
</text>
    </revision>
  </page>
  <page>
    <title>Diskussion:Alan</title>
    <ns>1</ns>
    <id>2</id>
    <revision><text xml:space="preserve">weg</text></revision>
  </page>
  <page>
    <title>Leer</title>
    <ns>0</ns>
    <id>3</id>
    <redirect title="Alan" />
    <revision><text xml:space="preserve" /></revision>
  </page>
  <page>
    <title>Ohne Attribut</title>
    <ns>0</ns>
    <id>4</id>
    <revision><text>#REDIRECT [[Alan]]</text></revision>
  </page>
</mediawiki>
"""


@pytest.fixture
def dump(tmp_path):
    path = tmp_path / "dump.xml"
    path.write_text(DUMP, encoding="utf-8")
    return str(path)


@pytest.mark.parametrize("scan", [xml_dump.scan_xml_pages, xml_dump.scan_xml_pages_whole])
def test_dump(spark, dump, scan):
    pages = scan(spark, dump)
    assert pages.schema == schemas.XML_PAGE
    rows = pages.select("id", "ns", "title", "revision.text._VALUE").collect()
    assert {row[0]: tuple(row[1:]) for row in rows} == {
        1: (0, "Alan & Co", "''Alan'' {{x}} <b>fett</b> &amp; mehr\n"),
        2: (1, "Diskussion:Alan", "weg"),
        3: (0, "Leer", None),
        4: (0, "Ohne Attribut", "#REDIRECT [[Alan]]"),
    }


def test_dump_is_read_in_many_pieces(spark, tmp_path):
    path = str(tmp_path / "pages")
    body = F.concat(F.lit(" <page> & </page> \n"), F.repeat(F.lit("xä "), 100))
    pages = spark.range(500).select(
        "id",
        (F.col("id") % 2).alias("ns"),
        F.concat(F.lit("T"), F.col("id").cast("string")).alias("title"),
        F.struct(F.struct(body.alias("_VALUE")).alias("text")).alias("revision"),
    )
    xml_dump.write_xml_pages(pages.coalesce(1), path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        scan = xml_dump.scan_xml_pages(spark, path)
        assert scan.rdd.getNumPartitions() > 5
        assert sorted(map(tuple, scan.collect())) == sorted(map(tuple, pages.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_packed_dump_is_read_in_many_pieces(spark, tmp_path):
    # Several bzip2 streams in one file, as the dumps are published.
    rng = random.Random(2)
    pages = [
        f"<page><title>T{i}</title><ns>0</ns><id>{i}</id><revision>"
        f"<text>{[rng.random() for _ in range(40)]}</text></revision></page>\n"
        for i in range(3000)
    ]
    parts = ["".join(pages[i : i + 500]) for i in range(0, 3000, 500)]
    parts = ["<mediawiki>\n", *parts, "</mediawiki>"]
    path = tmp_path / "dump.xml.bz2"
    path.write_bytes(b"".join(bz2.compress(part.encode(), 1) for part in parts))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        scan = xml_dump.scan_xml_pages(spark, str(path))
        assert scan.rdd.getNumPartitions() > 3
        found = {r.id: r.revision.text._VALUE for r in scan.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == {i: page.split("text>")[1][:-2] for i, page in enumerate(pages)}


def test_namespace_filter_parses_each_page_once(spark, dump):
    pages = C.filter_namespace(xml_dump.scan_xml_pages(spark, dump))
    assert plan_of(C.project_article(pages), "simple").count("from_xml") == 1


def test_ingest(spark, dump, tmp_path):
    target = str(tmp_path / "articles")
    expected = [
        (1, "Alan & Co", "Alan |TEMPLATE| fett & mehr"),
        (3, "Leer", ""),
        (4, "Ohne Attribut", ""),
    ]
    for _ in range(2):  # a dump that is read again replaces its articles
        assert jobs.ingest(spark, dump, target) is None
        articles = S.read_articles(spark, target).select("docid", "title", "wikitext")
        assert sorted(map(tuple, articles.collect())) == expected
    found = S.read_titles(spark, target).select("title", "docid").collect()
    assert sorted(map(tuple, found)) == [("Alan & Co", 1), ("Leer", 3), ("Ohne Attribut", 4)]


def test_ingest_appends_to_other_targets(spark, dump, tmp_path, monkeypatch):
    monkeypatch.setitem(S.FORMATS, "jdbc", "parquet")
    target = str(tmp_path / "articles")
    for _ in range(2):
        jobs.ingest(spark, dump, target, "jdbc")
    assert S.read_articles(spark, target, "jdbc").count() == 6


def test_ingest_with_rejects(spark, dump, tmp_path):
    with open(dump, encoding="utf-8") as f:
        text = f.read()
    bad = "<page><title>x</title><ns>0</ns><id>9</id><revision><text>a &nope; b</text></revision></page>"
    damaged = tmp_path / "damaged.xml"
    damaged.write_text(text.replace("</mediawiki>", bad + "</mediawiki>"), encoding="utf-8")
    target, rejected = str(tmp_path / "articles"), str(tmp_path / "rejected")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        jobs.ingest(spark, str(damaged), target)
    assert S.versions.versions(spark, target) == []
    counts = jobs.ingest(spark, str(damaged), target, rejected=rejected)
    assert counts == {"pages": 5, "rejected": 1}
    assert sorted(r.docid for r in S.read_articles(spark, target).collect()) == [1, 3, 4]
    assert [r.page for r in spark.read.parquet(rejected).collect()] == [bad]
    # a good dump: nothing rejected, nothing changed
    assert jobs.ingest(spark, dump, target, rejected=rejected) == {"pages": 4, "rejected": 0}
    assert S.read_articles(spark, target).count() == 3 and spark.read.parquet(rejected).count() == 1


def test_ingest_then_index(spark, dump, tmp_path):
    articles = jobs.articles_from_dump(spark, dump)
    for layout in schemas.LAYOUTS:
        path = str(tmp_path / layout)
        jobs.write_index(articles, lists.default_stopwords(spark), layout, path, "word", 4)
        index = spark.read.parquet(path)
        # only words of the list go
        assert "mehr" not in lists.default_stopword_list()
        assert sorted(r.word for r in index.collect()) == ["alan", "fett", "mehr"]
        assert set(schemas.LAYOUTS[layout].names) <= set(index.columns)


def test_create_table_refuses_an_existing_one(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", "b")], schemas.ARTICLES)
    path = str(tmp_path / "table")
    S.create_table(rows, path)
    with pytest.raises(AnalysisException):
        S.create_table(rows, path)
    S.append_table(rows, path)
    assert S.read_table(spark, path).count() == 2


def test_column_names_of_the_targets(spark):
    rows = spark.createDataFrame([(1, "a", "b")], schemas.ARTICLES)
    assert S.rename_columns(rows, S.ARTICLE_NAMES["jdbc"]).columns == ["docID", "title", "wikitext"]
    names = S.rename_columns(rows, S.ARTICLE_NAMES["mongodb"]).columns
    assert names == ["_id", "title", "wikitext"]


def test_mongodb_index_shape(spark):
    entries = [("a", i, [i]) for i in range(6)] + [("b", 1, [0])]
    postings = spark.createDataFrame(entries, schemas.POSTINGS)
    by_term = I.index_by_term(postings, 2)
    rows = S.to_mongodb_index(by_term)
    assert rows.schema.simpleString() == (
        "struct<_id:string,invIndex:array<struct<_1:bigint,_2:array<int>>>>"
    )
    assert rows.select("_id").distinct().count() == rows.count()
    back = S.from_mongodb_index(rows)
    assert sorted(map(str, back.collect())) == sorted(map(str, by_term.collect()))


def test_rows_of_one_word_in_mongodb_shape(spark):
    entries = [("ab", i, [i]) for i in range(6)] + [("abc", 1, [0])]
    postings = spark.createDataFrame(entries, schemas.POSTINGS)
    rows = S.to_mongodb_index(I.index_by_term(postings, 2))
    found = S.from_mongodb_index(S.mongodb_word_rows(rows, "ab")).collect()
    assert {r.word for r in found} == {"ab"}
    assert sorted(e.docid for r in found for e in r.inv_index) == list(range(6))


@pytest.mark.parametrize("kind", list(S.INDEX_LAYOUTS))
def test_index_through_the_shape_of_each_target(spark, tmp_path, monkeypatch, kind):
    # The shape each target gets, kept in Parquet: no database is started here.
    monkeypatch.setitem(S.FORMATS, kind, "parquet")
    articles = spark.createDataFrame([(1, "a", "x y x"), (2, "b", "y der")], schemas.ARTICLES)
    stop = lists.default_stopwords(spark)
    path = str(tmp_path / "index")
    jobs.append_index(articles, stop, path, kind)
    assert spark.read.parquet(path).columns == S.INDEX_NAMES[kind]
    index = S.read_index(spark, path, kind)
    layout = S.INDEX_LAYOUTS[kind]
    assert index.columns == schemas.LAYOUTS[layout].names
    expected = jobs.build_index(articles, stop, layout)
    assert sorted(map(str, index.collect())) == sorted(map(str, expected.collect()))
    S.append_articles(articles, str(tmp_path / "articles"), kind)
    assert S.read_articles(spark, str(tmp_path / "articles"), kind).collect() == articles.collect()


def test_typed_columns(spark):
    types = "docid string, title string, wikitext string, x string"
    rows = spark.createDataFrame([("7", "t", "w", "more")], types)
    assert list(map(tuple, S.typed_columns(rows, schemas.ARTICLES).collect())) == [(7, "t", "w")]


def test_jdbc_options():
    # No database is started here; the options are what Spark's JDBC source takes.
    assert S.jdbc_scan_options("docID", 0, 100, 4) == {
        "partitionColumn": "docID",
        "lowerBound": "0",
        "upperBound": "100",
        "numPartitions": "4",
    }
    assert S.jdbc_article_types()["createTableColumnTypes"] == "title VARCHAR(255)"
    assert S.jdbc_index_types()["createTableColumnTypes"] == "word VARCHAR(65)"


def test_lists(spark, tmp_path):
    words, ids = str(tmp_path / "words"), str(tmp_path / "ids")
    (tmp_path / "words").write_text("der\ndie\nder\nz.B.\n", encoding="utf-8")
    found = [r.word for r in lists.load_stopwords(spark, words).collect()]
    assert sorted(found) == ["der", "die", "z.B."]
    (tmp_path / "ids").write_text("1\n22\n1\n", encoding="utf-8")
    keys = lists.load_search_keys(spark, words, ids, ids, words)
    assert {r.docid for r in keys["article_ids"].collect()} == {1, 22}
    assert keys["index_ids"].schema.simpleString() == "struct<docid:bigint>"
    assert keys["titles"].columns == ["title"] and keys["words"].columns == ["word"]


def test_a_key_that_is_no_number_fails(spark, tmp_path):
    (tmp_path / "ids").write_text("1\nx\n", encoding="utf-8")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        lists.read_list(spark, str(tmp_path / "ids"), "docid", "long").collect()


def test_default_stopwords(spark):
    words = lists.default_stopword_list()
    assert len(words) == len(set(words)) < 200
    assert {"der", "und", "über"} <= set(words)
    assert lists.default_stopwords(spark).count() == len(words)
