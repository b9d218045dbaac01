"""MediaWiki XML dumps."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wortfund.schemas import XML_PAGE

# Text comes back as it stands in the dump: white space around a body stays.
_OPTIONS = {"ignoreSurroundingSpaces": "false"}


_CORRUPT = "_corrupt_record"


def _page_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row per <page>, as text, from dumps that Spark splits over many tasks.

    The dump is read as text records that end at "</page>", which cannot stand unescaped inside
    a body. What lies before the first and after the last page holds no page and is dropped; a
    last page without its end is malformed.
    """
    records = spark.read.option("lineSep", "</page>").text(path)
    page = F.concat(F.regexp_extract("value", r"(?s)<page[ >].*", 0), F.lit("</page>"))
    return records.where(F.col("value").rlike("<page[ >]")).select(page.alias("page"))


def _parsed(pages: DataFrame, schema, **options) -> DataFrame:
    # inline, not "page.*": a later filter then reads the parsed columns, where it would otherwise
    # be pushed below and parse each page a second time.
    return pages.select(F.inline(F.array(F.from_xml("page", schema, {**_OPTIONS, **options}))))


def scan_xml_pages(spark: SparkSession, path: str, skip_malformed: bool = False) -> DataFrame:
    """One row per <page>. A malformed page fails the job, or is left out if skip_malformed;
    malformed_pages has the text of those."""
    pages = _page_texts(spark, path)
    if not skip_malformed:
        return _parsed(pages, XML_PAGE, mode="FAILFAST")
    schema = T.StructType([*XML_PAGE.fields, T.StructField(_CORRUPT, T.StringType())])
    return _parsed(pages, schema).where(F.col(_CORRUPT).isNull()).drop(_CORRUPT)


def malformed_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page): the text of each page of a dump that does not parse."""
    schema = T.StructType([*XML_PAGE.fields, T.StructField(_CORRUPT, T.StringType())])
    found = _parsed(_page_texts(spark, path), schema).where(F.col(_CORRUPT).isNotNull())
    return found.select(F.col(_CORRUPT).alias("page"))


def scan_all_pages(spark: SparkSession, path: str) -> DataFrame:
    """Every page, parsed once: the page columns, and `malformed`, the text of a page that does not parse, else null."""
    schema = T.StructType([*XML_PAGE.fields, T.StructField(_CORRUPT, T.StringType())])
    return _parsed(_page_texts(spark, path), schema).withColumnRenamed(_CORRUPT, "malformed")


def scan_xml_pages_whole(spark: SparkSession, path: str) -> DataFrame:
    """The same through Spark's XML source: one task per file, so only for many small files. A
    malformed page fails the job."""
    return (
        spark.read.format("xml")
        .options(rowTag="page", mode="FAILFAST", **_OPTIONS)
        .schema(XML_PAGE)
        .load(path)
    )


def write_xml_pages(pages: DataFrame, path: str) -> None:
    """Write rows of the page schema as a dump."""
    pages.write.format("xml").options(rootTag="mediawiki", rowTag="page").save(path)
