"""Readers of landed files: listings, details, bodies and page texts.

A fetcher outside Spark lands the publisher's answers as files:

    listing/<doc_type>/*.json                payloads {"conteudo": [...]}
    detail/<doc_type>/<meeting_number>.json  payloads {"conteudo": [{...}]}
    bodies/<sha-256 of the url>.pdf          fetched bytes
    pages/*.parquet                          (doc_key = sha-256 of the url, page_no, text)
"""

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirefold import fixed_values as fv
from quirefold import schemas
from quirefold.functions.dates import parse_date
from quirefold.functions.text import strip_ws

UNREADABLE = "listing payload cannot be read"


def _first_truthy_number(names) -> Column:
    """The first of two spellings that is neither absent nor zero, else 0."""
    first, second = (F.col(f"item.{n}") for n in names)
    return F.coalesce(F.nullif(first, F.lit(0)), second, F.lit(0))


def listing_items(payloads: DataFrame, doc_type: str) -> DataFrame:
    """One row per listed document of one kind, from payload rows (list_file, conteudo).

    (source_ord, list_file, list_pos) is the unique key and the listing order. A payload that cannot be read, as its
    column ``broken`` says if there is one, gives one row with a ``list_error``, so that it ends in quarantine.
    """
    if "broken" not in payloads.columns:
        payloads = payloads.withColumn("broken", F.lit(None).cast("string"))
    broken = F.col("broken").isNotNull()
    number = _first_truthy_number(fv.NUMBER_FIELDS[doc_type])
    default_title = F.concat(F.lit(fv.TITLE_PREFIXES[doc_type] + " "), number.cast("string"))
    return (payloads.select("list_file", "broken", F.posexplode_outer("conteudo").alias("pos", "item"))
            .where(F.col("pos").isNotNull() | broken)
            .select(F.lit(fv.DOC_TYPES.index(doc_type)).alias("source_ord"), "list_file",
                    F.coalesce(F.col("pos").cast("bigint"), F.lit(-1)).alias("list_pos"),
                    F.lit(doc_type).alias("doc_type"),
                    F.when(broken, -1).otherwise(number).alias("meeting_number"),
                    F.when(broken, F.col("list_file")).otherwise(
                        strip_ws(F.coalesce("item.titulo", default_title))).alias("title"),
                    parse_date(F.col("item.dataReferencia")).alias("meeting_date"),
                    F.when(broken, F.lit(UNREADABLE)).alias("list_error")))


def read_listing(spark: SparkSession, path: str, doc_type: str, streaming: bool = False,
                 max_files: int = fv.RUN_INTERVAL) -> DataFrame:
    """Listed documents of one kind; as a stream, ``max_files`` payloads make a batch."""
    schema = T.StructType([*schemas.LISTING, T.StructField("broken", T.StringType())])
    reader = ((spark.readStream if streaming else spark.read).schema(schema).option("multiLine", True)
              .option("columnNameOfCorruptRecord", "broken"))
    if streaming:
        reader = reader.option("maxFilesPerTrigger", max_files)
    payloads = reader.json(f"{path}/{doc_type}")
    return listing_items(payloads.withColumn("list_file", F.col("_metadata.file_name")), doc_type)


def detail_items(payloads: DataFrame, doc_type: str) -> DataFrame:
    """(doc_type, meeting_number, pdf_url, html): first element of ``conteudo``; blank and absent are ''."""
    item = F.get("conteudo", F.lit(0))

    def field(name):
        return F.coalesce(strip_ws(item[name]), F.lit(""))

    pdf = field("urlPdfAta") if doc_type == fv.DOC_TYPES[0] else F.lit("")
    full = F.when(pdf == "", "").when(pdf.startswith("http"), pdf).otherwise(F.concat(F.lit(fv.BASE_URL), pdf))
    return payloads.select(F.lit(doc_type).alias("doc_type"), "meeting_number", full.alias("pdf_url"),
                           field(fv.HTML_FIELDS[doc_type]).alias("html"))


def read_detail(spark: SparkSession, path: str, doc_type: str) -> DataFrame:
    """Details of one kind; the meeting number is the file name."""
    payloads = spark.read.schema(schemas.DETAIL).option("multiLine", True).json(f"{path}/{doc_type}")
    number = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)\.json$", 1).cast("int")
    return detail_items(payloads.withColumn("meeting_number", number), doc_type)


def body_key(url: Column) -> Column:
    """Name under which the bytes of a url are landed."""
    return F.sha2(url, 256)


def read_bodies(spark: SparkSession, path: str) -> DataFrame:
    """(doc_key, body_hash) of the landed bodies that hold any bytes.

    Bytes are digested where they are read, so only the digest travels further.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(path)
    key = F.regexp_extract("path", r"([0-9a-f]{64})\.pdf$", 1)
    return files.where("length > 0").select(key.alias("doc_key"), F.sha2("content", 256).alias("body_hash"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PAGES).parquet(path)


class BodyIndex:
    """Digests of the bodies in a landing folder, kept under a store's root: every run reads only files that came since."""

    def __init__(self, spark: SparkSession, root: str, landed: str):
        self.spark, self.landed = spark, landed
        self.path = f"{root.rstrip('/')}/bodies/{hashlib.sha256(landed.encode()).hexdigest()[:32]}"

    def refresh(self) -> DataFrame:
        """Take new files in and give (doc_key, body_hash) of all; the newest file of a name counts.

        Files of the newest two seconds are read again, as others may have landed in the same moment.
        """
        self.spark.createDataFrame([], schemas.BODIES).write.mode("ignore").parquet(self.path)
        index = self.spark.read.schema(schemas.BODIES).parquet(self.path)
        newest = index.agg(F.date_format(F.max("modified") - F.expr("interval 2 seconds"), "yyyy-MM-dd'T'HH:mm:ss")).first()[0]
        reader = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf")
        files = (reader.option("modifiedAfter", newest) if newest else reader).load(self.landed)
        (files.where("length > 0").select(F.regexp_extract("path", r"([0-9a-f]{64})\.pdf$", 1).alias("doc_key"),
                                          F.sha2("content", 256).alias("body_hash"), F.col("modificationTime").alias("modified"))
         .write.mode("append").parquet(self.path))
        index = self.spark.read.schema(schemas.BODIES).parquet(self.path)
        return index.groupBy("doc_key").agg(F.max_by("body_hash", "modified").alias("body_hash"))
