"""A content-addressed archive of WARC records.

An archive is a folder of two tables:

* ``payloads``: each payload's bytes once, under their SHA-256 digest (Parquet).
* ``headers``: the exact header block of every record, in WARC/1.1 syntax, as
  text files whose blocks end with an empty line, so that Spark's text reader
  can split them.

Records with equal payloads of at least ``MIN_BYTES`` bytes are one response, the
one with the lowest id, and revisits that refer to it; smaller payloads are not
worth a revisit and all their records are responses.

Digests are verified when the archive is written (rows with one digest must agree
in length and in a second hash of the payload) and when it is read (the stored
bytes must have the digest that they are filed under and the length that the
header states). Records come back by a join of headers and payloads on the
digest; digests that many headers name are salted, so that no task gathers a
payload's records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodframe.llm.common import small, stored

MIN_BYTES = 100
#: Records of one payload that a task joins; a payload with more is joined in salted parts.
HOT = 1_000
#: WARC syntax: lines end with this, header blocks and records with two of them.
EOL = "\r\n"
#: Pages of the tables have no date of capture.
NO_DATE = "1970-01-01T00:00:00Z"


def _field(name: str, value: Column) -> Column:
    """A header line, null if the value is null."""
    return F.concat(F.lit(name + ": "), value, F.lit(EOL))


def _stated(block: Column, name: str) -> Column:
    """The value of a header field, null if the block has no such field."""
    value = F.regexp_extract(block, rf"(?:\A|\n){name}: ([^\r]*)", 1)
    return F.when(block.rlike(rf"(?:\A|\n){name}: "), value)


def _record_id(id_: Column, ordinal: Column) -> Column:
    """``<urn:record:ID:N>``; a null id leaves the first part empty."""
    return F.concat(F.lit("<urn:record:"), F.coalesce(F.url_encode(id_.cast("string")), F.lit("")), F.lit(":"), ordinal.cast("string"), F.lit(">"))


def _id_of(record_id: Column, kind: str) -> Column:
    text = F.regexp_extract(record_id, r"\A<urn:record:([^:]*):", 1)
    return F.when(text != "", F.url_decode(text)).cast(kind)


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  date: str = NO_DATE) -> None:
    """Write a record per row of ``pages`` to the archive ``path``.

    A string payload is stored in UTF-8, a null one is empty. Null ids come after
    all others; of rows with one id and payload the lowest url (null first) leads,
    then the earliest row. Repeated rows are records of their own. A null url has
    no target field; one with control characters is written in Base64. Other
    columns are not read. An empty table makes an empty archive.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    rows.select("digest", "payload").dropDuplicates(["digest"]).write.parquet(f"{path}/payloads")
    # the ordinal tells repeated rows apart; it is stored before anything is derived from it
    drafts = stored(rows.select("id", "url", "digest", F.octet_length("payload").cast("long").alias("bytes"),
                                F.xxhash64("payload").alias("second"), F.monotonically_increasing_id().alias("ordinal")), "drafts")
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "url", "ordinal")
    copies = drafts.groupBy("digest").agg(
        F.count("*").alias("n"), F.min(rank).alias("first"), F.min("bytes").alias("bytes"), F.max("bytes").alias("most"),
        F.min("second").alias("low"), F.max("second").alias("high")).filter("n > 1")
    clash = F.when((F.col("low") != F.col("high")) | (F.col("bytes") != F.col("most")),
                   F.raise_error(F.concat(F.lit("different payloads have the digest "), "digest")).cast("boolean")).otherwise(F.lit(False))
    copies = small(copies.filter(~clash).filter(F.col("bytes") >= MIN_BYTES).select("digest", "first"), "copies")
    named = drafts.join(copies, "digest", "left")
    revisit = F.coalesce(F.col("first.ordinal") != F.col("ordinal"), F.lit(False))
    plain = ~F.col("url").rlike(r"[\x00-\x1F\x7F]|\A | \z")
    block = F.concat(
        F.lit("WARC/1.1" + EOL),
        _field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _field("WARC-Record-ID", _record_id(F.col("id"), F.col("ordinal"))),
        _field("WARC-Date", F.lit(date)),
        F.coalesce(F.when(plain, _field("WARC-Target-URI", F.col("url"))),
                   _field("WARC-Target-URI-Base64", F.base64(F.col("url").cast("binary"))), F.lit("")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        F.when(revisit, F.concat(
            _field("WARC-Refers-To", _record_id(F.col("first.id"), F.col("first.ordinal"))),
            _field("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        )).otherwise(F.lit("")),
        _field("Content-Type", F.lit("text/html; charset=utf-8")),
        _field("WARC-Payload-Length", F.col("bytes").cast("string")),
        F.concat(F.lit("Content-Length: "), F.when(revisit, 0).otherwise(F.col("bytes")).cast("string")))
    named.select(block.alias("value")).write.option("lineSep", EOL * 2).option("compression", "gzip").text(f"{path}/headers")


def read_headers(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """One row per record: ``block`` (its exact header, without the empty line
    that ends it) and the fields read from it."""
    blocks = spark.read.option("lineSep", EOL * 2).text(f"{path}/headers").withColumnRenamed("value", "block")
    block = F.col("block")
    return blocks.select(
        "block", _stated(block, "WARC-Type").alias("record_type"), _stated(block, "WARC-Record-ID").alias("record_id"),
        _id_of(_stated(block, "WARC-Record-ID"), id_type).alias("id"),
        F.coalesce(_stated(block, "WARC-Target-URI"), F.unbase64(_stated(block, "WARC-Target-URI-Base64")).cast("string")).alias("url"),
        F.regexp_extract(block, r"\nWARC-Payload-Digest: sha256:([0-9a-f]+)", 1).alias("digest"),
        _stated(block, "WARC-Payload-Length").cast("long").alias("bytes"),
        _id_of(_stated(block, "WARC-Refers-To"), id_type).alias("refers_to"))


def read_archive(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """The records of an archive: the fields of ``read_headers``, ``payload`` (of
    a revisit: that of its response), ``payload_bytes`` and ``payload_digest`` of
    the bytes found, and ``record``, the record's exact bytes. Fails if a stored
    payload does not have its digest or its stated length."""
    headers = stored(read_headers(spark, path, id_type), "headers")
    used = small(headers.groupBy("digest").agg(F.count("*").alias("n")).filter(F.col("n") > HOT).select(
        "digest", F.ceil(F.col("n") / HOT).cast("int").alias("salts")), "hot")
    salts = F.coalesce("salts", F.lit(1))
    headers = headers.join(used, "digest", "left").withColumn("salt", F.pmod(F.xxhash64("record_id"), salts).cast("int")).drop("salts")
    payloads = spark.read.schema("digest string, payload binary").parquet(f"{path}/payloads").select(
        "digest", "payload", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"))
    payloads = payloads.join(used, "digest", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
    wrong = F.raise_error(F.concat(F.lit("payload does not match its header: "), "record_id")).cast("string")
    sound = (F.col("payload_digest") == F.col("digest")) & (F.col("payload_bytes") == F.col("bytes"))
    both = headers.join(payloads, ["digest", "salt"], "left").withColumn(
        "payload_digest", F.when(F.coalesce(sound, F.lit(False)), F.col("payload_digest")).otherwise(wrong))
    body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    end = F.lit((EOL * 2).encode())
    return both.withColumn("record", F.concat(F.col("block").cast("binary"), end, body, end)).drop("salt", "bytes", "digest")


def export_warc(records: DataFrame, path: str) -> None:
    """Write ``read_archive``'s records as plain WARC files, each record whole in
    one file, by Spark's text writer (every record ends with its separator)."""
    tail = len(EOL * 2)
    body = F.expr(f"substring(record, 1, octet_length(record) - {tail})").cast("string")
    records.select(body.alias("value")).write.option("lineSep", EOL * 2).text(path)
