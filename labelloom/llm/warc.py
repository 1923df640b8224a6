"""Content-addressed WARC archive.

An archive is a folder with two tables. ``payloads`` holds every distinct payload once, under
the SHA-256 of its bytes. ``records`` holds the exact header block of every record. Records
are put together again by joining the two on the digest the header names.

Both tables are written and read by Spark, so the folder can lie in any store. Neither a
record nor a payload passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.llm.columns import quoted
from labelloom.session import new_path

# Rows of one payload are dealt to so many tasks when they look for its first record.
SALTS = 16

# Payloads of fewer bytes are dealt to so many tasks for their responses: many may share them.
SHORT = 256

END = "\r\n"

# Names and values of the WARC 1.1 format, fixed values.
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_URN = "urn:page:"


def _bytes(html: Column) -> Column:
    return F.coalesce(F.encode(html, "UTF-8"), F.encode(F.lit(""), "UTF-8"))


def _one_line(url: Column) -> Column:
    """Line ends would end the header field; they are written as in URLs."""
    return F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _header(date: str) -> Column:
    """The header block of a record, up to and with the empty line."""
    revisit = F.col("refers_to").isNotNull()

    def field(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(END))

    return F.concat(
        F.lit(VERSION + END),
        field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        F.coalesce(field("WARC-Record-ID", F.concat(F.lit(f"<{RECORD_URN}"), F.col("page_id").cast("string"), F.lit(">"))), F.lit("")),
        F.coalesce(field("WARC-Target-URI", _one_line(F.col("url"))), F.lit("")),
        field("WARC-Date", F.lit(date)),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        F.when(revisit, field("WARC-Profile", F.lit(SAME_PAYLOAD))).otherwise(""),
        F.coalesce(
            field("WARC-Refers-To", F.concat(F.lit(f"<{RECORD_URN}"), F.col("refers_to").cast("string"), F.lit(">"))),
            F.lit(""),
        ),
        field("Content-Type", F.lit("text/html; charset=utf-8")),
        field("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes")).cast("string")),
        F.lit(END),
    )


def with_first(pages: DataFrame, smallest: int) -> DataFrame:
    """Adds refers_to: the smallest page_id with the same payload, null for that page itself.

    Payloads under the smallest size, and pages without a page_id, refer to nothing. Pages
    that share the smallest page_id and the payload are all first. The first page of each
    payload is found with a map-side combine; the pages of a payload that many share are
    dealt to several tasks for the join.
    """
    firsts = (
        pages.filter((F.col("payload_bytes") >= smallest) & F.col("page_id").isNotNull())
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("__llm_first"), F.count("*").alias("__llm_copies"))
        .filter(F.col("__llm_copies") > 1)
        .select("payload_digest", "__llm_first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__llm_salt"))
    )
    salted = pages.withColumn("__llm_salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    found = salted.join(firsts, ["payload_digest", "__llm_salt"], "left")
    later = (F.col("payload_bytes") >= smallest) & (F.col("page_id") > F.col("__llm_first"))
    return found.withColumn("refers_to", F.when(later, F.col("__llm_first"))).drop("__llm_salt", "__llm_first")


def write_archive(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    smallest: int = 100,
    date: str = "2024-01-01T00:00:00Z",
) -> None:
    """Writes a record for every page and every distinct payload once.

    The payload is the html in UTF-8; a null html is an empty payload. Of pages with equal
    payloads of at least ``smallest`` bytes the one with the smallest page_id becomes a
    response and the others revisits of it; all other pages become responses. A page without
    a page_id becomes a response without a record id, one without an url a record without a
    target. Line ends in an url are written percent-encoded. Repeated rows become records of
    their own. An empty table gives an archive without records. Other columns are not
    archived, whatever their names. The folder must not exist.

    Before anything is written under a digest, all payloads with that digest must agree in
    length and in a second, unrelated digest; else the write fails.
    """
    source = pages.select(
        pages[quoted(page_id)].alias("page_id"),
        pages[quoted(url)].cast("string").alias("url"),
        _bytes(pages[quoted(html)]).alias("payload"),
    ).withColumns({"payload_digest": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload").cast("long")})
    proof = F.concat_ws(":", F.md5("payload"), F.crc32("payload"), "payload_bytes")
    distinct = source.withColumn("proof", proof).groupBy("payload_digest").agg(
        F.first("payload").alias("payload"), F.min("proof").alias("low"), F.max("proof").alias("high")
    )
    agreed = F.when(F.col("low") == F.col("high"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("two payloads have the digest "), F.col("payload_digest")))
    )
    distinct.select("payload_digest", agreed.alias("payload")).write.parquet(f"{folder}/payloads")
    slim = source.select("page_id", "url", "payload_digest", "payload_bytes")
    with_first(slim, smallest).select(_header(date).alias("header")).write.parquet(f"{folder}/records")


def _value(name: str) -> Column:
    """A header field's value, null where the record has no such field."""
    found = F.regexp_extract("header", f"(?m)^{name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def read_records(spark: SparkSession, folder: str, id_type: str = "long") -> DataFrame:
    """One row per record: what its header says, and the header itself."""
    urn = f"^<{RECORD_URN}(.*)>$"

    def number(name: str) -> Column:
        return F.regexp_extract(_value(name), urn, 1).cast(id_type)

    records = spark.read.schema("header string").parquet(f"{folder}/records")
    return records.select(
        number("WARC-Record-ID").alias("page_id"),
        _value("WARC-Target-URI").alias("url"),
        _value("WARC-Type").alias("record_type"),
        number("WARC-Refers-To").alias("refers_to"),
        F.regexp_extract(_value("WARC-Payload-Digest"), "^sha256:(.*)$", 1).alias("payload_digest"),
        _value("Content-Length").cast("long").alias("content_length"),
        "header",
    )


def read_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """The stored payloads, each checked against the digest it is stored under."""
    payloads = spark.read.schema("payload_digest string, payload binary").parquet(f"{folder}/payloads")
    sound = F.sha2("payload", 256) == F.col("payload_digest")
    return payloads.select(
        "payload_digest",
        F.when(sound, F.col("payload"))
        .otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.col("payload_digest"))).cast("binary"))
        .alias("payload"),
    )


def _salt() -> Column:
    """The task a record is dealt to; records without an id are told apart by their target."""
    return F.pmod(F.xxhash64("header"), F.lit(SALTS)).cast("int")


def _salts() -> Column:
    return F.sequence(F.lit(0), F.lit(SALTS - 1))


def _without_payload(kind: str) -> Column:
    return F.raise_error(F.concat(F.lit("record without its payload: "), F.col("header"))).cast(kind)


def _responses(records: DataFrame, payloads: DataFrame) -> DataFrame:
    """The responses with their payload, which must have the length the header tells.

    A record of no known type is held to the same, not passed over. A short payload may have
    many responses: it is copied for several tasks. A longer one has one, but for rows without
    a page_id and repeated rows, which Spark can split.
    """
    salts = F.when(F.octet_length("payload") < SHORT, _salts()).otherwise(F.array(F.lit(0)))
    many = payloads.select("*", F.explode(salts).alias("__llm_salt"))
    own_salt = F.when(F.col("content_length") < SHORT, _salt()).otherwise(0)
    found = records.filter("NOT record_type <=> 'revisit'").withColumn("__llm_salt", own_salt)
    joined = found.join(many, ["payload_digest", "__llm_salt"], "left").drop("__llm_salt")
    whole = F.coalesce(F.col("content_length") == F.octet_length("payload"), F.lit(False))
    return joined.withColumn("payload", F.when(whole, F.col("payload")).otherwise(_without_payload("binary")))


def _revisits(records: DataFrame, payloads: DataFrame) -> DataFrame:
    """The revisits with payload_bytes, the size of the stored payload they name.

    Only digest and size travel, so a payload with many revisits is not copied.
    """
    sizes = payloads.select(
        "payload_digest", F.octet_length("payload").cast("long").alias("payload_bytes"), F.explode(_salts()).alias("__llm_salt")
    )
    found = records.filter("record_type = 'revisit'").withColumn("__llm_salt", _salt())
    joined = found.join(sizes, ["payload_digest", "__llm_salt"], "left").drop("__llm_salt")
    return joined.withColumn("payload_bytes", F.coalesce("payload_bytes", _without_payload("long")))


def _record(own: Column) -> Column:
    return F.concat(F.encode("header", "UTF-8"), own, F.encode(F.lit(END + END), "UTF-8"))


def read_pages(spark: SparkSession, folder: str, id_type: str = "long") -> DataFrame:
    """The archived pages' records with size and digest of their full payload, read back and checked.

    Responses are put together byte for byte, and size and digest are those of what the whole
    record holds between its header and its closing line ends. A revisit holds nothing there:
    its size and digest are those of the stored payload. Stored bytes are checked against their
    digest, and a record of either type whose payload is not stored is an error.
    """
    records, payloads = read_records(spark, folder, id_type), read_payloads(spark, folder)
    columns = [*records.columns, "payload_bytes"]
    rebuilt = _responses(records, payloads).withColumn("record", _record(F.col("payload"))).drop("payload")
    size = F.octet_length("record") - F.octet_length("header") - len(END + END)
    held = rebuilt.withColumn("own", F.substr("record", F.octet_length("header") + 1, size)).withColumns(
        {"payload_bytes": F.octet_length("own").cast("long"), "found": F.sha2("own", 256)}
    )
    digest = F.when(F.col("found") == F.col("payload_digest"), F.col("found")).otherwise(_without_payload("string"))
    return held.withColumn("payload_digest", digest).select(columns).union(_revisits(records, payloads).select(columns))


def rebuild_records(spark: SparkSession, folder: str) -> DataFrame:
    """The original records, byte for byte: header, own payload, and the closing line ends.

    A revisit carries no payload of its own, so its record has none; payload is the full one,
    copied to those tasks only that have revisits of it.
    """
    records, payloads = read_records(spark, folder), read_payloads(spark, folder)
    columns = ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload", "record"]
    responses = _responses(records, payloads).withColumn("record", _record(F.col("payload")))
    later = records.filter("record_type = 'revisit'").withColumn("__llm_salt", _salt())
    dealt = payloads.join(later.select("payload_digest", "__llm_salt").distinct(), "payload_digest")
    revisits = later.join(dealt, ["payload_digest", "__llm_salt"], "left").withColumns(
        {
            "payload": F.coalesce("payload", _without_payload("binary")),
            "record": _record(F.encode(F.lit(""), "UTF-8")),
        }
    )
    return responses.select(columns).union(revisits.select(columns))


def export_warc(spark: SparkSession, archive: str, folder: str) -> None:
    """The records as plain WARC files, one per task, written by Spark.

    The text writer ends each row with the two line ends that close a record. Only responses
    need their payloads.
    """
    records = read_records(spark, archive)
    responses = _responses(records, read_payloads(spark, archive))
    made = responses.select(F.concat("header", F.decode("payload", "UTF-8")).alias("value"))
    revisits = records.filter("record_type = 'revisit'").select(F.col("header").alias("value"))
    made.union(revisits).write.option("lineSep", END + END).text(folder)


def archive_pages(pages: DataFrame, smallest: int = 100, folder: str | None = None, **columns: str) -> DataFrame:
    """Writes the pages to an archive in the shared folder and reads it back."""
    spark = pages.sparkSession
    target = folder or new_path(spark, "warc")
    write_archive(pages, target, smallest=smallest, **columns)
    return read_pages(spark, target)
