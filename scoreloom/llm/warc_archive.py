"""A content-addressed web archive: payloads once, record headers apart.

Two written tables make an archive.

- ``payloads``: ``digest`` (SHA-256), ``payload``. Every payload of at least
  ``min_bytes`` bytes stands here once, by its digest.
- ``headers``: a row for each record, with the exact bytes of its WARC and HTTP
  headers, the digest of its payload, and what the record refers to.

Records come back by a join of the two, and every payload is digested anew on
the way; one that does not fit its digest stops the read. ``export_warc``
writes standard WARC files of the same records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.llm.numbering import numbered
from scoreloom.plans.staging import release, stage

_CRLF = r"'\r\n'"
# A URL is one header value: line ends inside it would end the header.
_URL = r"regexp_replace(coalesce(url, ''), '[\\x00-\\x20\\x7F]', '')"
_STAMP = "2024-01-01T00:00:00Z"


def base32_sha1(payload: str) -> str:
    """SQL: the bare upper-case base32 SHA-1; 40 bits give 8 digits, four times."""
    parts = ", ".join(f"lpad(conv(substr(d, {1 + 10 * i}, 10), 16, 32), 8, '0')" for i in range(4))
    made = f"translate(concat({parts}), '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')"
    return f"transform(array(sha1({payload})), d -> {made})[0]"


def _uuid(key: str) -> str:
    d = f"md5({key})"
    return "concat_ws('-', " + ", ".join(f"substr({d}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) + ")"


def _id(page: str) -> str:
    return f"concat('<urn:uuid:', {_uuid(f'concat({page}, {chr(39)}/record{chr(39)})')}, '>')"


def _header() -> str:
    """SQL: the header block of a record, its closing blank line included."""
    http = rf"concat('HTTP/1.1 200 OK', {_CRLF}, 'Content-Type: text/html; charset=utf-8', {_CRLF}, 'Content-Length: ', payload_bytes, {_CRLF}, {_CRLF})"
    held = "CASE WHEN record_type = 'response' THEN payload_bytes ELSE 0 END"
    lines = [
        "'WARC/1.1'",
        "concat('WARC-Type: ', record_type)",
        f"concat('WARC-Record-ID: ', {_id('record')})",
        f"'WARC-Date: {_STAMP}'",
        f"concat('WARC-Target-URI: ', {_URL})",
        "concat('WARC-Payload-Digest: sha1:', payload_digest)",
        f"CASE WHEN record_type = 'revisit' THEN concat_ws({_CRLF}, 'WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest', concat('WARC-Refers-To: ', {_id('kept_record')})) END",
        "'Content-Type: application/http; msgtype=response'",
        f"concat('Content-Length: ', octet_length({http}) + {held})",
    ]
    return f"CAST(concat(concat_ws({_CRLF}, {', '.join(lines)}), {_CRLF}, {_CRLF}, {http}) AS binary)"


def _numbered(digests: DataFrame) -> DataFrame:
    """``digests`` with ``copy``: 0, or the number of the row among those of one page_id and payload."""
    key = ["place", "digest"]
    repeated = stage(digests.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select(*key), "repeated")
    if repeated.isEmpty():
        return digests.selectExpr("*", "0L AS copy")
    copies = numbered(digests.join(repeated, key, "left_semi"), key, [F.asc("url")], "copy")
    return digests.join(repeated, key, "left_anti").selectExpr("*", "0L AS copy").unionByName(copies)


def archive(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write ``pages (page_id, url, html)`` as an archive below ``path``: a record for every row.

    Payload: the html in UTF-8; a null is empty. Of records with equal payloads
    the one with the smallest page_id is the response, the others revisit it;
    payloads under ``min_bytes`` are responses always, and stored per record's
    digest all the same. Rows that repeat a page_id and a payload are numbered
    by url; the number stands in the record ID, and the first is the one that
    others refer to. A page without page_id is a record without one, before all
    others. A null url is empty. Other columns are ignored; an empty table
    gives an empty archive.
    """
    content = pages.selectExpr("CAST(page_id AS bigint) AS page_id", "CAST(url AS string) AS url", "CAST(coalesce(html, '') AS string) AS payload")
    digests = stage(
        content.selectExpr(
            "page_id", "url", "coalesce(page_id, -9223372036854775808) AS place", "unhex(sha2(payload, 256)) AS digest",
            f"{base32_sha1('payload')} AS payload_digest", "bigint(octet_length(payload)) AS payload_bytes",
        ),
        "digests",
    )
    # Hot payloads add up before the shuffle; both digests must tell the same story.
    kept = stage(
        digests.groupBy("digest").agg(
            F.min("place").alias("kept_place"), F.min("page_id").alias("kept_id"), F.min("payload_digest").alias("lo"), F.max("payload_digest").alias("hi"),
            F.min("payload_bytes").alias("least"), F.max("payload_bytes").alias("most"),
        ).selectExpr("digest", "kept_place", "CASE WHEN kept_place > -9223372036854775808 THEN kept_id END AS kept_id",
                     "CASE WHEN lo = hi AND least = most THEN true ELSE raise_error('two payloads with one digest') END AS verified"),
        "kept",
    )
    headers = (
        _numbered(digests).join(kept.where("verified"), "digest")
        .selectExpr("*", f"CASE WHEN (place = kept_place AND copy = 0) OR payload_bytes < {min_bytes} THEN 'response' ELSE 'revisit' END AS record_type")
        .selectExpr("*", "concat(coalesce(CAST(page_id AS string), 'none'), '/', hex(digest), CASE WHEN copy > 0 THEN concat('/', copy) ELSE '' END) AS record", "concat(coalesce(CAST(kept_id AS string), 'none'), '/', hex(digest)) AS kept_record")
        .selectExpr("page_id", "digest", "record_type", "CASE WHEN record_type = 'revisit' THEN kept_id END AS refers_to", f"{_header()} AS header")
    )
    headers.write.parquet(f"{path}/headers")
    # One row of each payload goes to the store, found by its page and digest; the join moves payloads once, by page.
    stored = content.selectExpr("coalesce(page_id, -9223372036854775808) AS kept_place", "CAST(payload AS binary) AS payload", "unhex(sha2(payload, 256)) AS digest")
    stored.join(kept.select("digest", "kept_place"), ["kept_place", "digest"]).dropDuplicates(["kept_place", "digest"]).select("digest", "payload").write.parquet(f"{path}/payloads")
    release(digests, kept)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The records of an archive: ``page_id, record_type, refers_to, header, payload, digest``, payloads verified.

    A revisit gets the payload of the record it refers to. A record whose
    payload is missing or does not fit its digest raises.
    """
    payloads = spark.read.parquet(f"{path}/payloads").selectExpr(
        "digest", "CASE WHEN unhex(sha2(payload, 256)) = digest THEN payload ELSE CAST(raise_error('a payload does not fit its digest') AS binary) END AS payload"
    )
    headers = spark.read.parquet(f"{path}/headers")
    return headers.join(payloads, "digest", "left").selectExpr(
        "page_id", "record_type", "refers_to", "header", "digest",
        "coalesce(payload, CAST(raise_error('a payload is missing') AS binary)) AS payload",
    )


_RECORD = "concat(header, CASE WHEN record_type = 'response' THEN payload ELSE CAST('' AS binary) END, CAST('\\r\\n\\r\\n' AS binary))"


def records(archived: DataFrame) -> DataFrame:
    """The original records, byte by byte: ``page_id, record``, the two closing line ends included."""
    return archived.selectExpr("page_id", f"{_RECORD} AS record")


def export_warc(archived: DataFrame, path: str) -> None:
    """Write standard WARC files, one a task; any WARC reader takes them."""
    # A row ends with one line end of the record, the writer adds the other.
    records(archived).selectExpr("CAST(substring(record, 1, octet_length(record) - 2) AS string) AS value").write.option("lineSep", "\r\n").text(path)


def record_digests(archived: DataFrame) -> DataFrame:
    """Per record what its headers and its payload say, digested from the payload read back."""
    return archived.selectExpr(
        "page_id", "bigint(octet_length(payload)) AS payload_bytes", f"{base32_sha1('payload')} AS payload_digest", "record_type", "refers_to",
        r"regexp_extract(CAST(header AS string), 'WARC-Payload-Digest: sha1:([A-Z2-7]+)', 1) AS header_digest",
    )


def rebuilt_digests(archived: DataFrame) -> DataFrame:
    """As ``record_digests``, from every record built anew: a response's payload is cut out of its record.

    A record whose header tells another type, length or payload digest raises.
    """
    said = archived.selectExpr(
        "page_id", "record_type", "refers_to", f"{_RECORD} AS record", "octet_length(header) AS head_bytes",
        "CASE WHEN record_type = 'response' THEN CAST(NULL AS binary) ELSE payload END AS elsewhere", "CAST(header AS string) AS head",
    ).selectExpr(
        "*", r"regexp_extract(head, 'WARC-Type: ([a-z]+)', 1) AS said_type", r"regexp_extract(head, 'WARC-Payload-Digest: sha1:([A-Z2-7]+)', 1) AS header_digest",
        rf"octet_length(substring_index(head, concat({_CRLF}, {_CRLF}), 1)) + try_cast(regexp_extract(head, 'Content-Length: ([0-9]+)', 1) AS bigint) + 8 AS said_bytes",
    )
    found = said.selectExpr("*", "coalesce(elsewhere, substring(record, head_bytes + 1, octet_length(record) - head_bytes - 4)) AS payload").selectExpr(
        "*", f"{base32_sha1('payload')} AS found_digest"
    )
    return found.selectExpr(
        "page_id", "bigint(octet_length(payload)) AS payload_bytes",
        "CASE WHEN said_type = record_type AND said_bytes = octet_length(record) AND header_digest = found_digest THEN found_digest ELSE raise_error('a header does not fit its record') END AS payload_digest",
        "said_type AS record_type", "refers_to", "header_digest",
    )
