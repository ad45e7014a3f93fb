"""WARC derivatives: metadata and plain-text conversion records linked to their responses.

Every response record yields two records that refer to it: a ``conversion`` record
with the plain text of the page and a ``metadata`` record (``application/warc-fields``)
that keeps the source's HTTP headers and digests. Built-in functions only; one
scan, no shuffle.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame, functions as F

CRLF = "\r\n"
#: Character references: by name, by decimal and by hexadecimal code. Names are those of Python's table; others stay as they are.
REFERENCE = "&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
NAMES = {**name2codepoint, "apos": 0x27, "nbsp": 0x20}
#: Applied in order to the markup: what goes with its content (what is never closed goes to the end of the page, as in a browser),
#: what begins or ends a line, what parts the cells of a row, all other tags. A tag has no ``<`` inside, so that a search never reads a stretch of the page twice.
WHOLE = [r"!--.*?(?:-->|\z)", *[rf"{tag}[^<>]*>.*?(?:</{tag}[^<>]*>|\z)" for tag in ("script", "style", "title")]]
BLOCKS = (
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h[1-6] head header hr html "
    "legend li main menu nav ol option p pre search section select summary table tbody tfoot thead tr ul"
).split()
_REST = r"(?:[ \t\r\n\f/][^<>]*)?>"
STRIP = [
    (rf"(?is)<(?:{'|'.join(WHOLE)})", ""),
    (rf"(?i)</?(?:{'|'.join(BLOCKS)}){_REST}", "\n"),
    (rf"(?i)</?(?:td|th){_REST}", " "),
    (r"<[a-zA-Z/!?][^<>]*>", ""),
]
SPACES = [(r"[ \t\r\f]+", " "), (r" ?\n[ \n]*", "\n")]
TITLE = r"(?is)<title[^<>]*>(.*?)(?:</title|\z)"
LINK = r"(?i)<a [^<>]*href="


def decode_references(text: Column) -> Column:
    """Character references decoded, each once; codes that are no character become U+FFFD."""
    # a map is searched from its beginning
    common = ("amp", "lt", "gt", "quot", "nbsp", "apos")
    names = F.create_map(*[x for n in (*common, *sorted(set(NAMES) - set(common))) for x in (F.lit(n), F.lit(chr(NAMES[n])))])

    def decoded(m: Column) -> Column:
        body = F.substring(m, 2, F.length(m) - 2)
        digits = F.when(F.lower(F.substring(body, 2, 1)) == "x", F.conv(F.substring(body, 3, F.length(body)), 16, 10)).otherwise(F.substring(body, 2, F.length(body)))
        code = digits.try_cast("int")
        fine = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code <= 0x10FFFF))
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(fine, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")
        return F.when(m.isNull(), "").when(body.startswith("#"), char).otherwise(F.coalesce(F.try_element_at(names, body), m))

    def whole(t: Column) -> Column:
        pieces = F.arrays_zip(F.split(t, REFERENCE, -1).alias("p"), F.regexp_extract_all(t, F.lit(REFERENCE), F.lit(0)).alias("m"))
        return F.when(t.contains("&"), F.array_join(F.transform(pieces, lambda x: F.concat(x["p"], decoded(x["m"]))), "")).otherwise(t)

    # the text, which may be costly to make, is made once
    return F.element_at(F.transform(F.array(text), whole), 1)


def html_to_text(html: Column) -> Column:
    """Plain text of a page: no scripts, styles, comments or title; one line for each block and each row of a table, a space between its cells;
    references decoded; white space collapsed (in preformatted text too)."""
    for pattern, to in STRIP:
        html = F.regexp_replace(html, pattern, to)
    html = decode_references(html)
    for pattern, to in SPACES:
        html = F.regexp_replace(html, pattern, to)
    return F.trim(html, F.lit(" \n"))


def one_line(value: Column) -> Column:
    """For a header's value: line ends percent-encoded, so that it can't begin a header of its own."""
    return F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def record_uuid(kind: str, *parts: Column) -> Column:
    """A URN that is a function of ``parts``, so a rerun makes the same record."""
    h = F.md5(F.concat_ws("|", F.lit(kind), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))
    groups = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *groups), F.lit(">"))


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block.cast("binary"), 256))


def _header(kind: str, fields: list[tuple[str, Column]]) -> Column:
    parts = [F.lit(f"WARC/1.1{CRLF}WARC-Type: {kind}{CRLF}")]
    for name, value in fields:
        parts += [F.lit(f"{name}: "), value, F.lit(CRLF)]
    return F.concat(*parts, F.lit(CRLF))


def derivatives(responses: DataFrame, key: str, warcinfo_id: str = "<urn:uuid:00000000-0000-0000-0000-000000000000>") -> DataFrame:
    """Two rows for each response record: ``metadata`` and ``conversion``.

    ``responses`` needs the columns ``key``, ``record_id``, ``target_uri``, ``warc_date`` (strings),
    ``http_headers`` (the source's header lines, CRLF between them) and ``payload`` (the HTML).
    Returns ``key, record_type, record_id, refers_to, target_uri, warc_date, content_type,
    content_length, block_digest, source_payload_digest, warc_header, block``; the record
    as written to a file is ``warc_header || block || CRLF CRLF``.

    A null payload is an empty one, a null URI or date or header list an empty string.
    Equal responses give equal records, once for each row; responses that differ in their payload alone have records of their own.
    Line ends in a URI, a date or an identifier are percent-encoded in the header. Other columns are ignored.
    """
    r = responses.select(
        F.col(key),
        F.col("record_id").alias("source_id"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("target_uri", "warc_date", "http_headers", "payload")],
    ).withColumn("source_payload_digest", digest(F.col("payload")))
    title = F.regexp_replace(decode_references(F.regexp_extract("payload", TITLE, 1)), r"[ \t\r\n\f]+", " ")
    links = F.regexp_count("payload", F.lit(LINK))
    fields = F.concat(
        F.lit("title: "), title, F.lit(CRLF + "outlinks: "), links.cast("string"), F.lit(CRLF + "sourcePayloadDigest: "), F.col("source_payload_digest"),
        F.lit(CRLF + "sourceContentLength: "), F.octet_length("payload").cast("string"), F.lit(CRLF),
        F.when(F.col("http_headers") == "", "").otherwise(
            F.concat(F.lit("http-header: "), F.regexp_replace("http_headers", "\r\n|\r|\n", CRLF + "http-header: "), F.lit(CRLF))
        ),
    )
    kinds = F.array(
        F.struct(F.lit("metadata").alias("record_type"), F.lit("application/warc-fields").alias("content_type"), fields.alias("block")),
        F.struct(F.lit("conversion").alias("record_type"), F.lit("text/plain; charset=utf-8").alias("content_type"), html_to_text(F.col("payload")).alias("block")),
    )
    rows = r.withColumn("record", F.explode(kinds)).select("*", "record.*").drop("record", "payload", "http_headers")
    rows = rows.withColumn("record_id", record_uuid("derived", F.col("record_type"), F.col("source_id"), F.col("source_payload_digest"))).withColumn("block_digest", digest(F.col("block")))
    rows = rows.withColumn("content_length", F.octet_length("block").cast("long"))
    common = [
        ("WARC-Record-ID", F.col("record_id")), ("WARC-Refers-To", one_line(F.coalesce("source_id", F.lit("")))), ("WARC-Refers-To-Target-URI", one_line(F.col("target_uri"))),
        ("WARC-Refers-To-Date", one_line(F.col("warc_date"))), ("WARC-Target-URI", one_line(F.col("target_uri"))), ("WARC-Date", one_line(F.col("warc_date"))),
        ("WARC-Warcinfo-ID", F.lit(warcinfo_id)), ("WARC-Block-Digest", F.col("block_digest")), ("Content-Type", F.col("content_type")),
        ("Content-Length", F.col("content_length").cast("string")),
    ]
    header = F.when(F.col("record_type") == "metadata", _header("metadata", common)).otherwise(_header("conversion", common))
    return rows.select(
        key, "record_type", "record_id", F.col("source_id").alias("refers_to"), "target_uri", "warc_date", "content_type",
        "content_length", "block_digest", "source_payload_digest", header.alias("warc_header"), "block",
    )


def page_responses(pages: DataFrame, warc_date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """``pages`` as response records: a stable identifier, and the headers of a plain HTML answer."""
    size = F.octet_length(F.coalesce("html", F.lit(""))).cast("string")
    return pages.select(
        "page_id",
        record_uuid("response", F.col("page_id"), F.col("url"), digest(F.coalesce("html", F.lit("")))).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(warc_date).alias("warc_date"),
        F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), size).alias("http_headers"),
        F.col("html").alias("payload"),
    )


def op1(pages: DataFrame) -> DataFrame:
    return derivatives(page_responses(pages), "page_id")


def _sql_regex(column: str, steps: list[tuple[str, str]]) -> str:
    for pattern, to in steps:
        shown = "'" + to.replace("'", "''") + "'" if "\n" not in to else "chr(10)"
        column = f"regexp_replace({column}, '{pattern}', {shown}, 'g')"
    return column


def _sql_decoded(text: str) -> str:
    names = "MAP {" + ", ".join(f"'{n}': {c}" for n, c in sorted(NAMES.items())) + "}"
    code = f"""CASE WHEN m IS NULL THEN NULL WHEN lower(substr(m, 2, 2)) = '#x' THEN CAST('0x' || substr(m, 4, length(m) - 4) AS INTEGER)
      WHEN substr(m, 2, 1) = '#' THEN CAST(substr(m, 3, length(m) - 3) AS INTEGER) ELSE {names}[substr(m, 2, length(m) - 2)] END"""
    char = f"CASE WHEN m IS NULL THEN '' WHEN ({code}) IS NULL THEN m WHEN (({code}) BETWEEN 1 AND 55295) OR (({code}) BETWEEN 57344 AND 1114111) THEN chr({code}) ELSE chr(65533) END"
    return f"""array_to_string(list_transform(list_zip(regexp_split_to_array({text}, '{REFERENCE}'), regexp_extract_all({text}, '{REFERENCE}')),
      lambda z: z[1] || list_transform([z[2]], lambda m: {char})[1]), '')"""


def op1_sql() -> str:
    """The same rows in DuckDB's SQL."""
    text = _sql_regex("payload", STRIP)
    text = f"trim({_sql_regex(_sql_decoded(text), SPACES)}, ' ' || chr(10))"
    title = _sql_decoded(f"regexp_extract(payload, '{TITLE}', 1)")
    line = lambda c: f"replace(replace({c}, chr(13), '%0D'), chr(10), '%0A')"
    crlf = "chr(13) || chr(10)"
    uid = "'<urn:uuid:' || substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' || substr({h}, 17, 4) || '-' || substr({h}, 21, 12) || '>'"
    header = " || ".join(
        f"'{name}: ' || {value} || {crlf}"
        for name, value in [
            ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"), ("WARC-Refers-To-Target-URI", line("target_uri")),
            ("WARC-Refers-To-Date", "warc_date"), ("WARC-Target-URI", line("target_uri")), ("WARC-Date", "warc_date"),
            ("WARC-Warcinfo-ID", "'<urn:uuid:00000000-0000-0000-0000-000000000000>'"), ("WARC-Block-Digest", "block_digest"),
            ("Content-Type", "content_type"), ("Content-Length", "content_length"),
        ]
    )
    return rf"""
WITH source AS (
  SELECT page_id, md5('response|' || coalesce(CAST(page_id AS VARCHAR), '') || '|' || coalesce(url, '') || '|sha256:' || sha256(coalesce(html, ''))) AS h, coalesce(url, '') AS target_uri, '2024-01-01T00:00:00Z' AS warc_date, coalesce(html, '') AS payload
  FROM pages
), response AS (
  SELECT *, {uid.format(h="h")} AS refers_to, 'sha256:' || sha256(payload) AS source_payload_digest FROM source
), made AS (
  SELECT page_id, refers_to, target_uri, warc_date, source_payload_digest, 'conversion' AS record_type, 'text/plain; charset=utf-8' AS content_type,
    {text} AS block FROM response
  UNION ALL
  SELECT page_id, refers_to, target_uri, warc_date, source_payload_digest, 'metadata', 'application/warc-fields',
    'title: ' || regexp_replace({title}, '[ \t\r\n\f]+', ' ', 'g') || {crlf}
    || 'outlinks: ' || len(regexp_extract_all(payload, '{LINK}')) || {crlf}
    || 'sourcePayloadDigest: ' || source_payload_digest || {crlf} || 'sourceContentLength: ' || strlen(payload) || {crlf}
    || 'http-header: HTTP/1.1 200 OK' || {crlf} || 'http-header: Content-Type: text/html; charset=utf-8' || {crlf} || 'http-header: Content-Length: ' || strlen(payload) || {crlf}
  FROM response
), named AS (
  SELECT *, md5('derived|' || record_type || '|' || refers_to || '|' || source_payload_digest) AS d, 'sha256:' || sha256(block) AS block_digest, CAST(strlen(block) AS BIGINT) AS content_length FROM made
), records AS (SELECT *, {uid.format(h="d")} AS record_id FROM named)
SELECT page_id, record_type, record_id, refers_to, target_uri, warc_date, content_type, content_length, block_digest, source_payload_digest,
  'WARC/1.1' || {crlf} || 'WARC-Type: ' || record_type || {crlf} || {header} || {crlf} AS warc_header, block
FROM records"""
