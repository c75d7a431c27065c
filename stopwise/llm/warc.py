"""WARC archives: revisit resolution by payload digest, deduplicated writing, streamed reading.

Writing. Only headers are shuffled to find equal payloads: a table of digests that occur at least twice,
with the smallest id, comes from one aggregation (combined before the shuffle, so a payload that a third of
all rows share costs a row per task). Joined back to the rows, it makes each row a response (payload and
fresh headers) or a revisit (headers that refer to the response). Up to `small` repeated payloads (a count
proves it; about 200 bytes each) the join is a broadcast and no payload is shuffled; beyond, rows meet the
table in a join that is salted, so that no payload's rows are in one task, at the price of one shuffle of the
rows. Records are written through Spark's text writer, as gzipped files of WARC records (.txt.gz, the
extension of that writer).

Reading. A gzipped file is one task's stream of lines, and records are cut by Content-Length, so payloads
may hold anything, blank lines and record headers included; a task holds a batch and a record at most, and
waits for a long record to be whole before it looks at it again. Revisits are resolved by a join of headers
to those responses that a revisit names.

Defined cases: null payload is the empty one; payloads below min_bytes are never revisits; rows that share
the smallest id of a payload are all responses (an id may come with several payloads: a record's name is
made of both); rows with a null id are revisits where the payload has a row with an id, else responses; null
addresses and dates give no such header; line ends in addresses are escaped; very long payloads are written
and read whole; an empty table gives an archive without records; columns other than id, address, payload
and date are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_keyed, materialize, shared_dir, slices, table

_END = "\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(id_: Column, digest: Column) -> Column:
    """A name-based record id: the same id and payload get the same one in every run."""
    h = F.md5(F.concat(F.lit("record "), digest, F.lit(" "), F.coalesce(id_.cast("string"), F.lit("null"))))
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]))


def resolve(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", min_bytes: int = 100, small: int = 200_000) -> DataFrame:
    """Append payload (not null), payload_digest (SHA-256, hex), payload_bytes, record_type and refers_to_id (of revisits)."""
    payload = F.coalesce(F.col(f"`{payload_col}`"), F.lit(""))
    rows = pages.withColumns({"payload": payload, "payload_digest": F.sha2(payload.cast("binary"), 256), "payload_bytes": F.octet_length(payload).cast("long")})
    heads = rows.select(F.col(f"`{id_col}`").alias("id"), "payload_digest", "payload_bytes").filter(F.col("payload_bytes") >= min_bytes)
    twice = heads.groupBy("payload_digest").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    out = join_keyed(rows, materialize(twice), ["payload_digest"], "left", max_rows=small)
    revisit = F.col("first_id").isNotNull() & ~F.col(f"`{id_col}`").eqNullSafe(F.col("first_id"))
    return out.withColumn("record_type", F.when(revisit, "revisit").otherwise("response")).withColumn("refers_to_id", F.when(revisit, F.col("first_id"))).drop("first_id")


def records(resolved: DataFrame, id_col: str = "page_id", url_col: str = "url", date: Column | str = "2024-01-01T00:00:00Z") -> DataFrame:
    """One column `value`: the whole WARC/1.1 record of each row, but for its last line feed. date: one for all, or a column of times or texts."""
    when = F.lit(date) if isinstance(date, str) else date
    if dict(resolved.select(when.alias("d")).dtypes)["d"].startswith(("timestamp", "date")):
        when = F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(_END + _END))
    block = F.when(F.col("record_type") == "response", F.concat(head, F.col("payload"))).otherwise(head)
    url = F.regexp_replace(F.regexp_replace(F.col(f"`{url_col}`"), "\r", "%0D"), "\n", "%0A")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value)  # noqa: E731  null where the value is
    angle = lambda c: F.concat(F.lit("<"), c, F.lit(">"))
    revisit = F.col("record_type") == "revisit"
    lines = [
        F.lit("WARC/1.1"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", angle(record_id(F.col(f"`{id_col}`"), F.col("payload_digest")))),
        line("WARC-Date", when),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        F.when(revisit, line("WARC-Refers-To", angle(record_id(F.col("refers_to_id"), F.col("payload_digest"))))),
        F.when(revisit, F.lit(f"WARC-Profile: {_PROFILE}")),
        line("X-Row-ID", F.col(f"`{id_col}`").cast("string")),
        F.lit("Content-Type: application/http;msgtype=response"),
        line("Content-Length", F.octet_length(F.col("block")).cast("string")),
    ]
    return resolved.withColumn("block", block).select(F.concat(F.concat_ws(_END, *lines), F.lit(_END + _END), F.col("block"), F.lit("\r\n\r")).alias("value"))


def write(pages: DataFrame, path: str, id_col: str = "page_id", payload_col: str = "html", url_col: str = "url", min_bytes: int = 100, date: Column | str = "2024-01-01T00:00:00Z") -> None:
    """Write deduplicated archives, a file for each task (of at most 50,000 records)."""
    rows = resolve(pages, id_col, payload_col, min_bytes)
    records(rows, id_col, url_col, date).write.option("lineSep", "\n").option("compression", "gzip").option("maxRecordsPerFile", 50_000).text(path)


def parse(buffer: bytes) -> tuple[list[tuple], bytes, int]:
    """Whole records at the start of buffer, what is left, and how many bytes of that the next record needs at least."""
    out, at, need = [], 0, 0
    while True:
        end = buffer.find(b"\r\n\r\n", at)
        if end < 0:
            need = len(buffer) - at + 1
            break
        lines = buffer[at:end].decode("utf-8", "replace").split(_END)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record starts with {lines[0][:80]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        start = end + 4
        stop = start + int(fields["content-length"])
        if len(buffer) < stop + 4:
            need = stop + 4 - at
            break
        block = buffer[start:stop]
        _, gap, payload = block.partition(b"\r\n\r\n")
        trim = lambda k: fields[k].strip("<>") if k in fields else None
        out.append((fields.get("warc-type"), trim("warc-record-id"), trim("warc-refers-to"), fields.get("warc-target-uri"), fields.get("warc-date"), fields.get("warc-payload-digest"), fields.get("x-row-id"), payload if gap else block))
        at = stop + 4
    return out, buffer[at:], need


_READ = "record_type string, record_id string, refers_to_record string, url string, date string, digest string, row_id string, payload binary"


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of gzipped archives, headers and payload. Revisits have an empty payload here."""
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("value").cast("binary").alias("value"))
    names = [f.split()[0] for f in _READ.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = need = 0
        for b in slices(batches, 4096):
            held += [x + b"\n" for x in b.column(0).to_pylist()]
            size += sum(map(len, held[-b.num_rows :]))
            if size < need:
                continue
            got, rest, need = parse(b"".join(held))
            held, size = [rest], len(rest)
            if got:
                cols = list(zip(*got, strict=True))
                yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.string()) for c in cols[:-1]], pa.array(cols[-1], pa.binary())], names=names)
        if b"".join(held).strip():
            raise ValueError("an archive ends within a record")

    return lines.mapInArrow(run, _READ)


def resolved_headers(spark: SparkSession, path: str) -> DataFrame:
    """Every record with payload_bytes and payload_digest of its full payload; a revisit has those of the response that it names."""
    # the payload is measured and dropped before anything is shuffled
    heads = read(spark, path).withColumns({"bytes": F.octet_length("payload").cast("long"), "sha": F.sha2("payload", 256)}).drop("payload")
    heads = materialize(heads)
    response, revisit = heads.filter("record_type = 'response'"), heads.filter("record_type = 'revisit'")
    named = revisit.select(F.col("refers_to_record").alias("record_id")).distinct()
    # equal rows wrote equal records: one stands for all
    once = response.groupBy("record_id").agg(F.min(F.struct("row_id", "bytes", "sha")).alias("o"))
    originals = materialize(once.join(named, "record_id").select(F.col("record_id").alias("refers_to_record"), "o"))
    responses = response.select("row_id", F.col("bytes").alias("payload_bytes"), F.col("sha").alias("payload_digest"), "record_type", F.lit(None).cast("string").alias("refers_to"))
    revisits = join_keyed(revisit, originals, ["refers_to_record"], "left").select("row_id", F.col("o.bytes").alias("payload_bytes"), F.col("o.sha").alias("payload_digest"), "record_type", F.col("o.row_id").alias("refers_to"))
    return responses.unionByName(revisits)


def op8_warc(spark, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    write(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    out = resolved_headers(spark, path)
    return out.select(F.col("row_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


OP8_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM f
"""
