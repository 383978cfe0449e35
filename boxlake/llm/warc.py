"""Content-addressed archive of WARC records.

An archive is a folder of three Parquet tables. `payloads` holds the bytes of each distinct payload once, under its SHA-256;
`headers` holds the exact header block of each record and the digest of its payload; `digests` names, for each digest, the
record that stands for it. Reading joins headers to payloads by digest and checks every payload against its digest first; a
mismatch fails the job.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes, the one with the largest id is a response and the others are
revisits that refer to it. Smaller payloads are responses each.

Payloads cross one shuffle, at writing, keyed by digest and id, which is as good as unique; digests with many records cross only as short
rows. A null html is an empty payload; a null id sorts below all others and refers to the largest like them; rows that repeat an id and payload are records of their own and of the same type.
A null url leaves its header field out, line breaks in one are removed. A very long payload is one value, as Spark's rows hold it. An empty table gives an empty
archive. Other columns aren't read.

`write` archives pages, for which it makes headers; `archive` takes records with headers of their own, as `import_files` reads them, and keeps both byte for byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxlake.llm.common import scratch_dir, stored

MIN_REVISIT = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
URN = "urn:boxlake:page:"
LINE, END = "\r\n", "\r\n\r\n"
FILE_RECORDS = 2000
_LEAST = -(1 << 63)


def _described(pages: DataFrame, id_: str, url: str, html: str) -> DataFrame:
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_).cast("bigint").alias("page_id"), F.regexp_replace(url, r"[\r\n]", "").alias("url"), payload.alias("payload"))
    return rows.withColumns({"sha256": F.sha2("payload", 256), "payload_bytes": F.length("payload").cast("bigint")})


def _urn(id_: str) -> Column:
    return F.concat(F.lit(f"<{URN}"), F.coalesce(F.col(id_).cast("string"), F.lit("none")), F.lit(">"))


def _header() -> Column:
    revisit = F.col("record_type") == "revisit"
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), "record_type"),
        F.concat(F.lit("WARC-Record-ID: "), _urn("page_id")),
        F.concat(F.lit("WARC-Target-URI: "), "url"),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), "sha256"),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _urn("refers_to"))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit("0")).otherwise(F.col("payload_bytes").cast("string"))),
    ]
    return F.concat(F.concat_ws(LINE, *lines), F.lit(END))


def write(pages: DataFrame, path: str, id_: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Write the archive of one record per row of pages to a new folder that all machines share."""
    rows = _described(pages, id_, url, html)
    narrow = stored(rows.drop("payload"), f"{path}/index")
    digests = stored(narrow.groupBy("sha256").agg(F.max("page_id").alias("canonical"), F.count("*").alias("records")), f"{path}/digests")
    typed = narrow.join(digests, "sha256")
    older = (F.col("payload_bytes") >= MIN_REVISIT) & (F.coalesce("page_id", F.lit(_LEAST)) < F.col("canonical"))
    typed = typed.withColumn("refers_to", F.when(older, F.col("canonical")))
    typed = typed.withColumn("record_type", F.when(F.col("refers_to").isNotNull(), "revisit").otherwise("response"))
    typed.select("page_id", "sha256", _header().alias("header")).write.parquet(f"{path}/headers")
    keyed = rows.select("sha256", F.coalesce("page_id", F.lit(_LEAST)).alias("k"), "payload")
    _write_payloads(keyed, digests.select("sha256", F.coalesce("canonical", F.lit(_LEAST)).alias("k")), path)


def _write_payloads(keyed: DataFrame, first: DataFrame, path: str) -> None:
    """Each digest's payload once: of keyed (sha256, k, payload), a row with the k that first (sha256, k) names."""
    one = keyed.join(first, ["sha256", "k"]).withColumn("n", F.row_number().over(W.partitionBy("sha256", "k").orderBy(F.lit(1))))
    one.filter("n = 1").select("sha256", "payload").write.parquet(f"{path}/payloads")


def archive(records: DataFrame, path: str) -> None:
    """Write the archive of records (header_bytes, header, block), as of import_files(), to a new folder that all machines share."""
    rows = records.select("header_bytes", "header", F.coalesce("block", F.lit(b"")).alias("payload"))
    rows = rows.withColumns({"sha256": F.sha2("payload", 256), "k": F.xxhash64("header_bytes")})
    narrow = stored(rows.select("sha256", "k", "header_bytes", "header"), f"{path}/headers")
    _write_payloads(rows.select("sha256", "k", "payload"), narrow.groupBy("sha256").agg(F.min("k").alias("k")), path)


def originals(spark: SparkSession, path: str) -> DataFrame:
    """header_bytes, header and block of each record of archive(), byte for byte."""
    found = payloads(spark, path).withColumnRenamed("payload", "block")
    return spark.read.parquet(f"{path}/headers").join(found, "sha256", "left").select("header_bytes", "header", "block")


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """sha256 and payload of each distinct payload; reading a payload that doesn't match its digest fails."""
    rows = spark.read.parquet(f"{path}/payloads")
    wrong = F.raise_error(F.concat(F.lit("payload differs from its digest "), "sha256")).cast("binary")
    return rows.withColumn("payload", F.when(F.sha2("payload", 256) == F.col("sha256"), F.col("payload")).otherwise(wrong))


def restore(spark: SparkSession, path: str, derive: dict[str, Column] | None = None) -> DataFrame:
    """page_id, header and payload of each record; with derive, columns computed of the payload instead of it.

    derive's columns are computed where the payload lies, so that only they cross the join.
    """
    found = payloads(spark, path)
    if derive is not None:
        found = found.select("sha256", *(c.alias(k) for k, c in derive.items()))
    return spark.read.parquet(f"{path}/headers").join(found, "sha256", "left").drop("sha256")


def field(name: str) -> Column:
    """A field of the header block, null if it is absent."""
    return F.nullif(F.regexp_extract("header", rf"\r\n{name}: ([^\r]*)\r\n", 1), F.lit(""))


def records(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write pages to an archive, read it back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    path = path or scratch_dir(spark)
    write(pages, path)
    back = restore(spark, path, {"payload_bytes": F.length("payload").cast("bigint"), "payload_digest": F.sha1("payload")})
    refers = F.regexp_extract(F.coalesce(field("WARC-Refers-To"), F.lit("")), rf"<{URN}(-?\d+)>", 1)
    return back.select("page_id", "payload_bytes", "payload_digest", field("WARC-Type").alias("record_type"), F.nullif(refers, F.lit("")).cast("bigint").alias("refers_to"))


def export_files(spark: SparkSession, path: str, out: str, compression: str = "gzip") -> None:
    """Write an archive's records as WARC files; revisits have no block. Payloads must be UTF-8 text, as html is."""
    rows = restore(spark, path)
    block = F.when(field("WARC-Type") == "response", F.col("payload").cast("string")).otherwise("")
    text = rows.select(F.concat("header", block).alias("value"))
    text.write.option("lineSep", END).option("compression", compression).option("maxRecordsPerFile", FILE_RECORDS).text(out)


def _members(data: bytes) -> Iterator[bytes]:
    """The expanded bytes of a gzip file, of one member or many, about PIECE at a time; other data as it is. Each byte of the file is taken once."""
    import zlib

    view, at = memoryview(data), 0
    if data[:2] != b"\x1f\x8b":
        yield from (view[k : k + PIECE] for k in range(0, len(view), PIECE))
        return
    while bytes(view[at : at + 2]) == b"\x1f\x8b":
        z = zlib.decompressobj(31)
        while not z.eof and at < len(view):
            piece = view[at : at + PIECE]
            out = z.decompress(piece, PIECE)
            at += len(piece) - len(z.unused_data if z.eof else z.unconsumed_tail)
            yield out
        if not z.eof and (out := z.flush()):  # what the last bytes still held
            yield out
        if not z.eof:
            raise ValueError("a gzip member that is cut off")
        while bytes(view[at : at + 1]) == b"\x00":  # padding between members
            at += 1


def _parse(parts: Iterator[bytes]) -> Iterator[tuple[bytes, bytes]]:
    """Header block and block of each record; a record without a length, or cut off, is an error that shows its header.

    Parts gather until the record that has begun is whole, whatever its size.
    """
    held, wanted, begin = bytearray(), 0, True
    for part in parts:
        held += part
        while len(held) >= wanted:
            at = 0
            if begin:  # a record ends with two line breaks
                while held[at : at + 1] in (b"\r", b"\n"):
                    at += 1
            if at:
                del held[:at]
            stop = held.find(b"\r\n\r\n")
            if stop < 0:
                begin, wanted = not held, len(held) + 1
                break
            header = bytes(held[: stop + 4])
            size = next((x[15:] for x in header.split(b"\r\n") if x[:15].lower() == b"content-length:"), b"").strip()
            if not size.isdigit():
                raise ValueError(f"a record without a length: {header[:200]!r}")
            end = stop + 4 + int(size)
            if end > len(held):
                begin, wanted = False, end
                break
            yield header, bytes(held[stop + 4 : end])
            del held[:end]
            begin, wanted = True, 0
            if not held:
                break
    if held.strip():
        raise ValueError(f"a record that is cut off: {bytes(held[:200])!r}")


#: Bytes that are expanded at a time.
PIECE = 1 << 20


def import_files(spark: SparkSession, path: str, rows: int = 256) -> DataFrame:
    """header_bytes, header (as text, for fields) and block of each record of the WARC files of a folder.

    A file is read whole but expanded PIECE bytes at a time, and its records leave in small batches.
    """

    def batch(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        heads = [h for h, _ in pairs]
        return pa.RecordBatch.from_arrays([pa.array(heads, pa.binary()), pa.array([h.decode("utf-8", "replace") for h in heads], pa.string()), pa.array([p for _, p in pairs], pa.binary())], ["header_bytes", "header", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column(0).to_pylist():
                pairs: list[tuple[bytes, bytes]] = []
                for pair in _parse(_members(data)):
                    pairs.append(pair)
                    if len(pairs) >= rows:
                        yield batch(pairs)
                        pairs = []
                if pairs:
                    yield batch(pairs)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, "header_bytes binary, header string, block binary")
