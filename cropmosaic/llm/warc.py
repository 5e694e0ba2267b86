"""WARC archives with a two-level capture index."""

import base64
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cropmosaic.llm.common import BROADCAST_BYTES, bucket_count, shared_folder, stored, with_size_hint

#: Aimed-at bytes of an archive file, and captures in a compressed block of the index.
ARCHIVE_BYTES, BLOCK_CAPTURES = 16 << 20, 512
#: Archives that a range read names to the reader one by one.
NAMED_ARCHIVES = 1000
CRLF = "\r\n"
#: The digits of base32.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
INDEX_COLUMNS = "first_key string, last_key string, part int, block int, captures int, data binary"
CAPTURE = "key string, file string, offset long, length long"
RECORD = (
    "key string, page_id string, record_type string, refers_to string, url string, payload_bytes long, payload_digest string, payload binary"
)


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1: 40 hex digits are 8 groups of 4 base32 digits."""
    hexed = F.sha1(data)
    digits = []
    for group in range(8):
        bits = F.conv(F.substring(hexed, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            digits.append(F.substring(F.lit(BASE32), F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1)))
    return F.concat(*digits)


def surt(url: Column) -> Column:
    """Sort key: the host's labels reversed and joined by commas, `)`, and the rest; NULL and keyless urls give their own text."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    host = F.lower(F.regexp_extract(text, r"^[^:/?#]+://([^/?#]*)", 1))
    rest = F.regexp_replace(text, r"^[^:/?#]+://[^/?#]*", "")
    return F.when(host == "", text).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest))


def records(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0) -> DataFrame:
    """One column `value`: the WARC record of each page as text, without the two line ends that close it.

    Of pages with equal payloads of at least least_bytes the one with the smallest id holds the
    payload (response), the others refer to it (revisit). A NULL payload is empty; rows that
    repeat the smallest id are all responses; rows without an id are revisits if another has one.
    Line ends and blanks in urls are percent-encoded.
    """
    page = pages.select(
        F.col(key).alias("id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("body")
    ).withColumn("digest", base32_sha1(F.col("body").cast("binary")))
    page = page.withColumn("size", F.octet_length("body").cast("long"))
    first = page.filter(F.col("size") >= least_bytes).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    first = stored(first.filter("n > 1").drop("n"))
    page = page.join(with_size_hint(first, first.count(), 64), "digest", "left")
    response = F.col("first").isNull() | F.col("id").eqNullSafe(F.col("first"))
    target = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("size").cast("string"), F.lit(CRLF * 2)
    )
    block = F.when(response, F.concat(http, "body")).otherwise(http)
    uri = lambda id_: F.concat(F.lit("<urn:page:"), F.coalesce(id_.cast("string"), F.lit("")), F.lit(">"))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(response, "response").otherwise("revisit")),
        line("WARC-Record-ID", uri(F.col("id"))),
        F.lit(f"WARC-Date: 1970-01-01T00:00:00Z{CRLF}"),
        F.coalesce(line("WARC-Target-URI", target), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(response, F.lit("")).otherwise(
            F.concat(
                line("WARC-Refers-To", uri(F.col("first"))),
                F.lit(f"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{CRLF}"),
            )
        ),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}"),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(CRLF),
    )
    return page.select(F.concat(head, block).alias("value"))


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0) -> None:
    """WARC files below `folder`, one record per page, written by Spark's text writer with two line ends after each record.

    Files hold as many records as make about ARCHIVE_BYTES on average; a single longer record is
    never split.
    """
    found = pages.agg(F.count(F.lit(1)), F.coalesce(F.avg(F.octet_length(F.col(payload).cast("string"))), F.lit(0))).first()
    per_file = max(1, int(ARCHIVE_BYTES / (found[1] + 600)))
    writer = records(pages, key, url, payload, least_bytes).write.option("lineSep", CRLF * 2).option("maxRecordsPerFile", per_file)
    writer.mode("overwrite").text(folder)


def _headers(block: bytes) -> dict[bytes, bytes]:
    return {k.lower(): v.strip() for k, _, v in (line.partition(b":") for line in block.split(b"\r\n")[1:])}


def parse_record(record: bytes) -> tuple:
    """A record, header block to payload, as the columns of RECORD without the key."""
    head, _, block = record.partition(b"\r\n\r\n")
    fields = _headers(head)
    http, _, payload = block.partition(b"\r\n\r\n")
    name = lambda v: v[len(b"<urn:page:") : -1].decode() if v else None
    kind = fields[b"warc-type"].decode()
    if kind == "response":
        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
    else:  # the payload is with the record referred to
        size, digest = int(_headers(http)[b"content-length"]), fields[b"warc-payload-digest"].decode().removeprefix("sha1:")
        payload = None
    url = fields.get(b"warc-target-uri")
    return name(fields[b"warc-record-id"]), kind, name(fields.get(b"warc-refers-to")), url and url.decode(), size, digest, payload


def _archives(spark: SparkSession, folder: str | list[str]) -> DataFrame:
    """file, content of the archives below a folder, or of the listed ones."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select(F.col("path").alias("file"), "content")


def captures(spark: SparkSession, folder: str) -> DataFrame:
    """url, file, offset, length of every record, found by walking each archive from record to record."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, data in zip(batch["file"], batch["content"]):
                rows, at = [], 0
                while at < len(data):
                    end = data.index(b"\r\n\r\n", at) + 4
                    fields = _headers(data[at:end])
                    length = end - at + int(fields[b"content-length"])
                    url = fields.get(b"warc-target-uri", b"").decode()
                    rows.append((url, file, at, length))
                    at += length + 4
                yield pd.DataFrame(rows, columns=["url", "file", "offset", "length"])

    return _archives(spark, folder).mapInPandas(walk, "url string, file string, offset long, length long")


def build_index(spark: SparkSession, folder: str) -> DataFrame:
    """The index, stored: captures sorted by key, in compressed blocks of BLOCK_CAPTURES lines.

    Sorting is a range shuffle by key and place, so a key with very many captures is spread too.
    The columns without `data` are the sparse directory: a row for each block.
    """
    found = captures(spark, folder).withColumn("key", F.regexp_replace(surt(F.col("url")), r"[\t\n]", "%09"))
    found = stored(found.select("key", "file", "offset", "length"))
    parts = bucket_count(found.count(), 64 * BLOCK_CAPTURES)
    order = ["key", "file", "offset"]
    found = found.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, block = None, 0
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            while len(held) >= BLOCK_CAPTURES:
                yield one(held.iloc[:BLOCK_CAPTURES], block)
                held, block = held.iloc[BLOCK_CAPTURES:], block + 1
        if held is not None and len(held):
            yield one(held, block)

    def one(rows: pd.DataFrame, block: int) -> pd.DataFrame:
        lines = "\n".join(f"{k}\t{f}\t{o}\t{n}" for k, f, o, n in zip(rows["key"], rows["file"], rows["offset"], rows["length"]))
        row = (rows["key"].iloc[0], rows["key"].iloc[-1], int(rows["part"].iloc[0]), block, len(rows), zlib.compress(lines.encode()))
        return pd.DataFrame([row], columns=["first_key", "last_key", "part", "block", "captures", "data"])

    return stored(found.mapInPandas(pack, INDEX_COLUMNS))


def _sorted_directory(rows: pd.DataFrame) -> tuple[np.ndarray, ...]:
    encoded = [np.array([k.encode() for k in rows[c]], object) for c in ("first_key", "last_key")]
    return *encoded, rows["part"].to_numpy(), rows["block"].to_numpy()


def _bisect(keys: pd.Series, directory: tuple[np.ndarray, ...]) -> pd.DataFrame:
    """key, part, block for every block whose range of keys may hold the key."""
    first, last, part, block = directory
    key = np.array([k.encode() for k in keys], object)
    lo = np.searchsorted(last, key, side="left")  # the first block that ends at or after the key
    hi = np.searchsorted(first, key, side="right")  # the first one that begins after it
    n = np.maximum(hi - lo, 0)
    at = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return pd.DataFrame({"key": np.repeat(keys.to_numpy(), n), "part": part[at], "block": block[at]})


def _bisected(keys: DataFrame, rows: pd.DataFrame) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(_sorted_directory(rows))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield _bisect(batch["key"], shared.value)

    return keys.mapInPandas(run, "key string, part int, block int")


def find_captures(index: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, file, offset, length) of all captures of the distinct keys asked for (column `key`).

    The directory, sorted, is searched by bisection for the run of blocks that may hold a key;
    only those blocks are opened, and searched by bisection again. The directory has one row in
    BLOCK_CAPTURES and is broadcast while it is within the bound. A larger one is searched in two
    steps: for the sorted parts that may hold the key (one row per part, of which there are as
    many as tasks made the index), then, part by part, for the blocks.
    """
    keys = keys.select(F.col("key")).distinct()
    directory = index.select("first_key", "last_key", "part", "block")
    size = directory.agg(F.coalesce(F.sum(F.octet_length("first_key") + F.octet_length("last_key") + 16), F.lit(0))).first()[0]
    if size <= BROADCAST_BYTES:
        places = _bisected(keys, directory.orderBy("first_key", "part", "block").toPandas())
    else:
        parts = directory.groupBy("part").agg(F.min("first_key").alias("first_key"), F.max("last_key").alias("last_key"))
        parts = parts.withColumn("block", F.lit(0)).orderBy("first_key", "part").toPandas()
        near = _bisected(keys, parts)

        def within(asked: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
            return _bisect(asked["key"], _sorted_directory(blocks.sort_values(["block"])))

        both = near.groupBy("part").cogroup(directory.groupBy("part"))
        places = both.applyInPandas(within, "key string, part int, block int")
    # a block may hold more keys than one, each key asked for is searched in it
    asked = places.groupBy("part", "block").agg(F.sort_array(F.collect_list("key")).alias("asked"))
    opened = asked.join(index.select("part", "block", "data"), ["part", "block"]).select("asked", "data")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for asked, data in zip(batch["asked"], batch["data"]):
                lines = zlib.decompress(data).decode().split("\n")
                names = np.array([line.partition("\t")[0].encode() for line in lines], object)
                rows = []
                for key in asked:
                    k = key.encode()
                    for i in range(np.searchsorted(names, k, side="left"), np.searchsorted(names, k, side="right")):
                        _, file, offset, length = lines[i].split("\t")
                        rows.append((key, file, int(offset), int(length)))
                yield pd.DataFrame(rows, columns=["key", "file", "offset", "length"])

    return opened.mapInPandas(search, CAPTURE)


def read_captures(spark: SparkSession, folder: str, found: DataFrame) -> DataFrame:
    """The records (RECORD) at the places found; each archive is opened once at most, and only the ranges are parsed.

    Spark's binary reader hands over an archive (a bounded file) as one value; the ranges are
    cut from it in the task that reads it. Up to NAMED_ARCHIVES archives are named to the reader,
    which opens no other; for more than that, or for all, it reads the folder and the join drops
    what nobody asked for.
    """
    found = stored(found)
    ranges = found.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("offset", "length", "key"))).alias("ranges"))
    size = found.agg(F.coalesce(F.sum(F.octet_length("key") + 24), F.lit(0))).first()[0]
    ranges = with_size_hint(stored(ranges), size, 1)
    archives = _archives(spark, folder)
    named = found.select("file").distinct()
    if named.count() <= min(NAMED_ARCHIVES, archives.select("file").count() - 1):
        paths = [r["file"] for r in named.collect()]  # at most NAMED_ARCHIVES
        archives = _archives(spark, paths) if paths else archives.limit(0)
    both = archives.join(ranges, "file").select("content", "ranges")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in RECORD.split(", ")]
        for batch in batches:
            for data, ranges in zip(batch["content"], batch["ranges"]):
                rows = []
                for r in ranges:
                    rows.append((r["key"], *parse_record(data[r["offset"] : r["offset"] + r["length"]])))
                    if len(rows) == 1000:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
                yield pd.DataFrame(rows, columns=names)

    return both.mapInPandas(cut, RECORD)


def archive_and_read(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0) -> DataFrame:
    """Every page's record (RECORD) after writing all to archives and looking all urls up in the capture index."""
    spark = pages.sparkSession
    folder = shared_folder(spark)
    write_archives(pages, folder, key, url, payload, least_bytes)
    index = build_index(spark, folder)
    encoded = F.regexp_replace(F.col(url).cast("string"), r"[\x00-\x20\x7F]", "%20")
    keys = pages.select(F.regexp_replace(surt(encoded), r"[\t\n]", "%09").alias("key"))
    return read_captures(spark, folder, find_captures(index, keys))
