"""WARC archives written by Spark, and read back by verifying the chain of record boundaries.

A file is read in splits, cut at every ``WARC/1.0`` line, also at such that stand
inside payloads. Each cut is a candidate record: its header tells where the
record that follows has to begin. Candidates whose successor is just the next
cut form runs; pointer jumping over runs, from the start of each file, finds the
runs that are reached and where they are entered. Candidates outside are no
records. A record that was cut inside its payload is put together again from the
pieces up to its successor.

Files hold ``RECORDS_PER_FILE`` records at most; of a file's cuts, only offsets
come together in one task. A record has to fit into memory.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from numberplace.session import stored

RECORDS_PER_FILE = 100_000
#: Crawl time where the pages have none.
DATE = "1970-01-01T00:00:00Z"

_MAGIC = b"WARC/1.0\r\n"
_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_RECORD = "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string, intact boolean"
_FIELDS = [x.split()[0] for x in _RECORD.split(", ")]


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _digests(pages: DataFrame, id_column: str, payload: str) -> DataFrame:
    """The columns of ``pages`` with ``payload_bytes`` and ``payload_digest``; a null payload is empty."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads = [(x or "").encode() for x in batch.column(payload).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(map(len, payloads), pa.int64()), pa.array(map(digest, payloads), pa.string())],
                [*batch.schema.names, "payload_bytes", "payload_digest"])

    schema = ", ".join(f"`{name}` {kind}" for name, kind in pages.dtypes)
    return pages.mapInArrow(add, f"{schema}, payload_bytes long, payload_digest string")


def write_archives(
    pages: DataFrame, path: str, id_column: str = "page_id", url: str = "url", payload: str = "html",
    least_bytes: int = 0, date: str = DATE,
) -> None:
    """One record per row in ``path``, a folder of archives.

    Of the rows with equal payloads of at least ``least_bytes`` bytes, those with
    the largest id are responses, the others revisit it (rows without an id
    revisit one with an id). A null payload is an empty one, a null URL is left out.
    """
    base = pages.select(F.col(id_column).alias("id"), F.col(url).alias("url"), F.col(payload).alias("payload"))
    marked = _digests(base, "id", "payload")
    equal = marked.filter(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest", "payload_bytes").agg(
        F.max("id").alias("last"), F.count("*").alias("n"))
    copied = stored(equal.filter("n > 1 AND last IS NOT NULL").drop("n", "payload_bytes"))
    joined = marked.join(copied, "payload_digest", "left")
    revisit = F.col("last").isNotNull() & ~F.col("id").eqNullSafe(F.col("last"))
    body = F.when(revisit, "").otherwise(F.coalesce("payload", F.lit("")))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    clean_url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    lines = F.concat_ws(
        "\r\n",
        F.concat(F.lit("WARC/1.0\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), _urn("id")),
        F.concat(F.lit("WARC-Target-URI: "), clean_url),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.concat(F.lit("WARC-Payload-Length: "), F.col("payload_bytes").cast("string")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _urn("last"), F.lit(f"\r\nWARC-Profile: {_PROFILE}"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), (F.octet_length(http) + F.octet_length(body)).cast("string")),
    )
    record = F.concat(lines, F.lit("\r\n\r\n"), http, body)
    joined.select(record.alias("value")).write.option("lineSep", "\r\n\r\n").option(
        "maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def _urn(column: str) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(">"))


def parse(cut: bytes) -> tuple[int, int, dict[str, str]] | None:
    """Where the block begins in the bytes behind a magic line, its length, and the header; None without a proper header."""
    end = cut.find(b"\r\n\r\n")
    if end < 0:
        return None
    header = {}
    for line in cut[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        header[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = header.get("content-length", "")
    return (end + 4, int(length), header) if re.fullmatch(r"[0-9]{1,18}", length) else None


def _page(urn: str | None) -> str | None:
    return (urn or "").removeprefix("<urn:page:").removesuffix(">") or None


def _record(header: dict[str, str], block: bytes) -> tuple:
    """The fields of a record; a response's payload is what follows the HTTP header."""
    kind, claimed = header.get("warc-type"), header.get("warc-payload-digest", "").removeprefix("sha1:")
    number = header.get("warc-payload-length", "")
    if kind == "revisit":
        return (_page(header.get("warc-record-id")), int(number) if number.isdigit() else None, claimed, kind,
                _page(header.get("warc-refers-to")), True)
    payload = block.partition(b"\r\n\r\n")[2]
    own = digest(payload)
    return _page(header.get("warc-record-id")), len(payload), own, kind, None, own == claimed


def _cuts(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, position, value): the bytes between magic lines, in the order of each split."""
    raw = spark.read.option("lineSep", _MAGIC.decode()).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"), F.col("value").cast("binary").alias("value"))
    return raw


def _scan(cuts: DataFrame) -> DataFrame:
    """Per cut its size, how far on the next record has to begin, and the record's fields if it holds all of it."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for cut in batch.column("value").to_pylist():
                found = parse(cut)
                if found is None:
                    rows.append((len(cut), None, *[None] * len(_FIELDS)))
                    continue
                begin, length, header = found
                whole = begin + length <= len(cut)
                fields = _record(header, cut[begin : begin + length]) if whole else [None] * len(_FIELDS)
                rows.append((len(cut), begin + length + 4, *fields))
            columns = zip(*rows, strict=True) if rows else [[]] * (2 + len(_FIELDS))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("block"), batch.column("position"),
                 *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                ["file", "block", "position", "size", "reach", *_FIELDS])

    return cuts.mapInArrow(scan, f"file string, block long, position long, size long, reach long, {_RECORD}")


def _reached(cuts: DataFrame) -> DataFrame:
    """(file, run, entry) of the runs on the chain of each file, by pointer jumping."""
    runs = stored(cuts.filter("reach IS NOT NULL").groupBy("file", "run").agg(
        F.min("offset").alias("first"), F.max(F.struct("offset", "successor")).getField("successor").alias("leaves_for")))
    starts = cuts.select("file", F.col("offset").alias("leaves_for"), F.col("run").alias("next")).filter("next IS NOT NULL")
    steps = stored(runs.join(starts, ["file", "leaves_for"]).select("file", "run", "next", F.col("leaves_for").alias("entry")))
    reached = stored(runs.filter("first = 0").select("file", "run"))
    jumps, n = steps.select("file", "run", "next"), reached.count()
    while True:
        onward = reached.join(jumps, ["file", "run"]).select("file", F.col("next").alias("run"))
        reached = stored(reached.unionByName(onward).distinct())
        before, n = n, reached.count()
        if n == before:
            break
        second = jumps.select("file", F.col("run").alias("next"), F.col("next").alias("after"))
        jumps = stored(jumps.join(second, ["file", "next"]).select("file", "run", F.col("after").alias("next")))
    entries = reached.join(steps, ["file", "run"]).select("file", F.col("next").alias("run"), "entry")
    return stored(entries.unionByName(runs.filter("first = 0").select("file", "run", F.col("first").alias("entry"))))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(file, offset, page_id, payload_bytes, payload_digest, record_type, refers_to, intact) of all records.

    Ids are texts. Size and digest are taken from the payload of a response and
    from the header of a revisit; ``intact`` is false where a payload does not
    have the digest that its header claims. Bytes that the chain of boundaries
    does not reach are passed over.
    """
    scanned = stored(_scan(_cuts(spark, path)))
    of_file = Window.partitionBy("file").orderBy("block", "position")
    behind = F.sum(F.col("size") + len(_MAGIC)).over(of_file) - F.col("size")  # where a cut's own bytes begin, past the magic
    placed = scanned.withColumn("offset", behind - 2 * len(_MAGIC)).withColumn(
        "successor", F.col("offset") + len(_MAGIC) + F.col("reach"))
    linked = F.lag("successor").over(of_file).eqNullSafe(F.col("offset"))
    placed = placed.withColumn("opens", F.when(linked, 0).otherwise(1))
    cuts = stored(placed.withColumn("run", F.when(F.col("reach").isNotNull(), F.sum("opens").over(of_file))))
    chain = cuts.join(_reached(cuts), ["file", "run"]).filter("offset >= entry")
    kept = stored(chain.select("file", "offset", "successor", *_FIELDS))
    whole = kept.filter("record_type IS NOT NULL")
    torn = stored(kept.filter("record_type IS NULL").select("file", "offset", "successor"))
    out = whole.select("file", "offset", *_FIELDS)
    if not torn.isEmpty():
        out = out.unionByName(_mended(spark, path, cuts, torn))
    return out


def _mended(spark: SparkSession, path: str, cuts: DataFrame, torn: DataFrame) -> DataFrame:
    """Records that hold magic lines in their payload, joined from their pieces."""
    of_file = Window.partitionBy("file").orderBy("block", "position")
    owner = F.last("own", ignorenulls=True).over(of_file)
    heads = torn.withColumn("own", F.struct("offset", "successor")).select("file", "offset", "own")
    owned = cuts.select("file", "block", "position", "offset", "size").join(heads, ["file", "offset"], "left").withColumn("owner", owner)
    pieces = stored(owned.filter("offset < owner.successor").select(
        "file", "block", "position", "offset", F.col("owner.offset").alias("record")))
    # The same scan numbers the cuts as before.
    again = _cuts(spark, path).join(pieces, ["file", "block", "position"])
    joined = again.groupBy("file", F.col("record").alias("offset")).agg(
        F.sort_array(F.collect_list(F.struct("offset", "value"))).alias("pieces"))
    cut = F.array_join(F.transform("pieces", lambda x: F.hex(x.value)), _MAGIC.hex().upper())

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("cut").to_pylist():
                record = bytes.fromhex(text)
                begin, length, header = parse(record) or (0, 0, None)
                if header is None or begin + length > len(record):
                    raise ValueError("the pieces of a record do not add up to its length")
                rows.append(_record(header, record[begin : begin + length]))
            kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("offset"),
                 *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))],
                ["file", "offset", *_FIELDS])

    mended = joined.select("file", "offset", cut.alias("cut")).mapInArrow(mend, f"file string, offset long, {_RECORD}")
    # Scans that are split in another way than before, as after a change of cores, must not lose a record.
    found = torn.select("file", "offset").join(mended.withColumn("found", F.lit(True)), ["file", "offset"], "left")
    lost = F.raise_error(F.lit("files were split anew while they were read; read the archives again"))
    return found.select("file", "offset", *_FIELDS[:-1], F.when(F.col("found").isNull(), lost.cast("boolean")).otherwise(
        F.col("intact")).alias("intact"))
