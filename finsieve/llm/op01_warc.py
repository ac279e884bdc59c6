"""WARC archives: written by Spark's text writer, read back by boundary-chain verification.

Writing: a record is a header block, its content and two line ends; the writer appends the latter
as its line separator. Payloads that repeat are written once; later ones are revisit records
with the HTTP head alone.

Reading: the text source splits files at the magic "WARC/1." wherever it stands, also inside
payloads. Within a split a running sum of bytes gives each candidate's place; totals per split lift
it to the offset in the file. A candidate whose header parses points to its successor, the place
behind its content. Only records on the chain from the file's start are real: pointer jumping marks
them in a logarithmic number of rounds. Content that holds the magic is put together again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from finsieve.llm.common import pieces
from finsieve.session import stage

MAGIC = "WARC/1."
LEAST = 1000
_END = "\r\n\r\n"


def _header(*fields: tuple[str, Column]) -> Column:
    lines = [F.lit(MAGIC + "0")] + [F.concat(F.lit(f"{name}: "), value.cast("string")) for name, value in fields]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(_END))


def _record_id(id: Column) -> Column:
    """A urn:uuid made of the page's id, so that a revisit can name its response."""
    h = F.md5(F.concat(F.lit("page:"), F.coalesce(id.cast("string"), F.lit("null"))))
    part = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *part), F.lit(">"))


def plan(pages: DataFrame, id: str, payload: str, least: int = LEAST) -> DataFrame:
    """(digest, size, keeper) of every payload of ``least`` bytes that several pages have; keeper is the largest id."""
    p = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    return (
        pages.select(F.col(id).alias("id"), F.sha1(p).alias("digest"), F.octet_length(p).alias("size"))
        .filter(F.col("size") >= least).groupBy("digest", "size")
        .agg(F.max("id").alias("keeper"), F.count("*").alias("n")).filter("n > 1").drop("n")
    )


def write(pages: DataFrame, path: str, id: str = "page_id", url: str = "url", payload: str = "html", least: int = LEAST) -> None:
    """Write one record per row of ``pages`` under ``path``.

    A null payload is empty and a null url is empty. Rows that repeat the largest id of a group of
    equal payloads are responses as well; a null id is smaller than any other.
    """
    shared = stage(plan(pages, id, payload, least), "repeated")
    rows = pages.select(
        F.col(id).alias("id"), F.coalesce(F.regexp_replace(F.col(url).cast("string"), "[\r\n]", "%0A"), F.lit("")).alias("url"),
        F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("body"),
    ).withColumn("digest", F.sha1(F.col("body").cast("binary"))).withColumn("size", F.octet_length("body"))
    # The table of repeated payloads is written, so Spark knows its size: small, it is broadcast, else joined by shuffle.
    rows = rows.join(shared, ["digest", "size"], "left")
    revisit = F.col("keeper").isNotNull() & ~F.col("id").eqNullSafe(F.col("keeper"))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(_END)
    )
    content = F.when(revisit, head).otherwise(F.concat(head, "body"))
    common = [
        ("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        ("WARC-Record-ID", _record_id(F.col("id"))),
        ("WARC-Page-ID", F.coalesce(F.col("id").cast("string"), F.lit(""))),
        ("WARC-Target-URI", F.col("url")),
        ("WARC-Date", F.lit("2026-01-01T00:00:00Z")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        ("Content-Type", F.lit("application/http; msgtype=response")),
    ]
    length = [("Content-Length", F.octet_length(content))]
    profile = [
        ("WARC-Refers-To", _record_id(F.col("keeper"))),
        ("WARC-Refers-To-Page-ID", F.col("keeper")),
        ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
    ]
    text = F.concat(F.when(revisit, _header(*common, *profile, *length)).otherwise(_header(*common, *length)), content)
    rows.select(text.alias("value")).write.option("lineSep", _END).text(path)


def parse(piece: bytes) -> tuple[dict[str, str], int, int] | None:
    """(fields, bytes of the header with the magic, content length) of a candidate, or None.

    ``piece`` follows the magic. Field names are lower case; of a repeated field the last counts.
    """
    end = piece.find(b"\r\n\r\n")
    if end < 0 or piece[:3] not in (b"0\r\n", b"1\r\n"):
        return None
    fields = {}
    for line in piece[3:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = fields.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        return None
    return fields, len(MAGIC) + end + 4, int(length)


def _split_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", MAGIC).option("recursiveFileLookup", "true").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("value"),
    )


def _placed(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[int]]]:
    """Batches with the bytes of their split before each row; a split is read in order within one task."""
    now, at = None, 0
    for batch in pieces(batches, 32 << 20):
        places = []
        for file, block, n in zip(batch.column("file"), batch.column("block"), pc.binary_length(batch.column("value")).to_pylist()):
            if (file, block) != now:
                now, at = (file, block), 0
            places.append(at)
            at += n + len(MAGIC)
        yield batch, places


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, size, at, bytes, fields, length, head, payload_bytes, payload_digest, whole) per piece between magics.

    ``whole`` if the piece holds just the record's content and its two line ends; then the payload,
    which is the content behind the HTTP head, has its size and SHA-1 here.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, places in _placed(batches):
            out: dict[str, list] = {n: [] for n in ("bytes", "fields", "length", "head", "payload_bytes", "payload_digest", "whole")}
            for v in batch.column("value"):
                piece = v.as_buffer().to_pybytes()
                found = parse(piece)
                fields, head, length = found if found else (None, None, None)
                whole = bool(found) and len(piece) + len(MAGIC) == head + length + 4
                content = piece[head - len(MAGIC):head - len(MAGIC) + length] if whole else b""
                row = (len(piece), fields, length, head, *(payload(content) if whole else (None, None)), whole)
                for name, value in zip(out, row):
                    out[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("block"), batch.column("size"), pa.array(places, pa.int64()),
                 pa.array(out["bytes"], pa.int64()),
                 pa.array([None if f is None else list(f.items()) for f in out["fields"]], pa.map_(pa.string(), pa.string())),
                 pa.array(out["length"], pa.int64()), pa.array(out["head"], pa.int64()),
                 pa.array(out["payload_bytes"], pa.int64()), pa.array(out["payload_digest"], pa.string()),
                 pa.array(out["whole"], pa.bool_())],
                names=["file", "block", "size", "at", "bytes", "fields", "length", "head", "payload_bytes", "payload_digest", "whole"],
            )

    return _split_rows(spark, path).mapInArrow(
        run, "file string, block bigint, size bigint, at bigint, bytes bigint, fields map<string,string>, length bigint, "
        "head bigint, payload_bytes bigint, payload_digest string, whole boolean"
    )


def payload(content: bytes) -> tuple[int, str]:
    """Bytes and SHA-1 of what follows the HTTP head, of all if there is none."""
    body = memoryview(content)[content.find(b"\r\n\r\n") + 4:] if content.startswith(b"HTTP/") else content
    return len(body), hashlib.sha1(body).hexdigest()


def located(found: DataFrame) -> DataFrame:
    """Add ``offset``, the place of the piece's magic in its file, and ``next``, that of its successor.

    The first piece of a file precedes any magic and has offset -7. A successor at or behind the
    end of the file is null, and so is that of a piece that is no candidate.
    """
    ends = found.groupBy("file", "block").agg(F.sum(F.col("bytes") + len(MAGIC)).alias("total"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    lifts = ends.select("file", "block", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("lift"))
    at = found.join(lifts, ["file", "block"]).withColumn("offset", F.col("lift") + F.col("at") - len(MAGIC)).drop("lift")
    target = F.col("offset") + F.col("head") + F.col("length") + 4
    return at.withColumn("next", F.when(target < F.col("size"), target))


def reachable(nodes: DataFrame) -> DataFrame:
    """(file, offset) of the candidates on the chain from each file's start, by pointer jumping.

    ``nodes`` are (file, offset, next) of all candidates. Round r knows the first 2**r records of each
    chain and jumps from each of them 2**r records on, while every pointer is doubled.
    """
    known = nodes.filter("offset = 0").select("file", "offset")
    jump = nodes.filter("next is not null").select("file", "offset", "next")
    known, count = stage(known, "chain"), -1
    while True:
        jump = stage(jump, "jump")
        onward = known.join(jump, ["file", "offset"]).select("file", F.col("next").alias("offset"))
        onward = onward.join(nodes.select("file", "offset"), ["file", "offset"], "left_semi")
        known, count, before = stage(known.unionByName(onward).distinct(), "chain"), None, count
        count = known.count()
        if count == before:
            return known
        ahead = jump.select("file", F.col("offset").alias("next"), F.col("next").alias("further"))
        jump = jump.join(ahead, ["file", "next"]).select("file", "offset", F.col("further").alias("next"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, offset, fields, payload_bytes, payload_digest) of every real record under ``path``.

    ``fields`` are the header fields by lower-case name, the payload is the content behind the HTTP
    head. Files without a byte have no records, nor has a file that does not start with a record. A
    content that the file's end cuts short counts as far as it is there.
    """
    spots = stage(located(stage(candidates(spark, path), "candidates")), "located")
    nodes = stage(spots.filter("fields is not null").select("file", "offset", "next"), "nodes")
    real = spots.join(reachable(nodes), ["file", "offset"], "left_semi")
    simple = real.filter("whole").select("file", "offset", "fields", "payload_bytes", "payload_digest")
    broken = stage(real.filter("not whole").select("file", "offset", "fields", "length", "head"), "broken")
    return simple.unionByName(_mended(spark, path, spots, broken))


def _mended(spark: SparkSession, path: str, spots: DataFrame, broken: DataFrame) -> DataFrame:
    """The records whose content holds the magic, put together from their pieces.

    A piece belongs to the last record that starts at or before it. Each piece is paired with the
    records that start in its own or an earlier stretch of the file that they cover.
    """
    width = 1 << 16
    last = F.col("offset") + F.col("head") + F.col("length") - 1
    spans = broken.withColumn("cell", F.explode(F.sequence(F.floor(F.col("offset") / width), F.floor(last / width))))
    spans = spans.select("file", "cell", F.col("offset").alias("start"), (last + 1).alias("stop"))
    owned = spots.filter("offset >= 0").withColumn("cell", F.floor(F.col("offset") / width)).join(spans, ["file", "cell"]).filter(
        "offset >= start and offset < stop"
    ).select("file", "block", "at", "offset", "start")
    wanted = stage(owned, "pieces")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, places in _placed(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("block"), pa.array(places, pa.int64()), batch.column("value")],
                names=["file", "block", "at", "value"],
            )

    again = _split_rows(spark, path).mapInArrow(run, "file string, block bigint, at bigint, value binary")
    parts = again.join(wanted, ["file", "block", "at"]).groupBy("file", F.col("start").alias("offset")).agg(
        F.sort_array(F.collect_list(F.struct("offset", "value"))).alias("parts")
    )

    def join_parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = []
            for head, length, parts in zip(*(batch.column(c) for c in ("head", "length", "parts"))):
                whole = b"".join(MAGIC.encode() + p["value"].as_py() for p in parts)
                found.append(payload(whole[head.as_py():head.as_py() + length.as_py()]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("file", "offset", "fields")), pa.array([n for n, _ in found], pa.int64()),
                 pa.array([d for _, d in found], pa.string())],
                names=["file", "offset", "fields", "payload_bytes", "payload_digest"],
            )

    return broken.join(parts, ["file", "offset"]).select("file", "offset", "fields", "length", "head", "parts").mapInArrow(
        join_parts, "file string, offset bigint, fields map<string,string>, payload_bytes bigint, payload_digest string"
    )


def payloads(found: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of records that ``write`` made.

    A revisit has its payload's size and digest from its response, which must be among the records.
    """
    f = F.col("fields")
    rows = found.select(
        F.when(f["warc-page-id"] != "", f["warc-page-id"]).cast("bigint").alias("page_id"), f["warc-type"].alias("record_type"),
        f["warc-record-id"].alias("rid"), f["warc-refers-to"].alias("ref"),
        f["warc-refers-to-page-id"].cast("bigint").alias("refers_to"), "payload_bytes", "payload_digest",
    )
    shown = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    own = rows.filter("record_type = 'response'")
    later = rows.filter("record_type = 'revisit'").drop("payload_bytes", "payload_digest")
    named = own.join(later.select(F.col("ref").alias("rid")).distinct(), "rid", "left_semi")
    first = named.groupBy("rid").agg(F.max("payload_bytes").alias("payload_bytes"), F.max("payload_digest").alias("payload_digest"))
    return own.select(*shown).unionByName(later.join(first.withColumnRenamed("rid", "ref"), "ref").select(*shown))
