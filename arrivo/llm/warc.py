"""Operator 3, WARC archives as seekable Zstandard bundles.

Records are grouped into independent Zstandard frames of about
``FRAME_BYTES``; a bundle is a run of frames that ends in a seek table in a
skippable frame (the public seekable format: compressed and uncompressed
size of each frame), so a reader can fetch one frame alone. An index maps
every record to its frame and its offset inside the decompressed frame.

Bundles are kept as table rows, one row for each frame and one for each seek
table, so neither writer nor reader ever holds more than one frame, and the
files go through Spark's own committers into the shared folder. The rows of
a bundle joined in order of ``frame`` are a standard ``.warc.zst`` file;
``write_files`` writes such files and ``read_files`` fetches single records
from them. Every reader finds frames by the seek tables: a frame that its
seek table doesn't list with these sizes, a listed frame that isn't there and
a bundle without a seek table raise.

Records of http and https urls hold an HTTP response (its head, and for
responses the payload); those of other urls hold the payload alone.

Of records with equal payloads of at least ``min_bytes`` the one with the
smallest page_id is a response, the others are revisits that refer to it;
smaller payloads are all responses. Rows that repeat that page_id and
payload are responses as well. Null payloads count as empty, null urls as an
empty target; null page_ids are larger than all others and a group of them
alone is all response. An empty table gives no bundles and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivo.llm.common import batches_of, small_batches, table
from arrivo.session import cut_lineage

FRAME_BYTES, BUNDLE_FRAMES, LEVEL = 1 << 20, 256, 3
MIN_BYTES = 0  # fixed by the data contract
DATE = "1970-01-01T00:00:00Z"
#: Seekable format: skippable frame magic 0x184D2A5E, seek table magic
#: 0x8F92EAB1 (fixed values of the public format).
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
HTTP, PLAIN = "application/http; msgtype=response", "text/html; charset=utf-8"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"

#: ``footer`` repeats the seek table in a column of its own, so that reading
#: the seek tables reads no frame.
FRAMES = ("bundle string, frame int, data binary, footer binary, "
          "records array<struct<page_id:bigint,offset:bigint,length:bigint>>")
#: Place of each frame in its file, from the seek tables.
PLACES = "bundle string, frame int, at long, packed long, full long"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page-{page_id}')}"


def record_bytes(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record. A revisit keeps the digest and length of its
    payload in its header but not the payload."""
    revisit = refers_to is not None
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    kind, body = PLAIN, b"" if revisit else payload
    if target.lower().startswith(("http://", "https://")):
        kind, body = HTTP, HTTP_HEAD % len(payload) + body
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <{record_id(page_id)}>", f"WARC-Target-URI: {target}", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Payload-Length: {len(payload)}",
            f"WARC-Page-ID: {'' if page_id is None else page_id}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <{record_id(refers_to)}>", f"WARC-Refers-To-Page: {refers_to}"]
    head += [f"Content-Type: {kind}", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(data: memoryview) -> dict:
    """Header fields, and under ``payload`` the body without an HTTP head."""
    raw = bytes(data)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    size = int(fields["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("record length does not match its header")
    body = rest[:size]
    if fields["Content-Type"].startswith("application/http"):
        http, end, body = body.partition(b"\r\n\r\n")
        if not end or not http.startswith(b"HTTP/"):
            raise ValueError("no HTTP head in an HTTP record")
    return fields | {"payload": body}


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    entries = b"".join(struct.pack("<II", c, d) for c, d in sizes)
    body = entries + struct.pack("<IBI", len(sizes), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(data: bytes) -> list[tuple[int, int]]:
    """(compressed, uncompressed) frame sizes from the end of a bundle."""
    size = footer_bytes(data[-9:])
    if size > len(data) or struct.unpack_from("<II", data, len(data) - size) != (SKIPPABLE, size - 8):
        raise ValueError("no seek table")
    return list(struct.iter_unpack("<II", data[len(data) - size + 8:-9]))


def footer_bytes(tail: bytes) -> int:
    """Size of the seek table whose last nine bytes are given."""
    count, flags, magic = struct.unpack("<IBI", tail) if len(tail) == 9 else (0, 0, None)
    if magic != SEEKABLE or flags:
        raise ValueError("no seek table")
    return 8 + 8 * count + 9


def frame_of(data: bytes, packed: int, full: int) -> memoryview:
    """The decompressed frame, of the sizes that the seek table states."""
    if len(data) != packed:
        raise ValueError("frame size differs from the seek table")
    frame = zstandard.ZstdDecompressor().decompress(data)
    if len(frame) != full:
        raise ValueError("decompressed size differs from the seek table")
    return memoryview(frame)


def _bundled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    packer = zstandard.ZstdCompressor(level=LEVEL)
    bundle, sizes, waiting, index, at = None, [], [], [], 0

    def name() -> str:
        # unique to the rows it holds, equal when a lost task runs again
        key = f"{index[0][0]}-{index[-1][0]}-{len(index)}-{hashlib.sha1(b''.join(waiting)).hexdigest()}"
        return f"pages-{uuid.uuid5(uuid.NAMESPACE_OID, key)}.warc.zst"

    def flush() -> pd.DataFrame:
        nonlocal bundle, waiting, index, at
        bundle = bundle or name()
        data = packer.compress(b"".join(waiting))
        row = {"bundle": bundle, "frame": len(sizes), "data": data, "footer": None,
               "records": [{"page_id": p, "offset": o, "length": n} for p, o, n in index]}
        sizes.append((len(data), at))
        waiting, index, at = [], [], 0
        return pd.DataFrame([row])

    def close() -> pd.DataFrame:
        nonlocal bundle, sizes
        footer = seek_table(sizes)
        row = {"bundle": bundle, "frame": len(sizes), "data": footer, "footer": footer, "records": []}
        bundle, sizes = None, []
        return pd.DataFrame([row])

    for pdf in batches:
        for page_id, url, html, digest, refers_to in zip(
                pdf["page_id"], pdf["url"], pdf["html"], pdf["digest"], pdf["refers_to"]):
            page_id, refers_to = (None if x is None else int(x) for x in (page_id, refers_to))
            data = record_bytes(page_id, url, (html or "").encode(), digest, refers_to)
            if waiting and at + len(data) > FRAME_BYTES:
                yield flush()
                if len(sizes) == BUNDLE_FRAMES:
                    yield close()
            index.append((page_id, at, len(data)))
            waiting.append(data)
            at += len(data)
    if waiting:
        yield flush()
    if sizes:
        yield close()


def _base32(hexes: Column) -> Column:
    @F.pandas_udf("string")
    def run(batch: pd.Series) -> pd.Series:
        return batch.map(lambda h: base64.b32encode(bytes.fromhex(h)).decode())

    return run(hexes)


def with_revisits(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Rows (page_id, url, html, digest, refers_to). Only digests and ids are
    shuffled to find the first of each payload; the first of a payload that
    is repeated is joined back."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"),
                        F.sha1(html.cast("binary")).alias("sha"))
    first = rows.filter(F.octet_length("html") >= min_bytes).groupBy("sha").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select(
        F.col("sha").alias("of"), "first")
    # sides meet on the digest; Spark splits a digest that many pages share
    joined = rows.join(first, F.col("sha") == F.col("of"), "left")
    repeat = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    # ids as text: pandas would turn a column of longs with nulls into floats
    return joined.select(F.col("page_id").cast("string").alias("page_id"), "url", "html",
                         _base32(F.col("sha")).alias("digest"),
                         F.when(repeat, F.col("first")).cast("string").alias("refers_to"))


def write_bundles(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Writes the archives of ``pages`` (page_id, url, html) as a table of
    frames and seek tables in the shared folder and returns it."""
    with batches_of(pages.sparkSession):
        return cut_lineage(with_revisits(pages, min_bytes).mapInPandas(_bundled, FRAMES), "warc")


def _places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for bundle, footer, held in zip(pdf["bundle"], pdf["footer"], pdf["held"]):
            sizes, at = read_seek_table(footer or b""), 0
            if held != len(sizes):
                raise ValueError(f"{bundle} holds {held} frames, its seek table lists {len(sizes)}")
            for frame, (packed, full) in enumerate(sizes):
                rows.append((bundle, frame, at, packed, full))
                at += packed
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in PLACES.split(", ")])


def frame_places(bundles: DataFrame) -> DataFrame:
    """``PLACES`` of all frames, written, so that Spark knows its size. Only
    names and seek tables are read; the frames of each bundle are counted."""
    footers = bundles.filter("footer IS NOT NULL").select("bundle", "footer")
    held = bundles.groupBy("bundle").agg(F.count(F.when(F.col("footer").isNull(), 1)).alias("held"))
    with batches_of(bundles.sparkSession):
        return cut_lineage(held.join(footers, "bundle", "left").mapInPandas(_places, PLACES), "warc-places")


def _unbundled(with_payload: bool):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for bundle, data, packed, full, records in zip(*(pdf[c] for c in (
                    "bundle", "data", "packed", "full", "records"))):
                if pd.isna(packed):
                    raise ValueError(f"{bundle} holds a frame that its seek table doesn't list")
                yield _record_rows(frame_of(data, int(packed), int(full)), records, with_payload)

    return read


def _record_rows(frame: memoryview, places, with_payload: bool = True) -> pd.DataFrame:
    """``RECORDS`` at the given places of a frame."""
    rows = []
    for r in places:
        f = parse_record(frame[r["offset"]:r["offset"] + r["length"]])
        digest = f["WARC-Payload-Digest"].removeprefix("sha1:")
        page = int(f["WARC-Page-ID"]) if f["WARC-Page-ID"] else None
        full = f["WARC-Type"] == "response"
        if full and payload_digest(f["payload"]) != digest:
            raise ValueError(f"payload of page {page} does not match its digest")
        rows.append((page, f["WARC-Target-URI"], f["WARC-Type"], int(f["WARC-Refers-To-Page"]) if not full else None,
                     len(f["payload"]) if full else int(f["WARC-Payload-Length"]), digest,
                     f["payload"] if full and with_payload else None))
    names = [c.split()[0] for c in RECORDS.split(", ")]
    # whole numbers even where some are null
    return pd.DataFrame({n: pd.array(v, dtype="Int64") if n in ("page_id", "refers_to") else list(v)
                         for n, v in zip(names, zip(*rows))})


def _frames(bundles: DataFrame) -> DataFrame:
    """Frames with the sizes that the seek tables state. Spark broadcasts the
    written places while they are small and shuffles frames beyond that."""
    frames = bundles.filter("footer IS NULL").select("bundle", "frame", "data", "records")
    return frames.join(frame_places(bundles).drop("at"), ["bundle", "frame"], "left")


def read_bundles(bundles: DataFrame, with_payload: bool = True) -> DataFrame:
    """All records of the archives; frames are checked against the seek
    tables and payloads against their digests. Revisits have a null payload."""
    frames = _frames(bundles)
    small_batches(bundles.sparkSession, 8)
    return frames.mapInPandas(_unbundled(with_payload), RECORDS)


def record_index(bundles: DataFrame) -> DataFrame:
    """(page_id, bundle, frame, offset, length) of every record."""
    return bundles.select("bundle", "frame", F.explode("records").alias("r")).select(
        "r.page_id", "bundle", "frame", "r.offset", "r.length")


def read_records(bundles: DataFrame, page_ids: DataFrame) -> DataFrame:
    """Records of the given page_ids alone: the index names their frames, and
    each of these is decompressed once."""
    wanted = record_index(bundles).join(page_ids.select("page_id"), "page_id", "left_semi")
    held = wanted.groupBy("bundle", "frame").agg(F.collect_list(F.struct("offset", "length")).alias("records"))
    found = _frames(bundles).drop("records").join(held, ["bundle", "frame"])
    small_batches(bundles.sparkSession, 8)
    return found.mapInPandas(_unbundled(True), RECORDS)


def write_files(bundles: DataFrame, folder: str) -> DataFrame:
    """Writes each bundle as a ``.warc.zst`` file of the given folder and
    returns (bundle, bytes). ``folder`` is a path or URI that all executors
    reach. A task streams frame by frame into a file of its own and moves it
    into place, so a task that runs again leaves whole files."""
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        name, part, sink = None, None, None
        for pdf in batches:
            for bundle, data, footer in zip(pdf["bundle"], pdf["data"], pdf["footer"]):
                if bundle != name:
                    if sink is not None:
                        raise ValueError(f"{name} has no seek table")
                    name, part = bundle, f"{root}/.{bundle}-{uuid.uuid4().hex}"
                    sink = store.open_output_stream(part)
                sink.write(data)
                if footer is not None:
                    size = sink.tell()
                    sink.close()
                    sink = None
                    store.move(part, f"{root}/{bundle}")
                    yield pd.DataFrame({"bundle": [bundle], "bytes": [size]})
        if sink is not None:
            raise ValueError(f"{name} has no seek table")

    with batches_of(bundles.sparkSession, 8):
        return cut_lineage(bundles.select("bundle", "frame", "data", "footer").repartition("bundle")
                           .sortWithinPartitions("bundle", "frame").mapInPandas(write, "bundle string, bytes long"),
                           "warc-files")


def read_files(index: DataFrame, folder: str, page_ids: DataFrame) -> DataFrame:
    """Records of the given page_ids from files of ``write_files``: a task
    reads a file's seek table from its end, adds up the sizes before the wanted
    frame and reads that range alone."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = fs.FileSystem.from_uri(folder)
        name, sizes = None, []
        for pdf in batches:
            for bundle, frame, records in zip(pdf["bundle"], pdf["frame"], pdf["records"]):
                with store.open_input_file(f"{root}/{bundle}") as file:
                    end = file.size()
                    if bundle != name:
                        file.seek(max(end - 9, 0))
                        footer = footer_bytes(file.read(9))
                        file.seek(max(end - footer, 0))
                        name, sizes = bundle, read_seek_table(file.read(footer))
                        if sum(packed for packed, _ in sizes) + footer != end:
                            raise ValueError(f"{bundle} differs from its seek table")
                    file.seek(sum(packed for packed, _ in sizes[:frame]))
                    yield _record_rows(frame_of(file.read(sizes[frame][0]), *sizes[frame]), records)

    wanted = index.join(page_ids.select("page_id"), "page_id", "left_semi").groupBy("bundle", "frame").agg(
        F.collect_list(F.struct("offset", "length")).alias("records"))
    return wanted.repartition("bundle").sortWithinPartitions("bundle", "frame").mapInPandas(read, RECORDS)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    bundles = write_bundles(table(spark, sf_dir, "pages"))
    return read_bundles(bundles, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# base32 takes 5 bits a letter; 5 hex digits are 20 bits, four letters
OP3_SQL = r"""
WITH p AS (SELECT page_id::BIGINT AS page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT html, min(page_id) AS first, sha1(html) AS sha, strlen(html)::BIGINT AS size FROM p GROUP BY html),
d AS (SELECT html, first, size, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             ((('0x' || substr(sha, i // 4 * 5 + 1, 5))::INTEGER >> (15 - 5 * (i % 4))::INTEGER) & 31) + 1, 1)
             for i in range(32)], '') AS digest
      FROM f)
SELECT page_id, size AS payload_bytes, digest AS payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p JOIN d USING (html)
"""
