"""Web archives: pages as WARC records in sorted capture runs, merged to one ordered index, read back.

1. Every task sorts its captures by URL key and time and writes one run: WARC files of one gzip member
   per record, and index entries (URL key, time, id, file, offset, length). Of captures with equal
   payloads one is a response with its bytes, the others revisit it without.
2. The runs' entries are dealt out by ranges of (URL key, time, id). Each range merges its slices of
   all runs, already sorted, by a tree of losers; ranges follow one another, so the whole is one
   globally ordered capture history. A URL of any number of captures spans as many ranges as needed.
3. Records are read through that index, file by file in rising offsets, and checked.

Files appear under a name of their own per attempt and are only known through the index, which Spark's
committer writes; what a lost attempt leaves behind is never read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.columns import whole_numbers
from corpusmill.session import scratch_dir, spill

FILE_BYTES = 1 << 30  # a run goes on in a new file after so many bytes
ENTRIES = 200_000  # index entries a range is meant to hold

_INDEX = "url_key string, captured_at timestamp, page_id long, run int, file string, offset long, length long"
_MERGED = _INDEX + ", range int, place long"
_RECORDS = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url_key string, "
    "captured_at timestamp, range int, place long"
)


def url_key(url: Column) -> Column:
    """Host labels from the right, then path and query: ``org,example)/path?query``; null for no host.

    Scheme, ``www.``, user, port and fragment make no difference, nor does the host's case.
    """
    parts = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(?:[wW]{3}\.)?([^/?#:]+)(?::[0-9]*)?([^#]*)"
    host = F.lower(F.regexp_extract(url, parts, 1))
    rest = F.regexp_extract(url, parts, 2)
    path = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    labels = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    return F.when(host != "", F.concat(labels, F.lit(")"), path))


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    captured_at: Column | None = None,
    revisit_from: int = 0,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
) -> DataFrame:
    """Write one record per row under ``folder``; return the index entries of all runs, stored.

    Payloads are the UTF-8 bytes of ``payload_col``, null as empty. Of equal payloads of at least
    ``revisit_from`` bytes the one with the largest id is a response and the others revisit it; all smaller
    ones are responses. Defined cases: a null id is a response of its own that nothing refers to; rows
    that repeat an id and a payload are of one kind; a null URL, or one without host, has an empty key;
    without ``captured_at`` times count seconds from 2024-01-01 by id; no rows, no files; further columns
    are not read, whatever their names.
    """
    spark = pages.sparkSession
    folder = folder or scratch_dir(spark)
    time = captured_at if captured_at is not None else F.timestamp_seconds(F.lit(1704067200) + F.coalesce(id_col, F.lit(0)))
    rows = pages.select(
        whole_numbers(pages, id_col).alias("page_id"),
        F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary").alias("payload"),
        time.alias("captured_at"),
    )
    rows = rows.withColumn("url_key", F.coalesce(url_key(F.col("url")), F.lit("")))
    rows = rows.withColumn("same", F.sha2("payload", 256))
    chosen = rows.groupBy("same").agg(F.max("page_id").alias("response_id"))
    small = F.octet_length("payload") < revisit_from
    refers = F.when(small | (F.col("page_id") == F.col("response_id")), None).otherwise(F.col("response_id"))
    rows = rows.join(chosen, "same").withColumn("refers_to", F.when(F.col("page_id").isNotNull(), refers))
    rows = rows.select("url_key", "captured_at", "page_id", "url", "payload", "refers_to", F.sha1("payload").alias("sha1"))
    runs = rows.sortWithinPartitions("url_key", "captured_at", "page_id").mapInArrow(_write_run(folder), _INDEX)
    return spill(runs)


def merge_runs(index: DataFrame, ranges: int | None = None) -> DataFrame:
    """All entries with ``range`` and ``place``: ordered by them, they are ordered by URL key, time and id."""
    ranges = ranges or max(1, -(-index.count() // ENTRIES))
    keys = ["url_key", "captured_at", "page_id"]
    dealt = index.repartitionByRange(ranges, *keys).sortWithinPartitions("run", *keys)
    return dealt.mapInArrow(_merge_range, _MERGED)


def read_archives(history: DataFrame) -> DataFrame:
    """The records behind merged index entries, as the files hold them."""
    return history.repartition("file").sortWithinPartitions("file", "offset").mapInArrow(_read_records, _RECORDS)


def captures(pages: DataFrame, **options) -> DataFrame:
    """Write, merge and read back: one row per page, with its place in the ordered history."""
    return read_archives(spill(merge_runs(write_archives(pages, **options))))


# --- records ---------------------------------------------------------------------------------


def record(page_id: int | None, url: str, when: str, payload: bytes, sha1: str, refers_to: int | None) -> bytes:
    """One WARC 1.1 record, uncompressed. A revisit keeps the header of the answer, without its payload."""
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Date: {when}",
        *([f"WARC-Target-URI: {_one_line(url)}"] if url else []),
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if refers_to is not None:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {_record_id(refers_to)}",
        ]
    block = http if refers_to is not None else http + payload
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Type, ids, payload length and digest of one record; the payload of a response is hashed anew."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    block = rest[: int(fields["content-length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("the record does not end where its length says")
    http, _, payload = block.partition(b"\r\n\r\n")
    said = {k.lower(): v for k, _, v in (line.partition(": ") for line in http.decode().split("\r\n")[1:])}
    length, digest = int(said["content-length"]), fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-type"] == "response":
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if (len(payload), found) != (length, digest):
            raise ValueError(f"payload of {fields['warc-record-id']} does not match its header")
    return {
        "page_id": _page_of(fields["warc-record-id"]),
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": fields["warc-type"],
        "refers_to": _page_of(fields.get("warc-refers-to")),
    }


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"


def _page_of(record_id: str | None) -> int | None:
    return int(record_id[10:-1]) if record_id and record_id.startswith("<urn:page:") else None


def _one_line(url: str) -> str:
    return "".join(c if c >= " " else f"%{ord(c):02X}" for c in url)


def _file_system(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def _write_run(folder: str) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _file_system(folder)
        run, out, name, at = TaskContext.get().partitionId(), None, "", 0
        try:
            for batch in batches:
                entries = []
                whens = batch.column("captured_at").cast(pa.timestamp("s"), safe=False)
                columns = [batch.column(c) for c in ("page_id", "url", "payload", "sha1", "refers_to")]
                for i, (page, url, payload, sha1, refers) in enumerate(zip(*columns, strict=True)):
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        system.create_dir(root, recursive=True)
                        name, at = f"run-{run:06d}-{uuid.uuid4().hex}.warc.gz", 0
                        out = system.open_output_stream(f"{root}/{name}", compression=None)
                    when = whens[i].as_py()
                    when = f"{when:%Y-%m-%dT%H:%M:%SZ}" if when is not None else "1970-01-01T00:00:00Z"
                    raw = record(page.as_py(), url.as_py(), when, payload.as_py(), sha1.as_py(), refers.as_py())
                    packed = gzip.compress(raw, 6, mtime=0)
                    out.write(packed)
                    entries.append((f"{folder}/{name}", at, len(packed)))
                    at += len(packed)
                if entries:
                    files, offsets, lengths = zip(*entries, strict=True)
                    yield pa.record_batch(
                        {
                            "url_key": batch.column("url_key"),
                            "captured_at": batch.column("captured_at"),
                            "page_id": batch.column("page_id"),
                            "run": pa.array([run] * len(entries), pa.int32()),
                            "file": pa.array(files, pa.string()),
                            "offset": pa.array(offsets, pa.int64()),
                            "length": pa.array(lengths, pa.int64()),
                        }
                    )
        finally:
            if out is not None:
                out.close()

    return rows


# --- merging ---------------------------------------------------------------------------------


def loser_merge(runs: list[Iterable[tuple]]) -> Iterator[tuple]:
    """Merge sorted runs of tuples. Inner nodes of the tree keep the loser of their match, so that each
    step replays one path from a leaf to the top."""
    ends = [iter(r) for r in runs]
    k = len(ends)
    heads: list[tuple | None] = [next(e, None) for e in ends]

    def beats(a: int, b: int) -> bool:
        if heads[a] is None or heads[b] is None:
            return heads[b] is None and (heads[a] is not None or a < b)
        return (heads[a], a) < (heads[b], b)

    losers = [-1] * max(k, 1)
    top = -1
    for leaf in range(k):
        node, winner = (leaf + k) // 2, leaf
        while node > 0:
            if losers[node] < 0:
                losers[node], winner = winner, -1
                break
            if beats(losers[node], winner):
                losers[node], winner = winner, losers[node]
            node //= 2
        if winner >= 0:
            top = winner
    while top >= 0 and heads[top] is not None:
        yield heads[top]
        heads[top] = next(ends[top], None)
        node, winner = (top + k) // 2, top
        while node > 0:
            if beats(losers[node], winner):
                losers[node], winner = winner, losers[node]
            node //= 2
        top = winner


def _merge_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
    if table is None or len(table) == 0:
        return
    table = table.combine_chunks()
    runs = table.column("run").to_numpy()
    cuts = [0, *(i + 1 for i in (runs[1:] != runs[:-1]).nonzero()[0].tolist()), len(runs)]
    times = table.column("captured_at").cast(pa.int64()).to_pylist()
    lists = [table.column("url_key").to_pylist(), times, table.column("page_id").to_pylist()]

    def entries(start: int, stop: int) -> Iterator[tuple]:
        for i in range(start, stop):
            key, time, page = (c[i] for c in lists)
            yield (key, time is not None, time or 0, page is not None, page or 0, i)

    order = [e[-1] for e in loser_merge([entries(a, b) for a, b in zip(cuts, cuts[1:], strict=False)])]
    done = table.take(pa.array(order))
    number = TaskContext.get().partitionId()
    done = done.append_column("range", pa.array([number] * len(done), pa.int32()))
    done = done.append_column("place", pa.array(range(len(done)), pa.int64()))
    yield from done.combine_chunks().to_batches(max_chunksize=20_000)


def _read_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    name, source = None, None
    try:
        for batch in batches:
            rows = []
            spots = zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True)
            for file, offset, length in spots:
                if file != name:
                    if source is not None:
                        source.close()
                    system, path = _file_system(file)
                    name, source = file, system.open_input_file(path)
                rows.append(parse_record(zlib.decompress(source.read_at(length, offset), wbits=31)))
            if rows:
                kinds = {"record_type": pa.string(), "payload_digest": pa.string()}
                found = {k: pa.array([r[k] for r in rows], kinds.get(k, pa.int64())) for k in rows[0]}
                carried = ("url_key", "captured_at", "range", "place")
                yield pa.record_batch({**found, **{c: batch.column(c) for c in carried}})
    finally:
        if source is not None:
            source.close()
