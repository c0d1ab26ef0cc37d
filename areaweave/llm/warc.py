"""Web archives: write records, read them back, and merge the sorted capture runs of all archives.

Each task writes archives whose records are in order of URL key and time: its capture runs.
``read_archives`` parses the files by their content lengths; ``merge_index`` deals the entries
of all runs out by range and merges, in each range, the runs' sorted segments with a loser tree,
so that the partitions, in order, hold one globally ordered history of captures.

Of records with the same payload the one with the smallest id is a response and the others are
revisits that name it; payloads under ``least_bytes`` are always responses.  A null payload is
empty.  A row without an id refers to the smallest id there is and is a response where no row has
one.  Rows that repeat an id and payload have the same type.  Files go to the session's shared folder.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaweave.llm.common import new_folder, pick, stored, wide

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
END = "\r\n"
#: Records in a file at most, of at most 64 KB each; longer ones are spread over more files.
RECORDS_PER_FILE = 2000
RECORD_BYTES = 65_536
INDEX = ("url_key string, captured string, page_id long, url string, payload_bytes long, payload_digest string, "
         "record_type string, refers_to long, archive string, offset long, length long")


def base32_sha1(payload: Column) -> Column:
    """The payload's SHA-1 in upper-case base 32: five hexadecimal digits make four of base 32."""
    digits = F.sha1(payload)
    numbers = F.array(*[F.conv(F.substring(digits, 5 * g + 1, 5), 16, 10).cast("int") for g in range(8)])
    letter = lambda n, unit: F.substr(F.lit(ALPHABET), (F.floor(n / unit) % 32 + 1).cast("int"), F.lit(1))
    return F.array_join(F.transform(numbers, lambda n: F.concat(*[letter(n, u) for u in (32768, 1024, 32, 1)])), "")


def url_key(url: Column) -> Column:
    """Host labels from the right, then path and query, so that captures of a site are neighbours."""
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "")
    rest = F.regexp_replace(rest, r"#.*$", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, r"^[^/?]*", 0)), r"^www\.|:\d+$", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"),
                    F.regexp_extract(rest, r"^[^/?]*(.*)$", 1))


def roles(pages: DataFrame, least_bytes: int = 0, id_column: str = "page_id", url_column: str = "url",
          payload_column: str = "html") -> DataFrame:
    """Every row with its payload, digest, type and the id that it refers to."""
    rows = pick(pages, page_id=id_column, url=url_column, payload=payload_column)
    rows = rows.withColumn("payload", F.coalesce("payload", F.lit("")))
    rows = rows.select("page_id", "url", "payload", F.octet_length("payload").cast("bigint").alias("payload_bytes"),
                       F.sha1(F.col("payload").cast("binary")).alias("sha1"))
    first = rows.groupBy("sha1").agg(F.min("page_id").alias("first_id"))
    rows = rows.join(first, "sha1")
    revisit = (F.col("payload_bytes") >= least_bytes) & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(
        F.col("first_id"))
    return rows.select("page_id", "url", "payload", "payload_bytes",
                       F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                       F.when(revisit, F.col("first_id")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str | None = None, least_bytes: int = 0, id_column: str = "page_id",
                   url_column: str = "url", payload_column: str = "html", time_column: str | None = None) -> str:
    """Write one record per row under ``folder``; returns the folder.  Without times, ids count seconds."""
    folder = folder or new_folder(pages.sparkSession, "warc")
    rows = roles(pages, least_bytes, id_column, url_column, payload_column)
    captured = F.date_format(F.timestamp_seconds(F.lit(1_700_000_000) + F.coalesce(F.col("page_id"), F.lit(0)) % 100_000_000),
                             "yyyy-MM-dd'T'HH:mm:ss'Z'")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(END))
    name = lambda page: F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(">"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}"),
                    line("Content-Length", F.col("payload_bytes").cast("string")), F.lit(END))
    revisit = F.col("record_type") == "revisit"
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    record = F.concat(
        F.lit(f"WARC/1.1{END}"), line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", name(F.col("page_id"))),
        line("WARC-Target-URI", F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "%0A")),
        line("WARC-Date", captured), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(
            F.lit(f"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{END}"),
            line("WARC-Refers-To", name(F.col("refers_to"))))).otherwise(""),
        F.lit(f"Content-Type: application/http; msgtype=response{END}"),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit(END), block, F.lit(END))
    # Longer records are spread over more files, so that any file can be read at once.
    large = F.greatest(F.lit(0), F.ceil(F.log2((F.col("payload_bytes") + 1) / RECORD_BYTES))).cast("int")
    slot = F.pmod(F.xxhash64("page_id", "url"), F.pow(F.lit(2), "large").cast("bigint"))
    (rows.withColumn("digest", base32_sha1(F.col("payload").cast("binary")))
     .withColumn("large", large).withColumn("slot", slot)
     .sortWithinPartitions("large", "slot", url_key(F.col("url")), captured, "page_id")
     .select("large", "slot", record.alias("value"))
     .write.partitionBy("large", "slot").option("lineSep", END).option("maxRecordsPerFile", RECORDS_PER_FILE)
     .option("compression", "gzip").text(folder))
    return folder


def _headers(block: bytes) -> dict[str, str]:
    pairs = (x.split(": ", 1) for x in block.decode("utf-8").split(END)[1:])
    return {x[0].lower(): x[1] if len(x) > 1 else "" for x in pairs}


def parse_archive(data: bytes) -> Iterator[tuple[int, int, dict[str, str], dict[str, str], bytes]]:
    """Offset, length, record headers, HTTP headers and payload of every record of an archive's plain bytes."""
    at = 0
    while at < len(data):
        split = data.index(b"\r\n\r\n", at)
        head = _headers(data[at:split])
        start, end = split + 4, split + 4 + int(head["content-length"])
        if data[at:at + 5] != b"WARC/" or data[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"no record at byte {at}")
        inner = data.index(b"\r\n\r\n", start, end)
        yield at, end + 4 - at, head, _headers(data[start:inner]), data[inner + 4:end]
        at = end + 4


def _page(name: str) -> int | None:
    value = name[len("<urn:page:"):-1]
    return None if value == "none" else int(value)


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
            rows = []
            for offset, length, head, http, payload in parse_archive(gzip.decompress(content.as_py())):
                kind, digest = head["warc-type"], head["warc-payload-digest"].removeprefix("sha1:")
                if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                    raise ValueError(f"payload and digest differ in {path} at byte {offset}")
                refers = head.get("warc-refers-to")
                rows.append((head["warc-target-uri"], head["warc-date"], _page(head["warc-record-id"]),
                             int(http["content-length"]), digest, kind, None if refers is None else _page(refers),
                             path.as_py(), offset, length))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows) if rows else [[]] * 10, _TYPES, strict=True)], _NAMES)


_NAMES = ["url", "captured", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
          "archive", "offset", "length"]
_TYPES = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(),
          pa.string(), pa.int64(), pa.int64()]


def read_archives(spark, folder: str) -> DataFrame:
    """The captures of all archives under ``folder``, payloads checked against their digests."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt.gz")
             .load(folder).select("path", "content"))
    rows = files.mapInArrow(_read, "url string, captured string, page_id long, payload_bytes long, "
                            "payload_digest string, record_type string, refers_to long, archive string, "
                            "offset long, length long")
    return rows.withColumn("url_key", url_key(F.col("url"))).select(*[x.split()[0] for x in INDEX.split(", ")])


def merge_runs(runs: list[list]) -> Iterator:
    """Sorted lists merged by a tournament tree whose inner nodes keep the losers."""
    k = len(runs)
    if not k:
        return
    at, losers = [0] * k, [-1] * k
    head = [run[0] if run else None for run in runs]

    def beats(a: int, b: int) -> bool:
        """Runs that have ended lose; equal entries go by run, so that the merge is stable."""
        if head[a] is None or head[b] is None:
            return head[b] is None and (head[a] is not None or a < b)
        return (head[a], a) < (head[b], b)

    def play(leaf: int) -> int:
        winner, node = leaf, (leaf + k) // 2
        while node:
            if losers[node] < 0:
                losers[node] = winner
                return -1
            if beats(losers[node], winner):
                losers[node], winner = winner, losers[node]
            node //= 2
        return winner

    champion = 0
    for leaf in range(k):
        champion = play(leaf) if k > 1 else 0
    while head[champion] is not None:
        yield head[champion]
        at[champion] += 1
        run = runs[champion]
        head[champion] = run[at[champion]] if at[champion] < len(run) else None
        champion = play(champion)


def _segments(entries: list) -> Iterator[list]:
    """Entries cut wherever one is less than the one before: each piece is in order."""
    first = 0
    for i in range(1, len(entries) + 1):
        if i == len(entries) or entries[i] < entries[i - 1]:
            yield entries[first:i]
            first = i


def _merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
    if table is None or not table.num_rows:
        return
    keys = list(zip(*[table.column(c).to_pylist() for c in ("url_key", "captured", "archive", "offset")], strict=True))
    ids = [(-1, 0) if x is None else (0, x) for x in table.column("page_id").to_pylist()]
    runs: dict[str, list] = {}
    for row, ((key, captured, archive, offset), page) in enumerate(zip(keys, ids, strict=True)):
        runs.setdefault(archive, []).append((key, captured, page, archive, offset, row))
    # An archive's entries come in its own order; where the shuffle brought their blocks in another one, each block is a run.
    segments = [segment for archive in sorted(runs) for segment in _segments(runs[archive])]
    order = [entry[-1] for entry in merge_runs(segments)]
    yield from table.take(pa.array(order, pa.int64())).combine_chunks().to_batches(max_chunksize=10_000)


#: Captures in one range, about, which a task holds.
RANGE = 100_000


def merge_index(captures: DataFrame, partitions: int | None = None) -> DataFrame:
    """The captures in global order of URL key, time and id: ordered partitions of ordered rows.

    There are so many ranges that each holds about ``RANGE`` entries, which bounds a task's memory whatever the archives'
    size; the place in its archive is part of the key, so a URL with any share of the captures is dealt over many ranges.
    """
    captures = stored(captures, "captures")  # archives are read once: the ranges are chosen from their entries
    count = partitions or max(wide(captures.sparkSession), -(-captures.count() // RANGE))
    ranged = captures.repartitionByRange(count, "url_key", "captured", "page_id", "archive", "offset")
    return ranged.mapInArrow(_merge, captures.schema)
