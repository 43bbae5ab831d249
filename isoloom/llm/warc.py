"""WARC archives: writing with revisit records, reading back, and an index merged over all archives.

Records with equal payloads of at least ``least`` bytes are written once: the one with the largest page_id is the
response, the others are revisits that refer to it. Archives are written by Spark's own text writer (records are UTF-8,
the record end ``CRLF CRLF`` is its line separator, gzip), so that any store works and a lost task leaves nothing behind.

Each archive is read as one stream by the lengths in its headers; the digest of every payload is verified. Its captures,
sorted by (URL key, timestamp, page_id), are a run. Sampled splitters cut the runs into key ranges, and the segments of
one range are merged by a loser tree; ranges follow each other, so the captures are globally ordered.

Null html counts as empty. Null urls are left out of the record and come back as null; they sort first. Null page_ids
are revisits of any other equal payload, and responses if there is none. Rows that share page_id and payload are each a
response where that id is the largest. An empty table writes no record and gives an empty index.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isoloom.llm.common import settle
from isoloom.session import by_sorting, scratch_path

LEAST_BYTES = 1000
RECORDS_PER_ARCHIVE = 4000
RANGE_CAPTURES = 50_000
SAMPLE_KEYS = 20_000
END = "\r\n\r\n"
CAPTURED = "timestamp_seconds(1704067200 + pmod(coalesce(page_id, 0) * 7919, 31536000))"
CAPTURE = (
    "url_key string, captured string, page_id long, url string, record_type string, refers_to long, "
    "payload_digest string, payload_bytes long, archive string, record_start long, record_bytes long"
)


def with_record_types(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, html plus payload_bytes, payload_digest, record_type and refers_to."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("html").cast("long"), "payload_digest": F.sha1("html")})
    same = rows.where(F.col("payload_bytes") >= least).groupBy("payload_digest", "payload_bytes").agg(
        F.max("page_id").alias("first_id"), F.count("*").alias("n")
    )
    same = settle(same.where("n > 1").drop("n"), "payloads")
    rows = rows.join(by_sorting(same), ["payload_digest", "payload_bytes"], "left")
    revisit = F.expr("first_id is not null and not (page_id <=> first_id)")
    return rows.withColumns({
        "record_type": F.when(revisit, "revisit").otherwise("response"), "refers_to": F.when(revisit, F.col("first_id")),
    }).drop("first_id")


def write_archives(typed: DataFrame, path: str, records: int = RECORDS_PER_ARCHIVE) -> None:
    """One WARC/1.1 record per row of ``with_record_types``."""
    eol = F.lit("\r\n")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"), F.lit(END),
    )
    block = F.concat(http, F.when(F.col("record_type") == "response", F.col("html")).otherwise(""))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")

    def header(name: str, value) -> F.Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, eol), F.lit(""))

    def urn(c: str):
        return F.concat(F.lit("<urn:page:"), F.col(c).cast("string"), F.lit(">"))

    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        header("WARC-Type", F.col("record_type")),
        header("WARC-Record-ID", F.coalesce(urn("page_id"), F.lit("<urn:page:>"))),
        header("WARC-Date", F.date_format(F.expr(CAPTURED), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        header("WARC-Target-URI", url),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        header("WARC-Refers-To", urn("refers_to")),
        F.when(F.col("record_type") == "revisit", F.lit(
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n")).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        header("Content-Length", F.octet_length(block).cast("string")),
        eol, block,
    )
    writer = typed.select(record.alias("value")).write.option("lineSep", END).option("compression", "gzip")
    writer.option("maxRecordsPerFile", records).text(path)


def read_records(stream) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(start, bytes, headers, block) of each record of an uncompressed stream."""
    start = 0
    while line := stream.readline():
        if line.strip() != b"WARC/1.1":
            raise ValueError(f"no record starts at byte {start}")
        size, headers = len(line), {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            size += len(line)
            name, _, value = line.decode("utf-8").partition(":")
            headers[name.strip()] = value.strip()
        block = stream.read(int(headers["Content-Length"]))
        if len(block) < int(headers["Content-Length"]) or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"the record at byte {start} is cut short")
        size += len(line) + len(block) + 4
        yield start, size, headers, block
        start += size


def url_key(url: str | None) -> str:
    """Host labels from the right, then the rest, so that a site's pages stand together."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.lower())
        host = parts.hostname or ""
    except ValueError:
        return url.lower()
    rest = parts.path + ("?" + parts.query if parts.query else "")
    return ",".join(reversed(host.split("."))) + ")" + rest if host else url.lower()


def captures(archive: str, content: bytes) -> list[tuple]:
    """The run of one archive: its captures, sorted; payloads are checked against their digests."""
    found = []
    with gzip.open(io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content) as stream:
        for start, size, headers, block in read_records(stream):
            head, _, payload = block.partition(b"\r\n\r\n")
            digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
            full = int(head.rpartition(b"Content-Length:")[2])
            if headers["WARC-Type"] == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != full):
                raise ValueError(f"payload of the record at byte {start} of {archive} is damaged")

            def number(name: str) -> int | None:
                digits = headers.get(name, "").removeprefix("<urn:page:").removesuffix(">")
                return int(digits) if digits else None

            url = headers.get("WARC-Target-URI")
            found.append((
                url_key(url), headers["WARC-Date"], number("WARC-Record-ID"), url, headers["WARC-Type"],
                number("WARC-Refers-To"), digest, full, archive, start, size,
            ))
    found.sort(key=_order)
    return found


def _order(capture: tuple) -> tuple:
    return capture[0], capture[1], -1 if capture[2] is None else capture[2], capture[8], capture[9]


def loser_tree_merge(runs: list[list], key=_order) -> Iterator:
    """Merge sorted runs; each step replays one leaf-to-root path of a tree that holds the losers of its matches."""
    k = max(len(runs), 1)
    streams = [iter(r) for r in runs] or [iter(())]
    last = (1,)
    heads: list = []
    for s in streams:
        item = next(s, None)
        heads.append((last, None) if item is None else ((0, key(item)), item))
    losers = [-1] * k

    def play(leaf: int) -> int:
        """Send ``leaf`` towards the root; losers stay in the nodes, the winner is returned (-1: node still open)."""
        winner, node = leaf, (leaf + k) // 2
        while node > 0:
            if losers[node] == -1:
                losers[node] = winner
                return -1
            if heads[losers[node]][0] < heads[winner][0]:
                losers[node], winner = winner, losers[node]
            node //= 2
        return winner

    winner = 0 if k == 1 else -1
    for leaf in range(k if k > 1 else 0):
        if (played := play(leaf)) != -1:
            winner = played
    while heads[winner][0] != last:
        yield heads[winner][1]
        item = next(streams[winner], None)
        heads[winner] = (last, None) if item is None else ((0, key(item)), item)
        if k > 1:
            winner = play(winner)


def merged_index(spark: SparkSession, path: str, range_captures: int = RANGE_CAPTURES) -> DataFrame:
    """All captures of the archives under ``path`` with ``capture_no``, their place in the global order from 0."""
    archives = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    run_shape = f"archive string, captures array<struct<{', '.join(c.replace(' ', ':', 1) for c in CAPTURE.split(', '))}>>"

    def runs(frames):
        import pandas as pd

        names = [c.split(" ")[0] for c in CAPTURE.split(", ")]
        for frame in frames:
            for archive, content in zip(frame["path"], frame["content"]):
                rows = [dict(zip(names, c)) for c in captures(archive.rpartition("/")[2], content)]
                if rows:
                    yield pd.DataFrame({"archive": [archive], "captures": pd.Series([rows], dtype=object)})

    sorted_runs = settle(archives.mapInPandas(runs, run_shape), "runs")
    total = sorted_runs.agg(F.sum(F.size("captures"))).first()[0] or 0
    ranges = max(1, -(-total // range_captures))
    keys = sorted_runs.select(F.inline(F.expr("transform(captures, c -> struct(c.url_key as u, c.captured as t, coalesce(c.page_id, -1) as p))")))
    one_in = max(1, total // SAMPLE_KEYS)  # about SAMPLE_KEYS keys come back, however many there are
    sample = keys.where(F.pmod(F.xxhash64("u", "t", "p"), F.lit(one_in)) == 0).collect() if ranges > 1 else []
    sample = sorted(tuple(r) for r in sample)
    splitters = [sample[len(sample) * i // ranges] for i in range(1, ranges)] if sample else []
    segment = run_shape.replace("archive string", "range_no int, archive string")

    def cut(frames):
        import pandas as pd

        for frame in frames:
            for archive, run in zip(frame["archive"], frame["captures"]):
                parts: dict[int, list] = {}
                for c in run:
                    key = (c["url_key"], c["captured"], -1 if c["page_id"] is None else c["page_id"])
                    parts.setdefault(bisect_right(splitters, key), []).append(c)
                rows = list(map(list, parts.values()))
                yield pd.DataFrame({"range_no": list(parts), "archive": [archive] * len(parts), "captures": pd.Series(rows, dtype=object)})

    def merge(frame):
        import pandas as pd

        names = [c.split(" ")[0] for c in CAPTURE.split(", ")]
        lists = [[tuple(c[n] for n in names) for c in run] for run in frame["captures"]]
        out = pd.DataFrame(list(loser_tree_merge(lists)), columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})
        out["range_no"], out["place"] = frame["range_no"].iloc[0], range(len(out))
        return out

    segments = sorted_runs.mapInPandas(cut, segment)
    merged = segments.groupBy("range_no").applyInPandas(merge, f"{CAPTURE}, range_no int, place long")
    merged = settle(merged, "index")
    before = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    counts = merged.groupBy("range_no").agg(F.count("*").alias("n"))  # one row per range
    starts = counts.select("range_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    merged = merged.join(by_sorting(starts), "range_no")
    return merged.withColumn("capture_no", F.col("start") + F.col("place")).drop("range_no", "place", "start")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages to archives in the shared scratch folder, read them back and return the merged index."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(with_record_types(pages), path)
    return merged_index(pages.sparkSession, path)
