"""WARC archives of pages, and their index merged from locally sorted runs.

Pages become WARC records in files of bounded size in the shared folder. Reading the files back gives each file's captures,
sorted by URL key and time: a run. Runs are dealt by key range, and each range merges its k runs with a loser tree, so
the index is in global order: by key and time within a part, and part after part.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir
from .common import written

#: Records of one archive file at most if none has more bytes than ``SMALL``; twice the bytes, half the records. So a file has 256 MB, or one record.
FILE_RECORDS = 2_000
SMALL = 1 << 17
#: Captures of one range of the index on average.
RANGE_CAPTURES = 50_000
_RECORD = "WARC/1.1"
_END = "\r\n\r\n"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def payload_digest(payload: Column) -> Column:
    """SHA-1 in upper-case base32: five hexadecimal digits are four digits of base 32."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), _DIGITS, _BASE32)


def _uuid(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("\x1f", *[p.cast("string") for p in parts]))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def records(pages: DataFrame, *, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", time_col: str | None = None) -> DataFrame:
    """``record``: the text of one WARC record for each page.

    Of pages with equal payloads of at least ``least_bytes`` bytes the one with the smallest id is a response, the others revisit
    it. The payload of a revisit is left out; its length is kept in a field of its own.
    """
    when = F.col(time_col).cast("timestamp") if time_col else F.timestamp_seconds(1_700_000_000 + F.pmod(F.coalesce(F.col(id_col).cast("long"), F.lit(0)), F.lit(1_000_000_000)))
    body = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"), when.alias("at"), body.alias("body"), payload_digest(body).alias("digest"))
    rows = rows.withColumn("bytes", F.octet_length("body").cast("long"))
    firsts = rows.where(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.min("id").alias("first"))
    rows = rows.join(firsts, "digest", "left")
    revisit = F.coalesce((F.col("bytes") >= least_bytes) & ~F.col("id").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(_END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("body")))
    exact = F.url_encode(F.col("url"))  # a field must stay on one line
    head = F.concat(
        F.lit(f"{_RECORD}\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit("\r\n"),
        line("WARC-Record-ID", _uuid(F.coalesce("id", F.lit(-1)), F.col("url"))),
        line("WARC-Date", F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20\x7F]", "")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("X-Payload-Length", F.col("bytes").cast("string")),
        line("X-Page-URL", exact),
        line("X-Page-ID", F.coalesce(F.col("id").cast("string"), F.lit(""))),
        F.when(
            revisit,
            F.concat(
                F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"),
                line("X-Refers-To-Page-ID", F.col("first").cast("string")),
            ),
        ).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(_END),
    )
    return rows.select(F.concat(head, block).alias("value"))


def write_archives(pages: DataFrame, path: str, *, html_col: str = "html", **columns) -> None:
    """WARC files below ``path``, gzipped, each of a bounded number of bytes. Spark's own writer puts the blank line after each record.

    Pages are written by classes of payload size, each with its own number of records in a file. Equal payloads are in one class, so
    each class finds its own first copies; there are as many classes as a payload's size has doublings.
    """
    size = F.octet_length(F.coalesce(F.col(html_col).cast("string"), F.lit("")))
    kind = F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(size, F.lit(1)) / F.lit(SMALL))).cast("int"))
    found = sorted(r[0] for r in pages.select(kind).distinct().collect())  # some dozen numbers
    for k in found or [0]:
        rows = records(pages.where(kind == k) if len(found) > 1 else pages, html_col=html_col, **columns)
        rows.write.mode("append").option("lineSep", _END).option("maxRecordsPerFile", max(1, FILE_RECORDS >> k)).option("compression", "gzip").text(path)


def url_key(url: str) -> str:
    """Sort-friendly key: host reversed and comma-joined, then path and query, lower-cased, without scheme, port 80/443 and fragment."""
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").removeprefix("www.")
        port = f":{parts.port}" if parts.port not in (None, 80, 443) else ""
    except ValueError:
        return url.lower()
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}{port}){(parts.path or '/')}{query}".lower()


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes, int, int]]:
    """(fields, block, offset, length) of each record, by its Content-Length only: nothing inside a block can end it."""
    at = 0
    while at < len(content):
        split = content.index(_END.encode(), at)
        lines = content[at:split].decode().split("\r\n")
        if lines[0] != _RECORD:
            raise ValueError(f"no record at byte {at}")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        start = split + 4
        end = start + int(fields["Content-Length"])
        if content[end : end + 4] != _END.encode():
            raise ValueError(f"record at byte {at} is cut")
        yield fields, content[start:end], at, end + 4 - at
        at = end + 4


_CAPTURE = "urlkey string, at string, page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, file string, offset long, length long"


def read_archives(files: DataFrame) -> DataFrame:
    """Captures of each archive file, sorted by key, time and id: one run for each file, named by ``file``.

    ``files`` has ``path`` and ``content``, as Spark's binaryFile source gives them. The payload of a response is measured
    and hashed anew and must agree with its record.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import gzip
        from urllib.parse import unquote_plus

        for part in parts:
            for path, content in zip(part["path"], part["content"]):
                rows = []
                for fields, block, offset, length in parse(gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content):
                    number, digest = int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if fields["WARC-Type"] == "response":
                        payload = block[block.index(_END.encode()) + 4 :]
                        if (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()) != (number, digest):
                            raise ValueError(f"{path}: payload at byte {offset} differs from its record")
                    url = unquote_plus(fields["X-Page-URL"])
                    own, first = fields["X-Page-ID"], fields.get("X-Refers-To-Page-ID", "")
                    rows.append((url_key(url), fields["WARC-Date"], int(own) if own else None, url, fields["WARC-Type"], int(first) if first else None, number, digest, path, offset, length))
                rows.sort(key=_order)
                names = [c.split()[0] for c in _CAPTURE.split(", ")]
                yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})

    return files.select("path", "content").mapInPandas(run, _CAPTURE)


def _order(row: tuple) -> tuple:
    """Key, time, then id (null first), file and offset, which no two captures share."""
    return row[0], row[1], row[2] is not None, row[2] or 0, row[8], row[9]


class LoserTree:
    """Merge of k sorted runs: each inner node keeps the loser of its match, so the next winner takes one match a level."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs, self.k = runs, len(runs)
        self.heads = [next(r, None) for r in runs]
        self.loser = [-1] * max(1, self.k)
        for leaf in range(self.k):
            self._play(leaf)

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or x is not None and (x[0], a) < (y[0], b)

    def _play(self, leaf: int) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node:
            other = self.loser[node]
            if other < 0:  # the first to come waits for its opponent
                self.loser[node] = winner
                return
            if self._before(other, winner):
                self.loser[node], winner = winner, other
            node //= 2
        self.loser[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.k and self.heads[winner := self.loser[0]] is not None:
            yield self.heads[winner]
            self.heads[winner] = next(self.runs[winner], None)
            self._play(winner)


def merge_index(captures: DataFrame, n: int | None = None) -> DataFrame:
    """All captures in global order with ``part`` and ``position`` (from 0 within the part).

    Spark deals captures to ranges of (key, time, id); a hot URL is split by its times and ids. Each range takes its share of
    every run, about ``RANGE_CAPTURES`` rows in all, and merges the runs by loser tree. A part of a run that arrives out of order is
    put in order first, so shuffle order cannot break the merge.
    """
    n = n or max(1, -(-captures.count() // RANGE_CAPTURES))
    names = captures.columns

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        runs: dict[str, list[tuple]] = {}
        for part in parts:
            for row in part.astype(object).where(part.notna(), None).itertuples(index=False, name=None):
                runs.setdefault(row[8], []).append((_order(row), row))
        for rows in runs.values():
            if any(a[0] > b[0] for a, b in zip(rows, rows[1:])):
                rows.sort(key=lambda r: r[0])
        number, at, out = TaskContext.get().partitionId(), 0, []
        for _, row in LoserTree([iter(r) for r in runs.values()]):
            out.append((*row, number, at))
            at += 1
            if len(out) == 10_000:
                yield pd.DataFrame(out, columns=[*names, "part", "position"]).astype({"page_id": "Int64", "refers_to": "Int64"})
                out = []
        if out:
            yield pd.DataFrame(out, columns=[*names, "part", "position"]).astype({"page_id": "Int64", "refers_to": "Int64"})

    ranged = captures.repartitionByRange(n, "urlkey", "at", "page_id", "offset")
    return ranged.mapInPandas(run, f"{_CAPTURE}, part int, position long")


def archive(pages: DataFrame, *, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", time_col: str | None = None) -> DataFrame:
    """Write the pages to WARC files, read them back, and give the merged index: one capture for each row of ``pages``.

    Null html is an empty payload; null urls are empty and sort first; null ids stay null, come first in their key and
    time, and are always responses unless a page with an id has the same payload. Rows that repeat id and payload are
    all responses if theirs is the smallest id. Without ``time_col`` captures are dated by their ids. An empty table gives no rows. Other
    columns are ignored. Payloads of any length stay whole.

    Digests are summed in each task before the shuffle, one row a payload; pages meet their first copy by equality of
    digests, where Spark splits a hot payload. Archives, runs and index lie in the shared folder.
    """
    spark = pages.sparkSession
    path = shared_dir(spark)
    write_archives(pages, path, least_bytes=least_bytes, id_col=id_col, url_col=url_col, html_col=html_col, time_col=time_col)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt.gz").load(path)
    return merge_index(written(read_archives(files)))


def digest(index: DataFrame) -> DataFrame:
    """The columns of the op1 contract."""
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
