"""Suffix-array dedup: removes each byte covered by a string of ``length`` bytes that also starts earlier.

Every window of ``length`` bytes has an anchor, the smallest hash of its grams of ``GRAM`` bytes, so equal windows have equal
anchors. The windows of a text that share an anchor one after another form a piece of some 130 bytes. Pieces whose anchor occurs once, in
all texts and in the piece, hold no repeat and never move. Equal pieces, by anchor, size and a hash of all bytes, are settled by one aggregate: all but the first are repeats whole. What is left,
pieces with a common anchor but different bytes, goes to suffix sorting: Burrows-Wheeler transforms of shards of pieces are
merged by interleave refinement, and the repeated intervals of the merged order are the windows that occur again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bwt
from .common import as_bytes, slices, written

LENGTH = 100
GRAM = 32
#: Windows of one piece at most.
PIECE = 2048
#: Bytes of pieces whose transforms are merged at once, and of one shard of them.
BATCH = 1 << 16
SHARD = 1 << 14
#: An anchor with more different pieces than this is split by window hash.
PIECES = 1000

_MASK = (1 << 64) - 1
_A, _B, _C = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0x632BE59BD9B4E019


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(_B)
    return h ^ (h >> np.uint64(29))


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hash of the ``gram`` bytes (a power of two) from each position, by doubling."""
    h, n, factor = data.astype(np.uint64) * np.uint64(_A) + np.uint64(_C), 1, _B
    while n < gram:
        h = (h[:-n] ^ (h[:-n] >> np.uint64(29))) * np.uint64(factor) + h[n:]
        n, factor = 2 * n, factor * _A & _MASK | 1
    return _mixed(h)


def _least(keys: np.ndarray, span: int) -> np.ndarray:
    """Minimum of each ``span`` neighbouring keys, by doubling."""
    n = 1
    while 2 * n <= span:
        keys, n = np.minimum(keys[:-n], keys[n:]), 2 * n
    return np.minimum(keys[: len(keys) - (span - n)], keys[span - n :]) if n < span else keys


def pieces_of(texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(text, start, number of bytes, anchor, hash of the bytes, whether the anchor occurs twice) of every piece."""
    empty = np.zeros(0, dtype=np.int64)
    if max(map(len, texts), default=0) < length:
        return empty, empty, empty, empty, empty, empty.astype(bool)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    grams = gram_hashes(data)
    span = length - GRAM + 1
    place = np.arange(len(grams), dtype=np.uint64)
    low = np.uint64((1 << max(1, len(grams).bit_length())) - 1)
    # the smallest hash with its place in the low bits: the first of equals, and with places counted down the last of equals
    first = _least((grams & ~low) | place, span) & low
    last_of = low - (_least((grams & ~low) | (low - place), span) & low)
    least = grams[first]
    full = np.ones(len(least), dtype=bool)  # windows inside one text
    for end in offsets[1:-1].tolist():
        full[max(0, end - length + 1) : end] = False
    fresh = np.concatenate([[True], (least[1:] != least[:-1]) | ~full[:-1]])
    starts = np.flatnonzero(full & fresh)
    borders = np.append(np.flatnonzero(fresh | ~full), len(least))
    count = borders[np.searchsorted(borders, starts, side="right")] - starts
    parts = -(-count // PIECE)  # a long run of one anchor is cut
    again = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    count = np.minimum(PIECE, np.repeat(count, parts) - PIECE * again)
    starts = np.repeat(starts, parts) + PIECE * again
    size = count + length - 1
    # the grams below leave no byte out, but only with the size do they fix the bytes
    digest, at, last = _mixed(size.astype(np.uint64) * np.uint64(_A) + np.uint64(_C)), starts.copy(), starts + size - GRAM
    live = np.arange(len(starts))
    while len(live):
        digest[live] = _mixed(digest[live] * np.uint64(_A) + grams[np.minimum(at[live], last[live])])
        live = live[at[live] < last[live]]
        at[live] += GRAM
    text = np.searchsorted(offsets, starts, side="right") - 1
    twice = first[starts] != last_of[starts + count - 1]
    return text, starts - offsets[text], size, least[starts].view(np.int64), digest.view(np.int64), twice


def _grouped(texts: list[bytes], most: int = 1 << 21) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of neighbouring texts of about ``most`` bytes, with the number of the first."""
    at, held = 0, 0
    for k, t in enumerate(texts):
        held += len(t)
        if held > most:
            yield at, texts[at : k + 1]
            at, held = k + 1, 0
    if at < len(texts):
        yield at, texts[at:]


def occurrences(rows: DataFrame, length: int) -> DataFrame:
    """``doc, tie, start, size, anchor, digest, twice`` of every piece. No shuffle, whole texts of any length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            doc, tie = batch.column(0), batch.column(1)
            for first, texts in _grouped(as_bytes(batch.column(2))):
                text, start, size, anchor, digest, twice = pieces_of(texts, length)
                row = pa.array(text + first)
                yield pa.RecordBatch.from_arrays(
                    [doc.take(row), tie.take(row), pa.array(start, pa.int64()).cast(pa.int32()), pa.array(size, pa.int64()).cast(pa.int32()), pa.array(anchor), pa.array(digest), pa.array(twice)],
                    names=["doc", "tie", "start", "size", "anchor", "digest", "twice"],
                )

    return rows.mapInArrow(run, "doc long, tie int, start int, size int, anchor long, digest long, twice boolean")


def _cut(found: DataFrame, rows: DataFrame) -> DataFrame:
    """The bytes of listed pieces: ``anchor, doc, tie, start, bytes``."""
    lists = found.groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "size", "anchor")).alias("list"))  # a list is as long as its text
    both = lists.withColumnsRenamed({"doc": "d", "tie": "t"}).join(rows, F.expr("doc <=> d AND tie = t")).select("doc", "tie", "text", "list")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            texts, lists = as_bytes(batch.column(2)), batch.column(3)
            flat, sizes = lists.flatten(), np.diff(lists.offsets.to_numpy())
            row = np.repeat(np.arange(len(texts)), sizes)
            start, size = flat.field("start"), flat.field("size")
            cut = [texts[r][a : a + n] for r, a, n in zip(row.tolist(), start.to_pylist(), size.to_pylist())]
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [flat.field("anchor"), batch.column(0).take(take), batch.column(1).take(take), start, pa.array(cut, pa.binary())],
                names=["anchor", "doc", "tie", "start", "bytes"],
            )

    return both.mapInArrow(run, "anchor long, doc long, tie int, start int, bytes binary")


def _runs(doc: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, start, end) of the bytes under the given windows, neighbouring windows joined."""
    order = np.lexsort((at, doc))
    doc, at = doc[order], at[order]
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (at[1:] != at[:-1] + 1)])) if len(at) else np.zeros(0, dtype=np.int64)
    last = np.append(new[1:], len(at)) - 1 if len(at) else new
    return doc[new], at[new], at[last] + length


def _sorted_cells(pieces: DataFrame, length: int, n: int) -> DataFrame:
    """``doc, tie, start, end``: windows of the pieces that occur earlier in another piece or place, by merged transforms."""

    def settle(keys: list[tuple], cut: list[bytes]) -> pa.RecordBatch:
        docs = sorted({(k[0] is not None, k[0] or 0, k[1]) for k in keys})
        number = {d: i for i, d in enumerate(docs)}
        doc = np.array([number[(k[0] is not None, k[0] or 0, k[1])] for k in keys])
        start = np.array([k[2] for k in keys], dtype=np.int64)
        string, offset, interval = bwt.repeated(cut, length, SHARD)
        place = start[string] + offset
        order = np.lexsort((place, doc[string], interval))
        interval, owner, place = interval[order], doc[string][order], place[order]
        again = np.concatenate([[False], interval[1:] == interval[:-1]]) if len(interval) else np.zeros(0, dtype=bool)  # all but the first
        owner, a, b = _runs(owner[again], place[again], length)
        return pa.RecordBatch.from_arrays(
            [pa.array([docs[o][1] if docs[o][0] else None for o in owner.tolist()], pa.int64()), pa.array([docs[o][2] for o in owner.tolist()], pa.int32()), pa.array(a, pa.int64()).cast(pa.int32()), pa.array(b, pa.int64()).cast(pa.int32())],
            names=["doc", "tie", "start", "end"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[tuple] = []
        cut: list[bytes] = []
        held, last = 0, None
        for batch in slices(batches):
            for anchor, doc, tie, start, text in zip(*(c.to_pylist() for c in batch.columns)):
                if anchor == last and keys[-1] == (doc, tie, start):  # the same piece of a repeated row: one text, one piece
                    continue
                if held > BATCH and anchor != last:  # rows come by anchor; an anchor stays together
                    yield settle(keys, cut)
                    keys, cut, held = [], [], 0
                keys.append((doc, tie, start))
                cut.append(text)
                held += len(text)
                last = anchor
        if keys:
            yield settle(keys, cut)

    dealt = pieces.repartition(n, "anchor").sortWithinPartitions("anchor", "doc", "tie", "start")
    return dealt.select("anchor", "doc", "tie", "start", "bytes").mapInArrow(run, "doc long, tie int, start int, end int")


def _hot_windows(pieces: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many pieces: each window by itself, so that no group has to be in one place.

    Equal windows are met by two hashes of 64 bits and summed in each task before the shuffle.
    """
    at = F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - length)).alias("at")
    windows = pieces.select("doc", "tie", "start", "bytes", at)
    window = F.substring("bytes", F.col("at") + 1, F.lit(length))
    windows = written(windows.select("doc", "tie", (F.col("start") + F.col("at")).cast("int").alias("start"), F.xxhash64(window).alias("h1"), F.xxhash64(F.lit(7), window).alias("h2")))
    first = windows.groupBy("h1", "h2").agg(F.min(F.struct("doc", "tie", "start")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    return windows.join(first, ["h1", "h2"]).where("NOT (struct(doc, tie, start) <=> first)").select("doc", "tie", "start", (F.col("start") + length).cast("int").alias("end"))


def _released(spark: SparkSession) -> None:
    """Spark deletes shuffle files when the driver's JVM collects the plans that own them; a written stage no longer needs its own."""
    spark.sparkContext._jvm.System.gc()


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc"), F.hash(text).alias("tie"), text.alias("text"))


def repeated_spans(docs: DataFrame, *, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc, tie, spans``: byte ranges of every text that a string of ``length`` bytes with an earlier start covers.

    Texts are UTF-8 bytes, null is empty, matches stay inside a text. Earlier: smaller id (null first), then smaller hash of the
    text for rows that share an id, then start. ``tie`` is that hash. Rows that repeat id and text are one
    text. Texts shorter than ``length`` have no spans; texts without spans have no row. Ranges may touch or overlap.

    Of all pieces (one for some 37 bytes) 40 bytes each are shuffled, of those with repeated anchors the bytes of the first of equals.
    Counts and firsts are summed in each task before the shuffle; joins are by anchor with Spark's splitting of hot
    keys; an anchor with more than ``PIECES`` different pieces is settled window by window. Each stage is
    written to the shared folder.
    """
    if length < 2 * GRAM:
        raise ValueError(f"windows must have {2 * GRAM} bytes at least")
    spark = docs.sparkSession
    rows = _rows(docs, id_col, text_col)
    found = occurrences(rows.where(F.octet_length("text") >= length), length)
    often = written(found.groupBy("anchor").agg(F.count("*").alias("n"), F.max("twice").alias("t")).where("n > 1 OR t").select("anchor"))
    _released(spark)
    again = written(found.join(often, "anchor"))
    _released(spark)
    place = F.struct("doc", "tie", "start")
    firsts = written(again.groupBy("anchor", "size", "digest").agg(F.min(place).alias("first"), F.max("twice").alias("twice")))
    _released(spark)
    whole = again.join(firsts, ["anchor", "size", "digest"]).where(~place.eqNullSafe(F.struct("first.doc", "first.tie", "first.start")))
    kinds = written(firsts.groupBy("anchor").agg(F.count("*").alias("kinds"), F.max("twice").alias("t")).where("kinds > 1 OR t").drop("t"))
    differ = written(firsts.join(kinds, "anchor").select("anchor", "kinds", "first.*", "size"))
    total = differ.agg(F.sum("size")).first()[0] or 0  # one number
    cut = written(_cut(differ.where(F.col("kinds") <= PIECES), rows))
    _released(spark)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (16 * BATCH)))
    spans = _sorted_cells(cut, length, n)
    spans = spans.unionByName(_hot_windows(_cut(differ.where(F.col("kinds") > PIECES), rows), length))
    spans = written(spans.unionByName(whole.select("doc", "tie", "start", (F.col("start") + F.col("size")).cast("int").alias("end"))))
    _released(spark)
    # a list is as long as its text
    return spans.groupBy("doc", "tie").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))


def _kept(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, list[tuple[int, int]]]:
    """(what is left, maximal removed runs). Spans come sorted by start."""
    runs: list[tuple[int, int]] = []
    for a, b in spans:
        if runs and a <= runs[-1][1]:
            if b > runs[-1][1]:
                runs[-1] = (runs[-1][0], b)
        else:
            runs.append((a, b))
    left, at = [], 0
    for a, b in runs:
        left.append(text[at:a])
        at = b
    left.append(text[at:])
    return b"".join(left), runs


def _with_spans(docs: DataFrame, length: int, id_col: str, text_col: str) -> DataFrame:
    spans = written(repeated_spans(docs, length=length, id_col=id_col, text_col=text_col)).withColumnsRenamed({"doc": "__d", "tie": "__t", "spans": "__spans"})
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    _released(docs.sparkSession)
    same = F.col(id_col).cast("long").eqNullSafe(F.col("__d")) & (F.hash(text) == F.col("__t"))
    return docs.join(spans, same, "left").drop("__d", "__t")


def _spans_of(batch: pa.RecordBatch) -> list[list[tuple[int, int]]]:
    lists = batch.column(batch.num_columns - 1)
    return [[(s["start"], s["end"]) for s in x or ()] for x in lists.to_pylist()]


def measure(docs: DataFrame, *, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` of every row of ``docs``; see ``repeated_spans``."""
    kept = _with_spans(docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text")), length, id_col, "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = as_bytes(batch.column(1))
            done = [_kept(t, s) for t, s in zip(texts, _spans_of(batch))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(map(len, texts), pa.int64()),
                    pa.array([len(t) - len(k) for t, (k, _) in zip(texts, done)], pa.int64()),
                    pa.array([len(r) for _, r in done], pa.int64()),
                    pa.array([hashlib.sha256(k).hexdigest() for k, _ in done], pa.string()),
                ],
                names=[id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return kept.select(id_col, "__text", "__spans").mapInArrow(run, f"`{id_col}` {dict(kept.dtypes)[id_col]}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove(docs: DataFrame, *, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the repeated bytes. Characters of which a part is removed go whole; null texts stay null."""
    kept = _with_spans(docs, length, id_col, text_col)
    place, names = docs.columns.index(text_col), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, full = as_bytes(batch.column(place)), batch.column(place).is_valid().to_pylist()
            left = [_kept(t, s)[0].decode("utf-8", "ignore") if ok else None for t, s, ok in zip(texts, _spans_of(batch), full)]
            columns = [*batch.columns[:-1]]
            columns[place] = pa.array(left, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return kept.select(*names, "__spans").mapInArrow(run, docs.schema)
