"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items scans every text once."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORDS, as_bytes, slices

#: Characters of window patterns in one automaton. Larger benchmarks are scanned in several passes of at most this size.
AUTOMATON_CHARS = 16_000_000
#: A word in the original text, where A-Z are not lower-cased yet.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

_SCHEMA = (
    "n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>"
)
_BUILT: dict[str, ahocorasick.Automaton] = {}


def normal(text: bytes) -> list[bytes]:
    """Words of a text: A-Z lower-cased, everything but digits, letters and non-ASCII characters separates."""
    return text.translate(WORDS).split()


def _framed(words: list[bytes]) -> str:
    return (b" " + b" ".join(words) + b" ").decode("latin-1")


def windows_of(items: list[tuple[str, str | None]], window: int) -> dict[str, tuple[int, set[str]]]:
    """Framed pattern of each window -> (number of words, ids of the items that have it)."""
    found: dict[str, tuple[int, set[str]]] = {}
    for item, text in items:
        words = normal((text or "").encode())
        for at in range(max(1, len(words) - window + 1) if words else 0):
            part = words[at : at + window]
            found.setdefault(_framed(part), (len(part), set()))[1].add(item)
    return found


def _automaton(items: list[tuple[str, str | None]], window: int) -> ahocorasick.Automaton:
    key = hashlib.sha256(repr((window, items)).encode()).hexdigest()
    if key not in _BUILT:
        _BUILT.clear()
        made = ahocorasick.Automaton()
        for pattern, (n, ids) in windows_of(items, window).items():
            made.add_word(pattern, (n, sorted(ids)))
        made.make_automaton()
        _BUILT[key] = made
    return _BUILT[key]


def scan(text: bytes, automaton: ahocorasick.Automaton) -> tuple[int, np.ndarray, set[str]]:
    """(number of words, hit flag of each word, ids of the items found)."""
    words = normal(text)
    hit, ids = np.zeros(len(words) + 1, dtype=np.int32), set()
    if words and len(automaton):
        framed = _framed(words)
        ends = [(end, n, found) for end, (n, found) in automaton.iter(framed)]
        if ends:
            gaps = np.flatnonzero(np.frombuffer(framed.encode("latin-1"), dtype=np.uint8) == 32)
            last = np.searchsorted(gaps, np.array([e for e, _, _ in ends]))
            np.add.at(hit, last - np.array([n for _, n, _ in ends]), 1)
            np.add.at(hit, last, -1)
            for _, _, found in ends:
                ids.update(found)
    return len(words), np.cumsum(hit)[:-1] > 0, ids


def _spans(text: str, flags: np.ndarray) -> list[dict]:
    """Character ranges of the original text that the hit words take, neighbouring words as one range."""
    spans: list[dict] = []
    for at, m in enumerate(WORD.finditer(text)):
        if flags[at]:
            if at and flags[at - 1]:
                spans[-1]["end"] = m.end()
            else:
                spans.append({"start": m.start(), "end": m.end()})
    return spans


def _passes(benchmark: DataFrame, window: int, item_col: str, item_text_col: str) -> list[list[tuple[str, str | None]]]:
    """The items, dealt to passes of at most ``AUTOMATON_CHARS`` pattern characters (one item at least)."""
    passes: list[list[tuple[str, str | None]]] = [[]]
    held = 0
    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")), F.col(item_text_col)).distinct()
    for item, text in sorted(rows.toLocalIterator(), key=lambda r: (r[0], r[1] or "")):
        size = sum(map(len, windows_of([(item, text)], window)))
        if held and held + size > AUTOMATON_CHARS:
            passes.append([])
            held = 0
        passes[-1].append((item, text))
        held += size
    return passes


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, *, window: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """Each document's words, the words inside an occurrence of an item's window, and the items found.

    A window is ``window`` consecutive words of an item; an item with fewer words is one window. Words: A-Z
    lower-cased, ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. Gives id, ``n_words``, ``n_hit``, ``n_items``, ``items``
    (ids as strings, sorted), ``spans`` (character ranges in the original text) and ``contaminated``.

    Null and empty texts have no words and no hits; null items count as empty, items without words have no window.
    Repeated documents each give a row; items that share an id count once. Null ids stay null; a null item id is
    reported as "null". Empty tables give no rows, an empty benchmark leaves everything clean. Other columns are ignored.

    The windows travel to every task as item texts of a checked size; a benchmark beyond ``AUTOMATON_CHARS`` pattern
    characters is scanned in several passes whose hits are united. A scan needs no shuffle.
    """
    spark = docs.sparkSession
    passes = _passes(benchmark, window, item_col, item_text_col)

    def one(items: list[tuple[str, str | None]]):
        shared = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = _automaton(shared.value, window)
            for batch in slices(batches):
                out = {"n_words": [], "n_hit": [], "items": [], "spans": [], "flags": []}
                for text in as_bytes(batch.column(batch.num_columns - 1)):
                    n, flags, ids = scan(text, automaton)
                    out["n_words"].append(n)
                    out["n_hit"].append(int(flags.sum()))
                    out["items"].append(sorted(ids))
                    out["spans"].append(_spans(text.decode(), flags) if ids else [])
                    out["flags"].append(np.packbits(flags).tobytes() if len(passes) > 1 else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns[:-1],
                        pa.array(out["n_words"], pa.int64()),
                        pa.array(out["n_hit"], pa.int64()),
                        pa.array(out["items"], pa.list_(pa.string())),
                        pa.array(out["spans"], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    ]
                    + ([pa.array(out["flags"], pa.binary())] if len(passes) > 1 else []),
                    names=[*batch.schema.names[:-1], "n_words", "n_hit", "items", "spans"] + ["flags"] * (len(passes) > 1),
                )

        return run

    kept = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    head = f"`{id_col}` {dict(kept.dtypes)[id_col]}, "
    if len(passes) == 1:
        out = kept.mapInArrow(one(passes[0]), head + _SCHEMA)
    else:
        out = _united(kept, passes, one, head, id_col)
    return out.withColumns({"n_items": F.size("items").cast("long"), "contaminated": F.col("n_hit") > 0})


def _united(kept: DataFrame, passes: list, one, head: str, id_col: str) -> DataFrame:
    """Several passes over the same texts: each pass carries the text on and adds its flags to the words hit so far."""
    state = kept.select(id_col, F.lit(None).cast("binary").alias("__bits"), F.array().cast("array<string>").alias("__items"), "__text")
    schema = head + "__bits binary, __items array<string>, __text string"
    for items in passes:
        step = one(items)

        def run(batches: Iterator[pa.RecordBatch], step=step) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                got = next(step(iter([batch])))
                bits = [
                    bytes(np.bitwise_or(np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8))) if a is not None else b
                    for a, b in zip(batch.column(1).to_pylist(), got.column("flags").to_pylist())
                ]
                items = [sorted({*(a or []), *b}) for a, b in zip(batch.column(2).to_pylist(), got.column("items").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(bits, pa.binary()), pa.array(items, pa.list_(pa.string())), batch.column(3)],
                    names=batch.schema.names,
                )

        state = state.mapInArrow(run, schema)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = as_bytes(batch.column(3))
            words = [len(normal(t)) for t in texts]
            flags = [np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool) for b, n in zip(batch.column(1).to_pylist(), words)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(words, pa.int64()),
                    pa.array([int(f.sum()) for f in flags], pa.int64()),
                    batch.column(2),
                    pa.array([_spans(t.decode(), f) for t, f in zip(texts, flags)], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ],
                names=[id_col, "n_words", "n_hit", "items", "spans"],
            )

    return state.mapInArrow(finish, head + _SCHEMA)


def digest(found: DataFrame) -> DataFrame:
    """The columns of the op4 contract."""
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, *, window: int = 10, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text holds no window of any item. Null texts are clean. No shuffle; see ``decontaminate``."""
    place, out = docs.columns.index(text_col), docs
    for items in _passes(benchmark, window, item_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            automaton = _automaton(shared.value, window)
            for batch in slices(batches):
                hits = ([next(automaton.iter(_framed(w)), None) if (w := normal(t)) and len(automaton) else None for t in as_bytes(batch.column(place))])
                yield batch.filter(pa.array([h is None for h in hits], pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
    return out
