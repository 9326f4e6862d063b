"""Cross-tokenizer alignment by merge-path partitioning.

Two tokenizers cut the same bytes. Where a token of A and one of B overlap there is a link; where tokens of both end at one
byte, a group ends. Both follow from merging the two sorted lists of token ends. The merge is a path through the grid of A ends
against B ends, and a binary search along an anti-diagonal tells where the path crosses it, without walking there. Diagonals a fixed
number of ends apart so cut the merge of any text into pieces of equal work that need nothing of each other: a piece is a row
with its share of both id lists, one token more of each (the one that lies across its end), and the bytes before it. Pieces emit their links. The group that
is open at the end of a piece goes on in the next; pieces of one text are stitched there in order.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from .common import slices, written

#: Ends of a piece, of a chunk (the pieces whose links are looked up together), and of what a task merges at once.
PIECE = 1 << 16
CHUNK = 1 << 21
LOT = 1 << 17

SPACE = "▁"
# Fixed value: the pattern by which a byte-level tokenizer cuts words.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Other characters may be letters in one edition of Unicode and none in another: texts with them are left to A's own library.
_OLD = "\x00-\u024f\u0370-\u0373\u0386-\u03ce\u0400-\u0481\u2000-\u206f\u20a0-\u20b5\u3041-\u3096\u30a1-\u30fe\u3000-\u3020\u4e00-\u9fa5\uac00-\ud7a3\uff01-\uff5e"
_RARE = re.compile(f"[^{_OLD}]")


class Vocabularies(NamedTuple):
    """What tasks need of both tokenizers: the files, the bytes of each id, and A's ranks if merging by rank is proven."""

    spec: str
    model: bytes
    a: list[bytes]
    b: list[bytes]
    ranks: dict[bytes, int] | None

    @property
    def sizes(self) -> Sizes:
        return Sizes(*(np.array([*map(len, x)], dtype=np.int64) for x in (self.a, self.b)))


class Sizes(NamedTuple):
    """Bytes of each id of A and of B."""

    a: np.ndarray
    b: np.ndarray

    @property
    def kinds(self) -> tuple[type, type]:
        """The narrowest numbers that hold the ids; in these they are stored."""
        return tuple(np.uint16 if len(x) <= 1 << 16 else np.uint32 for x in self)


def _library(spec: str) -> Tokenizer:
    own = Tokenizer.from_str(spec)
    own.no_truncation()
    own.no_padding()
    own.encode_special_tokens = True  # their strings in a text are plain text
    return own


def vocabularies(spec: str, model: bytes) -> Vocabularies:
    """Both files read and checked.

    A's vocabulary is merged by rank, which is several times faster than its own library. It is proven first that this gives the
    same: ids come in the order of the merges, and every vocabulary string alone is merged to itself. A pair of tokens that
    stand side by side and make a third one is then the pair of that one's merge, since the merges inside a stretch that
    none has crossed are those of the stretch alone.
    """
    form = json.loads(spec)
    pre, merging = form["pre_tokenizer"] or {}, form["model"]
    if form["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
        raise ValueError("A must be a byte-level tokenizer that cuts words and adds no space")
    own = _library(spec)
    vocabulary, pairs = merging["vocab"], [m.split(" ") if isinstance(m, str) else m for m in merging["merges"]]
    made = [vocabulary[a + b] for a, b in pairs]
    alone = all([t.id for t in own.model.tokenize(w)] == [i] for w, i in vocabulary.items())
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(sorted({*range(256)} - {*printable}))}
    raw = {w: bytes(byte[c] for c in w) for w in vocabulary if all(c in byte for c in w)}
    special = {t["content"] for t in form["added_tokens"]}
    proven = alone and all(x < y for x, y in zip(made, made[1:])) and all(c in vocabulary for c in byte)
    ranks = {raw[w]: i for w, i in vocabulary.items() if w in raw and w not in special} if proven else None
    every = own.get_vocab(with_added_tokens=True)
    bytes_a = [b""] * (max(every.values()) + 1)
    for token, i in every.items():
        bytes_a[i] = raw.get(token, token.encode())
    other = SentencePieceProcessor(model_proto=model)
    pieces = [other.id_to_piece(i) for i in range(other.get_piece_size())]
    bytes_b = [bytes([int(p[3:5], 16)]) if other.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
    return Vocabularies(spec, model, bytes_a, bytes_b, ranks)


class Encoder:
    """Ids of both tokenizers for whole texts, in a worker process."""

    def __init__(self, v: Vocabularies):
        self.v = v
        self.by_rank = v.ranks and tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=v.ranks, special_tokens={})
        self.b = SentencePieceProcessor(model_proto=v.model)
        self.kinds = v.sizes.kinds
        self._own: Tokenizer | None = None

    def _by_library(self, text: str) -> list[int]:
        if self._own is None:  # few texts need it
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has given this task one core
            self._own = _library(self.v.spec)
        return self._own.encode(text, add_special_tokens=False).ids

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of space and text by A, of the text by B; both empty where the text is, or where the bytes of either differ."""
        a: list[int] = []
        b: list[int] = []
        if text:
            spaced = f" {text}"
            a = self._by_library(spaced) if self.by_rank is None or _RARE.search(text) else self.by_rank.encode_ordinary(spaced)
            b = self.b.encode(text)
            raw = spaced.encode()
            if b"".join(map(self.v.a.__getitem__, a)) != raw or b"".join(map(self.v.b.__getitem__, b)) != raw:
                a, b = [], []
        return np.array(a, dtype=self.kinds[0]), np.array(b, dtype=self.kinds[1])


_ENCODERS: dict[str, Encoder] = {}


def _encoder(v: Vocabularies) -> Encoder:
    """One for each worker process; it serves the next task too."""
    key = hashlib.sha256(v.spec.encode() + v.model).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(v)
    return _ENCODERS[key]


def diagonal(a: np.ndarray, b: np.ndarray, d: int) -> int:
    """How many of the first ``d`` ends of the merge are of A; of equal ends that of A comes first."""
    low, high = max(0, d - len(b)), min(d, len(a))
    while low < high:
        middle = (low + high) // 2
        if a[middle] <= b[d - 1 - middle]:
            low = middle + 1
        else:
            high = middle
    return low


def cut_pieces(a: np.ndarray, b: np.ndarray, work: int) -> list[tuple[int, int, int, int]]:
    """(first of A, end of A, first of B, end of B) of each piece of ``work`` merged ends; ``a`` and ``b`` are the ends."""
    total = len(a) + len(b)
    marks = [*range(0, total, work), total] if total else [0, 0]
    of_a = [diagonal(a, b, d) for d in marks]
    return [(i, j, d - i, e - j) for (i, d), (j, e) in zip(zip(of_a, marks), zip(of_a[1:], marks[1:]))]


_PIECE = "chunk long, row long, {id} {kind}, piece int, pieces int, from_a long, from_b long, n_a int, n_b int, a binary, b binary"


def pieces(docs: DataFrame, v: Vocabularies, *, work: int = PIECE, chunk: int = CHUNK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of every row of ``docs``, one at least.

    ``from_a`` and ``from_b``: bytes before the piece's first token of either. ``a`` and ``b``: ids in the numbers of ``Sizes.kinds``, packed, ``n_a`` and
    ``n_b`` own ones and, but in a text's last piece, the one that follows. ``row`` tells rows apart, ``chunk`` deals pieces to lots of some
    ``chunk`` ends. Both are numbers of the task that makes them, so the result must be written before it is read twice.
    """
    shared = docs.sparkSession.sparkContext.broadcast(v)
    kept = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    names = ["chunk", "row", id_col, "piece", "pieces", "from_a", "from_b", "n_a", "n_b", "a", "b"]
    kinds = [pa.int64(), pa.int64(), None, pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, sizes = _encoder(shared.value), shared.value.sizes
        pack = zstandard.ZstdCompressor(level=1).compress
        lot = row = TaskContext.get().partitionId() << 32
        held = 0
        for batch in slices(batches, 256):
            out: list[list] = [[] for _ in names]
            for place, text in enumerate(batch.column(1)):
                a, b = both.encode(text.as_py())
                total = len(a) + len(b)
                if total > work:
                    ends = np.cumsum(sizes.a[a]), np.cumsum(sizes.b[b])
                    cuts = cut_pieces(*ends, work)
                else:
                    ends, cuts = (), [(0, len(a), 0, len(b))]
                for k, (i, j, m, n) in enumerate(cuts):
                    before = [int(e[x - 1]) if x else 0 for e, x in zip(ends, (i, m))] or [0, 0]
                    new = (lot, row, place, k, len(cuts), *before, j - i, n - m, pack(a[i : j + 1].tobytes()), pack(b[m : n + 1].tobytes()))
                    for column, value in zip(out, new):
                        column.append(value)
                    held += 16 + j - i + n - m  # empty texts count too
                    if held >= chunk:
                        lot, held = lot + 1, 0
                row += 1
            columns = [batch.column(0).take(pa.array(c, pa.int32())) if kind is None else pa.array(c, kind) for c, kind in zip(out, kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return kept.mapInArrow(run, _PIECE.format(id=f"`{id_col}`", kind=dict(kept.dtypes)[id_col]))


class Merged:
    """Links and group ends of many pieces at once. Each piece's bytes are moved behind those of the piece before it."""

    def __init__(self, length: Sizes, from_a: np.ndarray, from_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, a: list[bytes], b: list[bytes]):
        count = len(a)
        kinds = length.kinds
        self.a, self.b = (np.frombuffer(b"".join(x), dtype=kind) for x, kind in zip((a, b), kinds))
        sizes = [np.array([len(x) // kind().itemsize for x in side], dtype=np.int64) for side, kind in zip((a, b), kinds)]
        sums = [np.concatenate([[0], np.cumsum(n[ids])]) for n, ids in zip(length, (self.a, self.b))]
        bounds = [np.concatenate([[0], np.cumsum(s)]) for s in sizes]
        spans = np.maximum(*(start + total[at[1:]] - total[at[:-1]] for start, total, at in zip((from_a, from_b), sums, bounds))) + 1
        base = np.cumsum(spans) - spans
        self.start_a = base + from_a  # where the last end of A before the piece lies
        owner = [np.repeat(np.arange(count), s) for s in sizes]
        ends = [
            total[1:] + np.repeat(base + start - total[at[:-1]], s)
            for start, total, at, s in zip((from_a, from_b), sums, bounds, sizes)
        ]
        own = [np.arange(len(o)) - at[o] < n[o] for o, at, n in zip(owner, bounds, (n_a, n_b))]

        at_a, at_b = np.flatnonzero(own[0]), np.flatnonzero(own[1])
        over = np.searchsorted(ends[1], ends[0][at_a])  # the token of B that holds the last byte of this one of A
        under = np.searchsorted(ends[0], ends[1][at_b])
        here = ends[1][at_b]
        tie = np.concatenate([ends[0], [-1]])[under] == here
        tie |= here == self.start_a[owner[1][at_b]]  # A's token with this end is in the piece before
        alone = ~tie
        self.piece = np.concatenate([owner[0][at_a], owner[1][at_b][alone]])
        self.pair = self.a[np.concatenate([at_a, under[alone]])].astype(np.int64) << 32 | self.b[np.concatenate([over, at_b[alone]])].astype(np.int64)
        cuts = here[tie]
        self.groups = np.bincount(owner[1][at_b][tie], minlength=count)
        self.own_a, self.own_b = at_a, at_b
        self.piece_a, self.piece_b = owner[0][at_a], owner[1][at_b]
        # the number of each own token's group; what is open at the end of a piece has a number of its own
        self.group_a = np.searchsorted(cuts, ends[0][at_a]) + self.piece_a
        self.group_b = np.searchsorted(cuts, here) + self.piece_b


class _Names:
    """Decimal ids with the sign that follows them: between tokens, between sides, between groups."""

    def __init__(self, n_a: int, n_b: int):
        self.first_b = 2 * n_a
        self.all = [f"{i}{sign}" for n, signs in ((n_a, ",|"), (n_b, ",;")) for i in range(n) for sign in signs]

    def whole(self, m: Merged, count: int) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each piece that is a whole text, so that every group has tokens of both sides."""
        ends_a = np.append(m.group_a[1:] != m.group_a[:-1], True)[: len(m.group_a)]
        ends_b = np.append(m.group_b[1:] != m.group_b[:-1], True)[: len(m.group_b)]
        place_a = np.arange(len(m.group_a)) + np.searchsorted(m.group_b, m.group_a)
        place_b = np.arange(len(m.group_b)) + np.searchsorted(m.group_a, m.group_b, side="right")
        codes = np.empty(len(place_a) + len(place_b), dtype=np.int64)
        codes[place_a] = 2 * m.a[m.own_a].astype(np.int64) + ends_a
        codes[place_b] = 2 * m.b[m.own_b].astype(np.int64) + ends_b + self.first_b
        sizes = np.bincount(m.piece_a, minlength=count) + np.bincount(m.piece_b, minlength=count)
        made, at, name = [], 0, self.all.__getitem__
        for size in sizes.tolist():
            made.append("".join(map(name, codes[at : at + size].tolist()))[:-1])
            at += size
        return made

    def part(self, m: Merged, k: int) -> str:
        """Groups of one piece of several; the first may have begun before, and the last, perhaps empty, goes on."""
        a, b = (np.flatnonzero(p == k) for p in (m.piece_a, m.piece_b))
        first = k + int(m.groups[:k].sum())
        sides = []
        for at, group, ids, own in ((a, m.group_a, m.a, m.own_a), (b, m.group_b, m.b, m.own_b)):
            bounds = np.searchsorted(group[at], np.arange(first, first + int(m.groups[k]) + 2))
            texts = ids[own[at]].tolist()
            sides.append([",".join(map(str, texts[x:y])) for x, y in zip(bounds.tolist(), bounds[1:].tolist())])
        return ";".join(f"{x}|{y}" for x, y in zip(*sides))


def _stitched(parts: Iterator[str]) -> Iterator[str]:
    """The groups of a text in order, from its pieces in order: the last group of each goes on as the first of the next."""
    open_a: list[str] = []
    open_b: list[str] = []
    for part in parts:
        first, *rest = part.split(";")
        for side, text in zip((open_a, open_b), first.split("|")):
            if text:
                side.append(text)
        if rest:
            yield f"{','.join(open_a)}|{','.join(open_b)}"
            yield from rest[:-1]
            open_a, open_b = ([t] if t else [] for t in rest[-1].split("|"))


def _lots(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Runs of neighbouring pieces with some ``most`` ends."""
    work = 16 + batch.column("n_a").to_numpy().astype(np.int64) + batch.column("n_b").to_numpy()
    lot = (np.cumsum(work) - 1) // most
    starts = np.flatnonzero(np.append(True, lot[1:] != lot[:-1])).tolist() if len(lot) else []
    for a, b in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(a, b - a)


def _merged(length: Sizes, batch: pa.RecordBatch) -> Merged:
    numbers = (batch.column(c).to_numpy() for c in ("from_a", "from_b", "n_a", "n_b"))
    unpack = zstandard.ZstdDecompressor().decompress
    return Merged(length, *numbers, *([unpack(x) for x in batch.column(c).to_pylist()] for c in "ab"))


def links(cut: DataFrame, length: Sizes) -> DataFrame:
    """``chunk``, ``pair`` (id of A times 2^32 plus id of B) and ``n``, its links in some pieces of the chunk. No shuffle."""
    shared = cut.sparkSession.sparkContext.broadcast(length)
    names = ["chunk", "pair", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def summed() -> Iterator[pa.RecordBatch]:
            for chunk, parts in held.items():
                pair, place = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
                n = np.zeros(len(pair), dtype=np.int64)
                np.add.at(n, place, np.concatenate([c for _, c in parts]))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), chunk)), pa.array(pair), pa.array(n)], names=names)
            held.clear()

        waiting = 0
        for batch in batches:
            for lot in _lots(batch, LOT):
                m = _merged(shared.value, lot)
                chunk = lot.column("chunk").to_numpy()
                for k in np.unique(chunk).tolist():
                    held.setdefault(k, []).append(np.unique(m.pair[chunk[m.piece] == k], return_counts=True))
                    waiting += len(held[k][-1][0])
                if len(held) > 1 or waiting > 16 * LOT:  # a chunk's pieces lie one after another
                    yield from summed()
                    waiting = 0
        yield from summed()

    return cut.select("chunk", "from_a", "from_b", "n_a", "n_b", "a", "b").mapInArrow(run, "chunk long, pair long, n long")


_SUMS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _measured(cut: DataFrame, known: DataFrame, length: Sizes, id_col: str, keep: bool) -> DataFrame:
    """Each piece with its numbers; ``groups`` of pieces of longer texts, digest of texts of one piece."""
    shared = cut.sparkSession.sparkContext.broadcast(length)
    kind = dict(cut.dtypes)[id_col]
    schema = f"row long, `{id_col}` {kind}, piece int, pieces int, {', '.join(f'{c} long' for c in _SUMS)}, groups string, groups_sha256 string"

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = _names(len(shared.value.a), len(shared.value.b))
        pair, total, best = (right.column(c).to_numpy() for c in ("pair", "total", "best"))
        order = np.argsort(pair, kind="stable")
        pair, total, best = pair[order], total[order], best[order]
        made = []
        for batch in (lot for b in left.combine_chunks().to_batches() for lot in _lots(b, LOT)):
            m, count = _merged(shared.value, batch), batch.num_rows
            place = np.searchsorted(pair, m.pair)
            sums = np.zeros(count, dtype=np.int64)
            np.add.at(sums, m.piece, total[place])
            one = (batch.column("pieces").to_numpy() == 1).tolist()
            groups = [w if single else names.part(m, k) for k, (w, single) in enumerate(zip(names.whole(m, count), one))]
            code = [(hashlib.sha256(g.encode()).hexdigest() if g else "") if single else None for g, single in zip(groups, one)]
            made.append(
                pa.table(
                    {
                        "row": batch.column("row"), id_col: batch.column(id_col), "piece": batch.column("piece"), "pieces": batch.column("pieces"),
                        "n_a": batch.column("n_a").cast(pa.int64()), "n_b": batch.column("n_b").cast(pa.int64()), "n_groups": pa.array(m.groups, pa.int64()),
                        "n_links": pa.array(np.bincount(m.piece, minlength=count), pa.int64()),
                        "n_best": pa.array(np.bincount(m.piece[best[place]], minlength=count), pa.int64()), "count_sum": pa.array(sums),
                        "groups": pa.array([g if keep or not single else None for g, single in zip(groups, one)], pa.string()),
                        "groups_sha256": pa.array(code, pa.string()),
                    }
                )
            )
        return pa.concat_tables(made)

    return cut.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(run, schema)


@cache
def _names(n_a: int, n_b: int) -> _Names:
    return _Names(n_a, n_b)


def _joined(parts: DataFrame, id_col: str, keep: bool) -> DataFrame:
    """One row for each text of several pieces, which come in order."""
    names = [id_col, *_SUMS, "groups", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in slices(iter([batch]), 64) for r in zip(*(c.to_pylist() for c in r.columns)))
        ids = None
        for _, text in itertools.groupby(rows, key=lambda r: r[0]):
            sums, kept, code = [0] * len(_SUMS), [], hashlib.sha256()
            first: list = []

            def read(text=text, sums=sums, first=first):
                for r in text:
                    first[:] = [r[1]]
                    sums[:] = [x + y for x, y in zip(sums, r[3 : 3 + len(_SUMS)])]
                    yield r[-1]

            for k, group in enumerate(_stitched(read())):
                code.update(f"{';' if k else ''}{group}".encode())
                if keep:
                    kept.append(group)
            ids = [first[0], *sums, ";".join(kept) if keep else None, code.hexdigest()]
            yield pa.RecordBatch.from_pylist([dict(zip(names, ids))], schema=schema)

    rows = parts.where("pieces > 1").repartition("row").sortWithinPartitions("row", "piece").select("row", id_col, "piece", *_SUMS, "groups")
    kind = dict(parts.dtypes)[id_col]
    schema = to_arrow_schema(parts.select(*names).schema)
    return rows.mapInArrow(run, f"`{id_col}` {kind}, {', '.join(f'{c} long' for c in _SUMS)}, groups string, groups_sha256 string")


def align(
    docs: DataFrame, a: str, b: str, *, work: int = PIECE, chunk: int = CHUNK, keep_groups: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256`` of every row.

    ``a`` and ``b`` are the paths of a tokenizers and of a sentencepiece file. A link is a token of A and one of B that share bytes of
    space and text; the count of a pair of ids is its links in all rows. ``n_best``: links whose count is the highest of their B id,
    ties included; ``count_sum``: counts summed over links. With ``keep_groups`` also ``groups``: ``a1,a2|b1;a3|b2,b3``.

    Null and empty texts, and those whose bytes either tokenizer does not give back, have no tokens: zeros and ''. Repeated rows each
    give a row and count each time, null ids stay null, an empty table gives none; other columns are ignored.

    Only pieces, pairs and sums of them are shuffled: pairs once for each chunk of some ``chunk`` ends, so a pair that is in
    every text costs one row a chunk, and pieces by chunk, which are all of a size. The one table that is broadcast has a row for each id
    of B. Only the pieces of texts with more than one meet again, to be stitched.
    """
    with open(a, encoding="utf-8") as f, open(b, "rb") as g:
        spec, model = f.read(), g.read()  # two vocabulary files: their size is fixed and does not depend on the data
    v = vocabularies(spec, model)
    length = v.sizes
    cut = written(pieces(docs, v, work=work, chunk=chunk, id_col=id_col, text_col=text_col))
    found = written(links(cut, length))
    counts = written(found.groupBy("pair").agg(F.sum("n").alias("total")).withColumn("b", F.col("pair").bitwiseAND((1 << 32) - 1)))
    highest = counts.groupBy("b").agg(F.max("total").alias("most"))
    counts = counts.join(F.broadcast(highest), "b").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))
    known = found.join(counts, "pair").select("chunk", "pair", "total", "best")
    parts = written(_measured(cut, known, length, id_col, keep_groups))
    columns = [id_col, *_SUMS, "groups_sha256", *(["groups"] if keep_groups else [])]
    return parts.where("pieces = 1").select(*columns).unionByName(_joined(parts, id_col, keep_groups).select(*columns))
