"""Fill-in-the-middle documents out of a store of seekable compressed frames.

A text is stored as zstandard frames that are independent of each other, each with the number of units, characters and bytes before
it. To cut a text after its k-th unit, the counts name one frame, and only that frame is decompressed. The output is again
a list of frames: those without a cut are taken over as they are, so its frames one after another are a valid zstandard
stream. Digests read the frames in order and hold one at a time.

A unit is a run of ASCII letters or any other character. A frame ends between two characters, perhaps inside a run of letters;
the run counts where it begins.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, slices, written

#: Bytes of text in a frame.
FRAME = 1 << 16
# What stands before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
#: Marks in the order of each form, and the part that follows each.
ORDER = {"psm": ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)), "spm": ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1))}

_LETTER, _INSIDE = 1, 2
#: Kind of a byte: letter, later byte of a character, or first byte of any other character.
_KIND = np.array([_LETTER if 65 <= b <= 90 or 97 <= b <= 122 else _INSIDE if 128 <= b < 192 else 0 for b in range(256)], dtype=np.uint8)
_FRAME = pa.struct([("units", pa.int64()), ("chars", pa.int64()), ("start", pa.int64()), ("goes_on", pa.bool_()), ("data", pa.binary())])
_FRAMES = "array<struct<units:long,chars:long,start:long,goes_on:boolean,data:binary>>"


def _unit_starts(data: bytes, goes_on: bool) -> tuple[np.ndarray, np.ndarray]:
    """(places where a unit begins, places where a character begins). ``goes_on``: a letter stands before the first byte."""
    kind = _KIND[np.frombuffer(data, dtype=np.uint8)]
    letter = kind == _LETTER
    begins = kind != _INSIDE
    first = begins.copy()
    first[1:] &= ~(letter[1:] & letter[:-1])
    if goes_on and len(letter) and letter[0]:
        first[0] = False
    return np.flatnonzero(first), np.flatnonzero(begins)


def frames_of(text: bytes, size: int = FRAME) -> tuple[list[dict], int, int]:
    """(frames with the counts before each, units, characters) of a whole UTF-8 text."""
    made, units, chars, at = [], 0, 0, 0
    compressor = zstandard.ZstdCompressor()
    while at < len(text):
        end = min(len(text), at + size)
        while end < len(text) and 128 <= text[end] < 192:
            end += 1
        data = text[at:end]
        goes_on = at > 0 and bool(_KIND[text[at - 1]] == _LETTER)
        starts, begins = _unit_starts(data, goes_on)
        made.append({"units": units, "chars": chars, "start": at, "goes_on": goes_on, "data": compressor.compress(data)})
        units, chars, at = units + len(starts), chars + len(begins), end
    return made, units, chars


class Frames:
    """One stored text. ``read`` and ``cut`` decompress only the frames that they need."""

    def __init__(self, frames: list[dict], n_bytes: int, n_units: int, n_chars: int):
        self.frames, self.size, self.n_units, self.n_chars = frames, n_bytes, n_units, n_chars
        self.units = [f["units"] for f in frames]
        self.starts = [f["start"] for f in frames]
        self._open = zstandard.ZstdDecompressor()
        self._last: tuple[int, bytes] = (-1, b"")

    def data(self, k: int) -> bytes:
        if self._last[0] != k:  # the frame read last stays, as both cuts and the parts beside them often share it
            self._last = k, self._open.decompress(self.frames[k]["data"])
        return self._last[1]

    def cut(self, units: int) -> tuple[int, int]:
        """(bytes, characters) before the unit with this number, counted from 0."""
        if units >= self.n_units:
            return self.size, self.n_chars
        k = bisect_right(self.units, units) - 1  # the last with so few units before it: the unit begins there
        f = self.frames[k]
        starts, begins = _unit_starts(self.data(k), f["goes_on"])
        place = int(starts[units - f["units"]])
        return f["start"] + place, f["chars"] + int(np.searchsorted(begins, place))

    def parts(self, a: int, b: int) -> Iterator[tuple[bytes | None, bytes]]:
        """Bytes ``a`` to ``b`` by frames in order: (the compressed frame, b'') of those inside, (None, the bytes) of those cut."""
        k = bisect_right(self.starts, a) - 1
        while a < b:
            end = self.starts[k + 1] if k + 1 < len(self.starts) else self.size
            if a == self.starts[k] and end <= b:
                yield self.frames[k]["data"], b""
            else:
                yield None, self.data(k)[a - self.starts[k] : min(b, end) - self.starts[k]]
            a, k = end, k + 1


class _Output:
    """Frames of an output: whole frames as they are, short stretches between them joined to frames of their own."""

    def __init__(self, size: int):
        self.size, self.frames, self.held, self.n = size, [], [], 0
        self._pack, self._open = zstandard.ZstdCompressor(), zstandard.ZstdDecompressor()

    def add(self, data: bytes) -> None:
        if data:
            self.held.append(data)
            self.n += len(data)
            if self.n >= self.size:
                self.end()

    def add_frame(self, frame: bytes) -> None:
        if 2 * zstandard.frame_content_size(frame) < self.size:
            self.add(self._open.decompress(frame))
        else:
            self.end()
            self.frames.append(frame)

    def end(self) -> list[bytes]:
        if self.held:
            self.frames.append(self._pack.compress(b"".join(self.held)))
            self.held, self.n = [], 0
        return self.frames


def _rearranged(text: Frames, form: str, cuts: tuple[int, int], size: int) -> list[bytes]:
    ends = (0, *cuts, text.size)
    out = _Output(size)
    for mark, part in ORDER.get(form, ((b"", None),)):
        out.add(mark)
        a, b = (0, text.size) if part is None else ends[part : part + 2]
        for frame, data in text.parts(a, b):
            out.add(data) if frame is None else out.add_frame(frame)
    return out.end()


def stream(frames: list[bytes]) -> Iterator[bytes]:
    """The bytes of each frame in order."""
    opened = zstandard.ZstdDecompressor()
    return (opened.decompress(f) for f in frames)


def restored(frames: list[bytes], form: str) -> Iterator[bytes]:
    """The text's bytes in its own order, from an output and its form alone.

    The text holds none of the marks, and no mark can arise across a border, as each begins with the only ``<`` and ends with the
    only ``>`` in it. So the first of each mark in the output is the one that was put there.
    """
    if form not in ORDER:
        yield from stream(frames)
        return
    at, tail, found = 0, b"", {}
    sizes = []
    for data in stream(frames):
        seen = tail + data  # a mark may lie across two frames
        for mark in MARKS:
            if mark not in found and (k := seen.find(mark)) >= 0:
                found[mark] = at - len(tail) + k
        at += len(data)
        sizes.append(len(data))
        tail = seen[-2:]
    places = [found[mark] for mark, _ in ORDER[form]] + [at]
    spans = {part: (a + len(mark), b) for (mark, part), a, b in zip(ORDER[form], places, places[1:])}
    starts = np.cumsum([0, *sizes]).tolist()
    whole = Frames([{"units": 0, "chars": 0, "start": s, "goes_on": False, "data": f} for s, f in zip(starts, frames)], at, 0, 0)
    opened = zstandard.ZstdDecompressor()
    for part in range(3):
        for frame, data in whole.parts(*spans[part]):
            yield data if frame is None else opened.decompress(frame)


def store(docs: DataFrame, *, size: int = FRAME, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``n_bytes``, ``n_units``, ``n_chars``, ``marked`` (the text holds a mark) and ``frames`` of every whole text.

    Null and empty texts have no frames. Repeated rows each give a row, null ids stay null, an empty table gives none. Other columns are
    ignored. A text of any length is a row as it was before, but smaller. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            texts = as_bytes(batch.column(1))
            made = [frames_of(t, size) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(map(len, texts), pa.int64()),
                    pa.array([m[1] for m in made], pa.int64()),
                    pa.array([m[2] for m in made], pa.int64()),
                    pa.array([any(mark in t for mark in MARKS) for t in texts], pa.bool_()),
                    pa.array([m[0] for m in made], pa.list_(_FRAME)),
                ],
                names=[id_col, "n_bytes", "n_units", "n_chars", "marked", "frames"],
            )

    kept = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    return kept.mapInArrow(run, f"`{id_col}` {dict(kept.dtypes)[id_col]}, n_bytes long, n_units long, n_chars long, marked boolean, frames {_FRAMES}")


def chosen(stored: DataFrame, *, seed: int = 1, share: int = 90, spm: int = 20, id_col: str = "doc_id") -> DataFrame:
    """Adds ``form`` and ``low`` and ``high``, the numbers of units before middle and suffix, drawn by the SHA-256 of seed and id.

    ``share`` of a hundred texts are rearranged, ``spm`` of a hundred of these with the suffix first. A null id draws like an
    empty one.
    """
    code = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)

    def h(k: int) -> Column:
        return F.conv(F.substring(code, 8 * k + 1, 8), 16, 10).cast("long")

    plain = (F.col("n_bytes") == 0) | F.col("marked") | (h(2) % 100 >= share)
    a, b = h(0) % (F.col("n_units") + 1), h(1) % (F.col("n_units") + 1)
    form = F.when(plain, "plain").when(h(3) % 100 < spm, "spm").otherwise("psm")
    return stored.withColumns({"form": form, "low": F.least(a, b), "high": F.greatest(a, b)})


def arrange(stored: DataFrame, *, seed: int = 1, share: int = 90, spm: int = 20, size: int = FRAME, id_col: str = "doc_id") -> DataFrame:
    """Id, ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` (null if plain) and ``output``, its zstandard frames in order.

    ``stored`` comes from ``store``. Each frame holds some ``size`` bytes of text; only frames with a cut, and small ones beside marks, are packed anew.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            forms, chars, outputs = batch.column(6).to_pylist(), [], []
            columns = [batch.column(k).to_pylist() for k in (1, 2, 3, 5, 7, 8)]
            for form, n_bytes, n_units, n_chars, frames, low, high in zip(forms, *columns):
                text = Frames(frames, n_bytes, n_units, n_chars)
                (a, p), (b, q) = ((0, 0), (0, 0)) if form == "plain" else (text.cut(low), text.cut(high))
                chars.append((None, None) if form == "plain" else (p, q - p))
                outputs.append(_rearranged(text, form, (a, b), size))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(2), batch.column(6),
                    pa.array([c[0] for c in chars], pa.int64()), pa.array([c[1] for c in chars], pa.int64()),
                    pa.array(outputs, pa.list_(pa.binary())),
                ],
                names=[id_col, "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    rows = chosen(stored, seed=seed, share=share, spm=spm, id_col=id_col).select(id_col, "n_bytes", "n_units", "n_chars", "marked", "frames", "form", "low", "high")
    return rows.mapInArrow(run, f"`{id_col}` {dict(rows.dtypes)[id_col]}, n long, form string, prefix_chars long, middle_chars long, output array<binary>")


def _over_frames(arranged: DataFrame, drop: tuple[str, ...], added: dict[str, tuple[str, pa.DataType]], make) -> DataFrame:
    """The columns but ``drop``, and those that ``make`` gives for the frames and form of each row."""
    rows = arranged.select(*[c for c in arranged.columns if c not in (*drop, *added)], F.col("form").alias("__form"), F.col("output").alias("__frames"))
    names = rows.columns[:-2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            made = [make(f or [], form) for f, form in zip(batch.column(len(names) + 1).to_pylist(), batch.column(len(names)).to_pylist())]
            new = [pa.array([m[k] for m in made], kind) for k, (_, kind) in enumerate(added.values())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *new], names=[*names, *added])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in names), *(f"`{c}` {k}" for c, (k, _) in added.items())]))


def digests(arranged: DataFrame) -> DataFrame:
    """``arranged`` without its frames, with ``output_sha256`` and ``restored_sha256``, one frame in memory at a time."""

    def code(parts: Iterator[bytes]) -> str:
        made = hashlib.sha256()
        for part in parts:
            made.update(part)
        return made.hexdigest()

    kinds = {c: ("string", pa.string()) for c in ("output_sha256", "restored_sha256")}
    return _over_frames(arranged, ("output",), kinds, lambda frames, form: (code(stream(frames)), code(restored(frames, form))))


def texts(arranged: DataFrame) -> DataFrame:
    """``arranged`` with the output as text in ``output``."""
    return _over_frames(arranged, ("output",), {"output": ("string", pa.string())}, lambda frames, form: (b"".join(stream(frames)).decode(),))


def restore(arranged: DataFrame) -> DataFrame:
    """``arranged`` with the text, rebuilt from output and form, in ``text`` in place of the output."""
    return _over_frames(arranged, ("output",), {"text": ("string", pa.string())}, lambda frames, form: (b"".join(restored(frames, form)).decode(),))


def measure(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store all texts once in the shared folder, rearrange them, and give counts and digests."""
    return digests(arrange(written(store(docs, id_col=id_col, text_col=text_col)), id_col=id_col))
