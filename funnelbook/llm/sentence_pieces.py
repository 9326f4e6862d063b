"""SentencePiece encoding and decoding as a shortest path through a weighted finite-state transducer.

The transducer for one input is the composition of three parts. The normaliser puts one space in front and writes
spaces as U+2581. The piece transducer reads characters and writes piece ids; its states are the pieces written last, and an
arc from piece a to piece b has weight 0 if byte-pair merging of the joined text gives exactly (a, b), else infinity. The
byte fallback reads a character that is in no piece and writes its UTF-8 bytes as pieces, weight 0. A sequence of pieces is
the one that merging yields exactly if all neighbours agree, so in the tropical semiring (min, +) one path has a
finite weight: the encoding. Weights by piece score alone would give the best unigram path, which for a model trained
by merging is a different segmentation.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from .common import slices

SPACE = "▁"
#: States without a piece: anything may follow, or no path leads here.
_FREE, _NONE = -1, -2
_SHORT = (2, 1)
#: Encoded strings that a task remembers at most; beyond it forgets all and goes on.
REMEMBERED = 300_000
PAIRS = 1_000_000
LONG = 64
#: Texts whose words are looked up together.
ROWS = 1024


class Transducer:
    """Pieces, byte fallback and normaliser of one merging model."""

    def __init__(self, model: bytes):
        own = SentencePieceProcessor(model_proto=model)
        self.size = own.get_piece_size()
        if own.normalize(" a  b ") != f"{SPACE}{SPACE}a{SPACE}{SPACE}b{SPACE}":
            raise ValueError("only models with a dummy prefix and no further normalisation can be compiled")
        self.text = [own.id_to_piece(i) for i in range(self.size)]
        self.bytes = {int(self.text[i][3:5], 16): i for i in range(self.size) if own.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.silent = {i for i in range(self.size) if own.is_control(i) or own.is_unknown(i)}
        usable = [i for i in range(self.size) if i not in self.silent and i not in self.byte_of and not own.is_unused(i)]
        self.id = {self.text[i]: i for i in usable}
        self.score = {self.text[i]: own.get_score(i) for i in usable}
        self.longest = max(map(len, self.id))
        if any(SPACE in p.lstrip(SPACE) for p in self.id) or len(self.bytes) != 256:
            raise ValueError("pieces must hold the space at their start only, and every byte must be a piece")
        # states: the pieces that merging yields from their own characters
        self.steps: dict[int, tuple[list[float], list[str], list[str]]] = {}
        for p, i in self.id.items():
            parts, scores, firsts, lasts = self._merge(p)
            if len(parts) == 1:
                self.steps[i] = ([*scores, float("-inf")], firsts, lasts)
        self.state = {p: i for p, i in self.id.items() if i in self.steps}
        self.length = [len(t) for t in self.text]
        # lengths of the pieces that end in three given characters, the longest first; shorter ones are always tried
        ends: dict[str, set[int]] = {}
        for p in self.state:
            ends.setdefault(p[-3:], {1, 2}).add(len(p))
        self.lengths = {tail: tuple(sorted(n, reverse=True)) for tail, n in ends.items() if len(tail) == 3}
        self.agrees: dict[int, bool] = {}
        self.code = [np.int32(i).tobytes() for i in range(self.size)]
        self.words: dict[str, bytes] = {}
        self.plain = [chr(self.byte_of[i]) if i in self.byte_of else "" if i in self.silent else self.text[i].replace(SPACE, " ") for i in range(self.size)]
        self.decimal = [str(i) for i in range(self.size)]
        self.is_byte = np.array([i in self.byte_of for i in range(self.size)])
        self.high = np.array([self.byte_of.get(i, 0) > 127 for i in range(self.size)])

    def _merge(self, text: str) -> tuple[list[str], list[float], list[str], list[str]]:
        """Byte-pair merging by definition: the best-scored neighbouring pair first, the leftmost of equals. Gives the
        parts, the score of each step, and the first and last part before each step and at the end."""
        parts, scores, firsts, lasts = list(text), [], [text[0]], [text[-1]]
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = self.score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                return parts, scores, firsts, lasts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            scores.append(best)
            firsts.append(parts[0])
            lasts.append(parts[-1])

    def _agree(self, a: int, b: int) -> bool:
        """Weight of the arc from a to b, finite or not: whether the steps that make a and b go through before any pair
        across their border is the best."""
        (own, _, ends), (other, starts, _) = self.steps[a], self.steps[b]
        i = j = 0
        while True:
            left, right = own[i], other[j]
            across = self.score.get(ends[i] + starts[j])
            if across is not None and across > left and across >= right:
                good = False
                break
            if left == right == float("-inf"):
                good = True
                break
            if left >= right:
                i += 1
            else:
                j += 1
        if len(self.agrees) >= PAIRS:
            self.agrees.clear()
        self.agrees[a * self.size + b] = good
        return good

    def learn(self, texts: set[str]) -> dict[str, bytes]:
        """Shortest path for each normalised text, its ids as 32-bit numbers.

        One pass over the positions: merging is unique, so of all pieces that end at a position exactly one is reached
        with a finite weight, and that one is the state kept there. It depends on what stands before only, so in sorted
        order each text goes on from the states that it shares with the text before it.
        """
        made: dict[str, bytes] = {}
        ends: list[int] = [_FREE]
        before = ""
        agrees, state, lengths, size, code = self.agrees, self.state, self.lengths, self.size, self.code
        for text in sorted(texts):
            same, most = 0, min(len(before), len(text))
            while same < most and before[same] == text[same]:
                same += 1
            del ends[same + 1 :]
            before = text
            for at in range(same + 1, len(text) + 1):
                for n in lengths.get(text[at - 3 : at], _SHORT) if at > 2 else _SHORT[2 - at :]:
                    if n > at or (piece := state.get(text[at - n : at])) is None or (last := ends[at - n]) == _NONE:
                        continue
                    if last == _FREE:
                        break
                    ok = agrees.get(last * size + piece)
                    if ok or ok is None and self._agree(last, piece):
                        break
                else:
                    # a character of no piece goes to byte fallback, next to which nothing merges
                    ends.append(_FREE if text[at - 1] not in self.id else _NONE)
                    continue
                ends.append(piece)
            out, at = [], len(text)
            while at:
                piece = ends[at]
                out.append(code[piece] if piece >= 0 else self._fallback(text[at - 1]))
                at -= self.length[piece] if piece >= 0 else 1
            out.reverse()
            made[text] = b"".join(out)
        return made

    def _fallback(self, character: str) -> bytes:
        return np.array([self.bytes[b] for b in character.encode()], dtype=np.int32).tobytes()

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text. No piece runs across the border of a word, so the paths of the words join to the path of the text."""
        split = [_words(t) for t in texts]
        words = self.words
        new = set(itertools.chain.from_iterable(split)).difference(words)
        if len(words) + len(new) > REMEMBERED:
            self.words = words = {w: words[w] for w in {w for t in split for w in t} if w in words}
        words.update(self.learn(new))
        made = [np.frombuffer(b"".join(map(words.__getitem__, t)), dtype=np.int32) for t in split]
        for w in [w for w in new if len(w) > LONG]:
            del words[w]
        return made

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids: np.ndarray) -> str:
        """The inverse transducer: pieces to characters, runs of byte pieces to UTF-8, the space in front taken off."""
        numbers = ids.tolist()
        if not len(ids) or not self.high[ids].any():
            text = "".join(map(self.plain.__getitem__, numbers))
        else:
            raw = (bytes([self.byte_of[i]]) if i in self.byte_of else self.plain[i].encode() for i in numbers)
            text = b"".join(raw).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def _words(text: str | None) -> list[str]:
    """Normalise and cut before spaces; a run of spaces stays with the word after it."""
    if not text:
        return []
    if "  " in text or SPACE in text or text[0] == " " or text[-1] == " ":
        return _RUNS.findall(SPACE + text.replace(" ", SPACE))
    return (SPACE + text.replace(" ", f" {SPACE}")).split(" ")


_RUNS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_COMPILED: dict[str, Transducer] = {}


def transducer(model: bytes) -> Transducer:
    """One compiled transducer for each worker process; what it has learnt serves the next task too."""
    key = hashlib.sha256(model).hexdigest()
    if key not in _COMPILED:
        _COMPILED.clear()
        _COMPILED[key] = Transducer(model)
    return _COMPILED[key]


def _model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()  # one model file: its size is fixed and does not depend on the data


def _back(fst: Transducer, text: str | None, ids: np.ndarray) -> bool:
    """Whether decoding gives the text back; U+2581 in it counts as a space."""
    return fst.decode(ids) == (text or "").replace(SPACE, " ")


def encode(docs: DataFrame, model: str, *, text_col: str = "text", into: str = "ids", check: str | None = None) -> DataFrame:
    """All columns of ``docs`` and the piece ids of each whole text in ``into``, in one pass and without a shuffle.

    ``check`` names a further column: whether decoding gives the text back. A column that has one of these names already is replaced.
    Null and empty texts give an empty list. U+2581 in a text counts as a space. Repeated rows each give a row, an
    empty table none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_model(model))
    added = {into: "array<int>"} | ({check: "boolean"} if check else {})
    kept = docs.select(*[c for c in docs.columns if c not in added], F.col(text_col).cast("string").alias("__text"))
    names = [*kept.columns[:-1], *added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = transducer(shared.value)
        for batch in slices(batches, ROWS):
            texts = batch.column(batch.num_columns - 1).to_pylist()
            codes = fst.encode_all(texts)
            ends = np.cumsum([0, *map(len, codes)], dtype=np.int32)
            new = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *codes])))]
            if check:
                new.append(pa.array([_back(fst, t, c) for t, c in zip(texts, codes)], pa.bool_()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *new], names=names)

    return kept.mapInArrow(run, _with(kept.drop("__text"), added))


def decode(coded: DataFrame, model: str, *, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """All columns of ``coded`` and the text of each list of piece ids in ``into``; null and empty lists give ''.

    A column ``into`` that exists already is replaced.
    """
    shared = coded.sparkSession.sparkContext.broadcast(_model(model))
    kept = coded.select(*[c for c in coded.columns if c != into], F.col(ids_col).alias("__ids"))
    names = [*kept.columns[:-1], into]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = transducer(shared.value)
        for batch in slices(batches, 256):
            ids = batch.column(batch.num_columns - 1)
            flat, at = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
            full = ids.is_valid().to_pylist()
            texts = pa.array([fst.decode(flat[a:b] if ok else flat[:0]) for a, b, ok in zip(at, at[1:], full)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], names=names)

    return kept.mapInArrow(run, _with(kept.drop("__ids"), {into: "string"}))


def _with(df: DataFrame, added: dict[str, str]):
    from pyspark.sql.types import StructType

    more = df.sparkSession.createDataFrame([], ", ".join(f"`{name}` {kind}" for name, kind in added.items())).schema
    return StructType([*df.schema.fields, *more.fields])


def digest(docs: DataFrame, model: str) -> DataFrame:
    """One row per document: tokens, byte-fallback tokens, digest of the ids, and whether decoding gives the text back.

    Ids are encoded, counted, hashed and decoded in one pass and never leave it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_model(model))
    kept = docs.select("doc_id", F.col("text").cast("string").alias("__text"))
    names = ["doc_id", "n_bytes", "n_tokens", "n_byte_tokens", "ids_sha256", "round_trip"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = transducer(shared.value)
        for batch in slices(batches, ROWS):
            texts = batch.column(1).to_pylist()
            codes = fst.encode_all(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len((t or "").encode()) for t in texts], pa.int64()),
                    pa.array(map(len, codes), pa.int64()),
                    pa.array([int(np.count_nonzero(fst.is_byte[c])) for c in codes], pa.int64()),
                    pa.array([hashlib.sha256(",".join(map(fst.decimal.__getitem__, c.tolist())).encode()).hexdigest() for c in codes], pa.string()),
                    pa.array([_back(fst, t, c) for t, c in zip(texts, codes)], pa.bool_()),
                ],
                names=names,
            )

    return kept.mapInArrow(run, f"doc_id {dict(kept.dtypes)['doc_id']}, n_bytes long, n_tokens long, n_byte_tokens long, ids_sha256 string, round_trip boolean")
