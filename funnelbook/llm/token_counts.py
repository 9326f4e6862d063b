"""Token counts by whole-token shortcut: strings proven to be one token are counted by lookup, the rest is merged."""

from __future__ import annotations

import itertools
import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import as_bytes, slices

#: Distinct strings whose count a task remembers at most; beyond it forgets all and goes on.
REMEMBERED = 400_000
#: Longer strings are left to the library whole.
LONG = 64
#: Characters below U+0250 lower and compose alike everywhere; separators other than ASCII white space are left to the library.
_RARE = regex.compile(r"[^\x00-\u024f]|[\x1c-\x1f\x85\xa0]")


def _plain(tokenizer: Tokenizer) -> Tokenizer:
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def whole_tokens(spec: str) -> frozenset[str]:
    """The vocabulary strings that the tokenizer, given the string alone, encodes as exactly that one token.

    Every entry that ends a word is decoded to its text and encoded by the library: what comes back as its own id is
    proven, anything else (entries no merge reaches, entries that normalise to something else) stays out.
    """
    tokenizer, end = _plain(Tokenizer.from_str(spec)), json.loads(spec)["model"]["end_of_word_suffix"] or ""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(sorted({*range(256)} - {*printable}))}
    texts: dict[str, int] = {}
    for piece, number in tokenizer.get_vocab(with_added_tokens=False).items():
        body = piece[: len(piece) - len(end)] if piece.endswith(end) else None
        if body and all(c in back for c in body):
            try:
                texts[bytes(back[c] for c in body).decode()] = number
            except UnicodeDecodeError:
                continue
    codes = tokenizer.encode_batch(list(texts), add_special_tokens=False)
    return frozenset(t for (t, number), c in zip(texts.items(), codes) if c.ids == [number])


class _Counts:
    """Tokens of each string between ASCII white space. No token spans white space, so the counts add up."""

    def __init__(self, spec: str, whole: frozenset[str], pattern: str):
        self.tokenizer, self.whole, self.pattern = _plain(Tokenizer.from_str(spec)), whole, regex.compile(pattern)
        self.markers = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.of: dict[bytes, int] = {}

    def _parts(self, text: str) -> list[str] | None:
        """Pre-tokens of a string, or None where only the library may cut it: markers, and characters whose
        normal form, lower case or class are not the same everywhere."""
        if _RARE.search(text) or any(m in text for m in self.markers):
            return None
        return self.pattern.findall(unicodedata.normalize("NFC", text).lower())

    def _learn(self, unknown: set[bytes]) -> dict[bytes, int]:
        """Count strings not seen yet: whole tokens by lookup, the rest merged in one call of the library."""
        made: dict[bytes, int] = {}
        rest: list[str] = []
        owner: list[bytes] = []
        alone: list[bytes] = []
        whole = self.whole
        for raw in unknown:
            text = raw.decode()
            if text in whole:
                made[raw] = 1
            elif len(raw) > LONG or (parts := self._parts(text)) is None:
                alone.append(raw)
            else:
                made[raw] = 0
                for part in parts:
                    if part in whole:
                        made[raw] += 1
                    else:
                        rest.append(part)
                        owner.append(raw)
        for at in range(0, len(rest), 4096):
            own = owner[at : at + 4096]
            for word in self.tokenizer.encode(" ".join(rest[at : at + 4096]), add_special_tokens=False).word_ids:
                made[own[word]] += 1
        for raw, code in zip(alone, self.tokenizer.encode_batch([r.decode() for r in alone], add_special_tokens=False)):
            made[raw] = len(code.ids)
        return made

    def count(self, texts: list[bytes]) -> list[int]:
        split = [t.split() for t in texts]
        new = self._learn(set(itertools.chain.from_iterable(split)).difference(self.of))
        if len(self.of) + len(new) > REMEMBERED:
            kept = {w for words in split for w in words if w in self.of}
            self.of = {w: self.of[w] for w in kept}
        self.of |= new
        one = self.of.__getitem__
        return [sum(map(one, words)) for words in split]


def count_tokens(docs: DataFrame, vocabulary: str, *, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) of each text, whole texts always.

    ``vocabulary`` is the path of a tokenizers file whose pre-tokens are lower-cased words, single digits and runs of
    signs, none of them with white space inside. Markers inside texts count as the library counts them by default; no
    marker is added, nothing is cut or padded.

    Null and empty texts have 0 bytes and 0 tokens. Repeated rows each give a row; ids may be null. An empty table gives
    no rows. Other columns are ignored. Counting needs no shuffle; a task remembers at most ``REMEMBERED`` strings.
    """
    with open(vocabulary, encoding="utf-8") as f:
        spec = f.read()  # one vocabulary file: its size is fixed and does not depend on the data
    split = json.loads(spec)["pre_tokenizer"]["pretokenizers"][0]
    if split["behavior"] != "Removed" or not split["invert"]:
        raise ValueError("the pre-tokenizer must keep the matches of its pattern")
    shared = docs.sparkSession.sparkContext.broadcast((spec, whole_tokens(spec), split["pattern"]["Regex"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(*shared.value)
        for batch in slices(batches, 512):
            texts = as_bytes(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(map(len, texts), pa.int64()),
                    pa.array(counts.count(texts), pa.int64()),
                ],
                names=[id_col, "n_bytes", "n_tokens"],
            )

    kept = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    out = kept.mapInArrow(run, f"`{id_col}` {dict(kept.dtypes)[id_col]}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
