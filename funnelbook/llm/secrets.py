"""Secret scans: known forms by pattern, and a battery of randomness tests for strings of no known form.

A run of characters of some code alphabet (hexadecimal digits, base 32, letters and digits, base 64) is read in the smallest
alphabet that holds it. Three numbers describe it: chi-squared over the alphabet, changes between kinds of characters (runs),
and the correlation of neighbouring values. Each has a known distribution under two hypotheses:

* random: every character is drawn evenly. A string that one of the three tests rejects has structure and is no secret.
* ordinary: characters come as in words and numbers. The three p-values, how unlikely an ordinary string looks that random,
  are joined by Fisher's method.

Short strings are often as even as random ones, so what is reported is held to a false-discovery rate: among all
strings tested in a document by Benjamini and Hochberg, each p-value weighted with the string's length, as long strings carry the evidence.
A document is judged by itself, whatever else the table holds.
"""

from __future__ import annotations

import math
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices

# The known forms. Letters of the names count in either case, ASCII only.
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
ASSIGNED = 6
KINDS = ("assign", "access", "hex", "random")
_NAMES = ("passw", "secret", "token", "api")

#: Characters of a tested string at least.
SHORTEST = 16
#: Level at which the battery finds structure, and share of false discoveries allowed.
STRUCTURE = 0.001
FALSE_SHARE = 0.01

# Shares of the letters a to z in English text, in percent.
LETTERS = (8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4, 6.7, 7.5, 1.9, 0.095, 6.0, 6.3, 9.1, 2.8, 0.98, 2.4, 0.15, 2.0, 0.074)
#: Shares of lower case, capitals, digits and signs in ordinary strings, and how often the kind changes from one character to the next.
SHARES = {"lower": 0.80, "upper": 0.10, "digit": 0.08, "sign": 0.02}
CHANGES = 0.12
#: The same for strings of letters of one case, whose kinds are vowels and consonants.
VOWEL_CHANGES = 0.62

_LOWER, _UPPER, _DIGIT = string.ascii_lowercase, string.ascii_uppercase, string.digits
#: Code alphabets in the order of their values, smaller ones first. Digits alone are a number and not tested.
ALPHABETS = {
    "hex": _DIGIT + "abcdef", "HEX": _DIGIT + "ABCDEF", "lower": _LOWER, "UPPER": _UPPER, "base32": _UPPER + "234567", "base36": _DIGIT + _LOWER,
    "BASE36": _DIGIT + _UPPER, "base62": _UPPER + _LOWER + _DIGIT, "base64": _UPPER + _LOWER + _DIGIT + "+/", "base64url": _UPPER + _LOWER + _DIGIT + "-_",
}
_RUN = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{SHORTEST},}}")


def _kind(c: str) -> str:
    return "lower" if c in _LOWER else "upper" if c in _UPPER else "digit" if c in _DIGIT else "sign"


@dataclass(frozen=True)
class Encoding:
    """An alphabet and what the two hypotheses expect of its strings."""

    name: str
    code: np.ndarray  # value of each ASCII character, 255 for none
    size: int
    kinds: np.ndarray  # kind of each value
    even_change: float  # chance that the kind changes, if characters are even
    change: float  # the same in ordinary strings
    squares: float  # sums of squares and cubes of the shares in ordinary strings
    cubes: float
    tie: float  # mean and spread of the product of two neighbouring values in ordinary strings, in units of an even one's variance
    tie_spread: float


@cache
def encoding(name: str) -> Encoding:
    alphabet = ALPHABETS[name]
    k = len(alphabet)
    groups = [_kind(c) for c in alphabet]
    one_case = len(set(groups)) == 1
    share = {"lower": dict(zip(_LOWER, LETTERS)), "upper": dict(zip(_UPPER, LETTERS)), "digit": dict.fromkeys(_DIGIT, 1.0), "sign": dict.fromkeys("+/-_", 1.0)}
    total = {g: sum(share[g][c] for c, h in zip(alphabet, groups) if h == g) for g in set(groups)}
    weight = np.array([SHARES[g] * share[g][c] / total[g] for c, g in zip(alphabet, groups)])
    weight /= weight.sum()
    labels = ["vowel" if c in "aeiouAEIOU" else "consonant" for c in alphabet] if one_case else groups
    kinds = np.unique(labels, return_inverse=True)[1]
    parts = np.bincount(kinds) / k
    change = VOWEL_CHANGES if one_case else CHANGES
    value = (np.arange(k) - (k - 1) / 2) / math.sqrt((k * k - 1) / 12)
    in_kind = np.bincount(kinds, weights=weight)
    means = np.bincount(kinds, weights=weight * value) / in_kind
    others = (np.dot(in_kind, means) - in_kind * means) / (1 - in_kind)  # mean of all other kinds
    tie = float(np.dot(in_kind, (1 - change) * means**2 + change * means * others))
    code = np.full(128, 255, dtype=np.uint8)
    code[[ord(c) for c in alphabet]] = np.arange(k)
    return Encoding(
        name, code, k, kinds, float(1 - np.sum(parts**2)), change, float(np.sum(weight**2)), float(np.sum(weight**3)), tie, float(np.dot(weight, value**2))
    )


def inferred(text: str) -> str | None:
    """The first alphabet that holds every character; None for digits alone and for strings of no alphabet."""
    held = set(text)
    if held <= set(_DIGIT):
        return None
    return next((n for n, a in ALPHABETS.items() if held <= set(a)), None)


def _below(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2))


def _tail(share: float, expected: float, n: int) -> float:
    """Chernoff's bound on the chance of a share at least as far on this side of the expected one, of n draws."""
    gain = sum(a * math.log(a / b) for a, b in ((share, expected), (1 - share, 1 - expected)) if a > 0)
    return math.exp(-n * gain)


@dataclass(frozen=True)
class Battery:
    """p-values of the three tests under both hypotheses: chi-squared, runs, serial correlation."""

    random: tuple[float, float, float]
    ordinary: tuple[float, float, float]

    @property
    def structure(self) -> float:
        """Chance that a random string fails some test that badly (Bonferroni)."""
        return min(1.0, 3 * min(self.random))

    @property
    def evidence(self) -> float:
        """Fisher's joint p-value of the ordinary hypothesis: chi-squared with six degrees of freedom."""
        half = -sum(math.log(max(p, 1e-300)) for p in self.ordinary)
        return math.exp(-half) * (1 + half + half * half / 2)


def tested(text: str, name: str) -> Battery:
    e, n = encoding(name), len(text)
    value = e.code[np.frombuffer(text.encode("ascii"), dtype=np.uint8)]
    chi = max(0.0, e.size / n * float(np.sum(np.bincount(value, minlength=e.size).astype(float) ** 2)) - n)
    mean, spread = e.size - 1.0, 2 * (e.size - 1) * (n - 1) / n
    shape = mean * mean / spread  # a gamma distribution with the exact mean and variance, by Wilson and Hilferty
    z = ((chi / mean) ** (1 / 3) - 1 + 1 / (9 * shape)) * 3 * math.sqrt(shape)
    chi_random = 2 * min(_below(z), _below(-z))
    pairs = e.size * (n - 1)
    chance_spread = (4 * (n - 2) * max(e.cubes - e.squares**2, 0) + 2 * (e.squares - e.squares**2)) / (n * (n - 1))
    chi_ordinary = _below((chi - (e.size + pairs * e.squares - n)) / (pairs * math.sqrt(chance_spread)))

    kinds = e.kinds[value]
    changes = float(np.count_nonzero(kinds[1:] != kinds[:-1])) / (n - 1)
    runs_random = min(1.0, 2 * _tail(changes, e.even_change, n - 1))
    toward = (changes > e.change) == (e.even_change > e.change)
    runs_ordinary = _tail(changes, e.change, n - 1) if toward else 1.0

    x = (value - (e.size - 1) / 2) / math.sqrt((e.size**2 - 1) / 12)
    tie = float(np.dot(x[1:], x[:-1]))
    serial_random = 2 * _below(-abs(tie) / math.sqrt(n - 1))
    z = (tie - (n - 1) * e.tie) / (e.tie_spread * math.sqrt(n - 1))
    serial_ordinary = _below(z if e.tie > 0 else -z)
    return Battery((chi_random, runs_random, serial_random), (chi_ordinary, runs_ordinary, serial_ordinary))


def discoveries(found: list[tuple[int, float]], share: float = FALSE_SHARE) -> list[bool]:
    """Which of the (length, p-value) are discoveries: Benjamini and Hochberg with weights in proportion to the lengths."""
    if not found:
        return []
    length, p = np.array([n for n, _ in found], dtype=float), np.array([p for _, p in found])
    weighted = p * length.mean() / length
    order = np.sort(weighted)
    good = np.flatnonzero(order <= share * np.arange(1, len(order) + 1) / len(order))
    return (weighted <= order[good[-1]]).tolist() if len(good) else [False] * len(found)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind in ``KINDS``, end) of the known forms, in code points."""
    spans = []
    small = text.lower()
    if any(name in small for name in _NAMES):
        spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= ASSIGNED]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def random_spans(text: str, base: list[tuple[int, int, int]], *, structure: float = STRUCTURE, share: float = FALSE_SHARE) -> list[tuple[int, int, int, float]]:
    """The same, with the joined p-value, of strings outside the known forms that the battery and the control let through."""
    tests, places = [], []
    at, reach = 0, 0
    for m in _RUN.finditer(text):
        while at < len(base) and base[at][0] <= m.start():
            reach, at = max(reach, base[at][2]), at + 1
        if m.end() <= reach or (name := inferred(m[0])) is None:
            continue
        tests.append(tested(m[0], name))
        places.append((m.start(), m.end()))
    taken = discoveries([(b - a, t.evidence) for (a, b), t in zip(places, tests)], share)
    return [(a, 3, b, t.evidence) for (a, b), t, good in zip(places, tests, taken) if good and t.structure >= structure]


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64()), ("text", pa.string())])


def scan(
    docs: DataFrame, *, structure: float = STRUCTURE, share: float = FALSE_SHARE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Id and ``spans`` of every row: ``kind``, ``start``, ``end`` (code points, end exclusive), ``p`` and ``text``, by start, then kind.

    Kinds are ``assign``, ``access``, ``hex`` (known forms, ``p`` null) and ``random``. The matches of one known form do not
    overlap; those of different forms may. A random string inside a known form is not reported again.

    Null and empty texts have no spans. Repeated rows each give a row, null ids stay null, an empty table gives none; other columns
    are ignored. Texts are scanned whole in one pass; no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 512):
            rows = []
            for text in batch.column(1).to_pylist():
                text = text or ""
                base = base_spans(text)
                more = random_spans(text, base, structure=structure, share=share)
                every = sorted([*((*b, None) for b in base), *more], key=lambda s: s[:3])
                rows.append([{"kind": KINDS[k], "start": a, "end": b, "p": p, "text": text[a:b]} for a, k, b, p in every])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(_SPAN))], names=[id_col, "spans"])

    kept = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    kind = "array<struct<kind:string,start:long,end:long,p:double,text:string>>"
    return kept.mapInArrow(run, f"`{id_col}` {dict(kept.dtypes)[id_col]}, spans {kind}")


def digest(found: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """Counts of the known forms, a digest of their places, and the places of all spans as text."""

    def places(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(id_col, *map(count, KINDS), F.sha2(places(base), 256).alias("base_sha256"), places(F.col("spans")).alias("spans"))
