"""Token alignment, fill-in-the-middle and secret scans against brute force, and edge cases."""

import hashlib
import random
import re

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from test_text_operators import ODD, docs_of
from tokenizers import Tokenizer

from funnelbook.llm import alignment, fill_middle, secrets
from funnelbook.llm.common import table

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SPECIAL = ["<|endoftext|>", "<s> </s> <unk> <0x41>", "a\n\nb  c \t d", "　x y\x1cz \x85 w", "don't we'll", "x" * 300 + " " + "é" * 50, " ", "\n"]


@pytest.fixture(scope="module")
def texts(spark, sf):
    rows = [(r[0], r[1]) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    return rows + [(10**6 + k, t) for k, t in enumerate([*ODD, *SPECIAL])] + [(None, "a null id"), (None, None), (10**6 + 7, "one two")]


def frame_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", 0.5) for i, t in rows], "doc_id long, text string, row int, groups string, chunk double")


def brute_alignment(rows):
    a, b = Tokenizer.from_file(BYTES), SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in printable} | {chr(256 + k): x for k, x in enumerate(sorted({*range(256)} - {*printable}))}
    docs, counts = [], {}
    for _, t in rows:
        code = a.encode(" " + (t or ""), add_special_tokens=False)
        ids = code.ids, b.encode(t or "")
        raw = [[bytes(byte[c] for c in x) for x in code.tokens], [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids[1] for p in [b.id_to_piece(i)]]]
        if not t or any(b"".join(r) != b" " + t.encode() for r in raw):
            ids, raw = ([], []), ([], [])
        at = [[0], [0]]
        for side, r in zip(at, raw):
            for x in r:
                side.append(side[-1] + len(x))
        found, groups, i, j = [], [[[], []]] if raw[0] else [], 0, 0
        while i < len(raw[0]):  # the walk that the pieces do not take
            found.append((ids[0][i], ids[1][j]))
            x, y = at[0][i + 1], at[1][j + 1]
            if x <= y:
                groups[-1][0].append(str(ids[0][i]))
                i += 1
            if y <= x:
                groups[-1][1].append(str(ids[1][j]))
                j += 1
            if x == y and i < len(raw[0]):
                groups.append([[], []])
        docs.append((ids, found, ";".join(",".join(g) + "|" + ",".join(h) for g, h in groups)))
        for pair in found:
            counts[pair] = counts.get(pair, 0) + 1
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    return sorted(
        (str(d), len(ids[0]), len(ids[1]), len(g.split(";")) if g else 0, len(f), sum(counts[p] == best[p[1]] for p in f), sum(counts[p] for p in f), hashlib.sha256(g.encode()).hexdigest() if g else "", g)
        for (d, _), (ids, f, g) in zip(rows, docs)
    )


@pytest.mark.parametrize("work, chunk", [(alignment.PIECE, alignment.CHUNK), (5, 300)])
def test_alignment(spark, texts, monkeypatch, work, chunk):
    monkeypatch.setattr(alignment, "LOT", 100 if work == 5 else alignment.LOT)
    rows = texts if work > 5 else texts[:30] + texts[-25:]
    got = alignment.align(frame_of(spark, rows), BYTES, PIECES, work=work, chunk=chunk, keep_groups=True)
    order = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]
    assert sorted((str(r["doc_id"]), *(r[c] for c in order[1:])) for r in got.collect()) == brute_alignment(rows)


def test_alignment_of_nothing(spark):
    assert alignment.align(frame_of(spark, []), BYTES, PIECES).count() == 0
    got = alignment.align(frame_of(spark, [(1, None), (2, ""), (2, "")]), BYTES, PIECES).collect()
    assert [tuple(r)[1:] for r in got] == [(0, 0, 0, 0, 0, 0, "")] * 3


def test_diagonals_cut_any_merge():
    rng = random.Random(6)
    for _ in range(300):
        import numpy as np

        a, b = (np.array(sorted(rng.sample(range(1, 40), rng.randint(0, 15)))) for _ in range(2))
        merged = sorted([(x, 0) for x in a.tolist()] + [(x, 1) for x in b.tolist()])
        for d in range(len(merged) + 1):
            assert alignment.diagonal(a, b, d) == sum(1 for _, side in merged[:d] if not side)
        work = rng.randint(1, 9)
        cuts = alignment.cut_pieces(a, b, work)
        assert all(j - i + n - m == work for i, j, m, n in cuts[:-1])


def brute_middle(i, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    h = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    return (n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("size", [fill_middle.FRAME, 7])
def test_fill_middle(spark, texts, size):
    rng = random.Random(7)
    marks = ["".join(rng.choice(["a", "bc", "é", "日", " ", "<", "P", ">", "<P", "<S>", "𝕏", "\n"]) for _ in range(rng.randint(0, 30))) for _ in range(200)]
    rows = [r for r in texts if size > 7 or len(r[1] or "") < 3000] + list(enumerate(marks, 2 * 10**6))
    made = fill_middle.arrange(fill_middle.store(frame_of(spark, rows), size=size), size=size)
    want = sorted((str(i), *brute_middle(i, t)) for i, t in rows)
    out = fill_middle.texts(made).collect()
    assert sorted((str(r["doc_id"]), r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in out) == want
    back = fill_middle.restore(made).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in back) == sorted((str(i), t or "") for i, t in rows)
    code = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = fill_middle.digests(made).collect()
    assert sorted((str(r["doc_id"]), r["output_sha256"], r["restored_sha256"]) for r in got) == sorted((str(i), code(brute_middle(i, t)[4]), code(t or "")) for i, t in rows)
    assert fill_middle.measure(frame_of(spark, [])).count() == 0


def test_cuts_open_only_their_frames():
    text = ("word é " * 5000).encode()
    frames, units, chars = fill_middle.frames_of(text, 1000)
    stored = fill_middle.Frames(frames, len(text), units, chars)
    opened = []
    read = stored.data
    stored.data = lambda k: opened.append(k) or read(k)
    place, before = stored.cut(units // 2 + 7)
    assert len(opened) == 1 and text[:place].decode() == ("word é " * 5000)[:before]
    parts = list(stored.parts(place, len(text)))
    assert set(opened) == {opened[0]} and sum(f is not None for f, _ in parts) == len(frames) - 1 - opened[0]


def brute_base(text):
    kinds = [r"""(?:PASS)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", r"AKIA[A-Z0-9]+", r"[0-9a-f]+"]
    either = lambda w: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
    kinds[0] = kinds[0].replace("PASS", "|".join([*map(either, ("password", "passwd", "secret", "token")), either("api") + "_?" + either("key")]))
    out = []
    for k, (pattern, least) in enumerate(zip(kinds, (6, 20, 24))):
        for m in re.finditer(pattern, text):
            if len(m[1] if k == 0 else m[0]) >= least:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_secrets(spark, texts):
    rng = random.Random(8)
    code = lambda a, n: "".join(rng.choice(a) for _ in range(n))
    parts = ["password", "SECRET", "toKen", "toKen", "ſecret", "api_key", "ApiKey", "=", ":", " = ", '"', "'", "abc", "abcdefgh", "AKIA", "AKIAABCD", "é", " ", "\n", "0123456789abcdef", "X" * 9]
    rows = texts + [(3 * 10**6 + k, "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))) for k in range(400)]
    got = secrets.scan(frame_of(spark, rows)).collect()
    want = sorted((str(i), [(secrets.KINDS[k], a, b, (t or "")[a:b]) for a, k, b in brute_base(t or "")]) for i, t in rows)
    base = lambda r: [(s["kind"], s["start"], s["end"], s["text"]) for s in r["spans"] if s["kind"] != "random"]
    assert sorted((str(r["doc_id"]), base(r)) for r in got) == want
    flat = {str(r["doc_id"]): r for r in secrets.digest(secrets.scan(frame_of(spark, rows))).collect()}
    for r in got:
        order = [(s["start"], secrets.KINDS.index(s["kind"])) for s in r["spans"]]
        assert order == sorted(order)
        if r["doc_id"] is not None and r["doc_id"] != 10**6 + 7:
            d = flat[str(r["doc_id"])]
            places = ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in r["spans"] if s["kind"] != "random")
            assert d["base_sha256"] == hashlib.sha256(places.encode()).hexdigest()
            assert d["n_assign"] + d["n_access"] + d["n_hex"] == len([s for s in r["spans"] if s["kind"] != "random"])
    assert secrets.scan(frame_of(spark, [])).count() == 0


def test_randomness_battery(spark):
    rng = random.Random(9)
    keys = ["".join(rng.choice(secrets.ALPHABETS[name]) for _ in range(n)) for name in ("base64", "base62", "base64url", "HEX") for n in (32, 40, 64) for _ in range(12)]
    plain = ["internationalisation", "some-long-title-of-a-page-with-words", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "n" * 28, "src/main/java/org/example/Application", "Donaudampfschifffahrtsgesellschaft", "getElementsByClassNameAndTag", "4111111111111111111", "abcdefghijklmnopqrstuvwxyz0123456789", "x" * 100_000]
    docs = docs_of(spark, [f"see {k} here" for k in keys + plain])
    found = [[s["text"] for s in r["spans"]] for r in secrets.scan(docs).orderBy("doc_id").collect()]
    assert sum(f == [k] for f, k in zip(found, keys)) >= 0.95 * len(keys)
    assert found[len(keys) :] == [[]] * len(plain)
    # among many ordinary strings a discovery needs more evidence, and a long one gets more weight than a short one
    assert secrets.discoveries([(20, 0.009)]) == [True] and secrets.discoveries([(20, 0.009)] + [(20, 0.5)] * 9) == [False] * 10
    assert secrets.discoveries([(60, 0.004), (20, 0.9)]) == [True, False] and secrets.discoveries([(20, 0.006), (60, 0.9)]) == [False, False]


def test_even_strings_pass_and_words_do_not():
    rng = random.Random(10)
    some = "the people will often find another place where water runs under old trees and children play near their house before supper every summer evening".split()
    words = lambda k: "".join(rng.choice(some) for _ in range(k))
    for name, alphabet in secrets.ALPHABETS.items():
        drawn = ["".join(rng.choice(alphabet) for _ in range(40)) for _ in range(400)]
        tested = [secrets.tested(t, name) for t in drawn]
        assert sum(t.structure < secrets.STRUCTURE for t in tested) <= 4
    ordinary = [secrets.tested(words(5), "lower").evidence for _ in range(1000)]
    assert sum(p <= 0.01 for p in ordinary) <= 20
