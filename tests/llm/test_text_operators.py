"""Operators on texts against brute force, the libraries, and edge cases."""

import hashlib
import random
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from funnelbook.llm import bwt, decontaminate, licenses, quality, repeats, sentence_pieces, simhash, token_counts
from funnelbook.llm.common import table

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["  ▁ab e\n<s>日本𝕏öß", "", None, "'S's 12\t é <|endoftext|>x", " lead", "trail ", "a" * 5000, "one two", "one two"]


def docs_of(spark, texts):
    rows = [(i, t, "en", "src0", len(t or ""), "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, ids_ string")


@pytest.fixture(scope="module")
def docs(spark, sf):
    return table(spark, sf, "documents")


def test_token_counts_match_the_library(spark, docs):
    lib = Tokenizer.from_file(WORDS)
    both = docs.select("doc_id", "text").unionByName(docs_of(spark, ODD).selectExpr("doc_id + 1000000 AS doc_id", "text"))
    texts = {r[0]: r[1] or "" for r in both.collect()}
    for r in token_counts.count_tokens(both, WORDS).collect():
        n = len(lib.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 2048)


def test_pieces_match_the_library_and_come_back(spark, docs):
    lib = SentencePieceProcessor(model_file=PIECES)
    both = docs.select("doc_id", "text").unionByName(docs_of(spark, ODD).selectExpr("doc_id + 1000000 AS doc_id", "text"))
    for r in sentence_pieces.decode(sentence_pieces.encode(both, PIECES), PIECES).collect():
        assert r["ids"] == lib.encode(r["text"] or "")
        assert r["decoded"] == lib.decode(lib.encode(r["text"] or ""))


def brute_decontamination(texts, items, window=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    wins = [(i, tuple(w[k : k + window])) for i, t in items for w in [words(t)] if w for k in range(max(1, len(w) - window + 1))]
    out = []
    for t in texts:
        w, hit, ids = words(t), set(), set()
        for i, x in wins:
            for k in range(len(w) - len(x) + 1):
                if tuple(w[k : k + len(x)]) == x:
                    hit.update(range(k, k + len(x)))
                    ids.add(str(i))
        out.append((len(w), len(hit), sorted(ids)))
    return out


@pytest.mark.parametrize("size", [decontaminate.AUTOMATON_CHARS, 40])
def test_decontamination(spark, monkeypatch, size):
    monkeypatch.setattr(decontaminate, "AUTOMATON_CHARS", size)
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["Ab", "b,", "C.", "é"]) for _ in range(rng.randint(0, 40))) for _ in range(60)] + [None, "", "ab b", "x" * 3000]
    items = [(3, "ab B"), (10, " ".join(rng.choice(["ab", "b"]) for _ in range(12))), (2, None), (5, "é!c"), (5, "é!c"), (7, "...")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of(spark, texts)
    got = {r["doc_id"]: r for r in decontaminate.decontaminate(docs, bench, window=4).collect()}
    want = brute_decontamination(texts, items, 4)
    for i, (n, hit, ids) in enumerate(want):
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["items"]) == (n, hit, ids), texts[i]
        covered = " ".join(texts[i][s["start"] : s["end"]] for s in got[i]["spans"]) if ids else ""
        assert len(decontaminate.WORD.findall(covered)) == hit
    clean = {r["doc_id"] for r in decontaminate.keep_clean(docs, bench, window=4).collect()}
    assert clean == {i for i, (_, hit, _) in enumerate(want) if not hit}
    assert decontaminate.decontaminate(docs.limit(0), bench).count() == 0
    assert decontaminate.decontaminate(docs, bench.limit(0)).where("contaminated").count() == 0


def test_interleaved_transforms_find_all_repeats():
    rng = random.Random(5)
    for _ in range(60):
        texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(1, 12))]
        depth = rng.choice([1, 3, 8])
        got, want = {}, {}
        for s, o, i in zip(*(x.tolist() for x in bwt.repeated(texts, depth, rng.choice([5, 20, 1000])))):
            got.setdefault(i, set()).add((s, o))
        for s, t in enumerate(texts):
            for o in range(len(t) - depth + 1):
                want.setdefault(t[o : o + depth], set()).add((s, o))
        assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def brute_repeats(rows, length=100):
    seen, out = set(), {}
    for d, t in sorted(rows):
        x = (t or "").encode()
        covered = bytearray(len(x))
        for p in range(len(x) - length + 1):
            w = x[p : p + length]
            if w in seen:
                covered[p : p + length] = b"\1" * length
            seen.add(w)
        kept = bytes(b for b, c in zip(x, covered) if not c)
        runs = sum(1 for i, c in enumerate(covered) if c and not (i and covered[i - 1]))
        out[d] = (len(x), len(x) - len(kept), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("pieces", [repeats.PIECES, 2])
def test_repeats(spark, docs, monkeypatch, pieces):
    monkeypatch.setattr(repeats, "PIECES", pieces)  # the split of hot anchors gives the same
    rng = random.Random(2)
    line = "".join(rng.choice("abcdefgh ") for _ in range(130))
    more = [line, line + "x" + line, "ab" * 300, "é" * 200, None, "", "short", line[:100], line[1:101] + "é"]
    more += ["".join(rng.choice("xyz ") for _ in range(rng.randint(0, 90))) + line + str(k) * 20 for k in range(12)]
    rows = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()] + [(10**6 + i, t) for i, t in enumerate(more)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in repeats.measure(frame).collect()}
    assert got == brute_repeats(rows)


def test_repeats_edges(spark):
    assert repeats.measure(docs_of(spark, [])).count() == 0
    twice = docs_of(spark, ["q w e r t y u i o p " * 30]).unionByName(docs_of(spark, ["q w e r t y u i o p " * 30]))
    assert repeats.measure(twice).count() == 2
    kept = repeats.remove(docs_of(spark, ["é" * 100, None])).orderBy("doc_id").collect()
    assert kept[1]["text"] is None and kept[0]["ids_"] == "clash" and set(kept[0]["text"]) == {"é"}


def test_simhash_components(spark, docs):
    texts = docs.select("doc_id", "text").unionByName(docs_of(spark, ["", None, "one", "one two"]).selectExpr("doc_id + 1000000 AS doc_id", "text"))
    rows = [(r[0], simhash.fingerprint((r[1] or "").encode())) for r in texts.collect()]
    parent = {d: d for d, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(rows):
        for b, y in rows[:i]:
            if (x ^ y).bit_count() <= 4:
                p, q = sorted((find(a), find(b)))
                parent[q] = p
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(texts).collect()}
    assert got == {d: (f"{x:016x}", find(d)) for d, x in rows}
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_links_lose_no_pair(spark):
    rng = random.Random(3)
    base = rng.getrandbits(64)
    prints = {base} | {base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))) for _ in range(300)}
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    got = {frozenset(r) for r in simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()}
    assert got == {frozenset((a, b)) for a in signed for b in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 4}


def test_quality_holds_out(spark, docs, sf):
    labels = table(spark, sf, "labels")
    judged = quality.judge(docs, labels)
    assert judged.count() == docs.count()
    worst = {r[0]: r[1] == 0 or r[2] == 1 for r in labels.collect()}
    got = {r["doc_id"]: r["rejected"] for r in judged.collect() if r["doc_id"] in worst}
    assert sum(got[d] == worst[d] for d in got) >= 0.95 * len(got)
    none = quality.judge(docs_of(spark, ["", None, "a b"]), labels.limit(0))
    assert none.where("rejected").count() == 0 and none.count() == 3


WRAPPED = "\n".join(re.sub("(.{1,60})( |$)", "\\1\n", t).strip() for t in licenses.TEXTS["mit"])


def test_licenses(spark):
    texts = ["Plain words here.\nReleased under the MIT License.\n\nMore.", "Licensed under CC BY-NC 4.0.", "", None, "All rights reserved.", "Licensed under the Zebra Deed of 1812."]
    got = {r["doc_id"]: r for r in licenses.scan(docs_of(spark, texts)).collect()}
    assert [got[i]["families"] for i in range(6)] == [["mit"], ["cc-by-nc"], [], [], ["all-rights-reserved"], ["unknown"]]
    assert (got[0]["licenses"][0]["paragraph"], got[0]["licenses"][0]["line"]) == (0, 1) and [got[i]["n_paragraphs"] for i in range(4)] == [2, 1, 0, 0]
    assert licenses.scan(docs_of(spark, [])).count() == 0


def test_license_bodies_and_other_talk_of_licences(spark):
    bodies = {f: [t for t in licenses.TEXTS[f]] for f in ("mit", "bsd", "apache-2.0", "gpl")}
    texts = [t for f in bodies for t in bodies[f]] + ["Some words before.\n\n" + WRAPPED + "\n\nSome words after.", "It is under the terms of the GNU General\nPublic License as it stands.", *licenses.OTHER]
    texts += ["He told the story of a driving license in the year 1950. " * 3, "word " * 20_000 + "\nLicensed under the Apache License, Version 2.0.\n" + "word " * 20_000]
    got = [r["families"] for r in licenses.scan(docs_of(spark, texts)).orderBy("doc_id").collect()]
    names = [f for f in bodies for _ in bodies[f]]
    assert got[: len(names)] == [[f] for f in names]
    at = len(names)
    assert got[at] == ["mit"] and got[at + 1] == ["gpl"]
    assert got[at + 2 : at + 2 + len(licenses.OTHER)] == [[]] * len(licenses.OTHER)
    assert got[-2] == [] and got[-1] == ["apache-2.0"]


def test_license_hits_come_back_to_their_rows(spark):
    rows = [(None if k % 10 == 9 else k % 50, f"text number {k}" + (". Released under the MIT License." if k % 3 == 0 else "."), k) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int").withColumn("licenses", F.lit(1)).repartition(16).repartition(16, F.rand())
    got = sorted((str(r["doc_id"]), [h["text"] for h in r["licenses"]]) for r in licenses.scan(docs).collect())
    assert got == sorted((str(d), [t] if "MIT" in t else []) for d, t, _ in rows)


def test_paragraphs_left_out_hold_no_licence(spark, docs):
    """What the strong words leave out is "none" by the scores as well."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("text").alias("__text"))
    blocks = licenses.paragraphs(rows)
    model = licenses.Model(spark, licenses.units(blocks).select("unit.text"))
    assert model.strong and not {"the", "of", "and"} & set(model.strong)
    out = blocks.join(model.likely(blocks).select("row", "paragraph"), ["row", "paragraph"], "left_anti")
    left = licenses.units(out).select("row", "unit", F.col("unit.text").alias("text"))
    assert left.count() > 100 and model.classify(left, ["row", "unit"]).count() == 0


def test_license_scores_against_plain_sums(spark):
    """The scores of the pipeline are those of a plain reading of the fitted weights."""
    texts = ["Licensed under the Apache License, Version 2.0.", "nothing of the kind", "the rights to use, copy, modify", "Released under the ISC license"]
    docs = docs_of(spark, texts)
    model = licenses.Model(spark, docs.select("text"))
    keep = ["doc_id", "text"]
    got = {r["doc_id"]: r["raw"] for r in model._scored(model._featured(docs.select(*keep), keep), keep).collect()}
    weights, bias = model.model.coefficientMatrix.toArray(), model.model.interceptVector.toArray()
    for i, t in enumerate(texts):
        held = [k for k, g in enumerate(model.vocabulary) if g in set(licenses._grams(t))]
        assert all(abs(x - y) < 1e-6 for x, y in zip(got[i], bias + weights[:, held].sum(axis=1)))
