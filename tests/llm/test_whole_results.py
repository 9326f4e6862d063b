"""Cases in which operators once gave less than the whole result."""

import math
import random

import public_tokenizers
import pytest
from test_text_operators import brute_repeats, docs_of

import corpus_pipeline
from funnelbook.llm import quality, repeats, sentence_pieces, simhash, url_filter
from funnelbook.llm.common import table


def test_pieces_of_different_size_are_different(spark):
    rng = random.Random(7)
    text = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    pairs = []
    for _ in range(60):
        t = text(127)
        pairs += [t, t[:95] + t[95] + t[95:]]  # the same grams at 0, 32, 64 and the end
    for _ in range(30):
        head, tail = text(90), text(5)
        pairs += [head + "=" * n + tail for n in rng.sample([40, 41, 70, 71, 72], 2)]
    pairs += [text(110) + "=" * n for n in (31, 32, 33, 64, 65, 200, 201)]
    rows = list(enumerate(pairs))
    got = {r["doc_id"]: tuple(r)[1:] for r in repeats.measure(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_repeats(rows)


def test_repeated_rows_are_one_text(spark):
    rng = random.Random(8)
    line = "".join(rng.choice("abcdefgh ") for _ in range(130))
    texts = ["q w e r t y u i o p " * 30, line, line + "x" + line, "ab" * 300, "y" + line]
    want = brute_repeats(list(enumerate(texts)))
    assert want[0][:2] == (600, 580)
    for pieces in (repeats.PIECES, 1):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(repeats, "PIECES", pieces)
            got = repeats.measure(docs_of(spark, texts).unionByName(docs_of(spark, texts)).unionByName(docs_of(spark, texts[:1]))).collect()
        assert len(got) == 11
        assert all(tuple(r)[1:] == want[r["doc_id"]] for r in got)


def rows_of_docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")


def linked_by_hand(rows):
    """The row that stays of each group of linked fingerprints: smallest id, null last, then the first."""
    prints = [simhash.fingerprint((t or "").encode()) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(prints):
        for j in range(i):
            if (x ^ prints[j]).bit_count() <= 4:
                parent[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    return [min(g, key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i)) for g in groups.values()]


def test_near_copies_stage_keeps_one_of_each_group(spark, sf):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    rows = []
    for group in range(12):
        base = [word() for _ in range(300)]
        for _ in range(12):
            copy = list(base)
            for k in rng.sample(range(300), rng.randint(0, 5)):
                copy[k] = word()
            rows.append((rng.randint(0, 10**6), " ".join(copy)))
    rows += [(5, None), (4, ""), (3, "one"), (2, "ONE"), (1, "one two"), (0, "one  two")]
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.keep_first(spark, rows_of_docs(spark, rows), sf).collect()]
    want = [rows[k] for k in linked_by_hand(rows)]
    assert len(want) < len(rows) and sorted(got, key=str) == sorted(want, key=str)
    assert corpus_pipeline.keep_first(spark, rows_of_docs(spark, []), sf).count() == 0


def test_near_copies_are_dropped_by_row(spark, sf):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (5, "quite another text of id five"), (None, "a b c d e f"), (None, "g h i j k l"), (None, "g h i j k l"), (None, "m n o p q r"), (7, "M N o p q r")]
    got = [(r["doc_id"], r["text"].lower()) for r in corpus_pipeline.keep_first(spark, rows_of_docs(spark, rows), sf).collect()]
    assert sorted(got, key=str) == sorted([(rows[k][0], rows[k][1].lower()) for k in linked_by_hand(rows)], key=str)
    assert sorted(got, key=str) == sorted([(5, "a b c d e f"), (5, "quite another text of id five"), (None, "g h i j k l"), (7, "m n o p q r")], key=str)


def test_stages_on_nulls_repeats_and_nothing(spark, sf):
    line = "some passage that is long enough to be a repeat of one hundred bytes when it stands twice, in two different texts"
    rows = [(1, line), (2, "x " + line), (2, "x " + line), (None, None), (None, ""), (3, None), (4, "é" * 300), (5, "▁ a  b")]
    docs = rows_of_docs(spark, rows)
    cut = {(r["doc_id"], r["text"]) for r in corpus_pipeline.cut_repeats(spark, docs, sf).collect()}
    assert {(1, line), (2, "x "), (None, None), (None, ""), (3, None)} <= cut
    assert corpus_pipeline.keep_uncontaminated(spark, docs, sf).count() == len(rows)
    coded = corpus_pipeline.encode(spark, docs, sf).collect()
    assert len(coded) == len(rows) and all(r["round_trip"] for r in coded)
    assert sorted(r["n_tokens"] for r in coded)[:3] == [0, 0, 0]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, rows_of_docs(spark, []), sf).count() == 0


def test_pieces_replace_columns_of_their_names(spark):
    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = spark.createDataFrame([(1, "a b", "x", "y", True)], "doc_id long, text string, ids string, decoded string, ok boolean")
    coded = sentence_pieces.encode(docs, model, check="ok")
    row = sentence_pieces.decode(coded, model).first()
    assert row["decoded"] == "a b" and row["ok"] and len(row["ids"]) == 2 and coded.columns == ["doc_id", "text", "decoded", "ids", "ok"]
    assert sentence_pieces.decode(sentence_pieces.encode(docs.limit(0), model), model).count() == 0


def test_quality_rejects_rows_not_ids(spark, sf, monkeypatch):
    evidence = lambda docs, labels, sample: docs.selectExpr("*", "IF(text LIKE 'bad%', 50D, -50D) AS llr")
    monkeypatch.setattr(quality, "evidence", evidence)
    rows = [(None, "bad text"), (None, "good text"), (None, "good other"), (3, "bad"), (3, "good"), (4, "good"), (4, "good")]
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.keep_good(spark, rows_of_docs(spark, rows), sf).collect()]
    assert sorted(got, key=str) == sorted([r for r in rows if not r[1].startswith("bad")], key=str)


def test_url_verdicts_do_not_depend_on_the_size_of_the_table(spark):
    link = lambda h: f'<a href="https://{h}/p">'
    web = [("http://b.net/", ""), ("http://spam.com/", link("b.net")), ("http://far.com/", link("spam.com")), ("http://a.example.net/en/", link("good.com")), ("http://good.com/", "")]
    want = {"b.net": "block", "spam.com": "block", "far.com": "block", "a.example.net": "allow", "good.com": "allow"}
    # the same web beside copies of itself and 40,000 listed pages of other hosts
    frame = lambda rows: spark.createDataFrame([(u.split("/")[2], u, h) for u, h in rows], "page_id string, url string, html string")
    copies = [(u.replace("://", f"://w{k}."), h.replace("https://", f"https://w{k}.")) for k in range(3) for u, h in web]
    url = "concat('http://x', id, IF(id % 2 = 0, '.net/', '.org/fr/')) AS url"
    other = spark.range(0, 40_000, 1, 2).selectExpr("CAST(NULL AS STRING) AS page_id", url, "'' AS html")
    pages = frame(web + copies).unionByName(other)
    got = {r["page_id"]: r["verdict"] for r in url_filter.filter_urls(pages).where("page_id IS NOT NULL").collect()}
    assert got == {h: want[h.partition(".")[2] if h[0] == "w" else h] for h in got} and got.keys() >= want.keys()


def plain_bayes(rows):
    """Posterior rates by hand: global mean, hosts shrunk to it, paths to their host, each as strongly as the spread says."""
    soft = [1 / (1 + math.exp(-x)) for _, _, x in rows]

    def strength(groups):  # (n, rate, mean)
        total = sum(n for n, _, _ in groups)
        inside = sum(m * (1 - m) for _, _, m in groups) / len(groups)
        spread = max(sum(n * ((r - m) ** 2 - m * (1 - m) / n) for n, r, m in groups) / total, inside * 1e-3)
        return min(max(inside / spread - 1, 1.0), 1000.0)

    def gathered(key):
        out = {}
        for row, x in zip(rows, soft):
            n, s = out.get(key(row), (0, 0.0))
            out[key(row)] = (n + 1, s + x)
        return out

    mean = sum(soft) / len(soft)
    hosts = gathered(lambda r: r[0])
    m = strength([(n, s / n, mean) for n, s in hosts.values()])
    host_mean = {h: (s + m * mean) / (n + m) for h, (n, s) in hosts.items()}
    paths = gathered(lambda r: r[:2])
    k = strength([(n, s / n, host_mean[h]) for (h, _), (n, s) in paths.items()])
    return {(h, p): (s + k * host_mean[h]) / (n + k) for (h, p), (n, s) in paths.items()}


def test_site_rates_against_plain_sums(spark):
    rng = random.Random(11)
    rate = {h: rng.uniform(-3, 3) for h in ("a", "b", "c", None)}
    rows = [(h, p, rng.gauss(rate[h] + (1 if p == "x" else 0), 1)) for h in rate for p in ("x", "y", None) for _ in range(rng.randint(1, 40))]
    rows += rows[:5] * 3
    got = {(r["host"], r["path"]): r["prior"] for r in quality.site_rates(spark.createDataFrame(rows, "host string, path string, llr double")).collect()}
    want = plain_bayes(rows)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_quality_of_odd_rows(spark, sf, monkeypatch):
    monkeypatch.setattr(quality, "evidence", lambda docs, labels, sample: docs.selectExpr("*", "CAST(length(text) % 7 AS DOUBLE) - 3 AS llr"))
    rows = [(1, "word " * 30_000, "en", "s"), (1, "word " * 30_000, "en", "s"), (None, "x", None, None), (2, "", "en", None), (3, "yy", None, "s")]
    docs = spark.createDataFrame([(*r, "clash", 0.5) for r in rows], "doc_id long, text string, lang string, source string, host string, prior double")
    judged = quality.judge(docs, table(spark, sf, "labels"), keep=("text",)).collect()
    prior = plain_bayes([(s, g, len(t) % 7 - 3) for _, t, g, s in rows])
    assert len(judged) == len(rows)
    for r in judged:
        odds = r["llr"] + math.log(prior[r["host"], r["path"]] / (1 - prior[r["host"], r["path"]]))
        assert abs(r["p_bad"] - 1 / (1 + math.exp(-odds))) < 1e-9 and r["rejected"] == (r["p_bad"] > quality.REJECT)


def test_near_duplicates_of_odd_rows(spark):
    docs = spark.createDataFrame([(None, "a b c d e", 1, "x"), (7, "a b c d e", 2, "y"), (7, "a b c d e", 2, "y"), (None, "zz", 0, "z")], "doc_id long, text string, fp int, component_id string")
    got = sorted((str(r["doc_id"]), str(r["component_id"])) for r in simhash.near_duplicates(docs).collect())
    assert got == [("7", "7"), ("7", "7"), ("None", "7"), ("None", "None")]
