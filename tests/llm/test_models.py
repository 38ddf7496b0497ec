"""Language, toxicity and quality on held-out rows and odd ones."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tradeloom.llm import language, quality, toxicity
from tradeloom.llm.boosting import boost, precise_threshold
from tradeloom.llm.frames import held_out
from tradeloom.llm.texts import slices

SF, SMALL = "/root/testdata/sf0.1", "/root/testdata/sf0.001"
ODD = [(1, None, None), (2, "", "a"), (3, "  \n 12 !!", "b"), (None, "éé", "a"), (5, "x" * 300_000, None), (5, "x" * 300_000, None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string, source string")


def test_language_of_held_out_rows(spark):
    got = language.op2_language_id(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    row = got.where("held_out").join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert row[0] > 0.99
    assert got.where("score < 0 or score > 1 or score is null or lang_pred is null").count() == 0


def test_language_of_odd_rows(spark, odd):
    docs = spark.createDataFrame(
        [(i, t, g) for i, (t, g) in enumerate([("the cat and the dog", "en"), ("le chat et la souris", "fr")] * 40)],
        "doc_id long, text string, lang string",
    )
    model = language.train(docs)
    assert model.languages == ["en", "fr"]
    got = [r.p for r in odd.select(language.language(F.col("text"), model).alias("p")).collect()]
    assert [g.lang for g in got[:3]] == ["und"] * 3 and [g.score for g in got[:3]] == [0.0] * 3
    assert got[3].lang in ("en", "fr") and got[4] == got[5]
    none = language.train(docs.where("lang is null"))
    assert {r.p.lang for r in odd.select(language.language(F.col("text"), none).alias("p")).collect()} == {"und"}
    assert odd.limit(0).select(language.language(F.col("text"), model)).collect() == []


@pytest.mark.parametrize("k", [1, 2, 3, 4, 6, 7, 12, 40])
def test_codewords_differ_and_split(k):
    code = language.codewords(k)
    assert len({tuple(c) for c in code}) == k
    if k > 2:
        assert (np.abs(code.sum(axis=0)) < k).all()
        apart = min((code[i] != code[j]).sum() for i in range(k) for j in range(i))
        assert apart >= (2 ** (k - 2) if k <= 6 else 5)


def test_an_even_text_is_ambiguous():
    model = language.Model(["a", "b"], language.codewords(2), np.zeros((1 << language.BITS, 1), np.float32), np.zeros(1), np.ones((2, 1)))
    p = language.decode(np.zeros((1, 1)), model)
    assert np.allclose(p, 0.5)


def test_toxicity_of_held_out_rows(spark):
    got = toxicity.op10_toxicity(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = got.where("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in rows}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.85
    assert n[0, 0] / (n[0, 0] + n.get((0, 1), 0)) > 0.98
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_toxic_sentences_are_located(spark, odd):
    rng = np.random.default_rng(1)
    plain = ["alpha", "beta", "gamma", "delta", "omega"]

    def text(toxic):
        sentences = [" ".join(rng.choice(plain, 6)) for _ in range(4)]
        if toxic:
            sentences[2] = "alpha vile beta"
        return "É " + ". ".join(sentences) + "."

    rows = [(i, text(i % 2 == 0), int(i % 2 == 0)) for i in range(200)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] * 2 + [(None, 1), (999, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = docs.select("doc_id", "text", toxicity.toxicity(F.col("text"), model).alias("t")).collect()
    for r in got:
        assert (r.t.score >= 0.3) == (r.doc_id % 2 == 0)
        assert [r.text[s.start : s.end] for s in r.t.sentences] == (["alpha vile beta"] if r.doc_id % 2 == 0 else [])
    scores = [r.s for r in odd.select(toxicity.toxicity(F.col("text"), model).score.alias("s")).collect()]
    assert scores[0] == scores[1] == 0.0 and scores[4] == scores[5] and all(0 <= s <= 1 for s in scores)
    unlabelled = toxicity.train(docs, labels.limit(0))
    assert docs.select(F.max(toxicity.toxicity(F.col("text"), unlabelled).score)).first()[0] < 1e-9


def test_rare_toxic_words_beside_many_common_ones(spark):
    rng = np.random.default_rng(2)
    common = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 12)) for _ in range(450)]
    texts = [" ".join(common[(40 * i + j) % 450] for j in range(40)) for i in range(600)]  # each word 11 features
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(1000 + i, "so zorb it", 1) for i in range(24)]
    rows += [(2000 + i, "so it is", 0) for i in range(624)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"))
    probe = spark.createDataFrame([("so zorb it",), ("so it is",)], "text string")
    rare, plain = [r.s for r in probe.select(toxicity.toxicity(F.col("text"), model).score.alias("s")).collect()]
    assert rare >= 0.3 > plain


def test_quality_of_rows_it_has_not_seen(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(docs, labels.where(~held_out(F.col("doc_id"))))
    judged = quality.judge(docs, model, "verdict").select("doc_id", "verdict.kept").join(
        labels.where(held_out(F.col("doc_id"))), "doc_id"
    )
    assert judged.select(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int"))).first()[0] > 0.98


def test_quality_of_odd_rows(spark, odd):
    none = quality.train(odd, spark.createDataFrame([], "doc_id long, quality int"))
    got = [r.q for r in quality.judge(odd.withColumn("quality", F.lit(1)), none, "q").select("q").collect()]
    assert len(got) == len(ODD)
    assert sorted(r.kept for r in got) == [False, False, True, True, True, True]
    assert quality.judge(odd.limit(0), none).collect() == []


def test_sites_shrink_towards_the_level_above(spark):
    rows = [("big", "p", 4.0)] * 400 + [("big", "q", -4.0)] * 400 + [("bad", "", -4.0)] * 500 + [("one", "", -4.0)]
    judged = spark.createDataFrame(rows, "host string, path string, evidence double")
    sites = quality.site_posteriors(judged, 0.0)
    site = F.struct(*sites.table.columns)
    odds = {(r.host, r.path): r.odds for r in sites.table.select("host", "path", sites.odds(site, F.lit(0.0), 0).alias("odds")).collect()}
    assert odds["big", "p"] > 2 and odds["big", "q"] < -2 and odds["bad", ""] < -2
    assert odds["bad", ""] < odds["one", ""] < odds["big", "p"]


def test_hosts_and_paths(spark):
    rows = [("https://A.org/x/y/z",), ("src7",), ("h/one/two",), (None,), ("http://b.c?q",)]
    frame = spark.createDataFrame(rows, "s string")
    got = [tuple(r) for r in frame.select(quality.host(F.col("s")), quality.path(F.col("s"))).collect()]
    assert got == [("a.org", "x"), ("src7", ""), ("h", "one"), (None, ""), ("b.c", "")]


def test_boosting_learns_a_rule_and_a_threshold():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = boost(x[:2000], y[:2000])
    p = model.probability(x[2000:])
    assert ((p > 0.5) == y[2000:]).mean() > 0.95
    cut = precise_threshold(p, y[2000:], 0.99)
    assert y[2000:][p >= cut].mean() >= 0.99
    assert precise_threshold(np.zeros(0), np.zeros(0), 0.99) > 1
    assert boost(np.zeros((0, 2)), np.zeros(0)).probability(np.ones((3, 2))).tolist() == [0.5] * 3


# --- the fitted models, applied by plain loops ------------------------------------------


def small(spark, *columns):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", *columns).orderBy("doc_id").collect()
    rows = [tuple(r) for r in rows]
    return rows + [(-1, None, *[None] * len(columns)), (-2, "", *[None] * len(columns)), (-3, "é 12 !! " * 9, *[None] * len(columns))]


def plain_quality_features(text):
    """The features of one text, counted word by word."""
    data = text.encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    low = [bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in words]
    many, size = max(len(words), 1), max(len(data), 1)
    letter = lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b >= 0x80
    letters = [sum(map(letter, w)) for w in words]
    upper, lower = ([sum(a <= b <= z for b in w) for w in words] for a, z in ((65, 90), (97, 122)))
    counts = Counter(low)
    distinct, most = len(counts), max(counts.values(), default=0)
    out = [
        np.log1p(len(words)), 1 / np.sqrt(many), distinct / many, np.log(distinct + 1) / np.log(many + 1),
        sum(a == b for a, b in zip(low, low[1:])) / many, most / many, sum(n == 0 for n in letters) / many,
        sum(u >= 2 and not v for u, v in zip(upper, lower)) / many, sum(n < len(w) for n, w in zip(letters, words)) / many,
        sum(map(len, words)) / many, sum(len(w) > 20 for w in words) / many, sum(map(letter, data)) / size,
        sum(48 <= b <= 57 for b in data) / size, data.count(b"\n") * 10 / size,
    ]
    return out + [np.sqrt(data.count(c.encode()) / many) for c in quality.MARKS], len(words)


def test_quality_equals_a_plain_loop(spark):
    rows = small(spark, "source")
    rows = [(i, t, s if i % 3 else f"{s}/dir{i % 2}/page" if s else s) for i, t, s in rows]
    rows += [(-4, rows[5][1], "alone.org/a/b"), (-5, rows[6][1], ""), (-6, rows[7][1], None), (-6, rows[7][1], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    model = quality.train(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    found = quality.judge(docs, model, "q").select("doc_id", "q.*").collect()

    sites = defaultdict(list)
    judged = []
    for i, text, source in rows:
        x, words = plain_quality_features(text or "")
        z = np.clip((np.array(x) - model.mean) / model.scale, -6, 6)
        e = float(np.clip(np.append(z, np.minimum(z * z, 12)) @ model.weights + model.bias - model.prior, -12, 12)) if words else None
        if source is None:
            site = (None, "")
        else:
            host, _, rest = source.partition("/")
            site = (host.lower(), rest.partition("/")[0] if "/" in rest else "")
        if e is not None:
            sites[site].append(1 / (1 + np.exp(-(e + model.prior))))
        judged.append((i, e, site))
    hosts = defaultdict(list)
    for (host, _), p in sites.items():
        hosts[host] += p
    overall = min(max(sum(map(sum, hosts.values())) / sum(map(len, hosts.values())), 1e-3), 1 - 1e-3)

    def strength(groups):
        groups = [(len(p), sum(p), above) for p, above in groups if len(p) >= 2]
        noise = [a * (1 - a) for _, _, a in groups]
        apart = sum(n * (g / n - a) ** 2 for n, g, a in groups) - sum(noise)
        scale = sum(n * v for (n, _, _), v in zip(groups, noise)) - sum(v / n for (n, _, _), v in zip(groups, noise))
        return 1 / min(max(apart / max(scale, 1e-12), 1e-4), 0.9) - 1

    of_hosts = strength([(p, overall) for p in hosts.values()])
    share = {h: (sum(p) + overall * of_hosts) / (len(p) + of_hosts) for h, p in hosts.items()}
    of_paths = strength([(p, share[h]) for (h, _), p in sites.items()])
    want = []
    for i, e, site in judged:
        if e is None:
            want.append((i, None, 0.0))
            continue
        own = 1 / (1 + np.exp(-(e + model.prior)))
        host, path = hosts[site[0]], sites[site]
        above = (sum(host) - own + overall * of_hosts) / (len(host) - 1 + of_hosts)
        p = min(max((sum(path) - own + above * of_paths) / (len(path) - 1 + of_paths), 1e-3), 1 - 1e-3)
        want.append((i, e, 1 / (1 + np.exp(-(e + np.log(p / (1 - p)))))))
    got = sorted((r.doc_id, r.evidence, r.score, r.kept) for r in found)
    for (i, e, score), r in zip(sorted(want, key=lambda w: w[0]), got, strict=True):
        assert r[0] == i and r[3] == (r[2] >= quality.THRESHOLD)
        assert r[1] is None if e is None else r[1] == pytest.approx(e, abs=1e-6)
        assert r[2] == pytest.approx(score, abs=1e-6)


def plain_ngram_shares(text):
    seen = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0x80 else 32 for b in text.encode())
    size = 1 << (language.BITS - 1)
    counts = np.zeros(2 * size)
    for part, n in enumerate((2, 3)):
        for i in range(len(seen) - n + 1):
            gram = seen[i : i + n]
            if gram != b" " * n:
                hashed = (int.from_bytes(gram, "big") * 0x9E3779B1 & 0xFFFFFFFF) >> (33 - language.BITS)
                counts[part * size + hashed] += 1
    counts = np.sqrt(counts)
    return counts / max(np.sqrt((counts**2).sum()), 1e-9)


def test_language_equals_a_plain_loop(spark):
    rows = small(spark, "lang")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs)
    got = {r.doc_id: r.p for r in docs.select("doc_id", language.language(F.col("text"), model).alias("p")).collect()}
    for i, text, _ in rows:
        if not text or not any(c.isalpha() for c in text):
            assert (got[i].lang, got[i].score, got[i].ambiguous) == ("und", 0.0, False)
            continue
        margin = plain_ngram_shares(text) @ model.weights + model.bias
        distance = {}
        for k, name in enumerate(model.languages):
            losses = [np.log1p(np.exp(-m * c)) for m, c in zip(margin, model.code[k])]
            distance[name] = sum(t * x for t, x in zip(model.trust[k], losses)) * len(margin)
        total = sum(np.exp(-d) for d in distance.values())
        best, second = sorted(distance, key=distance.get)[:2]
        p = {name: np.exp(-distance[name]) / total for name in (best, second)}
        assert got[i].score == pytest.approx(p[best], abs=1e-4)
        if p[best] - p[second] > 1e-3:
            assert got[i].lang == best
        if abs(p[best] - p[second] - language.AMBIGUOUS) > 1e-3:
            assert got[i].ambiguous == (p[best] - p[second] < language.AMBIGUOUS)


def test_toxicity_equals_a_plain_loop(spark):
    """Noisy-or by hand over sentences and words found by patterns."""
    rows = small(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    got = {r.doc_id: r.t for r in docs.select("doc_id", toxicity.toxicity(F.col("text"), model).alias("t")).collect()}
    weight_of = {}

    def weight(word):
        """The word's features are looked up one by one, on its own."""
        if word not in weight_of:
            (texts,) = slices(pa.array([word.decode()]))
            features, *_ = toxicity.sentences(texts)
            weight_of[word] = float(sum(model.weights[f].sum() for _, f in features))
        return weight_of[word]

    for i, text in rows:
        scores = []
        for sentence in re.split(rb"[.!?\n]", (text or "").encode()):
            words = re.findall(rb"[0-9A-Za-z'\x80-\xff]+", sentence)
            if words:
                z = min(max(sum(map(weight, words)) + model.bias, -50), 50)
                scores.append(1 / (1 + np.exp(-z)))
        want = 1 - np.prod([1 - p for p in scores]) if scores else 0.0
        assert got[i].score == pytest.approx(want, abs=1e-5)
        assert [s.score for s in got[i].sentences] == pytest.approx([p for p in scores if p >= 0.5], abs=1e-5)
