import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tradeloom.llm import rules
from tradeloom.llm.texts import slices

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string"


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i : i + 5])].append(i)
    covered = {i + k for starts in windows.values() if len(starts) > 1 for i in starts for k in range(5)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered))


def read(text):
    return bytes(
        32 if b in (9, 10, 11, 12, 13) else 48 if 48 <= b <= 57 else b + 32 if 65 <= b <= 90 else b for b in text.encode()
    )


def grams_of(text):
    data = bytes(rules.ORDER - 1) + read(text)
    return [data[i : i + rules.ORDER] for i in range(len(data) - rules.ORDER + 1)]


class PlainModel:
    """Modified Kneser-Ney by dictionaries."""

    def __init__(self, texts):
        counts = {rules.ORDER: Counter(g for t in texts for g in grams_of(t))}
        for k in range(rules.ORDER - 1, 0, -1):
            counts[k] = Counter(g[1:] for g in counts[k + 1])
        self.counts, self.followers, self.discount = counts, {}, {}
        for k, table in counts.items():
            n = Counter(table.values())
            made = None
            if n[1] and n[2] and n[3]:
                y = n[1] / (n[1] + 2 * n[2])
                made = [i - (i + 1) * y * n[i + 1] / n[i] for i in (1, 2, 3)]
                if not all(0 < d < i for i, d in enumerate(made, 1)):
                    made = None
            self.discount[k] = made or list(rules.FALLBACK)
            follow = defaultdict(list)
            for g, c in table.items():
                follow[g[:-1]].append(c)
            self.followers[k] = follow

    def p(self, gram):
        if not gram:
            return 1 / 256
        k = len(gram)
        follow = self.followers[k].get(gram[:-1])
        if not follow:
            return self.p(gram[1:])
        rest = sum(self.discount[k][min(c, 3) - 1] for c in follow) / sum(follow)
        c = self.counts[k][gram]
        own = (c - self.discount[k][min(c, 3) - 1]) / sum(follow) if c else 0.0
        return own + rest * self.p(gram[1:])

    def bits_per_byte(self, text):
        grams = grams_of(text)
        return -sum(math.log2(self.p(g)) for g in grams) / len(grams)


def small_docs(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang").orderBy("doc_id").collect()
    return [tuple(r) for r in rows]


def test_counts_of_given_and_odd_texts(spark):
    texts = [t for _, t, _ in small_docs(spark)]
    texts += [None, "", " \t\n", "a a a a a a", "a b c d e a b c d e", "x\nx\n\n\nx\r\ny \ny", "é" * 50 + "\n" + "é" * 50, "#*$%&|<>é"]
    texts += ["w " * 50_000 + "\n" + "line\n" * 20_000]
    column = pa.array(texts)
    got = []
    for part in slices(column):
        found = rules.rule_counts(part)
        got += list(zip(*(found[c].tolist() for c in rules.COUNTS)))
    assert got == [plain_counts(t) for t in texts]


def judged(spark, docs):
    frame = spark.createDataFrame(docs, SCHEMA)
    return rules.judge(frame, rules.train(frame)).collect()


@pytest.mark.parametrize("entries", [1 << 22, 5000])
def test_probabilities_equal_plain_model(spark, monkeypatch, entries):
    """The same bits a byte with one part of the model and with many."""
    monkeypatch.setattr(rules, "PART_ENTRIES", entries)
    docs = small_docs(spark)[:60] + [(-1, "Short text in no language", None), (-2, None, "en"), (-3, "", "en")]
    models = {x: PlainModel([t or "" for _, t, lang in docs if (lang or "") == x]) for x in {lang or "" for *_, lang in docs}}
    got = judged(spark, docs)
    assert len(got) == len(docs)
    texts = {i: (t, lang) for i, t, lang in docs}
    for r in got:
        text, lang = texts[r.doc_id]
        assert tuple(r[c] for c in rules.COUNTS) == plain_counts(text)
        if text:
            assert r.bits_per_byte == pytest.approx(models[lang or ""].bits_per_byte(text), abs=2e-5)
        else:
            assert r.bits_per_byte is None and r.base_failed and not r.kept


def test_unseen_n_grams_fall_back(spark):
    known = [(1, "the cat sat on the mat and the dog sat on the log", "en"), (2, "a cat and a dog", "en")]
    model = rules.train(spark.createDataFrame(known, SCHEMA))
    plain = PlainModel([t for _, t, _ in known])
    asked = [(1, "the zebra sat", "en"), (2, "一丁", "en"), (3, "dog", "en")]
    got = rules.text_bits(spark.createDataFrame(asked, SCHEMA), model).collect()
    want = sorted(plain.bits_per_byte(t) for _, t, _ in asked)
    assert sorted(r.bits / rules.UNITS / r.bytes for r in got) == pytest.approx(want, abs=1e-5)


def test_bands_reject_both_sides_in_each_language(spark):
    rng = random.Random(1)
    words = {"en": ["the", "cat", "house", "tree", "runs", "over", "green", "hills"], "xx": ["zorg", "blim", "quax", "fnord", "wib", "trel"]}
    docs = [
        (1000 * (lang == "xx") + i, " ".join(rng.choices(words[lang], k=80)), lang) for lang in words for i in range(120)
    ]
    noise = "".join(rng.choices("bcdfghjklmnpqrstvwxz#!?", k=400))
    docs += [(5000, " ".join(noise[i : i + 6] for i in range(0, 400, 6)), "en")]
    docs += [(5001, " ".join(rng.choices(words["xx"], k=80)), "en")]  # right words, wrong language
    got = {r.doc_id: r for r in judged(spark, docs)}
    assert not got[5000].base_failed and not got[5000].kept and got[5000].bits_per_byte > got[5000].high
    assert all(got[i].kept for i, _, _ in docs if i < 5000 and not got[i].base_failed)


def test_repeated_rows_empty_tables_and_clashing_columns(spark):
    text = " ".join(f"word{i} follows" for i in range(30))
    frame = spark.createDataFrame([(1, text, "en", 1, 2)] * 3 + [(None, text, "en", 1, 2)], SCHEMA + ", bits int, part int")
    rows = rules.judge(frame, rules.train(frame)).collect()
    assert sorted((r.doc_id is None, r.kept) for r in rows) == [(False, True)] * 3 + [(True, True)]
    assert judged(spark, []) == []
    assert [(r.kept, r.base_failed) for r in judged(spark, [(1, None, None)])] == [(False, True)]


def test_counts_of_long_texts_are_whole(spark, monkeypatch):
    """A text cut into pieces has the n-grams of the whole."""
    monkeypatch.setattr(rules, "PIECE", 1000)
    rng = random.Random(2)
    long = "".join(rng.choices("abcdé \n", k=20_000))
    texts = [long, "ab", "", long[:999], "x" * 1001]
    got = Counter()
    for part in slices(pa.array(texts)):
        for doc, gram in rules.byte_grams(part):
            got.update(zip(doc.tolist(), gram.tolist()))
    want = Counter((i, int.from_bytes(g, "big")) for i, t in enumerate(texts) for g in grams_of(t))
    assert got == want
    assert np.all(np.array([g for _, g in got]) >= 0)
