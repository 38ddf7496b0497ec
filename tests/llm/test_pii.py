import hashlib
import random

from brute import personal
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradeloom.llm import pii

SMALL = "/root/testdata/sf0.01"
PIECES = ["4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (702) 555-0742", "+49", "a.b+c@x.example.com", "@", "x@y", ".", " ", "-",
          "10.20.30.40", "300.1.1.1", "1.2.3.4.5.6.7.8", "é", "12", "+", "((", "9" * 30, "q@w.e", "%"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join) | st.text("0123456789+@.- ()aé", max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert pii.base_spans(text) == personal(text)


def test_query_equals_the_patterns(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = pii.op8_pii(spark, SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        want = personal(texts[r.doc_id])
        shown = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in want) for k in pii.KINDS]
        assert r.base_sha256 == hashlib.sha256(shown.encode()).hexdigest()
        assert set(shown.split(",")) <= set(r.spans.split(","))


def written(spark, n=600):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        phone = f"+1 ({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
        mail = f"{rng.choice(['ann', 'bob', 'eve'])}{i}@{rng.choice(['mail', 'post'])}.example.com"
        rows.append((i, f"call {phone} or write {mail} about item {rng.randint(10**6, 10**7 - 1)} and {rng.randint(10**8, 10**9 - 1)}"))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_trees_add_other_spellings_and_leave_numbers(spark):
    docs = written(spark)
    model = pii.train(docs)
    again = pii.train(docs)
    assert model.threshold == again.threshold
    text = "write to carl77(at)mail.example.com about item 7654321"
    kinds = [(k, text[a:b]) for k, a, b in pii.added_spans(text, pii.base_spans(text), model)]
    assert ("email", "carl77(at)mail.example.com") in kinds and all("7654321" not in v for _, v in kinds)
    clean = ["order 1234567 of 2024", "at the house and then", "version 1.2.3", "1,000,000 words", ""]
    assert all(pii.added_spans(t, pii.base_spans(t), model) == [] for t in clean)


def mixed(spark, n=400, addresses=1.0):
    """Documents in which a fifth of the personal data has other spellings, and these."""
    rng = random.Random(9)
    rows, other = [], []
    for i in range(n):
        odd = i % 5 == 0
        phone = f"({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
        phone = phone if odd else f"+1 {phone}"
        name, host = f"{rng.choice(['ann', 'bob', 'eve'])}{i}", f"{rng.choice(['mail', 'post'])}.example.com"
        mail = f"{name} (at) {host}" if odd else f"{name}@{host}"
        ip = ":".join(f"{rng.randint(1, 65535):x}" for _ in range(8)) if odd else ".".join(str(rng.randint(1, 255)) for _ in range(4))
        ip = f" from host {ip}" if rng.random() < addresses else ""
        rows.append((i, f"call {phone} or write {mail}{ip} about item {rng.randint(10**6, 10**7 - 1)} on 2024-{rng.randint(10, 12)}-{rng.randint(10, 28)} at 10:{rng.randint(10, 59)}:{rng.randint(10, 59)}:{rng.randint(10, 59)}"))
        if odd:
            other.append((i, {("phone", phone), ("email", mail)} | ({("ip", ip.split()[-1])} if ip else set())))
    return spark.createDataFrame(rows, "doc_id long, text string"), dict(rows), other


def test_spellings_that_occur_are_found(spark):
    docs, texts, other = mixed(spark)
    model = pii.train(docs)
    added = {i: {(k, t[a:b]) for k, a, b in pii.added_spans(t, pii.base_spans(t), model)} for i, t in texts.items()}
    hit = sum(len(want & added[i]) for i, want in other)
    assert hit >= 0.95 * sum(len(want) for _, want in other), model.threshold
    wanted = dict(other)
    assert sum(len(found - wanted.get(i, set())) for i, found in added.items()) <= 0.01 * hit


def test_rare_kinds_keep_a_threshold(spark):
    docs, texts, other = mixed(spark, addresses=0.06)
    assert 0 < sum(k == "ip" for t in texts.values() for k, _, _ in pii.base_spans(t)) < 40
    model = pii.train(docs)
    assert model.threshold["ip"] <= 1 < model.threshold["card"]


def test_added_spans_never_touch_base_spans(spark):
    model = pii.train(written(spark))
    model.threshold = dict.fromkeys(pii.KINDS, 0.0)  # everything is accepted
    rng = random.Random(5)
    for _ in range(200):
        text = "".join(rng.choice(PIECES) for _ in range(12))
        base = pii.base_spans(text)
        added = pii.added_spans(text, base, model)
        for k, (_, a, b) in enumerate(added):
            assert not any(x < b and a < y for _, x, y in base + added[:k])


def test_redaction_nulls_and_clashing_columns(spark):
    rows = [(1, "mail a@b.example now", 5), (1, "mail a@b.example now", 5), (None, None, None), (3, "", 0), (4, "no data", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").withColumn("clean", F.lit("x"))
    got = pii.redact(docs, pii.train(docs))
    assert got.columns == docs.columns
    values = sorted((r.doc_id or 0, r.text, r.n_chars, r.clean) for r in got.collect())
    assert values == [(0, None, None, "x"), (1, "mail [EMAIL] now", 16, "x"), (1, "mail [EMAIL] now", 16, "x"), (3, "", 0, "x"), (4, "no data", 7, "x")]
    assert pii.redact(docs.limit(0), pii.train(docs.limit(0))).collect() == []
    assert pii.redact_text("0123456789", [("ip", 2, 5), ("card", 4, 7), ("phone", 7, 8)]) == "01[IP][PHONE]89"


def test_very_long_texts(spark):
    text = "9" * 100_000 + " " + "a." * 100_000 + "@x.example " + "+" * 1000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = docs.select(pii.find(F.col("text"), pii.train(docs)).alias("f")).first().f
    assert [(s.kind, s.start, s.end) for s in found.base] == personal(text)
