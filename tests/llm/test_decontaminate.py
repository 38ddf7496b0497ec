import random
import re

import pytest
from pyspark.sql import functions as F

from tradeloom.llm import decontaminate as dc

SMALL = "/root/testdata/sf0.01"


def plain(text):
    words = re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())
    return words, {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def held(docs, items):
    """Pairs of which the text, as one passage, holds three quarters of the item's shingles."""
    out = set()
    shingles = {i: plain(t) for i, t in items.items()}
    for d, text in docs.items():
        words, mine = plain(text)
        for i, (item, wanted) in shingles.items():
            if len(item) < 5 and item:
                n = len(item)
                if any(words[k : k + n] == item for k in range(len(words) - n + 1)):
                    out.add((d, i))
            elif wanted and len(mine & wanted) >= 0.75 * len(wanted):
                out.add((d, i))
    return out


def pairs(frame, benchmark, **settings):
    found = dc.contaminated(frame, benchmark, **settings).select("doc_id", F.explode("items").alias("i"))
    return {(r.doc_id, r.i.item_id) for r in found.collect()}


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id) for r in dc.op3_decontaminate(spark, SMALL).collect()}
    assert got == held(docs, items) and got


@pytest.mark.parametrize("block, part", [(8, 1 << 24), (2, 3000)])
def test_changed_and_cut_passages(spark, monkeypatch, block, part):
    monkeypatch.setattr(dc, "BLOCK", block)
    monkeypatch.setattr(dc, "PART_BYTES", part)
    rng = random.Random(2)
    common = ["the", "of", "and", "in", "to"]

    def prose(n):
        return [rng.choice(common) if rng.random() < 0.5 else f"w{rng.randint(0, 400)}" for _ in range(n)]

    items = {i: " ".join(prose(rng.choice([2, 4, 5, 6, 20, 40, 90, 700]))) for i in range(40)}
    docs = {}
    for d in range(200):
        words = prose(rng.choice([0, 3, 50, 400, 2500]))
        if rng.random() < 0.7:
            piece = items[rng.randrange(40)].split()
            for _ in range(rng.randint(0, max(1, len(piece) // 12))):
                piece[rng.randrange(len(piece))] = "changed"
            a, b = sorted((rng.randint(0, len(piece)), rng.randint(0, len(piece))))
            piece = piece if rng.random() < 0.7 else piece[a:b]
            at = rng.randint(0, len(words))
            words[at:at] = piece
        docs[d] = " ".join(words)
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    benchmark = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got, want = pairs(frame, benchmark), held(docs, items)
    assert got <= want
    # What only a text as a whole holds, spread over more than a passage, is no occurrence.
    for d, i in want - got:
        words, wanted = plain(docs[d])[0], plain(items[i])[1]
        span = 2 * len(plain(items[i])[0])
        best = max(len(plain(" ".join(words[k : k + span]))[1] & wanted) for k in range(max(1, len(words) - span + 1)))
        assert best < 0.75 * len(wanted)


def test_answers_must_be_found_too(spark):
    question = "which river flows through the old town of the seven bridges"
    docs = spark.createDataFrame([(1, f"{question} the blue danube"), (2, question)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(7, question, "Blue Danube")], "item_id long, text string, answer string")
    assert pairs(docs, benchmark) == {(1, 7), (2, 7)}
    assert pairs(docs, benchmark, answer="answer") == {(1, 7)}


def test_nulls_empty_tables_and_clashing_columns(spark):
    passage = "Alpha beta, gamma delta epsilon zeta"
    docs = spark.createDataFrame(
        [(1, passage), (1, passage), (None, passage.upper()), (2, None), (3, ""), (4, "alpha beta")], "doc_id long, text string"
    ).withColumn("items", F.lit("x"))
    benchmark = spark.createDataFrame([(1, passage), (1, passage), (2, None), (3, "..."), (None, "alpha beta")], "item_id long, text string")
    kept = dc.clean(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]
    assert dc.clean(docs, benchmark.limit(0)).count() == 6
    assert dc.clean(docs.limit(0), benchmark).count() == 0


def test_text_ids_and_a_very_long_text(spark):
    rng = random.Random(8)
    passage = " ".join(f"item{k}" for k in range(40))
    filler = [f"w{rng.randrange(5000)}" for _ in range(300_000)]
    long = " ".join([*filler[:200_000], passage, *filler[200_000:]])
    docs = spark.createDataFrame([(1, long), (2, " ".join(filler)), (3, passage)], "doc_id long, text string")
    benchmark = spark.createDataFrame([("q-1", passage), ("q-2", "something else that is not there at all"), (None, passage)], "item_id string, text string")
    got = {r.doc_id: [i.item_id for i in r["items"]] for r in dc.contaminated(docs, benchmark).collect()}
    assert got == {1: ["q-1"], 2: [], 3: ["q-1"]}
    assert [r.doc_id for r in dc.clean(docs, benchmark).collect()] == [2]
