import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tradeloom.llm import spelling

SMALL = "/root/testdata/sf0.001"


def words_of(doc_id, text, every):
    for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
        run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
        h = zlib.crc32(f"{doc_id}:{run}".encode())
        if every and doc_id is not None and h % every == 0:
            run = run[: h % len(run)] + run[h % len(run) + 1 :]
        yield run


def one_apart(a, b):
    """Whether one inserted, deleted or replaced letter makes a of b."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain(docs, every=None, occurrences=3):
    counts = Counter(w for doc_id, text in docs for w in words_of(doc_id, text, every))
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= occurrences}
    near = {w: [v for v in counts if v != w and one_apart(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts.get(form[w]))
    return out


def found(spark, docs, **options):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = spelling.spelling_variants(frame, **options).collect()
    assert len(rows) == len({r.word for r in rows})
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def family(rng, letters, size, longest):
    """Words many of which are one edit apart, with repeated letters."""
    out = ["".join(rng.choices(letters, k=rng.randint(5, longest))) for _ in range(size)]
    for _ in range(size * 3):
        w = rng.choice(out)
        i = rng.randint(0, len(w))
        out.append(rng.choice([w[:i] + rng.choice(letters) + w[i:], w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i + 1 :]]))
    return out


@pytest.mark.parametrize("letters, longest, seed", [("ab", 9, 1), ("abcde", 8, 2), ("aeiouéÿ", 12, 3), ("a", 40, 4)])
def test_variants_equal_all_pairs(spark, letters, longest, seed):
    rng = random.Random(seed)
    words = family(rng, letters, 60, longest)
    docs = [(i, " ".join(rng.choices(words, k=60))) for i in range(40)]
    assert found(spark, docs, every=7) == plain(docs, every=7)


def test_given_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    counts = spelling.word_counts(spark.createDataFrame(docs, "doc_id long, text string"), 5, 97).collect()
    want = Counter(w for i, t in docs for w in words_of(i, t, 97) if len(w) >= 5)
    assert {r.word: r.n for r in counts} == want


def test_odd_rows(spark):
    long = "ab" * 40_000
    docs = [
        (None, "Sample sample SAMPLE samples samples samples"),
        (1, None), (2, ""), (3, "12 — 3"), (4, long), (4, long), (4, long), (5, long + "c"), (6, long + "c"), (7, long + "c"),
        (8, "Étés×÷ étés×÷ Étés×÷"),
        (9, "x" * 300), (9, "x" * 300), (9, "x" * 300),
    ]
    got = found(spark, docs, every=3)
    want = plain(docs, every=3)
    assert got == want
    assert got["sample"][2] == 3  # a null id misspells nothing


def test_no_words(spark):
    assert found(spark, []) == {}
    assert found(spark, [(1, "a an the"), (2, None)]) == {}


def test_other_columns_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "abcde abcdf abcde " * 4, 1, 2, 3)], "doc_id long, text string, word int, n int, key int")
    assert {r.word: r.form for r in spelling.spelling_variants(docs).collect()} == {"abcde": None, "abcdf": "abcde"}


def test_a_chain_of_forms_ends_at_its_root(spark):
    ladder = ["abcdefgh", "xbcdefgh", "xycdefgh", "xyzdefgh", "xyzwefgh", "xyzwvfgh"]
    docs = [(i, " ".join([w] * 3 * 2**i)) for i, w in enumerate(ladder)]
    got = found(spark, docs)
    assert {got[w][1] for w in ladder} == {ladder[-1]}
    assert got == plain(docs)


def test_checksums_are_carried_over():
    rng = random.Random(5)
    prefixes = [b"1:", b"-77:", b":"]
    runs = [rng.randbytes(rng.randint(1, 200)) for _ in range(300)]
    doc = np.array([rng.randrange(3) for _ in runs])
    own = np.array([zlib.crc32(r) for r in runs], dtype=np.uint32)
    got = spelling.checksums(prefixes, doc, np.array([len(r) for r in runs]), own)
    assert got.tolist() == [zlib.crc32(prefixes[d] + r) for d, r in zip(doc, runs)]


def test_two_apart_takes_the_cheapest_pair():
    rng = np.random.default_rng(0)
    cost = rng.integers(1, 30, (200, 9))
    picked = spelling.two_apart(cost)
    assert (picked[:, 1] - picked[:, 0] >= 2).all()
    for row, (a, b) in zip(cost, picked):
        assert row[a] + row[b] == min(row[i] + row[j] for i in range(9) for j in range(i + 2, 9))
