"""Benchmark decontamination: passages query a BM25 index of test items by block-max WAND.

Items are the indexed documents and every passage of every text is a query of its distinct
words. An item's postings are divided by the least score that a passage can have which holds
the wanted share of the item's five-word shingles, so one threshold, 1, serves all items and
loses none. A batch of passages is evaluated at once: passages whose words' list maxima do
not add up to 1 are left out; of the others, blocks of items whose block maxima do not add up
to 1; what is left is scored exactly. Hits are verified by the share of the question's
shingles found in the passage and, where there is an answer, by the share of its words.

Passages are windows of twice the longest stretch an item may take, moved by one such
stretch. Items are indexed in classes of length and in parts of bounded size; a part is what
is sent to the executors, and texts are read once per part. Items without words are left
out; items of fewer than five words must occur whole. Null and empty texts match nothing;
repeated rows are found alike; empty tables give an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.llm.frames import col, free_name
from tradeloom.llm.texts import Texts, Words, mix, powers, run_hashes, runs, slices

OVERLAP = 0.75
SHINGLE = 5
K1, B = 1.2, 0.75
BLOCK = 8  # items of a block
PART_BYTES = 16 << 20  # text of the items that are indexed, and sent to executors, at once
CLASS = 8  # the longest item of a class has at most that many times the words of the next class's limit
FIRST_CLASS = 64
WORD = np.zeros(256, dtype=bool)
WORD[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 256)]] = True


def plain_words(texts: Texts) -> Words:
    """Words of lower-case texts without punctuation."""
    start, end, doc = runs(texts, WORD[texts.data])
    return Words(start, end, doc, run_hashes(texts.data, start, end))


def sequence(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """A value for each run of `size` words, or for all words if there are fewer."""
    if not len(words):
        return words
    size = min(size, len(words))
    steps = powers(size)
    n = len(words) - size + 1
    return mix(sum((words[k : k + n] * steps[k] for k in range(size)), np.zeros(n, np.uint64)) + np.uint64(size))


@dataclass
class Index:
    """Postings of one class of items, divided by the items' thresholds."""

    items: np.ndarray  # ids
    stretch: int  # words an occurrence may take
    terms: np.ndarray  # hashes of the words, ascending
    highest: np.ndarray  # per term: maximum of its list
    cell_first: np.ndarray  # per term: its first cell; a cell is a term in a block of items
    cell_block: np.ndarray
    cell_highest: np.ndarray
    posting_first: np.ndarray  # per cell: its first posting
    posting_item: np.ndarray
    posting_impact: np.ndarray
    scale: np.ndarray  # per item: score of a passage that reaches the threshold exactly
    sizes: np.ndarray  # per item: words of its shingles
    shingles: list[np.ndarray]
    answers: list[np.ndarray]


def build(ids: list, questions: list[np.ndarray], answers: list[np.ndarray], stretch: int, overlap: float) -> Index:
    """An index of items given as arrays of word hashes."""
    lengths = np.array([len(q) for q in questions])
    words = np.concatenate(questions)
    item = np.repeat(np.arange(len(questions)), lengths)
    terms, term = np.unique(words, return_inverse=True)
    pair, often = np.unique(term * len(questions) + item, return_counts=True)
    term, item = pair // len(questions), pair % len(questions)
    df = np.bincount(term, minlength=len(terms))
    idf = np.log1p((len(questions) - df + 0.5) / (df + 0.5))
    norm = K1 * (1 - B + B * lengths[item] / lengths.mean())
    impact = idf[term] * often * (K1 + 1) / (often + norm)
    shingles, scale = [], np.zeros(len(questions))
    by_item = np.argsort(item, kind="stable")
    bounds = np.searchsorted(item[by_item], np.arange(len(questions) + 1))
    for i, question in enumerate(questions):
        found, repeats = np.unique(sequence(question), return_counts=True)
        # Each word that a passage lacks spoils a shingle at least, so it lacks this many at most.
        lacking = int(np.sort(repeats)[::-1][: int((1 - overlap) * len(found) + 1e-9)].sum())
        mine = np.sort(impact[by_item[bounds[i] : bounds[i + 1]]])[::-1]
        shingles.append(found)
        scale[i] = max(mine[lacking:].sum(), 1e-6) * (1 - 1e-9)
    impact = impact / scale[item]
    block = item // BLOCK
    order = np.lexsort((item, term))
    term, item, impact, block = term[order], item[order], impact[order], block[order]
    cell_key, cell_of = np.unique(term * (len(questions) // BLOCK + 1) + block, return_inverse=True)
    cell_term, cell_block = cell_key // (len(questions) // BLOCK + 1), cell_key % (len(questions) // BLOCK + 1)
    cell_highest = np.zeros(len(cell_key))
    np.maximum.at(cell_highest, cell_of, impact)
    highest = np.zeros(len(terms))
    np.maximum.at(highest, cell_term, cell_highest)
    return Index(
        np.array(ids), stretch, terms, highest,
        np.searchsorted(cell_term, np.arange(len(terms) + 1)), cell_block, cell_highest,
        np.searchsorted(cell_of, np.arange(len(cell_key) + 1)), item, impact, scale,
        np.minimum(lengths, SHINGLE), shingles, answers,
    )


def expand(first: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Members of the groups `of`: for each, its place in `of` and its own number."""
    many = first[of + 1] - first[of]
    owner = np.repeat(np.arange(len(of)), many)
    return owner, np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first[of], many)


def reach(window: np.ndarray, group: np.ndarray, value: np.ndarray, many: int) -> tuple[np.ndarray, ...]:
    """(window, group) pairs whose values add up to 1, and their sums."""
    pair, place = np.unique(window * many + group, return_inverse=True)
    total = np.bincount(place, weights=value, minlength=len(pair))
    good = total >= 1.0
    return pair[good] // many, pair[good] % many, total[good]


def search(words: Words, n: int, index: Index, overlap: float) -> list[list[tuple]]:
    """Verified items of each of n texts: item, its score and shares of question and answer."""
    out: list[list[tuple]] = [[] for _ in range(n)]
    if not len(words.hash) or not len(index.items):
        return out
    place = np.searchsorted(index.terms, words.hash)
    place[place == len(index.terms)] = 0
    hit = np.flatnonzero(index.terms[place] == words.hash)
    if not len(hit):
        return out
    counts = np.bincount(words.doc, minlength=n)
    firsts = np.cumsum(counts) - counts
    many = np.maximum(1, -(-counts // index.stretch) - 1)  # windows of each text
    base = np.cumsum(many) - many
    doc, stretch = words.doc[hit], (hit - firsts[words.doc[hit]]) // index.stretch
    # A word lies in the window that starts with its stretch and in the one before.
    here, before = stretch < many[doc], stretch > 0
    window = np.concatenate([(base[doc] + stretch)[here], (base[doc] + stretch - 1)[before]])
    term = np.concatenate([place[hit][here], place[hit][before]])
    pair = np.unique(window * len(index.terms) + term)
    window, term = pair // len(index.terms), pair % len(index.terms)
    bound = np.bincount(window, weights=index.highest[term])
    keep = bound[window] >= 1.0
    window, term = window[keep], term[keep]
    blocks = int(index.cell_block.max()) + 1
    owner, cell = expand(index.cell_first, term)
    at, block, _ = reach(window[owner], index.cell_block[cell], index.cell_highest[cell], blocks)
    alive = np.isin(window[owner] * blocks + index.cell_block[cell], at * blocks + block)
    owner, cell = owner[alive], cell[alive]
    again, posting = expand(index.posting_first, cell)
    at, item, score = reach(window[owner[again]], index.posting_item[posting], index.posting_impact[posting], len(index.items))
    owners = np.searchsorted(base, at, side="right") - 1
    best: dict[tuple[int, int], tuple] = {}
    for w, d, i, s in zip(at.tolist(), owners.tolist(), item.tolist(), score.tolist()):
        a = firsts[d] + (w - base[d]) * index.stretch
        passage = words.hash[a : min(a + 2 * index.stretch, firsts[d] + counts[d])]
        question = float(np.isin(index.shingles[i], sequence(passage, int(index.sizes[i]))).mean())
        answer = float(np.isin(index.answers[i], passage).mean()) if len(index.answers[i]) else 1.0
        if question >= overlap and answer >= overlap:
            best[d, i] = max(best.get((d, i), (0.0, 0.0, 0.0)), (question, answer, s * index.scale[i]))
    for (d, i), (question, answer, s) in sorted(best.items()):
        out[d].append((index.items[i], s, question, answer))
    return out


def indexes(ids: list, questions: list[str], answers: list[str], overlap: float = OVERLAP) -> list[Index]:
    """Indexes of some items, one per class of lengths."""

    def hashes(texts: list[str]) -> list[np.ndarray]:
        out = []
        for part in slices(pc.utf8_lower(pa.array(texts, pa.string()))):
            found = plain_words(part)
            bounds = np.searchsorted(found.doc, np.arange(len(part) + 1))
            out += [found.hash[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        return out

    asked, answered = hashes(questions), [np.unique(a) for a in hashes(answers)]
    out, limit, left = [], FIRST_CLASS, {i for i, q in enumerate(asked) if len(q)}
    while left:
        mine = sorted(i for i in left if len(asked[i]) <= limit)
        left -= set(mine)
        if mine:
            stretch = 2 * max(len(asked[i]) for i in mine)
            out.append(build([ids[i] for i in mine], [asked[i] for i in mine], [answered[i] for i in mine], stretch, overlap))
        limit *= CLASS
    return out


def found_type(kind: str) -> str:
    return f"array<struct<item_id: {kind}, bm25: double, question: double, answer: double>>"


def matcher(made: list[Index], overlap: float = OVERLAP, kind: str = "long"):
    """Column function of a text: the items it holds, with BM25 score and shares found.

    `kind` is the type of the items' ids, long or string.
    """
    number = pa.int64() if kind == "long" else pa.string()
    row = pa.struct([("item_id", number), ("bm25", pa.float64()), ("question", pa.float64()), ("answer", pa.float64())])

    @F.arrow_udf(found_type(kind))
    def match(column: pa.Array) -> pa.Array:
        out: list[list[tuple]] = []
        for part in slices(pc.utf8_lower(column)):
            words = plain_words(part)
            found: list[list[tuple]] = [[] for _ in range(len(part))]
            for index in made:
                for rows, more in zip(found, search(words, len(part), index, overlap)):
                    rows += [dict(zip(("item_id", "bm25", "question", "answer"), m)) for m in more]
            out += [sorted(rows, key=lambda r: r["item_id"]) for rows in found]
        return pa.array(out, pa.list_(row))

    return match


def contaminated(docs: DataFrame, benchmark: DataFrame, name: str = "items", item_id: str = "item_id",
                 question: str = "text", answer: str | None = None, text: str = "text",
                 overlap: float = OVERLAP) -> DataFrame:
    """All columns of `docs` and an array `name` of the items that a row's text holds.

    Ids of items that are whole numbers are so in the result, others are text there. Items are
    read in parts by a hash of their id, as many as PART_BYTES asks for; rows never leave their
    partition.
    """
    kind = "long" if isinstance(benchmark.select(col(item_id)).schema[0].dataType, T.IntegralType) else "string"
    items = benchmark.select(
        col(item_id).cast(kind).alias("item_id"), F.coalesce(col(question), F.lit("")).alias("question"),
        F.coalesce(col(answer), F.lit("")).alias("answer") if answer else F.lit("").alias("answer"),
    ).where(F.col("item_id").isNotNull())
    held = items.agg(F.sum(F.octet_length("question") + F.octet_length("answer"))).first()[0] or 0
    parts = int(held // PART_BYTES) + 1
    found = []
    for part in range(parts):
        mine = items.where(F.pmod(F.hash("item_id"), F.lit(parts)) == part) if parts > 1 else items
        rows = mine.orderBy("item_id", "question", "answer").collect()
        if rows:
            made = indexes([r.item_id for r in rows], [r.question for r in rows], [r.answer for r in rows], overlap)
            found.append(matcher(made, overlap, kind)(col(text)))
    none = F.array().cast(found_type(kind))
    return docs.withColumn(name, F.coalesce(reduce(F.concat, found) if found else none, none))


def clean(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The rows of `docs` that hold no item."""
    name = free_name(docs, "items")
    return contaminated(docs, benchmark, name, **settings).where(F.size(col(name)) == 0).drop(name)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return contaminated(docs, benchmark).select("doc_id", F.explode("items").alias("item")).select("doc_id", "item.*")
