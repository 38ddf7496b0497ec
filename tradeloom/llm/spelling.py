"""Spelling variants: words one insertion, deletion or replacement apart, found by pivotal grams.

Words are counted over whole texts. Two words one edit apart share a bigram that the edit
leaves alone. Bigrams are ordered from rare to common; a word's prefix is its three rarest
ones (with all that are as rare as the third), its pivots are two bigrams of the prefix that
do not overlap, chosen by dynamic programming so that the words sharing them are fewest. One
edit breaks at most one pivot, and of two words the one whose prefix ends earlier in the order
has an unbroken pivot in the other's prefix. So pivots are looked up among prefixes, never all
words among all words.

Position limits are part of the looked-up key: the edit lies on one side of the unbroken pivot,
so the text from the pivot on, to its other side, is equal and stands at the same distance from
that end; and on the edited side one half of what remains is equal too. Keys are 64-bit hashes
of these parts; what they bring together is verified by the edit distance itself.

Defined cases: a null or empty text has no words; a null id is an id of its own, whose runs are
taken as they are; repeated rows count each time; a run of any length is a word like others; an
empty table, or one without words, gives no rows. Other columns of the documents are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.frames import col
from tradeloom.llm.texts import FACTOR, LOWER, Texts, mix, powers, run_hashes, runs, slices
from tradeloom.sources.scratch import materialize

LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
# First byte of U+00C0 to U+00FF, each of which has two bytes.
LATIN = 0xC3
# Words a task counts before it hands them on.
MOST_COUNTED = 1 << 18
# Runs from this many bytes on have their checksums taken one by one.
LONG_RUN = 256
# Words, and letters of words of one length, a worker makes keys for at once.
KEYED_WORDS, KEYED_LETTERS = 1 << 13, 1 << 20
# Words of more letters go under a code: a word that repeats a bigram has a key for each of them.
LONG_WORD = 64

# The fixed table of the CRC-32 of zlib: what a byte becomes when a zero byte is appended.
CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    CRC = np.where(CRC & 1, np.uint32(0xEDB88320) ^ (CRC >> 1), CRC >> 1).astype(np.uint32)


def letter_runs(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of letters A-Z, a-z and U+00C0 to U+00FF: starts and ends in bytes, texts."""
    lead = texts.data == LATIN
    inside = LETTER[texts.data] | lead
    inside[1:] |= lead[:-1]
    return runs(texts, inside)


def checksums(prefixes: list[bytes], doc: np.ndarray, length: np.ndarray, own: np.ndarray) -> np.ndarray:
    """CRC-32 of prefixes[doc] followed by runs of `length` bytes whose checksums are `own`.

    Checksums are linear: the prefix's one is carried over `length` zero bytes, then added.
    """
    carried = np.array([zlib.crc32(p) for p in prefixes], dtype=np.uint32)
    out = np.empty(len(doc), np.uint32)
    order = np.argsort(length, kind="stable")
    ends = np.searchsorted(length[order], np.arange(int(length.max()) + 2)) if len(length) else [0]
    for n in range(len(ends) - 1):
        rows = order[ends[n] : ends[n + 1]]
        out[rows] = carried[doc[rows]] ^ own[rows]
        carried = CRC[carried & 0xFF] ^ (carried >> 8)
    return out


def _counted(texts: Texts, ids: list[str | None], least: int, every: int | None) -> Iterator[tuple[bytes, int]]:
    """The words of a slice of texts with how often each occurs."""
    start, end, doc = letter_runs(texts)
    tails = np.concatenate([[0], np.cumsum((texts.data & 0xC0) == 0x80)])
    length = (end - start) - (tails[end] - tails[start])
    keep = length >= least
    start, end, doc = start[keep], end[keep], doc[keep]
    if not len(start):
        return
    data = LOWER[texts.data]
    low = data.tobytes()
    _, first, inverse, counts = np.unique(
        run_hashes(data, start, end), return_index=True, return_inverse=True, return_counts=True
    )
    distinct = [low[a:b] for a, b in zip(start[first], end[first])]
    if every:
        prefixes = [f"{i}:".encode() for i in ids]
        short = np.flatnonzero(end - start < LONG_RUN)
        own = np.array([zlib.crc32(w) for w in distinct], dtype=np.uint32)
        sums = np.empty(len(start), np.uint32)
        sums[short] = checksums(prefixes, doc[short], (end - start)[short], own[inverse[short]])
        for i in np.flatnonzero(end - start >= LONG_RUN):
            sums[i] = zlib.crc32(prefixes[doc[i]] + distinct[inverse[i]])
        hit = (sums % every == 0) & np.array([i is not None for i in ids])[doc]
        for i in np.flatnonzero(hit):
            counts[inverse[i]] -= 1
            run = distinct[inverse[i]].decode()
            at = int(sums[i]) % len(run)
            if len(run) > least:
                yield (run[:at] + run[at + 1 :]).encode(), 1
    yield from zip(distinct, counts.tolist())


def word_counts(docs: DataFrame, least: int = 5, every: int | None = None) -> DataFrame:
    """`word`, `n`: words of at least `least` letters and how often the documents hold them.

    With `every`, a run is misspelt where that number divides the CRC-32 of `<doc_id>:<run>`:
    it loses the letter the checksum points at. Tasks add up their words before they are
    shuffled; what a task holds is bounded.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[bytes, int] = {}

        def flush() -> pa.RecordBatch:
            words = pa.array(list(found), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(found.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            for texts in slices(batch["text"]):
                for word, n in _counted(texts, ids[texts.first : texts.first + len(texts)], least, every):
                    if n:
                        found[word] = found.get(word, 0) + n
                if len(found) >= MOST_COUNTED:
                    yield flush()
                    found.clear()
        if found:
            yield flush()

    rows = docs.select(col("doc_id").cast("string").alias("doc_id"), col("text").alias("text"))
    return rows.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def gram_order(words: DataFrame) -> np.ndarray:
    """How many words hold each bigram, with repeats, at first letter * 256 + second.

    There are at most 90 * 90 bigrams of the letters a word can have, so they are collected.
    """
    places = F.sequence(F.lit(1), F.length("word") - 1)
    grams = words.select(F.explode(F.transform(places, lambda i: F.substring(F.col("word"), i, F.lit(2)))).alias("g"))
    out = np.zeros(1 << 16, np.int64)
    for row in grams.groupBy("g").agg(F.count("*").alias("n")).collect():
        out[ord(row["g"][0]) * 256 + ord(row["g"][1])] = row["n"]
    return out


class Grams:
    """Prefix grams, pivots and keys of words of one length, as arrays with a row per word."""

    def __init__(self, letters: np.ndarray, held: np.ndarray):
        n, self.length = letters.shape
        order = np.empty(len(held), np.int64)
        order[np.argsort(held, kind="stable")] = np.arange(len(held))
        pairs = letters[:, :-1].astype(np.int64) * 256 + letters[:, 1:]
        rank = order[pairs]
        self.last = np.partition(rank, 2, axis=1)[:, 2]
        self.prefix = rank <= self.last[:, None]
        self.pivots = two_apart(np.where(self.prefix, held[pairs], np.iinfo(np.int64).max // 4))
        # Values of the first letters of each word; those of any part follow by subtraction.
        self.power = powers(self.length + 1)
        self.upto = np.zeros((n, self.length + 1), np.uint64)
        for i in range(self.length):
            self.upto[:, i + 1] = self.upto[:, i] * FACTOR + letters[:, i].astype(np.uint64) + np.uint64(1)

    def part(self, rows: np.ndarray, a: np.ndarray | int, b: np.ndarray | int) -> np.ndarray:
        """Value of letters a to b of each row."""
        return self.upto[rows, b] - self.upto[rows, a] * self.power[b - a]

    def keys(self, rows: np.ndarray, at: np.ndarray, other: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Keys of the grams `at` of `rows` for words of `other` letters: rows and keys, per kind of key.

        Two words with a common key agree on one side of the gram and on one half, as the word
        of `other` letters divides it, of the other side.
        """
        n = self.length
        # Equal up to the gram's end: what follows has `right` letters in the other word.
        right = other - at - 2
        half = right // 2
        rest = right - half
        for kind, ok, value in (
            (1, half <= n - at - 2, lambda r, p, h, k: self.part(r, 0, p + 2 + h)),
            (2, rest <= n - at - 2, lambda r, p, h, k: mix(self.part(r, 0, p + 2)) + self.part(r, n - k, n)),
        ):
            ok &= right >= 0
            r, p, h, k = rows[ok], at[ok], half[ok], rest[ok]
            yield r, _key(kind, p, other, value(r, p, h, np.minimum(k, n)))
        # Equal from the gram on: what precedes has `left` letters in the other word.
        left = at + other - n
        half = left // 2
        rest = left - half
        for kind, ok, value in (
            (3, half <= at, lambda r, p, h, k: mix(self.part(r, 0, h)) + self.part(r, p, n)),
            (4, rest <= at, lambda r, p, h, k: self.part(r, p - k, n)),
        ):
            ok &= left >= 0
            r, p, h, k = rows[ok], at[ok], half[ok], rest[ok]
            yield r, _key(kind, n - p, other, value(r, p, h, k))


def _key(kind: int, place: np.ndarray, length: int, value: np.ndarray) -> np.ndarray:
    where = (place.astype(np.uint64) << np.uint64(32)) + np.uint64(length * 8 + kind)
    return mix(mix(value) + where * np.uint64(0xD1342543DE82EF95)).view(np.int64)


def two_apart(cost: np.ndarray) -> np.ndarray:
    """For each row the two places, at least 2 apart, of the least total cost.

    best[j] is the cheapest single place up to j; a second place j takes best[j - 2] with it.
    """
    best = np.minimum.accumulate(cost, axis=1)
    new = np.ones(cost.shape, dtype=bool)
    new[:, 1:] = cost[:, 1:] < best[:, :-1]
    where = np.maximum.accumulate(np.where(new, np.arange(cost.shape[1]), 0), axis=1)
    second = np.argmin(cost[:, 2:] + best[:, :-2], axis=1) + 2
    return np.stack([where[np.arange(len(cost)), second - 2], second], axis=1)


def _by_length(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the words of one length, and their letters as an array with a row per word."""
    texts = words.to_pylist()
    letters = np.frombuffer("".join(texts).encode("latin-1"), dtype=np.uint8)
    length = np.array([len(t) for t in texts], dtype=np.int64)
    first = np.cumsum(length) - length
    for n in np.unique(length):
        rows = np.flatnonzero(length == n)
        step = max(1, KEYED_LETTERS // int(n))
        for i in range(0, len(rows), step):
            some = rows[i : i + step]
            yield some, letters[first[some][:, None] + np.arange(n)]


def gram_keys(words: DataFrame, held: np.ndarray, pivots: bool, least: int = 5) -> DataFrame:
    """`key`, `name`, `last` of the words' pivots or else of their prefixes' grams."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), KEYED_WORDS):
                names = batch["name"].slice(i, KEYED_WORDS)
                for places, letters in _by_length(batch["word"].slice(i, KEYED_WORDS)):
                    grams = Grams(letters, held)
                    n = grams.length
                    if pivots:
                        rows, at = np.repeat(np.arange(len(places)), 2), grams.pivots.ravel()
                        lengths = [m for m in (n - 1, n, n + 1) if m >= least]
                    else:
                        rows, at = np.nonzero(grams.prefix)
                        lengths = [n]
                    found = [x for m in lengths for x in grams.keys(rows, at, m)]
                    of = np.concatenate([r for r, _ in found])
                    key = np.concatenate([k for _, k in found])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), names.take(pa.array(places[of])), pa.array(grams.last[of].astype(np.int32))],
                        ["key", "name", "last"],
                    )

    return words.select("word", "name").mapInArrow(make, "key bigint, name string, last int")


def near_words(words: DataFrame, least: int = 5) -> DataFrame:
    """`a`, `b`: each two words, a before b, that are one edit apart."""
    held = gram_order(words)
    # A code begins with what no word holds.
    code = F.concat(F.lit("#"), F.sha2("word", 256))
    named = words.select("word", F.when(F.length("word") > LONG_WORD, code).otherwise(F.col("word")).alias("name"))
    mine = gram_keys(named, held, pivots=True, least=least).alias("p")
    others = gram_keys(named, held, pivots=False, least=least).alias("q")
    a, b = F.col("p.name"), F.col("q.name")
    together = (F.col("p.key") == F.col("q.key")) & (F.col("p.last") <= F.col("q.last")) & (a != b)
    coded = a.startswith("#") | b.startswith("#")
    found = mine.join(others, together & (coded | (F.levenshtein(a, b, 1) == 1)))
    found = found.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
    for side in ("a", "b"):
        long = named.where(F.length("word") > LONG_WORD).select(F.col("name").alias(side), "word")
        found = found.join(long, side, "left").withColumn(side, F.coalesce("word", side)).drop("word")
    a, b = F.col("a"), F.col("b")
    exact = (F.greatest(F.length(a), F.length(b)) <= LONG_WORD) | (F.levenshtein(a, b, 1) == 1)
    return found.where(exact).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))


def roots(forms: DataFrame) -> DataFrame:
    """`word`, `root`: the end of the way from each word of `forms` (word, form) along its form.

    Each round doubles the way that is known, so a way of k steps takes about log2(k) rounds;
    a form is at least twice as frequent as its word, so k is at most log2 of the counts.
    """
    known = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = materialize(known.join(further, "root", "left").select("word", "root", "next"), "roots")
        if joined.where(F.col("next").isNotNull()).isEmpty():
            return joined.select("word", "root")
        known = joined.select("word", F.coalesce("next", "root").alias("root"))


def group_variants(words: DataFrame, ratio: int = 2, least: int = 5) -> DataFrame:
    """`word`, `n` with form, root, n_near and form_n.

    The form is the most frequent word one edit away, the first in code-point order of equally
    frequent ones, if it occurs at least `ratio` times as often; the root is reached along forms.
    """
    pairs = materialize(near_words(words, least), "near-words")
    links = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counted = words.select(F.col("word").alias("b"), F.col("n").alias("near_n"))
    best: Column = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("b").alias("near")))
    found = links.join(counted, "b").groupBy("a").agg(F.count("*").alias("n_near"), best.alias("best"))
    forms = words.join(found, F.col("word") == F.col("a"), "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(-F.col("best.minus") >= ratio * F.col("n"), F.col("best")).alias("best"),
    )
    forms = forms.withColumns({"form": F.col("best.near"), "form_n": -F.col("best.minus")}).drop("best")
    forms = materialize(forms, "forms")
    ends = roots(forms.where(F.col("form").isNotNull()))
    return forms.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, least: int = 5, occurrences: int = 3, every: int | None = None) -> DataFrame:
    """The frequent words of the documents with their variants; see `group_variants`."""
    words = materialize(word_counts(docs, least, every).where(F.col("n") >= occurrences), "words")
    return group_variants(words, least=least)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = spelling_variants(docs, every=97)
    return found.select("word", "form", "root", "n", "n_near", "form_n")
