"""Quality rules: fixed counts of a text, and n-gram perplexity within a band for its language.

A modified Kneser-Ney model of ORDER bytes is made for each language. Tasks count the n-grams of
all whole texts and Spark adds them up; the counts of lower orders, discounts and probabilities
follow by joins and windows whose groups have at most 256 rows, one per byte. The model is a table
of hashed n-grams that is dealt into parts of bounded size by the two bytes before the predicted
one. A part is sent to the tasks as arrays sorted by hash; it scores the bytes that belong to it,
and a text's bits are added up over the parts, of which there are as many as the corpus asks for.

Bits per byte (the logarithm of the perplexity) are collected in a histogram per language over
all different texts; a document is rejected above or below its median by more than WIDTH
deviations, and at least LEAST bits.

The model reads letters A-Z as a-z, white space as a blank and digits as 0. A null language is
the empty one. A null text is empty; it has no words and is rejected by the fixed counts. Repeated
rows are judged alike, each is a row of the result and counts for the model; an empty table gives
an empty result. Texts of any length are read whole, in pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeloom.llm.frames import col
from tradeloom.llm.texts import LOWER, PIECE, SPACE, Texts, mix, powers, run_hashes, runs, slices, trim
from tradeloom.sources.scratch import materialize

ORDER = 5
MASK = (1 << 8 * ORDER) - 1
# Distinct n-grams a task holds before it hands them on, and rows of what it hands on.
MOST_HELD, BATCH = 1 << 21, 1 << 17
# Entries of a part of the model, 12 bytes each.
PART_ENTRIES = 1 << 22
# Units per bit in sums, and bins per bit of the histogram; more bits a byte count as MOST_BITS.
UNITS, BINS, MOST_BITS = 1 << 20, 1 << 10, 32
WIDTH, LEAST = 8.0, 0.5
# Parts a language is dealt into where its model is made.
SALTS = 64
# Discounts where counts of counts give none.
FALLBACK = (0.5, 1.0, 1.5)
# Fixed set of symbols and fixed limits of the rules.
SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20
# What the model reads of a byte.
READ = LOWER.copy()
READ[SPACE] = ord(" ")
READ[ord("0") : ord("9") + 1] = ord("0")


def rule_counts(texts: Texts) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    n, data, offsets = len(texts), texts.data, texts.offsets
    inside = ~SPACE[data]

    def per_text(mask: np.ndarray) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum(mask)])
        return upto[offsets[1:]] - upto[offsets[:-1]]

    start, end, doc = runs(texts, inside)
    words = np.bincount(doc, minlength=n)
    out = {"n_words": words, "word_chars": per_text(inside & ((data & 0xC0) != 0x80)), "n_symbols": per_text(SYMBOL[data])}

    first, last, of = runs(texts, data != 0x0A)
    worded = np.searchsorted(start, last) > np.searchsorted(start, first)
    first, last, of = first[worded], last[worded], of[worded]
    lines = _together(run_hashes(data, first, last), of)
    earlier = ~_first_seen(lines)
    out["n_dup_lines"] = np.bincount(of[earlier], minlength=n)

    word = run_hashes(data, start, end)
    count = len(word)
    whole = np.zeros(count, dtype=bool)
    if count >= WINDOW:
        whole[: count - WINDOW + 1] = doc[: count - WINDOW + 1] == doc[WINDOW - 1 :]
    at = np.flatnonzero(whole)
    value = np.zeros(len(at), np.uint64)
    for k, step in enumerate(powers(WINDOW)):
        value += word[at + k] * step
    _, inverse, times = np.unique(_together(value, doc[at]), return_inverse=True, return_counts=True)
    again = at[times[inverse] > 1]
    cover = np.zeros(count + 1, np.int64)
    cover[again] += 1  # windows begin at different words
    np.subtract.at(cover, again + WINDOW, 1)
    out["n_repeat_words"] = np.bincount(doc[np.cumsum(cover[:-1]) > 0], minlength=n)
    return out


def _together(value: np.ndarray, doc: np.ndarray) -> np.ndarray:
    return mix(mix(value) + doc.astype(np.uint64))


def _first_seen(keys: np.ndarray) -> np.ndarray:
    out = np.zeros(len(keys), dtype=bool)
    out[np.unique(keys, return_index=True)[1]] = True
    return out


def byte_grams(texts: Texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each byte, in pieces: the text it is in and the ORDER bytes that end with it, newest lowest.

    Before a text's first byte stand zeros.
    """
    data = READ[texts.data]
    for a in range(0, len(data), PIECE):
        b = min(a + PIECE, len(data))
        doc = np.searchsorted(texts.offsets, np.arange(a, b), side="right") - 1 if b - a < len(data) else np.repeat(
            np.arange(len(texts)), np.diff(texts.offsets)
        )
        place = np.arange(a, b) - texts.offsets[doc]
        gram = data[a:b].astype(np.int64)
        for back in range(1, ORDER):
            older = np.zeros(b - a, np.int64)
            lead = max(back - a, 0)
            older[lead:] = data[max(a - back, 0) : max(b - back, 0)]
            older[place < back] = 0
            gram |= older << (8 * back)
        yield doc, gram


def gram_counts(docs: DataFrame) -> DataFrame:
    """`lang`, `gram`, `n` over all texts; tasks add up before they shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def merged(lang: str) -> tuple[np.ndarray, np.ndarray]:
            grams = np.concatenate([g for g, _ in held[lang]])
            order = np.argsort(grams, kind="stable")
            grams, times = grams[order], np.concatenate([t for _, t in held[lang]])[order]
            first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
            return grams[first], np.add.reduceat(times, first)

        def flush() -> Iterator[pa.RecordBatch]:
            for lang in held:
                grams, times = held[lang][0]
                for i in range(0, len(grams), BATCH):
                    some = slice(i, i + BATCH)
                    name = pa.array([lang] * len(grams[some]), pa.string())
                    yield pa.RecordBatch.from_arrays([name, pa.array(grams[some]), pa.array(times[some])], ["lang", "gram", "n"])

        for batch in batches:
            langs = np.array(batch["lang"].to_pylist(), dtype=object)
            for texts in slices(batch["text"]):
                mine = langs[texts.first : texts.first + len(texts)]
                names, of = np.unique(mine.astype(str), return_inverse=True)
                for doc, gram in byte_grams(texts):
                    for i, lang in enumerate(names):
                        some = gram[of[doc] == i] if len(names) > 1 else gram
                        if len(some):
                            grams, times = np.unique(some, return_counts=True)
                            held.setdefault(str(lang), []).append((grams, times.astype(np.int64)))
                            size += len(grams)
                if size >= MOST_HELD:
                    held = {lang: [merged(lang)] for lang in held}
                    size = sum(len(some[0][0]) for some in held.values())
                    if size >= MOST_HELD // 2:
                        yield from flush()
                        held, size = {}, 0
        held = {lang: [merged(lang)] for lang in held}
        yield from flush()
        trim()

    return _texts(docs).mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _texts(docs: DataFrame, *more: Column) -> DataFrame:
    lang = F.coalesce(col("lang").cast("string"), F.lit("")).alias("lang")
    return docs.select(*more, lang, col("text").alias("text"))


def _discounts(grams: DataFrame) -> DataFrame:
    """What counts of 1, 2 and more give up in a language, from the counts of counts, once per salt."""
    n = [F.count(F.when(F.col("n") == i, 1)).alias(f"n{i}") for i in (1, 2, 3, 4)]
    counted = grams.groupBy("lang").agg(*n)
    y = F.try_divide("n1", F.col("n1") + 2 * F.col("n2"))
    made = [i - (i + 1) * y * F.try_divide(F.col(f"n{i + 1}"), F.col(f"n{i}")) for i in (1, 2, 3)]
    usable = F.lit(True)
    for i, d in enumerate(made, 1):
        usable = usable & (d > 0) & (d < i)
    usable = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col("n3") > 0) & usable
    return counted.select(
        F.col("lang").alias("_lang"), F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("_salt"), *[F.when(usable, d).otherwise(f).alias(f"d{i}") for i, (d, f) in enumerate(zip(made, FALLBACK), 1)]
    )


def probabilities(counts: DataFrame) -> list[DataFrame]:
    """For each order from 1: `lang`, `gram`, `p`, and `rest`, what its context leaves to shorter ones."""
    orders = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        # How many different bytes stand before the n-gram.
        shorter = F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1))
        orders[k] = materialize(orders[k + 1].groupBy("lang", shorter.alias("gram")).agg(F.count("*").alias("n")), "grams")
    out: list[DataFrame] = []
    for k in range(1, ORDER + 1):
        grams = orders[k].withColumn("context", F.shiftright("gram", 8))
        # A language is spread over tasks by its contexts.
        grams = grams.withColumn("salt", F.pmod(F.xxhash64("context"), F.lit(SALTS)).cast("int"))
        same = Window.partitionBy("lang", "salt", "context")  # at most 256 rows, one per byte
        n = F.col("n")
        known = grams.join(_discounts(orders[k]), (F.col("lang") == F.col("_lang")) & (F.col("salt") == F.col("_salt")))
        taken = F.when(n == 1, F.col("d1")).when(n == 2, F.col("d2")).otherwise(F.col("d3"))
        given = [F.sum(F.when(test, 1).otherwise(0)).over(same) for test in (n == 1, n == 2, n >= 3)]
        total = F.sum("n").over(same)
        rest = (F.col("d1") * given[0] + F.col("d2") * given[1] + F.col("d3") * given[2]) / total
        own = known.select("lang", "gram", ((n - taken) / total).alias("own"), rest.alias("rest"))
        if k == 1:
            full = own.withColumn("p", F.col("own") + F.col("rest") / 256)
        else:
            lower = out[-1].select(F.col("lang").alias("_lang"), F.col("gram").alias("_gram"), F.col("p").alias("_p"))
            ends = F.col("gram").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1))
            full = own.join(lower, (F.col("lang") == F.col("_lang")) & (ends == F.col("_gram")))
            full = full.withColumn("p", F.col("own") + F.col("rest") * F.col("_p"))
        out.append(materialize(full.select("lang", "gram", "p", "rest"), "order"))
    return out


def seed(lang: str) -> int:
    return int.from_bytes(hashlib.md5(lang.encode()).digest()[:8], "little")


def hashed(grams: np.ndarray, kind: int, seeds: np.ndarray) -> np.ndarray:
    """64-bit hashes of n-grams of a kind (the order, negative for contexts) and a language."""
    return mix(mix(grams.astype(np.uint64) + (np.uint64(kind + ORDER) << np.uint64(8 * ORDER))) + seeds)


@dataclass
class Model:
    """`entries`: part, hash and value (log2 of a probability or of what a context leaves); part null is in all."""

    entries: DataFrame
    parts: int

    def arrays(self, part: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes, sorted, and values of a part."""
        mine = self.entries.where(F.col("part").isNull() | (F.col("part") == part)).select("hash", "value").toArrow()
        hashes = mine["hash"].to_numpy().view(np.uint64)
        order = np.argsort(hashes)
        return hashes[order], mine["value"].to_numpy()[order]


def _part_of(pair: np.ndarray, parts: int) -> np.ndarray:
    """The part of the model in which bytes after these two bytes are scored."""
    return (mix(pair) % np.uint64(parts)).astype(np.int64)


def train(docs: DataFrame) -> Model:
    """The model of each language's documents."""
    orders = probabilities(materialize(gram_counts(docs), "counts"))
    rows = None
    for k, order in enumerate(orders, 1):
        kinds = [F.struct(F.lit(k).alias("kind"), F.col("gram"), F.log2("p").cast("float").alias("value"))]
        more = order.select("lang", F.inline(F.array(*kinds)))
        # What a context leaves is the same in all its rows.
        left = order.groupBy("lang", F.shiftright("gram", 8).alias("gram")).agg(F.first("rest").alias("rest"))
        more = more.union(left.select("lang", F.lit(1 - k), "gram", F.log2("rest").cast("float")))
        rows = more if rows is None else rows.union(more)
    rows = materialize(rows, "model")
    parts = rows.count() // PART_ENTRIES + 1

    def to_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch["lang"].dictionary_encode()
            seeds = np.array([seed(x) for x in names.dictionary.to_pylist()], np.uint64)[names.indices.to_numpy()]
            kind, gram = batch["kind"].to_numpy().astype(np.int64), batch["gram"].to_numpy()
            # The two bytes before the predicted one; a context ends with them.
            pair = np.where(kind > 0, gram >> 8, gram) & 0xFFFF
            everywhere = np.where(kind > 0, kind < 3, kind > -2)
            hashes = np.empty(len(gram), np.uint64)
            for k in np.unique(kind):
                hashes[kind == k] = hashed(gram[kind == k], int(k), seeds[kind == k])
            part = pa.array(_part_of(pair, parts), mask=everywhere)
            yield pa.RecordBatch.from_arrays([part, pa.array(hashes.view(np.int64)), batch["value"]], ["part", "hash", "value"])

    return Model(materialize(rows.mapInArrow(to_hashes, "part bigint, hash bigint, value float"), "hashes"), parts)


def bits(grams: np.ndarray, seeds: np.ndarray, hashes: np.ndarray, values: np.ndarray) -> np.ndarray:
    """-log2 of the probability of each n-gram's last byte after the bytes before it."""
    out = np.zeros(len(grams))
    left = np.arange(len(grams))
    for k in range(ORDER, 0, -1):
        some = grams[left] & ((1 << 8 * k) - 1)
        at, found = _find(hashed(some, k, seeds[left]), hashes)
        out[left[found]] -= values[at[found]]
        left, some = left[~found], some[~found]
        if not len(left):
            return out
        at, found = _find(hashed(some >> 8, 1 - k, seeds[left]), hashes)
        out[left[found]] -= values[at[found]]
    out[left] += 8  # no order knows the byte: one of 256
    return out


def _find(wanted: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(hashes, wanted), max(len(hashes) - 1, 0))
    return at, hashes[at] == wanted if len(hashes) else np.zeros(len(wanted), dtype=bool)


TEXT_KEY = ["lang", "text_a", "text_b"]


def _keyed(docs: DataFrame, *more: Column) -> DataFrame:
    """Languages and texts with 128 bits that stand for the text."""
    keys = {"text_a": F.xxhash64("text"), "text_b": F.xxhash64(F.lit(1), "text")}
    return _texts(docs, *more).withColumns(keys)


def text_bits(docs: DataFrame, model: Model) -> DataFrame:
    """One row per language and text: TEXT_KEY, `bytes` and `bits` (in UNITS)."""
    rows = _keyed(docs.where(F.length(col("text")) > 0))
    found = None
    for part in range(model.parts):
        sent = docs.sparkSession.sparkContext.broadcast(model.arrays(part))
        more = rows.mapInArrow(_scorer(sent, part, model.parts), "lang string, text_a bigint, text_b bigint, part int, bytes bigint, bits bigint")
        found = more if found is None else found.union(more)
    once = found.groupBy(*TEXT_KEY, "part").agg(F.first("bytes").alias("bytes"), F.first("bits").alias("bits"))
    return once.groupBy(*TEXT_KEY).agg(F.first("bytes").alias("bytes"), F.sum("bits").alias("bits"))


def _scorer(sent, part: int, parts: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, values = sent.value
        for batch in batches:
            seeds = np.array([seed(x) for x in batch["lang"].to_pylist()], np.uint64)
            length, total = np.zeros(len(seeds), np.int64), np.zeros(len(seeds))
            for texts in slices(batch["text"]):
                here = slice(texts.first, texts.first + len(texts))
                length[here] = np.diff(texts.offsets)
                for doc, gram in byte_grams(texts):
                    if parts > 1:
                        mine = _part_of((gram >> 8) & 0xFFFF, parts) == part
                        doc, gram = doc[mine], gram[mine]
                    # Each different n-gram of a language is looked up once, in order of its hash.
                    keys = hashed(gram, ORDER, seeds[here][doc])
                    _, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
                    known = bits(gram[first], seeds[here][doc[first]], hashes, values)
                    total[here] += np.bincount(doc, weights=known[inverse], minlength=len(texts))
            columns = [batch["lang"], batch["text_a"], batch["text_b"], pa.array(np.full(len(seeds), part, np.int32)),
                       pa.array(length), pa.array(np.rint(total * UNITS).astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, [*TEXT_KEY, "part", "bytes", "bits"])

    return score


def bands(scored: DataFrame, width: float = WIDTH, least: float = LEAST) -> DataFrame:
    """`lang`, `low`, `high`: bits per byte around the median of each language's texts.

    Texts are counted per bin first: at most BINS * MOST_BITS rows of a language.
    """
    per_byte = F.least(F.col("bits") / UNITS / F.col("bytes"), F.lit(float(MOST_BITS)))
    bins = scored.groupBy("lang", F.round(per_byte * BINS).cast("bigint").alias("bin")).agg(F.count("*").alias("n"))
    middle = bins.groupBy("lang").agg(F.percentile("bin", 0.5, F.col("n")).alias("middle"))
    spread = bins.join(middle, "lang").groupBy("lang", "middle").agg(
        F.percentile(F.abs(F.col("bin") - F.col("middle")), 0.5, F.col("n")).alias("spread")
    )
    reach: Column = F.greatest(width * 1.4826 * F.col("spread") / BINS, F.lit(least))
    return spread.select("lang", (F.col("middle") / BINS - reach).alias("low"), (F.col("middle") / BINS + reach).alias("high"))


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def with_counts(docs: DataFrame) -> DataFrame:
    """`doc_id`, TEXT_KEY and the fixed counts of each row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [rule_counts(texts) for texts in slices(batch["text"])]
            columns = [pa.array(np.concatenate([f[c] for f in found] or [np.zeros(0)]).astype(np.int64)) for c in COUNTS]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), *columns], [*kept, *COUNTS])

    rows = _keyed(docs, col("doc_id").alias("doc_id"))
    kept = ["doc_id", *TEXT_KEY]
    types = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept)
    return rows.mapInArrow(count, f"{types}, " + ", ".join(f"{c} bigint" for c in COUNTS))


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """`doc_id`, the fixed counts, `base_failed`, `bits_per_byte`, `low`, `high`, `kept`."""
    scored = materialize(text_bits(docs, model), "bits")
    limits = bands(scored)
    judged = scored.join(limits, "lang", "left").select(
        *TEXT_KEY, (F.col("bits") / UNITS / F.col("bytes")).alias("bits_per_byte"), "low", "high"
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    inside = F.coalesce(F.col("bits_per_byte").between(F.col("low"), F.col("high")), F.lit(False))
    return with_counts(docs).join(judged, TEXT_KEY, "left").select(
        "doc_id", *COUNTS, failed.alias("base_failed"), (~failed & inside).alias("kept"), "bits_per_byte", "low", "high"
    )


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return judge(docs, train(docs))
