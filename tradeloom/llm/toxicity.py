"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's probability is the logistic of the sum of its
words' weights; the document's is the noisy-or of its sentences, 1 - prod(1 - p). The weights
are fitted to document labels alone, after which single sentences can be scored and located.
Features are words, their first bytes, and these with the number of bytes that follow, so
that inflected forms share weights. Features that are not clearly more frequent in labelled
documents (by a likelihood-ratio test over distributed counts) get no weight.

Null and empty texts have no sentences and score 0. Very long texts only mean more
sentences. Rows are scored one by one, so repeated rows score alike and an empty table gives
an empty result. Without labelled rows every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.frames import col, held_out
from tradeloom.llm.sampling import labelled_sample
from tradeloom.llm.texts import LOWER, Texts, mix, prefix_values, runs, slices
from tradeloom.sources.scratch import materialize

BITS = 20  # features are hashed to 2**BITS weights
MAX_TRAIN = 6000  # labelled rows of each label that are used for fitting
EVIDENCE = 14.0  # least likelihood ratio of a feature that gets a weight
PREFIXES = (4, 5, 6, 7, 8)
THRESHOLD = 0.3
WORD = np.zeros(256, dtype=bool)
WORD[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
WORD[[ord("'"), *range(0x80, 256)]] = True
STOP = np.zeros(256, dtype=bool)
STOP[[ord(c) for c in ".!?\n"]] = True


@dataclass
class Model:
    weights: np.ndarray  # of 2**BITS features
    bias: float


def sentences(texts: Texts) -> tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features as pairs (words, hashes); per sentence: its first word, text, first and last byte."""
    start, end, doc = runs(texts, WORD[texts.data])
    length = end - start
    value = prefix_values(LOWER[texts.data], start, end)
    fold = np.uint64(64 - BITS)
    everyone = np.arange(len(start))
    features = [(everyone, (mix(value(length)) >> fold).astype(np.int64))]
    for n in PREFIXES:
        longer = np.flatnonzero(length > n)
        head = value(np.full(len(start), n), longer)
        rest = np.minimum(length[longer] - n, 12).astype(np.uint64)
        features.append((longer, (mix(head + np.uint64(n)) >> fold).astype(np.int64)))
        features.append((longer, (mix(head + (rest << np.uint64(8)) + np.uint64(n)) >> fold).astype(np.int64)))
    stops = np.cumsum(STOP[texts.data])
    before = stops[start] if len(start) else start
    new = np.ones(len(start), dtype=bool)
    new[1:] = (before[1:] != before[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(start)]])[: len(first)] - 1
    return features, first, doc[first], start[first], end[last] if len(first) else start[first]


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def fit(label: np.ndarray, feature: np.ndarray, sentence: np.ndarray, doc: np.ndarray, rounds: int = 300) -> Model:
    """Weights that minimise the noisy-or likelihood with an L2 penalty (Adam, all rows each round).

    feature, sentence: for each occurrence of a feature; doc: for each sentence; label: for
    each document.
    """
    size = 1 << BITS
    if not len(label) or label.min() == label.max():
        return Model(np.zeros(size, np.float32), -30.0)
    used, word = np.unique(feature, return_inverse=True)
    weight, n = np.zeros(len(used)), len(label)
    bias = float(np.log(0.01 / max(1.0, len(doc) / n)))
    m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for step in range(1, rounds + 1):
        z = np.clip(bias + np.bincount(sentence, weights=weight[word], minlength=len(doc)), -50, 50)
        total = np.bincount(doc, weights=softplus(z), minlength=n) + 1e-9
        slope = np.where(label == 1, -1.0 / np.expm1(np.minimum(total, 50.0)), 1.0)
        by_sentence = slope[doc] / (1.0 + np.exp(-z))
        grad = np.append(np.bincount(word, weights=by_sentence[sentence], minlength=len(used)) + 0.02 * weight,
                         by_sentence.sum()) / n
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        weight -= move[:-1]
        bias -= float(move[-1])
    out = np.zeros(size, np.float32)
    out[used] = weight
    return Model(out, bias)


def evidence(with_1: Column, with_0: Column, all_1: int, all_0: int) -> Column:
    """Likelihood ratio of a feature that label 1 has more often than label 0, else 0."""
    share = (with_1 + with_0) / (all_1 + all_0)

    def part(n: Column, total: int) -> Column:
        inside = F.when(n > 0, n * F.log(n / (share * total))).otherwise(0.0)
        rest = total - n
        return inside + F.when(rest > 0, rest * F.log(rest / ((1 - share) * total))).otherwise(0.0)

    return F.when(with_1 / all_1 > with_0 / all_0, 2 * (part(with_1, all_1) + part(with_0, all_0))).otherwise(0.0)


def count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each label that have a feature, for the batch's features."""
    size = 1 << BITS
    for batch in batches:
        label = batch.column(0).to_numpy(zero_copy_only=False)
        for part in slices(batch.column(1)):
            features, first, doc, _, _ = sentences(part)
            owner = np.repeat(doc, np.diff(np.append(first, len(features[0][0]))))
            pairs = np.unique(np.concatenate([owner[w] * size + f for w, f in features]))
            positive = label[part.first + pairs // size]
            found, place = np.unique(pairs % size, return_inverse=True)
            ones = np.bincount(place, weights=positive, minlength=len(found)).astype(np.int64)
            yield pa.record_batch(
                {"feature": pa.array(found, pa.int32()), "ones": pa.array(ones, pa.int64()),
                 "zeros": pa.array(np.bincount(place, minlength=len(found)) - ones, pa.int64())}
            )


def train(docs: DataFrame, labels: DataFrame, bound: int = MAX_TRAIN, seed: int = 10) -> Model:
    """Fit on about `bound` labelled documents of each label at most, whole texts."""
    sample = labelled_sample(docs.where(~held_out(F.col("doc_id"))), labels, "toxic", bound, seed).select(
        F.col("label").cast("int"), "text"
    )
    sample = materialize(sample, "toxicity-sample")
    totals = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    ones, zeros = totals.get(1, 0), totals.get(0, 0)
    if not ones or not zeros:
        return Model(np.zeros(1 << BITS, np.float32), -30.0)
    ratio = evidence(F.col("ones"), F.col("zeros"), ones, zeros)
    chosen = (
        sample.mapInArrow(count_features, "feature int, ones long, zeros long")
        .groupBy("feature").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
        .select("feature", ratio.alias("ratio")).where(F.col("ratio") >= EVIDENCE)
    )  # 2**BITS at most
    wanted = np.zeros(1 << BITS, dtype=bool)
    wanted[chosen.select("feature").toArrow()["feature"].to_numpy()] = True
    packed = np.packbits(wanted)

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(packed).astype(bool)
        for batch in batches:
            label = batch.column(0).to_numpy(zero_copy_only=False)
            for part in slices(batch.column(1)):
                features, first, doc, _, _ = sentences(part)
                inside = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(features[0][0]))))
                hits = [(inside[w[wanted[f]]], f[wanted[f]]) for w, f in features]
                sentence, feature = np.concatenate([h[0] for h in hits]), np.concatenate([h[1] for h in hits])
                order = np.argsort(sentence, kind="stable")
                sentence, feature = sentence[order], feature[order]
                per_doc = np.searchsorted(doc, np.arange(len(part) + 1))
                ends = np.searchsorted(sentence, per_doc)
                begin = per_doc[np.searchsorted(per_doc, sentence, side="right") - 1]
                yield pa.record_batch(
                    {
                        "label": pa.array(label[part.first : part.first + len(part)], pa.int32()),
                        "sentences": pa.array(np.diff(per_doc), pa.int32()),
                        "sentence": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(sentence - begin, pa.int32())),
                        "feature": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(feature, pa.int32())),
                    }
                )

    rows = sample.mapInArrow(
        occurrences, "label int, sentences int, sentence array<int>, feature array<int>"
    ).toArrow().combine_chunks()
    many = rows["sentences"].to_numpy().astype(np.int64)
    firsts = np.cumsum(many) - many
    listed = rows["sentence"].combine_chunks()
    sentence = listed.flatten().to_numpy() + np.repeat(firsts, listed.value_lengths().to_numpy())
    feature = rows["feature"].combine_chunks().flatten().to_numpy().astype(np.int64)
    return fit(rows["label"].to_numpy(), feature, sentence, np.repeat(np.arange(len(many)), many))


def scores(texts: Texts, model: Model) -> tuple[np.ndarray, tuple]:
    """Score of each text; probability, text, first and last byte of each sentence."""
    features, first, doc, start, end = sentences(texts)
    if not len(first):
        return np.zeros(len(texts)), (np.zeros(0), doc, start, end)
    weight = np.zeros(len(features[0][0]))
    for w, f in features:
        weight[w] += model.weights[f]
    z = np.clip(np.add.reduceat(weight, first) + model.bias, -50, 50)
    miss = np.bincount(doc, weights=softplus(z), minlength=len(texts))
    return -np.expm1(-miss), (1.0 / (1.0 + np.exp(-z)), doc, start, end)


RESULT = "struct<score: double, sentences: array<struct<start: long, end: long, score: double>>>"


def scorer(model: Model, least: float = 0.5):
    """Column function of a text: its score, and its sentences scoring `least` or more.

    Sentence bounds are code points, end exclusive.
    """
    weights, bias = model.weights, model.bias

    @F.arrow_udf(RESULT)
    def score(column: pa.Array) -> pa.Array:
        parts, found, bounds = [], [], [np.zeros(1, np.int64)]
        for part in slices(column):
            value, (p, doc, start, end) = scores(part, Model(weights, bias))
            hit = p >= least
            points = np.concatenate([[0], np.cumsum((part.data & 0xC0) != 0x80)])
            base = points[part.offsets[doc[hit]]]
            found.append((points[start[hit]] - base, points[end[hit]] - base, p[hit]))
            bounds.append(np.cumsum(np.bincount(doc[hit], minlength=len(part))) + bounds[-1][-1])
            parts.append(value)
        start, end, p = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0),) * 3
        items = pa.StructArray.from_arrays(
            [pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(p, pa.float64())], ["start", "end", "score"]
        )
        listed = pa.ListArray.from_arrays(pa.array(np.concatenate(bounds), pa.int32()), items)
        value = np.concatenate(parts) if parts else np.zeros(0)
        return pa.StructArray.from_arrays([pa.array(value, pa.float64()), listed], ["score", "sentences"])

    return score


def toxicity(text: Column, model: Model) -> Column:
    return scorer(model)(text)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))
    found = docs.select("doc_id", toxicity(col("text"), model).alias("found"))
    score = F.col("found.score")
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        score.alias("score"),
        (score >= THRESHOLD).cast("int").alias("predicted"),
        F.col("found.sentences").alias("sentences"),
    )
