"""Language identification with error-correcting output codes.

Every language has a codeword of bits. For each bit a logistic classifier over byte n-grams
predicts whether it is set; decoding chooses the codeword with the least loss, bits weighted
by how well their classifier does on the training rows. A small distance between the best two
codewords marks a prediction as ambiguous.

A null text, or one without a letter, gets `und` with score 0, as does every text when no
language was learned. With one learned language all other texts get it. Rows are scored one
by one: repeated rows score alike, very long texts are read whole, an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.frames import col, held_out
from tradeloom.llm.sampling import per_class_sample
from tradeloom.llm.texts import LOWER, PIECE, Texts, slices

BITS = 12  # n-grams are hashed to 2**BITS features
MAX_TRAIN = 400  # rows of each language that are used for fitting
AMBIGUOUS = 0.2  # least difference in probability between the best two languages
UNDETERMINED = "und"
# Bytes as the classifiers see them: letters in lower case, anything else a space.
SEEN = np.full(256, 0x20, dtype=np.uint8)
SEEN[ord("a") : ord("z") + 1] = LOWER[ord("a") : ord("z") + 1]
SEEN[ord("A") : ord("Z") + 1] = LOWER[ord("A") : ord("Z") + 1]
SEEN[0x80:] = np.arange(0x80, 256)
ASCII_LETTER = np.zeros(256, dtype=bool)
ASCII_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits, -1 or 1
    weights: np.ndarray  # features x bits
    bias: np.ndarray
    trust: np.ndarray  # languages x bits: weight of a bit's loss, 1 in total for each language


def codewords(k: int, seed: int = 2) -> np.ndarray:
    """k codewords: all distinct splits up to 6 languages, else the best of random codes."""
    if k <= 1:
        return np.ones((k, 1))
    if k <= 6:
        bits = np.arange(1, 1 << (k - 1))
        return np.where((bits[None, :] >> np.arange(k)[:, None]) & 1, 1.0, -1.0)
    rng, n = np.random.default_rng(seed), int(np.ceil(10 * np.log2(k)))
    best, most = None, -1
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (k, n))
        split = np.abs(code.sum(axis=0)) < k
        distance = (n - code @ code.T) / 2
        np.fill_diagonal(distance, n)
        if split.all() and distance.min() > most:
            best, most = code, distance.min()
    return best


def ngrams(texts: Texts) -> np.ndarray:
    """Shares of the hashed 2- and 3-grams of each text (half of the features each)."""
    n, size = len(texts), 1 << (BITS - 1)
    counts = np.zeros((n, 2 * size), np.float32)
    for a in range(0, len(texts.data), PIECE):
        # n-grams that start in this piece
        seen = SEEN[texts.data[a : a + PIECE + 2]].astype(np.uint32)
        if len(seen) < 2:
            break
        doc = np.repeat(np.arange(n), np.diff(np.clip(texts.offsets, a, a + len(seen))))
        value = (seen[:-1] << 8) | seen[1:]
        for part in range(2):
            if part:
                value = (value[:-1] << 8) | seen[2:]
            starts = slice(0, min(len(value), PIECE))
            here, last = value[starts], doc[part + 1 :][starts]
            inside = (last == doc[starts]) & (here != (0x202020 if part else 0x2020))
            feature = (here * np.uint32(0x9E3779B1)) >> np.uint32(33 - BITS)
            found = np.bincount(last[inside] * size + feature[inside], minlength=n * size)
            counts[:, part * size : (part + 1) * size] += found.reshape(n, size)
    counts = np.sqrt(counts)
    length = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
    return counts / np.maximum(length, 1e-9)


def lettered(texts: Texts) -> np.ndarray:
    """Whether a text has a letter, in any script."""
    total = np.concatenate([[0], np.cumsum(ASCII_LETTER[texts.data])])[texts.offsets]
    found = np.diff(total) > 0
    for i in np.flatnonzero(~found):
        if texts.offsets[i] < texts.offsets[i + 1]:
            found[i] = any(c.isalpha() for c in texts.text(i).decode("utf-8", "replace"))
    return found


def fit(x: np.ndarray, y: np.ndarray, languages: list[str], rounds: int = 150) -> Model:
    """One logistic classifier per bit, all trained at once, classes weighted alike."""
    code = codewords(len(languages))
    goal = code[y]
    share = 1.0 / np.bincount(y, minlength=len(languages))[y] / len(languages)
    w, b = np.zeros((x.shape[1], code.shape[1])), np.zeros(code.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        margin = goal * (x @ w + b)
        slope = -(goal * share[:, None]) / (1.0 + np.exp(np.clip(margin, -50, 50)))
        grad = x.T @ slope + 1e-5 * w
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        b -= 0.5 * slope.sum(axis=0)
    right = (goal * (x @ w + b)) > 0
    trust = np.stack([right[y == i].mean(axis=0) for i in range(len(languages))]) + 1e-3
    return Model(languages, code, w.astype(np.float32), b, trust / trust.sum(axis=1, keepdims=True))


def train(docs: DataFrame, lang: str = "lang", text: str = "text", doc_id: str = "doc_id",
          bound: int = MAX_TRAIN, seed: int = 2) -> Model:
    """Fit on about `bound` rows of each language at most, none of them held out."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                x = ngrams(part)
                yield pa.record_batch(
                    {"label": batch.column(0).slice(part.first, len(part)),
                     "x": pa.array([row.astype(np.float16).tobytes() for row in x], pa.binary())}
                )

    known = docs.select(col(doc_id).alias("doc_id"), col(lang).alias("label"), col(text).alias("text")).where(
        F.col("label").isNotNull() & ~held_out(F.col("doc_id"))
    )
    sample = per_class_sample(known, "label", "doc_id", bound, seed).select("label", "text")
    rows = sample.mapInArrow(features, "label string, x binary").toArrow()
    if not rows.num_rows:
        return Model([], codewords(0), np.zeros((1 << BITS, 1), np.float32), np.zeros(1), np.zeros((0, 1)))
    label = rows["label"].to_pylist()
    languages = sorted(set(label))
    x = np.frombuffer(b"".join(rows["x"].to_pylist()), np.float16).reshape(len(label), -1).astype(np.float32)
    return fit(x, np.array([languages.index(v) for v in label]), languages)


def decode(margin: np.ndarray, model: Model) -> np.ndarray:
    """Probability of each language: softmax of the negative weighted logistic loss."""
    loss = np.logaddexp(0.0, -margin[:, None, :] * model.code[None, :, :])
    distance = (loss * model.trust[None, :, :]).sum(axis=2) * model.code.shape[1]
    p = np.exp(distance.min(axis=1, keepdims=True) - distance)
    return p / p.sum(axis=1, keepdims=True)


def predictor(model: Model):
    """Column function of a text: `lang`, `score` (its probability) and `ambiguous`."""
    names = np.array([*model.languages, UNDETERMINED], dtype=object)

    @F.arrow_udf("struct<lang: string, score: double, ambiguous: boolean>")
    def predict(column: pa.Array) -> pa.Array:
        langs, scores, doubts = [np.zeros(0, object)], [np.zeros(0)], [np.zeros(0, bool)]
        for part in slices(column):
            known = lettered(part) & bool(model.languages)
            place = np.full(len(part), len(model.languages))
            score, doubt = np.zeros(len(part)), np.zeros(len(part), bool)
            if model.languages:
                p = decode(ngrams(part) @ model.weights + model.bias, model)
                place[known] = p.argmax(axis=1)[known]
                score[known] = p.max(axis=1)[known]
                second = np.sort(p, axis=1)[:, -2] if p.shape[1] > 1 else np.zeros(len(p))
                doubt = known & (p.max(axis=1) - second < AMBIGUOUS)
            langs.append(names[place])
            scores.append(score)
            doubts.append(doubt)
        return pa.StructArray.from_arrays(
            [pa.array(np.concatenate(langs), pa.string()), pa.array(np.concatenate(scores), pa.float64()),
             pa.array(np.concatenate(doubts), pa.bool_())],
            ["lang", "score", "ambiguous"],
        )

    return predict


def language(text: Column, model: Model) -> Column:
    return predictor(model)(text)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = train(docs)
    found = docs.select("doc_id", language(col("text"), model).alias("found"))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("found.lang").alias("lang_pred"),
        F.col("found.score").alias("score"),
        F.col("found.ambiguous").alias("ambiguous"),
    )
