"""Document quality by hierarchical empirical Bayes.

A logistic classifier over a text's own features gives the document's evidence as a log
likelihood ratio. The expected number of good documents is summed per host and per path of a
host; the spread between hosts (and between paths of a host) says how strongly a site's share
is drawn towards the level above it: path to host, host to all documents. Sites with few
rows therefore stay near the prior of the level above. A document's score combines its own
evidence with the odds of its path as the other documents have it: what it adds to its site is
taken out first, so that its evidence counts once.

Null and empty texts have no evidence for quality and are rejected. Null sources form a site
of their own, apart from empty ones. Repeated rows score alike and count for their site each time. Without labelled
rows all evidence is 0 and every document with words is kept. An empty table gives an empty
result; other columns are passed through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.frames import col, free_name
from tradeloom.llm.sampling import labelled_sample
from tradeloom.llm.texts import LOWER, SPACE, Texts, run_hashes, runs, slices
from tradeloom.sources.scratch import materialize

MAX_TRAIN = 4000  # labelled rows of each label that are used for fitting
THRESHOLD = 0.5
LARGEST = 12.0  # bound of a document's evidence, in log odds
LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 256)]] = True
UPPER = np.zeros(256, dtype=bool)
UPPER[ord("A") : ord("Z") + 1] = True
CAPITAL_OR_NOT = np.zeros(256, dtype=bool)
CAPITAL_OR_NOT[ord("a") : ord("z") + 1] = True
DIGIT = np.zeros(256, dtype=bool)
DIGIT[ord("0") : ord("9") + 1] = True
MARKS = ".,;:!?'\"()-|#$%&*@+/_<>{}[]\\=~^"
N_FEATURES = 14 + len(MARKS)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float  # log odds of the training rows, taken out of the evidence


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Features of each text, and its number of words."""
    n, data = len(texts), texts.data
    start, end, doc = runs(texts, ~SPACE[data])
    count = np.bincount(doc, minlength=n)
    many = np.maximum(count, 1)
    sizes = np.diff(texts.offsets)
    size = np.maximum(sizes, 1)
    cell = np.repeat(np.arange(n, dtype=np.int32) << 8, sizes)
    cell |= data
    byte_counts = np.bincount(cell, minlength=n << 8).reshape(n, 256)

    def per_word(flags: np.ndarray) -> np.ndarray:
        return np.bincount(doc, weights=flags, minlength=n) / many

    def inside(flags: np.ndarray) -> np.ndarray:
        """Sums from each word to the next; what stands between words has none of the flags."""
        return np.add.reduceat(flags.astype(np.int32)[data], start) if len(start) else np.zeros(0, np.int32)

    key = run_hashes(LOWER[data], start, end)
    same = np.zeros(len(start), bool)
    same[1:] = (key[1:] == key[:-1]) & (doc[1:] == doc[:-1])
    shift = np.uint64(54)  # a slice has fewer than 2**10 + 1 texts
    word = (doc.astype(np.uint64) << shift) | (key >> np.uint64(10))
    word.sort()
    first = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(word) else np.zeros(0, np.int64)
    owner = (word[first] >> shift).astype(np.int64)
    distinct = np.bincount(owner, minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, owner, np.diff(np.append(first, len(word))))
    letters, upper, lower = inside(LETTER), inside(UPPER), inside(CAPITAL_OR_NOT)
    length = end - start
    columns = [
        np.log1p(count), 1.0 / np.sqrt(many), distinct / many, np.log(distinct + 1.0) / np.log(many + 1.0),
        per_word(same), most / many, per_word(letters == 0), per_word((upper >= 2) & (lower == 0)),
        per_word(letters < length), per_word(length), per_word(length > 20), byte_counts[:, LETTER].sum(axis=1) / size,
        byte_counts[:, DIGIT].sum(axis=1) / size, byte_counts[:, 0x0A] * 10 / size,
    ]
    columns += [np.sqrt(byte_counts[:, ord(c)] / many) for c in MARKS]
    return np.stack(columns, axis=1), count


def expand(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised features and their squares, both bounded."""
    z = np.clip((x - mean) / scale, -6.0, 6.0)
    return np.concatenate([z, np.minimum(z * z, 12.0)], axis=1)


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 400) -> Model:
    n = x.shape[1]
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(n), np.ones(n), np.zeros(2 * n), 0.0, 0.0)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = expand(x, mean, scale)
    w, b = np.zeros(z.shape[1]), 0.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, rounds + 1):
        p = 1.0 / (1.0 + np.exp(-np.clip(z @ w + b, -50, 50)))
        grad = np.append(z.T @ (p - y) / len(y) + 1e-4 * w, (p - y).mean())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w -= move[:-1]
        b -= float(move[-1])
    return Model(mean, scale, w, b, float(np.log(y.mean() / (1 - y.mean()))))


def train(docs: DataFrame, labels: DataFrame, bound: int = MAX_TRAIN, seed: int = 1) -> Model:
    """Fit on about `bound` labelled documents of each label at most, whole texts."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                x, _ = features(part)
                yield pa.record_batch(
                    {"label": batch.column(0).slice(part.first, len(part)),
                     "x": pa.array(list(x), pa.list_(pa.float64()))}
                )

    sample = labelled_sample(docs, labels, "quality", bound, seed).select(F.col("label").cast("int"), "text")
    rows = sample.mapInArrow(measured, "label int, x array<double>").toArrow()
    x = rows["x"].combine_chunks().flatten().to_numpy().reshape(-1, N_FEATURES)
    return fit(x, rows["label"].to_numpy().astype(float))


def evidence(model: Model):
    """Column function of a text: log likelihood ratio for good quality; null without words."""

    @F.arrow_udf("double")
    def ratio(column: pa.Array) -> pa.Array:
        out = [pa.array([], pa.float64())]
        for part in slices(column):
            x, count = features(part)
            value = expand(x, model.mean, model.scale) @ model.weights + model.bias - model.prior
            out.append(pa.array(np.clip(value, -LARGEST, LARGEST), pa.float64(), mask=count == 0))
        return pa.concat_arrays(out)

    return ratio


def host(source: Column) -> Column:
    """What stands before the first slash, without a scheme; null for null."""
    return F.lower(F.regexp_extract(source, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?([^/?#]*)", 1))


def path(source: Column) -> Column:
    """The first directory below the host, empty if there is none."""
    return F.regexp_extract(F.coalesce(source, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?[^/?#]*/([^/?#]+)/", 1)


def logistic(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def logit(p: Column) -> Column:
    return F.log(p / (1.0 - p))


def strength(groups: DataFrame, n: str, good: str, above: Column) -> float:
    """Rows that the level above counts for: moments of a beta-binomial over the groups.

    `above` is a group's expected share. The mean squared distance of the groups' shares from
    it, less what sampling alone explains, is the spread between groups; the more spread, the
    less the level above counts.
    """
    noise, rows = above * (1 - above), F.col(n)
    row = groups.where(rows >= 2).agg(
        F.sum(rows * F.pow(F.col(good) / rows - above, 2)).alias("apart"),
        F.sum(noise).alias("noise"), F.sum(rows * noise).alias("scale"), F.sum(noise / rows).alias("small"),
    ).first()
    if row["scale"] is None or row["scale"] <= 0:
        return 100.0
    share = (row["apart"] - row["noise"]) / max(row["scale"] - row["small"], 1e-12)
    share = min(max(share, 1e-4), 0.9)
    return 1.0 / share - 1.0


@dataclass
class Sites:
    """`table`: host, path, n, good, host_n, host_good; the share of all documents, and how many
    rows it counts for in a host and the host's share in a path."""

    table: DataFrame
    overall: float
    between_hosts: float
    between_paths: float

    def odds(self, site: Column, own: Column, rows: int = 1) -> Column:
        """Log odds of a site's share without `rows` rows that add `own` to it."""
        host_share = (site["host_good"] - own + self.overall * self.between_hosts) / (
            site["host_n"] - rows + self.between_hosts
        )
        share = (site["good"] - own + host_share * self.between_paths) / (site["n"] - rows + self.between_paths)
        return logit(F.least(F.greatest(share, F.lit(1e-3)), F.lit(1 - 1e-3)))


def site_posteriors(judged: DataFrame, prior: float) -> Sites:
    """What the sites of the documents say.

    judged: host, path, evidence, one row per document with words. Rows are summed before
    they are shuffled, so a hot host costs no more than another.
    """
    p = logistic(F.col("evidence") + prior)
    paths = materialize(
        judged.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(p).alias("good")), "quality-paths"
    )
    hosts = paths.groupBy(F.col("host").alias("_host")).agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    table = paths.join(hosts, F.col("host").eqNullSafe(F.col("_host"))).drop("_host")
    total = paths.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    if not total["n"]:
        return Sites(table, 0.5, 1.0, 1.0)
    overall = min(max(total["good"] / total["n"], 1e-3), 1 - 1e-3)
    between_hosts = strength(hosts, "host_n", "host_good", F.lit(overall))
    share = (F.col("host_good") + overall * between_hosts) / (F.col("host_n") + between_hosts)
    between_paths = strength(table.withColumn("host_share", share), "n", "good", F.col("host_share"))
    return Sites(materialize(table, "quality-sites"), overall, between_hosts, between_paths)


def judge(docs: DataFrame, model: Model, name: str = "quality") -> DataFrame:
    """All columns of `docs` and a struct `name`: evidence, site_odds, score, kept.

    Texts are read once for the sites and once for the result; neither pass shuffles them.
    """
    text, source = col("text"), col("source")
    sites = site_posteriors(
        docs.select(host(source).alias("host"), path(source).alias("path"), evidence(model)(text).alias("evidence"))
        .where(F.col("evidence").isNotNull()),
        model.prior,
    )
    here, found, site = free_name(docs, "site_here"), free_name(docs, "evidence_here"), free_name(docs, "site")
    judged = docs.withColumns({here: F.struct(host(source).alias("host"), path(source).alias("path")),
                               found: evidence(model)(text)})
    table = sites.table.select(F.struct(*sites.table.columns).alias(site))
    same = col(here).host.eqNullSafe(col(site).host) & (col(here).path == col(site).path)
    odds = F.coalesce(sites.odds(col(site), logistic(col(found) + model.prior)), F.lit(0.0))
    score = F.coalesce(logistic(col(found) + odds), F.lit(0.0))
    return judged.join(table, same, "left").select(
        *[col(c) for c in docs.columns],
        F.struct(col(found).alias("evidence"), odds.alias("site_odds"), score.alias("score"),
                 (score >= THRESHOLD).alias("kept")).alias(name),
    )


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return judge(docs, train(docs, labels)).select("doc_id", "quality.*")
