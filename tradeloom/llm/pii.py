"""Personal data: fixed patterns, and further spans chosen by boosted trees.

Four patterns with checks (base spans) are always kept. Generators of high recall propose
further, overlapping spans: any group of digits with separators, hexadecimal address groups,
and addresses written with words for the signs. Boosted trees score them by format and
context. They learn from base spans and written variants of these against proposals that
fail every check and distorted base spans. Proposals in the format of a written variant are
not counted as failing: they may be what is looked for, and stay out of the fit. Digits
without separators do not count as such a format. Each kind's threshold is set for a precision
on rows left out of the fit, with few of a kind by all kinds; a kind without any base span adds
nothing. Accepted spans that overlap a base span or a better one are left out.

A null text counts as empty; empty texts have no spans. Rows are treated one by one: repeated
rows get the same spans, whole texts are searched, an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.boosting import Boosted, boost, precise_threshold
from tradeloom.llm.frames import col, free_name, unit_hash
from tradeloom.llm.texts import slices

KINDS = ("email", "ip", "card", "phone")
MAX_TRAIN = 4000  # documents with a digit or an at sign that are used for fitting
PER_DOC = 40  # spans of one of these documents that are used
PRECISION = 0.995
LEAST = 20  # left-out spans of a kind from which on it has a threshold of its own
OPEN = 2  # label of proposals outside base spans

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Proposals.
NUMBERS = re.compile(r"[+(]{0,2}[0-9](?:[\x20().\-/]{0,2}[0-9])++")
HEX_GROUPS = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
WRITTEN = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?(?:[\[({]\x20?at\x20?[\])}]|\x20at\x20|@)\x20?"
    r"[A-Za-z0-9-]{1,63}(?:\x20?(?:[\[({]\x20?dot\x20?[\])}]|\x20dot\x20|\.)\x20?[A-Za-z0-9-]{2,63}){1,4}"
)
SIGNS = ("@", "dot", "at)", "at]", "at}", "at )", "at ]", "at }")  # one is in any written address
CONTEXT = {
    "email": re.compile(r"e-?mail|contact|write|mailto", re.I),
    "ip": re.compile(r"\bip\b|addr|host|server|ping", re.I),
    "card": re.compile(r"card|visa|master|credit|pay|iban", re.I),
    "phone": re.compile(r"tel|phone|call|fax|mobil|ring|whats", re.I),
}
NON_DIGIT = re.compile(r"[^0-9]")
Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum(2 * int(d) - 9 * (d > "4") for d in digits[-2::-2])) % 10 == 0


def small_parts(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".")]
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns that pass their checks, by kind, then start."""
    out: list[Span] = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            done = found.end()
            out.append(("email", start, done))
        at = text.find("@", max(at + 1, done))
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if small_parts(m.group())]
    for m in CARD.finditer(text):
        digits = NON_DIGIT.sub("", m.group()) if m.end() - m.start() >= 13 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(NON_DIGIT.sub("", m.group())) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def likely_kind(value: str) -> str:
    if "@" in value or re.search(r"\bat\b", value):
        return "email"
    if ":" in value or re.fullmatch(r"[0-9]+(?:\.[0-9]+){3}", value):
        return "ip"
    digits = len(NON_DIGIT.sub("", value))
    if value.startswith("00") and 11 <= digits <= 17:
        return "phone"
    return "card" if digits >= 13 else "phone"


def proposals(text: str) -> list[Span]:
    """Spans of the generators; they overlap one another and base spans."""
    found = [m.span() for m in NUMBERS.finditer(text) if m.end() - m.start() >= 7]
    if text.count(":") >= 3:
        found += [m.span() for m in HEX_GROUPS.finditer(text)]
    if any(sign in text for sign in SIGNS):
        found += [m.span() for m in WRITTEN.finditer(text)]
    return [(likely_kind(text[a:b]), a, b) for a, b in dict.fromkeys(found)]


def features(kind: str, value: str, left: str, right: str) -> list[float]:
    """Format of a span and what stands around it."""
    digits = NON_DIGIT.sub("", value)
    groups = re.findall(r"[0-9]+", value)[:64]
    sizes = [len(g) for g in groups] or [0]
    near = left[-24:]
    return [
        KINDS.index(kind), len(value), len(digits), len(groups), max(sizes), min(sizes), sizes[0], sizes[-1],
        float(len(set(sizes)) == 1), float(2 <= len(digits) <= 40 and luhn(digits)),
        float(len(groups) == 4 and all(int(g[:9]) <= 255 for g in groups)), value.count("."), value.count("-"),
        value.count(" "), value.count("("), float(value.startswith("+")), value.count(":"), float("@" in value),
        float("(at)" in value or "[at]" in value or " at " in value), float("dot" in value),
        len(set(digits)), float(bool(left[-1:].isalnum())), float(bool(right[:1].isalnum())),
        float(left.endswith("+") or left.endswith("(")), float(left[-1:] in ("$", "€", "#", "/")),
        float(bool(CONTEXT[kind].search(near))), float(bool(re.search(r"[:=]\s?[\"']?$", near))),
        sum(c.isalpha() for c in value),
    ]


def variants(kind: str, value: str) -> list[tuple[int, str]]:
    """Other ways to write a base span (1) and distortions that are none (0)."""
    digits = NON_DIGIT.sub("", value)
    if kind == "email":
        name, _, domain = value.partition("@")
        return [(1, f"{name} at {domain.replace('.', ' dot ')}"), (1, f"{name}(at){domain}"),
                (1, f"{name} [at] {domain.replace('.', ' [dot] ')}"), (0, f"{name} at {domain.split('.')[0]}")]
    if kind == "ip":
        code = sha256(value.encode()).hexdigest()
        groups = [code[i : i + 4].lstrip("0") or "0" for i in range(0, 28, 4)]
        return [(1, ":".join(["2001", *groups])), (1, ":".join(["fe80", "0", "0", "0", *groups[:4]]).upper()),
                (0, ":".join(code[i : i + 2] for i in range(0, 12, 2))), (0, ":".join(groups[:4])),
                (0, value + ".77"), (0, ".".join(str(int(p[:9]) + 300) for p in value.split("."))),
                (0, value.rpartition(".")[0])]
    if kind == "card":
        grouped = " ".join(digits[i : i + 4] for i in range(0, len(digits), 4))
        wrong = digits[:-1] + str((int(digits[-1]) + 1) % 10)
        return [(1, grouped), (1, grouped.replace(" ", "-")), (0, wrong), (0, wrong[:9]), (0, digits + "00000000")]
    shown = value.lstrip("+")
    tail = re.sub(r"^[0-9]{1,3}[\x20.-]", "", shown)
    return [(1, "00" + shown), (1, tail if tail != shown else "(" + digits[:3] + ") " + digits[3:6] + "-" + digits[6:]),
            (0, digits), (0, digits[:5] + "-" + digits[5:7]), (0, digits[:7])]


def form(kind: str, value: str) -> str:
    """A written variant's format, empty where a value cannot be told from any other number."""
    if kind == "email":
        if re.search(r"[\[({]\x20?at\x20?[\])}]", value):
            return "(at)"
        return "at dot" if re.search(r"\x20at\x20.*[\x20\[({]dot[\x20\])}]", value) else ""
    if kind == "ip":
        return "groups" if value.count(":") == 7 else ""
    if len(value) > 40 or value.isdigit() or (kind == "card" and not luhn(NON_DIGIT.sub("", value))):
        return ""
    lead = 2 if value.startswith("00") else 0
    return value[:lead] + re.sub("[0-9]", "9", value[lead:])


def examples(text: str) -> list[tuple[int, str, str, list[float]]]:
    """Spans of one text for the fit: label, kind, format, features. Proposals are OPEN."""
    base = base_spans(text)
    out, covered = [], sorted((a, b) for _, a, b in base)
    for kind, a, b in base[:PER_DOC]:
        left, right, value = text[max(0, a - 24) : a], text[b : b + 8], text[a:b]
        out.append((1, kind, "", features(kind, value, left, right)))
        for label, other in variants(kind, value):
            shown = likely_kind(other) if label == 0 else kind
            out.append((label, shown, form(kind, other) if label else "", features(shown, other, left, right)))
    for kind, a, b in proposals(text)[:PER_DOC]:
        if not any(a < y and x < b for x, y in covered):
            value = text[a:b]
            out.append((OPEN, kind, form(kind, value), features(kind, value, text[max(0, a - 24) : a], text[b : b + 8])))
    return out


@dataclass
class Model:
    trees: Boosted
    threshold: dict[str, float]


def fit(label: np.ndarray, kind: np.ndarray, x: np.ndarray, seed: int = 8) -> Model:
    """Trees on three quarters of the rows, thresholds on the rest."""
    if not len(label):
        return Model(boost(np.zeros((0, 1)), np.zeros(0)), dict.fromkeys(KINDS, 1.1))
    order = np.lexsort((*x.T, label))
    label, kind, x = label[order], kind[order], x[order]
    rest = np.random.default_rng(seed).random(len(label)) < 0.25
    trees = boost(x[~rest], label[~rest].astype(float))
    score = trees.probability(x[rest])
    known, kind, truth = kind, kind[rest], label[rest]
    pooled = precise_threshold(score, truth, PRECISION, 1)
    threshold = {}
    for k in KINDS:
        mine, right = score[kind == k], truth[kind == k]
        if right.sum() >= LEAST:
            threshold[k] = precise_threshold(mine, right, PRECISION, LEAST)
        elif label[known == k].any():  # too few for a precision of their own: none that is wrong
            threshold[k] = max(pooled, float(np.nextafter(mine[right == 0].max(initial=0.0), 2.0)))
        else:
            threshold[k] = 1.1
    return Model(trees, {k: max(0.9, t) for k, t in threshold.items()})


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bound: int = MAX_TRAIN, seed: int = 8) -> Model:
    """Fit on about `bound` documents at most that have a digit or an at sign."""

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [e for t in batch.column(0).to_pylist() for e in examples(t)]
            yield pa.record_batch(
                {"label": pa.array([r[0] for r in rows], pa.int32()), "kind": pa.array([r[1] for r in rows], pa.string()),
                 "form": pa.array([r[2] for r in rows], pa.string()),
                 "x": pa.array([r[3] for r in rows], pa.list_(pa.float64()))}
            )

    some = docs.where(col(text).rlike("[0-9@]"))
    n = some.count()
    if not n:
        return fit(np.zeros(0), np.zeros(0), np.zeros((0, 1)))
    sample = some.where(unit_hash(seed, col(doc_id)) < bound / n).select(col(text))
    rows = sample.mapInArrow(labelled, "label int, kind string, form string, x array<double>").toArrow()
    label, kind, shape = rows["label"].to_numpy(), np.array(rows["kind"].to_pylist()), rows["form"].to_pylist()
    x = rows["x"].combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)
    written = {(k, s) for y, k, s in zip(label.tolist(), kind.tolist(), shape) if y == 1 and s}
    sure = np.array([y != OPEN or (k, s) not in written for y, k, s in zip(label.tolist(), kind.tolist(), shape)], bool)
    return fit(np.where(label == 1, 1, 0)[sure], kind[sure], x[sure])


def added_spans(text: str, base: list[Span], model: Model) -> list[Span]:
    """Proposals the trees accept, best first where they overlap, none over a base span."""
    taken = sorted((a, b) for _, a, b in base)
    starts = [a for a, _ in taken]
    free = []
    for kind, a, b in proposals(text):
        i = int(np.searchsorted(starts, b)) if starts else 0
        if not any(x < b and a < y for x, y in taken[max(0, i - 8) : i]):
            free.append((kind, a, b))
    if not free:
        return []
    x = np.array([features(k, text[a:b], text[max(0, a - 24) : a], text[b : b + 8]) for k, a, b in free])
    score = model.trees.probability(x)
    good = [(-s, a - b, a, b, k) for s, (k, a, b) in zip(score.tolist(), free) if s >= model.threshold[k]]
    out: list[Span] = []
    covered = np.zeros(len(text) + 1 if good else 0, bool)
    for _, _, a, b, kind in sorted(good):
        if not covered[a:b].any():
            covered[a:b] = True
            out.append((kind, a, b))
    return out


def joined(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ordered)


FOUND = "struct<base: array<struct<kind: string, start: int, end: int>>, added: array<struct<kind: string, start: int, end: int>>, base_sha256: string, spans: string>"
SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def finder(model: Model):
    """Column function of a text: base spans, added spans, the base's digest, all spans as text.

    Positions are code points, ends exclusive.
    """

    @F.arrow_udf(FOUND)
    def find(column: pa.Array) -> pa.Array:
        base, added, digests, shown = [], [], [], []
        signs = [sign.encode() for sign in SIGNS]
        for part in slices(column):
            digit = np.concatenate([[0], np.cumsum((part.data >= 0x30) & (part.data <= 0x39))])
            some = np.diff(digit[part.offsets]) > 0
            for i in range(len(part)):
                raw = part.text(i)
                mine: list[Span] = []
                more: list[Span] = []
                if some[i] or any(sign in raw for sign in signs) or raw.count(b":") >= 3:
                    text = raw.decode("utf-8", "replace")
                    mine = base_spans(text)
                    more = added_spans(text, mine, model)
                base.append([dict(zip(("kind", "start", "end"), s)) for s in mine])
                added.append([dict(zip(("kind", "start", "end"), s)) for s in more])
                digests.append(sha256(joined(mine).encode()).hexdigest())
                shown.append(joined(mine + more))
        return pa.StructArray.from_arrays(
            [pa.array(base, pa.list_(SPAN)), pa.array(added, pa.list_(SPAN)), pa.array(digests, pa.string()),
             pa.array(shown, pa.string())],
            ["base", "added", "base_sha256", "spans"],
        )

    return find


def find(text: Column, model: Model) -> Column:
    return finder(model)(text)


def redact_text(text: str, spans: list[Span]) -> str:
    """The text with each stretch of spans replaced by the first one's kind in brackets."""
    out, done, end = [], 0, -1
    for a, b, kind in sorted((a, b, k) for k, a, b in spans):
        if a >= end:
            out += [text[done:a], f"[{kind.upper()}]"]
            done = end = b
        elif b > end:
            done = end = b
    return "".join(out) + text[done:]


def redactor(model: Model):
    """Column function of a text: the text without its spans; a null text stays null."""

    @F.arrow_udf("string")
    def redact(column: pa.Array) -> pa.Array:
        out = []
        for text in column.to_pylist():
            base = base_spans(text) if text else []
            out.append(redact_text(text, base + added_spans(text, base, model)) if text else text)
        return pa.array(out, pa.string())

    return redact


def redact(docs: DataFrame, model: Model, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """`docs` with spans replaced in `text`, and `n_chars` as the new texts' length, if there."""
    clean = free_name(docs, "clean")
    found = docs.withColumn(clean, redactor(model)(col(text)))
    new = {text: col(clean), n_chars: F.length(col(clean)).cast("long")}
    return found.select(*[new[c].alias(c) if c in new else col(c) for c in docs.columns])


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = docs.select("doc_id", find(col("text"), train(docs)).alias("found"))

    def many(kind: str) -> Column:
        return F.size(F.filter("found.base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[many(k) for k in KINDS], "found.base_sha256", "found.spans",
        F.size("found.added").cast("long").alias("n_added"),
    )
