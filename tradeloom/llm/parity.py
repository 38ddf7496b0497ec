"""Near-duplicate documents: an n-gram Jaccard join by parity sketches.

A document's set holds the hashes of its distinct five-word shingles. Two documents link when
100 * intersection >= 75 * union, which bounds the symmetric difference of sets of a and b
shingles by (a + b) // 7.

Candidates. Sets are dealt into bands by size. A band has a number of lanes; a shingle's hash
names its lane, and a lane is the XOR of its shingles' hashes. Each shingle in the symmetric
difference changes one lane, so the lanes in which two sketches differ are at most the
difference, and with more lanes than that one lane is equal: documents that share a lane are
candidates (pigeonhole). A document is sketched in its own band and, if it is small enough to
have partners there, in the band below. Lanes are numerous enough that an equal lane is not
just an empty one; the few documents with too many empty lanes also emit these. The same count
says how many lanes a document must share at least: documents that share fewer are left out
before any pair is made.

Sieve. A parity sketch of four bits or more per shingle (each shingle flips a bit) bounds the
difference from below by its Hamming distance. Candidates that pass are compared exactly.

Groups that share a lane are not expanded into pairs. In a group of more than SMALL documents
all are compared with its smallest. Then those outside a group's largest class are compared
with the one of PROBES others that is nearest by the sketches, some rounds long. Those that are
then still outside it are compared by the sketches with all others, block by block, and what
passes exactly. Members of the largest class are never compared with one another, so a large
group of near copies with a few strays is dealt out about once. Links found later join classes,
not documents, so each search for components but the first is a small one.

Removal does not shuffle the texts that stay: rows whose id is in no slot of a bitmap of the
removed and repeated ids pass by, the others are joined by id.

Equal sets are one set throughout. Texts without words link with nothing, with fewer than
five words they are one shingle. Null ids link with nothing new; rows that share an id are
one document. Very long texts are read whole; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeloom.llm.components import components
from tradeloom.llm.frames import col, free_name
from tradeloom.llm.texts import SHINGLE_BITS, mix, shingles, slices, trim, words
from tradeloom.sources.scratch import materialize

PERCENT = 75
SMALL = 8  # documents of a group that is compared pair by pair at once
BLOCK = 512  # documents of a block of a larger group
PROBES = 64  # documents of other classes that one is compared with in a round
ROUNDS = 2  # rounds of these comparisons at most
WIDTH = 2  # a parity sketch has 2**WIDTH bits or more for each shingle, one for ranking has one
FLUSH = 1 << 20  # lanes a task gathers before it passes them on
TASK = 1 << 21  # lanes of a bucket, about
BITMAP = 1 << 24  # bits of the bitmap of documents whose sets are wanted
FEW = 1 << 17  # keys that are sent to all tasks at most, 8 bytes each


def bands() -> tuple[np.ndarray, np.ndarray]:
    """First sizes of the bands, and the lanes of each.

    Sets of one or two shingles link only with equal ones, so bands start at 3. The lanes
    exceed the largest difference of a pair whose smaller set is in the band, a third of it,
    by the empty lanes that are to be expected and some more.
    """
    first = [3]
    while first[-1] < 1 << 40:
        first.append(max(first[-1] + 1, int(first[-1] * 1.75)))
    largest = np.array(first[1:], dtype=np.float64) - 1
    least = np.floor(largest / 3) + 1
    lanes = np.ceil(least / 0.94 + 4 * np.sqrt(0.05 * least) + 1)
    return np.array(first[:-1]), lanes.astype(np.int64)


FIRST, LANES = bands()


def difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Largest symmetric difference of linked sets of these sizes."""
    return (a + b) // 7


def linked(common: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 100 * common >= PERCENT * (a + b - common)


def set_keys(doc: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of the sets of n texts, and two 64-bit keys of each set."""
    size = np.bincount(doc, minlength=n)
    keys = np.zeros((2, n), np.uint64)
    if len(doc):
        first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
        for k, salt in enumerate((0x5851F42D4C957F2D, 0x14057B7EF767814F)):
            keys[k, doc[first]] = np.add.reduceat(mix(value + np.uint64(salt)), first)
    return size, keys[0], keys[1]


def lanes(doc: np.ndarray, value: np.ndarray, size: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Documents, bands and signatures of lanes, in all bands a document is sketched in; and
    documents, bands and the least number of lanes they share there with a document they link
    with: what remains of the lanes after the largest difference and the document's empty ones.
    """
    out: list[list[np.ndarray]] = [[], [], []]
    needs: list[list[np.ndarray]] = [[], [], []]
    own = np.searchsorted(FIRST, size, side="right") - 1
    top = mix(value + np.uint64(0x2545F4914F6CDD1D))
    high = value >> np.uint64(SHINGLE_BITS - 32)
    for below in (0, 1):
        band = own - below
        first_of_own = FIRST[np.maximum(own, 0)]
        # In the band below, partners have at least three quarters of the size.
        there = (own >= 0) if not below else (band >= 0) & (3 * size <= 4 * (first_of_own - 1))
        many = LANES[np.maximum(band, 0)]
        most = difference(size, np.where(below, first_of_own - 1, 4 * size // 3))
        keep = there[doc]
        d, h = doc[keep], high[keep]
        if not len(d):
            continue
        lane = (h * many[d].astype(np.uint64)) >> np.uint64(32)  # ascending inside a document
        new = np.ones(len(d), dtype=bool)
        new[1:] = (d[1:] != d[:-1]) | (lane[1:] != lane[:-1])
        first = np.flatnonzero(new)
        name = (band[d[first]].astype(np.uint64) << np.uint64(40)) | lane[first]
        filled = np.bincount(d[first], minlength=len(size))
        need = many - most - (many - filled)
        here = np.flatnonzero(there)
        for column, x in zip(needs, (here, band[here], np.maximum(need[here], 1))):
            column.append(x)
        for column, x in zip(out, (d[first], band[d[first]], mix(np.bitwise_xor.reduceat(top[keep], first) ^ mix(name)))):
            column.append(x)
        for i in np.flatnonzero(there & (need < 1)):
            mine = lane[first[d[first] == i]].astype(np.int64)
            empty = np.setdiff1d(np.arange(many[i]), mine).astype(np.uint64)
            sig = mix(mix((band[i].astype(np.uint64) << np.uint64(40)) | empty) + np.uint64(1))
            for column, x in zip(out, (np.full(len(empty), i), np.full(len(empty), band[i]), sig)):
                column.append(x)
    if not needs[0]:
        return [np.zeros(0, np.int64)] * 2 + [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)] * 3
    return [np.concatenate(c) for c in out], [np.concatenate(c) for c in needs]


def bits(value: np.ndarray, size: int) -> bytes:
    """Parity sketch of a set; its bits are a power of two, 64 at least."""
    wide = max(6, int(size - 1).bit_length() + WIDTH)
    place = (value >> np.uint64(7)) & np.uint64((1 << wide) - 1)
    return np.packbits((np.bincount(place.astype(np.int64), minlength=1 << wide) & 1).astype(np.uint8)).tobytes()


def folded(sketch: np.ndarray, size: int) -> np.ndarray:
    """A sketch of `size` bytes or more as one of `size` bytes: halves flip each other's bits."""
    while len(sketch) > size:
        sketch = sketch[: len(sketch) // 2] ^ sketch[len(sketch) // 2 :]
    return sketch


def rough(sketch: bytes) -> bytes:
    """A sketch of about one bit per shingle, 64 at least."""
    return folded(np.frombuffer(sketch, np.uint8), max(8, len(sketch) >> WIDTH)).tobytes()


def distance(a: bytes, b: bytes) -> int:
    """Hamming distance of two parity sketches; the wider one is folded first."""
    size = min(len(a), len(b))
    x, y = folded(np.frombuffer(a, np.uint8), size), folded(np.frombuffer(b, np.uint8), size)
    return int(np.bitwise_count(x.view(np.uint64) ^ y.view(np.uint64)).sum())


SUMS = "doc_id long, n long, key long, check long, need long, need_below long"


def summaries(batches):
    """Rows of documents to their sets' sizes, keys and needs (0 where a band has no lanes of it)."""
    for batch in batches:
        for part in slices(batch.column("text")):
            doc, value = shingles(words(part), len(part))
            size, key, check = set_keys(doc, value, len(part))
            _, (d, band, need) = lanes(doc, value, size)
            both = np.zeros((2, len(part)), np.int64)
            below = (np.searchsorted(FIRST, size[d], side="right") - 1 != band).astype(np.int64)
            both[below, d] = need
            yield pa.record_batch(
                {"doc_id": batch.column("doc_id").slice(part.first, len(part)), "n": pa.array(size, pa.int64()),
                 "key": pa.array(key.view(np.int64)), "check": pa.array(check.view(np.int64)),
                 "need": pa.array(both[0]), "need_below": pa.array(both[1])}
            )


def packed(bucket: np.ndarray, columns: list[np.ndarray], kind: int) -> pa.RecordBatch:
    """A row per bucket with the bytes of its part of each column."""
    order = np.argsort(bucket, kind="stable")
    some, first = np.unique(bucket[order], return_index=True)
    bounds = np.append(first, len(bucket))
    cut = [c[order] for c in columns]
    return pa.record_batch(
        [pa.array(some, pa.int32()), pa.array(np.full(len(some), kind, np.int32))]
        + [pa.array([c[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary()) for c in cut],
        names=["bucket", "kind", *[f"c{i}" for i in range(len(cut))]],
    )


def unpacked(table, kinds: list, kind: int) -> list[np.ndarray]:
    """Columns of the rows of one kind of packed rows."""
    mine = table.filter(pc.equal(table.column("kind"), kind))
    return [
        np.concatenate([np.zeros(0, k), *[np.frombuffer(x, k) for x in mine.column(f"c{i}").to_pylist()]])
        for i, k in enumerate(kinds)
    ]


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int32)


# Packed rows: kind 0 holds lanes (32 and 8 bits of the signature; in runs: key, band, length),
# kind 1 holds needs (key, band, lanes).
LANE_ROWS = "bucket int, kind int, c0 binary, c1 binary, c2 binary, c3 binary, c4 binary"
SHARED_ROWS = "bucket int, kind int, c0 binary, c1 binary, c2 binary, c3 binary"
PAIR_ROWS = "bucket int, kind int, c0 binary, c1 binary"
LONGEST = 0xFFFF  # lanes of a run


class Seen:
    """The keys a task has come across, so that copies of a text leave it once."""

    def __init__(self):
        self.keys: set[int] = set()
        self.last = np.zeros(0, dtype=bool)

    def first(self, keys: np.ndarray) -> np.ndarray:
        """Which of `keys` come for the first time; kept as `last`."""
        self.last = np.zeros(len(keys), dtype=bool)
        for i, key in enumerate(keys.tolist()):
            if key not in self.keys:
                self.keys.add(key)
                self.last[i] = True
        return self.last


def packed_lanes(buckets: int):
    """Rows of texts to their lanes by bucket of signatures and their needs by bucket of keys."""

    def pack(sig, key, band) -> pa.RecordBatch:
        bucket = bucket_of(sig, buckets)
        order = np.argsort(bucket, kind="stable")
        sig, key, band, bucket = sig[order], key[order], band[order], bucket[order]
        new = np.append(True, (key[1:] != key[:-1]) | (band[1:] != band[:-1]) | (bucket[1:] != bucket[:-1]))
        place = np.arange(len(sig))
        since = place - np.maximum.accumulate(np.where(new, place, 0))
        first = np.flatnonzero(since % LONGEST == 0)
        length = np.diff(np.append(first, len(sig))).astype(np.uint16)
        some, at = np.unique(bucket, return_index=True)
        lanes_at, runs_at = np.append(at, len(sig)), np.append(np.searchsorted(first, at), len(first))
        # The bucket keeps the signature's first bits; these 40 tell it from others there.
        low, rest = sig.astype(np.uint32), (sig >> np.uint64(32)).astype(np.uint8)
        parts = [(low, lanes_at), (rest, lanes_at), (key[first], runs_at), (band[first].astype(np.uint8), runs_at), (length, runs_at)]
        return pa.record_batch(
            [pa.array(some, pa.int32()), pa.array(np.zeros(len(some), np.int32))]
            + [pa.array([c[a:b].tobytes() for a, b in zip(x[:-1], x[1:])], pa.binary()) for c, x in parts],
            names=["bucket", "kind", *[f"c{i}" for i in range(5)]],
        )

    def emit(batches):
        held: list[tuple] = []
        known = Seen()
        for batch in batches:
            for part in slices(batch.column("text")):
                doc, value = shingles(words(part), len(part))
                size, key, _ = set_keys(doc, value, len(part))
                fresh = known.first(key)[doc]
                (d, band, sig), (_, _, _) = lanes(doc[fresh], value[fresh], np.where(known.last, size, 0))
                if len(sig):
                    held.append((sig, key[d], band))
                if sum(len(x[0]) for x in held) >= FLUSH:
                    yield pack(*[np.concatenate(x) for x in zip(*held)])
                    held = []
        if held:
            yield pack(*[np.concatenate(x) for x in zip(*held)])

    return emit


def in_groups(sig: np.ndarray, keys: np.ndarray, *more: np.ndarray) -> list[np.ndarray]:
    """Distinct (signature, key) pairs, sorted, of signatures that have two keys at least."""
    order = np.argsort(sig)
    same = sig[order][1:] == sig[order][:-1]
    some = order[np.append(False, same) | np.append(same, False)]
    some = some[np.lexsort((keys[some], sig[some]))]
    sig, keys = sig[some], keys[some]
    new = np.append(True, (sig[1:] != sig[:-1]) | (keys[1:] != keys[:-1])) if len(sig) else np.zeros(0, bool)
    sig, keys, some = sig[new], keys[new], some[new]
    same = sig[1:] == sig[:-1]
    good = np.append(False, same) | np.append(same, False) if len(sig) else np.zeros(0, bool)
    return [sig[good], keys[good], *[m[some[good]] for m in more]]


def shared_lanes(buckets: int):
    """Lanes of a bucket that two sets share, by bucket of keys: key, band, signature, sets."""

    def share(key, table):
        trim()
        low, rest = unpacked(table, [np.uint32, np.uint8], 0)
        number = np.uint64(table.column("bucket")[0].as_py())
        sig = low.astype(np.uint64) | (rest.astype(np.uint64) << np.uint64(32)) | (number << np.uint64(40))
        mine = table.column("c4").to_pylist()
        length = np.concatenate([np.frombuffer(x, np.uint16) for x in mine])
        keys = np.repeat(np.concatenate([np.frombuffer(x, np.uint64) for x in table.column("c2").to_pylist()]), length)
        band = np.repeat(np.concatenate([np.frombuffer(x, np.uint8) for x in table.column("c3").to_pylist()]), length)
        sig, keys, band = in_groups(sig, keys, band)
        _, counts = np.unique(sig, return_counts=True)
        sharing = np.repeat(counts, counts).astype(np.uint32)
        return pa.Table.from_batches([packed(bucket_of(mix(keys), buckets), [keys, band, sig, sharing], 0)])

    return share


def packed_needs(buckets: int):
    """Sets to the lanes they must share, by bucket of keys: key, band, number."""

    def emit(batches):
        for batch in batches:
            key = batch.column("key").to_numpy().view(np.uint64)
            band = np.searchsorted(FIRST, batch.column("n").to_numpy(), side="right") - 1
            need = [batch.column(c).to_numpy() for c in ("need", "need_below")]
            rows = [(key[x > 0], band[x > 0] - below, x[x > 0]) for below, x in enumerate(need)]
            key, band, x = (np.concatenate(c) for c in zip(*rows))
            if len(key):
                none = np.zeros(len(key), np.uint8)
                yield packed(bucket_of(mix(key), buckets), [key, band.astype(np.uint8), x.astype(np.uint64), none], 1)

    return emit


def enough_lanes(buckets: int):
    """Lanes of the sets that share as many as a link takes, by bucket of signatures.

    A set that shares s lanes and must share n of them with a partner keeps s - n + 1, those
    that the fewest sets share: in this common order a partner's part meets its own.
    """

    def enough(key, table):
        trim()
        keys, band, sig, sharing = unpacked(table, [np.uint64, np.uint8, np.uint64, np.uint32], 0)
        known, known_band, need = unpacked(table, [np.uint64, np.uint8, np.uint64], 1)
        name, wanted = mix(keys ^ mix(band.astype(np.uint64))), mix(known ^ mix(known_band.astype(np.uint64)))
        order = np.lexsort((sig, sharing, name))
        name, sig, keys = name[order], sig[order], keys[order]
        first = np.flatnonzero(np.append(True, name[1:] != name[:-1])) if len(name) else np.zeros(0, np.int64)
        counts = np.diff(np.append(first, len(name)))
        by = np.argsort(wanted)
        needed = need[by][np.searchsorted(wanted[by], name[first])].astype(np.int64)
        keep = np.arange(len(name)) - np.repeat(first, counts) < np.repeat(counts - needed + 1, counts)
        return pa.Table.from_batches([packed(bucket_of(mix(sig[keep]), buckets), [sig[keep], keys[keep]], 0)])

    return enough


def candidates(key, table):
    """Pairs of sets that share a lane of a bucket.

    kind 0: a pair to compare; kind 1: (signature, member) of a group of more than SMALL sets,
    of which only pairs with the first member are listed.
    """
    trim()
    sig, keys = in_groups(*unpacked(table, [np.uint64, np.uint64], 0))
    first = np.flatnonzero(np.append(True, sig[1:] != sig[:-1])) if len(sig) else np.zeros(0, np.int64)
    many = np.diff(np.append(first, len(sig)))
    a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for size in range(2, SMALL + 1):
        at = first[many == size]
        for i in range(size):
            for j in range(i + 1, size):
                a.append(keys[at + i])
                b.append(keys[at + j])
    large = np.repeat(many > SMALL, many)
    lead = np.repeat(first, many)
    others = large & (lead != np.arange(len(sig)))
    a.append(keys[lead[others]])
    b.append(keys[others])
    pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], axis=1), axis=0)
    x = np.concatenate([pairs[:, 0], sig[large]]).view(np.int64)
    y = np.concatenate([pairs[:, 1], keys[large]]).view(np.int64)
    kind = np.append(np.zeros(len(pairs), np.int32), np.ones(int(large.sum()), np.int32))
    return pa.table({"kind": pa.array(kind), "a": pa.array(x), "b": pa.array(y)})


def wanted_sets(sent):
    """Rows of documents in the bitmap to their sets: key, size, parity sketch, hashes."""

    def emit(batches):
        bitmap, known = np.frombuffer(sent.value, np.uint8), Seen()
        for batch in batches:
            slot = batch.column("slot").to_numpy()
            batch = batch.filter(pa.array((bitmap[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)))
            if not batch.num_rows:
                continue
            for part in slices(batch.column("text")):
                doc, value = shingles(words(part), len(part))
                size, key, _ = set_keys(doc, value, len(part))
                bounds = np.searchsorted(doc, np.arange(len(part) + 1))
                fresh = np.flatnonzero(known.first(key) & (size > 0))
                sets = [value[bounds[i] : bounds[i + 1]] for i in fresh]
                sketches = [bits(s, len(s)) for s in sets]
                yield pa.record_batch(
                    {"key": pa.array(key[fresh].view(np.int64)), "n": pa.array(size[fresh], pa.int64()),
                     "sketch": pa.array(sketches, pa.binary()),
                     "rough": pa.array([rough(x) for x in sketches], pa.binary()),
                     "hashes": pa.array([s.tobytes() for s in sets], pa.binary())}
                )

    return emit


def sieve(batches):
    """Pairs whose sketches allow a link."""
    for batch in batches:
        a, b = batch.column("sketch_a").to_pylist(), batch.column("sketch_b").to_pylist()
        most = difference(batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy())
        keep = [distance(x, y) <= m for x, y, m in zip(a, b, most.tolist())]
        yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])


def exact(batches):
    """Pairs of sets that link."""
    for batch in batches:
        a, b = batch.column("hashes_a").to_pylist(), batch.column("hashes_b").to_pylist()
        keep = []
        for x, y in zip(a, b):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = np.concatenate([x, y])
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            keep.append(bool(linked(common, len(x), len(y))))
        yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])


def slot_of(doc_id: Column) -> Column:
    """One of BITMAP slots of an id, numbered from 1."""
    return F.pmod(F.xxhash64(doc_id.cast("long")), F.lit(BITMAP)) + 1


def slots_of(ids: DataFrame) -> DataFrame:
    """`bucket`, `bits`: the slots of `doc_id`, 32768 of a bucket, least bit of a byte first."""
    slot = slot_of(F.col("doc_id"))
    return ids.where("doc_id is not null").groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")
    )


def bitmap_of(ids: DataFrame) -> bytes:
    """The bits of the slots of `doc_id`, least bit of a byte first; BITMAP bits, made by the tasks."""
    out = np.zeros(BITMAP // 8, np.uint8)
    for row in slots_of(ids).collect():
        first = (row["bucket"] - 1) * 4096  # 32768 bits of a bucket
        out[first : first + 4096] = np.frombuffer(row["bits"], np.uint8)
    return out.tobytes()


def parted(docs: DataFrame, ids: DataFrame, doc_id: str) -> tuple[DataFrame, DataFrame]:
    """The rows of `docs` whose slot holds none of `ids`, and the others.

    The first need not be joined with `ids`, so their texts are not shuffled for it. The slots
    are BITMAP // 32768 rows at most, of 4 KB each, whatever the number of ids.
    """
    bucket, bits, known = (free_name(docs, n) for n in ("slot_bucket", "slot_bits", "slot_known"))
    slots = materialize(slots_of(ids), "parity-slots").select(F.col("bucket").alias(bucket), F.col("bits").alias(bits))
    slot = slot_of(col(doc_id))
    place = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substr(F.col(bits), (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    held = F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))
    marked = docs.join(F.broadcast(slots), F.bitmap_bucket_number(slot) == F.col(bucket), "left").withColumn(known, held)
    marked = marked.select(*[col(c) for c in docs.columns], known)
    return marked.where(~F.col(known)).drop(known), marked.where(known).drop(known)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The distinct pairs (a, b) of keys that link.

    Where the pairs name few sets these are picked out before they are shuffled.
    """
    pairs = materialize(pairs.distinct(), "parity-pairs")
    keys = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
    if keys.limit(FEW + 1).count() <= FEW:
        sets = sets.join(F.broadcast(keys), "key", "left_semi")
    small = sets.select("key", "n", "sketch")
    sized = (
        pairs
        .join(small.select(F.col("key").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a")), "a")
        .join(small.select(F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b")), "b")
        .where("4 * least(n_a, n_b) >= 3 * greatest(n_a, n_b)")
    )
    passed = sized.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(sieve, "a long, b long")
    return (
        passed.join(sets.select(F.col("key").alias("a"), F.col("hashes").alias("hashes_a")), "a")
        .join(sets.select(F.col("key").alias("b"), F.col("hashes").alias("hashes_b")), "b")
        .select("a", "b", "hashes_a", "hashes_b").mapInArrow(exact, "a long, b long")
    )


def groups_of(table):
    """The groups of a task: rows of the left and the right side, sketches as words, the rest."""
    sig = table.column("sig").to_numpy()
    side = table.column("side").to_numpy()
    member, kind, n = (table.column(c).to_numpy() for c in ("member", "class", "n"))
    sketch = table.column("sketch").to_pylist()
    order = np.argsort(sig, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(sig[order])) + 1):
        size = min(len(sketch[i]) for i in group.tolist())
        words = np.stack([folded(np.frombuffer(sketch[i], np.uint8), size).view(np.uint64) for i in group.tolist()])
        yield member[group], kind[group], n[group], words, np.flatnonzero(side[group] == 0), np.flatnonzero(side[group] == 1)


def near(i: int, others: np.ndarray, kind, n, words) -> tuple[np.ndarray, np.ndarray]:
    """Those of `others` in another class than i that may link with it, and their distances."""
    others = others[(kind[others] != kind[i]) & (4 * np.minimum(n[others], n[i]) >= 3 * np.maximum(n[others], n[i]))]
    apart = np.bitwise_count(words[others] ^ words[i]).sum(axis=1, dtype=np.int64)
    good = apart <= difference(n[others], n[i])
    return others[good], apart[good]


def cross_pairs(key, table):
    """Pairs of a block of groups whose classes differ and whose sketches allow a link."""
    trim()
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for member, kind, n, words, left, right in groups_of(table):
        for i in left.tolist():
            found, _ = near(i, right, kind, n, words)
            a.append(np.minimum(member[found], member[i]))
            b.append(np.maximum(member[found], member[i]))
    pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], axis=1), axis=0)
    return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})


def nearest_pairs(turn: int):
    """For members of a left block: the nearest of some of another class, if it may link."""

    def nearest(key, table):
        trim()
        best: dict[int, tuple[int, int]] = {}
        for member, kind, n, words, left, right in groups_of(table):
            for i in left.tolist():
                others = right[kind[right] != kind[i]]
                if len(others) > PROBES:
                    step = (i * 7919 + turn * 104729 + np.arange(PROBES) * (len(others) // PROBES)) % len(others)
                    others = others[step]
                found, apart = near(i, others, kind, n, words)
                if len(found):
                    k = int(apart.argmin())
                    best[int(member[i])] = min(best.get(int(member[i]), (1 << 62, 0)), (int(apart[k]), int(member[found[k]])))
        return pa.table({
            "member": pa.array(list(best), pa.int64()), "apart": pa.array([x for x, _ in best.values()], pa.int64()),
            "other": pa.array([x for _, x in best.values()], pa.int64()),
        })

    return nearest


def mixed_groups(members: DataFrame, classes: DataFrame, sketches: DataFrame, buckets: int) -> DataFrame:
    """Members of large groups that are not one class yet, dealt out for comparison.

    The members outside a group's largest class (side 0) meet all its members (side 1). Both are
    dealt into blocks of about BLOCK and each two blocks are a task, groups of one block each
    share tasks. A member of the largest class so goes to as many tasks as there are blocks of
    the others.
    """
    placed = members.join(classes.withColumnRenamed("id", "member"), "member", "left").select(
        "sig", "member", F.coalesce("component", "member").alias("class")
    )
    sizes = placed.groupBy("sig", "class").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("sig").agg(
        F.count("*").alias("classes"), F.sum("n").alias("size"), F.max(F.struct("n", "class")).alias("top")
    ).where("classes > 1").select(
        "sig", F.col("top.class").alias("largest"),
        F.ceil((F.col("size") - F.col("top.n")) / BLOCK).cast("int").alias("lefts"),
        F.ceil(F.col("size") / BLOCK).cast("int").alias("rights"),
    )
    rows = placed.join(mixed, "sig").join(sketches.withColumnRenamed("key", "member"), "member")

    def dealt(side: int, some: DataFrame, own: str, others: str) -> DataFrame:
        block = F.pmod(F.xxhash64("member"), F.col(own)).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.col(others) - 1))
        i, j = (block.alias("i"), other.alias("j")) if side == 0 else (other.alias("i"), block.alias("j"))
        shared = (F.col("lefts") == 1) & (F.col("rights") == 1)
        spot = F.when(shared, F.pmod(F.xxhash64("sig"), F.lit(8 * buckets)).cast("long")).otherwise(F.col("sig"))
        return some.select("sig", "member", "class", "n", "sketch", F.lit(side).alias("side"), spot.alias("spot"), i, j)

    strangers = rows.where(F.col("class") != F.col("largest"))
    return dealt(0, strangers, "lefts", "rights").union(dealt(1, rows, "rights", "lefts"))


def joined(classes: DataFrame, links: DataFrame) -> DataFrame:
    """`classes` (id, component) with the classes joined that the links (a, b) connect.

    Ids that are in no class yet are classes of their own.
    """
    between = links
    for side in ("a", "b"):
        named = classes.select(F.col("id").alias(side), F.col("component").alias(f"_{side}"))
        between = between.join(named, side, "left").withColumn(side, F.coalesce(f"_{side}", side)).drop(f"_{side}")
    more = components(between.where("a != b"), label="parity-classes")
    more = more.select(F.col("id").alias("component"), F.col("component").alias("least"))
    known = classes.join(more, "component", "left").select("id", F.coalesce("least", "component").alias("component"))
    new = more.join(classes, "component", "left_anti").select(F.col("component").alias("id"), F.col("least").alias("component"))
    return materialize(known.union(new), "parity-classes")


def further_classes(members: DataFrame, classes: DataFrame, sets: DataFrame, buckets: int) -> DataFrame:
    """`classes` and what still joins them within large groups."""
    task = ["spot", "i", "j"]
    roughly = sets.select("key", "n", F.col("rough").alias("sketch"))
    for turn in range(ROUNDS):
        probes = mixed_groups(members, classes, roughly, buckets).groupBy(*task).applyInArrow(
            nearest_pairs(turn), "member long, apart long, other long"
        )
        pairs = probes.groupBy("member").agg(F.min_by("other", F.struct("apart", "other")).alias("other")).select(
            F.least("member", "other").alias("a"), F.greatest("member", "other").alias("b")
        )
        found = materialize(verified(pairs, sets), "parity-probes")
        if found.isEmpty():
            break
        classes = joined(classes, found)
    wide = sets.select("key", "n", "sketch")
    rest = mixed_groups(members, classes, wide, buckets).groupBy(*task).applyInArrow(cross_pairs, "a long, b long")
    found = materialize(verified(rest, sets), "parity-rest")
    return classes if found.isEmpty() else joined(classes, found)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id`, `n_shingles`, `component_id`: a row for each row of `docs`."""
    spark = docs.sparkSession
    rows = docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).alias("text"))
    sums = materialize(rows.mapInArrow(summaries, SUMS), "parity-sums")
    reps = sums.where("n > 0").groupBy("key", "check", "n", "need", "need_below").agg(F.min("doc_id").alias("rep"))
    held = reps.agg(F.sum("n")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(held // TASK) + 1)

    needs = reps.select("key", "n", "need", "need_below").mapInArrow(packed_needs(buckets), SHARED_ROWS)
    found = materialize(
        rows.select("text").mapInArrow(packed_lanes(buckets), LANE_ROWS)
        .groupBy("bucket").applyInArrow(shared_lanes(buckets), SHARED_ROWS).union(needs)
        .groupBy("bucket").applyInArrow(enough_lanes(buckets), PAIR_ROWS)
        .groupBy("bucket").applyInArrow(candidates, "kind int, a long, b long"),
        "parity-candidates",
    )
    pairs = found.where("kind = 0").select("a", "b")
    members = found.where("kind = 1").select(F.col("a").alias("sig"), F.col("b").alias("member"))
    # All members of large groups are in pairs with the first.
    keys = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
    wanted = materialize(reps.join(keys, "key", "left_semi").select("key", F.col("rep").alias("doc_id")), "parity-wanted")
    if wanted.isEmpty():
        classes = spark.createDataFrame([], "id long, component long")
    else:
        sent = spark.sparkContext.broadcast(bitmap_of(wanted))
        slot = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(BITMAP)), F.lit(0)).alias("slot")
        sets = rows.where("doc_id is not null").select("doc_id", "text", slot).mapInArrow(
            wanted_sets(sent), "key long, n long, sketch binary, rough binary, hashes binary"
        )
        # Other documents in a wanted slot, and the repeated rows of one, go here.
        sets = materialize(sets.join(wanted.select("key"), "key", "left_semi").dropDuplicates(["key"]), "parity-sets")
        classes = materialize(components(verified(pairs, sets), label="parity-classes"), "parity-classes")
        if not members.isEmpty():
            classes = further_classes(members, classes, sets, buckets)
    known = reps.join(classes, F.col("key") == F.col("id"), "left").select(
        "key", "check", "n", "rep", F.coalesce("component", "key").alias("class")
    )
    known = materialize(known, "parity-known")
    # Rows that share an id are one document.
    repeated = sums.where("n > 0 and doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1")
    again = sums.where("n > 0").join(repeated, "doc_id", "left_semi").join(known, ["key", "check", "n"])
    again = again.select("doc_id", "class").distinct()
    lowest = again.groupBy("doc_id").agg(F.min("class").alias("a"))
    again = materialize(again.join(lowest, "doc_id").select("a", F.col("class").alias("b")).where("a != b"), "parity-again")
    if not again.isEmpty():
        more = components(again, label="parity-again").select(F.col("id").alias("class"), F.col("component").alias("least"))
        known = known.join(more, "class", "left").withColumn("class", F.coalesce("least", "class")).drop("least")
    least = known.groupBy("class").agg(F.min("rep").alias("component"))
    known = known.join(least, "class").select("key", "check", "n", "component")
    return sums.join(known, ["key", "check", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` with one of each class: the smallest id, and of rows that share it the
    first by text. Rows with a null id, and texts without words, stay."""
    classes = materialize(near_duplicates(docs, doc_id, text), "parity-result")
    gone, again, place = (free_name(docs, n) for n in ("gone_id", "repeated_id", "place"))
    removed = classes.where("component_id != doc_id").select("doc_id").distinct()
    repeated = classes.where("doc_id is not null and n_shingles > 0").groupBy("doc_id").agg(
        F.count("*").alias("rows")
    ).where("rows > 1").select("doc_id")
    # Most rows are in no slot of an id to look at and stay as they are.
    others, rows = parted(docs, removed.union(repeated), doc_id)
    kept = rows.join(removed.withColumnRenamed("doc_id", gone), col(doc_id) == col(gone), "left_anti")
    if repeated.isEmpty():
        return others.union(kept)
    repeated = repeated.withColumnRenamed("doc_id", again)
    first = Window.partitionBy(col(doc_id)).orderBy(F.col(text).asc_nulls_last())
    return others.union(kept.join(repeated, col(doc_id) == col(again), "left_anti")).union(
        kept.join(repeated, col(doc_id) == col(again), "left_semi")
        .withColumn(place, F.row_number().over(first)).where(col(place) == 1).drop(place)
    )


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
