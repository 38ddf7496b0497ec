"""Token counts of whole texts, huge ones by overlapping chunks that are spliced.

A text longer than a chunk is encoded in chunks that overlap. Two neighbouring encodings are
spliced at a position inside their overlap where both have a token boundary and where the
vocabulary's splitting pattern ends a piece whatever surrounds it: after a letter before
anything but a letter, after a digit before anything but a digit, after any visible character
before white space. Pieces are encoded independently, so at such a position the encoding of
the whole text has a boundary too, and the tokens on its left and right are those of the left
and right chunk. Without such a position the overlap is doubled, up to the whole text.

Null texts count as empty, with 0 bytes and tokens. Repeated rows count alike, other columns
are not read, an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.frames import col
from tradeloom.llm.texts import slices

LIMIT = 512
CHUNK = 1 << 14  # characters of a chunk, without its overlap
OVERLAP = 1 << 8
# Characters at a chunk's end whose encoding may depend on what follows it, or which may be
# part of a special string cut by the end.
MARGIN = 32
# The vocabulary as ranks for the encoder, and its special strings (a fixed value).
VOCABULARY = "byte_bpe_50k.tiktoken"
SPECIAL = {"<|endoftext|>": 50256}

Encode = Callable[[str], np.ndarray]  # the byte length of each token of a text
_encoders: dict[str, Encode] = {}


def encoder(vocabulary: str = VOCABULARY) -> Encode:
    """The encoder of a vocabulary file: ranks, tokenizers' JSON or a sentencepiece model.

    It is made once in each Python worker. Special strings inside texts are encoded as such.
    """
    if vocabulary not in _encoders:
        import public_tokenizers

        path = public_tokenizers.path(vocabulary)
        if vocabulary.endswith(".tiktoken"):
            import tiktoken

            with open(path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            special = {k: v for k, v in SPECIAL.items() if v not in ranks.values()}
            made = tiktoken.Encoding(
                vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
            )
            length = np.zeros(max([*ranks.values(), *special.values()]) + 1, np.int64)
            for token, rank in ranks.items():
                length[rank] = len(token)
            for token, rank in special.items():
                length[rank] = len(token.encode())
            _encoders[vocabulary] = lambda text: length[
                np.array(made.encode(text, allowed_special="all"), dtype=np.int64)
            ]
        elif vocabulary.endswith(".json"):
            from tokenizers import Tokenizer

            loaded = Tokenizer.from_file(path)

            def lengths(text: str) -> np.ndarray:
                found = loaded.encode(text, add_special_tokens=False).offsets
                ends = np.array([0] + [e for _, e in found], dtype=np.int64)
                points = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
                at = np.append(np.flatnonzero((points & 0xC0) != 0x80), len(points))
                return np.diff(at[ends])

            _encoders[vocabulary] = lengths
        else:
            raise ValueError(f"no encoder for {vocabulary}: its pieces may cross any position of a text")
    return _encoders[vocabulary]


def blank(char: str) -> bool:
    """Whether a character is white space to the pattern; to Python U+001C to U+001F are too."""
    return char.isspace() and not "\x1c" <= char <= "\x1f"


def ends_piece(before: str, after: str) -> bool:
    """Whether the splitting pattern ends a piece between these characters in any text."""
    if blank(before):
        return False
    if blank(after):
        return True
    a, b = unicodedata.category(before)[0], unicodedata.category(after)[0]
    return a in "LN" and a != b


def splice_point(
    text: str, origin: int, low: int, high: int, left: np.ndarray, right: np.ndarray
) -> int | None:
    """First proven boundary that both encodings have, in bytes; positions run from low to high.

    text: the characters of the overlap, whose first is at byte `origin`.
    """
    common = np.intersect1d(left, right, assume_unique=False)
    common = common[(common > max(low, origin)) & (common < high)]
    if not len(common):
        return None
    data = text.encode("utf-8")
    for p in common.tolist():
        at = p - origin
        if at >= len(data):
            return None
        if (data[at] & 0xC0) == 0x80:
            continue  # inside a character
        k = at - 1
        while (data[k] & 0xC0) == 0x80:
            k -= 1
        if ends_piece(data[k:at].decode(), data[at : at + 4].decode("utf-8", "ignore")[0]):
            return p
    return None


def count(text: str, encode: Encode, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Number of tokens of `text`."""
    n = len(text)
    if n <= chunk + overlap:
        return len(encode(text))

    def bounds(a: int, b: int, origin: int) -> np.ndarray:
        lengths = encode(text[a:b])
        return np.concatenate([[origin], origin + np.cumsum(lengths)])

    total, start, a, origin = 0, 0, 0, 0  # start: byte up to which tokens are counted
    b = min(n, a + chunk + overlap)
    left = bounds(a, b, origin)
    while b < n:
        nxt = a + chunk
        nxt_origin = origin + len(text[a:nxt].encode())
        wide = overlap
        while True:
            end = min(n, max(nxt + chunk + overlap, b))
            right = bounds(nxt, end, nxt_origin)
            safe = b - MARGIN if b < n else b
            high = nxt_origin + len(text[nxt:safe].encode()) if safe > nxt else nxt_origin
            low = nxt_origin + len(text[nxt : nxt + MARGIN].encode())
            p = splice_point(text[nxt:b], nxt_origin, low, high, left, right)
            if p is not None or b == n:
                break
            wide *= 2
            b = min(n, nxt + wide)
            left = bounds(a, b, origin)
        if p is None:  # the left chunk has been widened to the end
            break
        total += int(np.searchsorted(left, p) - np.searchsorted(left, start))
        start, a, origin, b, left = p, nxt, nxt_origin, end, right
    return total + int(len(left) - 1 - np.searchsorted(left, start))


def counter(vocabulary: str = VOCABULARY, chunk: int = CHUNK, overlap: int = OVERLAP):
    """Column function of a text: `n_bytes` and `n_tokens`."""

    @F.arrow_udf("struct<n_bytes: long, n_tokens: long>")
    def counts(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = encoder(vocabulary)
        for column in columns:
            sizes, tokens = [np.zeros(0, np.int64)], []
            for part in slices(column):
                sizes.append(np.diff(part.offsets))
                for i in range(len(part)):
                    tokens.append(count(part.text(i).decode("utf-8", "replace"), encode, chunk, overlap))
            yield pa.StructArray.from_arrays(
                [pa.array(np.concatenate(sizes), pa.int64()), pa.array(tokens, pa.int64())], ["n_bytes", "n_tokens"]
            )

    return counts


def token_counts(text: Column, vocabulary: str = VOCABULARY) -> Column:
    return counter(vocabulary)(text)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = docs.select("doc_id", token_counts(col("text")).alias("found"))
    return found.select("doc_id", "found.n_bytes", "found.n_tokens", (F.col("found.n_tokens") > LIMIT).alias("over_limit"))
