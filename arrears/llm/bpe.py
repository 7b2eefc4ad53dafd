"""Operator 6, BPE encoding and decoding with tree concatenation of long texts.

Short texts are encoded where they lie. A text of more than ``segment`` code
points is cut into segments that are spread over the cluster, encoded in
parallel and joined again:

* at places where the pre-tokenizer splits anyway (a space between word
  characters, or the end of a piece) the halves need no repair;
* inside an unsplit piece (a long run of letters, digits, signs or spaces) the
  piece is halved until each part is short; each join re-encodes a window of
  some tokens on both sides and doubles it until its first and last token are
  those that stood there. Adjacent tokens of a BPE encoding are valid pairwise,
  so the joined list is then the encoding of the whole piece.

Neighbours are joined in pairs, level by level. Special tokens stand for
themselves, as in the tokenizer file.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import documents, small_batches

SEGMENT = 16_384
VOCABULARY = "byte_bpe_50k.tiktoken"
SPECIALS = {"<|endoftext|>": 50256}


@lru_cache(maxsize=4)
def tokenizer(vocabulary: str, specials: tuple):
    """Encoder over a rank file (a path, or the name of a file of the public tokenizers)."""
    import os

    import public_tokenizers
    import tiktoken

    path = vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary)
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=dict(specials))


@lru_cache(maxsize=4)
def _pieces(pattern: str):
    import regex

    return regex.compile(pattern)


def _plain_segments(text: str, size: int, pattern):
    """(kind, text): 0 encode as it is, 2 first part of an unsplit piece, 1 a further part of it."""
    at = 0
    while len(text) - at > size:
        cut, tries = text.rfind(" ", at + size // 2, at + size), 0
        while cut > 0 and tries < 64 and not (text[cut - 1].isalnum() and text[cut + 1].isalnum()):
            cut, tries = text.rfind(" ", at + size // 2, cut), tries + 1
        if cut > 0 and tries < 64:
            yield 0, text[at:cut]
            at = cut
            continue
        start = at
        for m in pattern.finditer(text, at):
            a, b = m.span()
            if b - a > size // 2:
                if a > at:
                    yield 0, text[at:a]
                yield from ((2 if k == 0 else 1, part) for k, part in enumerate(_halves(text[a:b], size // 2)))
                at = b
                break
            if b - at >= size // 2:
                yield 0, text[at:b]
                at = b
                break
        if at == start:
            break
    if at < len(text):
        yield 0, text[at:]


def _halves(piece: str, size: int):
    if len(piece) <= size:
        return [piece]
    half = len(piece) // 2
    return _halves(piece[:half], size) + _halves(piece[half:], size)


def segments(text: str, size: int, pattern, specials) -> list[tuple[int, str]]:
    """Parts that can be encoded apart; specials are never cut."""
    if len(text) <= size:
        return [(0, text)]
    parts = re.split("(" + "|".join(map(re.escape, specials)) + ")", text) if specials else [text]
    return [s for part in parts for s in ([(0, part)] if part in specials else _plain_segments(part, size, pattern))]


class _Tokens:
    """Tokens of neighbouring segments; ``first`` and ``last`` are the lengths of the unsplit runs at the two ends."""

    __slots__ = ("ids", "kind", "first", "last")

    def __init__(self, kind: int, ids: np.ndarray):
        self.ids, self.kind = ids, kind
        self.first, self.last = (len(ids) if kind == 1 else 0), (len(ids) if kind else 0)


def _encode(enc, kind: int, text: str) -> np.ndarray:
    if kind:
        return np.array(enc._encode_single_piece(text), np.uint32)
    return np.array(enc.encode(text, allowed_special="all"), np.uint32)


def join_tokens(enc, left: _Tokens, right: _Tokens) -> _Tokens:
    """Concatenate; where the right side continues an unsplit piece, re-encode a growing window around the join."""
    out = _Tokens(0, left.ids)
    out.kind = left.kind
    if right.kind != 1:
        out.ids = np.concatenate([left.ids, right.ids])
        out.first, out.last = left.first, right.last
        return out
    a, b, window = left.last, right.first, 4
    while True:
        l, r = min(window, a), min(window, b)
        old = np.concatenate([left.ids[len(left.ids) - l:], right.ids[:r]])
        new = np.array(enc._encode_single_piece(enc.decode_bytes(old.tolist())), np.uint32)
        if (l == a or new[0] == old[0]) and (r == b or new[-1] == old[-1]):
            break
        window *= 2
    out.ids = np.concatenate([left.ids[: len(left.ids) - l], new, right.ids[r:]])
    run = (a - l) + len(new) + (b - r)  # tokens of the joined unsplit run
    out.first = left.first if left.first < len(left.ids) else run
    out.last = right.last if right.first < len(right.ids) else run
    return out


def tree_join(enc, parts: list[_Tokens]) -> np.ndarray:
    while len(parts) > 1:
        parts = [join_tokens(enc, *parts[i: i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0].ids if parts else np.zeros(0, np.uint32)


def bpe_encode(docs: DataFrame, vocabulary: str = VOCABULARY, specials: dict | None = None, segment: int = SEGMENT,
               decode: bool = False) -> DataFrame:
    """Token ids of every whole text; with ``decode`` also decoded, the text read back from them in the same pass.

    ``docs`` needs doc_id and text; other columns are ignored. Returns one row
    per input row: doc_id, n_tokens, ids (little-endian unsigned 32-bit
    integers, as one binary). Null and empty texts have no tokens. Repeated rows
    stay repeated; texts of any length are encoded whole. Empty table: no rows.
    """
    special = tuple(sorted((SPECIALS if specials is None else specials).items()))

    def back(enc, ids):
        return {"decoded": pa.array([enc.decode(x.tolist()) for x in ids], pa.string())} if decode else {}

    def short(batches):
        enc = tokenizer(vocabulary, special)
        for b in small_batches(batches):
            ids = [_encode(enc, 0, t) if t else np.zeros(0, np.uint32) for t in b.column("text").to_pylist()]
            yield pa.record_batch({"doc_id": b.column("doc_id"), "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                                   "ids": pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())} | back(enc, ids))

    def cut(batches):
        enc = tokenizer(vocabulary, special)
        names = dict(special)
        for b in small_batches(batches):
            for doc, key, text in zip(b.column("doc_id").to_pylist(), b.column("key").to_pylist(), b.column("text").to_pylist()):
                parts = segments(text, segment, _pieces(enc._pat_str), names)
                yield pa.record_batch({"doc_id": pa.array([doc] * len(parts), pa.int64()), "key": pa.array([key] * len(parts), pa.string()),
                                       "at": pa.array(range(len(parts)), pa.int64()), "kind": pa.array([k for k, _ in parts], pa.int32()),
                                       "text": pa.array([t for _, t in parts], pa.string())})

    def part(batches):
        enc = tokenizer(vocabulary, special)
        for b in small_batches(batches):
            ids = [_encode(enc, k, t).tobytes() for k, t in zip(b.column("kind").to_pylist(), b.column("text").to_pylist())]
            yield pa.record_batch([b.column("doc_id"), b.column("key"), b.column("at"), b.column("kind"), pa.array(ids, pa.binary())],
                                  names=["doc_id", "key", "at", "kind", "ids"])

    def join(table: pa.Table) -> pa.Table:
        enc = tokenizer(vocabulary, special)
        table = table.sort_by("at")
        at = table.column("at").to_numpy()
        doubles = int(np.count_nonzero(at == 0))  # repeated rows of one document
        rows = range(0, len(at), doubles)
        kind, ids = table.column("kind").to_pylist(), table.column("ids").to_pylist()
        whole = tree_join(enc, [_Tokens(kind[i], np.frombuffer(ids[i], np.uint32)) for i in rows])
        return pa.table({"doc_id": pa.array([table.column("doc_id")[0].as_py()] * doubles, pa.int64()),
                         "n_tokens": pa.array([len(whole)] * doubles, pa.int64()),
                         "ids": pa.array([whole.astype("<u4").tobytes()] * doubles, pa.binary())} | back(enc, [whole] * doubles))

    out = "doc_id long, n_tokens long, ids binary" + ", decoded string" * decode
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    long = F.length("text") > segment
    cuts = texts.filter(long).withColumn("key", F.sha2("text", 256)).mapInArrow(cut, "doc_id long, key string, at long, kind int, text string")
    parts = cuts.repartition("doc_id", "key", "at").mapInArrow(part, "doc_id long, key string, at long, kind int, ids binary")
    return texts.filter(~long).mapInArrow(short, out).unionAll(parts.groupBy("doc_id", "key").applyInArrow(join, out))


def bpe_decode(tokens: DataFrame, vocabulary: str = VOCABULARY, specials: dict | None = None) -> DataFrame:
    """Text of every row of ids (as ``bpe_encode`` returns them), appended as ``decoded``; specials are kept. Null ids: empty text."""
    special = tuple(sorted((SPECIALS if specials is None else specials).items()))

    def run(batches):
        enc = tokenizer(vocabulary, special)
        for b in small_batches(batches):
            text = [enc.decode(np.frombuffer(x or b"", "<u4").tolist()) for x in b.column("ids").to_pylist()]
            yield pa.record_batch([*b.columns, pa.array(text, pa.string())], names=[*b.schema.names, "decoded"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in tokens.schema)
    return tokens.mapInArrow(run, f"{schema}, decoded string")


def op6_bpe(spark, sf_dir: str) -> DataFrame:
    return bpe_encode(documents(spark, sf_dir), decode=True).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
