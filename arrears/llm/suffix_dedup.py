"""Operator 1, exact substring dedup over a distributed prefix-free parse.

A rolling hash picks *triggers*: the smallest 16-byte hash of every 50-byte
window. Each trigger with the bytes around it that a 50-byte match through it
can see is a *phrase*; the corpus is parsed into phrases, and equal stretches
of text give equal phrases wherever they stand.

1. Dictionary: every bucket of phrases (by trigger) is sorted by trigger, then
   phrase, then document. Equal phrases meet, so all windows of a repeated
   phrase are known from its first document; triggers with one phrase only
   occur once or in whole copies and need nothing more.
2. Suffixes: only where one trigger stands in several distinct phrases that
   also agree in half of what a match needs on the left or on the right (the
   rims of repeated passages) are the phrases' suffixes, cut to 50 bytes, put
   in order, again bucket by bucket, each with its first document.
3. Parse: every document combines both answers into removed byte ranges.

Suffix order enters as far as a 50-byte match can see: suffixes are ordered by
a hash of their first 50 bytes, which keeps equal prefixes adjacent (all that
the removal rule asks) and lets Spark shuffle 8 bytes a suffix instead of 50.

Skew: each block of documents sends one entry per distinct phrase or suffix
(its smallest document) and at most ``PER_TRIGGER`` phrases per trigger (those
beyond are compared suffix by suffix), so a passage in a third of all documents
costs each bucket a few entries per block, not per document. Text is shuffled once; the plan reuses that exchange. Memory: one
block of about 512 documents, one bucket of hashes.

Equality is judged by hashes: 80 bits for phrases, 64 for suffixes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import RangeHash, documents, mix, shuffle_partitions, text_chunks

DOCS_PER_BLOCK = 512
TRIGGER = 16
#: phrases per trigger that a block sends; a trigger with that many is taken to match on both sides everywhere
PER_TRIGGER = 16
_ENTRY = "bucket long, block long, docs binary, keys binary, high binary, low binary, left binary, right binary"
_FLAG = "block long, kind int, keys binary, docs binary"
_OUT = "doc_id long, n_bytes long, spans array<long>, kept binary"


def _raw(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


def _join(column, dtype) -> np.ndarray:
    parts = [np.frombuffer(x, dtype) for x in column.to_pylist() if x]
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def _pack_docs(docs: np.ndarray) -> np.ndarray:
    """Ascending ids as steps, which are nearly all zero or short."""
    step = np.diff(docs, prepend=0)
    return step.astype(np.int32) if len(step) and abs(step).max() < 2**31 else step


def _unpack_docs(column, counts: np.ndarray) -> np.ndarray:
    parts = [np.cumsum(np.frombuffer(x, np.int32 if len(x) == 4 * n else np.int64), dtype=np.int64) for x, n in zip(column.to_pylist(), counts) if n]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _counts(column, width: int) -> np.ndarray:
    return np.array([len(x) // width for x in column.to_pylist()], np.int64)


class _Block:
    """Triggers of one block of documents, sorted by doc_id; one entry per run of windows with the same trigger."""

    def __init__(self, table: pa.Table, match: int):
        table = table.sort_by("doc_id")
        self.match, self.ids, self.parts = match, table.column("doc_id").to_numpy(), []
        for i, j, data, off in text_chunks(table.column("text")):
            self.parts.append((i, j, data, off, self._parse(data, off)))
        keep = [p[4] for p in self.parts if p[4] is not None]
        self.doc = np.concatenate([self.ids[i + p["doc"]] for i, _, _, _, p in self.parts if p is not None]) if keep else np.zeros(0, np.int64)
        gather = lambda name, kind: np.concatenate([p[name] for p in keep]) if keep else np.zeros(0, kind)
        self.trigger, self.left, self.right = gather("trigger", np.uint64), gather("left", np.uint16), gather("right", np.uint16)
        self.short = (self.trigger >> np.uint64(32)).astype(np.uint32)
        self.phrase = _code(gather("phrase", np.uint64) >> np.uint64(16), self.short)

    def _parse(self, data: np.ndarray, off: np.ndarray) -> dict | None:
        span, n = self.match - TRIGGER, len(data)  # a window sees span + 1 trigger places
        if n < self.match:
            return None
        hashed = RangeHash(data)
        grams = hashed.every(TRIGGER)
        low, place, width = grams, np.arange(len(grams), dtype=np.int32), 1
        while width <= span:  # the smallest gram of each window; of equal ones the later, so that the window's bytes alone decide
            step = min(width, span + 1 - width)
            later = low[step:] <= low[:-step]
            low, place = np.where(later, low[step:], low[:-step]), np.where(later, place[step:], place[:-step])
            width += step
        lengths = np.diff(off)
        end_of = np.repeat(off[1:], lengths)
        windows = np.flatnonzero(np.arange(n - self.match + 1) + self.match <= end_of[: n - self.match + 1])
        if not len(windows):
            return None
        at = place[windows].astype(np.int64)
        new = np.ones(len(windows), bool)
        new[1:] = (at[1:] != at[:-1]) | (windows[1:] != windows[:-1] + 1)
        head = np.flatnonzero(new)
        p, first = at[head], windows[head]
        last = windows[np.append(head[1:], len(windows)) - 1]
        doc = np.searchsorted(off, p, side="right") - 1
        lo, hi = np.maximum(p - span, off[doc]), np.minimum(p + self.match, off[doc + 1])
        half = (span + 1) // 2  # a match reaches that far to the left or to the right of the trigger
        side = lambda a, b: (hashed(a, b) >> np.uint64(48)).astype(np.uint16)
        return {"doc": doc, "first": first, "last": last, "lo": lo, "hi": hi, "hash": hashed, "half": p - half,
                "left": side(np.maximum(p - half, lo), p), "right": side(p, np.minimum(p + TRIGGER + half, hi)),
                "trigger": mix(grams[p]), "phrase": mix(hashed(lo, hi) + (p - lo).astype(np.uint64))}


def _code(high: np.ndarray, short: np.ndarray) -> np.ndarray:
    """Name of a phrase inside a block: 48 bits of its hash and 16 of its trigger's."""
    return (high << np.uint64(16)) | (short.astype(np.uint64) & np.uint64(0xFFFF))


def _firsts(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the smallest document of each."""
    order = np.lexsort((docs, keys))
    k = keys[order]
    head = np.ones(len(k), bool)
    head[1:] = k[1:] != k[:-1]
    return k[head], docs[order][head]


_BLOBS = ("docs", "keys", "high", "low", "left", "right")


def _send(block: int, bucket: np.ndarray, columns: list[np.ndarray]) -> pa.Table:
    """One row per bucket; missing columns are empty."""
    order = np.argsort(bucket, kind="stable")
    names, cut = np.unique(bucket[order], return_index=True)
    edges = np.append(cut, len(order))
    blobs = [[_raw((_pack_docs if k == 0 else np.asarray)(c[order[a:b]])) for a, b in zip(edges[:-1], edges[1:])] for k, c in enumerate(columns)]
    blobs += [[b""] * len(names)] * (len(_BLOBS) - len(blobs))
    return pa.table({"bucket": pa.array(names, pa.int64()), "block": pa.array(np.full(len(names), block), pa.int64()),
                     **{n: pa.array(b, pa.binary()) for n, b in zip(_BLOBS, blobs)}})


def _sent(b: _Block) -> tuple[np.ndarray, np.ndarray]:
    """Entries that a block sends (one per distinct phrase, its smallest document) and which of all entries those do not stand for."""
    order = np.lexsort((b.doc, b.phrase, b.trigger))
    t, p = b.trigger[order], b.phrase[order]
    new_t, new_p = np.ones(len(t), bool), np.ones(len(t), bool)
    new_t[1:] = t[1:] != t[:-1]
    new_p[1:] = new_t[1:] | (p[1:] != p[:-1])
    rank = np.cumsum(new_p)
    rank = rank - rank[np.flatnonzero(new_t)][np.cumsum(new_t) - 1] if len(t) else rank
    out = np.zeros(len(t), bool)
    out[order] = rank >= PER_TRIGGER
    return order[new_p & (rank < PER_TRIGGER)], out


def _phrases(buckets: int, match: int):
    """A block's dictionary, bucket by bucket."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        b = _Block(table, match)
        at = np.sort(_sent(b)[0])  # in document order, which packs well
        high = b.phrase[at] >> np.uint64(16)
        return _send(key[0].as_py(), (b.trigger[at] % np.uint64(buckets)).astype(np.int64), [
            b.doc[at], b.short[at], (high >> np.uint64(16)).astype(np.uint32), (high & np.uint64(0xFFFF)).astype(np.uint16), b.left[at], b.right[at]])

    return run


def _flags(kind: int, block: np.ndarray, keys: np.ndarray, docs: np.ndarray) -> pa.Table:
    order = np.argsort(block, kind="stable")
    names, cut = np.unique(block[order], return_index=True)
    edges = np.append(cut, len(order))
    return pa.table({
        "block": pa.array(names, pa.int64()), "kind": pa.array(np.full(len(names), kind), pa.int32()),
        "keys": pa.array([_raw(keys[order[a:b]]) for a, b in zip(edges[:-1], edges[1:])], pa.binary()),
        "docs": pa.array([_raw(docs[order[a:b]]) for a, b in zip(edges[:-1], edges[1:])], pa.binary())})


def _shared(short: np.ndarray, side: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    """True where several distinct phrases have the trigger and this side."""
    key = (short.astype(np.uint64) << np.uint64(16)) | side.astype(np.uint64)
    _, back = np.unique(key, return_inverse=True)
    return np.bincount(back, weights=distinct)[back] > 1 if len(key) else np.zeros(0, bool)


def _dictionary(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Sort one bucket's phrases; tell each block which of its phrases began earlier (0) and which share a trigger and the left (1) or right (2) side with others."""
    counts = _counts(table.column("keys"), 4)
    short, doc = _join(table.column("keys"), np.uint32), _unpack_docs(table.column("docs"), counts)
    high = (_join(table.column("high"), np.uint32).astype(np.uint64) << np.uint64(16)) | _join(table.column("low"), np.uint16).astype(np.uint64)
    left, right = _join(table.column("left"), np.uint16), _join(table.column("right"), np.uint16)
    block = np.repeat(table.column("block").to_numpy(), counts)
    order = np.lexsort((doc, high, short))
    short, high, doc, block, left, right = (x[order] for x in (short, high, doc, block, left, right))
    new = np.ones(len(short), bool)
    new[1:] = (short[1:] != short[:-1]) | (high[1:] != high[:-1])
    first = doc[np.flatnonzero(new)][np.cumsum(new) - 1] if len(doc) else doc
    later = first < doc
    code = _code(high, short)
    # a block that sent all it may could have more: nothing of that trigger is ruled out
    _, back, sent = np.unique((short.astype(np.uint64) << np.uint64(32)) | (block & 0xFFFFFFFF).astype(np.uint64), return_inverse=True, return_counts=True)
    full = np.isin(short, np.unique(short[(sent >= PER_TRIGGER)[back]])) if len(short) else np.zeros(0, bool)
    flags = [_flags(0, block[later], code[later], first[later])]
    for kind, side in ((1, left), (2, right)):
        rim = (full | _shared(short, side, new)) & ~later
        flags.append(_flags(kind, block[rim], code[rim], doc[rim]))
    return pa.concat_tables(flags)


class _Told:
    """What the buckets told one block."""

    def __init__(self, table: pa.Table):
        kind = table.column("kind").to_numpy()
        pick = lambda k, col, t: _join(table.filter(pa.array(kind == k)).column(col), t)
        self.phrases = _firsts(pick(0, "keys", np.uint64), pick(0, "docs", np.int64))
        self.left, self.right = pick(1, "keys", np.uint64), pick(2, "keys", np.uint64)
        self.suffixes = _firsts(pick(3, "keys", np.uint64), pick(3, "docs", np.int64))


def _look(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """True where the table holds the key with a smaller document."""
    names, first = table
    if not len(names):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(names, keys), len(names) - 1)
    return (names[at] == keys) & (first[at] < docs)


def _resolve(b: _Block, told: _Told):
    """Per part: entries whose whole phrase is a repeat, and the suffixes left to compare (start, (hash, document))."""
    whole = _look(_firsts(b.phrase, b.doc), b.phrase, b.doc) | _look(told.phrases, b.phrase, b.doc)
    unsent = _sent(b)[1]
    on_left, on_right = (unsent | np.isin(b.phrase, told.left)) & ~whole, (unsent | np.isin(b.phrase, told.right)) & ~whole
    found, at = [], 0
    for i, _, data, off, part in b.parts:
        if part is None:
            found.append((None, None, None))
            continue
        n = len(part["doc"])
        w, l, r = whole[at: at + n], on_left[at: at + n], on_right[at: at + n]
        at += n
        # with the left side a suffix starts at or before ``half``, with the right side at or after it
        lo = np.where(l, part["first"], np.maximum(part["first"], part["half"]))
        hi = np.where(r, part["last"], np.minimum(part["last"], part["half"]))
        e = np.flatnonzero((l | r) & (lo <= hi))
        size = hi[e] - lo[e] + 1
        start = np.repeat(lo[e] - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(size.sum()) if len(e) else np.zeros(0, np.int64)
        found.append((w, start, (part["hash"](start, start + b.match), b.ids[i + np.repeat(part["doc"][e], size)])))
    return found


def _suffixes(buckets: int, match: int):
    """A block's suffixes that may repeat elsewhere, cut to the match length, each with its smallest document."""

    def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        b = _Block(left, match)
        found = [f[2] for f in _resolve(b, _Told(right)) if f[2] is not None]
        keys = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.uint64)
        docs = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.int64)
        keys, docs = _firsts(keys, docs)
        order = np.argsort(docs, kind="stable")
        keys, docs = keys[order], docs[order]
        block = key[0].as_py()
        return _send(block, (mix(keys) % np.uint64(buckets)).astype(np.int64), [docs, keys])

    return run


def _order(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Sort one bucket's suffixes; tell each block which of its suffixes began in an earlier document (3)."""
    counts = _counts(table.column("keys"), 8)
    suffix, doc = _join(table.column("keys"), np.uint64), _unpack_docs(table.column("docs"), counts)
    block = np.repeat(table.column("block").to_numpy(), counts)
    order = np.lexsort((doc, suffix))
    suffix, doc, block = suffix[order], doc[order], block[order]
    new = np.ones(len(suffix), bool)
    new[1:] = suffix[1:] != suffix[:-1]
    first = doc[np.flatnonzero(new)][np.cumsum(new) - 1] if len(doc) else doc
    later = first < doc
    return _flags(3, block[later], suffix[later], first[later])


def _cut(match: int):
    """Removed byte ranges and the remaining bytes of each document of a block."""

    def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        b, told = _Block(left, match), _Told(right)
        found = _resolve(b, told)
        have = [f[2] for f in found if f[2] is not None]
        local = _firsts(np.concatenate([h[0] for h in have]), np.concatenate([h[1] for h in have])) if have else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        sizes, spans, kept = [], [], []
        for (i, j, data, off, part), (whole, start, hashed) in zip(b.parts, found):
            gone = np.zeros(len(data) + 1, np.int32)
            if part is not None:
                again = _look(local, *hashed) | _look(told.suffixes, *hashed)
                np.add.at(gone, part["lo"][whole], 1)
                np.add.at(gone, part["hi"][whole], -1)
                np.add.at(gone, start[again], 1)
                np.add.at(gone, start[again] + match, -1)
            dead = np.cumsum(gone[:-1]) > 0
            for a, z in zip(off[:-1], off[1:]):
                d = dead[a:z]
                sizes.append(int(z - a))
                if not d.any():
                    spans.append([])
                    kept.append(data[a:z].tobytes())
                    continue
                turn = np.flatnonzero(np.diff(np.concatenate(([0], d.astype(np.int8), [0]))))
                spans.append(turn.tolist())
                kept.append(data[a:z][~d].tobytes())
        return pa.table({"doc_id": pa.array(b.ids, pa.int64()), "n_bytes": pa.array(sizes, pa.int64()),
                         "spans": pa.array(spans, pa.list_(pa.int64())), "kept": pa.array(kept, pa.binary())})

    return run


def suffix_dedup(docs: DataFrame, match: int = 50, block_docs: int = DOCS_PER_BLOCK) -> DataFrame:
    """Remove every byte covered by a ``match``-byte string that also starts in a document with a smaller doc_id.

    ``docs`` needs ``doc_id`` (long) and ``text``; other columns are ignored.
    Returns one row per input row: doc_id, n_bytes, spans (start, end, start,
    end, ... of the maximal removed byte ranges) and kept (the other bytes).

    Null and empty texts: 0 bytes, no spans. Texts shorter than ``match`` lose
    nothing. Rows that share a doc_id are one document and remove nothing from
    each other. A null doc_id has no order, so its rows lose and remove nothing.
    Empty table: no rows. ``match`` must be 17 to 79.
    """
    if not TRIGGER < match < TRIGGER + 64:
        raise ValueError(f"match must be {TRIGGER + 1} to {TRIGGER + 63}")
    spark = docs.sparkSession
    blocks = max(1, -(-docs.count() // block_docs))
    buckets = max(8, shuffle_partitions(spark))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    source = texts.filter("doc_id is not null").select(F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).alias("block"), "doc_id", "text")
    by_block = source.groupBy("block")
    entries = by_block.applyInArrow(_phrases(buckets, match), _ENTRY)
    told = entries.groupBy("bucket").applyInArrow(_dictionary, _FLAG)
    suffixes = by_block.cogroup(told.groupBy("block")).applyInArrow(_suffixes(buckets, match), _ENTRY)
    ordered = suffixes.groupBy("bucket").applyInArrow(_order, _FLAG)
    cut = by_block.cogroup(told.unionAll(ordered).groupBy("block")).applyInArrow(_cut(match), _OUT)
    whole = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    unordered = texts.filter("doc_id is null").select(
        "doc_id", F.length(whole).cast("long").alias("n_bytes"), F.array().cast("array<long>").alias("spans"), whole.alias("kept"))
    return cut.unionAll(unordered)


def op1_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.expr("cast(size(spans) div 2 as long)").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))
