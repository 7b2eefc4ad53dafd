"""Operator 12, substring dedup by super-k-mer partitioning.

A window is ``window`` consecutive words of one document. Its minimiser is the
least hash among its runs of ``gram`` words, so equal windows have equal
minimisers. Consecutive windows that share one travel together as one packed
string of their words to the minimiser's bucket, where the windows are sorted
and equal ones counted from their first place on.

* A first pass counts the minimisers. Those with more than half a bucket's share
  come last in the order of the second pass, so a line that a third of the
  documents hold is seldom a minimiser and its neighbourhood spreads. A block
  leaves out minimisers that it holds once or twice; which ones are listed
  decides where windows meet, never the result.
* Each block of texts first drops windows that repeat inside the block (they
  are known to be repeats), so a copied passage sends one string a block.
* Windows made of frequent runs alone still meet in one bucket, one string a
  block; these meet in groups of about the square root of the blocks first.
* Windows are sorted by a 64-bit hash, and equal hashes are compared word by
  word on the bytes; windows that differ under one hash are then told apart by
  their bytes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import SPACE, RangeHash, chunks, documents, mix, shuffle_partitions, small_batches, text_buffer, word_runs
from arrears.session import materialize

WINDOW = 20
GRAM = 5
BLOCK_BYTES = 3 << 20
BUCKET_BYTES = 2 << 20
#: bytes for which a pass holds 8-byte places or hashes at a time
PASS_BYTES = 256 << 10
#: no minimiser is listed as frequent below this share of all super-k-mers; it bounds the list that every task holds
LEAST_SHARE = 2.0**-18
#: super-k-mers of one minimiser in a block from which the block reports it
REPORTED = 3
_STEP = 0xD6E8FEB86659FD93
_GRAM_STEP = 0xA0761D6478BD642F
_LAST = np.uint64(1 << 63)
_RANGE = ("doc_id", "tag", "first", "last")
_SENT = "bucket long, salt int, packed binary, doc_id long, tag long, first long, last long"


def _rolled(words: np.ndarray, length: int, step: int) -> np.ndarray:
    """Polynomial hash of every ``length`` consecutive word hashes, by doubling."""
    out, have = None, 0
    power, size, step_power = words, 1, step
    while True:
        if length & size:
            if out is None:
                out, have = power, size
            else:
                n = max(len(words) - have - size + 1, 0)
                out = out[:n] * np.uint64(step_power) + power[have: have + n]
                have += size
        if size * 2 > length:
            return out
        n = max(len(words) - 2 * size + 1, 0)
        power = power[:n] * np.uint64(step_power) + power[size: size + n]
        size, step_power = size * 2, step_power * step_power % 2**64


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    size, out = 1, values
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:]) if len(out) > size else out[:0]
        size *= 2
    rest = width - size
    return (np.minimum(out[:-rest], out[rest:]) if len(out) > rest else out[:0]) if rest else out


def _copied(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The byte ranges one after another; the places of a few are held at a time."""
    upto = np.append(0, np.cumsum(size))
    out = np.empty(int(upto[-1]), np.uint8)
    for lo, hi in _cuts(upto[1:], PASS_BYTES):
        out[upto[lo]: upto[hi]] = data[np.arange(upto[lo], upto[hi]) + np.repeat(start[lo:hi] - upto[lo:hi], size[lo:hi])]
    return out


def _word_hashes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.empty(len(at) - 1, np.uint64)
    for lo, hi in _cuts(at[1:], PASS_BYTES):
        places = at[lo: hi + 1] - at[lo]
        out[lo:hi] = RangeHash(data[at[lo]: at[hi]])(places[:-1], places[1:] - 1)
    return out


class Words:
    """The words of some texts: each followed by one blank in ``data``, with ``at`` the places and ``upto`` the words before each text."""

    def __init__(self, data: np.ndarray, off: np.ndarray, joined: bool = False):
        if not joined:  # a blank behind every text, then one behind every word
            data, off = np.insert(data, off[1:], 32), off + np.arange(len(off))
            solid = ~SPACE[data]
            self.upto = np.searchsorted(np.flatnonzero(solid[:-1] & ~solid[1:]), off)
            solid[1:] |= solid[:-1].copy()
            data = data[solid]
            data[SPACE[data]] = 32
        self.data, self.at = data, np.append(0, np.flatnonzero(data == 32) + 1)
        if joined:
            self.upto = np.searchsorted(self.at, off)
        self.hash = _word_hashes(data, self.at)
        self.text = np.repeat(np.arange(len(off) - 1), np.diff(self.upto))

    def windows(self, length: int) -> np.ndarray:
        """First words of the windows of ``length`` words."""
        n = len(self.text) - length + 1
        return np.flatnonzero(self.text[:n] == self.text[length - 1:]) if n > 0 else np.zeros(0, np.int64)


def minimisers(words: Words, at: np.ndarray, window: int, gram: int, frequent: np.ndarray) -> np.ndarray:
    """Minimiser of each window; the ``frequent`` ones (sorted) come after all others."""
    grams = mix(_rolled(words.hash, gram, _GRAM_STEP)) >> np.uint64(1)
    if len(frequent) and len(grams):
        found = frequent[np.minimum(np.searchsorted(frequent, grams), len(frequent) - 1)] == grams
        grams = np.where(found, grams | _LAST, grams)
    return _least(grams, window - gram + 1)[at]


def _same(words: Words, a: np.ndarray, b: np.ndarray, window: int) -> np.ndarray:
    """Whether windows a and b have the same bytes; runs of neighbouring pairs are compared once."""
    if not len(a):
        return np.zeros(0, bool)
    order = np.lexsort((a, b - a))
    x, y = a[order], b[order]
    new = np.ones(len(x), bool)
    new[1:] = (np.diff(x) != 1) | (np.diff(y) != 1)
    run = np.cumsum(new) - 1
    first, last = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(x)) - 1
    n_words = x[last] - x[first] + window
    equal = np.zeros(len(first), bool)
    for lo, hi in _cuts(np.cumsum(n_words), PASS_BYTES // 4):
        # the words of a run: word k of one window against word k of the other
        n = n_words[lo:hi]
        base = np.repeat(np.cumsum(n) - n, n)
        k = np.arange(int(n.sum())) - base
        p, q = np.repeat(x[first[lo:hi]], n) + k, np.repeat(y[first[lo:hi]], n) + k
        size = words.at[p + 1] - words.at[p]
        good = size == words.at[q + 1] - words.at[q]
        size = np.where(good, size, 0)
        owner = np.repeat(np.arange(len(p)), size)
        bytes_same = _copied(words.data, words.at[p], size) == _copied(words.data, words.at[q], size)
        good[owner[~bytes_same]] = False
        equal[lo:hi] = np.bincount(np.repeat(np.arange(hi - lo), n), weights=~good, minlength=hi - lo) == 0
    out = np.zeros(len(a), bool)
    out[order] = equal[run]
    return out


def _cuts(upto: np.ndarray, budget: int):
    lo = 0
    while lo < len(upto):
        done = upto[lo - 1] if lo else 0
        hi = max(int(np.searchsorted(upto, done + budget, side="right")), lo + 1)
        yield lo, hi
        lo = hi


def equal_windows(words: Words, at: np.ndarray, window: int) -> np.ndarray:
    """For each window the index (into ``at``) of the first window with the same words."""
    h = mix(_rolled(words.hash, window, _STEP)[at])
    order = np.argsort(h, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = h[order][1:] != h[order][:-1]
    first = np.empty(len(order), np.int64)
    first[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1] if len(order) else 0
    pairs = np.flatnonzero(first != np.arange(len(first)))
    wrong = pairs[~_same(words, at[pairs], at[first[pairs]], window)]
    if len(wrong):  # one hash for different words somewhere in these runs: tell them apart by their bytes
        for value in np.unique(h[wrong]):
            seen: dict[bytes, int] = {}
            for i in np.flatnonzero(h == value):
                first[i] = seen.setdefault(words.data[words.at[at[i]]: words.at[at[i] + window]].tobytes(), i)
    return first


class Pieces:
    """Texts with their document, tag and the number of their first word, in the order of document and place."""

    def __init__(self, data, off, doc, tag, first, joined=False):
        order = np.lexsort((tag, first, doc))
        if (np.diff(order) < 0).any():
            size = np.diff(off)[order]
            data, off = _copied(data, off[:-1][order], size), np.append(0, np.cumsum(size))
            doc, tag, first = doc[order], tag[order], first[order]
        self.words = Words(data, off, joined)
        self.doc, self.tag, self.first = doc, tag, first

    def judged(self, window: int):
        """(first word, text, number of that word in the document, repeat, travels) of every window.

        A repeat has an equal window at a smaller (document, place). What
        travels on is the earliest of each set of equal windows, once for
        every tag where rows of one doc_id hold it at one place.
        """
        at = self.words.windows(window)
        text = self.words.text[at]
        place = self.first[text] + at - self.words.upto[text]
        doc, tag = self.doc[text], self.tag[text]
        first = equal_windows(self.words, at, window)
        if ((doc[1:] > doc[:-1]) | ((doc[1:] == doc[:-1]) & (place[1:] > place[:-1]))).all():
            repeat = first != np.arange(len(first))
            return at, text, place, repeat, ~repeat
        order = np.lexsort((tag, place, doc, first))  # rows that share a doc_id
        lead = np.ones(len(order), bool)
        lead[1:] = first[order][1:] != first[order][:-1]
        head = order[np.flatnonzero(lead)][np.cumsum(lead) - 1]
        later = (doc[order] != doc[head]) | (place[order] != place[head])
        twin = np.zeros(len(order), bool)
        twin[1:] = ~lead[1:] & ~later[1:] & ~later[:-1] & (tag[order][1:] == tag[order][:-1])
        repeat, travels = np.zeros(len(order), bool), np.zeros(len(order), bool)
        repeat[order], travels[order] = later, ~later & ~twin
        return at, text, place, repeat, travels


def _runs(*neighbours) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of the runs in which each (values, step) goes on by its step."""
    n = len(neighbours[0][0])
    new = np.ones(n, bool)
    for values, step in neighbours:
        new[1:] &= values[1:] == values[:-1] + values.dtype.type(step)
    new[1:] = ~new[1:]
    a = np.flatnonzero(new)
    return a, np.append(a[1:], n)[: len(a)] - 1


def _ranges(pieces: Pieces, text, place, repeat, window: int) -> np.ndarray:
    """Runs of repeated windows: doc_id, tag and their words from first to before last; equal rows once."""
    i = np.flatnonzero(repeat)
    t, p = text[i], place[i]
    a, b = _runs((t, 0), (p, 1))
    return np.unique(np.stack([pieces.doc[t[a]], pieces.tag[t[a]], p[a], p[b] + window]).astype(np.int64), axis=1)


def _super_kmers(pieces: Pieces, at, text, place, travels, keys, window: int):
    """(minimiser, text, first word, words, place) of runs of travelling neighbour windows that share a minimiser."""
    i = np.flatnonzero(travels)
    t, w, k = text[i], at[i], keys[i]
    a, b = _runs((t, 0), (w, 1), (k, 0))
    return k[a], t[a], w[a], w[b] - w[a] + window, place[i][a]


def _packed(pieces: Pieces, found, buckets: int, salts: int, block: int):
    """(bucket, salt, packed) of each bucket: its super-k-mers as one string of places and words, compressed."""
    key, text, word, n, place = found
    salt = np.where(key >= _LAST, 1 + block % salts, 0)
    bucket = (mix(key & ~_LAST) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((salt, bucket))
    bucket, salt, text, word, n, place = (x[order] for x in (bucket, salt, text, word, n, place))
    start = pieces.words.at[word]
    size = pieces.words.at[word + n] - start
    data, upto = _copied(pieces.words.data, start, size), np.append(0, np.cumsum(size))
    head = np.stack([pieces.doc[text], pieces.tag[text], place, size]).astype("<i8")
    codec = pa.Codec("zstd", 3)
    a, b = _runs((bucket, 0), (salt, 0))
    for x, y in zip(a, b + 1):
        raw = np.int64(y - x).tobytes() + head[:, x:y].tobytes() + data[upto[x]: upto[y]].tobytes()
        yield int(bucket[x]), int(salt[x]), len(raw).to_bytes(8, "little") + codec.compress(raw, asbytes=True)


def _unpacked(column) -> Pieces:
    heads, texts = [], []
    for x in column.to_pylist():
        raw = pa.decompress(x[8:], decompressed_size=int.from_bytes(x[:8], "little"), codec="zstd", asbytes=True)
        n = int.from_bytes(raw[:8], "little")
        heads.append(np.frombuffer(raw, "<i8", 4 * n, 8).reshape(4, n))
        texts.append(np.frombuffer(raw, np.uint8, offset=8 + 32 * n))
    head = np.concatenate(heads, axis=1)
    return Pieces(np.concatenate(texts), np.append(0, np.cumsum(head[3])), *head[:3], joined=True)


def _sent(parts, ranges: np.ndarray) -> pa.Table:
    """Rows of packed buckets and, with a bucket below 0, of ranges."""
    parts, m = list(parts), ranges.shape[1]
    n = len(parts)
    none = pa.nulls(n, pa.int64())
    bucket = np.append(np.array([p[0] for p in parts], np.int64), -1 - (mix(ranges[0].view(np.uint64)) >> np.uint64(48)).astype(np.int64))
    columns = [pa.array(bucket), pa.array([p[1] for p in parts] + [0] * m, pa.int32()), pa.array([p[2] for p in parts] + [None] * m, pa.binary())]
    columns += [pa.concat_arrays([none, pa.array(x, pa.int64())]) for x in ranges]
    return pa.Table.from_arrays(columns, names=["bucket", "salt", "packed", *_RANGE])


def slices(data: np.ndarray, limit: int, overlap: int):
    """(bytes, number of its first word) of slices of about ``limit`` bytes of one text, which share ``overlap`` words."""
    at, first = 0, 0
    while True:
        end = at + limit
        if end < len(data):  # not inside a word
            gap = np.flatnonzero(SPACE[data[end: end + limit]])
            while not len(gap) and end < len(data):
                end += limit
                gap = np.flatnonzero(SPACE[data[end: end + limit]])
            end += int(gap[0]) if len(gap) else 0
        part = data[at:end]
        yield part, first
        if end >= len(data):
            return
        start = word_runs(part, np.array([0, len(part)]))[0]
        step = max(len(start) - overlap, 0)
        first += step
        if step == 0 and len(start):
            limit *= 2  # words so long that the slice is all overlap
        at = at + int(start[step]) if step < len(start) else end


def _blocks(batches, limit: int, overlap: int):
    """(bytes, offsets, doc_id, tag, first word) of consecutive texts of about ``limit`` bytes together; longer texts come in slices."""
    held, size = [], 0

    def block():
        data, sizes, doc, tag, first = (np.concatenate(x) for x in zip(*held))
        held.clear()
        return data, np.append(0, np.cumsum(sizes)), doc, tag, first

    for b in batches:
        data, off = text_buffer(b.column("text"))
        doc, tag = (b.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "tag"))
        for i, j in chunks(off, limit):
            if size and size + off[j] - off[i] > limit:
                yield block()
                size = 0
            if off[j] - off[i] > limit:
                for part, first in slices(data[off[i]: off[j]], limit, overlap):
                    held.append((part, np.array([len(part)]), doc[i:j], tag[i:j], np.array([first])))
                    yield block()
            else:
                held.append((data[off[i]: off[j]], np.diff(off[i: j + 1]), doc[i:j], tag[i:j], np.zeros(j - i, np.int64)))
                size += int(off[j] - off[i])
    if held:
        yield block()


def repeated_words(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, bucket_bytes: int = BUCKET_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Ranges of words covered by windows that also start earlier: doc_id, tag, first, last (exclusive).

    ``docs`` needs doc_id, tag and text, none of them null. Ranges may overlap.
    """
    def count(batches):
        n_runs = n_bytes = n_blocks = 0
        for data, off, doc, tag, first in _blocks(batches, block_bytes, window - 1):
            words = Words(data, off)
            at = words.windows(window)
            keys = minimisers(words, at, window, gram, np.zeros(0, np.uint64))
            a, _ = _runs((words.text[at], 0), (at, 1), (keys, 0))
            found, n = np.unique(keys[a], return_counts=True)
            often = n >= REPORTED
            n_runs, n_bytes, n_blocks = n_runs + len(a), n_bytes + len(data), n_blocks + 1
            yield pa.record_batch([pa.array(found[often].astype(np.int64)), pa.array(n[often]), *[pa.array(np.zeros(often.sum(), np.int64))] * 2],
                                  names=["gram", "n", "bytes", "blocks"])
        yield pa.record_batch([pa.array([x], pa.int64()) for x in (None, n_runs, n_bytes, n_blocks)], names=["gram", "n", "bytes", "blocks"])

    counted = docs.mapInArrow(count, "gram long, n long, bytes long, blocks long")
    counted = materialize(counted.groupBy("gram").agg(*[F.sum(c).alias(c) for c in ("n", "bytes", "blocks")]), "minimisers")
    whole = counted.filter("gram is null").first() or {"n": 0, "bytes": 0, "blocks": 0}
    # super-k-mers overlap: about three times the text; a few buckets for each task of the exchange
    buckets = max(4 * shuffle_partitions(docs.sparkSession), math.ceil(3 * whole["bytes"] / bucket_bytes))
    salts = max(1, math.isqrt(whole["blocks"]))
    least = max(int(whole["n"] * LEAST_SHARE), whole["n"] // (2 * buckets), 32)
    # at most 1 / LEAST_SHARE numbers
    often = counted.filter(F.col("gram").isNotNull() & (F.col("n") >= least)).select("gram").toPandas()["gram"].to_numpy(np.int64)
    frequent = np.sort(often.view(np.uint64))

    def sent(pieces: Pieces, salts: int, block: int):
        at, text, place, repeat, travels = pieces.judged(window)
        keys = minimisers(pieces.words, at, window, gram, frequent)
        found = _super_kmers(pieces, at, text, place, travels, keys, window)
        return _sent(_packed(pieces, found, buckets, salts, block), _ranges(pieces, text, place, repeat, window))

    def scatter(batches):
        for block in _blocks(batches, block_bytes, window - 1):
            pieces = Pieces(*block)
            yield from sent(pieces, salts, int(mix(pieces.doc[:1].view(np.uint64))[0] >> np.uint64(32))).to_batches()

    def gather(pieces: Pieces) -> np.ndarray:
        _, text, place, repeat, _ = pieces.judged(window)
        return _ranges(pieces, text, place, repeat, window)

    def meet(key, table):
        bucket, salt = (k.as_py() for k in key)
        if bucket < 0:
            return table
        pieces = _unpacked(table.column("packed"))
        return sent(pieces, 1, 0) if salt else _sent([], gather(pieces))

    def last(table):
        return _sent([], gather(_unpacked(table.column("packed")))).select(_RANGE)

    # frequent windows travel with a salt above 0 and meet in two steps; all others are done after the first
    met = materialize(docs.mapInArrow(scatter, _SENT).groupBy("bucket", "salt").applyInArrow(meet, _SENT), "repeats")
    rest = met.filter("bucket >= 0").groupBy("bucket").applyInArrow(last, "doc_id long, tag long, first long, last long")
    return met.filter("bucket < 0").select(*_RANGE).unionByName(rest)


def substring_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, bucket_bytes: int = BUCKET_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every text without the words covered by a window that also starts earlier (smaller doc_id, or there at a smaller word).

    ``docs`` needs doc_id and text; other columns are ignored. Returns one row
    per input row: doc_id, n_words, n_removed, removed (array of first and last,
    exclusive, disjoint and ascending) and kept (the other words, joined by one
    space).

    Words are compared byte for byte. Null, empty and blank texts and texts of
    fewer words than a window have nothing to remove. Rows without a doc_id stay
    whole and remove nothing. Windows at one place of rows that share a doc_id
    are no repeats of each other, so repeated rows are judged alike. Very long
    texts are cut into slices that overlap by a window less one word. Empty
    table: no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = texts.withColumn("tag", F.xxhash64("text"))
    found = repeated_words(texts.filter("doc_id is not null"), window, gram, bucket_bytes, block_bytes)
    ranges = found.distinct().groupBy("doc_id", "tag").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("ranges"))

    def remove(batches):
        for b in small_batches(batches):
            data, off = text_buffer(b.column("text"))
            ranges = b.column("ranges").fill_null([])
            cut, flat = ranges.offsets.to_numpy().astype(np.int64), ranges.values
            first, last = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("first", "last"))
            for i, j in chunks(off, block_bytes):
                mine = slice(cut[i], cut[j])
                owner = np.repeat(np.arange(j - i), np.diff(cut[i: j + 1]))
                rows = _without(data[off[i]: off[j]], off[i: j + 1] - off[i], owner, first[mine], last[mine], block_bytes)
                yield pa.record_batch([b.column("doc_id").slice(i, j - i), *rows], names=["doc_id", "n_words", "n_removed", "removed", "kept"])

    joined = texts.join(ranges, ["doc_id", "tag"], "left").select("doc_id", "text", "ranges")
    return joined.mapInArrow(remove, "doc_id long, n_words long, n_removed long, removed array<struct<first:long,last:long>>, kept string")


def _without(data: np.ndarray, off: np.ndarray, owner, first, last, limit: int):
    """n_words, n_removed, removed and kept of texts without the given ranges of words; one long text is worked on in slices."""
    parts = [(data, 0)] if len(off) > 2 else slices(data, limit, 0)
    gone, text, kept, n_kept = [], [], [], np.zeros(len(off) - 1, np.int64)
    for part, number in parts:
        words = Words(part, off if len(off) > 2 else np.array([0, len(part)]))
        n = np.diff(words.upto)[owner]
        lo, hi = (words.upto[owner] + np.clip(x - number, 0, n) for x in (first, last))
        m = len(words.text)
        dead = np.cumsum(np.bincount(lo, minlength=m + 1) - np.bincount(hi, minlength=m + 1))[:m] > 0
        size = np.diff(words.at)
        kept.append(words.data[np.repeat(~dead, size)])
        n_kept += np.bincount(words.text, weights=size * ~dead, minlength=len(n_kept)).astype(np.int64)
        gone.append(dead)
        text.append(words.text)
    gone, text, kept = np.concatenate(gone), np.concatenate(text), np.concatenate(kept)
    kept = np.delete(kept, np.cumsum(n_kept)[n_kept > 0] - 1)  # no blank after the last word
    n_kept = np.maximum(n_kept - 1, 0)
    total, removed = np.bincount(text, minlength=len(n_kept)), np.bincount(text[gone], minlength=len(n_kept))
    i = np.flatnonzero(gone)
    a, b = _runs((text[i], 0), (i, 1))
    start = (np.cumsum(total) - total)[text[i[a]]]
    spans = pa.StructArray.from_arrays([pa.array(i[a] - start, pa.int64()), pa.array(i[b] + 1 - start, pa.int64())], ["first", "last"])
    upto = np.append(0, np.cumsum(np.bincount(text[i[a]], minlength=len(n_kept)))).astype(np.int32)
    strings = pa.StringArray.from_buffers(len(n_kept), pa.py_buffer(np.append(0, np.cumsum(n_kept)).astype(np.int32)), pa.py_buffer(kept))
    return pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.ListArray.from_arrays(pa.array(upto), spans), strings


def op12_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP12_SQL = f"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, i, array_to_string(words[i: i + {WINDOW - 1}], ' ') AS win FROM (
  SELECT doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM t)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS nth FROM w) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS i FROM again),
kept AS (SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.i) AS text, count(*) AS n
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM t) p
  ANTI JOIN gone g ON g.doc_id = p.doc_id AND g.i = p.i GROUP BY p.doc_id)
SELECT t.doc_id, len(words) AS n_words, len(words) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM t LEFT JOIN kept ON kept.doc_id = t.doc_id
"""
