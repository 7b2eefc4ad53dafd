"""Operator 2, near-duplicate classes by a chosen-path set similarity join.

1. Every text becomes its set of word shingles, as 48-bit hashes, and 64
   minwise tokens of that set. Equal sets are one *representative* from then on
   (a map-side combined aggregate, so thousands of copies cost nothing more).
2. Independent trees branch the representatives: a node picks each of the 64
   token places with probability 1 / (threshold * 64), and representatives
   with the same token there share a child. The choice depends on the node
   alone, so a step is one shuffle of (node, representative) pairs; nodes of
   one member, nearly all, vanish at the count.
3. Nodes of at most ``node_limit`` members are compared exhaustively by their
   tokens. A larger node compares all members with one pivot; those unlike the
   pivot are compared with all members, if they are few, else the node branches
   on, three levels at once. These are *loose* links
   (a likeness five standard errors under the threshold) and only a spanning
   forest of each node is kept, so links grow with members, not pairs. What is
   still large after ``steps`` rounds is linked to its pivot whole: nothing is lost.
4. Documents linked closely enough lie in one loose component; each text is
   shipped once, to its component, and all pairs there that are not yet
   connected are compared on full sets. Components of more than ``block_limit``
   members are compared block against block, so no task holds a whole one.
5. Connected components of the exact links (hooking to the smallest neighbour,
   pointer jumping, contraction) give the class of each document.

Recall: a pair at the threshold meets in a tree with the chance that a critical
branching process survives; with 16 trees and nearly all nodes small at the
first level the miss rate is about 1e-9 there, and falls above the threshold.
"""

from __future__ import annotations

import gc

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import LOWER, RangeHash, documents, mix, shuffle_partitions, small_batches, text_chunks, word_runs
from arrears.session import materialize

PLACES = 64
#: what tells sets apart
KEY = ("n_shingles", "lo", "hi")
_RNG = np.random.default_rng(7)
_MUL = _RNG.integers(1, 2**62, PLACES, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 2**62, PLACES, dtype=np.int64).astype(np.uint64)
_FOLD = [np.uint64(int(x) * 2 + 1) for x in _RNG.integers(1, 2**62, 64, dtype=np.int64)]


def shingle_sets(column, words: int):
    """(i, j, hashes, starts) per range of texts: the distinct shingles of text i + t are hashes[starts[t]:starts[t + 1]], sorted."""
    for i, j, data, off in text_chunks(column):
        data = LOWER[data]
        start, end, upto = word_runs(data, off)
        w = RangeHash(data)(start, end)
        n = np.diff(upto)
        whole = np.zeros(len(w), np.uint64)
        for k in range(min(words, len(w))):
            whole[: len(w) - k] += w[k:] * _FOLD[k % 64]
        doc = np.repeat(np.arange(len(n)), n)
        full = np.arange(len(w)) + words <= np.repeat(upto[1:], n)
        if (few := (n > 0) & (n < words)).any():  # the whole sequence as one shingle
            for t in np.flatnonzero(few):
                s = w[upto[t]: upto[t + 1]]
                whole[upto[t]] = np.add.reduce(s * np.array(_FOLD[: len(s)])) + np.uint64(len(s))
                full[upto[t]] = True
        key = np.sort((doc[full].astype(np.uint64) << np.uint64(48)) | (mix(whole[full]) >> np.uint64(16)))
        keep = np.ones(len(key), bool)
        keep[1:] = key[1:] != key[:-1]
        key = key[keep]
        yield i, j, key & np.uint64((1 << 48) - 1), np.searchsorted(key >> np.uint64(48), np.arange(len(n) + 1))


def _set_hash(x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of the sets that start at ``at`` in the mixed shingles ``x``."""
    return np.add.reduceat(x, at), np.add.reduceat(mix(x + np.uint64(99)), at)


def _signatures(words: int):
    def run(batches):
        for batch in small_batches(batches):
            ids = batch.column("doc_id")
            for i, j, hashes, start in shingle_sets(batch.column("text"), words):
                n = np.diff(start)
                some = np.flatnonzero(n)
                tokens = np.zeros((j - i, PLACES), np.uint32)
                lo, hi = np.zeros(j - i, np.uint64), np.zeros(j - i, np.uint64)
                if len(some):
                    x, at = mix(hashes), start[:-1][some]
                    for p in range(PLACES):
                        tokens[some, p] = np.minimum.reduceat(x * _MUL[p] + _ADD[p], at) >> np.uint64(32)
                    lo[some], hi[some] = _set_hash(x, at)
                yield pa.record_batch({
                    "doc_id": ids[i:j], "n_shingles": pa.array(n, pa.int64()),
                    "lo": pa.array(lo.view(np.int64)), "hi": pa.array(hi.view(np.int64)),
                    "tokens": pa.array([t.tobytes() for t in tokens], pa.binary())})

    return run


def set_keys(words: int, keep=("doc_id", "text")):
    """Rows with the ``keep`` columns and the key (n_shingles, lo, hi) of the set of ``text``."""

    def run(batches):
        for batch in small_batches(batches):
            for i, j, hashes, start in shingle_sets(batch.column("text"), words):
                n = np.diff(start)
                some, x = np.flatnonzero(n), mix(hashes)
                lo, hi = np.zeros(j - i, np.uint64), np.zeros(j - i, np.uint64)
                if len(some):
                    lo[some], hi[some] = _set_hash(x, start[:-1][some])
                yield pa.record_batch([*(batch.column(c)[i:j] for c in keep), pa.array(n, pa.int64()), pa.array(lo.view(np.int64)), pa.array(hi.view(np.int64))],
                                      names=[*keep, *KEY])

    return run


def _tokens(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, PLACES)


def _branch(threshold: float, trees: int, levels: int = 1):
    """Descendants, ``levels`` below, of (node, rep, tokens) rows; a null node stands for the roots of all trees."""
    need = np.uint64(int(2**64 / (threshold * PLACES)))
    place = np.arange(PLACES, dtype=np.uint64)

    def run(batches):
        for batch in batches:
            tokens = _tokens(batch.column("tokens")).astype(np.uint64)
            rep = batch.column("rep").to_numpy(zero_copy_only=False)
            if batch.column("node").null_count:
                roots = mix(np.arange(trees, dtype=np.uint64) + np.uint64(1000))
                rows, node = np.repeat(np.arange(len(rep)), trees), np.tile(roots, len(rep))
            else:
                rows, node = np.arange(len(rep)), batch.column("node").to_numpy(zero_copy_only=False).view(np.uint64)
            for a in range(0, len(rows), 20_000):
                r, n = rows[a: a + 20_000], node[a: a + 20_000]
                for _ in range(levels):
                    draw = mix(n[:, None] + (place + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
                    chosen = draw < need
                    chosen[np.arange(len(r)), draw.argmin(1)] = True
                    at, p = np.nonzero(chosen)
                    n = mix(mix(n[at] + (p.astype(np.uint64) << np.uint64(40))) ^ (tokens[r[at], p] * np.uint64(0x9E3779B97F4A7C15)))
                    r = r[at]
                yield pa.record_batch({"node": pa.array(n.view(np.int64)), "rep": pa.array(rep[r], pa.int64())})

    return run


def _forest(pairs, n: int):
    """The pairs that join two parts, in the order given."""
    root, parts = list(range(n)), n
    for a, b in pairs:
        x, y = int(a), int(b)
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        while root[y] != y:
            root[y] = root[root[y]]
            y = root[y]
        if x != y:
            root[max(x, y)] = min(x, y)
            yield int(a), int(b)
            parts -= 1
            if parts == 1:
                return


def _compare_nodes(least: int):
    """Loose links inside the small nodes of one bucket: a spanning forest of each, strongest first."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("node", "ascending"), ("rep", "ascending")])
        node, rep, tokens = table.column("node").to_numpy(), table.column("rep").to_numpy(), _tokens(table.column("tokens"))
        edge = np.append(np.flatnonzero(np.append(True, node[1:] != node[:-1])), len(node)) if len(node) else np.zeros(1, int)
        left, right = [], []
        for s, e in zip(edge[:-1], edge[1:]):
            t, r = tokens[s:e], rep[s:e]
            if e - s == 2:
                if np.count_nonzero(t[0] == t[1]) >= least:
                    left.append(int(r[0]))
                    right.append(int(r[1]))
                continue
            alike = np.stack([np.count_nonzero(t == x, axis=1) for x in t])
            a, b = np.nonzero(np.triu(alike >= least, 1))
            order = np.argsort(-alike[a, b], kind="stable")
            for x, y in _forest(zip(a[order], b[order]), e - s):
                left.append(int(r[x]))
                right.append(int(r[y]))
        return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})

    return run


def _compare_rest(least: int):
    """Loose links between the members of a node (or a block of them) and those unlike its pivot: a spanning forest."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = [], []
        if left.num_rows and right.num_rows:
            left, right = left.sort_by("rep"), right.sort_by("rep")
            rep, root, tokens = left.column("rep").to_numpy(), left.column("root").to_numpy(), _tokens(left.column("tokens"))
            names, part = np.unique(np.concatenate([root, right.column("root").to_numpy()]), return_inverse=True)
            for k, (r, t) in enumerate(zip(right.column("rep").to_pylist(), _tokens(right.column("tokens")))):
                own = part[len(rep) + k]
                near = np.flatnonzero((np.count_nonzero(tokens == t, axis=1) >= least) & (part[: len(rep)] != own))
                theirs, one = np.unique(part[near], return_index=True)
                if len(one):
                    a += [r] * len(one)
                    b += rep[near[one]].tolist()
                    part[np.isin(part, theirs)] = own
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _with_pivot(least: int):
    def run(batches):
        for batch in batches:
            near = np.count_nonzero(_tokens(batch.column("tokens")) == _tokens(batch.column("pivot_tokens")), axis=1) >= least
            yield pa.record_batch([*(batch.column(c) for c in ("node", "rep", "pivot", "tokens")), pa.array(near)],
                                  names=["node", "rep", "pivot", "tokens", "near"])

    return run


def _exact_links(words: int, percent: int):
    """Exact links among the texts of one component (or of two blocks of one): a spanning forest of each class."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("rep")
        rep = table.column("rep").to_numpy()
        sets, sizes = [], []
        for _, _, hashes, start in shingle_sets(table.column("text"), words):
            sets.append(hashes)
            sizes.append(np.diff(start))
        size = np.concatenate(sizes)
        start = np.append(0, np.cumsum(size))
        names, place = np.unique(np.concatenate(sets), return_inverse=True)
        n, mark = len(rep), np.zeros(len(names), bool)
        part = np.arange(n)  # the smallest member linked so far
        left, right = [], []
        todo = np.ones(n, bool)
        while True:
            count = np.bincount(part, minlength=n)
            largest = int(count.argmax())
            # members of the largest part need no turn of their own: all others meet them
            waiting = np.flatnonzero(todo & (part != largest)) if count[largest] > 1 else np.flatnonzero(todo)
            if count[largest] == n or not len(waiting):
                break
            p = int(waiting[0])
            todo[p] = False
            mark[place[start[p]: start[p + 1]]] = True
            both = np.add.reduceat(mark[place], start[:-1], dtype=np.int64)
            mark[place[start[p]: start[p + 1]]] = False
            for q in np.flatnonzero((100 * both >= percent * (size[p] + size - both)) & (part != part[p])):
                if part[q] != part[p]:
                    left.append(int(rep[p]))
                    right.append(int(rep[q]))
                    low, high = sorted((part[p], part[q]))
                    part[part == high] = low
        return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})

    return run


def connected(links: DataFrame, name: str) -> DataFrame:
    """(v, root): the smallest vertex reachable, for every vertex of ``links`` (a, b).

    Every vertex hooks to its smallest neighbour, pointers jump to the tops, and the links between different tops
    are all that the next turn sees: links inside a group are read once, however many they are.
    """
    few = max(1, shuffle_partitions(links.sparkSession) // 8)  # rows of two ids: larger partitions do
    kept = lambda df, what: materialize(df.coalesce(few), f"{name}-{what}")
    ordered = lambda x, y: [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]
    links, label = kept(links.select(*ordered("a", "b")).distinct(), "links"), None
    while True:
        both = links.union(links.select("b", "a")).toDF("v", "u")
        top = kept(both.groupBy("v").agg(F.least(F.min("u"), F.first("v")).alias("root")), "top")
        while True:
            done = kept(top.join(top.toDF("root", "far"), "root").select("v", F.col("far").alias("root"), F.col("root").alias("was")), "top")
            top = done.select("v", "root")
            if not done.filter("root != was").limit(1).count():
                break
        label = top if label is None else kept(label.join(top.toDF("root", "far"), "root", "left").select("v", F.coalesce("far", "root").alias("root")), "label")
        ends = links.join(top.toDF("a", "x"), "a").join(top.toDF("b", "y"), "b").filter("x != y")
        links = kept(ends.select(*ordered("x", "y")).distinct(), "links")
        if not links.limit(1).count():
            return label


def set_classes(docs: DataFrame, words: int = 5, percent: int = 75, trees: int = 16, node_limit: int = 512,
                steps: int = 4, block_limit: int = 4096) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, lo, hi) of every row, and one row per distinct set of rows with a doc_id:
    its key, rep (its number), first (its smallest doc_id), class (the number of its class) and root (the smallest doc_id there)."""
    spark = docs.sparkSession
    places = shuffle_partitions(spark)
    low = percent / 100 - 5 * (percent / 100 * (1 - percent / 100) / PLACES) ** 0.5
    least = max(1, int(low * PLACES))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = materialize(texts.mapInArrow(_signatures(words), "doc_id long, n_shingles long, lo long, hi long, tokens binary"), "signatures")
    key = list(KEY)
    # a set is a vertex of its own, numbered as it is written: a doc_id can stand on several sets
    reps = materialize(signed.filter("n_shingles > 0 and doc_id is not null").groupBy(*key).agg(
        F.min("doc_id").alias("first"), F.any_value("tokens").alias("tokens")).withColumn("rep", F.monotonically_increasing_id()), "reps")

    # trees
    tokens = reps.select("rep", "tokens")
    pairs = reps.select(F.lit(None).cast("long").alias("node"), "rep", "tokens").mapInArrow(
        _branch(percent / 100, trees), "node long, rep long")
    links = None
    for step in range(steps):
        pairs = materialize(pairs, "tree")
        sized = materialize(pairs.groupBy("node").agg(F.count("*").alias("n"), F.min("rep").alias("pivot")).filter("n > 1"), "nodes")
        large = materialize(sized.filter(F.col("n") > node_limit).select("node", "pivot"), "large")
        crowded = large.limit(1).count() > 0
        # members of large nodes are dealt by rep alone: no task gets a whole node, and each is joined with its node once
        light = pairs.join(large, "node", "left_anti") if crowded else pairs
        small = light.join(sized.filter(F.col("n") <= node_limit).select("node"), "node").join(tokens, "rep")
        found = materialize(small.withColumn("bucket", F.pmod("node", F.lit(2 * places))).select("bucket", "node", "rep", "tokens").groupBy(
            "bucket").applyInArrow(_compare_nodes(least), "a long, b long").distinct(), "loose")
        links = found if links is None else links.unionAll(found)
        if not crowded:
            break
        pivots = materialize(large.join(tokens.toDF("pivot", "pivot_tokens"), "pivot").select("node", "pivot", "pivot_tokens"), "pivots")
        star = materialize(pairs.join(pivots, "node").join(tokens, "rep").select("node", "rep", "pivot", "tokens", "pivot_tokens").mapInArrow(
            _with_pivot(least), "node long, rep long, pivot long, tokens binary, near boolean"), "star")
        linked = star.filter("rep != pivot")
        if step < steps - 1:
            linked = linked.filter("near")
        links = links.unionAll(linked.select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct())
        # members unlike the pivot: none, nothing is left to find; few, they meet all members; many, the node branches
        state = materialize(star.groupBy("node").agg(F.count("*").alias("n"), F.count_if(~F.col("near")).alias("rest")), "state")
        few = state.filter(F.col("rest").between(1, node_limit)).select("node", F.ceil(F.col("n") / block_limit).cast("int").alias("blocks"))
        member = ["node", "block", "rep", F.when(F.col("near"), F.col("pivot")).otherwise(F.col("rep")).alias("root"), "tokens"]
        every = star.join(few, "node").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).select(*member)
        rest = star.filter("not near").join(few, "node").withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)"))).select(*member).select(
            *[F.col(c).alias(c) for c in ("node", "block", "rep", "root", "tokens")])
        links = links.unionAll(materialize(every.groupBy("node", "block").cogroup(rest.groupBy("node", "block")).applyInArrow(
            _compare_rest(least), "a long, b long").distinct(), "rest"))
        many = state.filter(F.col("rest") > node_limit).select("node")
        if many.limit(1).count() == 0:
            break
        pairs = star.join(many, "node").select("node", "rep", "tokens").mapInArrow(_branch(percent / 100, trees, 3), "node long, rep long")

    # exact comparison inside loose components
    part = connected(links, "loose")
    size = part.groupBy("root").agg(F.count("*").alias("n")).withColumn("blocks", F.ceil(F.col("n") / block_limit).cast("int"))
    placed = part.join(size, "root").withColumn("mine", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int"))
    # block i meets every block j: the pair (i, j), i <= j, gets both
    placed = placed.select("root", F.col("v").alias("rep"), F.explode(F.expr(
        "transform(sequence(0, blocks - 1), j -> struct(least(mine, j) as i, greatest(mine, j) as j))")).alias("at"))
    placed = placed.select("root", "rep", "at.i", "at.j")
    # one text per set, from the rows of its smallest doc_id
    linked = reps.join(part.select(F.col("v").alias("rep")), "rep").select(F.col("first").alias("doc_id"), *key, "rep")
    keyed = texts.filter("doc_id is not null").mapInArrow(set_keys(words), "doc_id long, text string, n_shingles long, lo long, hi long")
    sources = keyed.join(linked.hint("merge"), ["doc_id", *key]).groupBy("doc_id", *key, "rep").agg(F.min("text").alias("text")).select("rep", "text")
    exact = materialize(placed.join(sources, "rep").select("root", "i", "j", "rep", "text").groupBy("root", "i", "j").applyInArrow(
        _exact_links(words, percent), "a long, b long").distinct(), "exact")
    root = connected(exact, "class")
    lowest = root.join(reps.select(F.col("rep").alias("v"), "first"), "v").groupBy("root").agg(F.min("first").alias("lowest"))
    named = root.join(lowest, "root").select(F.col("v").alias("rep"), F.col("root").alias("class"), "lowest")
    members = materialize(reps.select(*key, "rep", "first").join(named, "rep", "left").select(
        *key, "rep", "first", F.coalesce("class", "rep").alias("class"), F.coalesce("lowest", "first").alias("root")), "members")
    gc.collect()
    return signed.select("doc_id", *key), members


def near_dup_classes(docs: DataFrame, **limits) -> DataFrame:
    """Class of every document under ``100 * |A & B| >= percent * |A | B|`` on lower-cased (A-Z) word shingles.

    ``docs`` needs ``doc_id`` (long) and ``text``; other columns are ignored.
    ``limits`` are those of ``set_classes``. Returns one row per input row:
    doc_id, n_shingles (distinct), component_id (smallest doc_id reachable over
    links, itself included), kept (doc_id is component_id).

    Null or blank texts have the empty set, n_shingles 0, and link to nothing.
    Texts of fewer than ``words`` words have one shingle, all their words.
    Equal sets are linked; rows that share a doc_id are separate rows, each in
    the class of its own text. Empty table: no rows.
    """
    signed, members = set_classes(docs, **limits)
    return signed.join(members.select(*KEY, "root"), list(KEY), "left").select(
        "doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"),
        F.coalesce(F.coalesce("root", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"))


def op2_minhash_join(spark, sf_dir: str) -> DataFrame:
    return near_dup_classes(documents(spark, sf_dir))
