"""Operator 10, personal data by fixed patterns and a skip-chain conditional random field.

Patterns find e-mail addresses, IPv4 addresses, payment cards and phone numbers
(the *base* spans). A CRF over each whole document then adds spans that the
patterns miss but the document itself speaks for: a number that elsewhere in
the text stands in a form that a pattern knows.

Nodes are the words with a digit, ``@`` or ``+``; every other word is surely no
personal data, so it is clamped and splits the chain exactly there. Neighbouring
nodes share a chain potential; a *skip* potential links each node to the next
one with the same letters and digits, to the next with the same last seven
digits, and to the next with the same name before an ``@`` (links grow with
words, not pairs). The words around a node are features of it. Loopy belief
propagation runs over all documents of a batch that have a node at once, as
array operations over the links.

The CRF is trained here by pseudo-likelihood (each node's label given its
neighbours' labels) on the base labels of at most about ``sample`` documents,
chosen by a hash of doc_id, in one small task. Detection is one pass without
shuffle; memory is one batch of texts.
"""

from __future__ import annotations

import pickle
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import documents, small_batches

KINDS = ("email", "ip", "card", "phone")
LABELS = 1 + len(KINDS)
SAMPLE = 4000
FEATURES = 1 << 12
SURE = 0.95
_ACTIVE = re.compile(r"[0-9@+]")
_WORD = re.compile(r"[^\x20\x09-\x0D]*[0-9@+][^\x20\x09-\x0D]*")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# a start inside a run of digits fails where the run's first digit does
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if i % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def _emails(text: str):
    """Leftmost matches: the longest local part before each ``@`` whose domain matches."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        done = found.end() if found else at + 1
        if found:
            yield start, done
        at = text.find("@", done)


def _ip_ok(s: str) -> bool:
    return all(len(p := x.lstrip("0")) < 3 or (len(p) == 3 and int(p) <= 255) for x in s.split("."))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start, in code points."""
    out = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if _ip_ok(m[0])]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_DIGIT.findall(m[0])) <= 15]
    return out


_TRIM = "\"'`.,;:!?()[]{}<>|*#$%&-_/\\="


def _shape(word: str) -> str:
    return re.sub(r"(.)\1{3,}", r"\1\1\1+", re.sub(r"[^\W\d_]", "a", re.sub(r"[0-9]", "0", word[:64])))


def _node_features(word: str, before: str, after: str) -> list[int]:
    digits = "".join(_DIGIT.findall(word))
    bare = word.strip(_TRIM)
    near = [w.strip(_TRIM).lower() for w in before.split()[-2:]]
    named = ("1", f"p{near[-1] if near else ''}", f"q{near[0] if len(near) > 1 else ''}", f"s{_shape(bare)}", f"d{min(len(digits), 24)}", f"l{min(len(word), 40) // 4}", f"@{word.count('@')}.{min(word.count('.'), 4)}",
             f"+{word.startswith('+')}", f"c{len(digits)}{luhn(digits)}" if 16 <= len(digits) <= 19 else "c", f"b{_shape(before)}", f"a{_shape(after)}",
             f"i{_ip_ok(bare)}" if _IP.fullmatch(bare) else "i")
    return [zlib.crc32(x.encode("utf-8", "replace")) % FEATURES for x in named]


class _Graph:
    """Nodes and links of a batch of texts."""

    def __init__(self):
        self.doc, self.start, self.end, self.feats, self.chain, self.skip = [], [], [], [], [], []

    def add(self, doc: int, text: str) -> None:
        last, seen_text, seen_tail, seen_name = None, {}, {}, {}
        for m in _WORD.finditer(text):
            a, b = m.span()
            word, n = m[0], len(self.doc)
            left, right = text.rfind(" ", max(0, a - 24), max(0, a - 1)) + 1, text.find(" ", b + 1, b + 24)
            before = text[max(left, a - 24): a].strip() if a else ""
            after = text[b: right if right > 0 else b + 24].strip()
            self.doc.append(doc)
            self.start.append(a)
            self.end.append(b)
            self.feats.append(_node_features(word, before, after))
            if last is not None and a - self.end[last] == 1:
                self.chain.append((last, n))
            key = re.sub(r"[\W_]", "", word).lower()
            digits = "".join(_DIGIT.findall(word))
            name = re.sub(r"[\W_]", "", word.split("@")[0]).lower()
            for seen, k in ((seen_text, key), (seen_tail, digits[-7:] if len(digits) >= 7 else ""), (seen_name, name if len(name) >= 4 else "")):
                if k and k in seen:
                    self.skip.append((seen[k], n))
                if k:
                    seen[k] = n
            last = n

    def arrays(self):
        link = lambda x: np.array(sorted(set(x)), np.int64).reshape(-1, 2)
        return np.array(self.feats, np.int64).reshape(len(self.doc), -1), link(self.chain), link(self.skip)


def _labels(graph: _Graph, base: dict) -> np.ndarray:
    """Label of each node: the kind of the base span it touches, else 0."""
    out = np.zeros(len(graph.doc), np.int64)
    for n, (d, a, b) in enumerate(zip(graph.doc, graph.start, graph.end)):
        for kind, s, e in base.get(d, ()):
            if s < b and a < e:
                out[n] = kind + 1
                break
    return out


def _repeats(y: np.ndarray, skips: np.ndarray) -> np.ndarray:
    """True for nodes without a label that share a skip key with a labelled one (links of a key run in text order)."""
    near = (y > 0).tolist()
    for a, b in skips.tolist():
        near[b] = near[b] or near[a]
    for a, b in skips[::-1].tolist():
        near[a] = near[a] or near[b]
    return np.array(near, bool) & (y == 0)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(-1, keepdims=True))
    return x / x.sum(-1, keepdims=True)


def fit_crf(texts, steps: int = 150, rate: float = 0.5, decay: float = 1e-3) -> dict:
    """Unary, chain and skip potentials by pseudo-likelihood on the base labels of ``texts``.

    A word that the patterns miss though it repeats one of a base span has no
    known label: it and its links teach nothing.
    """
    graph, base = _Graph(), {}
    for d, text in enumerate(texts):
        if text and _ACTIVE.search(text):
            base[d] = base_spans(text)
            graph.add(d, text)
    unary, chain, skip = np.zeros((FEATURES, LABELS)), np.zeros((LABELS, LABELS)), np.eye(LABELS)
    unary[:, 0] = 0.02  # words that training never saw lean to no personal data
    if not graph.doc:
        return {"unary": unary, "chain": chain, "skip": skip}
    feats, chains, skips = graph.arrays()
    y = _labels(graph, base)
    known = ~_repeats(y, skips)
    chains, skips = (x[known[x].all(1)] for x in (chains, skips))
    target = np.eye(LABELS)[y]
    sums = [np.full_like(w, 1e-8) for w in (unary, chain, skip)]
    for _ in range(steps):
        score = unary[feats].sum(1)
        for w, links in ((chain, chains), (skip, skips)):
            np.add.at(score, links[:, 1], w[y[links[:, 0]]])
            np.add.at(score, links[:, 0], w.T[y[links[:, 1]]])
        diff = (_softmax(score) - target) * known[:, None] / known.sum()
        grads = [np.zeros_like(unary), np.zeros_like(chain), np.zeros_like(skip)]
        np.add.at(grads[0], feats.ravel(), np.repeat(diff, feats.shape[1], 0))
        for g, links in ((grads[1], chains), (grads[2], skips)):
            np.add.at(g, y[links[:, 0]], diff[links[:, 1]])
            np.add.at(g.T, y[links[:, 1]], diff[links[:, 0]])
        for w, g, s in zip((unary, chain, skip), grads, sums):
            g += decay * w
            s += g * g
            w -= rate * g / np.sqrt(s)
    return {"unary": unary, "chain": chain, "skip": (skip + skip.T) / 2}


def posteriors(model: dict, feats: np.ndarray, chains: np.ndarray, skips: np.ndarray, observed: np.ndarray, rounds: int = 10) -> np.ndarray:
    """Label beliefs of every node by loopy belief propagation; nodes with ``observed`` > 0 are clamped to that label.

    Every node gets all rounds: a stop at small changes would depend on the other documents of the batch.
    """
    unary = model["unary"][feats].sum(1)
    known = observed > 0
    unary[known] = -50.0
    unary[known, observed[known]] = 0.0
    links = np.concatenate([chains, skips])
    pot = np.concatenate([np.broadcast_to(model["chain"], (len(chains), LABELS, LABELS)), np.broadcast_to(model["skip"], (len(skips), LABELS, LABELS))])
    src, dst = np.concatenate([links[:, 0], links[:, 1]]), np.concatenate([links[:, 1], links[:, 0]])
    pot = np.concatenate([pot, pot.transpose(0, 2, 1)])  # pot[e, label of src, label of dst]
    back = np.concatenate([np.arange(len(links)) + len(links), np.arange(len(links))])
    message = np.zeros((len(src), LABELS))
    belief = unary
    for _ in range(rounds if len(links) else 0):
        out = (belief[src] - message[back])[:, :, None] + pot
        top = out.max(1)
        new = top + np.log(np.exp(out - top[:, None, :]).sum(1))
        new -= new.max(1, keepdims=True)
        message = 0.5 * message + 0.5 * new
        belief = unary.copy()
        np.add.at(belief, dst, message)
    return _softmax(belief)


def find_spans(texts, model: dict, sure: float = SURE) -> list[list[tuple[int, int, int, bool]]]:
    """(kind, start, end, is base) of every text, by kind, then start."""
    graph, base = _Graph(), {}
    for d, text in enumerate(texts):
        if text and _ACTIVE.search(text):
            base[d] = base_spans(text)
            graph.add(d, text)
    out: list[list] = [[(k, a, b, True) for k, a, b in base.get(d, ())] for d in range(len(texts))]
    if graph.doc:
        feats, chains, skips = graph.arrays()
        observed = _labels(graph, base)
        belief = posteriors(model, feats, chains, skips, observed)
        kind = belief.argmax(1)
        extra = np.flatnonzero((kind > 0) & (observed == 0) & (belief.max(1) >= sure))
        for n in extra:
            text = texts[graph.doc[n]]
            a, b = graph.start[n], graph.end[n]
            while a < b and text[a] in _TRIM and text[a] != "(":
                a += 1
            while b > a and text[b - 1] in _TRIM and text[b - 1] != ")":
                b -= 1
            if a < b:
                out[graph.doc[n]].append((int(kind[n]) - 1, a, b, False))
    return [sorted(s) for s in out]


def masked(text: str, spans) -> str:
    """The text with each span (or run of overlapping spans) replaced by the first one's kind in angle brackets."""
    parts, at = [], 0
    for kind, a, b, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            parts += [text[at:a], f"<{KINDS[kind].upper()}>"]
        at = max(at, b)
    return "".join([*parts, text[at:]])


def detect_pii(docs: DataFrame, sample: int = SAMPLE, sure: float = SURE, keep=(), mask: bool = False) -> DataFrame:
    """Spans of personal data of every whole text.

    ``docs`` needs doc_id and text. Returns one row per input row: doc_id,
    ``keep`` columns, spans (kind, start, end, base; code points, by kind as in
    KINDS, then start) and with ``mask`` also masked, the text with
    ``<KIND>`` in place of each span (null for a null text).

    Null and empty texts have no spans. Repeated rows are treated alike. Rows
    without a doc_id are searched, but never trained on. Every document with a
    node goes through the field, and what it gets depends on its own text and the
    model, not on the rows beside it. A very long text is one graph, a node a
    word with a digit, ``@`` or ``+``. Empty table: no rows.
    """
    rest = [c for c in keep if c not in ("doc_id", "spans", "masked")]
    n = docs.count()
    picked = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter("doc_id is not null")
    if n > sample:
        picked = picked.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(sample / n * (1 << 30)))

    def train(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        return pa.table({"model": pa.array([pickle.dumps(fit_crf(table.column("text").to_pylist()))], pa.binary())})

    # words without digits or @ are no nodes, so texts without them teach nothing
    fitted = picked.filter(F.col("text").rlike("[0-9@+]")).withColumn("one", F.lit(1)).groupBy("one").applyInArrow(train, "model binary").collect()
    model = docs.sparkSession.sparkContext.broadcast(pickle.loads(fitted[0]["model"]) if fitted else fit_crf([]))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def run(batches):
        for b in small_batches(batches):
            texts = b.column("_text").to_pylist()
            found = find_spans(texts, model.value, sure)
            cols = [b.column("doc_id"), *(b.column(c) for c in rest), pa.array([[(KINDS[k], s, e, o) for k, s, e, o in f] for f in found], kind)]
            if mask:
                cols.append(pa.array([t if not f else masked(t, f) for t, f in zip(texts, found)], pa.string()))
            yield pa.record_batch(cols, names=["doc_id", *rest, "spans", *["masked"] * mask])

    source = docs.select("doc_id", *rest, F.col("text").cast("string").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "_text")
    return source.mapInArrow(run, f"{schema}, spans array<struct<kind:string,start:bigint,end:bigint,base:boolean>>" + ", masked string" * mask)


def op10_pii(spark, sf_dir: str) -> DataFrame:
    found = detect_pii(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    listed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select("doc_id", *map(count, KINDS), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
