"""Null ids, clashing columns and the whole pipeline against brute-force versions."""

import hashlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import LONG, ROWS, SCHEMA, SF, texts

import corpus_pipeline
from arrears.llm import minhash_join
from arrears.llm.ann_forest import nearest
from arrears.llm.bpe import bpe_decode, bpe_encode
from arrears.llm.chat import format_chats, records_from_rows
from arrears.llm.minhash_join import near_dup_classes
from arrears.llm.mixing import mix_copies
from arrears.llm.pii import FEATURES, LABELS, detect_pii, find_spans, fit_crf
from arrears.llm.quality_model import score_quality
from arrears.llm.quality_rules import quality_verdicts
from arrears.llm.suffix_dedup import suffix_dedup
from arrears.llm.url_rules import RULES, judge_urls

NO_ID = [(None, LONG, "a"), (None, LONG, "a"), (None, None, None), (None, "mail me at a.b@c.org or 4.3.2.1", "b")]
MORE = ROWS + NO_ID + [(20, "\x00 zero \x00 byte", ""), (21, "\U0001F600 " * 50, "ü")]
CLASH = ("_row", "_id", "_n", "_nth", "_kept", "_copy", "_copies", "_size", "_source", "block", "kept", "copies", "size", "best", "asked")


@pytest.fixture(scope="module")
def wild(spark):
    return spark.createDataFrame(MORE, SCHEMA).withColumns({c: F.lit("x") for c in CLASH})


def without_id(df):
    return df.filter("doc_id is null").collect()


def test_null_ids_lose_and_remove_nothing(spark, wild):
    got = suffix_dedup(wild).collect()
    assert sorted((r["n_bytes"], len(r["spans"]), len(r["kept"])) for r in got if r["doc_id"] is None) == sorted(
        (len((t or "").encode()), 0, len((t or "").encode())) for _, t, _ in NO_ID)
    ordered = [r[:2] for r in MORE if r[0] is not None]
    assert sorted((r["doc_id"], r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["spans"]) // 2, hashlib.sha256(r["kept"]).hexdigest())
                  for r in got if r["doc_id"] is not None) == brute.suffix_dedup(ordered)


def test_null_ids_keep_their_rows(spark, wild):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert all(r["kept"] for r in without_id(near_dup_classes(wild)))
    assert sorted(r["size"] for r in without_id(mix_copies(wild))) == sorted(len(brute.WORD.findall(t or "")) for _, t, _ in NO_ID)
    assert sorted(r["decoded"] for r in without_id(bpe_decode(bpe_encode(wild)))) == sorted(t or "" for _, t, _ in NO_ID)
    assert all(0 <= r["score"] <= 1 for r in without_id(score_quality(wild, labels)))
    assert sorted(r["n_words"] for r in without_id(quality_verdicts(wild))) == sorted(len(brute.WORD.findall(t or "")) for _, t, _ in NO_ID)
    assert sorted(len([s for s in r["spans"] if s["base"]]) for r in without_id(detect_pii(wild))) == sorted(len(brute.base_pii(t)) for _, t, _ in NO_ID)


def test_null_keys_of_pages_turns_and_vectors(spark):
    extra = {c: F.lit("x") for c in CLASH}
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = spark.createDataFrame([(None, "http://a.net/"), (None, None), (3, "http://" + "a." * 5000 + "net/x")], "page_id long, url string")
    got = judge_urls(pages.withColumns({**extra, "rule": F.lit("x"), "path": F.lit("x")}), rules).select("page_id", "rule", "verdict").collect()
    assert sorted(map(tuple, got), key=str) == [(3, "net/", "block"), (None, "net/", "block"), (None, None, "allow")]
    turns = spark.createDataFrame([(None, 0, "user", "x"), (1, None, None, LONG), (1, None, "user", None)], "conv_id long, turn long, role string, text string")
    assert format_chats(records_from_rows(turns.withColumns(extra)), ["conv_id"]).count() == 2
    vectors = spark.createDataFrame([(None, [1.0, 2.0]), (0, [1.0, 0.5]), (1, [2.0, 3.0]), (1, [2.0, 3.0]), (2, [])], "vec_id long, embedding array<float>")
    assert [tuple(r)[:3] for r in nearest(vectors.withColumns(extra), F.col("id") % 100 == 0).collect()] == [(0, 1, 1)]


def test_op7_blocks_and_equal_queries(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 8)).astype(np.float32)
    x[::3] = x[0]  # a third of all rows are one vector, queries among them
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for r in nearest(rows, F.col("id") % 2 == 0, block_rows=7).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    y, hits = x.astype(float), 0
    assert sorted(got) == list(range(0, 600, 2))
    for q, found in got.items():
        d = np.sqrt(((y - y[q]) ** 2).sum(1))
        d[q] = np.inf
        want = np.lexsort((np.arange(600), d))[:10].tolist()
        assert len(found) == 10 and q not in found and (q % 3 or found == want)
        hits += len(set(found) & set(want))
    assert hits >= 0.9 * 3000


def test_pipeline_stages_of_wild_rows(spark, wild):
    docs = wild.withColumns({"lang": F.lit(None).cast("string"), "n_chars": F.lit(1).cast("long")})
    kept = corpus_pipeline.near_dedup(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sum(r["doc_id"] is None for r in kept.collect()) == len(NO_ID)
    mixed = corpus_pipeline.mixing(spark, docs, SF)
    assert mixed.columns == docs.columns
    due = {}
    for r in mix_copies(docs).collect():
        due[r["doc_id"], r["source"], r["size"]] = due.get((r["doc_id"], r["source"], r["size"]), 0) + r["copies"]
    for r in mixed.collect():
        due[r["doc_id"], r["source"], len(brute.WORD.findall(r["text"] or ""))] -= 1
    assert not any(due.values())


def test_pipeline_brute_force(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole.no_truncation()
    whole.no_padding()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r["doc_id"] for r in score_quality(docs, labels).filter("predicted = 1").collect()}
    left = [(d, t) for d, t in texts(spark) if d in good]
    left = dict(r for r, near in zip(sorted(left), brute.near_dups(left)) if near[3])
    assert 0 < len(left) < len(good) < docs.count()
    unique = docs.filter(F.col("doc_id").isin(sorted(left)))
    clean = spark.createDataFrame(corpus_pipeline.pii(spark, unique, SF).toArrow())
    for r in clean.collect():  # no pattern stands where the text said so, all else is untouched
        spans = brute.base_pii(left[r["doc_id"]])
        assert r["n_chars"] == len(r["text"] or "") and (spans or r["text"] == left[r["doc_id"]])
        assert all(left[r["doc_id"]][a:b] not in r["text"] for kind, a, b in spans if kind == "email")
    copies = {r["doc_id"]: r["copies"] for r in mix_copies(clean).collect()}
    want = []
    for r in clean.collect():
        ids = whole.encode(r["text"] or "", add_special_tokens=False).ids
        want += [(r["doc_id"], len(ids), np.array(ids, "<u4").tobytes(), whole.decode(ids, skip_special_tokens=False))] * copies[r["doc_id"]]
    got = [(r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["decoded"]) for r in corpus_pipeline.run(spark, SF).collect()]
    assert sorted(got) == sorted(want)


def test_op1_repeated_grams_at_every_offset(spark):
    rng = np.random.default_rng(11)
    word = lambda n: bytes(rng.integers(97, 123, n).astype(np.uint8)).decode()
    docs = []
    for run in [c * n for c in "-= #" for n in (16, 20, 24, 32, 40)] + ["ab" * 12, "xyz" * 9, "-=" * 17]:
        for k in range(64):  # a passage of one window, first inside a document, then alone
            passage = word((50 - len(run)) // 2) + run + word(50 - len(run) - (50 - len(run)) // 2)
            docs += [(len(docs), word(k + 1) + passage + word(20)), (len(docs) + 1, passage)]
    got = sorted((r["doc_id"], r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["spans"]) // 2, hashlib.sha256(r["kept"]).hexdigest())
                 for r in suffix_dedup(spark.createDataFrame(docs, "doc_id long, text string"), block_docs=100).collect())
    assert got == brute.suffix_dedup(docs)


def test_op10_spans_depend_on_the_document_alone(spark):
    model = {"unary": np.zeros((FEATURES, LABELS)), "chain": np.eye(LABELS), "skip": 3 * np.eye(LABELS)}
    model["unary"][:, 4] = 1.0  # all numbers look like phones
    some = ["call (555) 555-0100", "mail a.b@c.org or (555) 555-0100", "+1 (555) 555-0100 and 555-0100 555-0100", None, "no number", "7 " * 40 + "x@y.org"]
    alone = [find_spans([t], model, 0.5)[0] for t in some]
    # a document without a base span goes through the field as well
    assert sum(not s[3] for s in alone[0]) == 2 and sum(not s[3] for s in alone[1]) == 2 and alone[3] == alone[4] == []
    assert find_spans(some, model, 0.5) == alone and find_spans(some[::-1], model, 0.5) == alone[::-1]
    docs = spark.createDataFrame([(i, f"{some[i % 3]} {i}") for i in range(300)], "doc_id long, text string")
    spans = lambda df: sorted(map(tuple, detect_pii(df).collect()))
    assert spans(docs.repartition(1)) == spans(docs.repartition(7, "doc_id"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        assert spans(docs.repartition(1)) == spans(docs.repartition(3))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_op10_repeats_of_base_spans_are_added():
    docs = [f"call +1 (555) 555-{i:04d} now, again 1 (555) 555-{i:04d} and mail u{i}@site.org" for i in range(300)]
    plain = [f"built in {1900 + i % 100} with {i % 50} rooms, 1 hall and order 77-{i:04d}" for i in range(300)]
    found = find_spans(docs + plain, fit_crf(docs + plain))
    for i, spans in enumerate(found[:300]):
        at = docs[i].rindex(f"555-{i:04d}")
        assert (3, at, at + 8, False) in spans and all(k == 3 and a > docs[i].index("again") for k, a, _, base in spans if not base)
    assert not any(found[300:])


def test_op2_other_texts_of_a_doc_id(spark):
    base = [f"w{i}" for i in range(80)]
    near = lambda k: " ".join(base[:k] + [f"x{k}"] + base[k + 1:])
    other = " ".join(f"a{i}" for i in range(40))
    docs = [(1, near(20)), (2, " "), (2, near(40)), (3, other), (3, near(60)), (4, other + " b"), (9, None), (9, near(70)), (5, other), (5, other)]
    got = sorted(map(tuple, near_dup_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()))
    assert got == sorted(brute.near_dups([(d, t or "") for d, t in docs]))


def test_near_dedup_keeps_one_row_of_each_class(spark):
    base = [f"w{i}" for i in range(80)]
    near = lambda k: " ".join(base[:k] + [f"x{k}"] + base[k + 1:])
    other = " ".join(f"a{i}" for i in range(40))
    docs = [(1, near(20)), (1, near(20)), (1, near(30)), (2, " "), (2, near(40)), (3, other), (3, other), (4, other), (4, "one two"),
            (None, other), (None, other), (5, None), (5, None)]
    got = corpus_pipeline.near_dedup(spark, spark.createDataFrame(docs, "doc_id long, text string"), SF).collect()
    kept = sorted([tuple(r) for r in got if r["text"] not in (near(20), near(30))], key=str)
    assert sum(r["text"] in (near(20), near(30)) and r["doc_id"] == 1 for r in got) == 1 and len(got) == len(kept) + 1
    assert kept == sorted([(2, " "), (3, other), (4, "one two"), (None, other), (None, other), (5, None), (5, None)], key=str)


def test_links_inside_a_group_are_read_once(spark, monkeypatch):
    rng = np.random.default_rng(4)
    edges = [(int(order[i]), int(order[rng.integers(i)])) for _ in range(16) for order in [rng.permutation(300)] for i in range(1, 300)]  # 16 trees over one group
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(3000, 2000), (2500, 3000), (4000, 4000)]
    copies, write = [], minhash_join.materialize
    monkeypatch.setattr(minhash_join, "materialize", lambda df, name: (out := write(df, name), copies.append((name, out.count())))[0])
    found = {r["v"]: r["root"] for r in minhash_join.connected(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert found == {i: 0 for i in range(300)} | {1000 + i: 1000 for i in range(61)} | {2000: 2000, 2500: 2000, 3000: 2000, 4000: 4000}
    sizes = [n for name, n in copies if name == "t-links"]
    assert len(sizes) > 1 and sizes[0] > 4000 and sum(sizes[1:]) < sizes[0] / 4 and sizes[-1] == 0


def test_rows_of_large_nodes_meet_their_node_once(spark, monkeypatch):
    base, joined, pairs = [f"w{i}" for i in range(80)], [], []
    frame, write = type(spark.range(0)), minhash_join.materialize
    join = frame.join

    def counted(self, other, on=None, how=None):
        out = join(self, other, on, how)
        if on == "node" and how is None:
            joined.append(out.count())
        return out

    monkeypatch.setattr(frame, "join", counted)
    monkeypatch.setattr(minhash_join, "materialize", lambda df, name: (out := write(df, name), pairs.append(out.count() if name == "tree" else 0))[0])
    totals = []
    for n in (120, 240):
        docs = [(i, " ".join(base[:i % 80] + [f"x{i}"] + base[i % 80 + 1:])) for i in range(n)] + [(1000 + i, f"a{i} b{i} c{i}") for i in range(20)]
        got = sorted(map(tuple, near_dup_classes(spark.createDataFrame(docs, "doc_id long, text string"), node_limit=16, block_limit=64).collect()))
        assert got == sorted(brute.near_dups(docs))
        totals.append((sum(joined), sum(pairs)))
        joined.clear()
        pairs.clear()
    (some, members), (more, twice) = totals
    assert some <= members and more <= twice
    assert more <= 2.5 * some  # a group of twice the size: about twice the rows
