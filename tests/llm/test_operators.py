"""Every operator against its brute-force version on the sf0.001 tables and on hard small rows."""

import hashlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from arrears.llm.ann_forest import nearest, op7_ann_forest
from arrears.llm.bpe import bpe_decode, bpe_encode, op6_bpe
from arrears.llm.chat import PROBE, canonical_turns, format_chats, parse_formatted, records_from_rows
from arrears.llm.minhash_join import near_dup_classes, op2_minhash_join
from arrears.llm.mixing import document_sizes, mix_copies, source_targets
from arrears.llm.pii import base_spans, detect_pii, op10_pii
from arrears.llm.quality_model import op8_quality_model, score_quality
from arrears.llm.quality_rules import op9_quality_rules, quality_verdicts
from arrears.llm.suffix_dedup import op1_suffix_dedup, suffix_dedup
from arrears.llm.url_rules import RULES, judge_urls

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 997} and{i % 13}" for i in range(9000))
# null, empty, blank, short, very long, repeated row, near copy, clashing extra columns
ROWS = [(1, None, None), (2, "", "a"), (3, " \n\t", "a"), (4, "one two", "b"), (5, LONG, "b"), (5, LONG, "b"), (6, LONG + " tail", None),
        (7, "é漢 +1 (555) 555-0100 mail x@y.org ip 1.2.3.4 and 999.1.1.1", "a"), (8, "a" * 70, "a"), (9, "a" * 60, "b"), (10, "One TWO", "b")]
SCHEMA = "doc_id long, text string, source string"


@pytest.fixture(scope="module")
def hard(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    clash = ("bucket", "block", "size", "score", "spans", "kept", "node", "rep", "root", "n", "rules", "ids", "key", "_row", "masked")
    return df.withColumns({c: F.lit("x") for c in clash})


@pytest.fixture(scope="module")
def none(hard):
    return hard.filter("false")


def texts(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_op1_brute_force(spark, hard, none):
    assert sorted(map(tuple, op1_suffix_dedup(spark, SF).collect())) == brute.suffix_dedup(texts(spark))
    got = sorted((r["doc_id"], r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["spans"]) // 2, hashlib.sha256(r["kept"]).hexdigest())
                 for r in suffix_dedup(hard, block_docs=3).collect())
    assert got == brute.suffix_dedup([r[:2] for r in ROWS])
    assert suffix_dedup(none).count() == 0


def test_op1_many_edges_of_one_passage(spark):
    passage = "the passage that all of these documents share, word for word, to its end"
    docs = [(i, f"{i:07d}" * (i % 5) + passage + f"{i * 7919:09d}" * (i % 4)) for i in range(120)]
    got = sorted((r["doc_id"], r["n_bytes"], r["n_bytes"] - len(r["kept"])) for r in suffix_dedup(
        spark.createDataFrame(docs, "doc_id long, text string"), block_docs=40).collect())
    assert got == [r[:3] for r in brute.suffix_dedup(docs)]


def test_op2_brute_force(spark, hard, none):
    assert sorted(map(tuple, op2_minhash_join(spark, SF).collect())) == brute.near_dups(texts(spark))
    assert sorted(map(tuple, near_dup_classes(hard).collect())) == [
        (r[0], *r[1:3], r[0] == r[2]) for r in brute.near_dups([r[:2] for r in ROWS])]
    assert near_dup_classes(none).count() == 0


def test_op2_large_nodes_and_blocks(spark):
    base = [f"w{i}" for i in range(60)]
    docs = []
    for i in range(90):  # one big group, a chain of weaker links and strangers that share a passage
        w = list(base)
        w[(i * 7) % 60] = f"x{i}"
        docs.append((i, " ".join(w)))
    docs += [(200 + i, " ".join(base[:20] + [f"q{i}_{j}" for j in range(30)])) for i in range(60)]
    got = sorted(map(tuple, near_dup_classes(spark.createDataFrame(docs, "doc_id long, text string"), node_limit=8, block_limit=32).collect()))
    assert got == brute.near_dups(docs)


def test_op3_targets_and_limits(spark, hard, none):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = mix_copies(docs, group_docs=16).cache()
    per = out.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("most")).collect()
    assert all(abs(r["taken"] - r["target"]) <= r["most"] for r in per)
    assert out.filter("taken > 2 * size").count() == 0
    total = out.agg(F.sum("size")).first()[0]
    assert abs(sum(r["target"] for r in per) - 1.5 * total) < 1e-6 * total
    assert rows(out) == rows(mix_copies(docs.repartition(5), group_docs=16))
    assert mix_copies(hard).count() == len(ROWS) and mix_copies(none).count() == 0


def test_op3_water_filling(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), ("c", 1000), (None, 5)], "source string, size long")
    got = {r["source"]: r["target"] for r in source_targets(sizes).collect()}
    weight, cap, left, open_ = {"a": 3, "b": 1, "c": 2, None: 3}, {"a": 20, "b": 200, "c": 2000, None: 10}, 1.5 * 1115, {"a", "b", "c", None}
    want = {}
    while True:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > cap[s]}
        if not over:
            break
        for s in over:
            want[s], left = cap[s], left - cap[s]
        open_ -= over
    want |= {s: level * weight[s] for s in open_}
    assert {s: round(x, 6) for s, x in got.items()} == {s: round(x, 6) for s, x in want.items()}
    assert document_sizes(spark.createDataFrame([(1, " a  b\n", "x"), (2, None, "x")], SCHEMA)).agg(F.sum("size")).first()[0] == 2


def test_op4_round_trip_and_layouts(spark):
    hard = [(1, 0, "user", "&amp; <| <|im_end|>\n<|im_start|>x"), (1, 1, "assistant", None), (1, 1, "assistant", "tie"), (2, None, None, ""),
            (3, 0, "a\nb&nl;", "t<"), (3, 1, "assistant", PROBE)]
    out = format_chats(records_from_rows(spark.createDataFrame(hard, "conv_id long, turn long, role string, text string")), ["conv_id"])
    got = {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in out.select("conv_id", parse_formatted(F.col("formatted")).alias("turns")).collect()}
    assert got == {1: [("user", hard[0][3]), ("assistant", ""), ("assistant", "tie")], 2: [("", "")], 3: [("a\nb&nl;", "t<"), ("assistant", PROBE)]}
    lines = ['{"id":1,"prompt":"p","response":"r"}', '{"id":2,"instruction":"i","output":"o"}', '{"id":3,"instruction":"i","input":"in","output":"o"}',
             '{"id":4,"conversations":[{"from":"human","value":"h"},{"from":"gpt","value":"g"}]}', '{"id":5,"data":{"prompt":"p","response":"r"}}', '{"id":6,"odd":1}']
    wide = spark.read.json(spark.sparkContext.parallelize(lines))
    got = {r["id"]: (r["layout"], r["turns"] and [tuple(t) for t in r["turns"]]) for r in canonical_turns(wide, ["id"]).collect()}
    assert got[1] == ("prompt_response", [("user", "p"), ("assistant", "r")]) and got[5] == ("nested", [("user", "p"), ("assistant", "r")])
    assert got[2][1] == [("user", "i"), ("assistant", "o")] and got[3][1] == [("user", "i"), ("user", "in"), ("assistant", "o")]
    assert got[4] == ("from_value", [("user", "h"), ("assistant", "g")]) and got[6] == (None, None)
    assert format_chats(wide.filter("false"), ["id"]).count() == 0


def test_op5_nested_rules(spark):
    urls = ["https://Blog.Example.NET/en/x?y", "http://example.net", "ftp://net/", "http://xexample.net/en/", None, "no scheme", "http://a.org/fr/1#x",
            "http://a.org/en", "http://m.example.com/de/", "http://EXAMPLE.com/de?x", "://.net/q", "http://net./", "x://y://example.net/en/"]
    pages = spark.createDataFrame(list(enumerate(urls)) + [(0, urls[0])], "page_id long, url string").withColumn("host", F.lit("clash"))
    rules = spark.createDataFrame(RULES + [(None, "/", "block")], "host string, path string, verdict string")
    got = rows(judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict"))

    def judge(i, u):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        n = next((k for k, c in enumerate(rest) if c in "/?#"), len(rest))
        host, path = brute.lower(rest[:n]), rest[n:].split("?")[0].split("#")[0]
        fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, None, "allow"))
        return i, host, path, best[1], best[2]

    assert got == sorted([judge(i, u) for i, u in enumerate(urls)] + [judge(0, urls[0])], key=str)
    assert judge_urls(pages.filter("false"), rules).count() == 0
    assert judge_urls(pages, rules.filter("false")).filter("verdict = 'allow' and rule is null").count() == len(urls) + 1


def test_op6_equals_the_tokenizers_library(spark, hard, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole.no_truncation()
    whole.no_padding()
    rng = np.random.default_rng(2)
    odd = [(100 + k, "".join(rng.choice(list(a), n)) + " x<|endoftext|> y" + "".join(rng.choice(list(a), n // 2)), "z")
           for k, (a, n) in enumerate([("ab", 900), ("0123", 700), (" \n\t", 500), ("é漢", 400), ("!?", 800), ("aab ", 600)])]
    docs = hard.select("doc_id", "text", "source").union(spark.createDataFrame(odd, SCHEMA))
    want = sorted((d, whole.encode(t or "", add_special_tokens=False).ids) for d, t, _ in ROWS + odd)
    for segment in (64, 16_384):
        got = bpe_decode(bpe_encode(docs, segment=segment)).collect()
        assert sorted((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in got) == want
        assert sorted((r["doc_id"], r["decoded"]) for r in got) == sorted((d, t or "") for d, t, _ in ROWS + odd)
    assert bpe_encode(none).count() == 0
    assert {c for c, _ in op6_bpe(spark, SF).dtypes} == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}


def test_op7_recall_and_hard_vectors(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").toPandas()
    x, ids = np.array(table["embedding"].tolist(), float), table["vec_id"].to_numpy()
    got, hits, total = {}, 0, 0
    for r in op7_ann_forest(spark, SF).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q, found in got.items():
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        d[ids == q] = np.inf
        hits, total = hits + len({v for _, v, _ in found} & set(ids[np.lexsort((ids, d))[:10]])), total + 10
        assert all(abs(s - d[ids == v][0]) < 1e-12 for _, v, s in found)
    assert total and hits / total >= 0.9
    odd = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (100, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [1.0]), (5, [None, 1.0]), (6, [0.0, 1.0])]
    odd += [(10 + i, [1.0, 0.0]) for i in range(40)]  # equal vectors tie by id
    df = spark.createDataFrame(odd, "vec_id long, embedding array<float>")
    out = sorted(map(tuple, nearest(df, F.col("id") % 100 == 0).collect()))
    assert [r[2] for r in out if r[0] == 0] == list(range(10, 20)) and [r[2] for r in out if r[0] == 100] == [0, *range(10, 19)]
    assert nearest(df.filter("false"), F.col("id") % 100 == 0).count() == 0
    assert [r[2] for r in nearest(df.filter("vec_id in (0, 6)"), F.col("id") == 0).collect()] == [6]


def test_op8_held_out_accuracy(spark, hard, none):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored = op8_quality_model(spark, sf).join(labels, "doc_id").filter("held_out").toPandas()
    assert len(scored) > 50 and (scored["predicted"] == scored["quality"]).mean() > 0.95
    few = score_quality(hard, labels, keep=["source", "text"])
    assert few.count() == len(ROWS) and few.filter("score < 0 or score > 1 or score is null").count() == 0
    assert score_quality(none, labels).count() == 0
    assert {r["score"] for r in score_quality(hard, labels.filter("false")).collect()} == {0.5}


def test_op9_counts_and_verdicts(spark, hard, none):
    want = {d: brute.rule_counts(t) for d, t in texts(spark)}
    for r in op9_quality_rules(spark, SF).collect():
        n = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert n == want[r["doc_id"]]
        assert r["base_failed"] == (n[0] < 10 or 100 * n[4] > 20 * n[0]) and not (r["base_failed"] and r["kept"])
    got = sorted((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in quality_verdicts(hard).collect())
    assert got == sorted((d, *brute.rule_counts(t)) for d, t, _ in ROWS)
    assert quality_verdicts(none).count() == 0
    sf = "/root/testdata/sf0.01"
    seen = op9_quality_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    assert seen[seen["quality"] == 1]["kept"].mean() > 0.95 and seen[seen["quality"] == 0]["kept"].mean() < 0.1


def test_op9_em_recovers_planted_accuracies(spark):
    from arrears.llm.quality_rules import fit_rules

    rng = np.random.default_rng(4)
    planted = {"a": (0.97, 0.2), "b": (0.9, 0.35), "c": (0.85, 0.5), "d": (0.6, 0.55), "e": (0.93, 0.1)}
    good = rng.random(30_000) < 0.7
    votes = {r: np.where(rng.random(len(good)) < 0.1, None, (rng.random(len(good)) < np.where(good, *p)).astype(int)) for r, p in planted.items()}
    rows = spark.createDataFrame(list(zip(*[[None if v is None else int(v) for v in votes[r]] for r in planted])), ", ".join(f"{r} int" for r in planted))
    share, chance = fit_rules(rows, list(planted), rounds=60, anchor="a")
    assert abs(share - good.mean()) < 0.03
    assert all(abs(x - y) < 0.05 for r in planted for x, y in zip(chance[r], planted[r]))
    # the sign follows the anchor, not the start
    share, chance = fit_rules(rows, list(planted), rounds=60, start=(0.4, 0.9), anchor="a")
    assert abs(share - good.mean()) < 0.03 and chance["a"][0] > chance["a"][1]


def test_op9_posterior_decides(spark):
    from arrears.llm.quality_rules import rule_votes

    sf = "/root/testdata/sf0.01"
    seen = quality_verdicts(spark.read.parquet(f"{sf}/documents.parquet")).toPandas()
    bad = (seen[list(rule_votes())] == 0).sum(axis=1)
    assert (seen["kept"] == (~seen["base_failed"] & (seen["posterior"] >= 0.5))).all()
    # one weak bad vote may pass, others do not: neither all-must-pass nor the base rules alone
    assert ((bad == 1) & seen["kept"]).sum() >= 5 and ((bad > 0) & ~seen["base_failed"] & ~seen["kept"]).sum() >= 5


def test_op10_base_spans(spark, hard, none):
    want = {d: brute.base_pii(t) for d, t in texts(spark)}
    for r in op10_pii(spark, SF).collect():
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in want[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert {f"{k}:{a}:{b}" for k, a, b in want[r["doc_id"]]} <= set(r["spans"].split(","))
    kinds = ("email", "ip", "card", "phone")
    for t in ["a@b.c@d.e x@@y.z @q.r", "1.2.3.4.5.6.7.8 300.1.1.1 0001.1.1.255", "4111 1111-1111 1111 4111111111111112", "+1 (555) 555-0100) +12 +1.2.3.4.5.6.7.8",
              "p@q.r" * 5, "1" * 5000, "a" * 5000 + "@", ROWS[6][1] + "x@y.zz"]:
        assert [(kinds[k], a, b) for k, a, b in base_spans(t)] == brute.base_pii(t)
    out = {r["doc_id"]: r for r in detect_pii(hard, keep=["source"], mask=True).collect()}
    assert out[7]["masked"] == "é漢 <PHONE> mail <EMAIL> ip <IP> and 999.1.1.1" and out[1]["masked"] is None and out[2]["spans"] == []
    assert detect_pii(none).count() == 0


def test_op10_skip_links_add_repeats(spark):
    again = [f"call +1 (555) 555-{i:04d} now, again 1 (555) 555-{i:04d} and mail u{i}@site.org" for i in range(300)]
    clean = [f"version 3.{i} of chapter {i} in 19{i % 100:02d}, page {i * 7}" for i in range(300)]
    found = {r["doc_id"]: r["spans"] for r in detect_pii(spark.createDataFrame(list(enumerate(again + clean)), "doc_id long, text string")).collect()}
    for i, text in enumerate(again):
        assert [s["kind"] for s in found[i] if s["base"]] == ["email", "phone"]
        added = [text[s["start"]: s["end"]] for s in found[i] if not s["base"]]
        assert added and set(added) <= {"1", "(555)", f"555-{i:04d}"}
    assert not any(found[300 + i] for i in range(300))


def test_op10_every_document_with_a_node_is_in_the_field(monkeypatch):
    import arrears.llm.pii as m

    seen = []
    monkeypatch.setattr(m._Graph, "add", lambda self, d, text, add=m._Graph.add: (seen.append(text), add(self, d, text)))
    m.find_spans(["no base span, but 555-0100", "none at all", "a@b.cd", None], m.fit_crf([]))
    assert seen == ["no base span, but 555-0100", "a@b.cd"]


def _exact_beliefs(model, feats, chains, skips, observed):
    """Label shares of every node over all labellings."""
    import itertools

    n, labels = len(feats), model["chain"].shape[0]
    total = np.zeros((n, labels))
    unary = model["unary"][feats].sum(1)
    for y in itertools.product(range(labels), repeat=n):
        if all(o == 0 or o == v for o, v in zip(observed, y)):
            score = sum(unary[i, v] * (observed[i] == 0) for i, v in enumerate(y))
            score += sum(model["chain"][y[a], y[b]] for a, b in chains) + sum(model["skip"][y[a], y[b]] for a, b in skips)
            total[range(n), y] += np.exp(score)
    return total / total.sum(1, keepdims=True)


@pytest.mark.parametrize("n, chains, skips, near", [
    (6, [(0, 1), (1, 2), (3, 4), (4, 5)], [], 0.01),
    (7, [(0, 1), (2, 3), (4, 5)], [(1, 2), (3, 4), (5, 6)], 0.01),
    (5, [(0, 1), (1, 2), (2, 3)], [(0, 2), (1, 4)], 0.08), (8, [(0, 1), (1, 2), (2, 3), (4, 5), (6, 7)], [(0, 3), (3, 4)], 0.08)])
def test_op10_beliefs_against_enumeration(n, chains, skips, near):
    from arrears.llm.pii import FEATURES, posteriors

    rng = np.random.default_rng(n)
    labels = 5
    model = {"unary": rng.normal(0, 0.7, (FEATURES, labels)), "chain": rng.normal(0, 0.5, (labels, labels)), "skip": np.eye(labels)}
    feats, observed = rng.integers(0, FEATURES, (n, 2)), np.zeros(n, int)
    observed[0] = 1
    link = lambda x: np.array(x, np.int64).reshape(-1, 2)
    got = posteriors(model, feats, link(chains), link(skips), observed)
    assert np.abs(got - _exact_beliefs(model, feats, chains, skips, observed)).max() < near



def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({"score": F.lit(1), "kept": F.lit("x")})
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "bpe":
            assert out.columns == docs.columns
            docs = spark.createDataFrame(out.toArrow())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "pii", "mixing", "bpe"]
    assert out.count() == docs.count() and out.filter("n_tokens is null").count() == 0
    empty = spark.read.parquet(f"{SF}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
