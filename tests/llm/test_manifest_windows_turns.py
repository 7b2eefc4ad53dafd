"""Merkle manifest, substring dedup and conversation repair against brute-force versions."""

import hashlib
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from arrears.llm.merkle import document_leaves, merkle_manifest, op11_merkle
from arrears.llm.superkmer import Words, equal_windows, op12_substring_dedup, slices, substring_dedup
from arrears.llm.turn_repair import Lattice, damage, edit_cost, edited, op13_turn_repair, repair_conversations, repair_edits, turns_digest

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def clashing(df):
    names = ("grp", "node", "pos", "n", "rows", "path", "block", "tag", "first", "last", "ranges", "bucket", "salt", "part", "fault", "said", "kind")
    return df.withColumns({c: F.lit("x") for c in names})


def proofs(df, **sizes):
    out = merkle_manifest(document_leaves(df), **sizes)
    told = F.array_join(F.transform("proof", lambda s: F.concat(s["left"], s["right"])), "")
    return sorted(map(tuple, out.select("id", "leaf", "subroot", "root", F.sha2(told.cast("binary"), 256), "folded_root",
                                        F.col("folded_root") == F.col("root")).collect()), key=str)


def test_op11_brute_force(spark):
    rows = list(map(tuple, spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()))
    assert sorted(map(tuple, op11_merkle(spark, SF).collect()), key=str) == brute.merkle(rows)


def test_op11_many_rounds_nulls_ties(spark):
    pick = random.Random(3)
    rows = [(i if i % 50 else None, pick.choice([None, "", "Abc", "É" * 3, "X" * 30_000]), pick.choice([None, "", "de", "é", *map(str, range(12))]), pick.choice([None, "s"]), i)
            for i in range(500)] + [(7, "A", "de", "s", 1)] * 3
    df = clashing(spark.createDataFrame(rows, DOC).repartition(5))
    assert proofs(df, levels=1) == proofs(df, levels=3) == brute.merkle(rows)
    one = [(5, "A b", None, None, None)]
    assert proofs(spark.createDataFrame(one, DOC)) == brute.merkle(one)
    assert proofs(df.filter("false")) == []


@pytest.fixture(scope="module")
def hard_texts():
    pick = random.Random(5)
    vocabulary = ["a", "b", "c", "é", "漢字", "dd", "x1"]
    common = [pick.choice(vocabulary) for _ in range(12)]
    rows = []
    for i in range(300):
        words = [pick.choice([*vocabulary, f"u{i}"]) for _ in range(pick.choice([0, 3, 8, 30, 60]))]
        if i % 3 == 0:  # one passage in a third of the texts
            at = pick.randrange(len(words) + 1)
            words[at:at] = common
        rows.append((pick.choice([i, i, i, None, 7, -i]), pick.choice([" ", "  ", "\n"]).join(words) if i % 41 else None))
    rows += rows[10:20] + [(3000 + i, rows[30][1]) for i in range(50)]
    return rows + [(9000, " ".join(pick.choice(vocabulary) for _ in range(4000))), (9001, "a " * 3000), (9002, "z" * 5000 + " q" * 40), (9003, " " * 9000 + "a b c d e")]


@pytest.mark.parametrize("window, gram, bucket, block", [(8, 4, 4000, 700), (8, 1, 2000, 300), (20, 5, 2 << 20, 4 << 20), (6, 3, 500, 50)])
def test_op12_brute_force(spark, hard_texts, window, gram, bucket, block):
    df = clashing(spark.createDataFrame(hard_texts, "doc_id long, text string").repartition(5))
    got = substring_dedup(df, window, gram, bucket, block).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got), key=str) == brute.windows_dedup(hard_texts, window)
    assert all(sum(x["last"] - x["first"] for x in r["removed"]) == r["n_removed"] for r in got)
    assert all(a["last"] < b["first"] for r in got for a, b in zip(r["removed"], r["removed"][1:]))


def test_op12_tables(spark, hard_texts):
    rows = list(map(tuple, spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()))
    want = [(d, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for d, n, gone, kept in brute.windows_dedup(rows, 20)]
    assert sorted(map(tuple, op12_substring_dedup(spark, SF).collect()), key=str) == sorted(want, key=str)
    assert substring_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_op12_one_hash_for_different_words(monkeypatch):
    import arrears.llm.superkmer as m

    monkeypatch.setattr(m, "_rolled", lambda words, length, step: np.zeros(max(len(words) - length + 1, 0), np.uint64))
    text = b"a b c d a b c e a b c d"
    words = Words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    at = words.windows(3)
    wins = [tuple(text.split()[i: i + 3]) for i in at]
    assert list(equal_windows(words, at, 3)) == [wins.index(w) for w in wins]


def test_op12_slices_share_a_window_less_one_word():
    text = b"  " + b" ".join(b"w%d" % i for i in range(400)) + b" " + b"z" * 300 + b" end"
    found = []
    for part, first in slices(np.frombuffer(text, np.uint8), 60, 3):
        words = part.tobytes().split()
        found += [(first + i, tuple(words[i: i + 4])) for i in range(len(words) - 3)]
    words = text.split()
    assert dict(found) == {i: tuple(words[i: i + 4]) for i in range(len(words) - 3)}


def test_op13_auction_finds_the_least_edits():
    pick = random.Random(7)
    for _ in range(3000):
        n = pick.randrange(0, 12)
        initials, faults = ("".join(pick.choice(of) for _ in range(n)) for of in ("suax", "....btd"))
        edits = repair_edits(initials, faults)
        assert (edit_cost(edits, faults), edits) == brute.turn_edits(initials, faults)
        roles = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
        said = [r for r, _ in edited(edits, [roles[c] for c in initials], [""] * n)]
        heard = said[1:] if said[:1] == ["system"] else said
        assert heard == ["user", "assistant"] * (len(heard) // 2) and (not said or heard)


def test_op13_prices_are_distances_and_stay_below_every_arc():
    initials, faults = "suauxxauusa" * 9, "..t.bd....t" * 9
    lattice = Lattice(initials, faults, (0, 4, 2, 0))
    for node in range(4 * len(initials)):
        assert all(lattice.price[node] <= cost + lattice.price[to] for _, cost, to in lattice.arcs(node))
    assert lattice.price[0] == brute.turn_edits(initials, faults)[0]


def turns_of(rows, by):
    """Rows of one conversation after sorting, with their faults."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), ""
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        faults += "b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "."
        seen.add((role, text))
    return rows, faults


@pytest.mark.parametrize("chunk", [3, 1024])
def test_op13_chunks_nulls_ties(spark, chunk):
    pick = random.Random(11)
    rows = [(pick.choice([None, 1, 2, 3, 3, 3, *range(10, 40)]), pick.choice([None, *range(60)]), pick.choice([None, "", "system", "user", "user", "assistant", "assistant", "tool"]),
             pick.choice([None, "", " \n", "a.", "b!", "c", "d? ", "e" * 20_000 + ".", "f\n."])) for _ in range(500)]
    df = clashing(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4))
    whole, turns = repair_conversations(df, chunk)
    got = {r["conv_id"]: r.asDict() for r in whole.collect()}
    digest = dict(map(tuple, turns_digest(turns).collect()))
    for conv in {r[0] for r in rows}:
        mine, faults = turns_of([(t, " " if a is None else a, " " if b is None else b) for c, t, a, b in rows if c == conv], conv)
        initials = "".join(r[1][:1] if r[1][:1] in ("s", "u", "a") else "x" for r in mine)
        cost, audit = brute.turn_edits(initials, faults)
        told = sorted({r[0] for r in mine if r[0] is not None})
        want = {"conv_id": conv, "gaps": told[-1] - told[0] + 1 - len(told) if told else 0, "blank": faults.count("b"), "duplicate": faults.count("d"),
                "truncated": faults.count("t"), "illegal": sum(initials[k: k + 2] not in ("su", "ua", "au") for k in range(len(mine) - 1)), "cost": cost, "audit": audit}
        assert got[conv] == want
        lines = "\n".join(f"{a}:{b}" for a, b in edited(audit, [r[1] for r in mine], [r[2] for r in mine]))
        assert digest[conv] == hashlib.sha256(lines.encode()).hexdigest()
    assert repair_conversations(df.filter("false"), chunk)[0].count() == 0


def test_op13_dropped_conversations_and_empty_tables(spark, tmp_path):
    schema = "conv_id long, turn long, role string, text string"
    kind = F.crc32(F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string")).cast("binary")) % 20
    rows = spark.createDataFrame([(i, 0, "user", "a.") for i in range(200)] + [(None, None, None, None)], schema)
    rows.coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    out = {r["conv_id"]: r for r in op13_turn_repair(spark, str(tmp_path)).collect()}
    gone = [r["conv_id"] for r in rows.filter(kind == 0).collect()]
    assert gone and len(out) == 201
    assert all((out[c]["cost"], out[c]["audit"], out[c]["repaired_sha256"]) == (0, "", hashlib.sha256(b"").hexdigest()) for c in gone)
    assert damage(rows.filter("false")).count() == 0
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none/conversations.parquet")
    assert op13_turn_repair(spark, f"{tmp_path}/none").count() == 0
