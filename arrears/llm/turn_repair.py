"""Operator 13, conversation structure repair by the auction algorithm for shortest paths.

The edits of a conversation are paths of an integer-cost lattice: node (i, s)
has i rows behind it and s tells what the output so far allows next. Every node
has a price, never above an arc's cost plus the price at its end. A path grows
from its origin over arcs that meet that bound exactly; at a node where none
does the price rises to the least bound and the path contracts by one node. A
path that reaches a node of final price makes its own nodes final. Prices start
at what the rows ahead cost at least, and origins are taken every ``STRIDE``
layers from the end, so that no path contracts far. The tight arcs left by the
final prices hold every cheapest repair; the ASCII-least one is traced over them.

Places come from one range-partitioned sort. A conversation is worked on in
chunks of ``chunk`` rows: where there are several, each gives its least cost
between every two border states, the borders' prices follow from those, and
then all chunks are traced at once from each state that they may be entered in.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrears.llm.common import crc32_sql, ranked
from arrears.session import materialize

CHUNK = 1024
STRIDE = 32
UNREACHABLE = 1 << 40
#: states: nothing yet, after a system turn, after a user turn, after an assistant turn
KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
SPEAK = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
#: cost and edits that end a conversation from each state
END_COST, END_EDITS = (0, 4, 2, 0), ("", "II", "I", "")
LEGAL = ("su", "ua", "au")
_EMPTY = hashlib.sha256(b"").hexdigest()


class Lattice:
    """Prices of the nodes 4 * i + s of some rows; ``exits`` are the final prices behind the last row.

    ``faults`` has one of ``.`` (none), ``b`` (blank), ``d`` (duplicate) and ``t`` (truncated) a row.
    """

    def __init__(self, initials: str, faults: str, exits):
        self.initials, self.faults, n = initials, faults, len(initials)
        ahead, prices = min(exits), []
        for f in reversed(faults):
            ahead += 3 if f in "bd" else f == "t"
            prices.append(ahead)
        self.price = [p for p in reversed(prices) for _ in range(4)] + list(exits)
        self.final = [False] * (4 * n) + [True] * 4
        if min(exits[2:]) >= UNREACHABLE:  # no way back from a user or assistant turn
            for node in range(4 * n):
                if node % 4 > 1:
                    self.price[node], self.final[node] = UNREACHABLE, True
        for i in range((n - 1) // STRIDE * STRIDE, -1, -STRIDE) if n else ():
            for s in range(4):
                self.converge(4 * i + s)

    def arcs(self, node: int):
        """(edit, cost, end) of the arcs of a node, edits in ASCII order."""
        i, s = divmod(node, 4)
        if i == len(self.initials):
            return
        fault = self.faults[i]
        yield "D", 3, node + 4
        yield "I", 2, 4 * i + SPEAK[s]
        if fault not in "bd":
            worse = int(fault == "t")
            kept = KEEP.get((s, self.initials[i]))
            if kept is not None:
                yield "K", worse, 4 * i + 4 + kept
            yield "R", 2 + worse, 4 * i + 4 + SPEAK[s]

    def converge(self, origin: int) -> None:
        """Extend and contract a path from ``origin`` until it reaches a final price."""
        price, final, path = self.price, self.final, [origin]
        while not final[path[-1]]:
            node = path[-1]
            bound, end = min((cost + price[to], to) for _, cost, to in self.arcs(node))
            if price[node] < bound:
                price[node], final[node] = min(bound, UNREACHABLE), bound >= UNREACHABLE
                if len(path) > 1:
                    path.pop()
            else:
                path.append(end)
        for node in path:
            final[node] = True

    def trace(self, state: int) -> tuple[str, int]:
        """ASCII-least cheapest edits from ``state`` and the state behind the last row."""
        node, edits, last = state, [], 4 * len(self.initials)
        while node < last:
            self.converge(node)
            for edit, cost, to in self.arcs(node):
                if self.price[node] == cost + self.price[to]:
                    self.converge(to)  # a price that rises now was not tight
                    if self.price[node] == cost + self.price[to]:
                        edits.append(edit)
                        node = to
                        break
        return "".join(edits), node - last


@lru_cache(maxsize=4096)
def repair_edits(initials: str, faults: str) -> str:
    """ASCII-least cheapest edits of a whole conversation."""
    edits, end = Lattice(initials, faults, END_COST).trace(0)
    return edits + END_EDITS[end]


def edit_cost(edits: str, faults: str) -> int:
    rows = [e for e in edits if e != "I"]
    return sum(3 if e == "D" else 2 * (e == "R") + (f == "t") for e, f in zip(rows, faults)) + 2 * (len(edits) - len(rows))


def edited(edits: str, roles, texts, state: int = 0):
    """(role, text) of the repaired turns."""
    i = 0
    for e in edits:
        if e == "K":
            state = KEEP[state, roles[i][:1]]
            yield roles[i], texts[i]
        elif e != "D":
            state = SPEAK[state]
            yield ROLE[state], "" if e == "I" else texts[i]
        i += e != "I"


def damage(rows: DataFrame) -> DataFrame:
    """Conversation rows with the planted faults: by the crc32 of ``conv_id:turn`` modulo 20 a row is dropped (0), emptied (1),
    loses its ``.!?`` (2), stands twice (3) or becomes the user's (4). Null values read as one space."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")) % 20
    out = rows.select("conv_id", "turn", told("role").alias("role"), told("text").alias("text"), kind.alias("kind")).filter("kind <> 0")
    out = out.withColumn("role", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")))
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    out = out.withColumn("text", text)
    return out.withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("kind", "copy")


def _judged(rows: DataFrame, chunk: int) -> DataFrame:
    """Rows with their place and fault, written: conv, part, pos, n, turn, initial, fault, role, text."""
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    rows = rows.select(conv.alias("conv"), F.col("turn").cast("long").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    placed = ranked(rows, ["conv"], ["turn", "role", "text"], "turns").withColumn("part", F.floor(F.col("pos") / chunk))
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    open_end = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256)
    initial = F.substr("role", F.lit(1), F.lit(1))
    placed = placed.withColumn("initial", F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("x"))).withColumn(
        "fault", F.when(blank, F.lit("b")).when(open_end, F.lit("t")).otherwise(F.lit("."))).withColumn("said", said)
    placed = materialize(placed, "placed-turns")
    # what is said again after its first place; blank rows stay blank
    first = placed.filter("fault <> 'b'").groupBy("conv", "said").agg(F.min("pos").alias("first"), F.count("*").alias("n")).filter("n > 1").select("conv", "said", "first")
    again = placed.filter("fault <> 'b'").select("conv", "said", "pos").join(first, ["conv", "said"]).filter("pos > first").select("conv", "pos", F.lit(True).alias("again"))
    return placed.drop("said").join(materialize(again, "said-again"), ["conv", "pos"], "left").withColumn(
        "fault", F.when(F.col("again"), F.lit("d")).otherwise(F.col("fault"))).drop("again")


def _parts(judged: DataFrame) -> DataFrame:
    """One written row a chunk: initials and faults as strings, and what the sums over a conversation need."""
    rows = judged.groupBy("conv", "part").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "turn", "initial", "fault"))).alias("rows"))
    joined = lambda c: F.array_join(F.transform("rows", lambda r: r[c]), "")
    turns = F.filter(F.transform("rows", lambda r: r["turn"]), lambda t: t.isNotNull())
    rows = rows.select("conv", "part", "n", joined("initial").alias("initials"), joined("fault").alias("faults"), F.array_min(turns).alias("low"),
                       F.array_max(turns).alias("high"), F.size(F.array_distinct(turns)).cast("long").alias("turns"))
    return materialize(rows, "turn-chunks")


_PART = "conv string, part long, entry int, edits string, cost long, illegal long"


def _whole(batches):
    """Edits of conversations of one chunk."""
    for b in batches:
        rows = list(zip(b.column("initials").to_pylist(), b.column("faults").to_pylist()))
        edits = [repair_edits(*r) for r in rows]
        yield _part_rows(b, [0] * len(rows), edits)


def _part_rows(b, entry, edits):
    initials, faults = b.column("initials").to_pylist(), b.column("faults").to_pylist()
    illegal = [sum(s[k: k + 2] not in LEGAL for k in range(len(s) - 1)) for s in initials]
    return pa.record_batch([b.column("conv"), b.column("part"), pa.array(entry, pa.int32()), pa.array(edits, pa.string()),
                            pa.array([edit_cost(e, f) for e, f in zip(edits, faults)], pa.int64()), pa.array(illegal, pa.int64())],
                           names=["conv", "part", "entry", "edits", "cost", "illegal"])


def _chunked(parts: DataFrame) -> DataFrame:
    """Edits of conversations of several chunks, one row a chunk."""
    def costs(batches):
        for b in batches:
            out = []
            for initials, faults in zip(b.column("initials").to_pylist(), b.column("faults").to_pylist()):
                ends = [Lattice(initials, faults, [0 if s == e else UNREACHABLE for s in range(4)]).price[:4] for e in range(4)]
                out.append([ends[e][s] for s in range(4) for e in range(4)])
            yield pa.record_batch([b.column("conv"), b.column("part"), pa.array(out, pa.list_(pa.int64()))], names=["conv", "part", "costs"])

    def borders(table):
        table = table.sort_by("part")
        exits, out = list(END_COST), []
        for c in reversed(table.column("costs").to_pylist()):
            out.append(exits)
            exits = [min(c[4 * s + e] + exits[e] for e in range(4)) for s in range(4)]
        return pa.table({"conv": table.column("conv"), "part": table.column("part"), "exits": pa.array(out[::-1], pa.list_(pa.int64()))})

    def traces(batches):
        for b in batches:
            edits, ends = [], []
            for initials, faults, exits in zip(*(b.column(c).to_pylist() for c in ("initials", "faults", "exits"))):
                lattice = Lattice(initials, faults, exits)
                found = [lattice.trace(s) for s in range(4)]
                edits.append([e for e, _ in found])
                ends.append([s for _, s in found])
            yield pa.record_batch([*[b.column(c) for c in ("conv", "part", "initials", "faults")], pa.array(edits, pa.list_(pa.string())), pa.array(ends, pa.list_(pa.int32()))],
                                  names=["conv", "part", "initials", "faults", "edits", "ends"])

    def entries(table):
        table = table.sort_by("part")
        state, out = 0, []
        for ends in table.column("ends").to_pylist():
            out.append(state)
            state = ends[state]
        last = [None] * (len(out) - 1) + [END_EDITS[state]]
        return pa.table({"conv": table.column("conv"), "part": table.column("part"), "entry": pa.array(out, pa.int32()), "tail": pa.array(last, pa.string())})

    def chosen(batches):
        for b in batches:
            entry = b.column("entry").to_pylist()
            yield _part_rows(b, entry, [e[s] + (t or "") for e, s, t in zip(b.column("edits").to_pylist(), entry, b.column("tail").to_pylist())])

    exits = parts.mapInArrow(costs, "conv string, part long, costs array<long>").groupBy("conv").applyInArrow(borders, "conv string, part long, exits array<long>")
    traced = parts.join(exits, ["conv", "part"]).mapInArrow(traces, "conv string, part long, initials string, faults string, edits array<string>, ends array<int>")
    traced = materialize(traced, "turn-traces")
    entered = traced.select("conv", "part", "ends").groupBy("conv").applyInArrow(entries, "conv string, part long, entry int, tail string")
    return traced.join(entered, ["conv", "part"]).mapInArrow(chosen, _PART)


def repair_conversations(rows: DataFrame, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns): what each conversation needs, and its repaired turns.

    ``rows`` needs conv_id, turn, role and text; other columns are ignored.
    Rows go by turn (nulls first), then role and text. Null roles and texts read
    as one space; rows of a null conv_id are one conversation. The first has a
    row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal,
    cost and audit. The second has a row per chunk of a conversation: conv_id,
    part and lines, the repaired turns in order (``role:text``), not null.

    Repeated rows are duplicates of the first. Very long texts are only hashed,
    matched by two patterns and handed on. Empty table: no rows.
    """
    judged = _judged(rows, chunk)
    parts = _parts(judged)
    solved = parts.filter(F.col("n") <= chunk).select("conv", "part", "initials", "faults").mapInArrow(_whole, _PART)
    solved = materialize(solved.unionByName(_chunked(parts.filter(F.col("n") > chunk).select("conv", "part", "initials", "faults"))), "turn-edits")

    its = parts.join(solved, ["conv", "part"])
    order = Window.partitionBy("conv").orderBy("part")
    border = F.concat(F.lag(F.substr("initials", F.lit(-1), F.lit(1))).over(order), F.substr("initials", F.lit(1), F.lit(1)))
    its = its.withColumn("border", F.coalesce(~border.isin(*LEGAL), F.lit(False)).cast("long")).withColumn(
        "met", F.coalesce(F.lag("high").over(order) == F.col("low"), F.lit(False)).cast("long"))
    count = lambda f: F.sum(F.length(F.regexp_replace("faults", f"[^{f}]", ""))).cast("long")
    gaps = F.coalesce(F.max("high") - F.min("low") + 1 - F.sum(F.col("turns") - F.col("met")), F.lit(0).cast("long"))
    whole = its.groupBy("conv").agg(
        gaps.alias("gaps"), count("b").alias("blank"), count("d").alias("duplicate"), count("t").alias("truncated"),
        F.sum(F.col("illegal") + F.col("border")).alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "edits"))), lambda r: r["edits"]), "").alias("audit"))

    def lines(batches):
        for b in batches:
            out = []
            for entry, edits, said in zip(*(b.column(c).to_pylist() for c in ("entry", "edits", "said"))):
                roles, texts = [r["role"] for r in said], [r["text"] for r in said]
                out.append([f"{r}:{t}" for r, t in edited(edits, roles, texts, entry)])
            yield pa.record_batch([b.column("conv"), b.column("part"), pa.array(out, pa.list_(pa.string()))], names=["conv", "part", "lines"])

    texts = judged.groupBy("conv", "part").agg(F.sort_array(F.collect_list(F.struct("pos", "role", "text"))).alias("said"))
    turns = texts.join(solved.select("conv", "part", "entry", "edits"), ["conv", "part"]).mapInArrow(lines, "conv string, part long, lines array<string>")
    conv_id = F.expr("IF(conv = '', NULL, CAST(conv AS BIGINT))").alias("conv_id")
    return (whole.select(conv_id, *whole.columns[1:]), turns.select(conv_id, "part", "lines"))


def turns_digest(turns: DataFrame) -> DataFrame:
    """conv_id and sha256 of the newline-joined turns; chunks of a conversation stream through one hash."""
    def run(batches):
        conv, state, some = None, None, False
        for b in batches:
            done = []
            for c, lines in zip(b.column("conv_id").to_pylist(), b.column("lines").to_pylist()):
                if state is None or c != conv:
                    if state is not None:
                        done.append((conv, state.hexdigest()))
                    conv, state, some = c, hashlib.sha256(), False
                if lines:
                    state.update(("\n" * some + "\n".join(lines)).encode())
                    some = True
            yield pa.record_batch([pa.array([x for x, _ in done], pa.int64()), pa.array([x for _, x in done], pa.string())], names=["conv_id", "repaired_sha256"])
        if state is not None:
            yield pa.record_batch([pa.array([conv], pa.int64()), pa.array([state.hexdigest()], pa.string())], names=["conv_id", "repaired_sha256"])

    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(run, "conv_id long, repaired_sha256 string")


def op13_turn_repair(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    whole, turns = repair_conversations(damage(rows))
    found = whole.join(turns_digest(turns).withColumnRenamed("conv_id", "its"), F.col("conv_id").eqNullSafe(F.col("its"))).drop("its")
    found = found.withColumnRenamed("conv_id", "its")
    every = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    zero = {c: 0 for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("its")), "left").drop("its").fillna(zero | {"audit": "", "repaired_sha256": _EMPTY})


def _step_sql() -> str:
    """One row's step of the cheapest edits by state; a value is eight digits of cost, then the edits, so the least text is the answer."""
    add = lambda v, cost, edits: f"lpad(CAST(CAST(left({v}, 8) AS BIGINT) + {cost} AS VARCHAR), 8, '0') || substr({v}, 9) || '{edits}'"
    spoken = f"""SELECT *, s0 AS i0, s1 AS i1, least(s2, {add("s0", 2, "I")}, {add("s1", 2, "I")}, {add("s3", 2, "I")}) AS i2,
        least(s3, {add("s2", 2, "I")}, {add("s0", 4, "II")}, {add("s1", 4, "II")}) AS i3 FROM here"""
    cut = lambda v: f"CASE WHEN fault IN ('b', 'd') THEN NULL ELSE {v} END"
    worse = "(fault = 't')::INT"
    keep = lambda v, role: cut(f"CASE WHEN initial = '{role}' THEN {add(v, worse, 'K')} END")
    rerole = lambda v: cut(add(v, f"2 + {worse}", "R"))
    gone = lambda v: add(v, 3, "D")
    users = ", ".join(f"{keep(v, 'u')}, {rerole(v)}" for v in ("i0", "i1", "i3"))
    return f"""SELECT conv_id, pos, {gone("i0")} AS s0, least({gone("i1")}, {keep("i0", "s")}) AS s1,
        least({gone("i2")}, {users}) AS s2, least({gone("i3")}, {keep("i2", "a")}, {rerole("i2")}) AS s3
      FROM ({spoken}) x"""


_FAR = "99000000"
OP13_SQL = f"""
WITH RECURSIVE raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind FROM conversations),
dam AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM raw WHERE kind <> 0),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos FROM dam),
f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'b'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'd'
    WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 't' ELSE '.' END AS fault,
    CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'x' END AS initial,
    lag(role) OVER (PARTITION BY conv_id ORDER BY pos) AS before FROM r),
dp AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS pos, '00000000' AS s0, '{_FAR}' AS s1, '{_FAR}' AS s2, '{_FAR}' AS s3 FROM f
  UNION ALL SELECT * FROM (WITH here AS (SELECT dp.s0, dp.s1, dp.s2, dp.s3, f.conv_id, f.pos, f.fault, f.initial
      FROM dp JOIN f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.pos = dp.pos + 1) {_step_sql()}) y),
ends AS (SELECT conv_id, least(s0, s3, lpad(CAST(CAST(left(s2, 8) AS BIGINT) + 2 AS VARCHAR), 8, '0') || substr(s2, 9) || 'I',
    lpad(CAST(CAST(left(s1, 8) AS BIGINT) + 4 AS VARCHAR), 8, '0') || substr(s1, 9) || 'II') AS best
  FROM dp QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY pos DESC) = 1),
e AS (SELECT conv_id, CAST(left(best, 8) AS BIGINT) AS cost, substr(best, 9) AS audit FROM ends),
l AS (SELECT conv_id, k, edit, sum(edit <> 'I') OVER w AS pos, sum(edit <> 'D') OVER w AS nth FROM (
    SELECT conv_id, unnest(string_split(audit, '')) AS edit, unnest(range(len(audit))) AS k FROM e WHERE audit <> '') WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
o AS (SELECT l.conv_id, l.k, l.edit, l.nth, f.role, f.text, f.initial FROM l LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.pos = l.pos AND l.edit <> 'I' WHERE l.edit <> 'D'),
s AS (SELECT conv_id, max((nth = 1 AND edit = 'K' AND initial = 's')::INT) AS sys FROM o GROUP BY conv_id),
t AS (SELECT o.conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (nth - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
    CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY k)) AS repaired_sha256 FROM o JOIN s ON s.conv_id IS NOT DISTINCT FROM o.conv_id GROUP BY o.conv_id),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (before IS NOT NULL AND left(before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
"""
