"""Operator 4, chat formatting: schema fingerprints select a declarative mapping to canonical turns.

Records of many layouts share one wide table (as ``spark.read.json`` makes it):
each row fills the fields of its own layout. The row's *fingerprint* is a hash
of the sorted paths of the fields it fills; every layout declares its paths and
how they become turns, and the fingerprint picks the layout. Only DataFrame
functions are used, all inside one projection.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn. Inside role and text
``&`` becomes ``&amp;`` and ``<|`` becomes ``&lt;|`` (in roles also a line
break ``&nl;``), so no control string of the template can come from the data
and the original is read back exactly.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import chain, combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
PROBE = "<|im_end|><|im_start|>assistant ok"
_TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """``each`` = (array, role field, text field) or ``turns`` = (role, path) in order; paths in ``optional`` may be missing."""

    name: str
    each: tuple[str, str, str] | None = None
    turns: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()
    aliases: dict = field(default_factory=dict, hash=False)

    def paths(self) -> list[str]:
        if self.each:
            a, r, t = self.each
            return [f"{a}[].{r}", f"{a}[].{t}"]
        return [p for _, p in self.turns]

    def fingerprints(self) -> list[str]:
        """Every path list that the layout answers to."""
        drop = chain.from_iterable(combinations(self.optional, n) for n in range(len(self.optional) + 1))
        return ["\n".join(sorted(set(self.paths()) - set(d))) for d in drop]


LAYOUTS = [
    Layout("messages", each=("messages", "role", "content")),
    Layout("from_value", each=("conversations", "from", "value"), aliases={"human": "user", "gpt": "assistant", "bot": "assistant"}),
    Layout("prompt_response", turns=(("system", "system"), ("user", "prompt"), ("assistant", "response")), optional=("system",)),
    Layout("prompt_completion", turns=(("user", "prompt"), ("assistant", "completion"))),
    Layout("instruction", turns=(("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output")), optional=("system", "input")),
    Layout("question_answer", turns=(("user", "question"), ("assistant", "answer"))),
    Layout("nested", turns=(("user", "data.prompt"), ("assistant", "data.response"))),
]


def field_paths(schema: T.StructType, skip=(), prefix: str = "") -> list[tuple[str, Column]]:
    """(path, is it filled) of every leaf; ``a[].b`` is field b of the structs of array a."""
    found = []
    for f in schema.fields:
        name = f"{prefix}{f.name}"
        if not prefix and f.name in skip:
            continue
        if isinstance(f.dataType, T.StructType):
            found += field_paths(f.dataType, prefix=f"{name}.")
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
            found += [(f"{name}[].{g.name}", _at(name).isNotNull()) for g in f.dataType.elementType.fields]
        else:
            found.append((name, _at(name).isNotNull()))
    return found


def _at(path: str) -> Column:
    return F.col(".".join(f"`{p}`" for p in path.split(".")))


def fingerprint(paths: list[tuple[str, Column]]) -> Column:
    """Hash of the sorted paths that the row fills."""
    return F.xxhash64(F.concat_ws("\n", *[F.when(there, F.lit(p)) for p, there in sorted(paths, key=lambda x: x[0])]))


def _layout_turns(layout: Layout) -> Column:
    if layout.each:
        a, r, t = layout.each

        def one(m):
            role = F.coalesce(m[r].cast("string"), F.lit(""))
            for was, now in layout.aliases.items():
                role = F.when(role == was, now).otherwise(role)
            return F.struct(role.alias("role"), F.coalesce(m[t].cast("string"), F.lit("")).alias("text"))

        return F.transform(_at(a), one).cast(_TURNS)
    return None


def canonical_turns(records: DataFrame, keys, layouts=None) -> DataFrame:
    """``keys``, layout (name) and turns (role, text) of every record.

    All columns but ``keys`` take part in the fingerprint. A record that no
    layout answers to (unknown, missing or extra fields) keeps its row with
    layout and turns null. Null roles and texts inside arrays are empty; a null
    array element is an empty turn.
    """
    layouts = LAYOUTS if layouts is None else layouts
    paths = field_paths(records.schema, skip=set(keys))
    have = {p for p, _ in paths}
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(_TURNS)
    for layout in layouts:
        for listed in layout.fingerprints():
            filled = set(listed.split("\n"))
            if not filled <= have:
                continue
            hit = F.col("_fingerprint") == F.xxhash64(F.lit(listed))
            made = _layout_turns(layout)
            if made is None:
                made = F.array(*[F.struct(F.lit(r).alias("role"), _at(p).cast("string").alias("text")) for r, p in layout.turns if p in filled]).cast(_TURNS)
            name, turns = F.when(hit, F.lit(layout.name)).otherwise(name), F.when(hit, made).otherwise(turns)
    return records.withColumn("_fingerprint", fingerprint(paths) if paths else F.lit(0).cast("long")).select(
        *keys, name.alias("layout"), turns.alias("turns"))


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def format_chats(records: DataFrame, keys, layouts=None, learn_role: str = "assistant") -> DataFrame:
    """``keys``, layout, formatted (the templated text) and loss: code-point ranges [start, end) of the texts to learn from.

    One row per record. Texts of ``learn_role`` are under the loss mask, without
    the template around them; they stand escaped in ``formatted``. Records
    without a layout have null formatted and loss; records without turns have
    an empty text and no ranges. Empty table: no rows.
    """
    turns = canonical_turns(records, keys, layouts)

    def parts(t):
        role = F.replace(escape(F.coalesce(t["role"], F.lit(""))), F.lit("\n"), F.lit("&nl;"))
        return F.struct(F.concat(F.lit(START), role, F.lit("\n")).alias("head"), escape(F.coalesce(t["text"], F.lit(""))).alias("body"),
                        (t["role"] == learn_role).alias("learn"))

    made = turns.withColumn("_parts", F.transform("turns", parts))
    tail = F.lit(f"{END}\n")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def step(acc, p):
        lo = acc["at"] + F.length(p["head"])
        hi = lo + F.length(p["body"])
        span = F.array(F.struct(lo.cast("long").alias("start"), hi.cast("long").alias("end")))
        return F.struct((hi + F.length(tail)).cast("long").alias("at"),
                        F.when(p["learn"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return made.select(*keys, "layout",
                       F.array_join(F.transform("_parts", lambda p: F.concat(p["head"], p["body"], tail)), "").alias("formatted"),
                       F.aggregate("_parts", start, step, lambda a: a["spans"]).alias("loss"))


def parse_formatted(formatted: Column) -> Column:
    """The turns (role, text) that a formatted text holds, unescaped."""
    pieces = F.split(formatted, r"<\|im_end\|>\n", -1)

    def turn(p):
        inner = F.substring(p, F.lit(len(START) + 1), F.length(p))
        cut = F.locate("\n", inner)
        role = unescape(F.replace(F.substring(inner, F.lit(1), cut - 1), F.lit("&nl;"), F.lit("\n")))
        return F.struct(role.alias("role"), unescape(F.substring(inner, cut + 1, F.length(inner))).alias("text"))

    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def records_from_rows(rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """One record of the messages layout per conversation from rows of (key, turn, role, text).

    Turns are ordered by turn (null first), equal ones by role, then text; null
    roles and texts are empty. Null keys are one conversation.
    """
    turn = F.struct("turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("content"))
    return rows.groupBy(key).agg(F.sort_array(F.collect_list(turn)).alias("m")).select(
        key, F.transform("m", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"))


def op4_chat(spark, sf_dir: str) -> DataFrame:
    rows = records_from_rows(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text"))
    probe = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.lit(PROBE).alias("prompt"), F.lit(PROBE).alias("response"))
    out = format_chats(rows.unionByName(probe, allowMissingColumns=True), ["conv_id"])
    turns = parse_formatted(F.col("formatted"))
    learned = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return out.select("conv_id", "formatted", turns.alias("turns"), F.array_join(learned, "").alias("learned")).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


_ESC = "replace(replace({}, '&', '&amp;'), '<|', '&lt;|')"
OP4_SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}')
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum({len(START) + len(END) + 2} + length(replace({_ESC.format('role')}, chr(10), '&nl;')) + length({_ESC.format('text')})) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""
