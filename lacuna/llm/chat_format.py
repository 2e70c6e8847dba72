r"""Chat formatting by schema fingerprints, with DataFrame functions only.

A record is a variant value of any layout. The hash of its nested field paths (types left out) selects a declarative
mapping to canonical turns, an array of (role, text). Turns of one conversation are then written with a template

    ### role
    text</turn>

Inside roles and texts \ becomes \b, < becomes \l, # becomes \h (and a line end in a role \n), so no control string can
occur there, and plain replacements in the opposite order restore the input.

Defined cases: null texts and roles are empty; turns are ordered by turn, then role and text (null turns first), so ties
and repeated rows give one defined order and each row is a turn; rows without a conv_id belong to no conversation;
a record of unknown layout has no turns and the layout null; other columns are ignored; an empty table gives
conversation -7 only. A conversation is one output value, so its turns meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "</turn>\n"
_TURNS = "array<struct<role:string,text:string>>"
#: layout name, nested field paths as ``shape`` writes them, and the SQL that maps a variant ``v`` to turns.
LAYOUTS = (
    ("row", "OBJECT<role, text, turn>", "array(struct(try_variant_get(v, '$.role', 'string') AS role, try_variant_get(v, '$.text', 'string') AS text))"),
    ("messages", "OBJECT<messages: ARRAY<OBJECT<content, role>>>", "transform(try_variant_get(v, '$.messages', 'array<struct<role:string,content:string>>'), x -> struct(x.role AS role, x.content AS text))"),
    ("from_value", "OBJECT<conversations: ARRAY<OBJECT<from, value>>>", "transform(try_variant_get(v, '$.conversations', 'array<struct<from:string,value:string>>'), x -> struct(CASE x.from WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' ELSE x.from END AS role, x.value AS text))"),
    ("prompt_response", "OBJECT<prompt, response>", "array(struct('user' AS role, try_variant_get(v, '$.prompt', 'string') AS text), struct('assistant' AS role, try_variant_get(v, '$.response', 'string') AS text))"),
    ("prompt_completion", "OBJECT<completion, prompt>", "array(struct('user' AS role, try_variant_get(v, '$.prompt', 'string') AS text), struct('assistant' AS role, try_variant_get(v, '$.completion', 'string') AS text))"),
    ("instruction", "OBJECT<instruction, output>", "array(struct('user' AS role, try_variant_get(v, '$.instruction', 'string') AS text), struct('assistant' AS role, try_variant_get(v, '$.output', 'string') AS text))"),
    ("instruction_input", "OBJECT<input, instruction, output>", "array(struct('user' AS role, concat_ws('\\n\\n', try_variant_get(v, '$.instruction', 'string'), nullif(try_variant_get(v, '$.input', 'string'), '')) AS text), struct('assistant' AS role, try_variant_get(v, '$.output', 'string') AS text))"),
)


def shape(v: Column) -> Column:
    """Nested field paths of a variant: its schema without the scalar types."""
    return F.regexp_replace(F.schema_of_variant(v), r": (?!OBJECT<|ARRAY<)[A-Z_]+(\([0-9, ]*\))?", "")


def canonical_turns(records: DataFrame, payload: str = "v") -> DataFrame:
    """records with ``layout`` and ``turns`` for the variant column ``payload``, in place of that column."""
    rest = [F.col(f"`{c}`") for c in records.columns if c != payload]
    found = records.select(*rest, F.col(f"`{payload}`").alias("v")).withColumn("fingerprint", F.xxhash64(shape(F.col("v"))))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(_TURNS)
    for name, paths, mapping in LAYOUTS:
        same = F.col("fingerprint") == F.xxhash64(F.lit(paths))
        layout, turns = F.when(same, F.lit(name)).otherwise(layout), F.when(same, F.expr(mapping).cast(_TURNS)).otherwise(turns)
    return found.select(*rest, layout.alias("layout"), turns.alias("turns"))


def escaped(c: Column, role: bool = False) -> Column:
    for a, b in (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"), *([("\n", "\\n")] if role else [])):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def restored(c: Column, role: bool = False) -> Column:
    for a, b in ((("\n", "\\n"),) if role else ()) + (("#", "\\h"), ("<", "\\l"), ("\\", "\\b")):
        c = F.replace(c, F.lit(b), F.lit(a))
    return c


def written(role: Column, text: Column) -> Column:
    return F.concat(F.lit("### "), escaped(role, True), F.lit("\n"), escaped(text), F.lit(END))


def read_back(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation."""
    parts = F.split(formatted, END, -1)
    head = lambda p: F.substring_index(p, "\n", 1)
    return F.transform(
        F.slice(parts, F.lit(1), F.size(parts) - 1),
        lambda p: F.struct(restored(F.substr(head(p), F.lit(5)), True).alias("role"), restored(F.substr(p, F.length(head(p)) + 2)).alias("text")),
    )


def format_conversations(rows: DataFrame) -> DataFrame:
    """conv_id and formatted text of conversations that come as rows of conv_id, turn, role and text."""
    records = rows.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), F.to_variant_object(F.struct("role", "text", "turn")).alias("v"))
    turns = canonical_turns(records).select("conv_id", "turn", F.posexplode("turns").alias("place", "t"))
    turns = turns.select("conv_id", "turn", "place", F.coalesce("t.role", F.lit("")).alias("role"), F.coalesce("t.text", F.lit("")).alias("text"))
    pieces = turns.select("conv_id", F.struct("turn", "place", "role", "text").alias("turn_of"))
    gathered = pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn_of")).alias("turns"))
    return gathered.select("conv_id", F.array_join(F.transform("turns", lambda t: written(t["role"], t["text"])), "").alias("formatted"))


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted texts say when read back: turns, loss-masked text (assistant turns), lengths."""
    back = formatted.select("conv_id", "formatted", read_back(F.col("formatted")).alias("turns"))
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == "assistant"), lambda t: t["text"]), "")
    every = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(every, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
