"""Chat formatting: records of many layouts become canonical turns, then one marked-up text.

A record's fingerprint is the hash of its nested field paths (the schema of its JSON value without the
leaf types and without fields in ``IGNORED``). It selects one of the declarative mappings in ``LAYOUTS``, which say
where roles and texts are found. Records of no known layout come back with a null layout and no turns.

The text: ``<turn ROLE>TEXT</turn>`` and a line end per turn. Inside roles and texts the three characters
of the marks are written as escapes, so no text can end its turn or open another, and reading back is exact.

Everything is built-in functions: no Python runs per row. Defined cases: null texts and roles are empty;
turns come in the order of (turn, role, text); a record that is null, empty or no JSON has a null layout.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulyard.llm.frames import col, others

# fixed values: escapes, and the stand-ins used while reading back (they cannot occur in escaped text)
ESCAPES = [("\\", "\\\\"), ("<", "\\l"), (">", "\\g")]
STAND_INS = [("\\\\", "<b"), ("\\l", "<l"), ("\\g", "<g"), ("<b", "\\"), ("<g", ">"), ("<l", "<")]
END = "</turn>\n"
TRAINED = "assistant"
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "chatbot": "assistant"}
IGNORED = ("id", "conv_id", "source", "lang", "meta")

# (layout, example of its fields, rule): a rule is either a list of (role, path of the text) in order, or
# (path of the messages, name of the role field, name of the text field)
LAYOUTS: list[tuple[str, str, object]] = [
    ("prompt_completion", '{"prompt":"","completion":""}', [("user", "prompt"), ("assistant", "completion")]),
    ("prompt_response", '{"prompt":"","response":""}', [("user", "prompt"), ("assistant", "response")]),
    ("question_answer", '{"question":"","answer":""}', [("user", "question"), ("assistant", "answer")]),
    ("instruction", '{"instruction":"","output":""}', [("user", "instruction"), ("assistant", "output")]),
    ("instruction_input", '{"instruction":"","input":"","output":""}', [("system", "instruction"), ("user", "input"), ("assistant", "output")]),
    ("system_prompt", '{"system":"","prompt":"","response":""}', [("system", "system"), ("user", "prompt"), ("assistant", "response")]),
    ("messages", '{"messages":[{"role":"","content":""}]}', ("messages", "role", "content")),
    ("conversations", '{"conversations":[{"from":"","value":""}]}', ("conversations", "from", "value")),
    ("turns", '{"turns":[{"turn":0,"role":"","text":""}]}', ("turns", "role", "text")),
    ("dialog", '{"data":{"dialog":[{"speaker":"","text":""}]}}', ("data.dialog", "speaker", "text")),
]
RESULTS = ("fingerprint", "layout", "segments", "formatted")
TURNS = "array<struct<role:string,text:string>>"


def paths(value: Column) -> Column:
    """The nested field paths of a VARIANT as text: its schema without leaf types."""
    shape = F.regexp_replace(F.schema_of_variant(value), r"\b(?:STRING|BIGINT|DOUBLE|FLOAT|BOOLEAN|VOID|VARIANT|DATE|TIMESTAMP|TIMESTAMP_NTZ|BINARY|DECIMAL\(\d+,\d+\))(?=[,>]|$)", "_")
    for name in IGNORED:
        shape = F.regexp_replace(shape, rf"(?<=<)`?{name}`?: _, |, `?{name}`?: _(?=[,>])", "")
    return shape


def paths_of(kind: T.DataType) -> str:
    """The same text for a typed column."""
    if isinstance(kind, T.ArrayType):
        return f"ARRAY<{paths_of(kind.elementType)}>"
    if isinstance(kind, T.StructType):
        inner = (f"{f.name}: {paths_of(f.dataType)}" for f in sorted(kind, key=lambda f: f.name) if f.name not in IGNORED or isinstance(f.dataType, (T.StructType, T.ArrayType)))
        return f"OBJECT<{', '.join(inner)}>"
    return "_"


def paths_of_example(value) -> str:
    """The same text for a value read by the json module."""
    if isinstance(value, list):
        return f"ARRAY<{paths_of_example(value[0])}>"
    if isinstance(value, dict):
        return f"OBJECT<{', '.join(f'{k}: {paths_of_example(v)}' for k, v in sorted(value.items()))}>"
    return "_"


def digits(shape: str) -> str:
    """The fingerprint of a text of field paths: the first 16 hexadecimal digits of its hash."""
    return hashlib.sha256(shape.encode()).hexdigest()[:16]


def fingerprint(value: Column) -> Column:
    return F.substring(F.sha2(paths(value), 256), 1, 16)


PRINTS = {digits(paths_of_example(json.loads(example))): (name, rule) for name, example, rule in LAYOUTS}


def _variant_turns(record: Column, rule) -> Column:
    """The turns of a VARIANT as the mapping says."""
    if isinstance(rule, list):
        return F.array(*[F.struct(F.lit(role).alias("role"), F.try_variant_get(record, f"$.{path}", "string").alias("text")) for role, path in rule])
    path, role, text = rule
    items = F.try_variant_get(record, f"$.{path}", f"array<struct<`{role}`:string,`{text}`:string>>")
    return F.transform(items, lambda m: F.struct(m[role].alias("role"), m[text].alias("text")))


def _struct_turns(record: Column, rule) -> Column:
    """The turns of a struct as the mapping says."""

    def field(value: Column, path: str) -> Column:
        for name in path.split("."):
            value = value[name]
        return value

    if isinstance(rule, list):
        return F.array(*[F.struct(F.lit(role).alias("role"), field(record, path).cast("string").alias("text")) for role, path in rule])
    path, role, text = rule
    return F.transform(field(record, path), lambda m: F.struct(m[role].cast("string").alias("role"), m[text].cast("string").alias("text")))


def tidy(turns: Column) -> Column:
    """Canonical role names; nulls as empty texts."""
    known = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])

    def one(turn: Column) -> Column:
        role = F.coalesce(turn["role"], F.lit(""))
        return F.struct(F.coalesce(F.try_element_at(known, role), role).alias("role"), F.coalesce(turn["text"], F.lit("")).alias("text"))

    return F.transform(turns, one)


def escape(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for written, plain in STAND_INS:
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def segments(turns: Column, trained: str = TRAINED) -> Column:
    """The formatted text in pieces, each with its place in the loss mask: marks never, texts of ``trained`` always."""

    def pieces(turn: Column) -> Column:
        return F.array(
            F.struct(F.concat(F.lit("<turn "), escape(turn["role"]), F.lit(">")).alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(turn["text"]).alias("text"), (turn["role"] == trained).alias("loss")),
            F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")),
        )

    return F.flatten(F.transform(turns, pieces))


def _formatted(out: DataFrame) -> DataFrame:
    out = out.withColumn("segments", segments(tidy(F.col("_turns"))))
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), "")).drop("_value", "_turns")


def format_records(df: DataFrame, record: str = "record") -> DataFrame:
    """``df`` without the JSON text column ``record``, with fingerprint, layout, segments and formatted.

    Every row has its own layout. A record must fit in a VARIANT (16 MB); longer ones belong in typed columns.
    """
    out = df.select(*[col(c) for c in others(df, [*RESULTS, record])], F.try_parse_json(col(record)).alias("_value"))
    out = out.withColumn("fingerprint", fingerprint(F.col("_value")))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for print_, (name, rule) in PRINTS.items():
        same = F.col("fingerprint") == print_
        layout, turns = F.when(same, F.lit(name)).otherwise(layout), F.when(same, _variant_turns(F.col("_value"), rule)).otherwise(turns)
    return _formatted(out.withColumns({"layout": layout, "_turns": turns}))


def format_structs(df: DataFrame, record: str = "record") -> DataFrame:
    """The same for a typed column, whose rows share one layout and may be of any length."""
    print_ = digits(paths_of(df.schema[record].dataType))
    name, rule = PRINTS.get(print_, (None, None))
    turns = _struct_turns(F.col("_value"), rule) if rule else F.lit(None).cast(TURNS)
    out = df.select(*[col(c) for c in others(df, [*RESULTS, record])], col(record).alias("_value"))
    out = out.withColumns({"fingerprint": F.lit(print_), "layout": F.lit(name).cast("string"), "_turns": turns})
    return _formatted(out)


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text."""
    ended = F.split(formatted, END)
    whole = F.slice(ended, F.lit(1), F.greatest(F.size(ended) - 1, F.lit(0)))

    def turn(piece: Column) -> Column:
        at = F.locate(">", piece)
        role = F.substring(piece, F.lit(7), at - 7)
        return F.struct(unescape(role).alias("role"), unescape(F.substring(piece, at + 1, F.length(piece))).alias("text"))

    return F.transform(whole, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    masked = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(masked, lambda s: unescape(s["text"])), "")


def conversations(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One typed record of the layout ``turns`` per conversation from rows by turn.

    The rows of a conversation are collected with partial aggregation, then ordered inside the row: a
    conversation is one record, whatever its length.
    """
    item = F.struct(col(turn).alias("turn"), F.coalesce(col(role), F.lit("")).alias("role"), F.coalesce(col(text), F.lit("")).alias("text"))
    grouped = turns.groupBy(col(key).alias(key)).agg(F.sort_array(F.collect_list(item)).alias("turns"))
    return grouped.select(col(key), F.struct("turns").alias("record"))
