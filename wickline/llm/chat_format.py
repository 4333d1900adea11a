"""Chat formatting (operator 4), with DataFrame functions only.

Records come in different layouts: prompt and completion, instruction and
output, lists of messages under several names.  Each declarative mapping has
the fingerprint of the nested field paths that mark its layout; a record's own
fingerprint is the hash of those paths that it holds.  The first mapping of the
table whose fingerprint the record has turns it into canonical turns of role
and text, whatever other fields stand beside them.  The template then writes

    <<SYS>>system<</SYS>>   [INST]user[/INST]   <s>assistant</s>
    <|hex of the role|>other<|end|>

Control strings inside texts get a backslash after their first character, and
backslashes are doubled, so every text is read back exactly.  ``loss_spans``
marks the assistant texts as code-point ranges of the formatted text.

Records are JSON texts, or structs, which are read straight from their fields
and have no limit of size but that of a row.

Defined cases: a record that is no JSON or holds no known layout keeps its row
with null layout, turns and text; a record that holds several layouts takes
the first of the table, lists of turns before prompts, and a system text
beside a prompt is its first turn; a list item without a text has an empty
one; a struct whose marking fields are partly null takes the first layout of
which it holds any, and one that holds none the only layout of its type, if
that is no list; a JSON object or list of more than
``JSON_BYTES`` that cannot be read, as it is beyond Spark's size limit of a
variant, fails the query; a null text is empty; an empty list of turns formats as an empty text;
fields besides the known paths are ignored; turn rows of one conversation are
ordered by turn, then role and text, and repeated rows are all turns; a null
conversation id groups like any other.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

TURNS = "array<struct<role:string,text:string>>"

#: Layouts by the nested paths that mark them, the first to apply first.
#: ``turns`` lists (role, path) of a flat record, preceded by ``system`` where
#: the record has that; ``items`` names a list and its role and text fields,
#: and ``names`` says that roles go by other names there.
SYSTEM = "$.system"
MAPPINGS = [
    {"layout": "messages", "paths": ["$.messages[0].role"], "items": ("$.messages", "role", "content")},
    {"layout": "sharegpt", "paths": ["$.conversations[0].from"], "items": ("$.conversations", "from", "value"), "names": True},
    {"layout": "turns", "paths": ["$.turns[0].role"], "items": ("$.turns", "role", "text")},
    {
        "layout": "instruction_input",
        "paths": ["$.input", "$.instruction", "$.output"],
        "turns": [("user", "$.instruction"), ("user", "$.input"), ("assistant", "$.output")],
    },
    {"layout": "instruction", "paths": ["$.instruction", "$.output"], "turns": [("user", "$.instruction"), ("assistant", "$.output")]},
    {
        "layout": "system_prompt_response",
        "paths": ["$.prompt", "$.response", SYSTEM],
        "turns": [("user", "$.prompt"), ("assistant", "$.response")],
    },
    {"layout": "prompt_completion", "paths": ["$.completion", "$.prompt"], "turns": [("user", "$.prompt"), ("assistant", "$.completion")]},
    {"layout": "prompt_response", "paths": ["$.prompt", "$.response"], "turns": [("user", "$.prompt"), ("assistant", "$.response")]},
    {"layout": "question_answer", "paths": ["$.answer", "$.question"], "turns": [("user", "$.question"), ("assistant", "$.answer")]},
]
#: No JSON text below this makes a variant beyond Spark's 128 MiB.
JSON_BYTES = 16 << 20
#: Such other names of the canonical roles.
ROLE_NAMES = {"human": "user", "prompter": "user", "gpt": "assistant", "model": "assistant", "bot": "assistant"}

MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
END_OTHER = "<|end|>"
#: The first character of a control string that stands in a text.
_CONTROL = r"([\[<])(?=/?INST\]|/?s>|</?SYS>>|\|)"
_TURN = r"(?s)<<SYS>>.*?<</SYS>>|\[INST\].*?\[/INST\]|<s>.*?</s>|<\|[0-9A-F]*\|>.*?<\|end\|>"


def fingerprint(paths: list[str], held: list[Column] | None = None) -> Column:
    """The hash of those paths that are held; of all of them without ``held``."""
    names = [F.lit(p) for p in paths] if held is None else [F.when(h, F.lit(p)) for p, h in zip(paths, held, strict=True)]
    return F.xxhash64(F.concat_ws("\n", *names))


def _with_system(turns: Column, system: Column | None, held: Column | None) -> Column:
    if system is None:
        return turns
    return F.concat(F.when(held, F.array(_turn(F.lit("system"), system))).otherwise(F.array().cast(TURNS)), turns)


def _turn(role: Column, text: Column) -> Column:
    return F.struct(role.alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _canonical(role: Column, renamed: bool) -> Column:
    if not renamed:
        return F.coalesce(role, F.lit(""))
    names = F.create_map(*[F.lit(x) for kv in ROLE_NAMES.items() for x in kv])
    role = F.coalesce(role, F.lit(""))
    return F.coalesce(names[F.lower(role)], role)


def _mapped(record: Column, mapping: dict) -> Column:
    if "items" in mapping:
        path, role, text = mapping["items"]
        items = F.try_variant_get(record, path, "array<variant>")
        return F.transform(
            items, lambda x: _turn(_canonical(F.try_variant_get(x, f"$.{role}", "string"), "names" in mapping), F.try_variant_get(x, f"$.{text}", "string"))
        )
    turns = F.array(*[_turn(F.lit(role), F.try_variant_get(record, path, "string")) for role, path in mapping["turns"]])
    return _with_system(turns, F.try_variant_get(record, SYSTEM, "string"), F.variant_get(record, SYSTEM, "variant").isNotNull())


def _field(record: Column, kind: DataType, path: str) -> Column | None:
    """The field of a struct at a path, None if its type has none."""
    for step in re.findall(r"\w+", path[1:]):
        if step.isdigit() and isinstance(kind, ArrayType):
            record, kind = F.get(record, F.lit(int(step))), kind.elementType
        elif isinstance(kind, StructType) and step in kind.names:
            record, kind = record[step], kind[step].dataType
        else:
            return None
    return record


def _struct_mapped(record: Column, kind: StructType, mapping: dict) -> Column:
    if "items" in mapping:
        path, role, text = mapping["items"]
        has_text = _field(record, kind, f"{path}[0].{text}") is not None
        return F.transform(
            _field(record, kind, path),
            lambda x: _turn(_canonical(x[role].cast("string"), "names" in mapping), x[text].cast("string") if has_text else F.lit("")),
        )
    turns = F.array(*[_turn(F.lit(role), _field(record, kind, path).cast("string")) for role, path in mapping["turns"]])
    system = _field(record, kind, SYSTEM)
    if system is None:
        return turns
    return _with_system(turns, system.cast("string"), F.lit(True) if SYSTEM in mapping["paths"] else system.isNotNull())


def _struct_turns(df: DataFrame, record_col: str, kind: StructType) -> DataFrame:
    """As :func:`canonical_turns`, of structs."""
    record = F.col(record_col)
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    fitting = [m for m in MAPPINGS if all(_field(record, kind, p) is not None for p in m["paths"])]
    flat = [m for m in fitting if "turns" in m and not any(set(m["paths"]) < set(o["paths"]) for o in fitting)]
    chosen = [(flat[0], record.isNotNull())] if len(flat) == 1 and all("turns" in m for m in fitting) else []
    for whole in (False, True):  # the last to apply comes first here: part of a layout, then all of one
        for m in reversed(fitting):
            fields = [_field(record, kind, p) for p in m["paths"]]
            if not whole and "items" in m:
                fields += [F.try_element_at(_field(record, kind, m["items"][0]), F.lit(1))]
            held = [c.isNotNull() for c in fields]
            if whole:
                chosen.append((m, fingerprint(m["paths"], held) == fingerprint(m["paths"])))
            else:
                chosen.append((m, F.array_contains(F.array(*held), True)))
    for m, applies in chosen:
        layout = F.when(applies, F.lit(m["layout"])).otherwise(layout)
        turns = F.when(applies, _struct_mapped(record, kind, m)).otherwise(turns)
    return df.withColumns({"layout": layout, "turns": turns})


def _parsed(text: Column) -> Column:
    """The variant of a JSON text, null if it is none."""
    out = F.try_parse_json(text)
    lost = out.isNull() & (F.octet_length(text) > JSON_BYTES) & F.substring(text, 1, 1000).rlike(r"^\s*[{\[]")
    return F.when(lost, F.raise_error(F.lit("a record cannot be read: it is beyond the size limit of a variant, or no JSON")).cast("variant")).otherwise(out)


def canonical_turns(df: DataFrame, record_col: str = "record") -> DataFrame:
    """``df`` with ``layout`` and ``turns`` of the records in ``record_col``."""
    kind = df.schema[record_col].dataType
    if isinstance(kind, StructType):
        return _struct_turns(df, record_col, kind)
    record = F.col("__record")
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for m in reversed(MAPPINGS):  # the first of the table applies last
        held = [F.variant_get(record, p, "variant").isNotNull() for p in m["paths"]]
        applies = fingerprint(m["paths"], held) == fingerprint(m["paths"])
        layout = F.when(applies, F.lit(m["layout"])).otherwise(layout)
        turns = F.when(applies, _mapped(record, m)).otherwise(turns)
    return df.withColumn("__record", _parsed(F.col(record_col))).withColumns({"layout": layout, "turns": turns}).drop("__record")


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _CONTROL, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _opening(role: Column) -> Column:
    out = F.concat(F.lit("<|"), F.hex(role), F.lit("|>"))
    for name, (mark, _) in MARKS.items():
        out = F.when(role == name, F.lit(mark)).otherwise(out)
    return out


def _closing(role: Column) -> Column:
    out = F.lit(END_OTHER)
    for name, (_, mark) in MARKS.items():
        out = F.when(role == name, F.lit(mark)).otherwise(out)
    return out


def format_turns(df: DataFrame, turns_col: str = "turns") -> DataFrame:
    """``df`` with ``formatted`` and ``loss_spans`` (first code point from 0
    and length of each assistant text in it)."""
    pieces = F.transform(
        F.col(turns_col),
        lambda t: F.struct(
            (t["role"] == "assistant").alias("learn"),
            F.length(_opening(t["role"])).alias("lead"),
            F.length(escape(t["text"])).alias("size"),
            F.concat(_opening(t["role"]), escape(t["text"]), _closing(t["role"])).alias("written"),
        ),
    )
    spans = F.aggregate(
        F.col("__pieces"),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["written"])).alias("at"),
            F.when(p["learn"], F.concat(acc["spans"], F.array(F.struct((acc["at"] + p["lead"]).alias("start"), p["size"].alias("length")))))
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    written = F.array_join(F.transform(F.col("__pieces"), lambda p: p["written"]), "")
    out = df.withColumn("__pieces", pieces)
    return out.withColumns({"formatted": written, "loss_spans": spans}).drop("__pieces")


def parse_formatted(formatted: Column) -> Column:
    """The turns of a formatted text."""

    def turn(written: Column) -> Column:
        role, start = F.unhex(F.regexp_extract(written, r"^<\|([0-9A-F]*)\|>", 1)).cast("string"), F.length(F.regexp_extract(written, r"^<\|[0-9A-F]*\|>", 0))
        end = F.lit(len(END_OTHER))
        for name, (first, last) in MARKS.items():
            own = F.startswith(written, F.lit(first))
            role, start, end = (F.when(own, F.lit(x)).otherwise(y) for x, y in ((name, role), (len(first), start), (len(last), end)))
        text = F.substring(written, start + 1, F.length(written) - start - end)
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    return F.transform(F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(0)), turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")


def turn_rows(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id and record: the rows of each conversation as one record of messages."""
    row = F.struct(
        F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("content")
    )
    groups = df.groupBy(F.col(id_col).alias("conv_id")).agg(F.sort_array(F.collect_list(row)).alias("rows"))
    messages = F.transform(F.col("rows"), lambda r: F.struct(r["role"].alias("role"), r["content"].alias("content")))
    return groups.select("conv_id", F.struct(messages.alias("messages")).alias("record"))


def chat_digests(df: DataFrame) -> DataFrame:
    """What a formatted conversation says when read back, a row each.  ``df``
    has conv_id, formatted and loss_spans."""
    back = df.withColumn("__turns", parse_formatted(F.col("formatted"))).withColumn("__loss", loss_text(F.col("formatted"), F.col("loss_spans")))
    said = F.array_join(F.transform(F.col("__turns"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("__turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("__loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("__loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
