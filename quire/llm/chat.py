"""Chat formatting with DataFrame functions only.

Records come in many layouts: turns as rows, prompt and response, instruction
with input and output, lists of messages. A layout is known by its fingerprint,
a hash of the nested field paths that mean something to any declared mapping.
The fingerprint selects the mapping, which turns a record into canonical turns
(conv_id, turn, sub, role, text). Turns are rendered with a template whose
control strings are escaped, reversibly, where they occur inside a text.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The template's marks, and strings other chat templates treat as control strings.
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROL = (START, SEP, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
LOSS_ROLE = "assistant"

_TAILS = "|".join(re.escape(c[1:]) for c in CONTROL)
_ESCAPE = rf"([<\[])(\\*)(?={_TAILS})"
_UNESCAPE = rf"([<\[])\\(\\*)(?={_TAILS})"


@dataclass(frozen=True)
class Layout:
    """A declarative mapping: where the conversation id and the turns are.

    ``each`` names a list field with (role field, text field) in its elements;
    ``turns`` lists (role, text fields to join by a blank line) of one record;
    ``row`` names (turn, role, text) of a record that is itself one turn.
    """

    name: str
    id_field: str
    row: tuple[str, str, str] | None = None
    each: tuple[str, str, str] | None = None
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()

    def paths(self) -> frozenset[str]:
        own = {self.id_field}
        if self.row:
            own |= set(self.row)
        if self.each:
            own |= {f"{self.each[0]}[].{f}" for f in self.each[1:]}
        for _, fields in self.turns:
            own |= set(fields)
        return frozenset(own)


LAYOUTS = (
    Layout("turn_rows", "conv_id", row=("turn", "role", "text")),
    Layout("messages", "conv_id", each=("messages", "role", "content")),
    Layout("from_value", "conv_id", each=("conversations", "from", "value")),
    Layout("system_prompt_response", "conv_id", turns=(
        ("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("prompt_response", "conv_id", turns=(("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("prompt_completion", "conv_id", turns=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("instruction_input", "conv_id", turns=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("instruction", "conv_id", turns=(("user", ("instruction",)), ("assistant", ("output",)))),
)
VOCABULARY = frozenset().union(*(x.paths() for x in LAYOUTS))
_LISTS = tuple(x.each[0] for x in LAYOUTS if x.each)


def fingerprint(paths) -> str:
    """Hash of the sorted field paths that some mapping knows."""
    return hashlib.sha256("\n".join(sorted(set(paths) & VOCABULARY)).encode()).hexdigest()


def schema_paths(schema: T.StructType, prefix: str = "") -> list[str]:
    """Nested field paths; ``[]`` marks the elements of a list."""
    out = []
    for f in schema.fields:
        kind, path = f.dataType, prefix + f.name
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            out += schema_paths(kind.elementType, f"{path}[].")
        elif isinstance(kind, T.StructType):
            out += schema_paths(kind, f"{path}.")
        else:
            out.append(path)
    return out


def layout_of(schema: T.StructType, layouts=LAYOUTS) -> Layout:
    """The mapping with the schema's fingerprint. If further columns clash with
    another mapping's names, the first mapping all of whose paths are there."""
    paths = schema_paths(schema)
    by_print = {fingerprint(x.paths()): x for x in layouts}
    found = by_print.get(fingerprint(paths)) or next((x for x in layouts if x.paths() <= set(paths)), None)
    if found is None:
        raise ValueError(f"no mapping for the field paths {sorted(paths)}")
    return found


def _turn(turn: Column, sub: Column, role: Column, text: Column) -> Column:
    role = F.coalesce(role.cast("string"), F.lit(""))
    for other, name in ROLE_NAMES.items():
        role = F.when(role == other, F.lit(name)).otherwise(role)
    return F.struct(turn.cast("long").alias("turn"), sub.cast("int").alias("sub"), role.alias("role"),
                    F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def _turns(x: Layout, field, inside=lambda element, name: element[name], element: str | None = None) -> Column:
    """The record's turns as an array; ``field(name, type)`` reads one of its fields, ``inside`` a
    field of a list's element (of the type ``element``, where given)."""
    if x.row:
        return F.array(_turn(field(x.row[0], "bigint"), F.lit(0), field(x.row[1], "string"), field(x.row[2], "string")))
    if x.each:
        items = field(x.each[0], f"array<{element or f'struct<`{x.each[1]}`:string,`{x.each[2]}`:string>'}>")
        made = F.transform(items, lambda m, i: _turn(i, F.lit(0), inside(m, x.each[1]), inside(m, x.each[2])))
        return F.coalesce(made, F.array())
    made = [_turn(F.lit(0), F.lit(k), F.lit(role), F.concat_ws("\n\n", *(
        F.nullif(field(f, "string"), F.lit("")) for f in fields))) for k, (role, fields) in enumerate(x.turns)]
    return F.array(*made)


def canonical_turns(records: DataFrame, layouts=LAYOUTS) -> DataFrame:
    """Turns (conv_id, turn, sub, role, text) of records that share one typed layout.

    The layout is chosen once, by the fingerprint of the schema. Null roles and
    texts are empty; other columns are not read; repeated rows stay."""
    x = layout_of(records.schema, layouts)
    turns = _turns(x, lambda f, kind: F.col(f"`{f}`").cast(kind) if not kind.startswith("array") else F.col(f"`{f}`"))
    return records.select(F.col(x.id_field).cast("long").alias("conv_id"), F.inline(turns))


def as_records(rows: DataFrame, name: str = "record") -> DataFrame:
    """Each row as one variant of those of its columns that some mapping knows, so that frames
    of different layouts can be united. A record holds at most 128 MB (Spark's limit on variants)."""
    top = {p.split("[")[0].split(".")[0] for p in VOCABULARY}
    held = [F.col(f"`{c}`") for c in rows.columns if c in top]
    return rows.select(F.to_variant_object(F.struct(*held)).alias(name))


def mixed_turns(records: DataFrame, column: str, layouts=LAYOUTS) -> DataFrame:
    """Turns of records (variants, or JSON strings of at most 20 MB) whose layout differs from row to row.

    Each row's fingerprint is computed in Spark from its own keys and the keys of all
    elements of its message lists. A row with further known keys takes the first mapping all of
    whose paths it has, else the first whose message list it has (elements may lack fields,
    which are empty then). A list that is empty, null or no list has no turns. Rows without turns give one
    row with null turns, so that no conversation is lost; conv_id is read in any case. Rows with no
    mapping, or that are no object, have layout null."""
    is_text = isinstance(records.schema[column].dataType, T.StringType)
    v = F.try_parse_json(F.col(f"`{column}`")) if is_text else F.col(f"`{column}`")
    rows = records.select(v.alias("v"))
    get = lambda f, kind: F.try_variant_get(F.col("v"), f"$.{f}", kind)
    keys = lambda c: F.coalesce(F.map_keys(c.try_cast("map<string,variant>")), F.array().cast("array<string>"))

    own = keys(F.col("v"))

    def element_paths(name: str) -> Column:
        items = get(name, "array<variant>")
        inner = F.transform(F.flatten(F.transform(items, keys)), lambda k: F.concat(F.lit(f"{name}[]."), k))
        whole = F.array(*(F.lit(p) for p in sorted(VOCABULARY) if p.startswith(f"{name}[].")))
        empty = F.array_contains(own, name) & (F.coalesce(F.size(items), F.lit(0)) <= 0)
        return F.when(empty, whole).otherwise(F.coalesce(inner, F.array().cast("array<string>")))

    known = F.array(*(F.lit(p) for p in sorted(VOCABULARY)))
    paths = F.array_sort(F.array_distinct(F.array_intersect(F.concat(own, *map(element_paths, _LISTS)), known)))
    rows = rows.select("v", own.alias("own"), paths.alias("paths")).select("v", "own", "paths", F.sha2(F.array_join("paths", "\n"), 256).alias("print"))

    def has(x: Layout) -> Column:
        return F.size(F.array_except(F.array(*(F.lit(p) for p in sorted(x.paths()))), F.col("paths"))) == 0

    pick = [F.when(F.col("print") == fingerprint(x.paths()), F.lit(i)) for i, x in enumerate(layouts)]
    pick += [F.when(has(x), F.lit(i)) for i, x in enumerate(layouts)]
    pick += [F.when(F.array_contains("own", x.each[0]), F.lit(i)) for i, x in enumerate(layouts) if x.each]
    rows = rows.select("v", F.coalesce(*pick).alias("pick"))

    ids = list(dict.fromkeys(x.id_field for x in layouts))
    layout, turns = F.lit(None).cast("string"), F.array().cast("array<struct<turn:bigint,sub:int,role:string,text:string>>")
    inside = lambda m, name: F.try_variant_get(m, f"$.{name}", "string")
    for i, x in enumerate(layouts):
        layout = F.when(F.col("pick") == i, F.lit(x.name)).otherwise(layout)
        turns = F.when(F.col("pick") == i, _turns(x, get, inside, "variant")).otherwise(turns)
    return rows.select(layout.alias("layout"), F.coalesce(*(get(f, "bigint") for f in ids)).alias("conv_id"), F.inline_outer(turns))


def escape(text: Column) -> Column:
    """A backslash more after the first character of every control string (and of
    what looks like an escaped one), so that none is left and none is lost."""
    return F.regexp_replace(text, F.lit(_ESCAPE), F.lit(r"$1$2\\"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_UNESCAPE), F.lit("$1$2"))


def format_turns(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss (spans of code points
    [start, end) of the assistant's texts inside ``formatted``).

    Turns are ordered by turn (null first), sub, role, text; repeated turns are
    all kept. A null conv_id is one conversation of its own. A conversation is
    one string, so it has to fit into one row; nothing else is gathered."""
    head = F.concat(F.lit(START), escape(F.col("role")), F.lit(SEP))
    body = escape(F.col("text"))
    parts = turns.select("conv_id", "turn", "sub", "role", "text", head.alias("head"), body.alias("body"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "sub", "role", "text")
    size = F.length("head") + F.length("body") + F.lit(len(END))
    placed = parts.select(
        "conv_id", "role", F.row_number().over(order).alias("nth"), "head", "body",
        (F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, 0)) - size + F.length("head")).alias("start"))
    gathered = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "nth", F.concat("head", "body", F.lit(END)).alias("shown"),
        F.when(F.col("role") == LOSS_ROLE, F.struct("start", (F.col("start") + F.length("body")).alias("end"))).alias("span")))).alias("t"))
    return gathered.select("conv_id", F.array_join(F.col("t.shown"), "").alias("formatted"),
                           F.filter(F.col("t.span"), lambda s: s.isNotNull()).alias("loss"))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds."""
    blocks = F.slice(F.split(formatted, re.escape(START), -1), 2, 1 << 30)
    inner = F.transform(blocks, lambda b: F.split(F.substring_index(b, END, 1), re.escape(SEP), 2))
    return F.transform(inner, lambda p: F.struct(unescape(p[0]).alias("role"), unescape(p[1]).alias("text")))


def read_loss(formatted: Column, loss: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescape(
        F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def formatted_digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from the formatted strings, as counts and digests."""
    turns = read_turns(F.col("formatted"))
    return formatted.select("conv_id", turns.alias("turns"), read_loss(F.col("formatted"), F.col("loss")).alias("lost"),
                            F.length("formatted").cast("long").alias("formatted_chars")).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""),
               256).alias("turns_sha256"),
        F.length("lost").cast("long").alias("loss_chars"), F.sha2("lost", 256).alias("loss_sha256"), "formatted_chars")
