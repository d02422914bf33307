"""Chat formatting: records of several layouts become turns, and turns one marked-up text with a loss mask.

A record is JSON. Its nested field paths, sorted, are hashed; the hash selects the declared mapping that turns the record
into (role, text) turns. Everything is DataFrame functions.

A turn is written ``<s>[role]text</s>``. In roles and texts ``&``, ``<``, ``[`` and ``]`` stand as entities, so no text can
contain or complete a mark, and reading is exact. The mask has, for each turn, how
many characters to skip after its start and how many to take: the texts of the assistant.

Turns are ordered by turn, role and text, nulls first, so ties have one order. Null roles and texts are empty. Rows without conv_id
form one conversation. Repeated rows are repeated turns. Only the four named columns are read. A record of an
unknown layout has null turns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
#: The characters of marks, and what stands for them in texts. ``&`` comes first.
ENTITIES = [("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;"), ("]", "&rsqb;")]
START, MIDDLE, END = "<s>[", "]", "</s>"

_TURNS = "array<struct<role:string,text:string>>"
_JSON = {"maxStringLen": str(2**31 - 1)}


@dataclass(frozen=True)
class Layout:
    """A mapping: the fields that make turns of a given role in this order, or a list field with its two keys."""

    name: str
    paths: tuple[str, ...]
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()  # role -> fields, joined by an empty line
    listed: tuple[str, str, str] | None = None  # list field, key of the role, key of the text
    roles: tuple[tuple[str, str], ...] = ()  # names of roles that differ


LAYOUTS = (
    Layout("messages", ("messages[].content", "messages[].role"), listed=("messages", "role", "content")),
    Layout("from_value", ("conversations[].from", "conversations[].value"), listed=("conversations", "from", "value"),
           roles=(("human", "user"), ("gpt", "assistant"))),
    Layout("prompt", ("completion", "prompt"), fields=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("system_prompt", ("completion", "prompt", "system"),
           fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("instruction", ("input", "instruction", "output"),
           fields=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("short_instruction", ("instruction", "output"), fields=(("user", ("instruction",)), ("assistant", ("output",)))),
)


def field_paths(body: Column) -> Column:
    """Sorted paths of a JSON record's fields; members of lists of objects are ``list[].member``.

    A variant keeps apart a nested value and a string that looks like one. Records that a variant cannot hold (one too large,
    or with a repeated field) are read as strings, where the first character decides.
    """
    return F.coalesce(_typed_paths(F.try_parse_json(body)), _guessed_paths(body))


def _typed_paths(record: Column) -> Column:
    fields = lambda v: F.map_entries(F.try_variant_get(v, "$", "map<string,variant>"))
    names = lambda v: F.map_keys(F.try_variant_get(v, "$", "map<string,variant>"))
    kind = lambda v, name: F.schema_of_variant(v).startswith(name)
    members = lambda v: F.try_variant_get(v, "$", "array<variant>")
    inner = lambda v: F.flatten(F.transform(members(v), lambda m: F.when(kind(m, "OBJECT"), names(m)).otherwise(F.array(F.lit("")))))
    paths = F.transform(fields(record), lambda e: F.when(
        kind(e["value"], "ARRAY") & kind(F.get(members(e["value"]), F.lit(0)), "OBJECT"),
        F.transform(inner(e["value"]), lambda k: F.concat(e["key"], F.lit("[]."), k)))
        .when(kind(e["value"], "OBJECT"), F.transform(names(e["value"]), lambda k: F.concat(e["key"], F.lit("."), k)))
        .otherwise(F.array(e["key"])))
    return F.array_sort(F.array_distinct(F.flatten(paths)))


def _guessed_paths(body: Column) -> Column:
    top = F.map_entries(F.from_json(body, "map<string,string>", _JSON))
    inner = lambda e: F.flatten(F.transform(
        F.from_json(e["value"], "array<map<string,string>>", _JSON), lambda m: F.map_keys(m)))
    nested = lambda e: F.from_json(e["value"], "map<string,string>", _JSON)
    paths = F.transform(top, lambda e: F.when(
        e["value"].startswith("[{"), F.transform(inner(e), lambda k: F.concat(e["key"], F.lit("[]."), k)))
        .when(e["value"].startswith("{") & nested(e).isNotNull(),
              F.transform(F.map_keys(nested(e)), lambda k: F.concat(e["key"], F.lit("."), k)))
        .otherwise(F.array(e["key"])))
    return F.array_sort(F.array_distinct(F.flatten(paths)))


def fingerprint(paths: Column) -> Column:
    return F.sha2(F.array_join(paths, "\n"), 256)


def _turns(layout: Layout, body: Column) -> Column:
    if layout.listed:
        field, role, text = layout.listed
        parsed = F.from_json(body, f"`{field}` array<struct<`{role}`:string,`{text}`:string>>", _JSON)[field]
        named = lambda r: F.coalesce(*[F.when(r == a, F.lit(b)) for a, b in layout.roles], r, F.lit(""))
        return F.transform(parsed, lambda m: F.struct(named(m[role]).alias("role"), F.coalesce(m[text], F.lit("")).alias("text")))
    names = [f for _, fields in layout.fields for f in fields]
    parsed = F.from_json(body, ", ".join(f"`{f}` string" for f in names), _JSON)
    joined = lambda fields: F.array_join(
        F.filter(F.array(*[F.coalesce(parsed[f], F.lit("")) for f in fields]), lambda v: v != ""), "\n\n")
    return F.array(*[F.struct(F.lit(role).alias("role"), joined(fields).alias("text")) for role, fields in layout.fields])


def canonical(records: DataFrame, body: str = "body", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``records`` with ``layout``, the name of the mapping that the fingerprint selects, and its ``turns``."""
    marked = records.withColumn("_fingerprint", fingerprint(field_paths(F.col(body))))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(_TURNS)
    for layout in layouts:
        mine = F.col("_fingerprint") == fingerprint(F.array(*map(F.lit, sorted(layout.paths))))
        name = F.when(mine, F.lit(layout.name)).otherwise(name)
        turns = F.when(mine, _turns(layout, F.col(body))).otherwise(turns)
    return marked.select("*", name.alias("layout"), turns.alias("turns")).drop("_fingerprint")


def escape(text: Column) -> Column:
    for mark, entity in ENTITIES:
        text = F.replace(text, F.lit(mark), F.lit(entity))
    return text


def unescape(text: Column) -> Column:
    for mark, entity in reversed(ENTITIES):
        text = F.replace(text, F.lit(entity), F.lit(mark))
    return text


def formatted(turns: DataFrame) -> DataFrame:
    """``formatted`` and ``loss_mask`` from ``turns``: per turn the characters to skip and to take."""
    parts = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(START), escape(t["role"]), F.lit(MIDDLE)).alias("head"), escape(t["text"]).alias("text"),
        (t["role"] == ASSISTANT).alias("learn")))
    with_parts = turns.withColumn("_parts", parts)
    text = F.array_join(F.transform("_parts", lambda p: F.concat(p["head"], p["text"], F.lit(END))), "")
    mask = F.transform("_parts", lambda p: F.struct(
        F.length(p["head"]).alias("skip"), F.when(p["learn"], F.length(p["text"])).otherwise(0).alias("take")))
    return with_parts.withColumns({"formatted": text, "loss_mask": mask}).drop("_parts")


def read_back(df: DataFrame) -> DataFrame:
    """``read_turns`` and ``learned`` (the texts under the mask) from ``formatted`` and ``loss_mask`` alone."""
    marked = F.split("formatted", END)
    pieces = df.withColumn("_pieces", F.slice(marked, 1, F.size(marked) - 1))
    middle = lambda p: F.instr(p, MIDDLE)
    turns = F.transform("_pieces", lambda p: F.struct(
        unescape(p.substr(F.lit(len(START) + 1), middle(p) - len(START) - 1)).alias("role"),
        unescape(p.substr(middle(p) + 1, F.length(p))).alias("text")))
    learned = F.array_join(F.zip_with("_pieces", "loss_mask", lambda p, m: unescape(p.substr(m["skip"] + 1, m["take"]))), "")
    return pieces.withColumns({"read_turns": turns, "learned": learned}).drop("_pieces")


def records(rows: DataFrame) -> DataFrame:
    """(conv_id, body): conversations given as rows (conv_id, turn, role, text), each as JSON in a layout that fits.

    A pair of user and assistant is a prompt with its completion, with a system text if there is one
    in front; other conversations are lists, of messages for even ids and of from/value pairs for odd ones.
    """
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    ordered = rows.select("conv_id", F.struct("turn", blank("role").alias("role"), blank("text").alias("text")).alias("t"))
    lists = ordered.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    roles = F.col("t.role")
    is_roles = lambda *names: roles == F.array(*map(F.lit, names))
    at = lambda i: F.col("t")[i]["text"]
    as_list = lambda field, role, text, name: F.to_json(F.struct(F.transform(
        "t", lambda m: F.struct(name(m["role"]).alias(role), m["text"].alias(text))).alias(field)))
    other = lambda r: F.when(r == "user", F.lit("human")).when(r == "assistant", F.lit("gpt")).otherwise(r)
    body = (
        F.when(is_roles("user", "assistant"), F.to_json(F.struct(at(0).alias("prompt"), at(1).alias("completion"))))
        .when(is_roles("system", "user", "assistant"),
              F.to_json(F.struct(at(0).alias("system"), at(1).alias("prompt"), at(2).alias("completion"))))
        .when((F.pmod("conv_id", F.lit(2)) == 1) & ~F.arrays_overlap(roles, F.array(F.lit("human"), F.lit("gpt"))),
              as_list("conversations", "from", "value", other))
        .otherwise(as_list("messages", "role", "content", lambda r: r)))
    return lists.select("conv_id", body.alias("body"))


def digests(rows: DataFrame) -> DataFrame:
    """Per conversation: what is read back from its formatted text and mask."""
    read = read_back(formatted(canonical(records(rows))))
    flat = F.array_join(F.transform("read_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("read_turns").cast("long").alias("n_turns"), F.sha2(flat, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
