"""Chat formatting: records of several layouts become canonical turns, then one marked text with a loss mask.

1. Fingerprint. The nested field paths of a JSON record (``.messages[].role`` and the like, without types and values) are
   sorted and hashed. Spark infers the schema of each record (``schema_of_variant``); a fold over its tokens, with the
   open objects on a stack, writes the paths.
2. Mapping. ``LAYOUTS`` declares for each known layout which fields hold which turns, and which fields may be absent. Every
   combination of present fields is one fingerprint; a literal map leads from it to the layout.
3. Template. A turn is ``<|im_start|>`` role, line feed, text, ``<|im_end|>`` and line feed. In texts and roles every ``<``, any
   number of backslashes and ``|`` gets one backslash more, so no control string is left, and reading takes it away again.
   Roles also have backslashes and line feeds escaped, so a role ends at the first line feed.
4. Mask. ``loss_runs`` has (skip, take) for each turn: code points passed over since the run before, then code points learned,
   the escaped text of an assistant. Marks are never learned.

A record is one row, whatever its layout; no step shuffles. A conversation is one value, as a document is.

Defined results: a null or broken record, or one of an unknown layout, keeps its row with layout, turns, formatted and
loss_runs null; null roles and texts are empty; a record without turns is of unknown layout (its paths end early); repeated
records stay; an empty table gives no row; columns named like the new ones are replaced.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
LEARNED = "assistant"
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """Where the turns of a record are: ``fields`` are (role, field) in order, or ``items`` is a list of turns.

    ``text`` may be a list of parts with a field of their own (``part``); ``extra`` fields say nothing about turns.
    """

    name: str
    fields: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()
    items: str = ""
    role: str = ""
    text: str = ""
    part: str = ""
    roles: tuple[tuple[str, str], ...] = ()
    extra: tuple[str, ...] = ("conv_id",)

    def paths(self) -> set[str]:
        """All field paths of a record with every field."""
        found = {f".{f}" for _, f in self.fields}
        if self.items:
            turn = f".{self.items}[]"
            found |= {f".{self.items}", turn, f"{turn}.{self.role}", f"{turn}.{self.text}"}
            if self.part:
                parts = f"{turn}.{self.text}[]"
                found |= {parts, f"{parts}.{self.part}", f"{parts}.type"}
        return found

    def fingerprints(self) -> set[str]:
        free = [f".{f}" for f in (*self.optional, *self.extra)]
        fixed = self.paths() - set(free)
        return {fingerprint_of(fixed | set(some)) for n in range(len(free) + 1) for some in combinations(free, n)}

    def turns(self, record: Column) -> Column:
        """The turns of a record of this layout, by one parse with the fields named."""
        if not self.items:
            row = F.from_json(record, ", ".join(f"`{f}` string" for _, f in self.fields))
            turns = [F.struct(F.lit(role).alias("role"), row[f].alias("text")) for role, f in self.fields]
            # an absent or null optional field is no turn
            return F.filter(F.array(*turns), lambda t: t["text"].isNotNull() | ~t["role"].isin(
                [role for role, f in self.fields if f in self.optional]))
        text = f"array<struct<`{self.part}`:string>>" if self.part else "string"
        items = F.from_json(record, f"`{self.items}` array<struct<`{self.role}`:string,`{self.text}`:{text}>>")[self.items]
        renamed = lambda role: F.coalesce(*[F.when(role == a, b) for a, b in self.roles], role)
        body = lambda t: F.array_join(t[self.part], "") if self.part else t
        return F.transform(items, lambda t: F.struct(renamed(t[self.role]).alias("role"), body(t[self.text]).alias("text")))


LAYOUTS = (
    Layout("prompt", fields=(("user", "prompt"), ("assistant", "completion"))),
    Layout("instruction", fields=(("system", "system"), ("user", "instruction"), ("assistant", "output")), optional=("system",)),
    Layout("messages", items="messages", role="role", text="content"),
    Layout("parts", items="messages", role="role", text="content", part="text"),
    Layout("exchange", items="conversations", role="from", text="value", roles=(("human", "user"), ("gpt", "assistant"))),
)


def fingerprint_of(paths: set[str]) -> str:
    return hashlib.md5("\n".join(sorted(paths, key=lambda p: p.encode())).encode()).hexdigest()


def field_paths(record: Column) -> Column:
    """Sorted distinct field paths of a JSON record; null if it does not parse."""
    schema = F.schema_of_variant(F.try_parse_json(record))
    tokens = F.regexp_extract_all(schema, F.lit(r"`(?:[^`]|``)*`: |\w+: |OBJECT<|ARRAY<|>"), F.lit(0))
    state = lambda at, stack, paths: F.struct(at.alias("at"), stack.alias("stack"), paths.alias("paths"))
    none = F.array().cast("array<string>")

    def step(s: Column, token: Column) -> Column:
        items, opened = token == "ARRAY<", token.isin("ARRAY<", "OBJECT<")
        closed = token == ">"
        top = F.try_element_at(s["stack"], F.lit(-1))
        name = F.regexp_replace(token, "^`|`?: $", "")
        at = F.when(items, F.concat(s["at"], F.lit("[]"))).when(opened, s["at"]).when(closed, top).otherwise(F.concat(top, F.lit("."), name))
        stack = (F.when(opened, F.concat(s["stack"], F.array(s["at"])))
                 .when(closed, F.slice(s["stack"], F.lit(1), F.size(s["stack"]) - 1)).otherwise(s["stack"]))
        return state(at, stack, F.when(closed | (token == "OBJECT<"), s["paths"]).otherwise(F.concat(s["paths"], F.array(at))))

    folded = F.aggregate(tokens, state(F.lit(""), none, none), step)
    return F.when(schema.isNotNull(), F.array_sort(F.array_distinct(folded["paths"])))


def fingerprint(record: Column) -> Column:
    return F.md5(F.array_join(field_paths(record), "\n").cast("binary"))


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _head(role: Column) -> Column:
    plain = F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return F.concat(F.lit(START), escaped(plain), F.lit("\n"))


def _role(head: Column) -> Column:
    """The role of a head without its start mark and line feed."""
    parts = F.transform(F.split(unescaped(head), r"\\\\", -1), lambda part: F.replace(part, F.lit("\\n"), F.lit("\n")))
    return F.array_join(parts, "\\")


def canonical(records: DataFrame, column: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Adds fingerprint, layout and turns (role and text, never null) to rows with a JSON record."""
    known = {print_: layout.name for layout in layouts for print_ in layout.fingerprints()}
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    turns = F.lit(None).cast(TURNS)
    for layout in layouts:
        turns = F.when(F.col("layout") == layout.name, layout.turns(F.col(column))).otherwise(turns)
    filled = F.transform(turns, lambda t: F.struct(F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text")))
    return (records.withColumn("fingerprint", fingerprint(F.col(column)))
            .withColumn("layout", F.try_element_at(table, F.coalesce("fingerprint", F.lit("")))).withColumn("turns", filled))


def render(turns: DataFrame) -> DataFrame:
    """Adds formatted and loss_runs to rows with canonical turns."""
    pieces = F.transform("turns", lambda t: F.struct(
        _head(t["role"]).alias("head"), escaped(t["text"]).alias("body"), (t["role"] == LEARNED).alias("learned")))

    def run(p: Column, i: Column) -> Column:
        before, body = F.length(p["head"]) + F.when(i > 0, len(END)).otherwise(0), F.length(p["body"])
        return F.struct((before + F.when(p["learned"], 0).otherwise(body)).alias("skip"), F.when(p["learned"], body).otherwise(0).alias("take"))

    return (turns.withColumn("_pieces", pieces)
            .withColumn("formatted", F.array_join(F.transform("_pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END))), ""))
            .withColumn("loss_runs", F.transform("_pieces", run)).drop("_pieces"))


def read_back(rendered: DataFrame) -> DataFrame:
    """Adds to rendered rows, from ``formatted`` and ``loss_runs`` alone: read_turns, and loss_text, unescaped."""
    # escaping leaves no end mark in texts; after the last one nothing follows
    marked = F.split("formatted", r"<\|im_end\|>\n", -1)
    return (rendered.withColumn("_marked", F.slice(marked, F.lit(1), F.size(marked) - 1))
            .withColumn("read_turns", F.transform("_marked", _turn))
            .withColumn("loss_text", F.array_join(F.zip_with("_marked", "loss_runs", _learned), "")).drop("_marked"))


def _turn(marked: Column) -> Column:
    head = F.substring_index(F.substr(marked, F.lit(len(START) + 1)), "\n", 1)
    return F.struct(_role(head).alias("role"), unescaped(F.substr(marked, F.length(head) + len(START) + 2)).alias("text"))


def _learned(marked: Column, run: Column) -> Column:
    """The learned text of one marked turn; its run skips to the text from the front, as nothing is learned behind it."""
    return unescaped(F.substr(marked, F.length(marked) - run["take"] + 1, run["take"]))


def as_records(rows: DataFrame) -> DataFrame:
    """(conv_id, record) from rows (conv_id, turn, role, text): JSON in the layout that suits the roles of the conversation.

    Turns are ordered by turn (null last), then role and text. A row without conv_id is a conversation of its own.
    """
    turn = F.struct(F.col("turn").isNull().alias("last"), "turn", F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    plain = rows.select("conv_id", turn.alias("t"))
    grouped = plain.where("conv_id is not null").groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    single = plain.where("conv_id is null").select("conv_id", F.array("t").alias("t"))
    roles, text = F.col("t.role"), lambda i: F.get(F.col("t"), F.lit(i))["text"]
    names = lambda *r: roles == F.array(*[F.lit(x) for x in r])
    other = lambda t: F.when(t["role"] == "user", "human").when(t["role"] == "assistant", "gpt").otherwise(t["role"])
    messages = F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content")))
    parts = F.transform("t", lambda t: F.struct(t["role"].alias("role"), F.array(
        F.struct(F.lit("text").alias("type"), t["text"].alias("text"))).alias("content")))
    exchange = F.transform("t", lambda t: F.struct(other(t).alias("from"), t["text"].alias("value")))
    usual = F.forall(roles, lambda r: r.isin("system", "user", "assistant"))
    json = lambda **fields: F.to_json(F.struct("conv_id", *[c.alias(k) for k, c in fields.items()]))
    record = (F.when(names("user", "assistant"), json(prompt=text(0), completion=text(1)))
              .when(names("system", "user", "assistant"), json(system=text(0), instruction=text(1), output=text(2)))
              .when(usual & (F.get(roles, F.lit(0)) == "user"), json(conversations=exchange))
              .when(usual, json(messages=parts)).otherwise(json(messages=messages)))
    return grouped.unionByName(single).select("conv_id", record.alias("record"))


def digests(read: DataFrame) -> DataFrame:
    """Per conversation, from what was read back: counts and digests of its turns and of its learned text."""
    said = F.array_join(F.transform("read_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("read_turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
