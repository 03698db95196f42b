"""Chat formatting by compiled templates.

A template is text with ``{{ expression }}`` outputs and ``{% statement %}`` tags: ``for``
over the messages, ``if``/``elif``/``else``, and ``generation`` around what a model is to
be trained on. It is parsed into a syntax tree, constant parts are folded, and the rest
becomes Python closures that yield pieces of text with their generation mark. Names are
``messages``, the loop variable and ``loop``; there are no calls and no other attributes,
so a template can't reach anything else.

Conversations are streamed: rows are dealt out by conversation and sorted by turn, and a
task holds one turn at a time, however long a conversation is. The formatted text comes
in parts that end where a turn ends; a conversation's text is its parts in order. (The
digest of a conversation needs its turns one after another, so one conversation is one
task's work; its memory stays bounded.)

Control strings inside roles and texts get a backslash after their first character, and
one more if they have some already; reading back takes one away. All other text stays.

Defined results: null text and null role read as empty; turns with equal numbers go by
role and text, null turns first; repeated rows are turns of their own; a null conv_id is
one conversation; roles of any other name keep it; an empty table gives no rows; other
columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orgloom.llm.common import arrow_schema, as_batches, n_partitions, table

Piece = tuple[str, bool]
Scope = dict
Render = Callable[[Scope, bool], Iterator[Piece]]

# --- syntax tree -----------------------------------------------------------------


@dataclass(frozen=True)
class Text:
    value: str


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Field:
    name: str
    attribute: str


@dataclass(frozen=True)
class Apply:
    """An operator or a filter over its operands."""

    what: str
    operands: tuple


@dataclass(frozen=True)
class Output:
    value: object


@dataclass(frozen=True)
class Loop:
    name: str
    body: tuple


@dataclass(frozen=True)
class If:
    branches: tuple  # (condition, body) pairs, the last condition may be Const(True)


@dataclass(frozen=True)
class Generation:
    body: tuple


class TemplateError(ValueError):
    """A template that can't be parsed or that names what it must not."""


_TAGS = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.DOTALL)
_TOKENS = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*')|(\d+)|([A-Za-z_]\w*)|(==|!=|[+|.()]))")
_MESSAGE = ("role", "text")
_LOOP = ("first", "last", "index0")
_BINARY = {
    "+": lambda a, b: a + b if isinstance(a, int) and isinstance(b, int) else str(a) + str(b),
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "and": lambda a, b: a and b,
    "or": lambda a, b: a or b,
}
_UNARY = {"not": lambda a: not a, "trim": lambda a: a.strip(), "upper": lambda a: a.upper(), "lower": lambda a: a.lower()}


class _Expression:
    """One expression, read by descent: or < and < not < comparison < + < filter < atom."""

    def __init__(self, source: str, names: dict[str, tuple[str, ...]], filters: dict):
        self.tokens, at = [], 0
        source = source.strip()
        while at < len(source):
            m = _TOKENS.match(source, at)
            if not m:
                raise TemplateError(f"can't read {source[at:]!r}")
            self.tokens.append(next((i, t) for i, t in enumerate(m.groups()) if t is not None))
            at = m.end()
        self.names, self.filters, self.at = names, filters, 0

    def whole(self):
        out = self.chain(("or",), self.both)
        if self.at < len(self.tokens):
            raise TemplateError(f"left over: {self.tokens[self.at][1]!r}")
        return out

    def both(self):
        return self.chain(("and",), self.negated)

    def negated(self):
        if self.takes("not"):
            return Apply("not", (self.negated(),))
        return self.chain(("==", "!="), self.sum)

    def sum(self):
        return self.chain(("+",), self.filtered)

    def chain(self, operators, part):
        out = part()
        while (found := next((o for o in operators if self.takes(o)), None)) is not None:
            out = Apply(found, (out, part()))
        return out

    def filtered(self):
        out = self.atom()
        while self.takes("|"):
            name = self.next()[1]
            if name not in self.filters:
                raise TemplateError(f"no filter {name!r}")
            out = Apply(name, (out,))
        return out

    def atom(self):
        kind, token = self.next()
        if kind == 0:
            return Const(re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), token[1:-1]))
        if kind == 1:
            return Const(int(token))
        if token == "(":
            out = self.chain(("or",), self.both)
            if not self.takes(")"):
                raise TemplateError("missing )")
            return out
        if kind == 2 and token in ("true", "false"):
            return Const(token == "true")
        if kind == 2 and token in self.names:
            if not self.takes("."):
                raise TemplateError(f"{token!r} needs an attribute")
            attribute = self.next()[1]
            if attribute not in self.names[token]:
                raise TemplateError(f"no attribute {attribute!r}")
            return Field(token, attribute)
        raise TemplateError(f"unknown name {token!r}")

    def next(self):
        if self.at >= len(self.tokens):
            raise TemplateError("ends too early")
        self.at += 1
        return self.tokens[self.at - 1]

    def takes(self, token: str) -> bool:
        if self.at < len(self.tokens) and self.tokens[self.at][1] == token:
            self.at += 1
            return True
        return False


def parse(source: str, filters: dict) -> tuple:
    """The syntax tree of a template."""
    items: list[tuple[str, str]] = []
    at = 0
    for m in _TAGS.finditer(source):
        items.append(("text", source[at : m.start()]))
        items.append(("output", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    items.append(("text", source[at:]))
    place = 0

    def body(names: dict, ends: tuple[str, ...]) -> tuple[tuple, str]:
        nonlocal place
        out: list = []
        while place < len(items):
            kind, value = items[place]
            place += 1
            if kind == "text":
                out.append(Text(value))
            elif kind == "output":
                out.append(Output(_Expression(value, names, filters).whole()))
            elif value.split(" ")[0] in ends:
                return tuple(out), value
            elif m := re.fullmatch(r"for (\w+) in messages", value):
                if "loop" in names:
                    raise TemplateError("loops can't be nested")
                out.append(Loop(m[1], body({m[1]: _MESSAGE, "loop": _LOOP}, ("endfor",))[0]))
            elif value.startswith("if "):
                branches, tag = [], value
                while tag != "endif":
                    test = Const(True) if tag == "else" else _Expression(tag.partition(" ")[2], names, filters).whole()
                    inner, tag = body(names, ("endif",) if tag == "else" else ("elif", "else", "endif"))
                    branches.append((test, inner))
                out.append(If(tuple(branches)))
            elif value == "generation":
                out.append(Generation(body(names, ("endgeneration",))[0]))
            else:
                raise TemplateError(f"unknown tag {value!r}")
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return tuple(out), ""

    return body({}, ())[0]


def fold(node, functions: dict):
    """The tree with constant expressions evaluated, dead branches gone and neighbouring text joined."""
    if isinstance(node, tuple):
        out: list = []
        for child in node:
            child = fold(child, functions)
            for part in child if isinstance(child, tuple) else (child,):
                if isinstance(part, Text) and out and isinstance(out[-1], Text):
                    out[-1] = Text(out[-1].value + part.value)
                elif not (isinstance(part, Text) and not part.value):
                    out.append(part)
        return tuple(out)
    if isinstance(node, Apply):
        operands = tuple(fold(x, functions) for x in node.operands)
        if all(isinstance(x, Const) for x in operands):
            return Const(functions[node.what](*[x.value for x in operands]))
        return Apply(node.what, operands)
    if isinstance(node, Output):
        value = fold(node.value, functions)
        return Text(str(value.value)) if isinstance(value, Const) else Output(value)
    if isinstance(node, If):
        branches = []
        for test, inner in node.branches:
            test = fold(test, functions)
            if isinstance(test, Const) and not test.value:
                continue
            branches.append((test, fold(inner, functions)))
            if isinstance(test, Const):
                break
        if branches and isinstance(branches[0][0], Const):
            return branches[0][1]
        return If(tuple(branches)) if branches else ()
    if isinstance(node, Loop):
        return Loop(node.name, fold(node.body, functions))
    if isinstance(node, Generation):
        return Generation(fold(node.body, functions))
    return node


def value_closure(node, functions: dict) -> Callable[[Scope], object]:
    if isinstance(node, Const):
        return lambda scope: node.value
    if isinstance(node, Field):
        name, attribute = node.name, node.attribute
        return lambda scope: scope[name][attribute]
    operands = [value_closure(x, functions) for x in node.operands]
    if node.what in ("and", "or"):
        a, b = operands
        return (lambda s: a(s) and b(s)) if node.what == "and" else (lambda s: a(s) or b(s))
    function = functions[node.what]
    if len(operands) == 1:
        (a,) = operands
        return lambda scope: function(a(scope))
    a, b = operands
    return lambda scope: function(a(scope), b(scope))


def render_closure(node, functions: dict) -> Render:
    if isinstance(node, tuple):
        parts = [render_closure(x, functions) for x in node]

        def every(scope: Scope, marked: bool) -> Iterator[Piece]:
            for part in parts:
                yield from part(scope, marked)

        return every
    if isinstance(node, Text):

        def fixed(scope: Scope, marked: bool) -> Iterator[Piece]:
            yield node.value, marked

        return fixed
    if isinstance(node, Output):
        value = value_closure(node.value, functions)

        def output(scope: Scope, marked: bool) -> Iterator[Piece]:
            text = str(value(scope))
            if text:  # an empty piece stands for the end of a turn
                yield text, marked

        return output
    if isinstance(node, Generation):
        inner = render_closure(node.body, functions)
        return lambda scope, marked: inner(scope, True)
    if isinstance(node, If):
        branches = [(value_closure(t, functions), render_closure(b, functions)) for t, b in node.branches]

        def choose(scope: Scope, marked: bool) -> Iterator[Piece]:
            for test, inner in branches:
                if test(scope):
                    yield from inner(scope, marked)
                    return

        return choose
    inner, name = render_closure(node.body, functions), node.name

    def loop(scope: Scope, marked: bool) -> Iterator[Piece]:
        messages = iter(scope["messages"])
        message, index = next(messages, None), 0
        while message is not None:
            following = next(messages, None)
            state = {"first": index == 0, "last": following is None, "index0": index}
            yield from inner({name: message, "loop": state}, marked)
            yield "", False
            message, index = following, index + 1

    return loop


class Template:
    """A compiled template.

    ``render`` takes messages, an iterator too, and yields (text, marked); an empty text
    comes at the end of each turn.
    """

    def __init__(self, source: str, controls: tuple[str, ...]):
        self.source, self.controls = source, controls
        whole = "|".join(re.escape(c) for c in sorted(controls, key=len, reverse=True))
        heads = {c[0] for c in controls}
        tails = "|".join(sorted({re.escape(c[1:]) for c in controls}, key=len, reverse=True))
        head = "[" + "".join(re.escape(h) for h in sorted(heads)) + "]"
        self.control = re.compile(whole)
        self._escape = re.compile(rf"({head})(\\*)(?={tails})")
        self._unescape = re.compile(rf"({head})\\(\\*)(?={tails})")
        self._heads = tuple(heads)
        functions = {**_BINARY, **_UNARY, "escape": self.escape}
        self.tree = fold(parse(source, {**_UNARY, "escape": self.escape}), functions)
        self._render = render_closure(self.tree, functions)

    def __reduce__(self):
        return Template, (self.source, self.controls)

    def escape(self, text: str) -> str:
        return self._escape.sub(r"\1\\\2", text) if any(h in text for h in self._heads) else text

    def unescape(self, text: str) -> str:
        return self._unescape.sub(r"\1\2", text) if "\\" in text else text

    def render(self, messages: Iterable[dict]) -> Iterator[Piece]:
        return self._render({"messages": messages}, False)


# The control strings of the template.
CONTROLS = ("<s>", "</s>", "[SYS]", "[/SYS]", "[INST]", "[/INST]", "[ANS]", "[ROLE]", "[TEXT]", "[/TEXT]")
SOURCE = (
    "{% for m in messages %}{% if loop.first %}<s>{% endif %}"
    "{% if m.role == 'system' %}[SYS]{{ m.text | escape }}[/SYS]"
    "{% elif m.role == 'user' %}[INST]{{ m.text | escape }}[/INST]"
    "{% elif m.role == 'assistant' %}[ANS]{% generation %}{{ m.text | escape }}{% endgeneration %}</s>"
    "{% else %}[ROLE]{{ m.role | escape }}[TEXT]{{ m.text | escape }}[/TEXT]{% endif %}{% endfor %}"
)
#: Which control string opens a turn of which role.
OPENS = {"[SYS]": "system", "[INST]": "user", "[ANS]": "assistant"}
CLOSES = ("[/SYS]", "[/INST]", "</s>", "[/TEXT]")
#: Code points after which a part of a formatted conversation ends with the turn.
PART = 1 << 20


def default_template() -> Template:
    return Template(SOURCE, CONTROLS)


def turns_of(formatted: str, template: Template) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn, read back from formatted text of whole turns."""
    role, start = "", 0
    for m in template.control.finditer(formatted):
        control = m.group()
        if control in OPENS:
            role = OPENS[control]
        elif control == "[TEXT]":
            role = template.unescape(formatted[start : m.start()])
        elif control in CLOSES:
            yield role, template.unescape(formatted[start : m.start()])
        start = m.end()


def dealt(conversations: DataFrame) -> DataFrame:
    """Each conversation's turns in one partition, in order."""
    rows = conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return rows.repartition(n_partitions(rows), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def format_conversations(conversations: DataFrame, template: Template | None = None, part: int = PART) -> DataFrame:
    """conv_id, part (from 0), n_turns, formatted and loss: (start, end) code points within the part's text.

    Parts of a conversation stand in one partition, in order.
    """
    template = template or default_template()
    schema = StructType.fromDDL(
        "conv_id long, part int, n_turns long, formatted string, loss array<struct<start:int,end:int>>"
    )
    arrow = arrow_schema(schema)

    def parts(conv_id, messages: Iterator[dict]) -> Iterator[tuple]:
        number = turns = length = 0
        pieces: list[str] = []
        loss: list[dict] = []
        for text, marked in template.render(messages):
            if text:
                if marked:
                    loss.append({"start": length, "end": length + len(text)})
                pieces.append(text)
                length += len(text)
            elif not marked:  # the end of a turn
                turns += 1
                if length >= part:
                    yield conv_id, number, turns, "".join(pieces), loss
                    pieces, loss, number, turns, length = [], [], number + 1, 0, 0
        if pieces or not number:
            yield conv_id, number, turns, "".join(pieces), loss

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for conv_id, rows in groupby(each_row(batches), key=lambda r: r[0]):
            for row in parts(conv_id, ({"role": r[2], "text": r[3]} for r in rows)):
                held.append(row)
                size += len(row[3])
                if size >= 4 * PART or len(held) >= 5_000:
                    yield from as_batches(dict(zip(arrow.names, zip(*held, strict=True), strict=True)), arrow)
                    held, size = [], 0
        if held:
            yield from as_batches(dict(zip(arrow.names, zip(*held, strict=True), strict=True)), arrow)

    return dealt(conversations).mapInArrow(run, schema)


def each_row(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def digests(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """One row for each conversation, read back from its formatted parts.

    Needs the parts of a conversation in one partition and in order, as
    ``format_conversations`` returns them.
    """
    template = template or default_template()
    schema = StructType.fromDDL(
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for conv_id, rows in groupby(each_row(batches), key=lambda r: r[0]):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n_turns = loss_chars = chars = 0
            for _, _, _, text, spans in rows:
                chars += len(text)
                for role, said in turns_of(text, template):
                    n_turns += 1
                    turns.update(f"{role}\n{said}\n".encode())
                for span in spans:
                    under = template.unescape(text[span["start"] : span["end"]])
                    loss_chars += len(under)
                    loss.update(under.encode())
            held.append((conv_id, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
            if len(held) >= 10_000:
                yield from as_batches(dict(zip(arrow.names, zip(*held, strict=True), strict=True)), arrow)
                held = []
        if held:
            yield from as_batches(dict(zip(arrow.names, zip(*held, strict=True), strict=True)), arrow)

    return formatted.mapInArrow(run, schema)


#: The extra conversation that the query formats: texts that look like controls.
EXTRA = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(EXTRA, "conv_id long, turn long, role string, text string")
    return digests(format_conversations(rows.unionByName(extra)))


ORACLE = """
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
), marked AS (
    SELECT *, length(regexp_replace(text, '([<\\[])(\\\\*)(/?s>|/?SYS\\]|/?INST\\]|ANS\\]|ROLE\\]|/?TEXT\\])', '\\1\\\\\\2\\3', 'g')) AS chars
    FROM rows
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    (3 + sum(chars + CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 9
        ELSE 19 + length(role) END))::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""
