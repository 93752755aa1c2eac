"""Operator 2: chat formatting with a compiled, sandboxed template.

``compile_template`` parses a small template language into a syntax tree, folds
constants, and turns the tree into Python closures:

    text   {{ expr }}   {# comment #}
    {% for message in messages %} ... {% endfor %}        (once, not nested)
    {% if expr %} ... {% elif expr %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}               (what a loss mask keeps)

Expressions know strings, integers, true/false/none, ``message.role``,
``message.text``, ``message.turn``, ``loop.index`` / ``index0`` / ``first`` /
``last``, the operators ``or and not == != < <= > >= in + ~``, ``a if c else b``,
parentheses and the filters ``escape trim upper lower length``. There are no
calls, no attributes of Python objects and no other names, so a template
cannot reach anything but the message.

Turns are formatted one by one where they are read, so a conversation of any
length is never gathered to be rendered; its turns are written as rows
(conv_id, turn, place, text, loss spans), in order. Only a template that uses
``loop``, or has text around its loop, needs each turn's place in its
conversation; ``rank_within`` gives it. ``digests`` reads the written turns back.
A digest of a whole conversation is a sequential fold by nature: sorted turns
are streamed through it with constant memory, whatever a conversation's length.

Defined cases: null text and null role count as empty; a null conv_id is a
conversation of its own; turns with equal numbers are ordered by role, then
text; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from airlens.operators.ranking import rank_within
from airlens.session import scratch_path

#: Strings with a meaning of their own; inside roles and texts they are escaped.
CONTROLS = ("<|im_start|>", "<|im_sep|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
            "<|endoftext|>", "<|startoftext|>")
TEMPLATE = ("{% for message in messages %}<|im_start|>{{ message.role | escape }}<|im_sep|>"
            "{% if message.role == 'assistant' %}{% generation %}{{ message.text | escape }}{% endgeneration %}"
            "{% else %}{{ message.text | escape }}{% endif %}<|im_end|>{% endfor %}")


# --- escaping -----------------------------------------------------------------
def escaper(controls: Sequence[str]) -> Callable[[str], str]:
    """Doubles every backslash and puts one after the first character of every
    control string, so that none is left and ``unescape`` can undo it."""
    if any("\\" in c or len(c) < 2 for c in controls):
        raise ValueError("control strings have two characters at least and no backslash")
    one = re.compile(r"\\|(?=" + "|".join(map(re.escape, controls)) + r")[\s\S]") if controls else re.compile(r"\\")
    return lambda text: one.sub(lambda m: m[0] + "\\", text)


_PAIR = re.compile(r"\\(\\?)")


def unescape(text: str) -> str:
    return _PAIR.sub(lambda m: m[1], text)


# --- syntax tree -----------------------------------------------------------------
class TemplateError(ValueError):
    pass


_TOKEN = re.compile(r"\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[<>+~|().]))")
_PART = re.compile(r"\{\{(.*?)\}\}|\{%-?(.*?)-?%\}|\{#.*?#\}", re.S)
_FIELDS = {"message": ("role", "text", "turn"), "loop": ("index", "index0", "first", "last")}
_CONSTANTS = {"true": True, "false": False, "none": None}
_ESCAPES = {"n": "\n", "t": "\t", "\\": "\\", "'": "'", '"': '"'}


def _tokens(source: str) -> list[tuple[str, str]]:
    out, at = [], 0
    source = source.strip()
    while at < len(source):
        m = _TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"unexpected {source[at:at + 10]!r} in {source!r}")
        out.append((m.lastgroup, m[m.lastgroup]))
        at = m.end()
    return out


class _Expression:
    """Recursive descent over one expression. Nodes are tuples (kind, ...)."""

    def __init__(self, source: str):
        self.source, self.left = source, _tokens(source)

    def parse(self):
        node = self.choice()
        if self.left:
            raise TemplateError(f"unexpected {self.left[0][1]!r} in {self.source!r}")
        return node

    def accept(self, *words):
        if self.left and self.left[0][0] in ("op", "name") and self.left[0][1] in words:
            return self.left.pop(0)[1]
        return None

    def need(self, word):
        if not self.accept(word):
            raise TemplateError(f"{word!r} is missing in {self.source!r}")

    def choice(self):
        node = self.either()
        if self.accept("if"):
            test = self.either()
            self.need("else")
            node = ("if", test, node, self.choice())
        return node

    def either(self):
        node = self.both()
        while self.accept("or"):
            node = ("or", node, self.both())
        return node

    def both(self):
        node = self.negation()
        while self.accept("and"):
            node = ("and", node, self.negation())
        return node

    def negation(self):
        return ("not", self.negation()) if self.accept("not") else self.comparison()

    def comparison(self):
        node = self.sum()
        while op := self.accept("==", "!=", "<", "<=", ">", ">=", "in"):
            node = (op, node, self.sum())
        return node

    def sum(self):
        node = self.filtered()
        while op := self.accept("+", "~"):
            node = (op, node, self.filtered())
        return node

    def filtered(self):
        node = self.atom()
        while self.accept("|"):
            kind, name = self.left.pop(0) if self.left else ("", "")
            if kind != "name" or name not in ("escape", "trim", "upper", "lower", "length"):
                raise TemplateError(f"unknown filter {name!r}")
            node = ("filter", name, node)
        return node

    def atom(self):
        if self.accept("("):
            node = self.choice()
            self.need(")")
            return node
        kind, word = self.left.pop(0) if self.left else ("", "")
        if kind == "str":
            return ("const", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[0]), word[1:-1]))
        if kind == "int":
            return ("const", int(word))
        if kind == "name" and word in _CONSTANTS:
            return ("const", _CONSTANTS[word])
        if kind == "name" and word in _FIELDS:
            self.need(".")
            field = self.left.pop(0)[1] if self.left else ""
            if field not in _FIELDS[word]:
                raise TemplateError(f"{word} has no {field!r}")
            return ("field", word, field)
        raise TemplateError(f"unexpected {word!r} in {self.source!r}")


_BINARY = {"==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b,
           ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "in": lambda a, b: a in b, "+": lambda a, b: a + b,
           "~": lambda a, b: _text(a) + _text(b)}


def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value).lower() if isinstance(value, bool) else str(value)


def _filters(escape):
    return {"escape": lambda v: escape(_text(v)), "trim": lambda v: _text(v).strip(), "upper": lambda v: _text(v).upper(),
            "lower": lambda v: _text(v).lower(), "length": lambda v: len(_text(v))}


def fold(node, filters):
    """The node with every part that depends on no message replaced by its value."""
    kind = node[0]
    if kind in ("const", "field"):
        return node
    if kind == "filter":
        inner = fold(node[2], filters)
        return ("const", filters[node[1]](inner[1])) if inner[0] == "const" else ("filter", node[1], inner)
    parts = [fold(x, filters) for x in node[1:]]
    if kind == "if" and parts[0][0] == "const":
        return parts[1] if parts[0][1] else parts[2]
    if kind in ("or", "and") and parts[0][0] == "const":
        return parts[1] if bool(parts[0][1]) == (kind == "and") else parts[0]
    if all(p[0] == "const" for p in parts):
        values = [p[1] for p in parts]
        if kind == "not":
            return ("const", not values[0])
        if kind in _BINARY:
            return ("const", _BINARY[kind](*values))
    return (kind, *parts)


def closure(node, filters) -> Callable:
    """A function of (message, loop) for an expression."""
    kind = node[0]
    if kind == "const":
        value = node[1]
        return lambda m, l: value
    if kind == "field":
        name = node[2]
        return (lambda m, l: m[name]) if node[1] == "message" else (lambda m, l: l[name])
    if kind == "filter":
        f, inner = filters[node[1]], closure(node[2], filters)
        return lambda m, l: f(inner(m, l))
    parts = [closure(x, filters) for x in node[1:]]
    if kind == "if":
        test, yes, no = parts
        return lambda m, l: yes(m, l) if test(m, l) else no(m, l)
    if kind == "not":
        return lambda m, l: not parts[0](m, l)
    a, b = parts
    if kind == "or":
        return lambda m, l: a(m, l) or b(m, l)
    if kind == "and":
        return lambda m, l: a(m, l) and b(m, l)
    op = _BINARY[kind]
    return lambda m, l: op(a(m, l), b(m, l))


def parse(source: str) -> list:
    """The template as nested nodes: ("text", s), ("out", expr), ("if", [(test, body)...]), ("gen", body), ("for", body)."""
    root: list = []
    stack: list[tuple[str, list]] = [("", root)]   # open block and where its nodes go
    at = 0

    def text(s):
        if s:
            stack[-1][1].append(("text", s))

    for m in _PART.finditer(source):
        text(source[at:m.start()])
        at = m.end()
        if m[1] is not None:
            stack[-1][1].append(("out", _Expression(m[1]).parse()))
        elif m[2] is not None:
            word, _, rest = m[2].strip().partition(" ")
            if word == "for":
                if rest.split() != ["message", "in", "messages"] or len(stack) > 1 or any(n[0] == "for" for n in root):
                    raise TemplateError("one loop, 'for message in messages', stands at the top")
                body: list = []
                root.append(("for", body))
                stack.append(("for", body))
            elif word == "if":
                branches: list = [(_Expression(rest).parse(), [])]
                stack[-1][1].append(("if", branches))
                stack.append(("if", branches[0][1]))
            elif word in ("elif", "else") and stack[-1][0] == "if":
                stack.pop()
                branches = stack[-1][1][-1][1]
                branches.append((_Expression(rest).parse() if word == "elif" else ("const", True), []))
                stack.append(("if", branches[-1][1]))
            elif word == "generation":
                if any(kind == "generation" for kind, _ in stack):
                    raise TemplateError("generation blocks do not nest")
                body = []
                stack[-1][1].append(("gen", body))
                stack.append(("generation", body))
            elif word in ("endfor", "endif", "endgeneration") and stack[-1][0] == word[3:]:
                stack.pop()
            else:
                raise TemplateError(f"unexpected {m[2].strip()!r}")
    text(source[at:])
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]!r} is not ended")
    return root


def _fold_nodes(nodes: list, filters) -> list:
    out: list = []
    for node in nodes:
        if node[0] == "out":
            e = fold(node[1], filters)
            node = ("text", _text(e[1])) if e[0] == "const" else ("out", e)
        elif node[0] == "gen":
            node = ("gen", _fold_nodes(node[1], filters))
        elif node[0] == "if":
            branches = []
            for test, body in node[1]:
                test = fold(test, filters)
                if test[0] == "const" and not test[1]:
                    continue
                branches.append((test, _fold_nodes(body, filters)))
                if test[0] == "const":
                    break
            if branches and branches[0][0][0] == "const":   # decided: its body stands for it
                out += branches[0][1]
                continue
            if not branches:
                continue
            node = ("if", branches)
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        elif node != ("text", ""):
            out.append(node)
    return out


def _emitter(nodes: list, filters) -> Callable:
    """A function (message, loop, write, spans): writes text, and a span for each generation block."""
    steps = []
    for node in nodes:
        if node[0] == "text":
            steps.append(lambda m, l, w, s, value=node[1]: w(value))
        elif node[0] == "out":
            steps.append(lambda m, l, w, s, f=closure(node[1], filters): w(_text(f(m, l))))
        elif node[0] == "gen":
            def generation(m, l, w, s, inner=_emitter(node[1], filters)):
                start = w.length
                inner(m, l, w, s)
                s.append((start, w.length))
            steps.append(generation)
        else:
            branches = [(closure(t, filters), _emitter(b, filters)) for t, b in node[1]]

            def branch(m, l, w, s, branches=branches):
                for test, body in branches:
                    if test(m, l):
                        return body(m, l, w, s)
            steps.append(branch)
    if len(steps) == 1:
        return steps[0]

    def run(m, l, w, s):
        for step in steps:
            step(m, l, w, s)
    return run


class _Writer:
    def __init__(self):
        self.parts, self.length = [], 0

    def __call__(self, text: str):
        self.parts.append(text)
        self.length += len(text)


def _uses_loop(nodes) -> bool:
    return any(x == "loop" or isinstance(x, (list, tuple)) and _uses_loop(x) for x in nodes)


class Template:
    """A compiled template. ``turn`` renders one message: (text, generation spans in code points)."""

    def __init__(self, source: str, controls: Sequence[str] = CONTROLS):
        filters = _filters(escaper(controls))
        nodes = parse(source)
        at = [i for i, n in enumerate(nodes) if n[0] == "for"]
        if not at:
            raise TemplateError("the template has no loop over messages")
        parts = nodes[:at[0]], nodes[at[0]][1], nodes[at[0] + 1:]
        if any(n[0] == "gen" or n[0] != "text" and "message" in repr(n) for part in (parts[0], parts[2]) for n in part):
            raise TemplateError("messages and generation blocks are used inside the loop only")
        self.before, self.body, self.after = (_fold_nodes(p, filters) for p in parts)
        self.needs_place = bool(self.before or self.after) or _uses_loop(self.body)
        self._emit = [_emitter(p, filters) for p in (self.before, self.body, self.after)]

    def turn(self, message: dict, index0: int = 0, last: bool = False) -> tuple[str, list[tuple[int, int]]]:
        loop = {"index0": index0, "index": index0 + 1, "first": index0 == 0, "last": last}
        w, spans = _Writer(), []
        if index0 == 0 and self.before:
            self._emit[0](message, loop, w, spans)
        self._emit[1](message, loop, w, spans)
        if last and self.after:
            self._emit[2](message, loop, w, spans)
        return "".join(w.parts), spans

    def render(self, messages: Sequence[dict]) -> tuple[str, list[tuple[int, int]]]:
        """A whole conversation."""
        texts, spans, at = [], [], 0
        for i, m in enumerate(messages):
            text, own = self.turn(m, i, i == len(messages) - 1)
            texts.append(text)
            spans += [(a + at, b + at) for a, b in own]
            at += len(text)
        return "".join(texts), spans


def compile_template(source: str, controls: Sequence[str] = CONTROLS) -> Template:
    return Template(source, controls)


# --- on Spark -------------------------------------------------------------------
TURNS = "conv_id long, turn long, place long, formatted string, loss array<struct<start:int,end:int>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def format_turns(conversations: DataFrame, source: str = TEMPLATE, controls: Sequence[str] = CONTROLS) -> DataFrame:
    """One formatted row per turn: conv_id, turn, place (order among equal turn
    numbers and, where the template asks for it, in the conversation), formatted, loss."""
    template = compile_template(source, controls)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    if template.needs_place:
        rows = rank_within(rows, ["conv_id"], ["turn", "role", "text"], out="place")
        last = rows.groupBy(F.col("conv_id").alias("_conv")).agg(F.max("place").alias("_last"))
        rows = rows.join(last, F.col("conv_id").eqNullSafe(F.col("_conv"))).withColumn("last", F.col("place") == F.col("_last"))
    else:
        rows = rows.withColumn("place", F.lit(1).cast("long")).withColumn("last", F.lit(False))

    def format_batches(batches):
        template = compile_template(source, controls)
        for batch in batches:
            cols = {n: batch.column(n).to_pylist() for n in ("role", "text", "turn", "place", "last")}
            done = [template.turn({"role": r, "text": t, "turn": n}, p - 1, l)
                    for r, t, n, p, l in zip(*(cols[c] for c in ("role", "text", "turn", "place", "last")))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), batch.column("place"), pa.array([d[0] for d in done], pa.string()),
                 pa.array([[{"start": a, "end": b} for a, b in d[1]] for d in done], _SPANS)],
                names=["conv_id", "turn", "place", "formatted", "loss"])

    return rows.select("conv_id", "turn", "place", "role", "text", "last").mapInArrow(format_batches, TURNS)


_MARKED = re.compile(r"<\|im_start\|>(.*?)<\|im_sep\|>(.*)<\|im_end\|>", re.S)


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a turn formatted by ``TEMPLATE``."""
    m = _MARKED.fullmatch(formatted)
    if m is None:
        raise ValueError(f"not a formatted turn: {formatted[:80]!r}")
    return unescape(m[1]), unescape(m[2])


DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def digests(turns: DataFrame) -> DataFrame:
    """One row per conversation, from formatted turns as they were written."""
    def parsed(batches):   # order among equal turn numbers is that of role and text
        for batch in batches:
            both = [parse_turn(x) for x in batch.column("formatted").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([b[0] for b in both], pa.string()), pa.array([b[1] for b in both], pa.string())],
                names=[*batch.schema.names, "role", "text"])

    rows = (turns.mapInArrow(parsed, TURNS + ", role string, text string").repartition("conv_id")
                 .sortWithinPartitions("conv_id", "turn", "role", "text"))

    def fold_sorted(batches):
        key, state, done = None, None, []

        def row():
            return (key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "formatted", "loss")]
            for conv_id, role, text, formatted, loss in zip(*cols):
                if state is None or conv_id != key:
                    if state is not None:
                        done.append(row())
                    key, state = conv_id, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                for span in loss:
                    kept = unescape(formatted[span["start"]:span["end"]])
                    state[2] += len(kept)
                    state[3].update(kept.encode())
                state[4] += len(formatted)
            if done:
                yield _digest_batch(done)
                done = []
        if state is not None:
            yield _digest_batch([*done, row()])

    return rows.select("conv_id", "role", "text", "formatted", "loss").mapInArrow(fold_sorted, DIGESTS)


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                      names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def format_table(spark: SparkSession, conversations: DataFrame, source: str = TEMPLATE) -> DataFrame:
    """Write the formatted turns below the shared checkpoint folder, read them back and digest them."""
    out = scratch_path(spark, "chat")
    format_turns(conversations, source).write.parquet(out)
    return digests(spark.read.parquet(out))


#: A conversation made of control strings, formatted along with the table.
PROBE = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def with_probe(conversations: DataFrame) -> DataFrame:
    probe = conversations.sparkSession.createDataFrame(PROBE, "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)


def _sql_controls() -> str:
    return "|".join(["\\\\", *(re.sub(r"([|\[\]])", r"\\\1", c) for c in CONTROLS)])


ORACLE = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')))
SELECT conv_id::BIGINT AS conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(role) + length(text) + len(regexp_extract_all(role, '{_sql_controls()}'))
           + len(regexp_extract_all(text, '{_sql_controls()}'))
           + {len("<|im_start|>") + len("<|im_sep|>") + len("<|im_end|>")})::BIGINT AS formatted_chars
FROM c GROUP BY conv_id"""
