"""Chat templates: compiler, escaping, and the formatted table against a plain rendering."""

import hashlib

import pytest
from hypothesis import given, settings, strategies as st

from airlens.llm import chat

PARTS = ["\\", "<", "|", "im_start", "|>", "<|im_end|>", "<|im_sep|>", "</s>", "<s>", "[INST]", "[/INST]", "a", "\n", "é", "<<SYS>>", "<s<s>"]
TEXT = st.lists(st.sampled_from(PARTS), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_escaping_is_reversible_and_complete(text):
    safe = chat.escaper(chat.CONTROLS)(text)
    assert chat.unescape(safe) == text
    assert not any(c in safe for c in chat.CONTROLS)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "<|im_sep|>", ""]), TEXT), max_size=5))
def test_formatted_turns_read_back(turns):
    t = chat.compile_template(chat.TEMPLATE)
    text, spans = t.render([{"role": r, "text": x, "turn": i} for i, (r, x) in enumerate(turns)])
    pieces = [p for p in text.split("<|im_start|>")[1:]]
    assert [chat.parse_turn("<|im_start|>" + p) for p in pieces] == turns
    assert "".join(chat.unescape(text[a:b]) for a, b in spans) == "".join(x for r, x in turns if r == "assistant")


def test_language_and_constant_folding():
    t = chat.compile_template("{# note #}<s>{% for message in messages %}{% if 1 + 1 == 2 and not false %}{{ 'A' ~ 'b' | upper }}{% else %}no{% endif %}"
                              "{{ message.role | upper if loop.first else message.text | trim }}{% if not loop.last %}, {% endif %}{% endfor %}!")
    assert t.body[0] == ("text", "AB") and t.needs_place
    assert t.render([{"role": "u", "text": " x ", "turn": 0}, {"role": "v", "text": " y ", "turn": 1}])[0] == "<s>ABU, ABy!"
    plain = chat.compile_template(chat.TEMPLATE)
    assert not plain.needs_place


@pytest.mark.parametrize("source", [
    "no loop", "{% for message in messages %}", "{% for x in messages %}{% endfor %}", "{% for message in messages %}{{ message.__class__ }}{% endfor %}",
    "{% for message in messages %}{{ open('x') }}{% endfor %}", "{% for message in messages %}{{ message.text | shell }}{% endfor %}",
    "{% for message in messages %}{% generation %}{% generation %}{% endgeneration %}{% endgeneration %}{% endfor %}",
    "{{ message.text }}{% for message in messages %}{% endfor %}", "{% for message in messages %}{% endif %}{% endfor %}",
    "{% for message in messages %}{{ import os }}{% endfor %}", "{% for message in messages %}{{ 1 + }}{% endfor %}"])
def test_nothing_else_is_let_in(source):
    with pytest.raises(chat.TemplateError):
        chat.compile_template(source)


ROWS = [(1, 0, "user", "hi"), (1, 1, "assistant", "a</s>\\"), (1, 2, "assistant", None), (2, 0, None, "x"), (None, 0, "user", "n"),
        (3, 5, "assistant", "tie b"), (3, 5, "assistant", "tie a"), (3, 5, "assistant", "tie a"), (4, 0, "user", "long " * 30000)]


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(((t, r or "", x or "") for c, t, r, x in rows if c == conv))
        text = "".join(f"<|im_start|>{chat.escaper(chat.CONTROLS)(r)}<|im_sep|>{chat.escaper(chat.CONTROLS)(x)}<|im_end|>" for _, r, x in own)
        loss = "".join(x for _, r, x in own if r == "assistant")
        out[conv] = (len(own), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest(), len(loss),
                     hashlib.sha256(loss.encode()).hexdigest(), len(text))
    return out


def test_table_matches_plain_rendering(spark):
    hot = [(9, i, "assistant" if i % 2 else "user", f"turn {i} [INST]") for i in range(700)]
    rows = ROWS + hot
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, place int, loss string").repartition(5)
    got = {r.conv_id: tuple(r)[1:] for r in chat.format_table(spark, chat.with_probe(df)).collect()}
    assert got == expected(rows + list(chat.PROBE))


def test_empty_table_and_template_with_places(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_table(spark, none).count() == 0
    df = spark.createDataFrame([(1, 3, "user", "b"), (1, 1, "user", "a"), (2, 0, "user", "c")], none.schema)
    source = "<s>{% for message in messages %}{{ loop.index }}{{ message.text }}{% if loop.last %}.{% endif %}{% endfor %}</s>"
    got = {(r.conv_id, r.place): r.formatted for r in chat.format_turns(df, source).collect()}
    assert got == {(1, 1): "<s>1a", (1, 2): "2b.</s>", (2, 1): "<s>1c.</s>"}
