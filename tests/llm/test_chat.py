"""The template language, escaping, and conversations formatted and read back."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tierlake.llm.chat_format import format_conversations, read_conversations
from tierlake.llm.chat_template import CONTROLS, TEMPLATE, Node, TemplateError, compile_template, escape, fold, parse, read_turns, unescape

pieces = st.lists(st.sampled_from([*CONTROLS, "\\", "<", "[", "s>", "/", "INST]", "x", "\n", "é"]), max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(pieces)
def test_escaped_text_has_no_control_string(text):
    hidden = escape(text)
    assert unescape(hidden) == text and not any(c in hidden for c in CONTROLS)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "[END]"]), pieces), max_size=6))
def test_turns_are_read_back(turns):
    out = list(compile_template(TEMPLATE)({"role": r, "text": t} for r, t in turns))
    assert read_turns("".join(p for p, _ in out)) == turns
    assert [unescape(p) for p, masked in out if masked] == [t for r, t in turns if r == "assistant" and t]


def render(template, *messages):
    return "".join(p for p, _ in compile_template(template)([{"role": r, "text": t} for r, t in messages]))


def test_language():
    shown = "{% for m in messages %}{{ loop.index0 }}{% if loop.first and not loop.last %}<{% elif loop.last %}>{% else %}-{% endif %}{% endfor %}"
    assert render(shown, *[("user", "")] * 3) == "0<1-2>"
    assert render("{{ 'a' ~ \"b\" | upper ~ ('c' | upper) }}{% if 1 == 2 or 'x' != 'y' %}y{% else %}n{% endif %}") == "aBCy"
    assert render("{% for m in messages %}{{ m.text | trim | lower }};{% endfor %}", ("a", " X "), ("b", "Y")) == "x;y;"
    assert render("{{ unknown }}{{ m.text }}plain { } % text") == "plain { } % text"


def test_constants_are_folded():
    tree = fold(parse("a{{ 'b' ~ ('c' | upper) }}{% if 'x' == 'y' %}no{% else %}d{% endif %}"))
    assert tree == Node("block", (Node("show", (Node("constant", ("abCd",)),)),))


@pytest.mark.parametrize(
    "template",
    ["{% if x %}", "{% endif %}", "{{ x.__class__ }}", "{{ x() }}", "{{ x | open }}", "{% for x %}{% endfor %}", "{{ 'a }}", "{% import os %}",
     "{{ (x }}", "{{ }}", "{{ x[0] }}", "{% for a in b %}{% endif %}"],
)
def test_nothing_else_is_allowed(template):
    with pytest.raises(TemplateError):
        compile_template(template)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_conversations_of_any_kind(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST] \\ x"), (1, 1, "assistant", "</s>[INST] \\ x"), (1, None, "system", "first"),
        (2, 0, "assistant", None), (2, 1, None, "no role"), (2, 2, "user", "z" * 200_000), (2, 3, "assistant", "y\U0001f600" * 90_000),
        (None, 0, "user", "a"), (None, 1, "assistant", "b"), (3, 0, "tool", ""),
    ]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, chunk string")
    by_id = defaultdict(list)
    for row in sorted(rows, key=lambda r: (r[1] is not None, r[1], r[2] or "", r[3] or "")):
        by_id[row[0]].append((row[2] or "", row[3] or ""))
    expected = {}
    for key, turns in by_id.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        expected[key] = (len(turns), sha("".join("{}\n{}\n".format(*t) for t in turns)), len(loss), sha(loss))
    formatted = format_conversations(frame)
    found = {r["conv_id"]: tuple(r)[1:5] for r in read_conversations(formatted).collect()}
    assert found == expected
    texts = defaultdict(str)
    for row in sorted(formatted.collect(), key=lambda r: (str(r["conv_id"]), r["nth"])):
        assert row["start"] == len(texts[row["conv_id"]])
        texts[row["conv_id"]] += row["chunk"]
    assert read_turns(texts[2]) == by_id[2]
    assert read_conversations(format_conversations(frame.limit(0))).collect() == []


def test_a_template_without_a_loop_ends(spark):
    frame = spark.createDataFrame([(k, 0, "user", "x") for k in range(5)], "conv_id long, turn long, role string, text string")
    assert sorted((r["conv_id"], r["chunk"]) for r in format_conversations(frame, "hello").collect()) == [(k, "hello") for k in range(5)]
