"""The template language, and formatting read back."""

import hashlib

import pytest

from sparkrank.llm import chat


def render(source, turns):
    return "".join(text for text, _ in chat.Template(source).render(iter(turns)))


def test_constants_are_folded():
    tree = chat.fold_block(chat.parse("a{{ 'b' ~ 1 + 2 }}{% if 1 < 2 and not false %}c{% else %}d{% endif %}{{ 'X' | lower }}"))
    assert tree == [("text", "ab3cx")]


def test_statements():
    source = "{% set sep = ';' %}{% for m in messages %}{{ m.index }}{% if m.first %}<{% elif m.last %}>{% endif %}{{ m.content | trim }}{{ sep }}{% endfor %}"
    assert render(source, [("u", " a "), ("u", "b"), ("u", "c")]) == "0<a;1b;2>c;"


@pytest.mark.parametrize("source", ["{{ m.__class__ }}", "{{ open('x') }}", "{% for x in y %}{% endfor %}", "{% if 1 %}", "{{ 'a' | eval }}", "{{ }}", "{% import os %}"])
def test_the_rest_is_refused(source):
    with pytest.raises(chat.TemplateError):
        chat.Template(source)


LOOP = "{%% for m in messages %%}%s{%% endfor %%}"


@pytest.mark.parametrize(
    "source",
    [
        "{{ q.role }}", LOOP % "{{ q.role }}", LOOP % "" + "{{ m.role }}", LOOP % "{{ m }}", "{{ messages }}", "{{ in }}",
        LOOP % "{{ m.index + 'a' }}", LOOP % "{{ m.content - 1 }}", "{{ 'a' + 'b' }}", LOOP % "{% if m.role < 1 %}{% endif %}", "{{ none < 1 }}",
        "{{ 1 % 0 }}", "{% if false %}{{ 1 % 0 }}{% endif %}", "{{ 9999999999 * 9999999999 }}", "{{ " + "9" * 5000 + " }}",
        "{% set = 1 %}", "{% set 1a = 1 %}", "{% set true = 1 %}", "{% set messages = 1 %}", LOOP % "{% set m = 1 %}", LOOP % (LOOP % ""), "{% set a %}",
        "{% for true in messages %}{% endfor %}", "{% generation x %}{% endgeneration %}", "{% if 1 %}{% else 2 %}{% endif %}", "{% if 1 %}{% endif 2 %}",
        "{{ 'a'", "{% if 1", "{{ " + "(" * 5000 + "1" + ")" * 5000 + " }}", "{{ " + "not " * 5000 + "1 }}",
    ],
)
def test_faults_show_when_compiled(source):
    with pytest.raises(chat.TemplateError):
        chat.Template(source)


@pytest.mark.parametrize("source", ["{{ x + 1 }}", "{% set x = 0 %}{{ 5 % x }}", "{% set x = 'a' %}{{ x * 2 }}", "{% set x = 'a' %}{% if x < 1 %}{% endif %}", "{% set x = 99999999999 %}{{ x * x }}"])
def test_faults_of_values_show_when_rendered(source):
    template = chat.Template(source)
    with pytest.raises(chat.TemplateError):
        list(template.render(iter([])))


def test_names_without_a_value_show_nothing():
    assert render("[{{ x }}{{ none | trim }}{{ x | length }}]{% if x %}y{% endif %}}}", []) == "[0]}}"
    assert render("{% set n = 0 %}" + LOOP % "{% set n = n + m.index %}" + "{{ n }}{{ 7 % 4 - 1 }}", [("u", "")] * 4) == "62"


@pytest.mark.parametrize("text", ["", "</s>[INST] ok [/INST]", "<\\<<[\\[", "[OUT]</s><s>[INST] ", "a\n[END]", " x ", "\\"])
def test_turns_come_back(text):
    turns = [("user", text), ("assistant", text), (text, text), ("system", text)]
    assert list(chat.read_turns(render(chat.TEMPLATE, turns))) == turns


def test_odd_rows(spark):
    rows = [
        (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (1, 1, "assistant", "x\U0001f600[y" * 3), (1, 2, "assistant", "</s>"),
        (None, 1, "assistant", ""), (2, 5, "assistant", "long " * 30_000), (2, 4, "assistant", "l<ng " * 30_000),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as part", "2 as formatted", "3 as spans")
    formatted = chat.format_conversations(turns, part_chars=1000)
    got = {r.conv_id: r for r in chat.digests(formatted).collect()}
    assert set(got) == {1, 2, None} and formatted.count() == 4  # the long one has two parts
    for conv_id, row in got.items():
        own = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv_id))
        loss = "".join(x for _, _, r, x in own if r == "assistant")
        assert row.n_turns == len(own)
        assert row.turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, _, r, x in own).encode()).hexdigest()
        assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.digests(chat.format_conversations(turns.filter("false"))).count() == 0
