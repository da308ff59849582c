import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from scoremill.llm import chat_format as C

TURNS = "conv_id long, turn long, role string, text string, formatted string"


@given(st.text(alphabet="<|\\>im_end\n a"))
def test_escapes_are_reversible(text):
    assert C.unescape(C.escape(text)) == text
    assert C.unescape_line(C.escape_line(text)) == text
    assert "<|" not in C.escape(text) and "\n" not in C.escape_line(text)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a\nb", ""]), st.text(alphabet="<|\\>im_endstart \n")), max_size=5))
def test_read_back(turns):
    text, spans = C.compiled(C.TEMPLATE)({"turns": [{"role": r, "text": t} for r, t in turns]})
    assert list(C.turns_of(text)) == turns
    assert [C.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


@pytest.mark.parametrize(
    ("source", "scope", "expected"),
    [
        ("a{{ 1 + 2 }}b", {}, "a3b"),
        ("{% if x == 'y' and not z %}1{% elif x %}2{% else %}3{% endif %}", {"x": "y"}, "1"),
        ("{% if x == 'y' %}1{% elif x %}2{% else %}3{% endif %}", {"x": "q"}, "2"),
        ("{% for i in xs %}{{ loop.index0 }}{{ i.k | upper }}{% if loop.last %}!{% endif %}{% endfor %}", {"xs": [{"k": "a"}, {"k": "b"}]}, "0A1B!"),
        ("{% set a = 'x' %}{{ a ~ a['b'] }}", {}, None),
        ("  {%- if true -%}  t  {%- endif -%}  ", {}, "t"),
        ("{{ missing }}{{ none }}", {}, ""),
    ],
)
def test_language(source, scope, expected):
    if expected is None:
        with pytest.raises(C.TemplateError):
            C.compiled(source)(scope)
    else:
        assert C.compiled(source)(scope)[0] == expected


@pytest.mark.parametrize("source", ["{{ x.__class__ }}", "{{ x[0][0] }}"])
def test_sandbox_knows_no_attributes(source):
    with pytest.raises(C.TemplateError):
        C.compiled(source)({"x": 5})


@pytest.mark.parametrize("source", ["{{ f() }}", "{% for x in %}", "{% if a %}", "{{ 'a' | nofilter }}", "{% import os %}", "{{ }}", "{% endif %}"])
def test_bad_templates_are_refused(source):
    with pytest.raises(C.TemplateError):
        C.compiled(source)


def test_constants_fold():
    assert C.fold_constants(C.parse("a{{ 'b' + 'c' }}{% if false %}x{% endif %}{% if 1 == 1 %}d{% endif %}")) == (
        "block", ("print", ("const", "abcd")))


def test_conversations(spark):
    rows = [
        (1, 1, "assistant", "<|im_end|>"), (1, 0, "user", "hi"), (1, None, "system", None), (2, 0, None, ""),
        (2, 0, None, ""), (None, 3, "assistant", "x" * 100_000),
    ]
    frame = spark.createDataFrame([(*r, "other") for r in rows], TURNS)
    out = {r["conv_id"]: r for r in C.read_back(C.render_conversations(frame)).collect()}
    turns = "system\n\nuser\nhi\nassistant\n<|im_end|>\n"
    assert out[1]["turns_sha256"] == hashlib.sha256(turns.encode()).hexdigest()
    assert (out[1]["n_turns"], out[1]["loss_chars"], out[2]["n_turns"], out[None]["loss_chars"]) == (3, 10, 2, 100_000)
    assert C.read_back(C.render_conversations(frame.limit(0))).count() == 0
