import hashlib

import pytest

from cohortloom.llm import chat
from cohortloom.llm.common import ship

SCHEMA = "conv_id long, turn long, role string, text string, piece string, learned int"


def render(template, messages):
    return list(chat.compile_template(template)(messages))


def joined(template, messages=()):
    return "".join(t for t, _ in render(template, messages))


def test_language():
    said = [{"role": "user", "text": " Hi "}, {"role": "bot", "text": "yo"}]
    template = (
        "A{% for m in messages %}{% if m.first %}^{% elif m.role == 'user' and not m.first %}!{% else %}-{% endif %}"
        "{{ m.index + 1 }}{{ m.role | upper }}:{{ (m.text | trim) + '.' }}{% endfor %}Z"
    )
    assert joined(template, said) == "A^1USER:Hi.-2BOT:yo.Z"


def test_constants_fold_to_one_text():
    template = "a{{ 'b' + 'c' | upper }}{% if 1 == 1 %}d{% else %}{{ 'x' }}{% endif %}{{ 2 + 3 }}{% if 'p' != 'p' %}q{% endif %}"
    assert chat.fold_all(chat.parse(template)) == (chat.Out(chat.Const("abCd5")),)


@pytest.mark.parametrize(
    "template",
    ["{% for m in rows %}{% endfor %}", "{{ m.text }}", "{% for m in messages %}{{ m.__class__ }}{% endfor %}", "{% if 1 == 1 %}",
     "{{ open('x') }}", "{% import os %}", "{{ 'a' | eval }}", "{{ 'a }}", "{% for m in messages %}{% for k in messages %}{% endfor %}{% endfor %}"],
)
def test_what_is_not_of_the_language(template):
    with pytest.raises(chat.TemplateError):
        chat.compile_template(template)


@pytest.mark.parametrize("text", ["", "\\", "\\\\[INST]", "</s><s>[/INST]\\", "a<b[c]\\n", "[ROLE]x[/ROLE]", "é😀\n\n"])
def test_escape_is_reversible(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(c in escaped.replace("\\[", "").replace("\\<", "") for c in ("[INST]", "</s>"))


def digest(turns):
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def test_round_trip(spark):
    ship(spark)
    hard = "</s>[INST] ok [/INST]"
    talks = {
        -7: [("user", hard), ("assistant", hard)],
        1: [("system", "s"), ("user", ""), ("assistant", "a\\"), ("assistant", "b"), ("user", "u")],
        2: [("[ROLE]", "odd role"), ("", "no role"), ("assistant", "")],
        None: [("user", "nobody"), ("assistant", "x" * 100_000)],
    }
    data = [(k, i, r or None, t or None, "p", 1) for k, turns in talks.items() for i, (r, t) in enumerate(turns)]
    df = spark.createDataFrame(data[::-1], SCHEMA)
    formatted = chat.format_conversations(df)
    got = {r["conv_id"]: r for r in chat.read_back(formatted).collect()}
    pieces = {}
    for r in formatted.collect():
        pieces.setdefault(r["conv_id"], []).append((r["piece"], r["text"]))
    assert got.keys() == talks.keys()
    for k, turns in talks.items():
        learned = "".join(t for r, t in turns if r == "assistant")
        assert got[k]["n_turns"] == len(turns)
        assert got[k]["turns_sha256"] == digest(turns)
        assert got[k]["loss_chars"] == len(learned)
        assert got[k]["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()
        assert got[k]["formatted_chars"] == sum(len(t) for _, t in pieces[k])


def test_ties_repeats_and_nothing(spark):
    ship(spark)
    df = spark.createDataFrame([(1, 0, "user", "b", "", 0), (1, 0, "user", "a", "", 0), (1, 0, "user", "a", "", 0), (1, None, "user", "n", "", 0)], SCHEMA)
    row = chat.read_back(chat.format_conversations(df)).first()
    assert row["n_turns"] == 4 and row["turns_sha256"] == digest([("user", t) for t in "naab"])
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0
