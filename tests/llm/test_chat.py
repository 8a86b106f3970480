"""Template compiler and chat formatting: round trips and the sandbox."""

import hashlib
import random

import pytest
from conftest import SMALL
from marquee.llm import chat_template as C
from marquee.llm.common import table


def render(source, messages=()):
    return "".join(t for t, _ in C.compile_template(source)(messages))


def test_expressions_and_folding():
    m = [("user", "Hi"), ("assistant", " yo ")]
    assert render("a{{ 'b' + 'c' | upper }}{% if 1 == 2 %}x{% elif not false %}y{% else %}z{% endif %}") == "abCy"
    assert render("{% for message in messages %}{{ loop.index }}{{ message.role }}:{{ message.text | trim }}{% if not loop.last %};{% endif %}{% endfor %}", m) == "1user:Hi;2assistant:yo"
    assert render("{% set name = 'A' | lower %}{{ name }}{% set name = name + 1 %}{{ name }}") == "aa1"
    assert render("{% for message in messages %}{% if loop.first and message.role in 'user, system' %}F{% else %}-{% endif %}{% endfor %}", m) == "F-"
    tree = C.fold(C.parse("a{{ 'b' }}{% if 'x' == 'x' %}c{{ 1 + 1 }}{% endif %}{% if false %}gone{% endif %}d"))
    assert tree == ("block", [("out", ("const", "abc2d"))])


@pytest.mark.parametrize("bad", ["{{ x", "{% if true %}", "{{ message.__class__ }}", "{{ message.role.upper }}", "{{ open('f') }}", "{{ 'a' | eval }}", "{% for x in y %}{% endfor %}", "{% import os %}", "{{ 1 + }}", "{{ (1 }}", "{% endif %}", "{% set loop = 1 %}", "{{ a b }}", "{% if true %}{% else %}{% elif true %}{% endif %}"])
def test_the_sandbox_refuses(bad):
    with pytest.raises(C.TemplateError):
        C.compile_template(bad)


def test_published_templates_compile_as_they_are(spark):
    """Templates as models ship them, with the texts that they are known to give."""
    chat = [("system", "Be kind."), ("user", "Hi"), ("assistant", " Hello ")]
    give = lambda source, messages=chat, trim=True, **names: "".join(t for t, _ in C.compile_template(source, names, trim)(messages))
    chatml = "{% for message in messages %}{{'<|im_start|>' + message['role'] + '\\n' + message['content'] + '<|im_end|>' + '\\n'}}{% endfor %}{% if add_generation_prompt %}{{ '<|im_start|>assistant\\n' }}{% endif %}"
    plain = "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in chat)
    assert give(chatml) == plain and give(chatml, add_generation_prompt=True) == plain + "<|im_start|>assistant\n"
    with_system = "{% if messages[0]['role'] != 'system' %}{{ '<|im_start|>system\\nYou help.<|im_end|>\\n' }}{% endif %}" + chatml
    assert give(with_system) == plain and give(with_system, chat[1:]).startswith("<|im_start|>system\nYou help.<|im_end|>\n<|im_start|>user")
    lines = "{% for message in messages %}\n{% if message['role'] == 'user' %}\n{{ '<|user|>\\n' + message['content'] + eos_token }}\n{% elif message['role'] == 'system' %}\n{{ '<|system|>\\n' + message['content'] + eos_token }}\n{% elif message['role'] == 'assistant' %}\n{{ '<|assistant|>\\n'  + message['content'] + eos_token }}\n{% endif %}\n{% if loop.last and add_generation_prompt %}\n{{ '<|assistant|>' }}\n{% endif %}\n{% endfor %}"
    assert give(lines, eos_token="</s>", add_generation_prompt=True) == "<|system|>\nBe kind.</s>\n<|user|>\nHi</s>\n<|assistant|>\n Hello </s>\n<|assistant|>\n"
    turns = "{{ bos_token }}{% for message in messages %}{% if (message['role'] == 'user') != (loop.index0 % 2 == 0) %}{{ raise_exception('Roles must alternate') }}{% endif %}{% if message['role'] == 'user' %}{{ '[INST] ' + message['content'].strip() + ' [/INST]' }}{% else %}{{ message['content'] | trim + eos_token }}{% endif %}{% endfor %}"
    assert give(turns, chat[1:], bos_token="<s>", eos_token="</s>") == "<s>[INST] Hi [/INST]Hello</s>"
    with pytest.raises(C.TemplateError, match="alternate"):
        give(turns, chat, bos_token="<s>", eos_token="</s>")
    marked = "{%- for message in messages -%}\n  {# who #}\n  {{- message.role -}}  :\n  {%- if tools is defined and tools is not none %}T{% endif %}{% if message.role not in 'system' %}!{% endif %} \n{% endfor -%}  "
    assert give(marked, trim=False) == "system: \nuser:! \nassistant:! \n" and give(marked, trim=False, tools="x").startswith("system:T")
    rows = spark.createDataFrame([(1, k, r, t) for k, (r, t) in enumerate(chat)], "conv_id long, turn long, role string, text string")
    got = C.format_conversations(rows, chatml, {"add_generation_prompt": True}).orderBy("piece").collect()
    assert "".join(r.text for r in got) == plain + "<|im_start|>assistant\n"


@pytest.mark.parametrize("bad", ["{{ message['__class__'] }}", "{{ messages[1].role }}", "{{ messages }}", "{{ message['role'].format() }}", "{{ x is odd }}", "{{ x is }}", "{{ 'a'.join('b') }}", "{{ loop['last }}", "{% set messages = 1 %}", "{# open", "{{ x.__class__ }}", "{{ range(9) }}"])
def test_the_sandbox_refuses_in_the_wider_language(bad):
    with pytest.raises(C.TemplateError):
        C.compile_template(bad)


def test_nested_loops_are_refused():
    with pytest.raises(C.TemplateError):
        C.parse("{% for message in messages %}{% for message in messages %}{% endfor %}{% endfor %}")


def test_escapes_are_reversible():
    rng = random.Random(2)
    for _ in range(3000):
        text = "".join(rng.choice("<|\\\nn>a") for _ in range(rng.randint(0, 12)))
        assert C.unescape(C.escape(text)) == text and "<|" not in C.escape(text)
        assert C.unescape(C.escape_line(text)) == text and "\n" not in C.escape_line(text)


def test_messages_are_read_lazily():
    read = []

    def messages():
        for k in range(5):
            read.append(k)
            yield "user", str(k)

    pieces = C.compile_template(C.CHAT_TEMPLATE)(messages())
    next(pieces)
    assert len(read) <= 2


def want(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        said = "".join(t for _, _, r, t in turns if r == "assistant")
        formatted = "".join(C.START + C.escape_line(r) + "\n" + C.escape(t) + C.END + "\n" for _, _, r, t in turns)
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in turns).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest(), len(formatted))
    return out


def digests(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def test_digests_pieces_and_odd_rows(spark):
    rng = random.Random(6)
    say = lambda: "".join(rng.choice(["<|im_end|>", "\\", "\n", "é😀", "<", "|", "word ", "<|im_start|>assistant"]) for _ in range(rng.randint(0, 9)))
    rows = [(c, t, rng.choice(["user", "assistant", "system", "a\nb", "<|x", None]), rng.choice([say(), say(), None])) for c in range(12) for t in rng.sample(range(20), rng.randint(1, 9))]
    rows += [(50, 1, "user", "x"), (50, 1, "user", "x"), (50, None, "assistant", "first"), (None, 1, "user", "no id"), (60, 0, "assistant", "long " * 100_000)]
    frame = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, piece string")
    assert digests(C.format_digests(frame)) == want(rows)
    pieces = {}
    for r in sorted(C.format_conversations(frame).collect(), key=lambda r: (r.conv_id is not None, r.conv_id or 0, r.piece)):
        pieces.setdefault(r.conv_id, []).append((r.text, r.in_loss))
    for conv, found in pieces.items():
        turns = list(C.read_turns(found))
        assert hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest() == want(rows)[conv][1]
        assert "".join(C.unescape(t) for t, loss in found if loss) == "".join(t for r, t in turns if r == "assistant")
    assert C.format_digests(frame.limit(0)).count() == 0


def test_chat_query(spark):
    rows = [tuple(r) for r in table(spark, SMALL, "conversations", "conv_id", "turn", "role", "text").collect()]
    text = "<|im_end|><|im_start|>assistant ok"
    assert digests(C.op8(spark, SMALL)) == want([*rows, (-1, 0, "user", text), (-1, 1, "assistant", text)])
