"""Chat formatting: exact round trips, spans, rewriting templates, SQL."""

from __future__ import annotations

import hashlib
import sys

import pytest
from pyspark import cloudpickle

from contrail.llm import chat
from contrail.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"
KEY = "op8_incremental_chat_rendering"


@pytest.mark.parametrize("text", ["", "</s>", "[INST] a [/INST]", "\\b\\l\\\\", "\\", "a\nb", "é[<\\", "</s" * 3])
def test_escape_round_trip(text):
    assert chat.unescape(chat.escape(text)) == text
    turns = [(text, text), ("user", text)]
    assert chat.read_back(chat.marked_template(turns)) == turns


def test_spans_are_the_texts():
    turns = [("user", "</s>"), ("assistant", "x</s>"), ("assistant", ""), ("system", "[")]
    found = chat.Located(chat.marked_template, [], turns)
    assert not found.rewrites and "".join(p for p, _, _ in found.parts) == chat.marked_template(turns)
    assert [chat.unescape(p[a:b]) for p, a, b in found.parts] == [t for _, t in turns]


def test_rewriting_templates_are_detected():
    def drops_old_thoughts(messages, opening=None):
        out = [f"<{r}>{t if k == len(messages) - 1 else t.split('|')[-1]};" for k, (r, t) in enumerate(messages)]
        return "".join(out) + (f"<{opening}>" if opening is not None else "")

    assert chat.Located(drops_old_thoughts, [], [("a", "think|x"), ("u", "y")]).rewrites
    assert not chat.Located(drops_old_thoughts, [], [("a", "x"), ("u", "y")]).rewrites

    def only_last(messages, opening=None):
        return f"{messages[-1][1] if messages else ''}{opening or ''}"

    assert chat.Located(only_last, [], [("a", "x"), ("u", "y")]).rewrites


def test_other_black_box_template():
    def chatml(messages, opening=None):
        out = "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in messages)
        return "<bos>" * bool(messages or opening) + out + (f"<|im_start|>{opening}\n" if opening is not None else "")

    turns = [("user", "hi"), ("assistant", "hello\n"), ("user", "")]
    found = chat.Located(chatml, [], turns)
    assert [p[a:b] for p, a, b in found.parts] == [t for _, t in turns] and not found.rewrites


def expected(rows):
    turns = loss = b""
    for role, text in rows:
        turns += f"{role or ''}\n{text or ''}\n".encode()
        loss += (text or "").encode() * (role == "assistant")
    return len(rows), hashlib.sha256(turns).hexdigest(), len(loss.decode()), hashlib.sha256(loss).hexdigest()


def test_edges_and_blocks(spark):
    long = [("user" if i % 2 else "assistant", f"t{i} [") for i in range(70)]
    rows = [(1, i, r, t, 0) for i, (r, t) in enumerate(long)]
    rows += [(2, None, "user", None, 0), (2, 0, None, "x", 0), (2, 0, None, "x", 0), (None, 1, "assistant", "n", 0)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, block int")
    for size in (1, 7, 64):
        out = chat.digest_conversations(chat.format_conversations(df, block=size)).collect()
        got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in out}
        assert len(out) == 3 and not any(r.rewrites_history for r in out)
        assert got == {1: expected(long), 2: expected([("user", None), (None, "x"), (None, "x")]),
                       None: expected([("assistant", "n")])}
    assert chat.digest_conversations(chat.format_conversations(df.limit(0))).count() == 0


def numbered(messages, opening=None):
    out = "".join(f"#{k} {r}: {t}\n" for k, (r, t) in enumerate(messages))
    return out + (f"#{len(messages)} {opening}: " if opening is not None else "")


def truncating(messages, opening=None):
    """Keeps the first turn and the last hundred."""
    kept = messages if len(messages) <= 101 else [messages[0], *messages[-100:]]
    return "".join(f"<{r}>{t};" for r, t in kept) + (f"<{opening}>" if opening is not None else "")


def forgets_thoughts(messages, opening=None):
    out = "".join(f"<{r}>{t if k == len(messages) - 1 else t.split('|')[-1]};" for k, (r, t) in enumerate(messages))
    return "<bos>" + out + (f"<{opening}>" if opening is not None else "")


def with_bos(messages, opening=None):
    return "<bos>" * bool(messages or opening is not None) + chat.marked_template(messages, opening)


LONG = [("assistant" if i % 2 else "user", f"t{i} {i * 7 % 10}") for i in range(200)]


def formatted(spark, turns, **options):
    cloudpickle.register_pickle_by_value(sys.modules[__name__])   # workers do not have this file
    df = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(turns)],
                               "conv_id long, turn long, role string, text string")
    return chat.format_conversations(df, **options).orderBy("block").collect()


def texts(blocks):
    return [b.formatted[s.text_start:s.text_end] for b in blocks for s in b.spans]


def test_long_conversations_of_templates_with_memory(spark):
    out = formatted(spark, LONG, render=numbered)
    assert "".join(b.formatted for b in out) == numbered(LONG) and texts(out) == [t for _, t in LONG]
    assert not any(b.rewrites_history for b in out)
    out = formatted(spark, LONG, render=with_bos)
    assert len(out) == 4 and "".join(b.formatted for b in out) == with_bos(LONG)
    assert [chat.unescape(t) for t in texts(out)] == [t for _, t in LONG]
    out = formatted(spark, LONG, render=with_bos, independent=True)
    assert len(out) == 4 and "".join(b.formatted for b in out) == with_bos(LONG)


def test_rewritten_history_returns_the_final_rendering(spark):
    out = formatted(spark, LONG, render=truncating)
    assert len(out) == 1 and out[0].rewrites_history and out[0].formatted == truncating(LONG)
    kept = [0, *range(100, 200)]
    assert [t for t in texts(out) if t] == [LONG[k][1] for k in kept]
    assert [s.text_end > s.text_start for s in out[0].spans] == [k in kept for k in range(200)]
    turns = [("a", "think|x"), ("u", "y;"), ("a", "more|z"), ("u", "")]
    out = formatted(spark, turns, render=forgets_thoughts)
    assert len(out) == 1 and out[0].formatted == forgets_thoughts(turns) and out[0].rewrites_history
    assert texts(out) == ["x", "y;", "z", ""]
    assert [out[0].formatted[s.start:s.end] for s in out[0].spans] == ["<bos><a>x;", "<u>y;;", "<a>z;", "<u>;"]


@pytest.mark.parametrize("render", [numbered, forgets_thoughts, truncating])
def test_broken_promise_is_an_error(render):
    turns = [(1, r, t + "|" + t) for r, t in LONG]
    with pytest.raises(ValueError, match="not independent"):
        list(chat._blocks(iter(turns), render, 128, 2, True))


def test_query_equals_sql(spark):
    from oracle_harness import compare
    problems, n, _ = compare(spark, KEY, QUERIES[KEY], ORACLE[KEY], SMALL)
    assert not problems and n > 10
