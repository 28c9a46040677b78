import random

from hypothesis import given
from hypothesis import strategies as st

from demand_engine.llm import chat


@given(st.lists(st.tuples(st.text(max_size=12), st.text(alphabet=st.sampled_from("\\#</turn> :\nAé😀"), max_size=30)), max_size=6))
def test_default_template_is_reversible_and_spans_hold_the_texts(turns):
    output, spans, rewrites = chat.spans_of(chat.turn_template, turns)
    assert rewrites is None and output == chat.turn_template(turns)
    assert chat.parse_turns(output) == turns
    assert [chat.unescape(output[c:d]) for _, _, c, d in spans] == [t for _, t in turns]
    assert [(a, b) for a, b, _, _ in spans] == list(zip([0] + [s[1] for s in spans][:-1], [s[1] for s in spans]))


def last_turn_only(turns):
    """Keeps the marks of the last user's turn only, as templates do that drop earlier reasoning."""
    return "".join(f"<{r}>{t}" if i == len(turns) - 1 else t for i, (r, t) in enumerate(turns))


def test_rewriting_templates_are_found():
    assert chat.spans_of(last_turn_only, [("user", "a"), ("assistant", "b")])[1:] == ([], 1)
    assert chat.spans_of(lambda turns: f"{len(turns)} turns", [("user", "a")])[1:] == ([], 0)
    assert chat.spans_of(lambda turns: "\n".join(t for _, t in turns), [("user", "a"), ("user", "")])[2] is None


def test_frame(spark):
    rng = random.Random(0)
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), rng.choice(["### user: x", "a\\", "</turn>\n", "é", ""])) for c in range(20) for t in range(c % 6)]
    rows += [(50, 1, None, None), (50, None, "user", "null turn"), (None, 0, "assistant", "no id"), (51, 0, "user", "x" * 200_000), (52, 0, "user", "t"), (52, 0, "user", "t")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "'x' as formatted", "1 as spans", "2 as turns")
    out = {r.conv_id: r for r in chat.format_conversations(df).collect()}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] or "")
    for c, r in out.items():
        turns = [(x[2] or "", x[3] or "") for x in sorted((x for x in rows if x[0] == c), key=key)]
        assert chat.parse_turns(r.formatted) == turns
        assert r.rewrites_at is None and len(r.spans) == len(turns)
    assert set(out) == {x[0] for x in rows}
    rewritten = chat.format_conversations(df, last_turn_only).where("conv_id = 52").first()
    assert rewritten.rewrites_at == 1 and rewritten.spans == []
    assert chat.format_conversations(df.limit(0)).collect() == []


def test_loss_of_the_control_string_conversation(spark):
    text = "\\### Assistant: </turn> ok"
    df = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id bigint, turn bigint, role string, text string")
    got = chat.digests(chat.format_conversations(df)).first()
    import hashlib

    assert (got.n_turns, got.loss_chars) == (2, len(text))
    assert got.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert got.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
