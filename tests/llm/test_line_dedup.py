import random

from demand_engine.llm.line_dedup import drop_recurring_lines

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()


def prose(k, n=20):
    return " ".join(f"{WORDS[(k * 7 + i * (k + 3)) % 10]}{chr(97 + (k * 5 + i) % 26)}" for i in range(n))


def run(spark, rows, schema="doc_id bigint, text string"):
    return {r.doc_id: r for r in drop_recurring_lines(spark.createDataFrame(rows, schema)).collect()}


def test_a_line_among_different_neighbours_goes(spark):
    passage = prose(99, 60)
    rows = [(k, f"{prose(k)}\n{passage}\n{prose(k + 40)}") for k in range(5)]
    for k, r in run(spark, rows).items():
        assert (r.text, r.n_lines, r.n_dropped) == (f"{prose(k)}\n{prose(k + 40)}", 3, 1)


def test_copies_stay_whole(spark):
    text = f"{prose(1)}\n{prose(2)}\n{prose(3)}"
    got = run(spark, [(k, text) for k in range(20)])
    assert all(r.text == text and r.n_dropped == 0 for r in got.values())


def test_variable_fields_are_generalised(spark):
    rows = [(k, f"{prose(k)}\nPage {k} of {k + 9}, printed on day {k * 3}\n{prose(k + 40)}") for k in range(5)]
    assert all(r.n_dropped == 1 for r in run(spark, rows).values())
    head, tail = prose(70, 12), prose(71, 6)
    rows = [(k, f"{prose(k)}\n{head} {prose(k + 200, 2)} {tail}\n{prose(k + 40)}") for k in range(5)]
    assert all(r.n_dropped == 1 for r in run(spark, rows).values())


def test_short_and_rare_lines_stay(spark):
    rows = [(k, f"{prose(k)}\nthe end\n{prose(k + 40)}") for k in range(5)]
    assert all(r.n_dropped == 0 for r in run(spark, rows).values())
    rows = [(k, f"{prose(k)}\n{prose(99)}\n{prose(k + 40)}") for k in range(2)]
    assert all(r.n_dropped == 0 for r in run(spark, rows).values())


def test_edge_rows_and_clashing_columns(spark):
    passage = prose(99, 60)
    rows = [(k, f"{prose(k)}\n{passage}\n{prose(k + 40)}", "a", "b", "c") for k in range(4)]
    rows += [(50, None, None, "x", "y"), (51, "", "a", None, "y"), (52, "\n\n", "a", "x", None), (0, *rows[0][1:]), (None, rows[1][1], "n", "n", "n")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, template string, place string, _id string")
    got = drop_recurring_lines(df.withColumnRenamed("_id", "line_no")).collect()
    assert len(got) == len(rows)
    assert {"template", "place", "line_no"} <= set(got[0].asDict())
    by = {(r.doc_id, r.text) for r in got}
    assert (50, None) in by and (51, "") in by and (52, "\n\n") in by
    assert sum(r.n_dropped for r in got) == 6
    assert drop_recurring_lines(df.limit(0)).collect() == []


def own_line(rng):
    return " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(8))


def test_a_passage_goes_beside_a_large_group_of_near_copies(spark):
    rng = random.Random(0)
    passage = own_line(rng)
    texts = [[own_line(rng) for _ in range(4)] + [passage] + [own_line(rng) for _ in range(4)] for _ in range(300)]
    for _ in range(1000):
        copy = list(texts[0])
        copy[rng.choice([0, 1, 2, 3, 5, 6, 7, 8])] = own_line(rng)
        texts.append(copy)
    for k, r in run(spark, [(k, "\n".join(t)) for k, t in enumerate(texts)]).items():
        assert r.text == "\n".join(x for x in texts[k] if x != passage)


def test_blocks_of_several_lines_go_whole(spark):
    rng = random.Random(1)
    for n_block, n_own in ((2, 2), (3, 2), (5, 5), (10, 5), (20, 5)):
        block = [own_line(rng) for _ in range(n_block)]
        own = [[own_line(rng) for _ in range(n_own)] for _ in range(60)]
        for k, r in run(spark, [(k, "\n".join([*x[:1], *block, *x[1:]])) for k, x in enumerate(own)]).items():
            assert (r.text, r.n_dropped) == ("\n".join(own[k]), n_block)
