import random
import re
import string

from demand_engine.llm.decontaminate import contamination

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    windows = {}
    for item, text in items:
        ws = words(text)
        n = min(10, len(ws))
        for i in range(len(ws) - n + 1 if n else 0):
            windows.setdefault(tuple(ws[i : i + n]), set()).add(item)
    out = {}
    for doc, text in docs:
        ws, hit, found = words(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(ws) - n + 1):
                if tuple(ws[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(ws[i : i + n])]
        out[doc] = (len(ws), len(hit), sorted(str(i) for i in found if i is not None))
    return out


def check(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r.doc_id: r for r in contamination(d, b).collect()}
    assert {k: (r.n_words, r.n_hit, list(r["items"])) for k, r in got.items()} == brute(docs, items)
    assert all(r.contaminated == (r.n_hit > 0) and r.n_items == len(r["items"]) for r in got.values())


def test_equals_brute_force(spark):
    rng = random.Random(3)
    vocabulary = ["the", "of", "ä", "x1", "é2", *("".join(rng.choices("abc", k=2)) for _ in range(12))]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 2, 4, 7, 9, 10, 11, 25])))) for k in range(25)]
    docs = []
    for k in range(60):
        parts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 40)))]
        if rng.random() < 0.6:
            ws = words(rng.choice(items)[1])
            lo = rng.randrange(len(ws) + 1)
            parts += [", ".join(ws[lo : lo + rng.randint(5, 30)]).upper(), " ".join(rng.choices(vocabulary, k=5))]
        docs.append((k, "\n".join(parts)))
    check(spark, docs, items)


def test_window_repeats_and_overlaps(spark):
    item = " ".join(f"w{i}" for i in range(14))
    docs = [(1, f"{item} {item} w3"), (2, "w0 w1 w2 w3 w4 w5 w6 w7 w8"), (3, item.replace(" ", ".")), (4, "a a a a"), (5, "x")]
    check(spark, docs, [(1, item), (2, item + " tail"), (3, "a a"), (10, item)])


def test_edge_rows_and_clashing_columns(spark):
    long = " ".join(f"v{i}" for i in range(50_000))
    docs = [(1, None), (2, ""), (3, "--- !!!"), (4, long + " p q r s t u v w x y")]
    items = [(1, None), (2, ""), (3, "p q r s t u v w x y z"), (4, "p q r s t u v w x y"), (None, "q r")]
    check(spark, docs, items)
    d = spark.createDataFrame([(1, "a b c", "x", "y", "z")] * 2, "doc_id bigint, text string, window string, row_id string, shingle string")
    b = spark.createDataFrame([(7, "b c", "x", "y")] * 2, "item_id bigint, text string, doc_id string, n string")
    assert [(r.n_hit, r["items"]) for r in contamination(d, b).collect()] == [(2, ["7"])] * 2
    assert [r.n_hit for r in contamination(d, b.limit(0)).collect()] == [0, 0]
    assert contamination(d.limit(0), b).collect() == []
