import hashlib
from collections import Counter

import numpy as np
import pytest

from demand_engine.llm import alignment, queries
from demand_engine.llm.common import table

from .conftest import SF_DIR

ODD = [
    None, "", " ", "  ", "a", " a  b\n c\t", "trail  ", "x▁y", "▁", "a▁ b", "<|endoftext|> <s></s> <unk> <0x41>", "ﬁ é é ½ ｱ",
    "日本語 текст 🙂🙂", "﻿a​\x00\r\n", "a" * 3000, "word " * 2000, "don't we'll THEY'RE 12345 1,000.5", " nb sp", "tab\t\tend\n\n",
]


def encoders():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(alignment.A_FILE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.B_FILE)


def spelled(a, b):
    """Bytes per id, from the tokenizers' own names of their tokens."""
    printable = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace() and b != 0xAD]
    back = {chr(b): b for b in printable}
    for k, x in enumerate(x for x in range(256) if x not in printable):
        back[chr(256 + k)] = x
    names_a = {i: bytes(back[c] for c in a.id_to_token(i)) for i in range(50256)}
    names_b = {}
    for i in range(b.get_piece_size()):
        p = b.id_to_piece(i)
        names_b[i] = bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode()
    return names_a, names_b


def brute(texts):
    """Per text its groups and links, by sets of ends."""
    a, b = encoders()
    names = spelled(a, b)
    out = []
    for t in texts:
        if not t:
            out.append(([], [], 0, 0))
            continue
        ids = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
        if any(b"".join(n[i] for i in x) != (" " + t).encode() for n, x in zip(names, ids)):
            out.append(([], [], 0, 0))
            continue
        ends = [list(np.cumsum([len(n[i]) for i in x]).tolist()) for n, x in zip(names, ids)]
        groups, links, before = [], [], 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            groups.append(tuple([i for i, e in zip(x, es) if before < e <= cut] for x, es in zip(ids, ends)))
            links.append((groups[-1][0][-1], groups[-1][1][-1]))
            before = cut
        out.append((groups, links, len(ids[0]), len(ids[1])))
    return out


def digests(found):
    counts = Counter(x for _, links, _, _ in found for x in links)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    out = []
    for groups, links, n_a, n_b in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((
            n_a, n_b, len(groups), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
            hashlib.sha256(text.encode()).hexdigest() if n_a else "",
        ))
    return out


def row(r):
    return r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256


def test_query_against_brute_force(spark):
    rows = table(spark, SF_DIR, "documents").select("doc_id", "text").collect()
    want = dict(zip((r.doc_id for r in rows), digests(brute([r.text for r in rows]))))
    got = queries.op11_cross_tokenizer_alignment(spark, SF_DIR).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: row(r) for r in got} == want


@pytest.mark.parametrize("lane", [1, 7, 1024])
def test_odd_texts_in_lanes(lane):
    a, b = alignment.ByteTokens(alignment.A_FILE), alignment.PieceTokens(alignment.B_FILE)
    texts = [t or "" for t in ODD]
    a_ids, a_n, b_ids, b_n, link_a, link_b = alignment.merged(texts, a, b, lane)
    want = brute(texts)
    assert a_n.tolist() == [x[2] for x in want] and b_n.tolist() == [x[3] for x in want]
    assert list(zip(a_ids[link_a].tolist(), b_ids[link_b].tolist())) == [x for w in want for x in w[1]]
    names = alignment._names(a.n, "|"), alignment._names(b.n, ";")
    texts = alignment.group_texts(a_ids, a_n, b_ids, b_n, link_a, link_b, *names)
    assert texts == [";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in w[0]) for w in want]


def test_words_of_b_are_encoded_as_in_their_text():
    b = alignment.PieceTokens(alignment.B_FILE)
    assert b.by_words
    texts = [t for t in ODD if t]
    assert [x.tolist() for x in b.encode(texts)] == b.model.encode(texts)
    b.by_words = False
    assert [x.tolist() for x in b.encode(texts)] == b.model.encode(texts)


def test_rows_and_rare_pairs(spark):
    """Repeated and missing ids, foreign columns, and every pair on the way of rare ones or of hot ones."""
    rows = [(k % 5 if k % 4 else None, t, 1, "x") for k, t in enumerate(ODD + ODD[4:8])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, row int, links string")
    want = Counter(zip((r[0] for r in rows), (d[:6] for d in digests(brute([r[1] for r in rows])))))
    found = alignment.aligned(df)
    for hot_pairs in (0, 3, 10**6):
        got = alignment.with_support(found, hot_pairs).collect()
        assert Counter((r.doc_id, (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum)) for r in got) == want


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert alignment.with_support(alignment.aligned(df)).collect() == []
