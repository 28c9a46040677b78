"""The registered queries of the operators, each over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demand_engine.llm import (
    alignment,
    chat,
    decontaminate,
    exact_dedup,
    jaccard_join,
    langid,
    line_dedup,
    mixing,
    spelling,
    token_counts,
    toxicity,
    vector_join,
    warc,
)
from demand_engine.llm.common import table
from demand_engine.session import cut_lineage, shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return keep


@register("op1_language_id")
def op1_language_id(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    test = langid.held_out(F.col("doc_id"))
    model = langid.learn(documents.where(~test))
    return langid.predict(documents, model).withColumn("held_out", test)


WARC_SQL = """
WITH d AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS n, sha1(coalesce(html, '')) AS hex FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS keeper FROM d)
SELECT page_id, n AS payload_bytes,
  array_to_string([
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + ((('0x' || hex[(k // 8) * 10 + 1:(k // 8) * 10 + 10])::BIGINT >> (35 - 5 * (k % 8))) & 31)]
    FOR k IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM k
"""


@register("op2_warc", WARC_SQL)
def op2_warc(spark, sf_dir):
    index = warc.write_bundles(table(spark, sf_dir, "pages"))
    return warc.read_bundles(spark, index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op3_token_counts")
def op3_token_counts(spark, sf_dir):
    """Estimates first, exact counts as revisions, then exact copies deleted; the revisions are delivered twice.
    Documents without id, which nothing can revise, come with their exact counts."""
    documents = table(spark, sf_dir, "documents")
    estimate = F.ceil(F.coalesce(F.char_length("text"), F.lit(0)) / 4)
    version = F.lit(token_counts.VERSION).alias("tokenizer")

    def change(rows, op, tokens):
        return rows.select("doc_id", "source", "lang", version, op.alias("op"), tokens.cast("bigint").alias("tokens"), F.lit(0).alias("seq"))

    rollup = token_counts.Rollup(spark, shared_folder(spark, "token-counts"))
    named = F.col("doc_id").isNotNull()
    rollup.apply("inserts", change(documents.where(named), F.lit("insert"), estimate))
    counted = cut_lineage(token_counts.count_tokens(documents), "token-counts")
    for _ in range(2):
        rollup.apply("revisions", change(counted, F.when(named, "revise").otherwise("insert"), F.col("tokens")))
    copies = documents.groupBy(F.sha2("text", 256).alias("h")).agg(F.min("doc_id").alias("_keep"), F.count(F.lit(1)).alias("n"))
    extra = (
        documents.select("doc_id", "source", "lang", F.sha2("text", 256).alias("h"))
        .join(copies.where("n > 1 and h is not null"), "h")
        .where("doc_id <> _keep")
    )
    rollup.apply("deletes", change(extra, F.lit("delete"), F.lit(None)))
    rollup.compact()
    return rollup.totals()


CHAT_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(role) + length(text) + 15 + length(text) - length(translate(text, '\#<', '')))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""


@register("op4_chat_formatting", CHAT_SQL)
def op4_chat_formatting(spark, sf_dir):
    extra = spark.createDataFrame(
        [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")],
        "conv_id bigint, turn bigint, role string, text string",
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.format_conversations(rows.unionByName(extra)))


@register("op5_toxicity")
def op5_toxicity(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    test = langid.held_out(F.col("doc_id"))
    field = toxicity.learn(documents, table(spark, sf_dir, "labels").where(~test))
    return toxicity.score(documents, field).select(
        "doc_id", test.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans"
    )


JACCARD_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t-\r]+'), []) AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN ws ELSE ws[i:i + 4] END AS shingle
  FROM w, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS u(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
  GROUP BY ALL),
l AS MATERIALIZED (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)),
r AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.other)
SELECT r.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.other) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""


@register("op6_ngram_jaccard_join", JACCARD_SQL)
def op6_ngram_jaccard_join(spark, sf_dir):
    return jaccard_join.similarity_classes(table(spark, sf_dir, "documents"))


DECONTAMINATION_SQL = r"""
WITH letters AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS up, 'abcdefghijklmnopqrstuvwxyz' AS low),
d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, up, low), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws
  FROM documents, letters),
b AS (
  SELECT item_id, coalesce(regexp_extract_all(translate(text, up, low), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws
  FROM benchmark, letters),
win AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS win
  FROM b, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS u(i) WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT n FROM win),
occ AS (
  SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS win
  FROM d, sizes, unnest(range(1, len(ws) - n + 2)) AS u(i) WHERE len(ws) >= n),
m AS (SELECT doc_id, i, n, item_id FROM occ JOIN win USING (n, win)),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM m, unnest(range(i, i + n)) AS u(j) GROUP BY doc_id),
it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM m) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""


@register("op9_decontamination", DECONTAMINATION_SQL)
def op9_decontamination(spark, sf_dir):
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


LINE_DEDUP_SQL = f"""
WITH d AS (SELECT doc_id, md5(coalesce(text, '')) AS t, string_split(coalesce(text, ''), chr(10)) AS ls, coalesce(text, '') AS text FROM documents),
x AS (SELECT t, any_value(ls) AS ls FROM d GROUP BY t),
l AS (
  SELECT t, i, string_split(regexp_replace(trim(ls[i]), '[^ ]*[0-9][^ ]*', '<*>', 'g'), ' ') AS tok
  FROM x, unnest(range(1, len(ls) + 1)) AS u(i)),
p AS MATERIALIZED (
  SELECT *, len(tok) AS n, md5(array_to_string(tok[1:{line_dedup.LEAD}], ' ')) AS lead, len(tok) = 1 AND tok[1] = '' AS blank FROM l),
m AS (SELECT t, list_sort(list(DISTINCT lead))[1:2] AS least FROM p GROUP BY t),
q AS (
  SELECT *, {line_dedup.LEAD} + (n - {line_dedup.LEAD}) // 2 AS half, {{'n': n, 'lead': lead}} AS path,
    coalesce(CASE WHEN least[1] <> lead THEN least[1] ELSE least[2] END, '') AS place
  FROM p JOIN m USING (t) WHERE NOT blank),
o AS MATERIALIZED (
  SELECT t, i, n, place, md5({{'k': 0, 'path': path, 'rest': tok}}::VARCHAR) AS template FROM q
  UNION ALL SELECT t, i, n, place, md5({{'k': 1, 'path': path, 'rest': tok[{line_dedup.LEAD + 1}:half]}}::VARCHAR) FROM q
    WHERE n >= {line_dedup.MIN_WILD}
  UNION ALL SELECT t, i, n, place, md5({{'k': 2, 'path': path, 'rest': tok[half + 1:n]}}::VARCHAR) FROM q
    WHERE n >= {line_dedup.MIN_WILD}),
texts AS (SELECT template, t, arg_min(place, i) AS place, min(n) AS n FROM o GROUP BY template, t),
need AS (
  SELECT template, CASE WHEN min(n) < {line_dedup.MIN_TOKENS} THEN {line_dedup.SHORT_DOCS} ELSE {line_dedup.MIN_DOCS} END AS needed
  FROM texts GROUP BY template HAVING count(*) >= needed),
e AS MATERIALIZED (SELECT t, i, md5(tok[1:{line_dedup.LEAD}]::VARCHAR) AS a, md5(tok[greatest(n - {line_dedup.LEAD - 1}, 1):n]::VARCHAR) AS z FROM q),
ends AS (SELECT t, count(DISTINCT {{'a': a, 'z': z}}) AS n_ends FROM e GROUP BY t),
own AS (
  SELECT t, count(*) AS n_own
  FROM (SELECT any_value(t) AS t, min(i) AS i FROM e GROUP BY a HAVING count(DISTINCT t) = 1)
  JOIN (SELECT any_value(t) AS t, min(i) AS i FROM e GROUP BY z HAVING count(DISTINCT t) = 1) USING (t, i) GROUP BY t),
placed AS (
  SELECT template, needed, t, place, coalesce(n_own, 0) AS n_own, n_ends - 1 AS others
  FROM texts JOIN need USING (template) JOIN ends USING (t) LEFT JOIN own USING (t)),
judged AS (
  SELECT *, n_own >= 2 AND 2 * n_own > others AS apart,
    n_own > 0 AND (2 * n_own >= others OR (n_own >= 2 AND n_own >= {line_dedup.OWN_SHARE} * others)) AS itself FROM placed),
found AS (
  SELECT template FROM judged GROUP BY template, needed
  HAVING (count(DISTINCT {{'s': itself, 'p': CASE WHEN itself THEN t ELSE place END}}) >= greatest(needed, {line_dedup.MIN_SPREAD} * count(*)))
    OR count(*) FILTER (apart) >= needed),
g AS (SELECT t, list(DISTINCT i) AS gone FROM o SEMI JOIN found USING (template) GROUP BY t)
SELECT doc_id, len(ls)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_dropped,
  CASE WHEN gone IS NULL THEN text
    ELSE array_to_string([ls[j] FOR j IN range(1, len(ls) + 1) IF NOT list_contains(gone, j)], chr(10)) END AS text
FROM d LEFT JOIN g USING (t)
"""


@register("op7_line_dedup", LINE_DEDUP_SQL)
def op7_line_dedup(spark, sf_dir):
    return line_dedup.drop_recurring_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", "text"
    )


@register(
    "op8_exact_dedup",
    """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
""",
)
def op8_exact_dedup(spark, sf_dir):
    return exact_dedup.mark_duplicates(table(spark, sf_dir, "documents"))


MIXING_SQL = f"""
WITH q AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id),
d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^ \\t-\\r]+')), 0)::BIGINT AS size,
    -ln((('0x' || md5('0:' || doc_id)[1:13])::BIGINT::DOUBLE + 0.5) / {2**52}::DOUBLE)
      / CASE quality WHEN 1 THEN {mixing.QUALITY_WEIGHTS[1]} WHEN 0 THEN {mixing.QUALITY_WEIGHTS[0]}
             ELSE {mixing.DEFAULT_WEIGHT} END::DOUBLE AS key
  FROM documents LEFT JOIN q USING (doc_id)),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w, 3.0::DOUBLE * sum(size)::DOUBLE AS cap
  FROM d GROUP BY source),
v AS (
  SELECT *, sum(source_size::DOUBLE) OVER () AS total, sum(w) OVER () AS w_all,
    coalesce(sum(cap) OVER b, 0) AS cap_before, coalesce(sum(w) OVER b, 0) AS w_before
  FROM s WINDOW b AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
o AS (
  SELECT *, (total - cap_before) / (w_all - w_before) AS level,
    row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS rank FROM v),
e AS (SELECT min(rank) AS first, arg_min(level, rank) AS level FROM o WHERE level * w <= cap),
t AS (
  SELECT source, source_size,
    CASE WHEN rank >= e.first THEN least(cap, e.level * w) ELSE cap END AS target FROM o, e),
p AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM t),
f AS (
  SELECT d.*, source_size, target, epochs, round(target - epochs * source_size)::BIGINT AS budget,
    coalesce(sum(size) OVER (
      PARTITION BY d.source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, budget - before)))::BIGINT AS taken FROM f
"""


@register("op10_mixing", MIXING_SQL)
def op10_mixing(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@register("op11_cross_tokenizer_alignment")
def op11_cross_tokenizer_alignment(spark, sf_dir):
    found = alignment.aligned(table(spark, sf_dir, "documents"), digest=True)
    return alignment.with_support(found).withColumnRenamed("groups", "groups_sha256")


EMBEDDING_SQL = """
WITH RECURSIVE e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
u AS (
  SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS l FROM e
  WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
l AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id
  WHERE list_inner_product(a.v, b.v) / (a.l * b.l) >= 0.95),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
r AS (SELECT vec_id, vec_id AS other FROM e UNION SELECT r.vec_id, l.b FROM r JOIN l ON l.a = r.other)
SELECT r.vec_id, coalesce(any_value(n.n), 0)::BIGINT AS n_links, min(other) AS component_id, r.vec_id = min(other) AS kept
FROM r LEFT JOIN n ON n.a = r.vec_id GROUP BY r.vec_id
"""


@register("op12_embedding_near_dedup", EMBEDDING_SQL)
def op12_embedding_near_dedup(spark, sf_dir):
    return vector_join.near_duplicates(table(spark, sf_dir, "embeddings"))


SPELLING_SQL = r"""
WITH tab AS (
  SELECT list_transform(range(256), lambda x: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, x)) AS tab),
r AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]+')) AS run FROM documents),
c AS (SELECT doc, run, count(*) AS n, hex(encode(doc || ':' || run)) AS hex FROM r WHERE length(run) >= 7 GROUP BY ALL),
h AS (
  SELECT doc, run, n, xor(4294967295, list_reduce(
    list_transform(range(length(hex) // 2), lambda k: ('0x' || hex[2 * k + 1:2 * k + 2])::BIGINT),
    lambda crc, b: xor(crc >> 8, tab[(xor(crc, b) & 255) + 1]), 4294967295::BIGINT)) AS h
  FROM c, tab),
o AS (SELECT CASE WHEN h % 31 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM h),
w AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM o WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
x AS MATERIALIZED (SELECT word, n, length(word) AS l, i, word[1:i - 1] || word[i + 1:] AS rest FROM w, unnest(range(1, length(word) + 1)) AS u(i)),
near AS (
  SELECT a.word, b.word AS other, b.n FROM x a JOIN x b ON a.rest = b.rest AND a.i = b.i AND a.l = b.l AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM x a JOIN w b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM x a JOIN w b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, arg_min({'o': other, 'n': n}, {'n': -n, 'o': other}) AS b FROM near GROUP BY word),
f AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN b.n >= 10 * w.n THEN b.o END AS form,
    CASE WHEN b.n >= 10 * w.n THEN b.n END AS form_n
  FROM w LEFT JOIN best ON w.word = best.word),
up AS (
  WITH RECURSIVE up AS (
    SELECT word, word AS root FROM f UNION ALL SELECT up.word, f.form FROM up JOIN f ON f.word = up.root WHERE f.form IS NOT NULL)
  SELECT up.word, up.root FROM up JOIN f ON f.word = up.root WHERE f.form IS NULL)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN up ON f.word = up.word
"""


@register("op13_spelling_variants", SPELLING_SQL)
def op13_spelling_variants(spark, sf_dir):
    """Every 31st run, by a checksum, loses a code point first, which plants misspellings."""
    found = spelling.runs(table(spark, sf_dir, "documents"))
    h = F.crc32(F.concat_ws(":", "doc_id", "run").cast("binary"))
    at = (h % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    words = found.select(F.when(h % 31 == 0, cut).otherwise(F.col("run")).alias("word"))
    return spelling.group_variants(spelling.vocabulary(words))
