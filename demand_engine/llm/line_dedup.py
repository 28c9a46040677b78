"""Lines that recur across documents, found by a log-template tree of fixed depth, and dropped.

The path of a line in the tree is its token count, then its first LEAD tokens, where a token with a digit
counts as a variable field ``<*>``. Below that, a line belongs to up to three templates: its tokens as
they are (digits masked), and, from MIN_WILD tokens on, the same with the first or the second half of the
rest generalised to ``<*>``, so that a field that varies in one half doesn't hide the template.

A template recurs if it stands in at least ``min_docs`` different texts and in as many different
surroundings, and its surroundings are at least ``min_spread`` of its texts. The surroundings of a line are
its text, if enough of the text's other lines are its own, that is, neither begin nor end like a line of any other
text (an edited line of a copy mostly keeps one of both): half of them, or two and OWN_SHARE of them. Else they are one other line, drawn by the smallest hash of leading tokens.
A license line or a repeated passage, of one line or many, has as many surroundings as texts, nearly, while copies of
one text, exact or near, mostly draw the same line. So copies are left whole for the operators that look for them.
Whatever the share, a template recurs if it stands in ``min_docs`` texts most of whose lines, two at least, are their
own: no copies do that, so a group of copies, however large, can't keep a passage in the texts outside of it.
Lines under MIN_TOKENS tokens need ``short_docs`` texts.

Built-in Spark expressions only: paths and templates are made inside each row, so what is shuffled is
hashes; counts are pre-aggregated per (template, text) and (template, surroundings), which spreads a
template that a third of all documents have, and only templates of enough texts are looked at further; the last
join brings the dropped line numbers to the texts.
Templates are compared by 64-bit hashes.

Defined results: a null text is one empty line and stays null; empty lines stay and are never templates;
rows that repeat an id with the same text are treated alike, with other texts each by its own lines;
a null id is an id like others; an empty table gives an empty result; other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demand_engine.llm.common import pick, unused
from demand_engine.session import cut_lineage

LEAD = 3
MIN_TOKENS = 5
MIN_WILD = 12
MIN_DOCS = 3
SHORT_DOCS = 30
MIN_SPREAD = 0.4
#: The share of a text's own lines that makes it the surroundings of its other lines.
OWN_SHARE = 0.2
VARIABLE = "[^ ]*[0-9][^ ]*"


def _text_hash():
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _empty(tokens):
    return (F.size(tokens) == 1) & (F.get(tokens, F.lit(0)) == "")


def occurrences(documents: DataFrame) -> DataFrame:
    """``doc_id, text_hash, n_ends, line_no, n_tokens, place, ends, templates``: a row per line; place stands for
    another line of the text, ends for how the line begins and ends (null if it is empty), n_ends counts the
    different ones of the text."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    tokens = F.transform(lines, lambda x: F.split(F.regexp_replace(F.trim(x), VARIABLE, "<*>"), " "))

    def ends(t):
        last = F.slice(t, F.greatest(F.size(t) - LEAD + 1, F.lit(1)), LEAD)
        return F.when(~_empty(t), F.array(F.xxhash64(F.lit(0), F.slice(t, 1, LEAD)), F.xxhash64(F.lit(1), last)))

    docs = (
        pick(documents, doc_id="doc_id", text="text")
        .select("doc_id", _text_hash().alias("text_hash"), tokens.alias("tokens"))
        .withColumn("leads", F.transform("tokens", lambda t: F.md5(F.array_join(F.slice(t, 1, LEAD), " "))))
        .withColumn("least", F.slice(F.array_sort(F.array_distinct("leads")), 1, 2))
        .withColumn("ends", F.transform("tokens", ends))
        .withColumn("n_ends", F.size(F.array_compact(F.array_distinct("ends"))))
    )

    def entry(t, i):
        n = F.size(t)
        half = LEAD + F.floor((n - LEAD) / 2).cast("int")
        lead = F.get(F.col("leads"), i)
        path = F.xxhash64(n, lead)
        first = F.slice(t, LEAD + 1, F.greatest(half - LEAD, F.lit(0)))
        second = F.slice(t, half + 1, F.greatest(n - half, F.lit(0)))
        wild = F.array(
            F.xxhash64(path, F.lit(0), t),
            F.xxhash64(path, F.lit(1), first),
            F.xxhash64(path, F.lit(2), second),
        )
        least = F.get(F.col("least"), F.lit(0))
        place = F.xxhash64(F.when(least != lead, least).otherwise(F.get(F.col("least"), F.lit(1))))
        templates = F.when(_empty(t), F.array().cast("array<bigint>")).when(n < MIN_WILD, F.slice(wild, 1, 1)).otherwise(wild)
        return F.struct(i.alias("line_no"), n.alias("n_tokens"), place.alias("place"), F.get(F.col("ends"), i).alias("ends"), templates.alias("templates"))

    return docs.select("doc_id", "text_hash", "n_ends", F.explode(F.transform("tokens", entry)).alias("e")).select(
        "doc_id", "text_hash", "n_ends", "e.*"
    )


def candidates(lines: DataFrame, min_docs: int = MIN_DOCS, short_docs: int = SHORT_DOCS) -> DataFrame:
    """``doc_id, text_hash, n_ends, line_no, place, template, n, needed`` of the templates that stand in enough texts."""
    found = lines.select("doc_id", "text_hash", "n_ends", "line_no", "n_tokens", "place", F.explode("templates").alias("template"))
    per_text = found.groupBy("template", "text_hash").agg(F.min("n_tokens").alias("n"))
    counted = per_text.groupBy("template").agg(F.count(F.lit(1)).alias("n_texts"), F.min("n").alias("n"))
    needed = F.when(F.col("n") < MIN_TOKENS, short_docs).otherwise(min_docs)
    enough = counted.withColumn("needed", needed).where("n_texts >= needed").select("template", "needed")
    return found.drop("n_tokens").join(enough, "template")


def recurring(lines: DataFrame, found: DataFrame, min_spread: float = MIN_SPREAD) -> DataFrame:
    """``template, n_texts, n_places`` of the recurring ones among the templates of ``found`` (``candidates``)."""
    of_line = lines.select(F.struct("text_hash", "line_no").alias("line"), F.explode("ends").alias("end"))
    of_end = of_line.groupBy("end").agg(F.min("line").alias("line"), F.max("line.text_hash").alias("last"))
    own = (
        of_end.where("line.text_hash = last")
        .groupBy("line.text_hash", "line.line_no")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n = 2")
        .groupBy("text_hash")
        .agg(F.count(F.lit(1)).alias("n_own"))
    )
    first = F.min(F.struct("line_no", "place", "n_ends", "needed")).alias("first")
    per_text = found.groupBy("template", "text_hash").agg(first).select("template", "text_hash", "first.*")
    # A line of a template in several texts is never one of its text's own.
    n_own, others = F.coalesce("n_own", F.lit(0)), F.col("n_ends") - 1
    apart = (n_own >= 2) & (2 * n_own > others)
    itself = (n_own > 0) & ((2 * n_own >= others) | ((n_own >= 2) & (n_own >= F.lit(OWN_SHARE) * others)))
    placed = per_text.join(own, "text_hash", "left").select(
        "template", "needed", apart.alias("apart"), itself.alias("itself"), F.when(itself, F.col("text_hash")).otherwise(F.col("place")).alias("place")
    )
    per_place = placed.groupBy("template", "itself", "place").agg(
        F.count(F.lit(1)).alias("c"), F.count_if("apart").alias("apart"), F.min("needed").alias("needed")
    )
    counted = per_place.groupBy("template").agg(
        F.sum("c").alias("n_texts"),
        F.count(F.lit(1)).alias("n_places"),
        F.sum("apart").alias("n_apart"),
        F.min("needed").alias("needed"),
    )
    spread = (F.col("n_places") >= F.col("needed")) & (F.col("n_places") >= F.lit(min_spread) * F.col("n_texts"))
    return counted.where(spread | (F.col("n_apart") >= F.col("needed"))).select("template", "n_texts", "n_places")


def drop_recurring_lines(
    documents: DataFrame, min_docs: int = MIN_DOCS, short_docs: int = SHORT_DOCS, min_spread: float = MIN_SPREAD
) -> DataFrame:
    """The rows of ``documents`` with the recurring lines taken out of ``text``, and ``n_lines``,
    ``n_dropped``. These two replace columns of the same names. A text counts once per template, with the
    surroundings of the template's first line in it."""
    lines = cut_lineage(occurrences(documents), "lines")
    found = cut_lineage(candidates(lines, min_docs, short_docs), "line-templates")
    row_hash, key, key_hash, gone = unused(documents, "row_hash", "key", "key_hash", "gone")
    dropped = (
        found.join(recurring(lines, found, min_spread), "template", "left_semi")
        .groupBy(F.col("doc_id").alias(key), F.col("text_hash").alias(key_hash))
        .agg(F.collect_set("line_no").alias(gone))
    )
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(F.col(gone), i)), "\n")
    n_lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("bigint")
    return (
        documents.withColumn(row_hash, _text_hash())
        .join(dropped, F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(row_hash) == F.col(key_hash)), "left")
        .withColumns(
            {
                "n_lines": n_lines,
                "n_dropped": F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).cast("bigint"),
                "text": F.when(F.col(gone).isNull(), F.col("text")).otherwise(kept),
            }
        )
        .drop(row_hash, key, key_hash, gone)
    )
