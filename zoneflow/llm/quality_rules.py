"""Quality rules: counts within a text, and lines that many documents of a host share.

DataFrame functions only. A text is read once; what later steps need of it is a short row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.llm import common

#: A line is above the limit in over SHARE of a host's documents, MOST_FEW at the least.
SHARE, MOST_FEW = 0.05, 20
#: And at least that share of the documents with the line differ in what is left without all such lines.
DIVERSE = 0.5
#: A document is depleted when less than that share of its words is left, and fewer words than that.
LEFT, LEFT_WORDS = 0.2, 30
_BLANKS = " \t\n\x0b\x0c\r"
_WINDOW = 5


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of five that occurs twice or more in the same array."""

    def covered(hashes: Column) -> Column:
        marked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        same = lambda s, x, i: F.coalesce(x.h == F.get(s, i - 1).h, F.lit(False)) | F.coalesce(x.h == F.get(s, i + 1).h, F.lit(False))
        twice = common.let(marked, lambda s: F.filter(s, lambda x, i: same(s, x, i)))
        starts = F.sort_array(F.transform(twice, lambda x: x.i))
        grow = lambda acc, p: F.struct((acc.n + p + _WINDOW - F.greatest(p, acc.end)).alias("n"), (p + _WINDOW).alias("end"))
        return F.aggregate(starts, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), grow, lambda acc: acc.n)

    def windows(w: Column) -> Column:
        part = F.slice(w, 1, F.greatest(F.size(w) - (_WINDOW - 1), F.lit(0)))
        return F.transform(part, lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, _WINDOW)]))

    repeated = lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))
    return common.let(words, lambda w: common.let(windows(w), repeated))


def _facts(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """Per row: the base counts, and its normalised lines as (hash, words, characters)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = common.keyed(docs, id_col, text_col, host_col).select(
        "_f", "_r", F.col(id_col).alias("doc_id"), F.xxhash64(F.col(host_col), F.col(host_col).isNull()).alias("host"), text.alias("text")
    )
    blank = F.lit(_BLANKS)
    whole = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, blank) != "")
    words = common.split_words(F.col("text"), common.BLANK + "+")
    counts = common.let(
        words, lambda w: F.struct(F.size(w).alias("n_words"), F.length(F.array_join(w, "")).alias("word_chars"), repeated_words(w).alias("n_repeat_words"))
    )
    n_words = lambda x: F.size(F.split(F.regexp_replace(x, common.BLANK + "+", " "), " "))
    normal = F.transform(F.split(F.lower("text"), "\n"), lambda x: F.btrim(x, blank))
    longest = lambda x: F.array_max(F.transform(F.split(x, common.BLANK + "+"), lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))
    lines = F.transform(F.filter(normal, lambda x: x != ""), lambda x: F.struct(F.xxhash64(x).alias("line"), n_words(x).alias("words"), longest(x).alias("top")))
    return rows.select(
        "_f", "_r", "doc_id", "host", F.xxhash64("text").alias("body"), counts.alias("c"), lines.alias("lines"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).alias("n_symbols"),
        common.let(whole, lambda x: F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"),
    ).select("_f", "_r", "doc_id", "host", "body", "c.*", "n_symbols", "n_dup_lines", "lines")


def frequent_lines(facts: DataFrame, share: float, most_few: int, diverse: float) -> DataFrame:
    """(`host`, `line`) above the limit.

    Copies count once: a document is its text. Near copies share most lines too, so the documents
    with a line also have to differ in what is left of them without all lines over the count: in the
    longest word of that, which an edit seldom hits. So a header, a footer and a notice do not
    shield each other, and what only one group of near copies has is no boilerplate. Counting goes by
    (host, line, text) and (host, line, longest word) first, so a line that every document has is
    summed up in many tasks.
    """
    each = facts.select("host", "body", F.inline("lines"))
    texts = each.groupBy("host", "line", "body").agg(F.lit(1).alias("one"))
    counts = texts.groupBy("host", "line").agg(F.count("*").alias("texts"))
    hosts = facts.select("host", "body").groupBy("host", "body").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("*").alias("docs"))
    above = F.col("texts") > F.greatest(F.lit(float(most_few)), share * F.col("docs"))
    many = counts.where(F.col("texts") > most_few).join(hosts, "host").where(above)
    many = common.written(many.select("host", "line", F.lit(True).alias("often")), "shared-lines")
    marked = each.join(many, ["host", "line"], "left")
    # of each text with such a line: those lines, and the longest word of the others
    left = marked.groupBy("host", "body").agg(F.collect_set(F.when(F.col("often"), F.col("line"))).alias("often"), F.max(F.when(F.col("often").isNull(), F.col("top"))).alias("top"))
    kinds = left.where(F.size("often") > 0).select("host", F.explode("often").alias("line"), F.col("top.w").alias("top"))
    kinds = kinds.groupBy("host", "line", "top").agg(F.count("*").alias("texts"))
    kinds = kinds.groupBy("host", "line").agg(F.count("*").alias("kinds"), F.sum("texts").alias("texts"))
    return kinds.where(F.col("kinds") >= diverse * F.col("texts")).select("host", "line")


def judge(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    share: float = SHARE, most_few: int = MOST_FEW, diverse: float = DIVERSE, left: float = LEFT, left_words: int = LEFT_WORDS,
) -> DataFrame:
    """`_f`, `_r` (the row), `doc_id`, the base counts, `n_words_left`, `base_failed`, `kept`, for each row.

    A row fails the base rules with fewer than 10 words, or with over 20 % of its words in repeated
    five-word windows. Apart from that, lines above the limit of their host are taken out, and a row
    with less than `left` of its words and fewer than `left_words` after that is rejected. Lines are compared in lower case,
    without blanks at their ends; windows and lines by 64-bit hashes.

    Null texts have no words. A null host is a host of its own. Equal rows are judged alike. An
    empty table gives no rows.
    """
    facts = common.written(_facts(docs, id_col, text_col, host_col), "line-facts")
    above = common.written(frequent_lines(facts, share, most_few, diverse), "frequent-lines")
    lines = facts.where(F.size("lines") > 0).select("_f", "_r", "host", F.inline("lines"))
    gone = lines.join(above, ["host", "line"]).groupBy("_f", "_r").agg(F.sum("words").alias("gone"))
    out = facts.drop("host", "body", "lines").join(gone, ["_f", "_r"], "left")
    kept_words = F.col("n_words") - F.coalesce("gone", F.lit(0))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    longs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return out.select(
        "_f", "_r", "doc_id", *[F.col(c).cast("long").alias(c) for c in longs], kept_words.cast("long").alias("n_words_left"),
        failed.alias("base_failed"), (~failed & ((kept_words >= left * F.col("n_words")) | (kept_words >= left_words))).alias("kept"),
    )


def kept(docs: DataFrame, **names) -> DataFrame:
    """The rows of `docs` that `judge` keeps."""
    docs = common.filed(docs)
    return common.among(docs, judge(docs, **names).where("kept"))
