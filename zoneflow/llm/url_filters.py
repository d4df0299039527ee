"""Verdicts on urls: rules by host and path, then naive Bayes over words that Viterbi finds in names."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.llm import common

common.shipped(__name__)

#: Fixed by the contract: verdict, host, path.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: The longest word that is looked for in a name.
LONGEST = 24
#: Tokens or names that are broadcast at most; with more, they are joined by a shuffle.
BROADCAST = 500_000
_PIECES = re.compile(r"[a-z]+|[0-9]+|[^\x00-\x7F]+")


def host_of(url: Column) -> Column:
    return common.lowered(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules=RULES) -> Column:
    """`rule` and `verdict` of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the last one that fits counts
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def segment(name: str, log_p: dict[str, float], unknown: float) -> list[str]:
    """The likeliest words of a name; an unknown word costs `unknown` for each letter."""
    best, cut = [0.0], [0]
    for end in range(1, len(name) + 1):
        options = []
        for start in range(max(0, end - LONGEST), end):
            p = log_p.get(name[start:end])
            options.append((best[start] + (p if p is not None else unknown * (end - start)), start))
        value, start = max(options, key=lambda x: (x[0], -x[1]))
        best.append(value), cut.append(start)
    words, end = [], len(name)
    while end:
        words.append(name[cut[end] : end])
        end = cut[end]
    return words[::-1]


def pieces_of(host: str, path: str) -> list[tuple[str, str | None]]:
    """Tokens of a url, each with no piece, and pieces whose words are to be found, with where they stand.

    Runs of letters of the host's names and of the path are pieces; numbers count by length; the host's last name is whole.
    """
    *names, top = host.split(".")
    out: list[tuple[str, str | None]] = [(f"top:{top}", None)] if top else []
    for place, text in [*(("h", n) for n in names), ("p", path.lower())]:
        for piece in _PIECES.findall(text):
            number = piece.isascii() and piece.isdigit()
            out.append((f"{place}:#{len(piece)}", None) if number else (place, piece))
    return out


def tokens_of(host: str, path: str, words) -> list[str]:
    """All tokens of a url, where `words` gives those of a piece."""
    return [t for mark, piece in pieces_of(host, path) for t in ([mark] if piece is None else [f"{mark}:{w}" for w in words(piece)])]


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("mark", pa.string()), ("piece", pa.string())]))
    for batch in batches:
        found = [[{"mark": m, "piece": x} for m, x in pieces_of(h, p)] for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())]
        yield pa.record_batch([*batch.columns, pa.array(found, kind)], names=[*batch.schema.names, "marks"])


def _segmented(total: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unknown = -math.log(total) - 2.0
        for batch in batches:
            held = (dict(x or ()) for x in batch.column("held").to_pylist())
            found = [segment(piece, {w: math.log(n / total) for w, n in counts.items()}, unknown) for piece, counts in zip(batch.column("piece").to_pylist(), held)]
            yield pa.record_batch([batch.column("piece"), pa.array(found, pa.list_(pa.string()))], names=["piece", "words"])

    return run


def words_of(pieces: DataFrame, counts: DataFrame) -> DataFrame:
    """`piece`, `words`: the likeliest split of each distinct piece.

    All parts of a piece, up to LONGEST letters, are joined with the counted words; a piece comes to
    its split with the words that it holds, so no task holds the lexicon.
    """
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] + 1
    starts = pieces.select("piece", F.explode(F.sequence(F.lit(1), F.length("piece"))).alias("at"))
    parts = starts.select("piece", "at", F.explode(F.sequence(F.lit(1), F.least(F.lit(LONGEST), F.length("piece") - F.col("at") + 1))).alias("n"))
    held = parts.select("piece", F.col("piece").substr(F.col("at"), F.col("n")).alias("word")).distinct().join(counts, "word")
    held = held.groupBy("piece").agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("held"))
    return pieces.join(held, "piece", "left").mapInArrow(_segmented(total), "piece string, words array<string>")


def lexicon(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """`word`, `n`: counts of all words of all pages' text, LONGEST letters at most."""
    text = F.regexp_replace(F.coalesce(F.col(html_col), F.lit("")), "<[^>]*>", " ")
    words = pages.select(F.explode(F.split(F.lower(text), "[^a-z]+")).alias("word")).where(F.length("word").between(1, LONGEST))
    return common.written(words.groupBy("word").agg(F.count("*").alias("n")), "page-words")


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """`page_id`, `host`, `path`, `rule`, `verdict`, `log_odds` for each row.

    The longest rule that fits decides. For the rest, multinomial naive Bayes with add-one counts
    decides: it learns from all urls that a rule decides, and scores the words of host and path;
    `log_odds` over 0 is a block. The words are the likeliest split of each name by word counts of
    all pages' text.

    A null url, or one without `://`, has empty host and path and no tokens; it gets the verdict of
    the classes' sizes. Without decided urls all log odds are 0 and verdicts allow. Null html adds
    no words. Equal rows are judged each. An empty table gives no rows.
    """
    counts = lexicon(pages, html_col)
    rows = common.keyed(pages, id_col, url_col).select("_f", "_r", F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    kind = rows.schema["page_id"].dataType.simpleString()
    split = rows.mapInArrow(_marked, f"_f long, _r long, page_id {kind}, host string, path string, marks array<struct<mark:string,piece:string>>")
    split = common.written(split.withColumn("by_rule", ruled(F.col("host"), F.col("path"), rules)), "url-pieces")
    marks = split.select("_f", "_r", F.col("by_rule.verdict").alias("decided"), F.inline("marks"))
    pieces = common.written(marks.where("piece is not null").select("piece").distinct(), "pieces")
    found = common.written(words_of(pieces, counts), "piece-words")
    if found.count() <= BROADCAST:
        found = F.broadcast(found)
    token = F.when(F.col("piece").isNull(), F.array("mark")).otherwise(F.transform("words", lambda w: F.concat("mark", F.lit(":"), w)))
    tokens = common.written(marks.join(found, "piece", "left").select("_f", "_r", "decided", F.explode(token).alias("token")), "url-tokens")

    block = (F.col("by_rule.verdict") == "block").cast("long")
    sides = split.where("by_rule is not null").agg(F.coalesce(F.sum(block), F.lit(0)), F.coalesce(F.sum(1 - block), F.lit(0))).first()
    prior = math.log((sides[0] + 1) / (sides[1] + 1))
    learned = tokens.where("decided is not null").select((F.col("decided") == "block").cast("long").alias("block"), "token")
    counts = common.written(learned.groupBy("token").agg(F.sum("block").alias("b"), F.sum(1 - F.col("block")).alias("a")), "url-counts")
    n, b, a = counts.agg(F.count("*"), F.coalesce(F.sum("b"), F.lit(0)), F.coalesce(F.sum("a"), F.lit(0))).first()
    unseen = math.log((a + n + 1) / (b + n + 1))
    weights = counts.select("token", (F.log((F.col("b") + 1) / (F.col("a") + 1)) + unseen).alias("w"))
    if n <= BROADCAST:
        weights = F.broadcast(weights)
    sums = tokens.where("decided is null").join(weights, "token", "left")
    sums = sums.groupBy("_f", "_r").agg(F.sum(F.coalesce("w", F.lit(unseen))).alias("sum"))
    odds = F.when(F.col("by_rule").isNull(), prior + F.coalesce("sum", F.lit(0.0)))
    out = split.drop("marks").join(sums, ["_f", "_r"], "left").withColumn("log_odds", odds)
    verdict = F.coalesce("by_rule.verdict", F.when(F.col("log_odds") > 0, "block").otherwise("allow"))
    return out.select("page_id", "host", "path", F.col("by_rule.rule").alias("rule"), verdict.alias("verdict"), "log_odds")
