"""License statements in texts: a positional index of the rarest license words.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zoneflow.llm import common

#: Fixed by the contract: phrase and label. They are also the index's mandatory phrases of those labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: Label, wording of a statement, phrase that has to stand within the match.
TEMPLATES = (
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    ("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", "public domain"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0", "apache org licenses license 2 0"),
    ("gpl-3.0", "it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", "either version 3 of the license"),
    ("gpl-2.0", "it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version", "either version 2 of the license"),
    ("mpl-2.0", "if a copy of the mpl was not distributed with this file you can obtain one at", "copy of the mpl"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "may be used to endorse or promote products derived from this software"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "for any purpose with or without fee is hereby granted"),
    ("zlib", "in no event will the authors be held liable for any damages arising from the use of this software", "in no event will the authors be held liable"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)
#: Highest-IDF words of a wording that are indexed; so many of them have to agree on where it begins.
INDEXED, AGREE = 4, 2


def templates(spark: SparkSession, wordings=TEMPLATES) -> DataFrame:
    """`template`, `label`, `pos`, `word` of each wording's words. As long as the list of wordings."""
    rows = [(i, label, pos, w) for i, (label, text, _) in enumerate(wordings) for pos, w in enumerate(text.split(" "))]
    return common.frame(spark, rows, "template int, label string, pos int, word string")


def _begins(found: Column, phrase: list[str]) -> Column:
    """Places of a phrase. All its words are license words, so they follow one another in `found` too."""

    def at(x: Column, j: Column) -> Column:
        ok = x.word == phrase[0]
        for k, w in enumerate(phrase[1:], 1):
            y = F.get(found, j + k)
            ok = ok & F.coalesce((y.word == w) & (y.at == x.at + k), F.lit(False))
        return ok

    return F.transform(F.filter(found, at), lambda x: x.at)


def scan(docs: DataFrame, wordings=TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id`, `n_words`, `n_base`, `first_word`, `last_word`, `base_labels`, `labels`, `score` for each row.

    Base: all places of the contract's phrases. The method: the index holds each wording's INDEXED
    words of highest IDF (of those that any text has) with their places. All indexed words of a text
    are looked up; word place less wording place is where the wording would begin, and a beginning on
    which AGREE of them agree (all of a wording with fewer) is a candidate. It counts when the mandatory
    key phrase stands there too. So what else a text holds never takes a label away. `score` is the best candidate's share of the wording's words that
    stand at their places, or 1 where a base phrase stands.

    One pass reads the texts and keeps the license words with their places; anchors are grouped by
    row and beginning. Null and empty texts have no words and score 0. Equal rows are scanned each.
    An empty table gives no rows.
    """
    spark = docs.sparkSession
    vocabulary = sorted({w for _, text, key in wordings for w in f"{text} {key}".split(" ")} | {w for p, _ in PHRASES for w in p.split(" ")})
    words = common.split_words(common.lowered(F.col(text_col)), common.NOT_WORD)
    rows = common.keyed(docs, id_col, text_col).select("_f", "_r", F.col(id_col).alias("doc_id"), words.alias("words"))
    numbered = F.transform("words", lambda w, i: F.struct(i.alias("at"), w.alias("word")))
    marked = common.written(
        rows.select("_f", "_r", "doc_id", F.size("words").alias("n_words"), F.filter(numbered, lambda x: x.word.isin(vocabulary)).alias("found")), "license-words"
    )

    named = [(f"b{i}", label, p.split(" ")) for i, (p, label) in enumerate(PHRASES)]
    base = marked.select("_f", "_r", "doc_id", "n_words", *[_begins(F.col("found"), p).alias(c) for c, _, p in named])
    every = F.concat(*[F.col(c) for c, _, _ in named])
    labels = F.array_compact(F.array(*[F.when(F.size(c) > 0, F.lit(label)) for c, label, _ in named]))
    base = base.select("_f", "_r", "doc_id", "n_words", F.size(every).alias("n_base"), F.array_min(every).alias("first_word"), F.array_max(every).alias("last_word"), labels.alias("base"))

    some = marked.where(F.size("found") > 0).select("_f", "_r", "found")
    texts = some.select(F.explode(F.array_distinct("found.word")).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    index = templates(spark, wordings).join(F.broadcast(texts), "word")
    rank = F.row_number().over(Window.partitionBy("template").orderBy("df", "pos"))
    index = index.withColumn("rank", rank).where(F.col("rank") <= INDEXED).drop("rank", "df")
    index = common.written(index.withColumn("need", F.least(F.lit(AGREE), F.count("*").over(Window.partitionBy("template")))), "license-index")
    index = F.broadcast(index)  # INDEXED rows a wording

    votes = some.select("_f", "_r", F.inline("found")).join(index, "word")
    votes = votes.groupBy("_f", "_r", "template", "label", (F.col("at") - F.col("pos")).alias("begin"), "need").agg(F.count("*").alias("agreed"))
    near = votes.where("agreed >= need").drop("need", "agreed")

    texts = common.frame(spark, [(i, text.split(" "), f" {key} ") for i, (_, text, key) in enumerate(wordings)], "template int, wording array<string>, key string")
    near = near.join(F.broadcast(texts), "template").join(some, ["_f", "_r"])
    here = F.filter("found", lambda x: (x.at >= F.col("begin")) & (x.at < F.col("begin") + F.size("wording")))
    place = F.transform("here", lambda x: F.struct((x.at - F.col("begin")).alias("i"), x.word.alias("word")))
    near = near.withColumn("here", here).withColumn("here", place)
    same = F.size(F.filter("here", lambda x: x.word == F.get("wording", x.i))) / F.size("wording")
    #: words with a gap mark wherever words of the text lie between that are no license words
    joined = F.array_join(F.transform("here", lambda x, j: F.concat(F.when(F.coalesce(F.get("here", j - 1).i == x.i - 1, F.lit(False)), F.lit(" ")).otherwise(F.lit(" ? ")), x.word)), "")
    near = near.where(F.contains(F.concat(joined, F.lit(" ")), F.col("key"))).select("_f", "_r", "label", same.alias("share"))
    extra = near.groupBy("_f", "_r").agg(F.collect_set("label").alias("extra"), F.max("share").alias("share"))

    out = base.join(extra, ["_f", "_r"], "left")
    longs = ["n_words", "n_base", "first_word", "last_word"]
    return out.select(
        "doc_id", *[F.col(c).cast("long").alias(c) for c in longs], F.array_join(F.sort_array("base"), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union("base", F.coalesce("extra", F.array().cast("array<string>")))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
