"""Decontamination, license scans and quality rules against plain Python."""

import re
from collections import Counter, defaultdict

import pytest

from llm.conftest import SMALL, pairs, rows
from zoneflow.llm import decontamination, licenses, quality_rules

WORD, PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return (text or "").encode().lower().decode()


def _hits(docs, items):
    wins = defaultdict(set)
    for item, text in items:
        w = WORD.findall(lower(text))
        for k in range(max(len(w) - 9, 1) if w else 0):
            wins[tuple(w[k : k + 10])].add(str(item) if item is not None else None)
    lengths = {len(w) for w in wins}
    for i, text in docs:
        w = WORD.findall(lower(text))
        hit, who = set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if (found := wins.get(tuple(w[k : k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    who |= found - {None}
        yield i, len(w), len(hit), len(who), ",".join(sorted(who))


@pytest.mark.parametrize("limit", [decontamination.BROADCAST, 0])
def test_windows_in_documents(spark, odd, monkeypatch, limit):
    monkeypatch.setattr(decontamination, "BROADCAST", limit)
    texts = [t for _, t in pairs(odd) if t]
    some = sorted(texts, key=len)
    items = [(1, " ".join(some[-1].split()[50:80])), (2, some[-9]), (12, some[-9]), (3, "Two"), (4, "the of"), (5, ""), (6, None), (7, "never seen words at all"), (None, some[-12]), (8, "X"), (9, "abé")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = rows(decontamination.hits(odd, bench).drop("_f", "_r"))
    assert got == sorted(_hits(pairs(odd), items), key=repr)
    assert any(r[2] for r in got)


def test_windows_of_the_given_benchmark(spark, given):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    got = rows(decontamination.hits(given, bench).drop("_f", "_r"))
    assert got == sorted(_hits(pairs(given), items), key=repr)
    assert decontamination.clean(given, bench).count() == sum(1 for r in got if r[2] == 0)


def test_no_items_no_hits(spark, given, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.hits(given, none).where("n_hit > 0 or n_items > 0 or items <> ''").count() == 0
    assert decontamination.hits(empty, none).collect() == []


def _base(text):
    w = WORD.findall(lower(text))
    places = [(k, label) for p, label in licenses.PHRASES for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
    at = [k for k, _ in places]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def test_license_places(spark, odd, given):
    extra = [(900, "x CC-BY y. All rights, reserved; cc by cc by"), (901, "all rights all rights reserved GENERAL public License general"), (902, "rights reserved")]
    docs = odd.select("doc_id", "text").union(given.select("doc_id", "text")).union(spark.createDataFrame(extra, "doc_id long, text string"))
    got = rows(licenses.scan(docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"))
    assert got == sorted(((i, *_base(t)) for i, t in pairs(docs)), key=repr)


def test_license_wordings(spark):
    rng = ["alpha beta the of and", "this is free text to any person", "under the sun"]
    texts = {
        1: "foo bar Released under the MIT License. more",
        2: "Licensed under the Apache License, Version 2.0.",
        3: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the",
        4: "This work is licensed under the GNU General Public License, version 3.",
        5: "the license of the apache tribe",
        6: "we released the license under the bridge of mit",
        7: "Licensed under CC BY-NC 4.0.",
    }
    data = list(texts.items()) + [(100 + i, rng[i % 3]) for i in range(60)]
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got[1] == ("mit", 1.0) and got[2] == ("apache-2.0", 1.0) and got[3][0] == "mit" and got[4] == ("gpl,gpl-3.0", 1.0)
    assert got[5][0] == "" and got[6][0] == "" and got[7] == ("cc-by,cc-by-nc-4.0", 1.0)
    assert all(got[100 + i] == ("", 0.0) for i in range(60))


def test_more_text_removes_no_label(spark):
    said, more = "Code is covered by the MIT License.", "Version two was released in May under a new name."
    texts = [said, f"{more} {said}", f"{said} {more}", f"{more} {said} Licensed products of the Apache tribe. {more}", f"released under {said}"]
    got = {r.doc_id: r.labels for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == dict.fromkeys(range(5), "mit")


def test_license_statements_of_one_text_are_all_found(spark, given):
    notices = "\n".join(f"Part {i} of this product: {text}." for i, (_, text, _) in enumerate(licenses.TEMPLATES))
    docs = given.select("doc_id", "text").union(spark.createDataFrame([(-1, notices)], "doc_id long, text string"))
    (got,) = licenses.scan(docs).where("doc_id = -1").collect()
    assert set(got.labels.split(",")) >= {label for label, _, _ in licenses.TEMPLATES} and got.score == 1.0


def test_words_that_no_text_has_are_not_indexed(spark):
    wordings = (("foo", "hereby unseenone unseentwo unseenthree unseenfour released under the foo license", "foo license"),)
    docs = spark.createDataFrame([(1, "all of it is released under the foo license"), (2, "no foo here")], "doc_id long, text string")
    got = {r.doc_id: r.labels for r in licenses.scan(docs, wordings).collect()}
    assert got == {1: "foo", 2: ""}


def _facts(text):
    w = PLAIN.findall(text or "")
    wins = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    seen = Counter(wins)
    in_twice = set()
    for k, x in enumerate(wins):
        if seen[x] > 1:
            in_twice |= set(range(k, k + 5))
    lines = [x for x in (text or "").split("\n") if PLAIN.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(in_twice)


def _kept(docs, share=quality_rules.SHARE, few=quality_rules.MOST_FEW, diverse=quality_rules.DIVERSE, left=quality_rules.LEFT, least=quality_rules.LEFT_WORDS):
    """`docs`: (doc_id, text, host)."""
    blank = " \t\n\x0b\x0c\r"
    lines = lambda t: [x for x in (y.strip(blank) for y in (t or "").lower().split("\n")) if x]
    texts, hosts = defaultdict(set), defaultdict(set)
    for _, t, h in docs:
        hosts[h].add(t or "")
        for x in lines(t):
            texts[h, x].add(t or "")
    often = {(h, x) for (h, x), ts in texts.items() if len(ts) > max(few, share * len(hosts[h]))}
    longest = lambda h, t: max(((len(w), w) for x in lines(t) if (h, x) not in often for w in PLAIN.findall(x)), default=None)
    above = {(h, x) for h, x in often if len({longest(h, t) for t in texts[h, x]}) >= diverse * len(texts[h, x])}
    for i, t, h in docs:
        n, chars, sym, dup, rep = _facts(t)
        rest = n - sum(len(PLAIN.findall(x)) for x in lines(t) if (h, x) in above)
        failed = n < 10 or 100 * rep > 20 * n
        yield i, n, chars, sym, dup, rep, rest, failed, not failed and (rest >= left * n or rest >= least)


def _all(df):
    return [tuple(r) for r in df.select("doc_id", "text", "source").collect()]


@pytest.mark.parametrize("name", ["odd", "given"])
def test_rules(request, name):
    docs = request.getfixturevalue(name)
    got = quality_rules.judge(docs)
    assert rows(got.drop("_f", "_r")) == sorted(_kept(_all(docs)), key=repr)
    assert quality_rules.kept(docs).count() == got.where("kept").count()


def test_shared_lines_deplete_but_near_copies_stay(spark):
    menu = "home about contact us now\nmore things to read here today"
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(40))
    data = [(i, f"{menu}\n{own(i)}", "h") for i in range(60)] + [(100 + i, f"{menu}\na{i}", "h") for i in range(5)]
    body = [own(1000 + k) for k in range(8)]
    for i in range(50):  # near copies: one line of each is its own
        data.append((200 + i, "\n".join([*body[: i % 8], own(2000 + i), *body[i % 8 + 1 :]]), "h"))
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = quality_rules.judge(df)
    assert rows(got.drop("_f", "_r")) == sorted(_kept(data), key=repr)
    assert {r.doc_id for r in got.where("not kept").collect()} == {100, 101, 102, 103, 104}


@pytest.mark.parametrize("parts", [1, 3])
def test_long_boilerplate_depletes(spark, parts):
    """The boilerplate is the longest line of its documents, in one line or several."""
    own = lambda i, n: " ".join(f"w{i}x{k}" for k in range(n))
    notice = "\n".join(own(9000 + p, 60 // parts) for p in range(parts))
    data = [(i, f"{own(i, 5)}\n{notice}", "h") for i in range(95)]
    data += [(100 + i, f"{own(100 + i, 80)}\n{own(300 + i, 30)}", "h") for i in range(5)]
    data += [(200 + i, f"{own(200 + i, 80)}\n{notice}", "h") for i in range(3)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    assert {r.doc_id for r in quality_rules.judge(df).where("kept").collect()} == {100, 101, 102, 103, 104, 200, 201, 202}


@pytest.mark.parametrize("footers", [190, 200])
def test_frequent_lines_do_not_shield_each_other(spark, footers):
    """A header on all pages, a footer on most, and a title of four words of their own."""
    words = lambda n, i: " ".join(f"{n}{i}x{k}" for k in range(4))
    header, footer = " ".join(f"head{k}" for k in range(40)), " ".join(f"foot{k}" for k in range(50))
    data = [(i, f"{header}\n{words('title', i)}" + (f"\n{footer}" if i < footers else ""), "h") for i in range(200)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = quality_rules.judge(df)
    assert rows(got.drop("_f", "_r")) == sorted(_kept(data), key=repr)
    assert got.where("kept").count() == 0


def test_edited_copies_stay(spark):
    """Near copies that differ in a word or two of a line: what is left of them is much the same."""
    base = [[f"line{k}word{j}" for j in range(12)] for k in range(12)]
    data = []
    for i in range(80):
        copy = [list(x) for x in base]
        copy[i % 12][i % 11] = f"e{i}"
        data.append((i, "\n".join(map(" ".join, copy)), "h"))
    got = quality_rules.judge(spark.createDataFrame(data, "doc_id long, text string, source string"))
    assert rows(got.drop("_f", "_r")) == sorted(_kept(data), key=repr) and got.where("not kept").count() == 0


def test_a_column_named_like_the_file_metadata(spark, tmp_path):
    """As text, and as a struct with the same fields, in files and in frames."""
    words = " ".join(f"w{k}" for k in range(20))
    frame = spark.createDataFrame([(i, f"{words} {i}", "h", "x", ("same", 7)) for i in range(6)], "doc_id long, text string, source string, a string, b struct<file_path string, row_index long>")
    for c in "ab":
        df = frame.select("doc_id", "text", "source", frame[c].alias("_metadata"))
        df.write.parquet(str(tmp_path / c))
        for docs in (df, spark.read.parquet(str(tmp_path / c))):
            kept = quality_rules.kept(docs)
            assert kept.count() == 6 and kept.columns == docs.columns
            bench = spark.createDataFrame([(1, f"{words} 3")], "item_id long, text string")
            assert decontamination.clean(docs, bench).count() == 0 and licenses.scan(docs).count() == 6


@pytest.mark.parametrize("apply", [quality_rules.judge, quality_rules.kept, licenses.scan])
def test_no_rows_give_no_rows(empty, apply):
    assert apply(empty).collect() == []
