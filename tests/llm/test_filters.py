"""Quality rules, URL filter, decontamination and license scan."""

import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from basketloom.llm import decontaminate, licenses, quality_rules, url_filter
from basketloom.llm.oracle import llm_oracles
from basketloom.llm.queries import URL_RULES, op2_quality_rules, op10_url_filter
from tests.llm.conftest import prose


def base_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_base_counts(make_docs, messy_rows):
    rows = [*messy_rows, (30, "a b c a b c a b"), (31, "#a |b|\n\n#a |b|\n \n"), (32, "x " * 70), (33, "\x0b\x0ca b\r\nc\x85d\xa0e a b\nc\x85d\xa0e")]
    got = sorted((tuple(r) for r in quality_rules.quality_rules(make_docs(rows)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()), key=repr)
    assert got == sorted(((r[0], *base_by_hand(r[1])) for r in rows), key=repr)


def test_divergence_rejects_odd_texts_and_keeps_others(make_docs):
    good = [(i, prose(i, 150)) for i in range(40)]
    odd = [(100, " | ".join(f"w{i}" for i in range(120))), (101, prose(3, 150).upper()), (102, prose(4, 150).replace(" ", "$$$ "))]
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality_rules.quality_rules(make_docs(good + odd)).collect()}
    assert all(got[i][1] or got[i][0] for i, _ in good) and sum(got[i][1] for i, _ in good) > 30
    assert not any(got[i][1] for i, _ in odd)


def test_rules_without_references_or_rows(make_docs):
    rows = quality_rules.quality_rules(make_docs([(1, prose(1, 400), None), (2, prose(2, 400), "xx")]))
    assert [r["kept"] for r in rows.collect()] == [not r["base_failed"] for r in rows.collect()]
    assert quality_rules.quality_rules(make_docs([])).count() == 0


@pytest.mark.parametrize("query", [op2_quality_rules, op10_url_filter])
def test_sql_gives_the_same(spark, data_dir, query):
    con = duckdb.connect()
    for name in ("documents", "pages"):
        con.sql(f"create view {name} as select * from '{data_dir}/{name}.parquet'")
    out = query(spark, data_dir)
    want = con.sql(llm_oracles()[query.__name__])
    assert sorted(out.columns) == sorted(want.columns)
    assert sorted(map(tuple, out.select(*want.columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)


def test_no_python_on_the_native_paths(spark, data_dir):
    for query in (op2_quality_rules, op10_url_filter):
        plan = query(spark, data_dir)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas", plan)


URLS = [None, "", "no scheme/x", "://", "http://", "HTTP://WWW.Example.ORG/es/1?q#f", "http://example.org/en/12", "http://a.com/fr/", "http://com/de/x",
        "http://xcom/de/x", "http://a.org", "http://a.org?x=/", "http://b.net/p#x?y", "http://m.b.net/p.html?z", "ftp://b.net/p/", "http://b.net/other",
        "x://y://z/p", "http://é.net/ü\nz"]


def url_by_hand(url, listed):
    cut = url.partition("://")[2] if url else ""
    host = re.match(r"[^/?#]*", cut)[0]
    path = re.match(r"[^?#]*", cut[len(host):])[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [r for r in URL_RULES if (host == r[1].partition("/")[0] or host.endswith("." + r[1].partition("/")[0]))
            and path.startswith("/" + r[1].partition("/")[2])]
    rule = max(fits, key=lambda r: len(r[1]), default=None)
    key = re.sub(r"^(www|m)\.", "", host) + re.sub(r"(\.html|/+)\Z", "", path)
    return host, path, rule and rule[1], rule[0] if rule else "block" if key and key in listed else "allow"


@pytest.mark.parametrize("blocks", [1, url_filter.MAX_BLOCKS])
@pytest.mark.parametrize("listed", [[], ["b.net/p", None, "b.net/p", "a.org/x"], [f"h{i}.net/x" for i in range(3000)] + ["b.net/p"]])
def test_urls(spark, listed, blocks):
    """One block is a filter that lets nearly all pass; the verdicts stay."""
    rows = [(i, u, "x", "y") for i, u in enumerate([*URLS, *URLS[-6:]])]
    pages = spark.createDataFrame(rows, "page_id long, url string, block string, canonical string")
    known = spark.createDataFrame([(x,) for x in listed], "canonical string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(pages, known, URL_RULES, max_blocks=blocks).collect()}
    assert got == {i: url_by_hand(u, listed) for i, u, *_ in rows}
    assert url_filter.filter_urls(pages.limit(0), known, URL_RULES).count() == 0


def edit_distance_inside(pattern, text):
    before = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        now = [i]
        for j, b in enumerate(text, 1):
            now.append(min(before[j - 1] + (a != b), before[j] + 1, now[-1] + 1))
        before = now
    return min(before)


def changed(text, rng, n):
    out = list(text)
    for _ in range(n):
        at, kind = rng.randrange(len(out)), rng.randrange(3)
        out[at : at + 1] = [out[at], rng.choice("abc")] if kind == 0 else [rng.choice("abc")] if kind == 1 else []
    return "".join(out)


def test_alignment_against_the_whole_table():
    rng = random.Random(6)
    for _ in range(400):
        pattern = "".join(rng.choice("abc") for _ in range(rng.randint(5, 25)))
        text = "".join(rng.choice("abc") for _ in range(rng.randint(0, 4))) + changed(pattern, rng, rng.randint(0, 4)) + "c" * rng.randint(0, 3)
        best, got = edit_distance_inside(pattern, text), decontaminate.banded_distance(decontaminate._points(pattern), decontaminate._points(text), 4)
        assert (got is None) == (best > 4)
        if got:
            assert got[0] == best == edit_distance_inside(pattern, text[got[1] : got[2]])


@pytest.mark.parametrize("block_windows", [3, 50_000])
def test_leaks_are_found_and_others_left(spark, make_docs, messy_rows, block_windows):
    rng = random.Random(8)
    items = [(i, prose(300 + i, 45)) for i in range(12)] + [(50, None), (51, "short"), (52, ""), (0, prose(300, 45))]
    benchmark = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    rows = [(i, t) for i, t, *_ in messy_rows if i != 10]
    leaks = {}
    for i in range(8):
        text = decontaminate.normal(items[i][1].encode())
        kind = [text, text.upper(), text.replace(" ", " \n "), changed(text, rng, 3), text[:170], text[20:190]][i % 6]
        rows.append((200 + i, prose(i, 40) + " " + kind + " " + prose(50 + i, 40)))
        leaks[200 + i] = i
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.contaminated(make_docs(rows), benchmark, block_windows=block_windows).collect()}
    assert {k: v for k, v in got} == leaks
    assert got[200, 0]["edits"] == 0 and 0 <= got[203, 3]["edits"] <= 5
    for (doc, item), r in got.items():
        text = decontaminate.normal(dict(rows)[doc].encode())
        assert edit_distance_inside(decontaminate.normal(dict(items)[item].encode())[: decontaminate.WINDOW], text) <= 170 and r["begin"] < r["end"] <= len(text)


def test_leaks_of_empty_tables(spark, make_docs, messy_rows):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(make_docs(messy_rows), none).count() == 0
    assert decontaminate.contaminated(make_docs([]), spark.createDataFrame([(1, prose(1))], "item_id long, text string")).count() == 0


def test_licenses_and_their_directories(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [(1, "LICENSE", gpl), (2, "a/x.txt", "prose\nall of it"), (3, "a/b/LICENSE.md", f"text first\n{mit}\nmore text"), (4, "a/b/c/d.txt", None),
            (5, "a/b/c/own.txt", "some\nLICENSED UNDER THE APACHE LICENSE, VERSION 2.0"), (6, "a/b/c/NOTICE", "no license in here at all"),
            (7, "top.txt", ""), (8, None, "x"), (9, None, mit), (9, None, mit), (10, "z/COPYING", mit), (11, "z/LICENSE", gpl), (12, "z/q", "x"),
            (13, "a/licenses.txt", "the mit of prose with mit mit mit and public domain words all over the place here")]
    files = spark.createDataFrame([(*r, 0.1, "d") for r in rows], "doc_id long, path string, text string, cosine double, dir string")
    got = sorted(((r["doc_id"], r["license"], r["how"], r["from_dir"]) for r in licenses.scan_licenses(files).collect()), key=repr)
    want = [(1, "GPL-3.0", "own", None), (2, "GPL-3.0", "inherited", ""), (3, "MIT", "own", None), (4, "MIT", "inherited", "a/b"),
            (5, "Apache-2.0", "own", None), (6, "MIT", "inherited", "a/b"), (7, "GPL-3.0", "inherited", ""), (8, None, None, None), (9, "MIT", "own", None),
            (9, "MIT", "own", None), (10, "MIT", "own", None), (11, "GPL-3.0", "own", None), (12, "GPL-3.0", "inherited", "z"), (13, "GPL-3.0", "inherited", "")]
    assert got == sorted(want, key=repr)
    assert licenses.scan_licenses(files.limit(0)).count() == 0


def test_cosine_by_hand(spark):
    files = spark.createDataFrame([(1, "a", "Licensed under CC BY 4.0. okay"), (2, "b", "x")], "doc_id long, path string, text string")
    cosine = licenses.scan_licenses(files).where("doc_id = 1").select(F.round("cosine", 9)).first()[0]
    import math
    seen, unseen = math.log(3 / 2) + 1, math.log(3) + 1
    assert cosine == pytest.approx(5 * seen**2 / (math.sqrt(5 * seen**2 + unseen**2) * math.sqrt(5 * seen**2)))


def test_no_line_near_a_template_is_passed_over():
    rng, vocabulary = random.Random(12), sorted({t for x in licenses.TEMPLATES.values() for t in licenses.terms(x)})
    idf = {t: rng.choice([1.0, 1.5, 6.0]) for t in vocabulary}
    matcher, near = licenses.Matcher(licenses.TEMPLATES, idf, 8.0), 0
    for _ in range(4000):
        words = licenses.terms(rng.choice(list(licenses.TEMPLATES.values())))
        line = "_".join(w for w in words if rng.random() < 0.8) + rng.choice(["", " other", "\u00e9"])
        best = -matcher.best(line)[0]
        if best >= licenses.THRESHOLD:
            near += 1
            assert matcher.scan(f"prose\n{line}\n")[::2] == (best, 1)
        else:
            assert matcher.scan(line)[0] <= best
    assert 500 < near < 4000


def test_terms_end_with_their_run_of_letters():
    assert licenses.terms("GPL-2.0x v1.2.3, cc0 4.0.") == ["gpl", "2", "0x", "v1.2.3", "cc0", "4.0"]


MIT_TEXT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
APACHE_HEADER = ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
                 "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0")
LGPL_WRAPPED = """# Foo is free software: you can redistribute it and/or modify
# it under the terms of the GNU Lesser General Public License
# as published by the Free Software Foundation, either version 3 of
# the License, or (at your option) any later version."""


def test_license_files_titles_headers_and_notices_in_long_lines(spark):
    """Whole licence files without a one-line notice, wrapped headers, titles over two lines, tags, notices inside a line."""
    folder = licenses.__file__.rpartition("/")[0] + "/license_texts/"
    gpl, apache = (open(f"{folder}{name}.txt").read() for name in ("GPL-3.0", "Apache-2.0"))
    cases = {
        "mit/LICENSE": ("Copyright (c) 2020 Foo\n\n" + MIT_TEXT, "MIT"), "gpl/COPYING": (gpl, "GPL-3.0"), "apache/LICENSE": (apache, "Apache-2.0"),
        "t/1": ("MIT License", "MIT"), "t/2": ("The MIT License (MIT)\n\nCopyright Foo", "MIT"),
        "t/3": ("   GNU GENERAL PUBLIC LICENSE\n      Version 3, 29 June 2007\n" + prose(5), "GPL-3.0"), "t/4": ("Apache License\nVersion 2.0, January 2004", "Apache-2.0"),
        "t/5": ("// SPDX-License-Identifier: Apache-2.0\nint x;", "Apache-2.0"), "t/6": ("SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"),
        "t/7": (prose(6) + "\n" + APACHE_HEADER + " " + prose(7), "Apache-2.0"), "t/8": (LGPL_WRAPPED + "\n" + prose(8), "LGPL-3.0"),
        "t/9": (prose(9) + " Copyright 2020 Foo Inc. Released under the MIT License. " + prose(10), "MIT"),
        "t/10": ("Released under\nthe MIT\nLicense.", "MIT"), "t/11": ("/* " + MIT_TEXT.replace("\n", "\n * ") + " */\n" + prose(11, 900), "MIT"),
        "n/1": ("a word on the MIT license of old", None), "n/2": ("SPDX-License-Identifier: ISC", None), "n/3": (prose(12, 2000), None)}
    inside = {"mit/src/a.c": "MIT", "gpl/x/y/b.c": "GPL-3.0", "apache/c.c": "Apache-2.0"}
    rows = [(i, path, text) for i, (path, text) in enumerate([*((p, t) for p, (t, _) in cases.items()), *((p, "int main() {}") for p in inside)])]
    rows += [(1000 + i, None, prose(500 + i)) for i in range(60)]
    got = {r["path"]: (r["license"], r["how"]) for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    got.pop(None)
    want = {p: (name, name and "own") for p, (_, name) in cases.items()} | {p: (name, "inherited") for p, name in inside.items()}
    assert got == want


def test_window_cosines_by_hand():
    """Against every window counted by itself."""
    from basketloom.llm.license_forms import Form, Windows

    rng, words = random.Random(3), "a b c d e x y z".split()
    forms = [Form("one", "a b c"), Form("two", "a a d e b", keys=frozenset("d")), Form("three", "c d", aligned=True)]
    idf = dict(zip("abcde", [1.0, 2.5, 1.5, 3.0, 1.2], strict=True))
    scanner = Windows(forms, licenses.terms, idf, 4.0, 0.8)

    def cosine(window, form):
        p, q = ({t: n * idf.get(t, 4.0) for t, n in Counter(x).items()} for x in (window, licenses.terms(form)))
        return sum(p[t] * q.get(t, 0) for t in p) / (sum(x * x for x in p.values()) * sum(x * x for x in q.values())) ** 0.5

    hits = 0
    for _ in range(600):
        lines = [[rng.choice(words) for _ in range(rng.randint(1, 5))] for _ in range(rng.randint(1, 6))]
        flat = [(w, i, k == 0, k == len(x) - 1) for i, x in enumerate(lines) for k, w in enumerate(x)]
        best = 0.0
        for f in forms:
            size = min(len(licenses.terms(f.text)), len(flat))
            for at in range(len(flat) - size + 1):
                part = flat[at : at + size]
                c = cosine([w for w, *_ in part], f.text)
                fits = f.keys <= {w for w, *_ in part} and (not f.aligned or (part[0][2] and part[-1][3] and c >= 0.9))
                if fits and c >= 0.8:
                    best = max(best, c)
        got = scanner.scan("\n".join(map(" ".join, lines)), licenses._TERM.finditer, True)
        assert got[0] == pytest.approx(best)
        hits += best > 0
    assert 100 < hits < 600


def plain(rng, n, common):
    made = ["".join(rng.choice("bcdfglmnrst") + rng.choice("aeiou") for _ in range(rng.randint(2, 4))) for _ in range(400)]
    return " ".join(rng.choice(quality_rules.COMMON_WORDS["en"]) if rng.random() < common else rng.choice(made) for _ in range(n))


def test_texts_without_common_words_go(make_docs):
    """About a sixth of the words of the clean texts are common ones, as in the given tables."""
    rng = random.Random(21)
    clean = [(i, plain(rng, 300, 0.16)) for i in range(60)]
    bare = [(100 + i, plain(rng, n, 0)) for i, n in enumerate((100, 150, 400))]
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality_rules.quality_rules(make_docs([*clean, *bare])).collect()}
    assert not any(failed for failed, _ in got.values())
    assert all(got[i][1] for i, _ in clean) and not any(got[i][1] for i, _ in bare)


RUSSIAN = "в этом городе жили люди, которые каждый день ходили на работу через старый мост и говорили о погоде.".split()
POLISH = "w tym mieście mieszkali ludzie, którzy codziennie chodzili do pracy przez stary most i rozmawiali o pogodzie.".split()


def test_languages_without_a_word_list_are_kept_and_their_symbols_are_not(make_docs):
    rng = random.Random(22)
    clean = [(i, plain(rng, 300, 0.16)) for i in range(20)]

    def mixed(words):
        return " ".join(rng.choice(words) for _ in range(300))

    other = [(100, mixed(RUSSIAN), "ru"), (101, mixed(POLISH), "pl")]
    odd = [(110, mixed(RUSSIAN).replace(" ", "|#| "), "ru"), (111, mixed(POLISH).upper(), "pl")]
    rows = quality_rules.quality_rules(make_docs([*clean, *other, *odd])).where("doc_id >= 100").collect()
    assert {r["doc_id"]: r["kept"] for r in rows if not r["base_failed"]} == {100: True, 101: True, 110: False, 111: False}
    assert all(r["word_distance"] is None for r in rows)


@pytest.mark.parametrize("block_windows", [1, 50_000])
def test_short_items_are_found_as_whole_words(spark, make_docs, block_windows):
    benchmark = spark.createDataFrame([(1, "What is  two plus two?"), (2, "red green sun"), (3, "too short"), (4, prose(7, 45))], "item_id long, text string")
    rows = [(10, "He asked: WHAT is two\nplus two? Nobody knew."), (11, "what is two plus three?"), (12, "a red green sunday, a red green sun"),
            (13, "a bored green sun"), (14, "a red green sunday"), (15, "too short"), (16, "red green sun")]
    got = decontaminate.contaminated(make_docs(rows), benchmark, block_windows=block_windows).collect()
    assert sorted((r["doc_id"], r["item_id"], r["begin"], r["end"], r["edits"]) for r in got) == [
        (10, 1, 10, 31, 0), (12, 2, 22, 35, 0), (16, 2, 0, 13, 0)]


def test_whole_operator_against_all_windows_by_brute_force(spark, make_docs):
    """Every window of every item aligned with every whole text by the full table: the same pairs, counts and fewest edits."""
    rng = random.Random(31)
    items = [(i, prose(700 + i, 9 + 6 * i)) for i in range(4)] + [(9, prose(700, 9) + " and " + prose(720, 12))]
    rows = [(100, prose(800, 30)), (101, ""), (102, None)]
    for i, edits in enumerate((0, 1, 2, 5, 9)):
        item = items[i % 4][1]
        rows.append((110 + i, f"{prose(810 + i, 8)} {changed(item, rng, edits)} {prose(820 + i, 8)}"))
        rows.append((120 + i, f"{item[len(item) // 4 :]}\n{changed(items[4][1], rng, i)}"))
    want = {}
    for doc, text in rows:
        text = decontaminate.normal((text or "").encode())
        for item, passage in items:
            passage = decontaminate.normal(passage.encode())
            last = max(0, len(passage) - decontaminate.WINDOW)
            best = []
            for at in {*range(0, last, decontaminate.STEP), last}:
                window = passage[at : at + decontaminate.WINDOW]
                assert len(window) >= decontaminate.EXACT_BELOW
                edits = edit_distance_inside(window, text)
                best += [edits] if edits <= decontaminate.edit_budget(len(window)) else []
            if best:
                want[doc, item] = (len(best), min(best))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for block_windows in (2, 50_000):
        found = decontaminate.contaminated(make_docs(rows), benchmark, block_windows=block_windows).collect()
        assert {(r["doc_id"], r["item_id"]): (r["n_windows"], r["edits"]) for r in found} == want
    assert len(want) > 8 and {0, 1} <= {edits for _, edits in want.values()}


def test_a_text_that_begins_inside_an_item_is_not_its_neighbours_leak(spark, make_docs):
    """The window's first letters are missing; the edits stand before the text, where the text before it ends."""
    item = decontaminate.normal(prose(740, 40)[:90].encode())
    docs = make_docs([(1, prose(830, 30)), (2, item[3:] + " " + prose(831, 20)), (3, prose(832, 30)), (4, prose(833, 20) + " " + item[:-3]), (5, prose(834, 30))])
    found = decontaminate.contaminated(docs.coalesce(1), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["begin"]) for r in found)[0] == (2, 0) and all(3 <= r["edits"] <= 4 for r in found) and {r["doc_id"] for r in found} == {2, 4}
    assert next(r for r in found if r["doc_id"] == 4)["end"] == len(decontaminate.normal((prose(833, 20) + " " + item[:-3]).encode()))
