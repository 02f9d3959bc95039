"""Operators in DataFrame functions: URL filter, quality rules, decontamination, line templates."""

from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from riskmart.llm import decontaminate, line_templates, quality, url_filter

from . import line_brute
from .conftest import prose, sentence

URLS = ["https://A.Example.org/es/1", "http://example.org/en/12?x#y", "http://example.org/en/2", "http://x.com/fr/", "http://x.com/de",
        "http://x.com/de/1", "http://xcom/fr/", "http://com/fr/a", "http://org", "http://org/", "HTTP://myexample.org/es/", "no url", "",
        None, "http://a.net/casino/x", "http://a.net/mycasino/x", "http://ads1.b.net/x", "http://a.net/wp-login.php",
        "http://a://b/c", "http://org/casino", "http://user@h.com:80/fr/x", "x" * 50_000, "http://ÄB.com/fr/é"]


def test_url_rules_either_way(spark, ordered):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)] * 2, "page_id long, url string")
    pages = pages.select("*", *[F.lit(1).alias(c) for c in ("host", "path", "rule", "verdict", "row", "subject", "best")])
    rules = (*url_filter.QUERY_RULES, *url_filter.METHOD_RULES)
    inline = ordered(url_filter.judge_urls(pages, rules), "row.page_id", "host", "path", "rule", "verdict")
    assert inline == ordered(url_filter.judge_urls(pages, rules, inline_rules=0), "row.page_id", "host", "path", "rule", "verdict")
    by_url = {URLS[r[0]]: r[1:] for r in inline}
    assert by_url["https://A.Example.org/es/1"] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert by_url["http://example.org/en/12?x#y"] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert by_url["http://example.org/en/2"][2:] == ("org/", "allow")
    assert by_url["http://x.com/de"][2:] == (None, "allow") and by_url["http://x.com/de/1"][2:] == ("com/de/", "block")
    assert by_url["http://org"] == ("org", "", None, "allow") and by_url["http://com/fr/a"][2] == "com/fr/"
    assert by_url["HTTP://myexample.org/es/"][2:] == ("org/", "allow")
    assert by_url[None] == ("", "", None, "allow") == by_url["no url"]
    assert by_url["http://a.net/casino/x"][3] == "block" and by_url["http://a.net/mycasino/x"][3] == "allow"
    assert by_url["http://org/casino"][3] == "allow" and by_url["http://user@h.com:80/fr/x"][2] is None
    assert by_url["http://ÄB.com/fr/é"][0] == "Äb.com"
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0
    assert url_filter.filter_urls(pages).columns == pages.columns


def test_rules_are_filed_under_their_rarest_token(spark):
    urls = spark.createDataFrame([("example.org/es/a",), ("example.org/b",), ("x.org/c",)], "subject string")
    index = url_filter.rule_index(urls, url_filter.QUERY_RULES[:3])
    assert {t: [r.name for r in rs] for t, rs in index.items()} == {
        "org": ["org/"], "es": ["example.org/es/"], "en": ["example.org/en/1"]}


def base(text):
    text = text or ""
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", text) if x]
    runs: dict = {}
    for i in range(len(w) - 2):
        runs.setdefault(tuple(w[i:i + 3]), []).append(i)
    rep = {i + j for at in runs.values() if len(at) > 1 for i in at for j in range(3)}
    full = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(full) - len(set(full)), len(rep))


def test_quality_measures(spark, edge, edge_clashing, empty, ordered):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("a b c dd é | #x").strip() for _ in range(n)) for n in (0, 1, 2, 3, 4, 50, 200)]
    texts += ["a\n\na\n a\na", "x y z x y z x", None, "menu | home | about | more\n" + prose(rng), prose(rng) + "\nAll rights reserved."]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").unionByName(edge.select("doc_id", "text"))
    got = quality.judge(rows, "doc_id").collect()
    want = rows.collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted((str(r["doc_id"]), *(r[n] for n in names)) for r in got) == sorted((str(r["doc_id"]), *base(r["text"])) for r in want)
    assert all(r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) for r in got)
    assert ordered(quality.judge(edge, "doc_id")) == ordered(quality.judge(edge_clashing, "doc_id"))
    assert quality.judge(empty, "doc_id").count() == 0
    kept = {r["doc_id"]: r["text"] for r in quality.clean(rows).collect() if r["doc_id"] in (10, 11)}
    assert kept == {10: texts[10].partition("\n")[2], 11: texts[11].partition("\n")[0]}
    assert quality.clean(edge_clashing).columns == edge_clashing.columns


def test_pages_of_menus_are_rejected(spark):
    menu = "\n".join("Home | News | Sports | Weather | More" for _ in range(30))
    df = spark.createDataFrame([(1, menu + "\n" + "A sentence of the text. " * 2)], "doc_id long, text string")
    assert quality.clean(df).count() == 0


@pytest.mark.parametrize("broadcast", [64 << 20, 0])
def test_substitutions_are_tolerated(spark, monkeypatch, edge_clashing, empty, broadcast):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", broadcast)
    rng = random.Random(9)
    item = prose(rng, 4).split()[:40]
    changed = list(item)
    for i in (5, 13, 21, 29):
        changed[i] = "other"
    far = [w if i % 2 else "z" for i, w in enumerate(item)]
    docs = [(1, prose(rng) + " " + " ".join(item).upper() + " " + prose(rng)), (2, " ".join(changed)), (3, " ".join(far)),
            (4, prose(rng)), (5, " ".join(item[:17]) + " " + prose(rng)), (6, None), (7, ""), (8, " ".join(item[:7]))]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "short one"), (None, prose(rng)), (3, None), (1, " ".join(item))],
                                  "item_id long, text string")
    df = spark.createDataFrame([*docs, docs[0]], "doc_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.report(df, bench).collect()}
    assert {i for i, r in got.items() if r["contaminated"]} == {1, 2, 5}
    assert got[1]["item_ids"] == "1" and got[1]["matched"] == 16
    assert decontaminate.report(df, bench).count() == 9
    assert decontaminate.report(df, bench.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.report(empty, bench).count() == 0
    left = decontaminate.decontaminate(edge_clashing, bench)
    assert left.columns == edge_clashing.columns and left.count() == edge_clashing.count()


def test_every_accepted_exchange_is_found(spark):
    """All ways to exchange a quarter of the words of items and windows of 8 to 16 words, and one word more than that."""
    rng = random.Random(19)
    word = lambda: "".join(rng.choice("bcdfghklmnp") for _ in range(7))
    items, docs, want = [], [], set()
    for n in range(8, 17):
        item = [word() for _ in range(n)]
        items.append((n, " ".join(item)))
        ways = list(itertools.combinations(range(n), n // 4)) + rng.sample(list(itertools.combinations(range(n), n // 4 + 1)), 20)
        for exchanged in ways:
            text = [word() if i in exchanged else w for i, w in enumerate(item)]
            docs.append((len(docs), " ".join([word() for _ in range(rng.randrange(4))] + text + [word()])))
            want |= {len(docs) - 1} if len(exchanged) == n // 4 else set()
    for n in (4, 5, 6, 7):
        item = [word() for _ in range(n)]
        items.append((100 + n, " ".join(item)))
        docs.append((len(docs), f"{word()} {' '.join(item)} {word()}"))
        want |= {len(docs) - 1} if n >= 5 else set()
        docs.append((len(docs), " ".join([word(), *item[:-1], word()])))
    found = decontaminate.report(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {r["doc_id"] for r in found.filter("contaminated").collect()} == want


@pytest.mark.parametrize("period", range(2, 9))
def test_exchange_periods(spark, period):
    """Every ``period``-th word of a long passage exchanged, alone and with its neighbour, against a 16-word window."""
    rng = random.Random(period)
    item = prose(rng, 12).split()[:60]
    docs = [[("zz" if i % period in gone else w) for i, w in enumerate(item)] for gone in ({0}, {0, 1}, {period - 1})]
    found = decontaminate.report(spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string"),
                                 spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"))
    plain = [[w.lower().strip(".") for w in d] for d in (item, *docs)]
    most = [max(sum(a == b for a, b in zip(d[i:i + 16], plain[0][i:i + 16])) for i in range(45)) for d in plain[1:]]
    assert {r["doc_id"]: r["contaminated"] for r in found.collect()} == {i: 4 * m >= 48 for i, m in enumerate(most)}


@pytest.mark.parametrize("seed", range(4))
def test_line_dedup_equals_plain_python(spark, seed):
    rng = random.Random(seed)
    stock = [sentence(rng, rng.randrange(1, 8)) for _ in range(25)]
    name = lambda: sentence(rng, 1)[:-1]
    kinds = [lambda: f"User {rng.randrange(99)} has seen {name()} today", lambda: f"User has given {name()} to {name()}", lambda: rng.choice(stock),
             lambda: rng.choice(stock[:5]), lambda: prose(rng, 1), lambda: "", lambda: f"{rng.randrange(50)} views"]
    docs = [(i, "\n".join(rng.choice(kinds)() for _ in range(rng.randrange(1, 9)))) for i in range(160)]
    copied = "\n".join(stock[:12])
    docs += [(200 + i, "\n".join([*stock[:i % 12], prose(rng, 1), *stock[i % 12 + 1:12]]) if i % 2 else copied) for i in range(30)]
    docs += [(1, None), (2, ""), (5, docs[5][1]), (6, "User 3 has seen him today")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, line_templates.report(df).collect()), key=str)
    assert got == sorted(line_brute.report(docs), key=str) and any(r[2] for r in got)


def test_line_dedup_of_the_sample_equals_plain_python(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = sorted(map(tuple, line_templates.report(df).collect()), key=str)
    assert got == sorted(line_brute.report([tuple(r) for r in df.collect()]), key=str) and sum(r[2] for r in got) > 100


def test_templates_recur_and_copies_stay(spark, edge, edge_clashing, empty, ordered):
    rng = random.Random(6)
    copied = "\n".join(prose(rng, 3) for _ in range(6))
    rows = [(i, "\n".join(prose(rng, 4) for _ in range(4)) + f"\nVisitor number {i * 37} since 1999 thanks you") for i in range(30)]
    rows += [(100 + i, copied) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in line_templates.report(df).collect()}
    assert all(got[i]["n_dropped"] == 1 and got[i]["cleaned"] == rows[i][1].rpartition("\n")[0] for i in range(30))
    assert all(got[100 + i]["n_dropped"] == 0 and got[100 + i]["cleaned"] == copied for i in range(40))
    assert ordered(line_templates.report(edge)) == ordered(line_templates.report(edge_clashing))
    assert line_templates.report(edge).filter("n_dropped > 0").count() == 0
    assert line_templates.report(empty).count() == 0
    dropped = line_templates.drop_lines(edge_clashing)
    assert dropped.columns == edge_clashing.columns and ordered(dropped) == ordered(edge_clashing)


def test_boilerplate_goes_whatever_its_share(spark):
    rng = random.Random(16)
    footer = "\n".join(["Contact us", *(prose(rng, 1) for _ in range(11))])
    copied = [prose(rng, 1) for _ in range(14)]
    rows = [(i, sentence(rng) + "\n" + footer) for i in range(40)]
    rows += [(100 + i, "\n".join(prose(rng, 2) for _ in range(40)) + "\n" + footer) for i in range(5)]
    near = [(200 + i, "\n".join([*copied[:i % 14], sentence(rng), *copied[i % 14 + 1:]])) for i in range(60)]
    df = spark.createDataFrame(rows + near, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in line_templates.report(df).collect()}
    assert all(got[i]["n_dropped"] == 12 and got[i]["cleaned"] == text.removesuffix("\n" + footer) for i, text in rows)
    assert all(got[i]["cleaned"] == text for i, text in near)


def test_a_leaf_holds_several_templates(spark):
    rng = random.Random(26)
    name = lambda: sentence(rng, 1)[:-1]
    kinds = [lambda: f"User has been seen by {name()} at the northern gate today",
             lambda: f"User has been given old {name()} keys for one more year",
             lambda: f"User has been told that {name()} will not come back again"]
    rows = [(i, "\n".join([prose(rng, 3), kinds[i % 3](), prose(rng, 3)])) for i in range(90)]
    rows += [(90 + i, "\n".join([prose(rng, 3), "User has been logged out because of a long idle time", prose(rng, 3)])) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in line_templates.report(df).collect()}
    assert all(r["n_dropped"] == 1 and r["cleaned"].split("\n") == rows[i][1].split("\n")[::2] for i, r in got.items())
    mixed = {r["doc_id"]: r for r in line_templates.report(df.filter("doc_id < 90")).collect()}
    assert all(r["n_dropped"] == 1 for r in mixed.values())
