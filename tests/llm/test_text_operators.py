"""I-Match, line dedup, decontamination, HTML extraction and revisits."""

import hashlib
import random

import duckdb
import pytest

from slotwise.llm import decontaminate as D
from slotwise.llm import html_extract as H
from slotwise.llm import imatch as I
from slotwise.llm import line_dedup as L
from slotwise.llm import warc as W

SF = "/root/testdata/sf0.001"
LONG = "word " * 30_000


def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows, an extra column with a clashing name."""
    return [(None, "no id here", "x"), (1, None, "x"), (2, "", None), (3, LONG, "x"), (3, LONG, "x"), (4, "tie", "x"),
            (4, "tie two", "x"), (5, "one two three four five six seven", None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), "doc_id long, text string, score string")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def duck(sql, sf=SF):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con.sql(sql)


def same(df, sql):
    rel = duck(sql)
    order = [rel.columns.index(c) for c in df.columns]
    assert sorted(map(str, (tuple(r) for r in df.collect()))) == sorted(
        str(tuple(row[i] for i in order)) for row in rel.fetchall())


# line dedup

def test_line_dedup_matches_sql(spark):
    same(L.op3_line_dedup(spark, SF), L.SQL)


def test_line_dedup_rules(spark):
    line = "A shared line that is long enough to count, really"
    rows = [(i, f"own {i}\n  {line.upper() if i % 2 else line}\t\n{line}\nend") for i in range(1, 6)]
    rows += [(9, None), (10, ""), (11, "own\n\n"), (5, rows[4][1])]     # a repeated row changes nothing
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["kept_text"], r["line_count"], r["lines_dropped"])
           for r in L.apply_bitmaps(docs, L.keep_bitmaps(docs)).collect()}
    assert got == {(i, f"own {i}\nend", 4, 2) for i in range(1, 5)} | {
        (5, rows[4][1], 4, 0), (9, "", 1, 0), (10, "", 1, 0), (11, "own\n\n", 3, 0)}
    bitmap = L.keep_bitmaps(docs).filter("doc_id = 1").first()
    assert (bitmap["n_lines"], bitmap["n_dropped"]) == (4, 2)
    assert [tuple(x) for x in bitmap["keep"]] == [(0, 1), (3, 1)]


def test_line_dedup_needs_five_documents_and_forty_characters(spark):
    docs = spark.createDataFrame([(i, "x" * 39 + "\n" + "y" * 40) for i in range(4)] + [(7, "x" * 39)] * 3,
                                 "doc_id long, text string")
    assert L.keep_bitmaps(docs).count() == 0


def test_line_dedup_odd_rows(spark, odd, empty):
    assert L.apply_bitmaps(odd, L.keep_bitmaps(odd)).count() == len(odd_rows())
    assert L.apply_bitmaps(empty, L.keep_bitmaps(empty)).count() == 0


# I-Match

def test_next_text_and_edit_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = {r["doc_id"]: r for r in I.op1_imatch(spark, SF).collect()}
    assert len(got) == len(rows)
    for k, r in enumerate(rows):
        text, after = r["text"], rows[(k + 1) % len(rows)]["text"]
        q = len(text) // 4
        edited = text[:len(text) - q] + after[:q]
        g = got[r["doc_id"]]
        assert (g["n_chars"], g["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= g["near_edited"] <= 1 and 0 <= g["near_next"] <= 1
        assert g["near_edited"] == I.likeness(g["fingerprint"], g["edited_fingerprint"])
    mean = lambda c: sum(r[c] for r in got.values()) / len(got)
    assert mean("near_edited") > 0.4 and mean("near_next") < 0.1


def test_fingerprint_of_odd_texts(spark, odd, empty):
    df, n = I.document_frequencies(odd)
    assert n == len(odd_rows())
    kept = I.kept_slots(df, n)
    prints = I.fingerprints(odd, kept).collect()
    assert len(prints) == len(odd_rows()) and all(r["fingerprint"] for r in prints)
    assert I.fingerprint(None, kept) == I.fingerprint("", kept)
    assert I.fingerprint("b a", kept) == I.fingerprint("a b a", kept)       # a set of terms
    assert I.with_next(odd).count() == len(odd_rows())
    assert I.document_frequencies(empty)[1] == 0 and I.with_next(empty).count() == 0


def test_band_holds_exactly_the_terms_of_its_document_frequencies(spark, monkeypatch):
    from collections import Counter

    import numpy as np
    monkeypatch.setattr(I, "HELD", 5000)
    rng = random.Random(7)
    # a rare vocabulary larger than 2^18, beside common and middling terms
    texts = [" ".join([f"r{d}x{i}" for i in range(1500)] + [f"m{rng.randrange(300)}" for _ in range(20)] + ["the", "The", "of"])
             for d in range(200)]
    df, n = I.document_frequencies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5))
    kept = I.kept_slots(df, n)
    count = Counter(w for t in texts for w in set(t.lower().split()))
    idf = {w: np.log(200 / c) / np.log(200) for w, c in count.items()}
    expected = [w for w, x in idf.items() if I.BAND[0] <= x <= I.BAND[1]]
    assert n == 200 and 200 < len(expected) <= 300
    assert kept.tolist() == I.terms(" ".join(expected)).tolist()
    # terms outside the band leave no trace in a fingerprint
    assert I.fingerprint(texts[0], kept) == I.fingerprint(" ".join(w for w in texts[0].split() if w in set(expected)), kept)


def test_next_text_wraps_over_many_ranges(spark):
    docs = spark.range(100).selectExpr("id * 7 AS doc_id", "concat('t', id) AS text").repartition(5)
    got = {r["doc_id"]: r["next_text"] for r in I.with_next(docs, 13).collect()}
    assert got == {i * 7: f"t{(i + 1) % 100}" for i in range(100)}


def test_likeness_falls_with_edits():
    import numpy as np
    kept = np.ones(1 << I.BITS, bool)
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    base = I.fingerprint(" ".join(words), kept)
    scores = []
    for share in (0, 40, 120, 400):
        changed = words[:]
        for i in rng.sample(range(400), share):
            changed[i] = f"x{i}"
        scores.append(I.likeness(base, I.fingerprint(" ".join(changed), kept)))
    assert scores[0] == 1 and scores == sorted(scores, reverse=True) and scores[-1] < 0.05


# decontamination

def edit_distance_in(item, text):
    """Least edit distance of ``item`` to a substring of ``text``."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_edit_matches_against_brute_force(spark):
    rng = random.Random(5)
    vocabulary = ["lorem", "ipsum", "dolor", "sit", "amet", "elit", "sed", "do", "magna"]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, prose(14)) for i in range(6)]
    docs = []
    for i in range(60):
        passage = list(D.normal(items[i % 6][1]))
        for _ in range(rng.randrange(0, 12)):
            k = rng.randrange(len(passage))
            passage[k:k + 1] = rng.choice([[], ["q"], [passage[k], "z"]])
        docs.append((i, prose(rng.randrange(20)) + " " + "".join(passage) + " " + prose(10)))
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in D.matches(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"), block_chars=200).collect()}
    expected = {}
    for d, text in docs:
        for i, item in items:
            x = D.normal(item)
            n = edit_distance_in(x, D.normal(text))
            if n <= int(D.ERRORS * len(x)):
                expected[d, i] = n
    assert got == expected and 20 < len(got) < 60


def test_matched_span_is_in_the_original_text(spark):
    item = "The  quick, brown fox -- jumps over the lazy dog; again and again."
    text = "Before!\n" + item.upper() + "\nAfter"
    r = D.matches(spark.createDataFrame([(1, text)], "doc_id long, text string"),
                  spark.createDataFrame([(7, item)], "item_id long, text string")).first()
    assert (r["doc_id"], r["item_id"], r["distance"]) == (1, 7, 0)
    assert text[r["start"]:r["end"]] == item.upper()[:-1]


def test_short_items_inside_longer_documents(spark):
    items = [(1, "Who wrote Faust?"), (2, "tie"), (3, "\u6c34\u306e\u5316\u5b66\u5f0f\u306f\u4f55\u3067\u3059\u304b"),
             (4, "Is it so?"), (5, "sit amet elit " * 9)]
    docs = [(1, "Quiz: who wrote  FAUST? Goethe did."), (2, "whoever; who wrote Fausts, xwho wrote faust"), (3, "a tie two"),
            (4, "\u554f\u984c\u6c34\u306e\u5316\u5b66\u5f0f\u306f\u4f55\u3067\u3059\u304b\u3068\u805e\u304f"),
            (5, "who wrote Faust"), (6, "Is it so? Is it so?"), (7, "this it so"), (8, "Tie!")]
    docs, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["distance"], r["start"], r["end"]) for r in D.matches(docs, bench).collect()}
    assert got == {(1, 1): (0, 6, 22), (4, 3): (0, 2, 12), (5, 1): (0, 0, 15), (6, 4): (0, 0, 8), (8, 2): (0, 0, 4)}
    assert {r["doc_id"] for r in D.clean(docs, bench).collect()} == {2, 3, 7}
    # with short items alone, or across the pieces of a long text
    many = spark.createDataFrame([(1, "x " * (D.PIECE // 2 - 3) + "who wrote Faust?")], "doc_id long, text string")
    assert D.matches(many, bench.filter("item_id = 1")).count() == 1


def test_decontamination_of_odd_rows(spark, odd, empty):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "tie"), (None, "one two three four five six seven")],
                                  "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["distance"]) for r in D.matches(odd, bench).collect()}
    assert got == {(4, 3, 0), (5, None, 0)}      # a short item needs the whole text
    assert D.clean(odd, bench).count() == len(odd_rows()) - 2
    assert D.clean(odd, bench).columns == odd.columns
    assert D.matches(empty, bench).count() == 0 and D.matches(odd, bench.limit(0)).count() == 0
    assert D.clean(odd, bench.limit(0)).count() == len(odd_rows())


# HTML

PAGE = """<html><head><title>t</title><style>p{}</style></head><body>
<header><p>Site name and a claim that is long enough to look like the text of a page, with the of and to in it.</p></header>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">About</a></li></ul></nav>
<div class="cookie-notice">We use cookies to make the site work for you and for all of the others.</div>
%s
<aside class="sidebar">Read also the other things that we have.</aside>
<form><label>Mail</label><input name=x><button>Send</button></form>
<div id="comments"><p>I think that this is the best of all the articles that I have read on it so far.</p></div>
<script>var a = "</p><p>no</p>";</script><footer>&copy; 2024 The site. All of the rights.</footer></body></html>"""
STORY = """<h1>A title</h1><p>It was the best of times, it was the worst of times, it was
 the age&nbsp;of <b>wisdom</b> &amp; of &quot;foolishness&quot;.</p><p>Short.<br>line</p>"""
TEXT = 'A title\nIt was the best of times, it was the worst of times, it was the age of wisdom & of "foolishness".\nShort. line'


@pytest.mark.parametrize("open_, close", [("<article>", "</article>"), ("<main>", "</main>"), ("<div class=post>", "</div>"), ("", "")])
def test_main_text_without_furniture(open_, close):
    assert H.main_text(PAGE % (open_ + STORY + close)) == TEXT


@pytest.mark.parametrize("block, text", [
    ('<h1><a href="/x">A linked title of the story</a></h1>', "A linked title of the story"),
    ('<p>See <a href="/x">the whole report</a>.</p>', "See the whole report."),
    ('<p><a href="/x">The whole report</a></p>', "The whole report"),
    ('<h2>Sources</h2><ul><li><a href="/1">One paper</a></li><li><a href="/2">Another paper</a>, 2020</li></ul>',
     "Sources\nOne paper\nAnother paper, 2020")])
@pytest.mark.parametrize("name", ["article", "main"])
def test_links_inside_the_article_are_kept(block, text, name):
    inside = lambda x: H.main_text(PAGE % f"<{name}>{x}</{name}>")
    assert inside(block + STORY) == text + "\n" + TEXT
    assert inside(STORY + block) == TEXT + "\n" + text
    assert inside(block) == text


def test_linked_heading_outside_of_an_article():
    linked = STORY.replace("A title", '<a href="/x">A title</a>')
    assert H.main_text(PAGE % linked) == H.main_text(PAGE % f"<div class=post>{linked}</div>") == TEXT


def test_truncated_and_broken_pages():
    assert H.main_text(None) == H.main_text("") == H.main_text("<p></p><!-- only") == ""
    whole = PAGE % ("<article>" + STORY + "</article>")
    for n in range(0, len(whole), 7):
        assert "var a" not in H.main_text(whole[:n]) and "cookies" not in H.main_text(whole[:n])
    assert H.main_text("a < b &lt; c <b") == "a < b < c"
    assert H.main_text("<p>one<p>two<li>three") == "one\ntwo\nthree"


def test_extract_keeps_rows_and_replaces_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "<p>x y</p>", "old", 9), (1, "<p>x y</p>", "old", 9), (2, None, "old", 9)],
                                  "page_id long, html string, text string, other long")
    got = sorted(tuple(r) for r in H.extract(pages).select("page_id", "text", "n_chars", "other").collect())
    assert got == [(1, "x y", 3, 9), (1, "x y", 3, 9), (2, "", 0, 9)]
    assert H.extract(pages.limit(0)).count() == 0


def test_article_of_every_test_page(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in H.op5_html_extract(spark, SF).collect():
        article = pages[r["page_id"]].split("<article>")[1].split("</article>")[0]
        lines = [" ".join(x.split()) for x in __import__("html").unescape(
            __import__("re").sub("<[^>]+>", "\0", article)).split("\0")]
        assert r["text"].split("\n") == [x for x in lines if x]


# revisits

def test_revisits_match_sql(spark):
    same(W.op7_revisits(spark, SF), W.SQL)


def test_revisit_rules(spark):
    ts = lambda m: f"2024-01-01 00:{m:02d}:00"
    u = "https://WWW.Example.com:443/a/?utm_source=x&b=2&a=1#top"
    old = "HTTP/1.1 200 OK\r\nETag: \"1\"\r\nContent-Type: t\r\nExpires: never\r\nLast-Modified: d"
    responses = spark.createDataFrame(
        [(1, u, ts(1), old, "one"), (2, "http://example.com/a?a=1&b=2", ts(5), old.replace('"1"', '"2"'), "two"),
         (3, u, ts(5), old.replace('"1"', '"3"'), "three"), (4, None, ts(0), old, "no url"), (5, u, None, old, "no time")],
        "record_id long, url string, ts string, block string, digest string").withColumn("extra", __import__("pyspark").sql.functions.lit(1))
    responses = responses.withColumn("ts", responses["ts"].cast("timestamp_ntz"))
    cases = [(10, u, ts(5), 'ETag: W/"1"\nDate: now\nContent-Type: no'), (11, u, ts(6), 'ETag: "3"'), (12, u, ts(6), 'ETag: "2"'),
             (13, u, ts(6), "Last-Modified: d"), (14, u, ts(6), "Date: x"), (15, u, ts(1), 'ETag: "1"'), (16, None, ts(9), 'ETag: "1"'),
             (17, u, None, 'ETag: "1"'), (11, u, ts(6), 'ETag: "3"'), (18, "http://other/", ts(9), None)]
    revisits = spark.createDataFrame(cases, "record_id long, url string, ts string, block string")
    revisits = revisits.withColumn("ts", revisits["ts"].cast("timestamp_ntz"))
    got = [(r["record_id"], r["status"], r["target_id"], r["digest"]) for r in W.resolve(responses, revisits).collect()]
    assert sorted(got, key=str) == sorted([
        (10, "resolved", 1, "one"), (11, "resolved", 3, "three"), (11, "resolved", 3, "three"),
        (12, "validator mismatch", None, None), (13, "resolved", 3, "three"), (14, "no validator", None, None),
        (15, "no response", None, None), (16, "no response", None, None), (17, "no response", None, None),
        (18, "no response", None, None)], key=str)
    headers = W.resolve(responses, revisits.filter("record_id = 10")).first()["headers"]
    assert headers == 'content-type: t\ndate: now\netag: W/"1"\nexpires: never\nlast-modified: d'
    assert W.resolve(responses.limit(0), revisits).count() == len(cases) and W.resolve(responses, revisits.limit(0)).count() == 0


def test_latest_before_over_many_ranges(spark):
    """Equal to a plain window, with a hot key over several ranges and ties of time."""
    import random

    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from slotwise.llm.asof import latest_before
    rnd = random.Random(9)
    rows = [(rnd.choice(["hot", "hot", "a", "b"]), rnd.randrange(300), i, rnd.choice([None, None, i])) for i in range(2000)]
    df = spark.createDataFrame(rows, "url string, t long, id long, v long")
    setting = {"spark.sql.shuffle.partitions": "13", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {k: spark.conf.get(k) for k in setting}
    for k, v in setting.items():
        spark.conf.set(k, v)
    try:
        got = latest_before(df, "url", ["t", "id"], F.col("v"), "out").select("id", "out").collect()
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    w = Window.partitionBy("url").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("out", F.last("v", ignorenulls=True).over(w)).select("id", "out").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_tags_with_very_many_quotes_take_linear_time():
    import time

    from slotwise.llm import html_extract as X
    story = "<article><p>A story of some length that stays here.</p>"
    t = time.time()
    for tail in ('<a ' + 'x="1" ' * 10_000 + "< 3 </article>", "<a " + "x='1\" " * 10_000 + "< 3", '<p title="' + "a'b " * 10_000 + "<"):
        assert X.main_text(story + tail).startswith("A story of some length that stays here.")
    assert time.time() - t < 1
    assert X.main_text('<article><p title="x>y">One <b class=\'a>b\'>two</b>.</p></article>') == "One two."
