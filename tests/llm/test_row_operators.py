"""HTML extraction, personal data and quality rules against plain Python."""

import hashlib
import random
import re
import time
from collections import Counter

import pytest
from awkward import clashing, documents, empty, rows

from carriageway.llm import html_text, pii, quality_rules

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><a href="/">Site</a></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<div id="sidebar">Side text that goes on for quite a while, longer than the article is</div>
<article class="post"><header><h1>A &amp; B</h1></header><p>First <b>bold
text</b>&nbsp;here.<br>Next line<p>Second &#233;.</p><ul><li>one<li>two</ul><form><input><p>Search</p></form><!-- note -->
<div class="ad">Buy now</div><section class="comments"><p>Reader says hi</p></section></article><footer>&copy; all</footer></body></html>"""


@pytest.mark.parametrize("html, text", [
    (PAGE, "A & B\nFirst bold text here. Next line\nSecond é.\none\ntwo"),
    (None, ""), ("", ""), ("plain words\n only", "plain words only"), ("<p>", ""), ("<script>x", ""),
    ("<nav><a>m</a><article><p>kept</p></article>", "kept"),
    ("<body><div id=menu><a>x</a></div><div class='content'><p>" + "long text " * 20 + "</p><p>end</p></div></body>", ("long text " * 20).strip() + "\nend"),
    ("<article><p>cut off in the midd", "cut off in the midd"),
    ("<main><h1>T</h1><article><p>one</p></article><article><p>two</p></article></main>", "T\none\ntwo"),
])
def test_main_text(html, text):
    assert html_text.main_text(html) == text


def test_votes_outside_a_teaser_win():
    body = [f"{'long words of the body ' * 12}{k}" for k in range(6)]
    text = "<div class='x'>" + "".join(f"<p>{x}</p>" for x in body) + "</div>"
    teaser = "<article><h3>Also read</h3><p>short teaser</p></article>"
    assert html_text.main_text(f"<body>{text}{teaser}</body>") == "\n".join(body)
    assert html_text.main_text(f"<body>{teaser}{text}</body>") == "\n".join(body)
    assert html_text.main_text(f"<body><article>{text}</article></body>") == "\n".join(body)


LONG = "long text " * 20


@pytest.mark.parametrize("html, text", [
    (f"<html><head><title>T</title><body><div><p>{LONG}</div>", LONG.strip()),  # no </head>
    (f"<html><head><title>T</title><div><p>{LONG}<p>two</div>", f"{LONG.strip()}\ntwo"),  # no <body> either
    (f"<head><meta name=a><link rel=b><script>x</script>{LONG}", LONG.strip()),
    (f"<title>T</title><article><ul><li>{LONG}<li>two<li>three</ul><p>four<h2>five</h2></article>", f"{LONG.strip()}\ntwo\nthree\nfour\nfive"),
    (f"<article><p><b><i><u><s><em>{LONG}<p>next</article>", f"{LONG.strip()}\nnext"),  # a paragraph under much inline markup
    (f"<article><table><tr><td>{LONG}<td>b<tr><td>c</table><dl><dt>d<dd>e</dl></article>", f"{LONG.strip()}\nb\nc\nd\ne"),
    (f"<body><nav><a>menu</a><div><p>{LONG}</p></div></body>", LONG.strip()),  # a menu left open before all there is
])
def test_end_tags_left_out(html, text):
    assert html_text.main_text(html) == text


def without_end_tags(html):
    return re.sub("</head>|</p>|</li>|</body>|</html>", "", html)


def test_given_pages_keep_their_text_without_end_tags(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()
    assert all(html_text.main_text(h) == html_text.main_text(without_end_tags(h)) for (h,) in pages)
    plain = [re.sub("<(/?)article", r"<\1div", h) for (h,) in pages]
    assert sum(html_text.main_text(p) == html_text.main_text(without_end_tags(p)) != "" for p in plain) >= 0.99 * len(plain)


@pytest.mark.parametrize("page", [
    "<div>" * 50_000 + "deep " * 50, "<div><p>x" * 25_000, "<b>" * 30_000 + "x" + "</i>" * 30_000, "<b>" + "<div>" * 30_000 + "</b>" * 30_000,
    "<ul><li><ul>" + "<div>" * 30_000 + "<li>x</li>" * 10_000, "<article>" * 30_000 + "<p>x</p>" * 1_000, "<p>" + "<i>" * 30_000 + "<p>y" * 3_000,
])
def test_hostile_nesting_takes_linear_time(page):
    start = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - start < 3


def test_extracted_rows(spark):
    pages = spark.createDataFrame([(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "x", "<p>a</p>")], "page_id long, url string, html string")
    got = Counter(tuple(r) for r in html_text.extracted(pages.selectExpr("*", "'x' AS text", "1 AS n_chars")).collect())
    assert got == Counter([(1, "u", html_text.main_text(PAGE), len(html_text.main_text(PAGE)))] * 2 + [(2, None, "", 0), (None, "x", "a", 1)])
    assert html_text.extracted(pages.limit(0)).count() == 0


def test_gaussian_and_threshold():
    assert html_text.smoothed([3.0, 3.0, 3.0]) == pytest.approx([3.0] * 3)
    assert 2 < html_text.threshold([1, 1, 2, 9, 10]) < 9
    assert html_text.threshold([4.0, 4.0]) == 4.0


def luhn(s):
    total = 0
    for i, c in enumerate(reversed(s)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def digits(s):
    return re.sub("[^0-9]", "", s)


BASE = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda s: True),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda s: all(int(x) <= 255 for x in s.split("."))),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda s: 8 <= len(digits(s)) <= 15),
)
PERSONAL = [
    "write a@b.com_x@y.org. or x@y", "😀 é 1.2.3.4.5.6 300.1.1.1 0001.2.3.004 1.2.3", "+1 (234) 567-8901 +1234 +1 2345678 9012345 6",
    "4111 1111 1111 1111 x 4111-1111-1111-1111-1 4111111111111111 4111111111111112 4111  1111 1111 1111", "IBAN GB82 WEST 1234 5698 7654 32 GB83WEST12345698765432",
    "my ssn: 123-45-6789 " + "a" * 60 + " 123-45-6788", " ".join(f"u{i}@h.de, 4111111111111111 +49 30 1234567{i}." for i in range(150)),
    "1" * 9000, "a" * 9000 + "@", "a." * 4000, "+1 " * 3000, "x@" + "a." * 3000, "1-2 3-4 " * 2000, None, "",
]


def test_base_spans_follow_the_patterns(spark):
    data = [(9000 + i, t) for i, t in enumerate(PERSONAL)] + [(r[0], r[1]) for r in rows()]
    got = pii.report(spark.createDataFrame(data, "doc_id long, text string").repartition(4)).collect()
    want = Counter()
    for i, t in data:
        spans = [f"{k}:{m.start()}:{m.end()}" for k, p, ok in BASE for m in p.finditer(t or "") if ok(m.group())]
        n = Counter(s.split(":")[0] for s in spans)
        want[(i, n["email"], n["ip"], n["card"], n["phone"], hashlib.sha256(",".join(spans).encode()).hexdigest())] += 1
    assert Counter(tuple(r)[:6] for r in got) == want
    spans = {r["doc_id"]: r["spans"] for r in got if r["doc_id"] in (9004, 9005)}
    assert spans == {9004: "iban:5:32", 9005: "ssn:8:19"}


def test_redaction_keeps_columns_and_other_text(spark):
    df = spark.createDataFrame([(1, "a@b.de or +49 30 1234567", "en", 24, "x"), (2, None, None, None, None), (3, "clean", "en", 7, "y")],
                               "doc_id long, text string, lang string, n_chars int, spans string")
    got = pii.redacted(df)
    assert got.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(tuple, got.collect())) == [(1, "[EMAIL] or [PHONE]", "en", 18, "x"), (2, None, None, None, None), (3, "clean", "en", 7, "y")]
    assert pii.redacted(df.limit(0)).count() == 0 and pii.report(df.limit(0)).count() == 0


def base_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(grams)
    repeated = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed


def test_quality_counts(spark):
    more = [(400, "a b c d e\na b c d e\n\n \nx # * $ % & | < >", "en", "a", 1), (401, "a a a a a a a", "en", "a", 1), (402, "one two three four five six " * 40, "en", "a", 1)]
    data = rows() + more
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    got = quality_rules.report(clashing(df)).collect()
    assert Counter(tuple(r)[:7] for r in got) == Counter((r[0], *base_measures(r[1])) for r in data)
    assert all(not r["kept"] for r in got if r["base_failed"])


def test_quality_filter_adapts(spark):
    """A share of symbols that is usual for one source is out of range in another."""
    plain = [(i, f"these are quite plain words of text number {i} and a few more of them", "en", "prose", 0) for i in range(300)]
    table = [(1000 + i, f"a | b | c | d | e | f | g | h | row {i} | of | a | table", "en", "tables", 0) for i in range(300)]
    odd = [(5000, "x | y | z | d | e | f | g | h | row | of | a | table", "en", "prose", 0)]
    df = spark.createDataFrame(plain + table + odd, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in quality_rules.keep_good(df).select("doc_id").collect()}
    assert kept == {r[0] for r in plain + table}


def test_fences_are_tighter_than_fixed_cutoffs(spark):
    """Texts far from what their group has fail though no general cutoff would stop them; a small group leans on its parents."""
    rng = random.Random(3)
    line = lambda i, k: " ".join("".join(rng.choices("abcdefghij", k=3 + j % 5)) for j in range(12))
    text = lambda i: "\n".join(line(i, k) for k in range(20))
    plain = [(i, text(i), "en", "prose", 0) for i in range(300)]
    odd = [(1000, "\n".join(line(1000, k) + " # $ %" * (k % 2) for k in range(20)), "en", "prose", 0),
           (1001, "".join(c.upper() if k % 3 == 0 else c for k, c in enumerate(text(1001))), "en", "prose", 0),
           (1002, "\n".join([line(1002, k) for k in range(20)] + ["again"] * 15), "en", "prose", 0)]
    small = [(2000 + i, text(2000 + i), "en", "rare", 0) for i in range(2)] + [(2002, odd[0][1], "en", "rare", 0)]
    df = spark.createDataFrame(plain + odd + small, "doc_id long, text string, lang string, source string, n_chars long")
    got = quality_rules.report(df).collect()
    assert not any(r["base_failed"] for r in got)
    assert {r["doc_id"] for r in got if r["kept"]} == {r[0] for r in plain} | {2000, 2001}


def test_quality_stage_columns(spark):
    df = documents(spark)
    assert quality_rules.keep_good(df).schema == df.schema
    assert quality_rules.keep_good(empty(spark)).count() == 0 and quality_rules.report(empty(spark)).count() == 0


def test_sketch_quartiles(spark):
    df = spark.createDataFrame([(i, " ".join(["w" * (i % 40 + 1)] * 10)) for i in range(2000)], "doc_id long, text string")
    measured = quality_rules.measured(df)
    q = quality_rules.quartiles(quality_rules.sketches(measured)).where("measure = 'mean_word'").collect()[0]
    assert q["rows"] == 2000
    for value, want in ((q["q1"], 10), (q["q2"], 20), (q["q3"], 30)):
        assert abs(value - want) <= quality_rules.ACCURACY * want + 1e-9
