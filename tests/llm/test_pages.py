"""Main text, URL verdicts and toxicity."""

import html
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chatloom.llm import html_text, toxicity, urls

LONG = "A long sentence of the article, with commas, and an end. " * 6


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("", ""),
        ("<p>", ""),
        (
            f"<html><head><title>t</title><style>p{{}}</style><script>var a='</p><p>x';</script></head><body>"
            f"<nav><ul><li><a href='/'>Home</a></ul></nav><!-- <p>no</p> --><div class=\"ad\">Buy, buy, buy.</div>"
            f"<article><h1>Title &amp; more</h1><p><b>{LONG}<br>next<p>Second\n  one &lt;b&gt;&nbsp;.</p></article>"
            f"<footer>&copy; me</footer>",
            f"Title & more\n\n{LONG}next\n\nSecond one <b> .",
        ),
        (
            f"<body><div id=content><p>{LONG}</p><p>Short.</p><div class='comments'><p>{LONG}</p></div></div>"
            f"<aside><p>{LONG}</p></aside><form>{LONG}</form><div role=navigation>{LONG}</div></body>",
            f"{LONG.strip()}\n\nShort.",
        ),
        (f"<main><section><p>{LONG}</p></section><ul><li>one<li>two</ul></main>", f"{LONG.strip()}\n\none\n\ntwo"),
        (f"<article><p>{LONG}</p><p>a < b and 1<2</p></article><foo", f"{LONG.strip()}\n\na < b and 1<2"),
        (f"<article><p title='a>b' data-x=\"y\">{LONG}</p></article>", LONG.strip()),
        (f"<article><p>{LONG}</p><img src='x\"><p>after</p></article>", f"{LONG.strip()}\n\nafter"),
    ],
)
def test_extract(page, want):
    assert html_text.extract(page) == want


@pytest.mark.parametrize(
    "page",
    [
        "<body class='single has-sidebar'><div><p>{}</p></div>",
        "<html class='nav-open'><body class=no-sidebar><main class='content with-sidebar'><p>{}</p></main>",
        "<body><article class='post comments-open'><p>{}</p></article>",
        "<body><div class='post comments-open'><p>{}</p></div>",
        "<body><form id=aspnetForm><nav><a>Home</a></nav><div><p>{}</p></div><footer>Me.</footer></form>",
        "<body><div class='social'><ul class=menu><li>a<li>b</ul><p>{}</p></div><p>Imprint</p>",
    ],
)
def test_wrappers_are_not_away(page):
    got = html_text.extract(page.format(LONG))
    assert LONG.strip() in got and not any(x in got for x in ("Home", "Me.", "a\n"))


@pytest.mark.parametrize("icon", ["<svg class='icon'/>", "<math />", "<svg><path d='M0'>", "<iframe src=x>", "<textarea>"])
def test_raw_tags_without_an_end(icon):
    later = "<svg><text>no</text></svg>" if icon.endswith("/>") else ""
    got = html_text.extract(f"<body>{icon}<article><p>{LONG}</p>{later}<p>after</p></article>")
    assert got == f"{LONG.strip()}\n\nafter"
    assert html_text.extract(f"<article><p>{LONG}</p><script>var a = 1; <p>no") == LONG.strip()


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<body><div><h1>Title</h1><p>Lead.</p><div><p>{}</p><p>{}</p></div></div>", ["Title", "Lead.", 0, 0]),
        (
            "<body><div><h1>T</h1><div><p>{}</p></div><h2>S</h2><ul><li>a<li>b</ul><blockquote>Q.</blockquote>"
            "<section><p>{}</p></section></div>",
            ["T", 0, "S", "a", "b", "Q.", 0],
        ),
        ("<body><div><ul><li>Home<li>News</ul><h1>T</h1><ul><li>a</ul><div><p>{}</p></div></div>", ["T", "a", 0]),
        ("<body><div><div><p>{0}</p><p>{0}</p><p>{0}</p></div><section><p>{0}</p></section></div>", [0, 0, 0, 0]),
        ("<body><h1>T</h1><article><p>{}</p></article><ul><li>More</ul>", ["T", 0]),
    ],
)
def test_blocks_around_the_best_container(page, want):
    got = html_text.extract(page.format(LONG, LONG))
    assert got.split("\n\n") == [LONG.strip() if w == 0 else w for w in want]


def test_away_elements_stay_away():
    links = "<ul><li>Home<li>About us</ul>"
    assert html_text.extract(f"<body><nav>{links}</nav><div class=menu>{links}</div>") == ""
    page = f"<body><article><p>Short.</p></article><div class='left-sidebar'><p>{LONG}</p></div><footer>{LONG}</footer>"
    assert html_text.extract(page) == "Short."


def test_extract_survives_any_page():
    rng = random.Random(2)
    parts = ["<p>", "</p>", "<div class=ad>", "</div>", "<article>", "<", ">", "&amp", "text, ", "<!--", "-->", "<script>"]
    parts += ["</script>", "<br/>", "<li>", "<td>", "</table>", "'", '"', "é", "\n", "<b", "<a href='"]
    for _ in range(1500):
        html_text.extract("".join(rng.choice(parts) for _ in range(rng.randint(0, 25))))
    assert html_text.extract("<div>" * 20000 + LONG) == LONG.strip()


def test_main_text_rows(spark):
    rows = [(1, "u", f"<article><p>{LONG}</p></article>"), (2, None, None), (None, "v", ""), (1, "u", "<p>x</p>")]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, text string")
    got = html_text.main_text(df).collect()
    assert sorted((r.page_id or -1, r.url or "", r.n_chars) for r in got) == sorted(
        (i or -1, u or "", len(html_text.extract(h or ""))) for i, u, h in rows
    )
    assert all(r.n_chars == len(r.text) for r in got)
    assert html_text.main_text(df.where("false")).count() == 0


URLS = [
    ("http://a.example.net/en/1?x", "a.example.net", "/en/1", "example.net/en/", "allow"),
    ("HTTP://A.Example.NET/de/1#y", "a.example.net", "/de/1", "net/", "block"),
    ("https://example.com/de/", "example.com", "/de/", "example.com/de/", "block"),
    ("https://myexample.com/de/", "myexample.com", "/de/", None, None),
    ("x://org/fr/a?b://c", "org", "/fr/a", "org/fr/", "allow"),
    ("x://w.org/FR/a", "w.org", "/FR/a", None, None),
    ("x://net", "net", "", None, None),
    ("x://net?q=/en/", "net", "", None, None),
    ("a.net/en", "", "", None, None),
    ("://net/", "net", "/", "net/", "block"),
    ("", "", "", None, None),
    (None, "", "", None, None),
]


def test_hosts_paths_and_rules(spark):
    more = [f"http://w{i}.example.net/{'en' if i % 2 else 'de'}/{'good' if i % 2 else 'spam'}{i}" for i in range(60)]
    more += [f"http://w{i}.example.com/xx/spam{i}" for i in range(6)]
    rows = [(i, u) for i, u in enumerate([u[0] for u in URLS] + more)]
    df = spark.createDataFrame([(*r, "x") for r in [*rows, rows[0]]], "page_id long, url string, host string")
    got = {}
    for r in urls.judge(df).collect():
        assert got.setdefault(r.page_id, r) == r
    for i, (_, host, path, rule, verdict) in enumerate(URLS):
        r = got[i]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict in ("allow", "block") if verdict is None else r.verdict == verdict
    assert got[len(URLS) - 1].verdict == "allow"
    assert all(got[len(URLS) + 60 + i].verdict == "block" for i in range(6))
    assert urls.judge(df.where("false")).count() == 0


def test_one_class_allows_all(spark):
    df = spark.createDataFrame([(1, "http://a.net/x"), (2, "http://b.com/y")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in urls.judge(df).collect()} == {1: "block", 2: "allow"}


def test_model_is_witten_bell(spark):
    yes, no = Counter(), Counter()
    rng = random.Random(5)
    for c, letters in ((yes, "aab"), (no, "abb")):
        for _ in range(40):
            c["".join(rng.choice(letters) for _ in range(3))] += 1
    keys = sorted({*yes, *no, "ccc", "abc"})
    df = spark.createDataFrame([(k, yes[k], no[k]) for k in keys], "gram string, yes long, no long")
    got = {r.gram: r.ratio for r in urls.model(df, 3).collect()}

    def p(c, gram):
        out = urls.EVEN
        for size in (1, 2, 3):
            key = gram[3 - size :]
            level = Counter()
            for g, n in c.items():
                level[g[3 - size :]] += n
            of = {g: n for g, n in level.items() if g[:-1] == key[:-1] and n}
            if of:
                out = (of.get(key, 0) + len(of) * out) / (sum(of.values()) + len(of))
        return out

    for k in keys:
        assert math.isclose(got[k], math.log(p(yes, k)) - math.log(p(no, k)), abs_tol=1e-9)


def test_signs(spark):
    df = spark.createDataFrame([("A.é", "/9?"), ("", "")], "h string, p string")
    assert [r[0] for r in df.select(urls.signs(F.col("h"), F.col("p"))).collect()] == ["a.~/0~", ""]


def test_grammar_scores_clauses():
    g = toxicity.Grammar({"idiot*": 4.0, "scum": 3.0})
    weigh = lambda t: sum(g.clauses(t))
    assert weigh("a plain text about the scumble of paint.") == 0
    assert weigh("an Idiot walked by") == 4
    assert weigh("you idiots") == 4 * toxicity.TARGETED
    assert weigh("it is not an idiot") == pytest.approx(4 * toxicity.NEGATED)
    assert weigh("not now. an idiot") == 4
    assert weigh("someone wrote scum") == 3 * toxicity.REPORTED
    assert weigh("a “scum” there. scum") == pytest.approx(3 * toxicity.REPORTED + 3)
    assert len(g.clauses("scum! idiot; fine.")) == 2
    assert toxicity.Grammar({}).clauses("scum") == []


def test_grammar_scores_threats():
    g = toxicity.Grammar({"idiot*": 4.0})
    threat = 4 * toxicity.TARGETED
    for t in ("I will find you and hurt you", "I'll kill them", "ich werde dich töten", "je vais te tuer", "voy a matar a ella"):
        assert g.matched(t) == [(threat, threat)], t
        assert g.features(t)[3] == pytest.approx(math.log1p(threat))
    assert g.matched("I will not hurt you") == [(pytest.approx(threat * toxicity.NEGATED),) * 2]
    assert g.matched("he said I will hurt you") == [(pytest.approx(threat * toxicity.REPORTED),) * 2]
    for t in ("did it hurt you", "you will kill time", "the frost will kill the crop. you know", "I will find you"):
        assert g.matched(t) == [] and g.features(t) == [0, 0, 0, 0], t
    assert g.matched("you idiot") == [(threat, 0)]


def test_threats_score_above_no_match(spark, docs):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("opqrstuv") for _ in range(8))
    rows = [(i, " ".join([word() for _ in range(9)] + ["zzogger" if i % 2 else word()])) for i in range(300)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    df = docs([*rows, (900, "I will find you and hurt you"), (901, "I will find you and help you")])
    lexicon, weights = toxicity.learn(df, labels)
    assert "zzogger" in lexicon or any(w.startswith("zzog") for w in lexicon)
    got = {r.doc_id: r for r in toxicity.score(df, lexicon, weights).collect() if r.doc_id >= 900}
    assert got[900].predicted == 1 and got[900].n_clauses == 1
    assert got[901].predicted == 0 and got[901].n_clauses == 0


def test_choose_entries():
    got = toxicity.choose(
        {"worthless": (90, 0), "wort*": (91, 1), "worthl*": (90, 0), "lowei*": (50, 0), "loweisch": (9, 0), "lowe*": (50, 0),
         "scum": (40, 0), "scum*": (41, 0), "idiot": (60, 0), "idiot*": (64, 0)}
    )
    assert set(got) == {"worthless", "lowei*", "scum", "idiot*"}


def test_learning_on_held_out(spark, docs):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 11)))
    rows, marks = [], []
    for i in range(600):
        toxic = i % 5 == 0
        w = [word() for _ in range(rng.randint(10, 60))]
        if toxic:
            for _ in range(rng.randint(1, 4)):
                w[rng.randrange(len(w))] = rng.choice(["zzog", "qumbler", "vexi" + word()])
        rows.append((i, " ".join(w)))
        marks.append((i, int(toxic)))
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    df = docs([*rows, (900, None), (901, ""), (None, "zzog")])
    lexicon, weights = toxicity.learn(df, labels)
    got = {r.doc_id: r for r in toxicity.score(df, lexicon, weights).collect()}
    held = [got[i] for i, _ in marks if got[i].held_out]
    assert 150 < len(held) < 250
    right = sum(r.predicted == (r.doc_id % 5 == 0) for r in held)
    assert right >= 0.97 * len(held)
    assert got[900].score == got[901].score < toxicity.THRESHOLD <= got[None].score
    lexicon, weights = toxicity.learn(df, labels.where("toxic = 0"))
    assert lexicon == {} and weights is None
    assert {r.score for r in toxicity.score(df, lexicon, weights).collect()} == {toxicity.PRIOR}


def test_small_language_is_learned(spark, docs):
    """Recall on held-out rows, by language; the small one has a fortieth of the toxic texts."""
    rng = random.Random(4)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(3, 11)))
    rows, marks = [], []
    for i in range(4800):
        toxic, small = i % 2 == 0, i % 80 < 2
        w = [word("opqrstuv" if small else "abcdefgh") for _ in range(12)]
        if toxic:
            w[rng.randrange(12)] = "xuxozzo" if small else rng.choice(["zzogger", "qumbler"])
        rows.append((i, " ".join(w)))
        marks.append((i, int(toxic)))
    lexicon, weights = toxicity.learn(docs(rows), spark.createDataFrame(marks, "doc_id long, toxic int"))
    got = [r for r in toxicity.score(docs(rows), lexicon, weights).collect() if r.held_out]
    for small in (True, False):
        toxic = [r.predicted for r in got if r.doc_id % 2 == 0 and (r.doc_id % 80 < 2) == small]
        assert len(toxic) >= 10 and sum(toxic) >= 0.9 * len(toxic), (small, sum(toxic), len(toxic))
    clean = [r.predicted for r in got if r.doc_id % 2]
    assert sum(clean) <= 0.03 * len(clean)


def test_entities():
    assert html_text.extract("<p>&quot;a&#233;&am &amp</p>") == html.unescape("&quot;a&#233;&am &amp")
