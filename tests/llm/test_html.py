"""Operator 7 against the article tags, the network against its numeric gradient."""

import re
from html import unescape

import numpy as np
import pytest

from starmill.llm import html_text
from starmill.llm.common import read_table

PAGES = [
    (1, "u", "<html><body><nav><a href=x>Home</a></nav><article><h1>T &amp; U</h1><p>One\n two<br>three "
             "<b>bo</b>ld.</article><footer>&copy; me</footer>"),
    (2, None, None),
    (3, "u", ""),
    (3, "u", "plain text, no tags"),
    (4, "u", "<p>broken <a title='x > y' href=\"a>b\">link</p <p>next & more &lt;b&gt;"),
    (None, "v", "<!-- <p>no</p> --><script>var t='</p>';</script><p>yes<p>also<!-- never closed <p>x"),
    (5, "u", "<ul>" + "<li><a href='/'>menu</a>" * 300 + "</ul>" + "<p>word </p>" * 300),
    (6, "u", "<" * 5000 + ">" * 3),
]
SCHEMA = "page_id long, url string, html string, text string, n_chars long"


def article(html):
    inner = re.search(r"<article>(.*)</article>", html, re.S)[1]
    parts = re.split(r"</?(?:p|h1|br)>", inner)
    return " ".join(" ".join(unescape(re.sub("</?b>", "", p)) for p in parts).split())


def test_articles(spark, folder):
    pages = read_table(spark, folder, "pages")
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    rows = html_text.extract(pages).collect()
    assert len(rows) == len(html)
    right = sum(r["text"] == article(html[r["page_id"]]) for r in rows)
    assert right >= 0.98 * len(rows)


def test_blocks_of_broken_pages():
    texts = lambda html: [b.text for b in html_text.blocks(html)]
    assert texts(PAGES[0][2]) == ["Home", "T & U", "One two", "three bold.", "© me"]
    assert texts(PAGES[4][2])[0] == "broken link"
    assert texts(PAGES[5][2]) == ["var t='</p>';", "yes", "also"][1:]
    assert texts("a < b and c <3 d") == ["a < b and c <3 d"]


def test_hard_pages(spark, folder):
    pages = spark.createDataFrame([(*p, "t", 1) for p in PAGES], SCHEMA)
    rows = html_text.extract(pages).collect()
    assert sorted(str((r["page_id"], r["url"])) for r in rows) == sorted(str(p[:2]) for p in PAGES)
    assert all(r["text"] == "" for r in rows if r["page_id"] == 2)
    assert html_text.extract(pages.where("false")).count() == 0
    untaught = html_text.extract(pages.where("page_id = 5")).first()["text"]
    assert untaught == " ".join(["menu"] * 300 + ["word"] * 300)


AROUND = {
    "menu": "<nav><ul><li><a href=/a>Start</a><li><a href=/b>News</a></ul></nav>",
    "menu by class": "<div class=menu><a href=/a>Start</a> <a href=/b>News</a></div>",
    "header": "<header><p>The Daily Page</p></header>",
    "footer": "<footer><p>All rights reserved.</p></footer>",
    "sidebar": "<aside><p>Read this too.</p></aside>",
    "sidebar by class": "<div class='right sidebar'><p>Read this too.</p></div>",
    "notice": "<div class='cookie notice'><p>We use cookies.</p></div>",
    "advert": "<div class=advert><p>Buy two, get one.</p></div>",
    "form": "<form><label>Your mail</label><input name=m><button>Send</button></form>",
    "script": "<script>document.write('<p>written</p>')</script>",
    "style": "<style>p { color: red }</style>",
    "noscript": "<noscript><p>Please enable JS now.</p></noscript>",
    "drawing": "<svg><text>icon label</text></svg>",
    "comments": "<div class=comments><h3>2 comments</h3><div class=comment><p>Nice one.</p></div></div>",
}


@pytest.fixture(scope="module")
def taught(spark, folder):
    pages = read_table(spark, folder.replace("sf0.001", "sf0.01"), "pages")
    return html_text.learn(pages, "html", ids=("page_id",))


@pytest.fixture(scope="module")
def paragraphs(spark, folder):
    page = read_table(spark, folder, "pages").where("html like '%<article>%'").orderBy("page_id").first()
    inner = re.search(r"<article>(.*)</article>", page["html"], re.S)[1]
    return [p for p in re.findall(r"<p>([^<]*)</p>", inner) if len(p) > 60][:6]


@pytest.mark.parametrize("place", ["before", "after", "inside", "at the end"])
@pytest.mark.parametrize("kind", AROUND)
def test_surroundings_go_wherever_they_are(taught, paragraphs, kind, place):
    body = [f"<p>{p}</p>" for p in paragraphs]
    parts = {
        "before": [AROUND[kind], "<article>", *body, "</article>"],
        "after": ["<article>", *body, "</article>", AROUND[kind]],
        "inside": ["<article>", *body[:3], AROUND[kind], *body[3:], "</article>"],
        "at the end": ["<article>", *body, AROUND[kind], "</article>"],
    }[place]
    page = f"<html><body>{''.join(parts)}</body></html>"
    want = " ".join(" ".join(unescape(p).split()) for p in paragraphs)
    assert html_text.main_text([page], taught) == [want]


def test_long_pages_are_read_whole(taught, paragraphs):
    times = html_text.LONGEST // sum(map(len, paragraphs)) + 2
    page = "<article>" + "".join(f"<p>{p}</p>" for p in paragraphs * times) + "</article>"
    (text,) = html_text.main_text([page], taught)
    assert text.count(" ".join(unescape(paragraphs[0]).split())) == times


def test_gradient():
    draw = np.random.default_rng(3)
    net = html_text.Labeller(1)
    x, real = html_text.padded([draw.standard_normal((n, html_text.INPUT)) for n in (4, 2)])
    y = (draw.random(real.shape) > 0.5).astype(float)

    def loss():
        s = net.scores(x, real)[0]
        return ((np.logaddexp(0, s) - y * s) * real).sum() / real.sum()

    for name, grad in net.gradients(x, real, y).items():
        flat, at = net.p[name].reshape(-1), grad.reshape(-1)
        for i in draw.integers(0, len(flat), 4):
            flat[i] += 1e-5
            up = loss()
            flat[i] -= 2e-5
            down = loss()
            flat[i] += 1e-5
            assert abs((up - down) / 2e-5 - at[i]) < 1e-6, name


def test_labels_do_not_depend_on_the_other_pages():
    pages = [html_text.vectors(html_text.blocks(p[2] or "")) for p in PAGES]
    net = html_text.Labeller(2)
    for page, label in zip(pages, net.label(pages)):
        assert (net.label([page])[0] == label).all()


def test_the_sample_is_bounded_for_repeated_pages(spark):
    for page in range(20):  # some of these pages hash low
        rows = [(i, f"<p>{page}</p>") for i in range(500)]
        pages = spark.createDataFrame(rows, "page_id long, html string").coalesce(2)
        assert html_text.drawn(pages, "html", 100).count() <= 100
    assert html_text.drawn(pages, "html", 100, ("page_id",)).count() > 50
