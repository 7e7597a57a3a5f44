"""Block rules on small pages, and whole pages of the test data against their article elements."""

import collections
import html as entities
import random
import re

import pytest

from tierwise.llm import html_text

ARTICLE = "This is the text of the article that is about the weather and it is as long as it has to be. " * 4
LINE = ARTICLE.strip()


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain &amp; short", ""),
        (f"<p>{ARTICLE}", LINE),
        (f"<nav>Home</nav><article><h1>T &lt;x&gt;</h1><p>a&nbsp;b\n\t c<br>d</p>e</article><footer>f</footer>", "T <x>\na b c d\ne"),
        (f"<header>{ARTICLE}</header><main><header><h1>Title</h1></header><p>One.</p></main><aside>{ARTICLE}</aside>", "Title\nOne."),
        (f"<div class='cookie-notice'>{ARTICLE}</div><div><h2>Title</h2><p>{ARTICLE}</p></div><div id=comments><p>{ARTICLE}</p></div>", f"Title\n{LINE}"),
        (f"<form>{ARTICLE}</form><script>var a='<p>{ARTICLE}</p>'</script><style>p{{}}</style><!-- <p>{ARTICLE}</p> --><p>{ARTICLE}", LINE),
        (f"<p>{ARTICLE}</p><p>Short.</p><p>{ARTICLE}</p><p>Tail.</p>", f"{LINE}\nShort.\n{LINE}\nTail."),
        (f"<ul><li><a href=a>{ARTICLE}</a></li></ul><p>{ARTICLE}</p>", LINE),
        ("<article><p>Kept.</p><div class='ad'>Buy</div><ul><li><a href=x>related</a></li></ul><div role=navigation>x</div></article>", "Kept."),
        ("<article><p hidden>gone</p><p>a<p>b<b>c<br><br>d</article>", "a\nbc\nd"),
        ("<title>t</title><body><main>x<button>click</button> y<svg><text>z</text></svg></main>", "x y"),
    ],
)
def test_small_pages(page, text):
    assert html_text.main_text(page or "") == text


SECOND = "Nobody knew what it was that they had seen in the sky over the town, and it was not the last time that it came. " * 3
OTHER = SECOND.strip()


@pytest.mark.parametrize(
    ("page", "text"),
    [
        # Marks last to the end of their element.
        (f"<p>{ARTICLE}</p><ul><li class='comment'><p>{SECOND}</p></li><li><p>{SECOND}</p></li></ul>", f"{LINE}\n{OTHER}"),
        (f"<ul><li class=comment><p>{SECOND}</p><p>{SECOND}</p><li>{ARTICLE}</ul>", LINE),
        (f"<table><tr><td class='sidebar'><p>{SECOND}</p></td><td><p>{ARTICLE}</p></td></tr></table>", LINE),
        (f"<table><tr><td class=sidebar><div>{SECOND}</div><td>{ARTICLE}<tr><td>{SECOND}</table>", f"{LINE}\n{OTHER}"),
        (f"<p class='ad'>{SECOND}<p>{ARTICLE}</p>", LINE),
        (f"<p class='ad'>{SECOND}<div>{ARTICLE}</div>", LINE),
        # A class does not hide an article that it names or holds.
        (f"<article class='post share-on'><p>{ARTICLE}</p><p>Short.</p></article>", f"{LINE}\nShort."),
        (f"<div class='content promotion'><nav>Home</nav><article><p>One.</p></article></div>", "One."),
        (f"<div class='sidebar-left'><div><p>{ARTICLE}</p><p>{SECOND}</p></div></div>", f"{LINE}\n{OTHER}"),
        (f"<div class='widget'><div class='widget'><p>{ARTICLE}</p></div></div><footer>Imprint</footer>", LINE),
        (f"<p>{ARTICLE}</p><div class='related'><p>{SECOND}</p><p>{SECOND}</p></div>", LINE),
        (f"<article><p>One.</p><section id='comments'>{SECOND * 9}</section></article>", "One."),
        (f"<p>Hi.</p><div id='comments'><p>{SECOND * 9}</p></div>", "Hi."),
        # Short paragraphs without a main element.
        ("<nav><a href=/>Home</a></nav><div><p>It rained.</p><p>We went home.</p></div><footer>2020</footer>", "It rained.\nWe went home."),
        # Strings that are no HTML.
        (f"<p>{ARTICLE}</p><![foo bar]><p>{SECOND}</p>", f"{LINE}\n{OTHER}"),
        (f"<p>{ARTICLE}</p><![endif]--><![CDATA[x]]><![if !IE]><p>{SECOND}</p><![ never closed", f"{LINE}\n{OTHER}"),
    ],
)
def test_frames_by_class(page, text):
    assert html_text.main_text(page) == text


def test_no_string_crashes():
    rng = random.Random(5)
    bits = ["<", ">", "<!", "<![", "]]>", "<!--", "-->", "<?", "&", "&#x;", "&#99999999;", "</", "/>", "'", '"', "=", "<p", "<li class=ad>", "<table", "<td>", "<a href=", "<script>", "</div>", "<article>", "\x00", " é", "word. ", "<!DOCTYPE", "<![foo [", "\n"]
    for _ in range(4000):
        assert isinstance(html_text.main_text("".join(rng.choice(bits) for _ in range(rng.randrange(40)))), str)


def test_rules_without_the_article_element(spark, sf_dir):
    """The given pages with the article element taken away: the rules alone find nearly all of the text, and little else."""
    found = wanted = kept = 0
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        blocks = lambda text: collections.Counter(x for x in text.split("\n") if x)
        whole = blocks(html_text.main_text(r.html))
        bare = blocks(html_text.main_text(re.sub("</?article>", "", r.html)))
        size = lambda c: sum(len(x) * n for x, n in c.items())
        found, wanted, kept = found + size(whole & bare), wanted + size(whole), kept + size(bare)
    assert found >= 0.9 * wanted and found >= 0.98 * kept, (found / wanted, found / kept)


OTHER_LANGUAGES = [
    "В чащах юга жил бы цитрус, но фальшивый экземпляр рос у самой дороги, и каждый прохожий мог видеть его плоды. ",
    "Pchnąć w tę łódź jeża lub ośm skrzyń fig, powiedział stary rybak, który mieszkał niedaleko portu i znał każdą falę. ",
    "Pijamalı hasta yağız şoföre çabucak güvendi, sonra birlikte şehrin dışındaki eski köprüye kadar yavaşça yürüdüler. ",
    "いろはにほへとちりぬるをわかよたれそつねならむうゐのおくやまけふこえてあさきゆめみしゑひもせすと昔の人は歌に残しました。",
]


@pytest.mark.parametrize("sentence", OTHER_LANGUAGES)
def test_pages_in_other_languages_without_main_elements(sentence):
    first, second = (sentence * 4).strip(), (sentence * 3).strip() + "!"
    links = "".join('<a href="/%d">%s</a>' % (i, sentence[:20]) for i in range(9))
    page = f"<body><nav>{links}</nav><div><p>{first}</p><p>{second}</p></div><div>{links}</div><footer>{sentence}</footer></body>"
    assert html_text.main_text(page) == first + "\n" + second


def test_stop_words_count_where_a_listed_language_is_told():
    prose = "It was the best of times and it was the worst of times, as they say in the book that we have here. " * 3
    junk = "cheap phones tablets laptops cameras printers monitors keyboards speakers cables " * 4
    assert html_text.main_text(f"<p>{prose}</p><p>{junk}</p>") == prose.strip()


def test_open_blocks_inherit():
    assert html_text._second_pass(["good", "short", "short", "short", "bad"]) == [True, True, False, False, False]
    assert html_text._second_pass(["bad", "near", "good", "head", "bad", "head", "good"]) == [False, True, True, False, False, True, True]
    assert html_text._second_pass(["near", "short"]) == [True, False]


def test_pages_of_the_test_data(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = {r.page_id: r for r in html_text.extract(pages).collect()}
    assert len(rows) == pages.count()
    for r in pages.collect():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = [" ".join(entities.unescape(re.sub("<[^>]+>", "", b)).split()) for b in re.split("</?(?:p|h1)>|<br>", inner)]
        assert rows[r.page_id].text == "\n".join(b for b in blocks if b)
        assert rows[r.page_id].n_chars == len(rows[r.page_id].text) and rows[r.page_id].url == r.url


def test_odd_rows_and_columns(spark):
    rows = [(1, "u", None, "old", 5), (None, None, "<main>é</main>", "old", 5), (1, "u", "<main>" + "w " * 300_000, "x", 1), (1, "u", None, "old", 5)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string, parts int")).collect()
    assert sorted((r.n_chars, r.text[:3]) for r in got) == [(0, ""), (0, ""), (1, "é"), (599_999, "w w")] and got[0].parts == 5
    assert html_text.extract(spark.createDataFrame([], "page_id long, html string")).count() == 0
    clash = spark.createDataFrame([(1, "<main>a</main>", "old", 7)], "page_id long, HTML string, TEXT string, N_chars int")
    assert [tuple(r) for r in html_text.extract(clash, "HTML").collect()] == [(1, "a", 1)]
