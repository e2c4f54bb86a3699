from __future__ import annotations

import html
import re
import time

import pytest
from pyspark.sql import functions as F

from depotline.llm.extraction import Page, count_features, extract, learn_weights, op13_extraction

SCHEMA = "page_id bigint, url string, html string"


def article(markup):
    """Blocks of the marked article, by plain replacement; for the simple markup of the given pages."""
    inside = re.search("<article>(.*?)</article>", markup, re.S).group(1)
    blocks = re.split("</?(?:p|h1)>", inside)
    texts = [" ".join(html.unescape(re.sub("</?b>", "", b.replace("<br>", " "))).split()) for b in blocks]
    return "\n".join(t for t in texts if t)


@pytest.fixture(scope="module")
def given(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages, [tuple(r) for r in pages.select("page_id", "html").collect()], learn_weights(pages)


def test_given_pages(spark, sf_dir, given):
    _, rows, _ = given
    found = op13_extraction(spark, sf_dir).collect()
    assert sorted((r.page_id, r.text, r.n_chars) for r in found) == sorted((i, article(h), len(article(h))) for i, h in rows)


LONG = "Readers wrote about the weather in the valley and what it did to the roads this year again. " * 4
VARIANTS = {
    "unmarked": lambda h: h.replace("<article>", '<div class="c1">').replace("</article>", "</div>"),
    "no wrapper, advert without a name": lambda h: re.sub("</?article>", "", h).replace('class="ad"', 'class="x9"'),
    "main": lambda h: re.sub("<(/?)article>", r"<\1main>", h),
    "names by class": lambda h: re.sub("<(/?)(nav|footer)>", lambda m: "</div>" if m[1] else f'<div class="site-{m[2]}">', re.sub("<(/?)article>", lambda m: "</div>" if m[1] else "<div id='content'>", h)),
    "comments inside": lambda h: h.replace("</article>", f'<section class="comments"><h2>2 replies</h2><article class="comment"><p>{LONG}</p></article><div><p>{LONG}</p></div></section></article>'),
    "advert inside": lambda h: h.replace("</article>", f'<div class="ad-slot"><p>{LONG}</p></div><form><p>{LONG}</p></form><p>End of it.</p></article>'),
    "all around": lambda h: h.replace("<article>", f'<div class="cookie-notice"><p>{LONG}</p></div><header><h1>Site</h1><p>{LONG}</p></header><aside><p>{LONG}</p></aside><div class="post">').replace(
        "</article>", f'</div><form><p>{LONG}</p><input><button>go</button></form><div id="comments"><ol><li><p>{LONG}</p></li></ol></div>'
    ),
    "notice without a name after a mark": lambda h: h.replace("</article>", f"</article><p>{LONG}</p>"),
}


@pytest.mark.parametrize("name", VARIANTS)
def test_other_templates(given, name):
    """Weights learned from the given pages hold on pages built otherwise."""
    _, rows, weights = given
    right = 0
    for _, markup in rows[:100]:
        expected = article(markup) + ("\nEnd of it." if name == "advert inside" else "")
        found = Page(VARIANTS[name](markup)).main_text(weights)
        assert found.endswith(expected)
        right += found == expected
    # A long advert that nothing names, side by side with the paragraphs, is told by the weight of its tags alone.
    assert right >= min(len(rows), 100) * (0.75 if name == "no wrapper, advert without a name" else 1)


def test_words(given):
    weights = given[2]
    cases = {
        "<article><p>a&amp;amp;b &lt;i&gt; &copy; &#x41;&#66; c&nbsp;&nbsp;d</p></article>": "a&amp;b <i> © AB c d",
        "<article><p>one <b>two</b>three<br>four <script>var x='</p>'</script>five<!-- six --> seven</p></article>": "one twothree four five seven",
        "<article><h1> Title\n\n here </h1><p>first<p>second<ul><li>x<li>y</ul><table><tr><td>1<td>2</table></article>": "Title here\nfirst\nsecond\nx\ny\n1\n2",
        "<article><header><h1>Title</h1></header><p>text <a href='x>y'>link</a> more</p><footer>by me</footer></article>": "Title\ntext link more",
        "<ARTICLE><P CLASS='x'>Upper <![CDATA[no]]>case</P></ARTICLE>": "Upper case",
        "<article><p>kept</p><div hidden>gone</div><div style='display: none'>gone</div><div data-id='ad' title='hidden'>kept too</div></article>": "kept\nkept too",
        "<article><p>kept</p><script>never closed <p>x</p>": "kept",
        "<article><p>kept</p><!-- never closed <p>x</p>": "kept",
        "<article><p>1 < 2 and 3 > 2 & so on</p></article": "1 < 2 and 3 > 2 & so on",
        "<div class='page-header'><nav>menu</nav><h1>Title</h1></div>": "Title",
    }
    for markup, text in cases.items():
        assert Page(markup).main_text(weights) == text, markup


def test_plain_text_is_a_page(given):
    assert Page("Just some words without any markup that go on for a while.").main_text(given[2]) == "Just some words without any markup that go on for a while."
    assert Page("").main_text(given[2]) == "" and Page("<p></p><nav>a b</nav>").main_text(given[2]) == ""


def test_best_run_by_brute_force(given):
    _, rows, weights = given
    for _, markup in rows[:60]:
        page = Page(VARIANTS["all around"](markup))
        scores = page.scores(weights)
        totals = {}
        for low in range(len(scores)):
            total = 0.0
            for high in range(low, len(scores)):
                total += scores[high][0]
                if scores[low][1] >= 0 and scores[high][1] >= 0:
                    totals[low, high] = total
        best = max(totals.values())
        low, high = page.region(weights)
        at = [i for i, (_, block) in enumerate(scores) if block >= 0]
        first, last = next(i for i in at if scores[i][1] == low), next(i for i in at if scores[i][1] == high - 1)
        assert totals[first, last] == pytest.approx(best)


def test_counts_by_brute_force(spark, given):
    pages, rows, _ = given
    counted = {r.feature: (r.inside, r.pages) for r in count_features(pages).collect()}
    expected = {}
    for _, markup in rows:
        own = {}
        for feature, inside, n in Page(markup).observations():
            have = own.setdefault(feature, [0, 0])
            have[0] += n * inside
            have[1] += n
        for feature, (inside, n) in own.items():
            total = expected.setdefault(feature, [0.0, 0])
            total[0] += inside / n
            total[1] += 1
    assert counted.keys() == expected.keys()
    assert all(counted[f] == (pytest.approx(i), n) for f, (i, n) in expected.items())


def test_without_labelled_pages(spark):
    """The priors alone."""
    weights = learn_weights(spark.createDataFrame([(1, "u", None), (2, "u", ""), (3, "u", "<p>x")], SCHEMA))
    assert weights == {}
    assert Page(f"<nav><a href=x>Home</a></nav><div class=q><h1>About it</h1><p>{LONG}</p><p>{LONG}</p></div><footer>x</footer>").main_text(weights) == "\n".join(["About it", LONG.strip(), LONG.strip()])


@pytest.mark.parametrize("part", ["<div>", "<b>x<hr>", "<b>", "</x></div>", "<p a='", "<!--", "<li>x", "<h1>x", "<div class=page-header>", "&amp;", "<", "<a =", "<table><tr><td>x", "<article>", "word "])
def test_long_pages_take_linear_time(part):
    times = []
    for n in (10_000, 20_000):
        started = time.process_time()
        Page(part * n).main_text({})
        times.append(time.process_time() - started)
    assert times[1] < 4 * times[0] + 0.3


def test_tables(spark, tmp_path):
    rows = [(1, None, None), (2, "u", ""), (None, "v", "<article><p>x y</article>"), (3, "w", "<article><p>same</article>"), (3, "w", "<article><p>same</article>")]
    spark.createDataFrame(rows, SCHEMA).withColumn("text", F.lit("clash")).withColumn("feature", F.lit(1)).withColumn("pages", F.lit(1)).write.parquet(str(tmp_path / "pages.parquet"))
    found = sorted((tuple(r) for r in op13_extraction(spark, str(tmp_path)).collect()), key=repr)
    assert found == sorted([(1, None, "", 0), (2, "u", "", 0), (None, "v", "x y", 3), (3, "w", "same", 4), (3, "w", "same", 4)], key=repr)
    assert extract(spark.createDataFrame([], SCHEMA), {}).collect() == []
