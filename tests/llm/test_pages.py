"""The readable text of pages with articles in articles."""

import pytest

from bazaarline.llm import language


@pytest.mark.parametrize("page, words", [
    ("<p>out</p><article>a <article>b</article> c <ARTICLE class=x>d</ARTICLE> e</article><p>out</p>", "a b c d e"),
    ("<main>a<article>b</article>c<article>d</article>e</main> out", "a b c d e"),
    ("<article>a</article> out <article>b</article>", "a b"),
    ("<main>a<article>b</main> out <main>c</main>", "a b c"),
    ("<article>a <main>b</main> c", "a b c"),
    ("</article>x<article>a</article>", "a"),
    ("<main>a<script>'</main>'</script>b<!-- </main> -->c</main> out", "a b c"),
    ("<main-menu>a</main-menu> b", "a b"),
    ("a <b>b</b>", "a b"),
    (None, ""),
])
def test_text_of_articles(page, words):
    assert language.page_text(page).split() == words.split()


def test_parent_of_a_host_with_very_many_labels(spark):
    host = ".".join(["a"] * 90) + ".example.org"
    pages = spark.createDataFrame([(1, f"http://{host}/x", "<html></html>")], "page_id long, url string, html string")
    row = language.page_evidence(pages).first()
    assert row.host == host and row.parent == host[2:]
