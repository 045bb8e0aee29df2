"""Pages that are hard to read: broken and endless markup, deep nesting, hidden text, repeated pages."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from campaign_analytics.llm import html_extract

FRAGMENTS = ["<div>", "</div>", "<p>", "</p>", "<li>", "<ul>", "</ul>", "<a href='x'>", "</a>", '<a "', '"', "'", "<", ">", "<!--", "-->", "<!x>",
             "text ", "&amp;", "<br/>", "<td>", "<table>", "</table>", "<script>", "</script>", '<span class="a>b">', "<dd>", "<hr>"]


def tags_by_pattern(html):
    """Every tag by one pattern with all its backtracking: what the reader finds in one go."""
    token = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
    return [(m.start(), m.end(), (m[2] or "").lower()) for m in token.finditer(html)]


def test_tags_by_brute_force():
    rng = random.Random(4)
    for _ in range(3000):
        html = "".join(rng.choice(FRAGMENTS) for _ in range(rng.randint(0, 40)))
        tags, found, at = html_extract.Tags(html), [], 0
        while (tag := tags.next(at)) is not None:
            found.append(tag[:3])
            at = tag[1]
        assert found == tags_by_pattern(html), html


@pytest.fixture(scope="module")
def trees():
    return html_extract.boost(*html_extract.training_set([["A sentence with some words, and more of them. " * 4] * 5]))


@pytest.mark.parametrize("piece", ["<div>", '<a "', "<a '\"", "<a", "<!--", "<!", "<script>x", "<p>hello ", "<div><p>x</p>", "<li><center>"])
def test_a_megabyte_of_one_piece_is_read_in_seconds(trees, piece):
    start = time.time()
    html_extract.main_texts([piece * (1_000_000 // len(piece))], trees)
    assert time.time() - start < 20


def test_what_stands_in_the_article_stays(trees):
    body = "A sentence with some words, and more of them. " * 6
    page = (
        f"<body><nav><ul><li><a href=/>Home</a></ul></nav><article><p>{body}<div hidden><p>Hidden {body}</div>"
        f"<noscript><p>Without scripts {body}</p></noscript><object><p>Instead {body}</p></object><script>var x = '<p>no</p>'</script>"
        f"<p style='display:none'>Unseen {body}</p></article></body>"
    )
    text = html_extract.main_texts([page], trees)[0]
    for word in ("Hidden", "Without scripts", "Instead", "Unseen"):
        assert word in text
    assert "var x" not in text and "Home" not in text


def test_the_sample_holds_each_page_once(spark, tmp_path, monkeypatch):
    pages = spark.range(400).select(
        F.col("id").alias("page_id"), F.concat(F.lit("<p>page "), F.least(F.col("id"), F.lit(30)).cast("string"), F.lit("</p>")).alias("html")
    )
    pages.write.parquet(str(tmp_path / "pages"))
    seen = []
    monkeypatch.setattr(html_extract, "boost", lambda *x: "trees")
    monkeypatch.setattr(html_extract, "training_set", lambda articles: seen.append(articles) or ())
    frame = spark.read.parquet(str(tmp_path / "pages"))
    html_extract.train(frame, sample_pages=20)
    html_extract.train(frame.repartition(7), sample_pages=20)
    assert seen[0] == seen[1] and len(seen[0]) <= 20 and len({a[0] for a in seen[0]}) == len(seen[0])
