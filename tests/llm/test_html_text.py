import html
import re

import pytest
from pyspark.sql import functions as F

from creditspark.llm import html_text as H

P1 = "The committee said that it would review the plan again in the spring, and that no decision had been made on the matter."
P2 = "It was the second time in a year that the council had to wait for an answer from the firm that is in charge of the work."
NAV = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">The news of the day</a></li></ul></nav>'


@pytest.mark.parametrize(
    "page, want",
    [
        (f"<body>{NAV}<article><h1>Short</h1><p>{P1}<p>{P2}</article><footer>&copy; the owner of it</footer>", ["Short", P1, P2]),
        (f"<body>{NAV}<div><h1>Headline here</h1><p>{P1}</p><p>Yes.</p><p>{P2}</p></div><div>Share</div>", ["Headline here", P1, "Yes.", P2]),
        (f"<main><p>a &amp; b &eacute;&#233;&#x41;&nbsp;c\n\t d</p></main>", ["a & b ééA c d"]),
        (f"<article><p>{P1}</p></article><section id='comments'><p>{P2}</p></section>", [P1]),
        (f"<article><p>{P1}</p><div class='ad-box'>{P2}</div><aside>{P2}</aside><form><p>{P2}</p></form><p>ok</p></article>", [P1, "ok"]),
        (f"<div class='cookieNotice'><p>{P2}</p></div><p>{P1}</p><script>if (a < b) document.write('<p>{P2}</p>')</script>", [P1]),
        (f"<article><header><h1>Title</h1></header><p>{P1}<!-- <p>{P2}</p> --></article><header>{P2}</header>", ["Title", P1]),
        (f"<article><p>one<br>two<br><br>three <b>fo</b>ur</p>x<script>", ["one two", "three four", "x"]),
        (f"<article><p>{P1}</p><ul><li>item<li>next</ul><ul class='related'><li><a href=x>{P2}</a><li>{P2}</ul></article>", [P1, "item", "next"]),
        (f"<article><p>{P1}</p><p>tail without end &lt;b&gt; < 3", [P1, "tail without end <b> < 3"]),
        (f"<style>p{{}}</style><title>{P2}</title><p>{P1}<", [P1 + "<"]),
        ("", []),
        ("<nav>The only text of it all</nav>", []),
        ("plain text of no page", []),
        (P1, [P1]),
    ],
)
def test_pages(page, want):
    assert H.main_text(page) == "\n\n".join(want)


@pytest.mark.parametrize("labels", ["b?gg??bb", "???", "gg???bbbb", "g????b?g?", "?b", "?g", "b???????g"])
def test_second_pass_against_all_distances(labels):
    parts = {"g": f"<p>{P1}</p>", "b": "<p><a href=x>link link link</a></p>", "?": "<p>open</p>"}
    found = H.blocks("".join(parts[x] for x in labels))
    H.label(found)
    decided = {-1: False, len(labels): False} | {i: x == "g" for i, x in enumerate(labels) if x != "?"}
    for i, block in enumerate(found):
        want = decided[i] if i in decided else not min((abs(i - j), not v) for j, v in decided.items())[1]
        assert block.label == want


def test_whole_table_against_the_article_element(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in H.extract(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", p)).split()) for p in re.split("</?(?:p|h1)>", article)]
        assert got[r.page_id].text == "\n\n".join(filter(None, parts))
        assert (got[r.page_id].url, got[r.page_id].n_chars) == (r.url, len(got[r.page_id].text))


def test_hard_rows(spark):
    deep = "<div>" * 3000 + f"<p>{P1}</p>"
    long = "<article>" + f"<p>{P1}</p><p>é</p>" * 5000
    rows = [(1, "u", None), (2, None, ""), (None, "u", f"<p>{P1}"), (3, "u", deep), (3, "u", deep), (4, "u", long), (5, "u", "<" * 5000), (6, "u", "<a " * 3000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = [(r.page_id, r.url, r.n_chars) for r in H.extract(df).collect()]
    assert got[:5] == [(1, "u", 0), (2, None, 0), (None, "u", len(P1)), (3, "u", len(P1)), (3, "u", len(P1))]
    assert got[5][2] == 5000 * (len(P1) + 1 + 4) - 2
    assert H.extract(df.limit(0)).count() == 0


OTHER = {
    "ru": "Комитет сообщил, что весной он снова рассмотрит этот план и что решение по данному вопросу пока не принято, хотя город ждёт ответа.",
    "el": "Η επιτροπή δήλωσε ότι θα εξετάσει ξανά το σχέδιο την άνοιξη και ότι δεν έχει ληφθεί ακόμη καμία απόφαση για το θέμα αυτό.",
    "ar": "قالت اللجنة إنها ستراجع الخطة مرة أخرى في الربيع وإنه لم يتخذ أي قرار بعد في هذا الشأن رغم انتظار المدينة لجواب الشركة.",
    "zh": "委员会表示将在春季再次审议该计划，目前尚未就此事作出任何决定，而市议会一年内第二次不得不等待负责这项工作的公司答复。",
}


@pytest.mark.parametrize("lang", OTHER)
def test_pages_without_article_in_languages_without_stop_words(lang):
    text = OTHER[lang]
    links = "<div>" + "".join(f"<a href=x>{text[:40]}</a> " for _ in range(4)) + "</div>"
    page = f"<body>{NAV}{links}<div><p>{text}</p><p>{text[:11]}</p><p>{text}</p></div><div class='comments'><p>{text}</p></div><footer>{text}</footer>"
    assert H.main_text(page) == "\n\n".join([text, text[:11].strip(), text])


def test_code_without_article():
    code = "x = alpha[0] + beta[1]; q = gamma(x, delta); z = epsilon(q) * zeta; print(z, eta, theta, iota)"
    assert H.main_text(f"<body>{NAV}<div><pre>{code}</pre></div>") == code


@pytest.mark.parametrize("name", ["has-sidebar", "with-comments"])
def test_an_article_resets_a_wrapper_s_role(name):
    page = f"<div class='{name}'><article><p>{P1}</p><div class='sidebar'><p>{P2}</p></div></article><p>{P2}</p></div>"
    assert H.main_text(page) == P1
    assert H.main_text(f"<article><p>{P1}</p><section id='comments'><article><p>{P2}</p></article></section></article>") == P1
