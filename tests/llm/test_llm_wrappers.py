import pytest

from ratepanel.llm import wrappers
from ratepanel.llm.frames import ship


def texts(spark, pages):
    ship(spark)
    made = spark.createDataFrame([(i, "http://h.example.org/", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    return [r.text for r in wrappers.main_text(made).orderBy("page_id").collect()]


@pytest.mark.parametrize("n", [19, 20])
def test_a_text_on_many_pages_stays_in_the_article(spark, n):
    page = "<body><div class=menu>Home</div><article><h1>T {0}</h1><h2>Summary</h2><p>said {0} words</p></article></body>"
    assert texts(spark, [page.format(i) for i in range(n)]) == [f"T {i}\nSummary\nsaid {i} words" for i in range(n)]
    assert texts(spark, [page.format("x")] * n) == ["T x\nSummary\nsaid x words"] * n


def test_text_beside_the_largest_element_stays(spark):
    post = "<body><div class=nav>Home</div><div class=post><h1>T {0}</h1><p class=lead>Lead {0}</p><div class=body><p>{1} {0}</p></div></div></body>"
    long = " ".join(["word"] * 60)
    want = [f"T {i}\nLead {i}\n{long} {i}" for i in range(25)]
    assert texts(spark, [post.format(i, long) for i in range(25)]) == want
    assert texts(spark, [post.format(7, long)]) == [want[7]]
    two = "<body><div id=all><section class=main><p>{1} {0}</p></section><section class=details><p>more {1} {0}</p></section></div></body>"
    assert texts(spark, [two.format(i, long) for i in range(25)]) == [f"{long} {i}\nmore {long} {i}" for i in range(25)]


def test_deeply_nested_pages(spark):
    pages = ["<body>" + "<div>" * n + f"<p>deep {n} words</p>" + "</div>" * n + "</body>" for n in (300, 900, 1500)]
    assert texts(spark, pages) == ["deep 300 words", "deep 900 words", "deep 1500 words"]


def test_formulas_stay_in_their_sentence(spark):
    page = "<body><div class=nav>Home</div><article><p>so <math><msup><mi>x</mi><mn>2</mn></msup><mo>=</mo><mn>4</mn></math> holds {0}</p></article></body>"
    assert texts(spark, [page.format(i) for i in range(3)]) == [f"so x2=4 holds {i}" for i in range(3)]
