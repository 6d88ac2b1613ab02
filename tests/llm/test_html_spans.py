"""Articles whose text spans several containers, without an article or main element."""

from tidebook.llm.html_main import extract, main_text

LINKS = "<div class=list>" + "".join(f"<a href=/{i}>Some other page {i}</a> " for i in range(60)) + "</div>"


def page(n):
    return f"<body><div class=page><div class=post><h1>Title {n}</h1><div class=lead>Lead of {n}.</div><div class=body><p>{'Long text. ' * 40}</p></div></div>{LINKS}</div></body>"


def test_heading_and_lead_stay(spark):
    want = [" ".join(f"Title {n} Lead of {n}. {'Long text. ' * 40}".split()) for n in range(3)]
    assert [main_text(page(n)) for n in range(3)] == want
    df = spark.createDataFrame([(n, f"http://a.com/{n}", page(n)) for n in range(3)], "page_id long, url string, html string")
    assert [r["text"] for r in extract(df).orderBy("page_id").collect()] == want
