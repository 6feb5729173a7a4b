"""Pages, requests, reports and answers on toy rows."""

from pyspark.sql import functions as F

from rowsmith.operators import pages, reports, requests


def page(spark, *htmls):
    rows = [(i, f"http://h{i}/", h) for i, h in enumerate(htmls)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def links(spark, html, n=15):
    return [r.link for r in pages.extract_links(page(spark, html), n).orderBy("position").collect()]


def test_result_links_win_and_cap_comes_first(spark):
    html = '<a href="http://x/1">1</a><a class="big result-link" href="/rel">r</a><a class="result-link" href="http://x/2">2</a>'
    assert links(spark, html) == ["http://x/2"]
    assert links(spark, html, 1) == ["http://x/1"]
    assert links(spark, '<a href="/?u=http://y">a</a><a href="http://x/1">b</a>', 1) == []
    assert links(spark, "<a href='http://x/?a=1&amp;b=2'>q</a>") == ["http://x/?a=1&b=2"]
    assert links(spark, '<!-- <a href="http://no">n</a> --><p>none</p>') == []


def test_page_text(spark):
    html = (
        "<html><head><title> A &amp; B\n</title><style>p{}</style></head><body><nav>menu</nav>"
        "<script>var t='</p>';</script><article><p>One<b>two</b> &lt;3</p></article></body></html>"
    )
    rows = pages.extract_page_text(page(spark, html, "<p>plain</p>")).orderBy("page_id").collect()
    assert (rows[0].title, rows[0].raw_text) == ("A & B", "Onetwo <3")
    assert (rows[1].title, rows[1].raw_text) == ("No title", "plain")


def test_text_is_extracted_once_before_the_filter(spark):
    df = pages.filter_dataset_pages(pages.extract_page_text(page(spark, "<p>data</p>")))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<script") == 1
    assert df.count() == 1


def test_ranking_stops_early_unless_global(spark):
    df = spark.createDataFrame(
        [(1, "a", 0.1, 0.5), (2, "b", 0.9, 0.5), (3, "c", 1.0, 1.0)],
        "crawl_pos long, name string, relevance_score double, data_quality_score double",
    )
    early = pages.rank_candidates(df, 2).orderBy("candidate_rank").collect()
    best = pages.rank_candidates(df, 2, global_rank=True).orderBy("candidate_rank").collect()
    assert [r.name for r in early] == ["b", "a"] and [r.name for r in best] == ["c", "b"]


def test_shortfall_wraps_around_the_pages(spark):
    texts = pages.extract_page_text(page(spark, "<p>1</p>", "<p>2</p>"))
    none = spark.createDataFrame(
        [],
        "crawl_pos long, name string, description string, url string, format string, size_info string,"
        " columns array<string>, source_context string, relevance_score double, data_quality_score double,"
        " extracted_content string",
    )
    rows = pages.fill_shortfall(none, texts, 5).orderBy("candidate_rank").collect()
    assert [(r.name, r.crawl_pos) for r in rows] == [(f"Synthetic Dataset {i + 1}", i % 2) for i in range(5)]
    assert pages.fill_shortfall(none, texts.limit(0), 5).count() == 0
    assert pages.research_summary(pages.fill_shortfall(none, texts, 3)).first().synthetic_datasets == 3


def test_requests(spark):
    df = spark.createDataFrame([("The PAIN of ai_x, data and Café lists",), ("Patient prices",)], "t string")
    rows = requests.understand(df, "t").collect()
    assert (rows[0].domain, rows[0].key_entities) == ("technology", ["PAIN", "lists"])
    assert rows[1].domain == "medical"
    cleaned = requests.clean_queries(spark.createDataFrame([("  a-b! data  set ",)], "t string"), "t")
    assert cleaned.first().query == "ab data  set"
    assert requests.clean_queries(cleaned.drop("query"), "t", True).first().query == "a-b! set"
    assert requests.clean_queries(spark.createDataFrame([("Data study",)], "t string"), "t", True).first().query == "Data study"
    texts = [r.search_text for r in requests.expand_queries(cleaned).orderBy("template_no").collect()]
    assert texts[0] == "ab data  set dataset" and len(texts) == 4


def test_reports_in_every_form(spark):
    bodies = [
        '{"quality_issues": [{"issue_type": "a"}], "error_log": ["x"], "problem": []}',
        '{"analysis_results": {"r": {"issues": ["plain", {"severity": "low"}], "problems": ["p"]}, "s": {"problems": ["q"]}}}',
        '{"dataset_analyses": [{"dataset_name": "d", "quality_issues": [{"category": "c", "ai_recommendation": "do"}]}]}',
        "{}",
        "[1]",
        "{broken",
        '{"ok": 1} trailing {"x": 2}',
    ]
    df = spark.createDataFrame(list(enumerate(bodies)), "report_id int, body string")
    found = {}
    for r in reports.flatten_report_issues(df).orderBy("report_id", "position").collect():
        found.setdefault(r.report_id, []).append(r)
    assert [r.issue_type for r in found[0]] == ["a", "error_log"]
    assert [r.issue_type for r in found[1]] == ["r_issue", "r_issue", "s_problem"]
    assert found[1][0].description == "plain" and found[1][1].severity == "low"
    assert (found[2][0].dataset_name, found[2][0].issue_type, found[2][0].recommendation) == ("d", "c", "do")
    assert [r.issue_type for r in found[4]] == ["extraction_error"]
    assert set(found) == {0, 1, 2, 4}


def test_answers(spark):
    df = spark.createDataFrame(
        [(1, 'so {"a": 1.5, "b": "x"} ok'), (2, '{"a": 1} {"a": 2}'), (3, "none"), (4, "{'a': 1}"), (5, '{"a": "no"}')],
        "id int, response string",
    )
    rows = {r.id: r for r in reports.parse_responses(df, "struct<a:double, b:string>").collect()}
    assert [rows[i].status for i in range(1, 6)] == ["ok", "bad_json", "no_json", "bad_json", "ok"]
    assert rows[1].answer.a == 1.5 and rows[5].answer.a is None
    texts = reports.recommendations(df.withColumn("response", F.lit('["a", "b"]'))).filter("id = 1").collect()
    assert [r.recommendation for r in texts] == ["a", "b"]


def test_quoted_angle_brackets_and_references(spark):
    html = """<title>Caf&eacute; &#8217;s &#x27;x&#X27;</title><body><p title="a>b" class='c>d'>one &amp;lt; two &hellip; &unknown;
</p><a title="x>y" href="http://a/b?c=1&amp;d=2">go</a><b title="open>end</b></body>"""
    df = spark.createDataFrame([(1, "u", html)], "page_id bigint, url string, html string")
    row = pages.extract_page_text(df).first()
    assert row.title == "Caf\u00e9 \u2019s 'x'"
    assert "one &lt; two \u2026 &unknown;" in row.raw_text and 'b"' not in row.raw_text and "y\"" not in row.raw_text
    assert [r.link for r in pages.extract_links(df).collect()] == ["http://a/b?c=1&d=2"]


def test_crawl_summary_equals_the_filled_and_ranked_crawl(spark, small):
    from rowsmith.queries.pages import candidates_of, texts_of

    found, texts = candidates_of(spark, small), texts_of(spark, small)
    for part in (found, found.limit(0), found.filter("crawl_pos % 3 = 0")):
        want = pages.research_summary(pages.fill_shortfall(part, texts, texts.count())).first()
        assert pages.crawl_summary(part, texts).first() == want
