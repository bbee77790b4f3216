from tallyspark.llm import urls

SCHEMA = "page_id long, url string, html string"


def judge(spark, rows):
    return {r["page_id"]: r for r in urls.op9_urls(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_hosts_paths_and_rules(spark):
    got = judge(spark, [
        (1, "https://A.Example.COM/en/1?x=/en/#f", ""), (2, "http://www.example.com/en/1", ""), (3, "http://www.example.com/en", ""),
        (4, "http://x.net/es/2.html", ""), (5, "http://x.net/es", ""), (6, "http://notnet/es/", ""), (7, None, ""), (8, "nothing", ""),
        (9, "http://x.com", ""), (10, "http://x.com?a", ""), (11, "a://b://c.com/d", ""), (12, "http://sub.www.example.com/en/", ""), (13, "http://examplexcom/en/", "")])
    rows = {k: (r["host"], r["path"], r["rule"]) for k, r in got.items()}
    assert rows == {
        1: ("a.example.com", "/en/1", "example.com/en/"), 2: ("www.example.com", "/en/1", "www.example.com/en/"), 3: ("www.example.com", "/en", "com/"),
        4: ("x.net", "/es/2.html", "net/es/"), 5: ("x.net", "/es", None), 6: ("notnet", "/es/", None), 7: ("", "", None), 8: ("", "", None),
        9: ("x.com", "", None), 10: ("x.com", "", None), 11: ("b:", "//c.com/d", None), 12: ("sub.www.example.com", "/en/", "www.example.com/en/"),
        13: ("examplexcom", "/en/", None)}
    assert got[1]["verdict"] == "block" and got[2]["verdict"] == "allow" and got[4]["verdict"] == "block"


def test_templates(spark):
    df = spark.createDataFrame([(1, "/a/123/x.html",), (2, "/2024-01-02/00ff00ff1/"), (3, "/1/2/3/4/5/6/7/8"), (4, "/123.html"), (5, "")], "i long, path string")
    got = {r["i"]: r["s"] for r in df.select("i", urls.segments(df["path"]).alias("s")).collect()}
    assert got == {1: ["a", "{number}", "x.html"], 2: ["{date}", "{hex}"], 3: ["{number}"] * 6 + ["**"], 4: ["{number}.html"], 5: []}


def test_variable_positions_merge_and_purity_rejects(spark):
    rules = (("block", "bad.org", "/s/"),)
    rows = [(i, f"http://bad.org/s/w{i}x/", "") for i in range(200)] + [(500 + i, f"http://bad.org/t{i}/k", "") for i in range(3)]
    rows += [(1000 + i, f"http://good.org/a/w{i}", "") for i in range(50)] + [(1, rows[1][1], "")]
    got = urls.filter_urls(spark.createDataFrame(rows, SCHEMA), rules).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    assert by[0]["template"] == "/s/*" and by[0]["purity"] > 0.9 and by[0]["rule"] == "bad.org/s/"
    assert by[1000]["template"] == "/a/*" and by[1000]["verdict"] == "allow"


LEARNING = (("block", "bad.org", "/s/"), ("block", "mixed.org", "/s/"), ("allow", "mixed.org", "/a/"), ("allow", "good.org", "/"))


def test_undecided_urls_are_blocked_or_allowed_by_labels(spark):
    rows = [(i, f"http://bad.org/s/{i}", "") for i in range(40)] + [(100 + i, f"http://bad.org/u{i % 2}/{i}", "") for i in range(30)]
    rows += [(200 + i, f"http://mixed.org/s/{i}", "") for i in range(20)] + [(300 + i, f"http://mixed.org/a/{i}", "") for i in range(20)]
    rows += [(400 + i, f"http://mixed.org/v/{i}", "") for i in range(10)] + [(500, "http://unknown.org/s/1", ""), (501, None, "")]
    rows += [(600 + i, f"http://good.org/s/{i}", "") for i in range(25)]
    wide = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as host", "1 as segs", "2 as purity")
    got = {r["page_id"]: r for r in urls.filter_urls(wide, LEARNING).collect()}
    assert len(got) == len(rows)
    # every label of bad.org is blocked, so its other branches follow the host
    assert {(got[i]["template"], got[i]["verdict"]) for i in range(40)} == {("/s/{number}", "block")}
    assert {(got[i]["template"], got[i]["verdict"]) for i in range(100, 130)} == {("/*/{number}", "block")}
    share = (40 + 20) / (40 + 20 + 20 + 25)
    assert abs(got[100]["purity"] - (40 + 4 * share) / 44) < 1e-12
    # differing branches stay apart; one without labels falls in with the rest, which does not reach the threshold
    assert got[200]["template"] == "/s/{number}" and got[300]["template"] == "/a/{number}" and got[400]["template"] == "/*/{number}"
    assert {got[400 + i]["verdict"] for i in range(10)} == {"allow"} and got[500]["verdict"] == got[501]["verdict"] == "allow"


def test_rare_branches_merge_unless_their_labels_differ(spark):
    rules = (("block", "bad.org", "/s/"), ("allow", "bad.org", "/ok/"), ("allow", "good.org", "/"))
    rows = [(i, f"http://good.org/a/{i}", "") for i in range(100)] + [(200, "http://good.org/b/1", "")]
    rows += [(300 + i, f"http://bad.org/s/{i}", "") for i in range(100)] + [(500, "http://bad.org/ok/1", "")]
    got = {r["page_id"]: r["template"] for r in urls.filter_urls(spark.createDataFrame(rows, SCHEMA), rules).collect()}
    assert got[0] == got[200] == "/*/{number}" and got[300] == "/s/{number}" and got[500] == "/ok/{number}"


def test_empty(spark):
    assert judge(spark, []) == {}
