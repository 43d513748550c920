from ledgerline.llm import op4_url_filter as op

URLS = [
    "https://www.A.Example.NET/en/1?x#y", "http://net", "http://net/", "http://a.net?x=/", "https://example.com/de/5", "https://www.example.com/en/5", "http://x.org/fr/", "http://xorg/fr/",
    "http://anet/", "no scheme", "", None, "http://", "ftp://h/p://q", "https://blog.example.net/de/1", "https://www.free-bets.example.com/en/9", "https://www.ordinary.example.com/en/9", "http://ÄB.net/é",
]


def expected(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        rest = rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    best = None
    for rule, verdict in op.RULES:
        own, _, tail = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + tail) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return host, path, best


def test_rules_against_plain_python(spark):
    schema = "page_id long, url string, host string, verdict int, _decided string"
    pages = spark.createDataFrame([(i, u, "x", 1, "y") for i, u in enumerate(URLS + URLS[:2])], schema)
    model = op.train(spark)
    got = {r["page_id"]: r for r in op.judge(pages, model).collect()}
    assert len(got) == len(URLS) + 2
    for i, u in enumerate(URLS + URLS[:2]):
        host, path, best = expected(u)
        assert (got[i]["host"], got[i]["path"]) == (host, path)
        assert got[i]["rule"] == (best and best[0])
        if best:
            assert got[i]["verdict"] == best[1]
        else:
            assert got[i]["verdict"] == ("block" if model.scores([host], [path])[0] >= 0.6 else "allow")
    assert got[URLS.index(None)]["verdict"] == "allow"
    assert got[15]["verdict"] == "block" and got[16]["verdict"] == "allow"


def test_model_learns_its_table_and_is_deterministic(spark):
    model, again = op.train(spark), op.train(spark)
    assert (model.weights == again.weights).all() and model.bias == again.bias
    rows = op.default_labels()
    found = [expected(u)[:2] for u, _ in rows]
    scores = model.scores([h for h, _ in found], [p for _, p in found])
    right = sum((s >= 0.6) == bool(label) for s, (_, label) in zip(scores, rows))
    assert right >= 0.95 * len(rows)


def test_empty_and_unlabelled(spark):
    none = spark.createDataFrame([], "url string, label int")
    model = op.train(spark, none)
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    assert op.judge(pages.limit(0), model).count() == 0
    assert op.judge(pages, model).first()["verdict"] == "allow"
