"""URL parsing and rules against plain Python; the classifier on held-out URLs."""

import random

from pyspark.sql import functions as F

from cartlens.llm import url_filter as uf
from cartlens.llm.queries import URL_RULES


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    return host, path[:min([i for i in map(path.find, "?#") if i >= 0], default=len(path))]


def rule(host, path):
    fits = [r for r in URL_RULES if (host == (d := r[:r.index("/")]) or host.endswith("." + d))
            and path.startswith(r[r.index("/"):])]
    return max(fits, key=len, default=None)


URLS = ["http://A.Example.NET/en/x?y#z", "https://example.net/en/", "https://notexample.net/en/1", "ftp://net/",
        "x://net", "x://example.com/de/7", "x://m.example.com/DE/7", "x://b.org/fr/é", "x://org/fr", "x://org/fr/",
        "nothing", "", None, "a://b://c/d", "://h/p", "x://h?q=/fr/", "x://h#/a", "x://ÉA.org/fr/#", "x://" + "a" * 20000,
        "x://example.net.evil.com/en/", "x://exa\nmple.org/fr/\n"]


def test_parsing_and_rules_equal_python(spark):
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS)] + [(None, "x://a.net/", "")],
                                  "page_id long, url string, host string")
    got = {r.page_id: r for r in uf.judge_urls(pages, 0.0, URL_RULES).collect()}
    for i, u in enumerate(URLS):
        want = parse(u)
        assert (got[i].host, got[i].path) == want, u
        assert got[i].rule == rule(*want)
        assert got[i].verdict == URL_RULES.get(got[i].rule, "allow")
    assert got[None].verdict == "block"
    assert uf.judge_urls(pages.where(F.lit(False)), 0.0, URL_RULES).count() == 0


def test_classifier_learns_host_and_path_grams(spark):
    rng = random.Random(5)
    bad, good = ["casino", "winbig", "pillz"], ["library", "garden", "recipes"]

    def url(label):
        word = rng.choice(bad if label else good)
        return f"https://{''.join(rng.choices('abcdefgh', k=5))}-{word}.com/{rng.randint(1, 9999)}"

    rows = [(url(k % 2), k % 2) for k in range(600)]
    train = spark.createDataFrame(rows[:400] + [(None, None), (None, 0)], "url string, label int")
    model = uf.fit_url_model(train)
    test = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows[400:])], "page_id long, url string")
    got = {r.page_id: r.verdict for r in uf.judge_urls(test, model, {}).collect()}
    right = sum((got[i] == "block") == bool(y) for i, (_, y) in enumerate(rows[400:]))
    assert right >= 195
    again = uf.fit_url_model(train.repartition(7))
    assert abs(again.coefficients.toArray() - model.coefficients.toArray()).max() < 1e-12


def test_no_labels_and_one_class(spark):
    none = spark.createDataFrame([], "url string, label int")
    assert uf.fit_url_model(none) == 0.0
    assert uf.fit_url_model(spark.createDataFrame([("x://a/", 1)], "url string, label int")) == 1.0


def test_labelled_urls_come_from_the_document_number(spark):
    pages = spark.createDataFrame([("x://h/en/12?p=1",), ("x://h/en/13.html",), ("x://h/14/",), ("x://h/en/",), (None,),
                                   ("x://h/99999999999999999999",)], "url string")
    labels = spark.createDataFrame([(12, 0), (13, 1), (14, None), (13, 1)], "doc_id long, quality int")
    assert sorted(map(tuple, uf.labelled_urls(pages, labels).collect())) == [("x://h/en/12?p=1", 1), ("x://h/en/13.html", 0)]
