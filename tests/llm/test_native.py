"""Line dedup and URL filter against plain Python, and plans without Python."""

import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from showroom.llm import line_dedup, mixing, url_filter
from showroom.llm.queries import URL_RULES

DATA = "/root/testdata/sf0.001"


def no_python(df):
    plan = df._jdf.queryExecution().toString()
    return not re.search("Python|Pandas|Arrow", plan)


def test_native_plans(spark):
    docs, pages = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/pages.parquet")
    assert no_python(line_dedup.without_boilerplate(docs)) and no_python(mixing.mixed(docs)) and no_python(url_filter.judge(pages, URL_RULES))


def plain_lines(rows, sites):
    on = defaultdict(set)
    for _, text, site in rows:
        for line in (text or "").split("\n"):
            if line.strip(" ") and site is not None:
                on[line.strip(" ")].add(site)
    out = []
    for key, text, _ in rows:
        kept = None if text is None else [x for x in text.split("\n") if len(on.get(x.strip(" "), ())) < sites]
        n = 0 if text is None else text.count("\n") + 1
        out.append((str(key), n, n - len(kept or []), None if text is None else "\n".join(kept)))
    return sorted(out, key=str)


def test_lines_near_and_far_from_the_threshold(make):
    pick = random.Random(3)
    lines = [f"line {i}" for i in range(30)]
    rows = [(j, "\n".join(["All rights reserved. "] + pick.sample(lines[: 5 + j % 25], 4) + [f"own {j}", ""]), f"s{pick.randrange(14)}") for j in range(300)]
    rows += [(900, None, "s1"), (901, "", "s1"), (902, "All rights reserved.", None), (903, "x\n" * 50_000, "s1"), (0, rows[0][1], "s3"), (None, " All rights reserved.\nb", "s2")]
    docs = make([(*r, 1) for r in rows], "doc_id bigint, text string, source string, lines int")
    for sites in (2, 7, 10, 13):
        got = line_dedup.without_boilerplate(docs, result="kept", sites=sites)
        got = [(str(r.doc_id), r.kept.n_lines, r.kept.n_removed, r.kept.text) for r in got.collect()]
        assert sorted(got, key=str) == plain_lines(rows, sites)


def test_many_sites_are_estimated(make):
    """Far from the threshold the sketch decides, near to it the exact count."""
    rows = [(i, "often\nrarely" if i < 40 else "often", f"site{i}") for i in range(3_000)]
    docs = make(rows, "doc_id bigint, text string, source string")
    assert line_dedup.boilerplate(docs, sites=1_000).count() == 1
    assert line_dedup.boilerplate(docs, sites=3_000).count() == 1
    assert line_dedup.boilerplate(docs, sites=3_001).count() == 0
    assert line_dedup.boilerplate(docs.limit(0)).count() == 0


def plain_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


URLS = [
    None, "", "no scheme", "://", "http://", "http://EXAMPLE.org/es/x", "http://a.example.org/es", "https://example.org/en/12?x=/es/", "x://y://example.org/es/",
    "http://org/", "http://borg/", "http://a.com/fr/1", "http://a.com/de/#top", "http://com/de/", "http://example.org:80/es/", "http://u@b.org/a", "http://a.net/es/?a=1&b=2",
    "http://a.org?x=/", "http://É.ORG/é", "http://a.org/\n/es/", "http://notexample.org/es/1", "http://x.example.org/en/1/2", "http://a.com/FR/1", "http://" + "a" * 100_000 + ".net/"]


def test_hosts_paths_and_rules(make):
    rows = [(i, u, "h") for i, u in enumerate(URLS)] + [(5, URLS[5], "h")]
    pages = make(rows, "page_id bigint, url string, host string")
    got = url_filter.judge(pages, URL_RULES)
    assert got.columns == ["page_id", "url", "host", "url_verdict"]
    for r in got.collect():
        host, path = plain_url(r.url)
        rule = plain_rule(host, path)
        assert (r.url_verdict.host, r.url_verdict.path, r.url_verdict.rule) == (host, path, rule.text if rule else None), r.url
        assert r.url_verdict.verdict in ("allow", "block") and (rule is None or r.url_verdict.verdict == rule.verdict)
    assert got.count() == len(rows)


def test_trees_learn_what_urls_look_like(spark, make):
    pick = random.Random(4)
    word = lambda: "".join(pick.choices("abcdefgh", k=6))
    good = [f"https://{word()}.net/{word()}/{word()}.html" for _ in range(300)]
    bad = [f"http://{word()}-{word()}.net/{pick.randrange(10**9)}?a={pick.randrange(99)}&b={word()}&c=1" for _ in range(300)]
    rows = [(u, 1.0 if u in good else 0.0) for u in good[:250] + bad[:250]]
    model = url_filter.train(make(rows, "url string, allowed double"))
    test = make([(u, int(u in good)) for u in good[250:] + bad[250:]], "url string, y int")
    url = F.col("url")
    test = test.withColumns({"host": url_filter.host_of(url), "path": url_filter.path_of(url)})
    test = test.withColumns(url_filter.lexical(url, F.col("host"), F.col("path")))
    out = model.trees.transform(url_filter._with_suffixes(test, model.suffixes, model.rate))
    assert out.where("prediction = y").count() >= 97
    entropy = {r.url: r.entropy for r in make([("aabb", "", ""), ("aaaa", "", "")], "url string, host string, path string").withColumns(url_filter.lexical(url, F.col("host"), F.col("path"))).collect()}
    assert entropy == {"aabb": 1.0, "aaaa": 0.0}


def test_suffix_statistics_count_all_labels(make):
    """Only the trees see a sample: few rows for them leave the suffix tables and the rate as they are."""
    rows = [(f"http://h{i % 7}.site{i % 150}.net/{i}", float(i % 150 < 50)) for i in range(1_500)]
    urls = make([*rows, ("http://a.other.net/", None)], "url string, allowed double")
    model = url_filter.train(urls, rows=60, trees=2)
    assert model.trees is not None and abs(model.rate - 1 / 3) < 1e-12
    one, two = ({r.suffix: (r.n, r.good) for r in t.collect()} for t in model.suffixes)
    assert one == {"net": (1_500, 500.0)}
    assert two == {f"site{i}.net": (10, 10.0 if i < 50 else 0.0) for i in range(150)}


def test_one_url_many_times_and_rare_labels(make):
    """The sample for the trees may lack rows or one of the verdicts."""
    urls = make([("http://a.net/x", float(i % 2)) for i in range(300)], "url string, allowed double")
    model = url_filter.train(urls, rows=2, trees=2)
    assert model.trees is not None and model.rate == 0.5
    urls = make([(f"http://a{i}.net/x", float(i > 0)) for i in range(2_000)], "url string, allowed double")
    model = url_filter.train(urls, rows=30, trees=2)
    assert model.trees is not None and model.rate == 1_999 / 2_000 and model.suffixes[1].count() == 2_000


def test_without_labels_or_rows(make):
    pages = make([(1, "http://a.net/"), (2, None)], "page_id bigint, url string")
    assert {r.url_verdict.verdict for r in url_filter.judge(pages, URL_RULES).collect()} == {"allow"}
    blocked = make([(1, "http://a.com/de/"), (2, "http://b.net/")], "page_id bigint, url string")
    assert {r.url_verdict.verdict for r in url_filter.judge(blocked, URL_RULES).collect()} == {"block"}
    assert url_filter.judge(pages.limit(0), URL_RULES).count() == 0
