import itertools
import math

import pytest
from pyspark.sql import functions as F

from deadhead.llm import urls

RULES = [urls.Rule("net/", "block"), urls.Rule("example.net/en/", "allow"), urls.Rule("example.com/de/", "block"), urls.Rule("org/fr/", "allow")]


def plain(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    tail = rest[end:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fit = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fit, key=lambda r: len(r.where)) if fit else None


CASES = [
    None, "", "no scheme/here", "http://A.Example.NET/en/x?y#z", "https://example.net/EN/", "http://netx/", "http://net/", "http://net", "x://a.net?q/en/",
    "https://b.example.com/de/1", "https://b.example.com/de", "http://q.org/fr/", "http://q.org/en/12", "http://a://b.net/c", "ftp://h.net/é\nü/x", "http://É.ORG/fr/a",
    "http://redfox99.org/xx/12", "http://" + "redfox" * 2000 + ".com/", "http://q.org/" + "p/" * 20000, "://.net/", "http://u@h.net:80/a",
]


def test_rules_and_parts(spark):
    pages = spark.createDataFrame([(i, u, "<p>red fox</p>", "z", 1) for i, u in enumerate(CASES)] + [(None, CASES[3], None, None, None)], "page_id long, url string, html string, host string, score int")
    got = urls.judge(pages, urls.unigrams(pages), RULES).collect()
    assert len(got) == len(CASES) + 1
    for r in got:
        host, path, rule = plain(CASES[3 if r.page_id is None else r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.where)
        assert r.verdict == (rule.verdict if rule else ("block" if r.score > 0 else "allow"))


def test_unigrams_leave_markup_out(spark):
    pages = spark.createDataFrame([("<style>p{x}</style><p class='a'>Red fox, RED<script>var q</script> été x2y</p>",), (None,)], "html string")
    assert {tuple(r) for r in urls.unigrams(pages).collect()} == {("red", 2), ("fox", 1), ("x", 1), ("y", 1)}


def best(run, logs, unknown):
    cuts = itertools.chain.from_iterable(itertools.combinations(range(1, len(run)), k) for k in range(len(run)))
    splits = ([run[a:b] for a, b in zip((0, *c), (*c, len(run)), strict=True)] for c in cuts)
    return max(sum(logs.get(w, unknown - math.log(10) * len(w)) for w in s) for s in splits)


@pytest.mark.parametrize("run", ["redfox", "redfoxes", "aredx", "zzz", "thered", "r"])
def test_viterbi_equals_all_splits(run):
    logs = {"red": -1.0, "fox": -1.5, "the": -0.5, "here": -1.2, "d": -4.0, "re": -3.0}
    found = urls.viterbi(run, logs, -6.0)
    assert "".join(found) == run
    assert math.isclose(sum(logs.get(w, -6.0 - math.log(10) * len(w)) for w in found), best(run, logs, -6.0))


def test_words_of_any_length_are_found(spark):
    long = "donaudampfschifffahrtsgesellschaft"
    other = long[:30]
    counts = urls.unigrams(spark.createDataFrame([(f"<p>red {long} red {other} {long}x</p>",)] * 9, "html string"))
    assert {r.word: r.n for r in counts.collect()} == {"red": 18, long: 9, other: 9, long + "x": 9}
    hosts = [f"red{long}red.com", long, f"{other}red", f"{long}x{long}", "q" * 40]
    words = {r.host: r.words for r in urls.segment(spark.createDataFrame([(h,) for h in hosts], "host string"), counts).collect()}
    assert words[hosts[0]][:3] == ["red", long, "red"] and words[long] == [long]
    assert words[hosts[2]] == [other, "red"] and words[hosts[3]] == [long + "x", long]
    assert words["q" * 40] == ["q" * 40]


def test_segments_and_naive_bayes(spark):
    counts = spark.createDataFrame([("red", 50), ("fox", 40), ("spam", 30), ("farm", 30), ("blog", 20)], "word string, n long")
    hosts = spark.createDataFrame([("redfox.spamfarm-9.com",), ("",), ("x",)], "host string")
    words = {r.host: r.words for r in urls.segment(hosts, counts).collect()}
    assert words["redfox.spamfarm-9.com"][:5] == ["red", "fox", "spam", "farm", "9"]
    rows = [(i, f"http://spamfarm{i}.net/buy/{i}") for i in range(30)] + [(100 + i, f"http://redfox{i}.org/fr/read") for i in range(30)]
    rows += [(200, "http://my-spamfarm.com/buy/7"), (201, "http://redfox.com/read")]
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string"), counts, RULES)
    assert {r.page_id: r.verdict for r in got.filter("page_id >= 200").collect()} == {200: "block", 201: "allow"}
    # the weights are those of a plain count
    weights, prior = urls._train(spark.createDataFrame([("block", [1, 1, 2]), ("allow", [2]), (None, [3])], "ruled string, slots array<int>"), 4)
    block, allow = [1, 3, 2, 1], [1, 1, 2, 1]
    assert [round(float(w), 9) for w in weights] == [round(math.log(b / 7) - math.log(a / 5), 9) for b, a in zip(block, allow, strict=True)] and prior == 0


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert urls.judge(pages, urls.unigrams(pages), RULES).collect() == []
    assert urls.unigrams(pages).agg(F.count("*")).first()[0] == 0
