"""The URL filter against its SQL on tables made for it, and its rules against a plain loop."""

import random

import compare
import duckdb
import pyarrow as pa
import pytest

from kerbside.llm import common, urls
from kerbside.llm.queries import ORACLE

ODD = [None, "", "no scheme", "://", "http://", "http://ORG", "http://a.org/x", "http://org?x://y/z", "http://aorg/",
       "x://y://z/de/1", "http://Example.ORG/es/1", "http://b.example.org/es", "http://example.org/en/1?u", "http://É.com/fr/",
       "http://a.com/de/", "http://a.com/de", "http://.com//de//x", "http://a.com:80/de/1", "http://a.com/DE/1", "http://com#/de/",
       "http://a.com/de/*|{x}\\y", "http://l.com/" + "/".join("abcdefghijkl"), "http://a.com/de/\n", "http://a.com/" + "x" * 300_000,
       "http://n.com/" + "a/" * 50_000]


def plain_rule(url):
    """Host, path and the rule that counts."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = "".join(c.lower() if c < "\x80" else c for c in rest[:end]), rest[end:]
    path = rest[:min([rest.index(c) for c in "?#" if c in rest], default=len(rest))]
    fitting = []
    for rule, verdict in urls.RULES:
        at = rule.index("/")
        if (host == rule[:at] or host.endswith("." + rule[:at])) and path.startswith(rule[at:]):
            fitting.append((len(rule), rule, verdict))
    return host, path, *(max(fitting)[1:] if fitting else (None, None))


def tree_of(seed, n):
    """URLs of a few hosts, one of which has a third of them, with labelled and unlabelled branches of several sizes."""
    pick = random.Random(seed)
    hosts = [f"h{k}.{end}" for k in range(12) for end in ("com", "org", "example.org", "net")]
    words = ["de", "fr", "en", "news", "a*b", "{x|y}"]
    found = []
    for _ in range(n):
        host = "hot.com" if pick.random() < 0.34 else pick.choice(hosts)
        path = [pick.choice(words), *(str(pick.randrange(500)) if pick.random() < 0.6 else pick.choice("uvw")
                                      for _ in range(pick.choice([0, 1, 1, 2, 9])))]
        found.append(f"http://{host}/" + "/".join(path) + pick.choice(["", "/", "?q", "#x"]))
    return found


def frame(spark, found):
    rows = [(i // 2 if i % 5 else None, url, "clash", 1) for i, url in enumerate(found)]
    return spark.createDataFrame(rows, "page_id long, url string, host string, score int").repartition(6)


def differences(spark, found, rules=None):
    pages = frame(spark, found)
    connection = duckdb.connect()
    connection.register("pages", pa.Table.from_pylist(
        [{"page_id": r.page_id, "url": r.url} for r in pages.collect()], pa.schema({"page_id": pa.int64(), "url": pa.string()})))
    return compare.differences(urls.judge(pages), connection, ORACLE["op11_urls"])


@pytest.mark.parametrize("heavy", [3, 1000])
def test_as_sql(spark, monkeypatch, heavy):
    """Nodes by broadcast and by join, escaped marks, deep paths."""
    monkeypatch.setattr(common, "HEAVY", heavy)
    assert differences(spark, tree_of(heavy, 3000) + ODD) == ""


def test_rules_as_plain_loop(spark):
    found = ODD + tree_of(5, 300)
    rows = {(r.page_id, r.host, r.path, r.rule) for r in urls.judge(frame(spark, found)).collect()}
    assert rows == {(i // 2 if i % 5 else None, *plain_rule(url)[:3]) for i, url in enumerate(found)}


def test_templates_are_rejected_by_their_labels(spark):
    """A rule blocks most of a branch: the rest of it goes as well, its sister stays; without labels nothing goes."""
    rules = (("bad.com/shop/1", "block"), ("bad.com/help/", "allow"))
    found = [f"http://bad.com/shop/1{i}" for i in range(60)] + [f"http://bad.com/shop/2{i}" for i in range(9)]
    found += [f"http://bad.com/help/{i}" for i in range(40)] + [f"http://good.com/shop/{i}" for i in range(40)]
    rows = urls.judge(frame(spark, found), rules).collect()
    by_place = {(r.host, r.path.split("/")[1], r.rule is None): set() for r in rows}
    for r in rows:
        by_place[r.host, r.path.split("/")[1], r.rule is None].add((r.verdict, r.template))
    assert by_place == {("bad.com", "shop", False): {("block", "/shop/*")}, ("bad.com", "shop", True): {("block", "/shop/*")},
                        ("bad.com", "help", False): {("allow", "/help/*")}, ("good.com", "shop", True): {("allow", "/shop/*")}}


def test_alike_branches_are_merged(spark):
    rules = (("x.com/a/", "block"), ("x.com/b/", "block"), ("x.com/c/", "allow"))
    found = [f"http://x.com/{word}/{i}" for word in "abcd" for i in range(30)]
    rows = urls.judge(frame(spark, found), rules).collect()
    assert {r.template for r in rows} == {"/{a|b}/*", "/c/*", "/d/*"}


def test_empty_table_and_one_without_rules(spark):
    assert urls.judge(frame(spark, [])).collect() == []
    rows = urls.judge(frame(spark, ["http://a.net/x"]), ()).collect()
    assert [(r.rule, r.verdict) for r in rows] == [(None, "allow")]


def test_no_python_worker(spark):
    """The whole method is in expressions: no plan of it has a Python node."""
    plan = urls.judge(frame(spark, tree_of(1, 50)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
