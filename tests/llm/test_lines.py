from collections import defaultdict

import pytest

import llm_edges
from tillflow.llm import site_lines

BLANK = " \t\n\r\x0b\x0c"


def brute(rows, ratio, least):
    """rows of (host, text); cleaned texts."""
    pages, on = defaultdict(int), defaultdict(int)
    for host, text in rows:
        pages[host] += 1
        for line in {x.strip(BLANK) for x in (text or "").split("\n")} - {""}:
            on[host, line] += 1
    drop = {k for k, n in on.items() if n >= least and n > ratio * pages[k[0]]}
    return [None if t is None else "\n".join(x for x in t.split("\n") if (h, x.strip(BLANK)) not in drop) for h, t in rows]


@pytest.mark.parametrize("ratio,least", [(0.05, 5), (0.3, 2), (0.0, 1), (1.0, 1)])
def test_edges_by_brute_force(spark, ratio, least):
    docs = llm_edges.crowded(spark)
    out = site_lines.without_boilerplate(docs, ratio=ratio, least=least)
    assert set(out.columns) == set(docs.columns)
    rows = llm_edges.rows()
    want = brute([(r[3], r[1]) for r in rows], ratio, least)
    got = out.select("doc_id", "text").collect()
    key = lambda x: (str(x[0]), str(x[1]))
    assert sorted(map(tuple, got), key=key) == sorted(((r[0], t) for r, t in zip(rows, want)), key=key)


def test_ratio_is_relative_to_the_host(spark):
    pages = [("big", f"menu\nown {i}" if i % 10 == 0 else f"own {i}") for i in range(100)]
    pages += [("small", f"menu \r\n{i}\nmenu") for i in range(10)] + [(None, f"foot\n{i}") for i in range(6)]
    df = spark.createDataFrame(pages, "site string, body string")
    out = site_lines.without_boilerplate(df, host="site", text="body", ratio=0.2).collect()
    assert sum("menu" in r["body"] for r in out if r["site"] == "big") == 10
    assert not any("menu" in r["body"] for r in out if r["site"] == "small")
    assert all(r["n_dropped"] == 2 and r["n_lines"] == 3 for r in out if r["site"] == "small")
    assert not any("foot" in r["body"] for r in out if r["site"] is None)


def test_text_of_boilerplate_only_becomes_empty(spark):
    df = spark.createDataFrame([(1, "a", "x")] * 9 + [(2, "a", None)], "doc_id long, source string, text string")
    out = site_lines.without_boilerplate(df).collect()
    assert sorted((r["doc_id"], r["text"], r["n_dropped"]) for r in out if r["doc_id"] == 1) == [(1, "", 1)] * 9
    assert [(r["text"], r["n_lines"], r["n_dropped"]) for r in out if r["doc_id"] == 2] == [(None, 0, 0)]


def test_empty_table(spark):
    assert site_lines.without_boilerplate(llm_edges.empty(spark)).count() == 0


def test_hot_host_beyond_the_broadcast_limit(spark, confs):
    confs(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    rows = [("hot" if i % 3 else f"h{i % 50}", f"menu\nbody {i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "source string, text string")
    out = site_lines.without_boilerplate(df)
    assert sum("menu" in r["text"] for r in out.collect()) == 0
    plan = out._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
