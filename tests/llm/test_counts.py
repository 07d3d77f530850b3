"""Collocations, host reputation and whitening, against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.llm import collocations, hosts, whitening
from tests.helpers import rows


def phrases_of(text, width):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
        ws = re.findall(r"[^\x20\x09]+", piece)
        for k in range(1, width + 1):
            for i in range(len(ws) - k + 1):
                yield tuple(ws[i:i + k])


def brute_collocations(plain, width=3, least=10, percent=50, top=2000):
    found = defaultdict(Counter)
    for text, lang in plain:
        found[lang or "und"].update(phrases_of(text, width))
    out = []
    for lang, f in found.items():
        often = {p: n for p, n in f.items() if len(p) > 1 and n >= least}
        ranked = []
        for p, a in often.items():
            score, _, left, right = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]])
                                        for k in range(1, len(p)))
            longer = [n for q, n in often.items() if len(q) > len(p) and any(
                q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if not any(100 * n >= percent * a for n in longer):
                ranked.append((-score, -a, " ".join(p).encode(), left, right))
        total = sum(n for p, n in f.items() if len(p) == 1)
        for i, (s, a, p, left, right) in enumerate(sorted(ranked)[:top]):
            out.append((lang, i + 1, p.decode(), -a, left, right, total, -s))
    return sorted(out, key=repr)


def test_collocations(spark, docs, no_docs):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("a b c d Éa".split()) + rng.choice(("", "", ".", ",\t"))
                      for _ in range(rng.randint(0, 60))) for _ in range(80)]
    texts += ["a b a\x01 b\x00c \x7f b a b\x1fd a b e " * 12]
    data = [(t, rng.choice(("en", "de", None))) for t in texts] + [("b a. " * 40, None), (None, "en")]
    df = spark.createDataFrame(data, "text string, lang string").repartition(5)
    for width, least, top in ((3, 10, 2000), (2, 3, 5), (4, 5, 20)):
        got = rows(collocations.collocations(df, width, least, top=top))
        assert got == brute_collocations(data, width, least, top=top)
    plain = [tuple(r) for r in docs.select("text", "lang").collect()]
    assert rows(collocations.collocations(docs, min_count=2)) == brute_collocations(plain, least=2)
    assert collocations.collocations(no_docs).count() == 0


@pytest.mark.parametrize("size", (7, 40, 300))
def test_windows_do_not_depend_on_slices(size):
    rng = random.Random(size)
    text = "".join(rng.choice(("ab", "é", "X" * 50, " ", "\t", ".", "\n")) for _ in range(600))
    for width in (2, 3, 4):
        found = Counter()
        for part in collocations.windows_of(text.encode(), width, size):
            for *words, n in zip(*[c.to_pylist() for c in part.columns]):
                found[tuple(w for w in words if w is not None)] += n
        want = Counter()
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", "".join(
                c.lower() if c.isascii() else c for c in text)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            want.update(tuple(ws[i:i + width]) for i in range(len(ws)))
        assert found == want


def test_longest_windows_are_summed_by_rollup(docs):
    counted = collocations.phrase_counts(docs, 3, 2)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("rangepartitioning") == 1


@pytest.mark.parametrize("size", (1, 3, 50))
def test_rare_ends_keep_frequent_counts(size):
    import pyarrow as pa

    rng = random.Random(size)
    windows = Counter()
    for _ in range(3000):
        ws = [rng.choice("abcdefghij") for _ in range(rng.choice((1, 2, 3, 3, 3, 3)))]
        windows[" ".join(ws), rng.choice(("x", "y"))] += rng.choice((1, 1, 1, 4))
    data = sorted(windows.items())
    for low, high in ((0, len(data)), (100, 700)):
        state, found, want = collocations.RareEnds(3, 8), Counter(), Counter()
        part = [(w, g, n - n // 2) for (w, g), n in data[low:high]]
        part = [r for w, g, n in part for r in ((w, g, n), (w, g, 1))]
        tables = [pa.table([list(c) for c in zip(*part[i:i + size])], ["_window", "_lang", "_n"])
                  for i in range(0, len(part), size)]
        outs = [state.feed(t) for t in tables] + [state.feed(tables[0].slice(0, 0), last=True)]
        for w, g, n in (r for t in outs for r in zip(*[c.to_pylist() for c in t.columns])):
            for k in range(w.count(" ") + 1):
                found[g, " ".join(w.split(" ")[:k + 1])] += n
        for w, g, n in part:
            for k in range(w.count(" ") + 1):
                want[g, " ".join(w.split(" ")[:k + 1])] += n
        for key, n in want.items():
            assert found[key] == n or (n < 8 and found[key] == 0)
        edges = {" ".join(part[i][0].split(" ")[:2]) for i in (0, -1)}
        assert all(found[g, e] == want[g, e] for e in edges for g in "xy" if (g, e) in want)
        assert set(found) < set(want)


RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1")]


def brute_hosts(outcomes, z=1.645):
    """Posterior mean and lower bound of every host, level by level."""
    def strength(units):
        excess = sum((x - n * m) ** 2 - n * m * (1 - m) for n, x, m in units)
        room = sum(n * m * (1 - m) * (n - 1) for n, x, m in units)
        share = max(excess / room, 1 / 1001) if room > 0 else 1 / 1001
        return max(1 / share - 1, 0.5)

    counts = defaultdict(lambda: [0, 0])
    for host, bad in outcomes:
        counts[host][0] += bad is not None
        counts[host][1] += bad or 0
    levels = [{h: (h.split(".")[-1],) + (".".join(h.split(".")[-2:]), h) for h in counts}]
    means = {(): (sum(x for _, x in counts.values()) + 0.5) / (sum(n for n, _ in counts.values()) + 1)}
    for depth in (1, 2, 3):
        units = defaultdict(lambda: [0, 0])
        for h, (n, x) in counts.items():
            unit = units[levels[0][h][:depth]]
            unit[0] += n
            unit[1] += x
        k = strength([(n, x, means[u[:-1]]) for u, (n, x) in units.items()])
        means.update({u: (k * means[u[:-1]] + x) / (k + n) for u, (n, x) in units.items()})
    out = {}
    for h, (n, x) in counts.items():
        mean = means[levels[0][h]]
        out[h] = (mean, mean - z * (mean * (1 - mean) / (k + n + 1)) ** 0.5)
    return out


def test_host_reputation(spark):
    rng = random.Random(4)
    share = {"a.good.com": 0.02, "b.good.com": 0.05, "x.bad.com": 0.95, "y.bad.com": 0.9, "one.net": 0.5,
             "u.v.org": 0.1}
    labelled = [(f"http://{h}/{i}", int(rng.random() < p)) for h, p in share.items() for i in range(60)]
    labelled += [("http://new.bad.com/1", 1), ("http://new.good.com/1", 1), ("http://one.net/", None)]
    pages = [(i, u) for i, (u, _) in enumerate(labelled)]
    pages += [(1000, "http://never.bad.com/x"), (1001, "http://never.good.com/x")]
    got = hosts.filtered_urls(spark.createDataFrame(pages, "page_id long, url string").repartition(3),
                              spark.createDataFrame(labelled, "url string, bad int"), [])
    found = {r["host"]: r for r in got.dropDuplicates(["host"]).collect()}
    outcomes = [(u.split("/")[2], b) for u, b in labelled] + [
        ("never.bad.com", None), ("never.good.com", None)]
    for host, (mean, low) in brute_hosts(outcomes).items():
        assert found[host]["bad_mean"] == pytest.approx(mean) and found[host]["bad_low"] == pytest.approx(low)
    blocked = {h for h, r in found.items() if r["verdict"] == "block"}
    assert {"x.bad.com", "y.bad.com"} <= blocked and not any("good" in h for h in blocked)
    # One bad page does not condemn a host of a good domain; a bad domain weighs on its new hosts.
    assert found["new.bad.com"]["bad_mean"] > 0.7 > 0.5 > found["new.good.com"]["bad_mean"]
    assert found["never.bad.com"]["bad_mean"] > found["never.good.com"]["bad_mean"]


def test_urls_and_rules(spark):
    urls = ["http://A.Example.ORG/es/x?y#z", "https://example.org/en/12", "http://badexample.org/es/",
            "http://example.org?x", "ftp://user@h.co.uk:80/p/#q", "no url", None, "", "://", "a://b://c/d",
            "http://192.168.0.1:8080/x", "http://org/", "http://example.org/en/2", "HTTP://É.COM/Ab",
            "http://h.org/" + "p" * 100_000, "http://h.org/" + "p" * 100_000]
    df = spark.createDataFrame([(i if i != 3 else None, u, "x") for i, u in enumerate(urls)],
                               "page_id long, url string, host string")
    none = spark.createDataFrame([], "url string, bad int")
    got = hosts.filtered_urls(df, none, RULES).select("page_id", "host", "path", "rule", "verdict").collect()
    assert len(got) == len(urls)
    by = {r["page_id"]: tuple(r)[1:] for r in got}
    assert by[0] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert by[1][2:] == ("example.org/en/1", "block") and by[2][2:] == ("org/", "allow")
    assert by[None] == ("example.org", "", None, "allow")  # the path does not start with a slash
    assert by[4][:3] == ("user@h.co.uk:80", "/p/", None)
    assert [by[i][:2] for i in (5, 6, 7, 8)] == [("", "")] * 4 and by[9][:2] == ("b:", "//c/d")
    assert by[11][2] == "org/" and by[12][2:] == ("org/", "allow") and by[13][0] == "É.com"
    assert len(by[14][1]) == 100_001 and by[14][2] == "org/"
    named = df.filter("url is not null").select(hosts.suffix_of(F.lit("user@h.co.uk:80")).alias("s"),
                                                hosts.domain_of(F.lit("a.b.co.uk"), F.lit("co.uk")).alias("d"),
                                                hosts.suffix_of(F.lit("192.168.0.1:8080")).alias("i")).first()
    assert tuple(named) == ("co.uk", "b.co.uk", "")
    assert hosts.filtered_urls(df.limit(0), none, RULES).count() == 0
    with pytest.raises(ValueError):
        hosts.filtered_urls(df, none, [("block", "example.org")])


def brute_whitening(vectors, k=4):
    x = np.array([[int(np.floor(256 * c)) for c in v] for v in vectors], object)
    u = np.unique(x.astype(np.int64), axis=0).astype(object)
    n, sums = len(u), u.sum(axis=0)
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    c = (n * u - sums).astype(float) / n
    values, vec = np.linalg.eigh(c.T @ c / n)
    values, vec = values[::-1], vec[:, ::-1]
    return n, deviation, (n * x - sums).astype(float) / n @ vec[:, :k] / np.sqrt(values[:k]), \
        values[:k] / values.sum()


@pytest.mark.parametrize("kind", ("plain", "narrow", "constant", "copied"))
def test_whitening(spark, kind):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(400, 6)) @ np.diag([9, 5, 3, 2, 1, 0.5])
    if kind == "narrow":
        data = data @ np.diag([1e4, 1e2, 1, 1, 1, 1])
    if kind == "constant":
        data[:, 2] = 7
    if kind == "copied":
        data[:, 5] = data[:, 0]
    data = [[float(c) for c in v] for v in data] + [[float(c) for c in data[3]]] * 50
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], "vec_id long, embedding array<double>")
    got = whitening.whitened(df.repartition(3)).collect()
    n, deviation, want, explained = brute_whitening(data)
    assert len(got) == 4 * len(data) and {r["n"] for r in got} == {n}
    by = defaultdict(dict)
    for r in got:
        by[r["component"]][r["vec_id"]] = r["whitened"]
        exact = deviation[r["vec_id"]]
        assert r["deviation"] == (exact if exact < 2**63 else None) and r["identity_error"] < 1e-9
        assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-9)
    for c in range(4):
        mine = np.array([by[c + 1][i] for i in range(len(data))])
        assert min(np.abs(mine - want[:, c]).max(), np.abs(mine + want[:, c]).max()) < 1e-6


def test_whitening_cases(spark):
    rows_ = [(1, [1.0, 2.0], "a"), (None, [2.0, 1.0], "b"), (1, [1.0, 2.0], "a"), (3, None, "c"), (4, [], "d"),
             (5, [None, 1.0], "e"), (6, [float("nan"), 1.0], "f"), (7, [float("inf"), 1.0], "g"),
             (8, [3.0], "h"), (9, [4.0, 4.5], "i")]
    df = spark.createDataFrame(rows_, "vec_id long, embedding array<double>, n string")
    got = whitening.whitened(df)
    assert rows(got.select("vec_id", "component").distinct()) == sorted(
        [(i, c) for i in (1, None, 9) for c in (1, 2)], key=repr)
    assert got.filter("vec_id = 1").count() == 4 and got.filter("n <> 3").count() == 0
    assert whitening.whitened(df.filter("vec_id = 1")).count() == 0  # one vector has no variance
    assert whitening.whitened(df.limit(0)).count() == 0
    huge = spark.createDataFrame([(1, [1e12, 0.5]), (2, [-1e12, 0.25])], "vec_id long, embedding array<double>")
    assert {r["deviation"] for r in whitening.whitened(huge).collect()} == {None}


def test_factors():
    rng = np.random.default_rng(5)
    a = rng.normal(size=(200, 70))
    r = whitening.upper_factor(a.T @ a)
    q = whitening.solved(a, r)
    assert np.allclose(q.T @ q, np.eye(70)) and np.allclose(q @ r, a) and np.allclose(r, np.triu(r))
