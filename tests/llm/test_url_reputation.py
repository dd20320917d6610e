"""URL verdicts: parsing, rules, shrinkage against plain Python, edges."""

import math
import random
from collections import defaultdict

import pytest

from courtside.llm.queries import URL_RULES
from courtside.llm.url_reputation import judge_urls


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = lambda s, chars: min([s.index(c) for c in chars if c in s], default=len(s))
    n = cut(rest, "/?#")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:n])
    return host, rest[n:][:cut(rest[n:], "?#")]


def brute(pages, outcomes, max_bad, z=1.645):
    bad = {}
    for i, b in outcomes:
        if i is not None and b is not None:
            bad[i] = max(bad.get(i, 0), b)
    hosts = defaultdict(lambda: [0, 0])
    for i, url in pages:
        h = hosts[split(url)[0]]
        if i in bad:
            h[0] += 1
            h[1] += bad[i]
    suffix = lambda h: h.rsplit(".", 1)[-1]
    domain = lambda h: ".".join(h.split(".")[-2:])

    def total(keys, of):
        out = defaultdict(lambda: [0, 0])
        for k, (n, b) in keys.items():
            out[of(k)][0] += n
            out[of(k)][1] += b
        return out

    d = total(hosts, domain)
    s = total(d, suffix)
    g = total(s, lambda k: "")

    def strength(children, parents, of):
        sums, k, n2 = defaultdict(float), defaultdict(int), defaultdict(int)
        for c, (n, b) in children.items():
            if n:
                pn, pb = parents[of(c)]
                p = (pb + .5) / (pn + 1)
                sums[of(c)] += n * (b / n - p) ** 2 / (p * (1 - p))
                k[of(c)] += 1
                n2[of(c)] += n * n
        df, room = sum(k.values()) - len(k), sum(parents[p][0] - n2[p] / parents[p][0] for p in k)
        rho = (sum(sums.values()) - df) / (room - df) if df > 0 and room > df else 0
        return 1 / max(.005, min(.5, rho)) - 1

    ms, md, mh = strength(s, g, lambda k: ""), strength(d, s, suffix), strength(hosts, d, domain)
    p0 = (g[""][1] + .5) / (g[""][0] + 1)
    ps = {k: (ms * p0 + b) / (ms + n) for k, (n, b) in s.items()}
    pd = {k: (md * ps[suffix(k)] + b) / (md + n) for k, (n, b) in d.items()}
    out = []
    for i, url in pages:
        host, path = split(url)
        n, b = hosts[host]
        mean = (mh * pd[domain(host)] + b) / (mh + n)
        low = math.sin(max(0, math.asin(math.sqrt(mean)) - z / (2 * math.sqrt(mh + n + 1)))) ** 2
        fits = [(r, a) for a, r in URL_RULES
                if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0])) and path.startswith("/" + r.split("/", 1)[1])]
        rule, action = max(fits, key=lambda x: len(x[0]), default=(None, None))
        out.append((i, host, path, rule, action or ("block" if round(low, 6) > max_bad else "allow"), n, b, round(low, 6)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain_python(spark, seed):
    rng = random.Random(seed)
    hosts = [f"{a}{b}.{c}" for a in ("", "www.", "m.") for b in ("example", "spam", "good", "x1") for c in ("com", "net", "org")]
    rate = {h: rng.random() for h in hosts}
    urls = [f"http{rng.choice(['', 's'])}://{rng.choice([h, h.upper()])}{rng.choice(['', '/', '/en/1', '/es/', '/fr/x?y=/en/', '?q', '#f'])}"
            for h in rng.choices(hosts, k=600)]
    pages = [(i, u) for i, u in enumerate(urls)] + [(None, "http://a.b/c"), (700, None), (701, "no scheme"), (702, "://"),
                                                    (703, "http://"), (3, urls[3]), (704, "a://B://c/d")]
    outcomes = [(i, int(rng.random() < rate[split(u)[0]])) for i, u in enumerate(urls) if rng.random() < .6]
    outcomes += [(None, 1), (5, None), (7, 1), (7, 0)]
    p = spark.createDataFrame([(i, u, "v") for i, u in pages], "page_id bigint, url string, verdict string")
    o = spark.createDataFrame(outcomes, "page_id bigint, bad int")
    got = judge_urls(p, o, URL_RULES).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    got = sorted(((*r[:7], r["bad_lower"]) for r in got), key=key)
    want = sorted(brute(pages, outcomes, 0.5), key=key)
    assert [g[:7] for g in got] == [w[:7] for w in want]
    assert max(abs(g[7] - w[7]) for g, w in zip(got, want)) < 2e-6
    assert {g[4] for g in got} == {"allow", "block"}


def test_empty_tables(spark):
    p = spark.createDataFrame([(1, "http://a.com/x"), (2, "http://b.org/")], "page_id bigint, url string")
    o = spark.createDataFrame([], "page_id bigint, bad int")
    assert [(r["verdict"], r["rule"], r["n_labelled"]) for r in judge_urls(p, o, URL_RULES).orderBy("page_id").collect()] == \
        [("allow", "com/", 0), ("allow", None, 0)]
    assert judge_urls(p.limit(0), o, URL_RULES).count() == 0
