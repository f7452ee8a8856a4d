import math
import zlib
from collections import Counter, defaultdict

import pytest

from sluiceway.llm import urls

SF = "/root/testdata/sf0.001"


def parts(url):
    if url is None or "://" not in url:
        return "", "", url or ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    tail = rest[cut:]
    end = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    return host, tail[:end], rest


def rule_for(host, path):
    fits = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def held(text):
    return zlib.crc32(text.encode()) % urls.HELD_OUT == 0


def brute(links):
    """(host, path, rule, verdict, score) of each link, by plain dictionaries."""
    order, judged = urls.ORDER, []
    counts = {"allow": [defaultdict(Counter) for _ in range(order + 1)], "block": [defaultdict(Counter) for _ in range(order + 1)]}
    letters = set()
    for link in links:
        host, path, text = parts(link)
        rule = rule_for(host, path)
        judged.append((host, path, rule, text))
        padded = urls.START * order + text + urls.END
        for i in range(order, len(padded)):
            letters.add(padded[i])
            if rule and not held(text):
                for k in range(order + 1):
                    counts[rule.verdict][k][padded[i - k : i]][padded[i]] += 1

    def chance(kind, padded, i):
        p = 1 / (len(letters) + 1)
        for k in range(order + 1):
            seen = counts[kind][k].get(padded[i - k : i])
            if seen:
                p = (seen[padded[i]] + len(seen) * p) / (sum(seen.values()) + len(seen))
        return p

    def score(text):
        padded = urls.START * order + text + urls.END
        spots = range(order, len(padded))
        return sum(math.log(chance("allow", padded, i) / chance("block", padded, i)) for i in spots) / len(spots)

    scores = [score(text) for *_, text in judged]
    steps = [math.floor(s / urls.STEP) for s in scores]
    judged_by_rule = [(b, r.verdict, held(t)) for b, (_, _, r, t) in zip(steps, judged) if r]
    known = [(b, v) for b, v, out in judged_by_rule if out]
    if len({v for _, v in known}) < 2:
        known = [(b, v) for b, v, _ in judged_by_rule]
    total = Counter(v for _, v in known)
    level = None
    if len(total) == 2:
        def gain(level):
            below = Counter(v for b, v in known if b < level)
            return below["block"] / total["block"] - below["allow"] / total["allow"]

        level = max({b for b, _ in known}, key=lambda b: (gain(b), -b))
    return [
        (h, p, r and r.name, r.verdict if r else "allow" if level is None or b >= level else "block", s)
        for (h, p, r, _), b, s in zip(judged, steps, scores)
    ]


def check(got, links):
    want = brute(links)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:4] == w[:4]
        assert g[4] == pytest.approx(w[4], abs=1e-9)


def test_query_gives_what_brute_force_gives(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r.page_id: tuple(r)[1:] for r in urls.op10_urls(spark, SF).collect()}
    check([got[k] for k in sorted(pages)], [pages[k] for k in sorted(pages)])


def test_edges(spark):
    links = [None, "", "no scheme", "http://A.ORG", "http://a.org/", "http://org/", "http://xorg/", "http://example.org/es/?q=/en/1",
             "http://example.org/es/?q=/en/1", "ftp://B.example.org/en/12#://x", "https://a.com/de/://z/fr/", "http://a.com?/fr/", "http://\u00e9.com/fr/\n" + "y" * 20000]
    rows = [(i, link, "clash") for i, link in enumerate(links)]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    got = sorted(urls.judged_urls(pages).collect())
    check([(r.host, r.path, r.rule, r.verdict, r.score) for r in got], links)
    assert urls.judged_urls(pages.limit(0)).count() == 0
    assert {r.verdict for r in urls.judged_urls(pages.limit(3)).collect()} == {"allow"}


def test_the_longest_rule_wins(spark):
    names = {u: rule_for(*parts(u)[:2]) for u in ("http://b.example.org/en/1", "http://b.example.org/en/2", "http://com/de/")}
    assert [r.name for r in names.values()] == ["example.org/en/1", "org/", "com/de/"]
