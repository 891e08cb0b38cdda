"""A URL rule list of thousands: right verdicts, and few expressions run."""

import random
import re

from dealspark.llm import url_filter as U


def rule_list(rng):
    words = ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(2500)]
    rules = [U.site_rule(rng.choice(["allow", "block"]), f"{w}.example", rng.choice(["/", "/a/", "/a/b", "/news/x"])) for w in words]
    rules += [U.site_rule("block", f"shop.{w}.example", "/a/") for w in words[:500]]
    rules += [U.host_word_rule("block", w) for w in words[::4]]
    # Path patterns with a literal token, and one that every URL's token fetches.
    rules += [U.UrlRule(rf"/{w}-[0-9]+\.html$", (w, "html"), "block") for w in words[1::2]]
    rules.append(U.UrlRule(r"^[^/]*example/private", ("example", "private"), "block", "private"))
    return tuple(rules), words


def test_thousands_of_rules(spark):
    rng = random.Random(8)
    rules, words = rule_list(rng)
    urls = []
    for i in range(1500):
        host = rng.choice(["", "www.", "shop.", "x-"]) + rng.choice(words) + rng.choice([".example", "-bets.example", ".org"])
        path = rng.choice(["/", "/a/", "/a/bc", "/news/x1", f"/{rng.choice(words)}-{i}.html", "/private/1", "", "/n.html?q=1"])
        urls.append(f"https://{host}{path}")
    df = spark.createDataFrame(list(enumerate([*urls, None, "no scheme"])), "page_id long, url string")
    got = {r["page_id"]: r for r in U.judge(df, rules, tried="tried").collect()}
    compiled = [(re.compile(r.pattern), r) for r in rules]
    for i, url in enumerate(urls):
        host, path = re.match(r"https://([^/?#]*)([^?#]*)", url).groups()
        fits = [(r.name is not None, len(r.name or r.pattern), r.name or "", r.verdict) for p, r in compiled if p.search(host + path)]
        best = max(fits, default=(False, 0, "", U.DEFAULT))
        assert (got[i]["rule"] or "", got[i]["verdict"]) == (best[2], best[3]), url
    assert (got[1500]["verdict"], got[1500]["tried"], got[1501]["verdict"]) == (U.DEFAULT, 0, U.DEFAULT)
    tried = [r["tried"] for r in got.values()]
    assert len(rules) > 4500 and max(tried) < 30 and sum(tried) / len(tried) < 6
    assert sum(r["verdict"] == "block" for r in got.values()) > 200
