import pytest

from docketry.llm import url_filters as U


def verdicts(spark, urls, rules=None):
    df = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(urls)], "page_id long, url string, rule string, host string")
    rules = spark.createDataFrame(rules if rules is not None else U.RULES, "host string, path string, verdict string")
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in U.judge_urls(df, rules).collect()}


def test_cases(spark):
    urls = [
        "https://WWW.Example.ORG/es/1?q=/x", "http://a.example.org/en/12#t", "http://example.org/en/2", "http://notexample.org/es/1", "http://x.com/fr/", "http://x.com/fr", "http://x.com/de/9", "https://org/", "https://a.org", None, "", "no scheme/org/", "x://y://z.org/p", "http://é.COM/fr/É", "http://a.org:80/",
        "http://" + "a." * 500 + "com/de/" + "x" * 50_000,
    ]
    got = verdicts(spark, [*urls, urls[0]])
    assert got[0] == ("www.example.org", "/es/1", "example.org/es/", "block") == got[len(urls)]
    assert got[1][2:] == ("example.org/en/1", "block") and got[2][2:] == ("org/", "allow") and got[3][2:] == ("org/", "allow")
    assert got[4][2:] == ("com/fr/", "allow") and got[5][2:] == (None, "allow") and got[6][2:] == ("com/de/", "block") and got[7][2:] == ("org/", "allow")
    assert got[8] == ("a.org", "", None, "allow") and got[9] == ("", "", None, "allow") == got[10] == got[11]
    assert got[12][0] == "y:" and got[13][:2] == ("é.com", "/fr/É") and got[14][2] is None and got[15][2:] == ("com/de/", "block")


def test_precedence_and_empty(spark):
    rules = [("a.com", "/x", "block"), ("a.com", "/x", "allow"), ("com", "/x/yyyyyyyyyy", "allow"), (None, "/", "block"), ("b.com", "", "block")]
    got = verdicts(spark, ["http://a.com/x", "http://a.com/x/yyyyyyyyyyz", "http://b.com"], rules)
    assert got[0][3] == "block" and got[1][2] == "com/x/yyyyyyyyyy" and got[2][2:] == ("b.com", "block")
    assert verdicts(spark, [], rules) == {} and verdicts(spark, ["http://a.com/x"], [])[0][3] == "allow"


@pytest.mark.parametrize("n", [300])
def test_brute_force(spark, n):
    import random

    rng = random.Random(3)
    part = lambda: rng.choice(["a", "b", "ab"])
    rules = [(".".join(part() for _ in range(rng.randint(1, 3))), "/" + "".join(rng.choice("xy/") for _ in range(rng.randint(0, 3))), rng.choice(["allow", "block"])) for _ in range(30)]
    rules = list({(h, p): (h, p, v) for h, p, v in rules}.values())
    urls = [f"http://{'.'.join(part() for _ in range(rng.randint(1, 4)))}/{''.join(rng.choice('xy/') for _ in range(rng.randint(0, 5)))}" for _ in range(n)]
    got = verdicts(spark, urls, rules)
    for i, u in enumerate(urls):
        host, path = u[7:].split("/", 1)[0], "/" + u[7:].split("/", 1)[1]
        fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert got[i][2:] == (max(fit)[2:] if fit else (None, "allow")), u


def test_native_plan(spark, data):
    plan = U.op1_url_filters(spark, data)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "Cartesian" not in plan


def test_prefix_collisions_are_refused_by_the_digest(spark, monkeypatch):
    """With one hexadecimal digit, expressions meet many rules that they are not."""
    monkeypatch.setattr(U, "SHORT", 1)
    rules = [(f"h{i}.com", f"/{j}", "block") for i in range(20) for j in range(4)]
    got = verdicts(spark, [f"http://x.h{i}.com/{j}z" for i in range(30) for j in range(6)], rules)
    for k, (host, path, rule, _) in got.items():
        i, j = divmod(k, 6)
        assert rule == (f"h{i}.com/{j}" if i < 20 and j < 4 else None)
