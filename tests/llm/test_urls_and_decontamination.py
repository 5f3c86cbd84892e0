from factloom.llm import decontamination, urls
from tests.llm.frames import awkward, docs, prose

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/es", "allow")]


def slow(url):
    at = -1 if url is None else url.find("://")
    if at < 0:
        return "", "", None, "allow"
    rest = url[at + 3 :]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [r for r in RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


def test_urls_match_brute_force(spark):
    cases = [
        None, "", "no scheme", "http://", "http://A.Example.COM/en/x?y#z", "https://www.example.com/en/", "x://www.example.com/en",
        "http://example.net/es/1", "http://example.net/esx", "http://net?/es/", "http://com", "http://com/", "http://notcom/", "a://b://c.com/d",
        "http://" + "a." * 500 + "com/" + "p/" * 2000, "http://ÉCOM.com/é", "http://x.com\n/y", "http://www.example.com/en/",
    ]
    frame = spark.createDataFrame([(i, u, "r", "v") for i, u in enumerate(cases)], "page_id long, url string, rule string, host string")
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.filter_urls(frame, rules).collect()}
    assert got == {i: slow(u) for i, u in enumerate(cases)}
    assert {r.verdict for r in urls.filter_urls(frame, rules.where("false"), default="block").collect()} == {"block"}
    assert urls.filter_urls(frame.where("false"), rules).count() == 0


def test_the_rules_join_without_a_broadcast_too(spark, monkeypatch):
    monkeypatch.setattr(urls, "BROADCAST_RULES", 0)
    frame = spark.createDataFrame([(1, "http://a.example.com/en/")], "page_id long, url string")
    assert urls.filter_urls(frame, spark.createDataFrame(RULES, "host string, path string, action string")).first().rule == "example.com/en/"


def shingles(text):
    words = (text or "").lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_contamination_matches_brute_force(spark):
    items = [prose(50 + n, 10 + 7 * n) for n in range(8)] + ["three little words", "", None]
    texts = [None, "", "Three Little words", "three little words more"]
    for n, item in enumerate(items[:8]):
        words = item.split()
        texts.append(prose(n, 300) + " " + item.upper() + " " + prose(n + 1, 200))
        texts.append(prose(n, 90) + " " + " ".join(words[: int(0.9 * len(words))]) + " x")
        texts.append(" ".join(words[: len(words) // 2]) + " " + prose(n, 50))
        texts.append(" ".join(w if i != len(words) // 2 else "changed" for i, w in enumerate(words)))
    frame = docs(spark, texts).unionByName(docs(spark, [texts[4]], [4]))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    expected = set()
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            wanted, held = shingles(item), shingles(text)
            if wanted and len(wanted & held) >= 0.8 * len(wanted) - 1e-9:
                expected.add((d, i, len(wanted), len(wanted & held)))
    got = decontamination.contaminated(frame, bench).collect()
    assert len(got) == len(expected) and {tuple(r)[:4] for r in got} == expected


def test_contamination_of_awkward_rows(spark):
    bench = spark.createDataFrame([(0, prose(2, 40)), (1, "word"), (None, "two words")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(awkward(spark), bench).collect()}
    assert got == {(7, 0), (8, 0), (3, 1), (4, None)}
    assert decontamination.contaminated(docs(spark, []), bench).count() == 0
    assert decontamination.contaminated(awkward(spark), bench.where("false")).count() == 0
