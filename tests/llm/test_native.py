"""URL rules and licence scans: brute force, odd rows, and plans without Python."""

import itertools
import math
import random
import re
import textwrap
from collections import Counter

import pytest
from conftest import SMALL
from marquee.llm import license_scan as S
from marquee.llm import url_rules as U
from marquee.llm.common import table

ODD_URLS = [None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.COM/en/1", "http://example.com/en", "http://example.com/en/", "http://www.example.com/en/x?y#z",
            "http://a.www.example.com/en/", "http://notexample.com/en/", "http://x.net/es/1", "http://x.net?/es/", "http://net/fr/", "http://x.com:80/", "a://b://c.com/", "http://x.com\n/y", "http://ÉX.com/"]


def plain(url):
    m = re.search(r"://", url or "")
    if not m:
        return "", ""
    rest = url[m.end():]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    fits = [(len(h + p), h + p, v) for h, p, v in U.LISTED if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_hosts_paths_and_listed_rules(spark):
    pages = spark.createDataFrame([(k, u, "x", "y") for k, u in enumerate(ODD_URLS)] + [(0, ODD_URLS[0], "x", "y")], "page_id long, url string, host string, tokens string")
    none = spark.createDataFrame([], "tokens array<string>, confidence double, support double, index_token string")
    rows = U.judge_urls(pages, none).collect()
    assert len(rows) == len(ODD_URLS) + 1
    for r in rows:
        host, path = plain(ODD_URLS[r.page_id])
        rule, verdict = plain_rule(host, path)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow"), ODD_URLS[r.page_id]
    assert U.judge_urls(pages.limit(0), none).count() == 0


def test_mined_rules_equal_counting(spark):
    """Support, confidence and verdicts against plain counts."""
    urls = [(k, f"http://{'spam' if k % 4 == 0 else 'good'}.site{k % 7}.org/{'buy' if k % 2 else 'read'}/{k}") for k in range(200)]
    labels = spark.createDataFrame([(k, 0 if k % 4 == 0 or (k % 7 == 3 and k % 2) else 1, 0) for k, _ in urls] + [(None, 0, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    pages = spark.createDataFrame(urls + [(None, None)], "page_id long, url string")
    labelled = U.labelled_urls(pages, labels)
    rows = [(frozenset(r.tokens), r.blocked) for r in labelled.collect()]
    rules = U.mine_rules(labelled, min_support=0.02, min_confidence=0.7)
    found = {frozenset(r.tokens): r for r in rules.collect()}
    assert frozenset(["h:spam"]) in found
    for tokens, r in found.items():
        n = [b for t, b in rows if tokens <= t]
        assert r.confidence == pytest.approx(sum(n) / len(n)) and r.confidence >= 0.7 and r.support == pytest.approx(sum(n) / len(rows)) and r.index_token in tokens
        assert not any(o < tokens and found[o].confidence >= r.confidence for o in found)
    judged = sorted(map(tuple, U.judge_urls(pages, rules, listed=()).collect()), key=repr)
    assert judged == sorted(map(tuple, U.judge_urls(pages, rules, listed=(), map_rules=0).collect()), key=repr)
    for r in U.judge_urls(pages, rules, listed=()).collect():
        tokens = next((set(x.t) for x in pages.where(pages.page_id.eqNullSafe(r.page_id)).select(U.tokens_of(pages.url).alias("t")).collect()))
        sure = [o.confidence for t, o in found.items() if t <= tokens]
        assert (r.verdict, r.confidence) == (("block", max(sure)) if sure else ("allow", None))


def plain_rules(rows, least, confidence, most_tokens=3):
    """All rules by counting every combination: those surer than chance, without those that a smaller one implies."""
    total, blocked = len(rows), sum(b for _, b in rows)
    freq = Counter(t for tokens, _ in rows for t in tokens)
    kept = {t for t, c in freq.items() if least <= c <= U.COMMON * total}
    # tokens of the same pages count as the first of them
    pages = {t: frozenset(k for k, (tokens, _) in enumerate(rows) if t in tokens) for t in kept}
    name = {t: min(u for u in kept if pages[u] == pages[t]) for t in kept}
    sets, both = Counter(), Counter()
    for tokens, b in rows:
        own = sorted({name[t] for t in tokens if t in kept})
        for size in range(1, most_tokens + 1):
            for x in itertools.combinations(own, size):
                sets[x] += 1
                both[x] += b
    sets = {x: n for x, n in sets.items() if n >= least}
    bound, p = 2 * math.log(max(2, len(sets))) + 4, blocked / total

    def ratio(k, n):
        part = lambda k, n, p: k * math.log(k / (n * p)) if k > 0 else 0.0
        return 2 * (part(k, n, p) + part(n - k, n, 1 - p) + part(blocked - k, total - n, p) + part(total - n - blocked + k, total - n, 1 - p))

    found = {x: both[x] / n for x, n in sets.items() if both[x] >= least and both[x] / n >= confidence and both[x] / n > p and ratio(both[x], n) >= bound}
    found = {x: c for x, c in found.items() if not any(set(o) < set(x) and found[o] >= c for o in found)}
    return found | {(t,): found[name[t],] for t in kept if (name[t],) in found}


def test_no_rule_is_missing(spark):
    rng = random.Random(6)
    words = [f"t{k}" for k in range(12)]
    rows = []
    for k in range(400):
        tokens = set(rng.sample(words, rng.randint(1, 5))) | ({"x", "y"} if rng.random() < 0.2 else set())
        bad = ("t1" in tokens and "t2" in tokens) or ("x" in tokens and rng.random() < 0.9) or rng.random() < 0.15
        rows.append((frozenset(tokens | {"everywhere"}), bad))
    labelled = spark.createDataFrame([(sorted(t), b, 7919 * k) for k, (t, b) in enumerate(rows)], "tokens array<string>, blocked boolean, page long")
    for least, confidence in ((5, 0.6), (20, 0.5)):
        got = {tuple(r.tokens): r.confidence for r in U.mine_rules(labelled, least / 400, confidence).collect()}
        want = plain_rules(rows, least, confidence)
        assert got == pytest.approx(want) and ("t1", "t2") in got and ("x",) in got and ("y",) in got


def test_long_urls_that_repeat_end_soon(spark):
    """Many tokens that always come together are one item, not all subsets of them."""
    many = [f"z{k:02d}" for k in range(60)]
    rows = [(["a", "b"], k % 2 == 0, k) for k in range(100)] + [(many, True, 1000 + k) for k in range(12)]
    labelled = spark.createDataFrame(rows, "tokens array<string>, blocked boolean, page long")
    rules = U.mine_rules(labelled).collect()
    assert sorted(t for r in rules for t in r.tokens) == many and all(r.confidence == 1 for r in rules)
    few = spark.createDataFrame([(many, True, 2000 + k) for k in range(2)] + rows[:100], "tokens array<string>, blocked boolean, page long")
    assert U.mine_rules(few).count() == 0  # two pages are no evidence


def test_rules_hold_on_pages_they_were_not_mined_from(spark):
    """Blocked pages of the other half are bad more often than all of that half."""
    folder = SMALL.replace("sf0.001", "sf0.1")
    pages, labels = table(spark, folder, "pages", "page_id", "url"), table(spark, folder, "labels", "doc_id", "quality", "toxic")
    rules = U.mine_rules(U.labelled_urls(pages, labels).where("page % 2 = 0"))
    other = U.labelled_urls(pages, labels).where("page % 2 != 0")
    hits = other.crossJoin(rules.select(rules.tokens.alias("left"))).where("size(array_except(left, tokens)) = 0").select("page", "blocked").distinct()
    base, found = other.selectExpr("avg(int(blocked))").first()[0], hits.selectExpr("count(*) n", "avg(int(blocked)) share").first()
    assert found.n == 0 or found.share > base


def test_support_and_confidence_count_pages(spark):
    """A host with 39 of 40 pages blocked, whose pages differ in their numbers alone; copies of a URL count once."""
    urls = [f"http://{'bad' if k < 40 else 'fine'}.org/page/{k}" for k in range(80)]
    pages = spark.createDataFrame([*enumerate(urls), *[(100 + k, urls[39]) for k in range(50)]], "page_id long, url string")
    labels = spark.createDataFrame([(k, int(k >= 39), 0) for k in range(80)], "doc_id long, quality int, toxic int")
    labelled = U.labelled_urls(pages, labels)
    assert labelled.count() == 80
    (rule,) = U.mine_rules(labelled).collect()
    assert (rule.tokens, rule.confidence, rule.support) == (["h:bad"], pytest.approx(39 / 40), pytest.approx(39 / 80))
    verdicts = {r.page_id: r.verdict for r in U.judge_urls(pages, U.mine_rules(labelled), listed=()).collect()}
    assert all(verdicts[k] == ("block" if k < 40 or k >= 100 else "allow") for k in verdicts)


def test_url_query(spark):
    pages = {r.page_id: r.url for r in table(spark, SMALL, "pages", "page_id", "url").collect()}
    rows = U.op3(spark, SMALL).collect()
    assert {r.page_id for r in rows} == set(pages)
    for r in rows:
        rule, verdict = plain_rule(*plain(pages[r.page_id]))
        assert (r.host, r.path) == plain(pages[r.page_id]) and r.rule == rule and (verdict is None or r.verdict == verdict)
        assert r.verdict in ("allow", "block")


def plain_scan(text, templates=S.TEMPLATES):
    """Every window of a template's word count, from every place that has one of its bigrams."""
    w = re.sub(r"[\W_]+", " ", (text or "").lower()).split()
    best, names = None, set()
    for name, template in templates:
        m, t = len(S.template_words(template)), {tuple(x.split(" ")) for x in S.template_bigrams(template)}
        for at in range(len(w) - 1):
            if (w[at], w[at + 1]) in t:
                part = w[at : at + m]
                g = set(zip(part, part[1:]))
                dice = 2 * len(g & t) / (len(g) + len(t))
                if dice >= S.MIN_DICE:
                    names.add(name)
                    best = max(best or (0, "", 0), (dice, name, -at))
    return (best[1], best[0], -best[2], ",".join(sorted(names))) if best else (None, None, None, "")


def test_scans_equal_brute_force(spark, make_docs, odd, no_docs):
    notice = S.TEMPLATES[0][1]
    mit = max((t for n, t in S.TEMPLATES if n == "MIT"), key=len)
    rng = random.Random(4)
    texts = [notice, notice.upper() + "!!", "x\n" + notice + "\ny", mit.replace(", ", ",\n"), "released under MIT licence", "Released under the MIT License. and more words here that do not match it",
             "Released under the MIT License.\nLicensed under CC BY 4.0.", "released released released", "of the of the in the software the software", *[t for _, t in S.TEMPLATES]]
    for _ in range(30):  # templates with words lost, changed and added, amid other words and other templates
        w = S.template_words(rng.choice(S.TEMPLATES)[1])
        w = [x if rng.random() > 0.08 else rng.choice(["", "other", x + " " + x]) for x in w]
        texts.append(" ".join(["some words"] * rng.randint(0, 5) + w + ["the software is"] * rng.randint(0, 5) + S.template_words(rng.choice(S.TEMPLATES)[1])[: rng.randint(0, 40)]))
    for docs in (make_docs([*enumerate(texts)]), odd, no_docs):
        want = sorted(((r.doc_id, *plain_scan(r.text)) for r in docs.select("doc_id", "text").collect()), key=repr)
        got = sorted((tuple(r) for r in S.scan_licenses(docs).collect()), key=repr)
        assert [(g[0], g[1], g[3], g[4]) for g in got] == [(w[0], w[1], w[3], w[4]) for w in want]
        assert [g[2] for g in got] == pytest.approx([w[2] for w in want])


def wrapped(text, width, mark):
    return "\n".join(mark + line for line in textwrap.wrap(text, width))


def test_licences_inside_longer_texts(make_docs):
    """Wrapped, behind comment marks, above code, amid a line."""
    code = "\n".join(f"int f{k}(int x) {{ return x + {k}; }}" for k in range(40))
    mit = max((t for n, t in S.TEMPLATES if n == "MIT"), key=len)
    bsd = max((t for n, t in S.TEMPLATES if n == "BSD-2-Clause"), key=len)
    apache = max((t for n, t in S.TEMPLATES if n == "Apache-2.0" and t.startswith("Licensed")), key=len)
    texts = [wrapped(mit, 80, " * ") + "\n" + code, wrapped(apache, 72, "# ") + "\n" + code, code + "\n// " + bsd + "\n" + code, "It is all there. Released under the MIT License. Use it as you like, with or without much thought about it.", code]
    got = {r.doc_id: r.license for r in S.scan_licenses(make_docs([*enumerate(texts)])).collect()}
    assert got == {0: "MIT", 1: "Apache-2.0", 2: "BSD-2-Clause", 3: "MIT", 4: None}


def test_templates_of_a_folder(spark, make_docs, tmp_path):
    body = " ".join(f"clause{k} says thing{k % 9}" for k in range(900))
    (tmp_path / "Own-1.0.txt").write_text(body)
    templates = S.templates_from(spark, str(tmp_path))
    assert templates == (("Own-1.0", body),)
    got = {r.doc_id: (r.license, r.start) for r in S.scan_licenses(make_docs([(1, "before it " + body + " after"), (2, "clause1 says no")]), templates).collect()}
    assert got == {1: ("Own-1.0", 2), 2: (None, None)}


def test_bounds_lose_nothing():
    """Any set that reaches the least Dice value shares enough bigrams, and so one of the anchors."""
    for size in range(1, 60):
        need = S.least_shared(size)
        for n in range(1, 200):
            for c in range(1, min(n, size) + 1):
                assert 2 * c < S.MIN_DICE * (n + size) or c >= need
        assert len(S.anchors([f"a{k} b" for k in range(size)])) == size - need + 1


def test_plans_have_no_python(spark):
    for query in (U.op3, S.op10):
        plan = query(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas|Cartesian|BroadcastNestedLoop", plan)
