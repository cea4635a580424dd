"""URL filters, quality rules and decontamination against plain Python."""

import hashlib
import random
import re

from atollgrid.llm.decontamination import decontaminate
from atollgrid.llm.quality import host_rules
from atollgrid.llm.url_filters import RULES, url_verdicts


def stored(spark, tmp_path, rows, schema, name="t"):
    path = str(tmp_path / name)
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def test_urls(spark, tmp_path):
    rng = random.Random(3)
    hosts = [f"{a}{b}.{c}" for a in ("", "www.", "m.") for b in ("example", "other", "third") for c in ("com", "net", "org")]
    pages = []
    for i in range(300):
        links = "".join(f'<a href="https://{rng.choice(hosts)}/x">y</a>' for _ in range(rng.randint(0, 4)))
        pages.append((i, rng.choice(["http", "HTTPS"]) + "://" + rng.choice(hosts).upper() + rng.choice(["", "/", "/en/1", "/es/2?x=/fr/", "/fr/#a", "?q", "/x://y"]), links))
    got = {r["page_id"]: r for r in url_verdicts(stored(spark, tmp_path, pages, "page_id int, url string, html string")).collect()}

    def split(url):
        host, path = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url).groups()
        return host.lower(), path

    said, mass = {}, {"trust": {}, "distrust": {}}
    for i, url, _ in pages:
        host, path = split(url)
        fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        said[i] = max(fits, default=(0, None, None))[1:]
    by = {}
    for i, url, _ in pages:
        by.setdefault(split(url)[0], []).append(said[i][1])
    trust = {h: v.count("allow") / len(v) for h, v in by.items()}
    distrust = {h: v.count("block") / len(v) for h, v in by.items()}
    edges = {}
    for _, url, links in pages:
        for d in re.findall(r'href="https://([^/]*)/', links):
            if d != split(url)[0]:
                edges[split(url)[0], d] = edges.get((split(url)[0], d), 0) + 1
    for h in by:
        m = re.match(r"^[^.]+\.([^.]+\..+)$", h)
        if m:
            for e in ((h, m[1]), (m[1], h)):
                edges[e] = edges.get(e, 0) + 1

    def rank(seed, edges):
        total = {}
        for (s, _), w in edges.items():
            total[s] = total.get(s, 0) + w
        r = dict(seed)
        for _ in range(10):
            new = {h: 0.15 * v for h, v in seed.items()}
            for (s, d), w in edges.items():
                new[d] = new.get(d, 0) + 0.85 * w / total[s] * r.get(s, 0)
            r = new
        return r

    mass["trust"], mass["distrust"] = rank(trust, edges), rank(distrust, {(d, s): w for (s, d), w in edges.items()})
    for i, url, _ in pages:
        host, path = split(url)
        r = got[i]
        t, b = mass["trust"].get(host, 0), mass["distrust"].get(host, 0)
        assert (r["host"], r["path"], r["rule"]) == (host, path, said[i][0])
        assert abs(r["host_trust"] - t) < 1e-9 and abs(r["host_distrust"] - b) < 1e-9
        if said[i][1] or abs(b - t) > 1e-9:
            assert r["verdict"] == (said[i][1] or ("block" if b > t and b >= 0.05 else "allow"))


def test_quality(spark, tmp_path):
    rng = random.Random(5)
    docs = []
    for i in range(400):
        source = rng.choice(["good", "good", "bad", None, "few"]) if i < 390 else "few"
        n = rng.choice([3, 49, 50, 51, 200]) if source != "bad" else rng.choice([3, 10, 60])
        words = [rng.choice(["a", "b", "ça", "d#", "$e"] if rng.random() < 0.5 else [f"w{k}" for k in range(300)]) for _ in range(n)]
        text = "".join(w + rng.choice([" ", "\n", "\t ", "\x0b"]) for w in words)
        docs.append((i, rng.choice([text, text + "\n" + text]), source))
    got = {r["doc_id"]: r for r in host_rules(stored(spark, tmp_path, docs, "doc_id int, text string, source string")).collect()}
    stats = {}
    for i, text, source in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        rep = {p for k, g in enumerate(grams) if grams.count(g) > 1 for p in (k, k + 1, k + 2)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        r = got[i]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(rep))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        failed = len(w) < 50 or 100 * len(rep) > 50 * len(w)
        assert r["base_failed"] == failed
        stats.setdefault(source, []).append(failed)
    rates = [sum(v) / len(v) for v in stats.values()]
    m = sum(rates) / len(rates)
    v = sum((x - m) ** 2 for x in rates) / len(rates)
    k = min(1000.0, max(1.0, m * (1 - m) / v - 1))
    most = min(0.5, m + 3 * (m * (1 - m) / (k + 1)) ** 0.5)
    for i, _, source in docs:
        f = stats[source]
        rate = (sum(f) + m * k) / (len(f) + k)
        assert abs(got[i]["host_rate"] - rate) < 1e-9
        assert got[i]["kept"] == (not got[i]["base_failed"] and rate <= most + 1e-9)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))


def test_decontamination(spark, tmp_path):
    rng = random.Random(7)
    vocabulary = ["The", "of", "É", "x1", "zeta", "eta", "theta"]
    text = lambda n: rng.choice([" ", "-"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 5, 9, 10, 11, 25]))) for i in range(25)] + [(100, None), (101, "..."), (102, "of of of")]
    docs = []
    for i in range(150):
        t = text(rng.randint(0, 60))
        if rng.random() < 0.4:
            t += " " + rng.choice(items[:25])[1] + " " + text(3)
        docs.append((i // 2, t))
    got = sorted(map(tuple, decontaminate(stored(spark, tmp_path, docs, "doc_id int, text string"), stored(spark, tmp_path, items, "item_id int, text string", "i"), slop=1).drop("n_near", "near", "_rid").collect()))
    want = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for k, s in items:
            x = words(s)
            n = min(10, len(x))
            for a in range(len(x) - n + 1) if n else ():
                for b in range(len(w) - n + 1):
                    if w[b : b + n] == x[a : a + n]:
                        hit.update(range(b, b + n))
                        found.add(str(k))
        want.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    assert got == sorted(want)


def test_proximity(spark, tmp_path):
    item = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa")]
    docs = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (2, "alpha beta gamma delta and epsilon zeta eta theta iota kappa"), (3, "kappa alpha")]
    docs += [(9, "beta gamma delta epsilon zeta eta theta iota " * 3)]
    got = {r["doc_id"]: r for r in decontaminate(stored(spark, tmp_path, docs, "doc_id int, text string"), stored(spark, tmp_path, item, "item_id int, text string", "i")).collect()}
    assert got[1]["contaminated"] and got[1]["n_near"] == 0
    assert not got[2]["contaminated"] and got[2]["n_near"] == 1
    assert not got[3]["contaminated"] and got[3]["n_near"] == 0


def test_propagation_decides(spark, tmp_path):
    # bad.com's pages are blocked by a rule; farm.org links to it, good.org is linked by an allowed host
    rules = [("bad.com", "/", "block"), ("fine.com", "/", "allow")]
    pages = [(i, "http://bad.com/x", "") for i in range(4)] + [(10 + i, "http://farm.org/x", "<a href='https://bad.com/1'>x</a>" * 3) for i in range(4)]
    pages += [(20 + i, "http://fine.com/x", "<a href='https://good.org/1'>x</a><a href='https://bad.com/2'>x</a>") for i in range(4)] + [(30, "http://good.org/x", "")]
    docs = stored(spark, tmp_path, pages, "page_id int, url string, html string")
    said = {r["page_id"]: r["verdict"] for r in url_verdicts(docs, rules=rules).collect()}
    off = {r["page_id"]: r["verdict"] for r in url_verdicts(docs, rules=rules, rounds=0).collect()}
    assert [said[i] for i in (0, 10, 20, 30)] == ["block", "block", "allow", "allow"] and off[10] == "allow"
    assert sum(said[i] != off[i] for i in said) == 4


def test_host_verdict_decides(spark, tmp_path):
    clean = lambda i: " ".join(f"w{i}x{k}" for k in range(60))
    docs = [(h * 1000 + i, clean(i) if i % 10 else "too short", f"h{h}") for h in range(30) for i in range(40)]
    docs += [(50_000 + i, clean(i) if i % 2 else "too short", "spam") for i in range(40)]  # half of it fails: far off the others
    got = host_rules(stored(spark, tmp_path, docs, "doc_id int, text string, source string")).collect()
    gone = {r["doc_id"] for r in got if not r["kept"] and not r["base_failed"]}
    assert gone == {50_000 + i for i in range(40) if i % 2}
    off = host_rules(stored(spark, tmp_path, docs, "doc_id int, text string, source string", "u"), max_rate=1.0, tail=1e9).collect()
    assert not any(not r["kept"] and not r["base_failed"] for r in off)


def test_tied_rates_and_ranks(spark, tmp_path):
    docs = [(h * 100 + i, "short" if i < 5 else " ".join(f"w{k}" for k in range(60)), f"h{h}") for h in range(4) for i in range(10)]
    assert {r["host_rate"] for r in host_rules(stored(spark, tmp_path, docs, "doc_id int, text string, source string")).collect()} == {0.5}
    pages = [(1, "http://a.com/x", "<a href='//b.org/'>"), (2, "http://c.net/x", "<a href='//b.org/'>"), (3, "http://b.org/x", "")]
    got = {r["page_id"]: r for r in url_verdicts(stored(spark, tmp_path, pages, "page_id int, url string, html string", "p"), rules=[("a.com", "/", "allow"), ("c.net", "/", "block")], min_distrust=0.0).collect()}
    assert got[3]["verdict"] == "allow" and got[3]["host_distrust"] == 0
