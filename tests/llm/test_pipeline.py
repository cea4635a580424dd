"""The pipeline's stages, one after the other, against a brute-force version of each."""

import random
import re

import corpus_pipeline
import pytest


def near(rows):
    """The smallest ids of the groups of five-word Jaccard 0.8 or more."""
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for w in (re.sub("[A-Z]", lambda m: m[0].lower(), t).split() for _, t in rows)]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= 0.8 * len(a | sets[j]) and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    return [r for i, r in enumerate(rows) if group[i] == i]


def cut(rows):
    """Texts without words of 51-word runs, and bytes of 400-byte strings, that another row has."""
    words, strings = {}, {}
    for i, t in rows:
        w = t.split()
        for k in range(len(w) - 50):
            words.setdefault(tuple(w[k : k + 51]), set()).add(i)
        b = t.encode()
        for k in range(len(b) - 399):
            strings.setdefault(b[k : k + 400], set()).add(i)
    out = []
    for i, t in rows:
        b = t.encode()
        gone = bytearray(len(b))
        at = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", b)]
        w = t.split()
        for k in range(len(w) - 50):
            if len(words[tuple(w[k : k + 51])]) > 1:
                gone[at[k][0] : at[k + 50][1]] = b"\1" * (at[k + 50][1] - at[k][0])
        for k in range(len(b) - 399):
            if len(strings[b[k : k + 400]]) > 1:
                gone[k : k + 400] = b"\1" * 400
        kept = "".join(b[m.start() : m.end()].decode("utf-8", "ignore") for m in re.finditer(rb"\0+", bytes(gone)))
        if kept.strip():
            out.append((i, kept))
    return out


def clean(rows, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    tests = set()
    for _, t in items:
        w = words(t)
        n = min(10, len(w))
        tests |= {tuple(w[k : k + n]) for k in range(len(w) - n + 1) if n}
    found = lambda w: any(tuple(w[k : k + n]) in tests for n in {len(t) for t in tests} for k in range(len(w) - n + 1))
    return [(i, t) for i, t in rows if not found(words(t))]


def test_against_brute_force(spark, tmp_path):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice(["ba", "né", "To", "ri", "su"]) for _ in range(rng.randint(1, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages, items = [text(60), text(51), text(50), "x" + "long" * 110], [(1, text(30)), (2, "one two three")]
    rows = []
    for i in range(40):
        parts = [text(rng.randint(60, 140))]
        if i % 4 == 0:
            parts.append(passages[i // 4 % 4])
        if i % 9 == 0:
            parts.append(rng.choice([items[0][1][:200], "ONE, two three"]))
        rows.append((i, " ".join([*parts, text(70)])))
    for i in range(40, 50):  # near copies
        w = rows[i - 40][1].split()
        w[rng.randrange(len(w))] = "changed"
        rows.append((i, " ".join(w)))
    whole = [(i, t, "aa", "s", len(t)) for i, t in rows] + [(90, "", "aa", "s", 0), (91, None, "aa", "s", None), (92, "12 34 !!", None, None, 8)]
    folder = str(tmp_path)
    spark.createDataFrame(whole, "doc_id int, text string, lang string, source string, n_chars int").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id int, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs, want = spark.read.parquet(f"{folder}/documents.parquet"), rows
    for (name, stage), plain in zip(corpus_pipeline.STAGES[:4], (lambda r: r, near, cut, lambda r: clean(r, items)), strict=True):
        stage(spark, docs, folder).write.parquet(f"{folder}/{name}")
        docs, want = spark.read.parquet(f"{folder}/{name}"), plain(want)
        assert sorted((r["doc_id"], r["text"], r["n_chars"]) for r in docs.collect()) == sorted((i, t, len(t)) for i, t in want), name
    assert 10 < len(want) < 40
    last = {r["doc_id"]: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert sorted(last) == sorted(i for i, _ in want)
    assert all(r["round_trip"] and len({tuple(s["ids"]) for s in r["samples"]}) == len(r["samples"]) == 2 for r in last.values())


@pytest.mark.parametrize("name", ["row_key", "_rid", "_row", "k", "t", "runs"])
def test_clashing_columns(spark, tmp_path, name):
    rows = [(1, "the same words here " * 30, "en", "a", 5), (1, "the same words here " * 30, "en", "a", 5), (2, "other words " * 40, "en", "a", 6)]
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(rows, f"doc_id int, text string, lang string, source string, `{name}` int").write.parquet(path)
    spark.createDataFrame([(1, "nothing of it")], "item_id int, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(path)
    for _, stage in corpus_pipeline.STAGES[:4]:
        got = stage(spark, docs, str(tmp_path))
        assert got.columns == docs.columns and {r[name] for r in got.collect()} <= {5, 6}
