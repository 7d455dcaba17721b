"""The document operators against brute force, on odd rows and on sf0.001."""

import math
import os
import random
import sys
import zlib

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402
import cases  # noqa: E402

from payledger.llm import (decontaminate, language_id, lm_scoring, minhash_dedup, mixing, quality_rules, secret_scan,  # noqa: E402
                           substring_dedup)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", params=["odd", "sf0.001"])
def docs(request, spark):
    if request.param == "odd":
        df = spark.createDataFrame(cases.odd_documents(), cases.DOC_SCHEMA)
    else:
        df = spark.read.parquet(f"{SF}/documents.parquet")
    return df.cache()


@pytest.fixture(scope="module")
def texts(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def key(row):
    return tuple((x is None, x) for x in row)


def same(df, columns, expected):
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=key)
    assert got == sorted(expected, key=key)


def empty(spark):
    return spark.createDataFrame([], cases.DOC_SCHEMA)


def test_mixing(docs, spark):
    rows = [(r["doc_id"], r["source"], r["text"]) for r in docs.collect()]
    size, target = brute.targets(rows)
    for block, shard in ((mixing.BLOCK, mixing.SHARD), (16, 8)):
        got = mixing.mixed_words(docs, block, shard).collect()
        assert sorted((r["doc_id"] is None, r["doc_id"], r["size"]) for r in got) == sorted(
            (d is None, d, len(brute.words(t))) for d, _, t in rows)
        taken = {}
        for r in got:
            assert 0 <= r["taken"] <= 2 * r["size"]
            assert r["source_size"] == size[r["source"]]
            assert r["target"] == pytest.approx(target[r["source"]])
            taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        assert all(abs(taken[s] - target[s]) <= 1 for s in target)
        again = mixing.mixed_words(docs.repartition(3), block, shard).collect()
        order = lambda rs: sorted(tuple((x is None, x) for x in r) for r in rs)
        assert order(got) == order(again)


def test_permutation_is_a_bijection(spark):
    for n in (1, 2, 7, 256, 1000):
        df = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit(3), F.lit(1)).alias("p"))
        assert sorted(r["p"] for r in df.collect()) == list(range(n))


def test_decontamination(docs, texts, spark):
    bench = spark.createDataFrame(cases.odd_benchmark(), cases.BENCH_SCHEMA)
    bench = bench.unionByName(spark.read.parquet(f"{SF}/benchmark.parquet").withColumns({"doc_id": F.lit(1), "words": F.lit("w"), "h": F.lit(1)}))
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    expected = brute.contaminated(texts, items)
    same(decontaminate.contamination(docs, bench), columns, expected)
    kept = decontaminate.remove_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not r[5] for r in expected)
    same(decontaminate.contamination(docs, bench.limit(0)), columns, [(d, w, 0, 0, brute.sha(""), False) for d, w, *_ in expected])


def test_windows_meet_the_benchmark_by_hash_alone(spark):
    docs, bench = spark.createDataFrame(cases.odd_documents(), cases.DOC_SCHEMA), spark.createDataFrame(cases.odd_benchmark(), cases.BENCH_SCHEMA)
    plan = decontaminate.hits(docs, bench)._jdf.queryExecution().executedPlan().toString()
    keys = [line.split("BroadcastHashJoin [")[1].split("]")[0] for line in plan.splitlines() if "BroadcastHashJoin [" in line]
    assert keys and all("slice" not in k for k in keys)  # no words are copied into a key for every window


def test_decontamination_by_shuffle(docs, texts, spark, monkeypatch):
    bench = spark.createDataFrame(cases.odd_benchmark(), cases.BENCH_SCHEMA)
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    out = decontaminate.contamination(docs, bench)
    same(out, ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"], brute.contaminated(texts, items))


def test_windows_of_equal_hash_are_told_apart():
    import numpy as np
    import pandas as pd

    from payledger.llm import common

    h = common.WordHash().of([b"a%d" % i for i in range(60)])
    w, v = common.ngram_pairs(h, 50)
    assert len(w) == len(v) == 11 and not set(w.tolist()) & set(v.tolist())
    pairs = substring_dedup._distinct(np.append(w, w[:2]), np.append(v, [v[0], v[1] + np.uint64(1)]))
    assert len(pairs[0]) == 12
    text = " ".join(f"a{i}" for i in range(60))
    run = lambda check: next(substring_dedup._removed(50)(iter([pd.DataFrame({
        "ord": [1], "th": [1], "text": [text], "w": [w.view(np.int64)[:1]], "v": [check]})])))["n_removed"][0]
    assert run(v.view(np.int64)[:1]) == 50 and run(v.view(np.int64)[1:2]) == 0


def test_substring_dedup(docs, texts):
    out = substring_dedup.repeated_passages(docs, with_text=True)
    same(out, ["doc_id", "n_words", "n_removed", "kept_sha256"], brute.passages(texts))
    for r in out.where("kept_text IS NOT NULL").collect():
        assert brute.sha(r["kept_text"]) == r["kept_sha256"]


def test_secret_scan(docs, texts):
    out = secret_scan.scan(docs)
    same(out, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256"], brute.secrets(texts))
    for r in out.collect():
        spans = [s.split(":") for s in r["spans"].split(",")] if r["spans"] else []
        base = [s for s in spans if s[0] != "guess"]
        assert brute.sha(",".join(":".join(s) for s in base)) == r["base_sha256"]
        order = [(int(s[1]), secret_scan.KINDS.index(s[0])) for s in spans]
        assert order == sorted(order)
    clean = secret_scan.redact(docs)
    assert clean.columns == docs.columns and clean.count() == len(texts)
    left = secret_scan.scan(clean.select("doc_id", "text"))
    assert left.where("n_access > 0 OR n_hex > 0 OR n_assign > 0").count() == 0


def test_guess_cost():
    cost = secret_scan.guess_cost
    for easy in ("password1990", "qwertyuiop", "aaaaaaaaaaaa", "Summer2023", "p@ssword", "abcabcabcabc", "1990-12-31", "monkeydragon"):
        assert cost(easy) < secret_scan.GUESSES, easy
    for hard in ("zX9$kQ2!vR7#mT", "b7db7aa4a5fcc78305", "correcthorsebattery"):
        assert cost(hard) >= secret_scan.GUESSES, hard
    assert cost("") == 0
    # never dearer than brute force, and the cheapest of all segmentations of a short value
    assert cost("xqzjw") == pytest.approx(5 * math.log10(26))


def test_guess_cost_of_whole_values():
    """No step at any length, repeats of any length, walks off the row, reversed words."""
    cost = secret_scan.guess_cost
    rng = random.Random(5)
    hard = "".join(rng.choice("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789") for _ in range(300))
    along = [cost(hard[:n]) for n in range(1, 301)]
    assert max(b - a for a, b in zip(along, along[1:])) < 2 and along[-1] > 300 and along[70] > along[60]
    block = "Kd83-vQpz-71xW-mmBt"
    assert cost(block * 3) < cost(block) + 4 and cost(block + ":" + block) < cost(block) + 5
    for easy in ("1qaz2wsx", "zaq1xsw2", "drowssap1990", "nimda2024", "a" * 200_000):
        assert cost(easy) < secret_scan.GUESSES, easy


def test_guess_cost_is_the_least_of_all_segmentations():
    """Brute force over every way to cut short values, each piece judged on its own."""
    rng = random.Random(6)
    rows = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz")
    near = {x + y for r in rows for x, y in zip(r, r[1:])} | {x + y for up, low in zip(rows[:3], rows[1:4]) for x, y in zip(up, low)}
    near |= {x + y for up, low in zip(rows[:3], rows[1:4]) for x, y in zip(up[1:], low)}

    def size_of(c):
        return 10 if c.isdigit() else 26 if c.islower() or c.isupper() else 33

    def back(low, end):  # distance of the last three characters to where they stood last
        at = low.rfind(low[end - 3 : end], 0, end - 1) if end >= 3 else -1
        return end - 3 - at if at >= 0 else 0

    def piece(value, s, e):
        low, part, options = value.lower(), value[s:e], []
        if e - s == 1:
            options.append(size_of(part))
        lower = part.lower()
        plain = lower.translate(str.maketrans("@4310$5!7", "aaeiossit"))
        for guess, twist in ((plain, 1), (plain[::-1], 2)):
            if guess in secret_scan.WORDS and len(guess) > 1:
                options.append((secret_scan.WORDS.index(guess) + 1) * twist * (1 + (lower != plain)) * (1 + (part != lower)) + 1)
        if secret_scan.DATE.fullmatch(lower):
            options.append(10**2.2 if e - s == 4 else 10**4.6)
        if e - s >= 3:
            pairs = [low[i : i + 2] for i in range(s, e - 1)]
            if all(p in near or p[::-1] in near for p in pairs) and not (s and (low[s - 1 : s + 1] in near or low[s] + low[s - 1] in near)):
                options.append(200 * (e - s))
            if len(set(lower)) == 1 and not (s and low[s - 1] == low[s]):
                options.append(size_of(part[-1]) * (e - s))
            d = back(low, e)
            if d and s >= d and all(back(low, i) == d for i in range(s + 3, e + 1)) and back(low, s + 2) != d:
                options.append(2 * d * (e - s))
        return min(map(math.log10, options), default=math.inf)

    def least(value):
        for cuts in range(1 << (len(value) - 1)):
            at = [0, *(i + 1 for i in range(len(value) - 1) if cuts >> i & 1), len(value)]
            yield sum(costs[s, e] for s, e in zip(at, at[1:]))

    parts = ["pass", "Word", "ssap", "1990", "qaz", "asd", "aaa", "x9", "abcab", "!", "tset", "7", "w0rd"]
    for _ in range(60):
        value = "".join(rng.choice(parts) for _ in range(4))[:11]
        costs = {(s, e): piece(value, s, e) for s in range(len(value)) for e in range(s + 1, len(value) + 1)}
        assert secret_scan.guess_cost(value) == pytest.approx(min(least(value))), value


def test_near_duplicates(docs, texts):
    out = minhash_dedup.near_duplicates(docs)
    same(out, ["doc_id", "n_shingles", "component_id"], [r[:3] for r in brute.near(texts)])
    same(out.where("doc_id IS NOT NULL"), ["doc_id", "kept"], [(r[0], r[3]) for r in brute.near(texts) if r[0] is not None])
    assert minhash_dedup.keep_one(docs).columns == docs.columns


def test_near_duplicates_of_a_hub(spark):
    """Copies that are near the original but not each other: the links must not
    depend on which member a bucket compares with."""
    import random

    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    rows = []
    for i in range(60):
        w = list(base)
        for at in rng.sample(range(300), 6 if i % 2 else 9):
            w[at] = f"n{rng.randrange(10**6)}"
        rows.append((i + 1, " ".join(w)))
    rows.append((99, " ".join(base)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    same(minhash_dedup.near_duplicates(df), ["doc_id", "n_shingles", "component_id", "kept"], brute.near(rows))


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 300), (50, 50), (7, 7), (400, 300), (60, 61), (61, 60)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r["node"]: r["label"] for r in minhash_dedup.connected_components(df).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys((100, 200, 300, 400), 100), 60: 60, 61: 60}


def test_quality(docs, texts, spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = quality_rules.judge(docs, labels)
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    same(out, columns, brute.quality(texts))
    assert out.where("base_failed AND kept").count() == 0
    none = quality_rules.judge(docs, labels.limit(0))
    assert none.where("kept = base_failed").count() == 0


def test_boosted_trees():
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.random((3000, 4))
    y = ((x[:, 0] + 0.3 * np.sin(9 * x[:, 1]) + 0.1 * rng.normal(size=3000)) < 0.6).astype(float)
    model = quality_rules.Boosted(falling=(0,)).fit(x[:2000], y[:2000])
    p = model.predict(x[2000:])
    assert ((p > 0.5) == y[2000:]).mean() > 0.85
    grid = np.repeat(x[2000:2100], 50, axis=0)
    grid[:, 0] = np.tile(np.linspace(0, 1, 50), 100)
    assert (np.diff(model.predict(grid).reshape(100, 50), axis=1) <= 1e-12).all()
    flat = model.trees[0]
    by_hand = []
    for row in x[:50]:
        at = 0
        while flat[0][at] >= 0:
            at = flat[2][at] + int(row[flat[0][at]] > flat[1][at])
        by_hand.append(flat[3][at])
    assert np.allclose(by_hand, model._walk(flat, x[:50]))


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def test_language(docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
    got = language_id.predict(docs).collect()
    learned = {lang for d, t, lang in rows if lang and (d is None or crc(d) % 3 != 1)}
    letters = sorted(((d is None, d, any(c.isalpha() for c in t or "")) for d, t, _ in rows))
    assert sorted((r["doc_id"] is None, r["doc_id"], r["lang_pred"] != "und") for r in got) == letters
    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and crc(r["doc_id"]) % 3 == 1)
        assert r["lang_pred"] in learned | {"und"} and 0 <= r["score"] <= 1
        assert r["rejected"] or r["lang_pred"] != "und"
    assert language_id.keep_accepted(docs).columns == docs.columns


def test_language_is_brute_force(docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
    expected = sorted(brute.languages(rows, lambda d: d is not None and crc(d) % 3 == 1), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    got = sorted(map(tuple, language_id.predict(docs).select("doc_id", "lang_pred", "score", "rejected").collect()),
                 key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    for g, e in zip(got, expected, strict=True):
        assert g[:2] == e[:2] and abs(g[2] - e[2]) < 1e-4
        assert g[3] == (e[3] is None or e[2] < e[3]) or abs(e[2] - e[3]) < 1e-4


def test_language_rejects_strangers(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    odd = ["Привет, как дела сегодня в этом городе", "今天天气很好我们去公园散步", "xq zzkw vvqj kqxz wqkj zxqv jjkx qqwz"]
    more = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(odd)], "doc_id long, text string, lang string")
    got = language_id.predict(docs.union(more)).where("doc_id < 0").collect()
    assert len(got) == 3 and all(r["rejected"] for r in got)


def test_language_draws_copies_apart(spark):
    """A text that most rows hold takes no more of the sample than its share."""
    rows = [(i, "the river and the stone" if i % 2 else f"word number {i} of a row", "en") for i in range(4000)]
    rows += [(7, "the river and the stone", "en")] * 2000
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert language_id.fit(df, sample=100)["langs"] == ["en"]
    drawn = language_id.drawn(df, 100)
    assert 50 < drawn.count() < 160 and drawn.where("doc_id = 7").count() <= 1


def test_language_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.predict(docs).where("held_out").join(docs.select("doc_id", "lang", "text"), "doc_id")
    right = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.avg(F.col("rejected").cast("int"))).first()
    assert right[0] > 0.97 and right[1] < 0.01


def test_credential_contexts():
    """Real forms of credentials are found and masked, words round them are not."""
    value = "q8Zr!x7Lk2#"
    for before in ("DB_PASS=", "MYSQL_PWD=", "user_password: ", "aws_secret_access_key = ", "Authorization: Bearer ", "authorization: Basic ",
                   "AUTHORIZATION: token ", "auth: Bearer: ", "sent with bearer  ", "the PASSWORD IS ", "the password is ", "X-Api-Key: ", "pwd:\t", "bearer="):
        text = f"see {before}{value} and go"
        at = text.index(value)
        assert secret_scan.find_spans(text) == [(at, at + len(value), "guess")], before
        assert secret_scan.masked(text) == f"see {before}[REDACTED] and go"
    for plain in ("Authorization: Bearer", "the bearer remembers international law", "compass=" + value, "pwd: password1990", "password: Bearer", ""):
        assert secret_scan.find_spans(plain) == [], plain


def test_lm_scores(docs, texts):
    held = [d is not None and crc(d) % 10 == 0 for d, _ in texts]
    out = lm_scoring.score(docs, hot=50)  # most words take the join
    got = sorted((tuple(r) for r in out.collect()), key=key)
    expected = sorted(brute.unigram(texts, held), key=key)
    for g, e in zip(got, expected):
        assert g[:5] == e[:5]
        assert g[5] == pytest.approx(e[5], rel=1e-9)
        assert g[6] < 0
    assert len(got) == len(expected)


def test_lm_is_a_distribution_and_causal():
    import numpy as np

    w = lm_scoring.initial_weights(np.arange(lm_scoring.CLASSES, dtype=float))
    rng = np.random.default_rng(0)
    seq = rng.integers(0, lm_scoring.CLASSES, 150)

    def total(s):
        c, t, owner = lm_scoring.windows([s])
        return c, t, lm_scoring.log_probs(w, c, t)

    # probabilities of all next classes sum to one
    z = [10 ** total(np.append(seq[:40], k))[2].sum() / 10 ** total(seq[:40])[2].sum() for k in range(lm_scoring.CLASSES)]
    assert sum(z) == pytest.approx(1, abs=1e-3)
    # each token is scored once, and a window's score does not depend on what follows
    c, t, per = total(seq)
    assert (t != lm_scoring.PAD).sum() == len(seq)
    assert np.allclose(per[:2], total(np.append(seq[:64], rng.integers(0, 9, 50)))[2][:2], atol=1e-4)


def test_lm_gradient():
    import numpy as np

    rng = np.random.default_rng(2)
    w = {k: v.astype(np.float64) for k, v in lm_scoring.initial_weights(np.ones(lm_scoring.CLASSES)).items()}
    w["r"] = rng.normal(size=w["r"].shape)
    c, t, _ = lm_scoring.windows([rng.integers(0, 9, 70), rng.integers(0, 9, 20)])
    _, g = lm_scoring.gradients(w, c, t)
    for k in w:
        flat = np.argsort(-np.abs(g[k]).ravel())[:2]
        for i in flat:
            old, step = w[k].ravel()[i], 1e-5
            w[k].ravel()[i] = old + step
            up = lm_scoring.gradients(w, c, t)[0]
            w[k].ravel()[i] = old - step
            down = lm_scoring.gradients(w, c, t)[0]
            w[k].ravel()[i] = old
            assert (up - down) / (2 * step) == pytest.approx(g[k].ravel()[i], rel=2e-2, abs=1e-6), k


def test_lm_learns_context(spark):
    """On held-out texts the model beats the same class shares without context."""
    import numpy as np

    rng = np.random.default_rng(3)
    chain = [np.array([(7 * i + 3) % 20 for i in np.cumsum(rng.integers(0, 2, 200))]) for _ in range(40)]
    base = np.bincount(np.concatenate(chain), minlength=lm_scoring.CLASSES).astype(float)
    w0 = lm_scoring.initial_weights(base)
    w = w0
    for turn in range(20):  # a pass is 7 steps here
        w = lm_scoring.train(w, *lm_scoring.windows(chain[:30])[:2], seed=turn)
    c, t, _ = lm_scoring.windows(chain[30:])
    share = np.log10((base + 1) / (base + 1).sum())
    unigram = share[np.concatenate(chain[30:])].sum()
    assert lm_scoring.log_probs(w, c, t).sum() > unigram * 0.6


def test_lm_scores_ids():
    """Texts of one class sequence differ in context score, and the factored
    probabilities of all next ids sum to one."""
    import numpy as np

    bounds, counts = np.array([0, 1, 2, 10, 20, 21]), np.arange(21, 0, -1.0)
    rng = np.random.default_rng(4)
    w = lm_scoring.initial_weights(counts, bounds)
    w["y"] = rng.normal(size=w["y"].shape).astype(np.float32)

    def total(s):
        return lm_scoring.log_probs(w, *lm_scoring.windows([np.array(s)])[:2], bounds).sum()

    seq = [3, 0, 12, 5]
    assert sum(10 ** (total([*seq, k]) - total(seq)) for k in range(21)) == pytest.approx(1, abs=1e-4)
    after = [total([k, 0, 15]) - total([k]) for k in range(2, 10)]  # ids of one class
    assert np.ptp(after) > 1e-3
    ids = lm_scoring.class_bounds()
    assert len(ids) - 1 == lm_scoring.CLASSES and ids[-1] == lm_scoring.VOCABULARY and np.diff(ids).max() <= lm_scoring.SIZE

    w = {k: v.astype(np.float64) for k, v in w.items()}
    c, t, _ = lm_scoring.windows([rng.integers(0, 21, 70), rng.integers(0, 21, 20)])
    _, g = lm_scoring.gradients(w, c, t, bounds)
    for k in w:
        for i in np.argsort(-np.abs(g[k]).ravel())[:3]:
            old, step = w[k].ravel()[i], 1e-5
            w[k].ravel()[i] = old + step
            up = lm_scoring.gradients(w, c, t, bounds)[0]
            w[k].ravel()[i] = old - step
            down = lm_scoring.gradients(w, c, t, bounds)[0]
            w[k].ravel()[i] = old
            assert (up - down) / (2 * step) == pytest.approx(g[k].ravel()[i], rel=2e-2, abs=1e-6), k


def test_lm_classes_follow_counts():
    """Rare ids share large classes, so a token passes far fewer logits; nothing is left out."""
    import numpy as np

    n = lm_scoring.VOCABULARY
    counts = np.floor(1e6 / np.arange(1, n + 1) ** 1.6)
    fixed, by_count = lm_scoring.class_bounds(), lm_scoring.class_bounds(counts)
    assert by_count[0] == 0 and by_count[-1] == n and by_count[-2] == n - 1
    sizes = np.diff(by_count)
    assert (sizes[: lm_scoring.OWN] == 1).all() and (sizes[lm_scoring.OWN : -2] >= lm_scoring.SIZE).all()

    def logits(bounds):
        size = np.diff(bounds)
        return len(size) + (np.add.reduceat(counts, bounds[:-1]) * size)[size > 1].sum() / counts.sum()

    assert logits(by_count) < 0.7 * logits(fixed)
    w = lm_scoring.initial_weights(counts, by_count)
    first = np.concatenate([lm_scoring.log_probs(w, *lm_scoring.windows([np.array([k]) for k in range(i, min(i + 10_000, n))])[:2], by_count)
                            for i in range(0, n, 10_000)])
    assert (10**first).sum() == pytest.approx(1, abs=1e-3)


def test_lm_gradient_of_many_windows():
    """Windows that go through in several parts give the sum of their gradients, extreme logits included."""
    import numpy as np

    bounds, rng = np.array([0, 1, 2, 10, 20, 21]), np.random.default_rng(6)
    w = {k: v.astype(np.float64) for k, v in lm_scoring.initial_weights(np.arange(21, 0, -1.0), bounds).items()}
    w["y"], w["u"] = rng.normal(size=w["y"].shape), 30 * rng.normal(size=w["u"].shape)
    c, t, _ = lm_scoring.windows([rng.integers(0, 21, 700) for _ in range(4)])
    assert len(c) > 2 * lm_scoring.CHUNK
    loss, g = lm_scoring.gradients(w, c, t, bounds)
    each = [(int((t[i : i + 1] != lm_scoring.PAD).sum()), *lm_scoring.gradients(w, c[i : i + 1], t[i : i + 1], bounds)) for i in range(len(c))]
    n = sum(e[0] for e in each)
    assert loss == pytest.approx(sum(e[0] * e[1] for e in each) / n)
    for k in w:
        assert np.allclose(g[k], sum(e[0] * e[2][k] for e in each) / n, atol=1e-8), k


def test_lm_rate_falls():
    import numpy as np

    rng = np.random.default_rng(7)
    c, t, _ = lm_scoring.windows([rng.integers(0, 9, 2000)])
    w = lm_scoring.initial_weights(np.ones(lm_scoring.CLASSES))
    steps = []
    for tokens in (0, 2000):
        trainer = lm_scoring.Trainer(w, tokens=tokens)
        trainer.feed(c, t)
        before = trainer.w["q"].copy()
        trainer.feed(c[:32], t[:32])
        steps.append(np.abs(trainer.w["q"] - before).mean())
    assert steps[1] < 0.3 * steps[0]


def test_lm_learns_from_every_training_document(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(lm_scoring, "_round", lambda part, weights, tasks: seen.append(part.count()) or weights, raising=False)
    df = spark.read.parquet(f"{SF}/documents.parquet")
    lm_scoring.score(df).count()
    assert len(seen) == lm_scoring.ROUNDS and sum(seen) == sum(crc(r["doc_id"]) % 10 != 0 for r in df.select("doc_id").collect())


def test_lm_deals_copies_of_a_text_apart(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(lm_scoring, "_round", lambda part, weights, tasks: seen.extend(
        r["count"] for r in part.repartition(4, "order").groupBy(F.spark_partition_id()).count().collect()) or weights, raising=False)
    docs = spark.createDataFrame([(None, "one text")] * 1500 + [(11, "one text")] * 500, "doc_id long, text string")
    lm_scoring.score(docs).count()
    n = 1500 + 500 * (crc(11) % 10 != 0)
    assert sum(seen) == n and max(seen) < 1.5 * n / len(seen)


def test_empty_tables(spark):
    none, bench = empty(spark), spark.createDataFrame([], cases.BENCH_SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for out in (mixing.mixed_words(none), decontaminate.contamination(none, bench), substring_dedup.repeated_passages(none),
                secret_scan.scan(none), language_id.predict(none), minhash_dedup.near_duplicates(none), quality_rules.judge(none, labels),
                lm_scoring.score(none)):
        assert out.count() == 0


def test_all_null_rows(spark):
    rows = spark.createDataFrame([(None, None, None, None, None, None, None, None, None, None)] * 2, cases.DOC_SCHEMA)
    bench = spark.createDataFrame([(None, None, None, None, None)], cases.BENCH_SCHEMA)
    labels = spark.createDataFrame([(None, None, None)], "doc_id long, quality int, toxic int")
    for out in (mixing.mixed_words(rows), decontaminate.contamination(rows, bench), substring_dedup.repeated_passages(rows), secret_scan.scan(rows),
                language_id.predict(rows), minhash_dedup.near_duplicates(rows), quality_rules.judge(rows, labels), lm_scoring.score(rows)):
        assert out.count() == 2
