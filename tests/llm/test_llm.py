"""Operators of gleaner.llm on small tables: brute force, exact round trips, odd rows."""

from __future__ import annotations

import collections
import hashlib
import io
import math
import pathlib
import random
import struct
import zipfile
import zlib

import numpy as np
import pytest
from gleaner.llm import compression_score, mixing, nearest, ngram_join, piece_encoding, preference, quality_rules, registry, toxicity, warc, weak_labels
from pyspark.accumulators import AccumulatorParam
from pyspark.sql import functions as F

from tests.helpers import database, rows

DOCS = "doc_id long, text string, lang string, source string"


def words(text):
    return (text or "").encode().lower().split()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and few-word texts."""
    long = " ".join(f"w{i % 700}" for i in range(6000))
    data = [(1, None, "en", "a"), (2, "", "en", None), (3, " \n\t ", None, "a"), (4, "one two", "en", "b"), (4, "one two", "en", "b"), (None, "alpha beta gamma delta epsilon zeta", "en", "b"), (5, long, "en", "c"), (6, long + " end", "en", "c")]
    return spark.createDataFrame(data, DOCS)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# -- WARC ----------------------------------------------------------------------------------------------------------
def test_warc_equals_sql(spark, sf_dir):
    got = registry.op1_warc(spark, sf_dir).toPandas()
    assert rows(got) == rows(database(sf_dir).sql(registry.OP1_SQL).df())


def test_warc_round_trip(spark):
    big = "x" * 1500
    data = [(1, "http://a", big), (2, None, big), (3, "http://c\r\nd", "small"), (4, "http://d", "small"), (None, "http://e", big), (5, "http://f", None), (2, None, big)]
    pages = spark.createDataFrame(data, "record_id long, url string, html string").select("record_id", "url", F.col("html").cast("binary").alias("payload"))
    manifest = warc.write_packages(warc.plan_revisits(pages), package_bytes=300)
    assert manifest.count() > 1
    found = warc.read_records(manifest, split_bytes=200).collect()
    assert len(found) == len(data)
    for r in found:
        want = {1: big, 2: big, 3: "small", 4: "small", 5: "", None: big}[int(r["record_id"]) if r["record_id"] else None]
        assert r["payload_bytes"] == len(want) and r["payload_digest"] == hashlib.sha1(want.encode()).hexdigest()
        if r["record_type"] == "response":
            assert bytes(r["payload"]).decode() == want
    kinds = collections.Counter((r["record_id"], r["record_type"], r["refers_to"]) for r in found)
    assert kinds[("1", "revisit", "2")] == 1 and kinds[("2", "response", None)] == 2 and kinds[("", "revisit", "2")] == 1 and kinds[("3", "response", None)] == 1
    empty = warc.write_packages(warc.plan_revisits(pages.limit(0)))
    assert warc.read_records(empty).count() == 0


def test_warc_of_many_records_in_a_split_and_a_long_page(spark):
    data = [(i, f"http://a/{i}", ("y" * (i % 50) + str(i)).encode()) for i in range(3000)] + [(5000, None, b"z" * 3_000_000)]
    pages = spark.createDataFrame(data, "record_id long, url string, payload binary").withColumn("digest", F.lit("clash")).repartition(3)
    manifest = warc.write_packages(warc.plan_revisits(pages))
    splits = warc.find_splits(manifest).collect()
    assert max(len(r["lengths"]) for r in splits) > 500
    found = {int(r["record_id"]): bytes(r["payload"]) for r in warc.read_records(manifest).collect()}
    assert found == {i: payload for i, _, payload in data}
    cut = warc.find_splits(manifest, split_bytes=1).collect()
    assert len(cut) == len(data)
    assert warc.read_records(manifest, split_bytes=10_000)._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM") == 1


def test_zip64_directory():
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_STORED) as z:
        with z.open(zipfile.ZipInfo("a"), "w", force_zip64=True) as f:
            f.write(b"hello")
        z.writestr("b", b"there")
    plain = raw.getvalue()
    end = plain.rfind(b"PK\x05\x06")
    count, length, begin = struct.unpack_from("<HII", plain, end + 10)
    record = b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, count, count, length, begin)
    locator = b"PK\x06\x07" + struct.pack("<IQI", 0, end, 1)
    saturated = plain[:end] + record + locator + plain[end : end + 8] + struct.pack("<HHII", 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF) + plain[end + 20 :]
    for data in (plain, saturated):
        file = io.BytesIO(data)
        members = warc.read_directory(file, len(data))
        assert [m.name for m in members] == ["a", "b"]
        for m, want in zip(members, (b"hello", b"there"), strict=True):
            at = warc.data_begin(file, m)
            assert data[at : at + m.size] == want
    with pytest.raises(ValueError):
        warc.read_directory(io.BytesIO(b"nothing"), 7)


# -- quality classifier --------------------------------------------------------------------------------------------
def test_label_model_finds_accuracies():
    rng = np.random.default_rng(1)
    truth = rng.random(20000) < 0.6
    accuracy = np.array([0.9, 0.8, 0.7, 0.85])
    votes = np.where(rng.random((20000, 4)) < accuracy, truth[:, None], ~truth[:, None]).astype(float)
    votes[rng.random((20000, 4)) < 0.2] = np.nan
    model = weak_labels.fit_label_model(votes, np.ones(20000))
    assert abs(model.good - 0.6) < 0.05 and np.abs(model.on_good - accuracy).max() < 0.05
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.9


def test_classifier_on_labels(spark, sf_dir, docs):
    scored = weak_labels.classify(docs.select("doc_id", "text")).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").toPandas()
    assert (scored["good"] == (scored["quality"] == 1)).mean() > 0.85


def brute_label_model(rows_, rounds=100):
    """Expectation-maximisation row by row."""
    k = len(rows_[0])
    good, on_good, on_bad = 0.7, [0.8] * k, [0.3] * k
    for _ in range(rounds):
        posterior = []
        for votes in rows_:
            a, b = good, 1 - good
            for j, v in enumerate(votes):
                if v is not None:
                    a, b = a * (on_good[j] if v else 1 - on_good[j]), b * (on_bad[j] if v else 1 - on_bad[j])
            posterior.append(a / (a + b))
        rate = lambda j, w, ones, all_: (sum(x for x, r in zip(w, rows_, strict=True) if r[j] == 1) + ones) / (sum(x for x, r in zip(w, rows_, strict=True) if r[j] is not None) + all_)
        new_good = [min(max(rate(j, posterior, 4, 5), 0.01), 0.99) for j in range(k)]
        new_bad = [min(max(rate(j, [1 - x for x in posterior], 1, 5), 0.01), 0.99) for j in range(k)]
        good = min(max((sum(posterior) + 1) / (len(rows_) + 2), 0.02), 0.98)
        step = max(abs(a - b) for a, b in zip(new_good + new_bad, on_good + on_bad, strict=True))
        on_good, on_bad = new_good, new_bad
        if step < 1e-6:
            break
    return good, on_good, on_bad


def test_label_model_equals_brute_force():
    rng = random.Random(11)
    rows_ = [tuple(rng.choice([0, 1, 1, None]) if rng.random() < 0.3 else int(rng.random() < 0.8) for _ in range(4)) for _ in range(300)]
    patterns = collections.Counter(rows_)
    votes = np.array([[np.nan if v is None else v for v in p] for p in patterns], dtype=float)
    model = weak_labels.fit_label_model(votes, np.array(list(patterns.values()), dtype=float))
    good, on_good, on_bad = brute_label_model(rows_)
    assert math.isclose(model.good, good, abs_tol=1e-4) and np.allclose(model.on_good, on_good, atol=1e-4) and np.allclose(model.on_bad, on_bad, atol=1e-4)


def test_scorer_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(weak_labels, "STEPS", 6)
    rng = random.Random(12)
    data = [(" ".join(rng.choice("good fine text bad junk 1234 ##".split()) for _ in range(rng.randint(0, 30))), rng.random()) for _ in range(80)]
    found = weak_labels.train_scorer(spark.createDataFrame(data, "text string, posterior double"))
    x, y = np.zeros((80, weak_labels.BUCKETS)), np.array([p for _, p in data])
    for row, (text, _) in zip(x, data, strict=True):
        at, value = weak_labels.features(text)
        row[at] = value
    w, speed = np.zeros(weak_labels.BUCKETS), 0
    for _ in range(weak_labels.STEPS):
        g = x.T @ (1 / (1 + np.exp(-x @ w)) - y) / 80 + weak_labels.RIDGE * w
        speed = 0.8 * speed - weak_labels.RATE * 8 * g
        w = w + speed
    assert np.allclose(found, w, atol=1e-4)


def test_classifier_with_a_hot_text(spark):
    rng = random.Random(13)
    data = [(i, "same text again and again") for i in range(400)] + [(1000 + i, " ".join(rng.choice("the cat sat on a mat 77 ## zzz".split()) for _ in range(rng.randint(1, 90)))) for i in range(300)]
    for hot in (None, "same text again and again"):
        frame = spark.createDataFrame([(i, hot if i < 1000 else t) for i, t in data], "doc_id long, text string")
        found = weak_labels.classify(frame, fit_rows=200).collect()
        assert len(found) == 700 and len({round(r["score"], 6) for r in found}) > 100


def test_classifier_on_odd_rows(spark, odd):
    clash = odd.withColumn("score", F.lit("clash")).withColumn("_text", F.lit("mine")).withColumn("_row", F.lit(1))
    frame = weak_labels.classify(clash)
    assert frame.columns == ["doc_id", "text", "lang", "source", "_text", "_row", "n_votes", "posterior", "score", "good"]
    found = frame.collect()
    assert len(found) == 8 and all(0 <= r["score"] <= 1 and r["_text"] == "mine" for r in found)
    assert weak_labels.classify(odd.limit(0)).count() == 0


# -- toxicity ------------------------------------------------------------------------------------------------------
def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(3)
    plain = [f"w{k}" for k in range(300)]
    data, labels = [], []
    for i in range(1200):
        text = [rng.choice(plain) for _ in range(rng.randint(5, 80))]
        bad = i % 5 == 0
        if bad:
            for _ in range(2):
                text.insert(rng.randrange(len(text)), rng.choice(["vile", "awful", "nasty"]))
        data.append((i, " ".join(text)))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    fitted = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    found = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, fitted).collect()}
    held = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(found[i] >= toxicity.THRESHOLD) == bool(y) for i, y in held]) > 0.97


TOXIC_ROWS = [("a b a b c", 0, 0), ("a c c d", 0, 1), ("x a b x y", 1, 0), ("x y x a", 1, 1)]


def test_kneser_ney_sums_to_one(spark):
    counted = toxicity.count_bigrams(spark.createDataFrame(TOXIC_ROWS * 6, "text string, toxic int, half int"))
    model = counted.model("ab")
    assert np.allclose(model.p.sum(axis=1), 1)
    size = model.p.shape[1]
    for c in (0, 1):
        for v in range(size - 1):
            if model.total[c][v] > 0:
                kept = model.kept[c][model.pairs // size == v].sum() / model.total[c][v]
                assert math.isclose(kept + model.rest[c][v], 1, abs_tol=1e-6)


def brute_ratios(rows_, text):
    """log p(w | v, toxic) - log p(w | v, ordinary) in dictionaries."""
    count = [collections.Counter(), collections.Counter()]
    for t, y, _ in rows_:
        w = t.split()
        count[y].update(zip(["", *w], w, strict=False))
    both = count[0] + count[1]
    vocabulary = {""} | {w for _, w in both}
    size = len(vocabulary) + 1

    def discount(values):
        of = collections.Counter(min(x, 5) for x in values if x > 0)
        less = [0, 0.75, 0.75, 0.75]
        if all(of[k] for k in (1, 2, 3, 4)):
            y = of[1] / (of[1] + 2 * of[2])
            less[1:] = [min(max(k - (k + 1) * y * of[k + 1] / of[k], 0.1), k) for k in (1, 2, 3)]
        return lambda x: x - less[min(int(x), 3)]

    follows = [collections.Counter(w for (_, w), n in c.items() if n) for c in count]
    pooled = follows[0] + follows[1]
    cut = discount(pooled.values())
    back = {w: cut(pooled[w]) / sum(pooled.values()) for w in vocabulary}
    left = 1 - sum(back.values())
    of_back = lambda w: back.get(w, 0) + left / size
    p = []
    for c in (0, 1):
        cut = discount(follows[c].values())
        own = {w: cut(follows[c][w]) / sum(follows[c].values()) for w in vocabulary}
        p.append(lambda w, own=own: own.get(w, 0) + (1 - sum(own.values())) * of_back(w))

    def context(counts, v):
        cut = discount(counts.values())
        after = {w: n for (u, w), n in counts.items() if u == v}
        total = sum(after.values())
        return {w: cut(n) / total for w, n in after.items()}, (1 - sum(cut(n) for n in after.values()) / total if total else 1.0)

    out, before = [], ""
    for w in text.split():
        v = before if before in vocabulary else None
        per = [context(c, v) for c in count]
        pool, pool_rest = context(both, v)
        shared = max(per[0][1], per[1][1])
        prob = []
        for c in (0, 1):
            seen, rest = per[c]
            own = 1 - rest
            prob.append((1 - shared) * seen.get(w, 0) / (own if own > 0 else 1) + shared * (pool.get(w, 0) + pool_rest * p[c](w)))
        out.append(math.log(prob[1]) - math.log(prob[0]))
        before = w
    return out


def test_kneser_ney_equals_brute_force(spark):
    rng = random.Random(14)
    rows_ = TOXIC_ROWS + [(" ".join(rng.choice("abcdefgh"[: 3 + k % 6]) for _ in range(rng.randint(1, 12))), k % 2, k % 3 % 2) for k in range(40)]
    model = toxicity.count_bigrams(spark.createDataFrame(rows_, "text string, toxic int, half int")).model("ab")
    for text in ("a b c", "x y x q a", "q q", "h g f e d c b a"):
        number = model.numbers([w.encode() for w in text.split()])
        first = np.arange(len(number)) == 0
        assert np.allclose(model.ratios(number, first), brute_ratios(rows_, text), atol=1e-5)


def test_toxicity_of_a_phrase_whose_word_has_one_context(spark):
    rng = random.Random(4)
    plain = [f"w{k}" for k in range(300)]
    data, labels = [], []
    for i in range(800):
        bad = i % 5 == 0
        text = [rng.choice(plain) for _ in range(rng.randint(20, 60))]
        for phrase in ("quiet storm" if bad else "quiet river", "calm sea"):
            text.insert(rng.randrange(len(text)), phrase)
        text += ["w1", "w2"] if bad and i % 50 == 0 else []
        data.append((i, " ".join(text)))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    counted, curve = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    model = counted.model("ab")
    for v, w in ((b"quiet", b"storm"), (b"w1", b"w2")):
        assert model.words[v] * model.p.shape[1] + model.words[w] in model.pairs
    found = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, (counted, curve)).collect()}
    held = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(found[i] >= toxicity.THRESHOLD) == bool(y) for i, y in held]) > 0.97


def test_toxicity_counts_every_word_and_bigram(spark):
    counted = toxicity.count_bigrams(spark.createDataFrame(TOXIC_ROWS, "text string, toxic int, half int"))
    assert counted.words == [b"", b"a", b"b", b"c", b"d", b"x", b"y"]
    found = []
    for halves in ("a", "b", "ab"):
        key, counts = counted.pairs(halves)
        assert (np.diff(key) > 0).all()
        found.append({(counted.words[k // 8], counted.words[k % 8]): n for k, n in zip(key.tolist(), counts.T.tolist(), strict=True)})
    assert len(found[2]) == 12 and found[0][(b"a", b"b")] == [2, 1] == found[2][(b"a", b"b")] and found[1][(b"c", b"d")] == [1, 0] and (b"c", b"d") not in found[0]


def test_toxicity_on_odd_rows(spark, odd):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    assert toxicity.fit(odd, none) is None
    assert toxicity.drop_toxic(odd, none).count() == 8
    assert toxicity.score_documents(odd.limit(0), None).count() == 0
    texts = [(i, f"calm word {i % 7}" if i % 2 else f"vile word {i % 7}") for i in range(400)]
    fitted = toxicity.fit(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame([(i, 1 - i % 2) for i in range(400)], "doc_id long, toxic int"))
    clash = odd.withColumn("_text", F.lit("vile")).withColumn("score", F.lit("mine")).withColumn("_row", F.lit(1))
    found = toxicity.score_documents(clash, fitted).collect()
    assert len(found) == 8 and all(0 <= r["score"] <= 1 for r in found)
    assert toxicity.score_documents(clash.limit(0), fitted).count() == 0
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(400)], "doc_id long, toxic int")
    kept = toxicity.drop_toxic(spark.createDataFrame(texts, "doc_id long, text string").withColumn("_row", F.lit(1)).withColumn("_score", F.lit("s")), labels)
    assert kept.columns == ["doc_id", "text", "_row", "_score"] and kept.where("text LIKE 'vile%'").count() == 0 and kept.count() == 200


# -- PPM -----------------------------------------------------------------------------------------------------------
def brute_ppm(texts, text):
    k = compression_score.ORDER
    trie = [collections.defaultdict(collections.Counter) for _ in range(k + 1)]
    for t in texts:
        padded = b"\0" * k + t
        for i in range(len(t) + 1):
            for j in range(k + 1):
                trie[j][padded[i + k - j : i + k]][t[i] if i < len(t) else 256] += 1
    total, padded = 0.0, b"\0" * k + text
    for i in range(len(text) + 1):
        symbol, gone = text[i] if i < len(text) else 256, set()
        for j in range(k, -1, -1):
            seen = trie[j].get(padded[i + k - j : i + k], {})
            left = {s: n for s, n in seen.items() if s not in gone}
            size = sum(left.values())
            if size and symbol in left:
                total += math.log10((left[symbol] - 0.5) / size)
                break
            if size:
                total += math.log10(0.5 * len(left) / size)
            gone |= set(seen)
        else:
            total -= math.log10(257 - len(gone))
    return total


def test_ppm_equals_brute_force(spark):
    texts = ["The cat sat", "the hat", None, "", "abracadabra", "The cat sat", "zürich Zürich", "a\nb  c"] * 3
    data = list(enumerate(texts))
    trained = [(t or "").encode().lower() for i, t in data if zlib.crc32(str(i).encode()) % 10]
    counts = collections.Counter(w for t in trained for w in t.split() + [None])
    n, v = sum(counts.values()), len(counts)
    found = compression_score.score_documents(spark.createDataFrame(data, "doc_id long, text string"), batch_bytes=60).collect()
    assert len(found) == len(data)
    for r in found:
        text = (texts[r["doc_id"]] or "").encode().lower()
        tokens = text.split() + [None]
        assert math.isclose(r["score"], brute_ppm(trained, text), rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens), rel_tol=1e-9)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(counts[w] > 0 for w in tokens), n)


def test_packed_lists_come_back():
    rng = np.random.default_rng(8)
    gram = np.unique(rng.integers(0, 1 << 49, 5000))
    assert (compression_score.turn_back(compression_score.turn(gram)) == gram).all()
    for x in (np.sort(compression_score.turn(gram)), gram[:0]):
        assert (compression_score.unpack_sorted(compression_score.pack_sorted(x)) == x).all()
    values, codes = compression_score.pack_values(np.array([-0.5, 0.0, -0.5]))
    assert compression_score.unpack(values).view(float)[compression_score.unpack(codes)].tolist() == [-0.5, 0.0, -0.5]


def test_ppm_of_one_batch_and_many_equals(spark, docs):
    some = docs.select("doc_id", "text")
    found = [{r["doc_id"]: r for r in compression_score.score_documents(some, batch_bytes=b).collect()} for b in (30_000, 20_000_000)]
    for i, r in found[0].items():
        assert all(math.isclose(r[c], found[1][i][c], rel_tol=1e-9) for c in ("score", "base_score", "n_tokens", "n_known", "train_tokens"))


def test_ppm_without_training(spark):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    found = compression_score.score_documents(spark.createDataFrame([(i, "abc") for i in held], "doc_id long, text string")).collect()
    assert all(math.isclose(r["score"], -4 * math.log10(257)) and r["n_known"] == 0 and r["train_tokens"] == 0 for r in found)


def test_ppm_on_odd_rows(spark, odd):
    assert compression_score.score_documents(odd.select("doc_id", "text")).count() == 8
    assert compression_score.score_documents(odd.limit(0).select("doc_id", "text")).count() == 0


# -- preference ----------------------------------------------------------------------------------------------------
def test_preference_equals_sql(spark, sf_dir):
    got = registry.op5_preference_format(spark, sf_dir).toPandas()
    assert rows(got) == rows(database(sf_dir).sql(preference.ORACLE_SQL).df())


def test_preference_prefix_and_masks(spark):
    data = [(0, 0, "user", "hi"), (0, 1, "assistant", "good <|x"), (1, 0, "user", "hi"), (1, 1, "assistant", "bad"), (2, 0, "user", "alone"), (4, 0, None, None), (5, 0, None, None), (None, 0, "user", "x")]
    turns = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    found = {r["pair_id"]: r for r in preference.format_pairs(preference.neighbours(turns)).collect()}
    assert set(found) == {0, 2}
    assert found[0]["prompt"] == "<|user|>\nhi<|end|>\n" and found[0]["prompt_turns"] == 1
    assert [tuple(s) for s in found[0]["chosen"]] == [("<|assistant|>\n", False), ("good < |x<|end|>\n", True)]
    assert found[2]["chosen"] == [] and found[2]["prompt_turns"] == 1
    plan = preference.format_pairs(preference.neighbours(turns))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_preference_on_odd_rows(spark):
    turns = spark.createDataFrame([(0, 0, "user", "hi"), (0, 1, "assistant", "x " * 200_000), (1, 0, "user", "hi"), (1, 1, "assistant", "no"), (1, 1, "assistant", "no")], "conv_id long, turn long, role string, text string")
    clash = turns.withColumn("pair_id", F.lit("mine")).withColumn("prompt", F.lit(1)).withColumn("turns", F.lit(2))
    found = preference.format_pairs(preference.neighbours(clash)).collect()
    assert len(found) == 1 and len(found[0]["chosen"][1]["text"]) > 399_000
    assert preference.format_pairs(preference.neighbours(clash.limit(0))).count() == 0


# -- SentencePiece -------------------------------------------------------------------------------------------------
def test_pieces_equal_the_library(spark, docs):
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=piece_encoding.MODEL_PATH)
    rng = random.Random(5)
    letters = " abcdefghijklmnopqrstuvwxyzABC  éèüß你好日本Ω😀\n\t.,;:0123-/()“”\x00\xa0"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(500)] + ["a" * 500, "   x   y    ", " " * 33] + [r["text"] for r in docs.limit(100).collect()]
    encoder = piece_encoding.Encoder(piece_encoding.load_vocabulary())
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == sp.encode(text)
        assert encoder.decode(ids.tolist()) == text


def test_pieces_on_odd_rows(spark, odd):
    found = piece_encoding.encode_documents(odd.withColumn("token_ids", F.lit(1)), decoded="ok")
    assert found.where("ok").count() == 8
    assert piece_encoding.decode_ids(found, text="back").where("back = coalesce(text, '')").count() == 8
    assert piece_encoding.encode_documents(odd.limit(0)).count() == 0


# -- nearest -------------------------------------------------------------------------------------------------------
def brute_nearest(vectors, top):
    out = {}
    for q, x in vectors.items():
        if q % 20 == 0:
            out[q] = sorted(((-float(np.dot(x, y)), i) for i, y in vectors.items() if i != q))[:top]
    return out


def test_nearest_recall(spark, sf_dir):
    found = registry.op7_nearest(spark, sf_dir).toPandas()
    data = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    vectors = {i: np.array(x, dtype=np.float64) for i, x in zip(data["vec_id"], data["embedding"], strict=True)}
    hits = total = 0
    for q, best in brute_nearest(vectors, 20).items():
        mine = found[found["query_id"] == q].sort_values("rank")
        assert len(mine) == 20 and mine["score"].is_monotonic_decreasing
        hits += len({i for _, i in best} & set(mine["vec_id"]))
        total += 20
    assert hits / total >= 0.9


def test_nearest_with_ties_and_bad_vectors(spark):
    good = [(i, [1.0, 0.5 * (i % 3), 0.0, 1.0]) for i in range(60)]
    bad = [(100, None), (120, [0.0] * 4), (140, [1.0, None, 1.0, 1.0]), (160, [float("nan")] * 4), (180, [float("inf"), 1.0, 1.0, 1.0]), (200, [1.0]), (None, [1.0] * 4)]
    vectors = nearest.usable(spark.createDataFrame(good + bad, "vec_id long, embedding array<float>"))
    found = nearest.search(vectors, vectors.where("vec_id % 20 = 0"), nearest.Settings(least=1000)).toPandas()
    want = brute_nearest({i: np.array(x) for i, x in good}, 20)
    for q, best in want.items():
        mine = found[found["query_id"] == q].sort_values("rank")
        assert mine["vec_id"].tolist() == [i for _, i in best]
        assert np.allclose(mine["score"], [-s for s, _ in best])
    none = nearest.usable(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert nearest.search(none, none).count() == 0


def test_nearest_with_repeated_ids_and_rows(spark):
    rng = np.random.default_rng(7)
    data = [(i, [float(v) for v in x]) for i, x in enumerate(rng.normal(size=(50, 4)).astype(np.float32))]
    data += [(20, [3.0, 1.0, 0.5, 0.25]), data[1], (1, [2.0, 2.0, 2.0, 2.0]), data[20]]
    vectors = nearest.usable(spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("row", F.lit("clash")).withColumn("x", F.lit(0)))
    found = nearest.search(vectors, vectors.where("vec_id % 20 = 0"), nearest.Settings(least=1000)).toPandas()
    matrix, got = np.array([x for _, x in data]), collections.Counter()
    for q, rows_ in found.groupby("query_id"):
        got[q] = collections.Counter((r, v, round(s, 9)) for r, v, s in zip(rows_["rank"], rows_["vec_id"], rows_["score"], strict=True))
    want = collections.defaultdict(collections.Counter)
    for k, (q, x) in enumerate(data):
        if q % 20 == 0:
            order = sorted((-float(np.dot(np.array(x), matrix[j])), i, j) for j, (i, _) in enumerate(data) if j != k)[:20]
            want[q].update((r + 1, i, round(-s, 9)) for r, (s, i, _) in enumerate(order))
    assert got == want and sum(got[20].values()) == 60


def test_nearest_in_query_blocks(spark):
    rng = np.random.default_rng(6)
    data = [(i, [float(v) for v in x]) for i, x in enumerate(rng.normal(size=(1200, 8)).astype(np.float32))]
    vectors = nearest.usable(spark.createDataFrame(data, "vec_id long, embedding array<float>"))
    found = nearest.search(vectors, vectors.where("vec_id % 20 = 0"), nearest.Settings(least=1200, block_rows=50, query_rows=7)).toPandas()
    for q, best in brute_nearest({i: np.array(x) for i, x in data}, 20).items():
        assert found[found["query_id"] == q].sort_values("rank")["vec_id"].tolist() == [i for _, i in best]


# -- quality rules -------------------------------------------------------------------------------------------------
@pytest.mark.parametrize(("block_rows", "query_rows", "parts"), [(53, 7, 3), (31, 4096, 1), (4096, 5, 5)])
def test_nearest_ties_of_equal_vectors_in_any_blocks(spark, block_rows, query_rows, parts):
    """Equal vectors have equal scores and come in order of their ids, whatever the blocks; every shape gives the same rows."""
    rng = np.random.default_rng(11)
    data = [(i, [float(v) for v in x]) for i, x in enumerate(rng.normal(size=(1500, 24)).astype(np.float32))]
    copies = {i: data[77][1] for i in range(3, 1500, 90)}
    data = [(i, copies.get(i, x)) for i, x in data]
    vectors = nearest.usable(spark.createDataFrame(data, "vec_id long, embedding array<float>").repartition(parts))
    found = nearest.search(vectors, vectors.where("vec_id % 20 = 0"), nearest.Settings(least=4000, block_rows=block_rows, query_rows=query_rows)).toPandas().sort_values(["query_id", "rank"])
    matrix = np.array([x for _, x in data])
    for q, got in found.groupby("query_id"):
        score = np.cumsum(matrix * matrix[q], axis=1)[:, -1]
        order = [i for i in np.lexsort((np.arange(len(data)), -score)) if i != q][:20]
        assert got["vec_id"].tolist() == order and got["score"].tolist() == score[order].tolist()


def brute_metrics(text):
    import re

    w = re.findall("[^\x20\x09-\x0d]+", text or "")
    seen = collections.Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    covered = {j for k in range(len(w) - 7) if seen[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)}
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_metrics_equal_brute_force(spark, docs, odd):
    extra = spark.createDataFrame([(7, "a b c d e f g h " * 3 + "\n#x\n#x\ny 😀", "en", "a"), (8, "q " * 7, "en", "a"), (9, "q " * 9, "en", "a")], DOCS)
    for frame in (docs.select("doc_id", "text"), odd.unionByName(extra).select("doc_id", "text")):
        for r in quality_rules.apply_rules(frame).collect():
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute_metrics(r["text"])
            assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
            assert not (r["base_failed"] and r["kept"])


def test_rules_equal_sql(spark, sf_dir):
    got = registry.op8_quality_rules(spark, sf_dir).toPandas()
    assert rows(got) == rows(database(sf_dir).sql(quality_rules.ORACLE_SQL).df())


def test_rules_with_clashing_columns(spark, odd):
    clash = odd.withColumn("_words", F.lit("mine")).withColumn("_h1", F.lit(2)).withColumn("_row", F.lit(3)).withColumn("kept", F.lit("k"))
    found = quality_rules.apply_rules(clash)
    assert found.columns[:7] == ["doc_id", "text", "lang", "source", "_words", "_h1", "_row"]
    assert {(r["_words"], r["_h1"], r["_row"], type(r["kept"])) for r in found.collect()} == {("mine", 2, 3, bool)}
    assert quality_rules.keep_good(clash).columns == clash.columns


def test_rules_keep_columns(spark, odd):
    clash = odd.withColumn("n_words", F.lit("mine"))
    assert quality_rules.keep_good(clash).columns == clash.columns
    assert quality_rules.keep_good(clash.limit(0)).count() == 0


# -- mixing --------------------------------------------------------------------------------------------------------
def expected_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] >= 2 * sizes[s]}
        if not over:
            return target | share
        target |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        open_ -= over
    return target


def test_mix_reaches_targets(spark, docs):
    found = mixing.mix(docs).toPandas()
    want = expected_targets(found.groupby("source")["size"].sum().to_dict())
    for source, part in found.groupby("source"):
        assert np.allclose(part["target"], want[source])
        assert abs(part["taken"].sum() - want[source]) <= max(part["size"].median(), 0.05 * want[source])
    assert (found["taken"] <= 2 * found["size"]).all()
    again = mixing.mix(docs.repartition(3)).toPandas()
    assert found.set_index("doc_id")["taken"].to_dict() == again.set_index("doc_id")["taken"].to_dict()


def test_cube_sample_in_blocks_is_balanced(spark):
    rng = random.Random(2)
    data = [(i, 0, rng.randint(1, 400), rng.getrandbits(63), 0.37) for i in range(3000)]
    units = spark.createDataFrame(data, "uid long, rank long, size long, h long, p double")
    found = {r["uid"]: r["p"] for r in mixing.cube_sample(units, block_rows=64).collect()}
    assert len(found) == 3000 and set(found.values()) == {0.0, 1.0}
    assert abs(sum(found.values()) - 0.37 * 3000) <= 20
    assert abs(sum(d[2] * found[d[0]] for d in data) - 0.37 * sum(d[2] for d in data)) <= 400


def test_cube_sample_spreads_rows_of_one_hash(spark, monkeypatch):
    """20,000 repeated rows share a hash: no block holds more than its share, and their words still meet the target."""
    block = mixing._block
    blocks = spark.sparkContext.accumulator([], ListOf())
    monkeypatch.setattr(mixing, "_block", lambda pdf: (blocks.add([len(pdf)]), block(pdf))[1])
    units = spark.range(20_000).select(F.col("id").alias("uid"), F.lit(0).cast("long").alias("rank"), F.lit(9).cast("long").alias("size"), F.lit(5).cast("long").alias("h"), F.lit(0.25).alias("p"))
    found = mixing.cube_sample(units, block_rows=1000)
    assert abs(found.where("p = 1").count() - 5000) <= 20 and found.count() == 20_000
    sizes = blocks.value
    assert sizes and max(sizes) < 2000


class ListOf(AccumulatorParam):
    def zero(self, value):
        return []

    def addInPlace(self, a, b):  # noqa: N802
        return a + b


def test_flight_keeps_the_constraints():
    rng = random.Random(15)
    for by_count in (True, False):
        for _ in range(50):
            n = rng.randint(1, 40)
            sizes, p = [float(rng.choice([1, 5, 5, 30])) for _ in range(n)], [rng.choice([0.5, rng.random()]) for _ in range(n)]
            words, count = sum(s * x for s, x in zip(sizes, p, strict=True)), sum(p)
            mixing._flight(sizes, p, [rng.random() for _ in range(n)], by_count)
            assert all(-1e-9 <= x <= 1 + 1e-9 for x in p) and sum(x not in (0.0, 1.0) for x in p) <= (2 if by_count else 1)
            assert math.isclose(sum(s * x for s, x in zip(sizes, p, strict=True)), words, abs_tol=1e-5)
            assert not by_count or math.isclose(sum(p), count, abs_tol=1e-6)


def test_flight_keeps_inclusion_probabilities():
    """On average over draws, each document keeps its probability."""
    rng = random.Random(16)
    sizes, start = [3.0, 1.0, 7.0, 2.0, 2.0, 9.0], [0.2, 0.7, 0.5, 0.4, 0.4, 0.6]
    total = np.zeros(6)
    for _ in range(20000):
        p = list(start)
        mixing._flight(sizes, p, [rng.random() for _ in p], by_count=True)
        mixing._flight(sizes, p, [rng.random() for _ in p], by_count=False)
        total += [x if x in (0.0, 1.0) else float(rng.random() < x) for x in p]
    assert np.abs(total / 20000 - start).max() < 0.02


def test_mix_with_ties_and_clashing_columns(spark):
    data = [(7, "a b c d", "s", 1)] * 30 + [(i, "a b c d", "t", 2) for i in range(30)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string, _uid int").withColumn("copies", F.lit("c")).withColumn("_copy", F.lit(0))
    found = mixing.mix(docs).toPandas()
    for source, part in found.groupby("source"):
        assert abs(part["taken"].sum() - part["target"].iloc[0]) <= 4
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == found["copies"].sum()


def test_mix_on_odd_rows(spark, odd):
    found = mixing.mix(odd).collect()
    assert len(found) == 8 and all(r["taken"] == 0 for r in found if r["size"] == 0)
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns and mixed.count() == sum(r["copies"] for r in found)
    assert mixing.mix(odd.limit(0)).count() == 0


# -- n-gram join ---------------------------------------------------------------------------------------------------
def brute_components(texts):
    sets = {}
    for i, t in texts.items():
        w = words(t)
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(seed, groups, size, most):
    rng = random.Random(seed)
    texts, i = {}, 0
    for g in range(groups):
        base = [f"v{rng.randrange(4000)}" for _ in range(rng.randint(4, 160))]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randint(0, most)):
                copy[rng.randrange(len(copy))] = f"u{rng.randrange(10**6)}"
            texts[i] = " ".join(copy)
            i += 1
    return texts


def joined(spark, texts, **settings):
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join_documents(frame, **settings).collect()}


@pytest.mark.parametrize("rare_class,seed", [(5, 1), (1, 2), (0, 3)])
def test_join_equals_brute_force(spark, rare_class, seed):
    texts = near_copies(seed, 12, 12, 4) | {9000: None, 9001: "", 9002: "one two", 9003: "One  TWO", 9004: "one two three"}
    assert joined(spark, texts, rare_class=rare_class) == brute_components(texts)


def test_join_in_small_blocks_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 4)
    texts = near_copies(3, 12, 12, 4)
    assert joined(spark, texts, rare_class=0) == brute_components(texts)


def test_join_of_a_hot_group_without_a_hub(spark, monkeypatch):
    """Copies of one base that differ more from each other than from the base, sets above 128 shingles, and unrelated texts with one common passage."""
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 16)
    rng = random.Random(9)
    texts, base, passage = {}, [f"v{k}" for k in range(220)], " ".join(f"c{k}" for k in range(60))
    for i in range(60):
        copy = list(base)
        for at in rng.sample(range(len(copy)), 7 if i % 2 else 4):
            copy[at] = f"u{rng.randrange(10**6)}"
        texts[i] = " ".join(copy)
    for i in range(100, 160):
        texts[i] = passage + " " + " ".join(f"x{rng.randrange(10**6)}" for _ in range(rng.randint(4, 40)))
    assert joined(spark, texts, rare_class=1) == brute_components(texts)


def test_reach_of_combinations():
    """No placing of differences keeps similar sets from sharing k neighbours within reach."""
    rng = random.Random(7)
    for _ in range(3000):
        common = rng.randint(4, 80)
        differences = rng.randint(0, common // 4)
        order = ["c"] * common + ["x" if rng.random() < 0.5 else "y" for _ in range(differences)]
        if rng.random() < 0.5:
            rng.shuffle(order)
        else:  # one difference after each three
            c, d = order[:common], order[common:]
            order = []
            while c:
                order += c[:3] + d[:1]
                c, d = c[3:], d[1:]
        rare = rng.randint(0, 3)
        front = order[:rare] if all(o != "c" for o in order[:rare]) else []
        sides = []
        for mark in "xy":
            own = [(o, i) for i, o in enumerate(order) if o in ("c", mark)]
            sides.append((own, sum(1 for o in front if o == mark)))
        for k in [2] * (max(len(s) for s, _ in sides) <= ngram_join.PAIRS_UPTO) + [4] * (min(len(s) for s, _ in sides) >= ngram_join.LONG_FROM):
            if not differences and common < k:
                continue
            keys = []
            for own, r in sides:
                places = [i for _, i in own][r:][: ngram_join.reach(len(own), r, k)]
                keys.append({tuple(places[j : j + k]) for j in range(len(places) - k + 1)})
            assert keys[0] & keys[1], (order, k)


def test_keys_of_combinations_are_cut_on_both_sides(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 32)
    often = spark.range(1000).select(F.lit(7).cast("long").alias("key"), F.xxhash64("id").alias("sig"), F.lit(20).alias("n"), F.lit(0).alias("rare"), F.xxhash64("id").alias("label"))
    minor, every = ngram_join.rest_blocks(often, often.select("sig", F.array(F.lit(0).cast("long")).alias("bits")))
    for side in (minor, every):
        assert side.groupBy("slot", "part", "block").count().agg(F.max("count")).first()[0] <= 3 * 32
    met = minor.join(every.select("slot", "part", "block", F.col("sig").alias("other")), ["slot", "part", "block"]).select("sig", "other")
    assert met.distinct().count() == met.count() == 999 * 1000


def test_join_with_clashing_columns(spark, odd):
    clash = odd.withColumn("sig", F.lit("s")).withColumn("n", F.lit(1)).withColumn("_uid", F.lit(2)).withColumn("_row", F.lit(3))
    kept = ngram_join.keep_one(clash)
    assert kept.columns == clash.columns and {(r["sig"], r["n"], r["_uid"], r["_row"]) for r in kept.collect()} == {("s", 1, 2, 3)}
    assert ngram_join.join_documents(clash).count() == 8


def test_join_keeps_one_of_each_group(spark, odd):
    kept = ngram_join.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "4", "5", "None"]
    assert ngram_join.keep_one(odd.limit(0)).count() == 0


def test_join_keeps_the_same_of_each_group_in_any_partitions(spark):
    texts = list(near_copies(4, 9, 4, 3).values())
    rng = random.Random(9)
    ids = rng.sample(range(1000), len(texts))
    data = [*zip(ids, texts, strict=True), (ids[0], texts[1]), (None, texts[0]), (ids[2], texts[2])]
    frames = [spark.createDataFrame(order, "doc_id long, text string").repartition(parts) for order, parts in ((data, 1), (data[::-1], 5))]
    one, two = (collections.Counter(map(tuple, ngram_join.keep_one(f).collect())) for f in frames)
    assert one == two
    groups = collections.defaultdict(set)
    for r in ngram_join.join_documents(spark.createDataFrame([(i, x) for i, (_, x) in enumerate(data)], "doc_id long, text string")).collect():
        groups[r["component_id"]].add(data[r["doc_id"]][0])
    assert collections.Counter(i for i, _ in one) == collections.Counter(min(g, key=lambda i: (i is None, i or 0)) for g in groups.values())


def test_keep_one_shuffles_only_rows_that_may_go(spark):
    texts = near_copies(8, 30, 3, 1) | {900: None, 901: ""}
    frame = spark.createDataFrame([(i, x, x) for i, x in texts.items()], "doc_id long, text string, other string")
    kept = ngram_join.keep_one(frame)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in brute_components(texts).values()})
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 1 and plan.startswith("Union")


@pytest.fixture
def written(monkeypatch):
    """The tables that the join stores, by tag."""
    found, keep = {}, ngram_join.stored
    monkeypatch.setattr(ngram_join, "stored", lambda df, tag: found.setdefault(tag, []).append(keep(df, tag)) or found[tag][-1])
    return found


def test_join_stores_less_than_its_texts(spark, written):
    rng = random.Random(5)
    texts = {i: " ".join(f"w{rng.randrange(10**6)}" for _ in range(600)) for i in range(60)}
    assert joined(spark, texts) == {i: (596, i) for i in texts}
    size = sum(f.stat().st_size for tag in written for df in written[tag] for name in df.inputFiles() for f in [pathlib.Path(name.removeprefix("file://"))])
    assert size < sum(map(len, texts.values())) / 2


def test_rare_keys_stay_rare_in_a_table_that_grows(spark, written, monkeypatch):
    """More shingles than buckets of the least table, and copies in all partitions: neither makes shingles frequent."""
    monkeypatch.setattr(ngram_join, "LEAST_BITS", 6, raising=False)
    texts = near_copies(6, 40, 2, 2)
    frame = spark.createDataFrame([(100 * i + k, x) for i, x in texts.items() for k in range(40)], "doc_id long, text string").repartition(40)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join_documents(frame).collect()}
    wanted = brute_components(texts)
    assert found == {100 * i + k: (n, 100 * c) for i, (n, c) in wanted.items() for k in range(40)}
    (groups,) = written["join-groups"]
    assert groups.where("key IS NULL").count() > 0 == groups.where("key IS NOT NULL").count()
    octets = 9 * 10**9
    bits, rise = ngram_join.table_bits(octets)
    assert octets / ngram_join.SHINGLE_OCTETS <= ngram_join.LOAD * 2**bits and rise == 0
    assert ngram_join.table_bits(8 * octets)[1] == 3


# -- the pipeline --------------------------------------------------------------------------------------------------
def test_pipeline_stages(spark, sf_dir, docs):
    import corpus_pipeline

    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality_rules", "ngram_jaccard_join", "mixing", "sentencepiece"]
    frame = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, frame, sf_dir)
        assert after.columns == docs.columns
        frame = corpus_pipeline.stored(after, "test-stage")
    ids = [r["doc_id"] for r in frame.select("doc_id").distinct().collect()]
    assert 0 < len(ids) <= docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, frame, sf_dir)
    assert last.where("NOT round_trip").count() == 0 and last.count() == frame.count()


def test_pipeline_equals_brute_force(spark, tmp_path):
    """Planted documents through all stages, each stage's decisions against plain Python."""
    import corpus_pipeline

    rng = random.Random(17)
    calm = [f"calm{k}" for k in range(400)] + ["the", "of", "and", "to"] * 20
    texts = {}
    for i in range(240):
        texts[i] = ["the", "of", "and"] + [rng.choice(calm) for _ in range(rng.randint(25, 80))]
        if i % 6 == 0:
            for _ in range(4):
                texts[i].insert(rng.randrange(len(texts[i])), rng.choice(["vile", "nasty"]))
    short = {300 + i: [rng.choice(calm) for _ in range(rng.randint(0, 15))] for i in range(10)}
    copies = {400 + i: list(texts[1 + 6 * (i % 5)]) for i in range(25)}
    for words_ in copies.values():
        words_[rng.randrange(len(words_))] = "changed"
    data = [(i, " ".join(w), "en", f"s{i % 3}", 0) for i, w in (texts | short | copies).items()]
    spark.createDataFrame(data, DOCS + ", n_chars long").coalesce(1).write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in texts], "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    frame, by_id = spark.read.parquet(f"file://{tmp_path}/documents.parquet"), {i: t for i, t, *_ in data}
    ids = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = corpus_pipeline.stored(stage(spark, frame, f"file://{tmp_path}"), "brute-stage")
        ids.append(sorted(r["doc_id"] for r in frame.select("doc_id").collect()))
    assert ids[0] == [i for i in by_id if "vile" not in by_id[i] and "nasty" not in by_id[i]]
    assert set(ids[1]) == {i for i in ids[0] if len(by_id[i].split()) >= 20}
    component = {i: c for i, (_, c) in brute_components({i: by_id[i] for i in ids[1]}).items()}
    assert len(ids[2]) == len(set(component.values())) and {component[i] for i in ids[2]} == set(component.values())
    size = {i: len(by_id[i].split()) for i in ids[2]}
    want = expected_targets({s: sum(n for i, n in size.items() if f"s{i % 3}" == s) for s in ("s0", "s1", "s2")})
    taken = collections.Counter(ids[3])
    assert all(n <= 2 for n in taken.values())
    for s, target in want.items():
        assert abs(sum(size[i] * n for i, n in taken.items() if f"s{i % 3}" == s) - target) <= 80
    last = corpus_pipeline.STAGES[-1][1](spark, frame, f"file://{tmp_path}").collect()
    assert sorted(r["doc_id"] for r in last) == ids[3] and all(r["round_trip"] and r["n_tokens"] == len(r["token_ids"]) for r in last)
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").count() == len(last)
    empty = [(n, frame.limit(0)) for n, _ in corpus_pipeline.STAGES]
    assert all(stage(spark, nothing, f"file://{tmp_path}").count() == 0 for (_, stage), (_, nothing) in zip(corpus_pipeline.STAGES, empty, strict=True))
