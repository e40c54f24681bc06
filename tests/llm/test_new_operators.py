"""Importance resampling, personal data and whitening against brute force, on small tables and odd rows."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest
from gleaner.llm import personal_data, registry, resampling, whitening
from pyspark.sql import functions as F


# -- importance resampling ----------------------------------------------------------------------------------------
def brute_resample(docs, target, s=resampling.Settings()):
    """[(doc_id, n_features, weight, score, rank)] in the order of docs."""

    def buckets(text):
        low = (text or "").translate({i: i + 32 for i in range(65, 91)})
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        return w, [zlib.crc32(" ".join(w[i : i + n]).encode()) % s.buckets for n in range(1, s.longest + 1) for i in range(len(w) - n + 1)]

    made = [buckets(t) for _, t in docs]
    source = collections.Counter(b for _, bs in made for b in bs)
    wanted = collections.Counter(b for t in target for b in buckets(t)[1])
    s_all, t_all = sum(source.values()), sum(wanted.values())
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * (s_all + s.buckets) / ((source[b] + 1) * (t_all + s.buckets))))
    rows = []
    for (i, _), (w, bs) in zip(docs, made, strict=True):
        h = int(hashlib.sha256(f"{s.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, bs))
        rows.append([i, len(bs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(w)])
    eligible = sorted((r for r in rows if r[5] >= s.least), key=lambda r: (-r[3], math.inf if r[0] is None else r[0]))
    for k in range(s.percent * len(eligible) // 100):
        eligible[k][4] = k + 1
    return [tuple(r[:5]) for r in rows]


def resampled(spark, docs, target, **settings):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumn("score", F.lit("clash"))
    t = spark.createDataFrame([(x,) for x in target], "text string")
    return [tuple(r) for r in resampling.resample(d, t, resampling.Settings(**settings)).collect()]


def test_resampling_of_the_whole_table_equals_brute_force(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    target = [r[0] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text").collect()]
    got = registry.op11_importance_resampling(spark, sf_dir)
    assert dict(got.dtypes) == dict.fromkeys(("doc_id", "n_features", "weight", "score", "rank"), "bigint")
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(brute_resample(docs, target))


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_resampling_with_odd_rows_and_longer_runs(spark, longest):
    rng = random.Random(longest)
    make = lambda n: " ".join(rng.choice(["Alpha", "beta", "ÜBER", "x1", "日本", "🙂é", "gamma-delta"]) for _ in range(n))
    docs = [(i, make(rng.randrange(40))) for i in range(120)] + [(500, None), (501, ""), (502, " .,-\n"), (503, make(30_000)), (None, make(25)), (504, "one"), (505, "one two")]
    docs += [(7, docs[7][1])] * 5
    target = [make(10), None, "", "alpha beta"]
    got = resampled(spark, docs, target, longest=longest, percent=37)
    assert collections.Counter(got) == collections.Counter(brute_resample(docs, target, resampling.Settings(longest=longest, percent=37)))


def test_resampling_of_a_hot_group(spark):
    """A third of all rows share id, text and score: ranges still cut them, and ranks run on."""
    text = " ".join(f"w{i}" for i in range(25))
    docs = [(None, text)] * 400 + [(i, text) for i in range(800)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    weighted = resampling.weigh(d, d.limit(0))
    drawn = resampling.draw(weighted, resampling.Settings(percent=90), range_rows=50)
    assert sorted(r["rank"] for r in drawn.collect()) == list(range(1, 1081))
    assert len({r["row"] for r in drawn.collect()}) == 1080
    got = [tuple(r) for r in weighted.join(drawn, "row", "left").select("doc_id", "n_features", "weight", "score", "rank").collect()]
    assert collections.Counter(got) == collections.Counter(brute_resample(docs, [], resampling.Settings(percent=90)))
    for split in (1, 9):
        again = resampling.resample(d.repartition(split), d.limit(0), resampling.Settings(percent=90)).collect()
        assert collections.Counter(map(tuple, again)) == collections.Counter(got)


def test_resampling_of_empty_tables(spark):
    assert resampled(spark, [], ["a b"]) == []
    assert resampled(spark, [(1, "a few words")], [])[0][4] is None


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 16, 17, 40, 300])
def test_tournament_merges_runs(k):
    rng = random.Random(k)
    runs = [sorted((rng.randrange(50), rng.randrange(3), i * 1000 + j) for j in range(rng.randrange(30))) for i in range(k)]
    assert list(resampling.merged([iter(r) for r in runs])) == sorted(x for r in runs for x in r)


# -- personal data -------------------------------------------------------------------------------------------------
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_base(text):
    def luhn(d):
        return sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0

    def passes(kind, m):
        d = re.sub("[^0-9]", "", m)
        return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.split(".")), "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]

    return [(kind, m.start(), m.end()) for kind, p in PATTERNS.items() for m in re.finditer(p, text or "") if passes(kind, m[0])]


def text_of(found):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in found)


def check_report(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("spans", F.lit("clash")).repartition(3)
    got = personal_data.report(frame).collect()
    assert len(got) == len(docs)
    want = collections.Counter()
    for i, text in docs:
        base = brute_base(text)
        n = collections.Counter(k for k, _, _ in base)
        want[(i, n["email"], n["ip"], n["card"], n["phone"], hashlib.sha256(text_of(base).encode()).hexdigest())] += 1
    assert collections.Counter(tuple(r)[:6] for r in got) == want
    return {r["doc_id"]: r for r in got}


def test_base_spans_equal_brute_force(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = check_report(spark, docs)
    assert sum(r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] for r in found.values()) > 0
    assert sum(r["n_added"] for r in found.values()) == 0  # nothing else is planted there: clean texts stay clean
    types = dict(registry.op12_personal_data(spark, sf_dir).dtypes)
    assert [types[f"n_{k}"] for k in personal_data.BASE_KINDS] == ["bigint"] * 4 and types["base_sha256"] == types["spans"] == "string"


def test_base_spans_of_random_texts(spark):
    rng = random.Random(5)
    bits = ["a@b.c", "@", ".", "-", " ", "+", "1", "22", "255", "256.", "4111 1111 1111 1111", "é", "🙂", "x", "(", ")", "\n", "+1 (555) 555-0100", "1.2.3.4", "00", "_%", "@@", "a.b", "9999999"]
    docs = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(40)))) for i in range(1500)]
    check_report(spark, [*docs, (None, "me@x.org"), (9000, None), (9001, ""), (3, docs[3][1]), (3, docs[3][1])])


def test_added_spans_need_checksums_and_context():
    spans = lambda text: [(k, text[s:e], base) for k, s, e, _, base in personal_data.spans_of(text)]
    assert spans("Pay to IBAN DE89 3704 0044 0532 0130 00 EUR today") == [("iban", "DE89 3704 0044 0532 0130 00", False)]
    assert spans("GB82WEST12345698765432") == [("iban", "GB82WEST12345698765432", False)]
    assert spans("IBAN DE88 3704 0044 0532 0130 00") == []
    assert spans("my SSN: 078-05-1120.") == [("ssn", "078-05-1120", False)] and spans("part 078-05-1120") == [] and spans("ssn 000-05-1120") == []
    assert spans("visa card 12 4111111111111111 1") == [("card", "4111111111111111", False)] and spans("noted 12 4111111111111111 1") == []
    assert spans("call 212-555-0187 now") == [("phone", "212-555-0187", False)] and spans("serial 212-555-0187") == []
    assert spans("phone serial 212-555-0187") == []  # words against it outweigh
    assert spans("4111 1111 1111 1111") == [("card", "4111 1111 1111 1111", True)]
    assert personal_data.mod97("GB82WEST12345698765432") and not personal_data.mod97("GB83WEST12345698765432")
    low, high = (personal_data.spans_of(f"{word} 10.0.0.1")[0][3] for word in ("version", "server"))
    assert low < high


def test_scans_are_linear():
    n, began = 400_000, time.time()
    for text in ("1" * n, "a" * n, "1." * n, "a@" * n, "+1" + "." * n, "1 " * n, "A1" * n, "a" * n + "@", "@" + "a." * n, "phone 212-555-0187 " * (n // 20), "+" * n):
        personal_data.spans_of(text)
    assert time.time() - began < 60


def test_find_keeps_columns(spark):
    frame = spark.createDataFrame([(1, "me@x.org", "kept")], "doc_id long, text string, kind string")
    row = personal_data.find(frame).first()
    assert row["kind"] == "kept" and [tuple(s)[:3] for s in row["spans"]] == [("email", 0, 8)]
    assert personal_data.report(frame.limit(0)).count() == 0


# -- whitening -------------------------------------------------------------------------------------------------------
def brute_whitening(data, components=16):
    """{(vec_id, component): (n, deviation, |whitened|, explained)} through the covariance matrix."""
    kept = [(i, [math.floor(float(np.float32(c)) * 64) + 1_000_000 for c in v]) for i, v in data if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = np.array([[float(Fraction(int(v) * n - int(s), n)) for v, s in zip(row, sums, strict=True)] for row in fit])
    e, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-e)
    e, axes = e[order], axes[:, order]
    out = {}
    for i, x in kept:
        d = [v * n - int(s) for v, s in zip(x, sums, strict=True)]
        w = np.array(d, dtype=float) / n @ axes / np.sqrt(np.maximum(e, 1e-300))
        for k in range(min(components, int((e > 1e-9 * e[0]).sum()))):
            out[(i, k + 1)] = (n, sum(v * v for v in d), abs(w[k]), e[k] / e.sum())
    return out


def check_whitening(spark, data, **options):
    got = whitening.whiten(spark.createDataFrame(data, "vec_id long, embedding array<float>").repartition(5).withColumn("x", F.lit("clash")), **options).collect()
    want = brute_whitening(data)
    assert {(r["vec_id"], r["component"]) for r in got} == set(want)
    for r in got:
        n, deviation, size, share = want[(r["vec_id"], r["component"])]
        assert r["n"] == n and r["deviation"] == deviation == int(r["deviation_exact"])
        assert abs(abs(r["whitened"]) - size) < 1e-6 * max(1, size) and abs(r["explained"] / share - 1) < 1e-9 and r["identity_error"] < 1e-9
    return got


def test_whitening_equals_eigenvectors(spark, sf_dir):
    data = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert len(check_whitening(spark, data)) == 16 * len(data)
    types = dict(registry.op13_whitening(spark, sf_dir).dtypes)
    assert [types[c] for c in ("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]


def test_whitening_with_copies_and_bad_vectors(spark):
    rng = np.random.default_rng(3)
    good = [(i, [float(v) for v in rng.normal(size=5) * [9, 4, 2, 1, 0.5]]) for i in range(90)]
    hot = [(200 + i, good[0][1]) for i in range(60)] + [(0, good[0][1])]
    bad = [(500, None), (501, []), (502, [1.0, None, 2.0, 3.0, 4.0]), (503, [math.nan, 0.0, 0.0, 0.0, 0.0]), (504, [math.inf, 0.0, 0.0, 0.0, 0.0]), (None, good[1][1])]
    got = check_whitening(spark, good + hot + bad)
    assert sum(r["vec_id"] is None for r in got) == 5 and sum(r["vec_id"] == 0 for r in got) == 10
    # Axes have one sign for all rows: whitened rows of the fit list are uncorrelated.
    fit = {}
    for r in got:
        if r["vec_id"] is not None and r["vec_id"] < 90:
            fit[(r["vec_id"], r["component"])] = r["whitened"]
    w = np.array([[fit[(i, k)] for k in range(1, 6)] for i in range(90)])
    assert np.abs(w.T @ w / 90 - np.eye(5)).max() < 1e-9


def test_whitening_of_flat_and_tiny_tables(spark):
    assert check_whitening(spark, [(1, [1.0, 2.0]), (2, [1.0, 3.0]), (3, [1.0, 5.0])])[0]["component"] == 1  # one dimension is flat
    for data in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]):
        assert whitening.whiten(spark.createDataFrame(data, "vec_id long, embedding array<float>")).count() == 0


def test_whitening_of_mixed_lengths_and_huge_entries(spark):
    rng = np.random.default_rng(4)
    data = [(i, [float(v) for v in rng.normal(size=3)]) for i in range(40)]
    mixed = data + [(100, [1.0]), (101, [2.0] * 7), (102, [1e30, 0.0, 0.0])]
    got = whitening.whiten(spark.createDataFrame(mixed, "vec_id long, embedding array<float>"))
    assert {r["vec_id"] for r in got.collect()} == set(range(40))
    wide = [(i, [float(v) for v in rng.normal(size=3) * 1e14]) for i in range(40)]
    got = whitening.whiten(spark.createDataFrame(wide, "vec_id long, embedding array<float>")).collect()
    want = brute_whitening(wide)
    assert all(int(r["deviation_exact"]) == want[(r["vec_id"], r["component"])][1] and r["deviation"] is None for r in got) and len(got) == 120


def test_whitening_merges_many_factors(spark):
    rng = np.random.default_rng(5)
    frame = spark.createDataFrame([([int(v) for v in row],) for row in rng.integers(0, 99, size=(300, 4))], "x array<bigint>").distinct().repartition(70)
    fit = whitening.stored(frame, "test-fit")
    wide = frame.repartition(70)
    n, sums = fit.count(), whitening._sums(fit)
    x = np.array([r["x"] for r in fit.collect()], dtype=float)
    r = whitening.tsqr(wide, n, sums)
    assert np.allclose(r.T @ r, (x - x.mean(axis=0)).T @ (x - x.mean(axis=0)))
