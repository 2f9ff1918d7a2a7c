"""Collocations, exact duplicates and whitening against plain Python on small
odd tables: nulls, blank and long texts, ties, repeated rows, empty tables and
further columns with clashing names."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

pytest.importorskip("casetrace.llm")
from casetrace.llm import collocations, exact_dedup, whitening  # noqa: E402
from casetrace.llm.sums import sum_arrays  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, n long, phrase string, kept string, full_hash string, part long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, "clash", "clash", "clash", 7) for i, t, lang in rows], SCHEMA)


# --- collocations ------------------------------------------------------------

def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_collocations(rows, threshold, longest, inside, top):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(text)):
            w = re.findall("[^\x20\x09]+", piece)
            totals[lang or "und"] += len(w)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    counts[lang or "und"][tuple(w[i:i + m])] += 1
    out = []
    for lang, f in counts.items():
        scored = []
        for p, a in f.items():
            if len(p) < 2 or a < threshold:
                continue
            score, _, left, right = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]])
                                        for k in range(1, len(p)))
            longer = [b for q, b in f.items() if len(q) > len(p) and b >= threshold and 100 * b >= inside * a
                      and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if not longer:
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -s))
    return sorted(out)


def texts(seed, n):
    rng = np.random.default_rng(seed)
    vocabulary = ["the", "The", "cat", "sat", "on", "mat", "été", "naïve", "x" * 300, "a-b", "1"] + [
        f"w{i}" for i in range(40)]
    gaps = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", " \r\n", "!?", " "]
    weight = 1 / np.arange(1, len(vocabulary) + 1)
    out = []
    for i in range(n):
        parts = []
        for _ in range(int(rng.integers(0, 60))):
            parts += [rng.choice(vocabulary, p=weight / weight.sum()), rng.choice(gaps)]
        out.append((i, "".join(parts), [None, "en", "fr", "und"][i % 4]))
    return out


def test_collocations_against_plain_counts(spark):
    rows = texts(3, 160) + [(None, None, "en"), (1, "", None), (2, " \t\n", "de"), (5, "the cat sat on the mat", "en"),
                            (5, "the cat sat on the mat", "en"), (6, "of one mind " * 3000, "xx")]
    for threshold, longest, top in ((4, 4, 2000), (7, 3, 5), (1, 2, 10 ** 6)):
        got = collocations.collocations(documents(spark, rows), threshold, longest, 80, top).collect()
        assert sorted(map(tuple, got)) == plain_collocations(rows, threshold, longest, 80, top)


def test_collocations_of_nothing(spark):
    for rows in ([], [(1, None, "en"), (2, "", None), (3, "one", "en")]):
        assert collocations.collocations(documents(spark, rows), 2).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_summary_keeps_every_frequent_key_within_its_capacity(seed):
    rng = np.random.default_rng(seed)
    threshold = 20
    keys = np.concatenate([rng.integers(0, 1 << 40, 300_000), np.repeat(rng.integers(0, 1 << 40, 50), 20),
                           np.repeat(rng.integers(0, 1 << 40, 3), 40_000)]).astype(np.uint64)
    rng.shuffle(keys)
    summary = collocations.Summary(len(keys) // threshold + 1)
    largest = 0
    for part in np.array_split(keys, 60):
        summary.add(*np.unique(part, return_counts=True))
        summary._settle()
        largest = max(largest, len(summary._keys))
    assert largest <= summary.capacity and summary.error < threshold
    found, n = np.unique(keys, return_counts=True)
    left = summary.survivors(threshold)
    assert set(found[n >= threshold]) <= set(left) and len(left) < len(found)


def test_packed_counts_and_filter_round_trip():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 48, 5_000).astype(np.uint64))
    counts = rng.integers(1, 1 << 20, len(keys))
    k, c = collocations._unpack(collocations._pack(keys, counts))
    assert (k == keys).all() and (c == counts).all()
    parts = {b: keys[keys >> np.uint64(45) == b] for b in range(7)}  # bucket 7 has none
    keep = collocations.Filter(3, {b: collocations.Filter.part(p, 16.0) for b, p in parts.items()})
    assert all(keep.passes(p).all() for p in parts.values())
    other = rng.integers(0, 1 << 48, 20_000).astype(np.uint64)
    assert keep.passes(other).mean() < 0.05
    full = collocations.Filter(3, {b: collocations.Filter.part(p, 0.01) for b, p in parts.items()})
    assert all(full.passes(p).all() for p in parts.values())


# --- exact duplicates --------------------------------------------------------

def plain_duplicates(rows):
    groups = defaultdict(list)
    for k, (i, text, _) in enumerate(rows):
        groups[re.sub("[\x20\x09-\x0d]", "", text or "")].append((-len(text or ""), i is None, i or 0, k))
    out = []
    for bare, members in groups.items():
        lead = min(members[:], key=lambda m: m[:3])
        keep = None if lead[1] else lead[2]
        left = 1
        for m in sorted(members):
            out.append((None if m[1] else m[2], keep, len(members), m[:3] == lead[:3] and left == 1,
                        hashlib.sha256(bare.encode()).hexdigest()))
            left = 0
    return sorted(out, key=repr)


def test_exact_duplicates_against_plain_groups(spark):
    long = "word " * 30_000
    head = "p" * 64
    rows = [(1, "a b", "en"), (2, "a\tb ", "en"), (3, "ab", None), (4, None, "x"), (5, "", "x"), (6, " \n\x0b", None),
            (7, head + "one", "en"), (8, head + "two", "en"), (9, head + "one ", "en"), (10, "A B", "en"),
            (None, "ab", "en"), (None, "lone", None), (11, long, "en"), (12, long + " ", "en"), (12, long + " ", "en"),
            (13, long + "x", "en"), (14, "é é", "en"), (15, "éé", "en"), (16, "é é", "en")]
    rows += [(100 + i, "copy " * (1 + i % 2) if i % 2 == 0 else "co py", "en") for i in range(60)]
    got = exact_dedup.duplicates(documents(spark, rows), hash_all=True).collect()
    assert sorted(map(tuple, got), key=repr) == plain_duplicates(rows)
    # without the caller's wish only what may repeat is hashed
    some = exact_dedup.duplicates(documents(spark, rows)).collect()
    assert sorted(map(tuple, ((*r[:4],) for r in some)), key=repr) == sorted(
        [r[:4] for r in plain_duplicates(rows)], key=repr)
    assert all(r.full_hash for r in some if r.group_size > 1)
    assert sum(r.full_hash is None for r in some) >= 3
    assert exact_dedup.duplicates(documents(spark, [])).count() == 0


def test_length_and_prefix_leave_only_crowded_groups(spark):
    rows = [(1, "aa", "en"), (2, "ab", "en"), (3, "aa", "en"), (4, "abc", "en"), (5, "p" * 70, "en"),
            (6, "p" * 64 + "q" * 6, "en")]
    left = exact_dedup.crowded(documents(spark, rows)).collect()
    assert sorted(r["size"] for r in left) == [2, 70]


def test_a_full_bit_array_changes_nothing(spark, monkeypatch):
    rows = [(i, f"text {i % 700}", "en") for i in range(1500)]
    monkeypatch.setattr(exact_dedup, "FILTER_BITS", exact_dedup.MAP_BITS)
    got = exact_dedup.duplicates(documents(spark, rows), hash_all=True).collect()
    assert sorted(map(tuple, got), key=repr) == plain_duplicates(rows)


# --- whitening ---------------------------------------------------------------

def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows],
                                 "vec_id long, embedding array<float>, whitened string, n int")


def plain_whitening(rows, components):
    usable = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = [[int(np.floor(64.0 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in usable]
    distinct = sorted(set(map(tuple, x)))
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    fit = np.array([[c - s / n for c, s in zip(v, sums)] for v in distinct])
    values, basis = np.linalg.eigh(fit.T @ fit / n)
    order = np.argsort(-values)[:components]
    values, trace = values[order], values.sum()
    out = []
    for (i, _), v in zip(usable, x):
        c = np.array([a - s / n for a, s in zip(v, sums)])
        for k in range(len(values)):
            out.append((i, k + 1, n, sum((n * a - s) ** 2 for a, s in zip(v, sums)),
                        abs(c @ basis[:, order[k]]) / np.sqrt(values[k]), values[k] / trace))
    return out


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=12) * np.arange(1, 13)).tolist()) for i in range(200)]
    rows += [(None, rows[3][1]), (7, rows[7][1]), (7, rows[7][1])]
    want = plain_whitening(rows, 5)
    odd = [(900, None), (901, [1.0, None] + [0.0] * 10), (902, [float("nan")] * 12), (903, [float("inf")] * 12),
           (904, [1.0, 2.0]), (905, []), (906, [3e38] * 12)]
    got = whitening.whiten(vectors(spark, rows + odd), components=5).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert tuple(g[:4]) == tuple(w[:4])
        assert abs(abs(g.whitened) - w[4]) < 1e-9 and abs(g.explained - w[5]) < 1e-12
        assert g.identity_error < 1e-9


def test_whitening_of_few_vectors_and_low_rank(spark):
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    rows = whitening.whiten(vectors(spark, [(1, [0.0, 0.0]), (2, [1.0, 1.0])])).collect()
    assert [(r.vec_id, r.component, r.n, r.deviation) for r in sorted(rows)] == [(1, 1, 2, 8192), (2, 1, 2, 8192)]
    assert all(abs(abs(r.whitened) - 1) < 1e-12 and r.explained == pytest.approx(1.0) for r in rows)


def test_deviation_beyond_a_long_is_null():
    model = whitening.Whitening(10 ** 9, np.array([0, 0]), np.zeros(0), np.zeros((2, 0)), 0.0, 0.0)
    x = np.array([[3, 4], [4_000, 0]])
    assert model.deviations(x) == [25 * 10 ** 18 if 25 * 10 ** 18 < 2 ** 63 else None, None]
    assert model.deviations(np.array([[1, 2]])) == [5 * 10 ** 18]


@pytest.mark.parametrize("d,rank", [(1, 1), (6, 6), (17, 5), (64, 64)])
def test_eigenvectors_against_numpy(d, rank):
    rng = np.random.default_rng(d)
    a = rng.normal(size=(d, rank)) * 10.0 ** np.linspace(0, -3, rank)
    values, vectors_ = whitening.eigenvectors(a @ a.T)
    want = np.linalg.svd(a, compute_uv=False) ** 2
    assert len(values) >= rank and np.allclose(values[:rank], want, rtol=1e-8)
    assert np.allclose(vectors_[:, :rank].T @ vectors_[:, :rank], np.eye(rank), atol=1e-10)
    assert np.allclose((vectors_ * values) @ vectors_.T, a @ a.T, atol=1e-10)


def test_tree_of_sums(spark):
    rows = spark.range(0, 1000, 1, 70)

    def partial(batches):
        total = np.zeros(2, np.int64)
        for b in batches:
            total += [sum(b.column(0).to_pylist()), b.num_rows]
        return total

    assert sum_arrays(rows, partial, (2,), "<i8").tolist() == [499_500, 1000]
