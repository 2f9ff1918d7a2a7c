"""Small cases of every text operator: nulls, empty and long texts, ties,
repeated rows, empty tables and clashing column names, against plain Python."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

pytest.importorskip("casetrace.llm")
import public_tokenizers  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from casetrace.llm import (classifier, components, decontamination, divergence, near_dedup, packing,  # noqa: E402
                           ppm, preference, sharding, token_files, tokens, url_rules)

TEXTS = [None, "", " \n ", "one", "The cat sat on the mat, it's 12 mats.\nThe cat sat on the mat.",
         "a  b\t c\n\n d", "é ü ﬁ  x  y", "x " * 3000,
         " ".join(f"w{i}" for i in range(400)), " ".join(f"w{i}" for i in range(400))]
SCHEMA = "doc_id long, text string, lang string, source string, score string, kept int"


def documents(spark, texts=TEXTS):
    return spark.createDataFrame(
        [(i, t, "en" if i % 2 else None, "s", "clash", 7) for i, t in enumerate(texts)]
        + ([(None, "no id at all", None, None, None, None), (8, texts[8], "en", "s", "c", 7)]
           if texts is TEXTS else []), SCHEMA)


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0d]+", lowered)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_word_by_word_ids_equal_whole_text_ids(name):
    path = public_tokenizers.path(name)
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    texts = TEXTS + ["it's\nA b", "\na", "a\n", "a \nb", "tab\there", "<|endoftext|> a</w>", "\x1cq r"]
    got = list(tokens.WordEncoder(path, memo_pieces=5).encode(pa.array(texts, pa.string())))
    want = [tokens.id_bytes(whole.encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert got == want


def test_shards_are_whole_and_even(spark):
    rows = spark.range(600).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.col("id").cast("string")).alias("g"), (F.col("id") % 40 + 1).alias("bytes"))
    rows = rows.unionByName(rows.where("id < 5")).unionByName(
        spark.createDataFrame([(None, None, 9)], "id long, g string, bytes long"))
    got = sharding.shard_records(rows, F.col("g"), F.col("id"), F.col("bytes"), 7).toPandas()
    assert len(got) == 606
    sizes = got.groupby("shard").bytes.sum()
    assert len(sizes) == 7 and sizes.max() - sizes.min() <= 80
    assert all(sorted(s) == list(range(len(s))) for _, s in got.groupby("shard").slot)
    assert sharding.shard_records(rows.where("id < 0"), F.col("g"), F.col("id"), F.col("bytes"),
                                  7).count() == 0


def test_shards_against_a_cut_of_the_sorted_list(spark):
    rows = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("g"),
        (F.pmod(F.xxhash64("id"), F.lit(500)) + F.when(F.col("id") == 77, 20_000).otherwise(1))
        .alias("bytes"))
    got = sharding.shard_records(rows, F.col("g"), F.col("id"), F.col("bytes"), 11).collect()
    order = sorted((r.h, r.id, r.bytes) for r in rows.select(F.xxhash64("g").alias("h"), "id",
                                                             "bytes").collect())
    total, run, filled, want = sum(r[2] for r in order), 0, {}, {}
    for _, key, size in order:
        shard = min((2 * run + size) * 11 // (2 * total), 10)
        want[key] = shard, filled.get(shard, 0)
        filled[shard] = filled.get(shard, 0) + 1
        run += size
    assert {r.id: (r.shard, r.slot) for r in got} == want


def test_equal_rows_are_cut_as_finely_as_others(spark):
    rows = spark.range(20_000).select(F.lit(1).cast("long").alias("id"), F.lit("g").alias("g"))
    got = sharding.shard_records(rows, F.col("g"), F.col("id"), F.lit(8), 24).groupBy("shard").count()
    sizes = [r["count"] for r in got.collect()]
    assert len(sizes) == 24 and max(sizes) - min(sizes) <= 1


def test_the_broadcast_bound_of_counts(spark):
    counts = [1] * 500 + [2] * 90 + list(range(900, 3000, 7)) + [10 ** 12 + 1, 10 ** 12 + 2]
    df = spark.createDataFrame([(n,) for n in counts], "n long")
    for room in (0, 1, 2, 50, 200, 350, 400, 10_000):
        least = ppm._least(df, room)
        held = sum(n >= least for n in counts)
        assert held <= room
        assert least == 1 or held + 95 > room  # the next group holds at most 90


def test_rules_on_odd_texts(spark):
    got = {(r.doc_id, r.n_words): r for r in divergence.judge(documents(spark)).collect()}
    assert got[(7, 3000)].n_repeat_words == 3000 and not got[(7, 3000)].kept
    # 'The cat sat on the' twice: five words, both times
    assert got[(4, 15)].n_dup_lines == 0 and got[(4, 15)].n_repeat_words == 10
    assert got[(0, 0)].base_failed and got[(None, 4)].base_failed
    kept = divergence.keep(documents(spark))
    assert kept.columns == documents(spark).columns
    assert divergence.judge(documents(spark).limit(0)).count() == 0


def test_classifier_learns_and_survives_no_labels(spark):
    good = ["the cat and the dog went to the sea with a boat number %d" % i for i in range(40)]
    bad = ["$$$ ### %% && BUY!! " * (i % 5 + 1) for i in range(40)]
    docs = documents(spark, good + bad)
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(80)] + [(999, 1), (3, None)],
                                   "doc_id long, quality int")
    featured = classifier.with_features(docs)
    model = classifier.fit(classifier.with_label(featured, labels, "quality"))
    rows = classifier.classify(featured, model).select("doc_id", "score", "predicted").collect()
    assert all(r.predicted == int(r.doc_id < 40) and 0 <= r.score <= 1 for r in rows)
    assert classifier.keep(docs, model).count() == 40
    none = classifier.fit(classifier.with_label(featured, labels.limit(0), "quality"))
    odd = classifier.classify(classifier.with_features(documents(spark)), none).collect()
    assert len(odd) == 12 and {r.score for r in odd} == {0.5}


def test_classifier_against_numpy(spark):
    """The fit from its definition: equations over all fitted rows at once and
    the isotonic fit by its min-max formula."""
    rng = np.random.default_rng(11)
    n = 1600
    x = rng.normal(size=(n, len(classifier.FEATURES)))
    x[:, 3] = 2.0  # no spread
    label = (x[:, 0] + 0.5 * rng.normal(size=n) > 0).astype(float)
    rows = spark.createDataFrame([(*map(float, r), v) for r, v in zip(x, label.tolist())],
                                 [*classifier.FEATURES, "label"]).repartition(5)
    model = classifier.fit(rows, features=32)
    back = {tuple(r[:-1]) for r in rows.withColumn("b", F.pmod(F.xxhash64(*classifier.FEATURES), F.lit(
        classifier.CALIBRATION)) == 0).where("b").drop("label").collect()}
    held = np.array([tuple(r) in back for r in x.tolist()])
    assert 100 < held.sum() < 600
    z = (x - x.mean(0)) / np.where(x.std(0) > 0, x.std(0), 1)
    draw = np.random.default_rng(7)
    w, b = draw.normal(size=(x.shape[1], 32)) / 3.0, draw.uniform(0, 2 * np.pi, 32)
    phi = np.column_stack([np.cos(np.clip(z, -8, 8) @ w + b) * np.sqrt(2 / 32), np.ones(n)])
    fit = phi[~held]
    ridge = np.linalg.solve(fit.T @ fit + 1e-4 * n * np.eye(33), fit.T @ label[~held])
    raw = phi @ ridge
    assert np.allclose(model.raw(x), raw, atol=1e-8)
    at = np.clip((raw + 0.5) * 500, 0, 999).astype(int)
    used = sorted(set(at[held]))
    sums = np.array([label[held & (at == i)].sum() for i in used])
    counts = np.array([(held & (at == i)).sum() for i in used])
    steps = [max(min(sums[a:c + 1].sum() / counts[a:c + 1].sum() for c in range(i, len(used)))
                 for a in range(i + 1)) for i in range(len(used))]
    want = np.interp(raw, -0.5 + (np.arange(1000) + 0.5) / 500, np.interp(np.arange(1000), used, steps))
    assert np.allclose(model.score(x), want, atol=1e-6)


def test_stages_keep_columns_that_clash_with_their_own(spark):
    names = ["n_words", "f_words", "score", "predicted", "w_0", "w_rest", "n_lower", "n_chars_read", "kept",
             "__words", "__lang", "__row", "base_failed", "__rest", "lang"]
    text = " ".join(f"word{i}" for i in range(120))
    docs = spark.createDataFrame([(1, text, *["mine"] * len(names)), (2, text + " end", *["mine"] * len(names))],
                                 ["doc_id", "text", *names])
    model = classifier.fit(classifier.with_label(classifier.with_features(docs.select("doc_id", "text")),
                                                 spark.createDataFrame([(1, 1), (2, 1)], ["doc_id", "quality"]), "quality"))
    for stay in (classifier.keep(docs, model), divergence.keep(docs), divergence.keep(docs, robust=True),
                 near_dedup.keep(docs)):
        assert stay.columns == docs.columns
        rows = stay.collect()
        assert rows and all(r[2:] == ("mine",) * len(names) for r in rows)


def test_rising_steps():
    got = classifier.rising(np.array([0, 2, 1, 3.0]), np.array([2, 2, 2, 3.0]))
    assert np.allclose(got, [0, 0.75, 0.75, 1])


def test_near_duplicates_against_all_pairs(spark):
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join(base)]
    for k in range(25):
        changed = list(base)
        for j in range(k % 9):
            changed[(j * 13 + k) % 120] = f"x{k}-{j}"
        texts.append(" ".join(changed))
    texts += [None, "", "few words", "FEW words", "other text entirely of five words"]
    got = {r.doc_id: r for r in near_dedup.near_duplicates(documents(spark, texts)).collect()}
    sets = []
    for t in texts:
        w = words(t)
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    assert {i: r.component_id for i, r in got.items()} == dict(enumerate(root))
    assert near_dedup.near_duplicates(documents(spark, texts).limit(0)).count() == 0
    assert near_dedup.near_duplicates(documents(spark)).where("doc_id is null and kept").count() == 1


def test_one_row_of_each_group_stays_and_null_ids_link(spark):
    a, b = [" ".join(f"{p}{i}" for i in range(300)) for p in "ab"]
    near = " ".join(["other", *a.split()[1:]])
    docs = spark.createDataFrame(
        [(None, a, "x"), (None, a, "x"), (None, a, "y"), (4, near, "z"), (None, b, "z"), (None, b, "z"),
         (None, None, "n"), (None, None, "n"), (6, "", "n"), (7, "e f", "k"), (7, "e f", "k"), (9, "e f", "k")],
        "doc_id long, text string, kept string")
    stay = near_dedup.keep(docs)
    assert stay.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text or "") for r in stay.collect()) == sorted(
        [(4, near), (-1, b), (-1, ""), (-1, ""), (6, ""), (7, "e f")])
    judged = near_dedup.near_duplicates(docs).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in judged)
    assert sorted((r.component_id or -1) for r in judged) == [-1] * 4 + [4] * 4 + [6] + [7] * 3


def test_a_hub_keeps_its_edges_and_every_component_its_least_node(spark):
    rng = np.random.default_rng(0)
    edges = [(0, i) for i in range(1, 5000)] + [(9000, i) for i in range(9001, 13000)] + [(4999, 9001)]
    edges += [(20_000 + i, 20_001 + i) for i in range(60)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components.components(
        spark.createDataFrame([(int(a), int(b)) for a, b in edges], "a long, b long")).collect()}
    assert got == {i: 0 if i < 20_000 else 20_000 for pair in edges for i in map(int, pair)}


def test_super_min_hash_estimates_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 62, 900, dtype=np.uint64)
    a, b = np.unique(pool[:600]), np.unique(pool[300:])
    same = near_dedup.super_min_hash(a, 512) == near_dedup.super_min_hash(b, 512)
    assert abs(same.mean() - 300 / 900) < 0.08
    assert np.isfinite(near_dedup.super_min_hash(a[:1], 64)).all()


def test_packing_round_trip(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.cut_documents(documents(spark), path, longest=64)
    packed = packing.bucket_sequences(pieces).collect()
    assert sorted(r.sequence_id for r in packed) == list(range(len(packed)))
    assert all(r.length & (r.length - 1) == 0 and r.offset == 0 for r in packed)
    ids = b"".join(r.ids for r in sorted((r for r in packed if r.doc_id == 4),
                                         key=lambda r: r.start))
    want = list(tokens.WordEncoder(path).encode(pa.array([TEXTS[4]])))[0] + b"\0\0\0\0"
    assert ids == want
    assert {r.doc_tokens for r in packed if r.doc_id in (0, 1)} == {1}


def test_contaminated_documents_only(spark):
    item = " ".join(f"b{i}" for i in range(30))
    near = item.split()
    near[7], near[20] = "changed", "words"
    texts = ["pre " * 11 + item + " post", "Pre, " * 10 + " ".join(near).upper() + "!", item[:30],
             None, "", "clean " * 50]
    items = spark.createDataFrame([(1, item), (2, "too short"), (3, None)],
                                  "item_id long, text string")
    got = {r.doc_id: r for r in decontamination.flag(documents(spark, texts), items).collect()}
    assert [got[i].contaminated for i in range(6)] == [True, True] + [False] * 4
    assert got[0].worst_item == 1
    assert decontamination.clean(documents(spark, texts), items).count() == 4
    assert decontamination.clean(documents(spark, texts), items.limit(0)).count() == 6


def test_partial_matching_against_plain_python(spark):
    docs = documents(spark).select("doc_id", "text", (F.col("doc_id") == 4).alias("held_out"))
    got = ppm.train(docs.where("coalesce(held_out, false) = false")).score(docs).collect()
    texts = [(i, t or "") for i, t in enumerate(TEXTS)] + [(None, "no id at all"), (8, TEXTS[8])]
    train = [t for i, t in texts if i != 4]
    counts = Counter(w for t in train for w in words(t) + [None])
    whole = sum(counts.values()) + len(counts) + 1
    seen = defaultdict(Counter)
    for t in train:
        b = b"\xff\xff" + t.encode() + b"\xff"
        for k in range(2, len(b)):
            for o in range(3):
                seen[b[k - o:k]][b[k]] += 1
    b = b"\xff\xff" + TEXTS[4].encode() + b"\xff"
    want = 0.0
    for k in range(2, len(b)):
        escape, offered = 1.0, set()
        for ctx in (b[k - 2:k], b[k - 1:k], b""):
            left = {s: n for s, n in seen[ctx].items() if s not in offered}
            if not left:
                continue
            total = sum(left.values()) + len(left)
            if b[k] in left:
                want += math.log10(escape * left[b[k]] / total)
                break
            escape *= len(left) / total
            offered |= set(left)
        else:
            want += math.log10(escape / (256 - len(offered)))
    row = next(r for r in got if r.doc_id == 4)
    assert len(got) == len(texts)
    assert row.score == pytest.approx(want, rel=1e-5)
    tokens_4 = words(TEXTS[4]) + [None]
    assert row.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / whole)
                                               for w in tokens_4))
    assert (row.n_tokens, row.n_known) == (len(tokens_4), sum(counts[w] > 0 for w in tokens_4))
    assert ppm.train(docs.limit(0)).score(docs.limit(0)).count() == 0


def test_files_and_index_round_trip(spark, scratch):
    docs, path = documents(spark), public_tokenizers.path("word_bpe_49k.json")
    placed = token_files.write_token_files(docs, path, f"{scratch}/ids", 1, 3, 2)
    totals = token_files.shard_totals(placed)
    files = token_files.build_index(placed, f"{scratch}/ids")
    keys = docs.select("doc_id").unionByName(spark.createDataFrame([(12345,)], "doc_id long"))
    found = token_files.find_documents(keys, f"{scratch}/ids", files)
    got = token_files.with_start(spark, token_files.fetch(found, f"{scratch}/ids", totals), totals)
    rows = sorted((r.start, r.doc_id, bytes(r.ids)) for r in got.collect())
    order = [(None, "no id at all")] + sorted(
        [(i, t) for i, t in enumerate(TEXTS)] + [(8, TEXTS[8])], key=lambda x: x[0])
    encoded = list(tokens.WordEncoder(path).encode(pa.array([t for _, t in order], pa.string())))
    at, want = 0, []
    for (i, _), raw in zip(order, encoded):
        raw += tokens.id_bytes([1])
        want.append((at, i, raw))
        at += len(raw) // 4
    assert rows == want


def test_perfect_hash_is_minimal():
    keys = token_files.key_hash(np.arange(5000) * 7, np.zeros(5000, bool))
    held = token_files.PerfectHash.build(keys)
    assert sorted(held.slots(keys)) == list(range(5000))


@pytest.mark.parametrize("in_rows", [True, False])
def test_url_rules(spark, in_rows, monkeypatch):
    monkeypatch.setattr(url_rules, "ROW_RULES", 64 if in_rows else 0)
    urls = [None, "no scheme", "http://A.Example.org/es/1?x", "http://example.org/en/12",
            "http://example.org", "http://x.com/fr/#a", "http://notexample.org/es/",
            "http://m.spam-farm.net/", "http://spam-farm.example.org/en/2"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls + urls[2:3])],
                                  "page_id long, url string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge(pages).collect()}
    assert got == {
        0: ("", "", None, "allow"), 1: ("", "", None, "allow"),
        2: ("a.example.org", "/es/1", "example.org/es/", "block"),
        3: ("example.org", "/en/12", "example.org/en/1", "block"),
        4: ("example.org", "", None, "allow"), 5: ("x.com", "/fr/", "com/fr/", "allow"),
        6: ("notexample.org", "/es/", "org/", "allow"),
        7: ("m.spam-farm.net", "/", None, "block"),
        8: ("spam-farm.example.org", "/en/2", "org/", "allow"),
        9: ("a.example.org", "/es/1", "example.org/es/", "block")}
    assert url_rules.judge(pages.limit(0)).count() == 0


def test_many_rules_over_a_hot_url_both_ways(spark, monkeypatch):
    rules = url_rules.default_rules() + [
        url_rules.listed("block" if i % 2 else "allow", f"h{i % 7}.net/a{i}/") for i in range(50)]
    pages = spark.range(6000).select("id", F.when(F.col("id") % 2 == 0, F.lit("http://h1.net/a1/x"))
                                     .otherwise(F.format_string("http://h%s.net/a%s/y", F.col("id") % 7,
                                                                F.col("id") % 60)).alias("url"))
    in_rows = list(map(tuple, url_rules.judge(pages, rules).collect()))
    monkeypatch.setattr(url_rules, "ROW_RULES", 0)
    by_url = list(map(tuple, url_rules.judge(pages, rules).collect()))
    assert len(in_rows) == 6000 and len({r[-2] for r in in_rows}) > 20
    assert sorted(by_url, key=lambda r: r[0]) == sorted(in_rows, key=lambda r: r[0])


def test_preference_pairs(spark):
    schema = "conv_id long, turn long, role string, text string"
    chosen = spark.createDataFrame(
        [(1, 0, "user", "q"), (1, 0, "user", "q"), (1, 1, "assistant", "good"), (2, 0, "user", None),
         (None, 0, "user", "lost"), (1, None, "user", "lost")], schema)
    rejected = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "bad"),
                                      (1, 2, "user", "more"), (2, 0, "user", None)], schema)
    got = sorted((r.pair_id, r.part, r.turn, r.rendered, r.trained, r.prompt_turns) for r in
                 preference.format_pairs(chosen, rejected, "conv_id").collect())
    assert got == [(1, "chosen", 1, "<|assistant|>\ngood\n", True, 1),
                   (1, "prompt", 0, "<|user|>\nq\n", False, 1),
                   (1, "rejected", 1, "<|assistant|>\nbad\n", True, 1),
                   (1, "rejected", 2, "<|user|>\nmore\n", False, 1),
                   (2, "prompt", 0, "<|user|>\n\n", False, 1)]
    assert preference.format_pairs(chosen.limit(0), rejected.limit(0), "conv_id").count() == 0
