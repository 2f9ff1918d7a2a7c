"""What the operators left out before: each case here is found by plain Python."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

pytest.importorskip("casetrace.llm")
pytest.importorskip("corpus_pipeline")

import corpus_pipeline as P  # noqa: E402
from casetrace.llm import decontamination, divergence, near_dedup, ppm  # noqa: E402
from casetrace.llm.common import table  # noqa: E402
from test_text_operators import words  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, lang="en"):
    return spark.createDataFrame([(i, t, lang, "s", len(t)) for i, t in enumerate(texts)], DOCS)


def least_of_group(texts, percent):
    """Least index reachable over links of ``percent``, from all pairs."""
    sets = []
    for t in texts:
        w = words(t)
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)})
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


def test_near_duplicate_stage_links_at_80_per_cent(spark):
    rng = random.Random(3)
    texts = []
    for g in range(40):
        base = [f"w{rng.randrange(10 ** 6)}" for _ in range(200)]
        texts.append(" ".join(base))
        for changes in (3, 4, 5, 6):  # Jaccard 0.86, 0.81, 0.77 and 0.73 where they lie apart
            other = list(base)
            for k in range(changes):
                other[10 + 30 * k] = f"x{g}-{changes}-{k}"
            texts.append(" ".join(other))
    docs = documents(spark, texts)
    for percent, stage in ((80, P.near_duplicates(spark, docs, "")),
                           (85, near_dedup.keep(docs, 85))):
        want = [i for i, r in enumerate(least_of_group(texts, percent)) if i == r]
        assert sorted(r.doc_id for r in stage.select("doc_id").collect()) == want
    assert near_dedup.banding(85) == (24, 6)
    for percent in (80, 85):
        bands, rows = near_dedup.banding(percent)
        assert (1 - (percent / 100) ** rows) ** bands < 1.3e-5


def prose(spark, lang):
    """Distinct documents of a language that pass the base rules and are labelled good."""
    docs = table(spark, SF, "documents").where(F.col("lang") == lang)
    good = table(spark, SF, "labels").where("quality = 1").select("doc_id")
    passing = divergence.judge(docs).where("not base_failed").select("doc_id")
    return docs.join(good, "doc_id", "left_semi").join(passing, "doc_id", "left_semi").select(
        "doc_id", "text", "lang", "source", "n_chars")


def kept_ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_a_third_of_copies_of_junk_rejects_no_clean_document(spark):
    clean = prose(spark, "en")
    ids = kept_ids(clean)
    junk = " ".join(f"{i * 7919}#{i}$" for i in range(2000))
    copies = spark.range(10 ** 6, 10 ** 6 + len(ids) // 2).select(
        "id", F.lit(junk), F.lit("en"), F.lit("s"), F.lit(len(junk)).cast("long"))
    docs = clean.unionAll(copies)
    assert len(ids) > 20
    assert kept_ids(P.quality_rules(spark, docs, "")) == ids
    assert kept_ids(divergence.judge(docs, robust=True).where("kept")) == ids
    assert not ids & kept_ids(divergence.judge(docs).where("kept"))  # the plain sum


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0d]+", re.sub(r"[.,;:!?\"'()\[\]]+", "", (text or "").lower()))


def shares_a_run(doc, items):
    """The rule itself: some aligned run of 13 words, or a whole shorter item,
    of which four fifths agree."""
    for item in items:
        width = min(13, len(item))
        for a in range(len(item) - width + 1 if item else 0):
            for b in range(len(doc) - width + 1):
                same = sum(map(str.__eq__, item[a:a + width], doc[b:b + width]))
                if 5 * same >= 4 * width:
                    return True
    return False


def test_every_run_of_the_rule_is_found_at_every_phase(spark):
    widths = [2, 4, 5, 7, 8, 9, 10, 11, 12, 13, 20]
    items = [[f"i{n}w{k}" for k in range(n)] for n in widths]
    docs = []
    for item in items:
        run = item[-13:]
        for changes in range(4):
            if changes > len(run):
                continue
            for n, places in enumerate(itertools.combinations(range(len(run)), changes)):
                if changes == 3 and n % 7:
                    continue
                phases = range(3) if changes < 2 else [n % 3]
                docs += [["pre"] * phase + ["x" if k in places else w for k, w in enumerate(run)]
                         + ["post"] * 3 for phase in phases]
    got = kept_ids(decontamination.flag(
        documents(spark, [" ".join(d) for d in docs]), spark.createDataFrame(
            [(n, " ".join(i)) for n, i in enumerate(items)] + [(99, ""), (100, None)],
            "item_id long, text string")).where("contaminated"))
    want = {n for n, d in enumerate(docs) if shares_a_run(d, items)}
    assert len(docs) > 500 and 100 < len(want) < len(docs) - 50
    assert got == want


@pytest.mark.parametrize("room", [0, 40, 1 << 19])
def test_contexts_of_four_bytes_against_plain_python(spark, monkeypatch, room):
    monkeypatch.setattr(ppm, "COMMON_GRAMS", room)
    train = ["the cat sat on the mat", "the dog sat on the cat", "a that then this", "", "é ü é"] * 2
    asked = ["the cat sat on the mat", "the dot sag on thé cap", "zzz qqq", "", "a thas", "üé the"]
    docs = documents(spark, train + asked).select(
        "doc_id", "text", (F.col("doc_id") >= len(train)).alias("held_out"))
    got = {r.doc_id: r.score for r in ppm.train(docs.where("not held_out"), 4).score(docs).collect()}
    seen = defaultdict(Counter)
    for t in train:
        b = b"\xff" * 4 + t.encode() + b"\xff"
        for k in range(4, len(b)):
            for o in range(5):
                seen[b[k - o:k]][b[k]] += 1
    for i, t in enumerate(train + asked):
        b, want = b"\xff" * 4 + t.encode() + b"\xff", 0.0
        for k in range(4, len(b)):
            escape, offered = 1.0, set()
            for o in range(4, -1, -1):
                left = {s: n for s, n in seen[b[k - o:k]].items() if s not in offered}
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
        assert got[i] == pytest.approx(want, rel=1e-5)
    assert ppm.train(docs.limit(0), 4).score(docs).count() == len(got)
    assert ppm.train(docs.limit(0), 4).score(docs.limit(0)).count() == 0


def test_different_texts_under_one_id_are_judged_each_for_itself(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    docs = spark.createDataFrame(
        [(1, a), (7, a), (7, b), (8, b + " end"), (9, c), (9, c + " end")], "doc_id long, text string")
    for stage in (near_dedup.keep(docs, 80), near_dedup.keep(docs)):
        got = sorted((r.doc_id, r.text[0]) for r in stage.collect())
        assert got == [(1, "a"), (7, "b"), (9, "c")]
    assert near_dedup.keep(docs.where("doc_id in (7, 8)")).count() == 2


def test_a_language_without_word_list_has_its_own_reference(spark):
    latin = [" ".join(f"parola{chr(97 + (i * k) % 26)} bella{k}" for k in range(60)) for i in range(27)]
    cyrillic = [" ".join(f"слово{chr(1072 + (i * k) % 26)} мир{k}" for k in range(60)) for i in range(3)]
    docs = documents(spark, latin, "it").unionAll(documents(spark, cyrillic, "ru")).unionAll(
        documents(spark, cyrillic, None))
    assert divergence.keep(docs).where("lang = 'ru' or lang is null").count() == 0  # the pooled sum
    assert P.quality_rules(spark, docs, "").count() == docs.count()


def test_decontamination_stage_against_the_rule(spark):
    docs = table(spark, SF, "documents")
    items = [plain_words(r.text) for r in table(spark, SF, "benchmark").collect()]
    # two differences in 13 words leave four neighbours whole; no item is shorter here
    assert min(map(len, items)) >= 13
    fours = {tuple(i[k:k + 4]) for i in items for k in range(len(i) - 3)}
    want = set()
    for r in docs.collect():
        doc = plain_words(r.text)
        near = [k for k in range(len(doc) - 3) if tuple(doc[k:k + 4]) in fours]
        if not any(shares_a_run(doc[max(0, k - 13):k + 17], items) for k in near):
            want.add(r.doc_id)
    assert kept_ids(P.benchmark_decontamination(spark, docs, SF)) == want
    assert len(want) < docs.count()


def test_core_filter_spares_seeds_and_loses_none(spark):
    """Only windows whose always-kept words are in an item get hashed under
    every mask, and every seed of an item's own text is still found."""
    from pyspark.sql import functions as F
    items = table(spark, SF, "benchmark").select("item_id", "text")
    seeds, widths = decontamination.index(items)
    words = decontamination.word_hashes(F.col("text"))
    known = {r["h"] for r in decontamination._core_seeds(seeds, widths).collect()}

    def seeds_of(core_passes):
        made = items.select(F.explode(decontamination._windows(
            words, widths, lambda h: F.lit(True), core_passes)).alias("s")).select("s.*")
        return sorted(map(tuple, made.collect()))
    every = seeds_of(None)
    assert every and seeds_of(lambda h: h.isin(*known)) == every
    assert not seeds_of(lambda h: F.lit(False))
