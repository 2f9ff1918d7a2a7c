"""The pipeline stage by stage over whole small tables, each stage against a
plain re-computation on what its predecessor kept."""

import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

pytest.importorskip("casetrace.llm")
pytest.importorskip("corpus_pipeline")
import public_tokenizers  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

import corpus_pipeline as P  # noqa: E402
from casetrace.llm import classifier, decontamination, divergence, tokens  # noqa: E402
from casetrace.llm.common import held_out, table  # noqa: E402
from test_text_operators import words  # noqa: E402

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def components(rows):
    """Least id reachable over links of 80 per cent, from all pairs that share a shingle."""
    sets, holders = {}, defaultdict(list)
    for r in rows:
        w = words(r.text)
        sets[r.doc_id] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
        for s in sets[r.doc_id]:
            holders[s].append(r.doc_id)
    pairs = {(a, b) for ids in holders.values() for a in ids for b in ids if a < b}
    root = {i: i for i in sets}
    for a, b in sorted(pairs):
        both = len(sets[a] & sets[b])
        if 100 * both >= 80 * len(sets[a] | sets[b]):
            low, high = sorted((root[a], root[b]))
            root = {i: low if r == high else r for i, r in root.items()}
    return root


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """(input rows, output rows) of every stage over all documents."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs, out = table(spark, SF, "documents"), {}
    for k, (name, stage) in enumerate(P.STAGES):
        path = str(folder / str(k))
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        out[name] = (docs, after)
        docs = after
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_all_but_the_last_stage_return_the_columns_of_documents(stages):
    for name, _ in P.STAGES[:-1]:
        assert stages[name][1].columns == COLUMNS
        assert set(map(tuple, stages[name][1].collect())) <= set(map(tuple, stages[name][0].collect()))


def test_classifier_stage_drops_what_the_classifier_rejects(spark, stages):
    before, after = stages["quality classifier"]
    featured = classifier.with_features(before)
    labels = table(spark, SF, "labels")
    model = classifier.fit(classifier.with_label(
        featured.where(~held_out(F.col("doc_id"), 5, 0)), labels, "quality"))
    # the model is summed over partitions in any order, so scores at the threshold may differ
    judged = classifier.classify(featured, model).select("doc_id", "score").collect()
    kept = set(ids(after))
    assert all((r.doc_id in kept) == (r.score >= classifier.THRESHOLD)
               for r in judged if abs(r.score - classifier.THRESHOLD) > 1e-6)
    quality = {r.doc_id: r.quality for r in labels.collect()}
    good = [r.doc_id for r in judged if quality.get(r.doc_id) == 1]
    assert sum(i in kept for i in good) >= 0.95 * len(good)


def test_rules_stage_keeps_what_the_rules_keep(stages):
    before, after = stages["quality rules"]
    assert ids(after) == ids(divergence.judge(before).where("kept"))
    for r in after.collect():
        assert len(words(r.text)) >= 50


def test_near_duplicate_stage_against_all_pairs(stages):
    before, after = stages["near duplicates"]
    root = components(before.collect())
    assert ids(after) == sorted(i for i, r in root.items() if i == r)
    assert len(ids(after)) < len(root)


def test_decontamination_stage_drops_flagged_documents_only(spark, stages):
    before, after = stages["benchmark decontamination"]
    flagged = decontamination.flag(before, table(spark, SF, "benchmark"))
    assert ids(after) == ids(flagged.where("not contaminated"))


def test_packing_stage_holds_every_id_once(stages):
    before, after = stages["packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    pieces = defaultdict(list)
    for r in after.collect():
        assert r.offset == 0 and 0 < r.length <= 1024 and r.length & (r.length - 1) == 0
        pieces[r.doc_id].append(r)
    assert sorted(pieces) == ids(before)
    for doc in before.collect():
        want = tokenizer.encode(doc.text or "", add_special_tokens=False).ids + [0]
        at = 0
        for r in sorted(pieces[doc.doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(want)
            assert r.ids_crc32 == zlib.crc32(tokens.id_bytes(want[at:at + r.length]))
            at += r.length
        assert at == len(want)
    sequences = [r.sequence_id for rs in pieces.values() for r in rs]
    assert sorted(sequences) == list(range(len(sequences)))


def test_odd_documents_pass_through_every_stage(spark, stages):
    """Nulls in every column, blank texts, repeated rows and a further column
    named like an output: blank texts fail the rules, nothing crashes."""
    text = " ".join(f"the cat and dog number {i} went to sea" for i in range(20))
    docs = spark.createDataFrame(
        [(None, None, None, None, None, "x"), (1, "", "en", "s", 0, "x"), (2, " \n", "xx", None, 2, None),
         (3, text, "en", "s", 9, "x"), (3, text, "en", "s", 9, "x"), (None, text + " end", "en", "s", 9, "x")],
        "doc_id long, text string, lang string, source string, n_chars long, kept string")
    rules = divergence.keep(docs)
    assert rules.columns == docs.columns
    assert rules.where("text is null or trim(text) = ''").count() == 0
    for _, stage in P.STAGES:
        assert stage(spark, docs, SF).count() >= 0
        assert stage(spark, docs.limit(0), SF).count() == 0
    dedup = P.near_duplicates(spark, docs, SF)
    assert dedup.columns == docs.columns
    # one of the two equal rows goes; the text without an id is 0.97 like theirs and goes too
    assert sorted((r.doc_id or -1, r.text or "") for r in dedup.collect()) == [
        (-1, ""), (1, ""), (2, " \n"), (3, text)]
