import random

import corpus_pipeline
from corpusflow.llm import shingles
from corpusflow.session import bound_batches, stored
from tests.llm.conftest import make_documents


def test_stages_decide_as_their_operators(spark, sf_dir):
    """Each stage against the operator it calls, and the rules that hold for its result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, docs, sf_dir), "stage")
        assert after.columns == columns and after.schema == docs.schema
        assert after.join(docs, "doc_id", "left_anti").count() == 0
        if name != "suffix-array dedup":
            assert after.exceptAll(docs).count() == 0
        n = after.count()
        assert 0 < n <= before
        docs, before = after, n
    assert docs.where("n_chars <> char_length(text)").count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.select("doc_id").distinct().count() == before


def test_odd_rows_pass_every_stage(spark, documents, no_documents, sf_dir):
    for docs in (documents, no_documents):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, sf_dir).count()


def test_near_duplicates_keep_one_and_rows_without_id(spark, documents):
    kept = corpus_pipeline.drop_near_duplicates(spark, documents, "").collect()
    ids = [r.doc_id for r in kept]
    assert 3 in ids and 33 not in ids and 34 not in ids and ids.count(None) == 2


def test_near_duplicates_are_those_with_most_five_word_shingles_in_common(spark):
    """Every pair at 0.8 or more is linked, none below, though a crowd of edited copies is many bits apart."""
    rng = random.Random(11)
    rows = []
    for k in range(60):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([6, 40, 200]))]
        rows.append((10 * k, " ".join(words), "en"))
        for j in range(1, 4):
            changed = list(words)
            for at in rng.sample(range(len(words)), min(len(words) - 1, rng.randrange(1, max(2, len(words) // 25)))):
                changed[at] = "new" + str(rng.randrange(5000))
            rows.append((10 * k + j, " ".join(changed), "en"))
    sets = {i: {tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)} for i, t, _ in rows}
    label = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = label[a], label[b]
                label = {i: min(x, y) if c in (x, y) else c for i, c in label.items()}
    kept = corpus_pipeline.drop_near_duplicates(spark, make_documents(spark, rows), "").select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(label.values()))
    assert 60 < len(kept) < len(rows)


def test_pairs_to_verify_grow_with_a_crowd_not_with_its_square(spark, monkeypatch):
    """Copies of a template, each with a passage of its own: most are 0.6 to 0.79 alike, some 0.8 or more."""
    rng = random.Random(5)
    template = [f"t{i}" for i in range(150)]
    rows = []
    for k in range(400):
        words, at, n = list(template), rng.randrange(4, 120), 4 if k % 40 == 0 else rng.choice([9, 12, 14])
        words[at : at + n] = [f"own{k}x{j}" for j in range(n)]
        rows.append((k, " ".join(words), "en"))
    sets = {i: {tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)} for i, t, _ in rows}
    label = {i: i for i in sets}
    links = 0
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                links += 1
                x, y = label[a], label[b]
                label = {i: min(x, y) if c in (x, y) else c for i, c in label.items()}
    verified, counts = shingles.verified, []

    def counting(pairs, *args):
        pairs = stored(pairs, "pairs")
        counts.append(pairs.count())
        return verified(pairs, *args)

    monkeypatch.setattr(shingles, "verified", counting)
    kept = corpus_pipeline.drop_near_duplicates(spark, make_documents(spark, rows), "").select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(label.values()))
    assert len(set(label.values())) > 100 and links > 10
    assert counts[-1] <= links + 10 * len(rows)


BOUND = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_near_duplicates_send_texts_to_python_in_small_batches(spark, tmp_path, monkeypatch):
    """No batch of texts, nor of compressed words, is much over 4 MB, in a partition of many times that."""
    noted, cut = str(tmp_path / "bytes"), shingles.slices

    def noting(batches, *args):
        def seen():
            for batch in batches:
                with open(noted, "a") as f:
                    f.write(f"{batch.nbytes}\n")
                yield batch

        return cut(seen(), *args)

    monkeypatch.setattr(shingles, "slices", noting)
    spark.conf.unset(BOUND)
    words = "concat_ws(' ', transform(sequence(1, 150), i -> sha2(concat(id, '-', i), 256)))"
    docs = spark.range(0, 2000, 1, 1).selectExpr("id AS doc_id", f"{words} AS text", "'en' AS lang", "'s' AS source", "9750L AS n_chars")
    try:
        kept = dict(corpus_pipeline.STAGES)["SimHash near-dedup"](spark, stored(docs, "docs"), "")
        assert kept.count() == 2000
    finally:
        spark.conf.unset(BOUND)
    with open(noted) as f:
        found = [int(line) for line in f]
    assert sum(found) > 19_000_000 and max(found) < 5 << 20


def test_a_bound_of_the_session_stays(spark):
    spark.conf.set(BOUND, "1m")
    try:
        bound_batches(spark)
        assert spark.conf.get(BOUND) == "1m"
    finally:
        spark.conf.unset(BOUND)


def test_cut_repeats_takes_one_worker_a_task(spark):
    """No stage of the plan that is left to the caller goes to Python twice; a cut character goes whole."""
    passage = " ".join(f"né{i}" for i in range(60))
    docs = make_documents(spark, [(1, "é" + passage, "fr"), (2, "©" + passage + " fin", "fr")])  # both characters end in the byte A9
    cut = corpus_pipeline.cut_repeats(spark, docs, "")
    assert "EvalPython" not in cut._jdf.queryExecution().executedPlan().toString()
    assert {r.doc_id: r.text for r in cut.collect()} == {1: "é" + passage, 2: " fin"}
