import math

import pyarrow as pa
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from placefolio.llm import lm_score, quality
from placefolio.llm.common import fold, table

SF = "/root/testdata/sf0.001"


def training(spark, docs, labels):
    """``(text, label)`` of the labelled rows outside fold 0 in the seeded order."""
    turn = F.xxhash64(F.lit(quality.SEED), "doc_id")
    wanted = (labels.where(fold("doc_id", 5) != 0).where(F.col("quality").isin(0, 1)).groupBy("doc_id")
              .agg(F.min("quality").alias("label")).withColumn("turn", turn).orderBy("turn", "doc_id").limit(quality.MAX_TRAIN))
    rows = docs.select("doc_id", "text").join(wanted, "doc_id").collect()

    def index(text):
        (i, _), = quality.features(pa.array([text], pa.string()))
        return i.tobytes()

    return [(r["text"], r["label"]) for r in sorted(rows, key=lambda r: (r["turn"], r["label"], index(r["text"])))]


def test_quality_matches_the_updates_written_out(spark, docs):
    texts = [f"Good text number {i} with some words and more, fine." if i % 3 else f"BUY now {i} $$$ !!! BUY" for i in range(60)]
    rows = [*enumerate(texts), (60, None), (61, ""), (3, texts[3]), (None, "good words")]
    df = docs(rows)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(50)] + [(7, 0, 1), (60, 0, 0), (62, 1, 0), (4, None, 0), (5, 2, 0)],
                                   "doc_id long, quality int, toxic int")
    got = quality.score_documents(df, labels).collect()
    want = dict(zip([t for _, t in rows], brute.ftrl_scores([t for _, t in rows], training(spark, df, labels))))
    text = {(r["doc_id"]): r["text"] for r in df.collect()}
    assert len(got) == len(rows) and len({round(r["score"], 4) for r in got}) > 10
    for r in got:
        assert abs(r["score"] - want[text[r["doc_id"]]]) < 1e-5 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == bool(lm_score.in_fold(pa.chunked_array([pa.array([r["doc_id"]], pa.int64())]), 5, 0)[0])


    kept = {r["text"] for r in quality.drop_low_quality(df, labels).collect()}
    assert kept == {t for t, p in want.items() if p >= 0.3} and len(kept) < len(want) - 10


def test_features_count_grams():
    text = "a b a b c\tA b"
    (index, value), = quality.features(pa.array([text]))
    grams, _ = brute.sorted_values(text, 2)
    assert index[-1] == 0 and value[-1] == 1.0 and abs(math.sqrt(float(value[:-1] @ value[:-1])) - 1) < 1e-6
    # The counts of words and pairs are among the values, next to those of shapes.
    scale = max(value[:-1]) / max(math.log1p(brute.words(text).count("b")), max(grams), math.log1p(7))
    assert len(index) - 1 >= len(grams) and scale > 0
    (bias, one), = quality.features(pa.array(["  "]))
    assert bias.tolist() == [0] and one.tolist() == [1.0]


def test_whole_run_matches_brute_force(spark):
    """Every stage decides as its definition does, on what the stage before has left, and so does the whole run."""
    documents, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    row = {r["doc_id"]: r for r in documents.collect()}
    ids = sorted(row)
    scores = brute.ftrl_scores([row[i]["text"] for i in ids], training(spark, documents, labels))
    assert min(abs(s - quality.THRESHOLD) for s in scores) > 1e-4
    left = {i: row[i]["text"] for i, s in zip(ids, scores) if s >= quality.THRESHOLD}
    sizes = [len(left)]
    left = {i: left[i] for i in brute.first_of_equal(left)}
    sizes.append(len(left))
    left = {i: left[i] for i in brute.first_of_near(left, 80)}
    sizes.append(len(left))
    from test_filters import brute_contaminated
    items = [r["text"] for r in table(spark, SF, "benchmark").collect()]
    left = {i: t for i, t in left.items() if not any(brute_contaminated(t, b) for b in items)}
    sizes.append(len(left))
    # The comparison is not empty. So few labels reject nothing at 0.3; the test above has documents that are rejected.
    assert len(row) >= sizes[0] > sizes[1] > sizes[2] > sizes[3] > 0
    taken = brute.repetitions({i: (row[i]["source"], t) for i, t in left.items()})
    rows = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r["doc_id"], r["repetition"]) for r in rows) == sorted((i, k) for i, n in taken.items() for k in range(1, n + 1))
    assert all(r["text"] == row[r["doc_id"]]["text"] for r in rows)


def test_stages_of_an_empty_table(spark):
    left = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, SF)
        assert left.columns == table(spark, SF, "documents").columns and left.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, left, SF).count() == 0


def test_stages_of_odd_rows(spark, odd):
    left, ids = odd, {r["doc_id"] for r in odd.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, SF)
        assert left.columns == odd.columns and {r["doc_id"] for r in left.collect()} <= ids
    last = corpus_pipeline.STAGES[-1][1](spark, left, SF)
    assert last.columns == [*odd.columns, "_repetition"]
