import pyarrow as pa

from ledgermill.llm import language_id
from ledgermill.llm.queries import op6_language_id

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = op6_language_id(spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/documents.parquet"), "doc_id").where("held_out").collect()
    assert len(rows) > 100
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_edge_rows_and_clashing_columns(spark):
    train = spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "en"), ("le chat", None)], "text string, lang string")
    model = language_id.learn(train)
    assert model.languages == ["de", "en"]
    texts = [(1, None), (2, ""), (3, "123 !!"), (4, "the dog the cat " * 20000), (5, "und die"), (5, "und die"), (6, "漢字 𝒳")]
    frame = spark.createDataFrame([(i, t, "was", 9.0) for i, t in texts], "doc_id long, text string, lang_pred string, score double")
    rows = sorted((r["doc_id"], r["lang_pred"], r["score"] > 0.5) for r in language_id.predict(frame, model).collect())
    assert rows == [(1, "und", False), (2, "und", False), (3, "und", False), (4, "en", True), (5, "de", True), (5, "de", True), (6, "de", False)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = language_id.learn(none)
    assert model.languages == []
    assert language_id.predict(none, model).collect() == []
    one = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    assert language_id.predict(one, model).head()["lang_pred"] == "und"


def test_more_languages_than_bits_of_a_word(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = {f"l{k:03}": " ".join([letters[k % 26] + letters[k // 26] + x for x in "xyzvw"]) for k in range(130)}
    model = language_id.learn(spark.createDataFrame([(t, l) for l, t in words.items()], "text string, lang string"))
    assert len(model.languages) == 130 and model.slots.shape[0] == 3
    lang, score = language_id.judge(model, pa.array(list(words.values())))
    assert lang == list(words) and score.min() > 0.9


def test_texts_reach_the_workers_in_small_batches(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(name)
    frame = spark.range(400, numPartitions=1).selectExpr("repeat(sha2(string(id), 256), 800) AS text", "'xx' AS lang")  # 51 KB each
    judged = language_id.predict(frame, language_id.learn(frame))

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes])], ["n"])

    assert judged.where("score = 1").count() == 400
    largest = judged.mapInArrow(sizes, "n long").agg({"n": "max"}).head()[0]
    spark.conf.unset(name)
    assert largest < 8 << 20  # all texts of a task at once, before
