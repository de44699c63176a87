import base64

import public_tokenizers
import test_decontaminate
import test_line_dedup
import test_ngram_join
import tiktoken

import corpus_pipeline
from ledgermill.llm import language_id

FOLDER = "/root/testdata/sf0.001"


def test_run_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    docs = [(d, t) for d, t in docs if t and any(c.isalpha() for c in t)]
    lines = test_line_dedup.brute(docs)
    docs = [(d, text) for d, (text, _, gone) in lines.items() if not gone or text.strip()]
    docs_by_id = dict(docs)
    docs = [(d, docs_by_id[d]) for d, _, c in test_ngram_join.brute(docs) if c == d]
    items = [test_decontaminate.shingles(r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    docs = [(d, t) for d, t in docs if not any(i and 10 * test_decontaminate.held(i, t) >= 8 * len(i) for i in items)]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    truth = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((d, len(ids := truth.encode_ordinary(t)), b"".join(i.to_bytes(4, "little") for i in ids)) for d, t in docs)
    got = sorted((r["doc_id"], r["n_tokens"], bytes(r["ids"])) for r in corpus_pipeline.run(spark, FOLDER).collect())
    assert got == want and 50 < len(got) < 200


def test_stages_keep_columns_and_take_odd_rows(spark):
    text = "der hund und die katze gehen heute in den garten"
    rows = [(1, text, "de", None, 5, 1.5), (1, text, "de", "a", 5, 1.5), (None, text, "de", "a", 5, 1.5), (2, None, None, "b", 0, None), (3, "", "en", "b", 0, 2.0), (4, "42 %%", "en", "b", 3, 2.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for frame in (docs, docs.limit(0)):
            out = stage(spark, frame, FOLDER)
            assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
            kept = out.collect()
            assert len(kept) == (0 if frame is not docs else 3 if stage is corpus_pipeline.identify_language else 6)


def test_language_stage_rejects_what_was_not_learned(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = [
        (9001, "to jest zdanie po polsku bez znaczenia"), (9002, "это предложение на русском языке"),
        (9003, "xqzv kjwq zzxq pqkx vvkq"), (9004, "QmFzZTY0IGVuY29kZWQganVuayB0ZXh0 aGVsbG8gd29ybGQgdGhpcyBpcyBh"),
    ]
    rows = spark.createDataFrame([(i, t, None, "x", len(t), 0.25) for i, t in odd] + [(9005, "der, the. de la, und le que", None, "x", 26, 0.5)], "doc_id long, text string, lang string, source string, n_chars int, score double")
    both = docs.unionByName(rows, allowMissingColumns=True)
    got = corpus_pipeline.identify_language(spark, both, FOLDER).collect()
    lettered = {r["doc_id"] for r in docs.collect() if r["text"] and any(c.isalpha() for c in r["text"])}
    kept = {r["doc_id"] for r in got}
    assert kept - {9005} == lettered  # every labelled row stays
    assert all(r["score"] in (None, 0.5) for r in got)  # a column of the documents, not the stage's own


def test_threshold_lies_between_own_and_other_scores(spark):
    train = spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "en"), ("12", "fr")], "text string, lang string")
    model = language_id.learn(train)
    assert 0.2 < language_id.threshold(train, model) < 1
    assert language_id.threshold(train.limit(0), language_id.learn(train.limit(0))) > 0


def test_line_stage_keeps_columns_of_its_own_names(spark):
    rows = [(1, "a line of some words here\nshort", 77, 5), (2, "a line of some words here", 78, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines int, n_removed int")
    got = {r["doc_id"]: tuple(r) for r in corpus_pipeline.dedup_lines(spark, docs, FOLDER).collect()}
    assert got == {1: rows[0]}


def test_items_are_found_under_null_and_repeated_ids(spark):
    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").where("text IS NOT NULL").first()["text"]
    clean = "a clean text of its own that holds nothing of it"
    rows = [(None, f"before {item} after"), (None, clean), (1, item), (1, clean), (2, None)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, text_md5 string")
    got = sorted((tuple(r)[:2] for r in corpus_pipeline.drop_contaminated(spark, docs, FOLDER).collect()), key=str)
    assert got == sorted([(None, clean), (1, clean), (2, None)], key=str)
