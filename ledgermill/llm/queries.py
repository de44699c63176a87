"""The registered queries over the training-data tables, and their check statements."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm import byte_bpe, conversations, decontaminate, language_id, lexical_search, line_dedup, lm_score, main_text, neighbours, ngram_join, personal_data, repeats, simhash

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids and decoded bytes of every document, as counts and digests."""
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = byte_bpe.encode(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)
    return byte_bpe.decode(encoded, ranks).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from three quarters of them."""
    documents = table(spark, folder, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = language_id.learn(documents.where(~held_out).select("text", "lang"))
    rows = language_id.predict(documents.select("doc_id", "text"), model)
    return rows.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold at least four fifths of a benchmark item's shingles."""
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


SQL["op7_decontaminate"] = r"""
WITH words AS (
    SELECT 'd' AS kind, doc_id AS id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents
    UNION ALL
    SELECT 'i', item_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') FROM benchmark
), sizes AS (
    SELECT DISTINCT least(5, len(w)) AS n FROM words WHERE kind = 'i' AND len(w) > 0
), shingles AS (
    SELECT DISTINCT kind, id, array_to_string(w[k:k + n - 1], ' ') AS s
    FROM (
        SELECT kind, id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS k
        FROM words, sizes WHERE len(w) >= n AND (kind = 'd' OR n = least(5, len(w)))
    )
), items AS (
    SELECT id AS item_id, s, count(*) OVER (PARTITION BY id) AS n_item FROM shingles WHERE kind = 'i'
)
SELECT d.id AS doc_id, item_id, n_item, count(*) AS n_shared, count(*)::DOUBLE / n_item AS containment
FROM items JOIN shingles d ON d.kind = 'd' AND d.s = items.s
GROUP BY d.id, item_id, n_item HAVING 100 * count(*) >= 80 * n_item
"""


@query
def op3_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document: counts and digest of the base spans, and all spans."""
    model = personal_data.train(personal_data.read_labelled())
    found = personal_data.find(table(spark, folder, "documents"), model)

    def joined(spans: str) -> Column:
        return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')")

    base = "filter(spans, s -> s.base)"
    counts = [F.expr(f"CAST(size(filter(spans, s -> s.base AND s.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in personal_data.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans"))


@query
def op9_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, folder, "pages")
    found = main_text.extract(pages, main_text.train(), "struct(page_id, url) AS page", "html")
    return found.select("page.page_id", "page.url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op10_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    embeddings = table(spark, folder, "embeddings")
    return neighbours.nearest(embeddings, embeddings.where("vec_id % 50 = 0"), k=5)


@query
def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its number of lines and of lines that match an earlier one, and a digest of the rest."""
    rows = line_dedup.dedup(table(spark, folder, "documents"))
    return rows.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query
def op8_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the size of its shingle set and the smallest document that links reach."""
    return ngram_join.linked(table(spark, folder, "documents"))


SQL["op4_line_dedup"] = r"""
WITH parts AS (
    SELECT doc_id, string_split(text, chr(10)) AS all_lines FROM documents WHERE text IS NOT NULL
), l AS (
    SELECT doc_id, k - 1 AS line, all_lines[k] AS raw FROM (SELECT *, unnest(generate_series(1, len(all_lines))) AS k FROM parts)
), w AS (
    SELECT DISTINCT doc_id, line, unnest(list_filter(string_split_regex(
        translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS word
    FROM l
), n AS (
    SELECT doc_id, line, count(*) AS n FROM w GROUP BY doc_id, line
), rare AS (
    SELECT w.*, n, row_number() OVER (PARTITION BY doc_id, line ORDER BY c, word) AS r
    FROM w JOIN n USING (doc_id, line) JOIN (SELECT word, count(*) AS c FROM w GROUP BY word) USING (word)
), pairs AS (
    SELECT DISTINCT a.doc_id AS ad, a.line AS al, b.doc_id AS bd, b.line AS bl, a.n AS an, b.n AS bn
    FROM rare a JOIN rare b ON a.word = b.word AND (b.doc_id < a.doc_id OR (b.doc_id = a.doc_id AND b.line < a.line))
    WHERE a.r <= a.n - (4 * a.n + 4) // 5 + 1 AND b.r <= b.n - (4 * b.n + 4) // 5 + 1
), gone AS (
    SELECT DISTINCT ad AS doc_id, al AS line FROM (
        SELECT ad, al FROM pairs JOIN w x ON x.doc_id = ad AND x.line = al JOIN w y ON y.doc_id = bd AND y.line = bl AND y.word = x.word
        GROUP BY ad, al, bd, bl, an, bn HAVING 100 * count(*) >= 80 * (an + bn - count(*))
    )
), kept AS (
    SELECT doc_id, count(*) AS n, string_agg(raw, chr(10) ORDER BY line) AS text
    FROM l WHERE NOT EXISTS (FROM gone WHERE gone.doc_id = l.doc_id AND gone.line = l.line) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(len(all_lines), 0) AS n_lines, coalesce(len(all_lines), 0) - coalesce(kept.n, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents d LEFT JOIN parts USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

SQL["op8_ngram_join"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS k FROM words WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
    SELECT a.doc_id AS x, b.doc_id AS y
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN sizes na ON na.doc_id = a.doc_id JOIN sizes nb ON nb.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))
), reach AS (
    SELECT x, y FROM links
    UNION
    SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
)
SELECT d.doc_id, coalesce(any_value(sizes.n), 0) AS n_shingles, least(d.doc_id, coalesce(min(reach.y), d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes ON sizes.doc_id = d.doc_id LEFT JOIN reach ON reach.x = d.doc_id
GROUP BY d.doc_id
"""


@query
def op2_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the bytes of strings of 400 that repeat: counts, and a digest of what stays."""
    documents = table(spark, folder, "documents")
    cleaned = repeats.cleaned_texts(documents).withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
    whole = F.coalesce("text", F.lit(""))
    rows = documents.select("doc_id", F.octet_length(whole).cast("long").alias("n_bytes"), F.sha2(whole, 256).alias("whole_sha256"), repeats.text_key("text").alias("text_key"))
    return rows.join(cleaned, "text_key", "left").select(
        "doc_id", "n_bytes", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_removed", "n_spans")],
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
    )


@query
def op1_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    """Closeness of every document to those of good quality."""
    good = table(spark, folder, "labels").where("quality = 1")
    return lm_score.score(table(spark, folder, "documents"), good)


@query
def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The twenty documents that score highest for every benchmark item."""
    return lexical_search.rank(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=20)


SQL["op12_lexical_search"] = r"""
WITH d AS (
    SELECT doc_id, row_number() OVER () AS row_no, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents WHERE text IS NOT NULL
), q AS (
    SELECT item_id, term, count(*) AS repeats FROM (
        SELECT item_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark
    ) GROUP BY item_id, term
), total AS (
    SELECT count(*) AS many, sum(len(w))::BIGINT AS l FROM d WHERE len(w) > 0
), tf AS (
    SELECT row_no, term, count(*) AS tf FROM (SELECT row_no, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY row_no, term
), weight AS (
    SELECT term, floor(1000 * ln((2 * many + 2) / (2 * count(*) + 1)))::BIGINT AS idf FROM tf, total GROUP BY term, many
), part AS (
    SELECT row_no, term, idf * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(d.w) * many) // l))) AS value
    FROM tf JOIN weight USING (term) JOIN d USING (row_no), total
), scored AS (
    SELECT item_id, row_no, sum(repeats * value)::BIGINT AS score FROM q JOIN part USING (term) GROUP BY item_id, row_no HAVING sum(repeats * value) > 0
)
SELECT item_id, rank, doc_id, score FROM (
    SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scored JOIN d USING (row_no)
) WHERE rank <= 20
"""


@query
def op13_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint of every document and the smallest document that links of near fingerprints reach."""
    return simhash.linked(table(spark, folder, "documents"))


@query
def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults of every damaged conversation, its cheapest edits and a digest of what they give."""
    rows = conversations.repaired(conversations.damaged(table(spark, folder, "conversations")))
    return rows.select(
        F.col("conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.col("digest").alias("repaired_sha256")
    )


def _best(*options: str) -> str:
    """The cheapest edits, then the least in order; an option is null where there is no way."""
    return f"list_sort(list_filter([{', '.join(options)}], lambda x: x IS NOT NULL))[1]"


def _edit(state: str, cost: str, letter: str, line: str = "''", where: str = "TRUE") -> str:
    return f"CASE WHEN {state} IS NOT NULL AND {where} THEN {{'c': {state}.c + {cost}, 'e': {state}.e || '{letter}', 'o': {state}.o || {line}}} END"


def _inserted(rows: str) -> str:
    """One insert from every state, or none."""
    user = [_edit(x, "2", "I", "chr(10) || 'user:'") for x in "nsa"]
    return f"SELECT * REPLACE ({_best('u', *user)} AS u, {_best('a', _edit('u', '2', 'I', chr(39).join(('chr(10) || ', 'assistant:', ''))))} AS a) FROM ({rows})"


def _row(state: str, initial: str, role: str) -> list[str]:
    """The row kept or given another role after a state."""
    kept = _edit(state, "late", "K", "chr(10) || role || ':' || text", f"left(role, 1) = '{initial}' AND NOT gone")
    return [kept, _edit(state, "2 + late", "R", f"chr(10) || '{role}:' || text", "NOT gone")]


SQL["op11_conversation_repair"] = f"""
WITH RECURSIVE crc_table AS (
    SELECT list(v ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(i, [0::BIGINT for x in range(8)]), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM range(256) AS r(i)
    )
), keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(
        list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT for x in string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '')]),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind
    FROM conversations, crc_table
), damaged AS (
    SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM keyed, range(2) AS copy(n) WHERE kind <> 0 AND (n = 0 OR kind = 3)
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
           regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS ended
    FROM damaged
), faults AS (
    SELECT *, CASE WHEN ended = '' THEN 'blank'
                   WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
                   WHEN right(ended, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before
    FROM placed
), rows AS (
    SELECT conv_id AS c, pos AS p, role, text, fault IN ('blank', 'duplicate') AS gone, (fault = 'truncated')::BIGINT AS late FROM faults
), edits AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS pos, {{'c': 0::BIGINT, 'e': '', 'o': ''}} AS n, NULL::STRUCT(c BIGINT, e VARCHAR, o VARCHAR) AS s,
           NULL::STRUCT(c BIGINT, e VARCHAR, o VARCHAR) AS u, NULL::STRUCT(c BIGINT, e VARCHAR, o VARCHAR) AS a
    FROM conversations
    UNION ALL
    SELECT conv_id, p,
           {_edit('n', '3', 'D')},
           {_best(_edit('s', '3', 'D'), _row('n', 's', '')[0])},
           {_best(_edit('u', '3', 'D'), *_row('n', 'u', 'user'), *_row('s', 'u', 'user'), *_row('a', 'u', 'user'))},
           {_best(_edit('a', '3', 'D'), *_row('u', 'a', 'assistant'))}
    FROM ({_inserted(_inserted('SELECT * FROM edits'))}) JOIN rows ON c IS NOT DISTINCT FROM conv_id AND p = pos + 1
), last AS (
    SELECT conv_id, {_best('n', 'a')} AS best FROM ({_inserted(_inserted('SELECT conv_id, arg_max(n, pos) AS n, arg_max_null(s, pos) AS s, arg_max_null(u, pos) AS u, arg_max_null(a, pos) AS a FROM edits GROUP BY conv_id'))})
), counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
           count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (before IS NOT NULL AND before || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
    FROM faults GROUP BY conv_id
)
SELECT last.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, best.c AS cost, best.e AS audit, sha256(best.o[2:]) AS repaired_sha256
FROM last LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM last.conv_id
"""
