import base64
import random

import public_tokenizers
import pytest
import tiktoken

from ledgermill.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
HARD = [
    None, "", " ", "\n\n  \n", "don't  we'll THEY'RE", "a" * 700, "ab " * 3000, "\u00a0x\u2003y\u3000", "\x1c\x1d x\x85y\u200b",
    "漢字かな交じり文 ١٢٣ ½ Ⅷ", "🤷🏽‍♀️ e\u0301", "x" * 513 + "1" * 600, "token = \"24be64\"### $$$ de,&&&", "\t\tif x:\r\n\tpass",
    "ÄÖÜ ß ñ cióniear", "<|endoftext|>", "\u2028\u2029\ufeff",
]


@pytest.fixture(scope="module")
def truth():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_equal_the_library_and_decode_to_the_text(spark, truth):
    rng = random.Random(5)
    alphabet = "abcdehrst  \n'.,é漢1_-"
    texts = HARD + ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(300)] + HARD
    frame = spark.createDataFrame([(i % 7, t, "x", i) for i, t in enumerate(texts)], "doc_id long, text string, ids string, n long")
    frame = frame.repartition(3)
    ranks = byte_bpe.read_ranks(PATH)
    rows = byte_bpe.decode(byte_bpe.encode(frame.drop("doc_id"), ranks, public_tokenizers.PATTERN, key="n"), ranks, "n").collect()
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row["n"]] or ""
        ids = [int.from_bytes(row["ids"][k : k + 4], "little") for k in range(0, len(row["ids"]), 4)]
        assert ids == truth.encode_ordinary(text)
        assert bytes(row["decoded"]) == text.encode()


def test_heap_for_long_pieces(truth):
    words = byte_bpe.Vocabulary(byte_bpe.read_ranks(PATH))
    rng = random.Random(1)
    for _ in range(200):
        piece = "".join(rng.choices("aehinorst", k=rng.randrange(2, 90)))  # one match of the pattern
        assert words._long(piece.encode()).tolist() == truth.encode_ordinary(piece)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    ranks = byte_bpe.read_ranks(PATH)
    assert byte_bpe.decode(byte_bpe.encode(frame, ranks, public_tokenizers.PATTERN), ranks).collect() == []
