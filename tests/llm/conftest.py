import public_tokenizers
import pytest
from pyspark.sql import types as T

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

# ids and texts: nulls, empties, blanks, ties, repeated rows, a very long text, special strings, other white space
CASES = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank."),
    (1, "The quick brown fox jumps over the lazy dog near the river bank."),
    (1, "another text under the same id"),
    (None, "a text without an id, of several words"),
    (None, None),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (5, "one two three"),
    (6, "<|endoftext|> and </s>[INST] x [/INST] <s>"),
    (7, "line one\nline two\nline three\nline four"),
    (8, "x\nline one\nline two\nline three\nline four\ny"),
    (9, "word " * 40_000 + "end"),
    (10, "x" * 30_000),
    (11, "naïve café — 漢字 🙂  end\r\n\r\nnext  two   spaces "),
    (12, "12345 ½ Ⅷ ² !!! ???"),
    (0, "The quick brown fox jumps over the lazy dog near the river bank."),
]


@pytest.fixture(scope="session")
def cases(spark):
    """The cases with extra columns whose names the operators use inside."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())] + [
        T.StructField(c, T.StringType()) for c in ("row", "node", "key", "n", "sig", "windows", "doc", "root", "ids", "place", "lang")])
    rows = [(i, t, *["z"] * 10, ["en", "fr"][k % 2]) for k, (i, t) in enumerate(CASES)]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_rows(cases):
    return cases.limit(0)
