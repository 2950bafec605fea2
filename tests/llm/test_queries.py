"""Every registered query of the subpackage runs over the small tables; those with SQL equal it."""

import pytest

import __spark_entry__ as entry
from ledgerline.llm.queries import ORACLE_SQL, QUERIES
from oracle.compare import compare

SF = "/root/testdata/sf0.001"
FIRST_COLUMNS = {
    "op1": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op2": ["doc_id", "n_shingles", "component_id", "kept"],
    "op3": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op4": ["doc_id", "held_out", "lang_pred", "score"],
    "op5": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op6": ["doc_id", "item_id", "first_word", "n_words", "similarity"],
    "op7": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op8": ["doc_id", "n_lines", "n_removed", "n_chars", "text_sha256"],
    "op9": ["page_id", "url", "text", "n_chars"],
    "op10": ["query_id", "rank", "vec_id", "score"],
    "op11": ["doc_id", "size", "source_size", "target", "taken"],
    "op13": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
    "op12": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
}


def test_registered():
    names = entry.queries()
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert set(ORACLE_SQL) <= set(entry.oracle_sql())
    assert {q.split("_")[0] for q in QUERIES} == set(FIRST_COLUMNS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    assert df.columns == FIRST_COLUMNS[name.split("_")[0]]
    if name in ORACLE_SQL:
        found = compare(spark, duck, df, ORACLE_SQL[name])
        assert found["ok"], {k: found.get(k) for k in ("spark_rows", "oracle_rows", "only_spark", "only_oracle", "types")}
    else:
        assert df.count() > 0
