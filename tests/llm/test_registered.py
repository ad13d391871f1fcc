"""Every operator is registered; those without SQL are named here and tested against brute force."""

from tidemark.llm.queries import oracle_sql, queries

WITHOUT_SQL = {
    "op1_token_order", "op2_lm_scoring", "op3_toxicity", "op6_pii_pseudonyms", "op12_conversation_repair", "op13_byte_bpe",
}


def test_every_operator_is_registered_once():
    assert sorted(int(q[2:].split("_")[0]) for q in queries()) == list(range(1, 14))
    assert set(queries()) - set(oracle_sql()) == WITHOUT_SQL
