import __spark_entry__ as E
from corpusforge.llm import queries as L


def test_queries_without_sql_are_exactly_these():
    """SQL can't state them (README); the other tests here compare them with
    brute force."""
    qs, orc = E.queries(), E.oracle_sql()
    assert {n.split("_")[0] for n in L.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert {*L.QUERIES, "pipeline"} <= set(qs)
    assert {*L.QUERIES, "pipeline"} - set(orc) == {
        "op2_suffix_dedup", "op4_best_fit_packing", "op5_pii", "op7_simhash", "op8_quality",
        "op9_decontamination", "op10_url_filter", "op11_html_extraction", "op12_spelling_variants", "pipeline",
    }
