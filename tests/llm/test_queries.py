"""The registered queries: names, columns and whole tables."""

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"

#: The columns that each query promises, in any order.
COLUMNS = {
    1: "doc_id n_words n_base first_word last_word base_labels labels score",
    2: "doc_id item_id similarity",
    3: "doc_id n_tokens ids_sha256 decoded_sha256",
    4: "doc_id held_out n_tokens n_known train_tokens base_score score",
    5: "doc_id n_bytes n_removed n_spans kept_sha256",
    6: "doc_id n_shingles component_id",
    7: "doc_id held_out lang_pred score",
    8: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    9: "doc_id n_assign n_access n_hex base_sha256 spans",
    10: "doc_id n_bytes n_tokens over_limit",
    11: "lang rank phrase a l r n score",
    12: "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    13: "word form root n n_near form_n",
}


def test_each_operator_has_one_query_over_all_documents(spark):
    found = entry.queries()
    names = {n: [x for x in found if x.startswith(f"op{n}_")] for n in COLUMNS}
    assert all(len(x) == 1 for x in names.values()) and "pipeline" in found
    n_docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    for n, (name,) in names.items():
        df = found[name](spark, SF)
        assert set(COLUMNS[n].split()) <= set(df.columns), name
        if n not in (2, 11, 13):        # those of one row a document
            ids = [r.doc_id for r in df.select("doc_id").collect()]
            assert len(ids) == len(set(ids)) == n_docs, name
