"""The mixing stage of the pipeline on tables with clashing and missing columns."""

from __future__ import annotations

import corpus_pipeline


def test_mixing_keeps_columns_of_any_name(spark):
    rows = [(i, f"some words of text {i} " * 3, "ab"[i % 2], 10, 7, -1, "w", "d") for i in range(20)]
    rows += [rows[0], (20, None, "a", 10, 7, -1, "w", "d"), (None, "", None, 10, 7, -1, "w", "d")]
    columns = "doc_id bigint, text string, source string, row int, size int, taken int, words string, doc string"
    docs = spark.createDataFrame(rows, columns)
    got = corpus_pipeline.mix_sources(spark, docs, "")
    assert got.columns == docs.columns  # no n_chars needed
    kept = got.collect()
    assert {(r["row"], r["size"], r["taken"], r["words"], r["doc"]) for r in kept} == {(10, 7, -1, "w", "d")}
    sizes = {s: sum(len(r["text"].split()) for r in kept if r["source"] == s) for s in "ab"}
    total = {s: sum(len(r[1].split()) for r in rows if r[1] and r[2] == s) for s in "ab"}
    # Weights 5 and 2, share 1.5 of all words: a is at its cap of twice its words, b takes the rest.
    assert sizes["a"] == 2 * total["a"]
    assert abs(sizes["a"] + sizes["b"] - 1.5 * sum(total.values())) <= 1
