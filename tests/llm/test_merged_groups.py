"""Groups of a sketch word that share their least member are one group, and workers drop what other work held."""

from __future__ import annotations

from itertools import combinations

import public_tokenizers

import corpus_pipeline
from tallyworks.llm import bytebpe, jaccard, packing, text


def test_groups_of_one_least_member_are_merged(spark):
    groups = {10: [1, 2, 3, 4], 11: [1, 2, 3, 5], 12: [1, 2, 4, 5], 13: [2, 6], 14: [7, 8], 15: [9]}
    rows = [(g, c, 0, len(members), 0) for g, members in groups.items() for c in members]
    found = spark.createDataFrame(rows, "grp long, cls long, band long, size long, spare long")
    kept = jaccard.kept_groups(found).collect()
    merged = {}
    for r in kept:
        merged.setdefault(r.grp, set()).add(r["cls"])
    assert {frozenset(m) for m in merged.values()} == {frozenset({1, 2, 3, 4, 5}), frozenset({2, 6}), frozenset({7, 8})}
    assert all(r["count"] == len(merged[r.grp]) for r in kept) and len(kept) == 9
    met = {p for m in merged.values() for p in combinations(sorted(m), 2)}
    assert met >= {p for m in groups.values() for p in combinations(sorted(m), 2)}


def test_a_frequent_word_is_left_out_before_groups_are_merged(spark):
    rows = [(20, c, 0, 4, 1) for c in (1, 2, 3, 4)] + [(21, c, 0, 2, 1) for c in (1, 2)]
    kept = jaccard.kept_groups(spark.createDataFrame(rows, "grp long, cls long, band long, size long, spare long")).collect()
    assert {(r["cls"], r["count"]) for r in kept} >= {(1, 2), (2, 2)}
    assert not any(r.grp == r2.grp and r["cls"] == 1 and r2["cls"] in (3, 4) for r in kept for r2 in kept)


def test_work_without_state_drops_that_of_others():
    text._STATE.clear()
    text.worker_state("toxicity", "table 1", list)
    text.drop_other_state("toxicity")
    assert set(text._STATE) == {("toxicity", "table 1")}
    text.drop_other_state("jaccard")
    assert not text._STATE


def test_powers_of_a_base_are_held_once():
    text._STATE.clear()
    base = jaccard._BASE
    few, many = jaccard._powers(base, 100).copy(), jaccard._powers(base, 1000)
    held = text._STATE["jaccard", "powers"]
    assert (many[:100] == few).all() and set(held) == {base} and jaccard._powers(base, 10).base is held[base]
    assert [int(p) for p in many[:50]] == [pow(base, i, 1 << 64) for i in range(50)]


def test_the_table_of_the_pipelines_packing_is_smaller(spark):
    assert corpus_pipeline.TABLE_BYTES < packing.TABLE_BYTES
    docs = spark.createDataFrame([(1, "some words here"), (2, None), (3, "some more words")], "doc_id long, text string")
    path = public_tokenizers.path("word_bpe_49k.json")
    one, other = (packing.token_pieces(docs, path, table_bytes=n).collect() for n in (packing.TABLE_BYTES, 300))
    assert sorted(one) == sorted(other) and len(one) == 3


def test_more_matches_are_kept_and_as_tuples():
    encoder = bytebpe.Encoder({bytes([b]): b for b in range(256)}, r"\w+|\W+")
    assert bytebpe.MOST_MATCHES >= 150_000
    list(encoder.encode_batch(["ab cd"]))
    assert encoder.matches and all(isinstance(ids, tuple) for ids in encoder.matches.values())
