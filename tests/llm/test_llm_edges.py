"""Nulls, empty and long texts, repeated rows, empty tables and clashing column names; the entry and the pipeline."""

import pytest

import corpus_pipeline
from vaultspark.llm import chat_hmm, decontaminate, html_blocks, ngram_trie, packing, quality_mil, quality_rules, sharding, simhash, warc
from vaultspark.llm.common import crc_mod, table
from vaultspark.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
EXTRA = ["fp", "root", "size", "key", "score", "n_words", "hash", "item_id", "rank", "length", "row", "_w", "_in", "y"]


def awkward(spark, rows):
    """Documents with a column of every name that the operators use inside."""
    cols = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in EXTRA)
    return spark.createDataFrame([(i, t, None, None, None, *["x"] * len(EXTRA)) for i, t in rows], cols)


LONG = " ".join(f"word{i % 977} and" for i in range(60_000))
ROWS = [(1, "one two three four five six"), (1, "one two three four five six"), (2, None), (3, ""), (4, " \n\t "), (None, "a text without any id here"),
        (None, None), (5, "\x00\u0002 odd % {} ퟿"), (6, LONG), (7, "x" * 300_000)]


def trusted(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "doc_id long")


def labels(spark):
    return spark.createDataFrame([(1, 1), (6, 1), (2, 0), (7, 0), (None, 1), (9, None)], "doc_id long, quality int")


OPERATORS = {
    "near_duplicates": lambda s, d: simhash.near_duplicates(s, d),
    "rules": lambda s, d: quality_rules.judge(s, d, trusted(s, [1, None]), buckets=64, prefix="_rule_"),
    "classifier": lambda s, d: quality_mil.score(d, quality_mil.fit(s, d, labels(s))),
    "sharding": lambda s, d: sharding.shard_documents(s, d, shards=3),
    "language_model": lambda s, d: ngram_trie.score(d, ngram_trie.learn(s, d)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_has_a_result(spark, name):
    got = OPERATORS[name](spark, awkward(spark, ROWS)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in ROWS)
    assert OPERATORS[name](spark, awkward(spark, [])).collect() == []


def test_packing_of_awkward_rows(spark):
    got = packing.pack(spark, awkward(spark, ROWS)).collect()
    assert sum(r.length for r in got if r.start == 0) > 0
    assert sum(r.start == 0 for r in got) == len(ROWS)
    assert packing.pack(spark, awkward(spark, [])).collect() == []


def test_deduplicate_awkward_rows(spark):
    kept = simhash.deduplicate(spark, awkward(spark, ROWS)).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "2", "5", "6", "7", "None"]  # 3, 4 and the empty row without id join 2
    assert simhash.deduplicate(spark, awkward(spark, [])).collect() == []


def test_deduplicate_tells_texts_under_one_id_apart(spark):
    one, two = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    kept = simhash.deduplicate(spark, awkward(spark, [(1, one), (1, two), (2, one), (3, two), (1, one)])).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(1, one), (1, two)]
    three = " ".join(f"c{i}" for i in range(60))  # id 5 stands for the group of three only
    kept = simhash.deduplicate(spark, awkward(spark, [(4, one), (5, one), (5, three), (6, three)])).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(4, one), (5, three)]


def test_decontaminate_awkward_rows(spark):
    docs = awkward(spark, ROWS)
    items = spark.createDataFrame([(1, "one two three four five six", "x"), (2, None, "x"), (None, "", "x")], "item_id long, text string, hash string")
    assert [(r.doc_id, r.item_id) for r in decontaminate.contaminated(spark, docs, items).collect()] == [(1, 1)]
    assert decontaminate.remove_contaminated(spark, docs, items).count() == len(ROWS) - 2
    assert decontaminate.contaminated(spark, docs, items.limit(0)).collect() == []
    assert decontaminate.contaminated(spark, awkward(spark, []), items).collect() == []


def test_decontamination_judges_each_text_by_itself(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    half = item.split()
    rows = [(None, f"before {item} after"), (None, "a clean text without any id"), (None, None), (3, item), (3, "another text under the same id"),
            (None, " ".join(half[:9])), (None, " ".join(half[4:]))]  # the halves hold the item only together
    items = spark.createDataFrame([(1, item, "x")], "item_id long, text string, hash string")
    kept = decontaminate.remove_contaminated(spark, awkward(spark, rows), items).collect()
    assert sorted(str(r.text) for r in kept) == sorted(str(t) for _, t in rows if t is None or item not in t)


def test_pages_and_transcripts_that_are_empty(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string, text string")
    assert warc.archive(spark, none).collect() == [] and html_blocks.extract(spark, none).collect() == []
    turns = "conv_id long, seq long, text string, role string, chunk string, turn string"
    assert chat_hmm.parse_transcripts(spark, spark.createDataFrame([], turns)).collect() == []
    odd = spark.createDataFrame([(None, None, None, None, "x", "x"), (1, 0, "", None, "x", "x"), (2, 0, "User: a", "x", "x", "x"),
                                 (2, 0, "User: a", "x", "x", "x"), (3, 0, LONG, "x", "x", "x")], turns)
    got = chat_hmm.parse_transcripts(spark, odd).collect()
    assert {r.conv_id for r in got} == {None, 1, 2, 3}
    assert [r.text for r in got if r.conv_id == 2] == ["a", "a"]


def test_a_classifier_without_labels_is_indifferent(spark):
    docs = awkward(spark, ROWS)
    model = quality_mil.fit(spark, docs, labels(spark).limit(0))
    assert model is None
    assert {r.score for r in quality_mil.score(docs, model).collect()} == {0.5}


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))


def test_pipeline_equals_its_operators(spark):
    """Every stage against the operators' own rows, held as Python sets."""
    docs = table(spark, SMALL, "documents")
    steps = dict(corpus_pipeline.STAGES)
    good = table(spark, SMALL, "labels").filter("quality = 1").select("doc_id")
    a = steps["quality_rules"](spark, docs, SMALL).cache()
    assert a.columns == docs.columns
    assert {r.doc_id for r in a.collect()} == {r.doc_id for r in quality_rules.judge(spark, docs, good).filter("kept").collect()}
    b = steps["quality_classifier"](spark, a, SMALL).cache()
    model = quality_mil.fit(spark, docs, table(spark, SMALL, "labels"), learn=crc_mod("doc_id", 4) != 2)
    passed = {r.doc_id for r in quality_mil.score(a, model).collect() if r.score >= quality_mil.THRESHOLD}
    assert b.columns == docs.columns and {r.doc_id for r in b.collect()} == passed
    c = steps["near_dedup"](spark, b, SMALL).cache()
    assert {r.doc_id for r in c.collect()} == {r.component_id for r in simhash.near_duplicates(spark, b).collect()}
    d = steps["decontamination"](spark, c, SMALL).cache()
    held = {r.doc_id for r in decontaminate.contaminated(spark, c, table(spark, SMALL, "benchmark")).collect()}
    assert {r.doc_id for r in d.collect()} == {r.doc_id for r in c.collect()} - held
    out = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in out} == {r.doc_id for r in d.collect()}
    assert sum(r.length for r in out) == sum({r.doc_id: r.doc_tokens for r in out}.values())


def test_pipeline_on_an_empty_table(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table(spark, SMALL, name).limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
