from collections import Counter

from tallybrook.llm.counts import VOCABULARY, RunCounts, frequent_runs, token_counts
from tallybrook.llm.runs import RunTable, load_tokenizer


def test_the_library_agrees(documents, odd):
    frame = documents.select("doc_id", "text").union(odd.select("doc_id", "text"))
    tokenizer = load_tokenizer(VOCABULARY)
    expected = Counter()
    for r in frame.collect():
        n = len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)
        expected[r.doc_id, len((r.text or "").encode()), n, n > 512] += 1
    for frequent, runs in ((65_536, 1_000_000), (5, 50), (0, 1)):
        found = token_counts(frame.repartition(3), frequent=frequent, worker_runs=runs).collect()
        assert Counter(map(tuple, found)) == expected


def test_frequent_runs_are_the_most_frequent(llm_spark):
    texts = llm_spark.createDataFrame([("a x x y z",), ("b x y",), (None,), ("",)], "t string").repartition(2)
    assert frequent_runs(texts, limit=2) == ["x", "y"]


def test_the_table_of_runs(llm_spark):
    """It comes from a bounded sample, and is the same after it was packed."""
    texts = llm_spark.range(3000).selectExpr("concat('common w', id) AS t").repartition(4)
    listed = frequent_runs(texts, limit=100_000, sample_rows=300)
    assert 200 < len(listed) < 400 and set(listed) <= {f"w{i}" for i in range(3000)}
    compact = RunCounts.of(["a", "日本", ""], [1, 300, 0])
    assert compact.table() == {"a": 1, "日本": 300, "": 0}


def test_empty_table_and_clashing_names(llm_spark, none):
    assert token_counts(none).collect() == []
    rows = llm_spark.createDataFrame([(7, "a b", 3, 4)], "doc_id long, text string, n_tokens int, _id int")
    assert [tuple(r) for r in token_counts(rows).collect()] == [(7, 3, 2, False)]


def test_a_full_table_starts_anew():
    asked = []
    table = RunTable(lambda found: asked.append(sorted(found)) or [x.upper() for x in found], 3, {"k": "K"})
    assert table.values(["a", "b", "k", "a"]) == ["A", "B", "K", "A"]
    assert table.values(["c", "a"]) == ["C", "A"]
    assert table.values(["d", "a"]) == ["D", "A"]
    assert table.values(["a", "d", "k"]) == ["A", "D", "K"] and len(table.known) <= 5
    assert asked == [["a", "b"], ["c"], ["d"], ["a"]]
