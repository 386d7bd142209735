import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F
from tallybrook.llm import infilling
from tallybrook.llm.infilling import Markers, cut, fill_in_middle, restored, whole


def expected(owner, text):
    """Prefix, suffix and middle by cutting one unit at a time."""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if owner is None else owner}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    low, high = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_equals_brute_force_and_restores(llm_spark, odd):
    extra = llm_spark.createDataFrame(
        [(i, t, "en", "a") for i, t in enumerate(["a<P>b c", "<S", "<<S>>", "<", "P>x", "<M>", "é́ ab\ncd", "\U0001f600 x"] * 40, 100)],
        odd.schema,
    )
    texts = odd.unionByName(extra)
    got = restored(fill_in_middle(texts)).collect()
    by_key = {(r.doc_id, r.restored): r for r in got}
    rows = texts.collect()
    assert len(got) == len(rows)
    for r in rows:
        text = r.text or ""
        found = by_key[r.doc_id, text]
        assert (found.n, found.form, found.prefix_chars, found.middle_chars, found.output) == expected(r.doc_id, text)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_texts_near_to_markers_come_back():
    chance = random.Random(5)
    for owner in range(3000):
        text = "".join(chance.choice(["<", "P", "S", "M", ">", "a", " ", "<P", "S>"]) for _ in range(chance.randrange(12)))
        made = cut(text, owner, 1, 0, 50, Markers())
        assert whole(made.output, made.form, Markers()) == text


def test_shares_and_seeds(llm_spark):
    rows = llm_spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("one two, three four five").alias("text"))
    forms = {r.form: r["count"] for r in fill_in_middle(rows).groupBy("form").count().collect()}
    assert abs(forms["plain"] - 400) < 100 and abs(forms["spm"] - 720) < 120
    other = fill_in_middle(rows, seed=2, plain_percent=0, spm_percent=100)
    assert {r.form for r in other.select("form").distinct().collect()} == {"spm"}


def test_very_long_text(llm_spark):
    text = "word, " * 300_000
    made = restored(fill_in_middle(llm_spark.createDataFrame([(3, text)], "doc_id long, text string"), plain_percent=0))
    (row,) = made.collect()
    assert (row.n, row.restored) == (900_000, text)


def test_empty_table_clashing_names_and_other_id_types(llm_spark, none):
    assert fill_in_middle(none).count() == 0 and restored(fill_in_middle(none)).count() == 0
    rows = llm_spark.createDataFrame([("x", "a b", "p", "q", "r")], "n string, output string, _id string, _text string, form string")
    (row,) = fill_in_middle(rows, id_column="n", text_column="output").drop("n").collect()
    assert row.output.replace("<P>", "").replace("<S>", "").replace("<M>", "").strip("ab ") == ""
    assert fill_in_middle(rows, id_column="_id", text_column="_text").select("_id").first()[0] == "p"


def test_markers_must_be_told_apart(none):
    for markers in (Markers("<P>", "<P>", "<M>"), Markers("", "<S>", "<M>"), Markers("aba", "x", "y"), Markers("ab", "bc", "z")):
        with pytest.raises(ValueError):
            fill_in_middle(none, markers=markers)
    assert infilling.Markers().prefix == "<P>"
