import random

import numpy as np
from tallybrook.llm import sets as S
from tallybrook.llm.minhash import chance, half_bands, near_duplicates
from tallybrook.llm.words import mix
from tallybrook.session import work_folder

from test_jaccard import brute


def ours(frame, **options):
    rows = near_duplicates(frame, **options).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows}


def test_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert ours(documents, width=4, percent=80) == brute(rows, 4, 80)


def test_copies_odd_rows_and_common_keys(llm_spark, odd, none, monkeypatch):
    """A third of the rows are near copies; every key counts as common."""
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(4))
    first = [word() for _ in range(80)]
    rows = [(i, " ".join(word() for _ in range(draw.randrange(1, 60)))) for i in range(60)]
    for i in range(40):
        near = list(first)
        near[draw.randrange(80)] = word()
        rows.append((100 + i, " ".join(near)))
    rows += [(200 + i, " ".join(first).upper()) for i in range(20)] + [(r.doc_id + 1000, r.text) for r in odd.collect() if r.doc_id]
    frame = llm_spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(S, "COMMON", 1)
    monkeypatch.setattr(S, "SAMPLED", 1)
    assert ours(frame, width=4, percent=80, slice_sets=4, askers=3, broadcast_ids=0) == brute(rows, 4, 80)
    monkeypatch.undo()
    clashing = odd.withColumnRenamed("lang", "set_id").withColumnRenamed("source", "kept")
    found = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in near_duplicates(clashing).collect())
    assert len(found) == odd.count() and found.count((4, 1, 4)) == 2 and (0, 1, None) in found and (1, 0, 1) in found
    assert near_duplicates(none).collect() == []


def test_sharing_of_common_and_other_keys(llm_spark, monkeypatch):
    rows = [(s, 7) for s in range(400)] + [(s, 1000 + s // 2) for s in range(300)] + [(s, 5000 + s) for s in range(300)]
    listed = llm_spark.createDataFrame(rows + rows[:50], "set_id long, key long")
    expected = sorted([(7, s, 0) for s in range(400)] + [(1000 + s // 2, s, s // 2 * 2) for s in range(300)])
    for sampled, common in ((64, 64), (2, 50), (1, 1)):
        monkeypatch.setattr(S, "SAMPLED", sampled)
        monkeypatch.setattr(S, "COMMON", common)
        found = S.sharing(listed, work_folder(llm_spark, "sharing"))
        assert sorted(map(tuple, found.select("key", "set_id", "lo").collect())) == expected


def test_tables_meet_as_often_as_they_should():
    """Keys of pairs of halves, against the formula; half a table's halves are not enough."""
    draw, met, trials = np.random.default_rng(5), 0, 600
    for trial in range(trials):
        tokens = mix(draw.integers(0, 1 << 62, 130).astype(np.uint64))
        # 100 of 130 tokens in common: a similarity of 100 / 130.
        sets = [np.sort(tokens[:115]), np.sort(tokens[15:])]
        a, b = half_bands(sets, 3, 4, trial)
        assert len(a) == 8
        met += (a[:4] == b[:4]).any() and (a[4:] == b[4:]).any()
    assert abs(met / trials - chance(100 / 130, 3, 4)) < 0.08
    assert chance(0.8) > 0.997 and chance(0.9) > 0.9999 and chance(0.3) < 0.06


def test_half_bands_depend_on_seed_and_place():
    sets = [np.arange(1, 50, dtype=np.uint64)]
    one, other = half_bands(sets, 3, 10, 1)[0], half_bands(sets, 3, 10, 2)[0]
    assert len(set(one.tolist())) == 20 and not set(one.tolist()) & set(other.tolist())
    assert half_bands([], 3, 10, 1).shape == (0, 20)
