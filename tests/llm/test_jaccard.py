import random
import re

import numpy as np
import pytest
from tallybrook.llm import jaccard as J
from tallybrook.llm import sets as S
from tallybrook.llm.components import components
from tallybrook.llm.words import mix
from tallybrook.session import work_folder


def linked(a, b, percent):
    common = len(np.intersect1d(a, b))
    return 100 * common >= percent * (len(a) + len(b) - common)


def shingles(text, width):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(rows, width, percent):
    sets = [(i, shingles(t, width)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


def ours(frame, width, percent, **options):
    found = J.jaccard_components(frame, width=width, percent=percent, **options).collect()
    return {r.doc_id: (r.n_shingles, r.component_id) for r in found}


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
def test_documents(documents, width, percent):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert ours(documents, width, percent) == brute(rows, width, percent)


def test_chains_copies_and_borderline_pairs(llm_spark):
    chance = random.Random(4)
    word = lambda: "".join(chance.choice("abcdefgh") for _ in range(4))
    rows, common = [], [word() for _ in range(60)]
    for _ in range(6):
        text = [word() for _ in range(chance.choice([4, 12, 25, 40, 90]))]
        for _ in range(12):
            if chance.random() < 0.8:
                text = list(text)
                text[chance.randrange(len(text))] = word()
            rows.append((len(rows), " ".join(text)))
    rows += [(len(rows) + i, " ".join(common + [word() for _ in range(n)])) for i, n in enumerate((1, 2, 3, 5, 8, 13, 21))]
    rows += [(1000 + i, "The SAME text again and again") for i in range(50)] + [(1050, "the same text again and again")]
    rows += [(1100, None), (1101, ""), (1102, " \n"), (1103, "one"), (1104, "ONE"), (1105, "one two")]
    frame = llm_spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for width, percent in ((3, 90), (1, 80)):
        expected = brute(rows, width, percent)
        assert ours(frame, width, percent, slice_sets=3, askers=2, broadcast_ids=0) == expected
        assert ours(frame, width, percent) == expected


def test_repeated_rows_nulls_and_empty_tables(odd, none):
    found = J.jaccard_components(odd.withColumnRenamed("lang", "set_id"), width=3, percent=90)
    rows = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in found.collect())
    assert len(rows) == odd.count()
    assert rows.count((4, 1, 4)) == 2 and (0, 2, None) in rows and (1, 0, 1) in rows
    assert J.jaccard_components(none).collect() == []


@pytest.mark.parametrize("percent", [80, 90])
def test_similar_sets_share_a_part(percent):
    random_ = np.random.default_rng(percent)
    for _ in range(400):
        n = int(random_.integers(1, 300))
        tokens = mix(random_.integers(0, 1 << 62, n + 200).astype(np.uint64))
        a = tokens[:n]
        # As far apart as the similarity allows: tokens dropped from a, others added.
        drop = int(random_.integers(0, n // 4 + 1))
        add = int(random_.integers(0, n // 3 + 1))
        b = np.concatenate((a[drop:], tokens[n : n + min(add, 200)]))
        if linked(np.sort(a), np.sort(b), percent):
            assert np.intersect1d(J.part_hashes(np.sort(a), percent), J.part_hashes(np.sort(b), percent)).size


def test_bound_never_rules_out_a_link():
    random_ = np.random.default_rng(7)
    for _ in range(400):
        n = int(random_.integers(1, 200))
        tokens = mix(random_.integers(0, 1 << 62, n + 100).astype(np.uint64))
        a = np.sort(tokens[:n])
        b = np.sort(np.concatenate((tokens[int(random_.integers(0, n // 5 + 1)) : n], tokens[n : n + int(random_.integers(0, 30))])))
        other = np.sort(tokens[n + 30 : n + 90])
        wide = min(len(S.bits_of(b)), len(S.bits_of(other)))
        union = S.narrowed(S.bits_of(b), wide) | S.narrowed(S.bits_of(other), wide)
        sizes = sorted((len(b), len(other)))
        if linked(a, b, 90):
            rows = S.Rows([1, 2], [len(b), len(other)], [S.bits_of(b).tobytes(), S.bits_of(other).tobytes()])
            assert 1 in rows.near(S.bits_of(a).tobytes(), n, 90)
            assert S.may_link(S.bits_of(a), n, union, sizes[0], sizes[1], 90)


def test_similar_and_spanning():
    chance = random.Random(9)
    sets = [np.unique(np.array([chance.randrange(40) for _ in range(chance.randint(1, 60))], np.uint64)) for _ in range(30)]
    table = S.similar(sets, sets, 60)
    assert all(table[i, j] == linked(sets[i], sets[j], 60) for i in range(30) for j in range(30))
    some = S.similar(sets[:7], sets[7:], 60)
    assert (some == table[:7, 7:]).all()
    links = S.spanning(table)
    assert all(table[i, j] for i, j in links) and len(links) < 30


def test_large_matrices_are_multiplied_in_pieces(monkeypatch):
    sets = [np.arange(i, i + 50, dtype=np.uint64) for i in range(0, 60, 7)]
    whole = S.overlaps(sets, sets)
    monkeypatch.setattr(S, "COLUMNS", 16)
    assert (S.overlaps(sets, sets) == whole).all() and whole[0, 1] == 43


def test_components(llm_spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 200), (5, 5)]
    frame = llm_spark.createDataFrame(edges, "a long, b long").repartition(4)
    found = {r.node: r.component for r in components(frame, work_folder(llm_spark, "t")).collect()}
    assert found == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}
    assert components(frame.where("a < 0"), work_folder(llm_spark, "t")).collect() == []


def test_tasks_give_back_what_the_worker_holds_for_other_operators():
    from tallybrook.llm import runs, sets

    made = runs.held(lambda: bytearray(1 << 20))
    for task in (sets._tokens(3), sets._near_in_slices(80), sets._link_slices(80), sets._near_to_slices(80), sets._open_slices(80)):
        made()
        assert runs._held
        assert list(task(iter([]))) == [] and not runs._held


@pytest.mark.parametrize("percent", [80, 90])
def test_similar_sets_list_a_token_in_common_whatever_is_common(percent):
    random_ = np.random.default_rng(percent + 1)
    for _ in range(400):
        n = int(random_.integers(1, 300))
        tokens = mix(random_.integers(0, 1 << 62, n + 200).astype(np.uint64))
        some = random_.permutation(tokens)[: int(random_.integers(0, n + 200))]
        common = J.Common.of(some, random_.integers(3, 9, len(some)))
        a = np.sort(tokens[:n])
        b = np.sort(np.concatenate((tokens[int(random_.integers(0, n // 4 + 1)) : n], tokens[n : n + int(random_.integers(0, n // 3 + 1))])))
        listed = [J.part_hashes(x, percent, common) for x in (a, b)]
        assert [len(set(x.tolist())) for x in listed] == [len(x) - -(-percent * len(x) // 100) + 1 for x in (a, b)]
        if linked(a, b, percent):
            assert np.intersect1d(*listed).size


def test_texts_that_quote_a_passage_list_what_is_their_own(llm_spark, monkeypatch):
    """Three quarters of every text are the same; one text is an altered copy."""
    passage = " ".join(f"p{i}" for i in range(150))
    rows = [(i, passage + "".join(f" own{i}x{j}" for j in range(50))) for i in range(60)]
    rows.append((60, rows[7][1].replace("own7x20", "other")))
    met = []
    linked_of = J.linked_components
    monkeypatch.setattr(J, "linked_components", lambda hits, *more: met.append(hits.select("set_id").distinct().count()) or linked_of(hits, *more))
    frame = llm_spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert ours(frame, 5, 80, sampled_texts=1) == brute(rows, 5, 80)
    assert met == [2]
    # No more tokens are held to be common than asked for; the result is the same.
    assert ours(frame, 5, 80, sampled_texts=1, common_most=1) == brute(rows, 5, 80)


def test_sets_ask_no_slice_whose_sizes_cannot_link(llm_spark, monkeypatch):
    texts = llm_spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(n))) for i, n in enumerate((10, 100, 110))], "id long, text string")
    folder = work_folder(llm_spark, "t")
    described, listed = S.described_and_listed(texts, 1, lambda found: [np.array([1], np.uint64)] * len(found), folder)
    hits = listed.select("key", "set_id", S.F.col("set_id").alias("lo"))
    asked = []
    chunked = S._chunked
    monkeypatch.setattr(S, "_chunked", lambda asking, *more: asked.append(asking.count()) or chunked(asking, *more))
    found = S.linked_components(hits, described, texts, folder, 1, 80)
    ids = {r.id: r.component_id for r in described.join(found, described.set_id == found.of).collect()}
    assert ids == {0: 0, 1: 1, 2: 1} and asked[0] == 1
