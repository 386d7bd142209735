import struct
import zlib

import pytest
from tallybrook.llm import records as R
from tallybrook.llm import runs
from tallybrook.llm.runs import load_tokenizer
from tallybrook.session import work_folder


def expected(rows):
    tokenizer, start = load_tokenizer(R.VOCABULARY), 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        packed = struct.pack(f"<{len(ids)}I", *ids)
        yield doc_id, start, len(ids), zlib.crc32(packed), packed
        start += len(ids)


def test_round_trip_through_files_and_index(llm_spark, documents, odd):
    frame = documents.select("doc_id", "text").where("doc_id > 20").union(odd.select("doc_id", "text"))
    wanted = list(expected([tuple(r) for r in frame.collect()]))
    out = work_folder(llm_spark, "records")
    R.write_records(frame.repartition(5), out, per_file=40)
    found = R.record_digests(llm_spark, out).collect()
    assert sorted(map(str, ((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found))) == sorted(map(str, (w[:4] for w in wanted)))

    # The index leads to the same records, in an order that reruns repeat.
    shuffled = [(r.id, bytes(r.ids)) for r in R.read_shuffled(llm_spark, out, seed=5).collect()]
    assert shuffled == [(r.id, bytes(r.ids)) for r in R.read_shuffled(llm_spark, out, seed=5).collect()]
    assert sorted(map(str, shuffled)) == sorted(str((w[0], w[4])) for w in wanted)
    assert shuffled != [(r.id, bytes(r.ids)) for r in R.read_shuffled(llm_spark, out, seed=6).collect()]
    index = R.read_index(llm_spark, out)
    assert index.count() == len(wanted) and index.select("file").distinct().count() >= len(wanted) / 40


def test_a_worker_keeps_the_runs_that_are_used_most():
    pool = R.worker_runs_of(R.VOCABULARY, 40)
    tokenizer = load_tokenizer(R.VOCABULARY)
    asked, encode = [], pool.encode
    pool.encode = lambda opening, other: asked.extend(other) or encode(opening, other)
    for i in range(50):
        texts = ["", f"the cat and the dog {i} sat,\non run{i}", " two  spaces ", f"the cat {i * 7} \u2603 the"]
        ids, first, _, _ = pool.of(texts)
        wanted = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == wanted
        assert list(pool.known.values()) == list(range(pool.n)) and pool.n <= 40 + 16
    # A table that starts anew when it is full meets them again each time.
    assert asked.count("cat") == asked.count("the") == asked.count("dog") == 1


def test_frames():
    payloads = [b"", b"a", b"\n" * 50, bytes(range(256))]
    content = b"".join(map(R.frame, payloads))
    assert [bytes(p) for _, p in R.frames(content)] == payloads
    for at in range(0, len(content) - 1, 7):
        broken = bytearray(content)
        broken[at] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            list(R.frames(bytes(broken)))


def test_empty_table(llm_spark, none):
    out = work_folder(llm_spark, "records")
    R.write_records(none, out)
    assert R.record_digests(llm_spark, out).collect() == []


def test_one_id_or_none_in_a_third_of_the_rows(llm_spark):
    """Hot ids spread over many files, and ids still ascend from file to file."""
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, "the same text" if i % 2 else f"text {i}") for i in range(900)]
    frame = llm_spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = work_folder(llm_spark, "records")
    R.write_records(frame, out, file_bytes=300)
    index = R.read_index(llm_spark, out)
    counts = [r["count"] for r in index.groupBy("file").count().collect()]
    assert len(counts) >= 25 and max(counts) < 120
    found = sorted(R.record_digests(llm_spark, out).collect(), key=lambda r: r.start)
    ids = [(r.doc_id is not None, r.doc_id or 0) for r in found]
    assert ids == sorted(ids) and len(ids) == 900
    assert [r.start for r in found] == [sum(r.n_tokens for r in found[:i]) for i in range(900)]


def test_files_are_ordered_by_number(llm_spark):
    names = ["part-99999-u-c000.txt", "part-100000-u-c000.txt", "part-100000-u-c001.txt", "part-00002-u-c010.txt", "part-00002-u-c002.txt"]
    rows = llm_spark.createDataFrame([(n,) for n in names], "file string").orderBy(*R.file_order()).collect()
    assert [r.file for r in rows] == [names[4], names[3], names[0], names[1], names[2]]


def test_files_are_split_by_records(llm_spark):
    out = work_folder(llm_spark, "records")
    R.write_records(llm_spark.range(500).selectExpr("id AS doc_id", "'a b' AS text", "1 AS hash", "2 AS place"), out, per_file=9)
    found = sorted((r.start, r.doc_id) for r in R.record_digests(llm_spark, out).collect())
    assert found == [(3 * i, i) for i in range(500)]
    assert max(r["count"] for r in R.read_index(llm_spark, out).groupBy("file").count().collect()) <= 9


def test_a_full_pool_keeps_the_half_that_is_used_most():
    bpe = runs.ByteBpe(R.VOCABULARY)
    sizes = []

    def encode(opening, other):
        sizes.append(len(opening) + len(other))
        ids, lengths = bpe.joined(opening, other)
        return ids, lengths, lengths

    pool = runs.RunPool(encode, 8, bpe.width)
    texts = ["a b c d", "b a  c", "", "a b e f g h", "x a b", " a", "c d a b"]
    for some in (texts[:3], texts[3:4], texts[4:], texts, texts[::-1]):
        ids, first, numbers, starts = pool.of(some)
        expected = [bpe.tokenizer.encode(t, add_special_tokens=False).ids for t in some]
        assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == expected
        assert [int(numbers[a:b].sum()) for a, b in zip(starts, starts[1:])] == [len(x) for x in expected]
        assert pool.n == len(pool.known) and list(pool.known.values()) == list(range(pool.n))
    pool._trim()
    assert pool.n == len(pool.known) == 4
