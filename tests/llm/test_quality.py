import random
import re
from collections import Counter

import pytest
from tallybrook.llm import quality as Q


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    seen, dup_lines = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup_lines += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, dup_lines, len(repeated)


LINES = [(20, "a b\na b \na b\n\n \n \nx\nx", "en", None), (21, "a b c d e a b c d e f", "en", None), (22, "# | a b a b a b a b", "en", None)]


def test_base_figures(documents, odd, llm_spark):
    more = llm_spark.createDataFrame(LINES, odd.schema)
    frame = documents.select("doc_id", "text", "lang").union(odd.union(more).select("doc_id", "text", "lang"))
    texts = sorted((r.doc_id or 0, r.text) for r in frame.collect() if r.doc_id not in (1, 2) or r.text)
    rows = sorted((r for r in Q.quality_rules(frame).collect()), key=lambda r: r.doc_id or 0)
    found = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
    expected = Counter((r.doc_id, *brute(r.text)) for r in frame.collect())
    assert found == expected and texts
    for r in rows:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_measures():
    runs_of = Q.worker_runs_of(Q.BYTE_VOCABULARY, Q.PIECE_VOCABULARY, Q.WORKER_RUNS)
    fallback = Q.byte_pieces(Q.PIECE_VOCABULARY)
    model, tokenizer = Q.load_pieces(Q.PIECE_VOCABULARY), Q.ByteBpe(Q.BYTE_VOCABULARY).tokenizer
    texts = ["the cat sat on the mat\n\n  twice", "", "☃☃ \x01 ok", "a b " * 40]
    found = Q.fertility(texts, runs_of, fallback)
    for text, row in zip(texts, found):
        pieces, tokens = model.encode(text), tokenizer.encode(text, add_special_tokens=False).ids
        if not pieces:
            assert row.tolist() == [0, 0, 0, 0]
            continue
        n_byte = sum(model.is_byte(i) and model.id_to_piece(i) != "<0x0A>" for i in pieces)
        assert row[:3] == pytest.approx([len(text) / len(tokens), len(text) / len(pieces), n_byte / len(pieces)])
    assert found[3, 3] == pytest.approx(1.0, abs=0.2) and found[0, 3] == Q.ENTROPY_FREE


def test_clean_prose_stays_and_noise_goes(llm_spark, documents):
    noise = "".join(chr(0x1F300 + i % 300) for i in range(600))
    rows = [
        (1, " ".join(noise[i : i + 5] for i in range(0, 600, 5)), "en"),
        (2, "The committee will meet again next week to discuss the remaining points of the plan in detail.", "en"),
        (3, "Комитет соберётся на следующей неделе, чтобы обсудить оставшиеся пункты плана во всех подробностях.", "ru"),
        (4, "委员会 将 在 下周 再次 开会 详细 讨论 计划 的 剩余 要点 和 预算", "zh"),
        (5, " ".join("zq" * 40 + str(i) for i in range(30)), "en"),
    ]
    found = {r.doc_id: r for r in Q.quality_rules(llm_spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert {i: r.kept for i, r in found.items()} == {1: False, 2: True, 3: True, 4: True, 5: False}
    assert [found[i].band for i in (2, 3, 4)] == ["latin", "cyrillic", "cjk"]
    # A band of a language goes before that of its script.
    strict = {**Q.BANDS, "en": Q.Band(99, 99, 0, 99)}
    assert not any(r.kept for r in Q.quality_rules(documents.where("lang = 'en'"), bands=strict, latin_languages={}).collect())


def test_keep_good_keeps_columns(documents, odd, none):
    frame = documents.withColumnRenamed("n_chars", "kept").withColumnRenamed("source", "_rest")
    good = {r.doc_id for r in Q.quality_rules(frame).where("kept").collect()}
    kept = Q.keep_good(frame)
    assert kept.schema == frame.schema
    assert {tuple(r) for r in kept.collect()} == {tuple(r) for r in frame.collect() if r.doc_id in good}
    assert Q.keep_good(none).collect() == [] and Q.quality_rules(none).collect() == []
    assert Q.keep_good(odd.select("doc_id", "text"), lang_column=None).columns == ["doc_id", "text"]


def test_clean_prose_of_more_scripts_stays_and_dumps_go(llm_spark, documents):
    chance = random.Random(1)
    clean = {
        "latin_marked": "Ủy ban sẽ họp lại vào tuần tới để thảo luận chi tiết về những điểm còn lại của kế hoạch và ngân sách.",
        "georgian": "კომიტეტი მომავალ კვირას კვლავ შეიკრიბება, რათა დეტალურად განიხილოს გეგმის დარჩენილი საკითხები და ბიუჯეტი.",
        "ethiopic": "ኮሚቴው በሚቀጥለው ሳምንት እንደገና ተሰብስቦ የዕቅዱን ቀሪ ነጥቦች እና በጀቱን በዝርዝር ይወያያል ብለው አስታወቁ።",
        "myanmar": "ကော်မတီသည် နောက်အပတ်တွင် ထပ်မံ တွေ့ဆုံပြီး အစီအစဉ်၏ ကျန်ရှိသော အချက်များကို အသေးစိတ် ဆွေးနွေး သွားမည် ဟု ပြော သည်။",
        "armenian": "Հանձնաժողովը հաջորդ շաբաթ կրկին կհավաքվի՝ մանրամասն քննարկելու ծրագրի մնացած կետերը և բյուջեն։",
    }
    dump = " ".join(f"{chance.randrange(256):02x}" for _ in range(400))
    letters = " ".join("".join(chance.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(chance.randint(3, 9))) for _ in range(300))
    rows = [(name, text, None) for name, text in clean.items()] + [("vi", clean["latin_marked"], "vi"), ("dump", dump, None)]
    rows += [(f"{x}-{lang}", text, lang) for lang in ("en", "de", "fr", "es") for x, text in (("dump", dump), ("letters", letters))]
    found = {r.doc_id: r for r in Q.quality_rules(llm_spark.createDataFrame(rows, "doc_id string, text string, lang string")).collect()}
    assert {i for i, r in found.items() if r.kept} == {*clean, "vi"}
    assert all(found[name].band == name for name in clean) and found["vi"].band == "latin_marked"
    # No document that keeps the base rules leaves its language's band.
    assert Q.quality_rules(documents).where("NOT base_failed AND NOT kept").count() == 0
