import random
import re

import pytest
from tallybrook.llm import licenses as L


def brute(text, templates, containment=L.CONTAINMENT):
    """Templates of which some stretch of the text, no longer than any window, holds enough."""

    def shingles(t):
        words = re.findall(r"[a-z0-9]+", t.lower())
        return [tuple(words[i : i + 3]) for i in range(len(words) - 2)]

    found, mine = set(), shingles(text)
    for name, template in templates.items():
        wanted = set(shingles(template))
        n = len(shingles(template))
        if any(len(wanted & set(mine[i : i + n])) >= containment * len(wanted) for i in range(len(mine))):
            found.add(name)
    return found


def scan(spark, rows, **options):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return [tuple(r) for r in L.scan_licenses(frame, **options).collect()]


def test_planted_templates_are_found(llm_spark):
    chance = random.Random(6)
    filler = lambda n: [chance.choice("abcdefgh") * chance.randint(1, 5) for _ in range(n)]
    rows, wanted = [], {}
    for i in range(120):
        name = chance.choice(list(L.TEMPLATES))
        words = L.TEMPLATES[name].split()
        if i % 2 and len(words) > 20:
            words[chance.randrange(len(words))] = "edited"
        if i % 3 == 0:
            words = [w.upper() for w in words]
        text = " ".join(filler(chance.randint(0, 300)) + words + filler(chance.randint(0, 300)))
        rows.append((i, text))
        wanted[i] = name
    found = {}
    for doc_id, name, first, last, share in scan(llm_spark, rows):
        found.setdefault(doc_id, set()).add(name)
        words = re.findall(r"[a-z0-9]+", dict(rows)[doc_id].lower())
        template = re.findall(r"[a-z0-9]+", L.TEMPLATES[name].lower())
        assert share >= 0.8 and last - first < 1.3 * len(template) and set(words[first : last + 1]) & set(template)
    for i, text in rows:
        assert brute(text, L.TEMPLATES) <= found[i] and wanted[i] in found[i]


def test_documents_against_brute_force(documents, llm_spark):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    expected = {(i, name) for i, t in rows for name in brute(t, L.TEMPLATES)}
    assert {x[:2] for x in scan(llm_spark, rows)} == expected != set()


def test_two_occurrences_odd_rows_and_no_templates(llm_spark, odd, none):
    line = L.TEMPLATES["MIT-line"]
    rows = scan(llm_spark, [(1, f"{line} x y z w v u t s r q p o n m {line}"), (1, None), (None, line)])
    assert sorted(rows, key=str) == [(1, "MIT-line", 0, 4, 1.0), (1, "MIT-line", 19, 23, 1.0), (None, "MIT-line", 0, 4, 1.0)]
    assert L.scan_licenses(odd.withColumnRenamed("lang", "license")).collect() == [] == L.scan_licenses(none).collect()
    with pytest.raises(ValueError, match="fewer"):
        L.scan_licenses(odd, templates={"x": "two words"})


def test_an_occurrence_may_begin_anywhere():
    name, text = "Apache-2.0-notice", L.TEMPLATES["Apache-2.0-notice"]
    known = L.prepare(tuple(L.TEMPLATES.items()))
    for shift in range(0, 140):
        filler = " ".join(f"w{i}" for i in range(shift))
        found, _ = L.shingles(L.text_bytes(L.pa.array([f"{filler} {text} {filler}"])))
        assert name in {known.names[m.template] for m in L.matches(found, known)}


def test_usual_statements_and_whole_texts(llm_spark):
    said = {
        "CC-BY-4.0-short": "Licensed under CC BY 4.0.",
        "MIT-licensed": "Licensed under the MIT License",
        "LGPL-line": "licensed under the GNU Lesser General Public License",
        "AGPL-3.0-line": "licensed under the GNU Affero General Public License",
        "BSL-1.0-line": "Distributed under the Boost Software License, Version 1.0",
        **{name: L.TEMPLATES[name] for name in ("BSD-disclaimer", "MIT-disclaimer", "Zlib", "BSL-1.0", "CC0-1.0-line")},
        **L.full_texts(),
    }
    assert {"Apache-2.0-text", "CC0-1.0-text", "GPL-3.0-text", "LGPL-3.0-text", "MPL-2.0-text"} <= set(said)
    names = list(said)
    rows = [(i, f"some words before it {said[name]} and some behind") for i, name in enumerate(names)]
    found = {(i, name) for i, name, *_ in scan(llm_spark, rows)}
    assert set(enumerate(names)) <= found
