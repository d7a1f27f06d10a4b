from __future__ import annotations

import random
import re

import pytest

from statpanel.llm import licenses, queries
from tests.llm import texts


def brute(text):
    """Every template aligned with the whole text, without compression; of stands that overlap the longer stays."""
    placed = licenses.words_of(text)
    found = []
    for template in licenses.templates():
        for a, b, share, changes in licenses.align([w for w, _, _ in placed], template):
            found.append((template.license, placed[a][1], placed[b - 1][2], share, changes))
    found.sort(key=lambda f: (f[1] - f[2], -f[3], len(f[4]), f[0], f[1]))
    kept = []
    for f in found:
        if all(f[2] <= k[1] or f[1] >= k[2] for k in kept):
            kept.append(f)
    return sorted(kept, key=lambda f: f[1])


def plain(found):
    return [(n, a, b, share, diff) for n, a, b, _, share, diff in found]


@pytest.mark.parametrize("seed", range(3))
def test_equals_alignment_without_compression(seed):
    rng = random.Random(seed)
    noise = lambda n: " ".join("".join(rng.choices("abcdefg", k=rng.randint(2, 8))) for _ in range(n))
    parts, count = [noise(200)], 0
    for name, wordings in licenses.TEMPLATES.items():
        for wording in wordings:
            parts += [" ".join(wording.split()), noise(rng.choice([40, 400]))]
            count += 1
    text = "\n".join(parts)
    found = plain(licenses.notices(text))
    assert found == brute(text)
    assert len(found) == count


def test_differences_in_wording():
    wording = " ".join(licenses.TEMPLATES["Apache-2.0"][1].split())
    ((name, a, b, _, share, diff),) = licenses.notices("x " + wording.replace("either express", "expressly") + " y")
    assert name == "Apache-2.0" and a == 2 and 0.9 < share < 1 and diff == ["-either", "-express", "+expressly"]
    for other in ("Licensed under the Apache License, Version 1.1.", "Released under the MITE License.", "Licensed under CC BY-ND 4.0."):
        assert licenses.notices(other) == []


def test_odd_texts(spark):
    notice = "Released under the MIT License."
    rows = [
        (1, notice, 0.1, 1, "x"), (2, "", 0.1, 1, "x"), (3, None, 0.1, 1, "x"), (4, f"é漢 {notice}\n" * 3, 0.1, 1, "x"),
        (5, "license " * 3000, 0.1, 1, "x"), (1, notice, 0.1, 1, "x"), (None, f"{'w ' * 50_000}{notice}", 0.1, 1, "x"),
    ]
    got = licenses.scan(texts.odd(spark, rows)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["1", "1", "4", "4", "4", "None"]
    by = {r[0]: r[1] for r in rows}
    assert all(by[r["doc_id"]][r["start"] : r["end"]] == r["notice"] == notice[:-1] for r in got)
    assert licenses.scan(texts.odd(spark, [])).count() == 0


def test_query_finds_every_plain_notice(spark):
    want = []
    for doc, text in texts.small(spark):
        for name, wordings in licenses.TEMPLATES.items():
            want += [(doc, name, m.start()) for m in re.finditer(re.escape(wordings[0].rstrip(".")), text)]
    got = queries.QUERIES["op5_licenses"](spark, texts.SMALL).collect()
    assert sorted((r["doc_id"], r["license"], r["start"]) for r in got) == sorted(want)


@pytest.mark.parametrize(
    "text, name, notice, diff",
    [
        ("x All rights reserved. y", "Proprietary", "All rights reserved", []),
        ("x Copyright (c) 2024 Acme Corp. All rights reserved. y", "Proprietary", "Copyright (c) 2024 Acme Corp. All rights reserved", []),
        ("x Copyright. All rights reserved.", "Proprietary", "Copyright. All rights reserved", []),
        ("x Licensed under the MIT License y", "MIT", "Licensed under the MIT License", []),
        ("x Distributed under the MIT License y", "MIT", "Distributed under the MIT License", []),
        ("x Released under this MIT License y", "MIT", "Released under this MIT License", ["-the", "+this"]),
        ("x Licensed under the Apache License 2.0", "Apache-2.0", "Licensed under the Apache License 2.0", ["-version"]),
    ],
)
def test_short_wordings(text, name, notice, diff):
    ((found, a, b, _, _, changes),) = licenses.notices(text)
    assert (found, text[a:b], changes) == (name, notice, diff)


def test_short_templates_keep_their_names():
    for other in ("Released under the MIT umbrella, no licence", "all rights, copyright", "Released under the Apache Licenses", "Licensed under the BSD License"):
        assert licenses.notices(other) == []
    assert [n[0] for n in licenses.notices(f"Copyright {'w ' * 13}. All rights reserved.")] == ["Proprietary"]
    assert licenses.notices(f"Copyright {'w ' * 13}. All rights reserved.")[0][1] > 20


def test_every_reservation_in_the_data_is_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("text rlike '(?i)all rights reserved'")
    want = [(r["doc_id"], m.start()) for r in docs.collect() for m in re.finditer("(?i)all rights reserved", r["text"])]
    got = licenses.scan(docs).filter("license = 'Proprietary'").collect()
    assert len(want) >= 7 and sorted((r["doc_id"], r["end"] - len("all rights reserved")) for r in got) == sorted(want)
