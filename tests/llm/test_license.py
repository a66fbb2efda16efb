"""Operator 2 against alignment of every template with every text."""

import random
from collections import Counter

import numpy as np

from lakestar.llm import license_scan as scan
from lakestar.llm.license_texts import TEMPLATES

INDEX = scan.Index(TEMPLATES)


def brute(text, coverage=scan.COVERAGE):
    """Names of the templates that a longest common subsequence in some stretch of the text covers."""
    words = scan.words_of(text)
    names = set()
    for name, template in TEMPLATES.items():
        pattern = scan.words_of(template)
        width = len(pattern) + scan.BAND
        for at in range(max(1, len(words) - len(pattern) + 1)):
            piece = words[at : at + width]
            if len(set(pattern) & set(piece)) < 0.6 * len(set(pattern)):
                continue
            row = [0] * (len(piece) + 1)
            for p in pattern:
                last = row[:]
                for j, w in enumerate(piece):
                    row[j + 1] = last[j] + 1 if p == w else max(row[j], last[j + 1])
            if row[-1] >= coverage * len(pattern) if len(pattern) >= scan.SHORT else piece[: len(pattern)] == pattern:
                names.add(name)
                break
    return names


def test_every_template_is_found_whole():
    for name, template in TEMPLATES.items():
        text = f"Some words before it. {template} And some after."
        found = scan.spans(INDEX, text)
        top = max(found, key=lambda m: m.matched)
        assert top.coverage == 1.0 and scan.words_of(text[top.start : top.end]) == scan.words_of(TEMPLATES[top.license])
        assert top.license == name or scan.words_of(TEMPLATES[top.license]) == scan.words_of(template)


def test_edited_texts_are_found_and_others_are_not():
    rnd = random.Random(4)
    for name in ("MIT", "GPL-3.0", "Apache-2.0", "BSD-2-Clause"):
        words = TEMPLATES[name].split()
        for i in rnd.sample(range(len(words)), len(words) // 20):
            words[i] = rnd.choice(["", "thing", "other words"])
        text = "intro " * 30 + " ".join(words) + " end" * 20
        found = scan.spans(INDEX, text)
        assert name in {m.license for m in found}
        m = max(found, key=lambda m: m.matched)
        assert 0.8 <= m.coverage < 1 and abs(m.start - text.index(words[0] or words[1])) < 60
    half = " ".join(TEMPLATES["MIT"].split()[:60])
    assert not any(m.license == "MIT" for m in scan.spans(INDEX, half))
    assert scan.spans(INDEX, "the license of the software is free and the copy is without warranty of any kind") == []


def test_repeats_and_nesting():
    assert len(scan.spans(INDEX, "Released under the MIT License. " * 40)) == 40
    nested = scan.spans(INDEX, TEMPLATES["Apache-2.0"])
    assert [m.license for m in nested] == ["Apache-2.0"]  # its first words are a notice of their own


def test_winnowing_shares_a_fingerprint():
    rnd = np.random.default_rng(2)
    for _ in range(200):
        shared = rnd.integers(1, 50, scan.WINDOW + scan.GRAM - 1)
        sides = [np.concatenate((rnd.integers(1, 50, 9), shared, rnd.integers(1, 50, 9))) for _ in range(2)]
        chosen = [set(h[scan.winnowed(h)].tolist()) for h in (scan.gram_hashes(s, 51) for s in sides)]
        assert chosen[0] & chosen[1]


def test_query(odd, documents, empty):
    for df in (odd, documents):
        got = {}
        for r in scan.scanned(df).collect():
            got.setdefault(r["doc_id"], set()).add(r["license"])
        for r in df.dropDuplicates(["doc_id"]).collect():
            found = got.get(r["doc_id"], set())
            if len(r["text"] or "") < 20_000:
                assert found == brute(r["text"] or ""), r["doc_id"]
    twice = documents.union(documents)
    counts = Counter(map(tuple, scan.scanned(twice).collect()))
    assert counts and all(n == 2 for n in counts.values())
    assert scan.scanned(empty).count() == 0


def test_rights_reserved_lines(documents):
    """Licence lines as they are written in documents, not as the templates have them."""
    line = "All rights reserved."
    for text in (line, "all  rights\nreserved", f"Chapter one. {line} Chapter two. " * 9, f"x {line} y"):
        assert [m.license for m in scan.spans(INDEX, text)] == ["rights-reserved-notice"] * text.lower().count("rights")
    rnd = random.Random(6)
    for _ in range(300):  # whatever stands beside it: fingerprints of the neighbours must not hide it
        beside = [" ".join(rnd.choice(["copyright", "software", "of", "version", "stone", "river"]) for _ in range(rnd.randrange(6))) for _ in range(2)]
        assert "rights-reserved-notice" in {m.license for m in scan.spans(INDEX, f"{beside[0]}. {line} {beside[1]}")}
    tail = "No part of this publication may be reproduced without permission."
    for head in ("Copyright.", "Copyright 2021 Acme.", "Copyright (c) 2019-2021 by Smith & Sons Ltd.", "Copyright \u00a9 2020 A. Person and B. Person."):
        text = f"Before. {head} {line} {tail} After."
        (m,) = scan.spans(INDEX, text)
        assert m.license == "rights-reserved" and text[m.start : m.end] == f"{head} {line} {tail}"[:-1]
    assert scan.spans(INDEX, "All rights are reserved. All rights waived.") == []
    texts = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    got = Counter(r["doc_id"] for r in scan.scanned(documents).collect() if r["license"] == "rights-reserved-notice")
    assert got == Counter({k: n for k, t in texts.items() if (n := t.count(line))})


def test_siblings_are_told_apart():
    """Headers and texts as works carry them, written out here."""
    tail = "either version {} of the License, or (at your option) any later version.\n\n * This {} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU {} License for more details.\n"
    head = " * This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {} License as published by the Free Software Foundation; "
    for name, kind, version, work in (
        ("GPL-2.0", "General Public", "2", "program"),
        ("GPL-3.0", "General Public", "3", "program"),
        ("LGPL-2.0", "Library General Public", "2", "library"),
        ("LGPL-2.1", "Lesser General Public", "2.1", "library"),
        ("LGPL-3.0", "Lesser General Public", "3", "program"),
        ("LGPL-3.0", "Lesser General Public", "3", "library"),
        ("AGPL-3.0", "Affero General Public", "3", "program"),
    ):
        text = "Copyright 2020 Somebody\n" + (head + tail).format(work, kind, version, work, kind)
        assert [m.license for m in scan.spans(INDEX, text)] == [name], (name, work)
    clauses = [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ]
    third = "3. Neither the name of Acme Inc. nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    advertising = "3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by Acme Inc."
    warranty = (
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF '
        "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT OWNER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
        "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN "
        "IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    )
    for name, parts in (("BSD-2-Clause", []), ("BSD-3-Clause", [third]), ("BSD-4-Clause", [advertising, third])):
        assert [m.license for m in scan.spans(INDEX, "\n".join([*clauses, *parts, warranty]))] == [name]
    text = "Released by us. Copyright 2001 Acme. " + head.format("program", "General Public") + tail.format("4", "program", "General Public")
    assert scan.spans(INDEX, text) == []  # a version that no template has
