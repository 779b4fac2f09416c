"""Compression bands, quality classifier and licenses."""

import base64
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard

from corpusq.llm import compression, licenses, quality
from corpusq.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {k + d for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for d in range(3)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), failed


def test_compression_counts(spark, documents, odd):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for docs in (documents, odd):
        texts = [(r.doc_id, r.text or "") for r in docs.collect()]
        found = compression.compression_rules(docs, ["doc_id"]).collect()
        assert Counter((r.doc_id, *(r[n] for n in names)) for r in found) == Counter((i, *counts(t)) for i, t in texts)
        assert not any(r.kept and r.base_failed for r in found)


@pytest.mark.parametrize("text", ["a b c a b c a", "\x1c\x85 a\xa0b  ", "a a a a", "x\n x\nx\n\n\n", "|# <", "é ß\ré ß"])
def test_compression_counts_of_odd_text(text):
    assert compression._Rules(compression.Bands()).one(text)[:6] == counts(text)


def test_compression_verdicts():
    rules, rng = compression._Rules(compression.Bands()), np.random.default_rng(3)
    noise = " ".join(bytes(rng.integers(33, 0x7F, 9).astype(np.uint8)).decode() for _ in range(2000))
    cycle = " ".join(f"{k % 400}word" for k in range(399)) + " "
    prose = " ".join("".join(rng.choice(["th", "er", "on", "an", "re"], 3)) for _ in range(3000))
    assert rules.one(noise)[-1] == "incompressible"
    assert rules.one("ab" * 20 + " " + " ".join(f"w{k}" + "z" * 3000 for k in range(60)))[-1] == "repetitive"
    assert rules.one(cycle * 20)[-1] == "base"
    assert rules.one(prose)[-1] == "kept"
    assert rules.one(prose[:12_000] + " " + noise)[-1] == "chunks"
    raw = prose.encode()
    assert rules.one(prose)[8] == len(raw) / len(zstandard.ZstdCompressor(level=3).compress(raw))


def test_compression_judges_the_end_of_a_text():
    rules, rng = compression._Rules(compression.Bands()), np.random.default_rng(3)
    prose = " ".join("".join(rng.choice(["th", "er", "on", "an", "re"], 3)) for _ in range(3000))
    noise = bytes(rng.integers(33, 0x7F, 4096).astype(np.uint8)).decode()
    coded = base64.b64encode(rng.bytes(3072)).decode()
    for end in (2047, 2048):
        assert rules.one(prose[:4096] + noise[:end])[-3:] == (2, 1, "chunks")
        assert rules.one(prose[:4096] + coded[:end])[-3:] == (2, 1, "chunks")
        assert rules.one(prose[: 4096 + end])[-3:] == (2, 0, "kept")
    # A short end counts by its bytes.
    assert rules.one(prose[:4096] + noise[:300])[-3:] == (2, 1, "kept")
    assert rules.one(prose[:8192] + coded[:4096])[-3:] == (3, 1, "chunks")


def test_compression_query(spark, documents):
    found = QUERIES["op1_compression_bands"](spark, SF)
    assert found.columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert found.count() == documents.count()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = found.join(labels.where("quality = 1"), "doc_id").where("not base_failed")
    assert good.where("not kept").count() == 0


def test_compression_keeps_columns(odd, none):
    assert compression.kept_documents(odd).columns == odd.columns
    assert compression.compression_rules(none, ["doc_id"]).count() == 0


def test_word_features_are_those_of_each_word_alone():
    s = quality.Settings(buckets=2**16)
    words = ["a", "the", "häuser", "x" * 3000, "日本語"]
    together, counts_ = quality.word_features(words, s)
    alone = [quality.word_features([w], s)[0] for w in words]
    assert counts_.tolist() == [len(a) for a in alone]
    assert together.tolist() == [i for a in alone for i in a.tolist()]
    assert len(alone[1]) == 1 + 3 + 2 + 1  # the word, its 3-, 4- and 5-grams with both edges


def test_score_is_the_softmax_of_the_average():
    rng = np.random.default_rng(5)
    s = quality.Settings(buckets=512)
    model = quality.Model(rng.normal(size=512).astype(np.float32), 0.3, s)
    text = "on and on on and off"
    total, n = 0.0, 0
    for w in text.split():
        ids = quality.word_features([w], s)[0]
        total, n = total + model.weight[ids].astype(float).sum(), n + len(ids)
    total, n = total + model.weight[-1], n + 1  # "on on"
    assert quality.Scorer(model)([text])["score"][0] == pytest.approx(1 / (1 + np.exp(-(0.3 + total / n))))


def test_new_words_are_learnt_a_block_at_a_time(monkeypatch):
    s = quality.Settings(buckets=512)
    model = quality.Model(np.random.default_rng(5).normal(size=512).astype(np.float32), 0.3, s)
    text = " ".join(f"w{k * 7919}" for k in range(2500))
    monkeypatch.setattr(quality, "LEARN_WORDS", 10**9, raising=False)
    whole, sizes, features = quality.Scorer(model)([text]), [], quality.word_features
    monkeypatch.setattr(quality, "LEARN_WORDS", 1000, raising=False)
    monkeypatch.setattr(quality, "word_features", lambda words, s: sizes.append(len(words)) or features(words, s))
    assert quality.Scorer(model)([text]) == whole
    assert sizes == [1000, 1000, 500]


def test_quality_query_on_held_out_rows(spark):
    found = QUERIES["op10_subword_quality"](spark, "/root/testdata/sf0.01").toPandas()
    assert list(found.columns) == ["doc_id", "held_out", "score", "predicted"]
    assert (found.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in found.doc_id]).all()
    assert found.score.between(0, 1).all() and (found.predicted == (found.score >= 0.3)).all()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    both = found[found.held_out].merge(labels, on="doc_id")
    good, bad = both[both.quality == 1], both[both.quality == 0]
    assert good.predicted.mean() >= 0.97
    assert (np.subtract.outer(good.score.to_numpy(), bad.score.to_numpy()) > 0).mean() > 0.95


def test_quality_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (6, 1), (4, 0), (5, 0), (7, 1), (7, 0), (None, 1), (2, None)], "doc_id bigint, quality int")
    sample = quality.labelled_sample(odd, labels, quality.Settings())
    learnable = [i for i in (4, 5, 6) if zlib.crc32(str(i).encode()) % 5]
    assert sorted(c for c, _ in sample) == sorted({4: [0, 0], 5: [0], 6: [1]}[i][k] for i in learnable for k in range({4: 2, 5: 1, 6: 1}[i]))
    kept = quality.keep_good(odd, labels)
    assert kept.columns == odd.columns
    assert quality.keep_good(none, labels.limit(0)).count() == 0
    # Nothing to learn from: everything is kept.
    assert quality.keep_good(odd, labels.limit(0)).count() == odd.count()


def _notice(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def full_alignment(template, words):
    """Smith-Waterman without a band: matched words of the best alignment."""
    best, above = (0, 0), [(0, 0)] * (len(words) + 1)
    for t in template:
        row = [(0, 0)]
        for j, w in enumerate(words):
            hit = (above[j][0] + 2, above[j][1] + 1) if t == w else (above[j][0] - 1, above[j][1])
            here = max(hit, (above[j + 1][0] - 1, above[j + 1][1]), (row[j][0] - 1, row[j][1]), key=lambda x: x[0])
            row.append(here if here[0] > 0 else (0, 0))
            best = max(best, row[-1])
        above = row
    return best[1]


def test_banded_alignment_equals_the_full_one():
    rng = np.random.default_rng(9)
    for _ in range(60):
        template = rng.integers(0, 12, 30).tolist()
        text = [w for w in template if rng.random() > 0.08]
        for _ in range(2):
            text.insert(int(rng.integers(0, len(text))), 99)
        words = np.array([50] * 7 + text + [51] * 9)
        matched, first, last = licenses.align(template, words, 7 - 12, 7 + 12)
        assert matched == full_alignment(template, words.tolist())
        assert 7 <= first <= last < 7 + len(text)


def full_span(template, words):
    """As ``full_alignment``, with the first and last word of the text that match; ties go as in the engine."""
    none = (0, 0, -1, -1)
    best, above = none, [none] * (len(words) + 1)
    for t in template:
        row = [none]
        for j, w in enumerate(words):
            s, n, first, _ = above[j]
            here = (s + 2, n + 1, first if n else j, j) if t == w else (s - 1, *above[j][1:])
            here = max(here, (above[j + 1][0] - 1, *above[j + 1][1:]), (row[j][0] - 1, *row[j][1:]), key=lambda x: x[0])
            row.append(here if here[0] > 0 else none)
            if row[-1][:2] > best[:2]:
                best = row[-1]
        above = row
    return best[1:]


def test_license_matches_equal_alignment_with_every_template():
    """Edited notices against all templates: no other template or coverage than full alignments give, and the nearest of them."""
    from corpusq.llm.texts import PlainHashes

    rng, hashes = np.random.default_rng(4), PlainHashes()
    short = [(k, name, body) for k, (name, body) in enumerate(licenses.TEMPLATES) if 9 <= len(hashes.of_text(body)) <= 60]
    index = licenses.Index(short)
    texts = []
    for k in rng.choice(len(short), 25, replace=False).tolist():
        words = re.findall(r"[^\W_]+", short[k][2])
        words[int(rng.integers(0, 2))] = "other"
        words.insert(int(rng.integers(len(words) - 1, len(words))), "more")
        texts.append(hashes.of_text(" ".join(["start", "of", "a", "file", *words, "and", "its", "end"])))
    every, nearest = index.all_matches(texts, 0.7), index.nearest(texts, 0.7)
    for words, found, near in zip(texts, every, nearest):
        wanted = {}
        for j, (number, _, _) in enumerate(short):
            matched, first, last = full_span(index.words[j].tolist(), words.tolist())
            if matched >= 0.7 * len(index.words[j]) and np.isin(index.needed[j], words[first : last + 1]).all():
                wanted[number] = matched
        got = {}
        for m in found:
            got[m.template] = max(m.matched, got.get(m.template, 0))
        # Winnowing answers for templates of which the text has five words in a row.
        runs = {tuple(words[k : k + 5].tolist()) for k in range(len(words) - 4)}
        sure = {short[j][0] for j, w in enumerate(index.words) if any(tuple(w[k : k + 5].tolist()) in runs for k in range(len(w) - 4))}
        assert got.items() <= wanted.items() and wanted.keys() & sure <= got.keys() and got
        assert licenses._best(near) == licenses._best(found)


def test_nearest_of_whole_and_edited_bodies():
    from corpusq.llm.license_texts import BODIES, MORE_TEMPLATES
    from corpusq.llm.texts import PlainHashes

    rng, hashes = np.random.default_rng(6), PlainHashes()
    index = licenses.Index([(k, name, body) for k, (name, body) in enumerate(licenses.TEMPLATES)])
    bodies = [body for name, body in MORE_TEMPLATES if name in BODIES and 500 < len(body) < 20_000]
    texts = []
    for body in bodies:
        words = [w for w in body.split() if rng.random() > 0.03]
        at = int(rng.integers(0, len(words)))
        texts += [body, " ".join(words[:at] + ["inserted"] * 5 + words[at:]), body + " " + bodies[0]]
    texts = [hashes.of_text(t) for t in texts]
    for every, near in zip(index.all_matches(texts, 0.7), index.nearest(texts, 0.7)):
        assert licenses._best(near) == licenses._best(every)
    assert licenses.Index([]).nearest(texts[:1], 0.7) == [[]]


def test_winnowing_keeps_a_fingerprint_of_every_shared_run():
    rng = np.random.default_rng(2)
    for _ in range(50):
        grams = rng.integers(0, 2**60, 20).astype(np.uint64)
        chosen = set(licenses.winnowed(grams).tolist())
        assert all(chosen & set(range(k, k + licenses.WINDOW)) for k in range(len(grams) - licenses.WINDOW + 1))


def test_licenses_found_with_spans(spark):
    mit = licenses.TEMPLATES[2][1]
    edited = mit.replace("free of charge, ", "").replace("merge", "combine")
    rows = [(1, "words before.\nLicensed under the Apache License, Version 2.0.\nafter"), (2, f"/* {edited} */"), (3, "License of the public version, under general terms"), (4, None), (5, "")]
    found = {r.doc_id: r for r in licenses.scan_licenses(_notice(spark, rows), ["doc_id"]).collect()}
    assert set(found) == {1, 2}
    assert found[1].license == "Apache-2.0" and found[1].coverage == 1.0
    assert rows[0][1][found[1].start : found[1].end] == "Licensed under the Apache License, Version 2.0"
    assert found[2].license == "MIT" and found[2].template == 2 and 0.9 < found[2].coverage < 1
    assert rows[1][1][found[2].start : found[2].end].startswith("Permission is hereby") and rows[1][1][found[2].start : found[2].end].endswith("of the Software")


def test_licenses_of_all_documents(spark, documents):
    found = QUERIES["op4_license_alignment"](spark, SF).toPandas()
    patterns = {"MIT": "Released under the MIT License", "Apache-2.0": "Licensed under the Apache License, Version 2.0", "GPL-3.0": "GNU General Public License, version 3", "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0"}
    wanted = {(r.doc_id, name) for r in documents.collect() for name, p in patterns.items() if p in r.text}
    assert set(zip(found.doc_id, found.license)) == wanted and wanted


def test_licenses_in_several_passes_and_odd_rows(monkeypatch, spark, odd, none):
    rows = [(1, "Licensed under CC BY-NC 4.0. Released under the MIT License.")]
    once = sorted(licenses.scan_licenses(_notice(spark, rows * 2), ["doc_id"]).collect())
    monkeypatch.setattr(licenses, "TEMPLATES_PER_PASS", 4)
    assert sorted(licenses.scan_licenses(_notice(spark, rows * 2), ["doc_id"]).collect()) == once and len(once) == 4
    assert licenses.scan_licenses(odd, ["doc_id", "label"]).count() == 0
    assert licenses.scan_licenses(none, ["doc_id"]).count() == 0


def test_the_nearest_license_and_version(spark):
    from corpusq.llm.license_texts import BODIES, MORE_TEMPLATES

    gnu = "This {0} is free software; you can redistribute it and/or modify it under the terms of the GNU {1}General Public License as published by the Free Software Foundation; either version {2} of the License, or (at your option) any later version."
    texts = {
        "GPL-2.0": gnu.format("program", "", "2"), "GPL-3.0": gnu.format("program", "", "3"), "AGPL-3.0": gnu.format("program", "Affero ", "3"),
        "LGPL-2.1": gnu.format("library", "Lesser ", "2.1"), "LGPL-3.0": gnu.format("library", "Lesser ", "3"),
        "MPL-2.0": "// This Source Code Form is subject to the terms of the Mozilla Public\n// License, v. 2.0. If a copy of the MPL was not distributed with this\n// file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0 which accompanies this distribution",
        "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.", "CC0-1.0": "Licensed under CC0 1.0 Universal.", "Unlicense": "Released under the Unlicense.",
        "Apache-1.1": "Licensed under the Apache License, Version 1.1.", "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.", "BUSL-1.1": "SPDX-License-Identifier: BUSL-1.1",
    }
    bodies = {name: body for name, body in MORE_TEMPLATES if name in BODIES or name.startswith(("BSD", "MIT", "ISC", "0BSD")) and len(body) > 500}
    rows = [(k, f"words before\n{t}\nand words after") for k, t in enumerate([*texts.values(), *bodies.values()])]
    found = {}
    for r in licenses.scan_licenses(_notice(spark, rows), ["doc_id"]).collect():
        found.setdefault(r.doc_id, set()).add(r.license)
    assert found == {k: {name} for k, name in enumerate([*texts, *bodies])}


def test_unknown_versions_and_names_are_no_match(spark):
    rows = [(1, "Licensed under the Apache License, Version 7.0."), (2, "Released under the Foo License."), (3, licenses.TEMPLATES[6][1].replace("version 3", "version 9"))]
    assert licenses.scan_licenses(_notice(spark, rows), ["doc_id"]).count() == 0
