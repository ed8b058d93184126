"""Licences, language, quality and token counts: brute force, the tokenizer library, and held-out accuracy."""

from __future__ import annotations

import random
import re
import zlib
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tierlake.llm.language import Parser, count_phrases, equal_shares, learn_samples, normalise, predict_language, suffix_automaton
from tierlake.llm.license_scan import NOTICES, bands_for, scan_licenses
from tierlake.llm.common import mix
from tierlake.llm.quality import SHAPES, SHARPNESS, drop_low_quality, score_quality, term_counts, train
from tierlake.llm.token_counts import Counter, count_tokens, merged_length, read_merges

FOLDER = Path("/root/testdata/sf0.01")
needs_tables = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not here")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def held_out(key):
    return zlib.crc32(b"" if key is None else str(key).encode()) % 4 == 2


def plain_shingles(text, size=5):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
    return [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []


def test_every_notice_is_found_whole_and_with_small_changes(spark):
    rng = random.Random(2)
    filler = lambda n: " ".join("f{}".format(rng.randrange(10**6)) for _ in range(n))
    docs, expected = [], {}
    for name, text in NOTICES:
        for changed in (False, True):
            words = text.split()
            if changed:
                words[-1] = "changed"
            docs.append((len(docs), "{} {} {}".format(filler(rng.randrange(300)), " ".join(words), filler(rng.randrange(300)))))
            expected[len(docs) - 1] = name
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = {(r["row_id"], r["license"]): r["containment"] for r in scan_licenses(frame).collect()}
    for i, text in docs:
        held = set(plain_shingles(text))
        for name in {n for n, _ in NOTICES}:
            shares = [len(held & set(plain_shingles(t))) / len(set(plain_shingles(t))) for n, t in NOTICES if n == name]
            if max(shares) >= 0.8:
                assert found.pop((i, name)) == pytest.approx(max(shares))
    assert not found


def test_licences_that_share_words_are_told_apart(spark):
    gnu = (
        "{} is free software{} you can redistribute it and/or modify it under the terms of the GNU {}General Public License as "
        "published by the Free Software Foundation, either version {} of the License, or (at your option) any later version. "
        "It is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY."
    )
    bsd = (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: * Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. * Redistributions in binary form must reproduce the above copyright notice, this "
        "list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
    )
    third = (
        "* Neither the name of Example Inc. nor the names of its contributors may be used to endorse or promote products derived "
        "from this software without specific prior written permission. "
    )
    adverts = (
        "All advertising materials mentioning features or use of this software must display the following acknowledgement: This "
        "product includes software developed by Example Inc. "
    )
    granted = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted{} "
    as_is = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE.'
    notice = ", provided that the above copyright notice and this permission notice appear in all copies."
    mit = next(t for n, t in NOTICES if n == "MIT" and len(t) > 100)
    texts = [
        ({"GPL-2.0"}, gnu.format("This program", ";", "", "2")),
        ({"GPL-3.0"}, gnu.format("Foo", ":", "", "3")),
        ({"LGPL-2.0"}, gnu.format("This library", ";", "Library ", "2")),
        ({"LGPL-2.1"}, gnu.format("This library", ";", "Lesser ", "2.1")),
        ({"LGPL-3.0"}, gnu.format("Foo", ":", "Lesser ", "3")),
        ({"AGPL-3.0"}, gnu.format("This program", ":", "Affero ", "3")),
        ({"AGPL-3.0", "GPL-3.0"}, gnu.format("This program", ":", "Affero ", "3") + gnu.format("This program", ":", "", "3")),
        ({"GPL-2.0"}, "This work is licensed under the GNU General Public License, version 2."),
        ({"LGPL-3.0"}, "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
        ({"BSD-2-Clause"}, bsd + as_is),
        ({"BSD-3-Clause"}, bsd + third + as_is),
        ({"BSD-3-Clause"}, bsd.replace("* ", "1. ") + third.replace("* ", "3. ") + as_is),
        ({"BSD-4-Clause"}, bsd + adverts + third + as_is),
        ({"BSD-2-Clause", "BSD-3-Clause"}, bsd + as_is + " filler" * 300 + " " + bsd + third),
        ({"ISC"}, granted.format(notice) + as_is),
        ({"0BSD"}, granted.format(".") + as_is),
        ({"MIT"}, mit + " The above copyright notice and this permission notice shall be included. " + as_is),
        ({"MIT-0"}, mit.split(", subject to")[0] + ". " + as_is),
        ({"CC-BY-NC-SA-4.0"}, "Licensed under CC BY-NC-SA 4.0."),
        ({"EPL-2.0"}, "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at x"),
        ({"BSL-1.0"}, "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt)"),
    ]
    frame = spark.createDataFrame([(i, "before it " * (7 * i) + t + " after it" * 30) for i, (_, t) in enumerate(texts)], "doc_id long, text string")
    found = [set() for _ in texts]
    for r in scan_licenses(frame).collect():
        found[r["row_id"]].add(r["license"])
    assert found == [names for names, _ in texts]


def test_licences_of_odd_documents(odd_docs, no_docs):
    assert scan_licenses(odd_docs).collect() == [] and scan_licenses(no_docs).collect() == []
    found = scan_licenses(odd_docs, notices=[("x", "one")], words=5).select("row_id").collect()
    assert sorted(str(r[0]) for r in found) == ["10", "9", "9", "None"]


def test_bands_miss_no_more_than_asked():
    for size, block in ((1, 1), (3, 4), (40, 64)):
        shared = -(-8 * size // 10)
        assert (1 - shared / (2 * block + size - shared)) ** bands_for(size, block, 0.8, 1e-4) <= 1e-4


def greedy_phrases(text, sample):
    count, at = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in sample:
            size += 1
        count, at = count + 1, at + size
    return count


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab c", min_size=1, max_size=40), st.lists(st.text(alphabet="abcd ", max_size=60), max_size=6))
def test_phrases_are_the_greedy_parse(sample, texts):
    states = suffix_automaton(sample)
    assert len(states) <= 2 * len(sample)
    points, bounds = normalise(texts)
    found = count_phrases(points, bounds, [Parser(sample)])[:, 0]
    clean = ["".join(map(chr, points[a:b])) for a, b in zip(bounds, bounds[1:], strict=False)]
    assert found.tolist() == [greedy_phrases(t, sample) for t in clean]


def test_large_alphabets_take_little_memory(spark):
    rng = random.Random(5)
    letters = [chr(0x4E00 + i) for i in range(2500)]
    sample = "".join(rng.choice(letters) for _ in range(16_000))
    parser = Parser(sample)
    assert parser.table.nbytes + parser.rare.nbytes + parser.rare_target.nbytes + parser.symbols.nbytes < 20_000_000
    texts = [sample[i : i + 40] + "".join(rng.choice(letters) for _ in range(30)) + "a" + sample[-9:] for i in range(0, 3000, 300)]
    points, bounds = normalise(texts)
    assert count_phrases(points, bounds, [parser])[:, 0].tolist() == [greedy_phrases(t, sample) for t in texts]


def test_samples_cover_whole_texts_in_equal_shares(spark):
    assert equal_shares([5, 100, 100], 105) == 50 and equal_shares([3, 4], 100) == 4 and equal_shares([], 5) == 0
    assert equal_shares([10, 10], 7) == 3
    opening = "".join("header words all alike " for _ in range(200))
    rows = [(i, opening + "".join("{} ".format("abcdefgh"[i % 8] * (3 + j % 5)) for j in range(4000)), "xx") for i in range(64)]
    rows.append((1000, "short", "xx"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = learn_samples(docs, "doc_id", "text", "lang", 48, 16_000)["xx"]
    assert 15_900 <= len(sample) <= 16_000
    assert sample.count("header") * len("header words all alike ") < len(sample) / 2
    assert sum(c * 3 in sample for c in "abcdefgh") == 8


@needs_tables
def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(str(FOLDER / "documents.parquet"))
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    found = predict_language(docs).collect()
    assert len(found) == len(truth) and all(r["held_out"] == held_out(r["row_id"]) for r in found)
    asked = [r for r in found if r["held_out"] and truth[r["row_id"]]]
    assert np.mean([r["lang_pred"] == truth[r["row_id"]] for r in asked]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_of_odd_documents(odd_docs, no_docs):
    found = {(r["row_id"], r["lang_pred"]) for r in predict_language(odd_docs).collect()}
    assert {(4, "und"), (5, "und"), (6, "und")} <= found and {k for k, v in found if v == "und"} == {4, 5, 6}
    assert predict_language(no_docs).collect() == []
    assert {r["lang_pred"] for r in predict_language(odd_docs, samples={}).collect()} == {"und"}


@needs_tables
def test_quality_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet("{}/{}.parquet".format(FOLDER, t)) for t in ("documents", "labels"))
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    model = train(docs, labels)
    found = score_quality(docs, model).collect()
    assert len(found) == docs.count() and all(r["held_out"] == held_out(r["row_id"]) for r in found)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in found)
    asked = [r for r in found if r["held_out"] and r["row_id"] in truth]
    assert np.mean([r["predicted"] == truth[r["row_id"]] for r in asked]) > 0.93
    kept = {r["doc_id"] for r in drop_low_quality(docs, labels).collect()}
    assert kept == {r["row_id"] for r in found if r["score"] >= 0.5}


def plain_terms(text, terms):
    data, found = text.encode(), [0] * terms
    for i in range(len(data) - 2):
        code = data[i] << 16 | data[i + 1] << 8 | data[i + 2]
        found[(code * 2654435761 % 2**32 >> 8) % (terms - SHAPES)] += 1
    words = re.findall("[^\x20\x09-\x0d]+", text.translate(LOWER))
    for i in range(len(words) - 4):
        run, shape = words[i : i + 5], 0
        for word in run[1:]:
            shape = shape * 5 + run.index(word)
        found[terms - SHAPES + int(mix(np.array([shape], dtype=np.uint64))[0]) % SHAPES] += 1
    return found


@needs_tables
def test_votes_are_those_of_the_nearest_of_all_sample_rows(spark):
    docs, labels = (spark.read.parquet("{}/{}.parquet".format(FOLDER, t)) for t in ("documents", "labels"))
    model = train(docs, labels, sample_rows=60, neighbours=9)
    asked = docs.orderBy("doc_id").limit(80)
    texts = {r["doc_id"]: r["text"] or "" for r in asked.collect()}
    found = {r["row_id"]: r["score"] for r in score_quality(asked, model).collect()}
    assert found.keys() == texts.keys() and 40 < model.labels.size <= 120
    share, held = model.labels.mean(), model.vectors.astype(float)
    for key, text in texts.items():
        vector = np.log1p(plain_terms(text, model.idf.size)) * model.idf
        vector = (vector / max(np.linalg.norm(vector), 1e-9)) @ model.projection
        vector /= max(np.linalg.norm(vector), 1e-9)
        near = sorted(((float(h @ vector), int(q)) for h, q in zip(held, model.labels, strict=True)), reverse=True)[:9]
        weights = [max(c, 1e-6) ** SHARPNESS * (model.prior / share if q else (1 - model.prior) / (1 - share)) for c, q in near]
        wanted = sum(w for w, (_, q) in zip(weights, near, strict=True) if q) / sum(weights)
        assert found[key] == pytest.approx(wanted if text else model.prior, abs=2e-3), key


def test_terms_do_not_cross_texts():
    texts = ["a b c d e", "", "x", "a a a a a a", "one two one two one", "ß é ß é ß"]
    data = b"".join(t.encode() for t in texts)
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    found = term_counts(offsets, np.frombuffer(data, dtype=np.uint8), 1024)
    assert found.tolist() == [plain_terms(t, 1024) for t in texts]


def test_quality_of_odd_documents(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in score_quality(odd_docs, train(odd_docs, none)).collect()} == {0.5}
    labels = spark.createDataFrame([(1, 1), (2, 1), (7, 0), (7, 1), (9, None), (None, 0), (11, 0)], "doc_id long, quality int")
    model = train(odd_docs, labels)
    assert sorted(model.labels.tolist()) == sorted(float(q) for k, q in ((1, 1), (2, 1), (11, 0)) if not held_out(k))
    assert len(score_quality(odd_docs, model).collect()) == odd_docs.count()
    assert score_quality(no_docs, model).collect() == []
    assert drop_low_quality(odd_docs, labels).columns == odd_docs.columns


tokenizers = pytest.importorskip("tokenizers")
vocabularies = pytest.importorskip("public_tokenizers")
HOSTILE = [
    "", " ", "  a", "a  ", "\n\n x\t\r\n", "don't we'll I'M 've", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext",
    "　\xa0x\x85 y\x1c\x1f z", "1234567890 ½ ² ٣", "été 日本語 \U0001f600‍\U0001f600 ́", "a" * 5000, " " * 700, "ab" * 2000 + "!?" * 900,
]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(vocabularies.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def counter():
    return Counter(*read_merges(vocabularies.path("byte_bpe_50k.json")))


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_counts_equal_the_library_on_any_text(library, counter, text):
    assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_counts_equal_the_library_on_hostile_texts(spark, library):
    rows = list(enumerate(HOSTILE)) + [(99, None), (None, "a"), (None, "a")]
    found = count_tokens(spark.createDataFrame(rows, "doc_id long, text string"), vocabularies.path("byte_bpe_50k.json"), limit=3).collect()
    expected = [(k, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for k, t in rows]
    assert sorted((tuple(r)[:3] for r in found), key=str) == sorted(expected, key=str)
    assert all(r["over_limit"] == (r["n_tokens"] > 3) for r in found)


def test_counts_of_every_code_point(library, counter):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    wrong = [hex(ord(c)) for c in points[:0x3100] if counter.count("a" + c + " b") != len(library.encode("a" + c + " b", add_special_tokens=False).ids)]
    assert not wrong


def test_merging_takes_the_lowest_rank_first():
    ranks = {(b"b", b"c"): 0, (b"a", b"b"): 1, (b"a", b"bc"): 2, (b"a", b"a"): 3}
    assert [merged_length(p, ranks) for p in (b"", b"a", b"abc", b"abab", b"aaa", b"aaaa")] == [0, 1, 1, 2, 2, 2]


def test_other_tokenizer_kinds_are_refused():
    with pytest.raises(ValueError):
        read_merges(vocabularies.path("word_bpe_49k.json"))
