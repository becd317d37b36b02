"""Licence scans on headers as they stand in files, and against the SQL on a mixed fixture."""

import random

import duckdb
import pytest

from roadpulse.llm import licenses, oracles

GPL = """/*
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU {}General Public License as published by
 * the Free Software Foundation, either version {} of the License, or
 * (at your option) any later version.
 */"""
APACHE = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that:
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
   products derived from this software without specific prior written permission."""
ZLIB = """In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose"""
TEXTS = [
    (GPL.format("", 3), "gpl-3"),
    (GPL.format("", 2), "gpl-2"),
    (GPL.format("Lesser ", 3), "lgpl"),
    (GPL.format("Affero ", 3), "agpl-3"),
    (APACHE, "apache-2"),
    (ISC, "isc"),
    (BSD, "bsd,bsd-3"),
    (ZLIB, "zlib"),
    ("// Distributed under the Boost Software License, Version 1.0. (See accompanying file)", "boost-1"),
    ("// SPDX-License-Identifier: MIT", "mit"),
    ("// SPDX-License-Identifier: GPL-3.0-or-later", "gpl-3"),
    ("# SPDX-License-Identifier: BSD-3-Clause", "bsd-3"),
    ("text under a Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa"),
    ("text under a Creative Commons Attribution 4.0 International License", "cc-by"),
    ("This is licensed under CC BY-SA 4.0.", "cc-by-sa"),
    ("the materials are made available under the terms of the Eclipse Public License 2.0", "epl-2"),
    ("the general public may use this software for free; the foundation has its terms", ""),
    ("this program is free software, published by a foundation; see the license", ""),
]


@pytest.mark.parametrize("before", ["", "word " * 500])
def test_headers_as_they_stand_in_files(spark, before):
    df = spark.createDataFrame([(n, before + text) for n, (text, _) in enumerate(TEXTS)], "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in licenses.license_scan(df).collect()}
    assert [got[n] for n in range(len(TEXTS))] == [labels for _, labels in TEXTS]


def test_every_key_phrase_stands_in_its_notice_and_holds_a_rare_word():
    for _, notice, phrases in licenses.NOTICES:
        assert all(f" {p} " in f" {notice} " for p in phrases) and len(licenses._rare(notice)) >= 1
    assert all(word in phrase.split() for phrase, word in licenses.key_phrases())


def test_against_sql_on_notices_that_are_cut_and_mixed(spark):
    rng, rows = random.Random(4), []
    for n in range(150):
        words = []
        for _ in range(rng.randrange(4)):
            part = rng.choice(licenses.NOTICES)[1].split()
            low = rng.choice([0, 0, rng.randrange(len(part))])
            words += [f"w{rng.randrange(9)}" for _ in range(rng.randrange(5))] + part[low : rng.choice([None, None, low + 6])]
        rows.append((n, " ".join(words)))
    got = spark.createDataFrame(rows, "doc_id long, text string")
    got = licenses.license_scan(got).toPandas().sort_values("doc_id").reset_index(drop=True)
    engine = duckdb.connect()
    engine.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    engine.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = engine.execute(oracles.license_scan_sql()).df().sort_values("doc_id").reset_index(drop=True)
    key = ["doc_id", "n_words", "n_base", "base_labels", "labels", "score"]
    assert got[key].values.tolist() == want[key].values.tolist()
    assert (want["labels"] != "").sum() > 60
