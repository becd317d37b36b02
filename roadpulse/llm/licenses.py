"""License scans: a positional index over the rare words of licence notices.

Each document's words that occur in any notice are kept with their places. Over the corpus these words
get an inverse document frequency. For each document and notice the words of highest frequency weight
are looked up in the notice's postings; equal differences of place mean the words stand as they do in
the notice. Notices with enough words in line are confirmed by their key phrases. Phrases of the base
list are found exactly, whatever the index says. DataFrame functions only.

Null and empty texts: no words, no labels, score 0. A null doc_id stays null. Repeated rows are
answered each (rows are told apart by a number of their own, fixed when the digest is written). Long
texts are linear: only places of notice words leave the row. Extra columns are ignored. Empty
tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import lower_ascii
from roadpulse.session import materialize

LICENCE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrase and label of the base scan.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Label, notice as words, key phrases that must be present.
NOTICES = [
    ("mit", "released under the mit license", ["the mit license"]),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software"
        " and associated documentation files",
        ["permission is hereby granted free of charge"],
    ),
    ("apache-2", "licensed under the apache license version 2 0", ["apache license"]),
    ("gpl-3", "licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    ("gpl-2", "licensed under the gnu general public license version 2", ["gnu general public license version 2"]),
    ("lgpl", "gnu lesser general public license", ["gnu lesser general public license"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by", "licensed under cc by 4 0", ["cc by 4 0"]),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted",
        ["redistribution and use in source and binary forms"],
    ),
    (
        "mpl-2",
        "subject to the terms of the mozilla public license v 2 0",
        ["mozilla public license"],
    ),
    (
        "unlicense",
        "free and unencumbered software released into the public domain",
        ["released into the public domain"],
    ),
    ("all-rights-reserved", "all rights reserved", ["all rights reserved"]),
    (
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance"
        " with the license you may obtain a copy of the license at",
        ["apache license version 2 0", "you may not use this file except in compliance with the license"],
    ),
    (
        "gpl-3",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by"
        " the free software foundation either version 3 of the license or at your option any later version",
        ["the gnu general public license as published by the free software foundation", "version 3 of the license"],
    ),
    (
        "gpl-2",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by"
        " the free software foundation either version 2 of the license or at your option any later version",
        ["the gnu general public license as published by the free software foundation", "version 2 of the license"],
    ),
    (
        "agpl-3",
        "under the terms of the gnu affero general public license as published by the free software foundation"
        " either version 3 of the license",
        ["gnu affero general public license"],
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
        " granted provided that the above copyright notice and this permission notice appear in all copies",
        ["distribute this software for any purpose with or without fee is hereby granted"],
    ),
    (
        "bsd-3",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
        " products derived from this software without specific prior written permission",
        ["may be used to endorse or promote products derived from this software"],
    ),
    (
        "boost-1",
        "distributed under the boost software license version 1 0",
        ["boost software license version 1 0"],
    ),
    (
        "boost-1",
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software"
        " and accompanying documentation covered by this license",
        ["any person or organization obtaining a copy of the software and accompanying documentation"],
    ),
    (
        "zlib",
        "in no event will the authors be held liable for any damages arising from the use of this software permission"
        " is granted to anyone to use this software for any purpose",
        ["held liable for any damages arising from the use of this software"],
    ),
    (
        "epl-2",
        "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0",
        ["eclipse public license 2 0"],
    ),
    (
        "cc-by",
        "licensed under a creative commons attribution 4 0 international license",
        ["creative commons attribution 4 0"],
    ),
    (
        "cc-by-nc",
        "licensed under a creative commons attribution noncommercial 4 0 international license",
        ["creative commons attribution noncommercial 4 0"],
    ),
    (
        "cc-by-sa",
        "licensed under a creative commons attribution sharealike 4 0 international license",
        ["creative commons attribution sharealike 4 0"],
    ),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa 4 0"]),
    ("cc0", "cc0 1 0 universal public domain dedication", ["cc0 1 0 universal"]),
]

#: Label, and identifier of the short form as words.
IDENTIFIERS = [
    ("mit", "mit"), ("apache-2", "apache 2 0"), ("gpl-2", "gpl 2 0"), ("gpl-3", "gpl 3 0"), ("agpl-3", "agpl 3 0"),
    ("lgpl", "lgpl 2 1"), ("lgpl", "lgpl 3 0"), ("bsd", "bsd 2 clause"), ("bsd-3", "bsd 3 clause"), ("isc", "isc"),
    ("mpl-2", "mpl 2 0"), ("boost-1", "bsl 1 0"), ("zlib", "zlib"), ("epl-2", "epl 2 0"), ("unlicense", "unlicense"),
    ("cc-by", "cc by 4 0"), ("cc-by-sa", "cc by sa 4 0"), ("cc-by-nc", "cc by nc 4 0"), ("cc0", "cc0 1 0"),
]
_SHORT = "spdx license identifier"
NOTICES += [(label, f"{_SHORT} {name}", [f"{_SHORT} {name}"]) for label, name in IDENTIFIERS]

#: Words too common to tell notices apart; they are never looked up.
COMMON = (
    "a above all and any anyone appear are as at available be by can charge copies copy either event except file for"
    " free from general have held in included into is it its later made materials may modify name names no nor not"
    " notice obtain of option or organization person prior products program promote provided public purpose shall source"
    " specific subject terms that the this to under use used v version will with without you 0 1 2 3 4"
).split()

#: So many of a notice's words, those of highest weight, are looked up in a document.
LOOKUPS = 4
#: So many of these must stand in line (all, where the document has fewer).
IN_LINE = 2


def _rare(notice: str) -> list[str]:
    return sorted({w for w in notice.split() if w not in COMMON})


def vocabulary() -> list[str]:
    return sorted({w for _, notice, _ in NOTICES for w in _rare(notice)})


def key_phrases() -> list[tuple[str, str]]:
    """Key phrases, each with a word of it that is looked for first."""
    return sorted({(p, max(_rare(p), key=len)) for _, _, phrases in NOTICES for p in phrases})


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _places(words: Column, spaced: Column, phrase: str) -> Column:
    parts = phrase.split()
    starts = F.sequence(F.lit(0), F.size(words) - len(parts))
    hit = lambda i: F.slice(words, i + 1, len(parts)) == _strings(parts)
    empty = F.array().cast("array<int>")
    return F.when(F.contains(spaced, F.lit(f" {phrase} ")), F.filter(starts, hit)).otherwise(empty)


def digest(documents: DataFrame) -> DataFrame:
    """Per document: counts, places of base phrases, notice words with their places, key phrases."""
    text = lower_ascii(F.coalesce("text", F.lit("")))
    split = documents.select(
        "doc_id", F.regexp_extract_all(text, F.lit(LICENCE_WORD), F.lit(0)).alias("words")
    ).select(
        "doc_id",
        "words",
        F.array_intersect("words", _strings(vocabulary())).alias("rare"),
        F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")).alias("spaced"),
    )
    words, spaced, rare = F.col("words"), F.col("spaced"), F.col("rare")
    placed = F.filter(
        F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("at"))),
        lambda x: F.array_contains(rare, x["word"]),
    )
    asked = F.array(*[F.struct(F.lit(p).alias("phrase"), F.lit(w).alias("word")) for p, w in key_phrases()])
    here = F.filter(
        asked,
        lambda p: F.array_contains(rare, p["word"])
        & F.contains(spaced, F.concat(F.lit(" "), p["phrase"], F.lit(" "))),
    )
    split = split.withColumn("phrases", F.when(F.size("rare") > 0, here["phrase"]))
    found = {label: _places(words, spaced, phrase) for phrase, label in BASE.items()}
    every = F.flatten(F.array(*found.values()))
    labels = F.array(*[F.when(F.size(at) > 0, F.lit(label)) for label, at in found.items()])
    return split.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.size(words).cast("long").alias("n_words"),
        every.alias("base_at"),
        F.array_compact(labels).alias("base"),
        "rare",
        # No notice is confirmed without a key phrase.
        F.when(F.size("phrases") > 0, placed).alias("placed"),
        "phrases",
    )


def _postings(spark) -> DataFrame:
    rows = [
        (n, label, word, at, phrases)
        for n, (label, notice, phrases) in enumerate(NOTICES)
        for at, word in enumerate(notice.split())
        if word in _rare(notice)
    ]
    return spark.createDataFrame(rows, "notice int, label string, word string, place int, mandatory array<string>")


def matches(rows: DataFrame) -> DataFrame:
    """Notices found in each digested row, with the share of looked-up words that stand in line."""
    spark = rows.sparkSession
    frequency = rows.select(F.explode("rare").alias("word")).groupBy("word").count()
    likely = rows.filter(F.size("phrases") > 0)
    looked_up = (
        likely.select("row", F.explode("rare").alias("word"))
        .join(F.broadcast(frequency), "word")
        .join(F.broadcast(_postings(spark).select("notice", "word").distinct()), "word")
        .groupBy("row", "notice")
        # The rarer a word, the higher its weight; equal ones by the word itself.
        .agg(F.slice(F.sort_array(F.collect_list(F.struct("count", "word"))), 1, LOOKUPS)["word"].alias("top"))
    )
    places = (
        likely.select("row", "phrases", F.explode("placed").alias("x"))
        .select("row", "phrases", "x.word", "x.at")
        .join(F.broadcast(_postings(spark)), "word")
        .filter(F.size(F.array_except("mandatory", "phrases")) == 0)
        .groupBy("row", "notice", "label", (F.col("at") - F.col("place")).alias("shift"))
        .agg(F.collect_set("word").alias("aligned"))
    )
    in_line = F.size(F.array_intersect("aligned", "top"))
    return (
        places.join(looked_up, ["row", "notice"])
        .select("row", "label", in_line.alias("hits"), F.size("top").alias("asked"))
        .filter(F.col("hits") >= F.least(F.lit(IN_LINE), F.col("asked")))
        .groupBy("row")
        .agg(F.collect_set("label").alias("found"), F.max(F.col("hits") / F.col("asked")).alias("share"))
    )


def license_scan(documents: DataFrame) -> DataFrame:
    """Labels and places of licence notices per document; the digest goes to the shared folder."""
    rows = materialize(digest(documents), "licence-digest")
    found = rows.join(matches(rows), "row", "left")
    every = F.array_union("base", F.coalesce("found", F.array().cast("array<string>")))
    base = F.when(F.size("base") > 0, 1.0).otherwise(0.0)
    return found.select(
        "doc_id",
        "n_words",
        F.size("base_at").cast("long").alias("n_base"),
        F.array_min("base_at").cast("long").alias("first_word"),
        F.array_max("base_at").cast("long").alias("last_word"),
        F.array_join(F.sort_array("base"), ",").alias("base_labels"),
        F.array_join(F.sort_array(every), ",").alias("labels"),
        F.greatest(base, F.coalesce("share", F.lit(0.0))).alias("score"),
    )
