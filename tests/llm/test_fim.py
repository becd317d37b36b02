"""Boundary sets against plain positions, outputs against slices of the decoded text."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadpulse.llm import fim


def _plain_offsets(text: str) -> list[int]:
    return [0, *np.cumsum([len(c.encode()) for c in text]).tolist()]


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=300))
def test_select_gives_every_boundary(text):
    found = fim.Boundaries(np.frombuffer(text.encode(), np.uint8))
    assert [found.select(k) for k in range(len(found))] == _plain_offsets(text)


@pytest.mark.parametrize(
    "text, forms",
    [
        ("a" * 200_000, {fim.Runs}),
        ("é" * 100_000, {fim.Bitmap, fim.Sorted}),
        ("𝄞" * 30_000 + "a" * 70_000, {fim.Bitmap, fim.Runs}),
        ("語" * 60_000, {fim.Bitmap}),
        ("é" * 1_500, {fim.Sorted}),
        ("a" * (fim.SPAN - 1) + "é" + "b", {fim.Runs, fim.Sorted}),
        ("a" * fim.SPAN, {fim.Runs, fim.Sorted}),
        ("", {fim.Sorted}),
    ],
)
def test_containers_of_all_forms(text, forms):
    found = fim.Boundaries(np.frombuffer(text.encode(), np.uint8))
    assert {type(c) for c in found.containers} == forms
    want = _plain_offsets(text)
    assert len(found) == len(want)
    for k in {0, len(want) - 1, *random.Random(3).choices(range(len(want)), k=200)}:
        assert found.select(k) == want[k]


def test_each_form_is_the_smallest():
    rng = np.random.default_rng(5)
    for chance in (0.0001, 0.01, 0.05, 0.06, 0.07, 0.5, 0.95, 0.9999):
        member = rng.random(fim.SPAN) < chance
        runs = int(np.count_nonzero(np.diff(member.astype(int), prepend=0) == 1))
        sizes = {fim.Runs: 4 * runs + 2, fim.Sorted: 2 * int(member.sum()), fim.Bitmap: fim.BITMAP_BYTES}
        made = fim.container(member)
        assert sizes[type(made)] == min(sizes.values())
        assert [made.select(k) for k in range(int(member.sum()))] == np.flatnonzero(member).tolist()


def _by_hand(doc_id, text):
    import hashlib

    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    one, two, three, four = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or three % 100 >= 90:
        return n, "plain", None, None, text
    low, high = sorted((one % (n + 1), two % (n + 1)))
    head, middle, tail = text[:low], text[low:high], text[high:]
    if four % 100 < 20:
        return n, "spm", low, high - low, f"<S>{tail}<P>{head}<M>{middle}"
    return n, "psm", low, high - low, f"<P>{head}<S>{tail}<M>{middle}"


def test_rows_of_all_kinds_and_round_trip(spark):
    rng = random.Random(8)
    alphabet = "ab <>PSM\n#é語𝄞"
    rows = [(k, "".join(rng.choices(alphabet, k=rng.randint(0, 60)))) for k in range(400)]
    rows += [(400, None), (401, ""), (None, "no id"), (None, None), (5, rows[5][1]), (5, "other text, same id")]
    rows += [(402, "a <P> mark"), (403, "<" * 50 + "S>"), (404, "語x" * 120_000), (405, "long text " * 100_000), (-7, "négatif")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.withColumns({c: F.lit("x") for c in ("form", "output", "n", "part", "`odd name`".strip("`"))})
    made = fim.fill_in_middle(docs).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    want = sorted(((doc, *_by_hand(doc, text), text or "") for doc, text in rows), key=str)
    columns = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "back")
    assert sorted((tuple(r[c] for c in columns) for r in made), key=str) == want
    assert {r["form"] for r in made} == {"plain", "psm", "spm"}


def test_shares_and_empty_table(spark):
    ids = range(4000)
    forms = [fim.transform(b"some text", k)[1] for k in ids]
    assert 0.07 < forms.count("plain") / 4000 < 0.13 and 0.15 < forms.count("spm") / 4000 < 0.21
    assert fim.transform(b"some text", 1, plain=100)[1] == "plain"
    assert {fim.transform(b"some text", k, plain=0, spm=100)[1] for k in ids} == {"spm"}
    assert fim.fim_digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0
