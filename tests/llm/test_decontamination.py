import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from roadpulse.llm import decontamination, hashing
from roadpulse.llm.common import table

SF = "/root/testdata/sf0.01"
ITEMS = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
TEXTS = pq.read_table(f"{SF}/documents.parquet").column("text").to_pylist()


def _least(item, text):
    row = [0] * (len(text) + 1)
    for c in item:
        new = [row[0] + 1]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_distance_against_dynamic_programming():
    rng = random.Random(1)
    for _ in range(300):
        item = "".join(rng.choice("abé") for _ in range(rng.randint(1, 12)))
        text = "".join(rng.choice("abéc") for _ in range(rng.randint(0, 25)))
        assert decontamination.distance(item, text) == _least(item, text)


def test_every_whole_passage_is_found_and_nothing_else(spark):
    rows = decontamination.leaks(table(spark, SF, "documents"), table(spark, SF, "benchmark")).collect()
    found = {(r["doc_id"], r["item_id"]) for r in rows}
    docs = dict(zip(pq.read_table(f"{SF}/documents.parquet").column("doc_id").to_pylist(), TEXTS))
    whole = {(d, i) for d, t in docs.items() for i, s in ITEMS if s.lower() in t.lower()}
    assert whole and whole <= found
    for r in rows:
        item = dict(ITEMS)[r["item_id"]]
        assert 100 * r["edits"] <= decontamination.EDITS * len(item)


def test_recall_of_edited_passages():
    rng = random.Random(2)
    index = decontamination.Index(ITEMS)
    clean = [t for t in TEXTS if 500 < len(t) < 3000 and not any(s in t for _, s in ITEMS)][:60]

    def edited(text, n):
        text = list(text)
        for _ in range(n):
            k, way = rng.randrange(len(text)), rng.random()
            if way < 0.34:
                text[k] = rng.choice("abcdefgh")
            elif way < 0.67:
                text.insert(k, rng.choice("abcdefgh"))
            else:
                del text[k]
        return "".join(text)

    for percent, least in ((5, 0.98), (10, 0.9)):
        planted, texts = [], []
        for _ in range(200):
            number, item = rng.choice(ITEMS)
            host = rng.choice(clean)
            at = rng.randrange(len(host))
            planted.append(number)
            texts.append(f"{host[:at]} {edited(item, len(item) * percent // 100)} {host[at:]}")
        found = index.matches(hashing.as_texts(pa.array(texts)))
        assert np.mean([n in {i for i, _ in f} for n, f in zip(planted, found)]) >= least
    assert not any(index.matches(hashing.as_texts(pa.array(clean))))


def test_sampled_steps_agree_as_often_as_assumed():
    """AGREE is no more than what two walks over texts at the allowed distance show."""
    rng = random.Random(3)
    index = decontamination.Index(ITEMS)
    turns = decontamination._turns(index.walk)
    agree = []
    for _, item in ITEMS:
        other = list(item)
        for _ in range(len(item) * decontamination.EDITS // 100):
            other[rng.randrange(len(other))] = "z"
        put = []
        for text in (item, "".join(other)):
            data, place, out = hashing.LOWER[np.frombuffer(text.encode(), np.uint8)], 0, []
            for step in range(2 * len(data)):
                byte = data[place] if place < len(data) else 0
                out.append(byte)
                place += turns[0, step, byte]
            put.append(out)
        n = min(map(len, put))
        agree.append(np.mean(np.array(put[0][:n]) == np.array(put[1][:n])))
    assert np.mean(agree) >= decontamination.AGREE


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 3000)
    assert len(list(decontamination.blocks(table(spark, SF, "benchmark")))) > 3
    df = spark.createDataFrame([(n, f"x {s} y") for n, s in ITEMS[:8]], "doc_id long, text string")
    rows = decontamination.leaks(df, table(spark, SF, "benchmark")).collect()
    assert {(n, n) for n, _ in ITEMS[:8]} <= {(r["doc_id"], r["item_id"]) for r in rows}


def test_short_items_against_dynamic_programming():
    """Every copy with up to the allowed edits is found, whatever the item's length, and nothing else."""
    rng = random.Random(4)
    alphabet = "abcdefghijklmnopqrst   é漢"
    lengths = [1, 2, 4, 9, 10, 15, 19, 20, 24, 28, 33, 40, 50, 60, 64, 65, 72, 80]
    words = ["".join(rng.choice(alphabet) for _ in range(n)) for n in lengths for _ in range(3)]
    items = [(n, w) for n, w in enumerate(words) if len(w.encode()) < decontamination.SHORT]
    texts, planted = ["", "a", "漢"], []
    for number, item in items * 4:
        text = list(item)
        for _ in range(len(item) * decontamination.EDITS // 100):
            k, way = rng.randrange(len(text)), rng.random()
            text[k : k + (way < 0.67)] = rng.choice(alphabet) * (way > 0.33)
        host = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        at = rng.randint(0, len(host))
        planted.append((len(texts), number))
        whole = host[:at] + "".join(text) + host[at:]
        texts.append("".join(c.upper() if c.isascii() else c for c in whole))
    found = decontamination.Index(items).matches(hashing.as_texts(pa.array(texts)))
    got = {(t, n): e for t, hits in enumerate(found) for n, e in hits}
    assert set(planted) <= got.keys() and sum(map(len, found)) == len(got)
    lower = [hashing.LOWER[np.frombuffer(t.encode(), np.uint8)].tobytes().decode() for t in texts]
    want = {(t, n): decontamination.distance(item, text) for t, text in enumerate(lower) for n, item in items}
    assert got == {k: e for k, e in want.items() if 100 * e <= decontamination.EDITS * len(dict(items)[k[1]])}


def test_places_of_short_items_in_parts(monkeypatch):
    texts = hashing.as_texts(pa.array(["abc abc abcdefghijkl", "abcdefghijxl and abcdefghijk"]))
    items = [(1, "abc"), (2, "abcdefghijkl"), (None, "zzz"), (4, "")]
    whole = decontamination.Index(items).matches(texts)
    monkeypatch.setattr(decontamination, "PLACES", 1)
    assert decontamination.Index(items).matches(texts) == whole == [[(1, 0), (2, 0)], [(1, 0), (2, 1)]]
