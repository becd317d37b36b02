"""The two multinomials against counting."""

import math
import re
import zlib
from collections import Counter

from roadpulse.llm import quality_rules


def test_every_trusted_document_is_counted(spark):
    bins = quality_rules.BINS
    texts = {n: f"w{n} common w{n % 7}\nx{n * n}" for n in range(300)}
    good = {n for n in texts if n % 3}
    docs = spark.createDataFrame([*texts.items(), (None, "w1 w2")], "doc_id long, text string")
    labels = spark.createDataFrame([(n, int(n in good)) for n in texts], "doc_id long, quality int")
    raw, trusted = Counter(), Counter()
    for n, text in [*texts.items(), (None, "w1 w2")]:
        ids = [zlib.crc32(w.encode()) for w in re.findall(quality_rules.WORD, text)]
        grams = [i % bins for i in ids] + [(a * 31 + b) % bins for a, b in zip(ids, ids[1:])]
        raw.update(grams)
        trusted.update(grams if n in good else ())
    all_raw, all_trusted = sum(raw.values()), sum(trusted.values())
    want = [
        1e6 * (math.log((trusted[b] + 1) / (all_trusted + bins)) - math.log((raw[b] + 1) / (all_raw + bins)))
        for b in range(bins)
    ]
    got = quality_rules.weights(docs, labels).first()["weights"]
    assert len(got) == bins and all(abs(a - b) <= 0.51 for a, b in zip(got, want))
