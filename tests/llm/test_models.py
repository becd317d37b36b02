"""Fitted operators: held-out accuracy, brute force and invariants."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from roadpulse.llm import automaton, hashing, language, language_model, pu_quality, toxicity
from roadpulse.llm.common import table

SF = "/root/testdata/sf0.01"
DOCUMENTS = pq.read_table(f"{SF}/documents.parquet").to_pylist()
LABELS = {r["doc_id"]: r for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}


def _fold(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


def test_quality_on_held_out_labels(spark):
    rows = pu_quality.pu_quality(table(spark, SF, "documents"), table(spark, SF, "labels")).collect()
    assert len(rows) == len(DOCUMENTS)
    assert all(r["held_out"] == (_fold(r["doc_id"], 5) == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = [(r["score"], LABELS[r["doc_id"]]["quality"]) for r in rows if r["held_out"] and r["doc_id"] in LABELS]
    good, bad = ([s for s, q in held if q == k] for k in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.95


def test_prior_of_a_known_mixture():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(0, 1, (4000, 5)), rng.normal(3, 1, (4000, 5))
    mixed = np.concatenate([good[2000:3400], bad[:600]])
    assert abs(pu_quality.estimate_prior(good[:2000], mixed) - 0.7) < 0.08
    net = pu_quality.fit(good[:2000], mixed, 0.7)
    assert (net.margin(good[3400:]) > 0).mean() > 0.95 and (net.margin(bad[600:]) < 0).mean() > 0.95


def test_toxicity_on_held_out_labels(spark):
    rows = toxicity.toxicity(table(spark, SF, "documents"), table(spark, SF, "labels")).collect()
    assert len(rows) == len(DOCUMENTS)
    assert all(r["held_out"] == (_fold(r["doc_id"], 3) == 1) for r in rows)
    lang = {d["doc_id"]: d["lang"] for d in DOCUMENTS}
    held = [r for r in rows if r["held_out"] and r["doc_id"] in LABELS]
    assert all(LABELS[r["doc_id"]]["toxic"] == 1 for r in held if r["predicted"])
    english = [r for r in held if lang[r["doc_id"]] == "en" and LABELS[r["doc_id"]]["toxic"]]
    assert np.mean([r["predicted"] for r in english]) > 0.85


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton_against_edit_distance():
    rng = np.random.default_rng(2)
    entries = [automaton.Entry("abcab", edits=1), automaton.Entry("bbaac", edits=2), automaton.Entry("cab", edits=0)]
    entries.append(automaton.Entry("aacc", stem=True))
    words = ["".join(rng.choice(list("abcd"), rng.integers(1, 9))) for _ in range(3000)] + ["aaccdddddddd"]
    texts = hashing.as_texts(pa.array([" ".join(words)]))
    found = hashing.words(texts)
    word, entry, edits = automaton.Automaton(entries).find(texts.data, found)
    got = {int(w): int(e) for w, e in zip(word, edits)}
    want = {}
    for k, w in enumerate(words):
        near = [_edits(e.term, w) for e in entries if not e.stem and _edits(e.term, w) <= e.edits]
        if near or w.startswith("aacc"):
            want[k] = 0 if w.startswith("aacc") else min(near)
    assert got.keys() == want.keys()
    assert all(got[k] <= want[k] or words[k].startswith("aacc") for k in got)
    assert len(entry) == len(word)


def test_quoted_terms_weigh_less_than_abuse():
    model = toxicity.Model(
        automaton.Automaton([automaton.Entry("idiot", edits=1)]), np.array([[2.5, 1.5]]), toxicity._PRIOR.copy()
    )
    texts = ["you idiot, go", "you idoit, idiott!", 'She said "what an idiot" and left', "nothing here", "", "er nannte ihn „idiot“ laut"]
    p, n = toxicity.score(hashing.as_texts(pa.array(texts)), model)
    assert p[0] > 0.7 and p[1] > 0.7 and p[2] < 0.5 and p[5] < 0.7
    assert p[3] == p[4] == toxicity.NOTHING and n.tolist() == [1, 1, 1, 0, 0, 1]


def test_language_on_held_out_documents(spark):
    rows = language.identify(table(spark, SF, "documents")).collect()
    lang = {d["doc_id"]: d["lang"] for d in DOCUMENTS}
    assert all(r["held_out"] == (_fold(r["doc_id"], 3) == 1) for r in rows)
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"]]) > 0.98


def test_forward_pass_sums_all_segmentations():
    pieces = language.Pieces()
    rng = np.random.default_rng(3)
    p = language._scaled(rng.random((pieces.size + 1, 2)) * (pieces.length > 0)[:, None], pieces)
    model = language.Model(pieces, ["a", "b"], p)
    word = language.SPACE + "heé".encode()
    plain = p / language._SCALE ** pieces.length[:, None]

    def number(part):
        key = language._keys(language._row_hash(np.frombuffer(part, np.uint8)[None, :]), len(part))
        return int(pieces.find(key)[0, 0])

    def total(rest):
        if not rest:
            return np.ones(2)
        found = np.zeros(2)
        for n in range(1, len(rest) + 1):
            k = number(rest[:n])
            if k < pieces.size:
                found += plain[k] * total(rest[n:])
        return found

    assert np.allclose(model.log_probabilities([word])[0], np.log(total(word)))


def _tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + ["<end>"]


@pytest.mark.parametrize("head", [50, 500_000])
def test_language_model_against_counting(spark, monkeypatch, head):
    """The same whether few or all words' counts are at hand."""
    monkeypatch.setattr(language_model, "HEAD", head)
    monkeypatch.setattr(language_model, "STEPS", 20)
    tiny = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: _tokens(r["text"]) for r in pq.read_table(f"{tiny}/documents.parquet").to_pylist()}
    counts = Counter(t for i, ts in texts.items() if _fold(i, 7) != 2 for t in ts)
    n, v = sum(counts.values()), len(counts)
    rows = language_model.lm_scores(table(spark, tiny, "documents")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        own = texts[r["doc_id"]]
        assert r["held_out"] == (_fold(r["doc_id"], 7) == 2)
        assert (r["n_tokens"], r["train_tokens"]) == (len(own), n)
        assert r["n_known"] == sum(counts[t] > 0 for t in own)
        assert math.isclose(r["base_score"], sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own), rel_tol=1e-9)
        assert r["score"] < 0


def test_language_model_is_normalised_and_learns():
    rng = np.random.default_rng(4)
    size = language_model.CLASSES
    pairs = np.zeros((size, size))
    pairs[3:13, 3:13] = rng.integers(1, 9, (10, 10))
    pairs[3, 4] = 2000
    model = language_model.train(pairs)
    table_ = model.log_probabilities(np.arange(size))
    assert np.allclose(np.exp(table_.astype(np.float64)).sum(1), 1, atol=1e-3)
    unigram = np.log(pairs.sum(0) / pairs.sum())[4]
    assert table_[3, 4] > unigram


def test_a_word_misspelt_in_its_stem_is_found(spark):
    """The family of words is frequent enough only together, so its beginning becomes the entry."""
    rng = np.random.default_rng(6)
    prose = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(400)]
    family = ["idiot", "idiots", "idiotic", "idiocy", "idiotically", "idioten"]
    docs, labels = [], []
    for n in range(600):
        words = [str(w) for w in rng.choice(prose, 20)]
        if n % 10 == 0:
            words.insert(int(rng.integers(1, 19)), family[n // 10 % len(family)])
        docs.append((n, " ".join(words)))
        labels.append((n, int(n % 10 == 0)))
    # Two letters that change places are two edits.
    said = ["abc idjot def", "abc odiotic def", "abc idiotisch def", "abc def", "abc idoit def"]
    docs += [(1000 + k, text) for k, text in enumerate(said)]
    tables = [spark.createDataFrame(docs, "doc_id long, text string")]
    tables.append(spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert any(e.stem and "idiot".startswith(e.term) for e in toxicity.train(*tables).automaton.entries)
    got = {r["doc_id"] - 1000: r for r in toxicity.toxicity(*tables).collect() if r["doc_id"] >= 1000}
    assert [got[k]["n_found"] for k in range(5)] == [1, 1, 1, 0, 0]
    assert [got[k]["predicted"] for k in range(5)] == [1, 1, 1, 0, 0]


def test_an_id_on_many_rows_is_learned_from_once(spark, monkeypatch):
    rows = [(n, f"some text number {n} of {n % 5}") for n in range(60)]
    labels = spark.createDataFrame([(n, 1, 0) for n in range(0, 60, 3)], "doc_id long, quality int, toxic int")
    taken = []
    monkeypatch.setattr(pu_quality, "fit", lambda p, u, prior: taken.append((len(p), len(u))))
    monkeypatch.setattr(pu_quality, "estimate_prior", lambda p, u: 0.5)
    for more in ([], [(n, f"other {k} {n}") for n in (1, 2, 3, 4) for k in range(50)], rows * 3):
        pu_quality.train(spark.createDataFrame(rows + more, "doc_id long, text string"), labels)
    assert len(taken) == 3 and len(set(taken)) == 1


def test_a_bound_of_languages_is_told(spark, monkeypatch):
    monkeypatch.setattr(language, "LANGUAGES", 2)
    rows = [(n, f"l{n % 3}", f"some words of {n % 3} here") for n in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    with pytest.warns(UserWarning, match="3 languages"):
        language.train(docs)


def test_long_runs_are_scored_over_all_segmentations():
    """Against a plain sum in logarithms; from one byte below the border to runs of some hundred."""
    rng = np.random.default_rng(3)
    pieces = language.Pieces()
    words = [("▁" + "".join(rng.choice(list("abcdeést語"), n))).encode() for n in (9, 20, 30, 31, 32, 33, 34, 35, 36, 60, 200, 333)]
    p = rng.random((pieces.size + 1, 2)) * (pieces.length > 0)[:, None]
    p = p / p.sum(0) * language._SCALE ** pieces.length[:, None]
    p[-1] = 0
    model = language.Model(pieces, ["x", "y"], p)
    got = model.log_probabilities(words)
    assert any(len(w) <= language.LONGEST for w in words) and any(len(w) > 300 for w in words)
    for word, row in zip(words, got):
        lattice = pieces.lattice(np.frombuffer(word, np.uint8)[None])
        for lang in range(2):
            total = [0.0]
            for end in range(1, len(word) + 1):
                ways = [
                    total[end - size] + np.log(p[at, lang]) - size * np.log(language._SCALE)
                    for size in range(1, min(end, pieces.longest) + 1)
                    if p[at := lattice[size][0, end - size], lang] > 0
                ]
                total.append(float(np.logaddexp.reduce(ways)))
            assert abs(total[-1] - row[lang]) < 1e-6 * abs(total[-1])


def test_a_lexicon_in_blocks_finds_what_one_automaton_does():
    rng = np.random.default_rng(4)
    terms = sorted({"".join(rng.choice(list("abc"), rng.integers(3, 8))) for _ in range(60)})
    entries = [automaton.Entry(t, stem=n % 7 == 0, edits=int(n % 7 and len(t) > 4)) for n, t in enumerate(terms)]
    texts = hashing.as_texts(pa.array([" ".join("".join(rng.choice(list("abcd"), rng.integers(1, 9))) for _ in range(2000))]))
    found = hashing.words(texts)
    want = automaton.Automaton(entries).find(texts.data, found)
    for block in (1, 7, 100):
        got = automaton.Lexicon(entries, block).find(texts.data, found)
        assert all((a == b).all() for a, b in zip(got, want)) and len(want[0])


def test_evidence_by_how_often_a_term_occurs():
    """Of many rare terms some stand in toxic texts by chance; of few, hardly any."""
    many = {(3, False): 100_000, (3, True): 150, (10, False): 500, (10, True): 40}
    assert toxicity.needed(many, 100, 900) == 4
    assert toxicity.needed({(3, False): 200, (3, True): 30}, 100, 900) == 3
    assert toxicity.needed({(3, False): 10**6}, 100, 900) == float("inf")


def test_toxic_terms_of_rare_languages_and_one_pass(spark):
    """Held-out recall by language; the documents are read once to learn."""
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    marked = docs.join(labels, "doc_id").select("doc_id", "text", "lang", "toxic")
    rows = {r["doc_id"]: r for r in marked.select("doc_id", "lang", "toxic").collect()}
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    watched = docs.select("doc_id", "text").mapInArrow(counted, "doc_id long, text string")
    model = toxicity.train(watched, labels)
    assert read.value == docs.count()
    hits, n = Counter(), Counter()
    held = marked.filter("doc_id is not null").select("doc_id", "text").toPandas()
    held = held[[_fold(d, 3) == 1 for d in held["doc_id"]]]
    scores, _ = toxicity.score(hashing.as_texts(pa.array(held["text"].tolist(), pa.string())), model)
    for doc, value in zip(held["doc_id"], scores):
        kind = (rows[doc]["lang"], rows[doc]["toxic"])
        n[kind] += 1
        hits[kind] += value >= toxicity.LIMIT
    recall = {lang: hits[lang, 1] / n[lang, 1] for lang in ("en", "fr", "de", "es")}
    assert all(r >= 0.75 for r in recall.values()), recall
    assert sum(hits[k] for k in hits if not k[1]) <= 0.02 * sum(n[k] for k in n if not k[1])


def _risk(net, p, u, prior):
    """The two parts of the positive-unlabelled risk under the sigmoid loss, by their definition."""
    p, u = (1 / (1 + np.exp(-net.margin(x))) for x in (p, u))
    return prior * (1 - p).mean(), u.mean() - prior * p.mean()


@pytest.mark.parametrize("below", [False, True])
def test_a_step_follows_the_non_negative_risk(monkeypatch, below):
    """The first step of `fit` moves each number against its slope by finite differences: of the whole risk, or, where its
    second part is below zero, of that part turned round."""
    monkeypatch.setattr(pu_quality, "EPOCHS", 1)
    monkeypatch.setattr(pu_quality, "LEAST_STEPS", 1)
    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (120, 4))
    start = pu_quality._network(x, 3)
    order = np.argsort(start.margin(x))
    p, u = (x[order[60:]], x[order[:60]]) if below else (x[order[:60]], x[order[60:]])
    prior = 0.9
    start = pu_quality._network(np.concatenate([p, u]), 3)
    assert (_risk(start, p, u, prior)[1] < 0) == below
    after = pu_quality.fit(p, u, prior)

    def wanted():
        first, second = _risk(start, p, u, prior)
        return -second if below else first + second

    checked = 0
    for value, moved in zip(start.values(), after.values()):
        for at in np.ndindex(value.shape):
            held = value[at]
            value[at] = held + 1e-5
            up = wanted()
            value[at] = held - 1e-5
            down = wanted()
            value[at] = held
            slope = (up - down) / 2e-5 + 1e-4 * held
            if abs(slope) > 1e-6:
                assert np.isclose(moved[at] - held, -0.005 * np.sign(slope), rtol=0.05)
                checked += 1
    assert checked > 60


def test_prior_by_a_plain_recount(monkeypatch):
    """Smallest ratio of the shares above a cut, with each half scored by the other half's model."""
    rng = np.random.default_rng(7)
    p, u = rng.normal(1, 1, (80, 3)), rng.normal(0, 1.2, (140, 3))
    models = []
    fit = pu_quality.fit
    monkeypatch.setattr(pu_quality, "fit", lambda *a: models.append(fit(*a)) or models[-1])
    got = pu_quality.estimate_prior(p, u)
    sums = np.zeros(26)
    for k, net in enumerate(models):
        scores_p, scores_u = net.margin(p[k::2]).tolist(), net.margin(u[k::2]).tolist()
        for n, share in enumerate(np.linspace(0.5, 1, 26)):
            cut = np.quantile(scores_p, 1 - share)
            in_p, in_u = (sum(s >= cut for s in scores) / len(scores) for scores in (scores_p, scores_u))
            error = math.sqrt(in_p * (1 - in_p) / len(scores_p) + in_u * (1 - in_u) / len(scores_u)) / in_p
            sums[n] += in_u / in_p + pu_quality.MARGIN * error
    assert len(models) == 2 and abs(got - min(max(min(sums / 2), 0.05), 0.98)) < 1e-9
