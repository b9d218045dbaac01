import re

import numpy as np
from explain import plan_of
from pyspark.sql import functions as F

from wortfund.llm import langid, toxicity
from wortfund.llm.queries import QUERIES


def test_held_out_language(spark, sf):
    got = {r.doc_id: r for r in QUERIES["op8_language_id"](spark, "/root/testdata/sf0.01").collect()}
    lang = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [r for r in got.values() if r.held_out]
    assert len(held) > 200 and all(0 <= r.score <= 1 for r in got.values())
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97


def test_mixture(spark, documents):
    model = langid.fit(documents)
    assert model[0] == ["de", "en", "es", "fr"]
    text = {r.lang: r.text for r in documents.where("n_chars > 3000 and n_chars < 9000").collect()}
    both = (text["en"][:2000] + " " + text["fr"][:1000]).encode()
    share = dict(zip(model[0], langid.infer(model[1], both)))
    assert share["de"] == share["es"] == 0 and 0.5 < share["en"] < 0.85 and 0.15 < share["fr"] < 0.5
    assert np.count_nonzero(langid.infer(model[1], text["en"].encode())) == 1


def test_language_odd_and_empty(spark, documents, odd, empty):
    model = langid.fit(documents)
    rows = langid.predict(odd, model)
    assert rows.columns.count("lang_pred") == 1
    rows = rows.collect()
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) for r in rows)
    assert langid.predict(empty, model).count() == 0
    assert langid.fit(empty)[0] == []
    assert {r.lang_pred for r in langid.predict(odd, langid.fit(empty)).collect()} == {"und"}


def auc(y, s):
    order = np.argsort(s)
    rank = np.empty(len(s))
    rank[order] = np.arange(1, len(s) + 1)
    y = np.asarray(y)
    return (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (1 - y).sum())


def test_held_out_toxicity(spark):
    sf = "/root/testdata/sf0.1"
    score = {r.doc_id: r for r in QUERIES["op9_toxicity"](spark, sf).where("held_out").collect()}
    labels = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.doc_id in score]
    y, s = [r.toxic for r in labels], np.array([score[r.doc_id].score for r in labels])
    # labels hold noise: some ordinary texts are called toxic
    assert len(y) > 500 and auc(y, s) > 0.88
    clean = s[np.array(y) == 0]
    assert (clean < 0.5).mean() > 0.97


def test_misspellings_share_their_vectors():
    rng = np.random.default_rng(1)
    words = [f"neutral{i}" for i in range(200)]
    plain = [" ".join(rng.choice(words, 40)) for _ in range(120)]
    toxic = [p + " horrible " + " ".join(rng.choice(words, 20)) for p in plain[:60]]
    model = toxicity.train(plain + toxic, [0] * 120 + [1] * 60)
    word = lambda w: model[0][toxicity.bag(w)].mean()
    assert word("horrible") > word("horrrible") > max(0, np.max([word(w) for w in words]))


def test_toxicity_odd_and_empty(spark, odd, empty):
    labels = spark.createDataFrame([(1, 0), (3, 1), (5, 0), (5, 1), (6, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    model = toxicity.fit(odd, labels)
    rows = toxicity.predict(odd, model)
    assert rows.columns.count("toxicity") == 1
    rows = rows.collect()
    assert len(rows) == 10 and all(0 <= r.toxicity <= 1 for r in rows)
    assert toxicity.fit(empty, labels) is None
    assert {r.toxicity for r in toxicity.predict(odd, None).collect()} == {0.0}
    assert toxicity.predict(empty, model).count() == 0


def test_sample_is_bounded(documents, spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    texts, y = toxicity.sample(documents, labels, per_class=3)
    assert 0 < len(texts) <= 6 and sorted(set(y)) == [0, 1]
    assert documents.where(F.col("text").isin(texts)).count() >= len(set(texts))


def test_many_languages(spark):
    """600 languages of made-up words; each text goes to its own."""
    rng = np.random.default_rng(5)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    words = [["".join(rng.choice(letters, 6)) for _ in range(6)] for _ in range(600)]
    rows = [(f"l{i:03d}", " ".join(rng.choice(words[i], 30))) for i in range(600)]
    model = langid.fit(spark.createDataFrame(rows, "lang string, text string"))
    assert len(model[0]) == 600
    for i in range(0, 600, 60):
        assert model[0][int(langid.infer(model[1], rows[i][1].encode()).argmax())] == rows[i][0]


def test_proportions_against_a_plain_loop(spark, documents):
    """Expectation-maximisation over the trigrams one by one."""
    model = langid.fit(documents)
    for row in documents.where("n_chars between 200 and 2000").limit(5).collect():
        bucket, count = np.unique(langid.trigrams(row.text.encode()), return_counts=True)
        like = np.exp(model[1][:, bucket].T.astype(float) - model[1][:, bucket].max(axis=0)[:, None])
        share = [1 / 4] * 4
        for _ in range(langid.ROUNDS):
            new = [0.0] * 4
            for p, c in zip(like, count):
                total = sum(a * b for a, b in zip(p, share))
                for k in range(4):
                    new[k] += c * p[k] * share[k] / total
            share = [x / count.sum() for x in new]
        assert np.allclose(langid._proportions(like, count)[0], share)


def test_sample_moves_no_texts(spark, documents, monkeypatch):
    plans = []
    limit = type(documents).limit
    monkeypatch.setattr(type(documents), "limit", lambda self, n: plans.append(plan_of(self)) or limit(self, n))
    labels = documents.select("doc_id", (F.col("doc_id") % 2).alias("toxic"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        toxicity.sample(documents, labels, per_class=3)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(plans) == 2
    for plan in plans:
        moved = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: (.*)", plan)
        assert len(moved) >= 2
        # the text itself has a plain number; size and key of it are a struct
        texts = re.findall(r"Output \[\d+\]: \[doc_id#\d+L?, (text#\d+)", plan)
        assert texts and not any(re.search(texts[0] + r"\b", columns) for columns in moved)


def test_sample_passes_over_what_does_not_fit(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 2_000)
    monkeypatch.setattr(toxicity, "LONGEST_TEXT", 1_000)
    texts = {i: f"text number {i}" for i in range(40)} | {3: "x" * 5_000, 4: "y" * 999, 5: "z" * 998, 6: "u" * 997}
    docs = spark.createDataFrame([*texts.items(), *[(7, texts[7])] * 500, (8, "another text of one id"), (9, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(45)] + [(1, None), (None, 1)], "doc_id long, toxic int")
    got, y = toxicity.sample(docs, labels)
    assert sum(len(t) for t in got) <= 2_000 and texts[3] not in got
    # one row of each id, its shortest text; every short text fits, and one or two of the long ones
    short = {t for i, t in texts.items() if i not in (3, 4, 5, 6)}
    assert len(got) == len(set(got)) and short <= set(got) and 1 <= len(set(got) - short) <= 2
    known = {t: int(i % 4 == 0) for i, t in texts.items()}
    assert [known[t] for t in got] == y
    got, y = toxicity.sample(docs, labels, per_class=3)
    assert sorted(y) == [0, 0, 0, 1, 1, 1]
    assert toxicity.sample(docs.limit(0), labels) == ([], []) == toxicity.sample(docs, labels.limit(0))


def test_scores_against_a_plain_loop(spark, documents):
    """The most toxic stretch, word by word."""
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = toxicity.fit(documents, labels)
    for row in toxicity.predict(documents.where("n_chars < 1500").limit(40), model).collect():
        value = [np.mean([model[0][g] for g in toxicity.bag(w)]) for w in toxicity.tokens(row.text)]
        width = min(toxicity.STRETCH, len(value))
        best = max((np.mean(value[i : i + width]) for i in range(len(value) - width + 1)), default=0.0) if value else 0.0
        assert np.isclose(row.toxicity, 1 / (1 + np.exp(-(best + model[1]))), atol=1e-6)
