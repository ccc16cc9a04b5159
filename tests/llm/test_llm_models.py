"""Learned operators: held-out accuracy, and the defined result of every odd input."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from gridwright.llm import byte_cnn, mil_quality, toxicity_chain

SF = "/root/testdata/sf0.01"
ODD = [(10**9, None), (10**9 + 1, ""), (10**9 + 2, "123 !! ..."), (10**9 + 3, "word " * 30_000), (None, "The the of and is."),
       (10**9 + 4, "😀"), (10**9 + 5, "\x00\x01")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


def auc(good, bad):
    return float(np.mean(np.array(good)[:, None] > np.array(bad)[None]))


def with_odd_rows(docs):
    odd = docs.sparkSession.createDataFrame([(i, t, None, None, 0) for i, t in ODD], docs.schema)
    return docs.unionByName(odd).unionByName(docs.limit(3))


def test_language_on_held_out_documents(docs):
    truth = {r.doc_id: (r.lang, r.text) for r in docs.select("doc_id", "lang", "text").collect()}
    rows = byte_cnn.identify_languages(docs).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id][0] for r in held]) > 0.97


def test_language_ignores_held_out_labels(docs):
    from pyspark.sql import functions as F

    wrong = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit("xx"))
                            .otherwise(F.col("lang")))
    one = {r.doc_id: (r.lang_pred, r.score) for r in byte_cnn.identify_languages(docs).collect()}
    two = {r.doc_id: (r.lang_pred, r.score) for r in byte_cnn.identify_languages(wrong).collect()}
    assert one == two


def test_language_of_odd_rows(docs):
    net = byte_cnn.fit(docs)
    mixed = with_odd_rows(docs)
    rows = byte_cnn.identify_languages(mixed, net).collect()
    got = {r.doc_id: (r.lang_pred, r.score) for r in rows}
    assert len(rows) == docs.count() + len(ODD) + 3
    for k in (0, 1, 2, 5, 6):
        assert got[ODD[k][0]] == ("und", 0.0)
    assert got[None][0] == "en"
    assert byte_cnn.identify_languages(docs.limit(0)).count() == 0
    kept = byte_cnn.in_known_language(mixed, net=net)
    assert kept.columns == docs.columns and not {r.doc_id for r in kept.collect()} & {ODD[k][0] for k in (0, 1, 2)}


def test_letters_are_those_of_unicode(docs):
    net = byte_cnn.fit(docs)
    texts = ["²", "½ ½", "\u0301", "_9", "Ⅷ", "ª", "中", "a"]
    rows = byte_cnn.predict(net, texts)[0]
    assert [v == "und" for v in rows] == [True, True, True, True, True, False, False, False]
    df = docs.sparkSession.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    by_pattern = {r.doc_id for r in df.where(df.text.rlike(r"\p{L}")).collect()}
    assert by_pattern == {k for k, v in enumerate(rows) if v != "und"}


def test_batched_prediction_equals_one_window_at_a_time(docs):
    """The batched score against a plain forward pass, window by window and filter by filter."""
    net = byte_cnn.fit(docs)
    texts = [r.text for r in docs.orderBy("doc_id").limit(12).collect()] + ["x" * 700 + "é", "a"]
    langs, scores = byte_cnn.predict(net, texts)
    for text, lang, score in zip(texts, langs, scores, strict=True):
        data, total, seen = text.encode(), np.zeros(len(net.classes)), 0
        for at in range(0, len(data), byte_cnn.WINDOW):
            piece = data[at : at + byte_cnn.WINDOW]
            window = piece + bytes(byte_cnn.WINDOW - len(piece))
            taps = len(net.kernel) // byte_cnn.EMBEDDING
            best = np.full(net.kernel.shape[1], -np.inf)
            for k in range(byte_cnn.WINDOW - taps + 1):
                patch = np.concatenate([net.embed[b] for b in window[k : k + taps]])
                best = np.maximum(best, patch @ net.kernel)
            total += len(piece) * (np.maximum(best + net.shift, 0) @ net.dense + net.bias)
            seen += len(piece)
        z = np.exp(total / seen - (total / seen).max())
        assert net.classes[int(z.argmax())] == lang and abs(z.max() / z.sum() - score) < 1e-4


def test_equal_shares():
    assert byte_cnn.equal_share([5, 100, 200], 65) == 30 and byte_cnn.equal_share([5, 6], 65) == 6
    assert byte_cnn.equal_share([], 9) == 0


def test_a_rare_language_is_learned(spark, docs):
    """Drawn by language: 40 documents of one language among 4000 are all used."""
    from pyspark.sql import functions as F

    rare = spark.createDataFrame([(10**6 + k, "zażółć gęślą jaźń kot pies " * (3 + k % 5), "pl", "s", 1) for k in range(40)],
                                 "doc_id bigint, text string, lang string, source string, n_tokens int")
    both = docs.select("doc_id", "text", "lang").unionByName(rare.select("doc_id", "text", "lang"))
    net = byte_cnn.fit(both, sample_docs=400)
    assert "pl" in net.classes and byte_cnn.predict(net, ["gęślą jaźń zażółć pies kot pies"])[0] == ["pl"]
    one = byte_cnn.fit(docs.where("lang = 'en'"))
    assert one.classes == ["en"] and byte_cnn.predict(one, ["hello"])[0] == ["en"]
    clash = docs.withColumns({"score": F.lit(1), "lang_pred": F.lit("x"), "__docs": F.lit(0), "held_out": F.lit(1)})
    assert byte_cnn.identify_languages(clash, net).columns == ["doc_id", "held_out", "lang_pred", "score"]


def test_the_language_stage_keeps_what_it_knows(spark, docs):
    more = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    net = byte_cnn.fit(more, spare_trials=True)
    bound = byte_cnn.least_known_score(more, net)
    assert 0.3 < bound < 0.95
    kept = byte_cnn.in_known_language(more, net=net).count()
    assert kept >= 0.998 * more.where(more.text.rlike(r"\p{L}")).count()
    # Too few trials to tell a bound: chance.
    assert byte_cnn.least_known_score(docs, net) == 1 / len(net.classes)


def test_the_language_bound_is_told_from_all_trials(spark):
    """More trial documents than once were drawn (4000): each of them counts."""
    rng = np.random.default_rng(3)
    net = byte_cnn.ByteNet(["aa", "bb"], *[rng.normal(0, 0.5, shape).astype(np.float32) for shape in (
        (256, byte_cnn.EMBEDDING), (4 * byte_cnn.EMBEDDING, 6), (6,), (6, 2), (2,))])
    trials = [k for k in range(200_000) if fold(k, byte_cnn.FOLDS) != byte_cnn.HELD_OUT
              and fold(k, byte_cnn.TRIALS) == byte_cnn.TRIAL]
    assert len(trials) > 8000
    texts = {k: f"text {k * 7919 % 100_003} of {k % 97}" for k in trials}
    docs = spark.createDataFrame([(k, t, "ab"[k % 2] * 2) for k, t in texts.items()], "doc_id bigint, text string, lang string")
    langs, scores = byte_cnn.predict(net, list(texts.values()))
    told = [s for s, v, k in zip(scores, langs, trials, strict=True) if v == "ab"[k % 2] * 2]
    want = (0.5 + np.quantile(told, byte_cnn.TRIAL_TAIL)) / 2
    assert len(told) > 4000 and abs(byte_cnn.least_known_score(docs, net) - want) < 1e-9


def test_quality_on_held_out_documents(docs, labels):
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = mil_quality.score_quality(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    good, bad = [r.score for r in held if truth[r.doc_id] == 1], [r.score for r in held if truth[r.doc_id] == 0]
    assert auc(good, bad) > 0.97 and np.mean(np.array(good) >= 0.3) > 0.98


def test_quality_of_odd_rows(spark, docs, labels):
    model = mil_quality.fit(docs, labels)
    rows = mil_quality.score_quality(with_odd_rows(docs), labels, model).collect()
    assert len(rows) == docs.count() + len(ODD) + 3 and all(0 <= r.score <= 1 for r in rows)
    none = mil_quality.score_quality(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert mil_quality.score_quality(docs.limit(0), labels).count() == 0
    assert mil_quality.of_quality(docs, labels.limit(0)).count() == docs.count()


def test_attention_gradients():
    rng = np.random.default_rng(0)
    m = mil_quality.train([rng.random((4, mil_quality.FEATURES), np.float32) for _ in range(6)],
                          np.array([0, 1, 0, 1, 1, 0], np.float32), epochs=1)
    for f in ("encode", "tanh_gate", "sigmoid_gate", "attend", "weigh", "bias", "encode_bias"):
        setattr(m, f, getattr(m, f).astype(np.float64))
    x, starts, y = rng.normal(0, 1, (7, mil_quality.FEATURES)), np.array([0, 3]), np.array([1.0, 0.0])

    def loss():
        p = m.forward(x, starts)["p"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    grads = mil_quality._gradients(m, x, starts, y)
    for name in ("encode", "tanh_gate", "sigmoid_gate", "attend", "weigh", "bias"):
        w = getattr(m, name)
        at = np.unravel_index(np.abs(grads[name]).argmax(), w.shape)
        keep, e = w[at], 1e-5
        w[at] = keep + e
        up = loss()
        w[at] = keep - e
        down = loss()
        w[at] = keep
        assert abs((up - down) / (2 * e) - grads[name][at]) < 1e-6


def test_toxicity_on_documents_it_did_not_see(spark):
    from pyspark.sql import functions as F

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    seen = labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 0)
    rest = {r.doc_id: r.toxic for r in labels.collect() if fold(r.doc_id, 4) == 0}
    rows = toxicity_chain.score_toxicity(docs, seen).collect()
    assert len(rows) == docs.count() and all(0 <= r.toxic_junk <= 1 and 0 <= r.toxic_prose <= 1 for r in rows)
    toxic = [r.is_toxic for r in rows if rest.get(r.doc_id) == 1]
    clean = [r.is_toxic for r in rows if rest.get(r.doc_id) == 0]
    # Some labels of this table have no trace in the text.
    assert np.mean(toxic) > 0.85 and np.mean(clean) < 0.02


def test_later_models_see_out_of_fold_probabilities():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 400)
    rows = [np.array([int(v)]) if rng.random() < 0.9 else np.array([1 - int(v)]) for v in y]
    chain = toxicity_chain.train_chain(("a", "b"), ["f0", "f1"], rows, np.stack([y, y], 1), np.arange(400) % 4)
    assert len(chain.weights[0]) == 3 and len(chain.weights[1]) == 4 and chain.weights[1][2] > 0


def test_the_verdict_comes_through_the_chain(spark):
    """`toxic` is the last link: without the earlier ones verdicts change."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    chain = toxicity_chain.fit(docs, labels)
    assert chain.categories[-1] == "toxic" and len(chain.weights) == 3
    texts = [r.text for r in docs.select("text").collect()]
    whole = chain.probabilities(texts)[:, -1]
    w = chain.weights[-1].copy()
    assert (w[len(chain.features) : -1] != 0).all()
    w[len(chain.features) : -1] = 0
    cut = toxicity_chain.Chain(chain.categories, chain.features, [*chain.weights[:-1], w])
    alone = cut.probabilities(texts)[:, -1]
    assert ((whole >= toxicity_chain.ACCEPT) != (alone >= toxicity_chain.ACCEPT)).any()


def test_chain_equals_a_plain_forward_pass(docs, labels):
    chain = toxicity_chain.fit(docs, labels)
    texts = [r.text for r in docs.orderBy("doc_id").limit(200).collect()] + [None, "", "vile " * 5]
    got = chain.probabilities(texts)
    n = len(chain.features)
    for text, row in zip(texts, got, strict=True):
        words = set(toxicity_chain.WORD.findall((text or "").lower()))
        present = {f for w in words for f in toxicity_chain.features_of(w)} & chain.features.keys()
        before = []
        for w in chain.weights:
            z = sum(w[chain.features[f]] for f in present) + sum(a * b for a, b in zip(w[n:-1], before, strict=True)) + w[-1]
            before.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        assert np.allclose(before, row)


def test_counted_features_are_those_scored(spark):
    """Spark's counts against ``features_of``, word by word."""
    texts = ["Wretched wretches, ab ABCD abcde abcdefgh.", "élan vitality vital x", "", "9 _ !"]
    rows = [(k, k % 2, 1, 0, 1, t) for k, t in enumerate(texts)]
    sample = spark.createDataFrame(rows, "key bigint, fold int, toxic_prose int, toxic_junk int, toxic int, text string")
    got = {}
    for r in toxicity_chain.feature_counts(sample).collect():
        got[r.f, r.fold] = r.n
    expected = {}
    for k, text in enumerate(texts):
        for f in {f for w in toxicity_chain.WORD.findall(text.lower()) for f in toxicity_chain.features_of(w)}:
            expected[f, k % 2] = expected.get((f, k % 2), 0) + 1
    assert got == expected and ("wretc*", 0) in got


def test_each_link_learns_from_its_own_labels(spark, docs, labels):
    """A document without one label still teaches what the other decides."""
    rows = [(1, 1, None), (2, 0, None), (3, None, 1), (4, None, 0), (5, None, None), (6, 1, 1), (6, None, 0), (None, 1, 1)]
    odd = spark.createDataFrame(rows, "doc_id bigint, toxic int, quality int")
    texts = spark.createDataFrame([(k, f"text {k}", 1) for k in range(1, 8)], "doc_id bigint, text string, fold int")
    found = {r.text: (r.toxic_prose, r.toxic_junk, r.toxic)
             for r in toxicity_chain.training_sample(texts, odd, 100).collect()}
    assert found == {"text 1": (None, None, 1), "text 2": (0, 0, 0), "text 3": (None, 0, None),
                     "text 4": (0, None, None), "text 6": (1, 0, 1)}
    no_quality = labels.withColumn("quality", labels.quality.cast("int") * None)
    rows = toxicity_chain.score_toxicity(docs, no_quality.unionByName(no_quality)).collect()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert np.mean([r.is_toxic for r in rows if truth.get(r.doc_id) == 1]) > 0.7


def test_toxicity_of_odd_rows(docs, labels):
    rows = toxicity_chain.score_toxicity(with_odd_rows(docs), labels).collect()
    assert len(rows) == docs.count() + len(ODD) + 3
    assert not any(r.is_toxic for r in rows if r.doc_id is None or r.doc_id >= 10**9)
    assert {r.toxic for r in toxicity_chain.score_toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity_chain.score_toxicity(docs.limit(0), labels).count() == 0
