"""Toxicity, quality and language: accuracy on held-out rows, and odd inputs."""

import numpy as np
import pytest

from tessera.llm import langid, quality, toxicity

SF001, SF01 = "/root/testdata/sf0.01", "/root/testdata/sf0.1"


def rates(rows, truth):
    hits = sum(r.predicted == 1 and truth[r.doc_id] == 1 for r in rows)
    return hits / max(1, sum(truth[r.doc_id] == 1 for r in rows)), hits / max(1, sum(r.predicted == 1 for r in rows))


def test_toxicity_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    model = toxicity.fit(docs, labels)
    assert len(model.feature) < 5_000  # L1 keeps the weights few
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    import zlib

    rows = [r for r in toxicity.score(docs, model).collect() if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    recall, precision = rates(rows, truth)
    assert recall > 0.8 and precision > 0.95


def test_quality_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF001}/documents.parquet"), spark.read.parquet(f"{SF001}/labels.parquet")
    model = quality.fit(docs, labels)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    import zlib

    rows = [r for r in quality.score(docs, model).collect() if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert np.mean([r.predicted == truth[r.doc_id] for r in rows]) > 0.95


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = langid.predict(docs, langid.fit(docs)).collect()
    assert len(rows) == len(truth)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in rows]) > 0.98


@pytest.fixture()
def odd_labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 0), (5, 0, 1), (6, 1, None), (None, 1, 1), (7, 7, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")


def test_odd_rows(odd, empty, odd_labels):
    n = odd.count()
    for module, label in ((toxicity, "toxic"), (quality, "quality")):
        model = module.fit(odd, odd_labels, label=label)
        rows = module.score(odd, model).collect()
        assert len(rows) == n and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
        blank = {round(r.score, 12) for r in rows if r.doc_id in (2, 3)}
        assert len(blank) == 1
        assert module.score(empty, model).count() == 0
    model = langid.fit(odd)
    rows = langid.predict(odd, model).collect()
    assert len(rows) == n
    assert {r.lang_pred for r in rows if r.doc_id in (2, 3, 4, 8)} == {"und"}
    assert all(r.score == 0 for r in rows if r.lang_pred == "und")


def test_without_labels_nothing_is_rejected(odd, odd_labels):
    none = odd_labels.limit(0)
    assert {r.predicted for r in toxicity.score(odd, toxicity.fit(odd, none)).collect()} == {0}
    assert {r.predicted for r in quality.score(odd, quality.fit(odd, none)).collect()} == {1}
    assert {r.lang_pred for r in langid.predict(odd, langid.fit(odd.limit(0))).collect()} == {"und"}


def test_long_texts_score_as_their_slabs_together(monkeypatch):
    """Working off a text in slabs changes no presence feature."""
    text = ("idiot words go on and on " * 4000).encode()
    whole = toxicity.distinct_features(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]
    grams = langid.distinct_grams(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]
    for module in (toxicity, langid):
        monkeypatch.setattr(module, "GROUP_BYTES", 5000)
    assert (toxicity.distinct_features(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0] == whole).all()
    assert (langid.distinct_grams(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0] == grams).all()


def test_attention_gradient():
    """The written-out gradient step lowers the loss of a separable toy problem."""
    rng = np.random.default_rng(1)
    bags = []
    for i in range(120):
        x = rng.random((rng.integers(1, 6), quality.WIDTH)).astype(np.float32) * 0.1
        if i % 2:
            x[rng.integers(len(x)), :5] += 1.0  # one telling passage
        bags.append((x, i % 2))
    model = quality.train(bags, epochs=30)
    good = 0
    for x, y in bags:
        h, logit = model.encoded(x)
        a = np.exp(logit - logit.max())
        z = (a / a.sum()) @ h
        good += int((z @ model.c[:-1] + model.c[-1] > 0) == bool(y))
    assert good > 110


def test_gradient_against_differences():
    """Every part of the model moved a little by itself."""
    rng = np.random.default_rng(2)
    bags = [(rng.random((n, quality.WIDTH)), i % 2) for i, n in enumerate((1, 3, 7))]
    shapes = {"w": (quality.WIDTH, quality.CODE), "v": (quality.CODE, quality.GATE), "u": (quality.CODE, quality.GATE), "a": (quality.GATE,), "c": (quality.CODE + 1,)}
    model = quality.Bag(**{k: rng.normal(0, 1 / np.sqrt(s[0]), s) for k, s in shapes.items()})
    _, grad = quality.gradient(model, bags)
    for name in quality.NAMES:
        part = getattr(model, name)
        for _ in range(12):
            at = tuple(rng.integers(0, n) for n in part.shape)
            kept, h = part[at], 1e-5
            losses = []
            for value in (kept + h, kept - h):
                part[at] = value
                losses.append(quality.gradient(model, bags)[0])
            part[at] = kept
            assert np.isclose((losses[0] - losses[1]) / (2 * h), grad[name][at], rtol=1e-4, atol=1e-8), (name, at)


def test_a_step_in_parts_is_the_whole_step(monkeypatch):
    rng = np.random.default_rng(3)
    bags = [(rng.random((rng.integers(1, 9), quality.WIDTH)).astype(np.float32), i % 2) for i in range(40)]
    assert [len(x) for x in quality.steps(bags, 5)] and sum(quality.steps(bags, 5), []) == bags
    assert all(len(run) == 1 or sum(len(b[0]) for b in run) <= 5 for run in quality.steps(bags, 5))
    whole = quality.train(bags, epochs=2)
    monkeypatch.setattr(quality.steps, "__defaults__", (5,))
    parts = quality.train(bags, epochs=2)
    assert all(np.allclose(getattr(whole, k), getattr(parts, k), atol=1e-4) for k in quality.NAMES)


def test_training_sees_single_passages_of_long_texts():
    """The bag of a text of 20,000 words holds each of its passages as they are scored."""
    text = " ".join(f"w{i % 977}" for i in range(20_000)).encode()
    body, offsets = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    bag = quality._bags(body, offsets)[0][0].values.to_numpy().reshape(-1, quality.WIDTH)
    assert len(bag) == -(-20_000 // quality.WORDS) and (bag == quality.passages(body, offsets)[1]).all()


def test_samples_end_at_their_bound(spark):
    docs = spark.createDataFrame([(i, f"some words {'bad' if i % 2 else 'good'} here {i} " * (i % 5 * 40 + 1)) for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2, i % 2) for i in range(200)], "doc_id long, quality int, toxic int")
    for most in (1, 60, 10**6):
        assert len(toxicity.score(docs, toxicity.fit(docs, labels, present=most)).collect()) == 200
        assert len(quality.score(docs, quality.fit(docs, labels, most=most)).collect()) == 200


def test_ftrl_coordinate_by_coordinate():
    """The array form against the update written for single coordinates, in plain Python."""
    rng = np.random.default_rng(4)
    rows = [(np.unique(rng.integers(0, 30, 8)), int(rng.random() < 0.4)) for _ in range(60)]
    alpha, beta, l1, l2, positive, bias = 0.7, 1.0, 0.5, 0.1, 2.0, -1
    z, n = {}, {}

    def weight(i):
        penalty = 0.0 if i == bias else l1
        own = z.get(i, 0.0)
        if abs(own) <= penalty:
            return 0.0
        return -(own - np.sign(own) * penalty) / ((beta + n.get(i, 0.0) ** 0.5) / alpha + l2)

    for _ in range(3):
        for present, label in rows:
            at = [*present.tolist(), bias]
            w = {i: weight(i) for i in at}
            g = (1 / (1 + np.exp(-sum(w.values()))) - label) * (positive if label else 1.0)
            for i in at:
                sigma = ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / alpha
                z[i] = z.get(i, 0.0) + g - sigma * w[i]
                n[i] = n.get(i, 0.0) + g * g
    got, own_bias = toxicity.ftrl(rows, 3, alpha, beta, l1, l2, positive)
    assert np.allclose([got[i] for i in range(30)], [weight(i) for i in range(30)])
    assert np.isclose(own_bias, weight(bias)) and not got[30:].any() and (got[:30] == 0).any() and got[:30].any()


def test_ridge_is_the_nystrom_solution():
    """The weights by n-gram against the formula over full kernel matrices."""
    rng = np.random.default_rng(5)
    rows = [(f"l{i % 3}", np.unique(rng.integers(i % 3 * 15, i % 3 * 15 + 60, 20))) for i in range(90)]
    model = langid.ridge(rows, landmarks=12, ridge=0.01)
    every = np.arange(200)
    full = np.array([np.isin(every, g) / np.sqrt(len(g)) for _, g in rows])
    base = [i for name in ("l0", "l1", "l2") for i in [k for k, r in enumerate(rows) if r[0] == name][:4]]
    seen = np.isin(every, model.gram)
    # n-grams of the landmarks alone count, and a text's norm is taken over these
    cut = np.array([np.isin(every, g) & seen for _, g in rows], float)
    cut /= np.sqrt(np.maximum(cut.sum(axis=1, keepdims=True), 1))
    assert np.allclose(cut[base], full[base])
    k_nm, k_mm = cut @ cut[base].T, cut[base] @ cut[base].T
    y = np.array([[1.0 if r[0] == name else -1.0 for name in ("l0", "l1", "l2")] for r in rows])
    alpha = np.linalg.solve(k_nm.T @ k_nm + 0.01 * len(rows) * k_mm + 1e-8 * np.eye(12), k_nm.T @ y)
    assert model.names == ("l0", "l1", "l2")
    assert np.allclose(cut[:, model.gram] @ model.weight, k_nm @ alpha, atol=1e-3)
