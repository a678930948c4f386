import numpy as np
import pytest
from pyspark.sql import functions as F

from citylake.llm import toxic_net as T
from citylake.llm.toxicity import drop_toxic, fit_toxicity, toxicity_report
from tests.llm.helpers import docs, with_extra


def test_windows_cover_every_word():
    counts = np.array([0, 1, 63, 64, 65, 96, 97, 1000])
    text, first, size = T.windows(counts)
    base = np.cumsum(counts) - counts
    for i, n in enumerate(counts):
        spans = [(f - base[i], f - base[i] + s) for t, f, s in zip(text, first, size) if t == i]
        assert set().union(*(range(a, b) for a, b in spans)) == set(range(n)) and spans[-1][1] == n
        assert all(b - a == min(n, T.WINDOW) for a, b in spans)


def test_gradients_against_differences():
    texts = [b"one two three four", b"b", b"alpha beta gamma delta epsilon zeta"]
    net = T.Net(3)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    rng = np.random.default_rng(0)
    net.word_odds, net.gram_odds = rng.normal(size=T.WORDS), rng.normal(size=T.GRAMS)
    words = T.Words(texts)
    _, first, size = T.windows(words.counts)
    index, mask = T._index(words.ids, first, size, int(size.max()))
    y = np.array([1.0, 0.0, 1.0])

    def loss():
        x = net.inputs(words).astype(np.float64)
        return net.gradients(x, words, index, mask, y)
    base, g = loss()
    for k in net.p:
        flat, grad = net.p[k].reshape(-1), g[k].reshape(-1)
        for j in [*np.argsort(-np.abs(grad))[:3], 0]:
            old = flat[j]
            eps = 1e-2 if k in "EC" else 1e-3
            flat[j] = old + eps
            up = loss()[0]
            flat[j] = old - eps
            down = loss()[0]
            flat[j] = old
            assert abs((up - down) / (2 * eps) - grad[j]) < 2e-3 * max(1, abs(grad[j])) + 1e-3, (k, j)


def test_scores_do_not_depend_on_the_batch():
    net = T.Net(1)
    texts = [b"a few words", b"", b"word " * 500, "été à la plage".encode(), b"a few words"]
    together = net.probability(texts)
    assert np.allclose(together, [net.probability([t])[0] for t in texts], atol=1e-5)
    assert together[0] == together[4] and ((together > 0) & (together < 1)).all()


def test_text_without_spaces_has_many_windows():
    words = T.Words([("日本語のテキスト。" * 200).encode(), b"a short text"])
    assert words.counts.tolist() == [1600, 3] and (T.windows(words.counts)[0] == 0).sum() > 1


@pytest.fixture(scope="module")
def sf(spark):
    d = "/root/testdata/sf0.1"
    return spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")


def test_held_out_accuracy(spark, sf):
    d, labels = sf
    net = fit_toxicity(d, labels, steps=200)
    rows = toxicity_report(d.join(labels.select("doc_id"), "doc_id", "left_semi"), net).join(labels, "doc_id").where("held_out").collect()
    y, p = np.array([r.toxic for r in rows]), np.array([r.predicted for r in rows])
    assert (y == p).mean() > 0.95 and p[y == 0].mean() < 0.03 and p[y == 1].mean() > 0.7
    clean = "the of and to in that is with for on " * 30
    insult = clean + "you stupid worthless pathetic idiot loser trash moron scum " + clean
    rows = {r.doc_id: r for r in toxicity_report(with_extra(docs(spark, [clean, insult, None, "", insult])), net).collect()}
    assert [rows[i].predicted for i in range(5)] == [0, 1, 0, 0, 1] and rows[2].score == rows[3].score
    kept = drop_toxic(with_extra(docs(spark, [clean, insult, None])), net)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2]


def test_degenerate_tables(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    net = fit_toxicity(docs(spark, ["a b", "c"]), none)
    assert [r.predicted for r in toxicity_report(docs(spark, ["a b", None]), net).collect()] == [0, 0]
    assert toxicity_report(docs(spark, []), net).count() == 0
    ones = spark.createDataFrame([(i, 1, 1) for i in range(20)], "doc_id long, quality int, toxic int")
    assert fit_toxicity(docs(spark, ["x"] * 20), ones).scale == 0
