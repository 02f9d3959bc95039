"""Language identification: gradients, held-out accuracy, edge rows."""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import functions as F

from riskmart.llm import langid
from riskmart.llm.common import table

SF = "/root/testdata/sf0.01"


def test_gradients_by_differences():
    rng = np.random.default_rng(0)
    net = langid.Network.fresh(["a", "b", "c"], 4)
    x = rng.integers(0, 256, (9, 3)).astype(np.uint8)
    mask, labels = np.ones((9, 3), np.float32), np.array([0, 2, 1])
    mask[6:, 1] = 0
    _, grads = langid.gradients(net, x, mask, labels)
    for p, g in zip(net.parameters(), grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = p[at]
        p[at] = old + 0.01
        up, _ = langid.gradients(net, x, mask, labels)
        p[at] = old - 0.01
        down, _ = langid.gradients(net, x, mask, labels)
        p[at] = old
        assert abs((up - down) / 0.02 - g[at]) < 1e-3 + 0.02 * abs(g[at])


def test_pieces_do_not_depend_on_the_batch():
    net = langid.Network.fresh(["a", "b"], 4)
    texts = [b"", b"short", b"x" * 1000, bytes(range(256)) * 3]
    lengths = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    all_ = langid.pool(net, data, np.cumsum(lengths) - lengths, lengths)
    for i, t in enumerate(texts):
        one = langid.pool(net, np.frombuffer(t, np.uint8), np.array([0]), np.array([len(t)]))
        assert np.allclose(all_[i], one[0], atol=1e-6)
    assert np.allclose(all_.sum(axis=1), [0, 1, 1, 1], atol=1e-4)


def test_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    got = langid.identify(docs, "doc_id", "lang").filter(langid.held_out(F.col("doc_id"))).collect()
    assert len(got) > 200 and np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)


def test_edge_rows(monkeypatch, edge, edge_clashing, empty, ordered):
    monkeypatch.setattr(langid, "train", functools.partial(langid.train, steps=40))
    got = ordered(langid.identify(edge, "doc_id", "text"))
    assert len(got) == edge.count()
    for _, text, lang, score in got:
        und = text is None or not any(c.isalpha() for c in text)
        assert (lang == langid.UND and score == 0) if und else (lang in ("en", "de") and 0 < score <= 1)
    assert got == ordered(langid.identify(edge_clashing, "doc_id", "text"))
    assert langid.identify(empty, "doc_id").count() == 0
    unlabelled = langid.identify(edge.withColumn("lang", edge["n_chars"].cast("string")).filter("lang is null"), "doc_id")
    assert {r["lang_pred"] for r in unlabelled.collect()} == {langid.UND}
    kept = langid.keep_identified(edge_clashing)
    assert kept.columns == edge_clashing.columns
