"""Language identification by a bidirectional gated recurrent network over bytes.

The network labels every byte of a text with a language; the label probabilities are pooled to those of the
document. It is trained in numpy by backpropagation through time on windows of a bounded sample of labelled
documents. Texts are predicted whole, cut into pieces of ``CHUNK`` bytes that run through the network side
by side.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.common import with_key
from riskmart.session import stage

UND = "und"
HIDDEN = 8
CHUNK = 192
LANES = 2048
# Bounds of the training sample: documents for each language, documents in all, and characters of each.
SAMPLE_PER_LANG = 400
SAMPLE_DOCS = 20_000
SAMPLE_CHARS = 384
OVERDRAW = 4
FOLDS, HELD_OUT_FOLD = 4, 2
MIN_SCORE = 0.4


@dataclass
class Network:
    """Per direction: input table (3H, 256) and recurrent weights (3H, H) for update, reset and candidate.

    ``out`` (2, K, H) and ``bias`` (K, 1) give the label scores. Gate rows of the tables hold half the gate's
    argument, so one tanh serves all of them: sigmoid(x) = tanh(x / 2) / 2 + 1 / 2.
    """

    langs: list[str]
    tables: list[np.ndarray]
    weights: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray

    @classmethod
    def fresh(cls, langs: list[str], hidden: int = HIDDEN, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
        return cls(langs, [draw(3 * hidden, 256), draw(3 * hidden, 256)], [draw(3 * hidden, hidden), draw(3 * hidden, hidden)],
                   draw(2, len(langs), hidden), np.zeros((len(langs), 1), np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [*self.tables, *self.weights, self.out, self.bias]


def _step(table: np.ndarray, weight: np.ndarray, x: np.ndarray, h: np.ndarray):
    """One step for all lanes: update z, reset r, candidate n, the recurrent part m of it, and the new state."""
    k = weight.shape[1]
    a, u = table.take(x, axis=1), weight @ h
    gates = a[:2 * k]
    gates += u[:2 * k]
    np.tanh(gates, out=gates)
    gates *= 0.5
    gates += 0.5
    z, r, m = gates[:k], gates[k:], u[2 * k:]
    n = r * m
    n += a[2 * k:]
    np.tanh(n, out=n)
    new = h - n
    new *= z
    new += n
    return z, r, n, m, new


def probabilities(net: Network, x: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Label probabilities (T, K, lanes) of bytes ``x`` (T, lanes); states are zero where not ``inside``."""
    full = bool(inside.all())
    steps, lanes = x.shape
    k = net.weights[0].shape[1]
    scores = np.empty((steps, len(net.langs), lanes), np.float32)
    for d, order in ((1, range(steps - 1, -1, -1)), (0, range(steps))):
        h = np.zeros((k, lanes), np.float32)
        for t in order:
            h = _step(net.tables[d], net.weights[d], x[t], h)[-1]
            if not full:
                h *= inside[t]
            if d:
                np.matmul(net.out[d], h, out=scores[t])
            else:
                scores[t] += net.out[d] @ h
    scores += net.bias
    scores -= scores.max(axis=1, keepdims=True)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=1, keepdims=True)
    return scores


def gradients(net: Network, x: np.ndarray, mask: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over the positions in ``mask`` and its gradients, in the order of ``parameters()``."""
    steps, lanes = x.shape
    k, n_langs = net.weights[0].shape[1], len(net.langs)
    trace: list[list] = [[None] * steps, [None] * steps]
    states = np.empty((2, steps, k, lanes), np.float32)
    for d, order in ((0, range(steps)), (1, range(steps - 1, -1, -1))):
        h = np.zeros((k, lanes), np.float32)
        for t in order:
            z, r, n, m, new = _step(net.tables[d], net.weights[d], x[t], h)
            trace[d][t] = (z, r, n, m, h)
            new *= mask[t]
            states[d, t] = h = new
    scores = np.einsum("dkh,dthb->tkb", net.out, states) + net.bias
    scores -= scores.max(axis=1, keepdims=True)
    p = np.exp(scores)
    p /= p.sum(axis=1, keepdims=True)
    total = max(1.0, float(mask.sum()))
    truth = np.arange(n_langs)[:, None] == labels
    loss = -float((np.log(np.maximum(np.where(truth, p, 0).sum(axis=1), 1e-9)) * mask).sum()) / total
    delta = (p - truth) * (mask / total)[:, None, :]
    d_out = np.einsum("tkb,dthb->dkh", delta, states)
    d_bias = delta.sum(axis=(0, 2))[:, None]
    d_tables, d_weights = [], []
    for d, order in ((0, range(steps - 1, -1, -1)), (1, range(steps))):
        d_arg = np.empty((steps, 3 * k, lanes), np.float32)
        d_w = np.zeros_like(net.weights[d])
        carry = np.zeros((k, lanes), np.float32)
        for t in order:
            z, r, n, m, h = trace[d][t]
            dh = (carry + net.out[d].T @ delta[t]) * mask[t]
            d_n = dh * (1 - z) * (1 - n * n)
            d_z = dh * (h - n) * z * (1 - z) * 2  # by half the gate's argument
            d_r = d_n * m * r * (1 - r) * 2
            d_u = np.concatenate((d_z, d_r, d_n * r))
            d_w += d_u @ h.T
            carry = dh * z + net.weights[d].T @ d_u
            d_arg[t, :2 * k], d_arg[t, 2 * k:] = d_u[:2 * k], d_n
        flat, bytes_ = d_arg.transpose(1, 0, 2).reshape(3 * k, -1), x.reshape(-1)
        d_tables.append(np.stack([np.bincount(bytes_, row, 256) for row in flat]).astype(np.float32))
        d_weights.append(d_w)
    return loss, [*d_tables, *d_weights, d_out.astype(np.float32), d_bias.astype(np.float32)]


def train(texts: list[bytes], labels: list[str], steps: int = 500, lanes: int = 96, length: int = 96, seed: int = 7,
          rate: float = 0.02, hidden: int = HIDDEN) -> Network:
    """Adam on windows of ``length`` bytes drawn from ``texts``, languages in equal parts."""
    langs = sorted(set(labels))
    net = Network.fresh(langs, hidden, seed)
    rng = np.random.default_rng(seed)
    by_lang = [[t for t, at in zip(texts, labels) if at == lang and t] for lang in langs]
    if not any(by_lang):
        return net
    usable = [i for i, group in enumerate(by_lang) if group]
    first = [np.zeros_like(p) for p in net.parameters()]
    second = [np.zeros_like(p) for p in net.parameters()]
    for step in range(1, steps + 1):
        x, mask = np.zeros((length, lanes), np.uint8), np.zeros((length, lanes), np.float32)
        y = np.array([usable[b % len(usable)] for b in range(lanes)])
        for b in range(lanes):
            text = by_lang[y[b]][rng.integers(len(by_lang[y[b]]))]
            start = rng.integers(max(1, len(text) - length // 2))
            piece = np.frombuffer(text[start:start + length], np.uint8)
            x[:len(piece), b], mask[:len(piece), b] = piece, 1
        _, grads = gradients(net, x, mask, y)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        scale, pace = min(1.0, 1.0 / max(norm, 1e-9)), rate * min(1.0, 3 * (1 - (step - 1) / steps))
        for p, g, m, v in zip(net.parameters(), grads, first, second):
            g = g * scale
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def sample(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG, most: int = SAMPLE_DOCS) -> tuple[list[bytes], list[str]]:
    """Windows of labelled texts with their languages: at most ``per_lang`` of each and ``most`` in all.

    Only documents outside the held-out fold with text, language and doc_id count; those with the smallest
    hashes of doc_id are taken, and of each a window at a place that the hash decides.
    """
    text = F.col("text").cast("string")
    rows = docs.filter(text.isNotNull() & (F.length(text) > 0) & F.col("lang").isNotNull() & F.col("doc_id").isNotNull()
                       & ~held_out(F.col("doc_id")))
    h = F.xxhash64(F.lit("langid"), F.col("doc_id"))
    narrow = rows.select(F.col("lang").cast("string").alias("lang"), h.alias("h"), "doc_id", text.alias("text"))
    counts = stage(narrow.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")), "languages")
    per_lang = max(1, min(per_lang, most // max(1, counts.count())))
    # hashes are compared within a language only below a bound that about OVERDRAW times as many rows stay under,
    # so the rows that meet do not grow with the table
    bound = F.least(F.lit(1.0), F.lit(float(OVERDRAW * per_lang)) / F.col("rows"))
    narrow = narrow.join(counts, "lang").filter(F.pmod("h", F.lit(1 << 40)) < bound * F.lit(float(1 << 40)))
    start = F.pmod("h", F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(1))).cast("int") + 1
    first = Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 40)), "h", "doc_id", "window")
    taken = (narrow.select("lang", "h", "doc_id", F.substring("text", start, F.lit(SAMPLE_CHARS)).alias("window"))
             .withColumn("at", F.row_number().over(first)).filter(F.col("at") <= per_lang)
             .orderBy("lang", "at").limit(most).select("lang", "window").collect())
    return [r["window"].encode() for r in taken], [r["lang"] for r in taken]


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def held_out(doc_id: Column) -> Column:
    """Null doc_id is in no fold: it is not held out, and not learned from either."""
    return F.coalesce(fold(doc_id) == HELD_OUT_FOLD, F.lit(False))


def pool(net: Network, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Mean label probabilities (documents, K) of the byte ranges of ``data``; zeros for empty ones."""
    n_chunks = -(-lengths // CHUNK)
    doc = np.repeat(np.arange(len(starts)), n_chunks)
    at = (np.arange(len(doc)) - np.repeat(np.cumsum(n_chunks) - n_chunks, n_chunks)) * CHUNK
    size = np.minimum(CHUNK, lengths[doc] - at)
    place = starts[doc] + at
    order = np.argsort(-size, kind="stable")  # full pieces together, short ones together
    sums = np.zeros((len(starts), len(net.langs)))
    padded = np.concatenate((data, np.zeros(CHUNK, np.uint8)))
    for i in range(0, len(order), LANES):
        lane = order[i:i + LANES]
        steps = np.arange(size[lane[0]])[:, None]
        inside = steps < size[lane]
        x = np.where(inside, padded[place[lane] + steps], 0).astype(np.uint8)
        p = probabilities(net, x, inside)
        pooled = np.einsum("tkb,tb->bk", p, inside.astype(np.float32))
        for k in range(len(net.langs)):
            sums[:, k] += np.bincount(doc[lane], pooled[:, k], len(starts))
    return sums / np.maximum(lengths, 1)[:, None]


def predict(docs: DataFrame, net: Network | None, *keep: str) -> DataFrame:
    """The columns ``keep`` with ``lang_pred`` and ``score``, the pooled probability of that language.

    Of languages equally probable the first by name is taken. ``und`` and 0 for null text, text without a letter, and all texts when there was nothing to learn from.
    Repeated rows get equal predictions; columns other than the text play no part; an empty table gives an
    empty result. Very long texts are many pieces of one batch of lanes after the other.
    """
    text = F.col("text").cast("string")
    rows = docs.select(*keep, F.when(text.rlike(r"\p{L}"), text).alias("text_for_lang"))
    schema = rows.select(*keep).schema
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array(batch.column(len(names)), pa.large_string())
            lang, score = np.full(batch.num_rows, None, object), np.zeros(batch.num_rows)
            lang[:] = UND
            known = np.array(texts.is_valid(), bool)
            if net is not None and net.langs and known.any():
                _, offsets, data = texts.buffers()
                bounds = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
                means = pool(net, np.frombuffer(data, np.uint8), bounds[:-1], np.where(known, np.diff(bounds), 0))
                best = means.argmax(axis=1)
                lang[known] = np.array(net.langs, object)[best[known]]
                score[known] = np.clip(np.round(means[np.arange(len(best)), best][known], 6), 0, 1)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(names))), pa.array(lang.tolist(), pa.string()),
                                              pa.array(score)], [*names, "lang_pred", "score"])

    from pyspark.sql.types import DoubleType, StringType

    for name, kind in (("lang_pred", StringType()), ("score", DoubleType())):
        schema = schema.add(name, kind)
    return rows.mapInArrow(run, schema)


def fit(docs: DataFrame) -> Network | None:
    texts, labels = sample(docs)
    return train(texts, labels) if texts else None


def identify(docs: DataFrame, *keep: str) -> DataFrame:
    """Learns from the labelled documents outside the held-out fold and predicts all of ``docs``."""
    return predict(docs, fit(docs), *keep)


def keep_identified(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """Documents, with their own columns, whatever their names, whose language is known with a probability of ``min_score``.

    Null and empty texts and those without a letter go; repeated rows stay or go together; of languages equally probable
    the first by name is taken. With nothing to learn from, as in an empty table, no row is left.
    """
    net = fit(docs)
    rows = with_key(docs).select("row", F.col("row.text").alias("text"))
    found = predict(rows, net, "row")
    if net is None:
        return found.limit(0).select("row.*")
    return found.filter((F.col("lang_pred") != UND) & (F.col("score") >= min_score)).select("row.*")
