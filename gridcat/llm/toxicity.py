"""Toxicity scores by a bidirectional gated recurrent network with attention.

A word enters as its own embedding, if the training rows know it, beside the
sum of its character n-gram embeddings, so unseen spellings still count.
Forward and backward gated recurrent units read each window of words,
attention pools their states, and a logistic unit scores the window.  Windows
overlap by half; a document's score is that of its most toxic window.  The
network is trained in numpy on a bounded sample of labelled documents and then scores all
texts inside the tasks.

Labels belong to documents, not windows: a toxic document trains on the windows that look
most toxic, first by word and n-gram log odds, then by the network itself; a clean one on its
most toxic looking windows and on others drawn at random.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Texts, worker_memory

THRESHOLD = 0.3
WINDOW, STRIDE = 32, 16
SAMPLE_PER_CLASS = 2000          # labelled documents of each class that the network is trained on, about
SAMPLE_CHARS = 20_000            # longer documents are not used for training
VOCABULARY, BUCKETS = 4096, 8192
WORD_DIM, CHAR_DIM, HIDDEN, ATTENTION = 12, 12, 8, 8
EVIDENCE, ENOUGH = 0.3, 1200     # part of a word's log odds that its embedding starts with, less the more documents
EPOCHS, MIN_STEPS, BATCH, RATE = 6, 500, 128, 0.01
SPARE_WINDOWS = 4000             # random windows of clean documents, about
HELD_OUT_MODULUS, HELD_OUT_REST = 4, 2

_TRIM = ".,;:!?\"'()[]{}<>*#$%&|/-_"
_BLOCK_WORDS = 1 << 16
_CACHED_WORDS = 200_000


def tokens(text: str | None) -> list[str]:
    return (text or "").lower().split()


def trimmed(word: str) -> str:
    return word.strip(_TRIM) or word


def ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all character 3- and 4-grams (of UTF-8 bytes, with edge
    marks) of the words, and where each word's begin."""
    data = b"\x01" + b"\x01".join(w.encode() for w in words) + b"\x01\x01"
    raw = np.frombuffer(data, np.uint8).astype(np.uint32)
    marks = np.flatnonzero(raw == 1)[:len(words) + 1]
    sizes = np.diff(marks) - 1
    n = len(raw)
    with np.errstate(over="ignore"):
        three = raw[:n - 2] * np.uint32(0x9E3779B1) + raw[1:n - 1] * np.uint32(0x85EBCA6B) + raw[2:] * np.uint32(0xC2B2AE35)
        four = np.concatenate([three[:-1] * np.uint32(31) + raw[3:] * np.uint32(0x27D4EB2F), np.zeros(1, np.uint32)])
    buckets = [((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(12)) % np.uint32(BUCKETS)
               for h in (three, four)]
    # a word of L bytes at mark m has 3-grams at m .. m+L-1 and 4-grams at m .. m+L-2; L is at least 1
    starts = np.concatenate([[0], np.cumsum(2 * sizes - 1)])
    out = np.empty(starts[-1], np.int32)
    owner = np.repeat(np.arange(len(words)), sizes)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    place = marks[:-1][owner] + inner
    out[starts[:-1][owner] + inner] = buckets[0][place]
    has_four = inner < sizes[owner] - 1
    out[(starts[:-1][owner] + sizes[owner] + inner)[has_four]] = buckets[1][place[has_four]]
    return out, starts


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _summed(ids: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Rows added up by id into a table of ``n`` rows."""
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    firsts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    out = np.zeros((n, rows.shape[1]), np.float32)
    out[ids[firsts]] = np.add.reduceat(rows[order], firsts, axis=0)
    return out


class Network:
    """Parameters and the passes over windows of word rows."""

    def __init__(self, vocabulary: dict[str, int], seed: int = 1):
        draw = np.random.default_rng(seed)
        d, h = WORD_DIM + CHAR_DIM, HIDDEN
        normal = lambda *shape, s: draw.normal(0, s, shape).astype(np.float32)
        self.vocabulary = vocabulary        # word -> 1.., 0 for words that training did not keep
        self.p = {"word": normal(len(vocabulary) + 1, WORD_DIM, s=0.1), "char": normal(BUCKETS, CHAR_DIM, s=0.1),
                  "A": normal(2 * h, ATTENTION, s=0.3), "a": np.zeros(ATTENTION, np.float32),
                  "v": normal(ATTENTION, s=0.3), "w": normal(2 * h, s=0.3), "b": np.zeros(1, np.float32)}
        for side in "fb":
            self.p |= {f"W{side}": normal(d, 3 * h, s=d ** -0.5), f"c{side}": np.zeros(3 * h, np.float32),
                       f"U{side}": normal(h, 3 * h, s=h ** -0.5), f"n{side}": np.zeros(h, np.float32)}

    def embed(self, words: list[str]) -> tuple[np.ndarray, tuple]:
        """Input vectors of trimmed words: own embedding and scaled n-gram sum."""
        ids = np.array([self.vocabulary.get(w, 0) for w in words])
        grams, starts = ngrams(words)
        scale = (1 / np.sqrt(np.diff(starts))).astype(np.float32)[:, None]
        chars = np.add.reduceat(self.p["char"][grams], starts[:-1], axis=0) * scale
        return np.concatenate([self.p["word"][ids], chars], axis=1), (ids, grams, starts, scale)

    def project(self, vectors: np.ndarray) -> np.ndarray:
        """Both directions' input terms, side by side."""
        return np.concatenate([vectors @ self.p["Wf"] + self.p["cf"], vectors @ self.p["Wb"] + self.p["cb"]], axis=1)

    def forward(self, rows: np.ndarray, lengths: np.ndarray, inputs: np.ndarray, keep: bool = False):
        """Logit of each window; ``rows`` (windows x places) index ``inputs``.  With
        ``keep`` also what the backward pass needs."""
        n, t_max, h = len(rows), int(lengths.max()), HIDDEN
        states = np.zeros((t_max, n, 2 * h), np.float32)
        live = lengths[None, :] > np.arange(t_max)[:, None]
        saved: dict = {"f": {}, "b": {}}
        for side, offset, order in (("f", 0, range(t_max)), ("b", 1, range(t_max - 1, -1, -1))):
            state = np.zeros((n, h), np.float32)
            u, bias = self.p[f"U{side}"], self.p[f"n{side}"]
            terms = inputs[:, offset * 3 * h:(offset + 1) * 3 * h]
            for t in order:
                x, g = terms[rows[:, t]], state @ u
                gates = _sigmoid(x[:, :2 * h] + g[:, :2 * h])
                z, r = gates[:, :h], gates[:, h:]
                inner = g[:, 2 * h:] + bias
                new = np.tanh(x[:, 2 * h:] + r * inner)
                after = new + z * (state - new)
                if not live[t].all():
                    after = np.where(live[t][:, None], after, state)
                if keep:
                    saved[side][t] = (state, z, r, inner, new)
                state = after
                states[t, :, offset * h:(offset + 1) * h] = state
        scores = np.tanh(states @ self.p["A"] + self.p["a"])
        weights = scores @ self.p["v"]
        weights = np.where(live, np.exp(weights - weights.max(0)), 0)
        weights /= weights.sum(0)
        pooled = (states * weights[:, :, None]).sum(0)
        logits = pooled @ self.p["w"] + self.p["b"][0]
        return (logits, (states, scores, weights, pooled, live, saved)) if keep else logits

    def gradients(self, rows: np.ndarray, lengths: np.ndarray, words: list[str], labels: np.ndarray,
                  weights_of: np.ndarray, hidden_words: np.ndarray) -> tuple[float, dict]:
        """Logistic loss of windows over the distinct ``words`` they use, and
        its gradient.  ``hidden_words`` marks words that go without their own
        embedding this time, so that characters have to carry them."""
        p, h = self.p, HIDDEN
        vectors, (ids, grams, starts, scale) = self.embed(words)
        ids = np.where(hidden_words, 0, ids)
        vectors[:, :WORD_DIM] = p["word"][ids]
        inputs = self.project(vectors)
        logits, (states, scores, weights, pooled, live, saved) = self.forward(rows, lengths, inputs, keep=True)
        guess = _sigmoid(logits)
        loss = -np.mean(weights_of * (labels * np.log(guess + 1e-7) + (1 - labels) * np.log(1 - guess + 1e-7)))
        d_logit = (weights_of * (guess - labels) / len(labels)).astype(np.float32)
        grad = {"w": pooled.T @ d_logit, "b": np.array([d_logit.sum()], np.float32)}
        d_pooled = d_logit[:, None] * p["w"]
        d_states = weights[:, :, None] * d_pooled
        d_weight = (states * d_pooled).sum(2)
        d_weight = weights * (d_weight - (weights * d_weight).sum(0))
        d_score = d_weight[:, :, None] * p["v"] * (1 - scores ** 2)
        grad["v"] = np.einsum("tna,tn->a", scores, d_weight)
        grad["A"] = np.einsum("tnh,tna->ha", states, d_score)
        grad["a"] = d_score.sum((0, 1))
        d_states += d_score @ p["A"].T
        t_max = len(states)
        d_inputs = np.zeros_like(inputs)
        order = np.argsort(rows[:, :t_max].T, axis=None, kind="stable")
        flat = rows[:, :t_max].T.ravel()[order]
        firsts = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
        for side, offset, back in (("f", 0, range(t_max - 1, -1, -1)), ("b", 1, range(t_max))):
            u = p[f"U{side}"]
            d_u, d_n = np.zeros_like(u), np.zeros(h, np.float32)
            d_next = np.zeros((len(rows), h), np.float32)
            d_terms = np.zeros((t_max, len(rows), 3 * h), np.float32)
            for t in back:
                state, z, r, inner, new = saved[side][t]
                on = live[t][:, None]
                total = d_next + d_states[t, :, offset * h:(offset + 1) * h] * on
                d_h = total * on
                d_new = d_h * (1 - z) * (1 - new ** 2)
                d_z = d_h * (state - new) * z * (1 - z)
                d_r = d_new * inner * r * (1 - r)
                d_g = np.concatenate([d_z, d_r, d_new * r], axis=1)
                d_terms[t] = np.concatenate([d_z, d_r, d_new], axis=1)
                d_u += state.T @ d_g
                d_n += d_g[:, 2 * h:].sum(0)
                d_next = np.where(on, d_h * z + d_g @ u.T, d_next)
            grad[f"U{side}"], grad[f"n{side}"] = d_u, d_n
            d_inputs[flat[firsts], offset * 3 * h:(offset + 1) * 3 * h] = np.add.reduceat(
                d_terms.reshape(-1, 3 * h)[order], firsts, axis=0)
        d_vectors = np.zeros_like(vectors)
        for side, offset in (("f", 0), ("b", 1)):
            part = d_inputs[:, offset * 3 * h:(offset + 1) * 3 * h]
            grad[f"W{side}"], grad[f"c{side}"] = vectors.T @ part, part.sum(0)
            d_vectors += part @ p[f"W{side}"].T
        grad["word"] = _summed(ids, d_vectors[:, :WORD_DIM], len(p["word"]))
        grad["char"] = _summed(grams, np.repeat(d_vectors[:, WORD_DIM:] * scale, np.diff(starts), axis=0), BUCKETS)
        return float(loss), grad


class Scorer:
    """Scores texts of one task; word terms are kept for the words met before."""

    def __init__(self, network: Network):
        self.network = network
        self.rows: dict[str, int] = {}
        self.inputs = np.zeros((1024, 6 * HIDDEN), np.float32)     # row 0 pads
        self.used = 1

    def _learn(self, words: set[str]) -> None:
        fresh = [w for w in words if w not in self.rows]
        if not fresh:
            return
        if len(self.rows) + len(fresh) > _CACHED_WORDS:
            self.rows, self.used, fresh = {}, 1, list(words)
        vectors, _ = self.network.embed([trimmed(w) for w in fresh])
        n, end = self.used, self.used + len(fresh)
        if end > len(self.inputs):
            grown = np.zeros((max(end, 2 * len(self.inputs)), 6 * HIDDEN), np.float32)
            grown[:n] = self.inputs[:n]
            self.inputs = grown
        self.inputs[n:end] = self.network.project(vectors)
        self.rows.update(zip(fresh, range(n, end)))
        self.used = end

    def window_logits(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logits of all windows of some texts' words, their text and first word."""
        self._learn(set().union(*texts))
        lookup = self.rows.__getitem__
        flat = np.array([0, *(lookup(w) for words in texts for w in words)], np.int64)
        sizes = np.array([len(words) for words in texts])
        begin = np.cumsum(sizes) - sizes
        counts = np.maximum(1, -(-(sizes - WINDOW) // STRIDE) + 1)
        owner = np.repeat(np.arange(len(texts)), counts)
        first = (np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)) * STRIDE
        lengths = np.minimum(WINDOW, sizes[owner] - first)
        places = first[:, None] + np.arange(WINDOW)
        rows = np.where(np.arange(WINDOW) < lengths[:, None], flat[np.minimum(1 + begin[owner][:, None] + places,
                                                                               len(flat) - 1)], 0)
        out = np.empty(len(rows), np.float32)
        order = np.argsort(lengths, kind="stable")      # windows of like length together
        for at in range(0, len(rows), 2048):
            some = order[at:at + 2048]
            out[some] = self.network.forward(rows[some], lengths[some], self.inputs)
        return out, owner, first

    def scores(self, texts) -> np.ndarray:
        """Score of each text; one without words has the empty window's."""
        out = np.full(len(texts), -np.inf)
        block, size = [], 0

        def run() -> None:
            logits, owner, _ = self.window_logits([w for _, w in block])
            np.maximum.at(out, np.array([i for i, _ in block])[owner], logits)

        for i, text in enumerate(texts):
            words = tokens(text)
            # a text beyond a block's words is scored in overlapping parts, so that memory stays bounded
            for at in range(0, max(1, len(words) - WINDOW + STRIDE), _BLOCK_WORDS):
                part = words[at:at + _BLOCK_WORDS + WINDOW - STRIDE]
                if not part:
                    continue
                block.append((i, part))
                size += len(part)
                if size >= _BLOCK_WORDS:
                    run()
                    block, size = [], 0
        if block:
            run()
        empty = out == -np.inf
        out[empty] = float(self.network.p["b"][0]) - 3.0
        return _sigmoid(out)


def _log_odds(texts: list[list[str]], labels: np.ndarray) -> dict[str, float]:
    """Log odds of words, the greater of the word's own and its strongest n-gram's."""
    toxic, clean = Counter(), Counter()
    for words, label in zip(texts, labels):
        (toxic if label else clean).update({trimmed(w) for w in words})
    words = list(toxic.keys() | clean.keys())
    pos, neg = np.array([toxic[w] for w in words], float), np.array([clean[w] for w in words], float)
    n_pos, n_neg = max(1, labels.sum()), max(1, (1 - labels).sum())
    grams, starts = ngrams(words)
    sizes = np.diff(starts)
    gram_pos = np.bincount(grams, np.repeat(pos, sizes), BUCKETS)
    gram_neg = np.bincount(grams, np.repeat(neg, sizes), BUCKETS)
    odds = lambda p, n: np.log((p + 0.5) / n_pos) - np.log((n + 0.5) / n_neg) - 2 / (p + n + 1)
    by_gram = np.maximum.reduceat(odds(gram_pos, gram_neg)[grams], starts[:-1])
    return dict(zip(words, np.maximum(odds(pos, neg), by_gram)))


def train(texts: list[str], labels: list[int], seed: int = 1, epochs: int = EPOCHS) -> Network:
    """Fit a network to labelled texts.  One class alone, or none, gives a
    network that scores everything by the share of toxic rows."""
    draw = np.random.default_rng(seed)
    docs = [(tokens(t), int(y)) for t, y in zip(texts, labels)]
    docs = [d for d in docs if d[0]]
    y = np.array([d[1] for d in docs])
    if not len(y) or y.min() == y.max():
        network = Network({}, seed)
        network.p["w"][:] = 0
        network.p["b"][:] = 6.0 if len(y) and y.max() else -6.0
        return network
    words = [d[0] for d in docs]
    odds = _log_odds(words, y)
    seen = Counter(w for ws in words for w in {trimmed(x) for x in ws})
    known = sorted((w for w, n in seen.items() if n >= 3), key=lambda w: (-abs(odds[w]), w))[:VOCABULARY]
    network = Network({w: i + 1 for i, w in enumerate(known)}, seed)
    network.p["b"][:] = -2.0
    # a few documents show each word too seldom to train its embedding: its first entry starts at the word's log odds
    network.p["word"][1:, 0] = EVIDENCE * max(0, 1 - len(docs) / ENOUGH) * np.clip([odds[w] for w in known], -6, 6)

    # few clean documents give more windows each: what is ordinary has to be seen
    spare = int(np.clip(SPARE_WINDOWS // max(1, int((y == 0).sum())), 1, 12))

    def windows(strength) -> list[tuple[list[str], int]]:
        chosen = []
        for (ws, label), s in zip(docs, strength):
            ranked = np.argsort(-s, kind="stable")
            picks = list(ranked[:1] if label else ranked[:2])
            if label and len(ranked) > 1 and s[ranked[1]] > 0.8 * s[ranked[0]]:
                picks.append(ranked[1])
            if not label:
                picks += list(draw.choice(len(s), min(len(s), spare), replace=False))
            chosen += [([trimmed(w) for w in ws[int(i) * STRIDE:int(i) * STRIDE + WINDOW]], label) for i in picks]
        return chosen

    def by_odds() -> list[np.ndarray]:
        out = []
        for ws, _ in docs:
            each = np.array([odds[trimmed(w)] for w in ws])
            n = max(1, -(-(len(ws) - WINDOW) // STRIDE) + 1)
            out.append(np.array([each[i * STRIDE:i * STRIDE + WINDOW].max() for i in range(n)]))
        return out

    def by_network() -> list[np.ndarray]:
        scorer, out = Scorer(network), []
        for at in range(0, len(docs), 64):
            part = [ws for ws, _ in docs[at:at + 64]]
            logits, owner, _ = scorer.window_logits(part)
            out += [_sigmoid(logits[owner == i]) for i in range(len(part))]
        return out

    data = windows(by_odds())
    first = {k: np.zeros_like(v) for k, v in network.p.items()}
    second = {k: np.zeros_like(v) for k, v in network.p.items()}
    step = 0
    epochs = max(epochs, -(-MIN_STEPS * BATCH // len(data)))    # a small sample is read more often
    for epoch in range(epochs):
        if epoch in (epochs // 3, 2 * epochs // 3):
            data = windows(by_network())
        rate = RATE * (1 - 0.8 * epoch / epochs)
        share = sum(label for _, label in data) / len(data)
        order = draw.permutation(len(data))
        for at in range(0, len(order), BATCH):
            some = [data[i] for i in order[at:at + BATCH]]
            index = {w: i + 1 for i, w in enumerate(dict.fromkeys(w for ws, _ in some for w in ws))}
            lengths = np.array([len(ws) for ws, _ in some])
            rows = np.zeros((len(some), WINDOW), np.int64)
            for i, (ws, _) in enumerate(some):
                rows[i, :len(ws)] = [index[w] for w in ws]
            target = np.array([label for _, label in some], np.float32)
            weight = np.where(target == 1, 0.5 / max(share, 1e-3), 0.5 / max(1 - share, 1e-3)).astype(np.float32)
            hidden = draw.random(len(index) + 1) < 0.4
            _, grad = network.gradients(rows, lengths, ["\x02", *index], target, weight, hidden)
            step += 1
            norm = np.sqrt(sum(float((g ** 2).sum()) for g in grad.values()))
            for k, g in grad.items():
                g = g * np.float32(min(1.0, 5.0 / (norm + 1e-9)))
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                network.p[k] -= (rate * (first[k] / (1 - 0.9 ** step))
                                 / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return network


def held_out(key: str = "doc_id") -> Column:
    """Rows whose labels are never learned from."""
    rest = F.pmod(F.crc32(F.col(key).cast("string")), F.lit(HELD_OUT_MODULUS))
    return F.coalesce(rest == HELD_OUT_REST, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        per_class: int = SAMPLE_PER_CLASS, characters: int = SAMPLE_CHARS) -> Network:
    """Train on at most about ``per_class`` labelled documents of each class, taken by hash
    of the key, none held out and none over ``characters`` long.  Rows of
    ``labels`` that repeat a key count once, as toxic if any is; null labels not at all.
    """
    known = (labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).where(~held_out(key))
             .groupBy(F.col(key).alias("__key")).agg(F.max(label).alias("__label")))
    counts = {r[0]: r[1] for r in known.groupBy("__label").count().collect()}
    part = F.pmod(F.xxhash64("__key", F.lit("toxicity")), F.lit(1 << 20))
    wanted = F.lit(0)
    for value, n in counts.items():
        wanted = F.when(F.col("__label") == value, min(1 << 20, (1 << 20) * per_class // n)).otherwise(wanted)
    # the sample's size is bounded by its parameter, so it is broadcast to the texts
    sample = known.where(part < wanted).orderBy(part, "__key").limit(4 * per_class)
    body = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text")).where(
        F.length("__text").between(1, characters))
    rows = (body.join(F.broadcast(sample), "__key").select("__key", "__text", "__label")
            .orderBy(part, "__key", F.xxhash64("__text")).limit(8 * per_class).collect())
    rows = sorted({(r[0], r[1], r[2]) for r in rows})
    return train([r[1] for r in rows], [r[2] for r in rows])


def score(docs: DataFrame, network: Network, key: str = "doc_id", text: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """``key, held_out, score, predicted`` for every row of ``docs``.  The score reads the text
    alone.  Null, empty or blank texts have a low constant score; repeated rows score alike."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        with worker_memory():
            scorer = Scorer(network)
            for batch in batches:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(scorer.scores(Texts(batch.column(2))), pa.float64())],
                    names=[key, "held_out", "score"])
            del scorer

    scored = docs.select(key, held_out(key).alias("held_out"), text).mapInArrow(
        run, f"`{key}` {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, network: Network, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``threshold``."""
    place = docs.columns.index(text)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        with worker_memory():
            scorer = Scorer(network)
            for batch in batches:
                yield batch.filter(pa.array(scorer.scores(Texts(batch.column(place))) < threshold, pa.bool_()))
            del scorer

    return docs.mapInArrow(run, docs.schema)
