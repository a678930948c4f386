"""A bidirectional gated recurrent network with attention pooling, in numpy.

Each word enters as a word part (a hashed embedding and a smoothed log-odds of its bucket) and a
character part (the mean of its hashed character n-grams' embeddings, and the mean and highest of their log-odds). A forward and a backward GRU
read a window of words, attention pools their states, and a logistic unit scores the window. A text's
score is that of its highest window; windows overlap and cover the whole text.
"""

from __future__ import annotations

import numpy as np

from citylake.llm.dartminhash import apart, mix, split_words

WORDS, GRAMS = 1 << 14, 1 << 15
#: Lengths of n-grams, in UTF-8 bytes; a word's bounds count as a byte.
LENGTHS = (3, 5, 7)
EMBED, HIDDEN, ATTEND = 8, 8, 8
WINDOW, STRIDE = 64, 32
INPUT = 2 * EMBED + 3


def _sigmoid(x):
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Words:
    """The words of some texts: ``bucket`` and trigram ids of the distinct ones, and the texts as
    indexes of those. Words are lower-cased runs of ASCII letters and digits, and of other characters but Unicode
    white space and punctuation; in scripts without spaces each character is one."""

    def __init__(self, texts: list[bytes]):
        low, first, last, hashes, counts = split_words(apart(texts))
        distinct, where, self.ids = np.unique(hashes, return_index=True, return_inverse=True)
        self.counts = counts
        self.bucket = (distinct % np.uint64(WORDS)).astype(np.int64)
        start, size = first[where], (last - first)[where]
        # n-grams of ^word$
        room = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        begin, n, word = np.repeat(start, size), np.repeat(size, size), np.repeat(np.arange(len(distinct)), size)
        grams, of = [], []
        for width in LENGTHS:
            got = np.full(len(room), np.uint64(width))
            for k in range(width):
                j = room + k - 1
                byte = np.where(j < 0, 1, np.where(j >= n, 2, low[np.clip(begin + j, 0, max(len(low) - 1, 0))])) if len(room) else j
                got = (got ^ byte.astype(np.uint64)) * np.uint64(0x100000001B3)
            ok = room + width - 1 <= n
            if width == LENGTHS[0]:
                ok |= room == 0  # the shortest words have one
            grams.append((mix(got[ok]) % np.uint64(GRAMS)).astype(np.int64))
            of.append(word[ok])
        order = np.argsort(np.concatenate(of), kind="stable")
        self.gram, self.of = np.concatenate(grams)[order], np.concatenate(of)[order]
        self.size = np.maximum(np.bincount(self.of, minlength=len(distinct)), 1)

    def pooled(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean, and highest last column, of the table's rows over the n-grams of each distinct word."""
        if not len(self.bucket):
            return np.zeros((0, table.shape[1])), np.zeros((0, 1))
        rows = table[self.gram]
        first = np.cumsum(self.size) - self.size
        return np.add.reduceat(rows, first) / self.size[:, None], np.maximum.reduceat(rows[:, -1], first)[:, None]


def windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, words) of every window: one each STRIDE words and one that ends the text; a
    text without words has one empty window."""
    many = np.where(counts > WINDOW, -(-(counts - WINDOW) // STRIDE) + 1, 1)
    text = np.repeat(np.arange(len(counts)), many)
    k = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    inside = np.minimum(k * STRIDE, np.maximum(counts[text] - WINDOW, 0))
    base = np.cumsum(counts) - counts
    return text, base[text] + inside, np.minimum(counts[text], WINDOW)


class Net:
    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)

        def init(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.p = {"E": init(WORDS, EMBED, scale=0.1), "C": init(GRAMS, EMBED, scale=0.1), "A": init(2 * HIDDEN, ATTEND, scale=0.3),
                  "ab": np.zeros(ATTEND, np.float32), "av": init(ATTEND, scale=0.3), "w": init(2 * HIDDEN, scale=0.3), "c": np.zeros(1, np.float32)}
        for d in "fb":
            self.p |= {f"W{d}": init(INPUT, 3 * HIDDEN, scale=0.3), f"U{d}": init(HIDDEN, 3 * HIDDEN, scale=0.3),
                       f"B{d}": np.zeros(3 * HIDDEN, np.float32), f"N{d}": np.zeros(HIDDEN, np.float32)}
        self.word_odds, self.gram_odds = np.zeros(WORDS, np.float32), np.zeros(GRAMS, np.float32)
        self.scale, self.shift = 1.0, 0.0

    def inputs(self, words: Words, word_odds=None, gram_odds=None) -> np.ndarray:
        """Input vectors of the distinct words."""
        wo, go = self.word_odds if word_odds is None else word_odds, self.gram_odds if gram_odds is None else gram_odds
        mean, high = words.pooled(np.concatenate([self.p["C"], go[:, None]], 1))
        return np.concatenate([self.p["E"][words.bucket], wo[words.bucket][:, None], mean, high], 1).astype(np.float32)

    def _run(self, d: str, gates: np.ndarray, index: np.ndarray, mask: np.ndarray, keep=None):
        """States of one direction. ``gates``: input gates by word; ``index``: words (time, window)."""
        U, N, H = self.p[f"U{d}"], self.p[f"N{d}"], HIDDEN
        h = np.zeros((index.shape[1], H), np.float32)
        states = np.zeros((*index.shape, H), np.float32)
        for t in range(len(index)) if d == "f" else range(len(index) - 1, -1, -1):
            x, u = gates[index[t]], h @ U
            rz = _sigmoid(x[:, :2 * H] + u[:, :2 * H])
            r, z, q = rz[:, :H], rz[:, H:], u[:, 2 * H:] + N
            n = np.tanh(x[:, 2 * H:] + r * q)
            new = n + z * (h - n)
            if keep is not None:
                keep[t] = (h, r, z, n, q)
            h = new if mask is None else np.where(mask[t][:, None], new, h)
            states[t] = h
        return states

    def _pool(self, states, mask):
        a = np.tanh(states @ self.p["A"] + self.p["ab"])
        e = a @ self.p["av"]
        e = np.where(mask, e, -1e9)
        e = np.exp(e - e.max(0))
        weight = np.where(mask, e, 0)
        weight = weight / np.maximum(weight.sum(0), 1e-9)
        return a, weight, (states * weight[:, :, None]).sum(0)

    def logits(self, x: np.ndarray, ids: np.ndarray, first: np.ndarray, size: np.ndarray, group: int = 4096) -> np.ndarray:
        """Scores of windows; ``group`` windows at a time bound the memory."""
        out = np.zeros(len(first), np.float32)
        gates = {d: x @ self.p[f"W{d}"] + self.p[f"B{d}"] for d in "fb"}
        order = np.argsort(-size, kind="stable")
        for k in range(0, len(order), group):
            pick = order[k:k + group]
            longest = max(int(size[pick].max()), 1)
            index, mask = _index(ids, first[pick], size[pick], longest)
            if not len(ids):
                out[pick] = self.p["c"][0]
                continue
            whole = None if mask.all() else mask
            states = np.concatenate([self._run(d, gates[d], index, whole) for d in "fb"], 2)
            out[pick] = self._pool(states, mask)[2] @ self.p["w"] + self.p["c"][0]
        return out

    def texts(self, texts: list[bytes]) -> np.ndarray:
        """The highest window logit of each text."""
        words = Words(texts)
        text, first, size = windows(words.counts)
        z = self.logits(self.inputs(words), words.ids, first, size)
        best = np.full(len(texts), -np.inf)
        np.maximum.at(best, text, z)
        return best

    def probability(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.texts(texts) + self.shift, -40, 40))) if texts else np.zeros(0)

    def gradients(self, x, words: Words, index, mask, y) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients of a batch of windows, by back-propagation through time."""
        p, H = self.p, HIDDEN
        gates = {d: x @ p[f"W{d}"] + p[f"B{d}"] for d in "fb"}
        kept = {d: {} for d in "fb"}
        states = np.concatenate([self._run(d, gates[d], index, mask, kept[d]) for d in "fb"], 2)
        a, weight, pooled = self._pool(states, mask)
        z = pooled @ p["w"] + p["c"][0]
        prob = _sigmoid(z)
        loss = float(-np.mean(y * np.log(prob + 1e-7) + (1 - y) * np.log(1 - prob + 1e-7)))
        dz = (prob - y) / len(y)
        g = {"w": pooled.T @ dz, "c": np.array([dz.sum()])}
        dp = dz[:, None] * p["w"]
        dstates = weight[:, :, None] * dp
        dw = (states * dp).sum(2)
        de = weight * (dw - (weight * dw).sum(0))
        da = de[:, :, None] * p["av"] * (1 - a * a)
        g["av"] = (a * de[:, :, None]).sum((0, 1))
        g["A"], g["ab"] = np.einsum("tbi,tbj->ij", states, da), da.sum((0, 1))
        dstates = dstates + da @ p["A"].T
        dx = np.zeros_like(x)
        for k, d in enumerate("fb"):
            U, dU, dN, dgates = p[f"U{d}"], np.zeros_like(p[f"U{d}"]), np.zeros(H, np.float32), np.zeros_like(gates[d])
            carry = np.zeros((index.shape[1], H), np.float32)
            steps = range(len(index) - 1, -1, -1) if d == "f" else range(len(index))
            for t in steps:
                h, r, zz, n, q = kept[d][t]
                dh = dstates[t, :, k * H:(k + 1) * H] + carry
                m = mask[t][:, None]
                dnew = np.where(m, dh, 0)
                dn = dnew * (1 - zz) * (1 - n * n)
                dzz = dnew * (h - n) * zz * (1 - zz)
                dr = dn * q * r * (1 - r)
                du = np.concatenate([dr, dzz, dn * r], 1)
                dN += (dn * r).sum(0)
                dU += h.T @ du
                np.add.at(dgates, index[t], np.concatenate([dr, dzz, dn], 1))
                carry = np.where(m, dnew * zz, dh) + du @ U.T
            g[f"U{d}"], g[f"N{d}"], g[f"B{d}"], g[f"W{d}"] = dU, dN, dgates.sum(0), x.T @ dgates
            dx += dgates @ p[f"W{d}"].T
        g["E"] = np.zeros_like(p["E"])
        np.add.at(g["E"], words.bucket, dx[:, :EMBED])
        g["C"] = np.zeros_like(p["C"])
        chars = dx[:, EMBED + 1:2 * EMBED + 1] / words.size[:, None]
        np.add.at(g["C"], words.gram, chars[words.of])
        return loss, g


def _index(ids, first, size, longest):
    step = np.arange(longest)[:, None]
    mask = step < size[None, :]
    at = np.where(mask, first[None, :] + step, 0)
    return (ids[at] if len(ids) else at), mask


def odds(words: Words, y: np.ndarray, of_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shrunk log-odds, between texts of label 1 and 0, that a text holds the word bucket or n-gram."""
    text = np.repeat(np.arange(len(words.counts)), words.counts)
    used = of_text[text]
    pair = np.unique(text[used] * np.int64(len(words.bucket)) + words.ids[used])
    t, w = pair // max(len(words.bucket), 1), pair % max(len(words.bucket), 1)
    n1, n0 = (y[of_text] == 1).sum(), (y[of_text] == 0).sum()

    per = np.bincount(words.of, minlength=len(words.bucket))
    start = np.cumsum(per) - per
    seen = [np.zeros((2, WORDS), np.int64), np.zeros((2, GRAMS), np.int64)]
    # some texts at a time bound the memory; a bucket counts once per text
    edges = [*range(0, len(t), 20_000), len(t)]
    edges = sorted({int(np.searchsorted(t, t[e], "left")) if 0 < e < len(t) else e for e in edges})
    for lo, hi in zip(edges, edges[1:]):
        texts, held = t[lo:hi], w[lo:hi]
        many = per[held]
        grams = words.gram[np.repeat(start[held], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)]
        for table, of, items in ((seen[0], texts, words.bucket[held]), (seen[1], np.repeat(texts, many), grams)):
            key = np.unique(of * np.int64(table.shape[1]) + items)
            of, items = key // table.shape[1], key % table.shape[1]
            for v in (0, 1):
                table[v] += np.bincount(items[y[of] == v], minlength=table.shape[1])

    def shrunk(table):
        b, a = table
        return ((np.log((a + 0.5) / (n1 + 1)) - np.log((b + 0.5) / (n0 + 1))) * (a + b) / (a + b + 8.0)).astype(np.float32)

    return shrunk(seen[0]), shrunk(seen[1])


def train(texts: list[bytes], labels: np.ndarray, share: float, steps: int = 300, batch: int = 32, rate: float = 0.01, seed: int = 0) -> Net:
    """Fit on labelled texts; ``share`` is the share of label 1 among all rows the texts stand for.

    The label holds for a text, not a window: a text of label 1 is learnt from the window that now scores highest (at
    first, by the words' log-odds), texts of label 0 from their highest and random windows. Log-odds that a text is
    trained with come from the other half of the texts. A fifth of the texts fits the final scale and shift. The number of steps is fixed. Without texts of both labels every
    score is ``share``.
    """
    net = Net(seed)
    share = float(np.clip(share, 1e-4, 1 - 1e-4))
    y = np.asarray(labels, np.float32)
    if not 0 < y.sum() < len(y) or min(y.sum(), len(y) - y.sum()) < 4:
        net.scale, net.shift = 0.0, float(np.log(share / (1 - share)))
        return net
    rng = np.random.default_rng(seed)
    words = Words(texts)
    n = len(texts)
    part = np.arange(n) % 2
    tables = [odds(words, y, part != k) for k in (0, 1)]
    fold = np.zeros(n, bool)
    for v in (0, 1):
        fold[np.flatnonzero(y == v)[::5]] = True  # for the scale
    text, first, size = windows(words.counts)

    def x_of(k):
        return net.inputs(words, *tables[k])

    def scores():
        z = np.zeros(len(text), np.float32)
        for k in (0, 1):
            pick = np.flatnonzero(part[text] == k)
            z[pick] = net.logits(x_of(k), words.ids, first[pick], size[pick])
        return z

    def top(z):
        order = np.lexsort((z, text))
        return order[np.append(np.flatnonzero(np.diff(text[order])), len(order) - 1)]

    cum = [np.concatenate([[0], np.cumsum(np.maximum(t[0][words.bucket][words.ids], 0) ** 2)]) if len(words.ids) else np.zeros(1) for t in tables]
    z = np.where(part[text] == 0, cum[0][first + size] - cum[0][first], cum[1][first + size] - cum[1][first])
    state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    for step in range(steps):
        if step % 100 == 0:
            best = top(z if step == 0 else scores())
            ones = best[(y[text[best]] == 1) & ~fold[text[best]]]
            hard = best[(y[text[best]] == 0) & ~fold[text[best]]]
            zeros = np.flatnonzero((y[text] == 0) & ~fold[text])
        k = step % 2  # one half's tables at a time
        one, two, three = (v[part[text[v]] == k] for v in (ones, hard, zeros))
        if not len(one) or not len(two):
            continue
        pick = np.concatenate([rng.choice(one, batch), rng.choice(two, batch // 2), rng.choice(three, batch - batch // 2)])
        index, mask = _index(words.ids, first[pick], size[pick], max(int(size[pick].max()), 1))
        used, local = np.unique(index, return_inverse=True)
        small = _Part(words, used)
        loss, g = net.gradients(net.inputs(small, *tables[k]), small, local.reshape(index.shape), mask, y[text[pick]])
        for name, grad in g.items():
            m, v = state[name]
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            net.p[name] -= (rate * (m / (1 - 0.9 ** (step + 1))) / (np.sqrt(v / (1 - 0.999 ** (step + 1))) + 1e-8)).astype(np.float32)
    z = scores()
    best = np.full(n, -np.inf)
    np.maximum.at(best, text, z)
    net.word_odds, net.gram_odds = odds(words, y, ~fold)
    _scale(net, best[fold], y[fold], share)
    return net


class _Part:
    """Some distinct words of ``words``, as far as ``inputs`` and ``gradients`` need them."""

    def __init__(self, words: Words, used: np.ndarray):
        per = np.bincount(words.of, minlength=len(words.bucket))
        start, n = (np.cumsum(per) - per)[used], per[used]
        at = np.repeat(start, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        self.bucket, self.size, self.gram, self.of = words.bucket[used], words.size[used], words.gram[at], np.repeat(np.arange(len(used)), n)

    pooled = Words.pooled


def _scale(net: Net, z: np.ndarray, y: np.ndarray, share: float) -> None:
    """Logistic scale and shift by Newton steps; labels weigh as in the whole, with a weak prior for scale 1."""
    weight = np.where(y == 1, share / max((y == 1).sum(), 1), (1 - share) / max((y == 0).sum(), 1)) * len(y)
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -40, 40)))
        r, h = weight * (p - y), weight * p * (1 - p) + 1e-9
        ga, gb = (r * z).sum() + (a - 1), r.sum()
        haa, hab, hbb = (h * z * z).sum() + 1, (h * z).sum(), h.sum() + 1e-6
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        size = max(1.0, abs(da), abs(db) / 2)
        a, b = a - da / size, b - db / size
    net.scale, net.shift = float(max(a, 0.05)), float(b)
