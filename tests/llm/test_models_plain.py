"""The models' arithmetic against plain versions written from their definitions."""

import math
import random

import numpy as np

from kempt.llm import gru, language, quality, secrets, toxicity


def plain_gru(inputs, u, reverse):
    """States of one sequence of gate pre-activations, unit by unit."""
    h = u.shape[0]
    sigmoid = lambda v: 1 / (1 + math.exp(-v))
    state, out = [0.0] * h, [None] * len(inputs)
    for t in (reversed(range(len(inputs))) if reverse else range(len(inputs))):
        g = [sum(state[i] * float(u[i, j]) for i in range(h)) for j in range(3 * h)]
        r = [sigmoid(inputs[t][j] + g[j]) for j in range(h)]
        z = [sigmoid(inputs[t][h + j] + g[h + j]) for j in range(h)]
        c = [math.tanh(inputs[t][2 * h + j] + r[j] * g[2 * h + j]) for j in range(h)]
        state = [z[j] * state[j] + (1 - z[j]) * c[j] for j in range(h)]
        out[t] = state
    return np.array(out)


def test_quality_equals_a_plain_discriminant(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, len(quality.NAMES))) @ rng.normal(size=(len(quality.NAMES),) * 2)
    y = (rng.random(400) < 0.3).astype(int)
    x[y == 1] += 1.5
    rows = [(int(label), *map(float, row)) for label, row in zip(y, x)]
    df = spark.createDataFrame(rows, "quality int, " + ", ".join(f"{n} double" for n in quality.NAMES))
    shrink, ridge = 0.3, 0.05
    model = quality.fit(df, shrink=shrink, ridge=ridge)
    covariances = [np.cov(x[y == k].T, bias=True) for k in (0, 1)]
    pooled = sum(c * (y == k).sum() for k, c in enumerate(covariances)) / len(y)
    spread = np.sqrt(np.diag(pooled))
    density = []
    for k in (0, 1):
        c = ((1 - shrink) * covariances[k] + shrink * pooled) / np.outer(spread, spread)
        c = c + ridge * np.trace(c) / len(c) * np.eye(len(c))
        d = (x - x[y == k].mean(0)) / spread
        mahalanobis = np.einsum("ni,ni->n", d, np.linalg.solve(c, d.T).T)
        density.append(math.log((y == k).mean()) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * mahalanobis)
    expected = 1 / (1 + np.exp(-np.clip(density[1] - density[0], -30, 30)))
    assert np.allclose(quality.score(model, x), expected, atol=1e-6)


def toxic_params(rng, hidden=3, dims=2):
    p = {"word": rng.normal(size=(toxicity.WORD_ROWS, dims)), "gram": rng.normal(size=(toxicity.GRAM_ROWS, dims)),
         "wf": rng.normal(size=(2 * dims, 3 * hidden)), "bf": rng.normal(size=3 * hidden), "wb": rng.normal(size=(2 * dims, 3 * hidden)),
         "bb": rng.normal(size=3 * hidden), "attend": rng.normal(size=2 * hidden), "out": rng.normal(size=2 * hidden), "bias": rng.normal(size=1)}
    return p | {"uf": gru.init(rng, hidden), "ub": gru.init(rng, hidden)}


def plain_window_logit(p, x):
    """Attention pooling over the states of one window of word inputs."""
    f, b = plain_gru(x @ p["wf"] + p["bf"], p["uf"], False), plain_gru(x @ p["wb"] + p["bb"], p["ub"], True)
    states = np.concatenate([f, b], axis=1)
    weight = np.exp(states @ p["attend"])
    return float((weight / weight.sum()) @ states @ p["out"] + p["bias"][0])


def test_toxicity_windows_equal_plain_attention():
    rng = np.random.default_rng(2)
    p = {k: v.astype(np.float32) for k, v in toxic_params(rng).items()}
    words = [f"word{rng.integers(40)}" for _ in range(70)]
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    number, bucket, gram, begin, first = toxicity.read_words(data, np.array([0, len(data)]))
    x = toxicity.word_inputs(p, bucket, gram, begin)
    for k in range(len(bucket)):  # a word's input: its embedding beside the mean of its trigrams'
        own = gram[begin[k]:begin[k + 1] if k + 1 < len(begin) else len(gram)]
        assert np.allclose(x[k], np.concatenate([p["word"][bucket[k]], p["gram"][own].mean(0)]), atol=1e-5)
    logits = [plain_window_logit(p, x[number[s:s + toxicity.WINDOW]].astype(float)) for s in (0, 16, 32, 48)]
    stats = toxicity._row_stats({"params": p}, number, bucket, gram, begin, first)
    assert np.allclose(stats[0], [max(logits), sum(logits) / len(logits)], atol=1e-3)


def test_toxicity_gradients_equal_differences():
    rng = np.random.default_rng(3)
    p = {k: v.astype(np.float64) for k, v in toxic_params(rng).items()}
    p |= {"uf": p["uf"].astype(np.float32), "ub": p["ub"].astype(np.float32)}
    x = rng.normal(size=(9, 4))
    index = np.where(np.arange(7) < rng.integers(1, 8, 5)[:, None], rng.integers(0, 9, (5, 7)), -1)  # padding at the end
    d = rng.normal(size=5).astype(np.float32)

    def loss():
        return float(toxicity._pooled_logit(p, toxicity._gates(p, x), index) @ d)

    _, kept = toxicity._pooled_logit(p, toxicity._gates(p, x), index, keep=True)
    grads, dx = toxicity._gradients(p, x, kept, d)
    for table, gradient in ((p["attend"], grads["attend"]), (p["out"], grads["out"]), (p["bias"], grads["bias"]), (x, dx), (p["wf"], grads["wf"])):
        for at in random.Random(1).sample(range(table.size), min(table.size, 5)):
            old, step = table.flat[at], 1e-2
            table.flat[at] = old + step
            high = loss()
            table.flat[at] = old - step
            low = loss()
            table.flat[at] = old
            assert abs((high - low) / (2 * step) - np.asarray(gradient).flat[at]) < 2e-2 + 0.02 * abs(np.asarray(gradient).flat[at])


def test_calibration_is_the_optimum():
    rng = np.random.default_rng(4)
    x, weight = rng.normal(size=(200, 2)), rng.uniform(0.5, 2, 200)
    y = (rng.random(200) < 1 / (1 + np.exp(-x[:, 0] * 2))).astype(float)
    w = toxicity._logistic(x, y, weight)
    q = 1 / (1 + np.exp(-(x @ w[:2] + w[2])))
    assert np.allclose(x.T @ (weight * (q - y)) + 1e-2 * w[:2], 0, atol=1e-5) and abs((weight * (q - y)).sum() + 1e-5 * w[2]) < 1e-5


def test_language_pools_plain_softmax_over_all_positions():
    rng = np.random.default_rng(5)
    h, names = 3, ["aa", "bb", "cc"]
    p = {"xf": rng.normal(size=(257, 3 * h)), "xb": rng.normal(size=(257, 3 * h)), "out": rng.normal(size=(2 * h, 3)), "bias": rng.normal(size=3)}
    p = {k: v.astype(np.float32) for k, v in p.items()} | {"uf": gru.init(rng, h), "ub": gru.init(rng, h)}
    texts = [b"a short one", "é long text ".encode() * 17, b"x" * language.SEGMENT, b""]
    offsets = np.cumsum([0] + [len(t) for t in texts])
    got = language.pooled({"names": names, "params": p}, np.frombuffer(b"".join(texts), np.uint8), offsets)
    for k, text in enumerate(texts):
        total = np.zeros(3)
        for s in range(0, len(text), language.SEGMENT):
            own = list(text[s:s + language.SEGMENT])
            padded = own + [256] * (language.SEGMENT - len(own))
            states = np.concatenate([plain_gru(p["xf"][padded], p["uf"], False), plain_gru(p["xb"][padded], p["ub"], True)], axis=1)
            logits = np.exp(states @ p["out"] + p["bias"])
            total += (logits / logits.sum(1, keepdims=True))[:len(own)].sum(0)
        assert np.allclose(got[k], total / max(len(text), 1), atol=1e-4)


def test_secret_network_is_a_plain_convolution():
    rng = np.random.default_rng(6)
    dims, filters, width = 2, 3, 5
    p = {"embed": rng.normal(size=(257, dims)), "conv": rng.normal(size=(width * (dims + 1), filters)), "conv_bias": rng.normal(size=filters),
         "out": rng.normal(size=2 * filters), "bias": rng.normal(size=1)}
    symbols = rng.integers(0, 257, (2, secrets._LENGTH)).astype(np.int16)
    inside = rng.random(symbols.shape) < 0.5
    got = secrets._network({k: v.astype(np.float32) for k, v in p.items()}, symbols, inside)
    for n in range(2):
        values = []
        for t in range(secrets._LENGTH - width + 1):
            window = np.concatenate([np.append(p["embed"][symbols[n, t + k]], float(inside[n, t + k])) for k in range(width)])
            values.append(np.maximum(window @ p["conv"] + p["conv_bias"], 0))
        pooled = np.concatenate([np.max(values, axis=0), np.mean(values, axis=0)])
        assert abs(got[n] - (pooled @ p["out"] + p["bias"][0])) < 1e-3


def row_major_network(x, u, mask, d_states):
    """Forward and backward pass with row-major arrays, one expression a line."""
    steps, n, h = len(x), x.shape[1], x.shape[2] // 3
    state, states, kept = np.zeros((n, h), np.float32), [], []
    for t in range(steps):
        g = state @ u
        gates = np.tanh((x[t, :, :2 * h] + g[:, :2 * h]) * np.float32(0.5))
        r, z = np.split((gates + np.float32(1)) * np.float32(0.5), 2, axis=1)
        c = np.tanh(r * g[:, 2 * h:] + x[t, :, 2 * h:])
        kept.append((state, r, z, c, g[:, 2 * h:]))
        state = ((state - c) * z + c) * mask[t][:, None]
        states.append(state)
    dx, du, carry = np.empty_like(x), np.zeros_like(u), np.zeros((n, h), np.float32)
    for t in range(steps - 1, -1, -1):
        state, r, z, c, gn = kept[t]
        d = (d_states[t] + carry) * mask[t][:, None]
        dn = d * (1 - z) * (1 - c * c)
        dr, dz = dn * gn * r * (1 - r), d * (state - c) * z * (1 - z)
        dx[t] = np.concatenate([dr, dz, dn], axis=1)
        dg = np.concatenate([dr, dz, dn * r], axis=1)
        du += state.T @ dg
        carry = d * z + dg @ u.T
    return np.array(states), dx, du


def test_gates_are_whole_rows_and_results_those_of_row_major_arrays():
    rng = np.random.default_rng(4)
    for n in (1, 77, 256):
        x = rng.standard_normal((6, n, 36)).astype(np.float32)
        u = gru.init(rng, 12)
        mask = (rng.random((6, n)) < 0.8).astype(np.float32)
        d = rng.standard_normal((6, n, 12)).astype(np.float32)
        states, kept = gru.forward(x, u, mask, False, keep=True)
        got = (states, *gru.backward(d, kept, u, mask, False))
        for a, b in zip(got, row_major_network(x, u, mask, d)):
            assert np.allclose(a, b, rtol=1e-5, atol=1e-6)
        # a column of row-major gates would cost numpy an inner loop for each sequence
        assert all(part.flags.c_contiguous for step in kept for part in step)


def test_rows_are_added_up_by_number():
    rng = np.random.default_rng(5)
    for top in (40, 70_000):
        at = rng.integers(-1, top, 500)
        rows = rng.standard_normal((500, 3)).astype(np.float32)
        table, expected = np.ones((top + 1, 3), np.float32), np.ones((top + 1, 3))
        toxicity._add_rows(table, at, rows)
        np.add.at(expected, at, rows)
        assert np.allclose(table, expected, atol=1e-5)


def test_chunks_of_a_table_step_as_the_whole():
    rng = np.random.default_rng(6)
    table = rng.standard_normal((3000, 12)).astype(np.float32)
    whole, parts = {"a": table.copy(), "b": np.ones(1, np.float32)}, [{"a": table[i:i + 1].copy()} for i in range(0, 3000, 500)]
    adam, others = gru.Adam(whole, 0.01), [gru.Adam(p, 0.01) for p in parts]
    for _ in range(3):
        g = rng.standard_normal(table.shape).astype(np.float32)
        adam.step({"a": g, "b": np.ones(1, np.float32)})
        for k, other in enumerate(others):
            other.step({"a": g[500 * k:500 * k + 1]})
    assert all(np.array_equal(whole["a"][500 * k], p["a"][0]) for k, p in enumerate(parts))
