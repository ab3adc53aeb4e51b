import numpy as np
import pytest

from tidewick.plans import regimes
from tidewick.schema import SERIES


def sequential(values, model, floor, rounds):
    """Baum and Welch by plain loops over the rows."""
    k, n = len(model.mean), len(values)
    for _ in range(rounds):
        density = np.exp(-(((values[:, None] - model.mean) / model.sd) ** 2) / 2) / (model.sd * np.sqrt(2 * np.pi))
        density[np.isnan(values)] = 1.0
        forward, scale = np.zeros((n, k)), np.zeros(n)
        for t in range(n):
            forward[t] = (model.start if t == 0 else forward[t - 1] @ model.step) * density[t]
            scale[t] = forward[t].sum()
            forward[t] /= scale[t]
        backward = np.ones((n, k))
        for t in range(n - 2, -1, -1):
            backward[t] = model.step @ (density[t + 1] * backward[t + 1])
            backward[t] /= backward[t].sum()
        state = forward * backward
        state /= state.sum(axis=1, keepdims=True)
        moves = np.zeros((k, k))
        for t in range(1, n):
            one = forward[t - 1][:, None] * model.step * (density[t] * backward[t])[None, :]
            moves += one / one.sum()
        known = ~np.isnan(values)
        weight = state[known].sum(axis=0)
        mean = (state[known] * values[known, None]).sum(axis=0) / weight
        variance = (state[known] * (values[known, None] - mean) ** 2).sum(axis=0) / weight
        model = regimes.Model(state[0], moves / moves.sum(axis=1, keepdims=True), mean, np.maximum(np.sqrt(variance), floor))
    return model, state, np.log(scale).sum()


def switching(n, seed):
    """Three levels that last, with noise that overlaps."""
    rng = np.random.default_rng(seed)
    state = [0]
    for _ in range(n - 1):
        state.append(state[-1] if rng.random() < 0.95 else int(rng.integers(3)))
    return np.array(state), np.array(state) * 2.0 + rng.normal(size=n) * 0.8


@pytest.mark.parametrize("cuts", [[], [1], [7, 8, 100], [50, 150, 299]])
def test_chunks_equal_a_sequential_loop(cuts):
    _, values = switching(300, 1)
    values[40] = np.nan
    model = regimes.first_model(np.nanmean(values), np.nanstd(values), 3)
    want, _, _ = sequential(values, model, 1e-6, 6)
    got = regimes.fit(np.split(values, cuts), model, 1e-6, rounds=6, tolerance=-np.inf)
    for a, b in zip(got, want, strict=True):
        assert np.allclose(a, b, atol=1e-9)
    _, state, total = sequential(values, want, 1e-6, 1)
    chunks = np.split(values, cuts)
    enter, leave, mine = regimes.carry([regimes.whole(v, want, i == 0) for i, v in enumerate(chunks)], want)
    assert np.isclose(mine, total, atol=1e-9)
    found = np.concatenate([regimes.posterior(v, want, i == 0, a, b)[0] for i, (v, a, b) in enumerate(zip(chunks, enter, leave))])
    assert np.allclose(found, state, atol=1e-9)


def test_regimes_last_and_are_found(spark):
    rows, truth = [], {}
    for exchange, seed, n in (("a", 2, 900), ("b", 3, 400)):
        state, values = switching(n, seed)
        rows += [(exchange, "p", 300, 300 * i, float(v)) for i, v in enumerate(values)]
        truth |= {(exchange, 300 * i): int(s) for i, s in enumerate(state)}
    rows += [("c", "p", 300, 300 * i, 5.0) for i in range(20)] + [("d", "p", 300, 0, None)]
    df = spark.createDataFrame(rows, "exchange string, trading_pair string, period int, timestamp long, v double")
    local = {(r.exchange, r.timestamp): r.state for r in regimes.regime_labels(df, "v", SERIES).collect()}
    assert len(local) == len(rows) and set(local.values()) <= {0, 1, 2}
    assert np.mean([local[x] == s for x, s in truth.items()]) > 0.93  # a mixture without transitions reaches about 0.85
    # the same by rounds over chunks
    spread = regimes.regime_labels(df, "v", SERIES, rounds=4, chunk_rows=64, local_rows=50)
    short = regimes.regime_labels(df, "v", SERIES, rounds=4)
    assert sorted(map(tuple, spread.select("exchange", "timestamp", "state").collect())) == sorted(map(tuple, short.select("exchange", "timestamp", "state").collect()))
    assert regimes.regime_labels(df.limit(0), "v", SERIES).count() == 0
