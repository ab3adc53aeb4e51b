"""Regimes of a series: a hidden Markov model with Gaussian states, fitted by Baum and Welch.

A row's step, transition times density, is a k x k matrix, and forward and backward probabilities are products of them.
Products are associative, so a chunk of a series is one matrix: chunks are multiplied out in their own tasks, one row per
chunk is carried across the series to give what enters and leaves each chunk, and the sums that Baum and Welch need are then
made chunk by chunk and added up.  Within a chunk the products up to every row come from a doubling scan, normalised
on the way.  Results do not depend on where chunks are cut.

A series of up to ``local_rows`` rows is fitted to its tolerance in one task; longer ones share rounds, two passes each,
until all of them are done.
"""

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewick.session import join_small, materialise

CHUNK_ROWS = 8192
LOCAL_ROWS = 65_536
ROUNDS = 200
TOLERANCE = 1e-6  # of the mean log likelihood of a row


class Model(NamedTuple):
    start: np.ndarray
    step: np.ndarray
    mean: np.ndarray
    sd: np.ndarray

    def flat(self) -> list[float]:
        return np.concatenate([x.ravel() for x in self]).tolist()

    @classmethod
    def of(cls, flat: Sequence[float], k: int) -> "Model":
        flat = np.asarray(flat, float)
        return cls(flat[:k], flat[k : k + k * k].reshape(k, k), flat[k + k * k : 2 * k + k * k], flat[2 * k + k * k :])


def first_model(mean: float, sd: float, k: int) -> Model:
    """States spread one deviation around the mean, mostly staying as they are."""
    spread = 2.0 * np.arange(k) / max(k - 1, 1) - 1.0
    step = np.full((k, k), 0.2 / max(k - 1, 1))
    np.fill_diagonal(step, 0.8 if k > 1 else 1.0)
    return Model(np.full(k, 1.0 / k), step, mean + sd * spread, np.full(k, sd))


def steps(values: np.ndarray, model: Model, begins: bool) -> tuple[np.ndarray, float]:
    """The matrix of every row and the logarithm taken out of them; a missing value says nothing about the state."""
    z = (values[:, None] - model.mean) / model.sd
    logs = np.where(np.isnan(values)[:, None], 0.0, -z * z / 2 - np.log(model.sd) - 0.5 * np.log(2 * np.pi))
    top = logs.max(axis=1)
    density = np.exp(logs - top[:, None])
    out = model.step * density[:, None, :]
    if begins:
        out[0] = np.eye(len(model.mean)) * density[0]
    return out, float(top.sum())


def products(matrices: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The product up to every row, each scaled to sum 1, and the logarithms of the scales."""
    out = matrices.copy()
    logs = np.zeros(len(out))
    reach = 1
    while True:
        total = out.sum(axis=(1, 2))
        out /= total[:, None, None]
        logs += np.log(total)
        if reach >= len(out):
            return out, logs
        later = out[:-reach] @ out[reach:]
        logs = np.concatenate([logs[:reach], logs[:-reach] + logs[reach:]])
        out = np.concatenate([out[:reach], later])
        reach *= 2


def whole(values: np.ndarray, model: Model, begins: bool) -> tuple[np.ndarray, float]:
    """One matrix of a chunk and its logarithm."""
    matrices, log = steps(values, model, begins)
    found, logs = products(matrices)
    return found[-1], log + float(logs[-1])


def carry(chunks: Sequence[tuple[np.ndarray, float]], model: Model) -> tuple[list[np.ndarray], list[np.ndarray], float]:
    """What enters and what leaves every chunk of a series in order, and the log likelihood."""
    enter, total = [model.start], 0.0
    for matrix, log in chunks:
        after = enter[-1] @ matrix
        total += log + float(np.log(after.sum()))
        enter.append(after / after.sum())
    leave = [np.ones(len(model.start))]
    for matrix, _ in reversed(chunks[1:]):
        before = matrix @ leave[-1]
        leave.append(before / before.sum())
    return enter[:-1], leave[::-1], total


def posterior(values: np.ndarray, model: Model, begins: bool, enter: np.ndarray, leave: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's state probabilities, and the expected steps from state to state."""
    matrices, _ = steps(values, model, begins)
    ahead, _ = products(matrices)
    forward = enter @ ahead
    forward /= forward.sum(axis=1, keepdims=True)
    behind, _ = products(matrices[:0:-1].transpose(0, 2, 1)) if len(values) > 1 else (matrices[:0], None)
    backward = np.concatenate([(leave @ behind)[::-1], leave[None, :]])
    backward /= backward.sum(axis=1, keepdims=True)
    state = forward * backward
    state /= state.sum(axis=1, keepdims=True)
    before = np.concatenate([enter[None, :], forward[:-1]])
    moves = before[:, :, None] * matrices * backward[:, None, :]
    moves /= moves.sum(axis=(1, 2), keepdims=True)
    return state, moves[1 if begins else 0 :].sum(axis=0)


def sums(values: np.ndarray, model: Model, begins: bool, enter: np.ndarray, leave: np.ndarray) -> np.ndarray:
    """What a chunk adds to the next model: start, steps, weights, and first and second moments around the old means."""
    state, moves = posterior(values, model, begins, enter, leave)
    known = ~np.isnan(values)
    apart = np.where(known[:, None], values[:, None] - model.mean, 0.0)
    weight = state * known[:, None]
    first = state[0] if begins else np.zeros(len(model.mean))
    return np.concatenate([first, moves.ravel(), weight.sum(axis=0), (weight * apart).sum(axis=0), (weight * apart * apart).sum(axis=0)])


def next_model(added: np.ndarray, model: Model, floor: float) -> Model:
    k = len(model.mean)
    first, moves = added[:k], added[k : k + k * k].reshape(k, k)
    weight, moved, square = added[k + k * k :].reshape(3, k)
    weight = np.maximum(weight, 1e-12)
    shift = moved / weight
    total = moves.sum(axis=1, keepdims=True)
    step = np.where(total > 0, moves / np.maximum(total, 1e-300), model.step)
    step = np.maximum(step, 1e-12)
    sd = np.sqrt(np.maximum(square / weight - shift * shift, 0.0))
    start = np.maximum(first, 1e-12)
    return Model(start / start.sum(), step / step.sum(axis=1, keepdims=True), model.mean + shift, np.maximum(sd, floor))


def fit(chunks: Sequence[np.ndarray], model: Model, floor: float, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> Model:
    """Baum and Welch on one series, given in chunks, until the likelihood of a row gains less than the tolerance."""
    n, last = sum(map(len, chunks)), -np.inf
    for _ in range(rounds):
        enter, leave, total = carry([whole(v, model, i == 0) for i, v in enumerate(chunks)], model)
        if total - last <= tolerance * n:
            break
        last = total
        added = sum(sums(v, model, i == 0, a, b) for i, (v, a, b) in enumerate(zip(chunks, enter, leave, strict=True)))
        model = next_model(added, model, floor)
    return model


def _states(chunks: Sequence[np.ndarray], model: Model) -> list[np.ndarray]:
    """The likeliest state of each row, states in order of their means."""
    rank = np.argsort(np.argsort(model.mean, kind="stable"))
    enter, leave, _ = carry([whole(v, model, i == 0) for i, v in enumerate(chunks)], model)
    return [
        rank[posterior(v, model, i == 0, a, b)[0].argmax(axis=1)].astype(np.int32)
        for i, (v, a, b) in enumerate(zip(chunks, enter, leave, strict=True))
    ]


# --- the same on DataFrames ------------------------------------------------------------------


def _blocks(values: DataFrame, column: str, keys: list[str], chunk_rows: int) -> DataFrame:
    """Chunks of a series as bytes, in order of time; the earliest of each series is marked."""
    d = values.select(
        *keys, F.expr(f"timestamp div (period * {chunk_rows}L)").alias("_chunk"), F.col("timestamp").cast("long").alias("_t"), F.col(column).cast("double").alias("_v")
    )

    def pack(table: pa.Table) -> pa.Table:
        at = table.column("_t").to_numpy()
        order = np.argsort(at, kind="stable")
        v = table.column("_v").to_numpy(zero_copy_only=False).astype(float)[order]
        return pa.table({
            **{k: table.column(k).slice(0, 1) for k in [*keys, "_chunk"]}, "n": pa.array([len(v)], pa.int64()),
            "times": [at[order].astype(np.int64).tobytes()], "values": [v.tobytes()],
        })

    schema = T.StructType([*[values.schema[k] for k in keys], *T.StructType.fromDDL("_chunk long, n long, times binary, values binary").fields])
    found = materialise(d.groupBy(*keys, "_chunk").applyInArrow(pack, schema), "regimes")
    size = found.groupBy(*keys).agg(F.sum("n").alias("_n"), F.min("_chunk").alias("_first"))
    return join_small(found, size, keys, salt_by="_chunk").withColumn("begins", F.col("_chunk") == F.col("_first"))


def _read(cell: pa.Scalar, kind: type) -> np.ndarray:
    return np.frombuffer(cell.as_py(), kind)


def _labels(keys: Sequence[str], column: str, parts: list[tuple]) -> pa.Table:
    """(key arrays of one row, times, values, states) of chunks as rows."""
    return pa.concat_tables([
        pa.table([*[pa.repeat(k, len(t)) for k in names], pa.array(t), pa.array(v, from_pandas=True), pa.array(s)], names=[*keys, "timestamp", column, "state"])
        for names, t, v, s in parts
    ])


def regime_labels(
    values: DataFrame, column: str, keys: Sequence[str], k: int = 3, rounds: int = ROUNDS, tolerance: float = TOLERANCE,
    chunk_rows: int = CHUNK_ROWS, local_rows: int = LOCAL_ROWS,
) -> DataFrame:
    """``state`` 0 .. k - 1 of each row (keys, timestamp, ``column``): the likeliest given its whole series, by ascending mean.

    Rows without a value are labelled by their neighbours.
    """
    keys = list(keys)
    blocks = _blocks(values, column, keys, chunk_rows)
    stats = values.groupBy(*keys).agg(F.avg(F.col(column).cast("double")).alias("_m"), F.stddev_pop(F.col(column).cast("double")).alias("_s"))
    stats = stats.select(*keys, F.coalesce("_m", F.lit(0.0)).alias("_m"), F.greatest(F.coalesce("_s", F.lit(0.0)), F.lit(1e-9)).alias("_s"))
    sized = materialise(join_small(blocks, stats, keys, salt_by="_chunk"), "regimes")
    schema = T.StructType([*[values.schema[c] for c in keys], *T.StructType.fromDDL(f"timestamp long, `{column}` double, state int").fields])

    def local(table: pa.Table) -> pa.Table:
        table = table.sort_by("_chunk")
        chunks = [_read(c, float) for c in table.column("values")]
        sd = table.column("_s")[0].as_py()
        model = fit(chunks, first_model(table.column("_m")[0].as_py(), sd, k), sd * 1e-3, rounds, tolerance)
        names = [table.column(c)[0] for c in keys]
        return _labels(keys, column, [(names, _read(t, np.int64), v, s) for t, v, s in zip(table.column("times"), chunks, _states(chunks, model), strict=True)])

    out = sized.where(F.col("_n") <= local_rows).groupBy(*keys).applyInArrow(local, schema)
    long = sized.where(F.col("_n") > local_rows)
    if long.take(1):
        out = out.unionByName(_long_labels(long, column, keys, k, rounds, tolerance, schema))
    return out


def _long_labels(long: DataFrame, column: str, keys: list[str], k: int, rounds: int, tolerance: float, schema: T.StructType) -> DataFrame:
    """The same for series of many chunks: rounds of two passes over all of them."""
    key_fields = [long.schema[c] for c in keys]

    def typed(ddl: str) -> T.StructType:
        return T.StructType([*key_fields, *T.StructType.fromDDL(ddl).fields])

    def multiplied(batches):
        for batch in batches:
            found = [
                whole(_read(v, float), Model.of(m.as_py(), k), b.as_py())
                for v, m, b in zip(batch.column("values"), batch.column("model"), batch.column("begins"), strict=True)
            ]
            lists = [pa.array([m.ravel().tolist() for m, _ in found], pa.list_(pa.float64())), pa.array([x for _, x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in [*keys, "_chunk", "model"]], *lists], names=[*keys, "_chunk", "model", "matrix", "log"])

    def carried(table: pa.Table) -> pa.Table:
        table = table.sort_by("_chunk")
        chunks = [(np.array(m.as_py()).reshape(k, k), x.as_py()) for m, x in zip(table.column("matrix"), table.column("log"), strict=True)]
        enter, leave, total = carry(chunks, Model.of(table.column("model")[0].as_py(), k))
        more = {"enter": pa.array([e.tolist() for e in enter]), "leave": pa.array([e.tolist() for e in leave]), "total": pa.array([total] * len(chunks))}
        return pa.table({**{c: table.column(c) for c in [*keys, "_chunk"]}, **more})

    def cells(batch, *names):
        return zip(*[batch.column(n) for n in names], strict=True)

    def added(batches):
        for batch in batches:
            found = [
                sums(_read(v, float), Model.of(m.as_py(), k), b.as_py(), np.array(e.as_py()), np.array(x.as_py())).tolist()
                for v, m, b, e, x in cells(batch, "values", "model", "begins", "enter", "leave")
            ]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in [*keys, "model", "total", "_s", "n"]], pa.array(found, pa.list_(pa.float64()))],
                names=[*keys, "model", "total", "_s", "n", "added"],
            )

    def updated(table: pa.Table) -> pa.Table:
        model = Model.of(table.column("model")[0].as_py(), k)
        whole_sum = np.sum([a.as_py() for a in table.column("added")], axis=0)
        new = next_model(whole_sum, model, table.column("_s")[0].as_py() * 1e-3)
        more = {"model": pa.array([new.flat()]), "total": table.column("total").slice(0, 1), "rows": pa.array([sum(table.column("n").to_pylist())])}
        return pa.table({**{c: table.column(c).slice(0, 1) for c in keys}, **more})

    def labelled(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                v, t, m, b, e, x = (batch.column(c)[i] for c in ("values", "times", "model", "begins", "enter", "leave"))
                model, v = Model.of(m.as_py(), k), _read(v, float)
                rank = np.argsort(np.argsort(model.mean, kind="stable"))
                state = posterior(v, model, b.as_py(), np.array(e.as_py()), np.array(x.as_py()))[0].argmax(axis=1)
                names = [batch.column(c)[i] for c in keys]
                yield from _labels(keys, column, [(names, _read(t, np.int64), v, rank[state].astype(np.int32))]).to_batches()

    def carry_all(models: DataFrame) -> DataFrame:
        """All chunks with their series' model and what enters and leaves them."""
        met = join_small(long, models, keys, salt_by="_chunk")
        matrices = met.mapInArrow(multiplied, typed("_chunk long, model array<double>, matrix array<double>, log double"))
        across = matrices.groupBy(*keys).applyInArrow(carried, typed("_chunk long, enter array<double>, leave array<double>, total double"))
        return met.join(across, [*keys, "_chunk"])

    start = long.select(*keys, "_m", "_s").distinct()

    def begun(batches):
        for batch in batches:
            models = [first_model(m.as_py(), s.as_py(), k).flat() for m, s in cells(batch, "_m", "_s")]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keys], pa.array(models, pa.list_(pa.float64()))], names=[*keys, "model"])

    models = materialise(start.mapInArrow(begun, typed("model array<double>")), "models")
    # a series stays at the model whose likelihood no longer gains; the others go on
    open_models, last = models, None
    settled = []
    for _ in range(rounds):
        passes = carry_all(open_models).mapInArrow(added, typed("model array<double>, total double, _s double, n long, added array<double>"))
        step = materialise(passes.groupBy(*keys).applyInArrow(updated, typed("model array<double>, total double, rows long")), "models")
        if last is not None:
            gained = step.join(last.select(*keys, F.col("total").alias("_before")), keys)
            stays = F.col("total") - F.col("_before") <= tolerance * F.col("rows")
            settled.append(open_models.join(gained.where(stays).select(*keys), keys, "left_semi"))
            step = materialise(gained.where(~stays).drop("_before"), "models")
        open_models, last = step.select(*keys, "model"), step
        if not step.take(1):
            break
    final = open_models
    for part in settled:
        final = final.unionByName(part)
    return carry_all(materialise(final, "models")).mapInArrow(labelled, schema)
