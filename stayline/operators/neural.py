"""Data-parallel feed-forward networks, restricted Boltzmann machines and deep belief nets.

Rows stay on the executors. A mini-batch is one Spark job: every task runs the forward and backward pass of
its Arrow batches in numpy and emits one partial row per row of weights, Spark adds the partials in levels, and only
weight-sized totals return. Random draws are a hash of (seed, epoch, row id, position), so a result does
not depend on partitioning and repeats when a task is retried.

Input frames have the columns ``id bigint, label array<double>, features array<double>``.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.functions.scalars import hash_number, share_limit
from stayline.operators.partials import summed
from stayline.session import scratch_path

# tasks get the functions of this module with their closure, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PARTIALS = "kind string, i int, j int, v double"


# ---- random draws ---------------------------------------------------------------------------------


def uniforms(ids: np.ndarray, width: int, *salt: int) -> np.ndarray:
    """len(ids) × width numbers in [0, 1), a function of row id, salt and position only."""

    def mix(z: np.ndarray) -> np.ndarray:  # splitmix64 finaliser
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))

    with np.errstate(over="ignore"):
        state = mix(np.asarray(ids, dtype=np.int64).astype(np.uint64))
        for s in salt:
            state = mix(state + np.uint64(s & 0xFFFFFFFFFFFFFFFF) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
        grid = state[:, None] + np.arange(1, width + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
        return (mix(grid) >> np.uint64(11)).astype(np.float64) / float(1 << 53)


# ---- partial sums over tasks ----------------------------------------------------------------------


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(rows, -1)


def _summed(df: DataFrame, work: Callable[[np.ndarray, np.ndarray, np.ndarray], dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """Add up the matrices that ``work(ids, labels, features)`` gives for each Arrow batch."""

    def of(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        n = batch.num_rows
        return work(batch.column(0).to_numpy(zero_copy_only=False), _matrix(batch.column(1), n), _matrix(batch.column(2), n))

    return summed(df.select("id", "label", "features"), of)


class Batches:
    """The rows cut into hash cells on shared storage; a mini-batch reads only its cells.

    Every epoch deals the cells to batches anew, so an epoch is a true partition of the rows and costs
    one scan in total instead of one scan per batch.
    """

    def __init__(self, df: DataFrame, batch_rows: int, seed: int, cells_per_batch: int = 4, folders: int = 1024):
        spark = df.sparkSession
        self.seed = seed
        rows = df.count()
        self.rows = rows
        self.count = max(1, rows // max(1, batch_rows))
        if self.count == 1:
            self.cells = 1
            self.frame = df.select("id", "label", "features").persist()
            return
        self.cells = self.count * cells_per_batch
        # cells share folders, so that their number has no bound; a batch reads its cells' folders and filters by cell
        self.folders = min(folders, self.cells)
        path = scratch_path(spark, "batches")
        cell = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(self.cells)).cast("int")
        staged = df.select("id", "label", "features", cell.alias("cell"), (cell % self.folders).alias("folder"))
        staged.repartition("folder").sortWithinPartitions("folder", "cell").write.partitionBy("folder").parquet(path)
        schema = staged.schema
        self.frame = spark.read.schema(schema).parquet(path)

    def batch(self, epoch: int, index: int) -> DataFrame:
        if self.cells == 1:
            return self.frame
        order = np.argsort(uniforms(np.arange(self.cells), 1, self.seed, epoch)[:, 0])
        mine = [int(c) for c in order[index :: self.count]]
        return self.frame.where(F.col("folder").isin(sorted({c % self.folders for c in mine}))).where(F.col("cell").isin(mine))

    def done(self) -> None:
        if self.cells == 1:
            self.frame.unpersist()


# ---- feed-forward network -------------------------------------------------------------------------


@dataclass(frozen=True)
class NetConfig:
    size: tuple[int, ...]  # layer widths, input first
    hidden: str = "scaled_tanh"  # sigmoid | scaled_tanh
    output: str = "sigmoid"  # sigmoid | linear
    rate: float = 2.0
    momentum: float = 0.5
    rate_decay: float = 1.0
    weight_penalty: float = 0.0  # L2
    sparsity_penalty: float = 0.0
    sparsity_target: float = 0.05
    input_zeroed: float = 0.0
    dropout: float = 0.0
    seed: int = 1
    legacy_penalty: bool = False  # take the L2 term from the gradient instead of the weights
    legacy_activation: bool = False  # running activation 0.01·new + 0.09·old


def backprop_preset(features: int, outputs: int = 1, rate: float = 0.1, seed: int = 1) -> NetConfig:
    """One hidden layer of ⌊√(features + 1)⌋ + 1 units, full batch, no momentum."""
    hidden = math.isqrt(features + 1) + 1
    return NetConfig((features, hidden, outputs), hidden="sigmoid", output="sigmoid", rate=rate, momentum=0.0, seed=seed)


def _sigm(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-z))


def _with_bias(a: np.ndarray) -> np.ndarray:
    return np.hstack([np.ones((a.shape[0], 1)), a])


def initial_weights(size: tuple[int, ...], seed: int) -> list[np.ndarray]:
    """(u - ½)·8·√(6 / (n_i + n_{i+1})), shape n_{i+1} × (n_i + 1), column 0 the bias."""
    out = []
    for i, (a, b) in enumerate(zip(size, size[1:])):
        u = uniforms(np.arange(b), a + 1, seed, 1000 + i)
        out.append((u - 0.5) * 8.0 * math.sqrt(6.0 / (a + b)))
    return out


def forward(x: np.ndarray, W: list[np.ndarray], cfg: NetConfig, ids: np.ndarray | None = None, epoch: int = 0) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Activations per layer (bias column in all but the last) and the dropout mask per hidden layer.

    With row ids this is a training pass (units dropped); without, an evaluation pass (units scaled by
    1 - dropout).
    """
    acts, masks = [_with_bias(x)], []
    for i, w in enumerate(W):
        z = acts[-1] @ w.T
        if i == len(W) - 1:
            acts.append(_sigm(z) if cfg.output == "sigmoid" else z)
            continue
        a = _sigm(z) if cfg.hidden == "sigmoid" else 1.7159 * np.tanh(z * (2.0 / 3.0))
        mask = np.ones_like(a)
        if cfg.dropout > 0:
            if ids is None:
                a = a * (1.0 - cfg.dropout)
            else:
                mask = (uniforms(ids, a.shape[1], cfg.seed, epoch, 2000 + i) > cfg.dropout).astype(float)
                a = a * mask
        masks.append(mask)
        acts.append(_with_bias(a))
    return acts, masks


def zero_inputs(x: np.ndarray, cfg: NetConfig, ids: np.ndarray, epoch: int) -> np.ndarray:
    if cfg.input_zeroed <= 0:
        return x
    return x * (uniforms(ids, x.shape[1], cfg.seed, epoch, 3000) >= cfg.input_zeroed)


def backward(y: np.ndarray, acts: list[np.ndarray], masks: list[np.ndarray], W: list[np.ndarray], cfg: NetConfig, running: list[np.ndarray] | None) -> list[np.ndarray]:
    """Gradient sums per weight matrix over the rows."""
    e = y - acts[-1]
    d = -e * acts[-1] * (1.0 - acts[-1]) if cfg.output == "sigmoid" else -e
    grads = [None] * len(W)
    for i in range(len(W) - 1, -1, -1):
        grads[i] = d.T @ acts[i]
        if i == 0:
            break
        back = d @ W[i]
        if running is not None and cfg.sparsity_penalty > 0:
            t, p = cfg.sparsity_target, running[i - 1]
            push = cfg.sparsity_penalty * (-t / p + (1.0 - t) / (1.0 - p))
            back = back + np.hstack([[0.0], push.ravel()])[None, :]
        a = acts[i]
        slope = a * (1.0 - a) if cfg.hidden == "sigmoid" else 1.7159 * (2.0 / 3.0) * (1.0 - (a / 1.7159) ** 2)
        d = (back * slope)[:, 1:] * masks[i - 1]
    return grads


@dataclass
class NetModel:
    config: NetConfig
    weights: list[np.ndarray]
    history: list[dict] = field(default_factory=list)  # per epoch: train and validation loss

    def predict(self, df: DataFrame, column: str = "prediction") -> DataFrame:
        """Add the output layer as an array column; rows keep all their columns."""
        W, cfg = self.weights, replace(self.config)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = batch.num_rows
                at = batch.schema.get_field_index("features")
                x = _matrix(batch.column(at), n) if n else np.zeros((0, cfg.size[0]))
                out = forward(x, W, cfg)[0][-1]
                predicted = pa.array(list(out), type=pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*batch.columns, predicted], [*batch.schema.names, column])

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        return df.mapInArrow(run, f"{schema}, `{column}` array<double>")

    def loss(self, df: DataFrame) -> float:
        return net_loss(df, self.config, self.weights)

    def weight_table(self, spark: SparkSession) -> DataFrame:
        return weights_to_table(spark, {f"w{i}": w for i, w in enumerate(self.weights)})

    def save(self, spark: SparkSession, path: str) -> None:
        self.weight_table(spark).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str, config: NetConfig) -> NetModel:
        named = table_to_weights(spark.read.parquet(path))
        return NetModel(config, [named[f"w{i}"] for i in range(len(named))])


def weights_to_table(spark: SparkSession, named: dict[str, np.ndarray]) -> DataFrame:
    """Weight matrices as one COO table (kind, i, j, v)."""
    rows = [(k, int(i), int(j), float(m[i, j])) for k, m in named.items() for i in range(m.shape[0]) for j in range(m.shape[1])]
    return spark.createDataFrame(rows, PARTIALS)


def table_to_weights(table: DataFrame) -> dict[str, np.ndarray]:
    out = {}
    for name, part in table.toPandas().groupby("kind"):
        m = np.zeros((part["i"].max() + 1, part["j"].max() + 1))
        m[part["i"], part["j"]] = part["v"]
        out[name] = m
    return out


def net_loss(df: DataFrame, cfg: NetConfig, W: list[np.ndarray]) -> float:
    """½·mean‖y - output‖² in evaluation mode."""

    def work(ids, y, x):
        e = y - forward(x, W, cfg)[0][-1]
        return {"sum": np.array([[float((e * e).sum()), float(len(ids))]])}

    total, n = _summed(df, work).get("sum", np.zeros((1, 2)))[0]
    return 0.5 * total / n if n else float("nan")


def net_gradient(df: DataFrame, cfg: NetConfig, W: list[np.ndarray], epoch: int = 0, running: list[np.ndarray] | None = None) -> tuple[list[np.ndarray], float, int]:
    """Mean gradient per weight matrix, ½·mean‖e‖² and the row count of one pass over the frame."""

    def work(ids, y, x):
        acts, masks = forward(zero_inputs(x, cfg, ids, epoch), W, cfg, ids, epoch)
        grads = backward(y, acts, masks, W, cfg, running)
        e = y - acts[-1]
        out = {f"w{i}": g for i, g in enumerate(grads)}
        out["sum"] = np.array([[float((e * e).sum()), float(len(ids))]])
        return out

    sums = _summed(df, work)
    if "sum" not in sums:
        return [np.zeros_like(w) for w in W], float("nan"), 0
    total, n = sums["sum"][0]
    return [sums[f"w{i}"] / n for i in range(len(W))], 0.5 * total / n, int(n)


def _mean_activation(df: DataFrame, cfg: NetConfig, W: list[np.ndarray], epoch: int) -> list[np.ndarray]:
    def work(ids, y, x):
        acts, _ = forward(zero_inputs(x, cfg, ids, epoch), W, cfg, ids, epoch)
        out = {f"p{i}": a[:, 1:].sum(axis=0, keepdims=True) for i, a in enumerate(acts[1:-1])}
        out["sum"] = np.array([[float(len(ids))]])
        return out

    sums = _summed(df, work)
    return [sums[f"p{i}"] / sums["sum"][0, 0] for i in range(len(W) - 1)]


def apply_step(W: list[np.ndarray], V: list[np.ndarray], grads: list[np.ndarray], cfg: NetConfig, rate: float) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """g = rate·(∂W + L2); with momentum g += μ·v and v = g; W -= g. The bias column is not penalised."""
    new_w, new_v = [], []
    for w, v, g in zip(W, V, grads):
        penalty = np.zeros_like(w)
        if cfg.weight_penalty > 0:
            penalty[:, 1:] = (g if cfg.legacy_penalty else w)[:, 1:] * cfg.weight_penalty
        move = rate * (g + penalty)
        if cfg.momentum > 0:
            move = move + cfg.momentum * v
            v = move
        new_w.append(w - move)
        new_v.append(v)
    return new_w, new_v


def net_train(df: DataFrame, cfg: NetConfig, batch_rows: int, epochs: int, validation: float = 0.0, initial: list[np.ndarray] | None = None, stop_loss: float | None = None) -> NetModel:
    """Mini-batch gradient descent; ``validation`` is the share of rows held out by hash of the id."""
    W = [np.array(w, dtype=float) for w in (initial or initial_weights(cfg.size, cfg.seed))]
    V = [np.zeros_like(w) for w in W]
    held = hash_number("id", cfg.seed) < share_limit(validation)
    train, valid = (df.where(~held), df.where(held).persist()) if validation > 0 else (df, None)
    batches = Batches(train, batch_rows, cfg.seed)
    running = [np.zeros((1, n)) for n in cfg.size[1:-1]]
    rate, history = cfg.rate, []
    for epoch in range(epochs):
        for index in range(batches.count):
            part = batches.batch(epoch, index)
            use = None
            if cfg.sparsity_penalty > 0:
                keep = 0.09 if cfg.legacy_activation else 0.99
                running = [0.01 * m + keep * p for m, p in zip(_mean_activation(part, cfg, W, epoch), running)]
                use = running
            grads, _, n = net_gradient(part, cfg, W, epoch, use)
            if n:
                W, V = apply_step(W, V, grads, cfg, rate)
        report = {"epoch": epoch + 1, "train": net_loss(batches.frame, cfg, W)}
        if valid is not None:
            report["validation"] = net_loss(valid, cfg, W)
        history.append(report)
        rate *= cfg.rate_decay
        if stop_loss is not None and report["train"] <= stop_loss:
            break
    batches.done()
    if valid is not None:
        valid.unpersist()
    return NetModel(cfg, W, history)


# ---- restricted Boltzmann machines and deep belief nets -------------------------------------------


@dataclass
class Rbm:
    W: np.ndarray  # hidden × visible
    b: np.ndarray  # visible bias
    c: np.ndarray  # hidden bias
    errors: list[float] = field(default_factory=list)  # mean ‖v1 - v2‖² per mini-batch


def rbm_train(df: DataFrame, hidden: int, batch_rows: int, epochs: int, momentum: float = 0.0, alpha: float = 1.0, seed: int = 1, below: list[Rbm] | None = None) -> Rbm:
    """One step of contrastive divergence per mini-batch; weights start at 0.

    ``below`` are trained layers the features pass through first. One job per mini-batch emits all four sums
    from the same draws.
    """
    below = below or []
    width = below[-1].c.size if below else len(df.select("features").first()[0])
    W, b, c = np.zeros((hidden, width)), np.zeros(width), np.zeros(hidden)
    vW, vb, vc = np.zeros_like(W), np.zeros_like(b), np.zeros_like(c)
    batches = Batches(df, batch_rows, seed)
    errors: list[float] = []
    for epoch in range(epochs):
        for index in range(batches.count):

            def work(ids, y, x, W=W, b=b, c=c, epoch=epoch):
                v1 = x
                for layer in below:
                    v1 = _sigm(v1 @ layer.W.T + layer.c)
                h1 = (_sigm(v1 @ W.T + c) > uniforms(ids, hidden, seed, epoch, len(below), 1)).astype(float)
                v2 = (_sigm(h1 @ W + b) > uniforms(ids, width, seed, epoch, len(below), 2)).astype(float)
                h2 = _sigm(v2 @ W.T + c)
                return {
                    "W": h1.T @ v1 - h2.T @ v2,
                    "b": (v1 - v2).sum(axis=0, keepdims=True),
                    "c": (h1 - h2).sum(axis=0, keepdims=True),
                    "sum": np.array([[float(((v1 - v2) ** 2).sum()), float(len(ids))]]),
                }

            sums = _summed(batches.batch(epoch, index), work)
            if "sum" not in sums:
                continue
            total, n = sums["sum"][0]
            vW = momentum * vW + alpha * sums["W"] / n
            vb = momentum * vb + alpha * sums["b"][0] / n
            vc = momentum * vc + alpha * sums["c"][0] / n
            W, b, c = W + vW, b + vb, c + vc
            errors.append(total / n)
    batches.done()
    return Rbm(W, b, c, errors)


def dbn_train(df: DataFrame, hidden: list[int], batch_rows: int, epochs: int, momentum: float = 0.0, alpha: float = 1.0, seed: int = 1) -> list[Rbm]:
    """Stacked machines; each layer trains on the hidden probabilities of the layers below."""
    layers: list[Rbm] = []
    for size in hidden:
        layers.append(rbm_train(df, size, batch_rows, epochs, momentum, alpha, seed, below=list(layers)))
    return layers


def dbn_to_net(layers: list[Rbm], outputs: int = 0, seed: int = 1, **options) -> tuple[NetConfig, list[np.ndarray]]:
    """[c | W] per layer as start weights of a network; ``outputs`` appends a randomly started layer."""
    weights = [np.hstack([layer.c[:, None], layer.W]) for layer in layers]
    size = [layers[0].W.shape[1], *[layer.W.shape[0] for layer in layers]]
    if outputs > 0:
        weights.append(initial_weights((size[-1], outputs), seed)[0])
        size.append(outputs)
    return NetConfig(tuple(size), hidden="sigmoid", seed=seed, **options), weights
