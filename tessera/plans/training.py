"""Data-parallel training of layer-list networks (CNN and MLP) on Spark.

Two execution modes:

* ``sync`` — synchronous gradient steps. Batches are exact consecutive slices of a seeded
  per-epoch permutation (a distributed rank), so ``batch_size`` means what it means in the
  reference; ``batch_size=None`` is one full-batch step per epoch.
* ``replicas`` — ``replicas`` copies of the model each take every ``replicas``-th of the same
  batches, in order, with their own weights and optimizer state. After the epoch weights and state
  are averaged by rows. The copies follow the seeded order alone, so results do not depend on cores
  or partitions; one copy is plain mini-batch training.

A batch of more than ``STEP_BYTES`` is spread over all tasks, and each step (of all copies) is one
Spark job: every partition runs forward + backward on its rows of the batch (Arrow batches, NumPy)
and emits one gradient-sum row; the rows are added on executors in groups of ``FAN_IN`` until at
most ``FAN_IN`` are left, which the driver adds before it applies the optimizer. For smaller batches
a job and its gradients cost more than the step: the epoch's batches are cut into runs of at most
``RUN_BYTES`` per copy, in order, and one Spark job takes every copy through a run, a
task a copy. A task streams its batches one after the other, steps at each, and returns its model and
optimizer state, with which the next run begins. So jobs and what the driver receives grow with
the bytes of the data, not with the number of steps, and no task holds more than a run.

After each epoch one scoring job measures loss and accuracy on the train and validation sets
(the learning curves). The model, the optimizer state and the curves live on the driver:
they are model-sized, never data-sized.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.splits import assign_batches
from ..session import ship_package
from . import kernels as K
from .scoring import arrow_list, arrow_matrix, check_model_size

FAN_IN = 32  # gradient rows added by one task or by the driver
STEP_BYTES = 4 << 20  # packed rows of a batch that one task steps through by itself
RUN_BYTES = 64 << 20  # packed rows of a copy's batches that one task steps through
STEP_ROWS = 512  # rows of such a batch in one forward and backward pass


@dataclass
class TrainConfig:
    epochs: int = 10
    batch_size: int | None = None
    batches_per_epoch: int | None = None  # alternative to batch_size: ceil(rows / batches) rows each
    optimizer: str = "sgd"  # sgd | momentum | adam
    learning_rate: float = 0.01
    lam: float = 0.0
    reduce: str = "sum"  # 'sum' (CNN layers sum over the batch) | 'mean' (MLP divides by m)
    l2: str = "decay"  # 'decay': W -= lr(dW + λW) | 'scaled': dW += λW/m before the step
    mode: str = "sync"  # sync | replicas
    replicas: int = 8  # model copies in 'replicas' mode
    eps_mode: str = "clip"  # loss clipping: 'clip' (CNN) | 'add' (MLP)
    gamma: float = 0.9
    beta1: float = 0.9
    beta2: float = 0.999
    epsilon: float = 1e-8
    seed: int = 42

    def __post_init__(self):
        if self.optimizer not in ("sgd", "momentum", "adam"):
            raise ValueError("optimizer must be sgd, momentum or adam")
        if self.mode not in ("sync", "replicas") or self.replicas < 1:
            raise ValueError("mode must be sync or replicas, with at least one replica")
        if self.reduce not in ("sum", "mean") or self.l2 not in ("decay", "scaled"):
            raise ValueError("reduce must be sum|mean and l2 decay|scaled")
        if self.learning_rate <= 0 or self.epochs <= 0 or self.lam < 0:
            raise ValueError("learning rate and epochs must be positive, lambda non-negative")
        if self.batch_size is not None and self.batch_size <= 0:
            raise ValueError("batch_size must be positive")
        if self.batches_per_epoch is not None and (self.batches_per_epoch <= 0 or self.batch_size is not None):
            raise ValueError("batches_per_epoch must be positive and excludes batch_size")


def cnn_config(**kw) -> TrainConfig:
    """Reference CNN semantics: summed gradients, per-layer optimizer, λ only in SGD."""
    return TrainConfig(**{"reduce": "sum", "l2": "decay", "eps_mode": "clip", **kw})


def mlp_config(**kw) -> TrainConfig:
    """Reference MLP semantics: mean gradient + λW/m, plain SGD step."""
    return TrainConfig(**{"reduce": "mean", "l2": "scaled", "eps_mode": "add", "optimizer": "sgd", **kw})


# ----------------------------------------------------------------------------- optimizer
def weight_mask(params) -> np.ndarray:
    parts = [np.concatenate([np.ones(p["W"].size), np.zeros(p["b"].size)]) for p in params if p is not None]
    return np.concatenate(parts) if parts else np.zeros(0)


class Optimizer:
    """SGD (+L2), Momentum and Adam over the flat parameter vector (state kept with it)."""

    def __init__(self, cfg: TrainConfig, size: int, wmask: np.ndarray):
        self.cfg, self.wmask = cfg, wmask
        self.m = np.zeros(size)
        self.v = np.zeros(size)
        self.t = 0

    def state(self) -> dict:
        return {"m": self.m, "v": self.v, "t": self.t}

    def load(self, st: dict) -> None:
        self.m, self.v, self.t = st["m"], st["v"], st["t"]

    def step(self, theta: np.ndarray, grad_sum: np.ndarray, m_rows: int) -> np.ndarray:
        c = self.cfg
        g = grad_sum / m_rows if c.reduce == "mean" else grad_sum
        if c.l2 == "scaled" and c.lam:
            g = g + c.lam * theta * self.wmask / m_rows
        if c.optimizer == "sgd":
            upd = g + c.lam * theta * self.wmask if (c.l2 == "decay" and c.lam) else g
            return theta - c.learning_rate * upd
        if c.optimizer == "momentum":
            self.v = c.gamma * self.v + c.learning_rate * g
            return theta - self.v
        self.t += 1
        self.m = c.beta1 * self.m + (1 - c.beta1) * g
        self.v = c.beta2 * self.v + (1 - c.beta2) * g * g
        mh = self.m / (1 - c.beta1 ** self.t)
        vh = self.v / (1 - c.beta2 ** self.t)
        return theta - c.learning_rate * mh / (np.sqrt(vh) + c.epsilon)


# ----------------------------------------------------------------------------- jobs
_GRAD_SCHEMA = "replica int, part bigint, n bigint, loss double, correct bigint, grad array<double>"


def _shape_x(x: np.ndarray, in_shape: tuple) -> np.ndarray:
    return x.reshape((-1,) + tuple(in_shape))


def _labels(rb: pa.RecordBatch, col: str) -> np.ndarray:
    return rb.column(rb.schema.get_field_index(col)).to_numpy(zero_copy_only=False).astype(np.int64)


def gradient_rows(df: DataFrame, layers, copies: list, in_shape, n_classes, eps_mode, data_col="data", label_col="label",
                  broadcasts: list | None = None) -> DataFrame:
    """One row per partition and model copy: (replica, part, rows, loss sum, correct, gradient sum).

    ``copies`` holds one parameter list per model copy; with more than one, column ``replica`` of
    ``df`` says which copy a row trains. The broadcast is appended to ``broadcasts`` so the caller can
    release it once the step has run."""
    ship_package(df.sparkSession)
    bc = df.sparkSession.sparkContext.broadcast((layers, copies))
    if broadcasts is not None:
        broadcasts.append(bc)
    width = int(np.prod(in_shape))
    several = len(copies) > 1

    def run(batches):
        from pyspark import TaskContext

        lys, cps = bc.value
        sums: dict[int, list] = {}
        for rb in batches:
            if rb.num_rows == 0:
                continue
            x = _shape_x(arrow_matrix(rb, data_col, width), in_shape)
            y = _labels(rb, label_col)
            copy = _labels(rb, "replica") if several else np.zeros(len(y), np.int64)
            for r in np.unique(copy).tolist():
                at = copy == r
                flat, ls, cr = K.batch_gradients(x[at], y[at], lys, cps[r], n_classes, eps_mode)
                n, loss, correct, acc = sums.get(r, (0, 0.0, 0, 0.0))
                sums[r] = [n + int(at.sum()), loss + ls, correct + cr, acc + flat]
        part = TaskContext.get().partitionId()
        for r, (n, loss, correct, acc) in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([r], pa.int32()), pa.array([part], pa.int64()), pa.array([n], pa.int64()), pa.array([loss]),
                 pa.array([correct], pa.int64()), arrow_list(acc[None, :])],
                names=["replica", "part", "n", "loss", "correct", "grad"],
            )

    return df.select(label_col, data_col, *(["replica"] if several else [])).mapInArrow(run, _GRAD_SCHEMA)


def _vectors(table: pa.Table, col: str, size: int) -> np.ndarray:
    """A list<double> column of a collected Arrow table → (rows, size) matrix, no Python lists."""
    arr = table.column(col).combine_chunks()
    if len(arr) == 0:
        return np.zeros((0, size))
    offs = arr.offsets.to_numpy()
    return arr.values.to_numpy(zero_copy_only=False)[offs[0]:offs[-1]].reshape(len(arr), size)


def _sum_partials(rows: DataFrame, size: int, n_parts: int) -> dict[int, tuple]:
    """{replica: (gradient sum, rows, loss, correct)} from the per-partition rows: added on executors,
    ``FAN_IN`` at a time, until the driver receives at most ``FAN_IN`` vectors per replica."""
    fan = FAN_IN

    def add(pdf):
        import pandas as pd

        g = np.sum(np.stack(pdf.sort_values("part")["grad"].to_numpy()), axis=0)
        return pd.DataFrame({"replica": pdf["replica"].iloc[:1].astype("int32"), "part": [int(pdf["part"].iloc[0]) // fan],
                             "n": [int(pdf["n"].sum())], "loss": [float(pdf["loss"].sum())],
                             "correct": [int(pdf["correct"].sum())], "grad": [g]})

    while n_parts > fan:
        rows = rows.groupBy("replica", F.floor(F.col("part") / fan)).applyInPandas(add, _GRAD_SCHEMA)
        n_parts = math.ceil(n_parts / fan)
    t = rows.toArrow().combine_chunks()
    replica, part = t.column("replica").to_numpy(), t.column("part").to_numpy()
    grads, out = _vectors(t, "grad", size), {}
    for r in np.unique(replica).tolist():
        at = np.flatnonzero(replica == r)
        at = at[np.argsort(part[at])]  # one order of addition
        n, loss, correct = (t.column(c).to_numpy()[at].sum() for c in ("n", "loss", "correct"))
        out[r] = (grads[at].sum(axis=0), int(n), float(loss), int(correct))
    return out


_COPY_SCHEMA = "replica int, n bigint, t bigint, theta array<double>, m array<double>, v array<double>"


def _row_bytes(width: int) -> int:
    return 8 * width + 32


def in_runs(batched: DataFrame, copies: int, batches_per_run: int, n_batches: int, id_col: str) -> DataFrame:
    """Column ``run`` and the rows of each run and copy in one partition, in batch order."""
    runs = math.ceil(math.ceil(n_batches / copies) / batches_per_run)
    turn = (F.col("batch") - F.col("batch") % copies) / copies  # whole: the copies' how-manieth batch
    placed = batched.withColumn("replica", (F.col("batch") % copies).cast("int")).withColumn("run", F.floor(turn / batches_per_run).cast("int"))
    return placed.repartitionById(runs * copies, F.col("run") * copies + F.col("replica")).sortWithinPartitions("batch", id_col)


def run_steps(rows: DataFrame, layers, like, copies: list, cfg: TrainConfig, in_shape, n_classes, data_col="data", label_col="label") -> dict[int, tuple]:
    """Take every model copy through its batches of ``rows`` (see :func:`in_runs`), in order, one task a
    copy: {replica: (theta, optimizer state, rows)}. ``copies`` holds (theta, optimizer state) per copy."""
    ship_package(rows.sparkSession)
    bc = rows.sparkSession.sparkContext.broadcast((layers, like, copies))
    width = int(np.prod(in_shape))

    def run(batches):
        lys, params, given = bc.value
        wmask = weight_mask(params)
        own: dict[int, list] = {}
        now, xs, ys = None, [], []

        def step():
            r, x, y = now[1], np.concatenate(xs), np.concatenate(ys)
            if r not in own:
                opt = Optimizer(cfg, wmask.size, wmask)
                opt.load(given[r][1])
                own[r] = [given[r][0], opt, 0]
            theta, opt, n = own[r]
            prm, grad = K.unpack(theta, params), 0.0
            for i in range(0, len(y), STEP_ROWS):
                grad = grad + K.batch_gradients(x[i:i + STEP_ROWS], y[i:i + STEP_ROWS], lys, prm, n_classes, cfg.eps_mode)[0]
            own[r] = [opt.step(theta, grad, len(y)), opt, n + len(y)]

        for rb in batches:
            if rb.num_rows == 0:
                continue
            x, y = _shape_x(arrow_matrix(rb, data_col, width), in_shape), _labels(rb, label_col)
            batch, replica = _labels(rb, "batch"), _labels(rb, "replica")
            edges = [0, *(np.flatnonzero(np.diff(batch)) + 1).tolist(), len(batch)]
            for a, b in zip(edges, edges[1:]):
                key = (int(batch[a]), int(replica[a]))
                if now is not None and key != now:
                    step()
                    xs, ys = [], []
                now = key
                xs.append(x[a:b])
                ys.append(y[a:b])
        if now is not None:
            step()
        for r, (theta, opt, n) in own.items():
            # what the optimizer does not use stays zero and is not sent
            m = opt.m if cfg.optimizer == "adam" else np.zeros(0)
            v = opt.v if cfg.optimizer != "sgd" else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r], pa.int32()), pa.array([n], pa.int64()), pa.array([opt.t], pa.int64()), *(_one_list(a) for a in (theta, m, v))],
                names=["replica", "n", "t", "theta", "m", "v"],
            )

    try:
        t = rows.select(label_col, data_col, "batch", "replica").mapInArrow(run, _COPY_SCHEMA).toArrow().combine_chunks()
    finally:
        bc.destroy()
    out = {}
    for k, (r, n, turns) in enumerate(zip(*(t.column(c).to_pylist() for c in ("replica", "n", "t")))):
        theta, m, v = (t.column(c)[k].values.to_numpy(zero_copy_only=False) for c in ("theta", "m", "v"))
        if r in out:
            raise RuntimeError("a model copy's batches must lie in one partition")
        old = copies[r][1]
        out[r] = (theta, {"m": m if m.size else old["m"], "v": v if v.size else old["v"], "t": turns}, n)
    return out


def _one_list(a: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, a.size], pa.int32()), pa.array(a, pa.float64()))


def _n_partitions(cached: DataFrame) -> int:
    """Partitions of a cached table that have rows up to the last such one (a job over the cache)."""
    last = cached.select(F.spark_partition_id().alias("p")).agg(F.max("p")).first()[0]
    return 1 if last is None else last + 1


def evaluate(df: DataFrame, layers, params, in_shape, eps_mode="clip", data_col="data", label_col="label",
             set_col: str | None = None) -> dict:
    """Loss and accuracy per set in one scoring job: {set: (loss, accuracy, n)}."""
    ship_package(df.sparkSession)
    bc = df.sparkSession.sparkContext.broadcast((layers, params))
    try:
        return _evaluate(df, bc, in_shape, eps_mode, data_col, label_col, set_col)
    finally:
        bc.destroy()


def _evaluate(df, bc, in_shape, eps_mode, data_col, label_col, set_col) -> dict:
    width = int(np.prod(in_shape))
    cols = [label_col, data_col] + ([set_col] if set_col else [])

    def run(batches):
        lys, prm = bc.value
        for rb in batches:
            if rb.num_rows == 0:
                continue
            x = _shape_x(arrow_matrix(rb, data_col, width), in_shape)
            y = _labels(rb, label_col)
            p = K.predict_proba(x, lys, prm)
            sets = rb.column(rb.schema.get_field_index(set_col)) if set_col else pa.array(["all"] * len(y))
            yield pa.RecordBatch.from_arrays(
                [sets, pa.array(K.ce_terms(p, y, eps_mode)), pa.array((p.argmax(axis=1) == y).astype(np.int64))],
                names=["set", "loss", "ok"],
            )

    per_row = df.select(*cols).mapInArrow(run, "set string, loss double, ok bigint")
    agg = per_row.groupBy("set").agg(F.count(F.lit(1)).alias("n"), F.avg("loss").alias("loss"), F.avg("ok").alias("acc"))
    return {r["set"]: (r["loss"], r["acc"], r["n"]) for r in agg.collect()}


def _release(broadcasts: list) -> None:
    """Drop a finished step's model broadcast from executors and driver (one per step)."""
    for bc in broadcasts:
        bc.destroy()
    broadcasts.clear()


TARGET_PARTITION_BYTES = 64 << 20  # packed rows per training partition


def cache_sized(df: DataFrame, width: int) -> tuple[DataFrame, int]:
    """(cached table, rows) for Python-side training work: at most TARGET_PARTITION_BYTES of packed
    rows per partition and a task for every core, but not many more (each partition costs an Arrow
    round trip per step). Fewer partitions come from a narrow ``coalesce`` over the cache, more from a
    repartition that replaces it."""
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    n_rows, current = cached.count(), _n_partitions(cached)
    by_size = math.ceil(n_rows * _row_bytes(width) / TARGET_PARTITION_BYTES)
    target = max(1, by_size, min(df.sparkSession.sparkContext.defaultParallelism, n_rows))
    if by_size <= current <= target:
        return cached, n_rows
    sized = (cached.coalesce(target) if current > target else cached.repartition(target)).persist(StorageLevel.MEMORY_AND_DISK)
    sized.count()
    cached.unpersist()
    return sized, n_rows


# ----------------------------------------------------------------------------- driver loop
@dataclass
class TrainResult:
    layers: list
    params: list
    curves: list  # (epoch, set, loss, accuracy)
    steps: int
    optimizer_state: dict


def train_network(
    train_df: DataFrame,
    layers: list[dict],
    cfg: TrainConfig,
    in_shape: tuple,
    n_classes: int,
    val_df: DataFrame | None = None,
    params: list | None = None,
    data_col: str = "data",
    label_col: str = "label",
    id_col: str = "id",
    init_scheme: str = "he",
    evaluate_every: int = 1,  # 0: no per-epoch scoring (no curves)
    checkpoint_path: str | None = None,
    resume: bool = False,
) -> TrainResult:
    """Train ``layers`` on ``train_df`` (rows: id, label, packed data).

    With ``checkpoint_path`` (a folder on shared storage) the model table and optimizer state
    are written after every epoch to ``epoch=<n>`` sub-folders (a failed write never replaces a
    committed one); ``resume=True`` restarts after the last committed epoch.
    """
    from ..sources.model_store import load_extra, load_model, save_model

    spark = train_df.sparkSession
    K.output_shapes(layers, in_shape)
    params = params if params is not None else K.init_params(layers, cfg.seed, init_scheme)
    size = check_model_size(params)
    opt = Optimizer(cfg, size, weight_mask(params))
    start = 0
    if resume and checkpoint_path:
        last = _last_epoch(spark, checkpoint_path)
        if last is not None:
            where = f"{checkpoint_path}/epoch={last}"
            _, params = load_model(spark, where, expect_layers=layers)
            st = load_extra(spark, where)
            opt.load({"m": st["m"], "v": st["v"], "t": int(st["t"][0])})
            start = last + 1
    theta = K.pack(params)

    width = int(np.prod(in_shape))
    data, total = cache_sized(train_df.select(id_col, label_col, data_col), width)
    if total == 0:
        data.unpersist()
        raise ValueError("no training rows")
    val = cache_sized(val_df.select(id_col, label_col, data_col), width)[0] if val_df is not None else None
    n_parts = _n_partitions(data)
    bsize = cfg.batch_size if cfg.batches_per_epoch is None else math.ceil(total / cfg.batches_per_epoch)
    n_batches = 1 if bsize is None else math.ceil(total / bsize)
    copies = min(cfg.replicas, n_batches) if cfg.mode == "replicas" else 1
    # batches that a task steps through in one job; 0: each is spread over tasks, a job a step
    per_run = 0
    if n_batches > 1 and bsize * _row_bytes(width) <= STEP_BYTES:
        per_run = max(1, RUN_BYTES // (bsize * _row_bytes(width)))
    curves, steps = [], 0
    try:
        for epoch in range(start, cfg.epochs):
            batched = data
            if n_batches > 1:
                # Sorted by batch inside each partition, the cached column batches carry tight
                # min/max statistics, so a job's filter skips the other batches' data.
                batched = assign_batches(data, id_col, cfg.seed, epoch, bsize, n_rows=total)
                if per_run:
                    batched = in_runs(batched, copies, per_run, n_batches, id_col)
                else:  # as many partitions as the training data, not shuffle-sized
                    batched = batched.coalesce(n_parts).sortWithinPartitions("batch")
                batched = batched.persist(StorageLevel.MEMORY_AND_DISK)
            thetas, opts, seen = [theta.copy() for _ in range(copies)], [], np.zeros(copies)
            for _ in range(copies):
                own = Optimizer(cfg, size, weight_mask(params))
                own.load({k: np.copy(v) if k != "t" else v for k, v in opt.state().items()})
                opts.append(own)
            turns = math.ceil(n_batches / copies)
            for k in range(math.ceil(turns / per_run) if per_run else 0):
                given = [(t, o.state()) for t, o in zip(thetas, opts)]
                for r, (t, state, m_rows) in run_steps(batched.where(F.col("run") == k), layers, params, given, cfg, in_shape, n_classes, data_col, label_col).items():
                    thetas[r] = t
                    opts[r].load(state)
                    seen[r] += m_rows
            if per_run:
                steps += turns
            for first in range(0, 0 if per_run else n_batches, copies):
                step = batched
                if n_batches > 1:
                    step = batched.where(F.col("batch").between(first, first + copies - 1)).withColumn("replica", (F.col("batch") - first).cast("int"))
                bcs: list = []
                got = _sum_partials(
                    gradient_rows(step, layers, [K.unpack(t, params) for t in thetas], in_shape, n_classes, cfg.eps_mode, data_col, label_col, bcs),
                    size, n_parts,
                )
                _release(bcs)
                for r, (g, m_rows, _, _) in got.items():
                    thetas[r] = opts[r].step(thetas[r], g, m_rows)
                    seen[r] += m_rows
                steps += 1
            share = seen / seen.sum()
            theta = sum(w * t for w, t in zip(share, thetas))
            opt.m = sum(w * o.m for w, o in zip(share, opts))
            opt.v = sum(w * o.v for w, o in zip(share, opts))
            opt.t = max(o.t for o in opts)
            if batched is not data:
                batched.unpersist()
            if evaluate_every and ((epoch + 1) % evaluate_every == 0 or epoch == cfg.epochs - 1):
                cur = K.unpack(theta, params)
                both = data.withColumn("_set", F.lit("train"))
                if val is not None:
                    both = both.unionByName(val.withColumn("_set", F.lit("val")))
                res = evaluate(both, layers, cur, in_shape, cfg.eps_mode, data_col, label_col, "_set")
                for s in ("train", "val"):
                    if s in res:
                        curves.append((epoch, s, float(res[s][0]), float(res[s][1])))
            if not np.all(np.isfinite(theta)):
                raise FloatingPointError(f"non-finite parameters after epoch {epoch}")
            if checkpoint_path:
                save_model(spark, f"{checkpoint_path}/epoch={epoch}", layers, K.unpack(theta, params),
                           extra={"m": opt.m, "v": opt.v, "t": [opt.t], "epoch": [epoch]})
    finally:
        data.unpersist()
        if val is not None:
            val.unpersist()
    return TrainResult(layers, K.unpack(theta, params), curves, steps, opt.state())


def _last_epoch(spark, path: str) -> int | None:
    """Highest committed ``epoch=<n>`` checkpoint under ``path`` (partition discovery)."""
    from pyspark.errors import AnalysisException

    try:
        row = spark.read.parquet(path).agg(F.max("epoch")).first()
    except AnalysisException:
        return None
    return None if row[0] is None else int(row[0])


def curves_frame(spark, result: TrainResult) -> DataFrame:
    return spark.createDataFrame(
        [(int(e), s, float(l), float(a)) for e, s, l, a in result.curves], "epoch bigint, set string, loss double, accuracy double"
    )


def one_step_params(df: DataFrame, layers, params, cfg: TrainConfig, in_shape, n_classes, steps: int = 1,
                    data_col="data", label_col="label"):
    """``steps`` full-batch optimizer steps (the unit checked against SQL)."""
    size = check_model_size(params)
    theta = K.pack(params)
    opt = Optimizer(cfg, size, weight_mask(params))
    data, _ = cache_sized(df.select(label_col, data_col), int(np.prod(in_shape)))
    n_parts = _n_partitions(data)
    for _ in range(steps):
        bcs: list = []
        got = _sum_partials(
            gradient_rows(data, layers, [K.unpack(theta, params)], in_shape, n_classes, cfg.eps_mode, data_col, label_col, bcs),
            size, n_parts,
        )
        _release(bcs)
        g, m_rows, _, _ = got[0]
        theta = opt.step(theta, g, m_rows)
    data.unpersist()
    return K.unpack(theta, params)
