"""An autoencoder trained on a table, with gradients that Spark sums, and its dataset, checkpoints and stage.

The network is linear - ReLU - linear (the code) - linear - ReLU - linear - sigmoid, over columns that are brought to 0..1 by their
least and largest value. Rows are dealt once to a test part and to batches, by a seeded hash of the key, and written by part. A
step reads one batch: every task gives the sum of its rows' gradients, one number a weight, Spark adds them up, and the
driver, which holds the weights alone, makes the Adam step. So a step is the same whatever the partitioning (but for the order of sums), no
row comes to the driver, and what is sent grows with the network and the number of tasks. After each epoch the state is written;
a run that breaks off goes on from there.

Defined results: a missing cell counts as its column's mean on the way in and not at all in the loss; a constant column is 0;
a column without values is 0 and never counts; a table without rows cannot be trained on (error).
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortloom.operators.sums import BATCH_ROWS, summed
from cohortloom.sources import tables


@dataclass(frozen=True)
class Training:
    """batches: parts an epoch is cut into, of which at most batch_limit are used (0: all)."""

    mid_size: int = 100
    latent_size: int = 10
    epochs: int = 5
    batches: int = 10
    batch_limit: int = 0
    rate: float = 1e-3
    test_percent: int = 20
    seed: int = 42


@dataclass
class Autoencoder:
    """weights: matrix and offset of each of the four layers."""

    columns: list[str]
    low: np.ndarray
    span: np.ndarray
    mean: np.ndarray
    weights: list[np.ndarray]
    history: list[dict] = field(default_factory=list)

    def scaled(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(inputs between 0 and 1, which cells are known) of rows with NaN where a cell is missing."""
        known = ~np.isnan(x)
        return np.where(known, (x - self.low) / self.span, (self.mean - self.low) / self.span), known

    def _layers(self, x: np.ndarray) -> list[np.ndarray]:
        w1, b1, w2, b2, w3, b3, w4, b4 = self.weights
        a = np.maximum(x @ w1 + b1, 0)
        z = a @ w2 + b2
        c = np.maximum(z @ w3 + b3, 0)
        return [x, a, z, c, 1 / (1 + np.exp(-np.clip(c @ w4 + b4, -60, 60)))]

    def encode(self, x: np.ndarray) -> np.ndarray:
        return self._layers(x)[2]

    def decode(self, x: np.ndarray) -> np.ndarray:
        return self._layers(x)[4]

    def loss(self, x: np.ndarray, known: np.ndarray) -> tuple[float, int]:
        """(sum of squared errors of the known cells, their number)."""
        return float((((self.decode(x) - x) * known) ** 2).sum()), int(known.sum())

    def gradients(self, x: np.ndarray, known: np.ndarray) -> tuple[float, int, list[np.ndarray]]:
        """As loss, with the derivative of the sum by each weight."""
        x, a, z, c, y = self._layers(x)
        error = (y - x) * known
        out: list[np.ndarray] = []
        back = 2 * error * y * (1 - y)
        for into, w, opened in ((c, 6, c > 0), (z, 4, None), (a, 2, a > 0), (x, 0, None)):
            out = [into.T @ back, back.sum(axis=0), *out]
            back = back @ self.weights[w].T
            if opened is not None:
                back = back * opened
        return float((error**2).sum()), int(known.sum()), out

    def moved(self, by: list[np.ndarray]) -> Autoencoder:
        return Autoencoder(self.columns, self.low, self.span, self.mean, [w + d for w, d in zip(self.weights, by)], self.history)

    def state(self) -> dict:
        return {"columns": self.columns, "low": self.low.tolist(), "span": self.span.tolist(), "mean": self.mean.tolist(), "weights": [w.tolist() for w in self.weights], "history": self.history}


def new_autoencoder(columns: list[str], ends: list[tuple], mid_size: int, latent_size: int, seed: int) -> Autoencoder:
    """ends: least value, largest value and mean of each column. Weights are uniform within 1 / sqrt(inputs of the layer)."""
    rng, d = np.random.default_rng(seed), len(columns)
    weights = []
    for inputs, outputs in ((d, mid_size), (mid_size, latent_size), (latent_size, mid_size), (mid_size, d)):
        reach = 1 / np.sqrt(inputs)
        weights += [rng.uniform(-reach, reach, (inputs, outputs)), rng.uniform(-reach, reach, outputs)]
    low, high, mean = (np.array([0.0 if e[i] is None else float(e[i]) for e in ends]) for i in range(3))
    return Autoencoder(columns, low, np.where(high > low, high - low, 1.0), mean, weights)


def column_ends(df: DataFrame, columns: list[str]) -> list[tuple]:
    row = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("l", F.min), ("h", F.max), ("m", F.avg))]).first()
    return [(row[f"l{i}"], row[f"h{i}"], row[f"m{i}"]) for i in range(len(columns))]


def _vector(columns: list[str]) -> Column:
    return F.array(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns])


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, d)


def dataset(df: DataFrame, key: str, label: str | None = None, test_percent: int = 20, seed: int = 42) -> tuple[DataFrame, DataFrame, list[str]]:
    """(training rows, test rows, columns): key, x (the other columns as one vector) and y (the label, 0 without one); dealt by a hash of the key."""
    columns = [c for c, t in df.dtypes if c not in (key, label) and (t in ("int", "bigint", "smallint", "tinyint", "float", "double", "boolean") or t.startswith("decimal"))]
    y = F.lit(0.0) if label is None else F.col(label).cast("double")
    rows = df.select(key, _vector(columns).alias("x"), y.alias("y"), _part(key, 1, test_percent, seed).alias("part"))
    return rows.where("part >= 0").drop("part"), rows.where("part < 0").drop("part"), columns


def save_dataset(train: DataFrame, test: DataFrame, folder: str) -> None:
    for name, rows in (("train", train), ("test", test)):
        for c in "xy":
            tables.write_parquet(rows.select(rows.columns[0], c), f"{folder}/{name}_{c.upper()}.parquet")


def _part(key: str, batches: int, test_percent: int, seed: int) -> Column:
    """-1 for test rows, else the batch."""
    h = F.xxhash64(F.lit(seed), key)
    return F.when(F.pmod(h, F.lit(100)) < test_percent, -1).otherwise(F.pmod(F.shiftright(h, 20), F.lit(batches))).cast("int")


def _summed(rows: DataFrame, model: Autoencoder, with_gradients: bool) -> np.ndarray:
    """Loss, known cells and, if wanted, the gradient by each weight, summed by Spark."""
    def part(model: Autoencoder, b: pa.RecordBatch) -> np.ndarray:
        x, known = model.scaled(_matrix(b.column("x"), len(model.columns)))
        loss, n, by = model.gradients(x, known) if with_gradients else (*model.loss(x, known), [])
        return np.concatenate([[loss, n], *[g.ravel() for g in by]])

    return summed(rows.select("x"), 2 + (sum(w.size for w in model.weights) if with_gradients else 0), model, part)


def mean_loss(rows: DataFrame, model: Autoencoder) -> float | None:
    """Mean squared error of the known cells of rows with vectors x."""
    loss, n = _summed(rows, model, False)
    return float(loss / n) if n else None


def _shaped(flat: np.ndarray, like: list[np.ndarray]) -> list[np.ndarray]:
    ends = np.cumsum([w.size for w in like])
    return [part.reshape(w.shape) for part, w in zip(np.split(flat, ends[:-1]), like)]


def gradient(rows: DataFrame, model: Autoencoder) -> tuple[float | None, list[np.ndarray]]:
    """(mean squared error of rows with vectors x, its derivative by each weight)."""
    total = _summed(rows, model, True)
    n = max(1.0, total[1])
    return (float(total[0] / n) if total[1] else None), _shaped(total[2:] / n, model.weights)


class _Adam:
    def __init__(self, like: list[np.ndarray], rate: float):
        self.rate, self.t = rate, 0
        self.first, self.second = [np.zeros_like(w) for w in like], [np.zeros_like(w) for w in like]

    def step(self, by: list[np.ndarray]) -> list[np.ndarray]:
        self.t += 1
        self.first = [0.9 * m + 0.1 * g for m, g in zip(self.first, by)]
        self.second = [0.999 * v + 0.001 * g * g for v, g in zip(self.second, by)]
        a, b = 1 - 0.9**self.t, 1 - 0.999**self.t
        return [-self.rate * (m / a) / (np.sqrt(v / b) + 1e-8) for m, v in zip(self.first, self.second)]


def train(df: DataFrame, key: str, columns: list[str], folder: str, settings: Training = Training(), resume: bool = True) -> Autoencoder:
    """The trained network; rows by part, and the state after each epoch, lie in the folder under a hash of columns and settings."""
    spark = df.sparkSession
    lasting = {k: v for k, v in asdict(settings).items() if k != "epochs"}  # more epochs go on with the same state
    home = tables.stage_path(folder, "autoencoder", [key, columns, lasting]).removesuffix(".parquet")
    parts = f"{home}/parts"
    if not (resume and tables.path_exists(spark, f"{parts}/_SUCCESS")):
        rows = df.select(F.col(key).alias("key"), _vector(columns).alias("x"), _part(key, settings.batches, settings.test_percent, settings.seed).alias("part"))
        files = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // (settings.batches + 1))
        tables.write_parquet(rows.repartition("part", F.pmod(F.xxhash64("key"), F.lit(files))).select("x", "part"), parts, ["part"])
    rows = spark.read.schema("x array<double>, part int").parquet(parts)
    model, adam, begun = None, None, 0
    if resume:
        model, adam, begun = _restored(spark, home, settings)
    if model is None:
        model = new_autoencoder(columns, column_ends(df, columns), settings.mid_size, settings.latent_size, settings.seed)
        adam = _Adam(model.weights, settings.rate)
    used = [b for b in range(settings.batches)][: settings.batch_limit or None]
    for epoch in range(begun, settings.epochs):
        losses = []
        for b in np.random.default_rng([settings.seed, epoch]).permutation(used).tolist():
            loss, by = gradient(rows.where(F.col("part") == b), model)
            if loss is not None:
                losses.append(loss)
                model = model.moved(adam.step(by))
        if not losses:
            raise ValueError("no rows to train on")
        model.history = [*model.history, {"epoch": epoch + 1, "train_loss": sum(losses) / len(losses), "val_loss": mean_loss(rows.where("part = -1"), model)}]
        state = model.state() | {"epoch": epoch + 1, "steps": adam.t, "first": [x.tolist() for x in adam.first], "second": [x.tolist() for x in adam.second]}
        tables.write_json(spark, state, f"{home}/epoch_{epoch + 1}.json.new")
        tables.rename(spark, f"{home}/epoch_{epoch + 1}.json.new", f"{home}/epoch_{epoch + 1}.json")
    return model


def _restored(spark: SparkSession, home: str, settings: Training) -> tuple[Autoencoder | None, _Adam | None, int]:
    """The latest whole state of at most the wanted epochs."""
    for epoch in range(settings.epochs, 0, -1):
        if tables.path_exists(spark, f"{home}/epoch_{epoch}.json"):
            state = tables.read_json(spark, f"{home}/epoch_{epoch}.json")
            adam = _Adam([], settings.rate)
            adam.t, adam.first, adam.second = state["steps"], [np.array(x) for x in state["first"]], [np.array(x) for x in state["second"]]
            return _of(state), adam, epoch
    return None, None, 0


def _of(state: dict) -> Autoencoder:
    return Autoencoder(state["columns"], *(np.array(state[c]) for c in ("low", "span", "mean")), [np.array(w) for w in state["weights"]], state["history"])


def save(spark: SparkSession, model: Autoencoder, path: str) -> None:
    tables.write_json(spark, model.state(), path)


def load(spark: SparkSession, path: str) -> Autoencoder:
    return _of(tables.read_json(spark, path))


def apply(df: DataFrame, key: str, model: Autoencoder) -> DataFrame:
    """key, code (the latent vector), rebuilt (the columns' values as the network gives them) and error (mean squared, of the known cells in 0..1)."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        d, latent = len(model.columns), model.weights[2].shape[1]
        for b in batches:
            for i in range(0, b.num_rows, BATCH_ROWS):
                rows = b.slice(i, BATCH_ROWS)
                x, known = model.scaled(_matrix(rows.column("x"), d))
                y = model.decode(x)
                n = known.sum(axis=1)
                error = np.where(n > 0, (((y - x) * known) ** 2).sum(axis=1) / np.maximum(n, 1), np.nan)
                lists = [pa.FixedSizeListArray.from_arrays(pa.array(v.ravel()), w).cast(pa.list_(pa.float64())) for v, w in ((model.encode(x), latent), (y * model.span + model.low, d))]
                yield pa.RecordBatch.from_arrays([rows.column(key), *lists, pa.array(error, from_pandas=True)], names=[key, "code", "rebuilt", "error"])

    return df.select(key, _vector(model.columns).alias("x")).mapInArrow(run, f"`{key}` {kind}, code array<double>, rebuilt array<double>, error double")


#: Kinds of models by name: what trains one.
MODELS = {"vanilla_ae": train}


def run(spark: SparkSession, settings: dict | str) -> Autoencoder:
    """The training stage. settings (or a JSON file of them): name, absolute_path, data_args {inputfile, index_id, label}, model,
    model_args {mid_size, latent_size}, epochs, batchlim (most batches an epoch). Writes results/name/model.json and history.json."""
    if isinstance(settings, str):
        with open(settings) as f:
            settings = json.load(f)
    if settings["model"] not in MODELS:
        raise ValueError(f"no model {settings['model']!r}; known: {sorted(MODELS)}")
    data, folder = settings["data_args"], f"{settings['absolute_path'].rstrip('/')}/results/{settings['name']}"
    key, label = data.get("index_id", "subject_id"), data.get("label")
    df = tables.read(spark, data["inputfile"])
    columns = dataset(df, key, label)[2]
    shape = {k: v for k, v in settings.get("model_args", {}).items() if k != "input_size"}
    model = MODELS[settings["model"]](df, key, columns, folder, Training(**shape, epochs=settings.get("epochs", 5), batch_limit=max(0, settings.get("batchlim", 0))))
    save(spark, model, f"{folder}/model.json")
    tables.write_json(spark, model.history, f"{folder}/history.json")
    return model
