"""Anomaly detection: reconstruction errors of features against mean plus two standard deviations.

Two detectors: principal components (fitted by Spark on all rows) and an autoencoder of two one-step LSTM layers (numpy).
The autoencoder is fitted on the driver, on at most ``rows`` feature vectors, those of the lowest hashes of their keys.
"""

from __future__ import annotations

import io
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIGMA = 2.0
LATENT, HIDDEN = 4, 128


class NotFitted(RuntimeError):
    """There is no model or threshold where one was looked for."""


def mse(x: Column, y: Column) -> Column:
    """Mean of the squared differences of two arrays."""
    total = F.aggregate(F.zip_with(x, y, lambda a, b: (a - b).cast("double") * (a - b).cast("double")), F.lit(0.0), lambda s, v: s + v)
    return total / F.size(x)


def threshold_of(errors: DataFrame, error: str = "error", sigma: float = SIGMA) -> DataFrame:
    """One row: threshold, mean plus sigma sample standard deviations. A single error has no deviation: null, which flags nothing."""
    return errors.agg((F.avg(error) + sigma * F.stddev_samp(error)).alias("threshold"))


def clean_rows(rows: DataFrame, key: str = "key") -> DataFrame:
    """Rows named clean; all rows if none is."""
    named = rows.where(F.lower(key).contains("clean"))
    return rows if named.isEmpty() else named


def flag(errors: DataFrame, threshold: DataFrame, error: str = "error") -> DataFrame:
    """errors with anomaly: above the threshold, at it not."""
    return errors.crossJoin(F.broadcast(threshold)).withColumn("anomaly", F.coalesce(F.col(error) > F.col("threshold"), F.lit(False)))  # one row


def summary(flagged: DataFrame) -> DataFrame:
    return flagged.agg(F.count("*").alias("total"), F.count_if(~F.col("anomaly")).alias("normal"), F.count_if("anomaly").alias("anomalies"))


# ---- principal components ----


def fit_pca(rows: DataFrame, k: int = LATENT, features: str = "features"):
    """Model (Spark's) and the mean that reconstruction needs."""
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import array_to_vector

    vectors = rows.select(array_to_vector(F.col(features)).alias("raw"))
    scaler = StandardScaler(inputCol="raw", outputCol="x", withMean=True, withStd=False).fit(vectors)
    return PCA(k=k, inputCol="x", outputCol="pc").fit(scaler.transform(vectors)), scaler


def score_pca(rows: DataFrame, model, scaler, features: str = "features", key: str = "key") -> DataFrame:
    """key, error: distance of each vector from its projection."""
    return score(rows, Components.of(model, scaler), key, features)


@dataclass
class Components:
    """A fitted projection with its mean, free of the session that fitted it."""

    axes: np.ndarray
    mean: np.ndarray

    @classmethod
    def of(cls, model, scaler) -> Components:
        return cls(model.pc.toArray(), np.asarray(scaler.mean.toArray()))

    @classmethod
    def fit(cls, rows: DataFrame, k: int = LATENT, features: str = "features") -> Components:
        return cls.of(*fit_pca(rows, k, features))

    def errors(self, x: np.ndarray) -> np.ndarray:
        x = x - self.mean
        return ((x - x @ self.axes @ self.axes.T) ** 2).mean(axis=1)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, axes=self.axes, mean=self.mean)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Components:
        kept = np.load(io.BytesIO(data), allow_pickle=False)
        return cls(kept["axes"], kept["mean"])


# ---- LSTM autoencoder ----


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


@dataclass
class Autoencoder:
    """input -> LSTM -> latent -> LSTM -> input over sequences of one step.

    The cell starts at zero, so the forget gate has no effect: c = i * g, h = o * tanh(c). The encoder's hidden state starts
    at zero too, so it has no recurrent weights; the decoder's starts at a projection of the latent vector. Gates are
    stacked as input, cell, output.
    """

    size: int
    hidden: int = HIDDEN
    latent: int = LATENT
    seed: int = 0
    w: dict[str, np.ndarray] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.w:
            return
        rng, n, h, z = np.random.default_rng(self.seed), self.size, self.hidden, self.latent
        shapes = {"enc_x": (n, 3 * h), "enc_b": (3 * h,), "to_z": (h, z), "z_b": (z,), "to_h": (z, h), "h_b": (h,), "dec_x": (z, 3 * h), "dec_h": (h, 3 * h), "dec_b": (3 * h,), "out": (h, n), "out_b": (n,)}
        self.w = {k: rng.uniform(-1, 1, s) / np.sqrt(h if k != "to_h" else z) for k, s in shapes.items()}

    def _cell(self, gates: np.ndarray) -> tuple[np.ndarray, tuple]:
        h = self.hidden
        i, g, o = _sigmoid(gates[:, :h]), np.tanh(gates[:, h : 2 * h]), _sigmoid(gates[:, 2 * h :])
        t = np.tanh(i * g)
        return o * t, (i, g, o, t)

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, dict]:
        w = self.w
        h1, enc = self._cell(x @ w["enc_x"] + w["enc_b"])
        z = h1 @ w["to_z"] + w["z_b"]
        h0 = z @ w["to_h"] + w["h_b"]
        h2, dec = self._cell(z @ w["dec_x"] + h0 @ w["dec_h"] + w["dec_b"])
        return h2 @ w["out"] + w["out_b"], {"h1": h1, "enc": enc, "z": z, "h0": h0, "h2": h2, "dec": dec}

    def reconstruct(self, x: np.ndarray) -> np.ndarray:
        return self._forward(x)[0]

    def errors(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.reconstruct(x)) ** 2).mean(axis=1)

    @staticmethod
    def _cell_back(d_h: np.ndarray, kept: tuple) -> np.ndarray:
        i, g, o, t = kept
        d_c = d_h * o * (1 - t * t)
        return np.hstack([d_c * g * i * (1 - i), d_c * i * (1 - g * g), d_h * t * o * (1 - o)])

    def gradients(self, x: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        y, k = self._forward(x)
        w, d_y = self.w, 2 * (y - x) / x.size
        d_dec = self._cell_back(d_y @ w["out"].T, k["dec"])
        d_h0 = d_dec @ w["dec_h"].T
        d_z = d_dec @ w["dec_x"].T + d_h0 @ w["to_h"].T
        d_enc = self._cell_back(d_z @ w["to_z"].T, k["enc"])
        grads = {
            "out": k["h2"].T @ d_y, "out_b": d_y.sum(0), "dec_x": k["z"].T @ d_dec, "dec_h": k["h0"].T @ d_dec, "dec_b": d_dec.sum(0),
            "to_h": k["z"].T @ d_h0, "h_b": d_h0.sum(0), "to_z": k["h1"].T @ d_z, "z_b": d_z.sum(0), "enc_x": x.T @ d_enc, "enc_b": d_enc.sum(0),
        }
        return float(((y - x) ** 2).mean()), grads

    def fit(self, train: np.ndarray, validation: np.ndarray, epochs: int = 500, rate: float = 5e-4, batch: int = 32, patience: int = 50) -> list[tuple[float, float]]:
        """Adam over shuffled batches; stops after so many epochs without a better validation loss and restores the best weights. Losses of each epoch."""
        if not len(train):
            raise ValueError("no rows to train on")
        rng, step = np.random.default_rng(self.seed), 0
        m, v = ({k: np.zeros_like(x) for k, x in self.w.items()} for _ in range(2))
        best, best_w, waited, history = np.inf, self.w, 0, []
        for _ in range(epochs):
            order, total = rng.permutation(len(train)), 0.0
            for at in range(0, len(train), batch):
                part = train[order[at : at + batch]]
                loss, grads = self.gradients(part)
                total += loss * len(part)
                step += 1
                for k, g in grads.items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.w[k] = self.w[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
            now = float(self.errors(validation).mean()) if len(validation) else total / len(train)
            history.append((total / len(train), now))
            if now < best:
                best, best_w, waited = now, {k: x.copy() for k, x in self.w.items()}, 0
            else:
                waited += 1
                if waited >= patience:
                    break
        self.w = best_w
        return history

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, size=self.size, hidden=self.hidden, latent=self.latent, **{f"w_{k}": x for k, x in self.w.items()})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Autoencoder:
        kept = np.load(io.BytesIO(data), allow_pickle=False)
        return cls(int(kept["size"]), int(kept["hidden"]), int(kept["latent"]), w={k[2:]: kept[k] for k in kept.files if k.startswith("w_")})


def fit_autoencoder(train: DataFrame, validation: DataFrame, rows: int = 20_000, key: str = "key", features: str = "features", **options) -> Autoencoder:
    def bounded(part: DataFrame) -> np.ndarray:
        got = part.orderBy(F.xxhash64(key), key).limit(rows).select(features).toPandas()[features]
        return np.stack(got.to_list()).astype(float) if len(got) else np.zeros((0, 0))

    x = bounded(train)
    if not len(x):
        raise ValueError("no rows to train on")
    model = Autoencoder(x.shape[1])
    held = bounded(validation)
    model.fit(x, held if len(held) else x[:0], **options)
    return model


def score(rows: DataFrame, model: Autoencoder | Components, key: str = "key", features: str = "features") -> DataFrame:
    """key, error. Errors are rounded, so that equal features have equal errors whatever batch they are in."""

    def run(values: pd.Series) -> pd.Series:
        return pd.Series(model.errors(np.stack(values.to_list()).astype(float)).round(12) if len(values) else np.zeros(0))

    return rows.select(key, F.pandas_udf(run, "double")(features).alias("error"))


score_autoencoder = score
KINDS = {"autoencoder": Autoencoder, "components": Components}


def save(spark: SparkSession, folder: str, model: Autoencoder | Components, threshold: float | None) -> None:
    """The detector and its threshold as one row."""
    kind = next(name for name, made in KINDS.items() if isinstance(model, made))
    row = [(kind, bytearray(model.to_bytes()), threshold)]
    spark.createDataFrame(row, "kind string, model binary, threshold double").coalesce(1).write.mode("overwrite").parquet(folder)


def load(spark: SparkSession, folder: str) -> tuple[Autoencoder | Components, float | None]:
    from pyspark.errors import AnalysisException

    try:
        row = spark.read.schema("kind string, model binary, threshold double").parquet(folder).first()
    except AnalysisException as error:
        raise NotFitted(f"no model in {folder}; train one first") from error
    if row is None:
        raise NotFitted(f"no model in {folder}; train one first")
    return KINDS[row["kind"]].from_bytes(bytes(row["model"])), row["threshold"]
