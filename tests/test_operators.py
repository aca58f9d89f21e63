import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import anomaly, dedup, metrics
from tidemark.operators.store import KeyedStore
from tidemark.plans import modes


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([("a", "k1", 1), ("b", "k2", 1), ("c", "k1", 1), ("d", "k1", 2), ("e", "k3", 2), ("f", "k3", 2), ("g", "k2", 3)], "path string, sha string, batch int").repartition(3)


def names(df):
    return sorted(r["path"] for r in df.collect())


def test_ways_to_deduplicate(spark, rows):
    store = spark.createDataFrame([("k3",)], "sha string")
    assert names(dedup.first_seen(rows, "sha")) == ["a", "b", "e"]
    assert names(dedup.first_seen(rows, "sha", store=store)) == ["a", "b"]
    assert len(names(dedup.first_seen(rows, "sha", dedup=False))) == 7
    assert names(dedup.batch_scoped(rows, "sha")) == ["a", "b", "c", "e", "f"]
    assert names(dedup.batch_scoped(rows, "sha", store=store)) == ["a", "b", "c"]
    assert names(dedup.seen(rows, store, "sha")) == ["e", "f"] and names(dedup.unseen(rows, store, "sha")) == ["a", "b", "c", "d", "g"]
    assert {r["path"]: r["found"] for r in dedup.exists(rows, store, "sha").collect()}["e"]
    assert {r["sha"]: r["last_seen"] for r in dedup.last_seen(rows, "sha", "path").collect()} == {"k1": "d", "k2": "g", "k3": "f"}


def test_batches_follow_a_loop(spark):
    rng = np.random.default_rng(0)
    keys = [f"k{k}" for k in rng.integers(0, 40, 200)]
    stored, survivors = {"k1", "k2"}, []
    for at in range(0, 200, 16):
        own = [(i, keys[i]) for i in range(at, min(at + 16, 200)) if keys[i] not in stored]
        survivors += [i for i, _ in own]
        stored |= {k for _, k in own}
    rows = dedup.numbered(spark.createDataFrame(list(enumerate(keys)), "i long, sha string"), "i").withColumn("batch", dedup.batch_of(F.col("place"), 16))
    got = dedup.batch_scoped(rows, "sha", store=spark.createDataFrame([("k1",), ("k2",)], "sha string"))
    assert sorted(r["i"] for r in got.collect()) == survivors


@pytest.mark.parametrize("n", [1, 4, 5, 10, 237])
def test_places_and_split(spark, n):
    df = spark.range(n).select((F.col("id") * 7 % 1009).alias("i")).repartition(3)
    got = [(r["i"], r["place"]) for r in dedup.numbered(df, "i").orderBy("i").collect()]
    assert [p for _, p in got] == list(range(1, n + 1))
    parts = [r["part"] for r in dedup.ordered_split(df, "i").orderBy("i").collect()]
    held = max(1, int(n * 0.2))
    assert parts == ["train"] * (n - held) + ["validation"] * held
    text = df.select(F.format_string("%05d", "i").alias("s"))
    assert [r["place"] for r in dedup.numbered(text, "s").orderBy("s").collect()] == list(range(1, n + 1))


def test_store(spark, tmp_path):
    store = modes.registry(spark, str(tmp_path))
    other = KeyedStore(spark, str(tmp_path), "fft", "sha256", "sha256 string, magnitudes array<float>")
    at = lambda key, day: spark.sql(f"select '{key}' as sha256, timestamp '2024-01-{day:02d}' as first_seen, timestamp '2024-01-{day:02d}' as last_seen")
    assert store.read().count() == 0 and store.get("a") is None and not store.exists("a")
    store.set(at("a", 1).union(at("b", 1)))
    store.set(at("a", 5))
    row = store.get("a")
    assert (row["first_seen"].day, row["last_seen"].day) == (1, 5) and store.read().count() == 2
    assert other.read().count() == 0
    other.set(spark.createDataFrame([("a", [float(i) for i in range(32_769)])], "sha256 string, magnitudes array<float>"))
    assert len(other.get("a")["magnitudes"]) == 32_769 and store.read().count() == 2
    store.compact()
    assert (store.get("a")["first_seen"].day, store.get("a")["last_seen"].day) == (1, 5)
    store.delete(spark.createDataFrame([("a",)], "sha256 string"))
    assert not store.exists("a") and store.exists("b")
    # a part that arrives while a generation is made is not lost, and is newer than what went into it
    state = store._state()
    store._state = lambda: state
    store.set(at("c", 3))
    store.compact()
    del store._state
    assert store.exists("c") and store.exists("b") and store.read().count() == 2
    store.clear()
    assert store.read().count() == 0 and other.exists("a")


def test_thresholds(spark):
    errors = spark.createDataFrame([("clean_1", 1.0), ("x", 2.0), ("CLEAN_2", 1.2)], "key string, error double")
    clean = anomaly.clean_rows(errors)
    assert clean.count() == 2 and anomaly.clean_rows(errors.where("key = 'x'")).count() == 1
    threshold = anomaly.threshold_of(clean).first()[0]
    assert threshold == pytest.approx(1.1 + 2 * np.std([1.0, 1.2], ddof=1))
    assert anomaly.summary(anomaly.flag(errors, anomaly.threshold_of(clean))).first()[:] == (3, 2, 1)
    one = errors.where("key = 'x'")
    assert not anomaly.flag(one, anomaly.threshold_of(one)).first()["anomaly"]
    at_it = spark.createDataFrame([(2.0,)], "threshold double")
    assert not anomaly.flag(one, at_it).first()["anomaly"]
    row = spark.range(1).select(anomaly.mse(F.array(F.lit(1.0), F.lit(2.0)), F.array(F.lit(3.0), F.lit(2.0)))).first()
    assert row[0] == 2.0


def test_autoencoder_gradients():
    rng = np.random.default_rng(0)
    model, x = anomaly.Autoencoder(5, hidden=6, latent=3), rng.normal(size=(4, 5))
    _, grads = model.gradients(x)
    for name, w in model.w.items():
        i = tuple(rng.integers(0, s) for s in w.shape)
        w[i] += 1e-6
        up = model.gradients(x)[0]
        w[i] -= 2e-6
        down = model.gradients(x)[0]
        w[i] += 1e-6
        assert grads[name][i] == pytest.approx((up - down) / 2e-6, abs=1e-6), name


@pytest.mark.parametrize("kind", ["autoencoder", "pca"])
def test_detectors_find_what_is_odd(spark, tmp_path, kind):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(2, 12))
    x = rng.normal(size=(160, 2)) @ base * 0.3 + rng.normal(0, 0.01, (160, 12))
    rows = [(f"clean_{i}", x[i].tolist()) for i in range(150)] + [(f"odd_{i}", (x[i] + 3 * (np.arange(12) % 3)).tolist()) for i in range(150, 160)]
    df = spark.createDataFrame(rows, "key string, features array<double>")
    clean = anomaly.clean_rows(df)
    if kind == "pca":
        errors = anomaly.score_pca(df, *anomaly.fit_pca(clean, k=4))
    else:
        model = anomaly.fit_autoencoder(clean, clean.where("key like '%7'"), epochs=60, rate=5e-3)
        anomaly.save(spark, f"{tmp_path}/m", model, 0.5)
        model, threshold = anomaly.load(spark, f"{tmp_path}/m")
        assert threshold == 0.5
        errors = anomaly.score_autoencoder(df, model)
    flagged = anomaly.flag(errors, anomaly.threshold_of(anomaly.clean_rows(errors)))
    odd = {r["key"] for r in flagged.where("anomaly").collect()}
    assert {f"odd_{i}" for i in range(150, 160)} <= odd and len(odd) < 30


def test_a_missing_model_says_so(spark, tmp_path):
    with pytest.raises(anomaly.NotFitted):
        anomaly.load(spark, f"{tmp_path}/none")


def test_metrics(spark):
    assert metrics.sweep(spark, a=[1, 2, 3, 4], b=[1, 2, 3, 4], c=[1, 2, 3, 4]).distinct().count() == 64
    row = spark.range(1).select(metrics.rate(F.lit(5), F.lit(0.0)), metrics.rate(F.lit(5), F.lit(2.0)), metrics.number_in(F.lit("Duration usecond 1,234.5")), metrics.number_in(F.lit("none")), metrics.bound_by(F.lit(1.0), F.lit(-1.0))).first()
    assert tuple(row) == (None, 2.5, 1234.5, -1.0, "unknown")
    status = spark.createDataFrame([("processed",), ("error",), ("processed",)], "status string")
    assert metrics.outcome_counts(status).first()[:] == (2, 0, 1)
