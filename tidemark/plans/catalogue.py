"""The engine's operators as queries over the driver's tables, each with SQL that gives the same rows.

The tables hold no audio: a document's text stands for a payload, an embedding for a window of samples, the values of a
user's events for a signal, labels for what a store has seen.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import hashing, spectral
from tidemark.functions.wav import with_header
from tidemark.operators import anomaly, dedup, metrics
from tidemark.plans import modes
from tidemark.session import work_folder
from tidemark.sources import recordings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
BATCH, WINDOW = 64, 64


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "n_chars", "source", hashing.sha256_hex(F.col("text")).alias("sha256"))


def spectra(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", spectral.dft_magnitudes(F.col("embedding"), WINDOW).alias("mag"))


def little_endian(value, size: int):
    """Hexadecimal digits of an integer's lowest bytes, the least first."""
    return F.concat(*(F.lpad(F.hex(F.pmod(F.floor(value / 256**k), F.lit(256))), 2, "0") for k in range(size)))


def payload(embedding: str = "embedding"):
    """The embedding as 16-bit samples."""
    return F.unhex(F.array_join(F.transform(embedding, lambda x: little_endian(spectral.pcm16(x.cast("double")).cast("int"), 2)), ""))


def engine_spectra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As spectra, by the engine's own transform of 16-bit samples."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", spectral.magnitude_bytes(payload(), WINDOW, 32_767.0).alias("mag_bytes"))
    return rows.select("vec_id", spectral.floats_of(F.col("mag_bytes")).alias("mag"))


#: Bins of every window, for the queries below.
BINS = """with e as (select vec_id, label, unnest(embedding)::double as x, generate_subscripts(embedding, 1) - 1 as n from embeddings),
g as (select vec_id, k, sum(x * cos(2 * pi() / 64 * ((k * n) % 64))) as re, sum(x * sin(2 * pi() / 64 * ((k * n) % 64))) as im from e cross join range(33) r(k) group by all),
m as (select vec_id, cast(k as integer) as k, sqrt(re * re + im * im) as mag from g)
"""
#: The same of 16-bit samples.
SAMPLED = BINS.replace("unnest(embedding)::double", "trunc(greatest(-1.0, least(1.0, unnest(embedding)::double)) * 32767) / 32767.0")



@query("select doc_id, sha256(text) as sha256 from documents")
def content_sha256(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashed(spark, sf_dir).select("doc_id", "sha256")


@query("""select doc_id, cast(cast('0x' || substr(sha256(text), 1, 16) as ubigint) as varchar) as w0, cast(cast('0x' || substr(sha256(text), 49, 16) as ubigint) as varchar) as w3,
sha256(text) as again from documents""")
def digest_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = hashed(spark, sf_dir).select("doc_id", hashing.words_of_sha256(F.col("sha256")).alias("w"))
    return words.select("doc_id", F.col("w")[0].cast("string").alias("w0"), F.col("w")[3].cast("string").alias("w3"), hashing.hex_of_words(F.col("w")).alias("again"))


@query("select min(doc_id) as doc_id, sha256(text) as sha256 from documents group by 2")
def first_seen_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.first_seen(hashed(spark, sf_dir).select("doc_id", "sha256"), "sha256", "doc_id")


@query("select count(*) as n_rows, count(distinct sha256(text)) as n_keys, count(*) - count(distinct sha256(text)) as n_duplicates from documents")
def dedup_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = hashed(spark, sf_dir).groupBy("sha256").agg(F.count("*").alias("n"))
    return each.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_keys"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"))


@query("select user_id, event_type, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') as last_seen from events group by 1, 2")
def last_seen_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup.last_seen(table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts")
    return rows.select("user_id", "event_type", F.date_format("last_seen", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_seen"))


@query("select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') as iso from events")
def iso_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", hashing.iso_time(F.col("ts")).alias("iso"))


@query("select doc_id, n_chars from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)")
def unseen_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.unseen(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), table(spark, sf_dir, "labels"), "doc_id")


@query("select doc_id, n_chars from documents d where exists (select 1 from labels l where l.doc_id = d.doc_id)")
def seen_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.seen(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), table(spark, sf_dir, "labels"), "doc_id")


@query("select doc_id, doc_id in (select doc_id from labels) as found from documents")
def keys_exist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exists(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id")


@query("select d.doc_id, l.quality, l.toxic from documents d left join labels l on d.doc_id = l.doc_id")
def store_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.look_up(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id")


@query("""with p as (select doc_id, sha256(text) as sha256, (row_number() over (order by doc_id) - 1) // 64 + 1 as batch from documents),
f as (select *, min(batch) over (partition by sha256) as first_batch from p)
select doc_id, batch from f where batch = first_batch and doc_id not in (select doc_id from labels)""")
def batch_scoped_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup.numbered(hashed(spark, sf_dir).select("doc_id", "sha256"), "doc_id")
    rows = dedup.batch_scoped(rows.withColumn("batch", dedup.batch_of(F.col("place"), BATCH)), "sha256")
    return dedup.unseen(rows, table(spark, sf_dir, "labels"), "doc_id").select("doc_id", "batch")


@query("""with p as (select n_chars, (row_number() over (order by doc_id) - 1) // 64 + 1 as batch from documents)
select batch, count(*) as files, cast(sum(n_chars) as bigint) as chars, round(count(*) / nullif(sum(n_chars) / 1000.0, 0), 6) as rate from p group by batch""")
def batch_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup.numbered(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id").withColumn("batch", dedup.batch_of(F.col("place"), BATCH))
    each = rows.groupBy("batch").agg(F.count("*").alias("files"), F.sum("n_chars").alias("chars"))
    return each.withColumn("rate", F.round(metrics.rate(F.col("files"), F.col("chars") / 1000.0), 6))


@query("""with p as (select (row_number() over (order by doc_id) - 1) // 64 + 1 as batch, n_chars from documents), b as (select batch, count(*) as files, max(n_chars) as ms from p group by 1)
select cast(sum(files) as bigint) as total_files, cast(sum(ms) as bigint) as total_duration_ms, round(avg(ms), 6) as avg_batch_duration_ms, round(sum(files) / (sum(ms) / 1000.0), 6) as throughput_files_per_sec from b""")
def profile_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup.numbered(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id").withColumn("batch", dedup.batch_of(F.col("place"), BATCH))
    out = metrics.batch_durations(rows, "batch", "n_chars")
    return out.select("total_files", "total_duration_ms", *(F.round(c, 6).alias(c) for c in ("avg_batch_duration_ms", "throughput_files_per_sec")))


@query("""with s as (select case when n_chars < 200 then 'error' when doc_id in (select doc_id from labels) then 'skipped' else 'processed' end as status from documents)
select count(*) filter (status = 'processed') as processed, count(*) filter (status = 'skipped') as skipped, count(*) filter (status = 'error') as error from s""")
def outcome_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup.exists(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), table(spark, sf_dir, "labels"), "doc_id")
    return metrics.outcome_counts(rows.withColumn("status", F.when(F.col("n_chars") < 200, "error").when(F.col("found"), "skipped").otherwise("processed")))


@query(BINS + "select vec_id, k, round(mag, 6) as mag from m")
def dft_magnitude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spectra(spark, sf_dir).select("vec_id", F.posexplode("mag").alias("k", "mag")).select("vec_id", "k", F.round("mag", 6).alias("mag"))


@query(BINS + "select vec_id, k // 4 as j, round(cast(cast(ln(1 + mag) as float) as double), 4) as value from m where k < 16 and k % 4 = 0")
def band_stride_log1p(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spectra(spark, sf_dir).select("vec_id", F.posexplode(spectral.preprocess(F.col("mag"), bin_max=16, factor=4)).alias("j", "value"))
    return rows.select("vec_id", "j", F.round(F.col("value").cast("double"), 4).alias("value"))


@query(BINS + "select vec_id, round(max(mag) filter (k between 5 and 15), 6) as peak, round(max(mag) filter (k between 25 and 32), 6) as edge_peak from m group by 1")
def peak_in_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = lambda at: F.round(spectral.peak_near(F.col("mag"), F.lit(at)), 6)
    return spectra(spark, sf_dir).select("vec_id", near(10).alias("peak"), near(30).alias("edge_peak"))


@query(SAMPLED + "select vec_id, arg_max(k, mag) as k from m group by 1")
def argmax_bin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engine_spectra(spark, sf_dir).select("vec_id", spectral.loudest_bin(F.col("mag")).cast("int").alias("k"))


@query(SAMPLED + "select vec_id, max(mag) filter (k = 8) > 2 * avg(mag) as stands_out from m group by 1")
def energy_over_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engine_spectra(spark, sf_dir).select("vec_id", spectral.stands_out(F.col("mag"), F.lit(8)).alias("stands_out"))


@query(BINS + "select a.vec_id, round(max(abs(a.mag - b.mag)), 6) as difference from m a join m b on b.vec_id = a.vec_id + 1 and a.k = b.k group by 1")
def spectrum_max_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = spectra(spark, sf_dir).select("vec_id", "mag")
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), F.col("mag").alias("next"))
    return a.join(b, "vec_id").select("vec_id", F.round(spectral.max_difference(F.col("mag"), F.col("next")), 6).alias("difference"))


@query("""with p as (select vec_id, row_number() over (order by vec_id) as place, count(*) over () as n from embeddings)
select vec_id, case when place <= n - greatest(1, n // 5) then 'train' else 'validation' end as part from p""")
def ordered_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.ordered_split(table(spark, sf_dir, "embeddings").select("vec_id"), "vec_id")


ERRORS = """with e as (select vec_id, label, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as n from embeddings),
c as (select label, n, avg(x) as y from e group by 1, 2), r as (select vec_id, avg((x - y) * (x - y)) as error from e join c using (label, n) group by 1)
"""


def errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance of each embedding from the mean of its label."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    mean = rows.select("label", F.posexplode("embedding").alias("n", "x")).groupBy("label", "n").agg(F.avg(F.col("x").cast("double")).alias("y"))
    center = mean.groupBy("label").agg(F.transform(F.sort_array(F.collect_list(F.struct("n", "y"))), lambda s: s["y"]).alias("center"))
    return rows.join(center, "label").select("vec_id", anomaly.mse(F.col("embedding"), F.col("center")).alias("error"))


@query(ERRORS + "select vec_id, round(error, 6) as error from r")
def recon_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return errors(spark, sf_dir).select("vec_id", F.round("error", 6).alias("error"))


@query(ERRORS + "select vec_id, error > (select avg(error) + 2 * stddev_samp(error) from r) as anomaly from r")
def threshold_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = errors(spark, sf_dir)
    return anomaly.flag(rows, anomaly.threshold_of(rows)).select("vec_id", "anomaly")


@query(ERRORS + ", f as (select error > (select avg(error) + 2 * stddev_samp(error) from r) as a from r) select count(*) as total, count(*) filter (not a) as normal, count(*) filter (a) as anomalies from f")
def anomaly_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly.summary(threshold_flag(spark, sf_dir))


@query("select hz, cast(floor(hz * 65536.0 / 44100) as bigint) as bin from (values (0), (40), (80), (1350), (5000), (22050)) v(hz)")
def hz_to_bin(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame([(x,) for x in (0, 40, 80, 1350, 5000, 22050)], "hz int")
    return rows.select("hz", spectral.hz_to_bin(F.col("hz"), 65_536, 44_100).alias("bin"))


@query("select * from (values (64), (128), (256), (512)) a(threads), (values (256), (512), (1024), (2048)) b(batch), (values (4096), (8192), (16384), (65536)) c(fft_size)")
def param_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.sweep(spark, threads=[64, 128, 256, 512], batch=[256, 512, 1024, 2048], fft_size=[4096, 8192, 16_384, 65_536])


@query("""select vec_id, cast(generate_subscripts(embedding, 1) - 1 as integer) as n, cast(trunc(greatest(-1.0, least(1.0, unnest(embedding)::double)) * 32767) as integer) as sample from embeddings""")
def pcm16_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = F.transform("embedding", lambda x: spectral.pcm16(x.cast("double")))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(samples).alias("n", "sample")).select("vec_id", "n", F.col("sample").cast("int").alias("sample"))


@query("""with e as (select vec_id, unnest(embedding)::double as x, generate_subscripts(embedding, 1) - 1 as n from embeddings), t as (select vec_id, max(abs(x)) as top from e group by 1)
select vec_id, cast(n as integer) as n, round(x / top, 6) as value from e join t using (vec_id)""")
def peak_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.transform("embedding", lambda v: v.cast("double"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", x.alias("x")).select("vec_id", F.posexplode(spectral.peak_normalised(F.col("x"))).alias("n", "value"))
    return rows.select("vec_id", "n", F.round("value", 6).alias("value"))


@query("""with e as (select vec_id, unnest(embedding)::double as x, generate_subscripts(embedding, 1) - 1 as n from embeddings)
select vec_id, cast(arg_min(n, abs(x - 0.1)) as integer) as n from e group by 1""")
def nearest_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.transform("embedding", lambda v: v.cast("double"))
    return table(spark, sf_dir, "embeddings").select("vec_id", x.alias("x")).select("vec_id", spectral.nearest(F.col("x"), F.lit(0.1)).cast("int").alias("n"))


@query("""with p as (select user_id, value, row_number() over (partition by user_id order by ts, event_id) - 1 as n from events), u as (select distinct user_id from events)
select u.user_id, cast(r.n as integer) as n, coalesce(p.value, 0) as value from u cross join range(64) r(n) left join p on p.user_id = u.user_id and p.n = r.n""")
def event_signal_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    # ranks are cut before values are listed, so that a list never holds more than one window
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    rows = table(spark, sf_dir, "events").withColumn("n", place).where(F.col("n") <= WINDOW)
    listed = F.transform(F.sort_array(F.collect_list(F.struct("n", "value"))), lambda s: s["value"])
    signal = rows.groupBy("user_id").agg(listed.alias("x"))
    padded = F.concat("x", F.array_repeat(F.lit(0.0), F.lit(WINDOW) - F.size("x")))
    return signal.select("user_id", F.posexplode(padded).alias("n", "value")).select("user_id", "n", F.coalesce("value", F.lit(0.0)).alias("value"))


@query("select doc_id, source from documents where source = 'src0' union all select doc_id, source from documents where n_chars < 500")
def producer_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    both = recordings.union_of_producers(rows.where("source = 'src0'"), rows.where("n_chars < 500"))
    return both.select("doc_id", "source")


@query("select doc_id from documents where doc_id % 3 = 0")
def name_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat("source", F.when(F.col("doc_id") % 3 == 0, "_Clean_").otherwise("_other_"), F.col("doc_id").cast("string"))
    return anomaly.clean_rows(table(spark, sf_dir, "documents").select("doc_id", name.alias("key"))).select("doc_id")


@query("""select cast(vec_id as varchar) as key, j.j, round(cast(cast(ln(1 + embedding[1 + 32 * j.j]) as float) as double), 4) as value
from embeddings, range(2) j(j) where vec_id % 2 = 0 and embedding[1 + 32 * j.j] > -1""")
def expected_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of a store of spectra, of which those of the expected length count."""
    store = modes.spectrum_store(spark, f"{work_folder(spark)}/lengths-{uuid.uuid4().hex}")
    whole = F.when(F.col("vec_id") % 2 == 0, F.col("embedding")).otherwise(F.slice("embedding", 1, 60))
    now = F.current_timestamp()
    store.set(table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("xxhash"), F.lit(126).alias("fft_size"), whole.alias("magnitudes"), F.lit(False).alias("consumed"), now.alias("first_seen"), now.alias("last_seen")
    ))
    rows = modes.features_of_store(spark, store, 126, sample_rate=126, max_hz=64)
    rows = rows.select("key", F.posexplode("features").alias("j", "value")).where("value is not null and not isnan(value)")
    return rows.select("key", F.col("j").cast("long").alias("j"), F.round(F.col("value").cast("double"), 4).alias("value"))


@query("""select id, case when c < 0 or m < 0 then 'unknown' when c > m then 'compute' else 'memory' end as bound
from (values (1, 80.0, 20.0), (2, 20.0, 80.0), (3, 50.0, 50.0), (4, -1.0, 3.0)) v(id, c, m)""")
def kernel_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame([(1, 80.0, 20.0), (2, 20.0, 80.0), (3, 50.0, 50.0), (4, -1.0, 3.0)], "id int, c double, m double")
    return rows.select("id", metrics.bound_by(F.col("c"), F.col("m")).alias("bound"))


@query("select event_id, floor(value * 100) / 100 as last, cast(event_id as double) as first, -1.0::double as none from events")
def report_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a line of a profiler's report; numbers have thousands separated, names hold digits that do not count."""
    value = F.format_number(F.floor(F.col("value") * 100) / 100, 2)
    line = F.concat(F.lit("  "), F.col("event_id").cast("string"), F.lit(" sm80__calls, Duration  usecond   "), value)
    rows = table(spark, sf_dir, "events").select("event_id", line.alias("line"))
    number = metrics.number_in
    return rows.select("event_id", number(F.col("line")).alias("last"), number(F.col("line"), last=False).alias("first"), number(F.lit("sm80__calls v2")).alias("none"))


@query("""select source as file, cast(case when source >= 'src5' then max(doc_id) else min(doc_id) end as varchar) as sha256 from documents group by source""")
def manifest_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two manifests, of all sources and of some, whose entries win."""
    rows = table(spark, sf_dir, "documents").groupBy("source").agg(F.min("doc_id").cast("string").alias("least"), F.max("doc_id").cast("string").alias("most"))
    manifest = lambda of, value: of.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("source", value))))).first()[0]
    return recordings.read_manifest(spark, recordings.merge_manifests(manifest(rows, "least"), manifest(rows.where("source >= 'src5'"), "most")))


@query("""select vec_id, 8000 + vec_id as sample_rate, (2 * (1 + vec_id % 30)) // (1 + vec_id % 2) as num_samples, cast(1 + vec_id % 2 as integer) as num_channels, 16 as bit_depth,
44 + 8 * (vec_id % 3) as data_offset, 4 * (1 + vec_id % 30) as data_size from embeddings""")
def wav_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding as a recording with a rate, channels, a length and other chunks of its own; its header is then parsed."""
    number, size = F.col("vec_id"), 4 * (1 + F.col("vec_id") % 30)
    text = lambda s: F.lit(s.encode().hex())
    le = little_endian
    channels, others = 1 + number % 2, number % 3
    head = F.concat(
        text("RIFF"), le(36 + 8 * others + size, 4), text("WAVEfmt "), le(F.lit(16), 4), le(F.lit(1), 2), le(channels, 2), le(8000 + number, 4),
        le((8000 + number) * 2 * channels, 4), le(2 * channels, 2), le(F.lit(16), 2), F.repeat(F.concat(text("none"), le(F.lit(0), 4)), others.cast("int")), text("data"), le(size, 4),
    )
    samples = F.substring(F.concat(payload(), F.unhex(F.repeat(F.lit("00"), 128))), F.lit(1), size.cast("int"))
    files = table(spark, sf_dir, "embeddings").select("vec_id", F.concat(F.unhex(head), samples).alias("content"))
    files = files.withColumn("length", F.length("content").cast("long"))
    return with_header(files).select("vec_id", *(f"header.{c}" for c in ("sample_rate", "num_samples", "num_channels", "bit_depth", "data_offset", "data_size")))


@query()
def spectrum_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spectra by key: xxHash64 with seed 0 of the single-precision magnitudes of each embedding; SQL has no such hash."""
    rows = table(spark, sf_dir, "embeddings")
    mags = rows.select("vec_id", spectral.magnitude_bytes(payload(), WINDOW, 32_767.0).alias("mag_bytes"))
    keyed = mags.select("vec_id", hashing.xxh64_hex(spark, F.col("mag_bytes")).alias("xxhash"))
    return dedup.distinct_by(keyed, "xxhash", "vec_id")


@query("select distinct sha256(text) as sha256 from documents")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as a stream, deduplicated by content over all micro-batches."""
    from tidemark.streaming.ingest import distinct_stream

    schema = table(spark, sf_dir, "documents").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/documents.parquet*")
    keys = distinct_stream(rows.select(hashing.sha256_hex(F.col("text")).alias("sha256")), "sha256")
    at = f"{work_folder(spark)}/stream-{uuid.uuid4().hex}"
    keys.writeStream.trigger(availableNow=True).format("parquet").option("checkpointLocation", f"{at}/checkpoint").start(f"{at}/keys").awaitTermination()
    return spark.read.schema("sha256 string").parquet(f"{at}/keys")
