"""Embedding of texts with a pluggable model, a cache keyed by content, and the index table."""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext, cloudpickle
from pyspark.resource import ResourceProfile, ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators.cache import BUCKETS, Cache

PREFIXES = {"passage": "passage: ", "query": "query: "}


def hashed_ngrams(dimension: int = 256, n: int = 3) -> Callable[[list[str]], np.ndarray]:
    """A deterministic stand-in for a model: signed hashes of character n-grams. It compares spelling, not meaning."""

    def encode(texts: list[str]) -> np.ndarray:
        padded = [f" {text.lower()} " for text in texts]
        together, size = "".join(padded), np.fromiter(map(len, padded), np.int64, len(padded))
        points = np.frombuffer(together.encode("utf-32-le"), np.uint32).astype(np.uint64)
        row = np.repeat(np.arange(len(texts)), size)
        at = np.flatnonzero(np.arange(len(points)) + n <= np.cumsum(size)[row])  # where an n-gram within one text starts
        # an n-gram as a number, 21 bits a character; of longer ones the first characters' rank stands for them
        gram = points[at]
        for k in range(1, n):
            gram = (np.unique(gram, return_inverse=True)[1].astype(np.uint64) if k > 2 else gram) << np.uint64(21) | points[at + k]
        _, first, which = np.unique(gram, return_index=True, return_inverse=True)
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(together[a : a + n]) for a in at[first].tolist()), np.uint64, len(first))
        place, sign = (hashes % np.uint64(dimension)).astype(np.int64), np.where(hashes >> np.uint64(63), 1.0, -1.0)
        out = np.bincount(row[at] * dimension + place[which], sign[which], len(texts) * dimension).reshape(-1, dimension).astype(np.float32)
        out[~out.any(axis=1), 0] = 1
        return out

    return encode


Encode = Callable[[list[str]], np.ndarray]


def hashing_loader(device: str, half: bool) -> Encode:
    """The built-in encoder: it runs on any device and has no weights."""
    return hashed_ngrams()


@dataclass(frozen=True)
class EmbeddingModel:
    """A model by name, and how a worker loads it: ``load(device, half)`` gives the function that encodes texts.

    ``device`` is what is asked for: auto, cpu or cuda. Half precision is used on a GPU only.
    """

    name: str = "hashed-3grams-256"
    dimension: int = 256
    load: Callable[[str, bool], Encode] = hashing_loader
    device: str = "auto"
    fp16: bool = True

    @property
    def loading(self) -> tuple[Callable[[str, bool], Encode], str, bool]:
        return self.load, self.device, self.fp16


def named(name: str):
    """What ``module:attribute`` names."""
    module, _, attribute = name.partition(":")
    if not attribute:
        raise ValueError(f"{name} is not module:attribute")
    return getattr(importlib.import_module(module), attribute)


def named_model(name: str | None, device: str = "auto", fp16: bool = True) -> EmbeddingModel:
    """The built-in model, or the one that ``module:attribute`` names (a model, or a function that makes one), for a device."""
    model = EmbeddingModel()
    if name and name != model.name:
        found = named(name)
        model = found if isinstance(found, EmbeddingModel) else found()
    return replace(model, device=device, fp16=fp16)


def select_device(requested: str | None, cuda_available: bool) -> str:
    if requested not in (None, "auto", "cpu", "cuda"):
        raise ValueError("device must be auto, cpu or cuda")
    if requested == "cuda" and not cuda_available:
        raise RuntimeError("cuda was asked for but is not available")
    return requested if requested in ("cpu", "cuda") else "cuda" if cuda_available else "cpu"


def gpus_of(spark: SparkSession) -> int:
    """GPUs that the session's executors are said to have."""
    return int(spark.conf.get("spark.executor.resource.gpu.amount", "0"))


def gpu_profile(spark: SparkSession, requested: str) -> ResourceProfile | None:
    """For encoding on GPUs a profile whose tasks take one each; other stages keep their own."""
    if select_device(requested, gpus_of(spark) > 0) == "cpu" or spark.sparkContext.master.startswith("local["):
        return None
    return ResourceProfileBuilder().require(TaskResourceRequests().cpus(1).resource("gpu", 1)).build


def task_device(requested: str, resources: dict) -> tuple[str, bool]:
    """The device of a task that was given these resources, and whether it is a GPU."""
    held = resources.get("gpu")
    address = held.addresses[0] if held is not None and held.addresses else None
    cuda = select_device(requested, address is not None) == "cuda"
    return (f"cuda:{address}" if cuda else "cpu"), cuda


@lru_cache(maxsize=1)
def _loaded(pickled: bytes, device: str, half: bool) -> Encode:
    """One model for all tasks of a worker process."""
    return cloudpickle.loads(pickled)(device, half)


def prepared(text: Column, kind: str) -> Column:
    if kind not in PREFIXES:
        raise ValueError("kind must be query or passage")
    return F.concat(F.lit(PREFIXES[kind]), F.coalesce(text, F.lit("")))


def content_hash(text: Column, kind: str) -> Column:
    return F.sha2(prepared(text, kind), 256)


def _encode(model: EmbeddingModel, batch_size: int):
    load, requested, fp16 = model.loading
    pickled = cloudpickle.dumps(load)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        device, cuda = task_device(requested, TaskContext.get().resources())
        encode = _loaded(pickled, device, fp16 and cuda)
        for batch in batches:
            for k in range(0, batch.num_rows, batch_size):
                part = batch.slice(k, batch_size)
                vectors = _halving(encode, part.column("_text").to_pylist())
                norm = np.linalg.norm(vectors, axis=1, keepdims=True)
                if (norm == 0).any():
                    raise ValueError("the model made a vector of length 0")
                rows = pa.ListArray.from_arrays(np.arange(len(vectors) + 1, dtype=np.int32) * vectors.shape[1], (vectors / norm).astype(np.float32).ravel())
                yield pa.RecordBatch.from_arrays([part.column("content_hash"), rows], names=["content_hash", "vector"])

    return run


def _halving(encode: Encode, texts: list[str]) -> np.ndarray:
    """Encode; on lack of memory, the device's too, in halves, down to one text."""
    try:
        return np.asarray(encode(texts), dtype=np.float32)
    except Exception as error:
        lack = isinstance(error, MemoryError) or type(error).__name__ == "OutOfMemoryError"
        if len(texts) == 1 or not lack:
            raise
        half = len(texts) // 2
        return np.concatenate([_halving(encode, texts[:half]), _halving(encode, texts[half:])])


def cache_misses(texts: DataFrame, cache: DataFrame | None, model_name: str, kind: str, text: str = "texto") -> DataFrame:
    """content_hash, _text of the different texts that the cache (model, kind, content_hash, dimension, vector) lacks."""
    wanted = texts.select(content_hash(F.col(text), kind).alias("content_hash"), prepared(F.col(text), kind).alias("_text")).dropDuplicates(["content_hash"])
    if cache is None:
        return wanted
    return wanted.join(cache.where((F.col("model") == model_name) & (F.col("kind") == kind)).select("content_hash"), "content_hash", "left_anti")


def cache_rows(encoded: DataFrame, model_name: str, kind: str) -> DataFrame:
    return encoded.select(F.lit(model_name).alias("model"), F.lit(kind).alias("kind"), "content_hash", F.size("vector").alias("dimension"), "vector")


def embedding_cache(path: str, buckets: int = BUCKETS) -> Cache:
    return Cache(path, ("model", "kind", "content_hash"), "model string, kind string, content_hash string, dimension int, vector array<float>", buckets)


def encode_misses(texts: DataFrame, model: EmbeddingModel, kind: str = "passage", text: str = "texto", batch_size: int = 32, cache: DataFrame | None = None) -> DataFrame:
    """Cache rows of the different texts that the cache lacks."""
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    missed = cache_misses(texts, cache, model.name, kind, text)
    return cache_rows(missed.mapInArrow(_encode(model, batch_size), "content_hash string, vector array<float>", profile=gpu_profile(texts.sparkSession, model.device)), model.name, kind)


def embed_through(texts: DataFrame, model: EmbeddingModel, cache: Cache, kind: str = "passage", text: str = "texto", batch_size: int = 32) -> DataFrame:
    """``embed`` through a cache that keeps what is encoded: misses are put first, and then all is read."""
    cache.put(encode_misses(texts, model, kind, text, batch_size, cache.read(texts.sparkSession)))
    return embed(texts, model, kind, text, batch_size, cache.read(texts.sparkSession))


def embed(texts: DataFrame, model: EmbeddingModel, kind: str = "passage", text: str = "texto", batch_size: int = 32, cache: DataFrame | None = None) -> DataFrame:
    """The rows with their ``embedding``; equal texts are encoded once, cached ones not at all."""
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    new = encode_misses(texts, model, kind, text, batch_size, cache)
    known = new if cache is None else cache.select(*new.columns).unionByName(new)
    known = known.where((F.col("model") == model.name) & (F.col("kind") == kind)).select(F.col("content_hash").alias("_hash"), F.col("vector").alias("embedding"))
    keyed = texts.withColumn("_hash", content_hash(F.col(text), kind))
    return keyed.join(known, "_hash").drop("_hash")


def config(model: EmbeddingModel, cuda_available: bool = False) -> dict:
    device = select_device(model.device, cuda_available)
    dtype = "float16" if model.fp16 and device == "cuda" else "float32"
    return {"model": model.name, "requested_device": model.device, "build_device": device, "dtype": dtype, "dimension": model.dimension, "normalized": True, "similarity": "inner_product", "index_type": "flat", "prefixes": PREFIXES}


def build_index(chunks: DataFrame, path: str, model: EmbeddingModel, batch_size: int = 32, cache: Cache | None = None) -> dict:
    """Write chunks (chunk_ord, chunk_id, doc_id, texto, ...) with their vectors, and the configuration beside them."""
    began = time.time()
    spark = chunks.sparkSession
    embedded = embed(chunks, model, batch_size=batch_size) if cache is None else embed_through(chunks, model, cache, batch_size=batch_size)
    embedded.write.mode("overwrite").parquet(f"{path}/chunks")
    written = config(model, gpus_of(spark) > 0) | {"chunks": spark.read.parquet(f"{path}/chunks").count(), "batch_size_requested": batch_size, "build_seconds": round(time.time() - began, 2)}
    spark.createDataFrame([(json.dumps(written),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/config")
    return written


def open_index(spark: SparkSession, path: str, model: EmbeddingModel) -> DataFrame:
    """The index table, if it was made with this model, dimension and prefixes."""
    held = json.loads(spark.read.text(f"{path}/config", wholetext=True).first()["value"])
    for name, wanted in (("model", model.name), ("dimension", model.dimension), ("prefixes", PREFIXES)):
        if held.get(name) != wanted:
            raise ValueError(f"the index has {name} {held.get(name)}, not {wanted}")
    return spark.read.parquet(f"{path}/chunks")
