"""What runs outside of Spark: downloads, plate service, detectors. Each is a function given by the caller.

A client is made once a partition, a model once for each worker and device. Failures become a status, never an exception of the job.
"""

from __future__ import annotations

import inspect
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.resource import ResourceProfile, ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_retries(call: Callable[[], object], tries: int = 3, wait: float = 1.0) -> tuple[object, str | None]:
    """(result, error) of a call that is tried again after a linearly growing wait."""
    error = None
    for k in range(tries):
        try:
            return call(), None
        except Exception as e:  # noqa: BLE001  what a client raises is its own affair
            error = f"{type(e).__name__}: {e}"
            if k + 1 < tries:
                time.sleep(wait * (k + 1))
    return None, error


def fetch(urls: DataFrame, make_client: Callable[[], Callable[[str], bytes]], tries: int = 3, wait: float = 1.0, partitions: int = 32) -> DataFrame:
    """(url, status, error, content): ok, or error for failures and empty bodies."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for frame in frames:
            rows = []
            for url in frame["url"]:
                body, error = with_retries(lambda u=url: client(u), tries, wait)
                if error is None and not body:
                    error = "empty body"
                rows.append((url, "error" if error else "ok", error, None if error else bytes(body)))
            yield pd.DataFrame(rows, columns=["url", "status", "error", "content"])

    return urls.select("url").repartition(partitions).mapInPandas(run, "url string, status string, error string, content binary")


def ask_service(crops: DataFrame, make_client: Callable[[], Callable[[bytes], str]], key: str = "image", tries: int = 3, wait: float = 1.0) -> DataFrame:
    """(key, payload, api_error): the JSON that a service gives for each ``content``; null after failures."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for frame in frames:
            got = [with_retries(lambda c=c: client(bytes(c)), tries, wait) for c in frame["content"]]
            yield pd.DataFrame({key: frame[key], "payload": [g[0] for g in got], "api_error": [g[1] for g in got]})

    return crops.select(key, "content").mapInPandas(run, f"{key} {crops.schema[key].dataType.simpleString()}, payload string, api_error string")


#: Models of this worker process, by their maker and device: a worker that serves several tasks loads one once.
_MODELS: dict[tuple[str, str | None], Callable[[list[bytes]], list[list[tuple]]]] = {}
_BOX = ("x1", "y1", "x2", "y2", "conf", "cls")
DETECTIONS = "array<struct<x1: double, y1: double, x2: double, y2: double, conf: double, cls: int>>"


def gpu_profile(gpus: float = 1.0, cpus: int = 1) -> ResourceProfile:
    """A profile for ``infer``: what each task needs. Executors must offer GPUs (``spark.executor.resource.gpu.amount``)."""
    return ResourceProfileBuilder().require(TaskResourceRequests().cpus(cpus).resource("gpu", gpus)).build


def _device() -> str | None:
    """The address of the task's GPU; None without one."""
    gpu = TaskContext.get().resources().get("gpu")
    return gpu.addresses[0] if gpu else None


def _model(make_model: Callable) -> Callable[[list[bytes]], list[list[tuple]]]:
    name = (f"{make_model.__module__}:{make_model.__qualname__}", device := _device())
    if name not in _MODELS:
        _MODELS[name] = make_model(device) if inspect.signature(make_model).parameters else make_model()
    return _MODELS[name]


def infer(images: DataFrame, make_model: Callable, key: str = "image", batch: int = 64, profile: ResourceProfile | None = None, barrier: bool = False) -> DataFrame:
    """(key, error, boxes): the rows (x1, y1, x2, y2, conf, cls) of a model for each image, in its order.

    ``make_model`` makes a function of a list of contents, once for each worker process and device; if it takes a
    parameter, it gets the address of the task's GPU. Batches are full but for a partition's last one, however
    the rows arrive. A batch that fails is tried image by image, and what fails then is a row with an error.
    With ``profile`` (see ``gpu_profile``) the stage runs on executors and slots of that kind, with ``barrier`` all
    its tasks start together, for models that span several devices.
    """

    def answers(model: Callable, rows: list[tuple]) -> list[tuple]:
        try:
            found = model([c for _, c in rows])
            if len(found) != len(rows):
                raise ValueError(f"{len(found)} answers for {len(rows)} images")
            return [(k, None, [dict(zip(_BOX, (*map(float, d[:5]), int(d[5])))) for d in ds]) for (k, _), ds in zip(rows, found)]
        except Exception as e:  # noqa: BLE001  what a model raises is its own affair
            if len(rows) == 1:
                return [(rows[0][0], f"{type(e).__name__}: {e}", None)]
            return [x for row in rows for x in answers(model, [row])]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _model(make_model)
        waiting: list[tuple] = []
        for frame in frames:
            waiting += [(k, bytes(c)) for k, c in zip(frame[key], frame["content"]) if c is not None]
            while len(waiting) >= batch:
                yield pd.DataFrame(answers(model, waiting[:batch]), columns=[key, "error", "boxes"])
                waiting = waiting[batch:]
        if waiting:
            yield pd.DataFrame(answers(model, waiting), columns=[key, "error", "boxes"])

    kind = images.schema[key].dataType.simpleString()
    return images.select(key, "content").mapInPandas(run, f"`{key}` {kind}, error string, boxes {DETECTIONS}", barrier, profile)


def detect(images: DataFrame, make_model: Callable, key: str = "image", batch: int = 64, **how) -> DataFrame:
    """(key, det_idx, x1, y1, x2, y2, conf, cls): the detections of ``infer``; images that fail have none."""
    found = infer(images, make_model, key, batch, **how).where("error IS NULL")
    return found.select(key, F.posexplode("boxes").alias("det_idx", "d")).select(key, "det_idx", *[F.col(f"d.{c}").alias(c) for c in ("x1", "y1", "x2", "y2", "conf", "cls")])
