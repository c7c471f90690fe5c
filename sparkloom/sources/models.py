"""Language and embedding models behind a local model server, and the calls that Spark's workers make to any model.

A model is a callable that takes a request, a dictionary with ``messages``, ``temperature`` and ``seed``, and gives the text of
its reply; an embedder takes a text and gives its vector.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..store import path_exists, written

Model = Callable[[dict], str]
Embedder = Callable[[str], list[float]]
Prompt = Callable[[dict], list[dict]]
#: What a call that fails in the end gives.
NOTHING = '{"items": []}'
VECTORS = "key string, model string, vector array<double>"


class Refused(Exception):
    """The server took a request for wrong; asking again would not help."""


@dataclass(frozen=True)
class Server:
    """A model of a server that speaks JSON over HTTP under /api/chat, /api/embeddings and /api/tags."""

    url: str
    model: str
    timeout: float = 300.0

    def _post(self, path: str, body: dict | None = None) -> dict:
        data = None if body is None else json.dumps(body).encode()
        request = urllib.request.Request(self.url.rstrip("/") + path, data, {"Content-Type": "application/json"})
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as response:
                return json.load(response)
        except urllib.error.HTTPError as error:
            raise Refused(f"{error.code} {error.reason}") from error

    def __call__(self, request: dict) -> str:
        options = {"temperature": request.get("temperature", 0.0)} | ({} if request.get("seed") is None else {"seed": int(request["seed"])})
        reply = self._post("/api/chat", {"model": self.model, "messages": request["messages"], "format": "json", "stream": False, "think": False, "options": options})
        return reply.get("message", {}).get("content", "")

    def embed(self, text: str) -> list[float]:
        return [float(x) for x in self._post("/api/embeddings", {"model": self.model, "prompt": text}).get("embedding") or []]

    def listing(self) -> dict:
        return self._post("/api/tags")


def model_names(listing: object) -> set[str]:
    """Names in a listing, a dictionary or an object with ``models``, with and without what follows a colon."""
    entries = listing.get("models") if isinstance(listing, dict) else getattr(listing, "models", None)
    names: set[str] = set()
    for entry in entries if isinstance(entries, (list, tuple)) else ():
        read = entry.get if isinstance(entry, dict) else lambda key, e=entry: getattr(e, key, None)
        if found := read("model") or read("name"):
            names |= {str(found), str(found).split(":", 1)[0]}
    return names


def check_model(listing: Callable[[], object], model: str) -> None:
    """An error if the server does not answer or does not have the model."""
    try:
        names = model_names(listing())
    except Exception as error:
        raise RuntimeError(f"the model server does not answer: {error}") from error
    if not {model, model.split(":", 1)[0]} & names:
        raise RuntimeError(f"no model {model}; there are: {', '.join(sorted(names)) or 'none'}")


def ask(model: Model, request: dict, retries: int, backoff: float) -> str:
    for attempt in range(1, retries + 1):
        try:
            return model(request)
        except Refused:
            break
        except Exception:  # noqa: BLE001  whatever a model's client raises
            if attempt < retries:
                time.sleep(backoff * attempt)
    return NOTHING


def replies(requests: DataFrame, model: Model, prompt: Prompt, temperature: float = 0.2, retries: int = 3, backoff: float = 2.0) -> DataFrame:
    """``requests`` with the model's reply to ``prompt`` of each row, under the row's ``seed`` if it has one.

    A refused request gives nothing at once; a call that fails otherwise is tried again after a pause. Write the result
    before using it twice: a lost task asks again.
    """

    def run(batches: Iterator) -> Iterator:
        for pdf in batches:
            rows = [{k: v.tolist() if hasattr(v, "tolist") else v for k, v in r.items()} for r in pdf.to_dict("records")]
            yield pdf.assign(reply=[ask(model, r | {"messages": prompt(r), "temperature": temperature, "seed": r.get("seed")}, retries, backoff) for r in rows])

    return requests.mapInPandas(run, StructType([*requests.schema.fields, StructField("reply", StringType())]))


def embedded(rows: DataFrame, embedder: Embedder, key: str, text: str, model: str = "", cache: str | None = None) -> DataFrame:
    """(key, vector) of each different ``key`` of ``rows``; a text that cannot be embedded has an empty vector.

    ``cache`` is a folder with the vectors of earlier runs by key and model, to which new ones are added; empty ones are not
    kept there, so that they are tried again.
    """
    spark = rows.sparkSession
    wanted = rows.select(F.col(key).cast("string").alias("key"), F.col(text).alias("content")).dropDuplicates(["key"])
    known = None
    if cache and path_exists(spark, cache):
        known = spark.read.schema(VECTORS).parquet(cache).where(F.col("model") == model).dropDuplicates(["key"]).select("key", "vector")
        wanted = wanted.join(known, "key", "left_anti")

    def run(batches: Iterator) -> Iterator:
        for pdf in batches:
            vectors = []
            for content in pdf["content"]:
                try:
                    vectors.append([float(x) for x in embedder(content or "")])
                except Exception:  # noqa: BLE001  whatever an embedder's client raises
                    vectors.append([])
            yield pdf.assign(vector=vectors)[["key", "vector"]]

    new = written(wanted.mapInPandas(run, "key string, vector array<double>"), "vectors")
    if cache:
        new.where(F.size("vector") > 0).select("key", F.lit(model).alias("model"), "vector").write.mode("append").parquet(cache)
    every = new if known is None else new.unionByName(written(known, "vectors-known"))
    return every.withColumnRenamed("key", key)
