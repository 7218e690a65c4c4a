"""Saving and loading a fitted engine as tables, one folder for each save and a manifest of them.

``settings`` holds one JSON row, ``vocab`` the terms, ``weights`` every numeric array in
blocks. All of it is model-sized; the folder can be on any file system Spark can write to.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from windrow.models.kmeans import KMeansFit
from windrow.models.mlp import MlpModel
from windrow.models.numeric import BLOCK
from windrow.models.pca import PcaModel
from windrow.models.svm import SvmModel
from windrow.operators.tfidf import TfidfModel
from windrow.plans.engine import Engine, Params
from windrow.taxonomy import Labels


def _arrays(e: Engine) -> dict[str, np.ndarray]:
    out = {"km_slow": e.kmeans_slow.centers, "km_fast": e.kmeans_fast.centers,
           "pca.mean": e.pca.mean, "pca.components": e.pca.components,
           "pca.variance": e.pca.variance, "pca.ratio": e.pca.ratio}
    for name, m in (("svm_slow", e.svm_slow), ("svm_fast", e.svm_fast)):
        out[f"{name}.coef"], out[f"{name}.intercept"] = m.coef, m.intercept
    return out | {f"mlp.{k}": v for k, v in e.mlp.weights.items()}


def _svm_settings(m: SvmModel) -> dict:
    return {"width": m.width, "features": m.features, "gamma": m.gamma, "seed": m.seed,
            "classes": [int(c) for c in m.classes], "pairs": [[int(a), int(b)] for a, b in m.pairs],
            "gaps": m.gaps, "tol": m.tol, "passes": m.passes}


def versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, folder) of every complete save below ``path``, oldest first."""
    try:
        rows = spark.read.schema("number bigint, folder string").json(f"{path}/manifest").collect()
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    return sorted((r["number"], r["folder"]) for r in rows)


def save(engine: Engine, spark: SparkSession, path: str) -> str:
    """Write the engine to a new version folder below ``path`` and return its name.

    One line of the manifest names each version and is written last, so a save that breaks off
    leaves the version before it valid. Old versions stay until somebody deletes them.
    """
    before = versions(spark, path)
    folder = f"version-{uuid.uuid4().hex}"
    _write(engine, spark, f"{path}/{folder}")
    line = spark.createDataFrame([((before[-1][0] if before else 0) + 1, folder)], "number bigint, folder string")
    line.coalesce(1).write.mode("append").json(f"{path}/manifest")
    return folder


def _write(engine: Engine, spark: SparkSession, path: str) -> None:
    settings = {
        "labels": asdict(engine.labels), "params": asdict(engine.params),
        "tfidf": {"stop": list(engine.tfidf.stop), "ngrams": list(engine.tfidf.ngrams), "n_rows": engine.tfidf.n_rows},
        "svm_slow": _svm_settings(engine.svm_slow), "svm_fast": _svm_settings(engine.svm_fast),
        "mlp": {"n1": engine.mlp.n1, "n2": engine.mlp.n2, "losses": engine.mlp.losses},
        "km_slow": [engine.kmeans_slow.cost, engine.kmeans_slow.costs, engine.kmeans_slow.converged, engine.kmeans_slow.passes],
        "km_fast": [engine.kmeans_fast.cost, engine.kmeans_fast.costs, engine.kmeans_fast.converged, engine.kmeans_fast.passes],
        "pca_converged": engine.pca.converged, "lemmas": engine.lemma_map,
    }
    rows = []
    for name, a in _arrays(engine).items():
        flat = np.asarray(a, dtype=np.float64).ravel()
        for b in range(0, max(1, len(flat)), BLOCK):
            rows.append((name, [int(x) for x in a.shape], b // BLOCK, bytearray(flat[b : b + BLOCK].tobytes())))
    spark.createDataFrame([(json.dumps(settings),)], "value string").coalesce(1).write.text(f"{path}/settings")
    engine.tfidf.vocab_table(spark).write.parquet(f"{path}/vocab")
    spark.createDataFrame(rows, "name string, shape array<int>, block int, data binary").write.parquet(f"{path}/weights")


def load(spark: SparkSession, path: str, folder: str | None = None) -> Engine:
    """Restore the last complete save below ``path``, or the one named; none raises ``FileNotFoundError``."""
    if folder is None:
        known = versions(spark, path)
        if not known:
            raise FileNotFoundError(f"no saved engine at '{path}'")
        folder = known[-1][1]
    path = f"{path}/{folder}"
    try:
        settings_rows = spark.read.text(f"{path}/settings")
        vocab = spark.read.parquet(f"{path}/vocab").orderBy("term_idx").collect()
        weights = spark.read.parquet(f"{path}/weights").orderBy("name", "block").collect()
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no saved engine at '{path}'") from exc
        raise
    s = json.loads(settings_rows.first()["value"])
    flat: dict[str, list] = {}
    shape: dict[str, list[int]] = {}
    for r in weights:
        flat.setdefault(r["name"], []).append(np.frombuffer(bytes(r["data"]), dtype=np.float64))
        shape[r["name"]] = r["shape"]
    a = {k: np.concatenate(v).reshape(shape[k]) for k, v in flat.items()}

    def svm(name: str) -> SvmModel:
        c = s[name]
        return SvmModel(c["width"], c["features"], c["gamma"], c["seed"], c["classes"],
                        [tuple(p) for p in c["pairs"]], a[f"{name}.coef"], a[f"{name}.intercept"],
                        c["gaps"], c["tol"], c["passes"])

    params = dict(s["params"])
    params["t2_loss_weights"] = {int(k): v for k, v in params["t2_loss_weights"].items()}
    labels = {k: tuple(v) for k, v in s["labels"].items()}
    mlp = {k.split(".")[1]: v.astype(np.float32) for k, v in a.items() if k.startswith("mlp.")}
    return Engine(
        Labels(**labels), Params(**params),
        TfidfModel([r["term"] for r in vocab], [r["idf"] for r in vocab], tuple(s["tfidf"]["stop"]),
                   tuple(s["tfidf"]["ngrams"]), s["tfidf"]["n_rows"]),
        svm("svm_slow"), svm("svm_fast"),
        MlpModel(len(vocab), s["mlp"]["n1"], s["mlp"]["n2"], mlp, s["mlp"]["losses"]),
        KMeansFit(a["km_slow"], *s["km_slow"]), KMeansFit(a["km_fast"], *s["km_fast"]),
        PcaModel(a["pca.mean"], a["pca.components"], a["pca.variance"], a["pca.ratio"], s["pca_converged"]),
        s["lemmas"],
    )
