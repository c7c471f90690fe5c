"""Datasets, checkpoints and metadata to files."""

from __future__ import annotations

import importlib.metadata
import json
import platform
import subprocess
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_jsonl(rows: DataFrame, path: str, seq: str | None = None, files: int | None = None) -> None:
    """JSON lines, null fields left out; sorted by ``seq`` within and across files, in ``files`` files if given."""
    rows = rows.orderBy(seq) if seq else rows
    rows = rows.coalesce(files) if files else rows
    rows.write.mode("overwrite").json(path)


def write_dataset(rows: DataFrame, rejected: DataFrame, base: str) -> None:
    """Rows with ``split`` as ``{base}.jsonl`` and, without it, ``{base}_train.jsonl``, ``_val`` and ``_test``; ``rejected`` beside them."""
    write_jsonl(rows, f"{base}.jsonl")
    for split in ("train", "val", "test"):
        write_jsonl(rows.where(F.col("split") == split).drop("split"), f"{base}_{split}.jsonl")
    write_jsonl(rejected, f"{base}.rejected.jsonl")


def write_checkpoint(items: DataFrame, folder: str) -> None:
    """Items by document; documents that are not in ``items`` keep theirs."""
    items.withColumn("part", F.col("document")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").json(folder)


def write_metadata(spark: SparkSession, values: dict, path: str) -> None:
    """Aggregates and settings of a run, already rows of the driver, as indented JSON wherever Spark writes."""
    content = json.dumps(values, indent=2, ensure_ascii=False, default=str).encode()
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()


def package_version(name: str) -> str | None:
    try:
        return importlib.metadata.version(name)
    except importlib.metadata.PackageNotFoundError:
        return None


def run_info(spark: SparkSession) -> dict:
    """Versions, and the commit of the code, None outside a repository."""
    try:
        commit = subprocess.run(["git", "rev-parse", "--short", "HEAD"], capture_output=True, text=True, timeout=3, cwd=Path(__file__).parent).stdout.strip() or None
    except (OSError, subprocess.TimeoutExpired):
        commit = None
    packages = {name: package_version(name) for name in ("pyspark", "pandas", "pyarrow", "numpy", "pypdf", "pymupdf4llm")}
    return {"python_version": platform.python_version(), "platform": platform.platform(), "spark": spark.version, "packages": packages, "git_commit": commit}


#: Folders in which generated files may be deleted, and the files that are generated.
CLEANED = ("output", "run_logs")
GENERATED = (".json", ".jsonl", ".crc")


def clean_outputs(roots: list[str], base: str, dry_run: bool = False) -> dict[str, int]:
    """Deletes the generated files under ``roots`` and the empty folders left; counts both, and deletes nothing in a dry run.

    A root has to be one of CLEANED in ``base`` or lie in one. Files that keep a folder in a repository stay.
    """
    allowed = [(Path(base) / name).resolve() for name in CLEANED]
    tops = list(dict.fromkeys(Path(root).resolve() for root in roots))
    for top in tops:
        if not any(top == root or root in top.parents for root in allowed):
            raise ValueError(f"{top} is not in {', '.join(map(str, allowed))}")
    found = sorted({p for top in tops if top.exists() for p in top.rglob("*") if p.is_file() and p.name != ".gitkeep" and (p.suffix.lower() in GENERATED or p.name == "_SUCCESS")})
    told = [p for p in found if p.suffix.lower() in (".json", ".jsonl")]
    if dry_run:
        return {"files": len(told), "dirs": 0}
    for p in found:
        p.unlink()
    folders = sorted({p for top in tops if top.exists() for p in top.rglob("*") if p.is_dir()}, key=lambda p: -len(p.parts))
    return {"files": len(told), "dirs": sum(1 for p in folders if not any(p.iterdir()) and not p.rmdir())}
