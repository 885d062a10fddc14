"""What a run used and with which code, kept beside its outputs: copies of its inputs with checksums, the settings, the commit.

Copies go through Hadoop's file systems, so the snapshot can be read from any host. Checksums are taken by Spark from the copies,
file by file on the executors. A snapshot is for inputs of the size of lookups and settings: each file must fit a task."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files


def commit_of(folder: str) -> str | None:
    """The commit that a git working folder stands at, read from its files; None where there is none."""
    try:
        with open(os.path.join(folder, ".git", "HEAD")) as f:
            head = f.read().strip()
        if not head.startswith("ref: "):
            return head
        name = head.removeprefix("ref: ")
        loose = os.path.join(folder, ".git", *name.split("/"))
        if os.path.exists(loose):
            with open(loose) as f:
                return f.read().strip()
        with open(os.path.join(folder, ".git", "packed-refs")) as f:
            return next((line.split()[0] for line in f if line.strip().endswith(f" {name}")), None)
    except OSError:
        return None


def sums(spark: SparkSession, folder: str) -> DataFrame:
    """(file, length, sha256) of all files under a folder that are not empty, by their names inside it."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    inside = F.regexp_replace("path", r"^.*?/inputs/", "")
    return found.select(inside.alias("file"), "length", F.sha2("content", 256).alias("sha256"))


def take(spark: SparkSession, folder: str, inputs: dict[str, str], code: str | None = None, **settings: object) -> str:
    """Copies each input (name: path of a file or folder) to folder/inputs/name, writes folder/run.json, and gives that path.

    A folder that has a snapshot already is an error, so no run overwrites what another one used."""
    folder = folder.rstrip("/")
    if files.exists(spark, f"{folder}/run.json"):
        raise FileExistsError(f"{folder} has a snapshot")
    for name, path in inputs.items():
        files.copy(spark, path, f"{folder}/inputs/{name}")
    rows = sums(spark, f"{folder}/inputs").orderBy("file").collect() if inputs else []
    said = {
        "written": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()), "commit": commit_of(code) if code else None, "spark": spark.version, "settings": settings,
        "inputs": {r["file"]: {"sha256": r["sha256"], "length": r["length"]} for r in rows}, "from": inputs,
    }
    lines = spark.createDataFrame([(json.dumps(said, default=str, sort_keys=True),)], "value string")
    stage = f"{folder}/_stage"
    lines.coalesce(1).write.mode("overwrite").text(stage)
    (part,) = [x for x in files.names(spark, stage) if x.startswith("part-")]
    files.move(spark, f"{stage}/{part}", f"{folder}/run.json")
    files.delete(spark, stage)
    return f"{folder}/run.json"


def compare(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """Copies that differ from what was written down: changed, lost, new. All empty if the snapshot is as it was taken."""
    folder = folder.rstrip("/")
    said = json.loads(files.read_text(spark, f"{folder}/run.json"))["inputs"]
    there = {r["file"]: r["sha256"] for r in sums(spark, f"{folder}/inputs").collect()} if files.exists(spark, f"{folder}/inputs") else {}
    return {
        "changed": sorted(f for f in said if f in there and there[f] != said[f]["sha256"]),
        "lost": sorted(set(said) - set(there)),
        "new": sorted(set(there) - set(said)),
    }
