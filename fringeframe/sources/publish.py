"""Tables that grow by published batches, and deposits of an observation's artefacts.

A batch is written to a folder of its own and becomes part of the table when its manifest is put in
place, in one step and last. A batch that is already published is not written again, so a job or a
micro-batch that is repeated adds nothing; a folder without a manifest (a failed attempt) is never read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_FOLDER = "published_batch"
#: Rows of a written file at most, so that a file can be checked whole.
FILE_ROWS = 1_000_000


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    system, p = _hadoop(spark, path)
    return system.exists(p)


def put(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file in one step; false, and nothing done, if it is there already."""
    system, final = _hadoop(spark, path)
    if system.exists(final):
        return False
    _, draft = _hadoop(spark, f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}")
    out = system.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    if system.exists(final) or not system.rename(draft, final):
        system.delete(draft, False)
        return False
    return True


def get(spark: SparkSession, path: str) -> dict:
    """A manifest as written."""
    return json.loads("\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()))


def artefacts(spark: SparkSession, path: str) -> DataFrame:
    """(name, bytes, sha1) of the files below ``path``, named from there on; a task reads a file at a time."""
    last = path.rstrip("/").rsplit("/", 1)[-1]
    inside = F.when(F.contains("path", F.lit(f"/{last}/")), F.substring_index("path", f"/{last}/", -1)).otherwise(F.lit(last))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    files = files.where(~F.element_at(F.split("path", "/"), -1).rlike("^[._]"))
    return files.select(inside.alias("name"), F.col("length").alias("bytes"), F.sha1("content").alias("sha1"))


def publish(df: DataFrame, path: str, batch: str, about: Mapping | None = None, partition_by: Sequence[str] = ()) -> dict:
    """Add ``df`` to the table at ``path`` as the batch of that name; returns its manifest.

    If the batch is published already, nothing is written and the earlier manifest is returned.
    """
    spark, manifest = df.sparkSession, f"{path}/manifest/{batch}.json"
    if not exists(spark, manifest):
        folder = f"data/{_FOLDER}={batch}-{uuid.uuid4().hex}"
        df.write.option("maxRecordsPerFile", FILE_ROWS).partitionBy(*partition_by).parquet(f"{path}/{folder}")
        files = [r.asDict() for r in artefacts(spark, f"{path}/{folder}").orderBy("name").collect()]  # files, not rows
        rows = spark.read.schema(df.schema).parquet(f"{path}/{folder}").count()
        put(spark, manifest, json.dumps({"batch": batch, "folder": folder, "rows": rows, "schema": df.schema.jsonValue(), "about": dict(about or {}), "artefacts": files}))
    return get(spark, manifest)


def manifests(spark: SparkSession, path: str) -> list[dict]:
    """All manifests of a table; one small document a batch."""
    if not exists(spark, f"{path}/manifest"):
        return []
    texts = spark.read.text(f"{path}/manifest/*.json", wholetext=True).collect()
    return sorted((json.loads(r["value"]) for r in texts), key=lambda m: m["batch"])


def published(spark: SparkSession, path: str, batches: Sequence[str] | None = None) -> DataFrame:
    """The rows of all published batches, or of those named."""
    wanted = [m for m in manifests(spark, path) if m["rows"] and (batches is None or m["batch"] in batches)]
    if not wanted:
        raise ValueError(f"no published rows in {path}")
    schema = StructType.fromJson(wanted[0]["schema"]).add(_FOLDER, "string")
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*[f"{path}/{m['folder']}" for m in wanted]).drop(_FOLDER)


def damaged(spark: SparkSession, path: str) -> list[str]:
    """Names of published files whose size or checksum is not that of the manifest, or that are gone."""
    bad = []
    for m in manifests(spark, path):
        now = {r["name"]: (r["bytes"], r["sha1"]) for r in artefacts(spark, f"{path}/{m['folder']}").collect()}
        bad += [a["name"] for a in m["artefacts"] if now.get(a["name"]) != (a["bytes"], a["sha1"])]
    return bad


def publish_batches(stream: DataFrame, path: str, checkpoint: str, name: str, partition_by: Sequence[str] = ()):
    """Publish every micro-batch under its number; one that comes again after a failure adds nothing."""
    def write(batch: DataFrame, i: int) -> None:
        publish(batch, path, f"{name}-{i:012d}", partition_by=partition_by)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: Kinds of artefacts of a deposit. A deposit needs one of the first three.
KINDS = ("image", "catalogue", "measurement_set", "evaluation")


def deposit(spark: SparkSession, outdir: str, sb_id: int, declared: Mapping[str, Sequence[str]], scans: Mapping[str, DataFrame] | None = None,
            identity: Mapping | None = None, obs_start: str | None = None, obs_end: str | None = None) -> dict:
    """List an observation's artefacts with checksums and the scans of its visibility tables; returns the manifest.

    ``declared`` gives the paths of each kind; ``scans`` the scan table (``start``, ``end``, …) of each
    measurement set. The first measurement set gives the time range of the observation; without one it
    must be stated. ``observation.json`` is put in place last but for its checksum and the READY file.
    A deposit that is there already is returned as it is.
    """
    unknown = set(declared) - set(KINDS)
    if unknown:
        raise ValueError(f"unknown artefact kinds {sorted(unknown)}")
    if not any(declared.get(k) for k in KINDS[:3]):
        raise ValueError("no artefacts declared")
    target = f"{outdir}/{sb_id}/observation.json"
    if not exists(spark, target):
        listed = []
        for kind in KINDS:
            for p in declared.get(kind, ()):
                entry = {"kind": kind, "path": p, "files": [r.asDict() for r in artefacts(spark, p).orderBy("name").collect()]}
                if kind == "measurement_set":
                    entry["scans"] = [json.loads(r[0]) for r in scans[p].select(F.to_json(F.struct("*")).alias("j")).orderBy("j").collect()]  # scans, not rows
                    if obs_start is None and entry["scans"]:
                        obs_start, obs_end = min(s["start"] for s in entry["scans"]), max(s["end"] for s in entry["scans"])
                listed.append(entry)
        if obs_start is None or obs_end is None:
            raise ValueError("state the time range of an observation without visibilities")
        text = json.dumps({"identity": {"sb_id": sb_id, **(identity or {})}, "obs_start": obs_start, "obs_end": obs_end, "artefacts": listed}, indent=1)
        put(spark, target, text)
    check = artefacts(spark, target).first()
    put(spark, f"{target}.checksum", f"{check['sha1']} {check['bytes']}")
    put(spark, f"{outdir}/{sb_id}/READY", "")
    return get(spark, target)
