"""Small files and whole folders of a run on any storage that Hadoop's FileSystem reaches: text replaced by one rename, tables staged
and moved into place together, and the registry, manifest and deliverables on top of that."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from .files import sanitize


class StoreError(ValueError):
    """Something that a run must leave behind is missing or broken."""


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.delete(where, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """The file as a whole: written beside it and renamed over it, so readers see the old text or the new one."""
    fs, where = _fs(spark, path)
    jvm = spark._jvm
    beside = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    fs.mkdirs(where.getParent())
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    qualified = fs.makeQualified(where)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(beside), qualified, options)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The file's text; None if there is none."""
    if not exists(spark, path):
        return None
    rows = spark.read.text(path, wholetext=True).collect()
    return rows[0][0] if rows else ""


def move_into_place(spark: SparkSession, staged: str, final: str) -> None:
    """The staged folder becomes `final`. What was there is set aside first and put back if the move fails."""
    fs, source = _fs(spark, staged)
    target = spark._jvm.org.apache.hadoop.fs.Path(final)
    aside = None
    fs.mkdirs(target.getParent())
    if fs.exists(target):
        aside = spark._jvm.org.apache.hadoop.fs.Path(f"{final}.old-{uuid.uuid4().hex}")
        if not fs.rename(target, aside):
            raise StoreError(f"{final} can't be set aside")
    if not fs.rename(source, target):
        if aside is not None:
            fs.rename(aside, target)
        raise StoreError(f"{staged} can't be moved to {final}")
    if aside is not None:
        fs.delete(aside, True)


def load_registry(spark: SparkSession, path: str) -> list[dict]:
    """The runs so far, in order; none if the file is missing or broken."""
    try:
        found = json.loads(read_text(spark, path) or "[]")
        return found if isinstance(found, list) else []
    except ValueError:
        return []


def append_record(spark: SparkSession, path: str, record: dict) -> list[dict]:
    """One writer at a time: the file is replaced as a whole."""
    records = [*load_registry(spark, path), sanitize(record)]
    write_text(spark, path, json.dumps(records, indent=1, sort_keys=True))
    return records


REGISTRY = "seq int, run_id string, mode string, timestamp string, training_end string, champion string, metrics_source string, model_by_property map<string,string>, metrics map<string,double>"


def registry_frame(spark: SparkSession, records: list[dict]) -> DataFrame:
    """The records as rows of REGISTRY; what a record lacks is null. A record for each run: a small table."""
    text = lambda r, k: None if r.get(k) is None else str(r[k])
    rows = [
        (i, *[text(r, k) for k in ("run_id", "mode", "timestamp", "training_end", "champion", "metrics_source")], r.get("model_by_property"), {k: float(v) for k, v in (r.get("metrics") or {}).items() if isinstance(v, (int, float))})
        for i, r in enumerate(records)
    ]
    return spark.createDataFrame(rows, REGISTRY)


#: What a manifest must hold (fixed values).
MANIFEST = ("dataset_version", "model_version", "training_period", "validation_period", "feature_config", "hyperparameters", "metrics", "seed", "timestamp")


def checked_manifest(manifest: dict) -> dict:
    missing = [k for k in MANIFEST if manifest.get(k) is None]
    if missing:
        raise StoreError(f"manifest lacks {', '.join(missing)}")
    return sanitize(manifest)


def fingerprint(manifest: dict) -> str:
    """SHA-256 of what configures a run: everything but its time and metrics."""
    return hashlib.sha256(json.dumps(sanitize({k: v for k, v in manifest.items() if k not in ("timestamp", "metrics", "fingerprint")}), sort_keys=True, ensure_ascii=False).encode()).hexdigest()


def same_configuration(a: dict, b: dict) -> bool:
    return fingerprint(a) == fingerprint(b)


def read_manifest(spark: SparkSession, run_dir: str) -> dict:
    """A run's manifest; raises if it is missing, broken, lacks a required field or doesn't match its own fingerprint."""
    text = read_text(spark, f"{run_dir}/run_manifest.json")
    try:
        found = json.loads(text) if text is not None else None
    except ValueError:
        found = None
    if not isinstance(found, dict):
        raise StoreError(f"no readable manifest in {run_dir}")
    checked_manifest(found)
    if found.get("fingerprint") != fingerprint(found):
        raise StoreError(f"the manifest in {run_dir} was changed")
    return found


#: The deliverables of a run (fixed values).
DELIVERABLES = (
    "data_quality_report", "eda_report", "feature_engineering_report", "model_benchmark", "backtesting_report",
    "forecast_accuracy_report", "future_forecast_dataset", "model_explainability_report", "powerbi_dataset", "technical_documentation",
)
#: The tables of powerbi_dataset.
AREAS = ("forecast", "accuracy", "pickup", "model")


def write_deliverables(run_dir: str, made: dict, manifest: dict, spark: SparkSession) -> list[str]:
    """All ten and the manifest, or nothing: they are staged beside run_dir and moved into place together, so a run that dies
    between two tables leaves an earlier one as it was. A table is written as Parquet, a dict as JSON, text as
    Markdown; powerbi_dataset is a dict of the four tables. Raises before writing if one is missing. Returns their paths."""
    missing = [n for n in DELIVERABLES if made.get(n) is None]
    areas = made.get("powerbi_dataset")
    missing += [f"powerbi_dataset/{a}" for a in AREAS if areas is not None and areas.get(a) is None]
    if missing:
        raise StoreError(f"deliverables missing: {', '.join(missing)}")
    manifest = checked_manifest(manifest)
    staged, names = f"{run_dir}.staging-{uuid.uuid4().hex}", []
    try:
        for name in DELIVERABLES:
            what = made[name]
            if name == "powerbi_dataset":
                for a in AREAS:
                    what[a].write.parquet(f"{staged}/{name}/{a}")
                names.append(name)
            elif isinstance(what, DataFrame):
                what.write.parquet(f"{staged}/{name}")
                names.append(name)
            else:
                names.append(f"{name}.{'json' if isinstance(what, dict) else 'md'}")
                write_text(spark, f"{staged}/{names[-1]}", json.dumps(sanitize(what), indent=1, sort_keys=True) if isinstance(what, dict) else what)
        write_text(spark, f"{staged}/run_manifest.json", json.dumps(manifest | {"fingerprint": fingerprint(manifest)}, indent=1, sort_keys=True))
        move_into_place(spark, staged, run_dir)
    except Exception:
        delete(spark, staged)
        raise
    return [f"{run_dir}/{n}" for n in names]


def read_deliverables(spark: SparkSession, run_dir: str) -> dict:
    """What write_deliverables wrote: frames, dicts and text by name. Raises if one is missing."""
    out: dict = {}
    for name in DELIVERABLES:
        if name == "powerbi_dataset" and exists(spark, f"{run_dir}/{name}"):
            out[name] = {a: spark.read.parquet(f"{run_dir}/{name}/{a}") for a in AREAS}
        elif exists(spark, f"{run_dir}/{name}"):
            out[name] = spark.read.parquet(f"{run_dir}/{name}")
        elif (text := read_text(spark, f"{run_dir}/{name}.json")) is not None:
            out[name] = json.loads(text)
        elif (text := read_text(spark, f"{run_dir}/{name}.md")) is not None:
            out[name] = text
        else:
            raise StoreError(f"{run_dir} lacks {name}")
    return out


def read_published(spark: SparkSession, run_dir: str) -> DataFrame | None:
    """The forecast that an earlier run published; None if there is none."""
    at = f"{run_dir}/future_forecast_dataset"
    return spark.read.parquet(at) if exists(spark, at) else None


def new_since(history: DataFrame, training_end: str | None, date: str = "stay_date") -> DataFrame:
    """new_records (rows later than the end of the last training, all if there was none), first, last, span_days: one row."""
    late = F.lit(True) if training_end is None else F.col(date) > F.lit(training_end).cast("date")
    g = history.where(F.col(date).isNotNull()).agg(F.count_if(late).alias("new_records"), F.min(date).alias("first"), F.max(date).alias("last"))
    return g.withColumn("span_days", F.coalesce(F.datediff("last", "first") + 1, F.lit(0)))
