"""Command-line job: ``spark-submit clientincome/plans/job.py ...``.

    job.py train --mes 202010 --historia 6 --inputs ROOT --models DIR
    job.py infer --mes 202010 --historia 6 --inputs ROOT --models DIR --out DIR
    job.py all   ... (train, then infer)

``ROOT`` holds one folder per input (contact, account_hist, deposit_hist,
transfer_hist, fx_hist, income, journey, calendar, census), parquet by
default or CSV with a header (``--format csv``), read with the declared
schemas.  With ``--format table`` it is a pattern of catalog names, such as
``extracts.{}``.  ``--corrected`` switches to the CORRECTED semantics.

Each training writes a version of its own (``--version``, else the time in UTC)
and publishes it in DIR when it is whole; ``infer`` takes the newest version
published, or the one named.  ``--executors`` and ``--executor-cores`` size the session for
``--input-bytes`` of input.
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import UTC, datetime

from pyspark.sql import SparkSession

from clientincome.plans import inference as plan
from clientincome.semantics import CORRECTED, REFERENCE, RunParams
from clientincome.session import cluster_conf
from clientincome.sources import io, registry, schemas


def _args(argv):
    ap = argparse.ArgumentParser(prog="clientincome")
    ap.add_argument("mode", choices=["train", "infer", "all"])
    ap.add_argument("--mes", type=int, required=True)
    ap.add_argument("--historia", type=int, default=6)
    ap.add_argument("--seed", type=int, default=123)
    ap.add_argument("--inputs", required=True)
    ap.add_argument("--format", choices=["parquet", "csv", "table"], default="parquet")
    ap.add_argument("--models", required=True)
    ap.add_argument("--out")
    ap.add_argument("--version")
    ap.add_argument("--corrected", action="store_true")
    ap.add_argument("--input-bytes", type=int, default=0)
    ap.add_argument("--executors", type=int, default=0)
    ap.add_argument("--executor-cores", type=int, default=1)
    return ap.parse_args(argv)


def _version(spark: SparkSession, models: str, version: str | None) -> tuple[str, str]:
    """The version named, or the newest published, and its folder."""
    found = registry.latest(spark, models, version)
    if found is None:
        raise SystemExit(f"{models} holds no version {version or 'at all'}")
    return found["version"], found["path"]


def run(spark: SparkSession, argv) -> dict:
    a = _args(argv)
    params = RunParams(a.mes, a.historia, a.seed)
    sem = CORRECTED if a.corrected else REFERENCE
    if a.executors:
        for key, value in cluster_conf(a.input_bytes, a.executor_cores, a.executors).items():
            if spark.conf.isModifiable(key):
                spark.conf.set(key, value)
    pattern = a.inputs if a.format == "table" else f"{a.inputs.rstrip('/')}/{{}}"
    readers = {"csv": schemas.read_inputs_csv, "parquet": schemas.read_inputs_parquet, "table": schemas.read_inputs_table}
    inputs = readers[a.format](spark, {name: pattern.format(name) for name in schemas.SCHEMAS})
    models = a.models.rstrip("/")
    result: dict = {}
    if a.mode in ("train", "all"):
        result["version"] = a.version or datetime.now(UTC).strftime("%Y-%m-%dT%H%M%S.%f")
        path = f"{models}/{result['version']}"
        status = plan.run_training(inputs, params, f"{path}/model", f"{path}/factor", sem=sem).first()
        result["training"] = status.asDict()
        # last, so that whole versions alone are published
        registry.publish(spark, models, result["version"], path, status["n_train"], plan.MODEL_PARTS)
    if a.mode in ("infer", "all"):
        if not a.out:
            raise SystemExit("--out is required to infer")
        result["version"], path = _version(spark, models, result.get("version") or a.version)
        factor = io.load_factor(spark, f"{path}/factor")
        scored, report = plan.run_inference(inputs, params, f"{path}/model", factor, sem)
        result["outputs"] = plan.write_outputs(scored, report, a.out)
    return result


def main(argv=None) -> None:
    spark = SparkSession.builder.appName("clientincome").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    print(json.dumps(run(spark, sys.argv[1:] if argv is None else argv), default=str))


if __name__ == "__main__":
    main()
