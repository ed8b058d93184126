"""Job commands: ``python -m tierlake.plans.jobs <step> --config pipeline.yml [--root s3a://] [--batch ID]``."""

from __future__ import annotations

import argparse
import glob
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tierlake.config import PipelineConfig, load_config
from tierlake.plans.ledger import newest, note, waiting
from tierlake.plans.layers import bronze_to_raw, func_to_gold, ingest, raw_to_tech, tech_to_func
from tierlake.session import build_session
from tierlake.sources.catalog import mirror
from tierlake.sources.staging import drop_staged, staged_for_now

def run_all(
    spark: SparkSession, config: PipelineConfig, batch_id: str | None = None, with_catalog: bool = True
) -> dict[str, str]:
    """The whole chain: ingest, then RAW, TECH and FUNC of every batch that waits for it, Gold, catalog.

    The work list comes from the ledger, so batches that an earlier run landed and didn't finish are done as well; their
    half-written folders are replaced. All batches of a run are shaped together: a snapshot covers the run, not the last of
    its batches. Batches without rows or without valid rows end where they are.
    """
    with staged_for_now(spark):
        outcome = {"ingest": ingest(spark, config, batch_id).status}
        for batch in waiting(spark, config, "bronze_to_raw", "ingest"):
            outcome["bronze_to_raw"] = bronze_to_raw(spark, config, batch, again=True).status
        for batch in waiting(spark, config, "raw_to_tech", "bronze_to_raw"):
            outcome["raw_to_tech"] = raw_to_tech(spark, config, batch, again=True).status
        shaped = waiting(spark, config, "tech_to_func", "raw_to_tech")
        if shaped:
            outcome["tech_to_func"] = tech_to_func(spark, config, batches=shaped).status
        if config.layout.gold_location and (shaped or newest(spark, config, "tech_to_func") != newest(spark, config, "gold")):
            func_to_gold(spark, config)
            outcome["func_to_gold"] = "success"
            note(spark, config, newest(spark, config, "tech_to_func") or "", "gold", 1, "success")
        if with_catalog:
            outcome["catalog"] = ", ".join(mirror(spark, config))
    return outcome


STEPS = {
    "ingest": ingest,
    "bronze-to-raw": bronze_to_raw,
    "raw-to-tech": raw_to_tech,
    "tech-to-func": tech_to_func,
}


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tierlake")
    parser.add_argument("step", choices=[*STEPS, "silver-to-gold", "catalog", "all"])
    parser.add_argument("--config", required=True, help="a file, or a pattern: one run per file")
    parser.add_argument("--root", default="s3a://", help="put before every bucket name")
    parser.add_argument("--batch", help="batch id; the newest one by default")
    options = parser.parse_args(arguments)
    files = sorted(glob.glob(options.config))
    if not files:
        parser.error("No configuration matches {}".format(options.config))
    configs = [load_config(file, options.root) for file in files]
    spark = build_session("tierlake-{}".format(options.step))
    failed = []
    try:
        for config in configs:
            try:
                print(config.name, run_step(spark, config, options.step, options.batch))
            except Exception as error:  # the other pipelines still run
                failed.append("{}: {}".format(config.name, error))
    finally:
        drop_staged(spark)
        spark.stop()
    if failed:
        raise SystemExit("\n".join(failed))


def run_step(spark: SparkSession, config: PipelineConfig, step: str, batch_id: str | None) -> object:
    """One command for one pipeline."""
    if step in STEPS:
        return STEPS[step](spark, config, batch_id)
    if step == "silver-to-gold":
        return func_to_gold(spark, config)
    return mirror(spark, config) if step == "catalog" else run_all(spark, config, batch_id)


if __name__ == "__main__":
    main()
