"""End-to-end plans: feature building, scoring, training.

The stages are plain DataFrame functions; a plan wires them and decides where
lineage is cut.  Cuts are parquet tables written in the shared folder named
by ``spark.checkpoint.dir`` (never machine-local storage on a cluster), so a
lost executor recomputes from the last cut, not from the raw history.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientincome.operators import census as census_ops
from clientincome.operators import copies
from clientincome.operators import deposits, demographics, populations, scoring, services, unify
from clientincome.operators import report as report_ops
from clientincome.operators import training
from clientincome.semantics import REFERENCE, RunParams, Semantics
from clientincome.session import scratch_path
from clientincome.sources import io
from clientincome.sources.fixtures import Inputs


# tables of a published model version, each with the marker file of its writer
MODEL_PARTS = ("model/metadata", "factor")


@dataclass
class Features:
    """Feature tables of a run.  ``deposits`` (enriched) and
    ``unified_weighted`` carry repeated dimension rows as the weight ``_w``;
    ``unified`` is the same table with the repeats as rows."""

    deposits: DataFrame
    fx: DataFrame
    transfers: DataFrame
    unified_weighted: DataFrame

    @property
    def unified(self) -> DataFrame:
        return copies.expand(self.unified_weighted)


def populations_of(i: Inputs, params: RunParams, sem: Semantics = REFERENCE):
    """The three populations in counted form (one row per client, copies as
    a count), which is what the feature builders need."""
    return (
        populations.deposit_population_counted(i.deposit_hist, i.income, params, sem),
        populations.transfer_population_counted(i.transfer_hist, i.contact, params, sem),
        populations.fx_population_counted(i.fx_hist, i.contact, params, sem),
    )


def features(i: Inputs, params: RunParams, sem: Semantics = REFERENCE, written_population: bool = False) -> Features:
    """Populations, the three feature families, unification and
    demographics (76 columns under REFERENCE).

    ``written_population``: the deposit population is cut first, so that Spark
    can make a runtime filter of its ids (``filtered_by``)."""
    pop_cap, pop_env, pop_div = populations_of(i, params, sem)
    if written_population:
        pop_cap = filtered_by(cut(pop_cap, "population"))
    dep = deposits.deposit_features(i.account_hist, pop_cap, params, sem)
    dep = deposits.enrich(dep, i.income, i.journey, params, sem)
    fx = services.fx_features(pop_div, i.calendar, i.fx_hist, params, sem)
    env = services.transfer_features(pop_env, i.calendar, i.transfer_hist, params, sem)
    u = unify.unify(dep, fx, env, sem)
    demo = demographics.inference_demographics(i.contact, params, sem)
    return Features(dep, fx, env, unify.add_demographics(u, demo))


def filtered_by(population: DataFrame) -> DataFrame:
    """A written counted population, as a filter over a scan.

    In that form Spark's own runtime filter (a Bloom filter of the client ids,
    ``spark.sql.optimizer.runtime.bloomFilter.*``) reaches the account scan and
    drops other clients' rows before the two aggregates, where the history is
    large enough for it to pay.  Every counted row has a copy, so the filter
    drops nothing itself.
    """
    return population.where(F.col("n") >= 1)


def unified_cut(f: Features) -> DataFrame:
    """The unified features written once (weighted, so a client repeated by
    dimension copies is one row in every shuffle), then expanded with hot
    clients spread over tasks."""
    return copies.expand(cut(f.unified_weighted, "unified"))


def score(
    unified: DataFrame,
    census: DataFrame,
    factor: DataFrame,
    add_model_income: Callable[[DataFrame], DataFrame],
    sem: Semantics = REFERENCE,
) -> DataFrame:
    """I8 without the report: census income, model income, factor, scores,
    rules, indicators (all columns kept)."""
    c = census_ops.with_census_income(unified, census, sem)
    c = add_model_income(c)
    c = census_ops.adjusted_census(c, factor)
    return scoring.score_all(c, sem)


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Cut lineage by writing ``df`` as a parquet table in the shared folder
    (``spark.checkpoint.dir``) and reading it back.

    Unlike an RDD checkpoint the written table is columnar: the consumers of a
    wide table (the maxima pass, the report passes) read only their columns.
    A lost executor recomputes from this table, not from the raw history.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def training_table(i: Inputs, params: RunParams, sem: Semantics = REFERENCE) -> DataFrame:
    """Training population with demographics and journey features."""
    pop = populations.training_population(i.income, i.contact, params, sem)
    demo = demographics.training_demographics(i.contact, params, sem)
    return unify.training_features(pop, demo, i.journey, params, sem)


def run_training(
    i: Inputs,
    params: RunParams,
    model_path: str,
    factor_path: str,
    target: str = "mto_ing_mes",
    sem: Semantics = REFERENCE,
    **forest: int,
) -> DataFrame:
    """T1-T3 and the adjustment factor: fit and save the forest, save the
    factor next to it; returns the one-row status (path, n and rmse of the
    test rows, n_train: rows of the training table).

    ``forest``: num_trees, max_depth, max_bins or layout_partitions of
    ``training.train``.  The training table is cut once: the forest makes several passes over it
    and the factor reads it again.
    """
    train = cut(training_table(i, params, sem), "training")
    rows = train.count()
    _, _, status = training.train(
        train, model_path, target=target, seed=params.seed,
        predictions_path=f"{model_path.rstrip('/')}_test_predictions", **forest,
    )
    factor = census_ops.adjustment_factor(train, i.census, target=target, sem=sem)
    io.save_factor(factor, factor_path)
    return status.withColumn("n_train", F.lit(rows).cast("long"))


def run_inference(
    i: Inputs,
    params: RunParams,
    model_path: str,
    factor: DataFrame,
    sem: Semantics = REFERENCE,
    checkpoint: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Scored clients (49 columns) and the percentile report.

    The unified features and the scored table are cut (written tables), so
    the maxima, the scoring pass and the report read them instead of
    recomputing the pipeline per consumer.
    """
    model = training.load(model_path)
    f = features(i, params, sem, written_population=checkpoint)
    unified = unified_cut(f) if checkpoint else f.unified
    scored = score(unified, i.census, factor, lambda d: training.model_income(d, model), sem)
    out = report_ops.scored_clients(scored)
    if checkpoint:
        out = cut(out, "scored")
    return out, report_ops.report(out)


def write_outputs(scored: DataFrame, report: DataFrame, out_dir: str, csv: bool = True) -> dict[str, str]:
    """Sinks of the scored clients and the report.

    The scored table is written in parallel part files (CSV with a header,
    or parquet); only the report, one row per label pair, is a single file.
    """
    base = out_dir.rstrip("/")
    paths = {"scored": f"{base}/scored_clients", "report": f"{base}/report"}
    if csv:
        io.write_csv(scored, paths["scored"])
    else:
        io.write_parquet(scored, paths["scored"])
    io.write_csv(report, paths["report"], single_file=True)
    return paths
