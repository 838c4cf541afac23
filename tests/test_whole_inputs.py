"""Every client of the tables is in the reference month: no view moves rows out of the run."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from clientincome.sources.fixtures import BASE_TABLES, load_inputs
from tests.conftest import SF_MID

MES = entry.PARAMS.mes


@pytest.fixture(scope="module")
def tables(spark):
    return {t: spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in BASE_TABLES}


def ids(df, key):
    return sorted(r[0] for r in df.select(key).distinct().collect())


def test_income_and_journey_hold_every_client_in_every_month(spark, tables):
    views = load_inputs(spark, SF_MID)
    buyers = tables["customer"].join(tables["orders"], F.col("c_custkey") == F.col("o_custkey"), "left_semi")
    for month in (MES - 1, MES):
        of_month = F.col("num_periodo_mes") == month
        assert ids(views.income.where(of_month), "id_master") == ids(tables["customer"], "c_custkey")
        assert ids(views.journey.where(of_month), "id_master") == ids(buyers, "c_custkey")
    for view in (views.income, views.journey):
        assert view.count() == view.select("id_master", "num_periodo_mes").distinct().count()


def test_populations_hold_every_client(spark, tables):
    customer = tables["customer"].where(F.col("c_custkey") > 0)
    payroll = customer.where((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") > 0))
    assert ids(entry.queries()["pop_training"](spark, SF_MID), "id_master") == ids(payroll, "c_custkey")
    assert set(ids(customer, "c_custkey")) <= set(ids(entry.queries()["pop_deposits"](spark, SF_MID), "id_master"))


def recent(tables):
    """Events of the reference month (the last five days) and the clients among their users, from the tables."""
    last = tables["events"].where(F.dayofmonth("ts") > 25)
    natural = tables["customer"].where(F.col("c_mktsegment") != "MACHINERY")
    active = (F.col("user_id") > 0) & ((F.col("user_id") % 3 != 0) | (F.col("user_id") % 2 == 1))
    return last, ids(last.where(active).join(natural, F.col("user_id") == F.col("c_custkey"), "left_semi"), "user_id")


def test_transfers_hold_every_client_of_the_reference_month(spark, tables):
    last, clients = recent(tables)
    history = load_inputs(spark, SF_MID).transfer_hist.where(F.col("num_periodo_mes") == MES)
    assert ids(history, "id_master") == ids(last, "user_id")
    assert ids(entry.queries()["pop_transfer"](spark, SF_MID), "id_master") == clients
    assert set(clients) <= set(ids(entry.queries()["score_rfm"](spark, SF_MID), "id_master"))


def test_scored_clients_hold_every_client_of_the_reference_month(spark, tables):
    _, clients = recent(tables)
    assert set(clients) <= set(ids(entry.queries()["score_clients"](spark, SF_MID), "id_master"))


def test_scored_clients_count_every_month_of_their_transfers(spark, tables):
    day = F.dayofmonth("ts")
    month = (F.lit(MES - 5) + F.when(day > 30, 5).otherwise(F.floor((day - 1) / 5))).cast("int")
    events = tables["events"].select(F.col("user_id").alias("id_master"), month.alias("num_periodo_mes"), "event_type")
    history = load_inputs(spark, SF_MID).transfer_hist.select("id_master", "num_periodo_mes")
    expected = events.select("id_master", "num_periodo_mes").distinct()
    assert sorted(history.collect()) == sorted(expected.collect())
    _, clients = recent(tables)

    def active_months(kind):
        rows = events.where(F.col("event_type") == kind).groupBy("id_master").agg(F.countDistinct("num_periodo_mes")).collect()
        return {r[0]: r[1] for r in rows}

    scored = {r.id_master: r for r in entry.queries()["score_clients"](spark, SF_MID).collect()}
    received = {"frec_rem": active_months("purchase"), "frec_dex": active_months("signup")}
    for name, counted in received.items():
        assert {c: scored[c][name] for c in clients} == {c: counted.get(c, 0) for c in clients}


def test_day_31_counts_in_the_reference_month(spark):
    from clientincome.sources.fixtures import VIEWS

    spark.sql("""SELECT 7L AS user_id, d AS ts, 'click' AS event_type, 1.5D AS value FROM VALUES
        (TIMESTAMP '2024-01-31 12:00:00'), (TIMESTAMP '2024-01-26 12:00:00'), (TIMESTAMP '2024-01-01 12:00:00') AS v(d)""").createOrReplaceTempView("events")
    try:
        got = spark.sql(VIEWS["transfer_hist"]).select("num_periodo_mes", "num_env_dex").collect()
    finally:
        load_inputs(spark, SF_MID)  # the view over the table again
    assert sorted(map(tuple, got)) == [(MES - 5, 1), (MES, 2)]
