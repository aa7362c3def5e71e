"""Day states: what they hold, how a run updates them, and the answers taken from them."""

from __future__ import annotations

import datetime as dt
import os

from conftest import SF_SMALL
from pyspark.sql import functions as F

from quayside.operators import marts, states
from quayside.operators.parse import encode_events, parse_transactions, split_valid_invalid
from quayside.plans import batch, queries, registry, served
from quayside.sources import testdata
from quayside.sources.lake import write_lake_batch


def rows(df):
    return sorted(map(str, registry.present(df).collect()))


def parts_of(folder):
    return {os.path.join(at, f) for at, _, files in os.walk(folder) for f in files if f.endswith(".parquet")}


def test_candidates_are_the_largest_of_each_day(spark):
    stg = registry.stg(spark, SF_SMALL)
    high = sorted((r.transaction_date, -r.amount, r.transaction_id) for r in marts.with_amount_flag(stg).filter("is_high_value").collect())
    want = [h for i, h in enumerate(high) if sum(g[0] == h[0] for g in high[:i]) < 2]
    got = sorted((r.transaction_date, -r.amount, r.transaction_id) for r in states.day_candidates(stg, 2).collect())
    assert got == want and len(got) < len(high)


def test_a_hot_day_is_cut_before_its_shuffle(spark):
    plan = states.day_candidates(registry.stg(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan  # each task's first rows, then the day's


def test_measures_shuffle_groups_only(spark):
    stg = registry.stg(spark, SF_SMALL)
    measured = states.day_measures(stg)
    assert measured.agg(F.sum("n_rows"), F.sum("amount")).first() == stg.agg(F.count(F.lit(1)), F.sum("amount")).first()


def test_q6_takes_the_fact_only_without_enough_high_values(spark):
    stg = registry.stg(spark, SF_SMALL)
    dim = marts.dim_customers(stg, registry.NOW)
    fct = marts.fct_transactions(stg, dim, registry.NOW)
    found = states.day_candidates(stg)
    n = found.count()
    asked = []

    def fact():
        asked.append(1)
        return fct

    for k, reads in ((3, 0), (n, 0), (n + 1, 1), (states.CANDIDATES + 1, 2)):
        assert rows(served.q6_flagged(found, dim, fact, k)) == rows(queries.q6_flagged(fct, k)), k
        assert len(asked) == reads
    few = stg.filter(F.col("amount") < 10)
    assert rows(served.q6_flagged(None, dim, lambda: marts.fct_transactions(few, dim, registry.NOW), 5)) == rows(
        queries.q6_flagged(marts.fct_transactions(few, dim, registry.NOW), 5)
    )


def test_two_loads_that_share_a_day(spark, scratch):
    """A run recomputes the days it touched and no other; after a crash before the states the next run catches up."""
    paths = batch.Paths(lake=os.path.join(scratch, "lake"), warehouse=os.path.join(scratch, "wh"))
    cut = dt.datetime(2024, 1, 28, 12)
    events = testdata.transactions(spark, SF_SMALL, with_event_id=True)
    for key, part in (("t-0", F.col("sent_at") < F.lit(cut)), ("t-1", F.col("sent_at") >= F.lit(cut))):
        messages = encode_events(events.filter(part).drop("event_id", "sent_at"))
        write_lake_batch(split_valid_invalid(parse_transactions(messages))[0], paths.lake, key)
        version = batch.run_id(dt.datetime(2024, 1, 31 if key == "t-0" else 30))
        assert batch.load_raw(spark, paths, version)[0]
        if key == "t-0":
            batch.update_day_groups(spark, paths)
            whole = batch.update_day_states(spark, paths)
            folder = paths.day_state("day_measures")
            before = parts_of(folder)
    batch.update_day_groups(spark, paths)  # the crash: groups done, states not
    touched = batch.update_day_states(spark, paths)
    after = parts_of(folder)
    assert 0 < touched < whole and len(before & after) == whole - 1
    assert batch.update_day_states(spark, paths) == 0

    staged = batch.read_staged(spark, paths)
    assert rows(batch.day_state(spark, paths, "day_measures")) == rows(states.day_measures(staged))
    assert rows(batch.day_state(spark, paths, "day_candidates")) == rows(states.day_candidates(staged))
    as_of = registry.AS_OF
    want = queries.q8_daily_trend_30d(marts.with_amount_flag(staged), as_of)
    assert rows(batch.warehouse_query(spark, paths, "q8_daily_trend_30d", as_of)) == rows(want)
