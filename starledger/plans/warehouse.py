"""Load of the whole warehouse: raw, landing and dimension tables, then the keyed fact."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import Future, ThreadPoolExecutor
from contextlib import nullcontext
from contextvars import copy_context
from dataclasses import replace
from functools import partial, reduce
from threading import Lock

from pyspark.sql import DataFrame, functions as F

from starledger.operators.columns import AVAILABILITY_TEXTS
from starledger.operators.joins import link_currency_rate
from starledger.operators.keys import Watch
from starledger.operators.rejects import Rejects
from starledger.operators.rows import DEFAULT_MEMBERS
from starledger.plans import pipelines
from starledger.plans.star import Star, resolve_keys
from starledger.schemas import DIM_TABLES, FACT_TABLE, LAND_TABLES, RAW_TABLES, TABLE_LAYOUTS, enforce_schema
from starledger.session import SHUFFLES_DROPPED, SMALL_PARTS_HASHED, materialised, scratch_scope, session_settings
from starledger.sources.sinks import PACKED, file_parts, layered_load, load_parts, load_table, replacing, spread

# The countries and currencies the dimensions keep.
CURRENCY_SUBSET = ["US", "GB", "DE"]
CONVERSION_SUBSET = ["USD", "GBP", "EUR"]


REPORT_TABLE = "load_rejects"
QUARANTINE_TABLE = "load_rejected_rows"
#: Number of a sale while its keys are resolved; not a column of any table.
ROW = "_row"


def load_warehouse(
    raws: Mapping[str, DataFrame],
    mapping: DataFrame,
    run_ts: str,
    root: str,
    position: str = "position",
    dense_position: bool = False,
    quarantine: bool = False,
) -> Star:
    """Load all datasets under ``root`` and return the star as read back from there.

    Every raw frame but stores and orders has a ``position`` column with its source
    order. Keys are resolved before the one write of the fact, and the currency
    dimension is written with its rate keys. What was dropped or did not fit is counted in
    the table ``load_rejects``; with ``quarantine`` the rows themselves are kept in ``load_rejected_rows``, at the price of
    cleaning those of the dimensions once more. Intermediate files are deleted with their dataset, those of the fact at the end.
    """
    spark = mapping.sparkSession
    layout = dict(TABLE_LAYOUTS[FACT_TABLE])
    rejects = {dataset: Rejects(keep=quarantine) for dataset in (*LAND_TABLES, "orders")}
    writing = Lock()

    def watch(dataset: str) -> Watch:
        return lambda df, rules: rejects[dataset].dropped(df, LAND_TABLES[dataset], rules)

    dense = {"position": position, "dense_position": dense_position}
    cleaners = {
        "users": partial(pipelines.clean_users, position=position, watch=watch("users")),
        "stores": partial(pipelines.clean_stores, watch=watch("stores")),
        "cards": partial(pipelines.clean_cards, watch=watch("cards"), **dense),
        "products": partial(pipelines.clean_products, watch=watch("products"), **dense),
        "date_times": partial(pipelines.clean_date_times, watch=watch("date_times"), **dense),
        "currency": partial(pipelines.clean_currency, position=position),
        "currency_conversion": partial(
            pipelines.clean_rates, mapping=mapping, run_ts=run_ts, position=position
        ),
    }
    loading: dict[str, Future] = {}

    def linked(currency: DataFrame) -> DataFrame:
        return link_currency_rate(currency, loading["currency_conversion"].result())

    steps = {
        "products": {"mapping": AVAILABILITY_TEXTS, "finish": pipelines.classed_products},
        "currency": {"subset": CURRENCY_SUBSET, "link": linked},
        "currency_conversion": {"subset": CONVERSION_SUBSET},
    }

    def keep(dataset: str, kept: str | None) -> None:
        """Write the rejected rows of a dataset, while its intermediate files are there."""
        if kept:
            with writing:  # One at a time: the loads write to one folder.
                rejects[dataset].rows(spark).write.mode("append").options(**PACKED).parquet(kept)

    def load(dataset: str, kept: str | None) -> DataFrame:
        with scratch_scope(spark):
            dim = layered_load(
                raws[dataset],
                cleaners[dataset],
                root,
                LAND_TABLES[dataset],
                DIM_TABLES[dataset],
                RAW_TABLES.get(dataset),
                additional_rows=DEFAULT_MEMBERS[DIM_TABLES[dataset]],
                rejects=rejects[dataset],
                **steps.get(dataset, {}),
            )
            keep(dataset, kept)
        return dim

    def stage(kept: str | None) -> DataFrame:
        """Staged, because several passes over the fact follow and its source may be slow.

        As texts, with a flag for those that have their shape, and numbered: typed rows and rejected rows are both read from here.
        """
        watched = rejects["orders"].lost(pipelines.clean_orders(spread(raws["orders"])), FACT_TABLE, layout)
        numbered = watched.withColumn(ROW, F.monotonically_increasing_id())
        staged = materialised(numbered, f"staged-{FACT_TABLE}", **PACKED)
        rejects["orders"].written(staged.drop(ROW))
        keep("orders", kept)
        return staged

    # The rates first: the currencies wait for them.
    datasets = sorted(cleaners, key=lambda d: d != "currency_conversion")
    quarantined = replacing(spark, f"{root}/{QUARANTINE_TABLE}") if quarantine else nullcontext()
    workers = len(cleaners) + 1
    with session_settings(spark, SHUFFLES_DROPPED), quarantined as kept, scratch_scope(spark), ThreadPoolExecutor(workers) as pool:
        # The datasets do not depend on each other otherwise; their jobs share the cluster.
        for dataset in datasets:
            loading[dataset] = pool.submit(copy_context().run, load, dataset, kept)
        staging = pool.submit(copy_context().run, stage, kept)
        dims = {dataset: done.result() for dataset, done in loading.items()}
        staged = staging.result()
        unresolved = Star(
            orders=enforce_schema(staged, layout),
            product=dims["products"],
            store=dims["stores"],
            users=dims["users"],
            card=dims["cards"],
            date_times=dims["date_times"],
            currency=dims["currency"],
            currency_conversion=dims["currency_conversion"],
        )
        parts = [enforce_schema(part, layout) for part in file_parts(staged)]
        with session_settings(spark, SMALL_PARTS_HASHED):
            fact = load_parts(resolve_keys(unresolved, ROW, parts), f"{root}/{FACT_TABLE}")
    report = reduce(DataFrame.union, [found.frame(spark) for found in rejects.values()])
    load_table(report, f"{root}/{REPORT_TABLE}", "replace")
    return replace(unresolved, orders=fact)
