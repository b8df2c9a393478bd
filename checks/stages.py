"""Stored stage tables, built once per session and input folder.

The stages hand over by table, as a scheduled run would: raw -> survivors of cleaning ->
featured. A query on one stage reads the stored table before it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixture
from haulmetrics.plans import increments, marketplace, mapping, report
from haulmetrics.plans.clean import clean_events, clean_orders, located
from haulmetrics.plans.features import engineer_features
from haulmetrics.plans.split import modelling_table, with_split
from haulmetrics.session import configure, new_path, stage
from haulmetrics.sources.csv import typed_market
from haulmetrics.sources.tables import write_csv

_built: dict[tuple, object] = {}


def _once(spark: SparkSession, sf: str, name: str, build: Callable[[], object]):
    configure(spark)
    key = (spark.conf.get("spark.app.id", ""), sf, name)
    if key not in _built:
        _built[key] = build()
    return _built[key]


def forget() -> None:
    """Build every stage anew on next use (for timing)."""
    _built.clear()


def _table(spark, sf, name, make) -> DataFrame:
    return _once(spark, sf, name, lambda: stage(make(), name))


def raw(spark, sf) -> DataFrame:
    return _table(spark, sf, "orders_raw", lambda: fixture.shipments_raw(spark, sf))


def survivors(spark, sf) -> DataFrame:
    return _once(spark, sf, "located", lambda: located(raw(spark, sf))[0])


def clean(spark, sf) -> DataFrame:
    """Not stored: beyond the stored survivors it is what a query uses of the filled columns."""
    return _once(spark, sf, "orders_clean", lambda: clean_orders(raw(spark, sf)))


def new_features(spark, sf) -> DataFrame:
    """The featured orders, not stored: for queries that read a part of them, once."""
    return engineer_features(clean(spark, sf))


def featured(spark, sf, *columns: str) -> DataFrame:
    """The featured orders, stored; those ``columns`` alone, if a query reads no others."""
    if not columns:
        return _table(spark, sf, "orders_featured", lambda: new_features(spark, sf))
    return _once(spark, sf, f"orders_featured: {', '.join(sorted(columns))}",
                 lambda: stage(new_features(spark, sf).select(*columns), "orders_featured"))


def summarised(spark, sf) -> DataFrame:
    """The columns of the featured orders that the summary is made of, stored alone."""
    return _table(spark, sf, "orders_summarised",
                  lambda: new_features(spark, sf).select(*report.SUMMARY_COLUMNS))


def kept(spark, sf) -> str:
    """Folder of partial aggregates of the cleaned orders, in three batches of months.

    The first comes with too few orders and again whole, the second twice.
    """
    def build() -> str:
        folder = new_path(spark, "kept")
        rows, third = clean(spark, sf), F.month("order_date") % 3
        increments.add_batch(rows.where((third == 0) & (F.col("quantity") > 10)), folder, "a")
        for batch, n in (("b", 1), ("a", 0), ("b", 1), ("c", 2)):
            increments.add_batch(rows.where(third == n), folder, batch)
        return folder
    return _once(spark, sf, "kept", build)


def _training(df: DataFrame) -> DataFrame:
    return with_split(modelling_table(df)).where("split = 'train'").drop("split")


def marked(spark, sf) -> DataFrame:
    return with_split(modelling_table(featured(spark, sf)))


def train(spark, sf) -> DataFrame:
    return _training(featured(spark, sf))


def new_train(spark, sf) -> DataFrame:
    """The training part, not stored: for queries that read some columns of it, once."""
    return _training(new_features(spark, sf))


def tracking(spark, sf) -> DataFrame:
    return _table(spark, sf, "events_raw", lambda: fixture.tracking_raw(spark, sf))


def events(spark, sf) -> DataFrame:
    return _table(spark, sf, "events_clean", lambda: clean_events(tracking(spark, sf)))


def market(spark, sf) -> dict[str, DataFrame]:
    configure(spark)
    return {name: typed_market(df) for name, df in fixture.market_text(spark, sf).items()}


def joined(spark, sf) -> DataFrame:
    return _table(spark, sf, "market_joined", lambda: new_join(spark, sf))


def new_join(spark, sf) -> DataFrame:
    """The marketplace join, not stored: for queries that read a part of it, once."""
    return marketplace.join_tables(market(spark, sf), staged=True)


def mapped(spark, sf) -> DataFrame:
    """Not stored: a query maps and shuffles those columns of the stored join that it uses."""
    return _once(spark, sf, "market_mapped",
                 lambda: marketplace.map_to_schema(joined(spark, sf)))


def vendor(spark, sf, ids: str = "unique") -> DataFrame:
    return _table(spark, sf, f"vendor_{ids}",
                  lambda: fixture.vendor_feed(spark, sf, ids=ids))


def vendor_mapped(spark, sf, ids: str = "unique") -> DataFrame:
    """Not stored: a query maps those columns of the stored feed that it uses."""
    return _once(spark, sf, f"vendor_mapped_{ids}",
                 lambda: mapping.map_to_schema(vendor(spark, sf, ids)))


def _shuffled(df: DataFrame, extra: str) -> DataFrame:
    """As real exports: columns in another order and one that nobody asked for."""
    names = df.columns
    return df.select(*names[1::2], F.lit('a "quoted", note').alias(extra), *names[::2])


def order_csv(spark, sf, source: str) -> str:
    """Folder with one canonical feed as CSV."""
    def build() -> str:
        path = new_path(spark, f"csv_{source}")
        feed = raw(spark, sf).where(f"source_system = '{source}'").drop("source_system")
        write_csv(_shuffled(feed, "customer_note"), path, compression="gzip")
        return path
    return _once(spark, sf, f"csv_{source}", build)


def market_csv(spark, sf) -> str:
    """Folder with the seven marketplace tables as CSV."""
    def build() -> str:
        path = new_path(spark, "market_csv")
        for name, df in fixture.market_text(spark, sf).items():
            write_csv(_shuffled(df, "shipping_limit_date"), f"{path}/{name}",
                      compression="gzip")
        return path
    return _once(spark, sf, "market_csv", build)
